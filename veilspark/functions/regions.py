"""Where the six request formats hold conversation text: a table of shapes, and one reader for all of them.

A shape is a function (value, path, see) that returns the value to put in place. ``see`` says what is done at a region: ``text``
for plain text, ``tree`` for JSON of a tool (walked with field rules), ``arguments`` for JSON inside a string that may be
malformed, ``strict`` for JSON inside a string that may not. One table so serves checking, listing and rewriting. Kinds and keys
that the table doesn't name pass unread.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

# The known formats.
FORMATS = ["openai", "openai-response", "claude", "gemini", "openai-image", "openai-video"]
Shape = Callable[[object, str, "See"], object]


class Number(str):
    """A JSON number with its own digits."""


class Malformed(ValueError):
    """A structural error: a path and a detail, neither of which quotes content."""

    def __init__(self, path: str, detail: str):
        super().__init__(detail)
        self.path, self.detail = path, detail


class See:
    """Looks at regions and changes nothing."""

    def text(self, value: str, path: str) -> str:
        return value

    def tree(self, value: object, path: str) -> object:
        return value

    def arguments(self, value: str, path: str) -> str:
        return value

    def strict(self, value: str, path: str) -> str:
        read_json(value, path)
        return value


class Listing(See):
    """Collects (path, kind, text) of all regions."""

    def __init__(self) -> None:
        self.found: list[tuple[str, str, str]] = []

    def text(self, value, path):
        self.found.append((path, "text", value))
        return value

    def tree(self, value, path):
        self.found.append((path, "tree", value if is_text(value) else write_json(value)))
        return value

    def arguments(self, value, path):
        self.found.append((path, "arguments", value))
        return value

    def strict(self, value, path):
        self.found.append((path, "arguments", super().strict(value, path)))
        return value


def is_text(value: object) -> bool:
    return isinstance(value, str) and not isinstance(value, Number)


_LONE = re.compile("[\ud800-\udfff]")


def _whole(value: object) -> object:
    """Lone halves of surrogate pairs, which no encoding can write, as U+FFFD."""
    if is_text(value):
        return _LONE.sub("\ufffd", value)
    if isinstance(value, dict):
        return {_LONE.sub("\ufffd", k): _whole(v) for k, v in value.items()}
    return [_whole(v) for v in value] if isinstance(value, list) else value


def read_json(text: str, path: str = "") -> object:
    """Exactly one JSON value; numbers keep their digits, and NaN and Infinity are no numbers."""

    def refuse(_: str):
        raise Malformed(path, "invalid JSON")

    try:
        value = json.loads(text, parse_int=Number, parse_float=Number, parse_constant=refuse)
    except Malformed:
        raise
    except json.JSONDecodeError as e:
        raise Malformed(path, json_error(text, e)) from None
    except (ValueError, RecursionError):
        raise Malformed(path, "invalid JSON") from None
    return _whole(value) if re.search(r"\\u[dD][89a-fA-F]|[\ud800-\udfff]", text) else value


def json_error(text: str, e: json.JSONDecodeError) -> str:
    """Why a text is no JSON value: its place at most, never its content."""
    if e.msg == "Extra data":
        return "more than one JSON value"
    if e.pos >= len(text.rstrip()) or e.msg.startswith("Unterminated string"):
        return "incomplete JSON"
    return f"invalid JSON at byte {len(text[: e.pos].encode('utf-8', 'replace')) + 1}"


def write_json(value: object) -> str:
    """Canonical text: sorted keys, no spaces, numbers as they came."""
    if isinstance(value, Number):
        return str.__str__(value)
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{write_json(value[k])}" for k in sorted(value)) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(write_json, value)) + "]"
    return json.dumps(value, ensure_ascii=False)


# ---- shapes


def _string(use: str) -> Shape:
    def visit(value, path, see):
        if not is_text(value):
            raise Malformed(path, "has to be a string")
        return getattr(see, use)(value, path)

    return visit


text, arguments, strict = _string("text"), _string("arguments"), _string("strict")


def tree(value, path, see):
    return see.tree(value, path)


def listed(item: Shape) -> Shape:
    def visit(value, path, see):
        if not isinstance(value, list):
            raise Malformed(path, "has to be an array")
        return [item(x, f"{path}[{i}]", see) for i, x in enumerate(value)]

    return visit


def text_or(other: Shape) -> Shape:
    return lambda value, path, see: see.text(value, path) if is_text(value) else other(value, path, see)


def null_or(other: Shape) -> Shape:
    return lambda value, path, see: None if value is None else other(value, path, see)


def values(item: Shape) -> Shape:
    """An object's values, its keys masked."""
    return obj(lambda v, path, see: v.update({k: item(x, f"{path}.*", see) for k, x in v.items()}))


def need(key: str, shape: Shape) -> Callable:
    def member(v, path, see):
        at = f"{path}.{key}".lstrip(".")
        if key not in v:
            raise Malformed(at, "is missing")
        v[key] = shape(v[key], at, see)

    return member


def may(key: str, shape: Shape) -> Callable:
    own = need(key, shape)
    return lambda v, path, see: own(v, path, see) if key in v else None


def null(key: str, shape: Shape = text) -> Callable:
    return may(key, null_or(shape))


def obj(*members: Callable) -> Shape:
    def visit(value, path, see):
        if not isinstance(value, dict):
            raise Malformed(path, "has to be an object")
        for member in members:
            member(value, path, see)
        return value

    return visit


def by_kind(cases: dict[str, Shape], guess: Callable[[dict], str | None] = lambda _: None, key: str = "type") -> Shape:
    """An object whose kind chooses its shape; other kinds stay unread."""

    def visit(value, path, see):
        if not isinstance(value, dict):
            raise Malformed(path, "has to be an object")
        kind = value.get(key) if key in value else guess(value)
        case = cases.get(kind) if is_text(kind) else None
        return case(value, path, see) if case else value

    return visit


def kinds(names: str, *members: Callable) -> dict[str, Shape]:
    return dict.fromkeys(names.split(), obj(*members))


_SAID = kinds("text input_text output_text", need("text", text)) | kinds("refusal", need("refusal", text))
# ---- chat
_CHAT = obj(
    may("content", null_or(text_or(listed(by_kind(_SAID))))), null("refusal"), null("reasoning_content"), null("audio", obj(null("transcript"))),
    null("tool_calls", listed(by_kind(kinds("function", need("function", obj(need("arguments", arguments)))) | kinds("custom", need("custom", obj(need("input", text)))), lambda v: "function" if "function" in v else None))),
    null("function_call", obj(may("arguments", arguments))),
)
# ---- responses
_PARTS = text_or(listed(by_kind(_SAID | kinds("summary_text reasoning_text", need("text", text)))))
_TYPED = by_kind(kinds("type", need("text", text)))
_EXEC = kinds("exec", need("command", text_or(listed(text))), null("env", values(text)), null("user"), null("working_directory"))


def _any_action(v, path, see):
    if "action" not in v and "actions" not in v:
        raise Malformed(f"{path}.action", "is missing")


_ITEMS = (
    kinds("message agent_message", need("content", _PARTS)) | _SAID
    | kinds("function_call mcp_approval_request", need("arguments", arguments)) | kinds("mcp_call", need("arguments", arguments), null("error"), null("output"))
    | kinds("function_call_output custom_tool_call_output", need("output", _PARTS)) | kinds("custom_tool_call", need("input", text))
    | kinds("reasoning", null("summary", _PARTS), null("content", _PARTS))
    | kinds("computer_call", _any_action, may("action", _TYPED), may("actions", listed(_TYPED)), null("pending_safety_checks", listed(obj(null("message")))))
    | kinds("local_shell_call", need("action", by_kind(_EXEC))) | kinds("local_shell_call_output", need("output", strict))
    | kinds("shell_call", need("action", obj(need("commands", listed(text))))) | kinds("shell_call_output", need("output", listed(obj(need("stdout", text), need("stderr", text)))))
    | kinds("apply_patch_call", need("operation", by_kind(kinds("create_file update_file", need("path", text), need("diff", text)) | kinds("delete_file", need("path", text)))))
    | kinds("apply_patch_call_output", null("output")) | kinds("mcp_list_tools", null("error")) | kinds("mcp_approval_response", null("reason"))
    | kinds("program", need("code", text)) | kinds("program_output", need("result", text))
    | kinds("code_interpreter_call", null("code"), null("outputs", listed(by_kind(kinds("logs", need("logs", text))))))
    | kinds("web_search_call", need("action", by_kind(kinds("search", null("queries", listed(text)), null("query")) | kinds("find_in_page", need("pattern", text)))))
    | kinds("file_search_call", need("queries", listed(text)), null("results", listed(obj(null("text"))))) | kinds("tool_search_call", need("arguments", tree))
)
# ---- claude
_TEXTS = listed(by_kind(kinds("text", need("text", text))))
_DOCUMENT = (null("title"), null("context"), need("source", by_kind(kinds("text", need("data", text)) | kinds("content", need("content", text_or(_TEXTS))))))


def _blocks(value, path, see):
    return text_or(listed(_BLOCK))(value, path, see)


def _answer(value, path, see):
    """What a tool gave: text, blocks or one result."""
    return null_or(text_or(lambda v, p, s: _blocks(v, p, s) if isinstance(v, list) else _RESULT(v, p, s)))(value, path, see)


_RESULT = by_kind(
    kinds("web_fetch_result", need("content", by_kind(kinds("document", *_DOCUMENT)))) | kinds("code_execution_result bash_code_execution_result", need("stdout", text), need("stderr", text))
    | kinds("encrypted_code_execution_result", need("stderr", text)) | kinds("text_editor_code_execution_view_result", lambda v, p, s: need("content", text)(v, p, s) if v.get("file_type") == "text" else None)
    | kinds("text_editor_code_execution_str_replace_result", null("lines", listed(text))) | kinds("text_editor_code_execution_tool_result_error", null("error_message"))
)
_ANSWERS = "tool_result mcp_tool_result web_search_tool_result web_fetch_tool_result code_execution_tool_result bash_code_execution_tool_result text_editor_code_execution_tool_result"
_BLOCK = by_kind(
    kinds("text", need("text", text)) | kinds("thinking", need("thinking", text))
    | kinds("tool_use server_tool_use", need("input", lambda v, p, s: tree(obj()(v, p, s), p, s))) | kinds(_ANSWERS, may("content", _answer))
    | kinds("search_result", may("title", text), may("content", null_or(_blocks))) | kinds("web_search_result web_fetch_result", may("title", text), may("text", text))
    | kinds("document", *_DOCUMENT) | kinds("tool_search_tool_result", need("content", by_kind(kinds("tool_search_tool_result_error", null("error_message")))))
    | kinds("mid_conv_system", need("content", _TEXTS))
)
# ---- gemini
_PART = obj(
    may("text", text), may("functionCall", obj(may("args", tree), may("partialArgs", listed(obj(null("stringValue")))))), may("functionResponse", obj(may("response", tree))),
    may("toolCall", obj(may("args", tree))), may("toolResponse", obj(may("response", tree))), may("executableCode", obj(need("code", text))), may("codeExecutionResult", obj(need("output", text))),
)
_SPOKEN = obj(need("parts", listed(_PART)))

SHAPES: dict[str, Shape] = {
    "openai": obj(need("messages", listed(_CHAT))),
    "openai-response": obj(need("input", text_or(listed(text_or(by_kind(_ITEMS, lambda v: "message" if "role" in v else None))))), null("instructions")),
    "claude": obj(need("messages", listed(obj(need("content", _blocks)))), may("system", _blocks)),
    "gemini": obj(need("contents", listed(_SPOKEN)), may("systemInstruction", _SPOKEN), may("system_instruction", _SPOKEN)),
    "openai-image": obj(may("prompt", text)),
    "openai-video": obj(may("prompt", text)),
}


def read_request(source_format: str | None, body: str | None) -> dict:
    """The body as one JSON object of a known format whose regions have the right shapes; Malformed otherwise."""
    if source_format not in SHAPES:
        raise Malformed("", "unknown format")
    value = read_json(body or "")
    if not isinstance(value, dict):
        raise Malformed("", "has to be one JSON object")
    SHAPES[source_format](value, "", See())
    return value
