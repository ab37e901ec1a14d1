r"""Putting originals back into one response: the per-row part of restoring.

A response is restored where its parts are strings: JSON values (keys stay), arguments that are JSON inside a string (escapes stay
valid, keys too), ``data:`` lines of event streams, or plain text. What is put in isn't looked at again.

JSON that is malformed, or nested so deeply that Python can't walk it, goes out as it came. Streams are in ``streams``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from .columns import TOKEN
from .regions import Malformed, is_text, read_json, write_json

#: In JSON text: an escaped token, another escape, a token, a string's border, or what no JSON string holds.
_ARGUMENT = re.compile(r'\\u003[cC](?P<name>[^<>\\"\r\n]+_[0-9a-f]{16})\\u003[eE]|\\.|(?P<token>' + TOKEN + r')|(?P<border>")|(?P<control>[\x00-\x1f])', re.DOTALL)
_TOKEN = re.compile(TOKEN)
_JSON_START = re.compile(r'\s*(?:[{\["0-9-]|true|false|null|(?:t|tr|tru|f|fa|fal|fals|n|nu|nul)\s*\Z)')
# The arguments of a whole response, as paths of keys (*: each item of a list).
ARGUMENTS = {"openai": [("choices", "*", "message", "tool_calls", "*", "function", "arguments")], "openai-response": [("output", "*", "arguments")]}


def looks_like_json(text: str) -> bool:
    return bool(_JSON_START.match(text))


def json_string_content(text: str) -> str:
    """A text as it stands between the quotes of a JSON string."""
    return write_json(text)[1:-1]


class Restorer:
    """Puts the originals of one request back."""

    def __init__(self, originals: Mapping[str, str]):
        self.originals = originals

    def text(self, s: str) -> str:
        return _TOKEN.sub(lambda m: self.originals.get(m[0], m[0]), s)

    def arguments(self, s: str) -> str:
        """JSON text stays JSON; text that doesn't parse stays as it is."""
        try:
            read_json(s)
        except (Malformed, RecursionError):
            return s
        return Arguments().restore(s, self.originals)

    def tree(self, value: object, paths: list[tuple] = ()) -> object:
        """All string values restored; those at ``paths`` as arguments."""
        if isinstance(value, dict):
            return {k: self.tree(v, [p[1:] for p in paths if p and p[0] == k]) for k, v in value.items()}
        if isinstance(value, list):
            return [self.tree(v, [p[1:] for p in paths if p and p[0] == "*"]) for v in value]
        if not is_text(value):
            return value
        return self.arguments(value) if () in paths else self.text(value)

    def json(self, body: str, source_format: str = "") -> str | None:
        """The body restored; as it came where nothing changes; None where it can't be read as one JSON value."""
        try:
            return self._json(body, read_json(body), source_format)
        except (Malformed, RecursionError):
            return None

    def _json(self, body: str, value: object, source_format: str) -> str:
        paths = ARGUMENTS.get(source_format, [])
        if source_format == "openai-response" and isinstance(value, dict) and isinstance(value.get("output"), list):
            calls = [isinstance(x, dict) and x.get("type") == "function_call" for x in value["output"]]
            done = self.tree({k: v for k, v in value.items() if k != "output"}) | {"output": [self.tree(x, [("arguments",)] if call else []) for x, call in zip(value["output"], calls, strict=True)]}
        else:
            done = self.tree(value, paths)
        return body if done == value else write_json(done)

    def line(self, line: str) -> str:
        """A line of an event stream: the payload of a ``data:`` field restored."""
        if not line.startswith("data:"):
            return line
        lead = "data: " if line.startswith("data: ") else "data:"
        payload = line[len(lead) :]
        done = self.json(payload)
        if done is None:
            done = payload if looks_like_json(payload) else self.text(payload)
        return lead + done

    def events(self, body: str) -> str:
        """An event stream; line ends stay as they are."""
        parts = re.split(r"(\r\n|\n|\r)", body)
        return "".join(self.line(p) if i % 2 == 0 else p for i, p in enumerate(parts))

    def body(self, body: str, route: str, source_format: str = "") -> str:
        """By route (json, sse, other or unknown). JSON that is malformed stays as it is."""
        if not self.originals:
            return body
        if route == "json":
            return self.json(body, source_format) or body
        if route == "sse":
            return self.events(body)
        if route == "unknown":
            done = self.json(body, source_format)
            if done is not None:
                return done
            if re.search(r"(?:\A|[\r\n])data:", body):
                return self.events(body)
            if looks_like_json(body):
                return body
        return self.text(body)


def _start_of(atoms: list[str]) -> str:
    """A pattern for any start of a sequence that isn't the whole of it."""
    out = ""
    for a in reversed(atoms):
        out = f"(?:{a}{out})?" if out else f"(?:{a})?"
    return out[3:-2]  # at least the first


def held(labels: list[str], escaped: bool = False) -> re.Pattern:
    """Where a text's end may be the start of a token of these labels."""
    starts = []
    for label in labels:
        name = [re.escape(c) for c in label + "_"] + ["[0-9a-f]"] * 16
        starts.append(_start_of(["<", *name]))
        if escaped:
            starts.append(_start_of([r"\\", "u", "0", "0", "3", "[cC]", *name, r"\\", "u", "0", "0", "3"]))
    return re.compile(f"(?:{'|'.join(starts)})\\Z") if starts else re.compile(r"(?!)")


def labels_of(tokens) -> list[str]:
    return sorted({t[1:-18] for t in tokens})


class Arguments:
    """Arguments that come in fragments: whether the next character is inside a string, and what is held back."""

    def __init__(self, inside: bool = False, off: bool = False, tail: str = ""):
        self.inside, self.off, self.tail = inside, off, tail

    def restore(self, s: str, originals: Mapping[str, str]) -> str:
        def put(m: re.Match) -> str:
            if m["border"]:
                self.inside = not self.inside
            elif m["control"] and self.inside:
                self.off = True  # no JSON: nothing more is put in
            elif self.inside and not self.off and (token := m["token"] or m["name"] and f"<{m['name']}>") in originals:
                return json_string_content(originals[token])
            return m[0]

        return _ARGUMENT.sub(put, s)

    def add(self, fragment: str, originals: Mapping[str, str], hold: re.Pattern, last: bool = False) -> str:
        s = self.tail + fragment
        at = len(s)
        if not last and not self.off:
            m = hold.search(s)
            while m and m[0][0] == "\\" and (m.start() - len(s[: m.start()].rstrip("\\"))) % 2:
                m = hold.search(s, m.start() + 1)  # the second half of an escaped backslash
            at = m.start() if m else at
        self.tail = s[at:]
        return self.restore(s[:at], originals)
