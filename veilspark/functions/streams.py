r"""One request's streamed chunks: framing, the protocols' deltas, and the life of the stream.

*Framing.* Under an event stream's media type, what comes is cut into events: ``data:`` events end at a blank line, a bare JSON object
where it closes (brackets outside objects and blank lines go straight on), and an event of the responses format also where its payload
is whole, as its sender may leave the blank line to others. Lines of no such kind go out as they come. The end is looked for in what is
new, so an event that comes in many pieces costs time in proportion to its length. Beyond MAX_CARRY characters an event goes out unread.

*Deltas.* An event is first read into a plan of what to do at which path; an event of a known kind whose members have other types has no
plan and goes out byte for byte. Only then is the plan carried out. Text is held back from where a token may have begun, for each channel
of the protocol on its own (a choice, an output item, a content block, a part of a candidate), and goes out with the channel's next delta
or its end: in the ending event itself where that has a place for it, else in an event of its own before it.

*Life.* An init (index -1) brings the originals; chunks go in order of their index, and what comes early waits. A completion refuses
all that is later than it. What waits for longer than the watermark allows is worked on without what is missing. After IDLE_SECONDS without
a chunk nothing is left. An init of an unfinished request starts over.

State goes through a store with single entries for originals, channels, waiting chunks and pieces of an event, so that a chunk touches
only what it names. ``Memory`` is such a store for tables; a stream has one on Spark's state.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

from .regions import Malformed, Number, is_text, read_json, write_json
from .restoring import Arguments, Restorer, held, labels_of

# Limits of one stream.
MAX_CHANNELS, MAX_CARRY, IDLE_SECONDS = 1024, 1 << 20, 300.0

# ---- shapes of known events: a dict's members, one kind for all items of a list; ? may be absent, ~ may be null

TEXT, SOME, INDEX, FLAG = "text", "some text", "index", "flag"
_KINDS = {TEXT: is_text, SOME: lambda v: is_text(v) and v != "", INDEX: lambda v: isinstance(v, Number) and v.isdigit(), FLAG: lambda v: isinstance(v, bool)}


def fits(value: object, shape: object) -> bool:
    if isinstance(shape, list):
        return isinstance(value, list) and all(fits(v, shape[0]) for v in value)
    if isinstance(shape, dict):
        if not isinstance(value, dict):
            return False
        for name, own in shape.items():
            key, optional, nullable = _named(name)
            if key not in value:
                if not optional:
                    return False
            elif not (nullable and value[key] is None or fits(value[key], own)):
                return False
        return True
    return _KINDS[shape](value)


@lru_cache(maxsize=1024)
def _named(name: str) -> tuple[str, bool, bool]:
    """(key, whether it may be absent, whether it may be null) of a member's name in a shape."""
    return name.rstrip("?~"), "?" in name, "~" in name


_CALL = {"function?~": {"arguments?": TEXT}}
CHAT = {"choices": [{"index": INDEX, "delta": {"content?~": TEXT, "tool_calls?~": [_CALL]}, "finish_reason?~": TEXT}]}
_PART = {"thought?": FLAG}
GEMINI = {"candidates": [{"index?": INDEX, "finishReason?~": TEXT, "content?": {"parts?": [_PART]}}]}
RESPONSES = {
    "response.output_text.delta": {"output_index": INDEX, "content_index": INDEX, "item_id?": TEXT, "delta": TEXT},
    "response.output_text.done": {"output_index": INDEX, "content_index": INDEX, "item_id?": TEXT, "text": TEXT},
    "response.function_call_arguments.delta": {"output_index": INDEX, "item_id": SOME, "delta": TEXT},
    "response.function_call_arguments.done": {"output_index": INDEX, "item_id": SOME, "arguments": TEXT},
    "response.output_item.done": {"item": {"type": TEXT}},
}
_CALL_DONE = {"output_index": INDEX, "item": {"id": SOME, "arguments": TEXT}}
CLAUDE = {"content_block_delta": {"index": INDEX, "delta": {"type": TEXT}}, "content_block_stop": {"index": INDEX}, "message_stop": {}}
_CLAUDE_DELTAS = {"text_delta": ("text", "text"), "thinking_delta": ("text", "thinking"), "input_json_delta": ("arguments", "partial_json")}

# ---- plans

_SEP = "\x1f"


def channel(*names: object) -> str:
    """A channel's name; the names of a group of channels are the start of each."""
    return "".join(f"{n}{_SEP}" for n in names)


@dataclass
class Plan:
    """``steps``: (use, channel, path) of strings that are deltas (text, arguments), arguments as a whole (whole) or stay (keep).
    ``ends``: (channel or start of channels, path of the text that can take what is still held, or None; a last + adds a part)."""

    steps: list[tuple[str, str | None, tuple]] = field(default_factory=list)
    ends: list[tuple[str, tuple | None]] = field(default_factory=list)


OPAQUE = object()


def _chat(doc: dict) -> object:
    if doc.get("object") != "chat.completion.chunk":
        return None
    if not fits(doc, CHAT):
        return OPAQUE
    plan = Plan()
    for n, choice in enumerate(doc["choices"]):
        i, delta, at = choice["index"], choice["delta"], ("choices", n, "delta")
        if is_text(delta.get("content")):
            plan.steps.append(("text", channel("c", i), (*at, "content")))
        for m, call in enumerate(delta.get("tool_calls") or []):
            if "arguments" in (call.get("function") or {}):
                j = call.get("index")
                plan.steps.append(("arguments", channel("a", i, j), (*at, "tool_calls", m, "function", "arguments")) if fits(j, INDEX) else ("keep", None, (*at, "tool_calls", m, "function", "arguments")))
        if is_text(choice.get("finish_reason")):
            plan.ends += [(channel("c", i), (*at, "content")), (channel("a", i), None)]
    return plan


def _responses(doc: dict) -> object:
    kind = doc.get("type")
    if not is_text(kind):
        return None
    if kind in RESPONSES and not fits(doc, RESPONSES[kind]):
        return OPAQUE
    plan = Plan()
    place = [doc[k] if isinstance(doc.get(k), str) else "" for k in ("output_index", "item_id", "content_index", "summary_index")]
    if kind == "response.function_call_arguments.delta":
        plan.steps.append(("arguments", channel("a", *place[:2]), ("delta",)))
    elif kind == "response.function_call_arguments.done":
        plan.ends.append((channel("a", *place[:2]), None))
        plan.steps.append(("whole", None, ("arguments",)))
    elif kind == "response.output_item.done":
        if doc["item"]["type"] != "function_call":
            return None
        if not fits(doc, _CALL_DONE):
            return OPAQUE
        plan.ends.append((channel("a", place[0], doc["item"]["id"]), None))
        plan.steps.append(("whole", None, ("item", "arguments")))
    elif kind == "response.completed":
        plan.ends.append(("", None))
        response = doc.get("response")
        output = response.get("output") if isinstance(response, dict) else None
        for n, item in enumerate(output if isinstance(output, list) else []):
            if isinstance(item, dict) and item.get("type") == "function_call" and is_text(item.get("arguments")):
                plan.steps.append(("whole", None, ("response", "output", n, "arguments")))
    elif kind.endswith(".delta") and is_text(doc.get("delta")):
        plan.steps.append(("text", channel("c", kind.removesuffix(".delta"), *place), ("delta",)))
    elif kind.endswith(".done"):
        plan.ends.append((channel("c", kind.removesuffix(".done"), *place), None))
    else:
        return None
    return plan


def _claude(doc: dict) -> object:
    kind = doc.get("type")
    if not is_text(kind) or kind not in CLAUDE:
        return None
    if not fits(doc, CLAUDE[kind]):
        return OPAQUE
    plan, i = Plan(), doc.get("index")
    if kind == "content_block_delta":
        if doc["delta"]["type"] not in _CLAUDE_DELTAS:
            return None
        use, name = _CLAUDE_DELTAS[doc["delta"]["type"]]
        if not is_text(doc["delta"].get(name)):
            return OPAQUE
        plan.steps.append((use, channel("a", i) if use == "arguments" else channel("c", i, name), ("delta", name)))
    else:
        plan.ends += [(channel("c", i), None), (channel("a", i), None)] if kind == "content_block_stop" else [("", None)]
    return plan


def _gemini(doc: dict) -> object:
    if "candidates" not in doc:
        return None
    if not fits(doc, GEMINI):
        return OPAQUE
    plan = Plan()
    for n, candidate in enumerate(doc["candidates"]):
        i = candidate.get("index", str(n))
        for m, part in enumerate((candidate.get("content") or {}).get("parts") or []):
            if "text" not in part:
                continue
            path = ("candidates", n, "content", "parts", m, "text")
            if part.get("thought"):
                plan.steps.append(("keep", None, path))
            elif is_text(part["text"]):
                plan.steps.append(("text", channel("c", i, m), path))
            else:
                return OPAQUE
        if candidate.get("finishReason"):
            plan.ends.append((channel("c", i), ("candidates", n, "content", "parts", "+")))
    return plan


PLANS = {"openai": _chat, "openai-response": _responses, "claude": _claude, "gemini": _gemini}


def late_delta(source_format: str, name: str, tail: str) -> tuple[str, dict]:
    """(event name, event) that carries the held text of a channel whose end has no place for it."""
    kind, *place = name.split(_SEP)[:-1]
    if source_format == "openai":
        delta = {"content": tail} if kind == "c" else {"tool_calls": [{"function": {"arguments": tail}, "index": Number(place[1])}]}
        return "", {"object": "chat.completion.chunk", "choices": [{"index": Number(place[0]), "delta": delta, "finish_reason": None}]}
    if source_format == "claude":
        kinds = {x: t for t, (_, x) in _CLAUDE_DELTAS.items()}
        own = "partial_json" if kind == "a" else place[1]
        return "content_block_delta", {"type": "content_block_delta", "index": Number(place[0]), "delta": {"type": kinds[own], own: tail}}
    if source_format == "openai-response":
        event = "response.function_call_arguments" if kind == "a" else place.pop(0)
        keys = ("output_index", "item_id", "content_index", "summary_index")
        own = {k: v if k == "item_id" else Number(v) for k, v in zip(keys, place, strict=False) if v}
        return f"{event}.delta", {"type": f"{event}.delta", **own, "delta": tail}
    return "", {"candidates": [{"index": Number(place[0]), "content": {"parts": [{"text": tail}]}}]}


# ---- stores


class Memory:
    """A stream's state in plain dicts."""

    def __init__(self) -> None:
        self.head: dict | None = None
        self._originals: dict[str, list] = {}
        self._channels: dict[str, list] = {}
        self._waiting: dict[int, dict] = {}
        self._pieces: list[str] = []

    def original(self, token: str) -> list | None:
        return self._originals.get(token)

    def put_originals(self, originals: dict[str, list]) -> None:
        self._originals = dict(originals)

    def channel(self, name: str) -> list | None:
        return self._channels.get(name)

    def put_channel(self, name: str, value: list | None) -> None:
        if value is None:
            self._channels.pop(name, None)
        else:
            self._channels[name] = value

    def channels(self) -> list[str]:
        return list(self._channels)

    def waiting(self) -> list[int]:
        return sorted(self._waiting)

    def is_waiting(self, index: int) -> bool:
        return index in self._waiting

    def put_waiting(self, index: int, row: dict) -> None:
        self._waiting[index] = row

    def take_waiting(self, index: int) -> dict | None:
        return self._waiting.pop(index, None)

    def push(self, piece: str) -> None:
        self._pieces.append(piece)

    def take_pieces(self) -> str:
        out, self._pieces = "".join(self._pieces), []
        return out

    def clear(self, waiting: bool = True) -> None:
        """All but the head."""
        self._originals, self._channels, self._pieces = {}, {}, []
        if waiting:
            self._waiting = {}


class _Live:
    """The originals of a store that haven't expired."""

    def __init__(self, store: Memory, now: float):
        self.store, self.now = store, now

    def get(self, token: str, default: str | None = None) -> str | None:
        own = self.store.original(token)
        return own[0] if own and (own[1] is None or self.now <= own[1]) else default

    def __contains__(self, token: object) -> bool:
        return isinstance(token, str) and self.get(token) is not None

    def __getitem__(self, token: str) -> str:
        return self.get(token)


# ---- framing and restoring

#: A blank line behind a line.
_BLANK = re.compile(r"\r\n\r\n|\n\r\n|\n\n|\r\r")
_FIELD = re.compile(r"(?:data|event|id|retry)?:")
_FIELD_STARTS = {f[:i] for f in ("data:", "event:", "id:", "retry:") for i in range(1, len(f))}
_JUMP = re.compile(r'["\\{}\[\]]')


_held = lru_cache(maxsize=1024)(lambda labels, escaped: held(list(labels), escaped))
#: What an event holds where a token may start, as it stands or escaped, and the names of deltas whose quotes are counted.
_STARTS, _COUNTED = re.compile(r"<|\\u"), re.compile("arguments|partial_json")


def json_end(text: str, depth: int, inside: bool, skip: bool) -> tuple[int | None, int, bool, bool]:
    """Where a JSON object that may have begun earlier closes in ``text``, and the state behind it: how deep, whether inside a string,
    whether the next character is escaped."""
    at = 1 if skip and text else 0
    skip = skip and not text
    for m in _JUMP.finditer(text, at):
        if m.start() < at:
            continue
        c = m[0]
        if inside:
            if c == "\\":
                at = m.end() + 1
                skip = at > len(text)
            elif c == '"':
                inside = False
        elif c == '"':
            inside = True
        elif c in "{[":
            depth += 1
        elif c in "}]":
            depth -= 1
            if depth == 0:
                return m.end(), 0, False, False
    return None, depth, inside, skip


class Stream:
    """Restores the chunks of one request, in order."""

    def __init__(self, store: Memory, now: float):
        self.store, self.head = store, store.head
        self.work = Restorer(_Live(store, now))
        labels = tuple(self.head["labels"])
        self.hold, self.hold_arguments = _held(labels, False), _held(labels, True)

    def chunk(self, body: str, route: str) -> str:
        """What goes out for a chunk; empty where all of it is held back."""
        if not self.head["labels"]:
            return body
        return self._events(body) if route == "sse" else self._plain(body, route)

    def _plain(self, body: str, route: str) -> str:
        s = self._take() + body
        m = self.hold.search(s)
        at = m.start() if m else len(s)
        if at < len(s):
            self._push(s[at:])
        return self.work.body(s[:at], route, self.head["format"]) if at else ""

    def _take(self) -> str:
        """What is held of an event; none is then."""
        self.head["frame"] = {}
        return self.store.take_pieces() if self.head.pop("size", 0) else ""

    def _push(self, piece: str, **frame) -> None:
        self.store.push(piece)
        self.head["size"] = self.head.get("size", 0) + len(piece)
        self.head["frame"] = frame

    def _events(self, rest: str) -> str:
        out = []
        while rest:
            kind = self.head["frame"].get("kind")
            if kind in ("sse", "json"):
                done, rest = self._more(kind, rest)
                out.append(done)
            elif kind == "line":
                end = re.search(r"\r\n|\n|\r", rest)
                out.append(rest[: end.end()] if end else rest)
                rest = rest[end.end() :] if end else ""
                self.head["frame"] = {} if end else {"kind": "line"}
            else:
                rest = self._take() + rest
                between = re.match(r"[\s\[\],]*(?=\{)|[\r\n]+|[\s\[\],]+\Z", rest)
                if between and between.end():
                    out.append(between[0])
                    rest = rest[between.end() :]
                if rest in _FIELD_STARTS:
                    self._push(rest, kind="start")
                    break
                if rest:
                    self.head["frame"] = {"kind": "json" if rest[0] == "{" else "sse" if _FIELD.match(rest) else "line"}
        return "".join(out)

    def _more(self, kind: str, rest: str) -> tuple[str, str]:
        """(what goes out, what is behind the event) for more of an event."""
        f = self.head["frame"]
        if kind == "json":
            end, *state = json_end(rest, f.get("depth", 0), f.get("inside", False), f.get("skip", False))
            f = dict(zip(("depth", "inside", "skip"), state, strict=True))
        else:
            if self.head.get("size") and re.match(r"(?:data|event|id|retry)?:", rest) and f.get("last", "")[-1:] not in "\r\n":
                held_back = self._take()
                rest, f = held_back + ("\n" if self._whole_line(held_back) else "") + rest, {}  # lines that came one a chunk, without their ends
            last = f.get("last", "")
            m = _BLANK.search(last + rest)
            end = m.end() - len(last) if m else None
            f = {"last": (last + rest)[-3:]}
        if end is not None:
            return self._event(self._take() + rest[:end], kind), rest[end:]
        self._push(rest, kind=kind, **f)
        if kind == "sse" and self.head["format"] == "openai-response" and rest[-1:] == "}":
            whole = self._take()
            if self._payload(whole)[1] is not None:
                return self._event(whole, kind), ""
            self._push(whole, kind=kind, **f)
        return (self._take(), "") if self.head["size"] > MAX_CARRY else ("", "")

    @staticmethod
    def _whole_line(s: str) -> bool:
        line = re.split(r"[\r\n]", s)[-1]
        if not line.startswith("data:"):
            return bool(_FIELD.match(line))
        try:
            read_json(line[5:])
        except Malformed:
            return line[5:].strip() == "[DONE]"
        return True

    @staticmethod
    def _payload(event: str) -> tuple[str, object]:
        """(text, value) of an event's data lines; None where it isn't one JSON value."""
        lines = [x[5:].removeprefix(" ") for x in re.split(r"\r\n|\n|\r", event) if x.startswith("data:")]
        text = "\n".join(lines)
        try:
            return text, read_json(text)
        except Malformed:
            return text, None

    def _event(self, event: str, kind: str) -> str:
        quiet = not _STARTS.search(event)
        if quiet and not self.head["channels"] and not _COUNTED.search(event):
            return event  # read or not, it goes out as it came
        if kind == "json":
            try:
                doc = read_json(event)
            except Malformed:
                return event
            before, after = self._carried_out(doc, None, quiet)
            return before + (event if after is None else write_json(after))
        text, doc = self._payload(event)
        first = re.search(r"(?:\A|[\r\n])data:( ?)", event)
        ending = re.search(r"\r\n|\n|\r", event)
        form = ("data:" + (first[1] if first else ""), ending[0] if ending else "\n")
        if text == "[DONE]" and self.head["format"] == "openai":
            return self._late("", *form) + event
        if doc is None:
            return self.work.events(event)
        before, after = self._carried_out(doc, form, quiet)
        if after is None:
            return before + event
        lines, said = [], form[0] + write_json(after)
        for line, end in re.findall(r"([^\r\n]*)(\r\n|\n|\r|\Z)", event):
            if not line.startswith("data:"):
                lines.append(line + end)
            elif said:
                lines.append(said + end)
                said = ""
        return before + "".join(lines)

    def _carried_out(self, doc: object, form: tuple[str, str] | None, quiet: bool) -> tuple[str, object]:
        """(events before, the new document; None: the event stays as it came). ``quiet``: no token starts in the event."""
        plan = PLANS[self.head["format"]](doc) if isinstance(doc, dict) and self.head["format"] in PLANS else None
        if plan is OPAQUE:
            return "", None
        plan = plan or Plan()
        ends = [p for p, _ in plan.ends]
        said: dict[tuple, str] = {}
        for k, (use, name, path) in enumerate(plan.steps):
            was = _at(doc, path)
            last = name is not None and any(name.startswith(p) for p in ends) and all(name != other for _, other, _ in plan.steps[k + 1 :])
            if use == "text":
                said[path] = self._text(name, was, last)
            elif use == "arguments":
                said[path] = self._arguments(name, was, last)
            else:
                said[path] = self.work.arguments(was) if use == "whole" else was
        before, placed = "", []
        for start, path in plan.ends:
            if path is None:
                before += self._late(start, *(form or ("data: ", "\n")))
            else:
                tail = "".join(self._tail(name) for name in sorted(self.store.channels()) if name.startswith(start))
                placed += [(path, tail)] if tail else []
        if quiet and not placed and all(text == _at(doc, path) for path, text in said.items()):
            return before, None
        after = _rebuilt(doc, said, self.work)
        for path, tail in placed:
            _add(after, path, tail)
        return before, None if after == doc else after

    def _text(self, name: str, said: str, last: bool) -> str:
        own = self.store.channel(name)
        s = (own[0] if own else "") + said
        room = own or self.head["channels"] < MAX_CHANNELS
        m = self.hold.search(s) if room and not last else None
        self._put(name, own, [s[m.start() :]] if m else None)
        return self.work.text(s[: m.start()] if m else s)

    def _arguments(self, name: str, said: str, last: bool) -> str:
        own = self.store.channel(name)
        if not own and self.head["channels"] >= MAX_CHANNELS:
            return said
        a = Arguments(*(own or ()))
        out = a.add(said, self.work.originals, self.hold_arguments, last)
        self._put(name, own, None if last else [a.inside, a.off, a.tail])
        return out

    def _put(self, name: str, was: list | None, now: list | None) -> None:
        if was != now:
            self.store.put_channel(name, now)
            self.head["channels"] += (now is not None) - (was is not None)

    def _tail(self, name: str) -> str:
        """What a channel still holds, restored; the channel goes."""
        own = self.store.channel(name)
        self._put(name, own, None)
        return self.work.text(own[0]) if len(own) == 1 else Arguments(*own).add("", self.work.originals, self.hold_arguments, True)

    def _late(self, start: str, lead: str, ending: str) -> str:
        """Events with what the channels of a group still hold."""
        out = ""
        for name in sorted(self.store.channels()) if self.head["channels"] else ():
            if name.startswith(start) and (said := self._tail(name)):
                event, doc = late_delta(self.head["format"], name, said)
                out += (f"event: {event}{ending}" if event else "") + lead + write_json(doc) + ending + ending
        return out


def _at(doc: object, path: tuple) -> object:
    for key in path:
        doc = doc[key]
    return doc


def _rebuilt(doc: object, said: dict[tuple, str], work: Restorer) -> object:
    """A copy with the strings at these paths put in, and all other strings restored."""
    if () in said:
        return said[()]
    if not said:
        return work.tree(doc)
    under: dict[object, dict[tuple, str]] = {}
    for path, text in said.items():
        under.setdefault(path[0], {})[path[1:]] = text
    if isinstance(doc, dict):
        return {k: _rebuilt(v, under.get(k, {}), work) for k, v in doc.items()}
    return [_rebuilt(v, under.get(i, {}), work) for i, v in enumerate(doc)]


def _add(doc: object, path: tuple, tail: str) -> None:
    """Adds text behind what stands at a path, whose last containers may still be missing."""
    if path[-1] != "+":
        owner = _at(doc, path[:-1])
        owner[path[-1]] = (owner.get(path[-1]) or "") + tail
        return
    owner = doc
    for key, missing in zip(path[:-1], (None, None, dict, list), strict=True):
        owner = owner[key] if missing is None else owner.setdefault(key, missing())
    owner.append({"text": tail})


# ---- life


class Session:
    """Takes the rows of one request in any order; gives (chunk_index, body, dropped, error) of its chunks."""

    def __init__(self, store: Memory):
        self.store = store

    def add(self, row: dict) -> Iterator[tuple]:
        """``row``: chunk_index (null: a completion), ts in seconds, body, route, and on an init originals (token -> [original, the
        second it expires]) and source_format."""
        index, now = row["chunk_index"], row["ts"]
        head = self.store.head or {"ready": False, "next": 0, "last": None, "completed": None, "idle": False}
        if index is None:
            head["completed"] = now if head["completed"] is None else min(now, head["completed"])
            self.store.head = head
            return
        self.store.head = head
        if head["completed"] is not None and now > head["completed"]:
            yield index, None, False, "the request is completed"
        elif index < -1:
            yield index, None, False, "no such chunk index"
        elif index == -1:
            if head["ready"]:  # starts over; what has waited goes out first
                yield from self._worked_off(self.store.waiting())
            self.store.clear(waiting=head["ready"])
            self.store.put_originals(row["originals"] or {})
            head |= {"ready": True, "idle": False, "next": 0, "last": now, "format": row["source_format"] or "", "labels": labels_of(row["originals"] or {}), "channels": 0, "size": 0, "frame": {}}
            yield from self._in_turn()
        elif head["idle"]:
            yield index, None, False, "the request has no init"
        elif head["ready"] and index < head["next"] or self.store.is_waiting(index):
            yield index, None, False, "the chunk has come before, or too late"
        elif head["ready"] and index == head["next"]:
            yield self._restored(index, row)
            yield from self._in_turn()
        else:
            self.store.put_waiting(index, row)
            yield from self._in_turn()

    def _in_turn(self) -> Iterator[tuple]:
        head = self.store.head
        while head["ready"] and (row := self.store.take_waiting(head["next"])):
            yield self._restored(head["next"], row)

    def _worked_off(self, indexes: list[int]) -> Iterator[tuple]:
        """Waiting chunks in order, whatever is missing between them."""
        for index in indexes:
            if row := self.store.take_waiting(index):
                yield self._restored(index, row)

    def _restored(self, index: int, row: dict) -> tuple:
        head, now, body = self.store.head, row["ts"], row["body"] or ""
        head["next"] = max(head["next"], index + 1)
        if head["ready"] and now - head["last"] > IDLE_SECONDS:
            head |= {"ready": False, "idle": True}
            self.store.clear(waiting=False)
        if not head["ready"]:
            return index, None, False, "the request has no init"
        head["last"] = max(head["last"], now)
        try:
            said = Stream(self.store, now).chunk(body, row["route"])
        except Exception:  # noqa: BLE001  whatever it is, the chunk goes out as it came and the others go on
            return index, body, False, "the chunk can't be restored"
        return index, said, said == "" and body != "", None

    def pass_time(self, watermark: float) -> Iterator[tuple]:
        """Nothing of before ``watermark`` comes any more: what waits since then is worked off, what is over goes."""
        head = self.store.head
        if head is None:
            return
        waiting = self.store.waiting()
        if waiting:
            due = [i for i in waiting if self._time_of(i) <= watermark]
            if due:
                yield from self._worked_off([i for i in waiting if i <= due[-1]])
                yield from self._in_turn()
        last = max(x for x in (head["last"], head["completed"], float("-inf")) if x is not None)
        if head["completed"] is not None and head["completed"] <= watermark and (head["ready"] or head["idle"]):
            self.store.clear()
            head |= {"ready": False, "idle": True}
        if watermark > last + IDLE_SECONDS and not self.store.waiting():
            self.store.clear()
            self.store.head = None

    def _time_of(self, index: int) -> float:
        row = self.store.take_waiting(index)
        self.store.put_waiting(index, row)
        return row["ts"]

    def deadline(self) -> float | None:
        """When ``pass_time`` has something to do next."""
        head = self.store.head
        if head is None:
            return None
        times = [self._time_of(i) for i in self.store.waiting()]
        if head["completed"] is not None and (head["ready"] or not head["idle"]):
            times.append(head["completed"])
        last = max((x for x in (head["last"], head["completed"]) if x is not None), default=None)
        if last is not None and not self.store.waiting():
            times.append(last + IDLE_SECONDS + 0.001)
        return min(times, default=None)


def restore_all(rows: list[dict]) -> list[tuple]:
    """All rows of a request at once: completions are known from the start, the others come in order of time."""
    session = Session(Memory())
    order = sorted(rows, key=lambda r: (r["chunk_index"] is not None, r["ts"], r["chunk_index"] if r["chunk_index"] is not None else 0))
    out = [x for r in order for x in session.add(r)]
    return out + list(session.pass_time(float("inf")))
