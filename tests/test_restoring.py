import json
import random
import time

import pytest
from pyspark.sql import functions as F

from veilspark.functions.restoring import Arguments, Restorer, held, labels_of
from veilspark.functions.streams import Memory, Session, Stream, restore_all
from veilspark.functions.scan import TextRedactor
from veilspark.operators import responses
from veilspark.streaming import chunks as C

make = TextRedactor((), b"k", "REDACTED").make
ODD = 'a"b\\c\nd <x> é'
T, U, N = make(ODD), make("plain"), make("nested")
KNOWN = {T: ODD, U: "plain", N: f"has {U} inside"}
WORK = Restorer(KNOWN)


def escaped(token):
    return token.replace("<", "\\u003c").replace(">", "\\u003E")


def test_json_values_and_arguments():
    body = json.dumps({"a": f"x {T}", U: [N, 1.50], "n": 1}) + "\n"
    assert json.loads(WORK.body(body, "json")) == {"a": f"x {ODD}", U: [KNOWN[N], 1.5], "n": 1}
    assert WORK.body('{"a": 1.50,  "b": "z"}', "json") == '{"a": 1.50,  "b": "z"}'
    assert WORK.body(f'{{"a": "{escaped(T)}"', "json") == f'{{"a": "{escaped(T)}"'
    for said in (json.dumps({"k": T, U: [T]}), f'{{"k":"{escaped(T)}","{U}":["{T}"]}}'):
        for kind, whole in (("openai", {"choices": [{"message": {"content": T, "tool_calls": [{"function": {"arguments": said}}]}}]}), ("openai-response", {"output": [{"type": "function_call", "arguments": said}, {"type": "x", "t": T}]})):
            out = json.loads(WORK.body(json.dumps(whole), "json", kind))
            inner = (out["choices"][0]["message"]["tool_calls"][0]["function"] if kind == "openai" else out["output"][0])["arguments"]
            assert json.loads(inner) == {"k": ODD, "plain": [ODD]}
    broken = {"choices": [{"message": {"tool_calls": [{"function": {"arguments": f"{{bad {T}"}}]}}]}
    assert WORK.body(json.dumps(broken), "json", "openai") == json.dumps(broken)
    assert WORK.arguments(f'{{"a":"\\\\u003c{T[1:-1]}\\\\u003e"}}') == f'{{"a":"\\\\u003c{T[1:-1]}\\\\u003e"}}'


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_event_streams_keep_their_lines(end):
    body = f"event: x{end}data: {json.dumps({'t': T})}{end}{end}: note {T}{end}data:{U} end{end}data: {{bad {T}{end}{end}"
    want = f"event: x{end}data: {json.dumps({'t': ODD}, ensure_ascii=False, separators=(',', ':'))}{end}{end}: note {T}{end}data:plain end{end}data: {{bad {T}{end}{end}"
    assert WORK.body(body, "sse") == want == WORK.body(body, "unknown")
    assert WORK.body(f"{{bad {T}", "unknown") == f"{{bad {T}" and WORK.body(f"x {N}", "other") == f"x has {U} inside" == WORK.body(f"x {N}", "unknown")


def test_responses_meet_their_own_requests(spark):
    vault = spark.createDataFrame([(t, o, 10.0) for t, o in KNOWN.items()], "token string, original string, e double").select("token", "original", F.col("e").cast("timestamp").alias("expires_at"))
    asked = [("1", f"has {T} and {U}"), ("2", json.dumps({"q": U}).replace("<", "\\u003c").replace(">", "\\u003e")), ("3", f"has {U}")]
    said = [("1", 5.0, "openai", "application/json", json.dumps({"t": T + N})), ("2", 5.0, "claude", "text/plain", f"{U} {T}"), ("3", 50.0, "gemini", None, U), ("4", 5.0, "openai", "text/event-stream", f"data: {U}\n\n"), ("5", 5.0, None, None, None)]
    requests = spark.createDataFrame(asked, "request_id string, body string")
    given = spark.createDataFrame(said, "request_id string, at double, source_format string, content_type string, body string").withColumn("ts", F.col("at").cast("timestamp")).drop("at")
    out = {r.request_id: r.body for r in responses.restore_responses(given, requests, vault).collect()}
    assert json.loads(out["1"]) == {"t": ODD + N} and out["2"] == f"plain {T}" and out["3"] == U and out["4"] == f"data: {U}\n\n" and out["5"] is None
    left = {(r.request_id, r.token) for r in responses.unrestored_tokens(given, requests, vault).collect()}
    assert left == {("1", N), ("2", T), ("4", U)}
    labels = spark.createDataFrame([([T, "<A_b_0123456789abcdef>", U],)], "t array<string>").select(responses.token_labels(F.col("t"))).first()[0]
    assert labels == ["A_b", "REDACTED"]


def test_arguments_at_every_cut():
    hold = held(labels_of(KNOWN), True)
    for said in (f'{{"k":"x {T} \\\\","z":"{U}"}}', f'{{"k":"\\"{escaped(T)}","u":"\\\\u003cREDACTED","z":"\\u003"}}'):
        want = Arguments().restore(said, KNOWN)
        for i in range(len(said) + 1):
            a = Arguments()
            got = a.add(said[:i], KNOWN, hold) + a.add(said[i:], KNOWN, hold) + a.add("", KNOWN, hold, True)
            assert got == want, i
        a = Arguments()
        assert "".join(a.add(c, KNOWN, hold) for c in said) + a.add("", KNOWN, hold, True) == want
    a = Arguments()
    assert a.add(f'{{"k":"line\nbreak {T}', KNOWN, hold, True) == f'{{"k":"line\nbreak {T}'


def sse(doc, name=""):
    return (f"event: {name}\n" if name else "") + f"data: {json.dumps(doc)}\n\n"


def deltas(kind, pieces):
    """A protocol's stream of text deltas in one channel and arguments in another, and its end."""
    args = ['{"q":"', *pieces, '"}']
    if kind == "openai":
        say = lambda d, f=None: sse({"object": "chat.completion.chunk", "choices": [{"index": 0, "delta": d, "finish_reason": f}]})
        return [say({"content": p}) for p in pieces] + [say({"tool_calls": [{"index": 0, "function": {"arguments": p}}]}) for p in args] + [say({}, "stop"), "data: [DONE]\n\n"]
    if kind == "claude":
        say = lambda i, d: sse({"type": "content_block_delta", "index": i, "delta": d}, "content_block_delta")
        out = [say(0, {"type": "text_delta", "text": p}) for p in pieces] + [sse({"type": "content_block_stop", "index": 0}, "content_block_stop")]
        return out + [say(1, {"type": "input_json_delta", "partial_json": p}) for p in args] + [sse({"type": "content_block_stop", "index": 1}), sse({"type": "message_stop"})]
    if kind == "openai-response":
        say = lambda t, d: sse({"type": f"{t}.delta", "output_index": 0, "item_id": "i", "content_index": 0, "delta": d}, f"{t}.delta")
        end = lambda t, **d: sse({"type": f"{t}.done", "output_index": 0, "item_id": "i", "content_index": 0, **d}, f"{t}.done")
        t, f = "response.output_text", "response.function_call_arguments"
        return [say(t, p) for p in pieces] + [end(t, text="".join(pieces))] + [say(f, p) for p in args] + [end(f, arguments="".join(args)), sse({"type": "response.completed", "response": {"output": [{"type": "function_call", "arguments": "".join(args)}]}})]
    return [sse({"candidates": [{"index": 0, "content": {"parts": [{"text": p}]}}]}) for p in pieces] + [sse({"candidates": [{"index": 0, "finishReason": "STOP"}]})]


def read(kind, body):
    """(text, arguments) that a client puts together from a stream."""
    text = args = ""
    for line in body.split("\n"):
        if line.startswith("data: {"):
            d = json.loads(line[6:])
            if kind == "openai":
                delta = d["choices"][0]["delta"]
                text += delta.get("content") or ""
                args += "".join(c["function"]["arguments"] for c in delta.get("tool_calls") or [])
            elif kind == "claude":
                text += d.get("delta", {}).get("text", "")
                args += d.get("delta", {}).get("partial_json", "")
            elif kind == "openai-response":
                if d["type"] == "response.output_text.delta":
                    text += d["delta"]
                elif d["type"] == "response.function_call_arguments.delta":
                    args += d["delta"]
            else:
                text += "".join(p["text"] for p in d["candidates"][0].get("content", {}).get("parts", []))
    return text, args


class Begun:
    """A stream whose init has come."""

    def __init__(self, known, kind):
        self.store = Memory()
        assert not list(Session(self.store).add({"chunk_index": -1, "ts": 0.0, "originals": known, "source_format": kind, "route": None, "body": None}))

    def chunk(self, body, route, now):
        return Stream(self.store, now).chunk(body, route)

    def held(self):
        return "".join(self.store._pieces)


KINDS = ["openai", "claude", "openai-response", "gemini"]
FULL = {t: [o, None] for t, o in KNOWN.items()}


@pytest.mark.parametrize("kind", KINDS)
def test_tokens_at_every_cut(kind):
    said = f"a {U} b {T}"
    for i in range(len(said) + 1):
        stream = Begun(FULL, kind)
        out = "".join(stream.chunk(e, "sse", 1.0) for e in deltas(kind, [said[:i], said[i:]]))
        text, args = read(kind, out)
        assert text == f"a plain b {ODD}", i
        if kind != "gemini":
            assert json.loads(args) == {"q": f"a plain b {ODD}"}
        assert not stream.store.channels() and not stream.held() and stream.store.head["channels"] == 0
        if kind == "openai-response":
            assert '"text":' + json.dumps(f"a plain b {ODD}", ensure_ascii=False) in out


@pytest.mark.parametrize("kind", KINDS)
def test_half_a_token_at_the_end_is_delivered(kind):
    stream = Begun(FULL, kind)
    out = "".join(stream.chunk(e, "sse", 1.0) for e in deltas(kind, ["x ", T[:15]]))
    assert read(kind, out)[0] == "x " + T[:15]


@pytest.mark.parametrize("kind", KINDS)
def test_bytes_at_any_cut_give_the_same(kind):
    whole = "".join(deltas(kind, ["one ", U[:7], U[7:], f" {T}"]))
    r = random.Random(1)
    want = None
    for _ in range(60):
        cuts = sorted(r.sample(range(len(whole)), r.randint(0, 12)))
        stream = Begun(FULL, kind)
        got = "".join(stream.chunk(whole[a:b], "sse", 1.0) for a, b in zip([0, *cuts], [*cuts, len(whole)], strict=True))
        want = want or got
        assert got == want and read(kind, got)[0] == f"one plain {ODD}"


def test_plain_streams_lines_and_limits(monkeypatch):
    said = f"x {U} y {T[:5]}"
    for i in range(len(said)):
        s = Begun(FULL, "openai")
        assert s.chunk(said[:i], "other", 1.0) + s.chunk(said[i:], "other", 1.0) == "x plain y " and s.held() == T[:5]
    s = Begun(FULL, "claude")
    lines = ["event: content_block_delta", "data: " + json.dumps({"type": "content_block_delta", "index": 0, "delta": {"type": "text_delta", "text": U}}), "id: 5\n\n"]
    assert '"text":"plain"' in "".join(s.chunk(x, "sse", 1.0) for x in lines)
    monkeypatch.setattr("veilspark.functions.streams.MAX_CARRY", 100)
    s = Begun(FULL, "openai")
    big = "data: {" + "x" * 200
    assert s.chunk(big, "sse", 1.0) == big
    assert Begun({}, "openai").chunk(U, "other", 1.0) == U
    late = Begun({U: ["plain", 5.0]}, "openai")
    assert late.chunk(U, "other", 4.0) == "plain" and late.chunk(U, "other", 6.0) == U
    thought = sse({"candidates": [{"index": 0, "content": {"parts": [{"text": U, "thought": True}, {"text": U}]}}]})
    out = Begun(FULL, "gemini").chunk(thought, "sse", 1.0)
    assert [p["text"] for p in json.loads(out[6:])["candidates"][0]["content"]["parts"]] == [U, "plain"]
    opaque = "data: {bad " + U + "\n\n"
    assert Begun(FULL, "openai").chunk(opaque, "sse", 1.0) == opaque


def init(ts, known=None, kind="openai"):
    return {"chunk_index": -1, "ts": ts, "originals": FULL if known is None else known, "source_format": kind, "route": None, "body": None}


def part(i, ts, body, route="other"):
    return {"chunk_index": i, "ts": ts, "originals": {}, "source_format": None, "route": route, "body": body}


def completion(ts):
    return {"chunk_index": None, "ts": ts}


def test_life_of_a_stream():
    session = Session(Memory())
    rows = [init(1.0), part(0, 2.0, U[:5]), init(2.5), part(0, 2.6, U), part(1, 2.7, U[:4]), completion(3.0), completion(3.5), part(2, 4.0, "x"), init(5.0)]
    out = [x for r in rows for x in session.add(r)]
    assert [(i, b, d, bool(e)) for i, b, d, e in out] == [(0, "", True, False), (0, "plain", False, False), (1, "", True, False), (2, None, False, True), (-1, None, False, True)]
    assert not list(session.pass_time(2.9)) and session.store.channels() == [] and session.store._originals
    assert not list(session.pass_time(3.1)) and not session.store._originals
    assert next(session.add(part(3, 4.0, "x")))[3] == "the request is completed"
    assert not list(session.pass_time(400.0)) and session.store.head is None
    assert [x for r in (init(400.0), part(0, 401.0, U)) for x in session.add(r)] == [(0, "plain", False, None)]
    assert restore_all([init(0.0), part(0, 301.0, U), part(1, 302.0, U)]) == [(0, None, False, "the request has no init"), (1, None, False, "the request has no init")]
    assert restore_all([part(0, 0.0, U)]) == [(0, None, False, "the request has no init")]
    assert [e for *_, e in restore_all([init(0.0), part(-5, 1.0, ""), part(0, 1.0, "a"), part(0, 2.0, "a")])] == ["no such chunk index", None, "the chunk has come before, or too late"]


def test_order_is_the_index_not_the_clock():
    """Chunks in any order and with any clocks give what the right order gives."""
    said = f"a {U} b {T}"
    pieces = [said[i : i + 7] for i in range(0, len(said), 7)]
    want = restore_all([init(0.0), *(part(i, 1.0, p) for i, p in enumerate(pieces))])
    r = random.Random(5)
    for _ in range(50):
        rows = [init(20.0), *(part(i, r.uniform(0, 60), p) for i, p in enumerate(pieces))]
        r.shuffle(rows)
        session = Session(Memory())
        got = [x for row in rows for x in session.add(row)] + list(session.pass_time(float("inf")))
        assert got == want == restore_all(rows)
    # A gap is given up once the watermark has passed what waits behind it.
    session = Session(Memory())
    assert not [x for row in (init(0.0), part(1, 5.0, "b"), part(3, 9.0, "d")) for x in session.add(row)]
    assert session.deadline() == 5.0 and not list(session.pass_time(4.0))
    assert [x[:2] for x in session.pass_time(6.0)] == [(1, "b")]
    assert [x[3] for x in session.add(part(0, 6.5, "a"))] == ["the chunk has come before, or too late"]
    assert [x[:2] for x in session.add(part(2, 7.0, "c"))] == [(2, "c"), (3, "d")]


ODD_EVENTS = [
    ("openai", {"object": "chat.completion.chunk", "choices": ["x"]}), ("openai", {"object": "chat.completion.chunk", "choices": 5}), ("openai", {"object": "chat.completion.chunk"}),
    ("openai", {"object": "chat.completion.chunk", "choices": [{"index": 0, "delta": {"tool_calls": ["x"], "content": T}}]}),
    ("openai", {"object": "chat.completion.chunk", "choices": [{"index": 0, "delta": {"content": T}}, {"delta": {"content": T}}]}),
    ("openai", {"object": "chat.completion.chunk", "choices": [{"index": -1, "delta": {"content": T}}]}),
    ("openai", {"object": "chat.completion.chunk", "choices": [{"index": 0, "delta": {"content": T}, "finish_reason": 1}]}),
    ("openai-response", {"type": "response.output_text.delta", "item_id": "m", "output_index": -1, "content_index": 0, "delta": T}),
    ("openai-response", {"type": "response.output_text.delta", "item_id": 5, "output_index": 0, "content_index": 0, "delta": T}),
    ("openai-response", {"type": "response.output_text.done", "output_index": 0, "content_index": 0, "text": [T]}),
    ("openai-response", {"type": "response.function_call_arguments.delta", "output_index": 0, "item_id": "", "delta": T}),
    ("openai-response", {"type": "response.output_item.done", "item": [T]}),
    ("openai-response", {"type": "response.output_item.done", "output_index": 0, "item": {"type": "function_call", "arguments": T}}),
    ("claude", {"type": "content_block_delta", "index": -1, "delta": {"type": "text_delta", "text": T}}), ("claude", {"type": "content_block_delta", "index": 0, "delta": T}),
    ("claude", {"type": "content_block_delta", "index": 0, "delta": {"type": "input_json_delta", "partial_json": {"x": T}}}), ("claude", {"type": "content_block_stop", "x": T}),
    ("gemini", {"candidates": ["x"], "t": T}), ("gemini", {"candidates": T}), ("gemini", {"candidates": [{"index": "1", "content": {"parts": [{"text": T}]}}]}),
    ("gemini", {"candidates": [{"content": {"parts": [{"text": 5}, {"text": T}]}}]}), ("gemini", {"candidates": [{"content": {"parts": [{"text": T, "thought": 1}]}}]}),
]


@pytest.mark.parametrize("kind,doc", ODD_EVENTS)
def test_odd_events_stay_byte_for_byte(kind, doc):
    """Known kinds of events with members of other types are no plan: bytes and what is held stay as they are."""
    s = Begun(FULL, kind)
    first = deltas(kind, [T[:9], ""])[0]
    before = s.chunk(first, "sse", 1.0)
    held_before = {c: s.store.channel(c) for c in s.store.channels()}
    assert T[:9] not in before and len(held_before) == 1
    event = "data:  " + json.dumps(doc) + "\r\nid: 7\r\n\r\n"
    assert s.chunk(event, "sse", 1.0) == event
    assert {c: s.store.channel(c) for c in s.store.channels()} == held_before
    more = "".join(s.chunk(e, "sse", 1.0) for e in deltas(kind, ["", T[9:]])[1:])
    assert ODD in read(kind, more)[0]


@pytest.mark.parametrize("kind,doc", [("openai", {"object": "x", "text": T}), ("openai-response", {"type": "response.custom", "text": T}), ("claude", {"type": "custom", "text": T}), ("gemini", {"result": {"text": T}}), ("?", {"text": T})])
def test_unknown_events_are_restored(kind, doc):
    out = Begun(FULL, kind).chunk(sse(doc), "sse", 1.0)
    assert json.dumps(ODD, ensure_ascii=False) in out and T not in out


def test_deep_nesting_goes_out_as_it_came():
    deep = '{"a":' * 1500 + f'"{T}"' + "}" * 1500
    assert WORK.body(deep, "json") == deep
    event = f"data: {deep}\n\n"
    out = restore_all([init(0.0), part(0, 1.0, event, "sse"), part(1, 1.0, sse({"x": U}), "sse")])
    assert [x[1] for x in out] == [event, 'data: {"x":"plain"}\n\n']


@pytest.mark.parametrize("kind", ["openai", "gemini"])
def test_bare_json_under_an_event_stream(kind):
    """Objects without event lines: whole, one behind the other, in an array, and cut anywhere."""
    docs = [json.loads(e[6:]) for e in deltas(kind, [f'q"{{ {U[:6]}', U[6:] + " }", f" {T}"]) if e.startswith("data: {")]
    for between, around in (("", ("", "")), ("\n", ("", "\n")), (",\r\n", ("[", "]\n"))):
        whole = around[0] + between.join(json.dumps(d) for d in docs) + around[1]
        for seed in range(40):
            r = random.Random(seed)
            cuts = sorted(r.sample(range(len(whole)), r.randint(0, 9)))
            s = Begun(FULL, kind)
            out = "".join(s.chunk(whole[a:b], "sse", 1.0) for a, b in zip([0, *cuts], [*cuts, len(whole)], strict=True))
            assert not s.held()
            body = out.removeprefix(around[0]).removesuffix(around[1])
            decoder, got, at = json.JSONDecoder(), [], 0
            while at < len(body):
                doc, at = decoder.raw_decode(body, at)
                got.append(doc)
                at += len(between)
            assert read(kind, "".join(sse(d) for d in got))[0] == f'q"{{ plain }} {ODD}'


def test_nothing_is_swallowed():
    s = Begun(FULL, "openai")
    assert s.chunk("plain text", "sse", 1.0) + s.chunk(" and more\n", "sse", 1.0) + s.chunk("\n\n", "sse", 1.0) == "plain text and more\n\n\n"
    assert s.chunk(": comment\n\n", "sse", 1.0) == ": comment\n\n"
    assert s.chunk("da", "sse", 1.0) == "" and s.chunk("y\n", "sse", 1.0) == "day\n"
    r = Begun(FULL, "openai-response")
    event = deltas("openai-response", [U, ""])[0]
    assert '"delta":"plain"' in r.chunk(event.rstrip("\n"), "sse", 1.0) and not r.held()
    name, data = event.rstrip("\n").split("\n")
    assert r.chunk(name, "sse", 1.0) == "" and '"delta":"plain"' in r.chunk(data, "sse", 1.0)


def test_end_in_the_same_event_keeps_the_order():
    say = lambda d, f=None: sse({"object": "chat.completion.chunk", "choices": [{"index": 3, "delta": d, "finish_reason": f}]})
    call = lambda i, a: {"index": i, "function": {"arguments": a}}
    s = Begun(FULL, "openai")
    one = say({"tool_calls": [call(0, '{"v":"' + T[:9])]}, "tool_calls")
    assert json.loads(s.chunk(one, "sse", 1.0)[6:]) == json.loads(one[6:])
    assert s.chunk(say({"tool_calls": [call(0, '{"p":"' + T[:9])]}), "sse", 1.0).count("data:") == 1
    out = s.chunk(say({"tool_calls": [call(1, '{"f":"' + T[:9]), call(2, '{"s":"' + T[:9])]}, "tool_calls"), "sse", 1.0)
    assert [[(c["index"], c["function"]["arguments"]) for c in json.loads(x[6:])["choices"][0]["delta"]["tool_calls"]] for x in out.split("\n\n") if x] == [[(0, T[:9])], [(1, '{"f":"' + T[:9]), (2, '{"s":"' + T[:9])]]


def test_a_long_event_costs_time_in_proportion():
    """A megabyte in a thousand pieces is looked at once: what is searched doesn't grow with what is held."""
    import veilspark.functions.streams as streams

    for kind, begin in (("openai", "data: " + json.dumps({"x": "y" * 1_000_000})), ("gemini", json.dumps({"candidates": [], "x": "{[" * 500_000}))):
        s, seen = Begun(FULL, kind), []
        search, end = streams._BLANK, streams.json_end

        class Counting:
            def search(self, text):
                seen.append(len(text))
                return search.search(text)

        streams._BLANK, streams.json_end = Counting(), lambda text, *a: seen.append(len(text)) or end(text, *a)
        try:
            step = len(begin) // 1000
            out = "".join(s.chunk(begin[i : i + step], "sse", 1.0) for i in range(0, len(begin), step)) + s.chunk("\n\n", "sse", 1.0)
        finally:
            streams._BLANK, streams.json_end = search, end
        assert len(out) >= len(begin) and sum(seen) < 1.1 * len(begin) + 4000


def tables(spark):
    rows = []
    for i, kind in enumerate(KINDS):
        rows.append((f"r{i}", -1, 1000.0 + i, kind, "text/event-stream", None, json.dumps({"q": f"{T} {U}"})))
        for j, e in enumerate(deltas(kind, [f"a {T}"[:9], f"a {T}"[9:], f" {N}"])):
            rows.append((f"r{i}", j, 1010.0 + j, kind, "text/event-stream; charset=utf-8", e, None))
    given = spark.createDataFrame(rows, "request_id string, chunk_index int, at double, source_format string, content_type string, body string, request_body string")
    given = given.withColumn("ts", F.col("at").cast("timestamp")).drop("at")
    done = spark.createDataFrame([("r0", 1011.5)], "request_id string, at double").select("request_id", F.col("at").cast("timestamp").alias("ts"))
    vault = spark.createDataFrame(list(KNOWN.items()), "token string, original string")
    return given, done, vault


def test_table_and_stream_of_chunks_agree(spark, tmp_path):
    given, done, vault = tables(spark)
    table = C.restore_chunks(given, done, vault)
    own = {(r.request_id, r.chunk_index): (r.body, r.dropped, r.error) for r in table.collect()}
    assert {own["r0", i][2] for i in (2, 3)} == {"the request is completed"}
    for i, kind in list(enumerate(KINDS))[1:]:
        body = "".join(own[k][0] for k in sorted(own) if k[0] == f"r{i}")
        assert read(kind, body)[0] == f"a {ODD} {N}"
    rows = C.events(given, done, C.stream_originals(given, vault))
    got, _ = streamed(spark, tmp_path, [rows])
    assert {(r.request_id, r.chunk_index): (r.body, r.dropped, r.error) for r in got} == own


def streamed(spark, tmp_path, batches):
    """(rows that a stream of these micro-batches gives, state rows behind the last)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    for i, rows in enumerate(batches):
        rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(1.1 if i + 1 < len(batches) else 0)  # files come in order of their time
    given = spark.readStream.schema(batches[0].schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    q = C.restore_chunk_stream(given).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    try:
        assert q.awaitTermination(240)
        return spark.read.parquet(f"{tmp_path}/out").collect(), q.lastProgress["stateOperators"][0]["numRowsTotal"]
    finally:
        q.stop()


def test_shuffled_late_and_idle_rows_of_a_stream(spark, tmp_path):
    """Any order over micro-batches gives the table's rows; a chunk behind five idle minutes is refused; at the end no state is left."""
    given, done, vault = tables(spark)
    done = done.select("request_id", F.timestamp_seconds(F.lit(1030)).alias("ts"))
    late = given.filter("request_id = 'r3' and chunk_index = 0").withColumn("ts", F.timestamp_seconds(F.lit(1500))).withColumn("chunk_index", F.lit(50))
    rows = C.events(given.unionByName(late), done, C.stream_originals(given, vault)).persist()
    early = rows.filter("ts < timestamp_seconds(1100)")
    parts = [early.filter((F.xxhash64("request_id", "chunk_index") % 3 == i) | (F.xxhash64("request_id", "chunk_index") % 3 == -i)) for i in range(3)]
    clock = rows.filter("chunk_index = -1").limit(1).withColumn("request_id", F.lit("clock")).withColumn("originals", F.lit(None).cast("string"))
    tick = lambda s: clock.withColumn("ts", F.timestamp_seconds(F.lit(s)))
    got, left = streamed(spark, tmp_path, [*parts, rows.filter("chunk_index = 50"), tick(3000), tick(9000)])
    want = C.restore_chunks(given.unionByName(late), done, vault).collect()
    assert len({(r.request_id, r.chunk_index) for r in got}) == len(got)
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert {(r.request_id, r.error) for r in got if r.error} == {("r3", "the request has no init")}
    assert left <= 2  # the clock's own head and timer


def test_order_stitching_and_late_rows(spark):
    given, done, _ = tables(spark)
    steps = {(r.request_id, r.chunk_index): r.step for r in C.chunk_order(given.filter("chunk_index <> 1")).collect()}
    assert steps["r0", -1] is None and steps["r0", 0] == 1 and steps["r0", 2] == 2
    text = C.stitch_text(given.filter("chunk_index >= 0"), "request_id", text="body").filter("request_id = 'r3'").first().body
    assert read("gemini", text)[0] == f"a {T} {N}"
    assert {r.chunk_index for r in C.late_rows(given, done).collect()} == {i for i in range(2, 10)}


def test_only_events_where_a_token_may_start_are_read(monkeypatch):
    from veilspark.functions import streams

    seen, token = [], "<REDACTED_0123456789abcdef>"
    monkeypatch.setattr(streams, "read_json", lambda *a, own=streams.read_json: seen.append(a) or own(*a))
    event = lambda said: 'data: {"object":"chat.completion.chunk","choices":[{"index":0,"delta":{"content":"' + said + '"}}]}\n\n'
    said = [event(x) for x in ["a\\n b"] * 40 + ["to \\u003cREDACTED_01", "23456789abcdef>!"] + ["c"] * 40]
    row = lambda i, body, known=None: {"chunk_index": i, "ts": 100.0 - i, "body": body, "route": "sse", "source_format": "openai", "originals": known or {}}
    out = {i: body for i, body, _, error in streams.restore_all([row(-1, None, {token: ["joe", None]}), *[row(i, x) for i, x in enumerate(said)]]) if not error}
    assert [out[i] for i in (*range(40), *range(42, 82))] == said[:40] + said[42:]
    assert '"content":"to "' in out[40] and '"content":"joe!"' in out[41]
    assert len(seen) == 2
