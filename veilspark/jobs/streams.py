"""Queries of streamed chunks in each protocol, of mappings by use, and of requests in all formats; all over whole tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.rules import ALL_VALUES, VALUE_RULES, RuleSet, effective_rules
from ..operators import findings, redaction, requests, responses, vault
from ..sources.scratch import cut
from ..streaming import chunks
from .queries import DELTA, KEY, _SEEDED, _sql_hits, _sql_hmac, _sql_text, deltas, seeded, sql_redacted, table


def _text_json(text: Column) -> Column:
    return F.concat(F.lit('"'), C.json_string_content(text), F.lit('"'))


def _written(*parts: object) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


#: By protocol: the event of a text delta, the last event, where a reader finds the text, and what stands around an event.
PROTOCOLS = {
    "openai": (
        lambda said: _written('{"object":"chat.completion.chunk","choices":[{"index":0,"delta":{"content":', said, "}}]}"),
        '{"object":"chat.completion.chunk","choices":[{"index":0,"delta":{},"finish_reason":"stop"}]}', "choices[0].delta.content", ("data: ", "\n\n"),
    ),
    "openai-response": (
        lambda said: _written('{"type":"response.output_text.delta","output_index":0,"item_id":"m","content_index":0,"delta":', said, "}"),
        '{"type":"response.output_text.done","output_index":0,"item_id":"m","content_index":0,"text":""}', "delta", ("event: e\r\ndata: ", ""),  # without the blank line
    ),
    "claude": (
        lambda said: _written('{"type":"content_block_delta","index":0,"delta":{"type":"text_delta","text":', said, "}}"),
        '{"type":"content_block_stop","index":0}', "delta.text", ("event: content_block_delta\ndata:", "\n\n"),
    ),
    "gemini": (
        lambda said: _written('{"candidates":[{"content":{"parts":[{"text":', said, "}]}}]}"),
        '{"candidates":[{"index":0,"finishReason":"STOP"}]}', "candidates[0].content.parts[0].text", ("", "\n"),  # bare JSON
    ),
}


def _redacted_texts(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(request_id, text) redacted, and the mapping, a row for each document that has made it."""
    done = cut(seeded(spark, sf_dir).select("doc_id", F.col("doc_id").cast("string").alias("request_id"), redaction.redact_text(F.col("text"), ALL_VALUES, KEY).alias("r")))
    return done.select("doc_id", "request_id", "r.text"), done.select(F.explode("r.tokens").alias("token", "original"))


def streamed_texts(spark, sf_dir, kind: str):
    """Redacted documents streamed in one protocol, in deltas that cut tokens, each event cut in two chunks, with clocks that run backward:
    put together by index, the texts come back."""
    event, last, place, (lead, end) = PROTOCOLS[kind]
    texts, mapping = _redacted_texts(spark, sf_dir)
    common = lambda at: [F.timestamp_seconds(F.lit(10_000) - at * 0.001).alias("ts"), F.lit(kind).alias("source_format"), F.lit("text/event-stream").alias("content_type")]
    none = F.lit(None).cast("string")
    init = texts.select("request_id", F.lit(-1).alias("chunk_index"), *common(F.lit(0)), none.alias("body"), F.col("text").alias("request_body"))
    parts = texts.select("request_id", F.posexplode(deltas(F.col("text"))).alias("at", "part"))
    ends = texts.select("request_id", (F.ceil((F.length("text") + 1) / DELTA)).cast("int").alias("at"), F.lit(lead + last + end).alias("event"))
    events = parts.select("request_id", "at", _written(lead, event(_text_json(F.col("part"))), end).alias("event")).unionByName(ends)
    half = F.floor(F.length("event") / 2).cast("int")
    cut_in_two = F.array(F.left("event", half), F.substring("event", half + 1, F.length("event")))
    bodies = events.select("request_id", "at", F.posexplode(cut_in_two).alias("side", "body")).withColumn("chunk_index", F.col("at") * 2 + F.col("side"))
    given = init.unionByName(bodies.select("request_id", "chunk_index", *common(F.col("chunk_index")), "body", none.alias("request_body")))
    out = chunks.restore_chunks(given, given.limit(0).select("request_id", "ts"), mapping, init).filter("chunk_index >= 0")
    # What goes out for a chunk is whole events; a tail may add one before the last.
    data = F.regexp_extract_all("body", F.lit(r"(?m)^(?:data: ?)?(\{.*\})\r?$"), F.lit(1))
    said = F.array_join(F.transform(data, lambda d: F.coalesce(F.get_json_object(d, f"$.{place}"), F.lit(""))), "")
    return chunks.stitch_text(out.select("request_id", "chunk_index", said.alias("text")), "request_id").select("request_id", F.sha2("text", 256).alias("text_sha256"))


def refused_chunks(spark, sf_dir):
    """Events as chunks of their user's stream: the first is the init, the first purchase the completion. What each later one gets."""
    events = table(spark, sf_dir, "events")
    first = events.groupBy("user_id").agg(F.min(F.struct("ts", "event_id")).alias("first"))
    none = F.lit(None).cast("string")
    own = events.join(first, "user_id").select(
        F.col("user_id").cast("string").alias("request_id"), F.when(F.col("event_id") == F.col("first.event_id"), -1).otherwise(F.col("event_id")).cast("int").alias("chunk_index"), "ts",
        F.lit("openai").alias("source_format"), F.lit("text/plain").alias("content_type"), F.col("event_type").alias("body"), none.alias("request_body"),
    )
    done = events.filter("event_type = 'purchase'").select(F.col("user_id").cast("string").alias("request_id"), "ts")
    out = chunks.restore_chunks(own, done, spark.createDataFrame([], "token string, original string"))
    return out.filter("error = 'the request is completed'").groupBy("request_id").agg(F.count("*").alias("refused"))


def compact_vault_by_use(spark, sf_dir):
    """Users' mappings, put by their first event and read by all others: those used last stay."""
    events = table(spark, sf_dir, "events").withColumn("v", F.col("user_id").cast("string"))
    first = events.groupBy("v").agg(F.min("ts").alias("ts"))
    until = F.expr("TIMESTAMP '2999-01-01 00:00:00'")
    token = C.make_token(F.col("v"), KEY).alias("token")
    puts = first.select(token, F.col("v").alias("original"), F.col("ts").alias("put_ts"), until.alias("expires_at"), F.col("ts").alias("used_ts"))
    never = F.lit(None).cast("timestamp")
    reads = events.groupBy("v").agg(F.max("ts").alias("used_ts")).select(token, F.lit(None).cast("string").alias("original"), never.alias("put_ts"), never.alias("expires_at"), "used_ts")
    return vault.compact(vault.dedupe(puts.unionByName(reads)), F.expr("TIMESTAMP '2000-01-01 00:00:00'"), 100).select("token", "original")


def tokens_by_rule(spark, sf_dir):
    """Hits and distinct tokens by rule and source."""
    return findings.count_values(findings.rule_values(seeded(spark, sf_dir), "text", ALL_VALUES, "source"), "source")


def _in_all_formats(spark, sf_dir) -> DataFrame:
    """Each document as a body of every format."""
    said = F.struct(F.lit("user").alias("role"), F.col("text").alias("content"))
    shapes = {
        "openai": F.struct(F.array(said).alias("messages")), "openai-response": F.struct(F.col("text").alias("input")), "claude": F.struct(F.array(said).alias("messages")),
        "gemini": F.struct(F.array(F.struct(F.array(F.struct("text")).alias("parts"))).alias("contents")), "openai-image": F.struct(F.col("text").alias("prompt")), "openai-video": F.struct(F.col("text").alias("prompt")),
    }
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("source_format"), F.to_json(s).alias("body")) for k, s in shapes.items()]))
    return seeded(spark, sf_dir).select("doc_id", each.alias("b")).select(F.col("doc_id").cast("string").alias("doc"), "b.*").withColumn("request_id", F.concat_ws("/", "doc", "source_format"))


def regions_of_all_formats(spark, sf_dir):
    return requests.regions(_in_all_formats(spark, sf_dir)).select("request_id", "path", "kind", F.sha2("text", 256).alias("text_sha256"))


#: What is done to a document's body, in turn: nothing, an unknown format, no format, no object, an object twice, a wrong shape.
_ODD = ["", "unknown format", "unknown format", "has to be one JSON object", "more than one JSON value"]


def rejected_requests(spark, sf_dir):
    """Bodies of unknown formats or of no single object, for every document: each is rejected with its reason, the others pass."""
    own = _in_all_formats(spark, sf_dir).filter("source_format = 'openai'")
    kind = F.col("doc").cast("long") % len(_ODD)
    odd = own.select("request_id", F.when(kind == 1, "openai-chat").when(kind == 2, F.lit(None)).otherwise(F.col("source_format")).alias("source_format"), F.when(kind == 3, F.concat(F.lit("["), "body", F.lit("]"))).when(kind == 4, F.concat("body", "body")).otherwise(F.col("body")).alias("body"))
    done = requests.redact_requests(odd, effective_rules(), KEY)
    return requests.split_results(done)[1].select("request_id", "reason", "path").unionByName(requests.split_results(done)[0].select("request_id", F.lit("passed").alias("reason"), F.lit(None).cast("string").alias("path")))


def whole_reasons(spark, sf_dir):
    """Tool arguments with one to twelve passwords: the whole reason of each request."""
    items = F.transform(F.sequence(F.lit(0), F.col("doc_id") % 12), lambda i: F.struct(F.concat("source", i.cast("string")).alias("Password")))
    call = F.struct(F.struct(F.to_json(F.struct(items.alias("items"))).alias("arguments")).alias("function"))
    given = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("request_id"), F.lit("openai").alias("source_format"), F.to_json(F.struct(F.array(F.struct(F.array(call).alias("tool_calls"))).alias("messages"))).alias("body"))
    return findings.request_reason(requests.findings_of(requests.redact_requests(given, effective_rules(), KEY)))


def restored_answers(spark, sf_dir):
    """JSON answers that quote their own request's redacted text, by turns with brackets and underscores escaped: the texts come back."""
    texts, mapping = _redacted_texts(spark, sf_dir)
    quoted = F.to_json(F.struct(F.col("text").alias("said")))
    escaped = F.replace(F.replace(F.replace(quoted, F.lit("<"), F.lit("\\u003c")), F.lit(">"), F.lit("\\u003E")), F.lit("_"), F.lit("\\u005f"))
    said = texts.select("request_id", F.lit("openai").alias("source_format"), F.lit("application/json").alias("content_type"), F.when(F.col("doc_id") % 2 == 0, quoted).otherwise(escaped).alias("body"))
    sent = texts.select("request_id", F.when(F.col("doc_id") % 3 == 0, escaped).otherwise(F.col("text")).alias("body"))
    back = responses.restore_responses(said, sent, mapping)
    return back.select("request_id", F.sha2(F.get_json_object("body", "$.said"), 256).alias("said_sha256"))


def redact_nested_leaves(spark, sf_dir):
    """The leaves of a table with arrays, structs and maps after its redaction, as rows."""
    docs = table(spark, sf_dir, "documents").filter("text is not null")
    lines = F.split("text", "\n")
    nested = docs.select("doc_id", lines.alias("lines"), F.transform(lines, lambda x: F.struct(F.col("source").alias("session_token"), x.alias("note"))).alias("turns"), F.create_map(F.lit("Password"), F.col("source"), F.lit("note"), F.col("text")).alias("props"))
    done = redaction.redact_columns(nested, RuleSet(effective_rules().fields, ALL_VALUES), KEY)
    leaf = lambda name, place, value: F.struct(F.lit(name).alias("leaf"), place.cast("long").alias("place"), F.sha2(value, 256).alias("value_sha256"))
    zero = F.lit(0)
    leaves = F.concat(
        F.transform("lines", lambda x, i: leaf("line", i, x)), F.transform("turns", lambda x, i: leaf("note", i, x["note"])), F.transform("turns", lambda x, i: leaf("session", i, x["session_token"])),
        F.array(leaf("password", zero, F.col("props")["Password"]), leaf("text", zero, F.col("props")["note"])),
    )
    return done.select("doc_id", F.explode(leaves).alias("x")).select("doc_id", "x.*")


def redact_values(spark, sf_dir):
    """Field rules on numbers, booleans, nulls, objects and lists: tokens of their canonical JSON text."""
    secret = F.struct(F.col("source").alias("b"), F.array("lang", "source").alias("a"), F.col("doc_id").alias("c"))
    fields = F.to_json(F.struct(F.col("doc_id").alias("password"), F.array("doc_id").alias("Token"), secret.alias("secret"), (F.col("doc_id") % 2 == 0).alias("SESSION_KEY"), F.col("source").alias("note")))
    given = F.concat(F.substring(fields, F.lit(1), F.length(fields) - 1), F.lit(',"credentials":null,"api_key":1.50}'))
    done = table(spark, sf_dir, "documents").select("doc_id", requests.redact_json(given, RuleSet(effective_rules().fields, ()), KEY)["body"].alias("body"))
    return done.select("doc_id", *[F.get_json_object("body", f"$.{k}").alias(k.lower()) for k in ("password", "Token", "secret", "SESSION_KEY", "note", "credentials", "api_key")])


#: What is wrong with a document's argument text, in turn.
_FAULTS = ["", "incomplete JSON", "more than one JSON value", "invalid JSON at byte 5", "incomplete JSON"]


def json_errors(spark, sf_dir):
    """Why argument texts made of documents are no JSON: places, never content."""
    kind, whole = F.col("doc_id") % len(_FAULTS), F.to_json(F.struct(F.col("text").alias("é")))
    text = F.when(kind == 1, F.left(whole, F.length(whole) - 1)).when(kind == 2, F.concat(whole, F.lit(" "), whole)).when(kind == 3, F.concat(F.lit('{"é'), F.lit("\n"), "text", F.lit('"}'))).when(kind == 4, F.lit('{"a":')).otherwise(whole)
    return table(spark, sf_dir, "documents").filter("text is not null").select("doc_id", F.coalesce(requests.json_error(text), F.lit("")).alias("error"))


def _sent_and_said(spark, sf_dir, body, content_type: str) -> DataFrame:
    """Answers (``body`` of the redacted text) restored against the request that carried the text."""
    texts, mapping = _redacted_texts(spark, sf_dir)
    said = texts.select("request_id", F.lit("openai").alias("source_format"), F.lit(content_type).alias("content_type"), body.alias("body"))
    return responses.restore_responses(said, texts.select("request_id", F.col("text").alias("body")), mapping)


def restored_arguments(spark, sf_dir):
    """Tool calls whose arguments hold the redacted text, in a key and in a value: inner escapes stay valid."""
    inner = F.concat(F.lit('{"k":'), F.to_json(F.struct(F.col("text").alias("q"))), F.lit("}"))
    call = F.struct(F.struct(inner.alias("arguments")).alias("function"))
    body = F.to_json(F.struct(F.array(F.struct(F.struct(F.array(call).alias("tool_calls")).alias("message"))).alias("choices")))
    back = _sent_and_said(spark, sf_dir, body, "application/json")
    arguments = F.get_json_object("body", "$.choices[0].message.tool_calls[0].function.arguments")
    return back.select("request_id", F.sha2(F.get_json_object(arguments, "$.k.q"), 256).alias("text_sha256"))


def restored_event_streams(spark, sf_dir):
    """Whole event streams of one JSON event and the sentinel."""
    body = F.concat(F.lit("event: a\r\ndata: "), F.to_json(F.struct(F.col("text").alias("q"))), F.lit("\r\n\r\ndata: [DONE]\r\n\r\n"))
    back = _sent_and_said(spark, sf_dir, body, "text/event-stream; charset=utf-8")
    event = F.regexp_extract("body", r"\Aevent: a\r\ndata: (.*)\r\n\r\ndata: \[DONE\]\r\n\r\n\z", 1)
    return back.select("request_id", F.sha2(F.get_json_object(event, "$.q"), 256).alias("text_sha256"))


def streamed_arguments(spark, sf_dir):
    """Redacted documents as tool arguments that come in fragments: put together they are JSON with the texts."""
    texts, mapping = _redacted_texts(spark, sf_dir)
    none = F.lit(None).cast("string")
    common = [F.timestamp_seconds(F.lit(10_000)).alias("ts"), F.lit("openai").alias("source_format"), F.lit("text/event-stream").alias("content_type")]
    init = texts.select("request_id", F.lit(-1).alias("chunk_index"), *common, none.alias("body"), F.col("text").alias("request_body"))
    inner = texts.select("request_id", F.to_json(F.struct(F.col("text").alias("q"))).alias("a"))
    parts = inner.select("request_id", F.posexplode(deltas(F.col("a"))).alias("chunk_index", "part"))
    event = _written('data: {"object":"chat.completion.chunk","choices":[{"index":0,"delta":{"tool_calls":[{"index":0,"function":{"arguments":', _text_json(F.col("part")), "}}]}}]}\n\n")
    ends = inner.select("request_id", F.ceil((F.length("a") + 1) / DELTA).cast("int").alias("chunk_index"), *common, F.lit("data: [DONE]\n\n").alias("body"), none.alias("request_body"))
    given = init.unionByName(parts.select("request_id", "chunk_index", *common, event.alias("body"), none.alias("request_body"))).unionByName(ends)
    out = chunks.restore_chunks(given, given.limit(0).select("request_id", "ts"), mapping, init).filter("chunk_index >= 0")
    data = F.regexp_extract_all("body", F.lit(r"(?m)^data: (\{.*\})$"), F.lit(1))
    said = F.array_join(F.transform(data, lambda d: F.coalesce(F.get_json_object(d, "$.choices[0].delta.tool_calls[0].function.arguments"), F.lit(""))), "")
    whole = chunks.stitch_text(out.select("request_id", "chunk_index", said.alias("text")), "request_id")
    return whole.select("request_id", F.sha2(F.get_json_object("text", "$.q"), 256).alias("text_sha256"))


QUERIES = {f"streamed_texts_{k.replace('-', '_')}": partial(streamed_texts, kind=k) for k in PROTOCOLS}
QUERIES |= {f.__name__: f for f in (refused_chunks, compact_vault_by_use, tokens_by_rule, regions_of_all_formats, rejected_requests, whole_reasons, restored_answers, redact_nested_leaves, redact_values, json_errors, restored_arguments, restored_event_streams, streamed_arguments)}
_ID = "CAST(doc_id AS VARCHAR) AS request_id"
_PATHS = {"openai": "messages[0].content", "openai-response": "input", "claude": "messages[0].content", "gemini": "contents[0].parts[0].text", "openai-image": "prompt", "openai-video": "prompt"}
_LINES = "(SELECT doc_id, unnest(range(len(x))) AS place, unnest(x) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE text IS NOT NULL))"
_REASON = "password (field) at messages[0].tool_calls[0].function.arguments.*['||i||'].* field \"Password\": \"\\\"Password\\\": \\\"[REDACTED]\\\"\""
SQL = {f"streamed_texts_{k.replace('-', '_')}": f"SELECT {_ID}, sha256(text) AS text_sha256 FROM {_SEEDED}" for k in PROTOCOLS}
SQL |= {k: f"SELECT {_ID}, sha256(text) AS text_sha256 FROM {_SEEDED}" for k in ("restored_arguments", "restored_event_streams", "streamed_arguments")}
SQL |= {
    "redact_values": f"""SELECT doc_id, {_sql_hmac('CAST(doc_id AS VARCHAR)')} AS password, {_sql_hmac("'[' || doc_id || ']'")} AS token, {_sql_hmac("'{\"a\":[\"' || lang || '\",\"' || source || '\"],\"b\":\"' || source || '\",\"c\":' || doc_id || '}'")} AS secret,
{_sql_hmac("CASE WHEN doc_id % 2 = 0 THEN 'true' ELSE 'false' END")} AS session_key, source AS note, {_sql_hmac("'null'")} AS credentials, {_sql_hmac("'1.50'")} AS api_key FROM documents""",
    "json_errors": f"SELECT doc_id, [{', '.join(map(_sql_text, _FAULTS))}][doc_id % {len(_FAULTS)} + 1] AS error FROM documents WHERE text IS NOT NULL",
    "refused_chunks": """WITH f AS (SELECT user_id, min((ts, event_id)) AS x, min(ts) FILTER (event_type = 'purchase') AS d FROM events GROUP BY user_id)
SELECT CAST(e.user_id AS VARCHAR) AS request_id, count(*) AS refused FROM events e JOIN f USING (user_id) WHERE ts > d GROUP BY e.user_id""",
    "compact_vault_by_use": f"SELECT {_sql_hmac('original')} AS token, original FROM (SELECT CAST(user_id AS VARCHAR) AS original, max(ts) AS used FROM events GROUP BY user_id) ORDER BY used DESC, token LIMIT 100",
    "tokens_by_rule": "SELECT rule, source, count(*) AS hits, count(DISTINCT x) AS n_tokens FROM (" + " UNION ALL ".join(f"SELECT source, '{n}' AS rule, unnest({_sql_hits('text', p, v)}) AS x FROM {_SEEDED}" for n, p, v, _ in VALUE_RULES) + ") GROUP BY rule, source",
    "regions_of_all_formats": " UNION ALL ".join(f"SELECT doc_id || '/{k}' AS request_id, '{p}' AS path, 'text' AS kind, sha256(text) AS text_sha256 FROM {_SEEDED}" for k, p in _PATHS.items()),
    "rejected_requests": f"SELECT doc_id || '/openai' AS request_id, [{', '.join(_sql_text(r or 'passed') for r in _ODD)}][doc_id % {len(_ODD)} + 1] AS reason, CASE WHEN doc_id % {len(_ODD)} > 0 THEN '' END AS path FROM documents",
    "whole_reasons": f"""SELECT {_ID}, (SELECT string_agg('{_REASON}', '; ' ORDER BY i) FROM range(least(doc_id % 12 + 1, 8)) AS t(i)) || CASE WHEN doc_id % 12 + 1 > 8 THEN '; ... and ' || (doc_id % 12 + 1 - 8) || ' more' ELSE '' END AS reason FROM documents""",
    "restored_answers": f"SELECT {_ID}, sha256(text) AS said_sha256 FROM {_SEEDED}",
    "redact_nested_leaves": f"""WITH {sql_redacted(_LINES, 'doc_id, place', VALUE_RULES)}, whole AS (WITH {sql_redacted('documents', 'doc_id', VALUE_RULES)} SELECT * FROM redacted)
SELECT doc_id, leaf, place, sha256(v) AS value_sha256 FROM (SELECT doc_id, 'line' AS leaf, place, text AS v FROM redacted UNION ALL SELECT doc_id, 'note', place, text FROM redacted
UNION ALL SELECT doc_id, 'session', place, {_sql_hmac('source')} FROM redacted JOIN documents USING (doc_id) UNION ALL SELECT doc_id, 'password', 0, {_sql_hmac('source')} FROM documents WHERE text IS NOT NULL UNION ALL SELECT doc_id, 'text', 0, text FROM whole)""",
}
