"""Queries of requests, responses, streams and findings. Bodies are made from all documents, with a seed of a rule in each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.rules import FIELD_RULES, VALUE_RULES, RuleSet, effective_rules, rules_named
from ..operators import findings, requests, responses
from ..sources.scratch import cut
from ..streaming import chunks
from .queries import KEY, _SEEDED, _sql_hits, _sql_hmac, _sql_text, deltas, seeded, sql_redacted, table

#: The formats, and the place of the text in the bodies made here.
PLACES = [("openai", "messages[0].content"), ("openai-response", "input"), ("claude", "messages[0].content"), ("gemini", "contents[0].parts[0].text"), ("openai-image", "prompt"), ("openai-video", "prompt")]
ON = [r for r in VALUE_RULES if r[3]]


def bodies(spark, sf_dir) -> DataFrame:
    """(doc_id, request_id, source_format, body): each document as a request of one of the six formats."""
    said = F.struct(F.lit("user").alias("role"), F.col("text").alias("content"))
    by_kind = {
        "openai": F.struct(F.lit("m").alias("model"), F.array(said).alias("messages")), "openai-response": F.struct(F.col("text").alias("input")), "claude": F.struct(F.array(said).alias("messages")),
        "gemini": F.struct(F.array(F.struct(F.array(F.struct("text")).alias("parts"))).alias("contents")), "openai-image": F.struct(F.col("text").alias("prompt")), "openai-video": F.struct(F.col("text").alias("prompt")),
    }
    body = F.lit(None).cast("string")
    for kind, shape in by_kind.items():
        body = F.when(F.col("source_format") == kind, F.to_json(shape)).otherwise(body)
    kind = F.element_at(F.array(*[F.lit(k) for k, _ in PLACES]), (F.col("doc_id") % len(PLACES) + 1).cast("int"))
    return seeded(spark, sf_dir).select("doc_id", "text", F.col("doc_id").cast("string").alias("request_id"), kind.alias("source_format")).withColumn("body", body)


def _done(spark, sf_dir, mode: str = "filter") -> DataFrame:
    return requests.redact_requests(bodies(spark, sf_dir), effective_rules(), KEY, mode=mode)


def request_formats(spark, sf_dir):
    """The text of each redacted body, and the rules that fired."""
    text = F.lit(None).cast("string")
    for kind, place in PLACES:
        text = F.when(F.col("source_format") == kind, F.get_json_object("result.body", f"$.{place}")).otherwise(text)
    return _done(spark, sf_dir).select("request_id", "source_format", F.sha2(text, 256).alias("text_sha256"), F.array_join("result.rules", ",").alias("rules"), F.size("result.tokens").cast("long").alias("n_tokens"))


def redact_again(spark, sf_dir):
    """A second pass with the mapping table of the first: nothing fires, and bodies come back byte for byte."""
    first = cut(_done(spark, sf_dir).select("request_id", "source_format", "result.body", "result.tokens"))
    known = first.select(F.explode("tokens").alias("token", "original")).select("token").distinct()
    again = requests.redact_requests(first.drop("tokens"), effective_rules(), KEY, vault=known)
    return again.select("request_id", F.size("result.findings").cast("long").alias("n_findings"), F.sha2("result.body", 256).alias("again_sha256"), F.sha2("body", 256).alias("body_sha256")).withColumn("same", F.col("again_sha256") == F.col("body_sha256")).select("request_id", "n_findings", "same")


def _regions(spark, sf_dir, *kinds: str) -> DataFrame:
    return requests.regions(bodies(spark, sf_dir).filter(F.col("source_format").isin(*kinds))).select("request_id", "path", "kind", F.sha2("text", 256).alias("text_sha256"))


def regions_openai(spark, sf_dir):
    return _regions(spark, sf_dir, "openai")


def regions_responses(spark, sf_dir):
    return _regions(spark, sf_dir, "openai-response")


def regions_claude(spark, sf_dir):
    return _regions(spark, sf_dir, "claude")


def regions_gemini(spark, sf_dir):
    return _regions(spark, sf_dir, "gemini")


def regions_prompt(spark, sf_dir):
    return requests.prompt_regions(bodies(spark, sf_dir)).select("request_id", "path", F.lit("text").alias("kind"), F.sha2("text", 256).alias("text_sha256"))


def request_findings(spark, sf_dir):
    """The findings table."""
    return requests.findings_of(_done(spark, sf_dir)).select("request_id", F.col("seq").cast("long").alias("seq"), "rule", "rule_type", "path", F.array_join(F.coalesce("fields", F.array().cast("array<string>")), ",").alias("fields"), "read_only")


def findings_report(spark, sf_dir):
    """Findings by rule, with the paths first seen."""
    return findings.report(requests.findings_of(_done(spark, sf_dir)).withColumn("request_id", F.lpad("request_id", 12, "0"))).select("rule", "rule_type", "hits", F.array_join("paths", ",").alias("paths"), "omitted_paths")


def request_reasons(spark, sf_dir):
    """How many findings each request's reason names."""
    found = requests.findings_of(_done(spark, sf_dir))
    return findings.request_reason(found).select("request_id", F.regexp_extract("reason", r"\A([^:]*): ", 1).alias("first"))


def block_requests(spark, sf_dir):
    """Block mode: what is rejected, and where."""
    return requests.split_results(_done(spark, sf_dir, "block"), "block")[1].select("request_id", "source_format", "reason", "path")


def malformed_arguments(spark, sf_dir):
    """Documents as broken tool arguments: what value rules find there is read-only and stays."""
    call = F.struct(F.struct(F.concat(F.lit("{"), "text").alias("arguments")).alias("function"))
    body = F.to_json(F.struct(F.array(F.struct(F.array(call).alias("tool_calls"))).alias("messages")))
    given = seeded(spark, sf_dir).select(F.col("doc_id").cast("string").alias("request_id"), F.lit("openai").alias("source_format"), body.alias("body"))
    done = requests.redact_requests(given, effective_rules(), KEY)
    return findings.read_only_summary(requests.findings_of(done)).select("request_id", "path", "matched_rules", F.array_join("rules", ",").alias("rules"))


def redact_json_text(spark, sf_dir):
    """The free walk over JSON text: one key under a field rule, one with a text."""
    given = seeded(spark, sf_dir).select("doc_id", F.to_json(F.struct(F.col("text").alias("note"), F.col("source").alias("Session_Token"))).alias("body"))
    done = given.select("doc_id", requests.redact_json(F.col("body"), effective_rules(), KEY).alias("r"))
    return done.select("doc_id", F.get_json_object("r.body", "$.Session_Token").alias("token"), F.sha2(F.get_json_object("r.body", "$.note"), 256).alias("note_sha256"), F.array_join("r.rules", ",").alias("rules"))


# ---- responses and chunks


def _redacted(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(doc_id, request_id, body as sent) and the mapping of all of it."""
    done = cut(_done(spark, sf_dir).select("doc_id", "request_id", "source_format", "result.body", "result.tokens"))
    return done.drop("tokens"), done.select(F.explode("tokens").alias("token", "original")).distinct()


def _answers(sent: DataFrame, shift: int = 0) -> DataFrame:
    """Each request's body quoted as text in a JSON answer, by turns with brackets escaped; to the request ``shift`` further on."""
    quoted = F.to_json(F.struct(F.col("body").alias("said")))
    escaped = F.replace(F.replace(quoted, F.lit("<"), F.lit("\\u003c")), F.lit(">"), F.lit("\\u003e"))
    return sent.select((F.col("doc_id") + shift).cast("string").alias("request_id"), "source_format", F.lit("application/json").alias("content_type"), F.when(F.col("doc_id") % 2 == 0, quoted).otherwise(escaped).alias("body"))


def restore_responses(spark, sf_dir):
    """JSON answers that quote their own request: every original comes back."""
    sent, mapping = _redacted(spark, sf_dir)
    back = responses.restore_responses(_answers(sent), sent, mapping)
    said = F.get_json_object("body", "$.said")
    return back.select("request_id", F.size(C.tokens_in(said)).cast("long").alias("tokens_left"), F.instr(said, "<REDACTED_").cast("long").alias("first_left"))


def unrestored_tokens(spark, sf_dir):
    """Tokens of answers that quote the request before: those that their own request doesn't carry."""
    sent, mapping = _redacted(spark, sf_dir)
    return responses.unrestored_tokens(_answers(sent, 1), sent, mapping)


def token_labels(spark, sf_dir):
    sent, _ = _redacted(spark, sf_dir)
    return sent.select("request_id", F.array_join(responses.token_labels(C.tokens_in(F.col("body"))), ",").alias("labels"))


def restore_chunks(spark, sf_dir):
    """Redacted documents streamed as deltas of 40 characters, which cut tokens: put together, the texts come back."""
    done = cut(requests.redact_requests(bodies(spark, sf_dir).withColumn("source_format", F.lit("openai-image")).withColumn("body", F.to_json(F.struct(F.col("text").alias("prompt")))), effective_rules(), KEY).select("request_id", "result.body", "result.tokens"))
    mapping = done.select(F.explode("tokens").alias("token", "original")).distinct()
    text = F.get_json_object("body", "$.prompt")
    at = F.timestamp_seconds(F.lit(0))
    none = F.lit(None).cast("string")
    init = done.select("request_id", F.lit(-1).alias("chunk_index"), at.alias("ts"), F.lit("openai").alias("source_format"), F.lit("text/event-stream").alias("content_type"), none.alias("body"), F.col("body").alias("request_body"))
    parts = done.select("request_id", F.posexplode(deltas(text)).alias("chunk_index", "part"))
    event = lambda delta, why: F.concat(F.lit("data: "), F.to_json(F.struct(F.lit("chat.completion.chunk").alias("object"), F.array(F.struct(F.lit(0).alias("index"), delta.alias("delta"), why.alias("finish_reason"))).alias("choices"))), F.lit("\n\n"))
    said = parts.select("request_id", "chunk_index", at.alias("ts"), F.lit("openai").alias("source_format"), F.lit("text/event-stream").alias("content_type"), event(F.struct(F.col("part").alias("content")), none).alias("body"), none.alias("request_body"))
    last = done.select("request_id", F.lit(2**31 - 1).alias("chunk_index"), at.alias("ts"), F.lit("openai").alias("source_format"), F.lit("text/event-stream").alias("content_type"), event(F.struct(F.lit("").alias("content")), F.lit("stop")).alias("body"), none.alias("request_body"))
    given = init.unionByName(said).unionByName(last)
    completions = given.limit(0).select("request_id", "ts")
    out = chunks.restore_chunks(given, completions, mapping, init).filter("chunk_index >= 0")
    content = out.select("request_id", "chunk_index", F.coalesce(F.get_json_object(F.substring("body", 7, 10**9), "$.choices[0].delta.content"), F.lit("")).alias("text"))
    return chunks.stitch_text(content, "request_id").select("request_id", F.sha2("text", 256).alias("text_sha256"))


# ---- columns


def excerpts(spark, sf_dir):
    """The surroundings of each document's first address."""
    found = seeded(spark, sf_dir).select("doc_id", "text", F.get(C.hits(F.col("text"), rules_named(["email"])[0]), F.lit(0)).alias("focus"))
    return found.filter("focus is not null").select("doc_id", C.excerpt(F.col("text"), F.col("focus")).alias("excerpt"))


def config_keys(spark, sf_dir):
    before = F.regexp_extract("text", r"([\w.-]+\s*[:=]\s*)hunter", 1)
    return seeded(spark, sf_dir).select("doc_id", C.config_key(before).alias("config_key"))


def json_contents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(C.json_string_content(F.col("text")), 256).alias("content_sha256"))


def masked_paths(spark, sf_dir):
    """Paths to the turns of conversations, keys masked."""
    turns = table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", C.mask_path(F.array(F.lit("messages"), F.concat(F.lit("["), F.col("turn").cast("string"), F.lit("]")), "role")).alias("path"))


def sse_events(spark, sf_dir):
    """Conversations as event streams, split again."""
    line = lambda x: F.concat(F.lit("event: "), x["role"], F.lit("\r\ndata: "), x["turn"].cast("string"), F.lit("\r\ndata:"), F.length(x["text"]).cast("string"))
    own = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("x"))
    body = F.concat(F.array_join(F.transform("x", line), "\r\n\r\n"), F.lit("\r\n\r\n"))
    split = own.select("conv_id", body.alias("body")).select("conv_id", C.is_sse(F.col("body")).alias("is_sse"), F.posexplode(C.sse_split(F.col("body"))).alias("place", "e"))
    return split.select("conv_id", "is_sse", F.col("place").cast("long").alias("place"), "e.event", "e.data")


def field_rules(spark, sf_dir):
    """Each field rule on its own over a table whose columns have its keys: whether it takes the value."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    from ..operators.redaction import redact_columns

    out = None
    for i, (name, keys) in enumerate(FIELD_RULES):
        given = docs.select("doc_id", F.col("source").alias(keys[-1].upper()))
        rule = RuleSet(tuple(r for r in effective_rules().fields if r.name == name), ())
        done = redact_columns(given, rule, KEY).select("doc_id", F.lit(name).alias("rule"), F.lit(i).cast("long").alias("place"), F.col(keys[-1].upper()).alias("value"))
        out = done if out is None else out.unionByName(done)
    return out


QUERIES = {
    f.__name__: f
    for f in (
        request_formats, redact_again, regions_openai, regions_responses, regions_claude, regions_gemini, regions_prompt, request_findings, findings_report, request_reasons, block_requests,
        malformed_arguments, redact_json_text, restore_responses, unrestored_tokens, token_labels, restore_chunks, excerpts, config_keys, json_contents, masked_paths, sse_events, field_rules,
    )
}
_ON = sql_redacted(_SEEDED, "doc_id", ON)
_FORMAT = "[" + ", ".join(f"'{k}'" for k, _ in PLACES) + f"][doc_id % {len(PLACES)} + 1]"
_PATH = "[" + ", ".join(f"'{p}'" for _, p in PLACES) + f"][doc_id % {len(PLACES)} + 1]"
_ID = "CAST(doc_id AS VARCHAR) AS request_id"
_FIRED = f"(SELECT doc_id, unnest(string_split(rules, ',')) AS rule, unnest(range(len(string_split(rules, ',')))) AS seq, {_PATH} AS path FROM redacted WHERE rules <> '')"
_EMAIL = _sql_hits("text", next(r[1] for r in VALUE_RULES if r[0] == "email"), None)
_FIELDS = """CASE rule WHEN 'config_password' THEN 'db_password' WHEN 'config_secret' THEN 'my.secret_key' WHEN 'config_api_key' THEN 'APP-KEY' WHEN 'config_private_key' THEN 'private_key'
  WHEN 'config_credential' THEN 'aws.credentials' WHEN 'config_token' THEN (SELECT array_to_string(list_distinct(k)[:8], ',') FROM (SELECT list(x) AS k FROM (SELECT unnest(regexp_extract_all(s.text, '(?i)((?:[\\w.-]*[_.-])?(?:access[_-]?token|refresh[_-]?token|auth[_-]?token|id[_-]?token|token))\\s*[:=]\\s*\\S+', 1)) AS x))) ELSE '' END"""


def _regions_sql(*kinds: str) -> str:
    return f"SELECT {_ID}, {_PATH} AS path, 'text' AS kind, sha256(text) AS text_sha256 FROM {_SEEDED} WHERE {_FORMAT} IN ({', '.join(map(_sql_text, kinds))})"


SQL = {
    "request_formats": f"WITH {_ON} SELECT {_ID}, {_FORMAT} AS source_format, sha256(text) AS text_sha256, rules, CAST(len(made) AS BIGINT) AS n_tokens FROM redacted",
    "redact_again": f"SELECT {_ID}, CAST(0 AS BIGINT) AS n_findings, TRUE AS same FROM documents",
    "regions_openai": _regions_sql("openai"), "regions_responses": _regions_sql("openai-response"), "regions_claude": _regions_sql("claude"), "regions_gemini": _regions_sql("gemini"), "regions_prompt": _regions_sql("openai-image", "openai-video"),
    "request_findings": f"WITH {_ON} SELECT CAST(f.doc_id AS VARCHAR) AS request_id, CAST(seq AS BIGINT) AS seq, rule, 'value' AS rule_type, path, {_FIELDS} AS fields, FALSE AS read_only FROM {_FIRED} f JOIN {_SEEDED} s ON s.doc_id = f.doc_id",
    "findings_report": f"WITH {_ON}, v AS (SELECT rule, path, count(*) AS n, min(doc_id) AS fst FROM {_FIRED} GROUP BY rule, path) SELECT rule, 'value' AS rule_type, CAST(sum(n) AS BIGINT) AS hits, string_agg(path, ',' ORDER BY fst, path) AS paths, CAST(0 AS BIGINT) AS omitted_paths FROM v GROUP BY rule",
    "request_reasons": f"WITH {_ON} SELECT {_ID}, rule || ' (value) at ' || path AS first FROM {_FIRED} WHERE seq = 0",
    "block_requests": f"WITH {_ON} SELECT {_ID}, {_FORMAT} AS source_format, 'blocked by ' || rule AS reason, path FROM {_FIRED} WHERE seq = 0",
    "malformed_arguments": "WITH h AS (" + " UNION ALL ".join(f"SELECT doc_id, {i} AS seq, '{n}' AS rule FROM {_SEEDED} WHERE len({_sql_hits('text', p, v)}) > 0" for i, (n, p, v, _) in enumerate(ON)) + f""")
SELECT {_ID}, 'messages[0].tool_calls[0].function.arguments' AS path, count(*) AS matched_rules, string_agg(rule, ',' ORDER BY seq) FILTER (r <= 8) AS rules FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS r FROM h) GROUP BY doc_id""",
    "redact_json_text": f"WITH {_ON} SELECT r.doc_id, {_sql_hmac('source')} AS token, sha256(r.text) AS note_sha256, CASE WHEN rules = '' THEN 'session' ELSE rules || ',session' END AS rules FROM redacted r JOIN documents d ON d.doc_id = r.doc_id",
    "restore_responses": f"SELECT {_ID}, CAST(0 AS BIGINT) AS tokens_left, CAST(0 AS BIGINT) AS first_left FROM documents",
    "unrestored_tokens": f"WITH {_ON}, t AS (SELECT doc_id, unnest(made) AS token FROM redacted) SELECT CAST(doc_id + 1 AS VARCHAR) AS request_id, token FROM t WHERE NOT EXISTS (SELECT 1 FROM t o WHERE o.doc_id = t.doc_id + 1 AND o.token = t.token)",
    "token_labels": f"WITH {_ON} SELECT {_ID}, CASE WHEN len(made) > 0 THEN 'REDACTED' ELSE '' END AS labels FROM redacted",
    "restore_chunks": f"SELECT {_ID}, sha256(text) AS text_sha256 FROM {_SEEDED}",
    "excerpts": f"""WITH f AS (SELECT doc_id, text, {_EMAIL}[1] AS x FROM {_SEEDED} WHERE len({_EMAIL}) > 0),
m AS (SELECT doc_id, strpos(text, x) - 1 AS b, regexp_replace(substr(text, 1, strpos(text, x) - 1) || '[REDACTED]' || substr(text, strpos(text, x) + length(x)), '[\\x00-\\x1F\\x7F-\\x{{9F}}]', ' ', 'g') AS t FROM f),
s AS (SELECT *, length(t) AS n, least(greatest(b - 72, 0), length(t) - 154) AS st FROM m)
SELECT doc_id, CASE WHEN n <= 160 THEN t WHEN st = 0 THEN substr(t, 1, 157) || '...' WHEN st + 154 = n THEN '...' || right(t, 157) ELSE '...' || substr(t, CAST(st + 1 AS INT), 154) || '...' END AS excerpt FROM s""",
    "config_keys": f"SELECT doc_id, trim(regexp_extract(regexp_extract(text, '([\\w.-]+\\s*[:=]\\s*)hunter', 1), '^([\\w.-]+)', 1)) AS config_key FROM {_SEEDED}",
    "json_contents": "SELECT doc_id, sha256(substr(CAST(to_json(text) AS VARCHAR), 2, length(CAST(to_json(text) AS VARCHAR)) - 2)) AS content_sha256 FROM documents",
    "masked_paths": "SELECT conv_id, turn, '.*[' || turn || '].*' AS path FROM conversations",
    "sse_events": "SELECT conv_id, TRUE AS is_sse, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS place, role AS event, turn || chr(10) || length(text) AS data FROM conversations",
    "field_rules": " UNION ALL ".join(f"SELECT doc_id, '{n}' AS rule, CAST({i} AS BIGINT) AS place, {_sql_hmac('source')} AS value FROM documents" for i, (n, _) in enumerate(FIELD_RULES)),
}
