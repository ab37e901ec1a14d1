import time

import pytest
from pyspark.sql import functions as F

from veilspark.functions import columns as C
from veilspark.functions import rules as R
from veilspark.functions.scan import TextRedactor
from veilspark.operators import findings, requests, responses, vault
from veilspark.sources import tables
from veilspark.streaming import chunks
from veilspark.streaming.redaction import redact_stream

KEY = b"k"
make = TextRedactor((), KEY, "REDACTED").make
SECRET = b"0123456789abcdef"


def at(seconds):
    return F.timestamp_seconds(F.lit(seconds))


def mapping(spark, rows):
    """(token, original, put, expires, used) with seconds."""
    df = spark.createDataFrame(rows, "token string, original string, p long, e long, u long")
    return df.select("token", "original", *[F.timestamp_seconds(a).alias(b) for a, b in (("p", "put_ts"), ("e", "expires_at"), ("u", "used_ts"))])


def test_batches_merge_into_one_row_a_token(spark, tmp_path):
    path = f"{tmp_path}/vault"
    assert tables.read_vault(spark, path) is None
    tables.write_vault(mapping(spark, [("a", "x", 10, 100, 10), ("b", "y", 10, 50, 10)]), path, batch=0)
    tables.write_vault(mapping(spark, [("a", "x", 20, 110, 20), ("c", "z", 20, 110, 20), ("d", None, None, None, 20)]), path, batch=1)
    rows = lambda: sorted((r.token, r.original, r.put_ts.second, r.used_ts.second) for r in tables.read_vault(spark, path).collect())
    want = [("a", "x", 20, 20), ("b", "y", 10, 10), ("c", "z", 20, 20)]
    assert rows() == want
    tables.merge_vault(spark, path)
    assert rows() == want and spark.read.parquet(f"{path}/merged/upto=1").count() == 3
    # A batch that runs again takes its own place, before and behind the merge.
    tables.write_vault(mapping(spark, [("c", "z", 20, 110, 20)]), path, batch=1)
    tables.write_vault(mapping(spark, [("b", None, None, None, 40)]), path, batch=2)
    tables.write_vault(mapping(spark, [("b", None, None, None, 45)]), path, batch=2)
    assert rows() == [want[0], ("b", "y", 10, 45), want[2]]
    # b was read last and stays; a and c were put last at the same time, ties go by token.
    tables.merge_vault(spark, path, at(50), most=2)
    assert [r[0] for r in rows()] == ["a", "b"]
    tables.write_vault(mapping(spark, [("e", "w", 60, 160, 60)]), path, batch=3)
    tables.merge_vault(spark, path, at(60), most=5)
    assert [r[0] for r in rows()] == ["a", "e"]  # b has expired, read or not


def test_originals_are_encrypted_and_come_back(spark, tmp_path):
    path, secret = f"{tmp_path}/vault", F.lit(SECRET)
    for batch in (0, 1):
        tables.write_vault(mapping(spark, [("a", "plain text é", 10, 100, 10), ("b", None, None, None, 5)]), path, secret, batch)
    tables.merge_vault(spark, path)
    assert [(r.token, r.original) for r in tables.read_vault(spark, path, secret).collect()] == [("a", "plain text é")]
    stored = spark.read.parquet(f"{path}/merged/upto=1").first().original
    assert "plain" not in stored and stored == tables.read_vault(spark, path).first().original
    with pytest.raises(Exception, match="AES"):
        tables.read_vault(spark, path, F.lit(b"fedcba9876543210")).collect()


def test_turns_of_a_conversation_are_redacted_once(spark, tmp_path):
    """The second turn carries the first one's token: it stays, its mapping is used, and both turns come back."""
    body = lambda *said: '{"messages":[' + ",".join(f'{{"content":"{s}"}}' for s in said) + "]}"
    token = make("hunter2")
    turns = [body("password: hunter2"), body(f"password: {token}", "and password: hunter2 with password: other99")]
    for i, b in enumerate(turns):
        spark.createDataFrame([(f"r{i}", "openai", b)], "request_id string, source_format string, body string").select("request_id", at(1000 + i).alias("ts"), "source_format", "body").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(1.1 * (1 - i))
    given = spark.readStream.schema(tables.SCHEMAS["requests"]).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    redact_stream(given, R.effective_rules(), KEY, f"{tmp_path}/out", secret=F.lit(SECRET), merge_every=2, most=10).awaitTermination(120)
    sent = {r.request_id: r.body for r in spark.read.parquet(f"{tmp_path}/out/bodies").collect()}
    assert sent["r0"] == body(f"password: {token}") and sent["r1"] == body(f"password: {token}", f"and password: {token} with password: {make('other99')}")
    held = tables.read_vault(spark, f"{tmp_path}/out/vault", F.lit(SECRET))
    assert sorted((r.token, r.original, r.used_ts.second) for r in held.collect()) == sorted([(token, "hunter2", 41), (make("other99"), "other99", 41)])
    asked = spark.createDataFrame(list(sent.items()), "request_id string, body string")
    back = vault.restore(asked, asked, held, "request_id", "body", "body")
    assert {r.body for r in back.collect()} == {turns[0], turns[1].replace(token, "hunter2")}


def test_an_expired_token_is_plain_text(spark):
    token = make("hunter2")
    df = spark.createDataFrame([("1", "openai", f'{{"messages":[{{"content":"password: {token}"}}]}}')], "request_id string, source_format string, body string")
    held = mapping(spark, [(token, "hunter2", 10, 100, 10)])
    for now, kept in ((50, True), (101, False)):
        done = requests.redact_requests(df.withColumn("ts", at(now)), R.effective_rules(), KEY, vault=held).first().result
        assert (token in done.body) == kept


def test_duplicate_mapping_rows_restore(spark):
    """A mapping that wasn't merged doesn't stop anything."""
    token = make("hunter2")
    held = mapping(spark, [(token, "hunter2", 10, 100, 10), (token, "hunter2", 20, 110, 20)])
    said = spark.createDataFrame([("1", f"x {token}")], "request_id string, body string")
    assert vault.restore(said, said, held, "request_id", "body", "body").first().body == "x hunter2"
    inits = said.select("request_id", F.lit(-1).alias("chunk_index"), F.col("body").alias("request_body"))
    assert chunks.stream_originals(inits, held).first().originals == f'{{"{token}":{{"original":"hunter2","expires":110.0}}}}'
    back = responses.restore_responses(said.select("request_id", F.lit("openai").alias("source_format"), F.lit("text/plain").alias("content_type"), "body"), said, held)
    assert back.first().body == "x hunter2"


def test_each_response_has_its_own_time(spark):
    token = make("hunter2")
    asked = spark.createDataFrame([("1", token)], "request_id string, body string")
    held = mapping(spark, [(token, "hunter2", 10, 200, 10)])
    said = spark.createDataFrame([("1", 150, "a"), ("1", 500, "b"), ("1", None, "c")], "request_id string, s long, x string")
    said = said.select("request_id", F.timestamp_seconds("s").alias("ts"), F.lit("openai").alias("source_format"), F.lit("text/plain").alias("content_type"), F.concat("x", F.lit(token)).alias("body"))
    assert sorted(r.body for r in responses.restore_responses(said, asked, held).collect()) == ["a" + "hunter2", f"b{token}", f"c{token}"]


def test_allowlists_read_any_escape(spark):
    token = make("x")
    escaped = [token, token.replace("_", "\\u005f"), token.replace("<", "\\u003C").replace(">", "\\u003e"), "".join(f"\\u{ord(c):04x}" for c in token)]
    none = [token.replace("<", "\\\\u003c"), token.replace("_", "\\u005"), "\\" + token.replace("<", "\\u003c"), token.replace("<", "\\u00e9")]
    df = spark.createDataFrame([(i, f'{{"a":"{t}"}}') for i, t in enumerate(escaped + none)], "i int, t string")
    got = {r.i: r.x for r in df.select("i", C.all_tokens(F.col("t")).alias("x")).collect()}
    assert all(got[i] == [token] for i in range(4)) and not any(got[i] for i in range(4, 8))
    held = spark.createDataFrame([(token, "x")], "token string, original string")
    assert {r.i for r in vault.allowlist(df, held, "i", "t").collect()} == {0, 1, 2, 3}


def test_distinct_tokens_and_their_sketches(spark):
    rows = [(i, "s0" if i % 3 else "s1", i % 2, f"u{i % 4000}@ex.com 10.0.{i % 250}.1 u{i}@ex.com") for i in range(12_000)]
    df = spark.createDataFrame(rows, "i int, source string, day int, text string")
    values = findings.rule_values(df, "text", R.rules_named(["email", "ipv4"]), "source", "day")
    exact = {(r.rule, r.source): (r.hits, r.n_tokens) for r in findings.count_values(values, "source").collect()}
    assert exact["ipv4", "s0"] == (8000, 250) and exact["email", "s0"][0] == 16_000
    days = findings.value_sketches(values, "source", "day")
    merged = {(r.rule, r.source): r.n_tokens for r in findings.estimate_values(days, "source").collect()}
    for k, (_, n) in exact.items():
        assert abs(merged[k] - n) <= 0.02 * n
