"""Redaction of a stream of requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.rules import RuleSet
from ..operators.requests import findings_of, redact_known, split_results, with_known
from ..sources.tables import merge_vault, read_vault, write_dead_letter, write_findings, write_redacted, write_vault


def redact_stream(
    requests: DataFrame, rules: RuleSet, key: bytes, path: str, mode: str = "filter", ttl_seconds: int = 3600, secret: Column | None = None, label: str = "REDACTED",
    most: int | None = None, merge_every: int = 16, trigger: dict | None = None,
) -> StreamingQuery:
    """Each micro-batch is redacted once and goes to four sinks under ``path``: bodies, findings, mapping and dead letters. A batch that runs
    again takes the place of its first try. ``secret`` encrypts the mapping's originals.

    Tokens that the mapping still holds at a request's time stay as they are, so that the turns of a conversation aren't redacted again and again; such a
    read counts as a use. Every ``merge_every`` batches the mapping is merged into one row for each token and, with ``most``, cut to those
    used last. ``trigger`` is as in ``DataStreamWriter.trigger``; what is there already, where it isn't given.

    What a batch has made is kept by the executors alone until its sinks are written: in a shared folder its originals would lie open. A lost executor's
    part is made again, with the same tokens."""

    def sink(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        done = redact_known(with_known(batch, read_vault(spark, f"{path}/vault")), rules, key, label, mode).persist()
        passed, rejected = split_results(done, mode)
        write_redacted(passed.select("request_id", "ts", "source_format", F.col("result.body").alias("body")), f"{path}/bodies", "source_format", batch=number)
        write_findings(findings_of(done, "ts"), f"{path}/findings", batch=number)
        made = passed.select("ts", F.explode("result.tokens").alias("token", "original")).groupBy("token", "original").agg(F.max("ts").alias("put_ts"))
        puts = made.select("token", "original", "put_ts", (F.col("put_ts") + F.make_dt_interval(secs=F.lit(ttl_seconds))).alias("expires_at"), F.col("put_ts").alias("used_ts"))
        never = F.lit(None).cast("timestamp")
        reads = done.select("ts", F.explode("known").alias("token")).groupBy("token").agg(F.max("ts").alias("used_ts"))
        write_vault(puts.unionByName(reads.select("token", F.lit(None).cast("string").alias("original"), never.alias("put_ts"), never.alias("expires_at"), "used_ts")), f"{path}/vault", secret, batch=number)
        write_dead_letter(rejected, f"{path}/dead_letter", batch=number)
        if number % merge_every == merge_every - 1:
            merge_vault(spark, f"{path}/vault", batch.agg(F.max("ts")).first()[0] and F.lit(batch.agg(F.max("ts")).first()[0]), most)
        done.unpersist()

    return requests.writeStream.foreachBatch(sink).option("checkpointLocation", f"{path}/_progress").trigger(**(trigger or {"availableNow": True})).start()
