"""Reading traffic tables and writing the results of a redaction job. Plain text only leaves through the mapping table."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.vault import compact, dedupe
from .scratch import delete, numbered

SCHEMAS = {
    "requests": "request_id string, ts timestamp, source_format string, body string",
    "responses": "request_id string, ts timestamp, source_format string, content_type string, body string",
    "chunks": "request_id string, chunk_index int, ts timestamp, source_format string, content_type string, body string, request_body string",
    "completions": "request_id string, ts timestamp, stream boolean, outcome string",
}


#: A table beyond this size is read where it is, however few its files are.
SMALL_BYTES = 1 << 30


def spread(df: DataFrame) -> DataFrame:
    """A small table of fewer files than the cluster has cores, dealt out evenly: a file may be a single row group, and so all the work
    would be one task's. Other tables stay as they are, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if len(df.inputFiles()) >= cores or size > SMALL_BYTES:
        return df
    return df.repartition(cores)


def read_traffic(spark: SparkSession, kind: str, path: str, streaming: bool = False, form: str = "parquet") -> DataFrame:
    """One of SCHEMAS from files, as a table or as a stream."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(SCHEMAS[kind]).format(form).load(path)


def _append(df: DataFrame, path: str, batch: int | None, *by: str) -> None:
    """Adds rows; those of a numbered batch take the place of what an earlier try of the same batch wrote."""
    if batch is None:
        df.write.mode("append").partitionBy(*by).parquet(path)
    else:
        own = df.withColumn("batch", F.lit(batch).cast("long"))
        own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", *by).parquet(path)


def write_redacted(df: DataFrame, path: str, *by: str, batch: int | None = None) -> None:
    _append(df, path, batch, *by)


def write_vault(vault: DataFrame, path: str, secret: Column | None = None, batch: int | None = None) -> None:
    """Adds rows to the mapping table at ``path``: puts, and reads (original null) as uses. A numbered batch that is written again takes the place of
    its first try. With ``secret`` (16, 24 or 32 bytes) originals are encrypted."""
    own = vault if secret is None else vault.withColumn("original", F.base64(F.aes_encrypt("original", secret)))
    own.write.mode("overwrite").parquet(f"{path}/rows/batch={time.time_ns() // 1000 if batch is None else batch}")


def _vault_rows(spark: SparkSession, path: str) -> tuple[DataFrame | None, int | None]:
    """(the last merged table and what came after it, its last batch)."""
    merged, batches = numbered(spark, f"{path}/merged", "upto"), numbered(spark, f"{path}/rows", "batch")
    after = [b for b in batches if not merged or b > merged[-1]]
    parts = [f"{path}/merged/upto={n}" for n in merged[-1:]] + [f"{path}/rows/batch={b}" for b in after]
    return (spark.read.option("mergeSchema", "true").parquet(*parts) if parts else None), max([*merged[-1:], *after], default=None)


def read_vault(spark: SparkSession, path: str, secret: Column | None = None) -> DataFrame | None:
    """The mapping table, one row for each token; None where nothing has been written."""
    rows, _ = _vault_rows(spark, path)
    if rows is None:
        return None
    vault = dedupe(rows)
    return vault if secret is None else vault.withColumn("original", F.aes_decrypt(F.unbase64("original"), secret).cast("string"))


def merge_vault(spark: SparkSession, path: str, now: Column | None = None, most: int | None = None) -> None:
    """Merges what has been added into one row for each token, without those that expired before ``now`` and, beyond the ``most`` used last,
    the others. Originals stay encrypted. Readers of the table before the merge aren't disturbed: its files go with the next one."""
    rows, last = _vault_rows(spark, path)
    if rows is None:
        return
    before = numbered(spark, f"{path}/merged", "upto")
    if before and before[-1] == last:
        return
    vault = dedupe(rows)
    vault = vault if most is None else compact(vault, F.lit(0).cast("timestamp") if now is None else now, most)
    vault.write.mode("overwrite").parquet(f"{path}/merged/upto={last}")
    for n in before[:-1]:
        delete(spark, f"{path}/merged/upto={n}")
    for n in numbered(spark, f"{path}/rows", "batch"):
        if before and n <= before[-1]:
            delete(spark, f"{path}/rows/batch={n}")


def write_findings(found: DataFrame, path: str, batch: int | None = None) -> None:
    """Findings without their context, so that neither plain text nor tokens leave."""
    _append(found.drop("context"), path, batch)


def write_dead_letter(rejected: DataFrame, path: str, batch: int | None = None) -> None:
    """Rejected rows: key and reason, never content."""
    _append(rejected, path, batch)
