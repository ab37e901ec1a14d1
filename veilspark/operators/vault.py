"""The mapping table token -> original, and restoring texts from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import all_tokens, make_token

MAX_TOKENS = 1024


def vault_rows(found: DataFrame, value: str, at: Column, ttl_seconds: int, key: bytes, label: str = "REDACTED") -> DataFrame:
    """(token, original, put_ts, expires_at) of found values: one row for each token, refreshed by its last put. The hash is only
    computed for what is left after a pre-aggregation."""
    put = found.select(F.col(value).alias("original"), at.alias("put_ts")).groupBy("original").agg(F.max("put_ts").alias("put_ts"))
    return put.select(make_token(F.col("original"), key, label).alias("token"), "original", "put_ts", (F.col("put_ts") + F.expr(f"INTERVAL {int(ttl_seconds)} SECONDS")).alias("expires_at"))


def dedupe(vault: DataFrame) -> DataFrame:
    """One row for each token: the original that expires last, and the last put, expiry and use (a put or a read) where the table has
    them. Rows of reads (original null) count as uses alone; a token without a put is left out."""
    times = [c for c in ("put_ts", "expires_at", "used_ts") if c in vault.columns]
    by = F.struct(*[c for c in ("expires_at", "original") if c in vault.columns])
    put = F.col("original").isNotNull()
    merged = vault.groupBy("token").agg(F.max_by(F.when(put, F.col("original")), F.when(put, by)).alias("original"), *[F.max(c).alias(c) for c in times])
    return merged.filter("original is not null")


def compact(vault: DataFrame, now: Column, most: int) -> DataFrame:
    """The ``most`` rows used last (by a put, or a read where there is ``used_ts``) that haven't expired, ties by token."""
    used = F.greatest(*[c for c in ("put_ts", "used_ts") if c in vault.columns]) if "used_ts" in vault.columns else F.col("put_ts")
    return vault.filter(F.col("expires_at") >= now).orderBy(used.desc(), "token").limit(most)


def live(reads: DataFrame, vault: DataFrame) -> DataFrame:
    """Reads (token, read_ts, ...) with the original that is live at that time."""
    both = reads.join(vault, "token").filter("put_ts <= read_ts and read_ts <= expires_at")
    return both.groupBy(*reads.columns).agg(F.max_by("original", "put_ts").alias("original"))


def request_tokens(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, token, at): the distinct token-shaped parts of each row's text, escaped ones last, with the place of the first."""
    return df.select(key, F.posexplode(all_tokens(F.col(text))).alias("at", "token")).groupBy(key, "token").agg(F.min("at").alias("at"))


def allowlist(df: DataFrame, vault: DataFrame, key: str, text: str, most: int = MAX_TOKENS) -> DataFrame:
    """(key, token): the first ``most`` tokens of each request that have a mapping. A hot token meets one vault row; adaptive
    execution splits its side of the join."""
    known = request_tokens(df, key, text).join(vault.select("token").distinct(), "token", "left_semi")
    ranked = known.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy("at")))
    return ranked.filter(F.col("rank") <= most).select(key, "token")


def forged(df: DataFrame, vault: DataFrame, key: str, text: str) -> DataFrame:
    """(key, token): token-shaped parts without a mapping."""
    return request_tokens(df, key, text).join(vault, "token", "left_anti").select(key, "token")


def restore_text(text: Column, originals: Column, token: str = r"<[^<>\r\n]+_[0-9a-f]{16}>") -> Column:
    """The text with each token that the map holds put back, in one pass: what is put in isn't looked at again."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s){token}|.[^<]*"), F.lit(0))
    return F.when(originals.isNull() | (F.size(originals) == 0), text).otherwise(F.array_join(F.transform(pieces, lambda p: F.coalesce(F.try_element_at(originals, p), p)), ""))


def restore(responses: DataFrame, requests: DataFrame, vault: DataFrame, key: str, text: str, request_text: str) -> DataFrame:
    """Responses with the tokens put back that their own request carried and the vault knows. Everything else stays."""
    allowed, mapping = allowlist(requests, vault, key, request_text), dedupe(vault)
    wanted = request_tokens(responses, key, text).join(allowed, [key, "token"], "left_semi").join(mapping.select("token", "original"), "token")
    maps = wanted.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("token", "original"))).alias("_originals"))
    return responses.join(maps, key, "left").withColumn(text, restore_text(F.col(text), F.col("_originals"))).drop("_originals")
