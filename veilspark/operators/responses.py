"""Restoring responses: a token comes back only if its own request carried it and the mapping table still holds it."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import all_tokens, media_route
from ..functions.restoring import Restorer
from .vault import MAX_TOKENS, allowlist, dedupe

ORIGINALS = "map<string,string>"


def token_labels(tokens: Column) -> Column:
    """Distinct labels of an array of tokens, sorted."""
    return F.array_sort(F.array_distinct(F.transform(tokens, lambda t: F.regexp_extract(t, r"\A<(.+)_[0-9a-f]{16}>\z", 1))))


def said_tokens(df: DataFrame, text: str) -> DataFrame:
    """Distinct (request_id, token) of a text, escaped brackets included."""
    return df.select("request_id", F.explode(F.array_distinct(all_tokens(F.col(text)))).alias("token"))


def unrestored_tokens(responses: DataFrame, requests: DataFrame, vault: DataFrame) -> DataFrame:
    """(request_id, token) of responses whose own request didn't carry the token, or without a mapping."""
    return said_tokens(responses, "body").join(allowlist(requests, vault, "request_id", "body"), ["request_id", "token"], "left_anti")


def originals_for(rows: DataFrame, requests: DataFrame, vault: DataFrame, most: int = MAX_TOKENS) -> DataFrame:
    """(request_id, originals): what may come back in ``rows`` (request_id, body). Where rows have ``ts`` and mappings expire, by request_id and
    ts: each response gets what is still held at its own time."""
    mapping = dedupe(vault)
    key = ["request_id", "ts"] if "ts" in rows.columns and "expires_at" in mapping.columns else ["request_id"]
    allowed = allowlist(requests, mapping, "request_id", "body", most)
    said = rows.select(*key, F.explode(F.array_distinct(all_tokens(F.col("body")))).alias("token")).distinct()
    wanted = said.join(allowed, ["request_id", "token"], "left_semi").join(mapping, "token")
    if len(key) == 2:
        wanted = wanted.filter("ts <= expires_at")
    return wanted.groupBy(*key).agg(F.map_from_entries(F.collect_set(F.struct("token", "original"))).alias("originals"))


def restore_responses(responses: DataFrame, requests: DataFrame, vault: DataFrame) -> DataFrame:
    """``responses`` (request_id, source_format, content_type, body, ...) with restored bodies, routed by media type; ``requests``
    holds the bodies as sent. Bodies meet nothing but the map of their own request."""

    @F.pandas_udf("string")
    def run(body: pd.Series, route: pd.Series, kind: pd.Series, originals: pd.Series) -> pd.Series:
        done = [b if b is None or m is None else Restorer(dict(m)).body(b, r, k or "") for b, r, k, m in zip(body, route, kind, originals, strict=True)]
        return pd.Series(done, dtype=object)

    columns = responses.columns
    maps = originals_for(responses, requests, vault)
    own = [c for c in maps.columns if c != "originals"]
    joined = responses.alias("r").join(maps.alias("m"), reduce(Column.__and__, [F.col(f"r.{c}").eqNullSafe(F.col(f"m.{c}")) for c in own]), "left").select("r.*", "m.originals")
    body = run("body", media_route(F.col("content_type")), "source_format", "originals")
    return joined.withColumn("body", body).select(*columns)
