"""Benchmark decontamination: a broadcast hash set of normalised benchmark word windows, scanned over whole documents.

Both sides are lower-cased (A-Z) and cut into words of letters and digits. Every ``size`` consecutive words of a benchmark
item are a window; an item with fewer words is one shorter window. Each task scans the words of its documents against a
sorted hash table of the windows, verifies each hit against the window's words, and reports the hit words, the spans and the
items. No document text is shuffled.

The table is broadcast only up to ``max_bytes`` of words and ids, and never becomes Python objects as a whole. A larger
benchmark is cut into slices by window, each of about that size; the documents are scanned once for each slice. Hits of slices
meet by hashes of doc_id and text, spans that touch or overlap become one, and the rows are joined to them, so both ways give the
same texts.

Defined results: null or empty text has no words and no hits. Items without words never match. A null item id counts as an
item with the id ``''``; rows that share an item id are one item. Rows of documents that repeat are reported once each.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import cut
from ..sources.tables import spread
from .text_kernels import ALNUM, cover, map_texts, runs, split_words, windows

WINDOW_WORDS = 10
MAX_BYTES = 128 << 20
SPANS = "array<struct<first:bigint,last:bigint,start:bigint,end:bigint>>"
_BITS = 22


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """Distinct (item, words, n_words, hash) windows of the items; ``words`` is joined by single spaces."""

    def work(data, offsets, _):
        w = split_words(data, offsets, ALNUM, lower=True)
        n = w.counts
        k = np.minimum(n, size)
        rows, at = [], []
        for d in np.flatnonzero(n):
            places = np.arange(w.first[d], w.first[d + 1] - k[d] + 1)
            at.append(places)
            rows.append(np.full(len(places), d))
        at = np.concatenate(at) if at else np.zeros(0, dtype=np.int64)
        rows = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
        by_size = {int(x): windows(w.hash, int(x)) for x in np.unique(k[n > 0])}
        text = [b" ".join(w.bytes(j) for j in range(i, i + k[d])).decode("utf-8", "replace") for i, d in zip(at, rows, strict=True)]
        h = np.array([by_size[int(k[d])][i] for i, d in zip(at, rows, strict=True)], dtype=np.uint64)
        return rows, {"words": text, "n_words": k[rows].astype(np.int32), "hash": h.view(np.int64)}

    item = {"item_id": F.coalesce(F.col("item_id").cast("string"), F.lit(""))}
    return map_texts(benchmark, work, [("words", "string"), ("n_words", "int"), ("hash", "long")], keep=item).distinct()


@dataclass
class Table:
    """Windows of one size, sorted by hash: their words, their items, and a bitmap of the hashes' low bits."""

    hashes: np.ndarray
    words: pa.Array
    items: pa.Array  # a list of ids for each window
    bits: np.ndarray


def _tables(rows: pa.Table) -> dict[int, Table]:
    """A table for each window size. ``rows`` (n_words, hash, words, items) comes sorted; it stays in Arrow buffers."""
    out = {}
    size, h = rows["n_words"].to_numpy(), rows["hash"].to_numpy().astype(np.int64).view(np.uint64)
    edge = runs(size)
    for lo, hi in zip(edge[:-1], edge[1:], strict=True):
        own = h[lo:hi]
        order = np.argsort(own, kind="stable")
        bits = np.zeros(1 << _BITS, dtype=bool)
        bits[(own & np.uint64((1 << _BITS) - 1)).astype(np.int64)] = True
        part = rows.slice(lo, hi - lo).take(pa.array(order)).combine_chunks()
        out[int(size[lo])] = Table(own[order], *(part[c].chunk(0) for c in ("words", "items")), bits)
    return out


def _scan(docs: DataFrame, rows: pa.Table, keep: dict) -> DataFrame:
    """The ``keep`` columns, n_words, items and spans of each text. A span is a run of hit words: the indexes of its first and last
    word, and its byte range."""
    shared = docs.sparkSession.sparkContext.broadcast(_tables(rows))

    def work(data, offsets, _):
        w = split_words(data, offsets, ALNUM, lower=True)
        left = w.left()
        n = len(offsets) - 1
        starts, ends = [], []
        found: list[set] = [set() for _ in range(n)]
        for k, t in shared.value.items():
            own = windows(w.hash, k)
            maybe = np.flatnonzero((left >= k) & t.bits[(own & np.uint64((1 << _BITS) - 1)).astype(np.int64)])
            at = np.searchsorted(t.hashes, own[maybe])
            there = at < len(t.hashes)
            there[there] = t.hashes[at[there]] == own[maybe[there]]
            for p, i in zip(maybe[there].tolist(), at[there].tolist(), strict=True):
                said = b" ".join(w.bytes(j) for j in range(p, p + k)).decode("utf-8", "replace")
                while i < len(t.hashes) and t.hashes[i] == own[p]:
                    if t.words[i].as_py() == said:
                        starts.append(p)
                        ends.append(p + k)
                        found[int(w.doc[p])].update(t.items[i].as_py())
                    i += 1
        hit = cover(np.array(starts, dtype=np.int64), np.array(ends, dtype=np.int64), len(w.doc))
        at = np.flatnonzero(hit)
        edge = (at[1:] != at[:-1] + 1) | (w.doc[at[1:]] != w.doc[at[:-1]]) if len(at) else np.zeros(0, dtype=bool)
        head = at[np.concatenate(([True], edge))] if len(at) else at
        tail = at[np.concatenate((edge, [True]))] if len(at) else at
        doc = w.doc[head]
        values = [head - w.first[doc], tail - w.first[doc], w.start[head] - offsets[doc], w.end[tail] - offsets[doc]]
        spans = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in values], names=["first", "last", "start", "end"])
        edges = pa.array(np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=n)))), pa.int32())
        return None, {"n_words": w.counts, "items": pa.array([sorted(x) for x in found], pa.list_(pa.string())), "spans": pa.ListArray.from_arrays(edges, spans)}

    return map_texts(docs, work, [("n_words", "long"), ("items", "array<string>"), ("spans", SPANS)], keep=keep)


def _merged(spans: Column) -> Column:
    """Spans in order of their places, those that touch or overlap as one."""

    def step(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        both = F.struct(last["first"].alias("first"), F.greatest(last["last"], x["last"]).alias("last"), last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        joins = (F.size(done) > 0) & (x["first"] <= F.coalesce(F.try_element_at(done, F.lit(-1))["last"], F.lit(-2)) + 1)
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(both))).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(spans), F.array().cast(SPANS), lambda done, x: F.when(F.size(done) == 0, F.array(x)).otherwise(step(done, x)))


def _hits(docs: DataFrame, benchmark: DataFrame, size: int, max_bytes: int, keep: dict) -> DataFrame:
    """The ``keep`` columns, n_words, items and spans of every row of ``docs``."""
    found = benchmark_windows(benchmark, size).groupBy("n_words", "hash", "words").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    found = cut(found)
    total = found.agg(F.sum(F.octet_length("words") + F.octet_length(F.array_join("items", "")) + 16 * F.size("items") + 32).alias("n")).first()[0] or 0
    ordered = found.orderBy("n_words", "hash", "words")
    if total <= max_bytes:
        return _scan(docs, ordered.toArrow(), keep)
    slices = -(-total // max_bytes)
    key = {"_x": F.xxhash64("doc_id", "text"), "_y": F.xxhash64(F.lit("row"), "text", "doc_id")}
    parts = [_scan(docs, ordered.filter(F.pmod(F.xxhash64("hash", "words"), F.lit(slices)) == s).toArrow(), key) for s in range(slices)]
    union = reduce(DataFrame.unionByName, parts).groupBy(*key).agg(F.max("n_words").alias("n_words"), *[F.array_distinct(F.flatten(F.collect_set(c))).alias(c) for c in ("items", "spans")])
    whole = union.select("_x", "_y", "n_words", F.sort_array("items").alias("items"), _merged(F.col("spans")).alias("spans"))
    given = docs.select(*[c.alias(f"_k{i}") for i, c in enumerate(keep.values())], *[c.alias(x) for x, c in key.items()])
    return given.join(whole, [*key]).select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "n_words", "items", "spans")


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, max_bytes: int = MAX_BYTES, keep: dict | None = None) -> DataFrame:
    """One row per document: the ``keep`` columns (doc_id), n_words, n_hit, items (sorted ids of items with an occurring window) and
    spans (first and last word of each run of hit words, start and end of its bytes in the UTF-8 text)."""
    keep = {"doc_id": F.col("doc_id")} if keep is None else keep
    hits = _hits(docs, benchmark, size, max_bytes, keep)
    n = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["last"] - x["first"] + 1)
    return hits.select(*keep, "n_words", n.alias("n_hit"), "items", "spans")


def clean_texts(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """All rows and columns of ``docs``; each run of hit words is cut out of ``text`` and leaves a space. The text travels with
    its spans, so nothing is joined or shuffled while the benchmark fits its bound."""
    hits = decontaminate(docs, benchmark, size, max_bytes, keep={f"c{i}": F.col(c) for i, c in enumerate(docs.columns)})
    text = F.col(f"c{docs.columns.index('text')}")
    raw = text.cast("binary")
    begin = F.concat(F.array(F.lit(0).cast("long")), F.col("spans.end"))
    end = F.concat(F.col("spans.start"), F.array(F.length(raw).cast("long")))
    kept = F.zip_with(begin, end, lambda a, b: F.substring(raw, (a + 1).cast("int"), (b - a).cast("int")).cast("string"))
    cut_text = F.when(F.size("spans") > 0, F.array_join(kept, " ")).otherwise(text)
    return hits.select(*[cut_text.alias(c) if c == "text" else F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate(docs, benchmark)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
h AS (SELECT DISTINCT doc_id, dw.k, i, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.k = bw.k),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
