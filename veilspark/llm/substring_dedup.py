"""Substring dedup by level-wise doubling: windows repeated at one length alone are extended to twice that length.

A word is removed if a window of ``window`` words that covers it also starts earlier in the corpus (a smaller doc_id, or the
same document and an earlier start). The levels:

1. *Shortest windows* (``lengths``: ``window`` halved until it is under 20 words, 10 for 20). Of those inside each window, the
   one with the least hash is its anchor; neighbouring windows share it, so about 2 in ``window - shortest + 2`` positions are
   anchors, and equal windows have equal anchors. The windows of one anchor are its chunk. Rows (anchor hash, chunk hash,
   doc_id) are pre-aggregated by anchor: an anchor of one document alone ends here. Where all chunks of an anchor are equal,
   the whole chunk is a repeat in every document but the least.
2. *Twice that length, again and again up to* ``window``. What lies under anchors that repeat with different chunks is
   extended: a window of the next length is the pair of its two halves (they share a word where the length is odd), is a
   candidate only if both have survived, and survives if another document has it. Levels end where no candidate survives.

Repeats inside one document are found in its own task. No text or group of occurrences is gathered: aggregations keep
minima and maxima, and each document gets back the hashes that it has to drop. Joins back are equi-joins on a hash that
adaptive execution splits where it is hot.

Lists of hashes are kept by doc_id and a hash of the text, so rows that share a doc_id gather nothing of each other.

Defined results: a null text has no words; a null doc_id is the least of all. Rows that share a doc_id are one document as
far as others go: neither is earlier than the other, whether their texts are equal or not. An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import cut
from ..sources.tables import spread
from .text_kernels import SPACED, Words, combine, cover, map_texts, mix, split_words, sums, windows

WINDOW_WORDS = 20
#: Levels start at this many words, or less than twice as many.
FIRST_WORDS = 10
_LEAST = -(2**63)


def lengths(window: int) -> list[int]:
    """Window lengths of the levels in ascending order, each at most twice the one before."""
    out = [window]
    while len(out) == 1 or out[0] >= 2 * FIRST_WORDS:
        out.insert(0, -(-out[0] // 2))
    return out


def _argmin(v: np.ndarray, k: int) -> np.ndarray:
    """Index of the leftmost least value among the k from each place on, by doubling."""
    at, size = np.arange(len(v)), 1

    def better(left: np.ndarray, by: int) -> np.ndarray:
        right = np.full_like(left, -1)
        right[: max(len(left) - by, 0)] = left[by:]
        right = np.where(right < 0, left, right)
        return np.where(v[right] < v[left], right, left)

    while 2 * size <= k:
        at = better(at, size)
        size *= 2
    return better(at, k - size) if size < k else at


def _halves(w: Words, size: int, at: np.ndarray, known: dict[int, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the two halves of the windows of ``size`` words at the given places, which have as many words left."""
    half = -(-size // 2)
    hashed = (known or {}).get(half)
    if hashed is None:
        hashed = windows(w.hash, half)
    return hashed[at], hashed[at + size - half]


class Chunks:
    """Windows of the texts of one pass, their anchors and chunks."""

    def __init__(self, w: Words, window: int):
        shortest = lengths(window)[0]
        short = windows(w.hash, shortest)
        left = w.left()
        self.at = np.flatnonzero(left >= window)
        ranked = np.where(left >= shortest, mix(short), np.uint64(2**64 - 1))
        anchor = _argmin(ranked, window - shortest + 1)[self.at]
        self.whole = combine(*_halves(w, window, self.at, {shortest: short}))
        self.doc = w.doc[self.at]
        new = np.ones(len(self.at), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (self.at[1:] != self.at[:-1] + 1)
        self.start = np.flatnonzero(new)  # of the chunks, in windows
        self.size = np.diff(np.append(self.start, len(self.at)))
        self.chunk = np.cumsum(new) - 1
        head = anchor[self.start]
        self.anchor = short[head]
        self.chunk_doc = self.doc[self.start]
        last = self.start + self.size - 1
        shape = (self.size * (window + 1) + (head - self.at[self.start])).astype(np.uint64)
        self.content = combine(combine(self.whole[self.start], self.whole[last]), mix(shape))


def _first_of_each(*keys: np.ndarray) -> np.ndarray:
    """Indexes of the first of each group of equal keys, in ascending order."""
    if not len(keys[0]):
        return np.zeros(0, dtype=np.int64)
    h = keys[0].astype(np.uint64)
    for k in keys[1:]:
        h = combine(h, k.astype(np.uint64))
    return np.sort(np.unique(h, return_index=True)[1])


def _key(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("d"), F.xxhash64("text").alias("k"), "doc_id", "text")


def _anchors(docs: DataFrame, window: int) -> DataFrame:
    def work(data, offsets, _):
        c = Chunks(split_words(data, offsets, SPACED), window)
        own = _first_of_each(c.anchor, c.content, c.chunk_doc)
        return c.chunk_doc[own], {"anchor": c.anchor[own].view(np.int64), "content": c.content[own].view(np.int64)}

    return map_texts(docs, work, [("anchor", "long"), ("content", "long")], keep={"d": F.col("d"), "k": F.col("k")})


def _windows(docs: DataFrame, window: int, size: int, first: bool) -> DataFrame:
    """(d, k, left, right) of the windows of ``size`` words inside windows under the anchors in the column ``open``; but for the
    first level, only those whose halves both stand in the columns ``left`` and ``right``."""
    lists = ["open"] if first else ["open", "left", "right"]

    def work(data, offsets, part):
        w = split_words(data, offsets, SPACED)
        c = Chunks(w, window)
        under = c.at[_listed(part.column(2), c.chunk_doc, c.anchor)[c.chunk]]
        at = np.flatnonzero(cover(under, under + window - size + 1, len(w.doc)))
        if not first:
            half = -(-size // 2)
            for p in (0, size - half):
                at = at[_pair_listed(part.column(3), part.column(4), combine(*_halves(w, half, at + p)), w.doc[at])]
        left, right = _halves(w, size, at)
        own = _first_of_each(combine(left, right), w.doc[at])
        return w.doc[at[own]], {"left": left[own].view(np.int64), "right": right[own].view(np.int64)}

    keep, also = {"d": F.col("d"), "k": F.col("k")}, {x: F.col(x) for x in lists}
    return map_texts(docs, work, [("left", "long"), ("right", "long")], keep=keep, also=also)


def _listed(column: pa.Array, doc: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether each value stands in the list of its document."""
    flat, owner = _flat(column)
    return np.isin(combine(value, doc.astype(np.uint64)), combine(flat, owner))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, null lists left out, and the row of each."""
    size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), np.repeat(np.arange(len(column)), size).astype(np.uint64)


def repeated_windows(docs: DataFrame, window: int = WINDOW_WORDS) -> tuple[DataFrame, DataFrame]:
    """Two tables by ``d`` (doc_id, null as the least number) and ``k`` (the text's hash): hashes of anchors whose whole chunks repeat an earlier
    document (``closed``) and of those to extend (``open``); and hashes of single windows that repeat one (``again``)."""
    own = _key(docs)
    span = [F.min("d").alias("least"), F.max("d").alias("most")]
    anchors = _anchors(own, window)
    shared = anchors.groupBy("anchor").agg(*span, F.min("content").alias("one"), F.max("content").alias("other")).filter("least < most")
    shared = shared.select("anchor", "least", (F.col("one") != F.col("other")).alias("differs"))
    hit = anchors.select("anchor", "d", "k").join(shared, "anchor").filter("differs or d > least")
    level = hit.groupBy("d", "k").agg(
        F.collect_set(F.when(~F.col("differs"), F.col("anchor"))).alias("closed"), F.collect_set(F.when(F.col("differs"), F.col("anchor"))).alias("open")
    )
    level = cut(level)
    alive = level.filter(F.size("open") > 0).select("d", "k", "open")
    for i, size in enumerate(lengths(window)[1:]):
        pairs = _windows(own.join(alive.hint("shuffle_hash"), ["d", "k"]), window, size, i == 0)
        both = pairs.groupBy("left", "right").agg(*span).filter("least < most").select("left", "right", "least")
        again = pairs.join(both, ["left", "right"])
        if size == window:
            again = again.filter("d > least")
        # A window's own hash is made from its two halves in the task, as Chunks does.
        again = cut(again.groupBy("d", "k").agg(F.collect_list("left").alias("left"), F.collect_list("right").alias("right")))
        if size < window:
            if again.isEmpty():
                break
            alive = level.select("d", "k", "open").join(again, ["d", "k"])
    return level, again


def dedup_substrings(docs: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, and text: the kept words joined by one space."""
    level, again = repeated_windows(docs, window)
    marks = level.select("d", "k", "closed").join(again, ["d", "k"], "full")
    joined = _key(docs).join(marks.hint("shuffle_hash"), ["d", "k"], "left")

    def work(data, offsets, part):
        w = split_words(data, offsets, SPACED)
        c = Chunks(w, window)
        gone = _listed(part.column(1), c.chunk_doc, c.anchor)[c.chunk] if len(c.at) else np.zeros(0, dtype=bool)
        later = np.ones(len(c.at), dtype=bool)
        later[_first_of_each(c.whole, c.doc)] = False
        gone = gone | later | _pair_listed(part.column(2), part.column(3), c.whole, c.doc)
        at = c.at[gone]
        removed = cover(at, at + window, len(w.doc))
        kept, offset = join_words(w, ~removed)
        text = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offset.astype(np.int32)), pa.py_buffer(kept))
        return None, {"n_words": w.counts, "n_removed": sums(removed, w.first), "text": text}

    also = {x: F.col(x) for x in ("closed", "left", "right")}
    return map_texts(joined, work, [("n_words", "long"), ("n_removed", "long"), ("text", "string")], keep={"doc_id": F.col("doc_id")}, also=also)


def _pair_listed(left: pa.Array, right: pa.Array, value: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether each window, by the hash of its halves, stands in the lists of its document."""
    (a, owner), (b, _) = _flat(left), _flat(right)
    return np.isin(combine(value, doc.astype(np.uint64)), combine(combine(a, b), owner))


def join_words(w: Words, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words of each text joined by single spaces, and the texts' offsets."""
    at = np.flatnonzero(kept)
    length, doc = (w.end - w.start)[at], w.doc[at]
    gap = np.ones(len(at), dtype=np.int64)
    gap[: 1] = 0
    gap[1:][doc[1:] != doc[:-1]] = 0
    size = length + gap
    offset = np.concatenate(([0], np.cumsum(np.bincount(doc, weights=size, minlength=len(w.first) - 1).astype(np.int64))))
    out = np.full(int(size.sum()), 0x20, dtype=np.uint8)
    to = np.cumsum(size) - length
    step = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(to, length) + step] = w.data[np.repeat(w.start[at], length) + step]
    return out, offset


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_substrings(spread(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
a AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS r FROM g) WHERE r > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM a),
k AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS kept, count(*) AS n FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d) u ANTI JOIN c USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""
