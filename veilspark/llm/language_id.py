"""Language ID: multinomial naive Bayes over hashed character n-grams.

Grams of 1 to 4 characters of the lower-cased (A-Z) text are hashed into ``BUCKETS``; grams without any letter are left out.
Training counts them for each language over at most ``MAX_TRAIN_DOCS`` whole texts (those with the smallest hashes of doc_id, text and language
among the training rows); the smoothed log-probability matrix (BUCKETS x languages) is broadcast, and its size is fixed.
Scoring gathers the matrix rows of all grams of a batch and sums them by text: a sparse count matrix times a dense one.

Defined results: a null text, one without a letter, or a table without training rows gives ``und`` and score 0. Ties go to
the language that sorts first. A null doc_id counts as the text ''. Repeated rows are predicted once each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import spread
from .text_kernels import LOWER, map_texts

BUCKETS = 1 << 15
GRAMS = (1, 2, 3, 4)
MAX_TRAIN_DOCS = 12_000
SMOOTHING = 0.5
FOLDS, HELD_OUT = 3, 1
_MIX = np.uint32(0x9E3779B1)


def characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 texts, A-Z lowered, and the texts' offsets in them."""
    head = np.flatnonzero((data & 0xC0) != 0x80)
    first = data[head].astype(np.uint32)
    code = LOWER[data[head]].astype(np.uint32)
    for lead, bits, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        own = np.flatnonzero(first >= lead)
        value = first[own] & bits
        for j in range(1, more + 1):
            value = value << np.uint32(6) | data[np.minimum(head[own] + j, len(data) - 1)] & np.uint32(0x3F)
        code[own] = value
    return code, np.searchsorted(head, offsets)


def gram_buckets(code: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """For each gram length the bucket of the gram at each character (BUCKETS: none); and which characters are letters."""
    letter = (code >= 0x61) & (code <= 0x7A) | (code >= 0x80)
    # Other characters than letters all count as one separator, so that n-grams see word borders.
    code = np.where(letter, code, np.uint32(0x20))
    to_end = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(code))
    out, h, some = [], np.zeros(len(code), dtype=np.uint32), np.zeros(len(code), dtype=bool)
    for k in range(max(GRAMS)):
        shifted, flags = np.zeros_like(code), np.zeros_like(letter)
        shifted[: max(len(code) - k, 0)] = code[k:]
        flags[: max(len(code) - k, 0)] = letter[k:]
        h = (h ^ shifted) * _MIX
        h ^= h >> np.uint32(15)
        some = some | flags
        if k + 1 in GRAMS:
            bucket = (h >> np.uint32(7)) & np.uint32(BUCKETS - 1)
            bucket[~some | (to_end <= k)] = BUCKETS
            out.append(bucket)
    return out, letter


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray  # (BUCKETS + 1, languages); the last row is zero


def train(docs: DataFrame, is_training: Column, max_docs: int = MAX_TRAIN_DOCS) -> Model | None:
    """Counts grams by language over the chosen training rows in Spark; at most BUCKETS counts a language reach the driver."""
    own = docs.filter(is_training & F.col("lang").isNotNull() & F.col("text").isNotNull())
    own = own.select(F.xxhash64(F.col("doc_id").cast("string"), "text", F.col("lang").cast("string")).alias("h"), "text", "lang")
    # The max_docs smallest hashes; of rows that are equal one takes part.
    bound = own.select("h").orderBy("h").limit(max_docs).agg(F.max("h")).first()[0]
    if bound is None:
        return None

    def work(data, offsets, part):
        names = part.column(0).to_pylist()
        code, offsets = characters(data, offsets)
        doc = np.repeat(np.arange(len(names)), np.diff(offsets))
        languages = sorted(set(names))
        of = np.array([languages.index(x) for x in names])[doc] if len(doc) else doc
        count = np.zeros((len(languages), BUCKETS + 1), dtype=np.int64)
        for bucket in gram_buckets(code, offsets)[0]:
            count += np.bincount(of * (BUCKETS + 1) + bucket, minlength=count.size).reshape(count.shape)
        count = count[:, :-1]
        i, j = np.nonzero(count)
        rows = [names.index(x) for x in languages]
        return np.array(rows, dtype=np.int64)[i], {"bucket": j.astype(np.int32), "n": count[i, j]}

    chosen = own.filter(F.col("h") <= F.lit(bound)).dropDuplicates(["h"])
    counts = map_texts(chosen, work, [("bucket", "int"), ("n", "long")], keep={"lang": F.col("lang").cast("string")})
    summed = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    prior = {r.lang: r.n for r in chosen.groupBy(F.col("lang").cast("string").alias("lang")).agg(F.count("*").alias("n")).collect()}
    languages = sorted(prior)
    table = np.full((BUCKETS, len(languages)), SMOOTHING)
    place = {x: i for i, x in enumerate(languages)}
    table[summed["bucket"].to_numpy(), [place[x] for x in summed["lang"].to_pylist()]] += summed["n"].to_numpy()
    log_prob = np.vstack([np.log(table / table.sum(axis=0)), np.zeros((1, len(languages)))]).astype(np.float32)
    total = np.array([prior[x] for x in languages], dtype=np.float64)
    return Model(languages, np.log(total / total.sum()), log_prob)


def predict(docs: DataFrame, model: Model | None, keep: dict | None = None) -> DataFrame:
    """One row per document: the ``keep`` columns (doc_id), lang_pred and score, the posterior of that language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(data, offsets, _):
        m, n = shared.value, len(offsets) - 1
        code, offsets = characters(data, offsets)
        buckets, letter = gram_buckets(code, offsets)
        some = np.add.reduceat(np.append(letter, False).astype(np.int64), offsets[:-1]) * (np.diff(offsets) > 0) if n else np.zeros(0)
        for d in np.flatnonzero(some):
            span = code[offsets[d] : offsets[d + 1]]
            if not ((span >= 0x61) & (span <= 0x7A)).any():
                some[d] = any(chr(c).isalpha() for c in np.unique(span))
        if m is None:
            return None, {"lang_pred": pa.array(["und"] * n), "score": np.zeros(n)}
        total = np.tile(m.log_prior, (n, 1))
        full = np.flatnonzero(np.diff(offsets))
        for i in range(len(m.languages)):
            column = np.ascontiguousarray(m.log_prob[:, i])
            value = column[buckets[0]]
            for bucket in buckets[1:]:
                value += column[bucket]
            if len(full):
                total[full, i] += np.add.reduceat(value.astype(np.float64), offsets[full])
        best = total.argmax(axis=1)
        score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        names = np.array([*m.languages, "und"], dtype=object)[np.where(some > 0, best, len(m.languages))]
        return None, {"lang_pred": pa.array(names, pa.string()), "score": np.where(some > 0, score, 0.0)}

    return map_texts(docs, work, [("lang_pred", "string"), ("score", "double")], keep=keep)


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    model = train(docs.select("doc_id", "text", "lang"), ~held_out())
    return predict(docs, model, keep={"doc_id": F.col("doc_id"), "held_out": held_out()})
