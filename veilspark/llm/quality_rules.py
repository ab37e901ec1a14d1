r"""Quality rules: base rules and gradient-boosted trees over document statistics.

Statistics of a whole text come from vectorised passes over its words (``[^\x20\x09-\x0D]+``). Two base rules reject a text
outright; the others are judged by boosted trees. The trees are fitted on the driver on a bounded sample of labelled rows
(``MAX_TRAIN_ROWS``, chosen by a hash of doc_id), with monotonic constraints on chosen features, then flattened into numpy
node arrays of fixed size, which tasks use to score all rows of a batch level by level. All else covers every document.

Defined results: null or empty text has zero words and so fails the base rules. Labels without a matching document, with
null quality, or repeated for one doc_id are used once each at most. Without labels of both classes no tree is fitted and
only the base rules decide (score 1). Ties in a split's gain go to the first feature and the lowest cut.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import spread
from .text_kernels import SPACED, combine, cover, map_texts, runs, split_words, sums, windows

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_TRAIN_ROWS = 20_000
TREES, DEPTH, BINS, RATE, LAMBDA, MIN_LEAF = 40, 3, 64, 0.2, 1.0, 20
KEEP_SCORE = 0.5

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_punct", "n_vocab", "n_letters"]
#: Features of the trees, and how the score may move as each grows: 1 up only, -1 down only, 0 freely.
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": 0,
    "digit_share": 0, "punct_share": 0, "vocab_share": 0, "letter_share": 0,
}
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", dtype=np.uint8))
_UPPER = np.array([0x41 <= b <= 0x5A for b in range(256)])
_DIGIT = np.array([0x30 <= b <= 0x39 for b in range(256)])
_LETTER = np.array([0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0xC0 for b in range(256)])
_PUNCT = np.array([chr(b) in ".,;:!?\"'()-" for b in range(256)])
_POINT = np.array([not 0x80 <= b <= 0xBF for b in range(256)])


def statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The COUNTS of each text."""
    w = split_words(data, offsets, SPACED)
    n = len(offsets) - 1
    count = lambda table: sums(table[data], offsets)
    # Lines: the sequence of words between line feeds stands for the line only where its bytes agree, so hash the bytes.
    feeds = np.flatnonzero(data == 0x0A)
    inner = offsets[1:-1]
    line_start = np.unique(np.concatenate(([0], feeds + 1, inner))).astype(np.int64)
    line_start = line_start[line_start < len(data)] if len(data) else line_start[:0]
    line_doc = np.searchsorted(offsets, line_start, side="right") - 1
    if len(line_start):
        line_hash = _line_hashes(data, line_start, offsets)
        filled = np.searchsorted(w.start, np.append(line_start[1:], len(data))) > np.searchsorted(w.start, line_start)
        dup = _again(combine(line_hash, line_doc.astype(np.uint64)), filled)
        n_dup = np.bincount(line_doc[dup], minlength=n)
        n_lines = np.bincount(line_doc[filled], minlength=n)
    else:
        n_dup = n_lines = np.zeros(n, dtype=np.int64)
    whole = np.flatnonzero(w.left() >= 3)
    key = combine(windows(w.hash, 3), w.doc.astype(np.uint64))[whole]
    order = np.argsort(key)
    edge = runs(key[order])
    many = np.repeat(np.diff(edge) > 1, np.diff(edge))
    at = whole[order[many]]
    repeated = cover(at, at + 3, len(w.doc))
    vocab = np.unique(combine(w.hash, w.doc.astype(np.uint64)), return_index=True)[1]
    return {
        "n_words": w.counts, "word_chars": count(_POINT & SPACED), "n_symbols": count(_SYMBOL), "n_dup_lines": n_dup,
        "n_repeat_words": sums(repeated, w.first), "n_lines": n_lines, "n_upper": count(_UPPER), "n_digits": count(_DIGIT),
        "n_punct": count(_PUNCT), "n_vocab": np.bincount(w.doc[vocab], minlength=n), "n_letters": count(_LETTER),
    }


def _line_hashes(data: np.ndarray, start: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each line without its line feed: a line is one word of the table of all bytes but the feed."""
    w = split_words(data, offsets, np.arange(256) != 0x0A)
    out = np.zeros(len(start), dtype=np.uint64)
    out[np.searchsorted(start, w.start)] = w.hash
    return out


def _again(key: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Indexes of the places among ``which`` whose key stood at an earlier one."""
    at = np.flatnonzero(which)
    first = np.unique(key[at], return_index=True)[1]
    later = np.ones(len(at), dtype=bool)
    later[first] = False
    return at[later]


def features(c: dict[str, np.ndarray]) -> np.ndarray:
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    return np.column_stack([
        np.log1p(c["n_words"]), chars / words, c["n_symbols"] / words, c["n_dup_lines"] / np.maximum(c["n_lines"], 1),
        c["n_repeat_words"] / words, c["n_upper"] / chars, c["n_digits"] / chars, c["n_punct"] / words, c["n_vocab"] / words, c["n_letters"] / chars,
    ]).astype(np.float64)


@dataclass
class Trees:
    """Complete binary trees of one depth as arrays of shape (trees, nodes); a leaf above the last level repeats its value."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        row = np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[row, feature[node]] > cut[node])
            out += value[node - len(feature)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray) -> Trees | None:
    """Boosted trees for the chance of y = 1. A split of a constrained feature that runs against its direction is not taken,
    and the values of the two sides then bound those of the nodes below, so that the whole sum is monotonic."""
    if len(y) < 2 * MIN_LEAF or not 0 < y.mean() < 1:
        return None
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(x.shape[1])])
    direction = list(FEATURES.values())
    base = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(len(y), base)
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    feature, cut, value = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        f, c, v = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf), np.zeros(leaves)
        node = np.zeros(len(y), dtype=np.int64)
        bound = {0: (-np.inf, np.inf)}
        for k in range(inner):
            at = np.flatnonzero(node == k)
            low, high = bound[k]
            best = (1e-6, 0, np.inf, None)
            if len(at) >= 2 * MIN_LEAF:
                whole_g, whole_h = g[at].sum(), h[at].sum()
                for j in range(x.shape[1]):
                    if not len(cuts[j]):
                        continue
                    left_g, left_h, left_n = (np.cumsum(np.bincount(binned[at, j], weights=z, minlength=len(cuts[j]) + 1))[:-1] for z in (g[at], h[at], np.ones(len(at))))
                    a = np.clip(left_g / (left_h + LAMBDA), low, high)
                    b = np.clip((whole_g - left_g) / (whole_h - left_h + LAMBDA), low, high)
                    gain = left_g**2 / (left_h + LAMBDA) + (whole_g - left_g) ** 2 / (whole_h - left_h + LAMBDA) - whole_g**2 / (whole_h + LAMBDA)
                    gain[(left_n < MIN_LEAF) | (len(at) - left_n < MIN_LEAF) | ((b - a) * direction[j] < 0)] = -1
                    i = int(np.argmax(gain))
                    if gain[i] > best[0]:
                        best = (gain[i], j, cuts[j][i], (a[i], b[i]))
            f[k], c[k] = best[1], best[2]
            node[at] = 2 * k + 1 + (x[at, f[k]] > c[k])
            left = right = (low, high)
            if best[3] and direction[f[k]]:
                middle = sum(best[3]) / 2
                left, right = ((low, middle), (middle, high)) if direction[f[k]] > 0 else ((middle, high), (low, middle))
            bound[2 * k + 1], bound[2 * k + 2] = left, right
        for k in range(leaves):
            at = np.flatnonzero(node == inner + k)
            low, high = bound[inner + k]
            v[k] = RATE * np.clip(g[at].sum() / (h[at].sum() + LAMBDA), low, high) if len(at) else RATE * np.clip(0, low, high)
        margin += v[node - inner]
        feature.append(f)
        cut.append(c)
        value.append(v)
    return Trees(np.array(feature), np.array(cut), np.array(value), base)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> Trees | None:
    """Fits on at most ``max_rows`` labelled documents with the smallest hashes of doc_id; their statistics, not texts, come
    to the driver."""
    own = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = own.withColumn("_h", F.xxhash64("doc_id")).orderBy("_h", "doc_id").limit(max_rows).drop("_h")
    labelled = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def work(data, offsets, part):
        return None, statistics(data, offsets)

    keep = {"doc_id": F.col("doc_id"), "quality": F.col("quality")}
    # A bounded number of rows of a few numbers each. Of documents that share a doc_id the one with the least numbers is used.
    rows = map_texts(labelled, work, [(c, "long") for c in COUNTS], keep=keep)
    least = rows.groupBy("doc_id", "quality").agg(F.min(F.struct(*COUNTS)).alias("s")).select("doc_id", "quality", "s.*")
    table = least.orderBy("doc_id").limit(max_rows).toArrow()
    stats = {c: table[c].to_numpy() for c in COUNTS}
    return fit(features(stats), (table["quality"].to_numpy() > 0).astype(np.float64))


def judge(docs: DataFrame, trees: Trees | None, keep: dict | None = None, min_score: float = KEEP_SCORE) -> DataFrame:
    """One row per document: the ``keep`` columns (doc_id), COUNTS, base_failed, score (0 to 1) and kept."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def work(data, offsets, _):
        c = statistics(data, offsets)
        failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
        score = shared.value.score(features(c)) if shared.value else np.ones(len(failed))
        return None, c | {"base_failed": pa.array(failed), "score": score, "kept": pa.array(~failed & (score >= min_score))}

    return map_texts(docs, work, [(c, "long") for c in COUNTS] + [("base_failed", "boolean"), ("score", "double"), ("kept", "boolean")], keep=keep)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    trees = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge(docs, trees).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
