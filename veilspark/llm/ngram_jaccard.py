"""N-gram Jaccard join with count vectors in an R-tree: links and their components over whole texts.

A document's set holds the hashes of its distinct word n-grams. Documents with equal sets are one class; the join is between
classes, and each document gets its class back. For sets with ``100 * shared >= percent * union``:

1. *Keys.* Both sides share one of their first ``n - ceil(percent * n / 100) + 1`` hashes in any fixed order. The order puts
   hashes that are frequent in a bounded sample of documents last, so that popular passages are no keys, and of the others those of
   rare words first: grams of common words meet by chance, the more often the more documents there are. The sample steers the
   work, not the result. Keys of a single class end in a pre-aggregated minimum and maximum; of keys that the same classes share, as
   those of copies and of quoted passages are, one stays.
2. *R-tree.* Hashes fall into ``GROUPS`` groups, and the counts by group are a class's point. Points under one key are packed by
   size into leaves that keep their coordinates' maxima. A leaf, then a point, is dropped where the summed coordinate minima
   with the query stay below the overlap that a link needs. What survives is reduced in the task to a spanning forest, so a key
   gives fewer rows than it has points. Keys of more than ``HOT`` points grow a tree of as many levels as they need: each task ties
   the boxes of one block and hands up one box for each label, with the maxima of all its points.
3. *Finer points.* Components of the forests hold all links inside. Their classes get points of ``FINE`` groups, which tell long
   sets apart, and the same bounds split the components again. Only what is still tied ships its sets.
4. *Verification.* In both of these steps large components are cut into bands of set sizes so wide that a
   link stays in a band or joins two neighbours, and bands into blocks of bounded size. Every pair of blocks of a band or of
   neighbours is one task, which at last counts the exact overlaps and returns a spanning forest of the links.

Keys stream through tasks in sorted order, blocks are bounded, and components come from joins that spread the least label, with
tables written to the shared folder between rounds. No task holds more than ``HOT`` points of a key or two blocks of one.

Defined results: a null text or one without words has an empty set and links with nothing, copies included. With fewer words
than the n-gram has, the whole sequence is the one gram. A null doc_id is the least of all and comes back as null. Rows that
repeat a doc_id are reported once each. Sets are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import cut
from ..sources.tables import spread
from .text_kernels import SPACED, Words, combine, map_texts, mix, runs, split_words, windows

SHINGLE, PERCENT = 4, 85
GROUPS, FINE = 256, 1024
#: The highest bits of a hash, which name its group.
_GROUP, _FINE = (np.uint64(64 - (n - 1).bit_length()) for n in (GROUPS, FINE))
LEAF = 32
#: Sets and hashes of a block, about.
BLOCK, BLOCK_HASHES = 512, 2_000_000
#: Keys of more points than this go up a tree of several levels; those of others are compared in one task.
HOT = 2_000
SAMPLE_DOCS, SAMPLE_HITS = 5_000, 4
#: Bits of a word's hash that name its slot in the table of levels, and levels for each doubling of how often its words stand in the sample.
SLOT_BITS, STEPS = 18, 2
_LEAST = -(2**63)
_OTHER = np.uint64(0x5851F42D4C957F2D)


def gram_sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, hash) of the distinct grams, sorted, and each document's class hash."""
    return weighed_sets(split_words(data, offsets, SPACED, lower=True), shingle)[:3]


def weighed_sets(w: Words, shingle: int, levels: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
    """The same, and with ``levels`` each gram's weight: the sum of its words' levels."""
    n, left = w.counts, w.left()
    at, size = np.flatnonzero(left >= shingle), shingle
    value, doc = windows(w.hash, shingle)[at], w.doc[at]
    for k in range(1, shingle):
        few = w.first[:-1][n == k]
        value, doc = np.concatenate((value, windows(w.hash, k)[few])), np.concatenate((doc, w.doc[few]))
        at, size = np.concatenate((at, few)), np.concatenate((np.broadcast_to(size, len(at)), np.full(len(few), k)))
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    first = np.ones(len(doc), dtype=bool)
    first[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    value, doc = value[first], doc[first]
    count = np.bincount(doc, minlength=len(n)).astype(np.uint64)
    name = combine(_sum_by(mix(value), doc, len(count)), _sum_by(mix(value ^ _OTHER), doc, len(count)) + count)
    if levels is None:
        return doc, value, name, None
    total = np.concatenate(([0], np.cumsum(levels[slots(w.hash)], dtype=np.int64)))
    return doc, value, name, (total[at + size] - total[at])[order][first]


def slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _sum_by(value: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, dtype=np.uint64)
    edge = runs(doc)
    if len(doc):
        out[doc[edge[:-1]]] = np.add.reduceat(value, edge[:-1])
    return out


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("d"), F.xxhash64("text").alias("x"), F.col("text"))


def _heads(docs: DataFrame, shingle: int, percent: int, sampled) -> DataFrame:
    """(d, x, n, c, point, keys) of each document: doc_id, the text's hash, set size, class, group counts (255: that many or more), and the first hashes of
    the set in the order that the sample steers."""

    def work(data, offsets, _):
        often, grade, levels = sampled.value
        doc, value, name, weight = weighed_sets(split_words(data, offsets, SPACED, lower=True), shingle, levels)
        rows = len(offsets) - 1
        group = (value >> _GROUP).astype(np.int64)
        counts = np.bincount(doc * GROUPS + group, minlength=rows * GROUPS).reshape(rows, GROUPS)
        points = np.minimum(counts, 255).astype(np.uint8).tobytes()
        point = pa.array([points[i * GROUPS : (i + 1) * GROUPS] for i in range(rows)], pa.binary())
        if len(often) and len(value):
            at = np.minimum(np.searchsorted(often, value), len(often) - 1)
            weight += np.where(often[at] == value, grade[at], 0) * (int(levels.max()) * shingle + 1)
        n = np.bincount(doc, minlength=rows).astype(np.int64)
        order = np.argsort(doc * (int(weight.max(initial=0)) + 1) + weight, kind="stable")  # values are sorted within a document
        rank = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
        size = np.where(n > 0, n - -(-percent * n // 100) + 1, 0)
        own = order[rank < np.repeat(size, n)]
        keys = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))), pa.int32()), pa.array(value[own].view(np.int64)))
        return None, {"n": n, "c": name.view(np.int64), "point": point, "keys": keys}

    keep = {x: F.col(x) for x in docs.columns if x != "text"}
    return map_texts(docs, work, [("n", "long"), ("c", "long"), ("point", "binary"), ("keys", "array<long>")], keep=keep)


def _sampled(docs: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of at most SAMPLE_DOCS documents: the sorted hashes of grams that stand in SAMPLE_HITS of them and the grade of each, which grows
    with every doubling; and the level of each slot of words. All are bounded by the sample."""
    levels, none = np.zeros(1 << SLOT_BITS, dtype=np.uint8), np.zeros(0, dtype=np.uint64)
    own = docs.select("d", "text", F.xxhash64("d", "text").alias("h"))
    bound = own.select("h").orderBy("h").limit(SAMPLE_DOCS).agg(F.max("h")).first()[0]
    if bound is None:
        return none, none.astype(np.int64), levels

    def work(data, offsets, _):
        w = split_words(data, offsets, SPACED, lower=True)
        doc, value, *_ = weighed_sets(w, shingle)
        slot, k = np.unique(slots(w.hash), return_counts=True)
        here = np.zeros(len(slot), dtype=np.int64)  # counted for the texts of a pass together
        word = np.arange(len(doc) + len(slot)) >= len(doc)
        return np.concatenate((doc, here)), {"g": np.concatenate((value.view(np.int64), slot)), "word": word, "k": np.concatenate((np.ones(len(doc), dtype=np.int64), k))}

    grams = map_texts(own.filter(F.col("h") <= F.lit(bound)).dropDuplicates(["h"]), work, [("g", "long"), ("word", "boolean"), ("k", "long")], keep={"d": F.col("d")})
    found = grams.groupBy("word", "g").agg(F.sum("k").alias("k")).filter(F.col("word") | (F.col("k") >= SAMPLE_HITS)).toArrow()
    word, g, k = (found[c].to_numpy() for c in ("word", "g", "k"))
    levels[g[word]] = np.round(STEPS * np.log2(1 + k[word]))
    often, k = g[~word].astype(np.int64).view(np.uint64), k[~word]
    order = np.argsort(often)
    return often[order], np.log2(k[order] * (2 / SAMPLE_HITS)).astype(np.int64), levels


def _needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of a link between sets of sizes a and b."""
    return -(-percent * (a + b) // (100 + percent))


def survivors(point: np.ndarray, low: np.ndarray, percent: int, high: np.ndarray | None = None) -> np.ndarray:
    """Label of each box: boxes in one label are tied by pairs that the bounds let pass. A box has the maxima of its points'
    coordinates and their least and largest set size; a point is a box with one size. Boxes are sorted by ``low``.

    A level of a packed R-tree: box i asks the leaves before it whose sizes fit, then their boxes that aren't tied to it yet."""
    m = len(low)
    high = low if high is None else high
    full = (point == 255).any(axis=1)
    point = point.astype(np.int16)
    label = np.arange(m)
    top = np.stack([point[k : k + LEAF].max(axis=0) for k in range(0, m, LEAF)])
    top_full = np.array([full[k : k + LEAF].any() for k in range(0, m, LEAF)])
    least = low[::LEAF]
    most = np.array([high[k : k + LEAF].max() for k in range(0, m, LEAF)])
    for i in range(1, m):
        leaves = np.arange(i // LEAF + (i % LEAF > 0))
        leaves = leaves[100 * most[leaves] >= percent * low[i]]
        bound = np.minimum(top[leaves], point[i]).sum(axis=1)
        leaves = leaves[(bound >= _needed(least[leaves], low[i], percent)) | top_full[leaves] | full[i]]
        if not len(leaves):
            continue
        j = (leaves[:, None] * LEAF + np.arange(LEAF)).ravel()
        j = j[j < i]
        j = j[(100 * high[j] >= percent * low[i]) & (label[j] != label[i])]
        bound = np.minimum(point[j], point[i]).sum(axis=1)
        j = j[(bound >= _needed(low[j], low[i], percent)) | full[j] | full[i]]
        if len(j):
            tied = np.append(np.unique(label[j]), label[i])
            label[np.isin(label[: i + 1], tied).nonzero()[0]] = tied.min()
    return label


_BOX = "key long, c long, low long, high long, point binary"


def _hot_forests(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): the same as ``_forests`` for keys of many points, by an R-tree that grows level by level. On each level the boxes of a
    key are dealt to tasks of about BLOCK, which tie them and hand one box of each label up. Where boxes stop falling by a fifth,
    all pairs of blocks are compared, each in a task of its own."""
    boxes = members.select("key", "c", F.col("n").alias("low"), F.col("n").alias("high"), "point")
    out = None

    def tie(table: pa.Table) -> pa.Table:
        own = {x: table[x].to_numpy() for x in ("key", "c", "low", "high")}
        order = np.lexsort((own["c"], own["low"]))
        order = order[np.append(True, own["c"][order][1:] != own["c"][order][:-1])]
        own = {x: v[order] for x, v in own.items()}
        point = np.frombuffer(b"".join(table["point"].take(pa.array(order)).to_pylist()), dtype=np.uint8).reshape(-1, GROUPS)
        label = survivors(point, own["low"], percent, own["high"])
        by = np.argsort(label, kind="stable")
        head = runs(label[by])[:-1]
        tops = np.maximum.reduceat(point[by], head, axis=0).tobytes()
        row = by[head]
        other = np.flatnonzero(label != np.arange(len(label)))
        up, tied = len(head), len(other)
        none = pa.nulls(tied, pa.int64())
        whole = lambda first, last: pa.concat_arrays([pa.array(first, pa.int64()), last if isinstance(last, pa.Array) else pa.array(last, pa.int64())])
        return pa.table({
            "key": whole(own["key"][row], own["key"][other]), "c": whole(own["c"][row], own["c"][label[other]]), "low": whole(own["low"][row], none),
            "high": whole(np.maximum.reduceat(own["high"][by], head), none), "b": whole(pa.nulls(up, pa.int64()), own["c"][other]),
            "point": pa.array([tops[i * GROUPS : (i + 1) * GROUPS] for i in range(up)] + [None] * tied, pa.binary()),
        })

    def level(given: DataFrame, *by: str) -> tuple[DataFrame, DataFrame]:
        done = cut(given.groupBy("key", *by).applyInArrow(tie, f"{_BOX}, b long"))
        return done.filter("b is null").drop("b"), done.filter("b is not null").select(F.col("c").alias("a"), "b")

    before = None
    while True:
        sizes = cut(boxes.groupBy("key").agg(F.count("*").alias("n"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")))
        total, most = sizes.agg(F.sum("n"), F.max("blocks")).first()
        if not total:
            return members.select(F.col("c").alias("a"), F.col("c").alias("b")).limit(0) if out is None else out
        dealt = _salted(boxes, sizes.drop("n"), "key", "c").withColumn("block", F.pmod(F.xxhash64("c", F.lit(total)), F.col("blocks")).cast("int"))
        last = before is not None and total > 0.8 * before
        if last and most > 1:  # the bounds part most boxes: every pair of blocks has a task
            pairs = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns({"i": F.least("block", "o"), "j": F.greatest("block", "o")})
            ups, edges = level(pairs.drop("o", "block", "blocks"), "i", "j")
        else:
            ups, edges = level(dealt.drop("blocks"), "block")
        out = edges if out is None else out.unionByName(edges)
        if most == 1 or last:
            return out
        boxes, before = _salted(ups, sizes.filter("blocks > 1").select("key"), "key", "c"), total


def _salted(many: DataFrame, few: DataFrame, on: str, by: str, salts: int = 16) -> DataFrame:
    """Joins rows with a small table of which one row may meet very many: rows of one value are dealt to ``salts`` tasks."""
    small = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return many.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int")).join(small, [on, "_salt"]).drop("_salt")


def _forests(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): under each key the spanning forest of the classes that the bounds let pass. ``members`` (key, n, c, point)
    comes sorted by key, n and c in partitions that hold keys whole."""

    def tie(n, c, point):
        label = survivors(point, n, percent)
        other = label != np.arange(len(label))
        return c[label[other]], c[other]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple] = []

        def closed(parts, last):
            key, n, c, point = (np.concatenate(x) for x in zip(*parts, strict=True))
            edge = runs(key)
            size = np.diff(edge)
            if not last:
                edge, size = edge[:-1], size[:-1]
            a, b = [], []
            two = edge[: len(size)][size == 2]
            if len(two):
                both = np.minimum(point[two].astype(np.int16), point[two + 1]).sum(axis=1)
                full = ((point[two] == 255) | (point[two + 1] == 255)).any(axis=1)
                fits = (100 * n[two] >= percent * n[two + 1]) & ((both >= _needed(n[two], n[two + 1], percent)) | full)
                a.append(c[two[fits]])
                b.append(c[two[fits] + 1])
            for i in np.flatnonzero(size > 2):
                x, y = tie(*(z[edge[i] : edge[i + 1]] for z in (n, c, point)))
                a.append(x)
                b.append(y)
            rest = [] if last or not len(key) else [tuple(x[edge[-1] :] for x in (key, n, c, point))]
            none = np.zeros(0, dtype=np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *a])), pa.array(np.concatenate([none, *b]))], names=["a", "b"]), rest

        for batch in batches:
            key, n, c = (batch.column(i).to_numpy() for i in range(3))
            if not len(key):
                continue
            point = np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype=np.uint8).reshape(-1, GROUPS)
            whole_run = bool(kept) and key[0] == key[-1] == kept[-1][0][-1]
            kept.append((key, n, c, point))
            if not whole_run:
                out, kept = closed(kept, False)
                yield out
        if kept:
            yield closed(kept, True)[0]

    return members.mapInArrow(task, "a long, b long").filter("a <> b")


def components(edges: DataFrame) -> DataFrame:
    """(v, label): for every end of an edge (a, b) the least number that its component holds. Each round takes the least label
    around every vertex and then that label's own label, until none moves."""
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy(F.col("a").alias("v")).agg(F.least(F.col("v"), F.min("b")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("v").alias("b"), "label"), "b").groupBy(F.col("a").alias("v")).agg(F.min("label").alias("least"))
        least = labels.join(near, "v").select("v", F.col("label").alias("was"), F.least("label", "least").alias("label"))
        jump = labels.select(F.col("v").alias("label"), F.col("label").alias("next"))
        moved = cut(least.join(jump, "label", "left").select("v", "was", F.least("label", "next").alias("label")))
        if moved.filter("label <> was").isEmpty():
            return labels
        labels = moved.select("v", "label")


def _blocks(clusters: DataFrame, percent: int) -> DataFrame:
    """``clusters`` (cluster, c, d, x, n) with the band of each set and the blocks of its band and of both neighbours."""
    all_of = clusters.groupBy("cluster").agg((F.count("*") <= BLOCK).alias("small"), F.sum("n").alias("hashes"))
    small = all_of.select("cluster", (F.col("small") & (F.col("hashes") <= BLOCK_HASHES)).alias("small"))
    width = math.log(100 / percent) + 0.001  # sizes of a link differ by less than this in their logarithms
    banded = _salted(clusters, small, "cluster", "c").withColumn("band", F.when(F.col("small"), 0).otherwise(F.floor(F.log(F.col("n")) / width)).cast("int")).drop("small")
    sizes = banded.groupBy("cluster", "band").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_HASHES)).cast("int").alias("blocks"))
    plan = sizes.groupBy("cluster").agg(F.map_from_entries(F.collect_list(F.struct("band", "blocks"))).alias("plan"))  # a few bands for each power of two
    at = lambda step: F.coalesce(F.try_element_at("plan", F.col("band") + step), F.lit(0))
    return _salted(banded, plan, "cluster", "c").select("d", "x", "c", "cluster", "band", at(0).alias("blocks"), at(-1).alias("below"), at(1).alias("above"))


def _deals() -> Column:
    """The tasks (lo, hi, i, j) that a set goes to, with its side there: the pairs of its block with each of its band's and of
    the neighbours' blocks."""
    own, band = F.col("own"), F.col("band")

    def each(blocks: str, make) -> Column:
        some = F.col(blocks) > 0
        return F.when(some, F.transform(F.sequence(F.lit(0), F.greatest(F.col(blocks), F.lit(1)) - 1), make)).otherwise(F.array())

    def one(lo, hi, i, j, side) -> Column:
        return F.struct(lo.alias("lo"), hi.alias("hi"), i.alias("i"), j.alias("j"), side.alias("side"))

    return F.concat(
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: one(band, band, F.least(own, o), F.greatest(own, o), own)),
        each("above", lambda o: one(band, band + 1, own, o, band)),
        each("below", lambda o: one(band - 1, band, o, own, band)),
    )


def _dealt(docs: DataFrame, wanted: DataFrame, shingle: int, fields: list[tuple[str, str]], make) -> DataFrame:
    """The rows of each task: (cluster, lo, hi, i, j), own (the side), c and what ``make(doc, value, rows)`` gives for each text."""

    def work(data, offsets, part):
        doc, value, name = gram_sets(data, offsets, shingle)
        rows = len(offsets) - 1
        n = np.bincount(doc, minlength=rows)
        own = np.flatnonzero((name.view(np.int64) == part.column(1).to_numpy()) & (n > 0))
        return own, {name: column.take(pa.array(own, pa.int64())) for name, column in make(doc, value, n).items()}

    keep = {x: F.col(x) for x in ("d", "c", "cluster", "band", "blocks", "below", "above")}
    made = map_texts(docs.join(wanted.hint("shuffle_hash"), ["d", "x"]), work, fields, keep=keep)
    dealt = made.withColumn("own", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int")).withColumn("at", F.explode(_deals()))
    return dealt.select("cluster", "at.lo", "at.hi", "at.i", "at.j", F.col("at.side").alias("own"), "c", *[f for f, _ in fields])


def _fine_forests(docs: DataFrame, wanted: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(a, b): spanning forests of the classes of ``wanted`` that the bounds on fine points let pass."""

    def make(doc, value, n):
        counts = np.bincount(doc * FINE + (value >> _FINE).astype(np.int64), minlength=len(n) * FINE)
        points = np.minimum(counts, 255).astype(np.uint8).tobytes()
        return {"n": pa.array(n.astype(np.int64)), "point": pa.array([points[i * FINE : (i + 1) * FINE] for i in range(len(n))], pa.binary())}

    def task(table: pa.Table) -> pa.Table:
        c, n = table["c"].to_numpy(), table["n"].to_numpy()
        order = np.lexsort((c, n))
        order = order[np.append(True, c[order][1:] != c[order][:-1])]  # a document that stands in several rows
        c, n = c[order], n[order]
        point = np.frombuffer(b"".join(table["point"].take(pa.array(order)).to_pylist()), dtype=np.uint8).reshape(-1, FINE)
        label = survivors(point, n, percent)
        other = label != np.arange(len(label))
        return pa.table({"a": pa.array(c[label[other]], pa.int64()), "b": pa.array(c[other], pa.int64())})

    return _dealt(docs, wanted, shingle, [("n", "long"), ("point", "binary")], make).groupBy("cluster", "lo", "hi", "i", "j").applyInArrow(task, "a long, b long")


def _links(docs: DataFrame, wanted: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(a, b): spanning forests of the true links. ``wanted``: one document of each class, with its cluster and blocks."""

    def make(doc, value, n):
        return {"grams": pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), pa.array(value.view(np.int64)))}

    dealt = _dealt(docs, wanted, shingle, [("grams", "array<long>")], make)

    def task(table: pa.Table) -> pa.Table:
        c, own = table["c"].to_numpy(), table["own"].to_numpy()
        order = np.lexsort((c, own))
        order = order[np.append(True, c[order][1:] != c[order][:-1])]  # a document that stands in several rows
        table = table.take(pa.array(order))
        c, own = c[order], own[order]
        grams = table["grams"].combine_chunks()
        value = grams.flatten().to_numpy()
        n = grams.value_lengths().to_numpy().astype(np.int64)
        member = np.repeat(np.arange(len(c)), n)
        by = np.argsort(value, kind="stable")
        value, member = value[by], member[by]
        edge = runs(value)
        many = np.diff(edge) > 1
        member, column = member[np.repeat(many, np.diff(edge))], np.repeat(np.cumsum(many) - 1, np.diff(edge))[np.repeat(many, np.diff(edge))]
        shared = np.zeros((len(c), len(c)), dtype=np.float32)
        width, total = 4096, int(many.sum())
        for lo in range(0, total, width):
            a, b = np.searchsorted(column, [lo, lo + width])
            grid = np.zeros((len(c), min(width, total - lo)), dtype=np.float32)
            grid[member[a:b], column[a:b] - lo] = 1
            shared += grid @ grid.T
        union = n[:, None] + n[None, :] - shared
        linked = (100 * shared >= percent * union) & (np.arange(len(c))[:, None] < np.arange(len(c))[None, :])
        if own[0] != own[-1]:
            linked &= own[:, None] != own[None, :]  # pairs of one block have a task of their own
        label = np.arange(len(c))
        out = []
        for x, y in zip(*np.nonzero(linked), strict=True):
            if label[x] != label[y]:
                out.append((c[x], c[y]))
                label[label == max(label[x], label[y])] = min(label[x], label[y])
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return dealt.groupBy("cluster", "lo", "hi", "i", "j").applyInArrow(task, "a long, b long")


def _grouped(own: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The heads of all documents, and (c, d, label) of all classes: the least doc_id and the least class reachable by links."""
    spark = own.sparkSession
    sampled = spark.sparkContext.broadcast(_sampled(own, shingle))
    heads = cut(_heads(own, shingle, percent, sampled))
    classes = heads.filter("n > 0").groupBy("c").agg(F.min(F.struct("d", "x")).alias("at"), F.first("n").alias("n"), F.first("point").alias("point")).select("c", "at.d", "at.x", "n", "point")
    keys = heads.select(F.explode("keys").alias("key"), "c")
    shared = keys.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("key")
    members = cut(keys.join(shared, "key").distinct())
    sets = members.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("c")).alias("s"), F.bit_xor(F.xxhash64("c", F.lit(1))).alias("t"))
    told = cut(sets.groupBy("n", "s", "t").agg(F.min("key").alias("key")).select("key", "n"))  # keys of one set of classes say the same
    points = members.join(told.select("key"), "key").join(classes.select("c", "n", "point"), "c").select("key", "n", "c", "point")
    hot = told.filter(F.col("n") > HOT).select("key")
    forests = _forests(points.join(hot, "key", "left_anti").repartition("key").sortWithinPartitions("key", "n", "c"), percent)
    forests = forests.unionByName(_hot_forests(_salted(points, hot, "key", "c"), percent))
    of = lambda edges: _blocks(components(cut(edges.distinct())).select(F.col("v").alias("c"), F.col("label").alias("cluster")).join(classes.select("c", "d", "x", "n"), "c"), percent)
    fine = _fine_forests(own, cut(of(forests)), shingle, percent)
    links = cut(_links(own, cut(of(fine)), shingle, percent))
    labels = components(links).select(F.col("v").alias("c"), "label")
    return heads, classes.select("c", "d").join(labels, "c", "left").withColumn("label", F.coalesce("label", "c"))


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id (least doc_id with an equal set) and component_id (least doc_id
    reachable by links)."""
    heads, grouped = _grouped(_keyed(docs), shingle, percent)
    least = grouped.groupBy("label").agg(F.min("d").alias("component"))
    named = grouped.join(least, "label").select("c", F.col("d").alias("class"), "component")
    some = F.col("n") > 0
    back = lambda x: F.when(x != _LEAST, x)
    return heads.select("d", "n", F.when(some, F.col("c")).alias("c")).join(named, "c", "left").select(
        back(F.col("d")).alias("doc_id"), F.col("n").alias("n_shingles"), back(F.when(some, F.col("class")).otherwise(F.col("d"))).alias("class_id"),
        back(F.when(some, F.col("component")).otherwise(F.col("d"))).alias("component_id"),
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` with one alone of each group of linked documents: the least doc_id, of equal ones the least hash of the
    text. Rows with an empty set stay. Rows are told apart by doc_id and text; of rows that share both one stays."""
    key = ["d", "x", "y"]
    text = F.col("text")
    of_text = [F.xxhash64(text).alias("x"), F.xxhash64(F.lit("row"), text).alias("y")]
    keyed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("d"), *of_text)
    heads, grouped = _grouped(_keyed(docs).withColumn("y", of_text[1]), shingle, percent)
    rows = heads.filter("n > 0").groupBy(*key, "c").agg(F.count("*").alias("copies")).join(grouped.select("c", "label"), "c")
    first = rows.groupBy("label").agg(F.min(F.struct(*key)).alias("first"), F.sum("copies").alias("rows")).filter("rows > 1")
    marks = cut(rows.join(first, "label").select(*key, (F.struct(*key) != F.col("first")).alias("gone"), (F.col("copies") > 1).alias("many")).filter("gone or many"))
    stay = keyed.join(marks.select(*key), key, "left_anti")
    again = keyed.join(marks.filter("many and not gone").select(*key), key).dropDuplicates(key)
    return stay.unionByName(again).select("row.*")


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))).select("doc_id", "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
r AS (SELECT doc_id AS v, doc_id AS u FROM d UNION SELECT r.v, l.b FROM r JOIN l ON r.u = l.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, (SELECT min(u) FROM r WHERE r.v = d.doc_id) AS component_id FROM d LEFT JOIN n ON d.doc_id = n.doc_id
"""
