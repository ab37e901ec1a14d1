import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilspark.llm import source_mixing as op
from veilspark.llm.registry import QUERIES

SCHEMA = "doc_id long, text string, source string, n long, size string, rank int, copies int, target string"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, rows):
    """Rows (doc_id, text, source) with columns whose names clash."""
    return spark.createDataFrame([(*r, 5, "s", 1, 9, "t") for r in rows], SCHEMA)


def corpus(seed, sources, most=300, docs=40):
    r = random.Random(seed)
    out = []
    for s in sources:
        out += [(len(out) + i, " ".join(["w"] * min(int(r.expovariate(1 / 60)) + 1, most)), s) for i in range(r.randint(3, docs))]
    return out


def wanted(rows, weights=(1, 2, 3), most=3):
    """Targets by resharing the excess round by round."""
    size = defaultdict(int)
    for _, text, source in rows:
        size[source] += len(_WORD.findall(text or ""))
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, stopped = sum(size.values()), set()
    while True:
        rest = {s: weight[s] for s in order if s not in stopped}
        left = total - sum(most * size[s] for s in stopped)
        out = {s: most * size[s] if s in stopped else rest[s] * left / sum(rest.values()) for s in order}
        above = {s for s in rest if out[s] > most * size[s]}
        if not above:
            return out, size
        stopped |= above


def best_tilt(sizes, target, most=3):
    """By halving, with one tilt a word."""
    given = lambda t: sum(s * min(most, math.exp(min(t * s, 50))) for s in sizes)
    low, high = -50.0, 50.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if given(mid) < target else (low, mid)
    return low


@pytest.mark.parametrize("seed,sources", [(1, ["a", "b", "c", "d", None]), (2, ["é", "z", "Z", "", "日本", "a"])])
def test_targets_and_totals(spark, seed, sources):
    rows = corpus(seed, sources) + corpus(seed + 50, [sources[0]], docs=400)  # one source holds most words
    rows = [(i, t, s) for i, (_, t, s) in enumerate(rows)] + [(9000, None, sources[0]), (9001, " \n", sources[-1])]
    got = op.copies_of(table(spark, rows), op.cycled(1, 2, 3)).collect()
    want, size = wanted(rows)
    assert sorted(g.doc_id for g in got) == sorted(r[0] for r in rows)
    taken = defaultdict(int)
    for g in got:
        assert g.target == pytest.approx(want[g.source], rel=1e-12) and g.source_size == size[g.source] and 0 <= g.copies <= 3
        taken[g.source] += g.copies * g.size
    for s in want:
        assert abs(taken[s] - want[s]) <= 60, (s, taken[s], want[s])


def test_tilts_solve_the_constraints(spark):
    rows = corpus(7, ["a", "b", "c", "d"], docs=200)
    docs = op.counted(table(spark, rows))
    found = {r.source: r for r in op.tilts(docs, op.targets(docs, op.cycled(1, 5, 2, 9))).collect()}
    for s, r in found.items():
        sizes = [len(t.split()) for _, t, x in rows if x == s]
        if r.full:
            assert r.target == 3 * sum(sizes)
        else:
            assert r.tilt / r.unit == pytest.approx(best_tilt(sizes, r.target), rel=1e-4, abs=1e-7)


def test_rates_are_the_closest_to_one_copy():
    """Any other rates of the same total are farther from one copy each, by relative entropy."""
    sizes = np.array([3.0, 10, 40, 100])
    t = best_tilt(sizes, 100)
    rate = np.exp(t * sizes)
    far = lambda w: float(np.sum(w * np.log(w) - w))
    r = np.random.default_rng(0)
    for _ in range(200):
        move = r.normal(size=4)
        move -= sizes * (move @ sizes) / (sizes @ sizes)
        other = rate + move * 0.01
        if (other > 0).all():
            assert far(other) >= far(rate) - 1e-12


def test_parts_and_equal_rows(spark):
    rows = corpus(4, ["a", "b"], docs=300) + [(77_000, "same words here", "a")] * 500 + [(None, "one two", "b")] * 300
    got = op.copies_of(table(spark, rows), op.cycled(1, 2), part_rows=20).collect()
    want, _ = wanted(rows, (1, 2))
    assert sum(g.n for g in got) == len(rows)
    for s in want:
        assert sum(g.copies * g.size for g in got if g.source == s) == pytest.approx(want[s], rel=0.02)
    assert all(0 <= g.copies <= 3 * g.n for g in got)


def test_the_mix_itself(spark):
    rows = corpus(5, ["a", "b", None]) + [(5000, "one two three", "a"), (5000, "uno due tre", "a"), (5001, None, "b"), (None, "x y", None)]
    docs = table(spark, rows)
    out = op.mixed(docs, op.cycled(1, 2, 3))
    assert out.columns == docs.columns
    words = {r.source: r.w for r in out.groupBy("source").agg(F.sum(F.size(F.split(F.coalesce("text", F.lit("")), r"\s+"))).alias("w")).collect()}
    want, _ = wanted(rows)
    for s in want:
        assert words[s] == pytest.approx(want[s], abs=40)
    assert out.groupBy("doc_id", "text").count().agg(F.max("count")).first()[0] <= 3


def test_empty_and_wordless(spark):
    assert op.copies_of(table(spark, []), op.cycled(1, 2, 3)).count() == 0
    got = op.copies_of(table(spark, [(1, None, "a"), (2, " ", None)]), op.cycled(1, 2, 3)).collect()
    assert [(g.size, g.target, g.source_size) for g in got] == [(0, 0.0, 0)] * 2


def test_words_and_order_of_sources(spark):
    texts = ["a  b\tc", "", None, "\x0bx\x0c\ry\n", "é\xa0ü 日本", " lead", "x" * 100_000 + " y"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(op.n_words(F.col("t"))).collect()]
    assert got == [len(_WORD.findall(t or "")) for t in texts]
    names = ["b", None, "", "Z", "é", "日", "\U0001f600", "a"]
    rank = {r.source: r["rank"] for r in op.ranked(spark.createDataFrame([(n,) for n in names], "source string")).collect()}
    assert rank == {s: i for i, s in enumerate(sorted(names, key=lambda s: (s is None, (s or "").encode())))}


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source")
    rows = [tuple(r) for r in docs.collect()]
    want, size = wanted(rows)
    source = {r[0]: r[2] for r in rows}
    got = QUERIES["op12_source_mixing"](spark, sf).collect()
    taken, longest = defaultdict(int), defaultdict(int)
    assert len(got) == len(rows)
    for g in got:
        s = source[g.doc_id]
        assert g.source_size == size[s] and g.target == pytest.approx(want[s], rel=1e-12) and g.taken <= 3 * g["size"] and (g["size"] == 0 or g.taken % g["size"] == 0)
        taken[s] += g.taken
        longest[s] = max(longest[s], g["size"])
    for s in want:
        assert abs(taken[s] - want[s]) <= longest[s] / 2 + 1
    again = QUERIES["op12_source_mixing"](spark, sf)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got))
