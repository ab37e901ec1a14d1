import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tests.llm.cases import DOCS, awkward, prose, table

from veilspark.llm import benchmark_decontamination as decontamination
from veilspark.llm import language_id, license_scans, quality_rules, substring_dedup
from veilspark.llm.text_kernels import split_words

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SF = "/root/testdata/sf0.001"


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("size", [1, 7, 20, 21, 45, 80])
def test_substring_dedup_is_brute_force(spark, size):
    shared = prose(500, 130)
    given = [*awkward(), (60, f"{prose(501, 30)} {shared}", None), (61, f"{shared} {prose(502, 30)}", None)]
    given += [(62 + i, " ".join([prose(503 + i, 9), *shared.split()[20 * i : 20 * i + 50]]), None) for i in range(4)]
    least = -(2**63)
    key = lambda i: least if i is None else i
    seen = {}
    for i, t, _ in given:
        w = SPACED.findall(t or "")
        for p in range(len(w) - size + 1):
            seen.setdefault(tuple(w[p : p + size]), set()).add((key(i), p))
    want = []
    for i, t, _ in given:
        w = SPACED.findall(t or "")
        gone = set()
        for p in range(len(w) - size + 1):
            if any((d, q) < (key(i), p) for d, q in seen[tuple(w[p : p + size])]):
                gone.update(range(p, p + size))
        want.append((i, len(w), len(gone), " ".join(x for q, x in enumerate(w) if q not in gone)))
    assert rows(substring_dedup.dedup_substrings(table(spark, given), size)) == sorted(want, key=repr)


def test_substring_dedup_doubles_until_nothing_survives():
    assert [substring_dedup.lengths(n) for n in (1, 7, 20, 21, 45, 160)] == [[1, 1], [4, 7], [10, 20], [11, 21], [12, 23, 45], [10, 20, 40, 80, 160]]


def test_substring_dedup_other_sizes_and_empty(spark):
    out = substring_dedup.dedup_substrings(table(spark, [(1, "a b c d e f", None), (2, "c d e f g", None)]), window=4).orderBy("doc_id").collect()
    assert [(r.n_removed, r.text) for r in out] == [(0, "a b c d e f"), (4, "g")]
    assert substring_dedup.dedup_substrings(spark.createDataFrame([], DOCS)).collect() == []


def brute_decontamination(docs, items, size=10):
    grams = {}
    for item, t in items:
        w = ALNUM.findall(lowered(t))
        k = min(size, len(w))
        for p in range(len(w) - k + 1 if k else 0):
            grams.setdefault(tuple(w[p : p + k]), set()).add("" if item is None else str(item))
    sizes = {len(g) for g in grams}
    out = []
    for i, t, _ in docs:
        w, hit, found = ALNUM.findall(lowered(t)), set(), set()
        for k in sizes:
            for p in range(len(w) - k + 1):
                if tuple(w[p : p + k]) in grams:
                    hit.update(range(p, p + k))
                    found |= grams[tuple(w[p : p + k])]
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("most", [10**8, 3000])
def test_decontamination_is_brute_force(spark, most):
    docs = awkward()
    items = [(1, prose(1, 40)), (2, "zz"), (3, None), (4, ""), (5, "..."), (None, prose(2, 15)), (6, "ONE"), (6, prose(1, 30)), (7, prose(77))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontamination.decontaminate(table(spark, docs), bench, max_bytes=most)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in out.collect()), key=repr) == brute_decontamination(docs, items)


def test_decontamination_cuts_spans(spark):
    docs = table(spark, [(1, "before ONE two, three é after", None), (2, "clean text", None), (3, None, None)])
    bench = spark.createDataFrame([(1, "one two three é")], "item_id long, text string")
    cut = decontamination.clean_texts(docs, bench)
    assert {r.doc_id: r.text for r in cut.collect()} == {1: "before   after", 2: "clean text", 3: None}
    assert cut.columns == docs.columns
    assert decontamination.decontaminate(docs, bench.limit(0)).filter("n_hit > 0").count() == 0


def test_slices_cut_the_same_texts(spark):
    w = [f"w{i}" for i in range(40)]
    said = lambda a, b: " ".join(w[a:b])
    items = spark.createDataFrame([(1, said(5, 20)), (2, said(18, 30)), (3, "alone"), (4, said(33, 36))], "item_id long, text string")
    docs = table(spark, [(1, "aa " + said(0, 40) + " bb alone", None), (1, said(5, 20), None), (None, "alone, " + said(18, 30), None), (2, None, None), (2, None, None), (3, said(0, 10), None), (3, said(0, 10), None)])
    own = lambda most: sorted(((r.doc_id, r.text, r.k0) for r in decontamination.clean_texts(docs, items, max_bytes=most).collect()), key=repr)
    assert own(10**8) == own(400) == own(90)
    spans = lambda most: rows(decontamination.decontaminate(docs, items, max_bytes=most))
    assert spans(10**8) == spans(200)


def test_rows_that_share_an_id_keep_their_own_windows(spark):
    a, b, c = prose(1, 30), prose(2, 30), prose(3, 30)
    given = [(7, a, None), (7, b, None), (None, c, None), (None, a + " x", None), (8, b, None), (9, c + " " + c, None), (7, a, None)]
    out = {(r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.dedup_substrings(table(spark, given)).collect()}
    assert out == {(7, 30, 30), (7, 30, 0), (None, 30, 0), (None, 31, 0), (8, 30, 30), (9, 60, 60)}


def test_windows_do_not_each_carry_their_text_s_lists(spark):
    text = " ".join(f"w{i}" for i in range(2000))
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    anchors = substring_dedup.Chunks(split_words(data, np.array([0, len(data)]), substring_dedup.SPACED), 20).anchor.view(np.int64)
    docs = spark.createDataFrame([(1, 0, text, anchors.tolist())], "d long, k long, text string, open array<long>")
    found = substring_dedup._windows(docs, 20, 20, True)
    assert found.columns == ["d", "k", "left", "right"] and found.distinct().count() == 1981
    whole = substring_dedup.dedup_substrings(table(spark, [(1, text, None), (2, text, None)]))
    for df, none in ((found, "open"), (whole, "closed")):
        made = [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "MapInArrow" in x]
        assert made and not any(none in x for x in made)


def test_quality_counts_are_brute_force(spark):
    docs = [*awkward(), (20, "a b\na b\n\n x\na b", "en"), (21, "#* $%& <|> a", "en"), (22, "a b c a b c a b", "en")]
    out = {}
    for r in quality_rules.judge(table(spark, docs), None).collect():
        out.setdefault(r.doc_id, r)
    for i, t, _ in docs:
        t, r = t or "", out[i]
        w = SPACED.findall(t)
        lines = [x for x in t.split("\n") if SPACED.search(x)]
        grams = Counter(tuple(w[p : p + 3]) for p in range(len(w) - 2))
        again = {q for p in range(len(w) - 2) if grams[tuple(w[p : p + 3])] > 1 for q in range(p, p + 3)}
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again), failed)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want, i
        assert r.kept is (not failed)


def test_quality_trees_learn_and_are_monotonic(spark):
    import numpy as np

    r = np.random.default_rng(0)
    x = r.random((3000, len(quality_rules.FEATURES)))
    y = ((x[:, 1] > 0.4) & (x[:, 4] < 0.6)).astype(float)
    trees = quality_rules.fit(x, y)
    assert ((trees.score(x) > 0.5) == (y > 0)).mean() > 0.95
    down = list(quality_rules.FEATURES.values()).index(-1)
    more = x.copy()
    more[:, down] += r.random(len(x))
    assert (trees.margin(more) <= trees.margin(x) + 1e-9).all()
    assert quality_rules.fit(x[:10], y[:10]) is None and quality_rules.fit(x, np.ones(len(x))) is None


def test_quality_keeps_good_and_drops_bad(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    judged = quality_rules.judge(docs, quality_rules.train(docs, labels)).join(labels, "doc_id")
    held = {(r.quality, r.kept): r["count"] for r in judged.filter("not base_failed").groupBy("quality", "kept").count().collect()}
    assert held.get((1, True), 0) > 0.98 * sum(n for (q, _), n in held.items() if q == 1)


def test_quality_verdicts_on_held_out_rows(spark):
    from pyspark.sql import functions as F

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    kept_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    trees = quality_rules.train(docs, labels.filter(~kept_out))
    held = quality_rules.judge(docs, trees).join(labels.filter(kept_out & F.col("quality").isNotNull()), "doc_id").select("quality", "kept", "score", *quality_rules.COUNTS, "base_failed").toPandas()
    assert (held.kept == (held.quality > 0)).mean() > 0.9 and len(held) > 100
    c = {k: held[k].to_numpy() for k in quality_rules.COUNTS}
    x = quality_rules.features(c)
    for row, score, kept, failed in zip(x, held.score, held.kept, held.base_failed, strict=True):
        margin = trees.base
        for f, cut, value in zip(trees.feature, trees.cut, trees.value, strict=True):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + bool(row[f[node]] > cut[node])
            margin += value[node - len(f)]
        import math

        assert abs(score - 1 / (1 + math.exp(-margin))) < 1e-9 and kept == (not failed and score >= quality_rules.KEEP_SCORE)


def test_licenses_are_brute_force(spark):
    said = [
        (1, "Under the MIT License. GNU General\nPublic - license; Apache LICENSE, MIT license", None), (2, "admit license", None), (30, "cc-by-nc 4.0 CC by", None),
        (4, "mit", None), (5, "license", None), *awkward(),
    ]
    want = []
    for i, t, _ in said:
        w = ALNUM.findall(lowered(t))
        at = [(p, label) for phrase, label in license_scans.BASE_PHRASES.items() for p in range(len(w)) if w[p : p + len(phrase.split())] == phrase.split()]
        places = [p for p, _ in at]
        want.append((i, len(w), len(at), min(places, default=None), max(places, default=None), sorted({x for _, x in at})))
    out = license_scans.scan_licenses(table(spark, said))
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, list(r.base_labels)) for r in out.collect()), key=repr) == sorted(want, key=repr)
    assert {r.doc_id: list(r.labels) for r in out.filter("doc_id = 30").collect()} == {30: ["cc-by", "cc-by-nc"]}


def test_license_expressions(spark):
    assert license_scans.to_postfix("MIT OR Apache-2.0 AND GPL-2.0 WITH Classpath-exception-2.0") == "mit apache-2.0 gpl-2.0 classpath-exception-2.0 WITH AND OR".split()
    assert license_scans.evaluate("(MIT OR GPL-2.0) AND BSD-3-Clause") == (["bsd-3-clause", "gpl-2.0", "mit"], True)
    assert license_scans.evaluate("GPL-2.0 AND MIT") == (["gpl-2.0", "mit"], False)
    for bad in ("", "AND MIT", "(MIT", "MIT)", "MIT OR", "()"):
        assert license_scans.evaluate(bad) is None, bad
    assert license_scans.evaluate("see LICENSE") is None and license_scans.evaluate("MIT OR nothing") is None and license_scans.evaluate("GPL-2.0+ WITH GCC-exception-3.1")
    docs = table(spark, [(1, "# SPDX-License-Identifier: MIT OR GPL-2.0-only\nmore", None), (2, "SPDX-License-Identifier: (", None), (3, "x", None), (4, "SPDX-License-Identifier: see LICENSE", None)])
    out = {r.doc_id: r for r in license_scans.scan_licenses(docs).collect()}
    assert out[1].permissive and list(out[1].labels) == ["gpl-2.0-only", "mit"] and out[1].score > 0.9
    assert out[2].permissive is None and not out[2].labels and out[3].score == 0 and not out[4].labels and out[4].permissive is None


def test_languages_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language_id.op3_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in out)


def test_language_scores_are_brute_force(spark):
    import math

    r = [(i, prose(i, 30, letters="abcdé日"), "en") for i in range(6)] + [(10 + i, prose(i, 30, letters="xyzß語"), "de") for i in range(6)]
    docs = table(spark, [*r, (20, "é日x ... Z", None), (21, "ab", None), (22, "x" * 2_000_000, None)])
    model = language_id.train(docs, language_id.held_out() | ~language_id.held_out())
    out = {x.doc_id: x for x in language_id.predict(docs, model).collect()}

    def buckets(t):
        import numpy as np

        code = [ord(c) for c in lowered(t)]
        letter = [97 <= c <= 122 or c >= 128 for c in code]
        code = [c if x else 32 for c, x in zip(code, letter, strict=True)]
        found = []
        for p in range(len(code)):
            h = 0
            for k in range(4):
                if p + k < len(code):
                    h = ((h ^ code[p + k]) * 0x9E3779B1) & 0xFFFFFFFF
                    h ^= h >> 15
                    if any(letter[p : p + k + 1]):
                        found.append((h >> 7) & (language_id.BUCKETS - 1))
        return np.array(found, dtype=np.int64)

    counts = {x: Counter() for x in ("de", "en")}
    for _, t, lang in r:
        counts[lang].update(buckets(t).tolist())
    for i, t in [(x[0], x[1]) for x in r] + [(20, "é日x ... Z"), (21, "ab")]:
        total = {}
        for lang, c in counts.items():
            n = sum(c.values()) + language_id.BUCKETS * language_id.SMOOTHING
            total[lang] = math.log(0.5) + sum(math.log((c[b] + language_id.SMOOTHING) / n) for b in buckets(t).tolist())
        best = max(sorted(total), key=lambda x: total[x])
        assert out[i].lang_pred == best and abs(out[i].score - 1 / sum(math.exp(v - total[best]) for v in total.values())) < 1e-3
    assert out[22].lang_pred == "de"
    same = language_id.train(table(spark, [(1, "abc", "b"), (2, "abc", "a")]), language_id.held_out() | ~language_id.held_out())
    assert {x.lang_pred for x in language_id.predict(table(spark, [(5, "abc", None)]), same).collect()} == {"a"}


def test_languages_of_awkward_rows(spark):
    docs = table(spark, [*awkward(), *[(100 + i, prose(i), "en") for i in range(9)], *[(200 + i, prose(i, letters="stuvwxyz"), "de") for i in range(9)], (300, "123 ½ ...", "en")])
    model = language_id.train(docs, language_id.held_out() | ~language_id.held_out())
    out = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    assert {i: out[i].lang_pred for i in (4, 5, 6, 300)} == dict.fromkeys((4, 5, 6, 300), "und")
    assert out[100].lang_pred == "en" and out[200].lang_pred == "de" and out[10].lang_pred != "und"
    empty = spark.createDataFrame([], DOCS)
    assert language_id.train(empty, language_id.held_out()) is None
    assert {r.lang_pred for r in language_id.predict(docs, None).collect()} == {"und"}


def test_queries_return_their_contract(spark):
    out = quality_rules.op8_quality_rules(spark, SF)
    assert out.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    r = decontamination.op10_benchmark_decontamination(spark, SF).filter("not contaminated").first()
    assert r.items_sha256 == hashlib.sha256(b"").hexdigest()
    assert license_scans.op9_license_scans(spark, SF).count() == out.count() > 0
