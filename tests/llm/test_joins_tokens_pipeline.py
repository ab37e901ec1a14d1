import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tests.llm.cases import DOCS, awkward, prose, table

from veilspark.llm import ngram_jaccard, sentencepiece_codec

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute_components(docs, shingle=4, percent=85):
    sets = []
    for i, t, _ in docs:
        w = SPACED.findall(lowered(t))
        sets.append((-(2**63) if i is None else i, {tuple(w[p : p + shingle]) for p in range(len(w) - shingle + 1)} if len(w) >= shingle else ({tuple(w)} if w else set())))
    label = [i for i, _ in sets]
    moved = True
    while moved:
        moved = False
        for x, (_, a) in enumerate(sets):
            for y, (_, b) in enumerate(sets):
                if label[y] < label[x] and a and b and 100 * len(a & b) >= percent * len(a | b):
                    label[x], moved = label[y], True
    back = lambda v: None if v == -(2**63) else v
    return sorted(((back(i), len(s), back(c)) for (i, s), c in zip(sets, label, strict=True)), key=repr)


def near_copies(seed, n, words=90, edits=8):
    import random

    r = random.Random(seed)
    base = prose(seed, words).split()
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = f"w{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block,hot", [(512, 2000), (8, 2000), (8, 10), (64, 3)])
def test_components_are_brute_force(spark, monkeypatch, block, hot):
    monkeypatch.setattr(ngram_jaccard, "BLOCK", block)
    monkeypatch.setattr(ngram_jaccard, "HOT", hot)
    docs = [d for d in awkward() if d[0] not in (11,)] + [(1000 + i, t, "en") for i, t in enumerate(near_copies(50, 60) + near_copies(51, 12, 300, 40))]
    out = ngram_jaccard.jaccard_components(table(spark, docs))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=repr)
    assert got == brute_components(docs)


def test_a_hot_key_of_points_that_nothing_ties(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(ngram_jaccard, "BLOCK", 8)
    r = np.random.default_rng(2)
    sets = [set(r.choice(4000, 40, replace=False).tolist()) for _ in range(60)]
    sets += [(sets[i] - {min(sets[i])}) | {9000 + i} for i in range(0, 60, 3)]
    point = [bytes(np.bincount([x % ngram_jaccard.GROUPS for x in s], minlength=ngram_jaccard.GROUPS).astype(np.uint8)) for s in sets]
    rows = [(k, len(s), i, bytearray(p)) for k in (1, 2) for i, (s, p) in enumerate(zip(sets, point, strict=True))]
    edges = ngram_jaccard._hot_forests(spark.createDataFrame(rows, "key long, n long, c long, point binary"), 85).collect()
    label = list(range(len(sets)))
    for e in edges:
        a, b = label[e.a], label[e.b]
        label = [min(a, b) if x in (a, b) else x for x in label]
    assert all(label[60 + i] == label[3 * i] for i in range(20)) and len(set(label)) > 1


def test_texts_that_share_a_passage_or_common_words_alone_are_no_candidates(spark, monkeypatch):
    import random

    r, seen = random.Random(5), {}
    for name, at in (("_forests", "members"), ("_fine_forests", "wanted")):
        def counted(*args, own=getattr(ngram_jaccard, name), at=at, **named):
            seen[at] = args[0 if at == "members" else 1].count()
            return own(*args, **named)

        monkeypatch.setattr(ngram_jaccard, name, counted)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(9)) if r.random() < 0.4 else r.choice(["of", "the"])
    passage = " ".join(f"quoted{i}" for i in range(30))
    docs = [(i, " ".join(word() for _ in range(7000)) + " " + passage, "en") for i in range(12)]
    docs.append((99, docs[3][1] + " end", "en"))
    out = ngram_jaccard.jaccard_components(table(spark, docs)).collect()
    assert {x.doc_id: x.component_id for x in out} == {i: 3 if i == 99 else i for i, _, _ in docs}
    assert seen["wanted"] == 2  # no long texts but the copy and its original are compared
    assert seen["members"] < 100  # one key for each set of texts, whatever the number of grams that they share


def test_components_of_repeated_rows_and_empty(spark):
    a = prose(9)
    docs = table(spark, [(1, a, None), (1, a, None), (2, a, None), (3, "", None), (4, None, None), (3, "", None)])
    assert sorted((r.doc_id, r.component_id) for r in ngram_jaccard.jaccard_components(docs).collect()) == [(1, 1), (1, 1), (2, 1), (3, 3), (3, 3), (4, 4)]
    assert ngram_jaccard.jaccard_components(spark.createDataFrame([], DOCS)).collect() == []


def test_leaves_drop_no_pair(spark):
    import numpy as np

    r = np.random.default_rng(1)
    n = np.sort(r.integers(20, 60, 200))
    sets = [set(r.choice(80, k, replace=False).tolist()) for k in n]
    point = np.array([np.bincount([x % ngram_jaccard.GROUPS for x in s], minlength=ngram_jaccard.GROUPS) for s in sets]).astype(np.uint8)
    label = ngram_jaccard.survivors(point, n, 60)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if 100 * len(a & b) >= 60 * len(a | b):
                assert label[i] == label[j]


def test_codec_gives_the_model_s_own_ids(spark):
    import sentencepiece

    path = sentencepiece_codec.default_model()
    pieces = sentencepiece_codec.load_pieces(path)
    own = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = [*awkward(), (20, "▁mark <s> <0x0A>", None), (21, "x" * 700 + "   y", None), (22, "\ttab\r\n", None), (23, "é" * 300, None), (24, "bcbcabcaaa" * 90, None), (25, prose(4, 900).replace(" ", ""), None)]
    encoded = sentencepiece_codec.encode(table(spark, docs), pieces)
    got = sorted(((r.doc_id, None if r.ids is None else list(r.ids), r.n_tokens) for r in encoded.collect()), key=repr)
    want = sorted(((i, None if t is None else own.encode(t), 0 if t is None else len(own.encode(t))) for i, t, _ in docs), key=repr)
    assert got == want
    back = sorted(((r.doc_id, r.text) for r in sentencepiece_codec.decode(encoded, pieces).collect()), key=repr)
    assert back == sorted(((i, t and t.replace("▁", " ")) for i, t, _ in docs), key=repr)
    assert sentencepiece_codec.encode(spark.createDataFrame([], DOCS), pieces).collect() == []


def test_codec_of_long_texts_without_a_space(spark):
    import random
    import resource

    import numpy as np
    import sentencepiece

    path = sentencepiece_codec.default_model()
    own = sentencepiece.SentencePieceProcessor(model_file=path)
    m = sentencepiece_codec.Matcher(sentencepiece_codec.load_pieces(path))
    r = random.Random(3)
    text = "".join(r.choice("abcdeéß日本_=/") for _ in range(60_000))
    data = np.frombuffer((" " + text).encode(), dtype=np.uint8)
    ids, n = sentencepiece_codec.encode_units(m, data, np.zeros(1, dtype=np.int64), np.array([len(data)]))
    assert ids.tolist() == own.encode(text) and n.tolist() == [len(ids)]
    data = np.frombuffer(b" " + "".join(r.choice("abcdefgh0123") for _ in range(5_000_000)).encode(), dtype=np.uint8)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    _, _, count = sentencepiece_codec._units(m, data, np.zeros(1, dtype=np.int64), np.array([len(data)]))
    assert count[0] > 0 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_300_000  # KB


def test_codec_forgets_units_within_its_bound(spark, monkeypatch):
    pieces = sentencepiece_codec.load_pieces(sentencepiece_codec.default_model())
    docs = table(spark, [(i, prose(i, 60), None) for i in range(40)]).coalesce(1)
    want = [tuple(r.ids) for r in sentencepiece_codec.encode(docs, pieces).orderBy("doc_id").collect()]
    m = sentencepiece_codec.Matcher(pieces)
    import numpy as np

    monkeypatch.setattr(sentencepiece_codec, "MEMORY", 600)
    for _, t, ids in ((i, prose(i, 60), x) for i, x in enumerate(want)):
        buffer = np.frombuffer(b" " + t.encode(), dtype=np.uint8)
        first = np.flatnonzero(buffer == 0x20)
        pool, begin, count = sentencepiece_codec._units(m, buffer, first, np.diff(np.append(first, len(buffer))))
        assert tuple(np.concatenate([pool[b : b + n] for b, n in zip(begin, count, strict=True)]).tolist()) == ids


def test_every_document_makes_the_round_trip(spark):
    out = sentencepiece_codec.op5_sentencepiece_codec(spark, "/root/testdata/sf0.001")
    assert out.filter("not round_trip").count() == 0 < out.count()


def test_one_row_of_each_group_stays(spark):
    a, b = prose(60), prose(61)
    near = b + " zz"
    given = [(1, a), (5, a), (5, b), (6, near), (6, near), (9, prose(62)), (9, prose(62)), (None, prose(63)), (None, prose(63)), (3, prose(63)), (4, ""), (4, ""), (None, None), (7, "w"), (8, "W")]
    docs = table(spark, [(i, t, "en") for i, t in given]).withColumn("_gone", F.lit(1))
    out = ngram_jaccard.keep_one(docs, 5, 80)
    assert out.columns == docs.columns
    want = [(1, a), (5, b), (9, prose(62)), (None, prose(63)), (4, ""), (4, ""), (None, None), (7, "w")]
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(want, key=repr)


CLASHES = ["kept", "n_lines_removed", "_gone", "row", "d", "score", "c0", "spans", "gone", "items"]


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as p

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = [(10**6, prose(70), None, None, None), (10**6, prose(71), None, None, None), (None, prose(72), None, None, None), (None, prose(72), None, None, None), (None, None, None, None, None), (10**6 + 1, "", None, None, None)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).select("*", *[F.lit(c).alias(c) for c in CLASHES])
    docs.write.parquet(f"{tmp_path}/given")
    docs = spark.read.parquet(f"{tmp_path}/given")
    counts = Counter((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    for i, (name, stage) in enumerate(p.STAGES):
        out = stage(spark, docs, sf)
        if name != "tokens":
            assert out.columns == docs.columns, name
            assert all(r[c] == c for r in out.select(*CLASHES).limit(20).collect() for c in CLASHES), name
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        ids = Counter(r.doc_id for r in docs.select("doc_id").collect())
        assert all(n <= sum(m for (d, _), m in counts.items() if d == k) for k, n in ids.items()), name
    assert docs.filter("n_tokens > 0").count() > 0.4 * len(counts)
    empty = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for name, stage in p.STAGES:
        assert stage(spark, empty, sf).collect() == [], name


def test_near_copies_ship_no_long_texts_that_share_a_passage(spark, monkeypatch):
    import random

    import corpus_pipeline

    r, seen, own = random.Random(6), [], ngram_jaccard._fine_forests
    monkeypatch.setattr(ngram_jaccard, "_fine_forests", lambda docs, wanted, *a: seen.append(wanted.count()) or own(docs, wanted, *a))
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(9))
    docs = [(i, " ".join(word() for _ in range(5000)) + " " + " ".join(f"quoted{k}" for k in range(30)), "en") for i in range(8)]
    assert corpus_pipeline.near_copies(spark, table(spark, docs), "").count() == 8
    assert seen == [0]
