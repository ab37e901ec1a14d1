"""Whole results of queries that SQL can't express, against plain Python over the whole tables."""

import re
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tests.llm.cases import table
from tests.llm.test_joins_tokens_pipeline import SPACED, lowered
from tests.llm.test_text_ops import ALNUM, brute_decontamination

from veilspark.llm import license_scans, quality_rules, sentencepiece_codec, url_filters
from veilspark.llm.registry import QUERIES

PAGE = "page_id long, url string, html string, host string, mass double, kind string"


def place(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (lowered(m[1]), m[2]) if m else ("", "")


def brute_pages(pages, rules):
    """Verdicts by hand: the longest rule, else ranks by plain iteration over all hosts until nothing moves."""
    placed = [(i, *place(u), h or "") for i, u, h in pages]
    ruled = {}
    for host, path in {(h, p) for _, h, p, _ in placed}:
        fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        ruled[host, path] = max(fits)[1:] if fits else (None, None)
    seeds = {"allow": Counter(), "block": Counter()}
    links = Counter()
    for _, host, path, html in placed:
        if ruled[host, path][1] and host:
            seeds[ruled[host, path][1]][host] += 1
        for to in re.findall(r"(?i)href\s*=\s*[\"']?([^\"'\s>]+)", html) if host else ():
            to = "x:" + to if to.startswith("//") else to
            target = place(to)[0] if "://" in to else host
            if target:
                links[host, target] += 1
    mass = {}
    for kind, back in (("allow", False), ("block", True)):
        out = defaultdict(Counter)
        for (a, b), n in links.items():
            out[b if back else a][a if back else b] += n
        for h in seeds[kind]:
            out[h] = out[h] or Counter({h: 1})
        now = {h: float(n) for h, n in seeds[kind].items()}
        for _ in range(400):
            new = Counter({h: 0.15 * n for h, n in seeds[kind].items()})
            for h, m in now.items():
                for to, n in out[h].items():
                    new[to] += 0.85 * m * n / sum(out[h].values())
            now = dict(new)
        mass[kind] = now
    result = []
    for i, host, path, _ in placed:
        rule, verdict = ruled[host, path]
        bad, good = mass["block"].get(host, 0.0), mass["allow"].get(host, 0.0)
        result.append((i, host, path, rule, verdict or ("block" if bad > 0.5 * (bad + good) else "allow")))
    return sorted(result, key=repr)


def test_url_filters_over_all_pages(spark):
    sf = "/root/testdata/sf0.01"
    pages = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    got = sorted((tuple(r) for r in QUERIES["op7_url_filters"](spark, sf).select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)
    assert got == brute_pages(pages, url_filters.RULES)


def test_url_filters_where_links_cross_hosts(spark):
    """Ranks decide: chains from seeds, a host between both, one that links to the bad, long urls, nulls and repeated rows."""
    a = lambda *to: "".join(f'<a href="{t}">' for t in to)
    pages = [
        (1, "http://ok.org/x", a("http://friend.net/", "http://middle.net/")), (2, "http://friend.net/1", a("http://far.net/q")), (3, "http://far.net/1", ""), (4, "http://bad.com/de/1", ""), (4, "http://bad.com/de/1", ""),
        (5, "http://spam.net/", a("http://bad.com/de/1", "http://spammer.net/")), (6, "http://middle.net/", a("http://bad.com/de/9", "//ok.org/")), (7, "http://ring.net/", a("http://spam.net/")), (8, "http://alone.net/", ""),
        (9, None, a("http://bad.com/de/1")), (10, "http://long.net/" + "p" * 300_000 + "?q", a("http://ring.net/" + "z" * 100_000)), (11, "http://spammer.net/", a("http://ring.net/", "http://ok.org/")),
    ]
    df = spark.createDataFrame([(*p, "clash", 1.0, "clash") for p in pages], PAGE)
    got = sorted((tuple(r) for r in url_filters.judge_pages(df).select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)
    want = brute_pages(pages, url_filters.RULES)
    assert got == want and {v for *_, v in want} == {"allow", "block"} and dict((i, v) for i, *_, v in want)[7] == "block"


class Expression:
    """An expression of identifiers by recursive descent."""

    def __init__(self, text):
        self.words, self.at = re.findall(r"[()]|[A-Za-z0-9][A-Za-z0-9.+:-]*", text), 0

    def value(self):
        try:
            out = self.either()
        except (IndexError, ValueError):
            return None
        # What follows an operand and is no operator is prose; a bracket there is a fault.
        return None if self.peek() in ("(", ")") else out

    def peek(self):
        return self.words[self.at] if self.at < len(self.words) else None

    def level(self, operator, below, join):
        out = below()
        while (self.peek() or "").upper() == operator:
            self.at += 1
            out = join(out, below())
        return out

    def either(self):
        return self.level("OR", self.both, lambda a, b: (a[0] | b[0], a[1] or b[1]))

    def both(self):
        return self.level("AND", self.plus, lambda a, b: (a[0] | b[0], a[1] and b[1]))

    def plus(self):
        return self.level("WITH", self.one, lambda a, b: a)

    def one(self):
        word = self.words[self.at]
        self.at += 1
        if word == "(":
            out = self.either()
            if self.words[self.at] != ")":
                raise ValueError
            self.at += 1
            return out
        if word == ")" or word.upper() in ("AND", "OR", "WITH") or not license_scans.is_identifier(word):
            raise ValueError
        return {word.lower()}, word.lower().startswith(license_scans.PERMISSIVE)


def brute_licenses(docs):
    phrases = [(p.split(), label, kind) for kind, own in (("base", license_scans.BASE_PHRASES), ("more", license_scans.MORE_PHRASES), ("tag", {license_scans.TAG: None})) for p, label in own.items()]
    left = {"base": 0.2, "more": 0.4, "tag": 0.05}
    out = []
    for i, text in docs:
        found = list(ALNUM.finditer(lowered(text)))
        w = [m[0] for m in found]
        base, base_labels, labels, doubt = [], set(), set(), 1.0
        for at in range(len(w)):
            for words, label, kind in phrases:
                if w[at : at + len(words)] != words:
                    continue
                if kind == "tag":
                    tail = text[found[at + len(words) - 1].end() :].split("\n")[0].lstrip(" \t\":='").rstrip()
                    if (value := Expression(tail).value()) is None:
                        continue
                    labels |= value[0]
                else:
                    labels.add(label)
                if kind == "base":
                    base.append(at)
                    base_labels.add(label)
                doubt *= left[kind]
        out.append((i, len(w), len(base), min(base, default=None), max(base, default=None), ",".join(sorted(base_labels)), ",".join(sorted(labels)), round(1 - doubt, 9)))
    return sorted(out, key=repr)


def licence_rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9)) for r in df.collect()), key=repr)


def test_license_scans_over_all_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert licence_rows(QUERIES["op9_license_scans"](spark, sf)) == brute_licenses(docs)


def test_license_scans_of_awkward_rows(spark):
    """Nulls, ties, repeats, overlapping phrases, long texts, and expressions of all kinds."""
    tag = "SPDX-License-Identifier:"
    texts = [
        None, "", "CC BY SA and cc-by.", "Apache License, Version 2.0 (MIT License) cc by cc by", f"{tag} MIT", f"x\n// {tag} (MIT OR GPL-2.0-only) AND BSD-3-Clause\nrest", f"{tag} MIT OR", f"{tag} (MIT", f"{tag} MIT)", f"{tag} MIT AND (Apache-2.0",
        f"{tag} GPL-2.0-only WITH Classpath-exception-2.0 OR MIT", f"{tag} nonsense", f"{tag} MIT some prose behind", f'"{tag} = "Apache-2.0"', f"{tag}", "gnu general public license version 3 " * 3, f"{tag} MIT AND AND MIT", f"{tag} () MIT", f"{tag} MIT (GPL-3.0)",
        "word " * 50_000 + "mit license", f"{tag} LicenseRef-Own+ OR BSL-1.0", "isc\tlicense\x0bgnu lesser general public license",
    ]
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(3, texts[3], "en"), (None, texts[5], "en")]
    from pyspark.sql import functions as F

    out = license_scans.scan_licenses(table(spark, rows)).select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")
    assert licence_rows(out) == brute_licenses([(i, t) for i, t, _ in rows])


def near(a, b, k):
    """Whether two lines are within k edits: by their letters first, then by all edits."""
    if abs(len(a) - len(b)) > k or sum(abs(n) for n in (Counter(a) - Counter(b)).values()) > k or sum((Counter(b) - Counter(a)).values()) > k:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1] <= k


def without_lines(docs, k=2, least=20):
    lines = [(i, p, x) for i, t in docs for p, x in enumerate((t or "").split("\n")) if re.search(r"\S", x)]
    first, by_size = {}, defaultdict(list)
    for i, p, x in lines:
        first[x] = min(first.get(x, (i, p)), (i, p))
    for x in first:
        by_size[len(x)].append(x)
    gone = {x for x in first if len(x) >= least and any(first[y] < first[x] and near(x, y, k) for n in range(max(len(x) - k, least), len(x) + k + 1) for y in by_size[n])}
    kept = lambda i, t: "\n".join(x for p, x in enumerate(t.split("\n")) if not re.search(r"\S", x) or not (x in gone or (i, p) > first[x]))
    return [(i, None if t is None else kept(i, t)) for i, t in docs]


def one_of_each_group(docs, shingle=5, percent=80):
    sets = []
    for i, t in docs:
        w = SPACED.findall(lowered(t))
        sets.append({tuple(w[p : p + shingle]) for p in range(len(w) - shingle + 1)} if len(w) >= shingle else ({tuple(w)} if w else set()))
    label = list(range(len(docs)))
    order = sorted(range(len(docs)), key=lambda x: docs[x][0])
    find = lambda x: x if label[x] == x else find(label[x])
    rank = {x: n for n, x in enumerate(order)}
    for x in range(len(docs)):
        for y in range(x):
            if sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                a, b = sorted((find(x), find(y)), key=rank.get)
                label[b] = a
    return [docs[x] for x in range(len(docs)) if find(x) == x]


def test_pipeline_over_all_documents(spark):
    """The whole run: rows and words of the decoded tokens, by plain Python from what the quality stage keeps."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    kept = {r.doc_id for r in QUERIES["op8_quality_rules"](spark, sf).filter("kept").collect()}
    assert 0 < len(kept) < len(docs)
    left = one_of_each_group(without_lines([(i, t) for i, t in sorted(docs.items()) if i in kept]))
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    sizes = {i: (n, hit) for i, n, hit, _ in brute_decontamination([(i, t, None) for i, t in left], items)}
    assert any(hit for _, hit in sizes.values())
    model = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.default_model())
    got = {r.doc_id: model.decode(list(r.ids)) for r in corpus_pipeline.run(spark, sf).collect()}
    assert sorted(got) == sorted(i for i, _ in left)
    texts = dict(left)
    for i, text in got.items():
        words = ALNUM.findall(lowered(text))
        assert len(words) == sizes[i][0] - sizes[i][1]
        if not sizes[i][1]:
            assert words == ALNUM.findall(lowered(texts[i]))


def test_the_fit_doesn_t_hang_on_the_order_of_rows(spark):
    """Documents that share a doc_id: the one with the least numbers trains, whatever comes first."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    twice = docs.unionByName(docs.selectExpr("doc_id + 1 AS doc_id", "text"))
    a, b = (quality_rules.train(d, labels) for d in (twice.coalesce(1), twice.repartition(7).orderBy("text", ascending=False)))
    assert all((x == y).all() for x, y in ((a.feature, b.feature), (a.cut, b.cut), (a.value, b.value)))


@pytest.mark.parametrize("most", [5])
def test_samples_are_bounded_where_ids_tie(spark, most):
    """Null ids and equal rows don't bring the whole corpus into a sample."""
    from pyspark.sql import functions as F

    from veilspark.llm import language_id

    rows = [(None, "the same words again", "en")] * 300 + [(None, f"word{i} und so weiter", "de") for i in range(300)]
    model = language_id.train(table(spark, rows), F.lit(True), max_docs=most)
    assert model is not None and set(model.languages) <= {"de", "en"}
    import numpy as np

    assert float(np.exp(model.log_prior).sum()) == pytest.approx(1.0)
