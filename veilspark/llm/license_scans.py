"""License scans: an Aho-Corasick pass finds notice phrases and identifier tags; a shunting-yard parser evaluates the tags.

Texts are lower-cased (A-Z), cut into words of letters and digits, and joined by single spaces in one buffer, on which one
automaton of all phrases runs; a phrase matches where its words stand consecutively, whatever separates them. Behind each
identifier tag (``SPDX-License-Identifier``) the rest of the line is read as an expression of identifiers, ``AND``, ``OR``,
``WITH`` and parentheses, turned into postfix order and evaluated to its labels and to whether it leaves a permissive choice.

Defined results: null or empty text has no words, no labels and score 0. An expression that doesn't parse, or that names what
is no known identifier, gives no label and leaves ``permissive`` as it was. Overlapping phrases count each. Documents that repeat are reported once for each row.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import spread
from .text_kernels import ALNUM, lists, map_texts, split_words

# Phrases of the contract and their labels.
BASE_PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Further notice phrases and their labels.
MORE_PHRASES = {
    "apache license version 2 0": "apache-2.0", "gnu general public license version 2": "gpl-2.0", "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl", "gnu affero general public license": "agpl", "mozilla public license": "mpl", "eclipse public license": "epl",
    "bsd license": "bsd", "bsd 2 clause": "bsd-2-clause", "bsd 3 clause": "bsd-3-clause", "isc license": "isc", "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd", "cc0": "cc0", "creative commons attribution": "cc-by", "public domain": "public-domain", "all rights reserved": "proprietary",
    "permission is hereby granted free of charge": "mit", "redistribution and use in source and binary forms": "bsd",
}
TAG = "spdx license identifier"
# First parts of identifiers that count as permissive.
PERMISSIVE = ("mit", "apache", "bsd", "isc", "zlib", "cc0", "cc-by-4", "cc-by-3", "unlicense", "0bsd", "python", "postgresql", "public-domain", "boost", "bsl")
# Identifiers that an expression may name, in lower case; some more by pattern: own references and exceptions.
KNOWN = frozenset(
    "0bsd aal afl-2.1 afl-3.0 agpl-1.0 agpl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.0 apache-1.1 apache-2.0 apsl-2.0 artistic-1.0 artistic-2.0 blueoak-1.0.0 bsd-1-clause bsd-2-clause "
    "bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-4-clause bsl-1.0 busl-1.1 cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 cc-by-nc-3.0 cc-by-nc-4.0 cc-by-nc-nd-4.0 cc-by-nc-sa-3.0 "
    "cc-by-nc-sa-4.0 cc-by-nd-4.0 cc-by-sa-2.0 cc-by-sa-3.0 cc-by-sa-4.0 cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.1 cpal-1.0 cpl-1.0 ecl-2.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2 gfdl-1.2 gfdl-1.3 "
    "gpl-1.0 gpl-2.0 gpl-2.0-only gpl-2.0-or-later gpl-3.0 gpl-3.0-only gpl-3.0-or-later hpnd isc lgpl-2.0 lgpl-2.0-only lgpl-2.0-or-later lgpl-2.1 lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 "
    "lgpl-3.0-only lgpl-3.0-or-later libpng mit mit-0 mpl-1.0 mpl-1.1 mpl-2.0 ms-pl ms-rl ncsa none noassertion odbl-1.0 ofl-1.1 openssl osl-3.0 php-3.01 postgresql psf-2.0 python-2.0 ruby "
    "sspl-1.0 unicode-dfs-2016 unlicense upl-1.0 vim w3c wtfpl x11 zlib zpl-2.1".split()
)
_OTHER = re.compile(r"licenseref-[a-z0-9.-]+|[a-z0-9.-]+-exception(?:-[0-9.]+)?|classpath-exception-2\.0|llvm-exception")
PRECEDENCE = {"OR": 1, "AND": 2, "WITH": 3}
_TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+:-]*")
#: Chance left, after one hit, that the document has no licence notice.
_DOUBT = {"base": 0.2, "more": 0.4, "tag": 0.05}


def is_identifier(word: str) -> bool:
    word = word.lower()
    return word.removesuffix("+") in KNOWN or _OTHER.fullmatch(word) is not None


def to_postfix(expression: str) -> list[str] | None:
    """Identifiers and operators in postfix order; None if the expression is malformed."""
    out: list[str] = []
    stack: list[str] = []
    operand = True
    for token in _TOKEN.findall(expression):
        word = token.upper()
        if token == "(":
            if not operand:
                return None
            stack.append(token)
        elif token == ")" or word in PRECEDENCE:
            if operand:
                return None
            while stack and stack[-1] != "(" and (token == ")" or PRECEDENCE[stack[-1]] >= PRECEDENCE[word]):
                out.append(stack.pop())
            if token != ")":
                stack.append(word)
                operand = True
            elif not stack:
                return None
            else:
                stack.pop()
        else:
            if not operand:
                break  # prose behind the expression
            if not is_identifier(token):
                return None
            out.append(token.lower())
            operand = False
    if operand or "(" in stack:
        return None
    return out + stack[::-1]


def evaluate(expression: str) -> tuple[list[str], bool] | None:
    """Labels of an expression, and whether a permissive choice satisfies it; None if it is malformed."""
    stack: list[tuple[frozenset, bool]] = []
    for token in (postfix := to_postfix(expression)) or ():
        if token in PRECEDENCE:
            (b, right), (a, left) = stack.pop(), stack.pop()
            stack.append((a, left) if token == "WITH" else (a | b, left and right if token == "AND" else left or right))
        else:
            stack.append((frozenset([token]), token.startswith(PERMISSIVE)))
    return (sorted(stack[0][0]), stack[0][1]) if postfix else None


def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    by_phrase: dict[str, list] = {}
    for kind, phrases in (("base", BASE_PHRASES), ("more", MORE_PHRASES), ("tag", {TAG: ""})):
        for phrase, label in phrases.items():
            by_phrase.setdefault(phrase, []).append((kind, label, len(phrase.split())))
    for phrase, said in by_phrase.items():
        a.add_word(f" {phrase} ", (len(phrase), said))
    a.make_automaton()
    return a


def spaced(w, offsets: np.ndarray) -> tuple[str, np.ndarray]:
    """All words in one string, each between single spaces, texts kept apart by a NUL; and each word's place in it."""
    n = len(w.doc)
    length = w.end - w.start
    place = np.cumsum(length) - length + np.arange(n) + 2 * (w.doc + 1)
    out = np.full(int(length.sum()) + n + 2 * (len(offsets) - 1), 0x20, dtype=np.uint8)
    inside = np.repeat(w.start - np.cumsum(length) + length, length) + np.arange(int(length.sum()))
    out[np.repeat(place - np.cumsum(length) + length, length) + np.arange(int(length.sum()))] = w.data[inside]
    before = np.concatenate(([0], np.cumsum(length + 1)))[w.first[:-1]] if n else np.zeros(len(offsets) - 1, dtype=np.int64)
    out[before + 2 * np.arange(len(offsets) - 1)] = 0
    return out.tobytes().decode("latin-1"), place


def scan_licenses(docs: DataFrame, keep: dict | None = None) -> DataFrame:
    """One row per document: the ``keep`` columns (doc_id), n_words, n_base (places of base phrases), first_word and last_word
    (smallest and largest start of those, in words; null without), base_labels, labels and expressions (sorted distinct),
    starts (word indexes of all hits), permissive (of the tags' expressions together; null without any) and score."""
    found: dict[str, object] = {}

    def work(data, offsets, _):
        if "a" not in found:
            found["a"] = automaton()
        n = len(offsets) - 1
        w = split_words(data, offsets, ALNUM, lower=True, hashed=False)
        text, place = spaced(w, offsets)
        base: list[list[int]] = [[] for _ in range(n)]
        base_labels: list[set] = [set() for _ in range(n)]
        labels: list[set] = [set() for _ in range(n)]
        expressions: list[set] = [set() for _ in range(n)]
        permissive: list[bool | None] = [None] * n
        doubt = np.ones(n)
        hits: list[list[int]] = [[] for _ in range(n)]
        for end, (length, said) in found["a"].iter(text):
            i = int(np.searchsorted(place, end - length))
            d = int(w.doc[i])
            for kind, label, words in said:
                if kind == "tag":
                    tail = data[w.end[i + words - 1] : offsets[d + 1]].tobytes()
                    expression = tail.split(b"\n", 1)[0].decode("utf-8", "replace").lstrip(" \t\":='").rstrip()
                    if (value := evaluate(expression)) is None:
                        continue
                    labels[d].update(value[0])
                    expressions[d].add(" ".join(to_postfix(expression)))
                    permissive[d] = value[1] if permissive[d] is None else permissive[d] and value[1]
                else:
                    labels[d].add(label)
                if kind == "base":
                    base[d].append(i - int(w.first[d]))
                    base_labels[d].add(label)
                hits[d].append(i - int(w.first[d]))
                doubt[d] *= _DOUBT[kind]
        strings = lambda x: pa.array([sorted(s) for s in x], pa.list_(pa.string()))
        flat = [sorted(set(x)) for x in hits]
        return None, {
            "n_words": w.counts, "n_base": np.array([len(x) for x in base], dtype=np.int64),
            "first_word": pa.array([min(x, default=None) for x in base], pa.int64()), "last_word": pa.array([max(x, default=None) for x in base], pa.int64()),
            "base_labels": strings(base_labels), "labels": strings(labels), "expressions": strings(expressions),
            "starts": lists(np.array([y for x in flat for y in x], dtype=np.int64), np.array([len(x) for x in flat], dtype=np.int64), pa.int64()),
            "permissive": pa.array(permissive, pa.bool_()), "score": 1 - doubt,
        }

    fields = [
        ("n_words", "long"), ("n_base", "long"), ("first_word", "long"), ("last_word", "long"), ("base_labels", "array<string>"), ("labels", "array<string>"),
        ("expressions", "array<string>"), ("starts", "array<long>"), ("permissive", "boolean"), ("score", "double"),
    ]
    return map_texts(docs, work, fields, keep=keep)


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(spread(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")
