"""Tables with the awkward cases that every operator has to take."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, k0 string, t int, hash long, n_words string"


def table(spark, rows):
    """Documents with extra columns whose names clash with those that operators make."""
    return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t), "x", 1, 2, "y") for i, t, lang in rows], DOCS)


def prose(seed, n=120, letters="abcdefgh", words=400):
    r = random.Random(seed)
    vocab = ["".join(r.choice(letters) for _ in range(r.randint(2, 7))) for _ in range(words)]
    return " ".join(r.choice(vocab) for _ in range(n))


def awkward():
    a, b = prose(1), prose(2)
    return [
        (1, a, "en"), (2, a, "en"), (3, b + "\n" + a[:300], "en"), (4, None, None), (5, "", "en"), (6, " \t\n ", "fr"), (7, "one", "de"),
        (8, a.upper(), "en"), (9, " ".join(["x"] * 60), "en"), (10, "é ü 日本 ½", "fr"), (11, b, None), (11, b, None), (None, b, "en"), (12, prose(3, 9000), "en"),
        (13, a[: len(a) // 2] + " zz " + b[: len(b) // 2], "en"), (14, "\x00\x0b\x0c null\x00bytes", "en"),
    ]
