"""Line dedup by a segment-partition edit join, in DataFrame functions alone.

Of the lines with at least ``min_chars`` characters, a line goes if an earlier one (smaller doc_id, or the same document and
an earlier place) is within ``edits`` edits of it. Equal lines are first reduced to one, with the place of its first copy.

1. *Segments.* A line of length n is cut into ``edits + 1`` segments; any line within ``edits`` edits holds one of them
   unchanged. The index has (length, segment, content) of each line; the probes are the substrings of a line that could be a
   segment of an equally long or shorter one: for each such length and segment only the starts that the edits left and right
   of it allow. A pair's packed letter counts have to fit too, before it leaves the join.
2. *Verification.* Common ends of a pair are cut off by bisection; the rest goes through a banded bit-parallel automaton: one
   register of ``2 * edits + 1`` bits for each number of edits, moved along the diagonals of the band, one character a step.

Copies of a line and popular segments are pre-aggregated or meet in equi-joins that adaptive execution splits.

Two edits make another line of a short one, so lines under ``min_chars`` never meet in the edit join. With ``short_copies``
exact copies of them go as well: each such line that holds more than white space stays at its first place alone.

Defined results: a null text stays null and an empty one empty. Lines shorter than ``min_chars`` stay, copies included, unless
``short_copies`` is set; blank lines always stay. A document whose lines all go keeps its row with an empty text. A null
doc_id is the least of all; rows that share a doc_id and a place are not earlier than each other. Places to drop are kept by
doc_id and a hash of the text, so rows that share a doc_id lose and gather nothing of each other. Extra columns pass through
unchanged, but for one with the name of the count, which takes its place.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import cut
from ..sources.tables import spread

EDITS = 2
MIN_CHARS = 20
_LEAST = -(2**63)
_SEED = "line"
#: Letters whose counts a pair has to agree on nearly before its lines are compared.
COUNTED = "etanoisrhdlu"


def _row_key() -> list[Column]:
    """d and k: the doc_id, null as the least number, and the text's hash."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("d"), F.xxhash64("text").alias("k")]


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(d, k, pos, line) of the lines that count."""
    return docs.select(*_row_key(), F.posexplode(F.split("text", "\n")).alias("pos", "line")).filter(F.length("line") >= max(min_chars, 1))


def _segment(n: Column, i: int, edits: int) -> tuple[Column, Column]:
    """Start (from 0) and length of segment i of a line of n characters."""
    start = F.floor(n * i / (edits + 1)).cast("int")
    return start, F.floor(n * (i + 1) / (edits + 1)).cast("int") - start


def _key(n: Column, i: int, content: Column) -> Column:
    return F.xxhash64(n, F.lit(i), content)


#: Probe keys made in one pass over the lines. The code of many at once is more than the JVM compiles, and twice as slow.
KEYS_AT_ONCE = 3


def index_keys(edits: int) -> Column:
    """Keys of a line's own segments."""
    n = F.col("n")
    keys = []
    for i in range(edits + 1):
        start, size = _segment(n, i, edits)
        keys.append(_key(n, i, F.substring(F.col("line"), start + 1, size)))
    return F.array(*keys)


def probe_keys(edits: int) -> list[Column]:
    """Keys that segments of lines up to ``edits`` shorter can have in this line; null where one would reach beyond it."""
    keys = []
    for shorter in range(edits + 1):
        n = F.col("n") - shorter
        for i in range(edits + 1):
            start, size = _segment(n, i, edits)
            low = max(-i, shorter - (edits - i))
            high = min(i, shorter + (edits - i))
            for shift in range(low, high + 1):
                inside = (start + shift >= 0) & (start + shift + size <= F.col("n"))
                keys.append(F.when(inside, _key(n, i, F.substring(F.col("line"), start + shift + 1, size))))
    return keys


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def letter_counts(line: Column) -> Column:
    """Counts of twelve letters, modulo 32, and of all other characters, modulo 16, packed into one number."""
    counts = [F.octet_length(line) - F.octet_length(F.replace(line, F.lit(letter), F.lit(""))) for letter in COUNTED]
    rest = (F.length(line) - sum(counts[1:], counts[0])) % 16
    out = F.shiftleft(rest.cast("long"), 5 * len(COUNTED))
    for i, n in enumerate(counts):
        out = out.bitwiseOR(F.shiftleft((n % 32).cast("long"), 5 * i))
    return out


def counts_fit(a: Column, b: Column, edits: int) -> Column:
    """Whether two packed counts can belong to lines within ``edits`` edits: an edit moves two counts by one at most."""
    total = F.lit(0).cast("long")
    for i in range(len(COUNTED) + 1):
        most = 32 if i < len(COUNTED) else 16
        d = F.abs(F.shiftright(a, 5 * i).bitwiseAND(F.lit(most - 1)) - F.shiftright(b, 5 * i).bitwiseAND(F.lit(most - 1)))
        total = total + F.least(d, most - d)
    return total <= 2 * edits


def _common(a: Column, b: Column, left: bool) -> Column:
    """Number of characters that a and b share at an end, by bisection."""
    part = (lambda s, n: F.substring(s, F.lit(1), n)) if left else (lambda s, n: F.right(s, n))

    def bisect(most: Column) -> Column:
        steps = F.transform(F.sequence(F.lit(0), F.ceil(F.log2(most + 1)).cast("int")), lambda i: F.pow(F.lit(2), F.ceil(F.log2(most + 1)).cast("int") - i).cast("int"))
        more = lambda have, n: F.when((n <= most) & (part(a, n) == part(b, n)), n).otherwise(have)
        return F.aggregate(steps, F.lit(0), lambda have, step: more(have, have + step))

    return _let(F.least(F.length(a), F.length(b)), bisect)


def within_edits(a: Column, b: Column, edits: int) -> Column:
    """Whether the edit distance of two arrays of characters is at most ``edits``: a banded bit-parallel automaton.

    Bit j of register e at step t says: the first t - edits + j items of a and the first t of b are within e edits."""
    width = 2 * edits + 1
    full = (1 << width) - 1
    start = F.array(*[F.lit(sum(1 << (edits + i) for i in range(e + 1)) & full) for e in range(edits + 1)])

    def step(s: Column, t: Column) -> Column:
        at = lambda j: F.get(a, t + (j - edits - 1))
        hit = lambda j, char: F.when((t + (j - edits) >= 1) & (at(j) == char), F.lit(1 << j)).otherwise(F.lit(0))
        match = F.get(F.transform(F.array(F.get(b, t - 1)), lambda char: sum((hit(j, char) for j in range(1, width)), hit(0, char))), F.lit(0))

        def registers(m: Column) -> Column:
            first = F.array(F.get(s, F.lit(0)).bitwiseAND(m))

            def add(done: Column, e: Column) -> Column:
                fewer, last = F.get(s, e - 1), F.get(done, e - 1)
                moved = fewer.bitwiseOR(F.shiftright(fewer, 1)).bitwiseOR(F.shiftleft(last, 1))
                return F.concat(done, F.array(F.get(s, e).bitwiseAND(m).bitwiseOR(moved).bitwiseAND(F.lit(full))))

            return F.aggregate(F.sequence(F.lit(1), F.lit(edits)), first, add) if edits else first

        # A later register holds all that an earlier one does: once the last is empty, so are all, and stay so.
        return F.when(F.get(s, F.lit(edits)) == 0, s).otherwise(_let(match, registers))

    end = F.aggregate(F.slice(F.sequence(F.lit(1), F.size(b) + 1), F.lit(1), F.size(b)), start, step)
    mask = F.get(F.array(*[F.lit(1 << j) for j in range(width)]), F.size(a) - F.size(b) + edits)  # null outside the band
    return F.coalesce(F.get(end, F.lit(edits)).bitwiseAND(mask) != 0, F.lit(False))


def similar(a: Column, b: Column, edits: int) -> Column:
    """Whether two strings are within ``edits`` edits."""
    chars = lambda s: F.filter(F.split(s, ""), lambda c: c != "")
    middle = lambda u, v: _let(_common(u, v, False), lambda q: _let(chars(F.left(u, F.length(u) - q)), lambda x: within_edits(x, chars(F.left(v, F.length(v) - q)), edits)))
    tail = lambda s, p: F.substring(s, p + 1, F.length(s))
    test = _let(_common(a, b, True), lambda p: _let(tail(a, p), lambda u: _let(tail(b, p), lambda v: middle(u, v))))
    return (F.abs(F.length(a) - F.length(b)) <= edits) & test


def dropped_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(d, k, gone): for each document that loses lines, the places of those lines."""
    lines = _lines(docs, min_chars).withColumn("h", F.xxhash64("line")).withColumn("g", F.xxhash64(F.lit(_SEED), "line"))
    known = lines.groupBy("h", "g").agg(F.min(F.struct("d", "pos")).alias("at"), F.count("*").alias("copies"), F.first("line").alias("line"))
    known = cut(known.withColumn("n", F.length("line")).withColumn("counts", letter_counts(F.col("line"))))
    index = known.select("h", "counts", F.explode(index_keys(edits)).alias("key"))
    keys = probe_keys(edits)
    some = [known.select(F.col("h").alias("h2"), F.col("counts").alias("counts2"), F.explode(F.array(*keys[i : i + KEYS_AT_ONCE])).alias("key")) for i in range(0, len(keys), KEYS_AT_ONCE)]
    probe = reduce(DataFrame.unionByName, some).filter("key is not null")
    fits = counts_fit(F.col("counts"), F.col("counts2"), edits)
    found = probe.join(index.hint("shuffle_hash"), (probe.key == index.key) & (F.col("h") != F.col("h2")) & fits)
    found = cut(found.select(F.least("h", "h2").alias("h"), F.greatest("h", "h2").alias("h2")).distinct())
    ids = cut(found.select("h").unionByName(found.select(F.col("h2").alias("h"))).distinct())
    texts = cut(known.join(ids, "h", "left_semi").select("h", "g", "at", "line"))
    one = texts.select("h", F.col("g").alias("g1"), F.col("at").alias("at1"), F.col("line").alias("line1"))
    two = texts.select(F.col("h").alias("h2"), F.col("g").alias("g2"), F.col("at").alias("at2"), F.col("line").alias("line2"))
    near = found.join(one, "h").join(two, "h2").filter("at1 <> at2").filter(similar(F.col("line1"), F.col("line2"), edits))
    later = near.select(F.when(F.col("at1") < F.col("at2"), F.struct("h2", "g2")).otherwise(F.struct(F.col("h").alias("h2"), F.col("g1").alias("g2"))).alias("x")).select(F.col("x.h2").alias("h"), F.col("x.g2").alias("g")).distinct()
    later = cut(later.withColumn("near", F.lit(True)))
    marked = known.select("h", "g", "at", "copies").join(later, ["h", "g"], "left").filter("copies > 1 or near").select("h", "g", "at", F.coalesce("near", F.lit(False)).alias("near"))
    gone = lines.select("d", "k", "pos", "h", "g").join(marked, ["h", "g"]).filter(F.col("near") | (F.struct("d", "pos") > F.col("at")))
    return gone.groupBy("d", "k").agg(F.collect_set("pos").alias("gone"))


def dropped_short_copies(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(d, k, short): for each document with later copies of lines under ``min_chars``, their places."""
    lines = _lines(docs, 1).filter((F.length("line") < min_chars) & F.col("line").rlike(r"\S"))
    first = lines.groupBy("line").agg(F.min(F.struct("d", "pos")).alias("at"), F.count("*").alias("copies")).filter("copies > 1")
    gone = lines.join(first.select("line", "at"), "line").filter(F.struct("d", "pos") > F.col("at"))
    return gone.groupBy("d", "k").agg(F.collect_set("pos").alias("short"))


def dedup_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, short_copies: bool = False, removed: str | None = "n_lines_removed") -> DataFrame:
    """All rows and columns of ``docs`` with the lines gone from ``text``, and their number in the column ``removed``, if named."""
    gone = dropped_lines(docs, edits, min_chars)
    if short_copies:
        gone = gone.join(dropped_short_copies(docs, min_chars), ["d", "k"], "full").select("d", "k", F.array_distinct(F.concat(*[F.coalesce(c, F.array().cast("array<int>")) for c in ("gone", "short")])).alias("gone"))
    given = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), *_row_key())
    joined = given.join(gone.hint("shuffle_hash"), ["d", "k"], "left")
    text = F.col("row.text")
    kept = F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(F.col("gone"), i))
    some = F.col("gone").isNotNull() & text.isNotNull()
    columns = [(F.when(some, F.array_join(kept, "\n")).otherwise(text) if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns if c != removed]
    count = [F.when(some, F.size("gone")).otherwise(0).cast("long").alias(removed)] if removed else []
    return joined.select(*columns, *count)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines_removed", F.sha2("text", 256).alias("text_sha256"))


def op6_line_dedup_short_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup with exact copies of short lines."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "text")
    return dedup_lines(docs, short_copies=True).select("doc_id", "n_lines_removed", F.sha2("text", 256).alias("text_sha256"))


SQL = """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents WHERE text IS NOT NULL),
e AS (SELECT * FROM l WHERE length(line) >= 20),
u AS (SELECT line, min((doc_id, pos)) AS fst, length(line) AS n FROM e GROUP BY line),
s AS (SELECT line, fst, n, unnest([0, 1, 2]) AS i, unnest([substring(line, 1, CAST(floor(n / 3.0) AS INT)), substring(line, CAST(floor(n / 3.0) AS INT) + 1, CAST(floor(2 * n / 3.0) AS INT) - CAST(floor(n / 3.0) AS INT)), substring(line, CAST(floor(2 * n / 3.0) AS INT) + 1)]) AS seg FROM u),
p AS (SELECT line, fst, n, n - z AS m, i, unnest(range(-2, 3)) AS o FROM u, unnest([0, 1, 2]) AS za(z), unnest([0, 1, 2]) AS ia(i)),
q AS (SELECT line, fst, m, i, substring(line, CAST(floor(i * m / 3.0) AS INT) + o + 1, CAST(floor((i + 1) * m / 3.0) AS INT) - CAST(floor(i * m / 3.0) AS INT)) AS seg FROM p WHERE floor(i * m / 3.0) + o >= 0),
c AS (SELECT DISTINCT q.line AS a, s.line AS b, q.fst AS at1, s.fst AS at2 FROM q JOIN s ON q.m = s.n AND q.i = s.i AND q.seg = s.seg WHERE q.line <> s.line),
v AS (SELECT DISTINCT CASE WHEN at1 > at2 THEN a ELSE b END AS line FROM c WHERE levenshtein(a, b) <= 2 AND at1 <> at2),
g AS (SELECT e.doc_id, e.pos FROM e JOIN u ON e.line = u.line WHERE (e.doc_id, e.pos) > u.fst OR e.line IN (SELECT line FROM v)),
k AS (SELECT l.doc_id, string_agg(CASE WHEN g.pos IS NULL THEN l.line END, chr(10) ORDER BY l.pos) AS t, count(g.pos) AS n FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_lines_removed, sha256(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(t, '') END) AS text_sha256 FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id
"""
#: The same with later copies of short lines that aren't blank.
SHORT_COPIES_SQL = SQL.replace(
    "\nk AS (",
    r"""
x AS (SELECT line, min((doc_id, pos)) AS fst FROM l WHERE length(line) < 20 AND regexp_matches(line, '[^ \t\n\x0B\f\r]') GROUP BY line),
y AS (SELECT * FROM g UNION ALL SELECT l.doc_id, l.pos FROM l JOIN x ON l.line = x.line WHERE (l.doc_id, l.pos) > x.fst),
k AS (""",
).replace("LEFT JOIN g ON l.doc_id = g.doc_id AND l.pos = g.pos", "LEFT JOIN y AS g ON l.doc_id = g.doc_id AND l.pos = g.pos")
