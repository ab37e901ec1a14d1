r"""Repairing the structure of conversations: the cheapest edits after which roles read ``(s?(ua)+)?``.

Rows of a conversation stand by turn (nulls first; ties by role, then text). The first fault of a row counts: *blank* (nothing but
ASCII white space), *duplicate* (role and text stood earlier in the conversation), *truncated* (the last character that isn't white
space isn't one of ``.!?``). Edits: K keeps a row (0), R gives it the role that fits (1), D deletes it (2; blank and duplicate rows
have to go), I inserts an empty row of the role that fits (5). A truncated row that stays adds 5.

The grammar has four states: the start, behind ``s``, behind ``u``, behind ``a``. As in Wu and Manber's matching with errors, there is
one layer for each cost: for each row a bitset of the states from which the rest can be accepted at that cost. A layer follows from
the layers below it. The first layer that accepts from the start gives the cost; a walk over the layers that takes the least letter
which still fits what is left gives the least audit.

A conversation of ordinary size is worked on in the one task that its id is dealt to, without being gathered in Spark. One of more
than LARGE_ROWS rows or LARGE_BYTES of text is cut into blocks by range, so that its rows lie in many tasks: a block's layers hold one
bitset for each state in which it may end, which gives the block's costs between any two states; one small row a block is chained
backward (costs to the end) and, after the blocks are walked from each state at once, forward (which walk is taken).

Nulls in role and text are one space; null conv_ids make one conversation; a null turn stands first. A row whose role is empty or has
another initial fits nowhere unless it gets a role. Equal rows are duplicates of each other. An empty table gives an empty result;
other columns are not read, so their names can't clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, groupby, islice
from operator import itemgetter

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..sources.scratch import cut

#: A conversation beyond one of these is worked on in blocks.
LARGE_ROWS, LARGE_BYTES = 20_000, 32 << 20
#: Rows of a block.
BLOCK = 256
NEVER = 1 << 60

_WORD = re.compile(r"[^\x20\x09-\x0D]")
_SPACE = " \t\n\x0b\x0c\r"
_INITIAL = {"s": 1, "u": 2, "a": 3}
#: The state behind a role that fits: user behind the start, s and a; assistant behind u.
_FITS = (2, 2, 3, 2)
_ROLE = {2: "user", 3: "assistant"}
_ONES = 0x1111  # the lowest bit of each end's four states


def _behind(initial: int, r: int) -> int:
    """States from which a row of this initial leads into the bitset r, for each of four ends at once."""
    to = r >> initial & _ONES
    if initial == 1:
        return to
    return to | to << 1 | to << 3 if initial == 2 else to << 2


@lru_cache(maxsize=1 << 14)
def layers(marks: tuple[int, ...], tail: bool, starts: int = 15) -> tuple[tuple[tuple[int, ...], ...], ...]:
    """costs[row][state][end]: what the rows from ``row`` on cost from one state to another. A mark is a row's initial (0: none
    that fits), plus 4 if it is truncated. With ``tail`` rows can also be put in behind the last one, and layers end once the ``starts`` accept."""
    n = len(marks)
    costs = [[[NEVER] * 4 for _ in range(4)] for _ in range(n + 1)]
    seen = [0] * (n + 1)
    made: list[list[int]] = []
    for cost in range(2 * n + 11):  # deleting all and two insertions reach all that can be reached
        layer = [0] * (n + 1)
        below = lambda d, i: made[cost - d][i] if 0 < d <= cost else layer[i] if d == 0 else 0  # noqa: E731, B023
        for i in range(n, -1, -1):
            r = 0
            if i == n:
                r = 0x8421 if cost == 0 else 0
            else:
                initial, more = marks[i] & 3, 5 * (marks[i] >> 2)
                if initial:
                    r |= _behind(initial, below(more, i + 1))
                given = below(more + 1, i + 1)
                r |= _behind(2, given) | _behind(3, given) | below(2, i + 1)
            if i < n or tail:
                put = below(5, i)
                r |= _behind(2, put) | _behind(3, put)
            layer[i] = r
            new = r & ~seen[i]
            seen[i] |= new
            while new:
                bit = new & -new
                at = bit.bit_length() - 1
                costs[i][at & 3][at >> 2] = cost
                new ^= bit
        made.append(layer)
        if tail and not starts & ~(seen[0] | seen[0] >> 12):
            break
    return tuple(tuple(tuple(s) for s in row) for row in costs)


#: Behind the last row: what the rows cost that are still missing, from one state to another.
MISSING = ((0, NEVER, 5, 10), (NEVER, 0, 5, 10), (NEVER, NEVER, 0, 5), (NEVER, NEVER, 5, 0))


def walk(marks: tuple[int, ...], must: tuple[bool, ...], state: int, rest: tuple[int, ...], tail: bool, starts: int = 15) -> tuple[str, int]:
    """The least letters among the cheapest from a state, and the state behind them. ``must``: rows that have to go; ``marks`` has the
    others alone. ``rest[end]`` is what follows behind the block."""
    costs, n = layers(marks, tail, starts), len(marks)
    need = lambda i, s: min(c + r for c, r in zip(costs[i][s], rest, strict=True))
    left, i, at, out = need(0, state), 0, 0, []
    while True:
        while at < len(must) and must[at]:  # D is the least letter
            out.append("D")
            at += 1
        if i < n and need(i + 1, state) == left - 2:
            out.append("D")
            i, at, left = i + 1, at + 1, left - 2
            continue
        to = _FITS[state]
        if (i < n or tail) and left >= 5 and need(i, to) == left - 5:
            out.append("I")
            state, left = to, left - 5
            continue
        if i == n:
            return "".join(out), state
        initial, more = marks[i] & 3, 5 * (marks[i] >> 2)
        keeps = initial and _behind(initial, 1 << initial) >> state & 1
        if keeps and need(i + 1, initial) == left - more:
            out.append("K")
            state, left = initial, left - more
        else:
            out.append("R")
            state, left = to, left - more - 1
        i, at = i + 1, at + 1


#: What follows the last row: nothing, at the start or behind an ``a``.
ACCEPTS = (0, NEVER, NEVER, 0)


@lru_cache(maxsize=1 << 16)
def _solved(marks: tuple[int, ...], must: tuple[bool, ...]) -> tuple[int, str]:
    costs = layers(marks, True, 1)
    return min(costs[0][0][0], costs[0][0][3]) + 2 * sum(must), walk(marks, must, 0, ACCEPTS, True, 1)[0]


def applied(rows: list[tuple[str, str]], letters: str, state: int = 0) -> Iterator[tuple[str, str]]:
    """(role, text) of the rows after the edits."""
    at = 0
    for letter in letters:
        if letter == "I":
            state = _FITS[state]
            yield _ROLE[state], ""
            continue
        role, text = rows[at]
        at += 1
        if letter == "K":
            state = _INITIAL[role[:1]]
            yield role, text
        elif letter == "R":
            state = _FITS[state]
            yield _ROLE[state], text


def mark(role: str, text: str) -> int:
    """A row's initial, plus 4 if it is truncated; -1 if it is blank."""
    if not _WORD.search(text):
        return -1
    return _INITIAL.get(role[:1], 0) + (0 if text.rstrip(_SPACE)[-1] in ".!?" else 4)


def illegal_pairs(initials: list[int]) -> int:
    return sum((a, b) not in ((1, 2), (2, 3), (3, 2)) for a, b in zip(initials, initials[1:], strict=False))


def mended(rows: list[tuple[int | None, str, str]]) -> dict:
    """One conversation of (turn, role, text) in order."""
    seen, marks, must, counts = set(), [], [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        m = mark(role, text)
        fault = "blank" if m < 0 else "duplicate" if (role, text) in seen else "truncated" if m & 4 else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        must.append(fault in ("blank", "duplicate"))
        if not must[-1]:
            marks.append(m)
    cost, audit = _solved(tuple(marks), tuple(must))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    said = [(r, t) for _, r, t in rows]
    return counts | {"gaps": gaps, "illegal": illegal_pairs([_INITIAL.get(r[:1], 0) for r, _ in said]), "cost": cost, "audit": audit, "repaired": list(applied(said, audit))}


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _order() -> list[Column]:
    return [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def _mapped(df: DataFrame, work: Callable[[Iterator[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """Runs ``work`` over the rows of each partition in order, as a stream."""
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = work(row for batch in batches for row in batch.to_pylist())
        while some := list(islice(done, 64)):
            yield pa.RecordBatch.from_pylist(some, schema=arrow)

    return df.mapInArrow(task, schema)


def _kind(rows: DataFrame) -> str:
    return dict(rows.dtypes)["conv_id"]


SAID = "array<struct<role:string,text:string>>"


def _said(rows: Iterator[tuple[str, str]]) -> list[dict]:
    return [{"role": r, "text": t} for r, t in rows]


def _small(rows: DataFrame) -> DataFrame:
    """(conv_id, counts, audit, repaired) of conversations whose rows lie in one task, read as a stream in order."""

    def work(given: Iterator[dict]) -> Iterator[dict]:
        for conv, own in groupby(given, itemgetter("conv_id")):
            done = mended([(r["turn"], r["role"], r["text"]) for r in own for _ in range(r["times"])])
            yield done | {"conv_id": conv, "repaired": _said(done["repaired"])}

    own = rows.select("conv_id", "turn", "role", "text", "times").repartition("conv_id").sortWithinPartitions(*_order())
    return _mapped(own, work, f"conv_id {_kind(rows)}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired {SAID}")


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """(conv_id, no, rows): large conversations in blocks of ``size`` rows; a block lies in one task, a conversation in many. ``no`` is in
    the order of the rows. Equal rows are counted before they meet, and a text seen in many turns meets its first turn by a join."""
    counted = rows.filter("times > 0").groupBy("conv_id", "turn", "role", "text").agg(F.sum("times").alias("times"))
    # The least turn, nulls first, by role and text.
    firsts = counted.groupBy("conv_id", "role", "text").agg(F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn")).alias("first"))
    a, b = counted.alias("a"), firsts.alias("b")
    both = a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.role") == F.col("b.role")) & (F.col("a.text") == F.col("b.text")))
    marked = both.select("a.*", (~F.col("a.turn").eqNullSafe(F.col("b.first.turn"))).alias("again"))

    def work(given: Iterator[dict]) -> Iterator[dict]:
        from pyspark import TaskContext

        no = TaskContext.get().partitionId() << 32  # ranges are in order of the partitions
        for conv, own in groupby(given, itemgetter("conv_id")):
            own = ({k: v for k, v in r.items() if k != "conv_id"} for r in own)
            while some := list(islice(own, size)):
                yield {"conv_id": conv, "no": no, "rows": some}
                no += 1

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = marked.repartitionByRange(parts, *_order()).sortWithinPartitions(*_order()).select("conv_id", "turn", "role", "text", "again", "times")
    return cut(_mapped(own, work, f"conv_id {_kind(rows)}, no long, rows array<struct<turn:long,role:string,text:string,again:boolean,times:long>>"))


def _marked(rows) -> tuple[tuple[int, ...], tuple[bool, ...], list[tuple[str, str]], dict[str, int]]:
    """marks, rows that have to go, (role, text), and the faults of a block."""
    marks, must, said, counts = [], [], [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for r in rows:
        m = mark(r["role"], r["text"])
        for copy in range(int(r["times"])):
            again = bool(r["again"]) or copy > 0
            must.append(m < 0 or again)
            said.append((r["role"], r["text"]))
            if must[-1]:
                counts["blank" if m < 0 else "duplicate"] += 1
            else:
                marks.append(m)
                counts["truncated"] += m >> 2
    counts["illegal"] = illegal_pairs([_INITIAL.get(r[:1], 0) for r, _ in said])
    return tuple(marks), tuple(must), said, counts


def _large(rows: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """As (conv_id, counts, audit) and, block by block, (conv_id, no, rows after the edits)."""
    blocks, kind = _blocks(rows, size), _kind(rows)

    def costs(given: Iterator[dict]) -> Iterator[dict]:
        for r in given:
            marks, must, said, counts = _marked(r["rows"])
            ends = {"head": _INITIAL.get(said[0][0][:1], 0), "last": _INITIAL.get(said[-1][0][:1], 0)}
            yield {"conv_id": r["conv_id"], "no": r["no"], "costs": [c for s in layers(marks, False)[0] for c in s], "must": 2 * sum(must)} | counts | ends

    priced = cut(_mapped(blocks, costs, f"conv_id {kind}, no long, costs array<long>, must long, blank long, duplicate long, truncated long, illegal long, head int, last int"))

    def backward(own: pd.DataFrame) -> pd.DataFrame:
        """What follows each block, from each state it may end in; behind the last one rows can be put in."""
        own = own.sort_values("no")
        after, out = [min(c + r for c, r in zip(row, ACCEPTS, strict=True)) for row in MISSING], []
        for c in reversed(own.costs.tolist()):
            out.append(after)
            after = [min(int(c[4 * s + x]) + after[x] for x in range(4)) for s in range(4)]
        seams = [(a, b) not in ((1, 2), (2, 3), (3, 2)) for a, b in zip(own["last"].tolist(), own["head"].tolist()[1:], strict=False)]
        return pd.DataFrame({"conv_id": own.conv_id, "no": own.no, "rest": out[::-1], "seam": [*seams, False], "is_last": [False] * (len(own) - 1) + [True], "total": [after[0]] * len(own)})

    rest = priced.groupBy("conv_id").applyInPandas(backward, f"conv_id {kind}, no long, rest array<long>, seam boolean, is_last boolean, total long")
    same = lambda a, b: a["conv_id"].eqNullSafe(b["conv_id"]) & (a["no"] == b["no"])

    def walks(given: Iterator[dict]) -> Iterator[dict]:
        for r in given:
            marks, must, _, _ = _marked(r["rows"])
            after = ACCEPTS if r["is_last"] else tuple(r["rest"])
            done = [walk(marks, must, s, after, r["is_last"]) for s in range(4)]
            yield {"conv_id": r["conv_id"], "no": r["no"], "audits": [a for a, _ in done], "ends": [e for _, e in done]}

    ready = blocks.join(rest, same(blocks, rest)).select(blocks["*"], "rest", "is_last")
    walked = cut(_mapped(ready, walks, f"conv_id {kind}, no long, audits array<string>, ends array<int>"))

    def forward(own: pd.DataFrame) -> pd.DataFrame:
        own, state, out = own.sort_values("no"), 0, []
        for ends in own.ends:
            out.append(state)
            state = int(ends[state])
        return pd.DataFrame({"conv_id": own.conv_id, "no": own.no, "state": out})

    states = walked.select("conv_id", "no", "ends").groupBy("conv_id").applyInPandas(forward, f"conv_id {kind}, no long, state int")
    chosen = cut(walked.join(states, same(walked, states)).select(walked["conv_id"], walked["no"], "state", F.get("audits", F.col("state")).alias("audit")))
    parts = {
        "turns": rows.filter("times > 0").groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps")),
        "sums": priced.join(rest, same(priced, rest)).groupBy(priced["conv_id"]).agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")], (F.sum("illegal") + F.sum(F.col("seam").cast("long"))).alias("illegal"), (F.max("total") + F.sum("must")).alias("cost")),
        "letters": chosen.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("no", "audit"))), lambda x: x["audit"]), "").alias("audit")),
    }
    one = rows.select("conv_id").distinct().alias("ids")
    for name, part in parts.items():
        one = one.join(part.alias(name), F.col("ids.conv_id").eqNullSafe(F.col(f"{name}.conv_id")), "left")
    told = one.select("ids.conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS], F.coalesce("audit", F.lit("")).alias("audit"))

    def rewritten(given: Iterator[dict]) -> Iterator[dict]:
        for r in given:
            yield {"conv_id": r["conv_id"], "no": r["no"], "repaired": _said(applied(_marked(r["rows"])[2], r["audit"], r["state"]))}

    ready = blocks.join(chosen, same(blocks, chosen)).select(blocks["*"], "state", "audit")
    return told, _mapped(ready, rewritten, f"conv_id {kind}, no long, repaired {SAID}")


def _digests(done: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of large conversations. A digest needs a conversation's rows one after the other; they run through
    its task as a stream and aren't kept."""
    def work(given: Iterator[dict]) -> Iterator[dict]:
        for conv, own in groupby(given, itemgetter("conv_id")):
            digest, between = hashlib.sha256(), ""
            for r in chain.from_iterable(x["repaired"] for x in own):
                digest.update(f"{between}{r['role']}:{r['text']}".encode())
                between = "\n"
            yield {"conv_id": conv, "repaired_sha256": digest.hexdigest()}

    return _mapped(done.repartition("conv_id").sortWithinPartitions("conv_id", "no"), work, f"conv_id {_kind(done)}, repaired_sha256 string")


def _given(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and times: how often a row stands (0: not at all, but its conversation is there)."""
    times = F.col("times").cast("long") if "times" in turns.columns else F.lit(1).cast("long")
    return turns.select("conv_id", F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")], times.alias("times"))


def _parted(turns: DataFrame, large_rows: int, large_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary conversations and, if there are any, of large ones."""
    given = _given(turns)
    sizes = given.groupBy("conv_id").agg(F.sum("times").alias("n"), F.sum(F.octet_length("text") * F.col("times")).alias("bytes"))
    large = cut(sizes.filter((F.col("n") > large_rows) | (F.col("bytes") > large_bytes)).select("conv_id"))
    if large.isEmpty():
        return given, None
    same = given["conv_id"].eqNullSafe(large["conv_id"])
    return given.join(large, same, "left_anti"), given.join(large, same, "left_semi")


def repaired_turns(turns: DataFrame, large_rows: int = LARGE_ROWS, large_bytes: int = LARGE_BYTES, block: int = BLOCK) -> DataFrame:
    """(conv_id, at, role, text): the repaired rows of all conversations (conv_id, turn, role, text) in order of ``at``."""
    small, large = _parted(turns, large_rows, large_bytes)
    out = _small(small).select("conv_id", F.posexplode("repaired").alias("at", "r")).select("conv_id", F.col("at").cast("long").alias("at"), "r.*")
    if large is None:
        return out
    told = _large(large, block)[1].select("conv_id", "no", F.posexplode("repaired").alias("at", "r"))
    # A block's number, then the place in it.
    return out.unionByName(told.select("conv_id", (F.col("no") * F.lit(1 << 20) + F.col("at")).alias("at"), "r.*"))


def audits(turns: DataFrame, large_rows: int = LARGE_ROWS, large_bytes: int = LARGE_BYTES, block: int = BLOCK) -> DataFrame:
    """For each conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit and the SHA-256 of the repaired ``role:text`` lines."""
    small, large = _parted(turns, large_rows, large_bytes)
    lines = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    out = _small(small).select("conv_id", *COUNTS, "audit", F.sha2(lines, 256).alias("repaired_sha256"))
    if large is None:
        return out
    told, done = _large(large, block)
    digests = _digests(done)
    joined = told.join(digests, told["conv_id"].eqNullSafe(digests["conv_id"]), "left")
    return out.unionByName(joined.select(told["*"], F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with ``times``, damaged by a hash of ``conv_id:turn``: dropped, emptied, without ``.!?``, repeated, or said by the user."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(said("conv_id"), F.lit(":"), said("turn")), "UTF-8")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text"))
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(said("role")).alias("role"),
        F.when(kind == 0, "").otherwise(text).alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits(damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


# ---- the same in SQL: costs and least letters by state, row by row


def _sql_step(state: int, cost: str, letters: str) -> str:
    return f"{{'c': s.p[{state}].c + {cost}, 'a': s.p[{state}].a || '{letters}'}}"


def _sql_least(*steps: str) -> str:
    return f"list_min([{', '.join(steps)}])"


_SQL_NEVER = "{'c': 1000000000, 'a': ''}"
_SQL_PUT = "{'p': [" + _SQL_NEVER + "], 'ini': -1, 'must': false, 'more': 0}"
_SQL_ROW = "{'p': [" + _SQL_NEVER + "], 'ini': r.ini, 'must': r.must, 'more': r.more}"
#: States 1 to 4: the start, behind s, behind u, behind a.
_SQL_PUT_IN = ", ".join([
    "s.p[1]", "s.p[2]", _sql_least("s.p[3]", *[_sql_step(x, "5", "I") for x in (1, 2, 4)], _sql_step(3, "10", "II")),
    _sql_least("s.p[4]", _sql_step(3, "5", "I"), *[_sql_step(x, "10", "II") for x in (1, 2, 4)]),
])


def _sql_taken(state: int, initial: int, froms: tuple[int, ...], given: bool) -> str:
    keeps = [_sql_step(x, f"CASE WHEN r.ini = {initial} THEN r.more ELSE 1000000000 END", "K") for x in froms]
    return _sql_least(_sql_step(state, "2", "D"), *keeps, *([_sql_step(x, "1 + r.more", "R") for x in froms] if given else []))


_SQL_TAKEN = ", ".join([_sql_step(1, "2", "D"), _sql_taken(2, 1, (1,), False), _sql_taken(3, 2, (1, 2, 4), True), _sql_taken(4, 3, (3,), True)])
_SQL_GONE = ", ".join(_sql_step(x, "2", "D") for x in (1, 2, 3, 4))
SQL = (
    r"""
WITH t AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), n)) AS crc),
g AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), h AS (
  SELECT g.*, xor(list_reduce(list_transform(string_split(k, ''), lambda x: CAST(ord(x) AS BIGINT)), lambda c, b: xor(c >> 8, crc[xor(c & 255, b) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS kind FROM g, t
), d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM h WHERE kind <> 0
), o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM d),
f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
    CASE left(role, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 WHEN 'a' THEN 3 ELSE 0 END AS ini, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM o
), c AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
    list({'role': role, 'text': text, 'ini': ini, 'must': fault IN ('blank', 'duplicate'), 'more': CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END} ORDER BY i) AS rows
  FROM f GROUP BY conv_id
), e AS (
  -- Before each row, and at the end, a step that may put rows in.
"""
    + f"""  SELECT c.*, list_reduce(list_concat(flatten(list_transform(rows, lambda r: [{_SQL_PUT}, {_SQL_ROW}])), [{_SQL_PUT}]),
    lambda s, r: {{'p': CASE WHEN r.ini = -1 THEN [{_SQL_PUT_IN}] WHEN r.must THEN [{_SQL_GONE}] ELSE [{_SQL_TAKEN}] END, 'ini': 0, 'must': false, 'more': 0}},
    {{'p': [{{'c': 0, 'a': ''}}, {_SQL_NEVER}, {_SQL_NEVER}, {_SQL_NEVER}], 'ini': 0, 'must': false, 'more': 0}}).p AS ends
  FROM c
"""
    + r"""), b AS (SELECT *, list_min([ends[1], ends[4]]) AS best FROM e),
r AS (
  SELECT *, list_reduce(list_transform(string_split(best.a, ''), lambda x: {'x': x, 'at': 0, 'state': 0, 'out': CAST([] AS VARCHAR[])}), lambda s, l: {'x': '', 'at': s.at + CASE WHEN l.x = 'I' THEN 0 ELSE 1 END,
    'state': CASE l.x WHEN 'D' THEN s.state WHEN 'K' THEN rows[s.at + 1].ini ELSE CASE WHEN s.state = 2 THEN 3 ELSE 2 END END,
    'out': CASE l.x WHEN 'D' THEN s.out WHEN 'K' THEN list_append(s.out, rows[s.at + 1].role || ':' || rows[s.at + 1].text)
      ELSE list_append(s.out, CASE WHEN s.state = 2 THEN 'assistant' ELSE 'user' END || ':' || CASE WHEN l.x = 'I' THEN '' ELSE rows[s.at + 1].text END) END},
    {'x': '', 'at': 0, 'state': 0, 'out': CAST([] AS VARCHAR[])}).out AS said
  FROM b
)
SELECT x.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) x LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM x.conv_id
"""
)
