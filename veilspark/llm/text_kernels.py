r"""Vectorised word kernels shared by the text operators.

Texts stay UTF-8 bytes in one buffer (an Arrow string column's own layout: a data buffer and offsets). Word borders,
hashes and windows come from numpy passes over that buffer, so that no Python object is made per word. All of them are
helpers of ``map_texts``, which runs them in Spark tasks on bounded pieces of a partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that one numpy pass works on; a single longer text is one pass of its own.
PASS_BYTES = 1 << 19
BATCH_BYTES = 4 << 20

U = np.uint64
_K1, _K2, _K3 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
_S31, _S29, _S32 = U(31), U(29), U(32)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: a bijection that spreads every input bit."""
    x = x ^ (x >> _S31)
    x = x * _K2
    x = x ^ (x >> _S29)
    x = x * _K3
    return x ^ (x >> _S32)


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a sequence from the hashes of its two parts; the order counts."""
    return mix(left * _K1 + mix(right + _K3))


def _table(in_word: Callable[[int], bool]) -> np.ndarray:
    return np.array([in_word(b) for b in range(256)], dtype=bool)


#: Words are runs of anything but ASCII white space.
SPACED = _table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Words are runs of ASCII letters, digits and everything beyond ASCII: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once lowered.
ALNUM = _table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
#: A-Z to a-z, all else unchanged.
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)
#: One random-looking 64-bit value per byte value.
_BYTE_HASH = mix(np.arange(1, 257, dtype=U) * _K1)
#: Places of a word whose values are looked up.
_NEAR = 64
_NEAR_HASH = mix(np.add.outer(np.arange(_NEAR, dtype=U) * _K1, _BYTE_HASH)).ravel()


def placed(data: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A value for each byte and its place, with no relation between places, so that sums over a word tell strings apart that are
    made to cancel in a polynomial."""
    out = _NEAR_HASH[np.minimum(place, _NEAR - 1) << 8 | data]
    far = np.flatnonzero(place >= _NEAR)
    if len(far):
        out[far] = mix(_BYTE_HASH[data[far]] + place[far].astype(U) * _K1)
    return out


@dataclass
class Words:
    """Words of a run of texts. ``doc[i]`` is the text of word i, ``first[d]`` the first word of text d."""

    data: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def left(self) -> np.ndarray:
        """Words from each one to the end of its text, itself included."""
        return self.first[self.doc + 1] - np.arange(len(self.doc))

    def bytes(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def split_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, lower: bool = False, hashed: bool = True) -> Words:
    """Words of the texts data[offsets[d]:offsets[d + 1]]; a word never crosses a text's end."""
    if lower:
        data = LOWER[data]
    inside = table[data]
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(data):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        borders = offsets[(offsets > 0) & (offsets < len(data))]
        before[borders], after[borders - 1] = False, False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    doc = np.searchsorted(offsets, start, side="right") - 1
    first = np.searchsorted(start, offsets, side="left")
    value = np.zeros(len(start), dtype=U)
    if hashed and len(start):
        length = end - start
        place = np.arange(len(data), dtype=np.int32)
        place -= np.repeat(np.concatenate(([0], start)).astype(np.int32), np.diff(np.concatenate(([0], start, [len(data)]))))
        np.minimum(place, int(length.max()) - 1, out=place)
        weighted = placed(data, place)
        weighted[~inside] = 0
        value = np.add.reduceat(weighted, start)
        value = mix(value + length.astype(U) * _K1)
    return Words(data, doc, start, end, first, value)


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on, built by doubling; only places with k words left in their text count."""
    out, have, block, size = None, 0, h, 1
    for bit in range(k.bit_length()):
        if k >> bit & 1:
            out = block if out is None else combine(block, _shift(out, size))
            have += size
        if k >> (bit + 1):
            block = combine(block, _shift(block, size))
            size *= 2
    assert have == k
    return out


def _shift(x: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros_like(x)
    if k < len(x):
        out[: len(x) - k] = x[k:]
    return out


def cover(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie inside any of the half-open ranges."""
    d = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(d[:n]) > 0


def sums(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of flags[first[d]:first[d + 1]] for each d."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[first[1:]] - total[first[:-1]]


def runs(values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal neighbours, and the end."""
    if not len(values):
        return np.zeros(1, dtype=np.int64)
    return np.concatenate(([0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]))


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column: counts[d] of the values in turn for each d."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(values, kind))


def pieces(offsets: np.ndarray, most: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Cuts a batch into runs of texts of about ``most`` bytes."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_BYTES where the session has left Spark's own bound, which is 64 MB on each side of every task."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "67108864b":
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")


def map_texts(
    docs: DataFrame,
    work: Callable[[np.ndarray, np.ndarray, pa.RecordBatch], tuple[np.ndarray | None, dict[str, object]]],
    fields: list[tuple[str, str]],
    keep: dict[str, Column] | None = None,
    text: str | Column = "text",
    pass_bytes: int = PASS_BYTES,
    also: dict[str, Column] | None = None,
) -> DataFrame:
    """Runs ``work(bytes, offsets, columns)`` over all texts of ``docs`` inside Spark tasks.

    ``work`` returns (rows, columns): the columns by name, and for each of their rows the index of its text (None: one
    row per text, in order). The result has the ``keep`` columns and ``fields`` (name, type) and no other column of
    ``docs``, so names of extra columns never clash. ``work`` gets the ``keep`` columns, then those in ``also``, which are not
    returned, so that a long list is not repeated in each row made of its text. A partition is worked on in passes of bounded size.
    """
    bound_batches(docs.sparkSession)
    keep = {"doc_id": F.col("doc_id")} if keep is None else keep
    text = F.col(text) if isinstance(text, str) else text
    shown = [*keep.values(), *(also or {}).values()]
    given = docs.select(*[c.alias(f"k{i}") for i, c in enumerate(shown)], text.cast("string").alias("t"))
    kept = [T.StructField(name, given.schema[f"k{i}"].dataType) for i, name in enumerate(keep)]
    schema = T.StructType(kept + [T.StructField(n, T._parse_datatype_string(t)) for n, t in fields])
    names, made, at_text = list(keep), [n for n, _ in fields], len(shown)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema, prefers_large_types=False)
        with np.errstate(over="ignore"):
            for batch in batches:
                data, offsets = string_buffers(batch.column(at_text))
                for lo, hi in pieces(offsets, pass_bytes):
                    part = batch.slice(lo, hi - lo)
                    rows, columns = work(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], part)
                    took = [c if rows is None else c.take(pa.array(rows, pa.int64())) for c in part.columns[: len(names)]]
                    made_columns = [columns[n] if isinstance(columns[n], pa.Array) else pa.array(columns[n]) for n in made]
                    arrays = [a.cast(f.type) if a.type != f.type else a for a, f in zip([*took, *made_columns], arrow, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return given.mapInArrow(task, schema)
