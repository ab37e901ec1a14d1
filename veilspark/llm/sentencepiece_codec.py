"""SentencePiece encoding and decoding by suffix-array matching.

The vocabulary is a SentencePiece BPE model with byte fallback; its pieces and scores (a table of the model's own fixed size)
are read on the driver and broadcast. In each pass of a task:

1. Texts get the model's leading space and are cut into units before each run of spaces: no piece reaches across such a
   border. Equal units are worked on once; a bounded table of a task's units is kept between passes.
2. The units' bytes are indexed a segment at a time: all suffixes, sorted by their next 8 bytes up to the unit's end; those that
   begin like a longer piece are sorted by the next ``longest`` bytes.
3. Every piece is looked up in the sorted suffixes by binary search; its range holds all its occurrences, the edges.
4. Edges are sorted by position and length and kept sparse: each byte has a bit for every length that starts there, and the
   pieces follow in that order. Relaxing them starts from single characters and takes, in each unit, the edge over two
   neighbours with the best score (the leftmost of equals) until none is left. Bytes that no edge covers become byte pieces.

The model file merges by score, so relaxing follows that order; a best-path sum over the edges, as for unigram models, would not
give the ids of this model. Units of more than ``LONG_UNIT`` characters are relaxed one at a time, with a sorted queue of their
first edges and a heap of those that merging makes.

Memory: a pass holds ``PASS_BYTES`` of text, and some 30 numbers for each of them at most. A longer text is a pass of its own; a
unit beyond a pass, such as a text of megabytes without a space, takes about 100 bytes for each of its own.

Defined results: null gives null ids, '' no ids. Decoding gives the text back, except that U+2581 comes back as a space and
that the model has no way to tell it apart. Unknown ids decode to nothing. Repeated rows are encoded once each.
"""

from __future__ import annotations

import heapq
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import spread
from .text_kernels import bound_batches, lists, map_texts, mix, placed
from .text_kernels import pieces as cuts

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
LONG_UNIT, LONG_BYTES = 200, 1024
PASS_BYTES = 1 << 20
#: Suffixes that are sorted at once, and bytes of the units that a task remembers.
SEGMENT, MEMORY = 1 << 18, 1 << 23
#: A byte's edges are bits of one number.
LONGEST = 63
U = np.uint64


@dataclass
class Pieces:
    text: list[bytes]  # with a plain space for the space mark; empty for control pieces
    score: np.ndarray
    merged: np.ndarray  # ids of the pieces that merging can give
    byte: np.ndarray  # id of each byte's piece
    longest: int


def load_pieces(path: str) -> Pieces:
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    text, byte, merged = [], np.zeros(256, dtype=np.int32), []
    for i in range(m.get_piece_size()):
        said = m.id_to_piece(i)
        if m.is_byte(i):
            byte[int(said[3:5], 16)] = i
            text.append(bytes([int(said[3:5], 16)]))
        elif m.is_control(i) or m.is_unknown(i) or m.is_unused(i):
            text.append(b"")
        else:
            merged.append(i)
            text.append(said.replace(SPACE, " ").encode())
    merged = np.array(list({text[i]: i for i in reversed(merged)}.values())[::-1])  # of equal texts the first
    if max(len(text[i]) for i in merged) > LONGEST:
        raise ValueError(f"a piece of more than {LONGEST} bytes")
    return Pieces(text, np.array([m.get_score(i) for i in range(len(text))]), merged, byte, max(len(text[i]) for i in merged))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


#: Masks that keep the first n bytes of a big-endian number of 8.
FIRST_BYTES = np.array([(1 << 64) - (1 << 8 * (8 - n)) for n in range(9)], dtype=np.uint64)


def _keys(data: np.ndarray, at: np.ndarray, end: np.ndarray, parts: range) -> list[np.ndarray]:
    """The next bytes from each place up to its end as big-endian numbers of 8 bytes each, zero-filled: those of ``parts``."""
    padded = np.concatenate((data, np.zeros(8 * parts.stop, dtype=np.uint8)))
    number = np.ndarray((len(padded) - 7,), dtype=">u8", buffer=padded, strides=(1,))
    return [number[at + 8 * k].astype(np.uint64) & FIRST_BYTES[np.clip(end - at - 8 * k, 0, 8)] for k in parts]


@dataclass
class Edges:
    """Occurrences of pieces in order of position and length. Bit n of mask[p]: a piece of n bytes starts at byte p; the ids of
    those of byte p start at first[p]."""

    mask: np.ndarray
    first: np.ndarray
    ids: np.ndarray

    def pieces(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Ids of the pieces that reach from start to end, -1 where none does."""
        if not len(self.ids):
            return np.full(len(start), -1, dtype=np.int32)
        size = end - start
        size = np.where(size <= LONGEST, size, 0).astype(U)  # no piece has 0 bytes
        mask = self.mask[start]
        at = self.first[start] + np.bitwise_count(mask & ((U(1) << size) - U(1)))
        return np.where((mask >> size) & U(1), self.ids[np.minimum(at, len(self.ids) - 1)], np.int32(-1))

    def piece(self, start: int, end: int) -> int:
        size, mask = end - start, self.mask.item(start)
        if size > LONGEST or not mask >> size & 1:
            return -1
        return self.ids.item(self.first.item(start) + (mask & ((1 << size) - 1)).bit_count())


class Matcher:
    """Finds the pieces' occurrences in the suffixes of a run of units."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.parts = range(-(-pieces.longest // 8))
        # In order of their bytes, so that neighbours are looked up one after another.
        self.piece = np.array(sorted(pieces.merged, key=lambda i: pieces.text[i]))
        raw = np.frombuffer(b"".join(pieces.text[i] for i in self.piece), dtype=np.uint8)
        self.length = np.array([len(pieces.text[i]) for i in self.piece])
        end = np.cumsum(self.length)
        self.low = _keys(raw, end - self.length, end, self.parts)
        self.high = [k.copy() for k in self.low]
        for part, key in enumerate(self.high):
            free = np.clip(8 * (part + 1) - self.length, 0, 8)
            fill = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)
            key |= fill[free]
        self.long = np.flatnonzero(self.length > 8)
        self.long_low, self.long_high = [k[self.long] for k in self.low], [k[self.long] for k in self.high]
        self.long_first = np.unique(self.long_low[0])
        # Place of each id's score, best first; equal scores share one.
        self.rank = np.unique(-pieces.score, return_inverse=True)[1]
        self.forget()

    def forget(self) -> None:
        """Units known by hash, and at the slot of each: where its ids begin and how many they are, and where its bytes begin."""
        self.known, self.slot = np.zeros(0, dtype=U), np.zeros(0, dtype=np.int64)
        self.begin = self.count = self.byte_begin = np.zeros(0, dtype=np.int64)
        self.ids, self.bytes = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.uint8)

    def edges(self, data: np.ndarray, at: np.ndarray, end: np.ndarray) -> Edges:
        """The edges that start at the places ``at``, in units that end at ``end``."""
        mask = np.zeros(len(data), dtype=U)
        ids = [np.zeros(0, dtype=np.int32)]
        for k in range(0, len(at), SEGMENT):
            place, which = self._occurrences(data, at[k : k + SEGMENT], end[k : k + SEGMENT])
            if len(place):
                # One number holds place, length and piece: 34, 6 and 24 bits.
                edge = np.sort(((place << 6 | self.length[which]) << 24) | which)
                place, which = edge >> 30, edge & 0xFFFFFF
                head = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
                mask[place[head]] = np.bitwise_or.reduceat(U(1) << self.length[which].astype(U), head)
                ids.append(self.piece[which].astype(np.int32))
        n = np.bitwise_count(mask).astype(np.int64)
        return Edges(mask, np.cumsum(n) - n, np.concatenate(ids))

    def _occurrences(self, data: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, index of the piece) of every occurrence among the suffixes at ``at``."""
        key = _keys(data, at, end, range(1))[0]
        order = np.argsort(key)
        key, at, end = key[order], at[order], end[order]
        lo, hi = np.searchsorted(key, self.low[0], "left"), np.searchsorted(key, self.high[0], "right")
        hi[self.long] = lo[self.long]
        place, which = [at[_ranges(lo, hi)]], [np.repeat(np.arange(len(lo)), hi - lo)]
        rest = _ranges(np.searchsorted(key, self.long_first, "left"), np.searchsorted(key, self.long_first, "right"))
        if len(rest):
            keys = _keys(data, at[rest], end[rest], self.parts)
            order = np.lexsort(keys[::-1])
            keys = [k[order] for k in keys]
            lo, hi = self._search(keys, self.long_low, False), self._search(keys, self.long_high, True)
            place.append(at[rest[order]][_ranges(lo, hi)])
            which.append(np.repeat(self.long, hi - lo))
        return np.concatenate(place), np.concatenate(which)

    def remember(self, h: np.ndarray, ids: np.ndarray, count: np.ndarray, data: np.ndarray, begin: np.ndarray) -> None:
        """Adds units by ascending hash, with their ids and their bytes, which begin at these places of ``data``."""
        at = np.searchsorted(self.known, h)
        self.slot = np.insert(self.slot, at, np.arange(len(self.known), len(self.known) + len(h)))
        self.known = np.insert(self.known, at, h)
        self.begin = np.concatenate((self.begin, np.cumsum(count) - count + len(self.ids)))
        self.byte_begin, self.count = np.concatenate((self.byte_begin, begin + len(self.bytes))), np.concatenate((self.count, count))
        self.ids, self.bytes = np.concatenate((self.ids, ids)), np.concatenate((self.bytes, data))

    def knows(self, h: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.known, h), max(len(self.known) - 1, 0))
        return self.known[at] == h if len(self.known) else np.zeros(len(h), dtype=bool)

    @staticmethod
    def _search(keys: list[np.ndarray], wanted: list[np.ndarray], after: bool) -> np.ndarray:
        """Binary search of every wanted key among the sorted ones, all at once: its place, or the one after those equal to it. Each
        part is searched where all parts before it are equal."""
        lo, hi = np.searchsorted(keys[0], wanted[0], "left"), np.searchsorted(keys[0], wanted[0], "right")
        for key, want in zip(keys[1:], wanted[1:], strict=True):
            ends = []
            for equal_too in (False, True):
                left, right = lo.copy(), hi.copy()
                while (open_ := left < right).any():
                    middle = (left + right) // 2
                    value = key[np.minimum(middle, len(key) - 1)]
                    up = open_ & ((value <= want) if equal_too else (value < want))
                    left = np.where(up, middle + 1, left)
                    right = np.where(open_ & ~up, middle, right)
                ends.append(left)
            lo, hi = ends
        return hi if after else lo


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The numbers from each lo up to its hi, one range after another."""
    n = hi - lo
    return np.arange(int(n.sum())) + np.repeat(lo - (np.cumsum(n) - n), n)


def _relax(edges: Edges, rank: np.ndarray, start: np.ndarray, end: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols (start, end, unit) after all merges; one merge in each unit a round. ``value`` has the rank of each symbol's pair with
    the next one; a round renews those beside its merges."""
    done = []
    none = np.iinfo(np.int32).max
    start, end, unit = (x.astype(np.int32) for x in (start, end, unit))

    def values(at: np.ndarray) -> np.ndarray:
        out = np.full(len(at), none, dtype=np.int32)
        some = np.flatnonzero(unit[np.minimum(at + 1, len(unit) - 1)] == unit[at])
        some = some[at[some] + 1 < len(unit)]
        found = edges.pieces(start[at[some]], end[at[some] + 1])
        out[some] = np.where(found >= 0, rank[np.maximum(found, 0)], none)
        return out

    value = values(np.arange(len(start)))
    while len(start):
        head = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1])))
        # The least rank of a unit and, in the low bits, its leftmost place.
        best = np.minimum.reduceat(value.astype(np.int64) << 32 | np.arange(len(value)), head)
        active = best >> 32 < none
        hit = best[active] & 0xFFFFFFFF
        keep = np.repeat(active, np.diff(np.append(head, len(unit))))
        if not active.all():
            done.append((start[~keep], end[~keep], unit[~keep]))
        end[hit] = end[hit + 1]
        keep[hit + 1] = False
        merged = np.cumsum(keep)[hit] - 1
        start, end, unit, value = start[keep], end[keep], unit[keep], value[keep]
        for at in (merged, merged[merged > 0] - 1):
            value[at] = values(at)
    return tuple(np.concatenate([d[i] for d in done]).astype(np.int64) if done else np.zeros(0, dtype=np.int64) for i in range(3))


def _relax_long(edges: Edges, rank: np.ndarray, starts: np.ndarray, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for one long unit: (start, end) of its symbols. Merges come from the sorted first edges and from a heap of later
    ones, as numbers of rank and place; ``now`` has the rank of each symbol's pair at the time, so that outdated ones are seen."""
    n = len(starts)
    end = array("q", np.append(starts[1:], stop).tobytes())
    start = array("q", starts.astype(np.int64).tobytes())
    after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
    found = edges.pieces(starts[:-1], np.append(starts[2:], stop)[: n - 1])
    first = np.append(np.where(found >= 0, rank[np.maximum(found, 0)], -1), -1)
    now = array("q", first.astype(np.int64).tobytes())
    some = np.flatnonzero(first >= 0)
    queue = np.sort((first[some] << 40) | some)
    heap: list[int] = []
    at, last, low = 0, len(queue), (1 << 40) - 1

    def look(i: int) -> None:
        j = after[i]
        x = edges.piece(start[i], end[j]) if j < n else -1
        now[i] = -1 if x < 0 else rank.item(x)
        if x >= 0:
            heapq.heappush(heap, now[i] << 40 | i)

    while at < last or heap:
        if at < last and (not heap or queue.item(at) <= heap[0]):
            key = queue.item(at)
            at += 1
        else:
            key = heapq.heappop(heap)
        i = key & low
        if now[i] != key >> 40:
            continue
        j = after[i]
        now[j], end[i], after[i] = -2, end[j], after[j]  # -2: part of the symbol before
        if after[i] < n:
            before[after[i]] = i
        if before[i] >= 0:
            look(before[i])
        look(i)
    kept = np.frombuffer(now, dtype=np.int64) != -2
    return starts[kept], np.frombuffer(end, dtype=np.int64)[kept]


def encode_units(m: Matcher, data: np.ndarray, first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of units that lie one behind another in ``data``, and how many each has."""
    if not len(first):
        return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    unit = np.searchsorted(first, at, side="right") - 1
    end = np.append(at[1:], len(data))
    edges = m.edges(data, at, stop[unit])
    chars = np.bincount(unit, minlength=len(first))
    long = np.flatnonzero(chars > LONG_UNIT)
    short = chars[unit] <= LONG_UNIT
    s, e, u = _relax(edges, m.rank, at[short], end[short], unit[short])
    if len(long):
        place = np.concatenate(([0], np.cumsum(chars)))
        more = [_relax_long(edges, m.rank, at[place[i] : place[i + 1]], int(stop[i])) for i in long]
        s, e, u = np.concatenate((s, *[x for x, _ in more])), np.concatenate((e, *[x for _, x in more])), np.concatenate((u, *[np.full(len(x), i) for i, (x, _) in zip(long, more, strict=True)]))
    order = np.argsort(s, kind="stable")
    s, e, u = s[order], e[order], u[order]
    size = e - s
    ids = edges.pieces(s, e)
    n = np.where(ids >= 0, 1, size)
    out = np.repeat(ids, n)
    place = np.repeat(s, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    out = np.where(out >= 0, out, m.pieces.byte[data[place]])
    return out.astype(np.int32), np.bincount(u, weights=n, minlength=len(first)).astype(np.int64)


def _units(m: Matcher, buffer: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, begin, count): ids of all units of a pass, and where those of each one begin and how many they are. Units are looked up by
    hash and then compared by their bytes; one whose bytes differ is matched on its own."""
    step = np.arange(len(buffer), dtype=np.int32)
    step -= np.repeat(first.astype(np.int32), size)
    np.minimum(step, LONG_BYTES - 1, out=step)
    h = placed(buffer, step)
    del step
    h = mix(np.add.reduceat(h, first) + size.astype(U))
    short = size <= LONG_BYTES
    order = np.argsort(h[short])
    own = h[short][order]
    head = np.concatenate(([True], own[1:] != own[:-1])) if len(own) else np.zeros(0, dtype=bool)
    kind = np.empty(len(own), dtype=np.int64)  # of each short unit, its place in own
    kind[order] = np.cumsum(head) - 1
    own, one = own[head], np.flatnonzero(short)[order[head]]
    new = ~m.knows(own)
    if len(m.bytes) + int(size[one[new]].sum()) > MEMORY:
        new[:] = True  # the units known so far go, so that those of this pass have room
        m.forget()
    some = one[new]
    length = size[some]
    begin = np.cumsum(length) - length
    data = buffer[np.repeat(first[some] - begin, length) + np.arange(int(length.sum()))]
    m.remember(own[new], *encode_units(m, data, begin, begin + length), data, begin)
    ids, starts, counts = [m.ids], np.zeros(len(first), dtype=np.int64), np.zeros(len(first), dtype=np.int64)
    at = m.slot[np.searchsorted(m.known, own)][kind]
    starts[short], counts[short] = m.begin[at], m.count[at]
    known = np.zeros(len(first), dtype=np.int64)
    known[short] = m.byte_begin[at]
    known = m.bytes[np.minimum(np.repeat((known - first) * short, size) + np.arange(len(buffer)), max(len(m.bytes) - 1, 0))] if len(m.bytes) else buffer
    alone = ~short | np.logical_or.reduceat(known != buffer, first)
    total = len(m.ids)
    for i in np.flatnonzero(alone):
        more, n = encode_units(m, buffer[first[i] : first[i] + size[i]], np.zeros(1, dtype=np.int64), size[i : i + 1])
        ids.append(more)
        starts[i], counts[i] = total, n[0]
        total += len(more)
    return np.concatenate(ids), starts, counts


def _with_spaces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with a leading space each (but empty ones), the space mark as a space."""
    mark = SPACE.encode()
    if mark in data.tobytes():
        texts = [data[a:b].tobytes().replace(mark, b" ") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    full = np.diff(offsets) > 0
    to = offsets + np.concatenate(([0], np.cumsum(full)))
    out = np.full(int(to[-1]), 0x20, dtype=np.uint8)
    doc_shift = np.repeat(to[:-1] - offsets[:-1] + full, np.diff(offsets))
    out[np.arange(len(data)) + doc_shift] = data
    return out, to


def encode(docs: DataFrame, pieces: Pieces, keep: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: the ``keep`` columns (doc_id), ids (null for a null text) and n_tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    state: dict[str, Matcher] = {}

    def work(data, offsets, part):
        if "m" not in state:
            state["m"] = Matcher(shared.value)
        m = state["m"]
        null = np.array(part.column(part.num_columns - 1).is_null())
        buffer, to = _with_spaces(data, offsets)
        if not len(buffer):
            return None, {"ids": pa.array([None if x else [] for x in null], pa.list_(pa.int32())), "n_tokens": np.zeros(len(null), dtype=np.int64)}
        space = buffer == 0x20
        head = space & ~np.concatenate(([False], space[:-1]))
        head[to[:-1][np.diff(to) > 0]] = True
        first = np.flatnonzero(head)
        ids, begin, count = _units(m, buffer, first, np.diff(np.append(first, len(buffer))))
        all_ids = ids[np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))]
        doc = np.searchsorted(to, first, side="right") - 1
        tokens = np.bincount(doc, weights=count, minlength=len(null)).astype(np.int64)
        column = lists(all_ids, tokens, pa.int32())
        if null.any():
            column = pa.ListArray.from_arrays(column.offsets, column.values, mask=pa.array(null))
        return None, {"ids": column, "n_tokens": tokens}

    return map_texts(docs, work, [("ids", "array<int>"), ("n_tokens", "long")], keep=keep, pass_bytes=PASS_BYTES)


def decode(encoded: DataFrame, pieces: Pieces, keep: list[str] | None = None, ids: str = "ids") -> DataFrame:
    """The ``keep`` columns (doc_id) and text: the bytes of the pieces, without the leading space. Null ids give null."""
    bound_batches(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(pieces)
    keep = ["doc_id"] if keep is None else keep
    given = encoded.select(*keep, F.col(ids).alias("_ids"))
    schema = T.StructType([given.schema[c] for c in keep] + [T.StructField("text", T.StringType())])

    def task(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema, prefers_large_types=False)
        text = shared.value.text
        length = np.array([len(t) for t in text] + [0])
        begin = np.cumsum(length) - length
        raw = np.frombuffer(b"".join(text), dtype=np.uint8)
        for batch in batches:
            per_row = batch.column(len(keep)).value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi in cuts(np.concatenate(([0], np.cumsum(per_row))), PASS_BYTES // 8):
                part, per = batch.slice(lo, hi - lo), per_row[lo:hi]
                column = part.column(len(keep))
                own = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                own = np.where((own >= 0) & (own < len(text)), own, len(text))
                size = length[own]
                data = raw[np.repeat(begin[own] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
                ends = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(per)))]
                out = [None if null else data[a + (a < b and data[a] == 0x20) : b].tobytes().decode("utf-8", "replace") for a, b, null in zip(ends[:-1], ends[1:], column.is_null().to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(out, pa.string())], schema=arrow)

    return given.mapInArrow(task, schema)


def op5_sentencepiece_codec(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """Ids of every document, and whether decoding them gives its text back."""
    pieces = load_pieces(model or default_model())
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    encoded = encode(docs, pieces, keep={"doc_id": F.col("doc_id"), "text_sha256": F.sha2("text", 256)})
    back = decode(encoded, pieces, keep=["doc_id", "text_sha256", "ids", "n_tokens"])
    return back.select("doc_id", "n_tokens", "ids", F.sha2("text", 256).eqNullSafe(F.col("text_sha256")).alias("round_trip"))
