"""Restoring streamed chunks: one keyed state for each request, as a batch job and as a stream that give the same rows.

Originals are joined to the init row alone, so chunks carry no mapping and the state holds what its own request may get back. Chunks are
worked on in order of their index, whatever order they come in and whatever their clocks say. As a stream, a chunk in turn goes out at
once; what comes early waits until the watermark passes it, and is then worked on without what is missing. State is gone once the watermark has passed
a completion, or five minutes without a chunk; a mark of a completion goes with the five minutes. A chunk behind the watermark is
dropped by Spark. A chunk that a stream has given out before the completion that refuses it came can't be taken back; a table's is refused.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.columns import media_route
from ..functions.streams import Session, restore_all
from ..operators.vault import MAX_TOKENS, allowlist, dedupe

OUT = "request_id string, chunk_index int, body string, dropped boolean, error string"


def events(chunks: DataFrame, completions: DataFrame, originals: DataFrame | None = None) -> DataFrame:
    """Chunks and completions as rows of one kind. ``originals`` (request_id, originals as JSON) is joined where it isn't there yet."""
    rows = chunks if originals is None else chunks.join(originals, (chunks.request_id == originals.request_id) & (chunks.chunk_index == -1), "left").select(chunks["*"], originals.originals)
    at = F.col("ts").cast("timestamp").alias("ts")
    own = rows.select("request_id", "chunk_index", at, "source_format", media_route(F.col("content_type")).alias("route"), "body", "originals")
    none = F.lit(None).cast("string")
    done = completions.select("request_id", F.lit(None).cast("int").alias("chunk_index"), at, none.alias("source_format"), none.alias("route"), none.alias("body"), none.alias("originals"))
    return own.unionByName(done)


def stream_originals(inits: DataFrame, vault: DataFrame, most: int = MAX_TOKENS) -> DataFrame:
    """(request_id, originals): token -> [original, the second it expires] as JSON, for the first ``most`` tokens of each init."""
    asked = inits.filter("chunk_index = -1").select("request_id", F.col("request_body").alias("body"))
    mapping = dedupe(vault)
    expires = F.col("expires_at").cast("double") if "expires_at" in mapping.columns else F.lit(None).cast("double")
    known = allowlist(asked, mapping, "request_id", "body", most).join(mapping.select("token", F.struct("original", expires.alias("expires")).alias("o")), "token")
    return known.groupBy("request_id").agg(F.to_json(F.map_from_entries(F.collect_set(F.struct("token", "o")))).alias("originals"))


FIELDS = ("chunk_index", "seconds", "body", "route", "source_format", "originals")
#: Rows and characters of restored chunks that a task gives out at a time.
OUT_ROWS, OUT_CHARS = 5_000, 1 << 22


def _row(index: int | None, seconds: float, body: str | None, route: str | None, source_format: str | None, originals: str | None) -> dict:
    known = {t: [o["original"], o.get("expires")] for t, o in json.loads(originals).items()} if originals else {}
    return {"chunk_index": index, "ts": seconds, "body": body, "route": route, "source_format": source_format, "originals": known}


def _rows(data: pd.DataFrame) -> list[dict]:
    text = lambda v: v if isinstance(v, str) else None
    return [_row(None if pd.isna(i) else int(i), s, *map(text, own)) for i, s, *own in data[list(FIELDS)].itertuples(index=False, name=None)]


def _frame(key: str, done: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame([(key, *r) for r in done], columns=["request_id", "chunk_index", "body", "dropped", "error"])


def restore_chunks(chunks: DataFrame, completions: DataFrame, vault: DataFrame, inits: DataFrame | None = None) -> DataFrame:
    """(request_id, chunk_index, body, dropped, error) of all chunks of a table; a request's rows are the only ones that meet. They
    stand one behind the other in their partition, so a task holds those of one request at a time. Originals come as one more row of
    their request, so chunks are dealt out once and joined with nothing. ``inits``: the init rows of ``chunks``, where the caller has
    them apart and finding them costs a pass."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, known, done, chars = None, [], None, [], 0

        def restored() -> list[tuple]:
            for r in rows:
                if known and r["chunk_index"] == -1:
                    r["originals"] = known
            return [(key, *x) for x in restore_all(rows)]

        def given() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [()] * 5
            kinds = (pa.string(), pa.int32(), pa.string(), pa.bool_(), pa.string())
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["request_id", "chunk_index", "body", "dropped", "error"])
            done.clear()
            return out

        for batch in batches:
            for own, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != key:
                    done += (new := restored())
                    chars += sum(len(x[2] or "") for x in new)
                    key, rows, known = own, [], None
                    if len(done) >= OUT_ROWS or chars >= OUT_CHARS:
                        chars = 0
                        yield given()
                if row[-1] is None:
                    rows.append(_row(*row))
                else:
                    known = _row(*row)["originals"]
        done += restored()
        yield given()

    none = F.lit(None).cast("string")
    own = events(chunks.withColumn("originals", none), completions).withColumn("seconds", F.col("ts").cast("double"))
    originals = stream_originals(chunks if inits is None else inits, vault).filter("request_id is not null")
    rows = own.unionByName(originals, allowMissingColumns=True)
    return rows.select(F.col("request_id").cast("string"), *FIELDS).repartition("request_id").sortWithinPartitions("request_id").mapInArrow(task, OUT)


class Stored:
    """A request's state in Spark's state store: one entry for each original, channel, waiting chunk and piece of an event, so that a
    batch reads and writes those it names alone."""

    def __init__(self, handle: StatefulProcessorHandle):
        self._head = handle.getValueState("head", "head string")
        self._originals = handle.getMapState("originals", "token string", "original string, expires double")
        self._channels = handle.getMapState("channels", "name string", "channel string")
        self._waiting = handle.getMapState("waiting", "chunk_index int", "row string")
        self._pieces = handle.getListState("pieces", "piece string")
        self.handle = handle

    def load(self) -> None:
        """The head of the request whose rows come next."""
        self.head = json.loads(self._head.get()[0]) if self._head.exists() else None

    def save(self, deadline: float | None) -> None:
        """Keeps the head, and one timer for when there is something to do without rows."""
        head, at = self.head, None if deadline is None else int(deadline * 1000)
        was = [int(t) for t in self.handle.listTimers()]
        for t in was:
            if t != at:
                self.handle.deleteTimer(t)
        if at is not None and at not in was:
            self.handle.registerTimer(at)
        if head is not None:
            self._head.update((json.dumps(head),))
        elif self._head.exists():
            self._head.clear()

    def original(self, token: str) -> list | None:
        own = self._originals.getValue((token,))
        return None if own is None else [own[0], own[1]]

    def put_originals(self, originals: dict[str, list]) -> None:
        self._originals.clear()
        for token, own in originals.items():
            self._originals.updateValue((token,), tuple(own))

    def channel(self, name: str) -> list | None:
        own = self._channels.getValue((name,))
        return None if own is None else json.loads(own[0])

    def put_channel(self, name: str, value: list | None) -> None:
        if value is None:
            self._channels.removeKey((name,))
        else:
            self._channels.updateValue((name,), (json.dumps(value),))

    def channels(self) -> list[str]:
        return [k[0] for k in self._channels.keys()]

    def waiting(self) -> list[int]:
        return sorted(k[0] for k in self._waiting.keys())

    def is_waiting(self, index: int) -> bool:
        return self._waiting.containsKey((index,))

    def put_waiting(self, index: int, row: dict) -> None:
        self._waiting.updateValue((index,), (json.dumps(row),))

    def take_waiting(self, index: int) -> dict | None:
        own = self._waiting.getValue((index,))
        if own is not None:
            self._waiting.removeKey((index,))
        return None if own is None else json.loads(own[0])

    def push(self, piece: str) -> None:
        self._pieces.appendValue((piece,))

    def take_pieces(self) -> str:
        out = "".join(p[0] for p in self._pieces.get())
        self._pieces.clear()
        return out

    def clear(self, waiting: bool = True) -> None:
        for own in (self._originals, self._channels, self._pieces, *([self._waiting] if waiting else [])):
            own.clear()


class ChunkProcessor(StatefulProcessor):
    """The same for a stream, with event-time timers."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.store = Stored(handle)

    def _done(self, key, rows: list[dict], timers) -> Iterator[pd.DataFrame]:
        self.store.load()
        session, done = Session(self.store), []
        for row in rows:
            done += session.add(row)
        done += session.pass_time(timers.getCurrentWatermarkInMs() / 1000)
        self.store.save(session.deadline())
        yield _frame(key[0], done)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        data = pd.concat(list(rows)).sort_values(["seconds", "chunk_index"], kind="stable", na_position="last")
        yield from self._done(key, _rows(data), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield from self._done(key, [], timerValues)

    def close(self) -> None:
        pass


def restore_chunk_stream(rows: DataFrame, delay: str = "1 minute") -> DataFrame:
    """The restored chunks of a stream of ``events`` (with originals on init rows, from ``stream_originals``). ``delay`` is how much later
    than younger rows a row may come. Needs the state store that is kept in RocksDB."""
    own = rows.withWatermark("ts", delay).withColumn("seconds", F.col("ts").cast("double"))
    return own.groupBy("request_id").transformWithStateInPandas(statefulProcessor=ChunkProcessor(), outputStructType=OUT, outputMode="Append", timeMode="EventTime")


def chunk_order(chunks: DataFrame, key: str = "request_id", index: str = "chunk_index") -> DataFrame:
    """The step from each chunk's predecessor; above 1 there is a gap."""
    from pyspark.sql import Window

    return chunks.select(key, index, (F.col(index) - F.lag(index).over(Window.partitionBy(key).orderBy(index))).alias("step"))


def stitch_text(deltas: DataFrame, *channel: str, index: str = "chunk_index", text: str = "text") -> DataFrame:
    """Each channel's deltas put together in order."""
    own = deltas.groupBy(*channel).agg(F.array_sort(F.collect_list(F.struct(index, text))).alias("x"))
    return own.select(*channel, F.array_join(f"x.{text}", "").alias(text))


def late_rows(rows: DataFrame, completions: DataFrame, key: str = "request_id", at: str = "ts") -> DataFrame:
    """Rows behind their key's first completion."""
    done = completions.groupBy(key).agg(F.min(at).alias("_done"))
    return rows.join(done, key).filter(F.col(at) > F.col("_done")).drop("_done")
