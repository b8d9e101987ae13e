"""Live silver, velocity, trending and session scores."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from datetime import datetime
from heapq import nsmallest
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.state import GroupStateTimeout

from playtide.functions.columns import page_code
from playtide.operators.clean import enrich_events, require_fields
from playtide.operators.listening import kpi_sketches
from playtide.operators.sessions import SessionModel, reconstruction_error, score_columns, session_vectors
from playtide.schema import EVENT_KEY, MAX_SESSION_LENGTH, SESSION_KEY
from playtide.sources import layers, runlog


def stream_silver(bronze: DataFrame, lateness: str = "10 minutes", drop_blank_users: bool = True) -> DataFrame:
    """R2: clean and dedupe; a key is remembered until the watermark passes it."""
    kept = enrich_events(require_fields(bronze, drop_blank_users))
    return kept.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(list(EVENT_KEY))


def stream_velocity(silver: DataFrame, width: str = "10 seconds", lateness: str = "10 minutes") -> DataFrame:
    """Events per closed time bucket."""
    return (
        silver.withWatermark("event_time", lateness)
        .groupBy(F.window("event_time", width).alias("w"))
        .agg(F.count(F.lit(1)).alias("events"))
        .select(F.col("w.start").alias("bucket"), "events")
    )


def stream_trending(silver: DataFrame, width: str = "1 hour", lateness: str = "10 minutes") -> DataFrame:
    """Plays per closed time bucket and song; state is dropped with the bucket."""
    return (
        silver.filter(F.col("song").isNotNull() & F.col("artist").isNotNull())
        .withWatermark("event_time", lateness)
        .groupBy(F.window("event_time", width).alias("w"), "song", "artist")
        .agg(F.count(F.lit(1)).alias("plays"))
        .select(F.col("w.start").alias("bucket"), "song", "artist", "plays")
    )


def stream_kpis(silver: DataFrame, width: str = "1 hour", lateness: str = "10 minutes") -> DataFrame:
    """Streams, users, paid share and songs per closed bucket; distinct counts are sketches."""
    rows = F.count(F.lit(1))
    return (
        silver.withWatermark("event_time", lateness)
        .groupBy(F.window("event_time", width).alias("w"))
        .agg(
            rows.alias("streams"),
            F.approx_count_distinct("userId").alias("users"),
            (F.count_if(F.col("level") == "paid") * 100.0 / rows).alias("paid_pct"),
            F.approx_count_distinct("song").alias("songs"),
        )
        .select(F.col("w.start").alias("bucket"), "streams", "users", "paid_pct", "songs")
    )


def stream_kpi_sketches(silver: DataFrame, width: str = "1 hour", lateness: str = "10 minutes") -> DataFrame:
    """Closed buckets as ``listening.kpi_sketches``, so that any range of them can be united."""
    return kpi_sketches(silver.withWatermark("event_time", lateness), width)


def _dropped(progress) -> int:
    return sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)


def late_rows(query: StreamingQuery) -> dict[int, int]:
    """R2: rows behind the watermark that each of the last micro-batches dropped, by batch.

    Exact for ``stream_silver``. Spark holds a batch's rows against the watermark that
    the batch before it ran with, so a row counts as late if it is older than the newest
    event of all batches but the last one, less the lateness. A windowed count drops partial aggregates, so its
    number counts those. How many batches are remembered is
    ``spark.sql.streaming.numRecentProgressUpdates``; ``LateRowLog`` keeps all.
    """
    found: dict[int, int] = {}
    for progress in query.recentProgress:
        found[progress.batchId] = found.get(progress.batchId, 0) + _dropped(progress)
    return found


class LateRowLog(StreamingQueryListener):
    """R2: appends the late rows of every micro-batch of a named query to the run log; register with ``spark.streams.addListener``."""

    def __init__(self, spark: SparkSession, name: str, path: str):
        self.spark, self.name, self.path = spark, name, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        dropped = _dropped(event.progress)
        if dropped and event.progress.name == self.name:
            when = datetime.fromisoformat(event.progress.timestamp)
            runlog.log_metrics(runlog.metric_rows(self.spark, self.name, {"late_rows": dropped}, when), self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def top_per_bucket(trend: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most played songs of each bucket."""
    best = W.partitionBy("bucket").orderBy(F.desc("plays"), "song", "artist")
    return trend.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= n).drop("_rank")


def write_top(trend: DataFrame, path: str, checkpoint: str, n: int = 10, every: str | None = "60 seconds"):
    """Top ``n`` songs of every bucket that a micro-batch closes, one folder per epoch."""

    def save(batch: DataFrame, epoch: int) -> None:
        top_per_bucket(batch, n).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return start_each_batch(trend, save, checkpoint, "append", every)


def start_each_batch(
    stream: DataFrame,
    save: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    every: str | None = "60 seconds",
) -> StreamingQuery:
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    writer = stream.writeStream.outputMode(mode).foreachBatch(save).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def closed_sessions(silver: DataFrame, gap: str = "30 minutes", lateness: str = "10 minutes") -> DataFrame:
    """Sessions by inactivity gap, for sources without a session id; emitted once closed."""
    return (
        silver.withWatermark("event_time", lateness)
        .groupBy(F.session_window("event_time", gap).alias("w"), "userId")
        .agg(F.count(F.lit(1)).alias("session_length"))
        .select("userId", F.col("w.start").alias("started"), F.col("w.end").alias("ended"), "session_length")
    )


SEQUENCES = "userId string, sessionId bigint, session_length bigint, page_seq array<int>"
PARTS = "userId string, sessionId bigint, started bigint, session_length bigint, page_seq array<int>"
SESSION_STATE = "sessions binary"
STATE_BUCKETS = 1_024
ROWS_PER_FOLD = 100_000
ENTRY = ("ts", "item", "code")


def _with_part(parts: list[list], idle: int, part: list) -> None:
    """Adds a stretch [start, last event, length, first entries] to disjoint ones, joining what is near; ``_fold`` does this for many sessions."""
    near = [p for p in parts if part[0] - p[1] <= idle and p[0] - part[1] <= idle]
    for p in near:
        parts.remove(p)
        part = [min(p[0], part[0]), max(p[1], part[1]), p[2] + part[2], nsmallest(MAX_SESSION_LENGTH, chain(p[3], part[3]))]
    parts.append(part)


class _Parts(NamedTuple):
    """Session parts by user, session and start, and the first entries of each, in order; ``part`` is an entry's row of the others."""

    users: pa.Array
    ids: np.ndarray
    started: np.ndarray
    last: np.ndarray
    lengths: np.ndarray
    touched: np.ndarray
    entries: dict[str, np.ndarray]
    part: np.ndarray


def _fold(known: _Parts, rows: pd.DataFrame, idle: int | None) -> _Parts:
    """``known`` with ``rows`` added; without ``idle`` a session is one part."""
    new = {c: rows[c].astype("int64").to_numpy() for c in ("sessionId", *ENTRY)}  # a missing time raises
    users = pa.concat_arrays([known.users, pa.array(rows["userId"], pa.string())])
    ids, started, last = (np.append(a, new[c]) for a, c in ((known.ids, "sessionId"), (known.started, "ts"), (known.last, "ts")))
    lengths = np.append(known.lengths, np.ones(len(rows), np.int64))
    touched = np.append(known.touched, np.ones(len(rows), bool))
    user = users.dictionary_encode().indices.to_numpy()
    order = np.lexsort((started, ids, user))
    opens = np.append(True, (np.diff(user[order]) != 0) | (np.diff(ids[order]) != 0))
    if idle is not None:
        session = np.cumsum(opens)
        ends, rank = np.unique(last[order], return_inverse=True)
        reached = ends[np.maximum.accumulate(session * len(ends) + rank) - session * len(ends)]
        opens[1:] |= started[order][1:] - reached[:-1] > idle
    first = np.flatnonzero(opens)
    part = np.empty(len(order), np.int64)
    part[order] = np.cumsum(opens) - 1
    part = np.append(part[known.part], part[len(known.ids) :])
    heads = {c: np.append(known.entries[c], new[c]) for c in ENTRY}
    by = np.lexsort((heads["code"], heads["item"], heads["ts"], part))
    place = np.arange(len(by)) - np.searchsorted(part[by], part[by])
    by = by[place < MAX_SESSION_LENGTH]
    return _Parts(
        users.take(pa.array(order[first])),
        ids[order][first],
        started[order][first],
        np.maximum.reduceat(last[order], first),
        np.add.reduceat(lengths[order], first),
        np.logical_or.reduceat(touched[order], first),
        {c: v[by] for c, v in heads.items()},
        part[by],
    )


def _only(parts: _Parts, kept: np.ndarray) -> _Parts:
    of = kept[parts.part]
    flat = (c[kept] for c in parts[1:6])
    return _Parts(parts.users.filter(pa.array(kept)), *flat, {c: v[of] for c, v in parts.entries.items()}, (np.cumsum(kept) - 1)[parts.part[of]])


def _packed(parts: _Parts) -> bytes:
    """Parts with their entries, as an Arrow stream of one batch."""
    at = pa.array(np.searchsorted(parts.part, np.arange(len(parts.ids) + 1)), pa.int32())
    entries = [pa.ListArray.from_arrays(at, pa.array(parts.entries[c])) for c in ENTRY]
    batch = pa.record_batch([parts.users, *(pa.array(c) for c in parts[1:5]), *entries], ["user", "id", "started", "last", "length", *ENTRY])
    with pa.BufferOutputStream() as sink:
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
            writer.write_batch(batch)
        return sink.getvalue().to_pybytes()


def _unpacked(state: bytes | None) -> _Parts:
    if state is None:
        none = np.empty(0, np.int64)
        return _Parts(pa.array([], pa.string()), none, none, none, none, none.astype(bool), dict.fromkeys(ENTRY, none), none)
    batch = pa.ipc.open_stream(state).read_next_batch()
    flat = [batch.column(i).to_numpy() for i in range(1, 5)]
    part = np.repeat(np.arange(batch.num_rows), np.diff(batch.column("ts").offsets.to_numpy()))
    return _Parts(batch.column(0), *flat, np.zeros(batch.num_rows, bool), {c: batch.column(c).values.to_numpy() for c in ENTRY}, part)


def _taken(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows in tables of about ``ROWS_PER_FOLD``."""
    held, size = [], 0
    for rows in batches:
        held.append(rows)
        size += len(rows)
        if size >= ROWS_PER_FOLD:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if size:
        yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)


def _advance_sessions(idle: int | None = None):
    """The state update of ``session_updates`` and, with ``idle``, of ``session_parts``, for a bucket of sessions."""

    def advance(key, batches, state) -> Iterator[pd.DataFrame]:
        parts = _unpacked(state.get[0] if state.exists else None)
        for rows in () if state.hasTimedOut else _taken(batches):
            parts = _fold(parts, rows, idle)
        if parts.touched.any():
            out = _only(parts, parts.touched)
            codes = np.split(out.entries["code"], np.searchsorted(out.part, np.arange(1, len(out.ids))))
            began = {} if idle is None else {"started": out.started}
            yield pd.DataFrame({"userId": out.users.to_pandas(), "sessionId": out.ids, **began, "session_length": out.lengths, "page_seq": codes})
        if idle is None:
            state.update((_packed(parts),))
            return
        # only the newest part of a session can go on, until the watermark has passed its end
        now = state.getCurrentWatermarkMs()
        user = parts.users.dictionary_encode().indices.to_numpy()
        newest = np.append((np.diff(user) != 0) | (np.diff(parts.ids) != 0), True)[: len(user)]
        parts = _only(parts, newest & (parts.last + idle + 1 >= now))
        if not len(parts.ids):
            state.remove()
            return
        state.update((_packed(parts),))
        state.setTimeoutTimestamp(max(int(parts.last.min()) + idle, now) + 1)

    return advance


def _session_events(silver: DataFrame) -> DataFrame:
    return silver.filter(F.col("page").isNotNull() & F.col("sessionId").isNotNull() & F.col("userId").isNotNull())


def _session_state(known: DataFrame, schema: str, timeout: str, idle: int | None = None) -> DataFrame:
    """Keyed state of ``STATE_BUCKETS`` buckets of sessions, by a hash of the session key."""
    rows = known.select(
        F.pmod(F.xxhash64(*SESSION_KEY), F.lit(STATE_BUCKETS)).cast("int").alias("bucket"),
        *SESSION_KEY,
        "ts",
        *([] if idle is None else ["event_time"]),
        F.coalesce("itemInSession", F.lit(0)).cast("long").alias("item"),
        page_code(F.col("page")).cast("int").alias("code"),
    )
    return rows.groupBy("bucket").applyInPandasWithState(_advance_sessions(idle), schema, SESSION_STATE, "update", timeout)


def session_updates(silver: DataFrame) -> DataFrame:
    """The length and first 50 page codes of every session touched by a micro-batch.

    The state holds at most 50 entries per (user, session id), so a session goes on
    where it was however long it rested and in whatever order its events arrive.
    Sessions lie in ``STATE_BUCKETS`` buckets that are updated as tables, so a
    micro-batch calls Python once per bucket and not once per session; it reads and
    writes the buckets of the sessions that it touches.
    """
    return _session_state(_session_events(silver), SEQUENCES, GroupStateTimeout.NoTimeout)


def session_parts(silver: DataFrame, idle_ms: int = 6 * 3_600_000, lateness: str = "10 minutes") -> DataFrame:
    """Like ``session_updates``, with an end: a session that rests for ``idle_ms`` of event time is over.

    It leaves its bucket when the watermark has passed that time, and an empty bucket
    leaves the state, so the state holds the sessions of the last ``idle_ms`` and lateness,
    not all that ever were. An event of the same user and session id after a longer rest
    starts a new part, known by its first time, whether or not the old state is gone
    already; what is later than ``lateness`` is dropped by the watermark. Many live
    sessions belong into a RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
    """
    known = _session_events(silver).withWatermark("event_time", lateness)
    return _session_state(known, PARTS, GroupStateTimeout.EventTimeTimeout, idle_ms)


def stream_session_parts(
    silver: DataFrame, path: str, checkpoint: str, idle_ms: int = 6 * 3_600_000, every: str | None = "60 seconds"
) -> StreamingQuery:
    """The sequence so far of every session part touched by a micro-batch, in ``path``/updates."""

    def write(parts: DataFrame, epoch: int) -> None:
        layers.replace_layer(parts, f"{path}/updates/epoch={epoch}")

    return start_each_batch(session_parts(silver, idle_ms), write, checkpoint, "update", every)


def stream_session_sequences(
    silver: DataFrame, path: str, checkpoint: str, every: str | None = "60 seconds"
) -> StreamingQuery:
    """The sequence so far of every session touched by a micro-batch, in ``path``/updates."""

    def write(sequences: DataFrame, epoch: int) -> None:
        layers.replace_layer(sequences, f"{path}/updates/epoch={epoch}")

    return start_each_batch(session_updates(silver), write, checkpoint, "update", every)


def score_sequences(sequences: DataFrame, model: SessionModel) -> DataFrame:
    """Error, flag and score of sequences in progress."""
    scored = reconstruction_error(session_vectors(sequences), model)
    return scored.withColumns(score_columns(F.col("recon_error"), F.lit(model.threshold))).select(
        "sessionId", "userId", "session_length", "recon_error", "is_anomaly", "anomaly_score"
    )


def stream_session_scores(
    silver: DataFrame, model: SessionModel, path: str, checkpoint: str, every: str | None = "60 seconds"
) -> StreamingQuery:
    """Scores of every session touched by a micro-batch, in ``path``/updates."""

    def write(sequences: DataFrame, epoch: int) -> None:
        layers.replace_layer(score_sequences(sequences, model), f"{path}/updates/epoch={epoch}")

    return start_each_batch(session_updates(silver), write, checkpoint, "update", every)
