"""Streams over files that arrive in several batches, against the batch results."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from playtide.operators import clean, listening, sessions
from playtide.sources import adapters, layers
from playtide.streaming import ingest, live

HOUR = 3_600_000


def payload(**event):
    return json.dumps(event)


def drop_files(folder, *batches):
    folder.mkdir(exist_ok=True)
    have = len(list(folder.iterdir()))
    for i, lines in enumerate(batches):
        (folder / f"{have + i:03d}.txt").write_text("\n".join(lines))


def run_files(stream, path, checkpoint, mode="append"):
    (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def test_ingest_resumes_and_equals_batch(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    good = [payload(ts=i, userId=i % 3, sessionId=1, page=["NextSong", "Thumbs Up"][i % 2], length=1.5) for i in range(20)]
    bad = ["{broken", payload(ts="soon", userId="1"), payload(userId="2")]
    odd = [payload(ts=100, userId="", page=""), payload(ts=101, page=None, duration=2.0)]

    def run():
        stream = ingest.read_event_stream(spark, "text", str(source), maxFilesPerTrigger="1")
        ingest.ingest(stream, out, checkpoint, every=None).awaitTermination()

    drop_files(source, good[:7], good[7:12] + bad)
    run()
    assert spark.read.parquet(out).count() == 12
    run()
    assert spark.read.parquet(out).count() == 12
    drop_files(source, good[12:], odd)
    run()
    rows = spark.read.parquet(out)
    whole = ingest.parse_events(spark.read.text(str(source)))
    columns = ["ts", "userId", "sessionId", "duration", "event_time"]
    assert rows.count() == 22 and rows.select(*columns).exceptAll(whole.select(*columns)).count() == 0
    found = {r.ts: r for r in rows.collect()}
    assert found[4].userId == "1" and found[4].duration == 1.5 and found[101].duration == 2.0
    assert found[100].userId == "" and found[100].page is None and found[101].page is None
    assert ingest.rejected_events(spark.read.text(str(source))).count() == 3


def test_kafka_is_the_default_source(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        ingest.read_event_stream(spark, **{"kafka.bootstrap.servers": "none:1", "subscribe": "t"})


@pytest.fixture
def event_files(spark, tmp_path):
    """Raw events as Parquet files of consecutive hours, some delivered twice."""
    rows = []
    for i in range(400):
        ts = 1_704_067_200_000 + i * HOUR // 20
        rows.append((ts, f"u{i % 7}", i % 7 * 10 + i // 200, ["NextSong", "Home", "Help"][i % 3], i, f"s{i % 4}" if i % 3 == 0 else None))
    schema = "ts long, userId string, sessionId long, page string, itemInSession long, song string"
    folder = tmp_path / "events"
    for part in range(4):
        chunk = rows[part * 100 : part * 100 + 100]
        df = spark.createDataFrame(chunk + chunk[-5:], schema)
        df.coalesce(1).write.mode("append").parquet(str(folder / f"part={part}"))
    full = "registration long, location string, userAgent string, level string, artist string"
    extra = [F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in full.split(", ")]

    def batch():
        return spark.read.schema(schema).parquet(str(folder / "part=*")).select("*", *extra)

    def stream():
        reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1")
        return reader.parquet(str(folder / "part=*")).select("*", *extra)

    return batch, stream


def test_silver_drops_repeated_deliveries(spark, event_files, tmp_path):
    batch, stream = event_files
    run_files(live.stream_silver(stream(), "60 minutes"), str(tmp_path / "o"), str(tmp_path / "c"))
    rows = spark.read.parquet(str(tmp_path / "o"))
    expected = clean.clean_events(batch())
    assert rows.count() == expected.count() == 400
    assert rows.select("userId", "ts").exceptAll(expected.select("userId", "ts")).count() == 0


def test_velocity_equals_batch_for_closed_windows(spark, event_files, tmp_path):
    batch, stream = event_files
    silver = clean.enrich_events(stream())
    run_files(live.stream_velocity(silver, "1 hour", "60 minutes"), str(tmp_path / "o"), str(tmp_path / "c"))
    found = {r.bucket: r.events for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    whole = clean.enrich_events(batch()).groupBy(F.window("event_time", "1 hour").alias("w")).count().collect()
    expected = {r.w.start: r["count"] for r in whole}
    assert len(found) >= 15 and all(expected[b] == n for b, n in found.items())


def test_top_songs_are_written_per_bucket(spark, event_files, tmp_path):
    _, stream = event_files
    silver = clean.enrich_events(stream()).withColumn("artist", F.when(F.col("song").isNotNull(), "a"))
    trend = live.stream_trending(silver, "1 hour", "60 minutes")
    live.write_top(trend, str(tmp_path / "top"), str(tmp_path / "c"), n=2, every=None).awaitTermination()
    run_files(live.stream_trending(silver, "1 hour", "60 minutes"), str(tmp_path / "all"), str(tmp_path / "c2"))
    rows = {r.bucket: r["count"] for r in spark.read.parquet(str(tmp_path / "top")).groupBy("bucket").count().collect()}
    whole = {r.bucket: r["count"] for r in spark.read.parquet(str(tmp_path / "all")).groupBy("bucket").count().collect()}
    assert len(rows) > 10 and rows == {b: min(2, n) for b, n in whole.items()}


def updates(spark, path):
    """(epoch, row) of every update written by a session stream."""
    return spark.read.parquet(f"{path}/updates").collect()


def longest(rows):
    final = {}
    for r in rows:
        if r.session_length > final.get((r.userId, r.sessionId), (0,))[0]:
            final[r.userId, r.sessionId] = (r.session_length, list(r.page_seq))
    return final


def test_sessions_in_progress_grow_to_the_batch_sequences(spark, event_files, tmp_path):
    batch, stream = event_files
    out = str(tmp_path / "o")
    live.stream_session_sequences(clean.enrich_events(stream()), out, str(tmp_path / "c"), every=None).awaitTermination()
    rows = updates(spark, out)
    whole = sessions.session_sequences(clean.enrich_events(batch()), min_len=1).collect()
    assert longest(rows) == {(r.userId, r.sessionId): (r.session_length, list(r.page_seq)) for r in whole}
    assert len(rows) > len(longest(rows)) and len({r.epoch for r in rows}) == 4


def test_a_session_goes_on_after_a_rest_and_a_restart(spark, events, tmp_path):
    """Three files with hours between them; the query stops after each and starts again from its checkpoint."""
    base = {"userId": "u", "sessionId": 1, "page": "Home", "itemInSession": 0}
    parts = [
        [{**base, "ts": 0}, {**base, "ts": 0, "page": "NextSong", "itemInSession": 1}],
        [{**base, "userId": "v", "ts": 7_200_000}],
        [{**base, "ts": 7_201_000}, {**base, "ts": 500, "page": "Help"}],
    ]
    source, out, schema = str(tmp_path / "in"), str(tmp_path / "o"), None
    for part in parts:
        rows = events(*part)
        schema = rows.schema
        rows.coalesce(1).write.mode("append").parquet(source)
        stream = clean.enrich_events(spark.readStream.schema(schema).parquet(source))
        live.stream_session_sequences(stream, out, str(tmp_path / "c"), every=None).awaitTermination()
    whole = sessions.session_sequences(clean.enrich_events(spark.read.schema(schema).parquet(source)), min_len=1).collect()
    assert longest(updates(spark, out)) == {(r.userId, r.sessionId): (r.session_length, list(r.page_seq)) for r in whole}


def test_live_scores_equal_batch_scores(spark, silver, tmp_path):
    vectors = sessions.session_vectors(sessions.session_sequences(silver))
    model = sessions.fit_threshold(vectors, sessions.fit_session_model(vectors, 4))
    expected = {
        (r.userId, r.sessionId): (r.is_anomaly, r.recon_error) for r in sessions.anomaly_scores(vectors, model).collect()
    }
    stream = clean.enrich_events(adapters.stream_raw_events(spark, "/root/testdata/sf0.01"))
    out = str(tmp_path / "o")
    live.stream_session_scores(stream, model, out, str(tmp_path / "c"), every=None).awaitTermination()
    rows = updates(spark, out)
    found = {(r.userId, r.sessionId): (r.is_anomaly, r.recon_error) for r in rows if r.session_length >= 3}
    assert found.keys() == expected.keys()
    for key, (flag, error) in expected.items():
        assert found[key][0] == flag and found[key][1] == pytest.approx(error, abs=1e-12)


def part_rows(spark, path):
    """The longest row of each session part."""
    best = {}
    for folder in sorted((path / "updates").glob("epoch=*")):
        for r in spark.read.schema(live.PARTS).parquet(str(folder)).collect():
            key = (r.userId, r.sessionId, r.started)
            if r.session_length > best.get(key, (0,))[0]:
                best[key] = (r.session_length, list(r.page_seq))
    return best


def test_state_of_ended_sessions_goes_and_a_resumed_one_is_a_new_part(spark, events, tmp_path):
    """10,000 sessions rest for over six hours: only the newest session is left in the state."""
    hour, source = 3_600_000, str(tmp_path / "in")
    schema = events().schema
    base = {"page": "Home", "itemInSession": 0}

    def add(rows):
        events(*rows).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = clean.enrich_events(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source))
        query = live.stream_session_parts(stream, str(tmp_path / "out"), str(tmp_path / "c"), every=None)
        query.awaitTermination()
        return query.recentProgress

    add([{**base, "userId": f"u{i}", "sessionId": i, "ts": i + 1} for i in range(10_000)])
    run()
    add([{**base, "userId": "u7", "sessionId": 7, "ts": hour, "page": "NextSong"}])
    run()
    add([{**base, "userId": "late", "sessionId": 1, "ts": 40 * hour}])
    last = run()[-1]
    assert last["stateOperators"][0]["numRowsTotal"] == 1
    add([{**base, "userId": "u7", "sessionId": 7, "ts": 41 * hour + k, "itemInSession": k} for k in (2, 0, 1)])
    run()
    found = part_rows(spark, tmp_path / "out")
    assert {f"u{i}" for i in range(10_000)} | {"late"} == {k[0] for k in found}
    assert len(found) == 10_002 and {k: v[0] for k, v in found.items() if k[0] == "u7"} == {("u7", 7, 8): 2, ("u7", 7, 41 * hour): 3}


def test_parts_do_not_depend_on_the_order_of_stretches():
    import random

    rng = random.Random(1)
    for _ in range(50):
        times = [rng.randrange(200) for _ in range(30)]
        parts = []
        for t in times:
            live._with_part(parts, 5, [t, t, 1, [(t, 0, 0)]])
        ordered = sorted(times)
        cuts = [0, *(i for i in range(1, 30) if ordered[i] - ordered[i - 1] > 5), 30]
        assert sorted(p[:3] for p in parts) == [[ordered[a], ordered[b - 1], b - a] for a, b in zip(cuts, cuts[1:])]


def test_late_rows_are_counted_and_logged(spark, tmp_path):
    folder, log = tmp_path / "in", str(tmp_path / "log")
    minute = 60_000
    for hours in ([0, 1], [5], [6, 4], [1, 2, 6], [7, 3]):  # 4 is not late: the watermark lags by one batch
        lines = [payload(ts=1_704_067_200_000 + h * HOUR + minute, userId=h, sessionId=1, page="Home") for h in hours]
        drop_files(folder, lines)
    for i, file in enumerate(sorted(folder.iterdir())):  # files are taken by their times
        os.utime(file, (1_704_067_200 + i, 1_704_067_200 + i))
    raw = ingest.parse_events(ingest.read_event_stream(spark, "text", str(folder), maxFilesPerTrigger="1"))
    listener = live.LateRowLog(spark, "silver", log)
    spark.streams.addListener(listener)
    try:
        writer = live.stream_silver(raw).writeStream.queryName("silver").format("parquet")
        query = writer.option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        query.awaitTermination()
        found = {batch: n for batch, n in live.late_rows(query).items() if n}
        deadline = time.time() + 60  # the listener hears of a batch a moment later
        while time.time() < deadline and (layers.read_layer(spark, log) is None or layers.read_layer(spark, log).agg(F.sum("value")).first()[0] < 3):
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    assert found == {3: 2, 4: 1}
    assert sorted(r.value for r in spark.read.parquet(log).filter("experiment = 'silver' and metric = 'late_rows'").collect()) == [1.0, 2.0]
    assert spark.read.parquet(str(tmp_path / "o")).count() == 6  # one repeat


def test_streamed_sketches_unite_to_exact_counts(spark, event_files, tmp_path):
    batch, stream = event_files
    run_files(live.stream_kpi_sketches(clean.enrich_events(stream()), "1 hour", "60 minutes"), str(tmp_path / "o"), str(tmp_path / "c"))
    hours = spark.read.parquet(str(tmp_path / "o"))
    first, last = hours.agg(F.min("bucket"), F.max("bucket")).first()
    whole = clean.enrich_events(batch()).filter((F.col("event_time") >= first) & (F.col("event_time") < last + F.expr("INTERVAL 1 HOUR")))
    assert listening.united_kpis(hours).collect() == listening.listening_kpis(whole).collect()
    assert listening.united_kpis(hours.limit(0)).first().users == 0


def test_session_state_is_kept_by_bucket(spark, events, tmp_path):
    """4,000 sessions in one micro-batch: a state row, and a call of Python, for each bucket and not for each session."""
    source, out = str(tmp_path / "in"), str(tmp_path / "o")
    rows = events(*[{"page": "Home", "itemInSession": 0, "userId": f"u{i % 7}", "sessionId": i, "ts": i} for i in range(4_000)])
    rows.coalesce(1).write.parquet(source)
    stream = clean.enrich_events(spark.readStream.schema(rows.schema).parquet(source))
    query = live.stream_session_sequences(stream, out, str(tmp_path / "c"), every=None)
    query.awaitTermination()
    assert {(r.userId, r.sessionId, r.session_length) for r in updates(spark, out)} == {(f"u{i % 7}", i, 1) for i in range(4_000)}
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= live.STATE_BUCKETS < 4_000


@pytest.mark.parametrize("idle", [None, 5])
def test_folded_sessions_equal_stretches_added_one_by_one(idle):
    import random

    import pandas as pd

    rng = random.Random(2)
    for _ in range(20):
        rows = [(rng.choice("ab"), rng.randrange(3), rng.randrange(-200, 400), rng.randrange(3), rng.randrange(4)) for _ in range(400)]
        whole, state = {}, live._unpacked(None)
        for at in range(0, 400, 80):
            some = rows[at : at + 80]
            state = live._fold(state, pd.DataFrame(some, columns=["userId", "sessionId", "ts", "item", "code"]), idle)
            if idle is None:
                state = live._unpacked(live._packed(state))
        for u, s, t, i, c in rows:
            live._with_part(whole.setdefault((u, s), []), 1_000 if idle is None else idle, [t, t, 1, [(t, i, c)]])
        entries = [[] for _ in state.ids]
        for p, *entry in zip(state.part.tolist(), *(state.entries[c].tolist() for c in live.ENTRY)):
            entries[p].append(tuple(entry))
        columns = (state.users.to_pylist(), *(c.tolist() for c in (state.ids, state.started, state.last, state.lengths)))
        assert sorted(zip(*columns, entries)) == sorted((*k, *p) for k in whole for p in whole[k])
