from hypothesis import HealthCheck, given, settings, strategies as st

from playtide.operators import clean, quality


def test_required_fields_and_blank_users(events):
    df = events({"userId": "1", "ts": 1}, {"userId": None, "ts": 2}, {"userId": "", "ts": 3}, {"userId": "2"})
    assert [r.userId for r in clean.require_fields(df).collect()] == ["1"]
    kept = clean.require_fields(df, drop_blank_users=False).collect()
    assert sorted(r.userId for r in kept) == ["", "1"]


def test_dedupe_picks_the_first_by_order(events):
    key = {"userId": "1", "ts": 5, "sessionId": 9}
    df = events(
        {**key, "page": "Home", "itemInSession": 3},
        {**key, "page": "Help", "itemInSession": 2},
        {**key, "page": "About", "itemInSession": 2},
        {"userId": "1", "ts": 5, "sessionId": None, "page": "Home"},
    )
    once = clean.dedupe_events(df)
    assert {(r.sessionId, r.page) for r in once.collect()} == {(9, "About"), (None, "Home")}
    assert set(clean.dedupe_events(once).collect()) == set(once.collect())


def test_location_without_comma_and_user_agent(events):
    df = events(
        {"userId": "1", "location": "Guam", "userAgent": "Mozilla (iPad) Mobile"},
        {"userId": "2", "location": None, "userAgent": None},
        {"userId": "3", "location": "Austin, TX", "userAgent": "Firefox on Linux, not Chrome"},
    )
    rows = {r.userId: r for r in clean.parse_user_agent(clean.split_location(df)).collect()}
    assert (rows["1"].city, rows["1"].state) == ("Guam", None)
    assert (rows["2"].city, rows["2"].state) == (None, None)
    assert (rows["3"].city, rows["3"].state) == ("Austin", "TX")
    assert (rows["1"].browser, rows["1"].os) == ("Unknown", "Unknown")
    assert (rows["2"].browser, rows["2"].os) == ("Unknown", "Unknown")
    assert (rows["3"].browser, rows["3"].os) == ("Firefox", "Linux")
    blank = {r.userId: r for r in clean.parse_user_agent(df, blank_is_unknown=False).collect()}
    assert (blank["1"].browser, blank["2"].browser) == ("", "Unknown")


def test_times_keep_milliseconds_unless_cut(events):
    df = events({"userId": "1", "ts": 1704067207179, "registration": 1})
    assert clean.add_times(df).first().event_time.microsecond == 179000
    assert clean.add_times(df, truncate_seconds=True).first().event_time.microsecond == 0


def test_incremental_first_load_takes_all(events):
    raw = events({"userId": "1", "ts": 1}, {"userId": "1", "ts": 2})
    assert clean.incremental_filter(raw, None).count() == 2
    assert clean.incremental_filter(raw, raw.limit(0)).count() == 2


def test_incremental_takes_late_rows_and_counts_those_left_out(events):
    stored = events({"userId": "1", "ts": 100, "sessionId": 1}, {"userId": "1", "ts": 90, "sessionId": None})
    raw = events(
        {"userId": "1", "ts": 100, "sessionId": 1},
        {"userId": "1", "ts": 90, "sessionId": None},
        {"userId": "2", "ts": 95, "sessionId": 1},
        {"userId": "2", "ts": 20, "sessionId": 1},
        {"userId": "1", "ts": 101, "sessionId": 1},
    )
    assert {r.ts for r in clean.incremental_filter(raw, stored).collect()} == {20, 95, 101}
    assert {r.ts for r in clean.incremental_filter(raw, stored, lateness=50).collect()} == {95, 101}
    assert {r.ts for r in clean.late_rows(raw, stored, 50).collect()} == {20}
    assert clean.increment_report(raw, stored, 50).first().asDict() == {"total": 5, "taken": 2, "too_late": 1, "known": 2}


def test_incremental_takes_rows_as_old_as_the_newest(events):
    stored = events({"userId": "1", "ts": 100, "sessionId": 1})
    raw = events(*[{"userId": u, "ts": t, "sessionId": 1} for u, t in (("1", 100), ("2", 100), ("2", 90), ("2", 110))])
    assert sorted(r.ts for r in clean.incremental_filter(raw, stored).collect()) == [90, 100, 110]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 30)), min_size=1, max_size=25), st.integers(0, 30))
def test_two_increments_equal_one_load(spark, events, pairs, cut):
    raw = events(*[{"userId": str(u), "ts": t, "sessionId": 1} for u, t in pairs])
    whole = clean.dedupe_events(raw).select("userId", "ts").collect()
    first = clean.dedupe_events(raw.filter(f"ts <= {cut}"))
    second = clean.dedupe_events(clean.incremental_filter(raw, first))
    assert sorted(first.unionByName(second).select("userId", "ts").collect()) == sorted(whole)


def test_null_profile(events):
    df = events({"userId": "1", "page": None}, {"userId": None, "page": None})
    found = {r["column"]: (r.nulls, r.total) for r in quality.null_profile(df).collect()}
    assert found["userId"] == (1, 2) and found["page"] == (2, 2)


def test_histogram_edges_and_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.05,), (0.999,), (1.0,)], "p double")
    counts = {r.bin: r["count"] for r in quality.histogram(df, "p").collect()}
    assert len(counts) == 20 and counts[0] == 1 and counts[1] == 1 and counts[19] == 2 and counts[10] == 0
