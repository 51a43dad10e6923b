import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from beaconmill import operators as ops
from tests.samples import IMPRESSIONS, INTERACTIONS


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ------------------------------------------------------------ staging


def test_flatten_goes_down_all_levels_and_keeps_arrays(spark):
    df = spark.sql("select struct(1 as a, struct('x' as b, array(1, 2) as c) as s) as t, 5 as d")
    flat = ops.flatten(df)
    assert flat.columns == ["a", "b", "c", "d"]
    assert flat.collect() == [(1, "x", [1, 2], 5)]
    assert ops.flatten(df, prefix=True).columns == ["t_a", "t_s_b", "t_s_c", "d"]


def test_flatten_rejects_leaves_of_one_name(spark):
    df = spark.sql("select struct(1 as a) as s, struct(2 as A) as t")
    with pytest.raises(ValueError, match="named a"):
        ops.flatten(df)
    assert ops.flatten(df, prefix=True).columns == ["s_a", "t_A"]


def test_flatten_and_stringify_take_odd_names(spark):
    df = spark.sql("select struct(1 as `a.b`, 2 as `c d`) as s, 3 as `e.f`")
    assert ops.stringify(ops.flatten(df)).collect() == [("1", "2", "3")]


def test_clicks_are_all_interactions_and_conversions_the_typed_ones(spark):
    given = INTERACTIONS + [("2024-05-05T13:00:00Z", "user1", "CampaignABC", None)]
    df = spark.createDataFrame(given, "timestamp string, user_id string, ad_campaign_id string, conversion_type string")
    clicks, conversions = ops.clicks_of(df), ops.conversions_of(df)
    assert clicks.count() == 6 and conversions.count() == 5
    assert clicks.select("click_id").distinct().count() == 6
    again = ops.clicks_of(df.repartition(3))
    assert rows(clicks.select("click_id")) == rows(again.select("click_id"))


def test_event_id_keeps_the_place_of_a_missing_value(spark):
    df = spark.createDataFrame(
        [("u", "t", None, "x"), ("u", "t", "x", None)],
        "user_id string, timestamp string, ad_campaign_id string, conversion_type string",
    )
    assert ops.clicks_of(df).select("click_id").distinct().count() == 2


# ------------------------------------------------------------ cleansing


def test_timestamps_that_do_not_parse_become_null(spark):
    df = spark.createDataFrame([("2024-05-05T12:30:45Z",), ("soon",), (None,)], "timestamp string")
    got = [r.timestamp for r in ops.convert_types(df).collect()]
    assert got == [datetime(2024, 5, 5, 12, 30, 45), None, None]


def test_standardize_replaces_and_adds(spark):
    df = spark.createDataFrame([("a",), (None,)], "website string")
    assert rows(ops.standardize(df)) == [("example.com",), ("example.com",)]
    assert ops.standardize(df, {"site": "x"}).columns == ["website", "site"]


def test_deduplicate_takes_null_as_equal_and_is_idempotent(spark):
    given = [("u", None, 1), ("u", None, 2), ("u", 5, 3), ("v", 5, 4), (None, 5, 5), (None, 5, 6)]
    df = spark.createDataFrame(given, "user_id string, timestamp int, n int")
    once = ops.deduplicate(df)
    assert rows(once) == rows(ops.deduplicate(once))
    assert rows(once) == sorted([("u", None, 1), ("u", 5, 3), ("v", 5, 4), (None, 5, 5)], key=repr)
    newest = ops.deduplicate(df, order_by=[F.desc("n")])
    assert rows(newest) == sorted([("u", None, 2), ("u", 5, 3), ("v", 5, 4), (None, 5, 6)], key=repr)


def test_deduplicate_chooses_the_same_row_however_the_input_is_split(spark):
    given = [("u", 1, random.Random(i).random(), [i % 7]) for i in range(200)]
    df = spark.createDataFrame(given, "user_id string, timestamp int, x double, a array<int>")
    assert rows(ops.deduplicate(df.repartition(7))) == rows(ops.deduplicate(df.coalesce(1)))


def test_deduplicate_takes_columns_that_cannot_be_sorted(spark):
    df = spark.sql("select * from values ('u', 1, map('a', 1)), ('u', 1, map('b', 2)) as t(user_id, timestamp, m)")
    assert ops.deduplicate(df).count() == 1


def test_mark_is_strict_and_needs_a_timestamp(spark):
    df = spark.createDataFrame([("2024-05-05 00:00:00",), ("2024-05-05 00:00:01",)], "load_date string")
    with pytest.raises(TypeError, match="needs a timestamp"):
        ops.newer_than(df, "2024-05-05")
    times = ops.convert_types(df, ["load_date"])
    assert ops.newer_than(times, "2024-05-05").count() == 1
    assert ops.newer_than(times, datetime(2024, 5, 5)).count() == 1


# ------------------------------------------------------------ versions


def test_close_out_marks_the_newest_version_also_of_null_keys(spark):
    given = [("u", 1, "2024-01-01"), ("u", 1, "2024-01-02"), ("u", None, "2024-01-01"), ("u", None, "2024-01-03"),
             ("v", 1, "2024-01-01")]
    df = spark.createDataFrame(given, "user_id string, timestamp int, d string").selectExpr(
        "user_id", "timestamp", "cast(d as timestamp) as load_date", "true as is_current"
    )
    closed = ops.close_out(df)
    assert closed.count() == 5
    assert closed.columns == df.columns
    current = {(r.user_id, r.timestamp, r.load_date.day) for r in closed.filter("is_current").collect()}
    assert current == {("u", 1, 2), ("u", None, 3), ("v", 1, 1)}


def test_not_loaded_takes_null_as_equal(spark):
    schema = "user_id string, timestamp int"
    incoming = spark.createDataFrame([("u", 1), ("u", None), ("v", 1), ("w", None)], schema)
    target = spark.createDataFrame([("u", 1), ("u", 1), ("u", None)], schema)
    assert rows(ops.not_loaded(incoming, target)) == [("v", 1), ("w", None)]


# ------------------------------------------------------------ correlation


def expected_correlation(impressions, events):
    out = Counter()
    for impression in impressions:
        ids = [e[2] for e in events if None not in e[:2] and e[:2] == impression[:2]]
        out.update((*impression, i) for i in (ids or [None]))
    return out


def frames(spark, impressions, events):
    return (
        spark.createDataFrame(impressions, "user_id string, timestamp int, ad string").repartition(3),
        spark.createDataFrame(events, "user_id string, timestamp int, click_id string").repartition(3),
    )


FANOUT = (
    [("u", 1, "a"), ("u", 1, "b"), ("u", None, "c"), (None, 1, "d"), ("v", 9, "e")],
    [("u", 1, "x"), ("u", 1, "y"), ("u", None, "z"), (None, 1, "q"), ("w", 9, "r")],
)


def test_correlate_keeps_impressions_and_fans_out(spark):
    got = ops.correlate(*frames(spark, *FANOUT), "click_id")
    assert got.columns == ["user_id", "timestamp", "ad", "click_id"]
    assert Counter(map(tuple, got.collect())) == expected_correlation(*FANOUT)
    assert got.count() == 7


def test_correlate_with_a_hot_key_of_copies(spark):
    """A third of the events are copies of one, a third share its key, on few impressions."""
    draw = random.Random(3)
    impressions = [("hot", 1, "h1"), ("hot", 1, "h2"), ("hot", 2, "h3"), (None, 1, "n")] + [
        (f"u{draw.randrange(20)}", draw.randrange(3), f"i{i}") for i in range(150)
    ]
    events = [("hot", 1, "copy")] * 200 + [("hot", 1, f"c{i % 150}") for i in range(200)]
    events += [(f"u{draw.randrange(20)}", draw.randrange(4), f"e{i % 60}") for i in range(200)]
    events += [("hot", 1, None), ("absent", 1, "never")] + [("absent", 2, "never")] * 50
    got = ops.correlate(*frames(spark, impressions, events), "click_id")
    assert Counter(map(tuple, got.collect())) == expected_correlation(impressions, events)


def test_one_event_per_key_needs_one_join(spark):
    events = [e for i, e in enumerate(FANOUT[1]) if i != 1]
    got = ops.correlate(*frames(spark, FANOUT[0], events), "click_id", one_per_key=True)
    assert Counter(map(tuple, got.collect())) == expected_correlation(FANOUT[0], events)


def test_a_column_of_the_ids_name_is_refused(spark):
    views, clicks = frames(spark, *FANOUT)
    taken = views.withColumnRenamed("ad", "Click_id")
    for add in (ops.correlate, ops.attribute_last_touch):
        with pytest.raises(ValueError, match="click_id"):
            add(taken, clicks, "click_id")
    for add in (ops.attribute_within, ops.attribute_first):
        with pytest.raises(ValueError, match="click_id"):
            add(taken, clicks, "click_id", timedelta(minutes=1))


def test_ties_are_settled_by_the_data(spark):
    rows = [(i % 7, 1, f"x{i}", 5) for i in range(2000)]
    df = spark.createDataFrame(rows, "user_id int, timestamp int, ad string, rank int")
    for add in (lambda d: ops.deduplicate(d, order_by=[F.desc("rank")]),):
        results = {tuple(sorted(map(tuple, add(df.repartition(n)).collect()))) for n in (1, 3, 8)}
        assert len(results) == 1


def test_one_version_stays_current_when_load_dates_tie(spark):
    rows = [(1, "a", 1), (1, "b", 1), (1, "b", 1), (2, "c", 1), (None, "d", 1), (None, "d", 0)]
    df = spark.createDataFrame(rows, "user_id int, ad string, day int").selectExpr("user_id", "ad", "timestamp_seconds(day) as load_date", "true as is_current")
    for n in (1, 3, 8):
        out = ops.close_out(df.repartition(n), ["user_id"])
        assert {r.user_id: r.n for r in out.groupBy("user_id").agg(F.count_if("is_current").alias("n")).collect()} == {1: 1, 2: 1, None: 1}
        assert out.count() == 6
        current = sorted(map(tuple, out.filter("is_current").select("user_id", "ad").collect()), key=repr)
        assert sorted(map(tuple, ops.current_versions(df.repartition(n), ["user_id"]).select("user_id", "ad").collect()), key=repr) == current


def test_times_without_zone_do_not_follow_the_sessions_clock(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("select 'u' as user_id, timestamp_ntz'2024-03-10 03:01:00' as timestamp, 1 as event_id")
        touch = spark.sql("select 'u' as user_id, timestamp_ntz'2024-03-10 02:30:00' as timestamp, 9 as touch")
        assert ops.attribute_last_touch(df, touch, "touch").first().touch == 9
        before = spark.sql("select 'u' as user_id, timestamp_ntz'2024-03-10 01:59:00' as timestamp, 1 as ad")
        after = df.withColumnRenamed("event_id", "click_id")
        for add in (ops.attribute_within, ops.attribute_first):
            assert add(before, after, "click_id", timedelta(minutes=10)).first().click_id is None
            assert add(before, after, "click_id", timedelta(minutes=62)).first().click_id == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_first_events_equal_brute_force(spark):
    draw = random.Random(8)
    views = [(draw.choice(["u", "v", None]), draw.choice([None, *range(40)]), f"i{i}") for i in range(120)]
    clicks = [(draw.choice(["u", "v", "w", None]), draw.choice([None, *range(0, 60, 3)]), f"c{i}") for i in range(60)]
    left, right = (df.withColumn("timestamp", F.timestamp_seconds("timestamp")) for df in frames(spark, views, clicks))
    got = {r.ad: r.click_id for r in ops.attribute_first(left, right, "click_id", timedelta(seconds=5)).collect()}
    for user, at, ad in views:
        near = [(t, c) for u, t, c in clicks if None not in (user, at, t) and u == user and at <= t <= at + 5]
        assert got[ad] == (min(near)[1] if near else None)


# ------------------------------------------------------------ attribution


@pytest.fixture
def sample_frames(spark):
    impressions = ops.convert_types(
        spark.createDataFrame(IMPRESSIONS, "ad_creative_id string, user_id string, timestamp string, website string")
    )
    events = ops.convert_types(
        spark.createDataFrame(INTERACTIONS, "timestamp string, user_id string, campaign string, kind string")
    ).withColumn("click_id", F.date_format("timestamp", "HH:mm:ss"))
    return impressions, events


def test_sample_rows_have_no_equal_times(sample_frames):
    got = ops.correlate(*sample_frames, "click_id")
    assert got.count() == 5 and got.filter("click_id is not null").count() == 0


def test_sample_rows_within_a_tolerance(sample_frames):
    ten = ops.attribute_within(*sample_frames, "click_id", timedelta(minutes=10))
    matches = {(f"{r.timestamp:%H:%M:%S}", r.click_id) for r in ten.filter("click_id is not null").collect()}
    assert matches == {("12:35:00", "12:35:21"), ("12:45:30", "12:50:20")}
    assert ten.count() == 5
    fifteen = ops.attribute_within(*sample_frames, "click_id", timedelta(minutes=15))
    assert fifteen.count() == 6 and fifteen.filter("click_id is not null").count() == 5


def test_sample_rows_by_last_touch(sample_frames):
    impressions, events = sample_frames
    touches = impressions.withColumn("touch", F.date_format("timestamp", "HH:mm:ss")).select("user_id", "timestamp", "touch")
    got = {r.click_id: r.touch for r in ops.attribute_last_touch(events, touches, "touch").collect()}
    assert got == {"12:35:21": "12:35:00", "12:40:10": None, "12:42:55": "12:30:45",
                   "12:47:30": "12:35:00", "12:50:20": "12:45:30"}


def timeline(draw, n, users, span):
    start = datetime(2024, 1, 1)
    return [
        (
            draw.choice(users),
            None if draw.random() < 0.03 else start + timedelta(microseconds=draw.randrange(span)),
            f"{i}",
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("span", [3_000_000, 400_000_000])
def test_attribution_against_brute_force(spark, span):
    draw = random.Random(span)
    users = ["hot"] * 5 + ["a", "b", "c", None]
    left, right = timeline(draw, 150, users, span), timeline(draw, 150, users, span)
    left += left[:20]
    right += [("hot", left[0][1], "same instant"), ("absent", datetime(2024, 1, 1), "no")]
    schema = "user_id string, timestamp timestamp, {} string"
    a = spark.createDataFrame(left, schema.format("ad"))
    b = spark.createDataFrame(right, schema.format("click_id"))

    tolerance = timedelta(microseconds=span // 40)
    want = Counter()
    for user, at, ad in left:
        ids = [c for u, t, c in right if at and t and u is not None and u == user and at <= t <= at + tolerance]
        want.update((user, at, ad, c) for c in (ids or [None]))
    got = ops.attribute_within(a, b, "click_id", tolerance)
    assert Counter(map(tuple, got.collect())) == want

    want = Counter()
    for user, at, ad in left:
        before = [(t, c) for u, t, c in right if at and t and u is not None and u == user and t <= at]
        want[(user, at, ad, max(before)[1] if before else None)] += 1
    got = ops.attribute_last_touch(a, b, "click_id", bucket=timedelta(microseconds=span // 30))
    assert Counter(map(tuple, got.collect())) == want


def test_attribution_needs_a_span(sample_frames):
    with pytest.raises(ValueError, match="must be positive"):
        ops.attribute_within(*sample_frames, "click_id", timedelta(0))


def test_attribution_before_the_epoch(spark):
    schema = "user_id string, timestamp timestamp, {} string"
    a = spark.createDataFrame([("u", datetime(1969, 12, 31, 23, 59, 59), "i")], schema.format("ad"))
    b = spark.createDataFrame([("u", datetime(1970, 1, 1, 0, 0, 1), "c")], schema.format("click_id"))
    assert ops.attribute_within(a, b, "click_id", timedelta(seconds=2)).collect()[0].click_id == "c"
    assert ops.attribute_within(a, b, "click_id", timedelta(seconds=1)).collect()[0].click_id is None


OWN_NAMES = ["_rank", "_hash", "_at", "_bucket", "_copy", "_newest", "_id", "_next", "_first", "_last", "_under", "_asked", "_inside", "_later"]


def test_columns_named_like_our_own_come_back(spark):
    """Every operator keeps a caller's columns of the names it uses itself."""
    plain = spark.sql(
        "select * from values ('u1', timestamp'2024-05-01 10:00:00', 'a', timestamp'2024-06-01', true),"
        " ('u1', timestamp'2024-05-01 10:00:00', 'b', timestamp'2024-06-02', true),"
        " ('u2', timestamp'2024-05-01 11:00:00', 'c', timestamp'2024-06-01', true) as t(user_id, timestamp, ad, load_date, is_current)"
    )
    df = plain.withColumns({c: F.concat(F.lit(c), "ad") for c in OWN_NAMES})
    events = plain.select("user_id", "timestamp", F.col("ad").alias("click_id"), *(F.lit("e").alias(c) for c in OWN_NAMES)).filter("click_id <> 'b'")
    made = {
        "deduplicate": ops.deduplicate(df, order_by=[F.desc("ad")]),
        "close_out": ops.close_out(df),
        "current_versions": ops.current_versions(df),
        "not_loaded": ops.not_loaded(df, plain.filter("user_id = 'u2'")),
        "correlate": ops.correlate(df, events, "click_id"),
        "attribute_within": ops.attribute_within(df, events, "click_id", timedelta(hours=1)),
        "attribute_first": ops.attribute_first(df, events, "click_id", timedelta(hours=1)),
        "attribute_last_touch": ops.attribute_last_touch(df, events, "click_id"),
    }
    for name, out in made.items():
        rows = out.collect()
        assert rows and set(df.columns) <= set(out.columns), name
        assert all(r[c] == c + r.ad for r in rows for c in OWN_NAMES), name
    assert sorted(r.ad for r in made["deduplicate"].collect()) == ["b", "c"]
    assert sorted(r.ad for r in made["current_versions"].collect()) == ["b", "c"]
    assert made["close_out"].filter("is_current").count() == 2
    for name in ("correlate", "attribute_within", "attribute_first", "attribute_last_touch"):
        assert sorted((r.ad, r.click_id) for r in made[name].collect()) == [("a", "a"), ("b", "a"), ("c", "c")], name
