"""Hand-computed micro tables, one per semantic decision."""

import math
import statistics
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.functions.clock import local_day, parse_release
from tidemark.functions import moments
from tidemark.functions.moments import distinct_with_null
from tidemark.operators import scoring
from tidemark.operators.attach import attach, group_activity, top_values
from tidemark.operators.labels import label_table
from tidemark.operators.narrow import narrow_types, range_profile
from tidemark.operators.prepare import add_measures, calendar_parts, localize, prepare, repeated_items
from tidemark.operators.ranges import day_range, instant_range, lookback
from tidemark.plans import samples as sampling
from tidemark.plans.features import _distinct_block, long_features
from tidemark.plans.spec import BASELINE_SPEC, SPEC_1, SPEC_2
from tidemark.plans.splits import BASELINE, CALENDAR, LATEST, SET_1, Layout, Split, survey

EVENTS = "did string, vid string, vts double, timestamp long"
ITEMS = (
    "vid string, cid string, is_intact int, online_time timestamp, series_id string,"
    " duration double, classify_id string"
)


def secs(text: str) -> int:
    """Epoch seconds of a UTC+8 wall-clock time."""
    naive = datetime.fromisoformat(text).replace(tzinfo=timezone.utc)
    return int(naive.timestamp()) - 8 * 3600


def utc(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def build(spark, events, items=(), spec=SPEC_1, catalogue=LATEST, **how):
    ev = spark.createDataFrame(events, EVENTS)
    it = spark.createDataFrame(list(items), ITEMS)
    layout = survey(ev, catalogue)
    prepared = prepare(ev, it, len(items), layout.items, **how)
    rows = long_features(prepared, layout, spec.pick((1, 3, 7), lambda f: True), keep_cells=False).collect()
    return {(r["split"], r["days"], r["did"]): r for r in rows}


ITEM_A = ("a", "c1", 1, utc("2024-01-01"), "s1", 100.0, "k1")
ITEM_B = ("b", "c1", 2, utc("2024-01-01"), "s1", 50.0, "k1")


def test_midnight_splits_local_days(spark):
    rows = spark.createDataFrame([(1704124799,), (1704124800,)], "t long")  # 15:59:59Z, 16:00:00Z
    days = [r[0] for r in rows.select(local_day(F.col("t"))).collect()]
    assert days == [date(2024, 1, 1), date(2024, 1, 2)]


def test_local_day_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        rows = spark.createDataFrame([(1704124800,)], "timestamp long")
        got = calendar_parts(localize(rows)).first()
        assert (got["date_day"], got["date_hour"], got["date_minute"]) == (date(2024, 1, 2), 0, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_weekday_runs_from_monday_to_sunday(spark):
    events = [("u", "a", 1.0, secs("2024-03-03T12:00:00")), ("u", "a", 1.0, secs("2024-03-04T12:00:00"))]
    rows = calendar_parts(localize(spark.createDataFrame(events, EVENTS))).orderBy("timestamp").collect()
    assert [r["date_weekday"] for r in rows] == [7, 1]


def test_window_keeps_exactly_its_days(spark):
    anchor = ("z", "a", 1.0, secs("2024-03-10T20:00:00"))
    events = [anchor] + [("u", "a", 1.0, secs(f"2024-03-{d:02d}T01:00:00")) for d in (10, 8, 7, 4, 3)]
    got = build(spark, events)
    assert got["test", 3, "u"]["did_vid_count"] == 2  # ages 0 and 2; age 3 is out
    assert got["test", 7, "u"]["did_vid_count"] == 4  # age 6 is in, age 7 is out
    local = localize(spark.createDataFrame(events, EVENTS))
    assert lookback(local, date(2024, 3, 10), 3).where("did = 'u'").count() == 2


def test_anchor_at_midnight_adds_no_day(spark):
    events = [("u", "a", 1.0, secs("2024-03-10T00:00:00")), ("u", "a", 1.0, secs("2024-03-09T00:00:00"))]
    got = build(spark, events)
    assert got["test", 1, "u"]["did_vid_count"] == 1


def test_label_and_history_edges(spark):
    end = date(2024, 6, 30)
    day = lambda back: secs("2024-06-30T12:00:00") - back * 86400
    events = [("u", "a", 1.0, day(b)) for b in (0, 6, 7, 127, 128)]
    ev = spark.createDataFrame(events, EVENTS)
    layout = survey(ev, SET_1)
    labels = sampling.split_labels(localize(ev), layout).where("split = 'valid'").first()
    assert labels["active_days"] == 2  # end and end - 6
    valid = next(s for s in layout.splits if s.name == "valid")
    assert (valid.label[1] - valid.label[0], valid.history[1] - valid.history[0]) == (6, 120)
    assert day_range(localize(ev), end, 6).count() == 2
    assert [b for b in (7, 127, 128) if valid.history[0] <= layout.last - b <= valid.history[1]] == [7, 127]


def test_null_watch_time_counts_as_a_watch(spark):
    events = [("u", "a", None, 1000), ("u", "a", 2.0, 2000), ("v", "a", None, 1000)]
    rows = {r["did"]: r for r in label_table(localize(spark.createDataFrame(events, EVENTS)), "did").collect()}
    assert rows["u"]["watch_nums"] == 2 and rows["u"]["watch_durations"] == 2.0
    assert rows["v"]["watch_nums"] == 1 and rows["v"]["watch_durations"] is None


def test_unmatched_item_is_one_more_distinct_value_but_no_group(spark):
    t = secs("2024-03-10T20:00:00")
    got = build(spark, [("u", "a", 1.0, t), ("u", "x", 4.0, t), ("u", "y", 5.0, t)], [ITEM_A])["test", 7, "u"]
    assert got["did_cid_nunique"] == 2  # c1 and missing
    assert got["did_did_cid_watch_nums_max"] == 1  # unmatched rows share no collection
    assert got["did_is_intact_cid_watch_durations_max"] == 1.0
    assert got["did_vid_watch_nums_mean"] == 1.0
    frame = spark.createDataFrame([("k", None), ("k", "p"), ("k", "p")], "g string, c string")
    assert frame.groupBy("g").agg(distinct_with_null(F.col("c")).alias("n")).first()["n"] == 2


def test_null_keys_attach_nothing(spark):
    rows = spark.createDataFrame(
        [("u", None, 1.0, date(2024, 1, 1)), ("u", "c", 1.0, date(2024, 1, 1))],
        "did string, cid string, vts double, date_day date",
    )
    got = attach(rows, ["cid"], group_activity(rows, ["cid"], "cid")).orderBy(F.col("cid").asc_nulls_first())
    assert [r["cid_watch_nums"] for r in got.collect()] == [None, 1]


def test_repeated_items(spark):
    t = secs("2024-03-10T20:00:00")
    twice = [ITEM_A, ("a", "c9", 3, utc("2024-02-01"), "s2", 10.0, "k2")]
    assert build(spark, [("u", "a", 1.0, t)], twice, dedupe_items=False)["test", 7, "u"]["did_vid_count"] == 2
    once = build(spark, [("u", "a", 1.0, t)], twice)["test", 7, "u"]
    assert once["did_vid_count"] == 1
    found = repeated_items(spark.createDataFrame(twice, ITEMS)).collect()
    assert [(r["vid"], r["rows"]) for r in found] == [("a", 2)]


def test_deviation_of_one_row_is_null_and_of_equal_rows_zero(spark):
    t = secs("2024-03-10T20:00:00")
    got = build(spark, [("u", "a", 0.1, t), ("v", "a", 0.1, t), ("v", "a", 0.1, t + 1), ("v", "a", 0.1, t + 2)])
    assert got["test", 7, "u"]["did_vts_std"] is None
    assert got["test", 7, "v"]["did_vts_std"] == 0.0


@pytest.mark.parametrize("far, step", [(1e6, 1e-4), (1e3, 1e-5), (1e9, 1.0)])
def test_deviation_of_tight_values_far_from_zero(spark, far, step):
    t = secs("2024-03-10T20:00:00")
    # over two windows, several days and cells with several rows
    events = [("u", f"v{k % 7}", far + step * k, t - 86400 * (k % 6)) for k in range(1000)]
    got = build(spark, events)
    for days in (3, 7):
        kept = [v for _, _, v, at in events if t - at < 86400 * days]
        assert got["test", days, "u"]["did_vts_std"] == pytest.approx(statistics.stdev(kept), rel=1e-6)


def test_sums_of_large_counts_do_not_overflow(spark):
    parts = [F.lit(3_000_000_000_000).alias("v"), F.lit(4_000_000).alias("n"), F.lit(1.0).alias("w")]
    frame = spark.range(2).select(*parts)
    got = frame.agg(*moments.repeated_parts("did_cid_watch_nums", "v", "n", "w", ["n", "s"]))
    mean = got.selectExpr(moments.statistic("mean", "did_cid_watch_nums")).first()[0]
    assert mean == 3e12


def test_zero_divisors_give_null(spark):
    release = utc("2024-03-10T12:00:00")
    item = ("a", "c", 1, release, "s", 0.0, "k")
    events = spark.createDataFrame([("u", "a", 5.0, int(release.timestamp()))], EVENTS)
    joined = localize(events).join(spark.createDataFrame([item], ITEMS), "vid")
    row = add_measures(joined).first()
    assert row["u_date"] == 0.0 and row["vts/duration"] is None and row["vts/u_date"] is None


def test_weekday_ratio_and_its_first_form(spark):
    t = secs("2024-03-10T20:00:00")  # a Sunday
    args = ([("u", "a", 14.0, t)], [ITEM_A], SPEC_2)
    assert build(spark, *args)["test", 7, "u"]["did_vts/date_weekday_mean"] == 2.0
    old = build(spark, *args, compat=True)["test", 7, "u"]
    assert old["did_vts/date_weekday_mean"] == pytest.approx(old["did_vts/u_date_mean"])
    assert old["did_vts/date_weekday_std"] is None


def test_missing_kind(spark):
    from dataclasses import replace

    t = secs("2024-03-10T20:00:00")
    row = build(spark, [("u", "a", 3.0, t)], [ITEM_A])["test", 7, "u"]
    assert (row["is_intact_1_vts"], row["is_intact_7_vts"], row["is_intact_7_vid"]) == (3.0, None, 0)
    zero = build(spark, [("u", "a", 3.0, t)], [ITEM_A], replace(SPEC_1, fill_empty=0.0))["test", 7, "u"]
    assert zero["is_intact_7_vts"] == 0.0
    assert build(spark, [("u", "a", 3.0, t)], [ITEM_A])["test", 1, "u"]["is_intact_9_vid"] is None


def test_weighted_mean_plain_and_normalised(spark):
    from dataclasses import replace

    events = [("u", "a", 10.0, secs("2024-03-10T20:00:00")), ("u", "a", 20.0, secs("2024-03-08T20:00:00"))]
    w = [0.95, 0.95**3]
    row = build(spark, events, [ITEM_A])["test", 7, "u"]
    assert row["w95_did_vts_mean"] == pytest.approx((10 * w[0] + 20 * w[1]) / 2)
    row = build(spark, events, [ITEM_A], replace(SPEC_1, normalized=True))["test", 7, "u"]
    assert row["w95_did_vts_mean"] == pytest.approx((10 * w[0] + 20 * w[1]) / sum(w))
    assert row["w95_did_vid_watch_nums_mean"] == pytest.approx(2.0)


def test_favourite_breaks_ties_upwards_and_skips_null(spark):
    t = secs("2024-03-10T20:00:00")
    items = [ITEM_A, ("b", "c2", 1, utc("2024-01-01"), "s", 10.0, "k2")]
    events = [("u", "a", 1.0, t), ("u", "b", 1.0, t + 1), *[("u", "x", 1.0, t + i) for i in range(2, 6)]]
    got = build(spark, events, items, BASELINE_SPEC, BASELINE)
    assert got["test", 7, "u"]["cid_like"] == "c2"
    rows = spark.createDataFrame([("u", "p"), ("u", "q"), ("u", None)], "did string, c string")
    assert [r["c"] for r in top_values(rows, "did", "c").collect()] == ["q"]
    assert [r["c"] for r in top_values(rows, "did", "c", 2).orderBy("rank").collect()] == ["q", "p"]


def test_user_without_history_keeps_the_label_row(spark):
    day = lambda back: secs("2024-06-30T12:00:00") - back * 86400
    ev = spark.createDataFrame([("new", "a", 1.0, day(0)), ("old", "a", 1.0, day(20))], EVENTS)
    layout = survey(ev, SET_1)
    it = spark.createDataFrame([ITEM_A], ITEMS)
    some = SPEC_1.pick((7,), lambda f: True)
    long = long_features(prepare(ev, it, 1), layout, some)
    rows = {(r["split"], r["did"]): r for r in sampling.samples(localize(ev), long, layout, some).collect()}
    assert rows["valid", "new"]["active_days"] == 1 and rows["valid", "new"]["did_vid_7_count"] is None
    assert rows["test", "new"]["did_vid_7_count"] == 1 and rows["test", "old"]["did_vid_7_count"] is None


def test_boundary_instant_is_in_one_range_only(spark):
    from dataclasses import replace

    last = 1_700_000_000
    ev = spark.createDataFrame([("u", "a", 1.0, last), ("u", "a", 1.0, last - 7 * 86400)], EVENTS)
    valid = lambda cat: next(s for s in survey(ev, cat).splits if s.name == "valid")
    assert valid(BASELINE).anchor is None
    assert valid(replace(BASELINE, compat=True)).anchor == last - 7 * 86400
    assert sampling.split_labels(localize(ev), survey(ev, BASELINE)).where("split='valid'").first()["watch_nums"] == 2
    assert instant_range(ev, last, 7).count() == 2


def test_rolling_windows_are_closed_and_spans_are_hours(spark):
    from dataclasses import replace

    last = 1_700_000_000
    events = [("u", "a", 1.0, last), ("u", "a", 1.0, last - 86400), ("u", "a", 1.0, last - 86401)]
    got = build(spark, events, [], BASELINE_SPEC, BASELINE)
    assert got["test", 1, "u"]["did_vid_count"] == 2 and got["test", 3, "u"]["did_vid_count"] == 3
    assert got["test", 1, "u"]["timestamp_ptp"] == 24.0
    old = build(spark, events, [], replace(BASELINE_SPEC, compat=True), BASELINE)
    assert old["test", 1, "u"]["timestamp_ptp"] == 24000.0


def test_tenure_and_its_slip(spark):
    last = 1_700_000_000
    ev = spark.createDataFrame([("u", "a", 1.0, last - 7200), ("v", "a", 1.0, last)], EVENTS)
    layout = survey(ev, BASELINE)
    plain = {r["did"]: r["activa_time"] for r in sampling.tenure(ev, layout).where("split='test'").collect()}
    assert plain == {"u": 2.0, "v": 0.0}
    slip = sampling.tenure(ev, layout, compat=True).where("split='test' and did='u'").first()["activa_time"]
    assert slip == pytest.approx(last - (last - 7200) / 3600)


def test_release_zone(spark):
    frame = spark.createDataFrame([("2024-01-01 08:00:00",), ("rubbish",)], "t string")
    read = lambda tz: [r[0] for r in frame.select(F.unix_seconds(parse_release(F.col("t"), tz))).collect()]
    assert read("UTC") == [1704096000, None]
    assert read("Asia/Shanghai") == [1704096000 - 8 * 3600, None]


def test_clip_keeps_null(spark):
    frame = spark.createDataFrame([(v,) * 3 for v in (-1.0, 0.5, 8.0, None)],
                                  "active_days double, watch_nums double, watch_durations double")
    got = scoring.clip_predictions(frame).collect()
    assert [r[0] for r in got] == [1.0, 1.0, 7.0, None]
    assert [r[1] for r in got] == [0.0, 0.5, 8.0, None]


def test_blend_and_key_mismatch(spark):
    schema = "did string, active_days double, watch_nums double, watch_durations double"
    a = spark.createDataFrame([("u", 9.0, 2.0, 4.0), ("only1", 1.0, 1.0, 1.0)], schema)
    b = spark.createDataFrame([("u", 7.0, 4.0, 8.0), ("only2", 1.0, 1.0, 1.0)], schema)
    got = {r["did"]: tuple(r)[1:] for r in scoring.blend(a, b).collect()}
    assert got == {"u": (7.0, 3.0, 6.0), "only1": (None, None, None)}
    pairs = sorted(((r["did1"], r["did2"]) for r in scoring.key_mismatch(a, b).collect()), key=str)
    assert pairs == [("only1", None), (None, "only2")]


def test_features_anchor_on_the_last_event_present(spark):
    day = lambda back: secs("2024-06-30T12:00:00") - back * 86400
    events = [("u", "a", 1.0, day(0)), ("u", "a", 1.0, day(12)), ("u", "a", 1.0, day(13))]
    got = build(spark, events, [ITEM_A], SPEC_1, SET_1)
    assert got["valid", 1, "u"]["did_vid_count"] == 1  # the history ends five days early
    assert got["valid", 3, "u"]["did_vid_count"] == 2


def test_range_profile_is_strict(spark):
    frame = spark.createDataFrame(
        [(126, 127, -128, 40000, 1e300, 1.5, "x"), (0, 0, 0, 0, 0.0, 0.5, "y")],
        "a long, b long, c long, d long, e double, f double, g string",
    )
    fit = {r["column"]: r["fitting"] for r in range_profile(frame).collect()}
    assert fit == {"a": "tinyint", "b": "smallint", "c": "smallint", "d": "int", "e": "double", "f": "float"}
    kept = dict(narrow_types(frame).dtypes)
    assert kept["d"] == "int" and kept["g"] == "string"


def test_r2_by_hand(spark):
    frame = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 3.0)], "y double, p double")
    assert scoring.r2_scores(frame, {"y": "p"}).first()["r2_y"] == pytest.approx(0.5)
    holes = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 3.0), (99.0, None), (None, 5.0)], "y double, p double")
    assert scoring.r2_scores(holes, {"y": "p"}).first()["r2_y"] == pytest.approx(0.5)
    assert scoring.r2_scores(frame, {"y": "p"})._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
    flat = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y double, p double")
    assert scoring.r2_scores(flat, {"y": "p"}).first()["r2_y"] is None


def test_empty_events(spark):
    ev = spark.createDataFrame([], EVENTS)
    layout = survey(ev, SET_1)
    assert layout.splits == ()
    assert sampling.split_labels(localize(ev), layout).count() == 0


def test_feature_names_of_the_sets():
    """The names, stated once more and apart from the build (fixed values)."""
    def stats(key, *names):
        return [f"w95_did_{key}_{{d}}_mean" if n == "w95" else f"did_{key}_{{d}}_{n}" for n in names]

    groups = [f"{g}_{m}" for g in ("vid", "did_cid", "is_intact_cid") for m in ("active_days", "watch_nums", "watch_durations")]
    first = [f"is_intact_{k}_{m}_{{d}}" for k in (1, 2, 3, 4, 7, 9) for m in ("vts", "vid")]
    first += ["did_vid_{d}_count", "did_vid_{d}_nunique", "did_vid_{d}_nunique_count", "ts_ptp_{d}", "did_date_{d}_nunique",
              "did_date/days_{d}_nunique", "did_cid_{d}_nunique", "did_classify_id_{d}_nunique", "did_series_id_{d}_nunique"]
    for key in ("vts", "u_date"):
        first += stats(key, "w95", "mean", "std", "min", "max", "sum")
    first += stats("vts/duration", "w95", "mean", "std", "min", "max")
    for key in groups:
        first += stats(key, "w95", "mean", "std", "min", "max")
    for days in (3, 120):
        assert sorted(SPEC_1.wide_columns((days,))) == sorted(n.format(d=days) for n in first)
    third = ["did_vid_{d}_count", "did_vid_{d}_nunique", "did_vid_{d}_nunique_count", "timestamp_ptp_{d}", "did_date_{d}_nunique",
             "did_cid_{d}_nunique", "did_classify_id_{d}_nunique", "cid_like_{d}", "classify_id_like_{d}"]
    third += stats("vts", "mean", "std", "min", "max", "sum") + stats("g_vid_{d}", "mean", "std", "min", "max", "sum")
    assert sorted(BASELINE_SPEC.wide_columns((7,))) == sorted(n.format(d=7) for n in third)


def test_feature_counts():
    assert [len(SPEC_1.wide_columns()), len(SPEC_2.wide_columns())] == [645, 484]
    assert len(BASELINE_SPEC.wide_columns()) == 114  # tenure is the 115th
    assert len(set(SPEC_1.wide_columns())) == 645
    assert math.isclose(sum(scoring.SHARES.values()), 1.0)


def test_values_are_grouped_once_for_all_splits(spark):
    """Distinct counts group a user's values once, not once per split, and agree with plain sets."""
    days = [(d, v, d % 40, f"c{v % 3}" if v % 4 else None) for d in (1, 2) for v in range(9)]
    base = "date'2024-01-01'"
    cells = spark.createDataFrame(days, "did long, vid long, back int, cid string").selectExpr(
        "did", "vid", "cid", f"date_sub({base}, back + CAST(vid AS INT) * 3) AS date_day")
    last = 19723  # 2024-01-01
    splits = (Split("a", None, (last - 30, last), last), Split("b", None, (last - 30, last - 5), last - 5), Split("none", None, (0, 1), None))
    layout = Layout(CALENDAR, last, splits)
    spec = SPEC_1.pick((3, 7, 30), lambda f: f.block == "distinct" and f.arg[0] in ("vid", "cid"))
    block = _distinct_block(cells, layout, spec)
    got = {(r.did, r.split, r.days): (r.did_vid_nunique, r.did_cid_nunique) for r in block.collect()}
    want = {}
    for s in splits[:2]:
        for d in (3, 7, 30):
            for did in (1, 2):
                hit = [r for r in cells.collect() if r.did == did and s.history[0] <= (day := (r.date_day - date(1970, 1, 1)).days) and s.anchor - d < day <= s.anchor]
                if hit:
                    want[did, s.name, d] = (len({r.vid for r in hit}), len({r.cid for r in hit}))
    assert got == want and len(want) > 6
    plan = block._jdf.queryExecution().optimizedPlan().toString()
    assert "min(_b0" in plan and "min(_b1" in plan  # a column per split


def test_products_of_counts_past_a_long_are_exact(spark):
    big = 2**40 + 12345
    rows = spark.createDataFrame([(1, big, 2**30 + 7), (1, 3, 5), (1, None, 9), (2, None, 1)], "k int, v_watch_nums long, n long")
    got = {r.k: r.s for r in rows.groupBy("k").agg(F.expr(f"{moments.whole_sum('v_watch_nums', 'n')} AS s")).collect()}
    assert got[1] == big * (2**30 + 7) + 15 and got[2] is None
