"""Hand-worked cases for the operators and the chosen deviations."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel.functions.geo import haversine_miles, speed_mph, vincenty_miles
from kestrel.functions.timecols import hhmm_minutes_between, round_to_minute
from kestrel.operators import mileage as M
from kestrel.operators import risk as RK
from kestrel.operators.quantiles import exact_quantiles
from kestrel.operators.replay import drop_repeat_timestamps, replay_schedule
from kestrel.operators.sequence import next_in_sequence
from kestrel.operators.bins import fine_bin, log_bin
from kestrel.operators.ranges import global_index, range_quantiles, range_sorted
from kestrel.operators.topk import kth_largest, top_k_per_group

T0 = dt.datetime(2024, 1, 1)


def test_haversine_equals_vincenty_and_zero_on_same_point(spark):
    rng = random.Random(1)
    rows = [(51 + rng.random(), -1 + rng.random(), 51 + rng.random(), -1 + rng.random()) for _ in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    out = df.select(haversine_miles("a", "b", "c", "d").alias("h"), vincenty_miles("a", "b", "c", "d").alias("v"),
                    haversine_miles("a", "b", "a", "b").alias("z")).collect()
    for r in out:
        assert abs(r.h - r.v) < 1e-6
        assert r.z == 0.0


def test_speed_zero_when_no_time_passes(spark):
    df = spark.createDataFrame([(1.0, 10, 10), (1.0, 10, 3610)], "d double, t0 long, t1 long")
    assert [r.s for r in df.select(speed_mph("d", "t0", "t1").alias("s")).collect()] == [0.0, 1.0]


def test_minute_rounding_half_up(spark):
    df = spark.createDataFrame([(29,), (30,), (89,), (90,)], "u long")
    got = [r.m for r in df.select(round_to_minute("u").alias("m")).collect()]
    assert got == [T0.replace(year=1970), T0.replace(year=1970, minute=1), T0.replace(year=1970, minute=1),
                   T0.replace(year=1970, minute=2)]


def test_hhmm_minutes_wrap_midnight(spark):
    df = spark.createDataFrame([("23:58", "00:03"), ("00:03", "23:58"), ("10:00", "10:07")], "a string, b string")
    assert [r.m for r in df.select(hhmm_minutes_between("a", "b").alias("m")).collect()] == [5, -5, 7]


def test_dedupe_keeps_all_ties_of_min_latitude(spark):
    rows = [(1, T0 + dt.timedelta(seconds=s), lat) for s, lat in [(0, 51.0), (10, 51.0), (20, 51.5), (70, 52.0)]]
    df = spark.createDataFrame(rows, "vehicle_number int, ts timestamp_ntz, lat double")
    df = df.withColumn("unix_ts", F.unix_timestamp("ts")).withColumn("ts_round", round_to_minute("unix_ts")) \
        .withColumn("bucket", F.lit(0))
    kept = sorted(r.lat for r in M.dedupe_min_latitude(df).collect())
    assert kept == [51.0, 51.0, 52.0]


def test_next_in_sequence_equals_plain_lead_on_a_hot_key(spark):
    rng = random.Random(7)
    rows = [(0 if rng.random() < 0.5 else rng.randint(1, 5), rng.randint(0, 100000), rng.random()) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k int, t long, v double").withColumn("b", F.floor(F.col("t") / 997))
    got = next_in_sequence(df, "k", "b", ["t", "v"], ["v", "t"])
    w = Window.partitionBy("k").orderBy("t", "v")
    want = df.withColumn("v_next", F.lead("v").over(w)).withColumn("t_next", F.lead("t").over(w))
    g = sorted(tuple(r) for r in got.select("k", "t", "v", "v_next", "t_next").collect())
    e = sorted(tuple(r) for r in want.select("k", "t", "v", "v_next", "t_next").collect())
    assert g == e


def test_kth_largest_matches_brute_force_with_duplicates_and_small_groups(spark):
    rng = random.Random(3)
    rows = [(g, float(rng.randint(0, 40))) for g in range(6) for _ in range(rng.choice([3, 9, 10, 57, 400]))]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r.g: (r.k, r.kth) for r in kth_largest(df, ["g"], "v").collect()}
    for g in range(6):
        vals = sorted((v for gg, v in rows if gg == g), reverse=True)
        k = len(vals) // 10
        assert got[g] == (k, vals[k - 1] if k else None)


def test_top_k_per_group_equals_sorting(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 3), i, rng.randint(0, 9)) for i in range(2000)]
    df = spark.createDataFrame(rows, "u int, item int, score int")
    got = top_k_per_group(df, ["u"], [F.desc("score"), F.col("item")], 5).select("u", "rank", "item").collect()
    want = []
    for u in range(4):
        own = sorted((-s, i) for v, i, s in rows if v == u)[:5]
        want += [(u, k + 1, i) for k, (_, i) in enumerate(own)]
    assert sorted(map(tuple, got)) == want


def test_kth_largest_of_a_heavy_value_ranks_distinct_values_only(spark):
    df = spark.range(20_000).selectExpr("'g' AS g", "if(id % 2 = 0, 100.0D, 100.0D + (id % 40) / 64.0) AS v")
    r = kth_largest(df, ["g"], "v", k=F.lit(10_500)).collect()[0]
    vals = sorted((x.v for x in df.collect()), reverse=True)
    assert (r.n, r.k, r.kth) == (20_000, 10_500, vals[10_499])


def test_exact_quantiles_match_numpy(spark):
    rng = random.Random(11)
    rows = [(g, float(rng.randint(0, 12))) for g in ("a", "b") for _ in range(rng.randint(5, 300))]
    q = exact_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v",
                        {"q1": 0.25, "median": 0.5, "q3": 0.75}).collect()
    for r in q:
        vals = np.array([v for g, v in rows if g == r.g])
        assert math.isclose(r.q1, np.quantile(vals, 0.25)) and math.isclose(r.median, np.quantile(vals, 0.5))
        assert math.isclose(r.q3, np.quantile(vals, 0.75)) and r.n == len(vals)


def test_drop_repeat_timestamps_and_first_row_option(spark):
    rows = [("s", i, T0 + dt.timedelta(hours=h)) for i, h in enumerate([0, 0, 1, 1, 1, 2])]
    df = spark.createDataFrame(rows, "source string, line_no int, ts timestamp_ntz")
    assert [r.line_no for r in drop_repeat_timestamps(df, "source", "line_no", "ts").orderBy("line_no").collect()] == [0, 2, 5]
    assert [r.line_no for r in drop_repeat_timestamps(df, "source", "line_no", "ts", keep_first=False)
            .orderBy("line_no").collect()] == [2, 5]


def test_replay_schedule_full_seconds_and_day_wrap(spark):
    rows = [("s", 0, T0), ("s", 1, T0 + dt.timedelta(days=1, seconds=120))]
    df = spark.createDataFrame(rows, "source string, line_no int, ts timestamp_ntz")
    full = replay_schedule(df, "source", "line_no", "ts", speedup=60).orderBy("line_no").collect()
    wrap = replay_schedule(df, "source", "line_no", "ts", speedup=60, wrap_days=True).orderBy("line_no").collect()
    assert full[1].gap_seconds == 86520 and full[1].sleep_seconds == 1442
    assert wrap[1].gap_seconds == 120 and wrap[1].sleep_seconds == 2


def _customers(spark, rows):
    return spark.createDataFrame(rows, "tstamp timestamp_ntz, nino string, housing double, childcare double")


def test_risk_flags_strict_and_carry_forward(spark):
    # slot = 1 hour, window = 2 slots.  slot 0: ten values 1..10 → k = 1, threshold 10.
    rows = [(T0 + dt.timedelta(minutes=i), f"n{i}", float(i + 1), 0.0) for i in range(10)]
    # slot 1: two rows (window 0..1 has 12 rows → k=1, thr = max) — one equal to the cutoff, one above
    rows += [(T0 + dt.timedelta(hours=1), "eq", 10.0, 0.0), (T0 + dt.timedelta(hours=1, minutes=1), "up", 10.5, 0.0)]
    # slot 5: nothing in the window before it has ≥10 rows → cutoff carried forward from slot 1 (10.5)
    rows += [(T0 + dt.timedelta(hours=5), "late", 10.6, 0.0), (T0 + dt.timedelta(hours=5, minutes=1), "low", 10.4, 0.0)]
    flags = RK.risk_flags(_customers(spark, rows), 3600, 2).where(F.col("risk_category") == RK.HOUSING)
    assert sorted(r.nino for r in flags.collect()) == ["late", "up"]


def test_risk_flags_none_before_first_cutoff(spark):
    rows = [(T0 + dt.timedelta(minutes=i), f"n{i}", float(i), float(i)) for i in range(9)]  # n < 10 → k = 0
    assert RK.risk_flags(_customers(spark, rows), 3600, 10).count() == 0


def test_carried_cutoffs_epochs_equal_single_pass(spark):
    rng = random.Random(13)
    rows = [(c, e, (float(rng.randint(0, 50)) if rng.random() < 0.3 else None))
            for c in ("x", "y") for e in range(0, 400, rng.choice([1, 2, 3]))]
    thr = spark.createDataFrame(rows, "risk_category string, end_slot long, kth double")
    a = sorted(map(tuple, RK.carried_cutoffs(thr, epoch_slots=7).collect()))
    b = sorted(map(tuple, RK.carried_cutoffs(thr, epoch_slots=100000).collect()))
    assert a == b
    # and against a direct definition
    for c, e, cut in a:
        prev = [k for cc, ee, k in rows if cc == c and ee < e and k is not None]
        last = max(((ee, k) for cc, ee, k in rows if cc == c and ee < e and k is not None), default=(None, None))[1]
        assert cut == (last if prev else None)


def test_kth_largest_multi_level_and_duplicate_mass(spark):
    rng = random.Random(21)
    rows = [("dup", 7.0) for _ in range(500)]                                   # one value only
    rows += [("mix", float(rng.choice([1, 2, 2, 3, 3, 3, 50]))) for _ in range(800)]
    rows += [("wide", rng.random() * 1e6) for _ in range(1500)]
    rows += [("tiny", 1.0), ("tiny", 2.0)]                                       # k = 0
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.k, r.kth) for r in kth_largest(df, ["g"], "v").collect()}
    for g in ("dup", "mix", "wide", "tiny"):
        vals = sorted((v for gg, v in rows if gg == g), reverse=True)
        k = len(vals) // 10
        assert got[g] == (k, vals[k - 1] if k else None), g


def test_bins_never_fall_as_values_rise(spark):
    rng = random.Random(2)
    ends = [0.0, -0.0, 5e-324, -5e-324, 1.7976931348623157e308, -1.7976931348623157e308, math.inf, -math.inf, 1.0, -1.0]
    values = ends + [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(3000)] + [rng.uniform(-2, 2) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", fine_bin("v").alias("fine"), log_bin("v").alias("bin"))
    got = sorted((r.v, r.bin, r.fine) for r in df.collect())
    assert all(a[1] <= b[1] and a[2] <= b[2] for a, b in zip(got, got[1:]))
    within = [(a, b) for a, b in zip(got, got[1:]) if a[1] == b[1] and 0 < a[0] and b[0] < math.inf]
    assert within and all(b[0] / a[0] <= 1.0051 for a, b in within if a[0] > 1e-300)
    odd = spark.createDataFrame([(math.nan,), (None,)], "v double").select(log_bin("v").alias("bin")).collect()
    assert odd[1].bin is None and odd[0].bin > max(b for _, b, _ in got)


def test_kth_largest_of_negative_tiny_and_special_values(spark):
    rng = random.Random(4)
    rows = [("neg", -rng.random() * 1e-5) for _ in range(300)] + [("cross", rng.uniform(-1, 1)) for _ in range(300)]
    rows += [("inf", math.inf)] * 20 + [("inf", -math.inf)] * 20 + [("inf", float(i)) for i in range(60)] + [("inf", None)] * 7
    got = {r.g: (r.n, r.k, r.kth) for r in kth_largest(spark.createDataFrame(rows, "g string, v double"), ["g"], "v",
                                                       k=F.lit(25)).collect()}
    for g in ("neg", "cross", "inf"):
        vals = sorted((v for gg, v in rows if gg == g and v is not None), reverse=True)
        assert got[g] == (len(vals), 25, vals[24])


def test_global_index_numbers_the_whole_table(spark):
    rng = random.Random(6)
    rows = [(0 if rng.random() < 0.6 else rng.randint(1, 9), i) for i in range(5000)] + [(None, 1)]
    df = spark.createDataFrame(rows, "k int, t int").repartition(7)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    got = global_index(df, ["k", "t"]).collect()
    assert [(r.k, r.t) for r in sorted(got, key=lambda r: r["index"])] == want
    assert sorted(r["index"] for r in got) == list(range(len(rows)))
    assert global_index(df.where("false"), ["k", "t"]).count() == 0


def test_range_quantiles_match_numpy_and_split_a_hot_group(spark):
    rng = random.Random(12)
    rows = [("hot", rng.random()) for _ in range(6000)] + [("b", float(rng.randint(0, 9))) for _ in range(500)]
    rows += [("one", 3.5), (None, 1.0), (None, 2.0), ("b", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = {"lo": 0.0, "q1": 0.25, "median": 0.5, "p99": 0.99, "hi": 1.0}
    got = {r.g: r for r in range_quantiles(df, ["g"], "v", probs).collect()}
    assert set(got) == {"hot", "b", "one", None}
    for g, r in got.items():
        vals = np.array([v for gg, v in rows if gg == g and v is not None])
        assert (r.n, r.min, r.max) == (len(vals), vals.min(), vals.max())
        assert all(math.isclose(r[name], np.quantile(vals, p)) for name, p in probs.items())
    merge = "spark.sql.adaptive.coalescePartitions.enabled"        # ranges this small are merged otherwise
    spark.conf.set(merge, "false")
    try:
        assert {r.g: r.median for r in range_quantiles(df, ["g"], "v", probs).collect()} == {g: r.median for g, r in got.items()}
        sizes = range_sorted(df.where("g = 'hot'").distinct(), ["g", "v"]).groupBy("_range").count().collect()
    finally:
        spark.conf.set(merge, "true")
    assert len(sizes) > 1 and max(s["count"] for s in sizes) < 4000
