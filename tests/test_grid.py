from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.frames import START, at, series, values, wave
from tidewatch.operators.chunks import across_chunks, chunk_window, chunked, own_rows, positions, rolling, streamed
from tidewatch.operators.explore import rolling_buckets
from tidewatch.operators.grid import deal, gap_islands, missing_timestamps, regularise
from tidewatch.operators.split import assert_no_leak, cv_folds, temporal_split
from tidewatch.schemas import HOURLY

TINY = HOURLY.on(chunk_rows=4)  # many chunks, so that every rule crosses their borders


@pytest.mark.parametrize("panel", [HOURLY, TINY])
def test_gap_is_filled_linearly(spark, panel):
    df = series(spark, [float(i) for i in range(30)], gaps=range(5, 19))
    out = values(regularise(df, panel, "linear"))
    assert out == pytest.approx([float(i) for i in range(30)])


@pytest.mark.parametrize("panel", [HOURLY, TINY])
def test_nulls_at_both_ends_take_the_nearest_value(spark, panel):
    df = series(spark, [None, None, 3.0, None, 5.0, None, None, None, None, None])
    assert values(regularise(df, panel, "linear")) == [3, 3, 3, 4, 5, 5, 5, 5, 5, 5]
    assert values(regularise(df, panel, "ffill")) == [3, 3, 3, 3, 5, 5, 5, 5, 5, 5]
    assert values(regularise(df, panel, "bfill")) == [3, 3, 3, 5, 5, 5, 5, 5, 5, 5]
    assert values(regularise(df, panel, "drop")) == [3, 5]
    assert values(regularise(df, panel)) == [None, None, 3, None, 5, None, None, None, None, None]


def test_all_null_and_one_row(spark):
    assert values(regularise(series(spark, [None, None, None]), TINY, "linear")) == [None] * 3
    assert values(regularise(series(spark, [7.0]), TINY, "linear")) == [7.0]


def test_nan_is_null(spark):
    assert values(regularise(series(spark, [1.0, float("nan"), 3.0]), TINY, "linear")) == [1, 2, 3]


def test_off_grid_rows_vanish_and_still_bound_the_grid(spark):
    rows = [("a", at(0), 1.0), ("a", at(1.25), 50.0), ("a", at(2), 3.0), ("a", at(4.5), 9.0)]
    df = spark.createDataFrame(rows, "series string, timestamp timestamp, demand double")
    assert values(regularise(df, TINY, "linear")) == [1, 2, 3, 3, 3]


def test_duplicates(spark):
    rows = [("a", at(0), 1.0, 1), ("a", at(1), 2.0, 2), ("a", at(1), 4.0, 3), ("a", at(2), 5.0, 4)]
    df = spark.createDataFrame(rows, "series string, timestamp timestamp, demand double, seen int")
    with pytest.raises(Exception, match="duplicate timestamp"):
        regularise(df, TINY).collect()
    assert values(regularise(df, TINY, on_duplicate="mean")) == [1, 3, 5]
    assert values(regularise(df, TINY, on_duplicate="last", order_by="seen")) == [1, 4, 5]
    with pytest.raises(ValueError):
        regularise(df, TINY, on_duplicate="last")


def test_unknown_strategy(spark):
    with pytest.raises(ValueError):
        regularise(series(spark, [1.0]), TINY, "spline")


def test_pass_through_columns_are_null_on_added_rows(spark):
    df = series(spark, wave(20), gaps=[5, 6]).withColumn("is_anomaly", F.lit(False))
    out = regularise(df, TINY, "linear")
    assert out.count() == 20
    assert out.where("is_anomaly is null").count() == 2
    # the null flags are then dropped with any other null row
    assert out.na.drop("any").count() == 18


def test_missing_and_islands(spark):
    df = series(spark, wave(40), gaps=[5, 6, 7, 20, *range(25, 36)])
    for panel in (HOURLY, TINY):
        assert values(missing_timestamps(df, panel), "timestamp") == [at(i) for i in [5, 6, 7, 20, *range(25, 36)]]
        got = [(r.gap_start, r.gap_end, r.n_missing) for r in gap_islands(df, panel).orderBy("gap_start").collect()]
        assert got == [(at(5), at(7), 3), (at(20), at(20), 1), (at(25), at(35), 11)]
    assert missing_timestamps(series(spark, wave(5)), TINY).count() == 0


def test_a_gap_far_longer_than_a_chunk(spark):
    df = spark.createDataFrame([("a", at(0), 0.0), ("a", at(10_000), 10_000.0)], "series string, timestamp timestamp, demand double")
    out = regularise(df, TINY, "linear", with_position=True)
    assert out.count() == 10_001
    assert out.where(F.abs(F.col("demand") - F.col("pos")) > 1e-6).count() == 0


def test_series_of_very_different_length(spark):
    df = series(spark, wave(200), "long").unionByName(series(spark, [1.0, 2.0], "short", at(7)))
    counts = dict(regularise(df, TINY, "linear").groupBy("series").count().collect())
    assert counts == {"long": 200, "short": 2}


def test_positions_by_rank(spark):
    df = series(spark, wave(30), gaps=[3, 4, 9]).unionByName(series(spark, wave(5), "b"))
    rows = positions(df, TINY).orderBy("series", "timestamp").collect()
    assert [r.pos for r in rows] == [*range(27), *range(5)]
    assert {(r.series, r.n) for r in rows} == {("a", 27), ("b", 5)}


@pytest.mark.parametrize("chunk", [3, 8, 2048])
def test_rolling_equals_plain_window(spark, chunk):
    from pyspark.sql import Window

    panel, widths = HOURLY.on(chunk_rows=chunk), [3, 5, 24]
    df = series(spark, [v if i % 7 else None for i, v in enumerate(wave(120))])
    ours = own_rows(rolling(chunked(df, panel, max(widths)), chunk_window(panel), "demand", widths, ["mean", "std", "min", "max", "count"], shift=1))
    ours = ours.orderBy("timestamp").collect()
    w = Window.partitionBy("series").orderBy("timestamp")
    plain = df
    for n in widths:
        f = w.rowsBetween(-n, -1)
        for name, fn in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max), ("count", F.count)):
            plain = plain.withColumn(f"_{name}_{n}", fn("demand").over(f))
    for a, b in zip(ours, plain.orderBy("timestamp").collect()):
        for n in widths:
            for name in ("mean", "std", "min", "max", "count"):
                x, y = a[f"_{name}_{n}"], b[f"_{name}_{n}"]
                assert (x is None) == (y is None) and (x is None or x == pytest.approx(y, abs=1e-9)), (name, n)


def test_rolling_std_of_constant_is_zero(spark):
    df = series(spark, [1234.56] * 200)
    out = rolling(chunked(df, TINY, 168), chunk_window(TINY), "demand", [168], ["std"])
    assert out.agg(F.max("_std_168")).first()[0] < 1e-9


def test_split_sizes_and_order(spark):
    parts = temporal_split(series(spark, wave(500)), TINY)
    assert dict(parts.groupBy("split").count().collect()) == {"train": 350, "val": 75, "test": 75}
    assert [r.split for r in parts.orderBy("timestamp").collect()] == ["train"] * 350 + ["val"] * 75 + ["test"] * 75
    train, val, test = (parts.where(F.col("split") == s).drop("split") for s in ("train", "val", "test"))
    assert_no_leak(train, val, test)
    with pytest.raises(ValueError):
        assert_no_leak(train, train, test)


def test_ratio_zero_is_not_the_default(spark):
    parts = temporal_split(series(spark, wave(100)), TINY, train_ratio=0.5, val_ratio=0.0)
    assert dict(parts.groupBy("split").count().collect()) == {"train": 50, "test": 50}


def test_folds_match_the_public_definition(spark):
    out = cv_folds(series(spark, wave(120)), TINY, n_splits=5, gap=4)
    rows = out.groupBy("fold", "role").agg(F.count(F.lit(1)).alias("n"), F.max("timestamp").alias("hi"), F.min("timestamp").alias("lo")).collect()
    got = {(r.fold, r.role): (r.n, r.lo, r.hi) for r in rows}
    for i in range(5):
        start = 120 - (5 - i) * 20
        assert got[(i, "val")] == (20, at(start), at(start + 19))
        assert got[(i, "train")] == (start - 4, START, at(start - 5))


def test_summaries_of_a_hundred_thousand_chunks(spark):
    """Against one plain window per series; no task of the two levels holds more than a group or one row per group."""
    rows = spark.range(100_000).select(
        F.when(F.col("id") < 99_000, "hot").otherwise("small").alias("series"), (F.col("id") * 3 - 1000).alias("_chunk"),
        F.when(F.col("id") % 700 == 5, F.col("id")).alias("v"), (F.col("id") % 7).alias("c"),
    )
    wanted = {"first": ("min", "_chunk"), "last": ("max", "_chunk"), "n": ("sum", "c"), "before": ("before", "c"),
              "left": ("last_before", "v"), "right": ("first_after", "v")}
    found = across_chunks(rows, ["series"], 256, wanted)
    by = "over (partition by series order by _chunk"
    whole = "over (partition by series)"
    plain = rows.selectExpr(
        "*", f"min(_chunk) {whole} as first", f"max(_chunk) {whole} as last", f"sum(c) {whole} as n",
        f"coalesce(sum(c) {by} rows between unbounded preceding and 1 preceding), 0) as before",
        f"lag(v) ignore nulls {by}) as left", f"lead(v) ignore nulls {by}) as right",
    )
    assert found.columns == plain.columns
    assert found.count() == 100_000
    assert found.exceptAll(plain).isEmpty()


def test_one_series_is_spread_over_tasks(spark):
    """Groups of one series lie in several partitions, whole groups in one, also where nothing is broadcast."""
    rows = spark.range(100_000).selectExpr("'a' as series", "id as _chunk", "id as c")
    found = across_chunks(rows, ["series"], 2048, {"before": ("before", "c")})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        held = found.select(F.floor(F.col("_chunk") / 2048).alias("g"), F.spark_partition_id().alias("p")).distinct().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
    assert len(held) == len({r.g for r in held}) == 49
    assert len({r.p for r in held}) > 1


@pytest.mark.parametrize("fill", ["linear", "ffill", "bfill"])
@pytest.mark.parametrize("back", [0, 3, 9])
def test_dealt_rows_are_the_grid_with_look_back(spark, fill, back):
    """Nulls, off-grid rows, gaps over whole chunks, series of one row and of many chunks."""
    panel = HOURLY.on(chunk_rows=2)  # chunks of 16 rows, or of as many as look-back needs
    given = [v if i % 5 else None for i, v in enumerate(wave(150))]
    df = series(spark, given, gaps=[*range(3, 9), *range(20, 95), *range(99, 104)])
    df = df.unionByName(series(spark, [None, None, 2.0], "b", at(41))).unionByName(series(spark, [None] * 20, "c", at(3.25)))
    df = df.unionByName(spark.createDataFrame([("a", at(30.5), 7.0), ("a", at(170.5), 7.0)], df.schema)).withColumn("x", F.lit(1))
    rows, dealt, longer = deal(df, panel, fill, back, with_position=True)
    rows = rows.withColumn("part", F.spark_partition_id()).withColumn("id", F.monotonically_increasing_id()).toPandas()
    assert longer and dealt.full and dealt.dealt == back
    chunks = rows[rows["_own"]].groupby("series")["_chunk"].nunique()
    assert all((chunks[name] == 1) == whole for name, whole in zip(rows["series"], rows["_whole"]))
    plain = regularise(df, panel, fill, with_position=True).orderBy("series", "timestamp").toPandas()
    own = rows[rows["_own"]].sort_values(["series", "timestamp"], ignore_index=True)
    for c in ("series", "timestamp", "pos", "n"):
        assert own[c].tolist() == plain[c].tolist()
    for c in ("demand", "x"):
        assert own[c].to_numpy() == pytest.approx(plain[c].to_numpy(), nan_ok=True)
    for (name, _), chunk in rows.sort_values("id").groupby(["series", "_chunk"]):
        assert chunk["part"].nunique() == 1 and (chunk["id"].diff().dropna() == 1).all()  # beside each other
        assert (chunk["pos"].diff().dropna() == 1).all()  # in time order, no gap
        first = chunk[chunk["_own"]]["pos"].iloc[0]
        assert first - chunk["pos"].iloc[0] >= min(back, first)
        whole = plain[plain["series"] == name].set_index("pos")["demand"]
        assert chunk["demand"].to_numpy() == pytest.approx(whole[chunk["pos"]].to_numpy(), nan_ok=True)


def test_dealt_duplicates_raise(spark):
    df = spark.createDataFrame([("a", at(0), 1.0), ("a", at(1), 2.0), ("a", at(1), 4.0)], "series string, timestamp timestamp, demand double")
    with pytest.raises(Exception, match="duplicate timestamp"):
        deal(df, TINY)[0].collect()
    with pytest.raises(ValueError):
        deal(df, TINY, None)


@pytest.mark.parametrize("shift", [0, 1])
def test_streamed_windows_equal_windows(spark, shift):
    widths, stats = [3, 5, 24], ["mean", "std", "min", "max", "count", "sum"]
    df = series(spark, wave(150), gaps=range(30, 60)).unionByName(series(spark, [None] * 5, "b"))
    rows, dealt, _ = deal(df, HOURLY.on(chunk_rows=4), back=25)
    ours = streamed(rows.drop("_whole"), dealt, widths, stats, shift, (1, 7)).orderBy("series", "timestamp").toPandas()
    full = HOURLY.on(chunk_rows=32, full=True)
    plain = rolling(chunked(regularise(df, fill="linear"), full, 25), chunk_window(full), "demand", widths, stats, shift=shift)
    plain = own_rows(plain.select("*", *[F.lag("demand", k).over(chunk_window(full)).alias(f"_lag_{k}") for k in (1, 7)]))
    plain = plain.orderBy("series", "timestamp").toPandas()
    assert len(ours) == len(plain) == 155
    for c in plain.columns[2:]:
        assert ours[c].to_numpy(float) == pytest.approx(plain[c].to_numpy(float), nan_ok=True, rel=1e-12), c


def _exchanges_above_gaps(df):
    """Shuffles of rows that are already exploded from gaps."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
    at = [i for i, line in enumerate(plan) if "Generate" in line]
    assert at
    return [line for line in plan[: at[0]] if "Exchange" in line]


def test_rolling_buckets_shuffles_no_grid_rows(spark):
    rows, dealt, _ = deal(series(spark, wave(50), gaps=[4]), HOURLY.on(step=86400, chunk_rows=8), back=8)
    out = rolling_buckets(rows.drop("_whole"), dealt, widths=(3, 8))
    assert _exchanges_above_gaps(out) == []
