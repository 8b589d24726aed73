"""DataFrame operators, their equivalent forms, and skewed keys."""

import datetime as dt

import pytest
from helpers import bag, executed, plan
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallygrid.functions import calendar
from tallygrid.operators import quality
from tallygrid.operators.horizons import calendar_between, month_horizon, trailing_horizon
from tallygrid.operators.overlaps import cross_overlap, overlap_explode, overlap_join
from tallygrid.operators.ranking import latest_with_ties, with_dense_ranks
from tallygrid.operators.scd import scd2_current
from tallygrid.operators.skew import salted_join
from tallygrid.params import MonthRange, RunParams

D = dt.date
RUN = RunParams(month_start=D(2000, 7, 1), period_end=D(2001, 6, 30), as_of=D(2026, 12, 1))


@pytest.fixture(scope="module")
def days(spark):
    return calendar_between(spark, D(1999, 1, 1), D(2026, 12, 31))


@pytest.fixture(scope="module")
def periods(spark):
    rows = [(i, D(2000, 1, 1) + dt.timedelta(days=7 * i % 800), i % 90) for i in range(400)]
    rows += [(900, D(2000, 8, 20), -10), (901, D(2000, 8, 5), -30)]
    frame = spark.createDataFrame(rows, "id int, first_day date, n int")
    dated = frame.select("id", "first_day", F.date_add("first_day", F.col("n")).alias("final_day"))
    return dated.union(spark.createDataFrame([(902, None, D(2000, 9, 1)), (903, D(2000, 9, 1), D(9999, 12, 31))], dated.schema))


def test_horizons(days):
    assert month_horizon(days, RUN).count() == 12
    trailing = trailing_horizon(days, RUN).agg(F.min("mth_sdt"), F.max("mth_sdt"), F.count("*")).first()
    assert tuple(trailing) == (D(2024, 7, 1), D(2026, 6, 1), 24)
    later = RunParams(month_start=D(2000, 7, 2), period_end=D(2001, 6, 30), as_of=D(2001, 1, 1))
    assert later.accrual_range == MonthRange(D(2000, 8, 1), D(2001, 6, 1))
    assert month_horizon(days, later).count() == later.accrual_range.months == 11


def test_overlap_forms_agree(days, periods):
    horizon = month_horizon(days, RUN)
    args = (periods, horizon, RUN.accrual_range, F.col("first_day"), F.col("final_day"))
    expected = bag(overlap_join(*args))
    assert expected == bag(overlap_explode(*args)) == bag(cross_overlap(*args))
    assert sum(expected.values()) > 100


def test_no_form_carries_a_hint(days, periods):
    for form in (overlap_join, overlap_explode, cross_overlap):
        frame = form(periods, month_horizon(days, RUN), RUN.accrual_range, F.col("first_day"), F.col("final_day"))
        assert "strategy=broadcast" not in plan(frame)


def test_overlap_days_add_up_to_the_period(days, periods):
    months = MonthRange(D(1999, 1, 1), D(2026, 12, 1))
    real = periods.filter("first_day <= final_day AND final_day < '2026-01-01'")
    spread = overlap_explode(real, days.transform(lambda c: _months(c)), months, F.col("first_day"), F.col("final_day"))
    shared = calendar.overlap_days(*(F.col(c) for c in ("mth_sdt", "mth_edt", "first_day", "final_day")))
    total = spread.groupBy("id", "first_day", "final_day").agg(F.sum(shared).alias("n"))
    assert total.count() == real.count()
    assert total.filter(F.col("n") != calendar.inclusive_days(F.col("first_day"), F.col("final_day"))).isEmpty()


def _months(calendar_days):
    return calendar_days.select(F.col("first_day_month").alias("mth_sdt"), F.col("last_day_month").alias("mth_edt")).distinct()


def _bills(spark, hot):
    """Account 1 holds ``hot`` rows, 20 others five each, with ties and missing dates."""
    heavy = spark.range(hot).select(F.lit(1).alias("account"), (F.col("id") % 40).cast("int").alias("d"))
    light = spark.range(100).select((F.col("id") % 20 + 2).cast("int").alias("account"), (F.col("id") % 7).cast("int").alias("d"))
    rows = heavy.union(light)
    sdt = F.when(F.col("d") != 3, F.date_add(F.lit(D(2000, 1, 1)), F.col("d")))
    return rows.select("account", sdt.alias("sdt"), F.date_add(F.lit(D(2000, 3, 1)), F.col("d") % 5).alias("edt"))


def test_dense_ranks_equal_the_plain_window(spark):
    rows = _bills(spark, 5000)
    plain = rows.select(
        "*",
        F.dense_rank().over(Window.partitionBy("account").orderBy(F.col("sdt").desc())).alias("a"),
        F.dense_rank().over(Window.partitionBy("account").orderBy(F.col("edt").desc())).alias("b"),
    )
    ranked = with_dense_ranks(rows, "account", {"sdt": "a", "edt": "b"})
    assert bag(plain) == bag(ranked)
    assert bag(plain.filter("a = 1 OR b = 1")) == bag(latest_with_ties(ranked, "a", "b"))


def test_window_sees_distinct_dates_only(spark):
    """The ranking window of a hot account gets its dates, not its rows."""
    text = plan(with_dense_ranks(_bills(spark, 5000), "account", {"sdt": "a"})).split("Optimized Logical Plan")[1]
    window, aggregate = text.index("Window ["), text.index("Aggregate [")
    assert window < aggregate


def test_skewed_join_partitions_are_split(spark):
    kept = {k: spark.conf.get(k, None) for k in _SKEW}
    try:
        for key, value in _SKEW.items():
            spark.conf.set(key, value)
        lines = spark.range(400_000).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("account"), F.md5(F.col("id").cast("string")).alias("t")
        )
        owners = spark.range(5000).select(F.col("id").alias("account"), F.md5(F.col("id").cast("string")).alias("name"))
        joined = lines.join(owners, "account").groupBy("account").agg(F.count("t").alias("n"))
        assert "skew=true" in executed(joined)
        assert joined.agg(F.sum("n")).first()[0] == 400_000
    finally:
        for key, value in kept.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
}


def test_salted_join_keeps_all_pairs_and_spreads_them(spark):
    many = spark.range(2000).select((F.col("id") % 3).alias("k"), "id")
    few = spark.range(12).select((F.col("id") % 4).alias("k"), F.col("id").alias("charge"))
    expected = bag(many.join(few, "k"))
    for rows_per_salt in (1_000_000, 50):
        assert bag(salted_join(many, few, ["k"], ["id"], rows_per_salt)) == expected
        assert bag(salted_join(many, few, ["k"], ["id"], rows_per_salt, partitions=5)) == expected


def test_a_hot_key_uses_many_tasks(spark):
    many = spark.range(3000).select(F.when(F.col("id") < 1500, -1).otherwise(F.col("id")).alias("k"), "id")
    few = many.select("k").distinct().join(spark.range(4).withColumnRenamed("id", "charge"))
    kept = {k: spark.conf.get(k, None) for k in _SKEW}
    try:
        for key in list(_SKEW)[:2]:
            spark.conf.set(key, "-1")
        joined = salted_join(many, few, ["k"], ["id"], rows_per_salt=200, partitions=16)
        homes = joined.filter("k = -1").select(F.spark_partition_id().alias("p")).distinct().count()
        assert joined.count() == 12_000 and homes >= 8
    finally:
        for key, value in kept.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_current_rows_and_pushed_flag(spark, tmp_path):
    spark.createDataFrame([(1, "a", 1), (1, "b", 0)], "id int, name string, adh_active_flag int").write.parquet(f"{tmp_path}/t")
    current = scd2_current(spark.read.parquet(f"{tmp_path}/t"), "id")
    assert [tuple(r) for r in current.collect()] == [(1,)]
    text = plan(current)
    assert "EqualTo(adh_active_flag,1)" in text and "ReadSchema: struct<id:int,adh_active_flag:int>" in text


def test_quality(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "a")], "id int, v string")
    assert bag(quality.unique(frame, "id")) == {(1, 2): 1}
    assert quality.not_null(frame, "id").count() == 2
    assert bag(quality.accepted_values(frame, "v", ["a", "b"])) == {(1, "c"): 1}
    assert quality.passes(quality.custom_query(frame, lambda f: f.filter("id = 5")))
    assert not quality.passes(quality.not_null(frame, "id"))
