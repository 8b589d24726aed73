"""Monthly measures: billed, extended from the last bill, and imputed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.functions.calendar import open_period_days, overlap_days
from tallygrid.functions.measures import (
    MONEY_COLUMNS,
    daily_volume,
    imputed_rate,
    measure_dispatch,
    seasonal_scale,
    unless_zero_rated,
)
from tallygrid.functions.numeric import zero_rate
from tallygrid.operators.overlaps import in_horizon, months_touched, overlap_explode
from tallygrid.operators.profiles import SEGMENT, segment_profile
from tallygrid.operators.ranking import latest_by_maxima, latest_in_buckets
from tallygrid.operators.skew import ROWS_PER_SALT, salted_join
from tallygrid.params import MonthRange, RunParams

# Columns of the three accrual models, in order.
_LEAD = (
    "data_source",
    "record_type",
    "seq_product_item_id",
    "market_region",
    "market_sub_region",
    "market_segment",
    "customer_segment",
    "fuel_type",
    "trans_description",
    "cntrl_load",
    "solar_zr",
    "bill_sdt",
    "bill_edt",
    "mth_sdt",
    "mth_edt",
    "service_sdt",
    "service_edt",
    "measure_name",
    "measure_code",
    "measure_unit",
    "total_days",
    "daily_amt",
    "daily_unit_quantity",
    "daily_unit_quantity_zr",
    "daily_disc_amt",
    "daily_ppd_amt",
    "daily_elig_ppd_amt",
    "measure",
)


def _labelled(rows: DataFrame, record_type: str) -> DataFrame:
    return rows.select("*", F.lit("Core").alias("data_source"), F.lit(record_type).alias("record_type")).select(*_LEAD)


def _guarded_money() -> dict[str, Column]:
    return {column: unless_zero_rated(F.col("solar_zr"), F.col(column)) for column in MONEY_COLUMNS}


def both_horizons(params: RunParams) -> MonthRange:
    """From the first to the last month of the seasonal and the accrual horizon."""
    spans = (params.seasonal_range, params.accrual_range)
    return MonthRange(min(s.first for s in spans), max(s.last for s in spans))


def monthly_core(core: DataFrame, params: RunParams) -> DataFrame:
    """Daily measures per month that their bill touches, over both horizons of a run; to be stored by month."""
    named = core.filter(F.col("measure_name").isNotNull())
    return months_touched(named, both_horizons(params), F.col("bill_sdt"), F.col("bill_edt"))


def monthly_profile(monthly: DataFrame, horizon: DataFrame) -> DataFrame:
    """:func:`seasonal_profile` from a stored :func:`monthly_core`, of which it reads the horizon's months.

    Files of a month are not dealt by account, so rows are dealt once by what the first two steps of the profile share.
    """
    daily = monthly.drop("trans_description").withColumnRenamed("ex_charge_desc", "trans_description")
    return segment_profile(in_horizon(daily, horizon).repartition(*SEGMENT, "mth_no", "seq_product_item_id"))


def monthly_actuals(monthly: DataFrame, horizon: DataFrame) -> DataFrame:
    """:func:`actuals` from a stored :func:`monthly_core`, of which it reads the horizon's months."""
    return _measured_actuals(in_horizon(monthly, horizon))


def seasonal_profile(core: DataFrame, horizon: DataFrame, params: RunParams) -> DataFrame:
    """Averages of daily values per segment, charge and month of the trailing horizon."""
    daily = core.filter(F.col("measure_name").isNotNull()).drop("trans_description")
    monthly = overlap_explode(
        daily.withColumnRenamed("ex_charge_desc", "trans_description"),
        horizon,
        params.seasonal_range,
        F.col("bill_sdt"),
        F.col("bill_edt"),
    )
    return segment_profile(monthly)


def actuals(core: DataFrame, horizon: DataFrame, params: RunParams) -> DataFrame:
    """Billed days of each month. ``core`` rows are distinct, so these are too."""
    billed = overlap_explode(
        core.filter(F.col("measure_name").isNotNull()),
        horizon,
        params.accrual_range,
        F.col("bill_sdt"),
        F.col("bill_edt"),
    )
    return _measured_actuals(billed)


def _measured_actuals(billed: DataFrame) -> DataFrame:
    days = overlap_days(*(F.col(c) for c in ("mth_sdt", "mth_edt", "bill_sdt", "bill_edt")))
    volume = daily_volume(F.col("solar_zr"), F.col("daily_unit_quantity"), F.col("daily_unit_quantity_zr"))
    measured = billed.withColumn("total_days", days).withColumn(
        "measure", measure_dispatch(F.col("measure_code"), F.col("total_days"), volume, _guarded_money())
    )
    return _labelled(measured, "Actual")


def existing_accruals(core: DataFrame, profile: DataFrame, horizon: DataFrame, params: RunParams, bucketed: bool = False) -> DataFrame:
    """Unbilled days after the latest bill, volumes scaled by season.

    A ``core`` that is ``bucketed`` by account is read once and not exchanged.
    Any other is read twice, so it should be written first.
    """
    find = latest_in_buckets if bucketed else latest_by_maxima
    latest = (
        find(core, "seq_product_item_id", "bill_sdt", "bill_edt")
        .filter(F.col("bill_edt") <= F.lit(params.period_end))
        .drop("trans_description")
        .withColumnRenamed("ex_charge_desc", "trans_description")
    )
    charge = ["solar_zr", "cntrl_load", "trans_description", "measure_name", "measure_code"]
    billed_month = profile.select("record_hash", *charge, F.col("avg_daily_unit_quantity").alias("billed_average"))
    accrued_month = profile.select(
        "mth_no",
        "market_sub_region",
        "fuel_type",
        "market_region",
        "customer_segment",
        *charge,
        F.col("avg_daily_unit_quantity").alias("month_average"),
    )
    daily = latest.join(billed_month, ["record_hash", *charge], "left").withColumn(
        "billed_average", F.coalesce("billed_average", "daily_unit_quantity")
    )
    open_months = overlap_explode(
        daily, horizon, params.accrual_range, F.greatest("service_sdt", "bill_edt"), F.col("service_edt")
    )
    days = open_period_days(*(F.col(c) for c in ("mth_sdt", "mth_edt", "service_edt", "bill_edt")))
    dated = open_months.withColumn("total_days", days).filter("total_days > 0")
    seasonal = dated.join(
        accrued_month,
        ["mth_no", "market_sub_region", "fuel_type", "market_region", "customer_segment", *charge],
        "left",
    )
    volume = daily_volume(F.col("solar_zr"), F.col("daily_unit_quantity"), F.col("daily_unit_quantity_zr"))
    guarded = seasonal.withColumns(_guarded_money())
    measured = guarded.withColumn(
        "measure",
        measure_dispatch(
            F.col("measure_code"),
            F.col("total_days"),
            seasonal_scale(F.col("month_average"), F.col("billed_average"), volume),
            {column: F.col(column) for column in MONEY_COLUMNS},
        ),
    )
    # Charge texts merge in cleaning and a charge can carry two units: only this distinct can drop rows.
    return _labelled(measured, "Accrual (Existing)").distinct()


def never_billed_accruals(
    months: DataFrame, profile: DataFrame, rows_per_salt: int = ROWS_PER_SALT, partitions: int | None = None
) -> DataFrame:
    """Segment averages for accounts without any bill; bill dates are the text ``NULL``.

    Each account month turns into one row per charge of its segment. The months
    are few and the result is large, so the join is salted by the counted size
    of each segment's share of it. With distinct months and one profile row per charge
    the result has no repeated rows, unless two segments give the same joined key
    text, which takes names that start with digits.
    """
    owners = months.select(
        "record_hash", "seq_product_item_id", "mth_sdt", "mth_edt", "service_sdt", "service_edt"
    ).distinct()
    charges = profile.filter(~F.col("trans_description").like("%Import%"))
    spread_by = ["seq_product_item_id", "mth_sdt"]
    charged = salted_join(owners, charges, ["record_hash"], spread_by, rows_per_salt, partitions)
    days = overlap_days(*(F.col(c) for c in ("mth_sdt", "mth_edt", "service_sdt", "service_edt")))

    def rate(column: str, zero_rated: Column) -> Column:
        return imputed_rate(
            F.col("solar_zr"), F.col("account_number_count"), F.col("record_count"), F.col(f"avg_{column}"), zero_rated
        )

    measure = measure_dispatch(
        F.col("measure_code"),
        F.col("total_days"),
        rate("daily_unit_quantity", F.col("avg_daily_unit_quantity_zr")),
        {column: rate(column, zero_rate()) for column in MONEY_COLUMNS},
    )
    daily = ("daily_amt", "daily_unit_quantity", "daily_unit_quantity_zr", "daily_disc_amt", "daily_ppd_amt", "daily_elig_ppd_amt")
    measured = (
        charged.withColumn("total_days", days)
        .filter("total_days > 0")
        .withColumn("measure", measure)
        .withColumns({column: F.col(f"avg_{column}") for column in daily})
        .withColumns({"bill_sdt": F.lit("NULL"), "bill_edt": F.lit("NULL")})
    )
    return _labelled(measured, "Accrual (Never Billed)")
