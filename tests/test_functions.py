"""Column functions on hand-computed rows."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.errors import ArithmeticException, NumberFormatException
from pyspark.sql import functions as F

from tallygrid.functions import calendar, charges, discounts, measures, numeric
from tallygrid.functions.keys import segment_hash
from tallygrid.functions.text import charge_description, clean_description

D = dt.date


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def day(y, m, d):
    return F.lit(D(y, m, d))


@pytest.mark.parametrize(
    ("start", "end", "month"),
    [(D(2001, 1, 1), D(2001, 1, 1), 1), (D(2001, 1, 15), D(2001, 2, 13), 2), (D(2000, 12, 31), D(2001, 1, 1), 1)],
)
def test_representative_month_is_two_thirds_in(spark, start, end, month):
    assert one(spark, calendar.representative_month(F.lit(start), F.lit(end)))[0] == month


def test_open_dates_fall_back_to_sentinels(spark):
    empty = F.lit(None).cast("date")
    assert tuple(one(spark, calendar.service_start(empty), calendar.service_end(empty))) == (D(1900, 1, 1), D(9999, 12, 31))


def ladder(mth_sdt, mth_edt, service_sdt, service_edt, bill_edt):
    """Unbilled days by cases: bill before or inside the month, service beyond or ending in it."""
    if service_edt < mth_sdt or service_sdt > mth_edt:
        return None
    begin = mth_sdt if bill_edt < mth_sdt else bill_edt + dt.timedelta(days=1)
    end = mth_edt if mth_edt <= service_edt else service_edt
    return (end - begin).days + 1


def test_open_period_days_equals_the_case_ladder(spark):
    rng = random.Random(7)
    rows = []
    while len(rows) < 3000:
        mth_sdt = D(2000, rng.randint(1, 12), 1)
        mth_edt = (mth_sdt + dt.timedelta(days=40)).replace(day=1) - dt.timedelta(days=1)
        service_sdt = mth_sdt + dt.timedelta(days=rng.randint(-80, 40))
        service_edt = mth_sdt + dt.timedelta(days=rng.randint(-10, 80))
        bill_edt = mth_sdt + dt.timedelta(days=rng.randint(-60, 35))
        if service_sdt <= mth_edt and service_edt >= mth_sdt and bill_edt <= mth_edt:
            expected = ladder(mth_sdt, mth_edt, service_sdt, service_edt, bill_edt)
            rows.append((mth_sdt, mth_edt, service_edt, bill_edt, expected))
    frame = spark.createDataFrame(rows, "m1 date, m2 date, s date, b date, expected int")
    days = calendar.open_period_days(*(F.col(c) for c in ("m1", "m2", "s", "b")))
    assert frame.filter(~days.eqNullSafe(F.col("expected"))).count() == 0


def test_daily_rate_keeps_fifteen_digits(spark):
    value = one(spark, numeric.per_day(F.lit("100").cast("decimal(18,4)"), F.lit(3)))[0]
    assert value == Decimal("33.333333333333333")


def test_zero_divisor_of_the_season_is_null(spark):
    zero, one_ = F.lit(0).cast("decimal(20,5)"), F.lit(1).cast("decimal(20,5)")
    assert one(spark, numeric.ratio(one_, zero))[0] is None
    with pytest.raises(ArithmeticException):
        one(spark, one_ / zero)


def test_seasonal_scale(spark):
    five, null = F.lit(5).cast("decimal(20,5)"), F.lit(None).cast("decimal(20,5)")
    daily = F.lit(3).cast(numeric.RATE)
    scaled = measures.seasonal_scale(five, F.lit(2).cast("decimal(20,5)"), daily)
    kept = measures.seasonal_scale(null, five, daily)
    assert tuple(one(spark, scaled, kept)) == (Decimal("7.5"), Decimal("3"))


def test_seasonal_scale_beyond_the_digits_of_the_factor(spark):
    wide = measures.seasonal_scale(
        F.lit("150000").cast("decimal(20,5)"), F.lit("0.00001").cast("decimal(20,5)"), F.lit("0.5").cast(numeric.RATE)
    )
    tiny = F.lit("0.00000000004").cast(numeric.RATE)
    own = measures.seasonal_scale(F.lit(5).cast("decimal(20,5)"), tiny, tiny)
    none = measures.seasonal_scale(F.lit(5).cast("decimal(20,5)"), F.lit(0).cast(numeric.RATE), tiny)
    got = one(spark, wide, own, none)
    assert (float(got[0]), float(got[1]), got[2]) == (pytest.approx(7.5e9), pytest.approx(5.0), None)


def line(**values):
    base = dict(
        fuel="ELECTRICITY", region="AMERICA", plan="RETAIL_USAGE", plan_id=2, time_class=None, display_group=None,
        text="Usage", net=Decimal("10"), quantity=Decimal("60"), multiplier=Decimal("1"), rate=Decimal("0.6"),
        start=D(2001, 1, 1), end=D(2001, 1, 30),
    ) | values
    types = dict(fuel="string", region="string", plan="string", plan_id="int", time_class="string", display_group="string",
                 text="string", net="decimal(18,4)", quantity="decimal(18,4)", multiplier="decimal(18,4)",
                 rate="decimal(18,6)", start="date", end="date")
    return charges.Line(**{k: F.lit(v).cast(types[k]) for k, v in base.items()})


@pytest.mark.parametrize(
    ("values", "volume", "revenue"),
    [
        (dict(fuel="GAS"), ("Volume - Consumption", "VOL_CONSUM"), ("Revenue - Consumption", "REV_CONSUM")),
        (dict(fuel="GAS", plan=None, time_class="PEAK"), ("Volume - Peak", "VOL_PEAK"), ("Revenue - Peak", "REV_PEAK")),
        (dict(time_class="WINTER", display_group="SOLAR"), ("Volume - Climate Saver", "VOL_CLIMAT"), ("Revenue - Climate Saver", "REV_CLIMAT")),
        (dict(text="Peak demand x"), ("Volume - Demand", "VOL_DEMAND"), ("Revenue - Demand", "REV_DEMAND")),
        (dict(plan="DAILY_RETAIL"), ("Billing Days - Supply Charge", "DAY_SUPPLY"), ("Revenue - Supply Charge", "REV_SUPPLY")),
        (dict(display_group="SOLAR"), ("Volume - Solar", "VOL_SOLAR"), ("Revenue - Solar", "REV_SOLAR")),
        (dict(display_group="SOLAR", net=Decimal(0)), ("Volume - Zero rated solar", "VOL_SZR_SO"), ("Revenue - Solar", "REV_SOLAR")),
        (dict(plan="CONTRIBUTION", time_class="PEAK"), ("Volume - Peak", "VOL_PEAK"), ("Revenue - Solar", "REV_SOLAR")),
        (dict(display_group="CONTROLLED"), ("Volume - Controlled Load Usage", "VOL_CONTRO"), ("Revenue - Controlled Load Usage", "REV_CONTRO")),
        (dict(text="Import Any Time Usage", time_class="SHOULDER"), ("Volume - Anytime Usage", "VOL_SHOULD"), ("Revenue - Anytime Usage", "REV_SHOULD")),
        (dict(text="My Off Peak", time_class="PEAK"), ("Volume - Off Peak", "VOL_OFFPEA"), ("Revenue - Off Peak", "REV_OFFPEA")),
        (dict(time_class="OFFPEAK"), ("Volume - Off Peak", "VOL_OFFPEA"), ("Revenue - Off Peak", "REV_OFFPEA")),
        (dict(), (None, None), (None, None)),
    ],
)
def test_classification_takes_the_first_rule(spark, values, volume, revenue):
    it = line(**values)
    kinds = charges.leading_kind(it), charges.trailing_kind(it)
    got = one(spark, charges.volume_name(it, *kinds), charges.volume_code(it, *kinds),
              charges.revenue_name(it, *kinds), charges.revenue_code(it, *kinds))
    assert tuple(got) == (*volume, *revenue)


@pytest.mark.parametrize(
    ("values", "unit"),
    [(dict(plan="DAILY_RETAIL"), "DAY"), (dict(plan="DEMAND_RETAIL", fuel="GAS"), "MVA"), (dict(fuel="GAS"), "GJ"),
     (dict(fuel="GAS", plan=None), "MWh"), (dict(), "MWh")],
)
def test_volume_unit(spark, values, unit):
    assert one(spark, charges.volume_unit(line(**values)))[0] == unit


@pytest.mark.parametrize(
    ("values", "expected"),
    [(dict(plan="DAILY_RETAIL"), True), (dict(plan="DAILY_RETAIL", rate=Decimal("0.4")), False),
     (dict(plan="DAILY_RETAIL", fuel="GAS", rate=Decimal("0.4")), True), (dict(), True), (dict(plan=None), None)],
)
def test_supply_lines_need_a_rate(spark, values, expected):
    assert one(spark, charges.counts_as_volume(line(**values)))[0] is expected


def test_unlisted_texts_and_null_texts(spark):
    texts = ["Concession x", "Account Adjustment", "Usage", None]
    assert [one(spark, charges.counts_as_charge(line(text=t)))[0] for t in texts] == [False, False, True, None]
    assert one(spark, charges.counts_as_charge(line(quantity=None)))[0] is False


def test_quantity_signs(spark):
    it = line(net=Decimal(-5))
    assert one(spark, charges.signed_quantity(it, charges.daily_rate(it)))[0] == -2
    free = line(region="SA", plan_id=35)
    assert one(spark, charges.signed_quantity(free, charges.daily_rate(free)))[0] == 0
    solar = line(display_group="SOLAR", net=Decimal(0))
    assert one(spark, charges.zero_rated_quantity(solar, charges.daily_rate(solar)))[0] == -2
    same_day = line(end=D(2001, 1, 1))
    assert one(spark, charges.daily_amount(same_day, charges.daily_rate(same_day)))[0] == 36


def test_null_reference_counts_as_open(spark):
    rows = spark.createDataFrame([(0,), (-1,), (None,), (7,)], "r bigint")
    assert [r[0] for r in rows.filter(charges.not_reversed(F.col("r"))).collect()] == [0, -1, None]


@pytest.mark.parametrize(
    ("text", "cleaned", "charge"),
    [
        ("Off Peak - Night", "", "Off Peak - Night"),
        ("Supply Charge (Network)", "Supply Charge", "Daily Charge (Network)"),
        ("Controlled Load Usage - Tariff 31", "Controlled Load Usage - Tariff 31", "Controlled Load Usage - Tariff 31"),
        ("Peak Usage (Block 1) - x", "Usage", "Usage"),
        ("(x) y - z", "(x) y", "(x) y"),
        ("Solar Rebate", "Solar", "Solar"),
        (None, None, None),
    ],
)
def test_charge_texts(spark, text, cleaned, charge):
    raw = F.lit(text).cast("string")
    value = clean_description(raw)
    assert tuple(one(spark, value, charge_description(raw, value))) == (cleaned, charge)


def test_initcap_splits_on_spaces_only(spark):
    assert one(spark, F.initcap(F.lit("OFF-PEAK usage")))[0] == "Off-peak Usage"


def test_hash_is_null_with_a_null_part(spark):
    parts = [F.lit(p).cast("string") for p in ("a", "b", None, "d")]
    assert one(spark, segment_hash(F.lit(1), *parts))[0] is None


def test_tax_is_stripped_only_without_a_tax_amount(spark):
    net, zero = F.lit(Decimal("11.0000")).cast("decimal(18,4)"), F.lit(0).cast("decimal(18,4)")
    got = one(spark, discounts.strip_tax(net, zero), discounts.strip_tax(net, net), discounts.strip_tax(zero, net))
    assert tuple(got) == (Decimal("10"), Decimal("11"), Decimal("0"))


def test_discount_rounding_matches_its_text_on_ties(spark):
    rows = spark.createDataFrame([(Decimal(n) * Decimal("0.00055"),) for n in range(1, 400)], "t decimal(18,5)")
    number = discounts.rounded_discount(F.col("t")).cast("decimal(18,3)").cast("string")
    assert rows.filter(number != discounts.formatted_discount(F.col("t"))).count() == 0


def test_one_day_discount_is_null(spark):
    args = F.lit("DIS"), "DIS%", 1, F.lit(10).cast("decimal(18,4)")
    got = one(
        spark,
        discounts.daily_discount(*args, day(2001, 1, 1), day(2001, 1, 1)),
        discounts.daily_discount(*args, day(2001, 1, 1), day(2001, 1, 2)),
        discounts.daily_discount(F.lit("EPPD"), "PPD%", -1, args[3], day(2001, 1, 1), day(2001, 1, 2)),
    )
    assert tuple(got) == (None, Decimal("5"), None)


def test_measures_follow_their_code(spark):
    rate = F.lit(2).cast(numeric.RATE)
    money = {c: rate * 10 for c in measures.MONEY_COLUMNS}
    got = [
        one(spark, measures.measure_dispatch(F.lit(code), F.lit(31), rate, money))[0]
        for code in ("DAY_SUPPLY", "VOL_X", "DIS", "EPPD_SUPPL", "REV_X", "OTHER")
    ]
    assert got == [31, Decimal("0.062"), 620, 620, 620, None]


def test_zero_rated_rows_earn_nothing(spark):
    rate = F.lit(2).cast(numeric.RATE)
    got = one(spark, measures.unless_zero_rated(F.lit("Y"), rate), measures.unless_zero_rated(F.lit("N"), rate))
    assert tuple(got) == (0, 2)


def test_imputed_rate(spark):
    avg, zr = F.lit(4).cast("decimal(20,5)"), F.lit(-1).cast("decimal(20,5)")
    def rate(flag, n, total):
        return one(spark, measures.imputed_rate(F.lit(flag), F.lit(n), F.lit(total), avg, zr))[0]

    assert (rate("N", 1, 4), rate("N", 1, 0), rate("Y", 1, 4)) == (1, 0, -1)


def test_like_underscore_is_a_wildcard(spark):
    assert one(spark, F.lit("VOLXDEMAND").like("VOL_DEMAND%"))[0] is True


def test_text_plus_number_fails_unless_tried(spark):
    with pytest.raises(NumberFormatException):
        one(spark, F.expr("'1_1' + 2"))
    assert one(spark, F.lit("1_1").try_cast("double") + 2)[0] is None
