"""Classification and per-day values of invoice lines."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.functions.calendar import inclusive_days, representative_month
from tallygrid.functions.numeric import per_day, times, zero_rate

# Reported measure per kind of charge, as (label, code suffix).
MEASURES = {
    "consumption": ("Consumption", "CONSUM"),
    "climate": ("Climate Saver", "CLIMAT"),
    "demand": ("Demand", "DEMAND"),
    "supply": ("Supply Charge", "SUPPLY"),
    "solar": ("Solar", "SOLAR"),
    "solar_zero": ("Zero rated solar", "SZR_SO"),
    "controlled": ("Controlled Load Usage", "CONTRO"),
    "anytime": ("Anytime Usage", "ANYTIM"),
    "off_peak": ("Off Peak", "OFFPEA"),
    "peak": ("Peak", "PEAK"),
    "shoulder": ("Shoulder", "SHOULD"),
}
# Time class to kind of charge, used when no earlier rule fits.
TIME_CLASS_KINDS = {"PEAK": "peak", "SHOULDER": "shoulder", "ANYTIME": "anytime", "OFFPEAK": "off_peak"}
CLIMATE_CLASSES = ("SUMMER", "WINTER")
# Texts that never count as a charge.
IGNORED_TEXTS = (
    "Transfer Decrease Cust Balance",
    "Account Adjustment",
    "Unplanned Interruption Adjustment",
    "Over Payment Refund Cheque",
)
IGNORED_PATTERN = "Concession%"
# Plan items, document references and the supply-charge threshold.
RETAIL_USAGE_PLAN = 2
CONTRIBUTION_PLAN = 35
ADJUSTED_PLAN = 36
OPEN_REFERENCES = (0, -1)
SUPPLY_RATE_FLOOR = "0.5"


@dataclass(frozen=True)
class Line:
    """The columns of an invoice line that the rules read."""

    fuel: Column
    region: Column
    plan: Column
    plan_id: Column
    time_class: Column
    display_group: Column
    text: Column
    net: Column
    quantity: Column
    multiplier: Column
    rate: Column
    start: Column
    end: Column


def registry_line() -> Line:
    return Line(
        fuel=F.col("fuel_type"),
        region=F.col("market_region"),
        plan=F.col("plan_item_name"),
        plan_id=F.col("plan_item_type_id"),
        time_class=F.col("time_class_name"),
        display_group=F.col("display_grouping_override"),
        text=F.col("trans_description"),
        net=F.col("net_amount"),
        quantity=F.col("quantity"),
        multiplier=F.col("multiplier"),
        rate=F.col("rate"),
        start=F.col("start_date"),
        end=F.col("end_date"),
    )


def not_reversed(reference: Column) -> Column:
    """A document is open if it has no reversal reference; NULL counts as none."""
    return reference.isin(*OPEN_REFERENCES) | reference.isNull()


def controlled_load_flag(time_class: Column, display_group: Column) -> Column:
    return F.when(time_class.isin(*CLIMATE_CLASSES) | display_group.like("CONTROLLED%"), "Y").otherwise("N")


def zero_rated_solar(line: Line) -> Column:
    return (line.fuel == "ELECTRICITY") & (line.display_group == "SOLAR") & (line.net == 0)


def zero_rated_flag(line: Line) -> Column:
    return F.when(zero_rated_solar(line), "Y").otherwise("N")


def counts_as_charge(line: Line) -> Column:
    kept = reduce(lambda acc, text: acc & (line.text != text), IGNORED_TEXTS, ~line.text.like(IGNORED_PATTERN))
    return kept & (F.coalesce(line.quantity, F.lit(0)) != 0)


def counts_as_volume(line: Line) -> Column:
    """Electricity supply lines below the rate floor are second meters and carry no billing days."""
    supply = line.plan == "DAILY_RETAIL"
    electricity = (line.fuel == "ELECTRICITY") & (line.rate >= F.lit(SUPPLY_RATE_FLOOR).cast("decimal(18,6)"))
    return (supply & (electricity | (line.fuel == "GAS"))) | (line.plan != "DAILY_RETAIL")


def _first(*rules: tuple[str, Column]) -> Column:
    (kind, test), *rest = rules
    return reduce(lambda chain, rule: chain.when(rule[1], rule[0]), rest, F.when(test, kind))


def leading_kind(line: Line) -> Column:
    """Kind of charge by the rules volume and revenue start with."""
    return _first(
        ("consumption", (line.fuel == "GAS") & (line.plan != "DAILY_RETAIL")),
        ("climate", line.time_class.isin(*CLIMATE_CLASSES)),
        ("demand", (line.plan == "DEMAND_RETAIL") | F.upper(line.text).like("%DEMAND%")),
        ("supply", line.plan == "DAILY_RETAIL"),
    )


def trailing_kind(line: Line) -> Column:
    """Kind of charge by text and time class, as the codes see it."""
    return _first(
        ("anytime", line.text.like("Any Time Usage%")),
        ("off_peak", line.text.like("%Off Peak%")),
        *[(kind, line.time_class == name) for name, kind in TIME_CLASS_KINDS.items()],
    )


def _label_kind(line: Line, trailing: Column) -> Column:
    """Labels find the any-time text anywhere, codes only at the start."""
    return F.when(line.text.like("%Any Time Usage%"), "anytime").otherwise(trailing)


def _volume_kind(line: Line, leading: Column, trailing: Column) -> Column:
    solar = line.display_group == "SOLAR"
    middle = _first(
        ("solar", solar & (line.net != 0)),
        ("solar_zero", solar & (line.net == 0)),
        ("controlled", line.display_group == "CONTROLLED"),
    )
    return F.coalesce(leading, middle, trailing)


def _revenue_kind(line: Line, leading: Column, trailing: Column) -> Column:
    middle = _first(
        ("solar", (line.display_group == "SOLAR") | (line.plan == "CONTRIBUTION")),
        ("controlled", line.display_group == "CONTROLLED"),
    )
    return F.coalesce(leading, middle, trailing)


def _lookup(texts: dict[str, str], kind: Column) -> Column:
    return F.create_map(*[F.lit(part) for item in texts.items() for part in item])[kind]


def volume_name(line: Line, leading: Column, trailing: Column) -> Column:
    names = {kind: f"Volume - {label}" for kind, (label, _) in MEASURES.items()}
    names["supply"] = "Billing Days - Supply Charge"
    return _lookup(names, _volume_kind(line, leading, _label_kind(line, trailing)))


def volume_code(line: Line, leading: Column, trailing: Column) -> Column:
    codes = {kind: f"VOL_{suffix}" for kind, (_, suffix) in MEASURES.items()}
    codes["supply"] = "DAY_SUPPLY"
    return _lookup(codes, _volume_kind(line, leading, trailing))


def volume_unit(line: Line) -> Column:
    return (
        F.when(line.plan == "DAILY_RETAIL", "DAY")
        .when(line.plan == "DEMAND_RETAIL", "MVA")
        .when((line.fuel == "GAS") & line.plan.isNotNull(), "GJ")
        .otherwise("MWh")
    )


def revenue_name(line: Line, leading: Column, trailing: Column) -> Column:
    names = {kind: f"Revenue - {label}" for kind, (label, _) in MEASURES.items()}
    return _lookup(names, _revenue_kind(line, leading, _label_kind(line, trailing)))


def revenue_code(line: Line, leading: Column, trailing: Column) -> Column:
    codes = {kind: f"REV_{suffix}" for kind, (_, suffix) in MEASURES.items()}
    return _lookup(codes, _revenue_kind(line, leading, trailing))


def daily_rate(line: Line) -> Column:
    """Quantity per billed day; a period of one day divides by one."""
    return per_day(line.quantity * line.multiplier, inclusive_days(line.start, line.end))


def _magnitude(line: Line, rate: Column) -> Column:
    contribution = (line.region == "SA") & (line.plan_id == CONTRIBUTION_PLAN)
    return F.abs(F.when(contribution, zero_rate()).otherwise(rate))


def signed_quantity(line: Line, rate: Column) -> Column:
    """Daily quantity with the sign of the net amount."""
    return times(_magnitude(line, rate), F.signum(line.net).cast("decimal(1,0)"))


def zero_rated_quantity(line: Line, rate: Column) -> Column:
    return F.when(zero_rated_solar(line), -_magnitude(line, rate)).otherwise(zero_rate())


def daily_amount(line: Line, rate: Column) -> Column:
    return times(rate, line.rate.cast("decimal(18,6)"))


def with_charge_parts(lines: DataFrame) -> DataFrame:
    """Add the columns several measures of one line are computed from.

    As columns they are evaluated once, and the generated code stays in methods
    small enough to be compiled.
    """
    line = registry_line()
    return lines.select(
        "*",
        leading_kind(line).alias("leading_kind"),
        trailing_kind(line).alias("trailing_kind"),
        daily_rate(line).alias("line_rate"),
        zero_rated_flag(line).alias("solar_zr"),
        representative_month(line.start, line.end).alias("rmp_mth_no"),
    )


def volume_measures(line: Line) -> list[Column]:
    """Measures of a line that went through :func:`with_charge_parts`."""
    kinds = F.col("leading_kind"), F.col("trailing_kind")
    return [
        volume_name(line, *kinds).alias("measure_name"),
        volume_code(line, *kinds).alias("measure_code"),
        volume_unit(line).alias("measure_unit"),
        signed_quantity(line, F.col("line_rate")).alias("daily_unit_quantity"),
        zero_rated_quantity(line, F.col("line_rate")).alias("daily_unit_quantity_zr"),
    ]


def revenue_measures(line: Line) -> list[Column]:
    kinds = F.col("leading_kind"), F.col("trailing_kind")
    return [
        revenue_name(line, *kinds).alias("measure_name"),
        revenue_code(line, *kinds).alias("measure_code"),
        F.lit("$").alias("measure_unit"),
        daily_amount(line, F.col("line_rate")).alias("daily_amt"),
    ]
