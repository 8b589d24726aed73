"""Accrual rules, data tests and sinks on the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.checks.basics import BILLS_SQL, bills
from tallygrid.checks.mart_sql import half_up, measure20, number, per_day, scaled
from tallygrid.checks.marts import sources
from tallygrid.checks.registry import Book, Tables
from tallygrid.functions import calendar, discounts
from tallygrid.functions.measures import MONEY_COLUMNS, imputed_rate, measure_dispatch, seasonal_scale, unless_zero_rated
from tallygrid.functions.numeric import per_day as daily_share, zero_rate
from tallygrid.operators import quality
from tallygrid.operators.horizons import trailing_horizon
from tallygrid.operators.overlaps import overlap_explode
from tallygrid.operators.profiles import segment_profile
from tallygrid.plans.results import run_stamp, with_service_counts
from tallygrid.session import fresh_path
from tallygrid.sinks import tables as sinks
from tallygrid.sources.testtables import TEST_RUN, order_calendar

# Bills relabelled as charges, one code per status and priority.
_STATUS_CODES = {"O": "DIS_SUPPLY", "F": "EPPD", "P": "PPD_SUPPLY"}

_DAILY_SQL = f"""
SELECT *, {per_day(scaled('price', 9), 'n_days')} AS rate15,
       CASE o_orderstatus WHEN 'O' THEN 'DIS_SUPPLY' WHEN 'F' THEN 'EPPD' ELSE 'PPD_SUPPLY' END AS status_code
FROM (SELECT *, CAST(datediff('day', bill_sdt, bill_edt) + 1 AS INTEGER) AS n_days FROM bills)"""

_SEASONAL_SQL = """
SELECT d.*, s.mth_no, o_orderstatus AS fuel_type, r_name AS market_region, 'MM' AS market_segment, c_mktsegment AS customer_segment,
       n_name AS market_sub_region
FROM daily_bills d JOIN season s ON bill_sdt <= s.mth_edt AND bill_edt >= s.mth_sdt
JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"""

_SEG = "fuel_type, market_region, market_segment, customer_segment, market_sub_region"
_HASH = "md5(CAST(mth_no AS VARCHAR) || market_sub_region || fuel_type || market_region || customer_segment)"
_PROFILE_SQL = f"""
SELECT f.*, record_count FROM (
  SELECT {_SEG}, o_orderpriority, mth_no, {_HASH} AS record_hash, {half_up('sum(rate15)', '(count(rate15) * 10000000000)')} AS mean5,
         count(DISTINCT o_custkey) AS account_number_count
  FROM seasonal_bills GROUP BY {_SEG}, o_orderpriority, mth_no) f
JOIN (SELECT {_HASH} AS h, count(DISTINCT o_custkey) AS record_count FROM seasonal_bills GROUP BY {_SEG}, mth_no) ON h = record_hash"""

book = Book({
    "bills": BILLS_SQL,
    "daily_bills": _DAILY_SQL,
    "seasonal_bills": _SEASONAL_SQL,
    "bill_profile": _PROFILE_SQL,
})


def daily_bills(t: Tables) -> DataFrame:
    days = calendar.inclusive_days(F.col("bill_sdt"), F.col("bill_edt"))
    code = F.create_map(*[F.lit(part) for item in _STATUS_CODES.items() for part in item])[F.col("o_orderstatus")]
    return bills(t).select("*", daily_share(F.col("price"), days).alias("daily_amt"), code.alias("status_code"))


@book.add(
    "daily_discount",
    f"""SELECT o_orderkey, {number("CASE WHEN n_days > 1 AND status_code LIKE 'DIS%' THEN rate15 END", 15)} AS daily_disc_amt,
        {number("CASE WHEN n_days > 1 AND status_code LIKE 'EPPD%' THEN -rate15 END", 15)} AS daily_elig_ppd_amt,
        {number("CASE WHEN n_days > 1 AND status_code LIKE 'PPD%' THEN -rate15 END", 15)} AS daily_ppd_amt FROM daily_bills""",
)
def _(t: Tables) -> DataFrame:
    parts = F.col("price"), F.col("bill_sdt"), F.col("bill_edt")
    code = F.col("status_code")
    return daily_bills(t).select(
        "o_orderkey",
        discounts.daily_discount(code, "DIS%", 1, *parts).alias("daily_disc_amt"),
        discounts.daily_discount(code, "EPPD%", -1, *parts).alias("daily_elig_ppd_amt"),
        discounts.daily_discount(code, "PPD%", -1, *parts).alias("daily_ppd_amt"),
    )


_CODES = ("DAY_SUPPLY", "VOL_PEAK", "DIS", "PPD", "EPPD", "REV_PEAK")
_CODE_LIST = ", ".join(f"'{c}'" for c in _CODES)


@book.add(
    "measure_dispatch",
    f"""SELECT o_orderkey, measure_code, {number('m20', 20)} AS measure FROM (
          SELECT *, {measure20('rate15', "CASE zr WHEN 'Y' THEN 0 ELSE rate15 END")} AS m20 FROM (
            SELECT *, n_days AS total_days, [{_CODE_LIST}][1 + CAST(o_orderkey % 6 AS INTEGER)] AS measure_code,
                   CASE WHEN o_orderstatus = 'P' THEN 'Y' ELSE 'N' END AS zr FROM daily_bills))""",
)
def _(t: Tables) -> DataFrame:
    code = F.element_at(F.array(*[F.lit(c) for c in _CODES]), (F.col("o_orderkey") % 6 + 1).cast("int"))
    flag = F.when(F.col("o_orderstatus") == "P", "Y").otherwise("N")
    money = {column: unless_zero_rated(F.col("zr"), F.col("daily_amt")) for column in MONEY_COLUMNS}
    rows = daily_bills(t).withColumns({"measure_code": code, "zr": flag})
    days = calendar.inclusive_days(F.col("bill_sdt"), F.col("bill_edt"))
    measure = measure_dispatch(F.col("measure_code"), days, F.col("daily_amt"), money)
    return rows.select("o_orderkey", "measure_code", measure.alias("measure"))


def _segments(t: Tables) -> DataFrame:
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("seq_product_item_id"),
            F.col("r_name").alias("market_region"),
            F.lit("MM").alias("market_segment"),
            F.col("c_mktsegment").alias("customer_segment"),
            F.col("n_name").alias("market_sub_region"),
        )
    )


def bill_profile(t: Tables) -> DataFrame:
    horizon = trailing_horizon(order_calendar(t.orders), TEST_RUN)
    rows = daily_bills(t).join(_segments(t), F.col("o_custkey") == F.col("seq_product_item_id"))
    monthly = overlap_explode(
        rows.withColumnRenamed("o_orderstatus", "fuel_type"), horizon, TEST_RUN.seasonal_range, F.col("bill_sdt"), F.col("bill_edt")
    )
    return segment_profile(monthly, averaged=("daily_amt",), charge=("o_orderpriority",))


@book.add("segment_profile", f"SELECT * EXCLUDE (mean5), {number('mean5', 5)} AS avg_daily_amt FROM bill_profile")
def _(t: Tables) -> DataFrame:
    return bill_profile(t)


_FACTOR13 = f"CASE WHEN a.mean5 IS NULL THEN 10000000000000 ELSE {half_up('(a.mean5 * 1000000000000000000)', 'b.billed10')} END"
_PROFILE_ON = """fuel_type = o_orderstatus AND {p}.market_region = r_name AND {p}.customer_segment = c_mktsegment
       AND {p}.market_sub_region = n_name AND {p}.o_orderpriority = {b}.o_orderpriority AND {p}.mth_no = {m}"""


@book.add(
    "seasonal_scale",
    f"""SELECT o_orderkey, {number(f"({half_up('(factor13 * rate15)', 10 ** 14)} * 10)", 15)} AS scaled_amt FROM (
          SELECT b.o_orderkey, b.rate15, {_FACTOR13} AS factor13 FROM (
            SELECT d.*, r_name, c_mktsegment, n_name,
                   CASE WHEN p.mean5 IS NULL THEN {half_up('d.rate15', 100000)} ELSE p.mean5 * 100000 END AS billed10
            FROM daily_bills d JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
            JOIN region ON r_regionkey = n_regionkey
            LEFT JOIN bill_profile p ON p.{_PROFILE_ON.format(p='p', b='d', m='month(bill_edt)')}) b
          LEFT JOIN bill_profile a ON a.{_PROFILE_ON.format(p='a', b='b', m='month(bill_edt + 31)')})""",
)
def _(t: Tables) -> DataFrame:
    """Scale each bill from its own month to the month 31 days later."""
    keys = ["market_region", "customer_segment", "market_sub_region", "fuel_type", "o_orderpriority"]
    profile = bill_profile(t).select(*keys, "mth_no", "avg_daily_amt")
    rows = (
        daily_bills(t)
        .join(_segments(t), F.col("o_custkey") == F.col("seq_product_item_id"))
        .withColumnRenamed("o_orderstatus", "fuel_type")
        .withColumns({"billed_month": F.month("bill_edt"), "next_month": F.month(F.date_add("bill_edt", 31))})
    )
    billed = profile.withColumnsRenamed({"mth_no": "billed_month", "avg_daily_amt": "billed"})
    ahead = profile.withColumnsRenamed({"mth_no": "next_month", "avg_daily_amt": "ahead"})
    both = rows.join(billed, [*keys, "billed_month"], "left").join(ahead, [*keys, "next_month"], "left")
    value = seasonal_scale(F.col("ahead"), F.coalesce("billed", "daily_amt"), F.col("daily_amt"))
    return both.select("o_orderkey", value.alias("scaled_amt"))


_SHARE15 = half_up(half_up("(account_number_count * CAST(10000000000000000000 AS HUGEINT))", "record_count"), 10000)


@book.add(
    "impute_never_billed",
    f"""SELECT {_SEG}, o_orderpriority, mth_no,
        {number(f"CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE {half_up(half_up('(share15 * mean5)', 1000), 100)} END", 15)} AS imputed
        FROM (SELECT *, {_SHARE15} AS share15 FROM bill_profile)""",
)
def _(t: Tables) -> DataFrame:
    flag = F.when(F.col("o_orderpriority") == "5-LOW", "Y").otherwise("N")
    rate = imputed_rate(
        flag, F.col("account_number_count"), F.col("record_count"), F.col("avg_daily_amt"), zero_rate()
    )
    return bill_profile(t).select(
        *[c.strip() for c in _SEG.split(",")], "o_orderpriority", "mth_no", rate.alias("imputed")
    )


@book.add(
    "union_derived",
    f"""SELECT 25 AS unbilled_accrual_run_audit_id, '{TEST_RUN.period_end_text}' AS unbilled_accrual_period_end_date, 'Core' AS data_source,
        name AS measure_name, code AS measure_code, unit AS measure_unit, n_name, CAST(amount AS DOUBLE) AS measure_value, n AS service_count
        FROM (SELECT n_name, o_orderstatus AS name, CASE o_orderstatus WHEN 'O' THEN 'DAY_SUPPLY' ELSE 'REV_SUPPLY' END AS code, '$' AS unit,
                     sum(price) AS amount, count(o_custkey) AS n
              FROM bills JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL
              UNION ALL
              SELECT n_name, 'Service Count', 'SERVICES', 'Meters', count(o_custkey), count(o_custkey)
              FROM bills JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE o_orderstatus = 'O' GROUP BY ALL)""",
)
def _(t: Tables) -> DataFrame:
    code = F.when(F.col("o_orderstatus") == "O", "DAY_SUPPLY").otherwise("REV_SUPPLY")
    totals = (
        bills(t)
        .join(_segments(t), F.col("o_custkey") == F.col("seq_product_item_id"))
        .groupBy(F.col("market_sub_region").alias("n_name"), F.col("o_orderstatus").alias("measure_name"), code.alias("measure_code"))
        .agg(F.sum("price").alias("measure_value"), F.count("o_custkey").alias("service_count"))
        .select(
            "*",
            F.lit("$").alias("measure_unit"),
            F.lit("Core").alias("data_source"),
            F.lit(TEST_RUN.request_id).alias("unbilled_accrual_run_audit_id"),
            F.lit(TEST_RUN.period_end_text).alias("unbilled_accrual_period_end_date"),
        )
    )
    return with_service_counts(totals, TEST_RUN)


@book.add(
    "dq_unique",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def _(t: Tables) -> DataFrame:
    return quality.unique(t.lineitem, "l_orderkey", "l_linenumber")


@book.add("dq_not_null", "SELECT id, type FROM invoice WHERE rev_invoice_id IS NULL")
def _(t: Tables) -> DataFrame:
    return quality.not_null(sources(t.spark, t.sf_dir).invoice, "rev_invoice_id").select("id", "type")


@book.add(
    "dq_accepted_values",
    "SELECT o_orderpriority AS value_field, count(*) AS n_records FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY ALL",
)
def _(t: Tables) -> DataFrame:
    return quality.accepted_values(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])


@book.add("dq_custom_query", "SELECT count(*) AS n_rows FROM orders WHERE o_orderstatus = 'P'")
def _(t: Tables) -> DataFrame:
    return quality.custom_query(
        t.orders, lambda rows: rows.filter("o_orderstatus = 'P'").agg(F.count(F.lit(1)).alias("n_rows"))
    )


def _totals(t: Tables) -> DataFrame:
    return bills(t).groupBy("o_custkey", "o_orderstatus").agg(F.sum("price").alias("amount"))


_TOTALS_SQL = "SELECT o_custkey, o_orderstatus, CAST(sum(price) AS DOUBLE) AS amount FROM bills GROUP BY o_custkey, o_orderstatus"


def _name(kind: str) -> str:
    return f"tallygrid_{kind}_{uuid.uuid4().hex[:12]}"


@book.add("sink_overwrite", _TOTALS_SQL)
def _(t: Tables) -> DataFrame:
    """The second write replaces the first."""
    name, path = _name("overwrite"), fresh_path(t.spark, "overwrite")
    sinks.overwrite_table(_totals(t).filter("amount > 100000"), name, path=path)
    return sinks.overwrite_table(_totals(t), name, path=path)


@book.add("sink_view", f"SELECT * FROM ({_TOTALS_SQL}) WHERE o_orderstatus = 'F'")
def _(t: Tables) -> DataFrame:
    return sinks.stored_view(_totals(t), _name("view")).filter("o_orderstatus = 'F'")


@book.add("sink_append", f"SELECT o_custkey, o_orderstatus, amount, count(*) AS copies FROM (SELECT * FROM ({_TOTALS_SQL}) UNION ALL SELECT * FROM ({_TOTALS_SQL})) GROUP BY ALL")
def _(t: Tables) -> DataFrame:
    """Two runs of one id are stored twice."""
    name, path = _name("append"), fresh_path(t.spark, "append")
    for _ in range(2):
        stored = sinks.append_table(_totals(t), name, path=path)
    return stored.groupBy("o_custkey", "o_orderstatus", "amount").agg(F.count(F.lit(1)).alias("copies"))


@book.add("sink_replace_run", f"SELECT *, '025' AS request_id FROM ({_TOTALS_SQL}) UNION ALL SELECT *, '026' FROM ({_TOTALS_SQL}) WHERE o_orderstatus = 'O'")
def _(t: Tables) -> DataFrame:
    """A repeated run id replaces its own rows, an empty run clears its rows, and the other runs stay; ids stay texts."""
    path = fresh_path(t.spark, "replace_run")
    first = _totals(t).withColumn("request_id", F.lit("025"))
    second = _totals(t).filter("o_orderstatus = 'O'").withColumn("request_id", F.lit("026"))
    third = _totals(t).withColumn("request_id", F.lit("027"))
    for run_id, run in (("025", first.filter("amount > 100000")), ("026", second), ("025", first), ("027", third), ("027", third.filter("false"))):
        stored = sinks.replace_run(run, path, "request_id", run_id)
    return stored


@book.add("sink_external_path", _TOTALS_SQL)
def _(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "external")
    sinks.overwrite_table(_totals(t), _name("external"), path=path)
    return t.spark.read.parquet(path)


@book.add("sink_gzip", _TOTALS_SQL)
def _(t: Tables) -> DataFrame:
    return sinks.overwrite_table(_totals(t), _name("gzip"), path=fresh_path(t.spark, "gzip"), codec="gzip")


@book.add("analyze_stats", "SELECT count(*) AS row_count FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders)")
def _(t: Tables) -> DataFrame:
    name = _name("stats")
    sinks.overwrite_table(_totals(t), name, path=fresh_path(t.spark, "stats"))
    counted = sinks.analyze_table(t.spark, name)
    return sinks.row_count(t.spark.table(name)).filter(F.col("row_count") == counted)


@book.add("run_stamp", f"SELECT 'test-run' AS run_id, * FROM ({_TOTALS_SQL})")
def _(t: Tables) -> DataFrame:
    return run_stamp(_totals(t), TEST_RUN.run_id)


@book.add("row_count", "SELECT count(*) AS row_count FROM lineitem")
def _(t: Tables) -> DataFrame:
    return sinks.row_count(t.lineitem)


QUERIES, SQL = book.queries, book.sql
