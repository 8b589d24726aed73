"""Scans, filters, scalar functions and unions on the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.checks.mart_sql import INITCAP, REP_MONTH, charge_text, cut_text, number, per_day, scaled
from tallygrid.checks.marts import _registry, sources
from tallygrid.checks.registry import Book, Tables
from tallygrid.functions import calendar, charges
from tallygrid.functions.keys import segment_hash
from tallygrid.functions.numeric import per_day as daily_share
from tallygrid.functions.text import charge_description, clean_description
from tallygrid.operators.horizons import month_horizon, trailing_horizon
from tallygrid.operators.scd import scd2_current
from tallygrid.plans import examples
from tallygrid.sources.literals import CHARGE_TEMPLATES, values_sql
from tallygrid.sources.testtables import TEST_RUN, order_calendar, order_day, usage_start

BILLS_SQL = """
SELECT *, CAST(o_orderdate AS DATE) - CAST(o_orderkey % 60 AS INTEGER) AS bill_sdt, CAST(o_orderdate AS DATE) AS bill_edt,
       CAST(o_totalprice AS DECIMAL(18, 2)) AS price FROM orders"""


def bills(t: Tables) -> DataFrame:
    """Orders read as bills: the period ends on the order day and covers up to 60 days."""
    return t.orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        usage_start().alias("bill_sdt"),
        order_day().alias("bill_edt"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
    )


LEAF_SQL = """
SELECT DISTINCT l_linenumber AS leaf, l_partkey AS id FROM lineitem
UNION SELECT 8, l_partkey FROM lineitem WHERE l_returnflag = 'R'
UNION SELECT 9, l_partkey FROM lineitem WHERE l_linestatus = 'O'"""

book = Book({"bills": BILLS_SQL, "part_leaf": LEAF_SQL})


@book.add(
    "scan_project",
    "SELECT l_orderkey AS invoice_id, l_linenumber AS line_no, l_partkey AS item_id, l_quantity AS quantity FROM lineitem",
)
def scan_project(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("invoice_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").alias("quantity"),
    )


_DAYS = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ("date", "first_day_month", "last_day_month"))


@book.add("date_dim", f"SELECT * REPLACE ({_DAYS}) FROM dim_date")
def date_dim(t: Tables) -> DataFrame:
    return order_calendar(t.orders)


_MONTHS = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ("mth_sdt", "mth_edt"))


@book.add("month_horizon", f"SELECT * REPLACE ({_MONTHS}) FROM horizon")
def _(t: Tables) -> DataFrame:
    return month_horizon(order_calendar(t.orders), TEST_RUN)


@book.add("trailing_horizon", f"SELECT * REPLACE ({_MONTHS}) FROM season")
def _(t: Tables) -> DataFrame:
    return trailing_horizon(order_calendar(t.orders), TEST_RUN)


@book.add(
    "literal_rows",
    """SELECT v.id, count(l_orderkey) AS n_lines
       FROM (SELECT 1 AS id UNION ALL SELECT NULL UNION ALL SELECT 2) v LEFT JOIN lineitem ON l_linenumber = v.id GROUP BY v.id""",
)
def literal_rows(t: Tables) -> DataFrame:
    literal = examples.literal_rows(t.spark, [1, None, 2], "int")
    return literal.join(t.lineitem, F.col("l_linenumber") == F.col("id"), "left").groupBy("id").agg(
        F.count("l_orderkey").alias("n_lines")
    )


@book.add(
    "scd2_current",
    """SELECT id, service_type_id, CAST(commence_date AS VARCHAR) AS commence_date, CAST(closed_date AS VARCHAR) AS closed_date
       FROM account WHERE adh_active_flag = 1""",
)
def _(t: Tables) -> DataFrame:
    return scd2_current(sources(t.spark, t.sf_dir).account, "id", "service_type_id", "commence_date", "closed_date")


@book.add(
    "star_plus_hash",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
       o_orderpriority, md5(CAST(o_custkey AS VARCHAR) || o_orderstatus || o_orderpriority) AS record_hash FROM orders""",
)
def _(t: Tables) -> DataFrame:
    key = F.md5(F.concat(F.col("o_custkey").cast("string"), "o_orderstatus", "o_orderpriority"))
    return t.orders.select("*", key.alias("record_hash"))


@book.add(
    "const_columns",
    "SELECT l_orderkey, l_linenumber, l_partkey, 'MM' AS market_segment, 'Core' AS data_source, '$' AS measure_unit FROM lineitem",
)
def _(t: Tables) -> DataFrame:
    constants = {"market_segment": "MM", "data_source": "Core", "measure_unit": "$"}
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", *[F.lit(v).alias(k) for k, v in constants.items()])


@book.add(
    "null_padding_union",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS quantity, CAST(NULL AS DOUBLE) AS amount, CAST(NULL AS VARCHAR) AS meter_id
       FROM lineitem WHERE l_returnflag = 'R'
       UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, NULL, l_extendedprice, NULL FROM lineitem WHERE l_returnflag = 'A'""",
)
def _(t: Tables) -> DataFrame:
    keys = ("l_orderkey", "l_linenumber", "l_partkey")
    volume = t.lineitem.filter("l_returnflag = 'R'").select(*keys, F.col("l_quantity").alias("quantity"))
    money = t.lineitem.filter("l_returnflag = 'A'").select(*keys, F.col("l_extendedprice").alias("amount"))
    padded = volume.unionByName(money, allowMissingColumns=True)
    return padded.withColumn("meter_id", F.lit(None).cast("string"))


@book.add(
    "filter_predicates",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       WHERE o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice BETWEEN 50000 AND 400000
         AND o_orderdate >= DATE '1996-01-01' AND CAST(o_orderdate AS DATE) <= DATE '2000-12-31'""",
)
def _(t: Tables) -> DataFrame:
    return t.orders.filter(
        (F.col("o_orderstatus") == "O")
        & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        & F.col("o_totalprice").between(50000, 400000)
        & (F.col("o_orderdate") >= F.lit(dt.date(1996, 1, 1)))
        & (order_day() <= F.lit(dt.date(2000, 12, 31)))
    ).select("o_orderkey", "o_custkey", "o_totalprice")


@book.add(
    "filter_null_logic",
    """SELECT l_orderkey, l_linenumber, l_partkey, flag, quantity
       FROM (SELECT *, CASE WHEN l_tax <> 0 THEN l_returnflag END AS flag, CASE WHEN l_discount <> 0 THEN l_quantity END AS quantity FROM lineitem)
       WHERE flag <> 'R' AND coalesce(quantity, 0) <> 0 AND NOT (l_linestatus LIKE 'X%') AND quantity IS NOT NULL""",
)
def _(t: Tables) -> DataFrame:
    nullable = t.lineitem.withColumns({
        "flag": F.when(F.col("l_tax") != 0, F.col("l_returnflag")),
        "quantity": F.when(F.col("l_discount") != 0, F.col("l_quantity")),
    })
    kept = nullable.filter(
        (F.col("flag") != "R")
        & (F.coalesce("quantity", F.lit(0)) != 0)
        & ~F.col("l_linestatus").like("X%")
        & F.col("quantity").isNotNull()
    )
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "flag", "quantity")


@book.add(
    "filter_like",
    """SELECT p_partkey, p_name, p_type FROM part
       WHERE (p_name LIKE '%ring%' OR p_type LIKE 'ECO%' OR p_brand LIKE 'Brand_1%') AND p_name NOT LIKE 'red%'""",
)
def _(t: Tables) -> DataFrame:
    name = F.col("p_name")
    found = name.like("%ring%") | F.col("p_type").like("ECO%") | F.col("p_brand").like("Brand_1%")
    return t.part.filter(found & ~name.like("red%")).select("p_partkey", "p_name", "p_type")


@book.add(
    "filter_or_groups",
    """SELECT id, account_id, type FROM invoice
       WHERE (rev_invoice_id = 0 OR rev_invoice_id = -1 OR rev_invoice_id IS NULL)
         AND (type = 'NORMAL' OR (type = 'REVERSAL' AND ppd_adjustment_id = 3))""",
)
def _(t: Tables) -> DataFrame:
    kind, adjustment = F.col("type"), F.col("ppd_adjustment_id")
    return sources(t.spark, t.sf_dir).invoice.filter(
        charges.not_reversed(F.col("rev_invoice_id"))
        & ((kind == "NORMAL") | ((kind == "REVERSAL") & (adjustment == 3)))
    ).select("id", "account_id", "type")


@book.add(
    "case_flag",
    """SELECT id, seq_product_item_id, meter_id, solar_zr, cntrl_load FROM (
         SELECT *, CASE WHEN fuel_type = 'ELECTRICITY' AND display_grouping_override = 'SOLAR' AND net_amount = 0 THEN 'Y' ELSE 'N' END AS solar_zr
         FROM registry)""",
)
def _(t: Tables) -> DataFrame:
    line = charges.registry_line()
    rows = _registry(sources(t.spark, t.sf_dir))
    return rows.select("id", "seq_product_item_id", "meter_id", charges.zero_rated_flag(line).alias("solar_zr"), "cntrl_load")


@book.add(
    "case_classify",
    """SELECT fuel_type, trans_description, solar_zr,
       CASE vol_label_kind WHEN 'supply' THEN 'Billing Days - Supply Charge' ELSE 'Volume - ' || vl.label END AS volume_name,
       CASE vol_code_kind WHEN 'supply' THEN 'DAY_SUPPLY' ELSE 'VOL_' || vc.suffix END AS volume_code,
       'Revenue - ' || rl.label AS revenue_name, 'REV_' || rc.suffix AS revenue_code, count(*) AS n_lines
       FROM charged LEFT JOIN kinds vl ON vl.kind = vol_label_kind LEFT JOIN kinds vc ON vc.kind = vol_code_kind
       LEFT JOIN kinds rl ON rl.kind = rev_label_kind LEFT JOIN kinds rc ON rc.kind = rev_code_kind GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    line = charges.registry_line()
    rows = _registry(sources(t.spark, t.sf_dir)).filter(charges.counts_as_charge(line))
    kinds = F.col("leading_kind"), F.col("trailing_kind")
    return charges.with_charge_parts(rows).groupBy(
        "fuel_type",
        "trans_description",
        "solar_zr",
        charges.volume_name(line, *kinds).alias("volume_name"),
        charges.volume_code(line, *kinds).alias("volume_code"),
        charges.revenue_name(line, *kinds).alias("revenue_name"),
        charges.revenue_code(line, *kinds).alias("revenue_code"),
    ).agg(F.count(F.lit(1)).alias("n_lines"))


@book.add(
    "str_case",
    "SELECT p_partkey, upper(p_name) AS upper_name FROM part WHERE upper(p_name) LIKE '%RING%' OR upper(p_type) LIKE 'ECO%'",
)
def _(t: Tables) -> DataFrame:
    upper = F.upper("p_name")
    return t.part.filter(upper.like("%RING%") | F.upper("p_type").like("ECO%")).select("p_partkey", upper.alias("upper_name"))


@book.add("str_initcap", f"SELECT DISTINCT description, {INITCAP.format(t='description')} AS trans_description FROM line")
def _(t: Tables) -> DataFrame:
    lines = sources(t.spark, t.sf_dir).invoicelineitem.filter("billable = 1 AND adh_active_flag = 1")
    return lines.select("description", F.initcap("description").alias("trans_description")).distinct()


_RAW = "trim(description || ' ' || o_orderpriority)"


@book.add(
    "str_clean",
    f"""SELECT o_orderkey, l_linenumber, l_partkey, raw, cleaned, {charge_text('raw', 'cleaned')} AS charge FROM (
        SELECT *, {cut_text('raw')} AS cleaned FROM (
          SELECT o_orderkey, l_linenumber, l_partkey, {_RAW} AS raw FROM lineitem JOIN orders ON o_orderkey = l_orderkey
          JOIN template ON line_number = l_linenumber AND variant = l_partkey % 3))""",
)
def _(t: Tables) -> DataFrame:
    template = t.spark.sql(values_sql(CHARGE_TEMPLATES))
    texts = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(template, (F.col("l_linenumber") == F.col("line_number")) & (F.col("l_partkey") % 3 == F.col("variant")))
        .select(
            "o_orderkey", "l_linenumber", "l_partkey", F.trim(F.concat_ws(" ", "description", "o_orderpriority")).alias("raw")
        )
    )
    cleaned = texts.withColumn("cleaned", clean_description(F.col("raw")))
    return cleaned.withColumn("charge", charge_description(F.col("raw"), F.col("cleaned")))


@book.add(
    "hash_key",
    """SELECT c_custkey, md5(CAST(month(DATE '1995-01-01' + CAST(c_custkey % 365 AS INTEGER)) AS VARCHAR) || n_name
              || CASE WHEN c_acctbal > 5000 THEN c_mktsegment END || r_name || c_mktsegment) AS record_hash
       FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
)
def _(t: Tables) -> DataFrame:
    day = F.date_add(F.lit(dt.date(1995, 1, 1)), (F.col("c_custkey") % 365).cast("int"))
    fuel = F.when(F.col("c_acctbal") > 5000, F.col("c_mktsegment"))
    key = segment_hash(F.month(day), F.col("n_name"), fuel, F.col("r_name"), F.col("c_mktsegment"))
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", key.alias("record_hash"))
    )


@book.add(
    "math_signed_qty",
    f"""SELECT id, meter_id, {number('CASE WHEN unmetered THEN 0 ELSE abs(rate15) END * CAST(sign(net_amount) AS INTEGER)', 15)} AS daily_unit_quantity,
        {number("CASE WHEN solar_zr = 'N' OR unmetered THEN 0 ELSE -abs(rate15) END", 15)} AS daily_unit_quantity_zr
        FROM charged""",
)
def _(t: Tables) -> DataFrame:
    line, rate = charges.registry_line(), F.col("line_rate")
    rows = _registry(sources(t.spark, t.sf_dir)).filter(charges.counts_as_charge(line))
    return charges.with_charge_parts(rows).select(
        "id",
        "meter_id",
        charges.signed_quantity(line, rate).alias("daily_unit_quantity"),
        charges.zero_rated_quantity(line, rate).alias("daily_unit_quantity_zr"),
    )


@book.add(
    "math_daily_rate",
    f"SELECT o_orderkey, {number('rate', 15)} AS daily_rate FROM "
    f"(SELECT o_orderkey, {per_day(scaled('price', 9), 'n_days')} AS rate FROM "
    "(SELECT o_orderkey, price, datediff('day', bill_sdt, bill_edt) + 1 AS n_days FROM bills))",
)
def _(t: Tables) -> DataFrame:
    days = calendar.inclusive_days(F.col("bill_sdt"), F.col("bill_edt"))
    return bills(t).select("o_orderkey", daily_share(F.col("price"), days).alias("daily_rate"))


@book.add("rep_month", f"SELECT o_orderkey, {REP_MONTH.format(s='bill_sdt', e='bill_edt')} AS rmp_mth_no FROM bills")
def _(t: Tables) -> DataFrame:
    return bills(t).select(
        "o_orderkey", calendar.representative_month(F.col("bill_sdt"), F.col("bill_edt")).alias("rmp_mth_no")
    )


@book.add(
    "date_span",
    """SELECT o_orderkey, CAST(datediff('day', bill_sdt, bill_edt) + 1 AS INTEGER) AS billing_days,
       CASE WHEN bill_edt = bill_sdt THEN 'Y' ELSE 'N' END AS one_day FROM bills""",
)
def _(t: Tables) -> DataFrame:
    start, end = F.col("bill_sdt"), F.col("bill_edt")
    return bills(t).select(
        "o_orderkey",
        calendar.inclusive_days(start, end).alias("billing_days"),
        F.when(F.datediff(end, start) == 0, "Y").otherwise("N").alias("one_day"),
    )


@book.add(
    "date_arith",
    """SELECT o_orderkey, CAST(bill_edt + 5 AS VARCHAR) AS posted, CAST(CAST(bill_edt - INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS month_before,
       CAST(last_day(bill_edt) AS VARCHAR) AS month_end, CAST(day(last_day(bill_edt)) AS INTEGER) AS month_days,
       CAST(last_day(CAST(bill_edt - INTERVAL 1 MONTH AS DATE)) + 1 AS VARCHAR) AS month_start FROM bills""",
)
def _(t: Tables) -> DataFrame:
    day = F.col("bill_edt")
    before = F.add_months(day, -1)
    return bills(t).select(
        "o_orderkey",
        F.date_add(day, 5).alias("posted"),
        before.alias("month_before"),
        F.last_day(day).alias("month_end"),
        F.dayofmonth(F.last_day(day)).alias("month_days"),
        F.date_add(F.last_day(before), 1).alias("month_start"),
    )


@book.add(
    "coalesce_default",
    """SELECT id, CAST(coalesce(commence_date, DATE '1900-01-01') AS VARCHAR) AS service_sdt,
       CAST(coalesce(closed_date, DATE '9999-12-31') AS VARCHAR) AS service_edt FROM account""",
)
def _(t: Tables) -> DataFrame:
    return sources(t.spark, t.sf_dir).account.select(
        "id",
        calendar.service_start(F.col("commence_date")).alias("service_sdt"),
        calendar.service_end(F.col("closed_date")).alias("service_edt"),
    )


@book.add(
    "try_cast_null",
    """SELECT p_brand, TRY_CAST(p_brand AS DOUBLE) + 2 AS brand_plus, TRY_CAST(substr(p_brand, 7) AS INTEGER) + 2 AS number_plus,
       count(*) AS n_parts FROM part GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    brand = F.col("p_brand")
    return t.part.groupBy(
        brand,
        (brand.try_cast("double") + 2).alias("brand_plus"),
        (F.substring(brand, 7, 100).try_cast("int") + 2).alias("number_plus"),
    ).agg(F.count(F.lit(1)).alias("n_parts"))


@book.add(
    "union_all",
    """SELECT l_orderkey, l_linenumber, l_partkey, 'returned' AS kind FROM lineitem WHERE l_returnflag = 'R'
       UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'open' FROM lineitem WHERE l_linestatus = 'O'
       UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'taxed' FROM lineitem WHERE l_tax <> 0""",
)
def _(t: Tables) -> DataFrame:
    kinds = {"returned": "l_returnflag = 'R'", "open": "l_linestatus = 'O'", "taxed": "l_tax <> 0"}
    first, second, third = (
        t.lineitem.filter(test).select("l_orderkey", "l_linenumber", "l_partkey", F.lit(kind).alias("kind"))
        for kind, test in kinds.items()
    )
    return first.unionByName(second).unionByName(third)


@book.add(
    "union_all_distinct_branches",
    """SELECT DISTINCT l_orderkey, l_returnflag AS flag FROM lineitem WHERE l_returnflag <> 'N'
       UNION ALL SELECT DISTINCT l_orderkey, l_linestatus FROM lineitem WHERE l_linestatus = 'O'""",
)
def _(t: Tables) -> DataFrame:
    flags = t.lineitem.filter("l_returnflag <> 'N'").select("l_orderkey", F.col("l_returnflag").alias("flag")).distinct()
    status = t.lineitem.filter("l_linestatus = 'O'").select("l_orderkey", F.col("l_linestatus").alias("flag")).distinct()
    return flags.unionByName(status)


@book.add(
    "union_distinct",
    """SELECT DISTINCT 't3_1' AS model, id FROM part_leaf WHERE leaf <= 4
       UNION ALL SELECT DISTINCT 'position_5', id FROM part_leaf WHERE leaf >= 5
       UNION ALL SELECT DISTINCT 'positions', id FROM part_leaf""",
)
def _(t: Tables) -> DataFrame:
    tests = {f"1_{n}": f"l_linenumber = {n}" for n in range(1, 8)} | {"1_8": "l_returnflag = 'R'", "1_9": "l_linestatus = 'O'"}
    leaves = {name: t.lineitem.filter(test).select(F.col("l_partkey").alias("id")) for name, test in tests.items()}
    models = examples.position_graph({name: leaf.distinct() for name, leaf in leaves.items()})
    picked = [models[m].select(F.lit(m).alias("model"), "id") for m in ("t3_1", "position_5", "positions")]
    return picked[0].union(picked[1]).union(picked[2])


@book.add(
    "distinct_rows",
    "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem",
)
def _(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag").distinct()


QUERIES, SQL = book.queries, book.sql
