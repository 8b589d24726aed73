"""Joins, aggregations and ranks on the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.checks.basics import BILLS_SQL, bills
from tallygrid.checks.mart_sql import EVEN3, half_up, month_overlap, number, per_day, scaled
from tallygrid.checks.registry import Book, Tables
from tallygrid.functions import calendar, discounts
from tallygrid.functions.keys import segment_hash
from tallygrid.functions.numeric import over_days, per_day as daily_share
from tallygrid.operators.horizons import month_horizon
from tallygrid.operators.overlaps import cross_overlap, overlap_explode, overlap_join
from tallygrid.operators.ranking import latest_with_ties, with_dense_ranks
from tallygrid.plans.accounts import never_billed_accounts
from tallygrid.sources.testtables import TEST_RUN, discount_rate, order_calendar, order_day, price, tax_rate

# Money of a line as exact decimals, in both engines.
MONEY_SQL = """
SELECT *, CAST(l_extendedprice AS DECIMAL(18, 2)) AS price, CAST(abs(l_discount) AS DECIMAL(4, 2)) AS disc,
       CAST(abs(l_tax) AS DECIMAL(4, 2)) AS tax, CAST(l_quantity AS DECIMAL(18, 2)) AS qty FROM lineitem"""
RANKED_SQL = """
SELECT *, CAST(dense_rank() OVER (PARTITION BY o_custkey ORDER BY bill_sdt DESC) AS INTEGER) AS sdt_rank,
       CAST(dense_rank() OVER (PARTITION BY o_custkey ORDER BY bill_edt DESC) AS INTEGER) AS edt_rank FROM bills"""

book = Book({"bills": BILLS_SQL, "money_lines": MONEY_SQL, "ranked_bills": RANKED_SQL})


def money_lines(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "*",
        price().alias("price"),
        discount_rate().alias("disc"),
        tax_rate().alias("tax"),
        F.col("l_quantity").cast("decimal(18,2)").alias("qty"),
    )



@book.add(
    "star_join",
    """SELECT r_name, n_name, c_mktsegment, o_orderstatus, count(*) AS n_orders, CAST(sum(price) AS DOUBLE) AS revenue
       FROM bills JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
       JOIN region ON r_regionkey = n_regionkey GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        bills(t)
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("r_name", "n_name", "c_mktsegment", "o_orderstatus")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("price").alias("revenue"))
    )


@book.add(
    "fact_join",
    """SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, p_brand, s_name, CAST(price AS DOUBLE) AS price
       FROM money_lines JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
       WHERE o_orderstatus = 'F'""",
)
def _(t: Tables) -> DataFrame:
    return (
        money_lines(t)
        .join(t.orders.filter("o_orderstatus = 'F'"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey", "p_brand", "s_name", "price")
    )


@book.add(
    "join_then_agg",
    """SELECT o_orderkey, o_custkey, CAST(min(bill_sdt) AS VARCHAR) AS first_day, CAST(max(bill_edt) AS VARCHAR) AS last_day,
       CAST(sum(price_line) AS DOUBLE) AS amount, count(*) AS n_lines
       FROM (SELECT b.*, m.price AS price_line FROM bills b JOIN money_lines m ON l_orderkey = o_orderkey)
       GROUP BY o_orderkey, o_custkey""",
)
def _(t: Tables) -> DataFrame:
    lines = money_lines(t).select("l_orderkey", F.col("price").alias("price_line"))
    return (
        bills(t)
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_orderkey", "o_custkey")
        .agg(
            F.min("bill_sdt").alias("first_day"),
            F.max("bill_edt").alias("last_day"),
            F.sum("price_line").alias("amount"),
            F.count(F.lit(1)).alias("n_lines"),
        )
    )


@book.add(
    "left_lookup",
    """SELECT l_orderkey, l_linenumber, l_partkey, p_name, p_size FROM lineitem
       LEFT JOIN (SELECT * FROM part WHERE p_size < 10) ON p_partkey = l_partkey""",
)
def _(t: Tables) -> DataFrame:
    small_parts = t.part.filter("p_size < 10")
    return t.lineitem.join(small_parts, F.col("l_partkey") == F.col("p_partkey"), "left").select(
        "l_orderkey", "l_linenumber", "l_partkey", "p_name", "p_size"
    )


@book.add(
    "left_null_reject",
    """SELECT l_orderkey, l_linenumber, l_partkey, o_orderstatus FROM lineitem
       LEFT JOIN orders ON o_orderkey = l_orderkey WHERE CAST(o_orderdate AS DATE) <= DATE '1997-12-31'""",
)
def _(t: Tables) -> DataFrame:
    """The filter rejects unmatched lines, so the optimizer makes this an inner join."""
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return joined.filter(order_day() <= F.lit(dt.date(1997, 12, 31))).select(
        "l_orderkey", "l_linenumber", "l_partkey", "o_orderstatus"
    )


@book.add(
    "left_composite_key",
    """SELECT l_orderkey, l_linenumber, l_partkey, n_same
       FROM lineitem a LEFT JOIN (
         SELECT l_partkey AS p, l_suppkey AS s, l_linenumber AS n, l_returnflag AS r, l_linestatus AS ls, count(*) AS n_same
         FROM lineitem GROUP BY ALL HAVING count(*) > 1) b
       ON p = l_partkey AND s = l_suppkey AND n = l_linenumber AND r = l_returnflag AND ls = l_linestatus""",
)
def _(t: Tables) -> DataFrame:
    keys = ["l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"]
    repeated = t.lineitem.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_same")).filter("n_same > 1")
    return t.lineitem.join(repeated, keys, "left").select("l_orderkey", "l_linenumber", "l_partkey", "n_same")


@book.add(
    "anti_join",
    """SELECT DISTINCT c_custkey AS seq_product_item_id, CAST(DATE '1999-01-01' + CAST(c_custkey % 700 AS INTEGER) AS VARCHAR) AS service_sdt,
       '2000-06-30' AS service_edt, c_mktsegment AS fuel_type, n_name AS market_region, n_name AS market_sub_region,
       c_mktsegment AS customer_segment, CAST(month(DATE '1999-01-01' + CAST(c_custkey % 700 AS INTEGER)) AS INTEGER) AS mth_no
       FROM customer JOIN nation ON n_nationkey = c_nationkey
       WHERE DATE '1999-01-01' + CAST(c_custkey % 700 AS INTEGER) <= DATE '2000-06-30'
         AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= DATE '2000-08-01')""",
)
def _(t: Tables) -> DataFrame:
    """Customers without an order in the last year of data."""
    recent = t.orders.filter(order_day() >= F.lit(dt.date(2000, 8, 1)))
    customers = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("account_id"),
        F.date_add(F.lit(dt.date(1999, 1, 1)), (F.col("c_custkey") % 700).cast("int")).alias("service_sdt"),
        F.lit(dt.date(2000, 6, 30)).alias("service_edt"),
        F.col("c_mktsegment").alias("fuel_type"),
        F.col("n_name").alias("market_region"),
        F.col("n_name").alias("market_sub_region"),
        F.col("c_mktsegment").alias("customer_type"),
    )
    return never_billed_accounts(customers, recent.select(F.col("o_custkey").alias("seq_product_item_id")))


_OVERLAP_SQL = f"""SELECT o_orderkey, CAST(mth_sdt AS VARCHAR) AS mth_sdt, CAST({month_overlap('h', 'bill_sdt', 'bill_edt')} AS INTEGER) AS total_days
FROM bills JOIN horizon h ON bill_sdt <= mth_edt AND bill_edt >= mth_sdt"""


def _overlap(t: Tables, join) -> DataFrame:
    horizon = month_horizon(order_calendar(t.orders), TEST_RUN)
    rows = join(bills(t), horizon, TEST_RUN.accrual_range, F.col("bill_sdt"), F.col("bill_edt"))
    days = calendar.overlap_days(*(F.col(c) for c in ("mth_sdt", "mth_edt", "bill_sdt", "bill_edt")))
    return rows.withColumn("total_days", days)


for _name, _join in (("overlap_join", overlap_join), ("overlap_explode", overlap_explode), ("cross_overlap", cross_overlap)):
    book.add(_name, _OVERLAP_SQL)(
        lambda t, join=_join: _overlap(t, join).select("o_orderkey", "mth_sdt", "total_days")
    )


_PRICE15 = per_day(scaled("price", 9), "n_days")


@book.add(
    "prorate_overlap",
    f"""SELECT CAST(mth_sdt AS VARCHAR) AS mth_sdt, o_orderstatus, {number('sum(rate15 * total_days)', 15)} AS amount FROM (
          SELECT h.mth_sdt, o_orderstatus, {month_overlap('h', 'bill_sdt', 'bill_edt')} AS total_days, rate15
          FROM (SELECT *, {_PRICE15} AS rate15 FROM (SELECT *, datediff('day', bill_sdt, bill_edt) + 1 AS n_days FROM bills))
          JOIN horizon h ON bill_sdt <= mth_edt AND bill_edt >= mth_sdt) GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    rate = daily_share(F.col("price"), calendar.inclusive_days(F.col("bill_sdt"), F.col("bill_edt")))
    return _overlap(t, overlap_explode).groupBy("mth_sdt", "o_orderstatus").agg(
        F.sum(over_days(rate, F.col("total_days"))).alias("amount")
    )


@book.add(
    "open_period_days",
    """SELECT o_custkey, o_orderkey, CAST(mth_sdt AS VARCHAR) AS mth_sdt, CAST(total_days AS INTEGER) AS total_days FROM (
         SELECT *, datediff('day', greatest(mth_sdt, bill_edt + 1), least(mth_edt, service_edt)) + 1 AS total_days
         FROM (SELECT *, DATE '2001-01-01' + CAST(o_custkey % 300 AS INTEGER) AS service_edt FROM ranked_bills WHERE edt_rank = 1)
         JOIN horizon ON DATE '1995-01-01' <= mth_edt AND service_edt >= mth_sdt AND bill_edt <= mth_edt)
       WHERE total_days > 0""",
)
def _(t: Tables) -> DataFrame:
    service_end = F.date_add(F.lit(dt.date(2001, 1, 1)), (F.col("o_custkey") % 300).cast("int"))
    latest = latest_with_ties(with_dense_ranks(bills(t), "o_custkey", {"bill_edt": "edt_rank"}), "edt_rank")
    months = overlap_explode(
        latest.withColumn("service_edt", service_end),
        month_horizon(order_calendar(t.orders), TEST_RUN),
        TEST_RUN.accrual_range,
        F.col("bill_edt"),
        F.col("service_edt"),
    )
    days = calendar.open_period_days(*(F.col(c) for c in ("mth_sdt", "mth_edt", "service_edt", "bill_edt")))
    return months.select("o_custkey", "o_orderkey", "mth_sdt", days.alias("total_days")).filter("total_days > 0")


_KEY = "md5(CAST(month(bill_edt) AS VARCHAR) || n_name || o_orderstatus || r_name || c_mktsegment)"
_PLACED = """FROM bills JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey"""


def _placed_bills(t: Tables) -> DataFrame:
    placed = (
        bills(t)
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    key = segment_hash(F.month("bill_edt"), F.col("n_name"), F.col("o_orderstatus"), F.col("r_name"), F.col("c_mktsegment"))
    return placed.withColumn("record_hash", key)


@book.add(
    "hash_key_join",
    f"""SELECT o_orderkey, record_hash, n_bills FROM (SELECT o_orderkey, {_KEY} AS record_hash {_PLACED})
        JOIN (SELECT {_KEY} AS h, count(*) AS n_bills {_PLACED} GROUP BY 1) ON h = record_hash""",
)
def _(t: Tables) -> DataFrame:
    rows = _placed_bills(t)
    sizes = rows.groupBy("record_hash").agg(F.count(F.lit(1)).alias("n_bills"))
    return rows.join(sizes, "record_hash").select("o_orderkey", "record_hash", "n_bills")


@book.add(
    "share_of_group",
    f"""SELECT n_name, c_mktsegment, o_orderpriority, n_accounts, n_group,
        round(CAST(n_accounts AS DOUBLE) / n_group, 6) AS factor
        FROM (SELECT n_name, c_mktsegment, o_orderpriority, count(DISTINCT o_custkey) AS n_accounts {_PLACED} GROUP BY ALL)
        JOIN (SELECT n_name, c_mktsegment, count(DISTINCT o_custkey) AS n_group {_PLACED} GROUP BY ALL) USING (n_name, c_mktsegment)""",
)
def _(t: Tables) -> DataFrame:
    rows, accounts = _placed_bills(t), F.countDistinct("o_custkey")
    fine = rows.groupBy("n_name", "c_mktsegment", "o_orderpriority").agg(accounts.alias("n_accounts"))
    coarse = rows.groupBy("n_name", "c_mktsegment").agg(accounts.alias("n_group"))
    return fine.join(coarse, ["n_name", "c_mktsegment"]).withColumn(
        "factor", F.round(F.try_divide("n_accounts", "n_group"), 6)
    )


@book.add(
    "agg_summary",
    """SELECT l_returnflag, l_linestatus, l_linenumber, CAST(sum(qty) AS DOUBLE) AS sum_qty, CAST(sum(price) AS DOUBLE) AS sum_price,
       CAST(sum(price * (1 - disc)) AS DOUBLE) AS sum_net, count(l_orderkey) AS n_lines FROM money_lines GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    net = F.col("price") * (F.lit(1).cast("decimal(4,2)") - F.col("disc"))
    return money_lines(t).groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(
        F.sum("qty").alias("sum_qty"),
        F.sum("price").alias("sum_price"),
        F.sum(net).alias("sum_net"),
        F.count("l_orderkey").alias("n_lines"),
    )


@book.add(
    "agg_detail",
    """SELECT l_orderkey, l_returnflag, CAST(sum(coalesce(CASE WHEN tax <> 0 THEN price END, 0)) AS DOUBLE) AS taxed_price
       FROM money_lines GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    taxed = F.when(F.col("tax") != 0, F.col("price"))
    return money_lines(t).groupBy("l_orderkey", "l_returnflag").agg(
        F.sum(F.coalesce(taxed, F.lit(0))).alias("taxed_price")
    )


_PRICE4 = scaled("price", 4)


@book.add(
    "conditional_sum",
    f"""SELECT l_suppkey, {number(f"sum(CASE WHEN tax = 0 THEN {half_up(f'({_PRICE4} * 1000)', 11)} * 10 ELSE {_PRICE4} * 1000 END)", 7)} AS before_tax
        FROM money_lines GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    stripped = discounts.strip_tax(F.col("price").cast("decimal(18,4)"), F.col("tax"))
    return money_lines(t).groupBy("l_suppkey").agg(F.sum(stripped).alias("before_tax"))


@book.add(
    "agg_min_max",
    """SELECT o_custkey, CAST(min(bill_sdt) AS VARCHAR) AS first_day, CAST(max(bill_edt) AS VARCHAR) AS last_day,
       CAST(max(price) AS DOUBLE) AS top_price FROM bills GROUP BY o_custkey""",
)
def _(t: Tables) -> DataFrame:
    return bills(t).groupBy("o_custkey").agg(
        F.min("bill_sdt").alias("first_day"), F.max("bill_edt").alias("last_day"), F.max("price").alias("top_price")
    )


@book.add(
    "agg_avg_round",
    f"""SELECT l_suppkey, {number(half_up(f"sum(CASE WHEN tax <> 0 THEN {scaled('price', 2)} END) * 1000", "count(CASE WHEN tax <> 0 THEN 1 END)"), 5)} AS avg_taxed
        FROM money_lines GROUP BY l_suppkey""",
)
def _(t: Tables) -> DataFrame:
    taxed = F.when(F.col("tax") != 0, F.col("price").cast("decimal(28,15)"))
    return money_lines(t).groupBy("l_suppkey").agg(F.round(F.avg(taxed), 5).alias("avg_taxed"))


@book.add(
    "agg_count_distinct",
    "SELECT l_returnflag, l_linenumber, count(DISTINCT l_partkey) AS n_parts FROM lineitem GROUP BY ALL",
)
def _(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag", "l_linenumber").agg(F.countDistinct("l_partkey").alias("n_parts"))


@book.add(
    "agg_group_expr",
    """SELECT CASE WHEN o_orderpriority LIKE '1%' THEN 'urgent' ELSE 'other' END AS kind, CAST(month(bill_edt) AS INTEGER) AS mth_no,
       o_orderstatus, CAST(sum(price) AS DOUBLE) AS revenue FROM bills GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    kind = F.when(F.col("o_orderpriority").like("1%"), "urgent").otherwise("other")
    return bills(t).groupBy(kind.alias("kind"), F.month("bill_edt").alias("mth_no"), "o_orderstatus").agg(
        F.sum("price").alias("revenue")
    )


@book.add(
    "agg_case_post",
    """SELECT l_orderkey, l_linestatus, CASE WHEN l_linestatus = 'O' AND sum(CASE WHEN l_returnflag = 'R' THEN price ELSE 0 END) = 0
       THEN 'Y' ELSE 'N' END AS all_kept, CAST(sum(price) AS DOUBLE) AS amount FROM money_lines GROUP BY l_orderkey, l_linestatus""",
)
def _(t: Tables) -> DataFrame:
    returned = F.sum(F.when(F.col("l_returnflag") == "R", F.col("price")).otherwise(F.lit(0)))
    grouped = money_lines(t).groupBy("l_orderkey", "l_linestatus").agg(
        returned.alias("returned"), F.sum("price").alias("amount")
    )
    kept = (F.col("l_linestatus") == "O") & (F.col("returned") == 0)
    return grouped.select("l_orderkey", "l_linestatus", F.when(kept, "Y").otherwise("N").alias("all_kept"), "amount")


@book.add(
    "agg_format_number",
    f"""SELECT l_orderkey, CAST(milli // 1000 AS VARCHAR) || '.' || lpad(CAST(milli % 1000 AS VARCHAR), 3, '0') AS discount_text FROM (
          SELECT l_orderkey, ({EVEN3}) // 10000 AS milli FROM (SELECT l_orderkey, round(price * disc, 2) AS discount_net FROM money_lines)
          GROUP BY l_orderkey)""",
)
def _(t: Tables) -> DataFrame:
    discount = F.round(F.col("price") * F.col("disc"), 2).cast("decimal(18,4)")
    return money_lines(t).groupBy("l_orderkey").agg(discounts.formatted_discount(F.sum(discount)).alias("discount_text"))


@book.add(
    "distinct_over_agg",
    """SELECT DISTINCT l_returnflag, n_lines FROM (
         SELECT l_orderkey, l_returnflag, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey, l_returnflag)""",
)
def _(t: Tables) -> DataFrame:
    counted = t.lineitem.groupBy("l_orderkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n_lines"))
    return counted.select("l_returnflag", "n_lines").distinct()


@book.add("dense_rank_latest", "SELECT o_custkey, o_orderkey, CAST(bill_sdt AS VARCHAR) AS bill_sdt, sdt_rank FROM ranked_bills")
def _(t: Tables) -> DataFrame:
    ranked = with_dense_ranks(bills(t), "o_custkey", {"bill_sdt": "sdt_rank"})
    return ranked.select("o_custkey", "o_orderkey", "bill_sdt", "sdt_rank")


@book.add("dense_rank_two_orders", "SELECT o_custkey, o_orderkey, sdt_rank, edt_rank FROM ranked_bills")
def _(t: Tables) -> DataFrame:
    ranked = with_dense_ranks(bills(t), "o_custkey", {"bill_sdt": "sdt_rank", "bill_edt": "edt_rank"})
    return ranked.select("o_custkey", "o_orderkey", "sdt_rank", "edt_rank")


@book.add("latest_with_ties", "SELECT o_custkey, o_orderkey, sdt_rank, edt_rank FROM ranked_bills WHERE sdt_rank = 1 OR edt_rank = 1")
def _(t: Tables) -> DataFrame:
    ranked = with_dense_ranks(bills(t), "o_custkey", {"bill_sdt": "sdt_rank", "bill_edt": "edt_rank"})
    return latest_with_ties(ranked, "sdt_rank", "edt_rank").select("o_custkey", "o_orderkey", "sdt_rank", "edt_rank")


QUERIES, SQL = book.queries, book.sql
