"""The small model graphs on leaves from the test tables, and counts by bitmaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.checks.registry import Book, Tables
from tallygrid.operators.bitmaps import bitmaps, counts_by_level, with_numbers
from tallygrid.plans import examples
from tallygrid.session import Staging, fresh_path

# A leaf has the customers of one ninth, by nation; the first one adds a number to text, which is NULL as an id.
_LEAVES = {
    f"1_{n}": f"SELECT CASE WHEN {n} > 1 THEN '1_{n}-' || CAST(c_nationkey AS VARCHAR) END AS id FROM customer WHERE c_custkey % 9 = {n - 1}"
    for n in range(1, 10)
}
_CHAIN = {
    "first": "SELECT CASE WHEN r_regionkey > 0 THEN r_regionkey END AS id FROM region",
    "second": "SELECT id FROM m_first WHERE id = 1",
    "third": "SELECT id FROM m_second WHERE id = 1",
    "fourth": "SELECT id FROM m_first WHERE id = 1",
}


def _graph_sql() -> str:
    """Every model as a table of its own: one input passes through, several are merged."""
    merged = {name: " UNION ".join(f"SELECT id FROM m_{part}" for part in parts) for name, parts in examples.POSITION_INPUTS.items()}
    models = {**_LEAVES, **merged, **_CHAIN}
    tables = ", ".join(f"m_{name} AS ({text})" for name, text in models.items())
    rows = " UNION ALL ".join(f"SELECT '{name}' AS model, CAST(id AS VARCHAR) AS id FROM m_{name}" for name in models)
    return f"WITH {tables} SELECT model, id, count(*) AS n_rows FROM ({rows}) GROUP BY ALL"


book = Book()


def graph_leaves(t: Tables) -> dict[str, DataFrame]:
    leaves = {}
    for n in range(1, 10):
        own = t.customer.filter(F.col("c_custkey") % 9 == n - 1)
        text = F.concat(F.lit(f"1_{n}-"), F.col("c_nationkey").cast("string"))
        leaves[f"1_{n}"] = own.select((text if n > 1 else (text.try_cast("double") + 2).cast("string")).alias("id"))
    return leaves


def whole_graph(t: Tables) -> DataFrame:
    first = t.region.select(F.when(F.col("r_regionkey") > 0, F.col("r_regionkey")).alias("id"))
    return examples.tagged({**examples.position_graph(graph_leaves(t)), **examples.example_chain(first)})


@book.add("model_graph", _graph_sql())
def _(t: Tables) -> DataFrame:
    """All 28 models of the position graph and the four of the filter chain, each row with its model."""
    return whole_graph(t).groupBy("model", "id").agg(F.count(F.lit(1)).alias("n_rows"))


_LEVELS = [["o_orderpriority", "l_returnflag"], ["l_returnflag"], []]
_COUNTS = """
SELECT CAST(CASE WHEN GROUPING(o_orderpriority) = 0 THEN 0 WHEN GROUPING(l_returnflag) = 0 THEN 1 ELSE 2 END AS INTEGER) AS level,
       o_orderpriority, l_returnflag, count(DISTINCT {column}) AS n_distinct
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY GROUPING SETS ((o_orderpriority, l_returnflag), (l_returnflag), ())"""


def _ordered(t: Tables) -> DataFrame:
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))


@book.add("bitmap_levels", _COUNTS.format(column="o_custkey"))
def _(t: Tables) -> DataFrame:
    """Customers per priority and flag, per flag, and in all, from one pass over the lines."""
    return counts_by_level(bitmaps(_ordered(t), "o_custkey", *_LEVELS[0]), _LEVELS[0], _LEVELS)


@book.add("bitmap_text_levels", _COUNTS.format(column="o_orderdate || o_orderstatus"))
def _(t: Tables) -> DataFrame:
    """The same for texts, numbered first."""
    stage = Staging(t.spark, fresh_path(t.spark, "numbers"))
    told = _ordered(t).withColumn("day", F.concat(F.col("o_orderdate").cast("string"), "o_orderstatus"))
    return counts_by_level(bitmaps(with_numbers(told, "day", stage), "number", *_LEVELS[0]), _LEVELS[0], _LEVELS)


QUERIES, SQL = book.queries, book.sql
