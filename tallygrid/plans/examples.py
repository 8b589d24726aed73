"""The small dependency graphs of literal rows and unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Inputs of each model of the position graph, leaves left out.
POSITION_INPUTS = {
    "2_1": ("1_1", "1_2", "1_3"),
    "2_2": ("1_3",),
    "2_3": ("1_3", "1_4"),
    "2_4": ("1_5",),
    "2_5": ("1_5", "1_6"),
    "2_6": ("1_7",),
    "2_7": ("1_8",),
    "t3_1": ("2_1", "2_2", "2_3"),
    "3_2": ("2_4", "2_5", "2_6", "2_7"),
    "4_1": ("t3_1",),
    "4_2": ("t3_1",),
    "4_3": ("t3_1",),
    "4_4": ("3_2", "1_9"),
    "position_1": ("4_1",),
    "position_2": ("4_2",),
    "position_3": ("4_2", "4_3"),
    "position_4": ("4_3",),
    "position_5": ("4_4",),
    "positions": ("position_1", "position_2", "position_3", "position_4", "position_5"),
}
LEAVES = tuple(f"1_{n}" for n in range(1, 10))
# Ids the data test of position_5 accepts.
ACCEPTED_POSITIONS = ("1_5", "1_6", "1_7", "1_8")


def literal_rows(spark: SparkSession, values: list, type_name: str, column: str = "id") -> DataFrame:
    """One-row literal relations under each other."""
    rows = [spark.range(1).select(F.lit(value).cast(type_name).alias(column)) for value in values]
    return reduce(DataFrame.union, rows)


def union_distinct(*branches: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, branches).distinct()


def position_leaves(spark: SparkSession) -> dict[str, DataFrame]:
    """Literal ids; the first one adds a number to text, which is NULL as an id."""
    leaves = {name: literal_rows(spark, [name], "string") for name in LEAVES}
    first = (F.lit("1_1").try_cast("double") + F.lit(2)).cast("string")
    return leaves | {"1_1": spark.range(1).select(first.alias("id"))}


def position_graph(leaves: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All models from the leaf relations; one input passes through, several are merged."""
    models = dict(leaves)
    for name, inputs in POSITION_INPUTS.items():
        frames = [models[part].select("id") for part in inputs]
        models[name] = frames[0] if len(frames) == 1 else union_distinct(*frames)
    return models


def tagged(models: dict[str, DataFrame]) -> DataFrame:
    """All models of a graph under each other, each row with its model's name. Parts they share are worked out once."""
    rows = [frame.select(F.lit(name).alias("model"), F.col("id").cast("string").alias("id")) for name, frame in models.items()]
    return reduce(DataFrame.union, rows)


def example_chain(first: DataFrame) -> dict[str, DataFrame]:
    """Filters stacked on a literal relation."""
    second = first.filter(F.col("id") == 1)
    return {"first": first, "second": second, "third": second.filter(F.col("id") == 1), "fourth": first.filter(F.col("id") == 1)}
