"""Column expressions that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the six ASCII white space characters; what separates words and what equality ignores.
WHITE = "\\x20\\x09-\\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str | Column) -> Column:
    """The text, a null as an empty one."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def once(*cols: Column) -> Column:
    """Array of one struct, to be exploded with ``inline``.

    Expressions that are used many times over, above all inside lambdas, are computed once per row
    below such a step; a plain select may be merged into its consumer and computed again each time.
    """
    return F.array(F.struct(*cols))


def tagged(docs: DataFrame, tag: Column) -> DataFrame:
    """(_row, _tag): every row as one value, whose names can't clash with any, and what the row is known by."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), tag.alias("_tag"))
