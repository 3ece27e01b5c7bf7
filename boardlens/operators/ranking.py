"""Ranks and neighbours inside groups of any size.

A plain window over a hot group sorts it in one task. These helpers split every group into
buckets of bounded population, window inside the buckets and stitch the buckets with a summary
that has one row per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardlens.operators.lineage import cut

_LOW_BITS = 20  # at most 2**20 unique integers share a bucket


def _ranked_in_buckets(df: DataFrame, by: list[str], bucket: Column, order: list[Column], name: str) -> DataFrame:
    tagged = df.withColumn("_bucket", bucket)
    sizes = tagged.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*by, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*by, "_bucket").orderBy(*order)
    return (
        tagged.withColumn("_row", F.row_number().over(inside))
        .join(offsets, [*by, "_bucket"])
        .withColumn(name, (F.col("_offset") + F.col("_row") - 1).cast("bigint"))
        .drop("_bucket", "_row", "_offset")
    )


def rank_by_id(df: DataFrame, by: list[str], id_col: str, name: str = "rank") -> DataFrame:
    """0-based rank by a unique integer id within each group."""
    bucket = F.shiftright(F.col(id_col).cast("bigint"), _LOW_BITS)
    return _ranked_in_buckets(df, by, bucket, [F.col(id_col)], name)


def rank_by_digest(df: DataFrame, by: list[str], digest: str, tie: str, name: str = "rank") -> DataFrame:
    """0-based rank by a hex digest within each group; its first four digits spread the rows evenly."""
    return _ranked_in_buckets(df, by, F.substring(digest, 1, 4), [F.col(digest), F.col(tie)], name)


def with_next(df: DataFrame, by: list[str], value: str, name: str = "next") -> DataFrame:
    """The next larger value of a unique integer column within each group, null for the last."""
    tagged = df.withColumn("_bucket", F.shiftright(F.col(value).cast("bigint"), _LOW_BITS))
    firsts = tagged.groupBy(*by, "_bucket").agg(F.min(value).alias("_first"))
    after = firsts.select(
        *by, "_bucket", F.lead("_first").over(Window.partitionBy(*by).orderBy("_bucket")).alias("_next_first")
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy(value)
    return (
        tagged.withColumn("_lead", F.lead(value).over(inside))
        .join(after, [*by, "_bucket"])
        .withColumn(name, F.coalesce("_lead", "_next_first"))
        .drop("_bucket", "_lead", "_next_first")
    )


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """0-based rank over the whole table in the order given, which should leave no ties.

    The rows are dealt into ranges of the order, numbered inside each range and moved by the rows of the
    ranges before it, so no task sees more than a range.
    """
    dealt = cut(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    counts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part").orderBy(*order)
    numbered = dealt.withColumn("_row", F.row_number().over(inside)).join(offsets, "_part")
    return numbered.withColumn(name, (F.col("_offset") + F.col("_row") - 1).cast("bigint")).drop("_part", "_row", "_offset")


def ranges_of(df: DataFrame, by: list[str], order: Column, ranges: int | None = None) -> DataFrame:
    """``df``, written, with the number ``_part`` of the range of (group, order) each row lies in."""
    keys = [*[F.col(c) for c in by], order]
    wide = cut(df).repartitionByRange(*([ranges] if ranges else []), *keys)  # finding the ranges reads the rows once more
    return cut(wide.withColumn("_part", F.spark_partition_id()))


def running_sums(df: DataFrame, by: list[str], order: Column, values: list[str], ranges: int | None = None) -> DataFrame:
    """``df`` with each of the integer columns ``values`` replaced by its sum up to the row, in the order given within each group.

    Rows are dealt into ranges of (group, order), as many as asked for or as a shuffle has, by quantiles that Spark samples: however the
    order's values lie, a range holds about its share of the rows. A range sums its own rows and adds the totals of the
    ranges before it. The order leaves no ties in a group. Groups by null are groups.
    """
    dealt = ranges_of(df, by, order, ranges)
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(*by, "_part").agg(*[F.sum(v).alias(v) for v in values])
    base = totals.select(
        F.struct(*by).alias("_key"), F.col("_part").alias("_at"), *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_{v}") for v in values]
    )
    inside = Window.partitionBy("_part", *by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    summed = dealt.withColumns({v: F.sum(v).over(inside) for v in values})
    met = summed.join(base, (F.col("_part") == F.col("_at")) & F.struct(*by).eqNullSafe(F.col("_key")))
    return met.withColumns({v: F.col(v) + F.col(f"_{v}") for v in values}).select(*df.columns)
