"""Draws, ranks and caps. A draw orders rows by a hash of a seed and their key, so it is the same on any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetforge.operators.storing import kept

#: Rows of a range of an ordered table, about.
ROWS = 500_000


def draw(seed: str | int, *key: str | Column) -> Column:
    """The hash that a seeded shuffle orders by."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in key)))


def uniform(seed: str | int, *key: str | Column) -> Column:
    """A number in [0, 1) from the first 32 bits of the draw."""
    return F.conv(F.substring(draw(seed, *key), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def drawn(seed: str | int, n: Column, *key: str | Column) -> Column:
    """A whole number from 0 to n - 1 by the first 32 bits of the draw."""
    return F.conv(F.substring(draw(seed, *key), 1, 8), 16, 10).cast("bigint") % n


def first_of(df: DataFrame, by: list[str], *order: Column | str, n: int = 1) -> DataFrame:
    """The first n rows of each group; Spark cuts groups down before it shuffles them."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def topped_up(new: DataFrame, accepted: DataFrame, by: list[str], n: int, *order: Column | str) -> DataFrame:
    """The new rows that a cap of n rows a group leaves room for, behind those accepted before, of which their number alone is
    read. New rows that were accepted before should be left out first."""
    had = accepted.groupBy(*by).agg(F.count("*").alias("_had"))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    few = new.withColumn("_rank", rank).where(F.col("_rank") <= n).join(had, by, "left")
    return few.where(F.col("_rank") + F.coalesce("_had", F.lit(0)) <= n).select(new.columns)


def quota(df: DataFrame, bucket: str, quotas: dict[str, int], *order: Column | str) -> DataFrame:
    """The first rows of each bucket, as many as its quota says; buckets without a quota go."""
    allowed = F.create_map(*(F.lit(x) for pair in quotas.items() for x in pair))
    rank = F.row_number().over(Window.partitionBy(bucket).orderBy(*order))
    most = max(quotas.values())
    ranked = df.where(F.col(bucket).isin(*quotas)).withColumn("_rank", rank).where(F.col("_rank") <= most)
    return ranked.where(F.col("_rank") <= allowed[F.col(bucket)]).drop("_rank")


def ranges(df: DataFrame, lead: str, order: list[Column | str], rows: int) -> DataFrame:
    """The rows with `_range`: as many ranges as the rows need, in the order of `lead` and `order`. Spark draws the bounds;
    the rows are kept with their ranges, so that all that follows sees the same ones."""
    many = -(-df.count() // rows)
    if many <= 1:
        return df.withColumn("_range", F.lit(0))
    return kept(df.repartitionByRange(many, lead, *order).withColumn("_range", F.spark_partition_id()))


def running(df: DataFrame, lead: str, order: list[Column | str], value: Column | str, name: str, by: tuple[str, ...] = (), rows: int | None = None) -> DataFrame:
    """`name`: the sum of `value` over all rows up to and with this one, in the order of `lead` and `order`, which together
    tell rows apart; of the rows with the same `by` only, if given.

    No task sees the whole table: ranges are summed, the sums of earlier ranges are joined back, a row for each range and
    `by`, and each range is added up by itself.
    """
    value = F.col(value) if isinstance(value, str) else value
    ranged = ranges(df.withColumn("_value", value), lead, order, rows or ROWS)
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    keys = ["_range", *by]
    sums = ranged.groupBy(*keys).agg(F.sum("_value").alias("_sum"))
    sums = sums.select(*(F.col(k).alias(f"_of_{k}") for k in keys), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = F.sum("_value").over(Window.partitionBy(*keys).orderBy(lead, *order).rowsBetween(Window.unboundedPreceding, 0))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    both = ranged.withColumn("_inside", inside).join(sums, same)
    return both.withColumn(name, F.col("_before") + F.col("_inside")).drop("_range", "_value", "_before", "_inside", *(f"_of_{k}" for k in keys))


def numbered(df: DataFrame, lead: str, *order: Column | str, name: str = "rn", by: tuple[str, ...] = (), rows: int | None = None) -> DataFrame:
    """`name`: the place of each row, from 1, in the order of `lead` and `order`, over the whole table or among the rows with
    the same `by`."""
    return running(df, lead, list(order), F.lit(1).cast("bigint"), name, by, rows)


def sharded(df: DataFrame, number: str, shards: int) -> DataFrame:
    """The rows with the shard that round robin gives them."""
    return df.withColumn("shard", ((F.col(number) - 1) % shards).cast("int"))


def strided(df: DataFrame, by: list[str], most: int, *order: Column | str) -> DataFrame:
    """Every k-th row of each group, k = size div most, at least 1."""
    whole = Window.partitionBy(*by)
    place = F.row_number().over(whole.orderBy(*order))
    step = F.greatest(F.lit(1), F.floor(F.count("*").over(whole) / most))
    return df.withColumns({"_place": place, "_step": step}).where((F.col("_place") - 1) % F.col("_step") == 0).drop("_place", "_step")


def weighted_choice(df: DataFrame, by: list[str], weight: str, seed: str | int, *order: Column | str) -> DataFrame:
    """One row of each group, with probability in proportion to its weight: the first whose share of the running sum
    exceeds the group's number."""
    group = Window.partitionBy(*by)
    upto = F.sum(weight).over(group.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    share = F.round(F.try_divide(upto, F.sum(weight).over(group)), 12)
    late = df.withColumn("cdf", share).where(F.col("cdf") > uniform(seed, *by))
    return first_of(late, by, "cdf", *order)
