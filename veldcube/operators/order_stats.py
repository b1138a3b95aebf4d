"""Exact medians and percentiles that hold up when one group is very large."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets that a group's values are split over: equal steps of a fixed range, or quantiles of the data.
STEPS = 4096
QUANTILES = 128


def same_keys(left: str, right: str, keys: list[str]) -> Column:
    return reduce(
        lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys], F.lit(True)
    )


def quantile_edges(df: DataFrame, value: str) -> list[float]:
    """Edges that cut all values of `df` into parts of about equal size; one small row reaches the driver."""
    cuts = [i / QUANTILES for i in range(1, QUANTILES)]
    found = df.agg(F.percentile_approx(value, cuts, 20 * QUANTILES).alias("edges")).first()["edges"]
    return sorted(set(found or []))


def edge_bucket(v: Column, edges: list[float], first: int = 0) -> Column:
    """Number of edges at or below a value, by bisection."""
    if not edges:
        return F.lit(first)
    middle = len(edges) // 2
    return F.when(v < edges[middle], edge_bucket(v, edges[:middle], first)).otherwise(
        edge_bucket(v, edges[middle + 1 :], first + middle + 1)
    )


def exact_percentiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    fractions: dict[str, float],
    value_range: tuple[float, float] | None = (-1.0, 1.0),
) -> DataFrame:
    """Percentiles with linear interpolation per group, a column for each entry of `fractions`; NULL
    values do not count.

    A group is split over value buckets, so a hot one spreads over many tasks. Rows are shuffled once, by
    group and bucket; from that one shuffle the buckets are counted, the running counts of a group's
    buckets locate the ranks, and the buckets that hold one are ordered. `value_range` is the range that the
    value has by definition; without one the buckets are quantiles of the data, which another pass over
    the input finds. Either steers the balance only, not the result.
    """
    v = F.col("v")
    if value_range is None:
        bucket = edge_bucket(v, quantile_edges(df, value))
    else:
        low, high = value_range
        share = F.least(F.greatest((v - low) / (high - low), F.lit(0.0)), F.lit(1.0))
        bucket = F.floor(share * (STEPS - 1)).cast("int")
    # The two readers of this shuffle have the same plan below it, so it runs once. NULL values have a
    # bucket of their own, which holds no rank; leaving them out of one reader would split the shuffle in two.
    rows = df.select(*keys, F.col(value).alias("v")).withColumn("bucket", F.when(v.isNotNull(), bucket)).repartition(*keys, "bucket")
    by_group = Window.partitionBy(*keys)
    running = by_group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    buckets = (
        rows.groupBy(*keys, "bucket")
        .agg(F.count("v").alias("n"))
        .withColumn("total", F.sum("n").over(by_group))
        .withColumn("before", F.sum("n").over(running) - F.col("n"))
    )
    position = {out: (F.col("total") - 1) * F.lit(float(f)) for out, f in fractions.items()}
    holds = [
        (F.col("before") < F.ceil(p) + 1) & (F.col("before") + F.col("n") >= F.floor(p) + 1) for p in position.values()
    ]
    wanted = buckets.where((F.col("n") > 0) & reduce(lambda a, b: a | b, holds)).drop("n")
    in_bucket = Window.partitionBy(*keys, "bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    condition = same_keys("v", "w", [*keys, "bucket"])
    ranked = (
        rows.alias("v")
        .join(wanted.alias("w"), condition)
        .select(*[F.col(f"v.{k}").alias(k) for k in keys], "v.bucket", "v.v", "w.before", "w.total")
        .withColumn("rank", F.col("before") + F.row_number().over(in_bucket))
    )
    picked, result = [F.max("total").alias("total")], []
    for i, (out, p) in enumerate(position.items()):
        picked += [
            F.max(F.when(F.col("rank") == F.floor(p) + 1, F.col("v"))).alias(f"lo{i}"),
            F.max(F.when(F.col("rank") == F.ceil(p) + 1, F.col("v"))).alias(f"hi{i}"),
        ]
        result.append((F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * (p - F.floor(p))).alias(out))
    found = ranked.groupBy(*keys).agg(*picked).select(*keys, *result)
    none = [F.lit(None).cast("double").alias(out) for out in fractions]
    empty = buckets.where("total = 0").select(*keys, *none).distinct()
    return found.unionByName(empty)


def exact_median(
    df: DataFrame, keys: list[str], value: str, out: str, value_range: tuple[float, float] | None = (-1.0, 1.0)
) -> DataFrame:
    return exact_percentiles(df, keys, value, {out: 0.5}, value_range)
