"""Helpers shared by the operators: stored intermediate tables, running totals, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veldcube.functions.session import ensure_checkpoint_dir

#: A word is a run of anything but ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


#: While this is set, a query's shuffle files go when the query ends, not when the driver happens to collect its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the driver and all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def stored(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and go on from the files, so that neither lineage nor shuffle files are left behind."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    with freed_shuffles(spark):
        (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, column: str = "row") -> DataFrame:
    """`df` with a number for each row, written once: row numbers follow the splits of the input, which may
    differ from job to job, so every step that goes by them reads this table."""
    spark = df.sparkSession
    path = shared_path(spark, "numbered")
    rows = df.withColumn(column, F.monotonically_increasing_id())
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once, however often `use` refers to it."""
    return F.transform(F.array(value), lambda x: use(x))[0]


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def running_total(df: DataFrame, order: list[str], value: str, out: str, group: str | None = None) -> DataFrame:
    """Add `out`: the sum of `value` up to and with each row in `order`, within `group` where one is named.

    Rows are range-sorted over all partitions; each partition adds the totals of the ranges before
    it, so neither a large group nor the whole table has to meet in one task. `order` must be total
    apart from rows that are alike; the totals of partitions are as many rows as there are partitions
    (and groups).
    """
    spark = df.sparkSession
    by = [group] if group else []
    rows = stored(
        df.repartitionByRange(partitions(spark), *[F.col(c).asc_nulls_last() for c in [*by, *order]])
        .withColumn("__part", F.spark_partition_id()), "ranged")
    totals = rows.groupBy("__part", *by).agg(F.sum(value).alias("__sum"))
    before = F.sum("__sum").over(W.partitionBy(*by).orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    offsets = totals.select("__part", *[F.col(c).alias(f"__of_{c}") for c in by], F.coalesce(before, F.lit(0)).alias("__before"))
    matches = F.col("__part") == F.col("__at")
    for c in by:
        matches &= F.col(c).eqNullSafe(F.col(f"__of_{c}"))
    joined = rows.join(offsets.withColumnRenamed("__part", "__at"), matches)
    within = F.sum(value).over(
        W.partitionBy("__part", *by).orderBy(*[F.col(c).asc_nulls_last() for c in order])
        .rowsBetween(W.unboundedPreceding, 0))
    return joined.withColumn(out, within + F.col("__before")).drop(
        "__part", "__at", "__before", *[f"__of_{c}" for c in by])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of `edges` (a, b: long): a row (node, component) for every node that has
    an edge, component being the smallest node reachable.

    Each round points every node at the neighbour (or itself) that comes first in a hashed order and
    replaces the edges by those between the nodes pointed at, until none is left; the tables written
    per round then compose the labels. A hub's edges are combined before they move. Rows with a null
    end are ignored.
    """
    rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n"))
    edges = edges.filter("a is not null and b is not null").select("a", "b")
    nodes = stored(edges.select("a").union(edges.select("b")).distinct().toDF("node"), "nodes")
    edges = stored(edges.filter("a != b").distinct(), "edges")
    hops: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a").toDF("a", "b"))
        hop = stored(
            both.groupBy("a").agg(F.min(rank("b")).alias("best"))
            .select("a", F.least("best", rank("a"))["n"].alias("p")), "hop")
        hops.append(hop)
        edges = stored(
            edges.join(hop, "a").select(F.col("p").alias("pa"), "b")
            .join(hop.withColumnRenamed("a", "b"), "b").filter("pa != p")
            .select(F.least("pa", "p").alias("a"), F.greatest("pa", "p").alias("b")).distinct(), "edges")
    labels = nodes.withColumn("root", F.col("node"))
    for hop in hops:
        labels = labels.join(hop.withColumnRenamed("a", "root"), "root", "left").select(
            "node", F.coalesce("p", "root").alias("root"))
    labels = stored(labels, "labels") if hops else labels
    least = labels.groupBy("root").agg(F.min("node").alias("component"))
    return labels.join(least, "root").select("node", "component")
