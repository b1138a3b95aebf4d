"""Exact deduplication over an extendible-hash index kept on shared files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veldcube.llm.common import SPACE, numbered, partitions, stored

#: Keys a bucket holds before it is split.
BUCKET_KEYS = 50_000
#: Bits of the key that the directory may use; buckets that are overfull beyond hold keys that share them all.
MAX_DEPTH = 20


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def slot(key: Column, depth: int) -> Column:
    """The first `depth` bits of a 64-bit key."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, bucket_keys: int = BUCKET_KEYS, max_depth: int = MAX_DEPTH) -> tuple[int, DataFrame]:
    """Extendible-hash directory over distinct `key`s: its depth, and its slots (slot, depth, bucket).

    The directory starts as one bucket. While a bucket is overfull the directory doubles, that is, it
    looks at one more bit, and the overfull bucket splits in two; the others keep their local depth.
    Keys are counted once, at the depth that their number calls for, and summed for the lower depths.
    A bucket is named by its first slot.
    """
    deepest = min(max_depth, (4 * keys.count() // bucket_keys).bit_length() + 1)
    fine = stored(keys.groupBy(slot(F.col("key"), deepest).alias("slot")).agg(F.count("*").alias("n")), "slots")
    seen = fine.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(deepest)))).withColumn(
        "prefix", F.expr(f"shiftrightunsigned(slot, {deepest} - depth)"))
    sizes = seen.groupBy("depth", "prefix").agg(F.sum("n").alias("n_keys"))
    done = (F.col("n_keys") <= bucket_keys) | (F.col("depth") == deepest)
    local = seen.join(sizes, ["depth", "prefix"]).groupBy("slot").agg(F.min(F.when(done, F.col("depth"))).alias("depth"))
    first = F.expr(f"shiftleft(shiftrightunsigned(slot, {deepest} - depth), {deepest} - depth)")
    return deepest, local.select("slot", "depth", first.alias("bucket"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 key: Column | None = None, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """Every row of `docs` with the row that stays of those with the same normalised text:
    row, doc_id, keep_id, keep_row, group_size, kept, text_sha256.

    Texts are grouped by key and bytes, map-side first, so a text that fills a third of the table
    moves once per task. The distinct texts are the index entries: those that share a key are chained
    and were told apart by their bytes. Entries are written to shared files in the order of their
    directory buckets, each task owning a range of keys; rows then look up their entry by key and
    digest. A digest shared by two different texts of one key stops the job instead of merging them.

    Null text counts as empty. The smallest doc_id stays, null ids last; among rows that share it, the
    first row. Empty tables give no rows; other columns are not read. `key` replaces the hash of the
    normalised text (column `norm`) in tests of collisions.
    """
    spark = docs.sparkSession
    key = F.xxhash64("norm") if key is None else key
    rows = numbered(docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("norm"))).withColumn("key", key)
    first = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row")
    texts = rows.groupBy("key", "norm").agg(F.min(first).alias("first"), F.count("*").alias("group_size"))
    entries = stored(texts.select(
        "key", F.sha2("norm", 256).alias("text_sha256"), F.col("first.doc_id").alias("keep_id"),
        F.col("first.row").alias("keep_row"), "group_size"), "entries")
    depth, slots = directory(entries.select("key").distinct(), bucket_keys)
    slots = stored(slots, "exact-directory")
    alike = F.count("*").over(W.partitionBy("bucket", "key", "text_sha256"))
    index = stored(
        entries.withColumn("slot", slot(F.col("key"), depth)).join(slots.select("slot", "bucket"), "slot")
        .repartitionByRange(partitions(spark), "bucket", "key").withColumn("same_digest", alike), "exact-index")
    checked = F.when(F.col("same_digest") > 1, F.raise_error(F.lit("two texts of one key share a SHA-256")).cast("long")).otherwise(F.col("keep_row"))
    probes = rows.select("row", "doc_id", "key", F.sha2("norm", 256).alias("text_sha256"))
    found = probes.join(index, ["key", "text_sha256"])
    return found.withColumn("keep_row", checked).select(
        "row", "doc_id", "keep_id", "keep_row", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")


def exact_report(docs: DataFrame) -> DataFrame:
    return exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


EXACT_SQL = r"""
with n as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm
  from documents
)
select doc_id, min(doc_id) over (partition by norm) as keep_id, count(*) over (partition by norm) as group_size,
       row_number() over (partition by norm order by doc_id) = 1 as kept, text_sha256
from n
"""
