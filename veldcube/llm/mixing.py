"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veldcube.llm.common import WORD, numbered, running_total, stored

EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = "mix-1:"


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """One row per source of `sized` (source, size): source_size, weight and target.

    Sources in code-point order, null last, take the weights in turn. Targets share the total size
    by weight; none exceeds `epochs` times its source, and what it leaves is shared among the others.
    The shares are levelled in one pass: ordered by limit over weight, sources are at their limit as
    long as the level that remains for them and the later ones reaches it. Windows here run over
    sources, not documents.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    index = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    picked = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("i") % len(weights) + 1)
    ranked = sizes.withColumn("i", index).withColumn("weight", picked.cast("long")).withColumn(
        "cap", F.col("source_size") * epochs)
    order = W.orderBy((F.col("cap").cast("double") / F.col("weight")).asc(), "i")
    everything = W.partitionBy()
    level = (F.col("total") - F.col("caps")).cast("double") / F.col("weights")
    levelled = (
        ranked.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("caps", F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("weights", F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("open", F.when(F.col("cap").cast("double") / F.col("weight") > level, F.struct(F.row_number().over(order).alias("at"), level.alias("level"))))
        .withColumn("level", F.min("open").over(everything)["level"])
    )
    # The level is that of the first source that stays below its limit.
    target = F.when(F.col("level").isNull(), F.col("cap").cast("double")).otherwise(
        F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")))
    return levelled.select("source", "source_size", "weight", target.alias("target"))


def mix_rows(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, seed: str = SEED,
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             row_col: str | None = None) -> DataFrame:
    """How often each row of `docs` enters the mix: row, doc_id, source, size, source_size, target, copies, taken.

    Every source is a queue in a shuffled order that depends on the seed and the ids only. A document
    of the n-th pass ends at (n x source size + words so far) / target; documents of all sources are
    range-sorted by that time and taken while the words stay within the total. `row` is
    `row_col` of stored `docs`, or else a number given here.

    Null text has size 0 and takes no words; null sources form a source of their own; null ids come
    last among equal keys; repeated rows are counted each. An empty table gives no rows. Other
    columns are not read.
    """
    sized = stored(docs.select(
        (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("key"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size")), "sized")
    targets = stored(source_targets(sized, weights, epochs), "targets")
    queued = running_total(sized, ["key", "doc_id", "size", "row"], "size", "served", "source")
    about = targets.select(F.col("source").alias("of"), "source_size", "target")
    queued = queued.join(F.broadcast(about) if targets.count() <= 100_000 else about, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    passes = queued.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    timed = passes.withColumn("finish", F.when(
        F.col("target") > 0, (F.col("pass") * F.col("source_size") + F.col("served")).cast("double") / F.col("target"))
        .otherwise(F.col("pass").cast("double")))
    lined = running_total(timed, ["finish", "key", "doc_id", "pass", "size", "row"], "size", "words")
    budget = targets.agg(F.sum("source_size")).first()[0] or 0
    taken = F.col("words") <= budget
    return lined.groupBy("row", "doc_id", "source", "size", "source_size", "target").agg(
        F.sum(F.when(taken, 1).otherwise(0)).alias("copies"),
        F.sum(F.when(taken, F.col("size")).otherwise(0)).alias("taken"))


def mix_report(docs: DataFrame) -> DataFrame:
    return mix_rows(docs).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """`docs` with each row as often as the mix takes it, columns unchanged."""
    docs = numbered(docs, "__row")
    copies = mix_rows(docs, **options, row_col="__row").filter("copies > 0").select(
        F.col("row").alias("__row"), F.sequence(F.lit(1), F.col("copies").cast("int")).alias("__passes"))
    return (
        docs.join(copies, "__row")
        .withColumn("__pass", F.explode("__passes")).drop("__row", "__passes", "__pass")
    )


MIX_SQL = r"""
with recursive sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         md5('mix-1:' || coalesce(doc_id::varchar, '')) as key
  from documents
), ranked as (
  select source, sum(size)::bigint as source_size,
         (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight,
         row_number() over (order by source nulls last) as i
  from sized group by source
), levels as (
  select *, source_size * 3 as cap, (sum(source_size) over ())::bigint as total,
         coalesce(sum(source_size * 3) over (order by (source_size * 3)::double / weight, i
                  rows between unbounded preceding and 1 preceding), 0)::bigint as caps,
         (sum(weight) over (order by (source_size * 3)::double / weight, i
          rows between current row and unbounded following))::bigint as weights
  from ranked
), levelled as (
  select *, (select arg_min((total - caps)::double / weights, row(cap::double / weight, i)) from levels
             where cap::double / weight > (total - caps)::double / weights) as level
  from levels
), targets as (
  select source, source_size, total,
         case when level is null then cap::double else least(cap::double, level * weight) end as target
  from levelled
), queued as (
  select s.*, t.source_size, t.target, t.total,
         (sum(s.size) over (partition by s.source order by s.key, s.doc_id, s.size
          rows between unbounded preceding and current row))::bigint as served
  from sized s join targets t on s.source is not distinct from t.source
), timed as (
  select *, case when target > 0 then (n * source_size + served)::double / target else n::double end as finish
  from queued, (values (0), (1), (2)) as p(n)
), lined as (
  select *, (sum(size) over (order by finish, key, doc_id, n, size
             rows between unbounded preceding and current row))::bigint as words
  from timed
)
"""
MIX_REPORT_SQL = MIX_SQL + """
select doc_id, size, source_size, target,
       sum(case when words <= total then size else 0 end)::bigint as taken
from lined group by doc_id, size, source_size, target
"""
