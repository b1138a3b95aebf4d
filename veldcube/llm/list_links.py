"""Links among the members of candidate lists, without forming all pairs of a large group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veldcube.llm.common import let, stored

#: Star rounds before the remaining pairs are formed.
STAR_ROUNDS = 2
#: Words of 64 bits in the parities of a set.
WORDS = 16


def similar(a: str | Column, b: str | Column, percent: int):
    """Whether two arrays of distinct items share `percent` of their union."""
    shared = F.size(F.array_intersect(a, b))
    return 100 * shared >= percent * (F.size(a) + F.size(b) - shared)


def verified(pairs: DataFrame, sets: DataFrame, percent: int, items: Callable[[Column], Column] | None = None) -> DataFrame:
    """The pairs (a, b) whose sets (row, items) are similar; with `items`, those that it makes of them."""
    of = lambda x: sets.select(F.col("row").alias(x), F.col("items").alias(f"s{x}"))
    alike = similar("sa", "sb", percent)
    if items:
        alike = let(F.struct(items(F.col("sa")).alias("x"), items(F.col("sb")).alias("y")), lambda both: similar(both["x"], both["y"], percent))
    return pairs.join(of("a"), "a").join(of("b"), "b").filter(alike).select("a", "b")


def close_enough(differ: Column, sizes: Column, percent: int) -> Column:
    """Whether sets of `sizes` together that differ in so many items at least can share `percent` of their union."""
    return (100 + percent) * differ <= (100 - percent) * sizes


def bound_columns(bounds: DataFrame, side: str) -> DataFrame:
    """`bounds` (row, n, words, more) for one side of a join: columns of their own, which are read without taking a row apart."""
    words = [F.col("words")[k].alias(f"{side}_word{k}") for k in range(WORDS)]
    return bounds.select(F.col("row").alias(side), F.col("n").alias(f"{side}_n"), F.col("more").alias(f"{side}_more"), *words)


def may_link(a: str, b: str, percent: int, finer: Callable[[Column, Column, Column], Column]) -> Column:
    """Whether the `bound_columns` of two sides leave it open that their sets are similar.

    A bit of `words` tells whether an odd number of the set's items fall to it: two sets differ in as many items at
    least as bits differ. Sets too large for that have `more`, which `finer` compares (with the sum of their sizes).
    """
    differ = sum((F.bit_count(F.col(f"{a}_word{k}").bitwiseXOR(F.col(f"{b}_word{k}"))) for k in range(WORDS)), F.lit(0))
    sizes, x, y = F.col(f"{a}_n") + F.col(f"{b}_n"), F.col(f"{a}_more"), F.col(f"{b}_more")
    more = F.when(x.isNotNull() & y.isNotNull(), finer(x, y, sizes)).otherwise(True)
    return F.when(close_enough(differ, sizes, percent), more).otherwise(False)


def hubs(links: DataFrame) -> DataFrame:
    """For every row that has links a row of its component, the same for most of them (row, component): each row
    points at the one with the most links of itself and its neighbours, and four such steps are taken."""
    ends = links.union(links.select("b", "a")).distinct().toDF("row", "hub")
    both = stored(ends.union(ends.select("row", "row").distinct()), "both")
    degrees = both.groupBy("hub").agg(F.count("*").alias("degree"))
    one = stored(both.join(degrees, "hub").groupBy("row").agg(F.max_by("hub", F.struct("degree", "hub")).alias("component")), "hubs")
    jump = lambda steps: steps.withColumnRenamed("component", "at").join(steps.withColumnRenamed("row", "at"), "at").select("row", "component")
    return jump(stored(jump(one), "hubs"))


def list_links(lists: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int, bounds: DataFrame,
               finer: Callable[[Column, Column, Column], Column], rounds: int = STAR_ROUNDS, items: Callable[[Column], Column] | None = None) -> DataFrame:
    """Links (a, b) whose components are those of all similar pairs that share enough lists.

    `lists` has a row (list, row, n, matches, common) for every member of a list: the size of its set,
    how many lists a partner must share with it, and how common its items are. `sets_of` gives the
    sets (row, items) of the rows it is handed, which are those of candidates only. `bounds` (row, n, words, more) and
    `finer` rule pairs out before their sets are read, see `may_link`; they rule out no similar pair.

    Each list is first joined as a star around its most common member, which near copies of one text
    have in common; all pairs of that member are then formed, and it leaves the list. Rows with the same
    hub are known to be connected. Lists that have one member or one hub left are done. After the star
    rounds every pair of different hubs that is left in a list is compared: members outside the list's
    main hub against the list. That last join has the lists and bounds of both at hand: a pair is a row only in the first
    list that it shares, and only if it shares enough lists and its bounds leave it open. A pair whose first list was left by one as centre was met there;
    if it shared too few lists until then, it waits and is told by its lists in the end. With `items`, `sets_of` gives what
    that makes the sets of, such as texts: less to store.
    """
    spark = lists.sparkSession
    fits = f"100 * least(n, m) >= {percent} * greatest(n, m)"
    columns = (("row", "a"), ("n", "m"), ("matches", "l"), ("component", "other"))
    members = lists.withColumn("component", F.col("row"))
    links = spark.createDataFrame([], "a long, b long")
    waiting = spark.createDataFrame([], "a long, b long, shared long, needed int")

    def checked(ready: DataFrame) -> DataFrame:
        rows = stored(ready.select(F.col("a").alias("row")).union(ready.select("b")).distinct(), "met")
        return stored(verified(ready, sets_of(rows), percent, items), "links")

    def left_open(ready: DataFrame) -> DataFrame:
        both = ready.join(bound_columns(bounds, "a"), "a").join(bound_columns(bounds, "b"), "b")
        return both.filter(may_link("a", "b", percent, finer)).select("a", "b")

    for _ in range(rounds):
        order = F.struct("common", (-F.col("row")).alias("late"), "row", "n", "matches", "component")
        centre = members.groupBy("list").agg(F.max(order).alias("c"))
        left = centre.select("list", *[F.col(f"c.{x}").alias(y) for x, y in columns])
        joined = members.withColumnRenamed("row", "b").join(left, "list").filter(f"b != a and component != other and {fits}")
        matched = joined.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.lit(1).cast("long").alias("shared"), F.least("matches", "l").cast("int").alias("needed"))
        counted = stored(matched.union(waiting).groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.min("needed").alias("needed")), "pairs")
        ready, waiting = counted.filter("shared >= needed").select("a", "b"), counted.filter("shared < needed")
        links = links.union(checked(stored(left_open(ready), "open")))
        rest = members.drop("component", "main").join(left.select("list", F.col("a").alias("centre")), "list").filter("row != centre").drop("centre")
        placed = stored(rest.join(hubs(links), "row", "left").withColumn("component", F.coalesce("component", "row")), "members")
        parts = placed.groupBy("list", "component").agg(F.count("*").alias("here"))
        main = parts.groupBy("list").agg(F.max_by("component", F.struct("here", "component")).alias("main"), F.count("*").alias("parts"))
        members = stored(placed.join(main.filter("parts > 1").drop("parts"), "list"), "members")

    lists_of = stored(lists.groupBy("row").agg(F.collect_list("list").alias("all")), "lists-of")
    left = members.filter("component != main").select("list", *[F.col(x).alias(y) for x, y in columns])
    left = left.join(lists_of.select(F.col("row").alias("a"), F.col("all").alias("alla")), "a").join(bound_columns(bounds, "a"), "a")
    right = members.withColumnRenamed("row", "b").join(lists_of.withColumnRenamed("row", "b"), "b").join(bound_columns(bounds, "b"), "b")
    met = right.join(left, "list").filter(f"component != other and (component = main or a < b) and {fits}").filter(may_link("a", "b", percent, finer))
    both = F.array_intersect("all", "alla")
    # Elements of an intersection are in no fixed order: the least list that both are in is the first.
    met = met.filter((F.array_min(both) == F.col("list")) & (F.size(both) >= F.least("matches", "l")))
    of = lambda x: lists_of.select(F.col("row").alias(x), F.col("all").alias(f"all{x}"))
    late = waiting.join(of("a"), "a").join(of("b"), "b").filter(F.size(F.array_intersect("alla", "allb")) >= F.col("needed"))
    ready = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).union(left_open(late.select("a", "b")))
    return links.union(checked(stored(ready.distinct(), "pairs")))
