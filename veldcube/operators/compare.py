"""Comparison of two sources over the same cells, and diagnostics of where they differ."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veldcube.functions import fixed
from veldcube.functions.columns import cell_area_approx
from veldcube.functions.session import cut_lineage
from veldcube.operators import distance, patches, spatial
from veldcube.operators.order_stats import exact_median, exact_percentiles


def compare_cells(new: DataFrame, old: DataFrame, group: list[str], cell: list[str]) -> DataFrame:
    """Per group: each side's statistics and agreement on the cells valid in both.

    Agreement is NULL below ten common cells.
    """
    key = [*group, *cell]
    both = new.select(*key, F.col("value").alias("a")).join(old.select(*key, F.col("value").alias("b")), key, "full")
    # Stored: the statistics and the median each read it.
    both = cut_lineage(both.withColumn("d", F.abs(F.col("a") - F.col("b"))))
    stats = []
    for side, c in (("new", "a"), ("old", "b")):
        stats += [
            F.count(c).alias(f"n_valid_{side}"), F.avg(c).alias(f"mean_{side}"), F.stddev_pop(c).alias(f"std_{side}"),
            F.min(c).alias(f"min_{side}"), F.max(c).alias(f"max_{side}"),
        ]
    n = F.count("d")
    shared = F.col("d").isNotNull()
    stats += [
        n.alias("n_overlapping"),
        F.when(n >= fixed.MIN_OVERLAP, F.corr(F.when(shared, F.col("a")), F.when(shared, F.col("b")))).alias("correlation"),
        F.when(n >= fixed.MIN_OVERLAP, F.avg("d")).alias("mean_abs_diff"),
        F.when(n >= fixed.MIN_OVERLAP, F.avg(F.when(F.col("d") > 0.05, 100.0).when(shared, 0.0))).alias("pct_diff_gt_005"),
        F.when(n >= fixed.MIN_OVERLAP, F.avg(F.when(F.col("d") > 0.10, 100.0).when(shared, 0.0))).alias("pct_diff_gt_010"),
    ]
    middle = exact_median(both, group, "d", "m", (0.0, 2.0))
    return both.groupBy(*group).agg(*stats).join(middle, group).withColumn(
        "median_abs_diff", F.when(F.col("n_overlapping") >= fixed.MIN_OVERLAP, F.col("m"))
    ).drop("m")


def burn_pairs(new: DataFrame, old: DataFrame, key: list[str], keep: list[str] | None = None) -> DataFrame:
    """Full alignment of two burn tables: doy_new and doy_old, 0 where unburned, fill or absent."""
    n = new.select(*key, F.col("burn_date").alias("n"), *(keep or []))
    o = old.select(*key, F.col("burn_date").alias("o"))
    positive = {c: F.when(F.col(c) > 0, F.col(c)).otherwise(0) for c in ("n", "o")}
    return n.join(o, key, "full").select(*key, positive["n"].alias("doy_new"), positive["o"].alias("doy_old"), *(keep or []))


def membership() -> Column:
    """overlap, only_new, only_old, or NULL for a cell that neither source burned."""
    new, old = F.col("doy_new") > 0, F.col("doy_old") > 0
    return F.when(new & old, "overlap").when(new, "only_new").when(old, "only_old")


def compare_burned(pairs: DataFrame, group: list[str], grid: DataFrame) -> DataFrame:
    m = membership()
    gap = F.when(m == "overlap", F.abs(F.col("doy_new") - F.col("doy_old")).cast("double"))
    counts = pairs.groupBy(*group).agg(
        F.sum((F.col("doy_new") > 0).cast("int")).alias("n_burned_new"),
        F.sum((F.col("doy_old") > 0).cast("int")).alias("n_burned_old"),
        *[F.sum(F.coalesce((m == k).cast("int"), F.lit(0))).alias(f"n_{k}") for k in ("overlap", "only_new", "only_old")],
        F.avg(gap).alias("mean_abs_diff_days"),
    )
    px = grid.select("aoi", cell_area_approx(F.col("dx"), F.col("dy"), F.col("north"), F.col("n_rows")).alias("pixel_area_km2"))
    return counts.join(px, "aoi").withColumn("burned_new_km2", F.col("n_burned_new") * F.col("pixel_area_km2")).withColumn(
        "burned_old_km2", F.col("n_burned_old") * F.col("pixel_area_km2")
    )


def cell_stats(cells: DataFrame, group: list[str]) -> DataFrame:
    return cells.groupBy(*group).agg(
        F.count("value").alias("n_valid"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )


def pairwise_match(aligned: DataFrame, sources: list[str], group: list[str]) -> DataFrame:
    """Agreement of every pair of sources; `aligned` has one burn-date column per source and cell.

    All pairs are counted in one pass over the cells.
    """
    pairs = list(combinations(sources, 2))
    burned = {s: F.coalesce(F.col(s) > 0, F.lit(False)) for s in sources}
    aggs = [F.sum(burned[s].cast("int")).alias(f"n_{s}") for s in sources]
    for a, b in pairs:
        both = burned[a] & burned[b]
        aggs.append(F.sum(both.cast("int")).alias(f"both_{a}_{b}"))
        aggs.append(F.avg(F.when(both, F.abs(F.col(a) - F.col(b)).cast("double"))).alias(f"mad_{a}_{b}"))
    counts = aligned.groupBy(*group).agg(*aggs)
    rows = counts.select(*group, F.explode(F.array(*[
        F.struct(
            F.lit(a).alias("source_a"), F.lit(b).alias("source_b"), F.col(f"n_{a}").alias("n_a"), F.col(f"n_{b}").alias("n_b"),
            F.col(f"both_{a}_{b}").alias("n_overlap"), F.col(f"mad_{a}_{b}").alias("mad_days"),
        ) for a, b in pairs
    ])).alias("p")).select(*group, "p.*")
    n_a, n_b, both = F.col("n_a"), F.col("n_b"), F.col("n_overlap")
    share = lambda part, whole: F.when(whole > 0, F.lit(100.0) * part / whole).otherwise(0.0)
    union = n_a + n_b - both
    return rows.select(
        "*", (n_a - both).alias("n_only_a"), (n_b - both).alias("n_only_b"),
        share(both, n_a).alias("pct_a_captured"), share(both, n_b).alias("pct_b_captured"),
        F.when(union > 0, both / union).otherwise(0.0).alias("jaccard"),
    )


def presence_counts(aligned: DataFrame, sources: list[str], group: list[str]) -> DataFrame:
    """Cells per combination of sources that burned them."""
    flags = [F.coalesce(F.col(s) > 0, F.lit(False)).alias(f"in_{s}") for s in sources]
    named = [f"in_{s}" for s in sources]
    some = reduce(lambda a, b: a | b, [F.col(c) for c in named])
    return aligned.select(*group, *flags).where(some).groupBy(*group, *named).agg(F.count(F.lit(1)).alias("n_cells"))


def subset_verdict(match: DataFrame, source: str, candidate: str, other: str, group: list[str]) -> DataFrame:
    """Is `source` the same product as `candidate`, judged against `other`? Pairs come source-first."""
    a = match.where((F.col("source_a") == source) & (F.col("source_b") == candidate))
    b = match.where((F.col("source_a") == source) & (F.col("source_b") == other)).select(
        *group, F.col("jaccard").alias("other_jaccard"), F.col("n_only_a").alias("other_only_a"), F.col("mad_days").alias("other_mad"),
    )
    pa, pb = F.col("pct_a_captured"), F.col("pct_b_captured")
    near = (pa >= 90) & (pb >= 90) & (F.coalesce("mad_days", F.lit(0.0)) < 2)
    better = F.when(F.col("other_jaccard") > 0, F.col("jaccard") / F.col("other_jaccard") >= 1.2).otherwise(True)
    subset = (F.col("other_only_a") == 0) & (F.coalesce("other_mad", F.lit(0.0)) < 1)
    verdict = (
        F.when(near, "near_perfect").when(((pa >= 50) | (pb >= 50)) & better, "partial")
        .when(subset, "strict_subset").otherwise("different")
    )
    return a.join(b, group).select(*group, pa, pb, "jaccard", "other_jaccard", verdict.alias("verdict"))


def yearly_ratio(pairs: DataFrame, group: list[str]) -> DataFrame:
    n = pairs.groupBy(*group, "year").agg(
        F.sum((F.col("doy_new") > 0).cast("int")).alias("n_new"), F.sum((F.col("doy_old") > 0).cast("int")).alias("n_old")
    )
    return n.withColumn("ratio", F.col("n_new") / F.nullif(F.col("n_old"), F.lit(0)))


def temporal_ratio(ratios: DataFrame, group: list[str]) -> DataFrame:
    """Verdict on new/old per year: constant, erratic, increasing or mixed; needs three years."""
    known = ratios.where("ratio IS NOT NULL")
    step = F.col("ratio") - F.lag("ratio").over(Window.partitionBy(*group).orderBy("year"))
    stats = known.withColumn("step", step).groupBy(*group).agg(
        F.count("ratio").alias("n_years"), (F.max("ratio") - F.min("ratio")).alias("ratio_range"),
        (F.stddev_pop("ratio") / F.avg("ratio")).alias("ratio_cv"),
        F.sum(F.when(F.col("step") > 0, 1).otherwise(0)).alias("n_up"), F.min("ratio").alias("lowest"),
    ).where("n_years >= 3")
    verdict = (
        F.when((F.col("ratio_range") < 0.30) & (F.col("lowest") > 1.1), "constant")
        .when(F.col("ratio_cv") > 0.5, "erratic")
        .when(F.col("n_up") >= F.col("n_years") - 2, "increasing").otherwise("mixed")
    )
    return stats.withColumn("verdict", verdict).drop("lowest")


def burned_clusters(pairs: DataFrame, group: list[str], connectivity: int) -> DataFrame:
    """Cells of the new source labelled by cluster, with whether the old source burned them too."""
    burned = cut_lineage(pairs.where("doy_new > 0").withColumn("mark", F.lit(1.0)))
    labels = patches.connected_components(burned, group, "mark", connectivity)
    key = [*group, "row_idx", "col_idx"]
    return labels.drop("value").join(burned.select(*key, (F.col("doy_old") > 0).alias("in_old")), key)


def cluster_sizes(clusters: DataFrame, group: list[str]) -> DataFrame:
    return clusters.groupBy(*group, "component_id").agg(
        F.count(F.lit(1)).alias("size"), F.sum(F.col("in_old").cast("int")).alias("n_old")
    )


def cluster_classes(sizes: DataFrame, group: list[str]) -> DataFrame:
    """Only-new cells by the kind of cluster they are in, and the dominant kind.

    Works on cluster sizes: a cluster's only-new cells are its size less its old cells.
    """
    fresh = F.col("size") - F.col("n_old")
    kind = F.when(F.col("size") == 1, "isolated").when(F.col("n_old") > 0, "mixed").otherwise("all_new")
    counts = sizes.withColumn("fresh", fresh).withColumn("kind", kind).groupBy(*group).agg(
        F.sum("fresh").alias("n_only_new"),
        *[F.sum(F.when(F.col("kind") == k, F.col("fresh")).otherwise(0)).alias(f"n_{k}") for k in ("isolated", "mixed", "all_new")],
    ).where("n_only_new > 0")
    pct = {k: F.lit(100.0) * F.col(f"n_{k}") / F.col("n_only_new") for k in ("isolated", "mixed", "all_new")}
    verdict = (
        F.when(pct["isolated"] > 50, "isolated").when(pct["mixed"] > 50, "mixed").when(pct["all_new"] > 50, "all_new")
        .otherwise("no_majority")
    )
    return counts.select("*", *[p.alias(f"pct_{k}") for k, p in pct.items()], verdict.alias("verdict"))


def cluster_size_classes(sizes: DataFrame, group: list[str]) -> DataFrame:
    """Clusters fully, partly or not at all in the old source: count and median size.

    Clusters are counted per size first: the number of distinct sizes is at most the square root of
    twice the cells, so the percentile's state stays small.
    """
    kind = F.when(F.col("n_old") == F.col("size"), "fully_old").when(F.col("n_old") == 0, "only_new").otherwise("mixed")
    per_size = sizes.groupBy(*group, kind.alias("kind"), "size").agg(F.count(F.lit(1)).alias("n"))
    return per_size.groupBy(*group, "kind").agg(
        F.sum("n").alias("n_clusters"), F.floor(F.percentile("size", F.lit(0.5), F.col("n"))).alias("median_size"),
    )


def min_cluster_curve(sizes: DataFrame, group: list[str]) -> DataFrame:
    """Cells kept when clusters below each minimum size are dropped, and how many more than the old source's overlap."""
    kept = sizes.groupBy(*group).agg(
        *[F.sum(F.when(F.col("size") >= k, F.col("size")).otherwise(0)).alias(f"k{k}") for k in fixed.CLUSTER_MIN_SIZES],
        F.sum("n_old").alias("n_old"),
    )
    steps = F.array(*[F.struct(F.lit(k).alias("min_size"), F.col(f"k{k}").alias("cells_kept")) for k in fixed.CLUSTER_MIN_SIZES])
    return kept.select(*group, F.explode(steps).alias("s"), "n_old").select(
        *group, "s.min_size", "s.cells_kept", (F.col("s.cells_kept") - F.col("n_old")).alias("vs_old")
    )


def distance_groups(pairs: DataFrame, group: list[str]) -> DataFrame:
    """Distance of each newly burned cell to the nearest old burn, by overlap or only_new."""
    cells = cut_lineage(pairs.withColumn("member", membership()))
    old = cells.where("doy_old > 0")
    new = cells.where("doy_new > 0")
    near = distance.distance_to_nearest(new, old, group)
    return near.join(new.select(*group, "row_idx", "col_idx", "member"), [*group, "row_idx", "col_idx"])


def distance_stats(distances: DataFrame, group: list[str]) -> DataFrame:
    """Mean, median and maximum distance per group and member."""
    key, known = [*group, "member"], distances.where("distance IS NOT NULL")
    sums = known.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_cells"), F.avg("distance").alias("mean_distance"), F.max("distance").alias("max_distance"))
    middle = exact_percentiles(known, key, "distance", {"median_distance": 0.5}, None)
    return sums.join(middle, key)


def distance_histogram(distances: DataFrame, group: list[str]) -> DataFrame:
    """Only-new cells per distance bin [lo, hi); the last bin is open."""
    d = F.col("distance")
    lo = F.lit(None).cast("int")
    for edge in fixed.DISTANCE_BINS:
        lo = F.when(d >= edge, edge).otherwise(lo)
    return distances.where((F.col("member") == "only_new") & d.isNotNull()).groupBy(*group, lo.alias("bin_from")).agg(
        F.count(F.lit(1)).alias("n_cells")
    )


def qa_stratify(pairs: DataFrame, group: list[str]) -> DataFrame:
    """Newly burned cells per quality value, with its bit fields decoded."""
    qa = F.col("burn_qa")
    bit = lambda k: F.shiftright(qa, k).bitwiseAND(F.lit(1))
    ground = qa.bitwiseAND(F.lit(3))
    # Names of the two land/water bits.
    names = ["water", "land", "barren", "other"]
    label = reduce(lambda acc, i: F.when(ground == i, names[i]).otherwise(acc), range(3), F.lit(names[3]))
    m = membership()
    return pairs.where("doy_new > 0").groupBy(*group, "burn_qa").agg(
        F.count(F.lit(1)).alias("n_burned"),
        F.sum((m == "overlap").cast("int")).alias("n_overlap"), F.sum((m == "only_new").cast("int")).alias("n_only_new"),
    ).select("*", label.alias("land_water"), bit(2).alias("valid_burn"), bit(3).alias("shortened"), bit(4).alias("special"), bit(5).alias("grouped"))


def reliable_window(pairs: DataFrame, group: list[str]) -> DataFrame:
    """Newly burned cells inside and outside their reliable days, against the old source."""
    first, last, day = F.col("first_day"), F.col("last_day"), F.col("doy_new")
    inside = F.coalesce((first > 0) & (last > 0) & (first <= day) & (day <= last), F.lit(False))
    m = membership()
    return pairs.where("doy_new > 0").groupBy(*group, inside.alias("in_window")).agg(
        F.count(F.lit(1)).alias("n_burned"),
        F.sum((m == "overlap").cast("int")).alias("n_overlap"), F.sum((m == "only_new").cast("int")).alias("n_only_new"),
    )


def edge_effect(pairs: DataFrame, valid: DataFrame, group: list[str], iterations: int = 2) -> DataFrame:
    """Only-new cells near the rim of the valid area against its interior."""
    zones = spatial.erode(valid, group, iterations)
    fresh = pairs.where(membership() == "only_new").join(zones, [*group, "row_idx", "col_idx"], "left")
    return fresh.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_only_new"),
        F.sum(F.coalesce((~F.col("interior")).cast("int"), F.lit(0))).alias("n_edge"),
        F.sum(F.coalesce(F.col("interior").cast("int"), F.lit(0))).alias("n_interior"),
    )


def inside_outside(pairs: DataFrame, spans: DataFrame, group: list[str]) -> DataFrame:
    """Cells inside and outside the polygons per membership, with a verdict on the outside share."""
    flagged = spatial.inside_flag(pairs.withColumn("member", membership()).where("member IS NOT NULL"), spans)
    counts = flagged.groupBy(*group, "member").agg(
        F.count(F.lit(1)).alias("n_cells"), F.sum(F.col("inside").cast("int")).alias("n_inside")
    ).withColumn("n_outside", F.col("n_cells") - F.col("n_inside"))
    share = F.col("n_outside") / F.col("n_cells")
    return counts.select(
        "*", (F.lit(100.0) * F.col("n_inside") / F.col("n_cells")).alias("pct_inside"),
        F.when(F.col("n_outside") == 0, "all_inside").when(share < 0.05, "marginal").otherwise("significant").alias("verdict"),
    )


def clip_verdict(cells: DataFrame, spans: DataFrame, group: list[str]) -> DataFrame:
    """Was the raster clipped by the polygon? Judged by values outside of it."""
    flagged = spatial.inside_flag(cells, spans)
    inside, has = F.col("inside"), F.col("value").isNotNull()
    count = lambda cond: F.sum(cond.cast("int"))
    counts = flagged.groupBy(*group).agg(
        count(inside & has).alias("inside_valued"), count(inside & ~has).alias("inside_nodata"),
        count(~inside & has).alias("outside_valued"), count(~inside & ~has).alias("outside_nodata"),
    )
    valued, empty = F.col("outside_valued"), F.col("outside_nodata")
    verdict = (
        F.when(valued + empty == 0, "no outside cells").when(valued == 0, "polygon clip")
        .when(empty == 0, "bbox clip only").otherwise("partial polygon clip")
    )
    return counts.withColumn("verdict", verdict)


def mean_shift(new: DataFrame, reference: DataFrame, member: list[str], family: list[str], spread: float = 0.05) -> DataFrame:
    """New mean less the reference mean per member; anomalous above 0.2 or when the members of a
    family shift in opposite directions by more than `spread` in total."""
    fresh = new.groupBy(*family, *member).agg(F.avg("value").alias("new_mean"))
    shifts = fresh.join(reference, [*family, *member]).withColumn("shift", F.col("new_mean") - F.col("ref_mean"))
    whole = Window.partitionBy(*family)
    low, high = F.min("shift").over(whole), F.max("shift").over(whole)
    return shifts.withColumn("opposed", (low < 0) & (high > 0) & (high - low > spread)).withColumn(
        "anomalous", (F.abs("shift") > 0.2) | F.col("opposed")
    )


def regression_baselines(comparison: DataFrame, expected: DataFrame, on: list[str]) -> DataFrame:
    """Correlation and mean difference against expected values within 0.005; a missing value fails."""
    rows = expected.join(comparison.select(*on, "correlation", "mean_abs_diff"), on, "left")
    tol = fixed.REGRESSION_TOLERANCE
    near = lambda got, want: F.coalesce(F.abs(F.col(got) - F.col(want)) <= tol, F.lit(False))
    return rows.select(
        "*", near("correlation", "exp_corr").alias("corr_ok"),
        (F.col("exp_mad").isNull() | near("mean_abs_diff", "exp_mad")).alias("mad_ok"),
        F.coalesce(F.col("correlation") >= 0.9, F.lit(False)).alias("spot_ok"),
    )


def sample_spaced(cells: DataFrame, group: list[str], n: int) -> DataFrame:
    """n evenly spaced cells of each group in row order.

    Ranks come from per-row counts plus the position within the row, so a large group stays split.
    """
    rows = cells.select(*group, "row_idx", "col_idx").distinct()
    per_row = rows.groupBy(*group, "row_idx").agg(F.count(F.lit(1)).alias("in_row"))
    before = Window.partitionBy(*group).orderBy("row_idx").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_row.withColumn("offset", F.coalesce(F.sum("in_row").over(before), F.lit(0)))
    position = F.row_number().over(Window.partitionBy(*group, "row_idx").orderBy("col_idx"))
    ranked = rows.withColumn("position", position).join(offsets, [*group, "row_idx"]).withColumn(
        "rank", F.col("offset") + F.col("position") - 1
    )
    sizes = per_row.groupBy(*group).agg(F.sum("in_row").alias("total"))
    m = F.least(F.lit(n), F.col("total"))
    step = F.when(m > 1, (F.col("total") - 1) / (m - 1)).otherwise(0.0)
    wanted = sizes.select(*group, F.explode(F.sequence(F.lit(0), (m - 1).cast("int"))).alias("sample"), step.alias("step")).select(
        *group, "sample", F.floor(F.col("sample") * F.col("step")).alias("rank")
    )
    return ranked.join(wanted, [*group, "rank"]).select(*group, "sample", "row_idx", "col_idx")


def sample_seeded(rows: DataFrame, group: list[str], identity: list[str], n: int, seed: int = 42) -> DataFrame:
    """n rows of each group in the order of a seeded hash; the limit applies before the shuffle too."""
    mark = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in identity]))
    order = Window.partitionBy(*group).orderBy("mark")
    return rows.withColumn("mark", mark).withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= n).drop("rn", "mark")
