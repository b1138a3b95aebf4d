from statistics import median

import pytest
from pyspark.sql import functions as F

from veldcube.operators import compare
from veldcube.sources import dims

CELL = "aoi string, row_idx int, col_idx int, value double"


def test_agreement_is_null_below_ten_common_cells(spark):
    make = lambda n: spark.createDataFrame([("A", 0, i, 0.1 * i) for i in range(n)] + [("A", 1, 0, None)], CELL)
    few = compare.compare_cells(make(9), make(12), ["aoi"], ["row_idx", "col_idx"]).first()
    assert few.n_overlapping == 9 and few.correlation is None and few.median_abs_diff is None and few.n_valid_old == 12
    many = compare.compare_cells(make(10), make(10).withColumn("value", F.col("value") + 0.07), ["aoi"], ["row_idx", "col_idx"]).first()
    assert many.correlation == pytest.approx(1.0) and many.median_abs_diff == pytest.approx(0.07)
    assert (many.pct_diff_gt_005, many.pct_diff_gt_010) == (100.0, 0.0)


def test_median_of_a_whole_area(spark):
    new, old = [(i * 37 % 101) / 101 for i in range(101)], [(i * 53 % 101) / 101 for i in range(101)]
    frames = [spark.createDataFrame([("A", 0, i, v) for i, v in enumerate(values)], CELL) for values in (new, old)]
    got = compare.compare_cells(*frames, ["aoi"], ["row_idx", "col_idx"]).first()
    assert got.median_abs_diff == pytest.approx(median(abs(a - b) for a, b in zip(new, old, strict=True)))


@pytest.fixture
def pairs(spark):
    rows = [("A", 0, 0, 5, 5), ("A", 0, 1, 6, 4), ("A", 0, 2, 7, 0), ("A", 5, 5, 9, 0), ("A", 5, 6, 9, 0), ("A", 9, 9, 3, 0), ("A", 9, 0, 0, 8), ("A", 9, 1, 0, 0)]
    return spark.createDataFrame(rows, "aoi string, row_idx int, col_idx int, doy_new int, doy_old int")


def test_burned_counts_and_fill(spark, pairs):
    r = compare.compare_burned(pairs, ["aoi"], dims.grid_dim(spark, dims.BLOCK_GRID).withColumn("aoi", F.lit("A")).limit(1)).first()
    assert (r.n_burned_new, r.n_burned_old, r.n_overlap, r.n_only_new, r.n_only_old, r.mean_abs_diff_days) == (6, 3, 2, 4, 1, 1.0)
    n = spark.createDataFrame([("A", 0, 0, -1)], "aoi string, row_idx int, col_idx int, burn_date int")
    o = spark.createDataFrame([("A", 0, 0, 4), ("A", 0, 1, None)], "aoi string, row_idx int, col_idx int, burn_date int")
    got = {(x.col_idx): (x.doy_new, x.doy_old) for x in compare.burn_pairs(n, o, ["aoi", "row_idx", "col_idx"]).collect()}
    assert got == {0: (0, 4), 1: (0, 0)}


def test_clusters(spark, pairs):
    sizes = compare.cluster_sizes(compare.burned_clusters(pairs, ["aoi"], 8), ["aoi"])
    r = compare.cluster_classes(sizes, ["aoi"]).first()
    assert (r.n_only_new, r.n_isolated, r.n_mixed, r.n_all_new, r.verdict) == (4, 1, 1, 2, "no_majority")
    kinds = {x.kind: (x.n_clusters, x.median_size) for x in compare.cluster_size_classes(sizes, ["aoi"]).collect()}
    assert kinds == {"mixed": (1, 3), "only_new": (2, 1)}
    curve = {x.min_size: x.cells_kept for x in compare.min_cluster_curve(sizes, ["aoi"]).collect()}
    assert curve == {1: 6, 2: 5, 3: 3, 4: 0, 5: 0, 10: 0}


@pytest.mark.parametrize("ratios,verdict", [([1.3, 1.4, 1.5], "constant"), ([1.0, 9.0, 1.0, 0.1], "erratic"), ([1.0, 1.2, 1.6], "increasing"),
                                            ([1.2, 1.0, 1.5, 0.9, 1.4], "mixed"), ([1.0, 2.0], None)])
def test_temporal_verdicts(spark, ratios, verdict):
    df = spark.createDataFrame([("A", 2000 + i, v) for i, v in enumerate(ratios)] + [("A", 2050, None)], "aoi string, year int, ratio double")
    got = compare.temporal_ratio(df, ["aoi"]).collect()
    assert [g.verdict for g in got] == ([verdict] if verdict else [])


def test_match_invariants_and_verdicts(spark):
    rows = [("A", 1, 1, 1), ("A", 2, 2, 2), ("A", 3, None, 3), ("A", None, 9, 4), ("A", None, None, 5)]
    aligned = spark.createDataFrame(rows, "aoi string, a int, b int, c int")
    m = compare.pairwise_match(aligned, ["a", "b", "c"], ["aoi"])
    for r in m.collect():
        assert 0 <= r.jaccard <= 1 and r.n_a == r.n_overlap + r.n_only_a and r.n_b == r.n_overlap + r.n_only_b
    ab = m.where("source_a = 'a' AND source_b = 'b'").first()
    assert (ab.n_overlap, ab.mad_days, ab.jaccard) == (2, 0.0, 0.5)
    # Every cell of a is in c on the same day, and b does not match better: a is a subset of c.
    assert compare.subset_verdict(m, "a", "b", "c", ["aoi"]).first().verdict == "strict_subset"


def test_spaced_sample_covers_both_ends(spark):
    cells = spark.createDataFrame([("A", i // 10, i % 10) for i in range(95)] + [("B", 0, 3)], "aoi string, row_idx int, col_idx int")
    got = {}
    for r in compare.sample_spaced(cells, ["aoi"], 5).orderBy("aoi", "sample").collect():
        got.setdefault(r.aoi, []).append(r.row_idx * 10 + r.col_idx)
    assert got == {"A": [0, 23, 47, 70, 94], "B": [3]}


def test_seeded_sample_repeats(spark):
    cells = spark.createDataFrame([("A", i, i) for i in range(100)], "aoi string, row_idx int, col_idx int")
    pick = lambda seed: sorted(compare.sample_seeded(cells, ["aoi"], ["row_idx", "col_idx"], 7, seed).collect())
    assert len(pick(42)) == 7 and pick(42) == pick(42) != pick(43)
