import random
import re
from statistics import median

import numpy as np
import pytest

from veldcube.operators.order_stats import edge_bucket, exact_percentiles, quantile_edges


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = [("hot", rng.uniform(-1, 1)) for _ in range(3000)]
    out += [("ties", rng.choice([0.25, 0.5])) for _ in range(101)]
    out += [("cluster", 0.3 + 1e-9 * i) for i in range(50)]
    out += [("wide", v) for v in (-7.0, 0.0, 9.0, 11.0)]
    out += [("one", 0.1), ("gaps", None), ("gaps", 0.4), ("gaps", 0.2), ("empty", None)]
    return out


def exact_percentile(df, keys, value, out, fraction=0.5, value_range=(-1.0, 1.0)):
    return exact_percentiles(df, keys, value, {out: fraction}, value_range)


@pytest.mark.parametrize("value_range", [(-1.0, 1.0), None])
def test_several_fractions_equal_numpy(spark, rows, value_range):
    df = spark.createDataFrame(rows, "k string, x double")
    fractions = {"a": 0.5, "b": 0.25, "c": 0.02, "d": 0.98, "e": 0.0, "f": 1.0}
    got = {r.k: r for r in exact_percentiles(df, ["k"], "x", fractions, value_range).collect()}
    for k in {r[0] for r in rows}:
        values = [v for n, v in rows if n == k and v is not None]
        for out, fraction in fractions.items():
            if not values:
                assert got[k][out] is None
            else:
                assert got[k][out] == pytest.approx(np.quantile(values, fraction), abs=1e-12)


def test_one_plan_for_any_size(spark, rows, tmp_path):
    """Same operators for few and for many rows: nothing but the data differs."""
    shape = lambda df: re.findall(r"\b(?:\w*)(Exchange|Window|Sort|HashAggregate|Join|Union)\b", exact_percentile(df, ["k"], "x", "p")._jdf.queryExecution().sparkPlan().toString())
    few = spark.createDataFrame(rows, "k string, x double")
    many = spark.range(3_000_000).selectExpr("cast(id % 3 as string) k", "rand(1) x")
    few.write.parquet(a := str(tmp_path / "few"))
    many.write.parquet(b := str(tmp_path / "many"))
    assert shape(spark.read.parquet(a)) == shape(spark.read.parquet(b))


def test_buckets_from_the_data_are_balanced(spark):
    df = spark.range(20_000).selectExpr("1 / (rand(5) - 0.5) x")  # heavy tails
    edges = quantile_edges(df, "x")
    sizes = [r["count"] for r in df.groupBy(edge_bucket(df.x, edges).alias("b")).count().collect()]
    assert max(sizes) <= 2 * 20_000 / (len(edges) + 1)


def test_null_keys_are_a_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 0.0), ("a", 0.5)], "k string, x double")
    assert {r.k: r.p for r in exact_percentile(df, ["k"], "x", "p").collect()} == {None: 0.5, "a": 0.5}


def test_no_group_goes_through_one_window_by_key_alone(spark, rows):
    df = spark.createDataFrame(rows, "k string, x double")
    plan = exact_percentile(df, ["k"], "x", "p")._jdf.queryExecution().executedPlan().toString()
    # Windows over the key alone see bucket counts, never values.
    assert "collect_list" not in plan and "percentile(" not in plan


def test_median_of_even_count(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.4), ("a", 0.2), ("a", 0.9)], "k string, x double")
    assert exact_percentile(df, ["k"], "x", "p").first().p == pytest.approx(median([0.1, 0.4, 0.2, 0.9]))


def test_composite_reads_the_observations_once(spark, sf_dir):
    from veldcube.plans.cube import Cube

    df = Cube(spark, sf_dir).cells
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scans = re.findall(r"FileScan parquet \[[^\]]*l_orderkey", plan)
    # One aggregate: neither a second reader of the observations nor a window over them.
    assert len(scans) == 1 and "Window" not in plan
