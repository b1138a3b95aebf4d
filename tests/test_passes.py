"""Queries of several products read the observations once."""

import pytest

from veldcube.plans.catalog import QUERIES
from veldcube.plans.cube import Cube
from veldcube.sources import adapter


@pytest.mark.parametrize("name", [
    "q3_timeseries_table", "d5_symmetric_delta_range", "k1_check_schema", "k3_check_ranges", "k4_check_all_null", "k9_check_stage_means",
    "v8_cluster_classes", "v12_qa_stratify", "v13_reliable_window", "v18_regression_baselines", "g15_distance_to_nearest", "b16_frp_patches"])
def test_observations_are_read_once(spark, sf_dir, monkeypatch, name):
    scene_obs = adapter.scene_obs
    reads = spark.sparkContext.accumulator(0)
    lines = scene_obs(spark, sf_dir, Cube(spark, sf_dir).rows).count()

    def tallied(*args, **kwargs):
        obs = scene_obs(*args, **kwargs)

        def tally(batches):
            for batch in batches:
                reads.add(batch.num_rows)
                yield batch

        return obs.mapInArrow(tally, obs.schema)

    monkeypatch.setattr(adapter, "scene_obs", tallied)
    QUERIES[name](spark, sf_dir).collect()
    assert reads.value == lines
