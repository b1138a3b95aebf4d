import math

import pytest
from pyspark.sql import functions as F

from veldcube.functions import columns


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


def test_two_sided_p_value_matches_erfc(spark):
    zs = [0.0, 0.3, -1.0, 1.96, 2.5758, -4.0, 7.0]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    for r in df.select("z", columns.normal_cdf_complement_two_sided(F.col("z")).alias("p")).collect():
        assert r.p == pytest.approx(math.erfc(abs(r.z) / math.sqrt(2)), rel=2e-7)


def test_cell_areas_cover_the_ellipsoid(spark):
    rows = spark.range(180).select(columns.row_area(F.col("id"), F.lit(90.0), F.lit(360.0), F.lit(-1.0)).alias("a"))
    assert rows.agg(F.sum("a")).first()[0] == pytest.approx(510065621.724, rel=1e-9)


def test_ring_area_agrees_with_the_cell_area(spark):
    corners = [(26.0, -14.0), (26.005, -14.0), (26.005, -14.005), (26.0, -14.005), (26.0, -14.0)]
    terms = [columns.edge_area_term(*[F.lit(v) for v in (*a, *b)]) for a, b in zip(corners, corners[1:])]
    ring = abs(sum(one(spark, t) for t in terms))
    cell = one(spark, columns.row_area(F.lit(0), F.lit(-14.0), F.lit(0.005), F.lit(-0.005)))
    assert ring == pytest.approx(cell, rel=1e-8)
    assert cell == pytest.approx(0.2985, rel=0.01)


def test_utm_known_points_and_round_trip(spark):
    # On the central meridian the easting is the false easting and the equator the false northing.
    east, north = columns.lonlat_to_utm35s(F.lit(27.0), F.lit(0.0))
    assert one(spark, east) == pytest.approx(500000.0) and one(spark, north) == pytest.approx(10000000.0)
    # Meridian arc from the equator to 10 degrees south, times the scale factor.
    _, north = columns.lonlat_to_utm35s(F.lit(27.0), F.lit(-10.0))
    assert 10000000.0 - one(spark, north) == pytest.approx(0.9996 * 1105854.833, abs=0.01)
    df = spark.range(400).select((24.0 + F.col("id") % 20 * 0.3).alias("lon"), (-33.0 + F.floor(F.col("id") / 20) * 1.7).alias("lat"))
    east, north = columns.lonlat_to_utm35s(F.col("lon"), F.col("lat"))
    there = df.select("lon", "lat", east.alias("e"), north.alias("n"))
    lon, lat = columns.utm35s_to_lonlat(F.col("e"), F.col("n"))
    gap = there.agg(F.max(F.abs(lon - F.col("lon"))), F.max(F.abs(lat - F.col("lat")))).first()
    assert max(gap) < 1e-9


def test_invalid_values_become_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (-9999.0,), (2e6,), (None,)], "v double")
    assert [r[0] for r in df.select(columns.null_invalid(F.col("v"), -9999.0)).collect()] == [1.0, None, None, None, None]


def test_normalized_difference_without_light(spark):
    assert one(spark, columns.normalized_difference(F.lit(0.0), F.lit(0.0))) is None
    assert one(spark, columns.normalized_difference(F.lit(3.0), F.lit(1.0))) == 0.5
