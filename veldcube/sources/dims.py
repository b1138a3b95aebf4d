"""Small dimension tables: grids, land cover, polygons, phenology profiles, sensors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veldcube.functions import fixed

# Study areas of the adapter view.
AOIS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]

# Grid corner and cell size in degrees.
BLOCK_GRID = {"west": 26.0, "north": -14.0, "dx": 0.005, "dy": -0.005, "n_rows": 8, "n_cols": 8}
STRIP_GRID = {"west": 26.0, "north": -14.0, "dx": 0.0005, "dy": -0.0005, "n_rows": 20000, "n_cols": 8}
SHIFTED_GRID = {"west": 26.0007, "north": -14.0009, "dx": 0.004, "dy": -0.004, "n_rows": 10, "n_cols": 10}

# Phenology profiles by name prefix of the study area. Window bounds are inclusive
# months. Order matters: the first prefix that matches wins.
PHENOLOGY_PROFILES = [
    # key, class, green-up from/to, baseline month, green-up rise, lowest rise,
    # peak from/to, peak delta, senescence from/to, senescence level
    ("Zambia", "Crops", 11, 12, 10, 0.08, 0.03, 1, 3, 0.05, 4, 6, 0.30),
    ("Zambia", "Rangeland", 10, 12, 9, 0.05, 0.02, 1, 3, 0.04, 4, 7, 0.20),
    ("AFR", "Crops", 11, 12, 10, 0.08, 0.03, 1, 3, 0.05, 4, 6, 0.30),
    ("AFR", "Rangeland", 10, 12, 9, 0.05, 0.02, 1, 3, 0.04, 4, 7, 0.20),
    ("AS", "Crops", 11, 12, 10, 0.08, 0.03, 1, 3, 0.05, 4, 6, 0.30),
    ("AS", "Rangeland", 10, 12, 9, 0.05, 0.02, 1, 3, 0.04, 4, 7, 0.20),
    ("A", "Crops", 9, 12, 8, 0.06, 0.02, 2, 4, 0.05, 5, 7, 0.10),
]

# Test polygons on the block grid; rings are closed. No vertex latitude equals a
# cell-centre latitude. polygon "notched" is concave, "holed" has a hole, "wedge" overlaps both.
POLYGONS = {
    ("aoi", 1): [[(26.0011, -14.0007), (26.0391, -14.0013), (26.0383, -14.0389), (26.0213, -14.0191), (26.0017, -14.0381), (26.0011, -14.0007)]],
    ("Crops", 2): [
        [(26.0021, -14.0031), (26.0379, -14.0019), (26.0361, -14.0367), (26.0033, -14.0353), (26.0021, -14.0031)],
        [(26.0111, -14.0109), (26.0237, -14.0117), (26.0229, -14.0243), (26.0119, -14.0231), (26.0111, -14.0109)],
    ],
    ("Rangeland", 3): [[(26.0131, -14.0051), (26.0397, -14.0203), (26.0127, -14.0311), (26.0131, -14.0051)]],
    ("Rangeland", 4): [[(26.0101, -14.0091), (26.0203, -14.0087), (26.0211, -14.0187), (26.0097, -14.0179), (26.0101, -14.0091)]],
}

# First month each sensor is expected from.
SENSOR_START = [("sentinel2", 500, "1995-01-01"), ("burned_area", 500, "1995-01-01")]


def grid_dim(spark: SparkSession, grid: dict, resolution: int = 500) -> DataFrame:
    rows = [(aoi, resolution, *[grid[k] for k in ("west", "north", "dx", "dy", "n_rows", "n_cols")]) for aoi in AOIS]
    return spark.createDataFrame(
        rows, "aoi string, resolution int, west double, north double, dx double, dy double, n_rows int, n_cols int"
    )


def aoi_classes(spark: SparkSession) -> DataFrame:
    """Classes mapped in each study area."""
    return spark.createDataFrame([(a, c) for a in AOIS for c in fixed.LAND_COVER], "aoi string, land_cover string")


def land_cover_cells(spark: SparkSession) -> DataFrame:
    """Cell to class on the block grid: class index is the cell index modulo the class count."""
    rows = [(r, c, fixed.LAND_COVER[(r * 8 + c) % len(fixed.LAND_COVER)]) for r in range(8) for c in range(8)]
    return spark.createDataFrame(rows, "row_idx int, col_idx int, land_cover string")


def ring_vertices(spark: SparkSession) -> DataFrame:
    """The test polygons, in every study area."""
    rows = [
        (aoi, layer, polygon, ring, seq, lon, lat)
        for aoi in AOIS
        for (layer, polygon), rings in POLYGONS.items()
        for ring, vertices in enumerate(rings)
        for seq, (lon, lat) in enumerate(vertices)
    ]
    return spark.createDataFrame(
        rows, "aoi string, layer string, polygon_id int, ring_id int, seq int, lon double, lat double"
    )


def phenology_profiles(spark: SparkSession) -> DataFrame:
    keys = list(dict.fromkeys(p[0] for p in PHENOLOGY_PROFILES))
    rows = [(keys.index(p[0]), *p) for p in PHENOLOGY_PROFILES]
    return spark.createDataFrame(
        rows,
        "profile_order int, profile_key string, land_cover string, green_up_lo int, green_up_hi int, "
        "baseline_month int, green_up_threshold double, conf_lo_min double, peak_lo int, peak_hi int, "
        "peak_delta double, sen_lo int, sen_hi int, sen_threshold double",
    )
