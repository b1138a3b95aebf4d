"""Domain constants that results depend on. Change none of them."""

# Sentinel-2 scene-classification classes that hide the ground, and the
# shorter list used by the older composites.
MASKED_SCL = [1, 2, 3, 7, 8, 9, 10, 11]
LEGACY_MASKED_SCL = [1, 7, 8, 9, 10, 11]
MAX_SUMMARY_QA = 1
NDVI_SCALE = 0.0001
MAX_CLOUD_PCT = 100
MAX_ABS_VALUE = 1e6

# Land-cover classes, in alphabetical order.
LAND_COVER = [
    "Bare_ground",
    "Built_Area",
    "Crops",
    "Flooded_vegetation",
    "Rangeland",
    "Trees",
    "Water",
]
PHENOLOGY_CLASSES = ["Crops", "Rangeland"]

# Thresholds of the annual analytics.
MONTHS_PER_YEAR = 12
MIN_TREND_YEARS = 5
MIN_SEASONAL_MONTHS = 60
SIGNIFICANCE = 0.05
Z_95 = 1.96
SEVERITY = [("Severe", -0.15), ("Moderate", -0.10), ("Mild", -0.05)]
NO_RECOVERY_PENALTY = 12
SPATIAL_CHANGE = 0.02
FRP_BUCKETS = [("lt_3", 3), ("lt_7", 7), ("lt_15", 15)]

# Comparison and check thresholds.
MIN_OVERLAP = 10
DISTANCE_BINS = [0, 1, 2, 3, 5, 10, 20, 50]
CLUSTER_MIN_SIZES = [1, 2, 3, 4, 5, 10]
GRID_TOLERANCE = 1e-8
REGRESSION_TOLERANCE = 0.005
SNAPSHOT_TOLERANCE = 0.001
RECOMPUTE_TOLERANCE = 0.01
SIMPLIFY_METRES = 50.0
VALUE_RANGES = {
    "mean_ndvi": (-1.0, 1.0),
    "anomaly_value": (-2.0, 2.0),
    "n_valid_px": (0.0, None),
    "burned_km2": (0.0, None),
}

# WGS84 ellipsoid.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
KM_PER_DEGREE = 111.32

# UTM zone 35 south (central meridian 27 E).
UTM_LON0 = 27.0
UTM_K0 = 0.9996
UTM_E0 = 500000.0
UTM_N0 = 10000000.0

# Output columns of every product table.
PRODUCT_COLUMNS = {
    "ndvi_monthly": ["aoi", "sensor", "resolution", "year", "month", "mean_ndvi", "n_valid_px"],
    "ndvi_monthly_by_class": [
        "aoi", "sensor", "resolution", "year", "month", "land_cover", "mean_ndvi", "n_valid_px",
    ],
    "ba_monthly": [
        "aoi", "resolution", "year", "month", "burned_km2",
        "ba_mean", "ba_lower_ci", "ba_upper_ci", "n_years",
    ],
    "ba_daily": ["aoi", "resolution", "year", "date", "burned_km2"],
    "ndvi_anomaly_monthly": [
        "aoi", "sensor", "resolution", "year", "month", "land_cover",
        "anomaly_value", "mean_ndvi", "hist_mean",
    ],
}
FLOAT_COLUMNS = {
    "ndvi_monthly": ["mean_ndvi"],
    "ndvi_monthly_by_class": ["mean_ndvi"],
    "ba_monthly": ["burned_km2", "ba_mean", "ba_lower_ci", "ba_upper_ci"],
    "ba_daily": ["burned_km2"],
    "ndvi_anomaly_monthly": ["anomaly_value", "mean_ndvi", "hist_mean"],
}
