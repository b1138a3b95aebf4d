"""GeoJSON polygon layers as vertex tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FEATURE = "struct<type:string,properties:map<string,string>,geometry:struct<type:string,coordinates:string>>"


def _vertices(features: DataFrame, keep: list[str]) -> DataFrame:
    """Polygon and MultiPolygon coordinates to (keep, polygon_id, part, ring_id, seq, lon, lat)."""
    text = F.col("geometry.coordinates")
    multi = F.when(
        F.col("geometry.type") == "MultiPolygon", F.from_json(text, "array<array<array<array<double>>>>")
    ).otherwise(F.array(F.from_json(text, "array<array<array<double>>>")))
    parts = features.select(*keep, "polygon_id", F.posexplode(multi).alias("part", "rings"))
    rings = parts.select(*keep, "polygon_id", "part", F.posexplode("rings").alias("ring_id", "points"))
    points = rings.select(*keep, "polygon_id", "part", "ring_id", F.posexplode("points").alias("seq", "p"))
    return points.select(*keep, "polygon_id", "part", "ring_id", "seq", F.col("p")[0].alias("lon"), F.col("p")[1].alias("lat"))


def read_geojson(spark: SparkSession, path: str, class_pattern: str = r"_([A-Z][A-Za-z_]*?)_\d{4}\.geojson$") -> DataFrame:
    """Vertices of FeatureCollection files; the class is taken from the file name."""
    schema = f"features array<{_FEATURE}>"
    raw = spark.read.schema(schema).option("multiLine", "true").json(path).withColumn("file", F.col("_metadata.file_path"))
    features = raw.select(F.regexp_extract("file", class_pattern, 1).alias("layer"), F.posexplode("features").alias("polygon_id", "f"))
    return _vertices(features.select("layer", "polygon_id", F.col("f.properties").alias("properties"), F.col("f.geometry").alias("geometry")), ["layer"])


def read_feature_lines(spark: SparkSession, path: str, id_property: str) -> DataFrame:
    """Vertices of files with one feature per line; splits like any text source."""
    schema = "type string, properties map<string,string>, geometry struct<type:string,coordinates:string>"
    lines = spark.read.schema(schema).json(path)
    return _vertices(
        lines.select(F.col("properties")[id_property].alias("polygon_id"), "properties", "geometry"), ["properties"]
    )


def polygon_features(vertices: DataFrame, keys: list[str]) -> DataFrame:
    """One feature line per polygon from (keys, ring_id, seq, lon, lat). A feature is one record."""
    point = F.struct("seq", "lon", "lat")
    ring = F.transform(F.array_sort(F.collect_list(point)), lambda p: F.array(p["lon"], p["lat"]))
    rings = vertices.groupBy(*keys, "ring_id").agg(ring.alias("ring"))
    shapes = rings.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("ring_id", "ring"))), lambda r: r["ring"]).alias("coordinates")
    )
    geometry = F.struct(F.lit("Polygon").alias("type"), F.col("coordinates"))
    return shapes.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*keys).alias("properties"), geometry.alias("geometry"))).alias("value"))


def write_features(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)
