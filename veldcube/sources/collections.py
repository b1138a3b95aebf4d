"""FeatureCollection layers of any size: written as valid files in parts, read by byte ranges.

A collection is one JSON value, often on one line, so neither lines nor whole files are units to
read it by. Files are split at closing braces instead, which works from any byte range; how deep each
piece lies, and whether it starts inside a string, follows from running totals, and a feature is what lies
between two places where the depth comes back to that of the features array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veldcube.functions.columns import utm35s_to_lonlat
from veldcube.functions.session import cut_lineage

FEATURE = "type string, properties map<string,string>, geometry struct<type:string,coordinates:string>"
#: Class in the name of a file or of a folder of parts: area_Class_year.geojson.
CLASS_PATTERN = r"_([A-Z][A-Za-z_]*?)_\d{4}\.geojson(?:/|$)"
#: Reference systems by EPSG number, WGS84 and UTM zone 35 south.
WGS84, UTM35S = 4326, 32735

_STRING = r'"(?:[^"\\]++|\\.)*+'
_TO_BRACE = rf'(?:[^"{{]++|{_STRING}")*+\{{'


def _outside_strings(text: Column) -> Column:
    return F.regexp_replace(text, rf'{_STRING}(?:"|\z)', "")


def _count(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))


def _before(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Add each value's sum over all pieces of the file that come before: inside a byte range by a window, over
    ranges by their totals, which are few."""
    inside = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    df = df.select("*", *[v.alias(f"_{k}") for k, v in values.items()])
    totals = df.groupBy("file", "block").agg(*[F.sum(f"_{k}").alias(f"_{k}_all") for k in values])
    offsets = totals.select("file", "block", *[F.coalesce(F.sum(f"_{k}_all").over(earlier), F.lit(0)).alias(f"_{k}_off") for k in values])
    joined = df.join(offsets, ["file", "block"])
    return joined.select(*df.columns, *[(F.coalesce(F.sum(f"_{k}").over(inside), F.lit(0)) + F.col(f"_{k}_off")).alias(k) for k in values])


def feature_texts(spark: SparkSession, path: str) -> DataFrame:
    """Features of the collections below `path` as JSON texts: file, polygon_id (place in the file), feature, epsg
    (of the file, NULL if it names none). Other members of a collection are skipped."""
    raw = spark.read.option("lineSep", "}").option("recursiveFileLookup", "true").text(path)
    # Stored once: places in a byte range must be the same for all that follows.
    pieces = cut_lineage(raw.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("piece")))
    quotes = _count(F.regexp_replace("piece", r"\\.", ""), '"')
    quoted = _before(pieces, {"quotes": quotes})
    inside = F.col("quotes") % 2 == 1
    ends_inside = (F.col("quotes") + F.col("_quotes")) % 2 == 1
    # A piece that starts inside a string gets its opening quote back.
    marked = quoted.withColumn("marked", F.when(inside, F.concat(F.lit('"'), "piece")).otherwise(F.col("piece"))).withColumn("bare", _outside_strings(F.col("marked")))
    braces = _count(F.col("bare"), "{") - F.when(ends_inside, 0).otherwise(1)
    nested = _before(marked, {"depth": braces, "arrays": _count(F.col("bare"), "[") - _count(F.col("bare"), "]")}).drop("bare")
    after = (F.col("depth") + F.col("_depth") == 1) & (F.col("arrays") + F.col("_arrays") == 1) & ~ends_inside
    numbered = _before(nested, {"polygon_id": after.cast("int")})
    # The brace that opens a feature is the second one from the root, and lies in one array.
    head = F.when(F.col("depth") == 1, F.regexp_extract("marked", f"^{_TO_BRACE}", 0)).when(
        F.col("depth") == 0, F.regexp_extract("marked", f"^(?:{_TO_BRACE}){{2}}", 0)).otherwise("")
    opened = numbered.withColumn("head", head)
    bare_head = _outside_strings(F.col("head"))
    start = (F.col("head") != "") & (F.col("arrays") + _count(bare_head, "[") - _count(bare_head, "]") == 1)
    opened = opened.withColumn("start", start)
    part = F.when(F.col("start"), F.concat(F.lit("{"), F.expr("substring(marked, length(head) + 1)"))).otherwise(F.col("piece"))
    ours = opened.where(F.col("start") | ((F.col("depth") >= 2) & (F.col("arrays") >= 1)))
    gathered = ours.groupBy("file", "polygon_id").agg(F.array_sort(F.collect_list(F.struct("block", "at", "start", part.alias("part")))).alias("parts"))
    # What lies before the start is of another member of the collection.
    first = F.array_position(F.transform("parts", lambda p: p["start"]), True)
    texts = F.transform(F.slice("parts", F.col("first"), F.size("parts")), lambda p: p["part"])
    features = gathered.withColumn("first", first.cast("int")).where("first > 0").select(
        "file", "polygon_id", F.concat(F.array_join(texts, "}"), F.lit("}")).alias("feature"))
    number = F.regexp_extract("piece", r'"(?:urn:ogc:def:crs:)?EPSG:[^"]*?(\d+)"', 1)
    systems = opened.where((F.col("depth") <= 2) & (F.col("arrays") <= 1) & ~F.col("start") & (number != "")).groupBy("file").agg(F.max(number.cast("int")).alias("epsg"))
    return features.join(systems, "file", "left").select("file", F.col("polygon_id").cast("int").alias("polygon_id"), "feature", "epsg")


def _degrees(x: Column, y: Column) -> tuple[Column, Column]:
    lon, lat = utm35s_to_lonlat(x, y)
    known = F.coalesce(F.col("epsg"), F.lit(WGS84))
    other = F.raise_error(F.concat(F.lit("unknown reference system EPSG:"), known)).cast("double")
    pick = lambda plain, turned: F.when(known == WGS84, plain).when(known == UTM35S, turned).otherwise(other)
    return pick(x, lon), pick(y, lat)


def read_collections(spark: SparkSession, path: str, class_pattern: str = CLASS_PATTERN) -> DataFrame:
    """Vertices of the polygons and multipolygons below `path`: file, layer (class in the file's name), polygon_id, properties,
    part, ring_id, seq, lon, lat. Coordinates in UTM zone 35 south become degrees; features without a polygon have no rows."""
    texts = feature_texts(spark, path).withColumn("f", F.from_json("feature", FEATURE)).where("f.type = 'Feature'")
    shape, kind = F.col("f.geometry.coordinates"), F.col("f.geometry.type")
    multi = F.when(kind == "MultiPolygon", F.from_json(shape, "array<array<array<array<double>>>>")).when(
        kind == "Polygon", F.array(F.from_json(shape, "array<array<array<double>>>")))
    parts = texts.select("file", F.regexp_extract("file", class_pattern, 1).alias("layer"), "polygon_id", F.col("f.properties").alias("properties"),
                         "epsg", F.posexplode(multi).alias("part", "rings"))
    rings = parts.select("*", F.posexplode("rings").alias("ring_id", "points")).drop("rings")
    points = rings.select("*", F.posexplode("points").alias("seq", "p")).drop("points")
    lon, lat = _degrees(F.col("p")[0], F.col("p")[1])
    return points.select("file", "layer", "polygon_id", "properties", "part", "ring_id", "seq", lon.alias("lon"), lat.alias("lat"))


def shape_features(vertices: DataFrame, keys: list[str], properties: list[str]) -> DataFrame:
    """`keys` and one feature text per polygon of (keys, part, ring_id, seq, lon, lat): a Polygon, or a MultiPolygon if it has
    several parts. A feature is one record by definition, so its outline is gathered here and only here."""
    ordered = lambda place, value: F.transform(F.array_sort(F.collect_list(F.struct(place, value))), lambda e: e[value])
    point = vertices.withColumn("point", F.array("lon", "lat"))
    rings = point.groupBy(*keys, "part", "ring_id").agg(ordered("seq", "point").alias("ring"))
    parts = rings.groupBy(*keys, "part").agg(ordered("ring_id", "ring").alias("rings"))
    shapes = parts.groupBy(*keys).agg(ordered("part", "rings").alias("parts"))
    several = F.size("parts") > 1
    shape = F.when(several, F.to_json("parts")).otherwise(F.to_json(F.col("parts")[0]))
    named = F.to_json(F.struct(*properties))
    kind = F.when(several, "MultiPolygon").otherwise("Polygon")
    return shapes.select(*keys, F.concat(
        F.lit('{"type":"Feature","properties":'), named, F.lit(',"geometry":{"type":"'), kind, F.lit('","coordinates":'), shape, F.lit("}}")).alias("feature"))


def write_collections(features: DataFrame, path: str, name: Column, parts: int = 1, epsg: int | None = None) -> None:
    """Write features (column `feature`) as FeatureCollections: a folder below `path` for each `name`, such as
    Area_Class_2023.geojson, with up to `parts` files that are collections of their own."""
    system = f'"crs":{{"type":"name","properties":{{"name":"urn:ogc:def:crs:EPSG::{epsg}"}}}},' if epsg else ""
    rows = features.select(name.alias("layer"), F.pmod(F.xxhash64("feature"), F.lit(parts)).cast("int").alias("slot"), "feature")
    first = F.row_number().over(Window.partitionBy("layer", "slot").orderBy("feature")) == 1
    # Head and tail come with a file's first feature: a union of lines and edges reports the partitioning of its sides, and
    # adaptive execution then merges the partitions of each side in its own way, which tears the files apart.
    line = lambda place, text: F.struct(F.lit(place).alias("place"), text.alias("value"))
    head, tail = F.lit(f'{{"type":"FeatureCollection",{system}"features":['), F.lit("]}")
    lines = F.when(first, F.array(line(0, head), line(1, F.col("feature")), line(3, tail))).otherwise(
        F.array(line(2, F.concat(F.lit(","), "feature"))))
    whole = rows.withColumn("lines", lines).select("layer", "slot", F.inline("lines"))
    ordered = whole.repartition("layer", "slot").sortWithinPartitions("layer", "slot", "place", "value")
    ordered.select("layer", "slot", "value").write.mode("overwrite").partitionBy("layer", "slot").text(path)
