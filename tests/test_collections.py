import json
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from veldcube.functions.columns import lonlat_to_utm35s
from veldcube.sources import collections


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="spark-test-", dir="/tmp")


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "331b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


NAMES = ["plain", "a } b", '{"x": [1, {"y": "}"}]}', "quote \" and \\", "\\\\", "ends with \\", "}", "{", "]} , {\"type\"", "été 漢字 }", ""]


def collection(rng, n):
    def square(size):
        x, y = round(rng.uniform(20, 30), 4), round(rng.uniform(-20, -10), 4)
        return [[x, y], [x + size, y], [x + size, y - size], [x, y - size], [x, y]]

    features = []
    for k in range(n):
        parts = [[square(1)] + [square(0.1)] * rng.randrange(3) for _ in range(1 + rng.randrange(3))]
        shape = {"type": "Polygon", "coordinates": parts[0]} if len(parts) == 1 else {"type": "MultiPolygon", "coordinates": parts}
        features.append({"type": "Feature", "properties": {"name": NAMES[k % len(NAMES)], "k": k, "more": {"deep": [1, {"z": "}"}]}}, "geometry": shape})
    return {"type": "FeatureCollection", "name": "lay{er}", "features": features}


def vertices(doc):
    out = {}
    for k, f in enumerate(doc["features"]):
        shape = f["geometry"]
        for part, rings in enumerate([shape["coordinates"]] if shape["type"] == "Polygon" else shape["coordinates"]):
            for ring, points in enumerate(rings):
                for seq, (x, y) in enumerate(points):
                    out[(k, part, ring, seq)] = (x, y, f["properties"]["name"])
    return out


def found(rows):
    return {(r.polygon_id, r.part, r.ring_id, r.seq): (r.lon, r.lat, r.properties["name"]) for r in rows}


@pytest.mark.parametrize("indent", [None, 1])
def test_collection_of_many_splits(spark, folder, small_splits, indent):
    doc = collection(random.Random(3), 60)
    with open(f"{folder}/Area_One_Bare_ground_2023.geojson", "w") as f:
        json.dump(doc, f, indent=indent, ensure_ascii=False)
    assert spark.read.option("lineSep", "}").text(folder).rdd.getNumPartitions() > 20
    got = collections.read_collections(spark, folder).collect()
    want = vertices(doc)
    assert len(got) == len(want) and found(got) == want
    assert {r.layer for r in collections.read_collections(spark, folder, r"Area_One_(.+)_\d{4}\.geojson$").collect()} == {"Bare_ground"}


def test_members_around_the_features_are_skipped(spark, folder):
    one = collection(random.Random(5), 3)
    first = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:OGC:1.3:CRS84"}}, "bbox": [1, 2, 3, 4],
             "features": one["features"], "links": {"a": [{"b": {"c": 1}}]}}
    empty = {"type": "FeatureCollection", "features": []}
    points = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"name": "p"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}]}
    for name, doc in (("A_Crops_2023", first), ("A_Water_2023", empty), ("A_Trees_2023", points)):
        with open(f"{folder}/{name}.geojson", "w") as f:
            f.write(json.dumps(doc) + "\n\n")
    got = collections.read_collections(spark, folder).collect()
    assert {r.layer for r in got} == {"Crops"} and found(got) == vertices(one)
    assert collections.feature_texts(spark, folder).count() == 4


def test_metres_become_degrees(spark, folder):
    corners = [(26.0, -14.0), (26.5, -14.0), (26.5, -14.5), (26.0, -14.0)]
    rows = spark.createDataFrame([("a", 0, 0, i, x, y) for i, (x, y) in enumerate(corners)], "id string, part int, ring_id int, seq int, lon double, lat double")
    east, north = lonlat_to_utm35s(F.col("lon"), F.col("lat"))
    metres = rows.select("id", "part", "ring_id", "seq", east.alias("lon"), north.alias("lat"))
    collections.write_collections(collections.shape_features(metres, ["id"], ["id"]), folder, F.lit("A_Crops_2023.geojson"), epsg=32735)
    got = {r.seq: (r.lon, r.lat) for r in collections.read_collections(spark, folder).collect()}
    assert all(got[i] == pytest.approx(p, abs=1e-8) for i, p in enumerate(corners))
    collections.write_collections(collections.shape_features(metres, ["id"], ["id"]), folder, F.lit("A_Crops_2023.geojson"), epsg=3857)
    with pytest.raises(Exception, match="EPSG:3857"):
        collections.read_collections(spark, folder).collect()


def test_written_parts_are_collections(spark, folder):
    rows = spark.createDataFrame([(f"id {k}", k % 2, ring, seq, float(k), float(seq)) for k in range(40) for ring in range(2) for seq in range(4)],
                                 "id string, part int, ring_id int, seq int, lon double, lat double")
    shapes = collections.shape_features(rows, ["id"], ["id"])
    collections.write_collections(shapes, folder, F.concat(F.lit("B_"), F.when(F.col("id") < "id 2", "Crops").otherwise("Water"), F.lit("_2023.geojson")), parts=3)
    import glob
    files = [f for f in glob.glob(f"{folder}/**/*.txt", recursive=True)]
    docs = [json.load(open(f)) for f in files]
    assert len(files) == 6 and sum(len(d["features"]) for d in docs) == 40
    back = collections.read_collections(spark, folder).collect()
    assert {(r.properties["id"], r.layer) for r in back} == {(f"id {k}", "Crops" if f"id {k}" < "id 2" else "Water") for k in range(40)} and len(back) == 320


def test_files_stay_whole_when_partitions_are_merged(spark, tmp_path):
    """Small partitions are merged by adaptive execution; a file's head, features and tail stay together."""
    names = ("spark.sql.adaptive.coalescePartitions.parallelismFirst", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(n) for n in names]
    try:
        spark.conf.set(names[0], "false")
        spark.conf.set(names[1], "20000")
        box = "[[[26.0,-14.0],[26.1,-14.0],[26.1,-14.1],[26.0,-14.0]]]"
        text = F.concat(F.lit('{"type":"Feature","properties":{"n":'), F.col("id").cast("string"),
                        F.lit(f'}},"geometry":{{"type":"Polygon","coordinates":{box}}}}}'))
        rows = spark.range(4000).select("id", F.concat(F.lit("A"), F.col("id") % 5).alias("area"), text.alias("feature")).repartition(4, "id")
        collections.write_collections(rows, f"{tmp_path}/c", F.concat_ws("_", "area", F.lit("Crops_2023.geojson")), parts=4)
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)
    for file in tmp_path.glob("c/*/*/*.txt"):
        assert json.loads(file.read_text())["type"] == "FeatureCollection"
    assert collections.read_collections(spark, f"{tmp_path}/c").count() == 16_000
