"""Patches of equal-valued cells: labels, outlines and simplification."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veldcube.functions.columns import edge_area_term
from veldcube.functions.session import cut_lineage, spread

BLOCK = 256
SHIFT = 1 << 31
SALTS = 16
ONE_TASK_VERTICES = 1_000_000
#: Vertices of short rings that a task takes together, about.
BUCKET_VERTICES = 200_000


def cell_id(row: str = "row_idx", col: str = "col_idx"):
    return F.col(row).cast("long") * F.lit(SHIFT) + F.col(col)


def _label_block(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, diagonal: bool, block: int) -> np.ndarray:
    """Smallest cell number of each patch inside one block of at most block x block cells.

    Labels are positions in the block: the smallest label around, then the label of that label.
    """
    width = block + 2
    place = (rows % block + 1) * width + cols % block + 1
    codes = np.full(width * width, -1)
    codes[place] = np.unique(values, return_inverse=True)[1]
    labels = np.arange(width * width)
    steps = [1, width] + ([width + 1, width - 1] if diagonal else [])
    pairs = [(place[ok], place[ok] + s) for s in steps for ok in [codes[place] == codes[place + s]]]
    while True:
        before = labels.copy()
        for a, b in pairs:
            low = np.minimum(labels[a], labels[b])
            np.minimum.at(labels, labels[a], low)
            np.minimum.at(labels, labels[b], low)
            np.minimum.at(labels, a, low)
            np.minimum.at(labels, b, low)
        labels = labels[labels]
        if (labels == before).all():
            break
    first = np.zeros(width * width, dtype=np.int64)
    first[place] = rows.astype(np.int64) * SHIFT + cols
    return first[labels[place]]


def connected_components(cells: DataFrame, keys: list[str], value: str, connectivity: int = 4, block: int = BLOCK) -> DataFrame:
    """Label patches of equal `value`; the label is the patch's first cell in row order.

    Blocks of the grid are labelled on their own (a bounded group each). Only pairs of block labels
    that touch across a block border go through the iteration: smallest neighbour label, then the
    label of that label, so rounds grow with the logarithm of the patch diameter in blocks.
    Each block label has a bounded number of neighbours; the label lookup is salted because most of
    a huge patch asks for the same label.
    """
    diagonal = connectivity == 8
    base = cells.select(*keys, "row_idx", "col_idx", F.col(value).alias("value")).where("value IS NOT NULL")
    fields = [f for f in base.schema.fields]

    def label(group: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf["label"] = _label_block(
            pdf["row_idx"].to_numpy(), pdf["col_idx"].to_numpy(), pdf["value"].to_numpy(), diagonal, block
        )
        return pdf[[f.name for f in fields] + ["label"]]

    boxed = base.withColumn("_br", F.floor(F.col("row_idx") / block)).withColumn("_bc", F.floor(F.col("col_idx") / block))
    schema = T.StructType([*fields, T.StructField("label", T.LongType())])
    labelled = cut_lineage(spread(boxed, *keys, "_br", "_bc").groupBy(*keys, "_br", "_bc").applyInPandas(label, schema))

    # Cells on the last row or column of a block (and the first column, for diagonals) look outwards.
    r, c = F.col("row_idx") % block, F.col("col_idx") % block
    rim = labelled.where((r == block - 1) | (c == block - 1) | (r == 0) | (c == 0))
    steps = [(0, 1), (1, 0)] + ([(1, 1), (1, -1)] if diagonal else [])
    look = rim.select(
        *keys, "row_idx", "col_idx", "value", F.col("label").alias("a"),
        F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in steps])).alias("o"),
    ).select(
        *keys, (F.col("row_idx") + F.col("o.i")).alias("row_idx"), (F.col("col_idx") + F.col("o.j")).alias("col_idx"), "value", "a"
    )
    touching = look.join(rim.select(*keys, "row_idx", "col_idx", "value", F.col("label").alias("b")),
                         [*keys, "row_idx", "col_idx", "value"]).where("a <> b").select(*keys, "a", "b").distinct()
    edges = cut_lineage(touching.unionByName(touching.select(*keys, F.col("b").alias("a"), F.col("a").alias("b"))))
    roots = cut_lineage(edges.select(*keys, F.col("a").alias("node")).distinct().withColumn("root", F.col("node")))
    while True:
        around = edges.join(roots.select(*keys, F.col("node").alias("b"), "root"), [*keys, "b"]).groupBy(*keys, "a").agg(
            F.min("root").alias("near")
        )
        step = roots.join(around.withColumnRenamed("a", "node"), [*keys, "node"]).select(
            *keys, "node", F.least("root", "near").alias("root"), (F.col("near") < F.col("root")).alias("moved")
        )
        salt = F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")
        lookup = roots.select(
            *keys, F.col("node").alias("root"), F.col("root").alias("up"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        )
        jumped = step.withColumn("salt", salt).join(lookup, [*keys, "root", "salt"]).select(
            *keys, "node", F.least("root", "up").alias("root"), "moved"
        )
        jumped = cut_lineage(jumped)
        roots = jumped.drop("moved")
        if jumped.where("moved").isEmpty():
            break
    return labelled.join(roots.withColumnRenamed("node", "label"), [*keys, "label"], "left").select(
        *keys, "row_idx", "col_idx", "value", F.coalesce("root", "label").alias("component_id")
    )


def patch_edges(components: DataFrame, keys: list[str]) -> DataFrame:
    """Boundary edges of each patch, directed with the patch on the right.

    Corners are (x, y) = (column, row) lattice points; direction 0 east, 1 south, 2 west, 3 north.
    An edge shared by two cells of a patch is counted twice and drops out.
    """
    r, c = F.col("row_idx"), F.col("col_idx")
    sides = F.array(*[
        F.struct((c + x).alias("x"), (r + y).alias("y"), F.lit(d).alias("d"),
                 (c + lx).alias("lx"), (r + ly).alias("ly"), F.lit(v).alias("v"))
        # start corner, direction, and the undirected side: its upper or left corner and orientation
        for x, y, d, lx, ly, v in ((0, 0, 0, 0, 0, 0), (1, 0, 1, 1, 0, 1), (1, 1, 2, 0, 1, 0), (0, 1, 3, 0, 0, 1))
    ])
    e = components.select(*keys, "component_id", F.explode(sides).alias("e"))
    return e.groupBy(*keys, "component_id", "e.lx", "e.ly", "e.v").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("e.x", "e.y", "e.d")).alias("s")
    ).where("n = 1").select(*keys, "component_id", "s.x", "s.y", "s.d")


def patch_outline(components: DataFrame, keys: list[str]) -> DataFrame:
    """Boundary edges of each patch in ring order: keys, component_id, ring_id, seq, x, y, d, corner.

    (x, y) is the start corner of the unit edge, `corner` marks a change of direction there. Rings run
    clockwise around the patch and the other way around its holes; `seq` orders a ring from 0.

    Edges are ranked by pointer doubling: each round doubles how far an edge sees along its ring, so
    no task ever holds a whole ring. Where a patch meets itself at a corner the ring turns right and
    stays with its cell, as four-connected patches do.
    """
    key = [*keys, "component_id"]
    eid = (F.col("y").cast("long") * F.lit(SHIFT) + F.col("x")) * 4 + F.col("d")
    edges = cut_lineage(patch_edges(components, keys).withColumn("edge", eid))
    nx = F.col("x") + F.when(F.col("d") == 0, 1).when(F.col("d") == 2, -1).otherwise(0)
    ny = F.col("y") + F.when(F.col("d") == 1, 1).when(F.col("d") == 3, -1).otherwise(0)
    ends = edges.select(*key, "edge", "d", nx.alias("x"), ny.alias("y"))
    starts = edges.select(*key, "x", "y", F.col("edge").alias("to"), F.col("d").alias("to_d"))
    turn = F.pmod(F.col("to_d") - F.col("d"), F.lit(4))
    follow = cut_lineage(
        ends.join(starts, [*key, "x", "y"]).groupBy(*keys, "edge", "d").agg(
            F.min_by(F.struct("to"), F.when(turn == 1, 0).when(turn == 0, 1).otherwise(2)).alias("n")
        )
    )
    # first: smallest edge seen ahead; ahead: steps to its nearest occurrence.
    walk = follow.select(
        *keys, "edge", F.col("n.to").alias("next"), F.col("edge").alias("first"), F.lit(0).cast("long").alias("ahead")
    )
    reach = 1
    while True:
        far = walk.select(*keys, F.col("edge").alias("next"), F.col("next").alias("next2"),
                          F.col("first").alias("first2"), F.col("ahead").alias("ahead2"))
        nearer = F.col("first") <= F.col("first2")
        step = cut_lineage(walk.join(far, [*keys, "next"]).select(
            *keys, "edge", F.col("next2").alias("next"),
            F.least("first", "first2").alias("first"),
            F.when(nearer, F.col("ahead")).otherwise(F.col("ahead2") + reach).alias("ahead"),
            (~nearer).alias("moved"),
        ))
        walk = step.drop("moved")
        reach *= 2
        if step.where("moved").isEmpty():
            break
    before = follow.select(*keys, F.col("n.to").alias("edge"), F.col("d").alias("from_d"))
    sizes = walk.groupBy(*keys, "first").agg(F.count(F.lit(1)).alias("size"))
    ranked = walk.join(sizes, [*keys, "first"]).select(
        *keys, "edge", F.col("first").alias("ring_id"), F.pmod(F.col("size") - F.col("ahead"), F.col("size")).alias("seq"),
        "size",
    )
    return edges.join(ranked, [*keys, "edge"]).join(before, [*keys, "edge"]).select(
        *key, "ring_id", "seq", "size", "x", "y", "d", (F.col("d") != F.col("from_d")).alias("corner")
    )


def ring_totals(outline: DataFrame, keys: list[str]) -> DataFrame:
    """Signed shoelace area in cells (holes negative), boundary length and corners of each ring."""
    x2 = F.col("x") + F.when(F.col("d") == 0, 1).when(F.col("d") == 2, -1).otherwise(0)
    y2 = F.col("y") + F.when(F.col("d") == 1, 1).when(F.col("d") == 3, -1).otherwise(0)
    return outline.groupBy(*keys, "component_id", "ring_id").agg(
        (F.sum(F.col("x") * y2 - x2 * F.col("y")) / 2).alias("area_cells"),
        F.count(F.lit(1)).alias("length"),
        F.sum(F.col("corner").cast("int")).alias("n_corners"),
    )


def outline_area(outline: DataFrame, keys: list[str], grid: DataFrame) -> DataFrame:
    """Geodesic km2 of each patch from its outline; `keys` include aoi."""
    placed = outline.join(grid.select("aoi", "west", "north", "dx", "dy"), "aoi")
    x2 = F.col("x") + F.when(F.col("d") == 0, 1).when(F.col("d") == 2, -1).otherwise(0)
    y2 = F.col("y") + F.when(F.col("d") == 1, 1).when(F.col("d") == 3, -1).otherwise(0)

    def lon(x):
        return F.col("west") + x * F.col("dx")

    def lat(y):
        return F.col("north") + y * F.col("dy")

    term = edge_area_term(lon(F.col("x")), lat(F.col("y")), lon(x2), lat(y2))
    return placed.groupBy(*keys, "component_id").agg(F.abs(F.sum(term)).alias("area_km2"))


def ring_vertices(outline: DataFrame, keys: list[str], grid: DataFrame) -> DataFrame:
    """Corners of the outlines as closed lon/lat rings: keys, component_id, ring_id, seq, lon, lat."""
    corners = outline.where("corner")
    key = [*keys, "component_id", "ring_id"]
    first = corners.groupBy(*key).agg(F.min(F.struct("seq", "x", "y")).alias("f"), F.max("size").alias("size"))
    # The closing vertex repeats the first one, a whole turn later.
    closing = first.select(*key, (F.col("f.seq") + F.col("size")).alias("seq"), F.col("f.x").alias("x"), F.col("f.y").alias("y"))
    every = corners.select(*key, "seq", "x", "y").unionByName(closing)
    return every.join(grid.select("aoi", "west", "north", "dx", "dy"), "aoi").select(
        *key, "seq", (F.col("west") + F.col("x") * F.col("dx")).alias("lon"), (F.col("north") + F.col("y") * F.col("dy")).alias("lat")
    )


def _keep_masks(starts: np.ndarray, x: np.ndarray, y: np.ndarray, tolerance: float, closed: bool = True) -> np.ndarray:
    """Vertices that closed rings (or open lines) keep. Rings lie one after another from `starts`; the open segments of all
    of them are split level by level."""
    ends = np.append(starts[1:], len(x)) - 1
    keep = np.zeros(len(x), dtype=bool)
    keep[starts] = keep[ends] = True
    lo, hi, ring, depth = starts, ends, np.arange(len(starts)), 0
    while True:
        wide = hi - lo >= 2
        lo, hi, ring = lo[wide], hi[wide], ring[wide]
        if not len(lo):
            return keep
        n = hi - lo - 1
        first = np.cumsum(n) - n
        seg = np.repeat(np.arange(len(lo)), n)
        at = np.arange(len(seg)) + (lo + 1 - first)[seg]
        vx, vy = (x[hi] - x[lo])[seg], (y[hi] - y[lo])[seg]
        px, py = x[at] - x[lo][seg], y[at] - y[lo][seg]
        length2 = vx * vx + vy * vy
        t = np.clip((px * vx + py * vy) / np.where(length2 > 0, length2, 1.0), 0.0, 1.0)
        t[length2 == 0] = 0.0
        gap = np.sqrt((px - t * vx) ** 2 + (py - t * vy) ** 2)
        far = np.maximum.reduceat(gap, first)
        # The first of the farthest vertices of each segment.
        hits = np.flatnonzero(gap == far[seg])
        split = at[hits[np.unique(seg[hits], return_index=True)[1]]]
        go = far > tolerance
        if closed and depth == 0:
            go[:] = True
        elif closed and depth == 1:
            order = np.lexsort((lo, -far, ring))
            go[order[np.unique(ring[order], return_index=True)[1]]] = True
        lo, split, hi, ring = lo[go], split[go], hi[go], ring[go]
        keep[split] = True
        lo, hi, ring, depth = np.append(lo, split), np.append(split, hi), np.append(ring, ring), depth + 1


def simplify_rings(vertices: DataFrame, keys: list[str], tolerance: float = 50.0, one_task: int = ONE_TASK_VERTICES, closed: bool = True) -> DataFrame:
    """Douglas-Peucker on closed rings with metric coordinates (keys, seq, x, y, ...): vertices kept.

    Rings of at most `one_task` vertices are simplified inside tasks, many rings in lockstep, since most are
    short; longer ones by splitting all their segments at once. Both keep the same vertices: a ring's two widest splits
    always stay, so it never falls below a closed triangle. Lines that are not `closed` may become straight.
    """
    sizes = vertices.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total, longest = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).first()
    schema = vertices.schema

    def many_rings(pdf: pd.DataFrame) -> pd.DataFrame:
        ring = pdf.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
        order = np.lexsort((pdf["seq"].to_numpy(), ring))
        pdf, ring = pdf[schema.names].iloc[order], ring[order]
        starts = np.flatnonzero(np.append(True, ring[1:] != ring[:-1]))
        return pdf[_keep_masks(starts, pdf["x"].to_numpy(), pdf["y"].to_numpy(), tolerance, closed)]

    def in_tasks(df: DataFrame) -> DataFrame:
        buckets = max(total // BUCKET_VERTICES, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
        return spread(dealt, "_bucket").groupBy("_bucket").applyInPandas(many_rings, schema)

    if longest <= one_task:
        return in_tasks(vertices)
    long = sizes.where(F.col("_n") > one_task).drop("_n")
    return in_tasks(vertices.join(long, keys, "left_anti")).unionByName(
        simplify_long_rings(vertices.join(long, keys, "left_semi"), keys, tolerance, closed))


def simplify_long_rings(vertices: DataFrame, keys: list[str], tolerance: float, closed: bool = True) -> DataFrame:
    """`simplify_rings` for rings too long for a task.

    Every round finds the farthest vertex of all open segments at once (a combinable aggregate) and
    splits or closes them, so a ring of any length stays spread over tasks.
    """
    other = [c for c in vertices.columns if c not in (*keys, "seq", "x", "y")]
    point = F.struct("seq", "x", "y", *other)
    spots = vertices.select(*keys, "seq", point.alias("p"))
    ends = spots.groupBy(*keys).agg(F.min("p").alias("lo"), F.max("p").alias("hi"))
    kept = [cut_lineage(ends.select(*keys, F.explode(F.array("lo", "hi")).alias("p")))]
    salt = F.pmod(F.xxhash64("seq"), F.lit(SALTS)).cast("int")

    def salted(df: DataFrame) -> DataFrame:
        return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))

    active = spots.withColumn("salt", salt).join(salted(ends), [*keys, "salt"]).where(
        (F.col("seq") > F.col("lo.seq")) & (F.col("seq") < F.col("hi.seq"))
    ).drop("salt")
    for depth in range(1 << 30):
        vx, vy = F.col("hi.x") - F.col("lo.x"), F.col("hi.y") - F.col("lo.y")
        px, py = F.col("p.x") - F.col("lo.x"), F.col("p.y") - F.col("lo.y")
        length2 = vx * vx + vy * vy
        t = F.when(length2 > 0, F.least(F.greatest((px * vx + py * vy) / length2, F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
        gap = F.sqrt(F.pow(px - t * vx, 2) + F.pow(py - t * vy, 2))
        active = cut_lineage(active.withColumn("gap", gap))
        if active.isEmpty():
            break
        segment = [*keys, "lo_seq"]
        marked = active.withColumn("lo_seq", F.col("lo.seq"))
        widest = marked.groupBy(*segment).agg(
            F.max("gap").alias("far"), F.max_by("p", F.struct("gap", -F.col("seq"))).alias("split")
        )
        limit = F.col("far") > tolerance
        if closed and depth == 0:
            limit = F.lit(True)
        elif closed and depth == 1:
            top = widest.groupBy(*keys).agg(F.max(F.struct(F.col("far"), (-F.col("lo_seq")).alias("at"))).alias("top"))
            widest = widest.join(top, keys)
            limit = limit | (F.col("lo_seq") == -F.col("top.at"))
        splits = cut_lineage(widest.where(limit).select(*segment, "split"))
        kept.append(splits.select(*keys, F.col("split").alias("p")))
        joined = marked.withColumn("salt", salt).join(salted(splits), [*segment, "salt"]).where(F.col("seq") != F.col("split.seq"))
        left = F.col("seq") < F.col("split.seq")
        active = joined.select(
            *keys, "seq", "p", F.when(left, F.col("lo")).otherwise(F.col("split")).alias("lo"),
            F.when(left, F.col("split")).otherwise(F.col("hi")).alias("hi"),
        )
    whole = kept[0]
    for part in kept[1:]:
        whole = whole.unionByName(part)
    return whole.select(*keys, "p.*")


def vertex_area(vertices: DataFrame, keys: list[str], step: int = 100_000) -> DataFrame:
    """Geodesic km2 per `keys` from closed lon/lat rings (keys, ring_id, seq, lon, lat) whose holes
    turn the other way.

    The next vertex is looked up within stretches of `step` positions; only the first vertex of each
    stretch is compared across a ring.
    """
    ring = [*keys, "ring_id"]
    part = vertices.select(*ring, "seq", "lon", "lat", F.floor(F.col("seq") / step).alias("stretch"))
    here = Window.partitionBy(*ring, "stretch").orderBy("seq")
    firsts = part.groupBy(*ring, "stretch").agg(F.min(F.struct("seq", "lon", "lat")).alias("f"))
    over = firsts.select(*ring, "stretch", F.lead("f").over(Window.partitionBy(*ring).orderBy("stretch")).alias("f"))
    pairs = part.withColumn("n", F.lead(F.struct("seq", "lon", "lat")).over(here)).join(over, [*ring, "stretch"]).withColumn(
        "n", F.coalesce("n", "f")
    )
    term = edge_area_term(F.col("lon"), F.col("lat"), F.col("n.lon"), F.col("n.lat"))
    return pairs.where("n IS NOT NULL").groupBy(*keys).agg(F.abs(F.sum(term)).alias("area_km2"))


def patch_features(vertices: DataFrame, keys: list[str], properties: DataFrame) -> DataFrame:
    """One GeoJSON feature line per patch from its closed lon/lat rings.

    A feature is one record by definition, so its outline is gathered per patch here and only here.
    """
    key = [*keys, "component_id"]
    ring = F.transform(F.array_sort(F.collect_list(F.struct("seq", "lon", "lat"))), lambda p: F.array(p["lon"], p["lat"]))
    rings = vertices.groupBy(*key, "ring_id").agg(ring.alias("ring"))
    # The ring with the smallest edge of the patch is the outer one and comes first.
    shapes = rings.groupBy(*key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("ring_id", "ring"))), lambda r: r["ring"]).alias("coordinates")
    )
    named = [c for c in properties.columns if c != "component_id"]
    geometry = F.struct(F.lit("Polygon").alias("type"), F.col("coordinates"))
    return shapes.join(properties, key).select(
        *key, F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*named).alias("properties"), geometry.alias("geometry"))).alias("feature")
    )
