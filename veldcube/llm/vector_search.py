"""Nearest neighbours among embeddings by an adaptive scan of rotated dimensions.

Vectors lie in lists around fitted centres, blocks of a list hold their rotated vectors dimension by
dimension, and a scan gives up candidates as soon as a test on their partial distances allows it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veldcube.llm.common import partitions, stored

NEIGHBOURS = 10
#: Queries are the rows whose id this number divides.
EVERY = 100
#: Bounds of the sample that centres and number of probes are fitted on: rows, and numbers in them.
SAMPLE_ROWS = 30_000
SAMPLE_VALUES = 4_000_000
#: Share of the true neighbours that the probed lists hold, on the sample.
RECALL = 0.985
#: Sampled vectors that the number of probes is fitted with, and those that a centre takes at least.
PROBING, PER_CENTRE = 400, 32
#: Vectors of a block, queries of a chunk, dimensions of a column block.
BLOCK, CHUNK, WIDTH = 1024, 128, 16
#: Width of the test on partial distances: the chance to give up a neighbour falls with exp(-EPSILON^2).
EPSILON = 2.5
#: Keys that hold more than one row in this many are looked up by broadcast, so there are fewer of them than that.
HOT = 100

BLOCKS = "dim int, list int, block long, nodes binary, firsts binary, columns array<binary>, vectors binary"
CHUNKS = "dim int, list int, queries binary, limits binary, points binary"


@dataclass
class Lists:
    """Centres of the vectors of one dimension and the number of lists that a query probes."""

    centres: np.ndarray
    probes: int

    def order(self, x: np.ndarray, count: int) -> np.ndarray:
        """The `count` nearest lists of each vector, nearest first."""
        far = (self.centres**2).sum(1) - 2 * x @ self.centres.T
        if count == 1:
            return far.argmin(1)[:, None]
        return np.argsort(far, axis=1, kind="stable")[:, :count]


def fit_lists(sample: np.ndarray, n: float, neighbours: int, recall: float = RECALL) -> Lists:
    """Centres for `n` vectors by Lloyd's rounds on a sample, and the fewest probes that find `recall` of
    the sample's own neighbours. More vectors lie closer, so that the whole table needs no more probes."""
    rng = np.random.default_rng(len(sample))
    count = max(1, min(round(math.sqrt(n) / 2), len(sample) // PER_CENTRE))
    centres = sample[rng.choice(len(sample), count, replace=False)]
    for _ in range(8 if count > 1 else 0):
        at = np.concatenate([Lists(centres, 1).order(x, 1)[:, 0] for x in np.array_split(sample, -(-len(sample) // 4096))])
        sizes = np.bincount(at, minlength=count)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, sample)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    lists = Lists(centres, count)
    at = np.concatenate([lists.order(x, 1)[:, 0] for x in np.array_split(sample, -(-len(sample) // 4096))])
    found = np.zeros(count)
    for q in np.array_split(rng.choice(len(sample), min(PROBING, len(sample)), replace=False), 8):
        far = (sample**2).sum(1) - 2 * sample[q] @ sample.T
        far[np.arange(len(q)), q] = np.inf
        near = np.argpartition(far, min(neighbours, len(sample) - 1) - 1, axis=1)[:, :neighbours] if len(sample) > 1 else q[:, None]
        rank = np.argsort(lists.order(sample[q], count), axis=1)
        found += np.bincount(np.take_along_axis(rank, at[near], 1).ravel(), minlength=count)
    return Lists(centres, int(np.searchsorted(found.cumsum(), recall * found.sum())) + 1)


def usable(vectors: DataFrame) -> DataFrame:
    """Rows whose `embedding` takes part: not null or empty, without null or non-finite components, not zero."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter((F.size("embedding") > 0) & F.coalesce(fine, F.lit(False)) & F.exists("embedding", lambda x: x != 0))


def by_dimension(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of a column of vectors: each dimension, the rows that have it, and their values."""
    dims = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(dims)[:-1]]).astype(np.int64)
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        yield int(dim), at, values[starts[at][:, None] + np.arange(dim)]


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def fitted(classes: DataFrame, neighbours: int, recall: float) -> dict[int, Lists]:
    """Lists of each dimension, fitted on a sample of the distinct vectors, drawn by hash."""
    n, values = classes.agg(F.count("*"), F.sum(F.size("embedding"))).first()
    if not n:
        return {}
    share = min(1.0, SAMPLE_ROWS / n, SAMPLE_VALUES / values)
    drawn = classes if share == 1 else classes.filter(F.pmod(F.xxhash64("embedding"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = drawn.select("embedding").toArrow().column(0).combine_chunks()
    if len(sample) == 0:
        return {}
    scale = n / len(sample)
    return {dim: fit_lists(x.astype(np.float64), len(at) * scale, neighbours, recall) for dim, at, x in by_dimension(sample)}


def index_blocks(classes: DataFrame, lists: dict[int, Lists]) -> DataFrame:
    """The index, a row for each block of a list (BLOCKS). Rows are range-sorted by list and node, so a list
    of any size is spread over tasks and none is held whole."""
    spark = classes.sparkSession
    shipped = spark.sparkContext.broadcast(lists)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, at_list = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int32)
            for dim, at, x in by_dimension(batch.column(2)):
                dims[at] = dim
                if dim in shipped.value:
                    at_list[at] = shipped.value[dim].order(x.astype(np.float64), 1)[:, 0]
            yield pa.RecordBatch.from_arrays([pa.array(dims), pa.array(at_list), *batch.columns], ["dim", "list", "node", "first", "embedding"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            dims, at_list, node, first = (batch.column(k).to_numpy() for k in range(4))
            cuts = np.flatnonzero((dims[1:] != dims[:-1]) | (at_list[1:] != at_list[:-1])) + 1
            ends = np.concatenate([cuts, [batch.num_rows]]) if batch.num_rows else np.empty(0, np.int64)
            start, rows = 0, []
            for end in ends.astype(int):
                while start < end:
                    stop = min(end, start + BLOCK)
                    (dim, _, x), *_ = by_dimension(batch.column(4).slice(start, stop - start))
                    if dim not in turns:
                        turns[dim] = rotation(dim)
                    turned = np.ascontiguousarray((x.astype(np.float64) @ turns[dim]).T)
                    rows.append((dim, int(at_list[start]), int(node[start]), node[start:stop].tobytes(), first[start:stop].tobytes(),
                                 [turned[d : d + WIDTH].tobytes() for d in range(0, dim, WIDTH)], x.tobytes()))
                    start = stop
            yield as_batch(rows, BLOCKS)

    kind = classes.schema["embedding"].dataType.simpleString()
    placed = classes.select("node", "first", "embedding").mapInArrow(place, f"dim int, list int, node long, first long, embedding {kind}")
    ranged = placed.repartitionByRange(partitions(spark), "dim", "list", "node").sortWithinPartitions("dim", "list", "node")
    return ranged.mapInArrow(pack, BLOCKS)


ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary()), "double": pa.float64()}


def as_batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(c.split(" ") for c in schema.split(", ")), strict=True)
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), ARROW[k]) for c, k in zip(columns, kinds, strict=True)], list(names))


def query_chunks(points: DataFrame, lists: dict[int, Lists], first: bool) -> DataFrame:
    """Queries (node, embedding, upto) sent to the lists that they probe, many in a row (CHUNKS): to their
    nearest list, or to all others of their probes."""
    shipped = points.sparkSession.sparkContext.broadcast(lists)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, upto = batch.column(0).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)
            for dim, at, x in by_dimension(batch.column(1)):
                mine = shipped.value.get(dim)
                order = mine.order(x.astype(np.float64), mine.probes) if mine else np.zeros((len(at), 1), np.int64)
                order = order[:, :1] if first else order[:, 1:]
                of, q = order.ravel(), np.repeat(np.arange(len(at)), order.shape[1])
                by = np.argsort(of, kind="stable")
                of, q = of[by], q[by]
                ends = np.append(np.flatnonzero(of[1:] != of[:-1]) + 1, len(of)) if len(of) else []
                start, rows = 0, []
                for end in ends:
                    for s in range(start, int(end), CHUNK):
                        part = q[s : min(s + CHUNK, int(end))]
                        rows.append((dim, int(of[s]), node[at[part]].tobytes(), upto[at[part]].tobytes(), x[part].tobytes()))
                        if len(rows) == 64:
                            yield as_batch(rows, CHUNKS)
                            rows = []
                    start = int(end)
                yield as_batch(rows, CHUNKS)

    return points.select("node", "embedding", "upto").mapInArrow(run, CHUNKS)


def scan(columns: list[np.ndarray], turned: np.ndarray, limits: np.ndarray, keep: int, epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, vector) of a chunk and a block that may be among the `keep` nearest of their query and
    within its limit. Distances grow by a column block at a time; a pair is given up once its partial
    distance, carried on to all dimensions, exceeds the limit by more than chance explains."""
    dim, n = turned.shape[1], columns[0].shape[1]
    partial = np.zeros((len(turned), n))
    for j in range(len(columns[0])):
        partial += (turned[:, j, None] - columns[0][None, j]) ** 2
    q = r = None
    done = len(columns[0])
    for column in [*columns[1:], None]:
        margin = 1 + epsilon * math.sqrt((1 - done / dim) / done) if done < dim else 1 + 1e-9
        bound = (limits * margin) ** 2 * (done / dim) + 1e-300
        if q is None:
            q, r = np.nonzero(partial <= bound[:, None])
            partial = partial[q, r]
        else:
            near = partial <= bound[q]
            q, r, partial = q[near], r[near], partial[near]
        if column is not None:
            for j in range(len(column)):
                partial += (turned[q, done + j] - column[j, r]) ** 2
            done += len(column)
    if len(q) > keep:  # of each query those up to its keep-th distance, ties included
        order = np.lexsort((partial, q))
        starts = np.flatnonzero(np.append(True, q[order][1:] != q[order][:-1]))
        sizes = np.diff(np.append(starts, len(q)))
        at = partial[order][starts + np.minimum(sizes, keep) - 1]
        cut = np.zeros(len(turned))
        cut[q[order][starts]] = at * (1 + 1e-9) + 1e-300
        near = partial <= cut[q]
        q, r = q[near], r[near]
    return q, r


def nearest_in(index: DataFrame, chunks: DataFrame, keep: int) -> DataFrame:
    """The `keep` nearest classes (query, node, first, score) of each query in the lists that its chunks name,
    none beyond its limit; ties go to the smaller first id."""
    spark = index.sparkSession
    sent = chunks.join(index.select("dim", "list", "block"), ["dim", "list"]).select("block", "queries", "limits", "points")
    n = partitions(spark)
    met = index.select("dim", "block", "nodes", "firsts", "columns", "vectors").repartition(n, "block").join(sent.repartition(n, "block"), "block")
    out = "query long, node long, first long, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            found: list[list[np.ndarray]] = []
            for k in range(batch.num_rows):
                dim = rows["dim"][k].as_py()
                get = lambda name, t=np.int64, k=k: np.frombuffer(rows[name][k].as_py(), t)
                nodes, firsts, queries, limits = get("nodes"), get("firsts"), get("queries"), get("limits", np.float64)
                stored_as = np.dtype(f"f{len(rows['vectors'][k].as_py()) // (dim * len(nodes))}")
                x = get("vectors", stored_as).reshape(-1, dim).astype(np.float64)
                p = get("points", stored_as).reshape(-1, dim).astype(np.float64)
                columns = [np.frombuffer(c.as_py()).reshape(-1, len(nodes)) for c in rows["columns"][k].values]
                if dim not in turns:
                    turns[dim] = rotation(dim)
                q, r = scan(columns, p @ turns[dim], limits, keep)
                score = np.concatenate([np.sqrt(((p[q[s : s + 8192]] - x[r[s : s + 8192]]) ** 2).sum(1)) for s in range(0, len(q), 8192)] or [np.empty(0)])
                near = score <= limits[q]
                q, r, score = q[near], r[near], score[near]
                order = np.lexsort((firsts[r], score, q))
                q, r, score = q[order], r[order], score[order]
                starts = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.empty(0, np.int64)
                place = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
                q, r, score = q[place < keep], r[place < keep], score[place < keep]
                found.append([queries[q], nodes[r], firsts[r], score])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) if found else pa.array([], t) for c, t in zip(
                zip(*found, strict=True) if found else [()] * 4, [pa.int64()] * 3 + [pa.float64()], strict=True)], ["query", "node", "first", "score"])

    return met.select("dim", "nodes", "firsts", "columns", "vectors", "queries", "limits", "points").mapInArrow(run, out)


def first_of(found: DataFrame, keep: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("query").orderBy("score", "first"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= keep)


def looked_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """`rows` joined with `table`, which has each `key` once. Keys that hold more than one row in HOT, fewer
    than HOT of them, are joined by broadcast, so that none of them meets in one task."""
    total = rows.count()
    hot = stored(rows.groupBy(key).agg(F.count("*").alias("__n")).filter(F.col("__n") * HOT > max(total, 10_000)).select(key), "hot")
    wanted = F.broadcast(table.join(F.broadcast(hot), key))
    return rows.join(wanted, key).unionByName(rows.join(F.broadcast(hot), key, "left_anti").join(table, key))


def nearest(vectors: DataFrame, neighbours: int = NEIGHBOURS, every: int = EVERY, recall: float = RECALL,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each row whose id `every` divides, its `neighbours` nearest other rows by Euclidean distance,
    nearest first, ties to the smaller id: query_id, rank, vec_id, score.

    Every row is indexed. Equal vectors are one class, which keeps its neighbours + 1 smallest ids: no
    more of them can be asked for. Centres of the lists and the number of probes are fitted on at most
    about SAMPLE_ROWS vectors. A query first scans its nearest list; the distance of its last neighbour
    there is the limit for the other lists that it probes. Blocks of a list and chunks of its queries are
    separate rows, so a list or a group of queries of any size spreads over tasks. Distances of what
    the test leaves are computed from the original vectors in double precision.

    Null, empty and zero vectors and those with null or non-finite components take no part; vectors of
    other lengths are no neighbours. Ids are integers; null ids are no queries and come last among
    ties. Repeated rows (same id and vector) count once; an id with several vectors is a query for each
    of them, and its own row alone is left out. Fewer candidates than `neighbours` are all returned. An
    empty table gives no rows; other columns are not read.
    """
    keep = neighbours + 1
    last = F.lit((1 << 63) - 1)
    kind = "double" if vectors.schema[vector_col].dataType.simpleString() == "array<double>" else "float"
    plain = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(f"array<{kind}>").alias("embedding"))
    rows = usable(plain).distinct()
    rank = F.row_number().over(W.partitionBy("embedding").orderBy(F.col("vec_id").asc_nulls_last()))
    place = F.coalesce("vec_id", last)
    ids = F.transform(F.array_sort(F.collect_list(F.struct(place.alias("place"), "vec_id"))), lambda x: x["vec_id"])
    grouped = rows.withColumn("rank", rank).filter(F.col("rank") <= keep).groupBy("embedding").agg(ids.alias("ids"))
    classes = stored(grouped.select(F.monotonically_increasing_id().alias("node"), F.coalesce(F.col("ids")[0], last).alias("first"), "ids", "embedding"), "classes")
    asking = stored(usable(plain.filter(F.pmod("vec_id", F.lit(every)) == 0)).distinct(), "asking")
    points = stored(asking.select("embedding").distinct().join(classes, "embedding").select("node", "embedding"), "points")

    lists = fitted(classes, neighbours, recall)
    index = stored(index_blocks(classes, lists), "index")
    nearby = stored(first_of(nearest_in(index, query_chunks(points.withColumn("upto", F.lit(float("inf"))), lists, True), keep), keep), "nearby")
    limits = nearby.filter(F.col("rank") == keep).select(F.col("query").alias("node"), F.col("score").alias("limit"))
    limited = points.join(limits, "node", "left").select("node", "embedding", F.coalesce("limit", F.lit(float("inf"))).alias("upto"))
    beyond = nearest_in(index, query_chunks(limited, lists, False), keep)
    best = stored(first_of(nearby.drop("rank").unionByName(beyond), keep).drop("rank"), "best")

    near = best.join(classes.select("node", "ids"), "node").select("query", "node", "score", F.explode("ids").alias("vec_id"))
    entry = F.struct("score", place.alias("place"), "node", "vec_id")
    answers = near.groupBy("query").agg(F.slice(F.array_sort(F.collect_list(entry)), 1, keep).alias("entries"))
    table = stored(answers.join(points.withColumnRenamed("node", "query"), "query").select("embedding", F.col("query").alias("own"), "entries"), "answers")
    found = looked_up(asking.withColumnRenamed("vec_id", "query_id"), table, "embedding")
    others = F.filter("entries", lambda x: ~(x["vec_id"].eqNullSafe(F.col("query_id")) & (x["node"] == F.col("own"))))
    ranked = found.select("query_id", F.posexplode(F.slice(others, 1, neighbours)).alias("at", "entry"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), F.col("entry.vec_id").alias("vec_id"), F.col("entry.score").alias("score"))
