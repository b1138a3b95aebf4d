"""Near duplicates among embeddings by randomly rotated binary codes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veldcube.llm.common import components, partitions, stored

COSINE = 0.95
#: Share of the pairs at the threshold that may meet in no bucket; pairs above it meet more often.
MISSED = 0.0005
#: Width of the confidence bound of an estimate, in its standard errors.
SIGMAS = 6.0
#: Members of a bucket are compared in blocks of about this size.
BLOCK = 512
#: Buckets up to this size are compared together with others.
FEW = 32


def rotation(dim: int, number: int) -> np.ndarray:
    """Random rotation of `dim` dimensions."""
    q, r = np.linalg.qr(np.random.default_rng([dim, number]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def tables_for(n: int, cosine: float = COSINE, missed: float = MISSED) -> tuple[int, int]:
    """Bits of a bucket key and number of tables for `n` vectors: keys grow with log2 n, so that
    unrelated vectors seldom meet, and there are enough tables for pairs at the threshold."""
    bits = min(60, max(8, math.ceil(math.log2(max(2, n))) + 3))
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(missed) / math.log1p(-meet))


def usable(vectors: DataFrame) -> DataFrame:
    """Rows (row, embedding) whose vector can be compared: not null, without null or non-finite components, not zero."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.coalesce(fine, F.lit(False)) & F.exists("embedding", lambda x: x != 0))


def coded(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """The index: per class its vector, the sign code of the first rotation, its correction factor
    and the bucket keys of all tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        weights = (1 << np.arange(bits, dtype=np.int64))
        for batch in batches:
            embedding = batch.column(2)
            dims = np.diff(embedding.offsets.to_numpy())
            values = embedding.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.concatenate([[0], np.cumsum(dims)[:-1]])
            out: dict[str, list] = {"at": [], "vector": [], "code": [], "factor": [], "keys": []}
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = values[starts[at][:, None] + np.arange(dim)]
                x = x / np.abs(x).max(1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                if dim not in turns:
                    turns[dim] = np.concatenate([rotation(dim, k) for k in range(-(-bits * tables // dim))])
                turned = x @ turns[dim].T
                signs = turned > 0
                keys = (signs[:, : bits * tables].reshape(len(at), tables, bits) @ weights) ^ (np.int64(dim) << 40 if bits < 40 else 0)
                out["at"].append(at)
                out["vector"] += [v.tobytes() for v in x]
                out["code"] += [c.tobytes() for c in np.packbits(signs[:, :dim], axis=1)]
                out["factor"].append(np.abs(turned[:, :dim]).sum(1) / math.sqrt(dim))
                out["keys"] += list(keys)
            order = np.argsort(np.concatenate(out["at"]), kind="stable") if out["at"] else np.empty(0, np.int64)
            pick = lambda x: [x[i] for i in order]
            keys = pick(out["keys"])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(pick(out["vector"]), pa.binary()), pa.array(pick(out["code"]), pa.binary()),
                pa.array(np.concatenate(out["factor"])[order] if out["factor"] else [], pa.float64()),
                pa.array(keys, pa.list_(pa.int64())) if keys else pa.array([], pa.list_(pa.int64()))],
                ["node", "size", "vector", "code", "factor", "keys"])

    return classes.select("node", "size", "embedding").mapInArrow(
        run, "node long, size long, vector binary, code binary, factor double, keys array<long>")


class Rows:
    """Members of buckets, in arrays; all of one dimension."""

    def __init__(self, batch: pa.RecordBatch):
        take = lambda name: batch.column(batch.schema.get_field_index(name))
        self.group = np.stack([take(c).to_numpy(zero_copy_only=False) for c in ("t", "key", "i", "j")], 1)
        self.t, self.i, self.j = self.group[:, 0], self.group[:, 2], self.group[:, 3]
        self.block, self.node, self.size = (take(c).to_numpy(zero_copy_only=False) for c in ("block", "node", "size"))
        raw = take("vector").to_pylist()
        self.dims = np.array([len(x) // 8 for x in raw])
        self.x = [np.frombuffer(x) for x in raw]
        self.codes = take("code").to_pylist()
        self.factor = take("factor").to_numpy(zero_copy_only=False)
        self.keys = np.array(take("keys").to_pylist(), np.int64).reshape(len(raw), -1)


def _within(rows: Rows, a: np.ndarray, b: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs of rows (a, b) those at the threshold that no earlier table has."""
    wanted = ((rows.i[a] == rows.j[a]) | (rows.block[a] != rows.block[b])) & (rows.dims[a] == rows.dims[b])
    a, b = a[wanted], b[wanted]
    if not len(a):
        return a, b
    kept_a, kept_b = [], []
    for dim in np.unique(rows.dims[a]):
        mine = rows.dims[a] == dim
        for s in range(0, int(mine.sum()), 1 << 16):
            p, q = a[mine][s : s + (1 << 16)], b[mine][s : s + (1 << 16)]
            used, back = np.unique(np.concatenate([p, q]), return_inverse=True)
            x = np.stack([rows.x[k] for k in used])
            signs = np.unpackbits(np.stack([np.frombuffer(rows.codes[k], np.uint8) for k in used]), axis=1)[:, :dim] * 2.0 - 1
            turned = x @ rotation(int(dim), 0).T
            ip, iq = back[: len(p)], back[len(p) :]
            # The estimate of the code is unbiased; its error is bounded by the correction factor.
            f = rows.factor[p]
            estimate = np.einsum("ij,ij->i", signs[ip], turned[iq]) / math.sqrt(dim) / f
            bound = SIGMAS * np.sqrt(np.maximum(0, 1 - f * f)) / f / math.sqrt(max(1, dim - 1))
            open_ = estimate + bound >= cosine
            p, q, ip, iq = p[open_], q[open_], ip[open_], iq[open_]
            hit = np.einsum("ij,ij->i", x[ip], x[iq]) >= cosine
            p, q = p[hit], q[hit]
            earlier = (rows.keys[p] == rows.keys[q]) & (np.arange(rows.keys.shape[1]) < rows.t[p][:, None])
            new = ~earlier.any(1)
            kept_a.append(p[new])
            kept_b.append(q[new])
    return np.concatenate(kept_a), np.concatenate(kept_b)


def _candidates(rows: Rows) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows inside the groups, many at a time."""
    n = len(rows.node)
    new = np.any(rows.group[1:] != rows.group[:-1], axis=1) if n > 1 else np.empty(0, bool)
    starts = np.concatenate([[0], np.flatnonzero(new) + 1])
    sizes = np.diff([*starts, n])
    rest = np.repeat(starts + sizes, sizes) - np.arange(n)  # members from a row on to its group's end
    small = np.repeat(sizes <= FEW, sizes)
    for step in range(1, min(FEW, int(sizes.max(initial=0)))):
        a = np.flatnonzero(small & (rest > step))
        if len(a):
            yield a, a + step
    for start, size in zip(starts[sizes > FEW], sizes[sizes > FEW], strict=True):
        a, b = np.triu_indices(size, 1)
        yield a + start, b + start


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row that each of `n` rows is joined to by the links (a, b)."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if np.array_equal(label, before):
            return label


def bucket_links(members: DataFrame, cosine: float) -> DataFrame:
    """Per bucket block and class the number of vectors newly linked (node, links) and a class that it
    is joined to (root). Pairs are counted in the first table in which they meet and never leave the task."""

    def settle(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = Rows(batch)
        found = [_within(rows, a, b, cosine) for a, b in _candidates(rows)]
        a = np.concatenate([x for x, _ in found]) if found else np.empty(0, np.int64)
        b = np.concatenate([x for _, x in found]) if found else np.empty(0, np.int64)
        links = np.zeros(len(rows.node), np.int64)
        np.add.at(links, a, rows.size[b])
        np.add.at(links, b, rows.size[a])
        root = rows.node[_forest(len(rows.node), a, b)] if len(a) else rows.node
        at = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays([pa.array(rows.node[at]), pa.array(links[at]), pa.array(root[at])], ["node", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = lambda x, k: tuple(x.column(c)[k].as_py() for c in range(4))
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(x.num_rows for x in held) < 8 * BLOCK or last(held[0], 0) == last(batch, -1):
                continue
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            end, cut = last(whole, -1), whole.num_rows - 1
            while cut and last(whole, cut - 1) == end:
                cut -= 1
            yield settle(whole.slice(0, cut))
            held = [whole.slice(cut)]
        if held:
            yield settle(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return members.mapInArrow(run, "node long, links long, root long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Links between vectors of cosine >= `cosine`: vec_id, n_links, component_id, kept.

    Every row is indexed. Equal vectors are one class with a size. Classes that share a bucket in some
    table are compared: the code's estimate and its bound rule out most, the rest is computed exactly
    in double precision. Buckets are cut into blocks by hash and the pairs of blocks spread over
    tasks, so that a bucket of any size is compared in full. A pair at the threshold meets in a bucket
    with probability 1 - MISSED, a closer one more often; none below the threshold is linked.

    Null, empty and zero vectors and those with null or non-finite components have no links; vectors
    of different lengths are not compared. Rows may repeat and ids may be null (they count as larger than any
    id). Other columns are not read. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = stored(vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding")), "vectors")
    grouped = usable(rows).groupBy("embedding").agg(F.min("row").alias("node"), F.count("*").alias("size"))
    classes = stored(grouped, "classes")
    bits, tables = tables_for(classes.count(), cosine)
    index = stored(coded(classes, bits, tables), "index")
    placed = index.select("node", F.posexplode("keys").alias("t", "key"))
    met = placed.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1")
    several = placed.join(met, ["t", "key"])
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    blocked = several.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    spread = blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.col("t").cast("long").alias("t"), "key", F.least("block", "other").cast("long").alias("i"),
        F.greatest("block", "other").cast("long").alias("j"), F.col("block").cast("long").alias("block"), "node")
    members = spread.join(index, "node").select("t", "key", "i", "j", "block", "node", "size", "vector", "code", "factor", "keys")
    found = stored(bucket_links(
        members.repartition(partitions(spark), "t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j"), cosine), "links")
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.filter("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = classes.join(linked, "node", "left").join(joined, "node", "left").select(
        "embedding", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    member = usable(rows).join(known, "embedding").select("row", "n_links", "component")
    whole = stored(rows.select("row", "vec_id").join(member, "row", "left").select(
        "row", "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "row").alias("component")), "whole")
    first = whole.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return whole.join(first, "component").select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
