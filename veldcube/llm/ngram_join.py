"""Self-join of documents on the Jaccard similarity of their word shingles, by adaptive prefixes."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veldcube.functions.session import broadcast_if_small
from veldcube.llm.common import components, numbered, stored
from veldcube.llm.list_links import WORDS, close_enough, list_links

#: log2 of the counters of the frequency sketch. It orders shingles only: a coarse one costs time, never links.
SKETCH_BITS = 22
#: Counters that travel as one row while sketches are added up.
SKETCH_ROW = 1 << 15
#: Longest extension of a prefix that is weighed.
MAX_MATCHES = 8
#: Cost of comparing one shingle in a verification, in units of one posting read.
VERIFY_COST = 0.05
CHUNK_BYTES = 300_000
#: Side tables of 8 bytes a row up to so many rows are broadcast; larger ones are joined by shuffle.
SMALL = 1_000_000

_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_RANDOM.integers(2**62, 2**63, dtype=np.uint64)) * 2 + 1
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of hashed word shingles of texts, many texts at a time.

    Words are cut at ASCII white space and A-Z are lower-cased. A text with fewer words than a
    shingle has its whole sequence as one; a text without words has none.
    """

    def __init__(self, words: int):
        self.words = words
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            steps = np.full(n, _BASE, np.uint64)
            back = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
            steps[0] = back[0] = 1
            self.powers, self.inverses = np.multiply.accumulate(steps), np.multiply.accumulate(back)

    def __call__(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The sorted distinct shingles of each text."""
        piece, size = [], 0
        for text in texts:
            piece.append((text or "").encode("utf-8", "surrogatepass").lower())
            size += len(piece[-1]) + 1
            if size >= CHUNK_BYTES:
                yield from self._sets(piece)
                piece, size = [], 0
        yield from self._sets(piece)

    def _sets(self, piece: list[bytes]) -> Iterator[np.ndarray]:
        if not piece:
            return
        data = np.frombuffer(b"\n" + b"\n".join(piece) + b"\n", np.uint8)
        self._grow(len(data) + 1)
        space = _SPACE[data]
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data] * self.powers[: len(data)], dtype=np.uint64)])
        words = _mixed((sums[ends] - sums[starts]) * self.inverses[starts])
        bounds = np.searchsorted(starts, np.cumsum([0, *(len(x) + 1 for x in piece)]))
        k = self.words
        whole = np.zeros(max(0, len(words) - k + 1), np.uint64)
        for j in range(k):
            whole = _mixed(whole * np.uint64(3) + words[j : j + len(whole)]) if len(whole) else whole
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a >= k:
                yield np.unique(whole[a : b - k + 1])
            elif b > a:
                one = np.full(1, b - a, np.uint64)
                for j in range(a, b):
                    one = _mixed(one * np.uint64(5) + words[j : j + 1])
                yield one
            else:
                yield np.empty(0, np.uint64)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _lists(sets: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets], dtype=np.int64)]).astype(np.int32)
    values = _signed(np.concatenate(sets)) if sets else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _pieces(batch: pa.RecordBatch, rows: int = 200) -> Iterator[pa.RecordBatch]:
    return (batch.slice(i, rows) for i in range(0, batch.num_rows, rows))


def set_sizes(rows: DataFrame, words: int) -> DataFrame:
    """Size and 128-bit digest of each row's shingle set (row, n, h1, h2), and beside them the
    pieces (slot, counts) of the tasks' frequency sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counts, mask = Shingler(words), np.zeros(1 << SKETCH_BITS, np.uint16), np.uint64((1 << SKETCH_BITS) - 1)
        names = ["row", "n", "h1", "h2", "slot", "counts"]
        for batch in batches:
            for piece in _pieces(batch):
                sets = list(shingler(piece.column(1).to_pylist()))
                at, times = np.unique((np.concatenate(sets) & mask).astype(np.int64), return_counts=True)
                counts[at] = np.minimum(counts[at].astype(np.int64) + times, 65_535)
                h1 = [int(_signed(np.bitwise_xor.reduce(_mixed(s), keepdims=True))[0]) for s in sets]
                h2 = [int(_signed(np.add.reduce(_mixed(s ^ np.uint64(0x5851F42D4C957F2D)), keepdims=True))[0]) for s in sets]
                m = len(sets)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                     pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names)
        for slot in range(0, len(counts), SKETCH_ROW):
            part = counts[slot : slot + SKETCH_ROW]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
                     pa.array([slot], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], names)

    return rows.select("row", "text").mapInArrow(run, "row long, n long, h1 long, h2 long, slot int, counts binary")


def add_sketches(parts: DataFrame) -> np.ndarray:
    """The sum of all tasks' sketches; its size is fixed. Sums are formed in two steps, so that no
    task meets the pieces of all tasks."""

    def adder(kind: type) -> Callable[[pa.Table], pa.Table]:
        def add(table: pa.Table) -> pa.Table:
            total = np.zeros(SKETCH_ROW, np.int64)
            for x in table.column("counts"):
                total += np.frombuffer(zlib.decompress(x.as_buffer()), kind)
            packed = zlib.compress(np.minimum(total, 2**31 - 1).astype(np.int32).tobytes(), 1)
            return pa.table({"slot": table.column("slot").slice(0, 1), "counts": pa.array([packed], pa.binary())})

        return add

    salted = parts.select("slot", "counts", (F.rand(3) * 32).cast("int").alias("salt"))
    once = salted.groupBy("slot", "salt").applyInArrow(adder(np.uint16), "slot int, counts binary")
    summed = once.groupBy("slot").applyInArrow(adder(np.int32), "slot int, counts binary").collect()
    sketch = np.zeros(1 << SKETCH_BITS, np.int32)
    for r in summed:
        sketch[r["slot"] : r["slot"] + SKETCH_ROW] = np.frombuffer(zlib.decompress(r["counts"]), np.int32)
    return sketch


def least_overlap(n: int, percent: int) -> int:
    """Shingles that any partner of a set of `n` shares at least."""
    return -(-percent * n // 100)


def choose_prefix(frequencies: np.ndarray, percent: int, floor: float) -> tuple[int, int]:
    """Length of the prefix and number of its shingles that partners must share, for one set.

    `frequencies` are those of the shingles in order. Reading postings costs one unit each; a partner
    that shares l prefix shingles uses up l postings, so at most postings / l partners are verified.
    The extension with the least cost is taken.
    """
    n = len(frequencies)
    overlap = least_overlap(n, percent)
    longest = min(MAX_MATCHES, overlap)
    read = np.cumsum(np.maximum(frequencies[: n - overlap + longest] - floor, 1.0))[n - overlap :]
    matches = np.arange(1, longest + 1)
    best = int((read * (1 + VERIFY_COST * n / matches)).argmin())
    return n - overlap + best + 1, best + 1


def parities(items: np.ndarray, words: int) -> np.ndarray:
    """`words` longs of bits: whether an odd number of items fall to each. Halves of a longer form make the shorter one."""
    odd = np.bincount((items & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def more_words(n: int) -> int:
    """Longs in the larger parities of a set of `n` items, a bit an item or more; 0 if WORDS are enough."""
    words = 1 << max(0, n - 1).bit_length()
    return words // 64 if words > 64 * WORDS else 0


def large_may_link(percent: int) -> Callable[[Column, Column, Column], Column]:
    """Whether the larger parities of two sets leave it open that they are similar."""

    def finer(x: Column, y: Column, sizes: Column) -> Column:
        size = F.least(F.size(x), F.size(y))
        xor = lambda p, q: p.bitwiseXOR(q)
        halved = lambda z: F.zip_with(F.slice(z, F.lit(1), size), F.slice(z, size + 1, size), xor)
        same = lambda z: F.when(F.size(z) == size, z).when(F.size(z) == 2 * size, halved(z))
        bits = F.zip_with(same(x), same(y), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
        # Of sets more than two steps apart in size, which don't get here, nothing is said.
        return F.coalesce(close_enough(F.aggregate(bits, F.lit(0), lambda total, b: total + b), sizes, percent), F.lit(True))

    return finer


def prefixes(rows: DataFrame, sketch: np.ndarray, words: int, percent: int) -> DataFrame:
    """The prefix of each row's set in the order of frequency: row, n, matches, common, prefix; and its parities, words and more."""
    shipped = rows.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen, mask = Shingler(words), shipped.value, np.uint64((1 << SKETCH_BITS) - 1)
        floor = float(np.median(seen[::64]))
        for batch in batches:
            for piece in _pieces(batch):
                sizes, matches, common, kept, told, more = [], [], [], [], [], []
                for s in shingler(piece.column(1).to_pylist()):
                    often = seen[(s & mask).astype(np.int64)]
                    order = np.argsort(often, kind="stable")
                    length, l = choose_prefix(often[order].astype(float), percent, floor) if len(s) else (0, 0)
                    sizes.append(len(s))
                    matches.append(l)
                    common.append(float(np.log2(1.0 + often).mean()) if len(s) else 0.0)
                    kept.append(s[order[:length]])
                    told.append(parities(s, WORDS))
                    larger = more_words(len(s))
                    more.append(_signed(parities(s, larger)) if larger else None)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(sizes, pa.int64()), pa.array(matches, pa.int32()), pa.array(common, pa.float64()), _lists(kept), _lists(told),
                     pa.array(more, pa.list_(pa.int64()))], ["row", "n", "matches", "common", "prefix", "words", "more"])

    return rows.select("row", "text").mapInArrow(
        run, "row long, n long, matches int, common double, prefix array<long>, words array<long>, more array<long>")


def shingle_sets(rows: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            for piece in _pieces(batch):
                yield pa.RecordBatch.from_arrays([piece.column(0), _lists(list(shingler(piece.column(1).to_pylist())))], ["row", "items"])

    return rows.select("row", "text").mapInArrow(run, "row long, items array<long>")


def similar_links(rows: DataFrame, sketch: np.ndarray, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between class representatives; a list holds those that have a shingle in their prefix."""
    reps = classes.select(F.col("node").alias("row")).distinct()
    chosen = stored(prefixes(rows, sketch, words, percent).filter("n > 0").join(reps, "row"), "prefixes")
    placed = chosen.select(F.explode("prefix").alias("list"), "row")
    shared = stored(placed.groupBy("list").agg(F.count("*").alias("size")).filter("size > 1").select("list"), "shared")
    lists = stored(
        placed.join(broadcast_if_small(shared, SMALL), "list").join(chosen.select("row", "n", "matches", "common"), "row")
        .select("list", "row", "n", "matches", "common"), "lists")
    sets_of = lambda met: stored(shingle_sets(rows.join(broadcast_if_small(met, SMALL), "row", "left_semi"), words), "sets")
    return list_links(lists, sets_of, percent, chosen.select("row", "n", "words", "more"), large_may_link(percent))


def similar_documents(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                      row_col: str | None = None) -> DataFrame:
    """Per row of `docs`: row, doc_id, n_shingles, component_id (the smallest doc_id that links reach)
    and stays (one row of each component).

    Two texts are linked when percent of the union of their shingle sets is shared. Rows with equal
    sets are one class, so copies are never expanded into pairs. Null texts and texts without words
    have the empty set and are alone; null ids count as larger than any id, and a component of null
    ids only has a null id. Rows may repeat. Other columns are not read. `row` is
    `row_col` of stored `docs`, or else a number given here.
    """
    rows = docs.select(*([F.col(row_col).alias("row")] if row_col else []), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows if row_col else numbered(rows)
    measured = stored(set_sizes(rows, words), "measured")
    sketch = add_sketches(measured.filter("slot is not null").select("slot", "counts"))
    sized = measured.filter("slot is null").select("row", "n", "h1", "h2")
    alike = sized.filter("n > 0").groupBy("h1", "h2", "n").agg(F.min("row").alias("node"))
    classes = stored(sized.join(alike, ["h1", "h2", "n"], "left").select("row", "n", F.coalesce("node", "row").alias("node")), "classes")
    found = components(similar_links(rows, sketch, classes.filter("n > 0"), words, percent))
    placed = classes.join(found, "node", "left").select("row", "n", F.coalesce("component", "node").alias("component"))
    placed = stored(placed.join(rows.select("row", "doc_id"), "row"), "placed")
    first = placed.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row")).alias("first"))
    return placed.join(first, "component").select(
        "row", "doc_id", F.col("n").alias("n_shingles"), F.col("first.doc_id").alias("component_id"),
        (F.col("row") == F.col("first.row")).alias("stays"))


def join_report(docs: DataFrame) -> DataFrame:
    """Three-word shingles, links from 90 percent."""
    return similar_documents(docs, words=3, percent=90).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """`docs` with one document of each group of similar ones; documents without words stay."""
    docs = numbered(docs, "__row")
    kept = similar_documents(docs, words, percent, row_col="__row").filter("stays").select(F.col("row").alias("__row"))
    return docs.join(kept, "__row", "left_semi").drop("__row")
