"""Alignment of two tokenizers: which of their tokens overlap in every text, and how usual each pairing is."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veldcube.llm.bpe import byte_symbols
from veldcube.llm.common import stored

#: Characters of the documents that are aligned together; a longer text is taken alone.
SHARD_CHARS = 1_500_000
#: Tokens of a lane: longer documents are cut at ends that both tokenizers share.
LANE = 2048
#: Fixed value: the character that stands for a space in the pieces of the second tokenizer.
BLANK = "▁"


@dataclass
class Files:
    """What tasks need of the two tokenizer files."""

    spec: str
    pattern: str
    model: bytes


def tokenizer_files(byte_level: str | None = None, pieces: str | None = None, pattern: str | None = None) -> Files:
    """Read the file of the byte-level tokenizer (A) and of the piece tokenizer (B), and the word pattern of A."""
    import public_tokenizers

    with open(byte_level or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    with open(pieces or public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return Files(spec, pattern or public_tokenizers.PATTERN, f.read())


class Pair:
    """Both tokenizers: ids of texts and the bytes of tokens."""

    def __init__(self, files: Files):
        import sentencepiece
        import tiktoken

        spec = json.loads(files.spec)
        byte = {s: b for b, s in enumerate(byte_symbols())}
        vocab = spec["model"]["vocab"]
        specials = {x["id"] for x in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items() if i not in specials}
        pairs = [x.split(" ") if isinstance(x, str) else x for x in spec["model"]["merges"]]
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or any(vocab[a + b] != 256 + k for k, (a, b) in enumerate(pairs)):
            raise ValueError("not a byte-level BPE file whose ids follow its merges")
        self.spec, self.slow = files.spec, None
        self.fast = tiktoken.Encoding("byte-level", pat_str=files.pattern, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=files.model)
        raw = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            raw[i] = token
        self.a_bytes = pa.array(raw, pa.binary())
        size = self.pieces.vocab_size()
        known = self.pieces.id_to_piece(list(range(size)))
        made = [bytes([int(x[1:-1], 16)]) if self.pieces.is_byte(i) else x.replace(BLANK, " ").encode() for i, x in enumerate(known)]
        self.b_bytes = pa.array(made, pa.binary())
        self.a_lengths, self.b_lengths = (np.array([len(x) for x in table], np.int64) for table in (raw, made))

    def a(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text).astype(np.int32)
        except Exception:  # texts that the fast library's patterns give up on
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_str(self.spec)
                self.slow.encode_special_tokens = True
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.int32)

    def b(self, text: str) -> np.ndarray:
        return np.array(self.pieces.encode(text, num_threads=1), np.int32)


_pairs: dict[int, Pair] = {}


def worker_pair(files: Files) -> Pair:
    """This worker's tokenizers; later tasks find them."""
    key = hash((files.spec, files.pattern, files.model))
    if key not in _pairs:
        _pairs.clear()
        _pairs[key] = Pair(files)
    return _pairs[key]


def shared_end(ends_a: np.ndarray, ends_b: np.ndarray, at: int) -> tuple[int, int]:
    """The first token of A from `at` on that ends where a token of B does, and that token."""
    while True:
        window = ends_a[at : at + 64]
        pos = np.minimum(np.searchsorted(ends_b, window), len(ends_b) - 1)
        hit = np.flatnonzero(ends_b[pos] == window)
        if len(hit):
            return at + int(hit[0]), int(pos[hit[0]])
        at += len(window)


def lanes_of(ends_a: np.ndarray, ends_b: np.ndarray, from_a: np.ndarray, from_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last token of A and first of B of each lane: the documents, long ones in several pieces."""
    lanes = []
    for a, stop, b in zip(from_a[:-1].tolist(), from_a[1:].tolist(), from_b[:-1].tolist(), strict=True):
        while stop - a > 2 * LANE:
            end, end_b = shared_end(ends_a, ends_b, a + LANE - 1)
            lanes.append((a, end + 1, b))
            a, b = end + 1, end_b + 1
        if a < stop:
            lanes.append((a, stop, b))
    return tuple(np.array(lanes, np.int64).reshape(-1, 3).T)


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, from_a: np.ndarray, from_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links and cuts of many documents at once.

    `ends_a` and `ends_b` are the byte offsets at which the tokens of all documents end, one document
    after the other; document d has the tokens from_a[d] to from_a[d + 1] of A, likewise of B. Each step
    links the tokens that all documents' pointers stand on and moves on the pointer whose token ends
    first, both where they end together, which is a cut. Finished documents leave the state.
    Returns the linked tokens of A and of B, and the tokens of A and of B that end at cuts.
    """
    i, stop, j = map(compact, lanes_of(ends_a, ends_b, from_a, from_b))
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(i):
        end_a, end_b = ends_a[i], ends_b[j]
        links_a.append(i)
        links_b.append(j)
        cut = end_a == end_b
        cuts_a.append(i[cut])
        cuts_b.append(j[cut])
        i, j = i + (end_a <= end_b), j + (end_b <= end_a)
        going = i < stop
        if not going.all():
            i, j, stop = i[going], j[going], stop[going]
    gather = lambda x: np.concatenate(x) if x else np.empty(0, np.int64)
    return gather(links_a), gather(links_b), np.sort(gather(cuts_a)), np.sort(gather(cuts_b))


def compact(x: np.ndarray) -> np.ndarray:
    """Growing numbers in 32 bits where they fit."""
    return x.astype(np.int32) if not len(x) or x.max() < 1 << 31 else x


def spelled(table: pa.Array, ids: np.ndarray) -> bytes:
    """The bytes of tokens, one after the other."""
    return b"".join(pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), table.take(pa.array(ids))), b"").to_pylist())


def int_lists(offsets: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.astype(np.int32)))


class Shard:
    """Documents aligned together; tokens of all of them stand one after the other."""

    def __init__(self, pair: Pair, texts: list[str]):
        nothing = (np.empty(0, np.int32),) * 2
        lengths_a, lengths_b = pair.a_lengths, pair.b_lengths
        made = [(pair.a(" " + t), pair.b(t)) if t else nothing for t in texts]
        raw = [(" " + t).encode() if t else b"" for t in texts]
        made = [(a, b) if lengths_a[a].sum() == lengths_b[b].sum() == len(x) else nothing for (a, b), x in zip(made, raw, strict=True)]
        self.take_up(made)
        if not spelled(pair.a_bytes, self.ids_a) == b"".join(x for (a, _), x in zip(made, raw, strict=True) if len(a)) == spelled(pair.b_bytes, self.ids_b):
            self.take_up([(a, b) if spelled(pair.a_bytes, a) == x == spelled(pair.b_bytes, b) else nothing for (a, b), x in zip(made, raw, strict=True)])
        ends_a, ends_b = (compact(np.cumsum(x)) for x in (lengths_a[self.ids_a], lengths_b[self.ids_b]))
        link_a, link_b, self.cut_a, self.cut_b = lockstep(ends_a, ends_b, self.from_a, self.from_b)
        doc = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(self.from_a))[link_a]
        pairs, keys = pd.factorize(self.ids_a[link_a].astype(np.int64) << 32 | self.ids_b[link_b])
        self.times = np.bincount(pairs, minlength=len(keys))
        self.pair_a, self.pair_b = keys >> 32, keys & 0xFFFFFFFF
        self.n_links = np.bincount(doc, minlength=len(texts))
        # A document's pairs in order: equal ones side by side take little room.
        pairs |= doc.astype(np.int64) << 32
        pairs.sort()
        self.pairs = (pairs & 0xFFFFFFFF).astype(np.int32)
        self.groups_to = np.searchsorted(self.cut_a, self.from_a)

    def take_up(self, made: list[tuple[np.ndarray, np.ndarray]]) -> None:
        flat = lambda part: np.concatenate([np.empty(0, np.int32), *(x[part] for x in made)])
        starts = lambda part: np.cumsum([0, *(len(x[part]) for x in made)])
        self.ids_a, self.ids_b, self.from_a, self.from_b = flat(0), flat(1), starts(0), starts(1)

    def groups(self) -> pa.Array:
        """Each document's groups as text: a1,a2|b1;a3|b2,b3."""
        side = lambda ids, cuts: pc.binary_join(pa.ListArray.from_arrays(
            pa.array(np.append(0, cuts + 1).astype(np.int32)), pa.array(ids).cast(pa.string())), ",")
        both = pc.binary_join_element_wise(side(self.ids_a, self.cut_a), side(self.ids_b, self.cut_b), "|")
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(self.groups_to.astype(np.int32)), both), ";")

    def columns(self, outputs: tuple[str, ...]) -> list[pa.Array]:
        sizes = lambda cuts: np.diff(np.append(-1, cuts))
        make = {
            "n_a": lambda: pa.array(np.diff(self.from_a)), "n_b": lambda: pa.array(np.diff(self.from_b)),
            "n_groups": lambda: pa.array(np.diff(self.groups_to)), "n_links": lambda: pa.array(self.n_links),
            "a_ids": lambda: int_lists(self.from_a, self.ids_a), "b_ids": lambda: int_lists(self.from_b, self.ids_b),
            "a_sizes": lambda: int_lists(self.groups_to, sizes(self.cut_a)), "b_sizes": lambda: int_lists(self.groups_to, sizes(self.cut_b)),
            "groups": self.groups,
            "groups_sha256": lambda: pa.array(["" if not g.is_valid or not len(x := g.as_buffer()) else sha256(x).hexdigest() for g in self.groups()], pa.string()),
        }
        return [make[x]() for x in outputs]


#: What aligned() can return, by column name.
OUTPUTS = {"n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "a_ids": "array<int>", "b_ids": "array<int>",
           "a_sizes": "array<int>", "b_sizes": "array<int>", "groups": "string", "groups_sha256": "string"}
COUNTED = "n_best long, count_sum long"
REPORT = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")


def linked_shards(docs: DataFrame, files: Files, outputs: tuple[str, ...]) -> DataFrame:
    """Documents (shard, doc_id, `outputs`, pairs) with the pair of each of their links, as its place among the
    pairs of the shard; the first document of a shard carries these (pair_a, pair_b, times)."""
    shipped = docs.sparkSession.sparkContext.broadcast(files)
    names = ["shard", "doc_id", *outputs, "pairs", "pair_a", "pair_b", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, number = worker_pair(shipped.value), TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        chars = 0

        def settle() -> pa.RecordBatch:
            nonlocal number, chars
            rows = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            number, chars = number + 1, 0
            shard = Shard(pair, [t or "" for t in rows.column(1).to_pylist()])
            n = rows.num_rows
            once = lambda x, kind: pa.array([x] + [None] * (n - 1), pa.list_(kind))
            ids = rows.column(0)
            return pa.RecordBatch.from_arrays([
                pa.array(np.full(n, number)), ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids, *shard.columns(outputs),
                int_lists(np.append(0, np.cumsum(shard.n_links)), shard.pairs),
                once(shard.pair_a, pa.int32()), once(shard.pair_b, pa.int32()), once(shard.times, pa.int64())], names)

        for batch in batches:
            sizes = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            start = 0
            for k, size in enumerate(sizes.tolist()):
                if chars and chars + size > SHARD_CHARS:
                    held.append(batch.slice(start, k - start))
                    yield settle()
                    start = k
                chars += size
            held.append(batch.slice(start))
        if sum(x.num_rows for x in held):
            yield settle()

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, ", ".join([
        "shard long", f"doc_id {kind}", *(f"{x} {OUTPUTS[x]}" for x in outputs), "pairs array<int>", "pair_a array<int>", "pair_b array<int>", "times array<long>"]))


def pair_counts(shards: DataFrame) -> DataFrame:
    """How many links of the corpus hold each pair of ids: a, b, count, and whether none of b is more usual."""
    entries = shards.select(F.explode(F.arrays_zip("pair_a", "pair_b", "times")).alias("e")).select(
        F.col("e.pair_a").alias("a"), F.col("e.pair_b").alias("b"), F.col("e.times").alias("times"))
    counts = stored(entries.groupBy("a", "b").agg(F.sum("times").alias("count")), "pair-counts")
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))  # a row for each id of B
    return counts.join(F.broadcast(highest), "b").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))


def aligned(docs: DataFrame, files: Files | None = None, outputs: tuple[str, ...] = REPORT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens of two tokenizers linked where their bytes overlap: doc_id, `outputs`, n_best, count_sum.

    A text is encoded by A with a space before it and by B, which adds one. Byte offsets at which tokens
    of both end cut them into groups; every pair of tokens of a group that overlap is a link. The count
    of a pair of ids is the number of links that hold it in all documents; count_sum adds the counts of
    a document's links, n_best is how many of them have the highest count of their id of B. `outputs`
    names columns of OUTPUTS: numbers, ids, tokens of each group, groups as text and its digest.

    Documents are aligned many at a time in arrays (a shard). Pairs are counted in a shard before
    they are shuffled, and counts come back to a shard once for each of its pairs, so neither a usual pair
    nor a long document meets in one task. Encoding and alignment happen once and are stored.

    Null and empty texts, and those that a tokenizer does not spell out byte by byte, have no tokens:
    zeros, an empty text and digest. Rows may repeat, each counts; other columns are not read. An empty
    table gives no rows. Groups as text must stay below 2 GB for a document.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shards = stored(linked_shards(rows, files or tokenizer_files(), outputs), "token-links", "zstd")
    counts = pair_counts(shards)
    zipped = F.arrays_zip("pair_a", "pair_b")
    wanted = shards.select("shard", F.posexplode(zipped).alias("at", "e")).select("shard", "at", F.col("e.pair_a").alias("a"), F.col("e.pair_b").alias("b"))
    known = wanted.join(counts, ["a", "b"]).select(F.col("shard").alias("of"), "at", "count", "best")
    names = ["doc_id", *outputs]

    def sums(documents: pa.Table, found: pa.Table) -> pa.Table:
        pairs = documents.column("pairs").combine_chunks()
        at = found.column("at").to_numpy()
        count, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        count[at], best[at] = found.column("count").to_numpy(), found.column("best").to_numpy(zero_copy_only=False)
        flat, ends = pairs.flatten().to_numpy(), np.append(0, np.cumsum(pc.list_value_length(pairs).to_numpy()))
        total = lambda x: np.diff(np.append(0, np.cumsum(x[flat]))[ends])
        return documents.select(names).append_column("n_best", pa.array(total(best))).append_column("count_sum", pa.array(total(count)))

    kind = rows.schema["doc_id"].dataType.simpleString()
    return shards.select("shard", *names, "pairs").groupBy("shard").cogroup(known.groupBy("of")).applyInArrow(
        sums, ", ".join([f"doc_id {kind}", *(f"{x} {OUTPUTS[x]}" for x in outputs), COUNTED]))


def links_report(docs: DataFrame) -> DataFrame:
    return aligned(docs)
