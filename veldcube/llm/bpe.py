"""Byte-pair encoding and decoding with a transducer lexicon of the frequent words.

The frequent words of all documents are compiled, with their token ids, into a minimal acyclic
automaton that tasks memory-map; other words are merged pair by pair.
"""

from __future__ import annotations

import heapq
import json
import mmap
import re
import struct
import unicodedata
import uuid
from array import array
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veldcube.llm.common import shared_path, stored

#: Words that the lexicon holds at most; all others are merged, with the same result.
LEXICON_WORDS = 60_000
#: Words that a task counts before it hands its counts on, and results that it keeps at hand.
COUNTED_WORDS = 200_000
CACHED_WORDS = 800_000
#: Characters that are encoded before a batch is passed on.
CHUNK_CHARS = 1_500_000
#: Words longer than this are merged with a heap.
LONG_WORD = 40
#: Fixed value: white space of the vocabulary's normaliser.
BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: The lower-case letters and the numbers below U+0100.
LATIN = {r"\p{L}": "a-zªµºß-öø-ÿ", r"\p{N}": "0-9²³¹¼-¾"}


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in vocabularies of byte-level tokenizers."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """What encoding needs of a tokenizer file: symbols, merges, word pattern and special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or spec.get("decoder"):
            raise ValueError(f"{path}: not a lower-casing byte-level BPE file without decoder")
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        split = next(x for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.pattern = split["pattern"]["Regex"].replace(r"\s", BLANK)
        self.specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + end] for s in symbols]
        pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        self.ranks = {(vocab[a] << 20) | vocab[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.merged = [vocab[a + b] for a, b in pairs]
        self.tokens = [""] * (max([*vocab.values(), *self.specials.values()]) + 1)
        for token, i in [*vocab.items(), *self.specials.items()]:
            self.tokens[i] = token

    def merge(self, word: bytes) -> list[int]:
        """Token ids of a word: the pair of lowest rank is merged first, the leftmost of equal ones."""
        ids = [*(self.inner[b] for b in word[:-1]), self.last[word[-1]]]
        return self._merge_long(ids) if len(ids) > LONG_WORD else self._merge_short(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        rank, none = self.ranks.get, len(self.merged)
        ranks = [rank((a << 20) | b, none) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks and (best := min(ranks)) < none:
            at = ranks.index(best)
            new = ids[at] = self.merged[best]
            del ids[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank((ids[at - 1] << 20) | new, none)
            if at < len(ranks):
                ranks[at] = rank((new << 20) | ids[at + 1], none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        rank, n = self.ranks.get, len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank((ids[i] << 20) | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            best, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = self.merged[best], -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (r := rank((ids[left] << 20) | ids[right])) is not None:
                    heapq.heappush(heap, (r, left, ids[left], ids[right]))
        return [x for x in ids if x >= 0]


class Words:
    """Cuts texts into the words of a vocabulary; special tokens are cut out first and stand as their ids."""

    def __init__(self, vocabulary: Vocabulary):
        self.find = regex.compile(vocabulary.pattern).findall
        narrow = vocabulary.pattern
        for kind, characters in LATIN.items():
            narrow = narrow.replace(kind, characters)
        self.find_latin = re.compile(narrow).findall  # the same cuts, for texts below U+0100
        self.specials = vocabulary.specials
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")").split if self.specials else None

    def __call__(self, text: str) -> list[str | int]:
        if self.specials and any(x in text for x in self.specials):
            parts: list[str | int] = []
            for piece in self.cut(text):
                parts += [self.specials[piece]] if piece in self.specials else self.plain(piece)
            return parts
        return self.plain(text)

    def plain(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower-cased letter by letter
        text = text.lower()
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.find(text)
        return self.find_latin(text)


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """Minimal acyclic transducer of `words` with their ids, as the bytes of a file.

    Words are added in order; what the next word can no longer change is replaced by an equal state
    if there is one, so common suffixes are stored once. Every transition holds the number of words
    that come before those it leads to; their sum along a word is its place among all words, and with
    it the place of its ids.
    """
    register: dict[tuple, int] = {}
    states: list[tuple] = []  # (final, ((byte, target), ...))

    def freeze(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(states)
            states.append(key)
        return register[key]

    path, previous = [[False, []]], b""
    order = sorted(words)
    for word in order:
        same = 0
        while same < min(len(word), len(previous)) and word[same] == previous[same]:
            same += 1
        for depth in range(len(previous), same, -1):
            target = freeze(path.pop())
            path[-1][1].append((previous[depth - 1], target))
        path += [[False, []] for _ in word[same:]]
        path[-1][0] = True
        previous = word
    for depth in range(len(previous), 0, -1):
        target = freeze(path.pop())
        path[-1][1].append((previous[depth - 1], target))
    root = freeze(path[0])
    below = [0] * len(states)
    first, labels, targets, skips = array("i"), bytearray(), array("i"), array("i")
    for i, (final, edges) in enumerate(states):  # targets come before the states that lead to them
        first.append(len(labels) * 2 + final)
        below[i] = int(final)
        for label, target in edges:
            labels.append(label)
            targets.append(target)
            skips.append(below[i])
            below[i] += below[target]
    first.append(len(labels) * 2)
    starts, ids = array("i", [0]), array("i")
    for word in order:
        ids.extend(words[word])
        starts.append(len(ids))
    parts = [bytes(first), bytes(targets), bytes(skips), bytes(starts), bytes(ids), bytes(labels)]
    return struct.pack("7i", root, *map(len, parts)) + b"".join(parts)


class Lexicon:
    """A compiled lexicon in a memory-mapped file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.bytes = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        self.root, *sizes = struct.unpack_from("7i", self.bytes)
        at, views, whole = struct.calcsize("7i"), [], memoryview(self.bytes)
        for n in sizes[:-1]:
            views.append(whole[at : at + n].cast("i"))
            at += n
        self.first, self.targets, self.skips, self.starts, self.ids = views
        self.labels = at

    def get(self, word: bytes) -> bytes | None:
        """The ids of a word as 32-bit integers, None if the lexicon has not got it."""
        state, place, first, find, base = self.root, 0, self.first, self.bytes.find, self.labels
        for i in range(len(word)):
            edge = find(word[i : i + 1], base + (first[state] >> 1), base + (first[state + 1] >> 1)) - base
            if edge < 0:
                return None
            place += self.skips[edge]
            state = self.targets[edge]
        return bytes(self.ids[self.starts[place] : self.starts[place + 1]]) if first[state] & 1 else None


def word_counts(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> DataFrame:
    """How often each word (word, n) occurs in all texts; counted in the tasks before they are added up."""
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, counts = Words(shipped.value), Counter()

        def flush() -> pa.RecordBatch:
            for special in cut.specials.values():
                counts.pop(special, None)
            batch = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for text in batch.column(0):
                counts.update(cut(text.as_py() or ""))
                if len(counts) >= COUNTED_WORDS:
                    yield flush()
        yield flush()

    return docs.select(text_col).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counted: DataFrame, limit: int) -> DataFrame:
    """The rows of the highest counts (column n), `limit` at most. Counts are told apart to a sixteenth of a
    doubling; of the rows of one such level all are taken or none, so the tasks hand on what is taken only."""
    level = F.floor(F.log2("n") * 16)
    lowest, taken = None, 0
    for at, size in sorted(((r["level"], r["size"]) for r in counted.groupBy(level.alias("level")).agg(F.count("*").alias("size")).collect()), reverse=True):
        taken += size
        if taken > limit:
            break
        lowest = at
    return counted.filter(level >= lowest if lowest is not None else F.lit(False))


def publish(spark: SparkSession, content: bytes) -> str:
    """Put a file into the shared folder and have every executor fetch it; returns its name."""
    name = f"lexicon-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_path(spark, 'bpe')}/{name}")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    spark.sparkContext.addFile(path.toString())
    return name


def build_lexicon(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", words: int = LEXICON_WORDS) -> str:
    """Compile the most frequent words of all documents and publish the file. The driver sees the
    chosen words only."""
    counted = stored(word_counts(docs, vocabulary, text_col), "words")
    top = most_frequent(counted, words).select("word").collect()
    chosen = {w: vocabulary.merge(w) for w in (r["word"].encode() for r in top)}
    return publish(docs.sparkSession, compile_lexicon(chosen))


class Encoder:
    """Encodes texts; keeps the results of recent words, and those of lexicon words as long as it lives."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.cut, self.vocabulary, self.lexicon = Words(vocabulary), vocabulary, lexicon
        self.frequent: dict[str | int, bytes] = {}
        self.known: dict[str | int, bytes] = {}

    def missing(self, word: str | int) -> bytes:
        if isinstance(word, int):
            return array("i", [word]).tobytes()
        raw = word.encode("utf-8", "surrogatepass")
        found = self.lexicon.get(raw)
        if found is not None:
            self.frequent[word] = found
        else:
            found = array("i", self.vocabulary.merge(raw)).tobytes()
        if len(self.known) >= CACHED_WORDS:
            self.known = dict(self.frequent)
        self.known[word] = found
        return found

    def __call__(self, text: str) -> bytes:
        get, missing = self.known.get, self.missing
        words = self.cut(text)
        found = [get(w) for w in words]
        if None in found:
            found = [missing(w) if x is None else x for w, x in zip(words, found, strict=True)]
        return b"".join(found)


_encoders: dict[str, Encoder] = {}


def worker_encoder(name: str, vocabulary: Vocabulary) -> Encoder:
    """This worker's encoder with the published lexicon `name`; later tasks find its results."""
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = Encoder(vocabulary, Lexicon(SparkFiles.get(name)))
    return _encoders[name]


def ids_column(encoded: list[bytes]) -> pa.ListArray:
    offsets = array("i", [0])
    for x in encoded:
        offsets.append(offsets[-1] + len(x) // 4)
    data = b"".join(encoded)
    values = pa.Array.from_buffers(pa.int32(), len(data) // 4, [None, pa.py_buffer(data)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def decode_ids(ids: pa.ListArray, tokens: pa.Array) -> pa.Array:
    """The texts of lists of ids: their tokens joined by one space, as a tokenizer without decoder has it."""
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, tokens.take(ids.values)), " ")


def _digests(texts: pa.Array) -> pa.Array:
    return pa.array([sha256(x.as_buffer()).hexdigest() for x in texts], pa.string())


#: What encode() can return, by column name.
OUTPUTS = {
    "ids": ("array<int>", lambda ids, tokens: ids),
    "n_tokens": ("long", lambda ids, tokens: pc.list_value_length(ids).cast(pa.int64())),
    "decoded": ("string", decode_ids),
    "ids_sha256": ("string", lambda ids, tokens: _digests(pc.binary_join(pa.ListArray.from_arrays(ids.offsets, ids.values.cast(pa.string())), " "))),
    "decoded_sha256": ("string", lambda ids, tokens: _digests(decode_ids(ids, tokens))),
}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode(docs: DataFrame, path: str | None = None, outputs: tuple[str, ...] = ("ids", "n_tokens", "decoded"),
           id_col: str = "doc_id", text_col: str = "text", lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """Token ids of every whole text and the texts decoded from them: the id column and `outputs`.

    Null and empty texts, and texts of white space, have no tokens and decode to an empty text. Rows
    may repeat; an empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    vocabulary = Vocabulary(path or default_path())
    name = build_lexicon(docs, vocabulary, text_col, lexicon_words)
    shipped = spark.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(name, shipped.value)
        tokens = pa.array(shipped.value.tokens, pa.string())

        def result(rows: pa.RecordBatch, encoded: list[bytes]) -> pa.RecordBatch:
            ids = ids_column(encoded)
            return pa.RecordBatch.from_arrays([rows.column(0), *(OUTPUTS[x][1](ids, tokens) for x in outputs)], ["doc_id", *outputs])

        for batch in batches:
            start, encoded, size = 0, [], 0
            for text in batch.column(1):
                text = text.as_py() or ""
                encoded.append(encoder(text))
                size += len(text)
                if size >= CHUNK_CHARS:
                    yield result(batch.slice(start, len(encoded)), encoded)
                    start, encoded, size = start + len(encoded), [], 0
            yield result(batch.slice(start), encoded)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, ", ".join([f"doc_id {kind}", *(f"{x} {OUTPUTS[x][0]}" for x in outputs)]))


def bpe_report(docs: DataFrame) -> DataFrame:
    return encode(docs, outputs=("n_tokens", "ids_sha256", "decoded_sha256"))
