"""Language identification in two steps: the family first, then linear SVMs between its languages."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from veldcube.functions.session import broadcast_if_small

#: Families of languages; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("de", "en", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "hr", "sr", "sl"),
}
UNKNOWN = "und"
#: Labelled documents per language that the model is fitted on.
SAMPLE_PER_LANGUAGE = 400
#: Bits of a character's class; a feature is the classes of three characters.
BITS = 6
FEATURES = 1 << (3 * BITS)
CHUNK_CHARS = 2_000_000
LETTER = re.compile(r"[^\W\d_]")


def family_of(lang: str) -> str:
    return next((name for name, langs in FAMILIES.items() if lang in langs), f"={lang}")


def _classes() -> np.ndarray:
    """Class of every code point below 0x250: 0 for anything but letters, else one class per lower-case letter."""
    table, seen = np.zeros(0x250, np.uint32), {}
    for code in range(0x250):
        low = chr(code).lower()[:1]
        if chr(code).isalpha():
            # Letters of the common alphabets have a class each; rarer ones share the last.
            seen.setdefault(low, min(len(seen) + 1, (1 << BITS) - 2))
            table[code] = seen[low]
    return table


CLASSES = _classes()


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram codes of all texts in a row, and how many each text has. Letters beyond the table share a class;
    every text is padded by two non-letters, and windows without a letter have code 0."""
    lengths = np.fromiter((len(t) + 2 for t in texts), np.int64, len(texts))
    joined = "  ".join(texts) + "  "
    codes = np.frombuffer(("  " + joined).encode("utf-32-le", "surrogatepass"), np.uint32)
    other = np.uint32((1 << BITS) - 1)
    classes = np.where(codes < len(CLASSES), CLASSES[np.minimum(codes, len(CLASSES) - 1)], other)
    return (classes[:-2] << (2 * BITS)) | (classes[1:-1] << BITS) | classes[2:], lengths


class Linear:
    """Linear SVM on relative trigram frequencies; positive margins speak for the first class."""

    def __init__(self, docs: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, epochs: int = 8, penalty: float = 1e-4):
        weights, bias, total, bias_total, step = np.zeros(FEATURES), 0.0, np.zeros(FEATURES), 0.0, 0
        share = {s: max(1, int((signs == s).sum())) for s in (-1.0, 1.0)}
        order = np.random.default_rng(7)
        for _ in range(epochs):
            for i in order.permutation(len(docs)):
                step += 1
                rate = 1.0 / (penalty * (step + 1_000))
                at, values = docs[i]
                scale = 1.0 - rate * penalty
                weights *= scale
                if signs[i] * (weights[at] @ values + bias) < 1:
                    gain = rate * signs[i] * len(docs) / (2 * share[signs[i]])
                    weights[at] += gain * values
                    bias += 0.01 * gain
        self.weights, self.bias = weights.astype(np.float32), float(bias)


def _vector(text: str) -> tuple[np.ndarray, np.ndarray]:
    codes, _ = trigrams([text])
    at, counts = np.unique(codes[codes > 0], return_counts=True)
    return at.astype(np.int64), counts / max(1, counts.sum())


class Model:
    """Families against the rest, then one against one within each family."""

    def __init__(self, texts: list[str], langs: list[str]):
        self.langs = sorted(set(langs))
        docs, of = [_vector(t) for t in texts], np.array([family_of(x) for x in langs])
        names = np.array(langs)
        self.families = {f: [x for x in self.langs if family_of(x) == f] for f in sorted(set(of))}
        self.rest = {f: Linear(docs, np.where(of == f, 1.0, -1.0)) for f in self.families} if len(self.families) > 1 else {}
        self.pairs = {}
        for members in self.families.values():
            for a, b in combinations(members, 2):
                at = np.flatnonzero((names == a) | (names == b))
                self.pairs[a, b] = Linear([docs[i] for i in at], np.where(names[at] == a, 1.0, -1.0))

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score of texts that hold a letter each."""
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        codes, lengths = trigrams(texts)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        counted = np.maximum(1, np.add.reduceat((codes > 0).astype(np.int64), starts))

        def margin(linear: Linear) -> np.ndarray:
            weights = linear.weights.copy()
            weights[0] = 0
            return np.add.reduceat(weights[codes], starts, dtype=np.float64) / counted + linear.bias

        sure = lambda m: 1 / (1 + np.exp(-np.clip(2 * m, -50, 50)))
        families = list(self.families)
        by_family = np.stack([margin(self.rest[f]) for f in families]) if self.rest else np.full((1, len(texts)), 25.0)
        best = by_family.argmax(0)
        margins = {pair: margin(linear) for pair, linear in self.pairs.items()}
        langs, scores = np.empty(len(texts), object), sure(by_family.max(0))
        for k, f in enumerate(families):
            members, at = self.families[f], np.flatnonzero(best == k)
            votes = np.zeros((len(members), len(at)))
            for (a, b), m in margins.items():
                if a in members:
                    p = sure(m[at])
                    votes[members.index(a)] += (p > 0.5) + p / len(members)
                    votes[members.index(b)] += (p <= 0.5) + (1 - p) / len(members)
            won = votes.argmax(0)
            langs[at] = np.array(members, object)[won]
            for (a, b), m in margins.items():
                if a in members:
                    p = sure(m[at])
                    for x, q in ((a, p), (b, 1 - p)):
                        mine = won == members.index(x)
                        scores[at[mine]] *= q[mine]
        return list(langs), scores


def held_out(id_col: str = "doc_id"):
    """Whether a document is kept from training."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """A model from at most `per_language` labelled documents of each language, none of them held out.

    The sample is the documents with the least hash of their id; rows are thinned by hash before they
    are ranked, so a frequent language is not sorted in one task. Only the sample reaches the driver.
    Null ids, texts and languages are not learned from.
    """
    usable = docs.filter(~held_out(id_col) & F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col).cast("string"), F.lit(11)).alias("h"))
    counts = docs.filter(~held_out(id_col) & F.col(lang_col).isNotNull()).groupBy(F.col(lang_col).alias("of")).agg(F.count("*").alias("n"))
    share = F.shiftrightunsigned("h", 11).cast("double") / float(1 << 53)
    thinned = usable.join(broadcast_if_small(counts), F.col("lang") == F.col("of")).filter(share < F.lit(3.0 * per_language) / F.col("n"))
    ranked = thinned.withColumn("at", F.row_number().over(W.partitionBy("lang").orderBy("h", "text"))).filter(F.col("at") <= per_language)
    rows = ranked.select("lang", "text").orderBy("lang", "h").collect()
    return Model([r["text"] for r in rows], [r["lang"] for r in rows])


def _chunks(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Positions and texts with a letter, in pieces of about CHUNK_CHARS."""
    at, piece, size = [], [], 0
    for i, text in enumerate(texts):
        if text is not None and LETTER.search(text):
            at.append(i)
            piece.append(text)
            size += len(text)
            if size >= CHUNK_CHARS:
                yield at, piece
                at, piece, size = [], [], 0
    if piece:
        yield at, piece


def identify(docs: DataFrame, model: Model, text_col: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """`docs` with the predicted language and a score from 0 to 1, each from the whole text.

    Null texts and texts without a letter are `und` with score 0, as is every text if nothing was
    learned. Columns of `docs` that have the names of the two new ones are replaced.
    """
    docs = docs.drop(lang, score)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for at, piece in _chunks(texts):
                found, sure = shipped.value.predict(piece)
                for i, x in zip(at, found, strict=True):
                    langs[i] = x
                scores[at] = sure
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*batch.schema.names, lang, score])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(lang, StringType()), StructField(score, DoubleType())]))


def language_report(docs: DataFrame) -> DataFrame:
    model = fit(docs)
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")


def known_language(docs: DataFrame) -> DataFrame:
    """`docs` without those whose language is not told: null texts and texts without a letter."""
    found = identify(docs, fit(docs), lang="__lang", score="__score")
    return found.filter(F.col("__lang") != UNKNOWN).drop("__lang", "__score")
