"""Secrets in documents: candidates by pattern, false positives removed by a random forest."""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veldcube.llm.common import stored

#: Documents that lend their words to labelled findings, about; and findings made from each.
SAMPLE_DOCUMENTS = 3_000
#: Words of the dictionary, the most frequent of all documents.
DICTIONARY_WORDS = 20_000
TREES, DEPTH, SEED = 40, 9, 20240609
ACCEPTED = 0.5
#: Words before and after a candidate that count as its neighbours.
BEFORE, AFTER = 4, 3

_SECRET_WORD = r"(?:key|token|secret|passw(?:or)?d|passwd|pwd|auth|credentials?)"
CANDIDATE = re.compile(
    r"(?P<pem>-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----(?:(?:(?!-----BEGIN)[\s\S])*?-----END [A-Z ]{0,20}PRIVATE KEY-----)?)"
    r"|(?P<cloud>\b(?:AKIA|ASIA)[0-9A-Z]{16}\b)"
    r"|(?P<jwt>\beyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]*)"
    r"|(?P<prefixed>\b(?:gh[pousr]|glpat|xox[abprs]|[sprk]k)[-_][A-Za-z0-9_-]{16,})"
    rf"|(?i:{_SECRET_WORD})[\"']?\s{{0,3}}(?:=>|:=|=|:)\s{{0,3}}[\"'`]?(?P<assigned>[^\s\"'`,;<>]{{6,}})"
    r"|(?<![\w/+=-])(?P<plain>(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{16,})(?![\w/+=-])")
KINDS = ("pem", "cloud", "jwt", "prefixed", "assigned", "plain")
NEAR_SECRET = re.compile(_SECRET_WORD + r"|login|private|bearer|api", re.I)
NEAR_HARMLESS = re.compile(r"\b(?:commit|sha\d*|md5|hash|checksum|digest|uuid|guid|rev(?:ision)?|etag|integrity|example|sample|placeholder|phone|card|isbn|order|serial|version)\b", re.I)
PLACEHOLDER = re.compile(r"x{4,}|\*{3,}|\$\{|<|changeme|example|your[-_]?|dummy|test|1234|placeholder", re.I)
HEX = re.compile(r"[0-9a-fA-F]+")
UUID = re.compile(r"[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}", re.I)
WORDS = re.compile(r"[a-z]{3,12}")
FEATURES = (
    "length", "digits", "upper", "distinct", "entropy", "transitions", "dictionary", "hex", "uuid", "numeric", "path",
    "placeholder", "near_secret", "near_harmless", "quoted", "own_line", *(f"is_{k}" for k in KINDS))

#: Classes of characters in transitions: letters without case, digits, the rest.
_CLASS = np.full(128, 27, np.int64)
_CLASS[ord("a") : ord("z") + 1] = _CLASS[ord("A") : ord("Z") + 1] = np.arange(26)
_CLASS[ord("0") : ord("9") + 1] = 26
CLASSES = 28


def classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("ascii", "replace"), np.uint8)
    return _CLASS[np.minimum(codes, 127)]


def corpus_statistics(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, frozenset[str]]:
    """Logarithms of the character transitions and the most frequent words of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, words = np.zeros(CLASSES * CLASSES, np.int64), Counter()

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], ["item", "n"])
            words.clear()
            return batch

        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                if text:
                    c = classes(text)
                    steps += np.bincount(c[:-1] * CLASSES + c[1:], minlength=CLASSES * CLASSES)
                    words.update(WORDS.findall(text.lower()))
                    if len(words) > 200_000:
                        yield flush()
        yield flush()
        yield pa.RecordBatch.from_arrays([pa.array([f"#{i}" for i in range(len(steps))]), pa.array(steps)], ["item", "n"])

    counted = stored(docs.select(text_col).mapInArrow(run, "item string, n long").groupBy("item").agg(F.sum("n").alias("n")), "counts")
    steps = np.ones((CLASSES, CLASSES))
    for r in counted.filter(F.col("item").startswith("#")).collect():  # CLASSES x CLASSES rows
        steps[divmod(int(r["item"][1:]), CLASSES)] += r["n"]
    top = counted.filter(~F.col("item").startswith("#")).orderBy(F.desc("n"), "item").limit(DICTIONARY_WORDS).collect()
    return np.log(steps / steps.sum(1, keepdims=True)), frozenset(r["item"] for r in top)


def coverage(value: str, dictionary: frozenset[str]) -> float:
    """Share of a value's characters that dictionary words cover, the longest taken first from the left."""
    low, at, covered = value.lower(), 0, 0
    while at < len(low):
        n = next((n for n in range(min(12, len(low) - at), 2, -1) if low[at : at + n] in dictionary), 0)
        covered += n
        at += n or 1
    return covered / max(1, len(low))


class Surroundings:
    """Where a text's words and telling neighbours are, found once for all its candidates."""

    def __init__(self, text: str):
        words = [m.span() for m in re.finditer(r"\S+", text)]
        self.starts, self.ends = [a for a, _ in words], [b for _, b in words]
        spans = lambda pattern: [m.span() for m in pattern.finditer(text)]
        self.secret, self.harmless, self.paths = spans(NEAR_SECRET), spans(NEAR_HARMLESS), spans(re.compile("://"))

    def before(self, start: int) -> int:
        """Where the words before a candidate begin; the part of its own word before it is one of them."""
        k = bisect_left(self.starts, start)
        return self.starts[max(0, k - BEFORE)] if k else start

    def after(self, end: int) -> int:
        k = bisect_right(self.ends, end)
        return self.ends[min(k + AFTER, len(self.ends)) - 1] if k < len(self.ends) else end

    def own_word(self, start: int) -> int:
        k = bisect_left(self.starts, start)
        return self.starts[k - 1] if k and self.ends[k - 1] > start else start

    @staticmethod
    def within(spans: list[tuple[int, int]], low: int, high: int) -> bool:
        k = bisect_left(spans, (low, 0))
        return k < len(spans) and spans[k][1] <= high


def features(text: str, start: int, end: int, kind: str, transitions: np.ndarray, dictionary: frozenset[str], around: Surroundings) -> list[float]:
    value, before, after = text[start:end], text[max(0, start - 1) : start], text[end : end + 1]
    counts, n = Counter(value), len(value)
    c = classes(value)
    low, high = around.before(start), around.after(end)
    word = before.strip() + after.strip()
    return [
        float(n), sum(x.isdigit() for x in value) / n, sum(x.isupper() for x in value) / n, len(counts) / n,
        -sum(k / n * math.log2(k / n) for k in counts.values()),
        float(transitions[c[:-1], c[1:]].mean()) if n > 1 else 0.0, coverage(value, dictionary),
        float(bool(HEX.fullmatch(value))), float(bool(UUID.fullmatch(value))), float(value.isdigit()),
        float(value.count("/") + value.count("\\") + (around.within(around.paths, around.own_word(start), end))), float(bool(PLACEHOLDER.search(value))),
        float(around.within(around.secret, low, start)), float(around.within(around.harmless, low, start) or around.within(around.harmless, end, high)),
        float(bool(word) and all(x in "\"'`" for x in word)), float(before in ("", "\n") and after in ("", "\n")),
        *(float(kind == k) for k in KINDS)]


def candidates(text: str) -> Iterator[tuple[int, int, str]]:
    for match in CANDIDATE.finditer(text):
        kind = match.lastgroup
        yield match.start(kind), match.end(kind), kind


_FINDING = pa.schema([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("secret", pa.string()), ("features", pa.list_(pa.float64()))])


def find(docs: DataFrame, transitions: np.ndarray, dictionary: frozenset[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All candidates of the whole texts with their features: doc_id, start and end (characters), kind, secret, features."""
    shipped = docs.sparkSession.sparkContext.broadcast((transitions, dictionary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, words = shipped.value
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py() or ""
                found = list(candidates(text))
                around = Surroundings(text) if found else None
                for start, end, kind in found:
                    rows.append((doc.as_py(), start, end, kind, text[start:end], features(text, start, end, kind, steps, words, around)))
            ids, *columns = zip(*rows, strict=True) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.types[0]), *(pa.array(c, t) for c, t in zip(columns, _FINDING.types, strict=True))], ["doc_id", *_FINDING.names])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, start long, end long, kind string, secret string, features array<double>")


def _planted(rng: random.Random, words: list[str]) -> list[tuple[str, float]]:
    """Phrases with a candidate in each, and whether it is a secret."""
    pick = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    hexa, upper, mixed = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    name = rng.choice(["password", "token", "api_key", "secret", "auth_token", "private_key"])
    joint = rng.choice(["=", " = ", ": ", ' = "', ": '"])
    close = joint[-1] if joint[-1] in "\"'" else ""
    some = [w.strip(".,") for w in words if len(w) > 3] or ["word"]
    long_word = "".join(rng.choice(some) for _ in range(4))
    uuid = "-".join(pick(hexa, n) for n in (8, 4, 4, 4, 12))
    owner = rng.choice(["", "RSA ", "EC ", "OPENSSH "])
    pem = lambda body: f"-----BEGIN {owner}PRIVATE KEY-----\n{body}\n-----END {owner}PRIVATE KEY-----"
    blank = rng.choice(["<your key>", "...", "your-key-here", "xxxxxxxxxxxxxxxx", long_word, "EXAMPLE " + long_word])
    return [
        (f"{name}{joint}{pick(hexa, rng.choice([18, 24, 32, 40]))}{close}", 1.0),
        (f"{name}{joint}{pick(mixed, rng.randint(14, 44))}{close}", 1.0),
        (rng.choice(["AKIA", "ASIA"]) + pick(upper, 16), 1.0),
        (rng.choice(["ghp_", "xoxb-", "sk_"]) + pick(mixed, rng.randint(24, 40)), 1.0),
        (f"{rng.choice(['bearer', 'api', 'login'])} {pick(mixed, rng.randint(24, 44))}", 1.0),
        (pem("\n".join(pick(mixed + "+/", 64) for _ in range(rng.randint(1, 6)))), 1.0),
        (f"eyJ{pick(mixed, rng.randint(16, 60))}.eyJ{pick(mixed, rng.randint(20, 90))}.{pick(mixed + '-_', 43)}", 1.0),
        (pem(blank), 0.0),
        (f"eyJ{long_word}.{long_word}.{rng.choice(some)}", 0.0),
        (f"{rng.choice(['commit', 'sha1', 'checksum', 'md5', 'rev'])} {pick(hexa, rng.choice([32, 40]))}", 0.0),
        (f"{rng.choice(['id', 'uuid', 'order', 'serial'])} {rng.choice([uuid, pick('0123456789', 16)])}", 0.0),
        (f"{name}{joint}{rng.choice(['changeme', 'your-' + name, 'example123', '********', '${SECRET}', 'xxxxxxxx'])}{close}", 0.0),
        (f"{name}{joint}{long_word}{close}", 0.0),
        (f"/{rng.choice(some)}/{long_word}/{rng.choice(some)}_{rng.randint(1, 99)}", 0.0),
        (f"{long_word}{rng.randint(1, 9999)}", 0.0),
        (pick("0123456789", rng.choice([16, 18, 20])), 0.0),
    ]


def labelled_findings(docs: DataFrame, transitions: np.ndarray, dictionary: frozenset[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Findings with a label (features, label), for corpora that have none: secrets of the usual forms and
    harmless look-alikes are set among the words of about SAMPLE_DOCUMENTS documents."""
    shipped = docs.sparkSession.sparkContext.broadcast((transitions, dictionary))
    share = F.shiftrightunsigned(F.xxhash64(F.col(id_col).cast("string"), F.lit(17)), 11).cast("double") / float(1 << 53)
    sample = docs.filter(F.col(text_col).isNotNull() & (share < SAMPLE_DOCUMENTS / max(1, docs.count())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, known = shipped.value
        for batch in batches:
            found, labels = [], []
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                rng, words = random.Random(f"{SEED}:{doc.as_py()}"), text.as_py().split()
                if not words:
                    continue
                for phrase, label in _planted(rng, words[:200]):
                    at = rng.randrange(len(words))
                    left, right = " ".join(words[max(0, at - 8) : at]), " ".join(words[at : at + 8])
                    context = f"{left} {phrase} {right}"
                    inside = (len(left) + 1, len(left) + 1 + len(phrase))
                    around = Surroundings(context)
                    for start, end, kind in candidates(context):
                        if inside[0] <= start and end <= inside[1]:
                            found.append(features(context, start, end, kind, steps, known, around))
                            labels.append(label)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), pa.array(labels, pa.float64())], ["features", "label"])

    return sample.select(id_col, text_col).mapInArrow(run, "features array<double>, label double")


def train(findings: DataFrame) -> RandomForestClassificationModel | None:
    """A random forest on labelled findings (features, label); None without findings of both labels."""
    rows = stored(findings, "findings")
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, maxMemoryInMB=64)
    return forest.fit(rows.select("label", array_to_vector("features").alias("vector")).coalesce(2))


def scan(docs: DataFrame, findings: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Candidates with the forest's verdict: doc_id, start, end, kind, secret, score, is_secret.

    `findings` are labelled ones as labelled_findings() makes them, which are used if none are given.
    Without findings of both labels every candidate counts as a secret. Null and empty texts have no
    candidates; rows may repeat, ids may be null; an empty table gives no rows. Other columns are not
    read.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    transitions, dictionary = corpus_statistics(docs)
    model = train(labelled_findings(docs, transitions, dictionary) if findings is None else findings)
    found = stored(find(docs, transitions, dictionary), "candidates")
    if model is None:
        scored = found.withColumn("score", F.lit(1.0))
    else:
        scored = model.transform(found.withColumn("vector", array_to_vector("features"))).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "start", "end", "kind", "secret", "score", (F.col("score") >= ACCEPTED).alias("is_secret"))


def secret_report(docs: DataFrame) -> DataFrame:
    return scan(docs).select("doc_id", "start", "end", "kind", F.sha2("secret", 256).alias("secret_sha256"), F.round("score", 6).alias("score"), "is_secret")
