"""Deduplication of lines that are nearly alike, by MinHash over character shingles."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veldcube.functions.session import broadcast_if_small
from veldcube.llm.common import components, let, numbered, stored
from veldcube.llm.list_links import WORDS, list_links, similar

#: Lines of fewer characters are left alone, as are blank ones.
MIN_CHARS = 1
#: Characters of a shingle. Shingles begin at every character; a shorter line is one itself.
SHINGLE = 12
#: Bands of a signature and minima in each: 99 % of the pairs at 0.8 share a band, nearly all at 0.9.
BANDS, ROWS = 6, 3
PERCENT = 80
#: Bits that are turned over for each minimum of a signature.
TURNED = [x - 2**63 for x in map(random.Random(20240607).getrandbits, [64] * (BANDS * ROWS))]
#: Shingles of a signature that are taken together, from one row.
STRIDE = 8
#: Side tables up to so many rows (24 bytes each) are broadcast; larger ones are joined by shuffle.
SMALL = 1_000_000


def normal(line: Column) -> Column:
    """Lower case, trimmed, other white space and longer runs of it as one blank."""
    lower = F.lower(line)
    odd = F.lit(False)
    for x in ("  ", *map(chr, range(9, 14))):
        odd |= line.contains(x)
    return F.trim(F.when(odd, F.regexp_replace(lower, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")).otherwise(lower))


def shingles(norm: Column) -> Column:
    """Hashes of the distinct shingles of a line. Code points have four bytes here, by which a shingle is found without
    reading what stands before it."""
    starts = F.sequence(F.lit(0), F.greatest(F.length(norm) - SHINGLE, F.lit(0)))
    piece = lambda wide, at: F.substr(wide, at * 4 + 1, F.lit(4 * SHINGLE))
    return F.array_distinct(let(F.encode(norm, "UTF-32"), lambda wide: F.transform(starts, lambda at: F.xxhash64(piece(wide, at)))))


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str = "__row") -> DataFrame:
    """Lines of numbered documents that take part: row, doc_id, pos, line."""
    rows = docs.select(F.col(row_col).alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    lines = rows.select("row", "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    blank = F.btrim("line", F.lit(" \t\n\v\f\r")) == ""
    return lines.filter((F.length("line") >= MIN_CHARS) & ~blank)


def keyed(lines: DataFrame) -> DataFrame:
    """Lines with two hashes of their normal form."""
    norm = lines.select("row", "doc_id", "pos", normal(F.col("line")).alias("norm"))
    return norm.select("row", "doc_id", "pos", F.xxhash64("norm").alias("h1"), F.xxhash64(F.lit(1), "norm").alias("h2"))


def signatures(lines: DataFrame) -> DataFrame:
    """The MinHash signature of each different normal form: h1, h2, the number of its lines and a value per band, of
    the ROWS least shingle hashes by as many orders.

    STRIDE shingles are a row on the way to the least ones, so that a line of any length is no array of them. Shingles
    have SHINGLE units of UTF-16 here, by which one is found without reading what stands before it; an order is that of the
    hashes with some bits turned over.
    """
    norm = lines.select(normal(F.col("line")).alias("norm")).withColumn("wide", F.encode("norm", "UTF-16BE"))
    last = F.greatest(F.floor(F.octet_length("wide") / 2).cast("int") - SHINGLE, F.lit(0))
    wide = norm.select(F.xxhash64("norm").alias("h1"), F.xxhash64(F.lit(1), "norm").alias("h2"), "wide", last.alias("last"))
    each = wide.select("h1", "h2", "wide", "last", F.explode(F.sequence(F.lit(0), "last", F.lit(STRIDE))).alias("at"))
    # Behind the end the last shingle is taken again.
    piece = lambda k: F.substr("wide", F.least(F.col("at") + k, F.col("last")) * 2 + 1, F.lit(2 * SHINGLE))
    hashed = each.select("h1", "h2", "at", *[F.xxhash64(piece(k)).alias(f"hash{k}") for k in range(STRIDE)])
    turned = lambda bits: F.least(*[F.col(f"hash{k}").bitwiseXOR(F.lit(bits)) for k in range(STRIDE)])
    least = [F.min(turned(bits)).alias(f"least{k}") for k, bits in enumerate(TURNED)]
    merged = hashed.groupBy("h1", "h2").agg(F.sum((F.col("at") == 0).cast("long")).alias("times"), *least)
    values = [F.xxhash64(F.lit(b), *[F.col(f"least{b * ROWS + k}") for k in range(ROWS)]) for b in range(BANDS)]
    return merged.select("h1", "h2", "times", F.array(*values).alias("bands"))


def bounds_of(texts: DataFrame) -> DataFrame:
    """The number of shingles of each text (row, items) and their parities, a long a column."""
    each = texts.select("row", F.explode(shingles(F.col("items"))).alias("hash"))
    word, bit = F.shiftright("hash", 6).bitwiseAND(F.lit(WORDS - 1)), F.expr("shiftleft(1L, cast(hash & 63 as int))")
    odd = [F.bit_xor(F.when(word == k, bit).otherwise(F.lit(0).cast("long"))).alias(f"word{k}") for k in range(WORDS)]
    return each.groupBy("row").agg(F.count("*").alias("n"), *odd)


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str = "__row") -> DataFrame:
    """Lines of numbered documents that go (row, pos): all of a component of similar lines but the first by doc_id
    and position. Equal lines are one entry, however many there are."""
    lines = lines_of(docs, id_col, text_col, row_col)
    keys = stored(keyed(lines), "keys")
    # Copies of one line are one entry and told by their hashes.
    signed = stored(signatures(lines), "signed")
    banded = signed.select(F.explode("bands").alias("list"), "h1", "h2", "times")
    shared = stored(banded.groupBy("list").agg(F.min("h1").alias("x"), F.max("h1").alias("y")).filter("x != y").select("list"), "bands")
    met = stored(banded.join(broadcast_if_small(shared, SMALL), "list"), "met")
    listed = stored(met.select("h1", "h2").distinct().withColumn("id", F.monotonically_increasing_id()), "listed")
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row", "pos")
    distinct = keys.groupBy("h1", "h2").agg(F.min(place).alias("place"), F.count("*").alias("times"))
    entries = stored(distinct.join(broadcast_if_small(listed, SMALL), ["h1", "h2"], "left").filter("times > 1 or id is not null"), "entries")
    first = entries.filter("id is not null").select("id", F.col("place.row").alias("row"), F.col("place.pos").alias("pos"))
    placed = lines.select("row", "pos", "line").join(broadcast_if_small(first, SMALL), ["row", "pos"]).select(
        F.col("id").alias("row"), normal(F.col("line")).alias("items"))
    texts = stored(placed, "texts")
    told = stored(bounds_of(texts), "told")
    # Lines too long for their parities to tell bring their sets.
    long = told.filter(F.col("n") > 64 * WORDS).select("row").join(texts, "row").select("row", shingles(F.col("items")).alias("more"))
    bounds = told.select("row", "n", F.array(*[f"word{k}" for k in range(WORDS)]).alias("words")).join(long, "row", "left")
    lists = stored(met.join(broadcast_if_small(listed, SMALL), ["h1", "h2"]).withColumnRenamed("id", "row").join(told.select("row", "n"), "row").select(
        "list", "row", "n", F.lit(1).alias("matches"), F.col("times").cast("double").alias("common")), "lists")
    links = list_links(lists, lambda met: texts, PERCENT, bounds, lambda x, y, sizes: similar(x, y, PERCENT), rounds=1, items=shingles)
    found = stored(components(links), "components")
    several = stored(entries.join(found.withColumnRenamed("node", "id"), "id", "left").filter("times > 1 or component is not null"), "several")
    stays = several.filter("component is not null").groupBy("component").agg(F.min("place").alias("stays"))
    groups = several.join(stays, "component", "left").withColumn("stays", F.coalesce("stays", "place"))
    groups = stored(groups.select("h1", "h2", F.col("stays.row").alias("row_stays"), F.col("stays.pos").alias("pos_stays")), "groups")
    met = keys.select("row", "pos", "h1", "h2").join(broadcast_if_small(groups, SMALL), ["h1", "h2"])
    return met.filter("row != row_stays or pos != pos_stays").select("row", "pos")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 n_lines: str | None = None, n_removed: str | None = None) -> DataFrame:
    """`docs` with repeated lines taken out of the text, columns unchanged but for the counts asked for.

    Lines end at \\n. Of lines whose shingle sets share PERCENT of their union, directly or through
    others, the first by doc_id (null last), row and position stays; lines shorter than MIN_CHARS
    and blank ones stay wherever they are. Null texts stay null and empty ones empty; a text may become empty. Rows may
    repeat: then the first row keeps its lines. An empty table gives no rows.
    """
    docs = numbered(docs, "__row")
    gone = stored(repeated_lines(docs, id_col, text_col).groupBy(F.col("row").alias("__row")).agg(F.collect_set("pos").alias("__gone")), "gone")
    text = F.col(text_col)
    left = F.array_join(F.filter(F.split(text, "\n", -1), lambda line, i: ~F.array_contains("__gone", i)), "\n")
    joined = docs.join(broadcast_if_small(gone), "__row", "left")
    counts = {}
    if n_lines:
        counts[n_lines] = F.coalesce(F.size(F.split(text, "\n", -1)), F.lit(0)).cast("long")
    if n_removed:
        counts[n_removed] = F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("long")
    return joined.withColumns({**counts, text_col: F.when(F.col("__gone").isNull(), text).otherwise(left)}).drop("__row", "__gone")


def line_report(docs: DataFrame) -> DataFrame:
    kept = deduplicated(docs.select("doc_id", "text"), n_lines="n_lines", n_removed="n_removed")
    return kept.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))
