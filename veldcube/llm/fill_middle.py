"""Fill-in-the-middle transformation of texts, worked out on whole Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: What stands before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Forms of a transformed text: as it was, prefix first, suffix first.
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Texts of a batch are worked on in slices of about this many bytes; one longer text is a slice of its own.
SLICE_BYTES = 16 << 20

SCHEMA = "n long, form string, prefix_chars long, middle_chars long, output string"


def drawn(id_col: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32 for each id: the first groups of eight digits of the SHA-256 of "seed:id"."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def slices(batch: pa.RecordBatch, texts: pa.Array) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, as many at a time as hold SLICE_BYTES of `texts`."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def modulo(x: pa.Array, by: pa.Array | pa.Scalar) -> pa.Array:
    return pc.subtract(x, pc.multiply(pc.divide(x, by), by))


def units_of(texts: pa.Array, separator: str) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """All units of `texts`, each with its separator at the end: the units, the text each belongs to, its
    place there, and the number of units of every text."""
    pieces = pc.split_pattern(texts, separator)
    flat, parent = pieces.flatten(), pc.list_parent_indices(pieces)
    length = pc.list_value_length(pieces).cast(pa.int64())
    first = pc.subtract(pc.cumulative_sum(length), length)
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), first.take(parent))
    last = pc.equal(ordinal, pc.subtract(length, 1).take(parent))
    unit = pc.binary_join_element_wise(flat, pc.if_else(last, "", separator), "")
    real = pc.not_equal(unit, "")  # the piece after a last separator is none
    empty_end = pc.or_(pc.equal(texts, ""), pc.ends_with(texts, separator))
    return unit.filter(real), parent.filter(real), ordinal.filter(real), pc.subtract(length, empty_end.cast(pa.int64()))


def joined(units: pa.Array, counts: pa.Array) -> pa.Array:
    """Units put together again, `counts` of them for each text."""
    offsets = np.concatenate([[0], np.cumsum(counts.to_numpy(zero_copy_only=False))]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), units), "")


def rearranged(texts: pa.Array, h: list[pa.Array], separator: str, rate: int, spm: int) -> list[pa.Array]:
    """Columns of SCHEMA for whole texts and their four numbers."""
    units, parent, ordinal, n = units_of(texts, separator)
    ends = pc.add(n, 1)
    one, two = modulo(h[0], ends), modulo(h[1], ends)
    cut, end = pc.min_element_wise(one, two), pc.max_element_wise(one, two)
    role = pc.add(pc.greater_equal(ordinal, cut.take(parent)).cast(pa.int8()), pc.greater_equal(ordinal, end.take(parent)).cast(pa.int8()))
    sizes = [cut, pc.subtract(end, cut), pc.subtract(n, end)]
    prefix, middle, suffix = (joined(units.filter(pc.equal(role, k)), size) for k, size in enumerate(sizes))
    marked = pc.match_substring_regex(texts, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    hundred = pa.scalar(100, pa.int64())
    plain = pc.or_(pc.or_(pc.equal(texts, ""), marked), pc.greater_equal(modulo(h[2], hundred), rate))
    suffix_first = pc.less(modulo(h[3], hundred), spm)
    form = pc.if_else(plain, PLAIN, pc.if_else(suffix_first, SPM, PSM))
    pieces = pc.if_else(suffix_first, pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, ""),
                        pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, ""))
    output = pc.if_else(plain, texts, pc.binary_join_element_wise(pieces, MIDDLE, middle, ""))
    chars = lambda x: pc.if_else(plain, None, pc.utf8_length(x).cast(pa.int64()))
    return [n, form, chars(prefix), chars(middle), output]


def put_back(form: pa.Array, output: pa.Array) -> pa.Array:
    """The texts that `output` was made of."""
    plain = pc.equal(form, PLAIN)
    halves = pc.split_pattern(pc.if_else(plain, PREFIX + SUFFIX + MIDDLE, output), MIDDLE, max_splits=1)
    middle = pc.list_element(halves, 1)
    outer = pc.split_pattern_regex(pc.utf8_slice_codeunits(pc.list_element(halves, 0), len(PREFIX)), f"{PREFIX}|{SUFFIX}", max_splits=1)
    suffix_first = pc.equal(form, SPM)
    left, right = pc.list_element(outer, 0), pc.list_element(outer, 1)
    text = pc.binary_join_element_wise(pc.if_else(suffix_first, right, left), middle, pc.if_else(suffix_first, left, right), "")
    return pc.if_else(plain, output, text)


def transformed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7,
                separator: str = "\n", rate: int = 100, spm: int = 50) -> DataFrame:
    """Texts rearranged for infilling: doc_id, n, form, prefix_chars, middle_chars, output.

    A text is cut into n units that end with `separator` (the last one may lack it), two of the n + 1
    cuts are drawn from the id and `seed`, and the parts are written prefix, suffix, middle ("psm") or
    suffix, prefix, middle ("spm", `spm` of 100 texts), each after its mark. Texts stay "plain" when
    they are empty or hold a mark, and 100 - `rate` of 100 others; their prefix_chars and middle_chars
    are null. Each row stands alone: nothing is shuffled.

    Null texts count as empty, null ids draw like an empty id; rows may repeat and get equal results.
    Other columns are not read. An empty table gives no rows. Outputs are limited, as all strings of
    Spark are, to 2 GB.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, batch.column(1)):
                out = rearranged(rows.column(1), [rows.column(2 + k) for k in range(4)], separator, rate, spm)
                yield pa.RecordBatch.from_arrays([rows.column(0), *out], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    numbers = [c.alias(f"h{k}") for k, c in enumerate(drawn(F.col(id_col), seed))]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *numbers)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {SCHEMA}")


def restored(rows: DataFrame) -> DataFrame:
    """`rows`, as `transformed` gives them, with the column `restored`: the text rebuilt from form and output alone.
    Rows whose form or output is null get a null; a column of that name is replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            for part in slices(batch, batch.column(names.index("output"))):
                text = put_back(part.column(names.index("form")), part.column(names.index("output")))
                yield pa.RecordBatch.from_arrays([*part.columns, text], [*names, "restored"])

    rows = rows.drop("restored")
    return rows.mapInArrow(run, StructType([*rows.schema, StructField("restored", StringType())]))


def middle_report(docs: DataFrame) -> DataFrame:
    """Digests of the transformed texts and of those rebuilt from them."""
    return restored(transformed(docs)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


MIDDLE_SQL = r"""
with units as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as u,
         sha256('7:' || coalesce(cast(doc_id as varchar), '')) as d
  from documents
), drawn as (
  select *, len(u) as n, cast('0x' || substr(d, 1, 8) as bigint) % (len(u) + 1) as c1,
         cast('0x' || substr(d, 9, 8) as bigint) % (len(u) + 1) as c2,
         case when t = '' or t like '%<P>%' or t like '%<S>%' or t like '%<M>%' or cast('0x' || substr(d, 17, 8) as bigint) % 100 >= 100 then 'plain'
              when cast('0x' || substr(d, 25, 8) as bigint) % 100 < 50 then 'spm' else 'psm' end as form
  from units
), parts as (
  select *, array_to_string(u[1:least(c1, c2)], '') as p, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') as m,
         array_to_string(u[greatest(c1, c2) + 1:n], '') as s
  from drawn
)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars,
       case when form <> 'plain' then length(m) end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
              else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(case form when 'plain' then t else p || m || s end) as restored_sha256
from parts
"""
