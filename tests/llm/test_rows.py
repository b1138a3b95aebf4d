"""Operators over an input whose rows come in another order in every job, as after a change of splits."""

import random

import pyarrow as pa
import pytest

import corpus_pipeline
from veldcube.llm import exact_dedup, line_dedup, mixing, ngram_join, warc


@pytest.fixture(scope="module")
def restless():
    def order(batches):
        rows = [b for b in batches if b.num_rows]
        if rows:
            table = pa.Table.from_batches(rows).combine_chunks()
            at = list(range(table.num_rows))
            random.SystemRandom().shuffle(at)
            yield from table.take(pa.array(at, pa.int64())).to_batches()

    return lambda df: df.coalesce(1).mapInArrow(order, df.schema)


@pytest.fixture(scope="module")
def docs(restless, make_docs, prose):
    rows = [(i, prose(i // 2, 30) + "\n" + prose(100 + i, 30), None, f"s{i % 3}") for i in range(60)]
    return restless(make_docs(rows + [(100 + i, rows[i][1], None, "s1") for i in range(0, 60, 3)])), {i: t for i, t, *_ in rows}


def test_lines_go_from_their_own_documents(docs, prose):
    made, texts = docs
    got = {r.doc_id: r.text for r in line_dedup.deduplicated(made).collect()}
    want = {i: t if i % 2 == 0 else t.split("\n")[1] for i, t in texts.items()}
    assert got == want | {100 + i: "" for i in range(0, 60, 3)}
    assert {r.doc_id for r in corpus_pipeline.drop_repeated_lines(made.sparkSession, made, "").collect()} == set(texts)


def test_documents_keep_their_own_groups(docs):
    made, texts = docs
    assert sorted(r.doc_id for r in ngram_join.one_of_each(made).collect()) == sorted(texts)
    assert all(r.component_id == (r.doc_id - 100 if r.doc_id >= 100 else r.doc_id) for r in ngram_join.similar_documents(made).collect())
    got = exact_dedup.exact_groups(made).collect()
    assert len(got) == 80 and all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_mixed_documents_are_those_that_the_mix_takes(docs):
    made, _ = docs
    want = {r.doc_id: r.copies for r in mixing.mix_rows(made).collect() if r.copies}
    got = [r.doc_id for r in mixing.mixed_documents(made).collect()]
    assert {i: got.count(i) for i in got} == want


def test_revisits_have_the_payload_of_their_response(spark, restless):
    rows = [(i, f"http://a.com/{i}", f"<p>page {i % 20} " + "text " * 30) for i in range(60)]
    pages = restless(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = warc.archive_report(pages).collect()
    assert {r.page_id: r.refers_to for r in got} == {i: i % 20 if i >= 20 else None for i in range(60)}
