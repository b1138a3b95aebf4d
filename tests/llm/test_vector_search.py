import math

import numpy as np
import pytest

from veldcube.llm import vector_search
from veldcube.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, node long, list int, block string, rank int, score string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2, 3, "x", 4, "y") for i, v in rows], SCHEMA)


def brute(rows, every, neighbours):
    """All distances in double precision of the 32-bit values."""
    fine = {}
    for i, v in rows:
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            fine[(i, tuple(np.float32(v).astype(float)))] = None
    want = {}
    for i, v in fine:
        if i is not None and i % every == 0:
            near = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(v, w, strict=True))), j if j is not None else 1 << 63)
                          for j, w in fine if (j, w) != (i, v) and len(w) == len(v))
            want.setdefault(i, []).append(near[:neighbours])
    return want


def answers(got):
    out = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id if r.vec_id is not None else 1 << 63))
        assert r["rank"] == len(out[r.query_id])
    return out


def same(got, want):
    assert got.keys() == {i for i, near in want.items() if near[0]}
    for i, near in got.items():
        assert [j for _, j in near] == [j for _, j in want[i][0]]
        assert [d for d, _ in near] == pytest.approx([d for d, _ in want[i][0]], rel=1e-12, abs=1e-12)


def test_all_found_when_all_lists_are_probed(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "BLOCK", 16)
    monkeypatch.setattr(vector_search, "CHUNK", 3)
    monkeypatch.setattr(vector_search, "PER_CENTRE", 4)
    rng = np.random.default_rng(5)
    rows = [(i, list(rng.standard_normal(20))) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(60)] + [(400 + i, [x + 1e-4 * i for x in rows[8][1]]) for i in range(60)]
    rows += [(500, None), (501, []), (502, [0.0] * 20), (503, [None] + [1.0] * 19), (504, [float("nan")] * 20), (505, [float("inf")] * 20), (510, [0.0] * 20)]
    rows += [(520 + i, list(rng.standard_normal(3))) for i in range(6)] + [(None, rows[7][1]), (None, list(rng.standard_normal(20)))]
    rows += [rows[10], rows[10], rows[305]]
    got = answers(vector_search.nearest(table(spark, rows), every=5, recall=1.0).collect())
    same(got, brute(rows, 5, 10))


def test_ties_go_to_the_smaller_id(spark):
    axes = [[float(s * (k == d)) for k in range(8)] for d in range(8) for s in (1, -1)]
    rows = [(0, [0.5] * 8)] + [(100 - i, v) for i, v in enumerate(axes)] + [(200 + i, v) for i, v in enumerate(axes)]
    same(answers(vector_search.nearest(table(spark, rows), every=1000).collect()), brute(rows, 1000, 10))


def test_few_or_no_candidates(spark):
    assert vector_search.nearest(table(spark, [])).count() == 0
    assert vector_search.nearest(table(spark, [(0, [1.0, 2.0]), (0, [1.0, 2.0])])).count() == 0
    two = vector_search.nearest(table(spark, [(0, [1.0, 2.0]), (7, [1.0, 3.0]), (100, None)])).collect()
    assert [tuple(r) for r in two] == [(0, 1, 7, 1.0)]
    twice = vector_search.nearest(table(spark, [(0, [1.0, 0.0]), (0, [3.0, 0.0]), (5, [1.5, 0.0])]), neighbours=1).collect()
    assert sorted((r.vec_id, r.score) for r in twice) == [(5, 0.5), (5, 1.5)]


def test_scan_gives_up_far_candidates_only():
    rng = np.random.default_rng(1)
    x, p = rng.standard_normal((1000, 64)), rng.standard_normal((4, 64))
    columns = [np.ascontiguousarray(x.T[d : d + 16]) for d in range(0, 64, 16)]
    far = np.sqrt(((p[:, None] - x[None]) ** 2).sum(2))
    limits = np.sort(far, axis=1)[:, 30]
    q, r = vector_search.scan(columns, p, limits, 20)
    assert {(a, b) for a in range(4) for b in np.argsort(far[a])[:20]} <= set(zip(q.tolist(), r.tolist(), strict=True))
    assert len(q) <= 80


def test_recall_on_unstructured_and_clustered_vectors(spark):
    rng = np.random.default_rng(2)
    loose = rng.standard_normal((4000, 24))
    tight = loose[:40].repeat(50, 0) + 0.1 * rng.standard_normal((2000, 24))
    x = np.concatenate([loose, tight]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = answers(vector_search.nearest(table(spark, rows), every=50).collect())
    assert len(got) == 120 and all(len(near) == 10 for near in got.values())
    hits = 0
    for i, near in got.items():
        far = np.sqrt(((x.astype(float) - x[i].astype(float)) ** 2).sum(1))
        far[i] = np.inf
        hits += len({j for _, j in near} & set(np.lexsort((np.arange(len(x)), far))[:10].tolist()))
        assert [d for d, _ in near] == pytest.approx([far[j] for _, j in near], rel=1e-12)
    assert hits >= 0.95 * 1200


def test_query_on_its_whole_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got, want = answers(QUERIES["op12_vector_search"](spark, sf_dir).collect()), brute(rows, 100, 10)
    assert got.keys() == want.keys()
    assert sum(len({j for _, j in near} & {j for _, j in want[i][0]}) for i, near in got.items()) >= 9 * len(got)
