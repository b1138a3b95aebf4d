import glob
import hashlib
import itertools
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from veldcube.llm import common, exact_dedup, line_dedup, list_links, ngram_join


def groups(ids, linked):
    """Smallest id that each id reaches."""
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 200), (300, 301), (301, 300)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == groups({x for e in edges for x in e}, edges)
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_running_total_spans_partitions(spark):
    rows = [("hot" if i % 4 else None, (i * 7919) % 1000, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, o long, v long")
    got = {(r.g, r.o): r.t for r in common.running_total(df, ["o"], "v", "t", "g").collect()}
    for g in ("hot", None):
        total = 0
        for _, o, v in sorted((r for r in rows if r[0] == g), key=lambda r: r[1]):
            total += v
            assert got[g, o] == total


EDGES = [(1, "a  b", None, None), (2, "a b", "x", None), (3, "a\t\n b", None, "s"), (3, "a b", None, "s"), (4, None, None, None), (5, "", None, None),
         (6, " ", None, None), (None, "a b", None, None), (7, "é" * 3000, None, None), (None, "q", None, None), (8, "A b", None, None)]


@pytest.mark.parametrize("key", [None, "length(norm) % 3"])
def test_exact_groups_equal_brute_force(make_docs, key):
    texts = {}
    for i, t, *_ in EDGES:
        texts.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    # A weak key makes different texts collide; they are chained and told apart by their bytes.
    made = exact_dedup.exact_groups(make_docs(EDGES), key=None if key is None else F.expr(key).cast("long"), bucket_keys=2).collect()
    assert len(made) == len(EDGES)
    digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in texts.items()}
    for r in made:
        ids = digest[r.text_sha256]
        assert r.keep_id == min((i for i in ids if i is not None), default=None) and r.group_size == len(ids) and r.doc_id in ids
    assert sum(r.kept for r in made) == len(texts)
    assert all(r.doc_id == r.keep_id for r in made if r.kept)


def test_exact_groups_of_an_empty_table(make_docs):
    assert exact_dedup.exact_report(make_docs([])).count() == 0


def test_directory_splits_overfull_buckets_only(spark):
    dense = spark.range(200).select((F.col("id") * 3).alias("key"))  # all in the first slot of any depth
    spread = spark.range(300).select(F.xxhash64("id").alias("key"))
    depth, slots = exact_dedup.directory(dense.union(spread), bucket_keys=100)
    rows = dense.union(spread).select(exact_dedup.slot(F.col("key"), depth).alias("slot")).join(slots, "slot")
    sizes = {r.bucket: (r.n, r.depth) for r in rows.groupBy("bucket").agg(F.count("*").alias("n"), F.max("depth").alias("depth")).collect()}
    assert all(n <= 100 or d == depth for n, d in sizes.values()) and len({d for _, d in sizes.values()}) > 1
    assert sum(n for n, _ in sizes.values()) == 500


def shingle_set(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_ngram_join_equals_brute_force(make_docs, prose, k, percent):
    rows = []
    for base in range(6):
        words = prose(base, 60 + 40 * base).split()
        for copy in range(12):  # near copies of a text, at many distances from one another
            w = list(words)
            for at in range(copy % 5):
                w[(at * 13 + copy * 7) % len(w)] = f"new{copy}x{at}"
            rows.append((1000 - len(rows), " ".join(w), None, None))
    rows += [(1, "One two", None, None), (2, "one  TWO", None, None), (3, "one", None, None), (4, None, None, None), (5, "", None, None), (6, " \n", None, None),
             (7, "the " * 50, None, None), (8, "the " * 300, None, None), (9, "Ä b c", None, None), (10, "ä b c", None, None), (11, prose(9, 3000), None, None), (11, prose(9, 3000), None, None)]
    sets = {}
    for i, t, *_ in rows:
        sets[i] = shingle_set(t, k)
    linked = [(a, b) for a, b in itertools.combinations(sets, 2)
              if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = groups(sets, linked)
    got = ngram_join.similar_documents(make_docs(rows), k, percent).collect()
    assert len(got) == len(rows)
    assert all(r.n_shingles == len(sets[r.doc_id]) and r.component_id == want[r.doc_id] for r in got)
    assert sum(r.stays for r in got) == len(set(want.values()))


def test_ngram_join_of_null_ids_and_an_empty_table(make_docs):
    got = ngram_join.similar_documents(make_docs([(None, "a b c d", None, None), (None, "a b c d", None, None), (3, "a b c d", None, None)])).collect()
    assert [r.component_id for r in got] == [3, 3, 3] and sum(r.stays for r in got) == 1
    assert ngram_join.join_report(make_docs([])).count() == 0
    assert ngram_join.one_of_each(make_docs(EDGES)).columns == make_docs(EDGES).columns


def test_prefix_is_longer_where_shared_shingles_are_frequent():
    import numpy as np

    rare = ngram_join.choose_prefix(np.ones(100), 90, 0.0)
    assert rare[0] == 100 - 90 + rare[1]
    steep = ngram_join.choose_prefix(np.concatenate([np.ones(11), np.full(89, 1e6)]), 90, 0.0)
    assert steep == (11, 1)
    assert ngram_join.choose_prefix(np.ones(1), 90, 0.0) == (1, 1)


def line_set(line):
    norm = re.sub(r"[\x20\x09-\x0D]+", " ", line.lower()).strip(" ")
    return norm, frozenset(norm[k : k + line_dedup.SHINGLE] for k in range(max(1, len(norm) - line_dedup.SHINGLE + 1)))


def test_lines_equal_brute_force(make_docs, prose):
    base = [prose(s, 12) for s in range(8)]
    changed = [b.replace(b.split()[-1], "otherword") for b in base]
    rows = [(i, "\n".join([base[i % 8], prose(100 + i, 14), "short", changed[(i + 3) % 8].upper(), "  " + base[(i * 5) % 8] + "\t"]), None, None) for i in range(20, 0, -1)]
    rows += [(30, None, None, None), (31, "", None, None), (32, "\n\n", None, None), (33, base[0], None, None), (33, base[0], None, None), (None, base[1] + "\n" + prose(500, 20), None, None), (34, "x" * 5000, None, None)]
    placed = sorted(((i is None, i or 0, k, p, line) for k, (i, t, *_) in enumerate(rows) for p, line in enumerate((t or "").split("\n")) if len(line) >= line_dedup.MIN_CHARS))
    sets = {line_set(x[4]) for x in placed}
    linked = [(a[0], b[0]) for a, b in itertools.combinations(sets, 2) if 100 * len(a[1] & b[1]) >= line_dedup.PERCENT * len(a[1] | b[1])]
    component, seen, gone = groups({n for n, _ in sets}, linked), set(), {}
    for _, _, k, p, line in placed:
        c = component[line_set(line)[0]]
        if c in seen:
            gone.setdefault(k, set()).add(p)
        seen.add(c)
    want = sorted([(i is None, i or 0, t is None, None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone.get(k, ()))) for k, (i, t, *_) in enumerate(rows)], key=str)
    docs = make_docs(rows)
    made = line_dedup.deduplicated(docs)
    assert made.columns == docs.columns
    assert sorted([(r.doc_id is None, r.doc_id or 0, r.text is None, r.text) for r in made.collect()], key=str) == want
    assert sum(map(len, gone.values())) > 30


def test_lines_of_an_empty_table(make_docs):
    assert line_dedup.line_report(make_docs([])).count() == 0


def test_copies_that_hold_short_lines_go_whole(spark, make_docs, prose):
    whole = "\n".join([prose(1, 14), "Ment que.", "", "  ", prose(2, 14), "7"])
    rows = [(1, whole, None, None), (2, whole, None, None), (3, "\n" + whole.upper() + "\n\t", None, None), (4, "7\nits own line\n\n", None, None),
            (5, "\n \n", None, None), (6, None, None, None), (7, "", None, None), (8, "Ment  que.", None, None)]
    got = corpus_pipeline.drop_repeated_lines(spark, make_docs(rows), "").collect()
    assert {r.doc_id: r.text for r in got} == {1: whole, 4: "its own line\n\n", 5: "\n \n", 6: None, 7: ""}
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)


def test_lines_that_differ_behind_the_start_of_a_word_stay(make_docs):
    lines = ["https://www.example.org/articles/on-the-sea", "https://www.other.net/recipes/of-the-north", "Source: https://www.example.org/a-long-path/to-a-page",
             "Source: https://www.other.net/b-short-way/from-a-page", "東京都は日本の首都であり世界最大の都市の一つである人口は約千四百万人に達する",
             "東京都は日本の首都であり世界最大の美術館と庭園と川の多い街として知られている", "abcdefghijklmnopqrstuvwxyz", "abcdefghijklzyxwvutsrqponm"]
    near = "https://www.example.org/articles/on-the-sea-and-on-the-hills-and-in-the-woods-of-the-north/index"
    rows = [(i, line, None, None) for i, line in enumerate(lines)] + [(20, near + "-1", None, None), (21, near + "-2", None, None), (22, lines[4], None, None)]
    got = {r.doc_id: r.text for r in line_dedup.deduplicated(make_docs(rows)).collect()}
    assert got == {**dict(enumerate(lines)), 20: near + "-1", 21: "", 22: ""}


def test_line_dedup_stores_texts_of_candidates_not_their_sets(spark, make_docs, prose, monkeypatch):
    """What is written on the way stays small beside the lines: no table holds an array but the signatures' bands."""
    tables, write = {}, line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", lambda df, name, codec=None: tables.setdefault(name, write(df, name, codec)))
    line = prose(7, 40)
    docs = make_docs([(i, f"{line} {i}\n{prose(100 + i, 30)}\n{line}", None, None) for i in range(6)])
    got = {r.doc_id: r.text for r in line_dedup.deduplicated(docs).collect()}
    assert got[0].startswith(line) and all(got[i] == prose(100 + i, 30) for i in range(1, 6))
    assert [n for n, t in tables.items() if any(k.startswith("array") for _, k in t.dtypes)] == ["signed", "gone"]
    assert tables["texts"].count() == 7


def test_last_join_makes_no_rows_of_pairs_that_cannot_link(make_docs, prose, monkeypatch):
    """Many texts that share frequent shingles and are all a little too unlike."""
    tables, write = [], list_links.stored
    monkeypatch.setattr(list_links, "stored", lambda df, name, codec=None: tables.append((name, write(df, name, codec))) or tables[-1][1])
    base, rows = prose(3, 200).split(), []
    for i in range(40):
        w = list(base)
        for at in range(4):
            w[(i * 37 + at * 50) % len(w)] = f"new{i}x{at}"
        rows.append((i, " ".join(w), None, None))
    rows += [(50, rows[7][1] + " end", None, None)]
    got = {r.doc_id: r.component_id for r in ngram_join.similar_documents(make_docs(rows), 3, 90).collect()}
    assert got == {**{i: i for i in range(40)}, 50: 7}
    assert [t for n, t in tables if n == "pairs"][-1].count() < 40


def test_signatures_are_of_different_lines_and_likely_alike(make_docs, prose):
    base = [prose(900 + s, 40) for s in range(30)]
    near = [b + " more" for b in base]
    rows = [(i, f"{x}\n  {x.upper()}\t", None, None) for i, x in enumerate(base + near + ["short", "é" * 40])]
    lines = line_dedup.lines_of(common.numbered(make_docs(rows), "__row"))
    made = line_dedup.signatures(lines).collect()
    assert len(made) == 62 and all(r.times == 2 and len(r.bands) == line_dedup.BANDS for r in made)
    keys = {(r.h1, r.h2): r.doc_id for r in line_dedup.keyed(lines).collect()}
    bands = {keys[r.h1, r.h2]: set(r.bands) for r in made}
    assert all(bands[i] & bands[30 + i] for i in range(30))
    assert sum(bool(bands[i] & bands[j]) for i, j in itertools.combinations(range(30), 2)) < 22


def test_stored_tables_leave_no_shuffle_files(spark):
    rows = spark.range(20_000).withColumn("key", F.col("id") % 997).groupBy("key").agg(F.collect_list("id").alias("ids"))
    folder = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    shuffles = lambda: {f for top in folder for f in glob.glob(f"{top}/**/shuffle_*.data", recursive=True)}
    before = shuffles()
    setting = spark.conf.get(common.FREE_SHUFFLES, None)
    made = common.stored(rows, "grouped")
    for _ in range(50):
        if shuffles() <= before:
            break
        time.sleep(0.1)
    assert shuffles() <= before and spark.conf.get(common.FREE_SHUFFLES, None) == setting
    assert made.count() == 997


@pytest.mark.parametrize("size", [50, 700, 3_000, 9_000])
def test_bounds_of_sets_rule_out_unlike_pairs_only(spark, size):
    """Sets from equal to unlike, small ones and such as need more than the first words."""
    rng, k, sets = np.random.default_rng(size), list_links.WORDS, []
    base = rng.integers(0, 2**63, size, dtype=np.uint64)
    for share in (0, 0.02, 0.05, 0.1, 0.3, 1):
        own = rng.integers(0, 2**63, 1 + int(share * size), dtype=np.uint64)
        sets.append(np.unique(np.append(base[len(own) :], own)))
    signed = lambda words: [int(x) for x in words.view(np.int64)]
    more = [ngram_join.more_words(len(s)) for s in sets]
    bounds = spark.createDataFrame(
        [(i, len(s), signed(ngram_join.parities(s, k)), signed(ngram_join.parities(s, w)) if w else None) for i, (s, w) in enumerate(zip(sets, more, strict=True))],
        "row long, n long, words array<long>, more array<long>")
    pairs = list_links.bound_columns(bounds, "a").crossJoin(list_links.bound_columns(bounds, "b")).filter("a < b")
    for percent in (80, 90):
        got = {(r.a, r.b) for r in pairs.filter(list_links.may_link("a", "b", percent, ngram_join.large_may_link(percent))).collect()}
        share = {(a, b): len(np.intersect1d(sets[a], sets[b])) / len(np.union1d(sets[a], sets[b])) for a, b in itertools.combinations(range(len(sets)), 2)}
        assert {p for p, x in share.items() if 100 * x >= percent} <= got
        assert not got & {p for p, x in share.items() if x < 0.7}


def test_bounds_of_lines_are_of_their_distinct_shingles(spark, prose):
    texts = ["short", prose(1, 30), prose(1, 30) + " end", "ab" * 40, "東京都は日本の首都であり" * 3]
    made = line_dedup.bounds_of(spark.createDataFrame(list(enumerate(texts)), "row long, items string")).collect()
    sets = [line_set(t)[1] for t in texts]
    assert {r.row: r.n for r in made} == {i: len(s) for i, s in enumerate(sets)}
    words = {r.row: [r[f"word{k}"] & (2**64 - 1) for k in range(list_links.WORDS)] for r in made}
    bits = lambda a, b: sum((x ^ y).bit_count() for x, y in zip(words[a], words[b], strict=True))
    assert all(bits(a, b) <= len(sets[a] ^ sets[b]) for a, b in itertools.combinations(range(5), 2))
    assert bits(1, 3) > 100 and 0 < bits(1, 2) <= 5
