import hashlib
import itertools
import random
import time

import numpy as np
import pytest

from veldcube.llm import embedding_dedup, html_text, warc

PAGES = "page_id long, url string, html string, text string, n_chars long, row long, payload string"


@pytest.fixture(scope="module")
def make_pages(spark):
    return lambda rows: spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], PAGES)


@pytest.mark.parametrize(("html", "text"), [
    ("", ""), ("plain text only", "plain text only"), ("<p>a<p>b", "a\n\nb"), ("<div", ""), ("<!-- x", ""), ("<script>a", ""),
    ("a < b &amp; c &lt; d", "a < b & c < d"), ("<p>one\n two<br>three", "one two three"),
    ("<article><header><h1>T</h1></header><p>x</p></article>", "T\n\nx"),
    ("<nav><a href=/>m</a></nav><article><h1>H</h1><p><b>bold<br><p>next</article><footer>&copy; f</footer>", "H\n\nbold\n\nnext"),
    ('<style>p{}</style><script>var t="</p>";</script><div class="ad">buy</div><article><p>x &amp;amp; y</p></article>', "x &amp; y"),
    ('<article><p>x</p><div id="comments"><p>nice, very nice.</p></div><aside>s</aside><form>f</form></article>', "x"),
    ("<p>a&nbsp;b <span class=ad>buy</span> c</p>", "a b c"), ("<body class=has-sidebar><p>kept</p></body>", "kept"),
    ("<article><ul><li>one<li>two</ul></article>", "one\n\ntwo"), ("<nav>menu</nav>", ""),
])
def test_main_text(html, text):
    assert html_text.main_text(html) == text


def test_pages_without_article_keep_the_dense_paths():
    body = "".join(f"<p>A sentence, with enough words, to count as text number {i}.</p>" for i in range(5))
    page = f"<body><div class='top'><a href=1>x</a></div><div class='body'>{body}</div><div class='sidebar'><p>side, text.</p></div></body>"
    assert html_text.main_text(page).count("\n\n") == 4


def test_extract_keeps_every_page(make_pages):
    rows = [(1, "u", "<p>a</p>"), (1, "u", "<p>a</p>"), (2, None, None), (None, "v", ""), (3, "w", "<article><p>" + "word " * 40_000 + "</p></article>")]
    got = html_text.extract(make_pages(rows)).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 0), (1, 1), (1, 1), (2, 0), (3, 199_999)]
    assert html_text.extract(make_pages([])).count() == 0


def test_loser_tree_merges_like_a_sort():
    rng = random.Random(4)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted((rng.randint(0, 30), rng.randint(0, 5)) for _ in range(rng.randint(0, 40))) for _ in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(itertools.chain(*runs))


def test_url_keys():
    assert warc.url_key("https://www.Example.com:443/A?b=C#d") == "com,example)/a?b=c"
    assert warc.url_key("http://a.b.org:8080") == "org,b,a:8080)/" and warc.url_key(None) == "" and warc.url_key("no url") == "no url"


def test_archive_round_trip(spark, make_pages, tmp_path):
    long, other = "<p>" + "long text " * 20, "é\r\n\r\nWARC/1.1\r\n" * 20
    rows = [(5, "http://b.com/x", long), (2, "http://a.com/", long), (9, "http://a.com/", long), (3, None, "short"), (4, "http://a.com/z y", "short"), (6, "", None), (7, "u", ""),
            (8, "http://c.com", other), (1, "http://c.com", other), (None, "n", long), (8, "http://c.com", other)]
    path = f"file://{tmp_path}/warc"
    assert warc.archive(make_pages(rows), path).count() == len(rows)
    index = warc.merged_index(warc.capture_runs(spark, path)).collect()
    assert len(index) == len(rows)
    assert [(r.url_key, r.captured, r.capture) for r in index] == sorted((r.url_key, r.captured, r.capture) for r in index)
    report = sorted(warc.archive_report(make_pages(rows)).collect(), key=lambda r: (r.page_id is None, r.page_id or 0, r.record_type))
    first = {}
    for i, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(h or "", i)
    seen = set()
    by_id = {}
    for r in report:
        by_id.setdefault(r.page_id, []).append(r)
    for i, _, h in rows:
        data = (h or "").encode()
        assert all(r.payload_bytes == len(data) and r.payload_digest == hashlib.sha256(data).hexdigest() for r in by_id[i])
        kinds = sorted((r.record_type, r.refers_to) for r in by_id[i])
        if len(data) < 100:
            assert kinds == [("response", None)]
        elif i == first[h] and i not in seen:
            assert kinds[0] == ("response", None)
        else:
            assert ("revisit", first[h]) in kinds
        seen.add(i)
    assert warc.archive_report(make_pages([])).count() == 0


def test_broken_archives_are_errors():
    for data in (b"junk", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.parse_records(data))


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows, vectors = [], {}

    def add(i, v):
        rows.append((i, None if v is None else [None if x is None else float(x) for x in v], 1, 2, 3))

    base = rng.standard_normal((40, 16))
    for k in range(40):
        for c in range(1 + k % 6):
            add(1000 - len(rows), (base[k] + 0.12 * c * rng.standard_normal(16)).astype(np.float32))
    hot = rng.standard_normal(16)
    for _ in range(700):  # one bucket of several blocks
        add(5000 - len(rows), (hot + 0.1 * rng.standard_normal(16)).astype(np.float32))
    add(9001, base[0].astype(np.float32))
    add(9002, 3 * base[0].astype(np.float32))
    add(9003, base[0].astype(np.float32))
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [1.0, 2.0]]
    for k, v in enumerate(odd):
        add(9100 + k, v)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, node long, size long")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    assert len(got) == len(rows)
    for i, v, *_ in rows:
        if v is not None and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            vectors[i] = np.array(v, np.float32).astype(float)
    ids = list(vectors)
    x = np.stack([vectors[i] / np.linalg.norm(vectors[i]) for i in ids])
    near = x @ x.T >= 0.95
    label = np.array(ids)
    while True:
        least = np.array([label[near[k]].min() for k in range(len(ids))])
        if (least == label).all():
            break
        label = least
    missed = sum(int(near[k].sum()) - 1 - got[i].n_links for k, i in enumerate(ids))
    assert 0 <= missed <= 0.001 * near.sum()
    assert all(got[i].n_links <= near[k].sum() - 1 for k, i in enumerate(ids))
    assert all(got[i].component_id == label[k] and got[i].kept == (i == label[k]) for k, i in enumerate(ids))
    assert all((r := got[9100 + k]).n_links == 0 and r.component_id == 9100 + k and r.kept for k in range(len(odd)))
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


P400 = ("A sentence of the article, with enough words to count. " * 8).strip()
SMALL_BLOCKS = {
    "table": ["T", *[P400] * 8, *[f"c{k}" for k in range(24)]],
    "nested": ["T", *[P400] * 8, *[f"item of the list, {k:02}" for k in range(6)]],
    "pre": ["T", *["An ordinary paragraph, with a few words."] * 10, "x = 1; y = 2. " * 4300],
    "headings": ["T", *[f"Part {k}" for k in range(6)], "Word after word, and so on. " * 2200],
}
SMALL_BLOCKS = {k: [x.strip() for x in v] for k, v in SMALL_BLOCKS.items()}


def small_blocks(kind):
    text = SMALL_BLOCKS[kind]
    p = "".join(f"<p>{x}</p>" for x in text[1:9])
    if kind == "table":
        inner = p + "<table>" + "".join(f"<tr><td>{a}</td><td>{b}</td></tr>" for a, b in zip(text[9::2], text[10::2], strict=True)) + "</table>"
    elif kind == "nested":
        inner = p + "<ul><li><ul>" + "".join(f"<li>{x}</li>" for x in text[9:]) + "</ul></li></ul>"
    elif kind == "pre":
        inner = "".join(f"<p>{x}</p>" for x in text[1:11]) + f"<pre>{text[11]}</pre>"
    else:
        inner = "".join(f"<h2>{x}</h2>" for x in text[1:7]) + f"<p>{text[7]}</p>"
    return f"<h1>T</h1>{inner}", "\n\n".join(" ".join(x.split()) for x in text)


@pytest.mark.parametrize("kind", SMALL_BLOCKS)
def test_small_blocks_of_an_article_stay(kind):
    inner, text = small_blocks(kind)
    for root in ("article", "main"):
        assert html_text.main_text(f"<html><body><nav><a href=/>m</a></nav><div><{root}>{inner}</{root}></div></body></html>") == text


@pytest.mark.parametrize("kind", SMALL_BLOCKS)
def test_small_blocks_of_a_page_without_article_stay(kind):
    inner, text = small_blocks(kind)
    inner, text = inner.replace("<h1>T<", "<h1>The title<"), "The title" + text[1:]
    assert html_text.main_text(f"<html><body><div class=x>{inner}</div><div class=y><a href=/1>more from here</a></div></body></html>") == text


def test_link_lists_inside_an_article_go_and_linked_headings_stay():
    links = "".join(f"<li><a href=/{k}>Another page of this site</a></li>" for k in range(5))
    page = f"<article><h1><a href=/>The title</a></h1><p>{P400}</p><div><ul>{links}</ul></div></article>"
    assert html_text.main_text(page) == f"The title\n\n{P400}"
    assert html_text.main_text("<article><p><a href=/>All of it</a></p></article>") == "All of it"


def test_the_ratio_decides_inside_an_article():
    long = "<p>" + "words, " * 9_000 + "end.</p>"
    deep = lambda inner, kind="x": f"<section class={kind}>" * 9 + inner + "</section>" * 9
    marks = "".join(f"<div><a href=/{k}>{k}</a>|</div>" for k in range(1, 9))
    got = html_text.main_text(f"<body><article><h1>Head</h1>{long}{deep(marks, 'y')}{deep('<p>Down here, a sentence.</p>')}</article></body>")
    assert "|" not in got
    assert got.startswith("Head\n\nwords, ") and got.endswith("end.\n\nDown here, a sentence.")


def test_words_in_other_values_and_wrappers_are_no_noise():
    long = "A sentence of the article, long enough to count. " * 3
    assert html_text.main_text(f'<body><div class="layout has-sidebar"><h1>Head</h1><p>{long}</p><div class="sidebar"><p>Side.</p></div></div></body>') == f"Head\n\n{long.strip()}"
    assert html_text.main_text(f'<body><div class="sidebar-layout"><p>{long}</p><nav><a href="/">Home</a></nav></div></body>') == long.strip()
    assert html_text.main_text('<body><div class="menu"><p>One.</p><p>Two.</p></div></body>') == ""
    article = lambda inner: html_text.main_text(f"<body><article><p>{long}</p>{inner}</article></body>")
    assert article('<p title="the hidden truth">Stays.</p>').endswith("Stays.")
    assert article('<p>See <a href="view?id=comment-12">the first report</a> there.</p>').endswith("See the first report there.")
    assert article('<p>See <a href="/hidden/gems">gems</a> there.</p>').endswith("See gems there.")
    assert article('<section class="related-work"><p>Others did this before.</p></section>').endswith("before.")
    assert "Gone" not in article('<div class="related-posts"><p>Gone.</p></div><div hidden><p>Gone.</p></div><div aria-hidden=true><p>Gone</p></div>')


def test_deep_nesting_takes_no_time():
    start = time.time()
    deep = "<div>" * 20_000
    assert html_text.main_text(f"<body>{deep}<p>Down here, a sentence.</p><p>And another one.</p>") == "Down here, a sentence.\n\nAnd another one."
    assert time.time() - start < 5
