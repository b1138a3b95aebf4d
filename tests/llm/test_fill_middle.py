import re
from hashlib import sha256

from veldcube.llm import fill_middle


def by_hand(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    digest = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = ["a\nb\nc", "a\nb\nc\n", "\n", "\n\n\n", "one line", None, "", "x <P> y\nz", "x\n<M>", "<S>", "< P>\n<P\n>S><", "<\nP>\n<<\n>>M>",
         "ünï\ncødé 😀\n漢字\n\r\nq", "\r\n\r\n", " \n \n", "tab\tline\x0bbreak\x85   none\nend", "w\n" * 3000, "long " * 200_000 + "\nend", "a\0b\nc"]


def test_all_texts_like_by_hand(make_docs, monkeypatch):
    monkeypatch.setattr(fill_middle, "SLICE_BYTES", 64)
    rows = [(10 * i + k, t, None, "s") for i, t in enumerate(TEXTS) for k in range(8)]
    rows += [(None, "a\nb", None, None), (3, "a\nb\nc", None, "s"), (3, "a\nb\nc", None, "s")]
    texts = {}
    for i, t, *_ in rows:
        texts.setdefault(i, t)
    docs = make_docs(rows)
    got = fill_middle.restored(fill_middle.transformed(docs)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == by_hand(r.doc_id, texts[r.doc_id])
        assert r.restored == (texts[r.doc_id] or "")
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert len(fill_middle.restored(fill_middle.restored(fill_middle.transformed(docs))).columns) == 7


def test_rate_separator_and_seed(make_docs):
    docs = make_docs([(i, "a b c d e", None, "s") for i in range(400)])
    got = fill_middle.restored(fill_middle.transformed(docs, seed=3, separator=" ", rate=40, spm=0)).collect()
    forms = [r.form for r in got]
    assert forms.count("spm") == 0 and 100 < forms.count("psm") < 220 and all(r.n == 5 and r.restored == "a b c d e" for r in got)
    assert [r.output for r in got] != [r.output for r in fill_middle.transformed(docs, separator=" ").collect()]


def test_nothing_and_digests(make_docs):
    assert fill_middle.middle_report(make_docs([])).count() == 0
    (row,) = fill_middle.middle_report(make_docs([(5, "a\nb\nc\nd", "en", None)])).collect()
    assert row.restored_sha256 == sha256(b"a\nb\nc\nd").hexdigest()
    assert row.output_sha256 == sha256(by_hand(5, "a\nb\nc\nd")[4].encode()).hexdigest()
