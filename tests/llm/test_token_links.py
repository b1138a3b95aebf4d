import random
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from veldcube.llm import token_links
from veldcube.llm.bpe import byte_symbols
from veldcube.llm.queries import QUERIES


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def by_hand(texts, libraries):
    """Every document's figures with the tokenizers' own libraries, link by link."""
    a, b = libraries
    byte = {s: i for i, s in enumerate(byte_symbols())}
    known, counts = {}, Counter()
    for d, text in enumerate(texts):
        raw = (" " + (text or "")).encode()
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            known[d] = None
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        links, j = [], 0
        for i, end in enumerate(ends_a):
            start = ends_a[i - 1] if i else 0
            while ends_b[j] <= start:
                j += 1
            k = j
            while k < len(ends_b) and (ends_b[k - 1] if k else 0) < end:
                links.append((ids_a[i], ids_b[k]))
                k += 1
        groups, i, j = [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            m, n = ends_a.index(cut) + 1, ends_b.index(cut) + 1
            groups.append(",".join(map(str, ids_a[i:m])) + "|" + ",".join(map(str, ids_b[j:n])))
            i, j = m, n
        counts.update(links)
        known[d] = (len(ids_a), len(ids_b), len(groups), links, ";".join(groups))
    highest = Counter()
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    return {d: (0, 0, 0, 0, "", 0, 0) if k is None else (*k[:3], len(k[3]), sha256(k[4].encode()).hexdigest(),
                sum(counts[p] == highest[p[1]] for p in k[3]), sum(counts[p] for p in k[3])) for d, k in known.items()}


def figures(rows):
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256, r.n_best, r.count_sum) for r in rows}


TEXTS = ["hello world", "", None, " ", "\n", "a\n\nb", "a  b   c  ", "▁ab", "x ▁", " héllo\t😀\0 x", "<|endoftext|> <s> </s> <unk> <0x41>", "ﬁ é ǆ İ", "漢字かな", "é", "é",
         " \u0085᠎​　x\x1c\x1d", "don't we'll I'D 12345 ½ ²", "hello world", "z" * 500, " " * 300, "(){};==!=->" * 20, "\r\n\t\r\n"]


def test_all_texts_like_by_hand(make_docs, prose, libraries, monkeypatch):
    monkeypatch.setattr(token_links, "SHARD_CHARS", 900)
    rng = random.Random(4)
    texts = TEXTS + [prose(k, 5 + 3 * k) for k in range(30)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x600), rng.randrange(0x2000, 0x2100), rng.randrange(0x4E00, 0x4F00), rng.randrange(0x1F600, 0x1F640)])) for _ in range(80)) for _ in range(30)]
    docs = make_docs([(i, t, None, "s") for i, t in enumerate(texts)])
    got = token_links.aligned(docs).collect()
    assert len(got) == len(texts)
    assert figures(got) == by_hand(texts, libraries)


def test_long_documents_in_lanes(make_docs, prose, libraries, monkeypatch):
    monkeypatch.setattr(token_links, "LANE", 16)
    texts = [prose(1, 900), "q" * 4000, prose(2, 3), "漢" * 700 + prose(3, 200), "", "ab" * 600 + "\n" + prose(4, 100)]
    shard = token_links.Shard(token_links.Pair(token_links.tokenizer_files()), texts)
    want = by_hand(texts, libraries)
    for d, g in enumerate(shard.groups().to_pylist()):
        assert (g and sha256(g.encode()).hexdigest()) == want[d][4] and shard.n_links[d] == want[d][3]
    pair = token_links.Pair(token_links.tokenizer_files())
    ends = [np.cumsum(lengths[ids]) for lengths, ids in ((pair.a_lengths, shard.ids_a), (pair.b_lengths, shard.ids_b))]
    i, _, _ = token_links.lanes_of(*ends, shard.from_a, shard.from_b)
    assert len(i) > 40


def test_very_long_text(make_docs, prose):
    long = prose(9, 400_000)
    got = token_links.aligned(make_docs([(1, long, None, "s"), (2, "short text", None, "s"), (None, "short text", None, None)])).collect()
    assert {r.doc_id: r.n_a > 0 and r.n_links >= max(r.n_a, r.n_b) for r in got} == {1: True, 2: True, None: True}


def test_real_outputs(make_docs):
    (row,) = token_links.aligned(make_docs([(1, "hello world", None, "s")]), outputs=("a_ids", "b_ids", "a_sizes", "b_sizes", "groups")).collect()
    assert row.a_ids == [23748, 995] and row.groups == "23748|6312,28709;995|1526" and (row.a_sizes, row.b_sizes) == ([1, 1], [2, 1])


def test_nothing(make_docs):
    assert token_links.aligned(make_docs([])).count() == 0
    assert figures(token_links.aligned(make_docs([(1, None, None, None), (2, "", None, None)])).collect()) == {1: (0, 0, 0, 0, "", 0, 0), 2: (0, 0, 0, 0, "", 0, 0)}


def test_query_on_its_whole_table(spark, sf_dir, libraries):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = by_hand([r.text for r in rows], libraries)
    assert figures(QUERIES["op13_token_links"](spark, sf_dir).collect()) == {r.doc_id: want[k] for k, r in enumerate(rows)}
