"""Pieces against direct encoding; gapless sequences; the curve; odd rows."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from siltbed.llm import packing as K

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(pieces, texts, tokenizer, length):
    """texts: (doc_id, text)"""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append((p.offset, p.length))
    want = defaultdict(list)
    for i, t in texts:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        want[i].append(ids)
    for i, versions in want.items():
        got = sorted((p.doc_tokens, p.start, p.length, p.ids_crc32) for p in by_doc[i])
        cover = []
        for ids in versions:
            raw = np.array(ids, "<u4")
            cover += [(len(ids), at, raw) for at in range(len(ids))]
        assert sum(n for _, _, n, _ in got) == len(cover)
        for total, start, n, crc in got:
            assert any(len(v) == total and zlib.crc32(np.array(v[start:start + n], "<u4").tobytes()) == crc for v in versions)
    assert set(by_doc) == set(want)
    sizes = {}
    for s, parts in by_sequence.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        sizes[s] = at
    assert sorted(sizes) == list(range(len(sizes)))
    assert all(n <= length and (n == length or n & (n - 1) == 0) for n in sizes.values())  # no padding
    assert sum(n != length for n in sizes.values()) <= length.bit_length()


def test_pieces_of_the_sample(sample_docs, tokenizer):
    texts = [(r.doc_id, r.text) for r in sample_docs.collect()]
    check(K.pack(sample_docs, PATH).collect(), texts, tokenizer, 2048)


def test_odd_rows(odd, none, tokenizer):
    texts = [(r.doc_id, r.text) for r in odd.collect()]
    check(K.pack(odd, PATH, length=64).collect(), texts, tokenizer, 64)
    assert K.pack(none, PATH).collect() == []


def test_words_are_encoded_as_the_tokenizer_does(tokenizer):
    r = random.Random(2)
    marks = ["a", "B", "é", "É", "x́", "İ", "ß", "1", "²", "Ⅷ", ".", ",", "'s", "'S", "-", "!", "<|endoftext|>", "<|ENDOFTEXT|>", "ϴ", "字", "ー", "́", "Σ", "\x1c", "\xa0", "|", "ǆ"]
    texts = [" ".join("".join(r.choice(marks) for _ in range(r.randint(1, 6))) for _ in range(30)) for _ in range(300)] + [None, "", " \n"]
    cache = K.WordCache(PATH, 1, most=500)
    for at in range(0, len(texts), 50):
        ids, sizes = cache.encode(texts[at:at + 50])
        for t, got in zip(texts[at:at + 50], np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
            assert got.tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids + [1]


def test_hilbert_keys_are_a_path_through_all_cells():
    grid = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    key = K.hilbert(grid, 3)
    assert sorted(key) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_neighbours_on_the_curve_are_alike(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = sorted({(p.sequence_id, p.offset, p.doc_id) for p in K.pack(docs, PATH).collect() if not p.start})
    order = [lang[i] for *_, i in rows]
    same = sum(a == b for a, b in zip(order, order[1:])) / (len(order) - 1)
    shuffled = sum((order.count(v) / len(order)) ** 2 for v in set(order))
    assert same > shuffled + 0.15


def test_many_range_buckets(spark):
    from siltbed.llm.common import materialize, running_total

    df = materialize(spark.range(5000).selectExpr("id % 100 as k", "id", "id % 7 as n"), "t")
    got = sorted((r.k, r.id, r.n, r.before) for r in running_total(df, "n", ["k", "id"], rows_per_bucket=100).collect())
    total = 0
    for _, _, n, before in got:
        assert before == total
        total += n
