"""Packing: every token lies in one piece, bins are gapless, and little of them is padding."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import awkward
import pytest
from tokenizers import Tokenizer

from muniment.llm import packing, queries

TOKENIZER = Tokenizer.from_file(packing.vocabulary_path(packing.VOCABULARY))


def plain_ids(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def padding(rows, capacity):
    """Checks the layout of all sequences; (tokens, padding)."""
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    pad = 0
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end and length > 0
            end += length
        assert end <= capacity
        pad += 0 if end & (end - 1) == 0 else capacity - end
    return sum(r.length for r in rows), pad


def check_documents(rows, texts):
    """``texts`` is a list of (id, text): each document's pieces, in order, are its tokens."""
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    want = {}
    for key, text in texts:
        want.setdefault(key, []).append(plain_ids(text))
    assert set(got) == set(want)
    for key, documents in want.items():
        if len(documents) == 1:
            [ids], at = documents, 0
            for start, length, code, total in sorted(got[key]):
                assert start == at and total == len(ids) and code == crc(ids[start : start + length])
                at += length
            assert at == len(ids)
        else:
            assert sum(p[1] for p in got[key]) == sum(map(len, documents))
            for p in got[key]:
                assert any(len(ids) == p[3] and crc(ids[p[0] : p[0] + p[1]]) == p[2] for ids in documents)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = queries.op12_packing(spark, sf).collect()
    check_documents(rows, [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()])
    tokens, pad = padding(rows, 2048)
    assert pad <= 0.005 * tokens


@pytest.mark.parametrize(("capacity", "slack"), [(2048, 1 / 64), (64, 0.0), (256, 0.2), (1, 0.0)])
def test_awkward_documents(spark, capacity, slack):
    special = ["<|endoftext|> a<|startoftext|>b", "ΑΣ ΣΑΣ Σ", "é ́x", "a\x85b\xa0c d \x1c e", "İ ǅ ﬁ", "it's we'LL 12345 %%%"]
    texts = [*awkward.corpus(), *special]
    docs = awkward.frame(spark, texts)
    rows = packing.pack(docs, capacity=capacity, slack=slack).collect()
    check_documents(rows, [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)])
    tokens, pad = padding(rows, capacity)
    assert pad <= slack * tokens


def test_words_learnt_alone_have_the_tokenizer_s_ids(spark):
    """Letters with and without marks, capitals, full stops and commas, in either order of being met."""
    words = ["Éa", "éA.", "e\u0301a", "STRASSE,", "Straße.", "ß", "İi", "ıx,", "ŉa", "\u00aa\u00ba", "\u01c5x", "x.", "x,", "x.,", "x..", ".", ",", "X", "Æ,", "ſt", "\u0140", "µm", "ÿ.", "it's.", "d'é,"]
    texts = [" ".join(words), " ".join(reversed(words)), *words]
    encoder = packing.WordIds(packing.vocabulary_path(packing.VOCABULARY), 1)
    ids, borders = encoder.encode([t.encode() for t in texts])
    for text, a, b in zip(texts, borders, borders[1:]):
        assert ids[a:b].tolist() == plain_ids(text)


def test_bins_are_filled_by_class(spark):
    """Bins of a class hold its fixed number of pieces, but for the last of the whole table."""
    texts = [" ".join(f"w{j}" for j in range(i % 700)) for i in range(3000)]
    rows = packing.pack(awkward.frame(spark, texts, 7)).collect()
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append(r.class_size)
    assert all(len(set(k)) == 1 for k in bins.values())
    short = Counter(k[0] for k in bins.values() if len(k) < k[0])
    assert all(n <= 12 for n in short.values())
    tokens, pad = padding(rows, 2048)
    assert pad <= tokens / 64


def test_cuts():
    for capacity in (64, 2048):
        for left in range(capacity):
            for slack in (0.0, 1 / 64, 0.5):
                pieces = packing.cuts(left, capacity, slack)
                assert sum(n for n, _, _ in pieces) == left
                assert all(capacity - n * k <= max(slack * capacity, 0) and n * k <= capacity for n, k, _ in pieces)
                assert all(exact == (n * k == capacity and n & (n - 1) == 0) for n, k, exact in pieces)


def test_empty_table_and_capacity(spark):
    assert packing.pack(awkward.empty(spark)).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(awkward.empty(spark), capacity=100)


def test_words_are_numbered_as_they_are_met(spark, monkeypatch):
    from tokenizers import Tokenizer

    path = packing.vocabulary_path(packing.VOCABULARY)
    encoder, whole = packing.WordIds(path, 1), Tokenizer.from_file(path)
    texts = ["Word, word. word x1, x1 Word", "naïve, Naïve. NAÏVE İstanbul, ſo ΌΣΟΣ, Ǆ. été. É", "", "word. , . ,, 1. Œuvre, œuvre �"]
    for kept in (packing.WORDS_KEPT, 4):  # with room for all words, and starting anew with every text
        monkeypatch.setattr(packing, "WORDS_KEPT", kept)
        for _ in range(2):
            for t in texts:
                ids, borders = encoder.encode([t.encode(), b"and more", t.encode()])
                want = [[*whole.encode(x, add_special_tokens=False).ids, 1] for x in (t, "and more", t)]
                assert [ids[a:b].tolist() for a, b in zip(borders, borders[1:])] == want
                # What was met is learnt by now, each word under one number.
                assert encoder.index.new == [] and sorted(encoder.index.values()) == list(range(len(encoder.first) - 1))
