"""Near copies against the exact similarity of all pairs."""

from __future__ import annotations

import random
from collections import Counter

import awkward
import pytest

from muniment.llm import nearcopies


def plain_groups(texts, size=5, least=0.8):
    """The group of each text, by all pairs."""
    sets = []
    for t in texts:
        w = "".join(c.lower() if c.isascii() else c for c in t or "").encode().split()
        sets.append(frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b or len(a & b) >= least * len(a | b):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))]


def near_texts(seed, n=60, copies=6):
    dice = random.Random(seed)
    out = []
    for _ in range(n):
        base = awkward.words(dice, dice.randint(8, 220), 5000).split()
        out.append(" ".join(base))
        for _ in range(dice.randint(0, copies)):
            copy = list(base)
            for _ in range(dice.randint(0, max(1, len(copy) // 30))):
                copy[dice.randrange(len(copy))] = f"x{dice.randint(0, 9999)}"
            out.append(" ".join(copy))
    dice.shuffle(out)
    return out


@pytest.mark.parametrize("small", [False, True])
def test_all_pairs(spark, monkeypatch, small):
    if small:  # hot bands and large groups in blocks
        monkeypatch.setattr(nearcopies, "HOT", 3)
        monkeypatch.setattr(nearcopies, "GROUP_BYTES", 1500)
    texts = near_texts(3)
    want = {g for g in plain_groups(texts)}
    kept = nearcopies.keep_one_similar(awkward.frame(spark, texts)).collect()
    assert {r.doc_id for r in kept} == want and len(kept) == len(want) < len(texts)


def test_awkward_documents(spark):
    texts = awkward.corpus()
    docs = awkward.frame(spark, texts)
    kept = nearcopies.keep_one_similar(docs)
    assert kept.columns == docs.columns
    groups = plain_groups([t[1] if isinstance(t, tuple) else t for t in texts])
    ids = [t[0] if isinstance(t, tuple) else i for i, t in enumerate(texts)]
    want = Counter(min((x for x, h in zip(ids, groups) if h == g and x is not None), default=None) for g in set(groups))
    assert Counter(r.doc_id for r in kept.collect()) == want
    assert nearcopies.keep_one_similar(awkward.empty(spark)).count() == 0


def test_given_documents(spark):
    """Recall of the pairs of the rule on given documents."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    groups = plain_groups([t for _, t in rows])
    assert {r.doc_id for r in nearcopies.keep_one_similar(docs).collect()} == {rows[g][0] for g in set(groups)}


def test_a_common_passage_ties_nothing(spark):
    """Texts that share a passage of a third of their words are no candidates: none of them is compared exactly."""
    dice = random.Random(8)
    passage = awkward.words(dice, 60, 5000)
    texts = [f"{awkward.words(dice, 60, 5000)} {passage} {awkward.words(dice, 50, 5000)}" for _ in range(600)]
    sets = [nearcopies.shingles(t.encode(), 5) for t in texts]
    words = nearcopies.np.stack([nearcopies.band_keys(s)[1] for s in sets]).view("uint64")
    prints = nearcopies.np.array([nearcopies.fingerprint(t.encode(), 5) for t in texts], "int64").view("uint64")
    n, every = nearcopies.np.array([len(s) for s in sets]), nearcopies.np.arange(600)
    assert sum(int(nearcopies.likely(i, every, prints, n, words, 0.8).sum()) - 1 for i in range(600)) < 10
    assert nearcopies.keep_one_similar(awkward.frame(spark, texts)).count() == 600


def test_fingerprints_make_candidates(spark, monkeypatch):
    """Without the bands the ring search alone still finds the similar texts whose fingerprints differ in few bits; similarity decides."""
    monkeypatch.setattr(nearcopies, "_candidates", lambda least: lambda batches: iter(()))
    texts = near_texts(5, n=40)
    sets = [set(nearcopies.shingles(t.encode(), 5).tolist()) for t in texts]
    prints = [nearcopies.fingerprint(t.encode(), 5) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    tied = 0
    for i in range(len(texts)):
        for j in range(i):
            near = ((prints[i] ^ prints[j]) & (1 << 64) - 1).bit_count() <= nearcopies.NEAR
            if sets[i] == sets[j] or near and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                tied += sets[i] != sets[j]
                root[max(find(i), find(j))] = min(find(i), find(j))
    kept = {r.doc_id for r in nearcopies.keep_one_similar(awkward.frame(spark, texts)).collect()}
    assert tied and kept <= {find(i) for i in range(len(texts))}
    assert kept >= set(plain_groups(texts))
