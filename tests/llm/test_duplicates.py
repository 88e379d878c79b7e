"""Near-duplicates, byte and word repeats, and components against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import awkward
import numpy as np
import pytest
import xxhash

from muniment.llm import anchors, graph, repeats, simhash, suffixes


def texts_of(corpus):
    return [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(corpus)]


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def groups_of(n, linked):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        root[find(a)] = find(b)
    return [find(i) for i in range(n)]


def plain_components(rows):
    prints = [plain_print(t) for _, t in rows]
    group = groups_of(len(rows), ((i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4))
    least = {}
    for (own, _), g in zip(rows, group):
        if own is not None:
            least[g] = min(own, least.get(g, own))
    return Counter((own, f"{p:016x}", least.get(g)) for (own, _), p, g in zip(rows, prints, group)), len(set(group))


@pytest.mark.parametrize("hot", [4096, 2])
def test_near_duplicates(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT", hot)
    corpus = awkward.corpus(2)
    docs = awkward.frame(spark, corpus)
    want, n = plain_components(texts_of(corpus))
    assert Counter(tuple(r) for r in simhash.near_duplicates(docs).collect()) == want
    if hot > 2:
        kept = simhash.keep_one(docs)
        assert kept.columns == docs.columns and kept.count() == n
        assert simhash.near_duplicates(awkward.empty(spark)).count() == 0 == simhash.keep_one(awkward.empty(spark)).count()


@pytest.mark.parametrize("distance", [2, 3, 4, 7])
def test_ring_links_every_near_pair(spark, distance):
    dice = random.Random(distance)
    prints = [dice.getrandbits(64) for _ in range(150)]
    for p in list(prints):
        for _ in range(dice.randint(0, 3)):
            q = p
            for b in dice.sample(range(64), dice.randint(1, distance + 1)):
                q ^= 1 << b
            prints.append(q)
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "print long"), distance).collect()
    at = {p: i for i, p in enumerate(signed)}
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= distance for r in found)
    want = groups_of(len(prints), ((i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= distance))
    got = groups_of(len(prints), ((at[r.a], at[r.b]) for r in found))
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


def test_dense_groups_give_few_links():
    """All fingerprints within few bits of one: links stay near the number of fingerprints."""
    ring, dice = simhash.Ring(4), random.Random(1)
    prints = sorted({sum(1 << b for b in dice.sample(range(30, 64), 2)) for _ in range(2000)})
    prints = np.array(prints, np.uint64)
    keys, places = ring.keys(prints, True)
    order = np.argsort(keys, kind="stable")
    stacked = np.stack([keys[order], np.zeros_like(keys), np.zeros_like(keys)], axis=1)
    made = sum(len(a) for a, _ in ring.links(stacked, prints[places][order]))
    assert made < 40 * len(prints)


def test_components(spark):
    dice = random.Random(4)
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    pairs = [(dice.randint(2000, 2100), dice.randint(2000, 2100)) for _ in range(60)] + chain + star + chain[:5]
    nodes = sorted({x for p in pairs if p[0] != p[1] for x in p})
    at = {x: i for i, x in enumerate(nodes)}
    group = groups_of(len(nodes), ((at[a], at[b]) for a, b in pairs if a != b))
    least = {g: min(n for n, k in zip(nodes, group) if k == g) for g in set(group)}
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {n: least[g] for n, g in zip(nodes, group)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_bytes(rows, least):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + least] for t in texts for i in range(len(t) - least + 1))
    out = Counter()
    for (own, _), t in zip(rows, texts):
        covered = np.zeros(len(t), bool)
        for i in range(len(t) - least + 1):
            if seen[t[i : i + least]] > 1:
                covered[i : i + least] = True
        spans = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        out[own, len(t), int(covered.sum()), spans, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~covered])).hexdigest()] += 1
    return out


@pytest.mark.parametrize("least,gram,heavy", [(60, 16, 9999), (60, 16, 2), (400, 64, 9999), (24, 24, 9999)])
def test_byte_repeats(spark, least, gram, heavy):
    corpus = awkward.corpus(3)
    docs = awkward.frame(spark, corpus)
    got = suffixes.substring_dedup(docs, least=least, gram=gram, heavy=heavy).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(tuple(r) for r in got.collect()) == plain_bytes(texts_of(corpus), least)


def test_byte_repeats_inside_one_text(spark):
    dice = random.Random(9)
    part = awkward.words(dice, 90)
    corpus = [f"{part} {awkward.words(dice, 40)} {part}", awkward.words(dice, 80) * 3, "xyz" * 500, awkward.words(dice, 300), "q" * 399]
    got = suffixes.substring_dedup(awkward.frame(spark, corpus)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(tuple(r) for r in got.collect()) == plain_bytes(texts_of(corpus), 400)
    assert suffixes.substring_dedup(awkward.empty(spark)).count() == 0


def test_transform_gives_common_prefixes():
    dice = random.Random(8)
    for least in (3, 9, 20, 40):
        text = (part := bytes(dice.choice(b"abc") for _ in range(120))) + part[9:] + part[:70] + b"\xff" + bytes(dice.choice(b"ab") for _ in range(200)) + part[20:] + b"\xff"
        array = np.frombuffer(text, np.uint8)
        order, seeds = suffixes.suffix_order(array, least)
        lengths = suffixes.common_prefixes(array, order, least)
        whole = [i for i in order.tolist() if b"\xff" not in text[i : i + least] and i + least <= len(text)]
        assert [text[i : i + least] for i in whole] == sorted(text[i : i + least] for i in whole)
        place = {i: r for r, i in enumerate(order.tolist())}
        for a, b in zip(whole, whole[1:]):
            common = next((k for k in range(least) if text[a + k] != text[b + k]), least)
            between = [x for x in lengths[place[a] + 1 : place[b] + 1].tolist() if x >= 0]
            assert (min(between) if between else least) == common
        if least > suffixes.SEED:
            seeded = suffixes.common_prefixes(array, order, least, seeds)
            late = (lengths < 0) | (lengths >= suffixes.SEED)
            inside = np.array([b"\xff" not in text[i : i + least] and i + least <= len(text) for i in order.tolist()])
            both = late & inside & np.concatenate([[False], inside[:-1]])
            assert (seeded[both] == lengths[both]).all() and (seeded[inside & ~late] >= 0).all()


def plain_words(rows, width):
    split = [(t or "").encode().split() for _, t in rows]
    first = {}
    for (own, _), w in zip(rows, split):
        for i in range(len(w) - width + 1):
            if own is not None:
                k = tuple(w[i : i + width])
                first[k] = min(own, first.get(k, own))
    out = Counter()
    for (own, _), w in zip(rows, split):
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if own is not None and first[tuple(w[i : i + width])] < own:
                gone[i : i + width] = [True] * width
        out[own, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()] += 1
    return out


@pytest.mark.parametrize("heavy", [None, 1])
def test_word_repeats(spark, heavy):
    corpus = awkward.corpus(4)
    docs = awkward.frame(spark, corpus)
    got = repeats.repeat_dedup(docs, heavy=heavy).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert Counter(tuple(r) for r in got.collect()) == plain_words(texts_of(corpus), 13)
    if not heavy:
        assert repeats.repeat_dedup(awkward.empty(spark)).count() == 0


@pytest.mark.parametrize("heavy", [None, 1])
def test_word_repeats_of_two_texts_under_one_id(spark, heavy):
    """Runs of the long text lie behind the end of the short one; other passages are shared by later documents only."""
    dice = random.Random(11)
    part, later = awkward.words(dice, 900), awkward.words(dice, 900)
    short, long = awkward.words(dice, 15), f"{awkward.words(dice, 60)} {part}"
    corpus = [(3, long), (3, short), (5, f"{awkward.words(dice, 20)} {part}"), (8, later), (9, later + " end"), (1, short + " tail")]
    got = repeats.repeat_dedup(awkward.frame(spark, corpus), heavy=heavy).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert Counter(tuple(r) for r in got.collect()) == plain_words(corpus, 13)


def test_suffix_tree_depths():
    words = np.array([1, 2, 3, 1, 2, 4, 1, 2, 3, 9])
    order, depth = repeats.tree(words, np.array([0, 3, 6]), 3)
    assert order.tolist() == [0, 2, 1] and depth.tolist() == [0, 3, 2]


def test_names_are_given_by_content():
    dice = random.Random(1)
    shape = suffixes.shape(40, 8)
    part = awkward.words(dice, 60).encode()
    texts = [part, b"some words in front " + part, part[5:] + b" more"]
    name = []
    for t in texts:
        names, runs = shape.runs(t)
        first, count = anchors.unpack(runs)
        name.append({t[s + k : s + k + 40]: n for n, s, c in zip(names, first, count) for k in range(c)})
        assert count.sum() == len(t) - 39
    shared = set(name[0]) & set(name[1]) & set(name[2])
    assert len(shared) > 100 and all(name[0][w] == name[1][w] == name[2][w] for w in shared)


def shared_passages(texts, n_words=51, least=400):
    """(documents that share n_words words with another place, byte for byte; those among them where the shared bytes are ``least`` or more)."""
    places, spans = {}, []
    for d, t in enumerate(texts):
        ends = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", t)]
        for i in range(len(ends) - n_words + 1):
            key = hash(t[ends[i][0] : ends[i + n_words - 1][1]])
            places.setdefault(key, []).append((d, ends[i][0], ends[i + n_words - 1][1]))
    share, long = set(), set()
    for group in places.values():
        if len(group) > 1:
            share |= {d for d, _, _ in group}
            # The same bytes go on to both sides as far as the texts agree with another place.
            d0, a0, b0 = group[0]
            for d, a, b in group[1:]:
                x, y = 0, 0
                while a0 - x > 0 and a - x > 0 and texts[d0][a0 - x - 1] == texts[d][a - x - 1]:
                    x += 1
                while b0 + y < len(texts[d0]) and b + y < len(texts[d]) and texts[d0][b0 + y] == texts[d][b + y]:
                    y += 1
                if b - a + x + y >= least:
                    long |= {d0, d}
    return share, long


def test_passages_of_400_bytes_are_all_caught(spark):
    """Documents that share over 50 words lose bytes wherever what they share has 400 bytes; the others keep all, as the contract says."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sorted((r.doc_id, (r.text or "").encode()) for r in docs.collect())
    removed = {r.doc_id: r.n_removed for r in suffixes.substring_dedup(docs).collect()}
    share, long = shared_passages([t for _, t in rows])
    caught = {i for i in range(len(rows)) if removed[rows[i][0]] > 0}
    assert long <= caught and long <= share and len(long) > 20
