"""Periodic runs against plain searches."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import awkward
import pytest

from muniment.llm import queries, runs


def plain_runs(w, least=24, times=3):
    n, out = len(w), set()
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            size = j + p - i
            if size >= max(least, times * p) and not any(all(w[k] == w[k + q] for k in range(i, i + size - q)) for q in range(1, p)):
                out.add((i, size, p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(w):
    found = plain_runs(w)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else None
    dropped = {i for s, n, p in found for i in range(s + p, s + n)}
    kept = " ".join(x for i, x in enumerate(w) if i not in dropped)
    return (len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in found).encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def planted(key, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(key).encode()) if key is not None else 1, len(w)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return w


@pytest.mark.parametrize("letters", [1, 2, 3, 9])
def test_find_runs(letters):
    dice = random.Random(letters)
    for turn in range(150):
        least, times = dice.choice([(24, 3), (6, 3), (4, 2), (9, 4)])
        w = [dice.randrange(letters) for _ in range(dice.randint(0, 90))]
        for _ in range(dice.randint(0, 3)):
            part = [dice.randrange(letters) for _ in range(dice.randint(1, 9))]
            at = dice.randint(0, len(w))
            w[at:at] = (part * dice.randint(2, 8))[: dice.randint(1, 60)]
        assert runs.find_runs(w, least, times) == plain_runs(w, least, times)


def test_query_equals_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r[0]: tuple(r)[1:8] for r in queries.op13_periodic_runs(spark, sf).collect()}
    assert got == {i: plain_row(planted(i, t)) for i, t in texts.items()}
    assert sum(r[0] for r in got.values()) > 10


def test_awkward_documents(spark):
    texts = [*awkward.corpus(), "a b " * 30, "x " + "a b " * 30 + "y", "é " * 23, "é " * 24, ("one two three " * 9 + "four ") * 4, "a" * 3000, "\x85\xa0 b " * 40]
    docs = awkward.frame(spark, texts)
    got = sorted((tuple(r)[1:8] for r in runs.periodic_runs(docs).collect()), key=repr)
    plain = [re.findall(r"[^\x20\x09-\x0D]+", (t[1] if isinstance(t, tuple) else t) or "") for t in texts]
    assert got == sorted(map(plain_row, plain), key=repr)
    assert runs.periodic_runs(awkward.empty(spark)).count() == 0


def test_tails(spark):
    texts = [*awkward.corpus(), "", None, "one"] * 12
    docs = awkward.frame(spark, texts)
    tails = [tuple(r) for r in docs.select("doc_id", runs.repeat_tails(docs.text, docs.doc_id)).collect()]
    pairs = [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)]
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    assert sorted((repr(k), words(t)) for k, t in tails) == sorted((repr(k), planted(k, t)) for k, t in pairs)
    assert any(not t and zlib.crc32(str(k).encode()) % 10 == 0 for k, t in pairs)


def test_long_text(spark):
    one = " ".join(["a"] * 30000)
    [r] = runs.periodic_runs(spark.createDataFrame([(1, one)], "doc_id long, text string")).collect()
    assert (r.n_runs, r.start, r.length, r.period, r.n_kept) == (1, 0, 30000, 1, 1)
