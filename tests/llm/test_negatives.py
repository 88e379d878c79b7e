"""Hard negatives against a plain search over all pairs."""

from __future__ import annotations

import math
from collections import Counter
from fractions import Fraction

import compare
import numpy as np
import pytest

from muniment.llm import negatives, queries

SCHEMA = "vec_id long, embedding array<double>, label int, id long, row long, block long, v string, score string, anchor string"


def plain(rows, positives=5, k=5, low=80, high=100, every=100):
    taken = []
    for i, (key, v, label) in enumerate(rows):
        if label is not None and v is not None and all(x is not None and math.isfinite(x) and math.isfinite(256 * x) for x in v):
            taken.append((key, [math.floor(Fraction(256 * x)) for x in v], label, i))
    order = lambda r: (-r[0], r[1] is None, r[1] or 0, r[2])
    clip = lambda s: min(max(s, -(1 << 63)), (1 << 63) - 1)
    out = Counter()
    for key, q, label, i in taken:
        if key is None or key % every:
            continue
        scored = [(clip(sum(a * b for a, b in zip(q, v))), k2, j, l2) for k2, v, l2, j in taken]
        mine = sorted((s for s in scored if s[3] == label and s[2] != i), key=order)[:positives]
        for ps, pid, *_ in mine:
            fits = sorted((s for s in scored if s[3] != label and low * ps <= 100 * s[0] <= high * ps), key=order)[:k]
            out.update((key, pid, n + 1, nid, ps, ns) for n, (ns, nid, *_) in enumerate(fits))
    return out


def made(seed, n, dim=8, clusters=5, copies=0):
    dice = np.random.default_rng(seed)
    centres = dice.normal(size=(clusters, dim))
    rows = [[i * 5, (centres[dice.integers(clusters)] + dice.normal(size=dim) * dice.choice([0.05, 0.5])).tolist(), int(dice.integers(4))] for i in range(n)]
    rows += [[10_000 + i, rows[3][1], int(dice.integers(3))] for i in range(copies)]
    return [tuple(r) for r in rows]


def mined(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, 1, 1, "x", "x", "x") for r in rows], SCHEMA).coalesce(1)
    every = options.pop("every", 100)
    return Counter(map(tuple, negatives.mine_negatives(frame, anchors=frame.vec_id % every == 0, **options).collect()))


@pytest.mark.parametrize(("n", "copies", "options"), [(300, 0, {}), (400, 150, {"block_rows": 64, "chunk_rows": 3}), (250, 40, {"low": 20, "high": 97, "block_rows": 30, "max_pivots": 2})])
def test_against_plain_search(spark, n, copies, options):
    rows = made(n, n, copies=copies)
    bounds = {k: options[k] for k in ("low", "high") if k in options}
    want = plain(rows, every=25, **bounds)
    assert mined(spark, rows, every=25, **options) == want
    assert len(want) > 50


def test_odd_rows(spark):
    rows = made(7, 120, dim=4)
    rows += [(100, rows[0][1], None), (200, None, 1), (300, [1.0, None, 0.0, 0.0], 1), (400, [1.0, math.nan, 0.0, 0.0], 1), (500, [math.inf, 0.0, 0.0, 0.0], 1), (600, [1e308, 1.0, 0.0, 0.0], 2)]
    rows += [(None, rows[1][1], 0), (None, rows[1][1], 1), (0, rows[0][1], rows[0][2]), (0, rows[0][1], 2), (700, [0.0] * 4, 1), (800, [1.0], 1), (900, [], 2), (-100, [1.0, 1.0, 0.5, 0.25, 3.0], -3)]
    assert mined(spark, rows, every=20) == plain(rows, every=20)


def test_large_components(spark):
    dice = np.random.default_rng(3)
    rows = [(i * 10, (dice.normal(size=3) * 10.0 ** dice.integers(0, 7)).tolist(), int(dice.integers(2))) for i in range(80)]
    assert mined(spark, rows) == plain(rows)


def test_empty_and_without_anchors(spark):
    assert not mined(spark, [])
    assert not mined(spark, [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 2)])
    assert not mined(spark, [(0, [1.0, 2.0], 1)])


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.1"
    assert compare.difference(queries.op11_hard_negatives(spark, sf), compare.connect(sf), queries.ORACLE["op11_hard_negatives"]) is None


def test_tree_covers_and_skips():
    """Members lie within their node's angle, and clusters let most rows be skipped."""
    dice = np.random.default_rng(5)
    centres = dice.normal(size=(40, 16)) * 200
    x = np.floor(np.repeat(centres, 50, axis=0) + dice.normal(size=(2000, 16)) * 4)
    n = np.arange(len(x))
    tree = negatives.CoverTree.build(x, n, n, n % 10)
    assert sorted(tree.rows.tolist()) == n.tolist()
    norms = np.linalg.norm(tree.vectors, axis=1)
    unit = np.hstack([tree.vectors, np.sqrt(np.maximum(tree.top**2 - norms**2, 0))[:, None]]) / tree.top
    for at in range(len(tree.centre)):
        inside = np.arange(tree.first[at], tree.last[at])
        assert tree.centre[at] in inside
        assert np.arccos(np.clip(unit[inside] @ unit[tree.centre[at]], -1, 1)).max() <= tree.angle[at] + 1e-6
    seen = []
    offer = tree._offer
    tree._offer = lambda anchor, members, *rest: (seen.append(len(members)), offer(anchor, members, *rest))
    top = np.arange(tree.child[0], tree.child[0] + tree.children[0])
    anchor = negatives.Anchor(x[7], 7, 7, True, [(-(1 << 63), (1 << 63) - 1)])
    tree.search(anchor, 3, True, tree.vectors[tree.centre[top]] @ x[7])
    assert sum(seen) < 500
    scores = x @ x[7]
    same = np.flatnonzero((n % 10 == 7) & (n != 7))
    assert anchor.best[0][2].tolist() == same[np.lexsort((same, -scores[same]))][:3].tolist()


def test_anchors_are_not_broadcast(spark):
    """Anchors repeated for every block grow with the square of the table: they meet the trees by shuffle however small they are estimated to be."""
    frame = spark.createDataFrame([(i * 5, v, label) for i, (_, v, label) in enumerate(made(11, 200))], "vec_id long, embedding array<double>, label int")
    found = negatives.mine_negatives(frame, anchors=frame.vec_id % 25 == 0, block_rows=32, chunk_rows=3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [block#" in plan
    assert "BroadcastHashJoin [block#" not in plan
