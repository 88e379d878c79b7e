"""Hard negatives by exact search on cover trees: for an anchor and one of its positives, the best rows of other labels in a window below the positive.

A component x of a vector counts as floor(scale * x), and scores are whole-number inner products. Rows are dealt to blocks of about ``block_rows`` by the nearest of a few
pivots (rows of least hash); a cell of a pivot with more rows than that is split by hash, so copies of one vector fill many blocks. In each block the
candidates get one more coordinate that gives all the same norm M: inner products with an anchor q are then |q| M cos(angle). A cover tree is built over
these directions: a node covers its members within an angle, its children's centres are more than half that angle apart and cover half of it, level by level.
Against a centre at angle t from q, members within angle r score between |q| M cos(t + r) and |q| M cos(t - r).

Each (block, chunk of anchors) is a row of its own, so no task holds all anchors or all candidates. In it every anchor descends best bound first; nodes
whose bounds lie outside all its open windows, below what it has found, or whose labels cannot count are skipped, and members that are left are scored exactly.
A first search gives the positives, a second the negatives of all of an anchor's windows at once; a block gives its first few per window, which are merged by shuffle.

On vectors without clusters the bounds skip little and the search comes near to scoring all pairs of anchor and row, in blocks by matrix products.

Defined results: rows with a null label, a null vector, a null or non-finite component (before or after scaling) take no part; shorter vectors count as filled up with zeros;
rows are told apart by position, so repeated ids are rows of their own, ties go to the smaller id (null ids, given as null, come last), then to the earlier row; scores beyond
the range of a long are given as its ends; an empty table or one without anchors gives no rows.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muniment.llm.common import small_batches
from muniment.session import stage

#: Members of a tree node that is not divided further.
LEAF = 16
#: Stands for a null id inside: the largest long.
NO_ID = (1 << 63) - 1

_ANGLE = 1e-6  # radians by which bounds are widened against rounding


def _dump(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _load(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as f:
        return {k: f[k] for k in f.files}


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    out = np.zeros((len(column), dim))
    for i, v in enumerate(column.to_pylist()):
        out[i, : len(v)] = v
    return out


def _compact(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int16) if len(x) == 0 or np.abs(x).max() < 1 << 15 else x


class CoverTree:
    """Cover tree over norm-augmented vectors; every node's members are neighbours in the arrays."""

    def __init__(self, parts: dict[str, np.ndarray]):
        self.parts = parts
        for k, v in parts.items():
            setattr(self, k, v)
        self.vectors = parts["vectors"].astype(np.float64)
        self.top = float(parts["norm"][0])
        self.sizes = self.last - self.first
        self.under_root = self._split(0) if len(self.rows) else None

    def _split(self, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A node's children: which are single members, which are not, and the numbers of either."""
        nodes = np.arange(self.child[at], self.child[at] + self.children[at])
        alone = self.sizes[nodes] == 1
        return np.flatnonzero(alone), np.flatnonzero(~alone), self.first[nodes[alone]], nodes[~alone]

    @staticmethod
    def build(vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray) -> CoverTree:
        n = len(vectors)
        scale = np.abs(vectors).max(initial=0.0) or 1.0  # first to at most 1, so that squares stay in range
        small = vectors / scale
        squares = np.einsum("ij,ij->i", small, small)
        top = np.sqrt(squares.max(initial=0.0)) or 1.0
        unit = np.hstack([small, np.sqrt(np.maximum(top * top - squares, 0))[:, None]]) / top
        order = np.empty(n, np.int64)
        centre, angle, first, last, child, children = [], [], [], [], [], []

        def node(c: int, a: int, size: int) -> int:
            for values, value in zip((centre, angle, first, last, child, children), (c, 0.0, a, a + size, 0, 0)):
                values.append(value)
            return len(centre) - 1

        level = [(node(0, 0, n), np.arange(n))] if n else []
        while level:
            below = []
            for at, members in level:
                c = centre[at]
                dots = unit[members] @ unit[c]
                angle[at] = float(np.arccos(np.clip(dots.min(), -1, 1))) if len(members) > 1 else 0.0
                parts = [] if len(members) <= LEAF or angle[at] <= _ANGLE else _net(unit, members[np.argsort(-dots, kind="stable")], np.cos(angle[at] / 2))
                if len(parts) < 2:
                    order[first[at] : last[at]] = members
                    continue
                child[at], children[at], a = len(centre), len(parts), first[at]
                for c, part in parts:
                    inner = node(c, a, len(part))
                    a += len(part)
                    if len(part) == 1:
                        order[a - 1] = part[0]
                    else:
                        below.append((inner, part))
            level = below
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        first, last, labels = np.array(first, np.int64), np.array(last, np.int64), labels[order]
        # A node has one label if no change of label lies between its members.
        changes = np.concatenate([[0], np.cumsum(labels[1:] != labels[:-1])]) if n else np.zeros(0, np.int64)
        single = changes[first] == changes[last - 1] if n else np.zeros(0, bool)
        bits = np.uint64(1) << (labels % 64).astype(np.uint64)
        masks = np.array([np.bitwise_or.reduce(bits[a:b]) for a, b in zip(first, last)], np.uint64)
        return CoverTree({
            "vectors": _compact(vectors[order]), "ids": ids[order], "rows": rows[order], "labels": labels, "norm": np.array([top * scale]),
            "centre": place[np.array(centre, np.int64)], "angle": np.array(angle), "first": first, "last": last,
            "child": np.array(child, np.int64), "children": np.array(children, np.int64), "single": single, "masks": masks,
        })

    def search(self, anchor: Anchor, k: int, whole: bool, start: np.ndarray) -> None:
        """Offer the anchor every member that may count; ``start``: scores of the centres of the root's children."""
        if not len(self.rows):
            return
        q, reach = anchor.vector, anchor.norm * self.top
        heap: list[tuple[float, int]] = [(0.0, 0)]
        while heap:
            bound, at = heapq.heappop(heap)
            if at and not anchor.wanted(-bound):
                break  # best first: all others are lower
            if not self.children[at]:
                inside = np.arange(self.first[at], self.last[at])
                self._offer(anchor, inside, self.vectors[inside] @ q, k, whole)
                continue
            alone, many, members, nodes = self._split(at) if at else self.under_root
            scores = self.vectors[self.centre[self.child[at] : self.child[at] + self.children[at]]] @ q if at else start
            self._offer(anchor, members, scores[alone], k, whole)
            open_ = (self.masks[nodes] & anchor.bit) != 0 if anchor.same else ~(self.single[nodes] & (self.labels[self.first[nodes]] == anchor.label))
            nodes, scores = nodes[open_], scores[many[open_]]
            if not len(nodes):
                continue
            turn = np.arccos(np.clip(scores / reach, -1, 1)) if reach else np.zeros(len(nodes))
            width = self.angle[nodes] + _ANGLE
            upper = reach * np.cos(np.maximum(turn - width, 0)) * (1 + 1e-9) + reach * 1e-9
            lower = reach * np.cos(np.minimum(turn + width, np.pi)) * (1 + 1e-9) - reach * 1e-9
            some = (upper >= anchor.least()) & (lower <= anchor.most)
            for node, u, w in zip(nodes[some].tolist(), upper[some].tolist(), lower[some].tolist()):
                if anchor.wanted(u, w):
                    heapq.heappush(heap, (-u, node))

    def _offer(self, anchor: Anchor, members: np.ndarray, scores: np.ndarray, k: int, whole: bool) -> None:
        if whole:  # scores first: few rows lie in a window
            inside = np.flatnonzero((scores >= anchor.least()) & (scores <= anchor.most))
            members, scores = members[inside], scores[inside]
        same = self.labels[members] == anchor.label
        keep = same & (self.rows[members] != anchor.row) if anchor.same else ~same
        if whole:
            members, scores = members[keep], scores[keep].astype(np.int64)
        else:  # sums beyond 2**53: scored in whole numbers of any size
            members = members[keep]
            q = [int(x) for x in anchor.vector]
            exact = [sum(int(a) * b for a, b in zip(self.vectors[m], q)) for m in members.tolist()]
            scores = np.array([min(max(s, -NO_ID - 1), NO_ID) for s in exact], np.int64)
        if len(members):
            anchor.add(scores, self.ids[members], self.rows[members], k)


def _net(unit: np.ndarray, members: np.ndarray, cosine: float) -> list[tuple[int, np.ndarray]]:
    """(centre, members) of a net: each centre is further than the angle from all before it and takes what lies within."""
    out = []
    while len(members):
        some = members[:128]
        near = unit[some] @ unit[members].T >= cosine
        open_ = np.ones(len(members), bool)
        for i, c in enumerate(some.tolist()):
            if open_[i]:
                taken = near[i] & open_
                taken[i] = True
                # The centre stands first among its members.
                out.append((c, members[taken]))
                open_ &= ~taken
        members = members[open_]
    return out


class Anchor:
    """An anchor's open windows of scores and the best rows found for each."""

    def __init__(self, vector: np.ndarray, row: int, label: int, same: bool, windows: list[tuple[int, int]]):
        self.vector, self.row, self.label, self.same, self.windows = vector, row, label, same, windows
        self.norm = float(np.linalg.norm(vector))
        self.bit = np.uint64(1) << np.uint64(label % 64)
        self.most = max((h for _, h in windows), default=-1)
        self.floors = [low for low, _ in windows]
        self.best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 3 for _ in windows]

    def least(self) -> int:
        return min(self.floors, default=NO_ID)

    def wanted(self, upper: float, lower: float = -np.inf) -> bool:
        return any(upper >= floor and lower <= high for floor, (_, high) in zip(self.floors, self.windows))

    def add(self, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> None:
        for j, (low, high) in enumerate(self.windows):
            fits = (scores >= max(low, self.floors[j])) & (scores <= high)
            if fits.any():
                s, i, r = (np.concatenate(x) for x in zip(self.best[j], (scores[fits], ids[fits], rows[fits])))
                first = np.lexsort((r, i, -np.maximum(s, -NO_ID)))[:k]
                self.best[j] = s[first], i[first], r[first]
                if len(first) == k:
                    self.floors[j] = max(low, int(s[first[-1]]))


def _search_pairs(same: bool, k: int, low: int, high: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first few rows per window of each anchor in a chunk, from one block's tree."""
    for batch in batches:
        for blob, anchors in zip(batch.column(0), batch.column(1)):
            tree, chunk = CoverTree(_load(blob.as_py())), _load(anchors.as_py())
            vectors = chunk["vectors"].astype(np.float64)
            # In this range sums of products are exact in doubles.
            largest = np.sqrt(np.einsum("ij,ij->i", vectors, vectors).max(initial=0.0))
            whole = largest * tree.top < 1 << 52
            top = np.arange(tree.child[0], tree.child[0] + tree.children[0]) if len(tree.rows) else np.zeros(0, np.int64)
            start = vectors @ tree.vectors[tree.centre[top]].T
            out: list[list[np.ndarray]] = [[] for _ in range(5)]
            for i in range(len(vectors)):
                positives = chunk["scores"][chunk["at"][i] : chunk["at"][i + 1]].tolist()
                windows = [(-NO_ID - 1, NO_ID)] if same else [(-(-low * p // 100), high * p // 100) for p in positives]
                anchor = Anchor(vectors[i], int(chunk["rows"][i]), int(chunk["labels"][i]), same, windows)
                if windows:
                    tree.search(anchor, k, whole, start[i])
                for j, (scores, ids, rows) in enumerate(anchor.best):
                    for values, value in zip(out, (np.full(len(rows), anchor.row), np.full(len(rows), j + 1), scores, ids, rows)):
                        values.append(value)
            arrays = [pa.array(np.concatenate(x) if x else [], pa.int64()) for x in out]
            yield pa.RecordBatch.from_arrays(arrays, names=["anchor", "nth", "score", "id", "row"])


def _tree_row(key: tuple, table: pa.Table, dim: int) -> pa.Table:
    ids, rows, labels = (table.column(c).to_numpy() for c in ("id", "row", "label"))
    order = np.argsort(rows)  # the same tree in whatever order rows arrive
    tree = CoverTree.build(_matrix(table.column("v"), dim)[order], ids[order], rows[order], labels[order])
    return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "tree": pa.array([_dump(**tree.parts)], pa.binary())})


def _chunk_row(key: tuple, table: pa.Table, dim: int) -> pa.Table:
    scores = table.column("scores").to_pylist()
    blob = _dump(
        vectors=_compact(_matrix(table.column("v"), dim)), rows=table.column("row").to_numpy(), labels=table.column("label").to_numpy(),
        scores=np.array([s for some in scores for s in some], np.int64), at=np.cumsum([0, *map(len, scores)]),
    )
    return pa.table({"chunk": pa.array([key[0].as_py()], pa.int64()), "anchors": pa.array([blob], pa.binary())})


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine_negatives(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | str = "label", anchors: Column | None = None, positives: int = 5, negatives: int = 5,
    low: int = 80, high: int = 100, scale: int = 256, block_rows: int = 4096, chunk_rows: int = 1024, max_pivots: int = 1024,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), one row for each negative found.

    ``anchors`` tells which rows are searched for (all, if None). The positives of an anchor are its first rows of its own label; a negative has another label and a score of
    ``low`` to ``high`` per cent of the positive's. At most ``max_pivots`` vectors are kept on the driver.
    """
    x = F.col(f"`{vector_col}`")
    own = F.col(label) if isinstance(label, str) else label
    scaled = F.transform(x, lambda c: _floored(c, scale))
    taken = vectors.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("id"), own.cast("long").alias("label"),
        (F.lit(True) if anchors is None else F.coalesce(anchors, F.lit(False))).alias("is_anchor"), scaled.alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    taken = taken.where(F.col("label").isNotNull() & F.col("v").isNotNull()).where(~bad)
    rows = stage(taken.select(F.monotonically_increasing_id().alias("row"), "*"), "vectors")
    n, n_anchors, dim = rows.agg(F.count("*"), F.count_if("is_anchor"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()

    # Cells around pivots, then blocks of bounded size.
    wanted = max(1, min(max_pivots, -(-n // block_rows)))
    pivots = np.zeros((wanted, dim))
    for i, r in enumerate(rows.orderBy(F.xxhash64("id", "row"), "row").limit(wanted).select("v").collect()):
        pivots[i, : len(r.v)] = r.v
    norms = np.linalg.norm(pivots, axis=1)
    directions = pivots / np.where(norms > 0, norms, 1)[:, None]

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = (_matrix(batch.column(1), dim) @ directions.T).argmax(axis=1) if dim else np.zeros(batch.num_rows, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cell, pa.int64()), *batch.columns[1:]], names=["row", "cell", "v", "id", "label"])

    placed = small_batches(rows.select("row", "v", "id", "label")).mapInArrow(cells, "row long, cell long, v array<double>, id long, label long")
    placed = stage(placed, "cells")
    sizes = {r.cell: -(-r.n // block_rows) for r in placed.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # one row for each pivot
    firsts, n_blocks = {}, 0
    for cell in sorted(sizes):
        firsts[cell], n_blocks = n_blocks, n_blocks + sizes[cell]
    of = lambda known: F.element_at(F.create_map(*[F.lit(int(y)) for pair in (known or {0: 1}).items() for y in pair]), F.col("cell").cast("int"))
    block = (of(firsts) + F.pmod(F.xxhash64("row"), of(sizes).cast("long"))).cast("long")
    trees = stage(placed.withColumn("block", block).groupBy("block").applyInArrow(lambda key, table: _tree_row(key, table, dim), "block long, tree binary"), "trees")

    def search(searched: DataFrame, same: bool, k: int) -> DataFrame:
        chunk = F.pmod(F.xxhash64("row"), F.lit(max(1, -(-n_anchors // chunk_rows)))).alias("chunk")
        chunks = searched.select(chunk, "row", "label", "v", "scores").groupBy("chunk").applyInArrow(lambda key, table: _chunk_row(key, table, dim), "chunk long, anchors binary")
        each = chunks.select("anchors", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(n_blocks, 1) - 1).cast("long"))).alias("block"))
        # Repeated per block, the anchors are far more than the rows they are estimated by: never to be broadcast through the driver.
        pairs = each.hint("merge").join(trees, "block").select("tree", "anchors")
        return pairs.mapInArrow(lambda batches: _search_pairs(same, k, low, high, batches), "anchor long, nth long, score long, id long, row long")

    searched = rows.where("is_anchor").select("row", "id", "label", "v")
    none = F.array().cast("array<long>").alias("scores")
    best = stage(_first(search(searched.select("*", none), True, positives), ["anchor"], positives).select(
        F.col("anchor"), F.col("rank").alias("nth"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    listed = best.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("nth", "positive_score"))).alias("found"))
    windows = searched.join(listed, F.col("row") == F.col("anchor")).withColumn("scores", F.transform("found", lambda s: s["positive_score"]))
    found = _first(search(windows, False, negatives), ["anchor", "nth"], negatives)
    named = best.join(searched.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return found.select("anchor", F.col("nth").cast("int").alias("nth"), "rank", "id", "score").join(named, ["anchor", "nth"]).select(
        real("anchor_id").alias("anchor_id"), real("positive_id").alias("positive_id"), "rank", real("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _floored(c: Column, scale: int) -> Column:
    """floor(scale * c) as a double: Spark's floor gives a long, which large values do not fit."""
    y = F.lit(float(scale)) * c.cast("double")
    return F.when(F.abs(y) < float(1 << 53), F.floor(y).cast("double")).otherwise(y)
