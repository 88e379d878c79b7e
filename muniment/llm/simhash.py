"""SimHash near-duplicates with pigeonring filtering.

A fingerprint of 64 bits is cut into ``distance + 1`` segments laid in a ring. If two fingerprints differ in at most ``distance``
bits, then from some segment on every chain of l consecutive segments differs in at most ``l * distance / segments`` bits: none
in its first segment, at most one in the first two, and so on. Chains of two are the blocking key: the
first segment as it is and the second as it is or with one of its set bits cleared, so that two
fingerprints that differ in that one bit share a key. Inside a key the longer chains' budgets prune pairs before the full
distance is taken.

Copies have equal fingerprints and count once from the start. From each key only a spanning forest of its links is given out: a search that
drops every fingerprint reached, so that a dense group costs about its size. A key with more than ``HOT``
fingerprints is split into blocks, and every two blocks of it meet in a task of their own.

Defined results: null, empty and blank texts have the fingerprint zero and are linked like others; a text of fewer than four words has one shingle; a
null id takes part, but a component is named by its least id that is not null; repeated ids get equal components if their texts do; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muniment.llm.common import map_texts, map_whole_rows
from muniment.llm.graph import components
from muniment.session import stage

SEED = 42
#: Fingerprints with the same plain key beyond which a key is split into blocks.
HOT = 4096
#: Groups up to this size are compared place by place, larger ones by the search.
_SMALL = 16


def fingerprint(text: bytes, size: int = 4) -> int:
    """Signed 64-bit SimHash of the word shingles of a text, repeats included."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    n = max(1, len(words) - size + 1)
    spans = zip(starts[:n].tolist(), (ends[len(words) - n :] - 1).tolist())
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in spans), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        part = hashes[at : at + (1 << 14)].astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


class Ring:
    """Segments of a fingerprint, and the bits of the chains that begin at each of them."""

    def __init__(self, distance: int):
        if not 2 <= distance <= 7:  # two segments of a key must fit beside each other
            raise ValueError("the distance must lie between 2 and 7")
        self.distance, m = distance, distance + 1
        self.widths = [64 // m + (i < 64 % m) for i in range(m)]
        self.offsets = [sum(self.widths[:i]) for i in range(m)]
        self.masks = [np.uint64(((1 << w) - 1) << o) for w, o in zip(self.widths, self.offsets)]
        chain = lambda i, n: np.uint64(sum(int(self.masks[(i + j) % m]) for j in range(n)))
        #: By first segment: (bits of the chain, its budget), for chains longer than the key's, the whole ring last.
        self.chains = [[(chain(i, n), n * distance // m) for n in range(3, m + 1)] or [(chain(i, m), distance)] for i in range(m)]

    def segment(self, prints: np.ndarray, i: int) -> np.ndarray:
        i %= len(self.widths)
        return (prints & self.masks[i]) >> np.uint64(self.offsets[i])

    def key(self, i: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return ((np.int64(i) << np.int64(58)) | (first << np.uint64(29)).astype(np.int64) | second.astype(np.int64)).astype(np.int64)

    def keys(self, prints: np.ndarray, cleared: bool) -> tuple[np.ndarray, np.ndarray]:
        """(key, place of its fingerprint): plain keys only, or also those with a bit cleared."""
        keys, places, every = [], [], np.arange(len(prints))
        for i in range(len(self.widths)):
            first, second = self.segment(prints, i), self.segment(prints, i + 1)
            keys.append(self.key(i, first, second))
            places.append(every)
            for bit in range(self.widths[(i + 1) % len(self.widths)] if cleared else 0):
                one = np.uint64(1 << bit)
                has = np.flatnonzero(second & one)
                keys.append(self.key(i, first[has], second[has] ^ one))
                places.append(has)
        return np.concatenate(keys), np.concatenate(places)

    def near(self, differing: np.ndarray, i: int) -> np.ndarray:
        """Which differences keep the budgets of every chain from segment ``i``; the last chain is the whole fingerprint."""
        keep = np.ones(len(differing), bool)
        for bits, budget in self.chains[i]:
            keep[keep] = np.bitwise_count(differing[keep] & bits) <= budget
        return keep

    def forest(self, prints: np.ndarray, i: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Links that hold each linked group of one key together."""
        left = prints
        while len(left) > 1:
            stack, left = [left[0]], left[1:]
            while stack and len(left):
                at = stack.pop()
                near = self.near(left ^ at, i)
                found = left[near]
                if len(found):
                    left = left[~near]
                    stack += list(found)
                    yield np.full(len(found), at), found

    def links(self, keys: np.ndarray, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Links inside equal keys; ``keys`` are sorted (groups stand together)."""
        if len(keys) < 2:
            return
        starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
        sizes = np.diff(np.append(starts, len(keys)))
        chain = keys[:, 0] >> 58
        small = np.repeat(sizes <= _SMALL, sizes)
        group = np.repeat(np.arange(len(starts)), sizes)
        for step in range(1, min(_SMALL, int(sizes.max()))):
            a = np.flatnonzero((group[:-step] == group[step:]) & small[:-step])
            for i in range(len(self.widths)):
                own = a[chain[a] == i]
                own = own[self.near(prints[own] ^ prints[own + step], i)]
                yield prints[own], prints[own + step]
        for g in np.flatnonzero(sizes > _SMALL).tolist():
            part = np.unique(prints[starts[g] : starts[g] + sizes[g]])
            yield from self.forest(part, int(chain[starts[g]]))


def _keyed(prints: DataFrame, distance: int, cleared: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ring = Ring(distance)
        for batch in batches:
            p = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            keys, places = ring.keys(p, cleared)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(p[places].view(np.int64))], names=["key", "print"])

    return prints.select("print").mapInArrow(run, "key long, print long")


def _links(rows: DataFrame, distance: int) -> DataFrame:
    """Links of rows (key, x, y, print) that are grouped by their first three columns, groups in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ring, keys, prints = Ring(distance), np.zeros((0, 3), np.int64), np.zeros(0, np.uint64)

        def give(keys: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
            for a, b in ring.links(keys, prints):
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            new = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            keys = np.concatenate([keys, np.stack(new[:3], axis=1)])
            prints = np.concatenate([prints, new[3].view(np.uint64)])
            last = int(np.flatnonzero((keys != keys[-1]).any(axis=1))[-1]) + 1 if (keys != keys[-1]).any() else 0
            yield from give(keys[:last], prints[:last])  # the last group may go on in the next batch
            keys, prints = keys[last:], prints[last:]
        yield from give(keys, prints)

    return rows.mapInArrow(run, "a long, b long")


def links(prints: DataFrame, distance: int = 4) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints of the column ``print`` within ``distance`` bits, directly or over others."""
    rows = _keyed(prints, distance, cleared=True)
    # Keys that may be hot: those with many plain fingerprints, and those which these reach by clearing a bit.
    ring = Ring(distance)
    width = max(ring.widths)
    plain = _keyed(prints, distance, cleared=False).groupBy("key").count().where(F.col("count") > HOT)
    bit = F.explode(F.sequence(F.lit(0), F.lit(width))).alias("bit")
    reached = plain.select("key", "count", bit).select(
        F.when(F.col("bit") == width, F.col("key")).otherwise(F.col("key").bitwiseAND(F.bitwise_not(F.expr("shiftleft(1L, bit)")))).alias("key"), "count",
    )
    hot = stage(reached.distinct().groupBy("key").agg(F.ceil(F.sum("count") / HOT).cast("int").alias("blocks")), "hot-keys")
    zero = F.lit(0)
    if hot.isEmpty():
        parted = rows.select("key", zero.alias("x"), zero.alias("y"), "print")
    else:
        own = F.pmod(F.xxhash64("print"), F.coalesce("blocks", F.lit(1)).cast("long")).cast("int").alias("own")
        other = F.explode(F.sequence(zero, F.coalesce("blocks", F.lit(1)) - 1)).alias("other")
        parted = rows.join(hot, "key", "left").select("key", "print", own, "blocks").select("key", "print", "own", other)
        parted = parted.select("key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "print")
    parted = parted.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    return _links(parted, distance)


def _roots(prints: DataFrame, distance: int) -> DataFrame:
    """(print, root, component): for each distinct fingerprint its group, and the group's least id."""
    alone = stage(prints.groupBy("print").agg(F.min("id").alias("least")), "prints")
    linked = components(links(alone, distance)).withColumnRenamed("node", "print")
    named = alone.join(linked, "print", "left").select("print", F.coalesce("root", "print").alias("root"), "least")
    groups = named.join(linked.select("print"), "print", "left_semi").groupBy("root").agg(F.min("least").alias("component"))
    return named.join(groups, "root", "left").select("print", "root", F.coalesce("component", "least").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, distance: int = 4) -> DataFrame:
    """Per document: its id, ``fingerprint`` (16 hex digits) and ``component_id``, the least id reachable over links."""
    prints = map_texts(docs, [id_col], text_col, "print long", lambda: lambda texts: {"print": [fingerprint(t, size) for t in texts]})
    prints = stage(prints.select(F.col(f"`{id_col}`").alias("id"), "print"), "fingerprints")
    out = prints.join(_roots(prints, distance), "print", "left")
    return out.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, distance: int = 4) -> DataFrame:
    """Whole rows, one of each group of near-duplicates: the one with the least id (of equal ids, one of them)."""
    mark = "print"
    while mark in docs.columns:
        mark += "_"
    rows = map_whole_rows(docs, text_col, lambda: lambda texts: {mark: [fingerprint(t, size) for t in texts]}, added=f"`{mark}` long")
    rows = stage(rows, "fingerprinted")
    prints = rows.select(F.col(f"`{id_col}`").alias("id"), F.col(mark).alias("print"))
    groups = _roots(prints, distance).select(F.col("print").alias("g_print"), F.col("root").alias("g_root"), F.col("component").alias("g_component"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    inner = rows.select(F.col(mark).alias("print"), F.col(f"`{id_col}`").alias("id"), row)
    kept = inner.join(groups, F.col("print") == F.col("g_print")).where(F.col("id").eqNullSafe(F.col("g_component")))
    return kept.dropDuplicates(["g_root"]).select("row.*")
