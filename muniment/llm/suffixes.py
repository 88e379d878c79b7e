"""Suffix-array dedup of bytes: strings of a least length that occur twice are found on a Burrows-Wheeler transform.

Run texts with one name (see ``anchors``) are laid end to end, with a separator that no UTF-8 text holds. Their suffixes are sorted as far as needed,
which gives the transform. Then intervals of suffixes with a common prefix are extended backwards, breadth first: every
interval of the strings of length l yields those of length l + 1 by each byte that stands before it, and each new right border
gets the common-prefix length l. Lengths are so derived in increasing order, and the search stops at the least length: suffixes
with no border between them share at least that much.

Defined results: null and empty texts lose nothing; a text met twice as a whole loses all if it is long enough; strings may overlap themselves; null
and repeated ids don't matter, every row gets its own result; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muniment.llm.anchors import BYTE_HASHES, Shape, by_name, keyed_texts, merged, repeated_runs, with_spans
from muniment.llm.common import map_texts

LEAST = 400
GRAM = 64
SEPARATOR = 0xFF
#: Runs with one name beyond which windows are compared by digest: about 9 MB of text, for which sorting takes some 500 MB.
HEAVY = 1 << 14

ADDED = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>"


#: Bytes of prefix whose borders the sort gives; the backward extension goes on from there.
SEED = 32


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first ``depth`` bytes, at least, and where a new prefix of ``SEED`` bytes begins.

    Sorted by 8 bytes first, then by twice as many in each round; rounds only move suffixes that are still equal.
    """
    n = len(text)
    padded = np.concatenate([text, np.full(8, SEPARATOR, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for j in range(8):
        key = key << np.uint64(8) | padded[j : j + n]
    order = np.argsort(key).astype(np.int32)
    fresh = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    del padded
    rank = np.zeros(n + depth * 2, np.int32)
    sorted_depth, seeds = 8, fresh
    while sorted_depth < depth:
        first = np.maximum.accumulate(np.where(fresh, np.arange(n, dtype=np.int32), np.int32(0)))
        rank[:n][order] = first + 1
        alone = fresh & np.append(fresh[1:], True)
        slots = np.flatnonzero(~alone)
        if not len(slots):
            break
        members = order[slots]
        next_rank = rank[members + sorted_depth]
        again = np.argsort(first[slots].astype(np.int64) << 32 | next_rank)
        order[slots] = members[again]
        groups, ranks = first[slots][again], next_rank[again]
        fresh[slots] = np.concatenate([[True], (groups[1:] != groups[:-1]) | (ranks[1:] != ranks[:-1])])
        sorted_depth *= 2
        if sorted_depth == SEED:
            seeds = fresh.copy()
    return order, seeds


def common_prefixes(text: np.ndarray, order: np.ndarray, least: int, seeds: np.ndarray | None = None) -> np.ndarray:
    """Length of the common prefix of each suffix and the one before it, as far as it is below ``least``; else -1.

    With the ``seeds`` of the sort, lengths below ``SEED`` count as 0 and the extension begins at the strings of that length.
    """
    n = len(text)
    before = text[order - 1]  # the transform; the text ends with a separator
    row_of = np.empty(n, np.int32)
    row_of[np.argsort(before, kind="stable")] = np.arange(n, dtype=np.int32)
    lengths = np.full(n + 1, -1, np.int32)
    lengths[0] = lengths[n] = 0
    lows, highs, first = np.array([0]), np.array([n]), 0
    if seeds is not None:
        lengths[:n][seeds] = 0
        lows, first = np.flatnonzero(seeds), SEED
        highs = np.append(lows[1:], n)
    for length in range(first, least):
        sizes = highs - lows
        ends = np.cumsum(sizes)
        rows = np.repeat((lows - (ends - sizes)).astype(np.int32), sizes) + np.arange(int(ends[-1]), dtype=np.int32)
        of = np.repeat(np.arange(len(lows), dtype=np.int32), sizes)
        if length:
            real = before[rows] != SEPARATOR
            rows, of = rows[real], of[real]
        if not len(rows):
            break
        target = row_of[rows]
        sort = np.argsort(target)  # rows are unique
        target, of = target[sort], of[sort]
        char = before[rows][sort]
        edge = np.concatenate([[True], (target[1:] != target[:-1] + 1) | (of[1:] != of[:-1]) | (char[1:] != char[:-1])])
        low = target[edge]
        high = np.append(target[:-1][edge[1:]], target[-1]) + 1
        new = lengths[high] < 0
        if not new.any():
            break
        lengths[high[new]] = length
        lows, highs = low[new], high[new]
    return lengths[:n]


def repeated_starts(bodies: list[bytes], least: int) -> list[np.ndarray]:
    """For each body the places at which a string of ``least`` bytes begins that also begins elsewhere among the bodies."""
    sizes = np.array([len(b) + 1 for b in bodies], np.int64)
    text = np.frombuffer(bytes([SEPARATOR]).join(bodies) + bytes([SEPARATOR]), np.uint8)
    order, seeds = suffix_order(text, least)
    lengths = common_prefixes(text, order, least, seeds if least > SEED else None)
    ends = np.cumsum(sizes)
    body = np.repeat(np.arange(len(bodies), dtype=np.int32), sizes)
    valid = order + least < ends[body[order]]
    group = np.cumsum(lengths >= 0)
    count = np.bincount(group[valid], minlength=int(group[-1]) + 1)
    found = np.sort(order[valid & (count[group] > 1)]).astype(np.int64)
    at = np.searchsorted(found, ends - sizes)
    return [found[a:b] - s for a, b, s in zip(at, [*at[1:], len(found)], (ends - sizes).tolist())]


def solver(least: int):
    def solve(groups: list) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Bodies that occur twice repeat as a whole; of the others only those that aren't alone in their group are searched."""
        bodies: list[bytes] = []
        plans, place = [], 0
        for group in groups:
            seen: dict[bytes, set] = {}
            for member in group:
                seen.setdefault(member[3], set()).add((member[4], member[5], member[1]))
            search = len(seen) > 1 or any(m[2] > least for m in group) or any(len(v) == 1 for v in seen.values())
            first = len(bodies)
            index = {b: first + i for i, b in enumerate(seen)}
            if search and (len(seen) > 1 or any(len(v) == 1 for v in seen.values())):
                bodies += seen
            plans.append((place, group, seen, index))
            place += len(group)
        starts = repeated_starts(bodies, least) if bodies else []
        for place, group, seen, index in plans:
            for i, (_, start, n, body, _, _) in enumerate(group):
                if len(seen[body]) > 1:
                    yield place + i, np.array([start]), np.array([start + n + least - 1])
                else:
                    own = starts[index[body]]
                    s, e = merged(own + start, own + start + least)
                    if len(s):
                        yield place + i, s, e

    return solve


def shape(least: int = LEAST, gram: int = GRAM) -> Shape:
    return Shape(least, gram, lambda text: BYTE_HASHES[np.frombuffer(text, np.uint8)], lambda text: lambda a, b: text[a:b])


def _cut(least: int):
    def fn(texts: list[bytes], copies: list, spans: list) -> dict:
        out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "spans": []}
        for text, n, found in zip(texts, copies, spans):
            if n and n > 1 and len(text) >= least:
                s, e = np.array([0]), np.array([len(text)])
            else:
                s, e = merged(*(np.array([x[k] for x in found or []], np.int64) for k in ("start", "end")))
            edges = [0, *(x for pair in zip(s.tolist(), e.tolist()) for x in pair), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
            for name, value in zip(out, (len(text), len(text) - len(kept), len(s), hashlib.sha256(kept).hexdigest(), [{"start": a, "end": b} for a, b in zip(s.tolist(), e.tolist())])):
                out[name].append(value)
        return out

    return lambda: fn


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, gram: int = GRAM, heavy: int = HEAVY) -> DataFrame:
    """Per document: its id, its bytes, those inside strings of ``least`` bytes that also begin elsewhere, the runs these make, the hash of
    what is left, and the runs themselves."""
    texts = keyed_texts(docs, id_col, text_col)
    copies, bodies, digests = repeated_runs(texts, shape(least, gram), heavy)
    spans = by_name(bodies, solver(least))
    if digests is not None:
        twice = digests.select("a", "b", "start", "digest").distinct().groupBy("digest").count().where("count > 1")
        spans = spans.union(digests.join(twice, "digest").select("a", "b", "start", (F.col("start") + least).alias("end")))
    out = map_texts(with_spans(texts, copies, spans), ["id"], "t", ADDED, _cut(least), use=["copies", "spans"])
    return out.withColumnRenamed("id", id_col)
