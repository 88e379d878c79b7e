"""Substring dedup of words: windows that an earlier document holds are removed.

Suffixes are split by a prefix-like key, the content name of their first windows (see ``anchors``), into groups that fit into memory; a heavy key is
lengthened to the whole window. In each group the suffix tree is built in its array form: suffixes sorted by their words, and the depth at which each parts
from the one before it. An inner node of at least ``width`` words is a repeat; its least document keeps it, all later ones lose it.

Defined results: null and blank texts have no words; a document with a null id neither loses words nor takes any; documents
with one id don't take from each other; equal rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muniment.llm.anchors import Shape, by_name, keyed_texts, merged, repeated_runs, with_spans
from muniment.llm.common import map_texts

WIDTH = 13
GRAM = 4

ADDED = "n_words long, n_removed long, kept_sha256 string, spans array<struct<start: long, end: long>>"


def _hashes(text: bytes) -> np.ndarray:
    from xxhash import xxh64_intdigest

    words = text.split()
    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))


def _cutter(text: bytes):
    words = text.split()
    return lambda a, b: b" ".join(words[a:b])


def shape(width: int = WIDTH, gram: int = GRAM) -> Shape:
    return Shape(width, gram, _hashes, _cutter)


def tree(words: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix tree of the given suffixes, cut at ``depth``: their order, and the depth at which each parts from the one before."""
    columns = np.stack([words[starts + j] for j in range(depth)])
    order = np.lexsort(columns[::-1])
    ordered = columns[:, order]
    same = np.logical_and.accumulate(ordered[:, 1:] == ordered[:, :-1], axis=0).sum(axis=0)
    return order, np.concatenate([[0], same])


def solver(width: int):
    def solve(groups: list) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """One tree for all groups: suffixes of different groups can't share a window, as their names differ."""
        number: dict[bytes, int] = {}
        words: list[int] = []
        starts, least, plans, place, bodies = [], [], [], 0, 0
        for group in groups:
            seen: dict[bytes, list] = {}
            for own, _, n, body, _, _ in group:
                seen.setdefault(body, [own, n, -1])
                seen[body][0] = min(seen[body][0], own)
            if len(seen) > 1:
                for body, plan in seen.items():
                    plan[2] = bodies
                    bodies += 1
                    starts.append(np.arange(len(words), len(words) + plan[1]))
                    least.append(np.full(plan[1], plan[0], np.int64))
                    words += [number.setdefault(w, len(number)) for w in body.split(b" ")]
            plans.append((place, group, seen))
            place += len(group)
        later: list[np.ndarray] = []
        if starts:
            order, depth = tree(np.array(words, np.int64), np.concatenate(starts), width)
            node = np.cumsum(depth < width) - 1
            ids = np.concatenate(least)
            first = np.full(int(node[-1]) + 1, np.iinfo(np.int64).max)
            np.minimum.at(first, node, ids[order])
            held = np.empty(len(order), np.int64)
            held[order] = first[node]
            later = np.split(held < ids, np.cumsum([len(s) for s in starts])[:-1])
        for place, group, seen in plans:
            for i, (own, start, n, body, _, _) in enumerate(group):
                first_id, _, at = seen[body]
                if own > first_id:
                    yield place + i, np.array([start]), np.array([start + n + width - 1])
                elif at >= 0 and later[at].any():
                    hit = np.flatnonzero(later[at]) + start
                    yield place + i, *merged(hit, hit + width)

    return solve


def _cut(width: int):
    def fn(texts: list[bytes], ids: list, least: list, spans: list) -> dict:
        out = {"n_words": [], "n_removed": [], "kept_sha256": [], "spans": []}
        for text, own, first, found in zip(texts, ids, least, spans):
            words = text.split()
            if own is None:
                s = e = np.zeros(0, np.int64)
            elif first is not None and own > first and len(words) >= width:
                s, e = np.array([0]), np.array([len(words)])
            else:
                s, e = merged(*(np.array([x[k] for x in found or []], np.int64) for k in ("start", "end")))
            edges = [0, *(x for pair in zip(s.tolist(), e.tolist()) for x in pair), len(words)]
            kept = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]
            for name, value in zip(out, (len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(), [{"start": a, "end": b} for a, b in zip(s.tolist(), e.tolist())])):
                out[name].append(value)
        return out

    return lambda: fn


def repeat_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, gram: int = GRAM, heavy: int | None = None) -> DataFrame:
    """Per document: its id (an integer), its words, those inside windows that a document with a smaller id holds, the hash of what is left, and
    the removed runs."""
    texts = keyed_texts(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    copies, bodies, digests = repeated_runs(texts.where("id IS NOT NULL"), shape(width, gram), heavy)
    spans = by_name(bodies, solver(width))
    if digests is not None:
        first = digests.groupBy("digest").agg(F.min("id").alias("first"))
        later = digests.join(first, "digest").where(F.col("id") > F.col("first"))
        spans = spans.union(later.select("a", "b", "start", (F.col("start") + width).alias("end")))
    rows = with_spans(texts, copies, spans).withColumn("own", F.col("id"))
    return map_texts(rows, ["id"], "t", ADDED, _cut(width), use=["own", "least", "spans"]).withColumnRenamed("id", id_col)
