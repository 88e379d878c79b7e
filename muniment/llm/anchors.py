"""Repeated windows of long texts, brought together by content: what the two substring operators share.

Both look for windows (``width`` symbols in a row) that occur more than once. Every window is named by the least hash among its
grams (``gram`` symbols in a row). Equal windows have equal names, and neighbouring windows mostly share theirs, so a text
falls into a few runs of windows with one name. Only names met at least twice go on, and only the texts of their runs are sent to the task of
the name, where the operator's own method compares them. A name with more than ``HEAVY`` runs has its windows told apart by their
full digest instead, which Spark counts with partial sums, so that no group is ever gathered in one place.

Texts that are equal as a whole are told by hash and length and searched once. 64-bit text hashes name texts in
joins, with 32 more bits and the length where copies are counted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muniment.llm.common import raw_texts, slices, small_batches
from muniment.session import stage

#: Runs with one name beyond which its windows are compared by digest.
HEAVY = 50_000
#: Symbols whose hashes are worked out at once.
CHUNK = 1 << 20

_RUN_BITS, _SELF = 24, 1 << 23
_MIX = [np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)]
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


#: A hash for each byte.
BYTE_HASHES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def gram_hashes(symbols: np.ndarray, gram: int) -> np.ndarray:
    """Hash of each gram, from running sums: equal grams have equal hashes wherever they stand."""
    n = len(symbols)
    if n < gram:
        return np.zeros(0, np.uint64)
    if len(_powers[0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        for i, base in enumerate((_BASE, inverse)):
            steps = np.full(max(n, 1 << 14), base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(symbols * _powers[0][:n])])
    return mix((sums[gram:] - sums[:-gram]) * _powers[1][: n - gram + 1])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, from least-so-far of blocks forwards and backwards."""
    n = len(values) - width + 1
    if width == 1 or n < 1:
        return values[: max(n, 0)]
    size = -(-len(values) // width) * width
    padded = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


@dataclass(frozen=True)
class Shape:
    """How texts are read: ``symbols`` gives the hashes of a text's symbols, ``cut`` a function from (first, last) to the text of these."""

    width: int
    gram: int
    symbols: Callable[[bytes], np.ndarray]
    cut: Callable[[bytes], Callable[[int, int], bytes]]

    def runs(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(name, packed run) of the windows of a text: first window, whether the name may recur inside the run, windows."""
        every, spread = self.symbols(text), self.width - self.gram + 1
        names, runs = [], []
        for at in range(0, len(every) - self.width + 1, CHUNK):
            grams = gram_hashes(every[at : at + CHUNK + self.width - 1], self.gram)
            least = sliding_least(grams, spread)
            first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
            count = np.diff(np.append(first, len(least)))
            name = least[first]
            twice = np.zeros(len(first), np.int64)
            ordered = np.sort(grams)
            again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
            if len(again):
                for r in np.flatnonzero(np.isin(name, again)).tolist():
                    twice[r] = np.count_nonzero(grams[first[r] : first[r] + count[r] + spread - 1] == name[r]) > 1
            names.append(name)
            runs.append((first + at) << _RUN_BITS | twice * _SELF | count)
        if not names:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return np.concatenate(names), np.concatenate(runs)


def unpack(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows."""
    return runs >> _RUN_BITS, runs & (_SELF - 1)


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, a, b, size, t): a document's id, its text's hashes and length, and the text, a null being empty."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("t"))
    return rows.select("id", F.xxhash64("t").alias("a"), F.hash("t").alias("b"), F.octet_length("t").alias("size"), "t")


def _named_runs(texts: DataFrame, shape: Shape) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                found = [shape.runs(t) for t in raw_texts(part.column(1))]
                sizes = [len(n) for n, _ in found]
                names, runs = (np.concatenate([f[i] for f in found]) for i in (0, 1))
                keys = part.column(0).take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
                yield pa.RecordBatch.from_arrays([keys, pa.array(names.view(np.int64)), pa.array(runs)], names=["key", "name", "run"])

    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("name", T.LongType()), T.StructField("run", T.LongType())])
    return small_batches(texts.select("a", "t")).mapInArrow(run, schema)


def _run_texts(rows: DataFrame, shape: Shape, whole: bool) -> DataFrame:
    """The texts of runs: in one piece, or, not ``whole``, one digest for each window."""
    more = "start long, n int, body binary" if whole else "start long, digest binary"
    schema = T.StructType([T.StructField("name", T.LongType()), *(rows.schema[c] for c in ("a", "b", "id")), *T.StructType.fromDDL(more).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import blake2b

        for batch in batches:
            for part in slices(batch, 3, 1 << 20):
                listed = part.column(4)
                inner = listed.flatten()
                sizes = pc.list_value_length(listed).to_numpy(zero_copy_only=False)
                of = np.repeat(np.arange(part.num_rows), sizes)
                names = inner.field(0).to_numpy(zero_copy_only=False)
                first, count = unpack(inner.field(1).to_numpy(zero_copy_only=False))
                texts, last, cut, bodies = raw_texts(part.column(3)), -1, None, []
                picked, starts = [], []
                for i, (d, s, n) in enumerate(zip(of.tolist(), first.tolist(), count.tolist())):
                    if d != last:
                        last, cut = d, shape.cut(texts[d])
                    if whole:
                        bodies.append(cut(s, s + n + shape.width - 1))
                        picked.append(i)
                        starts.append(s)
                    else:
                        for w in range(s, s + n):
                            bodies.append(blake2b(cut(w, w + shape.width), digest_size=16).digest())
                            picked.append(i)
                            starts.append(w)
                rows_at = pa.array(of[picked])
                arrays = [pa.array(names[picked]), *(part.column(i).take(rows_at) for i in range(3)), pa.array(starts, pa.int64())]
                arrays += [pa.array(count[picked], pa.int32())] if whole else []
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(bodies, pa.binary())], names=schema.names)

    return small_batches(rows.select("a", "b", "id", "t", "runs")).mapInArrow(run, schema)


def repeated_runs(texts: DataFrame, shape: Shape, heavy: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """What may repeat in keyed texts.

    Returns the distinct texts (a, b, size, least id, copies); the run texts (name, a, b, id, start, n, body) whose name is met twice, each
    distinct text once; and for heavy names, if there are any, window digests (name, a, b, id, start, digest).
    """
    heavy = HEAVY if heavy is None else heavy
    copies = stage(texts.groupBy("a", "b", "size").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "copies")
    named = _named_runs(texts, shape)
    recurs = F.col("run").bitwiseAND(_SELF)
    met = named.groupBy("name").agg(F.count("*").alias("met"), F.max(recurs).alias("recurs")).where("met > 1 OR recurs > 0")
    found = named.join(met, "name").groupBy("key").agg(F.collect_set(F.struct("name", "run", (F.col("met") > heavy).alias("heavy"))).alias("runs"))
    # Runs belong to a text, not to a document's id: one id may stand at several texts.
    listed = stage(copies.join(found, copies["a"] == found["key"]).select("a", "b", "size", "id", "runs"), "candidate-runs")
    light, dense = (F.filter("runs", lambda r: r["heavy"] == flag) for flag in (False, True))

    def joined(runs) -> DataFrame:
        some = listed.select("a", "b", "size", "id", runs.alias("runs")).where(F.size("runs") > 0)
        return texts.join(some.withColumnRenamed("id", "own"), ["a", "b", "size"]).where(F.col("id").eqNullSafe(F.col("own")))

    bodies = _run_texts(joined(light), shape, True)
    digests = None if listed.where(F.size(dense) > 0).isEmpty() else _run_texts(joined(dense), shape, False)
    return copies, bodies, digests


def by_name(bodies: DataFrame, solve: Callable[[list], Iterator[tuple[int, np.ndarray, np.ndarray]]], limit: int = 1 << 20) -> DataFrame:
    """Spans (a, b, start, end) found among run texts, names coming together in a task.

    ``solve`` gets a list of groups, each a list of (id, start, windows, body), of about ``limit`` bytes in all, and yields for a member, by
    its place in the whole list, the starts and ends of spans.
    """
    rows = bodies.repartition("name").sortWithinPartitions("name")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: list[list] = []
        keys: list[tuple] = []
        held, last = 0, None

        def give() -> Iterator[pa.RecordBatch]:
            picked, starts, ends = [], [], []
            for member, s, e in solve(groups):
                picked += [member] * len(s)
                starts.append(s)
                ends.append(e)
            if picked:
                a, b = zip(*(keys[i] for i in picked))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int32()), pa.array(np.concatenate(starts)), pa.array(np.concatenate(ends))], names=["a", "b", "start", "end"])

        for batch in batches:
            for name, a, b, own, start, n, body in zip(*(c.to_pylist() for c in batch.columns)):
                if name != last:
                    if held > limit:
                        yield from give()
                        groups, keys, held = [], [], 0
                    groups.append([])
                    last = name
                groups[-1].append((own, start, n, body, a, b))
                keys.append((a, b))
                held += len(body)
        if groups:
            yield from give()

    return rows.select("name", "a", "b", "id", "start", "n", "body").mapInArrow(run, "a long, b int, start long, end long")


def with_spans(texts: DataFrame, copies: DataFrame, spans: DataFrame) -> DataFrame:
    """(id, t, least, copies, spans) of every document."""
    listed = spans.groupBy("a", "b").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    known = copies.withColumnRenamed("id", "least").join(listed, ["a", "b"], "left")
    return texts.join(known, ["a", "b", "size"], "left").select("id", "t", "least", "copies", "spans")


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of spans: touching and overlapping ones become one."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate([[True], starts[1:] > ends[:-1]])
    return starts[first], np.append(ends[:-1][first[1:]], ends[-1])
