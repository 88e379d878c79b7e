"""Near copies by exact similarity of word shingles: SimHash fingerprints and minima of hashes find candidates, Jaccard decides.

A text is the set of its shingles (``size`` words, A-Z in lower case). Texts with equal sets are one node from the start. Candidates are texts whose SimHash fingerprints the ring search of
``simhash`` links: ``NEAR`` bits or fewer, over its chains of segments. At a similarity of 0.8 fingerprints of 64 bits lie some ten bits
apart, too far for keys that are cut from them; so texts that share a band are candidates as well: the least hashes of the set under ``ROWS`` of ``BANDS`` * ``ROWS`` functions, and of
these the fingerprints prune pairs that differ in more than ``FAR`` bits, the sizes those that cannot be similar enough, and four bits of each of 64 least hashes those that
differ in more than ``UNLIKE``. So texts that only share a common passage are not compared. Two texts of similarity 0.8 share no band once in 20,000 pairs. Candidates tied together make groups; in each group texts are compared exactly, block by block, and only a spanning forest
of the links is given out.

A band with more than ``HOT`` nodes, and a group of more than ``GROUP_BYTES`` of text, are dealt into blocks that meet pairwise, each pair in a task of its own.

Defined results: null, empty and blank texts have the empty set and are copies of each other; a text of fewer words than a shingle is one shingle; a group
is named by its least id that is not null; repeated ids stay apart if their texts do; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muniment.llm.common import map_whole_rows, raw_texts
from muniment.llm.graph import components
from muniment.llm.simhash import SEED, fingerprint, links
from muniment.session import stage

#: Bits by which fingerprints differ at most that the ring search links.
NEAR = 4
BANDS, ROWS = 25, 5
#: Bits by which fingerprints of candidates may differ.
FAR = 28
#: Of 64 least hashes those that may differ: 12 are expected at a similarity of 0.8, with a deviation of 3; 45 at 0.25.
UNLIKE = 28
HOT = 4096
GROUP_BYTES = 8 << 20

_BASE = 0x9E3779B97F4A7C15
_DICE = np.random.default_rng(SEED)
_FACTORS = _DICE.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _DICE.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingles(text: bytes, size: int) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles, in order."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - size + 1)
    return np.unique(np.fromiter((xxh64_intdigest(b" ".join(words[i : i + size]), SEED) for i in range(n)), np.uint64, n))


def band_keys(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys of the bands, and four bits of each of the first 64 least hashes in four words."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 4096):
        mixed = hashes[at : at + 4096, None] * _FACTORS + _OFFSETS
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        least = np.minimum(least, mixed.min(axis=0))
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for part in least.reshape(BANDS, ROWS).T:
        keys = (keys * np.uint64(0x9E3779B97F4A7C15)) ^ part
        keys ^= keys >> np.uint64(31)
    bits = (least[:64] * np.uint64(_BASE)) >> np.uint64(60)
    words = np.bitwise_or.reduce(bits.reshape(4, 16) << (np.arange(16, dtype=np.uint64) * np.uint64(4)), axis=1)
    return keys.view(np.int64), words.view(np.int64)


def likely(at: int, others: np.ndarray, prints: np.ndarray, n: np.ndarray, words: np.ndarray, least: float) -> np.ndarray:
    """Which of the others may be similar enough, by sizes, fingerprints and least hashes."""
    out = (np.bitwise_count(prints[others] ^ prints[at]) <= FAR) & (np.minimum(n[others], n[at]) >= least * np.maximum(n[others], n[at]))
    left = np.flatnonzero(out)
    x = words[others[left]] ^ words[at]
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    out[left] = np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=1) <= UNLIKE
    return out


def forest(n: int, near) -> Iterator[tuple[int, np.ndarray]]:
    """Links that hold each linked group of 0 .. n - 1 together; ``near(i, others)`` tells which of the others are linked to i."""
    left = np.arange(n)
    while len(left) > 1:
        stack, left = [left[0]], left[1:]
        while stack and len(left):
            at = stack.pop()
            linked = near(at, left)
            if linked.any():
                found, left = left[linked], left[~linked]
                stack += found.tolist()
                yield at, found


def _candidates(least: float):
    """Candidate links inside bands, which stand together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def give(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            starts = np.flatnonzero(np.concatenate([[True], (rows[1:, :3] != rows[:-1, :3]).any(axis=1)]))
            a, b = [], []
            for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(rows)]):
                if e - s > 1:
                    node, prints, n = rows[s:e, 3], np.ascontiguousarray(rows[s:e, 4]).view(np.uint64), rows[s:e, 5]
                    words = np.ascontiguousarray(rows[s:e, 6:]).view(np.uint64)
                    near = lambda i, o: likely(i, o, prints, n, words, least)  # noqa: E731, B023
                    for i, found in forest(e - s, near):
                        a.append(np.full(len(found), node[i]))
                        b.append(node[found])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
            rows = np.concatenate([*held, rows])
            change = np.flatnonzero((rows[:, :3] != rows[-1, :3]).any(axis=1))
            cut = int(change[-1]) + 1 if len(change) else 0  # the last band may go on
            if cut:
                yield from give(np.ascontiguousarray(rows[:cut]))
            held = [rows[cut:]]
        if held and len(held[0]):
            yield from give(np.ascontiguousarray(held[0]))

    return run


def _exact(size: int, least: float):
    def solve(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        order = np.argsort(node)
        texts = [t for c in table.column("t").chunks for t in raw_texts(c)]
        node, sets = node[order], [shingles(texts[i], size) for i in order.tolist()]
        sizes = np.array([len(s) for s in sets], np.int64)
        ends = np.cumsum(sizes)
        flat = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)

        prints = table.column("print").to_numpy().astype(np.int64)[order].view(np.uint64)
        words = np.stack([table.column(f"w{k}").to_numpy().astype(np.int64)[order].view(np.uint64) for k in range(4)], axis=1)

        def near(i: int, others: np.ndarray) -> np.ndarray:
            out = likely(i, others, prints, sizes, words, least)
            for k in np.flatnonzero(out).tolist():
                j = others[k]
                mine = flat[ends[j] - sizes[j] : ends[j]]
                at = np.searchsorted(sets[i], mine)
                both = int(np.count_nonzero(sets[i][np.minimum(at, max(0, sizes[i] - 1))] == mine)) if sizes[i] else 0
                out[k] = both >= least * (sizes[i] + sizes[j] - both)
            return out

        a, b = [], []
        for i, found in forest(len(node), near):
            a.append(np.full(len(found), node[i]))
            b.append(node[found])
        joined = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64())
        return pa.table({"a": joined(a), "b": joined(b)})

    return solve


def _blocked(rows: DataFrame, key: str, blocks: DataFrame, keep: list[str]) -> DataFrame:
    """Rows of a key, dealt into its blocks, once for each pair of blocks (``x`` <= ``y``) that they belong to."""
    n = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("node"), n.cast("long")).cast("int").alias("own")
    dealt = rows.join(blocks, key, "left").select(key, *keep, own, n.alias("blocks"))
    dealt = dealt.select(key, *keep, "own", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)).alias("other"))
    return dealt.select(key, F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), *keep)


def near_prints(sets: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) between nodes whose fingerprints are equal or that the ring search links, from rows (node, print)."""
    first = stage(sets.groupBy("print").agg(F.min("node").alias("first")), "prints")
    equal = sets.join(first, "print").where("node != first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    side = lambda c: first.select(F.col("print").alias(c), F.col("first").alias(f"n_{c}"))
    found = links(first.select("print"), distance).distinct().join(side("a"), "a").join(side("b"), "b")
    return equal.unionByName(found.select(F.col("n_a").alias("a"), F.col("n_b").alias("b")))


def similar_roots(rows: DataFrame, size: int, least: float) -> DataFrame:
    """(set_key, set_print, set_n, root, component) of each distinct set, from rows (row, id, t, print, n, set, bands)."""
    sets = rows.groupBy("set", "print", "n").agg(F.min("id").alias("least"), F.min("row").alias("row"), F.min("bands").alias("bands"), *[F.min(F.col("words")[k]).alias(f"w{k}") for k in range(4)])
    sketch = ["print", "n", "w0", "w1", "w2", "w3"]
    sets = stage(sets.select(F.monotonically_increasing_id().alias("node"), "*"), "sets")
    banded = sets.select(F.explode("bands").alias("band"), "node", *sketch)
    hot = stage(banded.groupBy("band").count().where(F.col("count") > HOT).select("band", F.ceil(F.col("count") / HOT).alias("blocks")), "hot-bands")
    zero = F.lit(0)
    if hot.isEmpty():
        dealt = banded.select("band", zero.alias("x"), zero.alias("y"), "node", *sketch)
    else:
        dealt = _blocked(banded, "band", hot, ["node", *sketch])
    dealt = dealt.repartition("band", "x", "y").sortWithinPartitions("band", "x", "y")
    tied = components(near_prints(sets.select("node", "print"), NEAR).unionByName(dealt.mapInArrow(_candidates(least), "a long, b long")))
    # Texts of candidates only, one for each set.
    members = tied.withColumnRenamed("root", "group").join(sets.select("node", "row", *sketch), "node").join(rows.select("row", "t"), "row")
    members = stage(members.select("group", "node", "t", *sketch), "candidates")
    large = members.groupBy("group").agg(F.sum(F.octet_length("t") + 64).alias("bytes")).where(F.col("bytes") > GROUP_BYTES)
    large = large.select("group", F.ceil(F.col("bytes") / GROUP_BYTES).alias("blocks"))
    grouped = _blocked(members, "group", large, ["node", "t", *sketch]).groupBy("group", "x", "y")
    roots = components(grouped.applyInArrow(_exact(size, least), "a long, b long"))
    named = sets.join(roots, "node", "left").select("set", "print", "n", "least", F.coalesce("root", "node").alias("root"))
    names = named.groupBy("root").agg(F.min("least").alias("component"))
    return named.join(names, "root").select(F.col("set").alias("g_set"), F.col("print").alias("g_print"), F.col("n").alias("g_n"), F.col("root").alias("g_root"), F.col("component").alias("g_component"))


def _marked(docs: DataFrame, text_col: str, size: int) -> tuple[DataFrame, dict[str, str]]:
    """Whole rows with their fingerprints, set sizes, set hashes and bands under names that the table does not have."""
    from xxhash import xxh64_intdigest

    names = {}
    for name in ("print", "n", "set", "bands", "words", "row"):
        names[name] = f"_{name}"
        while names[name] in docs.columns:
            names[name] += "_"

    def fn(texts: list[bytes]) -> dict:
        sets = [shingles(t, size) for t in texts]
        bands = [band_keys(s) for s in sets]
        signed = [int(np.uint64(xxh64_intdigest(s.tobytes(), SEED)).astype(np.int64)) for s in sets]
        return dict(zip((names[k] for k in ("print", "n", "set", "bands", "words")), ([fingerprint(t, size) for t in texts], [len(s) for s in sets], signed, [k.tolist() for k, _ in bands], [w.tolist() for _, w in bands])))

    added = f"`{names['print']}` long, `{names['n']}` long, `{names['set']}` long, `{names['bands']}` array<long>, `{names['words']}` array<long>"
    rows = map_whole_rows(docs, text_col, lambda: fn, added=added)
    return stage(rows.select("*", F.monotonically_increasing_id().alias(names["row"])), "shingled"), names


def keep_one_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, least: float = 0.8) -> DataFrame:
    """Whole rows, one of each group of texts that are tied by similarities of ``least`` or more: the one with the least id (of equal ids, one of them)."""
    rows, of = _marked(docs, text_col, size)
    plain = rows.select(F.col(of["row"]).alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("t"), *[F.col(of[k]).alias(k) for k in ("print", "n", "set", "bands", "words")])
    groups = similar_roots(plain, size, least)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    inner = rows.select(*[F.col(of[k]).alias(k) for k in ("print", "n", "set")], F.col(f"`{id_col}`").alias("id"), row)
    joined = inner.join(groups, (F.col("set") == F.col("g_set")) & (F.col("print") == F.col("g_print")) & (F.col("n") == F.col("g_n")))
    return joined.where(F.col("id").eqNullSafe(F.col("g_component"))).dropDuplicates(["g_root"]).select("whole.*")
