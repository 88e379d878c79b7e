"""Benchmark decontamination with a positional inverted index that is distributed by document.

Each task indexes its documents in blocks: for every term that some test item uses, the sorted list of its positions
(other terms can't take part in a match, so they need no postings). The windows of the items are the queries. A window is
looked up from its rarest term in the block: that term's postings, less its offset in the window, are the candidate
starts, and they are intersected with the offset-adjusted postings of the next rarer terms until all have agreed.
Documents never move; the items do, in chunks of at most ``CHUNK_BYTES`` each, so any number of items can be searched:
each chunk is one broadcast, written to the executors' disks, and a task holds one at a time.

Defined results: null and empty texts have no words; a null or repeated ``item_id`` counts its hits for words, but
``item_ids`` lists each id once and no null; equal documents get equal rows; empty tables give empty results or no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muniment.llm.common import map_texts, map_whole_rows

#: Text of test items that one index query set (one broadcast) may hold.
CHUNK_BYTES = 8 << 20

ADDED = (
    "n_words long, n_hit long, n_items long, item_ids array<string>, n_near long, "
    "matches array<struct<item_id: string, item_word: int, word: int, n_words: int>>"
)

# Lower-cases A-Z and turns what is no word character of [^\x00-\x2F\x3A-\x60\x7B-\x7F] into a blank.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Windows:
    """Test windows as rows of term numbers, with the item and offset of each; equal windows of one length stay apart."""

    def __init__(self, items: list[tuple[str | None, bytes]], size: int):
        self.vocabulary: dict[bytes, int] = {}
        by_length: dict[int, list[tuple[list[int], int, int]]] = {}
        self.ids = [i for i, _ in items]
        for k, (_, text) in enumerate(items):
            row = [self.vocabulary.setdefault(t, len(self.vocabulary)) for t in terms(text)]
            n = min(size, len(row))
            for a in range(len(row) - n + 1 if n else 0):
                by_length.setdefault(n, []).append((row[a : a + n], k, a))
        self.groups = {n: (np.array([r for r, _, _ in rows]), np.array([k for _, k, _ in rows]), np.array([a for _, _, a in rows])) for n, rows in by_length.items()}


class Postings:
    """Positions of each test term in a block of documents; documents lie ``gap`` apart, so no window crosses them."""

    def __init__(self, docs: list[list[bytes]], windows: Windows, gap: int):
        sizes = np.array([len(d) for d in docs], np.int64)
        self.base = np.cumsum(sizes + gap) - (sizes + gap)
        n = int(sizes.sum())
        found = np.fromiter((windows.vocabulary.get(w, -1) for d in docs for w in d), np.int64, n)
        at = np.flatnonzero(found >= 0)
        self.doc = np.repeat(np.arange(len(docs)), sizes)[at]
        place = at + self.doc * gap
        term = found[at]
        order = np.argsort(term, kind="stable")
        self.positions = place[order]
        self.counts = np.bincount(term, minlength=len(windows.vocabulary))
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])

    def of(self, term: int) -> np.ndarray:
        return self.positions[self.starts[term] : self.starts[term + 1]]

    def agree(self, starts: np.ndarray, term: int, offset: int, slop: int) -> np.ndarray:
        """Those starts for which ``term`` stands ``offset`` words further, give or take ``slop``."""
        own = self.of(term)
        i = np.searchsorted(own, starts + offset - slop)
        near = own[np.minimum(i, len(own) - 1)]
        return starts[(i < len(own)) & (near <= starts + offset + slop)]

    def search(self, windows: Windows, slop: int = 0) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """(item, offset in the item, length, starts) of every window that occurs; with slop, of every proximity match."""
        for n, (rows, items, offsets) in windows.groups.items():
            rarity = self.counts[rows]
            for w in np.flatnonzero(rarity.min(axis=1) > 0).tolist():
                row, starts = rows[w], None
                for j in np.argsort(rarity[w], kind="stable").tolist():
                    starts = self.of(row[j]) - j if starts is None else self.agree(starts, row[j], j, slop)
                    if not len(starts):
                        break
                if len(starts):
                    yield int(items[w]), int(offsets[w]), n, starts


def item_chunks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[str | None, bytes]]]:
    """The items, one chunk of at most about ``CHUNK_BYTES`` at a time (a longer item makes its own)."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = items.select(F.col(f"`{id_col}`").cast("string").alias("i"), text.alias("t"))
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    parts = max(1, -(-2 * total // CHUNK_BYTES))
    for k in range(parts):
        part = rows if parts == 1 else rows.where(F.pmod(F.xxhash64("t", "i"), F.lit(parts)) == k)
        chunk, size = [], 0
        for r in part.toLocalIterator():
            chunk.append((r.i, r.t.encode()))
            size += len(chunk[-1][1])
            if size >= CHUNK_BYTES:
                yield chunk
                chunk, size = [], 0
        if chunk:
            yield chunk


def matcher(chunks: list, size: int, slop: int):
    """Function from texts to the columns ``ADDED``; ``chunks`` are broadcasts of items."""

    def setup():
        ready = [Windows(chunks[0].value, size)] if len(chunks) == 1 else None

        def fn(texts: list[bytes]) -> dict:
            docs = [terms(t) for t in texts]
            lengths = np.array([len(d) for d in docs], np.int64)
            ends = np.cumsum(lengths)
            firsts, n = ends - lengths, len(docs)
            hit, near = np.zeros(int(ends[-1]) if n else 0, bool), np.zeros(int(ends[-1]) if n else 0, bool)
            ids: list[set] = [set() for _ in docs]
            matches: list[list] = [[] for _ in docs]
            gap = size + slop + 1
            for k in range(len(chunks)):
                windows = ready[0] if ready else Windows(chunks[k].value, size)
                postings = Postings(docs, windows, gap)
                for loose in (0, slop) if slop else (0,):
                    for item, offset, length, starts in postings.search(windows, loose):
                        doc = np.searchsorted(postings.base, starts + loose, side="right") - 1
                        flat = starts - doc * gap
                        mark = near if loose else hit
                        for j in range(-loose, length + loose):
                            inside = (flat + j >= firsts[doc]) & (flat + j < ends[doc])
                            mark[(flat + j)[inside]] = True
                        if not loose:
                            name = windows.ids[item]
                            for d, p in zip(doc.tolist(), (starts - postings.base[doc]).tolist()):
                                matches[d].append((name, offset, p, length))
                                if name is not None:
                                    ids[d].add(name)
            near |= hit
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in (hit, near)]
            count = [(s[ends] - s[firsts]).tolist() for s in sums]
            fields = ("item_id", "item_word", "word", "n_words")
            return {
                "n_words": [len(d) for d in docs], "n_hit": count[0], "n_items": [len(x) for x in ids], "item_ids": [sorted(x) for x in ids],
                "n_near": count[1], "matches": [[dict(zip(fields, m)) for m in sorted(x, key=lambda m: (m[2], m[1], m[0] or ""))] for x in matches],
            }

        return fn

    return setup


def _broadcast(docs: DataFrame, items: DataFrame, item_id: str, item_text: str) -> list:
    context = docs.sparkSession.sparkContext
    return [context.broadcast(c) for c in item_chunks(items, item_id, item_text)] or [context.broadcast([])]


def find_matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                 item_text: str = "text", size: int = 10, slop: int = 0) -> DataFrame:
    """Per document: words, words inside exact windows of ``size`` item words, items found, words inside proximity
    matches (each term within ``slop`` words of its place), and all exact matches with their places. Map only."""
    return map_texts(docs, [id_col], text_col, ADDED, matcher(_broadcast(docs, items, item_id, item_text), size, slop))


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                      size: int = 10) -> DataFrame:
    """The whole rows of documents in which no test window occurs. Map only."""
    inner = matcher(_broadcast(docs, items, item_id, item_text), size, 0)

    def setup():
        fn = inner()
        return lambda texts: {"keep": [n == 0 for n in fn(texts)["n_hit"]]}

    return map_whole_rows(docs, text_col, setup)
