"""Periodic runs of words: stretches that repeat themselves at least three times, and texts with each run collapsed to its first period.

For every text the words are appended one by one. All prefixes of the words are states of a suffix automaton, and the suffix links make a tree in which the
path from a prefix's state to the root holds all suffixes of that prefix. On this tree a link-cut structure keeps, as its preferred paths, the states
that share the place where they last ended. The access of prefix i walks up these paths: a path segment with last end e and longest suffix L tells that the
L words up to i also end at e, and at no place between. If d = i - e <= L this is a square of period d; with the L words it reaches d further back, so
the repetition has L + d words, cannot be extended to the left, and d is its least period (a smaller one would have left a later end). It is a whole run if the next
word does not continue it. The access then recolours the path with i. An append costs amortised O(log n) segments.

Only parts of a text that can hold a run are given to the automaton: a run of n >= max(min_words, times * period) words holds grams of
min_words - min_words // times words that occur again one period later, and these cover it. So words outside of repeated grams
(compared by 64-bit sums, where a collision can only let more through) need no automaton, and each run lies in one covered part with the neighbours that end it.

Defined results: a null or empty text has no words and no run; equal rows get equal results; rows are not compared with each other, ids may be null
or repeat; an empty table gives no rows. Memory grows with one text: about 0.4 KB for each word inside of repeated grams. Map only.
"""

from __future__ import annotations

import hashlib
from array import array
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muniment.llm.common import map_texts

ADDED = (
    "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, "
    "runs array<struct<start:long,length:long,period:long>>, n_words long, n_kept long"
)

_BASE = 0x9E3779B97F4A7C15 | 1


class Links:
    """Suffix links of the automaton of a word sequence: ``parent`` and ``length`` of each state, and the state of each prefix."""

    def __init__(self, words: list[int]):
        size = 2 * len(words) + 1
        length, link = array("q", bytes(8 * size)), array("q", bytes(8 * size))
        # Most states have one way on; only the others get a dictionary.
        first_word, first_to, more = array("q", [-1]) * size, array("q", bytes(8 * size)), {}
        link[0], n, last, prefix = -1, 1, 0, array("q")

        def step(state: int, word: int) -> int:
            if first_word[state] == word:
                return first_to[state]
            return more[state].get(word, -1) if state in more else -1

        def put(state: int, word: int, to: int) -> None:
            if first_word[state] in (-1, word):
                first_word[state], first_to[state] = word, to
            else:
                more.setdefault(state, {})[word] = to

        for word in words:
            new, n = n, n + 1
            length[new] = length[last] + 1
            p = last
            while p != -1 and (q := step(p, word)) == -1:
                put(p, word, new)
                p = link[p]
            if p == -1:
                link[new] = 0
            elif length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone, n = n, n + 1
                length[clone], link[clone] = length[p] + 1, link[q]
                first_word[clone], first_to[clone] = first_word[q], first_to[q]
                if q in more:
                    more[clone] = dict(more[q])
                while p != -1 and step(p, word) == q:
                    put(p, word, clone)
                    p = link[p]
                link[q] = link[new] = clone
            prefix.append(new)
            last = new
        self.length, self.parent, self.prefix, self.n = length, link, prefix, n


class LastEnds:
    """Link-cut trees over the states: each preferred path is a splay tree by depth and holds the last end of its states."""

    def __init__(self, links: Links):
        n = links.n
        self.length = links.length
        # Node x + 1 stands for state x, so that 0 means none. At first each state is a path of its own, without an end.
        self.up = array("q", [0, *(p + 1 for p in links.parent[:n])])
        self.left, self.right, self.end = array("q", bytes(8 * n + 8)), array("q", bytes(8 * n + 8)), array("q", [-1]) * (n + 1)

    def _splay(self, x: int) -> None:
        """Bring x to the top of its path's tree; the path's end stands at the top and goes along."""
        up, left, right, end = self.up, self.left, self.right, self.end
        while (p := up[x]) and (left[p] == x or right[p] == x):
            g = up[p]
            inner = bool(g) and (left[g] == p or right[g] == p)
            turns = ((p, x) if (left[g] == p) == (left[p] == x) else (x, x)) if inner else (x,)
            for y in turns:
                q = up[y]
                over = up[q]
                if left[q] == y:
                    child = left[q] = right[y]
                    right[y] = q
                else:
                    child = right[q] = left[y]
                    left[y] = q
                if child:
                    up[child] = q
                up[q], up[y] = y, over
                if over:
                    if left[over] == q:
                        left[over] = y
                    elif right[over] == q:
                        right[over] = y
                end[y] = end[q]

    def access(self, state: int, now: int) -> list[tuple[int, int]]:
        """(longest suffix, last end) of each path segment from the state up to the root, which then all end at ``now``."""
        up, right, end, length = self.up, self.right, self.end, self.length
        found, below, x = [], 0, state + 1
        while x:
            self._splay(x)
            if end[x] >= 0 and length[x - 1]:
                found.append((length[x - 1], end[x]))
            if right[x]:
                end[right[x]] = end[x]  # the part further down becomes a path of its own and keeps its end
            right[x] = below
            end[x] = now
            below, x = x, up[x]
        self._splay(state + 1)
        return found


def find_runs(words: list[int], min_words: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a word sequence, by start and period."""
    links = Links(words)
    ends, out, n = LastEnds(links), [], len(words)
    for i in range(n):
        for longest, e in ends.access(links.prefix[i], i):
            d = i - e
            if d <= longest and longest + d >= max(min_words, times * d) and (i + 1 == n or words[i + 1] != words[i + 1 - d]):
                out.append((i + 1 - longest - d, longest + d, d))
    return sorted(out, key=lambda r: (r[0], r[2]))


def _covered(words: np.ndarray, of: np.ndarray, gram: int) -> np.ndarray:
    """Which words lie in a gram that occurs twice or more in their text; ``of`` is the text of each word."""
    n = len(words)
    mask = np.zeros(n, bool)
    if n < gram:
        return mask
    with np.errstate(over="ignore"):
        values = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        values ^= values >> np.uint64(29)
        values *= np.uint64(0x94D049BB133111EB)
        values ^= values >> np.uint64(32)
        hashes = np.zeros(n - gram + 1, np.uint64)
        for j in range(gram):
            hashes = hashes * np.uint64(_BASE) + values[j : n - gram + 1 + j]
        hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(_BASE) + of[: n - gram + 1].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    inside = np.flatnonzero(of[: n - gram + 1] == of[gram - 1 :])
    keys = hashes[inside]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(n + 1, np.int64)
    starts = inside[twice]
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + gram, -1)
    return np.cumsum(edges[:-1]) > 0


def _measure(texts: list[bytes], min_words: int, times: int) -> dict[str, list]:
    split = [t.split() for t in texts]
    index: dict[bytes, int] = {}
    flat = np.fromiter((index.setdefault(w, len(index)) for w in chain.from_iterable(split)), np.int64)
    counts = np.array([len(w) for w in split], np.int64)
    of = np.repeat(np.arange(len(split)), counts)
    first = np.cumsum(counts) - counts
    covered = _covered(flat, of, max(1, min_words - min_words // times))
    # Covered parts: neighbours in one text.
    at = np.flatnonzero(covered)
    breaks = np.flatnonzero((np.diff(at) != 1) | (np.diff(of[at]) != 0)) + 1
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for part in np.split(at, breaks) if len(at) else []:
        if len(part) >= min_words:
            doc = int(of[part[0]])
            offset = int(part[0] - first[doc])
            _, small = np.unique(flat[part], return_inverse=True)
            runs[doc] += [(s + offset, n, p) for s, n, p in find_runs(small.tolist(), min_words, times)]
    out: dict[str, list] = {name: [] for name in ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs", "n_words", "n_kept")}
    for words, found in zip(split, runs):
        found.sort(key=lambda r: (r[0], r[2]))
        best = None
        for r in found:
            if best is None or r[1] * best[2] > best[1] * r[2]:
                best = r
        kept = words
        if found:
            edges = np.zeros(len(words) + 1, np.int64)
            for s, n, p in found:
                edges[s + p] += 1
                edges[s + n] -= 1
            kept = [w for w, inside in zip(words, (np.cumsum(edges[:-1]) > 0).tolist()) if not inside]
        row = (
            len(found), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in found).encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest(),
            [{"start": s, "length": n, "period": p} for s, n, p in found], len(words), len(kept),
        )
        for values, value in zip(out.values(), row):
            values.append(value)
    return out


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 24, times: int = 3) -> DataFrame:
    """Per document: its id, ``n_runs``, ``start``, ``length``, ``period`` and ``exponent_milli`` of the run with the greatest length / period (ties: least
    start, then period), digests of all runs and of the collapsed text, then all ``runs``, ``n_words`` and ``n_kept``.

    A run is a maximal stretch of words with least period p and at least max(``min_words``, ``times`` * p) words; ``times`` is 2 or more.
    """
    if times < 2 or min_words < times:
        raise ValueError("times has to be at least 2 and min_words at least times")
    return map_texts(docs, [id_col], text_col, ADDED, lambda: lambda texts: _measure(texts, min_words, times))


def repeat_tails(text: Column, key: Column, one_in: int = 10) -> Column:
    """The text, or where crc32 of the key in decimal is divisible by ``one_in`` its words with a tail of them in periodic repetition.

    With h the checksum, g = h // 10 and n words, word i from a = g % n on becomes word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8).
    """
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))

    def tailed(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (F.floor((n - a) / (F.lit(3) + g % 8)) + 1).cast("int")
        times = F.ceil((n - a) / p).cast("int")
        return F.when(n > 0, F.concat_ws(" ", F.slice(w, 1, a), F.slice(F.flatten(F.array_repeat(F.slice(w, a + 1, p), times)), 1, n - a))).otherwise("")

    # The words are bound to a variable, so a text is split once.
    return F.when((h % one_in == 0) & text.isNotNull(), F.transform(F.array(words), tailed)[0]).otherwise(text)
