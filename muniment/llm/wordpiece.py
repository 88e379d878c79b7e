"""Token counts by a linear longest-match automaton.

Greedy longest match cuts a word at the longest piece of the vocabulary that begins it, then goes on behind it. Every state
of the vocabulary's trie knows how many pieces are cut off ("popped") when its string can grow no further, and the
state that holds what is left; both are worked out once, breadth first. A word is then read once, byte by byte, and only counts
are added: no piece is built and no byte is read twice.

Words: the text in NFC and lower case, cut by the pattern of the vocabulary's file, each with the word-end mark as one more symbol behind its bytes. Pieces: the entries of the file
as bytes, with the mark where they have it, so a piece with the mark fits at the end of a word only. Where the longest piece takes a word's last byte but not its mark, the mark counts as
a token of its own. A word that pieces can't cover counts as one unknown token.

Defined results: null and empty texts have no words; equal rows get equal results; an empty table gives an empty result; a
text of one long word takes time linear in its length.
"""

from __future__ import annotations

import json
import unicodedata
from collections import deque
from collections.abc import Iterable, Sequence
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from muniment.llm.common import map_texts

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
#: The symbol behind the last byte of a word.
END = 256
#: Words remembered by a task before its memory starts anew; bounds memory, never changes a result.
WORDS_KEPT = 1 << 18

ADDED = "n_words long, n_tokens long, n_unknown long"


class LongestMatch:
    """Trie with failure links and popped-piece counts. A state without a link can't be left: the word is unknown."""

    def __init__(self, pieces: Iterable[Sequence[int]]):
        self.edge: dict[int, int] = {}
        final, children = [False], [[]]
        for piece in pieces:
            state = 0
            for b in piece:
                key = state << 9 | b
                if key not in self.edge:
                    self.edge[key] = len(final)
                    children[state].append((b, len(final)))
                    final.append(False)
                    children.append([])
                state = self.edge[key]
            final[state] = state != 0
        self.link: list[int | None] = [None] * len(final)
        self.popped = [0] * len(final)
        queue = deque([0])
        while queue:
            state = queue.popleft()
            for b, child in children[state]:
                if final[child]:
                    self.link[child], self.popped[child] = 0, 1
                else:
                    at, count = self.link[state], self.popped[state]
                    while at is not None and at << 9 | b not in self.edge:
                        count += self.popped[at]
                        at = self.link[at]
                    if at is not None:
                        self.link[child], self.popped[child] = self.edge[at << 9 | b], count
                queue.append(child)

    def count(self, word: Iterable[int]) -> int | None:
        """Pieces of the word, None if it is unknown."""
        edge, link, popped = self.edge, self.link, self.popped
        state, n = 0, 0
        for b in word:
            key = state << 9 | b
            while key not in edge:
                n += popped[state]
                state = link[state]
                if state is None:
                    return None
                key = state << 9 | b
            state = edge[key]
        while state:
            n += popped[state]
            state = link[state]
            if state is None:
                return None
        return n


def byte_of_sign() -> dict[str, int]:
    """The bytes for the signs by which byte-level vocabulary files write them: visible Latin-1 signs stand for themselves, the rest
    for the code points from 256 on, in order."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Counter(dict):
    """(words, tokens, unknown) of each blank-free part of a text, packed in one number."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        sign = byte_of_sign()
        end = file["model"].get("end_of_word_suffix") or ""
        special = {t["content"] for t in file["added_tokens"]}
        names = [p for p in file["model"]["vocab"] if p not in special]
        pieces = ((*map(sign.__getitem__, p.removesuffix(end) if end else p), *([END] if end and p.endswith(end) else [])) for p in names)
        # A mark left over is a piece of its own; a vocabulary without marks has no use for the symbol.
        self.tail = [END] if end else []
        self.machine = LongestMatch([*filter(None, pieces), *([(END,)] if end else [])])
        self.pattern = regex.compile(file["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])

    def measure(self, part: str) -> tuple[int, int, int]:
        part = unicodedata.normalize("NFC", part)
        part = part.lower() if part.isascii() else "".join(c.lower() for c in part)
        counts = [self.machine.count([*w.encode(), *self.tail]) for w in self.pattern.findall(part)]
        return len(counts), sum(1 if n is None else n for n in counts), sum(n is None for n in counts)

    def __missing__(self, part: bytes) -> tuple[int, int, int]:
        self[part] = found = self.measure(part.decode("utf-8", "replace"))
        return found


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Per document: its id, words, tokens and unknown words. Map only."""

    def setup():
        memory = counter(vocabulary)

        def fn(texts: list[bytes]) -> dict:
            if len(memory) > WORDS_KEPT:
                memory.clear()
            sums = [np.array(list(map(memory.__getitem__, t.split())), np.int64).reshape(-1, 3).sum(axis=0).tolist() for t in texts]
            return dict(zip(("n_words", "n_tokens", "n_unknown"), map(list, zip(*sums))))

        return fn

    return map_texts(docs, [id_col], text_col, ADDED, setup)
