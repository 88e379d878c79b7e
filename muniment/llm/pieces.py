"""SentencePiece encoding and decoding: one pass of an Aho-Corasick automaton over the pieces drives the best-path search.

At each character the automaton's state names the longest piece that ends there, and the output links name all shorter
ones; each of them relaxes the best score of the place behind that character. The path with the greatest sum of the
model's scores wins; of equal paths the one whose last piece is longer. A character that no single piece holds may be
left to the byte tokens, at the least score of any piece less ``UNKNOWN_PENALTY``.

Blanks are written as ``▁``, with one in front of the text. No piece of the model holds a ``▁`` behind another
character (checked when it is loaded), and no piece holds a line feed, so the best path of a text is made of the best paths of its words: each
distinct word is encoded once and remembered within a bound. A ``▁`` in the text itself goes to byte tokens, so that decoding gives back every text.

Defined results: null and empty texts have no tokens and decode to an empty text; equal rows get equal results; an empty
table gives an empty result; a text of one long word is encoded whole, in time linear in its length.
"""

from __future__ import annotations

import re
from array import array
from collections import deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from muniment.llm.common import map_texts, map_whole_rows

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN_PENALTY = 10.0
#: Words remembered by a task before its memory starts anew; bounds memory, never changes a result.
WORDS_KEPT = 3 << 18

_SPACE = "▁"


class Automaton:
    """Trie of the pieces with failure and output links; edges are keyed by state and code point."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        self.edge: dict[int, int] = {}
        self.piece: list[tuple[int, float, int] | None] = [None]
        children: list[list[tuple[int, int]]] = [[]]
        for text, score, number in pieces:
            state = 0
            for c in map(ord, text):
                key = state << 21 | c
                if key not in self.edge:
                    self.edge[key] = len(self.piece)
                    children[state].append((c, len(self.piece)))
                    self.piece.append(None)
                    children.append([])
                state = self.edge[key]
            self.piece[state] = (len(text), score, number)
        self.fail = [0] * len(self.piece)
        self.output = [0] * len(self.piece)
        queue = deque(s for _, s in children[0])
        while queue:
            state = queue.popleft()
            back = self.fail[state]
            self.output[state] = back if self.piece[back] else self.output[back]
            for c, child in children[state]:
                at = back
                while at and at << 21 | c not in self.edge:
                    at = self.fail[at]
                self.fail[child] = self.edge.get(at << 21 | c, 0)
                queue.append(child)

    def step(self, state: int, c: int) -> int:
        edge, key = self.edge, state << 21 | c
        while key not in edge:
            if not state:
                return 0
            state = self.fail[state]
            key = state << 21 | c
        return edge[key]


class Model:
    """Pieces, scores and byte tokens of a SentencePiece file with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        file = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(file.vocab_size())
        plain = [i for i in every if not (file.is_byte(i) or file.is_control(i) or file.is_unknown(i) or file.is_unused(i))]
        pieces = [(file.id_to_piece(i), float(file.get_score(i)), i) for i in plain]
        if any(_SPACE in p.lstrip(_SPACE) or "\n" in p for p, _, _ in pieces):
            raise ValueError("a piece crosses words; this model can't be encoded word by word")
        self.byte = {int(file.id_to_piece(i)[1:-1], 16): i for i in every if file.is_byte(i)}
        if len(self.byte) < 256:
            raise ValueError("the model has no byte tokens")
        self.automaton = Automaton(pieces)
        self.single = {p for p, _, _ in pieces if len(p) == 1}
        self.unknown = min(s for _, s, _ in pieces) - UNKNOWN_PENALTY
        self.bytes_of = [b""] * len(every)
        for p, _, i in pieces:
            self.bytes_of[i] = p.replace(_SPACE, " ").encode()
        for b, i in self.byte.items():
            self.bytes_of[i] = bytes([b])

    def as_bytes(self, char: str) -> list[int]:
        return [self.byte[b] for b in char.encode("utf-8", "surrogatepass")]

    def best_path(self, word: str) -> list[int]:
        """Tokens of a word in which blanks are written as ``▁``."""
        machine, n = self.automaton, len(word)
        piece, output = machine.piece, machine.output
        score, back = [0.0] * (n + 1), [None] * (n + 1)
        state = 0
        for end, c in enumerate(word, 1):
            state = machine.step(state, ord(c))
            best, arc = None, None
            at = state if piece[state] else output[state]
            while at:
                length, value, number = piece[at]
                value += score[end - length]
                if best is None or value > best:
                    best, arc = value, (length, number)
                at = output[at]
            if c not in self.single and (best is None or score[end - 1] + self.unknown > best):
                best, arc = score[end - 1] + self.unknown, (1, -1)
            score[end], back[end] = best, arc
        tokens: list[int] = []
        while n:
            length, number = back[n]
            if number >= 0:
                tokens.append(number)
            else:
                tokens += self.as_bytes(word[n - 1])[::-1]
            n -= length
        return tokens[::-1]


class Memory(dict):
    """Number of each word met; its tokens are computed when it is first asked for."""

    def __init__(self, coder: Coder, prefix: str):
        self.coder, self.prefix = coder, prefix

    def __missing__(self, word: str) -> int:
        self[word] = n = self.coder.add(self.prefix + word)
        return n


class Coder:
    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.tokens, self.ends = array("i"), array("q")
        self.spaced, self.bare, self.other = Memory(self, _SPACE), Memory(self, ""), Memory(self, "")
        self.line_feed, self.own_mark = self.put(self.model.as_bytes("\n")), self.put(self.model.as_bytes(_SPACE))

    def add(self, chunk: str) -> int:
        return self.put(self.model.best_path(chunk))

    def put(self, tokens: list[int]) -> int:
        self.tokens.extend(tokens)
        self.ends.append(len(self.tokens))
        return len(self.ends) - 1

    def words(self, text: str) -> list[int]:
        """Numbers of the chunks that make up a text; a ``▁`` of its own stands for itself, as bytes."""
        out: list[int] = []
        for i, part in enumerate(text.split(_SPACE)):
            out += [self.own_mark, *self.plain(part, False)] if i else self.plain(part, True)
        return out

    def plain(self, text: str, first: bool) -> list[int]:
        """As ``words``, for a text without ``▁``; ``first`` puts the blank in front."""
        out, start = [], True
        for line in text.split("\n"):
            if not start:
                out.append(self.line_feed)
            if "  " in line or line[:1] == " " or line[-1:] == " ":
                whole = (_SPACE if first else "") + line.replace(" ", _SPACE)
                out += map(self.other.__getitem__, _CHUNK.findall(whole))
            else:
                parts = line.split(" ")
                if first:
                    out += map(self.spaced.__getitem__, parts)
                elif line:
                    out.append(self.bare[parts[0]])
                    out += map(self.spaced.__getitem__, parts[1:])
            first = start = False
        return out

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all texts end to end, and where each text begins and ends."""
        if len(self.ends) > WORDS_KEPT:
            self.clear()
        numbers = [self.words(t.decode("utf-8", "replace")) if t else [] for t in texts]
        ends = np.array(self.ends, np.int64)
        flat, tokens = np.fromiter((n for x in numbers for n in x), np.int64, sum(map(len, numbers))), np.array(self.tokens, np.int32)
        sizes = np.diff(ends, prepend=0)[flat]
        out_ends = np.cumsum(sizes)
        total = int(out_ends[-1]) if len(flat) else 0
        ids = tokens[np.repeat(ends[flat] - out_ends, sizes) + np.arange(total)]
        marks = np.concatenate([[0], out_ends])[np.concatenate([[0], np.cumsum([len(x) for x in numbers])]).astype(np.int64)]
        return ids, marks


_CHUNK = re.compile(f"{_SPACE}*[^{_SPACE}]+|{_SPACE}+")


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    return Coder(Model(path))


def decode(model: Model, ids: list[int]) -> bytes:
    """The text of a list of tokens: pieces and bytes end to end, less the blank put in front."""
    return b"".join(map(model.bytes_of.__getitem__, ids))[1:]


ENCODED = "n_tokens long, n_byte_tokens long, ids array<int>, round_trip boolean"


def _encoder(path: str):
    def setup():
        c = coder(path)
        is_byte = np.zeros(len(c.model.bytes_of), bool)
        is_byte[list(c.model.byte.values())] = True

        def fn(texts: list[bytes]) -> dict:
            ids, marks = c.encode(texts)
            listed = ids.tolist()
            places = marks.tolist()
            byte_tokens = np.concatenate([[0], np.cumsum(is_byte[ids])])[marks]
            same = [decode(c.model, listed[a:b]) == t for t, a, b in zip(texts, places, places[1:])]
            return {"n_tokens": np.diff(marks), "n_byte_tokens": np.diff(byte_tokens), "round_trip": same,
                    "ids": pa.ListArray.from_arrays(pa.array(marks, pa.int32()), pa.array(ids, pa.int32()))}

        return fn

    return setup


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pieces: str = PIECES) -> DataFrame:
    """Per document: its id, tokens, how many of them are bytes, and whether they decode to the text. Map only."""
    return map_texts(docs, [id_col], text_col, ENCODED, _encoder(pieces))


def add_tokens(docs: DataFrame, text_col: str = "text", pieces: str = PIECES) -> DataFrame:
    """Whole rows with the columns ``ENCODED`` at the end, in place of columns of these names. Map only."""
    names = [f.split()[0] for f in ENCODED.split(", ")]
    return map_whole_rows(docs.drop(*names), text_col, _encoder(pieces), added=ENCODED)


def decode_texts(rows: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", pieces: str = PIECES) -> DataFrame:
    """Per row: its id and the text of its tokens (null tokens: empty text). Map only."""
    from collections.abc import Iterator

    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    schema = T.StructType([rows.schema[id_col], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = coder(pieces).model
        for batch in batches:
            texts = [decode(model, x or []).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=schema.names)

    return rows.select(F.col(f"`{id_col}`").alias("k"), F.col(f"`{ids_col}`").alias("v")).mapInArrow(run, schema)
