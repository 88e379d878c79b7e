"""Quality rules: word and line counts, and how well a public vocabulary fits the text (tokeniser fertility).

A text in a language or script that a vocabulary knows needs few tokens for its characters, hardly any
byte tokens, and uses many different tokens. Each of the three measures has a band per language (column ``lang``)
or, where the language is unknown, per script; a text outside a band is rejected. Measures are taken
from words encoded one by one, so a bounded memory of words makes each distinct word cost one encoding.

Defined results: a null or empty text has no words and fails the base rules; a null language goes by script; equal rows
get equal results; an empty table gives an empty result; columns besides the two named are not touched.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from muniment.llm.common import map_texts, map_whole_rows

PIECES = "/opt/tokenizers/piece_bpe_32k.model"

#: Words remembered by a task before its memory starts anew; bounds memory, never changes a result.
WORDS_KEPT = 1 << 17


@dataclass(frozen=True)
class Band:
    """Least and most characters per token, most byte-token share, least token entropy (bits, as a share of the
    most that a text of its length can have)."""

    least_chars: float
    most_chars: float
    most_bytes: float
    least_entropy: float


#: By language code, or script name where the language is unknown. Set so that over 99.9 % of the documents labelled good
#: in the given tables lie inside; byte tokens and low entropy mark garbled or machine-repeated text.
BANDS = {
    "en": Band(1.80, 6.0, 0.10, 0.40),
    "de": Band(1.80, 6.0, 0.10, 0.40),
    "fr": Band(1.60, 6.0, 0.10, 0.40),
    "es": Band(1.65, 6.0, 0.10, 0.40),
    "latin": Band(1.20, 7.0, 0.15, 0.35),
    "cyrillic": Band(1.00, 6.0, 0.25, 0.35),
    "cjk": Band(0.30, 3.0, 0.75, 0.30),
    "other": Band(0.20, 7.0, 1.00, 0.30),
}

ADDED = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, "
    "chars_per_token double, byte_share double, token_entropy double, base_failed boolean, kept boolean"
)

_BLANKS, _SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"


def script_of(text: bytes) -> str:
    """The script of most letters, by blocks of code points: latin, cyrillic, cjk or other."""
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    latin = ((points >= 0x41) & (points <= 0x5A)) | ((points >= 0x61) & (points <= 0x7A)) | ((points >= 0xC0) & (points < 0x250))
    cyrillic = (points >= 0x400) & (points < 0x530)
    cjk = ((points >= 0x3040) & (points < 0x3100)) | ((points >= 0x3400) & (points < 0xA000)) | ((points >= 0xAC00) & (points < 0xD7B0))
    rest = (points >= 0x250) & ~cyrillic & ~cjk & ~((points >= 0x2000) & (points < 0x2C00))
    counts = [int(x.sum()) for x in (latin, cyrillic, cjk, rest)]
    return ("latin", "cyrillic", "cjk", "other")[int(np.argmax(counts))] if any(counts) else "other"


def repeated_words(ids: np.ndarray) -> int:
    """Words inside 3-word windows that are found twice or more; exact, as windows are compared by their ids."""
    if len(ids) < 4:
        return 0
    if int(ids.max()) >= 1 << 21:
        ids = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    size = int(ids.max()) + 1
    if size < 1 << 21:
        key = (ids[:-2] * size + ids[1:-1]) * size + ids[2:]
    else:
        pair = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)[1].astype(np.int64)
        key = pair[:-1] * size + ids[2:]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    hit = np.zeros(len(ids), bool)
    for j in range(3):
        hit[j : j + len(key)] |= twice
    return int(hit.sum())


class Words(dict):
    """A number for each word; new words wait in ``new`` until they are encoded."""

    def __init__(self):
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class Fertility:
    """Tokens of every remembered word, laid end to end."""

    def __init__(self, path: str):
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.pieces.vocab_size()
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(size)])
        self.clear()

    def clear(self) -> None:
        self.words, self.tokens, self.starts = Words(), np.zeros(0, np.int32), np.zeros(1, np.int64)

    def number(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))

    def encode_new(self) -> None:
        if self.words.new:
            coded = self.pieces.encode([w.decode("utf-8", "replace") for w in self.words.new], num_threads=1)
            sizes = np.fromiter(map(len, coded), np.int64, len(coded))
            self.tokens = np.concatenate([self.tokens, np.fromiter((t for c in coded for t in c), np.int32, int(sizes.sum()))])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
            self.words.new = []

    def measure(self, ids: np.ndarray) -> tuple[int, int, float]:
        """Tokens, byte tokens and entropy share of a text given by its word numbers."""
        first, sizes = self.starts[ids], self.starts[ids + 1] - self.starts[ids]
        n = int(sizes.sum())
        if not n:
            return 0, 0, 0.0
        ends = np.cumsum(sizes)
        tokens = self.tokens[np.repeat(first - (ends - sizes), sizes) + np.arange(n)]
        counts = np.bincount(tokens)
        byte_tokens = int(counts[self.is_byte[: len(counts)].nonzero()[0]].sum())
        p = counts[counts > 0] / n
        return n, byte_tokens, float(-(p * np.log2(p)).sum() / np.log2(min(n, len(self.is_byte)))) if n > 1 else 0.0


@lru_cache(maxsize=2)
def fertility_of(path: str) -> Fertility:
    """One for each Python worker, so that its memory of words serves all the worker's tasks."""
    return Fertility(path)


def assess(path: str, bands: dict[str, Band]):
    """Function from texts and languages to the columns ``ADDED``."""
    fertility = fertility_of(path)

    def fn(texts: list[bytes], langs: list[str | None] | None = None) -> dict:
        out = {name.split()[0]: [] for name in ADDED.split(", ")}
        if len(fertility.words) > WORDS_KEPT:
            fertility.clear()
        numbered = [fertility.number(t.split()) for t in texts]
        fertility.encode_new()
        for text, ids, lang in zip(texts, numbered, langs or [None] * len(texts)):
            n = len(ids)
            chars = len(text.translate(None, _BLANKS).decode("utf-8", "replace"))
            lines = [x for x in text.split(b"\n") if x.strip()]
            repeat = repeated_words(ids)
            tokens, byte_tokens, entropy = fertility.measure(ids)
            per_token, share = (chars / tokens, byte_tokens / tokens) if tokens else (0.0, 0.0)
            failed = n < 50 or 100 * repeat > 50 * n
            band = bands.get(lang) or bands[script_of(text)]
            fits = band.least_chars <= per_token <= band.most_chars and share <= band.most_bytes and entropy >= band.least_entropy
            row = (n, chars, len(text) - len(text.translate(None, _SYMBOLS)), len(lines) - len(set(lines)), repeat, tokens,
                   per_token, share, entropy, failed, not failed and fits)
            for values, value in zip(out.values(), row):
                values.append(value)
        return out

    return fn


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  pieces: str = PIECES, bands: dict[str, Band] | None = None) -> DataFrame:
    """One row per document: its id and the columns ``ADDED``. Map only; ``lang_col`` may be absent."""
    return map_texts(docs, [id_col], text_col, ADDED, lambda: assess(pieces, bands or BANDS), use=[c for c in docs.columns if c == lang_col])


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", pieces: str = PIECES,
              bands: dict[str, Band] | None = None) -> DataFrame:
    """The whole rows of the documents that the rules keep. Map only."""

    def setup():
        fn = assess(pieces, bands or BANDS)
        return lambda texts, *langs: {"keep": fn(texts, *langs)["kept"]}

    return map_whole_rows(docs, text_col, setup, use=[c for c in docs.columns if c == lang_col])
