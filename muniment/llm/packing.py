"""Harmonic packing of token sequences: every document is cut into pieces, and pieces of one length class fill bins of that class.

A piece of r tokens belongs to class k = capacity // r, whose bins take exactly k pieces. A document gives whole bins first; what is left is kept whole if
a bin of its class would be at most ``slack`` padding, else the largest power of two is cut off (its class pads nothing) and the rest is looked at
again. Each task fills the bins of its own rows, class by class, without a look at any other task; a bin is given out once it has its k pieces.

What a task has left over is less than one bin for each class. These pieces are numbered per class from counts by (task, class) and fill further bins. Last, of each
class less than one bin remains in the whole table: such pieces of inexact classes are cut into powers of two, and the pieces of each exact class are dealt
into bins whose lengths are powers of two, which need no padding. So nothing grows in one task but counts, one row for each (task, class).

The pieces are written once before the numbers are counted, so that a lost executor cannot change a layout half-way.

Defined results: a null text counts as empty, an empty document is its end token alone; equal rows are packed each on its own; rows are told
apart by position and not by id, so ids may be null or repeat; an empty table gives no rows. Which sequence a piece gets depends on how the table is split into tasks.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from muniment.llm.common import raw_texts, slices, small_batches
from muniment.llm.wordpiece import byte_of_sign
from muniment.operators.spread import running_sum
from muniment.session import stage

VOCABULARY = "word_bpe_49k.json"

#: Words whose ids a task remembers; beyond that it starts anew. Never changes a result.
WORDS_KEPT = 3 << 18

#: No part of a text: text is split at blanks, so this stands for the end of a document.
_END = b" "

#: Where numbers of sequences begin: those of tasks are task << 32 | n, so less than this.
_GLOBAL, _EXACT, _LAST = 1 << 59, 1 << 60, 1 << 61

_PIECES = "start long, length long, ids_crc32 long, doc_tokens long, k int, exact boolean, sequence_id long, offset long, part int, at long, ids binary"


def vocabulary_path(name: str) -> str:
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class _Numbers(dict):
    """Numbers of words; one not met before gets the next number and is noted, so a text's words are looked up once."""

    def __init__(self, words: dict[bytes, int]):
        super().__init__(words)
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


class WordIds:
    """Token ids of whole texts by ``tokenizers``, each blank-free part encoded once.

    No token of this vocabulary spans ASCII white space, and neither normal form nor lower case looks across it, so parts can be encoded on their own.
    """

    def __init__(self, path: str, end: int):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.end = Tokenizer.from_file(path), end
        self.model, self.signs = self.tokenizer.model, {b: sign for sign, b in byte_of_sign().items()}
        self.clear()

    def clear(self) -> None:
        self.index, self.first, self.pool = _Numbers({_END: 0}), array("q", [0, 1]), array("I", [self.end])

    def _plain(self, word: bytes, learned: int, fresh: list[list[int] | None]) -> list[int] | None:
        """Ids of a word of Latin letters, or one with a full stop or comma behind them: one word of the vocabulary's pattern, so the library's model needs no other step.

        ``fresh`` has the ids of words numbered from ``learned`` on, as far as they are known.
        """
        stem, behind = (word[:-1], "." if word[-1] == 46 else ",") if word[-1] in b".," else (word, "")
        if stem.isalpha():
            stem = stem.lower()
            written = stem.decode("ascii")
        elif stem.isascii():
            return None
        else:
            text = stem.decode("utf-8", "replace")
            if not text.isalpha() or max(text) >= "\u0180":
                return None
            # None of these letters is lower-cased by what stands beside it.
            text = unicodedata.normalize("NFC", text).lower()
            if not text.isalpha():
                return None
            stem = text.encode()
            written = stem.decode("latin-1").translate(self.signs)
        at = self.index.get(stem, -1)
        ids = None
        if 0 <= at < learned:
            ids = self.pool[self.first[at] : self.first[at + 1]].tolist()
        elif 0 <= at - learned < len(fresh):
            ids = fresh[at - learned]
        if ids is None:
            ids = [t.id for t in self.model.tokenize(written)]
        return ids + [t.id for t in self.model.tokenize(behind)] if behind else ids

    def _learn(self) -> None:
        """Ids of the words that were met for the first time, in the order of their numbers."""
        learned, fresh = len(self.first) - 1, []
        for word in self.index.new:
            fresh.append(self._plain(word, learned, fresh))
        odd = [i for i, ids in enumerate(fresh) if ids is None]
        for some in (odd[i : i + 4096] for i in range(0, len(odd), 4096)):
            words = [self.index.new[i].decode("utf-8", "replace") for i in some]
            for i, e in zip(some, self.tokenizer.encode_batch_fast(words, add_special_tokens=False)):
                fresh[i] = e.ids
        self.first.extend(islice(accumulate(map(len, fresh), initial=len(self.pool)), 1, None))
        self.pool.extend(chain.from_iterable(fresh))
        self.index.new.clear()

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each with the end id behind it, and the borders of the texts."""
        words = [[*t.split(), _END] for t in texts]
        borders = np.cumsum([0, *map(len, words)])
        flat = list(chain.from_iterable(words))
        at = np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))
        if len(self.index) > WORDS_KEPT and len(self.index.new) < len(self.index) - 1:
            self.clear()
            at = np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))
        if self.index.new:
            self._learn()
        first, pool = np.frombuffer(self.first, np.int64), np.frombuffer(self.pool, np.uint32)
        sizes = first[at + 1] - first[at]
        ends = np.cumsum(sizes)
        ids = pool[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[at] - (ends - sizes), sizes)]
        return ids, np.concatenate([[0], ends])[borders]


@lru_cache(maxsize=2)
def _encoder(path: str, end: int) -> WordIds:
    return WordIds(path, end)


@lru_cache(maxsize=1 << 16)
def cuts(left: int, capacity: int, slack: float) -> tuple[tuple[int, int, bool], ...]:
    """(length, k, exact) of the pieces for fewer than ``capacity`` tokens, in their order."""
    out = []
    while left:
        k, power = capacity // left, 1 << (left.bit_length() - 1)
        exact = k * left == capacity and left == power
        if exact or (slack > 0 and capacity - k * left <= slack * capacity):
            out.append((left, k, exact))
            break
        out.append((power, capacity // power, capacity % power == 0))
        left -= power
    return tuple(out)


def _packed(fields: T.StructType, encode, id_at: int, text_at: int, capacity: int, slack: float, batches: Iterator[pa.RecordBatch]):
    """Pieces of a task's rows; those of a full bin have a sequence, the others their ids where they may be cut again."""
    part, n_bins = TaskContext.get().partitionId(), 0
    open_bins: dict[tuple[int, bool], list[tuple]] = {}
    types = [to_arrow_type(f.dataType) for f in fields]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=fields.names)

    for batch in batches:
        for some in slices(batch, text_at):
            rows = []
            ids, borders = encode(raw_texts(some.column(text_at)))
            for doc, a, b in zip(some.column(id_at).to_pylist(), borders.tolist(), borders[1:].tolist()):
                whole, left = divmod(b - a, capacity)
                at = a
                for length, k, exact in chain([(capacity, 1, True)] * whole, cuts(left, capacity, slack)):
                    piece = ids[at : at + length].tobytes()
                    key = (k, exact)
                    filled = open_bins.setdefault(key, [])
                    filled.append((doc, at - a, length, zlib.crc32(piece), b - a, k, exact, piece))
                    at += length
                    if len(filled) == k:
                        offset = 0
                        for d, start, n, crc, total, *_ in filled:
                            rows.append((d, start, n, crc, total, k, exact, part << 32 | n_bins, offset, part, None, None))
                            offset += n
                        n_bins += 1
                        filled.clear()
            if rows:
                yield table(rows)
    yield table([(*p[:7], None, None, part, i, None if p[6] else p[7]) for filled in open_bins.values() for i, p in enumerate(filled)])


def _recut(fields: T.StructType, capacity: int, batches: Iterator[pa.RecordBatch]):
    """Pieces of inexact classes cut into powers of two."""
    types = [to_arrow_type(f.dataType) for f in fields]
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            at = 0
            for length, k, _ in cuts(r["length"], capacity, 0.0):
                piece = r["ids"][4 * at : 4 * (at + length)]
                rows.append((r["doc"], r["start"] + at, length, zlib.crc32(piece), r["doc_tokens"], k, r["from_k"], r["nth"]))
                at += length
        columns = list(zip(*rows)) or [()] * len(types)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=fields.names)


def _numbered(pieces: DataFrame) -> DataFrame:
    """``nth`` of each piece in its class and the class's ``total``, from counts by task."""
    counts = pieces.groupBy("k", "part").agg(F.count(F.lit(1)).alias("n"))
    before = running_sum(counts, ["k"], ["part"], "n", F.floor(F.col("part") / 1024), "upto", "total")
    return pieces.join(before.select("k", "part", (F.col("upto") - F.col("n")).alias("base"), "total"), ["k", "part"]).withColumn("nth", F.col("base") + F.col("at"))


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, slack: float = 1 / 64, vocabulary: str = VOCABULARY, end: int = 1,
) -> DataFrame:
    """Per piece: the document's id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``, and ``class_size`` (pieces of its class in a full bin).

    ``capacity`` has to be a power of two.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity has to be a power of two")
    kind = docs.schema[id_col].dataType
    fields = T.StructType([T.StructField("doc", kind), *T.StructType.fromDDL(_PIECES).fields])
    inner = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").cast("string").alias("t"))

    def run(batches):
        return _packed(fields, _encoder(vocabulary_path(vocabulary), end).encode, 0, 1, capacity, slack, batches)

    pieces = stage(small_batches(inner).mapInArrow(run, fields), "pieces")
    out = ["doc", "start", "length", "ids_crc32", "doc_tokens", "k", "sequence_id", "offset"]
    done, rest = pieces.where("sequence_id IS NOT NULL").select(out), pieces.where("sequence_id IS NULL")

    # Inexact classes: further full bins; what is left, less than a bin of each class, is cut again.
    inexact = stage(_numbered(rest.where("NOT exact")), "inexact")
    full = inexact.where("nth < total - total % k").withColumn("bin", F.floor(F.col("nth") / F.col("k")))
    placed = running_sum(full, ["k", "bin"], ["nth"], "length", None, "upto", "filled")
    placed = placed.withColumn("sequence_id", F.lit(_GLOBAL) + F.shiftleft(F.col("k").cast("long"), 40) + F.col("bin")).withColumn("offset", F.col("upto") - F.col("length"))

    small = T.StructType([fields["doc"], *T.StructType.fromDDL("start long, length long, ids_crc32 long, doc_tokens long, k int, from_k int, nth long").fields])
    tail = inexact.where("nth >= total - total % k").select("doc", "start", "length", "doc_tokens", "ids", F.col("k").alias("from_k"), "nth")
    again = tail.mapInArrow(lambda batches: _recut(small, capacity, batches), small)
    # At most one bin's pieces for each class, so a bounded group, whatever the table's size.
    again = running_sum(again.withColumn("one", F.lit(1)), ["k"], ["from_k", "nth", "start"], "one", None, "upto", "n")
    columns = ["doc", "start", "length", "ids_crc32", "doc_tokens", "k", "part", "at"]
    again = again.withColumn("part", F.lit(-1)).withColumn("at", (F.col("upto") - 1).cast("long")).select(columns)

    # Exact classes: full bins, then bins of a power of two pieces each, by the binary digits of the number left.
    exact = _numbered(stage(rest.where("exact").select(columns).unionByName(again), "exact"))
    left, nth = F.col("total") % F.col("k"), F.col("nth")
    j = nth - (F.col("total") - left)
    digit = F.floor(F.log2((j.bitwiseXOR(left)).cast("double"))).cast("int")
    key = F.shiftleft(F.col("k").cast("long"), 40)
    exact = exact.withColumn("last", j >= 0).withColumn("digit", digit).select(
        "*", F.when(F.col("last"), j.bitwiseAND(F.expr("shiftleft(1L, digit) - 1"))).otherwise(nth % F.col("k")).alias("slot"))
    exact = exact.withColumn("sequence_id", F.when(F.col("last"), F.lit(_LAST) + key + F.col("digit")).otherwise(F.lit(_EXACT) + key + F.floor(nth / F.col("k"))))
    exact = exact.withColumn("offset", F.col("slot") * F.col("length"))

    packed = done.unionByName(placed.select(out)).unionByName(exact.select(out))
    return packed.select(F.col("doc").alias(id_col), *out[1:5], F.col("sequence_id").cast("long").alias("sequence_id"), F.col("offset").cast("long").alias("offset"), F.col("k").alias("class_size"))
