"""What the text operators share: bounded slices of Arrow batches, and a map over whole texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from muniment.session import small_batches

#: Bytes of text that a task works on at once; one longer text makes a slice of its own.
SLICE_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``limit`` bytes of the text in ``column``."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text; a null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def map_texts(
    df: DataFrame, keep: list[str], text_col: str, added: str, setup: Callable[[], Callable[..., dict]], use: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` as they are, and for each row those of the schema ``added``.

    ``setup`` runs once in each task (it loads vocabularies or automata) and returns a function from the texts of a
    slice, and the values of the columns ``use``, to a list or array for each added column. Columns are renamed on
    the way in, so input columns may have any name. No shuffle.
    """
    fields = T.StructType.fromDDL(added)
    schema = T.StructType([*(df.schema[c] for c in keep), *fields.fields])
    at, use = len(keep), use or []
    inner = df.select(
        *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text_col}`").cast("string").alias("t"),
        *[F.col(f"`{c}`").alias(f"u{i}") for i, c in enumerate(use)],
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = setup()
        types = [to_arrow_type(f.dataType) for f in fields]
        for batch in batches:
            for part in slices(batch, at):
                new = fn(raw_texts(part.column(at)), *[part.column(at + 1 + i).to_pylist() for i in range(len(use))])
                arrays = [part.column(i) for i in range(at)]
                arrays += [x if isinstance(x := new[f.name], pa.Array) else pa.array(x, t) for f, t in zip(fields, types)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return small_batches(inner).mapInArrow(run, schema)


def map_whole_rows(
    df: DataFrame, text_col: str, setup: Callable[[], Callable[..., dict]], use: list[str] | None = None, added: str = "",
) -> DataFrame:
    """Whole rows with decisions applied: ``keep`` (a mask) drops rows, ``replace`` gives columns new values (None: as it was).

    Every column of ``df`` comes back under its name; ``added`` names columns put at the end. No shuffle.
    """
    more = T.StructType.fromDDL(added) if added else T.StructType([])
    schema = T.StructType([*df.schema.fields, *more.fields])
    names, at, use = df.columns, df.columns.index(text_col), use or []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = setup()
        for batch in batches:
            for part in slices(batch, at):
                new = fn(raw_texts(part.column(at)), *[part.column(names.index(c)).to_pylist() for c in use])
                arrays = list(part.columns)
                for name, values in (new.get("replace") or {}).items():
                    i = names.index(name)
                    arrays[i] = pa.array([o if v is None else v for o, v in zip(arrays[i].to_pylist(), values)], arrays[i].type)
                arrays += [x if isinstance(x := new[f.name], pa.Array) else pa.array(x, to_arrow_type(f.dataType)) for f in more]
                mask = pa.array(new["keep"], pa.bool_()) if "keep" in new else None
                arrays = [a.filter(mask) for a in arrays] if mask is not None else arrays
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return small_batches(df).mapInArrow(run, schema)
