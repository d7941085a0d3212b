"""Helpers the training-data operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Hashable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barscreen.session import shared_folder

#: A small side is broadcast up to so many rows, counted after it was written; above, both
#: sides are shuffled and a hot key is split by adaptive execution.
BROADCAST_ROWS = 20_000
#: Texts are taken from an Arrow batch in slices of so many bytes at most (a longer text alone).
SLICE_BYTES = 4 << 20


_HELD: dict[Hashable, object] = {}


def held(key: Hashable, build: Callable[[], object]) -> object:
    """What `build` makes, kept in a worker process until another key asks: workers outlive the
    stages of a job, and each needs one model at a time."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = build()
    return _HELD[key]


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there, and a lost
    executor costs only the tasks that read it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def attach(big: DataFrame, small: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join a table to a staged one, broadcasting the latter only if its rows were counted to
    be few."""
    if small.count() <= BROADCAST_ROWS:
        small = F.broadcast(small)
    return big.join(small, on, how)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` does not use (names are compared without case)."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name += "_"
    return name


def bucket(column: Column, n: int) -> Column:
    """crc32 of a value's text modulo n; null counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % n


def slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of each piece fit in SLICE_BYTES."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(text)).fill_null(0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and held + size > SLICE_BYTES:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def joined_schema(df: DataFrame, fields: str) -> StructType:
    """The schema of `df` and the fields of a DDL string after it."""
    return StructType([*df.schema.fields, *StructType.fromDDL(fields).fields])


def add_columns(
    df: DataFrame, text: str, fields: str, make: Callable[[list[str | None]], list[pa.Array]],
    keep_text: bool = True,
) -> DataFrame:
    """All columns of `df` (without its texts if `keep_text` is false) and the ones `make`
    derives from a slice of its texts. `fields` is a DDL string such as `score double`.
    """
    kept = [c for c in df.columns if keep_text or c != text]
    schema = joined_schema(df.select(*kept), fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, text):
            made = make(piece.column(text).to_pylist())
            old = [piece.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*old, *made], names=schema.names)

    return df.mapInArrow(run, schema)
