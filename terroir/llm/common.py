"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def texts_of(batch: pa.RecordBatch, name: str = "text") -> Iterator[str]:
    """The strings of a column, null as the empty text, without a Python list of the whole batch."""
    return (x.as_py() or "" for x in batch.column(batch.schema.get_field_index(name)))


def record_batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of bounded length."""
    kept: list[tuple] = []
    for row in rows:
        kept.append(row)
        if len(kept) >= size:
            yield _batch(kept, schema)
            kept = []
    if kept:
        yield _batch(kept, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named input columns, cast; whatever else the input holds can't clash with columns made later."""
    return df.select(*(F.col(f"`{name}`").cast(kind).alias(name) for name, kind in columns.items()))
