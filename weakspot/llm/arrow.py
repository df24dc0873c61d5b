"""Arrow batches in tasks: whole texts in, plain columns out."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column's strings; NULL is the empty text."""
    return [t if t is not None else "" for t in batch.column(column).to_pylist()]


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The same as UTF-8 bytes, without decoding."""
    return [t if t is not None else b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def map_columns(
    df: DataFrame, columns: list[str], schema: str, run: Callable[[Iterator[pa.RecordBatch]], Iterable[dict]]
) -> DataFrame:
    """``run`` gets a task's batches of the given columns and yields dicts of
    equally long columns that match ``schema``."""
    kind = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(kind)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in run(batches):
            yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in arrow], schema=arrow)

    return df.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(task, kind)


def pieces(items: list[bytes], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of items with about ``most`` bytes each, so that temporary
    arrays stay small; a longer item is a range of its own."""
    start = size = 0
    for i, item in enumerate(items):
        if size and size + len(item) > most:
            yield start, i
            start, size = i, 0
        size += len(item) + 1
    if start < len(items):
        yield start, len(items)
