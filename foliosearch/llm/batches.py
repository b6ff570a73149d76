"""Arrow batches as flat numpy arrays, and columns appended to a table by them.

Operators that need Python see a batch of texts as one byte buffer with
offsets, so their work is a fixed number of array operations per group of
rows.  Groups hold a bounded number of bytes, except that a single text longer
than the bound is a group of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

GROUP_BYTES = 4 << 20

#: Lower-cases A-Z and leaves every other byte.
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[ord("A") : ord("Z") + 1] += 32


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its row offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def groups(offsets: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes together, or of one longer row."""
    rows, start = len(offsets) - 1, 0
    while start < rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), rows)
        yield start, end
        start = end


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of integer ``values`` over the ranges between offsets, as int64."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def free_names(taken: Iterable[str], *wanted: str) -> list[str]:
    """Names like those wanted that no column has, in whatever letter case."""
    names, used = [], {name.lower() for name in taken}
    for name in wanted:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        names.append(name)
    return names


def column_at(columns: list[str], name: str) -> int:
    """Where a column is, found as Spark finds it: the letter case doesn't matter."""
    return columns.index(name) if name in columns else [c.lower() for c in columns].index(name.lower())


def set_aside(df: DataFrame, names: Iterable[str]) -> tuple[DataFrame, list[str]]:
    """The table with its columns of these names renamed, and the new names of all its columns."""
    taken = {name.lower() for name in names}
    clash = [c for c in df.columns if c.lower() in taken]
    spare = dict(zip(clash, free_names([*df.columns, *taken], *["own"] * len(clash))))
    renamed = [spare.get(c, c) for c in df.columns]
    return df.toDF(*renamed), renamed


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """The table without columns of these names, in whatever letter case."""
    taken = {name.lower() for name in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


def append_columns(
    df: DataFrame,
    fields: T.StructType,
    compute: Callable[[pa.RecordBatch], list],
    keep: Callable[[dict], np.ndarray] | None = None,
) -> DataFrame:
    """``df`` with columns computed batch by batch.

    A column of ``df`` that has the name of a new one is replaced by it.
    ``compute`` gets a batch and returns one array for each field.
    """
    base = without(df, fields.names)
    schema = T.StructType(base.schema.fields + fields.fields)
    kinds = [to_arrow_type(f.dataType) for f in fields]
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = [x if isinstance(x, pa.Array) else pa.array(x, kind) for x, kind in zip(compute(batch), kinds)]
                yield pa.RecordBatch.from_arrays(list(batch.columns) + made, names=names)

    return base.mapInArrow(run, schema)
