"""Steps that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.session import fresh_path, stage

#: Characters handled at once inside a task, so memory does not follow the size of a batch.
SLAB = 4_000_000


def text_or_empty(name: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def unused(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def slabs(texts: list[str], limit: int = SLAB) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows with about ``limit`` characters, one row at least."""
    return ranges(map(len, texts), limit)


def ranges(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows whose sizes come to about ``limit``, one row at least."""
    start = total = end = 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
        end = i + 1
    if start < end:
        yield start, end


def map_texts(df: DataFrame, work: Callable[[list[str]], dict[str, object]], schema: str, text: str = "text", keep: bool = False, limit: int = SLAB) -> DataFrame:
    """Every column of ``df`` (``text`` only if kept), and the columns of ``schema`` that ``work`` makes of the texts,
    of about ``limit`` characters at once. Null is handed on as empty."""
    kept = [f for f in df.schema.fields if keep or f.name != text]
    added = spark_schema(schema)
    out = type(df.schema)(kept + added.fields)
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            lengths = pc.utf8_length if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else pc.list_value_length
            # only the rows of a slab become Python objects at a time
            for a, b in ranges(lengths(column).fill_null(0).to_pylist(), limit):
                part = batch.slice(a, b - a)
                made = work([t if t is not None else "" for t in column.slice(a, b - a).to_pylist()])
                arrays = [part.column(part.schema.get_field_index(n)) for n in names]
                arrays += [x if isinstance(x, pa.Array) else pa.array(x) for x in (made[f.name] for f in added.fields)]
                yield pa.RecordBatch.from_arrays(arrays, names=names + [f.name for f in added.fields])
        # the worker goes on to other tasks; what this one took goes back
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, out)


def spark_schema(text: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(text)


def known(df: DataFrame, rows: int) -> bool:
    """Whether a written table holds at most ``rows`` rows; reads no more than it must."""
    return df.limit(rows + 1).count() <= rows


def bounded(df: DataFrame, texts: list[str], rows: int = 20_000, size: int = 4_000_000) -> bool:
    """Whether a written table is within bounds of rows and of the bytes of its text columns."""
    n, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(sum((F.octet_length(F.coalesce(t, F.lit(""))) for t in texts), F.lit(0))), F.lit(0))).first()
    return n <= rows and total <= size


def join_small(left: DataFrame, right: DataFrame, on, how: str, rows: int = 200_000) -> DataFrame:
    """Join with a written table: broadcast up to ``rows`` rows, a shuffled join beyond."""
    return left.join(F.broadcast(right) if known(right, rows) else right, on, how)


__all__ = ["SLAB", "DataFrame", "SparkSession", "bounded", "fresh_path", "join_small", "known", "map_texts", "slabs", "spark_schema", "stage", "text_or_empty", "unused"]
