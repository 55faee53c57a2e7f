"""Small helpers that several operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Rows per Arrow batch: some texts are very long, and a batch is held in memory whole.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def crc_rest(doc_id: Column, n: int) -> Column:
    """crc32 of the id's text, modulo ``n``; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n).cast("int")


def row_key(*cols: Column) -> Column:
    """64-bit key of a row; a null differs from every text."""
    return F.xxhash64(*[x for c in cols for x in (c.isNull(), c.cast("string"))])


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def hash_sample(df: DataFrame, rows: int, *key: Column) -> DataFrame:
    """About ``rows`` rows, or all if there are fewer: those whose key's hash is small. The same
    rows come out however the table is split, and no task sends more than its share."""
    n = df.count()
    if n <= rows:
        return df
    part = F.shiftrightunsigned(F.xxhash64(*key), 1)
    return df.filter(part < F.lit(int((1 << 63) * (rows / n))))


def in_arrow(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with batches small enough for very long texts."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def rebatched(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at least ``rows``, for rows of small fixed size."""
    held, n = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            n += b.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def record_batch(schema: pa.Schema, columns: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type)
         for f, c in ((f, columns[f.name]) for f in schema)],
        schema=schema)
