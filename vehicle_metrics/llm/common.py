"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: A word is a run of characters outside this class (space, tab to carriage return).
SPACES = r"[\x20\x09-\x0D]+"

#: Rows and text bytes that a Python worker holds in numpy form at a time.
BLOCK_ROWS, BLOCK_BYTES = 512, 4 << 20


def fresh(df: DataFrame, base: str) -> str:
    """A column name starting with ``base`` that ``df`` does not have."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def hash_mod(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (NULL for a NULL id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def in_split(id_col: str, n: int, remainder: int) -> Column:
    """Whether a row belongs to the held-out split; a NULL id is never held out."""
    return F.coalesce(hash_mod(id_col, n) == remainder, F.lit(False))


def may_train(id_col: str, n: int, remainder: int) -> Column:
    """Whether a row may be learned from; a NULL id is never learned from."""
    return F.coalesce(hash_mod(id_col, n) != remainder, F.lit(False))


def blocks(sizes: list[int], rows: int = BLOCK_ROWS, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges holding at most ``rows`` items and, unless a single
    item is larger, ``size`` bytes."""
    start, held = 0, 0
    for i, s in enumerate(sizes):
        if i > start and (i - start >= rows or held + s > size):
            yield start, i
            start, held = i, 0
        held += s
    if start < len(sizes):
        yield start, len(sizes)


def text_blocks(batches: Iterable[pa.RecordBatch], text_col: str,
                size: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Record batches cut into blocks of bounded size, each with the texts'
    UTF-8 bytes (NULL: empty)."""
    for batch in batches:
        at = batch.schema.get_field_index(text_col)
        texts = batch.column(at).cast(pa.large_binary())
        sizes = [0 if x is None else x for x in pc.binary_length(texts).to_pylist()]
        for a, b in blocks(sizes, size=size):
            yield batch.slice(a, b - a), [x or b"" for x in texts.slice(a, b - a).to_pylist()]


def add_columns(df: DataFrame, text_col: str, fields: StructType,
                compute: Callable[[], Callable[[list[bytes]], list[pa.Array]]]) -> DataFrame:
    """Append ``fields`` to every row, computed from the text.

    ``compute()`` is called once per task and returns a function from the
    UTF-8 texts of a block to one array for each new field. Rows pass through
    in Arrow batches: no shuffle, and memory is bounded by the block size.
    """
    out = StructType([*df.schema.fields, *fields.fields])
    n_old = len(df.columns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = compute()
        for part, texts in text_blocks(batches, text_col):
            new = apply(texts)
            names = [*part.schema.names[:n_old], *fields.names]
            yield pa.RecordBatch.from_arrays([*part.columns, *new], names=names)

    return df.mapInArrow(run, out)


def sorted_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join by sorting both sides, whatever their sizes are taken for. Spark
    sizes rows made by ``inline``, ``explode`` or Python as the rows they are
    made of, and stored ones as their compressed file; a side that grows with
    the input would pass for a small one and go through the driver."""
    return left.join(right.hint("merge"), on, how)


#: A key that holds at least one row in this many is heavy, so at most this many keys are.
HEAVY_SHARE = 1000


def heavy_keys(rows: DataFrame, key: str, total: int) -> DataFrame:
    """The values of ``key`` that hold at least a thousandth of ``total`` rows."""
    least = max(2, -(-total // HEAVY_SHARE))
    return rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") >= least).select(key)


def look_up(rows: DataFrame, heavy: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``rows`` joined with ``table`` (one row for each key, NULL keys in
    neither). The at most 1000 keys in ``heavy`` are joined by broadcast, so
    their rows stay where they are; no other key is many of a task's rows."""
    few = table.join(F.broadcast(heavy), key)
    often = rows.join(F.broadcast(few), key)
    return often.unionByName(rows.join(F.broadcast(heavy), key, "left_anti").join(table, key))
