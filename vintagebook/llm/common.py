"""Helpers shared by the corpus operators.

Intermediate tables that are read more than once are written as Parquet into
the cluster's shared folder (``spark.checkpoint.dir``) and read back, which
cuts the lineage and survives lost executors.  :func:`release` removes the
tables written so far, once their readers have finished.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Fixed value: the word separators of every operator (space, tab to carriage
# return).  Python's ``bytes.split()`` separates at exactly these characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# the tables written by this thread of work, and by no other one
_WRITTEN: ContextVar[tuple[str, ...]] = ContextVar("written", default=())


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only, so that every engine agrees on the result."""
    return F.translate(c, UPPER, LOWER)


def reserve(rows: DataFrame, *names: str) -> None:
    """Fail when ``rows`` has a column that an operator adds or uses inside
    (names are matched as Spark resolves them, without regard to case)."""
    clash = sorted({c for c in rows.columns if c.lower() in names})
    if clash:
        raise ValueError(f"rename these columns first: {clash}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` into the shared folder (in one folder per value of ``by``)
    and return a reader of it."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*[by] if by else []).parquet(path)
    _WRITTEN.set((*_WRITTEN.get(), path))
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete tables in the shared folder."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


def release(spark: SparkSession) -> None:
    """Delete the tables that this thread of work has written by
    :func:`materialize` so far.  Call it only when every result that reads them
    has been written."""
    remove(spark, *_WRITTEN.get())
    _WRITTEN.set(())


def bitmap(cells: DataFrame, most: int, *also: Column) -> tuple[bytes, list[Row]]:
    """The numbers (column ``cell``, from 0 to ``most`` - 1) that occur, as set bits of
    ``most`` (the lowest of a byte first), and the aggregates ``also`` of each 32,768
    numbers.  The driver gets a row of 4 kB for those, however many rows there are."""
    place = F.col("cell").cast("long") + 1
    parts = cells.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"), *also).collect()
    out = bytearray(most // 8)
    for r in parts:
        at = (r["bucket"] - 1) * len(r["bits"])
        out[at:at + len(r["bits"])] = r["bits"]
    return bytes(out), parts


def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches``; at the end of a task its Arrow memory goes back to the system,
    as the worker stays alive for the tasks of other stages."""
    yield from batches
    pa.default_memory_pool().release_unused()


def dense_positions(rows: DataFrame, by: str, row_id: str, n_rows: int, weight: str | None = None,
                    rows_per_cell: int = 250_000, out: str = "position") -> DataFrame:
    """Number the rows of each ``by`` value from 0 without gaps.

    With ``weight`` a row takes that many numbers and gets the first of them.
    Rows are dealt into cells (``by``, salt); each cell is numbered on its own
    and shifted by the sizes of the cells before it, so a value that holds a
    third of all rows is spread over many tasks.  ``rows`` must be a
    materialised table and ``row_id`` unique in it, as it is read twice.
    """
    cells = max(16, n_rows // rows_per_cell + 1)
    w = F.col(weight) if weight else F.lit(1).cast("long")
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(F.col(row_id)), F.lit(cells)))
    before = Window.partitionBy("_by").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (dealt.groupBy(F.col(by).alias("_by"), "_salt").agg(F.sum(w).alias("_n"))
              .select("_by", F.col("_salt").alias("_cell"),
                      F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift")))
    inside = Window.partitionBy(by, "_salt").orderBy(row_id)
    numbered = dealt.withColumn("_sum", F.sum(w).over(
        inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - w)
    joined = numbered.join(shifts, F.col(by).eqNullSafe(F.col("_by"))
                           & (F.col("_salt") == F.col("_cell")))
    return joined.withColumn(out, F.col("_sum") + F.col("_shift")).drop(
        "_salt", "_sum", "_by", "_cell", "_shift")


def word_table(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The words of an Arrow batch of texts (null: none) as (starts, index,
    words): text i has the words ``words[index[starts[i]:starts[i + 1]]]``,
    and ``words`` holds each distinct one once."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.values.dictionary_encode()
    starts, index = np.asarray(lists.offsets), np.asarray(coded.indices)
    words = coded.dictionary
    empty = np.flatnonzero(np.asarray(pc.equal(words, "")))
    if len(empty):  # at the ends of texts
        keep = index != empty[0]
        starts = np.concatenate(([0], np.cumsum(keep)))[starts]
        index = index[keep]
    return starts, index, words


def text_slices(batch: pa.RecordBatch, column: int, most: int = 8_000_000):
    """Cut a batch into slices of at most ``most`` bytes of text (or one row)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
    part = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)
