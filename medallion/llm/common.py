"""Small helpers shared by the corpus operators."""
from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.session import ensure_checkpoint_dir, note_scratch, ship_package

#: ASCII white space that separates words: space and U+0009..U+000D.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor rereads the table instead of recomputing
    what led to it, and several readers do not repeat the work.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/llm-{name}-{uuid.uuid4().hex}"
    note_scratch(spark, path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


#: Bytes of a batch that is sent to a Python worker, where the session does not set it.
BATCH_BYTES = "16m"


def give_back() -> None:
    """Return freed memory of a worker to the system: idle workers must not hold what their last task needed."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def _freeing(run):
    def out(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return out


def _prepared(df: DataFrame) -> None:
    ship_package(df.sparkSession)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if df.sparkSession.conf.get(key, "1b") == "1b":
        df.sparkSession.conf.set(key, BATCH_BYTES)


def map_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package's source on the executors and batches bounded by bytes."""
    _prepared(df)
    return df.mapInArrow(_freeing(run), schema)


def map_pandas(df: DataFrame, run, schema: str) -> DataFrame:
    """``df.mapInPandas`` with this package's source on the executors and batches bounded by bytes."""
    _prepared(df)
    return df.mapInPandas(_freeing(run), schema)


class Remembered:
    """What a worker has computed for words, as flat arrays of at most ``limit`` bytes."""

    def __init__(self, limit: int):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.words, self.values = pa.array([], pa.large_binary()), pa.array([], pa.large_binary())

    def values_of(self, words: pa.Array, make: Callable[[list[bytes]], pa.Array]) -> pa.Array:
        """The value of each (distinct) word; ``make`` computes those of new words.

        Beyond the limit what was known before is forgotten, and the new words are kept if they fit.
        """
        at = pc.index_in(words, value_set=self.words)
        missing = pc.is_null(at)
        new = words.filter(missing)
        if not len(new):
            return self.values.take(at)
        fresh = make(new.to_pylist())
        mask = missing.to_numpy(zero_copy_only=False)
        number = at.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        number[mask] = len(self.words) + np.arange(len(new))
        known, values = pa.concat_arrays([self.words, new]), pa.concat_arrays([self.values, fresh])
        out = values.take(pa.array(number))
        if known.nbytes + values.nbytes <= self.limit:
            self.words, self.values = known, values
        elif new.nbytes + fresh.nbytes <= self.limit:
            self.words, self.values = new, fresh
        return out


def binary_slices(data: bytes, ends: np.ndarray) -> pa.Array:
    """Array of the slices of ``data`` between neighbouring ``ends`` (the first is 0)."""
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1,
                                 [None, pa.py_buffer(np.ascontiguousarray(ends, dtype=np.int64)), pa.py_buffer(data)])


def drop_scratch(df: DataFrame) -> None:
    """Delete a table that :func:`scratch` wrote and that nothing reads any more."""
    path = getattr(df, "_scratch_path", None)
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def small_side(df: DataFrame, max_rows: int = 50_000) -> DataFrame:
    """``df`` (a scratch table) marked for broadcast if it is proven small.

    The rows are counted (Parquet footers only); beyond ``max_rows`` the join
    stays a shuffled equi-join that adaptive execution can split.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def words(text: Column) -> Column:
    """Array of the words of a text (null or blank text: empty array)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def n_words(text: Column) -> Column:
    """Number of words of a text as long (null: 0)."""
    return F.size(words(text)).cast("long")


def in_share(h: Column, n: Column, want: int) -> Column:
    """Whether the hash ``h`` lies in the share ``want`` / ``n`` of all hashes (no product: ``n`` may be any long)."""
    return F.pmod(h, F.lit(1 << 30)).cast("double") < F.lit(float((1 << 30) * want)) / n.cast("double")


def id_key(id_col: Column, text: Column) -> Column:
    """String that identifies a row for hashing: the id, or the text where the id is null."""
    return F.coalesce(F.concat(F.lit("i"), id_col.cast("string")),
                      F.concat(F.lit("t"), text), F.lit("n"))


def empty_safe_min(df: DataFrame, col: str):
    row = df.agg(F.min(col)).first()
    return row[0] if row else None
