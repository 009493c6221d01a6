"""Sinks (SNK-*) and the bronze / silver / gold layout."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.cleaning import conform, split_conformed
from medallion.sources.readers import read_table


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    """SNK-1: CSV with a header (names survive a re-read)."""
    df.write.mode(mode).option("header", header).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None,
                  partition_by: Sequence[str] | None = None) -> None:
    """SNK-2/SNK-3: Parquet; ``files`` coalesces to that many files (small outputs only)."""
    if files:
        df = df.coalesce(files)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def load_typed(df: DataFrame, path: str, schema: T.StructType, order_by: Sequence[str],
               partitions: int | None = None, mode: str = "overwrite",
               quarantine_path: str | None = None, tiebreak: bool = True) -> DataFrame:
    """SNK-5: conform to ``schema``, range-partition and sort by ``order_by``, write Parquet.

    Rows that violate the schema go to ``quarantine_path`` (when given) instead
    of the table.  Sorted files give tight min/max statistics, so later
    filters on the order key skip files.  With ``tiebreak`` a row hash extends
    the range and sort keys, so one order-key value holding a large share of
    the rows is spread over several partitions instead of one write task.
    Returns the quarantined rows.
    """
    conformed = conform(df, schema)
    good, bad = split_conformed(conformed)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in order_by]
    if tiebreak:
        keys.append(F.xxhash64(*[x for c in good.columns for x in (F.col(c).isNull(), F.col(c))]))
    (good.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
     .write.mode(mode).parquet(path))
    if quarantine_path:
        bad.write.mode(mode).parquet(quarantine_path)
    return bad


def files_holding(df: DataFrame, cond) -> DataFrame:
    """(n_files, n_rows): distinct files of a file scan with a row under ``cond``, and the rows.

    Over a table written by :func:`load_typed` a range of the order key lies in few
    files; the footers of the others let the scan skip them.
    """
    return df.where(cond).agg(F.count_distinct("_metadata.file_path").alias("n_files"), F.count("*").alias("n_rows"))


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None,
                  sort_by: Sequence[str] | None = None, mode: str = "overwrite") -> DataFrame:
    """SNK-5 / SRC-9: a catalog table dealt into buckets by ``keys`` and sorted in each; returns the table.

    Tables with the same buckets join and aggregate on these keys without an exchange.
    With ``path`` the table is external: its files are written there.  Each task
    first gets whole buckets (one exchange, when written), so a bucket is one file;
    more buckets than tasks and a bucket count that grows with the data keep files bounded.
    """
    w = (df.repartition(buckets, *keys).write.mode(mode).format("parquet").bucketBy(buckets, *keys)
         .sortBy(*(sort_by or keys)))
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return read_table(df.sparkSession, name)


@dataclass(frozen=True)
class Layers:
    """SNK-6: bronze / silver / gold folders under one base path."""
    base: str

    @property
    def bronze(self) -> str:
        return f"{self.base.rstrip('/')}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.base.rstrip('/')}/silver"

    @property
    def gold(self) -> str:
        return f"{self.base.rstrip('/')}/gold"

    def path(self, layer: str, name: str) -> str:
        return f"{getattr(self, layer)}/{name}"
