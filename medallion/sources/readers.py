"""Scans (SRC-*): every reader takes a declared schema and never infers one."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.session import materialized
from medallion.sources.schemas import CSV_SCHEMA, JSON_SCHEMA

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType = CSV_SCHEMA,
             header: bool = True, corrupt_col: str = CORRUPT, sep: str = ",",
             source_file: str | None = "source_file") -> DataFrame:
    """SRC-1: permissive CSV scan; malformed rows keep their text in ``corrupt_col``.

    The corrupt column must be part of ``schema`` for Spark to fill it; the
    input file path is attached as ``source_file``.
    """
    if corrupt_col and corrupt_col not in schema.fieldNames():
        schema = T.StructType(schema.fields + [T.StructField(corrupt_col, T.StringType(), True)])
    df = (spark.read.schema(schema).option("header", header).option("sep", sep)
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
          .csv(path))
    return with_source_file(df, source_file) if source_file else df


def read_json(spark: SparkSession, path: str | Sequence[str], schema: T.StructType = JSON_SCHEMA,
              multi_line: bool = True, corrupt_col: str = CORRUPT,
              source_file: str | None = "source_file") -> DataFrame:
    """SRC-2: multi-line JSON documents (arrays of objects are exploded by Spark)."""
    if corrupt_col and corrupt_col not in schema.fieldNames():
        schema = T.StructType(schema.fields + [T.StructField(corrupt_col, T.StringType(), True)])
    df = (spark.read.schema(schema).option("multiLine", multi_line)
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
          .json(path))
    return with_source_file(df, source_file) if source_file else df


def with_source_file(df: DataFrame, out: str = "source_file") -> DataFrame:
    """Attach the input file path (hidden ``_metadata`` column of file scans)."""
    return df.withColumn(out, F.col("_metadata.file_path"))


def split_corrupt(df: DataFrame, corrupt_col: str = CORRUPT,
                  source_file: str = "source_file") -> tuple[DataFrame, DataFrame]:
    """SRC-3: (good rows, bad rows with their file) from a permissive scan.

    Spark refuses queries on a raw file scan that reference only the corrupt
    column; persist the scan (or write it) before counting the bad side alone.
    """
    bad = df.where(F.col(corrupt_col).isNotNull())
    good = df.where(F.col(corrupt_col).isNull()).drop(corrupt_col, source_file)
    return good, bad


def corrupt_report(df: DataFrame, corrupt_col: str = CORRUPT,
                   source_file: str = "source_file") -> DataFrame:
    """SRC-3: per input file, rows read and rows unreadable (persist the scan first)."""
    return (df.groupBy(source_file)
            .agg(F.count("*").alias("rows"),
                 F.count_if(F.col(corrupt_col).isNotNull()).alias("corrupt_rows"))
            .orderBy("source_file"))


def read_json_files(spark: SparkSession, path: str | Sequence[str], schema: T.StructType = JSON_SCHEMA
                    ) -> tuple[DataFrame, DataFrame]:
    """SRC-2/SRC-3 for files that each hold one JSON document or array: (rows, report by file).

    A file is parsed as a whole, in one task; one that is no valid JSON gives no rows
    and is set aside with its text.  The parse is written once (typed rows and
    rejects), so neither result reads the files again.  ``rows`` keep
    ``source_file``; the report has one line for each file: (source_file, rows,
    rejected, reject_text), the text null for good files.
    """
    parsed = materialized(read_json(spark, path, schema, multi_line=True), "json-files")
    bad = F.col(CORRUPT).isNotNull()
    report = parsed.groupBy("source_file").agg(
        F.count_if(~bad).alias("rows"), F.max(bad).alias("rejected"),
        F.max(F.when(bad, F.col(CORRUPT))).alias("reject_text"))
    return parsed.where(~bad).drop(CORRUPT), report


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Parquet scan of one or more paths."""
    return spark.read.parquet(*([path] if isinstance(path, str) else list(path)))


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """SRC-4: one row per text line (column ``value``)."""
    return spark.read.text(path)


def file_manifest(spark: SparkSession, path: str, glob: str | None = None,
                  recursive: bool = False) -> DataFrame:
    """SRC-5: path, length, modification time of input files (contents are not read)."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.load(path).select("path", "length", "modificationTime")


def audit_loaded(df: DataFrame, expected: DataFrame | Sequence, keys: str | Sequence[str]) -> DataFrame:
    """SRC-7: prove each known key arrived: (keys..., n_rows, present).

    Grouped counts of the loaded data are joined to the expected key list; the
    aggregate runs before the join, so the join sees one row per key.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    spark = df.sparkSession
    if not isinstance(expected, DataFrame):
        rows = [tuple(e) if isinstance(e, (tuple, list)) else (e,) for e in expected]
        fields = [T.StructField(k, df.schema[k].dataType, True) for k in keys]
        expected = spark.createDataFrame(rows, T.StructType(fields))
    counts = df.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    out = expected.select(*keys).distinct().join(counts, keys, "left")
    return out.select(*keys, F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
                      (F.coalesce("n_rows", F.lit(0)) > 0).alias("present"))


def missing_keys(df: DataFrame, expected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected keys that never arrived (anti join)."""
    return expected.join(df.select(*keys), list(keys), "left_anti")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """SRC-9: a catalog table or view."""
    return spark.table(name)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None) -> DataFrame:
    """SRC-9: a warehouse table over JDBC (credentials come from the caller's config)."""
    return spark.read.jdbc(url, table, properties=properties or {})
