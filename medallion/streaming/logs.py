"""Streaming log ingestion.

The log operators are stateless per line (parse, score, relabel, flag), so the
batch flow runs unchanged on ``readStream.text``.  Exact duplicate lines are
dropped with ``dropDuplicatesWithinWatermark`` keyed by the whole parsed row;
the watermark runs on the input file's modification time, which bounds the
deduplication state.  Output goes through ``foreachBatch``: each micro-batch
is written to its own ``epoch=N`` folder in overwrite mode, so a batch that is
replayed after a failure replaces its earlier partial output instead of
duplicating it (idempotent sink).  The query checkpoint belongs in the shared
checkpoint folder, so a restarted query resumes where it stopped.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from medallion.operators import rules, text
from medallion.plans.flows import FRAUD_PREFIX


def log_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of new text files under ``path`` with the file's modification time."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path).withColumn("file_time", F.col("_metadata.file_modification_time"))


def clean_log_stream(lines: DataFrame, prefixes: Sequence[str] = (FRAUD_PREFIX,),
                     watermark: str = "1 hour", dedupe_on: Sequence[str] | None = None) -> DataFrame:
    """Parse -> score -> relabel -> flag -> drop duplicates within the watermark.

    Duplicates are exact rows by default; ``dedupe_on`` (e.g. the transaction id)
    keeps the first row per key instead (DED-2 on a stream).
    """
    df = text.parse_logs(lines, keep=["file_time"])
    df = df.where(F.col("transaction_id").isNotNull() & F.col("amount").isNotNull())
    df = rules.risk_score(df, "ip_risk_score")
    df = rules.relabel_by_prefix(df, "transaction_id", list(prefixes), "is_fraud", True)
    df = rules.prefix_flag(df, "transaction_id", FRAUD_PREFIX, "id_flag")
    cols = list(dedupe_on) if dedupe_on else [c for c in df.columns if c != "file_time"]
    return df.withWatermark("file_time", watermark).dropDuplicatesWithinWatermark(cols)


def start_log_ingest(spark: SparkSession, source: str, target: str, checkpoint: str,
                     sink: Callable[[DataFrame, int], None] | None = None,
                     trigger_once: bool = False, **kw) -> StreamingQuery:
    """Run the streaming flow; micro-batch N is written (overwrite) to ``target/epoch=N``."""
    out = clean_log_stream(log_stream(spark, source), **kw)

    def write(batch: DataFrame, epoch: int) -> None:
        batch.drop("file_time").write.mode("overwrite").parquet(f"{target}/epoch={epoch}")

    w = out.writeStream.foreachBatch(sink or write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
