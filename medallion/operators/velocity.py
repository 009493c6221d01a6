"""Rolling activity per key over a time range, for keys of any size (X-2)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR = 3600 * 1_000_000


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def velocity(df: DataFrame, key: str, ts: str, amount: str | None = None, hours: int = 24, bucket: int = HOUR,
             out: str = "velocity", out_amount: str = "amount_in_range") -> DataFrame:
    """``df`` with the number of rows of the same key within the last ``hours`` (both ends included), and their sum of ``amount``.

    A range window over a key would hold all of a hot key in one task.  Here a row's
    window is the difference of two running totals, at its time and just before its
    time less the range.  Each row so becomes two points; the points are dealt by
    (key, time bucket), where a window runs over one bucket only, and the totals of
    the buckets before, one row for each key and bucket, are carried in.  A hot key
    is split into its buckets, and nothing wider than the numbers is shuffled but
    the rows themselves, once, at the end.

    The sum is exact: ``amount`` is taken as decimal(38, 6).  Null keys are a key of their own; a
    row without a time has null results and counts for nobody; a null amount adds nothing.
    """
    span = hours * HOUR
    value = F.coalesce(F.col(amount).cast("decimal(38,6)"), F.lit(0)) if amount else F.lit(0)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    src = df.select(F.col(key).alias("k"), _micros(ts).alias("t"), value.cast("decimal(38,6)").alias("v"), row.alias("row"))
    timed = src.where("t is not null")
    # rows get a number so that their two points meet again: rows that are alike in key and time have the same window
    moments = timed.groupBy("k", "t").agg(F.count("*").alias("n"), F.sum("v").alias("s"))
    # even places are rows, odd ones lie just before them
    points = moments.select("k", F.inline(F.array(
        F.struct((2 * F.col("t")).alias("at"), F.col("t").alias("t"), F.lit(1).alias("sign"), F.col("n").alias("n"), F.col("s").alias("s")),
        F.struct((2 * (F.col("t") - span) - 1).alias("at"), F.col("t").alias("t"), F.lit(-1).alias("sign"),
                 F.lit(0).cast("long").alias("n"), F.lit(0).cast("decimal(38,6)").alias("s")))))
    points = points.withColumn("b", F.floor(F.col("at") / (2 * bucket)).cast("long"))
    inside = Window.partitionBy("k", "b").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    run = points.withColumns({"rn": F.sum("n").over(inside), "rs": F.sum("s").over(inside)})
    before = Window.partitionBy("k").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    carried = (points.groupBy("k", "b").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
               .select(F.col("k").alias("ck"), F.col("b").alias("cb"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("cn"),
                       F.coalesce(F.sum("s").over(before), F.lit(0)).alias("cs")))
    total = run.join(carried, F.col("k").eqNullSafe(F.col("ck")) & (F.col("b") == F.col("cb")))
    found = total.groupBy(F.col("k").alias("fk"), F.col("t").alias("ft")).agg(
        F.sum(F.col("sign") * (F.col("rn") + F.col("cn"))).alias("n"),
        F.sum(F.col("sign") * (F.col("rs") + F.col("cs"))).cast("decimal(38,6)").alias("s"))
    back = src.join(found, F.col("k").eqNullSafe(F.col("fk")) & (F.col("t") == F.col("ft")), "left")
    new = [F.col("n").alias(out)] + ([F.col("s").alias(out_amount)] if amount else [])
    return back.select("row.*", *new)
