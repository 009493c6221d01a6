"""Quality rules with thresholds learned from mergeable quantile sketches (native).

Each text gives ratios: symbols per word character, share of words in repeated
three-word windows, share of repeated lines and letters per word.  For every
language and source the values of a ratio are put into a sketch of counted
buckets with a fixed relative width (``GAMMA``); sketches of different parts
merge by adding counts, so they need one partial aggregation and give the same
quantiles in any order of merging.  A fence is the upper quartile plus
``SPREAD`` times the interquartile range; the range counts as ``RESOLUTION`` at
least, so that in a group of nearly equal texts ordinary variation fails nobody.
Groups of fewer than
``MIN_GROUP`` texts take the merged sketch of their language, and that of the
whole corpus if this is small too.  The fences are joined back by language and
source.

Defined cases
* null or blank text: all counts 0, ``base_failed`` (fewer than 50 words), not kept;
* null language or source: a group like any other;
* repeated rows and ids: one result per row; empty table: empty result;
* a text is never cut; further columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, scratch, words

SYMBOLS = "#*$%&|<>"
GAMMA = 1.05
SPREAD = 3.0
MIN_GROUP = 50
#: Least interquartile range that a fence counts with (shares, or letters per word).
RESOLUTION = {"symbol_ratio": 0.01, "repeat_ratio": 0.10, "dup_line_ratio": 0.20, "word_length": 1.0}
METRICS = list(RESOLUTION)


def _windows(w: Column, of) -> Column:
    """``of`` three neighbouring words, for every place where three stand."""
    return F.when(F.size(w) < 3, F.array()).otherwise(F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: of(x, F.get(w, i + 1), F.get(w, i + 2))))


def _repeated(w: Column) -> Column:
    """Number of words covered by three-word windows that occur twice or more.

    Most texts repeat nothing, which the 64-bit hashes of the windows show.  Where
    two hashes agree the windows themselves are sorted with their positions; equal
    neighbours mark repeated positions.  A position adds the words up to the next
    one, three at most.
    """
    def positions(a: Column) -> Column:
        n = F.size(a)
        same = F.filter(a, lambda x, k: (
            ((k > 0) & (F.get(a, k - 1)["g"] == x["g"])) | ((k < n - 1) & (F.get(a, k + 1)["g"] == x["g"]))))
        return F.array_sort(F.transform(same, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        return F.aggregate(p, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
                           lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"),
                                                   i.alias("last")))["n"]

    def counted(hashes: Column) -> Column:
        # a window is its three words with a separator that no word can hold; only hashes that agree come here
        grams = F.transform(_windows(w, lambda x, y, z: F.concat_ws(" ", x, y, z)),
                            lambda g, i: F.struct(g.alias("g"), i.alias("i")))
        # one-element arrays bind the sorted windows and the positions once
        bound = F.transform(F.array(F.array_sort(grams)), lambda a: F.transform(F.array(positions(a)), covered)[0])
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(bound[0])
    return F.transform(F.array(_windows(w, lambda x, y, z: F.xxhash64(x, y, z))), counted)[0]


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             source_col: str = "source") -> DataFrame:
    """Counts per row: id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
                    t.alias("t"))
    d = d.select("id", "lang", "source", "t", words(F.col("t")).alias("w"),
                 F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("lines"))
    return d.select(
        "id", "lang", "source", F.size("w").cast("long").alias("n_words"),
        F.length(F.translate("t", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("w")).cast("long").alias("n_repeat_words"))


def ratios(f: DataFrame) -> dict[str, Column]:
    def over(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return {"symbol_ratio": over("n_symbols", "word_chars"), "repeat_ratio": over("n_repeat_words", "n_words"),
            "dup_line_ratio": over("n_dup_lines", "n_lines"), "word_length": over("word_chars", "n_words")}


def sketch(f: DataFrame) -> DataFrame:
    """Sketch rows (lang, source, metric, bucket, n); sketches merge by summing n.

    Bucket k > 0 holds values in (GAMMA^(k-1), GAMMA^k] thousandths, 0 all up to one thousandth.
    """
    k = F.lit(1000.0)
    cells = [F.struct(F.lit(m).alias("metric"),
                      F.when(v * k <= 1, 0).otherwise(F.ceil(F.log(v * k) / F.log(F.lit(GAMMA)))).cast("int")
                      .alias("bucket")) for m, v in ratios(f).items()]
    # counting whole value tuples first keeps the four cells of a text in one row
    per_text = f.select("lang", "source", *[c["bucket"].alias(f"b{i}") for i, c in enumerate(cells)])
    merged = per_text.groupBy("lang", "source", *[f"b{i}" for i in range(len(cells))]).agg(F.count("*").alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"b{i}").alias("bucket"))
                               for i, m in enumerate(METRICS)]))
    return (merged.select("lang", "source", each.alias("e"), "n")
            .groupBy("lang", "source", F.col("e.metric").alias("metric"), F.col("e.bucket").alias("bucket"))
            .agg(F.sum("n").alias("n")))


def _quartiles(s: DataFrame, by: list[str]) -> DataFrame:
    """(by..., metric, total, q1, q3) of sketch rows; a quantile is its bucket's upper edge."""
    merged = s.groupBy(*by, "metric", "bucket").agg(F.sum("n").alias("n"))
    run = Window.partitionBy(*by, "metric").orderBy("bucket")
    whole = Window.partitionBy(*by, "metric")
    c = merged.withColumns({"upto": F.sum("n").over(run), "total": F.sum("n").over(whole)})
    edge = F.when(F.col("bucket") == 0, 0.0).otherwise(F.pow(F.lit(GAMMA), F.col("bucket")) / 1000.0)
    return c.groupBy(*by, "metric").agg(
        F.max("total").alias("total"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total"), edge)).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, edge)).alias("q3"))


def fences(s: DataFrame) -> DataFrame:
    """(lang, source, one fence per metric): fences of each group, its language or the corpus."""
    own, lang, all_ = _quartiles(s, ["lang", "source"]), _quartiles(s, ["lang"]), _quartiles(s, [])
    lang = lang.select(F.col("lang").alias("l"), F.col("metric").alias("m"), F.struct("total", "q1", "q3").alias("of_lang"))
    all_ = all_.select(F.col("metric").alias("m2"), F.struct("total", "q1", "q3").alias("of_all"))
    j = (own.join(lang, own["lang"].eqNullSafe(F.col("l")) & (F.col("metric") == F.col("m")))
         .join(all_, F.col("metric") == F.col("m2")))
    pick = (F.when(F.col("total") >= MIN_GROUP, F.struct("total", "q1", "q3"))
            .when(F.col("of_lang.total") >= MIN_GROUP, F.col("of_lang")).otherwise(F.col("of_all")))
    least = F.create_map(*[x for m, v in RESOLUTION.items() for x in (F.lit(m), F.lit(v))])
    fence = F.col("p.q3") + SPREAD * F.greatest(F.col("p.q3") - F.col("p.q1"), least[F.col("metric")])
    return (j.withColumn("p", pick).withColumn("fence", fence).groupBy("lang", "source")
            .agg(*[F.max(F.when(F.col("metric") == m, F.col("fence"))).alias(f"max_{m}") for m in METRICS]))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: id, the counts, the group's fences, base_failed and kept."""
    f = scratch(features(docs, id_col, text_col, lang_col, source_col), "quality")
    t = fences(sketch(f)).withColumnsRenamed({"lang": "l", "source": "s"})
    j = f.join(t, f["lang"].eqNullSafe(F.col("l")) & f["source"].eqNullSafe(F.col("s")))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    within = F.lit(True)
    for m, v in ratios(f).items():
        within = within & (v <= F.col(f"max_{m}"))
    return j.select("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    *[f"max_{m}" for m in METRICS], failed.alias("base_failed"), (~failed & within).alias("kept"))
