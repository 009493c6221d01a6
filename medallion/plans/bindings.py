"""Registered queries: each operator run over the driver tables.

Every query takes ``(spark, sf_dir)``, reads whole tables from ``sf_dir`` and
returns a DataFrame whose columns match the oracle SQL in
:mod:`medallion.plans.oracle`.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions import coerce as fx
from medallion.operators import (cleaning, encode, impute, keys, model, outliers, profile,
                                 rules, snapshots, text, unify, velocity)
from medallion.plans import flows
from medallion.plans.dirt import (EVENT_CSV, EVENT_DIRT, EVENT_JSON, EVENT_JSON_NULL_CARDHOLDER,
                                  EVENT_JSON_TRUNCATED, EVENT_LOG_BROKEN, EVENT_LOG_LINE, SUPERVISOR_NOTE, with_dirt)
from medallion.session import materialized, scratch_path
from medallion.sources import readers, sinks

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return readers.read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread_events(spark, sf_dir) -> DataFrame:
    """The events dealt out evenly: rows that a few file blocks hold are rendered and parsed by all cores."""
    return table(spark, sf_dir, "events").repartition(2 * spark.sparkContext.defaultParallelism)


def dirty_events(spark, sf_dir) -> DataFrame:
    return with_dirt(table(spark, sf_dir, "events"), EVENT_DIRT)


def coerced_events(spark, sf_dir) -> DataFrame:
    """Dirty events with typed columns: value_num, hour_num, flag, cat."""
    d = dirty_events(spark, sf_dir)
    return d.select("event_id", "tx_id",
                    fx.as_double("raw_value").alias("value_num"),
                    fx.as_double("raw_hour").alias("hour_num"),
                    fx.as_bool_set("raw_flag").alias("flag"),
                    F.col("raw_cat").alias("cat"))


def event_log_lines(spark, sf_dir) -> DataFrame:
    line = F.when(F.expr(EVENT_LOG_BROKEN), F.concat(F.lit("cut off "), F.col("event_id").cast("string")))
    return spread_events(spark, sf_dir).select(line.otherwise(F.expr(EVENT_LOG_LINE)).alias("value"))


def dirty_lineitem(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        # dropping the quantity outliers narrows the price fences: sequential and simultaneous filters differ
        F.expr("CASE WHEN l_orderkey % 5 = 0 THEN l_quantity + 500 ELSE l_quantity END").alias("qty"),
        F.expr("CASE WHEN l_orderkey % 97 = 0 THEN l_extendedprice * 50 WHEN l_orderkey % 5 = 0 THEN l_extendedprice * 10 "
               "WHEN l_orderkey % 13 = 0 THEN l_extendedprice * 4 ELSE l_extendedprice END").alias("price"),
        F.expr("CASE WHEN l_orderkey % 83 = 0 THEN l_discount + 1 ELSE l_discount END").alias("disc"))


# --------------------------------------------------------------------- flows
@query
def clean_csv_flow(spark, sf_dir):
    """Flagship: bronze CSV (rendered from events) -> silver through the full CSV flow."""
    raw = with_dirt(spread_events(spark, sf_dir), EVENT_CSV, keep=())
    return flows.clean_csv(raw)


@query
def csv_stage_audit(spark, sf_dir):
    """PRF-10 / OUT-4: rows kept and removed by each stage of the CSV flow.

    The flow runs once (its result is materialised with the no-op sink); the
    per-stage counts come from ``observe`` marks, not from extra scans.
    """
    audit = profile.StageAudit()
    raw = with_dirt(table(spark, sf_dir, "events"), EVENT_CSV, keep=())
    flows.clean_csv(raw, audit=audit).write.format("noop").mode("overwrite").save()
    rows = [(i, name, int(n), int(removed)) for i, (name, n, removed) in enumerate(audit.report())]
    return spark.createDataFrame(rows, "stage_no int, stage string, rows long, removed long")


@query
def bronze_csv_flow(spark, sf_dir):
    """SNK-1 -> SRC-1/SRC-3 -> CSV flow: the bronze CSV is written as files and read back
    permissively (declared schema, corrupt-row column, source file), then cleaned."""
    raw = with_dirt(table(spark, sf_dir, "events"), EVENT_CSV, keep=())
    path = scratch_path(spark, f"bronze-csv-{uuid.uuid4().hex}")
    sinks.write_csv(raw, path)
    good, _bad = readers.split_corrupt(readers.read_csv(spark, path))
    return flows.clean_csv(good)


@query
def csv_rejects(spark, sf_dir):
    """SRC-1 / SRC-3: bronze CSV lines, some malformed (a number of fields that is not the header's); rows set aside with
    their text, by what is wrong, beside the count of the readable ones."""
    raw = with_dirt(table(spark, sf_dir, "events"), EVENT_CSV)
    cols = [c for c in raw.columns if c != "event_id"]
    fields = F.concat_ws(",", *[F.coalesce(F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"')), F.lit("")) for c in cols])
    line = F.when(F.col("event_id") % 211 == 3, F.concat(F.lit("extra,"), fields, F.lit(",1,2,3"))).when(
        F.col("event_id") % 223 == 4, F.lit("one,two")).otherwise(fields)
    path = scratch_path(spark, f"csv-lines-{uuid.uuid4().hex}")
    raw.select(line.alias("value")).write.text(path)
    scan = materialized(readers.read_csv(spark, path, header=False), "csv-parsed")
    good, bad = readers.split_corrupt(scan)
    kind = F.when(F.col("_corrupt_record").startswith("extra"), "too many fields").otherwise("too few fields")
    rejects = bad.groupBy(kind.alias("outcome")).agg(F.count("*").alias("n_rows"))
    return good.agg(F.lit("read").alias("outcome"), F.count("*").alias("n_rows")).unionByName(rejects)


def event_json_docs(spark, sf_dir, keep_id: bool = False) -> DataFrame:
    """Nested transaction documents rendered from ``events``."""
    e = spread_events(spark, sf_dir)
    x = {k: F.expr(v) for k, v in EVENT_JSON.items()}
    cardholder = F.when(~F.expr(EVENT_JSON_NULL_CARDHOLDER),
                        F.struct(x["age"].alias("age"), x["country"].alias("country")))
    return e.select(
        x["transaction_id"].alias("transaction_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        x["transaction_hour"].alias("transaction_hour"), x["amount"].alias("amount"),
        x["merchant_category"].alias("merchant_category"), cardholder.alias("cardholder"),
        F.struct(x["device_type"].alias("device_type"), x["operating_system"].alias("operating_system"),
                 x["device_trust_score"].alias("device_trust_score")).alias("device"),
        F.struct(x["velocity_last_24h"].alias("velocity_last_24h"),
                 x["ip_risk_score"].alias("ip_risk_score")).alias("network_features"),
        F.struct(x["city"].alias("city"), x["country"].alias("country"),
                 x["is_foreign_transaction"].alias("is_foreign_transaction"),
                 x["location_mismatch"].alias("location_mismatch")).alias("location"),
        F.struct(x["method"].alias("method"), x["failed_attempts"].alias("failed_attempts"))
        .alias("authentication"),
        F.struct(x["is_fraud"].alias("is_fraud")).alias("labels"),
        x["schema_version"].cast("double").alias("schema_version"),
        *(["event_id"] if keep_id else []))


@query
def bronze_json_flow(spark, sf_dir):
    """SRC-2/SRC-3 -> JSON flow: nested documents written as JSON files, read back with
    the declared nested schema (corrupt-row capture), flattened and cleaned."""
    path = scratch_path(spark, f"bronze-json-{uuid.uuid4().hex}")
    docs = event_json_docs(spark, sf_dir, keep_id=True)
    line = F.to_json(F.struct(*[c for c in docs.columns if c != "event_id"]))
    # some lines are cut short by key rule: unreadable documents the scan must survive
    line = F.when(F.expr(EVENT_JSON_TRUNCATED), F.substring(line, 1, 20)).otherwise(line)
    docs.select(line.alias("value")).write.text(path)
    good, _bad = readers.split_corrupt(readers.read_json(spark, path, multi_line=False))
    out = flows.clean_json(good)
    return out.withColumn("amount", F.round("amount", 6))


JSON_FILE_ROWS = 500  # documents in a rendered JSON file


def _json_array_files(spark, sf_dir) -> str:
    """Nested documents as files of JSON arrays over several lines: some documents are empty, every seventh file is cut off."""
    docs = event_json_docs(spark, sf_dir, keep_id=True)
    line = F.to_json(F.struct(*[c for c in docs.columns if c != "event_id"]))
    files = (docs.select(F.expr(f"event_id div {JSON_FILE_ROWS}").alias("file_no"), "event_id", line.alias("line"))
             .withColumn("line", F.when(F.col("event_id") % 89 == 5, "{}").otherwise(F.col("line")))
             .groupBy("file_no").agg(F.sort_array(F.collect_list(F.struct("event_id", "line"))).alias("d")))
    text_ = F.concat(F.lit("[\n"), F.array_join(F.col("d.line"), ",\n"), F.lit("\n]"))
    text_ = F.when(F.col("file_no") % 7 == 1, F.substring(text_, 1, 2000)).otherwise(text_)
    path = scratch_path(spark, f"json-arrays-{uuid.uuid4().hex}")
    files.select("file_no", text_.alias("value")).write.partitionBy("file_no").text(path)
    return path


def _file_no() -> F.Column:
    return F.regexp_extract("source_file", r"file_no=(\d+)", 1).cast("long")


@query
def json_file_report(spark, sf_dir):
    """SRC-2/SRC-3/SRC-6: JSON arrays over several lines, parsed file by file; rows, empty rows and rejects of each file."""
    rows, report = readers.read_json_files(spark, _json_array_files(spark, sf_dir))
    full = cleaning.drop_nulls(rows, [c for c in rows.columns if c not in ("source_file", "file_no")], "all")
    kept = full.groupBy("source_file").agg(F.count("*").alias("n"))
    return report.join(kept, "source_file", "left").select(
        _file_no().alias("file_no"), F.col("rows").alias("n_rows"),
        (F.col("rows") - F.coalesce("n", F.lit(0))).alias("n_empty"), "rejected",
        F.substring("reject_text", 1, 1).alias("reject_start"))


@query
def json_array_flow(spark, sf_dir):
    """SRC-2 -> JSON flow: the rows of the readable files, flattened and cleaned."""
    rows, _ = readers.read_json_files(spark, _json_array_files(spark, sf_dir))
    return flows.clean_json(rows.drop("file_no")).withColumn("amount", F.round("amount", 6))


@query
def clean_logs_flow(spark, sf_dir):
    """Log lines -> parse -> score -> relabel by the note's rule -> flag -> dedupe."""
    note = spark.createDataFrame([(SUPERVISOR_NOTE,)], "value string")
    out = flows.clean_logs(event_log_lines(spark, sf_dir), note)
    return out.select("transaction_id", "amount", "transaction_hour", "merchant_category",
                      "is_foreign_transaction", "location_mismatch", "device_trust_score",
                      "velocity_last_24h", "cardholder_age", "is_fraud", "ip_risk_score", "id_flag")


def _audited(spark, audit: profile.StageAudit, flow: DataFrame) -> DataFrame:
    flow.write.format("noop").mode("overwrite").save()
    rows = [(i, name, int(n), int(removed)) for i, (name, n, removed) in enumerate(audit.report())]
    return spark.createDataFrame(rows, "stage_no int, stage string, rows long, removed long")


@query
def logs_stage_audit(spark, sf_dir):
    """PRF-10 / STR-8: lines read, parsed and left by the log flow; the lines it could not parse are counted, not lost."""
    audit = profile.StageAudit()
    note = spark.createDataFrame([(SUPERVISOR_NOTE,)], "value string")
    return _audited(spark, audit, flows.clean_logs(event_log_lines(spark, sf_dir), note, audit=audit))


@query
def json_stage_audit(spark, sf_dir):
    """PRF-10 / SRC-3 / SRC-6: rows that each stage of the JSON flow leaves, with the unreadable lines and the empty rows."""
    audit = profile.StageAudit()
    docs = event_json_docs(spark, sf_dir, keep_id=True)
    line = F.to_json(F.struct(*[c for c in docs.columns if c != "event_id"]))
    line = (F.when(F.expr(EVENT_JSON_TRUNCATED), F.substring(line, 1, 20)).when(F.col("event_id") % 89 == 5, "{}").otherwise(line))
    path = scratch_path(spark, f"bronze-json-{uuid.uuid4().hex}")
    docs.select(line.alias("value")).write.text(path)
    scan = materialized(readers.read_json(spark, path, multi_line=False), "json-scan")
    return _audited(spark, audit, flows.clean_json(scan, audit=audit))


@query
def gold_union(spark, sf_dir):
    """UNI-1 over the three silver flows (CSV, JSON, logs)."""
    return flows.build_gold(csv=clean_csv_flow(spark, sf_dir).withColumn(
        "transaction_id", F.col("transaction_id").cast("string")),
        json=flows.clean_json(event_json_docs(spark, sf_dir)), logs=clean_logs_flow(spark, sf_dir))


@query
def gold_latest(spark, sf_dir):
    """Gold as the warehouse view: CSV + JSON + log silvers conformed, unified and
    merged to one row per transaction id, highest source priority winning (UNI-1/2)."""
    csv = clean_csv_flow(spark, sf_dir).withColumn("transaction_id", F.col("transaction_id").cast("string"))
    js = flows.clean_json(event_json_docs(spark, sf_dir))
    return flows.build_gold(csv=csv, json=js, logs=clean_logs_flow(spark, sf_dir), latest=True)


# ----------------------------------------------------------------- coercion
@query
def coerce_numeric(spark, sf_dir):
    d = cleaning.coerce_numeric(dirty_events(spark, sf_dir), ["raw_value"])
    return d.select("event_id", F.col("raw_value").alias("value_num"))


@query
def coerce_int(spark, sf_dir):
    d = cleaning.coerce_int(dirty_events(spark, sf_dir), ["raw_hour"])
    return d.select("event_id", F.col("raw_hour").alias("hour_int"))


@query
def coerce_bool(spark, sf_dir):
    d = dirty_events(spark, sf_dir).withColumn("flag_cast", F.col("raw_flag"))
    d = cleaning.coerce_bool(d, "raw_flag", "set")
    d = cleaning.coerce_bool(d, "flag_cast", "cast")
    return d.select("event_id", F.col("raw_flag").alias("flag_set"), "flag_cast")


@query
def bool_threshold(spark, sf_dir):
    d = coerced_events(spark, sf_dir).withColumn("score", F.col("value_num") / F.lit(500.0))
    return cleaning.bool_threshold(d, "score", 0.5, "is_high").select("event_id", "is_high")


@query
def bool_to_int(spark, sf_dir):
    return cleaning.bool_to_int(coerced_events(spark, sf_dir), ["flag"]).select("event_id", "flag")


@query
def coerce_timestamp(spark, sf_dir):
    d = cleaning.coerce_timestamp(dirty_events(spark, sf_dir), "raw_ts")
    return d.select("event_id", F.col("raw_ts").alias("ts_parsed"))


CONFORM_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType(), False),
    T.StructField("l_linenumber", T.ByteType(), True),
    T.StructField("l_quantity", T.ShortType(), True),
    T.StructField("l_extendedprice", T.ShortType(), True),
    T.StructField("l_returnflag", T.StringType(), True),
])


@query
def conform_typed(spark, sf_dir):
    c = cleaning.conform(table(spark, sf_dir, "lineitem"), CONFORM_SCHEMA)
    return c.withColumn("violations", F.array_join("_violations", ",")).drop("_violations")


@query
def flatten_nested(spark, sf_dir):
    """PRJ-9: orders+customer packed as JSON documents, parsed with a text schema, flattened."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    packed = o.join(c, o.o_custkey == c.c_custkey).select(F.to_json(F.struct(
        "o_orderkey", "o_totalprice", "o_orderstatus",
        F.struct("c_custkey", "c_name", "c_mktsegment", "c_acctbal").alias("customer"))).alias("doc"))
    leaf = T.StringType()
    schema = T.StructType([T.StructField(n, leaf) for n in ("o_orderkey", "o_totalprice", "o_orderstatus")]
                          + [T.StructField("customer", T.StructType(
                              [T.StructField(n, leaf) for n in ("c_custkey", "c_name", "c_mktsegment",
                                                                 "c_acctbal")]))])
    parsed = packed.select(F.from_json("doc", schema).alias("d")).select("d.*")
    flat = cleaning.flatten(parsed, {
        "o_orderkey": ("o_orderkey", "double"), "o_totalprice": ("o_totalprice", "double"),
        "o_orderstatus": ("o_orderstatus", "string"), "c_custkey": ("customer.c_custkey", "double"),
        "c_name": ("customer.c_name", "string"), "c_mktsegment": ("customer.c_mktsegment", "string"),
        "c_acctbal": ("customer.c_acctbal", "double")})
    return flat.withColumns({"o_orderkey": F.col("o_orderkey").cast("long"),
                             "c_custkey": F.col("c_custkey").cast("long")})


@query
def drop_sparse(spark, sf_dir):
    d = dirty_events(spark, sf_dir).select("event_id", "raw_hour", "raw_cat", "raw_sparse")
    return cleaning.drop_sparse(d, 0.5)


@query
def clamp(spark, sf_dir):
    d = cleaning.clamp_cols(coerced_events(spark, sf_dir), {"value_num": (0.0, 300.0)})
    return d.select("event_id", F.col("value_num").alias("value_clamped"))


# ------------------------------------------------------------------ filters
@query
def keep_integral(spark, sf_dir):
    d = dirty_events(spark, sf_dir).withColumn("id_num", fx.as_double("raw_id"))
    return cleaning.keep_integral(d, "id_num").select("event_id", "id_num")


@query
def keep_in(spark, sf_dir):
    return cleaning.keep_in(table(spark, sf_dir, "events"), "event_type",
                            ["click", "purchase"]).select("event_id", "event_type")


@query
def keep_at_most(spark, sf_dir):
    return cleaning.keep_at_most(coerced_events(spark, sf_dir), "hour_num", 24).select(
        "event_id", "hour_num")


@query
def clean_flag(spark, sf_dir):
    d = cleaning.clean_flag(dirty_events(spark, sf_dir), "raw_flag")
    return d.select("event_id", F.col("raw_flag").alias("flag"))


@query
def keep_between(spark, sf_dir):
    d = cleaning.keep_between(coerced_events(spark, sf_dir),
                              {"hour_num": (0, 23), "value_num": (0, 400)})
    return d.select("event_id", "hour_num", "value_num")


@query
def drop_nulls(spark, sf_dir):
    return cleaning.drop_nulls(coerced_events(spark, sf_dir), ["value_num", "hour_num"]).select(
        "event_id", "value_num", "hour_num")


@query
def validate_rows(spark, sf_dir):
    d = cleaning.validate(coerced_events(spark, sf_dir), {
        "value_range": F.col("value_num").between(0, 500),
        "hour_range": F.col("hour_num").between(0, 23),
        "flag_known": F.col("flag").isNotNull(),
    })
    return d.select("event_id", "_valid", F.array_join("_violations", ",").alias("violations"))


@query
def count_prefix(spark, sf_dir):
    return cleaning.count_prefix({"events": dirty_events(spark, sf_dir),
                                  "customer": table(spark, sf_dir, "customer")
                                  .withColumnRenamed("c_custkey", "tx_id")},
                                 "tx_id", "TX-2024-4")


# ---------------------------------------------------------------- profiling
@query
def null_counts(spark, sf_dir):
    return profile.null_counts(coerced_events(spark, sf_dir), ["value_num", "hour_num", "flag", "cat"])


@query
def null_counts_long(spark, sf_dir):
    return profile.null_counts_long(coerced_events(spark, sf_dir), ["value_num", "hour_num", "flag", "cat"])


@query
def value_counts(spark, sf_dir):
    d = text.normalize_category(dirty_events(spark, sf_dir), "raw_cat", "title", ("NAN",), "category")
    return profile.value_counts(d, "category", normalize=True)


@query
def class_balance(spark, sf_dir):
    return profile.class_balance(table(spark, sf_dir, "labels"), "toxic")


@query
def distinct_sample(spark, sf_dir):
    return profile.distinct_sample(table(spark, sf_dir, "events"), "event_type", 3)


LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query
def numeric_ranges(spark, sf_dir):
    return profile.numeric_ranges(table(spark, sf_dir, "lineitem"), LI_NUM)


@query
def summary(spark, sf_dir):
    return profile.summary(table(spark, sf_dir, "lineitem"))


@query
def summary_sketch(spark, sf_dir):
    """PRF-6 from sketches over all columns of two tables: what the sketches hold exactly (estimates are left out,
    they have no value in SQL), counts and moments of all columns."""
    out = None
    for name in ("lineitem", "documents"):
        s = profile.summary_sketch(table(spark, sf_dir, name), quartiles="cont")
        s = s.select(F.lit(name).alias("table_name"), "column_name", "count", "exact",
                     *[F.when(F.col("exact"), F.col(c)).alias(c) for c in ("unique", "top", "top_text", "freq")],
                     "mean", "std", "min", "q25", "q50", "q75", "max")
        out = s if out is None else out.unionByName(s)
    return out


@query
def outlier_report(spark, sf_dir):
    return outliers.outlier_report(dirty_lineitem(spark, sf_dir), ["qty", "price", "disc"], 1.5)


@query
def outlier_examples(spark, sf_dir):
    d = dirty_lineitem(spark, sf_dir)
    (q1, q3, lo, hi), = [outliers.fence_values(d, ["price"], 3.0)["price"]]
    return outliers.outlier_examples(d, "price", lo, hi, 10).select("l_orderkey", "l_linenumber", "price")


@query
def box_stats(spark, sf_dir):
    return outliers.box_stats(table(spark, sf_dir, "documents"), ["n_chars"])


@query
def fences(spark, sf_dir):
    return outliers.fences(dirty_lineitem(spark, sf_dir), ["qty", "price", "disc"], 1.5, "cont")


@query
def fences_disc(spark, sf_dir):
    return outliers.fences(dirty_lineitem(spark, sf_dir), ["qty", "price", "disc"], 1.5, "disc")


@query
def duplicate_keys(spark, sf_dir):
    return profile.duplicate_keys(table(spark, sf_dir, "documents"), ["text"])


@query
def duplicate_rows(spark, sf_dir):
    return profile.duplicate_rows(table(spark, sf_dir, "documents"), ["text", "lang", "source"])


@query
def corr_matrix(spark, sf_dir):
    return profile.corr_matrix(table(spark, sf_dir, "lineitem"), LI_NUM)


@query
def label_correlations(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn(
        "is_returned", (F.col("l_returnflag") == "R").cast("int"))
    return profile.label_correlations(li, "is_returned", LI_NUM)


GOLD_CATEGORIES = ["click", "error", "purchase", "signup", "view"]  # fixed values: categories of the gold table
GOLD_SOURCES = ["csv", "json", "logs"]


def _gold_frame(spark, sf_dir):
    """ENC-4/ENC-5: the gold table as a model frame (row_id and numbers): one-hot columns of category and source,
    rows with a null dropped."""
    gold = gold_union(spark, sf_dir).withColumn("row_id", F.concat_ws("-", "source", "transaction_id"))
    wide = encode.one_hot(gold, "merchant_category", GOLD_CATEGORIES, prefix="cat")
    wide = encode.one_hot(wide, "source", GOLD_SOURCES, prefix="src")
    return materialized(encode.model_frame(wide, drop=["transaction_id", "priority"], keep=["row_id"]), "gold-frame")


@query
def corr_gold(spark, sf_dir):
    """PRF-14 over all numeric and one-hot columns of the gold frame, from one Gram matrix."""
    return profile.corr_gram(_gold_frame(spark, sf_dir).drop("row_id"))


@query
def label_corr_gold(spark, sf_dir):
    """PRF-15 over the gold frame: every column against the label."""
    return profile.label_gram(_gold_frame(spark, sf_dir).drop("row_id"), "is_fraud")


# ------------------------------------------------------------ imputation
@query
def fill_const(spark, sf_dir):
    d = impute.fill_const(coerced_events(spark, sf_dir), {"value_num": 0.0, "cat": "unknown"})
    return d.select("event_id", "value_num", "cat")


@query
def fill_median(spark, sf_dir):
    d = impute.fill_median(coerced_events(spark, sf_dir), ["value_num", "hour_num"], "cont")
    return d.select("event_id", F.round("value_num", 6).alias("value_num"),
                    F.round("hour_num", 6).alias("hour_num"))


@query
def fill_mean(spark, sf_dir):
    d = impute.fill_mean(coerced_events(spark, sf_dir), ["value_num"])
    return d.select("event_id", F.round("value_num", 6).alias("value_num"))


@query
def fill_mode(spark, sf_dir):
    d = text.normalize_category(dirty_events(spark, sf_dir), "raw_cat", "lower", ("NAN",), "cat")
    return impute.fill_mode(d, "cat").select("event_id", "cat")


@query
def null_if(spark, sf_dir):
    return impute.null_if(dirty_events(spark, sf_dir), "raw_cat", ["NAN"]).select(
        "event_id", F.col("raw_cat").alias("cat"))


# ---------------------------------------------------------------- outliers
@query
def iqr_filter_sequential(spark, sf_dir):
    d = outliers.iqr_filter(dirty_lineitem(spark, sf_dir), ["qty", "price", "disc"],
                            {"qty": 1.5, "price": 3.0, "disc": 1.5}, sequential=True)
    return d.select("l_orderkey", "l_linenumber")


@query
def iqr_filter_simultaneous(spark, sf_dir):
    d = outliers.iqr_filter(dirty_lineitem(spark, sf_dir), ["qty", "price", "disc"],
                            {"qty": 1.5, "price": 3.0, "disc": 1.5}, sequential=False)
    return d.select("l_orderkey", "l_linenumber")


# -------------------------------------------------------------------- text
@query
def normalize_category(spark, sf_dir):
    d = text.normalize_category(dirty_events(spark, sf_dir), "raw_cat", "title", ("NAN",), "category")
    return d.select("event_id", "category")


# Segment synonyms for the category map query.
SEGMENT_SYNONYMS = {"automobile": "auto", "machinery": "industrial", "building": "construction"}


@query
def map_category(spark, sf_dir):
    c = text.map_category(table(spark, sf_dir, "customer"), "c_mktsegment", SEGMENT_SYNONYMS, "segment")
    return c.select("c_custkey", "segment")


@query
def blank_to_null(spark, sf_dir):
    return text.blank_to_null(dirty_events(spark, sf_dir), ["raw_cat"]).select(
        "event_id", F.col("raw_cat").alias("cat"))


def _parsed_events(spark, sf_dir):
    return text.split_unparsed(text.parse_logs(event_log_lines(spark, sf_dir)))[0]


@query
def parse_logs(spark, sf_dir):
    """SRC-4 / STR-5..7: the lines are written as text files, read back and parsed."""
    path = scratch_path(spark, f"log-lines-{uuid.uuid4().hex}")
    event_log_lines(spark, sf_dir).write.text(path)
    return text.split_unparsed(text.parse_logs(readers.read_lines(spark, path)))[0]


@query
def unparsed_lines(spark, sf_dir):
    """STR-8: the lines without an id or an amount, as they came."""
    return text.split_unparsed(text.parse_logs(event_log_lines(spark, sf_dir), keep=["value"]))[1].select("value")


# ------------------------------------------------------------------- rules


@query
def risk_score(spark, sf_dir):
    d = rules.risk_band(rules.risk_score(_parsed_events(spark, sf_dir)))
    return d.select("transaction_id", "risk_score", "risk_band")


@query
def relabel_by_prefix(spark, sf_dir):
    note = spark.createDataFrame([(SUPERVISOR_NOTE,)], "value string")
    d = rules.relabel_by_prefix(_parsed_events(spark, sf_dir), "transaction_id",
                                rules.rules_from_text(note), "is_fraud", True)
    return d.select("transaction_id", "is_fraud")


@query
def relabel_rule_table(spark, sf_dir):
    """SCR-3 with a rule table too large to inline (1,000 prefixes derived from ``orders``):
    applied as an equi-join on the id prefix, never as a nested-loop match."""
    rule_tab = table(spark, sf_dir, "orders").select(
        F.format_string("TX-2024-0%05d", F.col("o_orderkey") % 1000).alias("prefix"))
    d = rules.relabel_by_prefix(_parsed_events(spark, sf_dir), "transaction_id", rule_tab, "is_fraud", True)
    return d.select("transaction_id", "is_fraud")


@query
def prefix_flag(spark, sf_dir):
    return rules.prefix_flag(dirty_events(spark, sf_dir), "tx_id", "TX-2024-4").select("tx_id", "id_flag")


# -------------------------------------------------------------------- keys
@query
def dedupe_rows(spark, sf_dir):
    return keys.dedupe(table(spark, sf_dir, "documents").select("text", "lang", "source"))


@query
def dedupe_by_key(spark, sf_dir):
    d = keys.dedupe(table(spark, sf_dir, "documents"), ["text"], order=["doc_id"])
    return d.select("doc_id", F.md5("text").alias("text_md5"), "lang", "source", "n_chars")


@query
def resequence(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return keys.resequence(o, ["o_orderdate", "o_orderkey"], "seq").select("o_orderkey", "seq")


@query
def velocity_last_24h(spark, sf_dir):
    """X-2: events and their value of each user within the 24 hours up to each event."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.round("value", 2).alias("value"))
    v = velocity.velocity(e, "user_id", "ts", "value", 24)
    return v.select("event_id", "velocity", F.col("amount_in_range").cast("double").alias("amount_in_range"))


# ------------------------------------------------------------------- unify
ORDER_GOLD = T.StructType([T.StructField("order_id", T.StringType()),
                           T.StructField("amount", T.DoubleType()),
                           T.StructField("status", T.StringType())])


def _order_sources(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    s1 = o.select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("amount"),
                  F.col("o_orderstatus").alias("status"))
    s2 = o.where(F.col("o_orderstatus") == "O").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        (F.col("o_totalprice") * 2).alias("amount"), F.lit("O-json").alias("status"))
    s3 = o.where(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_orderkey").alias("order_id"), (F.col("o_totalprice") + 1).alias("amount"),
        F.lit(None).cast("string").alias("status"))
    return {"csv": (s1, 1), "json": (s2, 2), "logs": (s3, 3)}


@query
def unify_sources(spark, sf_dir):
    return unify.unify(_order_sources(spark, sf_dir), ORDER_GOLD)


@query
def unify_latest(spark, sf_dir):
    return unify.unify_latest(unify_sources(spark, sf_dir), "order_id", "priority")


@query
def unify_latest_columns(spark, sf_dir):
    return unify.unify_latest(unify_sources(spark, sf_dir), "order_id", "priority", mode="column")


@query
def view_sql(spark, sf_dir):
    """UNI-3 + SQL-1: the merged view registered and queried with SQL."""
    unify.register_view(unify_latest(spark, sf_dir), "orders_unified")
    return spark.sql("SELECT source, count(*) AS n_rows, max(amount) AS max_amount "
                     "FROM orders_unified GROUP BY source")


@query
def view_uniqueness(spark, sf_dir):
    """UNI-4: the merged view has no repeated key (expected: no rows)."""
    return profile.duplicate_keys(unify_latest(spark, sf_dir), ["order_id"])


# --------------------------------------------------------------- snapshots
def _customer(spark, sf_dir):
    return table(spark, sf_dir, "customer")


def _upsert_target(spark, sf_dir):
    """All customers, some without a name."""
    return _customer(spark, sf_dir).withColumn("c_name", F.expr("CASE WHEN c_custkey % 11 <> 0 THEN c_name END"))


def _upsert_source(spark, sf_dir):
    """All customers: some new, some with another balance, some whose segment has moved to the empty name, the rest equal."""
    return _customer(spark, sf_dir).select(
        F.expr("CASE WHEN c_custkey % 7 = 0 THEN c_custkey + 10000000 ELSE c_custkey END").alias("c_custkey"),
        F.expr("CASE WHEN c_custkey % 11 = 0 THEN c_mktsegment ELSE c_name END").alias("c_name"), "c_nationkey",
        F.expr("CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 100 ELSE c_acctbal END").alias("c_acctbal"),
        F.expr("CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END").alias("c_mktsegment"))


@query
def upsert(spark, sf_dir):
    return snapshots.upsert(_upsert_target(spark, sf_dir), _upsert_source(spark, sf_dir), ["c_custkey"])


@query
def update_where(spark, sf_dir):
    return snapshots.update(_customer(spark, sf_dir), F.col("c_acctbal") < 0,
                            {"c_acctbal": 0.0, "c_mktsegment": F.lit("DEBTOR")})


@query
def delete_where(spark, sf_dir):
    return snapshots.delete(_customer(spark, sf_dir), F.col("c_mktsegment") == "AUTOMOBILE")


@query
def append_conformed(spark, sf_dir):
    c = _customer(spark, sf_dir)
    new = c.where(F.col("c_nationkey") >= 20).select(
        (F.col("c_custkey") + 1000000).cast("string").alias("c_custkey"), "c_name",
        F.col("c_nationkey").cast("string").alias("c_nationkey"),
        F.col("c_acctbal").cast("string").alias("c_acctbal"), "c_mktsegment")
    repaired = cleaning.conform(new, c.schema, violations=None)
    return c.unionByName(repaired)


@query
def append_gate(spark, sf_dir):
    """MUT-1: a batch with the table's schema and one with other columns; accepted rows and the report on the other."""
    c = _customer(spark, sf_dir)
    good = c.where(F.col("c_nationkey") >= 20).withColumn("c_custkey", F.col("c_custkey") + 1000000)
    bad = good.select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_name", "c_nationkey",
                      F.lit(1).alias("c_extra"), "c_mktsegment")
    grown, report = snapshots.append_batches(c, {"good": good, "bad": bad})
    rows = grown.groupBy(F.when(F.col("c_custkey") > 1000000, "good").otherwise("table").alias("batch")).agg(
        F.count("*").alias("n_rows"))
    return rows.join(report, "batch", "full").select(
        "batch", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "accepted", "column_name", "table_type", "incoming_type")


@query
def diff_versions(spark, sf_dir):
    new = snapshots.delete(upsert(spark, sf_dir), F.col("c_custkey") % 17 == 0)
    return snapshots.diff_versions(_upsert_target(spark, sf_dir), new, ["c_custkey"])


# --------------------------------------------------------------- encoding
@query
def index_category(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return encode.index_category(e, "event_type", "event_type_idx").select("event_id", "event_type_idx")


@query
def one_hot(spark, sf_dir):
    return encode.one_hot(_customer(spark, sf_dir).select("c_custkey", "c_mktsegment"),
                          "c_mktsegment", prefix="seg")


@query
def index_hour(spark, sf_dir):
    """ENC-2: the numeric hour of the silver CSV as a frequency index; hours that do not occur, and null, get the next number."""
    silver = clean_csv_flow(spark, sf_dir).select("transaction_id", "transaction_hour")
    e = table(spark, sf_dir, "events").select("event_id", F.hour("ts").alias("transaction_hour"))
    index = encode.fit_index(silver, "transaction_hour")
    other = F.when(F.col("event_id") % 50 == 0, 99).when(F.col("event_id") % 50 == 1, None).otherwise(F.col("transaction_hour"))
    return encode.index_category(e.withColumn("transaction_hour", other), "transaction_hour", "hour_idx", index).select(
        "event_id", "hour_idx")


# --------------------------------------------------------------- modelling
def _labels_split(spark, sf_dir):
    return model.stratified_split(table(spark, sf_dir, "labels"), "toxic", "doc_id", 0.2, 42)


@query
def stratified_split(spark, sf_dir):
    return _labels_split(spark, sf_dir).select("doc_id", "toxic", "split")


@query
def split_report(spark, sf_dir):
    return model.split_report(_labels_split(spark, sf_dir), "toxic")


@query
def rebalance(spark, sf_dir):
    return model.rebalance(table(spark, sf_dir, "labels"), "toxic", "doc_id", 0.15).select("doc_id", "toxic")


def _rule_predictions(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    doc = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return lab.join(doc, "doc_id").withColumn("prediction", (F.col("n_chars") >= 2000).cast("int"))


@query
def confusion_matrix(spark, sf_dir):
    return model.confusion_matrix(_rule_predictions(spark, sf_dir), "quality", "prediction", [0, 1])


@query
def classification_report(spark, sf_dir):
    return model.classification_report(_rule_predictions(spark, sf_dir), "quality", "prediction", [0, 1])


@query
def prediction_counts(spark, sf_dir):
    return model.prediction_counts(_rule_predictions(spark, sf_dir), "quality", "prediction")


TREE_FEATURES = ["amount", "transaction_hour", "foreign_transaction", "location_mismatch", "device_trust_score",
                 "velocity_last_24h", "cardholder_age", *[f"cat_{c}" for c in GOLD_CATEGORIES]]


def _planted(spark, sf_dir):
    """The gold model frame with a label that is a threshold on one column, so that the best tree is known."""
    return _gold_frame(spark, sf_dir).withColumn("label", (F.col("transaction_hour") > 11).cast("int"))


@query
def tree_cv(spark, sf_dir):
    """MOD-3/4: impurity {gini, entropy} x depth 1..6, 5-fold CV on the gold frame; scores and best point."""
    cvm, grid = model.fit_tree(_planted(spark, sf_dir), TREE_FEATURES, "label", "row_id")
    return model.cv_results(spark, cvm, grid)


@query
def tree_importances(spark, sf_dir):
    """MOD-3/5/9: best tree of the full grid on the gold frame, top-10 importances."""
    cvm, _ = model.fit_tree(_planted(spark, sf_dir), TREE_FEATURES, "label", "row_id")
    return model.feature_importances(spark, cvm, TREE_FEATURES, 10)


# ----------------------------------------------------------------- sources
# Event types that must have arrived (one is never produced).
EXPECTED_EVENT_TYPES = ["click", "error", "purchase", "refund", "signup", "view"]


@query
def load_audit(spark, sf_dir):
    return readers.audit_loaded(table(spark, sf_dir, "events"), EXPECTED_EVENT_TYPES, "event_type")


TYPED_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("big_id", T.LongType()),
                             T.StructField("hour", T.ByteType())])


def _untyped_events(spark, sf_dir):
    """Dirty events with long ids; a third of the rows share one hour, the order key of the load."""
    d = dirty_events(spark, sf_dir).select("event_id", F.col("raw_id").alias("big_id"), F.col("raw_hour").alias("hour"))
    big = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("900719925474"), F.lpad(F.col("event_id").cast("string"), 7, "0")))
    hot = F.when(F.col("event_id") % 3 == 1, F.lit("12")).otherwise(F.col("hour"))
    return d.withColumns({"big_id": F.coalesce(big, F.col("big_id")), "hour": hot})


@query
def typed_load(spark, sf_dir):
    """SNK-2 / SNK-5: dirty events loaded by type and order key, read back, beside the quarantined rows."""
    path, aside = (scratch_path(spark, f"{x}-{uuid.uuid4().hex}") for x in ("typed-load", "typed-aside"))
    sinks.load_typed(_untyped_events(spark, sf_dir), path, TYPED_SCHEMA, ["hour"], quarantine_path=aside)
    good, bad = readers.read_parquet(spark, path), readers.read_parquet(spark, aside)
    return good.select("event_id", "big_id", "hour", F.lit("").alias("violations")).unionByName(
        bad.select("event_id", "big_id", "hour", F.array_join("_violations", ",").alias("violations")))


@query
def typed_load_skipping(spark, sf_dir):
    """SNK-5: the rows of an hour range in the loaded table lie in few of its files (8 written, ranges of the order key)."""
    path = scratch_path(spark, f"typed-skip-{uuid.uuid4().hex}")
    sinks.load_typed(_untyped_events(spark, sf_dir), path, TYPED_SCHEMA, ["hour"], partitions=8)
    back = readers.read_parquet(spark, path)
    out = None
    for lo, hi in ((0, 2), (12, 12), (20, 23)):
        part = sinks.files_holding(back, F.col("hour").between(lo, hi)).select(
            F.lit(lo).alias("from_hour"), F.lit(hi).alias("to_hour"), "n_rows", (F.col("n_files") <= 5).alias("few_files"))
        out = part if out is None else out.unionByName(part)
    return out


@query
def bucketed_join(spark, sf_dir):
    """SRC-9 / SNK-5: two catalog tables with equal buckets, joined on the bucket key without an exchange of their rows."""
    tag = uuid.uuid4().hex
    names = {}
    for name, key in (("orders", "o_custkey"), ("customer", "c_custkey")):
        names[name] = sinks.save_bucketed(table(spark, sf_dir, name), f"bucketed_{name}_{tag}", [key], 8,
                                          scratch_path(spark, f"bucketed-{name}-{tag}"))
    o, c = names["orders"], names["customer"]
    return (o.join(c.hint("merge"), o.o_custkey == c.c_custkey).groupBy("c_custkey", "c_mktsegment")
            .agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total")))


@query
def shared_index(spark, sf_dir):
    """ENC-2 / ENC-3: one index over the segments of customers and the priorities of orders, applied to both."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("cat"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.expr(
        "CASE WHEN o_orderkey % 3 = 0 THEN 'BUILDING' WHEN o_orderkey % 50 = 1 THEN NULL ELSE o_orderpriority END").alias("cat"))
    index = encode.fit_index([c, o], "cat")
    both = [encode.index_category(d, "cat", "idx", index).select(F.lit(n).alias("side"), "key", "idx")
            for n, d in (("customer", c), ("orders", o))]
    return both[0].unionByName(both[1])


@query
def model_chain(spark, sf_dir):
    """ENC-4..6, MOD-1..8 from gold: model frame, stratified split, full grid search (depths 1-6, 5 folds) on the training
    part, prediction of both parts, counts."""
    split = model.stratified_split(_planted(spark, sf_dir), "label", "row_id", 0.2, 42)
    cvm, _ = model.fit_tree(split.where("split = 'train'"), TREE_FEATURES, "label", "row_id")
    scored = model.predict(cvm, split, TREE_FEATURES)
    return scored.groupBy("split", "label", F.col("prediction").cast("int").alias("prediction")).agg(
        F.count("*").alias("n"))


def _planted_lineitem(spark, sf_dir):
    """Rows whose label is a threshold on one column, read straight from a table."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("row_id"), *LI_NUM,
                     (F.col("l_quantity") > 25).cast("int").alias("label"))


@query
def tree_rule_table(spark, sf_dir):
    """MOD-10: a fitted tree as a node table and as one SQL expression; its predictions beside those of the model, counted."""
    frame = _planted_lineitem(spark, sf_dir)
    cvm, _ = model.fit_tree(frame, LI_NUM, "label", "row_id", impurities=["gini"], depths=[3], folds=2)
    nodes = model.tree_table(spark, cvm, LI_NUM).collect()  # as many rows as the tree has nodes
    scored = model.predict(cvm, frame, LI_NUM).withColumn("by_rules", F.expr(model.tree_expression(nodes)))
    return scored.groupBy("label", F.col("prediction").cast("int").alias("by_model"),
                          F.col("by_rules").cast("int").alias("by_rules")).agg(F.count("*").alias("n"))


@query
def tree_leaves(spark, sf_dir):
    """MOD-10: leaves of the tree fitted to the planted label, by predicted class, read from its rules."""
    cvm, _ = model.fit_tree(_planted_lineitem(spark, sf_dir), LI_NUM, "label", "row_id", impurities=["gini"], depths=[1], folds=2)
    rules_ = model.tree_rules(spark, cvm)
    leaf = F.regexp_extract("rule", r"Predict: ([0-9.]+)", 1)
    return (rules_.where(leaf != "").groupBy(leaf.cast("double").cast("int").alias("prediction"))
            .agg(F.count("*").alias("leaves")))
