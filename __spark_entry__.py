"""The queries of this repository on the shared test tables, and the same in SQL.

``events(event_id, ts, user_id, event_type, value, props)`` plays the ad stream:
a view is an impression, a click a click, a purchase or signup a conversion. The
table holds no NULL and no duplicate, so queries that need them make the user of
every ``error`` event NULL and cut times to the hour or day.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconmill import operators as ops
from beaconmill import plans, schemas
from beaconmill.scratch import scratch_dir
from beaconmill.sources import SourceSpec, read_csv_strings, read_json_strings, read_source, source_spec, split_malformed
from beaconmill.streaming import close_stream, stream_correlated, stream_deduplicated, stream_load

try:  # the operators for training data may be left out of an installation
    import corpus_pipeline
    from beaconmill.llm import queries as llm
except ImportError:
    LLM_QUERIES, LLM_SQL = {}, {}
else:
    LLM_QUERIES, LLM_SQL = {**llm.QUERIES, "pipeline": corpus_pipeline.run}, dict(llm.ORACLE_SQL)

LOAD_TS = "2024-06-01 00:00:00"
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"  # the JSON writer cuts to milliseconds by default


def entry(spark: SparkSession) -> DataFrame:
    return analytical(spark, "/root/testdata/sf0.001")


# ---------------------------------------------------------------- inputs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def of_type(df: DataFrame, *types: str) -> DataFrame:
    return df.filter(F.col("event_type").isin(*types))


def cut(unit: str):
    return F.date_trunc(unit, "ts").alias("timestamp")


def staged_events(spark: SparkSession, sf_dir: str, unit: str) -> DataFrame:
    """All events as staging holds them: strings, but for the arrival time."""
    return ops.stringify(
        events(spark, sf_dir).select(
            F.expr("case when event_type <> 'error' then concat('user', user_id) end").alias("user_id"),
            cut(unit),
            F.col("event_id").alias("ad_creative_id"),
            F.col("event_type").alias("website"),
            "ts",
        )
    ).withColumns({"load_date": F.col("ts").cast("timestamp")}).drop("ts")


def ntz(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the test tables and the SQL have them."""
    casts = {
        f.name: F.col(f.name).cast("timestamp_ntz")
        for f in df.schema.fields
        if f.dataType.typeName() == "timestamp"
    }
    return df.withColumns(casts) if casts else df


# ---------------------------------------------------------------- sources and sinks


def scan_parquet(spark, sf_dir):
    return plans.read_layer(spark, f"{sf_dir}/events.parquet")


def scan_csv(spark, sf_dir):
    path = scratch_dir(spark, "csv")
    ops.stringify(events(spark, sf_dir)).write.csv(path, header=True)
    return read_source(spark, SourceSpec("events", "csv", path, options={"header": True}))


def scan_json(spark, sf_dir):
    path = scratch_dir(spark, "json")
    events(spark, sf_dir).write.option("timestampNTZFormat", MICROS).json(path)
    return read_source(spark, SourceSpec("events", "json", path))


def scan_json_multiline(spark, sf_dir):
    """All events as files of one array each, a thousand events to a file."""
    path = scratch_dir(spark, "json")
    row = F.to_json(F.struct("*"), {"timestampNTZFormat": MICROS})
    arrays = events(spark, sf_dir).select(F.expr("event_id div 1000").alias("file"), row.alias("row")).groupBy("file").agg(
        F.concat(F.lit("[\n"), F.array_join(F.collect_list("row"), ",\n"), F.lit("\n]")).alias("value")
    )
    arrays.write.partitionBy("file").text(path)
    return read_source(spark, SourceSpec("events", "json", path, options={"multiLine": True})).drop("file")


def scan_json_mixed(spark, sf_dir):
    """All events in one folder: an object to a line, arrays over many lines of what sixty thousand events have, and to a line of what a thousand have."""
    path = scratch_dir(spark, "json")
    df = events(spark, sf_dir)
    row = F.to_json(F.struct("*"), {"timestampNTZFormat": MICROS})
    df.filter("event_id % 3 = 0").select(row.alias("value")).write.text(f"{path}/lines")
    for n, (events_each, first, between, last) in enumerate(((60_000, "[\n", ",\n", "\n]"), (1000, "[", ", ", "]")), 1):
        grouped = df.filter(f"event_id % 3 = {n}").select(F.expr(f"event_id div {events_each}").alias("file"), row.alias("row")).groupBy("file")
        arrays = grouped.agg(F.concat(F.lit(first), F.array_join(F.collect_list("row"), between), F.lit(last)).alias("value"))
        # an array over many lines is a file by itself; those of one line share files
        (arrays.write.partitionBy("file") if n == 1 else arrays.select("value").write).text(f"{path}/arrays{n}")
    spec = SourceSpec("events", "json", path, df.schema, {"layout": "mixed"})
    return read_source(spark, spec)


def scan_json_schema_file(spark, sf_dir):
    """As strings, with the schema read from a file."""
    path = scratch_dir(spark, "json")
    df = events(spark, sf_dir)
    df.write.option("timestampNTZFormat", MICROS).json(f"{path}/data")
    spark.createDataFrame([(df.schema.json(),)], "value string").coalesce(1).write.text(f"{path}/schema")
    return read_json_strings(spark, f"{path}/data", schema_file=f"{path}/schema")


def scan_json_avsc(spark, sf_dir):
    """As strings, with the schema of an Avro document, as producers ship it."""
    path = scratch_dir(spark, "json")
    df = events(spark, sf_dir)
    df.write.option("timestampNTZFormat", MICROS).json(f"{path}/data")
    fields = [
        {"name": "event_id", "type": "long"},
        {"name": "ts", "type": {"type": "long", "logicalType": "local-timestamp-micros"}},
        {"name": "user_id", "type": ["null", "long"], "default": None},
        {"name": "event_type", "type": {"type": "enum", "name": "kind", "symbols": ["view", "click", "purchase", "signup", "error"]}},
        {"name": "value", "type": ["null", "double"]},
        {"name": "props", "type": "string"},
    ]
    document = json.dumps({"type": "record", "name": "event", "namespace": "ads", "fields": fields})
    spark.createDataFrame([(document,)], "value string").coalesce(1).write.text(f"{path}/schema")
    return read_json_strings(spark, f"{path}/data", schema_file=f"{path}/schema")


def scan_csv_no_header(spark, sf_dir):
    path = scratch_dir(spark, "csv")
    ops.stringify(events(spark, sf_dir)).write.csv(path)
    return read_csv_strings(spark, path, header=False)


def scan_json_schema(spark, sf_dir):
    path = scratch_dir(spark, "json")
    df = events(spark, sf_dir)
    df.write.option("timestampNTZFormat", MICROS).json(path)
    return read_source(spark, SourceSpec("events", "json", path, df.schema))


def quarantine(spark, sf_dir):
    path = scratch_dir(spark, "json")
    good = F.to_json(F.struct("event_id", "event_type"))
    broken = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"))
    line = F.when(F.col("event_type") == "error", broken).otherwise(good)
    events(spark, sf_dir).select(line.alias("value")).write.text(path)
    spec = SourceSpec("events", "json", path, "event_id bigint, event_type string")
    good_rows, bad_rows = split_malformed(read_source(spark, spec, keep_malformed=True))
    return good_rows.withColumn("raw", F.lit(None).cast("string")).unionByName(
        bad_rows.select("event_id", "event_type", F.col(schemas.MALFORMED).alias("raw"))
    )


def sink_overwrite(spark, sf_dir):
    path = scratch_dir(spark, "sink")
    df = events(spark, sf_dir)
    plans.overwrite(df, path)
    plans.overwrite(df, path)
    return plans.read_layer(spark, path).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


def sink_append(spark, sf_dir):
    path = scratch_dir(spark, "sink")
    df = events(spark, sf_dir)
    plans.overwrite(df, path)
    plans.append(df, path)
    return plans.read_layer(spark, path).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- projections and filters


def stringify_all(spark, sf_dir):
    return ops.stringify(events(spark, sf_dir))


def stringify_lineitem(spark, sf_dir):
    return ops.stringify(table(spark, sf_dir, "lineitem"))


def flatten_json(spark, sf_dir):
    df = events(spark, sf_dir).select("event_id", F.from_json("props", "k int").alias("props"))
    return ops.flatten(df, prefix=True)


def flatten_struct(spark, sf_dir):
    df = events(spark, sf_dir)
    nested = df.select(
        F.struct("user_id", F.struct("event_type", "value").alias("what")).alias("who"),
        F.struct("event_id", "ts").alias("event"),
        "props",
    )
    return ops.flatten(nested)


def cast_timestamp(spark, sf_dir):
    text = F.expr("case when event_type = 'error' then 'no time' else cast(ts as string) end")
    df = events(spark, sf_dir).select("event_id", text.alias("timestamp"))
    return ntz(ops.convert_types(df))


def standardize_constant(spark, sf_dir):
    df = events(spark, sf_dir).select("event_id", F.col("event_type").alias("website"))
    return ops.standardize(df)


def upper_user_id(spark, sf_dir):
    df = events(spark, sf_dir).select("event_id", F.expr("concat('user', user_id)").alias("user_id"))
    return ops.uppercase(df)


def filter_not_null(spark, sf_dir):
    df = events(spark, sf_dir).withColumn("event_type", F.expr("nullif(event_type, 'error')"))
    return ops.drop_null_keys(df, ["event_type"])


def incremental_filter(spark, sf_dir):
    return ops.newer_than(events(spark, sf_dir), "2024-01-29", "ts")


def rename_columns(spark, sf_dir):
    df = events(spark, sf_dir).select(
        F.col("ts").alias("Event Timestamp"),
        F.col("user_id").alias("User ID"),
        F.col("props").alias("Ad Campaign ID"),
        F.col("event_type").alias("Conversion Type"),
        "event_id",
    )
    return ops.rename_interactions(df)


def derive_event_ids(spark, sf_dir):
    return ops.clicks_of(interactions(spark, sf_dir))


def derive_conversion_ids(spark, sf_dir):
    return ops.conversions_of(interactions(spark, sf_dir))


def interactions(spark, sf_dir):
    return ops.stringify(
        of_type(events(spark, sf_dir), "click", "purchase", "signup").select(
            F.col("ts").alias("timestamp"),
            "user_id",
            F.col("props").alias("ad_campaign_id"),
            F.expr("nullif(event_type, 'click')").alias("conversion_type"),
        )
    )


# ---------------------------------------------------------------- deduplication and versions


def dedup_keys(spark, sf_dir):
    return ntz(ops.deduplicate(events(spark, sf_dir).select("user_id", cut("hour"))))


def dedup_keep_latest(spark, sf_dir):
    df = events(spark, sf_dir).select("*", cut("hour"))
    return ntz(ops.deduplicate(df, order_by=[F.desc("ts"), F.desc("event_id")]))


def dedup_ties(spark, sf_dir):
    """The given order leaves ties, which the other columns settle."""
    df = events(spark, sf_dir).select("*", cut("day"))
    return ntz(ops.deduplicate(df, order_by=[F.desc("event_type")]))


def dedup_lineitem(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    newest = [F.desc("l_shipdate"), F.desc("l_orderkey"), F.desc("l_linenumber")]
    return ops.deduplicate(df, ["l_partkey", "l_suppkey"], newest)


def scd_columns(spark, sf_dir):
    df = events(spark, sf_dir).select("event_id", "user_id")
    return ntz(ops.stamp_version(df, LOAD_TS))


def scd2_current(spark, sf_dir):
    df = events(spark, sf_dir)
    newest = [F.desc("ts"), F.desc("event_id")]
    loads = [
        ops.stamp_version(ops.deduplicate(part, ["user_id"], newest), day)
        for part, day in (
            (df.filter("ts < timestamp_ntz'2024-01-16'"), "2024-01-16"),
            (df.filter("ts >= timestamp_ntz'2024-01-16'"), "2024-01-31"),
        )
    ]
    return ntz(ops.close_out(loads[0].union(loads[1]), ["user_id"]))


def scd2_ties(spark, sf_dir):
    """Two loads with one load date: still one current row per key."""
    df = events(spark, sf_dir)
    loads = ops.stamp_version(df, LOAD_TS).unionByName(ops.stamp_version(df.filter("event_type = 'click'"), LOAD_TS))
    closed = ops.close_out(loads, ["user_id"])
    return closed.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_versions"), F.count_if("is_current").alias("n_current")
    )


def version_as_of(spark, sf_dir):
    """Views with the click that was a user's newest at the time; a third of both belongs to one user."""
    df = events(spark, sf_dir).withColumn("user_id", F.expr("if(event_id % 3 = 0, 0, user_id)"))
    clicks = of_type(df, "click").select("user_id", F.col("ts").alias("load_date"), F.col("event_id").alias("version_id"))
    views = of_type(df, "view").select("event_id", "user_id", F.col("ts").alias("timestamp"))
    return ops.as_of(views, ops.validity(clicks, ["user_id"]), ["user_id"], "timestamp", ["version_id", "valid_from", "valid_to"])


def close_versions(spark, sf_dir):
    """As a job, from one path to another."""
    root = scratch_dir(spark, "versions")
    newest = [F.desc("ts"), F.desc("event_id")]
    for part, day in (("ts < timestamp_ntz'2024-01-16'", "2024-01-16"), ("ts >= timestamp_ntz'2024-01-16'", "2024-01-31")):
        rows = ops.deduplicate(events(spark, sf_dir).filter(part), ["user_id"], newest)
        plans.append(ops.stamp_version(rows, day), f"{root}/loaded")
    plans.close_versions(spark, f"{root}/loaded", f"{root}/closed", ["user_id"])
    return ntz(plans.read_layer(spark, f"{root}/closed"))


def incremental_anti_join(spark, sf_dir):
    """User and hour of all views but those with any other event in the hour."""
    df = events(spark, sf_dir).select("user_id", cut("hour"), "event_type")
    incoming = ops.deduplicate(of_type(df, "view").drop("event_type"))
    return ntz(ops.not_loaded(incoming, df.filter("event_type <> 'view'")))


# ---------------------------------------------------------------- correlation and attribution


def views_and(spark, sf_dir, kind, unit, id_column):
    time = cut(unit) if unit else F.col("ts").alias("timestamp")
    df = events(spark, sf_dir)
    views = of_type(df, "view").select("event_id", "user_id", time, "value")
    others = of_type(df, kind).select("user_id", time, F.col("event_id").alias(id_column))
    return views, others


def correlate_clicks(spark, sf_dir):
    views, clicks = views_and(spark, sf_dir, "click", "day", "click_id")
    return ntz(ops.correlate(views, clicks, "click_id"))


def correlate_conversions(spark, sf_dir):
    views, conversions = views_and(spark, sf_dir, "purchase", "day", "conversion_id")
    return ntz(ops.correlate(views, conversions, "conversion_id"))


def correlate_exact(spark, sf_dir):
    views, clicks = views_and(spark, sf_dir, "click", None, "click_id")
    return ops.correlate(views, clicks, "click_id")


def correlate_hot_keys(spark, sf_dir):
    """A third of the views and of the clicks belong to one user."""
    df = events(spark, sf_dir).withColumn("user_id", F.expr("if(event_id % 3 = 0, 0, user_id)"))
    views = of_type(df, "view").select("event_id", "user_id", cut("hour"), "value")
    clicks = of_type(df, "click").select("user_id", cut("hour"), F.col("event_id").alias("click_id"))
    return ntz(ops.correlate(views, clicks, "click_id"))


def correlate_bucketed(spark, sf_dir):
    """Bucketed tables of deduplicated views and clicks."""
    views, clicks = views_and(spark, sf_dir, "click", "day", "click_id")
    loaded = []
    for df in (views.drop("value"), clicks):
        path = scratch_dir(spark, "bucketed")
        buckets = plans.Buckets(path.rsplit("/", 1)[1].replace("-", "_"), 8)
        plans.overwrite(ops.deduplicate(df), path, buckets=buckets)
        loaded.append(plans.read_layer(spark, path, buckets))
    return ntz(ops.correlate(*loaded, "click_id", one_per_key=True))


def attribute_interval(spark, sf_dir):
    views, clicks = views_and(spark, sf_dir, "click", None, "click_id")
    return ops.attribute_within(views, clicks, "click_id", timedelta(minutes=30))


def attribute_interval_day(spark, sf_dir):
    """A tolerance that gives most views a match and many several."""
    views, clicks = views_and(spark, sf_dir, "click", None, "click_id")
    return ops.attribute_within(views, clicks, "click_id", timedelta(days=1))


def attribute_first(spark, sf_dir):
    views, clicks = views_and(spark, sf_dir, "click", None, "click_id")
    return ops.attribute_first(views, clicks, "click_id", timedelta(days=1))


def attribute_last_touch(spark, sf_dir):
    df = events(spark, sf_dir)
    purchases = of_type(df, "purchase").select("event_id", "user_id", F.col("ts").alias("timestamp"))
    clicks = of_type(df, "click").select(
        "user_id", F.col("ts").alias("timestamp"), F.col("event_id").alias("click_id")
    )
    return ops.attribute_last_touch(purchases, clicks, "click_id")


# ---------------------------------------------------------------- loads


def full_load(spark, sf_dir):
    return ntz(plans.full_load_frame(staged_events(spark, sf_dir, "hour"), LOAD_TS))


def incremental_load(spark, sf_dir):
    newest = [F.desc("load_date"), F.desc("ad_creative_id")]
    staging = staged_events(spark, sf_dir, "day")
    return ntz(plans.incremental_load_frame(staging, "2024-01-20", LOAD_TS, order_by=newest))


def incremental_skip_loaded(spark, sf_dir):
    """The second load of a dataset: arrivals after the mark, without the keys of the first, by its index."""
    root = scratch_dir(spark, "skip")
    staging = staged_events(spark, sf_dir, "day")
    plans.overwrite(staging.filter("load_date <= '2024-01-20 12:00:00'"), f"{root}/early")
    plans.overwrite(staging, f"{root}/all")
    out, audit = f"{root}/ingestion", f"{root}/audit"
    plans.full_load(spark, f"{root}/early", out, audit, "2024-01-20")
    newest = [F.desc("load_date"), F.desc("ad_creative_id")]
    plans.incremental_load(spark, f"{root}/all", out, audit, "2024-01-20", LOAD_TS, newest, skip_loaded=True)
    return ntz(plans.read_loads(spark, out, plans.listed(spark, out).loads[1:]))


def incremental_by_mark(spark, sf_dir):
    """Three loads, each after the newest arrival that the one before has read."""
    root = scratch_dir(spark, "mark")
    staging = staged_events(spark, sf_dir, "hour")
    out = f"{root}/ingestion"
    for n, day in enumerate(("2024-01-10", "2024-01-20", "2024-02-20")):
        plans.overwrite(staging.filter(F.col("load_date") < F.lit(day).cast("timestamp")), f"{root}/staging{n}")
        plans.incremental_load(spark, f"{root}/staging{n}", out, f"{root}/audit", None, day, skip_loaded=True)
    return ntz(plans.read_layer(spark, out))


def publish_in_place(spark, sf_dir):
    """Two loads of a dataset, then its versions closed where it lies."""
    path = scratch_dir(spark, "published")
    newest = [F.desc("ts"), F.desc("event_id")]
    for part, day in (("ts < timestamp_ntz'2024-01-16'", "2024-01-16"), ("ts >= timestamp_ntz'2024-01-16'", "2024-01-31")):
        rows = ops.deduplicate(events(spark, sf_dir).filter(part), ["user_id"], newest)
        plans.add_load(ops.stamp_version(rows, day), path, keys=["user_id"])
    plans.close_versions(spark, path, keys=["user_id"])
    return ntz(plans.read_layer(spark, path))


def analytical_delta(spark, sf_dir):
    """Nine tenths of the events, then the other tenth of the last days: the second run joins those alone."""
    layers = plans.Layers(scratch_dir(spark, "delta"))
    df = events(spark, sf_dir)
    kinds = {"ad_impressions": ("ad_creative_id", ["view"]), "clicks": ("click_id", ["click"]), "conversions": ("conversion_id", ["purchase", "signup"])}
    late = (F.col("event_id") % 10 == 0) & (F.col("ts") >= F.lit("2024-01-25").cast("timestamp_ntz"))
    for rows, load_ts in ((df.filter("event_id % 10 <> 0"), LOAD_TS), (df.filter(late), "2024-07-01 00:00:00")):
        for name, (id_column, types) in kinds.items():
            staging = ops.stringify(
                of_type(rows, *types).select(F.expr("concat('user', user_id)").alias("user_id"), cut("day"), F.col("event_id").alias(id_column))
            )
            plans.add_load(plans.full_load_frame(staging, load_ts), layers.path("ingestion", name))
        plans.update_analytical(spark, layers)
    clicks, conversions = (plans.read_layer(spark, layers.path("analytical", f"ad_impressions_{n}")) for n in ("clicks", "conversions"))
    return ntz(clicks.join(conversions.select("ad_creative_id", "conversion_id"), "ad_creative_id"))


def audit_counts(spark, sf_dir):
    root = scratch_dir(spark, "audit")
    staged_events(spark, sf_dir, "hour").write.parquet(f"{root}/staging")
    plans.full_load(spark, f"{root}/staging", f"{root}/ingestion", f"{root}/audit", LOAD_TS)
    return plans.read_audit(spark, f"{root}/audit").select("operation", "record_count")


def unparsed_times(spark, sf_dir):
    """Rows whose time does not parse are kept apart with its text; the others are loaded."""
    root = scratch_dir(spark, "unparsed")
    bad = F.expr("if(website = 'purchase', 'no time', timestamp)")
    staged_events(spark, sf_dir, "hour").withColumn("timestamp", bad).write.parquet(f"{root}/staging")
    plans.full_load(
        spark, f"{root}/staging", f"{root}/ingestion", f"{root}/audit", LOAD_TS, unparsed_path=f"{root}/aside"
    )
    kept = plans.read_layer(spark, f"{root}/aside").select("user_id", "ad_creative_id", "timestamp")
    loaded = plans.read_layer(spark, f"{root}/ingestion").select(
        F.lower("user_id").alias("user_id"), "ad_creative_id", F.col("timestamp").cast("string").alias("timestamp")
    )
    return kept.unionByName(loaded)


def audit_incremental(spark, sf_dir):
    root = scratch_dir(spark, "audit")
    staged_events(spark, sf_dir, "day").write.parquet(f"{root}/staging")
    plans.incremental_load(
        spark, f"{root}/staging", f"{root}/ingestion", f"{root}/audit", "2024-01-20", LOAD_TS
    )
    return plans.read_audit(spark, f"{root}/audit").select("operation", "record_count")


def incremental_nothing_new(spark, sf_dir):
    """A mark after all arrivals: counts are audited, nothing is written."""
    root = scratch_dir(spark, "audit")
    staged_events(spark, sf_dir, "day").write.parquet(f"{root}/staging")
    plans.incremental_load(
        spark, f"{root}/staging", f"{root}/ingestion", f"{root}/audit", "2030-01-01", LOAD_TS
    )
    audit = plans.read_audit(spark, f"{root}/audit").select("operation", "record_count")
    written = plans.read_if_present(spark, f"{root}/ingestion") is not None
    return audit.withColumn("written", F.lit(written))


def incremental_arrivals(spark, sf_dir):
    """Two arrivals in staging, and a mark between them."""
    path = scratch_dir(spark, "staging")
    staging = staged_events(spark, sf_dir, "hour").drop("load_date")
    for part, arrived in (("website = 'click'", "2024-02-01 00:00:00"), ("website <> 'click'", "2024-02-02 00:00:00")):
        plans.save_arrivals(staging.filter(part), path, arrived, "append")
    return ntz(ops.newer_than(plans.read_layer(spark, path), "2024-02-01 12:00:00"))


def staging_drift(spark, sf_dir):
    """Three arrivals: the second has a column more and one less, the third comes as the first did."""
    path = scratch_dir(spark, "staging")
    staging = staged_events(spark, sf_dir, "hour").drop("load_date")
    third = F.col("ad_creative_id").cast("bigint") % 3
    plans.save_arrivals(staging.filter(third == 0), path, "2024-02-01", "overwrite")
    plans.save_arrivals(staging.filter(third == 1).withColumn("kind", F.upper("website")).drop("website"), path, "2024-02-02", "append")
    plans.save_arrivals(staging.filter(third == 2), path, "2024-02-03", "append")
    return ntz(plans.read_layer(spark, path))


def audit_reconcile(spark, sf_dir):
    """Every layer against the one before it, after a whole run."""
    layers = all_layers(spark, sf_dir)
    return plans.reconcile(spark, layers).select("dataset", "step", "expected_rows", "found_rows", "agrees")


def stream_batches(spark, sf_dir):
    """Keys spread over many files: the size of a batch changes nothing."""
    staging = staged_events(spark, sf_dir, "day").repartition(7, "ad_creative_id")
    out = None
    for max_files in (1, 10_000):
        root = scratch_dir(spark, "stream")
        paths = (f"{root}/staging", f"{root}/ingestion", f"{root}/audit", f"{root}/checkpoint")
        plans.append(staging, paths[0])
        stream_load(spark, *paths, LOAD_TS, max_files=max_files)
        loaded = ntz(plans.read_layer(spark, paths[1])).withColumn("max_files", F.lit(max_files))
        out = loaded if out is None else out.unionByName(loaded)
    return out


def stream_of_staging(spark, sf_dir):
    """Two arrivals and three runs: the second brings new files, the third none."""
    root = scratch_dir(spark, "stream")
    staging = staged_events(spark, sf_dir, "hour")
    early = F.col("load_date") < F.lit("2024-01-16").cast("timestamp")
    paths = (f"{root}/staging", f"{root}/ingestion", f"{root}/audit", f"{root}/checkpoint")
    for arrival in (staging.filter(early), staging.filter(~early), None):
        if arrival is not None:
            plans.append(arrival, paths[0])
        stream_load(spark, *paths, LOAD_TS)
    return ntz(plans.read_layer(spark, paths[1]))


def stream_late_rows(spark, sf_dir):
    """Three runs with new files: all but the last week, then everything a day or two late, then the last week."""
    root = scratch_dir(spark, "late")
    staging = staged_events(spark, sf_dir, "hour").drop("load_date")
    day = F.col("timestamp").cast("timestamp")
    week = day >= F.lit("2024-01-24").cast("timestamp")
    some = F.col("ad_creative_id").cast("bigint") % 5 == 0
    paths = [f"{root}/{n}" for n in ("staging", "out", "late", "audit", "state")]
    for arrival in (staging.filter(~week & ~some), staging.filter(some & ~week), staging.filter(week)):
        plans.append(arrival, paths[0])
        stream_deduplicated(spark, *paths, timedelta(days=5))
    out = plans.read_layer(spark, paths[1]).select("user_id", "timestamp", F.lit(False).alias("late"))
    late = plans.read_layer(spark, paths[2]).select("user_id", "timestamp", F.lit(True).alias("late"))
    return ntz(out.unionByName(late))


def stream_correlate(spark, sf_dir):
    """Views and clicks as they come, in three runs by day, then the end of the input."""
    root = scratch_dir(spark, "joined")
    views, clicks = views_and(spark, sf_dir, "click", None, "click_id")
    paths = [f"{root}/{n}" for n in ("views", "clicks", "out", "state")]
    delay = timedelta(hours=2)
    for first, last in (("2000-01-01", "2024-01-12"), ("2024-01-12", "2024-01-22"), ("2024-01-22", "2100-01-01"), (None, None)):
        if first is None:
            close_stream(spark, *paths[:2], delay=delay)
        for df, path in zip((views, clicks), paths):
            if first is not None:
                rows = df.withColumns({"timestamp": F.col("timestamp").cast("timestamp"), "user_id": F.col("user_id").cast("string")})
                plans.append(rows.filter(F.col("timestamp").between(F.lit(first).cast("timestamp"), F.expr(f"timestamp'{last}' - interval 1 microsecond"))), path)
        stream_correlated(spark, *paths, "click_id", delay)
    return ntz(plans.read_layer(spark, paths[2])).withColumn("user_id", F.col("user_id").cast("bigint"))


def analytical(spark, sf_dir):
    """Load views and clicks, the latest per user and day, and correlate them."""
    df = events(spark, sf_dir)
    newest = [F.desc("load_date"), F.desc("event")]
    loaded = {}
    for kind in ("view", "click"):
        staging = ops.stringify(
            of_type(df, kind).select(
                F.expr("concat('user', user_id)").alias("user_id"), cut("day"), F.col("event_id").alias("event"), "ts"
            )
        ).withColumn("load_date", F.col("ts").cast("timestamp")).drop("ts")
        loaded[kind] = plans.full_load_frame(staging, LOAD_TS, order_by=newest)
    views = loaded["view"].withColumnRenamed("event", "ad_creative_id")
    clicks = loaded["click"].withColumnRenamed("event", "click_id")
    return ntz(ops.correlate(views, clicks, "click_id", one_per_key=True))


# ---------------------------------------------------------------- all layers, from source files


def all_layers(spark, sf_dir) -> plans.Layers:
    """The whole tables as source files of the three kinds, taken through all layers."""
    inbox = scratch_dir(spark, "inbox")
    df = events(spark, sf_dir)
    user = F.expr("concat('user', user_id)")
    day = F.date_trunc("day", "ts").cast("string")
    of_type(df, "view").select(
        F.col("event_id").cast("string").alias("ad_creative_id"),
        user.alias("user_id"),
        day.alias("timestamp"),
        F.col("props").alias("website"),
    ).write.json(f"{inbox}/ad_impressions.json")
    of_type(df, "click", "purchase", "signup").select(
        day.alias("Event Timestamp"),
        user.alias("User ID"),
        F.concat(F.lit("campaign"), F.col("event_id").cast("string")).alias("Ad Campaign ID"),
        F.expr("nullif(event_type, 'click')").alias("Conversion Type"),
    ).write.csv(f"{inbox}/clicks_and_conversions.csv", header=True)
    of_type(df, "error").select(
        F.struct(
            user.alias("user_id"),
            F.col("event_type").alias("location"),
            F.get_json_object("props", "$.k").cast("int").alias("age"),
        ).alias("user_info"),
        F.struct(
            F.col("event_id").cast("string").alias("auction_id"),
            F.col("value").cast("float").alias("bid_amount"),
            F.col("ts").cast("string").alias("timestamp"),
        ).alias("auction_details"),
        F.struct(
            F.array("event_type", F.lit("ad")).alias("keywords"), F.lit("mobile").alias("device_type")
        ).alias("ad_targeting_criteria"),
    ).write.json(f"{inbox}/bid_requests.json")
    layers = plans.Layers(scratch_dir(spark, "layers"))
    specs = [
        source_spec("ad_impressions", inbox),
        source_spec("clicks_and_conversions", inbox),
        source_spec("bid_requests", inbox, format="json", path="bid_requests.json", schema=schemas.BID_REQUESTS),
    ]
    plans.run_all(spark, specs, layers, LOAD_TS)
    return layers


def layers_clicks(spark, sf_dir):
    return ntz(plans.read_layer(spark, all_layers(spark, sf_dir).path("analytical", "ad_impressions_clicks")))


def layers_conversions(spark, sf_dir):
    path = all_layers(spark, sf_dir).path("analytical", "ad_impressions_conversions")
    return ntz(plans.read_layer(spark, path))


def layers_two_loads(spark, sf_dir):
    """All layers, then the same arrivals loaded once more: each impression still comes out once."""
    layers = all_layers(spark, sf_dir)
    plans.load_all(spark, layers, "2024-07-01 00:00:00", "2024-01-01 00:00:00")
    plans.correlate_layers(spark, layers)
    return ntz(plans.read_layer(spark, layers.path("analytical", "ad_impressions_clicks")))


def layers_bids(spark, sf_dir):
    return ntz(plans.read_layer(spark, all_layers(spark, sf_dir).path("ingestion", "bid_requests")))


def layers_audit(spark, sf_dir):
    audit = plans.read_audit(spark, all_layers(spark, sf_dir).audit)
    return audit.groupBy("operation").agg(F.sum("record_count").alias("record_count"))


# ---------------------------------------------------------------- the same in SQL

STAGED = """
staged as (
  select case when event_type <> 'error' then 'USER' || user_id end as user_id,
         date_trunc('{unit}', ts)::timestamp as "timestamp",
         event_id::varchar as ad_creative_id, ts
  from events)"""

ON_DAY = """
select v.event_id, v.user_id, v.day as "timestamp", v.value, o.event_id as {id}
from (select *, date_trunc('day', ts)::timestamp as day from events where event_type = 'view') v
left join (select *, date_trunc('day', ts)::timestamp as day from events where event_type = '{kind}') o
  on v.user_id = o.user_id and v.day = o.day"""

STRINGS = """
select event_id::varchar as event_id, ts::varchar as ts, user_id::varchar as user_id,
       event_type, value::varchar as value, props from events"""

JSON_ROWS = """
select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as ts, user_id, event_type, value, props from events"""

EVENT_ID = "sha256(concat_ws('|', user_id::varchar, ts::varchar, props, coalesce(nullif(event_type, 'click'), '')))"

SPLIT = """
select ts::varchar as "timestamp", user_id::varchar as user_id, props as ad_campaign_id,
       nullif(event_type, 'click') as conversion_type, {event_id} as {id}
from events where event_type in ({types})"""

LAYERS_JOIN = """
with views as (
  select min(event_id::varchar) as ad_creative_id, 'USER' || user_id as user_id,
         date_trunc('day', ts)::timestamp as "timestamp"
  from events where event_type = 'view' group by all),
interactions as (
  select 'user' || user_id as u, date_trunc('day', ts)::timestamp as t,
         'campaign' || event_id as campaign, nullif(event_type, 'click') as type,
         sha256(concat_ws('|', 'user' || user_id, strftime(date_trunc('day', ts)::timestamp, '%Y-%m-%d %H:%M:%S'),
                          'campaign' || event_id, coalesce(nullif(event_type, 'click'), ''))) as id
  from events where event_type in ({types})),
kept as (
  select * from (select *, row_number() over (partition by u, t order by campaign, type nulls first) as n
                 from interactions) where n = 1)
select v.ad_creative_id, v.user_id, v."timestamp", 'example.com' as website,
       timestamp '2024-06-01' as load_date, true as is_current, k.id as {id}
from views v left join kept k on v.user_id = upper(k.u) and v."timestamp" = k.t"""

CLOSED = """
        with loads as (
          select *, case when ts < timestamp '2024-01-16' then timestamp '2024-01-16'
                         else timestamp '2024-01-31' end as load_date from events),
        kept as (
          select * exclude n from (
            select *, row_number() over (partition by user_id, load_date
                                         order by ts desc, event_id desc) as n
            from loads) where n = 1)
        select *, lead(load_date) over (partition by user_id order by load_date) is null as is_current
        from kept"""

SQL = {
    "scan_parquet": "select * from events",
    "scan_csv": STRINGS,
    "scan_json": JSON_ROWS,
    "scan_json_multiline": JSON_ROWS,
    "scan_json_mixed": "select * from events",
    "scan_json_schema_file": STRINGS,
    "scan_json_avsc": STRINGS,
    "scan_csv_no_header": """
        select event_id::varchar as _c0, ts::varchar as _c1, user_id::varchar as _c2,
               event_type as _c3, value::varchar as _c4, props as _c5 from events""",
    "scan_json_schema": "select * from events",
    "quarantine": """
        select case when event_type <> 'error' then event_id end as event_id,
               nullif(event_type, 'error') as event_type,
               case when event_type = 'error' then '{"event_id":' || event_id end as raw
        from events""",
    "sink_overwrite": "select user_id, count(*) as n from events group by user_id",
    "sink_append": "select user_id, 2 * count(*) as n from events group by user_id",
    "stringify_all": STRINGS,
    "stringify_lineitem": "select columns(*)::varchar from lineitem",
    "flatten_json": "select event_id, (props->>'k')::int as props_k from events",
    "flatten_struct": "select * from events",
    "cast_timestamp": """
        select event_id, case when event_type <> 'error' then ts end as "timestamp" from events""",
    "standardize_constant": "select event_id, 'example.com' as website from events",
    "upper_user_id": "select event_id, 'USER' || user_id as user_id from events",
    "filter_not_null": "select * from events where event_type <> 'error'",
    "incremental_filter": "select * from events where ts > timestamp '2024-01-29'",
    "rename_columns": """
        select ts as "timestamp", user_id, props as ad_campaign_id, event_type as conversion_type, event_id
        from events""",
    "derive_event_ids": SPLIT.format(event_id=EVENT_ID, id="click_id", types="'click', 'purchase', 'signup'"),
    "derive_conversion_ids": SPLIT.format(event_id=EVENT_ID, id="conversion_id", types="'purchase', 'signup'"),
    "dedup_keys": """
        select distinct user_id, date_trunc('hour', ts)::timestamp as "timestamp" from events""",
    "dedup_keep_latest": """
        select * exclude n from (
          select *, date_trunc('hour', ts)::timestamp as "timestamp",
                 row_number() over (partition by user_id, date_trunc('hour', ts)
                                    order by ts desc, event_id desc) as n
          from events) where n = 1""",
    "dedup_ties": """
        select * exclude n from (
          select *, date_trunc('day', ts)::timestamp as "timestamp",
                 row_number() over (partition by user_id, date_trunc('day', ts)
                                    order by event_type desc, event_id) as n
          from events) where n = 1""",
    "dedup_lineitem": """
        select * exclude n from (
          select *, row_number() over (partition by l_partkey, l_suppkey
                                       order by l_shipdate desc, l_orderkey desc, l_linenumber desc) as n
          from lineitem) where n = 1""",
    "scd_columns": """
        select event_id, user_id, timestamp '2024-06-01' as load_date, true as is_current from events""",
    "scd2_current": CLOSED,
    "close_versions": CLOSED,
    "version_as_of": """
        with e as (select event_id, if(event_id % 3 = 0, 0, user_id) as user_id, ts, event_type from events),
        starts as (select user_id, ts, lead(ts) over (partition by user_id order by ts) as next
                   from (select distinct user_id, ts from e where event_type = 'click')),
        versions as (select c.user_id, c.event_id as version_id, s.ts as valid_from, s.next as valid_to
                     from (select * from e where event_type = 'click') c join starts s using (user_id, ts))
        select v.event_id, v.user_id, v.ts as "timestamp", n.version_id, n.valid_from, n.valid_to
        from (select * from e where event_type = 'view') v
        left join versions n on v.user_id = n.user_id and n.valid_from <= v.ts and (v.ts < n.valid_to or n.valid_to is null)""",
    "scd2_ties": """
        select user_id, count(*) + count_if(event_type = 'click') as n_versions, 1::bigint as n_current
        from events group by user_id""",
    "incremental_anti_join": """
        with e as (select user_id, date_trunc('hour', ts)::timestamp as "timestamp", event_type from events)
        select user_id, "timestamp" from e where event_type = 'view'
        except select user_id, "timestamp" from e where event_type <> 'view'""",
    "correlate_clicks": ON_DAY.format(kind="click", id="click_id"),
    "correlate_conversions": ON_DAY.format(kind="purchase", id="conversion_id"),
    "correlate_hot_keys": """
        with e as (select event_id, if(event_id % 3 = 0, 0, user_id) as user_id,
                          date_trunc('hour', ts)::timestamp as "timestamp", value, event_type from events)
        select v.event_id, v.user_id, v."timestamp", v.value, c.event_id as click_id
        from (select * from e where event_type = 'view') v
        left join (select * from e where event_type = 'click') c using (user_id, "timestamp")""",
    "correlate_bucketed": """
        with kept as (select event_type, user_id, date_trunc('day', ts)::timestamp as "timestamp",
                             min(event_id) as event_id from events group by all)
        select v.event_id, v.user_id, v."timestamp", c.event_id as click_id
        from (select * from kept where event_type = 'view') v
        left join (select * from kept where event_type = 'click') c using (user_id, "timestamp")""",
    "correlate_exact": """
        select v.event_id, v.user_id, v.ts as "timestamp", v.value, c.event_id as click_id
        from (select * from events where event_type = 'view') v
        left join (select * from events where event_type = 'click') c
          on v.user_id = c.user_id and v.ts = c.ts""",
    "attribute_interval": """
        select v.event_id, v.user_id, v.ts as "timestamp", v.value, c.event_id as click_id
        from (select * from events where event_type = 'view') v
        left join (select * from events where event_type = 'click') c
          on v.user_id = c.user_id and c.ts between v.ts and v.ts + interval 30 minute""",
    "attribute_interval_day": """
        select v.event_id, v.user_id, v.ts as "timestamp", v.value, c.event_id as click_id
        from (select * from events where event_type = 'view') v
        left join (select * from events where event_type = 'click') c
          on v.user_id = c.user_id and c.ts between v.ts and v.ts + interval 1 day""",
    "attribute_first": """
        with clicks as (select user_id, ts, min(event_id) as event_id from events
                        where event_type = 'click' group by user_id, ts)
        select v.event_id, v.user_id, v.ts as "timestamp", v.value,
               case when c.ts <= v.ts + interval 1 day then c.event_id end as click_id
        from (select * from events where event_type = 'view') v
        asof left join clicks c on v.user_id = c.user_id and v.ts <= c.ts""",
    "attribute_last_touch": """
        select p.event_id, p.user_id, p.ts as "timestamp", c.event_id as click_id
        from (select * from events where event_type = 'purchase') p
        asof left join (select * from events where event_type = 'click') c
          on p.user_id = c.user_id and p.ts >= c.ts""",
    "full_load": f"""
        with {STAGED.format(unit="hour")}
        select user_id, "timestamp", min(ad_creative_id) as ad_creative_id, 'example.com' as website,
               timestamp '2024-06-01' as load_date, true as is_current
        from staged where user_id is not null group by user_id, "timestamp" """,
    "incremental_load": f"""
        with {STAGED.format(unit="day")}
        select user_id, "timestamp", ad_creative_id, 'example.com' as website,
               timestamp '2024-06-01' as load_date, true as is_current
        from (select *, row_number() over (partition by user_id, "timestamp"
                                           order by ts desc, ad_creative_id desc) as n
              from staged where user_id is not null and ts > timestamp '2024-01-20')
        where n = 1""",
    "incremental_skip_loaded": f"""
        with {STAGED.format(unit="day")},
        loaded as (select user_id, "timestamp" from staged
                   where user_id is not null and ts <= timestamp '2024-01-20 12:00:00')
        select user_id, "timestamp", ad_creative_id, 'example.com' as website,
               timestamp '2024-06-01' as load_date, true as is_current
        from (select *, row_number() over (partition by user_id, "timestamp"
                                           order by ts desc, ad_creative_id desc) as n
              from staged where user_id is not null and ts > timestamp '2024-01-20')
        where n = 1 and (user_id, "timestamp") not in (select (user_id, "timestamp") from loaded)""",
    "incremental_by_mark": f"""
        with {STAGED.format(unit="hour")}, kept as (
          select *, case when ts < timestamp '2024-01-10' then timestamp '2024-01-10'
                         when ts < timestamp '2024-01-20' then timestamp '2024-01-20'
                         else timestamp '2024-02-20' end as load_date
          from staged where user_id is not null and ts < timestamp '2024-02-20')
        select user_id, "timestamp", min_by(ad_creative_id, (load_date, ad_creative_id)) as ad_creative_id,
               'example.com' as website, min(load_date) as load_date, true as is_current
        from kept group by user_id, "timestamp" """,
    "publish_in_place": CLOSED,
    "analytical_delta": """
        with e as (
          select 'USER' || user_id as user_id, date_trunc('day', ts)::timestamp as day, event_id::varchar as id, event_type,
                 case when event_id % 10 <> 0 then timestamp '2024-06-01' else timestamp '2024-07-01' end as load_date
          from events where event_id % 10 <> 0 or ts >= timestamp '2024-01-25'),
        kept as (
          select * from (
            select *, case event_type when 'view' then 'view' when 'click' then 'click' when 'error' then 'error' else 'conversion' end as kind,
                   row_number() over (partition by kind, user_id, day order by load_date desc, id) as n from e) where n = 1)
        select v.user_id, v.day as "timestamp", v.id as ad_creative_id, 'example.com' as website, v.load_date, true as is_current,
               c.id as click_id, p.id as conversion_id
        from (select * from kept where kind = 'view') v
        left join (select * from kept where kind = 'click') c on v.user_id = c.user_id and v.day = c.day
        left join (select * from kept where kind = 'conversion') p on v.user_id = p.user_id and v.day = p.day""",
    "audit_counts": f"""
        with {STAGED.format(unit="hour")}
        select 'read_staging' as operation, count(*) as record_count from staged
        union all select 'filter_data', count(user_id) from staged
        union all select 'invalid_timestamp', 0
        union all select 'deduplicate_data', count(*)
          from (select distinct user_id, "timestamp" from staged where user_id is not null)""",
    "unparsed_times": f"""
        with {STAGED.format(unit="hour")}, typed as (
          select lower(staged.user_id) as user_id, ad_creative_id, "timestamp", event_type
          from staged join events on event_id::varchar = ad_creative_id where staged.user_id is not null)
        select user_id, ad_creative_id, 'no time' as "timestamp" from typed where event_type = 'purchase'
        union all
        select user_id, min(ad_creative_id), strftime("timestamp", '%Y-%m-%d %H:%M:%S') from typed
        where event_type <> 'purchase' group by user_id, "timestamp" """,
    "audit_incremental": f"""
        with {STAGED.format(unit="day")}, newer as (select * from staged where ts > timestamp '2024-01-20')
        select 'read_staging' as operation, count(*) as record_count from staged
        union all select 'filter_incremental', count(*) from newer
        union all select 'filter_data', count(user_id) from newer
        union all select 'invalid_timestamp', 0
        union all select 'deduplicate_data', count(*)
          from (select distinct user_id, "timestamp" from newer where user_id is not null)""",
    "incremental_nothing_new": """
        select 'read_staging' as operation, count(*) as record_count, false as written from events
        union all select unnest(['filter_incremental', 'filter_data', 'invalid_timestamp', 'deduplicate_data']), 0, false""",
    "incremental_arrivals": f"""
        with {STAGED.format(unit="hour")}
        select lower(user_id) as user_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') as "timestamp", ad_creative_id,
               event_type as website,
               timestamp '2024-02-02' as load_date
        from (select staged.*, event_type from staged join events on event_id::varchar = ad_creative_id)
        where event_type <> 'click'""",
    "staging_drift": f"""
        with {STAGED.format(unit="hour")}
        select lower(staged.user_id) as user_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') as "timestamp", ad_creative_id,
               case when ad_creative_id::bigint % 3 <> 1 then event_type end as website,
               case when ad_creative_id::bigint % 3 = 1 then upper(event_type) end as kind,
               timestamp '2024-02-01' + (ad_creative_id::bigint % 3) * interval 1 day as load_date
        from staged join events on event_id::varchar = ad_creative_id""",
    "audit_reconcile": """
        with e as (select *, date_trunc('day', ts) as day, event_type in ('click', 'purchase', 'signup') as click,
                          event_type in ('purchase', 'signup') as conversion from events),
        loads as (select 'ad_impressions' as dataset, user_id, day from e where event_type = 'view'
                  union all select 'clicks', user_id, day from e where click
                  union all select 'conversions', user_id, day from e where conversion
                  union all select 'bid_requests', user_id, ts from e where event_type = 'error'),
        steps as (select dataset, 'stage' as step, count(*) as n from loads group by dataset
                  union all select dataset, 'load', count(*) from (select distinct * from loads) group by dataset
                  union all select unnest(['ad_impressions_clicks', 'ad_impressions_conversions']), 'correlate', count(*)
                    from (select distinct * from loads where dataset = 'ad_impressions'))
        select dataset, step, n as expected_rows, n as found_rows, true as agrees from steps""",
    "stream_batches": f"""
        with {STAGED.format(unit="day")}
        select user_id, "timestamp", min(ad_creative_id) as ad_creative_id, 'example.com' as website,
               timestamp '2024-06-01' as load_date, true as is_current, max_files
        from staged, (select unnest([1, 10000]) as max_files)
        where user_id is not null group by user_id, "timestamp", max_files""",
    "stream_of_staging": f"""
        with {STAGED.format(unit="hour")}
        select user_id, "timestamp", min(ad_creative_id) as ad_creative_id, 'example.com' as website,
               timestamp '2024-06-01' as load_date, true as is_current
        from staged where user_id is not null group by user_id, "timestamp" """,
    "stream_late_rows": f"""
        with {STAGED.format(unit="hour")},
        runs as (select user_id, "timestamp", case when "timestamp" >= timestamp '2024-01-24' then 3
                        when ad_creative_id::bigint % 5 = 0 then 2 else 1 end as run from staged where user_id is not null),
        marks as (select r.run, (select max("timestamp") from runs b where b.run < r.run) as newest from (select unnest([1, 2, 3]) as run) r),
        told as (select user_id, "timestamp", coalesce("timestamp" < newest - interval 5 day, false) as late from runs join marks using (run))
        select distinct * from told where not late union all select * from told where late""",
    "stream_correlate": """
        select v.event_id, v.user_id, v.ts as "timestamp", v.value, c.event_id as click_id
        from (select * from events where event_type = 'view') v
        left join (select * from events where event_type = 'click') c
          on v.user_id = c.user_id and v.ts = c.ts""",
    "analytical": """
        with kept as (
          select * from (
            select event_type, 'USER' || user_id as user_id, date_trunc('day', ts)::timestamp as day,
                   event_id::varchar as event,
                   row_number() over (partition by event_type, user_id, date_trunc('day', ts)
                                      order by ts desc, event_id::varchar desc) as n
            from events where event_type in ('view', 'click')) where n = 1)
        select v.user_id, v.day as "timestamp", v.event as ad_creative_id, 'example.com' as website,
               timestamp '2024-06-01' as load_date, true as is_current, c.event as click_id
        from (select * from kept where event_type = 'view') v
        left join (select * from kept where event_type = 'click') c on v.user_id = c.user_id and v.day = c.day""",
    "layers_clicks": LAYERS_JOIN.format(types="'click', 'purchase', 'signup'", id="click_id"),
    "layers_conversions": LAYERS_JOIN.format(types="'purchase', 'signup'", id="conversion_id"),
    "layers_two_loads": LAYERS_JOIN.replace("2024-06-01", "2024-07-01").format(
        types="'click', 'purchase', 'signup'", id="click_id"
    ),
    "layers_bids": """
        select 'USER' || user_id as user_id, event_type as location, props->>'k' as age,
               event_id::varchar as auction_id, value::float::varchar as bid_amount, ts as "timestamp",
               '[error, ad]' as keywords, 'mobile' as device_type, 'example.com' as website,
               timestamp '2024-06-01' as load_date, true as is_current
        from events where event_type = 'error'""",
    "layers_audit": """
        with e as (select *, date_trunc('day', ts) as day, event_type in ('click', 'purchase', 'signup') as click,
                          event_type in ('purchase', 'signup') as conversion from events),
        loads as (select 'ad_impressions' as d, user_id, day from e where event_type = 'view'
                  union all select 'clicks', user_id, day from e where click
                  union all select 'conversions', user_id, day from e where conversion
                  union all select 'bid_requests', user_id, ts from e where event_type = 'error'),
        kept as (select distinct * from loads)
        select 'read_staging' as operation, count(*) as record_count from loads
        union all select 'filter_data', count(*) from loads
        union all select 'invalid_timestamp', 0
        union all select 'deduplicate_data', count(*) from kept
        union all select 'read_ingestion', count(*) from kept where d <> 'bid_requests'
        union all select unnest(['malformed_ad_impressions', 'malformed_clicks_and_conversions',
                                 'malformed_bid_requests']), 0""",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        scan_parquet, scan_csv, scan_csv_no_header, scan_json, scan_json_multiline, scan_json_mixed, scan_json_schema,
        scan_json_schema_file, scan_json_avsc, quarantine, sink_overwrite, sink_append,
        stringify_all, stringify_lineitem, flatten_json, flatten_struct, cast_timestamp,
        standardize_constant, upper_user_id, filter_not_null, incremental_filter, rename_columns,
        derive_event_ids, derive_conversion_ids, dedup_keys, dedup_keep_latest, dedup_ties, dedup_lineitem,
        scd_columns, scd2_current, scd2_ties, close_versions, version_as_of, incremental_anti_join, correlate_clicks, correlate_conversions,
        correlate_exact, correlate_hot_keys, correlate_bucketed, attribute_interval, attribute_interval_day, attribute_first,
        attribute_last_touch, full_load,
        incremental_load, incremental_skip_loaded, incremental_by_mark, publish_in_place, analytical_delta, audit_counts, unparsed_times, audit_incremental,
        incremental_nothing_new, incremental_arrivals, staging_drift, audit_reconcile, stream_of_staging, stream_batches, stream_late_rows, stream_correlate,
        analytical, layers_clicks, layers_conversions, layers_two_loads, layers_bids, layers_audit,
    )
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator and plan."""
    return {**QUERIES, **LLM_QUERIES}


def oracle_sql() -> dict[str, str]:
    """The same in SQL for DuckDB, over views named after the tables."""
    return {**SQL, **LLM_SQL}
