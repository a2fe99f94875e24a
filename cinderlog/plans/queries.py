"""Registered queries. Each builds log text from the given tables and runs one operator on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cinderlog.functions import attributes as attr, lines, records, times
from cinderlog.operators import (
    aggregate, attributes as attribute_rows, binding, bulk, collector, enrich, health, otel, registry, rollups, search, trace, versions,
)
from cinderlog.plans import adapter as ad
from cinderlog.plans.adapter import text
from cinderlog.session import work_path
from cinderlog.sinks import clustered, generations, index as log_index, terms
from cinderlog.sources import landing, topic
from cinderlog.streaming import jobs, silence

_MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _long(column: Column) -> Column:
    return column.cast("bigint")


# ---- sources

def src_raw_json(spark: SparkSession, sf: str) -> DataFrame:
    messages = ad.adapted(spark, sf).select(F.encode(ad.json_line(), "UTF-8").alias("value"))
    return topic.message_text(messages)


def _landed(spark: SparkSession, sf: str, line: Column, names: Column) -> str:
    """Write the events as files of lines, four clients, into a new landing folder."""
    base = work_path(spark, "landing")
    uploads = ad.adapted(spark, sf).select(
        text("c-", (F.col("user_id") % 4).cast("string")).alias("client_id"), names.alias("file_name"), line.alias("line")
    )
    landing.land_lines(uploads, base)
    return base


def _tailed(spark: SparkSession, base: str) -> DataFrame:
    """Stream a landing folder into an index and read that."""
    index, checkpoint = work_path(spark, "index"), work_path(spark, "stream")
    query = jobs.run_log_stream(
        landing.stream_landing(spark, base), index, work_path(spark, "quarantine"), checkpoint,
        parser=F.col("parser"), keep=["client_id", "file_path"], arrival=F.col("landed_at"), trigger=None,
    )
    query.awaitTermination()
    return log_index.read_index(spark, index).select("log_id", "level", "message")


def tail_log_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _tailed(spark, _landed(spark, sf, ad.log_line(), ad.pick(("app.log", "app.txt"))))


def tail_json_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _tailed(spark, _landed(spark, sf, ad.json_line(), ad.pick(("app.json", "app.ndjson"))))


def tail_csv_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _tailed(spark, _landed(spark, sf, ad.csv_line(), F.lit("app.csv")))


def tail_raw_lines(spark: SparkSession, sf: str) -> DataFrame:
    names = text("settings.", ad.pick(ad.RAW_EXTENSIONS))
    stream = landing.stream_landing(spark, _landed(spark, sf, ad.log_line(), names))
    path = work_path(spark, "raw")
    jobs.drain(jobs.file_writer(stream.select("tag", "client_id", "value"), path, work_path(spark, "stream")))
    return spark.read.schema("tag string, client_id string, value string").parquet(path)


def landing_path_columns(spark: SparkSession, sf: str) -> DataFrame:
    digest = F.md5("log_id")
    upload = F.concat_ws("-", *[F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    path = text(
        "file:/srv/uploads/logs/c-", (F.col("user_id") % 4).cast("string"), "/", upload, "_app_", F.col("log_id"),
        ".", ad.pick(ad.EXTENSIONS),
    )
    paths = ad.adapted(spark, sf).select("log_id", path.alias("path"))
    return landing.with_path_columns(paths, "path").drop("path")


def _bodies(spark: SparkSession, sf: str) -> DataFrame:
    """One request body per event with one to three records, each with a date key, a number and a nested value."""
    record = "concat('{\"date\":1.5,\"logId\":\"', log_id, '-', i, '\",\"level\":\"', level, '\",\"n\":1.10,\"x\":{\"b\":', i, '}}')"
    body = F.expr(f"concat('[', array_join(transform(sequence(0L, event_id % 3), i -> {record}), ','), ']')")
    return ad.adapted(spark, sf).select(F.col("event_id").alias("body_id"), body.alias("body"))


def _record_text(field: str) -> Column:
    return F.variant_get(F.col("record")[field], "$", "string")


def explode_request_body(spark: SparkSession, sf: str) -> DataFrame:
    return collector.explode_bodies(_bodies(spark, sf)).select(
        "body_id", _record_text("logId").alias("log_id"), _record_text("level").alias("level")
    )


def body_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Four kinds of bodies in turn: clean, cut, with a wrong element, an object."""
    bodies = _bodies(spark, sf).withColumn("body", F.expr(
        "CASE body_id % 4 WHEN 0 THEN body WHEN 1 THEN left(body, 20) WHEN 2 THEN concat(left(body, length(body) - 1), ',5]') "
        "ELSE '{\"a\":1}' END"
    ))
    return collector.body_quarantine(bodies)


def body_record_count(spark: SparkSession, sf: str) -> DataFrame:
    return collector.body_sizes(_bodies(spark, sf))


def drop_date_key(spark: SparkSession, sf: str) -> DataFrame:
    return collector.explode_bodies(_bodies(spark, sf)).select(
        _record_text("logId").alias("log_id"), _long(F.size("record")).alias("n_keys"),
        F.map_contains_key("record", "date").alias("has_date"),
    )


def kafka_payload(spark: SparkSession, sf: str) -> DataFrame:
    rows = collector.explode_bodies(_bodies(spark, sf)).withColumn("log_id", _record_text("logId"))
    return collector.payloads(rows).select("log_id", "value")


# ---- binding and validation

def _flat_event() -> list[Column]:
    first = F.element_at("attributes", 1)
    return [
        "log_id", "host", F.date_format("event_time", _MICROS).alias("event_time"),
        F.date_format("ingestion_time", _MICROS).alias("ingestion_time"), "service", "instance_id", "namespace",
        "pod_name", "trace_id", "level", "message", first["key"].alias("attr_key"), first["value"].alias("attr_value"),
    ]


def bind_log_event(spark: SparkSession, sf: str) -> DataFrame:
    seconds = (F.unix_micros(F.col("ts").cast("timestamp")).cast("decimal(26,6)") / F.lit(1_000_000)).cast("decimal(20,6)")
    value = ad.json_line(extra=text('"ingestionTimestamp":', seconds.cast("string")))
    return binding.bind_events(ad.adapted(spark, sf, "ts").select(value.alias("value"))).select(*_flat_event())


MAX_TEST_BYTES = 512


def _defects(spark: SparkSession, sf: str) -> DataFrame:
    """JSON records of which eight in ten have one defect each, told by event_id % 10."""
    kind = F.col("event_id") % 10
    whole = ad.json_line()
    no_zone = text('"', F.expr("left(ts_text, 19)"), '"')
    value = (
        F.when(kind == 0, F.lit("  "))
        .when(kind == 1, F.expr("left(whole, 40)"))
        .when(kind == 2, ad.json_line(extra=F.lit('"log":"x"')))
        .when(kind == 3, ad.json_line(level=F.lit('"FATAL"')))
        .when(kind == 4, ad.json_line(ts_text=no_zone))
        .when(kind == 5, ad.json_line(attributes=F.lit('"k=v"')))
        .when(kind == 6, ad.json_line(message=F.lit('{"a":1}')))
        .when(kind == 7, ad.json_line(message=text('"', F.repeat("message", 40), '"')))
        .otherwise(F.col("whole"))
    )
    return ad.adapted(spark, sf).withColumn("whole", whole).select("log_id", value.alias("value"))


def _judged(spark: SparkSession, sf: str) -> DataFrame:
    return binding.bind(_defects(spark, sf), "json", arrival=ad.no_time(), max_bytes=MAX_TEST_BYTES)


def validate_split(spark: SparkSession, sf: str) -> DataFrame:
    return _judged(spark, sf).select(
        "log_id", F.col("reason").isNull().alias("is_valid"), F.coalesce("reason", F.lit("valid")).alias("reason")
    )


def quarantine_counts(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.count_by(binding.quarantine(_judged(spark, sf)), "reason")


def filter_valid_level(spark: SparkSession, sf: str) -> DataFrame:
    level = F.when(F.col("event_id") % 10 == 3, F.lit('"FATAL"')).otherwise(text('"', F.col("level"), '"'))
    rows = ad.adapted(spark, sf).select(ad.json_line(level=level).alias("value"))
    return aggregate.count_by(binding.bind_events(rows), "level")


def replay_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Records kept out for their size come back under a larger limit; the others stay out."""
    again = binding.replay(binding.quarantine(_judged(spark, sf), "log_id"), "json", "log_id")
    return again.groupBy(F.coalesce("reason", F.lit("valid")).alias("reason")).agg(_long(F.count("*")).alias("n"))


def replay_out(spark: SparkSession, sf: str) -> DataFrame:
    """What a stream's batches left in quarantine is replayed under a larger limit, twice: index and quarantine afterwards."""
    path, kept_out = work_path(spark, "index"), work_path(spark, "quarantine")
    judged = _judged(spark, sf)
    for batch in range(3):
        own = judged.where(F.crc32("log_id") % 3 == batch)
        log_index.write_index_batch(binding.valid_events(own), path, batch)
        log_index.write_batch_folder(binding.quarantine(own, "log_id"), kept_out, batch)
    for _ in range(2):
        generations.replay_out(spark, kept_out, path, keep="log_id string", stopped=True, arrival=ad.no_time())
    left = generations.read_quarantine(spark, kept_out, "log_id string").select("log_id", F.lit("quarantine").alias("place"), "reason")
    there = log_index.read_index(spark, path).select("log_id", F.lit("index").alias("place"), F.lit(None).cast("string").alias("reason"))
    return left.unionByName(there)


# ---- collector

def _files(spark: SparkSession, sf: str) -> DataFrame:
    return ad.adapted(spark, sf).withColumn("ext", ad.pick((*ad.EXTENSIONS, "png")))


def route_by_extension(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.count_by(collector.route(_files(spark, sf)), "ext", "parser")


def filter_by_tag(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.count_by(collector.with_tag_like(collector.route(_files(spark, sf)), "logs.y*"), "tag")


def csv_line_match(spark: SparkSession, sf: str) -> DataFrame:
    """One of the first nine fields is emptied in nine of ten lines."""
    line = F.concat_ws(",", *[
        F.when(F.col("event_id") % 10 == i, F.lit("")).otherwise(F.col(column))
        for i, (_, column) in enumerate(ad.TEXT_FIELDS[:-1])
    ], F.col("message"))
    matched = f"({lines.csv_line_captures('line')}) IS NOT NULL AS matched"
    return aggregate.count_by(ad.adapted(spark, sf).select(line.alias("line")).selectExpr(matched), "matched")


def union_all_formats(spark: SparkSession, sf: str) -> DataFrame:
    """Each event in one of three formats; the frames are bound apart and put together."""
    rows = ad.adapted(spark, sf)
    kinds = (("logs.app", "log", ad.log_line()), ("logs.json", "json", ad.json_line()), ("logs.csv", "csv", ad.csv_line()))
    frames = [
        binding.valid_events(binding.bind(
            rows.where(F.col("event_id") % 3 == i).select(F.lit(tag).alias("tag"), line.alias("value")), parser,
        ), "tag")
        for i, (tag, parser, line) in enumerate(kinds)
    ]
    return collector.union_formats(*frames).select("tag", "log_id", "level")


def mixed_formats(spark: SparkSession, sf: str) -> DataFrame:
    """The same input as one frame that is read and bound in one pass."""
    kind = F.col("event_id") % 3
    value = F.when(kind == 0, ad.log_line()).when(kind == 1, ad.json_line()).otherwise(ad.csv_line())
    rows = ad.adapted(spark, sf).select(ad.pick(("log", "json", "csv")).alias("ext"), value.alias("value"))
    bound = binding.bind(collector.route(rows), F.col("parser"))
    return binding.valid_events(bound, "tag").select("tag", "log_id", "level")


# ---- parsing

def parse_log_line(spark: SparkSession, sf: str) -> DataFrame:
    rows = ad.adapted(spark, sf).select(ad.log_line().alias("line")).selectExpr(f"{lines.log_line_captures('line')} AS c")
    return rows.selectExpr(*[f"{sql} AS {name}" for name, sql in lines.log_fields("c").items()])


def parse_csv_line(spark: SparkSession, sf: str) -> DataFrame:
    rows = ad.adapted(spark, sf).select(ad.csv_line().alias("line")).selectExpr(f"{lines.csv_line_captures('line')} AS c")
    return rows.selectExpr(*[f"{sql} AS {name}" for name, sql in lines.csv_fields("c").items()])


def parse_log_time(spark: SparkSession, sf: str) -> DataFrame:
    return ad.adapted(spark, sf).selectExpr("log_id", f"unix_micros({times.parse_log_time('ts_text')}) AS epoch_us")


def normalize_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    """Three input forms in turn: whole seconds in UTC, microseconds with an offset, epoch seconds."""
    ts = F.col("ts").cast("timestamp")
    shifted = F.date_format(ts + F.expr("interval '5' hour + interval '30' minute"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+05:30'")
    number = (F.unix_micros(ts).cast("decimal(26,6)") / F.lit(1_000_000)).cast("decimal(20,6)").cast("string")
    kind = F.col("event_id") % 3
    value = F.when(kind == 0, F.col("ts_text")).when(kind == 1, shifted).otherwise(number)
    rows = ad.adapted(spark, sf, "ts").select("log_id", value.alias("value"))
    return rows.selectExpr("log_id", f"unix_micros({times.normalize_timestamp('value')}) AS epoch_us")


def parse_attributes(spark: SparkSession, sf: str) -> DataFrame:
    """Three input forms in turn: a pair, a JSON object, two pairs."""
    kind, k = F.col("event_id") % 3, F.col("attr_k")
    value = (
        F.when(kind == 0, text("k=", k)).when(kind == 1, text('{"k":"', k, '"}'))
        .otherwise(text("k=", k, ", user=", F.col("user_id").cast("string")))
    )
    rows = ad.adapted(spark, sf).select("log_id", value.alias("value"))
    parsed = rows.selectExpr("log_id", f"explode({attr.parse_attributes('value', 'log_id')}) AS a")
    return parsed.select("log_id", "a.key", "a.value")


# ---- documents and bulk requests

def event_to_json(spark: SparkSession, sf: str) -> DataFrame:
    value = records.to_document(records.event_document("iso"))
    return ad.json_events(spark, sf).selectExpr("log_id", f"{value} AS value")


def bulk_index_actions(spark: SparkSession, sf: str) -> DataFrame:
    return bulk.action_rows(bulk.with_documents(ad.json_events(spark, sf)), doc_id=F.col("log_id"))


def document_size(spark: SparkSession, sf: str) -> DataFrame:
    return bulk.with_documents(ad.json_events(spark, sf)).select("log_id", "bytes")


def oversize_filter(spark: SparkSession, sf: str) -> DataFrame:
    documents = ad.table(spark, sf, "documents").selectExpr("doc_id", f"{records.document_size('text')} AS bytes")
    return bulk.split_oversize(documents, 8192)


def bulk_batches_by_count(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of 1,000 records: what is in them, and how many break the limit or are not full before a lane's end."""
    size = 1_000
    batches = bulk.batches_by_count(ad.log_events(spark, sf).select("log_id"), size).groupBy("lane", "batch_no").agg(
        F.count("*").alias("n"), F.sum(F.col("log_id").cast("bigint")).alias("ids")
    )
    last = F.max("batch_no").over(Window.partitionBy("lane"))
    return batches.withColumn("last", last).agg(
        _long(F.sum("n")).alias("docs"), _long(F.sum("ids")).alias("id_sum"), _long(F.count_if(F.col("n") > size)).alias("over"),
        _long(F.count_if((F.col("n") < size) & (F.col("batch_no") < F.col("last")))).alias("not_full"),
    )


def bulk_batches_by_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of 500 records or 64 KiB: totals, and how many break a limit or close too early."""
    records_limit, bytes_limit = 500, 64 * 1024
    documents = bulk.with_documents(ad.json_events(spark, sf)).select("log_id", "bytes")
    ordered = documents.withColumn("arrival", F.monotonically_increasing_id())
    batches = bulk.batches_by_size(ordered, records_limit, bytes_limit).groupBy("lane", "batch_no").agg(
        F.count("*").alias("n"), F.sum("bytes").alias("size"), F.min_by("bytes", "arrival").alias("first"),
        F.sum(F.col("log_id").cast("bigint")).alias("ids"),
    )
    after = F.lead("first").over(Window.partitionBy("lane").orderBy("batch_no"))
    early = (F.col("n") < records_limit) & (F.col("size") + F.col("after") <= bytes_limit)
    return batches.withColumn("after", after).agg(
        _long(F.sum("n")).alias("docs"), _long(F.sum("ids")).alias("id_sum"), _long(F.sum("size")).alias("bytes"),
        _long(F.count_if(F.col("n") > records_limit)).alias("over_count"),
        _long(F.count_if(F.col("size") > bytes_limit)).alias("over_bytes"),
        _long(F.count_if(early)).alias("closed_early"),
    )


def doc_timestamp_forms(spark: SparkSession, sf: str) -> DataFrame:
    forms = times.document_forms("event_time")
    return ad.json_events(spark, sf).selectExpr("log_id", *[f"{sql} AS {name}" for name, sql in forms.items()])


# ---- attributes, transformation, enrichment

def _two_attributes(spark: SparkSession, sf: str) -> DataFrame:
    both = text(
        "[", ad.attribute_json("k", F.col("attr_k"), F.col("event_id") * 2), ",",
        ad.attribute_json("user", F.col("user_id").cast("string"), F.col("event_id") * 2 + 1), "]",
    )
    return binding.bind_events(ad.adapted(spark, sf).select(ad.json_line(attributes=both).alias("value")))


def attributes_flat(spark: SparkSession, sf: str) -> DataFrame:
    return attribute_rows.flatten_attributes(_two_attributes(spark, sf)).select("log_id", "key", "value")


def attributes_nest(spark: SparkSession, sf: str) -> DataFrame:
    """Attributes taken off and put back, on the event's number: a tenth of the records have no log id."""
    both = text(
        "[", ad.attribute_json("k", F.col("attr_k"), F.col("event_id") * 2 + 1), ",",
        ad.attribute_json("user", F.col("user_id").cast("string"), F.col("event_id") * 2), "]",
    )
    log_id = F.when(F.col("event_id") % 10 == 0, F.lit("null")).otherwise(text('"', F.col("log_id"), '"'))
    rows = ad.adapted(spark, sf).select("event_id", ad.json_line(attributes=both, log_id=log_id).alias("value"))
    events = binding.valid_events(binding.bind(rows, "json", arrival=ad.no_time()), "event_id")
    flat = attribute_rows.flatten_attributes(events, key="event_id")
    nested = attribute_rows.nest_attributes(events.select("event_id", "log_id"), flat, key="event_id")
    listed = F.array_join(F.transform("attributes", lambda a: F.concat_ws(":", a["id"].cast("string"), a["logId"], a["key"], a["value"])), ",")
    return nested.select("event_id", "log_id", listed.alias("attributes"))


def transform_event(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.transform_events(ad.log_events(spark, sf)).select(
        "log_id", "level_rank", F.col("event_date").cast("string").alias("event_date"), "event_hour"
    )


def enrich_service_dim(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = ad.table(spark, sf, "nation"), ad.table(spark, sf, "region")
    owners = enrich.join_dimension(
        nation.select(text("svc-", F.col("n_nationkey").cast("string")).alias("service"), F.col("n_regionkey").alias("r_regionkey")),
        region, ["r_regionkey"],
    ).select("service", F.col("r_name").alias("region"))
    return enrich.join_dimension(ad.log_events(spark, sf), owners, ["service"]).select("log_id", "service", "region")


# ---- queries over events

def metrics_per_hour(spark: SparkSession, sf: str) -> DataFrame:
    return _metric_rows(aggregate.metrics(ad.log_events(spark, sf)))


def _metric_rows(df: DataFrame) -> DataFrame:
    return df.select(
        F.date_format("window_start", times.DATE_TIME_FORMAT).alias("window_start"), "service", "n", "n_error",
        F.round("error_ratio", 6).alias("error_ratio"), "bytes",
    )


def metrics_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of a stream that ends, all windows included."""
    source = spark.readStream.schema(ad.table(spark, sf, "events").schema).parquet(f"{sf}/events*.parquet")
    events = source.select(
        F.col("ts").cast("timestamp").alias("event_time"), text("svc-", (F.col("user_id") % 5).cast("string")).alias("service"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("level"),
        F.col("event_type").alias("message"),
    )
    path = work_path(spark, "metrics")
    jobs.drain(jobs.whole_metrics_writer(events, path, work_path(spark, "stream")))
    return _metric_rows(spark.read.parquet(path))


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return ad.table(spark, sf, "documents").select("doc_id", "text")


SEARCH_TERMS = ("the", "and", "for")
ANY_TERMS = ("from", "than")
SEARCH_PHRASE = "by the"
SEARCH_NUMBERS = ("1", "42")
SEARCH_NON_ASCII = ("für", "Été", "ciónes")


def search_terms(spark: SparkSession, sf: str) -> DataFrame:
    found = search.search(_documents(spark, sf), SEARCH_TERMS, "text", "all")
    return found.select("doc_id", "score")


def search_any_term(spark: SparkSession, sf: str) -> DataFrame:
    found = search.search(_documents(spark, sf), ANY_TERMS, "text", "any")
    return found.select("doc_id", "score")


def search_phrase(spark: SparkSession, sf: str) -> DataFrame:
    return search.search_phrase(_documents(spark, sf), SEARCH_PHRASE, "text").select("doc_id")


def search_number(spark: SparkSession, sf: str) -> DataFrame:
    found = search.search(ad.log_events(spark, sf), SEARCH_NUMBERS, mode="any")
    return found.select("log_id", "score")


def search_non_ascii(spark: SparkSession, sf: str) -> DataFrame:
    return search.search(_documents(spark, sf), SEARCH_NON_ASCII, "text", "any").select("doc_id", "score")


def search_newest(spark: SparkSession, sf: str) -> DataFrame:
    found = search.search(ad.log_events(spark, sf), ("purchase", "user"))
    return search.newest(found, 20, "event_time", "log_id").select("log_id", F.unix_micros("event_time").alias("epoch_us"))


def filter_facets(spark: SparkSession, sf: str) -> DataFrame:
    return search.filter_events(
        ad.log_events(spark, sf), min_level="WARN", services=["svc-1", "svc-3"], hosts=["host-1", "host-2", "host-3"],
        since="2024-01-05T00:00:00Z", until="2024-01-25T12:00:00Z",
    ).select("log_id")


def filter_attribute(spark: SparkSession, sf: str) -> DataFrame:
    return search.filter_events(ad.json_events(spark, sf), attribute=("k", "42")).select("log_id")


def agg_by_level(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.count_by(ad.log_events(spark, sf), "level")


def top_services(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.top_groups(ad.log_events(spark, sf), "service", 3)


def date_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.date_histogram(ad.log_events(spark, sf)).select(
        F.date_format("bucket", times.DATE_FORMAT).alias("bucket"), "level", "n"
    )


def distinct_traces(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.distinct_count(ad.log_events(spark, sf), "service", "trace_id")


def value_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    result = aggregate.percentiles(ad.adapted(spark, sf, "value"), "level", "value", [0.5, 0.95, 0.99, 0.999])
    return result.select("level", *[F.round(p, 6).alias(p) for p in ("p50", "p95", "p99", "p99_9")])


def percentiles_approx(spark: SparkSession, sf: str) -> DataFrame:
    """For each level and point, whether the rank of the sketch's answer is within a thousandth of the wanted one."""
    rows = ad.adapted(spark, sf, "value").select("level", "value")
    points = {aggregate.percentile_name(q): q for q in (0.5, 0.95, 0.999)}
    found = aggregate.percentiles_approx(rows, "level", "value", list(points.values()))
    ranks = rows.join(found, "level").groupBy("level").agg(F.count("*").alias("n"), *[
        F.struct(F.count_if(F.col("value") < F.col(p)).alias("below"), F.count_if(F.col("value") <= F.col(p)).alias("upto")).alias(p)
        for p in points
    ])
    near = [
        ((F.col(p)["below"] <= (q + 0.001) * F.col("n") + 1) & (F.col(p)["upto"] >= (q - 0.001) * F.col("n") - 1)).alias(p)
        for p, q in points.items()
    ]
    return ranks.select("level", *near)


def metrics_sliding(spark: SparkSession, sf: str) -> DataFrame:
    return _metric_rows(aggregate.metrics(ad.log_events(spark, sf), "1 hour", slide="30 minutes"))


def metrics_session(spark: SparkSession, sf: str) -> DataFrame:
    sessions = aggregate.session_metrics(ad.log_events(spark, sf), "10 minutes", ["service"])
    return sessions.select(
        F.unix_micros("session_start").alias("start_us"), F.unix_micros("session_end").alias("end_us"), "service", "n", "n_error"
    )


def level_service_cube(spark: SparkSession, sf: str) -> DataFrame:
    cube = aggregate.cube_counts(ad.log_events(spark, sf), "level", "service")
    return cube.select(
        F.coalesce("level", F.lit("*")).alias("level"), F.coalesce("service", F.lit("*")).alias("service"), "subtotal", "n"
    )


def trace_timeline(spark: SparkSession, sf: str) -> DataFrame:
    events = ad.log_events(spark, sf).select("trace_id", "log_id", "event_time")
    return trace.timeline(events).select("log_id", "gap_us")


def context_around_error(spark: SparkSession, sf: str) -> DataFrame:
    events = ad.log_events(spark, sf).select("service", "event_time", "log_id", "level")
    return trace.around_errors(events, 60).select("error_id", "log_id", "gap_us")


def service_health(spark: SparkSession, sf: str) -> DataFrame:
    return health.service_health(ad.log_events(spark, sf)).withColumn("error_share", F.round("error_share", 6))


def silent_services(spark: SparkSession, sf: str) -> DataFrame:
    return health.silent(ad.log_events(spark, sf), 24, ["service", "trace_id"])


def alert_windows(spark: SparkSession, sf: str) -> DataFrame:
    metrics = aggregate.metrics(ad.log_events(spark, sf))
    return _metric_rows(health.alerts(metrics, 0.4, min_events=3)).drop("bytes")


def unusual_counts(spark: SparkSession, sf: str) -> DataFrame:
    metrics = aggregate.metrics(ad.log_events(spark, sf))
    return health.anomalies(metrics, ["service"]).select(
        F.date_format("window_start", times.DATE_TIME_FORMAT).alias("window_start"), "service", "n", F.round("z", 6).alias("z")
    )


# ---- streams to tables

def uppercase_stream(spark: SparkSession, sf: str) -> DataFrame:
    source = spark.readStream.schema(ad.table(spark, sf, "events").schema).parquet(f"{sf}/events*.parquet")
    path = work_path(spark, "upper")
    checkpoint = work_path(spark, "stream")
    rows = source.select("event_id", F.col("event_type").alias("value"))
    jobs.run_map_stream(
        rows, F.upper("value"), lambda df: jobs.file_writer(df, path, checkpoint), trigger=None
    ).awaitTermination()
    return spark.read.schema("event_id bigint, value string").parquet(path)


def index_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    base = _landed(spark, sf, ad.json_line(), F.lit("app.ndjson"))
    stream = binding.valid_events(binding.bind(landing.stream_landing(spark, base), "json", arrival=F.col("landed_at")))
    path = work_path(spark, "index")
    jobs.drain(log_index.index_writer(stream, path, work_path(spark, "stream")))
    return aggregate.count_by(log_index.read_index(spark, path), "level")


def archive_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "archive")
    log_index.archive(ad.log_events(spark, sf), path)
    days = log_index.read_index(spark, path)
    return days.groupBy(F.col("event_date").cast("string").alias("event_date")).agg(_long(F.count("*")).alias("n"))


def route_by_source(spark: SparkSession, sf: str) -> DataFrame:
    """Every source in a folder of its own."""
    path = work_path(spark, "sources")
    rows = collector.route(_files(spark, sf)).select("tag", "log_id", ad.log_line().alias("value"))
    log_index.write_by_source(rows, path)
    sources = spark.read.schema("log_id string, value string, tag string").parquet(path)
    return sources.select("tag", "log_id")


def client_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of one client, read from its folder."""
    base = _landed(spark, sf, ad.log_line(), F.lit("app.log"))
    return binding.valid_events(binding.bind(landing.read_landing(spark, base, client="c-1"), "log")).select("log_id")


# ---- index with its source, versions, other formats

def _indexed(spark: SparkSession, sf: str) -> str:
    """The events as log lines of four clients, streamed into an index with their source."""
    base, path = _landed(spark, sf, ad.log_line(), F.lit("app.log")), work_path(spark, "index")
    jobs.run_log_stream(
        landing.stream_landing(spark, base, max_files_per_trigger=4), path, work_path(spark, "quarantine"),
        work_path(spark, "stream"), parser=F.col("parser"), keep=["client_id", "file_path", "tag"],
        arrival=F.col("landed_at"), trigger=None,
    ).awaitTermination()
    return path


def index_with_source(spark: SparkSession, sf: str) -> DataFrame:
    """What one client sees of the index, with where it came from."""
    seen = log_index.read_tenant(spark, _indexed(spark, sf), "c-2")
    return seen.select("log_id", "client_id", "tag", F.col("file_path").contains("client_id=c-2/").alias("in_own_folder"))


def compact_index(spark: SparkSession, sf: str) -> DataFrame:
    """The index after its closed dates, all but the newest, were put together: the same events, few files a date."""
    path = _indexed(spark, sf)
    log_index.compact_index(spark, path, stopped=True)
    rows = log_index.read_index(spark, path).select(
        F.col("event_date").cast("string").alias("event_date"), (~F.input_file_name().contains("ingest_batch=-")).alias("as_streamed")
    )
    return aggregate.count_by(rows, "event_date", "as_streamed")


def archive_proof(spark: SparkSession, sf: str) -> DataFrame:
    """Dates of the index expire if all their rows are archived; those of which a row was changed stay."""
    path, archived = work_path(spark, "index"), work_path(spark, "archive")
    events = ad.log_events(spark, sf)
    log_index.write_index(events, path)
    changed = F.when(F.col("log_id").cast("bigint") % CHANGED_EVERY == 0, F.upper("message")).otherwise(F.col("message"))
    log_index.archive(events.withColumn("message", changed), archived)
    newest = events.agg(F.max(F.to_date("event_time")).cast("string")).first()[0] or ""
    told = log_index.expire(spark, path, archived, newest)
    left = aggregate.count_by(log_index.read_index(spark, path), "event_date").withColumnRenamed("n", "n_left")
    return told.join(left, "event_date", "left").select(
        F.col("event_date").cast("string").alias("event_date"), "n", "n_missing", "expired", F.coalesce("n_left", F.lit(0)).alias("n_left")
    )


CHANGED_EVERY = 701


def archive_twice(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "archive")
    for _ in range(2):
        log_index.archive(ad.log_events(spark, sf), path)
    return log_index.read_index(spark, path).select("log_id", "level")


OLD_NAMES = {"1": {"id": "logId", "ts": "timestamp", "svc": "service", "lvl": "level", "msg": "message"}}


def bind_by_version(spark: SparkSession, sf: str) -> DataFrame:
    """Every other record has the field names of version 1."""
    old = text('{"id":"', F.col("log_id"), '","ts":"', F.col("ts_text"), '","svc":"', F.col("service"), '","lvl":"',
               F.col("level"), '","msg":"', F.col("message"), '"}')
    version = (F.col("event_id") % 2 + 1).cast("string")
    rows = ad.adapted(spark, sf).select(version.alias("v"), F.when(version == "1", old).otherwise(ad.json_line()).alias("value"))
    bound = versions.bind_by_version(rows, F.col("v"), OLD_NAMES, arrival=ad.no_time())
    return binding.valid_events(bound, "v").select(
        "v", "log_id", F.unix_micros("event_time").alias("epoch_us"), "service", "level", "message", "host"
    )


RECORD_VERSIONS = (
    registry.Version("1", "id INT NOT NULL, svc STRING, n INT, old STRING"),
    registry.Version("2", "id BIGINT NOT NULL, service STRING, n INT", {"svc": "service"}),
    registry.Version("3", "id BIGINT NOT NULL, owner STRING, n DOUBLE, at DATE", {"service": "owner"}),
)


def bind_registered_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Records of three registered versions, and of one that is not, typed as the last; some have a text for a number."""
    path = work_path(spark, "registry")
    for version in RECORD_VERSIONS:
        registry.register(spark, path, version)
    c, place = F.col, F.col("event_id") % 4
    n = F.when(c("event_id") % 7 == 3, F.lit('"many"')).otherwise(c("user_id").cast("string"))
    half = F.when(c("event_id") % 7 == 3, F.lit('"many"')).otherwise(text(c("user_id").cast("string"), ".5"))
    value = (
        F.when(place == 0, text('{"id":', c("log_id"), ',"svc":"', c("service"), '","n":', n, ',"old":"', c("level"), '"}'))
        .when(place == 1, text('{"id":', (c("event_id") + 5_000_000_000).cast("string"), ',"service":"', c("service"), '","n":', n, "}"))
        .otherwise(text('{"id":', c("log_id"), ',"owner":"', c("service"), '","n":', half, ',"at":"', F.substring("ts_text", 1, 10), '"}'))
    )
    rows = ad.adapted(spark, sf).select("log_id", (place + 1).cast("string").alias("v"), value.alias("value"))
    bound = registry.bind_versions(rows, c("v"), registry.read_registry(spark, path))
    return bound.select(
        "log_id", "v", "reason", c("record.id").alias("id"), c("record.owner").alias("owner"), c("record.n").alias("n"),
        c("record.at").cast("string").alias("at_date"),
    )


def otel_to_events(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as an export of its own, with its resource, a severity name or number, and two attributes."""
    def attribute(key: str, value: Column) -> list:
        return ['{"key":"', key, '","value":{"stringValue":"', value, '"}}']

    c = F.col
    severity = F.when(c("event_id") % 2 == 0, text('"severityText":"', c("level"), '"')).otherwise(
        text('"severityNumber":', (enrich.level_rank(c("level")) * 4 + 1).cast("string"))
    )
    nanos = (F.unix_micros(F.to_timestamp("ts_text")) * 1000).cast("string")
    value = text(
        '{"resourceLogs":[{"resource":{"attributes":[', *attribute("service.name", c("service")), ",",
        *attribute("host.name", c("host")), ",", *attribute("k8s.pod.name", c("pod_name")), ']},"scopeLogs":[{"logRecords":[{"timeUnixNano":"',
        nanos, '",', severity, ',"body":{"stringValue":"', c("message"), '"},"traceId":"', c("trace_id"), '","attributes":[',
        *attribute("log.record.uid", c("log_id")), ",", *attribute("k", c("attr_k")), "]}]}]}]}",
    )
    events = otel.otel_events(ad.adapted(spark, sf).select(value.alias("value")))
    first = F.element_at("attributes", 1)
    return events.select(
        "log_id", "host", F.unix_micros("event_time").alias("epoch_us"), "service", "pod_name", "trace_id", "level", "message",
        first["key"].alias("attr_key"), first["value"].alias("attr_value"), _long(F.size("attributes")).alias("n_attrs"),
    )


def otel_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Five kinds of texts in turn, of which one is an export, with an array for its body."""
    c = F.col
    logs = lambda inner: text('{"resourceLogs":[{"scopeLogs":[{"logRecords":[{"severityNumber":', inner, "}]}]}]}")
    kinds = [
        logs(text('9,"body":{"arrayValue":{"values":[{"stringValue":"', c("message"), '"}]}}')), c("message"),
        text('{"resourceSpans":[],"id":"', c("log_id"), '"}'), logs(text('"', c("level"), '"')), F.lit(" "),
    ]
    rows = ad.adapted(spark, sf).select("log_id", F.element_at(F.array(*kinds), (c("event_id") % len(kinds) + 1).cast("int")).alias("value"))
    bad = otel.otel_quarantine(rows, "value", "log_id").select("log_id", "reason", "raw")
    good = otel.otel_events(rows.withColumnRenamed("log_id", "id"), "value", "id")
    return bad.unionByName(good.select(F.col("id").alias("log_id"), F.lit(None).cast("string").alias("reason"), F.col("message").alias("raw")))


def enrich_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Each event with the nation that owned its service at its time; owners change every six days, with a day between."""
    start = F.lit("2024-01-01").cast("timestamp")
    turn = F.floor(F.col("n_nationkey") / 5).cast("int")
    owners = ad.table(spark, sf, "nation").select(
        text("svc-", (F.col("n_nationkey") % 5).cast("string")).alias("service"), F.col("n_name").alias("owner"),
        (start + F.make_dt_interval(turn * 6)).alias("valid_from"),
        F.when(turn < 4, start + F.make_dt_interval(turn * 6 + 5)).alias("valid_to"),
    )
    return enrich.join_as_of(ad.log_events(spark, sf), owners, ["service"], ["owner"]).select("log_id", "owner")


# ---- the index with terms, clustered, and rolled up

def _with_terms(spark: SparkSession, sf: str) -> tuple[str, str]:
    """An index of the events with their attributes, and its terms."""
    path, terms_path = work_path(spark, "index"), work_path(spark, "terms")
    log_index.write_index(ad.json_events(spark, sf), path)
    terms.update_terms(spark, path, terms_path)
    return path, terms_path


def search_terms_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """A search that opens only the files with both words."""
    path, terms_path = _with_terms(spark, sf)
    return terms.search_index(spark, path, terms_path, ("purchase", INDEXED_USER)).select("log_id", "score")


INDEXED_USER = "17"


def search_phrase_indexed(spark: SparkSession, sf: str) -> DataFrame:
    path, terms_path = _with_terms(spark, sf)
    return terms.phrase_in_index(spark, path, terms_path, f"user {INDEXED_USER}").select("log_id")


def filter_attribute_indexed(spark: SparkSession, sf: str) -> DataFrame:
    path, terms_path = _with_terms(spark, sf)
    return terms.attribute_in_index(spark, path, terms_path, "k", "42").select("log_id")


def lookup_trace(spark: SparkSession, sf: str) -> DataFrame:
    """The events of one trace and service in the clustered index, with their time gaps."""
    path = work_path(spark, "clustered")
    clustered.write_clustered(ad.log_events(spark, sf), path)
    found = search.filter_events(log_index.read_index(spark, path), services=["svc-2"], trace_id=f"t{INDEXED_USER}")
    return trace.timeline(found).select("log_id", "gap_us")


def rollup_days(spark: SparkSession, sf: str) -> DataFrame:
    """Days put together from stored hours: counts, and whether the sketches' answers are within their bounds."""
    events, path = ad.log_events(spark, sf), work_path(spark, "rollup")
    rollups.write_hours(rollups.hourly(events), path)
    days = rollups.figures(rollups.merged(rollups.read_hours(spark, path), "day"))
    size, day = F.octet_length("message"), F.date_trunc("day", "event_time").alias("hour")
    exact = events.groupBy(day, "service").agg(F.count_distinct("trace_id").alias("traces"))
    ranks = events.select(day, "service", size.alias("size")).join(days.select("hour", "service", "p95"), ["hour", "service"]).groupBy(
        "hour", "service"
    ).agg(F.count("*").alias("all"), F.count_if(F.col("size") < F.col("p95")).alias("below"), F.count_if(F.col("size") <= F.col("p95")).alias("upto"))
    near = (F.col("below") <= 0.98 * F.col("all") + 1) & (F.col("upto") >= 0.92 * F.col("all") - 1)
    return days.join(exact, ["hour", "service"]).join(ranks, ["hour", "service"]).select(
        F.date_format("hour", times.DATE_FORMAT).alias("day"), "service", "n", "n_error", "bytes",
        (F.abs(F.col("n_traces") - F.col("traces")) <= 0.05 * F.col("traces") + 1).alias("traces_near"), near.alias("p95_near"),
        _long(F.col("top_hosts")[0]["count"]).alias("top_host_n"),
    )


def rollup_late(spark: SparkSession, sf: str) -> DataFrame:
    """Hours after a tenth of the events arrived late: only the hours these belong to were computed again."""
    events = ad.log_events(spark, sf)
    late = F.col("log_id").cast("bigint") % 10 == 3
    path = work_path(spark, "rollup")
    rollups.write_hours(rollups.hourly(events.where(~late)), path)
    rollups.update_hours(events, events.where(late), path)
    return rollups.read_hours(spark, path).select(
        F.date_format("hour", times.DATE_TIME_FORMAT).alias("window_start"), "service", "n", "n_error", "bytes"
    )


def silence_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Services that fall silent for an hour, and come back, as a stream tells them."""
    source = spark.readStream.schema(ad.table(spark, sf, "events").schema).parquet(f"{sf}/events*.parquet")
    events = source.select(F.col("ts").cast("timestamp").alias("event_time"), text("svc-", (F.col("user_id") % 5).cast("string")).alias("service"))
    path = work_path(spark, "silence")
    with silence.timer_state(spark):
        jobs.drain(jobs.file_writer(silence.silence_alerts(events, 1), path, work_path(spark, "stream")))
    return spark.read.schema("service string, alert string, at_us bigint").parquet(path)


def repeated_delivery(spark: SparkSession, sf: str) -> DataFrame:
    """A landing folder whose first third is delivered twice, as a topic may do: each event is indexed once."""
    base, path = work_path(spark, "landing"), work_path(spark, "index")
    rows = ad.adapted(spark, sf).select(F.lit("c-1").alias("client_id"), F.lit("app.ndjson").alias("file_name"), "event_id", ad.json_line().alias("line"))
    landing.land_lines(rows.drop("event_id"), base)
    landing.land_lines(rows.where("event_id % 3 = 0").drop("event_id"), base)
    jobs.run_log_stream(
        landing.stream_landing(spark, base, max_files_per_trigger=4), path, work_path(spark, "quarantine"), work_path(spark, "stream"),
        parser=F.col("parser"), arrival=F.col("landed_at"), trigger=None, repeats_within="1 day",
        state_partitions=max(16, 2 * spark.sparkContext.defaultParallelism),
    ).awaitTermination()
    return log_index.read_index(spark, path).select("log_id", "level")


REGISTERED = (
    src_raw_json, tail_log_lines, tail_json_lines, tail_csv_lines, tail_raw_lines, landing_path_columns,
    explode_request_body, body_quarantine, body_record_count, drop_date_key, kafka_payload,
    bind_log_event, validate_split, quarantine_counts, filter_valid_level, replay_quarantine, replay_out,
    route_by_extension, filter_by_tag, csv_line_match, union_all_formats, mixed_formats,
    parse_log_line, parse_csv_line, parse_log_time, normalize_timestamp, parse_attributes,
    event_to_json, bulk_index_actions, document_size, oversize_filter, bulk_batches_by_count,
    bulk_batches_by_bytes, doc_timestamp_forms,
    attributes_flat, attributes_nest, transform_event, enrich_service_dim,
    metrics_per_hour, metrics_stream, metrics_sliding, metrics_session, search_terms, search_any_term, search_phrase, search_number,
    search_non_ascii, search_newest,
    filter_facets, filter_attribute, agg_by_level, top_services, date_histogram, distinct_traces,
    value_percentiles, percentiles_approx, level_service_cube, trace_timeline, context_around_error, service_health, silent_services,
    alert_windows, unusual_counts, route_by_source, client_lines,
    uppercase_stream, index_roundtrip, archive_roundtrip, index_with_source, compact_index, archive_twice, archive_proof,
    bind_by_version, bind_registered_versions, otel_to_events, otel_quarantine, enrich_as_of,
    search_terms_indexed, search_phrase_indexed, filter_attribute_indexed, lookup_trace, rollup_days, rollup_late, repeated_delivery, silence_stream,
)
