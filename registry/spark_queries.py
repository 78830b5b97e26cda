"""Every registered query.  Each reads whole tables and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry import views
from rollcall.config import scratch_dir
from rollcall.functions import people as P
from rollcall.functions import rules
from rollcall.functions.codec import from_json_text, to_json_bytes
from rollcall.operators import events as E
from rollcall.operators import people as ops
from rollcall.operators import statistics as S
from rollcall.operators.processor import (
    RecordSpec,
    accepted,
    check,
    create_people,
    business_spec,
    json_parser,
    parse_people,
    person_id_from,
    process,
    rejected,
    storage_spec,
)
from rollcall.operators.quality import (
    ProcessingStats,
    SuccessRateTooLow,
    processing_stats,
    rejects_by_rule,
    validate_lake,
)
from rollcall.operators.report import report_figures
from rollcall.operators.runs import concatenate, lake_inventory, run_history, run_log_summary
from rollcall.plans import jobs
from rollcall.schemas import EVENT_FIELDS, EVENT_TEXT, LAKE, PERSON_FIELDS
from rollcall.sinks import event_log as log_sink
from rollcall.sinks import files as sink
from rollcall.sinks import storage
from rollcall.sources import event_log as log_source
from rollcall.sources import files as source
from rollcall.sources.generator import people_from_index
from rollcall.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEY = "c_custkey"
FIXED_TIME = "2024-01-01T00:00:00Z"
FIXED_MILLIS = 1_704_067_200_000
# The hour before which the batch view is complete, in the lambda merge.
BATCH_CUT = ("2024-01-15", "12")


def register(query: Query) -> Query:
    """Register under the function's name, less a trailing underscore."""
    QUERIES[query.__name__.rstrip("_")] = query
    return query


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _readable(spark: SparkSession, sf: str) -> DataFrame:
    """People that pass the record rules, in canonical form, as a re-validating read gives them."""
    spec = storage_spec()
    return accepted(check(views.people(spark, sf), spec), spec)


# Batch analytics


@register
def city_statistics(spark, sf):
    return _rounded(S.city_statistics(views.people(spark, sf)), "avg_age", "stddev_age")


@register
def record_count(spark, sf):
    return S.record_count(views.people(spark, sf))


@register
def enrich_people(spark, sf):
    return ops.enrich(views.people(spark, sf))


@register
def sample_people(spark, sf):
    return ops.enriched_sample(views.people(spark, sf))


@register
def batch_sample(spark, sf):
    return ops.batch_sample(_readable(spark, sf))


@register
def city_report(spark, sf):
    return S.city_report(_readable(spark, sf))


@register
def age_group_distribution(spark, sf):
    return S.age_group_distribution(_readable(spark, sf))


@register
def status_distribution(spark, sf):
    return S.status_distribution(_readable(spark, sf))


@register
def domain_distribution(spark, sf):
    """Over raw rows, so that every form of address occurs."""
    return S.domain_distribution(views.people(spark, sf))


@register
def batch_profile(spark, sf):
    return S.batch_profile(_readable(spark, sf))


@register
def combined_report(spark, sf):
    return S.combined_report(_readable(spark, sf))


@register
def city_report_raw(spark, sf):
    """Over raw rows, where a city may have no age at all."""
    return S.city_report(views.people(spark, sf))


@register
def report_document(spark, sf):
    """The report written out, twice on one path, and read back; the header is the total again."""
    root = scratch_dir(spark, "report")
    report = S.combined_report(_readable(spark, sf))
    for _ in range(2):
        sink.write_report(report, root, F.lit(FIXED_TIME))
    header = (F.col("section") == sink.HEADER) & (F.col("key") == FIXED_TIME)
    return sink.read_report_figures(spark, root).withColumns(
        {"key": F.when(~header, F.col("key")), "section": F.when(header, F.lit("total")).otherwise(F.col("section"))}
    )


@register
def statistics_round_trip(spark, sf):
    """City statistics written, written over, and read."""
    path = scratch_dir(spark, "stats")
    people = views.people(spark, sf)
    sink.write_statistics(S.city_statistics(people.filter(F.col("age") < 30)), path)
    sink.write_statistics(S.city_statistics(people), path)
    return _rounded(spark.read.parquet(path), "avg_age", "stddev_age")


# Attributes of a person


@register
def person_attributes(spark, sf):
    return ops.attributes(views.people(spark, sf))


@register
def domain_fallback(spark, sf):
    people = views.people(spark, sf)
    return people.select(KEY, P.domain_or_unknown(F.col("email")).alias("domain"))


@register
def categorize_people(spark, sf):
    return ops.categorize(views.people(spark, sf)).withColumn(
        "suspend_reason", rules.suspend_reason(F.col("status"))
    )


@register
def anonymize_people(spark, sf):
    return ops.anonymize(views.people(spark, sf))


@register
def summarize_people(spark, sf):
    return ops.summarize(views.people(spark, sf)).select(
        KEY, "summary", rules.storage_status(F.col("status")).alias("storage_status")
    )


@register
def set_status(spark, sf):
    return ops.with_status(views.people(spark, sf), "Inactive")


@register
def normalize_people(spark, sf):
    return ops.normalize(views.people(spark, sf))


@register
def storage_rows(spark, sf):
    """Canonical storage text of the readable rows."""
    good = accepted(check(views.people(spark, sf), storage_spec()), storage_spec())
    return ops.to_storage(good)


# Validation


def _rule_query(name: str, *errors: Callable[[], Column]) -> None:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        columns = {f"{e.__name__}": e() for e in errors}
        return views.people(spark, sf).select(KEY, *[c.alias(n) for n, c in columns.items()])

    QUERIES[name] = query


def email_error() -> Column:
    return rules.email_error(F.col("email"))


def age_error() -> Column:
    return rules.age_error(F.col("age"))


def city_error() -> Column:
    return rules.city_error(F.col("city"))


def status_error() -> Column:
    return rules.status_error(F.col("status"))


def id_error() -> Column:
    return rules.id_error(F.col("id"))


def created_at_error() -> Column:
    return rules.created_at_error(F.col("createdAt"))


_rule_query("validate_email", email_error)
_rule_query("validate_age", age_error)
_rule_query("validate_city", city_error)
_rule_query("validate_status", status_error)
_rule_query("validate_id_time", id_error, created_at_error)


@register
def first_error(spark, sf):
    return check(views.people(spark, sf), storage_spec()).select(KEY, "error", "error_rule")


@register
def business_rules(spark, sf):
    return check(views.people(spark, sf), business_spec()).select(KEY, "error", "error_rule")


@register
def quarantine(spark, sf):
    return rejected(check(views.people(spark, sf), storage_spec()))


@register
def rejects(spark, sf):
    return rejects_by_rule(check(views.people(spark, sf), storage_spec()))


@register
def processing_stats_(spark, sf):
    stats = processing_stats(check(views.people(spark, sf), storage_spec()), KEY)
    return _rounded(stats, "success_rate").withColumn(
        "sample_errors", F.array_join("sample_errors", " | ")
    )


@register
def lake_validation(spark, sf):
    return validate_lake(views.people(spark, sf))


@register
def create_people_(spark, sf):
    raw = views.people(spark, sf).select(KEY, "name", "email", "age", "city")
    return create_people(
        raw, person_id_from(F.concat(F.lit("c"), F.col(KEY).cast("string"))), F.lit(FIXED_TIME)
    )


@register
def generate_people(spark, sf):
    """One generated person per customer key."""
    keys = views.table(spark, sf, "customer").select(KEY)
    return people_from_index(keys, KEY, F.lit(FIXED_TIME))


# Files


def _staged_lines(spark: SparkSession, sf: str) -> str:
    path = scratch_dir(spark, "lines")
    views.person_lines(spark, sf).write.text(path)
    return path


@register
def parse_json_people(spark, sf):
    lines = source.read_json_lines(spark, _staged_lines(spark, sf))
    return parse_people(lines).select(*PERSON_FIELDS, "error", "error_rule")


@register
def preprocess_people(spark, sf):
    """JSON Lines to people and quarantine, then both read back."""
    target = scratch_dir(spark, "people")
    jobs.preprocess(spark, _staged_lines(spark, sf), target, minimum_rate=None)
    columns = [*PERSON_FIELDS, "error", "error_rule", sink.OUTCOME]
    return spark.read.parquet(target).select(*columns)


@register
def check_json_people(spark, sf):
    stats = jobs.check_lines(spark, _staged_lines(spark, sf), "value")
    return _rounded(stats, "success_rate").select("total", "successful", "failed", "success_rate")


@register
def revalidate_people(spark, sf):
    """Rows stored as they are; the read drops the bad ones."""
    path = scratch_dir(spark, "stored")
    views.people(spark, sf).select(*PERSON_FIELDS).write.parquet(path)
    return source.read_people(spark, path)


@register
def people_round_trip(spark, sf):
    """Readable people written and read again."""
    path = scratch_dir(spark, "typed")
    sink.write_people(_readable(spark, sf), path)
    return source.read_people(spark, path)


@register
def json_lines_round_trip(spark, sf):
    path = scratch_dir(spark, "jsonl")
    sink.write_json_lines(_readable(spark, sf), path, *PERSON_FIELDS)
    parsed = parse_people(source.read_json_lines(spark, path))
    return parsed.select(*PERSON_FIELDS, "error")


@register
def publish_from_file(spark, sf):
    """Lines of a file as messages, staged and decoded again."""
    log = scratch_dir(spark, "log")
    counts, dropped = jobs.publish_file(
        spark,
        _staged_lines(spark, sf),
        lambda messages: log_sink.publish_staged(messages, log),
        F.lit(FIXED_MILLIS),
    )
    decoded = E.decode_events(spark.read.parquet(log))
    return decoded.select(
        *EVENT_FIELDS,
        F.lit(counts.success).cast("bigint").alias("published"),
        F.lit(counts.failure).cast("bigint").alias("failed"),
        F.lit(dropped).cast("bigint").alias("dropped"),
    )


def _lake_events(spark: SparkSession, sf: str) -> DataFrame:
    return views.events(spark, sf).select(*EVENT_FIELDS)


def _written_lake(spark: SparkSession, sf: str) -> str:
    path = scratch_dir(spark, "lake")
    sink.write_lake(_lake_events(spark, sf), path)
    return path


@register
def lake_scan(spark, sf):
    return source.read_lake(spark, _written_lake(spark, sf))


@register
def land_batch(spark, sf):
    """A batch landed at a fixed run time, next to the events of the same lake."""
    lake = _written_lake(spark, sf)
    sink.land_batch(_readable(spark, sf), lake, F.lit(FIXED_MILLIS))
    return source.read_lake(spark, lake)


def _mixed_lake(spark: SparkSession, sf: str) -> str:
    """Both layouts below one root: people by dt, events by dt and hour."""
    lake = _written_lake(spark, sf)
    day = F.when(F.col("createdAt").startswith("2024"), F.substring("createdAt", 1, 10))
    legacy = views.people(spark, sf).select(*PERSON_FIELDS)
    legacy = legacy.withColumn("dt", F.coalesce(day, F.lit("1970-01-01")))
    legacy.hint("rebalance", "dt").write.mode("append").partitionBy("dt").parquet(lake)
    return lake


@register
def recursive_scan(spark, sf):
    return source.scan_data_files(spark, _mixed_lake(spark, sf)).select(*LAKE.names)


@register
def union_layouts(spark, sf):
    """Both layouts, each read from its own root, as one table."""
    root = scratch_dir(spark, "legacy")
    people = views.people(spark, sf).select(*PERSON_FIELDS)
    people.withColumn("dt", F.lit("2024-01-01")).write.partitionBy("dt").parquet(root)
    return concatenate(
        source.read_legacy_lake(spark, root), source.read_lake(spark, _written_lake(spark, sf))
    )


def _hour_files(spark: SparkSession, sf: str) -> str:
    """A lake with one file for each hour, so that files can be counted from the events."""
    lake = scratch_dir(spark, "hours")
    keyed = E.partition_keys(_lake_events(spark, sf)).repartition("dt", "hour")
    keyed.write.partitionBy("dt", "hour").parquet(lake)
    return lake


@register
def lake_inventory_(spark, sf):
    """How many files there are, and whether the sizes agree."""
    found = lake_inventory(source.list_data_files(spark, _hour_files(spark, sf)))
    return found.select(
        "files",
        (F.col("total_bytes") > 0).alias("has_bytes"),
        (F.col("size_kb") == F.call_function("div", F.col("total_bytes"), F.lit(1024))).alias("size_agrees"),
    )


@register
def run_history_(spark, sf):
    """Records of each hour's file, and whether its total covers them."""
    lake = _hour_files(spark, sf)
    counts = source.readable_by_file(source.scan_data_files(spark, lake))
    history = run_history(counts, source.list_data_files(spark, lake))
    return history.select(
        F.regexp_extract("path", "/dt=([^/]+)/", 1).alias("dt"),
        F.regexp_extract("path", "/hour=([^/]+)/", 1).alias("hour"),
        "records",
        (F.col("cumulative_total") >= F.col("records")).alias("covered"),
    )


@register
def lake_evolved(spark, sf):
    """A column that only the files of some hours carry."""
    lake = _written_lake(spark, sf)
    newer = _lake_events(spark, sf).filter(F.col("age") > 50).withColumn("country", F.concat(F.lit("of "), "city"))
    sink.write_lake(newer, lake)
    extra = T.StructType([T.StructField("country", T.StringType())])
    return source.read_lake(spark, lake, extra=extra)


@register
def lake_merged(spark, sf):
    """Columns that newer batches carry, found by the reader; one of them grew wider."""
    lake = _written_lake(spark, sf)
    events = _lake_events(spark, sf).filter(F.col("age") > 50)
    for kind in ("int", "bigint"):
        sink.write_lake(events.withColumns({"country": F.concat(F.lit("of "), "city"), "visits": F.col("age").cast(kind)}), lake)
    return source.read_lake(spark, lake, merge_schema=True)


@register
def recursive_scan_days(spark, sf):
    """Two days of both layouts, of which alone the folders are read."""
    days = source.scan_data_files(spark, _mixed_lake(spark, sf), dt_from="2024-01-03", dt_to="2024-01-04")
    return days.select(*LAKE.names)


@register
def run_history_refreshed(spark, sf):
    """The history kept up file by file: two batches, a refresh after each, and one with nothing new."""
    lake, store = _hour_files(spark, sf), f"{scratch_dir(spark, 'history')}/files"
    read, files = [], []
    for newer in (None, F.col("age") > 50):
        if newer is not None:
            sink.write_lake(_lake_events(spark, sf).filter(newer), lake)
        files.append(source.list_data_files(spark, lake).count())
        read += [jobs.refresh_history(spark, lake, store), jobs.refresh_history(spark, lake, store)]
    history = jobs.read_history(spark, lake, store)
    by_hour = history.groupBy(
        F.regexp_extract("path", "/dt=([^/]+)/", 1).alias("dt"), F.regexp_extract("path", "/hour=([^/]+)/", 1).alias("hour")
    ).agg(F.sum("records").alias("records"))
    totals = history.agg(F.max("cumulative_total").alias("last_total"))
    new_only = read == [files[0], 0, files[1] - files[0], 0]
    return by_hour.join(F.broadcast(totals)).withColumn("new_files_only", F.lit(new_only))


@register
def report_figures_(spark, sf):
    """A report document for each of seven ages modulo, written as JSON and read side by side."""
    root = scratch_dir(spark, "documents")
    people = _readable(spark, sf).withColumn("site", F.col("age") % 7).withColumn("domain", P.domain_or_unknown(F.col("email")))
    group = P.age_group(F.col("age"))

    def part(key: Column, *figures: Column) -> DataFrame:
        return people.groupBy("site", key.alias("key")).agg(F.count(F.lit(1)).alias("n"), *figures)

    def counts(key: Column, name: str) -> DataFrame:
        entries = F.map_from_entries(F.collect_list(F.struct("key", "n")))
        return part(key).groupBy("site").agg(entries.alias(name))

    cities = part(F.col("city"), F.min("age").alias("low"), F.max("age").alias("high"))
    city = F.struct(F.col("key").alias("city"), F.col("n").alias("total_people"), F.col("low").alias("min_age"), F.col("high").alias("max_age"))
    band = F.struct(F.col("key").alias("age_group"), F.col("n").alias("count"))
    documents = (
        people.groupBy("site")
        .agg(F.count(F.lit(1)).alias("total_records"))
        .join(cities.groupBy("site").agg(F.collect_list(city).alias("city_statistics")), "site")
        .join(part(group).groupBy("site").agg(F.collect_list(band).alias("age_groups")), "site")
        .join(counts(F.col("status"), "status_distribution"), "site")
        .join(counts(F.col("domain"), "email_domains"), "site")
    )
    text = F.to_json(F.struct(*documents.columns[1:]), {"pretty": "true"})
    documents.select("site", text.alias("value")).repartition("site").write.partitionBy("site").text(root)
    figures = report_figures(source.read_reports(spark, root))
    site = F.regexp_extract("source", "/site=([^/]+)/", 1).cast("int").alias("site")
    return figures.select(site, "section", "key", "count", "min_age", "max_age")


@register
def run_history_totals(spark, sf):
    """Last running total of the history, and the sum it must equal."""
    return jobs.export_history(spark, _mixed_lake(spark, sf)).agg(
        F.max("cumulative_total").alias("last_total"), F.sum("records").alias("records")
    )


@register
def file_running_total(spark, sf):
    """The running total behind the run history, with one entry per customer."""
    runs = views.table(spark, sf, "customer").select(
        F.col(KEY).cast("string").alias("path"),
        F.timestamp_seconds(F.col("c_nationkey") + FIXED_MILLIS // 1000).alias("modificationTime"),
        (F.col(KEY) * 100).alias("length"),
    )
    records = views.table(spark, sf, "orders").groupBy(F.col("o_custkey").cast("string").alias("path"))
    history = run_history(records.agg(F.count(F.lit(1)).alias("records")), runs)
    return history.select("path", "records", "cumulative_total", "size_kb")


@register
def lake_compacted(spark, sf):
    """A lake of five batches an hour, packed: its rows, and whether folders and names came out right."""
    lake = scratch_dir(spark, "lake")
    part = F.pmod(F.xxhash64("id", "eventTime"), F.lit(5))
    for n in range(5):
        sink.write_lake(_lake_events(spark, sf).filter(part == n), lake)
    before = source.list_data_files(spark, lake).count()
    removed = source.compact_lake(spark, lake)
    after = source.list_data_files(spark, lake).count()
    rows = source.read_lake(spark, lake, batches=True)
    return rows.select(
        *LAKE.names,
        F.col("batch").startswith("write-").alias("keeps_batch"),
        F.lit(after < before and removed > after).alias("packed"),
    )


# Events


@register
def run_log_summary_(spark, sf):
    return run_log_summary(views.run_log(spark, sf))


@register
def event_records(spark, sf):
    """People as events, at a given time, and decoded from their messages."""
    people = views.events(spark, sf)
    sent = E.encode_events(E.to_events(people, F.col("eventTime")))
    return E.decode_events(sent).drop("value")


@register
def event_messages(spark, sf):
    return E.encode_events(views.events(spark, sf))


@register
def event_bytes(spark, sf):
    """Events through their binary form and back."""
    coded = views.events(spark, sf).select("event_id", to_json_bytes(EVENT_FIELDS).alias("bytes"))
    decoded = from_json_text(F.col("bytes"), EVENT_TEXT).alias("e")
    return coded.select("event_id", decoded).select("event_id", *[f"e.{f}" for f in EVENT_FIELDS])


@register
def decode_outcomes(spark, sf):
    """Messages per decode outcome."""
    decoded = E.decode_events(views.messages(spark, sf))
    return decoded.groupBy("error", "error_rule").agg(F.count(F.lit(1)).alias("messages"))


@register
def event_partitions(spark, sf):
    keyed = E.partition_keys(views.events(spark, sf))
    ts = E.event_timestamp(F.col("eventTime")).cast("timestamp_ntz").alias("event_ts")
    return keyed.select("event_id", ts, "dt", "hour")


def _timed(events: DataFrame) -> DataFrame:
    return events.withColumn("event_ts", E.event_timestamp(F.col("eventTime")))


def _figures(df: DataFrame) -> DataFrame:
    starts = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    return _rounded(df.withColumns(starts), "avg_age", "stddev_age")


@register
def hourly_window(spark, sf):
    return _figures(E.hourly_figures(_timed(views.events(spark, sf))))


@register
def lambda_merge(spark, sf):
    """Batch view of the hours before a cut, speed view of everything."""
    keyed = E.partition_keys(views.events(spark, sf)).select("event_id", "age", "dt", "hour")
    closed = F.struct("dt", "hour") < F.struct(*map(F.lit, BATCH_CUT))
    batch = keyed.filter(closed).withColumn("layer", F.lit("batch"))
    return E.lambda_merge(batch, keyed.withColumn("layer", F.lit("speed")))


@register
def lambda_statistics(spark, sf):
    """City statistics of a batch view and a speed view together.

    The batch view covers the days before the cut.  Then late events of these days and all newer
    ones arrive, the stream's last batch is run again, and the batch view catches up with a part
    of the late days.
    """
    root = scratch_dir(spark, "views")
    lake, view, speed, checkpoint = (f"{root}/{n}" for n in ("lake", "batch", "speed", "cp"))
    millis = F.get_json_object("value", "$.eventTime").cast("bigint")
    early = F.coalesce((millis < FIXED_MILLIS + 14 * 86_400_000) & (F.xxhash64("value") % 4 != 0), F.lit(True))
    messages = views.messages(spark, sf)

    def stream() -> None:
        source_log = log_source.stream_staged_messages(spark, f"{root}/topic")
        _run(ingest.ingest_to_lake(source_log, lake, checkpoint, f"{root}/bad", interval=None, speed_view=speed))

    log_sink.publish_staged(messages.filter(early), f"{root}/topic")
    stream()
    jobs.refresh_batch_view(spark, lake, view, dt_to=BATCH_CUT[0])
    log_sink.publish_staged(messages.filter(~early), f"{root}/topic")
    stream()
    last = max(storage.files(spark, f"{checkpoint}/commits"), key=lambda n: int(n) if n.isdigit() else -1)
    storage.delete(spark, f"{checkpoint}/commits/{last}")
    stream()
    jobs.refresh_batch_view(spark, lake, view, "2024-01-03", "2024-01-05")
    return _rounded(jobs.lambda_statistics(spark, view, speed), "avg_age", "stddev_age")


# Longest value that the log of `publish_outcomes` takes, in bytes.
MOST_BYTES = 254


def _open_small_log():
    """A sender whose log refuses long values and what is no JSON object."""

    def deliver(batch):
        return [
            "Too large" if len(value.encode()) > MOST_BYTES else None if value.endswith("}") else "Not an object"
            for _, value in batch
        ]

    return deliver


@register
def publish_outcomes(spark, sf):
    """Messages sent one by one to a log that refuses some: outcomes, and the counts of the run."""
    path = scratch_dir(spark, "outcomes")
    keyed = views.messages(spark, sf).withColumn("key", F.when(~F.col("key").endswith("0"), F.col("key")))
    counts = log_sink.publish_acknowledged(keyed, _open_small_log, path)
    outcomes = spark.read.schema("key string, value string, error string").parquet(path)
    grouped = outcomes.groupBy("error").agg(F.count(F.lit(1)).alias("messages"))
    return grouped.withColumns({"success": F.lit(counts.success).cast("bigint"), "failure": F.lit(counts.failure).cast("bigint")})


# Streams


def _message_stream(spark: SparkSession, sf: str) -> DataFrame:
    log = scratch_dir(spark, "topic")
    log_sink.publish_staged(views.messages(spark, sf), log)
    return log_source.stream_staged_messages(spark, log)


def _run(query) -> None:
    query.awaitTermination()


def _to_lake(spark: SparkSession, sf: str, lake: str, checkpoint: str) -> None:
    stream = _message_stream(spark, sf)
    _run(ingest.ingest_to_lake(stream, lake, checkpoint, f"{lake}-bad", interval=None))


@register
def stream_to_lake(spark, sf):
    """Events of the lake, and how many messages the quarantine has."""
    root = scratch_dir(spark, "stream")
    _to_lake(spark, sf, f"{root}/lake", f"{root}/cp")
    rejected = ingest.read_quarantine(spark, f"{root}/lake-bad").agg(F.count(F.lit(1)).alias("rejected"))
    return source.read_lake(spark, f"{root}/lake").join(F.broadcast(rejected))


@register
def stream_two_topics(spark, sf):
    """Two topics with checkpoints of their own feed one lake."""
    root = scratch_dir(spark, "stream")
    for n in (1, 2):
        _to_lake(spark, sf, f"{root}/lake", f"{root}/cp{n}")
    return source.read_lake(spark, f"{root}/lake").groupBy("dt", "hour").agg(F.count(F.lit(1)).alias("events"))


@register
def stream_and_land(spark, sf):
    """Streamed and landed rows in one root."""
    root = scratch_dir(spark, "stream")
    _to_lake(spark, sf, f"{root}/lake", f"{root}/cp")
    sink.land_batch(_readable(spark, sf), f"{root}/lake", F.lit(FIXED_MILLIS))
    return source.read_lake(spark, f"{root}/lake")


@register
def stream_restart(spark, sf):
    """A stream stopped and started on its checkpoint, with more messages: each is there once."""
    root = scratch_dir(spark, "stream")
    messages = views.messages(spark, sf)
    first = F.xxhash64("value") % 2 == 0
    for part in (messages.filter(first), messages.filter(~first)):
        log_sink.publish_staged(part, f"{root}/topic")
        for _ in range(2):
            stream = log_source.stream_staged_messages(spark, f"{root}/topic")
            _run(ingest.ingest_to_lake(stream, f"{root}/lake", f"{root}/cp", f"{root}/bad", interval=None))
    return source.read_lake(spark, f"{root}/lake")


@register
def stream_late_events(spark, sf):
    """The newest hours first, then all older ones: late events change their hours' figures."""
    root = scratch_dir(spark, "stream")
    late = F.get_json_object("value", "$.eventTime").cast("bigint") < FIXED_MILLIS + 10 * 86_400_000
    messages = views.messages(spark, sf)
    late = F.coalesce(late, F.lit(False))
    for part in (messages.filter(~late), messages.filter(late)):
        log_sink.publish_staged(part, f"{root}/topic")
        stream = log_source.stream_staged_messages(spark, f"{root}/topic")
        _run(ingest.hourly_stream(stream, f"{root}/hours", f"{root}/cp", interval=None))
    return _figures(ingest.read_hours(spark, f"{root}/hours"))


@register
def stream_closed_hours(spark, sf):
    """Hours closed by the watermark over three batches and two restarts, and how many events each lost.

    The last batch brings the newest events, and events of the first days, whose hours are closed.
    """
    root = scratch_dir(spark, "stream")
    time, age = (F.get_json_object("value", f"$.{c}").cast("bigint") for c in ("eventTime", "age"))
    late = F.coalesce((time < FIXED_MILLIS + 5 * 86_400_000) & (age % 10 == 0), F.lit(False))
    batch = F.when(late | (time >= FIXED_MILLIS + 20 * 86_400_000), 3).when(time >= FIXED_MILLIS + 10 * 86_400_000, 2)
    messages = views.messages(spark, sf).withColumn("batch", F.coalesce(batch, F.lit(1)))
    for n in (1, 2, 3):
        log_sink.publish_staged(messages.filter(F.col("batch") == n).drop("batch"), f"{root}/topic")
        for start, out in ((ingest.closed_hours_stream, "closed"), (ingest.hourly_stream, "hours")):
            stream = log_source.stream_staged_messages(spark, f"{root}/topic")
            _run(start(stream, f"{root}/{out}", f"{root}/cp-{out}", interval=None))
    closed = ingest.read_closed_hours(spark, f"{root}/closed")
    return _figures(E.late_after_close(closed, ingest.read_hours(spark, f"{root}/hours")))


@register
def stream_quarantine(spark, sf):
    root = scratch_dir(spark, "stream")
    stream = _message_stream(spark, sf)
    ingest.quarantine_stream(stream, f"{root}/bad", f"{root}/cp", interval=None).awaitTermination()
    bad = spark.read.schema("value string, error string, error_rule string").parquet(f"{root}/bad")
    return bad.groupBy("error", "error_rule").agg(F.count(F.lit(1)).alias("messages"))


@register
def stream_validation(spark, sf):
    """Validated stream: rows of the lake, and the quarantine's rows by reason."""
    root = scratch_dir(spark, "stream")
    ingest.ingest_validated(
        _message_stream(spark, sf), f"{root}/lake", f"{root}/bad", f"{root}/cp", interval=None
    ).awaitTermination()
    good = source.read_lake(spark, f"{root}/lake").select(F.lit("accepted").alias("outcome"))
    bad = ingest.read_quarantine(spark, f"{root}/bad")
    return (
        concatenate(good, bad.select(F.lit("rejected").alias("outcome"), "error_rule"))
        .groupBy("outcome", "error_rule")
        .agg(F.count(F.lit(1)).alias("messages"))
    )


@register
def stream_hourly(spark, sf):
    root = scratch_dir(spark, "stream")
    stream = _message_stream(spark, sf)
    _run(ingest.hourly_stream(stream, f"{root}/hours", f"{root}/cp", interval=None))
    return _figures(ingest.read_hours(spark, f"{root}/hours"))


# Records of any table


@register
def spec_on_orders(spark, sf):
    """The record checks over a table that is not of people."""
    orders = views.table(spark, sf, "orders")
    spec = RecordSpec(
        ("o_orderkey", "o_custkey", "o_totalprice"),
        {
            "customer": F.when(F.col("o_custkey") % 7 == 0, F.concat(F.lit("Bad customer "), F.col("o_custkey"))),
            "price": F.when(F.col("o_totalprice") < 1000, F.lit("Too cheap")),
        },
    )
    return check(orders, spec).select("o_orderkey", "error", "error_rule")


@register
def spec_on_order_lines(spark, sf):
    """Orders as JSON text through the runner that people go through: parse, rules, transforms."""
    key = F.col("o_orderkey")
    price = F.when(key % 13 == 0, F.lit("dear")).otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    customer = F.when(key % 17 != 0, F.when(key % 19 == 0, F.lit("1.5")).otherwise(F.col("o_custkey").cast("string")))
    day = F.when(key % 23 == 0, F.lit("1995-02-30")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    fields = {"o_custkey": customer, "o_totalprice": price, "o_orderdate": day}
    text = F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))
    text = F.when(key % 29 == 0, F.lit("[]")).otherwise(text)
    lines = views.table(spark, sf, "orders").select("o_orderkey", text.alias("value"))
    schema = T.StructType(
        [
            T.StructField("o_custkey", T.LongType()),
            T.StructField("o_totalprice", T.DecimalType(18, 2)),
            T.StructField("o_orderdate", T.DateType()),
        ]
    )
    spec = RecordSpec(
        tuple(schema.names),
        {"price": F.when(F.col("o_totalprice") < 1000, F.lit("Too cheap"))},
        {"o_totalprice": (F.col("o_totalprice") * 2).cast("decimal(18,2)")},
        json_parser(schema, required_fields=("o_custkey",)),
    )
    done = process(lines, spec).drop("value")
    return done.withColumns({"o_totalprice": F.col("o_totalprice").cast("double"), "o_orderdate": F.col("o_orderdate").cast("string")})


@register
def success_gate(spark, sf):
    """Whether the gate lets a run pass, at three limits."""
    stats = processing_stats(check(views.people(spark, sf), storage_spec()), KEY).first()
    measured = ProcessingStats(stats["total"], stats["successful"], stats["failed"])

    def passes(limit: float) -> bool:
        try:
            measured.require(limit)
        except SuccessRateTooLow:
            return False
        return True

    return spark.createDataFrame([(n, passes(float(n))) for n in (25, 50, 95)], "minimum int, passes boolean")
