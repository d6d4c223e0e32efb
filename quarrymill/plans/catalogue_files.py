"""Registered queries on sources, typed tables, result files, catalogues, streams and specifications, with their SQL.

Those that write do so in a new folder of the shared one and read back what was written.
"""

from __future__ import annotations

import base64
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions import transforms
from quarrymill.functions.types import DType, clean_text
from quarrymill.operators import dictionary as enums
from quarrymill.operators import prepare
from quarrymill.operators.intervals import interval, report_range, whole_intervals
from quarrymill.plans import engine, partials
from quarrymill.plans.catalogue import _A, _B, _SUM, DOUBLE, END, EVENTS, INT, LONG, MONEY, START, TEXT, VECTORS, _all_uses, _pairs, _with_ip, events, query, stats, table
from quarrymill.plans.spec import ColumnSpec, DatasetSpec, ReportSpec, Transform
from quarrymill.sources import audit, readers, store
from quarrymill.streaming.reports import STORE, stream_statistics

_N = (("*", "count", "n"),)
_LAST = datetime(2024, 2, 3)
_IN = "ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-03'"

DAILY = DatasetSpec(
    "events",
    (_all_uses("user_id", LONG), _all_uses("event_type", TEXT), ColumnSpec("value", DType(203), statistical=True), ColumnSpec("event_id", LONG, statistical=True), ColumnSpec("ts", TEXT, filterable=False)),
    data_interval="Daily", header=("event_id", "user_id", "event_type", "value", "ts"), filename="day=%Y-%m-%d", ignore_missing_datafile=True, cache_timeout=1000, time_column="interval_start",
)


def values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def sql_values(rows: list[tuple], names: str) -> str:
    text = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(text, r)) + ')' for r in rows)}) AS t({names})"


def _span(s: SparkSession, d: str) -> tuple[datetime, datetime]:
    """The least and the greatest time of the events."""
    return tuple(table(s, d, "events").agg(F.min("ts"), F.max("ts")).first())


# --- files by interval and the typed table -------------------------------------------------------------------------


def _daily_files(s: SparkSession, d: str) -> str:
    """Events as CSV, a folder a day."""
    at = store.work_folder(s) + "/days"
    rows = table(s, d, "events").select("event_id", "user_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), F.date_format("ts", "yyyy-MM-dd").alias("day"))
    rows.write.partitionBy("day").option("escape", '"').csv(at)
    return at


@query("q_source_files", f"""
SELECT strftime(day, '%Y-%m-%d') AS day, count(event_id) AS n, count(event_id) = 0 AS missing
FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-02', INTERVAL 1 DAY)) AS day) LEFT JOIN events ON date_trunc('day', ts) = day GROUP BY day""")
def _(s, d):
    origin = readers.source("localfs", home=_daily_files(s, d))
    files = readers.interval_files(DAILY, START, _LAST)
    rows, missing = origin.read(s, DAILY, files)
    found = rows.groupBy(F.date_format(readers.INTERVAL, "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n")).withColumn("missing", F.lit(False))
    return found.unionByName(values(s, [(f.removeprefix("day="), 0, True) for f in missing], "day string, n bigint, missing boolean"))


@query("q_typed_table", f"SELECT event_type, count(*) AS n, {_SUM} AS total FROM events WHERE {_IN} GROUP BY event_type")
def _(s, d):
    """Parts of the range come out of order, one of them twice, and at last what is stale of the whole."""
    origin, at = readers.source("localfs", home=_daily_files(s, d)), store.work_folder(s) + "/typed"
    for a, b in ((11, 34), (1, 6), (6, 11), (6, 11)):
        store.download(s, DAILY, origin, at, START + timedelta(a - 1), START + timedelta(b - 1))
    store.download(s, DAILY, origin, at, START, _LAST, requested=START, only_stale=True)
    return stats(DAILY, store.load(s, at).withColumn("value", F.col("value").cast(MONEY)), group_by=("event_type",), resultset=(*_N, ("value", "sum", "total")))


@query("q_refreshed_columns", "SELECT event_type, count(*) AS n FROM (SELECT CASE WHEN ts >= TIMESTAMP '2024-01-04' THEN upper(event_type) ELSE event_type END AS event_type FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-07') GROUP BY event_type")
def _(s, d):
    """A column whose definition changed: the days that are asked for are made again, the others stay."""
    origin, at = readers.source("localfs", home=_daily_files(s, d)), store.work_folder(s) + "/typed"
    end = START + timedelta(6)
    store.download(s, DAILY, origin, at, START, end)
    loud = DatasetSpec(**{**DAILY.__dict__, "columns": tuple(ColumnSpec("event_type", TEXT, groupable=True, normalize="upper(event_type)") if c.name == "event_type" else c for c in DAILY.columns)})
    store.download(s, loud, origin, at, START + timedelta(3), end, requested=datetime.now() + timedelta(days=1), only_stale=True)
    store.download(s, DAILY, origin, at, START, end, only_stale=True)
    return store.load(s, at).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("q_retention", f"SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day FROM events WHERE {_IN} ORDER BY day DESC LIMIT 7")
def _(s, d):
    origin, at = readers.source("localfs", home=_daily_files(s, d)), store.work_folder(s) + "/typed"
    store.download(s, DatasetSpec(**{**DAILY.__dict__, "cache_timeout": 7}), origin, at, START, _LAST)
    return store.load(s, at).select(F.date_format(readers.INTERVAL, "yyyy-MM-dd").alias("day")).distinct()


@query("q_pruned_columns", "SELECT 'event_id' AS name, count(event_id) AS n FROM events UNION ALL SELECT 'event_type', count(event_type) FROM events UNION ALL SELECT 'user_id', count(user_id) FROM events UNION ALL SELECT 'value', count(value) FROM events")
def _(s, d):
    """The columns that reports use, with their values; the others aren't read."""
    kept = prepare.prepare(table(s, d, "events"), DAILY)
    return kept.agg(*(F.count(c).alias(c) for c in kept.columns)).unpivot([], kept.columns, "name", "n")


@query("q_empty_day", f"""
SELECT strftime(day, '%Y-%m-%d') AS request_time, count(event_id) AS n, coalesce({_SUM}, 0) AS total
FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-28', TIMESTAMP '2024-02-02', INTERVAL 1 DAY)) AS day) LEFT JOIN events ON date_trunc('day', ts) = day GROUP BY day""")
def _(s, d):
    """Days whose files hold no rows are in the table as empty ones: not missing, not fetched again, zeros in a report."""
    home, at = _daily_files(s, d), store.work_folder(s) + "/typed"
    low, high = datetime(2024, 1, 28), datetime(2024, 2, 3)
    for day in ("2024-01-31", "2024-02-01", "2024-02-02"):  # the events end before
        fs, path = store._fs(s, f"{home}/day={day}/part-0.csv")
        if not fs.exists(path.getParent()):
            fs.create(path).close()
    origin = readers.source("localfs", home=home)
    store.download(s, DAILY, origin, at, low, high)
    if store.stale(s, at, readers.interval_files(DAILY, low, high), None):
        raise RuntimeError("an empty day is taken for a missing one")
    rows = store.load(s, at).withColumn("value", F.col("value").cast(MONEY))
    out = stats(DAILY, rows, rtype="Daily", start=low, end=high, resultset=(*_N, ("value", "sum", "total")))
    return out.select(F.date_format("request_time", "yyyy-MM-dd").alias("request_time"), "n", F.col("total").cast("double").alias("total"))


def _stored(s: SparkSession, d: str, rtype: str) -> DataFrame:
    """Daily states, made for one type first, merged for another after one day came again."""
    origin, at, root = readers.source("localfs", home=_daily_files(s, d)), store.work_folder(s) + "/typed", store.work_folder(s)
    spec = lambda kind: ReportSpec("q", "events", START, _LAST, kind, group_by=("event_type",), resultset=(*_N, ("user_id", "distinct", "users"), ("event_id", "sum", "ids"), ("event_id", "min", "least"), ("event_id", "max", "most"), ("event_id", "avg", "mean")))
    store.download(s, DAILY, origin, at, START, _LAST)
    partials.run_statistics(s, spec("Daily"), DAILY, at, root)
    store.download(s, DAILY, origin, at, START + timedelta(9), START + timedelta(10))
    out = partials.run_statistics(s, spec(rtype), DAILY, at, root)[0]
    return out.select(F.date_format("request_time", "yyyy-MM-dd").alias("request_time"), "event_type", "users", "n", "ids", "least", "most", F.round("mean", 6).alias("mean"))


def _stored_sql(bucket: str) -> str:
    return f"""SELECT strftime({bucket}, '%Y-%m-%d') AS request_time, event_type, count(DISTINCT user_id) AS users, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, min(event_id) AS least, max(event_id) AS most,
    round(sum(event_id) / count(*), 6) AS mean FROM events WHERE ts >= date_trunc('{'week' if 'week' in bucket else 'month'}', TIMESTAMP '2024-01-01') AND ts < {"TIMESTAMP '2024-01-29'" if 'week' in bucket else "TIMESTAMP '2024-02-01'"} GROUP BY 1, 2"""


@query("q_stored_weeks", _stored_sql("date_trunc('week', ts)"))
def _(s, d):
    return _stored(s, d, "MondayBasedWeekly")


@query("q_stored_months", _stored_sql("date_trunc('month', ts)"))
def _(s, d):
    return _stored(s, d, "Monthly")


# --- formats -------------------------------------------------------------------------------------------------------


@query("q_csv_round_trip", "SELECT doc_id, md5(coalesce(text, '')) AS digest FROM documents")
def _(s, d):
    """Texts with quotes, commas and line breaks."""
    at = store.work_folder(s) + "/csv"
    store.write_csv(table(s, d, "documents").select("doc_id", "text"), at)
    return readers.read_csv(s, at, ("doc_id", "text"), has_header=True).select(F.col("doc_id").cast("bigint"), F.md5(F.coalesce("text", F.lit(""))).alias("digest"))


@query("q_csv_blocks", "SELECT doc_id, md5(coalesce(text, '')) AS digest, lang FROM documents")
def _(s, d):
    """The same texts cut into records by blocks, from files whose headers have their names in another order."""
    at, own = store.work_folder(s), table(s, d, "documents")
    store.write_csv(own.where("doc_id % 2 = 0").select("doc_id", "text", "lang"), f"{at}/a")
    store.write_csv(own.where("doc_id % 2 <> 0").select("lang", "doc_id", "text"), f"{at}/b")
    rows = readers.read_csv(s, [f"{at}/a", f"{at}/b"], ("doc_id", "text", "lang"), has_header=True, blocks=True)
    return rows.select(F.col("doc_id").cast("bigint"), F.md5(F.coalesce("text", F.lit(""))).alias("digest"), "lang")


@query("q_jsonline_round_trip", "SELECT event_id, event_type, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts, CASE WHEN user_id % 7 = 0 THEN NULL ELSE user_id END AS user_id FROM events")
def _(s, d):
    at = store.work_folder(s) + "/lines"
    store.write_jsonline(table(s, d, "events").select("event_id", "event_type", "ts", F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("user_id")), at)
    rows = readers.read_jsonline(s, at)
    return rows.select(F.col("event_id").cast("bigint").alias("event_id"), "event_type", "ts", F.col("user_id").cast("bigint").alias("user_id"))


@query("q_jsonlistline_round_trip", "SELECT p_partkey, p_name, p_size FROM part UNION ALL SELECT NULL, 'p_name', NULL")
def _(s, d):
    """Lists by line in several files, each with its header; a row of the header's own words stays."""
    at = store.work_folder(s) + "/lists"
    own = table(s, d, "part").select(F.col("p_partkey").cast("string"), "p_name", F.col("p_size").cast("string"))
    store.write_jsonlistline(own.union(values(s, [("p_partkey", "p_name", "p_size")], own.schema.simpleString()[7:-1].replace(":", " "))).repartition(3), at)
    rows = readers.read_jsonlistline(s, at)
    return rows.select(F.col("p_partkey").try_cast("bigint").alias("p_partkey"), "p_name", F.col("p_size").try_cast("int").alias("p_size"))


@query("q_rows_of_other_widths", "SELECT event_id, event_type, CASE WHEN event_id % 2 = 0 THEN props END AS props FROM events")
def _(s, d):
    at = store.work_folder(s)
    own = table(s, d, "events")
    store.write_csv(own.where("event_id % 2 = 0").select("event_id", "event_type", "props"), f"{at}/wide", header=False)
    store.write_csv(own.where("event_id % 2 <> 0").select("event_id", "event_type"), f"{at}/narrow", header=False)
    rows = readers.read_csv(s, [f"{at}/wide", f"{at}/narrow"], ("event_id", "event_type", "props"))
    return rows.select(F.col("event_id").cast("bigint").alias("event_id"), "event_type", "props")


@query("q_json_flatten_record", """
SELECT CAST(event_id AS VARCHAR) AS id, event_type AS category, CAST(user_id AS VARCHAR) AS "initiatedBy_user_id", 'mill' AS "initiatedBy_app_displayName",
       'x' || user_id AS "targetResource_User_displayName", '(kind.old=,kind.new=' || event_type || ')(n.old=1,n.new=2)' AS "targetResource_User_modifiedProperties", 'v' AS "additionalDetails_k" FROM events""")
def _(s, d):
    change = lambda name, old, new: F.struct(F.lit(name).alias("displayName"), old.cast("string").alias("oldValue"), new.alias("newValue"))
    changes = F.array(change("kind", F.lit(None), F.col("event_type")), change("n", F.lit("1"), F.lit("2")))
    record = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("category"),
        F.struct(F.struct(F.col("user_id").cast("string").alias("id")).alias("user"), F.struct(F.lit("mill").alias("displayName")).alias("app")).alias("initiatedBy"),
        F.array(F.struct(F.lit("k").alias("key"), F.lit("v").alias("value"))).alias("additionalDetails"),
        F.array(F.struct(F.lit("User").alias("type"), F.concat(F.lit("x"), F.col("user_id")).alias("displayName"), changes.alias("modifiedProperties"))).alias("targetResources"),
    ))
    rows, _ = audit.flatten(table(s, d, "events").select(record.alias("value")), known=("id", "category"))
    own = [c for c in rows.columns if c in ("id", "category") or c not in audit.SCALARS]  # the other scalars are empty here
    return rows.select(*(F.col(f"`{c}`").alias(c.replace(".", "_")) for c in own))


@query("q_blob_paths", "SELECT strftime(ts, '%Y-%m-%d') AS day, 'abfss://logs@store.dfs.core.windows.net/web/day=' || strftime(ts, '%Y-%m-%d') AS path, count(*) AS n FROM events GROUP BY ALL")
def _(s, d):
    """Where a blob store has each day of the events."""
    days = table(s, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    blob = readers.source("blobstorage", container="logs", account="store", home="web")
    low, high = _span(s, d)
    files = [(f"{a:%Y-%m-%d}", blob.path(f)) for a, _, f in readers.interval_files(DAILY, low, interval("Daily").next(high))]  # one row a day
    return days.join(values(s, files, "day string, path string"), "day").select("day", "path", "n")


@query("q_audit_slices", """
WITH span AS (SELECT min(ts) AS a, date_trunc('second', max(ts)) + INTERVAL 1 SECOND AS z FROM events)
SELECT event_type, count(*) AS n, true AS sliced FROM events, span WHERE ts < z GROUP BY event_type""")
def _(s, d):
    """Events by the slices of time that the audit source asks for: each row is in one slice."""
    low, high = _span(s, d)
    high = high.replace(microsecond=0) + timedelta(seconds=1)
    slices = [p.value for p in audit.AuditPages({"start": low.replace(microsecond=0).isoformat(), "end": high.isoformat(), "slices": "7"}).partitions()]
    inside = sum((((F.col("ts") >= F.lit(a).cast("timestamp_ntz")) & (F.col("ts") < F.lit(b).cast("timestamp_ntz"))).cast("int") for a, b in slices), F.lit(0))
    return table(s, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min(inside == 1).alias("sliced"))


# --- reports to files ----------------------------------------------------------------------------------------------


def _catalog(*reports: ReportSpec) -> store.Catalog:
    return store.Catalog({"events": EVENTS}, {r.id: r for r in reports})


@query("q_report_files", f"SELECT event_type, count(*) AS n, round({_SUM} / count(*), 6) AS mean, count(*) AS raw_count, {_SUM} AS raw_sum, 'Succeed' AS status FROM events GROUP BY event_type")
def _(s, d):
    """The final file and the raw one of a statistics report, read back and put side by side; the second run makes nothing new."""
    spec = ReportSpec("by type", "events", group_by=("event_type",), resultset=(*_N, ("value", "avg", "mean")), id=4, options={"single_file": True})
    catalog, at = _catalog(spec), store.work_folder(s)
    first = dict(store.run_report(s, catalog, spec, events(s, d), at))
    again = store.run_report(s, catalog, spec, events(s, d).limit(0), at)
    final = s.read.option("header", True).csv(again["file"])
    raw = s.read.option("header", True).csv(first["raw_file"]).select("event_type", F.col("count").cast("bigint").alias("raw_count"), F.col("value_sum").cast("double").alias("raw_sum"))
    return final.join(raw, "event_type").select("event_type", F.col("n").cast("bigint").alias("n"), F.round(F.col("mean").cast("double"), 6).alias("mean"), "raw_count", "raw_sum", F.lit(again["status"]).alias("status"))


@query("q_details_file", "SELECT event_id, user_id, event_type FROM events WHERE value >= 20 AND value < 30")
def _(s, d):
    spec = ReportSpec("some rows", "events", conditions=(("value", "between", [20, 30]),), id=5)
    status = store.run_report(s, _catalog(spec), spec, table(s, d, "events").select("event_id", "user_id", "event_type", "value"), store.work_folder(s))
    return s.read.option("header", True).csv(status["file"]).select(F.col("event_id").cast("bigint").alias("event_id"), F.col("user_id").cast("bigint").alias("user_id"), "event_type")


@query("q_report_status", sql_values([(1, "Succeed", True, ""), (2, "Failed", False, "InvalidReport"), (3, "Succeed", True, "missing files: day=2024-02-01")], "id, status, has_file, message"))
def _(s, d):
    good, bad, short = ReportSpec("g", "events", resultset=_N, id=1), ReportSpec("b", "events", resultset=(("value", "median", None),), id=2), ReportSpec("m", "events", resultset=_N, id=3)
    catalog, at = _catalog(good, bad, short), store.work_folder(s)
    for spec, missing in ((good, []), (bad, []), (short, ["day=2024-02-01"])):
        store.run_report(s, catalog, spec, events(s, d), at, missing=missing)
    told = lambda v: "InvalidReport" if v["status"] == "Failed" and "median" in base64.b64decode(v["message"]).decode() else v["message"]
    return values(s, [(k, v["status"], v["file"] is not None, told(v)) for k, v in sorted(catalog.status.items())], "id int, status string, has_file boolean, message string")


@query("q_catalog_instance", "SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15' AND value >= 10 AND value < 200 GROUP BY event_type")
def _(s, d):
    """A catalogue that is saved and loaded, and a periodic instance of one of its reports."""
    spec = ReportSpec("weekly", "events", conditions=(("value", "between", "[10, 200]"),), group_by=("event_type",), resultset=_N, id=7)
    catalog, at = _catalog(spec), store.work_folder(s) + "/catalog.json"
    catalog.instances[70] = (7, datetime(2024, 1, 8), datetime(2024, 1, 15))
    catalog.save(s, at)
    loaded = store.Catalog.load(s, at)
    return engine.run_statistics(s, loaded.instance(70), loaded.datasets["events"], table(s, d, "events"))[0]


@query("q_report_names", """
SELECT event_type, 'by_' || event_type || '-4-' || strftime(date_trunc('day', min(ts)), '%Y%m%d%H%M') || '-' || strftime(date_trunc('day', max(ts)), '%Y%m%d%H%M') || '-Daily.csv' AS name,
       'by_' || event_type || '-4-' || strftime(date_trunc('day', min(ts)), '%Y%m%d%H%M') || '-' || strftime(date_trunc('day', max(ts)), '%Y%m%d%H%M') || '-Daily-raw.csv' AS raw_name,
       '5-by_' || event_type || '-all-all.csv' AS details FROM events GROUP BY event_type""")
def _(s, d):
    """The result files' names of a report for each type of event, over the days that it has."""
    named, floor = [], interval("Daily").floor
    for r in table(s, d, "events").groupBy("event_type").agg(F.min("ts").alias("a"), F.max("ts").alias("z")).collect():  # a row a type
        spec = ReportSpec(f"by {r.event_type}", "events", floor(r.a), floor(r.z), "Daily", resultset=_N, id=4)
        named.append((r.event_type, store.report_filename(spec), store.report_filename(spec, raw=True), store.report_filename(ReportSpec(f"by {r.event_type}", "events", id=5))))
    return values(s, named, "event_type string, name string, raw_name string, details string")


def _streamed(s: SparkSession, rows: DataFrame, spec: ReportSpec) -> DataFrame:
    """Buckets that the watermark has closed, appended by a stream that reads what there is and ends."""
    at = store.work_folder(s)
    rows.write.parquet(f"{at}/in")  # streams read folders
    out = stream_statistics(spec, EVENTS, s.readStream.schema(rows.schema).parquet(f"{at}/in"))
    out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{at}/marks").trigger(availableNow=True).start(f"{at}/out").awaitTermination()
    return s.read.schema(out.schema).parquet(f"{at}/out").withColumn("request_time", F.date_format("request_time", "yyyy-MM-dd HH:mm:ss"))


@query("q_stream_buckets", f"""
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS request_time, event_type, count(*) AS n, {_SUM} AS total FROM events
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE GROUP BY 1, 2""")
def _(s, d):
    spec = ReportSpec("q", "events", rtype="Hourly", group_by=("event_type",), resultset=(*_N, ("value", "sum", "total")))
    rows = _streamed(s, table(s, d, "events").withColumn("value", F.col("value").cast(MONEY)), spec)
    return rows.select("request_time", "event_type", F.col("count").alias("n"), F.col("value_sum").cast("double").alias("total"))


@query("q_stream_distinct", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS request_time, event_type, count(DISTINCT user_id) AS users, count(*) AS n, max(event_id) AS last FROM events
WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE GROUP BY 1, 2""")
def _(s, d):
    spec = ReportSpec("q", "events", rtype="Daily", group_by=("event_type",), resultset=(("user_id", "distinct", "users"), *_N, ("event_id", "max", "last")))
    return _streamed(s, table(s, d, "events"), spec).select("request_time", "event_type", F.col("distinct").alias("users"), F.col("count").alias("n"), F.col("event_id_max").alias("last"))


_SPREAD = "ts + to_months(CAST(event_id % 3 AS INTEGER))"


@query("q_stream_months", f"""
SELECT strftime(date_trunc('month', t0), '%Y-%m-%d %H:%M:%S') AS request_time, event_type, count(DISTINCT user_id) AS users, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids
FROM (SELECT *, {_SPREAD} AS t0 FROM events) WHERE date_trunc('month', t0) + INTERVAL 1 MONTH <= (SELECT max({_SPREAD}) FROM events) - INTERVAL 10 MINUTE GROUP BY 1, 2""")
def _(s, d):
    """Events spread over three months, of which the last isn't over."""
    spec = ReportSpec("q", "events", rtype="Monthly", group_by=("event_type",), resultset=(("user_id", "distinct", "users"), *_N, ("event_id", "sum", "ids")))
    key = "spark.sql.streaming.stateStore.providerClass"
    before = s.conf.get(key)
    s.conf.set(key, STORE)
    try:
        rows = _streamed(s, table(s, d, "events").withColumn("ts", F.col("ts") + F.make_ym_interval(months=(F.col("event_id") % 3).cast("int"))), spec)
    finally:
        s.conf.set(key, before)
    return rows.select("request_time", "event_type", F.col("distinct").alias("users"), F.col("count").alias("n"), F.col("event_id_sum").alias("ids"))


# --- predicates, literals, checks ----------------------------------------------------------------------------------


@query("q_list_not_in_ranges", f"SELECT count(*) AS n FROM embeddings WHERE NOT (({_A} BETWEEN -1 AND 0 AND {_B} BETWEEN -1 AND 0) OR ({_A} BETWEEN 1 AND 2 AND {_B} BETWEEN 1 AND 2))")
def _(s, d):
    return stats(VECTORS, _pairs(s, d), conditions=(("pair", "not in ranges", [[-1, 0], [1, 2]]),), resultset=_N)


@query("q_list_raw_conditions", f"SELECT vec_id FROM embeddings WHERE {_A} BETWEEN -1 AND 0 AND {_B} BETWEEN 0 AND 1")
def _(s, d):
    spec = ReportSpec("q", "embeddings", raw_conditions=(("pair", "range", [[-1, 0], [0, 1]]),))
    return engine.run_details(s, spec, VECTORS, _pairs(s, d)).select("vec_id")


@query("q_distinct_lists", f"SELECT label, count(DISTINCT ({_A}, {_B})) AS pairs FROM embeddings GROUP BY label")
def _(s, d):
    spec = DatasetSpec("embeddings", (ColumnSpec("pair", DType(1203, dimension=2), distinctable=True), _all_uses("label", INT)), time_column="vec_id")
    return stats(spec, _pairs(s, d), group_by=("label",), resultset=(("pair", "distinct", "pairs"),))


@query("q_ipv6_range", "SELECT count(*) AS n FROM events WHERE user_id < 128")
def _(s, d):
    rows = events(s, d).withColumn("ip", F.concat(F.lit("2001:DB8::"), F.hex("user_id")))
    return stats(EVENTS, rows, conditions=(("ip", "ip ranges", ["2001:db8::/121", "10.0.0.0/8"]),), resultset=_N)


@query("q_text_in_brackets", "SELECT count(*) AS n FROM part WHERE p_size IN (7, 8)")
def _(s, d):
    """Text that looks like the beginning of JSON is text."""
    rows = table(s, d, "part").withColumn("tag", F.when(F.col("p_size") == 7, "[error").when(F.col("p_size") == 8, "[1, 2]").otherwise("{"))
    spec = DatasetSpec("part", (_all_uses("tag", TEXT),), time_column="p_partkey")
    one = stats(spec, rows, conditions=(("tag", "==", "[error"),), resultset=_N).union(stats(spec, rows, conditions=(("tag", "startswith", "[1, 2]"),), resultset=_N))
    return one.agg(F.sum("n").alias("n"))


@query("q_transformed_literals", "SELECT count(*) AS n FROM part WHERE starts_with(p_name, 'small')")
def _(s, d):
    transforms.register("loud", lambda c: F.upper(c))
    spec = DatasetSpec("part", (_all_uses("p_name", TEXT, transformer=Transform("loud")),), time_column="p_partkey")
    return stats(spec, table(s, d, "part").withColumn("p_name", F.upper("p_name")), conditions=(("p_name", "startswith", "small"),), options={"transform_literals": True}, resultset=_N)


# --- addresses -----------------------------------------------------------------------------------------------------


@query("q_address_places", """
SELECT event_id, CASE WHEN s_suppkey IS NOT NULL THEN 's' || s_suppkey END AS place
FROM (SELECT event_id, user_id % 256 * 256 + event_id % 256 AS n FROM events) LEFT JOIN supplier ON n BETWEEN s_suppkey * 60 AND s_suppkey * 60 + 39""")
def _(s, d):
    """All addresses and all ranges are in 10.0.0.0/16."""
    ip = F.concat_ws(".", F.lit("10"), F.lit("0"), F.col("user_id") % 256, F.col("event_id") % 256)
    ranges = table(s, d, "supplier").select(((10 << 24) + F.col("s_suppkey") * 60).alias("start_ip"), ((10 << 24) + F.col("s_suppkey") * 60 + 39).alias("end_ip"), F.concat(F.lit("s"), "s_suppkey").alias("place"))
    return enums.locate(table(s, d, "events").select("event_id", ip.alias("ip")), F.col("ip"), ranges, ["place"]).select("event_id", "place")


@query("q_address_places_v6", """
SELECT event_id, CASE WHEN s_suppkey IS NOT NULL THEN 's' || s_suppkey END AS place
FROM events LEFT JOIN supplier ON user_id = s_suppkey * 2 AND event_id % 65536 <= 32767""")
def _(s, d):
    """A number takes four groups of 16 bits, so that every key has an address."""
    groups = lambda n: reduce(F.concat, (F.concat(F.hex(F.shiftright(n, 16 * i).bitwiseAND(F.lit(65535))), F.lit(":")) for i in (3, 2, 1, 0)))
    low = F.concat(F.lit("2001:db8::"), groups(F.col("s_suppkey") * 2))
    ranges = table(s, d, "supplier").select(F.concat(low, F.lit("0")).alias("start_ip"), F.concat(low, F.lit("7FFF")).alias("end_ip"), F.concat(F.lit("s"), "s_suppkey").alias("place"))
    last = F.col("event_id") % 65536
    ip = F.concat(F.lit("2001:DB8:0:"), groups(F.col("user_id")), F.hex(F.when(last > 0, last).when(last <= 0, 0)))
    return enums.locate(table(s, d, "events").select("event_id", ip.alias("ip")), F.col("ip"), ranges, ["place"]).select("event_id", "place")


# --- intervals -----------------------------------------------------------------------------------------------------

#: Kinds with their floor and length in SQL.
_KINDS = (
    ("Hourly", "date_trunc('hour', {t})", "INTERVAL 1 HOUR"), ("HalfHourly", "time_bucket(INTERVAL 30 MINUTE, {t})", "INTERVAL 30 MINUTE"), ("Daily", "date_trunc('day', {t})", "INTERVAL 1 DAY"),
    ("MondayBasedWeekly", "date_trunc('week', {t})", "INTERVAL 7 DAY"), ("SundayBasedWeekly", "date_trunc('week', {t} + INTERVAL 1 DAY) - INTERVAL 1 DAY", "INTERVAL 7 DAY"), ("Monthly", "date_trunc('month', {t})", "INTERVAL 1 MONTH"),
)
_STAMP = "%Y-%m-%d %H:%M"


def _counted(s: SparkSession, d: str, ranges: list[tuple[str, datetime, datetime]]) -> DataFrame:
    """(kind, low, high, n): the events in each range that is one interval of its kind; there are as many as the ranges have intervals."""
    out = None
    for kind in dict.fromkeys(k for k, _, _ in ranges):
        own = values(s, [(k, a, b) for k, a, b in ranges if k == kind], "kind string, low timestamp_ntz, high timestamp_ntz")
        found = table(s, d, "events").groupBy(interval(kind).column(F.col("ts")).cast("timestamp_ntz").alias("low")).agg(F.count(F.lit(1)).alias("n"))
        one = own.join(found, "low", "left").select("kind", *(F.date_format(c, "yyyy-MM-dd HH:mm").alias(c) for c in ("low", "high")), F.coalesce("n", F.lit(0)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@query("q_whole_intervals", " UNION ALL ".join(
    f"SELECT '{k}' AS kind, strftime(a, '{_STAMP}') AS low, strftime(a + {step}, '{_STAMP}') AS high, (SELECT count(*) FROM events WHERE ts >= a AND ts < a + {step}) AS n "
    f"FROM (SELECT unnest(generate_series((SELECT {floor.format(t='min(ts)')} FROM events), (SELECT max(ts) FROM events), {step})) AS a) WHERE a + {step} <= (SELECT max(ts) FROM events)" for k, floor, step in _KINDS
))
def _(s, d):
    low, high = _span(s, d)
    return _counted(s, d, [(k, a, b) for k, _, _ in _KINDS for a, b in whole_intervals(interval(k), low, high, high)])


@query("q_default_start", " UNION ALL ".join(
    f"SELECT '{k}' AS kind, strftime(z - {step}, '{_STAMP}') AS low, strftime(z, '{_STAMP}') AS high, (SELECT count(*) FROM events WHERE ts >= z - {step} AND ts < z) AS n FROM (SELECT {floor.format(t='max(ts)')} AS z FROM events)" for k, floor, step in _KINDS
))
def _(s, d):
    """Without a start, the last interval that has ended at the time of the last event."""
    return _counted(s, d, [(k, a, b) for k, _, _ in _KINDS for a, b in whole_intervals(interval(k), None, None, _span(s, d)[1])])


@query("q_report_ranges", " UNION ALL ".join(
    f"SELECT '{k}' AS kind, {str(p).lower()} AS periodic, strftime(a, '%Y-%m-%d') AS low, strftime(z, '%Y-%m-%d') AS high, (SELECT count(*) FROM events WHERE ts >= a AND ts < z) AS n "
    f"FROM (SELECT {floor.format(t='min(ts)')} AS a, {floor.format(t='max(ts)')}{'' if p else f' + {step}'} AS z FROM events)" for k, floor, step in _KINDS[2:] for p in (True, False)
))
def _(s, d):
    """The rows of ad-hoc and periodic reports over all events, by kind."""
    low, high = _span(s, d)
    out = []
    for k, _, _ in _KINDS[2:]:
        for p in (True, False):
            a, z = report_range(interval(k), low, high, p)
            own = stats(EVENTS, table(s, d, "events"), start=low, end=high, rtype=k, periodic=p, resultset=_N)
            out.append(own.agg(F.sum("n").alias("n")).select(F.lit(k).alias("kind"), F.lit(p).alias("periodic"), F.lit(f"{a:%Y-%m-%d}").alias("low"), F.lit(f"{z:%Y-%m-%d}").alias("high"), F.coalesce("n", F.lit(0)).alias("n")))
    return reduce(DataFrame.unionByName, out)


_ZONED = "((ts + INTERVAL 60 DAY) AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York'"


def _in_new_york(s: SparkSession, d: str, **report) -> DataFrame:
    """Events moved into March, where the clock of the zone changes on the 10th."""
    spec = DatasetSpec(**{**EVENTS.__dict__, "timezone": "America/New_York"})
    out = stats(spec, table(s, d, "events").withColumn("ts", F.col("ts") + F.make_dt_interval(days=F.lit(60))), resultset=_N, **report)
    return out.withColumn("request_time", F.date_format("request_time", "yyyy-MM-dd HH:mm"))


@query("q_days_in_a_zone", f"""
SELECT strftime(day, '{_STAMP}') AS request_time, count(event_id) AS n FROM (SELECT unnest(generate_series(TIMESTAMP '2024-03-01', TIMESTAMP '2024-03-31', INTERVAL 1 DAY)) AS day)
LEFT JOIN (SELECT event_id, date_trunc('day', {_ZONED}) AS d FROM events) ON d = day GROUP BY day""")
def _(s, d):
    return _in_new_york(s, d, rtype="Daily", start=datetime(2024, 3, 1), end=datetime(2024, 4, 1))


@query("q_hours_in_a_zone", f"""
SELECT strftime(hour, '{_STAMP}') AS request_time, count(event_id) AS n
FROM (SELECT date_trunc('hour', (h AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') AS hour FROM (SELECT unnest(generate_series(TIMESTAMP '2024-03-09 05:00:00', TIMESTAMP '2024-03-11 03:00:00', INTERVAL 1 HOUR)) AS h))
LEFT JOIN (SELECT event_id, date_trunc('hour', {_ZONED}) AS t0 FROM events) ON t0 = hour GROUP BY hour""")
def _(s, d):
    """Two days, one of them of 23 hours."""
    return _in_new_york(s, d, rtype="Hourly", start=datetime(2024, 3, 9), end=datetime(2024, 3, 11))


@query("q_zone_by_type", f"SELECT strftime(date_trunc('week', {_ZONED}), '{_STAMP}') AS request_time, event_type, count(*) AS n FROM events GROUP BY ALL")
def _(s, d):
    return _in_new_york(s, d, rtype="MondayBasedWeekly", group_by=("event_type",))


# --- functions -----------------------------------------------------------------------------------------------------


@query("q_str2datetime", "SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS at FROM events")
def _(s, d):
    text = F.date_format("ts", "dd/MM/yyyy HH:mm:ss")
    at = transforms.apply("str2datetime", text, pattern="%d/%m/%Y %H:%M:%S", srctimezone="UTC", targettimezone="Australia/Perth")
    return table(s, d, "events").select("event_id", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("q_ip2city", "SELECT CASE WHEN user_id % 256 BETWEEN 0 AND 15 THEN 'Here Town' WHEN user_id % 256 BETWEEN 16 AND 99 THEN 'There' ELSE 'Internal' END AS city, count(*) AS n FROM events GROUP BY 1")
def _(s, d):
    ranges = values(s, [(10 << 24, (10 << 24) + (16 << 16) - 1, "here", "town"), ((10 << 24) + (16 << 16), (10 << 24) + (100 << 16) - 1, "there", "")], "start_ip bigint, end_ip bigint, country string, city string")
    found = enums.locate(_with_ip(s, d), F.col("ip"), ranges, ["country", "city"])
    return found.groupBy(enums.city_label(F.col("ip"), F.col("country"), F.col("city")).alias("city")).agg(F.count(F.lit(1)).alias("n"))


@query("q_get_enum", "SELECT key, id FROM (SELECT o_orderpriority AS key, CAST(dense_rank() OVER (ORDER BY o_orderpriority) AS BIGINT) AS id FROM orders) WHERE key IN ('1-URGENT', '3-MEDIUM', 'none') GROUP BY ALL")
def _(s, d):
    _, words = enums.encode(table(s, d, "orders"), "priority", "o_orderpriority", enums.empty(s))
    return values(s, sorted(enums.lookup(words, "priority", ["1-URGENT", "3-MEDIUM", "none"]).items()), "key string, id bigint")


@query("q_issues", "SELECT 'user_id' AS \"column\", 'u' || user_id AS value, 'can''t be read' AS message FROM events WHERE user_id % 50 = 1 UNION ALL SELECT 'at', event_type, 'str2unixtime gives nothing' FROM events WHERE event_type <> 'click'")
def _(s, d):
    rows = table(s, d, "events").select(F.when(F.col("user_id") % 50 == 1, F.concat(F.lit("u"), "user_id")).otherwise(F.col("user_id").cast("string")).alias("user_id"), F.when(F.col("event_type") == "click", "2024-01-01T00:00:00").otherwise(F.col("event_type")).alias("at"))
    spec = DatasetSpec("events", (ColumnSpec("user_id", LONG), ColumnSpec("at", LONG, transformer=Transform("str2unixtime", {"pattern": "%Y-%m-%dT%H:%M:%S"}))))
    return prepare.with_issues(rows, spec)[1]


@query("q_sanitised_text", r"SELECT doc_id, coalesce(substr(trim(regexp_replace(text, '[^\x00-\x7F]', '', 'g')), 1, 40), '') AS text FROM documents")
def _(s, d):
    return table(s, d, "documents").select("doc_id", F.coalesce(clean_text(F.col("text"), 40), F.lit("")).alias("text"))


@query("q_url_decoded", "SELECT event_id, event_type || ' é&' || user_id AS text FROM events")
def _(s, d):
    text = F.concat_ws("", "event_type", F.lit(" é&"), "user_id")
    return table(s, d, "events").select("event_id", transforms.apply("urldecode", F.url_encode(text)).alias("text"))


@query("q_url_hosts", "SELECT page_id, regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host FROM pages")
def _(s, d):
    return table(s, d, "pages").select("page_id", transforms.apply("urlhost", F.col("url")).alias("host"))


def _initials(value, size: int = 1, sep: str = "."):
    return sep.join(w[:size] for w in value.split())


@query("q_stored_transformer", "SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: w[1:2]), '.') AS short FROM part")
def _(s, d):
    """A function of the user's in Python, registered by name; its number parameter comes as text."""
    transforms.register("initials", _initials, "string")
    return table(s, d, "part").select("p_partkey", transforms.apply("initials", F.col("p_name"), size="2").alias("short"))


@query("q_sql_transformer", "SELECT p_partkey, upper(p_name) || '/' || length(p_name) AS tag FROM part")
def _(s, d):
    transforms.register_sql(s, "tagged", "concat(upper(value), '/', length(value))")
    return table(s, d, "part").select("p_partkey", transforms.apply("tagged", F.col("p_name")).alias("tag"))
