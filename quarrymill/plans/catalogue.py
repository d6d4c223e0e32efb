"""The registered report queries and their SQL. Events stand for an access log."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions import network, transforms
from quarrymill.functions.types import DType, parse
from quarrymill.operators import dictionary as enums
from quarrymill.operators import prepare
from quarrymill.operators.intervals import INTERVALS, report_range
from quarrymill.plans import engine
from quarrymill.plans.spec import ColumnSpec, DatasetSpec, ReportSpec, Transform

LONG, INT, DOUBLE, TEXT = DType(107), DType(105), DType(203), DType(301, size=255)
MONEY = "decimal(18,2)"
START, END = datetime(2024, 1, 1), datetime(2024, 1, 31)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _all_uses(name: str, dtype: DType, **kw) -> ColumnSpec:
    return ColumnSpec(name, dtype, statistical=dtype.is_number and not dtype.is_list, groupable=True, distinctable=True, **kw)


EVENTS = DatasetSpec("events", (_all_uses("user_id", LONG), _all_uses("event_type", TEXT), ColumnSpec("value", DOUBLE, statistical=True), ColumnSpec("event_id", LONG, statistical=True), _all_uses("ip", TEXT)), time_column="ts")
LINEITEM = DatasetSpec("lineitem", (_all_uses("l_linenumber", INT), _all_uses("l_returnflag", TEXT), _all_uses("l_linestatus", TEXT), ColumnSpec("l_quantity", DOUBLE, statistical=True), ColumnSpec("l_extendedprice", DOUBLE, statistical=True)), time_column="l_shipdate")
PART = DatasetSpec("part", (_all_uses("p_name", TEXT), _all_uses("p_type", TEXT), _all_uses("p_size", INT)), time_column="p_partkey")
VECTORS = DatasetSpec("embeddings", (ColumnSpec("pair", DType(1203, dimension=2), groupable=True), _all_uses("label", INT)), time_column="vec_id")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values to the cent, so that sums don't depend on their order."""
    return table(spark, sf_dir, "events").withColumn("value", F.col("value").cast(MONEY))


def stats(dataset: DatasetSpec, df: DataFrame, words: DataFrame | None = None, **kw) -> DataFrame:
    out = engine.run_statistics(df.sparkSession, ReportSpec("q", dataset.name, **kw), dataset, df, words)[0]
    # Decimal sums leave as doubles, times as text.
    cast = {n: F.col(f"`{n}`").cast("double") for n, t in out.dtypes if t.startswith("decimal")}
    cast |= {n: F.date_format(n, "yyyy-MM-dd HH:mm:ss") for n, t in out.dtypes if t.startswith("timestamp")}
    return out.withColumns(cast) if cast else out


_N = (("*", "count", "n"),)
_SUM = "CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE)"


@query("q_count_all", "SELECT count(*) AS n FROM events")
def _(s, d):
    return stats(EVENTS, events(s, d), resultset=_N)


@query("q_stats_ungrouped", f"SELECT count(*) AS n, {_SUM} AS total, CAST(min(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS low, CAST(max(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS high, round({_SUM} / count(*), 6) AS mean FROM events")
def _(s, d):
    out = stats(EVENTS, events(s, d), resultset=(("value", "count", "n"), ("value", "sum", "total"), ("value", "min", "low"), ("value", "max", "high"), ("value", "avg", "mean")))
    return out.withColumn("mean", F.round(F.col("total") / F.col("n"), 6))


@query("q_group_count_sum", f"SELECT event_type, count(*) AS n, {_SUM} AS total FROM events GROUP BY event_type")
def _(s, d):
    return stats(EVENTS, events(s, d), group_by=("event_type",), resultset=(*_N, ("value", "sum", "total")))


@query("q_group_avg", "SELECT l_returnflag, l_linestatus, sum(l_quantity) / count(*) AS mean FROM lineitem GROUP BY ALL")
def _(s, d):
    return stats(LINEITEM, table(s, d, "lineitem"), group_by=("l_returnflag", "l_linestatus"), resultset=(("l_quantity", "avg", "mean"),))


def _filter(name: str, dataset: DatasetSpec, tab: str, conditions: tuple, where: str) -> None:
    @query(name, f"SELECT count(*) AS n FROM {tab} WHERE {where}")
    def _(s, d):
        return stats(dataset, table(s, d, tab), conditions=conditions, resultset=_N)


for _name, _conds, _where in (
    ("q_eq", (("l_linenumber", "=", 3),), "l_linenumber = 3"),
    ("q_ne", (("l_linenumber", "<>", 3),), "l_linenumber <> 3"),
    ("q_cmp", (("l_quantity", ">=", 25), ("l_quantity", "<", 40)), "l_quantity >= 25 AND l_quantity < 40"),
    ("q_cmp_strict", (("l_quantity", ">", 25), ("l_quantity", "<=", 40)), "l_quantity > 25 AND l_quantity <= 40"),
    ("q_in", (("l_linenumber", "in", [1, 3]),), "l_linenumber IN (1, 3)"),
    ("q_not_in", (("l_linenumber", "not in", "[1, 3]"),), "l_linenumber NOT IN (1, 3)"),
):
    _filter(_name, LINEITEM, "lineitem", _conds, _where)
_filter("q_between_halfopen", EVENTS, "events", (("value", "between", [10, 50]),), "value >= 10 AND value < 50")

_W = ["ring", "anch"]
for _name, _op, _v, _where in (
    ("q_str_eq", "==", "red plate", "p_name = 'red plate'"),
    ("q_str_ne", "!=", "red plate", "p_name <> 'red plate'"),
    ("q_str_in", "in", ["red plate", "hot ring"], "p_name IN ('red plate', 'hot ring')"),
    ("q_contain", "contain", "ring", "contains(p_name, 'ring')"),
    ("q_not_contain", "not contain", "ring", "NOT contains(p_name, 'ring')"),
    ("q_mcontain", "mcontain", _W, "contains(p_name, 'ring') OR contains(p_name, 'anch')"),
    ("q_not_mcontain", "not mcontain", _W, "NOT (contains(p_name, 'ring') OR contains(p_name, 'anch'))"),
    ("q_startswith", "startswith", "small", "starts_with(p_name, 'small')"),
    ("q_not_startswith", "not startswith", "small", "NOT starts_with(p_name, 'small')"),
    ("q_mstartswith", "mstartswith", ["small", "red"], "starts_with(p_name, 'small') OR starts_with(p_name, 'red')"),
    ("q_not_mstartswith", "not mstartswith", ["small", "red"], "NOT (starts_with(p_name, 'small') OR starts_with(p_name, 'red'))"),
    ("q_endswith", "endswith", "late", "ends_with(p_name, 'late')"),
    ("q_not_endswith", "not endswith", "late", "NOT ends_with(p_name, 'late')"),
    ("q_mendswith", "mendswith", ["late", "ring"], "ends_with(p_name, 'late') OR ends_with(p_name, 'ring')"),
    ("q_not_mendswith", "not mendswith", ["late", "ring"], "NOT (ends_with(p_name, 'late') OR ends_with(p_name, 'ring'))"),
):
    _filter(_name, PART, "part", (("p_name", _op, _v),), _where)


def _with_ip(s, d):
    return events(s, d).withColumn("ip", F.concat(F.lit("10."), (F.col("user_id") % 256).cast("string"), F.lit(".0.1")))


@query("q_ip_range", "SELECT count(*) AS n FROM events WHERE user_id % 256 BETWEEN 16 AND 31")
def _(s, d):
    return stats(EVENTS, _with_ip(s, d), conditions=(("ip", "ip range", "10.16.0.0/12"),), resultset=_N)


@query("q_ip_ranges", "SELECT count(*) AS n FROM events WHERE user_id % 256 BETWEEN 16 AND 31 OR user_id % 256 = 5")
def _(s, d):
    return stats(EVENTS, _with_ip(s, d), conditions=(("ip", "ip ranges", ["10.16.0.0/12", "10.5.0.0/16"]),), resultset=_N)


@query("q_not_in_ip_ranges", "SELECT count(*) AS n FROM events WHERE NOT (user_id % 256 BETWEEN 16 AND 31 OR user_id % 256 = 5)")
def _(s, d):
    return stats(EVENTS, _with_ip(s, d), conditions=(("ip", "not in ip ranges", ["10.16.0.0/12", "10.5.0.0/16"]),), resultset=_N)


def _part_enum(s, d):
    """Parts with their names as dictionary ids."""
    rows, words = enums.encode(table(s, d, "part"), "name_id", "p_name", enums.empty(s))
    return rows, words, DatasetSpec("part", (_all_uses("name_id", LONG, enum="name_id"), _all_uses("p_size", INT)), time_column="p_partkey")


@query("q_enum_pattern", "SELECT count(*) AS n FROM part WHERE p_name LIKE 'small%'")
def _(s, d):
    rows, words, spec = _part_enum(s, d)
    return stats(spec, rows, words, conditions=(("name_id", "pattern", "small*"),), resultset=_N)


@query("q_unknown_enum_empty", "SELECT p_size, count(*) AS n FROM part WHERE false GROUP BY p_size")
def _(s, d):
    rows, words, spec = _part_enum(s, d)
    return stats(spec, rows, words, conditions=(("name_id", "!=", "no such name"),), group_by=("p_size",), resultset=_N)


def _pairs(s, d):
    return table(s, d, "embeddings").withColumn("pair", F.transform(F.slice("embedding", 1, 2), lambda x: F.floor(x.cast("double") * 10).cast("double")))


_A, _B = "floor(CAST(embedding[1] AS DOUBLE) * 10)", "floor(CAST(embedding[2] AS DOUBLE) * 10)"
for _name, _op, _v, _where in (
    ("q_list_eq", "==", [0, 0], f"{_A} = 0 AND {_B} = 0"),
    ("q_list_ne", "!=", [0, 0], f"NOT ({_A} = 0 AND {_B} = 0)"),
    ("q_list_in", "in", [[0, 1], [-1, -1]], f"{_A} IN (0, 1, -1) AND {_B} IN (0, 1, -1)"),
    ("q_list_not_in", "not in", [[0, 1], [-1, -1]], f"NOT ({_A} IN (0, 1, -1) AND {_B} IN (0, 1, -1))"),
    ("q_list_range", "range", [-1, 0], f"{_A} BETWEEN -1 AND 0 AND {_B} BETWEEN -1 AND 0"),
    ("q_list_not_in_range", "not in range", [-1, 0], f"NOT ({_A} BETWEEN -1 AND 0 AND {_B} BETWEEN -1 AND 0)"),
    ("q_list_ranges", "ranges", [[-1, 0], [1, 2]], f"({_A} BETWEEN -1 AND 0 AND {_B} BETWEEN -1 AND 0) OR ({_A} BETWEEN 1 AND 2 AND {_B} BETWEEN 1 AND 2)"),
):
    def _make(op, v):
        return lambda s, d: stats(VECTORS, _pairs(s, d), conditions=(("pair", op, v),), resultset=_N)

    query(_name, f"SELECT count(*) AS n FROM embeddings WHERE {_where}")(_make(_op, _v))


@query("q_list_group", f"SELECT concat({_A}::BIGINT, ',', {_B}::BIGINT) AS pair, count(*) AS n FROM embeddings GROUP BY 1")
def _(s, d):
    transforms.register("pair_text", lambda c: F.array_join(F.transform(c, lambda x: x.cast("bigint").cast("string")), ","))
    spec = DatasetSpec("embeddings", (ColumnSpec("pair", DType(1203, dimension=2), groupable=True, to_string="pair_text"),), time_column="vec_id")
    return stats(spec, _pairs(s, d), group_by=("pair",), sort_by=(("pair", "asc"),), resultset=_N)


@query("q_include_exclude", "SELECT count(*) AS n FROM events WHERE NOT (event_type = 'error') AND (value > 5 OR user_id < 10)")
def _(s, d):
    spec = DatasetSpec("events", (ColumnSpec("event_type", TEXT, exclude=("event_type = 'error'",)), ColumnSpec("value", DOUBLE, include=("value > 5", "user_id < 10"))))
    return prepare.kept(table(s, d, "events"), spec).agg(F.count(F.lit(1)).alias("n"))


@query("q_having", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) > 70")
def _(s, d):
    return stats(EVENTS, events(s, d), group_by=("user_id",), having=(("n", ">", 70), ("nothing", ">", 1)), resultset=_N)


@query("q_having_avg", "SELECT l_linenumber, sum(l_quantity) / count(*) AS mean FROM lineitem GROUP BY l_linenumber HAVING sum(l_quantity) / count(*) >= 25.5")
def _(s, d):
    return stats(LINEITEM, table(s, d, "lineitem"), group_by=("l_linenumber",), having=(("mean", ">=", 25.5),), resultset=(("l_quantity", "avg", "mean"),))


_FLOORS = {
    "Minutely": "date_trunc('minute', ts)", "FiveMinutely": "time_bucket(INTERVAL '5 minutes', ts)", "TenMinutely": "time_bucket(INTERVAL '10 minutes', ts)", "HalfHourly": "time_bucket(INTERVAL '30 minutes', ts)",
    "Hourly": "date_trunc('hour', ts)", "Daily": "date_trunc('day', ts)", "MondayBasedWeekly": "date_trunc('week', ts)",
    "SaturdayBasedWeekly": "date_trunc('week', ts + INTERVAL 2 DAY) - INTERVAL 2 DAY", "SundayBasedWeekly": "date_trunc('week', ts + INTERVAL 1 DAY) - INTERVAL 1 DAY", "Monthly": "date_trunc('month', ts)",
} | {f"{n}BasedFourWeekly": f"DATE '{a}' + CAST(floor(date_diff('day', DATE '{a}', CAST(ts AS DATE)) / 28.0) AS INTEGER) * 28" for n, a in (("Monday", "2024-01-01"), ("Saturday", "2023-12-30"), ("Sunday", "2023-12-31"))}

def _four_weeks(kind) -> str:
    low, high = report_range(kind, START, END, False)
    return f" WHERE ts >= TIMESTAMP '{low}' AND ts < TIMESTAMP '{high}'" if "FourWeekly" in kind.name else ""


for _i in INTERVALS:
    def _make_bucket(name):
        def f(s, d):
            spec = DatasetSpec("events", EVENTS.columns, time_column="ts", data_interval="Minutely")
            # Four-week types count from the range's start.
            span = {"start": START, "end": END, "periodic": False} if "FourWeekly" in name else {}
            return stats(spec, events(s, d), **span, rtype=name, group_by=("event_type",), sort_by=(("event_type", "asc"),), resultset=(*_N, ("value", "sum", "total")))

        return f

    query("q_bucket_" + _i.name.lower(), f"SELECT strftime(CAST({_FLOORS[_i.name]} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS request_time, event_type, count(*) AS n, {_SUM} AS total FROM events{_four_weeks(_i)} GROUP BY 1, 2")(_make_bucket(_i.name))


@query("q_bucket_label", "SELECT strftime(ts, '%Y-%m') AS request_time, count(*) AS n FROM events GROUP BY 1")
def _(s, d):
    return stats(EVENTS, events(s, d), rtype="Monthly", options={"bucket_mode": "label"}, resultset=_N)


@query("q_bucket_ungrouped_zero_fill", f"""
SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS request_time, count(ts) AS n, coalesce({_SUM}, 0) AS total
FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR)) AS h)
LEFT JOIN events ON date_trunc('hour', ts) = h AND value >= 150 GROUP BY h""")
def _(s, d):
    return stats(EVENTS, events(s, d), start=START, end=END, rtype="Hourly", conditions=(("value", ">=", 150),), resultset=(*_N, ("value", "sum", "total")))


@query("q_bucket_group_sort", f"SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS request_time, event_type, count(*) AS n, {_SUM} AS total, round({_SUM} / count(*), 6) AS mean FROM events WHERE CAST(value AS DECIMAL(18,2)) >= 10 AND CAST(value AS DECIMAL(18,2)) < 200 GROUP BY 1, 2")
def bucket_group_sort(s, d):
    out = stats(EVENTS, events(s, d), rtype="Daily", conditions=(("value", "between", [10, 200]),), group_by=("event_type",), sort_by=(("event_type", "asc"),), resultset=(*_N, ("value", "sum", "total"), ("value", "avg", "mean")))
    return out.withColumn("mean", F.round(F.col("total") / F.col("n"), 6))


@query("q_sort_enum_label", "SELECT o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY 1")
def _(s, d):
    rows, words = enums.encode(table(s, d, "orders"), "priority", "o_orderpriority", enums.empty(s))
    spec = DatasetSpec("orders", (_all_uses("priority", LONG, enum="priority"),), time_column="o_orderdate")
    return stats(spec, rows, words, group_by=("priority",), sort_by=(("priority", "desc"),), resultset=_N)


@query("q_sort_alias", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def _(s, d):
    return stats(EVENTS, events(s, d), group_by=("user_id",), sort_by=(("n", "desc"), ("user_id", "asc"), ("unknown", "asc")), resultset=_N)


@query("q_distinct_one", "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def _(s, d):
    return stats(EVENTS, events(s, d), group_by=("event_type",), resultset=(("user_id", "distinct", "users"),))


@query("q_distinct_tuple", "SELECT count(DISTINCT (user_id, event_type)) AS pairs FROM events")
def _(s, d):
    return stats(EVENTS, events(s, d), resultset=(("user_id", "distinct", "pairs"), ("event_type", "distinct", None)))


@query("q_distinct_exclude_null", "SELECT event_type, count(DISTINCT user_id) FILTER (user_id <> 0) AS users FROM events GROUP BY event_type")
def _(s, d):
    return stats(EVENTS, events(s, d), group_by=("event_type",), resultset=(("user_id", "distinct_exclude_null", "users"),))


@query("q_distinct_with_sum", f"SELECT event_type, count(DISTINCT user_id) AS users, count(*) AS n, {_SUM} AS total FROM events GROUP BY event_type HAVING count(DISTINCT user_id) > 1")
def _(s, d):
    return stats(EVENTS, events(s, d), group_by=("event_type",), having=(("distinct", ">", 1),), sort_by=(("distinct", "desc"),), resultset=(("user_id", "distinct", "users"), *_N, ("value", "sum", "total")))


@query("q_raw_physical", f"SELECT event_type, count(*) AS \"count\", CAST(max(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value_max, {_SUM} AS value_sum FROM events GROUP BY event_type")
def _(s, d):
    df = events(s, d)
    raw = engine.run_statistics(s, ReportSpec("q", "events", group_by=("event_type",), resultset=(("value", "avg", "mean"), ("value", "max", "top"), ("value", "count", "n"))), EVENTS, df)[1]
    return raw.withColumns({c: F.col(c).cast("double") for c in ("value_max", "value_sum")})


@query("q_str2enum", "SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) AS BIGINT) AS priority FROM orders")
def _(s, d):
    return enums.encode(table(s, d, "orders"), "priority", "o_orderpriority", enums.empty(s))[0].select("o_orderkey", "priority")


@query("q_number2group", "SELECT CASE WHEN CAST(floor(value) AS BIGINT) < 10 THEN 'low' WHEN CAST(floor(value) AS BIGINT) < 100 THEN 'middle' ELSE 'high' END AS grp, count(*) AS n FROM events GROUP BY 1")
def _(s, d):
    group = transforms.apply("number2group", F.floor(F.col("value")), rules=[("low", "<", 10), ("middle", "<", 100)], otherwise="high")
    return table(s, d, "events").groupBy(group.alias("grp")).agg(F.count(F.lit(1)).alias("n"))


@query("q_str2group", "SELECT CASE WHEN regexp_matches(source, '(?i)SRC1') THEN 'ones' WHEN regexp_matches(source, '(?i)[2-5]$') THEN 'some' ELSE 'rest' END AS grp, count(*) AS n FROM documents GROUP BY 1")
def _(s, d):
    group = transforms.apply("str2group", F.col("source"), rules=[("ones", "SRC1"), ("some", "[2-5]$")], otherwise="rest")
    return table(s, d, "documents").groupBy(group.alias("grp")).agg(F.count(F.lit(1)).alias("n"))


@query("q_domain2enum", """
WITH p AS (SELECT page_id, regexp_extract(url, 'https?://([^/:?#]+)', 1) AS domain, page_id % 3 = 0 AS missing FROM pages),
ok AS (SELECT DISTINCT domain FROM p WHERE NOT missing AND regexp_matches(domain, '^[a-z0-9.-]+$'))
SELECT page_id, CAST(coalesce(id, 0) AS BIGINT) AS domain_id FROM p LEFT JOIN (SELECT domain, row_number() OVER (ORDER BY domain) AS id FROM ok) USING (domain)""")
def _(s, d):
    rows = table(s, d, "pages").select("page_id", F.regexp_extract("url", "https?://([^/:?#]+)", 1).alias("domain"))
    return enums.domain2enum(rows, "domain_id", "domain", F.col("page_id") % 3 == 0, r"^[a-z0-9.-]+$", enums.empty(s))[0].select("page_id", "domain_id")


@query("q_resourcekey", "SELECT page_id, coalesce(nullif(regexp_extract(url, '^https?://[^/]+/+([^/?#]+)', 1), ''), 'none') AS resource FROM pages")
def _(s, d):
    rows = table(s, d, "pages").select("page_id", F.lit("any").alias("domain"), F.regexp_extract("url", r"^https?://[^/]+(/[^?#]*)?", 1).alias("path"))
    key = transforms.apply("resourcekey", F.col("domain"), {"path": F.col("path")}, configs={"any": ("path", 0)}, default="none")
    return rows.select("page_id", key.alias("resource"))


@query("q_unixtime_trunc", "SELECT event_id, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS at FROM events")
def _(s, d):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+0000"))
    return table(s, d, "events").select("event_id", transforms.apply("str2unixtime", text, pattern="%Y-%m-%dT%H:%M:%S%z", truncate_to="hour").alias("at"))


@query("q_ip2country_range_join", """
SELECT CASE WHEN user_id % 256 BETWEEN 0 AND 15 THEN 'Here' WHEN user_id % 256 BETWEEN 16 AND 99 THEN 'There' ELSE 'Internal' END AS country, count(*) AS n FROM events GROUP BY 1""")
def _(s, d):
    ranges = s.createDataFrame([(10 << 24, (10 << 24) + (16 << 16) - 1, "here"), ((10 << 24) + (16 << 16), (10 << 24) + (100 << 16) - 1, "there")], "start_ip bigint, end_ip bigint, country string")
    found = enums.locate(_with_ip(s, d), F.col("ip"), ranges, ["country"])
    return found.groupBy(enums.country_label(F.col("ip"), F.col("country")).alias("country")).agg(F.count(F.lit(1)).alias("n"))


@query("q_user_lookup_fallback", "SELECT o_orderkey, coalesce(c_name, CAST(o_custkey AS VARCHAR)) AS who FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_nationkey < 12) ON o_custkey = c_custkey")
def _(s, d):
    known = table(s, d, "customer").where("c_nationkey < 12")
    return enums.first_known(table(s, d, "orders"), "o_custkey", [(known.where("c_nationkey < 5"), "c_custkey", "c_name"), (known, "c_custkey", "c_name")], "who").select("o_orderkey", "who")


@query("q_enum_decode_join", "SELECT c_custkey, coalesce(n_name, CAST(c_nationkey AS VARCHAR)) AS nation FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON c_nationkey = n_nationkey")
def _(s, d):
    words = table(s, d, "nation").where("n_nationkey < 20").select(F.lit("nation").alias("column"), F.col("n_name").alias("key"), F.col("n_nationkey").cast("bigint").alias("id"), F.lit(None).cast("string").alias("info"))
    return enums.decode(table(s, d, "customer").select("c_custkey", F.col("c_nationkey").alias("nation")), "nation", words)


@query("q_json_flatten", "SELECT event_id, CAST(props->>'k' AS VARCHAR) AS k FROM events")
def _(s, d):
    from quarrymill.sources.audit import flat

    record = F.to_json(F.struct(F.array(F.struct(F.lit("k").alias("key"), F.get_json_object("props", "$.k").alias("value"))).alias("additionalDetails")))
    return table(s, d, "events").select("event_id", F.try_element_at(flat(record), F.lit("additionalDetails.k")).alias("k"))


@query("q_computed_override", "SELECT event_id, upper(event_type) AS event_type, upper(event_type) || '/' || user_id AS tag FROM events")
def _(s, d):
    transforms.register("upper_text", lambda c: F.upper(c))
    transforms.register("tag_of", lambda c, record=None: F.concat(F.upper(c), F.lit("/"), record["user_id"].cast("string")))
    spec = DatasetSpec("events", (
        ColumnSpec("event_id", LONG),
        ColumnSpec("tag", TEXT, source="event_type", transformer=Transform("tag_of"), computed="new"),
        ColumnSpec("event_type", TEXT, transformer=Transform("upper_text"), computed="override"),
    ))
    return prepare.prepare(table(s, d, "events"), spec)


@query("q_normalize", "SELECT trim(lower(source)) AS source, count(*) AS n FROM documents GROUP BY 1")
def _(s, d):
    spec = DatasetSpec("documents", (ColumnSpec("source", TEXT, normalize="lower(source)"),))
    return prepare.prepare(table(s, d, "documents"), spec).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query("q_parse_defaults", "SELECT event_id, coalesce(TRY_CAST(CASE WHEN user_id % 5 = 0 THEN 'x' WHEN user_id % 5 = 1 THEN '' ELSE CAST(user_id AS VARCHAR) END AS BIGINT), 0) AS v FROM events")
def _(s, d):
    dirty = F.when(F.col("user_id") % 5 == 0, "x").when(F.col("user_id") % 5 == 1, "").otherwise(F.col("user_id").cast("string"))
    return table(s, d, "events").select("event_id", parse(dirty, LONG).alias("v"))


_DETAILS = "SELECT event_id, user_id, event_type FROM events WHERE value >= 50 AND value < 60"


@query("q_details", _DETAILS)
def _(s, d):
    out = engine.run_details(s, ReportSpec("q", "events", conditions=(("value", "between", [50, 60]),)), EVENTS, table(s, d, "events"), order=("ts", "event_id"))
    return out.select("event_id", "user_id", "event_type")


@query("q_details_raw_conditions", _DETAILS + " AND event_type LIKE 'c%'")
def _(s, d):
    spec = ReportSpec("q", "events", conditions=(("value", "between", [50, 60]),), raw_conditions=(("event_type", "startswith", "c"),), resultset=(("__all__", None, None),))
    return engine.run_details(s, spec, EVENTS, table(s, d, "events")).select("event_id", "user_id", "event_type")
