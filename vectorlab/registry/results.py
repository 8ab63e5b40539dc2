"""Result files, flat tables, best runs, prices, leaderboards, names and formats.

The orders table stands in for an archive of result files: every order is one result document
with two case results, built by expressions only.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import text as X
from ..operators import analytics as A
from ..operators import filters as FL
from ..plans import cases as CS
from ..session import scratch_path
from ..sources import corpus as SRC
from ..sources import results as RS
from ..sources.versioned import VersionedTable
from .base import query, r6, table

# expressions that read the same in both dialects
STATUS = "CASE WHEN o_orderkey % 7 = 0 THEN 'x' WHEN o_orderkey % 11 = 0 THEN '?' ELSE ':)' END"
VERSION = "CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE concat('v', o_orderkey % 3) END"
CASE_ID = ("CASE o_custkey % 14 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 WHEN 4 THEN 5 WHEN 5 THEN 6 WHEN 6 THEN 7 "
           "WHEN 7 THEN 8 WHEN 8 THEN 9 WHEN 9 THEN 10 WHEN 10 THEN 12 WHEN 11 THEN 14 WHEN 12 THEN 16 ELSE 200 END")
LABEL = "concat('standard', CASE WHEN o_custkey % 2 = 0 THEN '_2025' ELSE '' END)"
OLD = "o_orderstatus = 'F'"


def orders(spark, sf):
    return table(spark, sf, "orders")


def _fill(fields, given):
    """A struct of the given expressions; fields without one are null."""
    return F.struct(*[(F.expr(given[f.name]) if isinstance(given.get(f.name), str) else given.get(f.name, F.lit(None)))
                      .cast(f.dataType).alias(f.name) for f in fields])


def _result(spec, scale: float):
    newer = {
        "conc_num_list": "array(1, 5, 10)", "conc_qps_list": "array(o_totalprice / 4, o_totalprice / 2)",
        "conc_latency_p99_list": "array(0.5D, 0.25D, 0.125D)", "insert_duration": "1.5D",
        "load_duration": "o_orderkey % 50", "serial_latency_p95": "(o_custkey % 900) / 1000",
        "st_ideal_insert_duration": "200", "st_search_stage_list": "array(50, 90, 100, 110)",
        "st_search_time_list": "array(1.5D, 2.5D, 3.5D, 4.5D)",
        "st_max_qps_list_list": "array(o_totalprice / 8, o_totalprice / 7, o_totalprice / 6, o_totalprice / 5)",
        "st_recall_list": "array(0.4D, 0.8D, 0.9D, 0.95D)", "st_ndcg_list": "array(0.45D, 0.85D, 0.9D, 0.9D)",
        "st_serial_latency_p99_list": "array(0.0125D, 0.02D, 0.03D, 0.01D)"}
    given = {"max_load_count": "o_orderkey * 10", "qps": f"o_totalprice * {scale}D", "recall": "(o_orderkey % 100) / 100",
             "serial_latency_p99": "(o_custkey % 1000) / 1000", "load_dur": f"CASE WHEN {OLD} THEN o_orderkey % 50 END",
             **{k: f"CASE WHEN NOT ({OLD}) THEN {v} END" for k, v in newer.items()}}
    task = spec["task_config"].dataType
    config = _fill(task["db_config"].dataType, {"db_label": "o_orderstatus", "version": VERSION, "note": "'n'"})
    case = _fill(task["case_config"].dataType, {"case_id": CASE_ID, "k": "100", "custom_case": "map('insert_rate', '500')"})
    return _fill(spec, {
        "label": STATUS, "metrics": _fill(spec["metrics"].dataType, given),
        "task_config": _fill(task, {"db": "o_orderpriority", "db_config": config, "case_config": case,
                                    "db_case_config": "map('index', 'FLAT', 'nlist', cast(null as string))"})})


def parsed(spark, sf):
    """One result document per order as the reader returns it, under a path of its own."""
    schema = RS.schema()
    spec = schema["results"].dataType.elementType
    path = ("concat('results/', o_orderpriority, '/result_', date_format(o_orderdate, 'yyyyMMdd'), '_', "
            "lpad(cast(o_orderkey as string), 12, '0'), CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE concat('_', lower(o_orderpriority)) END, '.json')")
    return orders(spark, sf).select(
        F.expr("concat('r', o_custkey)").alias("run_id"),
        F.expr(f"CASE WHEN o_custkey % 5 <> 0 THEN {LABEL} END").alias("task_label"),
        F.expr("cast(unix_seconds(cast(o_orderdate as timestamp)) as double)").alias("timestamp"),
        F.array(_result(spec, 1), _result(spec, 0.5)).alias("results"), F.expr(path).alias("path"), "o_orderkey")


def documents(spark, sf):
    """The same documents as JSON text; null fields are left out."""
    d = parsed(spark, sf)
    return d.select(F.to_json(F.struct("run_id", "task_label", "timestamp", "results")).alias("value"), "path", "o_orderkey")


# the two results of every order in SQL
R_SQL = f"""o AS (SELECT *, concat('r', o_custkey) AS run_id, {STATUS} AS status, {VERSION} AS version, {CASE_ID} AS case_id,
{OLD} AS old_style, CASE WHEN o_custkey % 5 = 0 THEN concat('r', o_custkey) ELSE {LABEL} END AS task_label,
concat('results/', o_orderpriority, '/result_', strftime(o_orderdate, '%Y%m%d'), '_', lpad(o_orderkey::VARCHAR, 12, '0'),
CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE concat('_', lower(o_orderpriority)) END, '.json') AS path FROM orders),
r AS (SELECT o.*, position, o_totalprice * CASE position WHEN 0 THEN 1.0 ELSE 0.5 END::DOUBLE AS qps FROM o, (SELECT unnest([0, 1])::BIGINT AS position))"""
NAME_SQL = "concat_ws('-', o_orderpriority, o_orderstatus, nullif(version, ''))"

_FLAT_COLUMNS = ["run_id", "task_label", "db", "db_label", "version", "db_name", "status"]
_FLAT_SQL = f"""WITH {R_SQL} SELECT run_id, task_label, o_orderpriority AS db, o_orderstatus AS db_label, version, {NAME_SQL} AS db_name, status,
position, case_id::BIGINT AS case_id, round(qps, 6) AS qps, round((o_orderkey % 100) / 100, 6) AS recall, round(o_orderkey % 50, 6)::DOUBLE AS load_duration,
round((o_custkey % 1000) / 1000, 6) AS p99, CASE WHEN old_style THEN 0 ELSE round((o_custkey % 900) / 1000, 6) END::DOUBLE AS p95, 1::BIGINT AS options FROM r"""


def _flat(df):
    return df.select(*_FLAT_COLUMNS, F.col("position").cast("bigint").alias("position"), F.col("case_id").cast("bigint").alias("case_id"),
                     r6("qps", "qps"), r6("recall", "recall"), r6("load_duration", "load_duration"),
                     r6("serial_latency_p99", "p99"), r6("serial_latency_p95", "p95"),
                     F.size("index_options").cast("bigint").alias("options"))


# --- reading and writing result files -------------------------------------------------------------


@query("s12_read_result_files", _FLAT_SQL)
def read_result_files(spark, sf):
    root = scratch_path(spark, "archive")
    documents(spark, sf).select("value").write.options(**RS.COMPRESSED).text(root)
    good, _ = RS.read_result_files(spark, root, one_per_file=False, pattern="*.txt.gz")
    return _flat(RS.flat_cases(good))


@query("s13_skip_unreadable", """SELECT count(*) FILTER (o_orderstatus <> 'P') AS good, count(*) FILTER (o_orderstatus = 'P') AS bad FROM orders""")
def skip_unreadable(spark, sf):
    """Documents of one status are cut in half before they are written."""
    d = documents(spark, sf).join(orders(spark, sf).select("o_orderkey", "o_orderstatus"), "o_orderkey")
    broken = F.substring("value", 1, 40)
    root = scratch_path(spark, "archive")
    d.select(F.when(F.col("o_orderstatus") == "P", broken).otherwise(F.col("value")).alias("value")).write.text(root)
    good, bad = RS.read_result_files(spark, root, one_per_file=False, pattern="*.txt")
    both = good.select(F.lit(1).alias("g"), F.lit(0).alias("b")).unionByName(bad.select(F.lit(0).alias("g"), F.lit(1).alias("b")))
    return both.agg(F.sum("g").cast("bigint").alias("good"), F.sum("b").cast("bigint").alias("bad"))


@query("s14_write_results", f"""WITH {R_SQL} SELECT o_orderpriority AS db, count(*) AS n, round(sum(qps), 3) AS qps FROM r GROUP BY 1""")
def write_results(spark, sf):
    rows = RS.case_rows(parsed(spark, sf)).withColumn("db", F.col("r.task_config.db"))
    root = scratch_path(spark, "results")
    RS.write_results(rows.select("run_id", "task_label", "timestamp", "db", "r"), root)
    back = spark.read.schema("run_id string, db string, r struct<metrics: struct<qps: double>>").json(root)
    return back.groupBy("db").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("r.metrics.qps"), 3).alias("qps"))


@query("s15_remove_secrets", "SELECT count(*) AS results, 0::BIGINT AS with_secret, count(*) AS with_label FROM orders")
def remove_secrets(spark, sf):
    o = orders(spark, sf)
    config = F.struct(F.col("o_orderstatus").alias("db_label"), F.lit("p").alias("password"), F.lit("k").alias("api_key"))
    r = F.struct(F.struct(F.col("o_orderpriority").alias("db"), config.alias("db_config")).alias("task_config"))
    rows = o.select(F.col("o_orderpriority").alias("db"), r.alias("r"))
    root = scratch_path(spark, "results")
    RS.write_results(rows, root)
    text = spark.read.text(root)
    return text.agg(F.count(F.lit(1)).alias("results"),
                    F.count_if(F.contains("value", F.lit("password")) | F.contains("value", F.lit("api_key"))).alias("with_secret"),
                    F.count_if(F.contains("value", F.lit("db_label"))).alias("with_label"))


_CONC_SQL = f"""{R_SQL}, lv AS (SELECT r.*, u.* FROM r, (VALUES (1, 4.0::DOUBLE, 0.5::DOUBLE), (5, 2.0, 0.25), (10, NULL, 0.125)) u(conc, part, lat) WHERE NOT old_style),
flat AS (SELECT path, o_orderkey, position, conc::BIGINT AS concurrency, o_totalprice / part AS qps, lat AS latency_p99, NULL::DOUBLE AS recall FROM lv
UNION ALL SELECT path, o_orderkey, position, NULL, qps, nullif((o_custkey % 1000) / 1000, 0), (o_orderkey % 100) / 100 FROM r WHERE old_style)"""


@query("r1_rows_per_concurrency", f"""WITH {_CONC_SQL} SELECT split_part(replace(split_part(path, '/', 3), '.json', ''), '_', 2) AS task_label,
CASE WHEN o_orderkey % 4 = 0 THEN split_part(path, '/', 2) WHEN true THEN concat(lpad(o_orderkey::VARCHAR, 12, '0'), '_', split_part(replace(split_part(path, '/', 3), '.json', ''), '_', 4)) END AS db0,
concurrency, round(qps, 6) AS qps, round(latency_p99, 6) AS latency_p99, round(recall, 6) AS recall FROM flat""".replace(
    "CASE WHEN o_orderkey % 4 = 0 THEN split_part(path, '/', 2) WHEN true THEN", "CASE WHEN o_orderkey % 4 = 0 THEN lpad(o_orderkey::VARCHAR, 12, '0') ELSE").replace("db0", "db"))
def rows_per_concurrency(spark, sf):
    rows = RS.per_concurrency_rows(parsed(spark, sf))
    return rows.select("task_label", "db", F.col("concurrency").cast("bigint").alias("concurrency"),
                       r6("qps", "qps"), r6("latency_p99", "latency_p99"), r6("recall", "recall"))


@query("s16_flat_csv", f"""WITH {_CONC_SQL} SELECT concurrency, count(*) AS n, round(sum(qps), 3) AS qps, round(sum(latency_p99), 3) AS latency FROM flat GROUP BY 1""")
def flat_csv(spark, sf):
    path = scratch_path(spark, "csv")
    rows = RS.per_concurrency_rows(parsed(spark, sf))
    RS.write_csv(rows, path)
    back = RS.read_csv(spark, path, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema))
    return back.groupBy(F.col("concurrency").cast("bigint").alias("concurrency")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("qps"), 3).alias("qps"), F.round(F.sum("latency_p99"), 3).alias("latency"))


_PRICE_SQL = "pr AS (SELECT o_orderpriority AS db, o_orderstatus AS db_label, round(avg(o_totalprice) / 10000, 4) AS price FROM orders WHERE o_orderpriority <> '3-MEDIUM' GROUP BY 1, 2)"


def prices(spark, sf):
    """Hourly prices derived from the orders; one backend has none."""
    o = orders(spark, sf).filter(F.col("o_orderpriority") != "3-MEDIUM")
    return o.groupBy(F.col("o_orderpriority").alias("db"), F.col("o_orderstatus").alias("db_label")).agg(
        F.round(F.avg("o_totalprice") / 10000, 4).alias("price"))


@query("s18_read_prices", f"WITH {_PRICE_SQL} SELECT db, db_label, price FROM pr")
def read_prices(spark, sf):
    """Prices written as one nested JSON object (a map of maps over a dozen pairs) and read back."""
    by_db = prices(spark, sf).groupBy("db").agg(F.map_from_entries(F.collect_list(F.struct("db_label", "price"))).alias("m"))
    nested = by_db.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("db", "m")))).alias("value"))
    path = scratch_path(spark, "prices")
    nested.write.text(path)
    return RS.read_prices(spark, path)


# --- flattening -------------------------------------------------------------------------------------


@query("r5_flatten_results", _FLAT_SQL)
def flatten_results(spark, sf):
    return _flat(RS.flat_cases(parsed(spark, sf)))


@query("r6_old_field_names", f"""WITH {R_SQL} SELECT old_style, count(*) AS n, sum(o_orderkey % 50)::BIGINT AS load,
round(sum(CASE WHEN old_style THEN 0 ELSE (o_custkey % 900) / 1000 END), 3)::DOUBLE AS p95, count(*) FILTER (task_label = run_id) AS unlabelled FROM r GROUP BY 1""")
def old_field_names(spark, sf):
    f = RS.flat_cases(parsed(spark, sf))
    return f.groupBy((F.col("db_label") == "F").alias("old_style")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("load_duration").cast("bigint").alias("load"),
        F.round(F.sum("serial_latency_p95"), 3).alias("p95"), F.count_if(F.col("task_label") == F.col("run_id")).alias("unlabelled"))


@query("r2_concurrency_chart", f"""WITH {R_SQL} SELECT {NAME_SQL} AS db_name, o_orderpriority AS db, conc::BIGINT AS conc_num,
round(coalesce(o_totalprice / part, 0), 6) AS qps, round(lat * 1000, 6) AS latency_p99, 0::DOUBLE AS latency_p95, 0::DOUBLE AS latency_avg
FROM r, (VALUES (1, 4.0::DOUBLE, 0.5::DOUBLE), (5, 2.0, 0.25), (10, NULL, 0.125)) u(conc, part, lat) WHERE NOT old_style""")
def concurrency_chart(spark, sf):
    c = A.concurrency_chart(A.with_list(RS.flat_cases(parsed(spark, sf)), "conc_num_list"))
    return c.select("db_name", "db", F.col("conc_num").cast("bigint").alias("conc_num"),
                    *[r6(x, x) for x in ("qps", "latency_p99", "latency_p95", "latency_avg")])


_STAGE_SQL = """(VALUES (50, 1.5::DOUBLE, 8, 0.4::DOUBLE, 0.45::DOUBLE, 0.0125::DOUBLE), (90, 2.5, 7, 0.8, 0.85, 0.02), (100, 3.5, 6, 0.9, 0.9, 0.03),
(110, 4.5, 5, 0.95, 0.9, 0.01)) u(stage, at_s, part, rec, nd, lat)"""


@query("r3_stage_rows", f"""WITH {R_SQL} SELECT {NAME_SQL} AS db_name, stage::BIGINT AS search_stage, at_s AS search_time, round(o_totalprice / part, 6) AS qps,
round_even(rec / least(stage, 100) * 100, 4) AS adjusted_recall, round_even(nd / least(stage, 100) * 100, 4) AS adjusted_ndcg,
round_even(lat * 1000, 2) AS latency_p99, 0::DOUBLE AS latency_p95, stage > 100 AS optimized FROM r, {_STAGE_SQL} WHERE NOT old_style""")
def stage_rows(spark, sf):
    s = A.stage_chart(RS.flat_cases(parsed(spark, sf)))
    return s.select("db_name", F.col("search_stage").cast("bigint").alias("search_stage"), "search_time", r6("qps", "qps"),
                    "adjusted_recall", "adjusted_ndcg", "latency_p99", "latency_p95", "optimized")


@query("r4_value_at_stage", f"""WITH {R_SQL} SELECT run_id, position, round(CASE WHEN NOT old_style THEN o_totalprice / 7 END, 6) AS qps_90, NOT old_style AS has_stage, o_orderkey::BIGINT * 10 AS load_count FROM r""")
def value_at_stage(spark, sf):
    f = RS.flat_cases(parsed(spark, sf))
    stages = F.col("st_search_stage_list")
    return f.select("run_id", F.col("position").cast("bigint").alias("position"),
                    r6(A.at_stage(F.col("st_max_qps_list_list"), stages, 90), "qps_90"),
                    F.coalesce(F.array_contains(stages, 90), F.lit(False)).alias("has_stage"),
                    F.col("max_load_count").cast("bigint").alias("load_count"))


@query("r7_json_lists", """SELECT event_id, (json_extract(props, '$.k')::BIGINT * 2)::DOUBLE AS total, 2::BIGINT AS n FROM events""")
def json_lists(spark, sf):
    """List parameters given as JSON text, built from the props of each event."""
    e = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k"))
    text = F.concat(F.lit("["), F.col("k"), F.lit(", "), F.col("k"), F.lit("]"))
    lst = X.number_list(text)
    return e.select("event_id", F.aggregate(lst, F.lit(0.0).cast("double"), lambda a, x: a + x).alias("total"), F.size(lst).cast("bigint").alias("n"))


@query("r8_clean_lists", """SELECT p_partkey, len(l)::BIGINT AS n, array_to_string(l, '|') AS items FROM
(SELECT p_partkey, [trim(x) for x in string_split(concat(' ', p_name, ' , ,', p_brand, ', ', p_type, ',,'), ',') if trim(x) <> ''] AS l FROM part)""")
def clean_lists(spark, sf):
    p = table(spark, sf, "part")
    text = F.concat(F.lit(" "), "p_name", F.lit(" , ,"), "p_brand", F.lit(", "), "p_type", F.lit(",,"))
    items = X.clean_list(text)
    return p.select("p_partkey", F.size(items).cast("bigint").alias("n"), F.array_join(items, "|").alias("items"))


@query("r9_options_without_nulls", f"""SELECT o_orderkey, (2 + CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 1 END)::BIGINT AS n FROM orders""")
def options_without_nulls(spark, sf):
    m = F.create_map(F.lit("index"), F.lit("FLAT"), F.lit("m"), F.lit("8"), F.lit("version"),
                     X.non_empty(F.expr(VERSION)), F.lit("ef"), F.lit(None).cast("string"))
    return orders(spark, sf).select("o_orderkey", F.size(X.without_nulls(m)).cast("bigint").alias("n"))


_RATES = ", ".join(str(r) for r in CS.ID_RATES)
_SHARES = ", ".join(str(r) for r in CS.LABEL_SHARES)


def _rate_text(p: str, upper: str) -> str:
    return f"CASE WHEN {p} >= 1 AND {p} <= {upper} THEN trunc({p})::BIGINT::VARCHAR ELSE printf('%.1f', {p}) END"


@query("r10_filter_cases", f"""WITH i AS (SELECT p_partkey, p_name, unnest([{_RATES}])::DOUBLE AS rate FROM part), l AS (SELECT p_partkey, p_name, unnest([{_SHARES}])::DOUBLE AS rate FROM part)
SELECT p_partkey, rate, concat('int_', {_rate_text('rate * 100', '99')}, 'p') AS filter, concat('Int-Filter-', printf('%.1f', rate * 100), '% - ', p_name) AS case_name FROM i
UNION ALL SELECT p_partkey, rate, concat('label_', {_rate_text('rate * 100', '1e9')}, 'p'), concat('Label-Filter-', printf('%.1f', rate * 100), '% - ', p_name) FROM l""")
def filter_cases(spark, sf):
    return CS.filter_cases(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name").select("p_partkey", "rate", "filter", "case_name")


# --- runs: merge, failures, ranges --------------------------------------------------------------------

_MERGED = f"""b AS (SELECT o_orderpriority AS db_name, concat('case-', o_orderstatus) AS case_name, o_totalprice AS qps, o_orderkey AS seq, {STATUS} AS status FROM orders),
mg AS (SELECT db_name, case_name, arg_max(qps, (qps, seq)) AS qps, arg_max(seq, (qps, seq)) AS seq,
CASE WHEN bool_or(status = ':)') THEN ':)' ELSE arg_max(status, seq) END AS status FROM b GROUP BY 1, 2)"""


def run_rows(spark, sf):
    return orders(spark, sf).select(
        F.col("o_orderpriority").alias("db_name"), F.concat(F.lit("case-"), "o_orderstatus").alias("case_name"),
        F.col("o_totalprice").alias("qps"), F.col("o_orderkey").alias("seq"), F.expr(STATUS).alias("status"))


@query("a13_runs_of_files", f"""WITH {R_SQL}, f AS (SELECT run_id, arg_min(task_label, path) AS task_label, count(*) AS files FROM o GROUP BY 1)
SELECT run_id, f.task_label, files, 2 * files AS results, round((SELECT sum(qps) FROM r WHERE r.run_id = f.run_id), 3) AS qps FROM f""")
def runs_of_files(spark, sf):
    d = parsed(spark, sf)
    per_run = RS.case_rows(d).groupBy("run_id").agg(F.count(F.lit(1)).alias("results"), F.round(F.sum("r.metrics.qps"), 3).alias("qps"))
    return RS.run_headers(d).join(per_run, "run_id").select("run_id", "task_label", "files", "results", "qps")


@query("a14_results_per_backend", f"WITH {R_SQL} SELECT o_orderpriority AS db, count(*) AS results, count(DISTINCT run_id) AS runs FROM r GROUP BY 1")
def results_per_backend(spark, sf):
    f = RS.flat_cases(parsed(spark, sf))
    per_run = f.groupBy("db", "run_id").agg(F.count(F.lit(1)).alias("n"))
    return per_run.groupBy("db").agg(F.sum("n").alias("results"), F.count(F.lit(1)).alias("runs"))


@query("a15_best_run", f"WITH {_MERGED} SELECT db_name, case_name, round(qps, 6) AS qps, seq FROM mg")
def best_run(spark, sf):
    return A.merge_runs(run_rows(spark, sf), ["db_name", "case_name"]).select("db_name", "case_name", r6("qps", "qps"), "seq")


# 200 backends; a third of them never have a normal run
BACKEND = "concat(o_orderpriority, '-', o_custkey % 40)"
RUN_STATUS = "CASE WHEN o_custkey % 40 % 3 <> 0 AND o_orderkey % 4 = 0 THEN ':)' WHEN o_orderkey % 2 = 0 THEN 'x' ELSE '?' END"
_BY_BACKEND = f"""b AS (SELECT {BACKEND} AS db_name, o_orderstatus AS case_name, o_totalprice AS qps, o_orderkey AS seq, {RUN_STATUS} AS status FROM orders),
mg AS (SELECT db_name, case_name, CASE WHEN bool_or(status = ':)') THEN ':)' ELSE arg_max(status, seq) END AS status FROM b GROUP BY 1, 2)"""


def _by_backend(spark, sf):
    return orders(spark, sf).select(
        F.expr(BACKEND).alias("db_name"), F.col("o_orderstatus").alias("case_name"), F.col("o_totalprice").alias("qps"),
        F.col("o_orderkey").alias("seq"), F.expr(RUN_STATUS).alias("status"))


@query("a16_best_status", f"WITH {_BY_BACKEND} SELECT db_name, case_name, status FROM mg")
def best_status(spark, sf):
    return A.merge_runs(_by_backend(spark, sf), ["db_name", "case_name"]).select("db_name", "case_name", "status")


def _better(lower: bool):
    def run(spark, sf):
        li = table(spark, sf, "lineitem")
        a, b = F.col("l_discount"), F.col("l_tax")
        return li.select("l_orderkey", "l_linenumber", r6(N.better_of(a, b, lower), "best"))

    return run


def _better_sql(fn: str) -> str:
    return f"SELECT l_orderkey, l_linenumber, round(CASE WHEN l_discount < 1e-7 THEN l_tax WHEN l_tax < 1e-7 THEN l_discount ELSE {fn}(l_discount, l_tax) END, 6) AS best FROM lineitem"


query("a17_better_of_two_lower", _better_sql("least"))(_better(True))
query("a17_better_of_two_higher", _better_sql("greatest"))(_better(False))


@query("a18_failed_backends", f"WITH {_BY_BACKEND} SELECT case_name, status, db_name FROM mg WHERE status <> ':)'")
def failed_backends(spark, sf):
    return A.failed_backends(A.merge_runs(_by_backend(spark, sf), ["db_name", "case_name"]))


@query("a19_distinct_lists", "SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders")
def distinct_lists(spark, sf):
    return A.distinct_values(orders(spark, sf), "o_orderpriority", "o_orderstatus")


@query("a20_padded_range", """WITH x AS (SELECT o_orderpriority AS db, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders GROUP BY 1)
SELECT db, round(lo - (hi - lo) * 0.2, 6) AS range_from, round(hi + (hi - lo) * 0.1, 6) AS range_to FROM x""")
def padded_range(spark, sf):
    p = A.padded_range(orders(spark, sf).withColumnRenamed("o_orderpriority", "db"), ["db"], "o_totalprice", 0.2, 0.1)
    return p.select("db", r6("range_from", "range_from"), r6("range_to", "range_to"))


@query("a21_metric_names", """SELECT o_orderpriority AS db, concat_ws(',', CASE WHEN bool_or(o_orderstatus <> 'F') THEN 'load' END, CASE WHEN bool_or(o_orderstatus = 'P') THEN 'ndcg' END, 'qps',
CASE WHEN bool_or(o_orderstatus = 'F') THEN 'recall' END) AS metrics FROM orders GROUP BY 1""")
def metric_names(spark, sf):
    m = F.expr("CASE o_orderstatus WHEN 'F' THEN map('qps', 1, 'recall', 1) WHEN 'P' THEN map('qps', 1, 'load', 1, 'ndcg', 1) ELSE map('qps', 1, 'load', 1) END")
    rows = orders(spark, sf).select(F.col("o_orderpriority").alias("db"), m.alias("metrics"))
    return A.metric_names(rows, ["db"]).select("db", F.array_join("metrics", ",").alias("metrics"))


# --- filters, joins and orders over results --------------------------------------------------------------


@query("f10_selected_cases", f"WITH {_MERGED} SELECT db_name, case_name, seq FROM b WHERE db_name IN ('1-URGENT', '5-LOW') AND case_name IN ('case-F', 'case-O')")
def selected_cases(spark, sf):
    kept = A.keep_selected(run_rows(spark, sf), ["1-URGENT", "5-LOW"], ["case-F", "case-O"])
    return kept.select("db_name", "case_name", "seq")


@query("f11_non_empty_lists", f"WITH {R_SQL} SELECT run_id, position, {NAME_SQL} AS db_name FROM r WHERE NOT old_style")
def non_empty_lists(spark, sf):
    f = A.with_list(RS.flat_cases(parsed(spark, sf)), "st_search_stage_list")
    return f.select("run_id", F.col("position").cast("bigint").alias("position"), "db_name")


@query("f12_above_noise", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE coalesce(l_discount, 0) > 1e-7")
def above_noise(spark, sf):
    return table(spark, sf, "lineitem").filter(N.above_noise(F.col("l_discount"))).select("l_orderkey", "l_linenumber")


_DAY = "1998-01-01"
_BOARD = f"""{R_SQL}, {_PRICE_SQL}, hd AS (SELECT run_id, arg_min(task_label, path) AS run_label, arg_min(epoch(o_orderdate), path) AS run_ts FROM o GROUP BY 1),
lb AS (SELECT o_orderpriority AS db, o_orderstatus AS db_label, {NAME_SQL} AS db_name, concat('case-', case_id) AS case_name, qps, (o_custkey % 1000) / 1000 AS latency,
(o_orderkey % 100) / 100 AS recall, CASE status WHEN ':)' THEN 1 WHEN 'x' THEN -1 ELSE -2 END::BIGINT AS label, version,
strftime(greatest(to_timestamp(run_ts) AT TIME ZONE 'UTC', TIMESTAMP '1997-08-01'), '%Y-%m') AS test_time, case_id, r.run_id
FROM r JOIN hd USING (run_id) WHERE contains(run_label, 'standard') AND case_id NOT IN (1, 2)
AND (o_orderpriority <> '5-LOW' OR to_timestamp(run_ts) AT TIME ZONE 'UTC' >= TIMESTAMP '{_DAY}'))"""


def _flat_named(spark, sf):
    f = RS.flat_cases(parsed(spark, sf))
    return f.withColumn("case_name", F.concat(F.lit("case-"), F.col("case_id").cast("string")))


@query("f13_leaderboard_predicate", f"WITH {_BOARD} SELECT db, case_name, count(*) AS n FROM lb GROUP BY 1, 2")
def leaderboard_predicate(spark, sf):
    b = A.leaderboard(_flat_named(spark, sf), prices(spark, sf), list(CS.CAPACITY_CASES), {"5-LOW": _DAY})
    return b.groupBy("db", "case_name").agg(F.count(F.lit(1)).alias("n"))


@query("e6_leaderboard", f"""WITH {_BOARD} SELECT lb.db, lb.db_label, db_name, case_name, round(qps, 6) AS qps, round(latency, 6) AS latency, round(recall, 6) AS recall, label, version,
round(CASE WHEN coalesce(price, 0) > 0 THEN qps / price * 3600 ELSE 0 END, 2) AS qpd FROM lb LEFT JOIN pr ON pr.db = lb.db AND pr.db_label = lb.db_label""")
def leaderboard(spark, sf):
    b = A.leaderboard(_flat_named(spark, sf), prices(spark, sf), list(CS.CAPACITY_CASES), {"5-LOW": _DAY})
    return b.select("db", "db_label", "db_name", "case_name", r6("qps", "qps"), r6("latency", "latency"), r6("recall", "recall"),
                    F.col("label").cast("bigint").alias("label"), "version", F.round("qp$", 2).alias("qpd"))


@query("s17_leaderboard_file", f"WITH {_BOARD} SELECT db, count(*) AS n, round(sum(qps), 3) AS qps FROM lb GROUP BY 1")
def leaderboard_file(spark, sf):
    path = scratch_path(spark, "leaderboard")
    RS.write_leaderboard(A.leaderboard(_flat_named(spark, sf), prices(spark, sf), list(CS.CAPACITY_CASES), {"5-LOW": _DAY}), path)
    back = spark.read.schema("db string, qps double").json(path)
    return back.groupBy("db").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("qps"), 3).alias("qps"))


@query("f14_priced_backends", f"WITH {_PRICE_SQL}, d AS (SELECT DISTINCT o_orderpriority AS db, o_orderstatus AS db_label FROM orders WHERE o_orderpriority <> '2-HIGH') SELECT db, db_label, coalesce(price, 0)::DOUBLE AS price FROM d LEFT JOIN pr USING (db, db_label)")
def priced_backends(spark, sf):
    rows = orders(spark, sf).select(F.col("o_orderpriority").alias("db"), F.col("o_orderstatus").alias("db_label"))
    return A.price_list(rows, prices(spark, sf), ["2-HIGH"])


@query("f15_unsupported_filters", """WITH cap AS (SELECT DISTINCT o_orderpriority AS db, CASE WHEN o_orderpriority < '4' THEN o_orderstatus ELSE 'F' END AS filter_type FROM orders)
SELECT o_orderkey, o_orderpriority AS db, o_orderstatus AS filter_type FROM orders o WHERE NOT EXISTS (SELECT 1 FROM cap WHERE cap.db = o.o_orderpriority AND cap.filter_type = o.o_orderstatus)""")
def unsupported_filters(spark, sf):
    tasks = orders(spark, sf).select("o_orderkey", F.col("o_orderpriority").alias("db"), F.col("o_orderstatus").alias("filter_type"))
    able = tasks.select("db", F.when(F.col("db") < "4", F.col("filter_type")).otherwise("F").alias("filter_type")).distinct()
    return FL.unsupported(tasks, able).select("o_orderkey", "db", "filter_type")


@query("j8_price_lookup", f"""WITH {_PRICE_SQL} SELECT o_orderkey, coalesce(price, 0)::DOUBLE AS price FROM orders LEFT JOIN pr ON pr.db = o_orderpriority AND pr.db_label = o_orderstatus""")
def price_lookup(spark, sf):
    rows = orders(spark, sf).select("o_orderkey", F.col("o_orderpriority").alias("db"), F.col("o_orderstatus").alias("db_label"))
    return A.with_price(rows, prices(spark, sf)).select("o_orderkey", "price")


def _case_values() -> str:
    rows = []
    for r in CS.case_rows():
        cells = ["NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in r]
        rows.append(f"({', '.join(cells)})")
    return f"cs(case_id, kind, case_name, dataset, size, dim, metric, dataset_title, filter_rate) AS (VALUES {', '.join(rows)})"


@query("j9_case_lookup", f"WITH {_case_values()} SELECT o_orderkey, kind, case_name, dataset, size::BIGINT AS size, filter_rate::DOUBLE AS filter_rate FROM (SELECT o_orderkey, {CASE_ID} AS case_id FROM orders) LEFT JOIN cs USING (case_id)")
def case_lookup(spark, sf):
    rows = orders(spark, sf).select("o_orderkey", F.expr(CASE_ID).alias("case_id"))
    return CS.with_case(rows, CS.case_table(spark)).select("o_orderkey", "kind", "case_name", "dataset", "size", "filter_rate")


@query("e4_cases_in_use", f"WITH {_case_values()} SELECT case_name, dataset_title, count(*) AS n FROM (SELECT {CASE_ID} AS case_id FROM orders) JOIN cs USING (case_id) GROUP BY 1, 2")
def cases_in_use(spark, sf):
    rows = orders(spark, sf).select(F.expr(CASE_ID).alias("case_id"))
    return CS.with_case(rows, CS.case_table(spark)).groupBy("case_name", "dataset_title").agg(F.count(F.lit(1)).alias("n"))


@query("j10_parametric_cases", f"""SELECT o_orderkey, CASE WHEN case_id IN (6, 7, 8, 9, 12, 14) THEN 400 ELSE case_id END::BIGINT AS case_id,
CASE WHEN case_id IN (6, 7, 12) THEN '0.01' WHEN case_id IN (8, 9, 14) THEN '0.99' END AS rate,
CASE WHEN case_id IN (6, 8) THEN 'Large Cohere (768dim, 10M)' WHEN case_id IN (7, 9) THEN 'Medium Cohere (768dim, 1M)' WHEN case_id IN (12, 14) THEN 'Medium OpenAI (1536dim, 500K)' END AS dataset
FROM (SELECT o_orderkey, {CASE_ID} AS case_id FROM orders)""")
def parametric_cases(spark, sf):
    case_id, custom = CS.as_parametric(F.expr(CASE_ID), F.create_map(F.lit("k"), F.lit("100")))
    rows = orders(spark, sf).select("o_orderkey", case_id.cast("bigint").alias("case_id"), custom.alias("c"))
    return rows.select("o_orderkey", "case_id", F.col("c")["filter_rate"].alias("rate"), F.col("c")["dataset_with_size_type"].alias("dataset"))


@query("j11_task_matrix", """SELECT DISTINCT o_orderpriority AS db, o_orderstatus AS case_name, nlist, nprobe FROM orders, (SELECT unnest([16, 64, 256])::BIGINT AS nlist), (SELECT unnest([1, 4])::BIGINT AS nprobe)""")
def task_matrix(spark, sf):
    rows = orders(spark, sf).select(F.col("o_orderpriority").alias("db"), F.col("o_orderstatus").alias("case_name")).distinct()
    m = CS.expand(rows, nlist=[16, 64, 256], nprobe=[1, 4])
    return m.select("db", "case_name", F.col("nlist").cast("bigint").alias("nlist"), F.col("nprobe").cast("bigint").alias("nprobe"))


@query("t7_report_order", f"WITH {R_SQL} SELECT o_orderpriority AS db, o_orderstatus AS db_label, concat('case-', case_id) AS case_name, round(sum(qps), 3) AS qps FROM r GROUP BY 1, 2, 3 ORDER BY 1 DESC, 2 DESC, 3 DESC")
def report_order(spark, sf):
    rows = _flat_named(spark, sf).groupBy("db", "db_label", "case_name").agg(F.round(F.sum("qps"), 3).alias("qps"))
    return A.report_order(rows)


@query("t9_listed_order", """SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1 ORDER BY CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '1-URGENT' THEN 2 ELSE 3 END, 1""")
def listed_order(spark, sf):
    rows = orders(spark, sf).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return rows.orderBy(*A.in_listed_order("o_orderpriority", ["5-LOW", "1-URGENT"]))


@query("t10_best_first", """SELECT o_orderkey, metric, round(CASE WHEN metric = 'load_duration' THEN -o_totalprice ELSE o_totalprice END, 6) AS sort_value FROM orders, (SELECT unnest(['qps', 'load_duration']) AS metric)""")
def best_first(spark, sf):
    rows = CS.expand(orders(spark, sf).select("o_orderkey", "o_totalprice"), metric=["qps", "load_duration"])
    v = rows.select("o_orderkey", "metric", r6(A.best_first(F.col("metric"), F.col("o_totalprice")), "sort_value"))
    return v.orderBy(*A.in_listed_order("metric", A.METRIC_ORDER), F.col("sort_value").desc())


@query("u1_concatenate_stages", """SELECT o_orderkey, 100::BIGINT AS stage FROM orders UNION ALL SELECT o_orderkey, 110 FROM orders WHERE o_orderstatus <> 'F' UNION ALL SELECT o_orderkey, 50 FROM orders""")
def concatenate_stages(spark, sf):
    o = orders(spark, sf)
    stage = [o.select("o_orderkey", F.lit(s).cast("bigint").alias("stage")) for s in (50, 100)]
    after = o.filter("o_orderstatus <> 'F'").select("o_orderkey", F.lit(110).cast("bigint").alias("stage"))
    return stage[0].unionByName(stage[1]).unionByName(after)


@query("u2_append_selected_runs", f"WITH {R_SQL} SELECT run_id, position, round(qps, 6) AS qps FROM r WHERE task_label = 'standard_2025'")
def append_selected_runs(spark, sf):
    f = RS.flat_cases(parsed(spark, sf)).filter(F.col("task_label") == "standard_2025")
    return f.select("run_id", F.col("position").cast("bigint").alias("position"), r6("qps", "qps"))


# --- chart tables and further leaderboards ------------------------------------------------------------------


@query("e5_chart_by_case", f"""WITH {_MERGED} SELECT case_name, db_name, round(qps, 6) AS qps FROM mg WHERE status = ':)'""")
def chart_by_case(spark, sf):
    m = A.merge_runs(run_rows(spark, sf), ["db_name", "case_name"]).filter(F.col("status") == X.NORMAL)
    return m.select("case_name", "db_name", r6("qps", "qps")).orderBy("case_name", F.col("qps").desc())


@query("e5_chart_by_dataset_and_rate", f"""WITH {R_SQL}, {_case_values()}, m AS (SELECT o_orderpriority AS db, dataset_title, filter_rate, arg_max(qps, (qps, o_orderkey, position)) AS qps, arg_max((o_orderkey % 100) / 100, (qps, o_orderkey, position)) AS recall
FROM r JOIN cs USING (case_id) WHERE status = ':)' AND dataset IS NOT NULL GROUP BY 1, 2, 3)
SELECT db, dataset_title, coalesce(filter_rate, 0)::DOUBLE AS filter_rate, round(qps, 6) AS qps, round(recall, 6) AS recall FROM m""")
def chart_by_dataset(spark, sf):
    f = CS.with_case(RS.flat_cases(parsed(spark, sf)), CS.case_table(spark)).filter(F.col("dataset").isNotNull() & (F.col("status") == X.NORMAL))
    seq = F.struct(F.regexp_extract("path", r"_(\d{12})", 1).alias("k"), "position")
    rows = f.select("db", "dataset_title", F.coalesce("filter_rate", F.lit(0.0)).alias("filter_rate"), "qps", "recall", "status", seq.alias("seq"))
    m = A.merge_runs(rows, ["db", "dataset_title", "filter_rate"])
    return m.select("db", "dataset_title", "filter_rate", r6("qps", "qps"), r6("recall", "recall"))


@query("e6_leaderboard_by_filter", f"""WITH {R_SQL}, {_case_values()} SELECT dataset_title AS dataset, o_orderpriority AS db, o_orderstatus AS label, concat_ws('-', o_orderpriority, o_orderstatus) AS db_name,
round_even(qps, 4) AS qps, round_even((o_custkey % 1000) / 1000, 4) AS latency, round_even((o_orderkey % 100) / 100, 4) AS recall, round_even(coalesce(filter_rate, 0)::DOUBLE, 3) AS filter_ratio
FROM r JOIN cs USING (case_id) WHERE task_label = 'standard_2025' AND kind = 'performance'""")
def leaderboard_by_filter(spark, sf):
    f = CS.with_case(RS.flat_cases(parsed(spark, sf)), CS.case_table(spark))
    return A.leaderboard_by_filter(f.filter((F.col("task_label") == "standard_2025") & (F.col("kind") == "performance")))


@query("e6_leaderboard_streaming", f"""WITH {R_SQL} SELECT o_orderpriority AS db, o_orderstatus AS label, 500::BIGINT AS insert_rate, CASE WHEN NOT old_style THEN round_even(o_totalprice / 7, 4) END AS streaming_qps,
CASE WHEN NOT old_style THEN 0.02 END::DOUBLE AS streaming_latency, NOT old_style AS has_stage FROM r WHERE case_id = 200""")
def leaderboard_streaming(spark, sf):
    f = RS.flat_cases(parsed(spark, sf)).filter(F.col("case_id") == CS.STREAMING)
    f = f.withColumn("insert_rate", F.col("custom_case")["insert_rate"].cast("bigint")).withColumn("dataset_title", F.lit(None).cast("string"))
    return A.leaderboard_streaming(f).drop("dataset", "db_name")


# --- names, dates, numbers -----------------------------------------------------------------------------------


@query("m1_short_numbers", """SELECT o_orderkey, CASE WHEN n < 1e3 THEN trunc(n)::BIGINT::VARCHAR WHEN n < 1e6 THEN concat(trunc(n / 1e3)::BIGINT, 'K') WHEN n < 1e9 THEN concat(trunc(n / 1e6)::BIGINT, 'M') ELSE concat(trunc(n / 1e9)::BIGINT, 'B') END AS text
FROM (SELECT o_orderkey, trunc(o_totalprice * power(10.0, (o_orderkey % 9) - 3)) AS n FROM orders)""")
def short_numbers(spark, sf):
    n = (F.col("o_totalprice") * F.pow(F.lit(10.0), F.col("o_orderkey") % 9 - 3)).cast("bigint")
    return orders(spark, sf).select("o_orderkey", N.short_number(n).alias("text"))


@query("m2_label_values", f"SELECT event_id, concat('label_', {_rate_text('p', '1e9')}, 'p') AS text FROM (SELECT event_id, (event_id % 1000 + 1) / 1000.0::DOUBLE * 100 AS p FROM events)")
def label_values(spark, sf):
    return table(spark, sf, "events").select("event_id", X.label_value((F.col("event_id") % 1000 + 1) / 1000).alias("text"))


@query("m3_int_rates", f"SELECT event_id, concat('int_', {_rate_text('p', '99')}, 'p') AS text FROM (SELECT event_id, (event_id % 1000 + 1) / 1000.0::DOUBLE * 100 AS p FROM events)")
def int_rates(spark, sf):
    return table(spark, sf, "events").select("event_id", X.int_rate_name((F.col("event_id") % 1000 + 1) / 1000).alias("text"))


@query("m4_dataset_names", """SELECT p_partkey, lower(concat_ws('_', p_type, p_brand, CASE WHEN p_partkey < 1000 THEN p_partkey::VARCHAR ELSE concat(p_partkey // 1000, 'K') END)) AS dir,
concat(upper(substr(p_type, 1, 1)), lower(substr(p_type, 2)), ' (', upper(substr(p_brand, 1, 1)), lower(substr(p_brand, 2)), ')') AS title FROM part""")
def dataset_names(spark, sf):
    return table(spark, sf, "part").select("p_partkey", X.dataset_dir(F.col("p_type"), F.col("p_brand"), F.col("p_partkey")).alias("dir"),
                                           X.dataset_title(F.col("p_type"), F.col("p_brand")).alias("title"))


@query("m5_backend_names", f"SELECT o_orderkey, concat_ws('-', o_orderpriority, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, nullif({VERSION}, '')) AS db_name FROM orders")
def backend_names(spark, sf):
    label = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus"))
    return orders(spark, sf).select("o_orderkey", X.backend_name(F.col("o_orderpriority"), label, F.expr(VERSION)).alias("db_name"))


@query("m6_case_names", "SELECT event_id, concat('Int-Filter-', printf('%.1f', (event_id % 1000) / 1000.0::DOUBLE * 100), '% - ', event_type) AS name FROM events")
def case_names(spark, sf):
    return table(spark, sf, "events").select("event_id", X.filter_case_name("Int", (F.col("event_id") % 1000) / 1000, F.col("event_type")).alias("name"))


@query("m7_label_and_db_of_path", f"""WITH {R_SQL} SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS task_label, concat(lpad(o_orderkey::VARCHAR, 12, '0'), CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE concat('_', lower(o_orderpriority)) END) AS db FROM o""")
def label_and_db_of_path(spark, sf):
    label, db = X.file_label_and_db(F.col("path"))
    return documents(spark, sf).select("o_orderkey", label.alias("task_label"), db.alias("db"))


@query("m8_test_month", "SELECT o_orderkey, strftime(greatest(o_orderdate, TIMESTAMP '1998-03-15'), '%Y-%m') AS month FROM orders")
def test_month(spark, sf):
    epoch = F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("double")
    return orders(spark, sf).select("o_orderkey", X.test_month(epoch, "1998-03-15").alias("month"))


@query("m9_midnight_and_stamp", "SELECT event_id, epoch(date_trunc('day', ts))::DOUBLE AS midnight, strftime(ts, '%Y%m%d') AS stamp FROM events")
def midnight_and_stamp(spark, sf):
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf, "events").select("event_id", X.midnight(ts).alias("midnight"), X.day_stamp(ts).alias("stamp"))


@query("m10_unit_changes", f"""WITH {R_SQL} SELECT run_id, position, round(CASE WHEN o_orderkey > 0 THEN o_orderkey * 10 / 1000 ELSE o_orderkey * 10 END, 6)::DOUBLE AS max_load_count, round((o_custkey % 1000) / 1000 * 1000, 6) AS p99,
round(CASE WHEN old_style THEN 0 ELSE (o_custkey % 900) / 1000 * 1000 END, 6)::DOUBLE AS p95 FROM r""")
def unit_changes(spark, sf):
    f = RS.flat_cases(parsed(spark, sf), change_units=True)
    return f.select("run_id", F.col("position").cast("bigint").alias("position"), r6("max_load_count", "max_load_count"),
                    r6("serial_latency_p99", "p99"), r6("serial_latency_p95", "p95"))


@query("m11_thousand_queries_per_dollar", f"""WITH {_PRICE_SQL} SELECT o_orderkey, round(CASE WHEN o_totalprice > 0 AND coalesce(price, 0) > 0 THEN o_totalprice / price * 3.6 END, 6) AS qpd FROM orders LEFT JOIN pr ON pr.db = o_orderpriority AND pr.db_label = o_orderstatus""")
def thousand_queries_per_dollar(spark, sf):
    rows = orders(spark, sf).select("o_orderkey", F.col("o_orderpriority").alias("db"), F.col("o_orderstatus").alias("db_label"), F.col("o_totalprice").alias("qps"))
    return A.dollar_chart(rows, prices(spark, sf)).select("o_orderkey", r6("qpd", "qpd"))


@query("m12_queries_per_dollar", f"""WITH {_PRICE_SQL} SELECT o_orderkey, round(CASE WHEN coalesce(price, 0) > 0 THEN o_totalprice / price * 3600 ELSE 0 END, 2) AS qpd FROM orders LEFT JOIN pr ON pr.db = o_orderpriority AND pr.db_label = o_orderstatus""")
def queries_per_dollar(spark, sf):
    rows = orders(spark, sf).select("o_orderkey", F.col("o_orderpriority").alias("db"), F.col("o_orderstatus").alias("db_label"), F.col("o_totalprice").alias("qps"))
    priced = A.with_price(rows, prices(spark, sf))
    return priced.select("o_orderkey", F.round(N.queries_per_dollar(F.col("qps"), F.col("price")), 2).alias("qpd"))


@query("m14_status_codes", f"SELECT o_orderkey, CASE {STATUS} WHEN ':)' THEN 1 WHEN 'x' THEN -1 ELSE -2 END::BIGINT AS code FROM orders")
def status_codes(spark, sf):
    return orders(spark, sf).select("o_orderkey", X.status_code(F.expr(STATUS)).cast("bigint").alias("code"))


@query("m15_run_titles", f"""WITH {R_SQL} SELECT o_orderkey, CASE WHEN task_label = run_id THEN concat('res-', substr(run_id, 1, 4)) ELSE task_label END AS title FROM o""")
def run_titles(spark, sf):
    run_id = F.concat(F.lit("r"), F.col("o_custkey"))
    label = F.when(F.col("o_custkey") % 5 == 0, run_id).otherwise(F.expr(LABEL))
    return orders(spark, sf).select("o_orderkey", X.run_title(label, run_id).alias("title"))


@query("m16_rounding", "SELECT l_orderkey, l_linenumber, round_even(l_extendedprice / 7, 4) AS four, round_even(l_extendedprice / 7, 3) AS three FROM lineitem")
def rounding(spark, sf):
    x = F.col("l_extendedprice") / 7
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", N.round4(x).alias("four"), N.round_even(x, 3).alias("three"))


@query("m17_rows_per_batch", "SELECT p_partkey, trunc(1024 * 1024 / (p_size * 4))::BIGINT AS rows FROM part")
def rows_per_batch(spark, sf):
    return table(spark, sf, "part").select("p_partkey", N.rows_per_batch(F.lit(1024 * 1024), F.col("p_size")).alias("rows"))


# --- corpus tables ------------------------------------------------------------------------------------------


@query("s6_dataset_lookup", """WITH ds(i, folder, title) AS (VALUES (0, 'cohere_small_100k', 'Cohere (Small)'), (1, 'cohere_medium_1m', 'Cohere (Medium)'), (2, 'openai_large_5m', 'Openai (Large)'), (3, 'laion_large_100m', 'Laion (Large)'), (4, 'sift_small_500k', 'Sift (Small)'))
SELECT o_orderkey, folder, title FROM orders JOIN ds ON ds.i = o_custkey % 5""")
def dataset_lookup(spark, sf):
    wanted = [("Cohere", 100_000), ("Cohere", 1_000_000), ("OpenAI", 5_000_000), ("LAION", 100_000_000), ("SIFT", 500_000)]
    name = F.array(*[F.lit(n) for n, _ in wanted])[(F.col("o_custkey") % 5).cast("int")]
    size = F.array(*[F.lit(s).cast("bigint") for _, s in wanted])[(F.col("o_custkey") % 5).cast("int")]
    rows = orders(spark, sf).select("o_orderkey", name.alias("name"), size.alias("size"))
    return rows.join(CS.dataset_table(spark), ["name", "size"], "left").select(
        "o_orderkey", F.coalesce("folder", F.raise_error(F.lit("unknown dataset")).cast("string")).alias("folder"), "title")


@query("s8_manifest_diff", """WITH l AS (SELECT doc_id AS path, n_chars + CASE WHEN doc_id % 17 = 0 THEN 1 ELSE 0 END AS length FROM documents WHERE doc_id % 13 <> 0)
SELECT d.doc_id AS path, d.n_chars AS length FROM documents d WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.path = d.doc_id AND l.length = d.n_chars)""")
def manifest_diff(spark, sf):
    """The local manifest lacks some files and has a wrong length for others."""
    remote = table(spark, sf, "documents").select(F.col("doc_id").alias("path"), F.col("n_chars").alias("length"))
    local = remote.filter(F.col("path") % 13 != 0).withColumn("length", F.col("length") + F.when(F.col("path") % 17 == 0, 1).otherwise(0))
    return SRC.size_mismatches(remote, local)


_UPSERT = """WITH old AS (SELECT o_orderkey AS id, o_totalprice AS price, 1 AS version FROM orders), new AS (SELECT o_orderkey AS id, o_totalprice * 2 AS price, 2 AS version FROM orders WHERE o_orderpriority = '1-URGENT'
UNION ALL SELECT o_orderkey + (SELECT max(o_orderkey) + 1 FROM orders), o_totalprice, 2 FROM orders WHERE o_orderpriority = '5-LOW'),
b AS (SELECT * FROM old UNION ALL SELECT * FROM new) SELECT id, round(arg_max(price, version), 6) AS price, max(version)::BIGINT AS version FROM b GROUP BY id"""


@query("s11_upsert", _UPSERT)
def upsert(spark, sf):
    old, new = _versions(spark, sf)
    return SRC.newest_per_id(old, new).select("id", r6("price", "price"), "version")


def _versions(spark, sf):
    """Stored orders and a delivery that changes some and adds others."""
    o = orders(spark, sf)
    old = o.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), F.lit(1).cast("bigint").alias("version"))
    shift = o.agg(F.max("o_orderkey")).first()[0] + 1
    changed = o.filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("id"), (F.col("o_totalprice") * 2).alias("price"), F.lit(2).cast("bigint").alias("version"))
    added = o.filter("o_orderpriority = '5-LOW'").select((F.col("o_orderkey") + shift).alias("id"), F.col("o_totalprice").alias("price"), F.lit(2).cast("bigint").alias("version"))
    return old, changed.unionByName(added)


@query("s11_upsert_in_place", _UPSERT)
def upsert_in_place(spark, sf):
    """The delivery comes in two parts, the second of them twice; buckets without new rows keep their files."""
    old, new = _versions(spark, sf)
    stored = VersionedTable(spark, scratch_path(spark, "versioned"))
    stored.create(old, 8)
    first = F.col("id") % 2 == 0
    stored.upsert(new.where(first), "version", "first")
    for _ in range(2):
        stored.upsert(new.where(~first), "version", "second")
    return stored.read().select("id", r6("price", "price"), "version")
