"""Result files: nested JSON in and out, flat tables, leaderboard and price files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import numbers as N
from ..functions import text as X

# fixed values: field names of a metric record
SCALARS = ["max_load_count", "insert_duration", "optimize_duration", "load_duration", "qps",
           "serial_latency_p99", "serial_latency_p95", "recall", "ndcg"]
CONCURRENT = ["conc_qps_list", "conc_latency_p99_list", "conc_latency_p95_list", "conc_latency_p90_list",
              "conc_latency_avg_list", "conc_recall_list"]
STAGED = ["st_search_time_list", "st_max_qps_list_list", "st_recall_list", "st_ndcg_list",
          "st_serial_latency_p99_list", "st_serial_latency_p95_list", "st_conc_failed_rate_list"]
SECRETS = ["password", "api_key"]
#: How archives are written as lines. One task reads a whole file.
COMPRESSED = {"compression": "gzip", "maxRecordsPerFile": 250_000}

METRICS = ", ".join(
    ["max_load_count: bigint"] + [f"{c}: double" for c in SCALARS[1:]]
    + ["load_dur: double", "latency_p99: double", "latency_p95: double"]
    + ["conc_num_list: array<int>"] + [f"{c}: array<double>" for c in CONCURRENT]
    + ["st_ideal_insert_duration: int", "st_search_stage_list: array<int>"] + [f"{c}: array<double>" for c in STAGED])

SCHEMA = f"""
run_id string, task_label string, file_fmt string, timestamp double,
results array<struct<
  label: string,
  metrics: struct<{METRICS}>,
  task_config: struct<
    db: string,
    db_config: struct<db_label: string, version: string, note: string>,
    db_case_config: map<string,string>,
    case_config: struct<case_id: int, custom_case: map<string,string>, k: int,
      concurrency_search_config: struct<num_concurrency: array<int>, concurrency_duration: int, concurrency_timeout: int>>,
    stages: array<string>>>>,
_corrupt string
"""


def schema() -> StructType:
    """The layout of a result file as a Spark type."""
    return StructType.fromDDL(SCHEMA)


def read_result_files(spark: SparkSession, root: str, one_per_file: bool = True,
                      pattern: str = "result_*.json") -> tuple[DataFrame, DataFrame]:
    """(readable results, unreadable ones) of a directory tree, with their path.

    One file is one JSON value; a large archive is better kept as one value per line, which
    splits over tasks. A value that cannot be parsed lands in the second table.
    """
    files = (spark.read.schema(SCHEMA).option("multiLine", one_per_file).option("recursiveFileLookup", True)
             .option("pathGlobFilter", pattern).option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", "_corrupt").json(root)
             .withColumn("path", F.input_file_name()))
    good = files.filter(F.col("_corrupt").isNull() & F.col("run_id").isNotNull()).drop("_corrupt")
    bad = files.filter(F.col("_corrupt").isNotNull() | F.col("run_id").isNull()).select("path", "_corrupt")
    return good, bad


def run_headers(files: DataFrame) -> DataFrame:
    """One header per run: that of its first file in path order."""
    header = F.struct("task_label", "timestamp", "path")
    first = files.groupBy("run_id").agg(F.min_by(header, F.col("path")).alias("h"), F.count(F.lit(1)).alias("files"))
    return first.select("run_id", F.coalesce("h.task_label", "run_id").alias("task_label"), "h.timestamp", "files")


def case_rows(files: DataFrame) -> DataFrame:
    """One row per case result, in file and list order, under the header of its run.

    Results of a run stay separate rows; they are never gathered into one list.
    """
    cases = files.select("run_id", "path", F.posexplode("results").alias("position", "r"))
    return cases.join(run_headers(files).drop("files"), "run_id")


def _first_non_zero(*columns: Column) -> Column:
    return F.coalesce(*[F.when(c != 0, c) for c in columns])


def flat_cases(files: DataFrame, change_units: bool = False) -> DataFrame:
    """Case results as flat rows, older field names and missing fields filled in."""
    rows = files.select("run_id", "path", F.posexplode("results").alias("position", "r"))
    m = F.col("r.metrics")
    task = F.col("r.task_config")
    load_count = m["max_load_count"].cast("double")
    p99 = m["serial_latency_p99"]
    p95 = F.coalesce(m["serial_latency_p95"], F.lit(0.0))
    if change_units:
        load_count, p99, p95 = N.rows_to_thousands(load_count), N.seconds_to_ms(p99), N.seconds_to_ms(p95)
    # flat columns first, so that the join moves no nested result
    flat = rows.select(
        "run_id", "path", "position",
        task["db"].alias("db"), F.coalesce(task["db_config"]["db_label"], F.lit("")).alias("db_label"),
        F.coalesce(task["db_config"]["version"], F.lit("")).alias("version"), task["db_config"]["note"].alias("note"),
        X.backend_name(task["db"], task["db_config"]["db_label"], task["db_config"]["version"]).alias("db_name"),
        task["case_config"]["case_id"].alias("case_id"), task["case_config"]["custom_case"].alias("custom_case"),
        X.without_nulls(task["db_case_config"]).alias("index_options"), F.col("r.label").alias("status"),
        load_count.alias("max_load_count"),
        F.coalesce(_first_non_zero(m["load_duration"], m["load_dur"]), F.lit(0.0)).alias("load_duration"),
        *[F.coalesce(m[c], F.lit(0.0)).alias(c) for c in ("insert_duration", "optimize_duration", "qps", "recall", "ndcg")],
        F.coalesce(p99, F.lit(0.0)).alias("serial_latency_p99"), p95.alias("serial_latency_p95"),
        m["conc_num_list"].alias("conc_num_list"), *[m[c].alias(c) for c in CONCURRENT],
        m["st_ideal_insert_duration"].alias("st_ideal_insert_duration"),
        m["st_search_stage_list"].alias("st_search_stage_list"), *[m[c].alias(c) for c in STAGED])
    return flat.join(run_headers(files).drop("files"), "run_id")


def summary_metrics(m: Column) -> dict[str, Column]:
    """Run-level columns of the flat report; older names stand in for zero or missing values."""
    def filled(a: str, b: str) -> Column:
        return F.coalesce(F.when(m[a] != 0, m[a]), m[b])

    return {
        "load_duration": filled("load_duration", "load_dur"),
        "insert_duration": m["insert_duration"], "optimize_duration": m["optimize_duration"],
        "serial_latency_p99": filled("serial_latency_p99", "latency_p99"),
        "serial_latency_p95": filled("serial_latency_p95", "latency_p95"),
        "serial_recall": m["recall"],
    }


# fixed values: columns of the flat report, in order
REPORT = ["db", "task_label", "concurrency", "qps", "latency_p99", "latency_p95", "latency_p90", "latency_avg", "recall",
          "load_duration", "insert_duration", "optimize_duration", "serial_latency_p99", "serial_latency_p95",
          "serial_recall"]


def per_concurrency_rows(files: DataFrame) -> DataFrame:
    """The flat report: a row per case and concurrency, or one summary row without concurrency data."""
    label, db = X.file_label_and_db(F.col("path"))
    m = F.col("r.metrics")
    cases = files.select("path", F.explode("results").alias("r")).withColumns(
        {"db": db, "task_label": label, **summary_metrics(m)})
    lists = ["conc_num_list", *CONCURRENT]
    zipped = F.arrays_zip(*[F.coalesce(m[c], F.array()).alias(c) for c in lists])
    n = F.coalesce(F.size(F.when(m["conc_num_list"].isNotNull(), m["conc_num_list"])), F.lit(0))
    # longer side lists have no concurrency of their own
    levels = F.when(n > 0, F.slice(zipped, 1, n))
    rows = cases.select("*", F.explode_outer(levels).alias("c"))
    single = F.col("c").isNull()

    def pick(name: str, summary: Column | None) -> Column:
        return F.when(single, summary if summary is not None else F.lit(None)).otherwise(F.col("c")[name])

    return rows.select(
        "db", "task_label", F.col("c.conc_num_list").alias("concurrency"),
        pick("conc_qps_list", m["qps"]).alias("qps"),
        pick("conc_latency_p99_list", F.col("serial_latency_p99")).alias("latency_p99"),
        pick("conc_latency_p95_list", F.col("serial_latency_p95")).alias("latency_p95"),
        pick("conc_latency_p90_list", None).alias("latency_p90"),
        pick("conc_latency_avg_list", None).alias("latency_avg"),
        pick("conc_recall_list", F.col("serial_recall")).alias("recall"),
        *REPORT[9:])


def write_results(rows: DataFrame, root: str) -> None:
    """Results by backend folder as compressed JSON lines, without secrets.

    `rows` has run_id, task_label, timestamp, db and the nested result `r`. As text a result is mostly
    field names. Compressed files don't split, so the rows of one are bounded.
    """
    clean = rows.withColumn("r", without_secrets(F.col("r"), rows.schema["r"].dataType))
    clean.write.mode("overwrite").options(**COMPRESSED).partitionBy("db").json(root)


def without_secrets(result: Column, schema: StructType) -> Column:
    """The result struct with secret fields dropped from its backend settings."""
    config = schema["task_config"].dataType["db_config"].dataType
    present = [c for c in SECRETS if c in config.names]
    if not present:
        return result
    task = result["task_config"].withField("db_config", result["task_config"]["db_config"].dropFields(*present))
    return result.withField("task_config", task)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_leaderboard(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """(db, db_label, price) from a nested price file."""
    nested = (spark.read.text(path, wholetext=True)
              .select(F.from_json("value", "map<string,map<string,double>>").alias("prices")))
    by_db = nested.select(F.explode("prices").alias("db", "labels"))
    return by_db.select("db", F.explode("labels").alias("db_label", "price"))
