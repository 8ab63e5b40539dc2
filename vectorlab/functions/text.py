"""Names, labels, dates and list parameters as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import short_number

NORMAL, FAILED, OUT_OF_RANGE = ":)", "x", "?"


def one_decimal(percent: Column) -> Column:
    return F.format_string("%.1f", percent)


def label_value(share: Column) -> Column:
    """Label text of a corpus share: label_5p, label_0.1p."""
    percent = share * 100
    text = F.when(percent >= 1, percent.cast("bigint").cast("string")).otherwise(one_decimal(percent))
    return F.concat(F.lit("label_"), text, F.lit("p"))


def int_rate_name(rate: Column) -> Column:
    """Rate text of an id filter: int_50p, int_99.5p."""
    percent = rate * 100
    whole = percent.between(1, 99)
    text = F.when(whole, percent.cast("bigint").cast("string")).otherwise(one_decimal(percent))
    return F.concat(F.lit("int_"), text, F.lit("p"))


def dataset_dir(name: Column, label: Column, size: Column) -> Column:
    return F.lower(F.concat_ws("_", name, label, short_number(size)))


def capitalised(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substring(word, 2, 1_000_000)))


def dataset_title(name: Column, label: Column) -> Column:
    return F.concat(capitalised(name), F.lit(" ("), capitalised(label), F.lit(")"))


def non_empty(c: Column) -> Column:
    return F.when(c != "", c)


def backend_name(db: Column, label: Column, version: Column) -> Column:
    """db-label-version without the empty parts."""
    return F.concat_ws("-", db, non_empty(label), non_empty(version))


def filter_case_name(kind: str, rate: Column, dataset: Column) -> Column:
    return F.concat(F.lit(f"{kind}-Filter-"), one_decimal(rate * 100), F.lit("% - "), dataset)


def file_label_and_db(path: Column) -> tuple[Column, Column]:
    """Second and third part of a result file's stem; the folder name stands in for a missing third."""
    pieces = F.split(path, "/")
    stem = F.regexp_replace(F.element_at(pieces, -1), r"\.[^.]*$", "")
    parts = F.split(stem, "_", 3)
    label = F.coalesce(F.get(parts, F.lit(1)), F.lit(""))
    folder = F.get(pieces, F.size(pieces) - 2)
    return label, F.coalesce(F.get(parts, F.lit(2)), folder)


def test_month(epoch: Column, earliest: str = "2023-08-01") -> Column:
    """Year and month of a run, not before the given day."""
    moment = F.greatest(F.timestamp_seconds(epoch), F.lit(earliest).cast("timestamp"))
    return F.date_format(moment, "yyyy-MM")


def midnight(ts: Column) -> Column:
    return F.unix_timestamp(F.date_trunc("day", ts)).cast("double")


def day_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def status_code(status: Column) -> Column:
    return F.when(status == NORMAL, 1).when(status == FAILED, -1).when(status == OUT_OF_RANGE, -2)


def run_title(task_label: Column, run_id: Column) -> Column:
    """The label of a run, or a short form of its id when the label is only the id."""
    is_id = task_label.isNull() | (task_label == run_id)
    return F.when(is_id, F.concat(F.lit("res-"), F.substring(run_id, 1, 4))).otherwise(task_label)


def number_list(text: Column) -> Column:
    return F.from_json(text, "array<double>")


def clean_list(text: Column) -> Column:
    """Comma-separated text as trimmed, non-empty items."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def without_nulls(options: Column) -> Column:
    return F.map_filter(options, lambda _, v: v.isNotNull())
