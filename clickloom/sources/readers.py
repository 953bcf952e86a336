"""Readers for raw input and for the datasets a run wrote. Schemas are declared."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import schema
from clickloom.sources import layout

_RUN_ID = T.StructField("run_id", T.StringType())


def read_clickstream(spark: SparkSession, path: str) -> DataFrame:
    """Raw events from UTF-8 CSV files with a header line.

    Cells that do not fit their type are NULL, short rows are filled up with NULLs and
    surplus cells are ignored. Use :func:`split_corrupt` to set such rows aside.
    """
    return (
        spark.read.schema(schema.RAW_SCHEMA)
        .options(header=True, encoding="UTF-8", mode="PERMISSIVE")
        .csv(path)
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same files as unparsed lines, in one column ``value``."""
    return spark.read.text(path)


def split_corrupt(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parse CSV lines; return (valid rows, lines that do not fit the schema).

    The second frame has the one column ``_corrupt_record``. Parsing is an ordinary
    expression here, so whether a line is corrupt does not depend on which columns are
    selected later, and nothing has to be cached to look at the corrupt ones. Blank
    lines are skipped wherever they stand, and so are header lines in any case, quoted
    or not, with blanks around the names or a byte order mark before them.
    """
    parsed = parse_lines(lines)
    corrupt = F.col(schema.CORRUPT_COLUMN)
    return (
        parsed.where(corrupt.isNull()).drop(schema.CORRUPT_COLUMN),
        parsed.where(corrupt.isNotNull()).select(schema.CORRUPT_COLUMN),
    )


def parse_lines(lines: DataFrame) -> DataFrame:
    """Every line with data as a raw row, with ``_corrupt_record`` where it does not fit."""
    marked = T.StructType(
        [*schema.RAW_SCHEMA.fields, T.StructField(schema.CORRUPT_COLUMN, T.StringType())]
    )
    row = F.from_csv(
        "value",
        marked.toDDL(),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schema.CORRUPT_COLUMN},
    )
    texts = [f.name for f in schema.RAW_SCHEMA.fields if f.dataType == T.StringType()]
    # from the last column on: the first test that fails ends it, and ids are the first
    named = (F.lower(F.trim(F.translate(c, "\ufeff", ""))).eqNullSafe(F.lit(c)) for c in texts[::-1])
    is_header = reduce(and_, named)
    not_blank = F.col("value").rlike(r"[^\x00-\x20]")
    # inline() rather than "row.*": filters are not moved below a generator, so each
    # line is parsed once and not again for every column a later filter looks at.
    return lines.where(not_blank).select(F.inline(F.array(row))).where(~is_header)


def read_parsed(spark: SparkSession, output: str, run_id: str) -> tuple[DataFrame, DataFrame]:
    """What a run parsed: (valid rows, lines set aside). Each reads its own folder only."""
    columns = [
        *schema.RAW_SCHEMA.fields,
        T.StructField(schema.CORRUPT_COLUMN, T.StringType()),
        T.StructField("corrupt", T.BooleanType()),
    ]
    parsed = spark.read.schema(T.StructType(columns)).parquet(
        layout.run_path(layout.parsed_path(output), run_id)
    )
    return (
        parsed.where("NOT corrupt").select(*schema.RAW_SCHEMA.names),
        parsed.where("corrupt").select(schema.CORRUPT_COLUMN),
    )


def read_cleaned(spark: SparkSession, output: str, run_id: str | None = None) -> DataFrame:
    """Cleaned events of one run, or of all runs with their ``run_id``."""
    return _read_parquet(spark, layout.cleaned_path(output), schema.CLEANED_SCHEMA, run_id)


def read_aggregate(
    spark: SparkSession, output: str, name: str, run_id: str | None = None
) -> DataFrame:
    """An aggregate of one run, or of all runs with their ``run_id``."""
    path = layout.aggregate_path(output, name)
    return _read_parquet(spark, path, schema.AGGREGATE_SCHEMAS[name], run_id)


def read_user_activity(
    spark: SparkSession, output: str, run_id: str | None = None
) -> DataFrame:
    """Facts per user and region of one run, or of all runs with their ``run_id``."""
    path = layout.aggregate_path(output, "user_activity")
    return _read_parquet(spark, path, schema.USER_ACTIVITY_SCHEMA, run_id)


def read_summary(spark: SparkSession, output: str, run_id: str | None = None) -> DataFrame:
    """The one-row summary of a run, or of all runs with their ``run_id``."""
    return _read_parquet(spark, layout.summary_path(output), schema.SUMMARY_SCHEMA, run_id)


def read_report(
    spark: SparkSession, output: str, name: str, run_id: str, typed: bool = True
) -> DataFrame:
    """A delimited report. Without ``typed`` every column is text, as in the file.

    A value may hold line breaks, so a file cannot be split and is read by one task. The
    writer bounds the rows of a file; only a report asked for as a single file is as
    large as it is, and so is the task that reads it.
    """
    columns = schema.AGGREGATE_SCHEMAS[name]
    if not typed:
        columns = T.StructType([T.StructField(c, T.StringType()) for c in columns.names])
    path = layout.run_path(layout.report_path(output, name), run_id)
    options = {"header": True, "sep": schema.REPORT_DELIMITER, "multiLine": True}
    return spark.read.schema(columns).options(**options).csv(path)


def read_corrupt(spark: SparkSession, output: str, run_id: str) -> DataFrame:
    """The lines a run set aside."""
    path = layout.run_path(layout.corrupt_path(output), run_id)
    return spark.read.text(path).withColumnRenamed("value", schema.CORRUPT_COLUMN)


def latest_run(dataset: DataFrame, runs: DataFrame) -> DataFrame:
    """The rows of a dataset that belong to the greatest ``run_id`` of ``runs``.

    ``runs`` is what :func:`read_summary` gives: one row per finished run. Of the dataset
    only the files of that run are read.
    """
    newest = runs.agg(F.max("run_id")).scalar()
    return dataset.where(F.col("run_id") == newest)


def latest_run_id(spark: SparkSession, output: str) -> str | None:
    """The greatest id of a finished run, None if there is none.

    Looks at the summaries only: one row per run, written last, so a run that was cut
    short is never picked up.
    """
    runs = found(lambda: read_summary(spark, output))
    return None if runs is None else runs.agg(F.max("run_id")).first()[0]


def is_finished(spark: SparkSession, output: str, run_id: str) -> bool:
    """Whether a run wrote its summary."""
    summary = found(lambda: read_summary(spark, output, run_id))
    return summary is not None and not summary.isEmpty()


def found(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` gives, or None if its path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _read_parquet(
    spark: SparkSession, path: str, columns: T.StructType, run_id: str | None
) -> DataFrame:
    if run_id is None:
        return spark.read.schema(T.StructType([*columns.fields, _RUN_ID])).parquet(path)
    # Naming the run's folder lists that folder only, however many runs there are.
    return spark.read.schema(columns).parquet(layout.run_path(path, run_id))
