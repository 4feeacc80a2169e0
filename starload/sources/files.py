"""File sources: Parquet (S1) and the CSV layout our CSV sink writes.

Paths are any Hadoop URI (local, ``hdfs://``, ``s3a://``...); the
filesystem settings belong to whoever deploys the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starload.functions.columns import quoted
from starload.operators.conform import select_in_schema_order

# How NULL, quotes and embedded newlines are written to and read
# from CSV, so that NULL, '' and text with quotes, line breaks or surrounding
# blanks survive a round trip (Spark's writer trims blanks unless told not
# to). NULL is written as \N; a text value that starts with the escape
# character gets one more in front, so no text can read as NULL.
CSV_NULL = "\\N"
CSV_ESCAPE = "\\"
CSV_OPTIONS = {
    "header": "true",
    "nullValue": CSV_NULL,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _text_exprs(schema: T.StructType, text_expr) -> list[str]:
    out = []
    for f in schema.fields:
        c = quoted(f.name)
        e = text_expr(c) if isinstance(f.dataType, T.StringType) else c
        out.append(f"{e} AS {c}")
    return out


#: How line breaks in texts are written: inside quotes, as they are, or as two characters.
LINE_BREAKS = ("quoted", "escaped")


def _known(line_breaks: str) -> bool:
    if line_breaks not in LINE_BREAKS:
        raise ValueError(f"line_breaks must be one of {LINE_BREAKS}, not {line_breaks!r}")
    return line_breaks == "escaped"


def csv_escape_exprs(schema: T.StructType, line_breaks: str = "quoted") -> list[str]:
    """Select list that escapes text columns before a CSV write."""
    esc = CSV_ESCAPE.replace("\\", "\\\\")
    if _known(line_breaks):
        return _text_exprs(schema, lambda c: f"replace(replace(replace({c}, '{esc}', '{esc}{esc}'), '\\n', '{esc}n'), '\\r', '{esc}r')")
    return _text_exprs(schema, lambda c: f"CASE WHEN startswith({c}, '{esc}') THEN concat('{esc}', {c}) ELSE {c} END")


def csv_unescape_exprs(schema: T.StructType, line_breaks: str = "quoted") -> list[str]:
    """Select list that undoes ``csv_escape_exprs`` after a CSV read."""
    esc = CSV_ESCAPE.replace("\\", "\\\\")
    if _known(line_breaks):  # cut at the doubled ones, so that what follows one is not taken for an escape
        def whole(c: str) -> str:
            breaks = f"replace(replace(x, '{esc}n', '\\n'), '{esc}r', '\\r')"
            return f"array_join(transform(split({c}, '{esc * 4}', -1), x -> {breaks}), '{esc}')"
        return _text_exprs(schema, lambda c: f"CASE WHEN contains({c}, '{esc}') THEN {whole(c)} ELSE {c} END")
    n = len(CSV_ESCAPE) + 1
    return _text_exprs(schema, lambda c: f"CASE WHEN startswith({c}, '{esc}') THEN substr({c}, {n}) ELSE {c} END")


def table_path(directory: str, name: str = "") -> str:
    """``<directory>/<name>`` without a trailing slash."""
    path = f"{directory.rstrip('/')}/{name}" if name else directory
    return path.rstrip("/")


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read Parquet, optionally with a declared schema.

    With a schema, partition values are typed by it (``'01'`` stays a
    string, no inference), a declared column missing from the files reads
    as NULL, and columns come back in declared order (Spark puts partition
    columns last).
    """
    if schema is None:
        return spark.read.parquet(path)
    return select_in_schema_order(spark.read.schema(schema).parquet(path), schema)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool | None = None,
             strict: bool = True, line_breaks: str = "quoted") -> DataFrame:
    """Read CSV written by ``write_csv`` with its declared schema.

    Files written with ``line_breaks="escaped"`` are read with the same
    setting: a record is one line, and large files are split between tasks.
    Otherwise:

    ``multi_line`` is needed for quoted line breaks; each file is then parsed
    by one task, which ``write_csv`` bounds by writing one file per task.
    Data known to hold no line breaks can pass ``multi_line=False`` so that
    large files are split between tasks. A value that does not read as its
    declared type fails the job; with ``strict=False`` it becomes NULL.
    """
    if multi_line is None:
        multi_line = not _known(line_breaks)
    df = (spark.read.schema(schema).options(**CSV_OPTIONS)
          .option("multiLine", str(multi_line).lower())
          .option("mode", "FAILFAST" if strict else "PERMISSIVE")
          .option("enforceSchema", "false")  # header must name the declared columns, in order
          .csv(path))
    return df.selectExpr(*csv_unescape_exprs(schema, line_breaks))
