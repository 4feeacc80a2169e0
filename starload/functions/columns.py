"""Column expressions shared by the operators. All are built-in Spark
functions. Plans of up to ``spark.sql.codegen.maxFields`` columns compile to
one loop; wider ones, such as the 121-column table, run operator by operator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The form of a hash-key part. A NULL part is the marker; any
# other part is "<character length>:<text>"; parts are joined by the separator.
KEY_NULL_MARKER = "~"
KEY_SEPARATOR = "|"


def quoted(name: str) -> str:
    """Backquote a column name so spaces and dots are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def scratch_column(df: DataFrame) -> str:
    """A column name that the frame does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    return next(n for n in (f"__c{i}" for i in range(len(taken) + 1)) if n not in taken)


def sql_type(data_type: T.DataType) -> str:
    """Spark SQL text of a data type, with nested field names quoted."""
    if isinstance(data_type, T.StructType):
        fields = ",".join(f"{quoted(f.name)}:{sql_type(f.dataType)}" for f in data_type.fields)
        return f"struct<{fields}>"
    if isinstance(data_type, T.ArrayType):
        return f"array<{sql_type(data_type.elementType)}>"
    if isinstance(data_type, T.MapType):
        return f"map<{sql_type(data_type.keyType)},{sql_type(data_type.valueType)}>"
    return data_type.simpleString()


def key_part(col: Column) -> Column:
    """Text form of one key part that keeps NULL apart from every value."""
    text = col.cast("string")
    return F.when(text.isNull(), F.lit(KEY_NULL_MARKER)).otherwise(
        F.concat(F.length(text).cast("string"), F.lit(":"), text))


def hash_key(columns: Sequence[str | Column]) -> Column:
    """Deterministic 128-bit key (md5 hex) over natural-key columns.

    NULL-safe and unambiguous: ``(a, NULL)`` and ``(NULL, a)`` differ, and a
    separator inside a value cannot shift part boundaries because every part
    carries its length.
    """
    cols = [F.col(quoted(c)) if isinstance(c, str) else c for c in columns]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *[key_part(c) for c in cols]))


def hash_key_sql(columns: Sequence[str]) -> str:
    """The same key as ANSI SQL text, for databases that hold such tables."""
    parts = []
    for c in columns:
        t = f"cast({c} as varchar)"
        parts.append(f"case when {t} is null then '{KEY_NULL_MARKER}' "
                     f"else concat(cast(length({t}) as varchar), ':', {t}) end")
    return f"md5(concat_ws('{KEY_SEPARATOR}', {', '.join(parts)}))"
