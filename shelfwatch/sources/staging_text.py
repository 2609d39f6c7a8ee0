"""Tab-separated staging files, one line per row, ``\\N`` for null.

Lines are cut and joined by plain string functions rather than a CSV dialect: quotes have no meaning here and
a backslash is written twice, which CSV readers do not undo.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.functions.scalars import normalise_text
from shelfwatch.tables import TableSpec

# Field separator, null marker, time format of the files.
SEPARATOR = "\t"
NULL_FIELD = "\\N"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.S"


def _encode(field: T.StructField) -> Column:
    value = F.col(field.name)
    if isinstance(field.dataType, T.TimestampType):
        text = F.date_format(value, TIME_FORMAT)
    elif isinstance(field.dataType, T.StringType):
        text = F.replace(normalise_text(value), F.lit("\\"), F.lit("\\\\"))
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit(NULL_FIELD))


def _decode(raw: Column, field: T.StructField) -> Column:
    text = F.when(raw != NULL_FIELD, F.replace(raw, F.lit("\\\\"), F.lit("\\")))
    return text.cast(field.dataType).alias(field.name)


def to_lines(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.select(F.concat_ws(SEPARATOR, *[_encode(f) for f in spec.staging.fields]).alias("value"))


def write_staging_text(df: DataFrame, spec: TableSpec, path: str) -> None:
    """Append, as repeated loads of a run do; the import absorbs repeats."""
    to_lines(df, spec).write.mode("append").text(path)


def from_lines(lines: DataFrame, spec: TableSpec) -> DataFrame:
    fields = F.split("value", SEPARATOR, -1)
    return lines.select(
        [_decode(fields.getItem(i), f) for i, f in enumerate(spec.staging.fields)]
    )


def checked_lines(
    lines: DataFrame, spec: TableSpec, keep: Callable[[DataFrame], DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows of the lines that are rows, and the other lines with a ``reason``: the number of fields, or the first bad one.

    ``keep`` may write the checked lines, so that both are read from there and no line is cut again.
    """
    fields = spec.staging.fields
    cut = lines.select("value", F.split("value", SEPARATOR, -1).alias("_fields"))

    def value(i: int, field: T.StructField) -> Column:
        raw = F.get("_fields", F.lit(i))
        return F.when(raw != NULL_FIELD, F.replace(raw, F.lit("\\\\"), F.lit("\\"))).try_cast(field.dataType)

    values = {f.name: value(i, f) for i, f in enumerate(fields)}
    bad = [
        F.when((F.get("_fields", F.lit(i)) != NULL_FIELD) & values[f.name].isNull(), F.lit(f"bad {f.name}")) for i, f in enumerate(fields)
    ]
    count = F.when(F.size("_fields") != len(fields), F.concat(F.size("_fields").cast("string"), F.lit(" fields")))
    row = F.struct(*[v.alias(n) for n, v in values.items()]).alias("row")
    checked = cut.select("value", F.coalesce(count, *bad).alias("reason"), row)
    if keep:
        # The text of a row is not asked for again.
        checked = keep(checked.withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value"))))
    return (
        checked.where("reason IS NULL").select("row.*"),
        checked.where("reason IS NOT NULL").select("value", "reason"),
    )


def read_staging_text(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    return from_lines(spark.read.option("lineSep", "\n").text(path), spec)


def stored_catalogs(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """Catalogs of a run, read back from its staging file."""
    return read_staging_text(spark, spec, path).select("shard", "query").distinct()
