"""Typed CSV scan (S1), schema check (S3) and CSV / Parquet sinks."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .. import config
from ..functions.text import sql_ref
from ..operators.normalise import null_sentinels
from .split_csv import csv_records


def load_nulls() -> list[str]:
    """Strings a CSV load treats as missing: the job's sentinels plus the
    pandas defaults (exact match, no stripping)."""
    seen, out = set(), []
    for s in config.NULL_STRINGS + config.PANDAS_DEFAULT_NA:
        if s not in seen:
            seen.add(s)
            out.append(s)
    return out


def validate_schema(df: DataFrame, required=None) -> DataFrame:
    """S3: raise when required columns are missing (extra columns allowed)."""
    required = config.REQUIRED_COLUMNS if required is None else required
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"input is missing required columns: {missing}")
    return df


def apply_load_types(df: DataFrame, numeric=("latitude", "longitude")) -> DataFrame:
    """Null the load sentinels on text, then ``try_cast`` numeric columns; a
    numeric column that is double already has its NaN nulled."""
    df = null_sentinels(df, load_nulls(), [c for c in df.columns if c not in numeric])
    casts = {}
    for c in numeric:
        if c in df.columns and isinstance(df.schema[c].dataType, DoubleType):
            casts[c] = F.when(~F.isnan(c), F.col(c))
        elif c in df.columns:
            v = F.when(~F.col(c).cast("string").isin(load_nulls()), F.col(c).cast("string"))
            casts[c] = v.try_cast("double")
    return df.withColumns(casts) if casts else df


_BEYOND = "__beyond_header"
_PLACE = "__place"


def _parsed(records: DataFrame, schema: StructType, header) -> DataFrame:
    """Records (text) through Spark's CSV parser; a file whose header is not ``header`` raises."""
    text = F.when(F.col("header"), F.ltrim(F.col("text"), F.lit("\ufeff"))).otherwise(F.col("text"))
    cells = F.from_csv(text, ", ".join(f"{sql_ref(f.name)} string" for f in schema.fields), {"quote": '"', "escape": '"', "multiLine": "true"})
    df = records.select("header", F.struct("file", "start", "seq").alias(_PLACE), cells.alias("c"))
    first = [str(c).lstrip("\ufeff") if c is not None else None for c in header]
    same = [F.col("c").getField(f.name).eqNullSafe(F.lit(c)) for f, c in zip(schema.fields, [*first, None])]
    other = F.raise_error(F.lit("a CSV file has another header than the first"))
    df = df.filter(F.when(~F.col("header"), True).when(reduce(and_, same), False).otherwise(other.cast("boolean")))
    return df.select(_PLACE, *[F.col("c").getField(f.name).alias(f.name) for f in schema.fields])


def read_csv(
    spark: SparkSession,
    path: str,
    columns=None,
    numeric=("latitude", "longitude"),
    multi_line: bool = True,
    position: str | None = None,
    split: bool = False,
) -> DataFrame:
    """CSV with a header, every column read as text (leading zeros kept),
    quoted cells and doubled quotes as in RFC 4180, sentinels nulled, numeric
    columns cast. Missing path raises. Rows with fewer cells than the header are
    padded with nulls; rows with more raise.

    ``multi_line=False`` is for files whose cells hold no line break: Spark can
    then split a file over tasks. ``split`` splits files over tasks although
    their cells hold line breaks (RFC 4180 only, see :mod:`.split_csv`; some
    passes over the files run at once), and raises where the files' headers
    differ. ``position`` names a column that orders rows as they stand in the
    file(s), for ``order_by`` of the merges.
    """
    columns = config.REQUIRED_COLUMNS if columns is None else columns
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line)
    header = reader.option("inferSchema", False).csv(path).columns
    schema = StructType([StructField(c, StringType()) for c in [*header, _BEYOND]])
    records = csv_records(spark, path) if split else None
    if records is None:
        df = reader.option("mode", "PERMISSIVE").schema(schema).csv(path)
        place = [F.col("_metadata.file_path"), F.lpad(F.col("_metadata.file_block_start").cast("string"), 20, "0")]
        place.append(F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0"))
    else:
        df = _parsed(records, schema, reader.option("header", False).csv(path).head())
        place = [F.col(f"{_PLACE}.file"), *[F.lpad(F.col(f"{_PLACE}.{c}").cast("string"), 20, "0") for c in ("start", "seq")]]
    fits = F.when(F.col(_BEYOND).isNull(), True).otherwise(F.raise_error(F.lit("a CSV row has more cells than the header")))
    df = df.filter(fits.cast("boolean"))
    names = list(header)
    if position:
        df = df.withColumn(position, F.concat_ws("#", *place))
        names.append(position)
    return validate_schema(apply_load_types(df.select(*names), numeric), columns)


def write_csv(df: DataFrame, path: str) -> None:
    """Header, UTF-8, overwrite; nulls and '' both as empty cells;
    blanks around values are kept (Spark's writer trims them by default).
    Output is a directory of part files (no coalesce to one task)."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
