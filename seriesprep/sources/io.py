"""Delimited text, Parquet and JSON in and out."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from seriesprep.functions.scalars import col, nan_to_null, quoted
from seriesprep.operators.cleaning import dedup_first, drop_null_timestamp, parse_timestamp
from seriesprep.spec import SeriesSpec, safe_names

# Texts that count as missing, beside the empty field.
MISSING_TOKENS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _header(spark: SparkSession, path: str, sep: str) -> list[str]:
    """Names in the first line, quotes observed; a nameless column is ``Unnamed: i``, a repeated name gets a number."""
    line = spark.read.text(path).first()
    if not line:
        return []
    fields = next(csv.reader([line[0].lstrip("\ufeff")], delimiter=sep), [])
    names: list[str] = []
    for i, field in enumerate(fields):
        name = field if field.strip() else f"Unnamed: {i}"
        again = sum(n == name or n.startswith(f"{name}.") for n in names) if name in names else 0
        names.append(f"{name}.{again}" if again else name)
    return names


def read_delimited(
    spark: SparkSession, path: str, sep: str = ";", na: Sequence[str] = MISSING_TOKENS
) -> DataFrame:
    """Header text file as string columns, missing tokens as null.

    The file is read with an explicit all-string schema, so there is no inference pass and
    no value is lost; comma decimals become numbers in ``coerce_numeric``.
    """
    names = _header(spark, path, sep)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = spark.read.csv(path, schema=schema, sep=sep, header=True, enforceSchema=True)
    return missing_tokens_to_null(raw, na)


def missing_tokens_to_null(df: DataFrame, na: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """Null every text field that holds nothing but a missing token."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({
        n: F.when(~F.trim(col(n)).isin(*na, ""), col(n)) for n in text
    })


def drop_empty_columns(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Drop columns whose non-null values are all blank (or that have none); one aggregate."""
    names = df.columns
    if not names:
        return df, []
    filled = df.agg(*[
        F.max(F.length(F.trim(col(n).cast("string")))).alias(f"_{i}") for i, n in enumerate(names)
    ]).first()
    empty = [n for i, n in enumerate(names) if not filled[i]]
    return df.select(*[quoted(n) for n in names if n not in empty]), empty


def normalize_names(df: DataFrame, safe: bool = False) -> tuple[DataFrame, dict[str, str]]:
    """Strip header blanks; with ``safe`` map to identifiers. The second value maps old to new."""
    mapping = safe_names(df.columns) if safe else {n: n.strip() for n in df.columns}
    return df.toDF(*[mapping[n] for n in df.columns]), mapping


def order_columns(df: DataFrame, preferred: Sequence[str]) -> DataFrame:
    """The preferred columns that exist, then all others in their order."""
    first = [n for n in preferred if n in df.columns]
    return df.select(*[quoted(n) for n in first + [n for n in df.columns if n not in first]])


def _load(spark: SparkSession, path: str) -> DataFrame:
    if path.lower().endswith(".parquet"):
        return spark.read.parquet(path)
    if path.lower().endswith(".csv"):
        return spark.read.csv(path, header=True, inferSchema=True)
    for suffix in (".parquet", ".csv"):
        try:
            return _load(spark, path + suffix)
        except AnalysisException:
            continue
    raise FileNotFoundError(f"no table at {path} (.parquet or .csv)")


def read_table(
    spark: SparkSession, path: str, spec: SeriesSpec, schema: T.StructType | None = None
) -> DataFrame:
    """A Parquet or CSV table with a usable time key: parsed, without null or repeated times.

    ``schema`` spares the inference pass over a CSV. NaN becomes null here and nowhere else.
    Rows keep no order in a Spark table; whoever needs time order gets it from its window.
    """
    if schema is not None and path.lower().endswith(".csv"):
        df = spark.read.csv(path, header=True, schema=schema)
    else:
        df = _load(spark, path)
    return prepare_table(df, spec)


def prepare_table(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """What ``read_table`` does to a loaded frame."""
    if spec.ts not in df.columns:
        raise ValueError(f"the table has no time column {spec.ts!r}")
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if floats:
        df = df.withColumns({n: nan_to_null(col(n)) for n in floats})
    return dedup_first(drop_null_timestamp(parse_timestamp(df, spec.ts), spec), spec)


def write_table(
    df: DataFrame,
    base: str,
    fmt: str = "parquet",
    spec: SeriesSpec | None = None,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> list[str]:
    """Write ``base``.parquet and/or .csv (``both``), or .json; returns the paths.

    With a ``spec`` files hold disjoint time ranges in time order, so a time filter on the
    written table skips files.
    """
    formats = {"both": ("parquet", "csv")}.get(fmt, (fmt,))
    unknown = set(formats) - {"parquet", "csv", "json"}
    if unknown:
        raise ValueError(f"unknown format {fmt!r}")
    if spec is not None:
        keys = [*partition_by, *spec.by, spec.ts]
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    paths = []
    for f in formats:
        path = f"{base}.{f}"
        writer = df.write.mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.csv(path, header=True) if f == "csv" else getattr(writer, f)(path)
        paths.append(path)
    return paths
