"""File sources and sinks (IO1-IO9)."""

from __future__ import annotations

import os
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.exprs import finite, standard_name


class DataFileError(FileNotFoundError):
    pass


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath) or bool(fs.globStatus(hpath))


# IO1
def load_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
             check_empty: bool = True) -> DataFrame:
    """CSV with a header; every column read as text (coercion is a cleaning
    step). ``columns`` fixes the schema so no inference pass runs."""
    if not _exists(spark, path):
        raise DataFileError(f"CSV file not found: {path}")
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    else:
        reader = reader.option("inferSchema", False)
    df = reader.csv(path)
    if check_empty and df.isEmpty():
        raise ValueError(f"CSV file is empty: {path}")
    return df


# IO2
class DatasetCatalog:
    """Named datasets (raw, cleaned, train, test, anomaly, forecast, ...) ->
    location and format; one place instead of one loader per name."""

    def __init__(self, spark: SparkSession, entries: dict[str, tuple[str, str]]):
        self.spark = spark
        self.entries = dict(entries)

    def register(self, name: str, path: str, fmt: str = "parquet") -> None:
        self.entries[name] = (path, fmt)

    def load(self, name: str) -> DataFrame:
        if name not in self.entries:
            raise KeyError(f"unknown dataset {name!r}; known: {sorted(self.entries)}")
        path, fmt = self.entries[name]
        if fmt == "csv":
            return load_csv(self.spark, path)
        if not _exists(self.spark, path):
            raise DataFileError(f"dataset {name!r} not found at {path}")
        return self.spark.read.format(fmt).load(path)


# IO3
METRICS_SCHEMA = T.StructType([T.StructField("model_name", T.StringType()),
                               T.StructField("asset", T.StringType()),
                               T.StructField("metric", T.StringType()),
                               T.StructField("value", T.DoubleType())])


def load_metrics(spark: SparkSession, path: str, multi_line: bool = False) -> tuple[str, DataFrame]:
    """Metrics kept as a long table (model_name, asset, metric, value), from
    JSON lines (``multi_line=True``: one JSON document per file).
    Missing or unreadable -> ('missing'|'invalid', empty table)."""
    empty = spark.createDataFrame([], METRICS_SCHEMA)
    if not _exists(spark, path):
        return "missing", empty
    schema = T.StructType([*METRICS_SCHEMA.fields, T.StructField("_corrupt_record", T.StringType())])
    df = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    bad, named = df.agg(F.count("_corrupt_record"), F.count("metric")).first()
    if bad and not named:
        return "invalid", empty
    return "available", df.where(F.col("_corrupt_record").isNull()).select(*METRICS_SCHEMA.names)


# IO4
RECORD_SCHEMA = T.ArrayType(T.StructType([T.StructField("date", T.StringType()),
                                          T.StructField("asset", T.StringType()),
                                          T.StructField("price", T.DoubleType())]))


def records_to_frame(df: DataFrame, column: str) -> DataFrame:
    """A column of JSON record lists (``[{date, asset, price}, ...]``) or
    single records -> one row per record."""
    txt = F.trim(F.col(column))
    as_list = F.when(txt.startswith("["), txt).otherwise(F.concat(F.lit("["), txt, F.lit("]")))
    return df.select(F.explode(F.from_json(as_list, RECORD_SCHEMA)).alias("_r")).select("_r.*")


# IO5
def save_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
               allow_empty: bool = False) -> str:
    if not allow_empty and df.isEmpty():
        raise ValueError("refusing to write an empty table")
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


# IO6
def json_safe(df: DataFrame) -> DataFrame:
    """Dates/timestamps -> ISO text, NaN/+-inf -> null."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = finite(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def to_json_records(df: DataFrame) -> DataFrame:
    return json_safe(df).select(F.to_json(F.struct("*")).alias("record"))


# IO7
def write_summary(df: DataFrame, path: str, fmt: str = "json") -> str:
    """Already-aggregated, small result -> one file."""
    df.coalesce(1).write.mode("overwrite").format(fmt).option("header", True).save(path)
    return path


# IO8
def ragged_union(frames: Sequence[DataFrame], preferred: Sequence[str] = ()) -> DataFrame:
    """Union by name; the header is the preferred columns first, then the
    remaining columns in first-seen order."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    head = [c for c in preferred if c in out.columns]
    return out.select(*head, *[c for c in out.columns if c not in head])


# IO9
def save_state(tables: dict[str, DataFrame], root: str) -> str:
    """Fitted parameters (fences, moments, trees, coefficients) as Parquet."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(os.path.join(root, standard_name(name)))
    return root


def load_state(spark: SparkSession, root: str, names: Sequence[str]) -> dict[str, DataFrame]:
    out = {}
    for name in names:
        p = os.path.join(root, standard_name(name))
        if not _exists(spark, p):
            raise DataFileError(f"saved state {name!r} missing at {p}")
        out[name] = spark.read.parquet(p)
    return out
