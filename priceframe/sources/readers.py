"""Sources: fact CSV with an explicit schema, wide year/snapshot matrices, multi-part snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import FACT_SCHEMA, POP_SNAPSHOT_YEARS, key_column, snapshot_columns, year_columns
from .writers import sink_parquet


def scan_facts(spark: SparkSession, path: str, schema: T.StructType | None = FACT_SCHEMA,
               fmt: str = "csv", corrupt_column: str | None = None, header: bool = True) -> DataFrame:
    """Fact file(s) with a declared schema (no inference pass); malformed cells become null.

    ``schema=None`` reads every column as text, for files whose layout is unknown.
    ``corrupt_column`` (with a schema) keeps the raw text of malformed lines in
    that column instead of silently nulling them.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", header).option("mode", "PERMISSIVE")
    if schema is not None:
        if corrupt_column:
            schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
            reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        reader = reader.schema(schema)
    return reader.load(path)


def scan_split(spark: SparkSession, path: str, schema: T.StructType, out: str,
               corrupt_column: str = "_corrupt", header: bool = True) -> tuple[DataFrame, DataFrame, dict]:
    """CSV files in one pass into accepted rows and quarantined lines: (accepted, lines, counts).

    A line that does not fit ``schema`` is written to the quarantine as its raw
    text, any other to the accepted rows; both stand under ``out``.  ``counts``
    has ``accepted`` and ``rejected``, observed while writing.
    """
    rows = scan_facts(spark, path, schema, corrupt_column=corrupt_column, header=header)
    bad = F.col(corrupt_column).isNotNull()
    counts = sink_parquet(rows.withColumn("rejected", bad.cast("int")), out, partition_by=["rejected"], observe=[
        F.count_if(~bad).alias("accepted"), F.count_if(bad).alias("rejected")])
    whole = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType()), T.StructField("rejected", T.IntegerType())])
    back = spark.read.schema(whole).parquet(out)
    return (back.filter("rejected = 0").drop("rejected", corrupt_column),
            back.filter("rejected = 1").select(F.col(corrupt_column).alias("line")), counts)


def scan_wide_years(spark: SparkSession, path: str, key_name: str = "country_name") -> tuple[DataFrame, list[str]]:
    """Wide CSV: first column = key, all-digit headers = years. All cells read as text."""
    df = spark.read.option("header", True).csv(path)
    first = df.columns[0]
    years = year_columns(df.columns[1:])
    return df.withColumnRenamed(first, key_name), years


def scan_wide_snapshots(spark: SparkSession, path: str, years=POP_SNAPSHOT_YEARS) -> tuple[DataFrame, str, dict[int, str]]:
    """Wide snapshot CSV: trimmed headers, the code column and the ``<year> … pop`` columns.

    Raises if either role is missing.  Returns (frame of key + snapshot columns, key, {year: header}).
    """
    df = spark.read.option("header", True).csv(path)
    df = df.toDF(*[c.strip() for c in df.columns])
    key = key_column(df.columns)
    cols = snapshot_columns(df.columns, years)
    return df.select(f"`{key}`", *[f"`{c}`" for c in cols.values()]), key, cols


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check on the cluster file system (a metadata call on the driver)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def scan_multipart(spark: SparkSession, snapshot: str, raw: str, fmt: str = "csv",
                   schema: T.StructType | None = None) -> DataFrame:
    """All part files of a written snapshot (one read of the folder); the raw file if there is none."""
    path = snapshot if path_exists(spark, snapshot) else raw
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)
