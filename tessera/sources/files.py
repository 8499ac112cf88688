"""File sources and sinks: CSV with a declared schema, table description, inventory, guards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tessera.sources import quoted_csv

# Text forms of non-finite doubles as written by common CSV producers.  Spark's
# defaults are 'Inf'/'-Inf'/'NaN' and would silently read 'inf' as NULL.
CSV_OPTIONS = {
    "header": "true",
    "positiveInf": "inf",
    "negativeInf": "-inf",
    "nanValue": "nan",
    "dateFormat": "yyyy-MM-dd",
    "mode": "FAILFAST",
    # RFC 4180: a quote inside quotes is doubled, and a quoted text may hold line breaks.
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             sampling_ratio: float = 1.0, line_breaks: bool = True) -> DataFrame:
    """Read CSV with a header, in as many tasks as the files have splits.

    Pass ``schema`` for production reads.  Without it the header names the columns, and one
    more pass finds the least type that holds all texts of each (of a ``sampling_ratio``
    fraction of the rows).  ``line_breaks``: quoted texts may hold line breaks; records are
    then told by quote parity, which takes one more pass over the lines.  Without them every
    line is a record and the pass is saved.
    """
    plain = CSV_OPTIONS | {"multiLine": "false"}

    def read(kind: T.StructType | str) -> DataFrame:
        return quoted_csv.parsed(spark, path, kind, plain) if line_breaks else spark.read.options(**plain).schema(kind).csv(path)

    if schema is None:
        names = spark.read.options(**CSV_OPTIONS).csv(path).columns
        texts = read(T.StructType([T.StructField(c, T.StringType()) for c in names]))
        schema = quoted_csv.least_types(texts if sampling_ratio >= 1 else texts.sample(sampling_ratio, seed=7))
    return read(schema)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none", rows_per_file: int = 0) -> None:
    """Write CSV with a header; non-finite doubles as 'inf'/'-inf'/'nan'.

    ``compression`` packs each file, of at most ``rows_per_file`` rows (0: any number); a packed file is one split.
    """
    out = df
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.col(f.name)
            out = out.withColumn(
                f.name,
                F.when(F.isnan(c), F.lit("nan"))
                .when(c == F.lit(float("inf")), F.lit("inf"))
                .when(c == F.lit(float("-inf")), F.lit("-inf"))
                .otherwise(c.cast("string")),
            )
    out.write.mode(mode).options(header="true", quote='"', escape='"', compression=compression, maxRecordsPerFile=rows_per_file).csv(path)


_TYPE_NAMES = {
    "bigint": "bigint",
    "int": "int",
    "smallint": "smallint",
    "tinyint": "tinyint",
    "double": "double",
    "float": "float",
    "string": "string",
    "date": "date",
    "boolean": "boolean",
    "timestamp": "timestamp",
    "timestamp_ntz": "timestamp",
}


def describe(spark: SparkSession, df: DataFrame) -> DataFrame:
    """(ordinal, column_name, column_type) of a source, one row per column."""
    rows = [
        (i + 1, f.name, _TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString()))
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(rows, "ordinal int, column_name string, column_type string")


def width(spark: SparkSession, df: DataFrame) -> DataFrame:
    """One row: number of columns of a source."""
    return spark.createDataFrame([(len(df.columns),)], "n_columns int")


def file_inventory(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """(relative_path, size_mb) of every file under ``root`` matching ``pattern``.

    Uses the binaryFile source with only path and length selected, so file
    contents are never read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length")
    )
    # The part of the path after the root, by position: the root is text, not a pattern.
    prefix = root.rstrip("/") + "/"
    rel = F.expr("substring(path, instr(path, prefix) + length(prefix))")
    files = files.withColumn("prefix", F.lit(prefix))
    return files.select(rel.alias("relative_path"), (F.col("length") / (1024 * 1024)).alias("size_mb")).orderBy(
        "relative_path"
    )


def require_path(spark: SparkSession, path: str, hint: str) -> DataFrame:
    """Open a Parquet path or fail with an actionable message."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        raise FileNotFoundError(f"{path} not found or unreadable. {hint}") from exc


def require_table(spark: SparkSession, name: str, hint: str) -> DataFrame:
    if not spark.catalog.tableExists(name):
        raise LookupError(f"table {name!r} does not exist. {hint}")
    return spark.table(name)
