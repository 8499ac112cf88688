"""Quoted CSV read in parallel: records are told by quote parity, not by a task that reads from the start.

A quoted text may hold line breaks (RFC 4180), so whether a line begins a record depends on
the number of quotes before it.  Lines are read by splits of the file.  A first pass counts
the quotes of each split; prefix sums over a file's splits tell in which state each begins.
A split that begins outside quotes, and in which every line closes what it opens, holds one
record a line.  Only in the others are lines joined: a line that begins inside quotes goes to
the last line that began outside, which may stand in an earlier split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.joins import broadcast_if_small
from tessera.session import work_dir

SPLIT = ["file", "block"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines: their split, and a number that grows within it."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    meta = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    return spark.read.option("lineSep", "\n").text(path).select("value", *meta, F.monotonically_increasing_id().alias("at")).withColumn("quotes", quotes)


def splits(lines: DataFrame) -> DataFrame:
    """(file, block, state, open, first_at) for each split.  ``state``: 1 if it begins inside quotes;
    ``open``: it does, or a line in it opens a text that it does not close."""
    found = lines.groupBy(*SPLIT).agg((F.sum("quotes") % 2).alias("odd"), F.max(F.col("quotes") % 2).alias("breaks"), F.min("at").alias("first_at"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each split of a file
    state = F.coalesce(F.sum("odd").over(before) % 2, F.lit(0))
    return found.withColumn("state", state).select(*SPLIT, "state", ((F.col("state") == 1) | (F.col("breaks") == 1)).alias("open"), "first_at")


def _joined(lines: DataFrame) -> DataFrame:
    """(file, block, at, record) of the records that begin in open splits."""
    upto = Window.partitionBy(*SPLIT).orderBy("at")
    before = (F.col("state") + F.coalesce(F.sum("quotes").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) % 2
    told = lines.withColumn("before", before).withColumn("start", F.when(F.col("before") == 0, F.struct("block", "at")))
    told = told.withColumn("own", F.last("start", ignorenulls=True).over(upto.rowsBetween(Window.unboundedPreceding, 0)))
    whole = (F.col("before") == 0) & (F.col("quotes") % 2 == 0)
    # The record that an earlier split leaves open.
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = told.groupBy(*SPLIT).agg(F.max("start").alias("start"))
    carried = last.select(*SPLIT, F.last("start", ignorenulls=True).over(earlier).alias("carried"))
    parts = told.filter(~whole).join(carried, SPLIT).withColumn("first", F.coalesce("own", "carried"))
    lines_of = F.sort_array(F.collect_list(F.struct("block", "at", "value")))  # one record's lines
    several = parts.groupBy("file", "first").agg(F.array_join(F.transform(lines_of, lambda x: x["value"]), "\n").alias("record"))
    return told.filter(whole).select(*SPLIT, "at", F.col("value").alias("record")).unionAll(several.select("file", "first.block", "first.at", "record"))


def records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """One row per record (column ``record``), blank lines and each file's header left out.

    Read the result under the same split size (``spark.sql.files.maxPartitionBytes``): a
    changed one raises an error.  Quotes may only enclose fields; a line that holds a stray
    quote outside quoted fields is not RFC 4180.
    """
    lines = _lines(spark, path)
    work_dir(spark)  # registers the checkpoint folder
    found = splits(lines).checkpoint(eager=True)  # a row for each split
    some_open = found.filter("open").limit(1).count() > 0
    n = found.count()
    changed = F.raise_error(F.lit("the split size has changed since the CSV was opened"))
    told = lines.join(broadcast_if_small(found, n), SPLIT, "left").withColumn("open", F.when(F.col("open").isNull(), changed.cast("boolean")).otherwise(F.col("open")))
    first = F.lit(header) & (F.col("block") == 0) & (F.col("at") == F.col("first_at"))
    # What is left out becomes null and is dropped last: a filter on parsed columns, which Spark may
    # push down, then never parses a header or a line that is not a record.
    out = told.select(F.when(~first & ~F.col("open"), F.col("value")).alias("record"))
    if some_open:
        joined = _joined(told.filter("open"))
        if header:
            heads = found.filter("block = 0").select("file", F.lit(0).cast("long").alias("block"), F.col("first_at").alias("at"), F.lit(True).alias("head"))
            joined = joined.join(broadcast_if_small(heads, n), ["file", "block", "at"], "left").withColumn("record", F.when(F.col("head").isNull(), F.col("record")))
        out = out.unionAll(joined.select("record"))
    text = F.regexp_replace("record", "\r$", "")
    return out.select(F.when(text != "", text).alias("record")).filter("record is not null")


def _ddl(spark: SparkSession, schema: T.StructType | str) -> str:
    if isinstance(schema, str):
        return schema
    return spark._jvm.org.apache.spark.sql.types.DataType.fromJson(schema.json()).toDDL()


def parsed(spark: SparkSession, path: str, schema: T.StructType | str, options: dict[str, str]) -> DataFrame:
    """The records of ``path`` with the declared ``schema``; columns go by position."""
    own = {k: v for k, v in options.items() if k not in ("header", "multiLine")}
    rows = records(spark, path, options.get("header") == "true")
    return rows.select(F.from_csv("record", _ddl(spark, schema), own).alias("r")).select("r.*")


# --- types ------------------------------------------------------------------------

#: The lattice: a column's type is the least one that holds all its texts.  Numbers widen within
#: 0-2, days within 10-11; anything else together is text.
_LEVELS = {0: "int", 1: "bigint", 2: "double", 10: "date", 11: "timestamp", 20: "boolean", 30: "string"}


def _level(c: Column) -> Column:
    number = c.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$") | c.isin("inf", "-inf", "nan")
    whole = c.rlike(r"^[+-]?\d+$")
    return (
        F.when(whole & c.try_cast("int").isNotNull(), 0)
        .when(whole & c.try_cast("bigint").isNotNull(), 1)
        .when(number, 2)
        .when(c.rlike(r"^\d{4}-\d{2}-\d{2}$") & c.try_cast("date").isNotNull(), 10)
        .when(c.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?$") & c.try_cast("timestamp").isNotNull(), 11)
        .when(F.lower(c).isin("true", "false"), 20)
        .when(c.isNotNull(), 30)
    )


def least_types(texts: DataFrame) -> T.StructType:
    """The least type of each text column: two mergeable aggregates a column, one pass over all rows."""
    names = texts.columns
    row = texts.select(*[_level(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(names)]).agg(
        *[f(f"c{i}").alias(f"{k}{i}") for i in range(len(names)) for k, f in (("lo", F.min), ("hi", F.max))]).first()
    fields = []
    for i, c in enumerate(names):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        level = 30 if lo is None or (lo // 10 != hi // 10) else hi
        fields.append(T.StructField(c, T._parse_datatype_string(_LEVELS[level])))
    return T.StructType(fields)
