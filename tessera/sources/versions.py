"""Create-or-replace of a named table: whole versions, published by one pointer.

``<root>/data-<id>/`` holds a version's files, written in full before anybody can see them.
``<root>/_versions/<number>.json`` names it; the greatest number is the current version.  A
pointer is written under another name and renamed, never over an existing one (the shared
file system refuses the second), so of two writers of one number one goes on to the next.
A reader takes the pointer once and reads that version's files, whatever is published
meanwhile.  :func:`publish_name` puts a catalog table on top, whose place is the version's.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

DIGITS = 12


@dataclass(frozen=True)
class Version:
    number: int
    path: str
    #: What the writer recorded: row counts, columns or whatever describes the version.
    info: dict = field(default_factory=dict)


class _Folder:
    """The few file-system calls that publishing needs, through the file system of ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.gateway = spark.sparkContext._gateway
        jvm = spark._jvm.org.apache.hadoop.fs
        self.jvm, self.utils = jvm, spark._jvm.org.apache.commons.io.IOUtils
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = jvm.Path(root)
        self.fs = self.root.getFileSystem(conf)
        self.context = jvm.FileContext.getFileContext(self.fs.makeQualified(self.root).toUri(), conf)
        self.pointers = jvm.Path(self.root, "_versions")

    def numbers(self) -> list[int]:
        if not self.fs.exists(self.pointers):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(self.pointers)]
        return sorted(int(n[:DIGITS]) for n in names if n.endswith(".json") and n[:DIGITS].isdigit())

    def pointer(self, number: int):
        return self.jvm.Path(self.pointers, f"{number:0{DIGITS}d}.json")

    def read(self, number: int) -> dict:
        stream = self.fs.open(self.pointer(number))
        try:
            return json.loads(self.utils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def add(self, number: int, said: dict) -> bool:
        """Whether the pointer is now there by this call."""
        draft = self.jvm.Path(self.pointers, f"_draft-{uuid.uuid4().hex}")
        stream = self.fs.create(draft, False)
        stream.write(bytearray(json.dumps(said).encode()))
        stream.close()
        rename = getattr(self.jvm, "Options$Rename")
        options = self.gateway.new_array(rename, 1)
        options[0] = rename.NONE  # never over an existing pointer: the rename fails instead
        try:
            self.context.rename(draft, self.pointer(number), options)
            return True
        except Exception as exc:
            self.fs.delete(draft, False)
            if "FileAlreadyExists" in str(exc) or self.fs.exists(self.pointer(number)):
                return False
            raise


def new_path(root: str) -> str:
    """A place for a version that nobody knows of yet."""
    return f"{root.rstrip('/')}/data-{uuid.uuid4().hex}"


def current(spark: SparkSession, root: str) -> Version | None:
    """The version that is published now, if any."""
    folder = _Folder(spark, root)
    numbers = folder.numbers()
    return _version(folder, root, numbers[-1]) if numbers else None


def _version(folder: _Folder, root: str, number: int) -> Version:
    said = folder.read(number)
    return Version(number, f"{root.rstrip('/')}/{said['data']}", said["info"])


def publish(spark: SparkSession, root: str, path: str, info: dict, first_only: bool = False) -> Version:
    """Make the written folder ``path`` (from :func:`new_path`) the current version.

    ``first_only``: only if there is none yet; else the one that is there is returned, so that
    several builders of the same table agree on one of their results.
    """
    folder = _Folder(spark, root)
    while True:
        numbers = folder.numbers()
        if numbers and first_only:
            return _version(folder, root, numbers[-1])
        number = numbers[-1] + 1 if numbers else 1
        if folder.add(number, {"data": path.rstrip("/").rsplit("/", 1)[1], "info": info}):
            return Version(number, path, info)


def create_or_replace(df: DataFrame, root: str, name: str | None = None, rows_per_file: int = 2_000_000) -> Version:
    """Write ``df`` as the next version of the table at ``root``, with its row count.

    A failed or lost job leaves files that no pointer names, and the table as it was.  ``df``
    may read the table itself.  ``name``: also publish it in the catalog.
    """
    spark = df.sparkSession
    path = new_path(root)
    rows = write_counted(df, path, rows_per_file)
    version = publish(spark, root, path, {"rows": rows, "columns": df.columns})
    if name:
        publish_name(spark, root, name)
    return version


def write_counted(df: DataFrame, path: str, rows_per_file: int) -> int:
    """Write ``df`` as Parquet and return how many rows were written, from the files' footers.

    Not by an observation: a session that has observed a frame cannot serialise the scoring
    functions of MLlib models, which hold the session.
    """
    df.write.option("maxRecordsPerFile", rows_per_file).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path).count()


def read(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The current version, or a numbered one; the frame stays on it when others are published."""
    folder = _Folder(spark, root)
    numbers = folder.numbers()
    if not numbers or number is not None and number not in numbers:
        raise LookupError(f"no {'version' if number is None else f'version {number}'} at {root}")
    return spark.read.parquet(_version(folder, root, numbers[-1] if number is None else number).path)


def publish_name(spark: SparkSession, root: str, name: str) -> None:
    """A catalog table ``name`` at the current version: one change of its place when a version follows another."""
    path = current(spark, root).path.replace("'", "\\'")
    quoted = ".".join(f"`{p}`" for p in name.split("."))
    if spark.catalog.tableExists(name):
        have = spark.table(name).schema
        if have == spark.read.parquet(path).schema:
            spark.sql(f"ALTER TABLE {quoted} SET LOCATION '{path}'")
            spark.catalog.refreshTable(quoted)
            return
        spark.sql(f"DROP TABLE {quoted}")  # an external table: its files stay
    try:
        spark.sql(f"CREATE TABLE {quoted} USING parquet LOCATION '{path}'")
    except AnalysisException:  # another driver was first
        spark.sql(f"ALTER TABLE {quoted} SET LOCATION '{path}'")


def remove_old(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Remove all but the last ``keep`` versions: pointers first, then files.  Readers of those fail from then on."""
    if keep < 1:
        raise ValueError("the current version stays")
    folder = _Folder(spark, root)
    gone = folder.numbers()[:-keep]
    for number in gone:
        path = _version(folder, root, number).path
        folder.fs.delete(folder.pointer(number), False)
        folder.fs.delete(folder.jvm.Path(path), True)
    return gone
