"""Sinks: replaced tables, CSV export, stored stages (SNK-1, SNK-2, SNK-3).

Paths default to the cluster's shared folder (``spark.checkpoint.dir``), never a
machine-local temporary folder.

A replaced table is a folder of versions and a pointer file that names the current
one. A write makes a new version and then swaps the pointer by one rename with
overwrite, which the file system does at once: readers see the old table or the new
one, a failing or killed write leaves the old one, and a re-run replaces instead of
appending. A catalog table is replaced by moving its location to a new version.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from winback.session import scratch_path

POINTER, VERSIONS = "_current", "_versions"     # hidden from Parquet readers of the folder


class Files:
    """Small files and renames in a folder of whatever Hadoop file system holds it."""

    def __init__(self, spark: SparkSession, root: str):
        sc = spark.sparkContext
        self._gateway, self._hadoop = sc._gateway, sc._jvm.org.apache.hadoop.fs
        self._conf = sc._jsc.hadoopConfiguration()
        self.root = self._hadoop.Path(root)
        self._fs = self.root.getFileSystem(self._conf)

    def path(self, name: str = ""):
        return self._hadoop.Path(self.root, name) if name else self.root

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self.path(name))

    def names(self, name: str = "") -> list[str]:
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self.path(name)))

    def delete(self, name: str = "") -> None:
        self._fs.delete(self.path(name), True)

    def read(self, name: str) -> str | None:
        if not self.exists(name):
            return None
        stream = self._fs.open(self.path(name))
        try:
            return stream.readUTF()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Replace a small file: written beside it, then renamed over it at once."""
        beside = self.path(f"_{uuid.uuid4().hex}")
        stream = self._fs.create(beside)
        try:
            stream.writeUTF(text)
        finally:
            stream.close()
        rename = self._hadoop.Options.Rename
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        self._hadoop.FileContext.getFileContext(self.root.toUri(), self._conf).rename(beside, self.path(name), options)

    def fingerprint(self) -> list:
        """(name, bytes, time of change) of the files below, in order: what a stage that
        reads them depends on."""
        out, files = [], self._fs.listFiles(self.root, True)
        while files.hasNext():
            s = files.next()
            out.append([s.getPath().toString(), s.getLen(), s.getModificationTime()])
        return sorted(out)


def _new_version(df: DataFrame, path: str, partition_by: list[str] | None, sort_within: list | None) -> str:
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    w = out.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    try:
        w.parquet(f"{path}/{VERSIONS}/{version}")
    except BaseException:
        Files(df.sparkSession, path).delete(f"{VERSIONS}/{version}")
        raise
    return version


def _swap(files: Files, version: str) -> None:
    """Make ``version`` the current one; the one before it stays for readers that began on
    it, complete older ones go (one without its success mark is another writer's)."""
    before = files.read(POINTER)
    files.write(POINTER, version)
    for v in files.names(VERSIONS):
        if v < version and v != before and files.exists(f"{VERSIONS}/{v}/_SUCCESS"):
            files.delete(f"{VERSIONS}/{v}")


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                sort_within: list | None = None) -> str:
    """CREATE OR REPLACE TABLE ... AS (as Parquet files); ``read_table`` reads it. The
    frame may read the table it replaces. An ORDER BY of the source becomes an order
    within each written file (no global sort)."""
    version = _new_version(df, path, partition_by, sort_within)
    _swap(Files(df.sparkSession, path), version)
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a replaced table; a folder without versions is read as it is."""
    version = Files(spark, path).read(POINTER)
    return spark.read.parquet(f"{path}/{VERSIONS}/{version}" if version else path)


def output_path(spark: SparkSession, name: str) -> str:
    """Where final output tables go: the warehouse, apart from checkpoints and stages; a
    local session without a shared setting keeps them with its other files."""
    if spark.sparkContext.master.startswith("local["):
        return scratch_path(spark, name)
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}"


def replace_catalog_table(df: DataFrame, name: str, path: str, partition_by: list[str] | None = None) -> str:
    """SNK-1 through the session's catalog: ``name`` becomes an external table over a new
    version under ``path``. With an unchanged schema its location is moved by one catalog
    call; a new schema drops and creates the entry. Files are deleted last."""
    spark = df.sparkSession
    version = _new_version(df, path, partition_by, None)
    location = f"{path}/{VERSIONS}/{version}"
    if spark.catalog.tableExists(name) and spark.table(name).schema == spark.read.parquet(location).schema:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=location, source="parquet")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)
    _swap(Files(spark, path), version)
    return name


def write_csv(df: DataFrame, path: str) -> str:
    """SNK-3: CSV with a header row (the null-count export)."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read a CSV export back with an explicit schema (no inference pass)."""
    return spark.read.option("header", True).schema(schema).csv(path)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut the lineage of a stage that several jobs read (the script's CTAS
    tables): the stage is written once as Parquet under the shared
    ``spark.checkpoint.dir`` and read back. A lost executor then re-reads
    files instead of recomputing the stage, and every later read prunes
    columns (a 161-column table read for one key column reads one column)."""
    path = scratch_path(df.sparkSession, f"{name}_{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
