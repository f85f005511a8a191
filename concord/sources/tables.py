"""Local tables in Parquet: reads, whole-table swaps, atomic batch writes and upserts of the parts that change."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.operators.apply import last_of_each, upsert
from concord.session import cut_lineage


class WriteConflict(RuntimeError):
    """Another writer was first; the write had no effect and can be tried again on the new state."""


def claim(spark: SparkSession, path: str, text: str = "") -> None:
    """Makes a file that must not exist yet; of several writers one succeeds and the others get a WriteConflict."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, False)
    except Py4JJavaError as e:
        if "exist" in str(e.java_exception):
            raise WriteConflict(path) from e
        raise
    out.write(bytearray(text.encode()))
    out.close()


class VersionedTable:
    """A Parquet table whose every version is a folder of its own; a pointer table names the current one.

    Spark cannot overwrite what it reads, so a new state goes to a new folder, and the pointer is written
    last: readers see the old state or the new one, never part of both."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def current(self) -> str | None:
        try:
            row = self._pointers().orderBy("n", ascending=False).first()
        except AnalysisException:  # no version was ever written
            return None
        return None if row is None else row["version"]

    def _pointers(self) -> DataFrame:
        return self.spark.read.schema("n long, version string").json(f"{self.path}/pointers")

    def read(self) -> DataFrame:
        version = self.current()
        if version is None:
            raise FileNotFoundError(f"{self.path} has no version yet")
        return self.spark.read.parquet(f"{self.path}/{version}")

    def replace(self, state: DataFrame) -> str:
        """Makes state the table's content; state may be computed from the table itself. Raises WriteConflict where another writer has taken the version's number."""
        n = 0 if self.current() is None else self._pointers().count()
        version = f"v-{uuid.uuid4().hex}"
        state.write.parquet(f"{self.path}/{version}")
        claim(self.spark, f"{self.path}/pointers/{n:09d}.json", f'{{"n": {n}, "version": "{version}"}}\n')
        return version


class KeyedTable:
    """A Parquet table with one row a key, laid out in `parts` folders by a hash of the key, so that an upsert rewrites only the folders of the keys that change.

    The folder is the first 32 bits of the MD5 of the key, modulo `parts`. Spark's dynamic partition overwrite puts the new files in place once all
    of them are written; a task that is repeated leaves nothing double. One writer at a time: a second one gets a WriteConflict.
    A writer that is killed leaves its claim, the file `_writer`; once it is certain that it is gone, delete the file and write again."""

    PART = "__part"

    def __init__(self, spark: SparkSession, path: str, keys: list[str], parts: int = 256):
        self.spark, self.path, self.keys, self.parts = spark, path, keys, parts

    def _placed(self, rows: DataFrame) -> DataFrame:
        name = F.to_json(F.struct(*[F.col(f"`{k}`").cast("string").alias(f"k{i}") for i, k in enumerate(self.keys)]), {"ignoreNullFields": "false"}) if len(self.keys) > 1 else F.coalesce(F.col(f"`{self.keys[0]}`").cast("string"), F.lit(""))
        return rows.withColumn(self.PART, F.pmod(F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(self.parts)).cast("int"))

    def _write(self, rows: DataFrame) -> None:
        # A folder's rows are in one task, so a folder gets one file.
        rows.repartition(self.PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.PART).parquet(self.path)

    def create(self, rows: DataFrame, order: str | None = None) -> None:
        """Writes a new table; of several rows of a key the last by order stays."""
        self._write(self._placed(last_of_each(rows, self.keys, order)))

    def _stored(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def read(self) -> DataFrame:
        return self._stored().drop(self.PART)

    def files(self) -> DataFrame:
        """(part, file) of the table as it is now."""
        return self._stored().select(F.col(self.PART).alias("part"), F.col("_metadata.file_path").alias("file")).distinct()

    def upsert(self, changes: DataFrame, order: str | None = None) -> int:
        """Puts the rows of changes (with the table's columns, and that of order) in place of those with their keys, adds the others, and gives the number of folders rewritten.

        Folders in which no key changes are neither read nor written: their numbers, `parts` at most, go to the driver and prune the scan."""
        lock = f"{self.path}/_writer"  # a name that readers pass over
        claim(self.spark, lock)
        try:
            placed = cut_lineage(self._placed(last_of_each(changes, self.keys, order)))
            if order is not None and order not in self.read().columns:
                placed = placed.drop(order)
            touched = [r[0] for r in placed.select(self.PART).distinct().collect()]
            if touched:
                stored = self._stored().where(F.col(self.PART).isin(touched))
                self._write(upsert(stored, placed.select(*stored.columns), self.keys))
        finally:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(lock)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, False)
        return len(touched)
