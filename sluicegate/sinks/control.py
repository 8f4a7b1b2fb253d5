"""Small bookkeeping tables kept beside the data.

A generation's rows are one folder, written again by a replay. What a generation writes depends only on its own
frames and on earlier generations, so a replay writes the same rows.

History does not make a flush slower. From time to time the rows of closed generations are put together:

- ``recent/gen=<n>`` holds the rows of generation n;
- ``history/upto=<n>`` holds the rows of the generations before n that were put together at n, with their ``gen``;
- ``merged/upto=<n>`` holds what all generations up to n come to, by the table's own merge.

The state as of a generation is the newest merged folder that is not later, and the recent folders after it: a
bounded number of folders, however long the job has run. A generation older than every merged folder reads the
history instead, which only a replay of long ago does. Folders are removed one round after they were put
together, so that readers which have listed them still find them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import local_rows

# Generations between two rounds; recent folders number at most twice as many.
EVERY = 16
BEFORE_ALL = -1
COMPLETE = "_COMPLETE"


def read_or_empty(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, base: str | None = None) -> DataFrame:
    """Parquet folders, or no rows when nothing has been written there yet.

    ``base`` is the folder that partition columns count from, where it is not ``path`` itself.
    """
    reader = spark.read.schema(schema)
    if base is not None:
        reader = reader.option("basePath", base)
    try:
        return reader.parquet(*([path] if isinstance(path, str) else path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        # A local relation, so that joins and filters on it are planned away.
        return local_rows(spark, [], schema)


def overwrite(rows: DataFrame, path: str, *partitions: str) -> None:
    """Replace the whole folder, also in a session whose overwrites replace only the partitions written."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partitions).parquet(path)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this job wrote and no longer needs."""
    place, files = _place(spark, path)
    files.delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _place(spark, path)
    return files.exists(place)


def create_if_absent(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create a file that is not there; false, and nothing changed, when it is."""
    place, files = _place(spark, path)
    try:
        out = files.create(place, False)
    except Exception as error:  # py4j wraps what the file system raises
        if files.exists(place):
            return False
        raise error
    out.write(text.encode())
    out.close()
    return True


def numbered_folders(spark: SparkSession, path: str, key: str = "") -> list[int]:
    """The numbers n of the folders ``<key>=<n>`` (or ``<n>``) right under ``path``, ascending."""
    place, files = _place(spark, path)
    if not files.exists(place):
        return []
    prefix = f"{key}=" if key else ""
    names = [status.getPath().getName() for status in files.listStatus(place) if status.isDirectory()]
    numbers = [name[len(prefix) :] for name in names if name.startswith(prefix)]
    return sorted(int(n) for n in numbers if n.lstrip("-").isdigit())


class ControlTable:
    """Rows by generation. ``merge`` makes of many generations' rows the rows that they come to."""

    def __init__(self, path: str, schema: T.StructType, merge: Callable[[DataFrame], DataFrame]):
        self.path = path
        self.schema = schema
        self.merge = merge
        self.names = [n for n in schema.names if n != "gen"]
        self.rest = T.StructType([f for f in schema.fields if f.name != "gen"])

    def _recent(self, gen: int) -> str:
        return f"{self.path}/recent/gen={gen}"

    def _read_recent(self, spark: SparkSession, gens: Sequence[int]) -> DataFrame:
        if not gens:
            return local_rows(spark, [], self.schema)
        # Spark moves the partition column to the end.
        found = read_or_empty(spark, [self._recent(g) for g in gens], self.schema, f"{self.path}/recent")
        return found.select(*self.schema.names)

    def _read_history(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("upto", T.LongType())])
        return read_or_empty(spark, f"{self.path}/history", schema).select(*self.schema.names)

    def recent_gens(self, spark: SparkSession) -> list[int]:
        return numbered_folders(spark, f"{self.path}/recent", "gen")

    def merged_upto(self, spark: SparkSession, gen: int | None = None) -> int | None:
        """The newest generation that a merged folder reaches, of those not later than ``gen``."""
        numbers = [n for n in numbered_folders(spark, f"{self.path}/merged", "upto") if gen is None or n <= gen]
        return next((n for n in reversed(numbers) if exists(spark, f"{self.path}/merged/upto={n}/{COMPLETE}")), None)

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows of all generations."""
        done = max(numbered_folders(spark, f"{self.path}/history", "upto"), default=BEFORE_ALL)
        recent = [g for g in self.recent_gens(spark) if g > done]
        return self._read_history(spark).unionByName(self._read_recent(spark, recent))

    def read_one(self, spark: SparkSession, gen: int) -> DataFrame:
        """One generation, from its own folder while that is there; the others are not even listed."""
        if exists(spark, self._recent(gen)):
            rows = read_or_empty(spark, self._recent(gen), self.rest)
            return rows.select(*[F.lit(gen).cast("bigint").alias("gen") if n == "gen" else n for n in self.schema.names])
        base = self.merged_upto(spark)
        if base is None or gen > base:
            return local_rows(spark, [], self.schema)
        return self._read_history(spark).where(F.col("gen") == gen)

    def _state(self, spark: SparkSession, base: int | None, recent: Sequence[int]) -> DataFrame:
        """A merged folder, if any, and recent folders together."""
        rows = self._read_recent(spark, recent)
        if base is not None:
            merged = read_or_empty(spark, f"{self.path}/merged/upto={base}", self.rest)
            rows = rows.unionByName(merged.withColumn("gen", F.lit(base).cast("bigint")))
        return rows

    def as_of(self, spark: SparkSession, gen: int | None = None) -> DataFrame:
        """What the generations up to ``gen``, or all, come to."""
        base = self.merged_upto(spark, gen)
        after = BEFORE_ALL if base is None else base
        rows = self._state(spark, base, [g for g in self.recent_gens(spark) if g > after and (gen is None or g <= gen)])
        if base is None and gen is not None and self.merged_upto(spark) is not None:
            rows = rows.unionByName(self._read_history(spark).where(F.col("gen") <= gen)).distinct()
        return self.merge(rows)

    def replace(self, rows: DataFrame, gen: int) -> None:
        overwrite(rows.select(*self.names).coalesce(1), self._recent(gen))

    def put_together(self, spark: SparkSession, upto: int) -> None:
        """Merge the generations up to ``upto``, all of which are closed, and remove what the last round merged."""
        before = self.merged_upto(spark)
        after = BEFORE_ALL if before is None else before
        recent = [g for g in self.recent_gens(spark) if after < g <= upto]
        folder = f"{self.path}/merged/upto={upto}"
        overwrite(self.merge(self._state(spark, before, recent)).select(*self.names).coalesce(1), folder)
        if recent:
            overwrite(self._read_recent(spark, recent).coalesce(1), f"{self.path}/history/upto={upto}")
        create_if_absent(spark, f"{folder}/{COMPLETE}")
        for g in self.recent_gens(spark):
            if g <= after:
                remove(spark, self._recent(g))
        for n in numbered_folders(spark, f"{self.path}/merged", "upto"):
            if n < after:
                remove(spark, f"{self.path}/merged/upto={n}")
