"""Durable results: partitioned tables and per-session snapshots."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 256
COMMIT = "folder string, version bigint, replaces array<string>"


def write_results(df: DataFrame, path: str, by: str = "risk_band", fmt: str = "parquet") -> None:
    """Write results partitioned by a column of few values (parquet, orc, json or csv)."""
    df.write.mode("overwrite").partitionBy(by).format(fmt).save(path)


def _bucket(session: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(session), F.lit(buckets)).cast("int")


class SnapshotStore:
    """Session snapshots in versioned folders: save, load, delete by session id.

    Every change is a new folder of ``data``, parted by bucket, and becomes visible by
    one row appended to ``commits``; nothing that is there is overwritten. So a saver that
    fails leaves no trace in what is read, and two savers at once both keep their rows.
    Of several versions of a session the newest counts (at the same version the larger
    folder name); a deletion is a version without content. One session should come once
    per save.

    A session's bucket follows from its id, so a load reads one bucket of each folder.
    :meth:`compact` merges the folders into one; the number of folders, which is all that
    reaches the driver, grows with the saves since then, not with the sessions. Replaced
    folders may be removed by hand once no reader uses them. ``buckets`` sets how many
    sessions a file holds and stays fixed for a store.
    """

    def __init__(self, spark: SparkSession, path: str, schema, session: str, buckets: int = BUCKETS):
        self.spark, self.path, self.session, self.buckets = spark, path, session, buckets
        self.schema = schema

    def _commits(self) -> list:
        try:
            rows = self.spark.read.schema(COMMIT).parquet(f"{self.path}/commits").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        replaced = {folder for row in rows for folder in row["replaces"]}
        return [row for row in rows if row["folder"] not in replaced]

    def _commit(self, rows: DataFrame, folder: str, version: int, replaces: list[str]) -> None:
        placed = rows.withColumn("_bucket", _bucket(F.col(self.session), self.buckets))
        placed.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/data/_folder={folder}")
        commit = self.spark.createDataFrame([(folder, version, replaces)], COMMIT)
        commit.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")

    def _add(self, rows: DataFrame, deleted: bool) -> None:
        folder = uuid.uuid4().hex
        version = max((c["version"] for c in self._commits()), default=0) + 1
        marks = {"_deleted": F.lit(deleted), "_version": F.lit(version).cast("bigint")}
        self._commit(rows.select(*self.schema.names).withColumns(marks), folder, version, [])

    def _newest(self, commits: list, only: Column | None = None) -> DataFrame:
        """The newest version of each session, deletions too."""
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema]
        full = ", ".join([*fields, "_deleted boolean", "_version bigint", "_folder string", "_bucket int"])
        data = f"{self.path}/data"
        if commits:
            folders = [f"{data}/_folder={c['folder']}" for c in commits]
            rows = self.spark.read.schema(full).option("basePath", data).parquet(*folders)
        else:
            rows = self.spark.createDataFrame([], full)
        if only is not None:
            rows = rows.filter(only)
        rest = [*[c for c in self.schema.names if c != self.session], "_deleted", "_version"]
        return (
            rows.groupBy(self.session)
            .agg(F.max_by(F.struct(*rest), F.struct("_version", "_folder")).alias("_row"))
            .select(self.session, "_row.*")
        )

    def _live(self, only: Column | None = None) -> DataFrame:
        return self._newest(self._commits(), only).filter(~F.col("_deleted")).select(*self.schema.names)

    def all(self) -> DataFrame:
        """All live snapshots."""
        return self._live()

    def load(self, session_id) -> DataFrame:
        """The snapshot of one session; no row when there is none."""
        key = F.lit(session_id).cast(self.schema[self.session].dataType)
        return self._live((F.col("_bucket") == _bucket(key, self.buckets)) & (F.col(self.session) == key))

    def save(self, df: DataFrame) -> None:
        """Add or replace the sessions in ``df``. A row without a session id is not saved."""
        self._add(df.filter(F.col(self.session).isNotNull()), False)

    def delete(self, ids: DataFrame) -> None:
        """Remove the sessions whose ids are in ``ids``."""
        blank = [
            F.col(f.name) if f.name == self.session else F.lit(None).cast(f.dataType).alias(f.name)
            for f in self.schema
        ]
        named = ids.filter(F.col(self.session).isNotNull()).select(self.session).distinct()
        self._add(named.select(*blank), True)

    def compact(self) -> None:
        """Merge all folders into one. Deletions are kept as marks, so that a save made
        before one but committed late does not bring the session back."""
        commits = self._commits()
        if len(commits) > 1:
            version = max(c["version"] for c in commits)
            self._commit(self._newest(commits), uuid.uuid4().hex, version, [c["folder"] for c in commits])
