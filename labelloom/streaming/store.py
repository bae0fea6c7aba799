"""A keyed table kept as one folder of changed rows per micro-batch.

A micro-batch writes only what it changed, into a folder named after its id, so a replay replaces
its own output and nothing is counted twice. Spark's ``_SUCCESS`` mark says that a folder is whole. A
reader takes the newest version of every key: the highest ``order`` columns, then the highest batch.

``compact`` folds whole folders into a snapshot, drops what has expired, and removes what no reader of this or
the last snapshot needs. So the number of files depends on the table and on how often it is folded, not
on its age. Everything lives in a shared folder as parquet.
"""

from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.schemas import LABELS

# Files of a snapshot: keys are dealt to them by hash.
BUCKETS = 16
_NOTE = "job string, upto bigint"


class ChangeTable:
    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], order: tuple[str, ...] = (),
        buckets: int = BUCKETS,
    ):
        self.spark, self.path, self.schema, self.keys, self.order = spark, path, schema, keys, order
        self._values = [c for c in schema.names if c not in keys]
        self._buckets = buckets

    def checkpoint(self, job: str) -> str:
        """State and progress of a job belong to the table it writes: they must stay in step."""
        return f"{self.path}/checkpoints/{job}"

    def write(self, job: str, changed: DataFrame, batch_id: int) -> None:
        """Stores the rows one micro-batch changed, with absolute values, in as many files as their size needs: a wide
        shuffle of few rows does not end in as many files as it has partitions."""
        changed.select(*self.schema.names).hint("rebalance").write.mode("overwrite").parquet(
            f"{self.path}/changes/job={job}/batch={batch_id}"
        )

    def _located(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("job", T.StringType()), T.StructField("batch", T.LongType())])

    def _changes(self) -> DataFrame:
        try:
            return self.spark.read.schema(self._located()).parquet(f"{self.path}/changes")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self._located())  # no job has written yet

    def _files(self):
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return root.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _listed(self, pattern: str) -> Iterator[list[str]]:
        """Names along each path below the table that fits the pattern."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        depth = pattern.count("/") + 1
        for status in self._files().globStatus(path(f"{self.path}/{pattern}")) or []:
            yield str(status.getPath().toString()).split("/")[-depth:]

    def _remove(self, name: str) -> None:
        self._files().delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}"), True)

    def _whole(self) -> dict[str, set[int]]:
        """Batches of each job that are written to the end."""
        found: dict[str, set[int]] = {}
        for _, job, batch, _ in self._listed("changes/job=*/batch=*/_SUCCESS"):
            found.setdefault(job.removeprefix("job="), set()).add(int(batch.removeprefix("batch=")))
        return found

    def _notes(self) -> list[int]:
        """Snapshots whose note is whole; it is what is written last."""
        return sorted(int(version.removeprefix("version=")) for _, version, _ in self._listed("folded/version=*/_SUCCESS"))

    def _folded(self, version: int | None = None) -> tuple[int | None, dict[str, int]]:
        """A snapshot, the newest by default, and the last batch of each job it contains (one row per job)."""
        if version is None:
            notes = self._notes()
            if not notes:
                return None, {}
            version = notes[-1]
        rows = self.spark.read.schema(_NOTE).parquet(f"{self.path}/folded/version={version}").collect()
        return version, {r["job"]: r["upto"] for r in rows}

    def _versions(self) -> DataFrame:
        version, upto = self._folded()
        changes = self._changes()
        if version is None:
            return changes
        for job, batch in upto.items():  # on partition columns: folded folders are not read
            changes = changes.where((F.col("job") != job) | (F.col("batch") > batch))
        snapshot = self.spark.read.schema(self._located()).parquet(f"{self.path}/snapshots/{version}")
        return snapshot.unionByName(changes)

    def current(self) -> DataFrame:
        """The newest version of every key."""
        return self._newest_of(self._versions()).select(*self.schema.names)

    def _newest_of(self, versions: DataFrame) -> DataFrame:
        newest = versions.groupBy(*self.keys).agg(
            F.max_by(F.struct(*self._values, "job", "batch"), F.struct(*self.order, "batch")).alias("row")
        )
        return newest.select(*self.keys, "row.*")

    def compact(self, now_ms: int | None = None) -> None:
        """Folds all whole batches into a new snapshot. With ``now_ms`` cells that have expired by then are dropped: their
        newest version is gone for every reader, and what is older has expired too. The old snapshot stays valid until the
        new one is complete: readers go by its note, which is written last.

        A batch that failed half-way, or is still on its way, has no mark and waits; so do those behind it, for a job's
        batches count in order. What the snapshot before last held on to is removed, so a reader that began before this
        call still finds everything. One caller at a time."""
        version, folded = self._folded()
        upto = dict(folded)
        begun: dict[str, int] = {}
        for _, job, batch in self._listed("changes/job=*/batch=*"):
            job, number = job.removeprefix("job="), int(batch.removeprefix("batch="))
            begun[job] = min(number, begun.get(job, number))
        for job, batches in self._whole().items():
            last = upto.get(job, begun[job] - 1)
            while last + 1 in batches:
                last += 1
            if last >= begun[job]:
                upto[job] = last
        if upto == folded:
            return
        rows = self._versions()
        for job, batch in upto.items():
            rows = rows.where((F.col("job") != job) | (F.col("batch") <= batch))
        rows = self._newest_of(rows.where(F.col("job").isin(list(upto))))
        if now_ms is not None and "expire_ts" in self.schema.names:
            rows = rows.where(F.col("expire_ts").isNull() | (F.col("expire_ts") > now_ms))
        new = 0 if version is None else version + 1
        dealt = rows.repartition(self._buckets, *self.keys)
        dealt.select(*self._located().names).write.mode("overwrite").parquet(f"{self.path}/snapshots/{new}")
        self.spark.createDataFrame(list(upto.items()), _NOTE).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/folded/version={new}"
        )
        self._sweep(new, folded)

    def _sweep(self, new: int, folded: dict[str, int]) -> None:
        """Removes snapshots and notes older than the last one, and the changes that the last one held already."""
        for _, job, batch, _ in list(self._listed("changes/job=*/batch=*/_SUCCESS")):
            if int(batch.removeprefix("batch=")) <= folded.get(job.removeprefix("job="), -1):
                self._remove(f"changes/{job}/{batch}")
        for _, version, _ in list(self._listed("folded/version=*/_SUCCESS")):
            number = int(version.removeprefix("version="))
            if number < new - 1:
                self._remove(f"snapshots/{number}")
                self._remove(f"folded/version={number}")


def label_table(spark: SparkSession, path: str) -> ChangeTable:
    """The shared label table: one row per user and label, the one of the newest event."""
    return ChangeTable(spark, path, LABELS, ["row_key", "label"], order=("write_ts",))
