"""Parquet tables: append, versioned snapshot, and replaceable date slices."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow import schemas


# How stored tables are packed. Content hashes in hex shrink to half, which the default codec does not do.
CODEC = "zstd"
# No date lies before it: a filter that every date passes.
FIRST_DATE = "0001-01-01"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _file_system(spark, path)
    return files.exists(at)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to this path ran to its end."""
    return exists(spark, f"{path}/_SUCCESS")


def child_names(spark: SparkSession, path: str) -> list[str]:
    files, at = _file_system(spark, path)
    return [status.getPath().getName() for status in files.listStatus(at)] if files.exists(at) else []


def discard(spark: SparkSession, path: str) -> None:
    """Remove a work folder of our own."""
    files, at = _file_system(spark, path)
    files.delete(at, True)


def mark(spark: SparkSession, path: str) -> None:
    """Put an empty file here, for `exists` to find."""
    files, at = _file_system(spark, path)
    files.create(at, True).close()


def observed(frame: DataFrame, metrics: dict[str, Column]) -> tuple[DataFrame, Callable[[], dict]]:
    """`frame`, and a function that gives aggregates of its rows once it was written.

    Put right under the write they are counted in the tasks whose output counts: no
    further scan, and a task that runs twice counts once.
    """
    if not metrics:
        return frame, dict
    seen = Observation()
    frame = frame.observe(seen, *[value.alias(name) for name, value in metrics.items()])
    return frame, lambda: {name: seen.get.get(name) for name in metrics}


def write_counted(frame: DataFrame, path: str, **metrics: Column) -> dict:
    """Write a work folder and return aggregates of what was written."""
    frame, counts = observed(frame, metrics)
    frame.write.mode("overwrite").option("compression", CODEC).parquet(path)
    return counts()


def _bucket_table(path: str) -> str:
    return f"buckets_{hashlib.sha256(path.encode()).hexdigest()[:32]}"


def write_buckets(frame: DataFrame, path: str, key: str, **metrics: Column) -> dict:
    """Write a work folder as write_counted does, in buckets of `key`; `read_buckets` reads it and joins by the key move nothing."""
    spark = frame.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Rows that a join or window has dealt and sorted by the key stay as they are; a sort of others compares their keys' first bytes.
    frame, counts = observed(frame.repartition(buckets, key).sortWithinPartitions(key), metrics)
    forget_buckets(spark, path)
    # A catalog takes relative paths from the warehouse, readers from the working folder.
    files, at = _file_system(spark, path)
    writer = frame.write.mode("overwrite").option("compression", CODEC).option("path", files.makeQualified(at).toString())
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(_bucket_table(path))
    return counts()


def read_buckets(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """What lies in buckets; as a plain folder of that `schema` where another process wrote it, whose catalog is gone."""
    # A bucket is one file, in the order of its key: joins need not sort it again.
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    if schema is not None and not spark.catalog.tableExists(_bucket_table(path)):
        return spark.read.schema(schema).parquet(path)
    return spark.table(_bucket_table(path))


def forget_buckets(spark: SparkSession, *paths: str) -> None:
    """Forget that folders lie in buckets; their files stay."""
    for path in paths:
        spark.sql(f"DROP TABLE IF EXISTS {_bucket_table(path)}")


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty frame that is known to be empty when a plan is made: joins with it move nothing."""
    return spark.createDataFrame([], schema).filter(F.lit(False))


def conform(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the declared schema; the columns must be exactly the declared ones."""
    if set(frame.columns) != set(schema.names):
        raise ValueError(f"columns {sorted(frame.columns)} are not the declared {sorted(schema.names)}")
    return frame.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in schema])


@dataclass(frozen=True)
class AppendTable:
    """A table that only grows."""

    path: str
    schema: T.StructType

    def read(self, spark: SparkSession) -> DataFrame:
        if not exists(spark, self.path):
            return no_rows(spark, self.schema)
        return spark.read.schema(self.schema).parquet(self.path)

    def append(self, frame: DataFrame) -> None:
        conform(frame, self.schema).write.mode("append").option("compression", CODEC).parquet(self.path)


@dataclass(frozen=True)
class PartedTable:
    """A table that grows part by part. Writing a part again replaces it, so a batch may try as often as it needs to.

    `partition` names a column by which the files of a part lie in folders. Rows are gathered by it, unless
    its folders are so few that every task has rows of most.
    """

    path: str
    schema: T.StructType
    partition: str | None = None
    gathered: bool = True

    def _folder(self, part: str) -> str:
        return f"{self.path}/_part={part}"

    def parts(self, spark: SparkSession) -> list[str]:
        found = [name.removeprefix("_part=") for name in child_names(spark, self.path) if name.startswith("_part=")]
        return sorted(part for part in found if is_complete(spark, self._folder(part)))

    def read(self, spark: SparkSession, parts: list[str] | None = None) -> DataFrame:
        chosen = self.parts(spark) if parts is None else parts
        if not chosen:
            return no_rows(spark, self.schema)
        stored = T.StructType([*self.schema.fields]).add("_part", "string")
        found = spark.read.schema(stored).option("basePath", self.path).parquet(*map(self._folder, chosen))
        return found.select(*self.schema.names)

    def put(self, frame: DataFrame, part: str, **metrics: Column) -> dict:
        """Write a part; returns aggregates of its rows, as write_counted does."""
        rows = conform(frame, self.schema)
        rows, counts = observed(rows.hint("rebalance", self.partition) if self.partition and self.gathered else rows, metrics)
        writer = rows.write.mode("overwrite").option("compression", CODEC)
        (writer.partitionBy(self.partition) if self.partition else writer).parquet(self._folder(part))
        return counts()

    def forget(self, spark: SparkSession, parts: list[str]) -> None:
        for part in parts:
            discard(spark, self._folder(part))


@dataclass(frozen=True)
class KeyIndex:
    """In which slices of a table a key may lie, in buckets of the key's hash.

    A look-up opens only the buckets of the keys it asks for. A key keeps the slices
    that it had before, so what is found may be too much, but never too little. A
    null slice stands for a key that was seen but is in no slice.
    """

    path: str
    key: str
    slice_column: str = "_slice"
    buckets: int = 32
    # Parts after which they are merged into one.
    most_parts: int = 16

    @property
    def _table(self) -> PartedTable:
        schema = T.StructType().add(self.key, "string").add(self.slice_column, "date").add("_bucket", "integer")
        return PartedTable(self.path, schema, "_bucket")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def is_empty(self, spark: SparkSession) -> bool:
        return not self._table.parts(spark)

    def add(self, entries: DataFrame, part: str) -> None:
        """Add (key, slice) pairs as a part of that name, in place of what it held."""
        self._table.put(entries.select(self.key, self.slice_column).withColumn("_bucket", self._bucket()), part)

    def find(self, keys: DataFrame) -> DataFrame:
        """The distinct (key, slice) pairs of `keys`, a stored frame of distinct keys."""
        wanted = keys.select(self.key).filter(F.length(self.key) >= 0)
        # One row for each bucket at most.
        buckets = F.broadcast(wanted.select(self._bucket().alias("_bucket")).distinct())
        held = self._table.read(keys.sparkSession).join(buckets, "_bucket", "left_semi")
        found = held.join(wanted, self.key, "left_semi").select(self.key, self.slice_column)
        # Dealt by the key alone, as the caller's keys may be; pairs move once.
        partitions = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return found.repartition(partitions, self.key).distinct()

    def compact(self, spark: SparkSession) -> None:
        """Merge the parts into one when they have become many. Dying half way leaves pairs twice, which changes nothing."""
        parts = self._table.parts(spark)
        if len(parts) > self.most_parts:
            self._table.put(self._table.read(spark, parts).distinct(), f"merged-{uuid.uuid4().hex}")
            self._table.forget(spark, parts)


@dataclass(frozen=True)
class SnapshotTable:
    """A table replaced as a whole, each state in a folder of its own.

    A state counts once its write completed, so readers and a writer that dies
    half way never meet a partial table, and older states stay readable.
    """

    path: str
    schema: T.StructType

    def versions(self, spark: SparkSession) -> list[int]:
        found = [int(name.partition("=")[2]) for name in child_names(spark, self.path) if name.startswith("version=")]
        return sorted(v for v in found if is_complete(spark, self._folder(v)))

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        versions = self.versions(spark)
        if not versions:
            return no_rows(spark, self.schema)
        chosen = versions[-1] if version is None else version
        if chosen not in versions:
            raise ValueError(f"{self.path} has no version {chosen}; it has {versions}")
        return spark.read.schema(self.schema).parquet(self._folder(chosen))

    def forget(self, spark: SparkSession, keep: int) -> None:
        """Remove all but the last `keep` states."""
        for version in self.versions(spark)[:-keep]:
            discard(spark, self._folder(version))

    def replace(self, frame: DataFrame) -> int:
        spark = frame.sparkSession
        version = max(self.versions(spark), default=0) + 1
        # A folder of this number can only be the rest of a write that died.
        conform(frame, self.schema).write.mode("overwrite").option("compression", CODEC).parquet(self._folder(version))
        return version

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version}"


@dataclass(frozen=True)
class SlicedTable:
    """A table partitioned by a date, of which single slices are replaced.

    Every replacement writes its slices once, into a folder of its own, and then
    switches a small table of (slice, folder) to them. The switch is one commit of
    that table: a reader sees all of a replacement or none of it. A slice that
    becomes empty loses its entry, so its rows are gone without being rewritten.

    `totals` (name, SQL aggregate, type) are kept for every slice beside its folder.
    With `sort_columns` rows are clustered: files are ranges of slice and columns.
    Rows that are not `gathered` are written by the tasks that have them: where slices are so
    large that every task has rows of most, moving them all would only make files larger.
    """

    path: str
    schema: T.StructType
    slice_column: str
    sort_columns: tuple[str, ...] = ()
    totals: tuple[tuple[str, str, str], ...] = ()
    gathered: bool = True

    @property
    def _places(self) -> SnapshotTable:
        schema = T.StructType().add(self.slice_column, "date").add("_folder", "string")
        for name, _, kind in self.totals:
            schema = schema.add(name, kind)
        return SnapshotTable(f"{self.path}/places", schema)

    @property
    def _data(self) -> str:
        return f"{self.path}/data"

    def _stored(self, spark: SparkSession) -> DataFrame:
        columns = [f for f in self.schema if f.name != self.slice_column]
        stored = T.StructType(columns).add("_folder", "string").add(self.slice_column, "date")
        return spark.read.schema(stored).parquet(self._data)

    def _at(self, spark: SparkSession, places: DataFrame) -> DataFrame:
        # The comparison holds for every date. It makes the few places a filter that prunes the folders.
        wanted = places.select(self.slice_column, "_folder").filter(F.col(self.slice_column) >= F.lit(FIRST_DATE).cast("date"))
        return self._stored(spark).join(wanted, ["_folder", self.slice_column], "left_semi").drop("_folder")

    def read(self, spark: SparkSession, slices: DataFrame | None = None) -> DataFrame:
        """All rows, with the slice column, or those of `slices`: a stored frame of one column of dates."""
        places = self._places.read(spark)
        if not self._places.versions(spark) or not exists(spark, self._data):
            kept = [f for f in self.schema if f.name != self.slice_column]
            return no_rows(spark, T.StructType(kept).add(self.slice_column, "date"))
        if slices is not None:
            places = places.join(slices.toDF(self.slice_column), self.slice_column, "left_semi")
        return self._at(spark, places)

    def stage(self, rows: DataFrame, folder: str, **metrics: Column) -> dict:
        """Write the new content of slices, unseen by readers; returns aggregates of the rows, observed as they are written.

        Staging a folder again replaces what it held. Rows are gathered into few files
        by slice, unless they stay where they are, and a slice that is too large for one task is split.
        """
        stored = T.StructType([f for f in self.schema if f.name != self.slice_column]).add(self.slice_column, "date")
        rows, order = conform(rows, stored), [self.slice_column, *self.sort_columns]
        dealt = rows.repartitionByRange(*order) if self.sort_columns else rows.hint("rebalance", self.slice_column) if self.gathered else rows
        dealt, counts = observed(dealt.sortWithinPartitions(*order), metrics)
        dealt.write.mode("overwrite").option("compression", CODEC).partitionBy(self.slice_column).parquet(f"{self._data}/_folder={folder}")
        return counts()

    def staged(self, spark: SparkSession, folder: str) -> DataFrame:
        columns = [f for f in self.schema if f.name != self.slice_column]
        return spark.read.schema(T.StructType(columns).add(self.slice_column, "date")).parquet(f"{self._data}/_folder={folder}")

    def staged_totals(self, spark: SparkSession, folder: str) -> DataFrame:
        """The totals of each slice in a staged folder."""
        sums = [F.expr(sql).cast(kind).alias(name) for name, sql, kind in self.totals]
        return self.staged(spark, folder).groupBy(self.slice_column).agg(*(sums or [F.count("*").alias("_rows")])).select(
            self.slice_column, *[name for name, _, _ in self.totals]
        )

    def slice_totals(self, spark: SparkSession) -> DataFrame:
        """Each slice and its totals, as kept when it was published."""
        return self._places.read(spark).drop("_folder")

    def holds(self, spark: SparkSession, folder: str) -> bool:
        """Whether a staged folder was published and still has a slice."""
        return not self._places.read(spark).filter(F.col("_folder") == folder).isEmpty()

    def publish(self, spark: SparkSession, folder: str, slices: DataFrame) -> None:
        """Switch the given slices to the staged folder. Doing it again changes nothing.

        Folders that neither this state nor the one before has a slice in are removed.
        """
        column = self.slice_column
        replaced = slices.toDF(column)
        filled = self.staged_totals(spark, folder).withColumn("_folder", F.lit(folder))
        kept = self._places.read(spark).join(replaced, column, "left_anti")
        self._places.replace(kept.unionByName(filled))
        self._places.forget(spark, keep=2)
        used = {folder}
        for version in self._places.versions(spark):
            # One row for each folder that still holds a slice.
            used |= {row[0] for row in self._places.read(spark, version).select("_folder").distinct().collect()}
        for name in child_names(spark, self._data):
            if name.startswith("_folder=") and name.partition("=")[2] not in used:
                discard(spark, f"{self._data}/{name}")


@dataclass(frozen=True)
class RefreshQueue:
    """Business dates whose Gold rows are stale, kept as a log of entries.

    Queueing and clearing both append, so two jobs can do so at once. An entry is
    cleared by date and stamp, whatever the clocks say: a date queued again
    meanwhile stays queued. Compacting starts a new log with the open entries; the
    one before is still read, in case another job was just adding to it.
    """

    path: str

    _schema = T.StructType([*schemas.REFRESH_QUEUE.fields]).add("cleared", "boolean")

    def _logs(self, spark: SparkSession) -> list[int]:
        found = [int(n.partition("=")[2]) for n in child_names(spark, self.path) if n.startswith("log=")]
        return sorted(n for n in found if is_complete(spark, f"{self.path}/log={n}"))

    def entries(self, spark: SparkSession) -> DataFrame:
        """The open entries, each as it was queued."""
        logs = self._logs(spark)
        if not logs:
            return no_rows(spark, schemas.REFRESH_QUEUE)
        log = spark.read.schema(self._schema).parquet(*[f"{self.path}/log={n}" for n in logs])
        stamped = ["order_date", "queued_at"]
        return log.filter("NOT cleared").select(*stamped).distinct().join(log.filter("cleared").select(*stamped), stamped, "left_anti")

    def pending(self, spark: SparkSession) -> DataFrame:
        """Each date with open entries, and its last stamp."""
        return self.entries(spark).groupBy("order_date").agg(F.max("queued_at").alias("queued_at"))

    def _append(self, entries: DataFrame) -> None:
        last = max(self._logs(entries.sparkSession), default=0)
        conform(entries, self._schema).write.mode("append").option("compression", CODEC).parquet(f"{self.path}/log={last}")

    def add(self, dates: DataFrame) -> None:
        """Queue dates, with a stamp of their own if the frame has one, or now."""
        stamp = F.col("queued_at") if "queued_at" in dates.columns else F.current_timestamp()
        entries = dates.filter(F.col("order_date").isNotNull()).select("order_date", stamp.alias("queued_at")).distinct()
        self._append(entries.withColumn("cleared", F.lit(False)))

    def clear(self, entries: DataFrame) -> None:
        """Clear just these entries."""
        self._append(entries.select("order_date", "queued_at").withColumn("cleared", F.lit(True)))

    def compact(self, spark: SparkSession) -> None:
        """Start a new log with the open entries; logs older than the last one go."""
        logs = self._logs(spark)
        if not logs:
            return
        fresh = self.entries(spark).withColumn("cleared", F.lit(False))
        conform(fresh, self._schema).write.mode("overwrite").option("compression", CODEC).parquet(f"{self.path}/log={logs[-1] + 1}")
        for old in logs[:-1]:
            discard(spark, f"{self.path}/log={old}")
