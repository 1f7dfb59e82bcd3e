"""Table jobs on catalog tables: staged overwrite, append, merges that rewrite only what
changed, compaction of small files, layout, delete by key, load history, detail.

A table is an external Parquet table of Spark's catalog; its name says where its files
are, so there is no log of our own.  A full load writes a new folder and then points the
name at it; readers that started before go on with the old folder, which stays until
``purge``.  An append writes into the current folder with Spark's own committer; new
columns are added to the catalog's schema, so older files read as null there and nothing
that a file holds is lost.

A table may be dealt into slices: folders by a column that is computed from others, a
hash bucket of the key (dimensions) or the day (events).  A merge, a delete or a new
batch then reads and overwrites only the slices that its feed touches (Spark's dynamic
partition overwrite); all other files stay as they are.

Every load appends one row to the load history, an ordinary Parquet table beside the
data.  A table has one writer at a time; two loads at once are not arbitrated.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from tierlake.plans.catalog import add_columns, create_database, point_table, quoted, table_location
from tierlake.sources.tables import Files, path_bytes

LOAD = ("load_id string, timestamp timestamp, operation string, operation_parameters string, row_count long, "
        "location string")
HISTORY = "version long, timestamp timestamp, operation string, operation_parameters string, row_count long, location string"

TARGET_FILE_BYTES = 128 * 1024 * 1024
SMALL_SHARE = 0.75             # files below this share of the target are small
BINS_AT_ONCE = 32              # bins merged side by side, a Spark job each
FILES_PER_TASK = 1_000         # a bin of more files is first read by many tasks
TASK_BYTES = 256 * 1024 * 1024               # rows that one task of a layout sorts, as Spark holds them
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"      # Spark's folder name for a null partition value


def write_observed(df: DataFrame, path: str, mode: str = "errorifexists", by: Column | None = None,
                   partition_by: str | None = None) -> tuple[int, list]:
    """Write ``df`` as Parquet; returns the number of rows written and, with ``by``, its
    distinct values as text (null as ``NO_VALUE``).  Both come from the write itself."""
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    metrics = [F.count(F.lit(1)).alias("rows")]
    if by is not None:
        metrics.append(F.collect_set(F.coalesce(by.cast("string"), F.lit(NO_VALUE))).alias("values"))
    writer = df.observe(obs, *metrics).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    found = obs.get
    return int(found.get("rows", 0)), list(found.get("values") or [])


def files_for(spark: SparkSession, path: str, target_file_bytes: int = TARGET_FILE_BYTES) -> int:
    return max(1, math.ceil(path_bytes(spark, path) / target_file_bytes))


def row_bytes(df: DataFrame) -> int:
    """Bytes of the rows as tasks hold them: a word a column and what varies in length.  Parquet files
    say little about it, since their columns may be compressed to a small part of that."""
    size = F.lit(8 * (len(df.columns) + 1)).cast("long")
    for f in df.schema:
        if isinstance(f.dataType, (StringType, BinaryType)):
            size += F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            size += F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0))
    return int(df.agg(F.sum(size)).first()[0] or 0)


# ---------------------------------------------------------------- slices

@dataclass(frozen=True)
class Slices:
    """How rows are dealt into folders: ``name``, a column computed from ``columns``.  There is a
    bounded number of slices (hash buckets, days of a calendar), so their values fit on the driver."""

    name: str
    type: str
    columns: tuple[str, ...]
    value: Callable[[], Column]

    def touched(self, feed: DataFrame) -> list:
        """The slices that the rows of ``feed`` fall into."""
        return [r[0] for r in feed.select(self.value().alias("s")).distinct().collect()]

    def among(self, values: Sequence) -> Column:
        """Rows in these slices; literals, so folders are pruned when the scan is planned."""
        some = [F.lit(v) for v in values if v is not None]
        col = F.col(self.name)
        hit = col.isin(*some) if some else F.lit(False)
        return hit | col.isNull() if None in values else hit


def by_key(keys: Sequence[str] | str, buckets: int = 64) -> Slices:
    """Hash buckets of the key columns."""
    keys = (keys,) if isinstance(keys, str) else tuple(keys)
    return Slices("key_bucket", "int", keys, lambda: F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def by_day(column: str) -> Slices:
    return Slices("event_day", "date", (column,), lambda: F.to_date(F.col(column)))


# ---------------------------------------------------------------- tables

class Table:
    """The catalog table ``name`` (``database.table``), its folders under ``root``.  Files of a sliced
    table are sorted by ``layout``, and rows that are near in it share files."""

    def __init__(self, spark: SparkSession, name: str, root: str, slices: Slices | None = None, layout: Sequence[str] = ()):
        self.spark, self.name, self.root, self.slices = spark, name, root.rstrip("/"), slices
        self.layout = list(layout)
        self.loads = f"{self.root}/_loads"
        self._files = Files(spark, self.root)

    # ------------------------------------------------------------ reads
    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def location(self) -> str:
        """The current folder, for path-addressed readers."""
        if not self.exists():
            raise FileNotFoundError(f"table {self.name} has no data yet")
        return table_location(self.spark, self.name)

    def read(self) -> DataFrame:
        if not self.exists():
            raise FileNotFoundError(f"table {self.name} has no data yet")
        df = self.spark.table(self.name)
        return df.drop(self.slices.name) if self.slices else df

    def history(self, limit: int | None = 5) -> DataFrame:
        """Most recent loads first (``DESCRIBE HISTORY .. LIMIT n``); versions count from 0."""
        if not self._files.exists(self.loads):
            return self.spark.createDataFrame([], HISTORY)
        log = self.spark.read.schema(LOAD).parquet(self.loads)      # one row per load
        numbered = log.withColumn("version", F.row_number().over(Window.orderBy("timestamp", "load_id")).cast("long") - 1)
        out = numbered.select("version", "timestamp", "operation", "operation_parameters", "row_count",
                              "location").orderBy(F.desc("version"))
        return out.limit(limit) if limit else out

    def files(self, folder: str | None = None) -> DataFrame:
        """(path, length) of the data files, one row per file, from the file listing; nothing is read."""
        return (self.spark.read.format("binaryFile").option("recursiveFileLookup", True)
                .option("pathGlobFilter", "*.parquet").load(folder or self.location()).select("path", "length"))

    def detail(self) -> DataFrame:
        """Files and bytes from the file listing, rows from the Parquet footers."""
        none = F.lit(0).cast("long")
        rows = self.read().agg(F.count(F.lit(1)).alias("num_rows"))
        sizes = self.files().agg(F.count(F.lit(1)).alias("num_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("size_in_bytes"))
        both = sizes.withColumn("num_rows", none).unionByName(
            rows.select(none.alias("num_files"), none.alias("size_in_bytes"), "num_rows"))
        return both.agg(F.lit("parquet").alias("format"), F.lit(self.location()).alias("location"),
                        *[F.sum(c).alias(c) for c in ("num_files", "size_in_bytes", "num_rows")])

    # ------------------------------------------------------------ whole loads
    def _sliced(self, df: DataFrame) -> DataFrame:
        """Rows of a slice together; AQE splits a hot slice and merges small ones."""
        dealt = df.withColumn(self.slices.name, self.slices.value()).hint("rebalance", self.slices.name, *self.layout)
        return dealt.sortWithinPartitions(self.slices.name, *self.layout) if self.layout else dealt

    def _record(self, operation: str, rows: int, location: str, params: dict) -> None:
        told = ", ".join(f"{k}={v}" for k, v in sorted(params.items()))
        row = self.spark.range(1).select(
            F.lit(uuid.uuid4().hex).alias("load_id"), F.current_timestamp().alias("timestamp"), F.lit(operation).alias("operation"),
            F.lit(told).alias("operation_parameters"), F.lit(rows).cast("long").alias("row_count"), F.lit(location).alias("location"))
        row.coalesce(1).write.mode("append").parquet(self.loads)

    def stage(self, df: DataFrame) -> tuple[str, int]:
        """Write a folder that readers do not see yet."""
        path = f"{self.root}/load-{uuid.uuid4().hex}"
        if self.slices:
            return path, write_observed(self._sliced(df), path, partition_by=self.slices.name)[0]
        return path, write_observed(df, path)[0]

    def publish(self, path: str, rows: int, operation: str = "WRITE", schema: StructType | None = None, **params) -> None:
        """Point the name at a staged folder; its columns replace the old ones (``overwriteSchema``)."""
        create_database(self.spark, self.name.rsplit(".", 1)[0], f"{self.root}/_db")
        schema = schema or self.spark.read.parquet(path).schema
        point_table(self.spark, self.name, path, schema, (self.slices.name, self.slices.type) if self.slices else None)
        self._record(operation, rows, path, {"mode": "Overwrite", **params})

    def overwrite(self, df: DataFrame, operation: str = "WRITE", **params) -> int:
        """Staged overwrite, so a job may read the table that it replaces.  Returns the rows written."""
        path, rows = self.stage(df)
        self.publish(path, rows, operation, df.schema, **params)
        return rows

    def append(self, df: DataFrame, **params) -> int:
        """Add rows to the current folder.  Columns that the table lacks are added to it; columns that
        ``df`` lacks are null.  A column of another type is an error, and nothing is written."""
        if not self.exists():
            return self.overwrite(df, **params)
        add_columns(self.spark, self.name, df.schema)
        path = self.location()
        if self.slices:
            # static: slices are added to, not replaced
            rows, _ = write_observed(self._sliced(df), path, "append", partition_by=self.slices.name)
        else:
            rows, _ = write_observed(df, path, "append")
        self._refresh()
        self._record("WRITE", rows, path, {"mode": "Append", **params})
        return rows

    def _refresh(self) -> None:
        if self.slices:
            self.spark.sql(f"MSCK REPAIR TABLE {quoted(self.name)} SYNC PARTITIONS")
        self.spark.catalog.refreshTable(self.name)

    # ------------------------------------------------------------ changes
    def rewrite(self, feed: DataFrame, change: Callable[[DataFrame], DataFrame], operation: str = "MERGE", **params) -> int:
        """Replace the slices that ``feed`` touches by ``change(their rows)``; all other files stay.

        ``change`` may only return rows of those slices (a row of another one fails the job before
        anything is replaced).  Slices that it leaves empty go.  Run again after a crash, a change that
        is idempotent (both merges, the event dedup, a delete) gives the same table."""
        hit = self.slices.touched(feed)
        if not hit:
            return 0
        old = self.spark.table(self.name).where(self.slices.among(hit))
        new = self._sliced(change(old.drop(self.slices.name)))
        stray = F.when(~F.coalesce(self.slices.among(hit), F.lit(False)),
                       F.raise_error(F.lit(f"a change of {self.name} returned rows of a slice that its feed does not touch")))
        new = new.where(F.coalesce(stray.cast("boolean"), F.lit(True)))
        add_columns(self.spark, self.name, new.drop(self.slices.name).schema)
        path = self.location()
        rows, left = write_observed(new, path, "overwrite", F.col(self.slices.name), self.slices.name)
        for v in {NO_VALUE if v is None else str(v) for v in hit} - set(left):
            self._files.delete(f"{path}/{self.slices.name}={v}")
        self._refresh()
        self._record(operation, rows, path, {"mode": "Slices", "slices": len(hit), **params})
        return rows

    def delete_keys(self, keys: DataFrame, on: Sequence[str] | str) -> int:
        """Remove every row whose key is in ``keys`` (left anti join).  A table sliced by the key
        rewrites only the slices that hold them; another one is rewritten whole, and ``purge`` then
        takes the superseded folder off storage.  Returns the rows written."""
        on = [on] if isinstance(on, str) else list(on)
        if self.slices and tuple(on) == self.slices.columns:
            return self.rewrite(keys, lambda old: delete_by_key(old, keys, on), "DELETE", on=on)
        return self.overwrite(delete_by_key(self.read(), keys, on), "DELETE", on=on)

    # ------------------------------------------------------------ layout
    def cluster_by(self, columns: Sequence[str], target_file_bytes: int = TARGET_FILE_BYTES, curve: bool = False) -> int:
        """Rewrite with rows range-partitioned and sorted on ``columns`` (with ``curve`` on a
        space-filling curve of them), so each file covers narrow ranges and statistics skip files.

        A task sorts the rows of one file, so files are of about the target size only while their rows
        are within ``TASK_BYTES``; well compressed tables get more and smaller files."""
        rows = self.read()
        n = max(files_for(self.spark, self.location(), target_file_bytes), math.ceil(row_bytes(rows) / TASK_BYTES))
        layout = curve_layout if curve else cluster_layout
        return self.overwrite(layout(rows, columns, n), "OPTIMIZE", clusterBy=list(columns), files=n)

    def compact(self, target_file_bytes: int = TARGET_FILE_BYTES) -> int:
        """Merge small files into files of about the target size; returns the number of files merged.

        Sizes come from the file listing; first-fit packs small files of one folder into bins, and only
        files of a bin with company are read and rewritten: one task per bin scans its files and writes
        the rows as they come, without a shuffle, so it reads no more than the compressed bytes of a
        bin and holds no rows.  Large files are not touched.  The new files are staged whole, with the
        list of those they replace, then moved in, then the replaced ones are deleted;
        ``finish_compaction`` (called first here) completes a compaction that was cut off in between.
        Readers that start between the moves and the deletes may see rows twice: run it when none starts."""
        self.finish_compaction()
        path = self.location()
        small = [(r.path, r.length) for r in self.files(path).where(
            F.col("length") < int(target_file_bytes * SMALL_SHARE)).collect()]      # the listing that any scan makes
        bins = [b for b in first_fit(small, target_file_bytes) if len(b) > 1]
        if not bins:
            self._record("OPTIMIZE", 0, path, {"files": 0})
            return 0
        replaced = [p for b in bins for p in b]
        schema = self.spark.table(self.name).schema
        staged = f"{self.root}/_compact-{uuid.uuid4().hex}"

        def merge(i: int) -> int:
            rows = self.spark.read.schema(schema).option("basePath", path).parquet(*bins[i])
            if len(bins[i]) > FILES_PER_TASK:
                rows.write.parquet(f"{staged}/first/{i}")
                rows = self.spark.read.schema(schema).parquet(f"{staged}/first/{i}")
            return write_observed(rows.coalesce(1), f"{staged}/new/{BIN}{i}",
                                  partition_by=self.slices.name if self.slices else None)[0]
        with ThreadPoolExecutor(BINS_AT_ONCE) as pool:
            n = sum(pool.map(inheritable_thread_target(self.spark)(merge), range(len(bins))))
        self.spark.createDataFrame([(path, p) for p in replaced], "location string, path string").coalesce(1) \
            .write.parquet(f"{staged}/replaced")
        self.finish_compaction()
        self._record("OPTIMIZE", n, path, {"files": len(replaced), "into": len(bins)})
        return len(replaced)

    def finish_compaction(self) -> None:
        """Complete staged compactions; drop those whose files were not all written.  Each step may be
        repeated, so this may itself be cut off and run again."""
        for name in self._files.names(self.root):
            if not name.startswith("_compact-"):
                continue
            staged = f"{self.root}/{name}"
            if self._files.exists(f"{staged}/replaced/_SUCCESS"):
                rows = self.spark.read.parquet(f"{staged}/replaced").collect()
                for f in self._files.data_files(f"{staged}/new"):
                    to = f.split("/", 1)[1] if f.startswith(BIN) else f
                    self._files.move(f"{staged}/new/{f}", f"{rows[0].location}/{to}")
                for r in rows:
                    self._files.delete(r.path)
            self._files.delete(staged)
            self._refresh()

    def purge(self, older_than_seconds: int = 0) -> list[str]:
        """Delete, for good, folders of earlier loads that the name no longer points at.  Only folders
        named in the load history go, so a folder that is staged and not yet published is safe.
        Returns their names."""
        if not self._files.exists(self.loads):
            return []
        held = self.location().rstrip("/").rsplit("/", 1)[-1]
        old = self.spark.read.schema(LOAD).parquet(self.loads).where(
            F.col("timestamp") <= F.current_timestamp() - F.make_interval(secs=F.lit(older_than_seconds)))
        names = {r[0].rstrip("/").rsplit("/", 1)[-1] for r in old.select("location").distinct().collect()}
        gone = sorted(n for n in names & set(self._files.names(self.root)) if n != held)
        for n in gone:
            self._files.delete(f"{self.root}/{n}")
        return gone


# ---------------------------------------------------------------- compaction helpers

BIN = "bin-"                   # staged folders, one per bin


def first_fit(files: list[tuple[str, int]], size: int) -> list[list[str]]:
    """First-fit decreasing: file paths in bins of at most ``size`` bytes, each bin of one folder."""
    folders: dict[str, list[tuple[int, list[str]]]] = {}
    for path, length in sorted(files, key=lambda f: (-f[1], f[0])):
        bins = folders.setdefault(path.rsplit("/", 1)[0], [])
        at = next((i for i, (left, _) in enumerate(bins) if left >= length), None)
        if at is None:
            bins.append((size - length, [path]))
        else:
            left, paths = bins[at]
            bins[at] = (left - length, [*paths, path])
    return [paths for bins in folders.values() for _, paths in bins]


# ---------------------------------------------------------------- layouts and deletes

def cluster_layout(df: DataFrame, columns: Sequence[str], num_files: int | None = None
                   ) -> DataFrame:
    """Range-partition on ``columns`` then sort within partitions.

    A row hash is the last range key: rows of one very frequent value are
    spread over several consecutive ranges instead of one oversized file,
    while each file still covers a narrow interval of ``columns``.  Without
    ``num_files`` the session's shuffle width is used and AQE coalesces
    small ranges, so a table can be laid out in the same pass that builds it.
    """
    cols = list(columns)
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    keys = [*[F.col(c) for c in cols], spread]
    parted = (df.repartitionByRange(num_files, *keys) if num_files
              else df.repartitionByRange(*keys))
    return parted.sortWithinPartitions(*cols)


CURVE_BITS = 6                 # a column's range is cut into 2^bits parts of about equal rows


def curve_layout(df: DataFrame, columns: Sequence[str], num_files: int | None = None, bits: int = CURVE_BITS) -> DataFrame:
    """Range-partition and sort on the Z-order curve of ``columns``, so that a filter on any of them
    skips files, where a plain range sort serves the first column only.

    A column's place on its axis is its number among 2^bits - 1 approximate quantiles (dates, times
    and numbers by value, text by its first six bytes, which keep its order), found by one aggregate over the
    columns alone.  The axes' bits are interleaved into one key.  Nulls come first.  Rows of one
    place are spread by a row hash, so a very frequent value fills several files."""
    cols = list(columns)
    parts = (1 << bits) - 1
    shares = F.array(*[F.lit((i + 1) / (parts + 1)) for i in range(parts)])
    cuts = df.agg(*[F.percentile_approx(_axis(df, c), shares, 10_000).alias(f"c{i}") for i, c in enumerate(cols)])
    bounds = cuts.first()
    key = F.lit(0).cast("long")
    for i, c in enumerate(cols):
        # how many cuts lie at or below the value; a value that several cuts fell on takes all their places
        place = _place(_axis(df, c), list(bounds[i] or []))
        for b in range(bits):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(place, b).bitwiseAND(F.lit(1)).cast("long"), b * len(cols) + i))
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    keyed = df.withColumn("__curve", key)
    ranged = (keyed.repartitionByRange(num_files, F.col("__curve"), spread) if num_files
              else keyed.repartitionByRange(F.col("__curve"), spread))
    return ranged.sortWithinPartitions("__curve", *cols).drop("__curve")


def _place(axis: Column, cuts: list[float]) -> Column:
    """The number of cuts at or below the value; 0 for null."""
    if not cuts:
        return F.lit(0)
    below = F.size(F.filter(F.array(*[F.lit(float(v)) for v in cuts]), lambda v: v <= axis))
    return F.when(axis.isNull(), F.lit(0)).otherwise(below)


def _axis(df: DataFrame, column: str) -> Column:
    """A column's values as doubles in the same order (text: by its first six bytes)."""
    kind, c = df.schema[column].dataType.simpleString(), F.col(column)
    if kind == "string":
        return F.conv(F.rpad(F.substring(F.hex(c.cast("binary")), 1, 12), 12, "0"), 16, 10).cast("double")
    if kind == "date":
        return F.unix_date(c).cast("double")
    if kind in ("timestamp", "boolean"):
        return c.cast("long").cast("double") if kind == "boolean" else F.unix_micros(c).cast("double")
    return c.cast("double")


def delete_by_key(df: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    on = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*on).distinct(), on, "left_anti")
