"""Parquet tables that are refreshed as a whole and switched over together.

A refresh writes each table into a new folder and then one small list that names
the folders. Readers follow the latest list, so a job that dies half way leaves
the old tables in place. Each list is whole: it takes over what it needs of the
one before, so there are never more than two, however often tables are refreshed.
"""

from __future__ import annotations

import uuid
from collections import Counter
from threading import Lock

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from guestlens.operators.quality import volumes
from guestlens.schemas import TABLES, Table, dependants

_PUBLISHED = "table_name string, folder string, publication bigint, rows bigint"
RUN_LOG = "pipeline_run_log"
ROWS = "rows"

#: Entries of each table that a list of folders takes over: its latest ones.
HISTORY = 32
#: Small files of the run log beyond which it is written anew, and what is small.
LOG_FILES = 64
LOG_FILE_BYTES = 32 << 20


def conform(df: DataFrame, table: Table) -> DataFrame:
    """Columns cast to the table's types, in its order, with the load time set.

    Under ANSI rules a number too big for its type raises here.
    """
    columns: list[Column] = [F.col(c).cast(table.columns[c]).alias(c) for c in table.data_columns]
    if table.stamp:
        now = F.current_timestamp().cast("timestamp_ntz")
        columns.append(now.alias(table.stamp))
    return df.select(*columns)


class Warehouse:
    """The tables under one root folder, which all executors must reach.

    One writer at a time; any number of readers.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        # Two appends to one folder must not commit at the same time.
        self._log_lock = Lock()
        self.metrics: dict[str, dict[str, int]] = {}

    # -- whole-table refresh ------------------------------------------------

    def new_version(self) -> str:
        return uuid.uuid4().hex

    def work_folder(self, version: str, name: str) -> str:
        return f"{self.root}/_work/{version}/{name}"

    def stage(
        self, name: str, df: DataFrame, version: str, metrics: dict[str, str] | None = None
    ) -> DataFrame:
        """Write a table's new content and read it back; not yet visible.

        ``metrics`` are aggregates by name, taken in the same pass and left in
        ``self.metrics[name]`` beside the number of rows.

        The rows of a clustered table are dealt to files by ranges of its columns,
        for which Spark first takes a sample of them: ``df`` should be stored then.
        """
        folder = self._folder(name, version)
        table = TABLES[name]
        rows = conform(df, table)
        if table.clustered:
            rows = rows.repartitionByRange(*table.clustered)
        if order := table.clustered or table.ordered:
            rows = rows.sortWithinPartitions(*order)
        observed = Observation(name)
        taken = {ROWS: "count(*)"} | (metrics or {})
        rows = rows.observe(observed, *[F.expr(text).alias(m) for m, text in taken.items()])
        options = {f"parquet.bloom.filter.enabled#{c}": "true" for c in table.looked_up}
        if options:
            options["parquet.bloom.filter.adaptive.enabled"] = "true"
        rows.write.mode("errorifexists").options(compression="zstd", **options).parquet(folder)
        self.metrics[name] = observed.get
        return self._load(name, folder)

    def staged(self, name: str, version: str) -> DataFrame:
        """A table's content in a version, visible or not."""
        return self._load(name, self._folder(name, version))

    def publish(self, names: list[str], version: str) -> None:
        """Switch to the new content of all ``names`` at once.

        Tables that depend on one of them and are not refreshed along with it
        become empty, as after a cascading truncate.
        """
        cleared = set().union(*[dependants(n) for n in names]) - set(names)
        counted = {n: self.metrics.get(n, {}).get(ROWS) for n in names}
        self._publish([(n, self._folder(n, version), counted[n]) for n in names] + [(n, None, None) for n in sorted(cleared)])

    def _publish(self, entries: list[tuple[str, str | None, int | None]]) -> None:
        """Write the next list: new entries, and each table's latest ones before.

        A reader may be at the list before; older ones are removed.
        """
        lists = self._lists()
        number = 1 + max(lists, default=0)
        rows = [(name, folder, number, n) for name, folder, n in entries]
        taken = Counter(name for name, _, _ in entries)
        for old in self._entries():
            taken[old.table_name] += 1
            if taken[old.table_name] <= HISTORY:
                rows.append(tuple(old))
        new = self.spark.createDataFrame(rows, _PUBLISHED)
        new.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/_published/{number}")
        for old in lists[:-1]:
            self._remove(f"{self.root}/_published/{old}")

    def refresh(self, name: str, df: DataFrame) -> DataFrame:
        """Replace one table and clear its dependants."""
        version = self.new_version()
        new = self.stage(name, df, version)
        self.publish([name], version)
        return new

    # -- reads --------------------------------------------------------------

    def read(self, name: str) -> DataFrame:
        row = self._current().get(name)
        if row is None or row.folder is None:
            return self._empty(name)
        return self._load(name, row.folder)

    def version(self, name: str) -> str | None:
        """The version a published table is in."""
        row = self._current().get(name)
        return row.folder.rsplit("/", 1)[1] if row and row.folder else None

    def volumes(self, tolerance: float = 0.01) -> DataFrame:
        """Rows of each published version of a table, of the latest ``HISTORY``,
        against what its earlier versions let expect."""
        return volumes(self._published().select("table_name", "publication", "rows"), tolerance)

    def register_views(self) -> None:
        """Make every table a temporary view, for plain SQL over the warehouse."""
        for name in TABLES:
            self.read(name).createOrReplaceTempView(name)

    # -- appends ------------------------------------------------------------

    def log(self, *records: dict) -> None:
        """Append rows to the run log, as one file; a record holds columns of that
        table.

        Counts that are not given are zero, and times are now. Once there are more
        than ``LOG_FILES`` small files, the log is written anew in few.
        """
        table = TABLES[RUN_LOG]
        usual = {"bigint": F.lit(0), "timestamp_ntz": F.current_timestamp().cast("timestamp_ntz")}
        rows = []
        for record in records:
            unknown = set(record) - set(table.columns)
            if unknown:
                raise ValueError(f"not columns of {RUN_LOG}: {sorted(unknown)}")
            values = [
                (usual.get(kind, F.lit(None)) if record.get(name) is None else F.lit(record[name])).cast(kind).alias(name)
                for name, kind in table.columns.items()
            ]
            rows.append(F.struct(*values))
        if rows:
            entry = self.spark.range(1).select(F.inline(F.array(*rows)))
            with self._log_lock:
                current = self._current().get(RUN_LOG)
                folder = current.folder if current else self._folder(RUN_LOG, self.new_version())
                entry.coalesce(1).write.mode("append").parquet(folder)
                if not current:
                    self._publish([(RUN_LOG, folder, None)])
                sizes = self._file_sizes(folder)
                if sum(size < LOG_FILE_BYTES for size in sizes) > LOG_FILES:
                    fewer = self._folder(RUN_LOG, self.new_version())
                    whole = self._load(RUN_LOG, folder).coalesce(max(1, sum(sizes) // (2 * LOG_FILE_BYTES)))
                    whole.write.parquet(fewer)
                    self._publish([(RUN_LOG, fewer, None)])

    # -- freeing ------------------------------------------------------------

    def drop_work(self, version: str, *names: str) -> None:
        """Remove intermediate results of a version: those named, or all."""
        for path in [self.work_folder(version, n) for n in names] or [f"{self.root}/_work/{version}"]:
            self._remove(path)

    def expire(self, keep: int = 2) -> None:
        """Free what is not in one of the latest ``keep`` versions of its table.

        Versions that were never published go too, so no run may be under way.
        Only folders of declared tables and of work, below the root, are removed.
        """
        if keep > HISTORY:
            raise ValueError(f"at most {HISTORY} versions are known")
        kept_work = set()
        entries = self._entries()
        for name in TABLES:
            kept = _latest_versions(entries, name, keep)
            if name == "stg_reviews":
                kept_work = kept
            for version in self._children(f"{self.root}/{name}") - kept:
                self._remove(f"{self.root}/{name}/{version}")
        for version in self._children(f"{self.root}/_work") - kept_work:
            self._remove(f"{self.root}/_work/{version}")

    def _path(self, path: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _children(self, folder: str) -> set[str]:
        path, files = self._path(folder)
        return {f.getPath().getName() for f in files.listStatus(path)} if files.exists(path) else set()

    def _file_sizes(self, folder: str) -> list[int]:
        path, files = self._path(folder)
        found = files.listStatus(path) if files.exists(path) else []
        return [f.getLen() for f in found if f.getPath().getName().endswith(".parquet")]

    def _remove(self, folder: str) -> None:
        path, files = self._path(folder)
        files.delete(path, True)

    # -- internals ----------------------------------------------------------

    def _folder(self, name: str, version: str) -> str:
        return f"{self.root}/{name}/{version}"

    def _load(self, name: str, folder: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name].ddl).parquet(folder)

    def _lists(self) -> list[int]:
        """Numbers of the lists of folders that are whole, in order. Each is one
        file, which appears when it is."""
        numbers = (n for n in self._children(f"{self.root}/_published") if n.isdigit())
        return sorted(int(n) for n in numbers if self._file_sizes(f"{self.root}/_published/{n}"))

    def _entries(self) -> list[Row]:
        """The latest list, newest entries first: at most ``HISTORY`` of each table."""
        return sorted(self._published().collect(), key=lambda r: -r.publication)

    def _published(self) -> DataFrame:
        lists = self._lists()
        if not lists:
            return self.spark.createDataFrame([], _PUBLISHED)
        return self.spark.read.schema(_PUBLISHED).parquet(f"{self.root}/_published/{lists[-1]}")

    def _empty(self, name: str) -> DataFrame:
        return self.spark.createDataFrame([], TABLES[name].ddl)

    def _current(self) -> dict[str, Row]:
        """Latest entry per table."""
        return {r.table_name: r for r in reversed(self._entries())}


def _latest_versions(entries: list[Row], name: str, keep: int) -> set[str]:
    """At most ``keep`` versions of the entries, which come newest first."""
    own = dict.fromkeys(r.folder.rsplit("/", 1)[1] for r in entries if r.table_name == name and r.folder)
    return set(list(own)[:keep])


def save_jdbc(df: DataFrame, url: str, table: str, partitions: int = 16, **options: str) -> None:
    """Replace a database table with ``df`` over a bounded number of connections.

    ``truncate`` keeps the table's own definition and constraints.
    """
    # Not coalesce(): that would run the stage before on as few tasks.
    writer = df.repartition(partitions).write.format("jdbc").mode("overwrite")
    settings = {"url": url, "dbtable": table, "truncate": "true", "batchsize": "10000", **options}
    writer.options(**settings).save()
