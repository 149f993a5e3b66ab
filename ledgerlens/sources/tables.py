"""Versioned tables on shared storage: dated (S14, U3, U4) and bucketed by key.

A table is a folder of immutable data folders and numbered manifests.  A
manifest names the folder that holds each part - a business date or a key
bucket - so a load writes the parts it touches and no others.  A commit is one
rename of a finished manifest to the next number, which fails where that number
exists: readers see the old or the new table, and of two loads that touch the
same part one is refused.  Loads of different parts both go through.

A ``BucketedTable`` keeps its rows in Spark's own buckets (one partition
location per bucket), so a join on the key reads the target where it lies:
only the incoming rows are shuffled, and only buckets with a changed key are
written again.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import upsert as upserts
from ..session import ensure_checkpoint_dir


class CommitConflict(RuntimeError):
    """Another load changed one of the parts of this one after it had been read."""


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame as Parquet in the shared checkpoint folder: later reads prune
    columns, push filters and know its size, and no executor is needed for it.
    Nothing reads the shuffles of the write again: they are removed with it."""
    spark = frame.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    removed = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept = spark.conf.get(removed, "false")
    spark.conf.set(removed, "true")
    try:
        frame.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(removed, kept)
    return spark.read.schema(frame.schema).parquet(path)


def observed(frame: DataFrame, **aggregates: Column) -> tuple[DataFrame, Observation]:
    """The frame, and the aggregates of it that the first action over it gathers on the way."""
    seen = Observation()
    return frame.observe(seen, *(c.alias(n) for n, c in aggregates.items())), seen


def action_counts(result: DataFrame) -> tuple[DataFrame, Observation]:
    """``result`` of an upsert, and its rows per action as they are written."""
    return observed(result, **{a.lower(): F.count_if(F.col(upserts.ACTION) == a)
                               for a in ("INSERT", "UPDATE", "NOOP", "DELETE", "KEEP")})


def _columns(frame: DataFrame) -> str:
    """Names and types; whether a column may be null is not the table's concern."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in frame.schema]).json()


# --- manifests --------------------------------------------------------------

@dataclass(frozen=True)
class Manifest:
    number: int = 0
    #: part -> folder under the table
    parts: Mapping[str, str] = field(default_factory=dict)
    schema: str = ""

    def text(self) -> str:
        return json.dumps({"parts": dict(sorted(self.parts.items())), "schema": self.schema})


class VersionedTable:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._hadoop.Path(self.base).getFileSystem(self._conf)

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.base}/{name}")

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def _numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._names("manifests") if n.endswith(".json"))

    def _load(self, number: int) -> Manifest:
        stream = self._fs.open(self._path(f"manifests/{number:010d}.json"))
        try:
            found = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Manifest(number, found["parts"], found["schema"])

    def current(self) -> Manifest | None:
        """The newest manifest, None before the first load."""
        numbers = self._numbers()
        return self._load(numbers[-1]) if numbers else None

    def _publish(self, manifest: Manifest) -> bool:
        """Whether ``manifest`` became its number; nothing changes if that exists."""
        draft = self._path(f"drafts/{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(manifest.text().encode("utf-8")))
        finally:
            out.close()
        self._fs.mkdirs(self._path("manifests"))
        kind = getattr(self._hadoop, "Options$Rename")
        never_over = self.spark.sparkContext._gateway.new_array(kind, 1)
        never_over[0] = kind.NONE
        context = self._hadoop.FileContext.getFileContext(self._path("manifests").toUri(), self._conf)
        try:
            context.rename(draft, self._path(f"manifests/{manifest.number:010d}.json"), never_over)
        except Py4JJavaError as exc:
            if "AlreadyExists" not in exc.java_exception.getClass().getName():
                raise
            self._fs.delete(draft, False)
            return False
        return True

    def commit(self, read: Manifest | None, changed: Mapping[str, str | None], schema: str) -> Manifest:
        """The table with the parts of ``changed`` in their new folders (None: gone).
        ``read`` is the manifest the change was made from."""
        before = read or Manifest()
        while True:
            now = self.current() or Manifest()
            if now.schema and now.schema != schema:
                raise ValueError(f"{self.base}: columns differ from those of the table")
            moved = [p for p in changed if now.parts.get(p) != before.parts.get(p)]
            if moved:
                raise CommitConflict(f"{self.base}: another load changed {sorted(moved)}")
            parts = {p: f for p, f in now.parts.items() if p not in changed} | {
                p: f for p, f in changed.items() if f is not None}
            new = Manifest(now.number + 1, parts, schema)
            if self._publish(new):
                return new

    def expire(self, keep: int = 2) -> list[str]:
        """Deletes all manifests but the newest ``keep`` and the folders that only
        they name; folders no manifest names yet may belong to a running load and stay."""
        numbers = self._numbers()
        old, kept = numbers[:-keep], numbers[-keep:]
        named = {f for n in old for f in self._load(n).parts.values()}
        gone = sorted(named - {f for n in kept for f in self._load(n).parts.values()})
        for folder in gone:
            self._fs.delete(self._path(folder), True)
        for n in old:
            self._fs.delete(self._path(f"manifests/{n:010d}.json"), False)
        return gone

    def _written(self, folder: str, column: str) -> dict[str, str]:
        """Part -> folder of what one write left."""
        prefix = f"{column}="
        return {n.removeprefix(prefix): f"{folder}/{n}" for n in self._names(folder) if n.startswith(prefix)}


# --- dated tables -----------------------------------------------------------

_PART = "part_of"
_NO_DATE = "none"


class DatedTable(VersionedTable):
    """A table with a folder per business date (``none`` for rows without one)."""

    def __init__(self, spark: SparkSession, base: str, date_col: str = "business_date"):
        super().__init__(spark, base)
        self.date_col = date_col

    @staticmethod
    def _name(date) -> str:
        return _NO_DATE if date is None else str(date)

    def dates(self) -> list[str]:
        now = self.current()
        return sorted(now.parts) if now else []

    def read(self, dates: Iterable | None = None, manifest: Manifest | None = None) -> DataFrame | None:
        """The rows of ``dates`` (all if None); other dates are not opened.  None before the first load."""
        now = manifest or self.current()
        if now is None:
            return None
        wanted = now.parts if dates is None else {self._name(d) for d in dates} & now.parts.keys()
        schema = T.StructType.fromJson(json.loads(now.schema))
        folders = [f"{self.base}/{now.parts[p]}" for p in sorted(wanted)]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def replace(self, rows: DataFrame, dates: Iterable, read: Manifest | None = None) -> Manifest:
        """``dates`` hold ``rows`` and nothing else - also where there are none.
        ``read`` is the manifest that ``rows`` were made from, if they were."""
        before = read or self.current()
        if before is not None:
            names = T.StructType.fromJson(json.loads(before.schema)).names
            rows = rows.select(*names) if sorted(names) == sorted(rows.columns) else rows
        touched = {self._name(d) for d in dates}
        folder = f"data/{uuid.uuid4().hex}"
        part = F.coalesce(F.col(self.date_col).cast("date").cast("string"), F.lit(_NO_DATE))
        rows.withColumn(_PART, part).write.partitionBy(_PART).parquet(f"{self.base}/{folder}")
        found = self._written(folder, _PART)
        if found.keys() - touched:
            raise ValueError(f"{self.base}: rows of {sorted(found.keys() - touched)}, which are not replaced")
        return self.commit(before, {p: found.get(p) for p in touched}, _columns(rows))

    def verify(self, date, rows: int) -> None:
        """What the table itself holds for ``date`` after a load."""
        held = self.read([date])
        count = 0 if held is None else held.count()
        if count != rows:
            raise RuntimeError(f"{self.base}: {count} rows of {date} after a load of {rows}")


# --- bucketed tables ----------------------------------------------------------

_BUCKET = "key_bucket"


class BucketedTable(VersionedTable):
    """A table of unique, non-null keys in ``buckets`` buckets of Spark's hash."""

    def __init__(self, spark: SparkSession, base: str, keys: Sequence[str], buckets: int = 16):
        super().__init__(spark, base)
        self.keys, self.buckets = list(keys), buckets

    def bucket(self) -> Column:
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets))

    def aligned(self, rows: DataFrame) -> DataFrame:
        """``rows`` dealt out as the table is: a join on the key then moves neither side."""
        return rows.repartition(self.buckets, *self.keys)

    def read(self, manifest: Manifest | None = None, buckets: Iterable[int] | None = None) -> DataFrame | None:
        """The table with its bucketing known to the planner, None before the first load."""
        now = manifest or self.current()
        if now is None:
            return None
        schema = T.StructType.fromJson(json.loads(now.schema))
        name = "ledgerlens_" + hashlib.md5(f"{self.base} {now.number}".encode(), usedforsecurity=False).hexdigest()
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            keys = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(f"CREATE TABLE {name} ({columns}, {_BUCKET} INT) USING parquet PARTITIONED BY ({_BUCKET}) "
                           f"CLUSTERED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self.base}/data'")
            places = " ".join(f"PARTITION ({_BUCKET}={p}) LOCATION '{self.base}/{f}'" for p, f in now.parts.items())
            if places:
                self.spark.sql(f"ALTER TABLE {name} ADD {places}")
        frame = self.spark.table(name)
        if buckets is not None:
            frame = frame.where(F.col(_BUCKET).isin([int(b) for b in buckets]))
        return frame.drop(_BUCKET)

    def _write(self, rows: DataFrame) -> dict[str, str]:
        folder, name = f"data/{uuid.uuid4().hex}", f"ledgerlens_{uuid.uuid4().hex}"
        rows.withColumn(_BUCKET, self.bucket().cast("int")).write.partitionBy(_BUCKET).bucketBy(
            self.buckets, *self.keys).sortBy(*self.keys).option("path", f"{self.base}/{folder}").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
        return self._written(folder, _BUCKET)

    def load(self, rows: DataFrame) -> Manifest:
        """The whole table anew."""
        before = self.current()
        found = self._write(self.aligned(rows))
        gone = dict.fromkeys(before.parts if before else (), None)
        return self.commit(before, gone | found, _columns(rows))

    def upsert(self, source: DataFrame, change_columns: Mapping[str, object], update_columns: Sequence[str],
               delete_unmatched: bool = False, read: Manifest | None = None) -> dict[str, int]:
        """Merges ``source`` into the table and returns the rows per action.
        ``read`` is the manifest that ``source`` was made from, if it was.

        One pass over keys and changing columns finds the buckets with work;
        only those are read whole and written, in a second pass."""
        before = read or self.current()
        if before is None:
            raise ValueError(f"{self.base}: not loaded yet")

        def labelled(target: DataFrame, rows: DataFrame) -> DataFrame:
            return upserts.upsert(target, self.aligned(rows), self.keys, change_columns, update_columns,
                                  delete_unmatched=delete_unmatched, unique_source=True)

        rows = stored(source, "upsert-source")
        counts = labelled(self.read(before), rows).groupBy(self.bucket().alias("b"), upserts.ACTION).count().collect()
        work = sorted({r.b for r in counts if r[upserts.ACTION] in ("INSERT", "UPDATE", "DELETE")})
        if work:
            mine = labelled(self.read(before, work), rows.where(self.bucket().isin(work)))
            found = self._write(upserts.merged(mine))
            self.commit(before, {str(b): found.get(str(b)) for b in work}, before.schema)
        totals = dict.fromkeys(("INSERT", "UPDATE", "NOOP", "DELETE", "KEEP"), 0)
        for r in counts:
            totals[r[upserts.ACTION]] += r["count"]
        return totals

