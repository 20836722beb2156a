"""Collections of nested documents with an ``_id``.

``fmt="mongodb"`` hands all options to Spark's connector. The default is a folder:

    path/v=000000/batch_id=N/row_status=valid|rejected/*.parquet

A batch of a stream is one folder, replaced as a whole when it is replayed. Documents written as a whole, or
new in a merge, lie in buckets by a hash of ``_id``: the folders of the batch numbers below 0. A merge
replaces the folders that hold updated documents and no others. An overwrite writes the next version beside
the present one, so a reader never meets a half-written table; no load or merge may run beside it.

Each folder's schema is noted when it differs from the one before. Folders are read under their noted
schemas, and values cast to the widest type of all, so no file is opened to learn its schema and no folder
is written again because a later one has wider types."""

from __future__ import annotations

import hashlib
import json
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelfstream.functions.nested import object_id
from shelfstream.functions.widening import wider_struct, widened
from shelfstream.operators.contracts import REASON, REJECTED, STATUS, VALID, write_split
from shelfstream.session import materialise
from shelfstream.sources import paths

FILES = "parquet"
BATCH = "batch_id"
RAW = "raw_message"
BUCKETS = 64
CONTROL = {REASON: "string", RAW: "string", BATCH: "int", STATUS: "string"}


class Collection:
    def __init__(
        self, spark: SparkSession, path: str = "", fmt: str = FILES, buckets: int = BUCKETS, **options: str
    ) -> None:
        """``buckets`` holds for a collection that has none yet."""
        self.spark = spark
        self.path = path.rstrip("/")
        self.fmt = fmt
        self.buckets = buckets
        self.options = options

    @property
    def in_files(self) -> bool:
        return self.fmt == FILES

    # -- where things lie -----------------------------------------------------------

    def _version_path(self, version: int) -> str:
        return f"{self.path}/v={version:06d}"

    def version(self) -> int:
        """The newest version whose writing ended; 0 while only batches have come in."""
        names = paths.children(self.spark, self.path)
        done = [
            int(name[2:]) for name in names
            if name.startswith("v=") and paths.exists(self.spark, f"{self.path}/{name}/_SUCCESS")
        ]
        return max(done, default=0)

    def _rejects_path(self) -> str:
        if not self.path:
            raise ValueError("a collection outside the file system needs a path for rejects")
        return f"{self.path}/rejects"

    def _units(self, version: int) -> list[int]:
        """The numbers of the folders of a version: batches, and buckets below 0."""
        names = paths.children(self.spark, self._version_path(version))
        return [int(name.partition("=")[2]) for name in names if name.startswith(f"{BATCH}=")]

    def batch_path(self, batch_id: int) -> str:
        """Where a batch lies, or will lie."""
        return f"{self._version_path(self.version())}/{BATCH}={batch_id}"

    def has_batches(self) -> bool:
        """Whether a stream has written batches that still count."""
        return any(unit >= 0 for unit in self._units(self.version()))

    # -- notes: facts told by names of empty files ----------------------------------

    def _notes(self, version: int) -> list[list[str]]:
        names = paths.children(self.spark, f"{self.path}/notes/{version:06d}")
        return [name.split("~") for name in names]

    def _note(self, version: int, *words: object) -> None:
        name = "~".join(map(str, words))
        paths.put_text(self.spark, f"{self.path}/notes/{version:06d}/{name}", "")

    def _keep_schema(self, schema: T.StructType) -> str:
        """Store a schema under a name made from it."""
        text = schema.json()
        name = hashlib.md5(text.encode()).hexdigest()
        paths.put_text(self.spark, f"{self.path}/schemas/{name}", text)
        return name

    def _schema(self, name: str) -> T.StructType:
        return T.StructType.fromJson(json.loads(paths.get_text(self.spark, f"{self.path}/schemas/{name}")))

    def _schema_names(self, version: int, units: list[int]) -> dict[int, str]:
        """The name of each folder's schema: its own, or that of all buckets, or that of the last batch before
        with a new one."""
        notes = self._notes(version)
        own: dict[int, str] = {}
        for _, unit, name in (n for n in notes if n[0] == "unit"):
            # a merge that did not end may have left two: the one with more fields fits both
            rival = own.get(int(unit), name)
            more = name if name == rival else max(rival, name, key=lambda n: len(self._schema(n).fields))
            own[int(unit)] = more
        since = sorted((int(n[1]), n[2]) for n in notes if n[0] == "since")
        buckets = [n[1] for n in notes if n[0] == "buckets-are"]
        out = {}
        for unit in units:
            earlier = buckets if unit < 0 else [name for first, name in since if first <= unit]
            out[unit] = own.get(unit) or earlier[-1]
        return out

    def schema_before(self, batch_id: int) -> T.StructType:
        """The schema batches had before this one; empty at the start."""
        notes = self._notes(self.version())
        since = sorted((int(n[1]), n[2]) for n in notes if n[0] == "since" and int(n[1]) < batch_id)
        return self._schema(since[-1][1]) if since else T.StructType([])

    # -- reading --------------------------------------------------------------------

    def _rows(self, status: str, keep: Column | None = None) -> DataFrame:
        """Rows of one status with their folder's number, each group of folders under its schema."""
        version = self.version()
        base = self._version_path(version)
        units = self._units(version)
        groups: dict[str, list[int]] = {}
        for unit, name in self._schema_names(version, units).items():
            groups.setdefault(name, []).append(unit)
        schemas = {name: self._schema(name) for name in sorted(groups, key=lambda n: min(groups[n]))}
        whole = reduce(wider_struct, schemas.values(), T.StructType([]))
        parts = []
        for name, schema in schemas.items():
            stored = [f for f in schema.fields if not isinstance(f.dataType, T.NullType)]
            control = [T.StructField(c, T.DataType.fromDDL(t)) for c, t in CONTROL.items()]
            rows = self.spark.read.schema(T.StructType(stored + control)).options(**self.options).parquet(base)
            if len(groups) > 1:
                rows = rows.filter(F.col(BATCH).isin(groups[name]))
            if keep is not None:
                rows = rows.filter(keep)
            types = {f.name: f.dataType for f in schema.fields}
            columns = [
                widened(_named(f.name), types.get(f.name, T.NullType()), f.dataType).alias(f.name)
                for f in whole.fields
            ]
            parts.append(rows.filter(F.col(STATUS) == status).select(*columns, REASON, RAW, BATCH))
        if not parts:
            return self.spark.read.parquet(base)  # nothing was written: the error names the folder
        return reduce(DataFrame.unionByName, parts)

    def read(self) -> DataFrame:
        """The documents. Rejected rows lie in folders that are not opened."""
        if not self.in_files:
            return self.spark.read.format(self.fmt).options(**self.options).load()
        return self._rows(VALID).drop(BATCH, REASON, RAW)

    def rejects(self) -> DataFrame:
        """Rejected rows with ``reject_reason``, and ``raw_message`` where the message text was kept."""
        if not self.in_files:
            return self.spark.read.parquet(self._rejects_path())
        return self._rows(REJECTED)

    # -- writing --------------------------------------------------------------------

    def append(self, df: DataFrame, batch_id: int) -> None:
        """Add one batch. Rows may carry a ``reject_reason``; such rows go to the rejects. Writing the same
        batch again replaces it, unless an overwrite or a merge took it in: then nothing is written."""
        rows = df if REASON in df.columns else df.withColumn(REASON, F.lit(None).cast("string"))
        if self.in_files:
            version = self.version()
            if self._taken_in(version, batch_id):
                return
            schema = T.StructType([f for f in rows.schema.fields if f.name not in CONTROL])
            if schema != self.schema_before(batch_id):
                self._note(version, "since", batch_id, self._keep_schema(schema))
            nothing = [f.name for f in schema.fields if isinstance(f.dataType, T.NullType)]
            write_split(rows.drop(*nothing), f"{self._version_path(version)}/{BATCH}={batch_id}")
            return
        # two sinks: keep the batch, on disk where memory is short, instead of making it twice
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            kept = rows.filter(F.col(REASON).isNull()).drop(REASON, RAW)
            kept.write.format(self.fmt).options(**self.options).mode("append").save()
            bad = rows.filter(F.col(REASON).isNotNull())
            bad.write.mode("overwrite").parquet(f"{self._rejects_path()}/{BATCH}={batch_id}")
        finally:
            rows.unpersist()

    def _taken_in(self, version: int, batch_id: int) -> bool:
        notes = self._notes(version)
        until = max((int(n[1]) for n in notes if n[0] == "until"), default=-1)
        return batch_id <= until or ["taken", str(batch_id)] in notes

    def drop_batch(self, batch_id: int) -> None:
        """Take away the folder of a batch that had no rows."""
        if self.in_files:
            paths.remove_folder(self.spark, self.batch_path(batch_id))

    def _bucket_count(self, version: int) -> int:
        """The number of buckets, noted before the first is written."""
        noted = [int(n[1]) for n in self._notes(version) if n[0] == "buckets"]
        if not noted:
            self._note(version, "buckets", self.buckets)
        return noted[0] if noted else self.buckets

    def _put(self, rows: DataFrame, version: int, **options: str) -> None:
        """Write documents with a folder number, the rows of a folder together."""
        dealt = rows.withColumn(STATUS, F.lit(VALID)).hint("rebalance", F.col(BATCH))
        dealt.write.mode("overwrite").options(**options).partitionBy(BATCH, STATUS).parquet(self._version_path(version))

    def overwrite(self, df: DataFrame) -> None:
        """Replace all documents. Ones without an ``_id`` are given one."""
        if not self.in_files:
            with_object_ids(df).write.format(self.fmt).options(**self.options).mode("overwrite").save()
            return
        now = self.version()
        target = now + 1
        # an unfinished version is written over, a finished one never
        paths.remove_folder(self.spark, f"{self.path}/notes/{target:06d}")
        seen = [int(n[1]) for n in self._notes(now) if n[0] == "until"] + self._units(now)
        self._note(target, "until", max(seen, default=-1))
        rows = with_object_ids(df, target)
        schema = self._keep_schema(rows.schema)
        buckets = self._bucket_count(target)
        self._note(target, "buckets-are", schema)
        self._put(rows.withColumn(BATCH, _bucket(buckets)), target)

    def merge(self, updates: DataFrame, sequence: str | None = None) -> None:
        """Write ``updates`` over the documents of the same ``_id`` field by field, and add the new ones.

        Each update is led to its document's folder, or to its bucket where there is none. These folders alone
        are read and replaced. A merge that did not end is done again from the start: what it wrote stays the
        same under the same updates. An update that widens a stored type writes a new version instead."""
        version = self.version()
        if not self.in_files or not self._units(version):
            stored = [] if self.in_files else [self.read()]
            news = fold_updates(updates, "_id", sequence)
            self.overwrite(merge_folded(*stored, news, ["_id"]) if stored else news)
            return
        stored = self._rows(VALID).drop(REASON, RAW)
        if _widens(stored.schema, updates.schema):
            self.overwrite(merge_documents(stored.drop(BATCH), updates, sequence=sequence))
            return
        buckets = self._bucket_count(version)
        news = fold_updates(updates, "_id", sequence).withColumn(BATCH, _bucket(buckets))
        if self.has_batches():
            in_batches = stored.filter(F.col(BATCH) >= 0).select("_id", F.col(BATCH).alias("_home"))
            news = news.join(in_batches, "_id", "left").withColumn(BATCH, F.coalesce("_home", BATCH)).drop("_home")
        news = materialise(news, "updates")
        touched = [r[0] for r in news.select(BATCH).distinct().collect()]  # numbers of folders
        merged = merge_folded(
            self._rows(VALID, F.col(BATCH).isin(touched)).drop(REASON, RAW), news, ["_id", BATCH]
        )
        name = self._keep_schema(merged.drop(BATCH).schema)
        notes = self._notes(version)
        before = [n for n in notes if n[0] == "unit" and int(n[1]) in touched and n[2] != name]
        for unit in touched:
            if unit >= 0:
                self._note(version, "taken", unit)
            self._note(version, "unit", unit, name)
        self._put(merged, version, partitionOverwriteMode="dynamic")
        for note in before:
            paths.remove(self.spark, f"{self.path}/notes/{version:06d}/{'~'.join(note)}")


def _named(column: str) -> Column:
    return F.col(f"`{column}`")


def _widens(stored: T.StructType, updates: T.StructType) -> bool:
    """Whether updates make a stored field's type wider."""
    both = wider_struct(stored, T.StructType([f for f in updates.fields if f.name in stored.names]))
    return [f.dataType for f in both.fields] != [f.dataType for f in stored.fields]


def _bucket(buckets: int) -> Column:
    """The folder number of a document that came in no batch."""
    return (-1 - F.pmod(F.xxhash64("_id"), F.lit(buckets))).cast("int")


def with_object_ids(df: DataFrame, write: int = 0) -> DataFrame:
    """Ids of a write: f, its number in 7 hex digits, the row in 16."""
    if "_id" in df.columns:
        return df
    row = F.lower(F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0"))
    return df.select(object_id(F.concat(F.lit(f"f{write:07x}"), row)).alias("_id"), "*")


def fold_updates(updates: DataFrame, key: str = "_id", sequence: str | None = None) -> DataFrame:
    """Several updates of one document as one: per field the last non-null value in ``sequence``, or any one
    of them without it."""
    fields = [c for c in updates.columns if c not in (key, sequence)]
    if sequence:
        fold = [F.max_by(_named(c), F.when(_named(c).isNotNull(), F.col(sequence))) for c in fields]
    else:
        fold = [F.any_value(_named(c), True) for c in fields]
    return updates.groupBy(key).agg(*[f.alias(c) for f, c in zip(fold, fields)])


def merge_folded(stored: DataFrame, news: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join on ``keys``; a field that is NULL or absent in the update keeps its stored value."""
    fields = {f.name: f.dataType for f in news.schema.fields if f.name not in keys}
    renamed = news.select(*keys, *[_named(c).alias(f"_new_{c}") for c in fields])
    both = wider_struct(stored.drop(*keys).schema, T.StructType([f for f in news.schema.fields if f.name not in keys]))
    before = {f.name: f.dataType for f in stored.schema.fields}
    columns = []
    for f in both.fields:
        sides = [widened(_named(f"_new_{f.name}"), fields[f.name], f.dataType)] if f.name in fields else []
        sides += [widened(_named(f.name), before[f.name], f.dataType)] if f.name in before else []
        columns.append(F.coalesce(*sides).alias(f.name))
    return stored.join(renamed, keys, "full_outer").select(*keys, *columns)


def merge_documents(
    stored: DataFrame, updates: DataFrame, key: str = "_id", sequence: str | None = None
) -> DataFrame:
    """``stored`` with ``updates`` written over it field by field, and new documents added."""
    return merge_folded(stored, fold_updates(updates, key, sequence), [key])
