"""Tables whose versions are rows: change rows per version, folded into interval rows now and then.

Every change of a table is a write of change rows (``insert``,
``update_preimage``, ``update_postimage``, ``delete``) to the folder of its
version, and every row keeps the identifier it got when it came in. So

* an UPDATE, DELETE or MERGE reads the table once and writes the changed rows;
* the change feed is a read of those folders, in batch or as a stream;
* what two versions differ in is the first and last image of the rows changed
  in between; RESTORE writes that difference backwards;
* a fold turns the changes so far into interval rows ``[_from, _to)``: those
  still open are written anew, closed ones are added once. A version before the
  fold is one predicate on intervals; a later one is the open rows without
  those changed since, and the last image of these.

The state of a version is one commit record of fixed size. No list of data
files is kept or passes the driver. One writer per table is assumed: a version
appears when its folder is renamed into place, so a writer that breaks off
leaves nothing that readers see or the next writer trips over.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millpond.functions.scalars import as_column
from millpond.operators.merge import action_frame, insert_rows, matched_changes, refuse_ambiguous
from millpond.workspace import staged

#: Versions after which the changes are folded.
FOLD_EVERY = 50
#: Version folders that are named one by one; a longer range is filtered from all of them.
NAMED = 200

ROW_ID = ["_born", "_row"]
_SYSTEM = "_born long, _row long, _change_type string, _commit_timestamp timestamp"
_INTERVAL = "_born long, _row long, _from long, _to long"
_COMMIT = (
    "version long, timestamp string, operation string, schema string, ever string, rewritten long, rewritten_before long, "
    "properties map<string,string>, constraints map<string,string>"
)
# fixed values: the types of change rows
INSERT, BEFORE, AFTER, DELETE = "insert", "update_preimage", "update_postimage", "delete"


class SchemaMismatch(ValueError):
    """Rows do not fit the table's columns."""


class ConstraintViolation(ValueError):
    """Rows break a CHECK of the table."""


class VersionConflict(RuntimeError):
    """The version to be written exists already."""


def _struct(columns: list[str], prefix: str = "") -> Column:
    return F.struct(*[F.col(f"{prefix}`{c}`").alias(c) for c in columns])


def _ddl_fields(ddl) -> list[T.StructField]:
    schema = T.StructType.fromDDL(ddl) if isinstance(ddl, str) else ddl
    return [T.StructField(f.name, f.dataType, True) for f in schema.fields]


class VersionedRows:
    """A table of rows in versions, under one folder."""

    def __init__(self, spark: SparkSession, root: str, fold_every: int = FOLD_EVERY):
        self.spark, self.root, self.fold_every = spark, root.rstrip("/"), fold_every
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._version = max(self._numbers("changes", "_commit_version"), default=-1)
        self._fold = max(self._numbers("open", "_fold"), default=-1)
        self._commit = self._record(self._version) if self._version >= 0 else None

    # ---- making tables ----------------------------------------------------------------

    @classmethod
    def _new(cls, spark, root, schema, properties, fold_every) -> VersionedRows:
        made = cls(spark, root, fold_every)
        if made._version >= 0:
            raise VersionConflict(f"a table is under {root}")
        text = T.StructType(_ddl_fields(schema)).json()
        made._commit = {"schema": text, "ever": text, "rewritten": -1, "rewritten_before": -1, "properties": dict(properties or {}), "constraints": {}}
        return made

    @classmethod
    def create(cls, spark: SparkSession, root: str, schema, properties=None, at=None, fold_every=FOLD_EVERY) -> VersionedRows:
        """An empty table as version 0."""
        made = cls._new(spark, root, schema, properties, fold_every)
        made._publish("CREATE TABLE", made._no_changes(), at)
        return made

    @classmethod
    def write(cls, spark: SparkSession, root: str, df: DataFrame, properties=None, at=None, fold_every=FOLD_EVERY) -> VersionedRows:
        """The rows of ``df`` as version 0."""
        made = cls._new(spark, root, df.schema, properties, fold_every)
        made._publish("CREATE TABLE AS SELECT", made._born(df), at)
        return made

    # ---- what there is ------------------------------------------------------------------

    def current_version(self) -> int:
        return self._version

    def schema(self, version: int | None = None) -> T.StructType:
        record = self._commit if version is None else self._record(version)
        return T.StructType.fromJson(json.loads(record["schema"]))

    def properties(self) -> dict[str, str]:
        return dict(self._commit["properties"])

    def history(self) -> DataFrame:
        """One row per version."""
        rows = self.spark.read.schema(_COMMIT).json(f"{self.root}/commits").where(F.col("version") <= self._version)
        return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp"))

    def version_at(self, timestamp: str) -> int:
        """The version that was current at a time."""
        before = self.history().where(F.col("timestamp") <= F.lit(timestamp).cast("timestamp"))
        found = before.agg(F.max("version")).first()[0]
        if found is None:
            raise ValueError(f"no version at {timestamp}")
        return found

    def read(self, version: int | None = None, timestamp: str | None = None) -> DataFrame:
        """The rows of a version: the current one, one by number, or the one at a time."""
        if timestamp is not None:
            version = self.version_at(timestamp)
        return self._rows(version).select(*self.schema(version).names)

    def as_view(self, name: str, version: int | None = None, timestamp: str | None = None) -> str:
        self.read(version, timestamp).createOrReplaceTempView(name)
        return name

    def changes(self, starting_version: int = 0, ending_version: int | None = None) -> DataFrame:
        """Change rows of a closed range of versions, with the present columns."""
        last = self._version if ending_version is None else ending_version
        rows = self._changes(starting_version, min(last, self._version))
        return rows.select(*self.schema().names, "_change_type", "_commit_version", "_commit_timestamp")

    def differing_rows(self, left: int, right: int) -> tuple[DataFrame, DataFrame]:
        """Rows of ``left`` that ``right`` lacks or holds with other values, and the other way round.

        Read from the changes in between alone.
        """
        if left > right:
            new, old = self.differing_rows(right, left)
            return old, new
        net = self._net_changes(left, right)
        old = net.where("before IS NOT NULL").select("before.*").select(*self.schema(left).names)
        return old, net.where("after IS NOT NULL").select("after.*").select(*self.schema(right).names)

    def appended_rows(self, after: int, until: int) -> DataFrame:
        """Rows that came in after one version, up to another, where nothing else changed; refused otherwise."""
        if self._record(until)["rewritten"] > after:
            raise ValueError(f"rows were changed after version {after}, not only appended")
        fresh = self._changes(after + 1, until).where((F.col("_change_type") == INSERT) & (F.col("_born") == F.col("_commit_version")))
        return fresh.select(*self.schema().names)

    # ---- changes -------------------------------------------------------------------------

    def append(self, df: DataFrame, merge_schema: bool = False, properties=None, skip_empty: bool = False, at=None) -> int:
        """Add rows by column name; a column the table lacks is refused, or added with ``merge_schema``."""
        extra = [f for f in _ddl_fields(df.schema) if f.name not in self.schema().names]
        if extra and not merge_schema:
            raise SchemaMismatch(f"unknown columns {[f.name for f in extra]}")
        return self._publish("APPEND", self._born(df), at, added=extra, properties=properties, skip_empty=skip_empty)

    def overwrite(self, df: DataFrame, properties=None, at=None) -> int:
        """Replace all rows; the columns become those of ``df``."""
        known = {f.name: f.dataType for f in T.StructType.fromJson(json.loads(self._commit["ever"])).fields}
        changed = [f.name for f in df.schema.fields if known.get(f.name, f.dataType) != f.dataType]
        if changed:
            raise SchemaMismatch(f"{changed} have another type in this table")
        gone = self._tagged(self._rows(), DELETE)
        return self._publish(
            "OVERWRITE", gone, at, inserts=self._born(df), schema=_ddl_fields(df.schema), properties=properties, rewrites=True
        )

    def update(self, condition: Column | str, assign: dict[str, Column | str], properties=None, at=None) -> int:
        """Set columns where a condition holds; one that holds nowhere makes no version."""
        types = {f.name: f.dataType for f in self.schema().fields}
        if unknown := set(assign) - set(types):
            raise SchemaMismatch(f"unknown columns {sorted(unknown)}")
        columns = [*ROW_ID, *types]
        new = {c: as_column(v).cast(types[c]) for c, v in assign.items()}
        hit = self._rows().where(F.coalesce(as_column(condition), F.lit(False)))
        images = hit.select(
            F.struct(F.lit(BEFORE).alias("_change_type"), *[F.col(f"`{c}`") for c in columns]).alias("a"),
            F.struct(F.lit(AFTER).alias("_change_type"), *[new.get(c, F.col(f"`{c}`")).alias(c) for c in columns]).alias("b"),
        )
        rows = images.select(F.explode(F.array("a", "b")).alias("r")).select("r.*")
        return self._publish("UPDATE", rows, at, rewrites=True, skip_empty=True, properties=properties)

    def delete(self, condition: Column | str, properties=None, at=None) -> int:
        """Remove rows where a condition holds; one that holds nowhere makes no version."""
        hit = self._rows().where(F.coalesce(as_column(condition), F.lit(False)))
        return self._publish("DELETE", self._tagged(hit, DELETE), at, rewrites=True, skip_empty=True, properties=properties)

    def merge(
        self, source: DataFrame, on: list[str], matched=(), not_matched=(), properties=None, at=None, unique: bool = False
    ) -> int:
        """MERGE by ordered clauses; the target is ``t``, the source ``s``. Without effect it makes no version.

        The target is on the left of its joins: a small source is broadcast,
        and a hot key of the target can be split. ``unique`` says that no two
        source rows share a key, as after a grouping by it; otherwise it is checked
        that no two change one row.
        """
        fields = self.schema().fields
        columns, types = [f.name for f in fields], {f.name: f.dataType for f in fields}
        if not_matched and self._never_filled():  # all rows are new, and read only once
            fresh = self._born(insert_rows(None, source, on, not_matched, columns, types))
            return self._publish("MERGE", fresh, at, skip_empty=properties is None, properties=properties)
        source, target = staged(source, "merge-source"), self._rows()
        images = held = None
        if matched:
            unique = unique or refuse_ambiguous(target, source, on, matched, ROW_ID)
            kept, kinds = [*ROW_ID, *columns], types | {c: T.LongType() for c in ROW_ID}
            once = unique and bool(not_matched)
            actions = action_frame(target, source, on, matched, kept, kinds, how="inner", met=once)
            if once:  # the target is joined a single time: its rows met also tell which source rows are not new
                actions = staged(actions, "merge-met")
                held = actions.select(*[F.col(f"pre.`{k}`").alias(k) for k in on]).distinct()
            images = matched_changes(actions, kept)
        fresh = self._born(insert_rows(target, source, on, not_matched, columns, types, held)) if not_matched else None
        if images is None:
            images = fresh
        elif fresh is not None:
            images = images.unionByName(fresh)
        return self._publish(
            "MERGE", images, at, rewrites=bool(matched), skip_empty=properties is None, properties=properties
        )

    def restore(self, version: int, at=None) -> int:
        """Bring back the rows and columns of a version: the changes since then, backwards."""
        then = self._record(version)
        if version == self._version:
            return version
        net = self._net_changes(version, self._version)
        columns = T.StructType.fromJson(json.loads(self._commit["ever"])).names

        def image(kind: str, side: str) -> Column:
            return F.struct(F.lit(kind).alias("_change_type"), *ROW_ID, *[F.col(f"{side}.`{c}`").alias(c) for c in columns])

        images = (
            F.when(F.col("before").isNull(), F.array(image(DELETE, "after")))
            .when(F.col("after").isNull(), F.array(image(INSERT, "before")))
            .otherwise(F.array(image(BEFORE, "after"), image(AFTER, "before")))
        )
        rows = net.select(F.explode(images).alias("r")).select("r.*")
        schema = T.StructType.fromJson(json.loads(then["schema"])).fields
        return self._publish("RESTORE", rows, at, rewrites=True, schema=schema)

    def clone(self, root: str, version: int | None = None, at=None) -> VersionedRows:
        """A table of its own with the rows of a version."""
        return VersionedRows.write(self.spark, root, self.read(version), at=at)

    def add_columns(self, ddl: str, at=None) -> int:
        """New columns, NULL in the rows so far."""
        added = _ddl_fields(ddl)
        if repeated := [f.name for f in added if f.name in self.schema().names]:
            raise SchemaMismatch(f"columns {repeated} exist")
        return self._publish("ADD COLUMNS", self._no_changes(), at, added=added)

    def add_constraint(self, name: str, check: str, at=None) -> int:
        """A CHECK that all rows, present and future, must not fail; unknown counts as failed."""
        if self.read().where(~F.coalesce(F.expr(check), F.lit(False))).take(1):
            raise ConstraintViolation(f"rows fail {name}: {check}")
        return self._publish("ADD CONSTRAINT", self._no_changes(), at, constraints={name: check})

    def set_properties(self, properties: dict[str, str], at=None) -> int:
        return self._publish("SET TBLPROPERTIES", self._no_changes(), at, properties=properties)

    def fold(self, cluster_by: str | None = None) -> None:
        """Turn the changes so far into interval rows, the open ones in ranges of a column if one is named.

        Each run reads the open rows and the changes since the last one. The
        ranges end in the row's identifier, so a hot value spreads over many.
        """
        last, until = self._fold, self._version
        if until == last:
            return
        ever = T.StructType.fromJson(json.loads(self._commit["ever"])).names
        in_order = Window.partitionBy(*ROW_ID).orderBy("_commit_version")
        events = self._changes(last + 1, until).where(F.col("_change_type") != BEFORE).withColumn(
            "_to", F.lead("_commit_version").over(in_order)
        )
        started = events.where(F.col("_change_type") != DELETE).withColumn("_from", F.col("_commit_version"))
        columns = [*ROW_ID, "_from", "_to", *ever]
        closed = started.where("_to IS NOT NULL").select(*columns)
        opened = started.where("_to IS NULL").select(*columns)
        if last >= 0:
            before = self._open()
            touched = self._touched(last + 1, until).groupBy(*ROW_ID).agg(F.min("_commit_version").alias("_end"))
            touched = staged(touched, "fold-touched")
            ended = before.join(touched, ROW_ID, "inner").withColumn("_to", F.col("_end")).select(*columns)
            closed = closed.unionByName(ended)
            opened = opened.unionByName(before.join(touched, ROW_ID, "left_anti").select(*columns))
        for number in self._numbers("closed", "_fold"):
            if number > last:  # of a fold that broke off
                self._remove(f"{self.root}/closed/_fold={number}")
        if cluster_by is not None:
            order = [cluster_by, *ROW_ID]
            opened = opened.repartitionByRange(*order).sortWithinPartitions(*order)
        self._place(closed, f"{self.root}/closed/_fold={until}")
        self._place(opened, f"{self.root}/open/_fold={until}")
        self._fold = until
        for number in self._numbers("open", "_fold"):
            if number < last:  # the one before is kept for those who still read it
                self._remove(f"{self.root}/open/_fold={number}")

    # ---- rows of a version -------------------------------------------------------------------

    def _rows(self, version: int | None = None) -> DataFrame:
        """Rows of a version with their identifiers."""
        record = self._commit if version is None else self._record(version)
        at, names = record["version"], T.StructType.fromJson(json.loads(record["schema"])).names
        columns = [*ROW_ID, *names]
        if at < self._fold:
            ended = self._closed(at).where((F.col("_from") <= at) & (F.col("_to") > at))
            return ended.select(*columns).unionByName(self._open().where(F.col("_from") <= at).select(*columns))
        news = self._changes(self._fold + 1, at)
        fresh = news.where((F.col("_change_type") == INSERT) & (F.col("_born") == F.col("_commit_version")))
        rows = fresh.select(*columns)
        if self._fold >= 0:
            rows = self._open().select(*columns).unionByName(rows)
        if record["rewritten"] <= self._fold:
            return rows  # nothing but inserts since
        if record["rewritten_before"] <= self._fold:  # one version changed rows: each of them once
            touched = self._touched(record["rewritten"], record["rewritten"])
            changed = touched.where(F.col("_change_type") != DELETE).select(*columns)
            return rows.join(touched.select(*ROW_ID), ROW_ID, "left_anti").unionByName(changed)
        touched = self._touched(self._fold + 1, at)
        last = touched.groupBy(*ROW_ID).agg(
            F.max_by(_struct([*names, "_change_type"]), "_commit_version").alias("_last")
        )
        changed = last.where(F.col("_last._change_type") != DELETE).select(*ROW_ID, "_last.*").select(*columns)
        return rows.join(touched.select(*ROW_ID).distinct(), ROW_ID, "left_anti").unionByName(changed)

    def _never_filled(self) -> bool:
        """No version so far brought a row."""
        return self._fold < 0 and self._changes(0, self._version).isEmpty()

    def _touched(self, first: int, last: int) -> DataFrame:
        """Images after a change of rows that were there before it, or had been."""
        after = F.col("_change_type").isin(AFTER, DELETE)
        again = (F.col("_change_type") == INSERT) & (F.col("_born") < F.col("_commit_version"))
        return self._changes(first, last).where(after | again)

    def _net_changes(self, left: int, right: int) -> DataFrame:
        """Rows changed in ``(left, right]`` as they were before and are after, NULL where they were or are not."""
        names = T.StructType.fromJson(json.loads(self._commit["ever"])).names
        rows = self._changes(left + 1, right)
        row, kind, nothing = _struct(names), F.col("_change_type"), F.lit(None)
        was = F.struct(F.when(kind != INSERT, row).otherwise(nothing).alias("row"))
        now = F.struct(F.when(kind != DELETE, row).otherwise(nothing).alias("row"))
        at = F.col("_commit_version")
        net = rows.groupBy(*ROW_ID).agg(
            F.min_by(was, F.when(kind != AFTER, at)).alias("_was"), F.max_by(now, F.when(kind != BEFORE, at)).alias("_now")
        )
        net = net.select(*ROW_ID, F.col("_was.row").alias("before"), F.col("_now.row").alias("after"))
        return net.where(~F.col("before").eqNullSafe(F.col("after")))

    def _changes(self, first: int, last: int) -> DataFrame:
        schema = T.StructType([
            *_ddl_fields(_SYSTEM), *T.StructType.fromJson(json.loads(self._commit["ever"])).fields, T.StructField("_commit_version", T.LongType()),
        ])
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/changes")
        if first > last:
            return self.spark.createDataFrame([], schema)
        if last - first < NAMED:
            return reader.parquet(*[f"{self.root}/changes/_commit_version={v}" for v in range(first, last + 1)])
        return reader.parquet(f"{self.root}/changes").where(F.col("_commit_version").between(first, last))

    def _open(self) -> DataFrame:
        return self.spark.read.schema(self._interval_schema()).parquet(f"{self.root}/open/_fold={self._fold}")

    def _closed(self, at: int) -> DataFrame:
        schema = T.StructType([*self._interval_schema().fields, T.StructField("_fold", T.LongType())])
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/closed")
        return rows.where((F.col("_fold") > at) & (F.col("_fold") <= self._fold))

    def _interval_schema(self) -> T.StructType:
        return T.StructType([*_ddl_fields(_INTERVAL), *T.StructType.fromJson(json.loads(self._commit["ever"])).fields])

    # ---- writing -----------------------------------------------------------------------------

    def _born(self, df: DataFrame) -> DataFrame:
        """New rows with identifiers of the next version."""
        return df.select(
            F.lit(INSERT).alias("_change_type"), F.lit(self._version + 1).cast("long").alias("_born"),
            F.monotonically_increasing_id().alias("_row"), *[F.col(f"`{c}`") for c in df.columns],
        )

    def _tagged(self, rows: DataFrame, kind: str) -> DataFrame:
        return rows.select(F.lit(kind).alias("_change_type"), *[F.col(f"`{c}`") for c in rows.columns])

    def _no_changes(self) -> DataFrame:
        fields = _ddl_fields("_change_type string, _born long, _row long")
        return self.spark.createDataFrame([], T.StructType([*fields, *T.StructType.fromJson(json.loads(self._commit["schema"])).fields]))

    def _publish(
        self, operation: str, rows: DataFrame, at=None, inserts: DataFrame | None = None, added=(), schema=None,
        properties=None, constraints=None, rewrites: bool = False, skip_empty: bool = False,
    ) -> int:
        """Write change rows, check them, and make them the next version."""
        version = self._version + 1
        fields = list(schema) if schema is not None else [*self.schema().fields, *added]
        known = {f.name: f for f in T.StructType.fromJson(json.loads(self._commit["ever"])).fields}
        ever = [*known.values(), *[f for f in fields if f.name not in known]]
        stamp = at or datetime.now(timezone.utc).isoformat(sep=" ")
        checks = self._commit["constraints"] | (constraints or {})
        types = {f.name: f.dataType for f in ever}

        def shaped(part: DataFrame) -> DataFrame:
            data = [F.col(f"`{c}`").cast(types[c]).alias(c) for c in part.columns if c in types]
            return part.select("_change_type", *ROW_ID, F.lit(stamp).cast("timestamp").alias("_commit_timestamp"), *data)

        draft = f"{self.root}/_drafts/{uuid.uuid4().hex}"
        shaped(rows).write.parquet(draft)
        if inserts is not None:
            shaped(inserts).write.mode("append").parquet(draft)
        system = _ddl_fields(_SYSTEM)
        written = self.spark.read.schema(T.StructType([*system, *ever])).parquet(draft)
        if skip_empty and written.isEmpty():
            self._remove(draft)
            return self._version
        for name, check in self._commit["constraints"].items():
            bad = F.col("_change_type").isin(INSERT, AFTER) & ~F.coalesce(F.expr(check), F.lit(False))
            if written.where(bad).take(1):
                self._remove(draft)
                raise ConstraintViolation(f"rows fail {name}: {check}")
        record = {
            "version": version, "timestamp": stamp, "operation": operation,
            "schema": T.StructType(fields).json(), "ever": T.StructType(ever).json(),
            # the last two versions that changed rows which were there before
            "rewritten": version if rewrites else self._commit["rewritten"],
            "rewritten_before": self._commit["rewritten" if rewrites else "rewritten_before"],
            "properties": self._commit["properties"] | {k: str(v) for k, v in (properties or {}).items()}, "constraints": checks,
        }
        target = f"{self.root}/changes/_commit_version={version}"
        if self._fs.exists(self._path(target)):
            self._remove(draft)
            raise VersionConflict(f"version {version} exists")
        self._save(f"{self.root}/commits/{version:012d}.json", json.dumps(record))
        self._rename(draft, target)
        self._version, self._commit = version, record
        if version - max(self._fold, 0) >= self.fold_every:
            self.fold()
        return version

    def _place(self, rows: DataFrame, target: str) -> None:
        """Write rows beside a folder, then rename them into it."""
        draft = f"{self.root}/_drafts/{uuid.uuid4().hex}"
        rows.write.parquet(draft)
        self._rename(draft, target)

    # ---- files ---------------------------------------------------------------------------------

    def _path(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def _numbers(self, folder: str, key: str) -> list[int]:
        """The numbers in the names ``key=n`` of a folder."""
        at = self._path(f"{self.root}/{folder}")
        if not self._fs.exists(at):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(at)]
        return [int(name.removeprefix(f"{key}=")) for name in names if name.startswith(f"{key}=")]

    def _record(self, version: int) -> dict:
        if not 0 <= version <= self._version:
            raise ValueError(f"no version {version}")
        stream = self._fs.open(self._path(f"{self.root}/commits/{version:012d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _save(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def _rename(self, draft: str, target: str) -> None:
        self._fs.mkdirs(self._path(target).getParent())
        if not self._fs.rename(self._path(draft), self._path(target)):
            raise VersionConflict(f"{target} cannot be put in place")

    def _remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def as_change_stream(table: VersionedRows, starting_version: int = 0, configure: Callable | None = None) -> DataFrame:
    """All change rows from a version on, as a stream of the files that make the versions.

    A version's folder appears at once and never changes, so each row comes
    exactly once, in order of arrival.
    """
    schema = T.StructType([
        *_ddl_fields(_SYSTEM), *table.schema().fields, T.StructField("_commit_version", T.LongType()),
    ])
    reader = table.spark.readStream.schema(schema).option("maxFileAge", "36500d")
    if configure is not None:
        reader = configure(reader)
    rows = reader.parquet(f"{table.root}/changes").where(F.col("_commit_version") >= starting_version)
    return rows.select(*table.schema().names, "_change_type", "_commit_version", "_commit_timestamp")
