"""Versioned tables over plain Parquet folders.

Under the table root::

    data/<commit>/part-*.parquet        immutable rows
    changes/<commit>/                   change rows, only while the feed is on
    commits/v=<n>/                      one JSON line per version, written last

A version exists once its ``commits`` row exists; everything else an
interrupted operation leaves behind is never read and is found by ``vacuum``.
One writer at a time: a second commit of the same number fails.

A commit row lists the live data folders, and file names only for folders of
which some files were rewritten later. So its size follows the number of
loads and rewritten files, not the number of rows, and the driver never
handles more than file names.
"""

from __future__ import annotations

import json
import math
import uuid
from collections import defaultdict
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millpond.functions.scalars import as_column
from millpond.operators import merge as M
from millpond.workspace import staged

COMMIT_SCHEMA = (
    "version long, timestamp timestamp, operation string, parameters map<string,string>, "
    "schema string, files array<struct<folder: string, names: array<string>>>, changes string, "
    "properties map<string,string>, constraints map<string,string>"
)

FEED_PROPERTY = "enableChangeDataFeed"
RETENTION_PROPERTY = "deletedFileRetentionHours"
DEFAULT_RETENTION_HOURS = 168
TARGET_FILE_BYTES = 128 * 1024 * 1024


# data folder -> names of its live files, None for all of them
Files = dict[str, list[str] | None]


class SchemaMismatch(ValueError):
    """The rows to write do not fit the table's columns."""


class ConstraintViolation(ValueError):
    """Some row to write breaks a CHECK or NOT NULL rule."""


def _string_map(values: dict[str, str]) -> Column:
    return F.from_json(F.lit(json.dumps(values)), "map<string,string>")


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


class SnapshotTable:
    """A table whose every change makes a new numbered version."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._commits: dict[int, Row] = {}  # a written commit row never changes

    # ---- creation -----------------------------------------------------

    @classmethod
    def create(cls, spark, root, schema, properties=None, at=None) -> SnapshotTable:
        """Version 0 with typed columns and no rows."""
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        table = cls(spark, root)
        table._publish(0, "CREATE TABLE", {}, schema, {}, properties=properties or {}, at=at)
        return table

    @classmethod
    def write(cls, spark, root, df: DataFrame, properties=None, at=None) -> SnapshotTable:
        """Version 0 holding ``df`` (create table as select)."""
        table = cls(spark, root)
        schema = _nullable(df.schema)
        commit_id = table._commit_id(0)
        at = at or _now()
        properties = properties or {}
        files = table._write_rows(df, commit_id)
        changes = None
        if properties.get(FEED_PROPERTY) == "true":
            changes = table._write_changes(commit_id, 0, at, _tagged(table._scan(files, schema), "insert"))
        table._publish(
            0, "CREATE TABLE AS SELECT", {}, schema, files,
            changes=changes, properties=properties, at=at,
        )
        return table

    # ---- versions -----------------------------------------------------

    def history(self, first: int | None = None, last: int | None = None) -> DataFrame:
        """One row per version; with bounds (both included) only those commits are read."""
        rows = self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.root}/commits")
        if first is not None:
            rows = rows.where(F.col("v") >= first)
        if last is not None:
            rows = rows.where(F.col("v") <= last)
        return rows.drop("v")

    def commit(self, version: int | None = None, timestamp: str | None = None) -> Row:
        """The commit row of a version, of the last one up to a time, or the latest."""
        if timestamp is not None:
            until = self.history().where(F.col("timestamp") <= F.lit(timestamp).cast("timestamp"))
            version = until.agg(F.max("version")).first()[0]
            if version is None:
                raise LookupError(f"no version of {self.root} up to {timestamp}")
        if version is None:
            version = self.current_version()
        if version not in self._commits:
            try:
                rows = self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.root}/commits/v={version}")
            except AnalysisException as missing:
                raise LookupError(f"no version {version} of {self.root}") from missing
            self._commits[version] = rows.first()
        return self._commits[version]

    def current_version(self) -> int:
        """The highest committed number, from the listing of the commits alone."""
        files = self.spark.read.text(f"{self.root}/commits").inputFiles()
        return max(int(path.rsplit("/v=", 1)[1].split("/")[0]) for path in files)

    def schema(self, version: int | None = None) -> T.StructType:
        return _schema_of(self.commit(version))

    def read(self, version: int | None = None, timestamp: str | None = None) -> DataFrame:
        """Rows of the latest version, of a numbered one, or of the one valid at a time."""
        at = self.commit(version, timestamp)
        return self._scan(_files_of(at), _schema_of(at))

    def as_view(self, name: str, version: int | None = None, timestamp: str | None = None) -> str:
        """A temporary view of one version, for SQL text."""
        self.read(version, timestamp).createOrReplaceTempView(name)
        return name

    def detail(self) -> DataFrame:
        """Location, number of files, bytes and properties of the latest version."""
        now = self.commit()
        return (
            self._listing(self._paths(_files_of(now)))
            .agg(F.count("*").alias("num_files"), F.coalesce(F.sum("size"), F.lit(0)).alias("size_in_bytes"))
            .select(
                F.lit("parquet").alias("format"),
                F.lit(self.root).alias("location"),
                F.lit(now.version).alias("version"),
                "num_files",
                "size_in_bytes",
                _string_map(now.properties).alias("properties"),
                _string_map(now.constraints).alias("constraints"),
            )
        )

    def describe(self) -> DataFrame:
        """Column names and types of the latest version."""
        fields = [(f.name, f.dataType.simpleString(), f.nullable) for f in self.schema().fields]
        return self.spark.createDataFrame(fields, "col_name string, data_type string, nullable boolean")

    # ---- writes -------------------------------------------------------

    def append(
        self, df: DataFrame, merge_schema: bool = False, skip_empty: bool = False, properties=None, at=None
    ) -> int:
        """Add rows. New columns are refused unless ``merge_schema`` widens the table.

        With ``skip_empty`` an append without rows makes no version.
        ``properties`` are set by the same commit.
        """
        now = self.commit()
        schema = _schema_of(now)
        have = {f.name: f.dataType for f in schema.fields}
        extra = [f for f in df.schema.fields if f.name not in have]
        if extra and not merge_schema:
            raise SchemaMismatch(f"columns not in the table: {[f.name for f in extra]}")
        for field in df.schema.fields:
            if field.name in have and field.dataType != have[field.name]:
                raise SchemaMismatch(
                    f"{field.name}: {field.dataType.simpleString()} is not {have[field.name].simpleString()}"
                )
        if extra:
            schema = T.StructType(schema.fields + _nullable(T.StructType(extra)).fields)
        rows = df.select(*[
            F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ])
        images = (lambda written: _tagged(written, "insert")) if self._feed_on(now) else None
        params = {"mergeSchema": str(merge_schema).lower()}
        return self._replace_files(
            now, _files_of(now), rows, images, "APPEND", params, at, schema, skip_empty=skip_empty, properties=properties
        )

    def overwrite(self, df: DataFrame, properties=None, at=None) -> int:
        """Replace all rows (and columns); earlier versions stay readable."""
        now = self.commit()
        schema = _nullable(df.schema)
        gone = self._scan(_files_of(now), _schema_of(now))

        def images(written):
            added = _tagged(written, "insert")
            return _tagged(gone, "delete").unionByName(added, allowMissingColumns=True)

        return self._replace_files(
            now, {}, df, images if self._feed_on(now) else None, "WRITE", {"mode": "overwrite"}, at, schema,
            properties=properties,
        )

    def update(self, condition: Column | str, assign: dict[str, Column | str], at=None) -> int:
        """SET columns where the condition is true, rewriting only the files that hold such rows."""
        now = self.commit()
        schema = _schema_of(now)
        hit = F.coalesce(as_column(condition), F.lit(False))
        _refuse_unknown(assign, schema)
        touched, untouched = self._divide(now, hit)
        if not touched:
            return now.version
        rows = self._scan(touched, schema)
        new = {
            f.name: (as_column(assign[f.name]).cast(f.dataType) if f.name in assign else F.col(f.name))
            for f in schema.fields
        }
        params = {"predicate": str(condition)}
        if not self._feed_on(now):
            kept = rows.select(*[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) for c in rows.columns])
            return self._replace_files(now, untouched, kept, None, "UPDATE", params, at)

        def image(kind, values):
            return F.struct(F.lit(kind).alias("_change_type"), *[values[c].alias(c) for c in rows.columns])

        old = {c: F.col(c) for c in rows.columns}
        images = rows.where(hit).select(
            F.explode(F.array(image("update_preimage", old), image("update_postimage", new))).alias("r")
        ).select("r.*")
        # the table takes its new values from the written change rows, so both always agree
        return self._replace_files(
            now, untouched, rows.where(~hit), images, "UPDATE", params, at, take_back="update_postimage"
        )

    def delete(self, condition: Column | str, at=None) -> int:
        """Remove rows where the condition is true; NULL keeps the row."""
        now = self.commit()
        hit = F.coalesce(as_column(condition), F.lit(False))
        touched, untouched = self._divide(now, hit)
        if not touched:
            return now.version
        rows = self._scan(touched, _schema_of(now))
        gone = _tagged(rows.where(hit), "delete") if self._feed_on(now) else None
        return self._replace_files(
            now, untouched, rows.where(~hit), gone, "DELETE", {"predicate": str(condition)}, at
        )

    def merge(
        self, source: DataFrame, on: list[str], matched=(), not_matched=(), properties=None, at=None
    ) -> int:
        """MERGE INTO: first matching clause per row, see :mod:`millpond.operators.merge`.

        Only files with a row to change are rewritten; inserts become new files.
        """
        now = self.commit()
        schema = _schema_of(now)
        columns = [f.name for f in schema.fields]
        types = {f.name: f.dataType for f in schema.fields}
        for given in [*(c.assign for c in matched), *(c.values for c in not_matched)]:
            _refuse_unknown(given or {}, schema)
        source = staged(source, "merge-source")
        live = _files_of(now)
        touched, untouched = {}, live
        kept = images = held = None
        if matched and live:
            target = self._identified(live, schema)
            unique = M.refuse_ambiguous(target, source, on, matched, ["_file", "_position"])
            if unique and not_matched:  # one pass over the target's keys serves both kinds of clause
                pairs = staged(M.known_pairs(target, source, on, matched), "merge-pairs")
                held = pairs.select(*on).distinct()
                hits = pairs.where("clause IS NOT NULL").select("_file")
            else:
                hits = M.acting_pairs(target, source, on, matched, "inner").select("t._file")
            touched, untouched = self._split_off(live, hits)
        if touched:
            actions = M.action_frame(self._scan(touched, schema), source, on, matched, columns, types)
            if self._feed_on(now):
                actions = staged(actions, "merge-actions")
                images = M.matched_changes(actions, columns)
            kept = M.kept_rows(actions)
        if not_matched:
            fresh = M.insert_rows(self._scan(live, schema), source, on, not_matched, columns, types, held)
            if self._feed_on(now):
                fresh = staged(fresh, "merge-inserts")
                inserted = _tagged(fresh, "insert")
                images = inserted if images is None else images.unionByName(inserted)
            kept = fresh if kept is None else kept.unionByName(fresh)
        if kept is None:
            return now.version
        return self._replace_files(
            now, untouched, kept, images, "MERGE", {"on": ",".join(on)}, at, properties=properties
        )

    # ---- schema, rules, properties -------------------------------------

    def add_columns(self, ddl: str, at=None) -> int:
        """Add typed columns; old rows read them as NULL and no file is rewritten."""
        now = self.commit()
        schema = _schema_of(now)
        added = T.StructType.fromDDL(ddl)
        clash = set(added.names) & set(schema.names)
        if clash:
            raise SchemaMismatch(f"columns exist already: {sorted(clash)}")
        wider = T.StructType(schema.fields + _nullable(added).fields)
        return self._republish(now, "ADD COLUMNS", {"columns": ddl}, schema=wider, at=at)

    def add_constraint(self, name: str, check: str, at=None) -> int:
        """Add a CHECK rule; rows already in the table must satisfy it."""
        now = self.commit()
        self._enforce(self.read(), {name: check})
        return self._republish(
            now, "ADD CONSTRAINT", {"name": name, "expr": check},
            constraints={**now.constraints, name: check}, at=at,
        )

    def set_properties(self, properties: dict[str, str], at=None) -> int:
        now = self.commit()
        return self._republish(
            now, "SET TBLPROPERTIES", properties, properties={**now.properties, **properties}, at=at
        )

    # ---- time travel ---------------------------------------------------

    def restore(self, version: int, at=None) -> int:
        """A new version with the rows of an old one. No data file is written."""
        now, old = self.commit(), self.commit(version)
        changes, at = None, at or _now()
        if self._feed_on(now):
            mine, theirs = self.differing_rows(now.version, version)
            mine, theirs = _widened(mine, theirs.schema), _widened(theirs, mine.schema)
            theirs = theirs.select(*mine.columns)
            rows = _tagged(mine.exceptAll(theirs), "delete").unionByName(_tagged(theirs.exceptAll(mine), "insert"))
            changes = self._write_changes(self._commit_id(now.version + 1), now.version + 1, at, rows)
        return self._republish(
            now, "RESTORE", {"version": version},
            schema=_schema_of(old), files=_files_of(old), changes=changes, at=at,
        )

    def clone(self, root: str, version: int | None = None, at=None) -> SnapshotTable:
        """A new, independent table filled from one version of this one."""
        return SnapshotTable.write(self.spark, root, self.read(version), at=at)

    def appended_rows(self, after: int, until: int) -> DataFrame:
        """Rows that appends (or the first write) brought in versions ``after`` < v <= ``until``.

        Version 0 counts when ``after`` is 0, so that a first run starts with everything.
        Versions that only rewrite or remove rows add none. One that may add
        rows in another way is refused, since its new rows cannot be told from
        rewritten ones by file.
        """
        first = 0 if after == 0 else after + 1
        commits = self.history(max(first - 1, 0), until).select("version", "operation", "files")
        folders: Files = {}
        known: Files = {}
        for row in commits.orderBy("version").collect():
            files = _files_of(row)
            added = {f: None for f in files if f not in known}
            if row.version >= first and added and row.operation not in ("UPDATE", "DELETE", "OPTIMIZE"):
                if row.operation not in ("APPEND", "CREATE TABLE AS SELECT"):
                    raise ValueError(f"version {row.version} is a {row.operation}, not an append")
                folders |= added
            known = files
        return self._scan(folders, self.schema(until))

    def differing_rows(self, left: int, right: int) -> tuple[DataFrame, DataFrame]:
        """Rows of the files that only one of two versions holds.

        Files shared by both versions hold the same rows, so a row diff never
        needs to read them.
        """
        a, b = self.commit(left), self.commit(right)
        files_a, files_b = _files_of(a), _files_of(b)
        return (
            self._scan(self._minus(files_a, files_b), _schema_of(a)),
            self._scan(self._minus(files_b, files_a), _schema_of(b)),
        )

    # ---- layout ---------------------------------------------------------

    def optimize(self, cluster_by: str | None = None, target_bytes: int = TARGET_FILE_BYTES, at=None) -> int:
        """Rewrite into files of about ``target_bytes``; rows stay the same.

        With ``cluster_by`` all rows are ranged by that column. The range key
        ends in the row's position, so one hot value spreads over many files.
        Without it only files below the target are packed together.
        """
        now = self.commit()
        live, schema = _files_of(now), _schema_of(now)
        stored = self._listing(self._paths(live))
        if cluster_by is None:
            stored = stored.where(F.col("size") < target_bytes)
        files, total = stored.agg(F.count("*"), F.sum("size")).first()
        if files < (2 if cluster_by is None else 1):
            return now.version
        parts = max(1, math.ceil(total / target_bytes))
        if cluster_by is None:
            packed, others = self._split_off(live, stored.select("path"))
            rows = self._scan(packed, schema).coalesce(parts)  # the scan packs small files, no shuffle
        else:
            others = {}
            rows = (
                self._identified(live, schema)
                .repartitionByRange(parts, F.col(cluster_by), F.xxhash64("_file", "_position"))
                .sortWithinPartitions(cluster_by)
                .select(*schema.names)
            )
        return self._replace_files(now, others, rows, None, "OPTIMIZE", {"clusterBy": cluster_by or ""}, at)

    def vacuum_candidates(self, retain_hours: float | None = None) -> DataFrame:
        """Data files that no version inside the retention window refers to."""
        now = self.commit()
        if retain_hours is None:
            retain_hours = float(now.properties.get(RETENTION_PROPERTY, DEFAULT_RETENTION_HOURS))
        cut = F.expr(f"current_timestamp() - make_dt_interval(0, 0, 0, {float(retain_hours) * 3600})")
        commits = self.history().withColumn("recent", F.col("timestamp") >= cut)
        # the version valid when the window opens is still readable inside it
        opening = commits.where(~F.col("recent")).agg(F.max("version")).first()[0]
        kept = commits.where(F.col("recent") | (F.col("version") == F.lit(opening))).select(
            F.explode("files").alias("f")
        )
        whole = kept.where("f.names IS NULL").select("f.folder").distinct()
        single = kept.select("f.folder", F.explode("f.names").alias("name")).distinct()
        if commits.where(F.size("files") > 0).isEmpty():
            return self._listing([])
        return (
            self._listing([f"{self.root}/data"])
            .where(F.col("modificationTime") < cut)
            .withColumns({
                "folder": F.substring_index("path", "/", 1), "name": F.substring_index("path", "/", -1)
            })
            .join(whole, "folder", "left_anti")
            .join(single, ["folder", "name"], "left_anti")
            .drop("folder", "name")
        )

    def vacuum(self, retain_hours: float | None = None, dry_run: bool = False, force: bool = False) -> DataFrame:
        """Delete unreferenced data files in parallel tasks; ``dry_run`` only lists them.

        A window below the default must be forced, since it can break readers
        of older versions.
        """
        if retain_hours is not None and retain_hours < DEFAULT_RETENTION_HOURS and not force:
            raise ValueError(f"retention below {DEFAULT_RETENTION_HOURS} hours needs force=True")
        found = self.vacuum_candidates(retain_hours)
        if dry_run:
            return found
        doomed = staged(found, "vacuum")
        base = f"{self.root}/data/"

        def remove(rows):
            from pyarrow import fs

            for row in rows:
                uri = base + row.path
                store, path = fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")
                if store.get_file_info(path).type != fs.FileType.NotFound:
                    store.delete_file(path)

        doomed.foreachPartition(remove)
        return doomed

    # ---- change feed ----------------------------------------------------

    def changes(self, starting_version: int = 0, ending_version: int | None = None) -> DataFrame:
        """Change rows of committed versions, both ends included."""
        rows = self.history(starting_version, ending_version).where("changes IS NOT NULL")
        folders = [r.changes for r in rows.select("changes").collect()]
        return self.change_rows(folders)

    def change_rows(self, folders: list[str]) -> DataFrame:
        schema = _feed_schema(self.schema())
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/changes/{f}" for f in folders])

    # ---- internals --------------------------------------------------------

    def _commit_id(self, version: int) -> str:
        return f"{version:010d}-{uuid.uuid4().hex[:8]}"

    def _feed_on(self, commit: Row) -> bool:
        return commit.properties.get(FEED_PROPERTY) == "true"

    def _paths(self, files: Files) -> list[str]:
        """Whole folders as folders, others file by file."""
        paths = []
        for folder, names in files.items():
            paths += [folder] if names is None else [f"{folder}/{n}" for n in names]
        return [f"{self.root}/data/{p}" for p in paths]

    def _names(self, folder: str, names: list[str] | None) -> set[str]:
        """File names of a folder, listed by Spark if the commit does not spell them out."""
        if names is not None:
            return set(names)
        found = self.spark.read.schema("_ int").parquet(f"{self.root}/data/{folder}").inputFiles()
        return {path.rsplit("/", 1)[1] for path in found}

    def _minus(self, files: Files, other: Files) -> Files:
        """Files of the first that the second does not hold."""
        left: Files = {}
        for folder, names in files.items():
            if folder not in other:
                left[folder] = names
            elif names != other[folder] and other[folder] is not None:
                rest = self._names(folder, names) - set(other[folder])
                if rest:
                    left[folder] = sorted(rest)
        return left

    def _scan(self, files: Files, schema: T.StructType) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], _nullable(schema))
        return self.spark.read.schema(schema).parquet(*self._paths(files))

    def _identified(self, files: Files, schema) -> DataFrame:
        """Rows with the file and the position they come from."""
        return self._scan(files, schema).select(
            "*",
            F.regexp_extract("_metadata.file_path", "/data/([^/]+/[^/]+)$", 1).alias("_file"),
            F.col("_metadata.row_index").alias("_position"),
        )

    def _divide(self, commit: Row, hit: Column) -> tuple[Files, Files]:
        """Live files with a row to change, and the others."""
        files = _files_of(commit)
        if not files:
            return {}, {}
        rows = self._scan(files, _schema_of(commit)).where(hit)
        return self._split_off(
            files, rows.select(F.regexp_extract("_metadata.file_path", "/data/([^/]+/[^/]+)$", 1))
        )

    def _split_off(self, files: Files, paths: DataFrame) -> tuple[Files, Files]:
        """Divide files into those whose ``folder/name`` is in the one column of ``paths``, and the others."""
        by_folder = defaultdict(set)
        for row in paths.distinct().collect():
            folder, name = row[0].split("/")
            by_folder[folder].add(name)
        inside: Files = {}
        outside: Files = dict(files)
        for folder, chosen in by_folder.items():
            rest = self._names(folder, files[folder]) - chosen
            inside[folder] = sorted(chosen) if rest else files[folder]
            if rest:
                outside[folder] = sorted(rest)
            else:
                del outside[folder]
        return inside, outside

    def _listing(self, paths: list[str]) -> DataFrame:
        """``folder/name``, size and time of the Parquet files under the paths, unread."""
        if not paths:
            return self.spark.createDataFrame([], "path string, size long, modificationTime timestamp")
        return (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .load(paths)
            .select(
                F.regexp_extract("path", "([^/]+/[^/]+)$", 1).alias("path"),
                F.col("length").alias("size"),
                "modificationTime",
            )
        )

    def _write_rows(self, df: DataFrame, commit_id: str) -> Files:
        df.write.parquet(f"{self.root}/data/{commit_id}")
        return {commit_id: None}

    def _write_changes(self, commit_id: str, version: int, at: str, rows: DataFrame) -> str:
        rows.withColumn("_commit_version", F.lit(version).cast("long")).withColumn(
            "_commit_timestamp", F.lit(at).cast("timestamp")
        ).write.parquet(f"{self.root}/changes/{commit_id}")
        return commit_id

    def _enforce(self, rows: DataFrame, constraints: dict[str, str], schema=None) -> None:
        """Raise if a row makes a CHECK false, or is NULL in a NOT NULL column."""
        rules = {name: F.coalesce(F.expr(check), F.lit(True)) for name, check in constraints.items()}
        for field in schema.fields if schema else []:
            if not field.nullable:
                rules[f"{field.name} NOT NULL"] = F.col(field.name).isNotNull()
        broken = F.lit(None).cast("string")
        for name, passes in rules.items():
            broken = F.when(~passes, F.lit(name)).otherwise(broken)
        found = rows.select(broken.alias("rule")).where("rule IS NOT NULL").take(1) if rules else []
        if found:
            raise ConstraintViolation(f"a row breaks {found[0].rule}")

    def _replace_files(
        self, now: Row, keep: Files, rows, images, operation, params, at,
        schema=None, take_back: str | None = None, skip_empty: bool = False, properties=None,
    ) -> int:
        """Write rows, check them, then publish them with the files to keep as the next version.

        ``images`` are the change rows, or a function from the written rows to
        them. ``take_back`` names the change type whose rows belong in the table.
        """
        version = now.version + 1
        schema = schema or _schema_of(now)
        commit_id, at = self._commit_id(version), at or _now()
        changes = None
        if images is not None and not callable(images):
            changes = self._write_changes(commit_id, version, at, images)
        if take_back:
            written = self.spark.read.schema(_feed_schema(schema)).parquet(f"{self.root}/changes/{commit_id}")
            rows = rows.unionByName(written.where(F.col("_change_type") == take_back).select(*rows.columns))
        files = self._write_rows(rows, commit_id)
        fresh = self._scan(files, _nullable(schema))
        if skip_empty and fresh.isEmpty():
            return now.version
        self._enforce(fresh, now.constraints, schema)
        if callable(images):
            changes = self._write_changes(commit_id, version, at, images(fresh))
        self._publish(
            version, operation, params, schema, {**keep, **files}, changes=changes,
            properties={**now.properties, **(properties or {})}, constraints=now.constraints, at=at,
        )
        return version

    def _republish(self, now: Row, operation, params, at=None, **fields) -> int:
        """A version that changes only what the commit row says."""
        state = {
            "schema": _schema_of(now), "files": _files_of(now), "changes": None,
            "properties": now.properties, "constraints": now.constraints, **fields,
        }
        self._publish(now.version + 1, operation, params, at=at, **state)
        return now.version + 1

    def _publish(
        self, version, operation, params, schema, files: Files,
        changes=None, properties=None, constraints=None, at=None,
    ) -> None:
        state = {
            "version": version,
            "timestamp": at or _now(),
            "operation": operation,
            "parameters": {k: str(v) for k, v in params.items()},
            "schema": schema.json(),
            "files": [{"folder": k, "names": v} for k, v in files.items()],
            "changes": changes,
            "properties": {k: str(v) for k, v in (properties or {}).items()},
            "constraints": constraints or {},
        }
        line = self.spark.range(0, 1, 1, 1).select(F.lit(json.dumps(state)).alias("value"))
        line.write.mode("error").text(f"{self.root}/commits/v={version}")
        self._commits[version] = Row(**{**state, "files": [Row(**entry) for entry in state["files"]]})


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def _files_of(commit: Row) -> Files:
    return {f.folder: f.names for f in commit.files}


def _schema_of(commit: Row) -> T.StructType:
    return T.StructType.fromJson(json.loads(commit.schema))


def _feed_schema(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField("_change_type", T.StringType())]
        + _nullable(schema).fields
        + [T.StructField("_commit_version", T.LongType()), T.StructField("_commit_timestamp", T.TimestampType())]
    )


def _refuse_unknown(assign: dict, schema: T.StructType) -> None:
    unknown = set(assign) - set(schema.names)
    if unknown:
        raise SchemaMismatch(f"columns not in the table: {sorted(unknown)}")


def _widened(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """With the columns of ``schema`` that are missing, as NULL."""
    missing = [f for f in schema.fields if f.name not in rows.columns]
    return rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


def _tagged(rows: DataFrame, kind: str) -> DataFrame:
    return rows.select(F.lit(kind).alias("_change_type"), "*")
