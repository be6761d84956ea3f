"""Versioned rows against a model: every version stays readable over folds, failures and schema changes."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import plan
from millpond.operators.intervals import ConstraintViolation, SchemaMismatch, VersionConflict, VersionedRows
from millpond.operators.merge import AmbiguousMerge, WhenMatched, WhenNotMatched
from millpond.streaming.rows import follow, read_stream_log, stream_log

SCHEMA = "k int, v int, s string"


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def rows_of(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


@pytest.mark.parametrize("fold_every, seed", [(1000, 1), (1, 2), (3, 3), (4, 4)])
def test_random_story(spark, root, fold_every, seed):
    """Appends, updates, deletes, merges, overwrites and restores; NULL and repeated keys; all versions at the end."""
    rng = random.Random(seed)
    t = VersionedRows.create(spark, f"{root}/t", SCHEMA, fold_every=fold_every)
    now, versions = Counter(), [Counter()]
    for _ in range(11):
        kind = rng.choice(["append", "append", "update", "delete", "merge", "overwrite", "restore"])
        k = rng.randint(0, 6)
        fresh = [(rng.choice([None, *range(8)]), rng.randint(0, 9), rng.choice("ab")) for _ in range(rng.randint(1, 6))]
        if kind == "append":
            t.append(rows_of(spark, *fresh))
            now = now + Counter(fresh)
        elif kind == "update":
            t.update(f"k <= {k}", {"v": "v + 10", "s": F.upper("s")})
            changed = {r: n for r, n in now.items() if r[0] is not None and r[0] <= k}
            now = now - Counter(changed)
            for (key, v, s), n in changed.items():
                now[(key, v + 10, s.upper())] += n
        elif kind == "delete":
            t.delete(f"k = {k}")
            now = Counter({r: n for r, n in now.items() if r[0] != k})
        elif kind == "overwrite":
            t.overwrite(rows_of(spark, *fresh))
            now = Counter(fresh)
        elif kind == "merge":
            source = {r[0]: r for r in fresh if r[0] is not None}
            t.merge(rows_of(spark, *source.values()), ["k"], [
                WhenMatched("s.v > 6", delete=True), WhenMatched("s.v > 2", {"v": "s.v"}),
            ], [WhenNotMatched("s.v < 8")])
            held = {r[0] for r in now}
            after = Counter()
            for (key, v, s), n in now.items():
                if key in source and source[key][1] > 6:
                    continue
                after[(key, source[key][1] if key in source and source[key][1] > 2 else v, s)] += n
            now = after + Counter(r for r in source.values() if r[0] not in held and r[1] < 8)
        elif versions:
            target = rng.randrange(len(versions))
            t.restore(target)
            now = versions[target]
        while len(versions) <= t.current_version():
            versions.append(+now)
    again = VersionedRows(spark, f"{root}/t")
    for version, want in enumerate(versions):
        assert bag(again.read(version)) == want, version
    left, right = sorted(rng.sample(range(len(versions)), 2))
    old, new = again.differing_rows(left, right)
    assert versions[left] - bag(old) + bag(new) == versions[right]
    back_old, back_new = again.differing_rows(right, left)
    assert (bag(back_old), bag(back_new)) == (bag(new), bag(old))


def test_feed_and_plain_appends(spark, root):
    t = VersionedRows.write(spark, f"{root}/t", rows_of(spark, (1, 1, "a"), (2, 2, "b"), (None, 3, "c")))
    t.update("k = 1", {"v": "v * 2"})
    t.delete("k IS NULL")
    assert t.update("k = 99", {"v": "0"}) == 2 and t.delete("v > 1000") == 2  # no effect, no version
    feed = t.changes(1).select("k", "v", "_change_type", "_commit_version")
    assert bag(feed) == Counter([
        (1, 1, "update_preimage", 1), (1, 2, "update_postimage", 1), (None, 3, "delete", 2),
    ])
    assert t.changes(5).count() == 0 and t.changes(2, 2).count() == 1
    added = VersionedRows.create(spark, f"{root}/a", SCHEMA)
    for i in range(3):
        added.append(rows_of(spark, (i, i, "x")))
    assert "Join" not in plan(added.read()) and "Exchange" not in plan(added.read())
    assert bag(added.appended_rows(1, 3)) == Counter([(1, 1, "x"), (2, 2, "x")])


def test_old_versions_are_one_predicate(spark, root):
    t = VersionedRows.write(spark, f"{root}/t", rows_of(spark, *[(i, i, "a") for i in range(20)]))
    for i in range(3):
        t.update(f"k = {i}", {"v": "-1"})
    t.fold()
    t.delete("k = 19")
    for version, want in ((0, {i: i for i in range(20)}), (2, {i: -1 if i < 2 else i for i in range(20)})):
        df = t.read(version)
        assert {r.k: r.v for r in df.collect()} == want
        text = plan(df)
        assert "Join" not in text and "Exchange" not in text and "LessThanOrEqual(_from" in text
    assert t.read().count() == 19


def test_many_versions_keep_constant_state(spark, root):
    """Commit records do not grow with the versions, and no more change folders are read than since the fold."""
    t = VersionedRows.write(spark, f"{root}/t", rows_of(spark, (1, 0, "a"), (2, 0, "b")), fold_every=10)
    for i in range(35):
        t.update("k = 1", {"v": "v + 1"})
    sizes = [len(str(t._record(v))) for v in range(36)]
    assert max(sizes[1:]) - min(sizes[1:]) <= 8
    assert [t.read(v).where("k = 1").first().v for v in (0, 9, 10, 11, 20, 34, 35)] == [0, 9, 10, 11, 20, 34, 35]
    assert t._fold == 30 and len(t._numbers("open", "_fold")) == 2
    assert len({f.split("_commit_version=")[1].split("/")[0] for f in t.read().inputFiles() if "_commit_version" in f}) == 5


def test_broken_off_writers_leave_nothing(spark, root, monkeypatch):
    t = VersionedRows.write(spark, f"{root}/t", rows_of(spark, (1, 1, "a")))
    rename = VersionedRows._rename

    def fails(self, draft, target):
        raise OSError("gone")

    for target in (VersionedRows, ):
        monkeypatch.setattr(target, "_rename", fails)
        with pytest.raises(OSError):
            t.append(rows_of(spark, (2, 2, "b")))
        monkeypatch.setattr(target, "_rename", rename)
    again = VersionedRows(spark, f"{root}/t")
    assert again.current_version() == 0 and bag(again.read()) == Counter([(1, 1, "a")]) and again.history().count() == 1
    again.append(rows_of(spark, (3, 3, "c")))
    assert bag(again.read()) == Counter([(1, 1, "a"), (3, 3, "c")])
    with pytest.raises(VersionConflict):
        t.append(rows_of(spark, (4, 4, "d")))  # the first writer did not see version 1
    again.update("k = 1", {"v": "7"})
    # a fold that breaks off after its closed rows
    place = VersionedRows._place
    monkeypatch.setattr(VersionedRows, "_place", lambda self, rows, at: place(self, rows, at) if "closed" in at else fails(self, 0, 0))
    with pytest.raises(OSError):
        again.fold()
    monkeypatch.setattr(VersionedRows, "_place", place)
    again.delete("k = 3")
    again.fold()
    final = VersionedRows(spark, f"{root}/t")
    assert bag(final.read()) == Counter([(1, 7, "a")])
    assert bag(final.read(0)) == Counter([(1, 1, "a")]) and bag(final.read(2)) == Counter([(1, 7, "a"), (3, 3, "c")])


def test_schema_and_checks(spark, root):
    t = VersionedRows.write(spark, f"{root}/t", rows_of(spark, (1, 1, "a")), at="2024-01-01 00:00:00")
    wide = spark.createDataFrame([(2, 2, "b", 0.5)], SCHEMA + ", extra double")
    with pytest.raises(SchemaMismatch):
        t.append(wide)
    t.append(wide, merge_schema=True, at="2024-01-02 00:00:00")
    t.add_columns("note string", at="2024-01-03 00:00:00")
    assert t.read().columns == ["k", "v", "s", "extra", "note"] and t.read(0).columns == ["k", "v", "s"]
    assert bag(t.read()) == Counter([(1, 1, "a", None, None), (2, 2, "b", 0.5, None)])
    assert t.read(timestamp="2024-01-02 12:00:00").columns[-1] == "extra"
    assert bag(t.read(timestamp="2024-01-01 00:00:00")) == Counter([(1, 1, "a")])
    with pytest.raises(ValueError):
        t.read(timestamp="2023-01-01 00:00:00")
    t.add_constraint("positive", "v > 0")
    for change in (lambda: t.append(rows_of(spark, (3, -1, "c"))), lambda: t.append(rows_of(spark, (3, None, "c"))),
                   lambda: t.update("k = 1", {"v": "-5"})):
        with pytest.raises(ConstraintViolation):
            change()
    with pytest.raises(ConstraintViolation):
        t.add_constraint("never", "k > 1")
    assert t.current_version() == 3
    t.overwrite(spark.createDataFrame([("a", 1)], "s string, v int"))
    assert t.read().columns == ["s", "v"] and t.read(2).count() == 2
    t.restore(1)
    assert bag(t.read()) == Counter([(1, 1, "a", None), (2, 2, "b", 0.5)])
    with pytest.raises(SchemaMismatch):
        t.overwrite(spark.createDataFrame([("a", "one")], "s string, v string"))
    with pytest.raises(AmbiguousMerge):
        t.merge(rows_of(spark, (1, 5, "x"), (1, 6, "y")), ["k"], [WhenMatched(None, {"v": "s.v"})])
    copy = t.clone(f"{root}/copy", 2)
    assert bag(copy.read()) == bag(t.read(2)) and copy.current_version() == 0


def stop_after(monkeypatch, batches):
    """Streams break off once they have written that many batches to a checkpoint's offsets, before they commit."""
    from pyspark.sql.streaming.readwriter import DataStreamWriter

    start = DataStreamWriter.start

    def cut(self, *args, **kwargs):
        query = start(self, *args, **kwargs)
        while query.isActive and len(query.recentProgress) < batches:
            pass
        query.stop()
        return query

    monkeypatch.setattr(DataStreamWriter, "start", cut)
    return lambda: monkeypatch.setattr(DataStreamWriter, "start", start)


def test_log_goes_on_after_a_stop_midway(spark, root, monkeypatch):
    t = VersionedRows.create(spark, f"{root}/t", SCHEMA)
    for i in range(6):
        t.append(rows_of(spark, (i, i, "a"), (i + 10, i, "b")))
    log, checkpoint = f"{root}/log", f"{root}/checkpoint"
    resume = stop_after(monkeypatch, 8)  # a version has several files
    stream_log(t, log, checkpoint, starting_version=1, files_per_batch=1)
    resume()
    assert 0 < read_stream_log(t, log).count() < 12
    t.update("k = 3", {"v": "30"})
    stream_log(t, log, checkpoint, starting_version=1, files_per_batch=1)
    stream_log(t, log, checkpoint, starting_version=1)
    assert bag(read_stream_log(t, log)) == bag(t.changes(1)) and read_stream_log(t, log).count() == 14


def test_follower_takes_each_change_once(spark, root, monkeypatch):
    t = VersionedRows.write(spark, f"{root}/t", rows_of(spark, *[(i, i, "in" if i % 2 else "out") for i in range(8)]))
    belongs = F.col("s") == "in"
    copy = VersionedRows.write(spark, f"{root}/copy", t.read().where(belongs).select("k", "v"))

    def run():
        follow(t, copy, "k", belongs, f"{root}/checkpoint", 1, files_per_batch=2)
        assert bag(copy.read()) == bag(t.read().where(belongs).select("k", "v"))

    t.update("k = 1", {"s": "'out'"})
    t.update("k = 2", {"s": "'in'"})
    t.update("k = 3", {"v": "33"})
    resume = stop_after(monkeypatch, 1)
    follow(t, copy, "k", belongs, f"{root}/checkpoint", 1, files_per_batch=2)
    resume()
    run()
    t.delete("k = 5")
    t.append(rows_of(spark, (20, 1, "in"), (21, 1, "out")))
    t.update("k = 20", {"v": "2"})
    t.update("k = 1", {"s": "'in'"})
    run()
    before = copy.current_version()
    run()
    assert copy.current_version() == before


def test_late_versions_change_nothing(spark, root):
    """Changes that arrive out of order: the state of a key is that of its greatest version."""
    from millpond.streaming.rows import latest_per_key

    feed = "k int, v int, s string, _change_type string, _commit_version long"
    batches = [
        [(1, 5, "in", "update_postimage", 5), (2, 1, "in", "insert", 3)],
        [(1, 4, "out", "update_postimage", 4), (2, 1, "in", "delete", 2)],
        [(1, 5, "in", "delete", 6), (3, 1, "out", "insert", 7), (3, 1, "out", "update_preimage", 9)],
    ]
    os.mkdir(f"{root}/in")
    stream = spark.readStream.schema(feed).parquet(f"{root}/in")
    states = {}

    def keep(batch, _):
        states.update({r.k: (r.v, r._stays) for r in batch.collect()})

    seen = []
    for rows in batches:
        spark.createDataFrame(rows, feed).coalesce(1).write.mode("append").parquet(f"{root}/in")
        latest = latest_per_key(stream, "k", ["v"], F.col("s") == "in")
        query = latest.writeStream.foreachBatch(keep).option("checkpointLocation", f"{root}/c").outputMode("update")
        query.trigger(availableNow=True).start().awaitTermination(120)
        seen.append(dict(states))
    assert seen == [{1: (5, True), 2: (1, True)}, {1: (5, True), 2: (1, True)}, {1: (5, False), 2: (1, True), 3: (1, False)}]


@pytest.mark.parametrize("matched", [[], [WhenMatched("s.v > 6", delete=True), WhenMatched("s.v > 2", {"v": "s.v"})]])
def test_merge_sorts_for_one_join_at_a_time(spark, root, monkeypatch, matched):
    """The rows a merge writes come from a single join, so no task holds the sorts of several."""
    t = VersionedRows.write(spark, f"{root}/t", rows_of(
        spark, (1, 0, "a"), (1, 1, "b"), (2, 0, "c"), (3, 0, "d"), (4, 0, "e"), (None, 0, "f")
    ))
    plans, publish = [], VersionedRows._publish

    def seen(self, operation, rows, *args, **named):
        plans.append(plan(rows))
        return publish(self, operation, rows, *args, **named)

    monkeypatch.setattr(VersionedRows, "_publish", seen)
    # 1 updates two rows, 2 goes, 3 is met without effect, 5 and NULL are new, 6 is not wanted
    source = rows_of(spark, (1, 5, "x"), (2, 7, "x"), (3, 1, "x"), (5, 4, "x"), (None, 4, "x"), (6, 9, "x"))
    t.merge(source, ["k"], matched, [WhenNotMatched("s.v < 8")])
    assert plans[0].count("Join") == 1
    new = Counter([(3, 0, "d"), (4, 0, "e"), (None, 0, "f"), (5, 4, "x"), (None, 4, "x")])
    old = [(1, 5, "a"), (1, 5, "b")] if matched else [(1, 0, "a"), (1, 1, "b"), (2, 0, "c")]
    assert bag(t.read()) == new + Counter(old)
