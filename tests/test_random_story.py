"""Random operations against a plain Python model: every version, and the feed between versions."""

import random
from collections import Counter

import pytest

from millpond.operators.merge import WhenMatched, WhenNotMatched
from millpond.operators.snapshot import FEED_PROPERTY, SnapshotTable

SCHEMA = "k int, v int, tag string"


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def random_rows(rng, keys):
    return [(rng.choice([*keys, None]), rng.choice([0, 1, 2, 3, None]), rng.choice("ab")) for _ in range(rng.randint(1, 8))]


def merged(model, source):
    """matched: tag b deletes, v known sets v; unmatched: tag a inserts."""
    by_key = {k: (v, tag) for k, v, tag in source}
    out, keys = Counter(), {row[0] for row in model}
    for row, n in model.items():
        k, v, tag = row
        if k is None or k not in by_key:
            out[row] += n
        else:
            sv, stag = by_key[k]
            if stag == "b":
                continue
            out[(k, sv, tag) if sv is not None else row] += n
    for k, v, tag in source:
        if (k is None or k not in keys) and tag == "a":
            out[(k, v, tag)] += 1
    return out


def step(spark, rng, table, model):
    kind = rng.choice(["append", "update", "delete", "merge", "restore", "optimize", "overwrite"])
    if kind == "append":
        new = random_rows(rng, range(12))
        table.append(spark.createDataFrame(new, SCHEMA).repartition(3))
        return model + Counter(new)
    if kind == "update":
        bound = rng.randint(0, 3)
        table.update(f"v >= {bound}", {"v": "v + 10", "tag": "concat(tag, 'u')"})
        changed = Counter()
        for (k, v, tag), n in model.items():
            changed[(k, v + 10, tag + "u") if v is not None and v >= bound else (k, v, tag)] += n
        return changed
    if kind == "delete":
        key = rng.randint(0, 11)
        table.delete(f"k = {key} OR v = 2")
        return Counter({r: n for r, n in model.items() if not (r[0] == key or r[1] == 2)})
    if kind == "merge":
        source = {k: (k, v, tag) for k, v, tag in random_rows(rng, range(12)) if k is not None}
        source = [*source.values(), (None, 5, "a")]
        table.merge(
            spark.createDataFrame(source, SCHEMA), ["k"],
            [WhenMatched("s.tag = 'b'", delete=True), WhenMatched("s.v IS NOT NULL", {"v": "s.v"})],
            [WhenNotMatched("s.tag = 'a'")],
        )
        return merged(model, source)
    if kind == "restore":
        version = rng.randint(0, table.current_version())
        rows = bag(table.read(version=version))
        table.restore(version)
        return rows
    if kind == "optimize":
        table.optimize(cluster_by=rng.choice([None, "k"]), target_bytes=rng.choice([500, 10**6]))
        return model
    rows = [r for r in model.elements() if r[0] is not None]
    table.overwrite(spark.createDataFrame(rows, SCHEMA))
    return Counter(rows)


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_story(spark, root, seed):
    rng = random.Random(seed)
    table = SnapshotTable.create(spark, f"{root}/t", SCHEMA, {FEED_PROPERTY: "true"})
    model, seen = Counter(), {0: Counter()}
    for _ in range(9):
        model = step(spark, rng, table, model)
        seen[table.current_version()] = model
        assert bag(table.read()) == model
    for version, rows in seen.items():
        assert bag(table.read(version=version)) == rows
    feed = table.changes(1).select("_commit_version", "_change_type", "k", "v", "tag").collect()
    state = Counter()
    for version in range(1, table.current_version() + 1):
        for change in feed:
            if change._commit_version == version:
                row = (change.k, change.v, change.tag)
                state[row] += 1 if change._change_type in ("insert", "update_postimage") else -1
        state = Counter({r: n for r, n in state.items() if n})
        if version in seen:
            assert state == seen[version], version
