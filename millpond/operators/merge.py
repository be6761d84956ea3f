"""MERGE as joins: ordered clauses, one action per target row.

Inside clauses the target is ``t`` and the source is ``s``; texts are SQL
expressions, as in the MERGE statement.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millpond.functions.scalars import as_column
from millpond.workspace import staged


class AmbiguousMerge(ValueError):
    """Several source rows want to change the same target row."""


@dataclass(frozen=True)
class WhenMatched:
    """UPDATE SET the given columns, or DELETE when ``delete`` is set."""

    condition: Column | str | None = None
    assign: dict[str, Column | str] | None = None
    delete: bool = False


@dataclass(frozen=True)
class WhenNotMatched:
    """INSERT the given values; without values INSERT * by name."""

    condition: Column | str | None = None
    values: dict[str, Column | str] | None = None


def _holds(clause) -> Column:
    if clause.condition is None:
        return F.lit(True)
    return F.coalesce(as_column(clause.condition), F.lit(False))


def first_clause(clauses) -> Column:
    """Position of the first clause whose condition holds, else NULL."""
    picked = F.lit(None).cast("int")
    for position, clause in reversed(list(enumerate(clauses))):
        picked = F.when(_holds(clause), F.lit(position)).otherwise(picked)
    return picked


def _same_key(on: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in on])


def acting_pairs(target: DataFrame, source: DataFrame, on, matched, how: str) -> DataFrame:
    """Join target rows (left) to the source rows that change them.

    The big side is on the left of an inner or left join, so adaptive
    execution may split a hot key's partition.
    """
    fires = _same_key(on) & first_clause(matched).isNotNull()
    return target.alias("t").join(source.alias("s"), fires, how)


def action_frame(
    target: DataFrame, source: DataFrame, on, matched, columns, types, how: str = "left", met: bool = False
) -> DataFrame:
    """One row per target row, or per changed one if ``how`` is inner: ``action`` (NULL = keep), ``pre`` and ``post``.

    With ``met`` an inner join gives every target row that a source row meets,
    also where no clause fires; for sources unique by key.
    """
    source = source.withColumn("_present", F.lit(True))
    if met:
        pairs = target.alias("t").join(source.alias("s"), _same_key(on), how)
    else:
        pairs = acting_pairs(target, source, on, matched, how)
    clause = F.when(F.col("s._present"), first_clause(matched))
    action = F.lit(None).cast("string")
    posts = {c: F.col(f"t.{c}") for c in columns}
    for position, spec in enumerate(matched):
        hit = clause == F.lit(position)
        action = F.when(hit, F.lit("delete" if spec.delete else "update")).otherwise(action)
        for name, value in (spec.assign or {}).items():
            posts[name] = F.when(hit, as_column(value).cast(types[name])).otherwise(posts[name])
    return pairs.select(
        action.alias("action"),
        F.struct(*[F.col(f"t.{c}").alias(c) for c in columns]).alias("pre"),
        F.struct(*[posts[c].alias(c) for c in columns]).alias("post"),
    )


def kept_rows(actions: DataFrame) -> DataFrame:
    """Target rows after the matched clauses."""
    return actions.where(F.coalesce(F.col("action") != "delete", F.lit(True))).select("post.*")


def matched_changes(actions: DataFrame, columns) -> DataFrame:
    """Change rows of the matched clauses: two images per update, one per delete."""

    def image(kind: str, side: str) -> Column:
        return F.struct(
            F.lit(kind).alias("_change_type"), *[F.col(f"{side}.{c}").alias(c) for c in columns]
        )

    rows = F.when(
        F.col("action") == "update",
        F.array(image("update_preimage", "pre"), image("update_postimage", "post")),
    ).otherwise(F.array(image("delete", "pre")))
    changed = actions.where(F.col("action").isNotNull())
    return changed.select(F.explode(rows).alias("r")).select("r.*")


def known_pairs(target: DataFrame, source: DataFrame, on, matched) -> DataFrame:
    """Key and file of each target row that a source row (unique by key) meets, and the clause that fires."""
    meets = target.alias("t").join(source.alias("s"), _same_key(on), "inner")
    return meets.select(*[F.col(f"t.{k}").alias(k) for k in on], "t._file", first_clause(matched).alias("clause"))


def held_keys(target: DataFrame, source: DataFrame, on: list[str]) -> DataFrame:
    """Keys that both sides hold, once each; a NULL key is never held.

    The target is on the left: a small source is broadcast against it and the
    target's keys do not shuffle, as they would in one anti join.
    """
    return target.select(*on).join(source.select(*on).distinct(), on, "left_semi").distinct()


def absent_rows(source: DataFrame, target: DataFrame, on: list[str]) -> DataFrame:
    """Source rows whose key the target does not hold."""
    return source.join(held_keys(target, source, on), on, "left_anti")


def insert_rows(
    target: DataFrame | None, source: DataFrame, on, not_matched, columns, types, held: DataFrame | None = None
) -> DataFrame:
    """Source rows without a partner in the target, shaped by the first clause that holds.

    A NULL key never matches, so such rows are inserted, as MERGE does.
    ``held`` may name the keys of the target that the source meets, if known;
    else they are written first, so that no task sorts for both joins. Without
    a ``target`` every source row is new.
    """
    clause = first_clause(not_matched)
    wanted = source.alias("s").where(clause.isNotNull()).select("s.*")
    if held is None and target is not None:
        held = staged(held_keys(target, wanted, on), "merge-held")
    fresh = (wanted if held is None else wanted.join(held, on, "left_anti")).alias("s")
    out = []
    for name in columns:
        value = F.lit(None)
        for position, spec in reversed(list(enumerate(not_matched))):
            if spec.values is None:
                given = F.col(f"s.{name}") if name in source.columns else F.lit(None)
            else:
                given = as_column(spec.values.get(name, F.lit(None)))
            value = F.when(clause == F.lit(position), given.cast(types[name])).otherwise(value)
        out.append(value.cast(types[name]).alias(name))
    return fresh.select(*out)


def refuse_ambiguous(target: DataFrame, source: DataFrame, on, matched, row_id: list[str]) -> bool:
    """Raise if a target row (identified by ``row_id``) is changed by two source rows.

    True if the source's keys are unique, so that no target row can meet two.
    """
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])
    repeated = source.where(known).groupBy(*on).count().where("count > 1").select(*on)
    if not repeated.take(1):
        return True
    suspects = source.join(repeated, on, "left_semi")
    hits = acting_pairs(target, suspects, on, matched, "inner")
    clash = hits.groupBy(*[F.col(f"t.{c}") for c in row_id]).count().where("count > 1")
    if clash.take(1):
        raise AmbiguousMerge(f"several source rows change one target row; make {on} unique")
    return False


def merge_frames(target: DataFrame, source: DataFrame, on, matched=(), not_matched=()):
    """MERGE over two DataFrames: returns ``(result, changes)``.

    The actions are written once, since both results read them.
    """
    columns = target.columns
    types = {f.name: f.dataType for f in target.schema.fields}
    source = staged(source, "merge-source")
    target = target.withColumn("_row", F.monotonically_increasing_id())
    if matched:
        target = staged(target, "merge-target")
        refuse_ambiguous(target, source, on, matched, ["_row"])
    actions = staged(action_frame(target, source, on, matched, columns, types), "merge-actions")
    result, changes = kept_rows(actions), matched_changes(actions, columns)
    if not_matched:
        fresh = insert_rows(target, source, on, not_matched, columns, types)
        result = result.unionByName(fresh)
        changes = changes.unionByName(fresh.withColumn("_change_type", F.lit("insert")))
    return result, changes
