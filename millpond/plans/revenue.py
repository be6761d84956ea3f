"""Daily revenue kept up to date from signed changes, without reading the orders again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpond.operators.intervals import AFTER, INSERT, VersionedRows
from millpond.operators.merge import WhenMatched, WhenNotMatched
from millpond.workspace import staged

GROUP = ["region", "order_date"]
#: ``group_key`` spells a group, also one with NULLs, which MERGE would not match.
GOLD_SCHEMA = (
    "group_key string, region string, order_date date, order_count long, amount_count long, exact_revenue decimal(38,6), "
    "total_revenue double, avg_order_value double, max_order_value double"
)
#: How often each group has each amount: what is left when the greatest goes.
AMOUNTS_SCHEMA = "group_key string, amount double, orders long"
SEEN = "silverVersion"


def _seen(table: VersionedRows) -> int:
    return int(table.properties().get(SEEN, 0))


def counted_orders(silver: VersionedRows, after: int, until: int) -> DataFrame:
    """Completed orders of the changes after a version, counted by group and amount.

    ``came`` and ``went`` count the rows, ``ids`` those with an identifier, 1
    where one came and -1 where one went. Keys are spelled and sums are taken
    from these counts, once for all orders of the same amount.
    """
    rows = silver.changes(after + 1, until).where(F.col("status") == "completed")
    here = F.col("_change_type").isin(INSERT, AFTER)
    counts = rows.groupBy(*GROUP, "amount").agg(
        F.count(F.when(here, 1)).alias("came"), F.count(F.when(~here, 1)).alias("went"),
        F.sum(F.when(F.col("order_id").isNull(), 0).when(here, 1).otherwise(-1)).alias("ids"),
    )
    key = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in GROUP]), {"ignoreNullFields": "false"})
    return staged(counts.select(key.alias("group_key"), "*"), "revenue-counts")


def _refresh_amounts(amounts: VersionedRows, counted: DataFrame, until: int) -> None:
    deltas = counted.where("amount IS NOT NULL AND came != went").select(
        "group_key", "amount", (F.col("came") - F.col("went")).alias("orders")
    )
    amounts.merge(
        deltas, ["group_key", "amount"],
        matched=[WhenMatched("t.orders + s.orders = 0", delete=True), WhenMatched(None, {"orders": "t.orders + s.orders"})],
        not_matched=[WhenNotMatched()], properties={SEEN: str(until)}, unique=True,
    )


def refresh_revenue(silver: VersionedRows, amounts: VersionedRows, gold: VersionedRows) -> None:
    """Add the changes of ``silver`` not yet seen to ``gold``.

    Counts and sums (exact millionths) take signed deltas. A maximum takes a
    greater amount as it comes; where the greatest went, the amounts of that
    group, and only of such groups, are read for the next one. Both tables keep in
    the commit that changes them how far they have read.
    """
    until = silver.current_version()
    after = _seen(gold)
    counted = counted_orders(silver, after, until) if after < until else None
    if (seen := _seen(amounts)) < until:
        # both tables stand at the same mark, unless a refresh broke off between them
        _refresh_amounts(amounts, counted if seen == after else counted_orders(silver, seen, until), until)
    if counted is None:
        return
    amount, net = F.col("amount"), F.col("came") - F.col("went")
    deltas = staged(
        counted.groupBy("group_key", *GROUP).agg(
            F.sum("ids").alias("order_count"),
            F.sum(F.when(amount.isNotNull(), net).otherwise(0)).alias("amount_count"),
            F.coalesce(F.sum(amount.cast("decimal(38,6)") * net), F.lit(0)).cast("decimal(38,6)").alias("exact_revenue"),
            F.max(F.when(F.col("came") > 0, amount)).alias("came"),
            F.max(F.when(F.col("went") > 0, amount)).alias("went"),
        ),
        "revenue-deltas",
    )
    old = gold.read().select(F.col("group_key").alias("of_key"), F.col("max_order_value").alias("top"))
    topped = staged(
        deltas.join(old, F.col("group_key") == F.col("of_key"), "left").drop("of_key")
        # the greatest amount may have gone, also one that came in the same changes
        .withColumn("lost", F.coalesce(F.col("went") >= F.greatest("top", "came"), F.lit(False))),
        "revenue-tops",
    )
    lost = topped.where("lost").select(F.col("group_key").alias("of_key"))
    rest = amounts.read().join(lost, F.col("group_key") == F.col("of_key"), "left_semi")
    rest = rest.groupBy(F.col("group_key").alias("of_key")).agg(F.max("amount").alias("left"))
    source = topped.join(rest, F.col("group_key") == F.col("of_key"), "left").withColumn(
        "max_order_value", F.when(F.col("lost"), F.col("left")).otherwise(F.greatest("top", "came"))
    )
    count, exact = F.col("t.amount_count") + F.col("s.amount_count"), F.col("t.exact_revenue") + F.col("s.exact_revenue")

    def values(count, exact, orders) -> dict:
        total = F.when(count > 0, exact.cast("double"))
        return {
            "order_count": orders, "amount_count": count, "exact_revenue": exact, "total_revenue": total,
            "avg_order_value": total / F.when(count > 0, count), "max_order_value": F.col("s.max_order_value"),
        }

    orders = F.col("t.order_count") + F.col("s.order_count")
    fresh = values(F.col("s.amount_count"), F.col("s.exact_revenue"), F.col("s.order_count"))
    gold.merge(
        source, ["group_key"],
        matched=[WhenMatched((orders == 0) & (count == 0), delete=True), WhenMatched(None, values(count, exact, orders))],
        not_matched=[WhenNotMatched("s.order_count > 0 OR s.amount_count > 0", {
            **fresh, "group_key": F.col("s.group_key"), **{c: F.col(f"s.{c}") for c in GROUP},
        })],
        properties={SEEN: str(until)}, unique=True,
    )
