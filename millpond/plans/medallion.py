"""Bronze, silver and gold layers from raw JSON payloads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millpond.operators.dedup import first_per_key
from millpond.operators.intervals import VersionedRows
from millpond.operators.merge import WhenNotMatched
from millpond.operators.quality import split_valid
from millpond.plans.revenue import AMOUNTS_SCHEMA, GOLD_SCHEMA, refresh_revenue
from millpond.workspace import staged

BRONZE_SCHEMA = "ingestion_timestamp timestamp, source_file string, raw_payload string"
SILVER_SCHEMA = (
    "order_id int, customer_id string, amount double, region string, status string, "
    "order_date date, ingestion_timestamp timestamp, source_file string"
)


# payload fields and their types
FIELDS = {
    "order_id": "int", "customer_id": "string", "amount": "double",
    "region": "string", "status": "string", "order_date": "date",
}


def parse_bronze(bronze: DataFrame) -> DataFrame:
    """Typed order columns from the raw payload; fields that do not parse are NULL.

    ``json_tuple`` reads each payload once for all fields, and later filters
    on the fields do not read it again.
    """
    texts = F.json_tuple("raw_payload", *FIELDS).alias(*FIELDS)
    return bronze.select(texts, "ingestion_timestamp", "source_file").withColumns(
        {name: F.col(name).try_cast(kind) for name, kind in FIELDS.items() if kind != "string"}
    )


def split_orders(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid orders, and everything else for quarantine."""
    valid = F.col("customer_id").isNotNull() & (F.col("amount") > 0) & F.col("order_id").isNotNull()
    return split_valid(parsed, valid)


BRONZE_SEEN = "bronzeVersion"


@dataclass(frozen=True)
class Layers:
    bronze: VersionedRows
    silver: VersionedRows
    quarantine: VersionedRows
    amounts: VersionedRows
    gold: VersionedRows


def open_layers(spark: SparkSession, root: str) -> Layers:
    """Empty layers under one folder."""
    return Layers(
        VersionedRows.create(spark, f"{root}/bronze", BRONZE_SCHEMA),
        VersionedRows.create(spark, f"{root}/silver", SILVER_SCHEMA),
        VersionedRows.create(spark, f"{root}/quarantine", SILVER_SCHEMA),
        VersionedRows.create(spark, f"{root}/amounts", AMOUNTS_SCHEMA),
        VersionedRows.create(spark, f"{root}/gold", GOLD_SCHEMA),
    )


def _mark(table: VersionedRows, name: str) -> int:
    return int(table.properties().get(name, 0))


def refresh(layers: Layers) -> None:
    """Bring silver, quarantine and gold up to date, parsing new bronze rows once.

    Each layer keeps, in the commit that changes it, how far it has read. So
    a refresh that breaks off is completed by the next one without repeated
    rows, and one without news writes nothing. Gold takes the changes of silver.
    """
    arrived = layers.bronze.current_version()

    parsed: dict[int, DataFrame] = {}

    def unseen(layer: VersionedRows) -> DataFrame:
        # both layers stand at the same mark, unless a refresh broke off between them
        seen = _mark(layer, BRONZE_SEEN)
        if seen not in parsed:
            parsed[seen] = staged(parse_bronze(layers.bronze.appended_rows(seen, arrived)), "parsed")
        return parsed[seen]

    mark = {BRONZE_SEEN: str(arrived)}
    if _mark(layers.quarantine, BRONZE_SEEN) < arrived:
        _, invalid = split_orders(unseen(layers.quarantine))
        layers.quarantine.append(invalid, properties=mark)
    if _mark(layers.silver, BRONZE_SEEN) < arrived:
        valid, _ = split_orders(unseen(layers.silver))
        orders = first_per_key(valid, ["order_id"], ["ingestion_timestamp", "source_file"])
        layers.silver.merge(orders, ["order_id"], not_matched=[WhenNotMatched()], properties=mark)
    refresh_revenue(layers.silver, layers.amounts, layers.gold)
