"""Events and their attribute rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

KEY = "record_id"


def flatten_attributes(events: DataFrame, keep_empty: bool = False, key: str = "log_id") -> DataFrame:
    """One row per attribute: key, id, key, value. `keep_empty` keeps events without any.

    `key` names the event in the rows. A log id may be missing or come twice; to re-attach the rows, take a key that
    every event has once, such as `enrich.document_id` over the record's source.
    """
    rows = F.explode_outer if keep_empty else F.explode
    return events.select(F.col(key), rows("attributes").alias("a")).select(key, "a.id", "a.logId", "a.key", "a.value").select(
        key, "id", *([] if key == "log_id" else ["logId"]), "key", "value"
    )


def nest_attributes(events: DataFrame, attributes: DataFrame, key: str = "log_id") -> DataFrame:
    """Re-attach attribute rows to events, as a list sorted by id, key and value; one row per event at any size.

    A list is as long as the event has attributes, which the size limit of a record bounds. Rows whose key no event
    has are left out, as are rows without a key; an event without rows has a NULL list.
    """
    log_id = F.col("logId") if "logId" in attributes.columns else F.col(key).cast("string")
    lists = attributes.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("id", log_id.alias("logId"), "key", "value"))).alias("attributes")
    )
    return events.drop("attributes").join(lists, key, "left")
