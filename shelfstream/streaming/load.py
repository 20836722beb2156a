"""Topic to collection: micro-batches that can be replayed without doubling a document."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from shelfstream.functions.nested import (
    CORRUPT, lost_json, object_id, typed_json, typed_message, undeclared_fields,
)
from shelfstream.functions.widening import wider_struct
from shelfstream.operators.contracts import REASON, STATUS, observed_counts, with_reason
from shelfstream.sources import paths
from shelfstream.sources.collections import BATCH, RAW, Collection
from shelfstream.sources.json_text import infer_fields

Prepare = Callable[[DataFrame, int], DataFrame]
# Fixed value: the batch interval of a live load.
LIVE_TRIGGER = {"processingTime": "1 second"}
DRAIN_TRIGGER = {"availableNow": True}


METRICS = T.StructType([T.StructField(c, T.LongType()) for c in ("messages", "rejected", "undeclared")])


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """(messages, rejected, undeclared, batch_id), one row per batch; ``undeclared`` counts the documents
    with fields outside the declared schema."""
    return spark.read.schema(METRICS).json(path)


# names a document's fields cannot have, because collections use them
REST = "rest"
RESERVED = {CORRUPT, "_raw", REASON, RAW, STATUS, BATCH, REST}


def typed_documents(
    messages: DataFrame,
    schema: T.StructType,
    not_null: Iterable[str] = (),
    nested: dict[str, T.DataType] | None = None,
    checks: Iterable[tuple[str, Column]] = (),
    derived: dict[str, Column] | None = None,
    rest: bool = True,
) -> DataFrame:
    """Messages as documents with ``_id`` and ``reject_reason``; a rejected one keeps its
    text in ``raw_message``. ``nested`` columns arrive as JSON text and are typed; text that is lost by that is
    a reason to reject. ``derived`` columns are made from the fields. Fields outside the schema come back in
    ``rest``, a VARIANT object, NULL where there are none; an object that has them and names a field twice is
    rejected, as it has no such value."""
    taken = RESERVED & {name.lower() for name in schema.names}
    if taken:
        raise ValueError(f"fields of these names are used by collections: {sorted(taken)}")
    nested = nested or {}
    own_id = "_id" in schema.names
    more, others = undeclared_fields(F.col("value"), schema.names)
    parsed = messages.select(
        *([] if own_id else [object_id("message_id").alias("_id")]),
        F.col("value").alias("_raw"),
        *([more.alias("_more"), others.alias("_rest")] if rest else []),
        typed_message("value", schema).alias("_m"),
    ).select("*", "_m.*").drop("_m")
    if nested:
        parsed = parsed.withColumns(
            {f"_typed_{c}": typed_json(F.col(c), as_type) for c, as_type in nested.items()}
        )
    rules = [
        ("null:value", F.col("_raw").isNull()),
        *checks,
        ("malformed", F.col(CORRUPT).isNotNull()),
        *[(f"null:{c}", F.col(f"`{c}`").isNull()) for c in not_null],
        *[(f"nested:{c}", lost_json(F.col(c), F.col(f"_typed_{c}"))) for c in nested],
        *([("name:twice", F.col("_more") & F.col("_rest").isNull())] if rest else []),
    ]
    judged = with_reason(parsed, checks=rules)
    fields = [
        (F.col(f"_typed_{f.name}") if f.name in nested else F.col(f"`{f.name}`")).alias(f.name)
        for f in schema.fields
    ]
    raw = F.when(F.col(REASON).isNotNull(), F.col("_raw")).alias(RAW)
    extra = [column.alias(name) for name, column in (derived or {}).items()]
    if rest:
        extra.append(F.when(F.col(REASON).isNull(), F.col("_rest")).alias(REST))
    return judged.select(*([] if own_id else ["_id"]), *fields, *extra, REASON, raw)


def declared(schema: T.StructType, **rules) -> Prepare:
    """The default: every batch under one declared schema."""
    return lambda messages, _batch_id: typed_documents(messages, schema, **rules)


def _has_field(name: str) -> Column:
    path = F.lit(f"$[\"{name}\"]")
    value = F.call_function(
        "try_variant_get", F.try_parse_json("_raw"), path, F.lit("string")
    )
    return value.isNotNull()


def drifting(collection: Collection) -> Prepare:
    """Schema inferred batch by batch. A new field is added; a field whose values do not fit its type so far
    has, from this batch on, the narrowest type that holds both (``functions.widening``), and earlier batches
    are cast to it when they are read. A field whose name differs from a known one in case only, or is one
    the collection uses itself, is a reason to reject.

    A replayed batch starts from the schema before it, so it gives the same documents again."""

    def prepare(messages: DataFrame, batch_id: int) -> DataFrame:
        before = collection.schema_before(batch_id)
        known = T.StructType([f for f in before.fields if f.name != "_id"])
        by_name = {f.name.lower(): f.name for f in known.fields}
        found, clashing = [], []
        for field in infer_fields(messages, exact=True).fields:
            first = by_name.setdefault(field.name.lower(), field.name)
            clash = first != field.name or field.name.lower() in RESERVED
            (clashing if clash else found).append(field)
        schema = wider_struct(known, T.StructType(found))
        checks = [(f"name:{f.name}", _has_field(f.name)) for f in clashing]
        return typed_documents(messages, schema, checks=checks, rest=False)

    return prepare


def run_load(
    messages: DataFrame,
    prepare: Prepare,
    collection: Collection,
    checkpoint: str,
    metrics: str | None = None,
    trigger: dict | None = None,
    wait: bool = True,
    keep: bool = False,
) -> StreamingQuery:
    """Load an unbounded table of messages into ``collection``.

    Each batch is one narrow pass: parse, judge, write to the folder of its batch number.
    Counts are observed during the write, without a job of their own, and kept under ``metrics``; of a batch
    without messages nothing stays. The default trigger
    drains what is there and stops; ``LIVE_TRIGGER`` keeps going. With ``keep`` a batch is
    held while it is worked on, for a ``prepare`` that reads it more than once from a source
    where that is dear."""
    claim(collection, checkpoint)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        if not keep:
            write_batch(batch, batch_id)
            return
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_batch(held, batch_id)
        finally:
            held.unpersist()

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch, batch_id)
        rows, seen = observed_counts(rows, undeclared=F.col(REST) if REST in rows.columns else F.lit(None))
        collection.append(rows, batch_id)
        if metrics or collection.in_files:
            counts = seen.get
            if not counts["messages"]:
                collection.drop_batch(batch_id)
            elif metrics:
                path = f"{metrics}/{BATCH}={batch_id}/counts.json"
                paths.put_text(batch.sparkSession, path, json.dumps(counts))

    query = (
        messages.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or DRAIN_TRIGGER))
        .start()
    )
    if wait:
        query.awaitTermination()
    return query


def run_for(query: StreamingQuery, seconds: float) -> None:
    """Let a live load run for a while and stop it between two batches. What has arrived
    since waits for the next run on the same checkpoint."""
    query.awaitTermination(seconds)
    while query.isActive and query.status["isTriggerActive"]:
        query.awaitTermination(0.2)
    query.stop()


def claim(collection: Collection, checkpoint: str) -> None:
    """Tie a collection to the checkpoint that fills it.

    A new checkpoint counts batches from 0 again and would write over the folders of earlier
    ones, so a collection filled from another checkpoint is refused."""
    if not collection.in_files:
        return
    spark = collection.spark
    owner = paths.get_text(spark, f"{collection.path}/owner")
    token = paths.get_text(spark, f"{checkpoint}/owner")
    if owner is None and not collection.has_batches():
        token = token or uuid.uuid4().hex
        paths.put_text(spark, f"{checkpoint}/owner", token)
        paths.put_text(spark, f"{collection.path}/owner", token)
    elif owner is None or owner != token:
        raise ValueError(
            f"{collection.path} was filled from another checkpoint than {checkpoint}"
        )
