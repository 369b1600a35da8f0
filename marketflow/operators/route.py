"""Mixed exchange messages to per-kind topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.functions import topic_partition
from marketflow.operators.validate import REASON
from marketflow.schemas import EVENT_KINDS

DEFAULT_PARTITIONS = 9

# What routing reads of a message. Wire names differ only by case, so fields are renamed by position.
_READ = "array<struct<`e`:variant,`E`:variant,`s`:variant,`k`:struct<`i`:variant>,`result`:variant>>"
_NAMED = "array<struct<event:variant,at:variant,symbol:variant,bar:struct<span:variant>,result:variant>>"
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _read_again(value: Column) -> Column:
    """What routing reads of a message that is no VARIANT because a key is repeated: the last value counts.

    Two elements where the text is one message: one that is missing or not the last shows text
    after it. Of broken messages nothing is read.
    """
    pair = F.concat(F.lit("["), value.cast("string"), F.lit(",{}]"))
    return F.from_json(pair, _READ, _STRICT).cast(_NAMED)


def route_raw(
    raw: DataFrame,
    partitions: int = DEFAULT_PARTITIONS,
    *,
    rewrite_json: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Give every message its kind, topic and partition, or the reason it has none.

    Output columns: ``endpoint``, ``topic``, ``partition``, ``value``, ``symbol``,
    ``interval`` (candlesticks only), ``reject_reason`` and ``carry``. Reasons are
    ``malformed``, ``not an object``, ``acknowledgement``, ``unknown event``, ``no event
    time`` and ``bad event time``.

    The message text is handed on as it came: writing it anew from a VARIANT would turn
    ``1.0`` into ``1`` and so make an id of what is none. ``rewrite_json`` asks for the
    compact form with sorted keys all the same.

    Of a key that is repeated the last value counts, here and where messages are parsed by
    their schema. Such a message is handed on as it came, also with ``rewrite_json``.
    """
    # In brackets, text after the message becomes a syntax error or a second element.
    text = F.concat(F.lit("["), F.col("value").cast("string"), F.lit("]"))
    parsed = raw.select("value", *carry, F.explode(F.array(F.try_parse_json(text))).alias("doc"))
    # Only messages that gave no VARIANT are parsed a second time.
    again = F.when(F.col("doc").isNull(), _read_again(F.col("value")))
    parsed = parsed.select("*", F.explode(F.array(again)).alias("again"))
    last = F.when(F.size("again") == 2, F.get("again", F.lit(0)))

    def at(path, type_="variant"):
        return F.try_variant_get(F.col("doc"), path, type_)

    def field(path, name, type_="variant"):
        return F.coalesce(at(path, type_), F.try_variant_get(F.col(f"last.{name}"), "$", type_))

    kinds = F.create_map(*(F.lit(x) for pair in EVENT_KINDS.items() for x in pair))
    fields = parsed.withColumn("last", last).select(
        "value",
        *carry,
        "doc",
        "last",
        F.try_element_at(kinds, field("$[0].e", "event", "string")).alias("kind"),
        field("$[0].E", "at", "bigint").alias("millis"),
        F.schema_of_variant(field("$[0].E", "at")).alias("time_type"),
        ((F.col("doc").isNull() & F.col("last").isNull()) | at("$[1]").isNotNull()).alias("malformed"),
        F.is_variant_null(field("$[0].result", "result")).alias("is_ack"),
    )
    is_object = F.col("last").isNotNull() | F.startswith(F.schema_of_variant(at("$[0]")), F.lit("OBJECT"))
    without_kind = (
        F.when(F.col("last").isNull() & at("$[0]").isNull(), "malformed")
        .when(is_object, "unknown event")
        .otherwise("not an object")
    )
    reason = (
        F.when(F.col("malformed"), "malformed")
        .when(F.col("is_ack"), "acknowledgement")
        .when(F.col("kind").isNull(), without_kind)
        .when(F.coalesce("time_type", F.lit("VOID")) == "VOID", "no event time")
        .when(F.col("time_type") != "BIGINT", "bad event time")
    )
    # As in ``validate``, the generator keeps filters on the reason from repeating its making.
    judged = fields.select("*", F.explode(F.array(reason)).alias(REASON))
    ok = F.col(REASON).isNull()
    text = F.col("value").cast("string")
    value = F.when(ok, F.coalesce(F.to_json(at("$[0]")), text)).otherwise(text) if rewrite_json else text
    return judged.select(
        F.when(ok, F.col("kind")).alias("endpoint"),
        F.when(ok, F.concat("kind", F.lit("_raw"))).alias("topic"),
        F.when(ok, topic_partition(F.col("millis"), partitions)).alias("partition"),
        value.alias("value"),
        F.when(ok, field("$[0].s", "symbol", "string")).alias("symbol"),
        F.when(ok & (F.col("kind") == "kline"), field("$[0].k.i", "bar.span", "string")).alias("interval"),
        REASON,
        *carry,
    )


def routed_messages(messages: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Accepted messages as topic records: ``topic``, ``partition``, ``value``."""
    accepted = messages.filter(F.col(REASON).isNull())
    return accepted.select("topic", "partition", "value", *carry)


def rejected_messages(messages: DataFrame) -> DataFrame:
    """Messages without a topic, with the reason."""
    return messages.filter(F.col(REASON).isNotNull()).drop("endpoint", "topic", "partition", "symbol", "interval")
