"""Keyed JSON messages: writing records to a topic, reading and decoding them again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from veracast.operators.once import computed_once
from veracast.schemas import LEGACY_NAMES, MESSAGE

_BAD = "_corrupt_record"
# What one batch of a backlog takes in at most, by source.
_LIMITS = {
    "kafka": {"maxOffsetsPerTrigger": "20000000"},
    "files": {"maxFilesPerTrigger": "1000"},
}
# What is kept of a message set aside.
QUARANTINE = T.StructType([T.StructField("body", T.BinaryType())])
# Columns a broker adds that say in what order messages arrived.
ARRIVAL = ("timestamp", "partition", "offset")


def to_messages(records: DataFrame) -> DataFrame:
    """key = city, value = the record as JSON; missing values are written as null."""
    body = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return records.select(
        F.col("ville").cast("binary").alias("key"), body.cast("binary").alias("value")
    )


def publish(records: DataFrame, fmt: str = "kafka", **options: str) -> None:
    """Append records as messages to a topic, or to any sink with the same two columns."""
    to_messages(records).write.format(fmt).mode("append").options(**options).save()


def open_topic(
    spark: SparkSession, fmt: str = "kafka", starting_offsets: str = "latest", **options: str
) -> DataFrame:
    """Stream of messages. ``fmt`` may be any streaming source carrying ``key`` and ``value``.

    With ``latest`` a first run sees only what arrives after it started; use ``earliest`` to load
    what is already there. A long backlog is drained in several batches, of the size given as
    ``maxOffsetsPerTrigger`` (``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` for files).
    """
    if fmt == "kafka":
        options = {**_LIMITS["kafka"], "startingOffsets": starting_offsets, **options}
        return spark.readStream.format(fmt).options(**options).load()
    # Spark takes one of its two limits.
    if not {"maxfilespertrigger", "maxbytespertrigger"} & {o.lower() for o in options}:
        options |= _LIMITS["files"]
    return spark.readStream.format(fmt).options(**options).schema(MESSAGE).load()


def _wire_schema(schema: T.StructType) -> T.StructType:
    legacy = [
        T.StructField(LEGACY_NAMES[f.name], T.StringType())
        for f in schema.fields
        if f.name in LEGACY_NAMES
    ]
    return T.StructType([*schema.fields, *legacy, T.StructField(_BAD, T.StringType())])


def _field(field: T.StructField, absent_only: bool) -> tuple[Column, Column | None]:
    """A field, taken from its legacy name where the present one is absent from the message, and
    whether the legacy value, if it is the one taken, is of the field's type.

    Legacy values are read as text and converted only when taken, so one that nobody reads spoils
    nothing. A quoted number under a legacy name is therefore read; under the present name a quoted
    number, or a fraction for a whole number (also ``55.0``), is a wrong type.
    """
    name = field.name
    current = F.col(f"p.`{name}`")
    if name not in LEGACY_NAMES:
        return current.alias(name), None
    text = F.col(f"p.`{LEGACY_NAMES[name]}`")
    taken = current.isNull() & text.isNotNull()
    if absent_only:
        # The names are listed only for the rare row that has the legacy value alone.
        taken = taken & ~F.coalesce(
            F.array_contains(F.json_object_keys("_text"), F.lit(name)), F.lit(False)
        )
    legacy = text.try_cast(field.dataType)
    return F.when(taken, legacy).otherwise(current).alias(name), ~taken | legacy.isNotNull()


def decode(messages: DataFrame, schema: T.StructType, absent_only: bool = True) -> DataFrame:
    """Messages to record columns plus ``body``, the bytes as they came, and ``is_good``.

    Not good: no value, broken UTF-8, anything but one JSON object, or a field of the wrong type.
    ``absent_only`` reads a legacy name only if the present name is absent; otherwise a null under
    the present name also falls back.
    """
    options = {"columnNameOfCorruptRecord": _BAD, "allowSingleQuotes": "false"}
    text = messages.withColumn("_text", F.col("value").cast("string"))
    read = computed_once(text, p=F.from_json("_text", _wire_schema(schema), options))
    bare = F.btrim("_text", F.lit(" \t\r\n"))
    braced = lambda x: F.startswith(x, F.lit("{")) & F.endswith(x, F.lit("}"))
    # Trimming goes through the whole text, so it is left to texts that have blanks around them.
    is_object = braced(F.col("_text")) | braced(bare)
    good = (
        F.col("p").isNotNull()
        & F.col(f"p.{_BAD}").isNull()
        & is_object
        & F.is_valid_utf8(F.col("_text"))
    )
    arrival = [c for c in ARRIVAL if c in messages.columns]
    fields = [_field(f, absent_only) for f in schema.fields]
    for _, fits in fields:
        if fits is not None:
            good = good & fits
    return read.select(
        *[value for value, _ in fields],
        F.col("value").alias("body"),
        F.coalesce(good, F.lit(False)).alias("is_good"),
        *arrival,
    )


def split_good(
    decoded: DataFrame, schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """(records, quarantined bodies) of a decoded batch."""
    arrival = [c for c in ARRIVAL if c in decoded.columns]
    good = decoded.where("is_good").select(*schema.names, *arrival)
    bad = decoded.where(~F.col("is_good")).select("body", *arrival)
    return good, bad
