"""JSON messages: writing, reading, decoding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewatch.schema import CATEGORIES, quoted

BAD = "_bad"


def message_columns(df: DataFrame, drop: Sequence[str] = ("Downtime",), key: str = "Machine_ID") -> list[Column]:
    """``key`` and ``value``: a row as a JSON object without the label; nulls and NaN are written as null."""

    def clean(field: T.StructField):
        c = F.col(quoted(field.name))
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        return c.alias(field.name)

    body = F.struct(*[clean(f) for f in df.schema.fields if f.name not in drop])
    value = F.to_json(body, {"ignoreNullFields": "false"}).alias("value")
    if key not in df.columns:
        return [F.lit(None).cast("string").alias("key"), value]
    return [F.col(quoted(key)).cast("string").alias("key"), value]


def to_messages(df: DataFrame, drop: Sequence[str] = ("Downtime",), key: str = "Machine_ID") -> DataFrame:
    """The :func:`message_columns` of all rows."""
    return df.select(*message_columns(df, drop, key))


def kafka_options(
    servers: str, topic: str, user: str, password: str, per_trigger: int = 100_000
) -> dict[str, str]:
    """Reader options for a TLS broker with a user and password, from the start
    of the topic."""
    login = "org.apache.kafka.common.security.plain.PlainLoginModule"
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": str(per_trigger),
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": f'{login} required username="{user}" password="{password}";',
    }


#: How long the log of a file source keeps parts that a later part holds whole. Spark keeps them for ten minutes, and each micro-batch lists all
#: that are kept: thousands of short micro-batches would get slower with each one. A restart needs none of them.
LOG_DELAY = {"spark.sql.streaming.fileSource.log.cleanupDelay": "1s"}

#: Columns that order the messages of a log, where the source has them.
SOURCE_ORDER = ["sent_at", "partition", "offset"]


def message_source(spark: SparkSession, config: Mapping[str, str]) -> DataFrame:
    """A stream of ``value`` text from ``{"kind": "kafka", ...options}`` or ``{"kind": "log", "path": ...}`` (a stored log), with the message's timestamp, partition and
    offset, or ``{"kind": "files", "path": ..., "files_per_trigger": ...}``, which shortens the log of file sources in a session that sets no delay of its own. A broker's log must come with
    ``maxOffsetsPerTrigger``, which bounds a micro-batch; a stored one is paced by its interval."""
    options = {k: v for k, v in config.items() if k not in ("kind", "path", "files_per_trigger")}
    if config["kind"] == "kafka":
        if "maxOffsetsPerTrigger" not in options:
            raise ValueError("set maxOffsetsPerTrigger: it bounds what one micro-batch holds")
        stream = spark.readStream.format("kafka").options(**options).load()
        return stream.select(
            F.col("value").cast("string").alias("value"), F.col("timestamp").alias("sent_at"), "partition", "offset"
        )
    if config["kind"] == "log":
        from linewatch.sources.log import read_message_log

        return read_message_log(spark, config["path"], **options).select("value", *SOURCE_ORDER)
    if config["kind"] == "files":
        for key, value in LOG_DELAY.items():
            if spark.conf.get(key, None) is None:
                spark.conf.set(key, value)
        per_trigger = str(config.get("files_per_trigger", 1))
        reader = spark.readStream.options(**options).option("maxFilesPerTrigger", per_trigger)
        return reader.text(config["path"])
    raise ValueError(f"unknown message source {config['kind']!r}")


def decode(messages: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``value`` to ``machine_id, assembly_line_no, data``, ``extra`` and ``_bad``.

    All payload fields are read as text, so one odd value costs that value only; ``extra`` maps the fields that are not
    asked for to their text, and is null without any.
    ``_bad`` holds the text of a message that is no JSON object or names no
    machine or line.
    """
    names = [*dict.fromkeys([*fields, *CATEGORIES])]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, BAD]])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    parsed = messages.withColumn("_m", F.from_json("value", schema, options))
    machine, line = (F.col("_m").getField(c) for c in CATEGORIES)
    bad = (
        F.col("_m").isNull() | F.col("_m").getField(BAD).isNotNull() | machine.isNull() | line.isNull()
    )
    everything = F.from_json("value", "map<string,string>")
    # An array without its empty map, and the first of it: the message is parsed once for this, where a condition on the map would parse it again.
    other = F.map_filter(everything, lambda k, _: ~k.isin(names))
    extra = F.get(F.filter(F.array(other), lambda m: F.size(m) > 0), F.lit(0))
    return parsed.select(
        machine.alias("machine_id"),
        line.alias("assembly_line_no"),
        F.struct(*[F.col("_m").getField(n).alias(n) for n in names]).alias("data"),
        extra.alias("extra"),
        F.when(bad, F.coalesce("value", F.lit(""))).alias(BAD),
        *[c for c in messages.columns if c not in ("key", "value")],
    )


def good(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(BAD).isNull()).drop(BAD)


def dead_letters(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(BAD).isNotNull()).select(F.col(BAD).alias("value"))
