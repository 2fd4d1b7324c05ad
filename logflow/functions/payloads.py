"""Building and unwrapping record values: JSON, CSV, typed envelopes, framed binary, test payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(**fields: str) -> T.StructType:
    schema = T.StructType()
    for name, type_name in fields.items():
        schema.add(name, type_name)
    return schema


# Field names and types of the domain records.
ORDER_SCHEMA = _schema(
    orderId="string",
    customerId="string",
    product="string",
    quantity="integer",
    price="decimal(10,2)",
    status="string",
    createdAt="timestamp",
)
USER_SCHEMA = _schema(userId="string", name="string", email="string", department="string")
ORDER_V1 = _schema(
    orderId="string",
    customerId="string",
    product="string",
    quantity="integer",
    totalPrice="double",
    status="string",
    timestamp="long",
)
ORDER_V2 = T.StructType([*ORDER_V1.fields, T.StructField("shippingAddress", T.StringType())])
USER_EVENT_SCHEMA = T.StructType(
    [
        *_schema(userId="string", email="string", name="string", eventType="string", timestamp="long").fields,
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    ]
)

# Enum symbols.
ORDER_STATUS = ["PENDING", "CONFIRMED", "SHIPPED", "DELIVERED", "CANCELLED"]
USER_EVENT_TYPES = ["CREATED", "UPDATED", "DELETED", "LOGIN", "LOGOUT"]
USER_EVENT_TYPES_INLINE = ["CREATED", "UPDATED", "DELETED", "LOGIN"]

ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def json_value(*columns: Column | str) -> Column:
    """A JSON object of the given columns; decimals keep their digits, timestamps are ISO in UTC."""
    return F.to_json(F.struct(*columns), {"timestampFormat": ISO_MILLIS, "timeZone": "UTC"})


def user_events(values: DataFrame, value: str = "value") -> DataFrame:
    """JSON user events as typed columns in place of ``value``: times of a millisecond, attributes as a map or null.

    A value that is no such record gives nulls; ``parsing.required_errors`` names what is missing or unknown.
    """
    rest = [c for c in values.columns if c != value]
    typed = values.select(*rest, F.from_json(value, USER_EVENT_SCHEMA).alias("_event")).select(*rest, "_event.*")
    return typed.withColumn("timestamp", F.timestamp_millis("timestamp"))


def envelope(kind: Column | str, payload: Column, timestamp: Column, version: str = "1.0") -> Column:
    """``{type, version, payload, timestamp}`` as JSON."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return json_value(
        kind.alias("type"),
        F.lit(version).alias("version"),
        payload.alias("payload"),
        timestamp.alias("timestamp"),
    )


def unwrap(df: DataFrame, payloads: dict[str, T.StructType], value: str = "value") -> DataFrame:
    """Add ``type``, ``version`` and one struct column per known payload type, null for the others."""
    head = F.from_json(F.col(value), "type STRING, version STRING, payload STRING")
    opened = df.withColumn("_head", head).withColumns(
        {"type": F.col("_head.type"), "version": F.col("_head.version")}
    )
    branches = {
        name: F.when(F.col("type") == name, F.from_json(F.col("_head.payload"), schema))
        for name, schema in payloads.items()
    }
    return opened.withColumns(branches).drop("_head")


def csv_value(header: list[str], *columns: Column | str) -> Column:
    """A header line and one data line."""
    return F.concat(F.lit(",".join(header) + "\n"), F.to_csv(F.struct(*columns)))


def parse_csv_value(value: str, schema: str) -> Column:
    """The data line of a header + data value, as a struct."""
    return F.from_csv(F.get(F.split(F.col(value), "\n"), F.lit(1)), schema)


FRAME_MAGIC = 0


def frame(schema_id: Column, payload: Column) -> Column:
    """Magic byte 0, the schema id as four big-endian bytes, then the payload."""
    head = F.unhex(F.concat(F.lit("00"), F.lpad(F.hex(schema_id.cast("bigint")), 8, "0")))
    return F.concat(head, payload.cast("binary"))


def unframe(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``magic``, ``schema_id`` and ``payload`` of a framed binary value.

    A value shorter than the 5-byte head, or with another magic byte, has a null schema id and payload.
    """
    v = F.col(value)
    magic = F.conv(F.hex(F.substring(v, 1, 1)), 16, 10).cast("int")
    framed = (F.octet_length(v) >= 5) & (magic == FRAME_MAGIC)
    return df.withColumns(
        {
            "magic": magic,
            "schema_id": F.when(framed, F.conv(F.hex(F.substring(v, 2, 4)), 16, 10).cast("bigint")),
            "payload": F.when(framed, F.expr(f"substring(`{value}`, 6)")),
        }
    )


# Layouts of the generated payloads.
SMALL_FILLER = "short filler text of a record, " * 5 + "end"  # about 200 bytes with the other fields
SMALL_PAYLOAD = '{"id":%d,"timestamp":%d,"data":"' + SMALL_FILLER + '"}'
LARGE_PAYLOAD = '{"timestamp":%d,"data":"%s","metadata":{"source":"benchmark","version":"1.0"}}'


def small_payload(number: Column, millis: Column) -> Column:
    return F.format_string(SMALL_PAYLOAD, number, millis)


def large_payload(millis: Column, filler: int = 400) -> Column:
    return F.format_string(LARGE_PAYLOAD, millis, F.lit("X" * filler))


def attributes(**fields: Column) -> Column:
    """A map<string,string> of the given columns."""
    pairs: list[Column] = []
    for name, column in fields.items():
        pairs += [F.lit(name), column.cast("string")]
    return F.create_map(*pairs)


def prefixed_id(prefix: str, source: Column | None = None) -> Column:
    """``prefix`` + 8 characters: from a hash of ``source``, or random when no source is given."""
    body = F.substring(F.md5(source), 1, 8) if source is not None else F.substring(F.uuid(), 1, 8)
    return F.concat(F.lit(prefix), body)
