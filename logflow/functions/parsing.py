"""Parsing of textual and JSON record values.  A bad value becomes an error text, never a failed job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _nonempty(c: Column) -> Column:
    return F.when(c != "", c)


def action_parts(value: str = "value") -> tuple[Column, Column]:
    """``ACTION:amount`` → (action, amount text); a missing amount is ``'0'``, a null value gives nulls."""
    parts = F.split(F.col(value), ":")
    text = F.coalesce(_nonempty(F.get(parts, F.lit(1))), F.lit("0"))
    return F.get(parts, F.lit(0)), F.when(F.col(value).isNotNull(), text)


def parse_action(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``action``, ``amount_text``, ``amount`` and ``error`` (null when the amount is usable).

    The word ``complete`` counts as 0; anything else must be an integer.
    """
    action, text = action_parts(value)
    amount = F.when(text == "complete", F.lit(0)).otherwise(text.try_cast("int")).cast("bigint")
    return (
        df.withColumns({"action": action, "amount_text": text})
        .withColumn("amount", amount)
        .withColumn(
            "error",
            F.when(
                F.col("amount").isNull(),
                F.concat(F.lit("not a number: "), F.coalesce(F.col("amount_text"), F.lit("null"))),
            ),
        )
    )


# Fixed value: layout of a typed text record.
TEXT_RECORD = r"^\[([^\]]*)\] Region: ([^|]*?) \| Message #(\d+) \| Timestamp: (\d+)$"


def text_record(kind: Column, region: Column, number: Column, millis: Column) -> Column:
    return F.concat(
        F.lit("["),
        kind,
        F.lit("] Region: "),
        region,
        F.lit(" | Message #"),
        number.cast("string"),
        F.lit(" | Timestamp: "),
        millis.cast("string"),
    )


def parse_text_record(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``type``, ``region``, ``message_no`` and ``ts_ms``; all null when the text does not fit."""
    v = F.col(value)
    fits = v.rlike(TEXT_RECORD)

    def part(i: int) -> Column:
        return F.when(fits, F.regexp_extract(v, TEXT_RECORD, i))

    return df.withColumns(
        {
            "type": part(1),
            "region": part(2),
            "message_no": part(3).try_cast("bigint"),
            "ts_ms": part(4).try_cast("bigint"),
        }
    )


def has_type(kind: str, value: str = "value") -> Column:
    """The value mentions ``[kind]`` (literal text)."""
    return F.col(value).contains(f"[{kind}]")


def mentions(text: str, value: str = "value") -> Column:
    return F.col(value).contains(text)


def parse_transfer(df: DataFrame, value: str = "value") -> DataFrame:
    """``TXN:debit:100`` → ``direction``, ``amount`` and ``signed_amount`` (debits negative)."""
    parts = F.split(F.col(value), ":")
    direction = F.when(F.get(parts, F.lit(0)) == "TXN", F.get(parts, F.lit(1)))
    amount = F.when(direction.isNotNull(), F.get(parts, F.lit(2)).try_cast("bigint"))
    signed = F.when(direction == "debit", -amount).when(direction == "credit", amount)
    return df.withColumns({"direction": direction, "amount": amount, "signed_amount": signed})


def looks_malformed(value: str = "value") -> Column:
    """Quick check: an opening brace at the start and no closing brace anywhere."""
    v = F.col(value)
    return v.startswith("{") & ~v.contains("}")


def is_json(value: str = "value") -> Column:
    """True when the value parses as JSON (null value: null)."""
    v = F.col(value)
    return F.when(v.isNotNull(), F.try_parse_json(v).isNotNull())


def not_json(value: str = "value") -> Column:
    """True when the value does not parse as JSON; a null value is none.  The rule of all dead letters."""
    return ~F.coalesce(is_json(value), F.lit(False))


def json_field(name: str, type_name: str, value: str = "value") -> Column:
    """A typed field of a JSON value; null when the value or the field does not convert."""
    return F.try_variant_get(F.try_parse_json(F.col(value)), f"$.{name}", type_name)


def decode(
    df: DataFrame,
    schema: T.StructType,
    rules: list[tuple[str, Column]] | None = None,
    value: str = "value",
    out: str = "decoded",
) -> DataFrame:
    """Decode a JSON value into the struct ``out`` and list what is wrong in ``errors``.

    ``rules`` are (code, condition that makes the record invalid) over the decoded fields; they see
    the struct as ``out``.  Unparseable text gets the single code ``not_json``.
    """
    valid = is_json(value)
    parsed = df.withColumn("_valid", F.coalesce(valid, F.lit(False))).withColumn(
        out, F.when(F.col("_valid"), F.from_json(F.col(value), schema))
    )
    codes = [F.when(~F.col("_valid"), F.lit("not_json"))]
    for code, bad in rules or []:
        codes.append(F.when(F.col("_valid") & F.coalesce(bad, F.lit(True)), F.lit(code)))
    return parsed.withColumn("errors", F.array_compact(F.array(*codes))).drop("_valid")


def on_error(
    decoded: DataFrame, action: str, out: str = "decoded", default: Column | None = None
) -> DataFrame:
    """Apply one policy to the rows that ``decode`` marked.

    ``skip`` drops them, ``default`` replaces the struct, ``fail`` raises, ``dlt`` keeps only them
    (the quarantine side of a split).
    """
    bad = F.size("errors") > 0
    if action == "skip":
        return decoded.where(~bad)
    if action == "dlt":
        return decoded.where(bad)
    if action == "default":
        if default is None:
            raise ValueError("a default value is needed")
        return decoded.withColumn(out, F.when(bad, default).otherwise(F.col(out)))
    if action == "fail":
        stop = F.raise_error(F.concat(F.lit("bad record: "), F.array_join("errors", ",")))
        # In a filter, so that it also runs where nobody selects the decoded column.
        return decoded.where(F.when(bad, stop.cast("boolean")).otherwise(F.lit(True)))
    raise ValueError(f"unknown action {action!r}")


def required_errors(required: list[str], symbols: dict[str, list[str]] | None = None) -> Column:
    """Array of ``<field>_missing`` / ``<field>_unknown`` codes for one typed record."""
    codes = [F.when(F.col(f).isNull(), F.lit(f"{f}_missing")) for f in required]
    for field, allowed in (symbols or {}).items():
        codes.append(F.when(~F.col(field).isin(allowed), F.lit(f"{field}_unknown")))
    return F.array_compact(F.array(*codes))
