"""Wire messages: decode, validate, route the malformed away, encode."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmetrics.functions.values import fits_int, number_or_null, timestamp_or_null
from fleetmetrics.schemas import BUFFER, MACHINE_NAME_LENGTH, READING_KEYS

INVALID_JSON = "invalid_json"
MISSING_FIELD = "missing_field"
CONSTRAINT = "constraint"

_MESSAGE = "array<struct<" + ",".join(f"{k}:string" for k in READING_KEYS) + ">>"
_STRICT = {"allowSingleQuotes": "false"}


def _parsed_items(text: Column) -> Column:
    """The text as the items of an array; null when that is not valid JSON.

    The JSON reader stops at the end of the first value. Wrapping the text in
    an array makes it read on to our closing bracket, so trailing text fails.
    """
    return F.from_json(F.concat(F.lit("["), text, F.lit("]")), _MESSAGE, _STRICT)


def _whole_object(text: Column, items: Column) -> Column:
    """The message's fields as text, or null unless it is one JSON object.

    Only a text holding ``}]`` could have closed our array early; for those, a
    second wrapping in an object has to parse too.
    """
    held = F.from_json(
        F.concat(F.lit('[{"held":'), text, F.lit("}]")),
        "array<struct<held:string>>",
        _STRICT,
    )
    closes = F.contains(text, F.lit("]")) & text.rlike(r"\}\s*\]")
    complete = ~closes | held.isNotNull()
    return F.when((F.size(items) == 1) & complete, items[0])


def _first(conditions: dict[str, Column]) -> Column:
    """Name of the first condition that holds, in order; null when none does."""
    return F.coalesce(*[F.when(c, F.lit(name)) for name, c in conditions.items()])


def violated_column(columns: dict[str, Column]) -> Column:
    """First typed column that breaks its NOT NULL, length or type rule."""
    return _first(
        {
            name: value.isNull()
            | (F.length(value) > MACHINE_NAME_LENGTH if name == "strMachineName" else F.lit(False))
            for name, value in columns.items()
        }
    )


def _computed_once(frame: DataFrame, kept: list[str], columns: dict[str, Column]) -> DataFrame:
    """Add columns behind an outer generator: filters are not pushed through it.

    Without it a filter on the outcome would be rewritten in terms of the text,
    and every mention of a parsed field would parse the message again.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return frame.select(*kept, F.array(row).alias("__row")).select(*kept, F.inline_outer("__row"))


def classify_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Decode every message once and say why the bad ones are rejected.

    Keeps all input columns; adds the typed reading (null when rejected),
    ``reject_reason`` and ``reject_field``. ``value`` may be text or bytes.
    """
    kept = messages.columns
    checked_text = F.try_validate_utf8(F.col(value).cast("string"))
    parsed = _computed_once(
        messages.withColumn("__text", checked_text).withColumn(
            "__items", _parsed_items(F.col("__text"))
        ),
        kept,
        {
            "__text": F.col("__text"),
            "__fields": _whole_object(F.col("__text"), F.col("__items")),
        },
    )
    text, fields = F.col("__text"), F.col("__fields")

    # json_object_keys is null for a message with a bare NaN, which the reader
    # accepts; such a key is present as text, so a null field is a missing one.
    # CASE branches run in order, so a complete message never lists its keys.
    keys = F.expr("json_object_keys(__text)")
    complete = reduce(lambda a, b: a & b, [fields[key].isNotNull() for key in READING_KEYS])
    missing = _first(
        {
            key: fields[key].isNull() & ~F.coalesce(F.array_contains(keys, key), F.lit(False))
            for key in READING_KEYS
        }
    )
    name = fields["strMachineName"]
    nested_name = (name.startswith("{") | name.startswith("[")) & text.rlike(
        r'"strMachineName"\s*:\s*[\[{]'
    )
    typed = {
        "strMachineName": F.when(~nested_name, name),
        "fA": number_or_null(fields["fA"]),
        "fV": number_or_null(fields["fV"]),
        "nTemperature": number_or_null(fields["nTemperature"]),
        "dtInsert": timestamp_or_null(fields["dtNow"]),
    }
    absent = F.when(complete, F.lit(None)).otherwise(missing)
    converted = _computed_once(
        parsed.withColumn("__absent", F.when(fields.isNotNull(), absent)),
        kept,
        {**typed, "__absent": F.col("__absent"), "__object": fields.isNotNull()},
    )

    checked = {name: F.col(name) for name in typed}
    checked["nTemperature"] = fits_int(checked["nTemperature"])
    violated = F.when(F.col("__object") & F.col("__absent").isNull(), violated_column(checked))
    reason = (
        F.when(~F.col("__object"), INVALID_JSON)
        .when(F.col("__absent").isNotNull(), MISSING_FIELD)
        .when(F.col("__violated").isNotNull(), CONSTRAINT)
    )
    good = F.col("reject_reason").isNull()
    return (
        converted.withColumn("__violated", violated)
        .withColumn("reject_reason", reason)
        .select(
            *kept,
            *[F.when(good, F.col(name)).alias(name) for name in typed],
            "reject_reason",
            F.coalesce("__absent", "__violated").alias("reject_field"),
        )
    )


def decode_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """The accepted readings, typed as the buffer stores them (no id yet)."""
    accepted = classify_messages(messages, value).filter(F.col("reject_reason").isNull())
    kept = [c for c in messages.columns if c != value]
    return accepted.select(*kept, *[f for f in BUFFER.fieldNames() if f != "nId"])


def quarantine_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """The rejected messages with their reason and the field at fault."""
    rejected = classify_messages(messages, value).filter(F.col("reject_reason").isNotNull())
    return rejected.select(*messages.columns, "reject_reason", "reject_field")


def constraint_violations(readings: DataFrame) -> DataFrame:
    """Buffer-typed rows that break a table constraint, with the column at fault."""
    columns = {f: F.col(f) for f in BUFFER.fieldNames() if f != "nId"}
    columns["nTemperature"] = fits_int(columns["nTemperature"])
    return readings.withColumn("reject_field", violated_column(columns)).filter(
        F.col("reject_field").isNotNull()
    )


def encode_messages(readings: DataFrame, value: str = "value") -> DataFrame:
    """Buffer rows as wire JSON; other columns are kept beside the text."""
    stamp = F.date_format("dtInsert", "yyyy-MM-dd HH:mm:ss")
    body = F.struct("strMachineName", "fA", "fV", "nTemperature", stamp.alias("dtNow"))
    encoded = F.to_json(body, {"ignoreNullFields": "false"})
    kept = [c for c in readings.columns if c not in BUFFER.fieldNames() or c == "nId"]
    return readings.select(*kept, encoded.alias(value))
