"""Sensor messages: JSON text to typed rows with a reject reason, and back."""

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from machpulse.functions.fixed_values import MACHINE_ID_RANGE, MEASURES, MESSAGE_FIELDS

# Complete calendar date, optionally followed by a time and an offset.
ISO_TIME = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.]\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$"
OFFSET = r"\d{2}:\d{2}.*(Z|[+-]\d{2}:\d{2})$"
# Spellings the JVM reads as numbers and JSON producers do not mean: 1.0d, 2f, 0x1p3.
JVM_ONLY_NUMBER = r"[0-9.][dDfF]\s*$|[xX]"
# Bare constants come back from the JSON reader with quotes around them.
QUOTED_CONSTANT = r'^"(NaN|-?Infinity|[+-]INF)"$'

_TEXT_FIELDS = "array<struct<" + ",".join(f"{f}:string" for f in MESSAGE_FIELDS) + ">>"


def _number(text: Column) -> Column:
    # Nearly every text ends in a digit and holds no exponent marker of a hex float.
    plain = F.right(text, F.lit(1)).between("0", "9") & ~F.contains(text, F.lit("p")) & ~F.contains(text, F.lit("P"))
    constant = F.regexp_replace(text, QUOTED_CONSTANT, "$1")
    return F.when(plain, text.try_cast("double")).when(~text.rlike(JVM_ONLY_NUMBER), constant.try_cast("double"))


def _utc_time(text: Column) -> Column:
    """Timestamp without zone. An offset is applied, a text without one is taken as UTC already."""
    local = text.try_cast("timestamp").cast("timestamp_ntz")
    shifted = F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)
    return F.when(text.rlike(ISO_TIME), F.when(text.rlike(OFFSET), shifted).otherwise(text.try_cast("timestamp_ntz")))


# Texts that stand for numbers where a program converts them: signs, blanks around, underscores between digits.
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
INTEGER_TEXT = rf"^\s*[+-]?{_DIGITS}\s*$"
FLOAT_TEXT = rf"(?i)^\s*[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?|nan|inf|infinity)\s*$"
# A constant that JSON lacks and its producers write.
BARE_CONSTANT = r"([:,\[]\s*)(-?Infinity|NaN)(?=\s*[,}\]])"


def _typed_texts(df: DataFrame, value_col: str) -> DataFrame:
    """``__object, __id, __time`` and the measures, by the types that the JSON values have."""
    text = F.col(value_col).cast("string")
    # Inside an array, trailing text is an error instead of being ignored.
    wrapped = F.concat(F.lit("["), text, F.lit("]"))
    quoted = F.regexp_replace(wrapped, BARE_CONSTANT, '$1"$2"')
    whole = F.is_valid_utf8(F.col(value_col)) & F.rtrim(F.translate(text, "\t\r\n", "   ")).endswith("}")
    staged = df.withColumn("__value", F.when(whole, F.coalesce(F.try_parse_json(wrapped), F.try_parse_json(quoted))))

    def part(path: str, kind: str) -> Column:
        return F.try_variant_get("__value", path, kind)

    staged = staged.withColumns(
        {
            "__object": F.schema_of_variant(part("$[0]", "variant")).startswith("OBJECT") & part("$[1]", "variant").isNull(),
            **{f"__kind_{f}": F.schema_of_variant(part(f"$[0].{f}", "variant")) for f in MESSAGE_FIELDS},
            **{f"__text_{f}": part(f"$[0].{f}", "string") for f in MESSAGE_FIELDS},
        }
    )

    def plain(field: str) -> Column:
        return F.regexp_replace(F.col(f"__text_{field}"), r"[_\s]", "")

    def converted(field: str, shape: str) -> Column:
        kind, held = F.col(f"__kind_{field}"), F.col(f"__text_{field}")
        number = kind.rlike("^(BIGINT|DECIMAL|DOUBLE)")
        return (
            F.when(kind == "BOOLEAN", F.when(held == "true", 1.0).otherwise(0.0))
            .when(number, held.try_cast("double"))
            .when((kind == "STRING") & held.rlike(shape), plain(field).try_cast("double"))
        )

    machine = converted("machine_id", INTEGER_TEXT)
    machine = F.when(F.isnan(machine) | (F.abs(machine) == F.lit(float("inf"))), None).otherwise(machine)
    cut = F.when(machine < 0, F.ceil(machine)).otherwise(F.floor(machine)).cast("double")
    return staged.withColumns(
        {
            "__id": cut,
            "__time": _utc_time(F.col("__text_datetime_mes")),
            **{f"__{f}": converted(f, FLOAT_TEXT) for f in MEASURES},
            "__missing": reduce(or_, [F.col(f"__kind_{f}").isNull() for f in MESSAGE_FIELDS]),
        }
    )


def _plain_texts(df: DataFrame, value_col: str) -> DataFrame:
    """The same from the texts of the JSON values, whatever their types."""
    text = F.col(value_col).cast("string")
    # Inside an array, trailing text or a second object is an error instead of being ignored.
    wrapped = F.from_json(F.concat(F.lit("["), text, F.lit("]")), _TEXT_FIELDS, {"allowSingleQuotes": "false"})
    one_object = F.is_valid_utf8(F.col(value_col)) & (F.size("__parsed") == 1)
    staged = (
        df.withColumn("__parsed", wrapped)
        .withColumn("__fields", F.when(one_object, F.try_element_at("__parsed", F.lit(1))))
        .drop("__parsed")
    )
    texts = {f: F.col("__fields")[f] for f in MESSAGE_FIELDS}
    return staged.withColumns(
        {
            "__object": F.col("__fields").isNotNull(),
            "__id": _number(texts["machine_id"]),
            "__time": _utc_time(texts["datetime_mes"]),
            **{f"__{f}": _number(texts[f]) for f in MEASURES},
            "__missing": reduce(or_, [t.isNull() for t in texts.values()]),
        }
    )


def parse_messages(
    df: DataFrame, value_col: str = "value", machine_ids: tuple[int, int] = MACHINE_ID_RANGE, typed: bool = False
) -> DataFrame:
    """Add the six typed fields and ``malformed_reason`` (NULL for a well-formed message).

    Reasons, in checking order: ``json_invalide``, ``champ_manquant``, ``type_invalide``,
    ``horodatage_invalide``. Unknown keys are ignored. A fractional or boolean machine id is a type
    error, and so is an id outside ``machine_ids``, by default all that the column holds. NaN and infinities are
    numbers. Text in single quotes is not JSON.

    ``typed`` converts by the types of the values instead, as a program would: 1.9 is machine 1 and true is 1, the text
    "1.9" is no machine id but a measure, blanks around and underscores between digits are allowed in texts; a null is a
    type error and only an absent field is missing. An object with a field twice is not read.
    """
    staged = (_typed_texts if typed else _plain_texts)(df, value_col)
    low, high = machine_ids
    whole = (F.col("__id") == F.floor("__id")) & F.col("__id").between(low, high)
    mistyped = reduce(or_, [F.col(f"__{f}").isNull() for f in MEASURES], ~F.coalesce(whole, F.lit(False)))
    reason = (
        F.when(~F.coalesce("__object", F.lit(False)), "json_invalide")
        .when(F.col("__missing"), "champ_manquant")
        .when(mistyped, "type_invalide")
        .when(F.col("__time").isNull(), "horodatage_invalide")
    )
    row = F.struct(
        F.when(whole, F.col("__id")).cast("int").alias("machine_id"),
        F.col("__time").alias("datetime_mes"),
        *[F.col(f"__{f}").alias(f) for f in MEASURES],
        reason.alias("malformed_reason"),
    )
    # Filters on the result stay above a generator; pushed below, they would parse every message again.
    return staged.select(*df.columns, F.inline(F.array(row)))


def to_messages(df: DataFrame) -> DataFrame:
    """(key, value): the machine id keeps one machine's messages in order, the value is the JSON text."""
    body = F.to_json(F.struct(*MESSAGE_FIELDS), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"})
    return df.select(F.col("machine_id").cast("string").alias("key"), body.alias("value"))


def topic_matches(topic: Column, pattern: str) -> Column:
    """Topic filter in which ``+`` stands for exactly one level."""
    levels = [r"[^/]+" if level == "+" else re.escape(level) for level in pattern.split("/")]
    return topic.rlike("^" + "/".join(levels) + "$")
