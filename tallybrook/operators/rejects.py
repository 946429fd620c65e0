"""Why messages were rejected, and which of them can be mended and sent through again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.operators.decode import REJECTED, computed
from tallybrook.schemas import EventKind, ddl

#: A plain decimal number, as text. Casts alone would also take ``1d`` or ``true``.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

_JSON_TYPES = {
    "STRING": "string",
    "BOOLEAN": "boolean",
    "OBJECT": "object",
    "ARRAY": "array",
}


def _at(value: Column, field: str) -> Column:
    return F.try_variant_get(value, f"$.{field}", "variant")


def _json_type(value: Column) -> Column:
    """What JSON calls the type of a variant; every kind of number is a number."""
    name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    found = F.lit("number")
    for variant, json in _JSON_TYPES.items():
        found = F.when(name == variant, json).otherwise(found)
    return found


def _problem(field: str, dtype: str) -> Column:
    """What is wrong with a field: there is a value, but the decoder reads none."""
    value = _at(F.col("_found"), field)
    unread = value.isNotNull() & ~F.is_variant_null(value) & F.col(f"_read.`{field}`").isNull()
    return F.when(
        unread,
        F.struct(
            F.lit(field).alias("field"),
            F.lit(dtype).alias("expected"),
            _json_type(value).alias("found"),
            F.try_variant_get(F.col("_found"), f"$.{field}", "string").alias("text"),
        ),
    )


def _looked_at(rejects: DataFrame, kind: EventKind, text: Column) -> DataFrame:
    """Adds what the decoder reads of a text, what it holds, and its problems."""
    # Any value can be read as a string.
    typed = {name: dtype for name, dtype in kind.fields.items() if dtype != "string"}
    parsed = computed(rejects, "_read", F.from_json(text, ddl(kind.fields)))
    found = computed(parsed, "_found", F.try_parse_json(text))
    problems = F.array(*[_problem(name, dtype) for name, dtype in typed.items()])
    return computed(found, "problems", F.filter(problems, lambda p: p.isNotNull()))


def _is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def reject_reasons(rejects: DataFrame, kind: EventKind) -> DataFrame:
    """Rejected messages, with ``reason`` and ``problems``.

    ``rejects`` has the text as ``rejected_json``, as ``decode_with_rejects`` and
    ``ingest.quarantine`` give it. The reason is ``null``, ``empty``, ``not json``, ``no object``,
    ``wrong type`` (then every problem has the field, the type it should have, the JSON type it
    has, and its text), or ``readable``: nothing is wrong with it now. Names used twice in an
    object are ``not json``.
    """
    text = F.col(REJECTED)
    known = _looked_at(rejects, kind, text)
    reason = (
        F.when(text.isNull(), "null")
        .when(F.trim(text) == "", "empty")
        .when(F.col("_found").isNull(), "not json")
        .when(~_is_object(F.col("_found")), "no object")
        .when(F.size("problems") > 0, "wrong type")
        .otherwise("readable")
    )
    return known.select(
        *rejects.columns,
        reason.alias("reason"),
        F.when(_is_object(F.col("_found")), F.col("problems")).otherwise(
            F.slice("problems", 1, 0)
        ).alias("problems"),
    )


def _mended(field: str, dtype: str) -> Column:
    """The field as the decoder reads it, else the number that its text spells, if it is exact."""
    read = F.col(f"_read.`{field}`")
    if dtype not in ("int", "double"):
        return read
    spelled = F.try_variant_get(F.col("_found"), f"$.{field}", "string")
    number = F.when(spelled.rlike(NUMBER), F.trim(spelled))
    if dtype == "double":
        return F.coalesce(read, number.try_cast("double"))
    exact = number.try_cast("decimal(38,9)")
    return F.coalesce(read, F.when(exact == F.floor(exact), exact).try_cast("int"))


def mend(rejects: DataFrame, kind: EventKind) -> DataFrame:
    """Adds ``mended_json``: the message with its fields in their types, or NULL.

    Mended are objects that are the only element of an array, and numbers that were sent as text
    or with a zero fraction. A message with any field that can't be mended is left as it is;
    nothing is rounded. Fields outside the schema and NULL fields are left out.
    """
    text = F.col(REJECTED)
    elements = F.from_json(text, "array<string>")
    is_array = F.coalesce(
        F.schema_of_variant(F.try_parse_json(text)).startswith("ARRAY"), F.lit(False)
    )
    inner = F.when(is_array, F.when(F.size(elements) == 1, F.get(elements, 0))).otherwise(text)
    known = _looked_at(computed(rejects, "_text", inner), kind, F.col("_text"))
    fields = [_mended(name, dtype).alias(name) for name, dtype in kind.fields.items()]
    mended = computed(known, "_mended", F.struct(*fields))
    is_whole = _is_object(F.col("_found"))
    for name in kind.fields:
        left = F.array_contains("problems.field", name) & F.col(f"_mended.`{name}`").isNull()
        is_whole = is_whole & ~left
    message = F.when(is_whole, F.to_json("_mended"))
    return computed(mended, "mended_json", message).select(*rejects.columns, "mended_json")


def replay(rejects: DataFrame, kind: EventKind) -> DataFrame:
    """Messages of the rejects that can be mended, ready to be decoded again.

    The lake has a row without fields for each rejected message; these come in addition.
    """
    sound = mend(rejects, kind).where(F.col("mended_json").isNotNull())
    return sound.select(
        F.get_json_object("mended_json", "$.user_id").alias("user_id_key"),
        F.col("mended_json").alias("raw_json"),
        F.lit(kind.topic).alias("topic"),
        "kafka_timestamp",
    )


def beyond_repair(rejects: DataFrame, kind: EventKind) -> DataFrame:
    """The rejects that ``replay`` leaves out."""
    return mend(rejects, kind).where(F.col("mended_json").isNull()).drop("mended_json")
