"""Turning a model reply into the fixed extraction record, as Spark columns.

A reply passes through ``variant`` so that JSON types survive until coercion.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsheaf import constants as C
from docsheaf import schemas
from docsheaf.functions.text import WS, py_strip
from docsheaf.session import computed_once, configure

STRICT, REPAIRED, FALLBACK, FAILED = "strict", "repaired", "fallback", "failed"

# a decimal number or a named value as text, as Python's float() reads it
_DIGITS = r"[0-9](?:_?[0-9])*"
_FLOAT_TEXT = (
    rf"^[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    r"|(?i:inf|infinity|nan))$"
)


# --- from reply text to a JSON value -------------------------------------------


def json_block(raw: Column) -> Column:
    """Without code fences, from the first ``{`` to the last ``}``, else all of it."""
    bare = py_strip(F.regexp_replace(raw, r"```(?:json)?", ""))
    return F.coalesce(F.nullif(F.regexp_extract(bare, r"(?s)\{.*\}", 0), F.lit("")), bare)


def _parse_wrapped(text: Column) -> Column:
    """The variant of a text that is exactly one JSON value, else null.

    The parser stops after one value, so the text is parsed as the only element
    of an array. A text could close that array itself; closing an object
    wrapper too is then impossible, so in doubt both must parse.
    """
    array = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    single = F.try_variant_get(array, "$[1]", "variant").isNull()
    closes_array = ~F.startswith(text, F.lit("{")) | F.rlike(text, F.lit(rf"\}}{WS}*\]"))
    as_member = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    sound = F.when(closes_array, as_member.isNotNull()).otherwise(True)
    return F.when(single & sound, F.try_variant_get(array, "$[0]", "variant"))


# Named numbers become strings that begin with a sign no text has.
_MARK, _END = "\ufdd0", "\ufdd1"
_NAMED = rf"^{_MARK}(NaN|-?Infinity)$"


def _quote_named_numbers(text: Column) -> Column:
    """Strings are matched first and stay as they are; a name counts only as a value."""
    string, named = r'"(?:[^"\\]|\\.)*+"', r"NaN|-?Infinity"
    marked = F.regexp_replace(
        text,
        rf"({string})|((?:^|[:\[,]){WS}*)({named})(?={WS}*(?:[,\]}}]|$))",
        rf"$1$2{_MARK}$3{_END}",
    )
    # the marks after strings are empty
    marked = F.replace(marked, F.lit(_MARK + _END), F.lit(""))
    return F.regexp_replace(marked, rf"{_MARK}({named}){_END}", rf'"{_MARK}$1"')


def strict_json(text: Column) -> Column:
    """Strict parse that also knows NaN and Infinity."""
    named = F.rlike(text, F.lit("NaN|Infinity")) & ~F.contains(text, F.lit(_MARK))
    return F.coalesce(
        _parse_wrapped(text), F.when(named, _parse_wrapped(_quote_named_numbers(text)))
    )


def without_trailing_commas(text: Column) -> Column:
    return F.regexp_replace(text, rf",{WS}*([}}\]])", "$1")


# --- typed access ----------------------------------------------------------------


def _field(value: Column, name: str) -> Column:
    """The member as a variant: null if missing, variant null if JSON null."""
    return F.try_variant_get(value, f"$.{name}", "variant")


def _as(value: Column, ddl: str) -> Column:
    return F.try_variant_get(value, "$", ddl)


def json_type(value: Column) -> Column:
    """OBJECT, ARRAY, STRING, BOOLEAN, VOID (JSON null) or a number type; null if missing."""
    kind = F.substring_index(F.schema_of_variant(value), "<", 1)
    named = (kind == "STRING") & F.rlike(_as(value, "string"), F.lit(_NAMED))
    return F.when(named, "DOUBLE").otherwise(kind)


def _number_shown(text: Column) -> Column:
    """A named number by its Python name; other text as it is."""
    name = F.replace(F.lower(F.substring(text, 2, 9)), F.lit("infinity"), F.lit("inf"))
    return F.when(F.rlike(text, F.lit(_NAMED)), name).otherwise(text)


def _shown(value: Column, kind: Column) -> Column:
    """A present value as text; null and booleans by their Python names."""
    text = _as(value, "string")
    return (
        F.when(kind == "VOID", "None")
        .when(kind == "BOOLEAN", F.initcap(text))
        .when(kind == "STRING", text)
        .otherwise(_number_shown(text))
    )


# --- coercion of each field, given its value and JSON type -------------------------


def coerce_summary(value: Column, kind: Column) -> Column:
    text = F.nullif(py_strip(_shown(value, kind)), F.lit(""))
    return F.coalesce(text, F.lit(C.DEFAULT_SUMMARY))


def _keys_as_written(value: Column, text: Column, path: str) -> Column:
    """The keys of an object in the order of the reply.

    A variant sorts them. Where the text has other keys at the path (an object
    is repeated, of which the last counts) or cannot be read that way, the order
    is the variant's.
    """
    keys = F.map_keys(_as(value, "map<string,variant>"))
    written = F.array_distinct(F.json_object_keys(F.get_json_object(text, path)))
    return F.when(F.array_sort(written) == F.array_sort(keys), written).otherwise(keys)


def coerce_names(value: Column, kind: Column, text: Column, path: str) -> Column:
    """Null marks a type that has no elements, which fails the reply.

    ``text`` is the JSON in which the value stands at ``path``.

    An element that is null has the name that text shows for it, here and so in
    every file and count.
    """
    named = lambda t: F.coalesce(F.regexp_replace(t, _NAMED, "$1"), F.lit("None"))
    return (
        F.when(kind.isNull(), F.array().cast("array<string>"))
        .when(kind == "ARRAY", F.transform(_as(value, "array<string>"), named))
        .when(kind == "OBJECT", _keys_as_written(value, text, path))
        .when(kind == "STRING", F.filter(F.split(_as(value, "string"), ""), lambda c: c != ""))
    )


def coerce_label(value: Column, kind: Column) -> Column:
    label = F.lower(_shown(value, kind))
    return F.when(label.isin(*C.LABELS), label).otherwise(C.DEFAULT_LABEL)


def coerce_confidence(value: Column, kind: Column) -> Column:
    text = py_strip(_as(value, "string"))
    plain = F.replace(text, F.lit("_"), F.lit(""))
    number = (
        F.when(kind == "STRING", F.when(F.rlike(text, F.lit(_FLOAT_TEXT)), plain.try_cast("double")))
        .when(kind == "BOOLEAN", _as(value, "boolean").cast("double"))
        .when(F.rlike(text, F.lit(_NAMED)), F.substring(text, 2, 9).try_cast("double"))
        .otherwise(_as(value, "double"))
    )
    # NaN counts as the largest number, so it becomes 1
    given = F.coalesce(number, F.lit(C.DEFAULT_CONFIDENCE))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), given))


def coerce_questions(value: Column, kind: Column) -> Column:
    listed = F.transform(_as(value, "array<variant>"), lambda q: _shown(q, json_type(q)))
    given = (
        F.when(kind.isNull(), F.array().cast("array<string>"))
        .when(kind == "ARRAY", listed)
        .otherwise(F.array(_shown(value, kind)))
    )
    pads = F.array_repeat(F.lit(C.QUESTION_PAD), C.QUESTION_COUNT)
    return F.slice(F.concat(given, pads), 1, C.QUESTION_COUNT)


# --- the record for a reply that is not JSON ---------------------------------------------


def fallback_summary(raw: Column) -> Column:
    found = F.regexp_extract(raw, rf'"summary"{WS}*:{WS}*"([^"]+)"', 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(C.FALLBACK_SUMMARY))


def fallback_label(raw: Column) -> Column:
    labels = "|".join(C.LABELS)
    found = F.lower(F.regexp_extract(raw, rf'(?iu)"label"{WS}*:{WS}*"({labels})"', 1))
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(C.DEFAULT_LABEL))


# --- the whole chain ------------------------------------------------------------------------

# the fields of a reply, by the object that holds them
_TOP = ("summary", "entities", "sentiment", "key_questions")
_NAMES = ("people", "places", "organizations")
_IN_SENTIMENT = ("label", "confidence")


def _json_steps(df: DataFrame, raw: Column) -> DataFrame:
    """Add ``_path`` and, where the path leads to an object, ``_reply``."""
    block = F.col("_json")
    return (
        df.withColumn("_json", json_block(raw))
        .withColumn("_strict", strict_json(block))
        .withColumn(
            "_repaired",
            F.when(F.col("_strict").isNull(), strict_json(without_trailing_commas(block))),
        )
        .withColumn("_reply", F.coalesce("_strict", "_repaired"))
        .withColumn("_type", json_type(F.col("_reply")))
        .withColumn(
            "_path",
            F.when(raw.isNull() | (py_strip(raw) == ""), FAILED)
            .when(F.col("_type").isNull(), FALLBACK)
            .when(F.col("_type") != "OBJECT", FAILED)
            .when(F.col("_strict").isNotNull(), STRICT)
            .otherwise(REPAIRED),
        )
        .withColumn("_reply", F.when(F.col("_path").isin(STRICT, REPAIRED), F.col("_reply")))
    )


def _field_steps(df: DataFrame) -> DataFrame:
    """Add each field's value ``_v_*`` and JSON type ``_t_*``."""

    def fetch(df, holder, names):
        df = df.withColumns({f"_v_{n}": _field(holder, n) for n in names})
        return df.withColumns({f"_t_{n}": json_type(F.col(f"_v_{n}")) for n in names})

    def object_field(name):
        return F.when(F.col(f"_t_{name}") == "OBJECT", F.col(f"_v_{name}"))

    df = fetch(df, F.col("_reply"), _TOP)
    df = fetch(df, object_field("entities"), _NAMES)
    return fetch(df, object_field("sentiment"), _IN_SENTIMENT)


def parse_replies(df: DataFrame, column: str = "raw") -> DataFrame:
    """Add the extraction fields, ``parse_path`` and, for failures, ``reason``.

    A narrow projection in small steps, so that no value is computed twice.
    Rows without a reply (null) get path ``failed`` and no reason. Of repeated
    keys the last counts, which is a setting of the session made here.
    """
    configure(df.sparkSession)
    keep, raw = df.columns, F.col(column)
    steps = _field_steps(_json_steps(df, raw))

    block = F.col("_json")
    text = F.when(F.col("_path") == REPAIRED, without_trailing_commas(block)).otherwise(block)

    def names(name):
        found = coerce_names(F.col(f"_v_{name}"), F.col(f"_t_{name}"), text, f"$.entities.{name}")
        return F.when(F.col("_path") != FAILED, found)

    steps = steps.withColumns({f"_{name}": names(name) for name in _NAMES})
    steps = steps.withColumn(
        "_final",
        F.when(F.greatest(*[F.col(f"_{n}").isNull() for n in _NAMES]), FAILED).otherwise(
            F.col("_path")
        ),
    )

    def choose(fallback: Column, coerced: Column) -> Column:
        return F.when(F.col("_final") == FALLBACK, fallback).when(
            F.col("_final") != FAILED, coerced
        )

    def coerced(rule, name):
        return rule(F.col(f"_v_{name}"), F.col(f"_t_{name}"))

    entities = F.struct(*[F.col(f"_{n}").alias(n) for n in _NAMES])
    sentiment = F.struct(
        choose(fallback_label(raw), coerced(coerce_label, "label")).alias("label"),
        choose(F.lit(C.FALLBACK_CONFIDENCE), coerced(coerce_confidence, "confidence")).alias("confidence"),
    )
    done = F.col("_final") != FAILED
    no_questions = F.array_repeat(F.lit(C.FALLBACK_QUESTION), C.QUESTION_COUNT)
    records = steps.select(
        *keep,
        choose(fallback_summary(raw), coerced(coerce_summary, "summary")).alias("summary"),
        F.when(done, entities).cast(schemas.ENTITIES).alias("entities"),
        F.when(done, sentiment).cast(schemas.SENTIMENT).alias("sentiment"),
        choose(no_questions, coerced(coerce_questions, "key_questions")).alias("key_questions"),
        F.when(F.col("_final") == FALLBACK, True).alias("parse_error"),
        F.col("_final").alias("parse_path"),
        F.when(raw.isNull() | done, None)
        .when(py_strip(raw) == "", "empty reply")
        .when(F.col("_path") == FAILED, "reply is not an object")
        .otherwise("entity list has a wrong type")
        .alias("reason"),
    )
    # the path alone is held back: filters on it stay above, and other fields can be pruned
    return computed_once(records, "parse_path")
