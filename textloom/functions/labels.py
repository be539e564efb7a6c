"""Label payloads: JSON text with three words and seven numbers, read strictly or leniently.

Numbers may be written as strings or booleans, must be present and readable, and
have no range. Words must be JSON strings. Further keys are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.text import let

# The fields of a payload, and the values of the enumerations.
WORDS = ("main_language", "error_density", "main_error_type")
NUMBERS = ("tatar_prob", "russian_share", "error_share", "non_fluent_prob", "meaning_clarity", "noise_score", "overall_gec_usefulness")
ENUMS = {
    "main_language": ("tatar", "russian", "mixed", "other"),
    "error_density": ("low", "medium", "high"),
    "main_error_type": ("none_or_minor", "spelling", "grammar_morphology", "punctuation", "word_order", "lexical_choice"),
}
FIELDS = ("main_language", "tatar_prob", "russian_share", "error_share", "error_density", "main_error_type", "non_fluent_prob", "meaning_clarity", "noise_score", "overall_gec_usefulness")


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _read(variant: Column, at: str) -> Column:
    """The payload at a path of a variant as a struct, null unless every field is there and of its kind."""
    values, good = [], []
    for field in FIELDS:
        path = f"{at}.{field}"
        if field in WORDS:
            value = F.try_variant_get(variant, path, "string")
            kind = F.schema_of_variant(F.try_variant_get(variant, path, "variant"))
            good.append(value.isNotNull() & (kind == "STRING"))
        else:
            value = F.try_variant_get(variant, path, "double")
            good.append(value.isNotNull())
        values.append(value.alias(field))
    every = good[0]
    for g in good[1:]:
        every = every & g
    return F.when(F.coalesce(every, F.lit(False)), F.struct(*values))


def flat_labels(payload: Column | str) -> Column:
    """The payload as a struct if it is a flat object with every field; else null."""
    return let(F.try_parse_json(_column(payload)), lambda v: _read(v, "$"))


def any_labels(payload: Column | str) -> Column:
    """The payload as a struct, whether flat or wrapped in ``{"labels": ...}``; else null."""
    return let(F.try_parse_json(_column(payload)), lambda v: F.coalesce(_read(v, "$"), _read(v, "$.labels")))


def valid_enums(labels: Column | str) -> Column:
    """Whether the words of a struct of labels are all among the known values, in lower case; null for null."""
    labels = _column(labels)
    out = F.lit(True)
    for field, values in ENUMS.items():
        out = out & F.lower(labels[field]).isin(*values)
    return F.when(labels.isNotNull(), out)


def payload_json(labels: Column | str) -> Column:
    """The text stored for a struct of labels: the object alone, without an id."""
    return F.to_json(_column(labels))


def scored_items(response: Column | str) -> Column:
    """The scored items (id, labels) of a response that is a JSON array; null if it isn't one or an item lacks its id or a label."""
    array = F.try_variant_get(F.try_parse_json(_column(response)), "$", "array<variant>")
    items = F.transform(array, lambda v: F.struct(F.try_variant_get(v, "$.id", "string").alias("id"), _read(v, "$.labels").alias("labels")))
    return F.when(F.forall(items, lambda i: i["id"].isNotNull() & i["labels"].isNotNull()), items)


def response_json(response: Column | str) -> Column:
    """The JSON in a chatty response: without code fences; else from the first bracket to the last, else from the first brace to the last."""
    text = F.regexp_replace(_column(response), r"(?s)\A\s*```(?:json)?\s*|\s*```\s*\z", "")
    array, thing = F.regexp_extract(text, r"(?s)\[.*\]", 0), F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return F.when(F.try_parse_json(text).isNotNull(), text).when(F.try_parse_json(F.nullif(array, F.lit(""))).isNotNull(), array).otherwise(F.nullif(thing, F.lit("")))


def tolerant_items(response: Column | str) -> Column:
    """The items of a chatty response; null unless all of them are whole and their words are known values."""
    items = scored_items(response_json(response))
    return F.when(F.forall(items, lambda i: valid_enums(i["labels"])), items)


# ---- in tasks, where a response is read before it is stored ------------------------


def checked_labels(labels, enums: bool = True) -> dict:
    """A labels object with its fields alone, numbers as floats and words in lower case; a ValueError names what is wrong."""
    if not isinstance(labels, dict):
        raise ValueError("labels isn't an object")
    out = {}
    for field in FIELDS:
        value = labels.get(field)
        if field in WORDS:
            if not isinstance(value, str) or (enums and value.lower() not in ENUMS[field]):
                raise ValueError(f"{field} isn't a known word: {value!r}")
            out[field] = value.lower() if enums else value
        else:
            try:
                out[field] = float(value)
            except (TypeError, ValueError):
                raise ValueError(f"{field} isn't a number: {value!r}") from None
    return out


def _parsed(text: str, tolerant: bool):
    """What a response says, if need be without code fences, or between its outermost brackets or braces."""
    bare = text.strip()
    if tolerant and bare.startswith("```"):
        bare = bare.strip("`").strip().removeprefix("json").strip()
    spans = [(0, len(bare))] + [(bare.find(a), bare.rfind(b) + 1) for a, b in ("[]", "{}") if tolerant]
    for lo, hi in spans:
        if 0 <= lo < hi:
            try:
                return json.loads(bare[lo:hi])
            except ValueError:
                continue
    raise ValueError("the response has no JSON")


def read_response(text: str, tolerant: bool = True) -> dict[str, dict]:
    """The labels by id of a response, an array of objects with id and labels; a ValueError if any item isn't whole.

    ``tolerant`` takes chatty responses and checks the words; otherwise the response must be JSON alone, and any word goes.
    """
    items = _parsed(text, tolerant)
    if not isinstance(items, list) or not all(isinstance(i, dict) and "id" in i and "labels" in i for i in items):
        raise ValueError("the response isn't an array of items with id and labels")
    return {str(i["id"]): checked_labels(i["labels"], tolerant) for i in items}
