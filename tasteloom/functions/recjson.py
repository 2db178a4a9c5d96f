"""Recommendation lists as JSON text, and the plain form served to clients."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def encode_recommendations(recommendations: Column) -> Column:
    """``[{"ProductId": .., "score": ..}, ..]``; an empty list gives ``[]``."""
    return F.to_json(recommendations)


def served_items(text: Column) -> Column:
    """Names shown for a stored list; text that is not a JSON list gives an empty list.

    Of an object the ``item_index`` is shown, else the ``ProductId``, else all of it. A key that is
    present with a JSON null wins over those after it and reads ``None``, as does a null element.
    """
    parsed_list = F.when(_is_one_value(text), F.from_json(text, "array<string>"))
    elements = F.coalesce(parsed_list, F.array().cast("array<string>"))
    # Each element is parsed once here and looked at several times below.
    parsed = F.transform(elements, lambda e: F.struct(
        e.alias("text"), F.from_json(e, "map<string,string>").alias("fields")))
    return F.transform(parsed, lambda p: _shown(p["text"], p["fields"]))


def _is_one_value(text: Column) -> Column:
    """Whether the whole text is one JSON value: the parser alone stops at the end of the first.

    As the only element of a list, and as the only field of an object, no rest of a text can hide.
    """
    in_list = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")
    in_object = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), "map<string,string>")
    return (F.size(in_list) == 1) & (F.size(in_object) == 1)


def _shown(text: Column, fields: Column) -> Column:
    def has(name: str) -> Column:
        return fields.isNotNull() & F.map_contains_key(fields, name)

    def value(name: str) -> Column:
        return F.coalesce(fields[name], F.lit("None"))

    return (
        F.when(text.isNull(), F.lit("None"))
        .when(has("item_index"), value("item_index"))
        .when(has("ProductId"), value("ProductId"))
        .otherwise(text)
    )
