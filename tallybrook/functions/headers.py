"""Fuzzy matching of column headers to standard fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybrook.functions.text import header, let
from tallybrook.schema import SYNONYMS

#: Stamps are times: a header that only names a stamp would otherwise lose its column.
ALIASES = {"交易时间戳": "交易时间"}


#: All synonyms in matching order, as one literal: word and field.
WORDS = "array({})".format(", ".join(f"struct('{w}' AS word, '{ALIASES.get(f, f)}' AS field)" for f, words in SYNONYMS for w in words))


def match_field(text: Column, overrides: dict[str, str] | None = None) -> Column:
    """The standard field of a header, else null: an override, else the first field with an equal synonym, else the
    first one with a synonym that contains the header or stands in it."""
    return let(header(text), lambda h: _field_of(h, overrides or {}))


def _field_of(h: Column, overrides: dict[str, str]) -> Column:
    words = F.expr(WORDS)
    first = lambda test: F.get(F.filter(words, test), F.lit(0))["field"]
    found = F.coalesce(first(lambda s: s["word"] == h), first(lambda s: h.contains(s["word"]) | s["word"].contains(h)))
    for name, field in reversed(overrides.items()):
        found = F.when(h == name, field).otherwise(found)
    return F.when((h != "") & (F.lower(h) != "nan"), found)
