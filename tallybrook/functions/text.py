"""Texts of statements: headers, amounts, times, identifiers. All JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.schema import NO_AMOUNT, NO_TIME

#: White space of Unicode.
SPACES = "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
WIDE, NARROW = "０１２３４５６７８９．－＋", "0123456789.-+"


def let(value: Column, body) -> Column:
    """body of a value that is computed once: an expression that uses a long one several times would repeat it."""
    return F.get(F.transform(F.array(value), body), 0)


def header(text: Column) -> Column:
    """A header without white space, with narrow parentheses; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), "（）" + SPACES, "()")


def trimmed(text: Column) -> Column:
    return F.trim(text, F.lit(SPACES))


def parse_amount(text: Column) -> Column:
    """A number with thousands separators, currency signs and wide digits; null where it isn't one.

    Only plain decimal notation counts: neither the letters that Java allows behind a number nor digit groups by
    underscores.
    """
    return let(trimmed(text), lambda t: let(bare_amount(t), lambda b: amount_of(t, b)))


def bare_amount(t: Column) -> Column:
    """Trimmed text without separators and currency signs, in narrow digits."""
    return F.translate(t, WIDE + ",， ¥￥元", NARROW)


def amount_of(t: Column, bare: Column) -> Column:
    """The number of a trimmed text and its bare form."""
    return F.when(~t.isin(*NO_AMOUNT) & bare.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), bare.try_cast("double"))


def _without_junk(text: Column) -> Column:
    t = trimmed(F.coalesce(text, F.lit("")))
    return F.when(t.isin(*NO_TIME), "").otherwise(t)


def joined_time(date: Column, time: Column) -> Column:
    """Both texts joined by a space, junk left out."""
    return trimmed(F.concat_ws(" ", _without_junk(date), _without_junk(time)))


DATE = r"(\d{4})[-/]?(\d{1,2})[-/]?(\d{1,2})"
CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2}))?"


def parse_datetime(date: Column, time: Column) -> Column:
    """TIMESTAMP_NTZ of the first date and the first time in the two texts, else null.

    A time is h:mm or h:mm:ss anywhere, else six digits behind the date or in the time text, else four digits that
    stand alone behind the date. A time of day that doesn't exist counts as midnight; years outside 1990 to 2100 and
    days that don't exist give null.
    """
    texts = F.struct(joined_time(date, time).alias("raw"), _without_junk(time).alias("alone"))
    return let(texts, lambda x: let(_clock_digits(x["raw"], x["alone"]), lambda d: _stamp(x["raw"], d)))


def with_datetime(df: DataFrame, date: Column, time: Column, name: str, raw_name: str) -> DataFrame:
    """df with parse_datetime() of the two texts, and the joined text (null if empty), step by step: each step's value is a
    column, computed once in generated code."""
    steps = df.withColumns({"__raw": joined_time(date, time), "__alone": _without_junk(time)})
    steps = steps.withColumn("__digits", _clock_digits(F.col("__raw"), F.col("__alone")))
    return steps.withColumns({name: _stamp(F.col("__raw"), F.col("__digits")), raw_name: F.nullif("__raw", F.lit(""))}).drop("__raw", "__alone", "__digits")


def _part(text: Column, pattern: str, k: int) -> Column:
    return F.regexp_extract(text, pattern, k)


def _clock_digits(raw: Column, alone: Column) -> Column:
    """Six digits of the time of day, which may not exist."""
    filled = lambda text: F.nullif(text, F.lit(""))
    two = lambda k: F.lpad(_part(raw, CLOCK, k), 2, "0")
    tail = _part(raw, rf"(?s){DATE}(.*)", 4)
    six = F.coalesce(filled(_part(tail, r"(\d{6})", 1)), filled(_part(alone, r"(\d{6})", 1)))
    four = filled(_part(tail, r"(?<![\w一-鿿])(\d{4})(?![\w一-鿿])", 1))
    return F.when(raw.rlike(CLOCK), F.concat(two(1), two(2), two(3))).otherwise(F.coalesce(six, F.concat(four, F.lit("00")), F.lit("000000")))


def _stamp(raw: Column, digits: Column) -> Column:
    sound = digits.rlike(r"^([01]\d|2[0-3])([0-5]\d){2}$")
    clock = F.when(sound, digits).otherwise("000000")
    shown = F.concat_ws(":", *(F.substring(clock, k, 2) for k in (1, 3, 5)))
    day = F.concat_ws("-", _part(raw, DATE, 1), F.lpad(_part(raw, DATE, 2), 2, "0"), F.lpad(_part(raw, DATE, 3), 2, "0"))
    known = _part(raw, DATE, 1).try_cast("int").between(1990, 2100)
    return F.when(known, F.concat_ws(" ", day, shown).try_cast("timestamp_ntz"))


def unique_id(*parts: Column) -> Column:
    """`TX-` and twelve hex digits of the MD5 of the parts joined by `|`, nulls as empty."""
    return F.concat(F.lit("TX-"), F.substring(F.md5(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))), 1, 12))


def money_text(amount: Column) -> Column:
    """An amount as text that doesn't depend on the engine: two decimals."""
    return F.format_string("%.2f", amount)
