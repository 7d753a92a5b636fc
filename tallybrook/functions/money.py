"""Directions, amount layouts and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IN, OUT, UNKNOWN, ANY = "收入", "支出", "未知", "通用"


def net(income: Column, expense: Column) -> Column:
    return F.coalesce(income, F.lit(0.0)) - F.coalesce(expense, F.lit(0.0))


def split_amounts(income: Column, expense: Column) -> Column:
    """struct(income, expense, amount) from two columns: the net decides the direction, so a reversal changes sides; a
    net of zero is an income of zero."""
    x = F.when(income.isNotNull() | expense.isNotNull(), net(income, expense))
    return F.struct(F.when(x >= 0, x).alias("income"), F.when(x < 0, -x).alias("expense"), x.alias("amount"))


def signed_amounts(amount: Column) -> Column:
    """struct(income, expense, amount) from one signed column."""
    return F.struct(F.when(amount >= 0, amount).alias("income"), F.when(amount < 0, -amount).alias("expense"), amount.alias("amount"))


def direction_amounts(direction: Column, amount: Column) -> Column:
    """struct(income, expense, amount) from an amount and a direction word; an unclear word leaves it to the sign."""
    has = lambda *words: F.lit(False) if not words else _any(F.coalesce(direction, F.lit("")), words)
    credit, debit = has("收", "贷"), has("支", "出", "借")
    size = F.abs(amount)
    income = F.when(credit & ~debit, size).when(debit & ~credit, None).when(amount >= 0, amount)
    expense = F.when(debit & ~credit, size).when(credit & ~debit, None).when(amount < 0, size)
    return F.struct(income.alias("income"), expense.alias("expense"), amount.alias("amount"))


def _any(text: Column, words: tuple[str, ...]) -> Column:
    out = text.contains(words[0])
    for w in words[1:]:
        out = out | text.contains(w)
    return out


def direction_of(income: Column, expense: Column) -> Column:
    """收入, 支出 or 未知. A row with zero on its only side is 未知; with two amounts the larger decides, income on a tie."""
    return (
        F.when((income > 0) & (expense.isNull() | (expense == 0)), IN)
        .when((expense > 0) & (income.isNull() | (income == 0)), OUT)
        .when(income.isNotNull() & expense.isNotNull(), F.when(income >= expense, IN).otherwise(OUT))
        .otherwise(UNKNOWN)
    )


def quality_score(breaks: Column, duplicates: Column, issues: Column) -> Column:
    """100 less a point per five breaks (30 at most), one per duplicate group (20 at most) and ten per issue; 0 at least."""
    return F.greatest(F.lit(0), 100 - F.least(F.lit(30), F.floor(breaks / 5)) - F.least(F.lit(20), duplicates) - 10 * issues).cast("int")


def batch_score(shared: Column, duplicates: Column) -> Column:
    """100 less twenty per shared account, and five if any record was handed in twice; 0 at least."""
    return F.greatest(F.lit(0), 100 - 20 * shared - F.when(duplicates > 0, 5).otherwise(0)).cast("int")


def priority(text: Column) -> Column:
    """1000 for the highest, 1000 - 10 n for a number, else 500."""
    t = F.trim(F.coalesce(text, F.lit("")))
    return F.when(t.contains("最高"), 1000.0).otherwise(F.coalesce(1000 - 10 * F.when(t.rlike(r"^[+-]?\d+(\.\d*)?$"), t.try_cast("double")).cast("int"), F.lit(500))).cast("double")
