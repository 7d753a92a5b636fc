import pytest
from pyspark.sql import functions as F

from tallybrook.functions import money, text
from tallybrook.functions.headers import match_field


def column(spark, values, expression, schema="x string"):
    rows = spark.createDataFrame([(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[0] for r in sorted(rows.select(expression.alias("y"), "i").collect(), key=lambda r: r["i"])]


def test_amounts(spark):
    values = ["46,800.00", "-1,026", "¥12元", "１２．５", " 7 ", ".5", "1e3", "", "—", "-", "（空）", "nan", "abc", "1d", "1_000", None]
    assert column(spark, values, text.parse_amount(F.col("x"))) == [46800.0, -1026.0, 12.0, 12.5, 7.0, 0.5, 1000.0, *[None] * 9]


def test_datetimes(spark):
    values = {
        ("20250421", "152103"): "2025-04-21 15:21:03", ("2025-06-04 16:06:27.014000", None): "2025-06-04 16:06:27", ("2024/01/19  22:57:48", ""): "2024-01-19 22:57:48",
        ("2025032100:10:53", None): "2025-03-21 00:10:53", ("2026-03-1009:54:35", None): "2026-03-10 09:54:35", ("2025-01-02 25:00:00", None): "2025-01-02 00:00:00",
        ("2025-01-02 0930", None): "2025-01-02 09:30:00", ("1899-01-01", None): None, ("abc", None): None, ("2025-13-45", None): None, (None, None): None, ("nan", "（空）"): None, ("2025-1-2 9:05", None): "2025-01-02 09:05:00",
    }
    got = column(spark, list(values), F.date_format(text.parse_datetime(F.col("a"), F.col("b")), "yyyy-MM-dd HH:mm:ss"), "a string, b string")
    assert got == list(values.values())


def test_headers(spark):
    values = {"对方户名": "对手名称", "金额": "交易金额", "开户名": "本方名称", "记账时间": "交易时间", " 余 额 ": "账户余额", "贷方发生额（收入）": "收入金额", "": None, None: None, "nan": None, "xyz": None}
    assert column(spark, list(values), match_field(F.col("x"))) == list(values.values())
    assert column(spark, ["xyz"], match_field(F.col("x"), {"xyz": "账户余额"})) == ["账户余额"]


@pytest.mark.parametrize(("income", "expense", "want"), [(5.0, None, "收入"), (None, 5.0, "支出"), (5.0, 0.0, "收入"), (0.0, None, "未知"), (None, None, "未知"), (3.0, 4.0, "支出"), (4.0, 4.0, "收入"), (0.0, 0.0, "收入")])
def test_direction(spark, income, expense, want):
    assert column(spark, [(income, expense)], money.direction_of(F.col("a"), F.col("b")), "a double, b double") == [want]


def test_split_amounts_move_reversals(spark):
    got = column(spark, [(-50.0, None), (10.0, 10.0), (None, None), (None, 3.0)], money.split_amounts(F.col("a"), F.col("b")), "a double, b double")
    assert [tuple(r) for r in got] == [(None, 50.0, -50.0), (0.0, None, 0.0), (None, None, None), (None, 3.0, -3.0)]


def test_priorities(spark):
    assert column(spark, ["最高", "3", "7.5", "x", None], money.priority(F.col("x"))) == [1000.0, 970.0, 930.0, 500.0, 500.0]
