"""Balance continuity and quality checks. An account's timeline is cut into days, so that one account with very many
rows is spread over its days; only each day's last row is carried over to the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.schema import TOLERANCE

LAST_TEXT, LAST_ROW, LAST_DAY = "\U0010ffff", 2**63 - 1, "9999-12-31"


def event_order(by_file: bool) -> list[Column]:
    """The order of an account's rows: time, file (if asked), row; missing ones last."""
    file = [F.coalesce("source_file", F.lit(LAST_TEXT))] if by_file else []
    return [F.coalesce("txn_time", F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")), *file, F.coalesce("source_row", F.lit(LAST_ROW)), F.coalesce("seq", F.lit(LAST_ROW))]


def balance_steps(ledger: DataFrame, keys: list[str], by_file: bool = True, drop_null_time: bool = False) -> DataFrame:
    """The ledger with diff (how far the balance is from the one before plus the net amount) and is_break. A missing
    balance on either side is no break. Keys: missing ones are one group, the empty text."""
    rows = ledger.where(F.col("txn_time").isNotNull()) if drop_null_time else ledger
    rows = rows.withColumns({k: F.coalesce(k, F.lit("")) for k in keys}).withColumn("_day", F.coalesce(F.to_date("txn_time"), F.lit(LAST_DAY).cast("date")))
    order = event_order(by_file)
    within = Window.partitionBy(*keys, "_day").orderBy(*order)
    last = rows.groupBy(*keys, "_day").agg(F.max_by(F.struct("balance"), F.struct(*order)).alias("last"))
    carried = last.select(*keys, "_day", F.lag("last").over(Window.partitionBy(*keys).orderBy("_day")).alias("_carried"))
    rows = rows.withColumn("_first", F.row_number().over(within) == 1).withColumn("_before", F.lag("balance").over(within)).join(carried, [*keys, "_day"])
    before = F.when(F.col("_first"), F.col("_carried.balance")).otherwise(F.col("_before"))
    diff = F.abs(F.col("balance") - (before + F.coalesce("income", F.lit(0.0)) - F.coalesce("expense", F.lit(0.0))))
    return rows.withColumn("diff", diff).withColumn("is_break", F.coalesce(diff >= TOLERANCE, F.lit(False))).drop("_day", "_first", "_before", "_carried")


def balance_check(ledger: DataFrame, keys: list[str], by_file: bool = True, drop_null_time: bool = False, examples: int = 8) -> DataFrame:
    """keys, rows, balances, breaks, status, example_ids (the first breaks), closing_balance."""
    steps = balance_steps(ledger, keys, by_file, drop_null_time)
    order = F.struct(*event_order(by_file))
    summary = steps.groupBy(*keys).agg(F.count("*").alias("rows"), F.count("balance").alias("balances"), F.count_if("is_break").alias("breaks"), F.max_by(F.when(F.col("balance").isNotNull(), F.col("balance")), F.when(F.col("balance").isNotNull(), order)).alias("closing_balance"))
    # the first breaks of each account: a rank that keeps few rows before any are gathered
    first = steps.where("is_break").withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*event_order(by_file)))).where(F.col("_n") <= examples)
    ids = first.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", "txn_id"))), lambda x: x["txn_id"]), ",").alias("example_ids"))
    status = F.when(F.col("balances") < 2, "未校验").when(F.col("breaks") == 0, "通过").otherwise("预警")
    return summary.join(ids, keys, "left").select(*keys, "rows", "balances", "breaks", status.alias("status"), F.coalesce("example_ids", F.lit("")).alias("example_ids"), "closing_balance")


def direction_conflicts(ledger: DataFrame) -> DataFrame:
    return ledger.where((F.col("income") > 0) & (F.col("expense") > 0))


def missing_rate(ledger: DataFrame, column: str = "opp_name") -> DataFrame:
    """rows, missing, rate, flagged (over 30 %)."""
    gone = F.count_if(F.trim(F.coalesce(column, F.lit(""))) == "")
    return ledger.agg(F.count("*").alias("rows"), gone.alias("missing")).select("rows", "missing", (F.col("missing") / F.col("rows")).alias("rate"), (F.col("missing") > 0.3 * F.col("rows")).alias("flagged"))


def coverage(ledger: DataFrame, columns: list[str]) -> DataFrame:
    """field, coverage: the share of rows with a value, three decimals; 0 for a column that isn't there."""
    share = lambda c: F.bround(F.avg(F.when(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))).isin("", "nan"), 0.0).otherwise(1.0)), 3) if c in ledger.columns else F.lit(0.0)
    wide = ledger.agg(*(share(c).alias(c) for c in columns))
    return wide.select(F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.coalesce(c, F.lit(0.0)).alias("coverage")) for c in columns))).alias("x")).select("x.*")
