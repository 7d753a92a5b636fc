"""Daily balances of many accounts, and the balance of all after each transaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.operators.checks import LAST_ROW
from tallybrook.schema import TOLERANCE
from tallybrook.tables import before_parts, in_ranges, write_table


def account_key(ledger: DataFrame) -> Column:
    """The account, behind its customer where the ledger has several."""
    account = F.coalesce("own_account", F.lit(""))
    return F.concat_ws("|", F.coalesce("customer_id", F.lit("")), account) if "customer_id" in ledger.columns else account


def dated(ledger: DataFrame) -> DataFrame:
    return ledger.where(F.col("txn_time").isNotNull()).withColumn("acct", account_key(ledger)).withColumn("day", F.to_date("txn_time"))


def eod_balance(ledger: DataFrame, by: list[str] | None = None) -> DataFrame:
    """by, acct, day, balance: the last balance of each account and day that isn't missing."""
    order = F.struct("txn_time", F.coalesce("source_row", F.lit(LAST_ROW)), F.coalesce("seq", F.lit(LAST_ROW)))
    return dated(ledger).where(F.col("balance").isNotNull()).groupBy(*(by or []), "acct", "day").agg(F.max_by("balance", order).alias("balance"))


def daily_balance(ledger: DataFrame, by: list[str] | None = None) -> DataFrame:
    """by, acct, day, balance on every day between the first and the last of the ledger (of each `by` group); balances
    are carried forward, and are 0 before the first."""
    by = by or []
    rows = dated(ledger)
    span = rows.groupBy(*by).agg(F.min("day").alias("first"), F.max("day").alias("last"))
    accounts = rows.select(*by, "acct").distinct()
    spanned = accounts.join(span, by) if by else accounts.crossJoin(F.broadcast(span))  # span is a single row
    grid = spanned.select(*by, "acct", F.explode(F.sequence("first", "last")).alias("day"))
    filled = grid.join(eod_balance(ledger, by), [*by, "acct", "day"], "left")
    carried = F.last("balance", True).over(Window.partitionBy(*by, "acct").orderBy("day").rowsBetween(Window.unboundedPreceding, 0))
    return filled.select(*by, "acct", "day", F.coalesce(carried, F.lit(0.0)).alias("balance"))


def daily_total(daily: DataFrame, by: list[str] | None = None) -> DataFrame:
    return daily.groupBy(*(by or []), "day").agg(F.bround(F.sum("balance"), 2).alias("total"))


def total_by_day(ledger: DataFrame, by: list[str] | None = None) -> DataFrame:
    """by, day, total: what daily_total(daily_balance()) gives, from the changes alone. An account has a row for each day on
    which its balance is known; the changes of all accounts are summed by day, and carried forward on the calendar."""
    by = by or []
    known = F.lag("balance", 1, 0.0).over(Window.partitionBy(*by, "acct").orderBy("day"))
    changes = eod_balance(ledger, by).withColumn("change", F.col("balance") - known).groupBy(*by, "day").agg(F.sum("change").alias("change"))
    calendar = dated(ledger).groupBy(*by).agg(F.min("day").alias("first"), F.max("day").alias("last")).where("first is not null").select(*by, F.explode(F.sequence("first", "last")).alias("day"))
    so_far = F.sum(F.coalesce("change", F.lit(0.0))).over(Window.partitionBy(*by).orderBy("day").rowsBetween(Window.unboundedPreceding, 0))  # one row per calendar day
    return calendar.join(changes, [*by, "day"], "left").select(*by, "day", (F.bround(so_far, 2) + 0.0).alias("total"))


def daily_with_total(daily: DataFrame) -> DataFrame:
    """day, acct, balance, total: the panel in long form; a sink may pivot it."""
    return daily.join(daily_total(daily), "day").select("day", "acct", F.bround("balance", 2).alias("balance"), "total")


def daily_wide(daily: DataFrame, accounts: list[str] | None = None) -> DataFrame:
    """A column per account, and the total; for few accounts."""
    wide = daily.groupBy("day").pivot("acct", accounts).agg(F.bround(F.first("balance"), 2)) if accounts else daily.groupBy("day").pivot("acct").agg(F.bround(F.first("balance"), 2))
    return wide.join(daily_total(daily), "day")


def net_flow(ledger: DataFrame, by: list[str] | None = None) -> DataFrame:
    net = F.coalesce("income", F.lit(0.0)) - F.coalesce("expense", F.lit(0.0))
    return dated(ledger).groupBy(*(by or []), "day").agg(F.bround(F.sum(net), 2).alias("net"))


def continuity(ledger: DataFrame) -> DataFrame:
    """day, total, change, net, gap, is_break for each day but the first: the total's change against the day's net flow."""
    total = total_by_day(ledger)
    change = F.col("total") - F.lag("total").over(Window.orderBy("day"))  # one row per calendar day
    days = total.withColumn("change", change).where(F.col("change").isNotNull()).join(net_flow(ledger), "day", "left").withColumn("net", F.coalesce("net", F.lit(0.0)))
    gap = F.bround(F.col("change") - F.col("net"), 2) + 0.0
    return days.select("day", "total", F.bround("change", 2).alias("change"), "net", gap.alias("gap"), (F.abs(gap) >= TOLERANCE).alias("is_break"))


def summary(ledger: DataFrame, by: list[str] | None = None) -> DataFrame:
    """by, accounts, first_day, last_day, days, opening, closing, peak, peak_day, trough, trough_day; each `by` group on
    its own calendar."""
    by = by or []
    accounts = dated(ledger).groupBy(*by).agg(F.count_distinct("acct").alias("accounts"))
    total = total_by_day(ledger, by)
    out = total.groupBy(*by).agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("days"), F.min_by("total", "day").alias("opening"), F.max_by("total", "day").alias("closing"),
        F.max("total").alias("peak"), F.min_by("day", F.struct(-F.col("total"), "day")).alias("peak_day"), F.min("total").alias("trough"), F.min_by("day", F.struct("total", "day")).alias("trough_day"),
    )
    return accounts.join(out, by) if by else accounts.crossJoin(out)  # both are single rows


def virtual_balance(ledger: DataFrame, written: bool = False) -> DataFrame:
    """The ledger with virtual_balance: after each row, the sum over all accounts of the balance last known, in the
    order of time, account, row and load; rows without a time come last. written: it stands in a written table, which may
    be read as often as needed. A ledger without any balance has a sum of 0 after each row, whatever their order, and its
    rows stay where they are.

    Each row changes the sum by its balance less its account's last one. The order is cut into ranges of even size, so a
    day or an account may hold any share of the rows. Between ranges go each account's last balance there, and a sum.
    """
    held = ledger if written else write_table(ledger, "rows")
    if held.where("balance is not null").isEmpty():
        return held.withColumn("virtual_balance", F.lit(0.0))
    keyed = held.withColumn("_acct", account_key(held))
    order = [F.coalesce("txn_time", F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")), F.col("_acct"), F.coalesce("source_row", F.lit(LAST_ROW)), F.coalesce("seq", F.lit(LAST_ROW))]
    rows = in_ranges(keyed, order, written=True)
    back = lambda window: window.rowsBetween(Window.unboundedPreceding, -1)
    # rows without a balance change nothing, so they need nothing carried
    ends = rows.where("balance is not null").groupBy("__part", "_acct").agg(F.max_by("balance", F.struct(*order)).alias("_end"))
    carried = ends.select("__part", "_acct", F.last("_end").over(back(Window.partitionBy("_acct").orderBy("__part"))).alias("_carried"))
    known = F.coalesce(F.last("balance", True).over(back(Window.partitionBy("__part", "_acct").orderBy(*order))), "_carried", F.lit(0.0))
    rows = rows.join(carried, ["__part", "_acct"], "left").withColumn("_delta", F.when(F.col("balance").isNull(), 0.0).otherwise(F.col("balance") - known))
    before = before_parts(rows.groupBy("__part").agg(F.sum("_delta").alias("_sum")), "_sum", "_before")
    running = F.sum("_delta").over(Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    out = rows.withColumn("_running", running).join(F.broadcast(before), "__part")  # a row for each part
    return out.withColumn("virtual_balance", F.bround(F.col("_before") + F.col("_running"), 2)).drop("__part", "_acct", "_carried", "_delta", "_running", "_before")


def account_index(ledger: DataFrame) -> DataFrame:
    """Own accounts: first known owner, files, rows, period, totals."""
    name = F.when(F.coalesce("own_name", F.lit("")) != "", F.col("own_name"))
    return ledger.groupBy(F.coalesce("own_account", F.lit("")).alias("own_account")).agg(
        F.min_by(name, F.when(name.isNotNull(), F.col("seq"))).alias("own_name"), F.array_join(F.sort_array(F.collect_set("source_file")), "；").alias("source_files"), F.count("*").alias("rows"),
        F.to_date(F.min("txn_time")).alias("first_day"), F.to_date(F.max("txn_time")).alias("last_day"),
        F.bround(F.sum(F.coalesce("income", F.lit(0.0))), 2).alias("income"), F.bround(F.sum(F.coalesce("expense", F.lit(0.0))), 2).alias("expense"),
    )


def overview(ledger: DataFrame) -> DataFrame:
    """One row: files, accounts, rows, period, inflow, outflow, net."""
    inflow, outflow = F.bround(F.sum(F.coalesce("income", F.lit(0.0))), 2), F.bround(F.sum(F.coalesce("expense", F.lit(0.0))), 2)
    one = ledger.agg(F.count_distinct("source_file").alias("files"), F.count_distinct("own_account").alias("accounts"), F.count("*").alias("rows"), F.to_date(F.min("txn_time")).alias("first_day"), F.to_date(F.max("txn_time")).alias("last_day"), inflow.alias("inflow"), outflow.alias("outflow"))
    return one.withColumn("net", F.bround(F.col("inflow") - F.col("outflow"), 2))
