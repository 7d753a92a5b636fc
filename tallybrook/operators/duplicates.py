"""Suspected duplicates, records handed in by several customers, and shared accounts. Nothing is removed or merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.tables import beside, numbered, write_table

# What is advised about a group.
KEEP, REVIEW = "保留一笔", "人工复核"
DUPLICATE_KEYS = ["own_account", "txn_time", "income", "expense", "balance", "opp_name"]
FINGERPRINT = ["txn_time", "income", "expense", "balance", "opp_name"]


def named(groups: DataFrame, order: list[Column], pattern: str) -> DataFrame:
    """group_id by rank of the order."""
    return numbered(groups, order, "_rank").withColumn("group_id", F.format_string(pattern, "_rank")).drop("_rank")


def joined_ids(column: str = "txn_id") -> Column:
    return F.array_join(F.array_sort(F.collect_list(column)), ",")


def duplicate_groups(ledger: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Groups of two or more rows that agree in account, time, amounts, balance and counterparty. Confidence 0.9 where
    they come from several files and have a balance, else 0.5."""
    keys = keys or DUPLICATE_KEYS
    groups = ledger.groupBy(*keys).agg(F.count("*").alias("size"), F.count_distinct("source_file").alias("files"), joined_ids().alias("txn_ids"), F.array_join(F.sort_array(F.collect_set("source_file")), ",").alias("source_files"))
    sure = (F.col("files") > 1) & F.col("balance").isNotNull()
    found = groups.where("size >= 2").select(*keys, "size", "files", "txn_ids", "source_files", F.when(sure, 0.9).otherwise(0.5).alias("confidence"), F.when(sure, KEEP).otherwise(REVIEW).alias("action"))
    return named(found, [F.asc_nulls_first(k) for k in keys], "DUP-%04d")


def duplicate_members(ledger: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The groups of duplicate_groups as a row for each of their rows, in place of lists of ids, which a group of any size
    allows: group_id, size, files, nth (in load order), with the row's seq, txn_id and source_file. A group of a third of
    all rows is numbered by ranges of the order."""
    keys = keys or DUPLICATE_KEYS
    groups = ledger.groupBy(*keys).agg(F.count("*").alias("size"), F.count_distinct("source_file").alias("files")).where("size >= 2")
    groups = write_table(named(groups, [F.asc_nulls_first(k) for k in keys], "DUP-%04d").select(*(F.col(k).alias(f"_{k}") for k in keys), "size", "files", "group_id"), "groups")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    rows = ledger.join(beside(groups), same).select("group_id", "size", "files", "seq", "txn_id", "source_file")
    ranked = write_table(numbered(rows, [F.col("group_id"), F.col("seq"), F.col("txn_id")], "_rank"), "members")
    first = ranked.groupBy("group_id").agg(F.min("_rank").alias("_first"))
    return ranked.join(beside(write_table(first, "first")), "group_id").withColumn("nth", F.col("_rank") - F.col("_first") + 1).drop("_rank", "_first")


def cross_customer_fingerprints(ledger: DataFrame, limit: int | None = None) -> DataFrame:
    """Groups of rows of several customers that agree in time, amounts, balance and counterparty."""
    groups = ledger.where(F.col("txn_time").isNotNull()).groupBy(*FINGERPRINT).agg(F.count("*").alias("size"), F.count_distinct("customer_id").alias("customers"), F.array_join(F.sort_array(F.collect_set("customer_id")), ",").alias("customer_ids"), joined_ids().alias("txn_ids"))
    found = named(groups.where("customers > 1").withColumn("confidence", F.lit(0.6)), [F.asc_nulls_first(k) for k in FINGERPRINT], "XDUP-%04d")
    return found if limit is None else found.orderBy("group_id").limit(limit)


def shared_accounts(ledger: DataFrame, examples: int = 10) -> DataFrame:
    """Accounts of several customers, with their first rows in load order."""
    rows = ledger.where(F.coalesce("own_account", F.lit("")) != "")
    shared = rows.groupBy("own_account").agg(F.count_distinct("customer_id").alias("customers"), F.array_join(F.sort_array(F.collect_set("customer_id")), ",").alias("customer_ids"), F.count("*").alias("rows")).where("customers > 1")
    # smallest load orders per account and part first, so that no task ranks a whole account
    part = rows.join(shared.select("own_account"), "own_account", "left_semi").select("own_account", "seq", "txn_id").withColumn("part", F.pmod(F.xxhash64("seq"), F.lit(64)))
    few = lambda df, *by: df.withColumn("n", F.row_number().over(Window.partitionBy(*by).orderBy("seq", "txn_id"))).where(F.col("n") <= examples)
    first = few(few(part, "own_account", "part").drop("n"), "own_account")
    ids = first.groupBy("own_account").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "txn_id"))), lambda x: x["txn_id"]), ",").alias("example_ids"))
    return shared.join(ids, "own_account").select("own_account", "customers", "customer_ids", "rows", "example_ids", F.lit("高").alias("severity"))
