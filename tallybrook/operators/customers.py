"""Several customers side by side: links between them are flagged, never merged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.money import batch_score


def inter_customer_txns(ledger: DataFrame, order: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """Rows whose counterparty is another customer's own name or account, with the first such customer in the given
    order(customer_id, ord), by default by id. Names and accounts are joined separately."""
    ranks = order if order is not None else ledger.select("customer_id").distinct().withColumn("ord", F.col("customer_id"))
    own = lambda c: ledger.where(F.coalesce(c, F.lit("")) != "").select(F.col(c).alias("_key"), F.col("customer_id").alias("_other")).distinct()
    rows = ledger.select("seq", "txn_id", "customer_id", "txn_time", "opp_name", "opp_account", F.coalesce("income", "expense").alias("size"))
    hits = [rows.join(own(o), rows[c] == F.col("_key")).where("_other != customer_id").drop("_key") for c, o in (("opp_name", "own_name"), ("opp_account", "own_account"))]
    both = hits[0].unionByName(hits[1]).join(ranks.withColumnRenamed("customer_id", "_other"), "_other")
    first = both.groupBy("seq", "txn_id", "customer_id", "txn_time", "opp_name", "size").agg(F.min_by("_other", F.struct("ord", "_other")).alias("other_customer_id"))
    return first if limit is None else first.orderBy("seq").limit(limit)


def common_counterparties(ledger: DataFrame, top: int | None = 30) -> DataFrame:
    """Counterparties of several customers; three or more ask for a review."""
    rows = ledger.where(F.coalesce("opp_name", F.lit("")) != "").groupBy("opp_name").agg(
        F.count_distinct("customer_id").alias("customers"), F.array_join(F.sort_array(F.collect_set("customer_id")), ",").alias("customer_ids"), F.count("*").alias("rows"),
        F.bround(F.sum(F.coalesce("income", F.lit(0.0))), 2).alias("income"), F.bround(F.sum(F.coalesce("expense", F.lit(0.0))), 2).alias("expense"),
    )
    found = rows.where("customers > 1").withColumn("remark", F.when(F.col("customers") >= 3, "需要复核").otherwise("常见交易对手"))
    return found if top is None else found.orderBy(F.desc("rows"), "opp_name").limit(top)


def customer_overview(ledger: DataFrame, checks: DataFrame) -> DataFrame:
    """A row per customer: rows, accounts, and its accounts' balance checks."""
    passed = checks.groupBy("customer_id").agg(F.count("*").alias("checked"), F.count_if(F.col("status") == "通过").alias("passed"), F.count_if(F.col("status") == "预警").alias("warned"), F.sum("breaks").alias("breaks"))
    meta = ledger.groupBy("customer_id").agg(F.count("*").alias("rows"), F.count_distinct("own_account").alias("accounts"))
    return meta.join(passed, "customer_id", "left")


def batch_overview(ledger: DataFrame, checks: DataFrame, shared: DataFrame, duplicates: DataFrame) -> DataFrame:
    """One row over all customers, with the score; shared accounts block the batch."""
    one = ledger.agg(F.count_distinct("customer_id").alias("customers"), F.count_distinct("own_account").alias("accounts"), F.count("*").alias("rows"))
    totals = checks.agg(F.count_if(F.col("status") == "通过").alias("passed"), F.count_if(F.col("status") == "预警").alias("warned"), F.sum("breaks").alias("breaks"))
    counts = shared.agg(F.count("*").alias("shared_accounts")).crossJoin(duplicates.agg(F.count("*").alias("duplicate_groups")))  # single rows, as above
    out = one.crossJoin(totals).crossJoin(counts)
    return out.withColumn("score", batch_score(F.col("shared_accounts"), F.col("duplicate_groups"))).withColumn("blocked", F.col("shared_accounts") > 0)
