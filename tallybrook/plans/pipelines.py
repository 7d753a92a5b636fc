"""Jobs that compose the operators. Each returns DataFrames by name; nothing is repaired, removed or merged."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.functions.money import quality_score
from tallybrook.operators import checks, customers, duplicates, portfolio, reports, rules, tagging, transfers
from tallybrook.operators.standardize import standardize
from tallybrook.plans import sinks
from tallybrook.plans.workbook_sink import write_workbooks
from tallybrook.schema import CANONICAL, DELIVERABLE, TAGS, published
from tallybrook.sources import ledgers
from tallybrook.sources.grids import scan_files
from tallybrook.tables import write_table

COVERED = ["txn_time", "own_name", "own_account", "opp_name", "opp_account", "income", "expense", "balance", "memo", "note"]


def standardize_files(spark: SparkSession, *paths: str, extractors: dict[str, Callable] | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """Raw statement files and folders to a ledger and a report row per file, also of files that have no header or that
    nothing reads. options: overrides (header to field), header_row, customer, account_type."""
    grids, outcomes = scan_files(spark, *paths, extractors=extractors)
    return standardize(grids, outcomes=outcomes, **options)


def integrate(ledger: DataFrame, self_accounts: list[str] | None = None) -> dict[str, DataFrame]:
    """One customer's files side by side: the ordered ledger and what was found in it."""
    check = checks.balance_check(ledger, ["own_account"])
    groups = duplicates.duplicate_groups(ledger)
    conflicts = checks.direction_conflicts(ledger)
    missing = checks.missing_rate(ledger)
    issues = missing.select(F.col("flagged").cast("int").alias("a")).crossJoin(conflicts.agg((F.count("*") > 0).cast("int").alias("b")))  # single rows
    quality = reports.quality(check, groups).crossJoin(issues).select("breaks", "duplicate_groups", quality_score(F.col("breaks"), F.col("duplicate_groups"), F.col("a") + F.col("b")).alias("score"))
    pairs = transfers.self_transfers(ledger, self_accounts)
    return {
        "ledger": ledgers.integrated(ledger), "overview": portfolio.overview(ledger), "accounts": portfolio.account_index(ledger), "balance_check": check, "duplicates": groups,
        "transfers": pairs, "reasons": reports.reasons(check, groups, pairs, missing, conflicts), "direction_conflicts": conflicts, "missing_counterparties": missing, "quality": quality, "review": reports.review_items(checks=check, duplicates=groups),
    }


def portfolio_report(ledger: DataFrame) -> dict[str, DataFrame]:
    daily = portfolio.daily_balance(ledger)
    check = checks.balance_check(ledger.withColumn("acct", portfolio.account_key(ledger)), ["acct"], by_file=False, drop_null_time=True)
    out = {"daily": daily, "total": portfolio.total_by_day(ledger), "balance_check": check, "summary": portfolio.summary(ledger), "continuity": portfolio.continuity(ledger)}
    if "customer_id" in ledger.columns:
        out["by_customer"] = portfolio.summary(ledger, ["customer_id"])
    return out


def tag_report(ledger: DataFrame, rule_table: DataFrame) -> dict[str, DataFrame]:
    """rule_table: as compiled or read, of texts."""
    tagged = tagging.tag(ledger, rules.typed_rules(rule_table))
    return {"ledger": tagged, "distribution": tagging.tag_distribution(tagged), "label_counts": tagging.label_counts(tagged), "hit_rate": tagging.hit_rate(tagged), "suggestions": tagging.suggestions(tagged)}


def several_customers(specs: list[tuple]) -> dict[str, DataFrame]:
    """specs: (name, ledger[, id]), in the order that decides between customers."""
    ledger, order = ledgers.customers(specs)
    ranks = ledger.sparkSession.createDataFrame(order, "customer_id string, ord int")
    check = checks.balance_check(ledger, ["customer_id", "own_account"], by_file=False, examples=5)
    shared, again = duplicates.shared_accounts(ledger), duplicates.cross_customer_fingerprints(ledger)
    return {
        "ledger": ledger, "customers": customers.customer_overview(ledger, check), "batch": customers.batch_overview(ledger, check, shared, again), "balance_check": check, "shared_accounts": shared,
        "resubmitted": again, "inter_customer": customers.inter_customer_txns(ledger, ranks, limit=200), "common_counterparties": customers.common_counterparties(ledger),
        "coverage": checks.coverage(ledger, COVERED), "review": reports.review_items(checks=check, shared=shared, resubmitted=again),
    }


class Sheets(Mapping):
    """DataFrames by name. Each is made when it is first asked for, and kept: steps that write tables (numbered lists,
    virtual balances) run for the sheets that are read, not for all."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        self._makers, self._made = makers, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def deliverable(client: str, subjects: list[tuple[str, DataFrame]], rule_table: DataFrame) -> Mapping[str, DataFrame]:
    """The sheets of a client's workbook, under published column names. subjects: (name, ledger)."""
    parts = [ledger.withColumn("subject_name", F.coalesce(F.nullif(F.trim("own_name"), F.lit("")), F.lit(name or client))) for name, ledger in subjects]
    ledger = ledgers.one_after_another(parts)
    columns = ["customer_name", "subject_name", "bank", *(n for n, *_ in CANONICAL), "virtual_balance", *(n for n, _ in TAGS)]
    assert {n for n, _ in DELIVERABLE} <= set(columns)
    typed = cache(lambda: rules.typed_rules(rule_table))
    check = lambda: checks.balance_check(ledger, ["own_account"])

    def main() -> DataFrame:
        # tagged last, so that ranges of balances are dealt out without the labels
        tagged = tagging.tag(portfolio.virtual_balance(ledger, written=True), typed())
        return published(ledgers.integrated(tagged.withColumn("bank", F.lit("")).withColumn("customer_name", F.lit(client))).select(*columns))

    return Sheets({
        "封面与说明": lambda: portfolio.overview(ledger), "整合打标流水": main, "组合日余额": lambda: portfolio.daily_with_total(portfolio.daily_balance(ledger)), "主体账户清单": lambda: portfolio.account_index(ledger),
        "余额校验": check, "标签汇总": lambda: published(tagging.tag_summary(tagging.tag(ledger, typed()))),
        "人工复核事项": lambda: reports.review_items(checks=check(), duplicates=duplicates.duplicate_groups(ledger), tagged=tagging.tag(ledger, typed())),
    })


def subject_spec(spec: str) -> tuple[str, str, str | None]:
    """Name, path and account type (or none) of `name:path[:type]`. A path may have a scheme and a port: what follows the
    last colon is a type only if it holds no separator of paths."""
    name, _, rest = spec.partition(":")
    path, _, kind = rest.rpartition(":")
    if not name or not rest:
        raise ValueError(f"{spec!r} isn't name:path[:type]")
    return (name, path, kind or None) if path and "/" not in kind else (name, rest, None)


def deliverable_of_files(spark: SparkSession, client: str, specs: list[str], rule_table: DataFrame, **options) -> tuple[Mapping[str, DataFrame], DataFrame]:
    """The sheets of a client from raw files, and a report row per file. specs: subjects as `name:path[:type]`, whose name
    is the own name of their rows; or one path without a name, where names come from the files."""
    parts, reports_of = [], []
    for spec in specs:
        name, path, kind = subject_spec(spec) if len(specs) > 1 or ":" in spec and not spec.startswith("/") else (None, spec, None)
        ledger, files = standardize_files(spark, path, customer=name, account_type=kind, **options)
        parts.append((name or client, write_table(ledger, "ledger")))
        reports_of.append(files.withColumn("subject", F.lit(name or client)))
    return deliverable(client, parts, rule_table), ledgers.union_all(reports_of)


def write_deliverable(client: str, sheets: Mapping[str, DataFrame], out_dir: str) -> list[str]:
    """The sheets as workbooks in the client's folder below out_dir, which is wiped first; the paths of the workbooks."""
    spark = next(iter(sheets.values())).sparkSession
    folder = f"{out_dir.rstrip('/')}/{sinks.safe_name(client)}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return write_workbooks(sheets, folder)


def one_customer(spark: SparkSession, customer: str, folder: str, rule_table: DataFrame, self_accounts: list[str] | None = None, **options) -> dict[str, dict[str, DataFrame]]:
    """Raw folder to all reports of one customer."""
    ledger, files = standardize_files(spark, folder, customer=customer, **options)
    ledger = write_table(ledger, "ledger")
    return {"files": {"report": files}, "integrated": integrate(ledger, self_accounts), "portfolio": portfolio_report(ledger), "tags": tag_report(ledger, rule_table)}
