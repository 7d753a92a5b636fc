"""Ledgers and rule tables that were written before."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.operators.checks import LAST_ROW
from tallybrook.schema import conform, from_published
from tallybrook.sources import textfiles
from tallybrook.tables import beside, numbered, own_splits, write_table


#: Names of the artifacts of a customer, the furthest processed first.
ARTIFACTS = ("*__打标流水.csv", "*__整合流水.csv", "*__standardized.csv")


def listed(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Paths in a folder that fit a pattern, sorted by name. Only names are listed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{pattern}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f"{folder.rstrip('/')}/{x.getPath().getName()}" for x in found or [])


def standardized_files(spark: SparkSession, *paths: str) -> list[str]:
    """CSV paths as they are, and for folders the standardised ledgers in them; an error if there is none at all."""
    files = [f for p in paths for f in ([p] if p.endswith(".csv") else listed(spark, p, ARTIFACTS[-1]))]
    if not files:
        raise FileNotFoundError(f"no {ARTIFACTS[-1]} in {', '.join(paths)}")
    return files


def best_artifact(spark: SparkSession, path: str) -> str:
    """The path of a CSV as it is; of a folder the first ledger that is tagged, else integrated, else standardised."""
    if path.endswith(".csv"):
        return path
    for pattern in ARTIFACTS:
        if found := listed(spark, path, pattern):
            return found[0]
    raise FileNotFoundError(f"no ledger in {path}")


def read_csv_ledgers(spark: SparkSession, *paths: str) -> DataFrame:
    """Standardised ledgers as CSV with published or own column names; columns that a file lacks are null. seq, the load
    order, goes by file in the order given (by name inside a folder), then by row.

    All files are one scan in splits, whatever their columns: each row looks up its file's header. Line breaks and quotes
    inside fields stay as they are; empty fields are null. A file that can't be read is an error.
    """
    given: dict[str, int] = {}
    for k, path in enumerate(standardized_files(spark, *paths)):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        given.setdefault(p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString(), k)
    rank = lambda f: (given.get(f, given.get(f.rpartition("/")[0])), f)  # noqa: E731  a ledger may be a folder of part files
    files = sorted(textfiles.files_in(spark, *(textfiles.literally(g) for g in given)), key=rank)
    table = textfiles.records(spark, files, record_safe=True)
    with own_splits(spark):
        return _typed(table, files)


def _typed(table: DataFrame, files: list[str]) -> DataFrame:
    """Records of ledgers to rows, the files in their order."""
    spark = table.sparkSession
    if (bad := table.where("error is not null").first()) is not None:
        raise ValueError(f"{bad['file']}: {bad['error']}")
    heads = table.groupBy("file").agg(F.max("record").alias("rows")).join(table.where("record = 0").select("file", F.col("cells").alias("header")), "file", "left")
    placed = heads.join(spark.createDataFrame(list(enumerate(files)), "place long, file string"), "file")
    # a row per file
    before = F.coalesce(F.sum("rows").over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    facts = write_table(placed.select("file", "header", before.alias("before")), "headers")
    names = sorted({n for r in facts.select(F.explode(F.array_distinct("header")).alias("name")).distinct().collect() for n in (r["name"],) if n})
    places = [f"_at{k}" for k in range(len(names))]
    located = facts.select("file", "before", *((F.nullif(F.array_position("header", n), F.lit(0)).cast("int") - 1).alias(at) for n, at in zip(names, places)))
    rows = table.where("record > 0").join(beside(located), "file")
    raw = rows.select((F.col("before") + F.col("record")).alias("_seq"), *(F.nullif(F.get("cells", F.col(at)), F.lit("")).alias(n) for n, at in zip(names, places)))
    raw = from_published(raw)
    typed = {c: F.col(c).try_cast("double") for c in ("income", "expense", "amount", "balance") if c in raw.columns}
    typed |= {"source_row": F.col("source_row").try_cast("long")} if "source_row" in raw.columns else {}
    time = {"txn_time": F.try_to_timestamp("txn_time", F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz"), "time_text": F.col("txn_time")} if "txn_time" in raw.columns else {}
    return conform(raw.drop("seq").withColumns(typed | time).withColumnRenamed("_seq", "seq"))


def _side_by_side(parts: list[DataFrame]) -> DataFrame:
    """Ledgers as one with _ledger, the place of each row's ledger. Rows without a load order are refused."""
    return union_all([p.withColumns({"_ledger": F.lit(k), "seq": F.coalesce("seq", F.raise_error(F.lit("a ledger row has no load order (seq)")).cast("long"))}) for k, p in enumerate(parts)])


def _in_one_order(rows: DataFrame) -> DataFrame:
    return numbered(rows.withColumnRenamed("seq", "_seq"), [F.col("_ledger"), F.col("_seq")], "seq").drop("_ledger", "_seq")


def in_load_order(parts: list[DataFrame]) -> DataFrame:
    """Ledgers as one whose load order is theirs, one after another, from 1 without gaps. Rows without one are refused."""
    return _in_one_order(_side_by_side(parts))


def one_after_another(parts: list[DataFrame]) -> DataFrame:
    """Ledgers as one, written, whose load order is theirs, one after another, with the gaps that it has in them: each
    ledger's is shifted behind the last of the one before, so that no row is moved for it. Only where that leaves the range
    of a long are the rows numbered. Rows without a load order are refused."""
    rows = write_table(_side_by_side(parts), "ledger")
    shifts, end = [0] * len(parts), 0
    for r in rows.groupBy("_ledger").agg(F.min("seq").alias("first"), F.max("seq").alias("last")).orderBy("_ledger").collect():  # a row per ledger
        shifts[r["_ledger"]] = end + 1 - r["first"]
        end += 1 + r["last"] - r["first"]
    if max(end, *map(abs, shifts)) >= LAST_ROW:
        return _in_one_order(rows)
    shift = F.get(F.array(*(F.lit(s).cast("long") for s in shifts)), F.col("_ledger"))
    return rows.withColumn("seq", F.col("seq") + shift).drop("_ledger")


def union_all(parts: list[DataFrame]) -> DataFrame:
    """UNION ALL by name, missing columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def integrated_order() -> list[Column]:
    return [F.asc_nulls_last(c) for c in ("own_account", "txn_time", "source_file", "source_row")]


def integrated(ledger: DataFrame) -> DataFrame:
    """The ledger in order of account, time, file and row, missing values last."""
    return ledger.orderBy(*integrated_order())


def customers(specs: list[tuple[str, DataFrame] | tuple[str, DataFrame, str]]) -> tuple[DataFrame, list[tuple[str, int]]]:
    """Ledgers of (name, ledger[, id]) as one, with customer_id (by default C001 on) and customer_name; and the order of
    the ids."""
    parts, order = [], []
    for k, spec in enumerate(specs):
        cid = spec[2] if len(spec) > 2 else f"C{k + 1:03d}"
        order.append((cid, k))
        parts.append(spec[1].select(F.lit(cid).alias("customer_id"), F.lit(spec[0]).alias("customer_name"), "*"))
    return in_load_order(parts), order


def read_rule_csv(spark: SparkSession, path: str) -> DataFrame:
    """A rule table as texts under this library's names; older tables name the scope differently."""
    # The published columns of a rule table.
    names = {"规则编号": "rule_id", "适用方向": "direction", "依据字段": "scope", "适用字段": "scope", "关键词": "keyword", "排除关键词": "excludes", "对手名称含": "opp_any", "一级标签": "label_1", "二级标签": "label_2", "三级标签": "label_3", "优先级": "priority"}
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    raw = raw.toDF(*(c.removeprefix("\ufeff") for c in raw.columns))
    drop = ["适用字段"] if "依据字段" in raw.columns else []
    return raw.drop(*drop).select(*(F.col(f"`{c}`").alias(names[c]) for c in raw.columns if c in names and c not in drop))
