"""Lists of what people should look at."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.money import quality_score
from tallybrook.operators.duplicates import REVIEW
from tallybrook.tables import numbered

KINDS = {"余额断裂": "中", "疑似重复": "中", "共用账户": "高", "重复提交": "中", "标签待复核": "低"}


def _items(df: DataFrame, kind: str, subject, detail, evidence) -> DataFrame:
    return df.select(F.lit(kind).alias("kind"), F.lit(KINDS[kind]).alias("priority"), subject.alias("subject"), detail.alias("detail"), evidence.alias("evidence"))


def review_items(checks: DataFrame | None = None, duplicates: DataFrame | None = None, shared: DataFrame | None = None, resubmitted: DataFrame | None = None, tagged: DataFrame | None = None, tag_limit: int = 50) -> DataFrame:
    """One list of all kinds, numbered RV-001 on by kind and subject. Duplicates that are sure need no review."""
    parts = []
    if checks is not None:
        parts.append(_items(checks.where(F.col("status") == "预警"), "余额断裂", F.col("own_account"), F.concat(F.col("breaks").cast("string"), F.lit(" breaks")), F.col("example_ids")))
    if duplicates is not None:
        parts.append(_items(duplicates.where(F.col("action") == REVIEW), "疑似重复", F.col("group_id"), F.concat(F.col("size").cast("string"), F.lit(" rows")), F.col("txn_ids")))
    if shared is not None:
        parts.append(_items(shared, "共用账户", F.col("own_account"), F.col("customer_ids"), F.col("example_ids")))
    if resubmitted is not None:
        parts.append(_items(resubmitted, "重复提交", F.col("group_id"), F.col("customer_ids"), F.col("txn_ids")))
    if tagged is not None:
        open_rows = tagged.where(F.col("rule_id").isNull()).orderBy("seq").limit(tag_limit)
        parts.append(_items(open_rows, "标签待复核", F.col("txn_id"), F.col("label_3"), F.col("txn_id")))
    every = reduce(DataFrame.unionByName, parts)
    return numbered(every, [F.col("kind"), F.col("subject")], "_rank").withColumn("item_id", F.format_string("RV-%03d", "_rank")).drop("_rank")


def quality(checks: DataFrame, duplicates: DataFrame, issues: int = 0) -> DataFrame:
    """One row: breaks, duplicate_groups, score."""
    one = checks.agg(F.coalesce(F.sum("breaks"), F.lit(0)).alias("breaks")).crossJoin(duplicates.agg(F.count("*").alias("duplicate_groups")))  # single rows
    return one.withColumn("score", quality_score(F.col("breaks"), F.col("duplicate_groups"), F.lit(issues)))


# The published reasons, advice and warnings of an integration.
BREAK = ("存在余额断点：常见于同秒多笔的排序歧义、对账单逆序、或解析缺行，需人工复核而非自动修正", "人工核对该账户对账单顺序与缺行")
EQUAL_ROWS, IN_FILES, IN_FILE = "同账户/时间/金额/余额/对手一致", "，且跨多个来源文件（疑似同源重复导入）", "，同一文件内重复"
TO_SELF, NOT_TO_SELF = "对手为本方名称/账户且金额时间匹配", "金额时间匹配但对手非本方，置信较低"
MISSING = ("对手名称缺失率偏高", "部分银行将对手信息写在备注中", "人工确认对手名称来源或增强解析")
CONFLICT = ("收支方向冲突", "同笔交易收入与支出同时大于0", "人工复核金额方向")
WARN_BREAKS, WARN_GROUPS = "存在余额断点，需人工复核", ("存在 ", " 组疑似重复交易")


def reasons(checks: DataFrame, duplicates: DataFrame, transfers: DataFrame, missing: DataFrame, conflicts: DataFrame) -> DataFrame:
    """section, subject, reason, advice: why each finding of an integration was made; issues of quality name their extent,
    and warnings stand alone."""
    def part(df: DataFrame, section: str, subject, reason, advice) -> DataFrame:
        as_column = lambda x: F.lit(x) if x is None or isinstance(x, str) else x
        return df.select(F.lit(section).alias("section"), subject.alias("subject"), as_column(reason).alias("reason"), as_column(advice).cast("string").alias("advice"))

    broken, none = checks.where(F.col("status") == "预警"), F.lit(None).cast("string")
    groups = duplicates.agg(F.count("*").alias("n")).where("n > 0")
    rows = conflicts.agg(F.count("*").alias("n")).where("n > 0")
    percent = F.concat(F.bround(100 * F.col("rate")).cast("int").cast("string"), F.lit("% 交易"))
    parts = [
        part(broken, "余额断裂", F.col("own_account"), *BREAK), part(duplicates, "疑似重复", F.col("group_id"), F.concat(F.lit(EQUAL_ROWS), F.when(F.col("files") > 1, IN_FILES).otherwise(IN_FILE)), F.col("action")),
        part(transfers, "自有账户互转", F.col("transfer_id"), F.when(F.col("confidence") > 0.5, TO_SELF).otherwise(NOT_TO_SELF), None),
        part(missing.where("flagged"), MISSING[0], percent, *MISSING[1:]), part(rows, CONFLICT[0], F.concat(F.col("n").cast("string"), F.lit(" 笔")), *CONFLICT[1:]),
        part(broken.select(F.lit(1)).limit(1), "提示", none, WARN_BREAKS, None), part(groups, "提示", none, F.concat(F.lit(WARN_GROUPS[0]), F.col("n").cast("string"), F.lit(WARN_GROUPS[1])), None),
    ]
    return reduce(DataFrame.unionByName, parts)
