"""Compiles a keyword lexicon and a label dimension into a rule table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.functions.money import IN, OUT, priority
from tallybrook.schema import load_order
from tallybrook.tables import numbered

# How the lexicon names fields, texts that are no keyword or label, and the inline rules.
FIELDS = {"摘要或备注": "摘要或备注", "对方户名": "对手名称", "摘要": "银行备注"}
BLANK = ["—", "-", "", "nan", "None"]
INTEREST = ["利息", "结息", "入息", "存息", "季息"]
INTEREST_EXCLUDE = ["利息税", "贷款"]
SUBSIDY_COUNTERPARTIES = ["国库", "金库", "财政", "局", "委员会", "政府"]
SUBSIDY = ["扶持", "支持", "奖", "资金", "资助", "经费", "激励", "补助", "补贴", "高新技术", "高新区", "经发局", "科技局", "整治", "整顿", "整改", "经济和信息化局", "非税"]
SALES_KEYWORD = "款"
SALES_EXCLUDE = [
    "销户款", "开户款", "定期款", "赔款", "退款", "借款", "还款", "贷款", "按揭款", "退余款", "回款", "罚款", "违约款", "执行款", "打款", "划款", "汇款", "付款", "借出款",
    "拨款", "转款", "股东款", "调解款", "代付款", "返款", "扣款", "股权款", "利息款", "捐款", "往来款", "往款", "住来款", "存款", "取款", "收款", "投资款", "公司款", "部分款",
    "租赁款", "款项", "放款", "税款", "保险款", "提款", "报销款", "工资款", "个人款", "借支款", "款已汇", "款金多", "汇缴款", "融资款", "保理款", "薪酬款", "汇入款", "汇出款",
]
RAW = "direction string, scope string, keyword string, excludes string, opp_any string, label_3 string, remark string, ord long"


def label_dimension(sheet: DataFrame) -> DataFrame:
    """sheet(row, label_1, label_2, label_3, income_priority, expense_priority) -> one row per label_3: merged cells are
    filled from above, and of several rows of a label the last counts."""
    above = Window.orderBy("row").rowsBetween(Window.unboundedPreceding, 0)  # a sheet is small
    filled = sheet.select("row", *(F.trim(F.last(c, True).over(above)).alias(c) for c in ("label_1", "label_2")), F.trim("label_3").alias("label_3"), priority(F.col("income_priority")).alias("for_income"), priority(F.col("expense_priority")).alias("for_expense"))
    latest = filled.where(F.col("label_3").isNotNull()).groupBy("label_3").agg(F.max_by(F.struct("label_1", "label_2", "for_income", "for_expense"), "row").alias("d"))
    return latest.select("label_3", "d.*")


#: The sheets of a rule workbook, and the places of the columns that count in them.
DIMENSION_SHEET, LEXICON_SHEET = "资金用途标签判定逻辑", "流水标签词库管理表"
DIMENSION_COLUMNS = {"label_1": 0, "label_2": 1, "label_3": 2, "income_priority": 9, "expense_priority": 10}
LEXICON_COLUMNS = {"flow_field": 0, "keyword": 2, "income_label": 3, "expense_label": 4}


def of_workbook(sheets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """sheets(file, sheet, row_idx, cells): of rule workbooks -> the label sheet as label_dimension() takes it, and the
    lexicon. A sheet's first row is its header; rows of several workbooks go by file, then by row."""
    files = numbered(sheets.select("file").distinct(), [F.col("file")], "_rank")
    rows = sheets.where("row_idx > 0 and exists(cells, c -> c is not null)").join(F.broadcast(files), "file")  # a row per workbook
    part = lambda name, columns: rows.where(F.col("sheet") == name).select(load_order(F.col("_rank") - 1, F.col("row_idx")).alias("row"), *(F.get("cells", F.lit(k)).alias(c) for c, k in columns.items()))
    return part(DIMENSION_SHEET, DIMENSION_COLUMNS), part(LEXICON_SHEET, LEXICON_COLUMNS)


def inline_rules(spark) -> DataFrame:
    rows = [(IN, "摘要或备注", w, "|".join(INTEREST_EXCLUDE), "", "结息", "内联:结息") for w in INTEREST]
    rows += [(IN, "摘要或备注", w, "", "|".join(SUBSIDY_COUNTERPARTIES), "财政补贴", "内联:财政补贴") for w in SUBSIDY]
    rows += [(IN, "摘要或备注", SALES_KEYWORD, "|".join(SALES_EXCLUDE), "", "销售收入", "内联:销售收入款规则")]
    return spark.createDataFrame([(*r, 1 << 50 | k) for k, r in enumerate(rows)], RAW)


def compile_rules(dimension: DataFrame, lexicon: DataFrame) -> DataFrame:
    """dimension: of label_dimension. lexicon(row, flow_field, keyword, income_label, expense_label). Rules of labels
    that the dimension lacks are left out; of equal rules the first stays; numbered by priority and labels."""
    field = None
    for name, f in FIELDS.items():
        test = F.trim(F.coalesce("flow_field", F.lit(""))) == name
        field = F.when(test, f) if field is None else field.when(test, f)
    words = lexicon.select("row", field.otherwise("摘要或备注").alias("scope"), F.trim("keyword").alias("keyword"), F.trim("income_label").alias(IN), F.trim("expense_label").alias(OUT)).where(F.col("keyword").isNotNull() & ~F.col("keyword").isin(*BLANK))
    sides = words.select("scope", "keyword", F.explode(F.array(*(F.struct(F.lit(d).alias("direction"), F.col(d).alias("label_3"), (2 * F.col("row") + k).alias("ord")) for k, d in enumerate((IN, OUT))))).alias("x"))
    listed = sides.select("x.direction", "scope", "keyword", F.lit("").alias("excludes"), F.lit("").alias("opp_any"), "x.label_3", F.lit("词库").alias("remark"), F.col("x.ord").cast("long").alias("ord"))
    raw = listed.unionByName(inline_rules(lexicon.sparkSession)).where(F.col("label_3").isNotNull() & ~F.col("label_3").isin(*BLANK))
    known = raw.join(dimension, "label_3").withColumn("priority", F.when(F.col("direction") == IN, F.col("for_income")).otherwise(F.col("for_expense")))
    key = ["direction", "scope", "keyword", "excludes", "opp_any", "label_3"]
    first = known.groupBy(*key).agg(F.min_by(F.struct("label_1", "label_2", "priority", "remark", "ord"), "ord").alias("r")).select(*key, "r.*")
    return numbered(first, [F.desc("priority"), F.col("label_1"), F.col("label_3"), F.col("ord")], "rule_seq").withColumn("rule_id", F.format_string("R%04d", "rule_seq")).drop("ord")


def typed_rules(table: DataFrame) -> DataFrame:
    """A rule table of texts as tag() wants it: lists split at `|`, a missing or bad priority 500; rule_seq is the rank of
    the rule in the table's own order, which decides between equal priorities."""
    parts = lambda c: F.filter(F.split(F.coalesce(c, F.lit("")), r"\|"), lambda x: x != "") if c in table.columns else F.array().cast("array<string>")
    scope = F.coalesce("scope", F.lit("通用")) if "scope" in table.columns else F.lit("通用")
    order = [F.col("rule_seq")] if "rule_seq" in table.columns else [F.length("rule_id"), F.col("rule_id")]
    level = F.coalesce(F.col("priority").try_cast("double"), F.lit(500.0))
    typed = table.select("rule_id", "direction", scope.alias("scope"), "keyword", parts("excludes").alias("excludes"), parts("opp_any").alias("opp_any"), "label_1", "label_2", "label_3", level.alias("priority"), *(order if "rule_seq" in table.columns else []))
    return numbered(typed, order, "_rank").withColumn("rule_seq", F.col("_rank")).drop("_rank")
