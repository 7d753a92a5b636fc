"""The canonical transaction, its published column names, and the fixed vocabularies of statement layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The published names of all columns, here and in TAGS, CUSTOMER and DELIVERABLE.
#: Column, published name, type. Money stays DOUBLE: all tolerances compare float64 differences with 0.01.
CANONICAL = [
    ("txn_id", "交易唯一编号", T.StringType()),
    ("txn_time", "交易时间", T.TimestampNTZType()),
    ("own_name", "本方名称", T.StringType()),
    ("own_account", "本方账户", T.StringType()),
    ("opp_name", "对手名称", T.StringType()),
    ("opp_account", "对手账户", T.StringType()),
    ("income", "收入金额", T.DoubleType()),
    ("expense", "支出金额", T.DoubleType()),
    ("amount", "交易金额", T.DoubleType()),
    ("balance", "账户余额", T.DoubleType()),
    ("memo", "银行备注", T.StringType()),
    ("note", "账户方附言", T.StringType()),
    ("channel", "交易渠道", T.StringType()),
    ("source_file", "来源文件名", T.StringType()),
    ("source_row", "来源行号", T.LongType()),
]
#: Beside the canonical columns: the time's raw text, and the load order.
EXTRA = [("time_text", T.StringType()), ("seq", T.LongType())]
TAGS = [
    ("direction", "收支方向"), ("label_1", "一级标签"), ("label_2", "二级标签"), ("label_3", "三级标签"), ("label_source", "标签来源"),
    ("label_confidence", "标签置信度"), ("rule_id", "命中规则编号"), ("keyword", "命中关键词"), ("hit_field", "命中字段"),
]
CUSTOMER = [("customer_id", "客户编号"), ("customer_name", "客户名称")]
DELIVERABLE = [("subject_name", "主体名称"), ("bank", "开户行"), ("virtual_balance", "虚拟账户余额")]

LEDGER = T.StructType([T.StructField(n, t) for n, _, t in CANONICAL] + [T.StructField(n, t) for n, t in EXTRA])
PUBLISHED = {n: p for n, p, *_ in [*CANONICAL, *TAGS, *CUSTOMER, *DELIVERABLE]}

# Header synonyms of each standard field, in matching order.
SYNONYMS = [
    ("交易日期", ["交易日期", "记账日期", "交易日"]),
    ("交易时间", ["交易时间"]),
    ("交易时间戳", ["交易时间", "交易日期时间", "记账时间"]),
    ("本方名称", ["户名", "账户名称", "账户名", "本方户名", "客户名称", "本方名称"]),
    ("本方账户", ["账号", "账户号", "卡号", "本方账户", "账户号码"]),
    ("对手名称", ["对方户名", "对手信息", "交易对手名称", "对方账户名", "对手户名", "对方名称", "对手名称", "对方账户名称", "对手账户名"]),
    ("对手账户", ["对方账号", "对方账户", "交易对手账号", "对手账户", "对方账户号", "对方卡号"]),
    ("收入金额", ["收入金额", "收入", "贷方发生额", "存入金额", "贷方金额", "贷方", "贷方发生额(收入)"]),
    ("支出金额", ["支出金额", "支出", "借方发生额", "取出金额", "借方金额", "借方", "借方发生额(支取)"]),
    ("交易金额", ["交易金额", "发生额", "金额"]),
    ("账户余额", ["账户余额", "余额", "本次余额", "当前余额"]),
    ("收支方向", ["收支方向", "收支", "借贷标志", "借贷", "方向", "借贷方向"]),
    ("银行备注", ["交易摘要", "摘要", "用途", "交易类型", "交易备注", "相关信息", "备注", "交易种类", "业务摘要", "附言摘要"]),
    ("账户方附言", ["交易附言", "附言", "留言", "客户附言"]),
    ("交易渠道", ["交易渠道", "渠道", "交易方式", "记账渠道"]),
]
# Words of rows that are page furniture.
NOISE = ["本页", "算术合计", "交易笔数", "承上页", "接下页", "转下页", "页次", "续表", "本期合计", "本页小计", "打印时间："]
# Texts that mean a missing amount, and a missing date or time.
NO_AMOUNT = ["", "nan", "None", "（空）", "(空)", "-", "—"]
NO_TIME = ["nan", "None", "（空）"]

TOLERANCE = 0.01
ZERO_DAY = "1900-01-01"


def load_order(file_rank: Column, row: Column) -> Column:
    """The place of a row in load order: by file, then by row, as one number; a file has fewer than 2^36 rows."""
    return F.shiftleft(file_rank.cast("long"), 36) + row


def conform(df: DataFrame) -> DataFrame:
    """The ledger's columns in order and type; missing ones null, further ones kept behind."""
    known = {f.name for f in LEDGER}
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in LEDGER), *(c for c in df.columns if c not in known))


def published(df: DataFrame) -> DataFrame:
    """df under the published column names."""
    return df.select(*(F.col(c).alias(PUBLISHED.get(c, c)) for c in df.columns))


def from_published(df: DataFrame) -> DataFrame:
    """df under this library's column names."""
    back = {p: n for n, p in PUBLISHED.items()}
    return df.select(*(F.col(f"`{c}`").alias(back.get(c, c)) for c in df.columns))
