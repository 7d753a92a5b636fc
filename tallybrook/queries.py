"""The registered queries of the ledger operators, each with the SQL that DuckDB runs on the same tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.functions import money, text
from tallybrook.functions.headers import match_field
from tallybrook.operators import checks, customers, duplicates, portfolio, reports, rules, standardize, tagging, transfers
from tallybrook.schema import NOISE, SYNONYMS
from tallybrook.sources import ledgers, testdata
from tallybrook.tables import numbered

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

#: The ledgers of sources.testdata in SQL.
L1 = """
    e AS (
        SELECT *, floor(value * 100 + 0.5)::BIGINT AS cents, user_id % 25 AS acct, event_type IN ('purchase', 'signup') AS inc FROM events),
    r AS (SELECT *, (sum(CASE WHEN inc THEN cents ELSE -cents END) OVER (PARTITION BY acct ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))::BIGINT AS run FROM e),
    l1 AS (
        SELECT event_id AS seq, 'TX-' || substr(md5(event_id::VARCHAR), 1, 12) AS txn_id, ts AS txn_time, 'N' || acct AS own_name, 'A' || acct AS own_account,
               CASE WHEN event_id % 11 <> 0 THEN 'N' || (event_id % 40) END AS opp_name, 'A' || (event_id % 40) AS opp_account,
               CASE WHEN inc THEN cents::DOUBLE / 100 END AS income, CASE WHEN NOT inc THEN cents::DOUBLE / 100 END AS expense,
               CASE WHEN inc THEN cents ELSE -cents END::DOUBLE / 100 AS amount, (run + CASE WHEN event_id % 97 = 0 THEN 100 ELSE 0 END)::DOUBLE / 100 AS balance,
               event_type AS memo, 'f' || (event_id % 4) || '.csv' AS source_file, event_id AS source_row, user_id
        FROM r)"""
L2 = """
    l2 AS (
        SELECT l_orderkey * 10 + l_linenumber AS seq, 'TX-' || l_orderkey || '-' || l_linenumber AS txn_id, o_orderdate AS txn_time, 'C' || o_custkey AS own_account,
               CASE WHEN l_suppkey % 13 <> 0 THEN s_name END AS opp_name, p_name AS memo, o_orderpriority AS note, NULL::DOUBLE AS balance,
               CASE WHEN l_returnflag = 'A' OR (l_returnflag = 'N' AND l_linenumber = 7) THEN floor(l_extendedprice * 100 + 0.5)::BIGINT::DOUBLE / 100 WHEN l_returnflag = 'N' THEN 0.0::DOUBLE END AS income,
               CASE WHEN l_returnflag = 'R' THEN floor(l_extendedprice * 100 + 0.5)::BIGINT::DOUBLE / 100
                    WHEN l_returnflag = 'N' AND l_linenumber = 7 THEN floor((l_tax * 100) * 100 + 0.5)::BIGINT::DOUBLE / 100 END AS expense,
               'o' || (l_orderkey % 3) || '.csv' AS source_file
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
    d2 AS (
        SELECT *, CASE WHEN income > 0 AND coalesce(expense, 0) = 0 THEN '收入' WHEN expense > 0 AND coalesce(income, 0) = 0 THEN '支出'
                       WHEN income IS NOT NULL AND expense IS NOT NULL THEN CASE WHEN income >= expense THEN '收入' ELSE '支出' END ELSE '未知' END AS direction
        FROM l2)"""
L3 = L1 + """,
    c AS (SELECT 'C' || CASE WHEN (user_id % 25) % 10 = 0 THEN user_id % 3 ELSE (user_id % 25) % 3 END AS customer_id, * FROM l1),
    l3 AS (SELECT * FROM c UNION ALL SELECT 'C9' AS customer_id, * EXCLUDE (customer_id) FROM c WHERE seq % 50 = 0)"""


def _steps(table: str, keys: str, order: str) -> str:
    return f"""
    s AS (
        SELECT *, coalesce(abs(balance - (lag(balance) OVER w + coalesce(income, 0) - coalesce(expense, 0))) >= 0.01, false) AS is_break,
               abs(balance - (lag(balance) OVER w + coalesce(income, 0) - coalesce(expense, 0))) AS diff
        FROM {table} WINDOW w AS (PARTITION BY {keys} ORDER BY {order})),
    n AS (SELECT *, row_number() OVER (PARTITION BY {keys}, is_break ORDER BY {order}) AS nth FROM s)"""


def _check(keys: str, examples: int, order: str) -> str:
    return f"""
    SELECT {keys}, count(*) AS rows, count(balance) AS balances, count(*) FILTER (WHERE is_break) AS breaks,
           CASE WHEN count(balance) < 2 THEN '未校验' WHEN count(*) FILTER (WHERE is_break) = 0 THEN '通过' ELSE '预警' END AS status,
           coalesce(string_agg(txn_id, ',' ORDER BY nth) FILTER (WHERE is_break AND nth <= {examples}), '') AS example_ids,
           arg_max(balance, ({order})) AS closing_balance
    FROM n GROUP BY {keys}"""


def query(sql: str | None = None):
    """Registers a function under its name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _l1(spark, sf_dir):
    return testdata.events_ledger(spark, sf_dir)


def _l2(spark, sf_dir):
    return testdata.orders_ledger(spark, sf_dir)


def _l3(spark, sf_dir):
    return testdata.customers_ledger(spark, sf_dir)


def _tagged(spark, sf_dir):
    return tagging.tag(_l2(spark, sf_dir), rules.typed_rules(testdata.demo_rules(spark)))


# Balance checks -----------------------------------------------------------------------------------------------------
BY_FILE = "txn_time, source_file, source_row"


@query(f"WITH {L1}, {_steps('l1', 'own_account', BY_FILE)} {_check('own_account', 8, BY_FILE)}")
def balance_check_by_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.balance_check(_l1(spark, sf_dir), ["own_account"])


@query(f"WITH {L1}, {_steps('l1', 'own_account', BY_FILE)} SELECT own_account, txn_id, seq, round(diff, 2) AS diff FROM s WHERE is_break")
def balance_break_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = checks.balance_steps(_l1(spark, sf_dir), ["own_account"])
    return steps.where("is_break").select("own_account", "txn_id", "seq", F.bround("diff", 2).alias("diff"))


@query(f"WITH {L3}, {_steps('l3', 'customer_id, own_account', 'txn_time, source_row')} {_check('customer_id, own_account', 5, 'txn_time, source_row')}")
def balance_check_by_customer_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.balance_check(_l3(spark, sf_dir), ["customer_id", "own_account"], by_file=False, examples=5)


@query(f"WITH {L1} SELECT own_account, count(*) AS rows, arg_max(balance, (txn_time, source_row)) AS closing_balance FROM l1 GROUP BY own_account")
def account_closing_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.balance_check(_l1(spark, sf_dir), ["own_account"], by_file=False, drop_null_time=True).select("own_account", "rows", "closing_balance")


# Texts --------------------------------------------------------------------------------------------------------------
@query("""
    SELECT event_id, CASE WHEN event_id % 8 < 4 THEN floor(value * 100 + 0.5)::BIGINT::DOUBLE / 100 * CASE WHEN event_id % 8 = 1 THEN -1 ELSE 1 END
                          WHEN event_id % 8 = 4 THEN event_id::DOUBLE END AS amount
    FROM events""")
def parse_amount_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers as plain, negative, marked and wide text, and texts that are no amount."""
    e = testdata.table(spark, sf_dir, "events")
    plain, k = F.format_number(F.floor(F.col("value") * 100 + 0.5) / 100, 2), F.col("event_id") % 8
    raw = (
        F.when(k == 0, plain).when(k == 1, F.concat(F.lit(" -"), plain)).when(k == 2, F.concat(F.lit("¥"), plain, F.lit("元"))).when(k == 3, F.concat(F.lit("￥ "), F.translate(plain, ",", "，")))
        .when(k == 4, F.translate(F.col("event_id").cast("string"), "0123456789", text.WIDE)).when(k == 5, "（空）").when(k == 6, F.concat(plain, F.lit("d"))).otherwise("—")
    )
    return e.select("event_id", text.parse_amount(raw).alias("amount"))


@query("""
    SELECT event_id, CASE WHEN event_id % 8 < 5 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN event_id % 8 = 5 THEN strftime(ts, '%Y-%m-%d 00:00:00') END AS parsed
    FROM events""")
def parse_datetime_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times in the layouts of statements: split, with fractions, with slashes, and glued; impossible ones."""
    e = testdata.table(spark, sf_dir, "events")
    k, shown = F.col("event_id") % 8, lambda p: F.date_format("ts", p)
    date = (
        F.when(k == 0, shown("yyyyMMdd")).when(k == 1, shown("yyyy-MM-dd HH:mm:ss.SSSSSS")).when(k == 2, shown("yyyy/MM/dd  HH:mm:ss")).when(k == 3, shown("yyyyMMddHH:mm:ss"))
        .when(k == 4, shown("yyyy-MM-ddHH:mm:ss")).when(k == 5, F.concat(shown("yyyy-MM-dd"), F.lit(" 25:00:00"))).when(k == 6, "1899-01-01").otherwise("2025-13-45")
    )
    parsed = text.parse_datetime(date, F.when(k == 0, shown("HHmmss")))
    return e.select("event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("parsed"))


HEADERS = ["交易日期", "对方户名", "金额", "开户名", "记账时间", "借方发生额（支取）", "本 次余额", "无关列", "nan", "", "摘要信息", "渠道", "客户附言", "交易对手账号"]
_SYN = ", ".join(f"({i}, '{'交易时间' if f == '交易时间戳' else f}', '{w}')" for i, (f, ws) in enumerate(SYNONYMS) for w in ws)
_HEADS = ", ".join(f"'{h}'" for h in HEADERS)


@query(f"""
    WITH syn(ord, field, word) AS (VALUES {_SYN}), heads AS (SELECT s_suppkey, [{_HEADS}][s_suppkey % {len(HEADERS)} + 1] AS raw FROM supplier),
    h AS (SELECT s_suppkey, raw, replace(replace(regexp_replace(raw, '\\s+', '', 'g'), '（', '('), '）', ')') AS h FROM heads)
    SELECT s_suppkey, raw, (SELECT field FROM syn WHERE h.h <> '' AND lower(h.h) <> 'nan' AND (contains(h.h, word) OR contains(word, h.h))
                 ORDER BY (h.h = word) DESC, ord LIMIT 1) AS field
    FROM h""")
def header_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A header for each supplier."""
    raw = F.element_at(F.array(*map(F.lit, HEADERS)), (F.col("s_suppkey") % len(HEADERS) + 1).cast("int"))
    return testdata.table(spark, sf_dir, "supplier").select("s_suppkey", raw.alias("raw")).select("s_suppkey", "raw", match_field(F.col("raw")).alias("field"))


_GRID_HEADS = ", ".join(f"({n}, '{h}')" for n, hs in testdata.GRID_HEADS.items() for h in hs)
_MATCHED = """(SELECT field FROM syn WHERE h.h <> '' AND lower(h.h) <> 'nan' AND (contains(h.h, word) OR contains(word, h.h)) ORDER BY (h.h = word) DESC, ord LIMIT 1)"""


@query(f"""
    WITH syn(ord, field, word) AS (VALUES {_SYN}), heads(n, h) AS (VALUES {_GRID_HEADS}),
    m AS (SELECT n, {_MATCHED} AS field FROM heads h)
    SELECT 'f' || n || '.csv' AS file, 2::BIGINT AS header_idx, count(field)::INT AS hits FROM m WHERE n IN (SELECT event_id % 4 FROM events) GROUP BY n""")
def header_row_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize.header_rows(testdata.raw_grids(spark, sf_dir)).select("file", "header_idx", "hits")


_PART_HEADS = ["交易{}日期", "对方 户名（{}）", "{}金额", "开户名", "记账时间{}", "贷方发生额（收入）", " 余额 ", "{}"]


@query(f"""
    WITH syn(ord, field, word) AS (VALUES {_SYN}),
    heads AS (SELECT p_partkey, CASE p_partkey % 8 {" ".join(f"WHEN {k} THEN replace('{h}', '{{}}', p_name)" for k, h in enumerate(_PART_HEADS))} END AS raw FROM part),
    h AS (SELECT *, replace(replace(regexp_replace(raw, '\\s+', '', 'g'), '（', '('), '）', ')') AS h FROM heads)
    SELECT p_partkey, raw, {_MATCHED} AS field FROM h""")
def header_match_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers with the names of all parts in them."""
    k, raw = F.col("p_partkey") % 8, F.lit(None).cast("string")
    for n, h in enumerate(_PART_HEADS):
        raw = F.when(k == n, F.replace(F.lit(h), F.lit("{}"), F.col("p_name"))).otherwise(raw)
    return testdata.table(spark, sf_dir, "part").select("p_partkey", raw.alias("raw")).select("p_partkey", "raw", match_field(F.col("raw")).alias("field"))


METAS = [("户名：测试公司 账号：6226****4806", "测试公司", "6226****4806", "对公"), ("某某公司)-800091876502013 流水", None, "800091876502013", "对公"), ("活期一本通 123456789 1234567890123", None, "1234567890123", "个人"), ("账户名:张三 没有号码", "张三", None, "未知")]
_METAS = ", ".join("({}, {})".format(n, ", ".join("NULL" if v is None else f"'{v}'" for v in m)) for n, m in enumerate(METAS))


@query(f"SELECT s_suppkey, t.* EXCLUDE (n) FROM supplier JOIN (VALUES {_METAS}) t(n, meta, own_name, own_account, account_type) ON n = s_suppkey % {len(METAS)}")
def account_sniff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A title for each supplier."""
    meta = F.element_at(F.array(*(F.lit(m[0]) for m in METAS)), (F.col("s_suppkey") % len(METAS) + 1).cast("int"))
    return testdata.table(spark, sf_dir, "supplier").select("s_suppkey", meta.alias("meta")).select("s_suppkey", "meta", standardize.sniffed(F.col("meta")).alias("s")).select("s_suppkey", "meta", "s.*")


@query("""
    SELECT c_custkey, CASE WHEN c_custkey % 4 = 3 THEN NULL ELSE c_name END AS own_name,
           CASE c_custkey % 4 WHEN 0 THEN '62' || lpad(c_custkey::VARCHAR, 8, '0') WHEN 1 THEN '62****' || lpad(c_custkey::VARCHAR, 6, '0') WHEN 2 THEN lpad(c_custkey::VARCHAR, 9, '7') END AS own_account,
           CASE c_custkey % 4 WHEN 0 THEN '个人' WHEN 1 THEN '对公' ELSE '未知' END AS account_type
    FROM customer""")
def account_sniff_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles that name each customer: labelled and masked numbers, one behind a dash, and none."""
    c, k, key = testdata.table(spark, sf_dir, "customer"), F.col("c_custkey") % 4, F.col("c_custkey").cast("string")
    meta = (
        F.when(k == 0, F.concat(F.lit("户名："), "c_name", F.lit("  储蓄 卡 号: 62"), F.lpad(key, 8, "0")))
        .when(k == 1, F.concat(F.lit("某公司 账户名 "), "c_name", F.lit("，账号 62****"), F.lpad(key, 6, "0")))
        .when(k == 2, F.concat(F.lit("账户名称:"), "c_name", F.lit(" 户主)-"), F.lpad(key, 9, "7"), F.lit(" 12345678")))
        .otherwise(F.lit("1234567 流水"))
    )
    return c.select("c_custkey", standardize.sniffed(meta).alias("s")).select("c_custkey", "s.*")


@query(f"""
    WITH {L1} SELECT seq, 'TX-' || substr(md5(own_name || '|' || own_account || '|' || strftime(txn_time, '%Y-%m-%d %H:%M:%S') || '|'
        || printf('%.2f', coalesce(income, expense)) || '|' || source_file || '|' || source_row), 1, 12) AS unique_id FROM l1""")
def unique_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [F.col("own_name"), F.col("own_account"), F.date_format("txn_time", "yyyy-MM-dd HH:mm:ss"), text.money_text(F.coalesce("income", "expense")), F.col("source_file"), F.col("source_row")]
    return _l1(spark, sf_dir).select("seq", text.unique_id(*parts).alias("unique_id"))


# Standardisation ----------------------------------------------------------------------------------------------------
@query(f"""
    WITH {L1}, m AS (SELECT seq % 4 AS n, CASE seq % 4 WHEN 0 THEN NULL WHEN 2 THEN abs(amount) ELSE amount END AS shown, row_number() OVER (PARTITION BY seq % 4 ORDER BY seq) AS k FROM l1),
    f AS (SELECT n, bool_or(shown < 0) FILTER (WHERE k <= 250) AS signed FROM m GROUP BY n)
    SELECT 'f' || n || '.csv' AS file, CASE WHEN n = 0 THEN '分列' WHEN n = 2 AND NOT signed THEN '方向+金额' ELSE '单列带符号' END AS mode, '12345678901' || n AS own_account, '测试公司' || n AS own_name, '对公' AS account_type FROM f""")
def amount_mode_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize.layouts(testdata.raw_grids(spark, sf_dir)).select("file", "mode", "own_account", "own_name", "account_type")


@query(f"""
    WITH {L1} SELECT source_file, 2 * row_number() OVER (PARTITION BY seq % 4 ORDER BY seq) + 3 AS source_row, strftime(txn_time, '%Y-%m-%d %H:%M:%S') AS txn_time,
        '测试公司' || (seq % 4) AS own_name, own_account, opp_name, income, expense,
        CASE seq % 4 WHEN 0 THEN NULL WHEN 2 THEN abs(amount) ELSE amount END AS amount, balance, memo FROM l1""")
def standardize_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files of four layouts back to transactions, free of page furniture."""
    ledger, _ = standardize.standardize(testdata.raw_grids(spark, sf_dir))
    return ledger.select("source_file", "source_row", F.date_format("txn_time", "yyyy-MM-dd HH:mm:ss").alias("txn_time"), "own_name", "own_account", "opp_name", "income", "expense", "amount", "balance", "memo")


@query(f"""
    WITH {L1}, k AS (SELECT seq % 4 AS n, 2 * row_number() OVER (PARTITION BY seq % 4 ORDER BY seq) + 3 AS i FROM l1)
    SELECT 'f' || n || '.csv' AS file, 2::BIGINT AS header_idx, CASE n WHEN 0 THEN '分列' WHEN 2 THEN '方向+金额' ELSE '单列带符号' END AS mode,
           (2 * count(*) - count(*) FILTER (WHERE i % 5 <> 0 AND i % 3 = 0)) AS rows, (count(*) - count(*) FILTER (WHERE i % 5 <> 0 AND i % 3 = 0)) AS dropped,
           0.95::DOUBLE AS confidence
    FROM k GROUP BY n""")
def standardize_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, report = standardize.standardize(testdata.raw_grids(spark, sf_dir))
    return report.select("file", "header_idx", "mode", "rows", "dropped", "confidence")


def _amounts(spark, sf_dir, expression):
    return _l2(spark, sf_dir).select("txn_id", "seq", "income", "expense", expression.alias("x")).groupBy(F.col("x.income").isNull().alias("no_income"), F.col("x.expense").isNull().alias("no_expense")).agg(F.count("*").alias("rows"), F.bround(F.sum("x.income"), 2).alias("income"), F.bround(F.sum("x.expense"), 2).alias("expense"), F.bround(F.sum("x.amount"), 2).alias("amount"))


def _amounts_sql(income: str, expense: str, amount: str) -> str:
    return f"""
    WITH {L2}, x AS (SELECT {income} AS i, {expense} AS e, {amount} AS a FROM l2)
    SELECT i IS NULL AS no_income, e IS NULL AS no_expense, count(*) AS rows, round(sum(i), 2) AS income, round(sum(e), 2) AS expense, round(sum(a), 2) AS amount FROM x GROUP BY ALL"""


_NET = "(coalesce(income, 0) - coalesce(expense, 0))"
_SOME = "income IS NOT NULL OR expense IS NOT NULL"


@query(_amounts_sql(f"CASE WHEN ({_SOME}) AND {_NET} >= 0 THEN {_NET} END", f"CASE WHEN {_NET} < 0 THEN -{_NET} END", f"CASE WHEN {_SOME} THEN {_NET} END"))
def split_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _amounts(spark, sf_dir, money.split_amounts(F.col("income"), F.col("expense")))


_SIGNED = "coalesce(income, -expense)"


@query(_amounts_sql(f"CASE WHEN {_SIGNED} >= 0 THEN {_SIGNED} END", f"CASE WHEN {_SIGNED} < 0 THEN -{_SIGNED} END", _SIGNED))
def signed_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _amounts(spark, sf_dir, money.signed_amounts(F.coalesce(F.col("income"), -F.col("expense"))))


_WORD = "CASE seq % 4 WHEN 0 THEN '贷' WHEN 1 THEN '支出' WHEN 2 THEN '收支' END"


@query(_amounts_sql(
    f"CASE WHEN seq % 4 = 0 THEN abs({_SIGNED}) WHEN seq % 4 >= 2 AND {_SIGNED} >= 0 THEN {_SIGNED} END",
    f"CASE WHEN seq % 4 = 1 THEN abs({_SIGNED}) WHEN seq % 4 >= 2 AND {_SIGNED} < 0 THEN abs({_SIGNED}) END", _SIGNED))
def direction_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("seq") % 4
    word = F.when(k == 0, "贷").when(k == 1, "支出").when(k == 2, "收支")
    return _amounts(spark, sf_dir, money.direction_amounts(word, F.coalesce(F.col("income"), -F.col("expense"))))


_NOISE = " OR ".join(f"contains(line, '{w}')" for w in NOISE)


@query(f"""
    WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN '本页小计 ' || p_name WHEN p_partkey % 11 = 0 THEN p_name || ' 承上页' ELSE p_name END AS line FROM part)
    SELECT p_partkey, {_NOISE} AS noise FROM p""")
def noise_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, k = testdata.table(spark, sf_dir, "part"), F.col("p_partkey")
    line = F.when(k % 7 == 0, F.array(F.lit("本页小计"), "p_name")).when(k % 11 == 0, F.array(F.col("p_name"), F.lit("承上页"))).otherwise(F.array("p_name"))
    return p.select("p_partkey", standardize.is_noise(line).alias("noise"))


@query("SELECT p_partkey, p_partkey % 5 >= 3 AS repeated FROM part")
def repeated_header_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    head, k = F.array(*map(F.lit, ["交易时间", "金额", "余额(元)", "摘要"])), F.col("p_partkey") % 5
    cells = F.array(F.when(k >= 1, "交易 时间").otherwise("x"), F.when(k >= 2, "金额").otherwise("y"), F.when(k >= 3, "余额（元）").otherwise(""), F.col("p_name"))
    return testdata.table(spark, sf_dir, "part").select("p_partkey", standardize.repeats_header(cells, head).alias("repeated"))


@query("SELECT p_partkey, p_partkey % 3 = 0 AS empty FROM part")
def empty_row_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = F.array(F.lit(""), F.lit("nan"), F.when(F.col("p_partkey") % 3 != 0, F.col("p_name")))
    return testdata.table(spark, sf_dir, "part").select("p_partkey", standardize.is_empty(cells).alias("empty"))


# Integration --------------------------------------------------------------------------------------------------------
@query(f"WITH {L1} SELECT row_number() OVER (ORDER BY own_account NULLS LAST, txn_time NULLS LAST, source_file NULLS LAST, source_row NULLS LAST) AS position, txn_id, CASE WHEN seq % 4 = 3 THEN NULL ELSE memo END AS memo FROM l1")
def integrated_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ledger of four files, of which one lacks the memo; position is its rank in the order of integration."""
    ledger = _l1(spark, sf_dir)
    files = [ledger.where(F.col("seq") % 4 == k) for k in range(4)]
    whole = ledgers.union_all([*files[:3], files[3].drop("memo")])
    return numbered(whole, ledgers.integrated_order(), "position").select("position", "txn_id", "memo")


_DUP = "own_account, txn_time, income, expense, balance, opp_name"


def _handed_in_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ledgers, and some rows of one a second time."""
    l1 = _l1(spark, sf_dir)
    again = l1.where(F.col("seq") % 100 < 2).withColumns({"txn_id": F.concat("txn_id", F.lit("b")), "source_file": F.when(F.col("seq") % 2 == 0, "again.csv").otherwise(F.col("source_file"))})
    return ledgers.union_all([_l2(spark, sf_dir), l1, again])


@query(f"""
    WITH {L2}, {L1}, both_ AS (
        SELECT {_DUP}, txn_id, source_file FROM l2 UNION ALL SELECT {_DUP}, txn_id, source_file FROM l1
        UNION ALL SELECT {_DUP}, txn_id || 'b', CASE WHEN seq % 2 = 0 THEN 'again.csv' ELSE source_file END FROM l1 WHERE seq % 100 < 2),
    g AS (
        SELECT {_DUP}, count(*) AS size, count(DISTINCT source_file) AS files FROM both_ GROUP BY ALL HAVING count(*) >= 2),
    n AS (SELECT *, row_number() OVER (ORDER BY own_account NULLS FIRST, txn_time NULLS FIRST, income NULLS FIRST, expense NULLS FIRST, balance NULLS FIRST, opp_name NULLS FIRST) AS n FROM g)
    SELECT printf('DUP-%04d', n) AS group_id, size, files, txn_id, b.source_file
    FROM n g JOIN both_ b ON {" AND ".join(f"g.{c} IS NOT DISTINCT FROM b.{c}" for c in _DUP.split(", "))}""")
def duplicate_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each row of a group, with no list of ids."""
    return duplicates.duplicate_members(_handed_in_again(spark, sf_dir)).select("group_id", "size", "files", "txn_id", "source_file")


@query(f"""
    WITH {L2}, {L1}, both_ AS (
        SELECT {_DUP}, txn_id, source_file FROM l2 UNION ALL SELECT {_DUP}, txn_id, source_file FROM l1
        UNION ALL SELECT {_DUP}, txn_id || 'b', CASE WHEN seq % 2 = 0 THEN 'again.csv' ELSE source_file END FROM l1 WHERE seq % 100 < 2),
    g AS (
        SELECT {_DUP}, count(*) AS size, count(DISTINCT source_file) AS files, string_agg(txn_id, ',' ORDER BY txn_id) AS txn_ids, string_agg(DISTINCT source_file, ',' ORDER BY source_file) AS source_files
        FROM both_ GROUP BY ALL HAVING count(*) >= 2)
    SELECT own_account, strftime(txn_time, '%Y-%m-%d %H:%M:%S') AS txn_time, income, expense, balance, opp_name, size, files, txn_ids, source_files,
           CASE WHEN files > 1 AND balance IS NOT NULL THEN 0.9 ELSE 0.5 END::DOUBLE AS confidence,
           CASE WHEN files > 1 AND balance IS NOT NULL THEN '保留一笔' ELSE '人工复核' END AS action,
           printf('DUP-%04d', row_number() OVER (ORDER BY own_account NULLS FIRST, txn_time NULLS FIRST, income NULLS FIRST, expense NULLS FIRST, balance NULLS FIRST, opp_name NULLS FIRST)) AS group_id
    FROM g""")
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = duplicates.duplicate_groups(_handed_in_again(spark, sf_dir))
    return found.withColumn("txn_time", F.date_format("txn_time", "yyyy-MM-dd HH:mm:ss"))


@query(f"""
    WITH {L1} SELECT own_account, own_name, string_agg(DISTINCT source_file, '；' ORDER BY source_file) AS source_files, count(*) AS rows,
        min(txn_time)::DATE AS first_day, max(txn_time)::DATE AS last_day, round(sum(coalesce(income, 0)), 2) AS income, round(sum(coalesce(expense, 0)), 2) AS expense
    FROM l1 GROUP BY own_account, own_name""")
def account_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.account_index(_l1(spark, sf_dir))


@query(f"WITH {L2} SELECT txn_id, seq, income, expense FROM l2 WHERE income > 0 AND expense > 0")
def direction_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.direction_conflicts(_l2(spark, sf_dir)).select("txn_id", "seq", "income", "expense")


@query(f"WITH {L2} SELECT count(*) AS rows, count(*) FILTER (WHERE opp_name IS NULL) AS missing, count(*) FILTER (WHERE opp_name IS NULL) / count(*) AS rate, count(*) FILTER (WHERE opp_name IS NULL) > 0.3 * count(*) AS flagged FROM l2")
def counterparty_missing_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.missing_rate(_l2(spark, sf_dir))


@query(f"""
    WITH {L1}, {_steps('l1', 'own_account', BY_FILE)},
    b AS (SELECT count(*) FILTER (WHERE is_break) AS breaks FROM s), g AS (SELECT count(*) AS duplicate_groups FROM (SELECT 1 FROM l1 GROUP BY {_DUP} HAVING count(*) >= 2))
    SELECT breaks, duplicate_groups, greatest(0, 100 - least(30, breaks // 5) - least(20, duplicate_groups) - 10)::INT AS score FROM b, g""")
def quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    l1 = _l1(spark, sf_dir)
    return reports.quality(checks.balance_check(l1, ["own_account"]), duplicates.duplicate_groups(l1), issues=1)


# Portfolio ----------------------------------------------------------------------------------------------------------
EOD = "eod AS (SELECT own_account AS acct, txn_time::DATE AS day, arg_max(balance, (txn_time, source_row)) AS balance FROM l1 GROUP BY ALL)"
DAILY = f"""{EOD},
    span AS (SELECT min(txn_time)::DATE AS a, max(txn_time)::DATE AS b FROM l1),
    days AS (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS day FROM span),
    grid AS (SELECT acct, day FROM (SELECT DISTINCT own_account AS acct FROM l1), days),
    daily AS (SELECT acct, day, coalesce(last_value(balance IGNORE NULLS) OVER (PARTITION BY acct ORDER BY day ROWS UNBOUNDED PRECEDING), 0) AS balance FROM grid LEFT JOIN eod USING (acct, day)),
    total AS (SELECT day, round(sum(balance), 2) AS total FROM daily GROUP BY day)"""


@query(f"WITH {L1}, {EOD} SELECT * FROM eod")
def eod_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.eod_balance(_l1(spark, sf_dir))


@query(f"WITH {L1}, {DAILY} SELECT * FROM daily")
def daily_balance_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.daily_balance(_l1(spark, sf_dir))


@query(f"WITH {L1}, {DAILY} SELECT * FROM total")
def daily_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.daily_total(portfolio.daily_balance(_l1(spark, sf_dir)))


#: All accounts that the ledger can hold; those without rows are null.
ACCOUNTS = [f"A{i}" for i in range(25)]
_WIDE = ", ".join(f"""round(max(balance) FILTER (WHERE acct = '{a}'), 2) AS "{a}\"""" for a in ACCOUNTS)


@query(f"WITH {L1}, {DAILY} SELECT day, {_WIDE}, round(sum(balance), 2) AS total FROM daily GROUP BY day")
def daily_balance_wide_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.daily_wide(portfolio.daily_balance(_l1(spark, sf_dir)), ACCOUNTS)


@query(ORACLE_SQL["daily_balance_wide_all"])
def daily_balance_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same columns, found in the ledger instead of given."""
    daily = portfolio.daily_balance(_l1(spark, sf_dir))
    found = portfolio.daily_wide(daily)
    return found.select("day", *((F.col(a) if a in found.columns else F.lit(None).cast("double")).alias(a) for a in ACCOUNTS), "total")


_SUMMARY = """min(day) AS first_day, max(day) AS last_day, count(*) AS days, arg_min(total, day) AS opening, arg_max(total, day) AS closing,
    max(total) AS peak, arg_min(day, (-total, day)) AS peak_day, min(total) AS trough, arg_min(day, (total, day)) AS trough_day"""


@query(f"WITH {L1}, {DAILY} SELECT (SELECT count(DISTINCT acct) FROM daily) AS accounts, {_SUMMARY} FROM total")
def portfolio_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.summary(_l1(spark, sf_dir))


@query(f"""
    WITH {L3},
    eod AS (SELECT customer_id, customer_id || '|' || own_account AS acct, txn_time::DATE AS day, arg_max(balance, (txn_time, source_row)) AS balance FROM l3 GROUP BY ALL),
    span AS (SELECT customer_id, min(txn_time)::DATE AS a, max(txn_time)::DATE AS b FROM l3 GROUP BY ALL),
    days AS (SELECT customer_id, unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS day FROM span),
    grid AS (SELECT customer_id, acct, day FROM (SELECT DISTINCT customer_id, acct FROM eod) JOIN days USING (customer_id)),
    daily AS (SELECT customer_id, acct, day, coalesce(last_value(balance IGNORE NULLS) OVER (PARTITION BY customer_id, acct ORDER BY day ROWS UNBOUNDED PRECEDING), 0) AS balance FROM grid LEFT JOIN eod USING (customer_id, acct, day)),
    n AS (SELECT customer_id, count(DISTINCT acct) AS accounts FROM daily GROUP BY ALL),
    total AS (SELECT customer_id, day, round(sum(balance), 2) AS total FROM daily GROUP BY ALL)
    SELECT customer_id, any_value(accounts) AS accounts, {_SUMMARY} FROM total JOIN n USING (customer_id) GROUP BY customer_id""")
def portfolio_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.summary(_l3(spark, sf_dir), ["customer_id"])


@query(f"""
    WITH {L1}, {DAILY}, flow AS (SELECT txn_time::DATE AS day, round(sum(coalesce(income, 0) - coalesce(expense, 0)), 2) AS net FROM l1 GROUP BY ALL),
    c AS (SELECT day, total, total - lag(total) OVER (ORDER BY day) AS change FROM total)
    SELECT day, total, round(change, 2) AS change, coalesce(net, 0) AS net, round(change - coalesce(net, 0), 2) + 0.0 AS gap, abs(round(change - coalesce(net, 0), 2)) >= 0.01 AS is_break
    FROM c LEFT JOIN flow USING (day) WHERE change IS NOT NULL""")
def portfolio_continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.continuity(_l1(spark, sf_dir))


@query(f"""
    WITH {L1}, d AS (SELECT *, balance - coalesce(lag(balance) OVER (PARTITION BY own_account ORDER BY txn_time, source_row), 0) AS delta FROM l1)
    SELECT seq, round(sum(delta) OVER (ORDER BY txn_time, own_account, source_row ROWS UNBOUNDED PRECEDING), 2) + 0.0 AS virtual_balance FROM d""")
def virtual_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.virtual_balance(_l1(spark, sf_dir)).select("seq", (F.col("virtual_balance") + 0.0).alias("virtual_balance"))


@query(f"WITH {L1} SELECT 4::BIGINT AS files, count(DISTINCT own_account) AS accounts, count(*) AS rows, min(txn_time)::DATE AS first_day, max(txn_time)::DATE AS last_day, round(sum(coalesce(income, 0)), 2) AS inflow, round(sum(coalesce(expense, 0)), 2) AS outflow, round(round(sum(coalesce(income, 0)), 2) - round(sum(coalesce(expense, 0)), 2), 2) AS net FROM l1")
def cover_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.overview(_l1(spark, sf_dir))


# Tagging ------------------------------------------------------------------------------------------------------------
_RULES = """
    rules(rule_id, dir, scope, keyword, excludes, opp_any, l1_, l2_, l3_, priority) AS (VALUES
        ('R0001', '收入', '银行备注', 'ring', 'small', '', 'sale', 'goods', 'ring', 900), ('R0002', '通用', '摘要或备注', 'red', '', '', 'sale', 'goods', 'red', 800),
        ('R0003', '支出', '银行备注', 'bolt', '', '', 'return', 'goods', 'bolt', 800), ('R0004', '支出', '账户方附言', 'URGENT', '', '0|2|4', 'return', 'urgent', 'some', 950),
        ('R0005', '收入', '对手名称', '7', '', '', 'sale', 'partner', 'seven', 700), ('R0006', '通用', '通用', 'HIGH', 'blue|old', '', 'any', 'high', 'high', 500),
        ('R0007', '收入', '摘要或备注', 'gear1', '', '', 'sale', 'across', 'fields', 990), ('R0008', '通用', '银行备注', 'gizmo', '', '1', 'any', 'gizmo', 'one', 500)),
    x AS (SELECT row_number() OVER () AS rid, * FROM d2),
    m AS (
        SELECT x.rid, r.*, CASE scope WHEN '对手名称' THEN coalesce(opp_name, '') WHEN '银行备注' THEN memo WHEN '账户方附言' THEN note WHEN '摘要或备注' THEN memo || note ELSE coalesce(opp_name, '') || memo || note END AS t,
               coalesce(opp_name, '') AS o, memo, note
        FROM x JOIN rules r ON r.dir = '通用' OR r.dir = x.direction),
    f AS (
        SELECT *, row_number() OVER (PARTITION BY rid ORDER BY priority DESC, rule_id) AS nth FROM m
        WHERE contains(t, keyword) AND len(list_filter(string_split(excludes, '|'), lambda e: e <> '' AND contains(t, e))) = 0
          AND (opp_any = '' OR len(list_filter(string_split(opp_any, '|'), lambda e: contains(o, e))) > 0)),
    tagged AS (
        SELECT x.*, f.rule_id, f.keyword,
               CASE WHEN f.rule_id IS NULL THEN NULL WHEN scope = '对手名称' THEN '对手名称' WHEN scope = '银行备注' THEN '银行备注' WHEN scope = '账户方附言' THEN '账户方附言'
                    WHEN scope = '摘要或备注' THEN CASE WHEN contains(x.memo, f.keyword) THEN '银行备注' WHEN contains(x.note, f.keyword) THEN '账户方附言' ELSE '银行备注' END
                    ELSE CASE WHEN contains(o, f.keyword) THEN '对手名称' WHEN contains(x.memo, f.keyword) THEN '银行备注' WHEN contains(x.note, f.keyword) THEN '账户方附言' ELSE '对手名称' END END AS hit_field,
               CASE WHEN f.rule_id IS NULL THEN '其他类' ELSE l1_ END AS label_1, CASE WHEN f.rule_id IS NULL THEN '其他' ELSE l2_ END AS label_2,
               CASE WHEN f.rule_id IS NOT NULL THEN l3_ WHEN direction = '支出' THEN '其他支出' ELSE '其他收入' END AS label_3
        FROM x LEFT JOIN f ON f.rid = x.rid AND nth = 1)"""
TAGGED = f"{L2}, {_RULES}"


@query(f"WITH {L2} SELECT direction, count(*) AS rows FROM d2 GROUP BY direction")
def txn_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _l2(spark, sf_dir).groupBy(money.direction_of(F.col("income"), F.col("expense")).alias("direction")).agg(F.count("*").alias("rows"))


@query(f"""
    WITH {TAGGED} SELECT txn_id, seq, opp_name, memo, direction, label_1, label_2, label_3, CASE WHEN rule_id IS NULL THEN '兜底' ELSE '规则库' END AS label_source,
        CASE hit_field WHEN '对手名称' THEN 0.9 WHEN '银行备注' THEN 0.78 WHEN '账户方附言' THEN 0.72 ELSE 0.3 END::DOUBLE AS label_confidence, rule_id, keyword, hit_field FROM tagged""")
def tag_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir).select("txn_id", "seq", "opp_name", "memo", "direction", "label_1", "label_2", "label_3", "label_source", "label_confidence", "rule_id", "keyword", "hit_field")


@query(f"WITH {TAGGED} SELECT direction, label_1, coalesce(label_2, '') AS label_2, coalesce(label_3, '') AS label_3, count(*) AS rows, round(sum(coalesce(income, 0)), 2) AS income, round(sum(coalesce(expense, 0)), 2) AS expense FROM tagged GROUP BY ALL")
def tag_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagging.tag_summary(_tagged(spark, sf_dir))


@query(f"WITH {TAGGED} SELECT label_1, coalesce(label_2, '') AS label_2, coalesce(label_3, '') AS label_3, count(*) AS rows FROM tagged GROUP BY ALL ORDER BY rows DESC, 1, 2, 3 LIMIT 40")
def tag_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagging.tag_distribution(_tagged(spark, sf_dir))


@query(f"WITH {TAGGED} SELECT label_1, count(*) AS rows, count(rule_id) AS hits FROM tagged GROUP BY ALL")
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagging.label_counts(_tagged(spark, sf_dir))


@query(f"""WITH {TAGGED} SELECT count(*) AS rows, count(rule_id) AS hits, round(count(rule_id) / count(*), 3) AS hit_rate,
    count(*) FILTER (WHERE hit_field = '对手名称') AS hits_opp_name, count(*) FILTER (WHERE hit_field = '银行备注') AS hits_memo, count(*) FILTER (WHERE hit_field = '账户方附言') AS hits_note FROM tagged""")
def tag_hit_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagging.hit_rate(_tagged(spark, sf_dir))


@query(f"""
    WITH {TAGGED}, g AS (SELECT direction, opp_name, count(*) AS rows, min(seq) AS first_seq FROM tagged WHERE rule_id IS NULL AND opp_name IS NOT NULL GROUP BY ALL ORDER BY rows DESC, first_seq LIMIT 40)
    SELECT direction, opp_name, rows, first_seq, printf('NEW-%03d', row_number() OVER (ORDER BY rows DESC, first_seq)) AS suggestion_id FROM g WHERE rows >= 5""")
def rule_suggestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagging.suggestions(_tagged(spark, sf_dir))


_IN = "(" + ", ".join(f"('摘要或备注', '{w}', '{'|'.join(rules.INTEREST_EXCLUDE)}', '', '结息', {k})" for k, w in enumerate(rules.INTEREST)) + ", " + ", ".join(f"('摘要或备注', '{w}', '', '{'|'.join(rules.SUBSIDY_COUNTERPARTIES)}', '财政补贴', {k + 5})" for k, w in enumerate(rules.SUBSIDY)) + f", ('摘要或备注', '款', '{'|'.join(rules.SALES_EXCLUDE)}', '', '销售收入', 23))"


@query(f"""
    WITH dim(label_3, label_1, label_2, for_income, for_expense) AS (VALUES ('销售收入', '经营', '收入', 950, 500), ('结息', '经营', '收入', 1000, 1000), ('财政补贴', '其他', '补贴', 970, 500), ('工资', '其他', '往来', 920, 960)),
    lex AS (
        SELECT p_partkey AS row, CASE p_partkey % 3 WHEN 0 THEN '银行备注' WHEN 1 THEN '对手名称' ELSE '摘要或备注' END AS scope, trim(p_name) AS keyword,
               CASE p_partkey % 5 WHEN 0 THEN '销售收入' WHEN 1 THEN '工资' WHEN 2 THEN '—' WHEN 3 THEN '财政补贴' ELSE 'unknown' END AS i,
               CASE p_partkey % 4 WHEN 0 THEN '销售收入' WHEN 1 THEN '工资' WHEN 2 THEN '—' WHEN 3 THEN '财政补贴' END AS o FROM part),
    raw AS (
        SELECT '收入' AS direction, scope, keyword, '' AS excludes, '' AS opp_any, i AS label_3, '词库' AS remark, 2 * row AS ord FROM lex
        UNION ALL SELECT '支出', scope, keyword, '', '', o, '词库', 2 * row + 1 FROM lex
        UNION ALL SELECT '收入', scope, keyword, excludes, opp_any, label_3, CASE label_3 WHEN '结息' THEN '内联:结息' WHEN '财政补贴' THEN '内联:财政补贴' ELSE '内联:销售收入款规则' END, (1::BIGINT << 50) + k
                  FROM (VALUES {_IN[1:-1]}) t(scope, keyword, excludes, opp_any, label_3, k)),
    first_ AS (SELECT *, row_number() OVER (PARTITION BY direction, scope, keyword, excludes, opp_any, label_3 ORDER BY ord) AS nth FROM raw JOIN dim USING (label_3)),
    kept AS (SELECT *, CASE direction WHEN '收入' THEN for_income ELSE for_expense END::DOUBLE AS priority FROM first_ WHERE nth = 1),
    seq AS (SELECT *, row_number() OVER (ORDER BY priority DESC, label_1, label_3, ord) AS rule_seq FROM kept)
    SELECT direction, scope, keyword, excludes, opp_any, label_3, label_1, label_2, priority, remark, rule_seq, printf('R%04d', rule_seq) AS rule_id FROM seq""")
def compile_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.compile_rules(rules.label_dimension(testdata.demo_dimension(spark)), testdata.lexicon(spark, sf_dir))


@query(f"""
    WITH {L2}, {_RULES.split('x AS (')[0].rstrip().rstrip(',')},
    p AS (SELECT p_partkey AS k, substr(p_name, (1 + p_partkey % 3)::INT, (1 + p_partkey % 6)::INT) AS word, CASE WHEN p_partkey % 2 = 0 THEN '收入' ELSE '通用' END AS dir, (p_partkey % 7) * 10 AS priority FROM part),
    t AS (SELECT DISTINCT direction, memo FROM d2),
    best AS (SELECT direction, memo, arg_min(k, (-priority, k)) AS k FROM t JOIN p ON word <> '' AND contains(memo, word) AND (dir = '通用' OR dir = direction) GROUP BY ALL)
    SELECT seq, txn_id, 'P' || b.k AS rule_id, p.word AS keyword FROM d2 LEFT JOIN best b USING (direction, memo) LEFT JOIN p ON p.k = b.k""")
def tag_by_part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule for each part, with a piece of its name as the keyword, through the index of grams."""
    p, k = testdata.table(spark, sf_dir, "part"), F.col("p_partkey")
    word = F.substring("p_name", (1 + k % 3).cast("int"), (1 + k % 6).cast("int"))
    none = F.array().cast("array<string>")
    table = p.select(
        F.concat(F.lit("P"), k.cast("string")).alias("rule_id"), F.when(k % 2 == 0, "收入").otherwise("通用").alias("direction"), F.lit("银行备注").alias("scope"), word.alias("keyword"), none.alias("excludes"), none.alias("opp_any"),
        F.lit("a").alias("label_1"), F.lit("b").alias("label_2"), word.alias("label_3"), (k % 7 * 10).cast("double").alias("priority"), k.cast("long").alias("rule_seq"),
    ).where("keyword != ''")
    return tagging.tag(_l2(spark, sf_dir), table, few_rules=0).select("seq", "txn_id", "rule_id", "keyword")


# Transfers ----------------------------------------------------------------------------------------------------------
@query(f"""
    WITH {L1} SELECT a.txn_id AS out_id, b.txn_id AS in_id, a.expense AS size FROM l1 a JOIN l1 b
    ON a.expense > 0 AND b.income > 0 AND abs(a.expense - b.income) < 0.01 AND a.own_account <> b.own_account AND abs(epoch_us(a.txn_time) - epoch_us(b.txn_time)) <= 259200000000""")
def transfer_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transfers.candidates(_l1(spark, sf_dir)).select("out_id", "in_id", "size")


def greedy(ledger: str) -> str:
    """Self-transfers in SQL: islands of amounts; in each, one outgoing leg after another takes the first free leg that fits."""
    return f"""
    legs AS (SELECT seq, txn_id, own_account, coalesce(own_account, '') AS account, epoch_us(txn_time) AS micros, opp_name, opp_account, income, expense FROM {ledger}),
    amounts AS (SELECT DISTINCT x FROM (SELECT income AS x FROM legs WHERE income > 0 UNION ALL SELECT expense FROM legs WHERE expense > 0)),
    islands AS (SELECT x, sum(start) OVER (ORDER BY x) AS island FROM (SELECT x, CASE WHEN x - lag(x) OVER (ORDER BY x) < 0.01 THEN 0 ELSE 1 END AS start FROM amounts)),
    outs AS MATERIALIZED (SELECT island, row_number() OVER (PARTITION BY island ORDER BY seq) AS n, seq, account, micros, x FROM legs JOIN islands ON expense = x),
    ins AS MATERIALIZED (SELECT island, seq, account, micros, x FROM legs JOIN islands ON income = x),
    matching(island, n, used, out_seq, in_seq, size) AS (
        SELECT DISTINCT island, 0::BIGINT, []::BIGINT[], NULL::BIGINT, NULL::BIGINT, NULL::DOUBLE FROM outs
        UNION ALL
        SELECT m.island, o.n, CASE WHEN min(i.seq) IS NULL THEN any_value(m.used) ELSE list_append(any_value(m.used), min(i.seq)) END, o.seq, min(i.seq), o.x
        FROM matching m JOIN outs o ON o.island = m.island AND o.n = m.n + 1
        LEFT JOIN ins i ON i.island = o.island AND abs(i.x - o.x) < 0.01 AND i.account <> o.account AND (o.micros IS NULL OR abs(i.micros - o.micros) <= 259200000000) AND NOT list_contains(m.used, i.seq)
        GROUP BY m.island, o.n, o.seq, o.x),
    pairs AS (SELECT row_number() OVER (ORDER BY out_seq) AS nth, out_seq, in_seq, size FROM matching WHERE in_seq IS NOT NULL)"""


@query(f"""
    WITH RECURSIVE {L1}, {greedy('l1')},
    own AS (SELECT seq, coalesce(opp_name IN (SELECT own_name FROM l1), false) OR coalesce(opp_account IN (SELECT own_account FROM l1), false) AS is_self FROM l1)
    SELECT o.txn_id AS out_id, i.txn_id AS in_id, out_seq, in_seq, size, CASE WHEN a.is_self OR b.is_self THEN 0.85 ELSE 0.5 END::DOUBLE AS confidence, printf('INT-%04d', nth) AS transfer_id
    FROM pairs JOIN l1 o ON o.seq = out_seq JOIN l1 i ON i.seq = in_seq JOIN own a ON a.seq = out_seq JOIN own b ON b.seq = in_seq""")
def self_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs depend on load order; the SQL goes through each island's outgoing legs one by one."""
    return transfers.self_transfers(_l1(spark, sf_dir))


@query(f"""
    WITH {L1} SELECT seq, coalesce(opp_name IN (SELECT own_name FROM l1) OR opp_account IN (SELECT own_account FROM l1), opp_account IN (SELECT own_account FROM l1)) AS is_self FROM l1""")
def own_counterparty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transfers.own_marks(_l1(spark, sf_dir))


def _why(section: str, subject: str, reason: str, advice: str = "NULL") -> str:
    return f"SELECT '{section}' AS section, {subject} AS subject, {reason} AS reason, {advice} AS advice"


@query(f"""
    WITH RECURSIVE {L1}, {greedy('l1')}, {_steps('l1', 'own_account', BY_FILE)}, checks AS ({_check('own_account', 8, BY_FILE)}),
    own AS (SELECT seq, coalesce(opp_name IN (SELECT own_name FROM l1), false) OR coalesce(opp_account IN (SELECT own_account FROM l1), false) AS is_self FROM l1),
    g AS (SELECT count(DISTINCT source_file) AS files, bool_or(balance IS NOT NULL) AS known, row_number() OVER (ORDER BY own_account, txn_time, income NULLS FIRST, expense NULLS FIRST, balance, opp_name NULLS FIRST) AS nth FROM l1 GROUP BY {_DUP} HAVING count(*) >= 2)
    {_why('余额断裂', 'own_account', f"'{reports.BREAK[0]}'", f"'{reports.BREAK[1]}'")} FROM checks WHERE status = '预警'
    UNION ALL {_why('疑似重复', "printf('DUP-%04d', nth)", f"'{reports.EQUAL_ROWS}' || CASE WHEN files > 1 THEN '{reports.IN_FILES}' ELSE '{reports.IN_FILE}' END", "CASE WHEN files > 1 AND known THEN '保留一笔' ELSE '人工复核' END")} FROM g
    UNION ALL {_why('自有账户互转', "printf('INT-%04d', nth)", f"CASE WHEN a.is_self OR b.is_self THEN '{reports.TO_SELF}' ELSE '{reports.NOT_TO_SELF}' END")} FROM pairs JOIN own a ON a.seq = out_seq JOIN own b ON b.seq = in_seq
    UNION ALL SELECT * FROM ({_why(reports.MISSING[0], "round(100.0 * count(*) FILTER (WHERE opp_name IS NULL) / count(*))::INT || '% 交易'", f"'{reports.MISSING[1]}'", f"'{reports.MISSING[2]}'")} FROM l1 HAVING count(*) FILTER (WHERE opp_name IS NULL) > 0.3 * count(*))
    UNION ALL SELECT * FROM ({_why(reports.CONFLICT[0], "count(*) || ' 笔'", f"'{reports.CONFLICT[1]}'", f"'{reports.CONFLICT[2]}'")} FROM l1 WHERE income > 0 AND expense > 0 HAVING count(*) > 0)
    UNION ALL SELECT * FROM ({_why('提示', 'NULL', f"'{reports.WARN_BREAKS}'")} FROM checks WHERE status = '预警' LIMIT 1)
    UNION ALL SELECT * FROM ({_why('提示', 'NULL', f"'{reports.WARN_GROUPS[0]}' || count(*) || '{reports.WARN_GROUPS[1]}'")} FROM g HAVING count(*) > 0)""")
def integration_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why each finding of an integration was made, in the published words."""
    ledger = _l1(spark, sf_dir)
    return reports.reasons(checks.balance_check(ledger, ["own_account"]), duplicates.duplicate_groups(ledger), transfers.self_transfers(ledger), checks.missing_rate(ledger), checks.direction_conflicts(ledger))


# Customers ----------------------------------------------------------------------------------------------------------
@query(f"""
    WITH {L3}, g AS (SELECT own_account, count(DISTINCT customer_id) AS customers, string_agg(DISTINCT customer_id, ',' ORDER BY customer_id) AS customer_ids, count(*) AS rows FROM l3 GROUP BY own_account HAVING count(DISTINCT customer_id) > 1),
    n AS (SELECT own_account, txn_id, row_number() OVER (PARTITION BY own_account ORDER BY seq, txn_id) AS nth FROM l3)
    SELECT own_account, customers, customer_ids, rows, string_agg(txn_id, ',' ORDER BY nth) AS example_ids, '高' AS severity FROM g JOIN n USING (own_account) WHERE nth <= 10 GROUP BY ALL""")
def shared_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.shared_accounts(_l3(spark, sf_dir))


@query(f"""
    WITH {L3}, g AS (SELECT txn_time, income, expense, balance, opp_name, count(*) AS size, count(DISTINCT customer_id) AS customers, string_agg(DISTINCT customer_id, ',' ORDER BY customer_id) AS customer_ids, string_agg(txn_id, ',' ORDER BY txn_id) AS txn_ids FROM l3 GROUP BY ALL HAVING count(DISTINCT customer_id) > 1)
    SELECT strftime(txn_time, '%Y-%m-%d %H:%M:%S') AS txn_time, income, expense, balance, opp_name, size, customers, customer_ids, txn_ids, 0.6::DOUBLE AS confidence,
           printf('XDUP-%04d', row_number() OVER (ORDER BY g.txn_time NULLS FIRST, income NULLS FIRST, expense NULLS FIRST, balance NULLS FIRST, opp_name NULLS FIRST)) AS group_id FROM g""")
def cross_customer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.cross_customer_fingerprints(_l3(spark, sf_dir)).withColumn("txn_time", F.date_format("txn_time", "yyyy-MM-dd HH:mm:ss"))


@query(f"""
    WITH {L3}, o AS (SELECT DISTINCT own_name, own_account, customer_id AS other FROM l3)
    SELECT l3.seq, txn_id, l3.customer_id, coalesce(income, expense) AS size, min(other) AS other_customer_id
    FROM l3 JOIN o ON other <> l3.customer_id AND (o.own_name = opp_name OR o.own_account = opp_account) GROUP BY ALL""")
def inter_customer_txns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers.inter_customer_txns(_l3(spark, sf_dir)).select("seq", "txn_id", "customer_id", "size", "other_customer_id")


@query(f"""
    WITH {L3} SELECT opp_name, count(DISTINCT customer_id) AS customers, string_agg(DISTINCT customer_id, ',' ORDER BY customer_id) AS customer_ids, count(*) AS rows, round(sum(coalesce(income, 0)), 2) AS income, round(sum(coalesce(expense, 0)), 2) AS expense,
        CASE WHEN count(DISTINCT customer_id) >= 3 THEN '需要复核' ELSE '常见交易对手' END AS remark
    FROM l3 WHERE opp_name IS NOT NULL GROUP BY opp_name HAVING count(DISTINCT customer_id) > 1 ORDER BY rows DESC, opp_name LIMIT 30""")
def common_counterparties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers.common_counterparties(_l3(spark, sf_dir))


_CHECKS3 = f"{L3}, {_steps('l3', 'customer_id, own_account', 'txn_time, source_row')}, checks AS ({_check('customer_id, own_account', 5, 'txn_time, source_row')})"


@query(f"""
    WITH {_CHECKS3}, m AS (SELECT customer_id, count(*) AS rows, count(DISTINCT own_account) AS accounts FROM l3 GROUP BY ALL)
    SELECT customer_id, m.rows, accounts, count(*) AS checked, count(*) FILTER (WHERE status = '通过') AS passed, count(*) FILTER (WHERE status = '预警') AS warned, sum(breaks)::BIGINT AS breaks FROM m JOIN checks USING (customer_id) GROUP BY ALL""")
def customer_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = _l3(spark, sf_dir)
    return customers.customer_overview(ledger, checks.balance_check(ledger, ["customer_id", "own_account"], by_file=False, examples=5))


@query(f"""
    WITH {_CHECKS3}, a AS (SELECT count(DISTINCT customer_id) AS customers, count(DISTINCT own_account) AS accounts, count(*) AS rows FROM l3),
    b AS (SELECT count(*) FILTER (WHERE status = '通过') AS passed, count(*) FILTER (WHERE status = '预警') AS warned, sum(breaks)::BIGINT AS breaks FROM checks),
    sh AS (SELECT count(*) AS shared_accounts FROM (SELECT 1 FROM l3 GROUP BY own_account HAVING count(DISTINCT customer_id) > 1)),
    d AS (SELECT count(*) AS duplicate_groups FROM (SELECT 1 FROM l3 GROUP BY txn_time, income, expense, balance, opp_name HAVING count(DISTINCT customer_id) > 1))
    SELECT *, greatest(0, 100 - 20 * shared_accounts - CASE WHEN duplicate_groups > 0 THEN 5 ELSE 0 END)::INT AS score, shared_accounts > 0 AS blocked FROM a, b, sh, d""")
def batch_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = _l3(spark, sf_dir)
    return customers.batch_overview(ledger, checks.balance_check(ledger, ["customer_id", "own_account"], by_file=False, examples=5), duplicates.shared_accounts(ledger), duplicates.cross_customer_fingerprints(ledger))


@query(f"""WITH {L2} SELECT 'opp_name' AS field, round(avg(CASE WHEN opp_name IS NULL THEN 0.0 ELSE 1.0 END), 3) AS coverage FROM l2
    UNION ALL SELECT 'balance', 0.0 UNION ALL SELECT 'memo', round(avg(CASE WHEN memo = '' THEN 0.0 ELSE 1.0 END), 3) FROM l2 UNION ALL SELECT 'expense', round(count(expense) / count(*), 3) FROM l2 UNION ALL SELECT 'absent', 0.0""")
def field_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.coverage(_l2(spark, sf_dir), ["opp_name", "balance", "memo", "expense", "absent"])


@query(f"""
    WITH {L1}, {_steps('l1', 'own_account', BY_FILE)}, checks AS ({_check('own_account', 8, BY_FILE)}),
    d AS (SELECT *, row_number() OVER (ORDER BY seq) AS k FROM l1 ORDER BY seq LIMIT 50),
    items AS (
        SELECT '余额断裂' AS kind, '中' AS priority, own_account AS subject, breaks || ' breaks' AS detail, example_ids AS evidence FROM checks WHERE status = '预警'
        UNION ALL SELECT '标签待复核', '低', txn_id, CASE WHEN income IS NULL THEN '其他支出' ELSE '其他收入' END, txn_id FROM d)
    SELECT *, printf('RV-%03d', row_number() OVER (ORDER BY kind, subject)) AS item_id FROM items""")
def review_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = _l1(spark, sf_dir)
    no_rules = rules.typed_rules(testdata.demo_rules(spark)).where("false")
    return reports.review_items(checks=checks.balance_check(ledger, ["own_account"]), duplicates=duplicates.duplicate_groups(ledger), tagged=tagging.tag(ledger, no_rules))
