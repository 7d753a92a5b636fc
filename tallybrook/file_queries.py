"""Registered queries of the file sources, the sinks and whole jobs: each writes files made of the driver's tables to the
shared folder, and reads them back through the library."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.operators import rules
from tallybrook.operators.standardize import standardize
from tallybrook.plans import pipelines, sinks
from tallybrook.plans.workbook_sink import write_workbooks
from tallybrook.queries import _CHECKS3, _DUP, _RULES, ACCOUNTS, BY_FILE, DAILY, L1, L2, ORACLE_SQL, QUERIES, _check, _steps, greedy, query
from tallybrook.schema import PUBLISHED
from tallybrook.sources import ledgers, testdata
from tallybrook.sources.grids import read_grids, read_sheets, scan_files, sheets_of, whole_files
from tallybrook.tables import new_path, numbered, write_table

__all__ = ["ORACLE_SQL", "QUERIES"]


def put(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file in the shared folder, through Spark's own file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(data))
    out.close()


# Raw files ----------------------------------------------------------------------------------------------------------
def statements(spark: SparkSession, sf_dir: str) -> str:
    """The raw grids of the events as a text file each, below folders n=0 to n=3."""
    grids = testdata.raw_grids(spark, sf_dir)
    quoted = F.transform("cells", lambda c: F.when(F.coalesce(c, F.lit("")).rlike('[,"]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.coalesce(c, F.lit(""))))
    line = F.concat(F.when(F.col("row_idx") < 0, "# ").otherwise(""), F.array_join(quoted, ","))
    path = new_path(spark, "statements")
    grids.select(F.substring("file", 2, 1).alias("n"), "row_idx", line.alias("value")).repartition("n").sortWithinPartitions("n", "row_idx").select("n", "value").write.partitionBy("n").text(path)
    return path


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger, _ = pipelines.standardize_files(spark, f"{statements(spark, sf_dir)}/n=*")
    return write_table(ledger, "files").withColumn("source_file", F.concat(F.lit("f"), F.regexp_extract("source_file", r"n=(\d)", 1), F.lit(".csv")))


#: The events ledger as read from files: rows count kept lines, load order goes by file and row.
FROM_FILES = f"""{L1},
    ff AS (SELECT * REPLACE (2 * row_number() OVER (PARTITION BY seq % 4 ORDER BY seq) + 1 AS source_row, '测试公司' || (seq % 4) AS own_name) FROM l1),
    fl AS (SELECT * REPLACE (row_number() OVER (ORDER BY source_file, source_row) AS seq, date_trunc('second', txn_time) AS txn_time) FROM ff)"""


@query(f"WITH {FROM_FILES} SELECT seq AS position, source_file, source_row, strftime(txn_time, '%Y-%m-%d %H:%M:%S') AS txn_time, own_name, own_account, opp_name, income, expense, balance, memo FROM fl")
def files_to_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files to transactions, in load order."""
    rows = ledgers.in_load_order([_files(spark, sf_dir)])
    return rows.select(F.col("seq").alias("position"), "source_file", "source_row", F.date_format("txn_time", "yyyy-MM-dd HH:mm:ss").alias("txn_time"), "own_name", "own_account", "opp_name", "income", "expense", "balance", "memo")


@contextmanager
def small_splits(spark: SparkSession, size: str = "64k") -> Iterator[None]:
    """Files are cut into many splits, as large ones are."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for n, v in zip(names, (size, "0")):
        spark.conf.set(n, v)
    try:
        yield
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)


#: Encodings of the files of encoded_statements().
CODES = ["utf-8-sig", "gb18030", "utf-16-le", "gbk"]


def _encoded(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines in the encoding of their file; the first line carries its mark, and none its end's first byte."""
    for pdf in pdfs:
        coded = [(b"\xff\xfe" if n == 2 and i < 0 else b"") + text.encode(CODES[n] if n or i < 0 else "utf-8") for n, i, text in zip(pdf["n"], pdf["row_idx"], pdf["value"])]
        yield pdf[["n", "row_idx"]].assign(value=coded)


def encoded_statements(spark: SparkSession, sf_dir: str) -> str:
    """The raw grids of the events as a text file of another encoding each, below folders n=0 to n=3. Among the rows stand
    comments, blank lines, and page totals with a quoted cell over several lines."""
    grids = testdata.raw_grids(spark, sf_dir)
    cells = F.transform("cells", lambda c: F.when(F.coalesce(c, F.lit("")).rlike(","), F.concat(F.lit('"'), c, F.lit('"'))).otherwise(F.coalesce(c, F.lit(""))))
    total = F.lit('\n# 备注，一\n\n"本页小计\n# 不是单元格\n二行","x ""y""",1')
    line = F.concat(F.when(F.col("row_idx") < 0, "# ").otherwise(""), F.array_join(cells, ","), F.when((F.col("row_idx") > 2) & (F.col("row_idx") % 7 == 0), total).otherwise(""))
    rows = grids.select(F.substring("file", 2, 1).cast("int").alias("n"), "row_idx", line.alias("value"))
    path = new_path(spark, "encoded")
    # the bytes go through the text writer as they are; a line end is a character of its own in UTF-16
    raw = rows.repartition("n").sortWithinPartitions("n", "row_idx").mapInPandas(_encoded, "n int, row_idx long, value binary").select("n", F.col("value").cast("string").alias("value"))
    for n in range(len(CODES)):
        raw.where(F.col("n") == n).select("value").write.option("lineSep", "\n\0" if n == 2 else "\n").text(f"{path}/n={n}")
    return path


@query(f"""
    WITH {L1}, ff AS (SELECT * REPLACE ('测试公司' || (seq % 4) AS own_name), 2 * row_number() OVER (PARTITION BY seq % 4 ORDER BY seq) + 2 AS i FROM l1)
    SELECT source_file, i - 1 + (i - 1) // 7 AS source_row, strftime(txn_time, '%Y-%m-%d %H:%M:%S') AS txn_time, own_name, own_account, opp_name, income, expense, balance, memo FROM ff""")
def files_of_any_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files in UTF-8 with a mark, GBK, UTF-16 and GB18030, read in many splits."""
    path = encoded_statements(spark, sf_dir)
    with small_splits(spark):
        grids, outcomes = scan_files(spark, f"{path}/n=*")
    ledger, _ = standardize(grids, outcomes=outcomes)
    name = F.concat(F.lit("f"), F.regexp_extract("source_file", r"n=(\d)", 1), F.lit(".csv"))
    return ledger.select(name.alias("source_file"), "source_row", F.date_format("txn_time", "yyyy-MM-dd HH:mm:ss").alias("txn_time"), "own_name", "own_account", "opp_name", "income", "expense", "balance", "memo")


@query(f"""
    WITH {L1}, k AS (SELECT 2 * row_number() OVER (PARTITION BY seq % 4 ORDER BY seq) + 3 AS i, seq % 4 AS n FROM l1)
    SELECT 'n=' || n AS name, 'read' AS status, NULL::VARCHAR AS reason, 2 * count(*) - count(*) FILTER (WHERE i % 5 <> 0 AND i % 3 = 0) AS rows FROM k GROUP BY n
    UNION ALL SELECT 'nations.txt', 'no header', 'no cell of the first rows names a field', 0 UNION ALL SELECT 'broken.xlsx', 'unreadable', 'BadZipFile: File is not a zip file', 0
    UNION ALL SELECT 'long.csv', 'unreadable', 'field larger than field limit (131072)', 0 UNION ALL SELECT 'letter.docx', 'unknown type', 'no reader for files of type .docx', 0""")
def file_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a folder, and a file that is named itself: what became of each file. Those that can't be read stop no other."""
    path = statements(spark, sf_dir)
    others = new_path(spark, "others")
    nations = "\n".join(f"{r['n_nationkey']},{r['n_name']}" for r in testdata.table(spark, sf_dir, "nation").collect())  # a table of 25 rows
    for name, data in (("nations.txt", nations.encode()), ("broken.xlsx", b"no zip"), ("long.csv", b"a,b\n" + b"x" * 200_000), ("letter.docx", b"x"), ("ignored.md", b"x")):
        put(spark, f"{others}/{name}", data)
    ledger, report = pipelines.standardize_files(spark, f"{path}/n=*", others, f"{others}/letter.docx")
    name = F.regexp_extract("file", r"(n=\d|[^/]*$)", 1)
    return report.select(name.alias("name"), "status", "reason", F.col("rows").cast("long").alias("rows"))


@query(f"""
    WITH RECURSIVE {FROM_FILES}, {greedy('fl')}
    SELECT printf('INT-%04d', nth) AS transfer_id, o.source_file AS out_file, o.source_row AS out_row, i.source_file AS in_file, i.source_row AS in_row, size
    FROM pairs JOIN fl o ON o.seq = out_seq JOIN fl i ON i.seq = in_seq""")
def files_to_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files through integrate() to transfers, which depend on load order."""
    rows = _files(spark, sf_dir)
    found = pipelines.integrate(rows)["transfers"]
    places = rows.select("seq", "source_file", "source_row")
    legs = [places.select(F.col("seq").alias(f"{s}_seq"), F.col("source_file").alias(f"{s}_file"), F.col("source_row").alias(f"{s}_row")) for s in ("out", "in")]
    return found.join(legs[0], "out_seq").join(legs[1], "in_seq").select("transfer_id", "out_file", "out_row", "in_file", "in_row", "size")


@query(f"""
    WITH {FROM_FILES}, {_steps('fl', 'own_account', BY_FILE)}, checks AS ({_check('own_account', 8, BY_FILE)}),
    b AS (SELECT count(*) AS accounts, sum(rows)::BIGINT AS rows, sum(breaks)::BIGINT AS breaks FROM checks),
    d AS (SELECT count(*) AS duplicate_groups FROM (SELECT 1 FROM fl GROUP BY {_DUP} HAVING count(*) >= 2)),
    m AS (SELECT (count(*) FILTER (WHERE opp_name IS NULL) > 0.3 * count(*))::INT AS issues FROM fl)
    SELECT accounts, rows, breaks, duplicate_groups, greatest(0, 100 - least(30, breaks // 5) - least(20, duplicate_groups) - 10 * issues)::INT AS score FROM b, d, m""")
def files_integrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sections of integrate() on text files, in one row."""
    out = pipelines.integrate(_files(spark, sf_dir))
    totals = out["balance_check"].agg(F.count("*").alias("accounts"), F.sum("rows").alias("rows"))
    return totals.crossJoin(out["quality"]).select("accounts", "rows", "breaks", "duplicate_groups", "score")  # single rows


@query("SELECT row_number() OVER (ORDER BY n_nationkey) - 1 AS row_idx, n_nationkey::VARCHAR || '|' || n_name || '|' || n_regionkey AS cells FROM nation")
def excel_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nations from the second sheet of a workbook, as the first is empty."""
    rows = [[str(x) for x in r] for r in testdata.table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey").orderBy("n_nationkey").collect()]  # a table of 25 rows
    path = f"{new_path(spark, 'excel')}/nations.xlsx"
    put(spark, path, testdata.workbook({"empty": [], "nations": rows}))
    return read_grids(spark, path).where("row_idx >= 0").select("row_idx", F.array_join("cells", "|").alias("cells"))


def _book(pdf: pd.DataFrame) -> pd.DataFrame:
    """A workbook of the events of a block, each cell of another type."""
    rows = [["No.", "when", "day", "clock", "amount", "whole", "income", "none", "label"]]
    for r in pdf.sort_values("event_id").to_dict("records"):
        day = r["seconds"] // 86_400 + 25_569
        cents = int(r["cents"])
        rows.append([("number", int(r["event_id"])), ("moment", day + r["seconds"] % 86_400 / 86_400), ("han", day), ("clock", r["seconds"] % 86_400 / 86_400), ("money", cents / 100), ("number", float(cents)), bool(r["inc"]), ("error", "#N/A"), f" {r['event_type']} & <x> " if r["event_id"] % 2 else "N/A"])
    return pd.DataFrame({"file": [f"b{pdf['block'].iloc[0]}.xlsx"], "content": [testdata.workbook({"cover": [["only a title"]], "data": rows})]})


@query("""
    WITH e AS (SELECT *, event_id // 1000 AS block, floor(value * 100 + 0.5)::BIGINT AS cents, date_trunc('second', ts) AS t FROM events)
    SELECT 'b' || block || '.xlsx' AS file, row_number() OVER (PARTITION BY block ORDER BY event_id) AS row_idx, event_id::VARCHAR || '|' || strftime(t, '%Y-%m-%d %H:%M:%S') || '|' || strftime(t, '%Y-%m-%d 00:00:00') || '|' || strftime(t, '%H:%M:%S')
           || '|' || CASE WHEN cents % 100 = 0 THEN (cents // 100)::VARCHAR ELSE (cents::DOUBLE / 100)::VARCHAR END || '|' || cents || '|' || CASE WHEN event_type IN ('purchase', 'signup') THEN 'True' ELSE 'False' END
           || '|?|' || CASE WHEN event_id % 2 = 1 THEN ' ' || event_type || ' & <x> ' ELSE '?' END AS cells
    FROM e""")
def typed_workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that are dates, times, amounts, truth values and errors by their style and type, in a workbook for each
    thousand events."""
    e = testdata.table(spark, sf_dir, "events").select("event_id", "event_type", F.floor(F.col("event_id") / 1000).alias("block"), F.floor(F.col("value") * 100 + 0.5).alias("cents"), F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01', ts)").alias("seconds"), F.col("event_type").isin("purchase", "signup").alias("inc"))
    files = e.groupBy("block").applyInPandas(_book, "file string, content binary")
    return whole_files(files).where("record > 0").select("file", F.col("record").alias("row_idx"), F.array_join("cells", "|", "?").alias("cells"))


@query("SELECT row_number() OVER (ORDER BY r_regionkey) AS row_idx, r_regionkey::VARCHAR || '|' || r_name AS cells FROM region UNION ALL SELECT 0, 'key|name'")
def pdf_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per region, each with the header again, through an extractor of the caller's."""
    rows = testdata.table(spark, sf_dir, "region").orderBy("r_regionkey").collect()  # a table of 5 rows
    pages = [[["key", "name"], [f"{r['r_regionkey']}\n", f" {r['r_name']} "], ["", None]] for r in rows]
    path = f"{new_path(spark, 'pdf')}/regions.pdf"
    put(spark, path, json.dumps(pages).encode())
    return read_grids(spark, path, extractors={".pdf": json.loads}).where("row_idx >= 0").select("row_idx", F.array_join("cells", "|").alias("cells"))


#: The most rows of a bare statement.
BARE_ROWS = 250_000


def bare_statements(spark: SparkSession, sf_dir: str, most: int = BARE_ROWS) -> str:
    """The events as statements without account, counterparty and balance, below folders n=0 on; the first also holds lines
    with a memo only. However many rows there are, a statement has at most so many, and no task holds all of them."""
    n = F.floor(F.col("seq") / most)
    rows = testdata.events_ledger(spark, sf_dir).select(F.date_format("txn_time", "yyyy-MM-dd HH:mm:ss").alias("交易时间"), F.format_string("%.2f", "amount").alias("交易金额"), F.col("memo").alias("摘要"), n.alias("n"), F.col("seq").alias("at"))
    top = spark.createDataFrame([(None, None, "nothing but a memo", 0, -2), (None, None, "another", 0, -1)], "`交易时间` string, `交易金额` string, `摘要` string, n long, at long")
    path = new_path(spark, "bare")
    sinks.write_csv(top.unionByName(rows).repartition("n").sortWithinPartitions("n", "at").drop("at"), path, names=False, mark=False, partition="n")
    return path


@query(f"""
    WITH {L1} SELECT '未识别账户#bare' AS own_account, '对手名称,账户余额,账户类型' AS review, count(*) AS rows, 2::BIGINT AS lines_without_data FROM l1""")
def bare_statement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements without account, counterparty and balance, and lines that hold a memo only."""
    grids = read_grids(spark, f"{bare_statements(spark, sf_dir)}/n=*").withColumn("file", F.concat(F.lit("x/"), F.regexp_extract("file", r"n=(\d+)", 1), F.lit("/bare.txt")))
    ledger, report = standardize(grids)
    lines = grids.where("row_idx > 0").agg(F.count("*").alias("lines"))
    found = ledger.groupBy("own_account").agg(F.count("*").alias("rows"))
    reviews = report.select(F.array_join("review", ",").alias("review")).distinct()
    return found.crossJoin(reviews).crossJoin(lines).select("own_account", "review", "rows", (F.col("lines") - F.col("rows")).alias("lines_without_data"))  # single rows


# Ledgers and rules --------------------------------------------------------------------------------------------------
def _csv_ledgers(spark: SparkSession, sf_dir: str) -> str:
    """The events ledger as four standardised CSV ledgers in a folder, next to another file."""
    rows, path = write_table(testdata.events_ledger(spark, sf_dir), "l1"), new_path(spark, "ledgers")
    for k in range(4):
        sinks.write_csv(rows.where(F.col("seq") % 4 == k).repartition(1).sortWithinPartitions(F.desc("seq")).drop("time_text", "seq"), f"{path}/f{k}__standardized.csv")
    put(spark, f"{path}/notes.csv", b"a,b\n1,2\n")
    return path


@query(f"""
    WITH {L1} SELECT row_number() OVER (ORDER BY seq % 4, seq DESC) AS seq, txn_id, strftime(txn_time, '%Y-%m-%d %H:%M:%S') AS txn_time, own_account, opp_name, income, expense, amount, balance, source_file, source_row,
        row_number() OVER (ORDER BY own_account, date_trunc('second', txn_time), source_file, source_row) AS position FROM l1""")
def csv_ledgers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardised ledgers written as CSV and read back: values, load order, and the order of integration."""
    rows = ledgers.read_csv_ledgers(spark, _csv_ledgers(spark, sf_dir))
    rows = numbered(rows, ledgers.integrated_order(), "position")
    return rows.select("seq", "txn_id", F.date_format("txn_time", "yyyy-MM-dd HH:mm:ss").alias("txn_time"), "own_account", "opp_name", "income", "expense", "amount", "balance", "source_file", "source_row", "position")


@query(f"""
    WITH {L1} SELECT row_number() OVER (ORDER BY seq % 50, seq) AS seq, txn_id, strftime(txn_time, '%Y-%m-%d %H:%M:%S') AS txn_time, own_account, income, expense, balance, memo || chr(10) || '"a", b' || chr(13) || chr(10) || ' # c ' AS memo,
           CASE WHEN (seq % 50) % 3 = 1 THEN NULL ELSE '' || opp_name END AS opp_name, CASE WHEN (seq % 50) % 3 = 2 THEN 'C' || (seq % 50) END AS customer_id FROM l1""")
def csv_ledgers_of_any_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty ledgers with marks, of three sets of columns in other orders, whose memos hold quotes, commas and line breaks:
    written, read back in many splits as one scan."""
    rows, path = write_table(testdata.events_ledger(spark, sf_dir), "l1"), new_path(spark, "texts")
    rows = rows.withColumns({"memo": F.concat("memo", F.lit('\n"a", b\r\n # c ')), "k": (F.col("seq") % 50).cast("int")})
    columns = ["txn_id", "txn_time", "own_account", "income", "expense", "balance", "memo", "opp_name"]
    kinds = [columns, ["memo", *columns[:6]], ["customer_id", *reversed(columns)]]
    shown = rows.withColumns({"customer_id": F.concat(F.lit("C"), F.col("k")), "f": F.format_string("k%02d__standardized.csv", "k")}).repartition("f").sortWithinPartitions("f", "seq")
    for n, kind in enumerate(kinds):
        sinks.write_csv(shown.where(F.col("k") % 3 == n).select(*kind, "f"), f"{path}-{n}", partition="f")
    found = [f for n in range(3) for f in ledgers.listed(spark, f"{path}-{n}", "f=*")]
    with small_splits(spark):
        back = ledgers.read_csv_ledgers(spark, *sorted(found, key=lambda f: f.rpartition("/")[2]))
    return back.select("seq", "txn_id", F.date_format("txn_time", "yyyy-MM-dd HH:mm:ss").alias("txn_time"), "own_account", "income", "expense", "balance", "memo", "opp_name", "customer_id")


@query(f"WITH {L1} SELECT 'a__整合流水.csv' AS name, count(*) AS rows FROM l1")
def best_artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a folder's artifacts, the integrated ledger comes before the standardised ones."""
    folder = _csv_ledgers(spark, sf_dir)
    for name in ("b__整合流水.csv", "a__整合流水.csv"):
        sinks.write_csv(testdata.events_ledger(spark, sf_dir), f"{folder}/{name}")
    best = ledgers.best_artifact(spark, folder)
    return ledgers.read_csv_ledgers(spark, best).groupBy(F.lit(best.rpartition("/")[2]).alias("name")).agg(F.count("*").alias("rows"))


@query(f"WITH {_RULES.split('x AS (')[0].rstrip().rstrip(',')}, own AS (SELECT r.* REPLACE (rule_id || '-' || s_suppkey AS rule_id) FROM rules r JOIN supplier ON right(rule_id, 1)::INT = s_suppkey % 8 + 1) SELECT rule_id, dir AS direction, scope, keyword, excludes, opp_any, l1_ AS label_1, l2_ AS label_2, l3_ AS label_3, priority::DOUBLE AS priority, row_number() OVER (ORDER BY length(rule_id), rule_id) AS rule_seq FROM own")
def rule_table_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule for each supplier under the published column names, written and read back; the scope under its older name."""
    names = {"rule_id": "规则编号", "direction": "适用方向", "scope": "适用字段", "keyword": "关键词", "excludes": "排除关键词", "opp_any": "对手名称含", "label_1": "一级标签", "label_2": "二级标签", "label_3": "三级标签", "priority": "优先级"}
    path = new_path(spark, "rules")
    suppliers = testdata.table(spark, sf_dir, "supplier").select("s_suppkey", F.format_string("R%04d", F.col("s_suppkey") % 8 + 1).alias("rule_id"))
    own = suppliers.join(testdata.demo_rules(spark), "rule_id").withColumn("rule_id", F.concat_ws("-", "rule_id", "s_suppkey"))
    own.select(*(F.col(c).alias(n) for c, n in names.items())).write.option("header", True).csv(path)
    typed = rules.typed_rules(ledgers.read_rule_csv(spark, path))
    joined = {c: F.array_join(c, "|") for c in ("excludes", "opp_any")}
    return typed.withColumns(joined).withColumn("direction", F.when(F.col("direction") == "other", "通用").otherwise(F.col("direction")))


def _rule_book(pdf: pd.DataFrame) -> pd.DataFrame:
    """A rule workbook of a block of the lexicon; the first has the labels too."""
    block, text = int(pdf["block"].iloc[0]), lambda v: None if v is None else str(v)
    labels = [["L1", "L2", "L3", *"abcdef", "in", "out"], *([r[1], r[2], r[3], *[None] * 6, r[4], r[5]] for r in (testdata.DIMENSION if block == 0 else []))]
    words = [["FlowField", "Operator", "Keyword", "Tags_Income", "Tags_Expenditure", "ut"]]
    words += [[text(r["flow_field"]), "包含", text(r["keyword"]), text(r["income_label"]), text(r["expense_label"]), None] for r in pdf.sort_values("row").to_dict("records")]
    return pd.DataFrame({"file": [f"rules{block:09d}.xlsx"], "content": [testdata.workbook({"notes": [["x"]], rules.DIMENSION_SHEET: labels, rules.LEXICON_SHEET: words})]})


@query(ORACLE_SQL["compile_rules"])
def rule_workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules that compile_rules gives from tables, from workbooks of a thousand keywords each, by their sheets' names."""
    files = testdata.lexicon(spark, sf_dir).withColumn("block", F.floor(F.col("row") / 1000)).groupBy("block").applyInPandas(_rule_book, "file string, content binary")
    labels, words = rules.of_workbook(write_table(sheets_of(files), "sheets"))
    return rules.compile_rules(rules.label_dimension(labels), words)


@query("""
    WITH p AS (SELECT p_partkey AS k, p_name FROM part)
    SELECT 'R' || k AS rule_id, CASE k % 3 WHEN 0 THEN '收入' WHEN 1 THEN '支出' ELSE '其他' END AS direction, CASE WHEN k % 2 = 0 THEN '银行备注' ELSE '通用' END AS scope, p_name || ', "' || k || '"' AS keyword,
           CASE WHEN k % 4 = 0 THEN 'small|old' ELSE '' END AS excludes, CASE WHEN k % 5 = 0 THEN '1|2' ELSE '' END AS opp_any, p_name AS label_1, 'b' AS label_2, 'c' AS label_3,
           CASE WHEN k % 7 < 2 THEN 500 ELSE k END::DOUBLE AS priority, row_number() OVER (ORDER BY length('R' || k), 'R' || k) AS rule_seq
    FROM p""")
def rule_table_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule for each part, under the published column names, written with a mark and read back: lists, bad and missing
    priorities, the scope under its older name."""
    p, k = testdata.table(spark, sf_dir, "part"), F.col("p_partkey")
    table = p.select(
        F.concat(F.lit("R"), k).alias("规则编号"), F.when(k % 3 == 0, "收入").when(k % 3 == 1, "支出").otherwise("其他").alias("适用方向"), F.when(k % 2 == 0, "银行备注").otherwise("通用").alias("适用字段"),
        F.concat("p_name", F.lit(', "'), k, F.lit('"')).alias("关键词"), F.when(k % 4 == 0, "small|old").alias("排除关键词"), F.when(k % 5 == 0, "1||2").alias("对手名称含"), F.col("p_name").alias("一级标签"), F.lit("b").alias("二级标签"), F.lit("c").alias("三级标签"),
        F.when(k % 7 == 0, "bad").when(k % 7 > 1, k.cast("string")).alias("优先级"),
    )
    path = new_path(spark, "rules")
    sinks.write_csv(table, path, names=False)
    typed = rules.typed_rules(ledgers.read_rule_csv(spark, path))
    return typed.withColumns({c: F.array_join(c, "|") for c in ("excludes", "opp_any")})


@query(f"""
    WITH {L1}, c AS (SELECT 'C001' AS customer_id, 'first' AS customer_name, * FROM l1 WHERE seq % 3 = 0 UNION ALL SELECT 'X9', 'second', * FROM l1 WHERE seq % 3 = 1 UNION ALL SELECT 'C003', 'third', * FROM l1 WHERE seq % 3 = 2)
    SELECT customer_id, customer_name, txn_id, row_number() OVER (ORDER BY customer_name, seq) AS seq FROM c""")
def customer_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = testdata.events_ledger(spark, sf_dir)
    part = lambda k: rows.where(F.col("seq") % 3 == k)
    whole, _ = ledgers.customers([("first", part(0)), ("second", part(1), "X9"), ("third", part(2))])
    return whole.select("customer_id", "customer_name", "txn_id", "seq")


# Sinks --------------------------------------------------------------------------------------------------------------
@query(ORACLE_SQL["account_index"])
def json_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account index as a section of a JSON report, read back."""
    index, path = pipelines.portfolio.account_index(testdata.events_ledger(spark, sf_dir)), new_path(spark, "report")
    sinks.write_report({"account index": index}, path)
    return spark.read.schema(index.schema).json(f"{path}/{sinks.safe_name('account index')}")


@query(f"""
    WITH {L1}, {DAILY} SELECT day, round(max(balance) FILTER (WHERE acct = 'A3'), 2) AS "A3", round(max(balance) FILTER (WHERE acct = 'A7'), 2) AS "A7", round(sum(balance), 2) AS total FROM daily GROUP BY day""")
def daily_panel_of_some(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily panel of two accounts; the total is that of all."""
    path = new_path(spark, "panel")
    sinks.write_panel(testdata.events_ledger(spark, sf_dir), path, ["A3", "A7"])
    return spark.read.option("header", True).schema("day date, A3 double, A7 double, total double").csv(path)


@query(ORACLE_SQL["daily_balance_wide_all"])
def daily_panel_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily panel as CSV, read back."""
    path = new_path(spark, "panel")
    sinks.write_panel(testdata.events_ledger(spark, sf_dir), path, ACCOUNTS)
    return spark.read.option("header", True).schema(", ".join(["day date", *(f"`{a}` double" for a in ACCOUNTS), "total double"])).csv(path)


# Whole jobs ---------------------------------------------------------------------------------------------------------
@query(f"""
    WITH {L2}, {_RULES}, d AS (SELECT *, balance AS b, 0.0::DOUBLE AS delta FROM tagged)
    SELECT 'client' AS customer_name, own_account AS subject_name, txn_id, direction, label_1, label_2, label_3, rule_id, 0.0::DOUBLE AS virtual_balance FROM d""")
def deliverable_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main sheet of the deliverable over the order ledger, whose accounts are their own subjects and have no balances."""
    ledger = testdata.orders_ledger(spark, sf_dir).withColumn("own_name", F.col("own_account"))
    main = pipelines.deliverable("client", [("a", ledger.where("seq % 2 = 0")), ("b", ledger.where("seq % 2 = 1"))], testdata.demo_rules(spark))["整合打标流水"]
    names = ["customer_name", "subject_name", "txn_id", "direction", "label_1", "label_2", "label_3", "rule_id", "virtual_balance"]
    return main.select(*(F.col(PUBLISHED[n]).alias(n) for n in names))


@query(f"""
    WITH {L1}, d AS (SELECT *, balance - coalesce(lag(balance) OVER (PARTITION BY own_account ORDER BY txn_time, source_row), 0) AS delta FROM l1),
    v AS (SELECT *, round(sum(delta) OVER (ORDER BY txn_time, own_account, source_row ROWS UNBOUNDED PRECEDING), 2) + 0.0 AS virtual FROM d),
    p AS (SELECT *, row_number() OVER (ORDER BY own_account, txn_time, source_file, source_row) - 1 AS k FROM v)
    SELECT k // 3000 + 1 AS book, k % 3000 + 1 AS row_idx, txn_id, strftime(txn_time, '%Y-%m-%d %H:%M:%S') AS txn_time, own_account, income, expense, balance, virtual AS virtual_balance, source_row FROM p""")
def deliverable_workbook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deliverable as workbooks of 3000 rows a sheet, written by tasks and read back: its main sheet, by workbook."""
    sheets = pipelines.deliverable("client", [("a", testdata.events_ledger(spark, sf_dir))], testdata.demo_rules(spark))
    folder = new_path(spark, "deliverable")
    write_workbooks(sheets, folder, sheet_rows=3000)
    rows = read_sheets(spark, folder, sheet="整合打标流水").where("row_idx > 0")
    at = {n: F.get("cells", F.lit(k)) for k, n in enumerate(sheets["整合打标流水"].columns)}
    number = lambda n: at[PUBLISHED[n]].cast("double").alias(n)
    return rows.select(
        F.regexp_extract("file", r"(\d+)\.xlsx$", 1).cast("long").alias("book"), "row_idx", at[PUBLISHED["txn_id"]].alias("txn_id"), at[PUBLISHED["txn_time"]].alias("txn_time"), at[PUBLISHED["own_account"]].alias("own_account"),
        number("income"), number("expense"), number("balance"), (at[PUBLISHED["virtual_balance"]].cast("double") + 0.0).alias("virtual_balance"), at[PUBLISHED["source_row"]].cast("long").alias("source_row"),
    )


@query(f"""
    WITH {FROM_FILES}, s AS (SELECT *, CASE source_file WHEN 'f0.csv' THEN '甲' ELSE '乙/丙' END AS subject FROM fl WHERE source_file IN ('f0.csv', 'f1.csv'))
    SELECT subject AS subject_name, own_account, count(*) AS rows, round(sum(coalesce(income, 0)), 2) AS income, round(sum(coalesce(expense, 0)), 2) AS expense FROM s GROUP BY ALL""")
def deliverable_of_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two subjects' folders of text files to workbooks, read back: rows and amounts by subject and account."""
    path = statements(spark, sf_dir)
    sheets, _ = pipelines.deliverable_of_files(spark, "客户: x", [f"甲:{path}/n=0:对公", f"乙/丙:{path}/n=1"], testdata.demo_rules(spark))
    books = pipelines.write_deliverable("客户: x", sheets, new_path(spark, "out"))
    at = {n: F.get("cells", F.lit(sheets["整合打标流水"].columns.index(PUBLISHED[n]))) for n in ("subject_name", "own_account", "income", "expense")}
    rows = read_sheets(spark, *books, sheet="整合打标流水").where("row_idx > 0").select(*(c.alias(n) for n, c in at.items()))
    total = lambda n: F.bround(F.sum(F.coalesce(F.col(n).cast("double"), F.lit(0.0))), 2).alias(n)
    return rows.groupBy("subject_name", "own_account").agg(F.count("*").alias("rows"), total("income"), total("expense"))


@query(f"""
    WITH {L1}, {DAILY} SELECT day, acct, round(balance, 2) AS balance, total FROM daily JOIN total USING (day)""")
def deliverable_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily sheet of the deliverable, an account a row."""
    return pipelines.deliverable("client", [("a", testdata.events_ledger(spark, sf_dir))], testdata.demo_rules(spark))["组合日余额"]


@query(f"""
    WITH {_CHECKS3},
    shared AS (SELECT own_account FROM l3 GROUP BY own_account HAVING count(DISTINCT customer_id) > 1),
    again AS (SELECT 1 FROM l3 GROUP BY txn_time, income, expense, balance, opp_name HAVING count(DISTINCT customer_id) > 1)
    SELECT '余额断裂' AS kind, '中' AS priority, count(*) AS items FROM checks WHERE status = '预警'
    UNION ALL SELECT '共用账户', '高', count(*) FROM shared UNION ALL SELECT '重复提交', '中', count(*) FROM again""")
def customers_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What several_customers() lists for review, by kind."""
    rows = write_table(testdata.customers_ledger(spark, sf_dir), "l3")
    specs = [(c, rows.where(F.col("customer_id") == c).drop("customer_id"), c) for c in ("C0", "C1", "C2", "C9")]
    return pipelines.several_customers(specs)["review"].groupBy("kind", "priority").agg(F.count("*").alias("items"))


@query(f"""
    WITH {L2}, {_RULES}, n AS (SELECT count(*) AS rows, count(rule_id) AS hits FROM tagged)
    SELECT rows, hits, round(hits / rows, 3) AS hit_rate, (SELECT count(*) FROM (SELECT 1 FROM tagged GROUP BY label_1, label_2, label_3)) AS label_sets FROM n""")
def tag_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tag_report() over the order ledger: the hit rate and how many sets of labels it gives."""
    out = pipelines.tag_report(testdata.orders_ledger(spark, sf_dir), testdata.demo_rules(spark))
    return out["hit_rate"].select("rows", "hits", "hit_rate").crossJoin(out["ledger"].select("label_1", "label_2", "label_3").distinct().agg(F.count("*").alias("label_sets")))  # single rows


@query(f"""
    WITH {FROM_FILES}, {DAILY.replace('FROM l1', 'FROM fl')}
    SELECT count(*) AS days, (SELECT count(*) FROM fl) AS rows, (SELECT count(DISTINCT own_account) FROM fl) AS accounts, max_by(total, day) AS closing,
           (SELECT count(*) FROM fl WHERE expense > 0) AS outgoing, (SELECT count(*) FROM fl WHERE contains(memo, 'ic')) AS hits FROM total""")
def one_customer_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one_customer() from a folder of text files: a figure of each of its reports."""
    rule = testdata.demo_rules(spark).limit(1).withColumns({"direction": F.lit("通用"), "keyword": F.lit("ic"), "excludes": F.lit("")})
    out = pipelines.one_customer(spark, "Z", f"{statements(spark, sf_dir)}/n=*", rule)
    whole = out["integrated"]["overview"].select("rows", "accounts")
    days = out["portfolio"]["summary"].select("days", "closing")
    tagged = out["tags"]["ledger"].agg(F.count_if(F.col("direction") == "支出").alias("outgoing"), F.count("rule_id").alias("hits"))
    return days.crossJoin(whole).crossJoin(tagged)  # single rows
