"""Sequential operators against plain loops on random ledgers, and fixtures of the balance check and of files."""

import random
import zipfile
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallybrook import file_queries, tables
from tallybrook.operators import checks, duplicates, portfolio, reports, tagging, transfers
from tallybrook.plans import pipelines
from tallybrook.schema import LEDGER
from tallybrook.sources import ledgers, testdata
from tallybrook.tables import numbered


def ledger(spark, rows):
    """rows: dicts of canonical columns."""
    return spark.createDataFrame([tuple({"seq": i, "txn_id": f"T{i}", "source_row": i, "source_file": "f"} .get(f.name) if f.name not in r else r[f.name] for f in LEDGER) for i, r in enumerate(rows)], LEDGER)


def random_rows(seed, n=120, hours=400):
    rng, start = random.Random(seed), datetime(2024, 1, 1)
    rows = []
    for _ in range(n):
        size, income = rng.randint(1, 12) / 100 + rng.choice([0, 100]), rng.random() < 0.5
        rows.append({
            "txn_time": None if rng.random() < 0.05 else start + timedelta(hours=rng.randint(0, hours)), "own_account": f"A{rng.randint(0, 3)}", "own_name": f"N{rng.randint(0, 3)}", "opp_name": f"N{rng.randint(0, 8)}",
            "income": size if income else None, "expense": None if income else size, "balance": None if rng.random() < 0.2 else rng.randint(0, 10**5) / 100,
        })
    return rows


def plain_transfers(rows):
    """Pairs of places in the list, which is in load order."""
    used, want = set(), []
    for i, a in enumerate(rows):
        if not a["expense"]:
            continue
        for j, b in enumerate(rows):
            if b["income"] and j not in used and a["own_account"] != b["own_account"] and abs(a["expense"] - b["income"]) < 0.01:
                if a["txn_time"] is None or b["txn_time"] is not None and abs(a["txn_time"] - b["txn_time"]) <= timedelta(days=3):
                    used.add(j)
                    want.append((i, j))
                    break
    return want


@pytest.mark.parametrize(("seed", "long_run"), [(0, 20_000), (1, 0), (2, 5)])
def test_transfers_match_a_plain_loop(spark, seed, long_run):
    """Run by run, and by slots of time."""
    rows = random_rows(seed)
    want = plain_transfers(rows)
    got = transfers.self_transfers(ledger(spark, rows), long_run=long_run).orderBy("out_seq").collect()
    assert [(r["out_seq"], r["in_seq"]) for r in got] == want
    assert [r["transfer_id"] for r in got] == [f"INT-{k + 1:04d}" for k in range(len(want))]


@pytest.mark.parametrize(("seed", "few", "hours"), [(0, 50_000, 400), (1, 0, 400), (2, 0, 20)])
def test_virtual_balance_matches_a_plain_loop(spark, monkeypatch, seed, few, hours):
    """In one range and in several; the last with all rows on a single day."""
    monkeypatch.setattr(tables, "FEW_ROWS", few)
    rows = random_rows(seed, hours=hours)
    assert tables.in_ranges(ledger(spark, rows), [F.col("txn_time"), F.col("seq")]).select("__part").distinct().count() == (1 if few else 4)
    order = sorted(range(len(rows)), key=lambda i: (rows[i]["txn_time"] or datetime(9999, 12, 31), rows[i]["own_account"], i))
    latest, want = {}, {}
    for i in order:
        if rows[i]["balance"] is not None:
            latest[rows[i]["own_account"]] = rows[i]["balance"]
        want[i] = round(sum(latest.values()), 2)
    got = {r["seq"]: r["virtual_balance"] for r in portfolio.virtual_balance(ledger(spark, rows)).collect()}
    assert got == pytest.approx(want, abs=0.011)


@pytest.mark.parametrize("seed", range(3))
def test_balance_check_matches_a_plain_loop(spark, seed):
    rows = random_rows(seed)
    want = {}
    for account in {r["own_account"] for r in rows}:
        own = sorted((i for i, r in enumerate(rows) if r["own_account"] == account), key=lambda i: (rows[i]["txn_time"] or datetime(9999, 12, 31), i))
        breaks = [b for a, b in zip(own, own[1:]) if None not in (rows[a]["balance"], rows[b]["balance"]) and abs(rows[b]["balance"] - (rows[a]["balance"] + (rows[b]["income"] or 0) - (rows[b]["expense"] or 0))) >= 0.01]
        want[account] = (len(breaks), ",".join(f"T{i}" for i in breaks[:8]))
    got = {r["own_account"]: (r["breaks"], r["example_ids"]) for r in checks.balance_check(ledger(spark, rows), ["own_account"]).collect()}
    assert got == want


def series(*balances):
    day = datetime(2024, 1, 1)
    return [{"txn_time": day + timedelta(days=i), "own_account": "A", "balance": b, "income": 0.0} for i, b in enumerate(balances)]


@pytest.mark.parametrize(("balances", "breaks", "status"), [((1.0, 1.0, 1.0), 0, "通过"), ((1.0, 2.0, 1.0), 2, "预警"), ((1.0, None, 5.0), 0, "通过"), ((1.0,), 0, "未校验"), ((100.01, 100.02), 0, "通过")])
def test_balance_fixtures(spark, balances, breaks, status):
    row = checks.balance_check(ledger(spark, series(*balances)), ["own_account"]).first()
    assert (row["breaks"], row["status"]) == (breaks, status)


def test_both_ways_of_matching_rules_agree(spark, sf_dir):
    rules = pipelines.rules.typed_rules(testdata.demo_rules(spark))
    rows = testdata.orders_ledger(spark, sf_dir)
    columns = ["direction", "opp_name", "memo", "note"]
    texts = rows.select(F.lit("收入").alias("direction"), *(F.coalesce(c, F.lit("")).alias(c) for c in columns[1:])).distinct()
    few, many = (sorted(map(str, tagging.match_rules(texts, rules, few_rules=k).select(*columns, "rule", "hit_field").collect())) for k in (500, 0))
    assert few == many and few


@pytest.mark.parametrize("keyword", ["", "ring"])
def test_empty_keywords_stand_in_every_text_either_way(spark, keyword):
    rule = spark.createDataFrame([("R1", "other", "银行备注", keyword, [], [], "a", "b", "c", 1.0, 1), ("R2", "other", "银行备注", None, [], [], "a", "b", "c", 9.0, 2)], tagging.RULES)
    texts = spark.createDataFrame([("收入", "", "a ring", ""), ("收入", "", "", "x"), ("支出", "o", "bolt", "")], "direction string, opp_name string, memo string, note string")
    few, many = (sorted(r["memo"] for r in tagging.match_rules(texts, rule, few_rules=k).collect()) for k in (500, 0))
    assert few == many == (["a ring", "bolt"] if keyword == "" else ["a ring"])


def test_few_rules_are_tested_where_the_rows_are(spark, sf_dir, monkeypatch):
    """Rules of every scope and direction, with lists, ties, odd keywords and texts: as the other ways, and no row moves."""
    rng, texts = random.Random(5), [None, "", "nan", "NaN", "ring", "a ring of bolts", "bolt", "款项", "na"]
    rows = ledger(spark, [{"income": rng.choice([None, 1.0]), "expense": rng.choice([None, 2.0]), **{c: rng.choice(texts) for c in tagging.TEXTS}} for _ in range(300)])
    words = ["", "ring", "bolt", "款", "nan", "o", None]
    some = lambda: [w for w in rng.sample(["s", "bolt", "款", "x"], rng.randint(0, 2))]
    table = [(f"R{k}", rng.choice(["收入", "支出", "通用", "other"]), rng.choice([*tagging.SCOPES, "else"]), rng.choice(words), some(), some() if k % 2 else [], "a", "b", None, float(k % 5), k) for k in range(40)]
    rules = spark.createDataFrame(table, tagging.RULES)
    direct = tagging.tag(rows, rules)
    assert "Exchange" not in direct._jdf.queryExecution().executedPlan().toString()
    shown = lambda df: sorted(map(str, df.collect()))
    monkeypatch.setattr(tagging, "DIRECT_RULES", 0)
    assert shown(direct) == shown(tagging.tag(rows, rules).select(*direct.columns)) == shown(tagging.tag(rows, rules, few_rules=0).select(*direct.columns))


def test_rows_without_a_rule_have_the_fallback_labels(spark):
    rows = ledger(spark, [{"income": 1.0, "txn_time": datetime(2024, 1, 1)}, {"expense": 1.0}, {"income": 0.0}])
    got = tagging.tag(rows, pipelines.rules.typed_rules(testdata.demo_rules(spark).where("false"))).orderBy("seq").select("label_1", "label_2", "label_3", "label_source", "label_confidence").collect()
    assert [tuple(r) for r in got] == [("其他类", "其他", x, "兜底", 0.3) for x in ("其他收入", "其他支出", "其他收入")]


def two_by_two():
    day = datetime(2024, 1, 1)
    return [{"txn_time": day, "own_account": a, "expense": 5.0} for a in "AB"] + [{"txn_time": day, "own_account": a, "income": 5.0} for a in "CD"]


def test_two_transfers_of_one_amount_are_two_pairs(spark):
    got = transfers.self_transfers(ledger(spark, two_by_two())).orderBy("out_seq").collect()
    assert [(r["out_seq"], r["in_seq"]) for r in got] == [(0, 2), (1, 3)]


def test_rows_without_load_order_are_refused(spark):
    rows = ledger(spark, two_by_two())
    with pytest.raises(Exception, match="no load order"):
        transfers.self_transfers(rows.withColumn("seq", F.lit(None).cast("long"))).collect()


def test_an_island_of_very_many_legs(spark):
    """One amount, a third of the legs of one account, against the plain loop."""
    rng, start = random.Random(19), datetime(2024, 1, 1)
    rows = []
    for _ in range(1500):
        income = rng.random() < 0.5
        rows.append({"txn_time": start + timedelta(minutes=rng.randint(0, 30_000)), "own_account": rng.choice(["A", "A", "B", "C", "D", "E"]), "income": 9.99 if income else None, "expense": None if income else 9.99})
    want = plain_transfers(rows)
    for long_run in (20_000, 100):
        found = transfers.self_transfers(ledger(spark, rows), long_run=long_run)
        assert [(r["out_seq"], r["in_seq"]) for r in found.orderBy("out_seq").collect()] == want
        assert (found.rounds == 0) == (long_run == 20_000)


@pytest.mark.parametrize("seed", range(60))
def test_slots_in_any_order_give_the_greedy_pairs(seed):
    """Deferred acceptance over slots, round by round, without Spark; load order and time have nothing to do with each other."""
    rng, reach = random.Random(seed), 10
    legs = [(k, rng.randint(0, 90), rng.choice("ABC"), f"T{k}", 1.0, rng.random() < 0.5) for k in range(60)]
    outs, ins = [x[:5] for x in legs if x[5]], [(x[0], x[0], x[1], x[2], x[3]) for x in legs if not x[5]]
    want = {(o[0], i[0]) for o, i in transfers.matched_run(outs, {1.0: ins}, reach)}
    claims, active, rounds = {}, {o[1] // reach for o in outs}, 0
    while active:
        rounds += 1
        holders = {}
        for home, pairs in claims.items():
            for o, i in pairs:
                holders[i] = min(holders.get(i, (10**9, home)), (o, home))
        new = {}
        for home in active:
            own = [i for i in ins if home - 1 <= i[2] // reach <= home + 1]
            held = {i: o for i, (o, h) in holders.items() if h != home}
            new[home] = [(o[0], i[0]) for o, i in transfers.matched_run([o for o in outs if o[1] // reach == home], {1.0: own}, reach, held)]
        claims |= new
        first = {}
        for pairs in claims.values():
            for o, i in pairs:
                first[i] = min(first.get(i, o), o)
        active = {home for home, pairs in claims.items() if any(first[i] != o for o, i in pairs)}
    assert {p for pairs in claims.values() for p in pairs} == want and rounds < 20


def test_transfers_of_files_follow_their_load_order(spark, sf_dir):
    rows = file_queries._files(spark, sf_dir).orderBy("seq").collect()
    assert [r["seq"] for r in rows] == sorted({r["seq"] for r in rows})
    assert [(r["source_file"], r["source_row"]) for r in rows] == sorted((r["source_file"], r["source_row"]) for r in rows)
    want = [(rows[i]["source_file"], rows[i]["source_row"], rows[j]["source_file"], rows[j]["source_row"]) for i, j in plain_transfers([r.asDict() for r in rows])]
    got = file_queries.files_to_transfers(spark, sf_dir).orderBy("transfer_id").collect()
    assert [(r["out_file"], r["out_row"], r["in_file"], r["in_row"]) for r in got] == want and want


def test_csv_ledgers_with_a_byte_order_mark_keep_their_rows_in_order(spark, tmp_path):
    for name, ids in (("b__standardized.csv", "xy"), ("a__standardized.csv", "zw")):
        (tmp_path / name).write_bytes(("\ufeff交易唯一编号,收入金额\n" + "".join(f"{i},1.5\n" for i in ids)).encode())
    got = ledgers.read_csv_ledgers(spark, str(tmp_path)).orderBy("seq").select("seq", "txn_id", "income").collect()
    assert [tuple(r) for r in got] == [(k + 1, i, 1.5) for k, i in enumerate("zwxy")]


@pytest.mark.parametrize("by", [[], ["customer_id"]])
def test_totals_from_changes_are_totals_of_daily_balances(spark, by):
    rows = ledger(spark, random_rows(7)).withColumn("customer_id", F.concat(F.lit("C"), (F.col("seq") % 3).cast("string")))
    want = portfolio.daily_total(portfolio.daily_balance(rows, by), by).orderBy(*by, "day").collect()
    assert portfolio.total_by_day(rows, by).orderBy(*by, "day").collect() == want and len(want) > 10


def test_index_of_grams_finds_what_contains_finds(spark):
    rng = random.Random(8)
    word = lambda most: "".join(rng.choice("ab款甲") for _ in range(rng.randint(0, most)))
    texts = spark.createDataFrame(sorted({("收入", "", word(9), word(3)) for _ in range(200)}), "direction string, opp_name string, memo string, note string")
    rules = spark.createDataFrame([(f"R{k}", "other", rng.choice(["银行备注", "摘要或备注", "通用"]), word(5), [], [], "a", "b", "c", float(rng.randint(0, 9)), k) for k in range(150)], tagging.RULES)
    few, many = (sorted(map(str, tagging.match_rules(texts, rules, few_rules=k).select("memo", "note", "rule", "hit_field").collect())) for k in (500, 0))
    assert few == many and few


@pytest.mark.parametrize("few", [0, 50_000])
def test_numbers_rank_the_whole(spark, monkeypatch, few):
    monkeypatch.setattr(tables, "FEW_ROWS", few)
    rows = spark.range(1000).select(F.xxhash64("id").alias("x"))
    got = numbered(rows, [F.desc("x")], "n").orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(1, 1001)) and [r["x"] for r in got] == sorted((r["x"] for r in got), reverse=True)


def test_numbers_need_no_second_sort_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(tables, "FEW_ROWS", 10)
    held = numbered(spark.range(1000), [F.desc("id")], "n").where("id >= 0").select("id", "n")
    assert "hashpartitioning(id" not in (plan := held._jdf.queryExecution().executedPlan().toString()) and "Sort [" not in plan.replace("Sort [__part", "")


def test_raw_grids_are_spread_over_tasks(spark, sf_dir, monkeypatch):
    """No task makes all lines of a file."""
    monkeypatch.setattr(tables, "FEW_ROWS", 10)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        rows = testdata.raw_grids(spark, sf_dir)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    parts = rows.where("row_idx > 2").select("file", F.spark_partition_id().alias("part")).distinct().groupBy("file").count().collect()
    assert len(parts) == 4 and sum(r["count"] for r in parts) > 4


def test_folders_without_ledgers_are_an_error(spark, tmp_path):
    for f in (ledgers.standardized_files, ledgers.best_artifact):
        with pytest.raises(FileNotFoundError):
            f(spark, str(tmp_path))


def test_empty_ledger(spark):
    empty = ledger(spark, [])
    for df in (checks.balance_check(empty, ["own_account"]), transfers.self_transfers(empty), portfolio.virtual_balance(empty), portfolio.daily_balance(empty)):
        assert df.count() == 0


def test_files_to_ledger(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("# 账号: 123456789012\n\n交易日期,交易时间,收入金额,支出金额,余额,对方户名,摘要\n20250421,152103,\"46,800.00\",,\"50,000.00\",甲公司,货款\n本页小计,,1,,,,\n20250422,,-50.00,,\"49,950.00\",乙,退款\n".encode("gbk"))
    cells = [["户名：测试公司  账号：6226****4806"], ["交易时间", "交易金额", "余额"], ["2025032100:10:53", "-3", "7"]]
    xml = "".join(f"<row r='{i + 1}'>" + "".join(f"<c r='{chr(65 + k)}{i + 1}' t='inlineStr'><is><t>{v}</t></is></c>" for k, v in enumerate(r)) + "</row>" for i, r in enumerate(cells))
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as book:
        book.writestr("xl/workbook.xml", "<workbook xmlns:r='http://x/r'><sheets><sheet name='s' r:id='rId1'/></sheets></workbook>")
        book.writestr("xl/_rels/workbook.xml.rels", "<Relationships><Relationship Id='rId1' Target='worksheets/s.xml'/></Relationships>")
        book.writestr("xl/worksheets/s.xml", f"<worksheet><sheetData>{xml}</sheetData></worksheet>")
    rows, report = pipelines.standardize_files(spark, str(tmp_path))
    got = sorted((r["own_account"], str(r["txn_time"]), r["income"], r["expense"], r["balance"], r["memo"]) for r in rows.collect())
    assert got == [("123456789012", "2025-04-21 15:21:03", 46800.0, None, 50000.0, "货款"), ("123456789012", "2025-04-22 00:00:00", None, 50.0, 49950.0, "退款"), ("6226****4806", "2025-03-21 00:10:53", None, 3.0, 7.0, None)]
    assert {r["file"].rpartition(".")[2]: (r["mode"], r["dropped"]) for r in report.collect()} == {"csv": ("分列", 1), "xlsx": ("单列带符号", 0)}


def test_pipelines_compose(spark, sf_dir):
    rows = testdata.events_ledger(spark, sf_dir)
    out = pipelines.integrate(rows)
    assert out["ledger"].count() == rows.count()
    assert out["quality"].first()["score"] <= 100
    sheets = pipelines.deliverable("client", [("a", rows)], testdata.demo_rules(spark))
    assert sheets["整合打标流水"].count() == rows.count()
    assert "虚拟账户余额" in sheets["整合打标流水"].columns
    both = pipelines.several_customers([("a", rows), ("b", rows.where("seq % 10 = 0"))])
    assert both["batch"].first()["customers"] == 2


@pytest.mark.parametrize("orders", [[[7, 3, 5], [], [2, -4], [9]], [[2**63 - 1, -(2**63)], [5, 0]]])
def test_ledgers_go_one_after_another(spark, monkeypatch, orders):
    """In the order of the ledgers, then their own; rows are numbered only where shifted numbers would not fit."""
    parts = [ledger(spark, [{"seq": s, "txn_id": f"{k}:{s}"} for s in part]) for k, part in enumerate(orders)]
    if max(map(abs, sum(orders, []))) < 2**60:
        monkeypatch.setattr(ledgers, "numbered", None)
    got = [r["txn_id"] for r in ledgers.one_after_another(parts).orderBy("seq").collect()]
    assert got == [f"{k}:{s}" for k, part in enumerate(orders) for s in sorted(part)]
    with pytest.raises(Exception, match="no load order"):
        ledgers.one_after_another([ledger(spark, [{"seq": None}])])


def test_main_sheet_of_a_ledger_without_balances_writes_each_row_once(spark, monkeypatch):
    """The load order, the virtual balances and the sheets that aren't read move and write none."""
    monkeypatch.setattr(tables, "FEW_ROWS", 10)
    monkeypatch.setattr(reports, "review_items", None)  # of another sheet
    rows = [r | {"balance": None} for r in random_rows(3)]
    twice = [("a", ledger(spark, rows)), ("b", ledger(spark, rows[:50]))]
    before = {p.name for p in Path(tables.shared_dir(spark)).iterdir()}
    sheet = pipelines.deliverable("client", twice, testdata.demo_rules(spark))["整合打标流水"]
    written = {p for p in Path(tables.shared_dir(spark)).iterdir() if p.name not in before}
    many = [n for p in written if (n := spark.read.parquet(str(p)).count()) > 10]
    assert many == [170]
    late = datetime(9999, 1, 1)
    want = sorted((r["own_account"], r["txn_time"] or late, i) for part in (rows, rows[:50]) for i, r in enumerate(part))
    got = [(r["本方账户"], r["交易时间"] or late, r["来源行号"]) for r in sheet.collect()]
    assert got == want
    assert {r["虚拟账户余额"] for r in sheet.collect()} == {0.0}


def test_stream_of_balances(spark, sf_dir, tmp_path):
    from tallybrook.streaming.balance import balance_breaks

    rows = testdata.events_ledger(spark, sf_dir)
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    found = balance_breaks(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    job = found.writeStream.format("memory").queryName("breaks").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    job.awaitTermination()
    want = checks.balance_steps(rows, ["own_account"], by_file=False).where("is_break").count()
    assert spark.table("breaks").count() == want > 0


def test_duplicate_members_number_a_hot_group_in_load_order(spark, monkeypatch):
    """A group of a third of the rows, one of rows without an account, and single rows; ranked by ranges of the order."""
    monkeypatch.setattr("tallybrook.tables.FEW_ROWS", 10)
    rows = [(i, f"T{i}", "A" if i % 3 == 0 else None if i % 3 == 1 and i < 60 else f"B{i}", f"f{i % 2}.csv") for i in range(120)]
    made = ledger(spark, [{"own_account": a, "source_file": f} for _, _, a, f in rows])
    got = duplicates.duplicate_members(made, ["own_account"]).collect()
    want = {"DUP-0001": [i for i, _, a, _ in rows if a is None], "DUP-0002": [i for i, _, a, _ in rows if a == "A"]}
    assert sorted((r["group_id"], r["nth"], r["seq"], r["size"]) for r in got) == sorted((g, n + 1, i, len(ids)) for g, ids in want.items() for n, i in enumerate(ids))
