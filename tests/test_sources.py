"""File sources: text in splits against a plain reader, typed cells, outcomes, ledgers written and read back."""

import csv
import io
import random
import zipfile
import zlib
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallybrook.file_queries import small_splits
from tallybrook.operators import rules
from tallybrook.plans import pipelines, sinks, workbook_sink
from tallybrook.sources import grids, ledgers, testdata, textfiles, workbooks
from tests.test_operators import ledger


def plain(data):
    """Comments and rows of a text file, read whole."""
    for encoding in ("utf-8-sig", "utf-8", "gbk", "gb18030", "utf-16"):
        try:
            text = data.decode(encoding)
            break
        except UnicodeError:
            pass
    else:
        text = data.decode("utf-8", "replace")
    lines = text.splitlines()
    comments = [x.strip().lstrip("#").strip() for x in lines if x.strip().startswith("#")]
    table = [x for x in lines if x.strip() and not x.strip().startswith("#")]
    return "\n".join(comments), [[c.strip() for c in r] for r in csv.reader(io.StringIO("\n".join(table)))]


def random_text(rng, rows):
    pieces = ["甲", "公司", "a", "1,2", '"q"', '""', "\n", "\r\n", "# x", "#", " ", " ", "，", "“", "　", "上", "一", "ੱ", "愀", '"\n"', 'x"y']
    out = []
    for _ in range(rows):
        fields = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 4))) for _ in range(rng.randint(1, 4))]
        out.append(",".join('"' + f.replace('"', '""') + '"' if rng.random() < 0.5 else f for f in fields))
    return rng.choice(["\n", "\r\n"]).join(out)


@pytest.mark.parametrize("split", ["64", "100m"])
def test_records_match_a_plain_reader_whatever_the_splits(spark, tmp_path, split):
    rng, want = random.Random(4), {}
    for k in range(30):
        text, encoding = random_text(rng, rng.choice([0, 1, 5, 60])), ["utf-8", "utf-8-sig", "gbk", "gb18030", "utf-16", "utf-16-be"][k % 6]
        data = (b"\xfe\xff" if encoding == "utf-16-be" else b"") + text.encode(encoding, "ignore")
        if k == 25:
            data = b"\xff\xff\xfe,bad\n\x81,1\n" * 5
        if k == 28:  # the bytes of a line end stand across two characters
            data = "一,ੱ愀\n愀愀ੱ,\"a\n\"\n".encode("utf-16") * 1
        (tmp_path / f"f{k:02d} [x]+%25.csv").write_bytes(data)
        want[f"f{k:02d} [x]+%25.csv"] = plain(data)
    with small_splits(spark, split):
        rows = textfiles.records(spark, textfiles.files_in(spark, str(tmp_path))).collect()
    got = {name: {} for name in want}
    for r in rows:
        assert r["error"] is None
        got[r["file"].rpartition("/")[2]][r["record"]] = r["cells"]
    for name, (comments, table) in want.items():
        assert got[name].pop(-1, [""]) == [comments]
        assert [got[name].get(i) for i in range(len(got[name]))] == table


@pytest.mark.parametrize("line", ["", "a", '"', '""', '"a', '"a""', '"a"",', 'a"b,"c', '"a"x"y,"', 'x,"y","z', '"a","b"'])
@pytest.mark.parametrize("inside", [False, True])
def test_state_of_a_line_is_the_readers(line, inside):
    rows = list(csv.reader(io.StringIO(('"' if inside else "") + line + "\n!\n")))
    assert textfiles.ends_inside(line, inside) == (len(rows) == 1 and bool(rows[0]))


def test_long_records_make_a_file_unreadable_whatever_the_splits(spark, tmp_path):
    (tmp_path / "open.csv").write_text('a,b\n1,"' + "x\n" * 80_000 + '2,3\n')
    (tmp_path / "good.csv").write_text("a,b\n1,2\n")
    (tmp_path / "huge.csv").write_text("a,b\n" + ",".join(["y" * 100_000] * 12) + "\n")
    for split in ("200k", "100m"):
        with small_splits(spark, split):
            found, outcomes = grids.scan_files(spark, str(tmp_path))
        assert {r["file"].rpartition("/")[2]: r["status"] for r in outcomes.collect()} == {"open.csv": "unreadable", "good.csv": "read", "huge.csv": "unreadable"}
        assert [(r["row_idx"], r["cells"]) for r in found.orderBy("row_idx").collect()] == [(0, ["a", "b"]), (1, ["1", "2"])]


def test_no_task_holds_a_file(spark, tmp_path):
    (tmp_path / "f.csv").write_text("交易时间,金额\n" + "".join(f"2024-01-01,{k}\n" for k in range(5000)))
    with small_splits(spark, "4k"):
        files = textfiles.files_in(spark, str(tmp_path))
        assert textfiles._lines(spark, files, "utf-8", False).rdd.getNumPartitions() > 10
        small = pipelines.standardize_files(spark, str(tmp_path))[0].orderBy("seq").collect()
    assert small == pipelines.standardize_files(spark, str(tmp_path))[0].orderBy("seq").collect() and len(small) == 5000


def test_every_file_has_an_outcome(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "good.csv").write_text("交易时间,金额\n2024-01-01,5\n")
    (folder / "odd.csv").write_text("x,y\n1,2\n")
    (folder / "empty.txt").write_text("")
    (folder / "old.xls").write_bytes(b"\xd0\xcf")
    (folder / "bad.xlsx").write_bytes(b"PK")
    (folder / "skipped.docx").write_bytes(b"x")
    (tmp_path / "named.docx").write_bytes(b"x")
    rows, report = pipelines.standardize_files(spark, str(folder), str(tmp_path / "named.docx"))
    got = {r["file"].rpartition("/")[2]: (r["status"], r["rows"], bool(r["reason"])) for r in report.collect()}
    assert got == {"good.csv": ("read", 1, False), "odd.csv": ("no header", 0, True), "empty.txt": ("no header", 0, True), "old.xls": ("unreadable", 0, True), "bad.xlsx": ("unreadable", 0, True), "named.docx": ("unknown type", 0, True)}
    assert rows.count() == 1
    with pytest.raises(ValueError, match="docx"):
        grids.read_grids(spark, str(tmp_path / "named.docx"))


def test_an_extractor_that_fails_is_its_files_outcome(spark, tmp_path):
    for name in ("a.pdf", "b.pdf"):
        (tmp_path / name).write_bytes(name[:1].encode())

    def tables(data):
        return [[["交易时间", "金额"], ["2024-01-01", "3"]], [["交易时间", "金额"], ["2024-01-02", "4"]]] if data == b"a" else data[5]

    rows, report = pipelines.standardize_files(spark, str(tmp_path), extractors={".pdf": tables})
    assert {r["file"][-5:]: r["status"] for r in report.collect()} == {"a.pdf": "read", "b.pdf": "unreadable"}
    assert [r["amount"] for r in rows.orderBy("seq").collect()] == [3.0, 4.0]


@pytest.mark.parametrize(("cell", "text"), [
    (("moment", 45736.5), "2025-03-20 12:00:00"), (("moment", 45736.453503472), "2025-03-20 10:53:02.700000"), (("day", 45736.0), "2025-03-20 00:00:00"), (("han", 45736), "2025-03-20 00:00:00"), (("clock", 0.25), "06:00:00"),
    (("moment", 59.0), "1900-02-28 00:00:00"), (("moment", 61.0), "1900-03-01 00:00:00"), (("duration", 1.5), "1 day, 12:00:00"), (("money", 1234.5), "1234.5"), (("money", 5.0), "5"), (("number", 6222021234567890123), "6222021234567890123"),
    (("number", 0.1), "0.1"), (True, "True"), (False, "False"), (("error", "#DIV/0!"), None), ("N/A", None), (" a ", " a "), (None, None),
])
def test_cells_print_by_their_type(cell, text):
    assert workbooks.first_table(testdata.workbook({"s": [["x"], [cell, "end"]]}))[1] == [text, "end"]


def test_the_other_calendar_and_gaps():
    book = testdata.workbook({"s": [[("day", 1)], []], "t": [["a"], [], ["b", ("day", 44274)]]}, of_1904=True)
    assert workbooks.first_table(book) == [["a"], [], ["b", "2025-03-20 00:00:00"]]


@pytest.mark.parametrize(("code", "kind"), [("yyyy\\-mm\\-dd", "date"), ("[$-804]yyyy年m月d日", "date"), ("#,##0.00_);[Red]\\(#,##0.00\\)", "number"), ('0.00"days"', "number"), ("[h]:mm", "duration"), ("General", "number"), ("h:mm AM/PM", "date")])
def test_number_formats(code, kind):
    assert workbooks._kind_of_format(code) == kind


def test_workbook_dates_become_times_of_the_ledger(spark, tmp_path):
    rows = [["交易时间", "交易金额", "余额"], [("moment", 45736.5), ("money", -3.0), ("money", 7.25)], [("day", 45737), ("money", 2), None]]
    (tmp_path / "a.xlsx").write_bytes(testdata.workbook({"cover": [["x"]], "data": rows}))
    got = pipelines.standardize_files(spark, str(tmp_path))[0].orderBy("seq").collect()
    assert [(r["txn_time"], r["expense"], r["income"], r["balance"]) for r in got] == [(datetime(2025, 3, 20, 12), 3.0, None, 7.25), (datetime(2025, 3, 21), None, 2.0, None)]


def test_sheets_by_name(spark, tmp_path):
    (tmp_path / "r.xlsx").write_bytes(testdata.workbook({"one": [["a"]], "two": [["b"], [("day", 45736)]]}))
    every = grids.read_sheets(spark, str(tmp_path)).orderBy("sheet_idx", "row_idx").collect()
    assert [(r["sheet_idx"], r["sheet"], r["row_idx"], r["cells"]) for r in every] == [(0, "one", 0, ["a"]), (1, "two", 0, ["b"]), (1, "two", 1, ["2025-03-20 00:00:00"])]
    assert grids.read_sheets(spark, str(tmp_path), sheet="two").count() == 2
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        grids.read_sheets(spark, str(tmp_path / "none"))


def test_rules_compile_from_a_workbook(spark, sf_dir, tmp_path):
    words = [r.asDict() for r in testdata.lexicon(spark, sf_dir).orderBy("row").collect()]
    labels = [["h"] * 11, *([r[1], r[2], r[3], *[None] * 6, r[4], r[5]] for r in testdata.DIMENSION)]
    lexicon = [["h"] * 6, *([w["flow_field"], "包含", w["keyword"], w["income_label"], w["expense_label"], None] for w in words)]
    (tmp_path / "rules.xlsx").write_bytes(testdata.workbook({rules.DIMENSION_SHEET: labels, rules.LEXICON_SHEET: lexicon}))
    sheet, found = rules.of_workbook(grids.read_sheets(spark, str(tmp_path)))
    shown = lambda df: [tuple(r) for r in df.orderBy("rule_seq").select("rule_id", "direction", "scope", "keyword", "label_1", "label_3", "priority").collect()]
    want = shown(rules.compile_rules(rules.label_dimension(testdata.demo_dimension(spark)), testdata.lexicon(spark, sf_dir)))
    assert shown(rules.compile_rules(rules.label_dimension(sheet), found)) == want and want


def test_sheets_come_back_from_workbooks_in_order(spark, tmp_path):
    rows = [(k, f"t{k}", k / 4, datetime(2024, 1, 1, 0, 0, k % 60), k % 2 == 0, None) for k in range(250)]
    rows[3] = (10**17, "a\r\n<&> \x0b\"'", 1e300, None, None, "x" * 40_000)
    main = spark.createDataFrame(rows, "id long, name string, amount double, at timestamp_ntz, flag boolean, note string").repartition(5).orderBy("id")
    none = spark.createDataFrame([], "only string")
    books = workbook_sink.write_workbooks({"main/流水": main, "none": none}, str(tmp_path / "out"), sheet_rows=100)
    assert [b.rpartition("/")[2] for b in books] == ["1.xlsx", "2.xlsx", "3.xlsx"]
    back = grids.read_sheets(spark, str(tmp_path / "out")).orderBy("file", "sheet_idx", "row_idx").collect()
    assert {r["sheet"] for r in back} == {"main_流水", "none"}
    assert [r["cells"] for r in back if r["sheet"] == "none"] == [["only"]]
    got = [r["cells"] for r in back if r["sheet"] == "main_流水" and r["row_idx"] > 0]
    want = [[str(i), name, str(int(x)) if x == int(x) else repr(x), str(t), str(flag), None] for i, name, x, t, flag, _ in sorted(rows, key=lambda r: r[0]) if i < 10**15]
    assert got[:-1] == want
    assert got[-1] == [str(10**17), "a\r\n<&> \"'", str(int(1e300)), None, None, "x" * 32_767]
    with zipfile.ZipFile(books[0].removeprefix("file:")) as book:
        assert book.testzip() is None and "[Content_Types].xml" in book.namelist()


@pytest.mark.parametrize(("spec", "parts"), [("甲:/a/b", ("甲", "/a/b", None)), ("甲:/a/b:对公", ("甲", "/a/b", "对公")), ("x:hdfs://h:9000/d", ("x", "hdfs://h:9000/d", None)), ("x:hdfs://h:9000/d:个人", ("x", "hdfs://h:9000/d", "个人"))])
def test_subjects_by_name_path_and_type(spec, parts):
    assert pipelines.subject_spec(spec) == parts


def test_a_clients_folder_is_wiped_and_its_name_made_safe(spark, tmp_path):
    folder = tmp_path / "a_b"
    folder.mkdir()
    (folder / "stale.xlsx").write_bytes(b"x")
    books = pipelines.write_deliverable("a/b", {"s": spark.range(3).toDF("n")}, str(tmp_path))
    assert [p.name for p in folder.iterdir() if not p.name.startswith(".")] == ["1.xlsx"] and books == [f"{folder}/1.xlsx"]
    with pytest.raises(ValueError, match="name:path"):
        pipelines.subject_spec("only")


def test_rows_of_a_sheet_stay_in_their_tasks(spark, tmp_path):
    """Runs of rows that follow each other in a workbook, whatever the batches; whole numbers with gaps stay whole."""
    batches = [pa.record_batch([pa.array(r), pa.array(r)], names=["rank", "n"]) for r in ([4, 5, 6], [7, 8], [20, 21])]
    got = [(p["book"], p["sheet"], p["block"], zlib.decompress(p["data"]).decode().count("<row>")) for b in workbook_sink._pieces(1, 7)(batches) for p in b.to_pylist()]
    assert got == [(0, 1, 4, 3), (1, 1, 0, 2), (2, 1, 6, 1), (3, 1, 0, 1)]
    books = workbook_sink.write_workbooks({"s": spark.range(50, numPartitions=7).selectExpr("id", "if(id % 5 = 0, null, id) AS n")}, str(tmp_path), sheet_rows=12)
    assert [b.rpartition("/")[2] for b in books] == [f"{k}.xlsx" for k in range(1, 6)]
    for k, book in enumerate(books):
        rows = workbooks.first_table(open(book, "rb").read())
        assert rows == [["id", "n"], *([str(i), None if i % 5 == 0 else str(i)] for i in range(12 * k, min(12 * k + 12, 50)))]
        assert b"s='1'" not in zipfile.ZipFile(book).read("xl/worksheets/sheet0.xml")


TEXTS = ["plain", "one\ntwo", 'a "quoted", text', "\r\n", " blanks ", "# no comment", "\n\n", "tail\\", "甲，乙", None, ",", '"']


@pytest.mark.parametrize("mark", [True, False])
@pytest.mark.parametrize("split", ["48", "100m"])
def test_ledgers_come_back_as_they_were_written(spark, tmp_path, mark, split):
    rows = ledger(spark, [{"memo": t, "note": TEXTS[-k - 1], "own_name": "N", "income": k + 0.5, "txn_time": datetime(2024, 1, 1, 0, 0, k)} for k, t in enumerate(TEXTS)])
    sinks.write_csv(rows.repartition(1).sortWithinPartitions("seq").drop("seq", "time_text"), str(tmp_path / "x__standardized.csv"), mark=mark)
    with small_splits(spark, split):
        back = ledgers.read_csv_ledgers(spark, str(tmp_path)).orderBy("seq").collect()
    want = rows.orderBy("seq").collect()
    names = [c for c in rows.columns if c not in ("seq", "time_text")]
    assert [tuple(r[c] for c in names) for r in back] == [tuple(r[c] for c in names) for r in want]
    assert [r["seq"] for r in back] == list(range(1, len(TEXTS) + 1))


def test_many_ledgers_of_any_columns_are_one_scan(spark, tmp_path):
    for k in range(40):
        head, row = [("交易唯一编号,收入金额", f"T{k},{k}"), ("收入金额,交易唯一编号,客户编号", f"{k},T{k},C{k}"), ("交易唯一编号", f"T{k}")][k % 3]
        (tmp_path / f"{k:03d}__standardized.csv").write_text(f"{head}\n{row}\n\n")
    back = ledgers.read_csv_ledgers(spark, str(tmp_path))
    assert [(r["seq"], r["txn_id"], r["income"], r["customer_id"]) for r in back.orderBy("seq").collect()] == [(k + 1, f"T{k}", None if k % 3 == 2 else float(k), f"C{k}" if k % 3 == 1 else None) for k in range(40)]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Union") == 0


def test_small_splits_share_tasks(spark, tmp_path):
    (tmp_path / "a__standardized.csv").write_text("交易唯一编号,银行备注\n" + "".join(f'T{k},"x\n{k}"\n' for k in range(600)))
    sc = spark.sparkContext
    sc.setJobGroup("splits", "")
    with small_splits(spark, "64"):
        assert textfiles._lines(spark, textfiles.files_in(spark, str(tmp_path)), "utf-8", True).rdd.getNumPartitions() > 100
        back = ledgers.read_csv_ledgers(spark, str(tmp_path))
    assert [(r["txn_id"], r["memo"]) for r in back.orderBy("seq").collect()] == [(f"T{k}", f"x\n{k}") for k in range(600)]
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("splits") for s in tracker.getJobInfo(j).stageIds]
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(stages) > 5 and max(s.numTasks for s in stages if s) <= 40


def test_unreadable_ledgers_are_an_error(spark, tmp_path):
    (tmp_path / "a__standardized.csv").write_text("交易唯一编号\n" + "x" * 200_000 + "\n")
    with pytest.raises(ValueError, match="field limit"):
        ledgers.read_csv_ledgers(spark, str(tmp_path))


def test_times_step_by_step_are_times_at_once(spark):
    from tallybrook.functions.text import joined_time, parse_datetime, with_datetime

    dates = ["2025032100:10:53", "2026-03-1009:54:35", "2024/1/5 7:08", "20240105 152103", "20240105 1521", "2024-13-01", "1980-01-01", "2024-01-05 25:00:00", "x", "", None, " nan "]
    df = spark.createDataFrame([(d, t) for d in dates for t in ("", "152103", "7:5:1", "09:10", None)], "d string, t string").coalesce(1)
    one = df.select(parse_datetime(F.col("d"), F.col("t")), F.nullif(joined_time(F.col("d"), F.col("t")), F.lit(""))).collect()
    two = with_datetime(df, F.col("d"), F.col("t"), "at", "raw").select("at", "raw").collect()
    assert [tuple(r) for r in one] == [tuple(r) for r in two]
