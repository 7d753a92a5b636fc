"""Delimited text files of any size as records, read in splits.

Spark cuts the files between lines. A record may span lines, as a quoted field may hold line breaks; so a line is a map
from the state before it (outside or inside a quoted field) to the state behind it. A first scan walks each split for
both states at once and keeps only the split's map: the state behind it and the records begun in it. The maps are composed
along each file, which gives every split its true first state and record: a file's rows have numbers although no task sees
the file. A second scan parses the records where they are; only what crosses the border of splits meets by its number.

The encoding of a file is the first of `ENCODINGS` that all its lines fit, else UTF-8 with replacement characters.
UTF-16 has its own line ends, so such files are read by themselves.

Defined results: a record of more than RECORD_LIMIT characters, or with a field of more than FIELD_LIMIT, makes its file
unreadable, whatever the splits; an empty file has no records; a quoted field that is never closed ends with the file.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.tables import own_splits, settings_of, write_table

#: Tried in this order.
ENCODINGS = ("utf-8", "gbk", "gb18030", "utf-16")
ANY_BYTES = "replace"
#: UTF-16 in which the bytes of a line end also stand across two characters; such a file is one task's.
WHOLE = "utf-16"
#: The longest field that the standard csv reader takes, and the longest record here, in characters.
FIELD_LIMIT, RECORD_LIMIT = 131_072, 1 << 20
BATCH = 5_000
#: Splits of fewer bytes share tasks.
SMALL_SPLIT = 8 << 20


# Files --------------------------------------------------------------------------------------------------------------
def plain_path(path: Column) -> Column:
    return F.regexp_replace(path, r"^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/")


def literally(path: str) -> str:
    """A path that isn't taken for a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def files_in(spark: SparkSession, *paths: str) -> list[str]:
    """Files by whole path, in order: those named or matched by a pattern, and those right in the folders so found; hidden
    ones aren't looked at. As Spark's own file index, the list of names is the driver's."""
    found = set()
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        matched = fs.globStatus(p)
        if matched is None:
            raise FileNotFoundError(path)
        for one in matched:
            inside = [x for x in fs.listStatus(one.getPath()) if x.isFile()] if one.isDirectory() else [one]
            found |= {x.getPath().toString() for x in inside if x.getPath().getName()[:1] not in ("_", ".")}
    return sorted(found)


def _lines(spark: SparkSession, files: list[str], encoding: str, record_safe: bool) -> DataFrame:
    """file, block (where its split begins), value (bytes of a line); the lines of a split follow each other."""
    if encoding == WHOLE:
        return binary(spark, files).mapInArrow(_narrowed, "file string, block long, value binary")
    reader = spark.read
    if encoding.startswith("utf-16"):
        reader = reader.option("encoding", "UTF-16LE" if encoding == "utf-16-le" else "UTF-16BE").option("lineSep", "\n")
    elif record_safe:  # a carriage return inside a field stays
        reader = reader.option("lineSep", "\n")
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return reader.text([literally(f) for f in files]).select(plain_path(path).alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


def binary(spark: SparkSession, files: list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load([literally(f) for f in files]).select(plain_path(F.col("path")).alias("file"), "content")


def _wide(data: bytes) -> str:
    return data.decode("utf-16" if data[:2] in (b"\xff\xfe", b"\xfe\xff") else "utf-16-le")


def _is_wide(batches):
    for batch in batches:
        for file, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            try:
                _wide(data.as_py())
            except UnicodeError:
                continue
            yield pa.record_batch([pa.array([file])], names=["file"])


def _narrowed(batches):
    """The lines of whole UTF-16 files in UTF-8."""
    for batch in batches:
        for file, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            lines = _wide(data.as_py()).split("\n")
            for at in range(0, len(lines), BATCH):
                part = [x.encode() for x in lines[at : at + BATCH]]
                yield pa.record_batch([pa.array([file] * len(part)), pa.array([0] * len(part)), pa.array(part, pa.binary())], names=["file", "block", "value"])


# Encodings ----------------------------------------------------------------------------------------------------------
def _fits(encodings: tuple[str, ...]):
    """For each run of lines of a file: whether all fit each encoding; with the first bytes of the file."""
    wide = encodings[0].startswith("utf-16")

    def run(batches):
        for batch in batches:
            fits: dict[str, list] = {}
            for file, block, value in zip(*(c.to_pylist() for c in batch.columns)):
                if (held := fits.get(file)) is None:
                    held = fits[file] = [None, [True] * len(encodings)]
                if block == 0 and held[0] is None:
                    held[0] = value[:2]
                if wide or not value.isascii():
                    for k, encoding in enumerate(encodings):
                        if held[1][k]:
                            try:
                                value.decode(encoding)
                            except UnicodeError:
                                held[1][k] = False
            if fits:
                yield pa.record_batch([pa.array(list(fits)), pa.array([h for h, _ in fits.values()], pa.binary()), pa.array([f for _, f in fits.values()], pa.list_(pa.bool_()))], names=["file", "head", "fits"])

    return run


def _all_fit(lines: DataFrame, encodings: tuple[str, ...]) -> list:
    found = lines.mapInArrow(_fits(encodings), "file string, head binary, fits array<boolean>")
    return found.groupBy("file").agg(F.first("head", True).alias("head"), *(F.bool_and(F.col("fits")[k]).alias(f"e{k}") for k in range(len(encodings)))).collect()  # a row per file


def encodings_of(spark: SparkSession, files: list[str], record_safe: bool = False) -> dict[str, str]:
    """The encoding of each file. Only files that aren't UTF-8 reach Python."""
    if not files:
        return {}
    sound = _lines(spark, files, "utf-8", record_safe).groupBy("file").agg(F.bool_and(F.expr("is_valid_utf8(CAST(value AS STRING))")).alias("sound")).where("not sound")
    others = sorted(r["file"] for r in sound.collect())
    out = dict.fromkeys(files, ENCODINGS[0])
    if others:
        wide = {"utf-16-le": [], "utf-16-be": []}
        for r in _all_fit(_lines(spark, others, "gbk", record_safe), ENCODINGS[1:3]):
            out[r["file"]] = "gbk" if r["e0"] else "gb18030" if r["e1"] else ANY_BYTES
            if out[r["file"]] == ANY_BYTES:
                wide["utf-16-be" if bytes(r["head"] or b"") == b"\xfe\xff" else "utf-16-le"].append(r["file"])
        for encoding, some in wide.items():
            if some:
                fits = {r["file"]: r["e0"] for r in _all_fit(_lines(spark, some, encoding, record_safe), (encoding,))}
                # else a line end's bytes stand across two characters, or it isn't UTF-16 at all
                whole = {r["file"] for r in binary(spark, [f for f in some if not fits.get(f)]).mapInArrow(_is_wide, "file string").collect()} if not all(fits.values()) else set()
                out |= {f: encoding if fits.get(f) else WHOLE for f in some if fits.get(f) or f in whole}
    return out


# Lines to records ---------------------------------------------------------------------------------------------------
def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line ends inside a quoted field. Quotes count at the start of a field, and inside a quoted one."""
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('"', at + 1):
                at += 2
                continue
        elif line.startswith('"', at):
            inside, at = True, at + 1
            continue
        inside = False
        at = line.find(",", at)
        if at < 0:
            return False
        at += 1


def _codec(encoding: str) -> tuple[str, str]:
    return ("utf-8", "replace") if encoding in (ANY_BYTES, WHOLE) else (encoding, "strict")


def _runs(batches):
    """The lines of a split that stand in one batch, with the columns before them, which hold one value in a split."""
    for batch in batches:
        *keys, values = batch.columns
        ends = sorted({e for c in keys[:2] for e in pc.run_end_encode(c).run_ends.to_pylist()})
        for at, end in zip([0, *ends], ends):
            yield [c[at].as_py() for c in keys], values.slice(at, end - at).to_pylist()


def _begun(block: int, lines: list[bytes], names: str) -> list[bytes]:
    """The first lines of a split; those of a file without its mark."""
    mark = b"\xef\xbb\xbf" if names == "utf-8" else b"\xff\xfe" if names == "utf-16-le" else b"\xfe\xff" if names.startswith("utf-16") else b""
    return [lines[0].removeprefix(mark), *lines[1:]] if block == 0 else lines


def _maps(encoding: str, record_safe: bool):
    """For each split the states behind it and the records begun in it, for both states in which it may begin."""
    names, errors = _codec(encoding)

    def run(batches):
        where, inside, seen = None, [False, True], [0, 0]
        row = lambda: pa.record_batch([pa.array([where[0]]), pa.array([where[1]], pa.int64()), pa.array([inside]), pa.array([seen], pa.list_(pa.int64()))], names=["file", "block", "behind", "seen"])
        for key, lines in _runs(batches):
            if key != where:
                if where is not None:
                    yield row()
                where, inside, seen = key, [False, True], [0, 0]
                lines = _begun(key[1], lines, names)
            for value in lines:
                text = value.decode(names, errors)
                for piece in [text] if record_safe else text.splitlines():
                    bare = piece.strip()
                    if bare and (record_safe or not bare.startswith("#")):
                        seen = [n + (not s) for n, s in zip(seen, inside)]
                        if '"' in piece:
                            inside = [ends_inside(piece, s) for s in inside]
        if where is not None:
            yield row()

    return run


RECORD, COMMENT, PART = 0, 1, 2
TOO_LONG = f"a record is longer than {RECORD_LIMIT} characters"
PIECES = "file string, block long, at long, kind byte, record long, cells array<string>, error string, part string, size long"


def _walk(encoding: str, record_safe: bool):
    """Lines (file, block, state and records before the split, value) to records that lie in one split, parsed, to what
    the split holds of others, and to comments."""
    names, errors = _codec(encoding)
    parse = _parsed(not record_safe, record_safe)

    def run(batches):
        where, at, number, inside, cut, begun, held, size = None, 0, -1, False, False, 0, [], 0
        whole: list[tuple] = []
        loose: list[tuple] = []

        def close(cut: bool):
            nonlocal held, size
            if cut:  # no more than a part of a record
                loose.append((*where, begun, PART, number, None, "\n".join(held) if size <= RECORD_LIMIT else None, size))
            elif size > RECORD_LIMIT:
                loose.append((*where, begun, RECORD, number, TOO_LONG, None, None))
            else:
                whole.append((*where, begun, number, "\n".join(held)))
            held, size = [], 0

        def flush():
            nonlocal whole, loose
            read, none = parse([w[4] for w in whole]), [None] * len(whole)
            split, rest = list(zip(*whole)) or [()] * 5, list(zip(*loose)) or [()] * 8
            columns = [split[0] + rest[0], split[1] + rest[1], split[2] + rest[2], (RECORD,) * len(whole) + rest[3], split[3] + rest[4], [c for c, _ in read] + [None] * len(loose), [e for _, e in read] + list(rest[5]), [*none, *rest[6]], [*none, *rest[7]]]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int8(), pa.int64(), pa.list_(pa.string()), pa.string(), pa.string(), pa.int64())
            whole, loose = [], []
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=[c.split()[0] for c in PIECES.split(", ")])

        for (file, block, state, before), lines in _runs(batches):
            if (file, block) != where:
                if held:
                    close(True)
                if state is None:
                    raise RuntimeError(f"the splits of {file} changed between two scans")
                where, at, number, inside, cut, begun = (file, block), 0, before - 1, bool(state), bool(state), 0
                lines = _begun(block, lines, names)
            for value in lines:
                text = value.decode(names, errors)
                for piece in [text] if record_safe else text.splitlines():
                    bare = piece.strip()
                    if not record_safe and bare.startswith("#"):
                        loose.append((file, block, at, COMMENT, -1, None, bare.lstrip("#").strip(), None))
                    elif bare or inside and record_safe:
                        if not inside:
                            number, begun = number + 1, at
                        behind = ends_inside(piece, inside) if '"' in piece else inside
                        if inside or behind:
                            size += len(piece) + 1
                            if size <= RECORD_LIMIT:  # what is too long is not gathered
                                held.append(piece)
                            if not behind:
                                close(cut)
                                cut = False
                        else:
                            whole.append((file, block, at, number, piece))
                        inside = behind
                    at += 1
                    if len(whole) + len(loose) >= BATCH:
                        yield flush()
        if held:
            close(True)
        if whole or loose:
            yield flush()

    return run


def _begins(maps: DataFrame) -> DataFrame:
    """file, block, state (1: inside a quoted field) and first (records begun before) of each split."""
    # a split's map is constant, the identity or an exchange; the last constant before a split tells its first state
    along = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    fixed, swaps = F.col("behind")[0] == F.col("behind")[1], F.col("behind")[0] & ~F.col("behind")[1]
    counted = maps.withColumn("swaps", F.coalesce(F.sum(swaps.cast("int")).over(along), F.lit(0)))
    marked = counted.withColumn("last", F.last(F.when(fixed, F.struct(F.col("behind")[0].cast("int").alias("state"), "swaps")), True).over(along))
    state = F.pmod(F.coalesce("last.state", F.lit(0)) + F.col("swaps") - F.coalesce("last.swaps", F.lit(0)), F.lit(2)).cast("int")
    return marked.withColumn("state", state).withColumn("first", F.coalesce(F.sum(F.get("seen", F.col("state"))).over(along), F.lit(0))).select("file", "block", "state", "first")


def _parsed(strip: bool, plain: bool):
    """Whole records as texts to cells; of records that the reader refuses, the reason."""

    def cells_of(row: list[str]) -> list[str]:
        return [c.strip() for c in row] if strip else row

    def one(text: str) -> tuple[list[str] | None, str | None]:
        if len(text) > RECORD_LIMIT:
            return None, TOO_LONG
        try:
            return cells_of(next(csv.reader([text]), [])), None
        except csv.Error as e:
            return None, str(e)

    def parse(texts: list[str]) -> list[tuple[list[str] | None, str | None]]:
        texts = [t.removesuffix("\r") for t in texts] if plain else texts
        try:
            rows = [(cells_of(r), None) for r in csv.reader(texts)] if all(len(t) <= RECORD_LIMIT for t in texts) else []
        except csv.Error:
            rows = []
        return rows if len(rows) == len(texts) else [one(t) for t in texts]

    return parse


def _gathered(record_safe: bool):
    """Records (file, record, text) that lay in several splits, parsed."""
    parse = _parsed(not record_safe, record_safe)

    def run(batches):
        for batch in batches:
            rows = parse(batch.column(2).to_pylist())
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([c for c, _ in rows], pa.list_(pa.string())), pa.array([e for _, e in rows], pa.string())], names=["file", "record", "cells", "error"])

    return run


@contextmanager
def _scans(spark: SparkSession) -> Iterator[None]:
    """Inside, every scan cuts the files alike, whatever executors come and go. Where the session asks for small splits, they
    are dealt out to a bounded number of tasks, one after another."""
    conf, cores = spark.conf, spark.sparkContext.defaultParallelism
    settings = {"spark.sql.files.minPartitionNum": conf.get("spark.sql.files.minPartitionNum", None) or str(cores)}
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf.get("spark.sql.files.maxPartitionBytes")) < SMALL_SPLIT:
        settings["spark.sql.files.maxPartitionNum"] = str(4 * max(cores, int(conf.get("spark.sql.shuffle.partitions"))))
    with settings_of(spark, settings):
        yield


def records(spark: SparkSession, files: list[str], record_safe: bool = False) -> DataFrame:
    """file, record (from 0; comments have -1, in one row), cells, error (why a file's record can't be read); written.

    As a rule lines that are blank or begin with # are left out first, also inside quotes, and cells are trimmed.
    record_safe: there are no comments, line breaks inside quotes stay as they are, and so do the cells.
    """
    kind = "file string, record long, cells array<string>, error string"
    if not files:
        return spark.createDataFrame([], kind)
    with _scans(spark):
        groups: dict[str, list[str]] = {}
        for file, encoding in encodings_of(spark, files, record_safe).items():
            groups.setdefault(encoding, []).append(file)
        scans = [(_lines(spark, some, encoding, record_safe), encoding) for encoding, some in groups.items()]
        maps = [lines.mapInArrow(_maps(encoding, record_safe), "file string, block long, behind array<boolean>, seen array<long>") for lines, encoding in scans]
        # a row per split, as the driver has one to plan a scan; joined otherwise the lines would lose their order
        begins = F.broadcast(write_table(_begins(reduce(DataFrame.unionByName, maps)), "splits"))
        pieces = [lines.join(begins, ["file", "block"], "left").select("file", "block", "state", "first", "value").mapInArrow(_walk(encoding, record_safe), PIECES) for lines, encoding in scans]
        table = write_table(reduce(DataFrame.unionByName, pieces), "pieces")
    with own_splits(spark):
        return _joined(table, record_safe)


def _joined(table: DataFrame, record_safe: bool) -> DataFrame:
    """Pieces to records; those of several splits, and comments, as a table of their own."""
    kind = "file string, record long, cells array<string>, error string"
    comments = table.where(F.col("kind") == COMMENT).groupBy("file").agg(F.array_sort(F.collect_list(F.struct("block", "at", "part"))).alias("all"))
    joined = F.array_join(F.transform("all", lambda x: x["part"]), "\n")
    shown = comments.select("file", F.lit(-1).cast("long").alias("record"), F.array(joined).alias("cells"), F.lit(None).cast("string").alias("error"))
    # the parts of records over several splits; what is too long is not gathered
    parts = table.where(F.col("kind") == PART).select("file", "record", "block", "at", "part", "size")
    size = parts.groupBy("file", "record").agg(F.sum("size").alias("size"))
    gathered = parts.join(size.where(F.col("size") <= RECORD_LIMIT).select("file", "record"), ["file", "record"], "left_semi").groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("block", "at", "part"))).alias("all"))
    long = gathered.select("file", "record", joined.alias("text")).mapInArrow(_gathered(record_safe), kind)
    refused = size.where(F.col("size") > RECORD_LIMIT).select("file", "record", F.lit(None).cast("array<string>").alias("cells"), F.lit(TOO_LONG).alias("error"))
    others = write_table(long.unionByName(refused).unionByName(shown).withColumn("kind", F.lit(RECORD).cast("byte")), "others")
    both = table.sparkSession.read.schema(f"{kind}, kind byte").parquet(table.written_to, others.written_to)  # one scan
    return both.where(F.col("kind") == RECORD).drop("kind")
