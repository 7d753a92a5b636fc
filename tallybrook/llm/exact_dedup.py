"""Exact dedup by Grace hashing (operator 6).

Each map task folds the copies that it reads itself into one record, so a text held by a third of all rows costs a
record per task. The records are dealt out by digest. A reducer fills an open-addressing table that compares complete
contents; when the distinct texts outgrow its memory, all go to spill files by further bits of the hash, and each file
is treated likewise, one level deeper. The table's classes are then joined to the rows by SHA-256, which stands for the content from there on; Spark splits a
digest with very many rows among tasks.

Defined results: a null text counts as empty; all empty texts form one group; null ids lose against any id, and a group
of null ids only keeps null; rows that repeat the kept row's id and text are the kept row (all flagged kept); a
very long text may outgrow a task's memory bound by itself only; an empty table gives an empty result; further columns
don't matter, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
import struct
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import tidy

NONE = -(2**63)
_RECORD = struct.Struct("<Iqq")
FAN_OUT_BITS, MAX_DEPTH = 4, 12


class ContentTable:
    """Open addressing with linear probing; keys are complete contents, values a count and the largest id."""

    def __init__(self, hash_of=xxhash.xxh3_64_intdigest):
        self.hash_of, self.slots, self.mask = hash_of, [-1] * 1024, 1023
        self.contents: list[bytes] = []
        self.hashes: list[int] = []
        self.counts: list[int] = []
        self.ids: list[int] = []
        self.bytes = 0

    def add(self, content: bytes, count: int, top: int) -> None:
        h = self.hash_of(content)
        at = h & self.mask
        while (i := self.slots[at]) >= 0:
            if self.hashes[i] == h and self.contents[i] == content:
                self.counts[i] += count
                if top > self.ids[i]:
                    self.ids[i] = top
                return
            at = (at + 1) & self.mask
        self.slots[at] = len(self.contents)
        self.contents.append(content)
        self.hashes.append(h)
        self.counts.append(count)
        self.ids.append(top)
        self.bytes += len(content) + 150
        if 2 * len(self.contents) > self.mask:
            self._grow()

    def _grow(self) -> None:
        self.mask = 4 * (self.mask + 1) - 1
        self.slots = [-1] * (self.mask + 1)
        for i, h in enumerate(self.hashes):
            at = h & self.mask
            while self.slots[at] >= 0:
                at = (at + 1) & self.mask
            self.slots[at] = i

    def records(self) -> Iterator[tuple[bytes, int, int]]:
        return zip(self.contents, self.counts, self.ids)


def grace(records: Iterable[tuple[bytes, int, int]], budget: int, hash_of=xxhash.xxh3_64_intdigest, depth: int = 0) -> Iterator[tuple[bytes, int, int]]:
    """One record for each content; holds at most about `budget` bytes of distinct contents in memory."""
    table, files, bits = ContentTable(hash_of), None, FAN_OUT_BITS
    shift = 64 - bits * (depth + 1)
    with tempfile.TemporaryDirectory() as folder:

        def spill(content: bytes, count: int, top: int) -> None:
            out = files[(hash_of(content) >> shift) & ((1 << bits) - 1)]
            out.write(_RECORD.pack(len(content), count, top))
            out.write(content)

        for record in records:
            if files is None:
                table.add(*record)
                if table.bytes > budget and len(table.contents) > 1 and depth < MAX_DEPTH:
                    files = [open(os.path.join(folder, str(k)), "wb") for k in range(1 << bits)]  # noqa: SIM115
                    for held in table.records():
                        spill(*held)
                    table = None
            else:
                spill(*record)
        if files is None:
            yield from table.records()
            return
        for out in files:
            out.close()
        for out in files:
            yield from grace(_spilled(out.name), budget, hash_of, depth + 1)
            os.remove(out.name)


def _spilled(path: str) -> Iterator[tuple[bytes, int, int]]:
    with open(path, "rb") as lines:
        while head := lines.read(_RECORD.size):
            size, count, top = _RECORD.unpack(head)
            yield lines.read(size), count, top


_PART = pa.schema([("digest", pa.binary()), ("content", pa.binary()), ("n", pa.int64()), ("top", pa.int64())])
_CLASS = pa.schema([("digest", pa.binary()), ("n", pa.int64()), ("top", pa.int64())])


def _combine(budget: int):
    def run(batches):
        table = ContentTable()

        def flush():
            cut = max(1, min(5000, int(8e6 * len(table.contents) / max(1, table.bytes))))
            for i in range(0, len(table.contents), cut):
                part = table.contents[i : i + cut]
                yield pa.record_batch([[hashlib.sha256(x).digest() for x in part], part, table.counts[i : i + cut], table.ids[i : i + cut]], schema=_PART)

        for batch in batches:
            for top, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                table.add(content, 1, NONE if top is None else top)
                if table.bytes > budget:
                    yield from flush()
                    table = ContentTable()
        yield from flush()

    return run


def _bucket(budget: int):
    def run(batches):
        def records():
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist())

        out = []
        for content, n, top in grace(records(), budget):
            out.append((hashlib.sha256(content).digest(), n, top))
            if len(out) == 5000:
                yield pa.record_batch([list(x) for x in zip(*out)], schema=_CLASS)
                out = []
        if out:
            yield pa.record_batch([list(x) for x in zip(*out)], schema=_CLASS)

    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", memory_bytes: int = 48 << 20, row_col: str | None = None) -> DataFrame:
    """One row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256, and row_col if there is one.

    Texts are equal when they are identical; the row with the largest id of a group stays. memory_bytes bounds the
    distinct contents that a task holds before it emits (map side) or spills (reduce side).
    """
    number = [row_col] if row_col else []
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("content"), *number)
    parts = rows.select("doc_id", "content").mapInArrow(tidy(_combine(memory_bytes // 2)), "digest binary, content binary, n long, top long")
    classes = parts.repartition("digest").select("content", "n", "top").mapInArrow(tidy(_bucket(memory_bytes)), "digest binary, n long, top long")
    classes = classes.select("digest", F.col("n").alias("group_size"), F.when(F.col("top") != NONE, F.col("top")).alias("keep_id"))
    members = rows.select("doc_id", *number, F.unhex(F.sha2("content", 256)).alias("digest"))
    return members.join(classes, "digest").select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), *number)
