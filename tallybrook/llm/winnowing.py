"""Benchmark decontamination by winnowing (operator 12).

A text is its words: A-Z lower-cased, maximal runs of digits, a-z and characters beyond ASCII. A window is `span`
consecutive words of an item, or all words of a shorter item. Winnowing with k-grams of words and windows of
span - k + 1 of them keeps the smallest hash of each; so every run of `span` words, in a document or an item, has one kept
hash, and equal runs have the same one: no shared span of that length is missed. Items shorter than `span` have their own
lengths, with shorter k-grams where a length is below k.

Kept hashes of documents are looked up among those of the items; each hit is extended to the windows around it that keep
this hash, and these are compared word by word with the items' windows. Documents are never shuffled if the items'
windows stay below `most_bytes` of text (summed up first): they are then broadcast, and one pass over the documents does
all. Beyond that, documents are numbered, their kept hashes (distinct for each document) meet those of the items in a
shuffled semi-join, and the windows around the hits meet the items' windows in a second one; Spark splits skewed keys.

Defined results: a null or empty text has no words; a word is hit if any window of an item covers it; an item counts once
however often its id repeats; items without an id hit words, but aren't listed or counted; rows with null or repeated
ids stay as they are; a very long text is read in segments and extended as a whole; empty tables give empty results or
documents without hits; further columns don't matter, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import write_table

SPAN, K = 10, 5
PRIME = 0x9E3779B97F4A7C15
#: Bytes hashed at once; a segment ends between words.
SEGMENT = 1 << 20
_WORD = np.array([b > 127 or chr(b).isdigit() or chr(b).isalpha() for b in range(256)])
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_RUN = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_GAP = re.compile(rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]")
_LONG = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]{%d,}" % SEGMENT)
_POWERS: list[np.ndarray] = []


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of MurmurHash3."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(size: int) -> list[np.ndarray]:
    """Powers of the prime and of its inverse, modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < size:
        _POWERS[:] = [np.cumprod(np.full(size, p, np.uint64), dtype=np.uint64) for p in (PRIME, pow(PRIME, -1, 1 << 64))]
    return _POWERS


def _hashed(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin, and their hashes: differences of one running polynomial, brought to the same power."""
    codes = np.frombuffer(data, np.uint8)
    up, down = _powers(max(SEGMENT, len(codes) + 1))
    edges = np.flatnonzero(np.diff(np.concatenate([[False], _WORD[codes], [False]]).astype(np.int8)))
    begin, end = edges[::2], edges[1::2]
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes + np.uint64(1)) * up[: len(codes)], dtype=np.uint64)])
    return begin, mixed((running[end] - running[begin]) * down[begin])


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The number of each word's text, and the word's hash; texts in lower case."""
    numbers, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    held, size = [], 0

    def flush() -> None:
        nonlocal held, size
        if held:
            begin, found = _hashed(b"\n".join(t for _, t in held))
            ends = np.cumsum([len(t) + 1 for _, t in held])
            numbers.append(np.array([i for i, _ in held])[np.searchsorted(ends, begin, side="right")])
            hashes.append(found)
        held, size = [], 0

    for i, text in enumerate(texts):
        at = 0
        while len(text) - at > SEGMENT:  # cut behind a byte that is in no word
            gap = _GAP.search(text, at + SEGMENT // 2)
            end = gap.end() if gap else len(text)
            flush()
            held, size = [(i, text[at:end])], SEGMENT
            at = end
        if size + len(text) - at > SEGMENT:
            flush()
        held.append((i, text[at:]))
        size += len(text) - at + 1
    flush()
    return np.concatenate(numbers), np.concatenate(hashes)


def kept_hashes(number: np.ndarray, word: np.ndarray, span: int, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Of each run of `span` words of one text: the place of its first word, and the smallest hash of its k-grams."""
    k, runs = min(k, span), len(word) - span + 1
    if runs <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    gram = np.zeros(len(word) - k + 1, np.uint64)
    for j in range(k):
        gram = gram * np.uint64(PRIME) + word[j : len(word) - k + 1 + j]
    gram = mixed(gram + np.uint64(span))
    low, wide = gram, 1
    while wide < span - k + 1:  # the smallest of ever wider windows
        step = min(wide, span - k + 1 - wide)
        low, wide = np.minimum(low[: len(low) - step], low[step:]), wide + step
    first = np.flatnonzero(number[:runs] == number[span - 1 :])
    return first, low[first]


def lowered(text: str | None) -> bytes:
    """A-Z in lower case; a word of SEGMENT bytes or more stands as its digest behind the last code point."""
    data = (text or "").encode("utf-8", "replace").translate(_LOWER)
    return data if len(data) < SEGMENT else _LONG.sub(lambda m: "\U0010ffff".encode() + hashlib.sha256(m[0]).hexdigest().encode(), data)


# Items --------------------------------------------------------------------------------------------------------------
def _item_windows(span: int, k: int):
    """Windows of each item: item_id, words (joined by blanks), size, kept (the kept hash)."""

    def run(batches):
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = lowered(text)
                words = _RUN.findall(data)
                size = min(span, len(words))
                if size:
                    first, kept = kept_hashes(*word_hashes([data]), size, k)
                    shown = [b" ".join(words[i : i + size]).decode("utf-8", "replace") for i in first.tolist()]
                    for at in range(0, len(shown), 10_000):
                        part = shown[at : at + 10_000]
                        yield pa.record_batch([pa.array([item] * len(part), pa.string()), pa.array(part), pa.array([size] * len(part), pa.int32()), pa.array(kept[at : at + 10_000].view(np.int64))], names=["item_id", "words", "size", "kept"])

    return run


# Documents ----------------------------------------------------------------------------------------------------------
class Index:
    """Item windows of bounded size: kept hashes by window length, and item ids by the window's words."""

    def __init__(self, windows: list[tuple[str, int, int, list[str]]]):
        self.items = {words.encode(): items for words, _, _, items in windows}
        by_size = defaultdict(set)
        for _, size, kept, _ in windows:
            by_size[size].add(kept)
        self.kept = {size: np.sort(np.array(list(found), np.int64)) for size, found in by_size.items()}
        # most hashes fail at a bit table of their low bits
        self.bits = {}
        for size, found in self.kept.items():
            self.bits[size] = np.zeros(1 << 20, bool)
            self.bits[size][found & 0xFFFFF] = True

    def hits(self, size: int, kept: np.ndarray) -> np.ndarray:
        """Which kept hashes are an item's too."""
        kept, found = kept.view(np.int64), self.kept[size]
        maybe = np.flatnonzero(self.bits[size][kept & 0xFFFFF])
        place = np.minimum(np.searchsorted(found, kept[maybe]), len(found) - 1)
        return maybe[found[place] == kept[maybe]]


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs [begin, end) of words as disjoint ones in order."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(runs):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def _in_groups(batches, most: int = SEGMENT):
    """Columns of rows whose last column, lower-cased texts, has bounded bytes (or is one text)."""
    for batch in batches:
        *others, texts = batch.columns
        others, held, size, begin = [c.to_pylist() for c in others], [], 0, 0
        for i, text in enumerate(map(lowered, (t.as_py() for t in texts))):
            if held and size + len(text) > most:
                yield *(o[begin:i] for o in others), held
                held, size, begin = [], 0, i
            held.append(text)
            size += len(text) + 1
        if held:
            yield *(o[begin:] for o in others), held


SPANS = "array<struct<first:long,end:long>>"
FOUND = f"doc_id long, n_words long, n_hit long, items array<string>, spans {SPANS}"
_SPAN = pa.struct([("first", pa.int64()), ("end", pa.int64())])


def _found_rows(ids: list, counts: list[int], spans: list[list[tuple[int, int]]], items: list[set[str]]):
    return pa.record_batch(
        [
            pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()), pa.array([sorted(x) for x in items], pa.list_(pa.string())),
            pa.array([[{"first": a, "end": b} for a, b in s] for s in spans], pa.list_(_SPAN)),
        ],
        names=["doc_id", "n_words", "n_hit", "items", "spans"],
    )


def _with_index(shared, k: int):
    """Documents (doc_id, text) to their spans and items, against a broadcast index."""

    def run(batches):
        index = Index(shared.value)
        for ids, texts in _in_groups(batches):
            number, word = word_hashes(texts)
            counts = np.bincount(number, minlength=len(texts))
            before = np.cumsum(counts) - counts
            runs, items, words = defaultdict(list), defaultdict(set), {}
            for size in index.kept:
                first, kept = kept_hashes(number, word, size, k)
                for at in first[index.hits(size, kept)].tolist():
                    i = int(number[at])
                    if i not in words:
                        words[i] = _RUN.findall(texts[i])
                    begin = at - int(before[i])
                    if (of := index.items.get(b" ".join(words[i][begin : begin + size]))) is not None:
                        runs[i].append((begin, begin + size))
                        items[i].update(of)
            every = range(len(texts))
            yield _found_rows(ids, counts.tolist(), [merged(runs[i]) if i in runs else [] for i in every], [items.get(i, set()) for i in every])

    return run


def _kept_of(sizes: list[int], k: int):
    """Documents (row, doc_id, text) to row, doc_id, n_words and the distinct kept hashes of each window length."""

    def run(batches):
        for rows, ids, texts in _in_groups(batches):
            number, word = word_hashes(texts)
            counts = np.bincount(number, minlength=len(texts))
            found = [[] for _ in texts]
            for size in sizes:
                first, kept = kept_hashes(number, word, size, k)
                at = np.searchsorted(number[first], np.arange(len(texts) + 1))
                for i in range(len(texts)):
                    found[i] += [{"size": size, "kept": v} for v in np.unique(kept[at[i] : at[i + 1]].view(np.int64)).tolist()]
            kind = pa.list_(pa.struct([("size", pa.int32()), ("kept", pa.int64())]))
            yield pa.record_batch([pa.array(rows, pa.int64()), pa.array(ids, pa.int64()), pa.array(counts), pa.array(found, kind)], names=["row", "doc_id", "n_words", "kept"])

    return run


def _windows_at(k: int):
    """Documents (row, hits: sizes and hashes, text) to the windows around the hits: row, first, size, words."""

    def run(batches):
        for rows, hits, texts in _in_groups(batches):
            out = []
            for row, wanted, text in zip(rows, hits, texts):
                words = _RUN.findall(text)
                number, word = word_hashes([text])
                for size in sorted({h["size"] for h in wanted}):
                    first, kept = kept_hashes(number, word, size, k)
                    among = np.array([h["kept"] for h in wanted if h["size"] == size], np.int64)
                    out += [(row, at, size, b" ".join(words[at : at + size]).decode("utf-8", "replace")) for at in first[np.isin(kept.view(np.int64), among)].tolist()]
            for at in range(0, len(out), 10_000):
                columns = list(zip(*out[at : at + 10_000]))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.string()))], names=["row", "first", "size", "words"])

    return run


def _without_index(texts: DataFrame, windows: DataFrame, k: int) -> DataFrame:
    """The same rows through shuffled joins, for items of any number."""
    sizes = [r["size"] for r in windows.select("size").distinct().collect()]  # as many as a window has words
    docs = write_table(texts.withColumn("row", F.monotonically_increasing_id()), "documents")
    known = write_table(docs.select("row", "doc_id", "text").mapInArrow(_kept_of(sizes, k), "row long, doc_id long, n_words long, kept array<struct<size:int,kept:long>>"), "kept")
    hits = known.select("row", F.explode("kept").alias("h")).select("row", "h.*").join(windows.select("size", "kept").distinct(), ["size", "kept"], "left_semi")
    wanted = hits.groupBy("row").agg(F.collect_list(F.struct("size", "kept")).alias("hits"))  # of one document
    around = docs.join(wanted, "row").select("row", "hits", "text").mapInArrow(_windows_at(k), "row long, first long, size int, words string")
    equal = write_table(around.join(windows.select("words").distinct(), "words", "left_semi"), "equal")
    spans = equal.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("first", (F.col("first") + F.col("size")).alias("end")))).alias("runs"))
    empty = F.array().cast(SPANS)
    grown = F.aggregate("runs", empty, lambda done, r: F.when((F.size(done) > 0) & (r["first"] <= F.get(done, F.size(done) - 1)["end"]), F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(F.get(done, F.size(done) - 1)["first"].alias("first"), F.greatest(F.get(done, F.size(done) - 1)["end"], r["end"]).alias("end"))))).otherwise(F.concat(done, F.array(r))))
    spans = spans.select("row", grown.alias("spans"))
    items = equal.select("row", "words").distinct().join(windows.where("item_id is not null").select("words", "item_id").distinct(), "words").groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    out = known.drop("kept").join(spans, "row", "left").join(items, "row", "left").withColumns({"spans": F.coalesce("spans", empty), "items": F.coalesce("items", F.array().cast("array<string>"))})
    return out.select("doc_id", "n_words", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"]).alias("n_hit"), "items", "spans")


def contaminated(docs: DataFrame, items: DataFrame, span: int = SPAN, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", most_bytes: int = 32 << 20) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted ids), spans (of words, disjoint and in order): a row for each document.

    most_bytes: of the items' windows, as broadcast; beyond it all joins are shuffled.
    """
    windows = items.select(F.col(item_col).cast("string"), F.col(item_text_col).cast("string")).mapInArrow(_item_windows(span, k), "item_id string, words string, size int, kept long")
    windows = write_table(windows.distinct(), "windows")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    held = windows.agg(F.coalesce(F.sum(F.octet_length("words") + F.octet_length(F.coalesce("item_id", F.lit(""))) + 100), F.lit(0)).alias("bytes")).first()["bytes"]
    if held > most_bytes:
        return _without_index(texts, windows, k)
    listed = windows.groupBy("words", "size", "kept").agg(F.collect_list("item_id").alias("items")).collect()  # at most most_bytes
    shared = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in listed])
    return texts.mapInArrow(_with_index(shared, k), FOUND)


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
