"""Best-fit packing by a grouping genetic algorithm (operator 3).

Documents become token ids plus an end id; longer ones are cut into full pieces, the first of which may be shorter.
Full pieces fill a sequence alone. The rest are dealt by hash into shards of a bounded number of pieces, and several
islands evolve packings of each shard. A solution's genes are its bins: crossover injects whole well-filled bins of one
parent into the other, removes the bins that would then hold a piece twice, and puts the displaced pieces back best
fit. Between epochs the best solution of an island moves on to the next island of its shard, and of all islands the
best solution counts. An island stops once it reaches the lower bound, ceil(sum of lengths / capacity).

Each shard leaves some bins open, so the pieces of all shards' open bins are dealt anew into far fewer shards and evolve
again, level by level, until one shard is left or the open bins don't get fewer.

Defined results: a null or empty text is one piece that holds the end id only; a very long text is cut into as many
pieces as it needs; repeated rows are packed each; ties between pieces of one length go by their numbers; an empty table
gives an empty result; further columns don't matter, whatever their names. Seeds depend on level, shard, island and
epoch only.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from functools import lru_cache, reduce
from itertools import combinations
from random import Random

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import tidy, write_table
from tallybrook.llm.token_counts import LATIN, segment_pattern

Bin = list[int]
#: One in so many bins, at most, is injected by a crossover, and as many of the worst-filled ones are taken apart; and one
#: in so many takes part in exchanges.
INJECTED, EXCHANGED = 20, 20


class SegmentIds:
    """Little-endian 32-bit ids of texts, by a tokenizer file. A pre-token never crosses the border of two segments, so
    a text's ids are those of its segments one after another, and each distinct segment is encoded once."""

    #: One pre-token, and still one behind another.
    one_word = re.compile(f" [{LATIN}]+").fullmatch

    def __init__(self, path: str, most: int = 500_000, at_once: int = 1000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread
        from tokenizers import Tokenizer

        self.coder, self.most, self.at_once = Tokenizer.from_file(path), most, at_once
        self.segments = segment_pattern([t.content for t in self.coder.get_added_tokens_decoder().values()]).findall
        self.known: dict[str, bytes] = {}

    def learn(self, segments: set[str]) -> None:
        if len(self.known) > self.most:
            self.known = {}
        new = segments.difference(self.known)
        words = [s for s in new if self.one_word(s)]
        for at in range(0, len(words), self.at_once):
            part = words[at : at + self.at_once]
            found = self.coder.encode("".join(part), add_special_tokens=False)
            ids, edges = np.array(found.ids, "<u4").tobytes(), 4 * (np.flatnonzero(np.diff(found.word_ids)) + 1)
            self.known.update(zip(part, (ids[a:b] for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(ids)])), strict=True))
        for s in new.difference(words):
            self.known[s] = np.array(self.coder.encode(s, add_special_tokens=False).ids, "<u4").tobytes()

    def of(self, texts: list[str]) -> list[bytes]:
        parts = [self.segments(t) for t in texts]
        self.learn(set().union(*parts))
        return [b"".join(map(self.known.__getitem__, p)) for p in parts]


@lru_cache(maxsize=2)
def segment_ids(path: str) -> SegmentIds:
    return SegmentIds(path)


def grouped(texts: list[str], chars: int):
    """Slices of the list of about so many characters, and at least one text."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def cut(size: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces; only the first may be short."""
    full, rest = divmod(size, capacity)
    return [rest] * (rest > 0) + [capacity] * full


def _pieces(path: str, end_id: int, capacity: int, keep_segments: bool, group_chars: int = 1 << 20):
    def run(batches):
        coder, end = segment_ids(path) if keep_segments else SegmentIds(path, most=100_000), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in grouped(texts, group_chars):
                at: list[int] = []
                rows: list[tuple] = []
                for i, ids in enumerate(coder.of(texts[a:b]), a):
                    ids, start = ids + end, 0
                    for k, n in enumerate(cut(len(ids) // 4, capacity)):
                        at.append(i)
                        rows.append((k, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)])))
                        start += n
                yield pa.record_batch([batch.column(0).take(pa.array(at)), *(pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.int64())))], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def best_fit(items: list[int], size: np.ndarray | list[int], capacity: int, bins: list[Bin]) -> list[Bin]:
    """Puts items, the largest first, where the least room remains."""
    room = sorted((capacity - sum(size[i] for i in b), k) for k, b in enumerate(bins))
    for i in sorted(items, key=lambda i: (-size[i], i)):
        at = bisect_left(room, (size[i], -1))
        if at == len(room):
            k, left = len(bins), capacity
            bins.append([])
        else:
            left, k = room.pop(at)
        bins[k].append(i)
        if left > size[i]:
            insort(room, (left - size[i], k))
    return bins


def fitness(bins: list[Bin], size, capacity: int) -> tuple[int, float]:
    """Smaller is better: bins, then how evenly they are filled."""
    return len(bins), -sum((sum(size[i] for i in b) / capacity) ** 2 for b in bins)


def exchange(bins: list[Bin], displaced: list[int], size, capacity: int, rounds: int = 2) -> tuple[list[Bin], list[int]]:
    """The bins, fuller where pieces that they hold can be exchanged for displaced ones, and what is displaced then: as
    many or more pieces, but smaller ones. In each round each of the bins with the most room (one in EXCHANGED of all, and 64 at least)
    gives one piece or two for the displaced piece that fills it best, and failing that two pieces for two."""
    free = sorted((size[i], i) for i in displaced)
    for _ in range(rounds):
        gained = False
        filled = sorted(((sum([size[i] for i in x]), k) for k, x in enumerate(bins)))
        for fill, k in filled[: max(64, len(filled) // EXCHANGED)]:
            x, room = bins[k], capacity - fill
            if not room or not free:
                break
            gives = [(i,) for i in x] + list(combinations(x, 2))
            best, move = 0, None
            for out in gives:
                least = sum(size[i] for i in out)
                at = bisect_left(free, (least + room + 1, -1)) - 1
                if at >= 0 and free[at][0] - least > best:
                    best, move = free[at][0] - least, (out, (at,))
            if move is None and len(free) > 1:
                sizes = np.array([n for n, _ in free])
                for out in gives[len(x) :]:
                    least = size[out[0]] + size[out[1]]
                    at = np.minimum(np.searchsorted(sizes, least + room - sizes, "right") - 1, np.arange(len(sizes)) - 1)
                    sums = np.where(at >= 0, sizes + sizes[at], 0)
                    k = int(sums.argmax())
                    if sums[k] - least > best:
                        best, move = int(sums[k]) - least, (out, (k, int(at[k])))
            if move:
                out, taken = move
                into = [free[k][1] for k in taken]
                for k in sorted(taken, reverse=True):
                    del free[k]
                x[:] = [i for i in x if i not in out] + into
                for i in out:
                    insort(free, (size[i], i))
                gained = True
        if not gained:
            break
    return bins, [i for _, i in free]


def crossover(a: list[Bin], b: list[Bin], size, capacity: int, rng: Random) -> list[Bin]:
    """Injects a few well-filled bins of b into a; bins of a that hold any of their items go, and what they alone held is
    displaced, as are the items of some of the worst-filled bins that remain. Displaced pieces are exchanged for smaller
    ones where that fills a bin better, and the rest is put back best fit."""
    ranked = sorted(b, key=lambda x: -sum(size[i] for i in x))
    injected = rng.sample(ranked[: max(1, len(ranked) // 2)], rng.randint(1, max(1, len(ranked) // INJECTED)))
    taken = {i for x in injected for i in x}
    kept, displaced = [], []
    for x in a:
        if taken.isdisjoint(x):
            kept.append(list(x))
        else:
            displaced += [i for i in x if i not in taken]
    kept.sort(key=lambda x: sum(size[i] for i in x))
    worst = rng.randint(1, max(1, len(kept) // INJECTED)) if kept else 0
    displaced += [i for x in kept[:worst] for i in x]
    kept, displaced = exchange(kept[worst:], displaced, size, capacity)
    return best_fit(displaced, size, capacity, [list(x) for x in injected] + kept)


def evolve(population: list[list[Bin]], size, capacity: int, rng: Random, generations: int) -> tuple[list[list[Bin]], int]:
    """The population, best first, and the generations that it took. Steady state: two parents by tournament, their
    child replaces the worst."""
    least, ran = -(-sum(size) // capacity), 0
    scored = sorted(((fitness(p, size, capacity), k, p) for k, p in enumerate(population)), key=lambda x: x[:2])
    for g in range(generations):
        if scored[0][0][0] <= least:
            break
        pick = lambda: min(rng.sample(scored, min(2, len(scored))), key=lambda x: x[:2])[2]
        child = crossover(pick(), pick(), size, capacity, rng)
        scored[-1] = (fitness(child, size, capacity), len(population) + g, child)
        scored.sort(key=lambda x: x[:2])
        ran += 1
    return [x[2] for x in scored], ran


def seeds(size, capacity: int, rng: Random, count: int) -> list[list[Bin]]:
    """Best fit decreasing, then best fit over groups of items in random order."""
    first = best_fit(list(range(len(size))), size, capacity, [])
    out = [first]
    while len(out) < count and len(first) > -(-sum(size) // capacity):
        items, bins = rng.sample(range(len(size)), len(size)), []
        for k in range(0, len(items), max(1, len(items) // 4)):
            best_fit(items[k : k + max(1, len(items) // 4)], size, capacity, bins)
        out.append(bins)
    return out


def _epoch(capacity: int, name: str, generations: int):
    """An island's rows hold its own pieces with the bins of its elite and of the elite that moved here (-1: none)."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("item", kind="stable")
        size, rng = pdf["length"].tolist(), Random(f"{key[0]}/{key[1]}/{name}")
        population = []
        for column in ("bin", "moved"):
            if pdf[column].iloc[0] >= 0:
                by_bin: dict[int, Bin] = {}
                for i, b in enumerate(pdf[column].tolist()):
                    by_bin.setdefault(b, []).append(i)
                population.append(list(by_bin.values()))
        least = -(-sum(size) // capacity)
        if not population or len(population[0]) > least:
            population += seeds(size, capacity, rng, 6)
        (best, *_), ran = evolve(population, size, capacity, rng, generations)
        at = np.empty(len(size), "int64")
        for k, items in enumerate(best):
            at[items] = k
        return pdf.assign(bin=at, moved=-1, over=len(best) - least, generations=pdf["generations"] + ran)

    return run


_ISLAND = "shard long, island int, item long, length long, bin long, moved long, over long, generations long"


def evolved(pieces: DataFrame, name: str, capacity: int, shards: int, islands: int, epochs: int, generations: int) -> DataFrame:
    """item, length, shard, bin, generations: each shard's best packing, and the generations that its island ran."""
    none = F.lit(-1).cast("long")
    state = pieces.select(F.pmod(F.xxhash64("item", F.lit(name)), F.lit(shards)).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "item", "length", none.alias("bin"), none.alias("moved"), none.alias("over"), F.lit(0).cast("long").alias("generations"))
    done, columns = [], state.columns
    for epoch in range(epochs):
        if epoch:  # each island's elite moves to the next island of its shard
            guests = state.select("shard", F.pmod(F.col("island") + 1, F.lit(islands)).cast("int").alias("island"), "item", F.col("bin").alias("moved"))
            state = state.drop("moved").join(guests, ["shard", "island", "item"]).select(*columns)
        state = write_table(state.groupBy("shard", "island").applyInPandas(_epoch(capacity, f"{name}/{epoch}", generations), _ISLAND), "islands")
        # shards that meet their bound are done
        unmet = state.groupBy("shard").agg(F.min("over").alias("least")).where("least > 0").select("shard")
        if epoch == epochs - 1 or unmet.isEmpty():
            done.append(state)
            break
        unmet = write_table(unmet, "unmet")
        done.append(state.join(unmet, "shard", "left_anti"))
        state = state.join(unmet, "shard", "left_semi")
    every = reduce(DataFrame.unionByName, done)
    best = every.groupBy("shard").agg(F.min_by("island", F.struct("over", "island")).alias("island"))
    return every.join(best, ["shard", "island"]).select("item", "length", "shard", "bin", "generations")


def pack(pieces: DataFrame, capacity: int = 2048, shard_pieces: int = 4096, islands: int = 2, epochs: int = 3, generations: int = 12) -> DataFrame:
    """pieces(item long, unique; length long) -> item, sequence_id, offset, generations for pieces shorter than
    capacity. generations: those of the island that placed the piece."""
    placed, level = [], 0
    #: A bin is open below one of these fills: the first with which at most half of the pieces stay in play.
    fills = [capacity, capacity - capacity // 256, capacity - capacity // 64, capacity - capacity // 16]
    while True:
        n = pieces.count()
        shards = max(1, -(-n // shard_pieces))
        found = write_table(evolved(pieces, str(level), capacity, shards, islands, epochs, generations), "packed")
        number = F.lit(level << 56) + F.shiftleft("shard", 20) + F.col("bin")
        found = found.withColumn("sequence_id", number)
        filled = found.groupBy("sequence_id").agg(F.sum("length").alias("fill"), F.count("*").alias("items"))
        open_below = None
        if shards > 1 and level < 60:
            counts = filled.agg(*(F.sum(F.when(F.col("fill") < f, F.col("items")).otherwise(0)).alias(f"below_{k}") for k, f in enumerate(fills))).first()
            open_below = next((f for f, items in zip(fills, counts) if 0 < items <= n // 2), None)
        if open_below is None:
            placed.append(found)
            break
        marked = write_table(found.join(filled.select("sequence_id", "fill"), "sequence_id"), "levels")
        placed.append(marked.where(F.col("fill") >= open_below).drop("fill"))
        pieces = marked.where(F.col("fill") < open_below).select("item", "length")
        level += 1
    inside = Window.partitionBy("sequence_id").orderBy("item").rowsBetween(Window.unboundedPreceding, -1)
    return reduce(DataFrame.unionByName, placed).select("item", "sequence_id", F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset"), "generations")


def pack_documents(docs: DataFrame, path: str, end_id: int = 0, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", keep_segments: bool = True, **options) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, generations (0 for pieces
    that fill a sequence).

    path: a tokenizer file that every executor has. keep_segments: Python workers keep the tokenizer and the ids of known
    segments (up to about 200 MB each) for their next task, which spares time; where they have other work too, they
    hold a fifth of the segments at most, and none between tasks.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    cut_up = rows.mapInArrow(tidy(_pieces(path, end_id, capacity, keep_segments)), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")
    # the item numbers of the written table hold from then on
    pieces = write_table(cut_up.withColumn("item", F.monotonically_increasing_id()), "pieces")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    none = F.lit(0).cast("long")
    whole = pieces.where(F.col("length") == capacity).select(*columns, (-1 - F.col("item")).alias("sequence_id"), none.alias("offset"), none.alias("generations"))
    rest = pieces.where(F.col("length") < capacity)
    placed = rest.join(pack(rest.select("item", "length"), capacity, **options), "item")
    return whole.unionByName(placed.select(*columns, "sequence_id", "offset", "generations"))
