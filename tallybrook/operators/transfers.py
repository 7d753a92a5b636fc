"""Transfers between own accounts.

The greedy one-to-one matching depends on load order: each outgoing row takes the first incoming row that is free. A
pair never leaves a run of amounts that lie less than the tolerance apart (an island), nor, inside it, a run of times
without a gap of more than the allowed days; so each such run is matched by itself. Legs are sent there once, never
pairs: inside a run, free incoming legs wait in queues by amount, slot of time and account, and an outgoing leg looks at
the heads of the queues only.

A long run is cut into slots of the allowed days. As both sides prefer the earlier leg, the greedy matching is the one
stable matching, which deferred acceptance finds in any order of proposals: each slot matches its outgoing legs with the
incoming ones of its own and the two next slots; an incoming leg that several slots claim keeps the earliest outgoing
one; and the slots that lost a leg match again, where legs that others hold take none but earlier ones. Rounds go on
until no claim is lost. So a task holds three slots of a run.

`candidates` lists the pairs that the amounts, times and accounts allow, for reports."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.schema import TOLERANCE
from tallybrook.tables import beside, drop_table, numbered, write_table

DAYS = 3
DAY = 86_400_000_000
BLOCK = 4096
#: A slot of time is this part of the days that two legs may lie apart.
SLOTS = 12
#: A run of more legs is matched by slots, in rounds.
LONG_RUN = 20_000


def legs(ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Outgoing and incoming rows; micros is the time in microseconds. Rows without a place in the load order, which
    decides between partners, are refused."""
    seq = F.coalesce("seq", F.raise_error(F.lit("a ledger row has no load order (seq)")).cast("long"))
    base = ledger.select(seq.alias("seq"), "txn_id", F.coalesce("own_account", F.lit("")).alias("account"), "income", "expense", F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', txn_time)").alias("micros"))
    side = lambda c: base.where(F.col(c) > 0).withColumn("size", F.col(c))
    return side("expense"), side("income")


def candidates(ledger: DataFrame, days: int = DAYS) -> DataFrame:
    """out_id, in_id, out_seq, in_seq, size, in_size: amounts agree, accounts differ, and the times lie `days` apart at
    most. An outgoing row without a time fits any; an incoming one without a time fits only such."""
    out, into = legs(ledger)
    cents = F.floor(F.col("size") * 100)
    left = out.select(F.col("seq").alias("out_seq"), F.col("txn_id").alias("out_id"), F.col("account").alias("out_account"), F.col("micros").alias("out_micros"), "size", F.explode(F.array(cents - 1, cents, cents + 1)).alias("cents"))
    right = into.select(F.col("seq").alias("in_seq"), F.col("txn_id").alias("in_id"), F.col("account").alias("in_account"), F.col("micros").alias("in_micros"), F.col("size").alias("in_size"), cents.alias("cents"))
    close = F.col("out_micros").isNull() | (F.abs(F.col("out_micros") - F.col("in_micros")) <= days * DAY)
    return left.join(right, "cents").where((F.abs(F.col("size") - F.col("in_size")) < TOLERANCE) & (F.col("out_account") != F.col("in_account")) & close).drop("cents")


def islands(amounts: DataFrame) -> DataFrame:
    """amounts(size) -> cents, island: whole cents in one island if their amounts come within the tolerance. Runs are
    found in blocks of cents and carried over the borders."""
    cents = amounts.groupBy(F.floor(F.col("size") * 100).alias("cents")).agg(F.min("size").alias("low"), F.max("size").alias("high"))
    block = F.floor(F.col("cents") / BLOCK)
    above = cents.select((F.col("cents") + 1).alias("cents"), F.col("high").alias("below"))
    starts = cents.join(above, "cents", "left").withColumn("start", F.when(F.coalesce(F.col("low") - F.col("below") >= TOLERANCE, F.lit(True)), F.col("cents"))).withColumn("block", block)
    carried = starts.groupBy("block").agg(F.max("start").alias("newest")).select("block", F.last("newest", True).over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    inside = F.last("start", True).over(Window.partitionBy("block").orderBy("cents"))
    return starts.withColumn("inside", inside).join(carried, "block").select("cents", F.coalesce("inside", "carried").alias("island"))


def runs(ledger: DataFrame, days: int = DAYS) -> DataFrame:
    """Legs (side, seq, txn_id, account, micros, size) with island and run. Where an outgoing leg of an island has no
    time, it fits any incoming one, so the island is one run; elsewhere legs without a time fit none and are left out."""
    out, into = (df.select(F.lit(side).alias("side"), "seq", "txn_id", "account", "micros", "size", F.floor(F.col("size") * 100).alias("cents")) for side, df in zip("oi", legs(ledger)))
    both = out.unionByName(into)
    placed = write_table(both.join(islands(both), "cents").drop("cents").withColumn("day", F.floor(F.col("micros") / DAY)), "legs")
    kinds = placed.groupBy("island").agg(F.count_distinct("side").alias("sides"), F.bool_or((F.col("side") == "o") & F.col("micros").isNull()).alias("whole")).where("sides = 2").drop("sides")
    # runs of times, from the days of an island
    by_day = placed.where("day is not null").groupBy("island", "day").agg(F.min("micros").alias("low"), F.max("micros").alias("high"))
    order = Window.partitionBy("island").orderBy("day")
    starts = by_day.withColumn("start", F.when(F.coalesce(F.col("low") - F.lag("high").over(order) > days * DAY, F.lit(True)), F.col("day")))
    run_of = starts.select("island", "day", F.last("start", True).over(order).alias("run"))
    marked = placed.join(kinds, "island").join(run_of, ["island", "day"], "left").where("whole or run is not null")
    return marked.select("side", "seq", "txn_id", "account", "micros", "size", "island", F.when(~F.col("whole"), F.col("run")).alias("run"))


class Waiting:
    """Free incoming legs (seq, number, micros, account, txn_id) of one amount, in queues by slot of time and account. A
    slot's heap holds the head of each of its queues, so the two smallest tell the first leg of another account."""

    def __init__(self, legs: list[tuple], slot: int):
        self.slot = slot
        self.queues: dict = defaultdict(lambda: defaultdict(list))
        for leg in sorted(legs, reverse=True):  # a queue's head is its last
            self.queues[self._slot(leg)][leg[3]].append(leg)
        self.heads = {at: [q[-1] for q in by_account.values()] for at, by_account in self.queues.items()}
        for heap in self.heads.values():
            heapify(heap)

    def _slot(self, leg: tuple) -> int | None:
        return None if leg[2] is None else leg[2] // self.slot

    def first(self, account: str, micros: int | None, reach: int) -> tuple | None:
        """The first free leg of another account within reach; any, if there is no time."""
        if micros is None:
            slots, ends = list(self.heads), ()
        else:
            ends = ((micros - reach) // self.slot, (micros + reach) // self.slot)
            slots = [at for at in range(ends[0], ends[1] + 1) if at in self.heads]
        best = None
        for at in slots:
            heap = self.heads[at]
            if best is not None and heap[0] > best:
                continue
            if at in ends:  # within reach in part
                for name, queue in self.queues[at].items():
                    if name != account:
                        for leg in reversed(queue):
                            if best is not None and leg > best:
                                break
                            if abs(leg[2] - micros) <= reach:
                                best = leg
                                break
            else:
                found = min((leg for leg in heap[:3] if leg[3] != account), default=None)
                if found and (best is None or found < best):
                    best = found
        return best

    def take(self, leg: tuple) -> None:
        at = self._slot(leg)
        queue, heap = self.queues[at][leg[3]], self.heads[at]
        if queue[-1] is not leg:
            queue.remove(leg)
            return
        queue.pop()
        if heap[0] is leg:
            heappop(heap)
        else:
            heap.remove(leg)
            heapify(heap)
        if queue:
            heappush(heap, queue[-1])
        else:
            del self.queues[at][leg[3]]
        if not heap:
            del self.heads[at], self.queues[at]


def matched_run(out: list[tuple], into: dict[float, list[tuple]], reach: int, held: dict[int, int] | None = None) -> list[tuple]:
    """out: (seq, micros, account, txn_id, size); into: legs by amount. Pairs of outgoing and incoming legs. held: of
    incoming legs (by seq) the outgoing one that another slot has for it; only earlier ones may take it."""
    waiting = {size: Waiting(legs, max(1, reach // SLOTS)) for size, legs in into.items()}
    closing = [(held[leg[0]], leg, size) for size, legs in into.items() for leg in legs if leg[0] in held] if held else []
    heapify(closing)
    pairs, taken = [], set()
    for leg in sorted(out, key=lambda x: x[0]):
        while closing and closing[0][0] < leg[0]:
            _, gone, size = heappop(closing)
            if gone[0] not in taken:
                waiting[size].take(gone)
        near = [(found, size) for size, w in waiting.items() if abs(size - leg[4]) < TOLERANCE and (found := w.first(leg[2], leg[1], reach))]
        if near:
            found, size = min(near, key=lambda x: x[0][:2])
            waiting[size].take(found)
            taken.add(found[0])
            pairs.append((leg, found))
    return pairs


PAIRS = "island long, run long, home long, out_seq long, in_seq long, out_id string, in_id string, size double"


def _match(days: int):
    columns = ("island", "run", "home", "side", "seq", "micros", "account", "txn_id", "size", "held")
    whole = lambda x: None if x is None or x != x else int(x)

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (row for pdf in pdfs for row in zip(*(pdf[c].tolist() for c in columns)))
        for (island, part, home), legs_of in groupby(rows, key=lambda r: (r[0], whole(r[1]), whole(r[2]))):
            out, into, held = [], defaultdict(list), {}
            for n, (*_, side, seq, micros, account, txn, size, holder) in enumerate(legs_of):
                if side == "o":
                    out.append((seq, whole(micros), account, txn, size))
                else:
                    into[size].append((seq, n, whole(micros), account, txn))
                    if whole(holder) is not None:
                        held[seq] = int(holder)
            if pairs := matched_run(out, into, days * DAY, held):
                yield pd.DataFrame([(island, part, home, o[0], i[0], o[3], i[4], o[4]) for o, i in pairs], columns=PAIRS.replace(",", "").split()[::2]).astype({"run": "Int64", "home": "Int64"})

    return run


def _matched(legs: DataFrame, days: int) -> DataFrame:
    """Whole groups lie side by side in a partition, and a task holds one at a time."""
    keys = ["island", "run", "home"]
    return legs.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(_match(days), PAIRS)


def _by_slots(legs: DataFrame, days: int) -> tuple[DataFrame, int]:
    """Pairs of long runs, and the rounds that it took."""
    keys = ["island", "run", "home"]
    slot = F.floor(F.col("micros") / (days * DAY))
    seen_by = F.when(F.col("side") == "o", F.array(slot)).otherwise(F.array(slot - 1, slot, slot + 1))
    blocks = write_table(legs.withColumn("home", F.explode(seen_by)), "slots")
    claims = write_table(_matched(blocks.withColumn("held", F.lit(None).cast("long")), days), "claims")
    rounds = 1
    while True:
        holders = claims.groupBy("in_seq").agg(F.min(F.struct("out_seq", "home")).alias("h")).select("in_seq", F.col("h.out_seq").alias("first"), F.col("h.home").alias("of"))
        lost = write_table(claims.join(holders, "in_seq").where("out_seq != first").select(*keys).distinct(), "lost")
        if lost.isEmpty():
            return claims, rounds
        again = blocks.join(beside(lost), keys, "left_semi")
        known = again.join(holders, again.seq == holders.in_seq, "left").withColumn("held", F.when((F.col("side") == "i") & (F.col("of") != F.col("home")), F.col("first"))).drop("in_seq", "first", "of")
        kept = claims.join(beside(lost), keys, "left_anti")
        newer = write_table(kept.unionByName(_matched(known, days)), "claims")
        drop_table(claims)
        claims, rounds = newer, rounds + 1


def self_transfers(ledger: DataFrame, self_accounts: list[str] | None = None, days: int = DAYS, long_run: int = LONG_RUN) -> DataFrame:
    """out_id, in_id, size, confidence (0.85 if a leg's counterparty is an own name or account, else 0.5), transfer_id.
    Runs of more than long_run legs, all with times, go by slots."""
    placed = write_table(runs(ledger, days), "runs")
    long = write_table(placed.where("run is not null").groupBy("island", "run").agg(F.count("*").alias("n")).where(F.col("n") > long_run).select("island", "run"), "long")
    rest = placed.withColumns({"home": F.lit(None).cast("long"), "held": F.lit(None).cast("long")})
    if long.isEmpty():
        matched, rounds = write_table(_matched(rest, days), "matched"), 0
    else:
        by_slots, rounds = _by_slots(placed.join(beside(long), ["island", "run"], "left_semi"), days)
        matched = write_table(_matched(rest.join(beside(long), ["island", "run"], "left_anti"), days).unionByName(by_slots), "matched")
    own = own_marks(ledger, self_accounts)
    marks = matched.join(own.select(F.col("seq").alias("out_seq"), F.col("is_self").alias("a")), "out_seq", "left").join(own.select(F.col("seq").alias("in_seq"), F.col("is_self").alias("b")), "in_seq", "left")
    ranked = numbered(marks, [F.col("out_seq")], "_rank")
    found = ranked.select("out_id", "in_id", "out_seq", "in_seq", "size", F.when(F.coalesce("a", F.lit(False)) | F.coalesce("b", F.lit(False)), 0.85).otherwise(0.5).alias("confidence"), F.format_string("INT-%04d", "_rank").alias("transfer_id"))
    found.rounds = rounds
    return found


def own_marks(ledger: DataFrame, self_accounts: list[str] | None = None) -> DataFrame:
    """seq, is_self: whether the counterparty is one of the own names or accounts (two equi-joins, no OR)."""
    names = ledger.where(F.coalesce("own_name", F.lit("")) != "").select(F.col("own_name").alias("opp_name")).distinct().withColumn("by_name", F.lit(True))
    accounts = ledger.where(F.coalesce("own_account", F.lit("")) != "").select(F.col("own_account").alias("opp_account"))
    if self_accounts:
        accounts = accounts.unionByName(ledger.sparkSession.createDataFrame([(a,) for a in self_accounts], "opp_account string"))
    accounts = accounts.distinct().withColumn("by_account", F.lit(True))
    rows = ledger.select("seq", "opp_name", "opp_account").join(names, "opp_name", "left").join(accounts, "opp_account", "left")
    return rows.select("seq", F.coalesce("by_name", "by_account", F.lit(False)).alias("is_self"))
