"""Near-duplicate classes by BagMinHash over word shingles (operator 7).

A text is the multiset of its shingles of five lower-cased words. BagMinHash: the weight axis of a shingle is cut into
dyadic intervals [0,1), [1,2), [2,4), ... with a Poisson process each, whose rate is the interval's length; a point
has a time, a component of the signature and a place in its interval, and counts if that place lies below the
shingle's multiplicity. Each component keeps its earliest point. Two signatures agree in a component with the
probability of the weighted Jaccard similarity, and large multiplicities cost their logarithm.

Texts with equal multisets are one node. Bands of the signature give buckets. In each bucket all nodes are compared
with two leaders, and verified pairs are merged into components; where a bucket still holds several components, the
nodes outside the largest are compared with all of the bucket, block by block, by signature and then exactly. So no
bucket, however large, is enumerated where its members already belong together, none is capped, and a block emits only
the links that join components. Verification counts the exact overlap of the multisets. Classes are the connected
components.

Texts of fewer than five words are one shingle. Defined results: texts without words (null and empty ones too) are
alike only if identical, null as empty; a very long text is a node like any other, handled by itself; repeated rows are
copies; an empty table gives an empty result; further columns don't matter, whatever their names; ties: a class is named
by its smallest id, and a null id names a class only if all its ids are null.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import drop_table, hot_keys, spread_join, tidy, write_table

WORDS = 5
M, ROWS = 96, 4
PRIME, INVERSE = 0x9E3779B97F4A7C15 | 1, pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64)
_WORD_BYTE = np.array([b > 127 or chr(b).isalnum() or chr(b) == "_" for b in range(256)])
#: Bytes of texts and shingles handled at once.
GROUP_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    out = []
    for base in (PRIME, INVERSE):
        p = np.full(size, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc, shingle hash, multiplicity, sorted by doc and hash."""
    blobs = [t.lower().encode("utf-8", "replace") + b"\n" for t in texts]
    data = np.frombuffer(b"".join(blobs), np.uint8)
    size = max(GROUP_BYTES, 1 << int(len(data)).bit_length())
    up, down = _powers(size)
    is_word = np.concatenate([[False], _WORD_BYTE[data], [False]]).astype(np.int8)
    edge = np.diff(is_word)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64)])
    word = mix((total[end] - total[start]) * down[start])
    ends = np.cumsum([len(b) for b in blobs])
    doc_of_word = np.searchsorted(ends, start, side="right")
    count = np.bincount(doc_of_word, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    n = len(word)
    h = np.zeros(n, np.uint64)
    alive = np.ones(n, bool)
    for k in range(WORDS):
        shifted = np.zeros(n, np.uint64)
        shifted[: max(n - k, 0)] = word[k:]
        here = np.zeros(n, bool)
        here[: max(n - k, 0)] = doc_of_word[k:] == doc_of_word[: max(n - k, 0)]
        alive &= here | (count[doc_of_word] < WORDS)
        h = np.where(here, mix(h * np.uint64(PRIME) + shifted + np.uint64(k + 1)), h)
    short = np.zeros(n, bool)
    short[first[(count > 0) & (count < WORDS)]] = True
    keep = np.where(count[doc_of_word] < WORDS, short, alive)
    doc, h = doc_of_word[keep], h[keep]
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return doc[at], h[at], np.diff(np.append(at, len(h)))


def bagminhash(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, docs: int, m: int = M) -> np.ndarray:
    """docs x m times of the earliest points; infinite for a document without shingles."""
    low, item = [], []
    k = 0
    while True:  # dyadic intervals [0,1), [1,2), [2,4), ... that begin below the multiplicity
        begin = 0 if k == 0 else 1 << (k - 1)
        reach = np.flatnonzero(weight > begin)
        if not len(reach):
            break
        item.append(reach)
        low.append(np.full(len(reach), k))
        k += 1
    out = np.full(docs * m, np.inf)
    if not item:
        return out.reshape(docs, m)
    item, low = np.concatenate(item), np.concatenate(low)
    length = np.where(low == 0, 1.0, 2.0 ** (low - 1.0))
    begin = np.where(low == 0, 0.0, length)
    owner, limit, seed = doc[item], weight[item], mix(h[item] + low.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    time = np.zeros(len(item))
    step = 0
    while len(owner):
        step += 1
        bits = mix(seed + np.uint64(step * 0xA0761D6478BD642F & (1 << 64) - 1))
        time = time - np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / length
        more = mix(bits)
        slot = owner * m + ((more & np.uint64(0xFFFFFFFF)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        place = begin + np.floor((more >> np.uint64(32)).astype(np.float64) * 2.0**-32 * length)
        counts = place < limit
        np.minimum.at(out, slot[counts], time[counts])
        live = np.unique(owner)
        latest = np.zeros(docs)
        latest[live] = out.reshape(docs, m)[live].max(axis=1)
        on = time < latest[owner]  # later points can't be the earliest anywhere
        owner, limit, seed, time, length, begin = (x[on] for x in (owner, limit, seed, time, length, begin))
    return out.reshape(docs, m)


def _groups(texts: list[str]):
    """Slices of the list of bounded total length."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > GROUP_BYTES // 2:
            yield at, i
            at, size = i, 0
        size += len(t) + 1
    if at < len(texts):
        yield at, len(texts)


def fingerprints(texts: list[str], doc: np.ndarray, h: np.ndarray, weight: np.ndarray) -> list[bytes]:
    """128 bits for a multiset of shingles, or for the text where there is none."""
    w = weight.astype(np.uint64)
    sums = [np.zeros(len(texts), np.uint64) for _ in range(2)]
    for k, s in enumerate(sums):
        np.add.at(s, doc, mix(h * np.uint64(2 * k + 3) + w * np.uint64(0xE7037ED1A0B428DB)))
    some = np.bincount(doc, minlength=len(texts)) > 0
    packed = np.stack(sums, axis=1).astype("<u8")
    return [packed[i].tobytes() if some[i] else hashlib.md5(texts[i].encode("utf-8", "replace")).digest() for i in range(len(texts))]


def _sign(batches):
    for batch in batches:
        texts = batch.column(2).to_pylist()
        for a, b in _groups(texts):
            part = texts[a:b]
            doc, h, weight = shingles(part)
            times = bagminhash(doc, h, weight, len(part))
            n = np.bincount(doc, weights=weight, minlength=len(part)).astype(np.int64)
            points = mix(times.view(np.uint64) + np.uint64(1))
            rows = points.reshape(len(part), M // ROWS, ROWS)
            bands = np.zeros(rows.shape[:2], np.uint64)
            for k in range(ROWS):
                bands = mix(bands * np.uint64(PRIME) + rows[:, :, k])
            bands = mix(bands + np.arange(M // ROWS, dtype=np.uint64))
            bands = [x.tolist() if c else [] for x, c in zip(bands.view(np.int64), n)]
            sig = (points >> np.uint64(32)).astype(np.uint32).view(np.int32)
            yield pa.record_batch([batch.column(0)[a:b], batch.column(1)[a:b], pa.array(fingerprints(part, doc, h, weight), pa.binary()), pa.array(n), pa.array(sig.tolist(), pa.list_(pa.int32())), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "row", "node", "n", "sig", "bands"])


def _sets(batches):
    """node, elements: 64-bit hashes of (shingle, which occurrence), so that overlap of sets is overlap of multisets.
    Texts that are not their node's, as a row hash may stand for two texts, are left out."""
    for batch in batches:
        texts, wanted = batch.column(1).to_pylist(), batch.column(0).to_pylist()
        for a, b in _groups(texts):
            doc, h, weight = shingles(texts[a:b])
            own = np.array([x == y for x, y in zip(wanted[a:b], fingerprints(texts[a:b], doc, h, weight))])
            at = np.repeat(np.arange(len(h)), weight * own[doc])
            nth = np.arange(len(at)) - np.repeat(np.cumsum(weight * own[doc]) - weight * own[doc], weight * own[doc])
            element = mix(h[at] + nth.astype(np.uint64) * np.uint64(0x589965CC75374CC3)).view(np.int64)
            cuts = np.concatenate([[0], np.cumsum(np.bincount(doc, weights=weight, minlength=b - a)[own])]).astype(np.int32)
            yield pa.record_batch([batch.column(0)[a:b].filter(pa.array(own)), pa.ListArray.from_arrays(pa.array(cuts), pa.array(element))], names=["node", "elements"])


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) -> node, label: the least node that a path reaches. Labels of neighbours, then labels of labels. A
    node with very many neighbours, or a label of very many nodes, is spread over the tasks."""
    both = write_table(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = write_table(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    hubs = hot_keys(both, "b")
    while True:
        near = spread_join(both, labels.withColumnRenamed("node", "b"), "b", hubs).groupBy("a").agg(F.min("label").alias("near"))
        lower = write_table(labels.join(near, labels.node == near.a).select("node", "label", F.least("label", "near").alias("lower")), "lower")
        jumped = spread_join(lower, labels.select(F.col("node").alias("lower"), F.col("label").alias("far")), "lower")
        after = write_table(jumped.select("node", F.least("lower", "far").alias("label"), (F.least("lower", "far") < F.col("label")).alias("changed")), "labels")
        drop_table(labels)
        drop_table(lower)
        done = after.where("changed").isEmpty()
        labels = after.drop("changed")
        labels.written_to = after.written_to
        if done:
            drop_table(both)
            return labels


def _across(similarity: float, maybe: float):
    """Links between the nodes of two blocks of a bucket that have different labels: signatures first, then the exact
    overlap of the multisets. A pair is judged in the first band that it shares, and not where links join it already."""

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = key[1], key[2]
        left, right = pdf[pdf["block"] == i], pdf[pdf["block"] == j]
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": []})
        band = int(pdf["band"].iloc[0])
        sig_a, sig_b = (np.array(x["sig"].tolist(), np.int32).reshape(-1, M) for x in (left, right))
        n_a, n_b = left["n"].to_numpy(), right["n"].to_numpy()
        nodes_a, nodes_b = left["node"].tolist(), right["node"].tolist()
        labels, places = np.unique(np.array([*left["label"], *right["label"]], object), return_inverse=True)
        root_a, root_b = places[: len(left)], places[len(left) :]
        sizes = [len(x) for side in (left, right) for x in side["elements"]]
        _, codes = np.unique(np.concatenate([*left["elements"], *right["elements"]]), return_inverse=True)
        sets = np.split(codes, np.cumsum(sizes)[:-1])
        mark, found = np.zeros(int(codes.max()) + 1, bool), []
        for x in range(len(left)):
            at = np.flatnonzero((root_b != root_a[x]) & (n_b >= similarity * n_a[x]) & (n_a[x] >= similarity * n_b))
            agree = sig_b[at] == sig_a[x]
            at = at[(agree.sum(axis=1) >= int(maybe * M)) & (agree.reshape(-1, M // ROWS, ROWS).all(axis=2).argmax(axis=1) == band)]
            if not len(at):
                continue
            others = [sets[len(left) + y] for y in at]
            mark[sets[x]] = True
            overlap = np.add.reduceat(mark[np.concatenate(others)].astype(np.int64), np.cumsum([0, *map(len, others)])[:-1])
            mark[sets[x]] = False
            for y in at[overlap >= similarity * (n_a[x] + n_b[at] - overlap)]:
                if root_b[y] != root_a[x]:
                    old, new = root_b[y], root_a[x]
                    places[places == old] = new  # root_a and root_b are views of places
                    found.append((min(nodes_a[x], nodes_b[y]), max(nodes_a[x], nodes_b[y])))
        return pd.DataFrame(found, columns=["a", "b"])

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, maybe: float = 0.6, block: int = 1000, block_elements: int = 1_000_000, broadcast_rows: int = 500_000, row_col: str | None = None) -> DataFrame:
    """One row for each row of docs: doc_id, class_id (smallest id of the class), class_size, kept (the id names the
    class); with row_col, a unique number of each row, also that number and stays (true for one row of each class, of
    the id that names it).

    maybe: pairs whose signatures agree in a smaller share of components aren't verified (at 0.8, almost five standard
    deviations below). block, block_elements: about how many nodes and shingles a task holds of either side.
    broadcast_rows: with more candidates than that, their texts are found by a shuffled join.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), (F.col(row_col).cast("long") if row_col else F.xxhash64(F.col(id_col).cast("long"), text)).alias("row"))
    signed = write_table(rows.select("doc_id", "row", "text").mapInArrow(tidy(_sign), "doc_id long, row long, node binary, n long, sig array<int>, bands array<long>"), "signed")
    # one row stands for the rows of equal multisets
    nodes = write_table(signed.where("n > 0").groupBy("node").agg(F.min("row").alias("row"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands")), "nodes")
    banded = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    sizes = write_table(banded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
    # a bucket may hold a large share of the nodes
    hot = hot_keys(banded, "bucket")
    shared = write_table(spread_join(banded, sizes, "bucket", hot).where("size is not null"), "buckets")
    # the leaders of a bucket: the node with the most company in all its buckets, as one that others derive from has, and the least
    company = shared.groupBy("node").agg(F.sum("size").alias("company"))
    leaders = shared.join(company, "node").groupBy("bucket").agg(F.max(F.struct("company", "node"))["node"].alias("first"), F.min("node").alias("last"))
    facts = nodes.select("node", "n", "sig")

    def alike(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose sizes and signatures allow the similarity."""
        left, right = (facts.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}")) for x in "ab")
        both = pairs.join(left, "a").join(right, "b")
        agree = F.size(F.filter(F.zip_with("sig_a", "sig_b", lambda x, y: x == y), lambda z: z))
        return both.where((F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b")) & (agree >= int(maybe * M))).select("a", "b", "n_a", "n_b")

    def sets_of(some: DataFrame) -> DataFrame:
        """node, elements of the nodes in `some`. The texts come from docs again, only those of candidates."""
        wanted = write_table(some.select("node").distinct().join(nodes.select("node", "row"), "node"), "wanted")
        found = rows.select("row", "text").join(F.broadcast(wanted) if wanted.count() <= broadcast_rows else wanted, "row")
        return write_table(found.select("node", "text").mapInArrow(tidy(_sets), "node binary, elements array<long>"), "sets").dropDuplicates(["node"])

    stars = spread_join(shared.select("bucket", "node"), leaders, "bucket", hot).select("node", F.explode(F.array("first", "last")).alias("leader")).where("node != leader").select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    pairs = write_table(alike(stars), "pairs")
    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")))
    left, right = (sets.select(F.col("node").alias(x), F.col("elements").alias(f"set_{x}")) for x in "ab")
    overlap = F.size(F.array_intersect("set_a", "set_b"))
    links = write_table(pairs.join(left, "a").join(right, "b").where(overlap >= F.lit(similarity) * (F.col("n_a") + F.col("n_b") - overlap)).select("a", "b"), "links")
    labels = components(links)

    # buckets of several components: what is outside the largest meets the whole bucket, in blocks
    placed = shared.join(labels, "node", "left").select("bucket", "band", "node", F.coalesce("label", "node").alias("label"))
    mixed = placed.groupBy("bucket", "label").agg(F.count("*").alias("of_label")).groupBy("bucket").agg(F.max(F.struct("of_label", "label"))["label"].alias("main"), F.sum("of_label").alias("size"), F.count("*").alias("labels")).where("labels > 1 and size > 2").select("bucket", "main")
    inner = spread_join(placed, mixed, "bucket", hot).where("main is not null").select("bucket", "band", "node", "label", (F.col("label") == F.col("main")).alias("inner"))
    spread = write_table(inner.join(facts.select("node", "n"), "node"), "spread")
    parts = lambda inner: F.greatest(F.lit(1), F.ceil(F.greatest(F.count(F.when(F.col("inner") == inner, 1)) / block, F.sum(F.when(F.col("inner") == inner, F.col("n"))) / block_elements))).cast("int")
    blocks = spread.groupBy("bucket").agg(parts(False).alias("outer_blocks"), parts(True).alias("inner_blocks"))
    dealt = spread_join(spread, blocks, "bucket", hot).withColumn("block", F.when(F.col("inner"), F.col("outer_blocks") + F.pmod(F.xxhash64("node"), F.col("inner_blocks"))).otherwise(F.pmod(F.xxhash64("node"), F.col("outer_blocks"))).cast("int"))
    others = F.when(F.col("inner"), F.sequence(F.lit(0), F.col("outer_blocks") - 1)).otherwise(F.sequence(F.lit(0), F.col("outer_blocks") + F.col("inner_blocks") - 1))
    known = facts.select("node", "sig").join(sets_of(spread), "node")
    meeting = dealt.join(known, "node").withColumn("other", F.explode(others)).select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "band", "block", "node", "label", "n", "sig", "elements")
    more = write_table(meeting.groupBy("bucket", "i", "j").applyInPandas(_across(similarity, maybe), "a binary, b binary"), "more")
    labels = components(links.unionByName(more))
    # a row per node, then per class; the rows of one text, and the texts of one class, may be a large share of all
    first = F.min(F.struct(F.col("doc_id").isNull().alias("gone"), "doc_id", "row")).alias("first")
    held = signed.groupBy("node").agg(first, F.count("*").alias("rows")).join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"), "first", "rows")
    held = write_table(held, "held")
    named = held.groupBy("label").agg(F.min("first").alias("first"), F.sum("rows").alias("class_size"))
    of_node = write_table(spread_join(held.select("node", "label"), named, "label").select("node", "first", "class_size"), "classes")
    out = spread_join(signed.select("doc_id", "row", "node"), of_node, "node")
    number = [F.col("row").alias(row_col), (F.col("row") == F.col("first.row")).alias("stays")] if row_col else []
    return out.select("doc_id", F.col("first.doc_id").alias("class_id"), "class_size", F.col("doc_id").eqNullSafe(F.col("first.doc_id")).alias("kept"), *number)
