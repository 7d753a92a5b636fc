"""Exact top-k search by distributed histogram selection (operator 9).

Vectors are made integer; queries and candidates are cut into blocks, and a task scores one block of each. The kth best
score of each query is found in histograms: a query's range begins with all scores that its length and the longest
vector allow, each task counts all its scores in bins of that range, the counts add up over all blocks, and the bin that
holds the kth is the next range. A block reports its bins from the top down to the one that holds its own kth score, as
the global kth can't be lower. Queries whose bin is one value wide, or above whose range few scores lie, are settled;
the others are scored against narrower ranges again. Then every block is scored once more, and only scores in or above a
query's range leave it; of those equal to its lower end the ones with the smallest ids. On what is left the histograms
are refined until the range is one value wide. Scores above the kth value stay, those equal to it are ranked by id.

Scores are exact 64-bit integers: blocks whose norms keep all sums below 2^53 are multiplied in floating point, others
modulo 2^64, and what may lie beyond 64 bits by itself in unbounded integers. Such a score counts as the largest or
smallest long; where it would be part of the result, the query stops, as its column can't hold it.

Defined results: vectors that are null, or hold null or non-finite components, and rows without an id take no part;
vectors of different lengths aren't compared; every row is a query of its own and a candidate of all others, also where
ids repeat; ties go to the smaller id; fewer than k candidates are all returned; an empty table gives an empty result;
further columns don't matter, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import drop_table, write_table

EXACT, TOP = 1 << 53, (1 << 63) - 1


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id, q (array of double, integers), dim, of the vectors that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).where("vec_id is not null and v is not null")
    sound = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    scaled = F.transform("v", lambda x: F.lit(float(scale)) * x.cast("double"))
    # numbers of that size are whole, and floor would make longs of them
    floors = F.transform(scaled, lambda x: F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x))
    return rows.where(F.coalesce(sound, F.lit(True))).select("vec_id", floors.alias("q"), F.size("v").alias("dim"))


def _wrapped(x: np.ndarray) -> np.ndarray:
    """Whole numbers modulo 2^64."""
    return np.array([int(v) & (1 << 64) - 1 for v in x.ravel().tolist()], np.uint64).reshape(x.shape)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of whole numbers, as longs; beyond 64 bits the largest or smallest one."""
    guess = a @ b.T
    norms = np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None, :]
    if not norms.size or norms.max() < EXACT:
        return guess.astype(np.int64)
    out = (_wrapped(a) @ _wrapped(b).T).view(np.int64)
    # where the guess, give or take its error, may be beyond 64 bits
    for i, j in np.argwhere(np.abs(guess) + norms * (a.shape[1] + 2) * 2.0**-52 >= 2.0**63).tolist():
        exact = sum(int(x) * int(y) for x, y in zip(a[i].tolist(), b[j].tolist()))
        out[i, j] = max(-TOP, min(TOP, exact))
    return out


def _scored(left: pd.DataFrame, right: pd.DataFrame):
    """By query of a block: its row, and its candidates' places in their block with their scores."""
    if len(left) and len(right):
        a, b = (np.array(x["q"].tolist(), float).reshape(len(x), -1) for x in (left, right))
        rows = right["row"].to_numpy()
        for scores, query in zip(products(a, b), left.itertuples(index=False)):
            at = np.flatnonzero((rows != query.row) & (scores >= query.low))
            yield query, at, scores[at]


def _frame(parts: list[dict], columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame({c: np.concatenate([np.broadcast_to(p[c], p["n_rows"]) for p in parts]) if parts else [] for c in columns}).astype("int64")


def _counted(k: int, bins: int):
    """Each query's scores of a block counted in the bins of its range, from the top to the block's kth; `bins`: above it."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for query, _, scores in _scored(left, right):
            above = scores.view(np.uint64) - np.array([query.low], np.int64).view(np.uint64)  # modulo 2^64, as it may exceed a long
            n = np.bincount(np.minimum(above // np.uint64(query.width), np.uint64(bins)).astype(np.int64), minlength=bins + 1)
            higher = n[::-1].cumsum()[::-1] - n
            found = np.flatnonzero((n > 0) & (higher < k))
            parts.append({"row": query.row, "bin": found, "n": n[found], "n_rows": len(found)})
        return _frame(parts, ["row", "bin", "n"])

    return run


def _kept(k: int):
    """Each query's scores of a block in or above its range; of those equal to its lower end the k with the smallest ids."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        parts, ids = [], right["vec_id"].to_numpy()
        for query, at, scores in _scored(left, right):
            equal = np.flatnonzero(scores == query.low)
            keep = np.concatenate([np.flatnonzero(scores > query.low), equal[np.argsort(ids[at[equal]], kind="stable")[:k]]])
            parts.append({"row": query.row, "query_id": query.vec_id, "vec_id": ids[at[keep]], "score": scores[keep], "n_rows": len(keep)})
        return _frame(parts, ["row", "query_id", "vec_id", "score"])

    return run


def ranges_of(queries: DataFrame, score, k: int, bins: int, settled_at: int) -> DataFrame:
    """queries(row, low, width) -> row, low, width: for each query a range that holds its kth best score in its bin at the
    lower end; at most settled_at scores lie in or above it, or the bin is one value wide. score: scores such ranges."""
    ranges = write_table(queries.withColumn("settled", F.lit(False)), "ranges")
    while not ranges.where("not settled").isEmpty():
        counts = score(ranges.where("not settled"), _counted(k, bins), "row long, bin long, n long").groupBy("row", "bin").agg(F.sum("n").alias("n"))
        from_top = counts.withColumn("seen", F.sum("n").over(Window.partitionBy("row").orderBy(F.desc("bin"))))
        found = from_top.where((F.col("seen") >= k) & (F.col("seen") - F.col("n") < k)).select("row", "bin", "seen")
        low = (F.col("low").cast("decimal(20,0)") + F.coalesce("bin", F.lit(0)) * F.col("width").cast("decimal(20,0)")).cast("long")
        met = F.col("settled") | F.col("bin").isNull() | (F.col("seen") <= settled_at) | (F.col("width") == 1)
        narrower = write_table(ranges.join(found, "row", "left").select("row", low.alias("low"), F.ceil(F.col("width") / bins).cast("long").alias("width"), met.alias("settled")), "ranges")
        drop_table(ranges)
        ranges = narrower
    return ranges


def kth_values(scores: DataFrame, k: int, bins: int) -> DataFrame:
    """scores(row, score) -> row, kth: each row's kth highest score, its least one where it has fewer than k."""
    scores = scores.select("row", F.col("score").cast("decimal(20,0)").alias("score"))  # differences of longs
    width = lambda span: F.greatest(F.lit(1), F.ceil(span / bins)).cast("decimal(20,0)")
    ends = scores.groupBy("row").agg(F.min("score").alias("low"), F.max("score").alias("high"))
    ranges = write_table(ends.select("row", "low", width(F.col("high") - F.col("low") + 1).alias("width")), "ranges")
    while True:
        at = F.least(F.floor((F.col("score") - F.col("low")) / F.col("width")).cast("long"), F.lit(bins))  # bin `bins`: above the range
        counts = scores.join(ranges, "row").where("score >= low").groupBy("row", at.alias("bin")).agg(F.count("*").alias("n"))
        from_top = counts.withColumn("seen", F.sum("n").over(Window.partitionBy("row").orderBy(F.desc("bin"))))
        found = from_top.where((F.col("seen") >= k) & (F.col("seen") - F.col("n") < k)).select("row", "bin")
        low = (F.col("low") + F.coalesce("bin", F.lit(0)) * F.col("width")).cast("decimal(20,0)")
        narrower = write_table(ranges.join(found, "row", "left").select("row", low.alias("low"), width(F.col("width")).alias("width"), (F.col("width") == 1).alias("done")), "ranges")
        drop_table(ranges)
        if narrower.where("not done").isEmpty():
            return narrower.select("row", F.col("low").cast("long").alias("kth"))
        ranges = narrower.drop("done")
        ranges.written_to = narrower.written_to


def top_k(vectors: DataFrame, is_query, k: int = 5, block: int = 1024, query_block: int = 1024, bins: int = 1024, settled_at: int = 256, **columns) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest integer inner products, ties to the smaller vec_id.

    is_query: a condition on vec_id. settled_at: how many scores, at least k, may leave the blocks for a query, besides
    those equal to its kth.
    """
    # the row numbers of the written table hold from then on
    table = write_table(quantised(vectors, **columns).withColumn("row", F.monotonically_increasing_id()), "vectors")
    norm = F.sqrt(F.aggregate("q", F.lit(0.0), lambda total, x: total + x * x))
    size = table.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("queries"), F.max(norm).alias("longest")).first()
    blocks, query_blocks = max(1, -(-size["n"] // block)), max(1, -(-size["queries"] // query_block))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))
    dealt = lambda n: F.pmod(F.xxhash64("row"), F.lit(n))
    candidates = table.select("row", "vec_id", "q", "dim", dealt(blocks).alias("c"), numbers(query_blocks).alias("b"))

    def score(ranges: DataFrame, run, schema: str) -> DataFrame:
        asked = table.sparkSession.read.schema(table.schema).parquet(table.written_to)  # columns of its own, beside the candidates'
        queries = asked.where(is_query).join(ranges.select("row", "low", "width"), "row")
        queries = queries.select("row", "vec_id", "q", "dim", "low", "width", dealt(query_blocks).alias("b"), numbers(blocks).alias("c"))
        return queries.groupBy("dim", "b", "c").cogroup(candidates.groupBy("dim", "b", "c")).applyInPandas(run, schema)

    # no inner product is larger than the product of the lengths
    reach = norm * F.lit(size["longest"] or 0.0) * (1 + 1e-9) + 1
    reach = F.when(reach < 2.0**62, F.ceil(F.least(reach, F.lit(2.0**62)))).otherwise(F.lit(TOP)).cast("decimal(20,0)")
    width = F.ceil((2 * reach + 1) / bins)
    ranges = ranges_of(table.where(is_query).select("row", (-reach).cast("long").alias("low"), width.cast("long").alias("width")), score, k, bins, settled_at)
    scores = write_table(score(ranges, _kept(k), "row long, query_id long, vec_id long, score long"), "scores")
    drop_table(ranges)
    kept = scores.join(kth_values(scores, k, bins), "row").where("score >= kth")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    held = F.when(F.abs("score") < TOP, F.col("score")).otherwise(F.raise_error(F.lit("a score of the result is beyond 64 bits")).cast("long"))
    return kept.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k).withColumn("score", held)
