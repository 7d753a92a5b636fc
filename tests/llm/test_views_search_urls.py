import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybrook.llm import chat_views, topk, url_filters
from tallybrook.llm.queries import RULES


@pytest.mark.parametrize(("block", "queries", "bins", "settled_at"), [(4096, 1024, 1024, 256), (7, 3, 4, 5)])
def test_top_k_matches_brute_force(spark, block, queries, bins, settled_at):
    rng = random.Random(12)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(120)] + [(i, [0.5, 0.5, 0.25, 0.0]) for i in range(120, 160)]
    rows += [(500, None), (501, [float("nan"), 1.0, 1.0, 1.0]), (502, [1.0, None, 1.0, 1.0]), (503, [float("inf")] * 4), (510, [1.0, 2.0]), (None, [1.0] * 4), (130, [0.5, 0.5, 0.25, 0.0])]
    rows.append((560, [3.0, 1.0]))
    table = spark.createDataFrame([(i, v, "q") for i, v in rows], "vec_id long, embedding array<float>, q string")
    sound = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    assert search(table, block, queries, bins, settled_at) == brute_top_k(sound)


def test_histograms_of_all_scores_select_what_leaves_the_blocks(spark):
    """Several blocks: a range with its few scores for each query, found in rounds, although a third of the rows are alike."""
    rng = random.Random(21)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(200)] + [(i, [0.9, 0.9, 0.9]) for i in range(200, 300)]
    vectors = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).withColumn("row", F.col("vec_id")).cache()
    scored = []

    def score(ranges, run, schema):
        scored.append(ranges.count())
        asked = ranges.join(vectors.select("row", F.col("q").alias("mine")), "row")
        blocks = asked.crossJoin(spark.range(4).withColumnRenamed("id", "c")).select("row", "low", "width", F.col("mine").alias("q"), "c", F.col("row").alias("vec_id"))
        return blocks.groupBy("c").cogroup(vectors.withColumn("c", F.col("row") % 4).groupBy("c")).applyInPandas(run, schema)

    top = 1 << 20
    asked = vectors.where("row % 10 = 0").select("row", F.lit(-top).cast("long").alias("low"), F.lit(-(-(2 * top + 1) // 16)).cast("long").alias("width"))
    got = {r["row"]: r for r in topk.ranges_of(asked, score, 5, 16, 20).collect()}
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    for i, r in got.items():
        scores = sorted((sum(a * b for a, b in zip(whole[i], v)) for j, v in whole.items() if j != i), reverse=True)
        above = sum(s >= r["low"] for s in scores)
        assert r["low"] <= scores[4] and (above <= 20 or r["low"] == scores[4])
    assert len(scored) > 2 and scored[0] == len(got) == 30 and scored[-1] < 30


def brute_top_k(sound):
    want = []
    for at, (q, vector) in enumerate(sound):
        if q % 10 == 0:
            scores = sorted((-sum(a * b for a, b in zip(vector, v)), i) for n, (i, v) in enumerate(sound) if n != at and len(v) == len(vector))
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores[:5])]
    return sorted(want)


def search(table, block=4096, queries=1024, bins=1024, settled_at=256):
    return sorted(map(tuple, topk.top_k(table, F.col("vec_id") % 10 == 0, k=5, block=block, query_block=queries, bins=bins, settled_at=settled_at).collect()))


@pytest.mark.parametrize(("size", "others"), [(1e6, 1e6), (1e9, 1e4), (1e12, 10.0)])
def test_top_k_of_large_vectors_and_repeated_ids(spark, size, others):
    """Inner products beyond 2^53; those with the last vector lie beyond 64 bits, but below the five best."""
    rng = random.Random(size)
    rows = [(i % 40, [rng.uniform(0, 1) * rng.choice([1, others]) for _ in range(3)]) for i in range(90)]
    rows += [(10, [size, size / 3, 0.1]), (31, [-1e24, -1e24, -5.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert search(table, 16, 4) == brute_top_k([(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows])


def test_top_k_beyond_64_bits(spark):
    a, b = np.array([[3e38 * 256, 1.0]]), np.array([[3e38 * 256, 0.0], [-3e38, 0.0], [0.0, 7.0]])
    assert topk.products(a, b).tolist() == [[topk.TOP, -topk.TOP, 7]]
    with pytest.raises(Exception, match="beyond 64 bits"):
        search(spark.createDataFrame([(10, [3e38]), (20, [3e38])], "vec_id long, embedding array<float>"))


def test_top_k_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(empty, F.col("vec_id") % 50 == 0).count() == 0


URLS = {
    "https://WWW.Example.com/en/1?x#y": ("www.example.com", "/en/1", "www.example.com/en/", "allow"), "http://m.example.com/en/": ("m.example.com", "/en/", "example.com/en/", "block"),
    "http://a.example.com/fr/": ("a.example.com", "/fr/", "com/", "allow"), "x://com/": ("com", "/", "com/", "allow"), "http://notcom/": ("notcom", "/", None, None), "http://a.com": ("a.com", "", None, None),
    "http://b.net/es/x": ("b.net", "/es/x", "net/es/", "block"), "http://b.net/en/": ("b.net", "/en/", None, None), "no scheme": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
    "http://İ.ORG?q=://z": ("İ.org", "", None, None), "http://": ("", "", None, "allow"), "a://b://c/d": ("b:", "//c/d", None, None),
}


def test_urls_and_rules(spark):
    rows = [(i, u, None, "r") for i, u in enumerate(URLS)] + [(0, next(iter(URLS)), None, "r"), (None, "http://b.net/fr/", "<a href='http://c.org/'>", "r")]
    got = url_filters.judge(spark.createDataFrame(rows, "page_id long, url string, html string, rule string"), RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["page_id"] is not None:
            host, path, rule, verdict = list(URLS.values())[r["page_id"]]
            assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
            assert verdict in (None, r["verdict"])
    assert url_filters.judge(spark.createDataFrame([], "page_id long, url string, html string"), RULES).count() == 0


def test_ties_long_html_and_clashing_columns(spark):
    """Rules of one length, trust equal to distrust, and a link behind a megabyte of text."""
    rules = [("b.org", "/x", "block"), ("org", "/x/a", "allow"), ("good.com", "/", "allow"), ("bad.com", "/", "block")]
    link = lambda h: f"<a href='//{h}/'>"

    def judged(*rows):
        pages = spark.createDataFrame([(*r, "v", "t") for r in rows], "page_id long, url string, html string, verdict string, trust string")
        return {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filters.judge(pages, rules).collect()}

    # good.com -> mid.net -> bad.com: as far from the one as from the other
    assert judged((1, "http://good.com/", link("mid.net")), (2, "http://bad.com/", ""), (3, "http://mid.net/", link("bad.com"))) == {1: ("good.com/", "allow"), 2: ("bad.com/", "block"), 3: (None, "allow")}
    assert judged((1, "http://b.org/x/ab", ""), (2, "http://bad.com/", ""), (3, "http://far.net/", "word " * 250_000 + link("bad.com"))) == {1: ("b.org/x", "block"), 2: ("bad.com/", "block"), 3: (None, "block")}


def test_distrust_spreads_to_hosts_that_link_to_blocked_ones(spark):
    link = lambda *hosts: "".join(f'<a href="//{h}/">' for h in hosts)
    rows = [(1, "http://bad.net/es/", ""), (2, "http://farm.org/", link("bad.net", "bad.net", "x.com")), (3, "http://ring.org/", link("farm.org")), (4, "http://x.com/", link("good.org")), (5, "http://good.org/", link("bad.net")), (6, "http://far.org/", "")]
    got = {r["page_id"]: r["verdict"] for r in url_filters.judge(spark.createDataFrame(rows, "page_id long, url string, html string"), RULES).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow"}


def test_distrust_reaches_hosts_at_any_distance_and_of_any_rank(spark):
    chain = [(1, "http://bad.net/es/", "")] + [(i, f"http://h{i}.org/", f'<a href="//{"bad.net" if i == 2 else f"h{i - 1}.org"}/">') for i in range(2, 36)]
    # A seed of one page among 100,000, and a host with 1/100,000 of the links to it.
    small = [(101, "http://small.net/es/", ""), (102, "http://loud.org/", '<a href="//small.net/">' * 100_000), (103, "http://quiet.org/", '<a href="//small.net/">')]
    pages = spark.createDataFrame(chain + small, "page_id long, url string, html string").union(spark.range(1000, 101_000).selectExpr("id", "'http://big.net/es/'", "''"))
    got = {r["page_id"]: r["verdict"] for r in url_filters.judge(pages, RULES).where("page_id < 1000").collect()}
    assert set(got.values()) == {"block"} and len(got) == 38


def test_hosts_are_seeds_by_the_shares_of_their_pages(spark):
    """No host has most of its pages under a rule; pages elsewhere don't matter."""
    rows = [("http://a.net/es/", None), ("http://a.net/x", "block"), ("http://a.net/y", "block"), ("http://t.org/en/", None), *((f"http://t.org/{x}", "allow") for x in "xyz")]
    rows += [("http://near.org/", "block"), ("http://both.org/", "allow"), ("http://none.org/", "allow")]
    # both.org: a host that is trusted by a quarter links to it, and it links to one that is distrusted by a third
    html = {"http://near.org/": "<a href='//a.net/'>", "http://both.org/": "<a href='//a.net/'>", "http://t.org/x": "<a href='//both.org/'>"}
    rules = [("t.org", "/en/", "allow"), ("net", "/es/", "block")]
    pages = spark.createDataFrame([(i, u, html.get(u, "")) for i, (u, _) in enumerate(rows)], "page_id long, url string, html string")
    for elsewhere in (0, 5000):
        more = spark.range(1000, 1000 + elsewhere).selectExpr("id", "concat('http://h', id, '.net/es/')", "''")
        got = {r["page_id"]: r for r in url_filters.judge(pages.union(more), rules).where("page_id < 1000").collect()}
        assert {i: got[i]["verdict"] for i, (_, want) in enumerate(rows) if want} == {i: want for i, (_, want) in enumerate(rows) if want}
        assert all((got[i]["rule"] is None) == (want is not None) for i, (_, want) in enumerate(rows))


def test_spread_is_personalised_pagerank(spark):
    edges = [("a", "b", 1), ("a", "c", 3), ("b", "c", 1), ("c", "a", 2), ("c", "d", 2)]
    seeds = {"a": 0.75, "b": 0.25}
    ranks = dict(seeds)
    for _ in range(100):
        new = defaultdict(float)
        for s, d, n in edges:
            new[d] += 0.85 * ranks.get(s, 0) * n / sum(e[2] for e in edges if e[0] == s)
        lost = 1 - sum(new.values())
        for h, w in seeds.items():
            new[h] += lost * w
        ranks = dict(new)
    got = url_filters.spread(spark.createDataFrame(list(seeds.items()), "host string, seed double"), spark.createDataFrame(edges, "src string, dst string, n long"), tolerance=1e-4)
    assert {r["host"]: r["rank"] for r in got.collect()} == pytest.approx(ranks, abs=1e-3)


@pytest.mark.parametrize("block", [256, 2])
def test_views_render_every_perspective(spark, block):
    rng = random.Random(13)
    rows = [(c, t, rng.choice(["user", "assistant", "Ann B", None, "system"]), rng.choice(["hi", "", None, "é" * 9])) for c in range(6) for t in range(rng.randint(1, 9))]
    rows += [(7, 0, "system", "only"), (None, 1, "u", "x"), (None, None, "v", "y"), (8, 1, "u", "same"), (8, 1, "u", "same"), (9, 0, "u", "long " * 50_000)]
    table = spark.createDataFrame([(*r, "s") for r in rows], "conv_id long, turn long, role string, text string, segment string")
    text, masked = defaultdict(str), defaultdict(str)
    name = lambda r: {None: "unknown", "Ann B": "Ann_B"}.get(r, r)
    for c in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, name(r[2]), r[3] or "") for r in rows if r[0] == c))
        for p in {t[2] for t in turns} - {"system"}:
            for _, _, who, said in turns:
                head = "<|im_start|>" + ("assistant" if who == p else "system" if who == "system" else f"user name={who}") + "\n"
                text[c, p] += head + said + "<|im_end|>\n"
                masked[c, p] += said + "<|im_end|>\n" if who == p else ""
    got, trained = defaultdict(str), defaultdict(str)
    for r in sorted(chat_views.views(table, block_turns=block).collect(), key=lambda r: r["position"]):
        key = (r["conv_id"], r["perspective"])
        assert r["start"] == len(got[key])
        got[key] += r["segment"]
        assert r["end"] == len(got[key])
        if r["train_start"] is not None:
            trained[key] += got[key][r["train_start"] : r["train_end"]]
    assert got == text
    assert {k: v for k, v in masked.items() if v} == trained
    assert chat_views.views(table.where("false")).count() == 0
