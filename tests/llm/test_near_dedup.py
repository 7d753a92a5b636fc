import random
import re
from collections import Counter

import numpy as np
import pytest

from tallybrook.llm import common
from tallybrook.llm import near_dedup as x


def multiset(text):
    words = re.findall(r"\w+", (text or "").lower())
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def brute(rows, least=0.8):
    sets, parent = [multiset(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = sum((sets[a] & sets[b]).values())
                near = both >= least * (sum(sets[a].values()) + sum(sets[b].values()) - both)
            else:
                near = not sets[a] and not sets[b] and (rows[a][1] or "") == (rows[b][1] or "")
            if near:
                parent[find(a)] = find(b)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(d)
    return sorted((d, min(ids[find(i)]), len(ids[find(i)]), d == min(ids[find(i)])) for i, (d, _) in enumerate(rows))


def texts(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    out = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([3, 8, 60, 150]))]
        out.append(" ".join(base))
        for _ in range(rng.choice([0, 2, 6])):  # edits that leave some copies just above and some just below 0.8
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(" ".join(copy))
    base = [rng.choice(words) for _ in range(120)]
    for _ in range(25):  # a chain: each like the one before, its ends unlike
        base[rng.randrange(120)] = rng.choice(words)
        out.append(" ".join(base))
    long = " ".join(rng.choice(words) for _ in range(60_000))  # very long texts, alike and not
    out += [long, long + " end", long[: len(long) // 2]]
    return [*out, "a b c d e f g " * 40, "a b c d e f g " * 45, None, "", "", "!!!", "Ü é, x", "ü É x"]


@pytest.mark.parametrize(("seed", "block", "few"), [(1, 2000, 500_000), (2, 3, 0)])
def test_classes_match_brute_force(spark, seed, block, few):
    rows = list(enumerate(texts(seed))) + [(0, texts(seed)[0])]
    docs = spark.createDataFrame([(*r, "n", "node") for r in rows], "doc_id long, text string, n string, node string")
    got = x.near_duplicates(docs, block=block, broadcast_rows=few)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_hot_keys_and_their_join(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}" if i % 2 else None) for i in range(300)], "i long, k string")
    facts = spark.createDataFrame([("hot", 1), ("k3", 2), ("k9", 3), ("other", 4)], "k string, v long")
    assert common.hot_keys(rows, "k", most=3, least=10) == ["hot"]
    for hot in (None, ["hot"], ["hot", "k3", "other"]):
        got = {r["i"]: r["v"] for r in common.spread_join(rows, facts, "k", hot).collect()}
        assert got == {i: 1 if i % 3 else {3: 2, 9: 3}.get(i) for i in range(300)}


def test_row_numbers_tell_one_row_of_each_class(spark):
    docs = spark.createDataFrame([(5, "a b c d e f", 10), (5, "A b c d e f", 11), (None, "a b c d e f", 12), (6, "x", 13), (6, "x", 14)], "doc_id long, text string, nr long")
    got = {r["nr"]: (r["class_id"], r["kept"], r["stays"]) for r in x.near_duplicates(docs, row_col="nr").collect()}
    assert got == {10: (5, True, True), 11: (5, True, False), 12: (5, False, False), 13: (6, True, True), 14: (6, True, False)}


def test_empty_table(spark):
    assert x.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_shingles_and_unbiased_signatures():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    many = [" ".join(rng.choice(words) for _ in range(n)) for n in (0, 1, 4, 5, 60, 400)]
    many += [many[4] + " " + " ".join(words[:9]), "x y z u v w " * 30, "x y z u v w " * 41, "日本 語 テキスト a_b 1"]
    doc, h, weight = x.shingles(many)
    for i, t in enumerate(many):
        assert sorted(weight[doc == i]) == sorted(multiset(t).values())
    errors = []
    signature = x.bagminhash(doc, h, weight, len(many), m=4096)
    for a in range(len(many)):
        for b in range(a):
            m, n = multiset(many[a]), multiset(many[b])
            if m and n:
                errors.append((signature[a] == signature[b]).mean() - sum((m & n).values()) / sum((m | n).values()))
    assert np.abs(errors).max() < 0.04
