import hashlib
import random
from collections import defaultdict

import pytest

from tallybrook.llm import exact_dedup as x


def brute(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    out = []
    for i, t, *_ in rows:
        ids = [k for k in groups[t or ""] if k is not None]
        keep = max(ids, default=None)
        out.append((i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("memory", [48 << 20, 2000])
def test_against_brute_force(spark, memory):
    rng = random.Random(1)
    texts = ["same"] * 40 + [f"text {rng.randint(0, 30)}" for _ in range(60)] + [None, "", "x" * 100_000, "x" * 100_000 + "y", "é", "e\u0301", "same "]
    rows = [(i, t, i, "digest", "content") for i, t in enumerate(texts)] + [(3, "same", 0, "", ""), (None, "same", 0, "", ""), (None, "lonely", 0, "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long, digest string, content string").repartition(5)
    assert sorted(map(tuple, x.exact_dedup(docs, memory_bytes=memory).collect()), key=str) == brute(rows)


def test_empty_table(spark):
    assert x.exact_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("weak", [lambda b: 7, lambda b: len(b) << 60, None])
def test_recursion_compares_complete_contents(weak):
    """Even where hashes agree, contents decide; a tiny budget forces several levels of spill files."""
    rng = random.Random(2)
    records = [(str(rng.randint(0, 400)).encode() * 5, 1, i) for i in range(2000)]
    want = defaultdict(lambda: [0, -1])
    for c, n, i in records:
        want[c][0] += n
        want[c][1] = max(want[c][1], i)
    got = list(x.grace(iter(records), 3000, **({"hash_of": weak} if weak else {})))
    assert len(got) == len(want)
    assert {c: [n, i] for c, n, i in got} == dict(want)
