import hashlib
import random
import re

import numpy as np
import pytest

from tallybrook.llm import winnowing

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        words = words_of(text)
        size = min(10, len(words))
        for at in range(len(words) - size + 1 if size else 0):
            windows.setdefault(tuple(words[at : at + size]), set()).add(item)
    out = []
    for doc, text in docs:
        words, hit, found = words_of(text), set(), set()
        for size in {len(w) for w in windows}:
            for at in range(len(words) - size + 1):
                if (of := windows.get(tuple(words[at : at + size]))) is not None:
                    hit |= set(range(at, at + size))
                    found |= {str(x) for x in of if x is not None}
        out.append((doc, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def got(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, 1, "r") for i, t in docs], "doc_id long, text string, items int, row string").repartition(3)
    b = spark.createDataFrame([(i, t, "k") for i, t in items], "item_id long, text string, kept string")
    found = winnowing.contaminated(d, b, **options)
    spans = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in found.collect()}
    return sorted((tuple(r) for r in winnowing.digest(found).collect()), key=str), spans


def cases(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(12)] + ["Été", "ÑAME", "日本語", "X9", "İ"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "--", "_"]) for _ in range(n))
    items = [(k, text(rng.choice([3, 9, 10, 11, 25, 60]))) for k in range(30)] + [(5, text(30)), (None, text(20)), (70, None), (71, ""), (72, "?!"), (73, text(4)), (10, text(15))]
    docs = [(k, text(rng.choice([0, 2, 9, 40, 150]))) for k in range(60)]
    docs += [(100 + k, text(20) + (t or "").upper().replace("É", "é") + text(15)) for k, (_, t) in enumerate(items)]
    docs += [(None, items[0][1]), (3, items[1][1]), (3, items[1][1]), (200, None), (201, ""), (202, " . ")]
    return docs, items


@pytest.mark.parametrize("most_bytes", [32 << 20, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force_by_either_way(spark, seed, most_bytes):
    docs, items = cases(seed)
    assert got(spark, docs, items, most_bytes=most_bytes)[0] == brute(docs, items)


def test_spans_cover_a_planted_passage_and_clean_texts_stay(spark):
    passage = " ".join(f"p{k}" for k in range(40))
    docs = [(1, "before it " + passage + " after it"), (2, "nothing of the kind " * 20), (3, " ".join(f"p{k}" for k in range(9))), (4, " ".join(f"p{k}" for k in range(10)))]
    for most in (32 << 20, 0):
        rows, spans = got(spark, docs, [(7, passage)], most_bytes=most)
        assert spans == {1: [(2, 42)], 2: [], 3: [], 4: [(0, 10)]}
        assert [r[5] for r in rows] == [True, False, False, True]


@pytest.mark.parametrize("most_bytes", [32 << 20, 0])
def test_very_long_texts_and_words(spark, most_bytes):
    huge = "ab" * (winnowing.SEGMENT // 2 + 10)
    long = "x y z " * 400_000 + " ".join(f"p{k}" for k in range(12)) + " x y z" * 10
    docs = [(1, long), (2, f"a b c {huge} d e f g h i j k"), (3, f"a b c {huge}c d e f g h i j k")]
    items = [(1, " ".join(f"p{k}" for k in range(11))), (2, f"c {huge} d e f g h i j k")]
    rows, _ = got(spark, docs, items, most_bytes=most_bytes)
    assert rows == brute(docs, items)


@pytest.mark.parametrize("most_bytes", [32 << 20, 0])
def test_empty_tables(spark, most_bytes):
    assert got(spark, [], [(1, "a b c")], most_bytes=most_bytes)[0] == []
    assert got(spark, [(1, "a b c")], [], most_bytes=most_bytes)[0] == brute([(1, "a b c")], [])


@pytest.mark.parametrize("span,k", [(10, 5), (6, 5), (4, 4), (1, 1), (12, 3)])
def test_equal_runs_keep_equal_hashes_and_few_are_kept(span, k):
    rng = np.random.default_rng(span)
    text = rng.integers(0, 1 << 62, 4000).astype(np.uint64)
    again = np.concatenate([rng.integers(0, 1 << 62, 17).astype(np.uint64), text[1000:1300], rng.integers(0, 1 << 62, 9).astype(np.uint64)])
    first, kept = winnowing.kept_hashes(np.zeros(len(text), int), text, span, k)
    _, other = winnowing.kept_hashes(np.zeros(len(again), int), again, span, k)
    assert (kept[1000 : 1300 - span + 1] == other[17 : 317 - span + 1]).all()
    # the density of winnowing: 2 / (number of k-grams in a run + 1)
    assert len(np.unique(kept)) <= 1.15 * len(text) * 2 / (span - min(k, span) + 2)
    assert first.tolist() == list(range(len(text) - span + 1))
