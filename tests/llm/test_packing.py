import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as vocabularies
import pytest
from tokenizers import Tokenizer

from tallybrook.llm import packing as x

PATH = vocabularies.path("byte_bpe_50k.json")


def test_pieces_and_places(spark):
    library = Tokenizer.from_file(PATH)
    rng = random.Random(5)
    texts = ["".join(rng.choice(["the ", "ring", " \n", "é", "'s", "12", "<|endoftext|>", "  ", "l'eau,", "x-y", "a_b!", "it'", "Ω", "5%"]) for _ in range(rng.randint(0, 90))) for _ in range(80)]
    rows = [*enumerate(texts), (200, None), (201, ""), (202, "word " * 5000), (203, "xQz日-" * 9000), (204, "tie"), (205, "tie"), (0, texts[0])]
    docs = spark.createDataFrame([(*r, "item") for r in rows], "doc_id long, text string, item string")
    got = x.pack_documents(docs, PATH, capacity=128, shard_pieces=40).collect()
    want = []
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        start = 0
        for k, n in enumerate(([len(ids) % 128] if len(ids) % 128 else []) + [128] * (len(ids) // 128)):
            want.append((i, k, start, n, zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())))
            start += n
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 128
    size = [r["length"] for r in got]
    # the shards' open bins are packed again together: no worse than best fit over all pieces at once
    assert len(bins) <= len(x.best_fit(list(range(len(size))), size, 128, []))


def test_levels_meet_the_bound_where_shards_cannot(spark):
    rng = random.Random(8)
    size = [rng.randint(1, 60) for _ in range(600)]
    pieces = spark.createDataFrame(list(enumerate(size)), "item long, length long")
    got = x.pack(pieces, capacity=100, shard_pieces=40).collect()
    assert sorted(r["item"] for r in got) == list(range(600))
    assert len({r["sequence_id"] for r in got}) == -(-sum(size) // 100)


def test_islands_run_where_the_bound_is_out_of_reach(spark):
    """Pieces of which no two fit together: every island runs all generations of all epochs."""
    got = x.pack(spark.createDataFrame([(i, 60) for i in range(50)], "item long, length long"), capacity=100, epochs=3, generations=4).collect()
    assert len({r["sequence_id"] for r in got}) == 50 and {r["generations"] for r in got} == {12}


def test_crossover_keeps_every_piece_once():
    rng = random.Random(6)
    for _ in range(50):
        size = [rng.randint(1, 99) for _ in range(60)]
        a, b = (x.best_fit(rng.sample(range(60), 60), size, 100, []) for _ in range(2))
        child = x.crossover(a, b, size, 100, rng)
        assert sorted(i for c in child for i in c) == list(range(60))
        assert max(sum(size[i] for i in c) for c in child) <= 100


def test_exchange_fills_bins_and_keeps_every_piece():
    rng = random.Random(11)
    for _ in range(50):
        size = [rng.randint(10, 70) for _ in range(60)]
        bins = x.best_fit(rng.sample(range(40), 40), size, 100, [])
        before = [sum(size[i] for i in b) for b in bins]
        after, displaced = x.exchange([list(b) for b in bins], list(range(40, 60)), size, 100)
        assert sorted([*displaced, *(i for b in after for i in b)]) == list(range(60))
        assert all(was <= sum(size[i] for i in b) <= 100 for was, b in zip(before, after))
        assert sum(size[i] for i in displaced) <= sum(size[40:])


@pytest.mark.parametrize(("pieces", "low", "high", "gain"), [(200, 500, 800, 2), (200, 300, 900, 1), (1000, 500, 800, 8), (1000, 200, 1100, 2), (4096, 200, 1100, 8)])
def test_evolution_needs_fewer_sequences_than_its_seeds(pieces, low, high, gain):
    """Pieces of which no greedy order fits whole sequences; the generations are those of the default."""
    rng = random.Random(3)
    size = [rng.randint(low, high) for _ in range(pieces)]
    first = x.seeds(size, 2048, rng, 6)
    (best, *_), ran = x.evolve(first, size, 2048, rng, 36)
    assert ran > 0 and sorted(i for b in best for i in b) == list(range(pieces))
    assert len(best) <= min(map(len, first)) - gain


def test_islands_need_fewer_sequences_than_best_fit(spark):
    rng = random.Random(4)
    size = [rng.randint(500, 800) for _ in range(600)]
    got = x.pack(spark.createDataFrame(list(enumerate(size)), "item long, length long"), shard_pieces=200).collect()
    assert sorted(r["item"] for r in got) == list(range(600))
    assert len({r["sequence_id"] for r in got}) <= len(x.best_fit(list(range(600)), size, 2048, [])) - 4


def test_empty_table(spark):
    assert x.pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
