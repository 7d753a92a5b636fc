import random

import public_tokenizers as vocabularies
import pytest
from tokenizers import Tokenizer

from tallybrook.llm import token_counts as t
from tallybrook.llm.common import Memo

PATH = vocabularies.path("byte_bpe_50k.json")
PARTS = [*"abcdefghijklmnopqrstuvwxyz'''    \n\t.,!?0123456789éñ日本\xa0ß½²\x1c\x85😀", "'s", "'re", "'ll", "  ", "the ", "ing", "<|endoftext|>", "<|end", "\n\n", "THE"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def text_of(rng, most=30):
    return "".join(rng.choice(PARTS) for _ in range(rng.randint(0, most)))


def composed(text, size, rules, memo, wrong=False):
    """The chunks' maps, made apart and chained; `wrong` first guesses are the start state."""
    begins = t.cuts(text, size, rules)
    chunks = [text[a:b] for (a, _), b in zip(begins, [a for a, _ in begins[1:]] + [len(text)])]
    assert "".join(chunks) == text and max(map(len, chunks)) <= size
    start = repr(t.TextMachine.START)
    guesses = [start if reset or wrong else rules.shown(rules.run(text[max(0, a - t.LEAD) : a])[0]) for a, reset in begins]
    maps = [{g: t.chunk_from(rules, memo, c, g)} for g, c in zip(guesses, chunks)]
    state, total = start, 0
    for m, c, (_, reset) in zip(maps, chunks, begins):
        state = start if reset else state
        state, n = m[state] if state in m else t.chunk_from(rules, memo, c, state)
        total += n
    return total


def test_machine_and_chunk_maps_give_the_librarys_counts(library):
    rng, machine = random.Random(1), t.machine(PATH)
    memo = Memo(machine.count)
    for _ in range(1500):
        text = text_of(rng)
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert machine.count(text) == n
        # a chunk holds the longest special string, as none is cut
        assert composed(text, rng.randint(13, 20), machine, memo, rng.random() < 0.5) == n


def test_states_pass_between_machines():
    rng, one, other = random.Random(2), t.machine(PATH), t.machine.__wrapped__(PATH)
    for _ in range(300):
        a, b = text_of(rng, 8), text_of(rng, 8).replace("<|", "")
        if (a + b).count("<|end") == a.count("<|end"):
            state, n = one.run(a)
            assert n + other.run(b, other.known(one.shown(state)))[1] == one.run(a + b)[1]


@pytest.mark.parametrize("unit", ["a", "ab1'é ", "xQz日", "'s"])
def test_a_text_of_many_chunks(spark, library, unit):
    """Without white space, all chunks but the first begin in states that only their neighbours know."""
    rng = random.Random(unit)
    texts = [unit * 20_000, "".join(rng.choice(unit.strip() + "eu") for _ in range(50_000)), "<|endoftext|>" * 900 + unit]
    got = t.token_counts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), PATH, chunk_chars=512)
    assert {r["doc_id"]: r["n_tokens"] for r in got.collect()} == {i: len(library.encode(x, add_special_tokens=False).ids) for i, x in enumerate(texts)}


def test_ten_million_characters_without_white_space(spark, library):
    rng = random.Random(4)
    text = "".join(rng.choice("etaoinshrdlu0123éü-/") for _ in range(200_000)) * 50
    got = t.token_counts(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH).first()
    assert got["n_tokens"] == len(library.encode(text, add_special_tokens=False).ids)


def test_every_row_comes_back_once_with_its_count(spark, library):
    rng = random.Random(3)
    texts = [text_of(rng, 200) for _ in range(40)] + [None, "", "a" * 5000, " " * 300, "a b " * 2000]
    rows = [(i, x, "row") for i, x in enumerate(texts)] + [(0, texts[0], "row"), (None, "x y", "row")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    got = [tuple(r) for r in t.token_counts(docs, PATH, chunk_chars=64).collect()]
    want = []
    for i, x, _ in rows:
        n = len(library.encode(x or "", add_special_tokens=False).ids)
        want.append((i, len((x or "").encode()), n, n > 1024))
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(want, key=key)


def test_empty_table(spark):
    assert t.token_counts(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
