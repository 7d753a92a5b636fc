import random
from itertools import product

import numpy as np
import public_tokenizers as vocabularies
import sentencepiece

from tallybrook.llm import sentence_pieces as x

PATH = vocabularies.path("piece_bpe_32k.model")
PARTS = [*"abcdefghijklmnopqrstuvwxyz    \n\t.,!?0123456789éñ日本\xa0ß½😀", "  ", "the ", "ing", "    ", "<s>", "tion", "THE"]


def test_ids_are_the_librarys_and_decode_back(spark):
    library, rng = sentencepiece.SentencePieceProcessor(model_file=PATH), random.Random(8)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60))) for _ in range(600)] + ["a" * 3000, "", " ", "the▁x", "".join(rng.choice(PARTS) for _ in range(60_000))]
    rows = [*enumerate(texts), (None, None), (0, texts[0])]
    docs = spark.createDataFrame([(*r, b"") for r in rows], "doc_id long, text string, ids binary")
    for r in x.decode(x.encode(docs, PATH), PATH).collect():
        ids = np.frombuffer(bytes(r["ids"]), "<i4").tolist()
        assert ids == library.encode(r["text"] or "")
        assert r["decoded"] == (r["text"] or "").replace("▁", " ")


def test_clashing_columns_stay_or_give_way(spark):
    docs = spark.createDataFrame([(1, "a b", "x", "y")], "doc_id long, text string, decoded string, words string")
    row = x.decode(x.encode(docs, PATH), PATH).first()
    assert (row["decoded"], row["words"]) == ("a b", "y")


def test_round_trip_query_shape(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert [(r["doc_id"], r["n_pieces"], r["exact"]) for r in x.round_trip(docs, PATH).orderBy("doc_id").collect()] == [(1, 2, True), (2, 0, True)]
    assert x.round_trip(docs.where("false"), PATH).count() == 0


def test_unigram_scores_are_the_best_of_all_segmentations():
    pieces = ["<unk>", "▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "ca"]
    scores = [0.0, -3.0, -2.0, -2.1, -2.2, -3.0, -2.5, -5.5, -4.0, -1.0]
    model = x.Pieces(pieces, scores, {0}, {}, 0, "unigram")
    words = ["▁" + "".join(w) for n in range(1, 6) for w in product("abc", repeat=n)]
    got = x.encode_words(words, model)

    def best(word):
        return 0.0 if not word else max(model.scores[model.id_of[word[:k]]] + best(word[k:]) for k in range(1, len(word) + 1) if word[:k] in model.id_of)

    for word in words:
        ids = np.frombuffer(got[word], "<i4").tolist()
        assert "".join(pieces[i] for i in ids) == word
        assert abs(sum(scores[i] for i in ids) - best(word)) < 1e-9
