import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybrook.llm import lang_id, toxicity

SOUNDS = {"aa": ["ka", "lo", "mi", "tar", "en"], "bb": ["zu", "ei", "sch", "ver", "ung"], "cc": ["ción", "os", "ado", "que", "ll"]}


def prose(rng, lang, n=40):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_held_out_languages_are_found(spark):
    rng = random.Random(9)
    rows = [(i, prose(rng, lang, rng.randint(1, 60)), lang, "src") for i, lang in ((i, rng.choice(sorted(SOUNDS))) for i in range(400))]
    rows += [(1000, None, "aa", "s"), (1001, "", "bb", "s"), (1002, "12 !?", "cc", "s"), (1003, "ka " * 100_000, None, None), (None, "ver ung schei", "bb", "s"), (0, rows[0][1], "aa", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = lang_id.identify(docs).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert [by_id[i]["lang_pred"] for i in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "aa", "bb"]
    held = [(by_id[i]["lang_pred"], lang) for i, _, lang, _ in rows[:400] if by_id[i]["held_out"]]
    assert np.mean([a == b for a, b in held]) > 0.97


def test_languages_of_held_out_documents(spark):
    """On the driver's documents, which texts never see their own label."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found = lang_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null and lang_pred != 'und'")
    right, n = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 2000 and right >= 0.98 * n


def test_rare_languages_stay_in_the_sample(spark):
    rng = random.Random(17)
    rows = [(i, prose(rng, "aa", 5), "aa") for i in range(3000)] + [(3000 + i, prose(rng, "bb", 5), "bb") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert lang_id.train(docs, F.lit(True), sample_rows=60).languages == ["aa", "bb"]
    # of a sample smaller than the languages are many, each has a row
    assert lang_id.train(docs, F.lit(True), sample_rows=1).languages == ["aa", "bb"]


def test_many_languages_are_all_learned_and_as_in_one_matrix(spark):
    """More languages than a task holds at once: the table's sums give the weights that all distributions together give."""
    rng = random.Random(23)
    rows = [(i, " ".join("".join(rng.choice("abcdefghij"[k % 7 :] + chr(0x3B1 + k % 24)) for _ in range(4)) for _ in range(20)), f"l{k:03}") for i, k in enumerate([*range(150)] * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang_id.train(docs, F.lit(True))
    sums = {}
    for _, text, lang in rows:
        h = sum(np.bincount(slots, minlength=lang_id.DIM) for slots in lang_id.grams(text))
        sums[lang] = sums.get(lang, 0) + h / h.sum()
    want = lang_id.Model(sorted(sums), np.array([sums[x] for x in sorted(sums)]))
    assert model.languages == want.languages and len(want.languages) == 150
    assert np.allclose(model.weights, want.weights, rtol=1e-4, atol=1e-5) and np.allclose(model.bias, want.bias, rtol=1e-6)


def plain_decode(model, text):
    """The language and score of a short text, byte by byte and codeword by codeword."""
    data = [b if b > 127 or chr(b).isalpha() else 32 for b in f" {text.lower()} ".encode()]
    wrap, total, n = (1 << 32) - 1, [0.0] * len(model.bias), 0
    for i in range(len(data) - 1):
        two = data[i] * 257 + data[i + 1]
        slots = [(two * 2246822519 & wrap) >> 32 - lang_id.BITS]
        if i + 2 < len(data):
            slots.append(((two * 65599 + data[i + 2] & wrap) * 2654435761 & wrap) >> 32 - lang_id.BITS)
        for slot in slots:
            total = [t + float(w) for t, w in zip(total, model.weights[slot])]
            n += 1
    margins = [t / n + float(b) for t, b in zip(total, model.bias)]
    losses = [sum(math.log1p(math.exp(-2 * bit * m)) for bit, m in zip(code, margins)) for code in model.code.tolist()]
    best = losses.index(min(losses))
    return model.languages[best], 1 / sum(math.exp(losses[best] - x) for x in losses)


def test_predictions_match_a_plain_decode(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = lang_id.train(docs, ~lang_id.held_out())
    some = docs.withColumn("text", F.substring("text", 1, 80)).where("text rlike '[a-zA-Z]'").orderBy("doc_id").limit(60)
    for r in lang_id.predict(some, model).collect():
        lang, score = plain_decode(model, r["text"])
        assert (r["lang_pred"], r["score"]) == (lang, pytest.approx(score, rel=1e-4))


def test_ties_numbers_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "ka lo", "aa", "x", "y"), (2, "½ ² 12", "aa", "x", "y")], "doc_id long, text string, lang string, lang_pred string, __text string")
    got = {r["doc_id"]: r for r in lang_id.predict(docs, lang_id.Model(["b", "a"][::-1], np.ones((2, lang_id.DIM)))).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2)] == ["a", "und"] and got[1]["__text"] == "y" and got[1]["ambiguous"]


def test_codewords_differ_in_many_bits():
    for n in (2, 3, 4, 6, 7, 20):
        code = lang_id.codewords(n)
        apart = [(code[a] != code[b]).sum() for a in range(n) for b in range(a)]
        assert min(apart) >= (1 if n < 4 else code.shape[1] // 4)


def test_ambiguity_is_flagged():
    model = lang_id.Model(["a", "b", "c"], np.ones((3, lang_id.DIM)))
    assert model.decode(np.zeros(model.code.shape[1]))[2] == pytest.approx(0)
    assert model.decode(3 * model.code[1])[0] == "b"


def test_no_training_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in lang_id.identify(docs).collect()] == ["und"]
    assert lang_id.identify(docs.where("false")).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a):
        before, row[0] = row[0], i + 1
        for j, d in enumerate(b):
            before, row[j + 1] = row[j + 1], min(row[j] + 1, row[j + 1] + 1, before + (c != d))
    return row[-1]


def test_automaton_matches_edit_distance():
    rng = random.Random(10)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(3, 9))) for _ in range(12)]
    terms = {w: (rng.random(), False) for w in words}
    machine = toxicity.Automaton(toxicity.Trie(terms))
    for _ in range(3000):
        base = list(rng.choice(words)) if rng.random() < 0.7 else [rng.choice("abc") for _ in range(rng.randint(1, 10))]
        for _ in range(rng.randint(0, 3)):
            base[rng.randrange(len(base)) : rng.randrange(len(base)) + 1] = rng.choice([[], ["a"], ["b", "c"]])
            base = base or ["a"]
        word = "".join(base)
        near = [(d, -w, t) for t, (w, _) in terms.items() if (d := distance(word, t)) <= toxicity.edits(t, False)]
        best = min(near, default=None)
        assert machine.match(word) == (best and (best[2], best[0]))


def test_open_terms_take_any_ending():
    machine = toxicity.Automaton(toxicity.Trie({"lowei": (2.0, True), "lowe": (1.0, False)}))
    assert machine.match("loweischaft") == ("lowei", 0)
    assert machine.match("lowe") == ("lowe", 0)
    assert machine.match("xlowei") is None


def labelled(rng, n=600):
    rows, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < 0.3)
        words = prose(rng, "aa").split()
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["stupidest", "moronic", "worthless"]))
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    return rows, labels


def test_toxic_rows_misspellings_and_quotes(spark):
    rows, labels = labelled(random.Random(11))
    rows += [(2000, "ka lo w0rthless mi stupidesst en tar"), (2001, None), (2002, ""), (2003, "ka lo mi " * 50_000), (None, "ka worthless lo moronic")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, predicted int")
    marks = spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.detect(docs, marks).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["predicted"] == y for i, y in labels if got[i]["held_out"])
    assert [got[i]["predicted"] for i in (2000, 2001, 2002, 2003, None)] == [1, 0, 0, 0, 1]
    lexicon = toxicity.train(docs, marks, ~toxicity.held_out())
    assert lexicon.hits('ka "worthless" lo') < lexicon.hits("ka worthless lo")
    assert lexicon.hits("worthless moronic ka") > lexicon.hits("worthless ka") + lexicon.hits("moronic ka")


def test_terms_below_a_beginning_that_clean_documents_hold_too(spark):
    rng = random.Random(15)
    rows = [(i, prose(rng, "aa") + (" loser" if i < 120 else f" lose{'abdfghiklmnopqtu'[i % 16]}qu" if i < 136 else ""), int(i < 120)) for i in range(500)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    lexicon = toxicity.train(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"), F.lit(True))
    assert lexicon.score("ka loser lo") > 0.5 and lexicon.score("ka losser lo") > 0.5
    assert lexicon.hits("ka loseaqu lo") == 0


def test_terms_stay_beside_an_open_beginning_and_void_ones_give_way(spark):
    rng = random.Random(16)
    rows = [(i, prose(rng, "aa") + (" idiot" if i < 60 else f" idiot{'abdfghik'[i % 8]}x" if i < 120 else ""), int(i < 120)) for i in range(500)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    lexicon = toxicity.train(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"), F.lit(True))
    assert all(lexicon.hits(f"ka {w} lo") > 0 for w in ("idiot", "idiotically", "idjot"))
    terms = {"lose*": (3.0, True), "loser": (2.0, False)}
    assert toxicity.Automaton(toxicity.Trie(terms)).match("loser") == ("lose*", 0)
    assert toxicity.Automaton(toxicity.Trie(terms, {("lose*", 0)})).match("loser") == ("loser", 0)
    assert toxicity.Automaton(toxicity.Trie(terms, {("lose*", 0)})).match("losser") == ("loser", 1)


def plain_score(lexicon, text):
    """The score by comparing every word with every term."""
    words = [(m.group(), *m.span()) for m in toxicity.WORD.finditer(text.lower())]
    found = []
    for i, (word, a, b) in enumerate(words):
        fits = []
        for (term, k), weight in lexicon.weights.items():
            is_open = lexicon.terms[term][1]
            near = min((distance(word[:n], term.removesuffix("*")) for n in range(len(word) + 1)), default=9) if is_open else distance(word, term)
            if weight > 0 and near == k:
                fits.append((k, -lexicon.terms[term][0], term))
        if fits:
            k, _, term = min(fits)
            line_start, line_end = text.rfind("\n", 0, a) + 1, text.find("\n", b) if "\n" in text[b:] else len(text)
            before, after = text[max(line_start, a - 80) : a], text[b : min(line_end, b + 80)]
            quoted = sum(c in toxicity.QUOTES for c in before) % 2 == 1 and any(c in toxicity.QUOTES for c in after)
            found.append((i, lexicon.weights[term, k] * (0.25 if quoted else 1)))
    total = sum(w * (1 + 0.2 * sum(0 <= m < len(found) and abs(found[m][0] - i) <= 12 for m in (n - 1, n + 1))) for n, (i, w) in enumerate(found))
    return 1 / (1 + np.exp(-(lexicon.slope * np.log1p(total) + lexicon.offset)))


def test_scores_match_brute_force(spark):
    rng = random.Random(18)
    rows, labels = labelled(rng)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lexicon = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
    odd = ["stupidest", "stupidst", "sstupidest", "morronic", "wrthless", "worthles", '"moronic"', "«", "»", '"', "\n", "moron", "worthlessness"]
    texts = [" ".join(rng.choice(odd) if rng.random() < 0.4 else rng.choice(["ka", "lo", "mitar"]) for _ in range(rng.randint(1, 60))) for _ in range(150)] + ["", "ka"]
    got = toxicity.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), lexicon).collect()
    assert {r["doc_id"]: r["score"] for r in got} == pytest.approx({i: plain_score(lexicon, t) for i, t in enumerate(texts)})


def test_no_labels_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    marks = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["predicted"] for r in toxicity.detect(docs, marks).collect()] == [0]
    assert toxicity.detect(docs.where("false"), marks).count() == 0


def test_folds(spark):
    import zlib

    got = spark.range(50).select("id", lang_id.held_out("id").alias("a"), toxicity.held_out("id").alias("b")).collect()
    assert [(r["a"], r["b"]) for r in got] == [(zlib.crc32(str(i).encode()) % 4 == 2, zlib.crc32(str(i).encode()) % 5 == 0) for i in range(50)]
    assert F is not None
