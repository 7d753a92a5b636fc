"""Language identification by error-correcting output codes (operator 1).

Every language has a codeword of bits; one binary classifier per bit scores hashed byte n-grams of the lower-cased
text (whole text, in blocks). Decoding adds each bit's logistic loss against each codeword and takes the language of
least loss; a small gap to the runner-up marks the document as ambiguous.

The classifiers are fitted on a bounded sample of labelled training rows (about `sample_rows`, shared out evenly among
the languages, and of each language one row at least, so that all are learned): each language's mean n-gram distribution
gives each bit's log odds between the languages that have the bit and those that don't, scaled so that the two sides' own
expectations are +1 and -1. The distributions stay in a table; only sums and bounds for each bit come together.

Defined results: null texts and texts without a letter are `und` with score 0; a very long text counts in blocks, whole;
equal losses go to the language that sorts first, and equally frequent languages likewise; rows without a language don't
train; no training rows: every text is `und`; repeated rows each give a row; an empty table gives an empty result;
further columns stay, but for those under the names of the results.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import drop_table, fold, tidy, write_table

BITS = 15
DIM = 1 << BITS
BLOCK = 1 << 16
LETTER = regex.compile(r"\p{L}").search
#: ASCII other than letters becomes a space; everything else stays.
_TABLE = np.array([b if b > 127 or chr(b).isalpha() else 32 for b in range(256)], dtype="u4")


def grams(text: str):
    """Slots of all byte trigrams and bigrams of the whole text, block by block."""
    data = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)
    for at in range(0, max(1, len(data) - 2), BLOCK):
        b = _TABLE[data[at : at + BLOCK + 2]]
        two = b[:-1] * np.uint32(257) + b[1:]
        three = two[:-1] * np.uint32(65599) + b[2:]
        yield (np.concatenate([two * np.uint32(2246822519), three * np.uint32(2654435761)]) >> np.uint32(32 - BITS)).astype(np.int64)


def codewords(languages: int) -> np.ndarray:
    """A row of +1 and -1 for each language: all splits of the languages in two if they are few, else 63 pseudo-random
    ones of which each has both signs."""
    if languages <= 6:
        splits = range(1, 1 << max(languages - 1, 1))
        return np.array([[1 if i and s >> (i - 1) & 1 else -1 for s in splits] for i in range(languages)], dtype=float).reshape(languages, len(splits))
    columns, k = [], 0
    while len(columns) < 63:
        bits = [hashlib.sha256(f"{k}/{i}".encode()).digest()[0] & 1 for i in range(languages)]
        k += 1
        if 0 < sum(bits) < languages:
            columns.append([2 * b - 1 for b in bits])
    return np.array(columns, dtype=float).T


def smoothed(histograms: np.ndarray) -> np.ndarray:
    """Distributions over the slots, none of them empty."""
    return (1 - 1e-3) * histograms / np.maximum(histograms.sum(axis=-1, keepdims=True), 1e-12) + 1e-3 / DIM


class Model:
    """languages, code (languages x bits), weights (slots x bits) and bias (bits)."""

    def __init__(self, languages: list[str], histograms: np.ndarray | None = None):
        """histograms: the languages' distributions, where they are few enough to hold together."""
        self.languages, self.code = languages, codewords(len(languages))
        self.weights, self.bias = np.zeros((DIM, self.code.shape[1]), np.float32), np.zeros(self.code.shape[1])
        if histograms is not None:
            p, has = smoothed(histograms), (self.code > 0).T
            ends = lambda x: (np.where(has, x, np.inf).min(axis=1), np.where(has, -np.inf, x).max(axis=1))
            self.learn(has @ p, p.sum(axis=0), lambda weights: ends((p @ weights).T))

    def learn(self, having: np.ndarray, total: np.ndarray, ends) -> None:
        """having: for each bit, the sum of the distributions of the languages that have it; total: that of all; ends: by
        weights, each bit's least expectation of the languages that have it and the largest of the others."""
        n, have = len(self.languages), (self.code > 0).sum(axis=0)
        split = np.flatnonzero((have > 0) & (have < n))
        weights = np.zeros((DIM, len(have)))
        weights[:, split] = (np.log(having[split] / have[split, None]) - np.log((total - having[split]) / (n - have[split])[:, None])).T
        high, low = ends(weights)
        half = np.maximum((high - low)[split] / 2, 1e-6)
        self.weights[:, split], self.bias[split] = weights[:, split] / half, -(high + low)[split] / 2 / half

    def margins(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.bias)), 0
        for slots in grams(text):
            total += self.weights[slots].sum(axis=0, dtype=np.float64)
            n += len(slots)
        return total / max(n, 1) + self.bias

    def decode(self, margins: np.ndarray) -> tuple[str, float, float]:
        """The language of least loss, its share of exp(-loss), and the gap to the runner-up."""
        loss = np.logaddexp(0, -2 * self.code * margins).sum(axis=1)
        order = np.argsort(loss, kind="stable")
        share = np.exp(loss[order[0]] - loss)
        gap = float(loss[order[1]] - loss[order[0]]) if len(order) > 1 else 99.0
        return self.languages[order[0]], float(1 / share.sum()), gap


#: Languages whose distributions a task holds at once, a quarter of a megabyte each; and languages that are broadcast.
TOGETHER, FEW = 64, 50_000


def _histograms(pdfs):
    """Sums of the rows' distributions by language, of some languages at a time."""
    sums: dict[str, np.ndarray] = {}
    rows = lambda: pd.DataFrame({"lang": list(sums), "h": [v.tobytes() for v in sums.values()]})
    for pdf in pdfs:
        for text, lang in zip(pdf["text"], pdf["lang"]):
            h = np.zeros(DIM)
            for slots in grams(text):
                h += np.bincount(slots, minlength=DIM)
            if lang not in sums and len(sums) == TOGETHER:
                yield rows()
                sums = {}
            sums[lang] = sums.get(lang, 0) + h / h.sum()
    if sums:
        yield rows()


def _together(pdf: pd.DataFrame) -> pd.DataFrame:
    """A language's distribution, smoothed."""
    return pd.DataFrame({"lang": pdf["lang"][:1], "h": [smoothed(sum(np.frombuffer(h) for h in pdf["h"])).tobytes()]})


def _sides(signs: dict[str, np.ndarray]):
    """For each bit, the sum of the distributions of the languages that have it; and, as bit -1, that of all."""

    def run(pdfs):
        total = None
        for pdf in pdfs:
            for lang, h in zip(pdf["lang"], pdf["h"]):
                own = np.append(signs[lang] > 0, True)
                total = np.zeros((len(own), DIM)) if total is None else total
                total[own] += np.frombuffer(h)
        if total is not None:
            for b, h in enumerate(total):
                yield pd.DataFrame({"bit": [b if b < len(total) - 1 else -1], "h": [h.tobytes()]})

    return run


def _bounds(signs: dict[str, np.ndarray], weights: np.ndarray):
    """For each bit, the least expectation of the languages that have it and the largest of those that don't."""

    def run(pdfs):
        for pdf in pdfs:
            for lang, h in zip(pdf["lang"], pdf["h"]):
                x = np.frombuffer(h) @ weights
                yield pd.DataFrame({"bit": np.arange(len(x)), "high": np.where(signs[lang] > 0, x, np.inf), "low": np.where(signs[lang] > 0, -np.inf, x)})

    return run


def fitted(by_language: DataFrame, languages: list[str]) -> Model:
    """by_language(lang, h): a written table with the distribution of each of the languages, which are in order."""
    model = Model(languages)
    signs, bits = dict(zip(languages, model.code)), model.code.shape[1]
    having, total = np.zeros((bits, DIM)), np.zeros(DIM)
    for r in by_language.mapInPandas(tidy(_sides(signs)), "bit int, h binary").toLocalIterator():
        (total if r["bit"] < 0 else having[r["bit"]])[:] += np.frombuffer(r["h"])

    def ends(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = by_language.mapInPandas(tidy(_bounds(signs, weights)), "bit int, high double, low double").groupBy("bit").agg(F.min("high"), F.max("low"))
        return tuple(np.array(x) for x in list(zip(*sorted(map(tuple, found.collect()))))[1:])

    if languages:
        model.learn(having, total, ends)
    return model


def train(docs: DataFrame, training: Column, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id", sample_rows: int = 20_000, parts: int = 8) -> Model:
    """Fits on a sample of about sample_rows rows of those where `training` holds, chosen by a hash of id and text, and of
    each language on the row whose hash is the smallest."""
    rows = docs.where(training & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(key_col).alias("key"))
    spot = F.pmod(F.xxhash64("key", "text"), F.lit(1 << 30))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min(spot).alias("least")).orderBy(F.desc("n"), "lang").collect()
    left, rates = sample_rows, []
    for k, r in enumerate(reversed(counts)):  # what a rare language leaves of its share goes to the others
        share = min(r["n"], left / (len(counts) - k))
        left -= share
        rates.append((r["lang"], max(int(share / r["n"] * (1 << 30)), r["least"] + 1)))
    rate = docs.sparkSession.createDataFrame(rates, f"lang {docs.schema[lang_col].dataType.simpleString()}, rate long")
    rows = rows.join(F.broadcast(rate) if len(rates) <= FEW else rate, "lang").where(spot < F.col("rate"))
    sums = rows.select("text", F.col("lang").cast("string").alias("lang")).repartition(parts).mapInPandas(tidy(_histograms), "lang string, h binary")
    by_language = sums.groupBy("lang").applyInPandas(_together, "lang string, h binary")
    table = write_table(by_language.repartition(max(1, -(-len(rates) // TOGETHER)), "lang"), "languages")
    languages = sorted(r["lang"] for r in table.select("lang").collect())
    model = fitted(table, languages)
    drop_table(table)
    return model


def predict(docs: DataFrame, model: Model, text_col: str = "text", gap: float = 0.5, names: tuple[str, str, str] = ("lang_pred", "score", "ambiguous")) -> DataFrame:
    """docs with lang_pred, score and ambiguous (the runner-up's loss is within `gap`), or under other names, in place of
    columns of those names."""
    docs = docs.drop(*(n for n in names if n != text_col))
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(at):
                text = text.as_py()
                if not text or not model.languages or not LETTER(text):
                    out.append(("und", 0.0, False))
                else:
                    lang, score, between = model.decode(model.margins(text))
                    out.append((lang, score, between < gap))
            langs, scores, flags = zip(*out) if out else ((), (), ())
            yield pa.record_batch([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(flags, pa.bool_())], names=[*batch.schema.names, *names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(tidy(run), f"{schema}, `{names[0]}` string, `{names[1]}` double, `{names[2]}` boolean")


def held_out(doc_id: str = "doc_id") -> Column:
    return fold(F.col(doc_id), 4) == 2


def identify(docs: DataFrame, **options) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, lang_pred, score, ambiguous; fitted on rows not held out."""
    model = train(docs, ~held_out(), **options)
    scored = predict(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")
