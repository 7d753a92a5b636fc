"""Toxicity by Levenshtein automata over a learned lexicon trie (operator 2).

Learning, on a bounded sample of labelled rows: words whose document counts lean strongly to toxic rows become terms;
a beginning that many such words share becomes an open term, which any ending may follow, if the documents that hold it
lean as strongly; the words below it stay terms beside it. Terms form one trie.
Matching intersects the trie with each term's Levenshtein automaton (more edits for longer terms): the intersection is
determinised as words reach its states, and most words leave it after a few letters. Each hit scores the weight that
the sample gives its term with that many edits; where such words turn up in clean texts, the term with these edits is
void and a word goes to the next term that it fits, which is weighed anew. A hit scores far less if it stands between quotation marks, more with further hits in its window of words. A
logistic curve fitted on the same sample turns the sum into a probability.

Defined results: null and empty texts have no hits and get the score of a text without hits; very long texts count whole;
of terms that a word fits with equally few edits, the heavier and then the smaller one counts, and of several labels of
an id the largest; no labelled rows: score 0 for all; repeated rows each give a row; an empty table gives an empty
result; further columns stay, but for those under the names of the results.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import Memo, fold, tidy, write_table

WORD = re.compile(r"\w+")
QUOTES = "\"“”„«»‹›‘"
#: Words on either side that a hit's context covers, and how many characters a quotation may reach.
WINDOW, QUOTED_CHARS, QUOTED, NEAR = 12, 80, 0.25, 0.2
EDIT_FACTOR = (1.0, 0.7, 0.5)
#: Ends the name of an open term, which may also be a term of its own; and the share of toxic documents that a weight takes.
ANY, CLEAR = "*", 0.9


def edits(term: str, is_open: bool) -> int:
    """Edits that a match may need; open terms end early, so they get none."""
    return 0 if is_open or len(term) < 5 else 1 if len(term) < 8 else 2


class Trie:
    """Terms as nodes: arcs by letter, the terms that end at a node, and the terms' edits below it. Void (term, edits)
    don't match."""

    def __init__(self, terms: dict[str, tuple[float, bool]], void: set[tuple[str, int]] = frozenset()):
        self.void = void
        self.arcs: list[dict[str, int]] = [{}]
        self.ends: list[list[tuple[str, float, bool]]] = [[]]
        self.most = [-1]
        for term, (weight, is_open) in sorted(terms.items()):
            at, k = 0, max((k for k in range(edits(term, is_open) + 1) if (term, k) not in void), default=-1)
            if k < 0:
                continue
            self.most[0] = max(self.most[0], k)
            for c in term.removesuffix(ANY) if is_open else term:
                if c not in self.arcs[at]:
                    self.arcs[at][c] = len(self.arcs)
                    self.arcs.append({})
                    self.ends.append([])
                    self.most.append(-1)
                at = self.arcs[at][c]
                self.most[at] = max(self.most[at], k)
            self.ends[at].append((term, weight, is_open))


class Automaton:
    """The intersection, determinised as needed. A state is the set of (node, edits so far); edits are insertion,
    deletion and substitution."""

    DEAD = 0

    def __init__(self, trie: Trie, most_states: int = 100_000):
        self.trie, self.most_states = trie, most_states
        self.reset()

    def reset(self) -> None:
        self.states: list[frozenset] = [frozenset()]
        self.ids = {self.states[0]: 0}
        #: By state: the best term that a word may end with here, and the best open term, as (edits, -weight, term).
        self.ending: list[tuple | None] = [None]
        self.open: list[tuple | None] = [None]
        self.arcs: dict[int, int] = {}
        self.start = self._number({0: 0})

    def _number(self, reach: dict[int, int]) -> int:
        """Closes over skipped term letters and drops what no term below a node allows."""
        todo = list(reach.items())
        while todo:
            node, k = todo.pop()
            if reach.get(node, 99) < k:
                continue
            for to in self.trie.arcs[node].values():
                if k + 1 <= self.trie.most[to] and reach.get(to, 99) > k + 1:
                    reach[to] = k + 1
                    todo.append((to, k + 1))
        key = frozenset(x for x in reach.items() if x[1] <= self.trie.most[x[0]])
        if (known := self.ids.get(key)) is None:
            known = self.ids[key] = len(self.states)
            self.states.append(key)
            ends = [(k, -end[1], end[0], end[2]) for node, k in key for end in self.trie.ends[node] if k <= edits(end[0], end[2]) and (end[0], k) not in self.trie.void]
            self.ending.append(min(ends, default=None))
            self.open.append(min((e for e in ends if e[3]), default=None))
        return known

    def _step(self, state: int, char: str) -> int:
        reach: dict[int, int] = {}

        def put(node: int, k: int) -> None:
            if k <= self.trie.most[node] and reach.get(node, 99) > k:
                reach[node] = k

        for node, k in self.states[state]:
            put(node, k + 1)  # a letter too many
            for c, to in self.trie.arcs[node].items():
                put(to, k if c == char else k + 1)
        return self._number(reach)

    def match(self, word: str) -> tuple[str, int] | None:
        """The term that a word is with the fewest edits, and those; then the heavier term, then the smaller."""
        return self.matches(word)[0]

    def matches(self, word: str) -> tuple[tuple[str, int] | None, tuple[str, int] | None]:
        """That match, and the best of open terms alone."""
        if len(self.states) > self.most_states:
            self.reset()
        state, free, arcs, opened = self.start, None, self.arcs, self.open
        for c in word:
            at = state << 21 | ord(c)
            if (to := arcs.get(at)) is None:
                to = arcs[at] = self._step(state, c)
            state = to
            if not state:
                break
            if (found := opened[state]) and (free is None or found < free):
                free = found
        best = free
        if (found := self.ending[state]) and (best is None or found < best):
            best = found
        return best and (best[2], best[0]), free and (free[2], free[0])


class Lexicon:
    def __init__(self, terms: dict[str, tuple[float, bool]]):
        self.terms, self.slope, self.offset = terms, 0.0, -99.0
        #: Weights of (term, edits): what the sample says, else the term's own, less for edits.
        self.weights = {(t, k): w * EDIT_FACTOR[k] for t, (w, is_open) in terms.items() for k in range(edits(t, is_open) + 1)}
        self._memo = None

    def __getstate__(self):
        return {**self.__dict__, "_memo": None}

    def void(self) -> set[tuple[str, int]]:
        return {m for m, w in self.weights.items() if w <= 0}

    def automaton(self) -> Automaton:
        return Automaton(Trie(self.terms, self.void()))

    def matches(self, lowered: str) -> list[tuple[int, tuple[str, int]]]:
        """Places of the hits, in words, with term and edits."""
        if self._memo is None:
            self._memo = Memo(self.automaton().match, most=120_000)
        return [(i, m) for i, m in enumerate(map(self._memo.__getitem__, WORD.findall(lowered))) if m]

    def hits(self, text: str) -> float:
        """The sum of the hits' scores over the whole text."""
        found = self.matches(text := text.lower())
        if not found:
            return 0.0
        wanted, spans = {i for i, _ in found}, {}
        if any(q in text for q in QUOTES):
            spans = {i: m.span() for i, m in enumerate(WORD.finditer(text)) if i in wanted}
        total, at = 0.0, [i for i, _ in found]
        for n, (i, m) in enumerate(found):
            near = (n > 0 and i - at[n - 1] <= WINDOW) + (n + 1 < len(at) and at[n + 1] - i <= WINDOW)
            quoted = i in spans and self._quoted(text, *spans[i])
            total += self.weights[m] * (QUOTED if quoted else 1.0) * (1 + NEAR * near)
        return total

    @staticmethod
    def _quoted(text: str, start: int, end: int) -> bool:
        """Whether quotation marks of the same line stand on both sides within reach."""
        before = text[max(0, start - QUOTED_CHARS) : start].rsplit("\n", 1)[-1]
        after = text[end : end + QUOTED_CHARS].split("\n", 1)[0]
        return sum(before.count(q) for q in QUOTES) % 2 == 1 and any(q in after for q in QUOTES)

    def score(self, text: str | None) -> float:
        x = self.slope * math.log1p(self.hits(text) if text else 0.0) + self.offset
        return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def _lean(toxic: Column, clean: Column, n_toxic: int, n_clean: int) -> tuple[Column, Column]:
    """Log-likelihood ratio of a term's split against that of all rows, and its smoothed log odds."""
    n = toxic + clean
    share = n_toxic / (n_toxic + n_clean)
    part = lambda k, p: F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0)
    return 2 * (part(toxic, share) + part(clean, 1 - share)), F.log((toxic + 0.5) / (n_toxic + 1)) - F.log((clean + 0.5) / (n_clean + 1))


def train(docs: DataFrame, labels: DataFrame, training: Column, sample_rows: int = 20_000, min_ratio: float = 24.0) -> Lexicon:
    """docs(doc_id, text), labels(doc_id, toxic); `training` is a condition on doc_id. Fits on a sample of about
    sample_rows labelled rows, chosen by a hash of the id, which bounds the terms too: each stands in four toxic rows of
    the sample at least and leans as strongly as min_ratio, a log-likelihood ratio, says."""
    known = labels.where(training & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    if n > sample_rows:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(sample_rows / n * (1 << 30)))
    rows = write_table(docs.where(training & F.col("text").isNotNull()).select("doc_id", "text").join(known, "doc_id"), "labelled")
    counts = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = counts.get(1, 0), counts.get(0, 0)
    lexicon = Lexicon({})
    if not n_toxic or not n_clean:
        lexicon.offset = 99.0 if n_toxic else -99.0
        return lexicon
    words = rows.select("toxic", F.array_distinct(F.split(F.lower("text"), r"(?U)\W+")).alias("words"))
    counted = lambda df: df.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
    by_word = counted(words.select("toxic", F.explode("words").alias("term")).where("term != ''")).withColumn("kinds", F.lit(1))
    starts = by_word.select("*", F.explode(F.filter(F.array(*map(F.lit, (4, 5, 6))), lambda k: k < F.length("term"))).alias("k"))
    starts = starts.groupBy(F.expr("substring(term, 1, k)").alias("term")).agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.count("*").alias("kinds"))
    ratio, odds = _lean(F.col("toxic"), F.col("clean"), n_toxic, n_clean)
    clear = F.col("toxic") >= CLEAR * (F.col("toxic") + F.col("clean"))
    #: Beginnings by the documents that hold them, also as whole words: an open term matches both.
    held = "array_distinct(flatten(transform(words, w -> transform(filter(array(4, 5, 6), k -> k <= length(w)), k -> substring(w, 1, k)))))"
    by_doc = counted(words.select("toxic", F.explode(F.expr(held)).alias("term"))).where(clear).select("term")
    strong = lambda df, precise: df.where((F.col("toxic") >= precise * (F.col("toxic") + F.col("clean"))) & (ratio >= min_ratio)).select("term", ratio.alias("ratio"), odds.alias("odds"), "kinds")
    opened: dict[str, tuple[float, bool]] = {}
    for r in sorted(strong(starts.where("kinds >= 6"), 0.85).join(by_doc, "term", "left_semi").collect(), key=lambda r: (len(r["term"]), r["term"])):
        if not any(r["term"].startswith(x.removesuffix(ANY)) for x in opened):
            opened[r["term"] + ANY] = (r["odds"], True)
    terms = {r["term"]: (r["odds"], False) for r in strong(by_word.where("toxic >= 4"), 0.8).collect()}
    lexicon = Lexicon(terms | opened)

    def seen_hits(pdfs):
        memo = Memo(lexicon.automaton().matches, most=120_000)
        for pdf in pdfs:
            found = ({m for w in WORD.findall(t.lower()) for m in memo[w] if m} for t in pdf["text"])
            out = [(*m, y) for ms, y in zip(found, pdf["toxic"]) for m in ms]
            yield pd.DataFrame(out, columns=["term", "edits", "toxic"]).astype({"edits": "int32", "toxic": "int32"})

    # A word counts for its match, and for its open term too; each round either makes some void or is the last.
    void = None
    while void != (void := lexicon.void()):
        leaning = rows.select("text", "toxic").mapInPandas(tidy(seen_hits), "term string, edits int, toxic int").groupBy("term", "edits").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
        for r in leaning.select("term", "edits", odds.alias("odds"), clear.alias("clear")).collect():
            lexicon.weights[r["term"], r["edits"]] = r["odds"] if r["clear"] else 0.0

    def totals(pdfs):
        for pdf in pdfs:
            yield pd.DataFrame({"x": [math.log1p(lexicon.hits(t)) for t in pdf["text"]], "toxic": pdf["toxic"].astype("int32")})
        lexicon._memo = None

    seen = rows.select("text", "toxic").mapInPandas(tidy(totals), "x double, toxic int").groupBy(F.round("x", 2).alias("x"), "toxic").count().collect()
    lexicon.slope, lexicon.offset = logistic(np.array([r["x"] for r in seen]), np.array([r["toxic"] for r in seen]), np.array([r["count"] for r in seen], float))
    return lexicon


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and offset by Newton's method."""
    a = np.stack([x, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + ridge * np.eye(2), a.T @ (weight * (y - p)) - ridge * w)
        w += np.clip(step, -5, 5)
        if abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def predict(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """docs with score and predicted (1 if score >= 0.5), or under other names, in place of columns of those names."""
    docs = docs.drop(*(n for n in names if n != text_col))
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            scores = pa.array([lexicon.score(t.as_py()) for t in batch.column(at)], pa.float64())
            yield pa.record_batch([*batch.columns, scores], names=[*batch.schema.names, names[0]])
        lexicon._memo = None

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(tidy(run), f"{schema}, `{names[0]}` double").withColumn(names[1], (F.col(f"`{names[0]}`") >= 0.5).cast("int"))


def held_out(doc_id: str = "doc_id") -> Column:
    return fold(F.col(doc_id), 5) == 0


def detect(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score, predicted; fitted on rows not held out."""
    lexicon = train(docs, labels, ~held_out(), **options)
    return predict(docs.select("doc_id", "text"), lexicon).select("doc_id", held_out().alias("held_out"), "score", "predicted")
