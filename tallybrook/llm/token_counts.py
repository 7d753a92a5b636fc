"""Token counts from a compiled finite-state tokenizer (operator 10).

The byte-level BPE is compiled, as states are first reached, into a deterministic transducer over characters. Let f(p)
be the number of tokens of a prefix p taken as a whole text; a transition carries f(p + c) - f(p), so the sum over the
transitions of a text is its token count. Two machines are composed:

* inside a pre-token the last token of every prefix is unique, and a token t may end a prefix exactly if t alone and the
  pair (last token before t, t) both encode to themselves. A state is thus the longest suffix that can still begin a
  token, with the last token and the relative count at each of its positions: finitely many;
* the pre-token rules (contractions, letter, number and other runs with one leading space, white space whose last
  character goes with what follows) are an automaton over character classes whose states hold the states above.

Where white space or another kind of character follows a run, and behind a special string, every state behaves as the
start state; texts up to chunk_chars run from there in one go, parts between such places counted once. Longer ones are cut into chunks, at such places where there are any. A chunk
acts as a map from incoming states to (outgoing state, count). Its first entry is for the start state, or, where the cut
is at no such place, for the state that the characters before it lead to, which most texts agree on soon; then entries
are added, in rounds over all chunks at once, for every state that the chunk before may end in, until no state is
missing. Maps hold states and counts, never texts, and pairs of neighbours compose into one (a join on the state
between them), level by level, as in a parallel prefix scan, so a text's chunks and maps lie in as many tasks as it
needs.

Defined results: a null text counts as empty (0 tokens); a very long text is cut as above, with or without white space;
repeated rows each give a row; an empty table gives an empty result; further columns don't matter, whatever their names.
"""

from __future__ import annotations

import json
import re
import unicodedata
from ast import literal_eval
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import Memo, write_table

#: Unicode's White_Space, as a character class of re.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Characters that are surely letters, beside others that may be.
LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
_IS_SPACE, _HAS_SPACE = re.compile(rf"[{SPACE}]").fullmatch, re.compile(rf"[{SPACE}]").search
#: Up to the last such place.
LAST_RESET = re.compile(rf"(?s).*[^{SPACE}](?=[{SPACE}])")
#: How many characters before a cut give the first guess of the state there.
LEAD = 512
ONE_LETTER, TWO_LETTERS = {"s", "t", "m", "d"}, {"r": "e", "v": "e", "l": "l"}


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, others from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class WordMachine:
    """The transducer inside one pre-token, state by state. State 0 is the empty prefix."""

    def __init__(self, merges: list[tuple[bytes, bytes]]):
        self.number = {bytes([b]): b for b in range(256)}
        self.split: list[tuple[int, int]] = [(-1, -1)] * 256
        self.joined: dict[tuple[int, int], int] = {}
        for left, right in merges:  # tokens are numbered in the order of the merges that make them
            pair = (self.number[left], self.number[right])
            if self.joined.setdefault(pair, k := len(self.split)) == k:
                self.number.setdefault(left + right, k)
                self.split.append(pair)
        self.begins = {t[:k] for t in self.number for k in range(1, len(t))}
        self.stable: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        self.keys: list[tuple] = [(b"", (-1,), (0,))]
        self.ids = {self.keys[0]: 0}

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens side by side stay apart: undoes the later merge of the two, again and again, and looks
        for a merge across the border that would have come before it."""
        key = left << 32 | right
        if (known := self.stable.get(key)) is not None:
            return known
        split, joined, limit, ok = self.split, self.joined, 1 << 60, True
        while True:
            if (k := joined.get((left, right))) is not None and k < limit:
                ok = False
                break
            if left < 256 and right < 256:
                break
            if right < 256 or left > right and left >= 256:
                limit, left = left, split[left][1]
            else:
                limit, right = right + 1, split[right][0]
        self.stable[key] = ok
        return ok

    def step(self, state: int, char: str) -> tuple[int, int]:
        """The next state and by how much the count changes. A state is its window, and for each position there the
        last token before it and the tokens since."""
        window, lasts, since = self.keys[state]
        change = 0
        for b in char.encode("utf-8", "surrogatepass"):
            window += bytes([b])
            for k, last in enumerate(lasts):
                token = self.number.get(window[k:])
                if token is not None and (last < 0 or self.fits(last, token)):
                    break
            delta = 1 - since[k]
            change += delta
            cut = next(k for k in range(len(window) + 1) if k == len(window) or window[k:] in self.begins)
            window, lasts, since = window[cut:], (*lasts[cut:], token), (*(n + delta for n in since[cut:]), 0)
        return self.number_of((window, lasts, since)), change

    def number_of(self, key: tuple) -> int:
        if (k := self.ids.get(key)) is None:
            k = self.ids[key] = len(self.keys)
            self.keys.append(key)
        return k


class TextMachine:
    """The transducer over whole texts: states are tuples that hold states of the word machine."""

    START = ("start",)

    def __init__(self, words: WordMachine, special: list[str], most_states: int = 300_000):
        self.words, self.most = words, most_states
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.segments = segment_pattern(special).findall
        self.longest = max(map(len, special), default=0)
        self.classes = Memo(self._class_of)
        self.reset()

    def reset(self) -> None:
        self.words.reset()
        self.keys, self.ids, self.arcs = [self.START], {self.START: 0}, {}

    @staticmethod
    def _class_of(char: str) -> str:
        kind = unicodedata.category(char)[0]
        return "space" if _IS_SPACE(char) else kind if kind in "LN" else "other"

    def _walk(self, *chars: str) -> tuple[int, int]:
        state = total = 0
        for c in chars:
            state, n = self.words.step(state, c)
            total += n
        return state, total

    def _open(self, char: str) -> tuple[tuple, int]:
        """Where a new pre-token begins with char."""
        kind = self.classes[char]
        state, n = self._walk(char)
        if kind == "space":
            return ("space", 0, state, char, n), n
        return (("quote",) if char == "'" else ("run", kind, state)), n

    def _next(self, key: tuple, char: str) -> tuple[tuple, int]:
        kind, mode = self.classes[char], key[0]
        if mode == "run":
            if kind == key[1]:
                state, n = self.words.step(key[2], char)
                return ("run", kind, state), n
        elif mode == "space":
            _, _, whole, last, added = key
            if kind == "space":
                state, n = self.words.step(whole, char)
                return ("space", whole, state, char, n), n
            if last == " ":
                state, n = self._walk(" ", char)
                return ("run", kind, state), n - added
            alone = self._walk(last)[1]
            to, n = self._open(char)
            return to, n + alone - added
        elif mode == "quote":
            if char in ONE_LETTER:
                return self.START, self._walk("'", char)[1] - 1
            if char in TWO_LETTERS:
                return ("half", char), self._walk(char)[1]
            if kind == "other":
                state, n = self._walk("'", char)
                return ("run", kind, state), n - 1
        elif mode == "half":
            if TWO_LETTERS[key[1]] == char:
                return self.START, self._walk("'", key[1], char)[1] - 1 - self._walk(key[1])[1]
            if kind == "L":
                state, n = self._walk(key[1], char)
                return ("run", "L", state), n - self._walk(key[1])[1]
        return self._open(char)

    def run(self, text: str, state: int = 0) -> tuple[int, int]:
        """The state that a text leads to, and the tokens it adds. Special strings, which no pre-token rule sees, count
        one each and lead to the start."""
        total, arcs = 0, self.arcs
        parts = self.special.split(text) if self.special else [text]
        for n, part in enumerate(parts):
            if n:
                state, total = 0, total + 1
            for char in part:
                at = state << 21 | ord(char)
                if (arc := arcs.get(at)) is None:
                    to, change = self._next(self.keys[state], char)
                    arc = arcs[at] = self._number(to) << 12 | change + 2048  # the state and the emission in one number
                state = arc >> 12
                total += (arc & 4095) - 2048
        return state, total

    def _number(self, key: tuple) -> int:
        if (k := self.ids.get(key)) is None:
            k = self.ids[key] = len(self.keys)
            self.keys.append(key)
        return k

    def count(self, text: str) -> int:
        """Tokens of a text from the start state."""
        if len(self.keys) > self.most:
            self.reset()
        return self.run(text)[1]

    def shown(self, state: int) -> str:
        """A state as text that another machine of the same rules understands."""
        key = self.keys[state]
        at = {"run": (2,), "space": (1, 2)}.get(key[0], ())
        return repr(tuple(self.words.keys[x] if i in at else x for i, x in enumerate(key)))

    def known(self, shown: str) -> int:
        key = literal_eval(shown)
        at = {"run": (2,), "space": (1, 2)}.get(key[0], ())
        return self._number(tuple(self.words.number_of(x) if i in at else x for i, x in enumerate(key)))


def segment_pattern(special: list[str]) -> re.Pattern:
    """Parts of a text, before each of which every state behaves as the start state: runs of letters, digits or marks
    with the white space before them, where what follows surely is of another kind; else all up to white space. Marks
    of special strings never end a part."""
    marks = re.escape("".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'" and not any(c in x for x in special)))
    runs = rf"(?:'?[{LATIN}]++|[0-9]++)(?=[{LATIN}0-9'{marks}{SPACE}]|\Z)|[{marks}]++(?=[{LATIN}0-9{SPACE}]|\Z)"
    return re.compile(rf"[{SPACE}]*+(?:{runs}|[^{SPACE}]++)|[{SPACE}]++\Z")


@lru_cache(maxsize=2)
def machine(path: str) -> TextMachine:
    """Compiles the rules of a byte-level BPE in a tokenizer file; further states come as texts reach them."""
    with open(path, encoding="utf-8") as f:
        rules = json.load(f)
    of = byte_of_char()
    raw = lambda token: bytes(map(of.__getitem__, token))
    special = [t["content"] for t in rules["added_tokens"]]
    if any(map(_HAS_SPACE, special)):
        raise ValueError("special strings with white space aren't supported")
    pairs = [m if isinstance(m, list) else m.split(" ") for m in rules["model"]["merges"]]
    return TextMachine(WordMachine([(raw(a), raw(b)) for a, b in pairs]), special)


@lru_cache(maxsize=2)
def segment_counts(path: str) -> Memo:
    """Tokens of segments from the start state."""
    return Memo(machine(path).count, most=250_000)


def cuts(text: str, size: int, rules: TextMachine) -> list[tuple[int, bool]]:
    """Where chunks of at most `size` characters begin, and whether every state behaves as the start state there. No
    cut is inside a special string."""
    out, at = [(0, True)], 0
    while len(text) - at > size:
        if found := LAST_RESET.match(text, at, at + size + 1):
            at, reset = found.end(), True
        else:
            to, reset = at + size, False
            for m in rules.special.finditer(text, max(at + 1, to - rules.longest), to + rules.longest) if rules.special else ():
                if m.start() < to < m.end():
                    to = m.start()
            at = to
        out.append((at, reset))
    return out


def chunk_from(rules: TextMachine, memo: Memo, chunk: str, state: str) -> tuple[str, int]:
    """A chunk's entry for one incoming state: the outgoing state and the tokens added. What stands between its first
    and last reset counts by segments."""
    if len(rules.keys) > rules.most:
        rules.reset()
    parts = rules.segments(chunk)
    at, total = rules.run(parts[0] if parts else "", rules.known(state))
    if len(parts) > 1:
        total += sum(map(memo.__getitem__, parts[1:-1]))
        at, n = rules.run(parts[-1])
        total += n
    return rules.shown(at), total


def _whole(path: str):
    def run(batches):
        memo, segments = segment_counts(path), machine(path).segments
        for batch in batches:
            totals = [sum(map(memo.__getitem__, segments(t))) for t in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(totals, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])
        memo.clear()  # a worker that waits for its next task holds no segments

    return run


def _cut(path: str, size: int):
    def run(batches):
        rules = machine(path)
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                begins = cuts(text, size, rules)
                ends = [a for a, _ in begins[1:]] + [len(text)]
                for k, ((a, reset), b) in enumerate(zip(begins, ends)):
                    first = 0 if reset else rules.run(text[max(0, a - LEAD) : a])[0]
                    yield pa.record_batch([[row], pa.array([k], pa.int64()), [text[a:b]], [rules.shown(first)], [reset]], names=["row", "at", "chunk", "state", "reset"])

    return run


def _entries(path: str):
    def run(batches):
        rules, memo = machine(path), segment_counts(path)
        for batch in batches:
            found = [chunk_from(rules, memo, c, s) for c, s in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            after, counts = zip(*found) if found else ((), ())
            yield pa.record_batch([batch.column(0), batch.column(1), batch.column(3), pa.array(after, pa.string()), pa.array(counts, pa.int64())], names=["row", "at", "state", "after", "n"])

    return run


def chunk_maps(chunks: DataFrame, path: str) -> DataFrame:
    """chunks(row, at, chunk, state, reset) -> row, at, state, after, n: the maps, with an entry for every state that a
    chunk's neighbour may hand on. What is handed to a chunk that begins at a reset is the start state."""
    # dealt by chunk, so that the chunks of one text are spread over the tasks
    dealt = lambda df: df.repartition("row", "at").select("row", "at", "chunk", "state").mapInArrow(_entries(path), "row long, at long, state string, after string, n long")
    resets = chunks.where("reset").select("row", (F.col("at") - 1).alias("at"), F.col("state").alias("begin"))
    handing = lambda df: dealt(df).join(resets, ["row", "at"], "left").withColumn("after", F.coalesce("begin", "after")).drop("begin")
    maps = write_table(handing(chunks), "maps")
    while True:
        handed = maps.select("row", (F.col("at") + 1).alias("at"), F.col("after").alias("state")).distinct()
        unknown = handed.join(maps.select("row", "at", "state"), ["row", "at", "state"], "left_anti")
        missing = write_table(unknown.join(chunks.select("row", "at", "chunk"), ["row", "at"]).select("row", "at", "chunk", "state"), "asked")
        if missing.isEmpty():
            return maps
        maps = write_table(maps.unionByName(handing(missing)), "maps")


def scanned(maps: DataFrame) -> DataFrame:
    """row, n: the maps of each row's chunks, composed in pairs until one is left, and applied to the start state."""
    half = F.floor(F.col("at") / 2).alias("half")
    while not maps.where("at > 0").isEmpty():
        left = maps.where("at % 2 = 0").select("row", half, "state", F.col("after").alias("between"), F.col("n").alias("n_left"))
        right = maps.where("at % 2 = 1").select("row", half, F.col("state").alias("between"), "after", F.col("n").alias("n_right"))
        both = left.join(right, ["row", "half", "between"]).select("row", F.col("half").alias("at"), "state", "after", (F.col("n_left") + F.col("n_right")).alias("n"))
        alone = left.join(right.select("row", "half").distinct(), ["row", "half"], "left_anti").select("row", F.col("half").alias("at"), "state", F.col("between").alias("after"), F.col("n_left").alias("n"))
        maps = write_table(both.unionByName(alone), "scan")
    return maps.where(F.col("state") == repr(TextMachine.START)).select("row", "n")


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024, chunk_chars: int = 1 << 16) -> DataFrame:
    """One row for each row of docs: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    path: a tokenizer file that every executor has. Only texts longer than chunk_chars are shuffled, in chunks.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("n_bytes", F.octet_length("text").cast("long"))
    kind = docs.schema[id_col].dataType.simpleString()
    short = rows.where(F.length("text") <= chunk_chars).select("doc_id", "n_bytes", "text").mapInArrow(_whole(path), f"doc_id {kind}, n_bytes long, n_tokens long")
    # the row numbers of the written table hold from then on
    long = write_table(rows.where(F.length("text") > chunk_chars).withColumn("row", F.monotonically_increasing_id()), "long")
    chunks = write_table(long.select("row", "text").mapInArrow(_cut(path, chunk_chars), "row long, at long, chunk string, state string, reset boolean"), "chunks")
    if chunks.isEmpty():
        return short.withColumn("over_limit", F.col("n_tokens") > limit)
    counted = long.join(scanned(chunk_maps(chunks, path)), "row").select("doc_id", "n_bytes", F.col("n").alias("n_tokens"))
    return short.unionByName(counted).withColumn("over_limit", F.col("n_tokens") > limit)
