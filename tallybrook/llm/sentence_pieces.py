"""SentencePiece encoding and decoding by shared-prefix Viterbi (operator 4).

White space is marked, and a marked word (marks and what follows up to the next mark) is encoded by itself, as no piece
holds a mark after another character. The distinct marked words of a batch are sorted, which makes them a trie in
depth-first order: from one word to the next, the forward scores of their common prefix are kept, and only the rest is
computed.

Forward scores of a unigram model are the best sums of piece scores. In a BPE model the order of merges decides, not
the sum: there a piece may follow another only if merging the two pieces' characters gives back just these two, any
other transition scores minus infinity, and a single path survives, which is the library's own encoding. Characters
without a piece become byte pieces. Decoding joins pieces and bytes, and turns marks back into spaces.

Defined results: null and empty texts have no pieces and decode to the empty text; a very long text is a group of its own
and is encoded whole; a text's own marks decode to spaces; repeated rows each give a row; an empty table gives an empty
result; further columns stay, but for one under the name of the result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import Memo

MARK = "▁"
WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+\\Z")
#: Where no piece joins Latin letters with anything but marks before them, words also end there.
LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
FINE_WORD = re.compile(f"{MARK}*[{LATIN}]+|{MARK}*[^{LATIN}{MARK}]+|{MARK}+\\Z")
JOINT = re.compile(f"[{LATIN}][^{LATIN}]|[^{LATIN}{MARK}][{LATIN}]").search
#: Numbers of single characters are their code points; longer pieces follow in the order of their scores.
BASE, SHIFT = 1 << 21, 23
WORST = float("-inf")


class Pieces:
    """A model's pieces. kind: bpe or unigram."""

    def __init__(self, pieces: list[str], scores: list[float], special: set[int], bytes_at: dict[int, int], unknown: int, kind: str = "bpe"):
        self.kind, self.unknown = kind, unknown
        self.id_of = {p: i for i, p in enumerate(pieces) if i not in special and i not in bytes_at}
        self.scores = scores
        self.byte_ids = {b: i for i, b in bytes_at.items()}
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.id_of):
            raise ValueError("a piece of this model goes on over white space")
        self.words = WORD if any(map(JOINT, self.id_of)) else FINE_WORD
        self.begins = {p[:k] for p in self.id_of for k in range(1, len(p))}
        order = sorted((p for p in self.id_of if len(p) > 1), key=lambda p: (-scores[self.id_of[p]], self.id_of[p]))
        self.number = {p: BASE + k for k, p in enumerate(order)}
        self.text = dict(zip(self.number.values(), order))
        #: Of each piece and beginning of one: twice the number of a longer piece (0: none), plus 1 where more may follow.
        self.info = {x: (self.number.get(x, 0) << 1) + (x in self.begins) for x in self.begins.union(order)}
        self.id_bytes = Memo(lambda k: np.array(self.ids(self.string(k)), "<i4").tobytes(), most=500_000)
        self.split: dict[int, tuple[int, int] | None] = {}
        self.stable: dict[int, bool] = {}
        self.raw = [bytes([bytes_at[i]]) if i in bytes_at else b"" if i in special else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]

    def string(self, number: int) -> str:
        return chr(number) if number < BASE else self.text[number]

    def halves(self, number: int) -> tuple[int, int] | None:
        """The last merge that makes a longer piece from its characters; None if merging doesn't end in the piece."""
        if number not in self.split:
            parts, last = [ord(c) for c in self.text[number]], None
            while len(parts) > 1:
                merged = [(k, i) for i, (x, y) in enumerate(zip(parts, parts[1:])) if (k := self.number.get(self.string(x) + self.string(y))) is not None]
                if not merged:
                    break
                k, i = min(merged)
                last = (parts[i], parts[i + 1])
                parts[i : i + 2] = [k]
            self.split[number] = last if len(parts) == 1 else None
        return self.split[number]

    def fits(self, left: int, right: int) -> bool:
        """Whether two pieces side by side stay apart: undoes the later merge of the two again and again, and looks for
        a merge over the border that would have come before it."""
        key = left << SHIFT | right
        if (known := self.stable.get(key)) is not None:
            return known
        if self.halves(right) is None:
            self.stable[key] = False
            return False
        limit, ok = 1 << 60, True
        while True:
            if (k := self.number.get(self.string(left) + self.string(right))) is not None and k < limit:
                ok = False
                break
            if left < BASE and right < BASE:
                break
            if right < BASE or left > right and left >= BASE:
                limit, left = left, self.halves(left)[1]
            else:
                limit, right = right + 1, self.halves(right)[0]
        self.stable[key] = ok
        return ok

    def ids(self, piece: str) -> list[int]:
        if (i := self.id_of.get(piece)) is not None:
            return [i]
        data = piece.encode("utf-8", "replace")
        return [self.byte_ids[b] for b in data] if self.byte_ids else [self.unknown]


class Forward:
    """The forward pass over one path of the trie: at each depth the best last piece, its start and the score, and
    where pieces that may still grow began."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.word = pieces, ""
        self.starts: list[list[int]] = [[]]
        self.last: list[int] = [-1]
        self.begin: list[int] = [0]
        self.score: list[float] = [0.0]

    def move_to(self, word: str) -> None:
        """Keeps what the common prefix with the word before has computed."""
        n, most = 0, min(len(word), len(self.word))
        while n < most and word[n] == self.word[n]:
            n += 1
        for x in (self.starts, self.last, self.begin, self.score):
            del x[n + 1 :]
        self.word = word
        (self._extend_merged if self.pieces.kind == "bpe" else self._extend_scored)(word, n)

    def _extend_merged(self, word: str, n: int) -> None:
        """The one piece that may end at each place: among those that fit what stands before, there is no second."""
        p = self.pieces
        info, stable, fits, last, starts, begin = p.info.get, p.stable.get, p.fits, self.last, self.starts, self.begin
        for i in range(n, len(word)):
            best = -1
            on = []
            for k in starts[i]:  # the earliest first: longer pieces first
                if (x := info(word[k : i + 1])) is None:
                    continue
                if best < 0 and x > 1:
                    number, before = x >> 1, last[k]
                    if before < 0:
                        ok = p.halves(number) is not None
                    elif (ok := stable(before << SHIFT | number)) is None:
                        ok = fits(before, number)
                    if ok:
                        best = k
                        last.append(number)
                if x & 1:
                    on.append(k)
            if best < 0:
                best = i
                last.append(ord(word[i]))
            if info(word[i]) is not None:  # single characters are there as beginnings only
                on.append(i)
            begin.append(best)
            starts.append(on)

    def _extend_scored(self, word: str, n: int) -> None:
        p, worst = self.pieces, min(self.pieces.scores) - 10
        for i in range(n, len(word)):
            best = (WORST, i)
            for k in [*self.starts[i], i]:
                at = p.id_of.get(word[k : i + 1])
                if at is not None or k == i:
                    best = max(best, (self.score[k] + (worst if at is None else p.scores[at]), k), key=lambda x: x[0])
            self.score.append(best[0])
            self.begin.append(best[1])
            self.starts.append([k for k in [*self.starts[i], i] if word[k : i + 1] in p.begins])

    def ids(self) -> bytes:
        """Little-endian 32-bit ids of the word."""
        out, at = [], len(self.word)
        merged, known = self.pieces.kind == "bpe", self.pieces.id_bytes
        while at:
            out.append(known[self.last[at]] if merged else np.array(self.pieces.ids(self.word[self.begin[at] : at]), "<i4").tobytes())
            at = self.begin[at]
        return b"".join(reversed(out))


def encode_words(words, pieces: Pieces) -> dict[str, bytes]:
    """Little-endian 32-bit ids of each distinct word."""
    forward, out = Forward(pieces), {}
    for word in sorted(words):
        forward.move_to(word)
        out[word] = forward.ids()
    return out


@lru_cache(maxsize=2)
def model(path: str, kind: str = "bpe") -> Pieces:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = range(sp.get_piece_size())
    special = {i for i in n if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
    return Pieces([sp.id_to_piece(i) for i in n], [sp.get_score(i) for i in n], special, {i: int(sp.id_to_piece(i)[1:-1], 16) for i in n if sp.is_byte(i)}, sp.unk_id(), kind)


def marked(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


def _carry(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.record_batch([*batch.columns, values], names=[*batch.schema.names, name])


def _parts(texts: pa.Array, chars: int):
    """Lists of texts of about so many characters, and at least one text."""
    part, size = [], 0
    for t in texts:
        part.append(t.as_py() or "")
        size += len(part[-1])
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def _encoder(path: str, kind: str, text_at: int, known_words: int, group_chars: int):
    def run(batches):
        pieces, known = model(path, kind), {}
        for batch in batches:
            ids = []
            for part in _parts(batch.column(text_at), group_chars):
                lists = [pieces.words.findall(marked(t)) for t in part]
                if len(known) > known_words:
                    known = {}
                if len(pieces.stable) > 500_000:
                    pieces.stable.clear()
                known |= encode_words(set().union(*lists).difference(known), pieces)
                ids += [b"".join(map(known.__getitem__, words)) for words in lists]
            yield _carry(batch, "ids", pa.array(ids, pa.binary()))

    return run


def _decoder(path: str, kind: str, ids_at: int):
    def run(batches):
        raw = model(path, kind).raw
        for batch in batches:
            texts = []
            for ids in batch.column(ids_at):
                text = b"".join(map(raw.__getitem__, np.frombuffer(ids.as_py() or b"", "<i4").tolist())).decode("utf-8", "replace")
                texts.append(text.removeprefix(" "))
            yield _carry(batch, "decoded", pa.array(texts, pa.string()))

    return run


def _columns(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def encode(docs: DataFrame, path: str, text_col: str = "text", kind: str = "bpe", known_words: int = 250_000, group_chars: int = 1 << 20) -> DataFrame:
    """docs with a column ids (little-endian 32-bit piece ids as binary). A trie is made of the words of about
    group_chars characters of texts; the ids of known_words words are kept for the next."""
    docs = docs.drop("ids") if text_col != "ids" else docs
    return docs.mapInArrow(_encoder(path, kind, docs.columns.index(text_col), known_words, group_chars), _columns(docs) + ", ids binary")


def decode(encoded: DataFrame, path: str, kind: str = "bpe") -> DataFrame:
    """encoded(ids, ...) with a column decoded."""
    encoded = encoded.drop("decoded")
    return encoded.mapInArrow(_decoder(path, kind, encoded.columns.index("ids")), _columns(encoded) + ", decoded string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", known_words: int = 250_000, group_chars: int = 1 << 20) -> DataFrame:
    """doc_id, n_pieces, ids_crc32, decoded_sha256, exact (decoding gave the text) for each row of docs. Encodes and
    decodes in one task, and only these digests leave it."""
    encoding, decoding = _encoder(path, "bpe", 1, known_words, group_chars), _decoder(path, "bpe", 2)

    def run(batches):
        for batch in decoding(encoding(batches)):
            rows = [(len(i) // 4, zlib.crc32(i), hashlib.sha256(d.encode()).hexdigest(), d == (t or "")) for t, i, d in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)))]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.record_batch([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.bool_())))], names=["doc_id", "n_pieces", "ids_crc32", "decoded_sha256", "exact"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_pieces long, ids_crc32 long, decoded_sha256 string, exact boolean")
