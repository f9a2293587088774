"""SentencePiece encoding and decoding over a trie of marked words, with shared prefixes.

The distinct words of a batch, marked by a leading "▁", are sorted, which walks their trie depth-first: a word keeps
the forward states of the prefix that it shares with the word before it, and only its new characters are computed.

For a unigram model this is Viterbi's recurrence: the state of a prefix is the highest sum of scores of a segmentation, and
its last piece. A piece model whose scores are merge ranks isn't segmented by their sum; the best path by sums wouldn't
give its ids. There the best segmentation is the one that merging gives. Its prefixes are segmented alike (no merge crosses
a final boundary), so a forward state is the last piece of its prefix, and a piece may follow another exactly if merging
the two alone leaves them apart: the recurrence stays, its maximum is replaced. The ids are those of the public library.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from os.path import commonprefix
from struct import pack

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingloom.llm.hashing import portions, text_bytes

MARK = "▁"
#: Words, and verdicts on pairs of pieces, that a task remembers; bytes of texts encoded together.
REMEMBER, AT_ONCE = 200_000, 1 << 20
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@dataclass
class Pieces:
    """A model's tables: id and rank of every piece, and the two parts of its last merge."""

    ids: dict[str, int]
    rank: dict[str, int]
    left: dict[str, str]
    right: dict[str, str]
    byte: list[int]
    text: list[bytes]  # of each id; bytes themselves for byte pieces
    unknown: int
    scores: dict[str, float] | None = None  # of a unigram model
    verdicts: dict = field(default_factory=dict)

    def apart(self, one: str, two: str) -> bool:
        """Whether merging one + two leaves these two pieces: undo the later of the two last merges, again and again,
        and see whether the pieces that then meet would have merged before it."""
        key = (one, two)
        known = self.verdicts.get(key)
        if known is not None:
            return known
        rank, limit = self.rank, float("inf")
        while True:
            both = rank.get(one + two)
            if both is not None and both < limit:
                out = False
                break
            r1, r2 = rank.get(one, 0), rank.get(two, 0)
            if r1 > r2:
                limit, one = r1, self.right[one]
            elif r2:
                limit, two = r2 + 1, self.left[two]
            else:
                out = True
                break
        if len(self.verdicts) > REMEMBER:
            self.verdicts.clear()
        self.verdicts[key] = out
        return out

    def forward(self, words: list[str]) -> Iterator[tuple[str, list[str]]]:
        """Of sorted, distinct words each with the last piece of the best segmentation of each of its prefixes (a unigram model)."""
        scores = self.scores
        longest, unknown = max(map(len, scores), default=1), min(scores.values(), default=0.0) - UNKNOWN
        best, last, before = [0.0], [""], ""
        for word in words:
            shared = len(commonprefix((before, word)))
            del best[shared + 1 :], last[shared + 1 :]
            for i in range(shared + 1, len(word) + 1):
                top, piece = best[i - 1] + unknown, word[i - 1 : i]  # an unknown character
                for j in range(max(0, i - longest), i):
                    if (s := scores.get(word[j:i])) is not None and best[j] + s > top:
                        top, piece = best[j] + s, word[j:i]
                best.append(top)
                last.append(piece)
            before = word
            yield word, last

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each word, as little-endian int32. words: sorted and distinct."""
        if self.scores is None:
            return {word: self.ids_of(word, last) for word, last in self.merging(words)}
        return {word: self.ids_of(word, last) for word, last in self.forward(words)}

    def ids_of(self, word: str, last: list[str]) -> bytes:
        """The pieces of a word from its end, by the last pieces of its prefixes. Unknown characters that follow one another are one id."""
        at, back = len(word), []
        while at:
            piece = last[at]
            at -= len(piece)
            one = self.ids.get(piece)
            if one is not None:
                back.append(one)
            elif self.byte:
                back += [self.byte[b] for b in reversed(piece.encode("utf-8", "surrogatepass"))]
            elif not back or back[-1] != self.unknown:
                back.append(self.unknown)
        return pack(f"<{len(back)}i", *reversed(back))

    def merging(self, words: list[str]) -> Iterator[tuple[str, list[str]]]:
        """As forward, for a model of merge ranks."""
        found, apart, longest = self.automaton(), self.apart, max(map(len, self.rank), default=1)
        last: list[str] = [""]  # last[i]: the last piece of the first i characters
        before = ""
        for word in words:
            shared = len(commonprefix((before, word)))
            del last[shared + 1 :]
            known = shared + 1  # prefixes that have a state, the empty one included
            for end, piece in found.iter(word, max(0, known - longest)):  # longest first
                if end + 1 >= known:
                    while known <= end:  # no piece ends there
                        last.append(word[known - 1])
                        known += 1
                    n = len(piece)
                    if n > end or apart(last[end + 1 - n], piece):
                        last.append(piece)
                        known += 1
            last.extend(word[known - 1 :])
            before = word
            yield word, last

    def automaton(self) -> ahocorasick.Automaton:
        """Finds the pieces that end at each character; made once in each process."""
        if "automaton_" not in self.__dict__:
            found = ahocorasick.Automaton()
            for piece in self.rank:
                found.add_word(piece, piece)
            found.make_automaton()
            self.__dict__["automaton_"] = found
        return self.__dict__["automaton_"]


def merged(text: str, rank: dict[str, int]) -> tuple[list[str], tuple[str, str] | None]:
    """Plain merging, best rank first and leftmost among equals; and the last merge."""
    parts, final = list(text), None
    while True:
        best = min(((r, i) for i in range(len(parts) - 1) if (r := rank.get(parts[i] + parts[i + 1])) is not None), default=None)
        if best is None:
            return parts, final
        i = best[1]
        final = (parts[i], parts[i + 1])
        parts[i : i + 2] = ["".join(final)]


def fields(message: bytes) -> dict[int, list]:
    """The fields of a protocol-buffer message by number: integers, or bytes of strings and messages."""
    out: dict[int, list] = {}
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = message[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(message):
        key = number()
        if key & 7 == 0:
            value: int | bytes = number()
        else:
            size = number() if key & 7 == 2 else {1: 8, 5: 4}[key & 7]
            value, at = message[at : at + size], at + size
        out.setdefault(key >> 3, []).append(value)
    return out


# Numbers of the fields of a model file and of the kinds of models.
TRAINER, NORMALIZER, KIND, CHARS_MAP, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE = 2, 3, 3, 2, 3, 4, 5
UNIGRAM, BPE = 1, 2
#: How far an unknown character scores below the worst piece.
UNKNOWN = 10.0


def load(model: str = DEFAULT_MODEL) -> Pieces:
    """Tables of a model file, read on the driver; they have the vocabulary's size. Models of merge ranks and unigram models
    are read, if they leave text as it is but for a mark before it and for each space; others raise an error."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    spec = fields(sp.serialized_model_proto())
    trainer, normal = (fields(spec[k][-1]) if k in spec else {} for k in (TRAINER, NORMALIZER))
    kind = trainer.get(KIND, [UNIGRAM])[-1]
    if kind not in (UNIGRAM, BPE):
        raise ValueError("neither a unigram model nor one of merge ranks")
    if normal.get(CHARS_MAP, [b""])[-1] or not normal.get(DUMMY_PREFIX, [1])[-1] or normal.get(REMOVE_SPACES, [1])[-1] or not normal.get(ESCAPE, [1])[-1]:
        raise ValueError("the model's normaliser changes text")
    size = sp.vocab_size()
    names = [sp.id_to_piece(i) for i in range(size)]
    plain = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)] if any(sp.is_byte(i) for i in range(size)) else []
    text = [b"" if sp.is_control(i) else bytes([int(names[i][3:5], 16)]) if sp.is_byte(i) else names[i].encode() for i in range(size)]
    ids = {names[i]: i for i in plain}
    if kind == UNIGRAM:
        return Pieces(ids, {}, {}, {}, byte, text, sp.unk_id(), {names[i]: sp.get_score(i) for i in plain})
    rank, left, right = merge_tables([names[i] for i in sorted((i for i in plain if len(names[i]) > 1), key=lambda i: -sp.get_score(i))])
    return Pieces(ids, rank, left, right, byte, text, sp.unk_id())


def merge_tables(pieces: list[str]) -> tuple[dict, dict, dict]:
    """rank, left and right of Pieces, from the pieces of two characters or more in the order of their merges."""
    rank = {piece: r for r, piece in enumerate(pieces, 1)}
    left, right = {}, {}
    for piece in list(rank):
        parts, final = merged(piece, rank)
        if len(parts) == 1 and final:
            left[piece], right[piece] = final
    return {p: r for p, r in rank.items() if p in left}, left, right  # pieces that merging never reaches are never emitted


def splitter(pieces: Pieces) -> re.Pattern:
    """Words of a marked text: a run of marks and what follows, up to the next mark. Pieces with a mark inside forbid that."""
    inside = any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces.scores or pieces.rank)
    return re.compile("(?s).+" if inside else f"{MARK}*[^{MARK}]+|{MARK}+")


def encode(documents: DataFrame, pieces: Pieces, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, text (null as empty) and ids (array<int>) of every row; an empty text has no ids.

    A text is marked as the library marks it: one mark before it, and for each space. So a mark in a text reads
    back as a space; every other text is restored by decode. Repeated rows each get a row; an empty table gives none.
    """
    split = splitter(pieces)

    def batch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, bytes] = {}
        for b in it:
            for at, end in portions(text_bytes(b.column(b.num_columns - 1))[1], AT_ONCE):
                part = b.slice(at, end - at)
                texts = part.column(part.num_columns - 1).to_pylist()
                words = [split.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
                if len(cache) > REMEMBER:
                    cache.clear()
                new = {w for ws in words for w in ws if w not in cache}
                cache |= pieces.encode_words(sorted(new))
                raw = [b"".join(map(cache.__getitem__, ws)) for ws in words]
                offsets = np.r_[0, np.cumsum([len(r) // 4 for r in raw])].astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(raw), "<i4")))
                yield pa.RecordBatch.from_arrays([*part.columns, ids], [*keep, text, "ids"])

    rows = documents.select(*keep, F.coalesce(text, F.lit("")).alias(text))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(batch, f"{kinds}, ids array<int>")


def decode(pieces: Pieces, ids: str = "ids") -> F.Column:
    """The text of an ids column: bytes joined, marks as spaces, the first mark dropped. Null ids are a null text, no ids an
    empty one; each row is read on its own, so repeated rows give equal texts and an empty table none."""
    text = pieces.text

    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            yield pd.Series([None if r is None else b"".join(map(text.__getitem__, r.tolist())).decode("utf-8", "replace").replace(MARK, " ")[1:] for r in rows])

    return F.pandas_udf(texts, "string")(F.col(ids))
