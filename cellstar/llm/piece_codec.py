"""SentencePiece BPE encoding by a table of last tokens.

For every prefix of a word the table stores the one token that ends the
prefix's encoding. The tokens that can end a prefix are the vocabulary's
matches ending there, longest first, which an Aho-Corasick automaton reports;
a match is the right one if the token that ends the rest of the prefix may
stand before it, i.e. if merging the two tokens' texts from scratch keeps them
apart (``compatible``, decided once a pair). Reading the table backwards from
the word's end gives the ids. A character that no token covers becomes its
UTF-8 bytes' tokens and cuts the word.

Vocabulary pieces have the space mark only at their beginning, or consist of
it, so merges never cross from a letter to a following mark: the words of a
text are encoded independently, and a worker remembers the words it has met.
A null or empty text is the end id alone, and decodes to the empty text.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from cellstar.llm.common import documents, lean

MARK = "▁"


class PieceCodec:
    #: Bytes of words remembered before they become the former ones (words, ids, and
    #: what a table entry takes), and the longest word that is.
    REMEMBER, ENTRY, LONGEST = 100_000_000, 150, 64
    _WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

    def __init__(self, model: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.end = sp.eos_id()
        self.unknown = sp.unk_id()
        self.piece = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(len(self.piece))]
        self.byte_id = {int(self.piece[i][1:-1], 16): i for i in range(len(self.piece)) if sp.is_byte(i)}
        self.id_of = {p: i for i, p in enumerate(self.piece) if not special[i] and not sp.is_byte(i)}
        self.score = {p: sp.get_score(i) for p, i in self.id_of.items()}
        self.is_byte = {i: b for b, i in self.byte_id.items()}
        self.piece_bytes = [bytes([self.is_byte[i]]) if i in self.is_byte else b"" if special[i] else p.encode()
                            for i, p in enumerate(self.piece)]
        self.id_text = list(map(str, range(len(self.piece))))
        self.chars = {p for p in self.id_of if len(p) == 1}
        self.find = ahocorasick.Automaton()  # a match: piece, length, {token before it ("" at the start): may it stand}
        for p in self.id_of:
            self.find.add_word(p, (p, len(p), {}))
        self.find.make_automaton()
        if any(MARK in p.lstrip(MARK) for p in self.id_of) or not self.byte_id:
            raise ValueError("pieces with an inner space mark, or no byte pieces")
        self.whole = {}      # piece -> it is what merging its own text gives
        self.words: dict[str, bytes] = {}   # word -> ids as little-endian 32-bit integers
        self.former: dict[str, bytes] = {}  # the words remembered before these
        self.held = 0                       # bytes of ``words``

    def merge(self, text: str) -> list[str]:
        """Merge from single characters, best score first, leftmost on ties.
        Only short texts (a token, or two) come here."""
        parts = list(text)
        after = list(range(1, len(parts))) + [-1]
        before = list(range(-1, len(parts) - 1))
        heap = []

        def offer(i):
            j = after[i]
            if j >= 0 and (s := self.score.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (-s, i, parts[i], parts[j]))

        for i in range(len(parts)):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else -1
            if j < 0 or parts[i] != a or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p is not None]

    def halves(self, piece: str) -> tuple[str, str] | None:
        """The two tokens whose merge makes the piece; None for one character
        or a piece that merging its text does not give."""
        if piece not in self.whole:
            self.whole[piece] = self._halves(piece)
        return self.whole[piece]

    def _halves(self, piece: str) -> tuple[str, str] | None:
        if len(piece) == 1 or self.merge(piece) != [piece]:
            return None
        # the last merge joins the pair that stands when the piece itself may not be made
        own = self.score.pop(piece)
        left, right = self.merge(piece)
        self.score[piece] = own
        return left, right

    def stands(self, piece: str) -> bool:
        """Whether merging the piece's own text gives the piece."""
        return len(piece) == 1 or self.halves(piece) is not None

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging left + right from scratch gives these two tokens;
        with an empty left, whether right's text merges into right."""
        if not left or not self.stands(right):
            return self.stands(right)
        if left[0] == MARK and (left[-1] == MARK or right[0] == MARK):  # mark runs tie in score
            return self.merge(left + right) == [left, right]
        return self._apart(left, right)

    def _apart(self, left: str, right: str) -> bool:
        """Undo merges on both sides of the seam, the latest first; the tokens
        stay apart if no merge across the seam was due before the undone one.

        Of equal scores the leftmost merge is due first: the left side's own,
        then the one across, then the right side's.
        """
        score, before, tie = self.score, -float("inf"), False
        while True:
            over = score.get(left + right)
            if over is not None and (over > before or (tie and over == before)):
                return False
            a = self.halves(left) if len(left) > 1 else None
            b = self.halves(right) if len(right) > 1 else None
            if a is None and b is None:
                return True
            if b is None or (a is not None and score[left] < score[right]):
                before, tie, left = score[left], False, a[1]
            else:
                before, tie, right = score[right], True, b[0]

    def run(self, text: str) -> list[int]:
        """Ids of a text that tokens cover wholly."""
        last: list[str | None] = [None] * (len(text) + 1)
        last[0] = ""
        for end, (piece, length, fits) in self.find.iter(text):  # longest first
            end += 1
            if last[end] is not None:
                continue
            left = last[end - length]
            if left is None:
                continue
            fit = fits.get(left)
            if fit is None:
                if len(fits) > 20_000:
                    fits.clear()
                fit = fits[left] = self.compatible(left, piece)
            if fit:
                last[end] = piece
        ids, at = [], len(text)
        while at:
            piece = last[at]
            ids.append(self.id_of[piece])
            at -= len(piece)
        return ids[::-1]

    def encode_word(self, word: str) -> list[int]:
        if self.chars.issuperset(word):
            return self.run(word)
        ids, run = [], ""
        for c in word:
            if c in self.chars:
                run += c
                continue
            if run:
                ids += self.run(run)
                run = ""
            ids += [self.byte_id[b] for b in c.encode("utf-8", "surrogatepass")]
        return ids + (self.run(run) if run else [])

    def new_word(self, word: str) -> bytes:
        found = self.former.get(word)
        if found is None:
            ids = self.encode_word(word)
            found = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= self.LONGEST:
            size = self.ENTRY + 4 * len(word) + len(found)
            self.held += size
            if self.held > self.REMEMBER:
                self.words, self.former, self.held = {}, self.words, size
            self.words[word] = found
        return found

    def split(self, text: str) -> list[str]:
        return self._WORD.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, text: str) -> list[int]:
        """All ids of a text, without the end id."""
        words = self.split(text)
        found = list(map(self.words.get, words))
        if None in found:
            found = [self.words.get(w) or self.new_word(w) if f is None else f for w, f in zip(words, found)]
        raw = b"".join(found)
        return list(struct.unpack(f"<{len(raw) // 4}I", raw))

    def decode(self, ids: list[int]) -> str:
        """Text of ids: marks become spaces, the first one goes, byte tokens
        are decoded together; control ids have no text."""
        raw = b"".join(map(self.piece_bytes.__getitem__, ids))
        text = raw.decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text[:1] == " " else text

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids with the end id, hash of the ids' text, hash of the decoded text."""
        ids = self.encode(text) + [self.end]
        return (len(ids), hashlib.sha256(" ".join(map(self.id_text.__getitem__, ids)).encode()).hexdigest(),
                hashlib.sha256(self.decode(ids).encode()).hexdigest())


_CODECS: dict[str, PieceCodec] = {}


def codec(model: str) -> PieceCodec:
    """One codec a worker process, kept between tasks."""
    if model not in _CODECS:
        _CODECS[model] = PieceCodec(model)
    return _CODECS[model]


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """doc_id and all ids (with the end id) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = codec(model)
            ids = [c.encode(t) + [c.end] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))],
                                             ["doc_id", "ids"])

    return documents(docs).mapInArrow(lean(run), "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """Digests of every document's ids and of the text decoded from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*map(codec(model).digest, batch.column("text").to_pylist()))) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(list(rows[0]), pa.int64()), pa.array(list(rows[1]), pa.string()),
                 pa.array(list(rows[2]), pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return documents(docs).mapInArrow(
        lean(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
