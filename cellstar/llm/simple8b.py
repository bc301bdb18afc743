"""Token ids in a Simple-8b file format.

A 64-bit word holds a 4-bit selector and 60 bits of data: the selector says
how many ids of which width the word packs. Ids are packed greedily in blocks
of ``BLOCK`` ids that start on a word of their own, and the offset of every
block's first word is kept, so blocks decode independently and without a loop
over ids. Selector 0 is a run of 240 zeros; selector 15 is an escape: the next
word holds one id that needs more than 60 bits.

A file is a sequence of chunks, each a blob of its own: a header (magic, number
of documents, ids, blocks and words), the token count of every document, block
offsets, words. ``write_ids`` sorts the documents by id over range
partitions, every partition being a shard of chunks, and writes them through
Spark to the shared folder; ``read_ids`` decodes chunks back. A null doc_id
sorts first; an empty or null text is the end id alone; rows that share an id
are ordered by text.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellstar.llm.common import bytes_of, documents, lean, partitions, stage, text_chunks

MAGIC = b"S8B1"
BLOCK = 1024
#: (ids a word, bits an id) by selector; 0: a run of zeros, 15: escape.
SELECTORS = ((240, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12),
             (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE = 15
#: Ids after which a chunk is closed.
CHUNK_IDS = 1 << 18
#: Bytes of texts whose distinct units are looked up together (a longer text is by itself).
TEXTS_BYTES = 1 << 24

_COUNT = np.array([c for c, _ in SELECTORS] + [1], np.int64)
#: Width class by the bits of an id: the first selector (widths ascend) that holds it.
_CLASS = np.array([sum(w < bits for _, w in SELECTORS) for bits in range(66)], np.int8)
#: The same by the id itself, for small ids.
_SMALL = _CLASS[np.frexp(np.arange(1 << 16, dtype=np.float64))[1]]


def choose(ids: np.ndarray) -> np.ndarray:
    """Best selector for a word that starts at each id; blocks end the choice.

    ``most`` is the largest width class within the next ``count`` ids, widened
    from one selector's count to the next by overlapping maxima.
    """
    n = len(ids)
    need = np.full(-(-n // BLOCK) * BLOCK, 127, np.int8)
    if n and ids.max() < len(_SMALL):
        need[:n] = _SMALL[ids]
    else:
        need[:n] = _CLASS[np.frexp(ids.astype(np.float64))[1]]  # beyond the last: escape
    most = need = need.reshape(-1, BLOCK)
    best = np.full(need.shape, ESCAPE, np.int8)
    have = 1
    for s in range(len(SELECTORS) - 1, -1, -1):  # a lower selector packs more ids
        count = SELECTORS[s][0]
        while have < count:
            step = min(have, count - have)
            wider = np.empty_like(most)
            np.maximum(most[:, :-step], most[:, step:], out=wider[:, :-step])
            wider[:, -step:] = 127
            most, have = wider, have + step
        fits = most <= s
        if not fits.any():  # nor does any that packs more ids
            break
        np.copyto(best, np.int8(s), where=fits)
    return best.reshape(-1)[:n]


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(block offsets, words) of ids given as uint64."""
    ids = np.asarray(ids, np.uint64)
    n = len(ids)
    if n == 0:
        return np.zeros(0, np.uint32), np.zeros(0, np.uint64)
    best = choose(ids)
    step = _COUNT[best]
    at = np.arange(0, n, BLOCK)  # all blocks advance side by side, a word each
    ends = np.minimum(at + BLOCK, n)
    starts = []
    while len(at):
        starts.append(at)
        at = at + step[at]
        go = at < ends
        at, ends = at[go], ends[go]
    start = np.sort(np.concatenate(starts))
    sel = best[start]
    size = 1 + (sel == ESCAPE)
    place = np.concatenate(([0], np.cumsum(size)))
    words = np.zeros(place[-1], np.uint64)
    words[place[:-1]] = sel.astype(np.uint64) << np.uint64(60)
    for s, (count, width) in enumerate(SELECTORS):
        of = np.flatnonzero(sel == s)
        if s == 0 or not len(of):
            continue
        packed = np.zeros(len(of), np.uint64)
        for j in range(count):
            packed |= ids[start[of] + j] << np.uint64(j * width)
        words[place[of]] |= packed
    raw = np.flatnonzero(sel == ESCAPE)
    words[place[raw] + 1] = ids[start[raw]]
    offsets = place[np.searchsorted(start, np.arange(0, n, BLOCK))]
    return offsets.astype(np.uint32), words


def decode(words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids that ``words`` hold (whole blocks)."""
    sel = (words >> np.uint64(60)).astype(np.int64)
    # a word after an escape is raw, whatever its high bits say
    lead = np.ones(len(words), bool)
    for i in np.flatnonzero(sel == ESCAPE).tolist():
        if lead[i] and i + 1 < len(words):
            lead[i + 1] = False
    at = np.flatnonzero(lead)
    sel = sel[at]
    count = _COUNT[sel]
    place = np.concatenate(([0], np.cumsum(count)))
    out = np.zeros(place[-1], np.uint64)
    for s, (c, width) in enumerate(SELECTORS):
        of = np.flatnonzero(sel == s)
        if s == 0 or not len(of):
            continue
        mask = np.uint64((1 << width) - 1)
        data, to = words[at[of]], place[of]
        for j in range(c):
            out[to + j] = (data >> np.uint64(j * width)) & mask
    raw = np.flatnonzero(sel == ESCAPE)
    out[place[raw]] = words[at[raw] + 1]
    return out[:n]


def pack_chunk(counts: list[int], ids: np.ndarray) -> bytes:
    offsets, words = encode(ids)
    head = struct.pack("<4sIQII", MAGIC, len(counts), len(ids), len(offsets), len(words))
    return b"".join((head, np.asarray(counts, "<u8").tobytes(), offsets.astype("<u4").tobytes(),
                     words.astype("<u8").tobytes()))


def unpack_chunk(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(token counts of the documents, all ids) of a chunk."""
    magic, docs, n, blocks, size = struct.unpack_from("<4sIQII", blob)
    if magic != MAGIC:
        raise ValueError("not a chunk of token ids")
    at = struct.calcsize("<4sIQII")
    counts = np.frombuffer(blob, "<u8", docs, at).astype(np.int64)
    words = np.frombuffer(blob, "<u8", size, at + 8 * docs + 4 * blocks)
    return counts, decode(words, n)


def read_block(blob: bytes, block: int) -> np.ndarray:
    """One block's ids, found by its offset."""
    _, docs, n, blocks, size = struct.unpack_from("<4sIQII", blob)
    at = struct.calcsize("<4sIQII") + 8 * docs
    offsets = [*np.frombuffer(blob, "<u4", blocks, at).tolist(), size]
    words = np.frombuffer(blob, "<u8", size, at + 4 * blocks)[offsets[block]:offsets[block + 1]]
    return decode(words, min(BLOCK, n - block * BLOCK))


class _Remembered(dict):
    """Looks a missing key up by ``find``. When full, what is remembered steps
    back a generation; that is by bytes. Long keys are not kept, nor keys with
    line ends, as they hold the end of one line and the start of another."""

    #: Bytes that a table entry takes besides its key and value; the longest key kept.
    ENTRY, LONGEST = 150, 64

    def __init__(self, find, most: int):
        super().__init__()
        self.find, self.most, self.held, self.former = find, most, 0, {}

    def __missing__(self, key: str) -> bytes:
        value = self.former.get(key)
        if value is None:
            value = self.find(key)
        n = len(key)
        if n <= self.LONGEST and "\n" not in key:
            self.held += self.ENTRY + 4 * n + len(value)
            if self.held > self.most:
                self.former, self.held = dict(self), self.ENTRY + 4 * n + len(value)
                self.clear()
            self[key] = value
        return value


def byte_letters() -> dict[int, str]:
    """The letters that a byte-level vocabulary writes bytes with: printable
    Latin-1 bytes stand for themselves, the others follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


#: Texts that don't fall into units (RE2): white space other than space and line end, three in a row, two at the end.
ODD = (r"[\t\x0b-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
       r"|[ \n]{3}|[ \n]{2}\z")


#: Signs of which any number after letters are one piece.
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class _Letters(dict):
    """The letters a vocabulary writes a character's bytes with."""

    def __init__(self):
        super().__init__()
        self.letters = byte_letters()

    def __missing__(self, c: str) -> str:
        raw = "".join(self.letters[b] for b in c.encode("utf-8", "surrogatepass"))
        if c < "\u2000":  # of the others there are many
            self[c] = raw
        return raw


class PieceEncoder:
    """``Tokenizer.encode`` for a byte-level BPE, remembering what it has met.

    Merges never cross the pre-tokeniser's pieces, so each distinct piece is
    encoded by the library once. Of white space before a word the last space
    belongs to the word, a last line end is a piece, and so is all that stands
    before. So a text whose white space is spaces and line ends, two in a row at
    most, falls into units that each start with one of them, and these are
    remembered as well. ``encode_all`` finds the distinct units of many texts
    first and looks each up once; other texts are split by the pattern.

    Added tokens are found in the text before it is split into pieces, as the
    library does: each is one id, and what lies between them is encoded by itself.
    """

    #: Bytes of pieces, and of units, remembered by a generation.
    PIECES, UNITS = 30_000_000, 90_000_000

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, _Letters()
        self.space = self.letters[" "]
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {t.content: array("I", [i]).tobytes() for i, t in added.items()}
        # tokens that take in white space, or only count as words, are left to the library
        self.plain = not any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values())
        longest = sorted(self.added, key=len, reverse=True)
        self.parts = re.compile(f"({'|'.join(map(re.escape, longest))})").split if longest else None
        self.split = regex.compile(pattern).findall
        self.pieces = _Remembered(self._piece, self.PIECES)
        self.units = _Remembered(self._unit, self.UNITS)

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():  # of these bytes only the space has another letter
            raw = piece.replace(" ", self.space)
        else:
            raw = "".join(map(self.letters.__getitem__, piece))
        return array("I", [t.id for t in self.model.tokenize(raw)]).tobytes()

    def _unit(self, unit: str) -> bytes:
        if unit.isalpha():  # letters are one piece
            return self._piece(" " + unit)
        word = unit.rstrip(SIGNS)
        if word[:1] in ("\n", "\r"):  # after a line end, or (\r) at the start of a text
            before, word = self.pieces["\n"] if unit[0] == "\n" else b"", word[1:]
            ids = self.pieces[word] if word.isalpha() else None
        else:
            before, ids = b"", self.units[word] if word.isalpha() else None
        if ids is None:
            return self._joined(unit[1:] if unit[:1] == "\r" else unit if unit[:1] == "\n" else " " + unit)
        signs = unit[len(unit.rstrip(SIGNS)):]
        return before + ids + (self.pieces[signs] if signs else b"")

    def _joined(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian 32-bit integers."""
        if any(t in text for t in self.added):
            if not self.plain:
                return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
            return b"".join(self.added.get(part) or self._joined(part) for part in self.parts(text))
        return self._joined(text)

    def encode_all(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, ids of all), with an end id after each text."""
        odd = pc.match_substring_regex(texts, ODD)
        for t in self.added:
            odd = pc.or_(odd, pc.match_substring(texts, t))
        # a carriage return, which no text left here has, marks where a text starts
        units = pc.split_pattern(pc.replace_substring(
            pc.binary_join_element_wise("\r", pc.if_else(odd, "", texts), ""), "\n", " \n"), " ")
        named = units.flatten().dictionary_encode()
        values = list(map(self.units.__getitem__, named.dictionary.to_numpy(zero_copy_only=False)))
        at, ends = named.indices.to_numpy().copy(), units.offsets.to_numpy()
        of = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        at[ends[of]] = len(values) + np.arange(len(of))
        values += map(self.encode, texts.take(pa.array(of)).to_pylist())
        values.append(struct.pack("<I", end_id))
        at = np.insert(at, ends[1:], len(values) - 1)
        raw, place = bytes_of(pa.array(values, pa.binary()).take(pa.array(at)))
        return np.diff(place[ends + np.arange(len(ends))]) // 4, raw.view("<u4")


_ENCODERS: dict[tuple[str, str], PieceEncoder] = {}


def encoder(path: str, pattern: str) -> PieceEncoder:
    """One encoder a worker process, kept between tasks."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = PieceEncoder(path, pattern)
    return _ENCODERS[path, pattern]


def groups(batches: Iterator[pa.RecordBatch], limit: int = TEXTS_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``limit`` bytes of text."""
    held, size = [], 0
    for batch in batches:
        for a, b in text_chunks(batch, limit=limit):
            part = batch.slice(a, b - a)
            if held and size + part.nbytes > limit:
                yield pa.concat_batches(held)
                held, size = [], 0
            held.append(part)
            size += part.nbytes
    if held:
        yield pa.concat_batches(held)


def write_ids(docs: DataFrame, tokenizer: str, pattern: str, end_id: int) -> DataFrame:
    """Encode all documents and write the files; the table of chunks
    (shard, chunk, start_in_shard, n_ids, doc_ids, data)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, chunk, start = TaskContext.get().partitionId(), 0, 0
        own, counts, parts, held = [], [], [], 0

        def close():
            nonlocal chunk, start, own, counts, parts, held
            ids = np.concatenate(parts).astype(np.uint64)
            row = pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([chunk], pa.int32()), pa.array([start], pa.int64()),
                 pa.array([held], pa.int64()), pa.array([own], pa.list_(pa.int64())),
                 pa.array([pack_chunk(counts, ids)], pa.binary())],
                ["shard", "chunk", "start_in_shard", "n_ids", "doc_ids", "data"])
            chunk, start, own, counts, parts, held = chunk + 1, start + held, [], [], [], 0
            return row

        for some in groups(batches):
            sizes, ids = encoder(tokenizer, pattern).encode_all(some.column("text"), end_id)
            for doc_id, part in zip(some.column("doc_id").to_pylist(), np.split(ids, np.cumsum(sizes)[:-1])):
                own.append(doc_id)
                parts.append(part)
                counts.append(len(part))
                held += len(part)
                if held >= CHUNK_IDS:
                    yield close()
        if own:
            yield close()

    data = documents(docs)
    by_id = F.col("doc_id").asc_nulls_first()
    return stage(data.repartitionByRange(partitions(docs.sparkSession), by_id)
                 .sortWithinPartitions(by_id, "text").mapInArrow(
        lean(run), "shard int, chunk int, start_in_shard long, n_ids long, doc_ids array<long>, data binary"), "ids")


def read_ids(chunks: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                counts, ids = unpack_chunk(row["data"].as_py())
                ends = np.concatenate(([0], np.cumsum(counts)))
                raw = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [row["doc_ids"].values, pa.array(row["start"].as_py() + ends[:-1], pa.int64()),
                     pa.array(counts, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    # one row a shard: the ids of the shards before it
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n")) \
        .select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return (chunks.join(F.broadcast(shards), "shard")
            .select("doc_ids", "data", (F.col("base") + F.col("start_in_shard")).alias("start"))
            .mapInArrow(lean(run), "doc_id long, start long, n_tokens long, ids_crc32 long"))
