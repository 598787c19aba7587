"""Packing token sequences: vector bin packing by the dot-product heuristic."""

from __future__ import annotations

import string
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topictables.llm.common import alone, empty_caches, table

#: Limits of a sequence: tokens, segments (pieces of documents) and tokens that bear loss.
TOKENS, SEGMENTS, LOSS = 4096, 256, 4096
#: So many open pieces are looked at for the next place.
WINDOW = 512
END = 2
TOKENIZER = "word_bpe_49k.json"


@dataclass
class Piece:
    """A stretch of a document that is still to be placed. loss holds, for each token, how many of the
    document's tokens before it bear loss, and the total at the end; None: every token bears loss."""

    document: int
    ids: np.ndarray
    start: int
    length: int
    loss: np.ndarray | None

    def loss_tokens(self, length: int | None = None) -> int:
        n = self.length if length is None else length
        return n if self.loss is None else int(self.loss[self.start + n] - self.loss[self.start])

    def longest(self, room: int, loss_room: int) -> int:
        """Most tokens from its start on that keep to both limits."""
        n = min(self.length, room)
        if self.loss is None:
            return min(n, loss_room)
        return min(n, int(np.searchsorted(self.loss[self.start :], self.loss[self.start] + loss_room, "right")) - 1)


class Packer:
    """Fills one sequence after another from a window of open pieces.

    The next piece is the one that fits all three limits and has the largest dot product of its needs
    with what is left, both as shares of the limits: large pieces go first, and a scarce resource is
    kept for those that need it. With `cut`, the room that no piece fits is filled by the head of the
    one that can give most, its tail stays open; a sequence that ends short of tokens, by the limit of
    segments or at the end of the input, is trimmed to a power of two, at which it needs no padding.
    Without `cut` pieces stay whole, and a document beyond a limit is refused.
    """

    def __init__(self, tokens: int = TOKENS, segments: int = SEGMENTS, loss: int = LOSS, window: int = WINDOW, cut: bool = True):
        if min(tokens, segments, loss) < 1:
            raise ValueError("limits must be positive")
        self.limits = np.array([tokens, segments, loss], float)
        self.cut, self.window = cut, window
        self.open: list[Piece] = []
        self.needs = np.zeros((0, 3))

    def _append(self, pieces: list[Piece]) -> None:
        self.open += pieces
        self.needs = np.vstack([self.needs, *([[p.length, 1, p.loss_tokens()]] for p in pieces)])

    def _take(self, i: int) -> Piece:
        self.needs = np.delete(self.needs, i, 0)
        return self.open.pop(i)

    def add(self, document: int, ids: np.ndarray, loss: np.ndarray | None = None) -> Iterator[list[Piece]]:
        """A document more; yields sequences that are full."""
        bound = int(self.limits[0])
        at = 0
        if self.cut:
            while len(ids) - at >= bound and loss is None and self.limits[2] >= bound:
                yield [Piece(document, ids, at, bound, loss)]
                at += bound
        elif len(ids) > bound or (len(ids) if loss is None else loss[-1]) > self.limits[2]:
            raise ValueError("a document exceeds the limits of a sequence and may not be cut")
        if at < len(ids):
            self._append([Piece(document, ids, at, len(ids) - at, loss)])
        while len(self.open) > self.window:
            yield self._sequence(False)

    def finish(self) -> Iterator[list[Piece]]:
        while self.open:
            yield self._sequence(True)

    def _sequence(self, last: bool) -> list[Piece]:
        left, placed = self.limits.copy(), []
        while len(self.open) and left.min() >= 0 and left[0] > 0 and left[1] > 0:
            fits = (self.needs <= left).all(1)
            if fits.any():
                worth = self.needs @ (left / self.limits**2)
                piece = self._take(int(np.argmax(np.where(fits, worth, -1))))
            elif self.cut:
                sizes = self._most(int(left[0]), int(left[2]))
                i = int(np.argmax(sizes))
                if sizes[i] < 1:
                    break
                piece = self._head(i, sizes[i])
            else:
                break
            placed.append(piece)
            left -= [piece.length, 1, piece.loss_tokens()]
        used = sum(p.length for p in placed)
        if self.cut and placed and used < self.limits[0] and (last or left[1] < 1 or left[2] < 1):
            self._trim(placed, used - (1 << (used.bit_length() - 1)))
        return placed

    def _most(self, room: int, loss_room: int) -> list[int]:
        """Of each open piece, the most tokens from its start on that keep to both limits."""
        if any(p.loss is not None for p in self.open):
            return [p.longest(room, loss_room) for p in self.open]
        return np.minimum(self.needs[:, 0], min(room, loss_room)).astype(int).tolist()

    def _head(self, i: int, length: int) -> Piece:
        piece = self._take(i)
        self._append([Piece(piece.document, piece.ids, piece.start + length, piece.length - length, piece.loss)])
        return Piece(piece.document, piece.ids, piece.start, length, piece.loss)

    def _trim(self, placed: list[Piece], surplus: int) -> None:
        """Gives so many tokens at the end of a sequence back to the window."""
        while surplus:
            piece = placed.pop()
            n = min(surplus, piece.length)
            surplus -= n
            self._append([Piece(piece.document, piece.ids, piece.start + piece.length - n, n, piece.loss)])
            if n < piece.length:
                placed.append(Piece(piece.document, piece.ids, piece.start, piece.length - n, piece.loss))


class WordIds(dict):
    """ASCII-white-space separated word -> its token ids as bytes, kept for a task.

    The tokenizer drops white space and never joins across it, so the ids of a text are those of its
    words one after another; it lower-cases, and parts letters from the punctuation around them. So
    words of plain letters, with or without punctuation, share the ids of their lower-case letters,
    for which its normalizing and splitting change nothing: they go straight to its model.
    """

    LIMIT = 600_000
    #: Punctuation around letters. An apostrophe before letters may belong to them, and a bar to a special token.
    MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{}~"
    #: The bytes of the letters A to Z and of Latin-1, and how they become lower-case letters.
    LETTERS = string.ascii_letters.encode() + bytes([0xC3, *(b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7))])
    LOWER = bytes(b + 32 if 65 <= b <= 90 or 0x80 <= b <= 0x9E else b for b in range(256))

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # The characters that the model has for the bytes of lower-case letters, where they differ from Latin-1.
        byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        letters = {bytes([0xC3, self.LOWER[b]]).decode() for b in self.LETTERS if 0x80 <= b < 0xC0}
        spelled = {c.encode().decode("latin-1")[1]: byte_level.pre_tokenize_str(c)[0][0][1] for c in letters}
        self.spelling = {a: b for a, b in spelled.items() if a != b}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _letters(self, lower: bytes) -> bytes:
        text = lower.decode("latin-1")
        if not text.isascii():
            for byte, character in self.spelling.items():
                text = text.replace(byte, character)
        return array("I", [t.id for t in self.model.tokenize(text)]).tobytes()

    def _marks(self, marks: bytes) -> bytes:
        if marks not in self:
            self[marks] = self._whole(marks.decode())
        return self[marks]

    def learn(self, words: Iterable[bytes]) -> None:
        new = [w for w in words if w not in self]
        if len(self) + len(new) > self.LIMIT:
            self.clear()
            new = list(words)
        for word in new:
            letters = word.strip(self.MARKS)
            at = word.find(letters)
            if not letters or letters.translate(None, self.LETTERS) or b"'" in word[:at]:
                self[word] = self._whole(word.decode())
                continue
            lower = letters.translate(self.LOWER)
            ids = self.get(lower)
            if ids is None:
                ids = self[lower] = self._letters(lower)
            if len(letters) < len(word):
                ids = self._marks(word[:at]) + ids + self._marks(word[at + len(letters) :])
            self[word] = ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of whole texts, each as little-endian unsigned 32-bit numbers."""
        alone(self)
        split = [(t or "").encode().split() for t in texts]
        self.learn(set().union(*split))
        return [b"".join(map(self.__getitem__, words)) for words in split]


_WORD_IDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _WORD_IDS:
        _WORD_IDS[path] = WordIds(path)
    return _WORD_IDS[path]


def encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[object, bytes]]:
    """(id, token ids) of batches of ids and texts; the words are forgotten at the end."""
    words = word_ids(path)
    try:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield from zip(part.column(0).to_pylist(), words.encode(part.column(1).to_pylist()), strict=True)
    finally:
        empty_caches()


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, segments int, loss_tokens long"


def pack_texts(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str | None = None, limits: tuple[int, int, int] = (TOKENS, SEGMENTS, LOSS), cut: bool = True) -> DataFrame:
    """One row per piece: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset, segments of the
    sequence, its loss tokens).

    A document is the ids of its text and END; a null text is empty, an empty one the END alone. All
    tokens bear loss. Each task packs what it reads, with a bounded window, so nothing is shuffled; a
    sequence's number holds the number of its task. What a task has left over at its end becomes
    sequences of a power of two tokens. Repeated and null ids are packed row by row.
    """
    path = path or tokenizer_path()
    source = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, np.ndarray, None]]:
        for key, ids in encoded(batches, path):
            yield key, np.frombuffer(ids + END.to_bytes(4, "little"), "<u4"), None

    return _packed(source, documents, limits, cut)


def pack_examples(df: DataFrame, id_column: str, ids_column: str, loss_column: str | None = None, limits: tuple[int, int, int] = (TOKENS, SEGMENTS, LOSS), cut: bool = False) -> DataFrame:
    """The same for instruction data that has its token ids (array of int) and, as an array of booleans
    of the same length, which of them bear loss. Examples stay whole unless `cut`. Null arrays are empty
    examples, which take no place and give no row; a null mask bears loss everywhere."""
    mask = F.col(loss_column) if loss_column else F.lit(None).cast("array<boolean>")
    source = df.select(F.col(id_column).alias("id"), F.col(ids_column).cast("array<long>").alias("ids"), mask.alias("loss"))

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, np.ndarray, np.ndarray | None]]:
        for batch in batches:
            for key, ids, loss in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if loss is not None and len(loss) != len(ids or ()):
                    raise ValueError("a loss mask must have one entry per token")
                bears = None if loss is None else np.r_[0, np.cumsum([bool(x) for x in loss])].astype(np.int64)
                yield key, np.array(ids or [], "<u4"), bears

    return _packed(source, examples, limits, cut)


def _packed(source: DataFrame, read, limits: tuple[int, int, int], cut: bool) -> DataFrame:
    kind = source.schema["id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, first = Packer(*limits, cut=cut), None
        number, keys, rows = TaskContext.get().partitionId() << 33, {}, []

        def note(sequence: list[Piece]) -> None:
            nonlocal number
            offset, loss = 0, sum(p.loss_tokens() for p in sequence)
            for p in sequence:
                crc = zlib.crc32(p.ids[p.start : p.start + p.length])
                rows.append((keys[p.document], p.start, p.length, crc, len(p.ids), number, offset, len(sequence), loss))
                offset += p.length
            number += 1

        def batch() -> pa.RecordBatch:
            columns = [pa.array([r[0] for r in rows], first), *(pa.array([r[k] for r in rows], pa.int32() if k == 7 else pa.int64()) for k in range(1, 9))]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, ["id", *(c.split()[0] for c in PIECES.split(", "))])

        def typed(batches):
            nonlocal first
            for b in batches:
                first = b.column(0).type
                yield b

        for document, (key, ids, loss) in enumerate(read(typed(batches))):
            keys[document] = key
            for sequence in packer.add(document, ids, loss):
                note(sequence)
            if len(rows) >= 10_000:
                still = {p.document for p in packer.open}
                yield batch()
                keys = {d: k for d, k in keys.items() if d in still}
        for sequence in packer.finish():
            note(sequence)
        if rows:
            yield batch()

    return source.mapInArrow(pack, f"id {kind}, {PIECES}")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents; null and empty texts, null ids and repeats as in `pack_texts`."""
    return pack_texts(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
