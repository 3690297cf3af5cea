"""Vector bin packing of token sequences.

An example has a demand vector (tokens, segments, loss-bearing tokens); a
sequence has a capacity vector. The open sequence takes, of the pieces that
fit, the one whose demand has the largest dot product with the capacity that is
left, both in shares of the full capacity. When nothing fits, a piece is cut so
that the sequence ends exactly full and its rest goes back to the pool. A
sequence that stays short when the pool is empty is cut into powers of two,
which need no padding.

Tokenising and packing run in one pass per task over a bounded pool: no
shuffle, nothing larger than ``pool`` pieces is held, and a retried task makes the
same sequences. ``sequence_id`` is the task's partition number times 2**33 plus a
number within the task.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quarry.llm.textops import slices, text_buffers

BYTES_AT_A_TIME = 1 << 21

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    T.StructField("loss_tokens", T.LongType())])


class Recent:
    """A lookup of what was used lately: two generations of at most about ``limit`` entries each."""

    def __init__(self, limit: int) -> None:
        self.limit = max(1, limit)
        self.young: dict = {}
        self.old: dict = {}

    def every(self, keys: list, make) -> list:
        """The values of ``keys``; those not known are made, and none of them is None."""
        found = list(map(self.young.get, keys))
        old = self.old.get
        for k, value in enumerate(found):
            if value is None:
                key = keys[k]
                value = self.young.get(key)
                if value is None:
                    value = old(key)
                    self.young[key] = value = make(key) if value is None else value
                found[k] = value
        if len(self.young) > self.limit:
            self.young, self.old = {}, self.young
        return found


class WordIds:
    """Token ids of text columns.

    The vocabulary's normaliser and pre-tokeniser never join across white space, so a
    batch is cut there by Arrow, and ids are computed once per distinct stretch and
    looked up after that. No ids mark a stretch with characters whose normalisation depends on their
    neighbours; a text with one goes through the tokeniser whole.
    """

    # Stretches made of these characters are unchanged by NFC, and lower-casing maps them one to one.
    UNSURE = re.compile("[^!-~\xc0-\xd6\xd8-\xf6\xf8-\u0131\u0134-\u0148\u014a-\u017e]|<\\|")
    # The vocabulary's split pattern over those characters.
    PIECE = re.compile("[a-z\xdf-\xf6\xf8-\u017e]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^a-z0-9\xdf-\xf6\xf8-\u017e]+")

    def __init__(self, path: str, limit: int) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.tokenize = self.whole.model.tokenize
        self.stretches, self.pieces = Recent(limit // 3), Recent(limit)  # a piece is in many stretches
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        self.byte_char = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def stretch(self, text: str) -> bytes:
        """Ids (little-endian 32-bit) of a text without white space; empty if they depend on what is around it."""
        if self.UNSURE.search(text):
            return b""
        found = self.PIECE.findall(text.lower())
        return self.pieces.every(found, self.piece)[0] if len(found) == 1 else b"".join(self.pieces.every(found, self.piece))

    def piece(self, piece: str) -> bytes:
        chars = piece if piece.isascii() else "".join([self.byte_char[b] for b in piece.encode()])
        return b"".join([t.id.to_bytes(4, "little") for t in self.tokenize(chars)])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's begin and the last end); null texts have none."""
        if column.null_count:
            column = pc.fill_null(column, "")
        cut = pc.ascii_split_whitespace(column.cast(pa.large_string()))
        ends = cut.offsets.to_numpy().astype(np.int64)
        coded = cut.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
        ends -= ends[0]
        known = self.stretches.every(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self.stretch)
        number = coded.indices.to_numpy().astype(np.int64)
        sizes = np.array(list(map(len, known)), np.int64) // 4
        unsure = sizes == 0
        unsure &= pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)  # the ends of a text
        flat = np.frombuffer(b"".join(known), "<u4")
        begin = np.cumsum(sizes) - sizes
        length = sizes[number] if len(number) else number
        at = np.r_[0, np.cumsum(length)]
        ids = flat[np.arange(at[-1]) + np.repeat(begin[number] - at[:-1], length)] if len(number) else flat[:0]
        bounds = at[ends]
        if unsure.any():
            rows = np.unique(np.searchsorted(ends, np.flatnonzero(unsure[number]), side="right") - 1)
            parts, last = [], 0
            sized = np.diff(bounds)
            for row in rows.tolist():
                own = np.array(self.whole.encode(column[row].as_py(), add_special_tokens=False).ids, "<u4")
                parts += [ids[bounds[last]:bounds[row]], own]
                sized[row], last = len(own), row + 1
            ids = np.concatenate([*parts, ids[bounds[last]:]])
            bounds = np.r_[0, np.cumsum(sized)]
        return ids, bounds


@lru_cache(maxsize=1)
def _word_ids(path: str, limit: int) -> WordIds:
    """Kept for the worker's later tasks."""
    return WordIds(path, limit)


class Packer:
    """Packs pieces ``(key, start, length)`` into sequences of limited size."""

    def __init__(self, capacity: int, segments: int, loss: int, pool: int) -> None:
        self.size = np.array([capacity, segments, loss], float)
        self.capacity, self.segments, self.loss, self.pool_size = capacity, segments, loss, pool
        self.pool: list[tuple] = []
        self.full: list[list[tuple]] = []

    @staticmethod
    def demand(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Tokens, segments and loss-bearing tokens: a text's first token bears none, as nothing predicts it."""
        return np.stack([lengths, np.ones_like(lengths), lengths - (starts == 0)], axis=-1).astype(float)

    def add(self, key, length: int) -> Iterator[list[tuple]]:
        start = 0
        most = min(self.capacity, self.loss)
        while length - start > most:
            yield [(key, start, most)]
            start += most
        if length > start:
            self.pool.append((key, start, length - start))
        if len(self.pool) >= self.pool_size:
            yield from self.pack(keep=True)

    def pack(self, keep: bool) -> Iterator[list[tuple]]:
        """Sequences from the pool; with ``keep`` those too short to fill one go back to it."""
        pieces, self.pool = self.pool, []
        pieces.sort(key=lambda p: (-p[2], p[1]))
        lengths = np.array([p[2] for p in pieces], np.int64)
        demand = self.demand(lengths, np.array([p[1] for p in pieces], np.int64))
        alive = np.ones(len(pieces), bool)
        share = demand / self.size
        n_alive = len(pieces)
        while n_alive:
            left = self.size.copy()
            taken: list[tuple] = []
            while n_alive and left[0] > 0 and left[1] > 0:
                fits = alive & (demand <= left).all(axis=1)
                if fits.any():
                    gain = share @ (left / self.size)
                    gain[~fits] = -1.0
                    i = int(gain.argmax())
                    taken.append(pieces[i])
                    left -= demand[i]
                    alive[i] = False
                    n_alive -= 1
                    continue
                # Cut the shortest piece that is longer than the room.
                room = int(min(left[0], left[2]))
                longer = np.flatnonzero(alive & (lengths > room))
                if room <= 0 or not len(longer):
                    break
                i = int(longer[-1])
                key, start, length = pieces[i]
                taken.append((key, start, room))
                left -= [room, 1, room - (start == 0)]
                pieces[i] = (key, start + room, length - room)
                lengths[i] = length - room
                demand[i] = self.demand(lengths[i:i + 1], np.array([start + room]))[0]
                share[i] = demand[i] / self.size
            if left[0] > 0 and not n_alive:
                if keep:
                    self.pool.extend(taken)
                else:
                    yield from powers(taken)
                return
            if left[0] > 0:  # another limit is reached
                yield from powers(taken)
            else:
                yield taken


def powers(pieces: list[tuple]) -> Iterator[list[tuple]]:
    """Cut a short sequence into sequences whose sizes are powers of two."""
    pieces = list(pieces)
    rest = sum(p[2] for p in pieces)
    while rest:
        want = 1 << (rest.bit_length() - 1)
        rest -= want
        out = []
        while want:
            key, start, length = pieces.pop()
            take = min(want, length)
            out.append((key, start, take))
            if take < length:
                pieces.append((key, start + take, length - take))
            want -= take
        yield out


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = 4096, segments: int = 256,
                   loss: int = 4096, pool: int = 512, cache: int = 200_000) -> DataFrame:
    """Pack ``docs(doc_id, text)`` into sequences; one row per piece (``SCHEMA``).

    A document is its text's ids, then ``end_id``; a null or empty text is that id
    alone. Each id lies in exactly one piece. ``ids_crc32`` is over the piece's ids as
    little-endian 32-bit integers, ``loss_tokens`` its tokens that bear loss. A
    sequence holds at most ``capacity`` tokens, ``segments`` pieces and ``loss`` loss-bearing
    tokens. Repeated rows are packed once each; an empty table gives no rows. Other columns are ignored.
    ``cache`` bounds a generation of a worker's lookups of pieces, and a third of it one of stretches (about 200 bytes an entry).
    """
    end = np.array([end_id], "<u4").tobytes()

    def encoded(words: WordIds, batch: pa.RecordBatch) -> Iterator[tuple[int | None, bytes]]:
        _, offsets = text_buffers(batch.column(1))
        for first, last in slices(offsets, BYTES_AT_A_TIME):
            flat, bounds = words.encode(batch.column(1)[first:last])
            for doc_id, a, b in zip(batch.column(0)[first:last].to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                yield doc_id, flat[a:b].tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(tokenizer_path, cache)
        packer = Packer(capacity, segments, loss, pool)
        next_id = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        open_ids: dict[int, list] = {}  # row number to [doc_id, ids, tokens not yet written]
        out: list[tuple] = []

        def write(pieces: list[tuple]) -> None:
            nonlocal next_id
            offset = 0
            for row, start, length in pieces:
                held = open_ids[row]
                crc = zlib.crc32(held[1][4 * start:4 * (start + length)])
                out.append((held[0], start, length, crc, len(held[1]) // 4, next_id, offset, length - (start == 0)))
                offset += length
                held[2] -= length
                if not held[2]:
                    del open_ids[row]
            next_id += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=SCHEMA.names)

        row = 0
        for batch in batches:
            for doc_id, ids in encoded(words, batch):
                ids += end
                open_ids[row] = [doc_id, ids, len(ids) // 4]
                for pieces in packer.add(row, len(ids) // 4):
                    write(pieces)
                row += 1
                if len(out) >= 20_000:
                    yield flush()
        for pieces in packer.pack(keep=False):
            write(pieces)
        if out:
            yield flush()

    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text").mapInArrow(run, SCHEMA)
