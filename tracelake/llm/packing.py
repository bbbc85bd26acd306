"""Documents packed into sequences of a fixed number of tokens, by best-fit decreasing.

A task encodes the documents of its partition and packs them *shard* by shard, a shard being the documents of about ``SHARD_TOKENS``
tokens, so no text or token is shuffled and memory is bounded. A document longer than a sequence is first cut into full ones; what remains
of all documents is packed from the longest to the shortest, each into the open sequence with the least room that it fits in. A segment tree
over the rooms 0 to ``size`` finds that sequence: its leaf r counts the open sequences with room r, an inner node those below it.

Best fit leaves a few rather empty sequences at a shard's end: those that are less than ``FULL`` full are laid end to end and cut anew, which
fills all of them but one. So a shard's padding is under one sequence and 1/16 of the others at most, in practice far less.

Null texts are empty texts. Every document has its end id, so it has a piece. The rows of one document are a document each; rows with a null
``doc_id`` are kept; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm import _shared, bpe

#: Tokens after which a shard ends (with the document that reaches it).
SHARD_TOKENS = 4 << 20
#: Sequences that are emptier than this are cut anew.
FULL = 15 / 16
#: Distinct words that a worker keeps encoded; beyond it the memory is emptied and filled anew.
KEPT_WORDS = 800_000
#: Sequence ids of one task.
SEQUENCES = 1 << 40


class Rooms:
    """Open sequences by the room that they have left, as a segment tree of counts."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def _add(self, room: int, n: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += n
            node >>= 1

    def put(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._add(room, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """The room and the number of the tightest open sequence with room for ``length``, which is taken out; none if there is none."""
        count, node = self.count, length + self.leaves
        if not count[node]:
            # up to the first ancestor with something to its right, then down along the leftmost counts
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._add(room, -1)
        return room, self.open[room].pop()


def best_fit_decreasing(lengths: list[int], size: int) -> tuple[list[int], list[int], int]:
    """The sequence of each piece and its offset there, and the number of sequences. Lengths are 1 to ``size``; equal ones go in order."""
    rooms, n = Rooms(size), 0
    sequence, offset = [0] * len(lengths), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = rooms.take(lengths[i])
        if found is None:
            found, n = (size, n), n + 1
        room, sequence[i] = found
        offset[i] = size - room
        if room > lengths[i]:
            rooms.put(room - lengths[i], sequence[i])
    return sequence, offset, n


def pack(lengths: list[int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start in it, length, sequence, offset in it) of documents with so many tokens each, by document and start."""
    out, rest, n = [], [], 0
    for d, tokens in enumerate(lengths):
        full = tokens // size
        out += [(d, k * size, size, n + k, 0) for k in range(full)]
        n += full
        if tokens % size:
            rest.append((d, full * size, tokens % size))
    sequence, offset, more = best_fit_decreasing([x[2] for x in rest], size)
    fill = [0] * more
    for x, s in zip(rest, sequence):
        fill[s] += x[2]
    kept = [s for s in range(more) if fill[s] >= FULL * size]
    number = {s: n + k for k, s in enumerate(kept)}
    n += len(kept)
    at = 0  # of the sequences that are cut anew, laid end to end
    for (d, start, length), s, o in zip(rest, sequence, offset):
        if s in number:
            out.append((d, start, length, number[s], o))
            continue
        while length:
            part = min(length, size - at % size)
            out.append((d, start, part, n + at // size, at % size))
            start, length, at = start + part, length - part, at + part
    return sorted(out)


class Encoder:
    """Ids of whole texts: the vocabulary's splitter makes the words, each distinct word is encoded once."""

    def __init__(self, path: str):
        self.split = bpe.splitter(path)
        self.kept: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        words = [self.split.words(t) for t in texts]
        known = self.kept
        if len(known) > KEPT_WORDS:
            known.clear()
        new = list(set().union(*words).difference(known))
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            ids, count = self.split.ids(part)
            flat, ends = ids.astype("<u4").tobytes(), (np.cumsum(count) * 4).tolist()
            known.update(zip(part, map(flat.__getitem__, map(slice, [0, *ends], ends))))
        return [b"".join(map(known.__getitem__, w)) for w in words]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


PIECE = "doc_id long, start long, length long, {}, doc_tokens long, sequence_id long, offset long"


def _packed(docs: DataFrame, vocabulary: str, size: int, end_id: int | None, id_col: str, text_col: str, last: str, value) -> DataFrame:
    """Pieces with ``value(ids)`` as the column that ``last`` names."""
    _shared.tune(docs.sparkSession)
    kind = {"binary": pa.binary(), "long": pa.int64()}[last.split()[1]]
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), (last.split()[0], kind), *((c, pa.int64()) for c in ("doc_tokens", "sequence_id", "offset"))])

    def task(batches):
        encode = encoder(vocabulary).encode
        base = TaskContext.get().partitionId() * SEQUENCES
        tail = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        keys, tokens, held = [], [], 0

        def shard():
            nonlocal base, keys, tokens, held
            rows, used = [], 0
            for d, start, length, sequence, offset in pack([len(t) // 4 for t in tokens], size):
                rows.append((keys[d], start, length, value(tokens[d][4 * start : 4 * (start + length)]), len(tokens[d]) // 4, base + sequence, offset))
                used = max(used, sequence + 1)
            base, keys, tokens, held = base + used, [], [], 0
            for i in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[i : i + 10_000]), schema)], schema=schema)

        for batch in batches:
            if not len(batch):
                continue
            for key, ids in zip(batch.column(0).to_pylist(), encode([t or "" for t in batch.column(1).to_pylist()])):
                keys.append(key)
                tokens.append(ids + tail)
                held += len(ids) // 4 + 1
                if held >= SHARD_TOKENS:
                    yield from shard()
        if keys:
            yield from shard()

    chosen = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).cast("string").alias("t"))
    return chosen.mapInArrow(task, PIECE.format(last))


def pack_documents(docs: DataFrame, vocabulary: str, size: int = 2048, end_id: int | None = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids (binary, little-endian uint32), doc_tokens, sequence_id, offset. A training job reads
    a sequence by grouping on sequence_id; sequences of a task follow each other, so rows are in order as they are written."""
    return _packed(docs, vocabulary, size, end_id, id_col, text_col, "ids binary", bytes)


def piece_digests(docs: DataFrame, vocabulary: str, size: int = 2048, end_id: int | None = 1) -> DataFrame:
    """``pack_documents`` with the crc32 of each piece's ids in their place."""
    return _packed(docs, vocabulary, size, end_id, "doc_id", "text", "ids_crc32 long", zlib.crc32)
