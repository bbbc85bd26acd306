"""BPE encoding and decoding through a distinct-word table.

Texts are split into words in Spark tasks; a task numbers the distinct words of each *chunk* of documents (a bounded number of
distinct words) and keeps a text as its sequence of those numbers, in one file a chunk in the shared folder. The chunks' word lists form
one table (word, chunk, number), dealt and sorted by word (its hash, so that rows without words spread): there the tokenizers library encodes each distinct word once, and the ids go
back to the chunks' numbers. A chunk then joins ids back by position, and decodes each of its words through the id-to-piece table, which is
the vocabulary and so of fixed size. A word crosses the network once for each chunk, not once for each occurrence: a word as common as
'the' makes as many rows as there are chunks, and no text is moved at all.

Null texts are empty texts: no ids, and the decoded text is empty. Rows with equal or null ``doc_id`` are kept as they are.
Strings of special tokens in a text become the special ids, as in the library. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm import _shared

#: Distinct words (and bytes of text) after which a chunk ends.
CHUNK_WORDS = 400_000
CHUNK_BYTES = 64 << 20
#: Words that are packed at once.
PACKED_ROWS = 100_000

#: The plain range: ASCII, Latin-1 and Latin Extended-A, whose lower-case letters are in it, too (but for U+0130), and whose properties are
#: the same in every version of Unicode. All other text is normalised and split by the library itself.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ſ"
_NUMBER = "0-9²³¹¼-¾"
_OTHER = re.compile("[^\t\n\r\x20-\x7e¡-ſ]|İ")
#: The vocabulary's split pattern, with the letters and numbers of the plain range written out.
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\s{_LETTER}{_NUMBER}]+")


#: The public byte-level alphabet: printing Latin-1 characters stand for their bytes, the other bytes follow from U+0100 on.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_ALPHABET = {b: chr(0x100 + i) for i, b in enumerate(sorted({*range(256)} - {*_SHOWN}))}


class Splitter:
    """The words of a text as the vocabulary's normaliser and pre-tokeniser make them; special tokens are words of their own."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = Tokenizer(self.tokenizer.model)
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def words(self, text: str) -> list[str]:
        if self.at_special is not None and "<|" in text:
            parts = self.at_special.split(text)
            if len(parts) > 1:
                return [w for p in parts if p for w in ([p] if p in self.special else self.words(p))]
        if not _OTHER.search(text):
            return _SPLIT.findall(text.lower())
        text = self.tokenizer.normalizer.normalize_str(text)
        return [text[i:j] for _, (i, j) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and how many each word has."""
        plain = [w for w in words if w not in self.special]
        spelled = "\n".join(plain).encode().decode("latin-1").translate(_ALPHABET).split(_ALPHABET[10]) if plain else []
        coded = self.model.encode(spelled, is_pretokenized=True, add_special_tokens=False)
        ids, count = np.array(coded.ids, np.uint32), np.bincount(np.array(coded.word_ids, np.int64), minlength=len(plain))
        if len(plain) < len(words):
            at = np.array([w in self.special for w in words])
            every = np.ones(len(words), np.int64)
            every[~at] = count
            out = np.empty(every.sum(), np.uint32)
            here = np.repeat(at, every)
            out[here], out[~here] = [self.special[w] for w in words if w in self.special], ids
            return out, every
        return ids, count

    def pieces(self) -> list[bytes]:
        """The id-to-piece table."""
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        out = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            out[i] = piece.encode()
        return out


_splitters: dict[str, Splitter] = {}


def splitter(path: str) -> Splitter:
    if path not in _splitters:
        _splitters[path] = Splitter(path)
    return _splitters[path]


class _Numbers(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _planes(numbers: array) -> bytes:
    """The numbers' lowest bytes, then their next bytes, ...: frequent words have small numbers, so this compresses well."""
    return np.frombuffer(numbers, np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(raw: bytes) -> list[int]:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view(np.uint32).reshape(-1).tolist()


_SEQUENCES = pa.schema([("doc_id", pa.int64()), ("seq", pa.binary())])


def split_words(docs: DataFrame, vocabulary: str, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (word, chunk, number) of every chunk's distinct words, or (null, chunk, -1) if it has none; the texts' sequences go to one file
    a chunk in ``folder``. Tasks read their rows in an order that depends on these alone, and a chunk's id is that of its partition and words,
    so a task that runs again makes the same chunks and leaves the same files; they get their names when finished."""

    def task(batches):
        split = splitter(vocabulary).words
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        place, out = f"{TaskContext.get().partitionId()}", None

        def finish():
            writer.close()
            out.close()
            words = list(numbers)
            mark = hashlib.blake2b("\n".join([place, *map(str, chunk), *words]).encode(), digest_size=8)
            name = int.from_bytes(mark.digest(), "little", signed=True)
            fs.move(own, f"{root}/{name}.arrow")
            for i in range(0, len(words), 20_000):
                part = words[i : i + 20_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([name] * len(part), pa.int64()), pa.array(range(i, i + len(part)), pa.int32())], names=["word", "chunk", "number"])
            if not words:
                yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([name], pa.int64()), pa.array([-1], pa.int32())], names=["word", "chunk", "number"])

        rows = 0
        for batch in batches:
            if not len(batch):
                continue
            if out is None:
                chunk, numbers, size = (batch.column(0)[0], rows), _Numbers(), 0
                own = f"{root}/_{uuid.uuid4().hex}"
                out = fs.open_output_stream(own)
                writer = pa.ipc.new_stream(out, _SEQUENCES, options=pa.ipc.IpcWriteOptions(compression="zstd"))
            seqs, rows = [], rows + len(batch)
            for text in batch.column(1).to_pylist():
                seqs.append(_planes(array("I", map(numbers.__getitem__, split(text)))) if text else b"")
                size += len(text or "")
            writer.write_batch(pa.RecordBatch.from_arrays([batch.column(0), pa.array(seqs, pa.binary())], schema=_SEQUENCES))
            if len(numbers) >= CHUNK_WORDS or size >= CHUNK_BYTES:
                yield from finish()
                out = None
        if out is not None:
            yield from finish()

    _shared.tune(docs.sparkSession)
    chosen = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).cast("string").alias("t"))
    return chosen.sortWithinPartitions("k", F.xxhash64("t")).mapInArrow(task, "word string, chunk long, number int")


def _gathered(batches, rows: int):
    """Tables of at least so many rows (but for the last) from small batches."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def encode_words(words: DataFrame, vocabulary: str) -> DataFrame:
    """The ids of the words, packed by chunk: rows (chunk, packed), packed being the words' numbers, their numbers of ids and the ids.

    Rows come dealt and sorted by word, so each distinct word is encoded once, whatever the number of its chunks."""
    import zlib

    def task(batches):
        encode = splitter(vocabulary).ids
        last, last_ids = None, np.zeros(0, np.uint32)
        for rows in _gathered(batches, PACKED_ROWS):
            word = rows.column("word").to_pylist()
            chunk, number = rows.column("chunk").to_numpy(), rows.column("number").to_numpy()
            new = [w for w, before in zip(word, [last, *word]) if w is not None and w != before]
            ids, count = encode(new)
            # which of the distinct words each row has: 0 is the one that the batch before ended with
            at = np.cumsum([w is not None and w != before for w, before in zip(word, [last, *word])])
            known = np.concatenate([last_ids, ids])
            count = np.concatenate([[len(last_ids)], count])
            start = np.cumsum(count) - count
            if new:
                last, last_ids = new[-1], known[start[-1] :]
            size = np.where(number < 0, 0, count[at])
            order = np.lexsort((number, chunk))
            edge = np.flatnonzero(np.diff(chunk[order], prepend=chunk[order][:1] - 1))
            out = []
            for i, j in zip(edge, [*edge[1:], len(order)]):
                own = order[i:j]
                own = own[number[own] >= 0]
                n = size[own]
                pick = np.repeat(start[at[own]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                raw = np.array([len(own)], np.uint32).tobytes() + number[own].astype(np.uint32).tobytes() + n.astype(np.uint32).tobytes() + known[pick].tobytes()
                out.append((int(chunk[order[i]]), zlib.compress(_planes(raw), 1)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.int64()), pa.array([p for _, p in out], pa.binary())], names=["chunk", "packed"])

    return words.mapInArrow(task, "chunk long, packed binary")


def encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", finish=None, result: str = "ids binary, decoded string") -> DataFrame:
    """Per document: doc_id, n_tokens, and what ``finish(ids, decoded)`` makes of its ids (bytes, little-endian uint32) and its
    decoded text (bytes, UTF-8) as columns ``result``; without ``finish``, these two themselves."""
    spark = docs.sparkSession
    _shared.tune(spark)
    folder = _shared.scratch(spark, "bpe-sequences")
    words = split_words(docs, vocabulary, folder, id_col, text_col)
    words = words.repartition(F.xxhash64("word", F.when(F.col("word").isNull(), F.col("chunk")))).sortWithinPartitions("word")
    packed = encode_words(words, vocabulary)
    names = [c.split()[0] for c in result.split(",")]
    kinds = [{"binary": pa.binary(), "string": pa.string()}[c.split()[1]] for c in result.split(",")]
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), *zip(names, kinds)])

    def join_back(packed: pa.Table) -> pa.Table:
        import zlib

        pieces = splitter(vocabulary).pieces()
        parts = []
        for raw in packed.column("packed").to_pylist():
            flat = np.ascontiguousarray(np.frombuffer(zlib.decompress(raw), np.uint8).reshape(4, -1).T).view(np.uint32).reshape(-1)
            n = int(flat[0])
            parts.append((flat[1 : 1 + n], flat[1 + n : 1 + 2 * n], flat[1 + 2 * n :]))
        total = sum(len(p[0]) for p in parts)
        if any(len(p[0]) and p[0].max() >= total for p in parts):
            raise RuntimeError("words of a chunk are missing")
        ids, spelled = [b""] * total, [b""] * total
        for number, count, flat in parts:
            ends = np.cumsum(count, dtype=np.int64).tolist()
            coded, decoded = flat.tobytes(), list(map(pieces.__getitem__, flat.tolist()))
            begin = 0
            for k, end in zip(number.tolist(), ends):
                ids[k], spelled[k] = coded[4 * begin : 4 * end], b" ".join(decoded[begin:end])
                begin = end
        fs, root = pafs.FileSystem.from_uri(folder)
        out = []
        with fs.open_input_file(f"{root}/{packed.column('chunk')[0].as_py()}.arrow") as file:
            for t in pa.ipc.open_stream(file):
                rows = []
                for key, seq in zip(t.column("doc_id").to_pylist(), t.column("seq").to_pylist()):
                    seq = _from_planes(seq) if seq else []
                    coded, decoded = b"".join(map(ids.__getitem__, seq)), b" ".join(map(spelled.__getitem__, seq))
                    rows.append((key, len(coded) // 4, *((coded, decoded.decode()) if finish is None else finish(coded, decoded))))
                if rows:
                    out.append(pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), schema.types)], schema=schema))
        return pa.Table.from_batches(out, schema=schema)

    return packed.groupBy("chunk").applyInArrow(join_back, f"doc_id long, n_tokens long, {result}")


def digests(ids: bytes, decoded: bytes) -> tuple[str, str]:
    return hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()


def token_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encode_decode(docs, vocabulary, finish=digests, result="ids_sha256 string, decoded_sha256 string")
