"""Token-id files: frequency-ranked ids, byte-aligned variable-length codes with separate control bytes.

Texts are range-partitioned by ``doc_id`` and each partition writes its own files, so no token crosses a shuffle and no file
depends on another. A file holds the documents of one run of ids: a header, the file's rank table (token ids by falling
frequency, ties by id), the documents' ids and lengths, control bytes and data bytes. A control byte has the lengths (1-4
bytes) of four ranks; the control bytes stand apart from the data bytes, so numpy decodes both by table lookup.

Layout, little-endian: magic ``TLVB``, uint32 number of documents, uint64 number of ids, uint32 size of the rank table; rank
table uint32[]; doc ids int64[]; doc id validity uint8[]; tokens a document uint32[]; control bytes; data bytes.

Null texts are empty texts; null ``doc_id`` sorts first and is read back as null; equal ``doc_id`` sort by text. Rows of one
``doc_id``, or without any, are dealt by the beginnings of their texts, so they don't meet in one task unless these are equal too. Other
columns of the input are not read. An empty table writes no file.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracelake.llm import _shared

MAGIC = b"TLVB"
#: Ids in one file, about: a file ends with the document that reaches it.
FILE_IDS = 4 << 20
#: Distinct pieces that a worker keeps encoded; beyond it the memory is emptied and filled anew.
KEPT_PIECES = 800_000
#: Characters of a text that decide, beside its id, which task writes it.
DEALT_BY = 64

_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
#: Texts of these characters only are split here as the vocabulary's own pre-tokeniser splits them.
_PLAIN = re.compile("[^\t\n\r\x20-\x7e¡-ɏ]")
#: The public byte-level BPE split pattern, with the letters and numbers of the plain range written out.
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\s{_LETTER}{_NUMBER}]+|\s+(?!\S)|\s+")

LENGTHS = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)


#: The public byte-level alphabet: printing Latin-1 characters stand for their bytes, the other bytes follow from U+0100 on.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_ALPHABET = {b: chr(0x100 + i) for i, b in enumerate(sorted({*range(256)} - {*_SHOWN}))}


class Encoder:
    """Ids of whole texts. Each distinct piece is encoded once by the tokenizers library; a text's ids are its pieces' ids.

    Pieces are split here, so the library's model gets them as they are: a list of words without a pre-tokeniser in front."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = Tokenizer(self.tokenizer.model)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kept: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str] | None:
        """The text's pieces; none if the library has to split it."""
        if _PLAIN.search(text) or any(s in text for s in self.special):
            return None
        return _SPLIT.findall(text)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.pieces(t) for t in texts]
        known = self.kept
        if len(known) > KEPT_PIECES:
            known.clear()
        new = list(set().union(*filter(None, split)).difference(known))
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            spelled = "\0".join(part).encode().decode("latin-1").translate(_ALPHABET).split(_ALPHABET[0])
            coded = self.model.encode(spelled, is_pretokenized=True, add_special_tokens=False)
            flat = array("I", coded.ids).tobytes()
            ends = (np.cumsum(np.bincount(coded.word_ids, minlength=len(part))) * 4).tolist()
            known.update(zip(part, map(flat.__getitem__, map(slice, [0, *ends], ends))))
        odd = [t for t, s in zip(texts, split) if s is None]
        hard = iter(self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)) if odd else iter(())
        get = known.__getitem__
        return [np.array(next(hard).ids, np.uint32) if s is None else np.frombuffer(b"".join(map(get, s)), np.uint32) for s in split]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    ranks = np.asarray(ranks, np.uint32)
    size = ((ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)).astype(np.uint8)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[: len(ranks)] = size
    control = padded.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    end = np.cumsum(size + np.uint8(1), dtype=np.int64)
    data = np.zeros(int(end[-1]) if len(end) else 0, np.uint8)
    start = end - size - 1
    for k in range(4):
        has = size >= k
        data[start[has] + k] = (ranks[has] >> np.uint32(8 * k)).astype(np.uint8)
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack_ranks(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The n values behind control and data bytes; lengths come from a table of the 256 control bytes."""
    size = LENGTHS[control].reshape(-1)[:n]
    start = np.cumsum(size, dtype=np.int64) - size
    out = np.zeros(n, np.uint32)
    for k in range(4):
        has = np.flatnonzero(size > k)
        out[has] |= data[start[has] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def file_bytes(doc_ids: list[int | None], tokens: list[np.ndarray]) -> bytes:
    """One file of the format."""
    ids = np.concatenate([np.asarray(t, np.uint32) for t in tokens]) if tokens else np.zeros(0, np.uint32)
    count = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
    table = np.flatnonzero(count)
    table = table[np.argsort(-count[table], kind="stable")]
    rank = np.zeros(len(count), np.uint32)
    rank[table] = np.arange(len(table), dtype=np.uint32)
    control, data = pack_ranks(rank[ids])
    head = MAGIC + np.array([len(doc_ids)], "<u4").tobytes() + np.array([len(ids)], "<u8").tobytes() + np.array([len(table)], "<u4").tobytes()
    valid = np.array([d is not None for d in doc_ids], np.uint8)
    keys = np.array([0 if d is None else d for d in doc_ids], "<i8")
    sizes = np.array([len(t) for t in tokens], "<u4")
    return b"".join([head, table.astype("<u4").tobytes(), keys.tobytes(), valid.tobytes(), sizes.tobytes(), control, data])


def read_bytes(content: bytes) -> Iterator[tuple[int | None, np.ndarray]]:
    """Documents and their ids of one file, in the file's order."""
    raw = np.frombuffer(content, np.uint8)
    if content[:4] != MAGIC:
        raise ValueError("not a token-id file")
    docs = int(np.frombuffer(content, "<u4", 1, 4)[0])
    n = int(np.frombuffer(content, "<u8", 1, 8)[0])
    at = 20
    k = int(np.frombuffer(content, "<u4", 1, 16)[0])
    table = np.frombuffer(content, "<u4", k, at)
    at += 4 * k
    keys = np.frombuffer(content, "<i8", docs, at)
    at += 8 * docs
    valid = np.frombuffer(content, np.uint8, docs, at)
    at += docs
    sizes = np.frombuffer(content, "<u4", docs, at)
    at += 4 * docs
    control = raw[at : at + -(-n // 4)]
    ids = table[unpack_ranks(control, raw[at + len(control) :], n)] if n else np.zeros(0, np.uint32)
    end = np.cumsum(sizes, dtype=np.int64)
    for i in range(docs):
        yield (int(keys[i]) if valid[i] else None), ids[end[i] - sizes[i] : end[i]]


def write(docs: DataFrame, folder: str, vocabulary: str, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text and write the files in ascending order of ``id_col``; the result lists the files (path, docs, ids).

    A file's name begins with its partition and its number there, so names sort as the ids do. Each task writes under a name of
    its own and renames the finished file, so a task that is run again leaves the same files.
    """
    spark = docs.sparkSession
    _shared.tune(spark)

    def task(batches):
        enc = encoder(vocabulary)
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        part, number = TaskContext.get().partitionId(), 0
        keys: list[int | None] = []
        tokens: list[np.ndarray] = []
        held = 0

        def flush():
            nonlocal keys, tokens, held, number
            name = f"part-{part:06d}-{number:06d}.tlvb"
            own = f"{root}/_{name}-{uuid.uuid4().hex}"
            with fs.open_output_stream(own) as out:
                out.write(file_bytes(keys, tokens))
            fs.move(own, f"{root}/{name}")
            row = pa.RecordBatch.from_pydict({"file": [name], "docs": [len(keys)], "ids": [held]}, schema=pa.schema([("file", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())]))
            keys, tokens, held, number = [], [], 0, number + 1
            return row

        tail = np.array([] if end_id is None else [end_id], np.uint32)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for key, ids in zip(batch.column(0).to_pylist(), enc.encode(texts)):
                keys.append(key)
                tokens.append(np.append(ids, tail).astype(np.uint32))
                held += len(tokens[-1])
                if held >= FILE_IDS:
                    yield flush()
        if keys:
            yield flush()

    chosen = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).cast("string").alias("t"))
    # beginnings sort as their texts do
    ordered = chosen.repartitionByRange(F.col("k").asc_nulls_first(), F.substring("t", 1, DEALT_BY)).sortWithinPartitions(F.col("k").asc_nulls_first(), "t")
    return ordered.mapInArrow(task, "file string, docs long, ids long")


def _read(spark: SparkSession, folder: str, last: str, value) -> DataFrame:
    """One row per document: file, place in it, doc_id, number of ids, and ``value(ids)`` as the column that ``last`` names."""
    name, kind = last.split()
    kind = {"binary": pa.binary(), "long": pa.int64()}[kind]

    def task(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                file, rows, size = path.rpartition("/")[2], [], 0
                for i, (key, ids) in enumerate(read_bytes(content.as_buffer().to_pybytes())):
                    rows.append((file, i, key, len(ids), value(ids.astype("<u4").tobytes())))
                    size += len(ids)
                    if size > 1 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    def batch_of(rows):
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.int64(), kind))]
        return pa.RecordBatch.from_arrays(columns, names=["file", "place", "doc_id", "n_tokens", name])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.tlvb").load(folder).select("path", "content")
    return files.mapInArrow(task, f"file string, place long, doc_id long, n_tokens long, {last}")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of the files in ``folder``: file, place in it, doc_id, n_tokens, ids (binary, little-endian uint32)."""
    return _read(spark, folder, "ids binary", bytes)


def digest(spark: SparkSession, folder: str) -> DataFrame:
    """Per document read back from the files: doc_id, start, n_tokens, ids_crc32 (see the query's contract)."""
    rows = _shared.settle(_read(spark, folder, "ids_crc32 long", zlib.crc32), "token-docs")
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("total")).withColumn("part", F.substring_index("file", "-", 2))
    before = lambda w, by: F.coalesce(F.sum("total").over(w.orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = files.groupBy("part").agg(F.sum("total").alias("total"))  # a row a task that wrote
    parts = parts.select("part", before(Window.partitionBy(), "part").alias("first"))
    files = files.withColumn("later", before(Window.partitionBy("part"), "file")).join(parts, "part").select("file", (F.col("first") + F.col("later")).alias("base"))
    inside = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(files, "file")
        .select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
    )


def token_files(docs: DataFrame, vocabulary: str, end_id: int | None = 2) -> DataFrame:
    """Write the files in the shared folder, read them back and return their digest."""
    spark = docs.sparkSession
    folder = _shared.scratch(spark, "tokens")
    # binaryFile needs the folder even when an empty table leaves no file
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)
    write(docs, folder, vocabulary, end_id).agg(F.sum("ids")).collect()
    return digest(spark, folder)
