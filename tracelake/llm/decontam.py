"""Benchmark decontamination with one FM-index per training shard.

A shard is a run of whole documents of about ``SHARD_WORDS`` words. Its words, numbered, and a separator after each document form the
indexed sequence: suffix array by prefix doubling, Burrows-Wheeler transform, wavelet matrix with rank blocks, and suffix positions
sampled every ``SAMPLE`` places and at each document's start. Every window of the test items is searched backwards in all shards; the
occurrences are located from the samples and merged into spans. Shards need no shuffle. The test items' word hashes are written in blocks of
about ``BLOCK_BYTES`` of text to the shared folder, by Spark tasks; a task reads one block at a time, cuts its windows, and searches each
different one that the shard has all words of once.

A window is ``window`` consecutive words of an item; an item with fewer words, but not none, is one window. Words are runs of letters
and digits after lower-casing A-Z (all non-ASCII characters count as letters). Null texts have no words; items with a null id are left
out; items with equal ids count as one; equal documents are each reported. An empty documents table gives an empty result, an empty
test table no hits.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm import _shared, _text

SHARD_WORDS = 1 << 20
SAMPLE = 16
#: Bytes of test text in one block, about.
BLOCK_BYTES = 8 << 20


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; only suffixes that still tie are sorted again. Nothing comes before any symbol."""
    n = len(t)
    t = t + 1
    bits = int(t.max()).bit_length()
    depth = max(1, min(3, 62 // max(bits, 1)))
    key = t.astype(np.int64, copy=True)
    for k in range(1, depth):
        key <<= bits
        key[: n - k] |= t[k:]
    sa = np.argsort(key)
    key = key[sa]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    slot = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, slot, 0))
    h = depth
    tied = ~new
    tied[:-1] |= ~new[1:]
    open_slots = np.flatnonzero(tied)
    while len(open_slots):
        p = sa[open_slots]
        after = p + h
        key = rank[p] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        order = np.argsort(key)
        p, key = p[order], key[order]
        sa[open_slots] = p
        new = np.ones(len(p), bool)
        new[1:] = key[1:] != key[:-1]
        rank[p] = open_slots[np.maximum.accumulate(np.where(new, np.arange(len(p)), 0))]
        tied = ~new
        tied[:-1] |= ~new[1:]
        open_slots = open_slots[tied]
        h *= 2
    return sa


class Bits:
    """A bit sequence with rank: bits packed in 64-bit blocks and the number of ones before each block."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.blocks = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.blocks.view(np.uint8)[: len(packed)] = packed
        ones = np.bitwise_count(self.blocks)
        self.before = np.cumsum(ones, dtype=np.int64) - ones

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        block = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.blocks[block] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.blocks[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1


class FMIndex:
    """Counts and locates sequences of symbols in ``t`` (symbols 0 to 2**bits - 1; 0 ends each document)."""

    def __init__(self, t: np.ndarray, sampled: np.ndarray):
        self.n = len(t)
        self.bits = max(1, int(t.max()).bit_length())
        sa = suffix_array(t)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=1 << self.bits))])
        column = t[sa - 1]
        self.levels: list[tuple[Bits, int]] = []
        for level in range(self.bits - 1, -1, -1):
            bit = (column >> level) & 1 == 1
            zeros = column[~bit]
            self.levels.append((Bits(bit), len(zeros)))
            column = np.concatenate([zeros, column[bit]])
        marked = sampled[sa]
        self.marked = Bits(marked)
        self.positions = sa[marked]

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of the symbols among the first i of the transform."""
        low = np.zeros_like(i)
        for level, (bits, zeros) in enumerate(self.levels):
            one = (symbol >> (self.bits - 1 - level)) & 1 == 1
            both = bits.rank(np.concatenate([low, i]))
            ones_low, ones_i = both[: len(i)], both[len(i) :]
            low, i = np.where(one, zeros + ones_low, low - ones_low), np.where(one, zeros + ones_i, i - ones_i)
        return i - low

    def symbol(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros_like(i)
        for bits, zeros in self.levels:
            one, ones = bits.get(i), bits.rank(i)
            out = out * 2 + one
            i = np.where(one, zeros + ones, i - ones)
        return out

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of the rows of ``patterns`` (padded at the end): index of those that occur, first row and end row."""
        alive = np.arange(len(patterns))
        symbol = patterns[alive, lengths - 1]
        low, high = self.first[symbol], self.first[symbol + 1]
        for k in range(2, int(lengths.max()) + 1 if len(lengths) else 0):
            go = np.flatnonzero(lengths[alive] >= k)
            if not len(go):
                break
            symbol = patterns[alive[go], lengths[alive[go]] - k]
            counts = self.rank(np.concatenate([symbol, symbol]), np.concatenate([low[go], high[go]]))
            low[go] = self.first[symbol] + counts[: len(go)]
            high[go] = self.first[symbol] + counts[len(go) :]
            keep = low < high
            alive, low, high = alive[keep], low[keep], high[keep]
        keep = low < high
        return alive[keep], low[keep], high[keep]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes at these rows: steps back until a sampled one."""
        out = np.empty(len(rows), np.int64)
        todo, steps = np.arange(len(rows)), 0
        while len(todo):
            found = self.marked.get(rows)
            out[todo[found]] = self.positions[self.marked.rank(rows[found])] + steps
            todo, rows = todo[~found], rows[~found]
            symbol = self.symbol(rows)
            rows = self.first[symbol] + self.rank(symbol, rows)
            steps += 1
        return out


def _blocks(items: DataFrame, id_col: str, text_col: str) -> list[str]:
    """Files of the items' names and word hashes, of about BLOCK_BYTES of text each; only their names pass through the driver."""
    spark = items.sparkSession
    items = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).where("item is not null and text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    folder = _shared.scratch(spark, "benchmark-words")

    def write(batches):
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        for batch in batches:
            if not len(batch):
                continue
            data, offsets = _text.pack(batch.column(1))
            _, _, h, at = _text.words(_text.LOWER[data], offsets, _text.ALNUM)
            hashes = pa.array([h[i:j].tobytes() for i, j in zip(at, at[1:])], pa.binary())
            block = pa.record_batch([batch.column(0), hashes], names=["item", "words"])
            # equal blocks have equal names: a task that runs again leaves the same files
            name = hashlib.blake2b(b"".join([*(x.encode() for x in batch.column(0).to_pylist()), h.tobytes()]), digest_size=12).hexdigest()
            own = f"{root}/_{uuid.uuid4().hex}"
            with fs.open_output_stream(own) as out, pa.ipc.new_stream(out, block.schema) as writer:
                writer.write_batch(block)
            fs.move(own, f"{root}/{name}.arrow")
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}.arrow"])], names=["file"])

    dealt = items.repartition(max(1, -(-size // BLOCK_BYTES)), "item")
    return [r["file"] for r in dealt.mapInArrow(write, "file string").distinct().collect()]


def _windows(file: str, seen: np.ndarray, window: int):
    """Of a block of items, each different window whose words are all in ``seen`` (sorted hashes): symbols (rows padded with 0), lengths, and
    the names of the items that have it."""
    fs, path = pafs.FileSystem.from_uri(file)
    with fs.open_input_file(path) as source:
        block = pa.ipc.open_stream(source).read_all()
    names, packed = block.column("item").to_pylist(), block.column("words").to_pylist()
    h = np.frombuffer(b"".join(packed), np.uint64)
    count = np.array([len(p) // 8 for p in packed], np.int64)
    begin = np.cumsum(count) - count
    length = np.minimum(count, window)
    n = np.where(count > 0, count - length + 1, 0)
    item = np.repeat(np.arange(len(names)), n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + begin[item]
    found = np.minimum(np.searchsorted(seen, h), len(seen) - 1)
    there = seen[found] == h
    gone = np.concatenate([[0], np.cumsum(~there)])
    keep = gone[start + length[item]] == gone[start]
    start, item = start[keep], item[keep]
    if not len(start):
        return np.zeros((0, window), np.int64), np.zeros(0, np.int64), []
    place = start[:, None] + np.arange(window)
    inside = np.arange(window) < length[item][:, None]
    symbols = np.where(inside, found[np.minimum(place, len(h) - 1)] + 1, 0)
    symbols, at = np.unique(symbols, axis=0, return_inverse=True)
    order = np.lexsort((item, at.reshape(-1)))
    groups = np.split(item[order], np.flatnonzero(np.diff(at.reshape(-1)[order])) + 1)
    return symbols, (symbols > 0).sum(axis=1), [{names[i] for i in g} for g in groups]


def _shard_hits(texts: pa.Array, blocks: list[str], window: int):
    """Words of the shard's texts (start, end, first word of each text), which of them are hit, and the items of each text."""
    data, offsets = _text.pack(texts)
    start, end, h, at = _text.words(_text.LOWER[data], offsets, _text.ALNUM)
    hit = np.zeros(len(h), bool)
    items: dict[int, set] = {}
    if len(h) and blocks:
        seen, number = np.unique(h, return_inverse=True)
        docs = len(at) - 1
        doc = np.repeat(np.arange(docs), np.diff(at))
        place = np.arange(len(h)) + doc  # one separator after each document
        t = np.zeros(len(h) + docs, np.int64)
        t[place] = number + 1
        starts = at[:-1] + np.arange(docs)
        sampled = np.zeros(len(t), bool)
        sampled[::SAMPLE] = True
        sampled[starts] = True
        index = FMIndex(t, sampled)
        change = np.zeros(len(t) + 1, np.int64)
        for block in blocks:
            symbols, lengths, owners = _windows(block, seen, window)
            if not len(symbols):
                continue
            which, low, high = index.search(symbols, lengths)
            size = high - low
            rows = np.repeat(low, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            where, which = index.locate(rows), np.repeat(which, size)
            np.add.at(change, where, 1)
            np.add.at(change, where + lengths[which], -1)
            owner = np.searchsorted(starts, where, side="right") - 1
            for d, i in {*zip(owner.tolist(), which.tolist())}:
                items.setdefault(d, set()).update(owners[i])
        hit = np.cumsum(change[:-1])[place] > 0
    return offsets, start, end, at, hit, items


def _shards(batches, text_place: int):
    """Groups of Arrow batches of about SHARD_WORDS words (6.5 bytes each, as a guess) of text."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(text_place).nbytes
        if size >= SHARD_WORDS * 6.5:
            yield held
            held, size = [], 0
    if held:
        yield held


def find_contamination(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items (ids as strings, sorted), spans (array of start and end byte, merged)."""
    _shared.tune(docs.sparkSession)
    blocks = _blocks(items, item_col, item_text_col)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.list_(pa.int64())))])

    def task(batches):
        for held in _shards(batches, 1):
            keys = pa.concat_arrays([b.column(0) for b in held])
            offsets, start, end, at, hit, items = _shard_hits(pa.concat_arrays([b.column(1) for b in held]), blocks, window)
            total = np.concatenate([[0], np.cumsum(hit)])
            n_hit = total[at[1:]] - total[at[:-1]]
            named, spans = [], []
            for d in range(len(keys)):
                named.append(sorted(items.get(d, ())))
                spans.append([[a - int(offsets[d]), b - int(offsets[d])] for a, b in _spans(start, end, at, hit, d)] if n_hit[d] else [])
            yield pa.RecordBatch.from_arrays([keys, pa.array(np.diff(at)), pa.array(n_hit), pa.array([len(x) for x in named], pa.int64()), pa.array(named, schema.field("items").type), pa.array(spans, schema.field("spans").type)], schema=schema)

    chosen = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).cast("string").alias("t"))
    return chosen.mapInArrow(task, "doc_id long, n_words long, n_hit long, n_items long, items array<string>, spans array<array<long>>")


def _spans(start, end, at, hit, d) -> list[tuple[int, int]]:
    """First and end byte of each maximal run of hit words of document d."""
    own = np.flatnonzero(hit[at[d] : at[d + 1]])
    if not len(own):
        return []
    cut = np.flatnonzero(np.diff(own) > 1)
    first, last = own[np.concatenate([[0], cut + 1])], own[np.concatenate([cut, [len(own) - 1]])]
    return list(zip(start[at[d] + first].tolist(), end[at[d] + last].tolist()))


def remove_contamination(docs: DataFrame, items: DataFrame, window: int = 10, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents with every hit span cut from their texts, and again those that the cut brings together, until no window occurs; all
    rows and all columns stay, null texts stay null."""
    _shared.tune(docs.sparkSession)
    blocks = _blocks(items, item_col, item_text_col)
    place = docs.columns.index(text_col)

    def clean(texts: list, kind: pa.DataType) -> list:
        todo = [i for i, x in enumerate(texts) if x]
        while todo:
            offsets, start, end, at, hit, _ = _shard_hits(pa.array([texts[i] for i in todo], kind), blocks, window)
            total = np.concatenate([[0], np.cumsum(hit)])
            again = np.flatnonzero(total[at[1:]] > total[at[:-1]]).tolist()
            for k in again:
                raw, kept, done = texts[todo[k]].encode(), [], 0
                for a, b in _spans(start, end, at, hit, k):
                    kept.append(raw[done : a - int(offsets[k])])
                    done = b - int(offsets[k])
                texts[todo[k]] = b"".join([*kept, raw[done:]]).decode()
            todo = [todo[k] for k in again]
        return texts

    def task(batches):
        for held in _shards(batches, place):
            kind = held[0].column(place).type
            texts = clean([x for b in held for x in b.column(place).to_pylist()], kind)
            done = 0
            for batch in held:
                own = pa.array(texts[done : done + len(batch)], kind)
                done += len(batch)
                yield pa.RecordBatch.from_arrays([own if i == place else c for i, c in enumerate(batch.columns)], schema=batch.schema)

    return docs.mapInArrow(task, docs.schema)


def contamination_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256 and contaminated, for windows of ten words."""
    found = find_contamination(docs, items)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


#: ``contamination_report`` in DuckDB: windows of the test items joined with all windows of the documents of the same length.
ORACLE_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS t FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS t FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
i AS (SELECT item_id, t, least(len(t), 10) AS n, unnest(range(1, len(t) - least(len(t), 10) + 2)) AS k FROM b WHERE len(t) > 0),
q AS (SELECT DISTINCT item_id, n, array_to_string(t[k:k + n - 1], ' ') AS g FROM i),
z AS (SELECT DISTINCT n FROM q),
d AS (SELECT doc_id, t, n, unnest(range(1, len(t) - n + 2)) AS k FROM w CROSS JOIN z WHERE len(t) >= n),
h AS (SELECT d.doc_id, d.k, d.n, q.item_id FROM d JOIN q ON d.n = q.n AND array_to_string(d.t[d.k:d.k + d.n - 1], ' ') = q.g),
p AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(k, k + n)) AS k FROM h) GROUP BY 1),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM h) GROUP BY 1)
SELECT w.doc_id, CAST(len(w.t) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN p USING (doc_id) LEFT JOIN m USING (doc_id)
"""
