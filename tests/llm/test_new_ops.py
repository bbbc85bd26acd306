"""Packing, the Merkle manifest and periodic runs: contracts, brute force and awkward rows."""

import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.test_ops import ODD, awkward, docs
from tracelake.llm import merkle, packing, periodic
from tracelake.llm import queries as q

# ---------------------------------------------------------------- packing


def brute_fit(lengths, size):
    """Best-fit decreasing, by looking at every open sequence."""
    room, out = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [r for r in room if r >= lengths[i]]
        if fits:
            r = min(fits)
            s = max(k for k, x in enumerate(room) if x == r)
        else:
            room.append(size)
            s = len(room) - 1
        out[i] = (s, size - room[s])
        room[s] -= lengths[i]
    return out, room


@given(st.lists(st.integers(1, 64), max_size=80))
@settings(max_examples=200, deadline=None)
def test_best_fit_takes_the_tightest_room(lengths):
    sequence, offset, n = packing.best_fit_decreasing(lengths, 64)
    _, room = brute_fit(lengths, 64)
    left = [64] * n
    for s, length in zip(sequence, lengths):
        left[s] -= length
    assert sorted(left) == sorted(room)
    spans = sorted((s, o, o + length) for s, o, length in zip(sequence, offset, lengths))
    assert all(a[0] != b[0] or a[2] == b[1] for a, b in zip(spans, spans[1:]))


def held(pieces, lengths, size):
    """Pieces hold each document whole and without gaps, sequences are gapless from 0; returns the sequences' fills."""
    by = {}
    for d, start, length, *_ in pieces:
        by.setdefault(d, []).append((start, length))
    assert sorted(by) == list(range(len(lengths)))
    for d, parts in by.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at and 0 < length <= size
            at += length
        assert at == lengths[d]
    fills = {}
    for _, _, length, s, o in sorted(pieces, key=lambda p: (p[3], p[4])):
        assert o == fills.get(s, 0)
        fills[s] = o + length
    assert all(f <= size for f in fills.values())
    return fills


@given(st.lists(st.integers(1, 300), max_size=60))
@settings(max_examples=200, deadline=None)
def test_pieces_hold_every_token_once(lengths):
    fills = held(packing.pack(lengths, 64), lengths, 64)
    assert sum(f < packing.FULL * 64 for f in fills.values()) <= 1


def test_packing(spark, sf_dir):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(q.vocabulary("word_bpe_49k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def check(df, rows):
        want = {}
        for r in df.select("doc_id", "text").collect():
            want.setdefault(r["doc_id"], []).append([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1])
        got = {}
        for r in rows:
            got.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        # one document can stand in the table more than once: each of its pieces is then there as often
        assert {k[0] for k in got} == set(want)
        for doc_id, texts in want.items():
            for ids in texts:
                parts = sorted(got[doc_id, len(ids)], key=lambda r: r["start"])
                assert sum(r["length"] for r in parts) == len(ids) * sum(len(t) == len(ids) for t in texts)
                for r in parts:
                    assert any(zlib.crc32(np.array(t[r["start"] : r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"] for t in texts)
        fills = {}
        for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
            assert r["offset"] == fills.get(r["sequence_id"], 0)
            fills[r["sequence_id"]] = r["offset"] + r["length"]
        assert max(fills.values()) <= 2048
        return fills

    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fills = check(table, q.op11_packing(spark, sf_dir).collect())
    assert sum(fills.values()) > 0.98 * 2048 * (len(fills) - 1)
    odd = awkward(spark).repartition(3)
    check(odd, packing.piece_digests(odd, q.vocabulary("word_bpe_49k.json")).collect())
    assert packing.piece_digests(docs(spark, []), q.vocabulary("word_bpe_49k.json")).count() == 0


def test_packed_ids(spark):
    rows = packing.pack_documents(docs(spark, ["a b c", None]), q.vocabulary("word_bpe_49k.json"), size=8, end_id=1).collect()
    ids = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in rows}
    assert ids[1] == [1] and ids[0][-1] == 1 and len(ids[0]) == rows[0]["doc_tokens"]


def test_shards_of_a_task(spark, monkeypatch):
    """Small shards, several tasks: sequences of shards and tasks are never mixed up, and all tokens are there."""
    monkeypatch.setattr(packing, "SHARD_TOKENS", 300)
    texts = [" ".join(["word"] * (7 * i % 90)) for i in range(200)]
    rows = packing.piece_digests(docs(spark, texts).repartition(3), q.vocabulary("word_bpe_49k.json"), size=64).collect()
    fills = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fills.get(r["sequence_id"], 0)
        fills[r["sequence_id"]] = r["offset"] + r["length"]
    assert sum(fills.values()) == sum({r["doc_id"]: r["doc_tokens"] for r in rows}.values()) and max(fills.values()) <= 64


# ---------------------------------------------------------------- Merkle manifest


def brute_proofs(rows):
    """The contract, by plain lists."""
    H = lambda s: hashlib.sha256(s.encode()).hexdigest()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, more=0: H("".join(map(field, (r["doc_id"], r["source"], r["lang"], None if r["n_chars"] is None else r["n_chars"] + more, r["text"]))))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([H("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
        return out

    def path(all_levels, i):
        for level in all_levels[:-1]:
            yield i % 2, level[i ^ 1] if i ^ 1 < len(level) else ""
            i //= 2

    langs = sorted({r["lang"] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((r for r in rows if r["lang"] == lang), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[lang] = own, levels([leaf(r) for r in own])
    above = levels([trees[v][1][-1][0] for v in langs])
    root = above[-1][0] if rows else None
    out = []
    for k, lang in enumerate(langs):
        own, tree = trees[lang]
        for i, r in enumerate(own):
            steps = [*path(tree, i), *path(above, k)]
            bad = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            at = leaf(r, int(bad))
            for digit, other in steps:
                at = H(other + at if digit else at + other)
            out.append((r["doc_id"], leaf(r), tree[-1][0], root, H("".join(x for _, x in steps)), at, at == root))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def proved(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in merkle.proofs(df).collect()), key=repr)


def test_merkle_equals_brute_force(spark, sf_dir, monkeypatch):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert sorted((tuple(r[c] for c in COLUMNS) for r in q.op12_merkle_manifest(spark, sf_dir).collect()), key=repr) == brute_proofs(table.collect())
    odd = awkward(spark)
    assert proved(odd) == brute_proofs(odd.collect())
    assert merkle.proofs(docs(spark, [])).count() == 0
    # several storeys of small segments: languages of 1 to 70 rows, among them null, empty, and two that order bytewise
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "SEGMENT", 4)
    langs = [("a", 70), (None, 17), ("", 1), ("Z", 5), ("é", 4), ("b", 33)]
    rows = [(i, f"text {i}", lang, "s" if i % 3 else None, i if i % 5 else None) for lang, n in langs for i in range(n)]
    many = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    got = proved(many)
    assert got == brute_proofs(many.collect())
    assert 0 < sum(not r[-1] for r in got) < len(got) / 3


def test_merkle_rows_of_a_hot_key_are_dealt(spark):
    """A third of all rows with one doc_id, equal throughout: ranks are those of their leaves."""
    rows = [(1, "same", "en", "s", 4)] * 60 + [(i, f"t{i}", "en", "s", 4) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(6)
    assert proved(df) == brute_proofs(df.collect())


def test_merkle_tampering_is_seen(spark):
    df = docs(spark, [f"text {i}" for i in range(30)]).withColumn("n_chars", F.lit(5).cast("long"))
    m = merkle.build(df, F.col("doc_id") == 11)
    rows = merkle.prove(m).collect()
    assert [r["doc_id"] for r in rows if not r["verified"]] == [11] and len({r["root"] for r in rows}) == 1
    assert all(merkle.fold(r["leaf"], []) == r["leaf"] for r in rows)
    m.drop()


# ---------------------------------------------------------------- periodic runs


def brute_runs(w, periods=4, words=6):
    out, n = [], len(w)
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            length = j - i + p
            if length >= max(words, periods * p) and not any(all(w[i + k] == w[i + k + r] for k in range(length - r)) for r in range(1, p)):
                out.append((i, length, p))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


REPEATING = st.builds(lambda a, b, k, c: [*a, *(b * k), *c], st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(0, 2), min_size=1, max_size=7), st.integers(1, 9), st.lists(st.integers(0, 3), max_size=8))


@given(st.one_of(st.lists(st.integers(0, 1), max_size=40), st.builds(lambda a, b: a + b, REPEATING, REPEATING)))
@settings(max_examples=600, deadline=None)
def test_runs_equal_brute_force(w):
    assert periodic.runs(w, 2, 2) == brute_runs(w, 2, 2)
    want = brute_runs(w)
    assert periodic.runs(w) == want
    assert periodic.word_runs([str(x).encode() for x in w]) == want


def test_stretches_are_few_in_plain_text():
    """Copies far apart are no runs: nothing of them is read word by word; what lies in a run is."""
    rng = random.Random(3)
    line = [f"w{rng.randrange(900)}" for _ in range(40)]
    text = [x for _ in range(30) for x in [*line, *(f"u{rng.getrandbits(40)}" for _ in range(200))]]
    number = {w: k for k, w in enumerate(dict.fromkeys(text))}
    assert periodic.stretches(np.array([number[w] for w in text])) == []
    text[500:500] = ["x", "y", "z"] * 5
    assert periodic.word_runs([w.encode() for w in text]) == [(500, 15, 3)]


def test_long_runs_take_little_time():
    import time

    began = time.process_time()
    assert periodic.runs([0] * 60_000) == [(0, 60_000, 1)]
    fib = [0, 1]
    while len(fib) < 20_000:
        fib = fib + fib[: len(fib) * 610 // 987]
    periodic.squares(fib[:20_000])
    assert time.process_time() - began < 30


def brute_digest(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(b"null" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    gone = {i for s, length, p in found for i in range(s + p, s + length)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2])) if found else None
    sha = lambda b: hashlib.sha256(b).hexdigest()
    told = "".join(f"{s},{length},{p}\n" for s, length, p in found).encode()
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(told), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_run_digests_equal_brute_force(spark, sf_dir):
    rows = q.op13_periodic_runs(spark, sf_dir).collect()
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, rows)) == sorted(brute_digest(r["doc_id"], r["text"]) for r in texts)
    assert sum(r["n_runs"] > 0 for r in rows) > 5
    odd = awkward(spark).where("doc_id is null or doc_id <> 9")  # brute force takes long over 30,000 equal words
    key = lambda r: (r[0] is None, r)
    assert sorted((tuple(r) for r in periodic.run_digests(odd).collect()), key=key) == sorted((brute_digest(r["doc_id"], r["text"]) for r in odd.collect()), key=key)
    assert periodic.run_digests(docs(spark, [])).count() == 0


def test_collapsed_texts(spark):
    texts = ["go go go go go go go  away", "a  b\nc", *ODD]
    rows = {r["doc_id"]: r for r in periodic.collapse_runs(docs(spark, texts)).collect()}
    assert rows[0]["text"] == "go away" and [tuple(x) for x in rows[0]["runs"]] == [(0, 7, 1)]
    assert rows[1]["text"] == "a  b\nc" and rows[2]["text"] is None
    assert rows[2 + ODD.index("word " * 30_000)]["text"] == "word"
