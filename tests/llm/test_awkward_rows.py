"""Rows of awkward tables, each held against what its text alone gives: nulls, empty and very long texts, repeated rows, null ids, ties, extra
columns with clashing names."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_ops import ODD, awkward, brute_hits, library
from tracelake.llm import ann, bpe, decontam, html_extract, langid, quality, tokenbin, toxicity
from tracelake.llm import queries as q


@pytest.fixture(scope="module")
def odd(spark):
    df = awkward(spark).repartition(3).cache()
    return df, sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=repr)


def by_key(rows):
    return sorted(rows, key=repr)


def test_token_digests(odd):
    df, rows = odd
    t, want = library("word_bpe_49k.json"), []
    for d, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want.append((d, len(ids), *(hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), t.decode(ids, skip_special_tokens=False).encode()))))
    got = bpe.token_digests(df, q.vocabulary("word_bpe_49k.json")).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert by_key(map(tuple, got)) == by_key(want)


def test_token_files(odd):
    """Rows without an id are written first or last, together; starts have no gaps."""
    df, rows = odd
    t, want = library("byte_bpe_50k.json"), []
    for d, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = sorted(tokenbin.token_files(df, q.vocabulary("byte_bpe_50k.json")).collect(), key=lambda r: r["start"])
    assert by_key((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == by_key(want)
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1].tolist()]
    known = [r["doc_id"] for r in got if r["doc_id"] is not None]
    assert known == sorted(known)


def test_decontamination(spark, odd):
    df, rows = odd
    items = [(1, "same text here"), (1, "same text here"), (2, "word " * 10), (3, None), (4, ""), (5, "日本語 テキスト"), (6, "A B")]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("shard", F.lit("x")).withColumn("doc_id", F.lit(1))
    want = [(d, *brute_hits([text], items)[0][1:]) for d, text in rows]
    assert any(w[-1] for w in want)
    assert by_key(map(tuple, decontam.contamination_report(df, table).collect())) == by_key(want)


def test_scores_are_those_of_the_text(spark, sf_dir, odd):
    """Equal texts, null and empty ones included, have equal results whatever else the row holds; each row has one."""
    df, rows = odd
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labelled = given.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id")
    results = [
        langid.predict(df, langid.fit(given)).select("doc_id", "text", "lang_pred", F.round("score", 9)),
        quality.score(df, quality.fit(labelled, "quality")).select("doc_id", "text", F.round("score", 9)),
        toxicity.tag(df, toxicity.fit(labelled, "toxic")).select("doc_id", "text", F.round("score", 9)),
    ]
    for out in results:
        got = [tuple(r) for r in out.collect()]
        assert by_key(r[:2] for r in got) == rows
        alike = {}
        for r in got:
            alike.setdefault(r[1] or "", set()).add(r[2:])
        assert all(len(v) == 1 for v in alike.values()) and len(alike) == len({t or "" for t in ODD}) + 1


def test_pages(spark):
    """Equal pages, pages without an id, null pages and columns named as the result's."""
    story = " ".join(f"word{i}" for i in range(60))
    page = f"<html><body><nav><a href='/'>Home</a></nav><article><p>{story}</p></article><footer>All rights reserved</footer></body></html>"
    htmls = [page, page, None, "", "<", "plain text only", "<p>" * 3_000 + "deep"]
    df = spark.createDataFrame([(i // 2, h, "mine", -1) for i, h in enumerate(htmls)] + [(None, page, None, None)], "page_id long, html string, text string, n_chars int")
    got = html_extract.extract_pages(df.drop("text", "n_chars"), html_extract.fit(df)).collect()
    assert sorted((r["page_id"] for r in got), key=repr) == sorted([*(i // 2 for i in range(len(htmls))), None], key=repr)
    assert sum(r["text"] == story for r in got) == 3 and sum(r["text"] == "" for r in got) >= 2
    clash = html_extract.extract_pages(df, html_extract.fit(df)).collect()
    assert sorted(r["text"] for r in clash) == sorted(r["text"] for r in got)


def test_neighbours(spark):
    """Fewer candidates than k, vectors of another width, null ids, repeated rows, ties to the smaller id, clashing columns."""
    a, b = [1.0, 0.0], [0.0, 2.0]
    rows = [(20, a), (20, a), (3, a), (1, a), (7, b), (0, b), (5, [1.0, 2.0, 3.0]), (40, []), (None, a), (60, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit("v")).withColumn("score", F.lit(1)).withColumn("id", F.lit(9))
    got = sorted(map(tuple, ann.nearest(df, F.col("id") % 20 == 0).collect()))
    assert got == [(0, 1, 7, 4.0), (0, 2, 1, 0.0), (0, 3, 3, 0.0), (0, 4, 20, 0.0), (20, 1, 1, 1.0), (20, 2, 3, 1.0), (20, 3, 0, 0.0), (20, 4, 7, 0.0)]
    assert [tuple(r) for r in ann.nearest(df, F.col("id") % 20 == 0, k=1).orderBy("query_id").collect()] == [(0, 1, 7, 4.0), (20, 1, 1, 1.0)]
    assert ann.nearest(df.where("vec_id = 20"), F.col("id") % 20 == 0).count() == 0
