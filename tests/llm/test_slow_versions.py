"""Slow versions of the queries that SQL can't express and that have no exact answer: language ID with exact n-gram sets in place of the filter,
quality as a plain dot product, toxicity by marginals summed one word at a time."""

import math

import numpy as np
import pyarrow as pa
import pytest

from tracelake.llm import _shared, langid, quality, toxicity
from tracelake.llm import queries as q

SF = "/root/testdata/sf0.01"


def spaced(text):
    """The text as n-grams see it: runs of letters in lower case, one space around each."""
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    return f" {' '.join(words)} " if words else ""


def grams(text):
    return [text[i : i + n] for n in langid.SIZES for i in range(len(text) - n + 1)]


def test_language_id_with_exact_sets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("r", _shared.crc_mod("doc_id", 4)).select("doc_id", "text", "lang", "r").collect()
    counts = {}
    for d in docs:
        if d["r"] != 2 and d["lang"] is not None:
            own = counts.setdefault(d["lang"], {})
            for g in grams(spaced(d["text"])):
                own[g] = own.get(g, 0) + 1
    known = {lang: {g for g, n in own.items() if n >= max(2, sum(own.values()) * langid.MIN_RATE)} for lang, own in sorted(counts.items())}
    rows = {r["doc_id"]: r for r in q.op1_language_id(spark, sf_dir).collect()}
    assert len(rows) == len(docs)
    for d in docs:
        text, r = spaced(d["text"]), rows[d["doc_id"]]
        if not text:
            assert (r["lang_pred"], r["score"]) == ("und", 0)
            continue
        own = grams(text)
        share = {lang: sum(g in s for g in own) / len(own) for lang, s in known.items()}
        best = max(share, key=share.get)
        others = max(v for lang, v in share.items() if lang != best)
        if share[best] - others > 0.01:
            assert r["lang_pred"] == best
        assert abs(r["hit_rate"] - share[best]) < 0.02 and abs(r["score"] - share[best] / sum(share.values())) < 0.02


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def test_quality_by_a_plain_dot_product(spark, texts):
    w = quality.fit(q._labelled(spark, SF, "quality", quality.FIT_ROWS), "label")
    rows = q.op8_quality(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        number, value, _ = quality.features(pa.array([texts[r["doc_id"]]], pa.string()))
        logit = w[0]
        for k, v in zip(number.tolist(), value.tolist()):
            logit += w[k] * v
        p = 1 / (1 + math.exp(-max(-35, min(35, logit))))
        assert abs(r["score"] - p) < 1e-9 and r["predicted"] == int(r["score"] >= 0.3)


def plain_marginals(score, moves):
    """Probabilities of the state 1 of each word, by the two recursions one word at a time."""
    n = len(score)
    ahead, back = [[0.5, 0.5]], [[0.5, 0.5]]
    emit = lambda i, s: math.exp(score[i]) if s else 1.0
    for i in range(n):
        if i == 0:
            now = [emit(0, 0), emit(0, 1)]
        else:
            now = [sum(ahead[-1][a] * math.exp(moves[a][s]) for a in (0, 1)) * emit(i, s) for s in (0, 1)]
        ahead.append([x / sum(now) for x in now])
    for i in range(n - 1, 0, -1):
        now = [sum(math.exp(moves[s][b]) * emit(i, b) * back[-1][b] for b in (0, 1)) for s in (0, 1)]
        back.append([x / sum(now) for x in now])
    out = []
    for a, b in zip(ahead[1:], reversed(back)):
        out.append(a[1] * b[1] / (a[0] * b[0] + a[1] * b[1]))
    return out


def test_toxicity_by_marginals_one_word_at_a_time(spark, texts):
    model = toxicity.fit(q._labelled(spark, SF, "toxic", toxicity.COUNT_ROWS, ones_first=True), "label", stands_col="stands")
    rows = q.op10_toxicity(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in sorted(rows, key=lambda r: r["doc_id"])[:400] + [r for r in rows if r["predicted"]]:
        _, _, _, units, at = toxicity.words(pa.array([texts[r["doc_id"]]], pa.string()))
        numbers, _ = toxicity._features(units, at)
        score = [max(-30.0, min(30.0, model.bias + sum(model.weights[k] for k in row))) for row in numbers.tolist()]
        evidence = sum(p for p in plain_marginals(score, model.moves.tolist()) if p > 0.5)
        want = 1 / (1 + math.exp(-(model.slope * math.log1p(evidence) + model.intercept)))
        assert abs(r["score"] - want) < 1e-6 and r["predicted"] == int(r["score"] >= 0.5)
    assert np.isfinite(model.weights).all()
