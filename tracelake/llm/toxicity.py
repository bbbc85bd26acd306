"""Toxic spans by a linear-chain conditional random field over words, and document scores from its marginals.

Words are runs of letters and digits of the lower-cased text (A-Z; non-ASCII characters count as letters). A word's score for the
state 'toxic' sums the weights of its own hash, of its beginnings of four and six bytes, and of its neighbours' hashes; a 2 x 2 table scores
transitions. Forward and backward
recursions run over all texts of a batch as one chain, in which a text's first word forgets what came before; blocks of words are
multiplied side by side, so the recursion is numpy over blocks and no text is cut.

Labelled tokens: there are labels of documents only. In labelled toxic documents, a word is toxic if it, or one of its beginnings, stands
behind at least ``MIN_CONTEXTS`` different words in toxic documents (fewer where there are few of these) and ``MIN_ODDS`` times as often,
for their number, as in clean ones; all other words of labelled documents are clean. Different words before it are counted, not
documents, so that many copies of one document make none of its words toxic. Contexts are counted over all rows given, for those words
that are in ``LEAST_ODDS`` times as large a share of the toxic documents as of the clean ones, so that common words aren't moved; the
``MAX_UNITS`` words with most toxic contexts are kept. The gradient steps take a bounded sample (about ``FIT_ROWS`` labelled rows; toxic
ones up to half of it first), dealt over at most ``SHARDS`` tasks; Spark averages the weights.

A document's evidence is the sum of the marginals of its words that are likelier toxic than not; a logistic function fitted on the same
sample, each row with the weight of those it stands for, turns it into a score. Null and empty texts have no evidence. Without toxic labels nothing is tagged and scores are below 0.5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.llm import _shared, _text

SIZE = 1 << 20
FIT_ROWS = 6_000
#: Labelled rows whose contexts are counted, about; the caller chooses them (see queries), toxic ones up to half of it first.
COUNT_ROWS = 24_000
#: Tasks that train side by side, and the rows that make one worthwhile.
SHARDS, SHARD_ROWS = 4, 1_000
PASSES = 10
#: Documents in one gradient step.
STEP_DOCS = 32
MIN_ODDS = 20.0
MIN_CONTEXTS, MIN_SHARE = 8, 0.05
#: Contexts are counted of words at least so many times as frequent in toxic documents as in clean ones.
LEAST_ODDS = 2.0
#: Positions of the table of those words that is sent to all tasks, one bit each.
MEMBERS = 1 << 24
#: Units that a task holds before it adds their counts up.
HELD = 1 << 20
#: Words labelled toxic, at most (8 bytes each).
MAX_UNITS = 1 << 17
#: Bytes of the beginnings of words that are features.
BEGINNINGS = (4, 6)
RATE = 1.0
BLOCK = 128


def words(texts: pa.Array):
    """Where texts begin, start and end bytes of their words, the words' units, and the first word of each text. A word's units are the
    hashes of the word and of its beginnings (0 if it isn't longer): an array of shape (words, 1 + len(BEGINNINGS))."""
    data, offsets = _text.pack(texts)
    data = _text.LOWER[data]
    start, end, h, at = _text.words(data, offsets, _text.ALNUM)
    units = np.zeros((len(h), 1 + len(BEGINNINGS)), np.uint64)
    units[:, 0] = h
    for k, size in enumerate(BEGINNINGS, 1):
        longer = np.flatnonzero(end - start > size)
        part = np.zeros(len(longer), np.uint64)
        for j in range(size):
            part = _text.mix(part * _text.PLACES[k] + data[start[longer] + j] + np.uint64(1))
        units[longer, k] = part
    return offsets, start, end, units, at


def _features(units: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of the words - of each unit, the word before and the word after (0: none) - and where texts begin."""
    n, width = units.shape
    first = np.zeros(n + 1, bool)
    first[at[:-1]] = True  # an empty text marks the next one's start, or the end
    first[n] = True
    out = np.zeros((n, width + 2), np.int64)
    number = lambda h, k: (_text.mix(h * _text.PLACES[40 + k]) % np.uint64(SIZE - 1)).astype(np.int64) + 1
    for k in range(width):
        out[:, k] = np.where(units[:, k] > 0, number(units[:, k], k), 0)
    if n:
        out[1:, width] = np.where(first[1:n], 0, number(units[:-1, 0], width))
        out[:-1, width + 1] = np.where(first[1:n], 0, number(units[1:, 0], width + 1))
    return out, first[:-1]


class Model:
    """weights by feature (0 unused), bias, transition table and the logistic function's slope and intercept."""

    def __init__(self, weights=None, bias=-8.0, moves=None, slope=8.0, intercept=-4.0):
        self.weights = np.zeros(SIZE) if weights is None else weights
        self.bias, self.moves = bias, np.zeros((2, 2)) if moves is None else moves
        self.slope, self.intercept = slope, intercept

    def scores(self, numbers: np.ndarray) -> np.ndarray:
        return np.clip(self.bias + self.weights[numbers].sum(axis=1), -30, 30)


def forward_backward(score: np.ndarray, first: np.ndarray, moves: np.ndarray):
    """Forward and backward vectors (each scaled to sum 1) of every word: arrays of shape (2, n)."""
    n = len(score)
    rows = -(-n // BLOCK)
    e = np.ones(rows * BLOCK)
    e[:n] = np.exp(score)
    reset = np.zeros(rows * BLOCK, bool)
    reset[:n] = first
    t = np.exp(moves)
    m00 = np.where(reset, 1.0, t[0, 0])
    m10 = np.where(reset, 1.0, t[1, 0])
    m01 = np.where(reset, 1.0, t[0, 1]) * e
    m11 = np.where(reset, 1.0, t[1, 1]) * e
    m00[n:], m10[n:], m01[n:], m11[n:] = 1, 0, 0, 1  # padding: identity
    m00, m01, m10, m11 = (np.ascontiguousarray(m.reshape(rows, BLOCK).T) for m in (m00, m01, m10, m11))
    a, b, c, d = (x[0].copy() for x in (m00, m01, m10, m11))
    for k in range(1, BLOCK):
        a, b, c, d = a * m00[k] + b * m10[k], a * m01[k] + b * m11[k], c * m00[k] + d * m10[k], c * m01[k] + d * m11[k]
        s = 1 / (a + b + c + d)
        a, b, c, d = a * s, b * s, c * s, d * s
    into = np.empty((2, rows))
    x, y = 0.5, 0.5
    for r, (p, q, u, v) in enumerate(zip(a.tolist(), b.tolist(), c.tolist(), d.tolist())):
        into[0, r], into[1, r] = x, y
        x, y = x * p + y * u, x * q + y * v
        s = x + y
        x, y = x / s, y / s
    back = np.empty((2, rows))
    x, y = 0.5, 0.5
    for r in range(rows - 1, -1, -1):
        back[0, r], back[1, r] = x, y
        x, y = a[r] * x + b[r] * y, c[r] * x + d[r] * y
        s = x + y
        x, y = x / s, y / s
    alpha, beta = np.empty((2, BLOCK, rows)), np.empty((2, BLOCK, rows))
    x, y = into
    for k in range(BLOCK):
        x, y = x * m00[k] + y * m10[k], x * m01[k] + y * m11[k]
        s = 1 / (x + y)
        alpha[0, k], alpha[1, k] = x, y = x * s, y * s
    x, y = back
    for k in range(BLOCK - 1, -1, -1):
        beta[0, k], beta[1, k] = x, y
        x, y = m00[k] * x + m01[k] * y, m10[k] * x + m11[k] * y
        s = 1 / (x + y)
        x, y = x * s, y * s
    flat = lambda z: z.transpose(0, 2, 1).reshape(2, -1)[:, :n]
    return flat(alpha), flat(beta)


def marginals(model: Model, numbers: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Probability of the state 'toxic' for every word."""
    if not len(numbers):
        return np.zeros(0)
    alpha, beta = forward_backward(model.scores(numbers), first, model.moves)
    both = alpha * beta
    return both[1] / both.sum(axis=0)


def _train(parts: list, toxic_units: np.ndarray) -> Model:
    """Adaptive gradient steps on the log-likelihood, one step for each STEP_DOCS documents."""
    model = Model()
    seen, seen_moves, seen_bias = np.full(SIZE, 1e-8), np.full((2, 2), 1e-8), 1e-8
    order = np.random.default_rng(11)
    ready = []
    for label, units, at in parts:
        for i in range(0, len(label), STEP_DOCS):
            j = min(i + STEP_DOCS, len(label))
            own = units[at[i] : at[j]]
            state = np.isin(own, toxic_units).any(axis=1) & np.repeat(label[i:j] == 1, np.diff(at[i : j + 1]))
            if len(own):
                ready.append((*_features(own, at[i : j + 1] - at[i]), state))
    for _ in range(PASSES):
        for i in order.permutation(len(ready)):
            numbers, first, state = ready[i]
            score = model.scores(numbers)
            alpha, beta = forward_backward(score, first, model.moves)
            both = alpha * beta
            miss = state - both[1] / both.sum(axis=0)
            # words that are as sure as they should be move nothing
            off = np.flatnonzero(np.abs(miss) > 1e-4)
            touched, at = np.unique(numbers[off], return_inverse=True)
            g = np.bincount(at.reshape(-1), np.repeat(miss[off], numbers.shape[1]), len(touched)).astype(float)
            g[touched == 0] = 0
            seen[touched] += g * g
            model.weights[touched] += RATE * g / np.sqrt(seen[touched])
            go = np.flatnonzero(~first)
            t = np.exp(model.moves)
            pair = np.stack([alpha[a, go - 1] * t[a, b] * (np.exp(score[go]) if b else 1.0) * beta[b, go] for a in (0, 1) for b in (0, 1)])
            expected = (pair / pair.sum(axis=0)).sum(axis=1).reshape(2, 2)
            observed = np.bincount(state[go - 1].astype(int) * 2 + state[go], minlength=4).reshape(2, 2)
            gm = observed - expected
            gm[0, 0] = 0
            seen_moves += gm * gm
            model.moves = model.moves + 0.2 * gm / np.sqrt(seen_moves)
            seen_bias += miss.sum() ** 2
            model.bias += 0.2 * miss.sum() / np.sqrt(seen_bias)
    return model


def fit(labelled: DataFrame, label_col: str, text_col: str = "text", id_col: str = "doc_id", stands_col: str | None = None) -> Model:
    """Learn from rows with label 0 or 1; rows with other labels or none are left out. The rows are read several times: give a sample of
    about ``COUNT_ROWS``, with the labelled rows that each stands for in ``stands_col``."""
    spark = labelled.sparkSession
    _shared.tune(spark)
    rows = labelled.select(F.col(label_col).cast("int").alias("label"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30)).alias("h"), (F.lit(1.0) if stands_col is None else F.col(stands_col).cast("double")).alias("stands")).where("label in (0, 1)")
    rows = _shared.settle(rows, "labelled")
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1:
        return Model()
    take1 = min(n1, max(FIT_ROWS // 2, FIT_ROWS - n0))
    share1, share0 = take1 / n1, min(1, (FIT_ROWS - take1) / max(n0, 1))
    sample = rows.where(F.col("h") < F.when(F.col("label") == 1, int(share1 * (1 << 30))).otherwise(int(share0 * (1 << 30))))
    sample = _shared.settle(sample.repartition(max(1, min(SHARDS, min(n1 + n0, FIT_ROWS) // SHARD_ROWS)), "h").sortWithinPartitions("h", "label").select("label", "text", "stands"), "toxic-sample")

    def frequencies(batches):
        """Of each unit, how many toxic and clean documents have it."""
        held: list = []

        def added():
            unit, at = np.unique(np.concatenate([u for u, _ in held]), return_inverse=True)
            sums = [np.bincount(at, np.concatenate([n[k] for _, n in held]), len(unit)).astype(np.int64) for k in (0, 1)]
            return unit, sums

        for batch in batches:
            _, _, _, units, at = words(batch.column(1))
            doc = np.repeat(np.arange(len(batch)), np.diff(at))
            for k in range(units.shape[1]):
                here = units[:, k] > 0
                pairs = np.unique(np.stack([units[here, k], doc[here].astype(np.uint64)], axis=1), axis=0)
                is_toxic = batch.column(0).to_numpy()[pairs[:, 1].astype(np.int64)] == 1
                held.append((pairs[:, 0], (is_toxic, ~is_toxic)))
            if sum(len(u) for u, _ in held) > HELD:
                held = [added()]
                if len(held[0][0]) > HELD // 2:
                    yield from table(held.pop())
        if held:
            yield from table(added())

    def table(counted):
        unit, (toxic, clean) = counted
        for i in range(0, len(unit), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[i : i + 50_000].view(np.int64)) for x in (unit, toxic, clean)], names=["unit", "toxic", "clean"])

    frequent = rows.select("label", "text").mapInArrow(frequencies, "unit long, toxic long, clean long").groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    likely = frequent.where((F.col("toxic") + 0.5) / (n1 + 1) >= LEAST_ODDS * (F.col("clean") + 0.5) / (n0 + 1)).select("unit")
    likely = _shared.settle(likely, "likely-units")
    member = F.pmod(F.col("unit"), F.lit(MEMBERS))
    bits = np.zeros(MEMBERS // 64, np.uint64)
    # at most MEMBERS / 64 rows, whatever the number of units
    for r in likely.groupBy(F.shiftright(member, 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(unit, 64) as int))")).alias("b")).toArrow().to_batches():
        bits[r.column(0).to_numpy()] = r.column(1).to_numpy().view(np.uint64)
    members = spark.sparkContext.broadcast(bits)

    def contexts(batches):
        """Distinct (unit, word before) of a batch, of units that may be likely ones."""
        for batch in batches:
            _, _, _, units, at = words(batch.column(1))
            if not len(units):
                continue
            before = np.concatenate([[np.uint64(0)], units[:-1, 0]])
            before[at[:-1][np.diff(at) > 0]] = 0
            spot = units % np.uint64(MEMBERS)
            may = (members.value[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
            for k in range(units.shape[1]):
                here = (units[:, k] > 0) & may[:, k]
                pairs = np.unique(np.stack([units[here, k], before[here]], axis=1), axis=0)
                if len(pairs):
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, i]).view(np.int64)) for i in (0, 1)], names=["unit", "before"])

    enough = max(3, min(MIN_CONTEXTS, round(MIN_SHARE * n1)))
    paired = lambda label: rows.where(F.col("label") == label).select("label", "text").mapInArrow(contexts, "unit long, before long").join(likely, "unit", "left_semi")
    toxic = paired(1).distinct().groupBy("unit").agg(F.count("*").alias("toxic"))
    toxic = _shared.settle(toxic.where(F.col("toxic") >= enough), "toxic-units")
    # clean contexts only of units that can be picked
    clean = paired(0).join(toxic.select("unit"), "unit", "left_semi")
    clean = clean.distinct().groupBy("unit").agg(F.count("*").alias("clean"))
    counts = toxic.join(clean, "unit", "left").withColumn("clean", F.coalesce("clean", F.lit(0)))
    picked = counts.where((F.col("toxic") + 0.5) / (n1 + 1) >= MIN_ODDS * (F.col("clean") + 0.5) / (n0 + 1)).orderBy(F.desc("toxic"), "unit").limit(MAX_UNITS).select("unit").toArrow()
    toxic_units = picked["unit"].to_numpy().view(np.uint64)
    _shared.unsettle(likely, toxic, rows)

    def train(batches):
        parts = []
        for batch in batches:
            _, _, _, units, at = words(batch.column(1))
            parts.append((batch.column(0).to_numpy(), units, at))
        if parts:
            model = _train(parts, toxic_units)
            at = np.flatnonzero(model.weights)
            extra = [1.0, model.bias, *model.moves.reshape(-1)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([at, -1 - np.arange(len(extra))])), pa.array(np.concatenate([model.weights[at], extra]))], names=["number", "value"])

    total = sample.mapInArrow(train, "number long, value double").groupBy("number").agg(F.sum("value").alias("value")).toArrow()
    number, value = total["number"].to_numpy(), total["value"].to_numpy()
    extra = [value[number == -1 - k][0] for k in range(6)]
    weights = np.zeros(SIZE)
    weights[number[number >= 0]] = value[number >= 0] / extra[0]
    model = Model(weights, extra[1] / extra[0], np.array(extra[2:]).reshape(2, 2) / extra[0])
    # evidence and label of at most FIT_ROWS rows
    seen = tag(sample, model).select("evidence", "label", "stands").toArrow()
    label = seen["label"].to_numpy()
    stands = seen["stands"].to_numpy() * np.where(label == 1, 1 / share1, 1 / max(share0, 1e-9))
    _logistic(model, seen["evidence"].to_numpy(), label, stands * len(label) / max(stands.sum(), 1e-9))
    return model


def _logistic(model: Model, evidence: np.ndarray, label: np.ndarray, weight: np.ndarray) -> None:
    """Slope and intercept by Newton steps with a weak pull to the starting values."""
    x = np.stack([np.log1p(evidence), np.ones(len(evidence))], axis=1)
    prior = np.array([model.slope, model.intercept])
    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        grad = x.T @ (weight * (label - p)) - 0.05 * (w - prior)
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(2)
        w = w + np.clip(np.linalg.solve(hess, grad), -2, 2)
    model.slope, model.intercept = float(w[0]), float(w[1])


def tag(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with score (0 to 1), evidence and toxic_spans (start and end in characters, end exclusive) added; columns of
    these names are replaced."""
    spark = docs.sparkSession
    _shared.tune(spark)
    shared = spark.sparkContext.broadcast(model)  # SIZE weights
    added = ["score", "evidence", "toxic_spans"]
    docs = docs.drop(*added)
    place = docs.columns.index(text_col)
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def task(batches):
        model = shared.value
        for batch in batches:
            texts = batch.column(place)
            offsets, start, end, units, at = words(texts)
            p = marginals(model, *_features(units, at))
            hot = np.flatnonzero(p > 0.5)
            doc = np.searchsorted(at, hot, side="right") - 1
            evidence = np.bincount(doc, p[hot], len(batch)).astype(float)
            score = 1 / (1 + np.exp(-np.clip(model.slope * np.log1p(evidence) + model.intercept, -35, 35)))
            spans: list[list] = [[] for _ in range(len(batch))]
            for d in np.unique(doc).tolist():
                raw = texts[d].as_py().encode()
                own = hot[doc == d]
                cut = np.flatnonzero(np.diff(own) > 1)
                for i, j in zip(own[np.concatenate([[0], cut + 1])], own[np.concatenate([cut, [len(own) - 1]])]):
                    a, b = int(start[i] - offsets[d]), int(end[j] - offsets[d])
                    a_chars = len(raw[:a].decode())
                    spans[d].append({"start": a_chars, "end": a_chars + len(raw[a:b].decode())})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array(evidence), pa.array(spans, spans_type)], names=[*batch.schema.names, *added])

    schema = T.StructType([*docs.schema.fields]).add("score", "double").add("evidence", "double").add("toxic_spans", T.ArrayType(T.StructType().add("start", "long").add("end", "long")))
    return docs.mapInArrow(task, schema)
