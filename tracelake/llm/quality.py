"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

Tokens are runs of letters and digits (case kept) and runs of other printing characters; features are the hashes of unigrams and
bigrams modulo ``SIZE``, with one feature for a token that follows itself. A document's values are log(1 + count), scaled to length 1.
Training deals a bounded sample of labelled rows (at most about ``FIT_ROWS``) over at most ``SHARDS`` tasks; each runs the per-coordinate
updates ``PASSES`` times over its rows, and Spark averages the weights. A score is a sparse dot product with the broadcast weights
(``SIZE`` doubles, a fixed size) through the logistic function.

Null and empty texts have no features: their score is that of the bias alone. Rows with equal texts get equal scores; without labelled
rows every score is 0.5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.llm import _shared, _text

SIZE = 1 << 18
FIT_ROWS = 12_000
#: Tasks that train side by side, and the rows that make one worthwhile.
SHARDS, SHARD_ROWS = 4, 1_000
PASSES = 8
ALPHA, BETA, L1, L2 = 3.0, 1.0, 0.005, 0.0

_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x41:0x5B] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_SIGN = np.zeros(256, bool)
_SIGN[0x21:0x7F] = True
_SIGN &= ~_WORD


def features(texts: pa.Array):
    """For each text its feature numbers and values, as (numbers, values, first entry of each text)."""
    data, offsets = _text.pack(texts)
    ws, we, wh, _ = _text.words(data, offsets, _WORD)
    ss, se, sh, _ = _text.words(data, offsets, _SIGN)
    start = np.concatenate([ws, ss])
    order = np.argsort(start, kind="stable")
    start = start[order]
    h = np.concatenate([wh, sh])[order]
    doc = np.searchsorted(offsets, start, side="right") - 1
    one = h % np.uint64(SIZE - 2) + np.uint64(1)
    pair = np.where(h[1:] == h[:-1], np.uint64(SIZE - 1), _text.grams(h, 2) % np.uint64(SIZE - 2) + np.uint64(1))
    same = doc[1:] == doc[:-1]
    key = np.concatenate([doc.astype(np.uint64) * np.uint64(SIZE) + one, doc[1:][same].astype(np.uint64) * np.uint64(SIZE) + pair[same]])
    key, count = np.unique(key, return_counts=True)
    doc, number = (key // np.uint64(SIZE)).astype(np.int64), (key % np.uint64(SIZE)).astype(np.int64)
    value = np.log1p(count)
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    length = np.sqrt(np.bincount(doc, value * value, len(texts)))
    return number, value / np.where(length, length, 1)[doc], first


class Learner:
    """Follow-the-regularised-leader state: z and n for each weight; weight 0 is the bias."""

    def __init__(self):
        self.z, self.n = np.zeros(SIZE), np.zeros(SIZE)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def update(self, numbers: np.ndarray, values: np.ndarray, label: int) -> None:
        numbers, values = np.append(numbers, 0), np.append(values, 1.0)
        w = self.weights(numbers)
        p = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
        g = (p - label) * values
        sigma = (np.sqrt(self.n[numbers] + g * g) - np.sqrt(self.n[numbers])) / ALPHA
        self.z[numbers] += g - sigma * w
        self.n[numbers] += g * g


def fit(labelled: DataFrame, label_col: str, text_col: str = "text", id_col: str = "doc_id") -> np.ndarray:
    """Weights from rows with a label 0 or 1; rows with other labels or none are left out."""
    spark = labelled.sparkSession
    _shared.tune(spark)
    rows = labelled.select(F.col(label_col).cast("int").alias("label"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30)).alias("h")).where("label in (0, 1)")
    n = rows.count()
    rows = rows.where(F.col("h") < int(min(1, FIT_ROWS / max(n, 1)) * (1 << 30)))
    shards = max(1, min(SHARDS, min(n, FIT_ROWS) // SHARD_ROWS))

    def train(batches):
        learner, seen = Learner(), []
        for batch in batches:
            number, value, first = features(batch.column(1))
            for i, label in enumerate(batch.column(0).to_pylist()):
                seen.append((number[first[i] : first[i + 1]].astype(np.int32), value[first[i] : first[i + 1]].astype(np.float32), label))
        if not seen:
            return
        order = np.random.default_rng(7)
        for _ in range(PASSES):
            for i in order.permutation(len(seen)):
                learner.update(*seen[i])
        w = learner.weights()
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(w[at], 1.0))], names=["number", "weight"])

    # sorted within a shard: the result does not depend on the order in which rows arrive
    dealt = rows.repartition(shards, "h").sortWithinPartitions("h", "label").select("label", "text")
    total = dealt.mapInArrow(train, "number long, weight double").groupBy("number").agg(F.sum("weight").alias("weight")).toArrow()
    weights = np.zeros(SIZE)
    number, weight = total["number"].to_numpy(), total["weight"].to_numpy()
    if len(number):
        trained = weight[number == -1][0]
        weights[number[number >= 0]] = weight[number >= 0] / trained
    return weights


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the column score (0 to 1) added; a column of this name is replaced."""
    spark = docs.sparkSession
    _shared.tune(spark)
    shared = spark.sparkContext.broadcast(weights)  # SIZE doubles
    docs = docs.drop("score")
    place = docs.columns.index(text_col)

    def task(batches):
        w = shared.value
        for batch in batches:
            number, value, first = features(batch.column(place))
            logit = w[0] + np.bincount(np.repeat(np.arange(len(batch)), np.diff(first)), w[number] * value, len(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(logit, -35, 35))))], names=[*batch.schema.names, "score"])

    return docs.mapInArrow(task, T.StructType([*docs.schema.fields]).add("score", "double"))
