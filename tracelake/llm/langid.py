"""Language identification with language-bitmask n-gram filters.

One Bloom filter serves all languages: each of its positions holds a mask with one bit per language (the filter is sliced by bit, in
words of 64 languages), so
reading the ``HASHES`` positions of an n-gram and and-ing their masks gives every language that contains it. A text's count for a
language is the number of its n-grams with that bit; from the share of n-grams the language's false-positive rate (its share of set
bits to the power of ``HASHES``) is taken out, and the largest corrected share decides (ties: the earlier language in order).

A language contains an n-gram that makes up at least ``MIN_RATE`` of the language's n-grams, so at most 1 / MIN_RATE n-grams a language
enter the filter, whatever the corpus; the filter has a fixed number of positions. It is fitted on at most about ``FIT_ROWS``
labelled documents a language (those with the smallest hashes of ``doc_id``) - the counts are partial sums in tasks, added up by Spark.

n-grams are runs of ``SIZES`` characters of the lower-cased text in which every run of non-letters is one space. Null texts and texts
without letters get ``und`` and score 0; so does every text if there is nothing to learn from. Equal rows get equal results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.llm import _shared, _text

SIZES = (2, 3, 4)
MIN_RATE = 2e-5
POSITIONS = 1 << 21
HASHES = 4
FIT_ROWS = 4_000
#: Languages in one mask.
WORD = 64
#: Code points handled at once.
WINDOW = 1 << 20

_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """For each code point, whether it is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def _normal(text: str) -> np.ndarray:
    """Code points of the text as n-grams see it, with a space at either end; empty if the text has no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _is_letter()[codes]
    if not letter.any():
        return np.zeros(0, np.uint32)
    codes = np.where(letter, codes, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one space after each run of letters
    codes = codes[keep]
    pad = np.array([32], np.uint32)
    return np.concatenate([pad, codes] if codes[-1] == 32 else [pad, codes, pad])


def _grams(codes: np.ndarray, n: int) -> np.ndarray:
    h = np.zeros(max(0, len(codes) - n + 1), np.uint64)
    for k in range(n):
        h += (codes[k : len(h) + k].astype(np.uint64) + np.uint64(1)) * _text.PLACES[8 * n + k]
    return _text.mix(h)


def _count(docs: DataFrame) -> DataFrame:
    """lang, gram (hash), n over all texts."""

    def task(batches):
        for batch in batches:
            texts: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if len(codes := _normal(text)):
                    texts.setdefault(lang, []).append(codes)
            for lang, parts in texts.items():
                grams = [np.concatenate([_grams(c, n) for c in parts]) for n in SIZES]
                gram, n = np.unique(np.concatenate(grams), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    return docs.mapInArrow(task, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Filter:
    """The fitted filter: languages in order, the masks of its positions (an array for each 64 languages), each language's false-positive
    rate."""

    def __init__(self, langs: list[str], masks: list[np.ndarray]):
        self.langs = langs
        self.masks = [m.astype(np.uint8) if len(langs) <= 8 else m for m in masks]
        bits = [np.count_nonzero(masks[i // WORD] >> np.uint64(i % WORD) & np.uint64(1)) for i in range(len(langs))]
        self.false_rate = (np.array(bits, float) / POSITIONS) ** HASHES

    def lookup(self, grams: np.ndarray) -> list[np.ndarray]:
        first, *others = _places(grams)
        out = []
        for masks in self.masks:
            mask = masks[first]
            for place in others:
                mask &= masks[place]
            out.append(mask)
        return out

    def shares(self, text: str | None) -> np.ndarray | None:
        """Each language's corrected share of the text's n-grams; none if the text has no letter."""
        codes = _normal(text) if text else np.zeros(0, np.uint32)
        if not len(codes) or not self.langs:
            return None
        hits, total = np.zeros(len(self.langs), np.int64), 0
        for at in range(0, len(codes), WINDOW):
            for n in SIZES:
                grams = _grams(codes[at : at + WINDOW + n - 1], n)
                total += len(grams)
                for i, mask in enumerate(self.lookup(grams)):
                    own = hits[i * WORD : (i + 1) * WORD]
                    if mask.dtype == np.uint8:
                        own += np.bincount(mask, minlength=256) @ _BITS[:, : len(own)]
                    else:
                        own += [np.count_nonzero(mask >> np.uint64(k) & np.uint64(1)) for k in range(len(own))]
        return np.clip((hits / max(total, 1) - self.false_rate) / (1 - self.false_rate), 0, None)


#: The bits of each 8-bit mask.
_BITS = np.arange(256)[:, None] >> np.arange(8) & 1


def _places(grams: np.ndarray) -> list[np.ndarray]:
    """Positions of each n-gram, by double hashing."""
    a, b = grams >> np.uint64(32), grams | np.uint64(1)
    return [((a + np.uint64(k) * b) & np.uint64(POSITIONS - 1)).astype(np.int64) for k in range(HASHES)]


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Filter:
    """Learn the filter from rows with text and language: every language that has one."""
    spark = labelled.sparkSession
    _shared.tune(spark)
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30)).alias("h")).where("lang is not null and text is not null")
    langs = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not langs:
        return Filter([], [np.zeros(POSITIONS, np.uint64)])
    order = sorted(langs)
    signed = [(1 << i) - (1 << 64 if i == 63 else 0) for i in range(WORD)]
    # one row a language
    known = F.broadcast(spark.createDataFrame([(k, int(min(1, FIT_ROWS / langs[k]) * (1 << 30)), i // WORD, signed[i % WORD]) for i, k in enumerate(order)], "lang string, share long, word int, bit long"))
    counts = _shared.settle(_count(rows.join(known, "lang").where(F.col("h") < F.col("share")).select("lang", "text")), "langid-counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    kept = counts.join(F.broadcast(totals), "lang").where(F.col("n") >= F.greatest(F.lit(2), F.col("total") * MIN_RATE))
    grams = kept.join(known, "lang").groupBy("gram", "word").agg(F.bit_or("bit").alias("mask"))

    def place(batches):
        for batch in batches:
            grams, word, mask = batch.column(0).to_numpy().view(np.uint64), batch.column(1), batch.column(2)
            for p in _places(grams):
                yield pa.RecordBatch.from_arrays([pa.array(p), word, mask], names=["position", "word", "mask"])

    sliced = grams.mapInArrow(place, "position long, word int, mask long").groupBy("position", "word").agg(F.bit_or("mask").alias("mask"))
    words = -(-len(order) // WORD)
    sliced = _shared.settle(sliced, "langid-masks") if words > 1 else sliced
    masks = []
    for w in range(words):
        # at most POSITIONS rows of 16 bytes reach the driver at once
        part = sliced.where(F.col("word") == w).select("position", "mask").toArrow()
        masks.append(np.zeros(POSITIONS, np.uint64))
        masks[w][part["position"].to_numpy()] = part["mask"].to_numpy().view(np.uint64)
    return Filter(order, masks)


def predict(docs: DataFrame, fitted: Filter, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with lang_pred, score (the share of the winner among all languages' corrected shares, 0 to 1) and
    hit_rate (the winner's corrected share itself) added; columns of these names are replaced."""
    spark = docs.sparkSession
    _shared.tune(spark)
    shared = spark.sparkContext.broadcast(fitted)  # POSITIONS masks: a fixed size for each 64 languages
    added = ["lang_pred", "score", "hit_rate"]
    docs = docs.drop(*added)
    place = docs.columns.index(text_col)

    def task(batches):
        model = shared.value
        for batch in batches:
            lang, score, rate = [], [], []
            for text in batch.column(place).to_pylist():
                share = model.shares(text)
                best = None if share is None else int(share.argmax())
                sure = share is not None and share[best] > 0
                lang.append("und" if best is None else model.langs[best])
                score.append(float(share[best] / share.sum()) if sure else 0.0)
                rate.append(float(min(share[best], 1.0)) if sure else 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rate, pa.float64())], names=[*batch.schema.names, *added])

    schema = T.StructType([*docs.schema.fields]).add("lang_pred", "string").add("score", "double").add("hit_rate", "double")
    return docs.mapInArrow(task, schema)
