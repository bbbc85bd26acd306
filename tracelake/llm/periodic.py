"""Runs of repeated word sequences inside documents, and the texts without the repeats.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that no neighbouring word extends. They are
found while a suffix automaton takes one word after the other: its states, by their suffix links, form a tree, and each state has the
place where one of its words ended last. A new word gives its own place to all states on the way from its state to the root. That way is a
few *segments* of states with one earlier place each (the preferred paths of a link-cut tree, which ``access`` joins and recolours). A
segment whose words have lengths lo+1 to hi and ended last d words before, lo < d <= hi, says that the last 2 d words are a square with
smallest period d; and each such square is told by some segment. Squares of one period at consecutive ends are one run.

Only stretches of words that may lie in a run are read in this way: each 5-gram of a run with at least four periods comes again within a
quarter of the stretch's length, so stretches of other 5-grams are left out beforehand, which loses none (``stretches``).

A text is read whole in one task. Null texts have no words; the rows of one document are a document each; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm import _shared

#: Periods and words that a run has at least.
PERIODS, WORDS = 4, 6
#: Words of the sequences that have to come again inside a run.
GRAM = 5
#: Rounds of ``stretches``; more would only shorten what is read.
ROUNDS = 8
_FACTORS = np.random.default_rng(13).integers(1, 2**63, GRAM, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def squares(word: list[int]) -> list[tuple[int, int]]:
    """(end, period) of every square whose period is its smallest, in order of their ends."""
    size = 2 * len(word) + 3
    # the automaton; state 1 is the empty word, 0 stands for none
    follow: list[dict[int, int]] = [{}, {}]
    link, longest = [0] * size, [0] * size
    # the link-cut tree over suffix links: splay trees by depth, ``up`` is the parent there or, at a splay tree's root, the tree's parent
    # above the path; ``place`` holds for the whole path and is kept at its splay tree's root
    left, right, up, place = [0] * size, [0] * size, [0] * size, [-1 << 40] * size

    def splay(x: int) -> None:
        while (p := up[x]) and (left[p] == x or right[p] == x):
            g = up[p]
            if not g or (left[g] != p and right[g] != p):
                turn(x, p)
            elif (left[g] == p) == (left[p] == x):
                turn(p, g)
                turn(x, p)
            else:
                turn(x, p)
                turn(x, g)

    def turn(x: int, p: int) -> None:
        """Rotate x over its parent p; the path's place goes up with it."""
        g = up[p]
        if left[p] == x:
            b = right[x]
            left[p], right[x] = b, p
        else:
            b = left[x]
            right[p], left[x] = b, p
        if b:
            up[b] = p
        up[p], up[x] = x, g
        if g:
            if left[g] == p:
                left[g] = x
                return
            if right[g] == p:
                right[g] = x
                return
        place[x] = place[p]

    out = []
    last, states = 1, 2
    for i, c in enumerate(word):
        new = states
        states += 1
        follow.append({})
        longest[new] = longest[last] + 1
        p = last
        while p and c not in follow[p]:
            follow[p][c] = new
            p = link[p]
        if not p:
            above = 1
        else:
            q = follow[p][c]
            if longest[q] == longest[p] + 1:
                above = q
            else:
                # the shorter words of q get a state of their own, just above q and with q's place
                above = states
                states += 1
                follow.append(follow[q].copy())
                longest[above], link[above] = longest[p] + 1, link[q]
                while p and follow[p].get(c) == q:
                    follow[p][c] = above
                    p = link[p]
                link[q] = above
                splay(q)
                shallower = left[q]
                left[above], left[q], up[above] = shallower, above, q
                if shallower:
                    up[shallower] = above
        link[new] = above
        # access: join the segments on the way to the root, cut off what is deeper, and read each segment's place
        up[new], below, x = above, new, above
        while x:
            splay(x)
            before, deeper = place[x], right[x]
            if deeper:
                place[deeper] = before
            right[x] = below
            further = up[x]
            d = i - before
            if d <= longest[x] and (not further or d > longest[further]):
                out.append((i, d))
            below, x = x, further
        splay(new)
        place[new] = i
        last = new
    return out


def runs(word: list[int], periods: int = PERIODS, words: int = WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs with at least so many periods (two or more) and words, by start, then period."""
    begun: dict[int, list[int]] = {}
    found = []

    def close(d: int, first: int, end: int) -> None:
        length = end - first + 2 * d
        if length >= max(words, periods * d):
            found.append((first - 2 * d + 1, length, d))

    for i, d in squares(word):
        open_run = begun.get(d)
        if open_run is not None and open_run[1] == i - 1:
            open_run[1] = i
        else:
            if open_run is not None:
                close(d, *open_run)
            begun[d] = [i, i]
    for d, (first, end) in begun.items():
        close(d, first, end)
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(ids: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of words that have all runs of ``PERIODS`` periods and ``WORDS`` words in them, each run whole in one range."""
    n = len(ids) - GRAM + 1
    if n < WORDS - GRAM + 1:
        return []
    h = np.zeros(n, np.uint64)
    for k in range(GRAM):
        h += ids[k : k + n].astype(np.uint64) * _FACTORS[k]
    h ^= h >> np.uint64(32)
    order = np.argsort(h, kind="stable")
    again = h[order[1:]] == h[order[:-1]]
    if not again.any():
        return []
    gap = np.where(again, order[1:] - order[:-1], n)
    near = np.full(n, n)
    near[order[1:]] = gap
    near[order[:-1]] = np.minimum(near[order[:-1]], gap)
    marked = near < n
    for _ in range(ROUNDS):
        first, behind = _ranges(marked)
        most = np.maximum(behind - first + GRAM - 1, 0)  # words of each range
        most = np.where(most >= WORDS, most // PERIODS, 0)
        stay = marked.copy()
        stay[marked] = near[marked] <= np.repeat(most, behind - first)
        if (stay == marked).all():
            break
        marked = stay
    first, behind = _ranges(marked)
    return [(a, b + GRAM - 1) for a, b in zip(first.tolist(), behind.tolist()) if b - a + GRAM - 1 >= WORDS]


def _ranges(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where stretches of marked places begin, and where they are over."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marked.view(np.int8), [0]])))
    return edges[::2], edges[1::2]


def word_runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """The runs of a document's words."""
    if len(words) < WORDS:
        return []
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    if len(number) == len(words):
        return []
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    found = []
    for a, b in stretches(ids):
        found += [(a + s, length, q) for s, length, q in runs(ids[a:b].tolist())]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that stand in a run after its first period."""
    if not found:
        return words
    keep = np.ones(len(words), bool)
    for start, length, q in found:
        keep[start + q : start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def grown(words: list[bytes], h: int) -> list[bytes]:
    """What the query's contract makes of a document's words: those of a tenth of the documents repeat from some word on."""
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    once = words[a : a + p]
    return words[:a] + (once * (-(-(n - a) // p)))[: n - a]


def longest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    return min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None


def _mapped(docs: DataFrame, id_col: str, text_col: str, schema: str, kinds: list[pa.DataType], one) -> DataFrame:
    """``one(doc_id, text)`` for each document, as rows of ``schema``."""
    _shared.tune(docs.sparkSession)
    chosen = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).cast("string").alias("t"))
    names = [c.split()[0] for c in re.sub("<.*>", "", schema).split(", ")]

    def task(batches):
        for batch in batches:
            if len(batch):
                rows = [one(k, t) for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return chosen.mapInArrow(task, schema)


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, text without the words that stand in a run after its first period (its words joined by one space where any goes;
    other texts, null ones too, stay as they are), and runs (start, length, period) by start and period."""
    parts = ("start", "length", "period")

    def one(k, text):
        words = (text or "").encode().split()
        found = word_runs(words)
        return k, b" ".join(collapse(words, found)).decode() if found else text, [dict(zip(parts, r)) for r in found]

    kinds = [pa.int64(), pa.string(), pa.list_(pa.struct([(c, pa.int64()) for c in parts]))]
    return _mapped(docs, id_col, text_col, "doc_id long, text string, runs array<struct<start: long, length: long, period: long>>", kinds, one)


def run_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The digest columns of the query's contract, over the words that ``grown`` gives each document; null ids count as the text 'null'."""

    def one(k, text):
        words = grown((text or "").encode().split(), zlib.crc32(b"null" if k is None else str(k).encode()))
        found = word_runs(words)
        best = longest(found)
        top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        told = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        return k, len(found), *top, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(b" ".join(collapse(words, found))).hexdigest()

    schema = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return _mapped(docs, id_col, text_col, schema, [pa.int64()] * 6 + [pa.string()] * 2, one)
