"""How the rows of a crowd in large nodes grow and shrink from level to level of the chosen-path trees, without Spark."""

import numpy as np
import pytest

from tracelake.llm import _text, neardup


def crowd_signatures(n, own, words=200, seed=1):
    """Signatures of sets that share all but ``own`` of their elements: two have a similarity of (words - own) / (words + own)."""
    rng = np.random.default_rng(seed)
    lowest = lambda e: np.stack([(_text.mix(e * a) >> np.uint64(32)).min(axis=-1) for a in neardup._A], axis=-1)
    core = lowest(rng.integers(1, 2**63, words - own, dtype=np.uint64))
    return np.minimum(core, lowest(rng.integers(1, 2**63, (n, own), dtype=np.uint64))).astype(np.uint32)


def rows_by_level(sig, small):
    """Rows in nodes of more than ``small`` classes, all of which branch on."""
    n, roots = len(sig), neardup.roots_for(neardup.RECALL, neardup.PERCENT)
    node = np.concatenate([_text.mix(np.full(n, 1000 + k, np.uint64) * _text.PLACES[1] + sig[:, k].astype(np.uint64) * _text.PLACES[2]) for k in range(roots)])
    used, who, out = np.repeat(np.uint64(1) << np.arange(roots, dtype=np.uint64), n), np.tile(np.arange(n), roots), []
    while True:
        _, at, count = np.unique(node, return_inverse=True, return_counts=True)
        large = count[at] > small
        node, used, who = node[large], used[large], who[large]
        if not len(node):
            return out
        out.append(len(node))
        parts = [(child, path, who[rows]) for rows, child, path in neardup._children(node, used, sig[who], neardup.PERCENT)]
        node, used, who = (np.concatenate(x) for x in zip(*parts))


@pytest.mark.parametrize("n, own, growth, levels", [(600, 50, 1.5, 18), (1_200, 50, 1.5, 20), (600, 31, 4, 24), (1_200, 31, 7, 30)])
def test_crowds_die_out(n, own, growth, levels):
    """Crowds of 0.6 hardly grow. Those of 0.73, just below the threshold, grow for some levels (a class leaves the crowd's node with less
    probability than 1 - 1 / branching), then die out, too, as nodes get small: long before tokens end."""
    rows = rows_by_level(crowd_signatures(n, own), 64)
    assert max(rows) <= growth * rows[0] and len(rows) <= levels < neardup.TOKENS
