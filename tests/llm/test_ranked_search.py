"""Ranked search against scoring every document in plain Python."""

from __future__ import annotations

import collections
import math
import random
import re

import numpy as np
import pytest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k):
    bags = [(i, terms(t)) for i, t in docs]
    n_docs, total = sum(bool(w) for _, w in bags), sum(len(w) for _, w in bags)
    df = collections.Counter(t for _, w in bags for t in set(w))
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * c + 1))) for t, c in df.items()}
    out = []
    for item_id, text in dict.fromkeys(items):
        scores = []
        for doc_id, w in bags:
            tf, m = collections.Counter(w), 75 + 25 * len(w) * n_docs // max(total, 1)
            score = sum(weight[t] * (10**9 * tf[t] // (1000 * tf[t] + 12 * m)) for t in terms(text) if tf[t])
            if score:
                scores.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, r, None if null else doc_id, -s) for r, (s, null, doc_id) in enumerate(sorted(scores)[:k], 1)]
    return collections.Counter(out)


@pytest.mark.parametrize("k", [1, 20, 500])
def test_against_plain(spark, docs, rows, k):
    from leadspark.llm.ranked_search import search

    items = [(1, "w1 W2, w3 w3 w3 é"), (2, rows[2][1][:300]), (2, "another text of w7"), (3, None), (4, "***"), (5, "nowhere"), (6, rows[6][1]), (6, rows[6][1]), (None, "the of"), (7, rows[60][1])]
    got = search(docs, spark.createDataFrame(items, "item_id long, text string"), k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert collections.Counter(tuple(r) for r in got.collect()) == plain([(r[0], r[1]) for r in rows], items, k)


def test_empty_tables(spark, docs, none):
    from leadspark.llm.ranked_search import search

    items = spark.createDataFrame([(1, "w1")], "item_id long, text string")
    assert search(none, items).collect() == [] and search(docs, items.limit(0)).collect() == []


@pytest.mark.parametrize("blocks, chunk, seeds", [(64, 16, 2), (1 << 20, 4096, 1)])
def test_blocks_chunks_and_seeds(spark, docs, rows, monkeypatch, blocks, chunk, seeds):
    """Results don't depend on how items and documents are dealt, nor on which documents give the first bounds."""
    from leadspark.llm import ranked_search

    for name, value in (("BLOCK_BYTES", blocks), ("CHUNK_DOCS", chunk), ("SEED_SHARE", seeds)):
        monkeypatch.setattr(ranked_search, name, value)
    items = [(i, r[1]) for i, r in enumerate(rows[:8])]
    got = ranked_search.search(docs, spark.createDataFrame(items, "item_id long, text string"), 3)
    assert collections.Counter(tuple(r) for r in got.collect()) == plain([(r[0], r[1]) for r in rows], items, 3)


def test_balls_hold_and_prune():
    """No document scores above a ball's bound, and far balls are not scored."""
    from leadspark.llm.ranked_search import Chunk, _ball, search_chunk

    rng = np.random.default_rng(4)
    # Eight kinds of documents with terms of their own, and common terms.
    sets = [np.unique(np.concatenate((rng.integers(50 * (i % 8), 50 * (i % 8) + 50, 30), rng.integers(400, 410, 3)))) for i in range(800)]
    begins = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    chunk = Chunk(np.arange(800), begins, np.concatenate(sets).astype(np.int32), rng.integers(1, 1_000_000, begins[-1]))
    weights = np.where(np.arange(410) < 400, rng.integers(3_000, 9_000, 410), rng.integers(0, 20, 410))
    items = np.zeros((16, 410), np.int64)
    for i in range(16):
        items[i, rng.integers(50 * (i % 8), 50 * (i % 8) + 50, 20)] = rng.integers(1, 4)
        items[i, rng.integers(400, 410, 5)] = 1
    exact = np.array([[int((items[i, s] * weights[s] * chunk.value[a:b]).sum()) for s, a, b in zip(sets, begins[:-1], begins[1:], strict=True)] for i in range(16)])
    root = np.sqrt(weights)
    x = chunk.value * root[chunk.term]
    stack = [_ball(chunk, x, np.add.reduceat(x * x, begins[:-1]), np.arange(800), (items * root).T, 32)]
    while stack:
        ball = stack.pop()
        assert (exact[:, ball.docs].max(axis=1) <= ball.bounds).all()
        stack += ball.parts
    item, doc, score, scored = search_chunk(chunk, items, weights, np.zeros(16, np.int64), 5, 32)
    for i in range(16):
        expected = sorted(((-int(s), d) for d, s in enumerate(exact[i]) if s > 0))[:5]
        assert [(-int(s), int(d)) for s, d in zip(score[item == i], doc[item == i], strict=True)] == expected
    assert scored < 16 * 800 / 3


def test_long_corpora_keep_whole_numbers():
    from leadspark.llm.ranked_search import parts_of_score

    n = np.array([10**9, 7], np.int64)
    counts = np.array([3, 1], np.int64)
    m = [75 + 25 * int(x) * 10**12 // 10**14 for x in n]
    assert parts_of_score(n, counts, 10**12, 10**14).tolist() == [10**9 * int(c) // (1000 * int(c) + 12 * x) for c, x in zip(counts, m, strict=True)]
