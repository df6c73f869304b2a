"""Exact deduplication against grouping by the normalised text."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import pytest

SCHEMA = "doc_id long, text string, kept string, sha long"


def plain(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in rows]
    ids = collections.defaultdict(list)
    for r, t in zip(rows, norm, strict=True):
        ids[t].append(r[0])
    out, seen = [], set()
    for r, t in zip(rows, norm, strict=True):
        known = [i for i in ids[t] if i is not None]
        first = min(known) if known else None
        stays = r[0] == first and t not in seen
        if stays:
            seen.add(t)
        out.append((r[0], first, len(ids[t]), stays, hashlib.sha256(t.encode()).hexdigest()))
    return collections.Counter(out)


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(8)
    long = " ".join(rng.choice(["a", "é", "word", "\t", "x\ny", "日本"]) for _ in range(9_000))
    texts = ["", None, " ", "\n\t", "a b", "a  b", "a\tb", "b a", " a b", "a b ", "A b", "é", "é", " ", "ab", "ba"]
    texts += [long, long.replace(" ", "\n \t"), long[:-1], long + "x", long[:4096], "x" * 300, "x" * 299 + "y"]
    rows = [(i, t, "k", 1) for i, t in enumerate(texts)] + [(100 + i, t, None, 2) for i, t in enumerate(texts[::2])]
    return [*rows, rows[16], rows[4], (4, "other", "k", 0), (None, "a b", None, None), (None, "alone", None, None), (None, "alone", None, None)]


@pytest.mark.parametrize("chunk_bytes, bits", [(1 << 16, 61), (64, 61), (7, 61), (64, 0), (1 << 16, 1)])
def test_against_plain(spark, odd, chunk_bytes, bits):
    """Chunks of any length and prints of which texts share most give the same rows."""
    from leadspark.llm.exact_dedup import dedup_exact

    got = dedup_exact(spark.createDataFrame(odd, SCHEMA), chunk_bytes, bits)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert collections.Counter(tuple(r) for r in got.collect()) == plain(odd)


def test_empty_table(spark):
    from leadspark.llm.exact_dedup import dedup_exact

    assert dedup_exact(spark.createDataFrame([], SCHEMA)).collect() == []


def test_prints_are_polynomials_and_combine():
    from leadspark.llm.exact_dedup import BASES, PRIME, combined, prints, times

    rng = np.random.default_rng(2)
    a, b = (rng.integers(0, PRIME, 200, dtype=np.uint64) for _ in range(2))
    a[:3], b[:3] = (0, PRIME - 1, PRIME - 1), (5, PRIME - 1, 1)
    assert times(a, b).tolist() == [int(x) * int(y) % PRIME for x, y in zip(a, b, strict=True)]
    data = rng.integers(0, 256, 3_000, dtype=np.uint8)
    for base in BASES:
        whole = sum((int(x) + 1) * pow(base, i, PRIME) for i, x in enumerate(data)) % PRIME
        assert prints(data, np.array([0, 3_000]), base, 3_000).tolist() == [whole]
        cuts = np.array([0, 0, 1, 700, 700, 2_999, 3_000])
        parts = prints(data, cuts, base, 3_000)
        assert combined(list(zip(np.diff(cuts).tolist(), parts.tolist(), strict=True)), base) == whole


def test_false_prints_are_found(spark):
    """With prints of no bits, texts of one length share theirs unless they are equal."""
    from leadspark.llm.exact_dedup import false_prints

    docs = spark.createDataFrame([(1, "aa"), (2, "ab"), (3, "xyz"), (4, "xyz")], "doc_id long, text string")
    assert [tuple(r) for r in false_prints(docs, docs, bits=0).collect()] == [(2, 0, 0)]
    assert false_prints(docs, docs).collect() == []
