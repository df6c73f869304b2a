"""Quality rules under weak supervision.

Each rule looks at one measure of a text and votes bad, votes good, or abstains. No rule decides alone, and none needs
labels: expectation-maximisation estimates from the votes of all texts how often each rule votes how on good and on bad
texts, and the posterior probability of quality follows from a text's votes.

Texts with the same votes count together, so the estimate works on a table of vote patterns, of which there are at most
3 to the number of rules, whatever the corpus; its counts cover all texts. The rates have a prior by which a rule's bad
votes fall on bad texts more often, which keeps the two kinds from changing places. Abstaining tells nothing.

Defined cases: a null text has no words; texts without words fail the base rule. An empty table gives an empty result.
Repeated rows are judged alike. Other columns are kept; those named as a result column are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from leadspark.llm.words import grams, pieces, whole, words_of

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marked", "n_capitals", "n_ended", "n_bare")
RULES = ("symbols", "marks", "dup_lines", "repeats", "length", "word_length", "capitals", "line_ends", "bare_marks")
_RESULT = (*MEASURES, "base_failed", "quality", "kept")


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_SYMBOL, _END = _table("#*$%&|<>"), _table(".!?:;,\"')")
_CAPITAL = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER_START = (np.arange(256) & 0xC0) != 0x80
_NEWLINE = _table("\n")


def _of_runs(flags: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[end] - total[at]


def measures(texts: pa.Array) -> dict[str, np.ndarray]:
    """The measures of each text."""
    w = words_of(texts)
    n, row = w.rows, w.row
    per_row = lambda x=None: np.bincount(row, x, n).astype(np.int64)
    out = {"n_words": per_row(), "word_chars": per_row(_of_runs(_LETTER_START[w.data], w.at, w.end))}
    out["n_symbols"] = _of_runs(_SYMBOL[w.data], w.offsets[:-1], w.offsets[1:])
    # Words with several ASCII marks, and words of nothing else.
    marks = _of_runs((w.data < 128) & ~np.isin(w.data, _ALNUM), w.at, w.end)
    out["n_marked"] = per_row((marks >= 2).astype(float))
    out["n_bare"] = per_row((marks == w.end - w.at).astype(float))
    capitals = _of_runs(_CAPITAL[w.data], w.at, w.end)
    out["n_capitals"] = per_row((capitals >= 2).astype(float))
    # Lines: a text's newlines cut it; only lines with a word count.
    newline = np.flatnonzero(_NEWLINE[w.data])
    cuts = np.unique(np.concatenate((w.offsets[:-1], newline + 1)))
    line = np.searchsorted(cuts, w.at, "right") - 1
    first = np.flatnonzero(np.concatenate(([True], (line[1:] != line[:-1]) | (row[1:] != row[:-1])))) if len(line) else line
    begins = cuts[line[first]]
    stops = np.append(cuts[1:], len(w.data))[line[first]] - np.isin(np.append(cuts[1:], len(w.data))[line[first]] - 1, newline)
    stops = np.minimum(stops, w.offsets[row[first] + 1])
    hashes = _byte_runs(w.data, begins, stops)
    of = row[first]
    out["n_lines"] = np.bincount(of, minlength=n)
    by = np.lexsort((np.arange(len(of)), hashes, of))
    again = np.zeros(len(of), bool)
    again[by[1:]] = (of[by[1:]] == of[by[:-1]]) & (hashes[by[1:]] == hashes[by[:-1]])
    out["n_dup_lines"] = np.bincount(of, again, n).astype(np.int64)
    last = np.append(first[1:], len(row)) - 1 if len(first) else first
    out["n_ended"] = np.bincount(of, _END[w.data[w.end[last] - 1]], n).astype(np.int64) if len(first) else np.zeros(n, np.int64)
    # Words in runs of eight that a text holds more than once.
    at = np.flatnonzero(whole(row, 8))
    runs = grams(w.hash, 8)[at]
    by = np.lexsort((runs, row[at]))
    same = (runs[by[1:]] == runs[by[:-1]]) & (row[at[by[1:]]] == row[at[by[:-1]]])
    twice = np.zeros(len(at), bool)
    twice[by[1:][same]] = True
    twice[by[:-1][same]] = True
    change = np.zeros(len(row) + 9, np.int32)
    np.add.at(change, at[twice], 1)
    np.add.at(change, at[twice] + 8, -1)
    out["n_repeat_words"] = per_row((np.cumsum(change)[: len(row)] > 0).astype(float))
    return out


_ALNUM = np.array([b for b in range(128) if chr(b).isalnum()], np.uint8)
_LINE_BASE = np.uint64(0x9E3779B97F4A7C15)
_LINE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _byte_runs(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each run."""
    if not len(data):
        return np.zeros(len(begins), np.uint64)
    steps = np.full(len(data), _LINE_BASE)
    steps[0] = 1
    up = np.multiply.accumulate(steps)
    steps[1:] = _LINE_INVERSE
    down = np.multiply.accumulate(steps)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93) * up)))
    return (total[ends] - total[begins]) * down[np.minimum(begins, len(data) - 1)] + (ends - begins).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)


def _votes() -> list[Column]:
    """1 good, -1 bad, 0 abstains; one for each rule."""
    c = F.col
    words, lines = F.greatest(c("n_words"), F.lit(1)), F.greatest(c("n_lines"), F.lit(1))
    vote = lambda bad, good: F.when(bad, -1).when(good, 1).otherwise(0)
    return [
        vote(c("n_symbols") / words > 0.1, c("n_symbols") / words < 0.02),
        vote(c("n_marked") / words > 0.2, c("n_marked") / words < 0.05),
        vote(c("n_dup_lines") / lines > 0.3, (c("n_dup_lines") == 0) & (c("n_lines") > 3)),
        vote(c("n_repeat_words") / words > 0.15, (c("n_repeat_words") == 0) & (c("n_words") >= 50)),
        vote(c("n_words") < 20, c("n_words") >= 100),
        vote((c("word_chars") / words > 12) | (c("word_chars") / words < 2.5), (c("word_chars") / words < 9) & (c("word_chars") / words > 3)),
        vote(c("n_capitals") / words > 0.2, c("n_capitals") / words < 0.02),
        vote(c("n_ended") / lines < 0.3, c("n_ended") / lines > 0.7),
        vote(c("n_bare") / words > 0.15, c("n_bare") / words < 0.03),
    ]


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, prior_bad: float = 0.1, trust: float = 0.5) -> np.ndarray:
    """The posterior probability of good for each vote pattern (rows of -1, 0, 1).

    Whether a rule abstains tells nothing; a vote is bad with one rate on bad texts and another on good ones. The rates
    start from a prior that counts as ``trust`` times the number of votes.
    """
    bad_votes, good_votes = (patterns == -1).astype(float), (patterns == 1).astype(float)
    cast = ((bad_votes + good_votes) * counts[:, None]).sum(axis=0)
    prior = np.array([0.4, 0.02])
    rates, bad = np.tile(prior, (patterns.shape[1], 1)), prior_bad
    for _ in range(rounds):
        log = bad_votes @ np.log(rates) + good_votes @ np.log(1 - rates) + np.log([bad, 1 - bad])
        log -= log.max(axis=1, keepdims=True)
        post = np.exp(log) / np.exp(log).sum(axis=1, keepdims=True)
        mass = post * counts[:, None]
        # Each kind's prior weight goes by its share, so that the rarer kind is not drowned.
        weight = trust * cast[:, None] * np.array([bad, 1 - bad]) + 1
        new = np.clip((bad_votes.T @ mass + weight * prior) / ((bad_votes + good_votes).T @ mass + weight), 1e-4, 0.95)
        # A rule that speaks up against good texts as much as against bad ones tells nothing.
        odd = new[:, 0] < new[:, 1]
        new[odd] = new[odd].mean(axis=1, keepdims=True)
        bad = float(np.clip((mass[:, 0].sum() + trust * prior_bad * counts.sum()) / ((1 + trust) * counts.sum()), 0.01, 0.5))
        if np.abs(new - rates).max() < 1e-7:
            break
        rates = new
    return post[:, 1]


def measured(docs: DataFrame, text: bool = True) -> DataFrame:
    """The documents with their measures; ``text`` says whether the text goes along."""
    names = [c for c in docs.columns if c not in _RESULT]
    carried = [c for c in names if text or c != "text"]

    def measure(batches):
        for batch in batches:
            for piece in pieces(batch):
                found = measures(piece.column("text"))
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in carried), *(pa.array(found[m], pa.int64()) for m in MEASURES)], names=[*carried, *MEASURES])

    docs = docs.select(*names)
    return docs.mapInArrow(measure, T.StructType([*(docs.schema[c] for c in carried), *(T.StructField(m, T.LongType()) for m in MEASURES)]))


def judge_quality(measured: DataFrame, least: float = 0.5) -> DataFrame:
    """Add ``base_failed`` (too short or too repetitive), ``quality`` and ``kept``. The rows are read twice."""
    votes = _votes()
    found = measured.groupBy(F.array(*[v.cast("int") for v in votes]).alias("votes")).count().collect()
    by_code = np.zeros(3 ** len(RULES))
    if found:
        patterns = np.array([r["votes"] for r in found], np.int64)
        by_code[(patterns + 1) @ 3 ** np.arange(len(RULES))] = estimate(patterns, np.array([r["count"] for r in found], float))
    table = F.split(F.lit(",".join(f"{q:.9f}" for q in by_code)), ",").cast("array<double>")
    code = sum(((v + 1) * 3**i for i, v in enumerate(votes)), F.lit(0))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    judged = measured.withColumn("base_failed", failed).withColumn("quality", F.element_at(table, (code + 1).cast("int")))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))
