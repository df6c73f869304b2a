"""Toxic spans and document scores from a linear-chain conditional random field.

Token labels come from the document labels: a word (ASCII punctuation stripped, A-Z as a-z) of ``support`` toxic training
documents that is more frequent among them than chance allows (log-likelihood ratio of ``least_ratio``) is evidence, in a
grade by its smoothed log-odds, of which the lowest begins at 1; evidence tokens of toxic documents are labelled toxic,
all other tokens are not. A two-state chain (clean, toxic) with a weight for each grade
and transition is fitted to these labels. Forward-backward marginals give each token's probability of being toxic;
a document's score is a logistic function of their sum and of the chance of any, and tokens of a half or more are its offending spans.

Word statistics cover all labelled training documents, and all evidence words are used: a table of up to ``SENT_WORDS``
goes to every task, a larger one stays a table, which chunks of documents ask about their words. The chain and the
logistic function are fitted on the driver to a bounded sample of the training documents (``sample`` of each label, those
with the least hashes). Stretches without evidence have constant potentials, so a
chain steps over them by a matrix power: marginals are exact at every evidence token, and work grows with those.

Defined cases: a null text is empty. An empty text has no tokens and the score of no evidence. A null label counts as
no label, a null ``doc_id`` has none. Without toxic or clean training documents every score is 0. Repeated labels of a
document count as toxic if any is. Repeated rows are scored alike. Other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from leadspark.llm.rounds import ANSWER, ASK, Chunks, answer_of, answer_table, ask_table, unpacked
from leadspark.llm.words import MARKS, Words, pieces, words_of
from leadspark.session import keep

#: A word table of more rows (9 bytes each) is not sent to the tasks.
SENT_WORDS = 1 << 20
_GRADES = np.array([1.0, 2.0, 3.0, 4.0, 5.0])
_COUNTS = "word long, toxic long, clean long"
_SAMPLE = "doc_id long, toxic int, row_at array<long>, grade array<int>, tokens long"
RESULT = "doc_id long, held_out boolean, score double, n_toxic long, spans array<struct<at: long, end: long>>"
_RESULT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("n_toxic", pa.int64()), ("spans", pa.list_(pa.struct([("at", pa.int64()), ("end", pa.int64())])))])


@dataclass
class Evidence:
    """Sorted word hashes and the grade of each, 1 or more."""

    words: np.ndarray
    grades: np.ndarray

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, self.grades[at], 0)


@dataclass
class Model:
    """``evidence`` is a table of ``word`` and ``grade`` if it is too large to be sent."""

    evidence: Evidence | DataFrame
    chain: np.ndarray
    link: np.ndarray


def _counts(training: DataFrame) -> DataFrame:
    def count(batches):
        for batch in batches:
            for piece in pieces(pa.Table.from_batches([batch])):
                w = words_of(piece.column("text"), True, MARKS)
                if not len(w.hash):
                    continue
                toxic = piece.column("toxic").to_numpy().astype(bool)
                by = np.lexsort((w.row, w.hash))
                word, row = w.hash[by], w.row[by]
                new = np.concatenate(([True], (word[1:] != word[:-1]) | (row[1:] != row[:-1])))
                kinds, number = np.unique(word[new], return_inverse=True)
                of_toxic = np.bincount(number, toxic[row[new]], len(kinds)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(of_toxic), pa.array(np.bincount(number, minlength=len(kinds)) - of_toxic)], names=["word", "toxic", "clean"])

    return training.mapInArrow(count, _COUNTS).groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _ratio(a: Column, b: Column, toxic: int, clean: int) -> Column:
    """Twice the log-likelihood ratio of a word in ``a`` of the toxic and ``b`` of the clean documents to one at the same rate in both."""
    n = toxic + clean
    part = lambda found, total, share: F.when(found > 0, found * F.log(found * n / (total * share))).otherwise(0.0)
    without = F.lit(n) - a - b
    return 2 * (part(a, a + b, toxic) + part(b, a + b, clean) + part(F.lit(toxic) - a, without, toxic) + part(F.lit(clean) - b, without, clean))


def _evidence(training: DataFrame, toxic: int, clean: int, support: int, least_ratio: float) -> Evidence | DataFrame:
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    clear = _counts(training).where(F.col("toxic") >= support).withColumn("odds", odds)
    clear = clear.where((F.col("odds") >= float(_GRADES[0])) & (_ratio(F.col("toxic"), F.col("clean"), toxic, clean) >= least_ratio))
    grade = sum(((F.col("odds") >= float(g)).cast("int") for g in _GRADES[1:]), F.lit(1))
    words = keep(clear.select("word", grade.cast("byte").alias("grade")))
    if words.count() > SENT_WORDS:
        return words
    found = words.toArrow()
    hashes = found.column("word").to_numpy().view(np.uint64)
    by = np.argsort(hashes)
    return Evidence(hashes[by], found.column("grade").to_numpy().astype(np.int64)[by])


def _graded(rows: DataFrame, evidence: Evidence | DataFrame, work: Callable[[pa.Table, Words, Callable[[np.ndarray], np.ndarray]], pa.RecordBatch], schema: str) -> DataFrame:
    """``work(rows, their words, grades of hashes)`` for all rows, piece by piece."""
    if isinstance(evidence, Evidence):

        def on_batches(batches):
            for batch in batches:
                for piece in pieces(pa.Table.from_batches([batch])):
                    yield work(piece, words_of(piece.column("text"), True, MARKS), evidence.of)

        return rows.mapInArrow(on_batches, schema)
    chunks = Chunks(rows)
    n = chunks.n

    def ask(table):
        kinds = [np.unique(words_of(piece.column("text"), True, MARKS).hash) for piece in pieces(table)]
        return ask_table(table.column("chunk")[0].as_py(), n, np.unique(np.concatenate(kinds)), np.uint64)

    def answer(asked, known):
        keys, starts = unpacked(asked.column("keys"), np.uint64)
        words = known.column("word").to_numpy().view(np.uint64)
        by = np.argsort(words)
        return answer_table(asked, 1, starts, Evidence(words[by], known.column("grade").to_numpy()[by]).of(keys).astype(np.uint8))

    def on_chunk(table, answers):
        out = []
        for piece in pieces(table):
            w = words_of(piece.column("text"), True, MARKS)
            kinds, number = np.unique(w.hash, return_inverse=True)
            grades = answer_of(answers, 1, kinds, n, np.uint8)[0].astype(np.int64)[number]
            out.append(work(piece, w, lambda _, grades=grades: grades))
        return pa.Table.from_batches(out)

    dealt = evidence.select(F.expr(f"shiftrightunsigned(word, 40) % {n}").alias("bucket"), "word", "grade")
    answers = chunks.apply(lambda table, _: ask(table), ASK).groupBy("bucket").cogroup(dealt.groupBy("bucket")).applyInArrow(answer, ANSWER)
    return chunks.apply(on_chunk, schema, answers)


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, sample: int = 1500, support: int = 3, least_ratio: float = 10.83) -> Model | None:
    """Learn from the labelled rows where ``held_out`` is false. A ratio of 10.83 has a chance of one in a thousand."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    learned = docs.where(~F.coalesce(held_out, F.lit(False))).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # One form of join at every size: texts are shuffled once, labels are narrow.
    training = learned.join(known.hint("merge"), "doc_id")
    sizes = {r.toxic > 0: r.n for r in training.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(True, 0), sizes.get(False, 0)
    if not toxic or not clean:
        return None
    evidence = _evidence(training, toxic, clean, support, least_ratio)

    def grade(piece, w, grades_of):
        out = [[], [], []]
        for at, grades, total in _events(w, grades_of(w.hash)):
            for column, value in zip(out, (at, grades, total), strict=True):
                column.append(value)
        return pa.RecordBatch.from_arrays([piece.column("doc_id").combine_chunks(), piece.column("toxic").combine_chunks().cast(pa.int32()), *(pa.array(x, t) for x, t in zip(out, (pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64()), strict=True))], names=["doc_id", "toxic", "row_at", "grade", "tokens"])

    # Ids are drawn first: they are at most ``sample``, small enough to broadcast, so that no text is shuffled for the draw.
    by = [F.xxhash64("doc_id"), F.col("doc_id")]
    some = []
    for kind in (F.col("toxic") > 0, F.col("toxic") <= 0):
        ids = training.where(kind).select("doc_id", "toxic").distinct().orderBy(*by).limit(sample)
        some.append(learned.join(F.broadcast(ids), "doc_id").orderBy(*by).limit(sample))
    rows = _graded(some[0].union(some[1]), evidence, grade, _SAMPLE).collect()
    sequences = [(np.array(r.row_at, np.int64), np.array(r.grade, np.int64), r.tokens) for r in rows]
    truth = np.array([r.toxic > 0 for r in rows])
    chain = _fit_chain(sequences, truth)
    model = Model(evidence, chain, np.zeros(3))
    features = np.array([_features(_marginals(chain, at, grades, total)) for at, grades, total in sequences])
    # The sample has as many documents of each label as there are; weights bring back their true shares.
    weights = np.where(truth, toxic / max(1, truth.sum()), clean / max(1, (~truth).sum()))
    model.link = _fit_link(features, truth, weights / weights.mean())
    return model


def _events(w: Words, grades: np.ndarray):
    """``(places, grades, number of tokens)`` of the evidence tokens of each text."""
    at = np.flatnonzero(grades)
    ends = np.cumsum(w.per_row())
    begins = ends - w.per_row()
    cut = np.searchsorted(at, np.concatenate((begins, ends[-1:])))
    for k in range(w.rows):
        mine = at[cut[k] : np.searchsorted(at, ends[k])]
        yield mine - begins[k], grades[mine], int(ends[k] - begins[k])


def _steps(chain: np.ndarray):
    """Potentials: transitions (from, to), of a token without evidence, of one with each grade; clean is 0, toxic is 1."""
    to_toxic, to_clean, stays, bias = chain[:4]
    moves = np.exp(np.array([[0.0, to_toxic], [to_clean, stays]]))
    emit = np.exp(np.concatenate(([bias], bias + chain[4:])))
    return moves, emit


def _power(base: np.ndarray, n: np.ndarray):
    """``(base to the n, log of its scale)`` of a positive 2 x 2 matrix, for an array of n."""
    (a, b), (c, d) = base
    root = np.sqrt((a - d) ** 2 + 4 * b * c)
    high, low = (a + d + root) / 2, (a + d - root) / 2
    one = np.eye(2)
    ratio = (low / high) ** n
    return ((base - low * one) - ratio[..., None, None] * (base - high * one)) / (high - low), n * np.log(high)


def _marginals(chain: np.ndarray, at: np.ndarray, grades: np.ndarray, total: int) -> np.ndarray:
    """The probability of toxic at each evidence token."""
    if not len(at):
        return np.zeros(0)
    moves, emit = _steps(chain)
    plain = moves * np.array([1.0, emit[0]])
    gaps = np.diff(np.concatenate(([-1], at, [total]))) - 1
    skip, _ = _power(plain, gaps.astype(float))
    n = len(at)
    forward, backward = np.empty((n, 2)), np.empty((n, 2))
    now = np.array([1.0, 0.0])
    for k in range(n):
        now = (now @ skip[k] @ moves) * np.array([1.0, emit[grades[k]]])
        now = now / now.sum()
        forward[k] = now
    now = skip[n] @ np.ones(2)
    for k in range(n - 1, -1, -1):
        backward[k] = now / now.sum()
        now = skip[k] @ (moves @ (np.array([1.0, emit[grades[k]]]) * backward[k]))
    both = forward * backward
    return both[:, 1] / both.sum(axis=1)


def _features(p: np.ndarray) -> tuple[float, float, float]:
    """A constant, the expected number of toxic tokens (its logarithm), and whether there is one at all."""
    return 1.0, float(np.log1p(p.sum())), 1.0 - float(np.prod(1.0 - p))


def _passages(sequences, truth, most: int = 32):
    """The sequences cut into stretches of bounded numbers of evidence tokens, for the fit alone."""
    for (at, grades, total), is_toxic in zip(sequences, truth, strict=True):
        for k in range(0, max(1, len(at)), most):
            begin = at[k - 1] + 1 if k else 0
            end = at[k + most - 1] + 1 if k + most < len(at) else total
            yield (at[k : k + most] - begin, grades[k : k + most], end - begin), is_toxic


def _fit_chain(sequences, truth, steps: int = 60, ridge: float = 0.05) -> np.ndarray:
    """Ascend the likelihood of the token labels, all chains side by side."""
    cut = list(_passages(sequences, truth))
    sequences, truth = [x for x, _ in cut], np.array([t for _, t in cut])
    most = max([1, *(len(at) for at, _, _ in sequences)])
    n = len(sequences)
    gaps, grades, real = np.zeros((n, most + 1)), np.zeros((n, most), np.int64), np.zeros((n, most), bool)
    for i, (at, grade, total) in enumerate(sequences):
        gap = np.diff(np.concatenate(([-1], at, [total]))) - 1
        gaps[i, : len(gap)] = gap
        grades[i, : len(at)] = grade
        real[i, : len(at)] = True

    def likelihood(chain):
        moves, emit = _steps(chain)
        plain = moves * np.array([1.0, emit[0]])
        now, norm = np.tile([1.0, 0.0], (n, 1)), np.zeros(n)
        truly = np.zeros(n)
        before = np.zeros(n, bool)
        for k in range(most + 1):
            skip, scale = _power(plain, gaps[:, k])
            now = np.einsum("ni,nij->nj", now, skip)
            norm += scale
            # The labelled path: a gap is clean, an evidence token of a toxic document is toxic.
            has_gap = gaps[:, k] > 0
            truly += np.where(has_gap & before, chain[1], 0.0)
            before &= ~has_gap
            if k < most:
                stepped = (now @ moves) * np.stack((np.ones(n), emit[grades[:, k]]), axis=1)
                here = real[:, k]
                now = np.where(here[:, None], stepped, now)
                is_toxic = here & truth
                score = chain[3] + np.concatenate(([0.0], chain[4:]))[grades[:, k]]
                truly += np.where(is_toxic, score + np.where(before, chain[2], chain[0]), 0.0) + np.where(here & ~truth & before, chain[1], 0.0)
                before = np.where(here, is_toxic, before)
            total = now.sum(axis=1)
            norm += np.log(total)
            now = now / total[:, None]
        return (truly - norm).mean() - ridge / n * np.square(chain).sum()

    chain = np.concatenate(([-2.0, 0.0, 0.0, -3.0], np.arange(1, len(_GRADES) + 1, dtype=float)))
    first, second = np.zeros(len(chain)), np.zeros(len(chain))
    for t in range(1, steps + 1):
        slope = np.array([(likelihood(chain + d) - likelihood(chain - d)) / 2e-4 for d in np.eye(len(chain)) * 1e-4])
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        chain = chain + 0.15 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return chain


def _fit_link(x: np.ndarray, truth: np.ndarray, weights: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weighted logistic regression by Newton's steps."""
    free = np.ones(x.shape[1], bool)
    while True:
        w = np.zeros(x.shape[1])
        own = x[:, free]
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(own @ w[free], -30, 30)))
            hessian = (own * (weights * p * (1 - p))[:, None]).T @ own + ridge * np.eye(own.shape[1])
            w[free] += np.linalg.solve(hessian, own.T @ (weights * (truth - p)) - ridge * w[free])
        # More toxic tokens must not lower a score.
        if (w[1:] >= 0).all():
            return w
        free[1:] &= w[1:] >= 0


def score_toxicity(docs: DataFrame, model: Model | None, held_out: Column) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``n_toxic`` (tokens more toxic than not) and ``spans`` (their byte offsets in the UTF-8 text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("n_toxic"), F.array().cast("array<struct<at: long, end: long>>").alias("spans"))

    def score(piece, w, grades_of):
        begins = np.cumsum(w.per_row()) - w.per_row()
        scores, counts, spans = [], [], []
        for k, (at, grades, total) in enumerate(_events(w, grades_of(w.hash))):
            p = _marginals(model.chain, at, grades, total)
            scores.append(1 / (1 + np.exp(-np.clip(np.dot(_features(p), model.link), -30, 30))))
            bad = at[p >= 0.5] + begins[k]
            counts.append(len(bad))
            spans.append([{"at": int(w.at[b] - w.offsets[k]), "end": int(w.end[b] - w.offsets[k])} for b in bad])
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id").combine_chunks(), piece.column("held_out").combine_chunks(), pa.array(scores, pa.float64()), pa.array(counts, pa.int64()), pa.array(spans, _RESULT.field("spans").type)], schema=_RESULT
        )

    # The model goes along with the tasks, and a table in it must not.
    evidence, model = model.evidence, Model(None, model.chain, model.link)
    return _graded(rows, evidence, score, RESULT)
