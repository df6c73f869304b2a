"""Language-model scores from a probabilistic suffix tree over words.

The tree's states are contexts of no word up to ``longest`` words. A context is a candidate if training texts hold it
``min_context`` times; it stays if the words after it differ from those after its shorter suffix: the log-likelihood of its
training words, each left out of the counts in turn, must gain at least ``divergence`` nats over the suffix. Contexts grow
by a word at each round; where the suffixes two and three words shorter have both been dropped, no longer one is asked
about, so the tree ends by itself where contexts tell nothing more. A round asks about the longer contexts while the gain
of the shorter ones is summed. A state's
next-word distribution is smoothed by that of its suffix, down to the add-one root, so every state's probabilities sum
to one over the known words and one unknown word. A text is scored from the longest state that its last words reach.

Counts cover all training texts. Words are counted by 64-bit hashes; runs of words by the hash range of
their bucket and 32 bits more. Buckets grow with the input, so at 0.1 GB as at 100 TB fewer than one run in 1,000 may share
a count.

A chunk of documents is written once as its distinct words and the places that hold them. Each round is a job of its own,
whose answers are written by chunk; a chunk works out its places again from them, as they are far smaller than the places.

Defined cases: a null text is empty and has one token, its end. A null ``doc_id`` counts as training. Without training
tokens each token's base probability is 1. Repeated rows are repeated training texts. Other columns are not carried.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from leadspark.llm.rounds import ASK, Chunks, answer_of, answer_table, ask_table, document_words, grouped, unpacked
from leadspark.llm.words import grams
from leadspark.session import keep

_END = np.uint64(0x5EEDED0FD0C00001)
#: Turns from here on answer whether the contexts of so many words stay.
_STAYS = 1000
_GAIN, _PAIR = b"gain", b"pair"
#: Chunks of at least so many bytes: a key is asked about once by a chunk.
CHUNK = 4 << 20
#: The places of a chunk hold numbers of words, the most frequent first; the numbers' upper halves are mostly 0.
_PLACES = "chunk long, docs array<long>, held_out array<boolean>, lengths binary, words binary, low binary, high binary"
_PLACES_ARROW = pa.schema([("chunk", pa.int64()), ("docs", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())), *((c, pa.binary()) for c in ("lengths", "words", "low", "high"))])
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, n_deep long, train_tokens long, base_score double, score double"
_RESULT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("n_deep", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def _as_places(table: pa.Table, _) -> pa.Table:
    hashes, _, counts = document_words(table, fold=True)
    ends = np.cumsum(counts + 1) - 1
    token = np.full(len(hashes) + len(counts), _END, np.uint64)
    is_word = np.ones(len(token), bool)
    is_word[ends] = False
    token[is_word] = hashes
    words, number, seen = np.unique(token, return_inverse=True, return_counts=True)
    by = np.argsort(-seen, kind="stable")
    rank = np.empty(len(by), np.uint32)
    rank[by] = np.arange(len(by))
    number = rank[number]
    packed = [x.tobytes() for x in ((counts + 1).astype(np.int64), words[by], number.astype(np.uint16), (number >> np.uint32(16)).astype(np.uint16))]
    return pa.table([[table.column("chunk")[0].as_py()], [table.column("doc_id").to_pylist()], [table.column("held_out").to_pylist()], *([x] for x in packed)], schema=_PLACES_ARROW)


@dataclass
class Places:
    """The tokens of a chunk: their words' numbers, their documents' rows, and whether they count."""

    chunk: int
    docs: pa.Array
    held_out: pa.Array
    words: np.ndarray
    number: np.ndarray
    row: np.ndarray
    counted: np.ndarray

    @classmethod
    def of(cls, table: pa.Table) -> Places:
        one = table.combine_chunks()
        read = lambda c, dtype: np.frombuffer(one.column(c)[0].as_py(), dtype)
        lengths = read("lengths", np.int64)
        row = np.repeat(np.arange(len(lengths)), lengths)
        held_out = one.column("held_out")[0].values
        number = read("low", np.uint16).astype(np.int64) | (read("high", np.uint16).astype(np.int64) << 16)
        return cls(one.column("chunk")[0].as_py(), one.column("docs")[0].values, held_out, read("words", np.uint64), number, row, ~held_out.to_numpy(zero_copy_only=False).astype(bool)[row])


@dataclass
class Level:
    """Contexts of one length: the places after them, how often they occur, how often with the place's word too, and which
    of the chunk's runs of that length they are.
    """

    at: np.ndarray
    held: np.ndarray
    found: np.ndarray
    runs: np.ndarray
    context: np.ndarray

    def in_doubt(self) -> np.ndarray:
        """The contexts that may gain. One seen twice, with two words after it, can't: each word is less likely than before."""
        return np.flatnonzero(np.bincount(self.context, (self.held > 2) | (self.found != 1), len(self.runs)))


def score_texts(docs: DataFrame, held_out: Column, min_context: int = 2, divergence: float = 2.0, backoff: float = 0.8, longest: int = 6) -> DataFrame:
    """Learn from the rows where ``held_out`` is false and score all rows.

    ``min_context``: occurrences that make a context a candidate; the estimate needs two, as each is left out in turn.
    ``longest``: words of the longest contexts, each of which costs a round. ``backoff``: a state seen n times gives its suffix
    the weight of n to this power. Returns ``doc_id``, ``held_out``, ``n_tokens``, ``n_known`` (tokens seen in
    training), ``n_deep`` (tokens scored by a state below the root), ``train_tokens``, ``base_score`` (add-one
    unigrams) and ``score``, both log10 of the text's probability.
    """
    chunks = Chunks(docs.select(docs.doc_id.cast("long").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out")), smallest=CHUNK)
    n = chunks.n
    places = chunks.keep(chunks.apply(_as_places, _PLACES)).groupBy("chunk")

    def parted(plain, flagged):
        def answer(question):
            is_flagged = pa.compute.is_valid(question.column("flags"))
            return pa.concat_tables([plain(question.filter(pa.compute.invert(is_flagged))), flagged(question.filter(is_flagged))])

        return answer

    def summed(turn):
        def answer(question):
            keys, starts = unpacked(question.column("keys"), np.uint64 if turn == 1 else np.uint32)
            counts, _ = unpacked(question.column("more"), np.uint32)
            number, found = grouped(keys)
            total = np.bincount(number, counts, found).astype(np.int64)
            return answer_table(question, turn, starts, total[number], float(total.sum()), float((total > 0).sum()), planes=True)

        return answer

    def runs_with_next(p, size, at):
        """The distinct runs of ``size`` words and the one at ``at``, and the number of each place's run."""
        if not len(at):
            return np.zeros(0, np.uint64), at
        return np.unique(grams(p.words[p.number], size + 1)[at - size], return_inverse=True)

    def counts(p, at, runs, place):
        return ask_table(p.chunk, n, runs, np.uint32, more=np.bincount(place, p.counted[at], len(runs)).astype(np.uint32))

    def second(p):
        """The places with a word before them: nearly all words occur often enough, so pairs are asked about with the words."""
        at = np.arange(1, len(p.number))
        return at[p.row[at] == p.row[at - 1]]

    def ask_words(table):
        p = Places.of(table)
        at = second(p)
        words = ask_table(p.chunk, n, p.words, np.uint64, more=np.bincount(p.number, p.counted, len(p.words)).astype(np.uint32))
        pairs = counts(p, at, *runs_with_next(p, 1, at))
        return pa.concat_tables([words, pairs.set_column(4, "flags", pa.array([_PAIR] * pairs.num_rows, pa.binary()))])

    counted_words = keep(chunks.answers(places.applyInArrow(ask_words, ASK), parted(summed(1), summed(2))))
    of_buckets = counted_words.where("turn = 1").groupBy("bucket").agg(F.max("total").alias("total"), F.max("kinds").alias("kinds"))
    sums = of_buckets.agg(F.sum("total").alias("total"), F.sum("kinds").alias("kinds")).first()
    total, kinds = sums.total or 0.0, sums.kinds or 0.0

    def weight(count):
        return count.astype(float) ** backoff

    def retained_at(p, answers, level, size):
        stays = np.zeros(len(p.number), bool)
        if len(level.at):
            present = level.in_doubt()
            of_run = np.zeros(len(level.runs), bool)
            of_run[present] = answer_of(answers, _STAYS + size, level.runs[present], n, np.uint8)[0] > 0
            stays[level.at] = of_run[level.context]
        return stays

    def states(table, answers, known):
        """``(places, their words' counts, levels up to known, next)``: the places that the next level may ask about, its
        runs with the next word, and the number of each place's run.
        """
        p = Places.of(table)
        token = p.words[p.number]
        c1 = answer_of(answers, 1, p.words, n, np.int64, planes=True)[0][p.number]
        held, runs, number = c1, p.words, p.number
        stays, levels = [np.ones(len(token), bool)] * 2, []
        asked_before = stays[0]
        for size in range(1, known + 2):
            if size > longest:
                return p, c1, levels, None
            if size == 1:
                at = second(p)
            else:
                at = np.arange(size, len(token))
                at = at[(p.row[at] == p.row[at - size]) & (held[at - 1] >= min_context) & asked_before[at] & (stays[-1][at] | stays[-2][at])]
            longer, place = runs_with_next(p, size, at)
            if size > known:
                return p, c1, levels, (at, longer, place)
            found = answer_of(answers, size + 1, longer, n, np.int64, planes=True)[0][place]
            if size == 1:
                candidate = held[at - 1] >= min_context
                at, place, found = at[candidate], place[candidate], found[candidate]
            levels.append(Level(at, held[at - 1], found, runs, number[at - 1]))
            held, asked_before = np.zeros(len(token), np.int64), np.zeros(len(token), bool)
            held[at], asked_before[at] = found, True
            runs, number = longer, np.zeros(len(token), np.int64)
            number[at] = place
            if size > 1:
                stays.append(retained_at(p, answers, levels[size - 2], size - 1))

    def ask_longer(size):
        """Counts of the contexts of ``size`` words with the next one, if any are left to ask about; and what each context
        of one word less gains over its suffix in this chunk, each token left out of its own counts.
        """

        def ask(table, answers):
            p, c1, levels, asked = states(table, answers, size - 1)
            out = []
            if asked is not None:
                out.append(counts(p, *asked))
            if levels:
                left = p.counted.astype(np.int64)
                chance = np.maximum(c1 + 1 - left, 1) / (total + kinds + 1)
                for level in levels:
                    seen, shorter = weight(level.held), chance[level.at]
                    chance[level.at] = (level.found - left[level.at] + seen * shorter) / (level.held - left[level.at] + seen)
                gain = np.bincount(level.context, np.log(chance[level.at] / shorter) * left[level.at], len(level.runs))
                present = level.in_doubt()
                gains = ask_table(p.chunk, n, level.runs[present], np.uint32, more=gain[present].astype(np.float32))
                out.append(gains.set_column(4, "flags", pa.array([_GAIN] * gains.num_rows, pa.binary())))
            return pa.concat_tables(out)

        return ask

    def retained(turn):
        def answer(question):
            keys, starts = unpacked(question.column("keys"), np.uint32)
            gain, _ = unpacked(question.column("more"), np.float32)
            number, found = grouped(keys)
            stays = np.bincount(number, gain, found) >= divergence
            return answer_table(question, turn, starts, stays[number].astype(np.uint8))

        return answer

    def score(table, answers):
        p, c1, levels, _ = states(table, answers, longest)
        base = (c1 + 1) / (total + kinds + 1)
        chance, best, below = base.copy(), base.copy(), np.zeros(len(base), bool)
        for size, level in enumerate(levels, 1):
            seen = weight(level.held)
            chance[level.at] = (level.found + seen * chance[level.at]) / (level.held + seen)
            stays = retained_at(p, answers, level, size)
            best[stays] = chance[stays]
            below |= stays
        rows = len(p.docs)
        per_row = lambda x=None: np.bincount(p.row, x, rows)
        whole = lambda x: pa.array(x.astype(np.int64))
        return pa.table(
            [p.docs, p.held_out, whole(per_row()), whole(per_row(c1 > 0)), whole(per_row(below)), pa.array(np.full(rows, int(total))), pa.array(per_row(np.log10(base))), pa.array(per_row(np.log10(best)))],
            schema=_RESULT,
        )

    known = counted_words
    for size in range(2, longest + 2):
        asked = places.cogroup(known.repartition(chunks.parts, "chunk").groupBy("chunk")).applyInArrow(ask_longer(size), ASK)
        known = known.union(keep(chunks.answers(asked, parted(summed(size + 1), retained(_STAYS + size - 1)))))
    return places.cogroup(known.repartition(chunks.parts, "chunk").groupBy("chunk")).applyInArrow(score, RESULT)
