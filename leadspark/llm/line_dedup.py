"""Line deduplication by an exact set-similarity join.

A line's tokens are its distinct runs of five words, ordered by rarity: by the power of two of the number of runs in
their hash class, then by hash. The classes are 65,536 whatever the input, so their counts, taken over all runs, are a
table of fixed size. Lines as similar as asked share a token among the first ``n - least overlap + 1`` of each (prefix),
have sizes in proportion (length), and have enough tokens left after the shared one (position). Pairs that pass are
verified on all their tokens.

Lines of equal word sequence are one class, told apart by 128 hash bits. Prefix tokens are shuffled as pairs of token and
class alone; only classes that share one with another class go on, with their place, size and tokens. Behind a prefix
token, all classes are first compared with the earliest; those that match it are settled, and only the others meet
further classes, more at each turn until all have been compared. A class carries a sketch of 128 bits, the parities of its
tokens by hash. Two sketches differ in no more bits than their lines in tokens, so lines that merely share a token are
neither listed as pairs nor sent with their tokens.

Words and tokens are hashed in Arrow tasks, all joins are Spark's: built-in array functions took several times the
seconds that the work may take (see the README).

A line is removed if a near copy of it stands earlier: in a document of smaller ``doc_id``, or further up in the same
one. Lines are judged on the input, not on what is left.

Defined cases: lines are cut at newlines. Blank lines stay and remove nothing. A line of one to four words has its whole
word sequence as its one token, so it goes if an exact copy of the sequence stands earlier.
A null text has no lines and stays null. A null ``doc_id`` comes last. Texts of one ``doc_id`` are ordered by a hash of
their text; equal rows don't remove each other's lines. Other columns are kept; those named as a result are replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from leadspark.llm.words import grams, mix, parities, pieces, whole, words_of
from leadspark.session import keep

CLASSES = 1 << 16
_RESULT = ("n_lines", "n_removed", "kept_text")
_CLASS = ["k1", "k2"]
_AT = ("late", "doc_id", "h", "line_no")
#: Words of 64 parities each.
_SKETCH = ["b0", "b1"]
_U = np.uint64


@dataclass
class Lines:
    """The lines of some texts that hold a word: text, number in it, class, and where its words begin and end."""

    text: np.ndarray
    number: np.ndarray
    k1: np.ndarray
    k2: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    words: np.ndarray

    def tokens(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """``(line, token)`` of each run of n words, and of each line of fewer; a line may hold a token several times."""
        line = np.repeat(np.arange(len(self.begin)), self.end - self.begin)
        at = np.flatnonzero(whole(line, n))
        short = np.flatnonzero(self.end - self.begin < n)
        token = grams(self.words, n)[at] if len(at) else np.zeros(0, _U)
        return np.concatenate((line[at], short)), np.concatenate((token, mix(self.k1[short] + _U(n))))

    def ranked(self, n: int, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(line, token, where each line's tokens begin)``: distinct tokens, the rarest of each line first."""
        line, token = self.tokens(n)
        # One sort by line, level and the hash's upper bits; equal tokens come side by side.
        bits = max(len(self.begin), 1).bit_length()
        level = levels[token % _U(CLASSES)].astype(_U)
        key = (line.astype(_U) << _U(64 - bits)) | (level << _U(58 - bits)) | (token >> _U(6 + bits))
        by = np.argsort(key)
        if ((key[by][1:] == key[by][:-1]) & (token[by][1:] != token[by][:-1])).any():
            by = np.lexsort((token, key))
        line, token, key = line[by], token[by], key[by]
        new = np.ones(len(by), bool)
        new[1:] = (key[1:] != key[:-1]) | (token[1:] != token[:-1])
        return line[new], token[new], np.searchsorted(line[new], np.arange(len(self.begin) + 1))


def lines_of(texts) -> Lines:
    w = words_of(texts)
    breaks = np.flatnonzero(w.data == 0x0A)
    number = np.searchsorted(breaks, w.at) - np.searchsorted(breaks, w.offsets[w.row])
    new = np.ones(len(w.row), bool)
    new[1:] = (w.row[1:] != w.row[:-1]) | (number[1:] != number[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin, len(w.row))[1:]
    place = mix((np.arange(len(w.row)) - np.repeat(begin, end - begin) + 1).astype(_U))
    if len(begin):
        size = mix((end - begin).astype(_U))
        k1 = np.add.reduceat(mix(w.hash ^ place), begin) + size
        k2 = np.bitwise_xor.reduceat(mix(w.hash + place * _U(3)), begin) ^ size
    else:
        k1 = k2 = np.zeros(0, _U)
    return Lines(w.row[begin], number[begin], mix(k1), mix(k2), begin, end, w.hash)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _each_piece(rows: DataFrame, work: Callable[[pa.Table, Lines], pa.Table | None], schema: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            for piece in pieces(pa.Table.from_batches([batch])):
                made = work(piece, lines_of(piece.column("text")))
                if made is not None:
                    yield from made.to_batches()

    return rows.mapInArrow(run, schema)


def _marked(rows: DataFrame, names: list[str], schema: str, words: int) -> tuple[DataFrame, np.ndarray]:
    """``(class and place of each line, the level of each class of tokens)``: the power of two of its runs, a table of fixed size."""
    def run(batches):
        total, kinds = np.zeros(CLASSES, np.int64), None
        for batch in batches:
            for piece in pieces(pa.Table.from_batches([batch])):
                lines = lines_of(piece.column("text"))
                total += np.bincount(lines.tokens(words)[1] % _U(CLASSES), minlength=CLASSES)
                made = pa.table([*_columns(piece, lines, np.arange(len(lines.begin))), pa.nulls(len(lines.begin), pa.int64())], names=[*names, "runs"])
                kinds = made.schema
                yield from made.to_batches()
        if kinds is not None:
            held = np.flatnonzero(total)
            none = [pa.nulls(len(held), f.type) for f in list(kinds)[:-2]]
            yield pa.RecordBatch.from_arrays([*none, pa.array(held, pa.int32()), pa.array(total[held], pa.int64())], schema=kinds)

    both = keep(rows.mapInArrow(run, f"{schema}, runs long"))
    levels = np.zeros(CLASSES, np.uint8)
    counts = both.where("runs is not null").groupBy("line_no").agg(F.floor(F.log2(F.sum("runs") + 1)).cast("int").alias("level"))
    for r in counts.collect():
        levels[r.line_no] = r.level
    return both.where("runs is null").select(*_CLASS, F.struct(*_AT).alias("at")), levels


def _columns(piece: pa.Table, lines: Lines, chosen: np.ndarray) -> list:
    """Class and place of the chosen lines."""
    of_text = pa.array(lines.text[chosen])
    doc = [piece.column(c).combine_chunks().take(of_text) for c in _AT[:3]]
    return [_signed(lines.k1[chosen]), _signed(lines.k2[chosen]), *doc, pa.array(lines.number[chosen], pa.int32())]


def _prefix_size(n, percent: int):
    return n - (percent * n + 99) // 100 + 1


def dedup_lines(docs: DataFrame, percent: int = 80, words: int = 5) -> DataFrame:
    """The documents with ``n_lines``, ``n_removed`` and ``kept_text``."""
    columns = [c for c in docs.columns if c not in _RESULT]
    key = [F.col("doc_id").isNull().alias("late"), F.col("doc_id"), F.xxhash64("text").alias("h")]
    rows = docs.select("text", *key)
    place = f"k1 long, k2 long, late boolean, doc_id {docs.schema['doc_id'].dataType.simpleString()}, h long, line_no int"
    names = ["k1", "k2", *_AT]
    sides, levels = _marked(rows, names, place, words)

    def prefixes(_, lines):
        line, token, begins = lines.ranked(words, levels)
        n = np.diff(begins)
        first = np.arange(len(line)) - begins[line] < _prefix_size(n, percent)[line]
        return pa.table([_signed(token[first]), _signed(lines.k1[line[first]])], names=["token", "k1"])

    classes = keep(sides.groupBy(*_CLASS).agg(F.min("at").alias("at"), F.count("*").alias("copies")))

    # Dealt by token once; a window finds which tokens several classes hold where they are.
    places = _each_piece(rows, prefixes, "token long, k1 long")
    of_token = Window.partitionBy("token")
    spread = places.select("token", "k1", F.min("k1").over(of_token).alias("low"), F.max("k1").over(of_token).alias("high"))
    shared = keep(spread.where("low != high").select("token", "k1"))

    # The classes that meet others, with their tokens, worked out again from their earliest line.
    met = classes.join(shared.select("k1").distinct(), "k1", "left_semi")
    wanted = keep(met.groupBy(*[F.col(f"at.{c}").alias(f"_{c}") for c in _AT[:3]]).agg(F.collect_set("at.line_no").alias("_lines")))
    # A document's key is never null but for its id.
    same = (F.col("h") == F.col("_h")) & (F.col("late") == F.col("_late")) & F.col("doc_id").eqNullSafe(F.col("_doc_id"))

    def sets_of(piece, lines):
        line, token, begins = lines.ranked(words, levels)
        asked = piece.column("_lines").to_pylist()
        chosen = np.array([i for i, (t, k) in enumerate(zip(lines.text.tolist(), lines.number.tolist(), strict=True)) if k in asked[t]], np.int64)
        sizes = np.diff(begins)[chosen]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        held = np.arange(ends[-1]) + np.repeat(begins[chosen] - ends[:-1], sizes)
        bits = [pa.array(b) for b in parities(token[held], ends[:-1], len(_SKETCH))]
        return pa.table([*_columns(piece, lines, chosen), *bits, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _signed(token[held]))], names=[*names, *_SKETCH, "codes"])

    # Documents without such a line are left out by their keys first, which are narrow.
    near = rows.join(wanted.drop("_lines"), same, "left_semi").join(wanted, same).select(*rows.columns, "_lines")
    found = keep(_each_piece(near, sets_of, f"{place}, {', '.join(f'{b} long' for b in _SKETCH)}, codes array<long>"))
    sets = found.select("k1", "k2", F.struct(*_AT).alias("at"), *_SKETCH, F.col("codes").alias("set"))
    sized = sets.select("k1", "k2", "at", *_SKETCH, F.size("set").alias("n"), F.slice("set", 1, _prefix_column(percent)).alias("prefix"))
    live = sized.select("k1", "k2", "at", *_SKETCH, "n", F.posexplode("prefix").alias("place", "token")).join(shared, ["token", "k1"], "left_semi")
    # Rows that repeat a document give its lines again.
    earlier = _earlier(keep(live.select("token", "place", "k1", "k2", "at", "n", *_SKETCH).distinct()), sets.select("k1", "k2", "set"), percent)

    # A later line of a class is a copy of its first; the first goes only if another class stands earlier.
    verdict = classes.where("copies > 1").select(*_CLASS, "at").join(earlier.withColumn("_all", F.lit(True)), _CLASS, "full").select(*_CLASS, F.col("at").alias("first_at"), "_all")
    removed = sides.join(verdict, _CLASS).where(F.coalesce("_all", F.lit(False)) | (F.col("at") > F.col("first_at")))
    gone = removed.groupBy(F.struct(*[F.col(f"at.{c}") for c in _AT[:3]]).alias("_gone_doc")).agg(F.collect_set("at.line_no").alias("_gone"))
    full = docs.select(*columns, F.struct(*key).alias("_doc"))
    joined = full.join(gone, F.col("_doc").eqNullSafe(F.col("_gone_doc")), "left")
    all_lines = F.split("text", "\n")
    kept = F.filter(all_lines, lambda line, i: ~F.array_contains("_gone", i))
    return joined.select(
        *columns, F.greatest(F.size(all_lines), F.lit(0)).cast("long").alias("n_lines"), F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
    )


def _prefix_column(percent: int) -> Column:
    n = F.size("set")
    return (n - F.floor((F.lit(percent) * n + 99) / 100) + 1).cast("int")


def _earlier(live: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``(k1, k2)`` of the classes that have a near copy which stands earlier."""
    settled, turn = None, 0
    while True:
        if settled is not None:
            live = live.join(settled.withColumn("done", F.lit(True)), ["k1", "k2"], "left").withColumn("done", F.coalesce("done", F.lit(False)))
        else:
            live = live.withColumn("done", F.lit(False))
        group = live.groupBy("token").agg(F.count("*").alias("members"), F.min(F.struct("at", "k1", "k2")).alias("least"), F.max(F.when(~F.col("done"), F.col("at"))).alias("last_open"))
        # Settled when whatever is open stands first.
        group = group.where(F.col("last_open") > F.col("least.at"))
        members = keep(live.drop("members", "least", "last_open").join(group, "token"))
        if not members.limit(1).count():
            return settled if settled is not None else live.select("k1", "k2").limit(0)
        share = F.greatest(F.lit(1).cast("long"), F.floor(F.col("members") / (1 << (3 * turn))))
        is_first = (F.col("k1") == F.col("least.k1")) & (F.col("k2") == F.col("least.k2"))
        chosen = is_first if not turn else (F.pmod(F.xxhash64("k1", F.lit(turn)), share) == 0)
        pivots = members.where(chosen).select("token", F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("at").alias("p_at"), F.col("n").alias("p_n"), F.col("place").alias("p_place"), *[F.col(b).alias(f"p_{b}") for b in _SKETCH])
        least = F.ceil(F.lit(percent) * (F.col("n") + F.col("p_n")) / (100 + percent))
        differ = sum((F.bit_count(F.col(b).bitwiseXOR(F.col(f"p_{b}"))) for b in _SKETCH), F.lit(0))
        pairs = members.where(~F.col("done")).join(pivots, "token").where(
            (F.col("p_at") < F.col("at"))
            & (100 * F.least("n", "p_n") >= percent * F.greatest("n", "p_n"))
            & (1 + F.least(F.col("n") - F.col("place") - 1, F.col("p_n") - F.col("p_place") - 1) + F.least("place", "p_place") >= least)
            & ((100 + percent) * differ <= (100 - percent) * (F.col("n") + F.col("p_n")))
        ).select("k1", "k2", "p1", "p2").distinct()
        other = sets.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("set").alias("p_set"))
        shared = F.size(F.array_intersect("set", "p_set"))
        near = pairs.join(sets, ["k1", "k2"]).join(other, ["p1", "p2"]).where(100 * shared >= percent * (F.size("set") + F.size("p_set") - shared))
        new = near.select("k1", "k2").distinct()
        settled = keep(new if settled is None else settled.union(new).distinct())
        # A group whose members have all been compared is done.
        live = members.where(share > 1 if turn else F.col("members") > 2).select("token", "place", "k1", "k2", "at", "n", *_SKETCH)
        turn += 1
