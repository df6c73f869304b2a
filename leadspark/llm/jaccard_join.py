"""Exact Jaccard join on word n-grams, by prefixes of token combinations.

Tokens are the n-grams of a text, ordered from rare to frequent (by the power of two of their document count, then by
hash). Two sets as similar as asked share at least two tokens in the first ``n - least overlap + 2`` of each, so each
set indexes its rare prefix tokens singly, and of its frequent ones each combination of two. A set whose prefix is
mostly frequent tokens indexes those singly, and the others meet it under single tokens too. Equal sets are one node.
Candidates are verified on their whole sets.

Each set has a sketch of 512 bits, the parities of its tokens by hash. Two sketches differ in no more bits than their sets
in tokens, so pairs whose sketches differ in more than the similarity allows are left out where they meet, and texts that
merely share passages are neither listed as pairs nor sent anywhere.

Each node is first compared with one pivot of all its candidate groups, for some rounds; members that are linked by now
need no comparison with each other, so a group of near copies costs about as many comparisons as it has members. Groups
that are still apart compare all members with the least one, and small groups then whatever is still apart; large ones go on with more pivots at each round until every two members are either
compared or linked. No link between components is lost; links within a component may stay unverified.

Defined cases: null and empty texts have no tokens and are linked with nothing. A text of fewer words than n is one
token. Rows of one ``doc_id`` are one node. A null ``doc_id`` is linked with nothing and has a null component. An empty
table gives an empty result. Other columns are not carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leadspark.llm.components import components
from leadspark.llm.rounds import ASK, Chunks, answer_of, answer_table, ask_table, document_words, grouped, unpacked
from leadspark.llm.words import grams, mix, parities, pieces, whole
from leadspark.session import keep

#: Tokens in fewer documents than 2 to this power are rare.
_RARE = 4
#: A set with more frequent tokens in its prefix indexes them singly.
_MOST_COMBINED = 16
#: Groups up to this size compare all that is not linked yet.
_SMALL_GROUP = 32
#: Rounds, at most, in which a node meets one pivot only.
_SINGLE_ROUNDS = 4
#: Members that are verified against one pivot in one task.
_BLOCK = 512

_SINGLE = np.uint64(0x51C7E5A1B2D3F405)
#: Words of 64 parities each.
_SKETCH = [f"b{i}" for i in range(8)]
_SIGNED = "doc_id long, n_shingles long, s1 long, s2 long"
_SIGNED_ARROW = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64())])
_ROWS = f"kind int, key long, node long, n long, {', '.join(f'{b} long' for b in _SKETCH)}, tokens binary"
_ROWS_ARROW = pa.schema([("kind", pa.int32()), *((c, pa.int64()) for c in ("key", "node", "n", *_SKETCH)), ("tokens", pa.binary())])
_SET, _ALONE, _FEW, _MANY = 0, 1, 2, 3


def token_sets(table, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``(row, token)`` of each text's distinct tokens, by row and token."""
    hashes, row, counts = document_words(table, fold=True)
    at = np.flatnonzero(whole(row, n))
    rows, tokens = [row[at]], [grams(hashes, n)[at]]
    begins = np.concatenate(([0], np.cumsum(counts)))[:-1]
    for k in range(1, n):
        short = np.flatnonzero(counts == k)
        if len(short):
            rows.append(short)
            tokens.append(grams(hashes, k)[begins[short]])
    row, token = np.concatenate(rows), np.concatenate(tokens)
    by = np.lexsort((token, row))
    row, token = row[by], token[by]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (token[1:] != token[:-1])
    return row[new], token[new]


def _signed(table, n: int) -> pa.Table:
    row, token = token_sets(table, n)
    sizes = np.bincount(row, minlength=table.num_rows)
    s1, s2 = np.zeros(table.num_rows, np.uint64), np.zeros(table.num_rows, np.uint64)
    if len(row):
        begins = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        s1[row[begins]] = np.add.reduceat(mix(token), begins)
        s2[row[begins]] = np.bitwise_xor.reduceat(mix(token ^ _SINGLE), begins)
    return pa.table([table.column("doc_id").combine_chunks(), pa.array(sizes, pa.int64()), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64))], schema=_SIGNED_ARROW)


def similar_components(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """Link texts whose sets of word n-grams have a Jaccard similarity of at least ``percent`` / 100.

    Returns ``doc_id``, ``n_shingles`` and ``component_id``, the least ``doc_id`` that links reach, itself included.
    """
    docs = docs.select(docs.doc_id.cast("long").alias("doc_id"), "text")

    def sign(batches):
        for batch in batches:
            for piece in pieces(pa.Table.from_batches([batch])):
                yield from _signed(piece, words).to_batches()

    signed = keep(docs.mapInArrow(sign, _SIGNED))
    same = ["n_shingles", "s1", "s2"]
    classes = keep(signed.where("doc_id is not null and n_shingles > 0").groupBy(*same).agg(F.min("doc_id").alias("node")))
    labels = components(similar_pairs(docs, classes, words, percent))
    named = classes.join(labels, "node", "left").select(*same, F.coalesce("label", "node").alias("component_id"))
    # A hot class is one row on the other side of this join.
    return signed.join(named, same, "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def similar_pairs(docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """``(a, b)``: links between nodes, enough of them to join every component."""
    chunks = Chunks(docs.where("doc_id is not null"), (F.col("doc_id"),))
    n = chunks.n
    members = classes.select(
        chunks.chunk(F.col("node")).alias("chunk"), F.lit(0).alias("turn"), F.col("node").alias("bucket"), F.lit(None).cast("binary").alias("answer"), F.lit(0.0).alias("total"), F.lit(0.0).alias("kinds")
    ).repartition(chunks.parts, "chunk")

    def nodes(table, answers):
        """The sets of the documents that stand for their class."""
        chosen = answers.filter(pa.compute.equal(answers.column("turn"), 0)).column("bucket")
        table = table.filter(pa.compute.is_in(table.column("doc_id"), value_set=chosen.combine_chunks()))
        row, token = token_sets(table, words)
        return table.column("doc_id").to_numpy()[row] if len(row) else np.zeros(0, np.int64), row, token

    def count(table, answers):
        chunk = table.column("chunk")[0].as_py() if table.num_rows else 0
        _, _, token = nodes(table, answers)
        keys, found = np.unique(token, return_counts=True)
        return ask_table(chunk, n, keys, np.uint32, more=found.astype(np.uint32))

    def counted(asked):
        keys, starts = unpacked(asked.column("keys"), np.uint32)
        found, _ = unpacked(asked.column("more"), np.uint32)
        number, kinds = grouped(keys)
        total = np.bincount(number, found, kinds)
        level = np.where(total > 1, np.floor(np.log2(np.maximum(total, 1))) + 1, 0)
        return answer_table(asked, 1, starts, level[number].astype(np.uint8))

    def index(table, answers):
        node, row, token = nodes(table, answers)
        keys, number = np.unique(token, return_inverse=True)
        level = answer_of(answers, 1, keys, n, np.uint8)[0][number]
        by = np.lexsort((token, level, row))
        token, level, node = token[by], level[by], node[by]
        size = np.bincount(row)
        size = size[row[by]] if len(row) else size
        begins = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else np.zeros(0, np.int64)
        place = np.arange(len(token)) - np.repeat(begins, np.diff(np.append(begins, len(token))))
        least = (percent * size + 99) // 100
        # Two sets that one token may link are both so small; they index every token singly.
        small = (least <= 1) & (percent <= 50)
        prefix = (place < size - least + 2) & ((size > 1) | small)
        out = []

        def emit(kind, key, where, sketch=None, tokens=None):
            bits = [pa.nulls(len(where), pa.int64())] * len(_SKETCH) if sketch is None else [pa.array(b) for b in sketch]
            tokens = pa.nulls(len(where), pa.binary()) if tokens is None else pa.array(tokens, pa.binary())
            out.append(pa.table([pa.array(np.full(len(where), kind), pa.int32()), pa.array(key.view(np.int64)), pa.array(node[where]), pa.array(size[where], pa.int64()), *bits, tokens], schema=_ROWS_ARROW))

        rare = np.flatnonzero(prefix & (level > 0) & (level <= _RARE))
        emit(_ALONE, token[rare], rare)
        frequent = prefix & (level > _RARE)
        total = np.add.reduceat(frequent.astype(np.int64), begins) if len(begins) else begins
        many = np.repeat(total > _MOST_COMBINED, np.diff(np.append(begins, len(token)))) | small
        for kind, of in ((_FEW, frequent & ~many), (_MANY, frequent & many)):
            of = np.flatnonzero(of)
            emit(kind, token[of] ^ _SINGLE, of)
        few = np.flatnonzero(frequent & ~many)
        for step in range(1, _MOST_COMBINED):
            # The frequent tokens of a prefix are its last ones, side by side.
            first = few[:-step][row[by[few[:-step]]] == row[by[few[step:]]]] if len(few) > step else few[:0]
            emit(_ALONE, mix(token[first] * np.uint64(3) + mix(token[first + step])), first)
        indexed = np.zeros(len(size), bool)
        indexed[rare] = True
        indexed |= frequent
        if len(begins):
            used = np.flatnonzero(np.add.reduceat(indexed.astype(np.int64), begins) > 0)
            ends = np.append(begins, len(token))[1:]
            sets = [np.sort(token[begins[k] : ends[k]]).tobytes() for k in used]
            emit(_SET, np.zeros(len(used), np.int64), begins[used], [b[used] for b in parities(token, begins, len(_SKETCH))], sets)
        return pa.concat_tables(out)

    levels = chunks.answered(chunks.apply(count, ASK, members), counted)
    rows = keep(chunks.apply(index, _ROWS, members.unionByName(levels)))
    sets = rows.where(F.col("kind") == _SET).select("node", "tokens")
    places = rows.where(F.col("kind") != _SET).select("key", "node", "n", (F.col("kind") != _FEW).alias("full"))
    # A key of one node, or met only by sets that don't need it, is of no use.
    useful = places.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.max("full").alias("any")).where("low != high and any").select("key")
    live = keep(places.join(useful, "key", "left_semi").join(rows.where(F.col("kind") == _SET).select("node", *_SKETCH), "node"))
    return _linked(live, sets, percent)


def _near(percent: int):
    """Sizes and sketches that allow the similarity."""
    differ = sum((F.bit_count(F.col(b).bitwiseXOR(F.col(f"pivot_{b}"))) for b in _SKETCH), F.lit(0))
    return (100 * F.least("n", "pivot_n") >= percent * F.greatest("n", "pivot_n")) & ((100 + percent) * differ <= (100 - percent) * (F.col("n") + F.col("pivot_n")))


def _grown(labels: DataFrame | None, new: DataFrame) -> DataFrame:
    """``(node, label)`` after new links; only what they join is worked out anew."""
    ends = new.select(F.col("a").alias("node")).union(new.select(F.col("b").alias("node"))).distinct()
    if labels is None:
        return components(new)
    held = keep(ends.join(labels, "node", "left_anti").withColumn("label", F.col("node")).union(labels.select("node", "label")))
    of = lambda end: held.select(F.col("node").alias(end), F.col("label").alias(f"{end}_label"))
    joined = components(new.join(of("a"), "a").join(of("b"), "b").select(F.col("a_label").alias("a"), F.col("b_label").alias("b")))
    renamed = joined.select(F.col("node").alias("label"), F.col("label").alias("grown"))
    return keep(held.join(renamed, "label", "left").select("node", F.coalesce("grown", "label").alias("label")))


def _with_labels(live: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return live.withColumn("label", F.col("node"))
    return live.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _pairs(labelled: DataFrame, pivots: DataFrame, percent: int) -> DataFrame:
    """Members of a group with its pivots, as far as sizes and the kinds of their tokens allow a link that is not known yet."""
    met = labelled.join(pivots, "key").where((F.col("node") != F.col("p")) & (F.col("label") != F.col("pivot_label")) & (F.col("full") | F.col("pivot_full")))
    return met.where(_near(percent))


def _as_pivots(rows: DataFrame) -> DataFrame:
    return rows.select("key", F.col("node").alias("p"), F.col("n").alias("pivot_n"), F.col("label").alias("pivot_label"), F.col("full").alias("pivot_full"), *[F.col(b).alias(f"pivot_{b}") for b in _SKETCH])


def _linked(live: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    found = live.sparkSession.createDataFrame([], "a long, b long")
    labels = None
    # First each node meets one pivot a round, of all groups that it is in: a large group of near copies is linked
    # by about as many comparisons as it has members, however many tokens they share.
    for turn in range(_SINGLE_ROUNDS):
        labelled = keep(_with_labels(live, labels))
        by = F.col("node") if not turn else F.xxhash64("node", F.lit(turn))
        row = F.struct("node", "n", "label", "full", *_SKETCH)
        group = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min_by(row, F.struct(by.alias("by"), "node")).alias("r")).where("low != high")
        offered = _pairs(labelled, _as_pivots(group.select("key", "r.*")), percent)
        chosen = offered.groupBy("node").agg(F.min_by("p", F.struct(F.xxhash64("p", F.lit(turn)) if turn else F.col("p"), "p")).alias("p"))
        new = keep(_verified(keep(chosen.select("p", "node")), sets, percent))
        if new.isEmpty():
            break
        found, labels = found.union(new), _grown(labels, new)
    turn = 0
    while True:
        labelled = _with_labels(live, labels)
        group = labelled.groupBy("key").agg(F.count("*").alias("members"), F.min("label").alias("low"), F.max("label").alias("high"), F.min("node").alias("least"))
        open_groups = group.where("low != high")
        labelled = keep(labelled.join(open_groups.select("key", "members", "least"), "key"))
        if labelled.isEmpty():
            return found
        # One pivot in each group, then more at each turn; small groups take every member.
        share = F.greatest(F.lit(1), F.floor(F.col("members") / (1 << (2 * turn))))
        pivot = F.col("node") == F.col("least")
        if turn:
            pivot = pivot | (F.col("members") <= _SMALL_GROUP) | (F.pmod(F.xxhash64("node", F.lit(turn)), share) == 0)
        labelled = labelled.withColumn("pivot", pivot)
        pairs = _pairs(labelled, _as_pivots(labelled.where("pivot")), percent)
        pairs = pairs.where(~F.col("pivot") | (F.col("node") > F.col("p"))).select("p", "node").distinct()
        new = keep(_verified(keep(pairs), sets, percent))
        if not new.isEmpty():
            found, labels = found.union(new), _grown(labels, new)
        live = labelled.where("not pivot").select("key", "node", "n", "full", *_SKETCH)
        turn += 1


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are similar. A pivot's partners are dealt into blocks, so that no pivot is one task."""
    blocks = pairs.groupBy("p").agg(F.ceil(F.count("*") / _BLOCK).alias("blocks"))
    dealt = pairs.join(blocks, "p").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    pivots = blocks.select("p", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    left = pivots.join(sets.withColumnRenamed("node", "p"), "p").select("p", "block", F.lit(None).cast("long").alias("node"), "tokens")
    right = dealt.join(sets, "node").select(*[F.col(c).alias(c) for c in ("p", "block", "node", "tokens")])

    def verify(pivot, others):
        out_a, out_b = [], []
        own = [np.frombuffer(x, np.uint64) for x in pivot.column("tokens").to_pylist()]
        for node, tokens in zip(others.column("node").to_pylist(), others.column("tokens").to_pylist(), strict=True):
            other = np.frombuffer(tokens, np.uint64)
            for mine in own:
                at = np.searchsorted(mine, other)
                shared = int(np.count_nonzero(mine[np.minimum(at, len(mine) - 1)] == other))
                if 100 * shared >= percent * (len(mine) + len(other) - shared):
                    out_a.append(pivot.column("p")[0].as_py())
                    out_b.append(node)
                    break
        return pa.table([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    return left.groupBy("p", "block").cogroup(right.groupBy("p", "block")).applyInArrow(verify, "a long, b long")
