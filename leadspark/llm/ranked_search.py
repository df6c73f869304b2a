"""Exact ranked search: the documents of highest inner product with an item, by sparse ball trees.

A document's vector has a whole number for each term that some item asks about, an item's vector the weight times the
repeats of its terms; the score is their inner product. Documents are read as vectors once and written. Each task then
takes them in chunks of bounded size and splits a chunk into balls, by halves between two distant documents. A ball has
a centroid and a radius, so no document of it scores more than ``centroid * item + radius * |item|``, where only the
terms that the ball holds count for the item's length. Bounds are in floating point and rounded up by more than their
error, scores are whole numbers. Balls are taken best first and left out, with all below them, for the items of which
k better documents are known; a leaf's documents are scored for the other items.

An item's k-th best score among one document in ``SEED_SHARE``, found first by the same search, is a bound that holds for
all documents: so a chunk gives only what may be among the best of all. Items are taken in blocks of ``BLOCK_BYTES``
of text, whose terms go to every task; nothing about the documents does but the counts of these terms.

Defined cases: a null or empty text has no terms and is never found, nor is a document without a term of the item.
Equal rows of the items are one item; rows of one ``item_id`` and different texts are items of their own. Rows of one
``doc_id`` are documents of their own; a null ``doc_id`` comes last among equal scores. Empty tables give an empty result.
Terms are told apart by 64 hash bits. Other columns are not carried.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from leadspark.llm.words import MARKS, pieces, words_of
from leadspark.session import keep

#: Bytes of items that are searched for together; the largest item is a block of its own size.
BLOCK_BYTES = 1 << 20
#: Documents and vector entries of one chunk, and documents of one leaf.
CHUNK_DOCS, CHUNK_ENTRIES, LEAF_DOCS = 4096, 1 << 20, 32
#: One document in so many is searched first.
SEED_SHARE = 64
#: Numbers of one block of scores.
_SCORES = 1 << 21
#: More than the relative error of a bound.
_SLACK = 1e-9

_VECTORS = "doc_id long, n long, terms array<int>, counts array<int>"
_VECTORS_ARROW = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])
_FOUND = "item int, doc_id long, score long"
_FOUND_ARROW = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def term_counts(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text's number, term, its count)``, by text and term."""
    w = words_of(texts, fold=True, gaps=MARKS)
    by = np.lexsort((w.hash, w.row))
    row, term = w.row[by], w.hash[by]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (term[1:] != term[:-1])
    at = np.flatnonzero(new)
    return row[at], term[at], np.diff(np.append(at, len(row)))


def vectors(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """``doc_id, n, terms, counts``: all terms of each text counted, and those of the sorted ``terms`` by their number."""

    def read(batches):
        for batch in batches:
            for piece in pieces(pa.Table.from_batches([batch])):
                w = words_of(piece.column("text"), fold=True, gaps=MARKS)
                place = np.minimum(np.searchsorted(terms, w.hash), max(len(terms) - 1, 0))
                known = np.flatnonzero(terms[place] == w.hash) if len(terms) else np.zeros(0, np.int64)
                key, count = np.unique(w.row[known] * np.int64(len(terms) + 1) + place[known], return_counts=True)
                row, term = key // (len(terms) + 1), key % (len(terms) + 1)
                starts = pa.array(np.searchsorted(row, np.arange(w.rows + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(starts, pa.array(x, pa.int32())) for x in (term, count)]
                yield from pa.table([piece.column("doc_id").combine_chunks(), pa.array(w.per_row(), pa.int64()), *lists], schema=_VECTORS_ARROW).to_batches()

    return docs.select(docs.doc_id.cast("long").alias("doc_id"), "text").mapInArrow(read, _VECTORS)


@dataclass
class Chunk:
    """Documents as sparse rows: the entries of document i are ``begins[i]`` to ``begins[i + 1]``."""

    ids: np.ndarray
    begins: np.ndarray
    term: np.ndarray
    value: np.ndarray

    def entries(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(places of the documents' entries, where each document begins among them)``; no document is empty."""
        lengths = self.begins[docs + 1] - self.begins[docs]
        starts = np.concatenate(([0], np.cumsum(lengths)))
        return np.arange(starts[-1]) + np.repeat(self.begins[docs] - starts[:-1], lengths), starts[:-1]


def parts_of_score(n: np.ndarray, counts: np.ndarray, n_docs: int, all_terms: int) -> np.ndarray:
    """The entries of the documents' vectors, in whole numbers; ``n`` is the length of each entry's document."""
    if len(n) and 25 * int(n.max()) * n_docs >= 1 << 63:
        m = np.array([75 + 25 * int(x) * n_docs // all_terms for x in n.tolist()], np.int64)
    else:
        m = 75 + 25 * n * n_docs // max(all_terms, 1)
    return 1_000_000_000 * counts // (1000 * counts + 12 * m)


@dataclass
class Ball:
    """Documents with a bound for each item; ``parts`` is empty in a leaf."""

    docs: np.ndarray
    bounds: np.ndarray
    parts: tuple[Ball, ...]


def _ball(chunk: Chunk, x: np.ndarray, norms: np.ndarray, docs: np.ndarray, asked: np.ndarray, leaf_docs: int) -> Ball:
    """A ball over the documents. ``x``: the entries' coordinates; ``asked``: the items' coordinates, a column each."""
    at, begins = chunk.entries(docs)
    held, term = np.unique(chunk.term[at], return_inverse=True)
    value = x[at]
    along = lambda v: np.add.reduceat(value * v[term], begins)
    centroid = np.bincount(term, value, len(held)) / len(docs)
    squares = norms[docs]
    length = centroid @ centroid
    # Rounding may err by this share of the largest square.
    apart = np.maximum(squares - 2 * along(centroid) + length, 0) + _SLACK * (squares + length)
    item = asked[held]
    bounds = (centroid @ item + math.sqrt(apart.max()) * np.sqrt((item * item).sum(axis=0))) * (1 + _SLACK) + 1
    if len(docs) <= leaf_docs:
        return Ball(docs, bounds, ())

    def spread(i: int) -> np.ndarray:
        out = np.zeros(len(held))
        mine = slice(begins[i], begins[i + 1] if i + 1 < len(begins) else None)
        out[term[mine]] = value[mine]
        return out

    first = spread(int(np.argmax(apart)))
    second = spread(int(np.argmax(squares - 2 * along(first))))
    by = np.argsort(along(second - first), kind="stable")
    half = len(docs) // 2
    return Ball(docs, bounds, tuple(_ball(chunk, x, norms, docs[part], asked, leaf_docs) for part in (by[:half], by[half:])))


def search_chunk(chunk: Chunk, items: np.ndarray, weights: np.ndarray, floor: np.ndarray, k: int, leaf_docs: int = LEAF_DOCS) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """``(item, document's place, score)`` of the k best documents of each item in the chunk, and how many pairs were scored.

    ``items``: repeats by item and term. ``floor``: a score that k documents of the corpus reach, for each item.
    """
    # Both sides take the root of the weight: rare terms count for more than common ones in a ball's radius, yet not for all.
    root = np.sqrt(weights)
    x = chunk.value * root[chunk.term]
    norms = np.add.reduceat(x * x, chunk.begins[:-1])
    factor = items * weights
    top = _ball(chunk, x, norms, np.arange(len(chunk.ids)), np.ascontiguousarray((items * root).T), leaf_docs)
    least = np.maximum(floor, 1)
    best = np.zeros((len(items), k), np.int64)
    found, scored, number = [], 0, 0

    def score(ball: Ball, of: np.ndarray) -> int:
        """Score the leaf's documents for the items, and raise what an item's k-th best reaches."""
        at, begins = chunk.entries(ball.docs)
        term, value = chunk.term[at], chunk.value[at]
        step = max(1, _SCORES // len(at))
        for some in (of[i : i + step] for i in range(0, len(of), step)):
            scores = np.add.reduceat(factor[some[:, None], term] * value, begins, axis=1)
            which, doc = np.nonzero(scores >= least[some, None])
            found.append((some[which], ball.docs[doc], scores[which, doc]))
            best[some] = np.partition(np.concatenate((best[some], scores), axis=1), -k, axis=1)[:, -k:]
            least[some] = np.maximum(least[some], best[some].min(axis=1))
        return len(of) * len(ball.docs)

    # Each item first goes down to the leaf of its best bound.
    done: dict[int, np.ndarray] = {}
    dive = [(top, np.flatnonzero(top.bounds >= least))]
    while dive:
        ball, of = dive.pop()
        if len(of) and ball.parts:
            left = ball.parts[0].bounds[of] >= ball.parts[1].bounds[of]
            dive += [(ball.parts[0], of[left]), (ball.parts[1], of[~left])]
        elif len(of):
            scored += score(ball, of)
            done[id(ball)] = of
    queue = [(-float(top.bounds.max()), number, top)]
    while queue:
        _, _, ball = heapq.heappop(queue)
        of = np.flatnonzero(ball.bounds >= least)
        if ball.parts and len(of):
            for part in ball.parts:
                number += 1
                heapq.heappush(queue, (-float(part.bounds[of].max()), number, part))
        elif len(of):
            of = np.setdiff1d(of, done.get(id(ball), of[:0]), assume_unique=True)
            if len(of):
                scored += score(ball, of)
    item, doc, score = (np.concatenate(c) for c in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 3
    stays = score >= least[item]
    item, doc, score = item[stays], doc[stays], score[stays]
    by = np.lexsort((chunk.ids[doc], -score, item))
    item, doc, score = item[by], doc[by], score[by]
    rank = np.arange(len(item)) - np.searchsorted(item, item)
    return item[rank < k], doc[rank < k], score[rank < k], scored


def _chunks(batches, n_docs: int, all_terms: int):
    """Chunks of the vectors in the order read, with ``(whether an id is null)``."""
    waiting, docs, entries = [], 0, 0
    for batch in batches:
        lengths = np.diff(batch.column("terms").offsets.to_numpy())
        ends = np.cumsum(lengths)
        at = 0
        while at < len(lengths):
            base = ends[at - 1] if at else 0
            to = min(at + CHUNK_DOCS - docs, int(np.searchsorted(ends, base + CHUNK_ENTRIES - entries, "right")))
            to = min(len(lengths), max(to, at + (not docs)))
            if to > at:
                waiting.append(batch.slice(at, to - at))
                docs, entries = docs + to - at, entries + int(ends[to - 1] - base)
                at = to
            if at < len(lengths):
                yield _chunk(waiting, n_docs, all_terms)
                waiting, docs, entries = [], 0, 0
    if waiting:
        yield _chunk(waiting, n_docs, all_terms)


def _chunk(batches, n_docs: int, all_terms: int) -> Chunk:
    table = pa.Table.from_batches(batches).combine_chunks()
    terms, counts = (table.column(c).combine_chunks() for c in ("terms", "counts"))
    begins = np.concatenate(([0], np.cumsum(pa.compute.list_value_length(terms).to_numpy()))).astype(np.int64)
    count = counts.flatten().to_numpy().astype(np.int64)
    n = np.repeat(table.column("n").to_numpy(), np.diff(begins))
    # A null id comes last among equal scores.
    ids = pa.compute.fill_null(table.column("doc_id"), np.iinfo(np.int64).max).to_numpy()
    return Chunk(ids, begins, terms.flatten().to_numpy(), parts_of_score(n, count, n_docs, all_terms))


def _found(rows: DataFrame, items: np.ndarray, weights: np.ndarray, floor: np.ndarray, n_docs: int, all_terms: int, k: int) -> DataFrame:
    part = max(1, _SCORES // max(1, items.shape[1]))

    def search(batches):
        for chunk in _chunks(batches, n_docs, all_terms):
            for at in range(0, len(items), part):
                item, doc, score, _ = search_chunk(chunk, items[at : at + part].astype(np.int64), weights, floor[at : at + part], k)
                ids = pa.array(chunk.ids[doc], pa.int64(), mask=chunk.ids[doc] == np.iinfo(np.int64).max)
                yield from pa.table([pa.array(item + at, pa.int32()), ids, pa.array(score, pa.int64())], schema=_FOUND_ARROW).to_batches()

    return rows.select("doc_id", "n", "terms", "counts").mapInArrow(search, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k documents of highest score above 0 of each item."""
    spark = docs.sparkSession
    items = items.select("item_id", "text").where("text is not null").distinct()
    blocks = max(1, math.ceil((items.select(F.sum(F.octet_length("text"))).first()[0] or 0) / BLOCK_BYTES))
    out = None
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        named = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(mine)], f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
        ranked = _search_block(docs, [r.text for r in mine], k).join(named, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = ranked if out is None else out.unionByName(ranked)
    return out


def _search_block(docs: DataFrame, texts: list[str], k: int) -> DataFrame:
    row, term, count = term_counts(pa.array(texts, pa.string()))
    terms, column = np.unique(term, return_inverse=True)
    items = np.zeros((len(texts), len(terms)), np.int32)
    items[row, column] = count
    read = keep(vectors(docs, terms))
    size = read.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    # As many rows as the block has terms.
    held = dict(read.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    weights = np.array([math.floor(1000 * math.log((2 * size.docs + 2) / (2 * held.get(t, 0) + 1))) for t in range(len(terms))], np.int64)
    rows = read.where(F.size("terms") > 0)
    floor = np.zeros(len(items), np.int64)
    seed = rows.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(SEED_SHARE)) == 0)
    # One row for each item of the block.
    for r in _best(_found(seed, items, weights, floor, size.docs, size.terms, k), k).where(F.col("rank") == k).collect():
        floor[r.item] = r.score
    return _best(_found(rows, items, weights, floor, size.docs, size.terms, k), k)
