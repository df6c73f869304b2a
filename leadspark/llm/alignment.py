"""Alignment of two tokenizers by inverted bitmaps of token pairs.

Both tokenizations of a text are read as cuts of the same bytes. Bytes between two cuts of either belong to one token of
each side, so every stretch between neighbouring cuts is one link; where both cut, a group ends. A block of documents is
indexed by pair of linked ids: bitmaps over the block's documents, one for each binary digit of the pair's multiplicity
in a document (multiplicity planes), each kept as a list of places where few bits are set. The OR of a pair's planes has a
bit for each document that holds the pair, so its population count is the pair's document count; the planes' counts,
weighed by their digits, are its link count.

Documents of two blocks differ, so corpus counts are sums over the blocks. Each block then gets the counts of its own
pairs back and adds them up along the postings: a document's score is read from the planes, not from its text again.

Defined cases: null and empty texts, and texts that the tokens of one side don't give back byte by byte, have no tokens.
Rows that repeat a ``doc_id`` are documents of their own. An empty table gives an empty result. The tokenizers' files are
read by the driver and sent to the tasks. Other columns are not carried.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from leadspark.llm.words import pieces
from leadspark.session import keep

#: Links after which a block of documents ends, and the most documents of a block: their places take 16 bits.
BLOCK_LINKS, BLOCK_DOCS = 4_000_000, 1 << 16
#: A plane with more than one document in so many is a bitmap, others are lists of places.
_SPARSE = 16

_DOCS = ("n_a", "n_b", "n_groups", "n_links")
_PLANES = ("run_pair", "run_plane", "run_size", "places", "bitmaps")
_BLOCK = (
    "block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups array<string>, "
    "pairs array<long>, pair_docs array<long>, pair_links array<long>, run_pair binary, run_plane binary, run_size binary, places binary, bitmaps binary"
)
_LONGS = pa.list_(pa.int64())
_BLOCK_ARROW = pa.schema(
    [("block", pa.int64()), ("doc_ids", _LONGS), *((c, _LONGS) for c in _DOCS), ("groups", pa.list_(pa.string())), *((c, _LONGS) for c in ("pairs", "pair_docs", "pair_links"))]
    + [(c, pa.binary()) for c in _PLANES]
)
_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_ALIGNED_ARROW = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in (*_DOCS, "n_best", "count_sum")), ("groups_sha256", pa.string())])


class Side:
    """A tokenizer, with the bytes of each id."""

    def __init__(self, token_bytes: list[bytes]):
        self.lengths = np.array([len(x) for x in token_bytes], np.int64)
        self._letters = np.frombuffer(b"".join(token_bytes), np.uint8)
        self._starts = np.concatenate(([0], np.cumsum(self.lengths)))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        raise NotImplementedError

    def joined(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        shift = np.repeat(self._starts[ids] - ends + lengths, lengths)
        return self._letters[shift + np.arange(len(shift))].tobytes()


class ByteLevel(Side):
    """A byte-level tokenizer: its entries write each byte as one printable character.

    Its ids follow the order of its merges, so they are ranks, by which a faster encoder finds the same ids. A text that
    this encoder refuses (endless white space) goes to the tokenizer itself.
    """

    #: Fixed value: the pattern that parts a text before merging.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, file: bytes):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_str(file.decode())
        # Names of special tokens inside a text are plain text.
        self._tokenizer.encode_special_tokens = True
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        names = {i: name for name, i in self._tokenizer.get_vocab().items()}
        token_bytes = [bytes(byte_of[c] for c in names.get(i, "")) for i in range(max(names) + 1)]
        super().__init__(token_bytes)
        special = {t["id"] for t in json.loads(file)["added_tokens"]}
        ranks = {t: i for i, t in enumerate(token_bytes) if i not in special}
        self._ranked = tiktoken.Encoding("by rank", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self._encode(" " + t) for t in texts]

    def _encode(self, text: str) -> np.ndarray:
        try:
            return self._ranked.encode_to_numpy(text, disallowed_special=())
        except ValueError:
            return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


class Pieces(Side):
    """A sentence-piece tokenizer, which puts the space before the text by itself."""

    def __init__(self, file: bytes):
        from sentencepiece import SentencePieceProcessor

        self._model = SentencePieceProcessor(model_proto=file)
        names = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        byte = re.compile("<0x([0-9A-F]{2})>")
        super().__init__([bytes.fromhex(m[1]) if (m := byte.fullmatch(p)) else p.replace("▁", " ").encode() for p in names])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self._model.encode_as_numpy(texts, num_threads=1)


@dataclass
class Tokens:
    """Both tokenizations of some texts: flat ids, and how many of them each text has."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray


def tokenized(texts: list[str | None], left: Side, right: Side) -> Tokens:
    """A text that either side doesn't give back has no tokens."""
    asked = [i for i, t in enumerate(texts) if t]
    whole = [b" " + texts[i].encode() for i in asked]
    both = [[ids.astype(np.int32) for ids in side.encode([texts[i] for i in asked])] if asked else [] for side in (left, right)]
    fits = np.ones(len(asked), bool)
    for side, found in zip((left, right), both, strict=True):
        flat = np.concatenate(found) if found else np.zeros(0, np.int32)
        same = np.array([int(side.lengths[ids].sum()) for ids in found]) == [len(t) for t in whole]
        if not same.all() or side.joined(flat) != b"".join(whole):
            fits &= [side.joined(ids) == t for ids, t in zip(found, whole, strict=True)]
    sizes, ids = np.zeros((2, len(texts)), np.int64), []
    kept = np.flatnonzero(fits)
    for k, found in enumerate(both):
        sizes[k, np.array(asked, np.int64)[kept]] = [len(found[i]) for i in kept]
        ids.append(np.concatenate([np.zeros(0, np.int32), *(found[i] for i in kept)]))
    return Tokens(*ids, *sizes)


def _digits(most: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of each number up to ``most``, and how many there are, with room for a mark behind."""
    names = [str(i).encode() for i in range(most + 1)]
    width = len(names[-1]) + 1
    return np.frombuffer(b"".join(n.ljust(width) for n in names), np.uint8).reshape(-1, width), np.array([len(n) for n in names])


@dataclass
class Alignment:
    """Groups and links of some texts. ``key`` and ``row``: each link's pair of ids and text."""

    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    key: np.ndarray
    row: np.ndarray


def align(tokens: Tokens, len_a: np.ndarray, len_b: np.ndarray, digits: tuple[np.ndarray, np.ndarray]) -> Alignment:
    """``len_a`` and ``len_b``: the bytes of each id. A pair's key is the first id times the number of second ids, plus the second."""
    a, b, rows = tokens.a, tokens.b, len(tokens.n_a)
    end_a, end_b = np.cumsum(len_a[a]), np.cumsum(len_b[b])
    # The token of the other side that covers an end, and whether it ends there too: the ends of both.
    over_a, over_b = np.searchsorted(end_b, end_a), np.searchsorted(end_a, end_b)
    cut_a, cut_b = end_b[over_a] == end_a, end_a[over_b] == end_b
    at_a, at_b = np.flatnonzero(cut_a), np.flatnonzero(cut_b)
    # Each stretch up to the next end of either side is one link; an end of both is counted on the left.
    only_b = np.flatnonzero(~cut_b)
    key = np.concatenate((a * np.int64(len(len_b)) + b[over_a], a[over_b[only_b]] * np.int64(len(len_b)) + b[only_b]))
    texts = np.arange(rows)
    row = np.concatenate((np.repeat(texts, tokens.n_a), np.repeat(texts, tokens.n_b)[only_b]))
    n_groups = np.bincount(np.repeat(texts, tokens.n_a)[at_a], minlength=rows)

    # Tokens in the order in which they are written: each group's left ones, then its right ones.
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    to_a = np.arange(len(a)) + np.concatenate(([0], at_b + 1))[group_a]
    to_b = np.arange(len(b)) + at_a[group_b] + 1
    token, mark = np.empty(len(a) + len(b), np.int32), np.full(len(a) + len(b), ord(","), np.uint8)
    token[to_a], token[to_b] = a, b
    mark[to_a[at_a]], mark[to_b[at_b]] = ord("|"), ord(";")
    table, width = digits
    letters = table[token]
    letters[np.arange(len(token)), width[token]] = mark
    written = letters[np.arange(table.shape[1]) <= width[token][:, None]]
    letter_end = np.concatenate(([0], np.cumsum(width[token] + 1)))[np.cumsum(tokens.n_a + tokens.n_b)]
    starts = np.concatenate(([0], letter_end[:-1]))
    # The last mark is no part of the text.
    groups = [hashlib.sha256(written[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(starts, letter_end, strict=True)]
    return Alignment(n_groups, tokens.n_a + tokens.n_b - n_groups, groups, key, row)


@dataclass
class Planes:
    """Bitmaps of documents, in runs: run i is plane ``run_plane[i]`` of pair ``run_pair[i]`` and has ``run_size[i]`` places, or 0 and a bitmap."""

    run_pair: np.ndarray
    run_plane: np.ndarray
    run_size: np.ndarray
    places: np.ndarray
    bitmaps: np.ndarray

    def packed(self) -> list[bytes]:
        return [getattr(self, f.name).tobytes() for f in fields(self)]

    @classmethod
    def unpacked(cls, docs: int, columns: list[bytes]) -> Planes:
        kinds = (np.int32, np.uint8, np.int32, np.uint16, np.uint8)
        out = [np.frombuffer(c, k) for c, k in zip(columns, kinds, strict=True)]
        return cls(*out[:4], out[4].reshape(-1, (docs + 7) // 8 or 1))

    def postings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(pair, place, links)`` of each set bit; a bit of plane k stands for 2^k links."""
        pair, place, plane = np.repeat(self.run_pair, self.run_size), self.places, np.repeat(self.run_plane, self.run_size)
        dense = np.flatnonzero(self.run_size == 0)
        run, bit = np.nonzero(np.unpackbits(self.bitmaps, axis=1))
        pair = np.concatenate((pair, self.run_pair[dense][run]))
        plane = np.concatenate((plane, self.run_plane[dense][run]))
        return pair, np.concatenate((place, bit)), np.int64(1) << plane.astype(np.int64)


def index(key: np.ndarray, place: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Planes]:
    """``(pairs, documents of each, links of each, planes)`` of a block's links."""
    held, times = np.unique(key * BLOCK_DOCS + place, return_counts=True)
    pairs, pair = np.unique(held // BLOCK_DOCS, return_inverse=True)
    place = held % BLOCK_DOCS
    out = [np.zeros(0, np.int64)] * 4
    bitmaps = [np.zeros((0, (docs + 7) // 8 or 1), np.uint8)]
    for plane in range(int(times.max()).bit_length() if len(times) else 0):
        on = np.flatnonzero(times >> plane & 1)
        runs, starts, sizes = np.unique(pair[on], return_index=True, return_counts=True)
        dense = sizes * _SPARSE > docs
        few = np.repeat(~dense, sizes)
        for k, x in enumerate((runs, np.full(len(runs), plane), np.where(dense, 0, sizes), place[on][few])):
            out[k] = np.concatenate((out[k], x))
        # A bitmap for each dense run; there are at most 16 runs' worth of bits for each link.
        rows = np.repeat(np.cumsum(dense) - 1, sizes)[~few]
        bits = np.zeros((int(dense.sum()), 8 * bitmaps[0].shape[1]), bool)
        bits[rows, place[on][~few]] = True
        bitmaps.append(np.packbits(bits, axis=1))
    planes = Planes(out[0].astype(np.int32), out[1].astype(np.uint8), out[2].astype(np.int32), out[3].astype(np.uint16), np.concatenate(bitmaps))
    return pairs, np.bincount(pair, minlength=len(pairs)), np.bincount(pair, times, len(pairs)).astype(np.int64), planes


def blocks(docs: DataFrame, left: bytes, right: bytes) -> DataFrame:
    """Blocks of documents with their alignment and index; ``left`` and ``right`` are the files of the tokenizers."""
    most = BLOCK_LINKS

    def read(batches):
        sides = ByteLevel(left), Pieces(right)
        lengths = [side.lengths for side in sides]
        digits = _digits(max(map(len, lengths)))
        held, links, docs_held, number = [], 0, 0, TaskContext.get().partitionId() << 32

        def flush():
            columns = [np.concatenate(c) for c in zip(*((ids, t.n_a, t.n_b, x.n_groups, x.n_links) for ids, t, x, _ in held), strict=True)]
            groups = [g for _, _, x, _ in held for g in x.groups]
            n = len(columns[0])
            pairs, pair_docs, pair_links, planes = index(np.concatenate([x.key for *_, x, _ in held]), np.concatenate([x.row + base for *_, x, base in held]), n)
            ids = [None if i is None else int(i) for i in columns[0]]
            row = [number, ids, *columns[1:], groups, pairs, pair_docs, pair_links, *planes.packed()]
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _BLOCK_ARROW, strict=True)], schema=_BLOCK_ARROW)

        for batch in batches:
            for piece in pieces(pa.Table.from_batches([batch])):
                for at in range(0, piece.num_rows, BLOCK_DOCS):
                    part = piece.slice(at, BLOCK_DOCS)
                    if held and docs_held + part.num_rows > BLOCK_DOCS:
                        yield flush()
                        held, links, docs_held, number = [], 0, 0, number + 1
                    tokens = tokenized(part.column("text").to_pylist(), *sides)
                    found = align(tokens, *lengths, digits)
                    held.append((np.array(part.column("doc_id").to_pylist(), object), tokens, found, docs_held))
                    links, docs_held = links + len(found.key), docs_held + part.num_rows
                    if links >= most:
                        yield flush()
                        held, links, docs_held, number = [], 0, 0, number + 1
        if held:
            yield flush()

    return docs.select(docs.doc_id.cast("long").alias("doc_id"), "text").mapInArrow(read, _BLOCK)


def _pair_rows(indexed: DataFrame) -> DataFrame:
    return indexed.select("block", F.inline(F.arrays_zip("pairs", "pair_docs", "pair_links"))).withColumnRenamed("pairs", "pair")


def pair_counts(indexed: DataFrame, right_ids: int) -> DataFrame:
    """``pair, b, n_docs, n_links, best``: corpus counts of each pair, and whether no pair of its second id has more links."""
    counts = _pair_rows(indexed).groupBy("pair").agg(F.sum("pair_docs").alias("n_docs"), F.sum("pair_links").alias("n_links"))
    counts = keep(counts.withColumn("b", F.pmod("pair", F.lit(right_ids))))
    top = counts.groupBy("b").agg(F.max("n_links").alias("top"))
    # One form of join at every size.
    return counts.join(top.hint("merge"), "b").select("pair", "b", "n_docs", "n_links", (F.col("n_links") == F.col("top")).alias("best"))


def _score(block: pa.Table, scores: pa.Table) -> pa.Table:
    out = []
    for row in block.to_pylist():
        n = len(row["doc_ids"])
        pairs = np.array(row["pairs"], np.int64)
        at = np.searchsorted(pairs, scores.column("pair").to_numpy())
        count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
        count[at], best[at] = scores.column("n_links").to_numpy(), scores.column("best").to_numpy(zero_copy_only=False)
        pair, place, links = Planes.unpacked(n, [row[c] for c in _PLANES]).postings()
        # Floats hold each half of a count exactly.
        low, high = (np.bincount(place, links * half[pair], n).astype(np.int64) for half in (count & 0x3FFFFFF, count >> 26))
        n_best = np.bincount(place, links * best[pair], n).astype(np.int64)
        columns = [row["doc_ids"], *(row[c] for c in _DOCS), n_best, low + (high << 26), row["groups"]]
        out.append(pa.table([pa.array(c, f.type) for c, f in zip(columns, _ALIGNED_ARROW, strict=True)], schema=_ALIGNED_ARROW))
    return pa.concat_tables(out) if out else _ALIGNED_ARROW.empty_table()


def align_tokenizers(docs: DataFrame, left: bytes, right: bytes) -> tuple[DataFrame, DataFrame]:
    """``(documents, pairs)``.

    Documents: ``doc_id, n_a, n_b, n_groups, n_links``, ``n_best`` (links that no other pair of their second id outnumbers),
    ``count_sum`` (over the links, of their pair's corpus count) and the hashed groups. Pairs: ``a, b, n_docs, n_links, best``.
    """
    right_ids = len(Pieces(right).lengths)
    indexed = keep(blocks(docs, left, right))
    counts = keep(pair_counts(indexed, right_ids))
    asked = _pair_rows(indexed).select("block", "pair")
    scores = asked.join(counts.select("pair", "n_links", "best").hint("merge"), "pair").select(F.col("block").alias("of"), "pair", "n_links", "best")
    whole = indexed.select("block", "doc_ids", *_DOCS, "groups", "pairs", *_PLANES)
    aligned = whole.groupBy("block").cogroup(scores.groupBy("of")).applyInArrow(_score, _ALIGNED)
    return aligned, counts.select((F.col("pair") / right_ids).cast("long").alias("a"), "b", "n_docs", "n_links", "best")


def read_files(*paths: str) -> list[bytes]:
    """The tokenizers' files, which the driver holds."""
    out = []
    for path in paths:
        with open(path, "rb") as file:
            out.append(file.read())
    return out
