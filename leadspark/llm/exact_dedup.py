"""Exact deduplication by composable polynomial fingerprints.

A text is normalised (each run of white space becomes one space) and read as the coefficients of a polynomial modulo
2^61 - 1, at two bases. The prints of two stretches combine: ``print(xy) = print(x) + base^len(x) * print(y)``. A text
of more than ``chunk_bytes`` is cut into chunks that any task may hash, and the chunks' prints are combined by their
length-shifted sum; others are hashed where they are read.

Texts of equal length and print are then compared in full, chunk by chunk: the chunks of all texts whose print occurs
twice stream through an aggregate, in which equal chunks collapse within their task before they are shuffled, so a
group of a third of all rows arrives as a row per task and chunk. Where a place of a print holds two different chunks,
the texts of this print are grouped by themselves instead.

Defined cases: a null text counts as empty. A null ``doc_id`` comes last. Of rows with one ``doc_id`` and equal texts,
one stays. Rows of one ``doc_id`` and different texts are texts of their own. An empty table gives an empty result.
Other columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leadspark.llm.words import SPACE, pieces, text_bytes
from leadspark.session import keep

_U = np.uint64
#: The modulus and the two bases, any numbers below it.
PRIME = (1 << 61) - 1
BASES = (1_402_946_387_093_527_281, 2_060_571_714_968_250_319)
CHUNK_BYTES = 1 << 16

_PRINT = ["n_bytes", "h1", "h2"]
_PRINTS = "doc_id long, n_bytes long, h1 long, h2 long, sha binary"
_PRINTS_ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("sha", pa.binary())])
_CUT = "doc_id long, raw binary, sha binary, chunk_no int, after_space boolean, chunk binary"
_CUT_ARROW = pa.schema([("doc_id", pa.int64()), ("raw", pa.binary()), ("sha", pa.binary()), ("chunk_no", pa.int32()), ("after_space", pa.bool_()), ("chunk", pa.binary())])
_HASHED = "doc_id long, raw binary, sha binary, chunk_no int, n_bytes long, h1 long, h2 long"
_HASHED_ARROW = pa.schema([("doc_id", pa.int64()), ("raw", pa.binary()), ("sha", pa.binary()), ("chunk_no", pa.int32()), ("n_bytes", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())])
_CHUNKS = "n_bytes long, h1 long, h2 long, chunk_no int, chunk binary"
_CHUNKS_ARROW = pa.schema([("n_bytes", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("chunk_no", pa.int32()), ("chunk", pa.binary())])


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _U(PRIME)) + (x >> _U(61))
    return np.where(x >= _U(PRIME), x - _U(PRIME), x)


def _shifted32(x: np.ndarray) -> np.ndarray:
    """``x * 2^32`` modulo the prime, for x below 2^63, not fully reduced."""
    return (x >> _U(29)) + ((x & _U((1 << 29) - 1)) << _U(32))


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of residues, by halves of 32 bits."""
    low = _U(0xFFFFFFFF)
    a0, a1, b0, b1 = a & low, a >> _U(32), b & low, b >> _U(32)
    middle = a1 * b0 + a0 * b1
    # 2^64 is 8 modulo the prime.
    return _reduced(_reduced(a1 * b1 * _U(8)) + _reduced(_shifted32(middle)) + _reduced(a0 * b0))


@cache
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The lower and upper halves of the first n powers of the base."""
    out = np.ones(1, _U)
    while len(out) < n:
        out = np.concatenate((out, times(out, np.full(len(out), pow(base, len(out), PRIME), _U))))
    return out[:n] & _U(0xFFFFFFFF), out[:n] >> _U(32)


def prints(data: np.ndarray, offsets: np.ndarray, base: int, longest: int) -> np.ndarray:
    """The print of each stretch of the bytes; no stretch is longer than ``longest``."""
    lengths = np.diff(offsets)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], lengths)
    value = data.astype(_U) + _U(1)
    sums = []
    for half in _powers(base, longest):
        total = np.zeros(len(data) + 1, _U)
        np.cumsum(half[place] * value, out=total[1:])
        sums.append(total[offsets[1:]] - total[offsets[:-1]])
    return _reduced(_reduced(sums[0]) + _reduced(_shifted32(sums[1])))


def combined(parts: list[tuple[int, int]], base: int) -> int:
    """The print of stretches one after the other, of which ``(length, print)`` is known."""
    out, shift = 0, 1
    for n, h in parts:
        out = (out + shift * h) % PRIME
        shift = shift * pow(base, n, PRIME) % PRIME
    return out


def squeezed(data: np.ndarray, offsets: np.ndarray, after_space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with one space for each run of white space; ``after_space``: a stretch goes on from white space."""
    space = SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = space[:-1]
    filled = np.diff(offsets) > 0
    before[offsets[:-1][filled]] = after_space[filled]
    stays = ~(space & before)
    ends = np.concatenate(([0], np.cumsum(stays)))
    return np.where(space, np.uint8(0x20), data)[stays], ends[offsets]


def _print_table(ids, data: np.ndarray, offsets: np.ndarray, longest: int, mask: int) -> pa.Table:
    shas = [hashlib.sha256(data[a:b]).digest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    h = [pa.array((prints(data, offsets, base, longest) & _U(mask)).view(np.int64)) for base in BASES]
    return pa.table([ids, pa.array(np.diff(offsets), pa.int64()), *h, pa.array(shas, pa.binary())], schema=_PRINTS_ARROW)


def _cut(data: np.ndarray, size: int) -> Iterator[tuple[int, bool, np.ndarray]]:
    """``(number, whether white space comes before, bytes)`` of each chunk of one text."""
    for number, at in enumerate(range(0, max(len(data), 1), size)):
        yield number, bool(at and SPACE[data[at - 1]]), data[at : at + size]


def _squeezed_chunk(chunk: np.ndarray, after_space: bool) -> np.ndarray:
    return squeezed(chunk, np.array([0, len(chunk)]), np.array([after_space]))[0]


def fingerprints(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, bits: int = 61) -> DataFrame:
    """``doc_id, n_bytes, h1, h2, sha`` of each row's normalised text; ``bits`` of each print count."""
    mask = (1 << bits) - 1
    docs = docs.select(docs.doc_id.cast("long").alias("doc_id"), "text")
    is_long = F.coalesce(F.octet_length("text") > chunk_bytes, F.lit(False))

    def whole(batches):
        for batch in batches:
            for piece in pieces(pa.Table.from_batches([batch])):
                data, offsets = text_bytes(piece.column("text"))
                data, offsets = squeezed(data, offsets, np.zeros(len(offsets) - 1, bool))
                yield from _print_table(piece.column("doc_id").combine_chunks(), data, offsets, chunk_bytes, mask).to_batches()

    def cut(batches):
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                sha = hashlib.sha256()
                for _, after, chunk in _cut(data, chunk_bytes):
                    sha.update(_squeezed_chunk(chunk, after))
                key, sha = hashlib.sha256(data).digest(), sha.digest()
                for number, after, chunk in _cut(data, chunk_bytes):
                    yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((doc_id, key, sha, number, after, chunk.tobytes()), _CUT_ARROW, strict=True)], schema=_CUT_ARROW)

    def hash_chunks(batches):
        for batch in batches:
            for piece in pieces(pa.Table.from_batches([batch]), "chunk"):
                data, offsets = text_bytes(piece.column("chunk").combine_chunks().cast(pa.large_binary()))
                data, offsets = squeezed(data, offsets, piece.column("after_space").to_numpy(zero_copy_only=False))
                columns = [piece.column(c).combine_chunks() for c in ("doc_id", "raw", "sha", "chunk_no")]
                h = [pa.array(prints(data, offsets, base, chunk_bytes).view(np.int64)) for base in BASES]
                yield from pa.table([*columns, pa.array(np.diff(offsets), pa.int64()), *h], schema=_HASHED_ARROW).to_batches()

    def combine(table):
        """Rows that repeat a text hold each of its chunks as often."""
        row = {c: table.column(c).to_pylist() for c in table.column_names}
        chunks = {k: i for i, k in enumerate(row["chunk_no"])}
        order = [chunks[k] for k in sorted(chunks)]
        n = sum(row["n_bytes"][i] for i in order)
        h = [combined([(row["n_bytes"][i], row[c][i]) for i in order], base) & mask for c, base in zip(("h1", "h2"), BASES, strict=True)]
        copies = row["chunk_no"].count(0)
        return pa.table([[x] * copies for x in (row["doc_id"][0], n, *h, row["sha"][0])], schema=_PRINTS_ARROW)

    short = docs.where(~is_long).mapInArrow(whole, _PRINTS)
    chunks = docs.where(is_long).mapInArrow(cut, _CUT).repartition("doc_id", "raw", "chunk_no").mapInArrow(hash_chunks, _HASHED)
    return short.unionByName(chunks.groupBy("doc_id", "raw").applyInArrow(combine, _PRINTS))


def _chunks_of(texts: DataFrame, chunk_bytes: int, mask: int) -> DataFrame:
    """The normalised chunks of the texts, each with its text's print."""

    def cut(batches):
        for batch in batches:
            for piece in pieces(pa.Table.from_batches([batch])):
                out = [[] for _ in _CHUNKS_ARROW]
                data, offsets = text_bytes(piece.column("text"))
                for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                    parts = [_squeezed_chunk(chunk, after) for _, after, chunk in _cut(data[a:b], chunk_bytes)]
                    ends = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
                    text = np.concatenate(parts)
                    h = [combined(list(zip(np.diff(ends).tolist(), prints(text, ends, base, chunk_bytes).tolist(), strict=True)), base) & mask for base in BASES]
                    for number, at in enumerate(range(0, max(len(text), 1), chunk_bytes)):
                        for column, x in zip(out, (len(text), *h, number, text[at : at + chunk_bytes].tobytes()), strict=True):
                            column.append(x)
                yield from pa.table(out, schema=_CHUNKS_ARROW).to_batches(max_chunksize=1024)

    return texts.mapInArrow(cut, _CHUNKS)


def false_prints(docs: DataFrame, members: DataFrame, chunk_bytes: int = CHUNK_BYTES, bits: int = 61) -> DataFrame:
    """The prints that different texts share, among those of the rows whose ``doc_id`` is in ``members``."""
    # One form of join at every size: the texts move once, the ids are narrow.
    wanted = members.select(F.col("doc_id").alias("_wanted")).hint("merge")
    texts = docs.select(docs.doc_id.cast("long").alias("doc_id"), "text")
    texts = texts.join(wanted, texts.doc_id.eqNullSafe(wanted["_wanted"]), "left_semi")
    chunks = _chunks_of(texts, chunk_bytes, (1 << bits) - 1)
    different = chunks.groupBy(*_PRINT, "chunk_no", "chunk").agg(F.lit(1).alias("one"))
    return different.groupBy(*_PRINT, "chunk_no").count().where("count > 1").select(*_PRINT).distinct()


def _groups(rows: DataFrame, same: list[str]) -> DataFrame:
    """Texts of more than one row, written, so that the joins with them can split a hot one."""
    groups = rows.groupBy(*same).agg(F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    return keep(groups.where("group_size > 1"))


def _verdicts(rows: DataFrame, groups: DataFrame, same: list[str]) -> DataFrame:
    """One row per document; ``rows`` has ``copies`` rows of one id and text as one."""
    joined = rows.join(groups, same, "left").select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("turn"))
    alone = F.col("group_size").isNull()
    keep_id = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    stays = F.col("doc_id").eqNullSafe(keep_id) & (F.col("turn") == 1)
    return joined.select("doc_id", keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), stays.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def dedup_exact(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, bits: int = 61) -> DataFrame:
    """``doc_id``, ``keep_id`` (the row that stays), ``group_size``, ``kept`` and ``text_sha256`` of each document.

    ``bits``: how many bits of each print count; results are the same for any, as equal prints are compared in full.
    """
    found = fingerprints(docs, chunk_bytes, bits)
    # Rows of one id and text are one row from here on; with bits left out, one id may have several texts to a print.
    rows = keep(found.groupBy("doc_id", *_PRINT, "sha").agg(F.count("*").alias("copies")))
    groups = _groups(rows, _PRINT)
    wrong = keep(false_prints(docs, rows.join(groups, _PRINT, "left_semi"), chunk_bytes, bits))
    if wrong.isEmpty():
        return _verdicts(rows, groups, _PRINT)
    right = _verdicts(rows.join(wrong, _PRINT, "left_anti"), groups, _PRINT)
    return right.unionByName(_by_text(docs, rows.join(wrong, _PRINT, "left_semi")))


def _by_text(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Verdicts on the rows of shared prints, grouped by their whole normalised texts."""
    texts = docs.select(docs.doc_id.cast("long").alias("doc_id"), F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ").alias("norm"))
    ids = rows.select(F.col("doc_id").alias("_wanted"), F.col("sha").alias("_sha")).distinct()
    sha = F.unhex(F.sha2("norm", 256))
    mine = texts.withColumn("sha", sha).join(ids, F.col("doc_id").eqNullSafe(F.col("_wanted")) & (F.col("sha") == F.col("_sha")), "left_semi")
    rows = keep(mine.groupBy("doc_id", "norm", "sha").agg(F.count("*").alias("copies")))
    return _verdicts(rows, _groups(rows, ["norm"]), ["norm"])
