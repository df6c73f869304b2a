"""Questions that groups of documents put to the whole corpus, and their answers.

Documents are dealt into chunks by a hash of their row. A chunk asks about many keys at once: it packs the keys of
one hash bucket into one binary value, so that a key costs a few bytes in the shuffle and no row of its own. A bucket
sees all chunks' keys of its hash range and answers in the order asked. A key is sent once by a chunk, whatever
number of its documents hold it, so no key is hot. Chunks and buckets are as many as the corpus needs, each of bounded
size. All rounds are one lazy plan, in which Spark reuses the exchanges; a lost executor costs a recomputed part.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from leadspark.llm.words import pieces, words_of
from leadspark.session import shared_folder, shuffles_dropped

ASK = "bucket long, chunk long, keys binary, more binary, flags binary"
ANSWER = "chunk long, turn int, bucket long, answer binary, total double, kinds double"

_ask_arrow = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("more", pa.binary()), ("flags", pa.binary())])
_answer_arrow = pa.schema([("chunk", pa.int64()), ("turn", pa.int32()), ("bucket", pa.int64()), ("answer", pa.binary()), ("total", pa.float64()), ("kinds", pa.float64())])

SMALLEST_CHUNK, LARGEST_CHUNK = 1 << 20, 32 << 20


class Chunks:
    """Documents dealt into ``n`` chunks; ``rows`` has the columns of ``docs``, ``doc_id`` and ``text`` among them, and ``chunk``."""

    def __init__(self, docs: DataFrame, deal_by: tuple[Column, ...] | None = None, smallest: int = SMALLEST_CHUNK):
        spark = docs.sparkSession
        total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
        size = min(LARGEST_CHUNK, max(smallest, math.isqrt(total * 1024)))
        self.n = max(1, math.ceil(total / size))
        self.parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(self.n / 64))
        self.deal_by = deal_by or (F.col("doc_id"), F.octet_length("text"), F.substring("text", 1, 64))
        self.rows = docs.withColumn("chunk", self.chunk(*self.deal_by)).repartition(self.parts, "chunk")

    def chunk(self, *key: Column) -> Column:
        return F.pmod(F.xxhash64(*key), F.lit(self.n))

    def apply(self, work: Callable[[pa.Table, pa.Table | None], pa.Table], schema: str, answers: DataFrame | None = None) -> DataFrame:
        """``work(documents, answers)`` for each chunk."""
        if answers is None:
            return self.rows.groupBy("chunk").applyInArrow(lambda table: work(table, None), schema)
        return self.rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(work, schema)

    def keep(self, rows: DataFrame) -> DataFrame:
        """Write the rows as a table dealt by chunk and read it back: later rounds take it without a shuffle."""
        spark, path = rows.sparkSession, shared_folder(rows.sparkSession)
        name = path.rsplit("/", 1)[1].replace("-", "_")
        with shuffles_dropped(spark):
            rows.repartition(self.parts, "chunk").write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(self.parts, "chunk").saveAsTable(name)
        kept = spark.table(name)
        # The name goes, the files stay.
        spark.sql(f"DROP TABLE {name}")
        return kept

    def answers(self, asked: DataFrame, answer: Callable[[pa.Table], pa.Table]) -> DataFrame:
        return asked.repartition(self.parts, "bucket").groupBy("bucket").applyInArrow(answer, ANSWER)

    def answered(self, asked: DataFrame, answer: Callable[[pa.Table], pa.Table]) -> DataFrame:
        """The answers, dealt by chunk."""
        return self.answers(asked, answer).repartition(self.parts, "chunk")


def order(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``(places, bounds)``: the keys' places by bucket, kept in order within, and where each bucket begins."""
    # Two bytes are sorted by digits.
    bucket = ((keys >> np.uint64(40)) % np.uint64(n)).astype(np.uint16 if n <= 1 << 16 else np.int64)
    places = np.argsort(bucket, kind="stable")
    return places, np.concatenate(([0], np.cumsum(np.bincount(bucket, minlength=n))))


def ask_table(chunk: int, n: int, keys: np.ndarray, key_type, more: np.ndarray | None = None, flags: np.ndarray | None = None) -> pa.Table:
    """One row for each bucket that has keys; ``more`` and ``flags`` go along with the keys."""
    places, bounds = order(keys, n)
    packed = keys[places].astype(key_type)
    more = None if more is None else more[places]
    flags = None if flags is None else flags[places]
    chosen = np.flatnonzero(np.diff(bounds))
    cut = lambda x: [None if x is None else x[bounds[b] : bounds[b + 1]].tobytes() for b in chosen]
    return pa.table([pa.array(chosen, pa.int64()), pa.array(np.full(len(chosen), chunk), pa.int64()), *(pa.array(cut(x), pa.binary()) for x in (packed, more, flags))], schema=_ask_arrow)


def unpacked(column, dtype) -> tuple[np.ndarray, np.ndarray]:
    """``(values of all rows, where each row begins)``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    parts = [np.frombuffer(x or b"", dtype) for x in column.to_pylist()]
    return (np.concatenate(parts) if parts else np.zeros(0, dtype)), np.concatenate(([0], np.cumsum([len(x) for x in parts]))).astype(np.int64)


def grouped(*keys: np.ndarray) -> tuple[np.ndarray, int]:
    """``(the number of each row's key, how many keys there are)``."""
    if not len(keys[0]):
        return np.zeros(0, np.int64), 0
    by = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0])
    new = np.zeros(len(by), bool)
    for k in keys:
        s = k[by]
        new[1:] |= s[1:] != s[:-1]
    number = np.empty(len(by), np.int64)
    number[by] = np.cumsum(new)
    return number, int(number[by[-1]]) + 1


def answer_table(asked: pa.Table, turn: int, starts: np.ndarray, values: np.ndarray, total: float = 0.0, kinds: float = 0.0, planes: bool = False) -> pa.Table:
    """The answer to each row of questions: ``values`` cut at ``starts``. ``planes`` packs them byte by byte, the last bytes of
    all values first, so that many small values compress well; ``answer_of`` is told so too.
    """
    n = len(starts) - 1
    cut = [values[starts[i] : starts[i + 1]] for i in range(n)]
    cut = [(x.view(np.uint8).reshape(len(x), -1).T if planes else x).tobytes() for x in cut]
    full = lambda v, t: pa.array(np.full(n, v), t)
    return pa.table([asked.column("chunk").combine_chunks(), full(turn, pa.int32()), asked.column("bucket").combine_chunks(), pa.array(cut, pa.binary()), full(total, pa.float64()), full(kinds, pa.float64())], schema=_answer_arrow)


def answer_of(answers: pa.Table, turn: int, keys: np.ndarray, n: int, dtype, planes: bool = False) -> tuple[np.ndarray, float, float]:
    """``(the answer to each key, sums of total and kinds over the buckets)`` of one turn."""
    mine = answers.filter(pa.compute.equal(answers.column("turn"), turn))
    out = np.zeros(len(keys), dtype)
    places, bounds = order(keys, n)
    for bucket, packed in zip(mine.column("bucket").to_pylist(), mine.column("answer").to_pylist(), strict=True):
        if planes:
            packed = np.frombuffer(packed, np.uint8).reshape(np.dtype(dtype).itemsize, -1).T.tobytes()
        out[places[bounds[bucket] : bounds[bucket + 1]]] = np.frombuffer(packed, dtype)
    return out, float(np.sum(mine.column("total").to_numpy())), float(np.sum(mine.column("kinds").to_numpy()))


def document_words(table: pa.Table, fold: bool = False):
    """All words of a chunk: ``(hashes, number of the document's row, words per row)``, made piece by piece."""
    hashes, rows, counts, base = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for piece in pieces(table):
        w = words_of(piece.column("text"), fold)
        hashes.append(w.hash)
        rows.append(w.row + base)
        counts.append(w.per_row())
        base += w.rows
    return np.concatenate(hashes), np.concatenate(rows), np.concatenate(counts)
