"""Exact substring deduplication by fixed-block anchors.

Each text is cut into non-overlapping blocks of half a window; their hashes are the index. Every rolling run of a
block's length, at every place of every text, probes it. Any repeat of a whole window holds a whole block of the
earlier text, so all repeats are found. Hits are extended: the windows around a hit are compared by a 96-bit hash
with the windows of all other texts, and overlapping repeated windows join into maximal spans.

Defined cases: a null or empty text has no words and keeps the empty text. A text shorter than a window loses nothing.
A null ``doc_id`` counts as later than all others. Rows of one ``doc_id`` don't remove each other's words, as neither
is the smaller. Repeats within one text stay. Further columns are not carried; join on ``doc_id``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from leadspark.llm.rounds import Chunks, answer_of, answer_table, ask_table, document_words, grouped, unpacked, ASK
from leadspark.llm.words import covered, grams, pieces, whole, words_of

_LAST = np.iinfo(np.int64).max
RESULT = "doc_id long, n_words long, n_removed long, kept_text string, spans array<struct<first: long, last: long>>"
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()), ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))])


def dedup_substrings(docs: DataFrame, window: int = 50) -> DataFrame:
    """Remove every word in a window of so many words that also stands in a document of smaller ``doc_id``.

    Windows are judged on the texts as they came. Returns ``doc_id``, ``n_words``, ``n_removed``, ``kept_text`` (the
    words left, joined by one space) and ``spans`` (first and last word number of each removed stretch).
    """
    block = (window + 1) // 2
    chunks = Chunks(docs.select(docs.doc_id.cast("long").alias("doc_id"), "text"))
    n = chunks.n

    def runs(table):
        """Words, and the distinct block-long runs of the chunk with the places where they stand."""
        hashes, row, counts = document_words(table)
        places = np.flatnonzero(whole(row, block))
        keys, first, number = np.unique(grams(hashes, block)[places], return_index=True, return_inverse=True)
        return hashes, row, counts, places, keys, first, number

    def probe(table, _):
        hashes, row, counts, places, keys, first, number = runs(table)
        begins = np.concatenate(([0], np.cumsum(counts)))
        is_block = (places - begins[row[places]]) % block == 0
        flags = np.zeros(len(keys), np.uint8)
        flags[number[is_block]] = 1
        last = np.zeros(len(keys), np.int64)
        last[number] = row[places]
        flags[last != row[places[first]]] |= 2
        return ask_table(table.column("chunk")[0].as_py(), n, keys, np.uint32, flags=flags)

    def hits(asked):
        """Runs that are a block of one text and stand in another text too."""
        keys, starts = unpacked(asked.column("keys"), np.uint32)
        flags, _ = unpacked(asked.column("flags"), np.uint8)
        number, found = grouped(keys)
        many = np.bincount(number, minlength=found) > 1
        many[number[flags & 2 > 0]] = True
        indexed = np.zeros(found, bool)
        indexed[number[flags & 1 > 0]] = True
        return answer_table(asked, 1, starts, (many & indexed)[number].astype(np.uint8))

    def windows(table, answers):
        """The windows that hold a hit: words, window places, distinct windows with their least document."""
        hashes, row, counts, places, keys, _, number = runs(table)
        hit, _, _ = answer_of(answers, 1, keys, n, np.uint8)
        total = np.zeros(len(hashes) + 2, np.int64)
        total[places[hit[number] > 0] + 1] = 1
        total = np.cumsum(total)
        at = np.flatnonzero(whole(row, window))
        at = at[total[at + window - block + 1] > total[at]]
        ids = table.column("doc_id").fill_null(_LAST).to_numpy()
        key, number = np.unique(grams(hashes, window)[at], return_inverse=True)
        check = np.zeros(len(key), np.uint32)
        check[number] = grams(~hashes, window)[at].astype(np.uint32) if len(at) else 0
        least = np.full(len(key), _LAST, np.int64)
        np.minimum.at(least, number, ids[row[at]])
        return row, counts, ids, at, key, number, check, least

    def extend(table, answers):
        _, _, _, _, key, _, check, least = windows(table, answers)
        packed = np.rec.fromarrays([check, least], names="check,least")
        return ask_table(table.column("chunk")[0].as_py(), n, key, np.uint64, more=packed)

    def earlier(asked):
        """Which windows stand in a smaller document of another chunk."""
        keys, starts = unpacked(asked.column("keys"), np.uint64)
        more, _ = unpacked(asked.column("more"), np.dtype([("check", np.uint32), ("least", np.int64)]))
        number, found = grouped(keys, more["check"])
        least = np.full(found, _LAST, np.int64)
        np.minimum.at(least, number, more["least"])
        return answer_table(asked, 2, starts, (least[number] < more["least"]).astype(np.uint8))

    def remove(table, answers):
        row, counts, ids, at, key, number, _, least = windows(table, answers)
        smaller, _, _ = answer_of(answers, 2, key, n, np.uint8)
        gone = at[(smaller[number] > 0) | (least[number] < ids[row[at]])]
        gone = covered(gone, window, len(row))
        out, base, base_row = [], 0, 0
        for piece in pieces(table):
            w = words_of(piece.column("text"))
            own = gone[base : base + len(w.row)]
            out.append(_kept(piece, w, own))
            base, base_row = base + len(w.row), base_row + w.rows
        return pa.concat_tables(out) if out else _RESULT.empty_table()

    found = chunks.answered(chunks.apply(probe, ASK), hits)
    judged = chunks.answered(chunks.apply(extend, ASK, found), earlier)
    return chunks.apply(remove, RESULT, found.unionByName(judged))


def _kept(piece: pa.Table, w, gone: np.ndarray) -> pa.Table:
    ends = np.cumsum(w.per_row())
    data = w.data.tobytes()
    lost = np.concatenate(([0], np.cumsum(gone)))
    texts, spans, removed = [], [], []
    begin = 0
    for k, end in enumerate(ends):
        removed.append(int(lost[end] - lost[begin]))
        text = data[w.offsets[k] : w.offsets[k + 1]]
        if removed[-1]:
            own = gone[begin:end]
            texts.append(b" ".join([x for x, g in zip(text.split(), own.tolist(), strict=True) if not g]))
            edges = np.flatnonzero(np.diff(np.concatenate(([0], own.view(np.int8), [0]))))
            spans.append([{"first": int(a), "last": int(b) - 1} for a, b in edges.reshape(-1, 2)])
        else:
            texts.append(b" ".join(text.split()))
            spans.append([])
        begin = end
    return pa.table(
        [piece.column("doc_id").combine_chunks(), pa.array(w.per_row(), pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(spans, _RESULT.field("spans").type)],
        schema=_RESULT,
    )
