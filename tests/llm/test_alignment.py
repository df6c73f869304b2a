"""Alignment against counting every overlap of two tokens in plain Python."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest

FOLDER = "/opt/tokenizers"


@pytest.fixture(scope="module")
def files():
    from leadspark.llm.alignment import read_files

    return read_files(f"{FOLDER}/byte_bpe_50k.json", f"{FOLDER}/piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokens_of(files):
    """Each side's ``(id, first byte, last byte)`` of a text, or nothing."""
    import sentencepiece
    from tokenizers import Tokenizer

    left = Tokenizer.from_str(files[0].decode())
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_proto=files[1])

    def spans(text):
        out = []
        ids = left.encode(" " + text, add_special_tokens=False)
        # Each character of an entry stands for one byte.
        sizes = [[(i, len(t)) for i, t in zip(ids.ids, ids.tokens, strict=True)]]
        pieces = right.encode(text, out_type=str)
        raw = [bytes.fromhex(p[3:5]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in pieces]
        if b"".join(raw) != b" " + text.encode():
            return None
        sizes.append([(i, len(r)) for i, r in zip(right.encode(text), raw, strict=True)])
        for side in sizes:
            at, spots = 0, []
            for i, n in side:
                spots.append((i, at, at + n))
                at += n
            out.append(spots)
        return out

    return lambda text: spans(text) if text else None


def plain(rows, tokens_of):
    docs, counts = [], collections.Counter()
    for doc_id, text in rows:
        found = tokens_of(text)
        if not found:
            docs.append((doc_id, 0, 0, 0, [], ""))
            continue
        a, b = found
        first, links = 0, []
        for i, s, e in a:
            while b[first][2] <= s:
                first += 1
            k = first
            while k < len(b) and b[k][1] < e:
                links.append((i, b[k][0]))
                k += 1
        ends = {e for *_, e in a} & {e for *_, e in b}
        groups, side = [], [[], []]
        for e in sorted(ends):
            for k, spots in enumerate((a, b)):
                side[k] = [str(i) for i, _, x in spots if x <= e and x > (groups[-1][0] if groups else 0)]
            groups.append((e, f"{','.join(side[0])}|{','.join(side[1])}"))
        docs.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(";".join(g for _, g in groups).encode()).hexdigest()))
        counts.update(links)
    top = collections.Counter()
    for (_, j), c in counts.items():
        top[j] = max(top[j], c)
    out = [(i, a, b, g, len(links), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links), s) for i, a, b, g, links, s in docs]
    return collections.Counter(out), counts, docs


TEXTS = [
    "The quick brown fox", "the quick  brown\tfox\n\n", "", None, " ", "  two", "naïve façade, 日本語のテキスト and 😀😀!", "<|endoftext|> and <s> </s> <unk>", "a", "▁ odd mark",
    "näive   nbsp ﬁ ligature 　 wide", "the the the the", "x" * 500, "re-establish uncooperative 1234567890 http://a.b/c?d=e&f",
]


@pytest.mark.parametrize("most", [4_000_000, 50])
def test_against_plain(spark, docs, rows, files, tokens_of, most, monkeypatch):
    """Also with blocks of a text or two."""
    from leadspark.llm import alignment

    monkeypatch.setattr(alignment, "BLOCK_LINKS", most)
    texts = [(1000 + i, t) for i, t in enumerate(TEXTS)] + [(r[0], r[1] and r[1][:600]) for r in rows] + [(1000, TEXTS[0]), (None, "null id")]
    frame = spark.createDataFrame([(i, t, "clash", 1) for i, t in texts], "doc_id long, text string, pair string, block long")
    aligned, pairs = alignment.align_tokenizers(frame, *files)
    expected, counts, held = plain(texts, tokens_of)
    assert aligned.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert collections.Counter(tuple(r) for r in aligned.collect()) == expected
    in_docs = collections.Counter(p for *_, links, _ in held for p in set(links))
    assert {(r.a, r.b): (r.n_docs, r.n_links) for r in pairs.collect()} == {p: (in_docs[p], c) for p, c in counts.items()}


def test_empty_table(spark, none, files):
    from leadspark.llm.alignment import align_tokenizers

    assert [x.collect() for x in align_tokenizers(none, *files)] == [[], []]


def test_planes_hold_multiplicities():
    """Population counts of the planes give documents and links, and the postings give each document's links back."""
    from leadspark.llm.alignment import Planes, index

    rng = np.random.default_rng(6)
    key = np.concatenate((np.repeat(7, 4_000), rng.integers(0, 900, 3_000), [1_600_000_000] * 70))
    place = np.concatenate((rng.integers(0, 300, 4_000), rng.integers(0, 300, 3_000), [299] * 70))
    held = collections.Counter(zip(key.tolist(), place.tolist(), strict=True))
    pairs, docs, links, planes = index(key, place, 300)
    assert planes.bitmaps.size and planes.places.size
    again = Planes.unpacked(300, planes.packed())
    got = collections.Counter()
    for pair, at, n in zip(*(x.tolist() for x in again.postings()), strict=True):
        got[int(pairs[pair]), at] += n
    assert got == held
    assert dict(zip(pairs.tolist(), docs.tolist(), strict=True)) == collections.Counter(k for k, _ in held)
    assert dict(zip(pairs.tolist(), links.tolist(), strict=True)) == collections.Counter(key.tolist())


def test_encoder_by_rank_gives_the_ids_of_the_tokenizer(files):
    """Also for texts that it refuses."""
    from tokenizers import Tokenizer

    from leadspark.llm.alignment import ByteLevel

    plain = Tokenizer.from_str(files[0].decode())
    plain.encode_special_tokens = True
    rng = random.Random(1)
    pool = [chr(c) for c in range(0x20, 0x250)] + list("\t\n\r\x0b\x1c\x85\xa0\u2003\u3000\u200b日本한अ😀é'’") + [" "] * 60 + ["'s", "'ll", "<|endoftext|>"] * 5
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(1, 80))) for _ in range(1_500)]
    texts += [" " * 300_000, "\n" * 300_000 + "a", "x" * 100_000]
    assert [x.tolist() for x in ByteLevel(files[0]).encode(texts)] == [plain.encode(" " + t, add_special_tokens=False).ids for t in texts]
