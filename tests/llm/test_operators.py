"""Each operator against a plain version, on rows with nulls, repeats, empty and long texts and odd columns."""

from __future__ import annotations

import base64
import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LAST = 1 << 62


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def bag(rows):
    return collections.Counter(rows)


def test_mixing(spark, docs, rows, none):
    from leadspark.llm.mixing import mix_sources

    got = mix_sources(docs)
    assert [c for c in got.columns if c in docs.columns and c != "size"] == [c for c in docs.columns if c != "size"]
    got = got.collect()
    size = collections.Counter()
    for r in rows:
        size[r[3]] += len(words(r[1]))
    names = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(size.values()), set()
    while True:
        level = (total - sum(2 * size[s] for s in full)) / sum(weight[s] for s in names if s not in full)
        more = {s for s in names if s not in full and weight[s] * level > 2 * size[s]}
        if not more:
            break
        full |= more
    target = {s: 2.0 * size[s] if s in full else weight[s] * level for s in names}
    taken = collections.Counter()
    for r in got:
        taken[r.source] += r.taken
        assert r.size == len(words(r.text)) and r.source_size == size[r.source] and r.taken <= 2 * r.size
        assert math.isclose(r.target, target[r.source])
    assert all(abs(taken[s] - target[s]) <= 64 for s in names)
    assert bag((r.doc_id, r.taken) for r in got) == bag((r.doc_id, r.taken) for r in mix_sources(docs).collect())
    assert mix_sources(none).collect() == []


def test_seats_follow_highest_quotients(spark):
    from leadspark.llm.mixing import seats

    claims = [53, 24, 23, 7, 1, 0, 0]
    df = spark.createDataFrame([(1, i, c, 17, 99) for i, c in enumerate(claims)], "g long, i long, claim long, total long, most long")
    got = {r.i: r.seats for r in seats(df, ["g"], "claim", "total", "most", ["i"]).collect()}
    won = [0] * len(claims)
    for _ in range(17):
        best = max(range(len(claims)), key=lambda i: (claims[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    assert [got[i] for i in range(len(claims))] == won


def test_decontamination(spark, docs, rows, none):
    from leadspark.llm.decontamination import decontaminate

    texts = [r[1] for r in rows]
    picked = [(1, " ".join(words(texts[2])[20:60]).upper()), (2, "W3"), (2, " ".join(words(texts[6])[:11])), (3, None), (4, "***"), (None, " ".join(words(texts[8])[:4])), (5, "nowhere at all")]
    items = spark.createDataFrame(picked, "item_id long, text string")
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = collections.defaultdict(set)
    for item, text in picked:
        w = pattern.findall((text or "").translate(LOWER))
        for i in range(len(w) - min(10, len(w)) + 1 if w else 0):
            windows[tuple(w[i : i + min(10, len(w))])].add(item)
    expected = []
    for r in rows:
        w = pattern.findall((r[1] or "").translate(LOWER))
        hit, found = [0] * len(w), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in windows:
                    found |= windows[k]
                    hit[i : i + n] = [1] * n
        names = sorted(str(x) for x in found if x is not None)
        expected.append((r[0], len(w), sum(hit), len(names), tuple(names), sum(hit) > 0))
    got = decontaminate(docs, items)
    assert got.columns[: len(docs.columns)] == docs.columns
    assert bag((r.doc_id, r.n_words, r.n_hit, r.n_items, tuple(r["items"]), r.contaminated) for r in got.collect()) == bag(expected)
    assert decontaminate(none, items).collect() == []
    assert {r.n_hit for r in decontaminate(docs, items.limit(0)).collect()} == {0}


def test_suffix_tree(spark, docs, rows, none):
    from leadspark.llm.suffix_tree import score_texts

    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tokens = [(r[0], words((r[1] or "").translate(LOWER)) + [None]) for r in rows]
    counts = collections.Counter(t for i, w in tokens if not out(i) for t in w)
    total, kinds = sum(counts.values()), len(counts)
    got = score_texts(docs, held, min_context=4).collect()
    assert len(got) == len(rows)
    expected = bag((i, out(i), len(w), sum(t in counts for t in w), total, round(sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in w), 5)) for i, w in tokens)
    assert bag((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == expected
    assert all(r.score < 0 for r in got) and sum(r.score for r in got) > sum(r.base_score for r in got)
    assert score_texts(none, held).collect() == []


def test_suffix_tree_chunks(spark, monkeypatch):
    """Scores don't depend on the chunks that documents are dealt into."""
    from leadspark.llm import suffix_tree

    rng = random.Random(5)
    kinds = [f"w{i}" for i in range(40)]
    passages = [" ".join(rng.choices(kinds, k=12)) for _ in range(20)]
    rows = [(i, " ".join(rng.choices(passages, k=40)) if i % 9 else None) for i in range(200)]
    docs = spark.createDataFrame([*rows, (7, rows[7][1]), (None, rows[1][1])], "doc_id long, text string")
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    one, many = [], []
    for found, size in ((one, suffix_tree.CHUNK), (many, 1 << 14)):
        monkeypatch.setattr(suffix_tree, "CHUNK", size)
        found.extend(suffix_tree.score_texts(docs, held).collect())
    rounded = lambda got: bag((*r[:6], round(r.base_score, 4), round(r.score, 4)) for r in got)
    assert rounded(one) == rounded(many) and len(one) == 202
    assert any(r.n_deep for r in one)


def test_suffix_tree_grows(spark):
    """The production parameters against a plain tree, on passages repeated a few times that only long contexts tell apart."""
    from leadspark.llm.suffix_tree import score_texts

    rng = random.Random(3)
    ways = [[f"{k}{i % 3}" for i in range(9)] + [f"end{k}"] for k in "abc"]
    middle = "so it was then".split()
    texts = [(i, " ".join([*ways[i % 3][: rng.randrange(3, 10)], *middle, f"end{i % 3}", f"x{rng.randrange(9)}", *ways[i % 3]])) for i in range(60)]
    held = F.col("doc_id") >= 45
    got = {r.doc_id: r for r in score_texts(spark.createDataFrame(texts, "doc_id long, text string"), held).collect()}
    rows = [(i, [*t.split(), None]) for i, t in texts]
    train = [w for i, w in rows if i < 45]
    grams = collections.Counter(tuple(w[k : k + n]) for w in train for n in range(1, 8) for k in range(len(w) - n + 1))
    total, kinds = sum(map(len, train)), len({t for w in train for t in w})
    weight = lambda c: c**0.8

    def chain(w, k, left, most=6):
        """The probability of w[k] from each context length on, as far as contexts are candidates."""
        out = [max(grams[(w[k],)] + 1 - left, 1) / (total + kinds + 1)]
        for n in range(1, most + 1):
            if k < n or grams[tuple(w[k - n : k])] < 2:
                break
            held = grams[tuple(w[k - n : k])]
            out.append((grams[tuple(w[k - n : k + 1])] - left + weight(held) * out[-1]) / (held - left + weight(held)))
        return out

    gain = collections.Counter()
    for w in train:
        for k in range(len(w)):
            p = chain(w, k, 1)
            for n in range(1, len(p)):
                gain[tuple(w[k - n : k])] += math.log(p[n] / p[n - 1])
    stays = {c for c, g in gain.items() if g >= 2}
    assert any(len(c) > 4 for c in stays)
    is_open = lambda w, k, n: n < 1 or tuple(w[k - n : k]) in stays
    for i, w in rows:
        score = deep = 0
        for k in range(len(w)):
            p, best = chain(w, k, 0), 0
            for n in range(1, len(p)):
                if not (is_open(w, k, n - 2) or is_open(w, k, n - 3)):
                    break
                best = n if tuple(w[k - n : k]) in stays else best
            score += math.log10(p[best])
            deep += best > 0
        assert math.isclose(got[i].score, score, rel_tol=1e-5), i
        assert got[i].n_deep == deep


def test_substrings(docs, rows, none):
    from leadspark.llm.substring_dedup import dedup_substrings

    first = {}
    for r in rows:
        w = words(r[1])
        for i in range(len(w) - 49):
            k = tuple(w[i : i + 50])
            first[k] = min(first.get(k, LAST), LAST if r[0] is None else r[0])
    expected = []
    for r in rows:
        w = words(r[1])
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < (LAST if r[0] is None else r[0]):
                gone[i : i + 50] = [True] * 50
        expected.append((r[0], len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    got = dedup_substrings(docs).collect()
    assert bag((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == bag(expected)
    assert all(sum(s["last"] - s["first"] + 1 for s in r.spans) == r.n_removed for r in got)
    assert dedup_substrings(none).collect() == []


def test_licenses(spark, docs, none):
    from leadspark.llm.licenses import scan_licenses

    known = spark.createDataFrame([("A", "Licensed under the A licence, 2.0.\nCopyright 2020 Someone"), ("B", "licensed under THE a license 2 0"), ("C", None), (None, "x")], "license_id string, text string")
    some = spark.createDataFrame([(1, "COPYRIGHT (c) 2024 Me\n  licensed under the A License -- 2.0"), (2, None), (3, "licensed under the A license 3.0"), (4, "!!"), (1, "x")], "doc_id long, text string")
    assert bag((r.doc_id, tuple(r.license_ids), r.licensed) for r in scan_licenses(some, known).collect()) == bag([(1, ("A", "B"), True), (2, (), False), (3, (), False), (4, (), False), (1, (), False)])
    assert scan_licenses(docs, known).count() == docs.count() and scan_licenses(none, known).collect() == []


@pytest.mark.parametrize("percent", [80, 40, 100])
def test_lines(docs, rows, none, percent):
    from leadspark.llm.line_dedup import dedup_lines

    seen, expected = [], []
    order = lambda r: (r[0] is None, r[0] or 0)
    distinct = {(r[0], r[1]): r for r in rows}
    lines = {}
    for (i, text), r in sorted(distinct.items(), key=lambda x: order(x[1])):
        kept = []
        for line in (text or "").split("\n"):
            w = words(line)
            s = frozenset(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))) if w else None
            near = s and any(100 * len(s & o) >= percent * len(s | o) for o in seen)
            if s:
                seen.append(s)
            if not near:
                kept.append(line)
        lines[(i, text)] = None if text is None else "\n".join(kept)
    expected = bag((r[0], lines[(r[0], r[1])]) for r in rows)
    clashing = docs.withColumns({c: F.lit(1) for c in ("gone", "k1", "doc", "line", "token")})
    got = dedup_lines(clashing, percent)
    assert got.columns[: len(clashing.columns)] == clashing.columns
    assert bag((r.doc_id, r.kept_text) for r in got.collect()) == expected
    assert dedup_lines(none, percent).collect() == []


def test_short_lines(spark):
    import corpus_pipeline
    from leadspark.llm.line_dedup import dedup_lines

    texts = [(1, "Les.\n\nThe end of it\n le s.", "en"), (2, " Les. \n\nthe end of it\nLes.\nThe  end of it", "en"), (3, "a b c d e\na b c d", "en"), (4, "a b c d\nb c d e\nLes.", "en"), (None, "Les.", "en")]
    some = spark.createDataFrame(texts, "doc_id long, text string, source string").withColumn("n_chars", F.char_length("text").cast("long"))
    got = {r.doc_id: (r.n_removed, r.kept_text) for r in dedup_lines(some).collect()}
    assert got == {1: (0, texts[0][1]), 2: (3, "\nthe end of it"), 3: (0, texts[2][1]), 4: (2, "b c d e"), None: (1, "")}
    stage = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, some, "").collect()}
    assert stage == {1: texts[0][1], 2: "\nthe end of it", 3: texts[2][1], 4: "b c d e"}


def test_lines_shared_words(spark, monkeypatch):
    """Unlike lines that share words aren't joined with their tokens; near copies among them go."""
    from leadspark.llm import line_dedup

    common = [f"c{i}" for i in range(60)]
    texts = [(i, " ".join([*common[:30], *(f"x{i}_{k}" for k in range(8)), *common[30:]])) for i in range(60)]
    texts += [(100 + i, t + " more") for i, t in texts[:5]]
    some = spark.createDataFrame(texts, "doc_id long, text string")
    listed, joined = [], type(some).join

    def join(left, other, on=None, how=None):
        if left.columns == ["k1", "k2", "p1", "p2"]:
            listed.extend(left.collect())
        return joined(left, other, on, how)

    monkeypatch.setattr(type(some), "join", join)
    got = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(some).collect()}
    assert got == {i: int(i >= 100) for i, _ in texts}
    assert 5 <= len(set(listed)) < 100


@pytest.mark.parametrize("n, percent", [(4, 85), (5, 80), (4, 30), (4, 50), (4, 100)])
def test_jaccard(spark, docs, rows, none, n, percent):
    from leadspark.llm.jaccard_join import similar_components

    short = [(100 + i, t) for i, t in enumerate(["a b c d e", "a b c d", "b c d e", "a b c d e f g", "p q r s t", "q r s t", "p q r s", "one two"])]
    rows = [r[:2] for r in rows] + short
    docs = docs.select("doc_id", "text", "size", "chunk").union(spark.createDataFrame([(*r, "x", "y") for r in short], "doc_id long, text string, size string, chunk string"))

    sets = {}
    for r in rows:
        w = words((r[1] or "").translate(LOWER))
        sets[r[0]] = frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) or frozenset([tuple(w)] if w else [])
    root = {i: i for i in sets if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in root:
        for b in root:
            if b < a and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and sets[b]:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    expected = bag((r[0], len(sets[r[0]]), None if r[0] is None else find(r[0])) for r in rows if r[0] is not None)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in similar_components(docs, n, percent).collect()]
    assert bag(x for x in got if x[0] is not None) == expected
    assert [x for x in got if x[0] is None and x[2] is not None] == [] and len(got) == len(rows)
    assert similar_components(none).collect() == []


def test_jaccard_shared_passage(spark, monkeypatch):
    """Unlike texts that share a passage are neither listed as pairs nor linked; near copies among them are."""
    from leadspark.llm import jaccard_join

    passage = [f"p{i}" for i in range(120)]
    own = lambda i: [f"x{i}_{k}" for k in range(12)]
    texts = [(i, " ".join([*passage[:60], *own(i), *passage[60:]])) for i in range(80)]
    texts += [(100 + i, t + " more") for i, t in texts[:5]]
    listed, verified = [], jaccard_join._verified
    monkeypatch.setattr(jaccard_join, "_verified", lambda pairs, *rest: (listed.extend(pairs.collect()), verified(pairs, *rest))[1])
    got = jaccard_join.similar_components(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i % 100 for i, _ in texts}
    assert len(set(listed)) < 100


def test_warc(spark, tmp_path):
    from leadspark.llm.warc import archive_pages

    pages = [(3, "http://a/ü b\r\nx", "same"), (1, None, "same"), (2, "u", None), (5, "u", ""), (4, "u", "a\r\n\r\nb" * 5000), (4, "u", "a\r\n\r\nb" * 5000), (None, "u", "same"), (None, "u", "alone")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2)
    first = {}
    for i, _, html in pages:
        if i is not None:
            first[html or ""] = min(first.get(html or "", LAST), i)
    expected = []
    for i, _, html in pages:
        data = (html or "").encode()
        keeper = first.get(html or "")
        response = keeper is None or keeper == i
        expected.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if response else "revisit", None if response else keeper, data if response else None))
    got = archive_pages(df, str(tmp_path)).collect()
    assert bag((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got) == bag(expected)
    assert archive_pages(df.limit(0)).collect() == []


def test_toxicity(spark, docs, none):
    from leadspark.llm.toxicity import fit, score_toxicity

    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    texts = [(i, f"some plain words number {i % 13} of text" + (" you vile, VILE! rat" if i % 3 == 0 else ""), i % 3 == 0) for i in range(300)]
    some = spark.createDataFrame([t[:2] for t in texts] + [(None, None), (None, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(t)) for i, _, t in texts] + [(None, 1), (7, None)], "doc_id long, toxic int")
    model = fit(some, labels, held)
    got = {r.doc_id: r for r in score_toxicity(some, model, held).collect()}
    assert all((got[i].score >= 0.3) == t for i, _, t in texts)
    span = got[0].spans[0]
    assert texts[0][1].encode()[span["at"] : span["end"]].decode().lower() in ("vile", "you", "rat")
    assert score_toxicity(docs, model, held).count() == docs.count() and score_toxicity(none, model, held).collect() == []
    assert fit(some, labels.limit(0), held) is None and {r.score for r in score_toxicity(docs, None, held).collect()} == {0.0}


def test_toxicity_uses_rare_words(spark, monkeypatch):
    from leadspark.llm import toxicity

    held = F.col("doc_id") >= 2400
    # 120 vile words, each in 4 of 480 toxic training documents: under 3% of them.
    texts = [(i, f"plain words number {i % 13} of text" + (f" vile{i // 5 % 120}" if i % 5 == 0 else ""), int(i % 5 == 0)) for i in range(3000)]
    some = spark.createDataFrame([t[:2] for t in texts] + [(None, None), (None, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in texts], "doc_id long, toxic int")
    out = []
    for most in (1 << 20, 5):
        monkeypatch.setattr(toxicity, "SENT_WORDS", most)
        model = toxicity.fit(some, labels, held)
        assert isinstance(model.evidence, toxicity.Evidence) == (most > 5)
        rows = toxicity.score_toxicity(some, model, held).collect()
        assert all((r.score >= 0.3) == (r.doc_id % 5 == 0) for r in rows if r.doc_id is not None)
        out.append(bag((r.doc_id, round(r.score, 6), r.n_toxic, str(r.spans)) for r in rows))
    assert out[0] == out[1]


def test_quality(docs, rows, none):
    from leadspark.llm.quality import judge_quality, measured

    expected = []
    for r in rows:
        w, seen, again = words(r[1]), set(), 0
        for line in (r[1] or "").split("\n"):
            if words(line):
                again += line in seen
                seen.add(line)
        runs, hit = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7)), [0] * len(w)
        for i in range(len(w) - 7):
            if runs[tuple(w[i : i + 8])] > 1:
                hit[i : i + 8] = [1] * 8
        expected.append((r[0], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", r[1] or "")), again, sum(hit), len(w) < 20 or 100 * sum(hit) > 30 * len(w)))
    got = judge_quality(measured(docs)).collect()
    assert bag((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == bag(expected)
    assert not any(r.kept and r.base_failed for r in got) and any(r.kept for r in got)
    assert judge_quality(measured(none)).collect() == []


def test_repeated_rows_leave_one(spark, docs, rows):
    import corpus_pipeline

    got = bag((r.doc_id, r.text) for r in corpus_pipeline.ngram_jaccard(spark, docs, "").collect())
    assert bag((r[0], r[1]) for r in rows)[(12, rows[12][1])] == 2 and got[(12, rows[12][1])] == 1
    assert max(n for (i, _), n in got.items() if i is not None) == 1 and sum(n for (i, _), n in got.items() if i is None) == 2


def test_pipeline(spark, docs, tmp_path):
    import corpus_pipeline

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "nothing like it")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert got and all(r.taken > 0 for r in got)
