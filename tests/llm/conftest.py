from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, words string, chunk string"


@pytest.fixture(scope="session")
def rows():
    """Documents with nulls, empty and long texts, copies, near copies, shared passages and repeated rows."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)] + ["The", "the", "of", "é", "ÉÀ", "a,b", "***"]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, base = prose(70), prose(200)
    out = []
    for i in range(60):
        kind = i % 10
        if kind == 0:
            text = base if i else base + " end"
        elif kind == 1:
            changed = base.split(" ")
            changed[rng.randrange(200)] = f"x{i}"
            text = " ".join(changed)
        elif kind == 2:
            text = f"{prose(30)}\n{passage}\n{prose(30)}"
        elif kind == 3:
            text = ["", None, " \n\t ", "one", "a b c", "The of"][i // 10]
        elif kind == 4:
            text = "\n".join([prose(12)] * 3 + [passage])
        elif kind == 5:
            text = prose(8) + " " + " ".join(["again and"] * 20)
        else:
            text = "\n".join(prose(rng.randrange(1, 40)) for _ in range(rng.randrange(1, 6)))
        out.append((i, text, None if i % 7 == 0 else "en", None if i % 9 == 0 else f"s{i % 4}", None, "x", "y", "z"))
    out.append((60, prose(20_000), "en", "s1", 1, "x", "y", "z"))
    out.append(out[12])
    out.append((None, base, "en", None, 2, "x", "y", "z"))
    out.append((None, None, None, None, None, None, None, None))
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
