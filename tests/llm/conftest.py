import random

import pytest

EXTRA = ["ids", "row", "cls", "keys", "_row", "_key", "_hash", "score", "chunk", "kind", "word", "bucket", "dedup_info"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", {c} string" for c in EXTRA)


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    words = ["".join(r.choice(["ka", "lo", "mi", "ten", "ur", "sha", "é"]) for _ in range(r.randint(1, 4))) for _ in range(n)]
    out, at = [], 0
    while at < n:
        k = r.randint(4, 14)
        out.append(" ".join(words[at:at + k]).capitalize() + ".")
        at += k
    return "\n".join(" ".join(out[i:i + 4]) for i in range(0, len(out), 4))


def edge_texts() -> list[tuple[int | None, str | None]]:
    """Nulls in both columns, empty and blank texts, ties, repeated rows, a very long
    text, one endless word, odd white space, a tokenizer's special string."""
    same = prose(1, 120)
    return [(1, None), (2, ""), (3, " \n\t "), (4, same), (5, same), (5, same), (None, same), (None, None),
            (6, prose(2, 30_000)), (7, "x" * 50_000), (8, "a <|endoftext|> b\u00a0c\u2003d  \n\n e"),
            (9, prose(3, 80) + "\n" + same), (10, "one. two. three."), (2**60 + 1, prose(4, 200))]


@pytest.fixture(scope="session")
def edge(spark):
    rows = [(k, t, None, None, None, *["z"] * len(EXTRA)) for k, t in edge_texts()]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    """Odd labels: nulls, repeats, values that are no class, ids of no document."""
    return spark.createDataFrame([(1, 1, 0), (4, 1, 0), (4, 1, 0), (None, 1, 1), (5, None, None), (99, 0, 1), (10, 0, 1), (9, 7, 7)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
