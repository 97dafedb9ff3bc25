"""Small tables that hold the awkward cases, and plain versions of what the operators return."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use themselves.
CLASH = ["chunk", "doc", "id", "h", "n", "sid", "digest", "kept", "rest", "bucket", "rid", "part", "rank", "key", "held_out", "f"]


def awkward() -> list[tuple]:
    """(doc_id, text): nulls, empties, white space, repeated rows and ids, copies, near copies, long texts."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(120)]
    out = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "One"), (6, "two words"), (None, "a text without an id " * 9), (7, "two  WORDS "), (8, "three small words")]
    for i in range(20, 40):  # a group of near copies
        edited = list(base)
        for _ in range(rng.randint(0, 3)):
            edited[rng.randrange(len(edited))] = rng.choice(words)
        out.append((i, " ".join(edited)))
    out += [(i, " ".join(base)) for i in range(50, 60)]  # copies
    out += [(70, "repeated row of some words"), (70, "repeated row of some words"), (71, "one id"), (71, "two texts")]
    passage = " ".join(rng.choice(words) for _ in range(30))
    out += [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) + "\n" + passage + " " + " ".join(rng.choice(words) for _ in range(20))) for i in range(80, 100)]
    out.append((101, " ".join(rng.choice(words) for _ in range(60_000))))  # long
    out.append((102, "x" * 300_000))  # one long word
    out.append((103, "é ü \x85 \x1c日本 𝄞 ▁ <|endoftext|> it's\x0b\x0cD'Or"))
    out += [(110 + i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 200)))) for i in range(40)]
    return out


def table(spark: SparkSession, rows: list[tuple], clash: bool = False) -> DataFrame:
    df = spark.createDataFrame([(i, x, "en", "src", len(x or "")) for i, x in rows], DOCS).repartition(3)
    return df.selectExpr("*", *[f"'{c}' AS `{c}`" for c in CLASH]) if clash else df


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    raw = (text or "").encode()
    return (raw.lower() if lower else raw).split()


def components(sets: list[frozenset], t: int) -> list[int]:
    """Least index reachable over links of 100 * intersection >= t * union."""
    parent = list(range(len(sets)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= t * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    return [find(i) for i in range(len(sets))]


def shingles(text: str | None, k: int) -> frozenset:
    w = words_of(text, lower=True)
    return frozenset(zip(*[w[j:] for j in range(k)])) if len(w) >= k else frozenset([tuple(w)] if w else [])


def kept_words(rows: list[tuple], window: int) -> list[tuple[int, int, bytes]]:
    """(words, removed, kept) of each row."""
    top = 2 ** 63 - 1
    first: dict[tuple, int] = defaultdict(lambda: top)
    each = [(top if i is None else i, words_of(x)) for i, x in rows]
    for i, w in each:
        for j in range(len(w) - window + 1):
            first[tuple(w[j:j + window])] = min(first[tuple(w[j:j + window])], i)
    out = []
    for i, w in each:
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if first[tuple(w[j:j + window])] < i:
                gone[j:j + window] = [True] * window
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g)))
    return out


@pytest.fixture(scope="session")
def rows():
    return awkward()
