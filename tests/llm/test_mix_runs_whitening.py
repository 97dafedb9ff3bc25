"""Source mixing, periodic runs and whitening against plain versions, on awkward rows, empty tables and clashing names."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from cases import CLASH, DOCS, rows, table, words_of  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigil.llm import mixing, queries, whitening
from vigil.llm.common import WordHasher, text_buffers
from vigil.llm.mixing import budgets, mix_sources, mixed_texts
from vigil.llm.periodic_runs import periodic_runs, runs_of
from vigil.llm.whitening import deviations, whiten

SF = "/root/testdata/sf0.001"


# --- source mixing

def water(sizes: dict, weights: dict, share: Fraction, most: int) -> dict:
    """Targets by the rule as it is stated: what a source cannot take is dealt again by weight."""
    out, full = {}, set()
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        parts = sum(weights[s] for s in sizes if s not in full)
        out = {s: Fraction(most * sizes[s]) if s in full else left * weights[s] / parts for s in sizes}
        above = {s for s in sizes if s not in full and out[s] > most * sizes[s]}
        if not above or not parts:
            return out
        full |= above


@settings(max_examples=12, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=9))
def test_budgets_fill_by_weight(spark, sizes):
    weights = {f"s{i}": (3, 1, 2)[i % 3] for i in range(len(sizes))}
    want = water({f"s{i}": n for i, n in enumerate(sizes)}, weights, Fraction(3, 2), 2)
    df = spark.createDataFrame([(f"s{i}", weights[f"s{i}"], n) for i, n in enumerate(sizes)], "source string, weight long, source_size long")
    for r in budgets(df).collect():
        assert r.target == pytest.approx(float(want[r.source]), rel=1e-12)
        assert abs(r.budget - want[r.source]) <= Fraction(1, 2) and r.budget <= 2 * r.source_size


def test_all_is_taken_if_more_is_asked_for_than_there_is(spark):
    df = spark.createDataFrame([("a", 3, 10), ("b", 1, 5)], "source string, weight long, source_size long")
    assert {r.source: (r.target, r.budget) for r in budgets(df, share=(5, 1)).collect()} == {"a": (20.0, 20), "b": (10.0, 10)}


def sources(spark, rows, clash=False):
    names = ["web", "code", None, "Books", "日本", "web"]
    return table(spark, rows, clash).withColumn("source", F.element_at(F.array(*[F.lit(n) for n in names]), (F.length(F.coalesce("text", F.lit(""))) % len(names) + 1).cast("int")))


def check_mix(out, share=Fraction(3, 2), most=2):
    sizes = defaultdict(int)
    for r in out:
        sizes[r.of] += r.size
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    want = water(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, share, most)
    taken = defaultdict(int)
    for r in out:
        assert r.source_size == sizes[r.of] and r.target == pytest.approx(float(want[r.of]), rel=1e-12)
        assert 0 <= r.taken <= most * r.size and r.taken == r.copies * r.size + r.part
        taken[r.of] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= Fraction(1, 2)


@pytest.mark.parametrize("clash", [False, True])
def test_mix_reaches_its_targets(spark, rows, clash):
    out = mix_sources(sources(spark, rows, clash), rest=True).withColumn("of", F.col("rest.source")).cache()
    got = out.collect()
    assert len(got) == len(rows)
    assert all(r.size == len(words_of(r.rest.text)) for r in got)
    check_mix(got)
    texts = Counter()
    for r in mixed_texts(out).collect():
        texts[r.doc_id] += len(words_of(r.mixed_text))
    taken = Counter()
    for r in got:
        taken[r.doc_id] += r.taken
    assert +texts == +taken
    again = mix_sources(sources(spark, rows[::-1], clash).repartition(5)).collect()
    assert Counter((r.doc_id, r.size, r.taken) for r in again) == Counter((r.doc_id, r.size, r.taken) for r in got)


def test_a_larger_mix_takes_what_a_smaller_one_takes(spark, rows):
    small, large = (Counter({(r.doc_id, r.size): r.taken for r in mix_sources(sources(spark, rows), weights=(1,), share=s, most=9).collect()}) for s in ((1, 3), (2, 3)))
    assert not small - large


def test_equal_rows_are_told_apart(spark):
    """A third of all rows are one row; its source ends inside them."""
    df = spark.createDataFrame([(1, "some repeated words", "a")] * 400 + [(i, f"w{i} x", "b") for i in range(2, 900)], "doc_id long, text string, source string")
    out = mix_sources(df, weights=(1, 5), share=(1, 1), rest=True).withColumn("of", F.col("rest.source")).collect()
    taken = [r.taken for r in out if r.doc_id == 1]
    want = round(next(r.target for r in out if r.doc_id == 1))
    assert 0 < want % 1200 and sum(taken) == want and sum(0 < t % 3 for t in taken) <= 1


def test_mix_of_nothing(spark):
    assert mix_sources(spark.createDataFrame([], DOCS)).collect() == []
    out = mix_sources(spark.createDataFrame([(1, None, "en", "a", 0), (2, " ", "en", None, 1)], DOCS)).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in out] == [(0, 0, 0.0, 0)] * 2


def test_refining_ends_at_the_boundary_row(spark, monkeypatch):
    """With two bits a histogram the boundary bucket is read again many times."""
    monkeypatch.setattr(mixing, "BITS", 2)
    df = spark.createDataFrame([(i, "w " * (1 + i % 7), f"s{i % 3}") for i in range(150)], "doc_id long, text string, source string")
    check_mix(mix_sources(df, rest=True).withColumn("of", F.col("rest.source")).collect())


# --- periodic runs

def plain_runs(w: list, least=6, times=4) -> list[tuple[int, int, int]]:
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if n >= max(least, times * q) and not any(all(w[x] == w[x + d] for x in range(i, i + n - d)) for d in range(1, q)):
                out.append((i, n, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(w: list, runs) -> list:
    gone = {x for s, n, q in runs for x in range(s + q, s + n)}
    return [x for i, x in enumerate(w) if i not in gone]


def found(texts):
    h, woff = WordHasher(False)(*text_buffers(pa.array(texts, pa.string())))
    out = [[] for _ in texts]
    for t, s, n, q in zip(*runs_of(h, woff).tolist()):
        out[t].append((s, n, q))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=70), min_size=1, max_size=4), st.lists(st.tuples(st.text(alphabet="abc", min_size=1, max_size=9), st.integers(1, 9)), max_size=6))
def test_runs_of_small_alphabets(texts, pieces):
    texts = [" ".join(x) for x in texts] + [" ".join("".join(p * n for p, n in pieces))]
    assert found(texts) == [plain_runs(words_of(x)) for x in texts]


def test_runs_of_words_that_look_periodic():
    fib, thue = ["a", "b"], "0"
    for _ in range(14):
        fib.append(fib[-1] + fib[-2])
    for _ in range(9):
        thue += "".join("10"[int(c)] for c in thue)
    rng = random.Random(3)
    long = [rng.choice("abcdefgh") for _ in range(37)]
    texts = [" ".join(fib[-1][:600]), " ".join(thue), " ".join(long * 11 + ["x"] + long * 4), " ".join((long * 5)[:-1]), " ".join("aab" * 30 + "aabaab" * 3 + "ab" * 30)]
    assert found(texts) == [plain_runs(words_of(x)) for x in texts]


@pytest.mark.parametrize("clash", [False, True])
def test_periodic_runs_of_awkward_rows(spark, rows, clash):
    more = [(200, "ha " * 500), (201, "la la la la la"), (202, "a b " * 3 + "a"), (203, "日 本 " * 9 + "x"), (204, "one " * 6), (204, "one " * 6), (None, "go go go go go go stop"),
            (205, "k " * 50_000), (206, ("p q r s t " * 700 + "u ") * 4 + "x" * 2_000_000)]
    rows = [*rows, *more]
    out = periodic_runs(table(spark, rows, clash), keep=("doc_id", "text")).collect()
    assert Counter((r.doc_id, r.text) for r in out) == Counter(rows)
    for r in out:
        w = words_of(r.text)
        runs = plain_runs(w) if len(w) < 700 else [tuple(x) for x in r.runs]
        assert [tuple(x) for x in r.runs] == runs and r.n_words == len(w)
        assert r.collapsed.encode() == b" ".join(collapse(w, runs))
    one = next(r for r in out if r.doc_id == 205)
    assert [tuple(x) for x in one.runs] == [(0, 50_000, 1)] and one.collapsed == "k"
    four = next(r for r in out if r.doc_id == 206)
    assert [tuple(x) for x in four.runs] == [(0, 14004, 3501)] + [(i * 3501, 3500, 5) for i in range(4)] or sorted(map(tuple, four.runs)) == sorted([(0, 14004, 3501)] + [(i * 3501, 3500, 5) for i in range(4)])
    assert periodic_runs(spark.createDataFrame([], DOCS)).collect() == []
    with pytest.raises(ValueError):
        runs_of(np.zeros(3, np.uint64), np.array([0, 3]), times=2)


def plain_op12(doc_id, text) -> tuple:
    w = words_of(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(collapse(w, runs))).hexdigest())


def test_op12_query_against_its_definition(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(0, 90)))) for i in range(400)]
    rows += [(None, "b b b b b b b"), (401, None), (402, ""), (403, " \n "), (404, "one")]
    spark.createDataFrame([(i, x, "en", "src", 0) for i, x in rows], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(tuple(r) for r in queries.op12(spark, str(tmp_path)).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect())
    assert got == Counter(plain_op12(i, x) for i, x in rows)


def test_op12_query_on_the_given_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = {r.doc_id: plain_op12(r.doc_id, r.text) for r in docs if len(words_of(r.text)) <= 1200}
    got = {r.doc_id: r for r in queries.op12(spark, SF).collect()}
    assert len(got) == len(docs) and len(short) > len(docs) / 2
    for i, want in short.items():
        assert tuple(got[i]) == want


# --- whitening

def plain_whitening(m: np.ndarray, k: int = 8):
    x = np.floor(1024 * m).astype(np.int64) + 100000
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s) / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    return n, [sum(int(a) ** 2 for a in row) for row in (n * x - s).tolist()], c @ v / np.sqrt(e), e / (np.square(c).sum() / n)


def compare_whitening(out, ids, m, k=8):
    n, dev, white, explained = plain_whitening(m, k)
    got = defaultdict(dict)
    for r in out:
        got[r.vec_id][r.component] = r
    assert sorted(got) == sorted(ids) and all(sorted(x) == list(range(1, len(explained) + 1)) for x in got.values())
    w = np.array([[got[i][c + 1].whitened for c in range(len(explained))] for i in ids])
    assert np.abs(w * np.sign((w * white).sum(axis=0)) - white).max() < 1e-7
    for j, i in enumerate(ids):
        for c, r in got[i].items():
            assert (r.n, r.deviation) == (n, dev[j]) and r.explained == pytest.approx(explained[c - 1], rel=1e-9) and 0 <= r.identity_error < 1e-9


VECTORS = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("block", [None, 1, 3])
def test_whitening_against_eigenvectors(spark, block):
    """A decaying spectrum in 40 dimensions: the process ends before it has all of them."""
    rng = np.random.default_rng(4)
    m = rng.normal(size=(300, 40)) * 0.5 ** (np.arange(40) / 2) * 50 + rng.normal(size=40)
    df = spark.createDataFrame([(i, x.tolist(), 0) for i, x in enumerate(m)], VECTORS).repartition(3)
    compare_whitening(whiten(df, block=block).collect(), list(range(300)), m)


def test_whitening_of_awkward_rows(spark):
    rng = np.random.default_rng(6)
    m = rng.normal(size=(50, 12))
    rows = [(i, x.tolist(), 0) for i, x in enumerate(m)]
    bad = [(90, None, 0), (91, [], 0), (92, [1.0] * 11 + [None], 0), (93, [float("nan")] + [1.0] * 11, 0), (94, [float("inf")] * 12, 0)]
    df = spark.createDataFrame(rows + bad, VECTORS).selectExpr("*", *[f"1 AS `{c}`" for c in CLASH], "2 AS dim", "3 AS at", "4 AS v", "5 AS n").repartition(4)
    compare_whitening(whiten(df).collect(), list(range(50)), m)
    other = [(100 + i, x.tolist(), 0) for i, x in enumerate(m[:20, :5])]  # another length is a table of its own
    out = whiten(spark.createDataFrame(rows + other, VECTORS)).collect()
    compare_whitening([r for r in out if r.vec_id < 100], list(range(50)), m)
    compare_whitening([r for r in out if r.vec_id >= 100], list(range(100, 120)), m[:20, :5], k=5)
    assert whiten(spark.createDataFrame([], VECTORS)).collect() == []
    assert whiten(spark.createDataFrame([(1, [2.0, 3.0], 0)] * 4, VECTORS)).collect() == []  # no variance
    flat = whiten(spark.createDataFrame([(None, [float(i), 7.0, 2.0 * i], 0) for i in (1, 2, 2, 5)], VECTORS)).collect()
    assert [(r.vec_id, r.component, r.n) for r in flat] == [(None, 1, 4)] * 4 and all(r.explained == pytest.approx(1.0) for r in flat)
    huge = whiten(spark.createDataFrame([(i, [1e300 * i, float(i), -float(i * i)], 0) for i in range(6)], VECTORS)).collect()
    assert len({r.vec_id for r in huge}) == 6 and all(np.isfinite(r.whitened) for r in huge)


def test_deviations_are_exact_or_the_greatest_long():
    c = np.array([[3, -4], [2 ** 30, 1], [2 ** 31, 2 ** 31 - 1], [2 ** 31, 2 ** 31], [2 ** 40, 0]])
    assert deviations(c).tolist() == [25, 2 ** 60 + 1, 2 ** 63 - 2 ** 32 + 1, whitening.LONG, whitening.LONG]
    assert deviations(c[:2]).tolist() == [25, 2 ** 60 + 1]


def test_op13_query_on_the_given_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    compare_whitening(queries.op13(spark, SF).collect(), [r.vec_id for r in rows], np.array([r.embedding for r in rows], float))
