"""Vector searches and url filters against plain versions."""

from __future__ import annotations

import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigil.llm.hash_forest import HashForest, nearest, projections
from vigil.llm.kd_trees import KDTree, exact_top, scaled
from vigil.llm.queries import ORACLES, QUERIES
from vigil.llm.url_filter import RULES, lexical, parts, url_verdicts
from vigil.llm.vector_shards import _deal, merged

VECTORS = "vec_id long, embedding array<double>, label int"
SF = "/root/testdata/sf0.01"


def vectors(spark, rows, clash=True):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], VECTORS).repartition(3)
    return df.selectExpr("*", "1 AS shard", "2 AS id", "3 AS kind", "4 AS dim", "5 AS asks", "6 AS rank", "7 AS score") if clash else df


def awkward_vectors():
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8)) for i in range(1, 400)]
    rows += [(i, rows[0][1]) for i in range(400, 460)]  # copies
    rows += [(500, None), (501, []), (502, [0.0] * 8), (503, [1.0, None] + [0.0] * 6), (504, [float("nan")] * 8), (505, [float("inf")] * 8), (None, [1.0] * 8),
             (550, [1.0, 2.0]), (600, [2.0, 1.0]), (650, [0.0, 1.0])]
    return rows


def usable(rows, zero=False):
    out = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v)):
            out[i] = np.asarray(v, float)
    return out


def brute(vs, asks, k, score):
    return brute_rows(list(vs.items()), asks, k, score)


def brute_rows(rows, asks, k, score):
    """Ids may repeat: an id counts with its best row, for the best row of a query id."""
    out, found = set(), {}
    for q, a in rows:
        for i, v in rows if asks(q) else ():
            if i != q and len(v) == len(a):
                best = found.setdefault(q, {})
                best[i] = max(best.get(i, -np.inf), score(a, v))
    for q, best in found.items():
        s = sorted((-x, i) for i, x in best.items())[:k]
        out |= {(q, r, i, -x) for r, (x, i) in enumerate(s, 1)}
    return out


def repeated_rows():
    """An id with a large score has thirty rows, another is a query with three, and rows repeat as a whole."""
    rng = np.random.default_rng(11)
    rows = [(i, rng.normal(size=6)) for i in range(200)]
    rows += [(777, 5 + rng.normal(size=6) / 100) for _ in range(30)] + [(50, rng.normal(size=6)) for _ in range(2)]
    return rows + rows[:20] + [rows[210]] * 50


@pytest.mark.parametrize("shard", [16, 64, 4096])
def test_repeated_ids_cost_no_results(spark, shard):
    rows = repeated_rows()
    got = {(r.query_id, r.rank, r.vec_id, r.score) for r in exact_top(vectors(spark, rows), F.col("vec_id") % 50 == 0, 10, shard=shard).collect()}
    assert got == brute_rows(rows, lambda q: q % 50 == 0, 10, integers)
    got = {(r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in nearest(vectors(spark, rows), F.col("vec_id") % 50 == 0, 5, fraction=1.0, shard=shard).collect()}
    assert got == brute_rows(rows, lambda q: q % 50 == 0, 5, cosine)


def test_rows_of_one_id_are_spread_and_equal_rows_sent_once(spark):
    rng = np.random.default_rng(2)
    rows = [(7, rng.normal(size=4)) for _ in range(5000)] + [(100, np.array([1.0, 0.0, 0.0, 0.0]))] + [(200 + i, rng.normal(size=4)) for i in range(50)]
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in exact_top(vectors(spark, rows, clash=False), F.col("vec_id") == 100, 10, shard=64).collect()]
    assert set(got) == brute_rows(rows, lambda q: q == 100, 10, integers)
    places = {r.s: r.n for r in vectors(spark, rows).select(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(79)).alias("s")).groupBy("s").agg(F.count("*").alias("n")).collect()}
    assert max(places.values()) < 5 * 64
    batch = pa.RecordBatch.from_pydict({"id": [1] * 9000 + [2], "vector": [[1.0, 2.0]] * 9001, "shard": pa.array([0] * 9001, pa.int32()), "asks": [True] * 9001})
    sent = [r for b in _deal()(iter([batch])) for r in b.to_pylist()]
    assert [(r["kind"], len(r["ids"]) // 8) for r in sent] == [(0, 2), (1, 2)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4), st.integers(-3, 3)), max_size=30), st.integers(1, 4))
def test_merged_lists_hold_k_different_ids(rows, k):
    q, i, s = (np.array([r[x] for r in rows], np.int64) for x in range(3))
    best = {}
    for a, b, c in rows:
        best[a, b] = max(best.get((a, b), c), c)
    want = [(a, b, c) for a in sorted({x[0] for x in best}) for c, b in sorted(((-c, b) for (x, b), c in best.items() if x == a))[:k] for c in [-c]]
    assert list(zip(*[x.tolist() for x in merged(q, i, s, k)])) == want
    assert list(zip(*[x.tolist() for x in merged(q, i, s.astype(float), k)])) == want


def cosine(a, b):
    return round(float((a * b).sum() / np.sqrt((a * a).sum()) / np.sqrt((b * b).sum())), 9)


@pytest.mark.parametrize("shard", [64, 4096])
def test_forest_that_takes_all_candidates_is_exact(spark, shard):
    rows = awkward_vectors()
    got = {(r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in nearest(vectors(spark, rows), F.col("vec_id") % 50 == 0, 5, fraction=1.0, shard=shard).collect()}
    assert got == brute(usable(rows), lambda q: q % 50 == 0, 5, cosine)


def test_forest_recall(spark):
    pq = spark.read.parquet(f"{SF}/embeddings.parquet")
    vs = {r.vec_id: np.array(r.embedding, float) for r in pq.collect()}
    want = {(q, i) for q, _, i, _ in brute(vs, lambda q: q % 50 == 0, 5, cosine)}
    got = {(r.query_id, r.vec_id): r.score for r in QUERIES["op3_hash_prefix_forest"](spark, SF).collect()}
    assert len(want & set(got)) >= 0.9 * len(want)
    assert all(s == pytest.approx(cosine(vs[q], vs[i]), abs=1e-8) for (q, i), s in got.items())


def test_forest_ascends_no_further_than_needed():
    rng = np.random.default_rng(0)
    m = rng.normal(size=(2000, 16))
    few, all_ = HashForest(np.arange(2000), m, fraction=0.1), HashForest(np.arange(2000), m, fraction=1.0)
    h = few.hash(m[:20])
    sizes = [len(few.candidates(x)) for x in h]
    assert min(sizes) >= 200 and max(sizes) < 1000
    assert all(i in few.candidates(x) for i, x in enumerate(h)) and len(all_.candidates(h[0])) == 2000
    assert np.array_equal(projections(4, 2, 3), projections(4, 2, 3))


@pytest.mark.parametrize("shard", [64, 4096])
def test_forest_gives_k_or_all(spark, shard):
    rows = awkward_vectors()
    vs = usable(rows)
    got = Counter(r.query_id for r in nearest(vectors(spark, rows), F.col("vec_id") % 50 == 0, 5, shard=shard).collect())
    assert got == Counter({q: min(5, sum(len(v) == len(vs[q]) for v in vs.values()) - 1) for q in vs if q % 50 == 0})


@pytest.mark.parametrize("n", [2, 3, 6, 8, 11])
def test_small_forest_gives_k_or_all(n):
    m = np.random.default_rng(n).normal(size=(n, 8))
    for ids in (np.arange(n), np.arange(n) // 2):
        q, i, _ = HashForest(ids, m)(ids, m, 5)
        assert all(len(set(i[q == x])) == min(5, len(set(ids)) - 1) and x not in i[q == x] for x in ids)


def integers(a, b):
    return int(np.floor(1024 * a).astype(object) @ np.floor(1024 * b).astype(object))


@pytest.mark.parametrize("shard", [100, 4096])
def test_kd_trees_are_exact(spark, shard):
    rows = awkward_vectors()
    got = {(r.query_id, r.rank, r.vec_id, r.score) for r in exact_top(vectors(spark, rows), F.col("vec_id") % 50 == 0, 10, shard=shard).collect()}
    assert got == brute(usable(rows, zero=True), lambda q: q % 50 == 0, 10, integers)


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 300), st.integers(1, 4), st.sampled_from([1.0, 1e-3, 1e12, 1e200]), st.integers(0, 5))
def test_kd_tree_prunes_nothing_that_counts(n, dim, size, k):
    rng = np.random.default_rng(n * 10 + dim)
    m = np.round(rng.normal(size=(n, dim)), 1) * size
    q, i, s = KDTree(np.arange(n), m)(np.array([-1]), m[:1], k)
    want = sorted((-int(sum(int(x) * int(y) for x, y in zip(row, scaled(m[:1])[0]))), j) for j, row in enumerate(scaled(m)))[:k]
    clip = lambda x: min(max(x, -2 ** 63), 2 ** 63 - 1)
    assert [(int(a), int(b)) for a, b in zip(s, i)] == [(clip(-x), j) for x, j in want]


def test_searches_of_nothing(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert nearest(empty, F.lit(True)).count() == exact_top(empty, F.lit(True)).count() == 0
    assert nearest(vectors(spark, [(1, [1.0])]), F.lit(True)).count() == 0


def test_kd_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.execute(ORACLES["op8_kd_tree_topk"]).fetchall()
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in QUERIES["op8_kd_tree_topk"](spark, SF).collect()]
    assert sorted(got) == sorted(want)


# --- urls

URLS = [None, "", "no scheme", "://", "http://", "http://ORG/x", "https://a.Example.org/es/1?q=/en/1", "http://example.org/en/1", "http://example.org/en/2", "http://xorg/x", "http://a.org",
        "http://a.org?x=/", "http://a.org#/", "http://b.com/de/5", "http://b.com/fr/5", "http://b.com/fr", "http://b.com/es/1?a=1&b=2#f", "ftp://c.net/de/" + "x/" * 5000, "http://É.com/fr/ü\n?z",
        "http://example.org/es//en/1", "x://y://com/de/"]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def plain_rule(host, path, rules=RULES):
    fit = [(len(r), r, v) for v, r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fit)[1:] if fit else (None, None)


def pages(spark, urls):
    return spark.createDataFrame([(i if i != 3 else None, u, "<p>", "clash", 1.0, 2.0) for i, u in enumerate(urls)],
                                 "page_id long, url string, html string, host string, label double, features double")


def test_url_parts_and_rules(spark):
    got = url_verdicts(pages(spark, URLS * 2)).collect()
    assert len(got) == 2 * len(URLS)
    want = Counter((i if i != 3 else None, *plain_parts(u), plain_rule(*plain_parts(u))[0]) for i, u in enumerate(URLS * 2))
    assert Counter((r.page_id, r.host, r.path, r.rule) for r in got) == want
    assert {r.verdict for r in got} <= {"allow", "block"}
    assert all(r.verdict == plain_rule(r.host, r.path)[1] for r in got if r.rule)


def test_lexical_features(spark):
    df = pages(spark, URLS).select(F.coalesce("url", F.lit("")).alias("url"))
    host, path = parts(F.col("url"))
    rows = df.select("url", *lexical(F.col("url"), host, path)).collect()
    for r in rows:
        ascii_only = re.sub(r"[^\x00-\x7f]", "\x80", r.url)
        entropy = -sum(n / len(r.url) * np.log2(n / len(r.url)) for n in Counter(ascii_only).values())
        assert (r.length, r.depth, r.hyphens) == (len(r.url), plain_parts(r.url)[1].count("/"), r.url.count("-"))
        assert r.entropy == pytest.approx(entropy, abs=1e-9)
        assert r.digits == pytest.approx(sum(c in "0123456789" for c in r.url) / max(len(r.url), 1))


def test_trees_learn_from_labelled_urls(spark):
    rng = np.random.default_rng(1)
    good = [f"https://site{i % 7}.net/news/{i}" for i in range(300)]
    bad = [f"http://x{rng.integers(1e9)}.buy.net/a/b/c/{rng.integers(1e12)}?id={i}&ref={i}&u=9" for i in range(300)]
    split = lambda rows: (rows[:200], rows[200:])
    labelled = spark.createDataFrame([(u, "allow") for u in split(good)[0]] + [(u, "block") for u in split(bad)[0]] + [(None, "allow"), ("x", None)], "url string, verdict string")
    test = split(good)[1] + split(bad)[1]
    got = {r.page_id: r.verdict for r in url_verdicts(spark.createDataFrame(list(enumerate(test)), "page_id long, url string"), labelled=labelled).collect()}
    right = sum(got[i] == ("allow" if i < 100 else "block") for i in range(200))
    assert right >= 190


def test_long_suffixes_are_not_broadcast(spark, monkeypatch):
    from vigil.llm import common
    monkeypatch.setattr(common, "BROADCAST_BYTES", 1 << 16)
    urls = [f"http://a.{i}{'x' * 1000}/p" for i in range(100)] + ["http://a.org/x", "http://a.com/de/x"] * 5
    hints = [url_verdicts(pages(spark, u))._jdf.queryExecution().analyzed().toString().count("strategy=broadcast") for u in (urls, URLS)]
    assert hints == [0, 1]


def test_urls_without_labels_or_rows(spark):
    one = spark.createDataFrame([(1, "http://q.net/x"), (2, "http://a.org/x")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in url_verdicts(one).collect()} == {1: "allow", 2: "allow"}
    assert {r.verdict for r in url_verdicts(one, rules=()).collect()} == {"allow"}
    assert {r.page_id: r.verdict for r in url_verdicts(one, rules=(("block", "org/"),)).collect()} == {1: "block", 2: "block"}
    assert url_verdicts(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_url_filter_runs_no_python(spark):
    df = QUERIES["op6_url_filter"](spark, "/root/testdata/sf0.001")
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
