"""The operators on texts against plain versions, on awkward rows, empty tables and clashing column names."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import DOCS, components, kept_words, rows, shingles, table, words_of  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigil.llm.byte_bpe import ByteBPE
from vigil.llm import common, packing, quality
from vigil.llm.common import WordHasher, save, text_buffers, text_groups, window_mask, windows
from vigil.llm.components import connected_components
from vigil.llm.lattice import Lattice, PieceTrie, Vocabulary
from vigil.llm.lm_scoring import held_out_by_id, lattice_scores
from vigil.llm.ngram_join import ngram_components
from vigil.llm.packing import CAPACITY, GROUP, _cut, pack, plan, read_tokenizer
from vigil.llm.quality import accepted, bradley_terry, quality_scores
from vigil.llm.sampled_pieces import decode, encode
from vigil.llm.substring_dedup import COVER, PERIOD, substring_dedup
from vigil.llm.token_counts import token_counts


def plain(df, *cols):
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


# --- helpers

@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n\t\x0b\x00日", max_size=40), max_size=8), st.integers(1, 30))
def test_word_hashes_follow_the_words(texts, segment):
    data, bounds = text_buffers(pa.array(texts, pa.string()))
    hasher = WordHasher(lower=False)
    hasher.SEGMENT = segment
    h, woff, (s, e) = hasher(data, bounds, places=True)
    own = [w for x in texts for w in words_of(x)]
    assert np.diff(woff).tolist() == [len(words_of(x)) for x in texts]
    assert [data[a:b].tobytes() for a, b in zip(s, e)] == own
    assert len(set(zip(h.tolist(), own))) == len(set(own)) == len(set(h.tolist()))


def test_text_groups_cover_all_texts():
    bounds = np.array([0, 3, 3, 50, 52, 60])
    assert list(text_groups(bounds, 10)) == [(0, 2), (2, 3), (3, 5)]


def test_windows_do_not_cross_texts():
    h, woff = WordHasher(False)(*text_buffers(pa.array(["a b c", "b c", "", "a b c d"])))
    ok = window_mask(woff, 3)
    w = windows(h, 3)
    assert np.flatnonzero(ok).tolist() == [0, 5, 6] and w[0] == w[5] != w[6]


def test_difference_cover_meets_every_pair_of_places():
    for i in range(PERIOD):
        for j in range(PERIOD):
            assert any((i + d) % PERIOD in COVER and (j + d) % PERIOD in COVER for d in range(PERIOD))


def test_connected_components(spark):
    chain = [(i, i + 1) for i in range(30)] + [(100, 7), (200, 201), (201, 200), (5, 5), (None, 3)]
    star = [(1000, 2000 + i) for i in range(500)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert got == {i: 0 for i in [*range(31), 100]} | {200: 200, 201: 200} | {i: 1000 for i in [1000, *range(2000, 2500)]}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- n-gram join

@pytest.mark.parametrize("k,t,block,cluster", [(3, 90, 4096, 1_000_000), (5, 80, 4, 300), (2, 50, 3, 200), (3, 100, 4096, 1_000_000)])
def test_ngram_components(spark, rows, k, t, block, cluster):
    got = ngram_components(table(spark, rows, clash=True), k, t, block=block, cluster_tokens=cluster)
    sets = [shingles(x, k) for _, x in rows]
    root = components(sets, t)
    ids = [i for i, _ in rows]
    want = Counter()
    for i, r in enumerate(root):
        names = [ids[j] for j in range(len(ids)) if root[j] == r and ids[j] is not None]
        want[ids[i], len(sets[i]), (min(names) if names else None) if sets[i] else ids[i]] += 1
    assert plain(got, "doc_id", "n_shingles", "component_id") == want


def test_ngram_components_of_nothing(spark):
    assert ngram_components(spark.createDataFrame([], DOCS)).count() == 0


# --- substring dedup

@pytest.mark.parametrize("window,chunk,bucket", [(13, 4 << 20, 1 << 20), (13, 2000, 1), (8, 5000, 50)])
def test_substring_dedup(spark, rows, window, chunk, bucket):
    got = substring_dedup(table(spark, rows, clash=True), window, rest=True, chunk_bytes=chunk, bucket_values=bucket)
    want = Counter((i, n, r, k.decode()) for (i, _), (n, r, k) in zip(rows, kept_words(rows, window)))
    assert plain(got, "doc_id", "n_words", "n_removed", "kept") == want
    assert {r.kept for r in got.select("rest.kept").collect()} == {"kept"}


def test_repeated_rows_are_dealt_into_many_chunks(spark):
    from vigil.llm.chunks import chunked
    rows = [(1, "a repeated row " * 10)] * 2000 + [(None, None)] * 2000 + [(i, f"text {i} " * 20) for i in range(2, 500)]
    df = spark.createDataFrame(rows, "doc long, text string").repartition(4)
    got = chunked(df, sum(len(x or "") for _, x in rows), "doc", "text", chunk_bytes=10_000)
    assert sorted((r.doc or 0, r.text or "") for r in got.collect()) == sorted((i or 0, x or "") for i, x in rows)
    assert got.columns == ["doc", "text", "chunk"] and max(r["count"] for r in got.groupBy("chunk").count().collect()) < 400


def test_substring_dedup_of_repeated_rows(spark, rows):
    passage = " ".join(f"p{i}" for i in range(40))
    more = rows + [(105, passage + " end")] * 60 + [(None, passage)] * 60 + [(104, "start " + passage)]
    got = substring_dedup(table(spark, more), 13, chunk_bytes=2000)
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept.encode()) for r in got.collect()) == Counter((i, *w) for (i, _), w in zip(more, kept_words(more, 13)))


def test_substring_dedup_of_nothing(spark):
    assert substring_dedup(spark.createDataFrame([], DOCS)).count() == 0


# --- LM scoring

@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary()


def characters(word: bytes) -> set[int]:
    return {i for i in range(1, len(word) + 1) if i == len(word) or (word[i] & 0xC0) != 0x80}


def marginal(word: bytes, logp, pieces: dict, byte_ids) -> float:
    """log of the summed weight of all segmentations, by the plain recursion."""
    ends = sorted(characters(word))
    known = {b for a, b in zip([0, *ends], ends) if word[a:b] in pieces}
    f = [0.0] + [-math.inf] * len(word)
    for j in range(1, len(word) + 1):
        terms = [f[i] + logp[pieces[word[i:j]]] for i in range(max(0, j - 40), j) if word[i:j] in pieces]
        if j not in known:
            terms.append(f[j - 1] + logp[byte_ids[word[j - 1]]])
        top = max(terms, default=-math.inf)
        f[j] = top + math.log(sum(math.exp(x - top) for x in terms)) if top > -math.inf else top
    return f[-1]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="the ingandé日\x00▁", min_size=1, max_size=20), min_size=1, max_size=6, unique=True))
def test_lattice_marginals_and_expected_counts(vocabulary, texts):
    words = [x.encode() for x in texts]
    pieces = {vocabulary.pieces[i]: i for i in vocabulary.plain}
    lattice = Lattice(words, PieceTrie(vocabulary))
    f = lattice.forward(vocabulary.logp)
    for w, end in zip(words, lattice.trie.ends):
        assert f[end] == pytest.approx(marginal(w, vocabulary.logp, pieces, vocabulary.byte_ids), rel=1e-9)
    counts = np.arange(1, len(words) + 1)
    uses = lattice.expected(vocabulary.logp, f, counts, len(vocabulary.logp))
    size = np.array([len(p) for p in vocabulary.pieces])
    assert (uses * size).sum() == pytest.approx((counts * [len(w) for w in words]).sum())  # every byte is covered once


def test_lattice_scores(spark, rows, vocabulary):
    got = lattice_scores(table(spark, rows, clash=True), held_out_by_id("doc_id", 3, 0), chunk_bytes=5000, bucket_values=50).collect()
    out = [i is not None and zlib.crc32(str(i).encode()) % 3 == 0 for i, _ in rows]
    uses = Counter()
    for (_, x), o in zip(rows, out):
        if not o:
            uses.update([*words_of(x, lower=True), None])
    n, v = sum(uses.values()), len(uses)
    want = Counter()
    for (i, x), o in zip(rows, out):
        tokens = [*words_of(x, lower=True), None]
        want[i, o, len(tokens), sum(uses[w] > 0 for w in tokens), n, round(sum(math.log10((uses[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens), 5)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
    assert all(r.score < 0 for r in got)
    by_text = {r.doc_id: r.score for r in got}
    assert by_text[50] == by_text[51] and by_text[2] == by_text[3] > by_text[4] and by_text[4] == by_text[5]


def test_lattice_scores_are_probabilities(spark, vocabulary):
    """The model's own probabilities from EM, replayed plainly: words' marginals and the end's add up to the score."""
    rows = [(i, "the thing and the end") for i in range(5)] + [(9, "the")]
    df = table(spark, rows)
    score = {r.doc_id: r.score for r in lattice_scores(df, F.lit(False), em_rounds=0).collect()}
    pieces = {vocabulary.pieces[i]: i for i in vocabulary.plain}
    end = -math.log1p(1000)
    for i, x in rows:
        log = sum(marginal(b" " + w, vocabulary.logp, pieces, vocabulary.byte_ids) for w in words_of(x)) + end
        assert score[i] == pytest.approx(log / math.log(10), rel=1e-9)
    better = {r.doc_id: r.score for r in lattice_scores(df, F.lit(False)).collect()}
    assert all(better[i] > score[i] for i in score)


def test_lattice_scores_without_training_or_rows(spark):
    assert lattice_scores(spark.createDataFrame([], DOCS), F.lit(False)).count() == 0
    r = lattice_scores(table(spark, [(1, "a b"), (2, None)]), F.lit(True)).orderBy("doc_id").collect()
    assert [(x.n_tokens, x.n_known, x.train_tokens, x.base_score) for x in r] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)] and r[0].score < r[1].score < 0


# --- sampled pieces and token counts

def test_sampled_pieces_are_lossless_and_reproducible(spark, rows):
    df = table(spark, rows, clash=True)
    one = decode(encode(df, seed=3))
    assert plain(one, "doc_id", "text") == Counter((i, x or "") for i, x in rows)
    ids = lambda d, **k: Counter((r.doc_id, tuple(r.ids)) for r in encode(d, **k).collect())
    assert ids(df, seed=3) == ids(df.repartition(7), seed=3) != ids(df, seed=4)
    assert encode(spark.createDataFrame([], DOCS)).count() == 0
    assert decode(spark.createDataFrame([(None,), ([],)], "ids array<int>")).select("text").collect() == [(None,), ("",)]


def test_samples_follow_the_posterior(spark, vocabulary):
    text, n = "then", 4000
    got = Counter(tuple(r.ids) for r in encode(table(spark, [(i, text) for i in range(n)])).collect())
    pieces = {vocabulary.pieces[i]: i for i in vocabulary.plain}

    def paths(word: bytes):
        if not word:
            yield (), 0.0
        for j in range(1, len(word) + 1):
            if word[:j] in pieces:
                for ids, w in paths(word[j:]):
                    yield (pieces[word[:j]], *ids), vocabulary.logp[pieces[word[:j]]] + w

    weight = {ids: math.exp(w) for ids, w in paths(b" " + text.encode())}
    total = sum(weight.values())
    assert set(got) <= set(weight)
    for ids, w in weight.items():
        p = w / total
        assert abs(got[ids] - n * p) < 5 * math.sqrt(n * p * (1 - p)) + 1


def test_token_counts(spark, rows, vocabulary):
    pieces = {vocabulary.pieces[i]: i for i in vocabulary.plain}

    def fewest(text: str) -> int:
        word = (" " + text).encode() if text else b""
        known = {b for a, b in zip([0, *sorted(characters(word))], sorted(characters(word))) if word[a:b] in pieces}
        f = [(0.0, 0)] + [(-math.inf, 0)] * len(word)
        for j in range(1, len(word) + 1):
            options = [(f[i][0] + vocabulary.logp[pieces[word[i:j]]], f[i][1] - 1) for i in range(max(0, j - 40), j) if word[i:j] in pieces]
            if j not in known:
                options.append((f[j - 1][0] + vocabulary.logp[vocabulary.byte_ids[word[j - 1]]], f[j - 1][1] - 1))
            f[j] = max(options, default=f[j])
        return -f[-1][1]

    some = [r for r in rows if len(r[1] or "") < 3000]
    got = plain(token_counts(table(spark, some, clash=True)), "doc_id", "n_tokens")
    assert got == Counter((i, fewest(x or "")) for i, x in some)
    assert token_counts(table(spark, rows)).count() == len(rows)
    assert token_counts(spark.createDataFrame([], DOCS)).count() == 0


# --- packing

@pytest.fixture(scope="module")
def tokenizers():
    from tokenizers import Tokenizer

    file = read_tokenizer()
    return ByteBPE(file), Tokenizer.from_str(file)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab st'mdrevlSé×² \u0085 \n\t\r.,!?12日\x1c", max_size=30), min_size=1, max_size=6))
def test_byte_bpe_gives_the_tokenizers_ids(tokenizers, texts):
    fast, slow = tokenizers
    got = fast(*text_buffers(pa.array(texts, pa.string())))
    assert [x.tolist() for x in got] == [slow.encode(x, add_special_tokens=False).ids for x in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=30, max_size=30))
def test_plan_packs_all_pieces(counts):
    counts = np.array([0, *counts])
    used = np.zeros_like(counts)
    sequences = 0
    for pattern, times in plan(counts):
        assert sum(pattern) <= 30 and times > 0
        np.add.at(used, pattern, times)
        sequences += times
    assert (used == counts).all()
    total = int((counts * np.arange(31)).sum())
    assert sequences <= max(-(-total // 30) * 11 / 9 + 1, 0)


def test_plan_fills_gaps_exactly():
    counts = np.zeros(101, int)
    counts[[60, 40, 50, 30, 20]] = [4, 3, 2, 1, 1]  # 60 + 40 and 50 + 50 fill sequences, 510 in all need six
    got = plan(counts)
    assert sum(t for _, t in got) == 6 and sum(t for p, t in got if sum(p) == 100) >= 4


@pytest.mark.parametrize("capacity", [2048, 64])
def test_pack(spark, rows, tokenizers, capacity):
    some = rows if capacity == 2048 else [r for r in rows if len(r[1] or "") < 100_000]
    got = pack(table(spark, some, clash=True), capacity, keep_ids=True).collect()
    whole = Counter((i, tuple(tokenizers[1].encode(x or "", add_special_tokens=False).ids + [0])) for i, x in some)
    want = Counter()
    for (i, ids), n in whole.items():
        first = (len(ids) - 1) % capacity + 1
        for piece, a in enumerate(range(first - capacity, len(ids), capacity)):
            part = ids[max(a, 0):a + capacity]
            want[i, piece, max(a, 0), part, zlib.crc32(np.array(part, "<u4").tobytes())] += n
    assert Counter((r.doc_id, r.piece, r.start, tuple(r.ids), r.ids_crc32) for r in got) == want
    assert all(r.length == len(r.ids) for r in got)
    by = {}
    for r in sorted(got, key=lambda r: r.offset):
        assert r.offset == by.get(r.sequence_id, 0)
        by[r.sequence_id] = r.offset + r.length
    assert max(by.values()) <= capacity and sorted(by) == list(range(len(by)))
    assert len(by) <= 1.05 * -(-sum(by.values()) // capacity) + 1


def test_pack_of_nothing(spark):
    assert pack(spark.createDataFrame([], DOCS)).count() == 0


# --- quality

def quality_rows():
    rng = np.random.default_rng(2)
    words = [f"{a}{b}" for a in ("re", "tion", "an", "der") for b in ("on", "at", "ing", "")]
    good = [(i, " ".join(rng.choice(words, 60)) + ".") for i in range(0, 400)]
    bad = [(i, " ".join(f"{w}!!".upper() for w in rng.choice(words, 60))) for i in range(400, 480)]
    return good + bad


def test_quality_scores(spark):
    rows = quality_rows()
    labels = spark.createDataFrame([(i, int(i < 400), 0) for i, _ in rows] + [(1, None, 0), (None, 0, 0), (9, 7, 0)], "doc_id long, quality int, toxic int")
    odd = [(None, "tion an der"), (1001, None), (1002, ""), (1003, "é" * 50_000), (3, rows[3][1])]
    got = quality_scores(table(spark, rows + odd, clash=True), labels, held_out_by_id("id", 4, 2)).collect()
    assert len(got) == len(rows) + len(odd)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [r for r in got if r.held_out and r.doc_id < 480]
    assert len(held) > 50 and np.mean([r.predicted == (r.doc_id < 400) for r in held]) > 0.97
    kept = accepted(table(spark, rows + odd, clash=True), labels, held_out_by_id("id", 4, 2))
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if r.predicted)
    assert kept.columns == table(spark, rows, clash=True).columns


def test_quality_learns_from_training_rows_only(spark):
    rows = quality_rows()
    df, held = table(spark, rows), held_out_by_id("id", 4, 2)
    label = lambda lie: spark.createDataFrame([(i, int((i < 400) != (lie and zlib.crc32(str(i).encode()) % 4 == 2))) for i, _ in rows], "doc_id long, quality int")
    assert plain(quality_scores(df, label(False), held), "doc_id", "score") == plain(quality_scores(df, label(True), held), "doc_id", "score")


def test_quality_sample_of_an_id_with_many_rows_is_bounded(spark, monkeypatch):
    from vigil.llm import quality
    hot = spark.range(5000).selectExpr("id", "pmod(xxhash64(id, 11), 1L << 40) AS h").orderBy("h").first().id
    rows = [(hot, [float(i % 1000), 1.0]) for i in range(4000)] + [(i, [float(i % 7), 0.0]) for i in range(5000) if i != hot]
    feats = spark.createDataFrame([(i, f, False) for i, f in rows], "id long, f array<double>, held_out boolean").repartition(4)
    labels = spark.createDataFrame([(i, int(i == hot or i % 2)) for i in range(5000)], "doc_id long, quality int")
    sent, frame, collect = [], type(feats), type(feats).collect
    monkeypatch.setattr(frame, "collect", lambda df: sent.append(collect(df)) or sent[-1])
    quality.fit(feats, labels, sample=200)
    good = [r for rows in sent for r in rows if "f" in r and (r.id == hot or r.id % 2)]
    assert max(map(len, sent)) <= 2 * 200 and 0 < sum(r.id == hot for r in good) < 0.5 * len(good)


def test_quality_without_both_labels(spark):
    rows = quality_rows()[:20]
    for marks in ([], [(i, 1) for i, _ in rows]):
        got = quality_scores(table(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int"), F.lit(False)).collect()
        assert [r.predicted for r in got] == [1] * 20
    assert quality_scores(spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id long, quality int"), F.lit(False)).count() == 0


def test_bradley_terry_finds_the_order():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3))
    worth = x @ [2.0, -1.0, 0.0]
    w = bradley_terry(x[worth > 0.5], x[worth < -0.5])
    assert w[0] > 0 > w[1] and abs(w[2]) < 0.2 * w[0] and abs(w[0] / w[1] + 2) < 0.3


# --- digests of the registered queries

def test_queries_follow_the_operators(spark):
    from conftest import SF_SMALL

    from vigil.llm.queries import QUERIES

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = sorted(docs.items())
    got = {r.doc_id: r for r in QUERIES["op4_substring_dedup"](spark, SF_SMALL).collect()}
    for (i, _), (n, removed, kept) in zip(rows, kept_words(rows, 13)):
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (n, removed, hashlib.sha256(kept).hexdigest())
    got = {r.doc_id: r for r in QUERIES["op5_sampled_pieces"](spark, SF_SMALL).collect()}
    assert all(got[i].decoded_sha256 == hashlib.sha256((x or "").encode()).hexdigest() for i, x in rows) and len(got) == len(rows)
    root = components([shingles(x, 3) for _, x in rows], 90)
    got = {r.doc_id: r.component_id for r in QUERIES["op1_ngram_jaccard_join"](spark, SF_SMALL).collect()}
    assert got == {i: rows[r][0] for (i, _), r in zip(rows, root)}


@pytest.mark.parametrize("name", ["op1_ngram_jaccard_join", "op4_substring_dedup"])
def test_queries_match_sql(spark, name):
    import duckdb
    from conftest import SF_SMALL

    from vigil.llm.queries import ORACLES, QUERIES

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    cur = con.execute(ORACLES[name])
    cols = [c[0] for c in cur.description]
    assert plain(QUERIES[name](spark, SF_SMALL), *cols) == Counter(cur.fetchall())


def test_packing_tokenises_few_texts_at_a_time(monkeypatch):
    """The tokenizer is never handed more than GROUP bytes at once, unless a single text is longer."""
    seen = []
    real = ByteBPE.__call__
    monkeypatch.setattr(ByteBPE, "__call__", lambda self, data, bounds: (seen.append((len(data), len(bounds) - 1)), real(self, data, bounds))[1])
    words = " ".join(f"w{i}" for i in range(20_000))
    batch = pa.record_batch([pa.array(range(30), pa.int64()), pa.array([words] * 29 + [words * 12], pa.string())], names=["doc_id", "text"])
    out = pa.Table.from_batches(list(_cut(read_tokenizer(), CAPACITY, 0, False)(iter([batch]))))
    assert sum(n for _, n in seen) == 30 and all(size <= GROUP <= 1 << 20 or n == 1 for size, n in seen)
    assert len(set(out["doc_id"].to_pylist())) == 30


def test_quality_reads_few_texts_at_a_time(monkeypatch):
    """Features are made of GROUP bytes at once (or a single text), and accepted rows go back as they are judged."""
    seen = []
    real = quality.features
    monkeypatch.setattr(quality, "features", lambda data, bounds, *rest: (seen.append((len(data), len(bounds) - 1)), real(data, bounds, *rest))[1])
    words = " ".join(f"w{i}" for i in range(20_000))
    texts = [words, "a b c", None] * 9 + [words * 12]
    batch = pa.record_batch([pa.array(range(28), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])
    for run in (quality._features(), quality._accepted(quality.Model(None), 1)):
        out = list(run(iter([batch])))
        assert sum(n for _, n in seen) == 28 and all(size <= quality.GROUP <= 1 << 20 or n == 1 for size, n in seen)
        assert [out_n.num_rows for out_n in out] == [n for _, n in seen]
        assert pa.Table.from_batches(out).column(0).to_pylist() == list(range(28))
        seen.clear()


def test_word_hasher_keeps_little_for_long_texts():
    """The tables of powers follow the segment, whatever the length of the texts."""
    hasher = WordHasher(lower=True)
    data, bounds = text_buffers(pa.array([" ".join(f"w{i}" for i in range(300_000))]))
    h, woff = hasher(data, bounds)
    assert len(data) > 1 << 21 and woff.tolist() == [0, 300_000] and len(set(h.tolist())) == 300_000
    assert hasher.power.nbytes + hasher.inverse.nbytes <= 5 << 20


def test_save_sends_texts_in_small_batches(spark):
    """With ``texts`` a worker gets little more than BATCH_BYTES at a time; the session's setting stays."""
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    df = spark.range(0, 3_000, 1, 1).select(F.expr("repeat('word ', 1000)").alias("text")).mapInArrow(sizes, "n long, size long")
    before = spark.conf.get(common.BATCH)
    small, whole = (save(df, "sizes", texts=t).collect() for t in (True, False))
    assert spark.conf.get(common.BATCH) == before
    assert sum(r.n for r in small) == sum(r.n for r in whole) == 3_000
    assert max(r["size"] for r in small) <= common.BATCH_BYTES + (1 << 20) < max(r["size"] for r in whole)


def test_packing_sends_texts_in_small_batches(spark, monkeypatch):
    """The pieces are saved with small batches of texts."""
    seen = []
    monkeypatch.setattr(packing, "save", lambda df, name, texts=False: (seen.append((name, texts)), save(df, name, texts))[1])
    assert pack(spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")).count() == 2
    assert seen == [("pieces", True)]
