"""Registered queries run whole against what their contracts say, and quality features against a plain version."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from cases import awkward, words_of
from tokenizers import Tokenizer

from vigil.llm.common import WordHasher, text_buffers
from vigil.llm.packing import plan, read_tokenizer
from vigil.llm.quality import _byte_kinds, features
from vigil.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def documents(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def remainder(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def test_op2_counts_and_base_scores(spark):
    docs = documents(spark)
    tokens = {i: [*words_of(x, lower=True), None] for i, x in docs.items()}
    c = Counter(t for i, ts in tokens.items() if remainder(i, 10) for t in ts)
    n, v = sum(c.values()), len(c)
    got = QUERIES["op2_lattice_likelihood"](spark, SF).collect()
    assert {r.doc_id for r in got} == set(docs) and len(got) == len(docs)
    for r in got:
        ts = tokens[r.doc_id]
        base = sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (remainder(r.doc_id, 10) == 0, len(ts), sum(c[t] > 0 for t in ts), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0


def test_op9_packs_every_id_of_every_document(spark):
    docs = documents(spark)
    tok = Tokenizer.from_str(read_tokenizer())
    want = {i: [*tok.encode(x or "", add_special_tokens=False).ids, 0] for i, x in docs.items()}
    got = QUERIES["op9_best_fit_packing"](spark, SF).collect()
    pieces, rooms = defaultdict(list), defaultdict(list)
    for r in got:
        ids = want[r.doc_id][r.start:r.start + r.length]
        assert len(ids) == r.length <= 2048 and r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        pieces[r.doc_id].append((r.piece, r.start, r.length))
        rooms[r.sequence_id].append((r.offset, r.length))
    for i, ids in want.items():
        own = sorted(pieces[i])
        assert [p for p, _, _ in own] == list(range(len(own))) and sum(n for _, _, n in own) == len(ids)
        assert len(own) == -(-len(ids) // 2048) and all(n == 2048 for _, _, n in own[1:])
    for room in rooms.values():
        at = 0
        for offset, n in sorted(room):
            assert offset == at
            at += n
        assert at <= 2048
    assert len(rooms) <= -(-sum(map(len, want.values())) // 2048) * 1.02 + 2


def test_op10_scores_every_document(spark):
    docs = documents(spark)
    got = QUERIES["op10_quality_classifier"](spark, SF).collect()
    assert {r.doc_id for r in got} == set(docs) and len(got) == len(docs)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) and r.held_out == (remainder(r.doc_id, 4) == 2) for r in got)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    seen = [(r.score, labels[r.doc_id]) for r in got if r.held_out and labels.get(r.doc_id) is not None]
    pairs = [(a > b) for a, x in seen for b, y in seen if x == 1 and y == 0]
    assert pairs and sum(pairs) / len(pairs) > 0.9


def test_op7_counts_every_document(spark):
    docs = documents(spark)
    got = QUERIES["op7_token_counts"](spark, SF).collect()
    assert Counter(r.doc_id for r in got) == Counter(docs.keys())
    again = {tuple(r) for r in QUERIES["op7_token_counts"](spark, SF).collect()}
    assert {tuple(r) for r in got} == again


def plain_features(text: bytes) -> list[float]:
    """The features of one text by loops over its bytes and words."""
    def count(test):
        return float(sum(map(test, text)))

    w = [x.lower() for x in text.split()]
    low, up = count(lambda b: 97 <= b < 123), count(lambda b: 65 <= b < 91)
    digits, lines = count(lambda b: 48 <= b < 58), count(lambda b: b == 10)
    blanks = count(lambda b: b in b" \t\r\x0b\x0c")
    stops, marks, quotes, signs = (count(lambda b, g=g: b in g) for g in (b".,;:", b"!?", b"'\"()-", b"#$%&*+/<=>@[\\]^_`{|}~"))
    control = count(lambda b: b < 9 or 14 <= b < 32)
    other = len(text) - low - up - digits - lines - blanks - stops - marks - quotes - signs - control
    n, solid, letters = max(len(w), 1), max(len(text) - blanks - lines, 1), max(low + up + other, 1)
    c, threes = Counter(w), Counter(zip(w, w[1:], w[2:]))
    t = sum(threes.values())
    ratios = [up / letters, digits / solid, stops / n, marks / n, quotes / n, signs / solid, control / solid, lines / n, other / letters, 1 - len(c) / n if w else 1.0,
              max(c.values(), default=0) / n, 1 - len(threes) / t if t else 0.0, max(threes.values(), default=0) / max(t, 1), sum(a == b for a, b in zip(w, w[1:])) / n]
    length = [math.log1p(len(w)) / 10, solid / n / 10]
    return [*ratios, *map(math.sqrt, ratios), *(min(r, 0.05) * 20 for r in ratios), *(min(r, 0.3) for r in ratios), *length, *(x * x for x in length), float(not w)]


def test_quality_features_follow_their_definition():
    texts = [x for _, x in awkward() if len(x or "") < 5000] + ["A b A b A b!?", "\x00\x1f #tag 12 12 12", "One\nTWO\tthree one two three", "日本 日本 'x' (y)"]
    data, bounds = text_buffers(pa.array(texts, pa.string()))
    got = features(data, bounds, WordHasher(lower=True), _byte_kinds())
    for row, x in zip(got, texts):
        want = plain_features((x or "").encode())
        assert len(row) == len(want) and np.allclose(row, want, atol=1e-12), x


def test_packing_plan_fills_what_can_be_filled():
    counts = np.zeros(101, int)
    counts[[60, 40, 50, 30, 20]] = [4, 3, 2, 1, 1]
    got = list(plan(counts))
    used = Counter()
    for lengths, times in got:
        assert sum(lengths) <= 100
        for x in lengths:
            used[int(x)] += times
    assert used == {60: 4, 40: 3, 50: 2, 30: 1, 20: 1}
    assert sum(t for _, t in got) == 6 and sum(t for lengths, t in got if sum(lengths) == 100) >= 4
