"""The pipeline's stages against plain versions of what they decide, and end to end."""

from __future__ import annotations

from collections import Counter

import pytest
from cases import DOCS, awkward, components, kept_words, shingles, table

import corpus_pipeline as cp

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_quality_stage_follows_the_classifier(spark):
    from vigil.llm.common import documents
    from vigil.llm.queries import QUERIES

    good = {r.doc_id for r in QUERIES["op10_quality_classifier"](spark, SF).collect() if r.predicted}
    kept = cp.quality(spark, documents(spark, SF), SF)
    assert {r.doc_id for r in kept.collect()} == good
    assert kept.columns == documents(spark, SF).columns


def test_near_duplicate_stage(spark):
    rows = awkward()
    got = rows_of(cp.near_duplicates(spark, table(spark, rows), SF))
    ids, sets = [i for i, _ in rows], [shingles(x, 5) for _, x in rows]
    root = components(sets, 80)
    least = {r: min((ids[j] for j in range(len(ids)) if root[j] == r and ids[j] is not None), default=None) for r in root}
    gone = {i for i in ids if i is not None and all(sets[j] and least[root[j]] != i for j in range(len(ids)) if ids[j] == i)}
    want = {(i, x) for i, x in rows if i not in gone}  # equal rows once
    assert got == Counter(want) and len(gone) > 20


def test_near_duplicate_stage_without_or_with_shared_ids(spark):
    """One row of each group stays, whether ids are null, shared or neither; texts without words all stay."""
    text, other, third = (" ".join(f"{x}{i}" for i in range(100)) for x in "abc")
    rows = [(None, text)] * 3 + [(None, text + " more"), (5, text), (9, text + " end"), (None, other), (None, other), (None, other + " z"),
            (7, third), (7, third + " z"), (7, "quite another text of that id"), (8, ""), (8, ""), (None, None), (None, None), (8, " ")]
    got = rows_of(cp.near_duplicates(spark, table(spark, rows), SF))
    assert [got.pop(x, 0) for x in [(8, ""), (None, None), (8, " ")]] == [2, 2, 1]
    assert got.pop((5, text)) == got.pop((7, "quite another text of that id")) == 1
    assert sorted((i or 0, x[:1], n) for (i, x), n in got.items()) == [(0, "b", 1), (7, "c", 1)]


def test_passage_stage_keeps_all_columns(spark):
    rows = awkward()
    got = cp.passages(spark, table(spark, rows, clash=True), SF)
    assert got.columns == table(spark, rows, clash=True).columns
    want = Counter((i, k.decode(), len(k.decode()), "en", "kept") for (i, _), (_, _, k) in zip(rows, kept_words(rows, 13)))
    assert Counter((r.doc_id, r.text, r.n_chars, r.lang, r["kept"]) for r in got.collect()) == want


def test_run_is_the_stages_in_turn(spark):
    docs = cp.documents(spark, SF)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
    want = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in docs.collect())
    got = cp.run(spark, SF).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    fill = Counter()
    for r in got:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048 and len(fill) <= 1.05 * sum(fill.values()) / 2048 + 1


@pytest.mark.parametrize("stage", [f for _, f in cp.STAGES])
def test_stages_on_empty_tables(spark, stage):
    assert stage(spark, spark.createDataFrame([], DOCS), SF).count() == 0
