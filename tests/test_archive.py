"""The packed archive: same records before, during and after packing, few files a day, replays, payloads as VARIANT."""

from __future__ import annotations

from collections import Counter

from conftest import SF_SMALL, readings
from hypothesis import given, settings
from hypothesis import strategies as st

from vigil.operators import consumers
from vigil.plans import stream_runs
from vigil.sources import fs
from vigil.streaming import archive as archives


def _batches(spark, n, days=3, rows=12):
    return [readings(spark, [{"event_id": f"e{b}-{i}", "arrival_seq": b * rows + i, "event_timestamp": f"2026-03-0{1 + (b + i) % days}T10:00:00Z"}
                             for i in range(rows)]) for b in range(n)]


def _held(table, spark, **options):
    return Counter((r.event_id, r.year, r.month, r.day) for r in table.read(spark, **options).select("raw_payload.event_id", "year", "month", "day").collect())


def _files(spark, table, part):
    return fs.names(spark, f"{table.root}/year={part.year}/month={part.month}/day={part.day}/part={part.part}")


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(0, 1000), st.integers(0, 150), max_size=40))
def test_bins_hold_all_names_once_and_no_more_than_target(sizes):
    out = archives.bins(sizes, 100)
    assert sorted(n for b in out for n in b) == sorted(sizes)
    assert all(sum(sizes[n] for n in b) <= 100 or len(b) == 1 for b in out)
    assert sum(sum(sizes[n] for n in b) * 2 < 100 for b in out) <= 1  # two bins under half would be one


def test_twenty_batches_become_two_files_a_day_and_readers_see_whole_states(spark, scratch):
    table, batches = archives.Archive(f"{scratch}/a", every=0), _batches(spark, 20)
    for i, b in enumerate(batches):
        table(b, i)
    before, state = _held(table, spark), table.log.states(spark)[-1]
    expected = Counter((r.raw_payload.event_id, r.year, r.month, r.day) for b in batches for r in consumers.archive_records(b).collect())
    assert before == expected and sum(before.values()) == 240
    planned = table.read(spark)  # a reader that planned before the files are packed
    texts = Counter(r.raw_text for r in planned.collect())
    table.pack(spark)
    assert _held(table, spark) == expected and _held(table, spark, state=state) == expected
    assert Counter(r.raw_text for r in planned.collect()) == texts == Counter(r.raw_text for r in table.read(spark).collect())
    parts = table.parts(spark)
    assert len({p.date for p in parts}) == 3 and all(n <= 2 for n in Counter({p.date: p.files for p in parts}).values())
    assert all(len(_files(spark, table, p)) == p.files for p in parts)
    assert Counter({(r.year, r.month, r.day): r.archived_events for r in table.counts(spark).collect()}) == Counter(k[1:] for k in expected.elements())
    assert sum(_held(table, spark, days=[("2026", "03", "02")]).values()) == 80


def test_old_states_go_when_no_kept_state_lists_them(spark, scratch):
    table = archives.Archive(f"{scratch}/a", every=2, keep=2)
    for i, b in enumerate(_batches(spark, 7)):
        table(b, i)
    assert sum(_held(table, spark).values()) == 84 and len(table.log.states(spark)) == 2
    listed = {archives._folder(vars(p)) for s in table.log.states(spark) for p in table.parts(spark, s)}
    there = {"/".join(f.split("/")[-5:-1]) for f in fs.files_below(spark, table.root) if "/part=" in f}
    assert there == listed


def test_a_replayed_batch_replaces_its_parts_also_where_files_were_packed(spark, scratch):
    table, batches = archives.Archive(f"{scratch}/a", every=2), _batches(spark, 4)
    for i in (0, 1, 1, 2, 3, 3, 3):  # batches 1 and 3 pack the ones before
        table(batches[i], i)
    assert _held(table, spark) == Counter((r.raw_payload.event_id, r.year, r.month, r.day) for b in batches for r in consumers.archive_records(b).collect())
    table(batches[0].limit(0), 4)
    table(batches[0].limit(0), 5)
    assert sum(_held(table, spark).values()) == 48


def test_a_large_day_is_packed_into_files_of_the_target_size_and_large_files_stay(spark, scratch):
    table = archives.Archive(f"{scratch}/a", target=30_000, every=0)
    for i in range(12):  # a third of all rows and more on one day
        rows = [{"event_id": f"e{i}-{j}", "arrival_seq": 100 * i + j, "event_timestamp": f"2026-03-{'01' if j % 3 else f'{2 + j % 20:02d}'}T10:00:00Z"} for j in range(60)]
        table(readings(spark, rows), i)
    table.pack(spark)
    hot = [p for p in table.parts(spark) if p.day == "01"]
    sizes = [s for p in hot for _, s, _ in fs.stamp(spark, f"{table.root}/{archives._folder(vars(p))}")]
    assert max(sizes) <= 30_000 and len(sizes) <= 2 * sum(sizes) / 30_000 + 1 and sum(_held(table, spark).values()) == 720
    names = {p.part for p in table.parts(spark)}
    table.pack(spark)
    assert {p.part for p in table.parts(spark)} == names  # nothing to gain: nothing is written again


def test_empty_archive(spark, scratch):
    table = archives.Archive(f"{scratch}/a")
    assert table.read(spark).count() == 0 and table.counts(spark).count() == 0 and table.parts(spark) == []
    table(_batches(spark, 1)[0].limit(0), 0)
    table.pack(spark)
    assert table.read(spark).count() == 0


def test_stream_with_restarts_holds_every_message_once(spark):
    table = stream_runs.packed_archive(spark, SF_SMALL)
    assert table.read(spark).select("raw_payload.arrival_seq").distinct().count() == table.read(spark).count() == 1000
    assert any(p.part.startswith("packed-") for p in table.parts(spark))


def test_unknown_fields_of_odd_messages(spark):
    texts = ['{"event_id":"a","extra":1,"machine":{"k":[1,2]}}', '{"event_id":"b","extra":"x"}', '{"event_id":"c"}', "{}", "[1,2]", "7", '"text"', "null",
             '{"event_id":"d"', "", None, "not json", '{"extra":null}', '{"field":1,"value":2,"kind":3}', '{"event_id":"e","extra":1,"extra":2}', '{"it\'s":true}']
    a = spark.createDataFrame([(i, t, "mine", "mine") for i, t in enumerate(texts)], "n int, raw_text string, year string, month string")
    got = {(r.n, r.field): (r.kind, r.text) for r in archives.unknown_fields(a).selectExpr("n", "field", "kind", "to_json(value) AS text").collect()}
    assert got == {(0, "extra"): ("BIGINT", "1"), (0, "machine"): ("OBJECT<k: ARRAY<BIGINT>>", '{"k":[1,2]}'), (1, "extra"): ("STRING", '"x"'),
                   (12, "extra"): ("VOID", "null"), (13, "field"): ("BIGINT", "1"), (13, "value"): ("BIGINT", "2"), (13, "kind"): ("BIGINT", "3"), (15, "it's"): ("BOOLEAN", "true")}
    assert sorted(r.n for r in archives.malformed(a).collect()) == [8, 9, 10, 11, 14]
    assert archives.malformed(a).where("n = 8").first().raw_text == '{"event_id":"d"'
    assert archives.unknown_fields(a, known=("it's", "a\\b")).where("n = 15").count() == 0
    assert archives.field_summary(a.limit(0)).count() == 0
