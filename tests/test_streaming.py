"""The stream with a folder source: routing, quarantine, repeats, replay and the direct path."""

import json
import shutil

import pytest
from pyspark.sql import functions as F

from vitalflow import schemas as S
from vitalflow.operators import events
from vitalflow.plans.proxy import Clinic
from vitalflow.sources import direct_append, id_index, publish_events, read_event_stream, read_realtime
from vitalflow.sources import realtime as R
from vitalflow.sources.id_index import IN_THRESHOLD, EventIds, slice_of
from vitalflow.streaming import ingest, start_ingest, start_window_counts
from vitalflow.streaming.confirm import published_stream, start_confirmations, stored_stream


def line(event_id, kind="CONDITION", patient="p", at="2026-09-01T10:00:00Z", **payload):
    body = {"CODE": "c", "DESCRIPTION": "d", "START_DATE": "2026-01-01", **payload}
    return json.dumps({"event_id": event_id, "patient_id": patient, "event_type": kind, "event_timestamp": at, "payload": body})


def drop(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def run(spark, folder, root, checkpoint, **kw):
    raw = read_event_stream(spark, "text", path=str(folder))
    q = start_ingest(raw, str(root), str(checkpoint), once=True, **kw)
    q.awaitTermination(120)
    assert q.exception() is None


def ids(spark, root, table="RT_CONDITIONS"):
    return sorted(r[0] for r in read_realtime(spark, str(root), table).select("EVENT_ID").collect())


def test_routes_rejects_and_drops_repeats(spark, tmp_path):
    inbox, root, ck = tmp_path / "in", tmp_path / "rt", tmp_path / "ck"
    seen = []
    drop(inbox, "1.txt", [line("a"), line("a"), line("b", kind="ALLERGY"), line("x", kind="LAB_RESULT"), line("y", patient=" "), "garbage"])
    run(spark, inbox, root, ck, on_counts=lambda i, c: seen.append(c))
    drop(inbox, "2.txt", [line("a"), line("c"), line("old", at="1999-01-01T00:00:00Z")])
    run(spark, inbox, root, ck)
    assert ids(spark, root) == ["a", "c", "old"], "a repeat is dropped, a late event is kept"
    assert ids(spark, root, "RT_ALLERGIES") == ["b"] and ids(spark, root, "RT_MEDICATIONS") == []
    assert seen[0] == {"CONDITION": 1, "ALLERGY": 1}
    bad = spark.read.parquet(R.table_path(str(root), R.QUARANTINE))
    assert {r["REASON"] for r in bad.collect()} == {events.REJECT_TYPE, events.REJECT_PATIENT}
    assert bad.count() == 3


def test_running_a_batch_again_gives_the_same_rows(spark, tmp_path):
    root = str(tmp_path / "rt")
    raw = spark.createDataFrame([(line("a"),), (line("b"),)], "value string").withColumn("ARRIVAL_TS", F.current_timestamp())
    envelope = raw.select(F.from_json("value", S.ENVELOPE_SCHEMA).alias("e"), "ARRIVAL_TS").select("e.*", "ARRIVAL_TS")
    batch = events.judge(events.identify(envelope))
    write = ingest.route_batch(root, "s")
    write(batch, 0)
    write(batch, 0)
    assert ids(spark, root) == ["a", "b"]
    write(batch.filter("event_id = 'a'").withColumn("event_id", F.lit("z")), 1)
    assert ids(spark, root) == ["a", "b", "z"]


def test_direct_append_after_stream_adds_only_new_events(spark, tmp_path):
    inbox, root, ck = tmp_path / "in", tmp_path / "rt", tmp_path / "ck"
    drop(inbox, "1.txt", [line("a"), line("b")])
    run(spark, inbox, root, ck)
    batch = events.parse_envelope(spark.createDataFrame([(line("a"),), (line("n"),), (line("n"),), (line("q", patient=""),)], "value string"))
    for _ in range(2):
        assert direct_append(batch, str(root), "1") == {"CONDITION": 1}
    assert ids(spark, root) == ["a", "b", "n"]
    tables = R.realtime_state(spark, str(root))
    wanted = spark.createDataFrame([("n", "CONDITION"), ("n", "ALLERGY"), ("gone", "CONDITION")], "event_id string, event_type string")
    assert [r["event_id"] for r in events.persisted_events(wanted, tables).collect()] == ["n"]
    assert events.persisted_events(wanted, tables, pending=True).count() == 2


def test_a_rejected_event_and_its_correction(spark, tmp_path):
    inbox, root, ck = tmp_path / "in", tmp_path / "rt", tmp_path / "ck"
    drop(inbox, "1.txt", [line("a", CODE=""), line("a"), line("a", CODE="")])
    run(spark, inbox, root, ck)
    assert ids(spark, root) == ["a"]
    bad = spark.read.parquet(R.table_path(str(root), R.QUARANTINE))
    assert bad.count() == 2


def test_broken_lines_are_kept_with_their_text(spark, tmp_path):
    inbox, root, ck = tmp_path / "in", tmp_path / "rt", tmp_path / "ck"
    broken = ["garbage", "{broken", "[1]"]
    drop(inbox, "1.txt", broken)
    run(spark, inbox, root, ck)
    bad = spark.read.parquet(R.table_path(str(root), R.QUARANTINE)).collect()
    assert sorted(r["RAW"] for r in bad) == sorted(broken)
    assert len({r["event_id"] for r in bad}) == 3


def test_stream_after_direct_append_stores_nothing_twice(spark, tmp_path):
    inbox, root, ck = tmp_path / "in", tmp_path / "rt", tmp_path / "ck"
    untimed = [line("u", at=""), line("v", at="garbled")]
    batch = events.parse_envelope(spark.createDataFrame([(x,) for x in [line("a"), *untimed]], "value string"))
    assert direct_append(batch, str(root), "1") == {"CONDITION": 3}
    drop(inbox, "1.txt", [line("a"), line("b"), *untimed])
    run(spark, inbox, root, ck)
    assert ids(spark, root) == ["a", "b", "u", "v"]
    days = read_realtime(spark, str(root), "RT_CONDITIONS", stored=True).filter("EVENT_DATE is null")
    assert days.count() == 2, "events without a time of their own share a folder"


def test_compaction_keeps_rows_and_survives_replay(spark, tmp_path):
    root = str(tmp_path / "rt")
    for i in range(3):
        batch = events.parse_envelope(spark.createDataFrame([(line(f"{i}{k}"),) for k in "ab"], "value string"))
        direct_append(batch, root, str(i))
    before = ids(spark, root)
    assert R.compact_day(spark, root, "RT_CONDITIONS", "2026-09-01", "n1") == 3
    assert ids(spark, root) == before
    direct_append(batch, root, "2")
    assert ids(spark, root) == before
    assert R.compact_day(spark, root, "RT_CONDITIONS", "2026-09-01", "n1") == 0


def test_publishing_keeps_the_payload(spark, tmp_path):
    box = tmp_path / "topic"
    box.mkdir()
    fields = "event_id string, patient_id string, event_type string, event_timestamp string, payload string"
    body = '{"UNITS":"kg","DESCRIPTION":"Body Weight","OBSERVATION_DATE":"2026-09-01","VALUE_NUMERIC":72.5,"EXTRA":{"a":[1,null]}}'
    rows = [("e", "p", "OBSERVATION", "2026-09-01T00:00:00Z", body), ("b", "p", "OBSERVATION", None, "{broken")]
    df = spark.createDataFrame(rows, fields)
    rejected = publish_events(df, "text", path=str(box))
    assert [r["event_id"] for r in rejected.collect()] == ["b"]
    sent = [json.loads(r[0])["payload"] for r in spark.read.text(str(box)).collect()]
    assert sent == [{**json.loads(body), "READING_SEQ": 1, "ENCOUNTER_ID": None}]
    rejected = publish_events(df, "text", path=str(tmp_path / "as_is"), validate=False)
    assert [r["REASON"] for r in rejected.collect()] == [events.REJECT_PAYLOAD]
    sent = [json.loads(r[0])["payload"] for r in spark.read.text(str(tmp_path / "as_is")).collect()]
    assert sent == [json.loads(body)]


def test_the_earlier_copy_wins(spark):
    fields = "event_id string, patient_id string, event_type string, event_timestamp string, payload string"
    rows = [("a", None, "CONDITION", "2026-09-02T00:00:00Z", "{}"), ("a", "p", "CONDITION", "2026-09-01T00:00:00Z", "{}"),
            ("", "p", "CONDITION", "2026-09-01T00:00:00Z", "{}"), (None, "q", "CONDITION", "2026-09-01T00:00:00Z", "{}")]
    once = events.dedup_events(events.identify(spark.createDataFrame(rows, fields))).collect()
    assert len(once) == 3, "events without an id are not copies of one another"
    assert [r["patient_id"] for r in once if r["event_id"] == "a"] == ["p"]


def test_equal_readings_are_two_events(spark):
    made = spark.createDataFrame([("p", "Body Weight", "2026-09-01", 99.9)] * 2, "PATIENT_ID string, DESCRIPTION string, OBSERVATION_DATE string, VALUE_NUMERIC double")
    sent = events.make_observation_events(made, F.lit("2026-09-01 10:00:00").cast("timestamp"))
    assert len({r["event_id"] for r in sent.collect()}) == 2
    assert {r["event_timestamp"] for r in sent.collect()} == {"2026-09-01T10:00:00Z"}


def test_publish_then_consume(spark, tmp_path):
    box, root = tmp_path / "topic", tmp_path / "rt"
    box.mkdir()
    made = spark.createDataFrame([("p", "Body Weight", "2026-09-01", 99.9)], "PATIENT_ID string, DESCRIPTION string, OBSERVATION_DATE string, VALUE_NUMERIC double")
    sent = events.make_observation_events(made)
    wrong = sent.withColumn("event_type", F.lit("LAB_RESULT"))
    rejected = publish_events(sent.unionByName(wrong), "text", path=str(box))
    assert [r["REASON"] for r in rejected.collect()] == [events.REJECT_TYPE]
    run(spark, box, root, tmp_path / "ck")
    row = read_realtime(spark, str(root), "RT_OBSERVATIONS").first()
    assert row["VALUE_NUMERIC"] == 99.9 and row["READING_SEQ"] == 1


def test_window_counts_close_with_the_watermark(spark, tmp_path):
    inbox = tmp_path / "in"
    drop(inbox, "1.txt", [line("a"), line("b"), line("c", at="2026-09-02T00:00:00Z")])
    out = str(tmp_path / "out")
    raw = read_event_stream(spark, "text", path=str(inbox))
    start_window_counts(raw, out, str(tmp_path / "ck"), lateness="1 hour", once=True).awaitTermination(120)
    drop(inbox, "2.txt", [line("d", at="2026-09-05T00:00:00Z")])
    raw = read_event_stream(spark, "text", path=str(inbox))
    start_window_counts(raw, out, str(tmp_path / "ck"), lateness="1 hour", once=True).awaitTermination(120)
    got = {str(r["WINDOW_START"])[:10]: r["EVENT_COUNT"] for r in spark.read.parquet(out).collect()}
    assert got["2026-09-01"] == 2 and got["2026-09-02"] == 1 and "2026-09-05" not in got


def test_a_date_far_ahead_closes_no_window(spark, tmp_path):
    inbox, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    drop(inbox, "1.txt", [line("far", at="2999-01-01T00:00:00Z")])
    start_window_counts(read_event_stream(spark, "text", path=str(inbox)), out, ck, lateness="400 days", once=True).awaitTermination(120)
    drop(inbox, "2.txt", [line("a"), line("a"), line("b")])
    start_window_counts(read_event_stream(spark, "text", path=str(inbox)), out, ck, lateness="400 days", once=True).awaitTermination(120)
    state = spark.read.format("statestore").option("operatorId", 0).load(ck)
    windows = {str(r["key"]["window"]["start"])[:10]: r["value"]["count"] for r in state.collect()}
    assert windows["2026-09-01"] == 2, "late but in time, and copies count once"
    assert not any(day.startswith("2999") for day in windows)


@pytest.mark.parametrize("table", list(S.REALTIME_SCHEMAS))
def test_empty_tables_are_readable(spark, tmp_path, table):
    R.create_realtime_tables(spark, str(tmp_path))
    assert read_realtime(spark, str(tmp_path), table).count() == 0


# --- the id index, one write a batch, confirmation ------------------------------------------
def _batch(spark, *event_ids, at="2026-09-01T10:00:00Z"):
    return events.parse_envelope(spark.createDataFrame([(line(i, at=at),) for i in event_ids], "value string"))


def _scanned(df):
    """Rows that the scans of a collected plan gave out."""
    leaves, total = df._jdf.queryExecution().executedPlan().collectLeaves(), 0
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numOutputRows")
        total += metric.get().value() if metric.isDefined() else 0
    return total


def test_a_lookup_reads_only_row_groups_that_may_hold_its_ids(spark, tmp_path):
    index = EventIds(spark, str(tmp_path))
    for k in range(2):
        ids = spark.range(k * 40_000, (k + 1) * 40_000).selectExpr("'e' || id AS event_id", "'CONDITION' AS event_type")
        index.append(ids, f"b{k}")
        assert index.settle(f"r{k}") == 1
    asked = [f"e{i}" for i in (5, 77, 60_000)] + [f"new{i}" for i in range(20)]
    named = spark.createDataFrame([(i, "CONDITION") for i in asked], "event_id string, event_type string")
    numbered = [tuple(r) for r in named.select(slice_of(), "event_id").collect()]
    old = spark.conf.get(IN_THRESHOLD)
    spark.conf.set(IN_THRESHOLD, "1000")
    try:
        found = index.lookup(numbered)
        assert sorted(r["event_id"] for r in found.collect()) == ["e5", "e60000", "e77"]
        # a slice of a run holds some 600 ids; three slices hold one each, and the filters let few others pass
        assert _scanned(found) <= 6 * 700
    finally:
        spark.conf.set(IN_THRESHOLD, old)
    assert {r["event_id"] for r in index.stored(named, "other").collect()} == {"e5", "e77", "e60000"}
    assert {r["event_id"] for r in index.stored(named, "b0").collect()} == {"e60000"}, "a batch's own rows do not count"


def test_ids_are_known_whatever_part_of_the_index_holds_them(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    assert direct_append(_batch(spark, "a", "b"), root, "1") == {"CONDITION": 2}
    index = EventIds(spark, root)
    assert index.settle("s1") == 1 and index.settle("s1") == 0
    assert direct_append(_batch(spark, "b", "c", at=""), root, "2") == {"CONDITION": 1}
    assert direct_append(_batch(spark, "a", "c", "d"), root, "3") == {"CONDITION": 1}
    assert index.settle("s2", whole=True) == 2
    monkeypatch.setattr(id_index, "LOOKUP_IDS", 2)  # more than that: the whole index is read
    assert direct_append(_batch(spark, "a", "b", "c", "d"), root, "4") == {}
    assert direct_append(_batch(spark, "a", "c", "d"), root, "3") == {"CONDITION": 1}, "a batch may run again"
    assert ids(spark, root) == ["a", "b", "c", "d"]


def test_an_index_is_made_from_tables_that_have_none(spark, tmp_path):
    root = str(tmp_path)
    direct_append(_batch(spark, "a", "b"), root, "1")
    shutil.rmtree(tmp_path / id_index.FOLDER)
    assert direct_append(_batch(spark, "b", "c"), root, "2") == {"CONDITION": 1}
    assert ids(spark, root) == ["a", "b", "c"]


def test_one_job_writes_rows_as_each_table_alone_would(spark, tmp_path, sf_dir):
    c = Clinic(spark, sf_dir)
    good = events.ingest(c.events, c.now)
    wide = events.parse_typed(good, c.now)
    for kind, table in S.EVENT_TABLES.items():
        own = wide.filter(F.col("TABLE_NAME") == table).select(*S.REALTIME_SCHEMAS[table].names)
        alone = events.parse_type(good, kind, c.now)
        assert own.count() > 0 and own.exceptAll(alone).isEmpty() and alone.exceptAll(own).isEmpty()
    R.append_events(good, str(tmp_path), "k")
    stored = R.realtime_state(spark, str(tmp_path))
    assert sum(t.count() for t in stored.values()) == good.count()


def test_confirmed_late_and_lost_events(spark, tmp_path):
    kinds = {"p": "event_id string, event_type string, PUBLISHED_TS timestamp", "s": "event_id string, event_type string, STORED_TS timestamp"}

    def put(side, n, *rows):
        df = spark.createDataFrame([(i, "CONDITION", at) for i, at in rows], kinds[side].replace("timestamp", "string"))
        df.selectExpr("event_id", "event_type", f"to_timestamp({df.columns[2]}) AS {df.columns[2]}").coalesce(1).write.parquet(str(tmp_path / side / str(n)))

    def go():
        sides = [spark.readStream.schema(kinds[s]).option("recursiveFileLookup", "true").parquet(str(tmp_path / s)) for s in "ps"]
        q = start_confirmations(*sides, str(tmp_path / "out"), str(tmp_path / "ck"), once=True)
        q.awaitTermination(120)
        assert q.exception() is None
        return {r["event_id"]: r["STATUS"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}

    day = "2026-09-01 10:00:"
    put("p", 0, ("a", day + "00"), ("a", day + "01"), ("late", day + "00"), ("lost", day + "00"))
    put("s", 0, ("a", day + "05"))
    assert go() == {"a": "CONFIRMED"}
    put("p", 1, ("end", "2026-09-01 11:00:00"))
    put("s", 1, ("late", day + "31"), ("end", "2026-09-01 11:00:01"))
    go()
    put("p", 2, ("last", "2026-09-01 12:00:00"))
    put("s", 2, ("last", "2026-09-01 12:00:00"))
    got = go()
    assert {k: got[k] for k in ("a", "late", "lost", "end")} == {"a": "CONFIRMED", "late": "TIMED_OUT", "lost": "TIMED_OUT", "end": "CONFIRMED"}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_the_stream_confirms_what_it_stored(spark, tmp_path):
    inbox, root = tmp_path / "in", tmp_path / "rt"
    drop(inbox, "1.txt", [line("a"), line("x", kind="LAB_RESULT")])
    run(spark, inbox, root, tmp_path / "ck")
    raw = read_event_stream(spark, "text", path=str(inbox))
    q = start_confirmations(published_stream(raw), stored_stream(spark, str(root)), str(tmp_path / "out"), str(tmp_path / "ck2"), within="1 hour", once=True)
    q.awaitTermination(120)
    assert q.exception() is None
    # the inbox is read as published after it was stored, so nothing is confirmed and nothing timed out yet
    assert spark.read.schema("event_id string, STATUS string").parquet(str(tmp_path / "out")).count() == 0
