"""Pages, whole extractions and overlaps; loads that stop at any step and are run again."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from visitledger.config import FEEDS, Settings
from visitledger.plans import load
from visitledger.sources import bronze, delivery, dims
from visitledger.streaming import landing
from visitledger.streaming.landing import stream_landed

from test_load import land_file, response, user_row, users

USERS = FEEDS["usuarios"]
S = Settings()


class Inbox:
    """Files that appear whole, each a second after the one before."""

    def __init__(self, wh, tmp_path):
        self.wh, self.root, self.time = wh, tmp_path, 1_700_000_000
        (tmp_path / "inbox").mkdir()
        (tmp_path / "out").mkdir()

    def drop(self, name, rows, total=None, without=None, cut=False):
        body = response(USERS, rows)
        body["rowCount"] = len(rows) if total is None else total
        if without:
            at = USERS.metrics.index(without)
            body["metricHeaders"].pop(at)
            for r in body["rows"]:
                r["metricValues"].pop(at)
        text = json.dumps(body)
        made = self.root / "out" / name.replace("/", "_")
        made.write_text(text[:len(text) // 2] if cut else text, encoding="utf-8")
        self.time += 1
        os.utime(made, (self.time, self.time))
        target = self.root / "inbox" / name
        target.parent.mkdir(parents=True, exist_ok=True)
        os.rename(made, target)

    def run(self):
        stream_landed(self.wh, USERS, S, str(self.root / "inbox"), str(self.root / "chk")).awaitTermination()
        return users(self.wh)

    def forget_commit(self):
        """The commit of the last batch is lost, so the batch runs again."""
        commits = self.root / "chk" / "commits"
        last = max(int(f.name) for f in commits.iterdir() if f.name.isdigit())
        for name in (str(last), f".{last}.crc"):
            os.rename(commits / name, self.root / f"lost-{last}-{name}-{self.time}")
            self.time += 1

    def states(self):
        ledger = self.wh.log("pages").where(F.col("relatorio") == USERS.name)
        return {r["extraction"]: r["state"] for r in delivery.reconciled(ledger).collect()}

    def counts(self):
        wh = self.wh
        logs = {n: wh.log(n).count() for n in ("snapshots", "control", "pages", "taken")}
        for name in (USERS.name, f"{USERS.name}_files"):
            folder = self.root / "wh" / "quarantine" / name
            logs[name] = wh.spark.read.parquet(str(folder)).count() if folder.exists() else 0
        return logs


@pytest.fixture
def inbox(warehouse, tmp_path):
    return Inbox(warehouse, tmp_path)


def test_overlapping_extractions_of_one_batch(inbox):
    inbox.drop("b.json", [user_row("20240101", 10), user_row("20240102", 11)])
    inbox.drop("a.json", [user_row("20240102", 12), user_row("20240103", 13)])
    assert inbox.run() == {(1, "Brazil"): 10, (2, "Brazil"): 12, (3, "Brazil"): 13}
    assert inbox.wh.silver("ga4_usuarios").count() == 3 and inbox.counts()["control"] == 2


def test_an_extraction_over_two_batches_is_used_once_and_whole(inbox):
    inbox.drop("old.json", [user_row("20240101", 1), user_row("20240102", 2)])
    inbox.drop("x/page-2.json", [user_row("20240102", 5, country="Chile")], total=3)
    assert inbox.run() == {(1, "Brazil"): 1, (2, "Brazil"): 2}
    assert inbox.states() == {"old": "whole", "x": "short"}
    inbox.drop("x/page-1.json", [user_row("20240101", 6), user_row("20240102", 7)], total=3)
    whole = {(1, "Brazil"): 6, (2, "Brazil"): 7, (2, "Chile"): 5}
    assert inbox.run() == whole
    before = inbox.counts()
    assert before["taken"] == 2 and before["control"] == 2
    # a page that arrives once more after its extraction was used changes nothing
    inbox.drop("x/page-1-again.json", [user_row("20240101", 99), user_row("20240102", 98)], total=3)
    assert inbox.run() == whole and inbox.counts()["taken"] == 2
    # staged rows of used extractions are gone once a later batch ran
    left = [f.name for f in (inbox.root / "wh" / "landing" / USERS.name).iterdir()]
    assert left == ["entry=usuarios-stream-000000000002"]


def test_a_replayed_batch_adds_nothing(inbox):
    inbox.drop("a.json", [user_row("20240101", 1), user_row("", 2)])
    inbox.drop("cut.json", [user_row("20240101", 1)], cut=True)
    assert inbox.run() == {(1, "Brazil"): 1}
    first = inbox.counts()
    assert first == {"snapshots": 1, "control": 1, "pages": 2, "taken": 1, "usuarios": 1, "usuarios_files": 1}
    for _ in range(2):
        inbox.forget_commit()
        assert inbox.run() == {(1, "Brazil"): 1} and inbox.counts() == first


@pytest.mark.parametrize("step", ["stage", "take", "append_snapshots", "register_load", "note_taken", "refresh_silver"])
def test_a_batch_that_dies_is_finished_by_the_next_run(inbox, monkeypatch, step):
    def dies(*args, **kwargs):
        raise RuntimeError("lost driver")

    inbox.drop("x/page-1.json", [user_row("20240101", 1), user_row("", 2)], total=3)
    inbox.run()
    inbox.drop("x/page-2.json", [user_row("20240102", 3)], total=3)
    if step == "note_taken":
        wh = type(inbox.wh)
        note = wh.note
        monkeypatch.setattr(wh, "note", lambda self, name, *a: dies() if name == "taken" else note(self, name, *a))
    else:
        owner = {"stage": delivery, "take": delivery, "refresh_silver": landing}.get(step, bronze)
        monkeypatch.setattr(owner, step, dies)
    with pytest.raises(Exception, match="lost driver"):
        inbox.run()
    monkeypatch.undo()
    assert inbox.run() == {(1, "Brazil"): 1, (2, "Brazil"): 3}
    assert inbox.counts() == {"snapshots": 2, "control": 1, "pages": 2, "taken": 1, "usuarios": 1, "usuarios_files": 0}


def test_unusable_pages_hold_their_extraction_back(inbox):
    inbox.drop("cut/page-1.json", [user_row("20240101", 1)], cut=True)
    inbox.drop("bare/page-1.json", [user_row("20240102", 2)], without="sessions")
    inbox.drop("many/page-1.json", [user_row("20240103", 3), user_row("20240103", 3, country="Peru")], total=1)
    inbox.drop("gap/page-1.json", [user_row("20240104", 4)], total=2)
    inbox.drop("gap/page-3.json", [user_row("20240104", 4, country="Peru")], total=2)
    assert inbox.run() == {}
    assert inbox.states() == {"cut": "corrupt", "bare": "headers", "many": "surplus", "gap": "short"}
    aside = inbox.wh.spark.read.parquet(inbox.wh.path("quarantine", "usuarios_files")).collect()
    assert [r["extraction"] for r in aside] == ["cut"] and aside[0]["corrupt_text"].startswith("{")
    inbox.drop("cut/page-1.second.json", [user_row("20240101", 1)])
    inbox.drop("bare/page-1.second.json", [user_row("20240102", 2)])
    assert inbox.run() == {(1, "Brazil"): 1, (2, "Brazil"): 2}


def body_file(tmp_path, name, **changes):
    folder = land_file(tmp_path, name, USERS, [user_row("20240101", 1)])
    path = tmp_path / name / "page-1.json"
    body = json.loads(path.read_text())
    body.update({k: v for k, v in changes.items() if k != "cut"})
    text = json.dumps(body)
    path.write_text(text[:200] if changes.get("cut") else text)
    return folder


@pytest.mark.parametrize(("changes", "state"), [
    ({"rowCount": 250_000}, "short, 1 of 250000 rows"), ({"cut": True}, "corrupt"),
    ({"metricHeaders": [{"name": m} for m in USERS.metrics[1:]]}, "headers"),
])
def test_a_batch_load_refuses_what_is_not_whole(warehouse, tmp_path, changes, state):
    with pytest.raises(delivery.IncompleteDelivery, match=state):
        load.land(warehouse, USERS, body_file(tmp_path, "a", **changes), dt.datetime(2024, 1, 2), snapshot_id="one")
    assert warehouse.snapshots().count() == 0 and warehouse.control().count() == 0
    # the same load with the whole file goes through, under the same name
    load.land(warehouse, USERS, body_file(tmp_path, "b"), dt.datetime(2024, 1, 2), snapshot_id="one")
    load.refresh_silver(warehouse, USERS, S)
    assert users(warehouse) == {(1, "Brazil"): 1} and warehouse.log("pages").count() == 1


def test_pages_of_a_batch_load(warehouse, tmp_path):
    folder = land_file(tmp_path, "a", USERS, [user_row("20240101", 1)])
    for page in (1, 2):
        body = response(USERS, [user_row("20240101", page, country=f"c{page}")]) | {"rowCount": 2}
        (tmp_path / "a" / f"page-{page}.json").write_text(json.dumps(body))
    load.land(warehouse, USERS, folder, dt.datetime(2024, 1, 2))
    load.refresh_silver(warehouse, USERS, S)
    assert users(warehouse) == {(1, "c1"): 1, (1, "c2"): 2}
    assert [tuple(r)[4:] for r in warehouse.log("taken").select("*").drop("entry").collect()] == [(2, 2)]


# ---- replacement that survives a dead driver -----------------------------------------------------------------------

def dying(monkeypatch, wh, step, after=False):
    kind = type(wh)
    real = getattr(kind, step)

    def dies(self, *args, **kwargs):
        if after:
            real(self, *args, **kwargs)
        raise RuntimeError("lost driver")

    monkeypatch.setattr(kind, step, dies)


STEPS = [("_switch", False), ("_switch", True), ("_retire", False), ("_retire", True)]


@pytest.mark.parametrize(("step", "after"), [*STEPS, ("note", False)])
def test_rebuild_dies_at_any_step(warehouse, spark, monkeypatch, step, after):
    wh = warehouse
    first = [user_row("20240101", 1), user_row("20240102", 2)]
    bronze.append_snapshot(wh, USERS, spark.createDataFrame(first), dt.datetime(2024, 1, 3))
    load.refresh_silver(wh, USERS, S)
    want = {(1, "Brazil"): 1, (2, "Brazil"): 2}
    bronze.append_snapshot(wh, USERS, spark.createDataFrame([user_row("20240102", 8)]), dt.datetime(2024, 1, 4))
    dying(monkeypatch, wh, step, after)
    with pytest.raises(RuntimeError):
        load.rebuild_silver(wh, USERS, S)
    monkeypatch.undo()
    new = {**want, (2, "Brazil"): 8}
    assert users(wh) == (want if (step, after) == ("_switch", False) else new)
    load.refresh_silver(wh, USERS, S)
    assert users(wh) == new and load.refresh_silver(wh, USERS, S) == []
    load.rebuild_silver(wh, USERS, S)
    load.rebuild_silver(wh, USERS, S)
    assert users(wh) == new
    folder = os.listdir(wh.path("silver", "ga4_usuarios"))
    assert len([f for f in folder if f != "_versions"]) == 2


@pytest.mark.parametrize(("step", "after"), STEPS)
def test_dimension_swap_dies_at_any_step(warehouse, spark, monkeypatch, step, after):
    wh = warehouse
    dims.load_dimensions(wh)
    seed = dims.seed_frames(spark)
    seed["dim_painel"] = seed["dim_painel"].where("painel <> 'IBGE Abate'")
    dying(monkeypatch, wh, step, after)
    with pytest.raises(RuntimeError):
        dims.load_dimensions(wh, seed)
    monkeypatch.undo()
    assert wh.dim("dim_painel").count() == 20  # the panel that left the seed is still there, active or not
    dims.load_dimensions(wh, seed)
    off = [r["painel"] for r in wh.dim("dim_painel").where("NOT ativo").collect()]
    assert off == ["IBGE Abate"] and wh.dim("dim_painel").count() == 20


def test_open_readers_keep_their_version(warehouse, spark):
    wh = warehouse
    dims.load_dimensions(wh)
    before = wh.dim("dim_painel")
    wh.replace_dim("dim_painel", wh.dim("dim_painel").where("false"))
    assert before.count() == 20 and wh.dim("dim_painel").count() == 0


def test_imports_note_their_own_lines(warehouse, spark):
    for day in (1, 2):
        rows = [(json.dumps([user_row(f"2024010{day}", day)]), dt.datetime(2024, 1, day + 1))]
        for _ in range(2):
            bronze.import_payloads(warehouse, USERS, spark.createDataFrame(rows, "payload string, data_extracao timestamp_ntz"))
    assert warehouse.snapshots().count() == 2


# ---- constraints, statistics and ranges of a load ------------------------------------------------------------------

@pytest.mark.parametrize(("bad", "said"), [
    ({"host": None}, "ga4_usuarios.hostname is NULL"), ({"country": "x" * 101}, "ga4_usuarios.country is longer than 100: xxx"),
])
def test_a_row_that_breaks_a_constraint_stops_the_load(warehouse, spark, bad, said):
    wh = warehouse
    bronze.append_snapshot(wh, USERS, spark.createDataFrame([user_row("20240101", 1)]), dt.datetime(2024, 1, 2))
    load.refresh_silver(wh, USERS, S)
    rows = [user_row("20240101", 5), user_row("20240101", 6, **bad)]
    bronze.append_snapshot(wh, USERS, spark.createDataFrame(rows), dt.datetime(2024, 1, 3))
    for run in (load.refresh_silver, load.rebuild_silver):
        with pytest.raises(Exception, match=said):
            run(wh, USERS, S)
        assert users(wh) == {(1, "Brazil"): 1} and wh.loaded().count() == 1


def test_statistics_of_the_loaded_days(warehouse, spark):
    from visitledger.plans import quality, weekly
    from visitledger.plans.gold import Silver

    wh, sunday = warehouse, dt.date(2024, 1, 7)
    rows = [user_row("20240106", 1), user_row("20240107", 2), user_row("20240107", 3, country="Peru")]
    bronze.append_snapshot(wh, USERS, spark.createDataFrame(rows), dt.datetime(2024, 1, 8, 9))
    load.refresh_silver(wh, USERS, S)
    facts = lambda: {r["event_date"].day: (r["linhas"], r["data_extracao"].day) for r in wh.days().collect()}
    assert facts() == {6: (1, 8), 7: (2, 8)}
    check = quality.week_completeness(Silver.of(wh, S), sunday)
    assert "/silver/" not in check._jdf.queryExecution().executedPlan().toString()
    assert {r["tabela"]: r["problem"] for r in check.collect()} == {"ga4_eventos": "missing_days", "ga4_usuarios": "extracted_early"}
    bronze.append_snapshot(wh, USERS, spark.createDataFrame(rows[:2]), dt.datetime(2024, 1, 8, 13))
    load.refresh_silver(wh, USERS, S)
    assert facts() == {6: (1, 8), 7: (1, 8)}
    load.rebuild_silver(wh, USERS, S)
    assert facts() == {6: (1, 8), 7: (1, 8)}
    assert [r["tabela"] for r in quality.week_completeness(Silver.of(wh, S), sunday).collect()] == ["ga4_eventos"]
    with pytest.raises(Exception, match="ga4_eventos: missing_days"):
        weekly.closed_week_dataset(Silver.of(wh, S), sunday).collect()


def test_islands(spark):
    days = [("a", d) for d in (1, 2, 2, 3, 5, 8, 9)] + [("b", 4)]
    df = spark.createDataFrame([(k, dt.date(2024, 1, d)) for k, d in days], "k string, event_date date")
    got = sorted((r["k"], r["range_start"].day, r["range_end"].day) for r in bronze.islands(df, ["k"]).collect())
    assert got == [("a", 1, 3), ("a", 5, 5), ("a", 8, 9), ("b", 4, 4)]


def test_loads_take_their_ranges_from_the_logs(warehouse, tmp_path):
    """A history in months, a daily window, an outage of four days and the wider window after it."""
    wh, inbox = warehouse, str(tmp_path / "inbox")
    (tmp_path / "inbox" / "usuarios").mkdir(parents=True)

    def deliver(start, end, value):
        days = [start + dt.timedelta(days=n) for n in range((end - start).days + 1)]
        land_file(tmp_path / "inbox" / "usuarios", f"{start}_{end}", USERS, [user_row(f"{x:%Y%m%d}", value) for x in days])

    def wanted(today, history=False):
        rows = load.wanted_ranges(wh, S, today, history).where("relatorio = 'usuarios'").collect()
        return sorted((r["range_start"], r["range_end"]) for r in rows)

    def run(today, history=False):
        done = load.land_delivered(wh, S, inbox, today, dt.datetime.combine(today, dt.time(15)), history)
        load.refresh_silver(wh, USERS, S)
        return [(s, e) for _, s, e in done]

    day = dt.date
    months = wanted(day(2024, 3, 5), history=True)
    assert len(months) == 37 and all(s.month == e.month for s, e in months) and months[-1] == (day(2024, 3, 1), day(2024, 3, 4))
    for start, end in months[-2:]:
        deliver(start, end, 1)
    assert run(day(2024, 3, 5), history=True) == months[-2:]
    assert len(wanted(day(2024, 3, 5), history=True)) == 36  # what was not delivered, and the usual window
    assert wanted(day(2024, 3, 6)) == [(day(2024, 3, 1), day(2024, 3, 5))]
    assert run(day(2024, 3, 6)) == []  # nothing delivered: the window stays open
    assert wanted(day(2024, 3, 10)) == [(day(2024, 3, 1), day(2024, 3, 9))]
    deliver(day(2024, 3, 1), day(2024, 3, 9), 2)
    assert run(day(2024, 3, 10)) == [(day(2024, 3, 1), day(2024, 3, 9))]
    got = {r["event_date"]: r["dau"] for r in wh.silver("ga4_usuarios").collect()}
    assert got == {day(2024, 2, 1) + dt.timedelta(days=n): 1 if n < 29 else 2 for n in range(38)}
    kinds = {r["tipo_carga"]: r["data_fim_janela"] for r in wh.control().orderBy("data_fim_janela").collect()}
    assert kinds == {"historico": day(2024, 3, 4), "incremental": day(2024, 3, 9)}
    assert wanted(day(2024, 3, 11)) == [(day(2024, 3, 6), day(2024, 3, 10))]
