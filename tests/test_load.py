"""Landing, snapshots, idempotent day replacement, dimensions, windows and the streaming form."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from visitledger import seeds
from visitledger.config import FEEDS, Settings
from visitledger.plans import load
from visitledger.plans.gold import Silver, register_views
from visitledger.schemas import SILVER
from visitledger.sources import bronze, dims, landed
from visitledger.sources.silver import typed_rows
from visitledger.streaming.landing import stream_landed

SITE, USERS = FEEDS["site"], FEEDS["usuarios"]
S = Settings()


def response(feed, rows):
    """A delivered response: columnar headers and rows of text values."""
    return {
        "dimensionHeaders": [{"name": n} for n in feed.dimensions],
        "metricHeaders": [{"name": n} for n in feed.metrics],
        "rows": [
            {"dimensionValues": [{"value": r[n]} for n in feed.dimensions], "metricValues": [{"value": r[n]} for n in feed.metrics]}
            for r in rows
        ],
        "rowCount": len(rows),
        "metadata": {"timeZone": "America/Sao_Paulo"},
    }


def user_row(day, dau, host="data.example.org", country="Brazil", sessions="2", engaged="1"):
    return {
        "date": day, "hostName": host, "country": country, "deviceCategory": "desktop", "active1DayUsers": str(dau),
        "active7DayUsers": str(dau), "active28DayUsers": str(dau), "sessions": sessions, "engagedSessions": engaged,
        "userEngagementDuration": "12.345",
    }


def land_file(tmp_path, name, feed, rows):
    folder = tmp_path / name
    folder.mkdir()
    (folder / "page-1.json").write_text(json.dumps(response(feed, rows), indent=1), encoding="utf-8")
    return str(folder)


def users(wh):
    return {(r["event_date"].day, r["country"]): r["dau"] for r in wh.silver("ga4_usuarios").collect()}


def test_snapshots_replace_whole_days(warehouse, tmp_path):
    wh = warehouse
    first = land_file(tmp_path, "a", USERS, [user_row("20240101", 1), user_row("20240101", 5, country=""), user_row("20240102", 2)])
    load.land(wh, USERS, first, dt.datetime(2024, 1, 3, 6))
    assert load.refresh_silver(wh, USERS, S) == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    assert users(wh) == {(1, "Brazil"): 1, (1, "(not set)"): 5, (2, "Brazil"): 2}
    row = wh.silver("ga4_usuarios").where("country = 'Brazil' and dau = 1").first()
    assert (row["site"], str(row["user_engagement_seconds"])) == ("Dados", "12.35")

    # a second run finds nothing to do and changes nothing
    before = sorted(map(tuple, wh.silver("ga4_usuarios").collect()))
    assert load.refresh_silver(wh, USERS, S) == []
    assert sorted(map(tuple, wh.silver("ga4_usuarios").collect())) == before

    # a newer snapshot of day 2 replaces the day, day 1 stays, day 3 is new
    second = land_file(tmp_path, "b", USERS, [user_row("20240102", 7, country="Chile"), user_row("20240103", 3)])
    load.land(wh, USERS, second, dt.datetime(2024, 1, 4, 6))
    assert load.refresh_silver(wh, USERS, S) == [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    assert users(wh) == {(1, "Brazil"): 1, (1, "(not set)"): 5, (2, "Chile"): 7, (3, "Brazil"): 3}

    # a full rebuild gives the same table, and leaves nothing pending
    load.rebuild_silver(wh, USERS, S)
    assert users(wh) == {(1, "Brazil"): 1, (1, "(not set)"): 5, (2, "Chile"): 7, (3, "Brazil"): 3}
    assert load.refresh_silver(wh, USERS, S) == []

    log = sorted((r["data_inicio_janela"].day, r["data_fim_janela"].day, r["qtd_dias"], r["qtd_linhas"]) for r in wh.control().collect())
    assert log == [(1, 2, 2, 3), (2, 3, 2, 2)]


def test_day_without_rows_keeps_or_clears(warehouse, tmp_path):
    wh = warehouse
    load.land(wh, USERS, land_file(tmp_path, "a", USERS, [user_row("20240101", 1), user_row("20240102", 2)]), dt.datetime(2024, 1, 3))
    load.refresh_silver(wh, USERS, S)
    window = (dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    again = land_file(tmp_path, "b", USERS, [user_row("20240102", 9)])
    load.land(wh, USERS, again, dt.datetime(2024, 1, 4), window=window)
    load.refresh_silver(wh, USERS, S)
    assert users(wh) == {(1, "Brazil"): 1, (2, "Brazil"): 9}
    load.land(wh, USERS, again, dt.datetime(2024, 1, 5), window=window, clear_empty_days=True)
    assert load.refresh_silver(wh, USERS, S) == list(window)
    assert users(wh) == {(2, "Brazil"): 9}


def test_interrupted_append_is_repeated_safely(warehouse, spark):
    wh = warehouse
    records = spark.createDataFrame([user_row("20240101", 1), user_row("20240101", 2, country="Peru")])
    for _ in range(2):  # same id twice: the rows are there once
        bronze.append_snapshot(wh, USERS, records, dt.datetime(2024, 1, 2), "fixed-id")
    assert wh.bronze(USERS).count() == 2
    load.refresh_silver(wh, USERS, S)
    assert users(wh) == {(1, "Brazil"): 1, (1, "Peru"): 2}


def test_crash_before_the_load_is_noted(warehouse, spark, monkeypatch):
    wh = warehouse
    records = spark.createDataFrame([user_row("20240101", 1)])
    bronze.append_snapshot(wh, USERS, records, dt.datetime(2024, 1, 2))
    monkeypatch.setattr(load, "_note_loaded", lambda *a: (_ for _ in ()).throw(RuntimeError("lost driver")))
    with pytest.raises(RuntimeError):
        load.refresh_silver(wh, USERS, S)
    monkeypatch.undo()
    assert load.refresh_silver(wh, USERS, S) == [dt.date(2024, 1, 1)]
    assert users(wh) == {(1, "Brazil"): 1}


def test_same_second_snapshots_are_settled_by_id(spark):
    at = dt.datetime(2024, 1, 2)
    log = spark.createDataFrame([(dt.date(2024, 1, 1), "b", at), (dt.date(2024, 1, 1), "a", at)], "event_date date, snapshot_id string, data_extracao timestamp_ntz")
    assert bronze.newest_snapshots(log).first()["snapshot_id"] == "b"


def test_site_feed_carries_segment_flag(warehouse, tmp_path):
    def row(event, sessions, engaged, city=""):
        return {**{n: "x" for n in SITE.dimensions}, "date": "20240101", "hostName": "WWW.example.org", "city": city, "eventName": event,
                "eventCount": "1", "sessions": sessions, "engagedSessions": engaged, "activeUsers": "1", "userEngagementDuration": "1"}

    rows = [row("session_start", "3000", "3"), row("page_view", "3000", "3"), row("session_start", "2", "1", "Recife")]
    load.land(warehouse, SITE, land_file(tmp_path, "a", SITE, rows), dt.datetime(2024, 1, 2))
    load.refresh_silver(warehouse, SITE, S)
    got = warehouse.silver("ga4_eventos")
    assert got.columns == SILVER["ga4_eventos"].names
    assert sorted((r["city"], r["event_name"], r["trafego_valido"], r["site"]) for r in got.collect()) == [
        ("(not set)", "page_view", False, "Institucional"), ("(not set)", "session_start", False, "Institucional"),
        ("Recife", "session_start", True, "Institucional"),
    ]


def test_flatten_pairs_up_to_the_shorter(spark, tmp_path):
    body = response(USERS, [user_row("20240101", 1), user_row("20240102", 2), user_row("", 3)])
    body["rows"][0]["metricValues"] = body["rows"][0]["metricValues"][:2]
    body["rows"][1]["metricValues"].append({"value": "surplus"})
    (tmp_path / "r.json").write_text(json.dumps(body), encoding="utf-8")
    records, rejected = landed.flatten(landed.read_landed(spark, str(tmp_path)), USERS)
    got = {r["date"]: (r["active7DayUsers"], r["sessions"], r["userEngagementDuration"]) for r in records.collect()}
    assert got == {"20240101": ("1", None, None), "20240102": ("2", "2", "12.345")}
    assert rejected.count() == 1


def test_rows_without_a_day_are_set_aside(warehouse, tmp_path, spark):
    load.land(warehouse, USERS, land_file(tmp_path, "a", USERS, [user_row("20240101", 1), user_row("", 3)]), dt.datetime(2024, 1, 2))
    assert warehouse.bronze(USERS).count() == 1
    aside = spark.read.parquet(warehouse.path("quarantine", "usuarios"))
    assert [r["active1DayUsers"] for r in aside.collect()] == ["3"]


def test_impossible_day_is_rejected(spark, tmp_path):
    rows = [user_row("20240101", 1), user_row("20240230", 2), user_row("2024011", 3)]
    records, rejected = landed.flatten(landed.read_landed(spark, land_file(tmp_path, "a", USERS, rows)), USERS)
    assert [r["date"] for r in records.collect()] == ["20240101"]
    assert sorted(r["date"] for r in rejected.collect()) == ["2024011", "20240230"]


def test_imported_payloads(warehouse, spark):
    """Snapshots kept as JSON arrays: two of one day, the newer one wins; a later landing wins over both."""
    old, new = dt.datetime(2024, 1, 2, 6), dt.datetime(2024, 1, 3, 6)
    snapshots = spark.createDataFrame([
        (json.dumps([user_row("20240101", 1), user_row("20240101", 2, country="")]), old),
        (json.dumps([user_row("20240101", 5)]), new), (json.dumps([user_row("20240102", 6)]), new),
    ], "payload string, data_extracao timestamp_ntz")
    bronze.import_payloads(warehouse, USERS, snapshots)
    load.refresh_silver(warehouse, USERS, S)
    assert users(warehouse) == {(1, "Brazil"): 5, (2, "Brazil"): 6}
    assert sorted((r["event_date"].day, r["linhas"]) for r in warehouse.snapshots().collect()) == [(1, 1), (1, 2), (2, 1)]
    bronze.append_snapshot(warehouse, USERS, spark.createDataFrame([user_row("20240102", 9)]), dt.datetime(2024, 1, 4))
    assert load.refresh_silver(warehouse, USERS, S) == [dt.date(2024, 1, 2)]
    assert users(warehouse) == {(1, "Brazil"): 5, (2, "Brazil"): 9}


def test_bad_number_stops_the_load(spark):
    records = spark.createDataFrame([user_row("20240101", 1, sessions="many")]).withColumn("data_extracao", F.lit(None).cast("timestamp_ntz"))
    with pytest.raises(Exception, match="sessions cannot be read as count: many"):
        typed_rows(records, USERS, S).collect()


def test_dimensions_twice_and_soft_delete(warehouse, spark):
    wh = warehouse
    load_twice = []
    for _ in range(2):
        dims.load_dimensions(wh)
        load_twice.append({n: sorted(map(str, wh.dim(n).collect())) for n in ("dim_painel", "dim_painel_alias", "dim_painel_relatorio")})
    assert load_twice[0] == load_twice[1]
    assert [len(v) for v in load_twice[0].values()] == [20, 26, 42]
    seed = dims.seed_frames(spark)
    seed["dim_painel"] = seed["dim_painel"].where("painel <> 'IBGE Abate'")
    dims.load_dimensions(wh, seed)
    panels = {r["painel"]: r["ativo"] for r in wh.dim("dim_painel").collect()}
    assert len(panels) == 20 and [p for p, on in panels.items() if not on] == ["IBGE Abate"]
    dims.load_dimensions(wh)
    assert wh.dim("dim_painel").where("ativo").count() == 20


def test_seed_is_consistent():
    names = {p[0] for p in seeds.PANELS}
    assert {a[1] for a in seeds.ALIASES} <= names and {r[1] for r in seeds.REPORT_IDS} <= names
    assert len({r[0] for r in seeds.REPORT_IDS}) == len(seeds.REPORT_IDS) == 42


@pytest.mark.parametrize("last,start", [
    (dt.date(2024, 1, 30), dt.date(2024, 1, 27)), (dt.date(2024, 1, 10), dt.date(2024, 1, 7)), (None, dt.date(2024, 1, 28)),
])
def test_load_window(spark, last, start):
    control = spark.createDataFrame([("r", last)] if last else [], "relatorio string, data_fim_janela date")
    floors = spark.createDataFrame([("r", dt.date(2023, 1, 1))], "relatorio string, floor date")
    got = bronze.load_window(control, floors, dt.date(2024, 1, 31), S).collect()
    assert [(r["window_start"], r["window_end"]) for r in got] == [(start, dt.date(2024, 1, 30))]


def test_load_window_skips_empty(spark):
    control = spark.createDataFrame([], "relatorio string, data_fim_janela date")
    floors = spark.createDataFrame([("r", dt.date(2024, 2, 1))], "relatorio string, floor date")
    assert bronze.load_window(control, floors, dt.date(2024, 1, 31), S).collect() == []


def test_month_ranges(spark):
    df = spark.createDataFrame([(dt.date(2023, 11, 15), dt.date(2024, 2, 10))], "start date, end date")
    got = [(r["range_start"].isoformat(), r["range_end"].isoformat()) for r in bronze.month_ranges(df).orderBy("range_start").collect()]
    assert got == [("2023-11-15", "2023-11-30"), ("2023-12-01", "2023-12-31"), ("2024-01-01", "2024-01-31"), ("2024-02-01", "2024-02-10")]


def test_stream_matches_batch_and_survives_replay(warehouse, tmp_path):
    wh, inbox, checkpoint = warehouse, tmp_path / "inbox", str(tmp_path / "chk")
    inbox.mkdir()
    times = iter(dt.datetime(2024, 1, d) for d in (3, 4, 5, 6))

    def run():
        stream_landed(wh, USERS, S, str(inbox), checkpoint, clock=lambda: next(times)).awaitTermination()

    def drop(name, rows):
        (tmp_path / name).write_text(json.dumps(response(USERS, rows)), encoding="utf-8")
        os.rename(tmp_path / name, inbox / name)

    drop("a.json", [user_row("20240101", 1), user_row("20240102", 2)])
    run()
    assert users(wh) == {(1, "Brazil"): 1, (2, "Brazil"): 2}
    run()  # nothing new
    drop("b.json", [user_row("20240102", 8)])  # late data for day 2
    run()
    assert users(wh) == {(1, "Brazil"): 1, (2, "Brazil"): 8}
    assert wh.control().count() == 2

    # the commit of the last batch is lost: the batch runs again and adds nothing
    commits = sorted((tmp_path / "chk" / "commits").glob("[0-9]*"))
    os.rename(commits[-1], tmp_path / "lost-commit")
    for crc in (tmp_path / "chk" / "commits").glob(f".{commits[-1].name}.crc"):
        os.rename(crc, tmp_path / "lost-commit.crc")
    run()
    assert users(wh) == {(1, "Brazil"): 1, (2, "Brazil"): 8}
    assert wh.snapshots().count() == 3 and wh.control().count() == 2


def test_views_by_name_over_tables(warehouse, tmp_path, spark):
    load.land(warehouse, USERS, land_file(tmp_path, "a", USERS, [user_row("20240101", 4)]), dt.datetime(2024, 1, 2))
    load.refresh_silver(warehouse, USERS, S)
    dims.load_dimensions(warehouse)
    silver = Silver.of(warehouse, S)
    assert len(register_views(silver)) == 11
    assert spark.sql("SELECT sum(dau) AS n FROM vw_usuarios_ativos").first()["n"] == 4
    assert {r["visao"]: r["linhas"] for r in load.gold_counts(silver).collect()}["vw_usuarios_ativos"] == 1
    assert {(r["tabela"], r["grupo"]): r["linhas"] for r in load.dimension_counts(silver).collect()} == {
        ("dim_painel", "painel"): 19, ("dim_painel", "auxiliar"): 1, ("dim_painel_alias", ""): 26,
        ("dim_painel_relatorio", "gtm"): 33, ("dim_painel_relatorio", "inferido"): 8, ("dim_painel_relatorio", "site"): 1,
    }


def test_truncated_response_stops_the_load(spark, tmp_path):
    whole = json.dumps(response(USERS, [user_row("20240101", 3)]))
    (tmp_path / "good.json").write_text(whole)
    (tmp_path / "short.json").write_text(whole[: len(whole) // 2])
    records, _ = landed.flatten(landed.read_landed(spark, str(tmp_path)), USERS)
    with pytest.raises(Exception, match="(?i)malformed"):
        records.collect()


def test_unreadable_payload_stops_the_load(spark):
    rows = spark.createDataFrame([("a", "[]"), ("b", "[{"), ("c", None)], "snapshot_id string, payload string")
    assert bronze.explode_payload(rows.where("snapshot_id <> 'b'"), USERS).count() == 0
    with pytest.raises(Exception, match="not a readable JSON array"):
        bronze.explode_payload(rows, USERS).collect()
