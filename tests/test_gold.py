"""Views, measures, weekly figures and quality checks on small hand-made tables."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from visitledger.config import Settings
from visitledger.plans import gold, quality, star, weekly
from visitledger.plans.measures import LABELS, MEASURES
from visitledger.schemas import DIMENSIONS, SILVER

SUN = dt.date(2024, 1, 28)
MON = dt.date(2024, 1, 22)
HOSTS = {"Dados": "data.example.org", "Institucional": "example.org", "Outros": "localhost"}


def event(day, event_name, n=1, sessions=1, engaged=1, users=1, seconds="0", valid=True, site="Institucional", country="Brazil",
          region="State of Bahia", device="desktop"):
    return (day, HOSTS[site], site, country, region, "x", device, "Chrome", "Linux", event_name, n, sessions, engaged, users,
            Decimal(seconds), valid, dt.datetime(2024, 1, 29, 15))


def click(day, raw, n=1, sessions=2, engaged=1, seconds="9", event_name="painel_acessado", site="Dados", device="desktop"):
    return (day, HOSTS[site], site, "Brazil", "r", "c", device, event_name, raw, n, sessions, engaged, 1, Decimal(seconds), None)


def user(day, dau, wau, mau, sessions, engaged, site="Dados", country="Brazil", device="desktop", seconds="10"):
    return (day, HOSTS[site], site, country, device, dau, wau, mau, sessions, engaged, Decimal(seconds), dt.datetime(2024, 1, 29, 15))


def page(day, target, views=1, users=1, users7=1, users28=1, site="Dados"):
    return (day, HOSTS[site], site, f"https://x/?redirect={target}", target, views, users, users7, users28, None)


PANELS = [("A", 1, "t1", "h", None, "painel", True), ("B", 2, "t2", "h", None, "painel", True), ("Z", 3, "t1", "h", None, "painel", False),
          ("T", None, "nav", "nav", None, "auxiliar", True)]
ALIASES = [("a", "A"), ("z", "Z")]
REPORTS = [("1", "A", "desktop", "gtm"), ("2", "A", "mobile", "gtm"), ("3", "B", "unica", "gtm"), ("9", "Z", "unica", "gtm"), ("tutorial.php", "T", "unica", "site")]


@pytest.fixture
def make(spark):
    def build(eventos=(), paineis=(), usuarios=(), paginas=(), settings=Settings()):
        facts = dict(ga4_eventos=eventos, ga4_paineis=paineis, ga4_usuarios=usuarios, ga4_paginas=paginas)
        dims = dict(dim_painel=PANELS, dim_painel_alias=ALIASES, dim_painel_relatorio=REPORTS)
        return gold.Silver(
            **{k: spark.createDataFrame(list(v), SILVER[k]) for k, v in facts.items()},
            **{k: spark.createDataFrame(v, DIMENSIONS[k]) for k, v in dims.items()}, settings=settings,
        )
    return build


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_each_metric_from_its_own_event(make):
    s = make([event(MON, "session_start", 10, 9, 5, 7, "1.5"), event(MON, "user_engagement", 30, 9, 5, 7, "60.25"),
              event(MON, "page_view", 50, 9, 5, 7, "0.5"), event(MON, "page_view", 5, site="Outros")])
    got = gold.vw_sessoes(s).first()
    assert (got["sessions"], got["engaged_sessions"], got["active_users"], float(got["user_engagement_seconds"])) == (9, 5, 7, 60.25)
    assert gold.vw_sessoes(s).count() == 1


def test_missing_session_start_gives_null_but_zero_seconds(make):
    got = gold.vw_sessoes(make([event(MON, "page_view")])).first()
    assert got["sessions"] is None and float(got["user_engagement_seconds"]) == 0
    got = gold.vw_site_overview(make([event(MON, "page_view")])).first()
    assert got["sessoes"] is None and got["usuarios"] is None and float(got["tempo_engajamento_s"]) == 0


def test_valid_plus_discarded_is_all(make):
    s = make([event(MON, "session_start", sessions=4, valid=True), event(MON, "session_start", sessions=6, valid=False),
              event(MON, "session_start", sessions=5, valid=False, country="China")])
    assert rows(gold.vw_qualidade_trafego(s), "country", "sessoes_validas", "sessoes_descartadas")[0] == ("Brazil", 4, 6)
    got = {r["country"]: (r["sessoes_validas"], r["sessoes_descartadas"]) for r in gold.vw_qualidade_trafego(s).collect()}
    assert got["China"] == (None, 5)
    assert gold.vw_site_overview(s).agg(F.sum("sessoes")).first()[0] == 4


def test_home_site_events(make):
    s = make([event(MON, "page_view", 3, users=2), event(MON, "page_view", 4, users=1, region="State of Acre"), event(MON, "page_view", 9, site="Dados"),
              event(MON, "page_view", 9, valid=False)])
    assert rows(gold.vw_institucional_eventos(s), "region", "eventos", "usuarios") == [("State of Acre", 4, 1), ("State of Bahia", 3, 2)]


def test_panel_events_all_accounted_for(make):
    raws = ["A", "a", "B", "Z", "z", "?", "(not set)", "T"]
    s = make(paineis=[click(MON, r, n=2 ** i) for i, r in enumerate(raws)] + [click(MON, "?", n=1000, site="Institucional")])
    ranked = gold.vw_paineis_ranking(s).agg(F.sum("acessos")).first()[0]
    unmapped = {r["nome_painel_raw"]: r["eventos"] for r in gold.vw_paineis_sem_mapeamento(s).collect()}
    assert ranked == 1 + 2 + 4 and unmapped == {"Z": 8, "z": 16, "?": 32}
    assert ranked + sum(unmapped.values()) + 64 + 128 == 2 ** len(raws) - 1  # plus not set and auxiliary
    first = gold.vw_paineis_ranking(s).where("painel = 'A'").first()
    assert (first["sessoes"], str(first["tempo_medio_seg"])) == (4, "4.5")


def test_mean_time_rounds_half_up_and_survives_no_sessions(make):
    s = make(paineis=[click(MON, "A", sessions=20, seconds="1.00"), click(MON, "B", sessions=0, seconds="5")])
    assert rows(gold.vw_paineis_ranking(s), "painel") == [("A",), ("B",)]
    assert {r["painel"]: r["tempo_medio_seg"] for r in gold.vw_paineis_ranking(s).collect()} == {"A": Decimal("0.1"), "B": None}


def test_panel_opens_and_unmapped(make):
    s = make(paginas=[page(MON, "1", 3, 2, 5, 8), page(MON, "1", 1, 1, 1, 1), page(MON, "2", 7, 6, 6, 6), page(MON, "9"), page(MON, "404", 4),
                      page(SUN, "404", 2), page(MON, None, 11), page(MON, "contato.php"), page(MON, "tutorial.php"), page(MON, "404", site="Institucional")])
    assert rows(gold.vw_paineis_acessos(s), "painel", "versao", "aberturas", "acessos", "pessoas_7d", "pessoas_28d") == [
        ("A", "desktop", 4, 3, 6, 9), ("A", "mobile", 7, 6, 6, 6), ("T", "unica", 1, 1, 1, 1)]
    got = {r["alvo"]: (r["primeira_data"], r["ultima_data"], r["aberturas"]) for r in gold.vw_paineis_url_sem_mapa(s).collect()}
    assert got == {"404": (MON, SUN, 6), None: (MON, MON, 11)}
    states = {r["estado"]: r["page_views"] for r in quality.map_coverage(s).collect()}
    assert states == {"mapped": 13, "unmapped": 7, "unreadable": 11}


def test_each_window_is_judged_by_its_own_sessions(make):
    day = [MON + dt.timedelta(days=i) for i in range(7)]
    s = make(usuarios=[user(day[0], 5, 5, 5, 100, 50), user(day[6], 7, 9, 11, 29, 0), user(SUN, 4, 6, 8, 0, 0, country="Chile")])
    got = {(r["event_date"], r["country"]): r for r in gold.vw_usuarios_ativos(s).collect()}
    last = got[(day[6], "Brazil")]
    # nobody engaged on the day itself, but the week is healthy: 50 engaged of 129
    assert last["dau"] is None and (last["wau"], last["mau"]) == (9, 11)
    assert (last["sessoes_7d"], last["sessoes_engajadas_7d"], float(last["tempo_engajamento_7d_s"])) == (129, 50, 20.0)
    assert got[(SUN, "Chile")]["wau"] is None  # no engagement in any window


def test_range_read_equals_whole_read(make):
    days = [dt.date(2023, 12, 20) + dt.timedelta(days=i) for i in range(0, 40, 3)]
    s = make(usuarios=[user(d, 1, 2, 3, 10 + i, i % 3) for i, d in enumerate(days)])
    cols = gold.vw_usuarios_ativos(s).columns
    whole = rows(gold.vw_usuarios_ativos(s).where(F.col("event_date") >= F.lit(dt.date(2024, 1, 15))).fillna(-1), *cols)
    part = rows(gold.vw_usuarios_ativos(s, dt.date(2024, 1, 15), None).fillna(-1), *cols)
    assert whole == part and whole


# ---- measures ------------------------------------------------------------------------------------------------------

def test_all_published_measures_exist():
    assert len(LABELS) == 32 and set(LABELS) <= set(MEASURES)


def test_ratio_of_totals_not_total_of_ratios(make):
    s = make(paineis=[click(MON, "A", sessions=10, engaged=1), click(MON, "B", sessions=2, engaged=2)])
    got = star.query(s, ["taxa_engajamento", "total_acessos"], ["painel"], totals=True).collect()
    assert {(r["level"], r["painel"]): r["taxa_engajamento"] for r in got} == {(0, "A"): 0.1, (0, "B"): 1.0, (1, None): 0.25}


def test_measures_of_several_views_meet(make):
    s = make([event(MON, "session_start", sessions=4, valid=True), event(MON, "session_start", sessions=6, valid=False, site="Dados")])
    got = {r["site"]: tuple(r)[1:] for r in star.query(s, ["total_sessoes", "sessoes_validas", "total_sessoes_bruto", "pct_bots"], ["site"]).collect()}
    assert got == {"Institucional": (4, 4, 4, 0.0), "Dados": (None, None, 6, 1.0)}


def test_unrelated_grouping_is_refused(make):
    with pytest.raises(ValueError, match="cannot be grouped"):
        star.query(make(), ["total_acessos"], ["device_category"])


def test_region_lookup_keeps_blank_member(make, spark):
    from visitledger.sources.dims import region_frame

    s = make([event(MON, "session_start", sessions=4), event(MON, "session_start", sessions=2, region="State of São Paulo")])
    got = star.by_category(s, "sessoes_validas", "estado", regions=region_frame(spark)).collect()
    assert [(r["estado"], r["sessoes_validas"]) for r in got] == [("Bahia", 4), (None, 2)]


def test_filters(make):
    s = make([event(MON, "session_start", sessions=1), event(SUN, "session_start", sessions=2, country="China"),
              event(SUN, "session_start", sessions=4, device="mobile")])
    q = lambda *where: star.query(s, ["sessoes_validas"], where=where).first()[0]
    assert q(star.exclude("country", "China")) == 5 and q(star.from_day(SUN)) == 6
    assert q(star.from_day(MON, MON)) == 1 and q(star.members("device_category", "mobile", "tablet")) == 4


def test_calendar_covers_whole_years(spark):
    span = spark.createDataFrame([(dt.date(2023, 5, 5), dt.date(2026, 1, 1))], "first_day date, last_day date")
    cal = star.calendar(span)
    assert cal.count() == 1461
    row = cal.where("event_date = '2024-02-29'").first()
    assert tuple(row)[1:] == (2024, 2, "fev", "fev/2024", "T1", 5, "quinta-feira")


# ---- weekly --------------------------------------------------------------------------------------------------------

def test_weekly_kpis(make):
    before = [MON - dt.timedelta(days=7), SUN - dt.timedelta(days=7)]
    s = make(usuarios=[
        user(MON, 10, 30, 60, 20, 10), user(SUN, 4, 35, 70, 8, 4), user(before[0], 9, 9, 9, 5, 5), user(before[1], 1, 28, 50, 9, 9),
        user(MON, 3, 3, 3, 6, 6, site="Institucional"),
    ])
    got = {(r["site"], r["week_end"]): r for r in weekly.site_kpis(s, SUN).collect()}
    now = got[("Dados", SUN)]
    assert (now["wau"], now["mau"], now["sessoes"], now["engajadas"]) == (35, 70, 28, 14)
    assert (now["sessoes_dia"], now["dau_medio"], now["tempo_sessao"]) == (4.0, 2.0, 20 / 28)
    assert (now["visitas_usuario"], now["engajadas_pct"], now["frequencia"]) == (28 / 35, 0.5, 2 / 35)
    assert got[("Institucional", SUN)]["wau"] == 0  # nothing on the Sunday itself
    change = {r["site"]: r for r in weekly.site_change(weekly.site_kpis(s, SUN), SUN).collect()}
    assert (change["Dados"]["wau_change"], change["Dados"]["phrase"]) == (0.25, "cresceu 25% vs. semana anterior")
    assert change["Institucional"]["wau_change"] is None and change["Institucional"]["arrow"] == "new"
    days = [r["dau"] for r in weekly.daily_users(s, "Dados", SUN).orderBy("event_date").collect()]
    assert days == [10, 0, 0, 0, 0, 0, 4]


def test_weekly_lists(make):
    s = make(
        [event(MON, "session_start", sessions=5), event(MON, "session_start", sessions=5, region="Federal District"),
         event(MON, "session_start", sessions=9, region="(not set)"), event(MON, "session_start", sessions=9, country="Chile", region="x")],
        usuarios=[user(SUN, 1, 5, 9, 4, 2), user(SUN, 1, 5, 9, 4, 2, country="Japan"), user(SUN, 1, 8, 9, 4, 2, country="Chile", device="mobile"),
                  user(SUN, 1, 50, 9, 4, 0, country="China")],
        paginas=[page(MON, "1", users=6, users7=6), page(SUN, "1", users=2, users7=7), page(SUN, "3", users=8, users7=9), page(SUN, "tutorial.php", users=99)],
    )
    assert [tuple(r) for r in weekly.top_countries(s, SUN).collect()] == [("Chile", 8), ("Brasil", 5), ("Japão", 5)]
    assert [tuple(r) for r in weekly.top_states(s, SUN).collect()] == [("Distrito Federal", 5), ("Bahia", 5)]
    assert [tuple(r) for r in weekly.devices(s, SUN).collect()] == [("Computador", 10, 10 / 18), ("Celular", 8, 8 / 18)]
    assert [tuple(r) for r in weekly.top_panels(s, SUN).collect()] == [("B", "t2", 8, 9), ("A", "t1", 8, 7)]
    # both themes have 8: the theme of the better-placed panel wins
    assert tuple(weekly.top_theme(s, SUN).first()) == ("t2", 8, 0.5)
    kinds = {r["section"] for r in weekly.weekly_dataset(s, SUN).collect()}
    assert kinds == {"site", "day", "country", "state", "device", "panel", "theme"}


def test_completeness(make):
    ok = make([event(SUN, "page_view")], usuarios=[user(SUN, 1, 1, 1, 1, 1)])
    assert quality.week_completeness(ok, SUN).collect() == []
    early = make([event(SUN, "page_view")], usuarios=[user(SUN, 1, 1, 1, 1, 1)], settings=Settings(day_closes_at_hour=16))
    assert {r["problem"] for r in quality.week_completeness(early, SUN).collect()} == {"extracted_early"}
    empty = quality.week_completeness(make(), SUN).collect()
    assert [(r["tabela"], r["problem"], r["last_day"]) for r in empty] == [("ga4_eventos", "missing_days", None), ("ga4_usuarios", "missing_days", None)]


def test_version_label(spark):
    df = spark.createDataFrame([("a", "mobile", 8), ("a", "desktop", 2), ("b", "mobile", 7), ("b", "desktop", 3)], "alvo string, device string, n bigint")
    assert {r["alvo"]: r["versao"] for r in quality.version_by_device(df, "alvo", "device", "n").collect()} == {"a": "mobile", "b": "unica"}


def test_freshness(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 30, 22, 15, 9),)], "ts timestamp_ntz")
    got = quality.freshness(df, dt.datetime(2024, 1, 31, 10)).first()
    assert (got["lag_hours"], got["yesterday_closed"], got["hours_missing"]) == (11.75, False, 1.75)
    later = spark.createDataFrame([(dt.datetime(2024, 1, 31, 0, 0, 9),)], "ts timestamp_ntz")
    got = quality.freshness(later, dt.datetime(2024, 1, 31, 10)).first()
    assert got["yesterday_closed"] and got["hours_missing"] is None
