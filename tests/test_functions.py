import base64
import datetime as dt
import json
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from visitledger import seeds
from visitledger.config import RobotRule, Settings
from visitledger.functions import dates, text
from visitledger.functions.traffic import site_of, valid_traffic
from visitledger.functions.url import redirect_target


def one(spark, column, **values):
    """Evaluate a column over one row of typed inputs."""
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("out")).first()["out"]


def payload(key, urlsafe=False, padding=True):
    raw = json.dumps({"k": key, "t": "x"}).encode()
    coded = (base64.urlsafe_b64encode if urlsafe else base64.b64encode)(raw).decode()
    return coded if padding else coded.rstrip("=")


ID = "0cf2dce7-1107-4ff6-bbba-d208ffd06164"
PLAIN = "https://bi.example/view?r="


@pytest.mark.parametrize("levels", [0, 1, 2])
@pytest.mark.parametrize("urlsafe", [False, True])
@pytest.mark.parametrize("key", [ID, "ÿ~?>ab", "a"])
def test_target_of_encoded_payload(spark, levels, urlsafe, key):
    inner = PLAIN + payload(key, urlsafe, padding=not urlsafe)
    for _ in range(levels):
        inner = quote(inner, safe="")
    url = "https://data.example.org/relatorios/?redirect=" + inner
    assert one(spark, redirect_target(F.col("u")), u=url) == key


@pytest.mark.parametrize("url,expected", [
    ("https://h/?redirect=tutorial.php", "tutorial.php"),
    ("https://h/?redirect=contato.php&x=1", "contato.php"),
    ("https://h/?redirect=a.php#top", "a.php"),
    ("https://h/?page=2", None),
    ("https://h/?redirect=", None),
    ("https://h/?r=%%%", None),
    ("https://h/?r=abcde", None),
    ("https://h/?redirect=x.php&r=abcde", None),
    ("https://h/?r=" + base64.b64encode(b"not json").decode(), None),
    ("https://h/?r=" + base64.b64encode(b"[1,2]").decode(), None),
    ("https://h/?r=" + base64.b64encode(b'{"q": 1}').decode(), None),
    ("https://h/?r=" + base64.b64encode(b'{"k": "\xff\xfe"}').decode(), None),
    ("https://h/?r=" + base64.b64encode(b'{"k": 7}').decode(), "7"),
    (None, None),
])
def test_target_edges(spark, url, expected):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(redirect_target(F.col("u"))).first()[0] == expected


@pytest.mark.parametrize("sessions,engaged,expected", [
    (3000, 3, False), (29, 1, True), (40, 2, True), (41, 2, False), (30, 1, False), (10, 0, False), (0, 0, False),
    (0, 1, True), (30, 30, True),
])
def test_robot_rule(spark, sessions, engaged, expected):
    rule = valid_traffic(F.col("s"), F.col("e"), RobotRule())
    df = spark.createDataFrame([(sessions, engaged)], "s bigint, e bigint")
    assert df.select(rule).first()[0] is expected


def test_robot_rule_missing_values(spark):
    df = spark.createDataFrame([(None, 1), (None, 0), (5, None)], "s bigint, e bigint")
    rule = valid_traffic(F.col("s"), F.col("e"), RobotRule())
    assert [r[0] for r in df.select(rule).collect()] == [None, False, None]


@pytest.mark.parametrize("host,site", [
    ("data.example.org", "Dados"), ("DATA.Example.ORG", "Dados"), ("www.example.org", "Institucional"),
    ("example-org.translate.test", "Institucional"), ("localhost", "Outros"), ("xdata.example.org", "Outros"),
])
def test_site_of_host(spark, host, site):
    assert one(spark, site_of(F.col("h"), Settings()), h=host) == site


def test_text_defaults_and_ratios(spark):
    df = spark.createDataFrame([("", 1, 0), (None, 1, 4), ("x", None, 4)], "t string, a int, b int")
    rows = df.select(
        text.or_not_set(F.col("t")), text.ratio(F.col("a"), F.col("b")), text.ratio_or_zero(F.col("a"), F.col("b"))
    ).collect()
    assert [tuple(r) for r in rows] == [("(not set)", None, 0.0), ("(not set)", 0.25, 0.25), ("x", None, 0.0)]


def test_names(spark):
    df = spark.createDataFrame([("State of Sao Paulo",), ("Federal District",), ("State of Bahia",), ("",), (None,)], "r string")
    assert [r[0] for r in df.select(text.state_name(F.col("r"), seeds.STATE_NAMES)).collect()] == [
        "São Paulo", "Distrito Federal", "Bahia", "Não identificado", "Não identificado"
    ]
    assert one(spark, text.lookup(F.col("c"), seeds.COUNTRY_NAMES), c="Japan") == "Japão"
    assert one(spark, text.lookup(F.col("c"), seeds.COUNTRY_NAMES), c="Norway") == "Norway"


def test_display_formats(spark):
    assert one(spark, text.show_integer(F.col("v")), v=1234567.5) == "1.234.568"
    assert one(spark, text.show_integer(F.lit(None).cast("double"))) == "0"
    assert one(spark, text.show_decimal(F.col("v")), v=3.14) == "3,1"
    assert one(spark, text.show_percent(F.col("a"), F.col("b")), a=1, b=8) == "12%"
    assert one(spark, text.show_percent(F.col("a"), F.col("b")), a=1, b=0) == "—"
    assert one(spark, text.show_duration(F.col("v")), v=125.2) == "2 min 05 s"
    assert one(spark, text.show_duration(F.col("v")), v=42.0) == "42 s"
    assert one(spark, text.show_duration(F.col("v")), v=0.0) == "—"


def test_change_wording(spark):
    df = spark.createDataFrame([(None,), (0.02,), (-0.029,), (0.004,), (0.25,), (-0.5,)], "v double")
    rows = df.select(
        text.change_phrase(F.col("v")), text.change_arrow(F.col("v")), text.headline_worthy(F.col("v"))
    ).collect()
    assert [r[1] for r in rows] == ["new", "up", "dn", "flat", "up", "dn"]
    assert [r[2] for r in rows] == [False, False, False, False, True, True]
    assert rows[0][0] == "sem semana anterior para comparar" and rows[1][0] == "estável vs. semana anterior"
    assert rows[4][0] == "cresceu 25% vs. semana anterior" and rows[5][0] == "caiu 50% vs. semana anterior"


def test_headline(spark):
    df = spark.createDataFrame([(0.2, -0.1), (0.2, 0.01), (None, None)], "a double, b double")
    said = [r[0] for r in df.select(text.headline("Dados", F.col("a"), "Institucional", F.col("b"))).collect()]
    assert said[0] == "Esta semana, o Dados ganhou 20% de usuários e o Institucional perdeu 10% de usuários frente à semana anterior."
    assert said[1] == "Esta semana, o Dados ganhou 20% de usuários frente à semana anterior."
    assert said[2].startswith("Semana estável")


def test_dates(spark):
    day = dt.date(2024, 2, 29)
    assert one(spark, dates.week_start(F.col("d")), d=day) == dt.date(2024, 2, 26)
    assert one(spark, dates.last_closed_sunday(F.col("d")), d=day) == dt.date(2024, 2, 25)
    assert one(spark, dates.last_closed_sunday(F.col("d")), d=dt.date(2024, 2, 25)) == dt.date(2024, 2, 18)
    assert one(spark, dates.next_month_start(F.col("d")), d=day) == dt.date(2024, 3, 1)
    assert one(spark, dates.day_name(F.col("d")), d=day) == "quinta-feira"
    assert one(spark, dates.month_short(F.col("d")), d=day) == "fev"
    assert one(spark, dates.from_compact(F.col("d")), d="20240229") == day
    with pytest.raises(Exception):
        one(spark, dates.from_compact(F.col("d")), d="2024-02-30")


def test_plain_dates():
    today = dt.date(2024, 1, 31)
    assert dates.relative_day("today", today) == today
    assert dates.relative_day("yesterday", today) == dt.date(2024, 1, 30)
    assert dates.relative_day("28daysAgo", today) == dt.date(2024, 1, 3)
    assert dates.relative_day("2023-05-06", today) == dt.date(2023, 5, 6)
    assert dates.reference_week(today) == (dt.date(2024, 1, 22), dt.date(2024, 1, 28))
    assert dates.reference_week(dt.date(2024, 1, 28)) == (dt.date(2024, 1, 15), dt.date(2024, 1, 21))
    assert dates.reference_week(today, dt.date(2024, 1, 14)) == (dt.date(2024, 1, 8), dt.date(2024, 1, 14))


def test_micros_needs_no_time_zone(spark):
    at = dt.datetime(2024, 3, 10, 2, 30, 0, 123456)
    df = spark.createDataFrame([(at,)], "t timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = df.select(dates.micros(F.col("t"))).first()[0]
            assert got == (at - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_decimals_round_the_binary_value(spark):
    from visitledger.functions.text import show_decimal

    values = [0.35, 0.15, 0.45, 1.15, 0.25, 0.75, -0.35, 1e6 + 0.05, *[n / 20 for n in range(400)], *[n / 7 for n in range(90)]]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    for places in (0, 1, 2):
        for r in rows.select("v", show_decimal(rows.v, places).alias("shown")).collect():
            assert r.shown == f"{r.v:.{places}f}".replace(".", ",")
