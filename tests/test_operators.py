import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from visitledger.config import RobotRule, Settings
from visitledger.operators import constraints, panels, ranking, reports
from visitledger.operators.matching import dominant_label, last_label_before, reconcile, signal_ratio
from visitledger.operators.segments import flag_by_join, flag_by_window
from visitledger.schemas import Constraints

DAY = dt.date(2024, 1, 1)


# ---- segments ------------------------------------------------------------------------------------------------------

def segment_rows(spark, rows):
    """(segment, event, sessions, engaged) to feed rows."""
    return spark.createDataFrame(rows, "city string, event_name string, sessions bigint, engaged_sessions bigint").select(
        F.lit(DAY).alias("event_date"), F.lit("h").alias("hostname"), F.lit("c").alias("country"), F.lit("r").alias("region"),
        "city", *[F.lit("x").alias(c) for c in ("device_category", "browser", "operating_system")],
        "event_name", "sessions", "engaged_sessions",
    )


SEGMENTS = [
    ("blob", "session_start", 3000, 3), ("blob", "page_view", 3000, 3000),
    ("small", "session_start", 29, 1), ("small", "page_view", 1, 0),
    ("edge", "session_start", 40, 2),
    ("below", "session_start", 41, 2),
    ("nostart", "page_view", 500, 1), ("nostart", "scroll", 500, 0),
    ("idle", "page_view", 5, 0),
]
FLAGS = {"blob": False, "small": True, "edge": True, "below": False, "nostart": True, "idle": False}


@pytest.mark.parametrize("flag", [flag_by_window, flag_by_join])
def test_segment_flags(spark, flag):
    got = flag(segment_rows(spark, SEGMENTS), Settings()).collect()
    assert len(got) == len(SEGMENTS)
    assert {(r["city"], r["trafego_valido"]) for r in got} == set(FLAGS.items())


def test_join_keeps_repeated_rows_of_a_hot_segment(spark):
    rows = segment_rows(spark, SEGMENTS + [("hot", "session_start", 40, 1)] * 500 + [("hot", "page_view", 1, 1)] * 500)
    got = flag_by_join(rows, Settings())
    assert got.count() == len(SEGMENTS) + 1000
    assert [r[0] for r in got.where("city = 'hot'").select("trafego_valido").distinct().collect()] == [False]


def test_hot_segment_is_split(spark):
    """Half of the rows are one segment: AQE must cut that partition of the join into several tasks."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        ids = spark.range(0, 100_000, 1, 16)
        name = F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
        rows = ids.select(
            F.date_add(F.lit(DAY), (F.col("id") * 0).cast("int")).alias("event_date"),
            *[name.alias(c) for c in ("hostname", "country", "region", "city", "device_category", "browser", "operating_system")],
            F.when(F.col("id") % 3 == 0, F.lit("session_start")).otherwise(F.lit("page_view")).alias("event_name"),
            F.lit(40).cast("bigint").alias("sessions"), (F.col("id") % 2 * 10).alias("engaged_sessions"), "id",
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        out = flag_by_join(rows, Settings())
        collected = out.groupBy("trafego_valido").agg(F.count("*").alias("n"), F.max("payload"), F.sum("id").alias("ids"))
        got = {r["trafego_valido"]: (r["n"], r["ids"]) for r in collected.collect()}
        assert got == {False: (50_000, sum(range(0, 100_000, 2))), True: (50_000, sum(range(1, 100_000, 2)))}
        assert "skew=true" in collected._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# ---- panels --------------------------------------------------------------------------------------------------------

@pytest.fixture
def dims(spark):
    panel = spark.createDataFrame(
        [("A", 1, "t", "h", None, "painel", True), ("B", 2, "t", "h", None, "painel", False),
         ("C", 3, "t", "h", None, "auxiliar", True)],
        "painel string, ordem_menu int, tema string, hierarquia string, publico_principal string, tipo string, ativo boolean",
    )
    alias = spark.createDataFrame([("a2", "A"), ("b2", "B"), ("C", "A")], "alias string, painel string")
    return panel, alias


def test_names(spark, dims):
    rows = spark.createDataFrame([("A", 1), ("a2", 2), ("B", 3), ("b2", 4), ("C", 5), ("?", 6), ("(not set)", 7)], "nome_painel_raw string, n int")
    got = {r["nome_painel_raw"]: r["painel"] for r in panels.resolve_names(rows, *dims).collect()}
    assert got == {"A": "A", "a2": "A", "B": None, "b2": None, "C": "C", "?": None, "(not set)": None}
    assert {r["n"] for r in panels.with_panel(rows, *dims).collect()} == {1, 2}
    assert {r["n"] for r in panels.unmatched_names(rows, *dims).collect()} == {3, 4, 6, 7}


def test_lookup_join_follows_its_size(spark):
    from visitledger.operators import panels

    facts = spark.range(1000).selectExpr("CAST(id AS STRING) AS alvo")
    known = spark.range(5).selectExpr("CAST(id AS STRING) AS alvo")

    def plan():
        found = panels.unmapped_targets(facts, known)
        assert found.count() == 995
        found.collect()
        return found._jdf.queryExecution().executedPlan().toString()

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        assert "BroadcastHashJoin" in plan()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
        assert "BroadcastHashJoin" not in plan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_events_without_a_user_match_nothing(spark):
    from visitledger.operators.matching import last_label_before

    rows = spark.sql("""SELECT * FROM VALUES (1, CAST(NULL AS BIGINT), timestamp_ntz'2024-01-01 10:00:00', 'label'),
        (2, NULL, timestamp_ntz'2024-01-01 10:00:05', 'target'), (3, 7, timestamp_ntz'2024-01-01 10:00:00', 'label'),
        (4, 7, timestamp_ntz'2024-01-01 10:00:05', 'target') AS t(id, user, ts, kind)""")
    found = last_label_before(rows, "user", "ts", "id", F.col("kind") == "label", F.col("kind") == "target",
                              F.col("kind"), F.col("id"), 60).collect()
    assert [(r.user, r.id, r.label) for r in found] == [(7, 4, "label")]



def test_targets(spark, dims):
    panel, _ = dims
    report = spark.createDataFrame([("1", "A", "mobile", "gtm"), ("2", "B", "unica", "gtm")], "alvo string, painel string, versao string, fonte string")
    pages = spark.createDataFrame([("1",), ("2",), ("3",), (None,)], "alvo string")
    assert {r["alvo"]: r["mapeado"] for r in panels.mark_targets(pages, report).collect()} == {"1": True, "2": True, "3": False, None: False}
    assert {r["alvo"] for r in panels.unmapped_targets(pages, report).collect()} == {"3", None}
    assert [(r["alvo"], r["versao"]) for r in panels.with_target(pages, report, panel).collect()] == [("1", "mobile")]


# ---- reports -------------------------------------------------------------------------------------------------------

def report_events(spark):
    rows = [
        ("x", 1, 11, True, 1.0), ("x", 1, 11, False, 2.0), ("x", 1, 12, False, 4.0), ("x", 2, 21, True, 8.0),
        ("y", 2, 21, False, 16.0), ("y", None, None, True, 32.0), ("z", None, None, False, None),
    ]
    return spark.createDataFrame(rows, "host string, user_id int, session_id int, engaged boolean, engagement_s double").withColumn("event_date", F.lit(DAY))


def test_report_metrics(spark):
    names = ("eventCount", "sessions", "engagedSessions", "activeUsers", "userEngagementDuration", "engagementRate")
    got = reports.run_report(report_events(spark), reports.ReportSpec(("host",), names))
    assert {r["host"]: tuple(r[n] for n in names) for r in got.collect()} == {
        "x": (4, 3, 2, 2, 15.0, 2 / 3), "y": (2, 1, 0, 1, 48.0, 0.0), "z": (1, 0, 0, 0, None, None),
    }
    only = reports.run_report(report_events(spark), reports.ReportSpec(("host",), ("activeUsers",)))
    assert {r["host"]: r["activeUsers"] for r in only.collect()} == {"x": 2, "y": 1}
    near = reports.run_report(report_events(spark), reports.ReportSpec(("host",), names, estimate=True))
    assert {r["host"]: r["activeUsers"] for r in near.collect()} == {"x": 2, "y": 1, "z": 0}


def test_report_plan_has_no_expand(spark):
    df = reports.run_report(report_events(spark), reports.ReportSpec(("host",), ("sessions", "activeUsers")))
    assert "Expand" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_report_order_offset_limit(spark):
    spec = reports.ReportSpec(("host",), ("eventCount",), order_by=(("eventCount", True), ("host", False)), offset=1, limit=1)
    assert [r["host"] for r in reports.run_report(report_events(spark), spec).collect()] == ["y"]


# ---- matching ------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("bucket", [20, 60, 3600])
def test_last_label_before_against_pairs(spark, bucket):
    rnd = random.Random(bucket)
    start = dt.datetime(2024, 1, 1, 0, 59, 0)
    events = []
    for i in range(400):
        user = 1 if rnd.random() < 0.5 else rnd.randrange(2, 6)  # one user has half of all events
        events.append((i, user, start + dt.timedelta(seconds=rnd.randrange(600), microseconds=rnd.choice([0, 500000])),
                       rnd.choice(["click", "view", "other"]), rnd.choice("PQR"), rnd.choice("st")))
    df = spark.createDataFrame(events, "event_id int, user_id int, ts timestamp_ntz, kind string, panel string, page string")
    got = last_label_before(
        df, "user_id", "ts", "event_id", F.col("kind") == "click", F.col("kind") == "view", F.col("panel"), F.col("page"),
        seconds=20, bucket_seconds=bucket,
    )
    expected = {}
    for e in events:
        if e[3] == "view":
            seen = [c for c in events if c[3] == "click" and c[1] == e[1] and dt.timedelta(0) < e[2] - c[2] <= dt.timedelta(seconds=20)]
            if seen:
                expected[e[0]] = (max(seen, key=lambda c: (c[2], c[0]))[4], e[5])
    assert {r["event_id"]: (r["label"], r["target"]) for r in got.collect()} == expected


def test_event_that_is_label_and_target(spark):
    at = dt.datetime(2024, 1, 1, 12)
    rows = [(1, 1, at, "a"), (2, 1, at + dt.timedelta(seconds=5), "b"), (3, 1, at + dt.timedelta(seconds=5), "c"), (4, 1, at + dt.timedelta(seconds=26), "d")]
    df = spark.createDataFrame(rows, "event_id int, user_id int, ts timestamp_ntz, panel string")
    both = F.lit(True)
    got = last_label_before(df, "user_id", "ts", "event_id", both, both, F.col("panel"), F.col("panel"), 20)
    assert {r["event_id"]: r["label"] for r in got.collect()} == {2: "a", 3: "a"}


def test_bucket_must_cover_interval(spark):
    with pytest.raises(ValueError):
        last_label_before(spark.range(1), "id", "id", "id", F.lit(True), F.lit(True), F.lit(""), F.lit(""), 20, 10)


def test_dominant_label_ties_to_smaller(spark):
    df = spark.createDataFrame([("t", "b"), ("t", "a"), ("u", "c"), ("u", "c"), ("u", "a")], "target string, label string")
    got = {r["target"]: (r["label"], r["n"], r["matches"]) for r in dominant_label(df).collect()}
    assert got == {"t": ("a", 1, 2), "u": ("c", 2, 3)}


def test_reconcile(spark):
    a = spark.createDataFrame([("x", 3), ("x", 2), ("y", 1)], "k string, n bigint")
    b = spark.createDataFrame([("x", 4), ("z", 2)], "k string, n bigint")
    got = {r["k"]: tuple(r)[1:] for r in reconcile(a, b, ["k"], "n").collect()}
    assert got == {"x": (5, 4, 1, 0.25), "y": (1, 0, 1, None), "z": (0, 2, -2, -1.0)}


def test_signal_ratio(spark):
    opens = spark.createDataFrame([(1, 10), (2, 10), (3, 20)], "week int, n bigint")
    clicks = spark.createDataFrame([(1, 10), (2, 9), (3, 1), (4, 5)], "week int, n bigint")
    got = [(r["week"], r["ratio"], r["broken"]) for r in signal_ratio(opens, clicks, "week", "n").orderBy("week").collect()]
    assert got == [(1, 1.0, False), (2, 0.9, False), (3, 0.05, True), (4, 0.0, True)]


# ---- ranking, constraints ------------------------------------------------------------------------------------------

def test_bars_and_shares(spark):
    df = spark.createDataFrame([("a", 200), ("b", 5), ("c", 1)], "k string, v bigint")
    order = F.desc("v")
    got = ranking.against_top(ranking.numbered(ranking.top(df, 3, order), order), "v").orderBy("position").collect()
    assert [(r["position"], r["width_pct"]) for r in got] == [(1, 100), (2, 2), (3, 2)]
    assert {r["k"]: r["share"] for r in ranking.share_of_total(df, "v").collect()}["a"] == 200 / 206


def test_keep_top_members(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("c", 2), ("d", 1), (None, 99)], "k string, v bigint")
    got = ranking.keep_top_members(df, "k", F.sum("v"), 2).collect()
    assert sorted(r["k"] for r in got) == ["a", "a", "b"]


def test_period_change(spark):
    df = spark.createDataFrame([("s", 1, 0), ("s", 2, 4), ("s", 3, 5)], "k string, p int, v bigint")
    got = ranking.period_change(df, ["k"], "p", "v").orderBy("p").collect()
    assert [r["change"] for r in got] == [None, None, 0.25]


def test_constraints(spark):
    df = spark.createDataFrame([(1, "abc", 9), (1, None, 8), (None, "toolong", None)], "id int, t string, ref int")
    parent = spark.createDataFrame([(9,)], "id int")
    rules = Constraints(not_null=("id", "t"), unique=(("id",),), max_length=(("t", 5),), references=(("ref", "parent", "id"),))
    got = {(r["rule"], r["target"]): r["violations"] for r in constraints.check_table("x", df, rules, {"parent": parent}).collect()}
    assert got == {("not_null", "id"): 1, ("not_null", "t"): 1, ("max_length", "t"): 1, ("unique", "id"): 1, ("references", "ref->parent.id"): 1}
    assert constraints.missing_columns(df, ["id", "nope"]) == ["nope"]
    assert RobotRule().min_sessions == 30


def test_columns_are_those_of_the_file(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(3).selectExpr("id AS a", "id AS b").write.parquet(path)
    declared = spark.read.schema("a bigint, b bigint, c bigint").parquet(path)
    assert constraints.missing_columns(declared, ["a", "b", "c"]) == []
    assert constraints.missing_in_file(spark, path, ["a", "b", "c"]) == ["c"]


def test_a_million_rows_are_numbered_without_one_task(spark):
    """Half of the values tie; the numbers are dense and in order, and no task sorted more than its range."""
    n = 1_000_000
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(n).select((F.when(F.col("id") % 2 == 0, F.col("id") % 1000).otherwise(F.hash("id"))).alias("v"), "id")
        found = ranking.numbered_at_scale(df.repartition(16), F.desc("v"), F.asc("id"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    row = found.agg(F.count("*"), F.count_distinct("position"), F.min("position"), F.max("position")).first()
    assert tuple(row) == (n, n, 1, n)
    here = found.alias("a").join(found.alias("b"), F.col("a.position") + 1 == F.col("b.position"))
    wrong = (F.col("a.v") < F.col("b.v")) | (F.col("a.v") == F.col("b.v")) & (F.col("a.id") > F.col("b.id"))
    assert here.where(wrong).count() == 0
    parts = found.inputFiles()
    largest = spark.read.parquet(*parts).groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert len(parts) >= 4 and largest < n / 2
    assert ranking.numbered_at_scale(df.limit(0), F.asc("v")).count() == 0


def test_a_payload_is_parsed_once(spark):
    from visitledger.config import FEEDS
    from visitledger.sources import bronze

    df = spark.createDataFrame([("a", "[]")], "snapshot_id string, payload string")
    plan = bronze.explode_payload(df, FEEDS["usuarios"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
