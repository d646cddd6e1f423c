"""Landing, snapshots, day replacement, load windows and dimension upserts over the given tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import seeds
from ..config import FEEDS
from ..plans import load
from ..session import shared_dir
from ..sources import bronze, dims, landed
from ..sources.silver import split_bad, typed_rows
from ..sources.tables import Warehouse
from . import dataset as d
from .oracle import CTES, SITE, big, money
from .registry import registered

SITE_FEED = FEEDS["site"]
TODAY = dt.date(2024, 1, 31)


def _text(col) -> Column:
    return col.cast("string")


def _value(col) -> Column:
    return F.struct(col.alias("value"))


def _header(*names: str) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("name")) for n in names])


def _responses(spark, sf_dir) -> DataFrame:
    """One response per event. Some rows are one cell short, some have a cell too many, some lack the date."""
    e = d.raw_events(spark, sf_dir)
    day = F.when(F.col("event_id") % 13 == 0, F.lit("")).otherwise(F.date_format("event_date", "yyyyMMdd"))
    metrics = F.array(
        _value(F.lit("1")), _value(_text(F.col("engaged").cast("int"))), _value(_text(F.col("engagement_s"))),
        _value(F.lit("surplus")),
    )
    cells = F.when(F.col("event_id") % 7 == 0, 2).when(F.col("event_id") % 7 == 1, 4).otherwise(3)
    row = F.struct(
        F.array(_value(day), _value(F.col("hostname")), _value(F.col("device_category")), _value(F.col("event_name")))
        .alias("dimensionValues"),
        F.slice(metrics, F.lit(1), cells).alias("metricValues"),
    )
    return e.select(
        _header("date", "hostName", "deviceCategory", "eventName").alias("dimensionHeaders"),
        _header("eventCount", "engagedSessions", "userEngagementDuration").alias("metricHeaders"),
        F.array(row).alias("rows"),
        F.struct(F.lit("America/Sao_Paulo").alias("timeZone"),
                 F.when(F.col("event_type") == "error", F.lit("202401100000")).alias("dataLossFromGapsTimestamp"))
        .alias("metadata"),
    )


@registered("landed_records", f"""SELECT strftime(event_date, '%Y%m%d') AS "date", hostname AS "hostName", event_name AS "eventName",
      count(*) AS n, count(*) FILTER (WHERE event_id % 7 <> 0) AS with_seconds,
      {money('CAST(COALESCE(sum(cents) FILTER (WHERE event_id % 7 <> 0), 0) AS BIGINT)', 'seconds')}, CAST(0 AS BIGINT) AS with_country
    FROM raw_events WHERE event_id % 13 <> 0 GROUP BY ALL""")
def landed_records(spark, sf_dir):
    records, _ = landed.flatten(_responses(spark, sf_dir), SITE_FEED)
    return records.groupBy("date", "hostName", "eventName").agg(
        F.count("*").alias("n"),
        F.count("userEngagementDuration").alias("with_seconds"),
        F.coalesce(F.sum(F.col("userEngagementDuration").cast("decimal(14,2)")), F.lit(0)).alias("seconds"),
        F.count("country").alias("with_country"),
    )


@registered("landed_rejected", """SELECT "hostName", count(*) AS n FROM (SELECT hostname AS "hostName" FROM raw_events WHERE event_id % 13 = 0) GROUP BY ALL""")
def landed_rejected(spark, sf_dir):
    _, rejected = landed.flatten(_responses(spark, sf_dir), SITE_FEED)
    return rejected.groupBy("hostName").agg(F.count("*").alias("n"))


@registered("collection_gaps", """SELECT DISTINCT 'America/Sao_Paulo' AS time_zone, CASE WHEN event_type = 'error' THEN '202401100000' END AS data_loss_from FROM events""")
def collection_gaps(spark, sf_dir):
    return landed.collection_gaps(_responses(spark, sf_dir))


def _payload(spark, sf_dir) -> DataFrame:
    """Snapshots as JSON arrays: an event becomes an array of one record, or of two with the second not engaged."""
    e = d.raw_events(spark, sf_dir)

    def record(engaged, seconds):
        return F.struct(
            F.date_format("event_date", "yyyyMMdd").alias("date"), F.col("hostname").alias("hostName"),
            F.when(F.col("user_id") % 3 > 0, F.expr("CASE user_id % 3 WHEN 1 THEN 'Brazil' ELSE '' END")).alias("country"),
            F.col("device_category").alias("deviceCategory"), F.col("event_name").alias("eventName"),
            F.when(F.col("event_id") % 30 > 0, F.expr("concat('Brand#', CAST(event_id % 30 AS STRING))"))
            .otherwise(F.lit("")).alias("customEvent:nome_painel"),
            F.lit("1").alias("eventCount"), F.lit("1").alias("sessions"), engaged.alias("engagedSessions"),
            F.lit("1").alias("activeUsers"), seconds.alias("userEngagementDuration"),
        )

    first = record(_text(F.col("engaged").cast("int")), _text(F.col("engagement_s")))
    second = record(F.lit("0"), F.lit("0.005"))
    items = F.when(F.col("event_id") % 4 == 0, F.array(first, second)).otherwise(F.array(first))
    return e.select(
        F.to_json(items).alias("payload"), (F.col("event_date").cast("timestamp_ntz")).alias("data_extracao")
    )


@registered("payload_rows", f"""SELECT event_date, hostname, {SITE} AS site, CASE user_id % 3 WHEN 1 THEN 'Brazil' ELSE '(not set)' END AS country,
      nome_painel_raw, device_category, {big("sum(1 + CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END)")} AS event_count,
      count(*) FILTER (WHERE engaged) AS engaged_sessions,
      {money('CAST(sum(cents + CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END) AS BIGINT)', 'user_engagement_seconds')}
    FROM raw_events GROUP BY ALL""")
def payload_rows(spark, sf_dir):
    """JSON arrays exploded and typed: missing and blank members, and a value that rounds to a cent."""
    records = bronze.explode_payload(_payload(spark, sf_dir), FEEDS["painel"])
    rows = typed_rows(records, FEEDS["painel"], d.SETTINGS)
    return rows.groupBy("event_date", "hostname", "site", "country", "nome_painel_raw", "device_category").agg(
        *[F.sum(c).alias(c) for c in ("event_count", "engaged_sessions", "user_engagement_seconds")]
    )


@registered("quarantine_rows", """SELECT bad, count(*) AS n FROM (SELECT event_id % 17 = 0 OR event_id % 19 = 0 AS bad FROM events) GROUP BY ALL""")
def quarantine_rows(spark, sf_dir):
    """Rows with an unreadable number or date are set aside instead of stopping the load."""
    e = d.raw_events(spark, sf_dir)
    day = F.when(F.col("event_id") % 17 == 0, F.lit("20241399")).otherwise(F.date_format("event_date", "yyyyMMdd"))
    count = F.when(F.col("event_id") % 19 == 0, F.lit("many")).otherwise(F.lit("1"))
    records = e.select(
        *[{"date": day, "eventCount": count}.get(f, F.lit(None).cast("string")).alias(f) for f in SITE_FEED.fields]
    )
    good, bad = split_bad(records, SITE_FEED)
    return good.select(F.lit(False).alias("bad")).unionByName(bad.select(F.lit(True).alias("bad"))).groupBy("bad").agg(
        F.count("*").alias("n")
    )


# ---- snapshots -----------------------------------------------------------------------------------------------------

_LOG_SQL = """SELECT CAST(ts AS DATE) AS event_date, event_type AS snapshot_id, count(*) AS linhas,
    date_trunc('hour', max(ts)) AS data_extracao FROM events GROUP BY ALL"""


def _snapshot_log(spark, sf_dir) -> DataFrame:
    """Each event type of a day as one snapshot; hour-precise extraction times make real ties."""
    return d.raw_events(spark, sf_dir).groupBy("event_date", F.col("event_type").alias("snapshot_id")).agg(
        F.count("*").alias("linhas"),
        F.date_trunc("hour", F.max("ts")).cast("timestamp_ntz").alias("data_extracao"),
    )


@registered("latest_snapshot", f"""SELECT event_date, snapshot_id, data_extracao FROM (SELECT *, row_number() OVER (PARTITION BY event_date
    ORDER BY data_extracao DESC, snapshot_id DESC) AS rn FROM ({_LOG_SQL})) WHERE rn = 1""")
def latest_snapshot(spark, sf_dir):
    return bronze.newest_snapshots(_snapshot_log(spark, sf_dir)).drop("linhas")


@registered("latest_snapshot_rows", f"""WITH l AS (SELECT event_date, snapshot_id FROM (SELECT *, row_number() OVER (PARTITION BY event_date
      ORDER BY data_extracao DESC, snapshot_id DESC) AS rn FROM ({_LOG_SQL})) WHERE rn = 1)
    SELECT event_id, user_id, CAST(ts AS DATE) AS event_date, event_type AS snapshot_id FROM events
    JOIN l ON l.event_date = CAST(ts AS DATE) AND l.snapshot_id = event_type""")
def latest_snapshot_rows(spark, sf_dir):
    rows = d.raw_events(spark, sf_dir).withColumnRenamed("event_type", "snapshot_id")
    newest = bronze.newest_snapshots(_snapshot_log(spark, sf_dir))
    return bronze.newest_rows(rows, newest).select("event_id", "user_id", "event_date", "snapshot_id")


@registered("pending_days", f"""WITH l AS (SELECT event_date, arg_max(snapshot_id, (data_extracao, snapshot_id)) AS snapshot_id, max(data_extracao) AS data_extracao
      FROM ({_LOG_SQL}) GROUP BY event_date),
      s AS (SELECT CAST(ts AS DATE) AS event_date, max(CAST(CAST(ts AS DATE) AS TIMESTAMP) + CASE day(ts) % 3 WHEN 1 THEN INTERVAL 6 HOURS WHEN 2 THEN INTERVAL 30 HOURS END) AS held
            FROM events GROUP BY ALL)
    SELECT l.event_date, snapshot_id, data_extracao FROM l LEFT JOIN s USING (event_date) WHERE held IS NULL OR data_extracao > held""")
def pending_days(spark, sf_dir):
    """A third of the days holds no time of loading, a third was loaded too early, a third is up to date."""
    held = F.col("event_date").cast("timestamp_ntz") + F.expr(
        "CASE day(event_date) % 3 WHEN 1 THEN INTERVAL '6' HOUR WHEN 2 THEN INTERVAL '30' HOUR END"
    )
    silver_days = d.raw_events(spark, sf_dir).select("event_date", held.alias("data_extracao"))
    return bronze.pending_days(_snapshot_log(spark, sf_dir), silver_days).drop("linhas")


def _as_delivered(facts: DataFrame) -> DataFrame:
    """Site-feed rows back to delivered text: compact dates, blanks for not-set members."""
    out = []
    for source, (name, kind) in SITE_FEED.fields.items():
        col = F.col(name)
        if kind == "date":
            col = F.date_format(col, "yyyyMMdd")
        elif kind == "dim":
            col = F.when(col != "(not set)", col).otherwise(F.lit(""))
        out.append(col.cast("string").alias(source))
    return facts.select(*out)


def _facts(spark, sf_dir, events: DataFrame) -> DataFrame:
    reduced = events.groupBy(
        "event_date", "user_id", "hostname", "device_category", "browser", "operating_system", "event_name"
    ).agg(
        F.count("*").alias("sessions"), F.count_if("engaged").alias("engaged_sessions"),
        F.sum("engagement_s").alias("user_engagement_seconds"),
    ).join(d.geography(spark, sf_dir), "user_id")
    return d._feed(reduced, [*d.FEED_GRAIN, "browser", "operating_system", "event_name"])


_KEPT = """kept AS (SELECT * REPLACE (engaged AND (event_id % 10 <> 0 OR event_date >= DATE '2024-01-28') AS engaged) FROM hits)"""
_REPLACED = ", ".join(
    f"{new} AS ({CTES[old].replace('hits', 'kept').replace('facts', 'day_facts').replace('flags', 'day_flags')})"
    for old, new in (("facts", "day_facts"), ("flags", "day_flags"), ("eventos", "day_events"))
)


@registered("day_replace", f"""WITH {_KEPT}, {_REPLACED} SELECT event_date, hostname, site, country, region, city, device_category, browser,
      operating_system, event_name, event_count, sessions, engaged_sessions, active_users, {money('cents', 'user_engagement_seconds')},
      trafego_valido, CASE WHEN event_date >= DATE '2024-01-28' THEN TIMESTAMP '2024-01-31 18:00:00' ELSE TIMESTAMP '2024-01-31 06:00:00' END AS data_extracao
    FROM day_events""")
def day_replace(spark, sf_dir):
    """Load, load again with late data for the last days, and once more without news, through real tables.

    The first extraction does not know yet that a tenth of the events was engaged; the second brings the last three days
    anew. Silver must hold the new rows of those days, the old rows of all others, and must not change on the third run.
    """
    wh = Warehouse(spark, shared_dir(spark, "day_replace"))
    wh.create_all()
    events = d.raw_events(spark, sf_dir)
    unsettled = events.withColumn("engaged", F.col("engaged") & (F.col("event_id") % 10 != 0))
    early = _as_delivered(_facts(spark, sf_dir, unsettled))
    late = _as_delivered(_facts(spark, sf_dir, events.where("event_date >= DATE '2024-01-28'")))
    bronze.append_snapshot(wh, SITE_FEED, early, dt.datetime(2024, 1, 31, 6))
    load.refresh_silver(wh, SITE_FEED, d.SETTINGS)
    bronze.append_snapshot(wh, SITE_FEED, late, dt.datetime(2024, 1, 31, 18))
    load.refresh_silver(wh, SITE_FEED, d.SETTINGS)
    if load.refresh_silver(wh, SITE_FEED, d.SETTINGS):
        raise AssertionError("a run without new snapshots replaced days")
    return wh.silver(SITE_FEED.table)


# ---- windows, logs, dimensions -------------------------------------------------------------------------------------

@registered("month_ranges", """WITH s AS (SELECT o_orderpriority, CAST(min(o_orderdate) AS DATE) AS "start", CAST(max(o_orderdate) AS DATE) AS "end" FROM orders GROUP BY ALL),
      m AS (SELECT *, CAST(unnest(generate_series(date_trunc('month', "start"), CAST("end" AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS m FROM s)
    SELECT o_orderpriority, "start", "end", greatest("start", m) AS range_start, least("end", CAST(last_day(m) AS DATE)) AS range_end FROM m""")
def month_ranges(spark, sf_dir):
    spans = d.table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(
        F.min(F.to_date("o_orderdate")).alias("start"), F.max(F.to_date("o_orderdate")).alias("end")
    )
    return bronze.month_ranges(spans)


def _control(spark, sf_dir) -> DataFrame:
    """A control log in which each event type is a report that last loaded on a different day."""
    days = d.raw_events(spark, sf_dir).where("event_type <> 'error'").groupBy("event_type", "event_date").agg(
        F.count("*").alias("qtd_linhas")
    )
    stopped = F.expr("CASE event_type WHEN 'click' THEN DATE '2024-01-20' ELSE DATE '2024-01-30' END")
    return days.where(F.col("event_date") <= stopped).select(
        F.col("event_type").alias("relatorio"), F.col("event_date").alias("data_fim_janela"), "qtd_linhas"
    )


_CONTROL_SQL = """SELECT event_type AS relatorio, CAST(ts AS DATE) AS data_fim_janela FROM events WHERE event_type <> 'error'
    AND CAST(ts AS DATE) <= CASE event_type WHEN 'click' THEN DATE '2024-01-20' ELSE DATE '2024-01-30' END"""


@registered("last_window_end", f"SELECT relatorio, max(data_fim_janela) AS last_end FROM ({_CONTROL_SQL}) GROUP BY ALL")
def last_window_end(spark, sf_dir):
    return bronze.last_window_end(_control(spark, sf_dir))


@registered("load_window", f"""SELECT relatorio, CASE WHEN last_end IS NULL THEN greatest(floor, DATE '2024-01-28') ELSE least(DATE '2024-01-28', last_end - 3) END AS window_start,
      DATE '2024-01-30' AS window_end
    FROM (SELECT event_type AS relatorio, min(CAST(ts AS DATE)) AS floor FROM events GROUP BY ALL)
    LEFT JOIN (SELECT relatorio, max(data_fim_janela) AS last_end FROM ({_CONTROL_SQL}) GROUP BY ALL) USING (relatorio)""")
def load_window(spark, sf_dir):
    """Usual window, a window widened by an outage, and a first run."""
    floors = d.raw_events(spark, sf_dir).groupBy(F.col("event_type").alias("relatorio")).agg(
        F.min("event_date").alias("floor")
    )
    return bronze.load_window(_control(spark, sf_dir), floors, TODAY, d.SETTINGS)


@registered("days_to_load", f"""WITH w AS (SELECT CAST(unnest(generate_series(DATE '2024-01-17', DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS event_date)
    SELECT event_date, count(event_id) AS rows_to_load FROM w JOIN events ON CAST(ts AS DATE) = event_date AND event_type = 'click' GROUP BY ALL""")
def days_to_load(spark, sf_dir):
    """The widened window expanded to days, and the landed rows it selects."""
    floors = d.raw_events(spark, sf_dir).groupBy(F.col("event_type").alias("relatorio")).agg(
        F.min("event_date").alias("floor")
    )
    window = bronze.load_window(_control(spark, sf_dir), floors, TODAY, d.SETTINGS).where("relatorio = 'click'")
    days = window.select(F.explode(F.sequence("window_start", "window_end")).alias("event_date"))
    rows = d.raw_events(spark, sf_dir).where("event_type = 'click'").join(days, "event_date", "left_semi")
    return rows.groupBy("event_date").agg(F.count("event_id").alias("rows_to_load"))


_KNOWN_DAY = "CAST(ts AS DATE) - CAST(day(ts) % 4 AS INT)"


@registered("extraction_ranges", f"""WITH f AS (SELECT event_type AS relatorio, min(CAST(ts AS DATE)) AS floor FROM events GROUP BY ALL),
      w AS (SELECT relatorio, CASE WHEN last_end IS NULL THEN greatest(floor, DATE '2024-02-02') ELSE least(DATE '2024-02-02', last_end - 3) END AS s
            FROM f LEFT JOIN (SELECT relatorio, max(data_fim_janela) AS last_end FROM ({_CONTROL_SQL}) GROUP BY ALL) USING (relatorio)),
      k AS (SELECT DISTINCT event_type AS relatorio, {_KNOWN_DAY} AS event_date FROM events),
      x AS (SELECT relatorio, CAST(unnest(generate_series(s, DATE '2024-02-04', INTERVAL 1 DAY)) AS DATE) AS event_date FROM w
            UNION SELECT relatorio, event_date FROM (SELECT relatorio, CAST(unnest(generate_series(floor, DATE '2024-02-04', INTERVAL 1 DAY)) AS DATE) AS event_date FROM f)
              ANTI JOIN k USING (relatorio, event_date))
    SELECT relatorio, min(event_date) AS range_start, max(event_date) AS range_end
    FROM (SELECT *, event_date - CAST(row_number() OVER (PARTITION BY relatorio, month(event_date) ORDER BY event_date) AS INT) AS run FROM x)
    GROUP BY relatorio, month(event_date), run""")
def extraction_ranges(spark, sf_dir):
    """Windows of the reports and all days without a snapshot, where three of four days have none."""
    events = d.raw_events(spark, sf_dir).withColumnRenamed("event_type", "relatorio")
    floors = events.groupBy("relatorio").agg(F.min("event_date").alias("floor"))
    known = events.select("relatorio", F.date_sub("event_date", F.day("event_date") % 4).alias("event_date"))
    return bronze.extraction_ranges(_control(spark, sf_dir), known, floors, dt.date(2024, 2, 5), d.SETTINGS, history=True)


_OLD = f"SELECT painel, ordem_menu, tema, hierarquia, tipo, true AS ativo FROM dim_painel WHERE {d.BRAND_NO.replace('p_brand', 'painel')} <= 18"
_SEED = f"SELECT painel, ordem_menu + 100 AS ordem_menu, 'new ' || tema AS tema, hierarquia, tipo FROM dim_painel WHERE {d.BRAND_NO.replace('p_brand', 'painel')} >= 6"


@registered("dim_upsert", f"""SELECT COALESCE(s.painel, o.painel) AS painel, CASE WHEN s.painel IS NULL THEN o.ordem_menu ELSE s.ordem_menu END AS ordem_menu,
      CASE WHEN s.painel IS NULL THEN o.tema ELSE s.tema END AS tema, CASE WHEN s.painel IS NULL THEN o.hierarquia ELSE s.hierarquia END AS hierarquia,
      CAST(NULL AS VARCHAR) AS publico_principal, CASE WHEN s.painel IS NULL THEN o.tipo ELSE s.tipo END AS tipo, s.painel IS NOT NULL AS ativo
    FROM ({_OLD}) o FULL JOIN ({_SEED}) s ON o.painel = s.painel""")
def dim_upsert(spark, sf_dir):
    """Five panels leave the seed and stay as inactive, seven are new, the rest is updated."""
    panels = d.panel_dimension(spark, sf_dir)
    number = F.expr(d.BRAND_NO.replace("p_brand", "painel"))
    old = panels.where(number <= 18).withColumn("ativo", F.lit(True))
    seed = panels.where(number >= 6).select(
        "painel", (F.col("ordem_menu") + 100).alias("ordem_menu"), F.concat(F.lit("new "), "tema").alias("tema"),
        "hierarquia", "publico_principal", "tipo", F.lit(True).alias("ativo"),
    )
    return dims.upsert_soft_delete(old, seed, "painel", "ativo")


@registered("key_upsert", """SELECT alvo, painel, versao, fonte FROM dim_relatorio WHERE alvo NOT IN (SELECT CAST(p_size AS VARCHAR) FROM part WHERE p_size <= 20)
    UNION ALL SELECT alvo, painel, 'unica', 'gtm' FROM dim_relatorio WHERE alvo IN (SELECT CAST(p_size AS VARCHAR) FROM part WHERE p_size <= 20)
    UNION ALL SELECT DISTINCT concat(p_brand, '.php'), p_brand, 'unica', 'site' FROM part WHERE p_size <= 20""")
def key_upsert(spark, sf_dir):
    """Twenty targets change, one per brand is new, the others survive."""
    old = d.report_dimension(spark, sf_dir)
    changed = old.where(F.expr("try_cast(alvo AS INT) <= 20")).withColumn("versao", F.lit("unica")).withColumn(
        "fonte", F.lit("gtm")
    )
    new = d.table(spark, sf_dir, "part").where("p_size <= 20").select(
        F.concat("p_brand", F.lit(".php")).alias("alvo"), F.col("p_brand").alias("painel"),
        F.lit("unica").alias("versao"), F.lit("site").alias("fonte"),
    ).distinct()
    return dims.upsert(old, changed.unionByName(new), "alvo")


_TABLES = {"ga4_eventos": "eventos", "ga4_paineis": "paineis", "ga4_usuarios": "usuarios", "ga4_paginas": "paginas"}


@registered("created_tables", " UNION ALL ".join(
    f"SELECT '{table}' AS tabela, CAST(0 AS BIGINT) AS linhas_antes, count(*) AS linhas, count(DISTINCT event_date) AS dias FROM {cte}"
    for table, cte in _TABLES.items()))
def created_tables(spark, sf_dir):
    """Every fact table as it is created, with its schema and no rows, and after the given data were written to it."""
    wh = Warehouse(spark, shared_dir(spark, "created_tables"))
    wh.create_all()
    given = d.silver(spark, sf_dir)
    parts = []
    for table in _TABLES:
        before = wh.silver(table)
        wh.replace_all(table, before.unionByName(getattr(given, table)))
        count = wh.silver(table).agg(F.count("*").alias("linhas"), F.count_distinct("event_date").alias("dias"))
        parts.append(count.select(F.lit(table).alias("tabela"), before.agg(F.count("*")).scalar().alias("linhas_antes"), "linhas", "dias"))
    return reduce(DataFrame.unionByName, parts)


_SEED = ", ".join("('{}', {})".format(name.replace("'", "''"), "NULL" if place is None else place) for name, place, *_ in seeds.PANELS)


@registered("seeded_panels", f"""SELECT painel, ordem_menu, count(p_partkey) AS parts, CAST(count(DISTINCT p_brand) AS BIGINT) AS brands
    FROM (VALUES {_SEED}) AS s(painel, ordem_menu) LEFT JOIN part ON p_size = ordem_menu GROUP BY ALL""")
def seeded_panels(spark, sf_dir):
    """The seeded panels, through a load of the dimensions, with the parts of their menu number."""
    wh = Warehouse(spark, shared_dir(spark, "seeded_panels"))
    wh.create_all()
    dims.load_dimensions(wh)
    part = d.table(spark, sf_dir, "part")
    joined = wh.dim("dim_painel").join(part, F.col("ordem_menu") == F.col("p_size"), "left")
    return joined.groupBy("painel", "ordem_menu").agg(F.count("p_partkey").alias("parts"), F.count_distinct("p_brand").alias("brands"))
