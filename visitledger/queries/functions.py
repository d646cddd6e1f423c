"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, text
from ..functions.url import payload_field, redirect_target
from . import dataset as d
from .registry import registered


@registered("url_targets", "SELECT page_location, alvo FROM page_targets")
def url_targets(spark, sf_dir):
    """Every panel URL: no, one and two levels of encoding, plain pages and broken payloads."""
    urls = d.page_events(spark, sf_dir).select("page_location").distinct()
    return urls.withColumn("alvo", redirect_target(F.col("page_location")))


@registered("payload_target", """SELECT json_extract_string(props, '$.k') AS alvo, count(*) AS n FROM events GROUP BY ALL""")
def payload_target(spark, sf_dir):
    """Encode every event's JSON as base64url without padding and read the field back."""
    encoded = F.rtrim(F.translate(F.base64(F.col("props").cast("binary")), "+/", "-_"), F.lit("="))
    events = d.table(spark, sf_dir, "events").select(payload_field(encoded, "k").alias("alvo"))
    return events.groupBy("alvo").agg(F.count("*").alias("n"))


@registered("page_url_targets", """SELECT page_id, NULLIF(regexp_extract(replace(replace(url, 'ref=', 'redirect='),
    'utm_source=', 'redirect='), 'redirect=([^&#?]+)', 1), '') AS alvo FROM pages""")
def page_url_targets(spark, sf_dir):
    url = F.replace(F.replace("url", F.lit("ref="), F.lit("redirect=")), F.lit("utm_source="), F.lit("redirect="))
    return d.table(spark, sf_dir, "pages").select("page_id", redirect_target(url).alias("alvo"))


@registered("text_defaults", """SELECT COALESCE(NULLIF(trim(regexp_extract(url, '[?&]([a-z_]+)=', 1)), ''), '(not set)') AS parameter,
    count(*) AS n FROM pages GROUP BY ALL""")
def text_defaults(spark, sf_dir):
    first = text.or_not_set(F.regexp_extract("url", "[?&]([a-z_]+)=", 1))
    return d.table(spark, sf_dir, "pages").groupBy(first.alias("parameter")).agg(F.count("*").alias("n"))


_MONTH = "CASE month(day) " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(dates.MONTHS_SHORT, 1)) + " END"
_DAY = "CASE dayofweek(day) " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(dates.DAYS)) + " END"


@registered("date_functions", f"""SELECT day, CAST(date_trunc('week', day) AS DATE) AS week_start,
      CAST(day - CAST(isodow(day) AS INT) AS DATE) AS closed_sunday, CAST(date_trunc('month', day) + INTERVAL 1 MONTH AS DATE) AS next_month,
      CAST(date_diff('day', date_trunc('month', day), day) + 1 AS INT) AS day_of_period, {_MONTH} AS month_name, {_DAY} AS day_name,
      CAST(quarter(day) AS INT) AS quarter, day AS parsed, n
    FROM (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY ALL)""")
def date_functions(spark, sf_dir):
    days = d.table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    day = F.col("day")
    return days.select(
        "day",
        dates.week_start(day).alias("week_start"),
        dates.last_closed_sunday(day).alias("closed_sunday"),
        dates.next_month_start(day).alias("next_month"),
        dates.inclusive_days(F.trunc("day", "MM"), day).alias("day_of_period"),
        dates.month_short(day).alias("month_name"),
        dates.day_name(day).alias("day_name"),
        F.quarter(day).alias("quarter"),
        dates.from_compact(F.date_format("day", "yyyyMMdd")).alias("parsed"),
        "n",
    )


@registered("local_days", """SELECT CAST(ts - INTERVAL 3 HOURS AS DATE) AS local_day, count(*) AS events,
    min(strftime(ts, '%Y%m%d%H%M')) AS first_minute, date_trunc('minute', min(ts)) AS first_at FROM events GROUP BY ALL""")
def local_days(spark, sf_dir):
    """Days in the property's time zone, and compact minute text read back."""
    events = d.table(spark, sf_dir, "events")
    local = F.to_date(dates.local_time(F.col("ts"), "America/Sao_Paulo"))
    out = events.groupBy(local.alias("local_day")).agg(
        F.count("*").alias("events"), F.min(F.date_format("ts", "yyyyMMddHHmm")).alias("first_minute")
    )
    return out.withColumn("first_at", dates.minute_from_compact(F.col("first_minute")))


_SHOW_INT = "replace(format('{:,}', CAST(round_even(total / 100.0, 0) AS BIGINT)), ',', '.')"


@registered("display_formats", f"""SELECT o_custkey, {_SHOW_INT} AS whole,
      replace(format('{{:.1f}}', n / 20.0), '.', ',') AS one_place,
      CASE WHEN urgent IS NULL THEN '—' ELSE replace(format('{{:.0f}}', round_even(100.0 * urgent / n, 0)), '.', ',') || '%' END AS share,
      CASE WHEN secs = 0 THEN '—' WHEN secs < 60 THEN secs || ' s'
           ELSE (secs // 60) || ' min ' || lpad(CAST(secs % 60 AS VARCHAR), 2, '0') || ' s' END AS duration
    FROM (SELECT o_custkey, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total,
            count(*) FILTER (WHERE o_orderpriority LIKE '1%') AS urgent, count(*) * 13 - 13 AS secs FROM orders GROUP BY ALL)""")
def display_formats(spark, sf_dir):
    per_customer = d.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("n"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("total"),
        F.count_if(F.col("o_orderpriority").startswith("1")).alias("urgent"),
    )
    return per_customer.select(
        "o_custkey",
        text.show_integer(F.col("total") / 100).alias("whole"),
        text.show_decimal(F.col("n") / 20).alias("one_place"),
        text.show_percent(F.col("urgent"), F.col("n")).alias("share"),
        text.show_duration(F.col("n") * 13 - 13).alias("duration"),
    )


@registered("display_names", """SELECT region, CASE WHEN region = '' THEN 'Não identificado'
      WHEN n_name = 'NATION_3' THEN 'Três' ELSE n_name END AS state, n
    FROM (SELECT CASE WHEN n_nationkey % 8 = 7 THEN '' ELSE concat('State of ', n_name) END AS region,
            CASE WHEN n_nationkey % 8 = 7 THEN '' ELSE n_name END AS n_name, count(*) AS n
          FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL)""")
def display_names(spark, sf_dir):
    nation = d.table(spark, sf_dir, "nation")
    customers = d.table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    counts = customers.groupBy(F.expr(d.REGION).alias("region")).agg(F.count("*").alias("n"))
    return counts.select("region", text.state_name(F.col("region"), {"NATION_3": "Três"}).alias("state"), "n")


@registered("change_labels", """WITH days AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY ALL),
      pairs AS (SELECT a.day, a.n, COALESCE(b.n, 0) AS previous FROM days a LEFT JOIN days b ON b.day = a.day - 7),
      rated AS (SELECT *, CAST(n - previous AS DOUBLE) / NULLIF(previous, 0) AS var FROM pairs)
    SELECT day, n, previous, var AS change,
      CASE WHEN var IS NULL THEN 'sem semana anterior para comparar' WHEN abs(var) < 0.03 THEN 'estável vs. semana anterior'
           ELSE (CASE WHEN var > 0 THEN 'cresceu ' ELSE 'caiu ' END) || CAST(round_even(abs(var) * 100, 0) AS BIGINT) || '% vs. semana anterior' END AS phrase,
      CASE WHEN var IS NULL THEN 'new' WHEN abs(var) < 0.005 THEN 'flat' WHEN var > 0 THEN 'up' ELSE 'dn' END AS arrow,
      COALESCE(abs(var) >= 0.1, false) AS headline FROM rated""")
def change_labels(spark, sf_dir):
    """Every day against the same weekday of the week before."""
    days = d.table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    before = days.select(F.date_add("day", 7).alias("day"), F.col("n").alias("previous"))
    rated = days.join(before, "day", "left").fillna(0, ["previous"]).withColumn(
        "change", text.change(F.col("n"), F.col("previous"))
    )
    return rated.select(
        "*", text.change_phrase(F.col("change")).alias("phrase"), text.change_arrow(F.col("change")).alias("arrow"),
        text.headline_worthy(F.col("change")).alias("headline"),
    )
