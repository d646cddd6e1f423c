"""Deployment settings. Everything a site owner may change lives here; nothing is read from the environment."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

NOT_SET = "(not set)"


@dataclass(frozen=True)
class SiteRule:
    """Hosts (lower case, exact) that belong to one site label. Translate proxies are listed as hosts too."""

    label: str
    hosts: tuple[str, ...]


@dataclass(frozen=True)
class RobotRule:
    """A segment is a robot blob when it is large and almost nobody in it engages."""

    min_sessions: int = 30
    min_engaged_pct: int = 5


@dataclass(frozen=True)
class Feed:
    """One report feed: source field -> (silver column, kind).

    kind: ``date`` (YYYYMMDD), ``dim`` (blank -> not set), ``text`` (as is), ``count`` (bigint), ``seconds`` (decimal).
    """

    name: str
    table: str
    fields: dict[str, tuple[str, str]]
    first_day: dt.date
    min_history_days: int | None = None

    @property
    def dimensions(self) -> list[str]:
        return [f for f, (_, kind) in self.fields.items() if kind in ("date", "dim", "text")]

    @property
    def metrics(self) -> list[str]:
        return [f for f, (_, kind) in self.fields.items() if kind in ("count", "seconds")]

    def floor(self, today: dt.date) -> dt.date:
        """Earliest day an incremental load may reach when nothing has been loaded yet."""
        if self.min_history_days is not None:
            return today - dt.timedelta(days=self.min_history_days)
        return self.first_day


# Field names of the source report service and the typed column each one becomes.
_DATE = {"date": ("event_date", "date")}
_HOST = {"hostName": ("hostname", "text")}
_GEO = {"country": ("country", "dim"), "region": ("region", "dim"), "city": ("city", "dim")}
_DEVICE = {"deviceCategory": ("device_category", "dim")}
_EVENT = {"eventName": ("event_name", "text")}
_VISIT_METRICS = {
    "sessions": ("sessions", "count"),
    "engagedSessions": ("engaged_sessions", "count"),
}
_ENGAGEMENT = {"userEngagementDuration": ("user_engagement_seconds", "seconds")}
_EVENT_METRICS = {
    "eventCount": ("event_count", "count"),
    **_VISIT_METRICS,
    "activeUsers": ("active_users", "count"),
    **_ENGAGEMENT,
}

FEEDS: dict[str, Feed] = {
    "site": Feed(
        "site",
        "ga4_eventos",
        {
            **_DATE, **_HOST, **_GEO, **_DEVICE,
            "browser": ("browser", "dim"),
            "operatingSystem": ("operating_system", "dim"),
            **_EVENT, **_EVENT_METRICS,
        },
        first_day=dt.date(2023, 2, 1),
        min_history_days=1095,
    ),
    "painel": Feed(
        "painel",
        "ga4_paineis",
        {
            **_DATE, **_HOST, **_GEO, **_DEVICE, **_EVENT,
            "customEvent:nome_painel": ("nome_painel_raw", "dim"),
            **_EVENT_METRICS,
        },
        first_day=dt.date(2026, 6, 1),
    ),
    "usuarios": Feed(
        "usuarios",
        "ga4_usuarios",
        {
            **_DATE, **_HOST,
            "country": ("country", "dim"),
            **_DEVICE,
            "active1DayUsers": ("dau", "count"),
            "active7DayUsers": ("wau", "count"),
            "active28DayUsers": ("mau", "count"),
            **_VISIT_METRICS, **_ENGAGEMENT,
        },
        first_day=dt.date(2023, 2, 1),
        min_history_days=1095,
    ),
    "paginas": Feed(
        "paginas",
        "ga4_paginas",
        {
            **_DATE, **_HOST,
            "pageLocation": ("page_location", "text"),
            "eventCount": ("page_views", "count"),
            "activeUsers": ("usuarios", "count"),
            "active7DayUsers": ("usuarios_7d", "count"),
            "active28DayUsers": ("usuarios_28d", "count"),
        },
        first_day=dt.date(2026, 6, 1),
    ),
}

PANEL_EVENTS = ("painel_acessado", "painel_clicado")
SESSION_EVENT = "session_start"
ENGAGEMENT_EVENT = "user_engagement"
PAGE_EVENT = "page_view"
SEGMENT = (
    "event_date", "hostname", "country", "region", "city", "device_category", "browser", "operating_system",
)
WINDOW_DAYS = (1, 7, 28)


@dataclass(frozen=True)
class Settings:
    panel_site: SiteRule = SiteRule("Dados", ("data.example.org", "data-example-org.translate.test"))
    home_site: SiteRule = SiteRule(
        "Institucional", ("example.org", "www.example.org", "example-org.translate.test")
    )
    other_site: str = "Outros"
    robots: RobotRule = field(default_factory=RobotRule)
    home_country: str = "Brazil"
    contact_page: str = "contato.php"
    lookback_days: int = 3
    day_closes_at_hour: int = 12

    @property
    def sites(self) -> tuple[SiteRule, ...]:
        return (self.panel_site, self.home_site)
