"""Measures: a base view, an aggregate and an optional condition, evaluated at any grouping."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import PAGE_EVENT, PANEL_EVENTS
from ..functions.text import ratio_or_zero


@dataclass(frozen=True)
class Base:
    """An aggregate over one view. ``additive`` is False where adding days or members counts people twice."""

    view: str
    column: str | None
    where: str | None = None
    additive: bool = True

    def expression(self) -> Column:
        if self.column is None:
            return F.count("*") if self.where is None else F.count_if(F.expr(self.where))
        value = F.col(self.column)
        return F.sum(value if self.where is None else F.when(F.expr(self.where), value))


@dataclass(frozen=True)
class Derived:
    """A formula over other measures, computed after they are aggregated (so totals are right)."""

    parts: tuple[str, ...]
    formula: Callable[..., Column]

    def expression(self) -> Column:
        return self.formula(*[F.col(p) for p in self.parts])


def _share(num: str, den: str) -> Derived:
    return Derived((num, den), ratio_or_zero)


def _per_minute(num: str, den: str) -> Derived:
    return Derived((num, den), lambda n, d: ratio_or_zero(n, d * 60))


def _minutes(seconds: str) -> Derived:
    return Derived((seconds,), lambda s: ratio_or_zero(s, F.lit(60)))


_VALID = "trafego_valido"
_MOBILE = "device_category = 'mobile'"
_DESKTOP = "device_category = 'desktop'"
_VALID_MOBILE = f"{_VALID} AND {_MOBILE}"
_RANK, _DEVICE, _SESSIONS = "vw_paineis_ranking", "vw_engajamento_dispositivo", "vw_sessoes"
_QUALITY, _OVERVIEW, _HOME, _UNMAPPED = (
    "vw_qualidade_trafego", "vw_site_overview", "vw_institucional_eventos", "vw_paineis_sem_mapeamento"
)


MEASURES: dict[str, Base | Derived] = {
    # panels
    "total_acessos": Base(_RANK, "acessos"),
    "usuarios_unicos": Base(_RANK, "usuarios", additive=False),
    "sessoes": Base(_RANK, "sessoes"),
    "sessoes_engajadas": Base(_RANK, "sessoes_engajadas"),
    "_tempo_medio_seg": Base(_RANK, "tempo_medio_seg", additive=False),
    "tempo_medio_min": _minutes("_tempo_medio_seg"),
    "taxa_engajamento": _share("sessoes_engajadas", "sessoes"),
    # devices
    "acessos_mobile": Base(_DEVICE, "sessoes", _MOBILE),
    "acessos_desktop": Base(_DEVICE, "sessoes", _DESKTOP),
    "total_acessos_dispositivo": Base(_DEVICE, "sessoes"),
    "pct_mobile": _share("acessos_mobile", "total_acessos_dispositivo"),
    "_segundos_mobile": Base(_SESSIONS, "user_engagement_seconds", _VALID_MOBILE),
    "tempo_engaj_mobile_min": _per_minute("_segundos_mobile", "sessoes_validas"),
    # audience
    "total_sessoes_site": Base(_SESSIONS, "sessions"),
    "sessoes_validas": Base(_SESSIONS, "sessions", _VALID),
    "usuarios_ativos": Base(_SESSIONS, "active_users", additive=False),
    "sessoes_engajadas_site": Base(_SESSIONS, "engaged_sessions"),
    "_segundos_validos": Base(_SESSIONS, "user_engagement_seconds", _VALID),
    "tempo_total_engaj_min": _minutes("_segundos_validos"),
    # traffic quality
    "sessoes_validas_total": Base(_QUALITY, "sessoes_validas"),
    "sessoes_descartadas": Base(_QUALITY, "sessoes_descartadas"),
    "total_sessoes_bruto": Derived(
        ("sessoes_validas_total", "sessoes_descartadas"),
        lambda kept, dropped: F.coalesce(kept, F.lit(0)) + F.coalesce(dropped, F.lit(0)),
    ),
    "pct_trafego_real": _share("sessoes_validas_total", "total_sessoes_bruto"),
    "pct_bots": _share("sessoes_descartadas", "total_sessoes_bruto"),
    # overview
    "total_usuarios": Base(_OVERVIEW, "usuarios", additive=False),
    "total_sessoes": Base(_OVERVIEW, "sessoes"),
    "total_sessoes_engajadas": Base(_OVERVIEW, "sessoes_engajadas"),
    "taxa_engaj_site": _share("total_sessoes_engajadas", "total_sessoes"),
    "tempo_engaj_medio_min": _per_minute("_segundos_validos", "sessoes_validas"),
    # home site
    "eventos_institucional": Base(_HOME, "eventos"),
    "usuarios_institucional": Base(_HOME, "usuarios", additive=False),
    "pageviews": Base(_HOME, "eventos", f"event_name = '{PAGE_EVENT}'"),
    "eventos_por_usuario": _share("eventos_institucional", "usuarios_institucional"),
    # maintenance
    "paineis_sem_mapeamento": Base(_UNMAPPED, None),
    "eventos_nao_mapeados": Base(_UNMAPPED, "eventos"),
    # corrected forms of three measures whose published definition is kept above
    "acessos_abertos": Base(_RANK, "acessos", f"event_name = '{PANEL_EVENTS[0]}'"),
    "_segundos_painel": Base(_DEVICE, "tempo_engajamento_s"),
    "tempo_por_sessao_min": _per_minute("_segundos_painel", "total_acessos_dispositivo"),
    "_sessoes_validas_mobile": Base(_SESSIONS, "sessions", _VALID_MOBILE),
    "tempo_mobile_por_sessao_min": _per_minute("_segundos_mobile", "_sessoes_validas_mobile"),
}

# Display names of the published measures.
LABELS = {
    "total_acessos": "Total Acessos",
    "usuarios_unicos": "Usuários Únicos",
    "sessoes": "Sessões",
    "sessoes_engajadas": "Sessões Engajadas",
    "tempo_medio_min": "Tempo Médio (min)",
    "taxa_engajamento": "Taxa Engajamento %",
    "acessos_mobile": "Acessos Mobile",
    "acessos_desktop": "Acessos Desktop",
    "total_acessos_dispositivo": "Total Acessos Dispositivo",
    "pct_mobile": "% Mobile",
    "tempo_engaj_mobile_min": "Tempo Engaj Mobile (min)",
    "total_sessoes_site": "Total Sessões Site",
    "sessoes_validas": "Sessões Válidas",
    "usuarios_ativos": "Usuários Ativos",
    "sessoes_engajadas_site": "Sessões Engajadas Site",
    "tempo_total_engaj_min": "Tempo Total Engaj (min)",
    "sessoes_validas_total": "Sessões Válidas Total",
    "sessoes_descartadas": "Sessões Descartadas",
    "total_sessoes_bruto": "Total Sessões Bruto",
    "pct_trafego_real": "% Tráfego Real",
    "pct_bots": "% Bots",
    "total_usuarios": "Total Usuários",
    "total_sessoes": "Total Sessões",
    "total_sessoes_engajadas": "Total Sessões Engajadas",
    "taxa_engaj_site": "Taxa Engaj Site %",
    "tempo_engaj_medio_min": "Tempo Engaj Médio (min)",
    "eventos_institucional": "Eventos Institucional",
    "usuarios_institucional": "Usuários Institucional",
    "pageviews": "Pageviews",
    "eventos_por_usuario": "Eventos por Usuário",
    "paineis_sem_mapeamento": "Painéis Sem Mapeamento",
    "eventos_nao_mapeados": "Eventos Não Mapeados",
}
