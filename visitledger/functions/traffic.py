"""Site classification and the robot rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import RobotRule, Settings


def site_of(hostname: Column, settings: Settings) -> Column:
    """Site label of a host: exact, case-insensitive; unknown hosts fall to the catch-all label."""
    host = F.lower(hostname)
    out = F
    for rule in settings.sites:
        out = out.when(host.isin(*rule.hosts), F.lit(rule.label))
    return out.otherwise(F.lit(settings.other_site))


def valid_traffic(sessions: Column, engaged: Column, rule: RobotRule) -> Column:
    """Somebody engaged, and the segment is not a large blob with almost no engagement.

    The rate is compared by cross multiplication: exact on integers, and no division by zero under ANSI.
    """
    blob = (sessions >= rule.min_sessions) & (100 * engaged < rule.min_engaged_pct * sessions)
    return (engaged > 0) & ~blob
