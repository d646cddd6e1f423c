"""Target of a dashboard URL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The escapes that are undone, in this order (the percent sign itself first).
ESCAPES = (
    ("%25", "%"), ("%3A", ":"), ("%2F", "/"), ("%3F", "?"), ("%3D", "="), ("%26", "&"), ("%2B", "+"), ("%2C", ","),
)
PAYLOAD_PARAMETER = r"[?&]r=([A-Za-z0-9+/_-]+)"
REDIRECT_PARAMETER = r"redirect=([^&#?]+)"


def _undo_escapes(url: Column) -> Column:
    for escape, char in ESCAPES:
        url = F.replace(url, F.lit(escape), F.lit(char))
    return url


def _capture(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def payload_field(encoded: Column, field: str) -> Column:
    """A text field of a JSON object in base64 or base64url, with or without padding; NULL when unreadable."""
    std = F.translate(encoded, "-_", "+/")
    pad = F.pmod(-F.length(std), F.lit(4))
    raw = F.try_to_binary(F.concat(std, F.repeat(F.lit("="), pad)), F.lit("base64"))
    return F.get_json_object(F.try_validate_utf8(raw.cast("string")), f"$.{field}")


def redirect_target(url: Column) -> Column:
    """Report id carried in the ``r=`` payload, else the plain page named by ``redirect=``.

    The URL may carry zero, one or two levels of percent-encoding. Anything unreadable gives NULL; a payload
    that is present but broken never falls back to the page name.
    """
    plain = _undo_escapes(_undo_escapes(url))
    payload = _capture(plain, PAYLOAD_PARAMETER)
    return F.when(payload.isNull(), _capture(plain, REDIRECT_PARAMETER)).otherwise(payload_field(payload, "k"))
