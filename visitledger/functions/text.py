"""Text and number columns: blanks, safe ratios, display names and display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import NOT_SET


def or_not_set(col: Column) -> Column:
    """Blank or missing text becomes the literal not-set member."""
    return F.coalesce(F.nullif(col, F.lit("")), F.lit(NOT_SET))


def ratio(num: Column, den: Column) -> Column:
    """num / den as double; NULL when the denominator is 0 or missing."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def ratio_or_zero(num: Column, den: Column) -> Column:
    """num / den with 0 in place of an undefined result."""
    return F.coalesce(ratio(num, den), F.lit(0.0))


def lookup(col: Column, names: dict[str, str], default: Column | None = None) -> Column:
    """Translate through a small fixed dictionary; unknown values pass through unless a default is given."""
    pairs = [F.lit(x) for item in names.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), col)
    return F.coalesce(found, col if default is None else default)


def state_name(region: Column, names: dict[str, str]) -> Column:
    """Drop the ``State of `` prefix, translate, and name the empty region."""
    bare = F.trim(F.regexp_replace(F.coalesce(region, F.lit("")), "^State of ", ""))
    return F.when(bare == "", F.lit("Não identificado")).otherwise(lookup(bare, names))


# ---- display formats: use at the edge of a report only -------------------------------------------------------------

def _swap_marks(text: Column) -> Column:
    """1,234.5 -> 1.234,5"""
    return F.translate(text, ",.", ".,")


def show_integer(value: Column) -> Column:
    """Whole number, half to even, with a dot between thousands; missing shows as 0."""
    return _swap_marks(F.format_number(F.bround(F.coalesce(value.cast("double"), F.lit(0.0)), 0).cast("bigint"), 0))


def show_decimal(value: Column, places: int = 1) -> Column:
    """Fixed number of places with a decimal comma and no thousands mark; missing shows as 0.

    The binary value is rounded, not its shortest decimal form: 0.35 is a little less than it looks and shows as 0,3.
    """
    number = F.coalesce(value.cast("double"), F.lit(0.0))
    rounded = _round_binary(number, places) / F.lit(10.0 ** places)
    return F.translate(F.format_string(f"%.{places}f", rounded), ".", ",")


def _round_binary(number: Column, places: int) -> Column:
    """``number`` times ten to ``places`` as a whole number; only exact ties go to the even one.

    Where the product looks like a tie, what the multiplication lost (from the halves of a split factor) settles it.
    """
    scale = F.lit(10.0 ** places)
    product = number * scale
    spread = number * F.lit(134217729.0)
    upper = spread - (spread - number)
    lost = (upper * scale - product) + (number - upper) * scale
    low = F.floor(product).cast("double")
    tie = F.when(lost > 0, low + 1).when(lost < 0, low).otherwise(F.rint(product))
    return F.when(product - low == 0.5, tie).otherwise(F.rint(product))


def show_percent(num: Column, den: Column, places: int = 0) -> Column:
    """100 * num / den with a percent sign; a dash when there is no base."""
    share = 100 * num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
    return F.when(share.isNull(), F.lit("—")).otherwise(F.concat(show_decimal(share, places), F.lit("%")))


def show_duration(seconds: Column) -> Column:
    """``m min ss s``, or ``s s`` below one minute; a dash for nothing."""
    whole = F.bround(seconds.cast("double"), 0).cast("bigint")
    minutes = F.floor(whole / 60)
    rest = whole % 60
    return (
        F.when(F.coalesce(seconds.cast("double"), F.lit(0.0)) == 0, F.lit("—"))
        .when(minutes > 0, F.format_string("%d min %02d s", minutes, rest))
        .otherwise(F.format_string("%d s", rest))
    )


# Sentence of a week without large changes.
STABLE_WEEK = "Semana estável nos dois portais — sem grandes variações de público frente à anterior."


# ---- change between two periods ------------------------------------------------------------------------------------

def change(current: Column, previous: Column) -> Column:
    """Relative change; NULL when the base is 0 or missing."""
    return ratio(current - previous, previous)


def change_phrase(var: Column) -> Column:
    """Sentence used in the text summary: changes below 3% count as stable."""
    grown = F.when(var > 0, F.lit("cresceu")).otherwise(F.lit("caiu"))
    return (
        F.when(var.isNull(), F.lit("sem semana anterior para comparar"))
        .when(F.abs(var) < 0.03, F.lit("estável vs. semana anterior"))
        .otherwise(F.concat(grown, F.lit(" "), _whole_percent(var), F.lit("% vs. semana anterior")))
    )


def change_arrow(var: Column) -> Column:
    """Label of the small arrow beside a KPI: ``new``, ``flat`` (below 0.5%), ``up`` or ``dn``."""
    return (
        F.when(var.isNull(), F.lit("new"))
        .when(F.abs(var) < 0.005, F.lit("flat"))
        .when(var > 0, F.lit("up"))
        .otherwise(F.lit("dn"))
    )


def headline_worthy(var: Column) -> Column:
    """Only changes of at least 10% reach the headline."""
    return F.coalesce(F.abs(var) >= 0.10, F.lit(False))


def _whole_percent(var: Column) -> Column:
    return F.format_string("%d", F.bround(F.abs(var) * 100, 0).cast("bigint"))


def headline(panel_site: str, panel_var: Column, home_site: str, home_var: Column) -> Column:
    """One sentence naming the sites whose weekly users moved by 10% or more."""

    def part(site: str, var: Column) -> Column:
        verb = F.when(var > 0, F.lit("ganhou")).otherwise(F.lit("perdeu"))
        text = F.concat(F.lit(f"o {site} "), verb, F.lit(" "), _whole_percent(var), F.lit("% de usuários"))
        return F.when(headline_worthy(var), text)

    both = F.concat_ws(" e ", part(panel_site, panel_var), part(home_site, home_var))
    return F.when(
        both != "", F.concat(F.lit("Esta semana, "), both, F.lit(" frente à semana anterior."))
    ).otherwise(F.lit(STABLE_WEEK))
