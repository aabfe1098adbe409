"""Column functions: each takes and returns a ``Column`` and compiles to built-in expressions only
(no Python UDF), so it stays inside whole-stage codegen.

The numeric helpers pin the rules the SQL oracle uses (see the trap notes in each docstring).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# Finishing-position labels, best to worst, then the label for no classification:
POSITION_LABELS = ("Victoria", "Podio", "Puntos", "Sin puntos", "No clasificado")
# Position thresholds of the ladder: winner, podium, points.
WIN_POSITION, PODIUM_POSITION, POINTS_POSITION = 1, 3, 10
# Text used for a null part of a surrogate key, and the separator between parts:
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"
# Status of a classified finish:
FINISHED_STATUS = "Finished"
# Lap-time seconds pattern and the minute separator:
LAP_SECONDS_FORMAT = "%06.3f"
# Event-name shortening for axis labels:
EVENT_SUFFIX, EVENT_SUFFIX_SHORT = " Grand Prix", " GP"
# ---------------------------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def race_id(year, round_) -> Column:
    """``YYYY-RR``: year as text, dash, round left-padded to two characters.

    ``lpad`` truncates past two characters (round 123 -> '12'), as the SQL original does, so rounds
    above 99 collide; ``expectations.round_fits_key`` checks that precondition.
    """
    return F.concat(_col(year).cast("string"), F.lit("-"), F.lpad(_col(round_).cast("string"), 2, "0"))


def surrogate_key(*cols) -> Column:
    """md5 over the parts cast to text, nulls replaced by a fixed token, joined by '-'."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


def classify_position(pos) -> Column:
    """Five-label ladder: 1, <=3, <=10, other non-null, null."""
    p = _col(pos)
    win, podium, points, other, unclassified = POSITION_LABELS
    return (F.when(p == WIN_POSITION, win)
            .when(p <= PODIUM_POSITION, podium)
            .when(p <= POINTS_POSITION, points)
            .when(p.isNotNull(), other)
            .otherwise(unclassified))


def round_half_away(x, digits: int) -> Column:
    """``round(x, digits)`` with the oracle's rule: scale, round half away from zero on the binary
    value, unscale. Plain Spark ``round`` rounds the decimal text (1.025 -> 1.03 instead of 1.02)."""
    scale = float(10 ** digits)
    return F.round(_col(x) * F.lit(scale)) / F.lit(scale)


def to_int(x) -> Column:
    """Number -> INT rounding half to even (the oracle's cast), not Spark's truncation."""
    return F.rint(_col(x).cast("double")).cast("int")


def exact_points(x) -> Column:
    """Points as DECIMAL, so that their sums do not depend on the order of the rows."""
    return _col(x).cast("decimal(18,6)")


def nan_to_null(x) -> Column:
    """NaN -> null, so a later integer cast cannot fail and aggregates skip the value."""
    c = _col(x)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def text_or_empty(x) -> Column:
    """Missing value -> '' and anything else -> its text form."""
    return F.coalesce(_col(x).cast("string"), F.lit(""))


def format_lap_time(seconds) -> Column:
    """``m:ss.mmm`` — whole minutes, colon, seconds modulo 60 zero-padded to width 6 with 3 decimals.

    Format only values already rounded to 3 decimals (``round_half_away``); null stays null because
    ``concat`` is null-propagating.
    """
    s = _col(seconds)
    minutes = F.floor(s / F.lit(60.0)).cast("int").cast("string")
    return F.concat(minutes, F.lit(":"), F.format_string(LAP_SECONDS_FORMAT, s % F.lit(60.0)))


def short_event_name(name) -> Column:
    """Literal (not regex) replacement of the long event suffix."""
    return F.replace(_col(name), F.lit(EVENT_SUFFIX), F.lit(EVENT_SUFFIX_SHORT))


def interval_seconds(x) -> Column:
    """Day-time interval -> seconds as DOUBLE, null-safe (microsecond exact via DECIMAL)."""
    c = _col(x).cast("interval day to second")
    whole = (F.extract(F.lit("DAY"), c).cast("decimal(18,6)") * 86400
             + F.extract(F.lit("HOUR"), c) * 3600 + F.extract(F.lit("MINUTE"), c) * 60)
    return (whole + F.extract(F.lit("SECOND"), c)).cast("double")


def iso_date(d) -> Column:
    """Date -> ISO ``yyyy-MM-dd`` text (how a landed calendar carries its dates)."""
    return F.date_format(_col(d), "yyyy-MM-dd")


def season_week(ts) -> Column:
    """Round number of a timestamp inside its year: 7-day blocks from 1 January (1..53)."""
    return (F.floor((F.dayofyear(_col(ts)) - F.lit(1)) / F.lit(7))).cast("int") + F.lit(1)


def points_label(points) -> Column:
    """Final-points display text: whole points then ' pts' (null stays null)."""
    return F.concat(_col(points).cast("int").cast("string"), F.lit(" pts"))
