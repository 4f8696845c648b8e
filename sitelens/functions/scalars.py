"""Scalar rules, each ``Column -> Column`` built from Spark's own functions.

All of them stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
STATE_PATTERN = r"\.([a-z]{2})\.gov\.br"
NAME_SUFFIXES = [".gov.br", ".org.br", ".com.br"]
NO_STATE = "N/A"
VALID_URL_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+"
BAND_GOOD, BAND_OK = 0.9, 0.5
BADGE_EXCELLENT, BADGE_GOOD = 80, 60
BADGE_TEXT = {"excellent": "Excelente", "good": "Bom", "poor": "Precisa Melhorar"}
STATUS_OK_MARK, STATUS_FAIL_MARK = "✅", "❌"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def state_from_url(url) -> Column:
    """Two-letter state of a ``.xx.gov.br`` host, upper case; '' if none.

    Case-sensitive and unanchored, as the grouping report uses it.
    """
    return F.upper(F.regexp_extract(_c(url), STATE_PATTERN, 1))


def state_label(url) -> Column:
    """Like X1 on the lower-cased url; 'N/A' when there is no state."""
    s = F.upper(F.regexp_extract(F.lower(_c(url)), STATE_PATTERN, 1))
    return F.when(s != "", s).otherwise(F.lit(NO_STATE))


def url_host(url) -> Column:
    """Host part of an absolute url: lower case, without user info and port."""
    auth = F.regexp_extract(_c(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    host = F.regexp_replace(auth, r"^.*@", "")
    host = F.regexp_replace(host, r":[0-9]*$", "")
    return F.lower(host)


def site_name(url) -> Column:
    """Friendly name — host without every 'www.' and one of each suffix.

    The suffixes are tried in order, each removed at most once; a url without
    a host gives the url itself.
    """
    host = url_host(url)
    name = F.replace(host, F.lit("www."), F.lit(""))
    for suffix in NAME_SUFFIXES:
        name = _strip_suffix(name, suffix)
    return F.when(host != "", name).otherwise(_c(url))


def _strip_suffix(name: Column, suffix: str) -> Column:
    return F.when(name.endswith(suffix),
                  F.substring(name, F.lit(1), F.length(name) - F.lit(len(suffix))))\
        .otherwise(name)


def normalize_url(url) -> Column:
    """Strip trailing slashes, then add exactly one."""
    return F.concat(F.regexp_replace(_c(url), "/+$", ""), F.lit("/"))


def is_valid_url(url) -> Column:
    """Scheme and network location both present."""
    return F.coalesce(_c(url).rlike(VALID_URL_PATTERN), F.lit(False))


def day(ts) -> Column:
    """Calendar day of a timestamp (keeps no zone)."""
    return F.to_date(_c(ts))


def score_percent(x, null_as_zero: bool = True) -> Column:
    """0..1 score to percent with one decimal, half up.

    ``null_as_zero`` gives 0.0 for a missing score (mobile scores); otherwise
    NULL stays NULL and 0 stays 0.0 (desktop scores).
    """
    v = F.coalesce(_c(x), F.lit(0.0)) if null_as_zero else _c(x)
    return F.round(v * 100, 1)


def iso_text(ts) -> Column:
    """ISO-8601 text of a naive timestamp like Python's ``isoformat()``:
    six fraction digits, none when the microseconds are zero."""
    t = _c(ts)
    frac = F.date_format(t, "SSSSSS")
    base = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(frac == "000000", base).otherwise(F.concat(base, F.lit("."), frac))


#: Names of the bands, best first.
SCORE_BANDS = ("good", "ok", "bad")


def score_band(x) -> Column:
    """Band of a 0..1 score; NULL stays NULL."""
    v = _c(x)
    good, ok, bad = SCORE_BANDS
    return F.when(v >= BAND_GOOD, good).when(v >= BAND_OK, ok).when(v.isNotNull(), bad)


def badge_class(score100) -> Column:
    """Class of a 0..100 score."""
    v = _c(score100)
    return F.when(v >= BADGE_EXCELLENT, "excellent").when(v >= BADGE_GOOD, "good").otherwise("poor")


def badge_text(score100) -> Column:
    """Display text of a 0..100 score."""
    v = _c(score100)
    return (F.when(v >= BADGE_EXCELLENT, BADGE_TEXT["excellent"])
            .when(v >= BADGE_GOOD, BADGE_TEXT["good"]).otherwise(BADGE_TEXT["poor"]))


def status_mark(error_message) -> Column:
    """X11: ok mark when there is no error text."""
    return F.when(_c(error_message).isNull(), STATUS_OK_MARK).otherwise(STATUS_FAIL_MARK)


def category_score(body_struct, name: str) -> Column:
    """``categories[name].score`` of a parsed response; NULL if absent."""
    return F.try_element_at(_c(body_struct).getField("lighthouseResult").getField("categories"),
                        F.lit(name)).getField("score").try_cast("double")


def audit_value(body_struct, name: str) -> Column:
    """``audits[name].numericValue`` of a parsed response; NULL if absent."""
    return F.try_element_at(_c(body_struct).getField("lighthouseResult").getField("audits"),
                        F.lit(name)).getField("numericValue").try_cast("double")


def as_time(t) -> Column:
    """A point in time given as a Column, a datetime or ISO text."""
    if isinstance(t, Column):
        return t
    if isinstance(t, _dt.datetime):
        # wall-clock text: independent of the session and process time zones
        return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(str(t)).cast("timestamp_ntz")


def minus_hours(t, hours: float) -> Column:
    """Time arithmetic with an interval, ``as_of`` given by the caller."""
    return as_time(t) - F.expr(f"INTERVAL {int(round(hours * 3600))} SECONDS")


def minus_days(t, days: float) -> Column:
    return minus_hours(t, days * 24)
