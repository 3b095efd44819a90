"""Column expressions shared by all operators. Everything stays in codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

# Fixed values -----------------------------------------------------------------
# Texts that a raw file uses for "no value"; compared trimmed, in lower case.
NULL_TOKENS = ["", "n/a", "na", "null", "none", "nan", "#n/a", "nat", "<na>"]

# Date formats of the raw files, tried in this order; the first that fits wins.
# Single-letter fields accept one or two digits.
DATE_FORMATS = [
    "yyyy-M-d H:m:s",
    "yyyy-M-d H:m",
    "yyyy-M-d",
    "yyyy/M/d",
    "d/M/yyyy",
    "M-d-yyyy",
    "d-M-yyyy H:m",
    "d-M-yyyy",
]

EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
CONTACT_PLACEHOLDERS = ["n/a", "na", "null", "none", "unknown", ""]
WHITESPACE = " \t\n\r\x0b\x0c"
PHONE_MIN_DIGITS = 10

WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# (first hour, label) of each part of the day; hours before 6 are night too.
DAY_PARTS = [(6, "morning"), (12, "afternoon"), (17, "evening"), (21, "night")]
# End of fixed values ----------------------------------------------------------

MICROS_PER_DAY = 86_400_000_000
# The three formats that start with a year and a dash, as one pattern.
DASHED_DATE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}( [0-9]{1,2}:[0-9]{1,2}(:[0-9]{1,2})?)?$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing whitespace of any kind, not only blanks."""
    return F.btrim(col(c).cast("string"), F.lit(WHITESPACE))


# -- nulls ----------------------------------------------------------------------
def null_tokens_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Turn the placeholder texts of raw files into real nulls (string columns only)."""
    wanted = set(columns) if columns is not None else None
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType) and (wanted is None or field.name in wanted):
            c = F.when(~F.lower(strip(c)).isin(NULL_TOKENS), c)
        out.append(c.alias(field.name))
    return df.select(*out)


def total(c: Column | str) -> Column:
    """Sum that is 0 for an empty or all-null group."""
    return F.coalesce(F.sum(col(c)).cast("double"), F.lit(0.0))


def mean(c: Column | str) -> Column:
    """Mean as sum / count, so decimal money is summed exactly and divided once."""
    c = col(c)
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


def sample_std(c: Column | str) -> Column:
    """Sample standard deviation; null for fewer than two values."""
    return F.stddev_samp(col(c).cast("double"))


def at_least(c: Column | str, floor: float = 1.0) -> Column:
    return F.greatest(col(c).cast("double"), F.lit(float(floor)))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """numerator / max(denominator, 1): the guard that all feature ratios use."""
    return col(numerator).cast("double") / at_least(denominator)


# -- time -------------------------------------------------------------------------
def as_ntz(value) -> Column:
    """A zone-less timestamp from a column, a date string or a datetime."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole days, rounded towards minus infinity (-0.4 days is -1)."""
    micros = F.timestamp_diff("MICROSECOND", col(earlier), col(later))
    return F.floor(micros / F.lit(MICROS_PER_DAY)).cast("long")


def shift_days(ts: Column, days: int) -> Column:
    return ts + F.expr(f"INTERVAL '{int(days)}' DAY")


def lenient_timestamp(c: Column | str) -> Column:
    """Cast that yields null for text which is no timestamp."""
    return col(c).try_cast("timestamp_ntz")


def strict_timestamp(c: Column | str) -> Column:
    """Cast that fails the job for text which is no timestamp (ANSI mode)."""
    return col(c).cast("timestamp_ntz")


def parse_date(c: Column | str) -> Column:
    """First of the known formats that fits the whole trimmed text, else null.

    The year-month-day formats with dashes come first and are the common case. A
    guarded cast reads them about twice as fast as a format pattern does.
    """
    text = strip(c)
    dashed = F.when(text.rlike(DASHED_DATE), text.try_cast("timestamp_ntz"))
    others = [F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS if not f.startswith("yyyy-")]
    return F.coalesce(dashed, F.coalesce(*others).cast("timestamp_ntz"))


def day_text(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd")


def timestamp_text(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd HH:mm:ss")


def is_weekend(ts: Column | str) -> Column:
    return F.weekday(col(ts)) >= 5


def weekday_name(number: Column | str) -> Column:
    """0 = Monday ... 6 = Sunday; null outside."""
    names = F.array(*[F.lit(n) for n in WEEKDAYS])
    return F.get(names, col(number).cast("int"))


def day_part(hour: Column | str) -> Column:
    hour = col(hour)
    out = F.when(hour < DAY_PARTS[0][0], "night")
    for (_, label), (upper, _) in zip(DAY_PARTS, DAY_PARTS[1:]):
        out = out.when(hour < upper, label)
    return out.when(hour.isNotNull(), DAY_PARTS[-1][1])


# -- text -------------------------------------------------------------------------
def title_case(c: Column | str) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the others."""
    runs = F.regexp_extract_all(F.lower(col(c)), F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    capital = F.transform(
        runs, lambda r: F.concat(F.upper(r.substr(1, 1)), r.substr(F.lit(2), F.length(r)))
    )
    return F.array_join(capital, "")


def valid_email(c: Column | str) -> Column:
    text = strip(c)
    placeholder = F.lower(text).isin(CONTACT_PLACEHOLDERS)
    return F.coalesce(~placeholder & text.rlike(EMAIL_PATTERN), F.lit(False))


def valid_phone(c: Column | str) -> Column:
    digits = F.regexp_replace(col(c).cast("string"), r"[^0-9]", "")
    return F.coalesce(F.length(digits) >= PHONE_MIN_DIGITS, F.lit(False))


def pad_id(prefix: str, number: Column | str, width: int) -> Column:
    """Prefix plus zero-padded number, e.g. C00042; longer numbers are kept whole."""
    text = col(number).cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0")))


# -- numbers ------------------------------------------------------------------------
def round_even(c: Column | str, digits: int = 2) -> Column:
    """Scale, round half to even, scale back (the rule of array libraries)."""
    scale = float(10**digits)
    return F.rint(col(c).cast("double") * scale) / scale


def clip(c: Column | str, low: float | Column | None = None, high: float | Column | None = None) -> Column:
    c = col(c)
    if low is not None:
        c = F.when(c.isNotNull(), F.greatest(c, F.lit(low)))
    if high is not None:
        c = F.when(c.isNotNull(), F.least(c, F.lit(high)))
    return c
