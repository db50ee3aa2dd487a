"""Column expressions shared by the operators. All stay inside codegen."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(ts: Column) -> Column:
    return F.to_date(ts)


def day_of_week(ts: Column) -> Column:
    """0 = Sunday."""
    return F.dayofweek(ts) - 1


def days_between(start: Column, end: Column) -> Column:
    """Midnights crossed from start to end, not whole 24-hour spans."""
    return F.datediff(F.to_date(end), F.to_date(start))


def half_even(value: Column, digits: int = 2) -> Column:
    """Scale, round to the nearest even integer, scale back: pandas' rounding, on doubles."""
    scale = F.lit(10.0**digits)
    return F.rint(value.cast("double") * scale) / scale


def without_nan(value: Column) -> Column:
    """NaN compares greater than everything in Spark, so it becomes NULL early."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; NULL when the whole is 0 or NULL."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def percent_or_zero(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.coalesce(half_even(percent(part, whole), digits), F.lit(0.0))


def label_by_list(value: Column, groups: Mapping[str, Sequence[str]], otherwise: str) -> Column:
    """First group whose list holds the value."""
    expr = None
    for label, members in groups.items():
        hit = value.isin(*members)
        expr = F.when(hit, label) if expr is None else expr.when(hit, label)
    return F.lit(otherwise) if expr is None else expr.otherwise(otherwise)


def label_by_code(value: Column, names: Mapping[str, str], otherwise: str) -> Column:
    return label_by_list(value, {label: [code] for code, label in names.items()}, otherwise)


# -- text -------------------------------------------------------------------


def _capitalize_runs(text: Column, runs: str) -> Column:
    pieces = F.regexp_extract_all(text, F.lit(runs), F.lit(1))
    capital = F.transform(
        pieces, lambda p: F.concat(F.upper(F.left(p, F.lit(1))), F.lower(F.substr(p, F.lit(2))))
    )
    return F.array_join(capital, "")


def title_text(name: Column) -> Column:
    """Capital after every non-letter, as for metric names: ``unit_price2go`` -> ``Unit_Price2Go``."""
    return _capitalize_runs(name, r"(\p{L}+|\P{L}+)")


def heading_text(name: Column) -> Column:
    """Capital after blanks, hyphens and opening brackets only: ``event_type`` -> ``Event_type``."""
    return _capitalize_runs(name, r"([-\s({\[<]+|[^-\s({\[<]+)")


def metric_title(metric: Column) -> Column:
    return title_text(F.replace(metric, F.lit("_"), F.lit(" ")))


def money_text(value: Column) -> Column:
    """Magnitude with thousands commas and two decimals; NULL reads 0.00."""
    return F.coalesce(F.format_number(F.abs(value.cast("double")), 2), F.lit("0.00"))


def signed_text(value: Column) -> Column:
    return F.format_string("%+.1f", half_even(value.cast("double"), 1))


def number_text(value: Column, digits: int) -> Column:
    """At most ``digits`` decimals, at least one, never in exponent form."""
    fixed = half_even(value.cast("double"), digits).cast(f"decimal(38,{digits})").cast("string")
    return F.regexp_replace(fixed, r"(\.\d+?)0+$", "$1")


def plain_text(markdown: Column) -> Column:
    return F.replace(markdown, F.lit("*"), F.lit(""))


def subject_text(subject: Column) -> Column:
    return F.left(subject, F.lit(100))


# -- identifiers --------------------------------------------------------------


def safe_name(raw: str) -> str:
    """Lower-case identifier made of the ASCII letter/digit runs of ``raw``."""
    joined = "_".join(re.findall(r"[0-9a-zA-Z]+", raw)).lower() or "column"
    return "_" + joined if joined[0].isdigit() else joined


def safe_names(raw: Sequence[str]) -> dict[str, str]:
    """Rename map for a set of columns; two columns may not share a name."""
    mapping = {name: safe_name(name) for name in raw}
    taken: dict[str, str] = {}
    for name, safe in mapping.items():
        if safe in taken:
            raise ValueError(f"columns {taken[safe]!r} and {name!r} both become {safe!r}")
        taken[safe] = name
    return mapping


def safe_name_column(raw: Column) -> Column:
    """``safe_name`` for a column of names."""
    runs = F.regexp_extract_all(raw, F.lit(r"([0-9a-zA-Z]+)"), F.lit(1))
    joined = F.lower(F.array_join(runs, "_"))
    named = F.when(joined == "", F.lit("column")).otherwise(joined)
    return F.when(named.rlike(r"^\d"), F.concat(F.lit("_"), named)).otherwise(named)


# -- dates ----------------------------------------------------------------------

# Accepted date spellings, tried in this order after ISO 8601.
# Day-first forms are left out on purpose: mixing them with month-first would
# read one column two ways. Pass ``formats`` for such files.
DATE_FORMATS = (
    "yyyy/M/d",
    "yyyy/M/d H:mm",
    "yyyy/M/d H:mm:ss",
    "M/d/yyyy",
    "M/d/yyyy H:mm",
    "M/d/yyyy H:mm:ss",
    "yyyyMMdd",
    "d-MMM-yyyy",
    "d MMM yyyy",
    "MMM d, yyyy",
    "MMMM d, yyyy",
)
_ISO_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:.*)?$"


#: The same spellings where the day stands before the month.
DAY_FIRST_FORMATS = tuple("d/M" + f[3:] if f.startswith("M/d") else f for f in DATE_FORMATS) + (
    "d.M.yyyy",
    "d.M.yyyy H:mm",
    "d.M.yyyy H:mm:ss",
)


def format_shape(form: str) -> str | None:
    """A pattern that matches every text the format can read; None if it has other letters
    than those of dates and times. Reading is dear where it fails, so texts of another shape skip it."""
    shape, number = "", False
    for run in (m.group() for m in re.finditer(r"([A-Za-z])\1*|[^A-Za-z]", form)):
        if run[0] in "yMdHms" and not (run[0] == "M" and len(run) > 2):
            # numbers without anything between them are one run of digits
            shape += "" if number else r"[+-]?\d+"
            number = True
            continue
        number = False
        if run[0] == "M":
            shape += r"\p{L}+\.?"
        elif run.isalpha() or run == "'":
            return None
        else:
            shape += re.escape(run)
    return f"^{shape}$"


def lenient_timestamp(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Wall-clock time for any accepted spelling, else NULL. A zone in the text is ignored."""
    trimmed = F.trim(text)
    iso = F.when(trimmed.rlike(_ISO_SHAPE), trimmed.try_cast("timestamp_ntz"))
    others = []
    for f in formats:
        read, shape = F.try_to_timestamp(trimmed, F.lit(f)).cast("timestamp_ntz"), format_shape(f)
        others.append(read if shape is None else F.when(trimmed.rlike(shape), read))
    return F.coalesce(iso, *others)


def may_be_date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Whether a text has the shape of any accepted spelling."""
    trimmed, shapes = F.trim(text), [format_shape(f) for f in formats]
    if None in shapes:
        return text.isNotNull()
    return trimmed.rlike("|".join([_ISO_SHAPE, *shapes]))


def strict_date(text: str | dt.date) -> dt.date:
    """A ``YYYY-MM-DD`` argument as a date; anything else is an error."""
    if isinstance(text, dt.date):
        return text
    return dt.datetime.strptime(text, "%Y-%m-%d").date()
