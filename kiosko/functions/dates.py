"""Dates in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kiosko.functions.dictionaries import MONTHS

# The layouts of dates, in the order in which they are tried.
LAYOUTS = (
    "yyyy-M-d", "yyyy/M/d", "yyyy M d", "d-M-yyyy", "d/M/yyyy", "d.M.yyyy", "d-M-yy", "d/M/yy", "d M yyyy", "d M yy",
)


def parse_date(text: Column) -> Column:
    """The date by the first layout that fits and gives a year of at least 1900; else null."""
    tries = []
    plain = F.trim(text)
    for layout in LAYOUTS:
        shape = "^" + "".join({"yyyy": "[0-9]{4}", "yy": "[0-9]{2}", "M": "[0-9]{1,2}", "d": "[0-9]{1,2}"}.get(x, "[.]" if x == "." else x) for x in _parts(layout)) + "$"
        day = F.try_to_date(F.when(plain.rlike(shape), plain), layout)
        tries.append(F.when(F.year(day) >= 1900, day))
    return F.coalesce(*tries)


def _parts(layout: str) -> list[str]:
    out = [layout[0]]
    for c in layout[1:]:
        if c == out[-1][0]:
            out[-1] += c
        else:
            out.append(c)
    return out


def month_number(name: Column) -> Column:
    """1 to 12 of a Spanish month name; else null."""
    return F.try_element_at(F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS, 1) for x in (m, i)]), F.lower(F.trim(name)))


def spanish_date(text: Column) -> Column:
    """The first date like "5 de marzo de 2026" or "5 marzo, 2026" in a text."""
    shape = "(?i)([0-9]{1,2})(?: de)? (" + "|".join(MONTHS) + "),?(?: de(?:l)?)? ([0-9]{4})"
    day, month, year = (F.regexp_extract(text, shape, i) for i in (1, 2, 3))
    date = F.try_to_date(F.concat_ws("-", year, month_number(month).cast("string"), day), "yyyy-M-d")
    return F.when(day != "", date)


def month_label(date: Column) -> Column:
    """Like "5 de marzo"."""
    names = F.array(*[F.lit(m) for m in MONTHS])
    return F.concat(F.dayofmonth(date).cast("string"), F.lit(" de "), F.element_at(names, F.month(date)))


def week_start(date: Column) -> Column:
    """The Sunday on or before a date."""
    return F.date_sub(date, F.dayofweek(date) - 1)


def url_date(url: Column) -> Column:
    """The date in a URL: /2026/2/22, 2026-02-22, 22-2-2026 or 20260222, the first of these that there is."""
    found = (
        (r"/([0-9]{4}/[0-9]{1,2}/[0-9]{1,2})", "yyyy/M/d"),
        (r"([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})", "yyyy-M-d"),
        (r"([0-9]{1,2}-[0-9]{1,2}-[0-9]{4})", "d-M-yyyy"),
        (r"([0-9]{8})", "yyyyMMdd"),
    )
    parts = [F.regexp_extract(url, shape, 1) for shape, _ in found]
    return F.coalesce(*[F.try_to_date(F.when(p != "", p), layout) for p, (_, layout) in zip(parts, found, strict=True)])
