"""Which table answers a question, and which SQL may be asked."""

from __future__ import annotations

import datetime
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


# Days up to which a range is shown by day and by month, days beyond which the monthly tables answer, the
# first day of the collection, the words that generated SQL must not hold, and its limit.
DAYS_BY_DAY, DAYS_BY_MONTH, DAYS_OF_DAILY = 62, 730, 180
FIRST_DAY = datetime.date(2018, 1, 1)
FORBIDDEN = "DROP|DELETE|INSERT|UPDATE|ALTER|CREATE|TRUNCATE|GRANT|REVOKE"
LIMIT = 30


def granularity(start: datetime.date, end: datetime.date) -> str:
    """day up to 62 days, month up to two years, else year."""
    days = (end - start).days
    return "day" if days <= DAYS_BY_DAY else "month" if days <= DAYS_BY_MONTH else "year"


def term_table(start: datetime.date, end: datetime.date, by_source: bool = False) -> str:
    """The monthly table for more than 180 days, else the daily one."""
    if (end - start).days > DAYS_OF_DAILY:
        return "mv_terminos_por_medio_mensuales" if by_source else "mv_terminos_mensuales"
    return "titulos_terminos_por_medio" if by_source else "titulos_terminos_diarios"


def clamped(start: datetime.date, end: datetime.date, last: datetime.date | None, today: datetime.date, floor: datetime.date = FIRST_DAY) -> tuple[datetime.date, datetime.date] | None:
    """The range within what there is up to the ``last`` day; None if nothing is left."""
    if last is None:
        return None
    lo, hi = max(start, floor), min(end, last, today)
    return (lo, hi) if lo <= hi else None


def guarded_column(answer: Column, limit: int = LIMIT) -> Column:
    """``guarded`` of a column."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: guarded(x, limit))

    return run(answer)


_FORBIDDEN = re.compile(f"(?i){FORBIDDEN}")


def guarded(answer: str | None, limit: int = LIMIT) -> str | None:
    """The SELECT in a generated answer, with a limit; None if there is none or a word that changes data occurs."""
    found = re.search(r"(?is)SELECT.+", re.sub("```sql|```", "", answer or "").strip())
    if not found or _FORBIDDEN.search(found[0]):
        return None
    return found[0] if re.search("(?i)LIMIT", found[0]) else f"{found[0]} LIMIT {limit}"
