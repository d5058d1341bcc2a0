"""Problem 1: aggregates by event time that late records correct, with a cut-off for lateness.

Records are combined to one partial aggregate for each (key, arrival period, event period) before anything else, so
what follows is bounded by the periods, not by the records.  The *mark* of an arrival period is the latest event period
among the records of earlier arrival periods, without those whose event lies after their own arrival.  Event time is
parted into shards of ``SHARD`` periods; in each, a finger B-tree takes the partials in order of arrival.  It is told the
mark of each arrival period, evicts the subtrees that the cut-off has passed, and answers each insert with the state of
the period: newest, open (before the mark: the insert corrects it, ``corrige``) or closed (more than ``lateness`` periods
before the mark: the insert is left out, ``excluida``).

Defined results: records with null event or arrival are left out; null values count as records without a value;
repeated rows count each, unless the caller removes them; an empty input gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from kiosko.plans.common import joined, written
from kiosko.streaming.fingertree import CLOSED, OPEN, FingerTree

LATENESS = 10
#: Periods of event time that one tree holds at most.
SHARD = 366
#: Seconds of a period.
PERIODS = {"minute": 60, "hour": 3600, "day": 86_400}
#: Partials that a task of the stream holds before it hands them on.
HELD = 200_000


def _number(col: Column, period: str) -> Column:
    """The number of the period in which a date or time lies."""
    if period == "day":
        return F.unix_date(col.cast("date")).cast("bigint")
    return F.floor(F.unix_micros(col.cast("timestamp")) / F.lit(PERIODS[period] * 1_000_000)).cast("bigint")


def _period(col: Column, period: str) -> Column:
    """The date, or the first moment, of a period by its number."""
    if period == "day":
        return F.date_from_unix_date(col.cast("int"))
    return F.timestamp_seconds(col * F.lit(PERIODS[period]))


def _partials(df: DataFrame, event: str, arrival: str, keys: list[str], value: str | None, period: str) -> DataFrame:
    """(keys..., _a, _e, _n, _s, _lo, _hi)"""
    v = F.col(value).cast("double") if value else F.lit(None).cast("double")
    own = df.select(*keys, _number(F.col(arrival), period).alias("_a"), _number(F.col(event), period).alias("_e"), v.alias("_v"))
    own = own.where("_a is not null and _e is not null")
    return own.groupBy(*keys, "_a", "_e").agg(F.count("*").alias("_n"), F.sum("_v").alias("_s"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))


def with_marks(partials: DataFrame, keys: list[str]) -> DataFrame:
    """With ``_m``, the mark of the arrival period, null in the first ones."""
    by_day = partials.groupBy(*keys, "_a").agg(F.max(F.when(F.col("_e") <= F.col("_a"), F.col("_e"))).alias("_top"))
    before = Window.partitionBy(*keys).orderBy("_a").rowsBetween(Window.unboundedPreceding, -1)  # one row a period
    marks = by_day.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_a").alias("_d"), F.max("_top").over(before).alias("_m"))
    same = F.col("_a") == F.col("_d")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return partials.join(marks, same).drop("_d", *[f"_k{i}" for i in range(len(keys))])


def _float(x) -> float | None:
    return None if pd.isna(x) else float(x)


def corrections(
    df: DataFrame, event: str, arrival: str, keys: list[str] | None = None, value: str | None = None, lateness: int = LATENESS, period: str = "day"
) -> DataFrame:
    """(keys..., llegada, fecha, n, efecto, antes, despues, suma, minimo, maximo): every partial in order of arrival.

    ``efecto`` is ``en_plazo`` (not late), ``adelantada`` (event after arrival), ``corrige`` or ``excluida``; ``antes``
    and ``despues`` are the period's count before and after, ``suma``, ``minimo``, ``maximo`` its values after.
    ``period`` is one of ``PERIODS``, ``lateness`` counts periods; ``llegada`` and ``fecha`` are dates for days, else the
    first moment of the period.
    """
    keys = keys or []
    partials = with_marks(_partials(df, event, arrival, keys, value, period), keys).withColumn("_shard", F.floor(F.col("_e") / SHARD))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "llegada bigint, fecha bigint, n bigint, efecto string, antes bigint, despues bigint, suma double, minimo double, maximo double"])

    def run(f: pd.DataFrame) -> pd.DataFrame:
        tree, out = FingerTree(), []
        for r in f.sort_values(["_a", "_e"]).itertuples(index=False):
            values = dict(zip(f.columns, r, strict=True))
            if not pd.isna(values["_m"]):
                tree.advance(int(values["_m"]), lateness)
            e, a, n = int(values["_e"]), int(values["_a"]), int(values["_n"])
            state, before, after = tree.offer(e, (n, _float(values["_s"]), _float(values["_lo"]), _float(values["_hi"])))
            effect = "excluida" if state == CLOSED else "adelantada" if e > a else "corrige" if state == OPEN else "en_plazo"
            out.append((*(values[k] for k in keys), a, e, n, effect, before[0], after[0], *after[1:]))
        return pd.DataFrame(out, columns=[*keys, "llegada", "fecha", "n", "efecto", "antes", "despues", "suma", "minimo", "maximo"])

    log = partials.groupBy(*keys, "_shard").applyInPandas(run, schema)
    return log.withColumns({c: _period(F.col(c), period) for c in ("llegada", "fecha")})


def aggregates(log: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys..., fecha, total, en_plazo, corrigen, excluidas): the corrected count of each period, from ``corrections``."""
    part = lambda *kinds: F.sum(F.when(F.col("efecto").isin(*kinds), F.col("n")).otherwise(0))
    return log.groupBy(*(keys or []), "fecha").agg(
        F.max("despues").alias("total"), part("en_plazo", "adelantada").alias("en_plazo"), part("corrige").alias("corrigen"), part("excluida").alias("excluidas")
    )


def arrivals(noticias: DataFrame) -> DataFrame:
    """(id, fecha, llegada) of each article: the day it was first seen.  Articles without an id are left out."""
    day = F.coalesce("fecha_scraping", F.to_date("created_at"))
    return noticias.where("id is not null").groupBy("id").agg(F.min("fecha").alias("fecha"), F.min(day).alias("llegada"))


def late_articles(noticias: DataFrame, lateness: int = LATENESS) -> DataFrame:
    """(id, efecto) of the late articles: the states with which the trees answered their (arrival, event) partials, joined
    back.  There are as many partials as pairs of days; a pair with very many articles is taken apart as a hot key."""
    own = arrivals(noticias)
    effects = written(corrections(own, "fecha", "llegada", lateness=lateness).where("efecto in ('corrige', 'excluida')").select("llegada", "fecha", "n", "efecto"))
    return joined(own, effects, ["llegada", "fecha"], "n").select("id", "efecto")


def _combined(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (k, a, e, n, s, lo, hi) combined by (k, a, e)."""
    held: list[pd.DataFrame] = []

    def together() -> pd.DataFrame:
        by = pd.concat(held).groupby(["k", "a", "e"], as_index=False, sort=False)
        return by.agg(n=("n", "sum"), s=("s", lambda x: x.sum(min_count=1)), lo=("lo", "min"), hi=("hi", "max"))

    for f in frames:
        if len(f):
            held.append(f)
            if sum(map(len, held)) > HELD:
                held = [together()]
                if len(held[0]) > HELD // 2:
                    yield held[0]
                    held = []
    if held:
        yield together()


def corrected_stream(stream: DataFrame, event: str, arrival: Column, key: str, value: str | None = None, lateness: int = LATENESS, period: str = "day") -> DataFrame:
    """The same on a stream, in update mode: (key, fecha, n, suma, cerrada) of each period that a micro-batch changed or
    closed; the last row of a period is its aggregate.

    The rows of a micro-batch are combined by (key, arrival, event) before they are shuffled, then taken in order of
    arrival; the mark advances from one arrival period to the next, as in ``corrections``, so the result doesn't depend
    on how the rows fall into micro-batches.  A row of an earlier arrival period than one that a former micro-batch has
    brought counts as arriving in the latter.  The state of a key is the periods of its tree, bounded by the cut-off and
    the events after their arrival.  Records with null key, event or arrival are left out.
    """
    v = F.col(value).cast("double") if value else F.lit(None).cast("double")
    rows = stream.select(
        F.col(key).alias("k"), _number(arrival, period).alias("a"), _number(F.col(event), period).alias("e"), F.lit(1).cast("bigint").alias("n"), v.alias("s"), v.alias("lo"), v.alias("hi")
    ).where("k is not null and e is not null and a is not null")
    kind = stream.schema[key].dataType.simpleString()
    rows = rows.mapInPandas(_combined, f"k {kind}, a bigint, e bigint, n bigint, s double, lo double, hi double")

    def run(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark, now, top, periods = pickle.loads(state.get[0]) if state.exists else (None, None, None, [])
        tree = FingerTree(keep=False)
        for t, p in periods:
            tree.insert(t, p)
        tree.advance(mark, lateness)
        changed, closed = {}, {}
        batch = pd.concat(list(frames)).groupby(["a", "e"], as_index=False).agg(n=("n", "sum"), s=("s", lambda x: x.sum(min_count=1)), lo=("lo", "min"), hi=("hi", "max"))
        for r in batch.itertuples(index=False):  # in order of arrival
            if now is None or r.a > now:
                now = int(r.a)
                closed.update(tree.advance(top, lateness))
            e = int(r.e)
            answer, _, after = tree.offer(e, (int(r.n), _float(r.s), _float(r.lo), _float(r.hi)))
            if answer != CLOSED:
                changed[e] = after
            if e <= r.a and (top is None or e > top):
                top = e
        state.update((pickle.dumps((tree.mark, now, top, tree.periods())),))
        out = [(k[0], e, p[0], p[1], e in closed) for e, p in sorted({**changed, **closed}.items())]
        yield pd.DataFrame(out, columns=["key", "fecha", "n", "suma", "cerrada"])

    out = rows.groupBy("k").applyInPandasWithState(run, f"key {kind}, fecha bigint, n bigint, suma double, cerrada boolean", "tree binary", "update", GroupStateTimeout.NoTimeout)
    return out.withColumn("fecha", _period(F.col("fecha"), period))
