import datetime
import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kiosko.streaming import late
from kiosko.streaming.fingertree import NONE, FingerTree, combined

DAY0 = datetime.date(2026, 1, 1)


def day(n):
    return DAY0 + datetime.timedelta(days=n)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.tuples(st.just("put"), st.integers(0, 60), st.integers(1, 9)), st.tuples(st.just("cut"), st.integers(0, 60), st.just(0))), max_size=120))
def test_tree_like_a_dictionary(steps):
    tree, want = FingerTree(), {}
    for kind, t, v in steps:
        if kind == "put":
            part = (1, float(v), float(v), float(v))
            before, after = tree.insert(t, part)
            assert before == want.get(t, NONE)
            want[t] = combined(want.get(t, NONE), part)
            assert after == want[t]
        else:
            assert list(tree.evict(t)) == sorted((k, p) for k, p in want.items() if k < t)
            want = {k: p for k, p in want.items() if k >= t}
        assert tree.periods() == sorted(want.items())
        assert tree.total()[0] == sum(p[0] for p in want.values())
        assert tree.total(10, 40)[0] == sum(p[0] for k, p in want.items() if 10 <= k <= 40)


def brute(rows, lateness=10):
    """Effects of (arrival, event) rows, one by one."""
    effects, closed = [], Counter()
    for a, e in rows:
        marks = [y for x, y in rows if x < a and y <= x]
        mark = max(marks) if marks else None
        if mark is not None and e < mark - datetime.timedelta(days=lateness):
            effects.append("excluida")
        else:
            effects.append("adelantada" if e > a else "corrige" if mark is not None and e < mark else "en_plazo")
            closed[e] += 1
    return effects, closed


def test_against_brute_force_with_a_hot_day(spark):
    rng = random.Random(3)
    rows = [(day(rng.randint(0, 60)), None) for _ in range(400)]
    rows = [(a, a - datetime.timedelta(days=int(rng.expovariate(0.2)) - (rng.random() < 0.05) * 30)) for a, _ in rows] + [(day(30), day(30))] * 200
    effects, closed = brute(rows)
    df = spark.createDataFrame([(a, e, 1.0, "x") for a, e in rows], "a date, e date, v double, fecha string")
    log = late.corrections(df, "e", "a", value="v").collect()
    assert Counter({k: n for k, n in Counter(effects).items()}) == Counter({k: sum(r.n for r in log if r.efecto == k) for k in {r.efecto for r in log}})
    got = {r.fecha: r.total for r in late.aggregates(late.corrections(df, "e", "a")).collect()}
    assert {k: v for k, v in got.items() if v} == dict(closed)


def test_keys_nulls_and_empty_input(spark):
    rows = [("a", day(5), day(5)), ("a", day(6), day(4)), (None, day(6), day(1)), ("b", None, day(1)), ("b", day(2), None), ("b", day(9), day(9))]
    df = spark.createDataFrame(rows, "k string, a date, e date")
    log = {(r.k, r.fecha): r.efecto for r in late.corrections(df, "e", "a", keys=["k"]).collect()}
    assert log == {("a", day(5)): "en_plazo", ("a", day(4)): "corrige", (None, day(1)): "en_plazo", ("b", day(9)): "en_plazo"}
    assert late.corrections(df.limit(0), "e", "a").count() == 0


def test_late_articles(spark):
    ts = lambda n: datetime.datetime.combine(day(n), datetime.time(3))
    rows = [
        ("a", day(1), day(1), ts(1)), ("b", day(30), day(30), ts(30)), ("c", day(31), None, ts(31)), ("c", day(31), None, ts(40)),
        ("late", day(22), day(31), ts(31)), ("old", day(5), None, ts(32)), ("future", day(90), day(31), ts(31)), ("edge", day(21), day(33), ts(33)), (None, day(1), day(33), ts(33)),
    ]
    df = spark.createDataFrame(rows, "id string, fecha date, fecha_scraping date, created_at timestamp")
    assert {(r.id, r.efecto) for r in late.late_articles(df).collect()} == {("late", "corrige"), ("old", "excluida"), ("edge", "corrige")}
    assert late.late_articles(df.limit(0)).count() == 0


def streamed(spark, folder, batches, **how):
    """The last row of each (key, period) after all micro-batches."""
    schema = "k string, e date, a date, v double"
    last, seen = {}, []

    def sink(df, _):
        for r in df.collect():
            last[r.key, r.fecha] = (r.n, r.suma)
            seen.append((r.key, r.fecha, r.n, r.cerrada))

    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        out = late.corrected_stream(stream, "e", F.col("a"), "k", "v", **how)
        out.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/ck").foreachBatch(sink).trigger(availableNow=True).start().awaitTermination()
    return last, seen


def test_stream_closes_periods(spark, tmp_path):
    batches = [[("x", day(0), day(0), 1.0), ("x", day(20), day(20), 2.0)], [("x", day(15), day(21), 4.0), ("x", day(2), day(21), 9.0), (None, day(1), day(1), 0.0)]]
    last, seen = streamed(spark, tmp_path, batches)
    assert last == {("x", day(0)): (1, 1.0), ("x", day(20)): (1, 2.0), ("x", day(15)): (1, 4.0)}
    assert ("x", day(0), 1, True) in seen and ("x", day(15), 1, False) in seen


def test_stream_is_the_same_for_other_micro_batches(spark, tmp_path):
    rng = random.Random(11)
    rows = [("x", day(0), day(0), 1.0), ("x", day(30), day(30), 1.0), ("x", day(2), day(31), 1.0), ("x", day(2), day(32), 1.0)]
    for _ in range(150):
        a = rng.randint(0, 40)
        rows.append((rng.choice("xy"), day(a - int(rng.expovariate(0.15)) + 3 * (rng.random() < 0.05)), day(a), float(rng.randint(1, 5))))
    rows.sort(key=lambda r: r[2])
    df = spark.createDataFrame(rows, "k string, e date, a date, v double")
    want = {}
    for r in late.corrections(df, "e", "a", ["k"], "v").where("efecto <> 'excluida'").collect():
        want[r.k, r.fecha] = max(want.get((r.k, r.fecha), (0, 0.0)), (r.despues, r.suma))
    for i, cuts in enumerate(([len(rows)], [60, len(rows)], [20, 50, 51, 90, len(rows)])):
        batches = [rows[a:b] for a, b in zip([0, *cuts], cuts)]
        assert streamed(spark, tmp_path / str(i), batches)[0] == want


def test_hours(spark):
    hour = lambda n: datetime.datetime(2026, 1, 1) + datetime.timedelta(hours=n, minutes=n % 7)
    rows = [(hour(0), hour(0)), (hour(5), hour(5)), (hour(4), hour(6)), (hour(1), hour(6)), (hour(9), hour(6))]
    df = spark.createDataFrame(rows, "e timestamp, a timestamp")
    got = {r.fecha.hour: r.efecto for r in late.corrections(df, "e", "a", lateness=2, period="hour").collect()}
    assert got == {0: "en_plazo", 5: "en_plazo", 4: "corrige", 1: "excluida", 9: "adelantada"}


def test_a_hot_pair_of_days(spark, monkeypatch):
    from kiosko.plans import common

    rows = [(f"i{n}", day(30), day(30)) for n in range(5)] + [(f"h{n}", day(25), day(31)) for n in range(300)] + [(f"o{n}", day(n), day(31)) for n in range(10)]
    df = spark.createDataFrame(rows, "id string, fecha date, fecha_scraping date").withColumn("created_at", F.lit(None).cast("timestamp"))
    want = {tuple(r) for r in late.late_articles(df).collect()}
    assert len(want) == 310
    monkeypatch.setattr(common, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(common, "HOT_ROWS", 100)
    got = [tuple(r) for r in late.late_articles(df).collect()]
    assert set(got) == want and len(got) == 310
