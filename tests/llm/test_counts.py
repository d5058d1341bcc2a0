"""Frequencies, repeated lines and pairs against brute force, with hot values that hold a third of all rows."""

import datetime
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import pytest

from kiosko.llm import boilerplate, cooccurrence, frequency
from kiosko.plans import common

DAY = datetime.date(2026, 3, 1)


def days(n):
    return DAY + datetime.timedelta(days=n)


def test_frequencies_with_a_hot_value(spark):
    rng = random.Random(5)
    values = ["País", "pais", " país ", "paí́s".replace("í́", "í"), "Villa  Alta", "villa alta", "", "  ", None, "raro1", "raro2", *[f"t{i}" for i in range(40)]]
    rows = [(days(rng.randint(0, 9)), rng.choice("abc"), rng.choice(values), rng.randint(1, 3), "x") for _ in range(600)]
    rows += [(days(rng.randint(0, 9)), rng.choice("abc"), "caliente", i, "x") for i in range(300)]
    rows += rows[:50] + [(None, None, "nulo", None, None)] * 3
    df = spark.createDataFrame(rows, "fecha date, fuente string, termino string, frecuencia int, valor string")
    occ, rec = Counter(), defaultdict(set)
    for f, s, t, n, _ in set(rows):
        v = frequency.normal(t) if t is not None else ""
        if v:
            occ[v] += n or 0
            rec[v].add((f, s))
    for share in (1 / 500, 0.2, 2.0):  # all heavy, the hot one, none
        got = {r.valor: (r.ocurrencias, r.registros) for r in frequency.frequencies(df, "termino", "frecuencia", ["fecha", "fuente"], share).collect()}
        assert got == {v: (n, len(rec[v])) for v, n in occ.items()}
    marks = {(r.valor, r.raro, r.comun) for r in frequency.marked(df, "termino", "frecuencia", ["fecha", "fuente"]).collect()}
    total = sum(occ.values())
    assert marks == {(v, len(rec[v]) <= 2, occ[v] >= total * 0.005) for v in occ}
    grams = df.selectExpr("fecha", "termino as ngrama", "frecuencia as n", "fuente")
    assert frequency.marks(df, grams).count() == frequency.marks(df.repartition(7), grams).count() > 0
    assert frequency.marks(df.limit(0), grams.limit(0)).count() == 0


def norm(line):
    return re.sub(r"\d+", "0", " ".join(line.lower().split()))


@pytest.mark.parametrize("few", [500_000, 0])
def test_repeated_lines(spark, monkeypatch, few):
    monkeypatch.setattr(boilerplate, "BROADCAST_LINES", few)  # 0: lines meet by (source, hash), the hot ones apart
    monkeypatch.setattr(common, "HOT_ROWS", 20)
    rng = random.Random(2)
    rows = []
    for i in range(260):
        source = "grande" if i % 3 else rng.choice(["uno", "dos", None])
        body = [f"texto {i} de la nota {source}", rng.choice(["", "  "])]
        if i % 4 == 0:
            body.insert(0, rng.choice(["© Diario 2026 ", "© DIARIO   1999\r", "© diario 5"]))
        if i % 5 == 0:
            body += ["Lee también", "Lee  también"]
        if i % 90 == 0:
            body.append("casi repetida")
        rows.append((f"d{i}", source, rng.choice(["\n".join(body), "\n".join(body), "\n".join(body), None if i % 17 == 0 else "\n".join(body)]), "s", 1))
    rows += rows[:20] + [(None, "grande", "Lee también", "s", 1), ("vacio", "uno", " \n ", "s", 1)]
    df = spark.createDataFrame(rows, "id string, fuente string, cuerpo string, s string, n int")
    docs = {i: (s, b) for i, s, b, *_ in rows if i}
    total, have = Counter(), defaultdict(set)
    for i, (s, b) in docs.items():
        if b and b.strip():
            total[s] += 1
        for line in (b or "").split("\n"):
            if norm(line):
                have[s, norm(line)].add(i)
    bad = {k for k, ids in have.items() if len(ids) >= 4 and len(ids) >= 0.02 * total[k[0]]}
    want = {(i, n) for i, (s, b) in docs.items() if b for n, line in enumerate(b.split("\n"), 1) if (s, norm(line)) in bad}
    got = [tuple(r) for r in boilerplate.repeated_places(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want
    bodies = {(r.id, r.cuerpo) for r in boilerplate.without_repeated(df).collect()}
    assert bodies == {(i, None if b is None else "\n".join(x for x in b.split("\n") if (s, norm(x)) not in bad)) for i, (s, b) in docs.items()}
    report = {(r.fuente, r.linea): r.articulos for r in boilerplate.source_report(df).collect()}
    assert report == {k: len(have[k]) for k in bad}
    assert boilerplate.repeated_places(df.limit(0)).count() == 0 and boilerplate.without_repeated(df.limit(0)).count() == 0


@pytest.mark.parametrize("rows", [1, 200_000])
def test_pairs(spark, monkeypatch, rows):
    monkeypatch.setattr(cooccurrence, "BROADCAST_ROWS", rows)
    rng = random.Random(4)
    baskets = [sorted({f"w{min(rng.randint(0, 30), rng.randint(0, 30)):02d}" for _ in range(rng.randint(0, 9))}) for _ in range(400)]
    baskets += [["caliente", "w00"]] * 200 + [[f"x{i:04d}" for i in range(60)], [], None]
    df = spark.createDataFrame([(b, 1) for b in baskets], "items array<string>, a int").repartition(3)
    single, both = Counter(), Counter()
    for b in baskets:
        single.update(b or [])
        both.update(combinations(sorted(b or []), 2))
    for support in (1, 5):
        got = {(r.termino_a, r.termino_b): (r.n_a, r.n_b, r.n_ab) for r in cooccurrence.pair_counts(df, support=support).collect()}
        assert got == {(a, b): (single[a], single[b], n) for (a, b), n in both.items() if n >= support}
    assert cooccurrence.pair_counts(df.limit(0)).count() == 0


def test_products_of_long_rows(monkeypatch):
    import numpy as np

    monkeypatch.setattr(cooccurrence, "PRODUCTS", 50)
    rows = [list(range(0, 90, 3)), [], [5], [1, 2, 30]]
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    want = Counter(p for r in rows for p in combinations(r, 2))
    for blocks in (1, 8, 90):
        monkeypatch.setattr(cooccurrence, "BLOCKS", blocks)
        gram = cooccurrence.Gram(90)
        for _ in range(3):
            gram.add(row, np.array([x for r in rows for x in r], np.int64), len(rows))
        assert all(i <= j for i, j in gram.tiles)
        got = {(a, b): n for t in gram.taken() for a, b, n in zip(*(c.to_pylist() for c in t.columns), strict=True)}
        assert got == {p: 3 * n for p, n in want.items()}


def test_associated_titles(spark):
    titles = ["Robo de cobre en Lota"] * 6 + ["rоbo de ｃｏｂｒｅ en Lota"] * 2 + [f"Palabra{i} unica{i}" for i in range(300)] + ["", None]
    words = lambda i: "".join(chr(97 + int(c)) for c in str(i))
    rows = [(f"i{n}", t if t is None or "unica" not in t else f"nota {words(n)} sobre", 0) for n, t in enumerate(titles)]
    df = spark.createDataFrame(rows + rows[:5], "id string, titulo string, n_a int")
    assert {tuple(r) for r in cooccurrence.associated_pairs(df).collect()} == {("cobre", "lota"), ("cobre", "robo"), ("lota", "robo")}
    pair = cooccurrence.title_pairs(df).where("termino_a = 'cobre' and termino_b = 'robo'").first()
    assert (pair.n_a, pair.n_b, pair.n_ab, pair.n) == (8, 8, 8, 308) and abs(pair.elevacion - 38.5) < 1e-9 and abs(pair.npmi - 1) < 1e-9
    assert cooccurrence.associated_pairs(df.limit(0)).count() == 0
