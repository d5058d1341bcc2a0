import datetime

from pyspark.sql import functions as F

from kiosko.functions import dates
from kiosko.functions import dictionaries as D
from kiosko.functions import text as X
from kiosko.functions.stem import stem
from kiosko.operators import titles as O

# invented titles
NEWS = [
    ("n1", "2024-03-01", "emol", "Gabriel Boric anuncia reforma de pensiones en Estados Unidos"),
    ("n2", "2024-03-01", "emol", "Boric y Kast debaten: criminales, migrantes y protestas"),
    ("n3", "2024-03-01", "biobio", "Alerta roja por incendios forestales en la Región del Bío–Bío"),
    ("n4", "2024-03-02", "biobio", "José Antonio Kast visita el Banco Central &quot;hoy&quot; 2024"),
    ("n5", "2024-03-02", "latercera", ""),
    ("n6", "2024-03-04", "latercera", "Nueva Zelanda y la Universidad de Chile firman acuerdo"),
    ("n7", "2024-03-04", "emol", "Carabineros de Chile: Xi Jinping llega a San Antonio"),
]
TERMS = {
    "n1": "Gabriel Boric|reforma|pensiones|Estados Unidos",
    "n2": "Gabriel Boric|José Antonio Kast|debaten|crimen|migración|protesta",
    "n3": "alerta|roja|incendios|forestales|región|Bío Bío",
    "n4": "José Antonio Kast|visita|Banco Central|hoy",
    "n6": "zelanda|Universidad de Chile|firman|acuerdo",
    "n7": "Carabineros de Chile|jinping|llega|San Antonio",
}


def news(spark):
    return spark.createDataFrame(NEWS, "id string, fecha string, fuente string, titulo string").withColumn("fecha", F.to_date("fecha"))


def test_terms_and_metrics(spark):
    own = news(spark)
    rows = O.with_title(own).select("id", F.array_join(X.title_terms(F.col("titulo")), "|").alias("t")).collect()
    assert {r.id: r.t for r in rows} == TERMS
    metrics = {r.fecha.day: (r.total_noticias, r.terminos_unicos) for r in O.daily_metrics(own, O.article_terms(own)).collect()}
    assert metrics == {1: (3, 15), 2: (2, 4), 4: (2, 8)}


def test_daily_equals_sum_by_source_and_both_fusions_agree(spark):
    own = news(spark)
    day = {(r.fecha, r.termino): r.frecuencia for r in O.term_counts(O.article_terms(own), "fecha").collect()}
    by = {}
    for r in O.term_counts(O.article_terms(own), "fecha", "fuente").collect():
        by[r.fecha, r.termino] = by.get((r.fecha, r.termino), 0) + r.frecuencia
    assert day == by
    ngrams = spark.createDataFrame([("incendios forestales", 9, 2), ("antonio kast", 8, 2), ("gabriel boric", 7, 2), ("raro caso", 1, 2), (None, 50, 2)], "ngrama string, n int, tipo int")
    dynamic = O.dynamic_compounds(ngrams, 5)
    labels = {r.patron: r.etiqueta for r in dynamic.collect()}
    assert labels == {"incendios forestales": "incendio forestal", "incendio forestal": "incendio forestal", "gabriel boric": "gabriel boric"}
    found = [sorted((r.id, r.termino) for r in O.article_terms(own, dynamic, most=most).collect()) for most in (200_000, 0)]
    assert found[0] == found[1]  # by a broadcast dictionary and by a join
    assert ("n3", "incendio forestal") in found[0] and ("n1", "Gabriel Boric") in found[0]
    assert O.article_terms(own.limit(0), dynamic, most=0).count() == 0


def test_ngrams(spark):
    grams = {}
    for r in O.article_ngrams(news(spark)).collect():
        grams.setdefault((r.id, r.tipo), set()).add(r.ngrama)
    assert grams["n1", 2] == {"gabriel boric", "estados unidos"}
    assert grams["n2", 3] == {"kast debaten criminales", "debaten criminales migrantes"}
    assert grams["n4", 2] == {"josé antonio", "antonio kast", "kast visita", "banco central", "central hoy"}
    assert grams["n6", 3] == {"chile firman acuerdo"} and ("n7", 3) not in grams


def test_pairs(spark):
    rows = O.pair_counts(news(spark), "id").collect()
    n = {}
    for r in rows:
        assert r.termino_a < r.termino_b
        n[r.id] = n.get(r.id, 0) + r.n
    assert n == {"n1": 6, "n2": 15, "n3": 15, "n4": 6, "n6": 6, "n7": 10}


def test_singular(spark):
    words = "luces veces incendios forestales presidentes crisis gas tres".split()
    df = spark.createDataFrame([(w,) for w in words], "w string").select(X.singular(F.col("w")).alias("s"))
    assert [r.s for r in df.collect()] == "luz vez incendio forestal president crisi gas tre".split()


def test_stems():
    # of the published sample vocabulary
    pairs = """chicas chic chicharrones chicharron chico chic cheque chequ torear tor torres torr torpeza torpez tórax torax
        lentamente lent diciéndolo dic constituyendo constitu pague pag evidencia evident actividad activ comunicaciones comun""".split()
    assert [stem(w) for w in pairs[::2]] == pairs[1::2]
    assert [stem(w) for w in ("", "y", "de", "sol")] == ["", "y", "de", "sol"]


def test_fusion_never_adds_tokens():
    index = D.first_words(D.compounds())
    assert D.fuse("san antonio kast josé antonio kast".split(), index) == ["San Antonio", "kast", "José Antonio Kast"]
    assert D.fuse([], index) == []


def test_dates(spark):
    cases = {
        "2026-04-01": "2026-04-01", "2026/04/01": "2026-04-01", "2026 4 1": "2026-04-01", "01-04-2026": "2026-04-01", "01/04/2026": "2026-04-01",
        "14.4.2025": "2025-04-14", "31-03-20": "2020-03-31", "5 3 2026": "2026-03-05", "5 3 26": "2026-03-05", "garbage": None, "2026-13-45": None,
    }
    df = spark.createDataFrame(list(cases.items()), "x string, y string")
    for r in df.select("x", "y", dates.parse_date(F.col("x")).cast("string").alias("z")).collect():
        assert r.y == r.z, r.x
    one = spark.range(1).select(
        dates.spanish_date(F.lit("Lunes 5 de marzo de 2026, 10:00")).alias("a"), dates.month_number(F.lit("Mayo")).alias("b"), dates.week_start(F.lit(datetime.date(2026, 3, 5))).alias("c"),
        dates.url_date(F.lit("https://x/2026/3/5/nota")).alias("d"), dates.url_date(F.lit("https://x/nota")).alias("e"),
    ).first()
    assert one == (datetime.date(2026, 3, 5), 5, datetime.date(2026, 3, 1), datetime.date(2026, 3, 5), None)


def test_clean_body(spark):
    r = spark.range(1).select(
        X.clean_body(F.lit("Hola {x: 1} mundo, 25 veces.\nFin #tag uno"), ["fin"]).alias("a"), X.clean_body(F.lit("  ")).alias("b"), X.light_clean(F.lit("dfp: a\n\n b")).alias("c"), X.nfc(F.lit("café")).alias("d")
    ).first()
    assert (r.a, r.b, r.c, r.d) == ("hola mundo veces", None, "a b", "café")
