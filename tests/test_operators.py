import datetime

import pytest
from pyspark.sql import functions as F

from kiosko.operators import dashboard as B
from kiosko.operators import network as N
from kiosko.operators import sentiment as S
from kiosko.plans import router
from kiosko.sources import ingest, tables
from kiosko.sources.vectors import VectorStore

D = datetime.date


def test_router_and_guard():
    assert [router.granularity(D(2024, 1, 1), D(2024, 1, 1) + datetime.timedelta(days=n)) for n in (62, 63, 731)] == ["day", "month", "year"]
    assert router.term_table(D(2024, 1, 1), D(2024, 7, 1)) == "mv_terminos_mensuales"
    assert router.term_table(D(2024, 1, 1), D(2024, 2, 1), True) == "titulos_terminos_por_medio"
    assert router.clamped(D(2010, 1, 1), D(2030, 1, 1), D(2026, 1, 1), D(2025, 1, 1)) == (D(2018, 1, 1), D(2025, 1, 1))
    assert router.clamped(D(2026, 1, 1), D(2026, 2, 1), D(2025, 1, 1), D(2025, 1, 1)) is None
    assert router.clamped(D(2026, 1, 1), D(2026, 2, 1), None, D(2025, 1, 1)) is None
    assert router.guarded("```sql\nSELECT 1```") == "SELECT 1 LIMIT 30"
    assert router.guarded("SELECT created_at FROM noticias") is None and router.guarded("DROP TABLE x") is None and router.guarded(None) is None
    assert [B.pages(n) for n in (0, 5, 6)] == [1, 1, 2]


def test_answers():
    assert S.parse_answer('{"1":"negativo","2":"neutral","3":"positivo"}', 3) == ["negativo", "neutral", "positivo"]
    assert S.parse_answer('x "1": "positivo"', 3) == ["positivo", "neutral", "neutral"]
    assert S.parse_answer("1. POSITIVO", 1) == ["positivo"]
    assert S.parse_answer("hola", 2) is None and S.parse_answer(None, 1) is None


def test_confidence(spark):
    df = spark.createDataFrame([(0.87, 87), (1.0, 100), (87.0, 87), (140.0, 100), (None, None)], "x double, y int")
    assert all(r.z == r.y for r in df.withColumn("z", S.confidence(F.col("x"))).collect())


def test_classifier_retries(spark):
    df = spark.createDataFrame([("a", "Robo y estafa en el centro"), ("b", "Inauguran una escuela"), ("c", "x"), ("d", None)], "id string, titulo string")
    got = {r.id: r.sentimiento for r in S.classify(df).collect()}
    assert got == {"a": "negativo", "b": "positivo"}

    def broken(_):
        raise OSError("down")

    assert {r.sentimiento for r in S.classify(df, broken).collect()} == {None}


def test_net_tone(spark):
    rows = [("positivo", D(2024, 1, 5))] * 3 + [("neutral", D(2024, 1, 5))] * 4 + [("negativo", D(2024, 1, 5))] + [("negativo", D(2024, 1, 2))]
    df = spark.createDataFrame(rows, "sentimiento string, fecha date")
    r = S.net_and_before(df, D(2024, 1, 4), D(2024, 1, 6)).first()
    assert (r.neto, r.neto_previo, r.delta, r.clase) == (25, -100, 125, "pos")
    empty = S.net_and_before(df.limit(0), D(2024, 1, 4), D(2024, 1, 6)).first()
    assert (empty.total, empty.neto, empty.neto_previo) == (0, 0, None)


def test_covered_months(spark):
    rows = [(D(2024, m, d),) for m in (1, 3, 4) for d in range(1, 4)] + [(D(2024, 5, 1),)]
    r = S.covered_months(spark.createDataFrame(rows, "fecha date"), 3).first()
    assert (r.desde, r.hasta, r.meses) == (D(2024, 3, 1), D(2024, 4, 3), 2)


def test_gaps(spark):
    rows = [("emol", D(2024, 3, 1)), ("emol", D(2024, 3, 4)), ("emol", D(2024, 3, 7)), ("uno", D(2024, 3, 2)), (None, D(2024, 3, 2)), ("x", None)]
    got = {r.fuente: tuple(r)[1:] for r in B.gaps(spark.createDataFrame(rows, "fuente string, fecha date")).collect()}
    assert got == {"emol": (2, D(2024, 3, 2), D(2024, 3, 3), D(2024, 3, 7)), "uno": (0, None, None, D(2024, 3, 2))}


def test_prefix_search_escapes(spark):
    df = spark.createDataFrame([("a%b", 1), ("axb", 5), ("A%", 1)], "termino string, frecuencia int")
    assert [r.termino for r in B.prefix_search(df, "a%").collect()] == ["A%", "a%b"]
    assert B.first_per_stem([("hospital", 3), ("hospitales", 2), ("casa", 1)]) == [("hospital", 3), ("casa", 1)]


def test_communities_and_clusters():
    two = [("a", "b"), ("b", "c"), ("a", "c"), ("x", "y"), ("y", "z"), ("x", "z"), ("c", "x")]
    m = N.louvain(two)
    assert m["a"] == m["b"] == m["c"] != m["x"] == m["y"] == m["z"]
    import numpy as np

    d = np.array([[0, 0.1, 0.9], [0.1, 0, 0.8], [0.9, 0.8, 0]])
    assert N.complete_linkage(d, 0.4) == [1, 1, 2]


def test_profiles(spark):
    pairs = spark.createDataFrame([("a", "c", 5), ("b", "c", 5), ("a", "d", 5), ("b", "d", 5), ("x", "y", 9), ("c", "d", 7)], "termino_a string, termino_b string, n int")
    edges = pairs.withColumnRenamed("n", "peso")
    like = N.profile_similarity(edges)
    assert {(r.termino_a, r.termino_b): r.similitud for r in like.collect()}["a", "b"] == 1.0
    assert ("a", "b") in {(r.termino_a, r.termino_b) for r in N.semantic_edges(like, edges, 0.9).collect()}
    assert ("c", "d") not in {(r.termino_a, r.termino_b) for r in N.semantic_edges(like, edges, 0.0).collect()}
    top = spark.createDataFrame([(t, n) for n, t in enumerate("abcdxy", 1)], "termino string, total bigint")
    merged = {r.terminos for r in N.clustered_top(N.with_profiles(top, pairs)).collect()}
    assert "y, x" in merged and not any({"x", "a"} <= set(m.split(", ")) for m in merged)


def test_similar_in_blocks(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [0.0, 1.0]), (3, [0.0, 0.0]), (4, None)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    for block in (1, 4096):
        assert {(r.a, r.b) for r in N.similar(df, df, 0.9, block).collect()} == {(0, 1), (1, 0)}


def test_prepared_batch(spark):
    rows = [
        ("Uno", "01-04-2026", "http://x/1", "emol", 1), ("Dos", "2026-04-02", "http://x/1", "emol", 2), ("Tres", "??", "http://x/2", "emol", 3),
        ("Cuatro", "2026/04/03", "", "emol", 4), (None, "2026/04/03", "http://x/3", "emol", 5), ("Seis", "3.4.2026", "http://x/1", "otra", 6),
    ]
    batch = spark.createDataFrame(rows, "titulo string, fecha string, url string, fuente string, orden int")
    got = {(r.titulo, r.fecha, r.fuente): r for r in ingest.prepared(batch, D(2026, 4, 5)).collect()}
    assert set(got) == {("Uno", D(2026, 4, 1), "emol"), ("Seis", D(2026, 4, 3), "otra")}
    import hashlib

    assert got["Uno", D(2026, 4, 1), "emol"].id == hashlib.md5(b"http://x/1_emol").hexdigest()
    with pytest.raises(ValueError, match="missing"):
        ingest.prepared(batch.drop("url"), D(2026, 4, 5))


def test_html():
    assert ingest.plain_text("<p>Uno &amp; dos</p><script>x</script><p>tres<br>cuatro</p>") == "Uno & dos\ntres\ncuatro"


def test_meta_in_either_order(spark):
    pages = [("<meta name='a.b' content='uno'>", "uno"), ('<META content="d\'os" property="a.b">', "d'os"), ("<meta name='axb' content='tres'>", None), ("", None), (None, None)]
    df = spark.createDataFrame(pages, "html string, want string").withColumn("got", ingest.attribute(F.col("html"), "a.b"))
    assert all(r.got == r.want for r in df.collect())


def test_dates_out_of_bounds(spark):
    days = [(D(2020, 1, 1), "fuera de rango"), (D(2026, 1, 1), "ok"), (D(2026, 1, 3), "ok"), (D(2026, 1, 4), "fecha futura"), (None, "sin fecha")]
    df = spark.createDataFrame(days, "d date, want string").withColumn("got", ingest.date_verdict(F.col("d"), D(2025, 1, 1), D(2026, 1, 2)))
    assert all(r.got == r.want for r in df.collect())


def test_failures_are_cleared(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x")], "id string, intentos int, ultima_vez string")
    ids = spark.createDataFrame([("b",), ("c",)], "id string")
    done = spark.createDataFrame([("a",), (None,)], "id string")
    assert {(r.id, r.intentos, r.ultima_vez) for r in S.failures(old, ids, F.lit("y"), done).collect()} == {("b", 3, "y"), ("c", 1, "y")}


def test_a_run_that_goes_on(spark, tmp_path):
    rows = spark.createDataFrame([(f"i{n}", "Inauguran una obra" if n % 3 else "Falla siempre", D(2024, 1, 1 + n)) for n in range(9)] + [("z", None, None)], "id string, titulo string, fecha date")
    t = tables.Table(spark, str(tmp_path / "s"), tables.SCHEMAS["noticias_sentimiento"], None)

    def ask(text):
        return "nada" if "Falla" in text else S.lexicon_answer(text)

    assert S.run_pending(rows, t, ask, chunk=2, limit=4)[0] == 4
    S.run_pending(rows, t, lambda x: S.lexicon_answer(x), chunk=2)
    assert t.read().count() == 9 and S.run_pending(rows, t) == (0, 0, 0)


def test_problems_of_sources(spark):
    days = [("a", D(2024, 1, 1)), ("a", D(2024, 3, 1)), ("b", D(2024, 1, 5)), ("c", D(2024, 3, 2)), ("d", D(2024, 3, 2))]
    own = B.source_status(B.gaps(spark.createDataFrame(days, "fuente string, fecha date")), D(2024, 3, 2), known={"d": "roto"})
    got = {r.fuente: (r.estado, r.problema) for r in own.collect()}
    assert got["a"] == ("gap", "⚠ Gap de datos: sin noticias del 02-01-2024 al 29-02-2024 (59 días).")
    assert got["b"] == ("malo", "⛔ Inactivo: sin noticias desde el 05-01-2024.") and got["c"] == ("ok", "") and got["d"] == ("malo", "⛔ roto")


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from kiosko.plans.common import shared_folder

    def session(master, folder=None, set_one=None):
        conf = SimpleNamespace(get=lambda *_: folder)
        context = SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=lambda *_: None), getCheckpointDir=lambda: set_one)
        return SimpleNamespace(conf=conf, sparkContext=context)

    assert shared_folder(session("spark://x", "hdfs://y")) == "hdfs://y"
    assert shared_folder(session("spark://x", None, "hdfs://z")) == "hdfs://z"
    for master in ("spark://x", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(RuntimeError, match="checkpoint"):
            shared_folder(session(master))


def _table(spark, tmp_path, name="titulos_terminos_diarios"):
    return tables.Table(spark, str(tmp_path / name), tables.SCHEMAS[name])


def test_upsert_and_rewrite(spark, tmp_path):
    t = _table(spark, tmp_path)
    make = lambda rows: spark.createDataFrame(rows, tables.SCHEMAS["titulos_terminos_diarios"])
    assert t.read().count() == 0
    t.upsert(make([(D(2024, 1, 1), "a", 1), (D(2024, 1, 2), "b", 2)]), "fecha", "termino")
    t.upsert(make([(D(2024, 1, 2), "b", 5), (D(2024, 1, 2), "c", 1), (D(2024, 1, 2), "c", 1)]), "fecha", "termino")
    assert {tuple(r) for r in t.read().collect()} == {(D(2024, 1, 1), "a", 1), (D(2024, 1, 2), "b", 5), (D(2024, 1, 2), "c", 1)}
    t.append_new(make([(D(2024, 1, 1), "a", 9), (D(2024, 1, 3), "d", 1)]), "fecha", "termino")
    t.rewrite_from(make([(D(2024, 1, 3), "e", 7)]), D(2024, 1, 2))
    assert {tuple(r) for r in t.read().collect()} == {(D(2024, 1, 1), "a", 1), (D(2024, 1, 3), "e", 7)}
    t.delete_with(spark.createDataFrame([("e",)], "termino string"), "termino")
    assert t.read().count() == 1
    t.overwrite(make([(D(2024, 1, 1), "x", 1)]))
    path, fs = t._files()
    fs.rename(path, t._files("__old")[0])  # a replacement that was cut off
    assert t.read().count() == 1
    t.upsert(make([(None, "x", 1), (D(2024, 1, 9), "y", 3), (D(2024, 1, 9), "y", 2)]), "fecha", "termino")
    assert {tuple(r) for r in t.read().collect()} == {(D(2024, 1, 1), "x", 1), (D(2024, 1, 9), "y", 2)}
    t.truncate()
    assert t.read().count() == 0


def test_upsert_moves_a_row_to_another_date(spark, tmp_path):
    t = tables.Table(spark, str(tmp_path / "m"), tables.SCHEMAS["noticias_embeddings_meta"].add("fecha", "date"))
    make = lambda rows: spark.createDataFrame(rows, t.schema)
    t.upsert(make([("a", None, "m", 1, D(2024, 1, 1)), ("b", None, "m", 1, D(2024, 1, 2))]), "id")
    t.upsert(make([("a", None, "n", None, D(2024, 1, 3))]), "id", keep=("store_version",))
    assert {(r.id, r.modelo, r.store_version, r.fecha.day) for r in t.read().collect()} == {("a", "n", 1, 3), ("b", "m", 1, 2)}


def test_incremental_equals_full(spark, tmp_path):
    from kiosko.operators import titles as O

    rows = [(D(2024, 1, d), f"Incendio forestal {w}") for d in range(1, 6) for w in ("valle", "costa")]
    old = spark.createDataFrame(rows[:6] + rows[8:], "fecha date, titulo string")
    new = spark.createDataFrame(rows, "fecha date, titulo string")
    t = _table(spark, tmp_path)
    full = lambda df: O.term_counts(O.article_terms(df), "fecha")
    t.overwrite(full(old))
    seen = tables.coverage(old, "titulos")
    assert tables.start_date(old, seen.limit(0)) is None
    start = tables.start_date(new, seen)
    assert start == D(2024, 1, 4)
    t.rewrite_from(full(new.where(F.col("fecha") >= F.lit(start))), start)
    assert {tuple(r) for r in t.read().collect()} == {tuple(r) for r in full(new).collect()}


def test_vector_store(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path / "v"))
    rows = spark.createDataFrame([(1, "a", "x", [1.0, 0.0]), (2, "b", "y", [0.9, 0.1]), (3, "c", "z", None)], "vec_id bigint, origin string, text string, embedding array<float>")
    store.insert(rows)
    store.insert(rows)
    assert store.table.read().count() == 2
    assert [r.id for r in store.missing(spark.createDataFrame([("a",), ("c",)], "id string")).collect()] == ["c"]
    assert store.search(rows.where("vec_id = 1"), 0.9).count() == 1
