import datetime

from kiosko.queries import titles

DAY, NEXT = datetime.date(2026, 3, 1), datetime.date(2026, 3, 2)


def noticias(spark, folder, rows):
    """(id, titulo, cuerpo_limpio, fecha) as the table noticias."""
    own = spark.createDataFrame(rows, "id string, titulo string, cuerpo_limpio string, fecha date")
    own.selectExpr("*", "'emol' AS fuente", "id AS url", "cast(null as string) AS bajada").write.parquet(f"{folder}/noticias.parquet")


def test_body_ngrams_that_occur_once(spark, tmp_path):
    noticias(spark, tmp_path, [("a", "x", "puente colgante valle", DAY), ("b", "x", "puente colgante", DAY), ("c", "x", "puente colgante", NEXT)])
    got = {(r.fecha, r.ngrama, r.tipo): r.n for r in titles.body_ngrams_daily(spark, str(tmp_path)).collect()}
    assert got == {(DAY, "puente colgante", 2): 2, (DAY, "colgante valle", 2): 1, (DAY, "puente colgante valle", 3): 1, (NEXT, "puente colgante", 2): 1}
