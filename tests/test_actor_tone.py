import datetime

from kiosko.queries import sentiment

DAY = datetime.date(2026, 3, 1)


def noticias(spark, folder, rows):
    """(id, titulo, cuerpo_limpio, fecha) as the table noticias."""
    own = spark.createDataFrame(rows, "id string, titulo string, cuerpo_limpio string, fecha date")
    own.selectExpr("*", "'emol' AS fuente", "id AS url", "cast(null as string) AS bajada").write.parquet(f"{folder}/noticias.parquet")


def test_actors_with_few_titles(spark, tmp_path):
    noticias(spark, tmp_path, [("a", "Habla Ana Rojas", None, DAY), ("b", "Gana Ana Rojas", None, DAY), ("c", "la voz de Luis Soto", None, DAY)])
    tone = [("a", "positivo"), ("b", "negativo"), ("c", "positivo")]
    spark.createDataFrame(tone, "id string, sentimiento string").selectExpr(
        "*", "'m' AS modelo", "timestamp_ntz'2026-03-02 00:00:00' AS procesado_en", "90 AS confianza", "'1' AS prompt_version"
    ).write.parquet(f"{tmp_path}/noticias_sentimiento.parquet")
    got = {r.actor: (r.total, r.neto) for r in sentiment.actor_net_tone(spark, str(tmp_path)).collect()}
    assert got["Luis Soto"] == (1, 100.0)
    assert sum(n for n, _ in got.values()) == 3
