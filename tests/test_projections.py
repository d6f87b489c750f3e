from pyspark.sql import functions as F

from strataflow import contracts as c
from strataflow.functions.columns import as_percentage, safe_divide
from strataflow.operators import projections as p
from strataflow.operators.calendar import row_quality_score
from tests.conftest import AS_OF, rows


def test_bad_values_become_null_then_default(spark):
    raw = spark.createDataFrame(
        [("1", "10", "12.5", "4", "2001", None), ("x", "11", "abc", None, "", "1")],
        "nusoc STRING, nucon STRING, prmaco STRING, pfco STRING, asaico STRING, etatco STRING",
    )
    out = raw.transform(p.cast_columns).transform(p.fill_defaults)
    assert rows(out) == [(1, 10, 12.5, 4, 2001, "UNKNOWN"), (None, 11, 0.0, 0, None, "1")]


def test_decoding_covers_listed_unlisted_and_missing_codes(spark):
    raw = spark.createDataFrame(
        [("A", "0", 0), ("M", "1", 1), ("C", "9", 3), ("X", "5", 2), (None, "UNKNOWN", None)],
        "cateco STRING, etatco STRING, usagco1 INT",
    )
    out = p.decode_contracts(raw)
    assert rows(out, "type_vehicule", "etat_contrat_libelle", "contrat_actif", "usage_vehicule", "nb_garanties") == sorted(
        [
            ("Auto", "Annule", 0, "Domicile-Travail", 0),
            ("Moto", "En cours", 1, "Promenade", 0),
            ("Cyclo", "Resilie Mutuelle", 0, "Professionnel", 0),
            ("Inconnu", "Autre", 0, "Autre", 0),
            ("Inconnu", "Autre", 0, "Autre", 0),
        ]
    )


def test_guarantees_count_present_columns_only(spark):
    raw = spark.createDataFrame([(1, None, "1"), (0, 1, "bad")], "g01co INT, g02co INT, g28co STRING")
    out = raw.select(p.guarantee_count(raw.columns).alias("n"))
    assert rows(out) == [(1,), (2,)]
    assert len(c.GUARANTEE_FLAGS) == 20


def test_ages(spark):
    years = [2026, 2002, 2001, 1997, 1996, 1992, 1991, 1982, 1981, 1972, 1971, 1962, 1961, None]
    raw = spark.createDataFrame([(y,) for y in years], "aadhso INT")
    out = p.derive_client_age(raw, AS_OF)
    out = out.select(
        "aadhso",
        "age_client",
        "client_jeune",
        p.age_segment(F.col("age_client")).alias("s"),
        p.age_segment(F.col("age_client"), "unknown").alias("k"),
    )
    got = {r.aadhso: (r.age_client, r.client_jeune, r.s) for r in out.collect()}
    assert got[2026] == (0, 1, "18-24")
    assert got[2002][2] == "18-24" and got[2001][2] == "25-34"
    assert got[1997] == (29, 1, "25-34") and got[1996] == (30, 0, "25-34")
    assert [got[y][2] for y in (1992, 1991, 1982, 1981, 1972, 1971, 1962, 1961)] == [
        "25-34", "35-44", "35-44", "45-54", "45-54", "55-64", "55-64", "65+",
    ]
    assert got[None] == (None, 0, "65+")
    assert {r.k for r in out.where("aadhso IS NULL").collect()} == {"unknown"}


def test_ratios_survive_zero_and_null(spark):
    raw = spark.createDataFrame([(1, 4), (1, 0), (None, 2), (5, None)], "a INT, b INT")
    ratio = safe_divide(F.col("a"), F.col("b"))
    assert [r[0] for r in raw.select(as_percentage(ratio)).collect()] == [25.0, 0.0, 0.0, 0.0]
    assert raw.select(safe_divide(F.col("a"), F.col("b"), 9.0)).collect()[1][0] == 9.0


def test_quality_score_counts_unknown_as_unmet(spark):
    raw = spark.createDataFrame([(1, 1), (None, 1), (None, None)], "a INT, b INT")
    score = row_quality_score([F.col("a") > 0, F.col("b") > 0])
    assert [r[0] for r in raw.select(score).collect()] == [1.0, 0.5, 0.0]
    assert raw.select(row_quality_score([])).first()[0] == 0.0


def test_sql_text_filter(spark):
    raw = spark.createDataFrame([(1, 2.0), (2, None)], "id INT, amount DOUBLE")
    assert rows(p.rows_matching(raw, "amount IS NOT NULL")) == [(1, 2.0)]
    assert rows(p.rows_matching(raw, F.col("id") == 2)) == [(2, None)]
