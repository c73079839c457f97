"""Expression goldens (FIXTURES §2)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from routekpi import functions as K
from routekpi.schemas import SUBREGION_RULES, SUBREGION_SEED


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_null_tokens(spark):
    vals = ["", "NULL", "N/A", "n/a", "null", " ", "NA", "x", None]
    got = [r[0] for r in one_col(spark, vals).select(K.null_tokens("x")).collect()]
    assert got == [None, None, None, None, "null", " ", "NA", "x", None]


def test_null_token_frame_matches_column_function(spark):
    vals = ["", "NULL", "N/A", "n/a", "null", "ok", None]
    df = one_col(spark, vals)
    a = [r[0] for r in df.select(K.null_tokens("x")).collect()]
    from routekpi.functions.parse import null_token_frame

    b = [r[0] for r in null_token_frame(df, ["x"]).collect()]
    assert a == b


ROUTES = [
    ("005", "5"), ("005/006", "5"), ("049/050", "49"), ("R4", "R4"), ("N19", "N19"),
    ("r4", "r4"), (" R4", None), ("R4/R5", "R4/R5"), ("C12", None), ("N/A", "N/A"),
    ("/006", None), ("5.6", "6"), ("000", "0"), ("-5", "-5"), (None, None),
]


def test_canonical_route(spark):
    df = one_col(spark, [r for r, _ in ROUTES])
    got = [r[0] for r in df.select(K.canonical_route("x")).collect()]
    assert got == [e for _, e in ROUTES]


def test_combined_flag(spark):
    df = one_col(spark, ["005/006", "005", None, "R4/R5"])
    assert [r[0] for r in df.select(K.combined_flag("x")).collect()] == [True, False, False, True]


TRY = [
    ("5.7", Decimal("6"), Decimal("5.70"), Decimal("5.70")),
    ("-5.5", Decimal("-6"), Decimal("-5.50"), Decimal("-5.50")),
    (" 7 ", Decimal("7"), Decimal("7.00"), Decimal("7.00")),
    ("1,234", None, None, Decimal("1234.00")),
    ("12%", None, None, Decimal("12.00")),
    ("1e3", Decimal("1000"), Decimal("1000.00"), Decimal("13.00")),
    ("85.", Decimal("85"), Decimal("85.00"), Decimal("85.00")),
    (".5", Decimal("1"), Decimal("0.50"), Decimal("0.50")),
    ("-", None, None, None),
    ("", None, None, None),
    ("1-2", None, None, None),
    ("1.2.3", None, None, None),
    ("abc", None, None, None),
    ("99999999999.5", Decimal("100000000000"), None, Decimal("99999999999.50")),
]


def test_try_parsers(spark):
    df = one_col(spark, [t[0] for t in TRY])
    rows = df.select(
        K.try_integer("x"), K.try_decimal("x", 10, 2), K.parse_with_units("x", 18, 2)
    ).collect()
    for (raw, i, d, s), r in zip(TRY, rows):
        assert (r[0], r[1], r[2]) == (i, d, s), raw


def test_try_int_and_double(spark):
    df = one_col(spark, ["2019", "2019.4", "x", "9999999999", "48.5"])
    rows = df.select(K.try_int("x"), K.try_double("x")).collect()
    assert [r[0] for r in rows] == [2019, 2019, None, None, 49]
    assert [r[1] for r in rows] == [2019.0, 2019.4, None, 9999999999.0, 48.5]


SUB = [
    ("North Vancouver", "Vancouver/UBC"), ("Southeast", "Southeast (Surrey/Langley)"),
    ("Maple Ridge/Pitt Meadows", "Ridge Meadows"), ("Port Coquitlam", "Tri-Cities"),
    ("Northeast (Coquitlam)", "Northeast Sector"), ("District X", "Tri-Cities"),
    ("Atlantis", "Atlantis"), ("", ""), (None, None), ("burnaby", "Burnaby/New Westminster"),
]


def test_keyword_classify_first_match_wins(spark):
    df = one_col(spark, [s for s, _ in SUB])
    got = [r[0] for r in df.select(K.keyword_classify("x", SUBREGION_RULES)).collect()]
    assert got == [e for _, e in SUB]


SEV = [(None, "Unknown"), ("0", "Low"), ("4.9", "Low"), ("4.9999", "Low"), ("5", "Medium"),
       ("14.99", "Medium"), ("15", "High"), ("29.9999", "High"), ("30", "Critical"), ("100", "Critical")]


def test_severity_tier(spark):
    df = one_col(spark, [s for s, _ in SEV]).select(F.col("x").cast("decimal(10,4)").alias("x"))
    assert [r[0] for r in df.select(K.severity_tier("x")).collect()] == [e for _, e in SEV]


GAP = [
    ("11.2", "1.2", "0.8", "11.20", "80.00", "80.00", "45.60"),
    ("40", "1.8", "1.1", "40.00", "100.00", "110.00", "72.00"),
    ("0", "0.5", "0.2", "0.00", "33.33", "20.00", "14.00"),
    ("100", "2.0", "1.5", "100.00", "100.00", "150.00", "110.00"),
]


def test_gap_score_components(spark):
    df = spark.createDataFrame([g[:3] for g in GAP], "p string, f string, u string").select(
        F.col("p").cast("decimal(10,4)").alias("p"), F.col("f").cast("decimal(10,4)").alias("f"),
        F.col("u").cast("decimal(10,4)").alias("u"),
    )
    c1, c2, c3 = K.gap_components("p", "f", "u")
    rows = df.select(F.round(c1, 2), F.round(c2, 2), F.round(c3, 2), K.gap_score("p", "f", "u")).collect()
    for g, r in zip(GAP, rows):
        assert tuple(str(x) for x in r) == g[3:]


def test_capped_keeps_null(spark):
    df = one_col(spark, [None, "120"]).select(F.col("x").cast("decimal(10,2)").alias("x"))
    assert [r[0] for r in df.select(K.capped("x", 100)).collect()] == [None, Decimal("100.00")]


DENSITY = {
    "Vancouver/UBC": "5871.5", "Burnaby/New Westminster": "3087.5", "North Shore": "705.7",
    "Northeast Sector": "1307.0", "Southeast (Surrey/Langley)": "1311.7", "Ridge Meadows": "37.9",
    "Tri-Cities": "633.8", "Southwest (Richmond/Delta)": "645.8",
}


def test_density_of_seed(spark):
    from routekpi.plans.marts import dim_subregions
    from routekpi.sources.csv_raw import seed_frame

    rows = dim_subregions(seed_frame(spark)).collect()
    assert len(rows) == len(SUBREGION_SEED)
    assert {r.subregion_name: str(r.population_density_per_km2) for r in rows} == DENSITY


@pytest.mark.parametrize("num,den,out", [("1000", "120", "8.3333333333"), ("1", "0", None), ("1", None, None)])
def test_guarded_ratio(spark, num, den, out):
    df = spark.createDataFrame([(num, den)], "a string, b string").select(
        F.col("a").cast("decimal(18,3)").alias("a"), F.col("b").cast("decimal(10,2)").alias("b"))
    v = df.select(F.round(K.guarded_ratio("a", "b"), 10)).collect()[0][0]
    assert (None if v is None else str(v)) == out


def test_index_and_change(spark):
    df = spark.createDataFrame([("705", "1000", "805")], "v string, b string, n string").select(
        *[F.col(c).cast("decimal(18,3)").alias(c) for c in "vbn"])
    r = df.select(K.index_to("v", "b", 1), K.pct_change("v", "b", 2), K.pct_change("n", "v", 2)).collect()[0]
    assert (str(r[0]), str(r[1]), str(r[2])) == ("70.5", "-29.50", "14.18")


def test_sql_functions_match_column_functions(spark):
    from routekpi.functions.sql import register_sql_functions

    register_sql_functions(spark)
    codes = [r for r, _ in ROUTES]
    df = one_col(spark, codes)
    df.createOrReplaceTempView("codes")
    got = [tuple(r) for r in spark.sql(
        "SELECT rk_canonical_route(x), rk_combined_flag(x), rk_try_integer(x), rk_strip_units(x), "
        "rk_null_token(x), rk_subregion(x) FROM codes").collect()]
    exp = [tuple(r) for r in df.select(
        K.canonical_route("x"), K.combined_flag("x"), K.try_integer("x"), K.strip_units("x"),
        K.null_tokens("x"), K.keyword_classify("x", SUBREGION_RULES)).collect()]
    assert got == exp
    sev = spark.sql("SELECT rk_severity_tier(CAST(x AS DECIMAL(10,4))) FROM VALUES (NULL), ('4.9999'), ('5'), "
                    "('15'), ('30') AS t(x)").collect()
    assert [r[0] for r in sev] == ["Unknown", "Low", "Medium", "High", "Critical"]
