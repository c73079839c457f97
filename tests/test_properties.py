"""Column expressions against plain-Python definitions on random inputs."""

from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from routekpi import functions as K
from routekpi.schemas import SUBREGION_RULES


def py_to_integer(s):
    """Numeric text -> integer, half-up; None when not a plain decimal number."""
    if s is None:
        return None
    t = s.strip(" ")
    if not t or any(c not in "0123456789.-+eE" for c in t):
        return None
    try:
        d = Decimal(t)
    except InvalidOperation:
        return None
    if not d.is_finite():
        return None
    return d.quantize(Decimal(1), rounding=ROUND_HALF_UP)


def py_canonical(s):
    if s is None:
        return None
    if s[:1].upper() in ("R", "N"):
        return s.strip(" ")
    part = s.split("/")[0] if "/" in s else s
    v = py_to_integer(part)
    return None if v is None else str(v)


codes = st.one_of(
    st.none(),
    st.integers(0, 999).map(lambda i: f"{i:03d}"),
    st.tuples(st.integers(0, 999), st.integers(0, 999)).map(lambda t: f"{t[0]:03d}/{t[1]:03d}"),
    st.tuples(st.sampled_from("RrNnC"), st.integers(0, 99)).map(lambda t: f"{t[0]}{t[1]}"),
    st.integers(0, 999).map(lambda i: f"{i}.5"),
    st.text(alphabet="0123456789/ .-", min_size=0, max_size=6),
)


@settings(max_examples=10, deadline=None)
@given(st.lists(codes, min_size=1, max_size=40))
def test_canonical_route_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(K.canonical_route("x")).collect()]
    assert got == [py_canonical(v) for v in values]


def py_classify(s, rules):
    if s is None:
        return None
    u = s.upper()
    for cat, pats in rules:
        for p in pats:
            needle = p.strip("%")
            if (p.startswith("%") and p.endswith("%") and needle in u) or (
                    not p.startswith("%") and p.endswith("%") and u.startswith(needle)):
                return cat
    return s


words = st.lists(st.sampled_from(["North", "Vancouver", "ubc", "Surrey", "district", "Maple", "Ridge",
                                  "Delta", "Atlantis", "Port", "Moody", "New West", "", "east"]),
                 min_size=0, max_size=3).map(" ".join)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), words), min_size=1, max_size=30))
def test_keyword_classify_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(K.keyword_classify("x", SUBREGION_RULES)).collect()]
    assert got == [py_classify(v, SUBREGION_RULES) for v in values]


def q(v, places):
    return v.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)


def py_gap(p, f, u):
    c1 = min(p, Decimal(100))
    c2f = min(f * 100, Decimal(150))
    return q(Decimal("0.5") * c1 + Decimal("0.3") * c2f / 150 * 100 + Decimal("0.2") * u * 100, 2)


dec4 = st.decimals(min_value=Decimal("0"), max_value=Decimal("200"), places=4, allow_nan=False, allow_infinity=False)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(dec4, dec4.map(lambda d: d / 50), dec4.map(lambda d: d / 100)), min_size=1, max_size=30))
def test_gap_score_matches_decimal_arithmetic(spark, triples):
    rows = [(str(p), str(q(f, 4)), str(q(u, 4))) for p, f, u in triples]
    df = spark.createDataFrame(rows, "p string, f string, u string").select(
        *[F.col(c).cast("decimal(10,4)").alias(c) for c in "pfu"])
    got = [r[0] for r in df.select(K.gap_score("p", "f", "u")).collect()]
    exp = [py_gap(Decimal(p), Decimal(f), Decimal(u)) for p, f, u in rows]
    assert got == exp


amounts = st.decimals(min_value=Decimal("0"), max_value=Decimal("9999999"), places=3, allow_nan=False,
                      allow_infinity=False)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(amounts, amounts), min_size=1, max_size=30))
def test_index_and_change_round_half_up_exactly(spark, pairs):
    df = spark.createDataFrame([(str(a), str(b)) for a, b in pairs], "v string, b string").select(
        *[F.col(c).cast("decimal(18,3)").alias(c) for c in "vb"])
    got = [(r[0], r[1]) for r in df.select(K.index_to("v", "b", 1), K.pct_change("v", "b", 2)).collect()]
    exp = [((q(a / b * 100, 1) if b > 0 else None), (q((a - b) / b * 100, 2) if b > 0 else None))
           for a, b in pairs]
    assert got == exp
