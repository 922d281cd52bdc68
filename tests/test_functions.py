"""Column functions F1-F5, F12 on the literal edge rows of FIXTURES.md §4."""

from decimal import Decimal

from pyspark.sql import functions as F

from procura.functions import (cents_to_money, digits_key, gl_object_description, int_prefix, pct_of,
                               strip_zeros_if_numeric, to_cents)


def col_values(spark, values, typ, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_to_cents_rounds_half_away_from_zero(spark):
    vals = [Decimal("12.345"), Decimal("-0.025"), None, Decimal("2.5"), Decimal("0.004")]
    assert col_values(spark, vals, "decimal(12,3)", to_cents) == [1235, -3, None, 250, 0]


def test_cents_to_money_is_exact(spark):
    assert col_values(spark, [123456789, -5, None], "bigint", cents_to_money) == \
        [Decimal("1234567.89"), Decimal("-0.05"), None]


def test_digits_key(spark):
    assert col_values(spark, ["Brand#13", "none", "0012", "", None], "string", digits_key) == [13, None, 12, None, None]


def test_int_prefix(spark):
    vals = ["890CO", "CO", " 12 ", "65535", None, "-7x", "+3", "99999999999999999999"]
    assert col_values(spark, vals, "string", int_prefix) == [890, 0, 12, 65535, None, -7, 3, 2 ** 63 - 1]


def test_strip_zeros_if_numeric(spark):
    vals = ["0001234", "00890CO22422086", "0000", "0A", "12 34", "0" * 5 + "1" * 15, None, "", " 012"]
    assert col_values(spark, vals, "string", strip_zeros_if_numeric) == \
        ["1234", "00890CO22422086", "0000", "A", "12 34", "1" * 15, None, "", " 012"]


def test_zero_padded_20_digit_number_is_kept(spark):
    v = "0" + "9" * 19 + "9"  # 21 chars, value beyond 64 bits: the prefix read clamps
    assert col_values(spark, [v], "string", strip_zeros_if_numeric) == [v]


def test_pct_of(spark):
    df = spark.createDataFrame([(3846, 200000), (5, 0), (None, 10), (1, 3), (2, 3), (-1, 8)], "n bigint, d bigint")
    got = [r[0] for r in df.select(pct_of("n", "d")).collect()]
    assert got == [Decimal("1.92"), Decimal("0.00"), Decimal("0.00"), Decimal("33.33"), Decimal("66.67"),
                   Decimal("-12.50")]


def test_pct_of_half_way_rounds_up(spark):
    # 1/8 = 0.125 -> 12.50 exactly; 1/200 = 0.005 -> 0.50; 1.005% case
    df = spark.createDataFrame([(201, 20000)], "n bigint, d bigint")
    assert df.select(pct_of("n", "d")).first()[0] == Decimal("1.01")


def test_gl_object_description(spark):
    got = col_values(spark, [5410, 5420, 5430, 5450, 5210, 9999, None], "int", gl_object_description)
    assert got == ["PRINT MATERIALS", "PERIODICALS", "A/V LIBRARY MATERIALS", "ELECTRONIC MATERIALS",
                   "ADMIN SUPPLIES", None, None]


def test_pct_of_matches_published_fund_chart(spark):
    """Golden rows of the published fund-use chart: (appropriation,
    encumbrance, expenditure) -> total % used, expenditure % used."""
    golden = [(150000, 0, 5900, "3.93", "3.93"), (148984, 16460, 73847, "60.62", "49.57"),
              (200000, 0, 0, "0.00", "0.00"), (1459190, 4636, 257415, "17.96", "17.64"),
              (4154362, 435696, 405302, "20.24", "9.76")]
    df = spark.createDataFrame([g[:3] for g in golden], "a bigint, enc bigint, exp bigint")
    got = df.select(pct_of(F.col("exp") + F.col("enc"), "a").alias("t"), pct_of("exp", "a").alias("e")).collect()
    assert [(str(r.t), str(r.e)) for r in got] == [(g[3], g[4]) for g in golden]
