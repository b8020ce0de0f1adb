from decimal import Decimal

from pyspark.sql import functions as F

from starloom.functions import (
    date_key, date_part, email_domain, hash_pii, iso_day_of_week, iso_millis, mask_email, mask_phone,
    millis_between, money, surrogate_key,
)


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def test_money_rounds_once_half_away_from_zero(spark):
    assert one(spark, money(F.lit(Decimal("1.0049")).cast("decimal(10,4)"))) == Decimal("1.000")
    assert one(spark, money(F.lit(Decimal("1.005")).cast("decimal(10,3)"))) == Decimal("1.010")
    assert one(spark, money(F.lit(Decimal("-1.005")).cast("decimal(10,3)"))) == Decimal("-1.010")
    t = spark.range(1).select(money(F.lit(Decimal("2.5")).cast("decimal(10,1)")).alias("m")).schema["m"].dataType
    assert t.simpleString() == "decimal(18,3)"


def test_surrogate_key_null_and_empty_collide_but_positions_do_not(spark):
    df = spark.createDataFrame([(None, "a"), ("", "a"), ("a", None)], "x string, y string")
    keys = [r[0] for r in df.select(surrogate_key("x", "y")).collect()]
    assert keys[0] == keys[1]
    assert keys[0] != keys[2]
    import hashlib
    assert keys[0] == hashlib.md5(b"|a").hexdigest()


def test_masks(spark):
    df = spark.createDataFrame([("Jane@Example.com", "+1-990-555-1234"), (None, None), ("nodomain", "123")],
                               "e string, p string")
    rows = df.select(mask_email("e"), mask_phone("p"), email_domain("e"), hash_pii("e")).collect()
    assert rows[0][0] == "J***@Example.com" and rows[0][1] == "+1-990-***-****"
    assert rows[1][0] is None and rows[1][1] is None and rows[1][3] is None
    assert rows[2][2] == "" and rows[2][0] == "n***@"


def test_calendar_parts(spark):
    d = F.to_date(F.lit("2024-12-30"))
    assert one(spark, date_key(d)) == 20241230
    assert one(spark, date_part("isoweek", d)) == 1
    assert one(spark, iso_day_of_week(d)) == 1
    assert one(spark, iso_day_of_week(F.to_date(F.lit("2024-12-29")))) == 7
    assert one(spark, date_part("quarter", d)) == 4


def test_millis_between_truncates(spark):
    a = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    b = F.to_timestamp(F.lit("2024-01-01 00:00:02.0019"))
    assert one(spark, millis_between(a, b)) == 2001
    assert one(spark, millis_between(b, a)) == -2001


def test_iso_millis(spark):
    ts = F.to_timestamp(F.lit("2024-01-01 00:00:07.179575"))
    assert one(spark, iso_millis(ts)) == "2024-01-01T00:00:07.179Z"
