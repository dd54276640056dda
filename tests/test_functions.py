import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from promolens.functions import completed_months, money, ratio, round_to, year_month


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_rounding_decides_ties_on_the_decimal_value(spark):
    assert one(spark, round_to(F.lit(0.145), 2)) == 0.15
    assert one(spark, round_to(F.lit(-0.145), 2)) == -0.15
    assert one(spark, round_to(F.lit(2.5), 0)) == 3.0
    assert one(spark, round_to(F.lit(86.666666), 1)) == 86.7
    assert one(spark, round_to(F.lit(None).cast("double"), 1)) is None


def test_division_by_zero_is_null(spark):
    assert one(spark, ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, ratio(F.lit(Decimal("1.50")), F.lit(3), 1000)) == 500.0
    assert one(spark, ratio(F.lit(None).cast("int"), F.lit(3))) is None


def test_money_keeps_cents_beyond_double_precision(spark):
    amount = Decimal("90071992547409930.07")
    assert one(spark, money(F.lit(amount))) == amount


def test_year_month(spark):
    assert one(spark, year_month(F.lit(dt.date(2024, 3, 9)))) == "2024-03"


def months_between(start, end):
    """Brute force: the largest number of month steps that does not pass the end."""
    if end < start:
        return -months_between(end, start)

    def reached(n):
        year, month = divmod(start.year * 12 + start.month - 1 + n, 12)
        return (year, month + 1, start.day) <= (end.year, end.month, end.day)

    n = 0
    while reached(n + 1):
        n += 1
    return n


def test_completed_months_against_brute_force(spark):
    seeded = random.Random(7)
    base = dt.date(2019, 12, 25)
    pairs = [
        (base + dt.timedelta(seeded.randrange(900)), base + dt.timedelta(seeded.randrange(900)))
        for _ in range(3000)
    ]
    pairs += [(dt.date(2023, 1, 31), dt.date(2023, 2, 28)), (dt.date(2020, 2, 29), dt.date(2021, 2, 28))]
    df = spark.createDataFrame(pairs, "a date, b date")
    got = df.select("a", "b", completed_months(F.col("a"), F.col("b")).alias("n")).collect()
    assert len(got) == len(pairs)
    for row in got:
        assert row.n == months_between(row.a, row.b), row


def test_month_end_is_not_a_full_month(spark):
    gap = completed_months(F.lit(dt.date(2023, 1, 31)), F.lit(dt.date(2023, 2, 28)))
    assert one(spark, gap) == 0
