from decimal import ROUND_HALF_UP, Decimal, localcontext

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from closebook.functions import numeric

NINE = Decimal("0.000000001")
amounts = st.lists(
    st.tuples(
        st.decimals(min_value=-(10**12), max_value=10**12, places=9),
        st.decimals(min_value=-(10**6), max_value=10**6, places=9),
    ),
    min_size=1,
    max_size=20,
)


def exact(function):
    with localcontext() as context:
        context.prec = 90
        return function().quantize(NINE, ROUND_HALF_UP)


@settings(max_examples=15, deadline=None)
@given(pairs=amounts)
def test_arithmetic_matches_exact_decimals(spark, pairs):
    df = spark.createDataFrame(pairs, "a decimal(38,9), b decimal(38,9)")
    a, b = F.col("a"), F.col("b")
    result = df.select("a", "b", numeric.add(a, b), numeric.subtract(a, b), numeric.multiply(a, b), numeric.divide(a, b))
    for x, y, total, difference, product, quotient in result.collect():
        assert (total, difference) == (exact(lambda: x + y), exact(lambda: x - y))
        assert product == exact(lambda: x * y)
        assert quotient == (exact(lambda: x / y) if y else None)


def test_plain_text(spark):
    values = ["5.00", "5.25", "5.250", "0.00", "100.00", "50.10"]
    df = spark.createDataFrame([(Decimal(v),) for v in values], "a decimal(20,9)")
    texts = [row[0] for row in df.select(numeric.plain_text(F.col("a"))).collect()]
    assert texts == ["5", "5.25", "5.25", "0", "100", "50.1"]
    whole = spark.createDataFrame([(Decimal(100),)], "a decimal(20,0)")
    assert whole.select(numeric.plain_text(F.col("a"))).first()[0] == "100"
