"""Property tests of the scalar rules against an independent Python computation."""

from __future__ import annotations

from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feeflow import functions as fn

pairs = st.lists(
    st.tuples(st.integers(-10**12, 10**12), st.integers(-5, 10**6)), min_size=1, max_size=300
)


def expected_rate(fee: int, size: int):
    if size == 0:
        return None
    return float(Decimal(repr(fee / size)).quantize(Decimal("0.01"), ROUND_HALF_EVEN))


@settings(max_examples=15, deadline=None)
@given(pairs)
def test_fee_rate_is_half_even_on_the_shortest_decimal(spark, rows):
    df = spark.createDataFrame(rows, "fee bigint, size int")
    got = df.select("fee", "size", fn.fee_rate("fee", "size").alias("r")).collect()
    for r in got:
        assert r.r == expected_rate(r.fee, r.size), (r.fee, r.size, r.r)


money = st.lists(
    st.tuples(st.integers(0, 10**9), st.integers(0, 10)), min_size=1, max_size=300
)


@settings(max_examples=15, deadline=None)
@given(money)
def test_money_to_cents_is_exact(spark, rows):
    data = [(c / 100.0, d / 100.0, c, d) for c, d in rows]
    df = spark.createDataFrame(data, "price double, discount double, c bigint, d bigint")
    got = df.select("c", "d", fn.cents_of("price").alias("in_c"), fn.discounted_cents_of("price", "discount").alias("out_c"))
    for r in got.collect():
        assert r.in_c == r.c
        net = Decimal(r.c) * (100 - r.d) / Decimal(100)
        assert r.out_c == int(net.quantize(Decimal(1), ROUND_HALF_UP))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, 9 * 10**15), min_size=1, max_size=100))
def test_coins_text_is_exact(spark, sats):
    df = spark.createDataFrame([(s,) for s in sats], "sat bigint")
    for r in df.select("sat", fn.coins_text("sat").alias("t")).collect():
        assert Decimal(r.t) == Decimal(r.sat) / Decimal(10**8) and len(r.t.split(".")[1]) == 8


def test_zone_free_conversions(spark):
    df = spark.range(1).select(F.lit(1677464386).alias("t"))
    r = df.select(fn.epoch_to_ntz("t").alias("n"), fn.instant_to_ntz(fn.epoch_to_instant("t")).alias("m")).first()
    assert r.n == r.m and str(r.n) == "2023-02-27 02:19:46"
