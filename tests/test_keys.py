"""Hash keys, hashdiffs, bounded ids, tiers, date helpers."""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from tessera.functions import (
    bounded_id,
    credit_tier,
    date_key,
    hashdiff,
    hub_key,
    month_start,
    padded_name,
)
from tessera.functions.keys import packed_key, unpacked_key


def md5(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


def test_null_part_uses_token_and_is_never_null(spark):
    df = spark.createDataFrame([(None, "x"), ("", "x")], "a string, b string")
    keys = [r.k for r in df.select(hub_key("a", "b").alias("k")).collect()]
    assert keys[0] == "3b4eefe862272d14394cff0e43854ab0"
    assert keys[0] == md5("_dbt_utils_surrogate_key_null_-x")
    assert keys[1] == md5("-x")
    assert keys[0] != keys[1]


def test_key_single_and_order(spark):
    df = spark.createDataFrame([(1, 2)], "a bigint, b bigint")
    r = df.select(hub_key("a").alias("one"), hub_key("a", "b").alias("ab"),
                  hub_key("b", "a").alias("ba")).first()
    assert r.one == md5("1")
    assert r.ab == md5("1-2") and r.ba == md5("2-1") and r.ab != r.ba


def test_separator_is_not_escaped(spark):
    df = spark.createDataFrame([("a-b", "c", "a", "b-c")], "p string, q string, r string, s string")
    r = df.select(hub_key("p", "q").alias("x"), hub_key("r", "s").alias("y")).first()
    assert r.x == r.y


def test_hashdiff_after_cast(spark):
    df = spark.createDataFrame([(5.0,), (5.001,)], "v double")
    hd = [r.h for r in df.select(hashdiff(F.col("v").cast("decimal(15,2)")).alias("h")).collect()]
    assert hd[0] == hd[1] == md5("5.00")


def test_typed_text_forms(spark):
    df = spark.createDataFrame([(dt.date(2016, 2, 29),)], "d date").select(
        F.col("d"), F.lit("2016-01-01 00:00:00").cast("timestamp_ntz").alias("t"))
    r = df.select(hub_key("d").alias("d"), hub_key("t").alias("t")).first()
    assert r.d == md5("2016-02-29")
    assert r.t == md5("2016-01-01 00:00:00")


def test_bounded_id_cuts_text_but_key_hashes_all(spark):
    long_id = "X" * 25
    df = spark.createDataFrame([(long_id,)], "id string")
    r = df.select(bounded_id("id", 20).alias("b"), hub_key("id").alias("k")).first()
    assert r.b == "X" * 20
    assert r.k == md5(long_id)


def test_credit_tier_cut_points(spark):
    scores = [750, 749, 700, 699, 650, 649, 600, 599, None]
    expect = ["excellent", "good", "good", "fair", "fair", "poor", "poor", "very_poor", "very_poor"]
    df = spark.createDataFrame([(s,) for s in scores], "s int")
    assert [r.t for r in df.select(credit_tier("s").alias("t")).collect()] == expect


def test_date_helpers(spark):
    df = spark.createDataFrame([(dt.date(2024, 5, 1),)], "d date").select(
        "d", F.lit("2021-01-01 13:45:00").cast("timestamp_ntz").alias("ts"))
    r = df.select(date_key("d").alias("k"), date_key("ts").alias("kt"),
                  month_start(F.lit("2024-05-17").cast("date")).alias("m"),
                  padded_name("d", "MMMM").alias("mn"), padded_name("d", "EEEE").alias("dn")).first()
    assert r.k == 20240501 and r.kt == 20210101
    assert r.m == dt.date(2024, 5, 1)
    assert r.mn == "May      " and r.dn == "Wednesday"


def test_packed_keys_come_back_and_stay_apart(spark):
    md5 = hashlib.md5(b"1").hexdigest()
    texts = [None, "", "t1", "hot", "é", md5, md5.upper(), md5[:31], md5 + "0", "x" * 16, "\0" * 17, "g" * 32]
    got = (spark.createDataFrame([(t,) for t in texts], "k string").withColumn("p", packed_key("k"))
           .select("k", "p", unpacked_key("p").alias("back")).collect())
    assert [r.back for r in got] == texts
    assert len({bytes(r.p) for r in got if r.p is not None}) == len(texts) - 1
    assert len(next(r.p for r in got if r.k == md5)) == 16
