"""SCD2 dimensions, star joins and data checks on hand-written fixtures."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from tessera.operators.checks import (
    CheckSpec,
    DataQualityError,
    check_not_null,
    check_relationships,
    check_unique,
    enforce,
    run_checks,
)
from tessera.operators.scd2 import build_scd2_dim, scd2_intervals
from tessera.operators.star import join_as_of, join_current, merge_as_of
from tessera.plans import gold

TS = "timestamp_ntz"


def ts(s: str):
    return F.lit(s).cast(TS)


def _sat(spark, rows):
    df = spark.createDataFrame(rows, "k string, attr string, load_date string")
    return df.select("k", "attr", F.col("load_date").cast(TS).alias("load_date"),
                     F.lit("src").alias("record_source"))


def test_intervals_half_open_one_current(spark):
    sat = _sat(spark, [("a", "x", "2016-01-01 00:00:00"), ("a", "y", "2018-01-01 00:00:00")])
    rows = scd2_intervals(sat, "k").orderBy("load_date").collect()
    assert rows[0].effective_end_date == rows[1].effective_start_date
    assert [r.is_current for r in rows] == [False, True]
    assert rows[1].effective_end_date == dt.datetime(9999, 12, 31)


def test_orphan_satellite_drops_and_reassigned_parent_fans_out(spark):
    sat = _sat(spark, [("a", "x", "2016-01-01 00:00:00"), ("z", "q", "2016-01-01 00:00:00")])
    hub = spark.createDataFrame([("a", "A")], "k string, id string")
    link = spark.createDataFrame([("a", "c1"), ("a", "c2")], "k string, parent string")
    dim = build_scd2_dim(sat, hub, "k", "id", ["attr"], "vkey", link, "parent")
    rows = dim.collect()
    assert {r.k for r in rows} == {"a"}
    assert len(rows) == 2 and len({r.vkey for r in rows}) == 1
    # one copy current, the other a zero-length interval
    assert sorted(r.is_current for r in rows) == [False, True]
    zero = [r for r in rows if not r.is_current][0]
    assert zero.effective_start_date == zero.effective_end_date
    assert check_unique(dim, "vkey").count() == 1


def test_account_without_link_has_null_parent(spark):
    sat = _sat(spark, [("a", "x", "2016-01-01 00:00:00")])
    hub = spark.createDataFrame([("a", "A")], "k string, id string")
    link = spark.createDataFrame([], "k string, parent string")
    dim = build_scd2_dim(sat, hub, "k", "id", ["attr"], "vkey", link, "parent")
    assert dim.first().parent is None
    assert check_not_null(dim, "parent").count() == 1


def test_customer_without_accounts_or_loans_gets_zero_rollups(spark):
    sat = spark.createDataFrame(
        [("c", "F", "L", "e", "city", 700, dt.date(2015, 3, 9))],
        "customer_hub_key string, first_name string, last_name string, email string, "
        "city string, credit_score int, created_date date").select(
        "*", ts("2016-01-01 00:00:00").alias("load_date"), F.lit("src").alias("record_source"))
    hub = spark.createDataFrame([("c", "1")], "customer_hub_key string, customer_id string")
    dim_account = spark.createDataFrame(
        [], "customer_hub_key string, account_type string, is_current boolean")
    fact_loans = spark.createDataFrame(
        [], "customer_hub_key string, loan_amount decimal(15,2)")
    r = gold.dim_customer(sat, hub, dim_account, fact_loans).first()
    assert (r.total_account_count, r.checking_account_count, r.savings_account_count,
            r.total_loan_count) == (0, 0, 0, 0)
    assert float(r.total_loan_amount) == 0.0
    assert r.credit_tier == "good" and r.acquisition_month == dt.date(2015, 3, 1)


def test_point_in_time_boundaries(spark):
    dim = scd2_intervals(_sat(spark, [("a", "v1", "2016-01-01 00:00:00"),
                                      ("a", "v2", "2018-01-01 00:00:00")]), "k")
    fact = spark.createDataFrame(
        [(1, "2016-01-01 00:00:00"), (2, "2017-12-31 23:59:59"), (3, "2018-01-01 00:00:00"),
         (4, "2015-06-01 00:00:00")], "id int, t string").select(
        "id", F.lit("a").alias("k"), F.col("t").cast(TS).alias("t"))
    got = {r.id: r.attr for r in join_as_of(fact, dim, "k", "t", ["attr"]).collect()}
    assert got == {1: "v1", 2: "v1", 3: "v2"}
    cur = {r.id: r.attr for r in join_current(fact, dim, "k", ["attr"]).collect()}
    assert cur == {1: "v2", 2: "v2", 3: "v2", 4: "v2"}
    # the error the rules prevent: joining on the key alone fans out
    assert fact.join(dim, "k").count() == 8


def test_relationships_orphan_fails_null_passes(spark):
    parent = spark.createDataFrame([("p1",)], "pk string")
    child = spark.createDataFrame([("p1",), ("p2",), (None,)], "fk string")
    bad = check_relationships(child, "fk", parent, "pk").collect()
    assert [(r.fk, r.n_records) for r in bad] == [("p2", 1)]


def test_scoped_check_and_gate(spark):
    dim = spark.createDataFrame([("a", True), ("a", False)], "k string, is_current boolean")
    specs = [CheckSpec("d", "unique_combination", ("k",), where="is_current"),
             CheckSpec("d", "unique_combination", ("k",))]
    res = {r.check_id: r.failures for r in run_checks({"d": dim}, specs).collect()}
    assert list(res.values()) == [0, 1]
    enforce(run_checks({"d": dim}, specs[:1]))
    try:
        enforce(run_checks({"d": dim}, specs))
    except DataQualityError as e:
        assert "unique_combination" in str(e)
    else:
        raise AssertionError("gate did not fail")


def test_run_checks_counts_like_assertion_queries(spark):
    t = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, 2)], "u string, v int")
    p = spark.createDataFrame([(1,)], "v int")
    specs = [CheckSpec("t", "unique", ("u",)), CheckSpec("t", "not_null", ("v",)),
             CheckSpec("t", "relationships", ("v",), to="p", field="v"),
             CheckSpec("t", "unique_combination", ("u", "v"))]
    got = [r.failures for r in run_checks({"t": t, "p": p}, specs).collect()]
    # unique: 'a' duplicated -> 1 row; not_null: 1 NULL; orphans: v=2 once;
    # combos: (a,1) duplicated -> 1 row
    assert got == [1, 1, 1, 1]


def test_fanout_versioning_equals_window_after_fanout(spark):
    from pyspark.sql import Window
    sat = _sat(spark, [("a", "x", "2016-01-01 00:00:00"), ("a", "y", "2018-01-01 00:00:00"),
                       ("a", "z", "2020-01-01 00:00:00"), ("b", "x", "2016-01-01 00:00:00"),
                       ("b", "w", "2018-01-01 00:00:00"), ("c", "q", "2018-01-01 00:00:00")])
    hub = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "k string, id string")
    link = spark.createDataFrame([("a", "p1"), ("a", "p2"), ("a", "p3"), ("b", "p1")],
                                 "k string, parent string")
    ours = build_scd2_dim(sat, hub, "k", "id", ["attr"], "vkey", link, "parent")
    # the reference formulation: fan out first, then version
    fanned = (sat.join(hub, "k").join(link, "k", "left"))
    w = Window.partitionBy("k").orderBy("load_date", "k")
    ref = (fanned.withColumn("effective_start_date", F.col("load_date"))
           .withColumn("effective_end_date",
                       F.coalesce(F.lead("load_date").over(w),
                                  F.lit("9999-12-31 00:00:00").cast(TS)))
           .withColumn("is_current", F.lead("load_date").over(w).isNull()))
    cols = ["k", "attr", "effective_start_date", "effective_end_date", "is_current"]
    assert sorted(map(tuple, ours.select(cols).collect())) == \
        sorted(map(tuple, ref.select(cols).collect()))
    assert ours.count() == 3 * 3 + 2 + 1
    assert ours.filter("is_current").groupBy("k").count().filter("count != 1").count() == 0


def test_empty_catalogue_is_an_empty_summary(spark):
    t = spark.createDataFrame([("a",)], "u string")
    out = run_checks({"t": t}, [])
    assert out.count() == 0 and out.columns == ["check_id", "model", "test", "column_name",
                                                "failures"]


def test_bucketed_point_in_time_equals_plain(spark, warehouse_sf0001):
    from tessera.operators.star import join_as_of
    f = warehouse_sf0001.read("gold", "fact_transactions").select(
        "transaction_hub_key", "customer_hub_key", "transaction_date", "amount_usd")
    d = warehouse_sf0001.read("gold", "dim_customer")
    cols = ["customer_key", "city"]
    plain = join_as_of(f, d, "customer_hub_key", "transaction_date", cols)
    for unit in ["year", "month"]:
        b = join_as_of(f, d, "customer_hub_key", "transaction_date", cols, bucket=unit)
        assert b.exceptAll(plain).count() == 0 and plain.exceptAll(b).count() == 0
    # boundary fixture: events at start, just before end, at end, before first load
    dim = scd2_intervals(_sat(spark, [("a", "v1", "2016-01-01 00:00:00"),
                                      ("a", "v2", "2018-01-01 00:00:00")]), "k")
    fact = spark.createDataFrame(
        [(1, "2016-01-01 00:00:00"), (2, "2017-12-31 23:59:59"), (3, "2018-01-01 00:00:00"),
         (4, "2015-06-01 00:00:00")], "id int, t string").select(
        "id", F.lit("a").alias("k"), F.col("t").cast(TS).alias("t"))
    got = {r.id: r.attr for r in join_as_of(fact, dim, "k", "t", ["attr"],
                                            bucket="month").collect()}
    assert got == {1: "v1", 2: "v1", 3: "v2"}


def test_bucketed_point_in_time_null_events_and_left_mode(spark):
    from tessera.operators.star import join_as_of
    dim = scd2_intervals(_sat(spark, [("a", "v1", "2016-01-01 00:00:00"),
                                      ("a", "v2", "2018-06-01 00:00:00")]), "k")
    fact = spark.createDataFrame(
        [(1, "2017-03-01 00:00:00"), (2, None), (3, "2019-01-01 00:00:00"),
         (4, "2015-01-01 00:00:00")], "id int, t string").select(
        "id", F.lit("a").alias("k"), F.col("t").cast(TS).alias("t"))
    for how in ["inner", "left"]:
        plain = join_as_of(fact, dim, "k", "t", ["attr"], how=how)
        for unit in ["year", "month"]:
            b = join_as_of(fact, dim, "k", "t", ["attr"], how=how, bucket=unit)
            assert sorted(map(tuple, b.collect()), key=str) == \
                sorted(map(tuple, plain.collect()), key=str)
    left = {r.id: r.attr for r in join_as_of(fact, dim, "k", "t", ["attr"], how="left",
                                             bucket="year").collect()}
    assert left == {1: "v1", 2: None, 3: "v2", 4: None}


def test_merged_point_in_time_equals_plain(spark, warehouse_sf0001):
    f = warehouse_sf0001.read("gold", "fact_transactions").select(
        "transaction_hub_key", "customer_hub_key", "transaction_date", "amount_usd")
    d = warehouse_sf0001.read("gold", "dim_customer")
    for how in ["inner", "left"]:
        plain = join_as_of(f, d, "customer_hub_key", "transaction_date", ["customer_key", "city"], how=how)
        merged = merge_as_of(f, d, "customer_hub_key", "transaction_date", ["customer_key", "city"], how=how)
        assert merged.columns == plain.columns
        assert merged.exceptAll(plain).count() == 0 and plain.exceptAll(merged).count() == 0


def test_merged_point_in_time_on_random_histories(spark):
    """Gaps, zero-length copies, repeated events, null keys, times and attributes, times outside the
    bounds, versions that start in the slice, before it and many slices before."""
    rng = random.Random(7)
    def day():
        return dt.datetime(rng.choice([2009, 2014, 2016, 2017, 2018, 2031]), rng.randint(1, 12), rng.randint(1, 9))
    versions = []
    for k in "abcdef":
        days = sorted({day() for _ in range(rng.randint(0, 9))})
        for i, (start, end) in enumerate(zip(days, days[1:] + [dt.datetime(9999, 12, 31)])):
            if rng.random() < 0.8:  # else a gap
                versions.append((k, rng.choice([None, f"{k}{i}"]), i, start, end))
            versions.append((k, f"zero{i}", -1, start, start))
    versions.append((None, "null", 0, day(), dt.datetime(9999, 12, 31)))
    dim = spark.createDataFrame(versions, "k string, attr string, n int, effective_start_date timestamp_ntz, "
                                          "effective_end_date timestamp_ntz")
    starts = [v[3] for v in versions]
    events = [(i, rng.choice(["a", "b", "c", "d", "e", "f", "g", None]),
               rng.choice([None, day(), day(), rng.choice(starts), rng.choice(starts) - dt.timedelta(seconds=1)]))
              for i in range(600)]
    fact = spark.createDataFrame(events + events[:20], "id int, k string, t timestamp_ntz")
    for how in ["inner", "left"]:
        plain = sorted(map(tuple, join_as_of(fact, dim, "k", "t", ["attr", "n"], how=how, prefix="d_").collect()), key=str)
        assert len(plain) > 100
        for bucket in ["year", "month"]:
            merged = merge_as_of(fact, dim, "k", "t", ["attr", "n"], how=how, prefix="d_", bucket=bucket)
            assert sorted(map(tuple, merged.collect()), key=str) == plain
    assert merge_as_of(fact, dim.limit(0), "k", "t", ["attr"]).count() == 0
    assert merge_as_of(fact.limit(0), dim, "k", "t", ["attr"], how="left").count() == 0
