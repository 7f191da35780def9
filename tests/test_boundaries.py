"""Queries on small tables made for their boundaries, compared with their SQL."""

import datetime as dt
import itertools
import random

import duckdb

from mereweave import plans

REGISTRY = plans.load()


def both(spark, tmp_path, name, schema, rows, table):
    """The query's rows and the SQL's over one table, lists of tuples by column names."""
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
    con = duckdb.connect()
    con.execute(f"create view {table} as select * from '{tmp_path}/{table}.parquet/*.parquet'")
    df = REGISTRY.QUERIES[name](spark, str(tmp_path))
    columns = sorted(df.columns)
    found = con.execute(f"select {', '.join(columns)} from ({REGISTRY.ORACLES[name]}) t").fetchall()
    return sorted(map(repr, map(tuple, df.select(*columns).collect()))), sorted(map(repr, found))


def test_scores_at_the_limit_are_those_of_the_sql(spark, tmp_path):
    rows = [(k, turn, "user", "x" + "," * n) for k, some in enumerate(itertools.product(range(20), repeat=2)) for turn, n in enumerate(some)]
    got, want = both(spark, tmp_path, "agg_43_style_score", "conv_id long, turn int, role string, text string", rows, "conversations")
    assert got == want


def test_a_gap_of_two_hours_begins_a_session(spark, tmp_path):
    at = lambda user, k, seconds: (k, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds), user, "view", 1.0, "{}")
    rows = [at(1, 0, 0), at(1, 1, 7199), at(1, 2, 14399.9), at(2, 3, 0), at(2, 4, 7200), at(2, 5, 14401), at(3, 6, 0.9), at(3, 7, 7200.1), at(3, 8, 7200.2)]
    got, want = both(spark, tmp_path, "stm_11_debounce", "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string", rows, "events")
    assert got == want and len(got) == 7


def test_components_settle_in_few_rounds_in_any_order(spark):
    from mereweave.operators import kg

    order = [f"n{k:03d}" for k in range(300)]
    random.Random(1).shuffle(order)
    e = spark.createDataFrame([*itertools.pairwise(order), ("z", "y"), (None, "y")], "a string, b string")
    for many in (100_000, 1):  # every node is one of many edges
        out = {r.node: r.component for r in kg.components(e, most_rounds=12, many=many).collect()}
        assert out == dict.fromkeys(order, "n000") | {"z": "y", "y": "y"}
