import re

import __spark_entry__ as entry
from lithosense.llm.queries import ORACLES, QUERIES


def test_every_operator_has_one_query():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_chat_matches_sql(spark, sf):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    got = QUERIES["op7_chat"](spark, sf).toPandas()
    want = con.execute(ORACLES["op7_chat"]).df()
    names = sorted(want.columns)
    assert sorted(got.columns) == names
    got, want = (df[names].sort_values("conv_id").reset_index(drop=True) for df in (got, want))
    assert got.equals(want)


def test_placement_and_tokens_cover_the_table(spark, sf):
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert QUERIES["op2_sharding"](spark, sf).count() == n
    assert QUERIES["op5_bpe"](spark, sf).filter("n_tokens >= 0").count() == n
