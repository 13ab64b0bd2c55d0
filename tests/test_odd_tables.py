"""Queries against their SQL over small tables of keys, ties and nulls that the given tables don't have."""

import duckdb

from tests.parity import assert_equal
from tidemark.plans import ORACLE_SQL, QUERIES


def check(spark, folder, name, **tables):
    """tables: the SELECT that makes each of them."""
    con = duckdb.connect()
    for t, sql in tables.items():
        con.sql(f"COPY ({sql}) TO '{folder}/{t}.parquet'")
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    assert_equal(spark, con, str(folder), QUERIES[name], ORACLE_SQL[name])


def test_best_verified_with_large_order_keys(spark, tmp_path):
    """Beyond a million, an order's key outweighs its size; rows without a customer or a price count, too."""
    orders = """SELECT * FROM (VALUES (1, 9000000, 'F', 10.0), (1, 5, 'F', 18.0), (1, 6, 'O', 18.4), (1, 7000000, 'O', 12.0),
      (2, 1000001, 'F', 3.0), (2, 1, 'F', 4.0), (3, 4, 'O', 1.0), (3, 5, 'F', NULL), (NULL, 6, 'O', 2.0), (NULL, 7, 'F', 2.0), (4, 8, NULL, 2.0)) t(o_custkey, o_orderkey, o_orderstatus, o_totalprice)"""
    check(spark, tmp_path, "best_verified", orders=f"SELECT o_custkey::BIGINT AS o_custkey, o_orderkey::BIGINT AS o_orderkey, o_orderstatus, o_totalprice::DOUBLE AS o_totalprice FROM ({orders})")


def test_gather_by_index_settles_ties_by_the_file(spark, tmp_path):
    """Lines of one number are in the order of the file, whatever order they are read and shuffled in; an index can be
    negative, a number or a key null."""
    lines = "SELECT (i * 7919 % 5000)::BIGINT AS l_orderkey, (i * 31 % 100000)::BIGINT AS l_partkey, 1 + (i % 2)::INTEGER AS l_linenumber FROM range(60000) t(i)"
    odd = "SELECT * FROM (VALUES (-2::BIGINT, 5::BIGINT, 2::INTEGER), (-2, 6, NULL), (-2, 7, 1), (-1, 8, 1), (7, NULL, 0), (NULL, 9, 1)) t"
    con = duckdb.connect()
    con.sql(f"COPY ({lines} UNION ALL {odd}) TO '{tmp_path}/lineitem.parquet' (ROW_GROUP_SIZE 4096)")
    read = f"(SELECT * FROM read_parquet('{tmp_path}/lineitem.parquet', file_row_number = true))"
    sql = ORACLE_SQL["gather_by_index"].replace("ORDER BY l_linenumber", "ORDER BY l_linenumber, file_row_number").replace("FROM lineitem", f"FROM {read}")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60000")
    try:
        assert_equal(spark, con, str(tmp_path), QUERIES["gather_by_index"], sql)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_dominance_of_many_items_in_a_nation(spark, tmp_path):
    """Forty thousand items of one nation are 800 million pairs; keys can be repeated, other columns null."""
    odd = "SELECT * FROM (VALUES (7::BIGINT, 1::BIGINT, 0.5), (7, 2, 0.4), (3, 2, 9.0), (9, NULL, 1.0), (NULL, 2, 1.0), (11, 2, NULL)) t"
    few = f"SELECT * FROM ({odd}) u(c_custkey, c_nationkey, c_acctbal) UNION ALL SELECT i % 700, i % 2 + 1, (i * 7919 % 1000 - 300)::DOUBLE FROM range(1500) t(i)"
    check(spark, tmp_path, "dominance", customer=few)
    duckdb.sql(f"COPY (SELECT i AS c_custkey, 1::BIGINT AS c_nationkey, (i * 104729 % 99991)::DOUBLE AS c_acctbal FROM range(40000) t(i)) TO '{tmp_path}/customer.parquet'")
    found = QUERIES["dominance"](spark, str(tmp_path))
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() > 39_000


def test_knn2_ratio_of_copies_ties_and_missing_vectors(spark, tmp_path, monkeypatch):
    """Copies, vectors that are equally far, labels of one row, and rows without a vector; in many small parts."""
    from tidemark.operators import align

    monkeypatch.setattr(align, "CHUNK", 16)
    spread = "SELECT i AS vec_id, (i % 3)::INTEGER AS label, [sin(i * 12.9 % 71)::FLOAT, cos(i * 78.2 % 53)::FLOAT, (i % 5)::FLOAT] AS embedding FROM range(400) t(i)"
    grid = "SELECT 1000 + i, 7, [(i % 9)::FLOAT, (i // 9)::FLOAT, 0::FLOAT] FROM range(81) t(i)"
    copies = "SELECT 2000 + i, 8, [(i // CASE WHEN i < 20 THEN 2 ELSE 7 END)::FLOAT, 1::FLOAT, (i // 20)::FLOAT] FROM range(60) t(i)"
    odd = "SELECT * FROM (VALUES (3000, 9, [1.0::FLOAT, 2, 3]), (3001, NULL, [1.0::FLOAT, 2, 3]), (3002, 10, NULL), (3003, 10, [1.0::FLOAT, 2, 3]), (3004, 10, [1.0::FLOAT, 2, 4]), (3005, 10, [1.0::FLOAT, 2, 9])) t"
    check(spark, tmp_path, "knn2_ratio", embeddings=" UNION ALL ".join([spread, grid, copies, odd]))


def test_nearest_vectors_are_found_without_all_pairs(spark, tmp_path):
    many = "SELECT i AS vec_id, 1 AS label, [(i * 7919 % 10007)::FLOAT, (i * 104729 % 9973)::FLOAT] AS embedding FROM range(2500) t(i)"
    check(spark, tmp_path, "knn2_ratio", embeddings=many)
    plan = QUERIES["knn2_ratio"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroups" in plan and not any("Join" in line and "label" in line for line in plan.splitlines())
