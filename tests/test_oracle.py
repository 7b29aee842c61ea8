"""Registered queries against their DuckDB oracles at sf0.001 (names, types and exact values)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF0001

TABLES = ["customer", "orders", "lineitem", "embeddings"]
NAMES = ["profile_counts", "user_index", "labelled", "batch_assign", "id_buckets", "bag_pooling", "pair_scores",
         "eval_summary", "topk_items", "topk_blocked", "init_model_scores"]
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = [tuple("NaN" if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order) for r in rows]
    return sorted(norm, key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF0001)
    rel = con.sql(E.oracle_sql()[name])
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == \
        {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())
