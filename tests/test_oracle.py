"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as registry
from conftest import SF, SF_SMALL

QUERIES = registry.transit_queries()
ORACLE = registry.oracle.statements()
STREAMED = {name for name in QUERIES if name.startswith("stream_")} | {
    "incremental_upsert", "mixed_log_append", "feed_rejects", "project_build", "project_models"
}
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def _sorted(rows):
    plain = [tuple(None if isinstance(v, float) and math.isnan(v) else v for v in row) for row in rows]
    return sorted(plain, key=repr)


def test_registry_is_complete():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_equals_sql(spark, name):
    folder = SF_SMALL if name in STREAMED else SF
    db = duckdb.connect()
    db.sql(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet'")
    df = QUERIES[name](spark, folder)
    expected = db.sql(ORACLE[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == types
    positions = [expected.columns.index(c) for c in columns]
    assert _sorted([tuple(r[c] for c in columns) for r in df.collect()]) == _sorted(
        [tuple(r[i] for i in positions) for r in expected.fetchall()]
    )


def test_entry(spark):
    assert len(registry.entry(spark).collect()) == 242
