"""The queries of llm/ that SQL can express, against their twins on the same files."""

from __future__ import annotations

import duckdb
import pytest

from kpiweave.llm.oracle import ORACLE
from kpiweave.llm.queries import QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("key", list(ORACLE))
def test_matches_twin(spark, sf_dir, key):
    duck = duckdb.connect()
    for name in TABLES:
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    twin = duck.execute(ORACLE[key])
    names = [d[0] for d in twin.description]
    expected = sorted(map(repr, twin.fetchall()))
    df = QUERIES[key](spark, sf_dir)
    assert sorted(df.columns) == sorted(names)
    assert sorted(repr(tuple(r)) for r in df.select(*names).collect()) == expected
