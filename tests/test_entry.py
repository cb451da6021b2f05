import importlib
from pathlib import Path

import pytest

SMALL = Path("/root/testdata/sf0.001")


def test_every_query_has_a_twin_or_a_reason():
    entry = importlib.import_module("__spark_entry__")
    queries, twins = entry.queries(), entry.oracle_sql()
    from workload import QUERIES

    assert set(QUERIES) - set(twins) == {"mice"}
    assert set(twins) <= set(queries)


@pytest.mark.skipif(not SMALL.exists(), reason="no test tables")
def test_queries_equal_their_twins(spark):
    """A sample of cheap queries against DuckDB on the smallest tables; the driver runs them all."""
    import duckdb

    entry = importlib.import_module("__spark_entry__")
    assert entry.entry(spark).count() == 6
    con = duckdb.connect()
    for path in SMALL.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")

    def plain(v):
        return round(v, 9) if isinstance(v, float) else v

    for name in ("uniqueness", "fk_exact", "interval_violations", "contains_left", "expand_columns",
                 "quantiles_99", "g3_scores", "survivors", "coherence_numeric", "two_branch_avg"):
        df = entry.queries()[name](spark, str(SMALL))
        columns = sorted(df.columns)
        cursor = con.execute(entry.oracle_sql()[name])
        names = [d[0] for d in cursor.description]
        want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=repr)
        got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
        assert sorted(names) == columns and got == want, name
