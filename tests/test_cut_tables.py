"""Tables that end within an asset: the last faces name vertices that have no row."""

import duckdb
import pytest
from test_queries import rows

from facetforge.plans import load

QUERIES, ORACLES = load()


@pytest.mark.parametrize("name", ["q_face_shapes", "q_usable_parts", "q_removed_mesh", "q_ab_demo"])
def test_faces_with_a_missing_vertex(spark, sf_dir, tmp_path, name):
    con = duckdb.connect()
    con.execute(f"COPY (SELECT * FROM '{sf_dir}/embeddings.parquet' WHERE vec_id < 152) TO '{tmp_path}/embeddings.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet'")
    frame = QUERIES[name](spark, str(tmp_path))
    got = con.execute(ORACLES[name])
    assert rows(frame.columns, [tuple(r) for r in frame.collect()]) == rows([d[0] for d in got.description], got.fetchall())


@pytest.mark.parametrize("name", ["q_nn_isolation"])
def test_growing_tables_are_not_broadcast(spark, sf_dir, name):
    """Even where all sides are small: a broadcast goes through the driver, and grows with the input."""
    assert "Broadcast" not in QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, rest", [("q_chain", 195), ("q_nn_isolation", 123)])
def test_the_last_faces_with_a_missing_vertex(spark, sf_dir, tmp_path, name, rest):
    """A face that isn't whole holds no vertex of a chain's state, but counts as one of its body."""
    con = duckdb.connect()
    con.execute(f"COPY (SELECT * FROM '{sf_dir}/embeddings.parquet' WHERE vec_id < {rest}) TO '{tmp_path}/embeddings.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet'")
    frame = QUERIES[name](spark, str(tmp_path))
    got = con.execute(ORACLES[name])
    assert rows(frame.columns, [tuple(r) for r in frame.collect()]) == rows([d[0] for d in got.description], got.fetchall())
