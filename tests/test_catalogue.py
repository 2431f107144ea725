"""Every query against its SQL on DuckDB."""

import duckdb
import pandas as pd
import pytest

from quillstream.plans import catalogue, files  # noqa: F401

TABLES = "documents conversations benchmark labels events part".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows(frame: pd.DataFrame):
    return sorted(repr([v.item() if hasattr(v, "item") else v for v in r]) for r in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    got, want = catalogue.QUERIES[name](spark, sf_dir).toPandas(), duck.sql(catalogue.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_json_files_of_many_texts_follow_the_places_of_the_sql(spark, tmp_path):
    """Beyond 10,000 texts a file's places run on among the next file's; at one place sentence and word decide."""
    said = {0: "cd gh.jk lm", 5000: "b.bc fg", 5100: "cd fg", 5101: "jk gh"}
    first = [(5 * i, 0, "user", said.get(i, "b")) for i in range(5102)]
    second = [(5 * i + 1, 0, "user", {0: "bc hd", 1: "cd hd. jk hd"}.get(i, "b")) for i in range(20)]
    spark.createDataFrame(first + second, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"file://{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    name = "json_files_transitions_bn"
    got, want = catalogue.QUERIES[name](spark, f"file://{tmp_path}").toPandas(), con.sql(catalogue.ORACLE[name]).df()
    assert len(want) == 9
    assert rows(got) == rows(want)
