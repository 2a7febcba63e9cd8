import os

import duckdb
import pytest

import __spark_entry__ as E
from homeward import job
from homeward.catalog import QUERIES
from homeward.oracle import ORACLE_SQL
from test_sources import HEADER


def test_job_counts_and_writes(spark, tmp_path):
    src = tmp_path / "t.csv"
    rows = [
        "1,2016-01-01 00:00:00,2016-01-01 00:10:00,1,1,-73.9,40.7,1,N,-73.95,40.75,1,1,0,0,0,0,0.3,1",
        "1,2016-01-01 02:00:00,2016-01-01 02:10:00,1,1,-73.95,40.75,1,N,-73.9,40.7,1,1,0,0,0,0,0.3,1",
        "1,2016-01-01 02:00:00,2016-01-01 02:10:00,1,1,0,0,1,N,-73.9,40.7,1,1,0,0,0,0,0.3,1",
    ]
    src.write_text("\n".join([HEADER] + rows) + "\n")
    n, _ = job.run(spark, job.parse([str(src)]))
    assert n == 1
    out = str(tmp_path / "pairs")
    n, _ = job.run(spark, job.parse([str(src), "--output", out, "--variant", "distinct"]))
    assert n == 1 and len(spark.read.parquet(out).columns) == 12
    n, _ = job.run(spark, job.parse([str(src), "--stage", str(tmp_path / "stage")]))
    assert n == 1
    n, _ = job.run(spark, job.parse([str(src), "--stage"]))  # the session's checkpoint folder
    assert n == 1
    # the staged copies are gone


    assert not (tmp_path / "stage").exists() or not list((tmp_path / "stage").iterdir())


def test_job_main_prints(spark, tmp_path, capsys, monkeypatch):
    src = tmp_path / "t.csv"
    rows = [
        "1,2016-01-01 00:00:00,2016-01-01 00:10:00,1,1,-73.9,40.7,1,N,-73.95,40.75,1,1,0,0,0,0,0.3,1",
        "1,2016-01-01 02:00:00,2016-01-01 02:10:00,1,1,-73.95,40.75,1,N,-73.9,40.7,1,1,0,0,0,0,0.3,1",
    ]
    src.write_text("\n".join([HEADER] + rows) + "\n")
    stopped = []
    monkeypatch.setattr(type(spark), "stop", lambda self: stopped.append(True))
    assert job.main([str(src)]) == 0
    out = capsys.readouterr().out
    assert "matches: 1\n" in out and "elapsed: " in out and stopped == [True]


def test_staging_wants_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(job, "is_local", lambda s: False)
    for folder in ("/tmp/mine", "file:/tmp/mine", "file:///tmp/mine"):
        with pytest.raises(ValueError):
            job.stage_target(spark, folder)
    assert job.stage_target(spark, "hdfs://name/shared").startswith("hdfs://name/shared/homeward-stage-")
    assert job.stage_target(spark, None)


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert len(df.columns) == 12
    assert df.count() == 123


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


def _duck(sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{sf_dir}/lineitem.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, name):
    from helpers import as_bag

    df = E.queries()[name](spark, sf_dir)
    con = _duck(sf_dir)
    want = con.execute(E.oracle_sql()[name]).df()
    assert sorted(df.columns) == sorted(want.columns)
    assert as_bag(df) == as_bag(want)
