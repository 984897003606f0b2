import pytest

from frames import rows
from test_runs import CSV
from tillworks import cli


def test_jobs(spark, store, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(CSV)
    root = ["--root", store.root]
    assert cli.main(["run", "--source", str(tmp_path / "in"), "--as-of", "2011-02-01", *root]) == 0
    assert cli.main(["months", "--dry-run", *root]) == 0
    assert "pending ['2010-12', '2011-01']" in capsys.readouterr().out
    assert cli.main(["months", "--year", "2010", *root]) == 0
    assert cli.main(["months", *root]) == 0
    assert "processed ['2011-01']" in capsys.readouterr().out
    assert cli.main(["months", "--reset", *root]) == 0
    assert store.read("ops.processed_months").count() == 0
    assert cli.main(["marts", "--run-id", "r1", *root]) == 0
    assert rows(store.read("ops.pipeline_checkpoint").select("run_id").distinct()) == [("r1",)]


def test_a_failed_check_is_an_error_code(spark, store, tmp_path):
    bad = CSV.replace("1,B2,beta,2,01/12/2010 8:26,1.00,17850,UK", "1,B2,beta,2,01/12/2010 8:26,1.00,guest,UK")
    (tmp_path / "bad.csv").write_text(bad)
    assert cli.main(["run", "--source", str(tmp_path / "bad.csv"), "--root", store.root]) == 1


def test_stream_job(spark, store, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(CSV)
    job = ["stream", "--landing", str(tmp_path / "in"), "--checkpoint", str(tmp_path / "mark"), "--root", store.root]
    for _ in range(2):
        assert cli.main(job) == 0
    assert store.read("bronze.raw_transactions").count() == 4
    assert store.read("gold.fact_sales_monthly").count() == 2


def test_workbooks_as_source(spark, store, tmp_path):
    from tillworks import schemas
    from tillworks.sources.workbooks import write_workbooks

    text = [line.split(",") for line in CSV.splitlines()]
    df = spark.createDataFrame([[v or None for v in line] for line in text[1:]], schemas.SOURCE_FILE).coalesce(1)
    write_workbooks(df, str(tmp_path / "in"), sheet_rows=3)
    job = ["run", "--source", str(tmp_path / "in"), "--format", "xlsx", "--as-of", "2011-02-01", "--root", store.root]
    assert cli.main([*job, "--all-sheets"]) == 0
    assert store.read("bronze.raw_transactions").count() == 4


def test_arguments():
    with pytest.raises(SystemExit):
        cli.main(["months", "--month", "13", "--root", "x"])
    with pytest.raises(SystemExit):
        cli.main([])
