import pytest
from sales import sale, staging
from starmill.__main__ import parse, place, run
from starmill.sources.csv_files import CsvFolder, write_csv
from starmill.sources.zone import ParquetZone


def test_places(monkeypatch):
    monkeypatch.setenv("CLICKHOUSE_PASSWORD", "secret")
    assert place("csv:/in") == CsvFolder("/in")
    assert place("parquet:s3a://bucket/ods") == ParquetZone("s3a://bucket/ods")
    assert place("postgres://me@host/star").url == "jdbc:postgresql://host:5432/star"
    marts = place("clickhouse://me@host:9000/reports")
    assert (marts.url, marts.user, marts.password) == (
        "jdbc:ch://host:9000/reports", "me", "secret"
    )


def test_unknown_place_is_refused(capsys):
    with pytest.raises(SystemExit):
        parse(["staging", "--source", "ftp:/x", "--target", "parquet:/y"])
    assert "not a place" in capsys.readouterr().err


def test_jobs(spark, tmp_path, capsys):
    write_csv(staging(spark, sale(1), sale(2)), str(tmp_path / "csv"))
    steps = [("staging", "csv", "csv", "parquet", "ods"), ("star", "parquet", "ods", "parquet",
             "star"), ("marts", "parquet", "star", "parquet", "marts")]
    for job, kind, source, target_kind, target in steps:
        counts = run(spark, parse([
            job, "--source", f"{kind}:{tmp_path}/{source}",
            "--target", f"{target_kind}:{tmp_path}/{target}",
        ]))
    assert counts["mart_sales_by_time"] == 1
    run(spark, parse(["preview", "--source", f"parquet:{tmp_path}/star", "--table", "fact_sales"]))
    assert "sale_total_price" in capsys.readouterr().out
