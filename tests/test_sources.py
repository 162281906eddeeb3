from decimal import Decimal
from pathlib import Path

import __spark_entry__
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sales import sale, staging, tuples
from starmill.plans.jobs import load_marts, load_staging, load_star
from starmill.plans.marts import MARTS, build_mart
from starmill.schemas import MART_ORDER, STAGING_TABLE, staging_schema
from starmill.sources import stage
from starmill.sources.csv_files import PACKED, CsvFolder, read_csv, write_csv
from starmill.sources.jdbc import clickhouse, clickhouse_definition, postgres
from starmill.sources.stage import SHARED_MOUNT, stage_folder
from starmill.sources.zone import ParquetZone

ITEM = (
    T.StructType().add("id", "integer").add("sale_date", "string").add("price", "decimal(10,2)")
    .add("zip", "string").add("d", "string")
)


def folder(tmp_path, **files):
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text, newline="")
    return str(tmp_path)


def test_csv_keeps_newlines_quotes_and_zeros(spark, tmp_path):
    path = folder(tmp_path, a=(
        'id,sale_date,price,zip,d\n1,1/2/2021,10.50,00123,"say ""hi""\nnext, line"\n'
    ))
    assert read_csv(spark, path, ITEM).collect() == [
        (1, "1/2/2021", Decimal("10.50"), "00123", 'say "hi"\nnext, line')
    ]


def test_csv_columns_are_found_by_name_in_every_file(spark, tmp_path):
    path = folder(
        tmp_path,
        a="zip,id,price,d,sale_date,extra\n01,1,1.00,x,1/1/2021,e\n",
        b="zip,id,price,d,sale_date,extra\n02,2,,,,\n",
    )
    assert tuples(read_csv(spark, path, ITEM), "id", "zip", "price", "d") == [
        (1, "01", Decimal("1.00"), "x"), (2, "02", None, None)
    ]


def test_csv_value_that_does_not_fit_fails(spark, tmp_path):
    path = folder(tmp_path, a="id,sale_date,price,zip,d\nx,1/1/2021,1.00,1,d\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        read_csv(spark, path, ITEM).collect()


def test_csv_without_a_column_fails(spark, tmp_path):
    path = folder(tmp_path, a="id,price\n1,2.00\n")
    with pytest.raises(ValueError, match="sale_date, zip"):
        read_csv(spark, path, ITEM)


def test_csv_roundtrip_of_difficult_text(spark, tmp_path):
    rows = staging(
        spark, sale(1, customer_first_name=' "a", \\ \n b '), sale(2, pet_category=None),
        sale(4, customer_postal_code="00123"),
    )
    assert write_csv(rows, str(tmp_path / "out")) == 3
    back = read_csv(spark, str(tmp_path / "out"), staging_schema())
    assert tuples(back, "*") == tuples(rows, "*")


def test_csv_has_no_empty_text(spark, tmp_path):
    write_csv(staging(spark, sale(1, pet_category="")), str(tmp_path / "out"))
    back = read_csv(spark, str(tmp_path / "out"), staging_schema())
    assert tuples(back, "id", "pet_category") == [(1, None)]


def test_packed_csv_is_read_like_plain_csv(spark, tmp_path, monkeypatch):
    texts = (' "a", \\ \n b ', 'x\r', '"', ",\n\n,", "plain", None)
    rows = staging(spark, *[sale(k, customer_first_name=texts[k % 6], product_name=texts[k % 5]) for k in range(60)])
    monkeypatch.setitem(PACKED, "maxRecordsPerFile", 7)
    assert write_csv(rows.coalesce(1), str(tmp_path / "out"), packed=True) == 60
    assert len(list((tmp_path / "out").glob("*.csv.gz"))) == 9
    assert tuples(read_csv(spark, str(tmp_path / "out"), staging_schema()), "*") == tuples(rows, "*")


def staged_bytes(made, monkeypatch, path):
    """Bytes of what a query stages as CSV."""
    monkeypatch.setattr(__spark_entry__, "new_stage_path", lambda _, name: str(path / name))
    made()
    return sum(f.stat().st_size for f in path.rglob("part-*"))


def test_csv_roundtrip_stages_less_than_a_third_of_the_text(spark, ws, tmp_path, monkeypatch):
    plain = write_csv(ws.staging, str(tmp_path / "plain")) and sum(f.stat().st_size for f in (tmp_path / "plain").glob("part-*"))
    assert staged_bytes(lambda: __spark_entry__.csv_roundtrip(ws), monkeypatch, tmp_path / "staged") * 3 < plain


@pytest.mark.parametrize("name", ["csv_rejects", "audit_precision"])
def test_planted_csv_takes_less_than_a_third_of_the_text(spark, ws, tmp_path, monkeypatch, name):
    plain = write_csv(ws.staging, str(tmp_path / "plain")) and sum(f.stat().st_size for f in (tmp_path / "plain").glob("part-*"))
    assert staged_bytes(lambda: getattr(__spark_entry__, name)(ws), monkeypatch, tmp_path / "staged") * 3 < plain


def test_zone_shows_the_last_load(spark, tmp_path):
    zone = ParquetZone(str(tmp_path))
    one, two = staging(spark, sale(1)), staging(spark, sale(1), sale(2))
    assert zone.write_tables({STAGING_TABLE: one}) == {STAGING_TABLE: 1}
    before = zone.read(spark, STAGING_TABLE)
    assert zone.write_tables({STAGING_TABLE: two}) == {STAGING_TABLE: 2}
    assert before.count() == 1 and zone.read(spark, STAGING_TABLE).count() == 2
    zone.write_tables({STAGING_TABLE: one}, mode="append")
    zone.write_tables({STAGING_TABLE: one}, mode="append")
    assert zone.read(spark, STAGING_TABLE).count() == 4
    zone.write_tables({STAGING_TABLE: two})
    assert zone.read(spark, STAGING_TABLE).count() == 2
    with pytest.raises(ValueError, match="no table"):
        zone.read(spark, "fact_sales")
    with pytest.raises(ValueError, match="mode"):
        zone.write_tables({STAGING_TABLE: one}, mode="ignore")


def test_zone_is_unchanged_by_a_load_that_breaks_off(spark, tmp_path):
    zone = ParquetZone(str(tmp_path))
    good = staging(spark, sale(1))
    zone.write_tables({STAGING_TABLE: good})
    bad = staging(spark, sale(2)).withColumn("id", F.raise_error(F.lit("stop")).cast("long"))
    with pytest.raises(Exception, match="stop"):
        zone.write_tables({STAGING_TABLE: bad})
    assert tuples(zone.read(spark, STAGING_TABLE), "id") == [(1,)]


def test_marts_are_stored_in_the_order_of_their_key(spark, ws, conf, tmp_path):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    zone = ParquetZone(str(tmp_path))
    name = "mart_sales_by_customer"
    zone.write_tables({name: ws.mart(name)}, sort_by=MART_ORDER)
    stored = zone.read(spark, name)
    files = stored.groupBy(F.input_file_name()).agg(
        F.min("customer_id").alias("low"), F.max("customer_id").alias("high")
    ).orderBy("low").collect()
    assert len(files) > 1
    assert all(a["high"] < b["low"] for a, b in zip(files, files[1:]))
    in_file = stored.select(F.input_file_name().alias("f"), "customer_id").collect()
    for path in {r["f"] for r in in_file}:
        keys = [r["customer_id"] for r in in_file if r["f"] == path]
        assert keys == sorted(keys)


def test_jobs_from_csv_to_marts_can_be_repeated(spark, ws, tmp_path):
    csv, ods, star, marts = (str(tmp_path / n) for n in ("csv", "ods", "star", "marts"))
    write_csv(ws.staging, csv)
    for _ in range(2):
        assert load_staging(spark, CsvFolder(csv), ParquetZone(ods)) == {STAGING_TABLE: 6000}
        counts = load_star(spark, ParquetZone(ods), ParquetZone(star))
        assert list(counts)[-1] == "fact_sales" and counts["fact_sales"] == 6138
        load_marts(spark, ParquetZone(star), ParquetZone(marts))
    assert tuples(ParquetZone(star).read(spark, "fact_sales"), "*") == tuples(ws.fact, "*")
    for name in MARTS:
        stored = ParquetZone(marts).read(spark, name)
        assert tuples(stored, "*") == tuples(build_mart(name, ws.star), "*"), name


def test_star_from_a_csv_folder(spark, tmp_path):
    write_csv(staging(spark, sale(1), sale(2)), str(tmp_path / "in"))
    counts = load_star(spark, CsvFolder(str(tmp_path / "in")), CsvFolder(str(tmp_path / "out")))
    assert counts["fact_sales"] == 2
    fact = CsvFolder(str(tmp_path / "out" / "fact_sales")).read(spark, "fact_sales")
    assert tuples(fact, "sale_id", "customer_id") == [(1, 1), (2, 1)]


def test_strict_grain_job(spark, tmp_path):
    write_csv(staging(spark, sale(1), sale(2, customer_age=9)), str(tmp_path / "in"))
    source, zone = CsvFolder(str(tmp_path / "in")), ParquetZone(str(tmp_path / "star"))
    assert load_star(spark, source, zone)["fact_sales"] == 4
    assert load_star(spark, source, zone, strict_grain=True)["fact_sales"] == 2


def test_postgres_options():
    db = postgres("host", 5432, "star", "me", "secret")
    assert "secret" not in repr(db)
    table = db.table_options("dim_store")
    assert table["url"] == "jdbc:postgresql://host:5432/star"
    assert table["driver"] == "org.postgresql.Driver"
    # An overwrite empties the table and what refers to it, and keeps the definitions.
    assert table["truncate"] is True and table["cascadeTruncate"] is True
    assert db.bounds_options("t", "id")["query"] == "SELECT min(id) AS low, max(id) AS high FROM t"


def test_reads_are_split_over_connections():
    db = clickhouse("host", 8123, "reports", "me", "secret")
    split = db.read_options("fact_sales", "sale_id", 0, 999)
    assert split["url"] == "jdbc:ch://host:8123/reports"
    assert (split["lowerBound"], split["upperBound"], split["numPartitions"]) == (0, 1000, 16)
    assert db.read_options("t", "id", 5, 7)["numPartitions"] == 3
    assert "numPartitions" not in db.read_options("t", "id", None, None)
    assert "cascadeTruncate" not in db.table_options("t")


def test_clickhouse_keeps_engine_and_sort_key(spark):
    db = clickhouse("host", 8123, "reports", "me", "secret")
    for mart, keys in MART_ORDER.items():
        options = db.table_options(mart)
        assert options["createTableOptions"].startswith("ENGINE = MergeTree() ORDER BY ")
        assert all(k in options["createTableOptions"] for k in keys) and "truncate" not in options
        assert clickhouse_definition(mart, "reports").endswith(options["createTableOptions"])
    assert "ORDER BY (year, month)" in db.table_options("mart_sales_by_time")["createTableOptions"]
    with pytest.raises(ValueError, match="append"):
        db.write_tables({"mart_sales_by_time": None}, "overwrite")


def test_what_spark_truncates(spark):
    """An upgrade that changes these answers is noticed here."""
    dialects = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects
    answer = lambda db: dialects.get(db.url).isCascadingTruncateTable()
    assert answer(postgres("h", 1, "d", "u", "p")).get() is False
    assert answer(clickhouse("h", 1, "d", "u", "p")).isEmpty()


def test_stage_folder_is_the_shared_one(spark):
    assert stage_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_a_folder_of_each_machine_is_refused_on_a_cluster(spark):
    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, name, default=None):
            return self.values.get(name, default)

    class Cluster:
        sparkContext = spark.sparkContext

        def __init__(self, folder, **more):
            self.conf = Conf(**{"spark.master": "yarn", "spark.checkpoint.dir": folder, **more})

    for folder in ("/tmp/somewhere", "file:///tmp/somewhere"):
        with pytest.raises(RuntimeError, match="disk of each machine"):
            stage_folder(Cluster(folder))
        assert stage_folder(Cluster(folder, **{SHARED_MOUNT: "true"})) == folder
    assert stage_folder(Cluster("hdfs://n/x/")) == "hdfs://n/x"
    with pytest.raises(RuntimeError, match="set spark.checkpoint.dir"):
        stage_folder(Cluster(None))


def test_a_mount_that_all_machines_share_is_used_on_a_cluster(spark, conf):
    conf("spark.master", "spark://host:7077")
    staged, n = stage.stage(spark.range(10), "ten")
    assert n == staged.count() == 10
    assert all(spark.conf.get("spark.checkpoint.dir") in file for file in staged.inputFiles())


def test_the_warehouse_is_used_on_a_cluster_without_a_checkpoint_folder(spark, conf, tmp_path):
    class Conf:
        def get(self, name, default=None):
            own = {"spark.checkpoint.dir": default, "spark.sql.warehouse.dir": str(tmp_path)}
            return own[name] if name in own else spark.conf.get(name, default)

    class Cluster:
        sparkContext, range, read, conf = spark.sparkContext, spark.range, spark.read, Conf()

    conf("spark.master", "spark://host:7077")
    assert stage_folder(Cluster()) == str(tmp_path)


def test_a_folder_that_does_not_give_back_what_tasks_write_is_refused(spark, conf, monkeypatch):
    conf("spark.master", "spark://host:7077")
    stage._is_shared.cache_clear()
    # What the tasks of another machine wrote is not there.
    read = stage._read_back
    monkeypatch.setattr(stage, "_read_back", lambda rows, path: read(rows.filter("id <> 3"), path))
    with pytest.raises(RuntimeError, match="disk of each machine"):
        stage_folder(spark)
    stage._is_shared.cache_clear()


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {file for file in files.split("\n") if "/shuffle_" in file}


@pytest.mark.parametrize("write", [lambda df: stage.stage(df, "sums")[0], lambda df: stage.write_once(df, "sums")])
def test_a_staged_table_leaves_no_shuffle_files(spark, write):
    option = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, own = shuffle_files(spark), spark.conf.get(option, None)
    sums = spark.range(10_000).repartition(5, "id").groupBy((F.col("id") % 100).alias("k")).agg(F.sum("id").alias("s"))
    staged = write(sums)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(option, None) == own
    # Neither the table nor the rows it was made of need them.
    expected = {(k, sum(range(k, 10_000, 100))) for k in range(100)}
    assert set(tuples(staged, "k", "s")) == set(tuples(sums, "k", "s")) == expected


def test_what_a_load_stages_is_in_one_folder(spark, tmp_path):
    write_csv(staging(spark, sale(1), sale(2)), str(tmp_path / "in"))
    done = load_star(spark, CsvFolder(str(tmp_path / "in")), ParquetZone(str(tmp_path / "star")))
    staged = Path(done.staged)
    assert staged.is_relative_to(stage_folder(spark))
    assert len(list(staged.iterdir())) >= 8
    assert spark.sparkContext.getLocalProperty("starmill.stage") is None


def test_a_star_is_not_appended_to(spark, tmp_path):
    source, zone = CsvFolder(str(tmp_path / "in")), ParquetZone(str(tmp_path / "star"))
    write_csv(staging(spark, sale(1), sale(2)), str(tmp_path / "in"))
    load_star(spark, source, zone)
    with pytest.raises(ValueError, match="replaced as a whole"):
        load_star(spark, source, zone, mode="append")
    assert zone.read(spark, "fact_sales").count() == 2


def test_repeated_ids_are_refused(spark, tmp_path):
    write_csv(staging(spark, sale(1), sale(1), sale(3)), str(tmp_path / "in"))
    with pytest.raises(ValueError, match="1 of 3 sales"):
        load_star(spark, CsvFolder(str(tmp_path / "in")), ParquetZone(str(tmp_path / "star")))


def test_one_of_two_loads_with_one_number_wins(spark, tmp_path, monkeypatch):
    zone = ParquetZone(str(tmp_path))
    zone.write_tables({STAGING_TABLE: staging(spark, sale(7), sale(8), sale(9))})
    monkeypatch.setattr(ParquetZone, "_next_load", lambda self, spark: 2)
    for n in (1, 2):
        zone.write_tables({STAGING_TABLE: staging(spark, sale(n))})
    assert len(tuples(zone.read(spark, STAGING_TABLE), "id")) == 1
    zone.write_tables({STAGING_TABLE: staging(spark, sale(3))}, mode="append")
    assert (3,) in tuples(zone.read(spark, STAGING_TABLE), "id")


def test_marts_from_a_star_kept_as_csv(spark, tmp_path):
    places = [CsvFolder(str(tmp_path / n)) for n in ("in", "star", "marts")]
    write_csv(staging(spark, sale(1), sale(2)), places[0].path)
    assert load_star(spark, places[0], places[1])["fact_sales"] == 2
    counts = load_marts(spark, places[1], places[2])
    assert set(counts) == set(MARTS)
    assert places[2].read(spark, "mart_sales_by_time").count() == 1
