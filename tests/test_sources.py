import os

import pytest
from conftest import bag
from pyspark.sql import functions as F

from loadkit.schema import SCHEMAS
from loadkit.sources import publish_csv, read_csv, read_extract, read_inferred, read_query, read_table, read_tagged, read_tsv, register_views, run_sql_file, write_csv


def test_tsv_reads_blank_and_na_as_missing(spark, tmp_path):
    names = SCHEMAS["forecast_file"].names
    row = ["50000766", "50000767", "Arts", "", "NA", "UG", "CLAYTON", "", "IN", "Y", "2", "24092019", "1.2500"]
    path = tmp_path / "forecast.txt"
    path.write_text("\t".join(names) + "\n" + "\t".join(row) + "\n")
    got = read_tsv(spark, str(path), SCHEMAS["forecast_file"]).first()
    assert got.TEACHING_FACULTY == "50000766" and got.FUND_SOURCE is None
    assert got.FUND_SOURCE_DESCRIPTION is None and got.SUA_LOCATION_CODE is None
    assert str(got.REPORTED_FORECAST_TAUGHT_LOAD) == "1.2500"


def test_csv_with_spaces_in_names(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text('Month,Faculty,Bucket Forecast Row #,Course Code Row #,Course Code:Bucket Workload Ratio\n'
                    'June,"Arts, Design",10,30,3.0\nJuly,Law,NA,,1.5\n')
    assert bag(read_csv(spark, str(path), SCHEMAS["workload_rows"])) == [
        ("July", "Law", None, None, 1.5), ("June", "Arts, Design", 10, 30, 3.0)]


def test_extract_reads_bad_numbers_as_missing(spark, tmp_path):
    path = tmp_path / "extract.csv"
    path.write_text("REFERENCE_YEAR,FACULTY,EXTRA,REPORTED_FORECAST_TAUGHT_LOAD\n2018,Arts,x,1.5\nTotal,Law,y,n/a\n")
    rest = [n for n in SCHEMAS["bucket_forecast"].names if n not in ("REFERENCE_YEAR", "FACULTY", "REPORTED_FORECAST_TAUGHT_LOAD")]
    with pytest.raises(ValueError, match="UNIT_MODE"):
        read_extract(spark, str(path), SCHEMAS["bucket_forecast"], [n for n in rest if n != "UNIT_MODE"])
    out = read_extract(spark, str(path), SCHEMAS["bucket_forecast"], rest)
    assert out.schema == SCHEMAS["bucket_forecast"]
    assert bag(out, "REFERENCE_YEAR", "FACULTY", "UNIT_MODE", "REPORTED_FORECAST_TAUGHT_LOAD") == [
        (2018, "Arts", None, 1.5), (None, "Law", None, None)]


@pytest.mark.parametrize("given, year", [("2018", 2018), ("2018.0", 2018), ("2018.5", None), ("Total", None), ("", None)])
def test_extract_years(spark, tmp_path, given, year):
    path = tmp_path / "extract.csv"
    path.write_text(f"REFERENCE_YEAR,FACULTY\n{given},Arts\n")
    out = read_extract(spark, str(path), SCHEMAS["bucket_forecast"], SCHEMAS["bucket_forecast"].names)
    assert out.first().REFERENCE_YEAR == year
    stored = str(tmp_path / "stored.parquet")
    spark.sql("SELECT 2018.0D AS REFERENCE_YEAR UNION ALL SELECT 2018.5D").write.parquet(stored)
    again = read_extract(spark, stored, SCHEMAS["bucket_forecast"], SCHEMAS["bucket_forecast"].names)
    assert bag(again, "REFERENCE_YEAR") == [(2018,), (None,)]


def test_tagged_files_with_repeated_labels(spark, tmp_path):
    files = []
    for i, label in enumerate(["March", "March", "June"]):
        path = str(tmp_path / f"f{i}.parquet")
        spark.range(1).select(F.lit(2018).alias("REFERENCE_YEAR"), F.lit(f"fac{i}").alias("FACULTY")).write.parquet(path)
        files.append((label, path))
    out = read_tagged(spark, files, SCHEMAS["bucket_forecast"], optional=SCHEMAS["bucket_forecast"].names)
    assert bag(out, "FCAST_MONTH", "FACULTY") == [("June", "fac2"), ("March", "fac0"), ("March", "fac1")]


def test_sql_file_with_parameters(spark, tmp_path, frame):
    register_views({"load_rows": frame("y int, v int", (2018, 1), (2019, 2))})
    path = tmp_path / "q.sql"
    path.write_text("SELECT v FROM load_rows WHERE y = :y;\n")
    assert bag(run_sql_file(spark, str(path), {"y": 2019})) == [(2,)]


@pytest.mark.parametrize("na", ["NA", ""])
def test_csv_sink_writes_missing_as_asked(spark, tmp_path, frame, na):
    df = frame("k string, v decimal(18,4)", ("a", None), (None, None)).withColumn("w", F.lit("0.5").cast("decimal(18,4)"))
    path = str(tmp_path / "out")
    write_csv(df, path, na=na, single_file=True)
    part = next(f for f in os.listdir(path) if f.startswith("part-"))
    text = (tmp_path / "out" / part).read_text().splitlines()
    assert text == ["k,v,w", f"a,{na},0.5", f"{na},{na},0.5"]


class FakeReader:
    def __init__(self):
        self.options, self.kind, self.loaded = {}, None, False

    def format(self, kind):
        self.kind = kind
        return self

    def option(self, key, value):
        self.options[key] = value
        return self

    def load(self):
        self.loaded = True
        return self


class FakeSpark:
    @property
    def read(self):
        return FakeReader()


def test_database_reader_options():
    got = read_query(FakeSpark(), "jdbc:x", "SELECT 1", user="u", password="p", fetchsize=1000)
    assert got.loaded and got.kind == "jdbc"
    assert got.options == {"url": "jdbc:x", "user": "u", "password": "p", "fetchsize": "1000", "query": "SELECT 1"}
    got = read_table(FakeSpark(), "jdbc:x", "UNIT_LOAD", partition_column="SNAPSHOT_ID", bounds=(1, 9), partitions=4)
    assert got.options == {"url": "jdbc:x", "dbtable": "UNIT_LOAD", "partitionColumn": "SNAPSHOT_ID",
                           "lowerBound": "1", "upperBound": "9", "numPartitions": "4"}
    with pytest.raises(ValueError):
        read_table(FakeSpark(), "jdbc:x", "UNIT_LOAD", partition_column="SNAPSHOT_ID")


def test_types_come_from_the_sample_and_misfits_are_told(spark, tmp_path):
    one, two = tmp_path / "one.tsv", tmp_path / "two.tsv"
    one.write_text("code\tyear\tload\tday\tnote\tblank\n" + "".join(f"007\t{2018 + i}\t{i}.5\t2019-0{i + 1}-01\tn{i}\t\n" for i in range(3))
                   + "008\tTotal\tn/a\t2019-13-01\tNA\t\n009\t2018.0\t1e3\t2019-04-01\t\t7\n")
    two.write_text("code\tyear\tload\tday\tnote\tblank\n010\t2021\t4\t2019-05-01\t5\t\n")
    got = read_inferred(spark, [str(one), str(two)], sep="\t", sample=3, as_text=["code"])
    assert [f.dataType.simpleString() for f in got.schema] == ["string", "bigint", "double", "date", "string", "string"]
    assert bag(got.table, "code", "year", "load", "note", "blank") == [
        ("007", 2018, 0.5, "n0", None), ("007", 2019, 1.5, "n1", None), ("007", 2020, 2.5, "n2", None), ("008", None, None, None, None),
        ("009", None, 1000.0, None, "7"), ("010", 2021, 4.0, "5", None)]
    rows = got.rejects.orderBy("position", "column").collect()
    assert [(r.file.split("/")[-1], r.column, r.value, r.type) for r in rows] == [
        ("one.tsv", "day", "2019-13-01", "date"), ("one.tsv", "load", "n/a", "double"), ("one.tsv", "year", "Total", "bigint"),
        ("one.tsv", "year", "2018.0", "bigint")]
    # A larger sample sees the misfits and falls back to types that hold them.
    wide = read_inferred(spark, str(one), sep="\t", sample=100)
    assert [f.dataType.simpleString() for f in wide.schema] == ["bigint", "string", "string", "string", "string", "bigint"]
    assert wide.rejects.collect() == [] and spark.read.csv(str(one), header=True).count() == 5


def test_published_file_is_sorted_named_from_the_data_and_computed_once(spark, tmp_path, frame):
    rows = frame("k string, v decimal(18,4)", ("b", "2"), ("a", "1.5"), (None, None))
    path = publish_csv(rows, str(tmp_path), lambda staged: f"load {staged.agg(F.max('k')).first()[0]}.csv", order=["k"])
    assert path.endswith("load b.csv")
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(parts) == 1 and (tmp_path / "load b.csv" / parts[0]).read_text().splitlines() == ["k,v", "a,1.5", "b,2.0", "NA,NA"]
    assert len(os.listdir(tmp_path / "_staging")) == 1
