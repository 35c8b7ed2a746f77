"""Sources, filters and sinks."""

from datetime import datetime
from types import SimpleNamespace

import pytest

from chronoloom.frame import with_roles
from chronoloom.operators.clean import resample
from chronoloom.shared import shared_dir
from chronoloom.sources.datasets import dataset, list_datasets
from chronoloom.sources.filters import apply_filters
from chronoloom.sources.readers import file_format, jdbc_options, load, read_file
from chronoloom.sources.writers import save
from tests.helpers import collected, monthly

SF_DIR = "/root/testdata/sf0.001"


def test_formats():
    assert [file_format(p) for p in ("a.csv", "b.TXT", "c.tsv", "d.pq", "s3a://x/e.json", "f.parquet")] == [
        "csv", "csv", "tsv", "parquet", "json", "parquet",
    ]
    assert file_format("https://host/data.csv?x=1") == "csv"
    for bad in (("a.xls", None), ("a", None), ("a.csv", "excel")):
        with pytest.raises(ValueError):
            file_format(*bad)


@pytest.mark.parametrize("name,text", [("a.csv", "date,v\n2024-01-01,1\n"), ("a.tsv", "date\tv\n2024-01-01\t1\n"), ("a.txt", "date,v\n2024-01-01,1\n")])
def test_delimited(spark, tmp_path, name, text):
    (tmp_path / name).write_text(text)
    tsf = load(spark, {"type": "file", "path": str(tmp_path / name), "target_column": "v"}, False)
    assert [tuple(r) for r in tsf.df.select("date", "v").collect()] == [(datetime(2024, 1, 1), 1.0)]


def test_json_array_of_records(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"date": "2024-01-01", "v": 1.5},\n {"date": "2024-02-01", "v": null}]')
    tsf = load(spark, {"type": "url", "url": f"file:{tmp_path}/a.json", "time_column": "date", "target_column": "v"})
    assert [r["v"] for r in tsf.df.orderBy("date").collect()] == [1.5, 1.5]


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_save_and_load(spark, tmp_path, fmt):
    tsf, path = monthly(spark, [1, None, 3]), str(tmp_path / fmt)
    save(tsf, path, fmt)
    with pytest.raises(Exception, match="already exists"):
        save(tsf, path, fmt)
    save(tsf, path, fmt, overwrite=True)
    config = {
        "type": "file", "path": path, "format": fmt, "key_columns": ["k"],
        "time_column": "ts", "target_column": "y", "schema": "k string, ts timestamp_ntz, y double",
    }
    assert collected(load(spark, config, False).df) == collected(tsf.df)
    with pytest.raises(ValueError):
        save(tsf, path, "excel")


def test_save_partitioned(spark, tmp_path):
    tsf, path = monthly(spark, [1, 2]), str(tmp_path / "p")
    save(tsf, path, "parquet", partition_by=["k"])
    assert (tmp_path / "p" / "k=a").is_dir()


def test_filters(spark):
    df = spark.createDataFrame([(i, f"n{i}", datetime(2024, 1, i)) for i in range(1, 6)], "a int, b string, t timestamp_ntz")

    def got(rules):
        return [r["a"] for r in apply_filters(df, rules).orderBy("a").collect()]

    assert got({"a": ">= 3"}) == [3, 4, 5]
    assert got({"a": "<3"}) == [1, 2]
    assert got({"a": "!=3", "b": "!= n1"}) == [2, 4, 5]
    assert got({"a": 2}) == got({"a": "2"}) == got({"b": "n2"}) == [2]
    assert got({"t": "<= 2024-01-02"}) == [1, 2]
    assert got(None) == [1, 2, 3, 4, 5]
    with pytest.raises(ValueError, match="'z' not found"):
        got({"z": 1})


def test_filters_and_columns_reach_the_scan(spark):
    df = read_file(spark, {"path": f"{SF_DIR}/orders.parquet"})
    df = apply_filters(df, {"o_totalprice": ">= 200000", "o_orderdate": ">= 1997-01-01"}).select("o_orderkey")
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(o_totalprice,200000.0)" in pushed
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in pushed
    assert "o_custkey" not in plan


def test_sql_from_the_catalog(spark):
    spark.range(10).selectExpr("id", "date_add(date'2024-01-01', int(id)) AS date", "id * 2.0 AS v").createOrReplaceTempView("src_t")
    config = {"type": "sql", "time_column": "date", "target_column": "v"}
    by_table = load(spark, {**config, "table": "src_t", "filters": {"id": ">= 4"}}, False)
    by_query = load(spark, {**config, "query": "SELECT * FROM src_t WHERE id >= :n", "query_params": {"n": 4}}, False)
    assert by_table.df.count() == 6 and collected(by_table.df) == collected(by_query.df)
    for bad in ({}, {"table": "src_t; DROP TABLE x"}, {"table": "src_t", "filters": {"id = 1 OR": "1"}}):
        with pytest.raises(ValueError):
            load(spark, {**config, **bad})


def test_jdbc_options():
    base = {"url": "jdbc:x:y"}
    got = jdbc_options({**base, "table": "s.t", "partition_column": "id", "lower_bound": 0, "upper_bound": 9, "num_partitions": 3})
    assert got["dbtable"] == "s.t" and got["numPartitions"] == "3"
    assert jdbc_options({**base, "query": "SELECT 1"})["query"] == "SELECT 1"
    for bad in (
        {}, {"table": "a b"}, {"table": "t", "query": "q"}, {"table": "t", "partition_column": "id"},
        {"query": "q", "query_params": {"a": 1}},
        {"query": "q", "partition_column": "id", "lower_bound": 0, "upper_bound": 1, "num_partitions": 2},
    ):
        with pytest.raises(ValueError):
            jdbc_options({**base, **bad})


def test_unknown_source(spark):
    with pytest.raises(ValueError, match="Unknown source"):
        load(spark, {"type": "fax"})
    with pytest.raises(ValueError, match="needs 'data'"):
        load(spark, {"type": "inline"})


def test_datasets(spark):
    assert "embeddings" in list_datasets("classification")["classification"]
    assert set(list_datasets()) == {"forecasting", "classification"}
    for names in list_datasets().values():
        for name in names:
            got = dataset(spark, SF_DIR, name)
            assert (got if name == "embeddings" else got.df).count() > 0
    with pytest.raises(ValueError):
        dataset(spark, SF_DIR, "nope")


def test_resample_kinds(spark):
    data = [("a", datetime(2024, 1, d), float(d)) for d in (1, 2, 3)] + [("a", datetime(2024, 2, 1), 9.0)]
    tsf = with_roles(spark.createDataFrame(data, "k string, ts timestamp_ntz, y double"), ["k"], "ts", "y")
    want = {"sum": 6, "mean": 2, "min": 1, "max": 3, "count": 3, "first": 1, "last": 3}
    for kind, value in want.items():
        assert resample(tsf, "MS", kind).df.orderBy("ts").first()["y"] == value
    with pytest.raises(ValueError):
        resample(tsf, "MS", "mode")


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark, "x").startswith("/")
    conf = {"spark.checkpoint.dir": "hdfs://name/shared/"}
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="yarn"))
    assert shared_dir(cluster, "x").startswith("hdfs://name/shared/x-")
    conf.clear()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(cluster, "x")


def test_inline_without_time_is_filtered(spark):
    config = {"type": "inline", "data": {"y": [1, 2, 3, 4]}, "target_column": "y", "filters": {"y": ">= 3"}}
    tsf = load(spark, config, auto_format=False)
    assert sorted(tuple(r) for r in tsf.df.select("index", "y").collect()) == [(2, 3), (3, 4)]


def test_json_lines_are_all_read(spark, tmp_path):
    (tmp_path / "a.json").write_text("".join(f'{{"date": "2024-01-0{i}", "v": {i}}}\n' for i in range(1, 8)))
    tsf = load(spark, {"type": "file", "path": f"{tmp_path}/a.json", "time_column": "date", "target_column": "v"}, auto_format=False)
    assert tsf.df.count() == 7
