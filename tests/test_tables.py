"""Readers, writers and read-transform-write flows."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException

from rowsmith.operators.windows import Rolling
from rowsmith.plans import flows
from rowsmith.session import scratch_dir
from rowsmith.sources import readers, writers

SCHEMA = "seq bigint, user_id bigint, age int, city string"


@pytest.fixture(scope="module")
def paths(users, tmp_path_factory):
    base = tmp_path_factory.mktemp("tables")
    users.write.option("header", True).csv(f"{base}/users.csv")
    users.write.parquet(f"{base}/users.parquet")
    return f"{base}/users.csv", f"{base}/users.parquet"


def test_readers(spark, users, paths):
    csv, parquet = paths
    expected = sorted(users.collect())
    assert sorted(readers.read_csv(spark, csv, SCHEMA).collect()) == expected
    assert readers.read_csv(spark, csv).schema["age"].dataType.typeName() == "integer"
    assert sorted(readers.read_table(spark, csv, SCHEMA).collect()) == expected
    assert sorted(readers.read_table(spark, parquet).collect()) == expected
    with pytest.raises(ValueError, match="must end in"):
        readers.read_table(spark, "users.json")


def test_missing_tables(spark, paths):
    gone = "/nowhere/gone.csv"
    with pytest.raises(FileNotFoundError, match="gone"):
        readers.read_tables(spark, [*paths, gone], [SCHEMA, None, SCHEMA])
    assert len(readers.read_tables(spark, [*paths, gone], missing="skip")) == 2
    with pytest.raises(FileNotFoundError):
        readers.read_parquet(spark, "/nowhere/gone.parquet")
    with pytest.raises(ValueError, match="missing"):
        readers.read_tables(spark, paths, missing="maybe")


def test_write_modes(spark, users, tmp_path):
    path = f"{tmp_path}/deep/er/t.parquet"
    writers.write_parquet(users, path, "errorifexists")
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        writers.write_parquet(users, path, "errorifexists")
    writers.write_parquet(users.limit(1), path, "ignore")
    assert spark.read.parquet(path).count() == 9
    writers.write_parquet(users.limit(1), path)
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError, match="must end in .parquet"):
        writers.write_parquet(users, f"{tmp_path}/t.csv")
    with pytest.raises(ValueError, match="mode"):
        writers.write_parquet(users, path, "append")


def _files(path):
    return [pq.ParquetFile(f).metadata for f in glob.glob(f"{path}/**/*.parquet", recursive=True)]


def test_compression_and_file_sizes(spark, users, tmp_path):
    path = writers.write_zstd(users.coalesce(1), f"{tmp_path}/z.parquet", rows_per_file=4)
    files = _files(path)
    assert sorted(m.num_rows for m in files) == [1, 4, 4]
    assert {m.row_group(0).column(0).compression for m in files} == {"ZSTD"}
    parts = writers.write_parts(users, f"{tmp_path}/n.parquet", 4)
    assert len(_files(parts)) == 4
    with pytest.raises(ValueError, match="parts"):
        writers.write_parts(users, f"{tmp_path}/n.parquet", 0)


def test_partitioned_folders(spark, users, tmp_path):
    path = writers.write_partitioned(users, f"{tmp_path}/p.parquet", ["city"])
    assert {f.rsplit("/", 1)[1] for f in glob.glob(f"{path}/city=*")} == {"city=A", "city=B"}
    assert spark.read.parquet(path).filter("city = 'A'").count() == 4


def test_scratch_dir_uses_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        assert scratch_dir(spark, "x").startswith(shared)
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_flows(spark, paths, tmp_path):
    csv, parquet = paths

    def read(path):
        return spark.read.parquet(path)

    def target(name):
        return f"{tmp_path}/{name}.parquet"

    path = flows.filter_group(spark, csv, target("a"), "age", 30, ["city"], "age", schema=SCHEMA)
    assert {tuple(r) for r in read(path).collect()} == {("A", 60), ("B", 90)}

    path = flows.rolling_columns(spark, csv, target("b"), ["age"], 2, -1, ["seq"])
    assert read(path).filter("Rolling_age is not null").count() == 6

    path = flows.normalize_column(spark, parquet, target("c"), "age")
    assert read(path).filter("age_normalize = 1").count() == 1

    path = flows.join_tables(spark, [csv, parquet], target("d"), "seq", "outer")
    assert read(path).count() == 9 and "age_right" in read(path).columns
    with pytest.raises(ValueError, match="exactly two"):
        flows.join_tables(spark, [csv, "/nowhere/x.csv"], target("d"), "seq", missing="skip")

    path = flows.rolling_cumulative(
        spark, parquet, target("e"), "rolling_sum", ["age"], [2], [1], ["seq"], ["user_id"], parts=3
    )
    assert read(path).filter("rolling_sum_age = 150").count() == 1
    path = flows.rolling_cumulative(
        spark, parquet, target("e"), "rolling_sum", ["age"], [2], [1], ["seq"], ["user_id"], 1_000
    )
    assert read(path).filter("rolling_sum_age = 150").count() == 1

    path = flows.feature_bundle(
        spark, parquet, target("f"), ["age"], [2], [1], "dense", ["seq"], ["user_id"]
    )
    assert read(path).count() == 9

    path = flows.label_and_join(spark, [parquet, csv], target("g"), "seq", "inner", "age")
    assert "age_diferiencia_right" in read(path).columns
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        flows.label_and_join(spark, [parquet, csv], target("g"), "seq", "inner", "age")

    path = flows.scale_or_aggregate(spark, parquet, target("h"), ["age"], scaler="minmax")
    assert read(path).filter("minmax_age = 1").count() == 1
    path = flows.scale_or_aggregate(spark, parquet, target("h"), ["age"], aggregate="sum")
    assert read(path).filter("sum_age = 260").count() == 9
    with pytest.raises(ValueError, match="either"):
        flows.scale_or_aggregate(spark, parquet, target("h"), ["age"])

    path = flows.multi_stage(
        spark, parquet, target("i"), "age", Rolling("age", 2), ["user_id"], ["seq"], ["user_id"],
        "age", "mean",
    )
    assert {tuple(r) for r in read(path).collect()} == {(1, 34.0), (2, 30.0)}


def test_strategies(spark, users, paths, tmp_path):
    csv, parquet = paths
    path = f"{tmp_path}/s.parquet"
    rolling = flows.RollingStrategy("rolling_mean", ["age"], [2], [1], ["seq"])
    flows.features_by_strategy(spark, [parquet], path, rolling, "city")
    assert spark.read.parquet(path).filter("rolling_mean_age = 30").count() == 3
    for scaler, column in [("minmax", "MinMax_age"), ("standard", "Zscore_age")]:
        flows.features_by_strategy(spark, [parquet], path, flows.MlStrategy(scaler, ["age"]))
        assert column in spark.read.parquet(path).columns
    sums = flows.MlStrategy("aggregate", aggregations={"age": "sum"})
    flows.features_by_strategy(spark, [parquet], path, sums)
    assert spark.read.parquet(path).filter("sum_age = 260").count() == 9
    join = flows.JoinStrategy("seq", "left", ["user_id > 1"])
    flows.features_by_strategy(spark, [parquet, csv], path, join, schemas=[None, SCHEMA])
    assert spark.read.parquet(path).filter("Categoria_user_id = 'Alto'").count() == 3
    with pytest.raises(ValueError, match="unknown scaler"):
        flows.features_by_strategy(spark, [parquet], path, flows.MlStrategy("robust", ["age"]))
    with pytest.raises(ValueError, match="1 table"):
        flows.features_by_strategy(spark, [parquet, csv], path, rolling)
    with pytest.raises(ValueError, match="exactly two"):
        flows.features_by_strategy(spark, [parquet], path, join)


def test_csv_is_read_by_its_header(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,2\n")
    assert readers.read_csv(spark, f"{tmp_path}/t.csv", "b int, a int").collect() == [(2, 1)]
    assert readers.read_csv(spark, f"{tmp_path}/t.csv", "b int").collect() == [(2,)]
    with pytest.raises(ValueError, match="not in the table: c"):
        readers.read_csv(spark, f"{tmp_path}/t.csv", "a int, c int")


def test_rows_that_do_not_fit_fail_by_default(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,2\nx,3\n")
    with pytest.raises(Exception, match="MALFORMED"):
        readers.read_csv(spark, f"{tmp_path}/t.csv", "a int, b int").collect()
    loose = readers.read_csv(spark, f"{tmp_path}/t.csv", "a int, b int", "PERMISSIVE")
    assert loose.collect() == [(1, 2), (None, 3)]
    with pytest.raises(ValueError, match="mode"):
        readers.read_csv(spark, f"{tmp_path}/t.csv", "a int", "LOOSE")


def test_scratch_folders_must_be_shared_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session(), "x")
