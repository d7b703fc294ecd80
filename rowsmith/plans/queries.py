"""The registered queries: each operator bound to the given tables, over all of their rows."""

from __future__ import annotations

import sys
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowsmith.functions import names
from rowsmith.operators import (
    aggregates,
    arrow_ops,
    features,
    filters,
    joins,
    labels,
    ranks,
    scaling,
    windows,
)
from rowsmith.operators.windows import Rolling
from rowsmith.plans import flows
from rowsmith.session import scratch_dir
from rowsmith.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

ORDER = ["ts", "event_id"]

# By default only groups beyond a million rows are cut into blocks. The queries named _blocks and
# _large_key cut the test tables too; larger tables get larger blocks.
ROWS_PER_BLOCK = 5_000
ROWS_PER_KEY_BLOCK = 1_000

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return readers.read_parquet(spark, f"{sf}/{name}.parquet")


def events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with the value in whole cents, whose sums are exact in any order."""
    cents = F.round(F.col("value") * 100).cast("bigint").alias("cents")
    return table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", cents)


def sparse_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events where error events have no value."""
    cents = F.when(F.col("event_type") != "error", F.col("cents"))
    return events(spark, sf).withColumn("cents", cents)


def kept(df: DataFrame) -> DataFrame:
    return df.drop("ts", "event_type")


# Sources and sinks


def _csv_copy(df: DataFrame, name: str) -> str:
    path = f"{scratch_dir(df.sparkSession, name)}/{name}.csv"
    df.write.option("header", True).csv(path)
    return path


def _parquet_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark, name)}/{name}.parquet"


@query
def src_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = _csv_copy(table(spark, sf, "customer"), "customer")
    return readers.read_csv(spark, path, CUSTOMER)


@query
def src_csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    path = _csv_copy(table(spark, sf, "part"), "part")
    part = readers.read_csv(spark, path)
    return part.withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


@query
def src_parquet(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return orders.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


@query
def src_multi_csv(spark: SparkSession, sf: str) -> DataFrame:
    paths = [
        _csv_copy(table(spark, sf, "customer"), "customer"),
        f"{scratch_dir(spark, 'none')}/missing.csv",
        _csv_copy(table(spark, sf, "nation"), "nation"),
    ]
    schema = "n_nationkey int, n_name string, n_regionkey int"
    customer, nation = readers.read_tables(spark, paths, [CUSTOMER, None, schema], missing="skip")
    nation = nation.withColumnRenamed("n_nationkey", "c_nationkey")
    return joins.join(customer, nation, "c_nationkey").select("c_custkey", "c_name", "n_name")


@query
def src_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    path = _csv_copy(table(spark, sf, "customer"), "customer")
    customer = readers.read_table(spark, path, CUSTOMER)
    orders = readers.read_table(spark, f"{sf}/orders.parquet")
    joined = joins.join(orders.withColumnRenamed("o_custkey", "c_custkey"), customer, "c_custkey")
    return joined.select("o_orderkey", "c_custkey", "c_name", "o_totalprice")


@query
def src_row_count(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("row_count"))


@query
def sink_parquet(spark: SparkSession, sf: str) -> DataFrame:
    path = writers.write_parquet(kept(events(spark, sf)), _parquet_path(spark, "events"))
    return readers.read_parquet(spark, path)


@query
def sink_parquet_zstd(spark: SparkSession, sf: str) -> DataFrame:
    path = _parquet_path(spark, "events")
    writers.write_zstd(kept(events(spark, sf)), path, rows_per_file=1_000_000)
    return readers.read_parquet(spark, path)


@query
def sink_row_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, the largest row group, and row groups that are short without being a file's last, from the footers."""
    path = _parquet_path(spark, "events")
    writers.write_zstd(kept(events(spark, sf)), path, rows_per_group=50)
    in_file = Window.partitionBy("file").orderBy(F.desc("row_group"))
    groups = readers.row_groups(spark, path).withColumn("from_last", F.row_number().over(in_file))
    return groups.agg(
        F.sum("rows").alias("row_count"),
        F.max("rows").alias("largest"),
        F.count_if((F.col("rows") < 50) & (F.col("from_last") > 1)).alias("short_inside"),
    )


@query
def sink_counted(spark: SparkSession, sf: str) -> DataFrame:
    path = _parquet_path(spark, "events")
    written = writers.write_counted(kept(events(spark, sf)), path)
    return readers.read_parquet(spark, path).agg(
        F.lit(written).cast("bigint").alias("written"), F.count(F.lit(1)).alias("row_count")
    )


@query
def flow_require_rows(spark: SparkSession, sf: str) -> DataFrame:
    path = flows.filter_group(
        spark, f"{sf}/part.parquet", _parquet_path(spark, "sums"), "p_size", 30, ["p_brand"], "p_size", require_rows=True
    )
    return readers.read_parquet(spark, path)


@query
def sink_n_parts(spark: SparkSession, sf: str) -> DataFrame:
    path = _parquet_path(spark, "events")
    parts = max(10, int(spark.conf.get("spark.sql.shuffle.partitions")))
    writers.write_parts(kept(events(spark, sf)), path, parts)
    return readers.read_parquet(spark, path)


@query
def sink_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    path = _parquet_path(spark, "events")
    writers.write_partitioned(events(spark, sf).drop("ts"), path, ["event_type"])
    return readers.read_parquet(spark, path)


@query
def sink_keep_existing(spark: SparkSession, sf: str) -> DataFrame:
    path = _parquet_path(spark, "events")
    data = kept(events(spark, sf))
    writers.write_parquet(data, path, mode="ignore")
    writers.write_parquet(data.withColumn("cents", F.lit(0)), path, mode="ignore")
    return readers.read_parquet(spark, path)


# Labels and filters


@query
def label_threshold(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return labels.threshold(items, "l_quantity", 25)


@query
def label_threshold_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return labels.threshold(kept(sparse_events(spark, sf)), "cents", 5_000)


@query
def label_sql_expr(spark: SparkSession, sf: str) -> DataFrame:
    data = table(spark, sf, "events").select("event_id", "user_id", "value")
    return labels.sql_predicates(
        data, ["value > 50", "user_id <= 75"], names.HIGH_LABEL, names.LOW_LABEL
    )


@query
def label_named_predicate(spark: SparkSession, sf: str) -> DataFrame:
    data = kept(sparse_events(spark, sf))
    return labels.named_predicates(
        data, {"cents": "is_null", "user_id": "is_not_null"}, "yes", "no"
    )


@query
def label_if_present(spark: SparkSession, sf: str) -> DataFrame:
    customer = labels.threshold_if_present(table(spark, sf, "customer"), "c_acctbal")
    orders = labels.threshold_if_present(table(spark, sf, "orders"), "c_acctbal")
    orders = orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return joins.join(customer, orders, "c_custkey")


@query
def filter_group_sum(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.filter_then_group(
        table(spark, sf, "part"), "p_size", 30, ["p_brand"], "p_size"
    )


@query
def filter_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return filters.not_null(kept(sparse_events(spark, sf)), "cents")


@query
def filter_even_rows(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return filters.even_rows(items, "l_linenumber")


def _word_lengths(spark: SparkSession, sf: str) -> DataFrame:
    lengths = F.transform(F.split("text", " "), F.length).alias("lengths")
    return table(spark, sf, "documents").select("doc_id", "source", lengths)


@query
def array_filter_even(spark: SparkSession, sf: str) -> DataFrame:
    return _word_lengths(spark, sf).select(
        "doc_id",
        F.array_join(filters.even_values(F.col("lengths")), ",").alias("even"),
        F.array_join(filters.even_values(F.col("lengths"), ordered=True), ",").alias("sorted_even"),
    )


@query
def array_latest_section(spark: SparkSession, sf: str) -> DataFrame:
    latest = filters.latest_lists(_word_lengths(spark, sf), "source", "doc_id", "lengths")
    return latest.select(
        "source", F.array_join(filters.even_values(F.col("lengths")), ",").alias("even")
    )


# Joins


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_name", "c_acctbal"
    )


def _events_of_users(spark: SparkSession, sf: str) -> DataFrame:
    """Events, those of error type without a user, so that both sides have unmatched rows."""
    user = F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id")
    return events(spark, sf).select("event_id", user, "cents")


@query
def join_inner(spark: SparkSession, sf: str) -> DataFrame:
    return joins.join(_events_of_users(spark, sf), _customers(spark, sf), "user_id")


@query
def join_left(spark: SparkSession, sf: str) -> DataFrame:
    return joins.join(_events_of_users(spark, sf), _customers(spark, sf), "user_id", "left")


@query
def join_right(spark: SparkSession, sf: str) -> DataFrame:
    return joins.join(_events_of_users(spark, sf), _customers(spark, sf), "user_id", "right")


@query
def join_full(spark: SparkSession, sf: str) -> DataFrame:
    return joins.join(_events_of_users(spark, sf), _customers(spark, sf), "user_id", "outer")


@query
def join_full_keep_keys(spark: SparkSession, sf: str) -> DataFrame:
    sides = _events_of_users(spark, sf), _customers(spark, sf)
    return joins.join(*sides, "user_id", "outer", coalesce_keys=False)


@query
def join_full_large_keys(spark: SparkSession, sf: str) -> DataFrame:
    sides = _events_of_users(spark, sf), _customers(spark, sf)
    return joins.join(*sides, "user_id", "outer", rows_per_task=40)


@query
def join_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice"
    )
    customer = table(spark, sf, "customer").select("c_custkey", "c_name")
    return joins.join_partitioned(orders, customer, "c_custkey")


@query
def join_partitioned_equal_rows(spark: SparkSession, sf: str) -> DataFrame:
    visits = table(spark, sf, "events").select("user_id", "event_type")
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
    return joins.join_partitioned(visits, customer, "user_id", "left", 8, rows_per_task=20)


@query
def join_partitioned_large_keys(spark: SparkSession, sf: str) -> DataFrame:
    sides = _events_of_users(spark, sf), _customers(spark, sf)
    return joins.join_partitioned(*sides, "user_id", "outer", rows_per_task=40)


@query
def join_suffix(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("key"), "o_orderkey", F.col("o_totalprice").alias("amount")
    )
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("amount")
    )
    return joins.join(orders, customer, "key")


@query
def label_then_join(spark: SparkSession, sf: str) -> DataFrame:
    left = events(spark, sf).select("event_id", "user_id", "cents")
    return joins.label_then_join(
        left, _customers(spark, sf), "user_id", "inner", ["cents > 5000"],
        names.HIGH_LABEL, names.LOW_LABEL,
    )


@query
def label_both_then_join(spark: SparkSession, sf: str) -> DataFrame:
    left = events(spark, sf).select("event_id", "user_id", F.col("cents").alias("amount"))
    right = _customers(spark, sf).withColumnRenamed("c_acctbal", "amount")
    return joins.label_both_then_join(left, right, "user_id", "inner", "amount", partitioned=True)


# Aggregates


@query
def group_mean(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.group(events(spark, sf), ["user_id"], "cents", "mean")


@query
def group_sum(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.group(events(spark, sf), ["user_id"], "cents", "sum")


@query
def group_min(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.group(table(spark, sf, "events"), ["user_id"], "value", "min")


@query
def group_max(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.group(table(spark, sf, "events"), ["user_id"], "value", "max")


@query
def broadcast_agg_map(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.spread_map(kept(events(spark, sf)), {"cents": "sum", "user_id": "mean"})


@query
def broadcast_agg(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.spread(kept(events(spark, sf)), ["cents", "user_id"], "min")


@query
def column_mean(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.column_mean(table(spark, sf, "lineitem"), "l_quantity")


@query
def guarded_sum(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.guarded_sum(table(spark, sf, "lineitem"), "l_quantity", 1e18)


@query
def sum_times_factor(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.sum_times(events(spark, sf), "cents", 5)


@query
def metric_summary(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.summarize_samples(events(spark, sf), "event_type", "cents")


# Windows


def _keyed(op: str, keys: list[str] | None = None, rows: int | None = None) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        feature = Rolling("cents", 4, 0, op)
        return kept(
            windows.rolling(sparse_events(spark, sf), [feature], ORDER, keys or ["user_id"], rows)
        )

    return run


def _cumulative(op: str, keys: list[str] | None = None, rows: int | None = None) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        feature = Rolling("cents", 4, 2, op)
        by = keys or ["user_id"]
        return kept(windows.rolling_cumulative(events(spark, sf), [feature], ORDER, by, rows))

    return run


def _ranked(method: str, rows: int | None = None) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return ranks.rank(kept(sparse_events(spark, sf)), ["cents"], method, rows)

    return run


for _op in ("mean", "sum", "min", "max"):
    QUERIES[f"rolling_{_op}_by_key"] = _keyed(f"rolling_{_op}")
for _op in ("mean", "sum", "max"):
    QUERIES[f"rolling_{_op}_cumsum_by_key"] = _cumulative(f"rolling_{_op}")
QUERIES["rolling_mean_by_large_key"] = _keyed("rolling_mean", ["event_type"], ROWS_PER_KEY_BLOCK)
QUERIES["rolling_mean_cumsum_by_large_key"] = _cumulative(
    "rolling_mean", ["event_type"], ROWS_PER_KEY_BLOCK
)
for _method in ("average", "dense", "min"):
    QUERIES[f"rank_{_method}"] = _ranked(_method)
    QUERIES[f"rank_{_method}_blocks"] = _ranked(_method, ROWS_PER_BLOCK)


@query
def rolling_over_self(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_size")
    return windows.rolling_over_self(part, [Rolling("p_size", 3, 1)], ["p_partkey"])


def _whole_table(window: int, lag: int, op: str, rows: int | None = None) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        wanted = windows.rolling_list(["cents"], [window], [lag], op, names.ROLLING)
        return kept(windows.rolling(events(spark, sf), wanted, ORDER, rows_per_block=rows))

    return run


for _name, _args in {
    "rolling_mean_global": (2, 1, "rolling_mean"),
    "rolling_sum_global": (3, 1, "rolling_sum"),
    "rolling_mean_lead": (2, -1, "rolling_mean"),
    "rolling_sum_wide": (1_000, 0, "rolling_sum"),
}.items():
    QUERIES[_name] = _whole_table(*_args)
    QUERIES[f"{_name}_blocks"] = _whole_table(*_args, ROWS_PER_BLOCK)


def _wide(op: str, dtype: str, name: str) -> Query:
    """A window of 2,000 rows, computed in runs. Sums of doubles are rounded: the order of adding differs."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        values = table(spark, sf, "events").select("event_id", "ts", F.col("value").cast(dtype).alias("value"))
        rolled = windows.rolling(values, [Rolling("value", 2_000, 0, f"rolling_{op}", "rolled")], ORDER)
        value = F.round("rolled", 6) if dtype == "double" else F.col("rolled").cast("double")
        return rolled.select("event_id", value.alias("rolled"))

    run.__name__ = name
    return run


for _op in ("sum", "mean", "min", "max"):
    QUERIES[f"rolling_{_op}_wide_double"] = _wide(_op, "double", f"rolling_{_op}_wide_double")
QUERIES["rolling_sum_wide_decimal"] = _wide("sum", "decimal(12,2)", "rolling_sum_wide_decimal")


@query
def join_suffix_case(spark: SparkSession, sf: str) -> DataFrame:
    """Keys and names that differ by case only: one key column, the other name with the suffix."""
    nation = table(spark, sf, "nation").selectExpr("n_regionkey AS Key", "n_name AS Name")
    region = table(spark, sf, "region").selectExpr("r_regionkey AS key", "r_name AS name")
    return joins.join(nation, region, "key").toDF("region_key", "nation", "region")


@query
def cumsum_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return kept(windows.cumulative_sum(sparse_events(spark, sf), ["cents"], ORDER, ["user_id"]))


@query
def cumsum_by_large_key(spark: SparkSession, sf: str) -> DataFrame:
    return kept(
        windows.cumulative_sum(
            sparse_events(spark, sf), ["cents"], ORDER, ["event_type"], ROWS_PER_KEY_BLOCK
        )
    )


@query
def lag_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return kept(windows.shift(events(spark, sf), "cents", 2, ORDER, ["user_id"]))


def _bundle(rows: int | None = None) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return kept(
            features.feature_bundle(
                events(spark, sf), ["cents"], [3], [1], "dense", ORDER, ["user_id"], rows
            )
        )

    return run


QUERIES["feature_bundle"] = _bundle()
QUERIES["feature_bundle_blocks"] = _bundle(ROWS_PER_BLOCK)


# Doubles of very different sizes: their sums depend on the order of adding, unless they are exact.


def double_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with ``x``, the cents times a power of two from -20 to 19."""
    power = F.pow(F.lit(2.0), F.col("event_id") % 40 - 20)
    return events(spark, sf).withColumn("x", F.col("cents").cast("double") * power).drop("cents")


@query
def group_sum_double(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.group(double_events(spark, sf), ["event_type"], "x", "sum", exactly=True)


@query
def group_mean_double(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.group(double_events(spark, sf), ["user_id"], "x", "mean", exactly=True)


def _double_cumsum(rows: int | None) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return kept(windows.cumulative_sum(double_events(spark, sf), ["x"], ORDER, ["event_type"], rows))

    return run


def _double_rolling(window: int, rows: int | None) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        feature = Rolling("x", window, 0, "rolling_mean")
        return kept(windows.rolling(double_events(spark, sf), [feature], ORDER, ["event_type"], rows))

    return run


def _double_rolling_cumsum(rows: int | None) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        feature = Rolling("x", 4, 2, "rolling_mean")
        return kept(windows.rolling_cumulative(double_events(spark, sf), [feature], ORDER, ["event_type"], rows))

    return run


for _suffix, _rows in (("key", None), ("large_key", ROWS_PER_KEY_BLOCK)):
    QUERIES[f"cumsum_double_by_{_suffix}"] = _double_cumsum(_rows)
    QUERIES[f"rolling_mean_double_by_{_suffix}"] = _double_rolling(4, _rows)
    QUERIES[f"rolling_mean_double_in_runs_by_{_suffix}"] = _double_rolling(128, _rows)
    QUERIES[f"rolling_mean_cumsum_double_by_{_suffix}"] = _double_rolling_cumsum(_rows)
QUERIES["rolling_sum_long_reach_blocks"] = _whole_table(1_500, 0, "rolling_sum", 2_000)


# Scaling


def _items(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )


@query
def scale_minmax_one(spark: SparkSession, sf: str) -> DataFrame:
    return scaling.normalize(_items(spark, sf), "l_quantity")


@query
def scale_minmax_many(spark: SparkSession, sf: str) -> DataFrame:
    return scaling.minmax(_items(spark, sf), ["l_quantity", "l_extendedprice"])


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query
def scale_zscore_many(spark: SparkSession, sf: str) -> DataFrame:
    scaled = scaling.zscore(_items(spark, sf), ["l_quantity", "l_extendedprice"])
    return _rounded(scaled, "Zscore_l_quantity", "Zscore_l_extendedprice")


@query
def scale_zscore_guarded(spark: SparkSession, sf: str) -> DataFrame:
    items = _items(spark, sf).withColumn("flat", F.lit(3))
    return _rounded(scaling.guarded(items, ["l_quantity", "flat"], "scaler"), "scaler_l_quantity")


@query
def scale_minmax_guarded(spark: SparkSession, sf: str) -> DataFrame:
    items = _items(spark, sf).withColumn("flat", F.lit(3))
    return scaling.guarded(items, ["l_quantity", "flat"], "minmax")


# Arrow functions

# They run on executors, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _doubled(batch: pa.Table) -> pa.Table:
    return batch.append_column("doubled", pc.multiply(batch["cents"], 2))


def _sum_by_user(rows: pa.Table, total: str, count: str, how: str) -> pa.Table:
    found = rows.group_by("user_id").aggregate([(total, "sum"), (count, how)])
    columns = [found["user_id"], found[f"{total}_sum"], found[f"{count}_{how}"]]
    return pa.table(columns, names=["user_id", "total", "n"])


def _partial_sums(rows: pa.Table) -> pa.Table:
    return _sum_by_user(rows, "cents", "cents", "count")


def _combined_sums(rows: pa.Table) -> pa.Table:
    return _sum_by_user(rows, "total", "n", "sum")


def _mean_of_sums(rows: pa.Table) -> pa.Table:
    means = pc.divide(pc.cast(rows["total"], pa.float64()), pc.cast(rows["n"], pa.float64()))
    return pa.table([rows["user_id"], means], names=["user_id", "mean_cents"])


@query
def map_batches_arrow(spark: SparkSession, sf: str) -> DataFrame:
    data = events(spark, sf).select("event_id", "cents")
    return arrow_ops.map_batches(data, _doubled, "event_id bigint, cents bigint, doubled bigint")


def _batch_rows(batch: pa.Table) -> pa.Table:
    return pa.table({"n": pa.array([batch.num_rows], pa.int64())})


@query
def map_batches_sized(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and the largest batch that a function gets, for two batch sizes."""
    data = events(spark, sf).select("event_id", "cents")
    parts = [
        arrow_ops.map_batches(data, _batch_rows, "n bigint", batch_size=size).agg(
            F.lit(size).alias("batch_size"), F.sum("n").alias("row_count"), F.max("n").alias("largest")
        )
        for size in (100, 37)
    ]
    return parts[0].union(parts[1])


def _mean_of_group(batches):
    total, rows, user = 0, 0, None
    for batch in batches:
        user = batch.column(0)[0].as_py()
        total += pc.sum(batch.column(1)).as_py()
        rows += batch.num_rows
    yield pa.RecordBatch.from_pydict({"user_id": pa.array([user], pa.int64()), "mean_cents": [total / rows]})


@query
def map_groups_arrow(spark: SparkSession, sf: str) -> DataFrame:
    data = events(spark, sf).select(F.col("user_id").cast("bigint"), "cents")
    return arrow_ops.map_groups(data, ["user_id"], _mean_of_group, "user_id bigint, mean_cents double")


@query
def reduce_groups_arrow(spark: SparkSession, sf: str) -> DataFrame:
    return arrow_ops.reduce_groups(
        events(spark, sf).select("user_id", "cents"), ["user_id"],
        _partial_sums, _combined_sums, "user_id bigint, total bigint, n bigint",
        _mean_of_sums, "user_id bigint, mean_cents double",
    )


# Flows: read, transform, write, and read back


@query
def strategy_rolling(spark: SparkSession, sf: str) -> DataFrame:
    strategy = flows.RollingStrategy("rolling_sum", ["p_size"], [3], [1], ["p_partkey"])
    path = flows.features_by_strategy(
        spark, [f"{sf}/part.parquet"], _parquet_path(spark, "features"), strategy, "p_brand"
    )
    return readers.read_parquet(spark, path).select("p_partkey", "p_brand", "rolling_sum_p_size")


@query
def strategy_ml(spark: SparkSession, sf: str) -> DataFrame:
    strategy = flows.MlStrategy("minmax", ["l_quantity", "l_extendedprice"])
    path = flows.features_by_strategy(
        spark, [f"{sf}/lineitem.parquet"], _parquet_path(spark, "features"), strategy
    )
    return readers.read_parquet(spark, path).select(
        "l_orderkey", "l_linenumber", "MinMax_l_quantity", "MinMax_l_extendedprice"
    )


@query
def strategy_ml_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    strategy = flows.MlStrategy("aggregate", aggregations={"l_quantity": "sum", "l_orderkey": "mean"})
    path = flows.features_by_strategy(
        spark, [f"{sf}/lineitem.parquet"], _parquet_path(spark, "features"), strategy
    )
    return readers.read_parquet(spark, path).select(
        "l_orderkey", "l_linenumber", "sum_l_quantity", "mean_l_orderkey"
    )


@query
def strategy_join(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer").withColumnRenamed("c_custkey", "user_id")
    sources = [
        f"{sf}/events.parquet",
        writers.write_parquet(customer, _parquet_path(spark, "customer")),
    ]
    strategy = flows.JoinStrategy("user_id", "inner", ["user_id > 75"])
    path = flows.features_by_strategy(
        spark, sources, _parquet_path(spark, "features"), strategy, "c_mktsegment"
    )
    return readers.read_parquet(spark, path).select(
        "event_id", "user_id", "c_name", "c_mktsegment", "Categoria_user_id"
    )


@query
def scale_and_write(spark: SparkSession, sf: str) -> DataFrame:
    path = flows.scale_or_aggregate(
        spark, f"{sf}/lineitem.parquet", _parquet_path(spark, "scaled"), ["l_quantity"], "minmax",
        rows_per_file=1_000_000,
    )
    return readers.read_parquet(spark, path).select(
        "l_orderkey", "l_linenumber", "minmax_l_quantity"
    )


@query
def scale_or_aggregate_write(spark: SparkSession, sf: str) -> DataFrame:
    path = flows.scale_or_aggregate(
        spark, f"{sf}/part.parquet", _parquet_path(spark, "spread"), ["p_size"], aggregate="sum"
    )
    return readers.read_parquet(spark, path)


@query
def flow_filter_group(spark: SparkSession, sf: str) -> DataFrame:
    path = flows.filter_group(
        spark, f"{sf}/part.parquet", _parquet_path(spark, "totals"), "p_size", 30, ["p_brand"], "p_size"
    )
    return readers.read_parquet(spark, path)


@query
def flow_rolling_columns(spark: SparkSession, sf: str) -> DataFrame:
    path = flows.rolling_columns(
        spark, f"{sf}/part.parquet", _parquet_path(spark, "rolled"), ["p_size"], 4, 1, ["p_partkey"]
    )
    return readers.read_parquet(spark, path)


@query
def flow_join_tables(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    sources = [writers.write_parquet(orders, _parquet_path(spark, "orders")), f"{sf}/customer.parquet"]
    joined = readers.read_parquet(
        spark, flows.join_tables(spark, sources, _parquet_path(spark, "joined"), "c_custkey")
    )
    return joined.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


@query
def flow_normalize(spark: SparkSession, sf: str) -> DataFrame:
    path = flows.normalize_column(spark, f"{sf}/part.parquet", _parquet_path(spark, "scaled"), "p_size")
    return readers.read_parquet(spark, path)


@query
def flow_rolling_cumulative(spark: SparkSession, sf: str) -> DataFrame:
    path = flows.rolling_cumulative(
        spark, f"{sf}/part.parquet", _parquet_path(spark, "summed"), "rolling_sum", ["p_size"], [3], [1],
        ["p_partkey"], ["p_brand"], parts=3, rows_per_file=100_000,
    )
    return readers.read_parquet(spark, path)


@query
def flow_feature_bundle(spark: SparkSession, sf: str) -> DataFrame:
    path = flows.feature_bundle(
        spark, f"{sf}/part.parquet", _parquet_path(spark, "bundle"), ["p_size"], [3], [1], "dense",
        ["p_partkey"], ["p_brand"],
    )
    return readers.read_parquet(spark, path)


@query
def flow_multi_stage(spark: SparkSession, sf: str) -> DataFrame:
    path = flows.multi_stage(
        spark, f"{sf}/part.parquet", _parquet_path(spark, "stages"), "p_name", Rolling("p_size", 4), ["p_brand"],
        ["p_partkey"], ["p_brand"], "p_size", "sum",
    )
    return readers.read_parquet(spark, path)


@query
def label_join_write(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    sources = [
        writers.write_parquet(orders, _parquet_path(spark, "orders")),
        f"{sf}/customer.parquet",
    ]
    path = flows.label_and_join(
        spark, sources, _parquet_path(spark, "joined"), "c_custkey", "inner", "o_totalprice",
        rows_per_file=1_000_000,
    )
    return readers.read_parquet(spark, path).select(
        "o_orderkey", "c_custkey", "c_name", "o_totalprice_diferiencia"
    )


@query
def multi_stage_etl(spark: SparkSession, sf: str) -> DataFrame:
    return features.clean_roll_group(
        sparse_events(spark, sf), "cents", Rolling("cents", 4, 0, "rolling_mean"), ["user_id"],
        ORDER, ["user_id"], "rolling_mean_cents", "mean",
    )


@query
def multi_stage_etl_source_column(spark: SparkSession, sf: str) -> DataFrame:
    return features.clean_roll_group(
        sparse_events(spark, sf), "cents", Rolling("cents", 4, 0, "rolling_mean"), ["user_id"],
        ORDER, ["user_id"], "cents", "mean",
    )
