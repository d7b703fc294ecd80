"""SQL with the same results as the registered queries, written independently of the operators."""

from __future__ import annotations

_EVENTS = """ev AS (
    SELECT event_id, ts, user_id, event_type, CAST(ROUND(value * 100) AS BIGINT) AS cents
    FROM events)"""

_SPARSE = """ev AS (
    SELECT event_id, ts, user_id, event_type,
           CASE WHEN event_type <> 'error' THEN CAST(ROUND(value * 100) AS BIGINT) END AS cents
    FROM events)"""

_PLAIN_EVENTS = f"WITH {_EVENTS} SELECT event_id, user_id, cents FROM ev"

_JOIN_SIDES = f"""{_EVENTS},
l AS (
    SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS user_id, cents FROM ev),
r AS (SELECT c_custkey AS user_id, c_name, c_acctbal FROM customer)"""


def _joined(kind: str) -> str:
    key = {"LEFT": "l.user_id", "RIGHT": "r.user_id"}.get(kind, "COALESCE(l.user_id, r.user_id)")
    return f"""WITH {_JOIN_SIDES}
        SELECT event_id, {key} AS user_id, cents, c_name, c_acctbal
        FROM l {kind} JOIN r ON l.user_id = r.user_id"""


def _aggregate(op: str) -> str:
    return {
        "mean": "AVG(cents) OVER f",
        "sum": "CAST(SUM(cents) OVER f AS BIGINT)",
        "min": "MIN(cents) OVER f",
        "max": "MAX(cents) OVER f",
    }[op]


def _rolling(op: str, window: int, lag: int, key: str | None, name: str, source: str) -> str:
    part = f"PARTITION BY {key}" if key else ""
    bound = lambda n: f"{n} PRECEDING" if n > 0 else f"{-n} FOLLOWING" if n < 0 else "CURRENT ROW"
    return f"""WITH {source}
        SELECT event_id, user_id, cents,
               CASE WHEN COUNT(cents) OVER f >= {window} THEN {_aggregate(op)} END AS "{name}"
        FROM ev WINDOW f AS ({part} ORDER BY ts, event_id
            ROWS BETWEEN {bound(window - 1 + lag)} AND {bound(lag)})"""


def _rolling_cumulative(op: str, key: str) -> str:
    return f"""WITH {_EVENTS}, rolled AS (
            SELECT *, CASE WHEN COUNT(cents) OVER f >= 4 THEN {_aggregate(op)} END AS r
            FROM ev WINDOW f AS (PARTITION BY {key} ORDER BY ts, event_id
                ROWS BETWEEN 5 PRECEDING AND 2 PRECEDING))
        SELECT event_id, user_id, cents, CASE WHEN r IS NOT NULL THEN
               {"SUM(r) OVER g" if op == "mean" else "CAST(SUM(r) OVER g AS BIGINT)"}
               END AS rolling_{op}_cents
        FROM rolled WINDOW g AS (PARTITION BY {key} ORDER BY ts, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


def _cumulative(key: str) -> str:
    return f"""WITH {_SPARSE}
        SELECT event_id, user_id, cents, CASE WHEN cents IS NOT NULL THEN CAST(SUM(cents) OVER (
            PARTITION BY {key} ORDER BY ts, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) END AS "Acumulacion_cents"
        FROM ev"""


def _rank(expression: str) -> str:
    return f"""WITH {_SPARSE}, ranked AS (
            SELECT event_id, {expression} AS place FROM ev WHERE cents IS NOT NULL)
        SELECT event_id, user_id, cents, place AS "Rank_cents"
        FROM ev LEFT JOIN ranked USING (event_id)"""


def _minmax(column: str) -> str:
    return f"""({column} - (SELECT MIN({column}) FROM lineitem)) /
        ((SELECT MAX({column}) FROM lineitem) - (SELECT MIN({column}) FROM lineitem))"""


def _zscore(column: str) -> str:
    return f"""ROUND(({column} - (SELECT AVG({column}) FROM lineitem)) /
        (SELECT STDDEV_SAMP({column}) FROM lineitem), 6)"""


_LENGTHS = "list_transform(string_split(text, ' '), lambda w: length(w))"
_EVEN = f"list_filter({_LENGTHS}, lambda n: n % 2 = 0)"

_MULTI_STAGE = f"""WITH {_EVENTS}, clean AS (SELECT * FROM ev WHERE event_type <> 'error'),
    rolled AS (
        SELECT user_id, cents, CASE WHEN COUNT(cents) OVER f >= 4 THEN AVG(cents) OVER f END AS r
        FROM clean WINDOW f AS (PARTITION BY user_id ORDER BY ts, event_id
            ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))"""

_FEATURE_BUNDLE = f"""WITH {_EVENTS}
    SELECT event_id, user_id, cents,
           CASE WHEN COUNT(cents) OVER f >= 3 THEN CAST(SUM(cents) OVER f AS BIGINT) END
               AS "Rolling_cents",
           CAST(SUM(cents) OVER g AS BIGINT) AS "Acumulacion_cents",
           DENSE_RANK() OVER (ORDER BY cents) AS "Rank_cents"
    FROM ev WINDOW f AS (ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
        g AS (PARTITION BY user_id ORDER BY ts, event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

# The doubles of the exact sums as whole numbers of 2**-20: added exactly, and rounded once by reading their digits.
_DOUBLES = """ev AS (
    SELECT event_id, ts, user_id, event_type,
           CAST(ROUND(value * 100) AS HUGEINT) * CAST(POW(2, event_id % 40) AS HUGEINT) AS h
    FROM events)"""


def _nearest(whole: str) -> str:
    return f"CAST(CAST({whole} AS VARCHAR) AS DOUBLE)"


_X = f"{_nearest('h')} / 1048576.0 AS x"


def _double_rolling(window: int) -> str:
    total = _nearest("SUM(h) OVER f")
    return f"""WITH {_DOUBLES} SELECT event_id, user_id, {_X},
        CASE WHEN COUNT(h) OVER f >= {window} THEN {total} / 1048576.0 / {window} END AS rolling_mean_x
        FROM ev WINDOW f AS (PARTITION BY event_type ORDER BY ts, event_id
            ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)"""


_DOUBLE_CUMSUM = f"""WITH {_DOUBLES} SELECT event_id, user_id, {_X},
    {_nearest('SUM(h) OVER (PARTITION BY event_type ORDER BY ts, event_id)')} / 1048576.0 AS "Acumulacion_x" FROM ev"""

_DOUBLE_ROLLING_CUMSUM = f"""WITH {_DOUBLES}, rolled AS (
        SELECT *, CASE WHEN COUNT(h) OVER f >= 4 THEN CAST({_nearest("SUM(h) OVER f")} AS HUGEINT) END AS r
        FROM ev WINDOW f AS (PARTITION BY event_type ORDER BY ts, event_id
            ROWS BETWEEN 5 PRECEDING AND 2 PRECEDING))
    SELECT event_id, user_id, {_X}, CASE WHEN r IS NOT NULL THEN
        {_nearest("SUM(r) OVER (PARTITION BY event_type ORDER BY ts, event_id)")} / 4194304.0 END AS rolling_mean_x
    FROM rolled"""

ORACLE: dict[str, str] = {
    "src_csv": "SELECT * FROM customer",
    "src_csv_inferred": "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
    "src_parquet": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
        CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders""",
    "src_multi_csv": """SELECT c_custkey, c_name, n_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "src_dispatch": """SELECT o_orderkey, c_custkey, c_name, o_totalprice
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "src_row_count": "SELECT COUNT(*) AS row_count FROM lineitem",
    "sink_parquet": _PLAIN_EVENTS,
    "sink_parquet_zstd": _PLAIN_EVENTS,
    "sink_n_parts": _PLAIN_EVENTS,
    "sink_row_groups": """SELECT CAST(COUNT(*) AS BIGINT) AS row_count, LEAST(COUNT(*), 50) AS largest,
        CAST(0 AS BIGINT) AS short_inside FROM events""",
    "sink_counted": "SELECT COUNT(*) AS written, COUNT(*) AS row_count FROM events",
    "flow_require_rows": """SELECT p_brand, CAST(SUM(p_size) AS BIGINT) AS "Total_Edad"
        FROM part WHERE p_size = 30 GROUP BY p_brand""",
    "map_batches_sized": """SELECT size AS batch_size, COUNT(*) AS row_count, LEAST(COUNT(*), size) AS largest
        FROM events, (VALUES (100), (37)) AS sizes(size) GROUP BY size""",
    "join_partitioned_equal_rows": """SELECT user_id, event_type, c_name
        FROM events LEFT JOIN customer ON user_id = c_custkey""",
    "group_sum_double": f"""WITH {_DOUBLES} SELECT event_type, {_nearest('SUM(h)')} / 1048576.0 AS sum_x
        FROM ev GROUP BY event_type""",
    "group_mean_double": f"""WITH {_DOUBLES} SELECT user_id, {_nearest('SUM(h)')} / 1048576.0 / COUNT(*) AS mean_x
        FROM ev GROUP BY user_id""",
    **{f"cumsum_double_by_{k}": _DOUBLE_CUMSUM for k in ("key", "large_key")},
    **{f"rolling_mean_double_by_{k}": _double_rolling(4) for k in ("key", "large_key")},
    **{f"rolling_mean_double_in_runs_by_{k}": _double_rolling(128) for k in ("key", "large_key")},
    **{f"rolling_mean_cumsum_double_by_{k}": _DOUBLE_ROLLING_CUMSUM for k in ("key", "large_key")},
    "rolling_sum_long_reach_blocks": _rolling("sum", 1_500, 0, None, "Rolling_cents", _EVENTS),
    "sink_partitioned": f"WITH {_EVENTS} SELECT event_id, user_id, cents, event_type FROM ev",
    "sink_keep_existing": _PLAIN_EVENTS,
    "label_threshold": """SELECT l_orderkey, l_linenumber, l_quantity,
        CASE WHEN l_quantity < 25 THEN 'Bajo' ELSE 'Alto' END AS "l_quantity_diferiencia"
        FROM lineitem""",
    "label_threshold_nulls": f"""WITH {_SPARSE} SELECT event_id, user_id, cents,
        CASE WHEN cents < 5000 THEN 'Bajo' ELSE 'Alto' END AS "cents_diferiencia" FROM ev""",
    "label_sql_expr": """SELECT event_id, user_id, value,
        CASE WHEN value > 50 THEN 'Alto' ELSE 'Bajo' END AS "Categoria_value",
        CASE WHEN user_id <= 75 THEN 'Alto' ELSE 'Bajo' END AS "Categoria_user_id" FROM events""",
    "label_named_predicate": f"""WITH {_SPARSE} SELECT event_id, user_id, cents,
        CASE WHEN cents IS NULL THEN 'yes' ELSE 'no' END AS "Categoria_cents",
        CASE WHEN user_id IS NOT NULL THEN 'yes' ELSE 'no' END AS "Categoria_user_id" FROM ev""",
    "label_if_present": """SELECT customer.*,
        CASE WHEN c_acctbal < 50 THEN 'Bajo' ELSE 'Alto' END AS "c_acctbal_diferiencia", o_orderkey
        FROM customer JOIN orders ON c_custkey = o_custkey""",
    "filter_group_sum": """SELECT p_brand, CAST(SUM(p_size) AS BIGINT) AS "Total_Edad"
        FROM part WHERE p_size = 30 GROUP BY p_brand""",
    "filter_not_null": f"""WITH {_EVENTS}
        SELECT event_id, user_id, cents FROM ev WHERE event_type <> 'error'""",
    "filter_even_rows": """SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem
        WHERE l_linenumber % 2 = 0""",
    "array_filter_even": f"""SELECT doc_id, array_to_string({_EVEN}, ',') AS even,
        array_to_string(list_sort({_EVEN}), ',') AS sorted_even FROM documents""",
    "array_latest_section": f"""SELECT source, array_to_string({_EVEN}, ',') AS even
        FROM documents JOIN (SELECT source, MAX(doc_id) AS doc_id FROM documents GROUP BY source)
        USING (source, doc_id)""",
    "join_inner": _joined("INNER"),
    "join_left": _joined("LEFT"),
    "join_right": _joined("RIGHT"),
    "join_full": _joined("FULL"),
    "join_full_keep_keys": f"""WITH {_JOIN_SIDES}
        SELECT event_id, l.user_id AS user_id, cents, c_name, c_acctbal, r.user_id AS user_id_right
        FROM l FULL JOIN r ON l.user_id = r.user_id""",
    "join_full_large_keys": _joined("FULL"),
    "join_partitioned": """SELECT c_custkey, o_orderkey, o_totalprice, c_name
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "join_partitioned_large_keys": _joined("FULL"),
    "join_suffix": """SELECT o_custkey AS key, o_orderkey, o_totalprice AS amount,
        c_acctbal AS amount_right FROM orders JOIN customer ON o_custkey = c_custkey""",
    "label_then_join": f"""WITH {_EVENTS} SELECT event_id, user_id, cents,
        CASE WHEN cents > 5000 THEN 'Alto' ELSE 'Bajo' END AS "Categoria_cents", c_name, c_acctbal
        FROM ev JOIN customer ON user_id = c_custkey""",
    "label_both_then_join": f"""WITH {_EVENTS} SELECT event_id, user_id, cents AS amount,
        CASE WHEN cents < 50 THEN 'Bajo' ELSE 'Alto' END AS "amount_diferiencia",
        c_name, c_acctbal AS amount_right,
        CASE WHEN c_acctbal < 50 THEN 'Bajo' ELSE 'Alto' END AS "amount_diferiencia_right"
        FROM ev JOIN customer ON user_id = c_custkey""",
    "group_mean": f"""WITH {_EVENTS}
        SELECT user_id, AVG(cents) AS mean_cents FROM ev GROUP BY user_id""",
    "group_sum": f"""WITH {_EVENTS}
        SELECT user_id, CAST(SUM(cents) AS BIGINT) AS sum_cents FROM ev GROUP BY user_id""",
    "group_min": "SELECT user_id, MIN(value) AS min_value FROM events GROUP BY user_id",
    "group_max": "SELECT user_id, MAX(value) AS max_value FROM events GROUP BY user_id",
    "broadcast_agg_map": f"""WITH {_EVENTS} SELECT event_id, user_id, cents,
        (SELECT CAST(SUM(cents) AS BIGINT) FROM ev) AS sum_cents,
        (SELECT AVG(user_id) FROM ev) AS mean_user_id FROM ev""",
    "broadcast_agg": f"""WITH {_EVENTS} SELECT event_id, user_id, cents,
        (SELECT MIN(cents) FROM ev) AS min_cents,
        (SELECT MIN(user_id) FROM ev) AS min_user_id FROM ev""",
    "column_mean": "SELECT AVG(l_quantity) AS mean_l_quantity FROM lineitem",
    "guarded_sum": "SELECT SUM(l_quantity) AS sum_l_quantity FROM lineitem",
    "sum_times_factor": f"""WITH {_EVENTS}
        SELECT CAST(SUM(cents) * 5 AS BIGINT) AS sum_times_cents FROM ev""",
    "metric_summary": f"""WITH {_EVENTS} SELECT event_type, AVG(cents) AS mean, MAX(cents) AS max,
        MIN(cents) AS min, COUNT(cents) AS samples FROM ev GROUP BY event_type""",
    "rolling_mean_by_large_key": _rolling(
        "mean", 4, 0, "event_type", "rolling_mean_cents", _SPARSE
    ),
    "rolling_mean_cumsum_by_large_key": _rolling_cumulative("mean", "event_type"),
    "rolling_over_self": """SELECT p_partkey, p_size,
        CASE WHEN COUNT(p_size) OVER f >= 3 THEN AVG(p_size) OVER f END AS rolling_mean_p_size
        FROM part WINDOW f AS (PARTITION BY p_size ORDER BY p_partkey
            ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)""",
    "rolling_mean_global": _rolling("mean", 2, 1, None, "Rolling_cents", _EVENTS),
    "rolling_sum_global": _rolling("sum", 3, 1, None, "Rolling_cents", _EVENTS),
    "rolling_mean_lead": _rolling("mean", 2, -1, None, "Rolling_cents", _EVENTS),
    "rolling_sum_wide": _rolling("sum", 1000, 0, None, "Rolling_cents", _EVENTS),
    "cumsum_by_key": _cumulative("user_id"),
    "cumsum_by_large_key": _cumulative("event_type"),
    "lag_by_key": f"""WITH {_EVENTS} SELECT event_id, user_id, cents,
        LAG(cents, 2) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS shift_cents FROM ev""",
    "rank_average": _rank(
        "RANK() OVER (ORDER BY cents) + (COUNT(*) OVER (PARTITION BY cents) - 1) / 2.0::DOUBLE"
    ),
    "rank_dense": _rank("DENSE_RANK() OVER (ORDER BY cents)"),
    "rank_min": _rank("RANK() OVER (ORDER BY cents)"),
    "feature_bundle": _FEATURE_BUNDLE,
    "scale_minmax_one": f"""SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
        {_minmax("l_quantity")} AS l_quantity_normalize FROM lineitem""",
    "scale_minmax_many": f"""SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
        {_minmax("l_quantity")} AS "MinMax_l_quantity",
        {_minmax("l_extendedprice")} AS "MinMax_l_extendedprice" FROM lineitem""",
    "scale_zscore_many": f"""SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
        {_zscore("l_quantity")} AS "Zscore_l_quantity",
        {_zscore("l_extendedprice")} AS "Zscore_l_extendedprice" FROM lineitem""",
    "scale_zscore_guarded": f"""SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
        3 AS flat, {_zscore("l_quantity")} AS scaler_l_quantity, 0.0::DOUBLE AS scaler_flat
        FROM lineitem""",
    "scale_minmax_guarded": f"""SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
        3 AS flat, {_minmax("l_quantity")} AS minmax_l_quantity, 0.0::DOUBLE AS minmax_flat
        FROM lineitem""",
    "map_batches_arrow": f"""WITH {_EVENTS}
        SELECT event_id, cents, cents * 2 AS doubled FROM ev""",
    "map_groups_arrow": f"""WITH {_EVENTS}
        SELECT user_id, AVG(cents) AS mean_cents FROM ev GROUP BY user_id""",
    "strategy_rolling": """SELECT p_partkey, p_brand,
        CASE WHEN COUNT(p_size) OVER f >= 3 THEN CAST(SUM(p_size) OVER f AS BIGINT) END
            AS rolling_sum_p_size
        FROM part WINDOW f AS (PARTITION BY p_size ORDER BY p_partkey
            ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)""",
    "strategy_ml": f"""SELECT l_orderkey, l_linenumber,
        {_minmax("l_quantity")} AS "MinMax_l_quantity",
        {_minmax("l_extendedprice")} AS "MinMax_l_extendedprice" FROM lineitem""",
    "strategy_ml_aggregate": """SELECT l_orderkey, l_linenumber,
        (SELECT SUM(l_quantity) FROM lineitem) AS sum_l_quantity,
        (SELECT AVG(l_orderkey) FROM lineitem) AS mean_l_orderkey FROM lineitem""",
    "strategy_join": """SELECT event_id, user_id, c_name, c_mktsegment,
        CASE WHEN user_id > 75 THEN 'Alto' ELSE 'Bajo' END AS "Categoria_user_id"
        FROM events JOIN customer ON user_id = c_custkey""",
    "scale_and_write": f"""SELECT l_orderkey, l_linenumber,
        {_minmax("l_quantity")} AS minmax_l_quantity FROM lineitem""",
    "label_join_write": """SELECT o_orderkey, c_custkey, c_name,
        CASE WHEN o_totalprice < 50 THEN 'Bajo' ELSE 'Alto' END AS "o_totalprice_diferiencia"
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "multi_stage_etl": f"""{_MULTI_STAGE}
        SELECT user_id, AVG(r) AS "mean_rolling_mean_cents" FROM rolled GROUP BY user_id""",
    "multi_stage_etl_source_column": f"""{_MULTI_STAGE}
        SELECT user_id, AVG(cents) AS mean_cents FROM rolled GROUP BY user_id""",
}

for _op in ("mean", "sum", "min", "max"):
    ORACLE[f"rolling_{_op}_by_key"] = _rolling(
        _op, 4, 0, "user_id", f"rolling_{_op}_cents", _SPARSE
    )
for _op in ("mean", "sum", "max"):
    ORACLE[f"rolling_{_op}_cumsum_by_key"] = _rolling_cumulative(_op, "user_id")

for _name in (
    "rolling_mean_global", "rolling_sum_global", "rolling_mean_lead", "rolling_sum_wide",
    "rank_average", "rank_dense", "rank_min", "feature_bundle",
):
    ORACLE[f"{_name}_blocks"] = ORACLE[_name]


def _wide(aggregate: str, value: str, outer: str) -> str:
    return f"""SELECT event_id, {outer.format(
        f"CASE WHEN COUNT({value}) OVER w >= 2000 THEN {aggregate}({value}) OVER w END")} AS rolled
        FROM events WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN 1999 PRECEDING AND CURRENT ROW)"""


for _op, _aggregate in (("sum", "SUM"), ("mean", "AVG"), ("min", "MIN"), ("max", "MAX")):
    ORACLE[f"rolling_{_op}_wide_double"] = _wide(_aggregate, "value", "ROUND({}, 6)")
ORACLE["rolling_sum_wide_decimal"] = _wide("SUM", "CAST(value AS DECIMAL(12,2))", "CAST({} AS DOUBLE)")
ORACLE["join_suffix_case"] = """SELECT n_regionkey AS region_key, n_name AS nation, r_name AS region
    FROM nation JOIN region ON n_regionkey = r_regionkey"""

_PART = "p_partkey, p_name, p_brand, p_type, p_size, p_retailprice"
_ROLLED = "ROWS BETWEEN {} PRECEDING AND 1 PRECEDING"
ORACLE["reduce_groups_arrow"] = ORACLE["map_groups_arrow"]
ORACLE["scale_or_aggregate_write"] = f"""SELECT {_PART},
    CAST(SUM(p_size) OVER () AS BIGINT) AS sum_p_size FROM part"""
ORACLE["flow_filter_group"] = ORACLE["filter_group_sum"]
ORACLE["flow_rolling_columns"] = f"""SELECT {_PART},
    CASE WHEN COUNT(p_size) OVER f >= 4 THEN AVG(p_size) OVER f END AS "Rolling_p_size"
    FROM part WINDOW f AS (ORDER BY p_partkey {_ROLLED.format(4)})"""
ORACLE["flow_join_tables"] = """SELECT c_custkey, o_orderkey, o_orderstatus, o_totalprice,
    CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority, c_name, c_nationkey, c_acctbal, c_mktsegment
    FROM orders JOIN customer ON o_custkey = c_custkey"""
ORACLE["flow_normalize"] = f"""SELECT {_PART}, (p_size - (SELECT MIN(p_size) FROM part)) /
    ((SELECT MAX(p_size) FROM part) - (SELECT MIN(p_size) FROM part)) AS p_size_normalize FROM part"""
ORACLE["flow_rolling_cumulative"] = f"""WITH rolled AS (SELECT {_PART},
        CASE WHEN COUNT(p_size) OVER f >= 3 THEN SUM(p_size) OVER f END AS r
        FROM part WINDOW f AS (PARTITION BY p_brand ORDER BY p_partkey {_ROLLED.format(3)}))
    SELECT {_PART}, CASE WHEN r IS NOT NULL THEN CAST(SUM(r) OVER (PARTITION BY p_brand ORDER BY p_partkey
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) END AS rolling_sum_p_size FROM rolled"""
ORACLE["flow_feature_bundle"] = f"""SELECT {_PART},
    CASE WHEN COUNT(p_size) OVER f >= 3 THEN CAST(SUM(p_size) OVER f AS BIGINT) END AS "Rolling_p_size",
    CAST(SUM(p_size) OVER g AS BIGINT) AS "Acumulacion_p_size",
    DENSE_RANK() OVER (ORDER BY p_size) AS "Rank_p_size"
    FROM part WINDOW f AS (ORDER BY p_partkey {_ROLLED.format(3)}),
    g AS (PARTITION BY p_brand ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
ORACLE["flow_multi_stage"] = """SELECT p_brand, CAST(SUM(p_size) AS BIGINT) AS sum_p_size
    FROM part WHERE p_name IS NOT NULL GROUP BY p_brand"""
