"""DuckDB SQL oracles for the registered queries.

Written independently of the Spark code: the vendor views, fill rules and
comparisons are re-stated here in plain SQL over the driver's tables
(``events orders customer lineitem nation region``)."""

from __future__ import annotations

from .catalog import TableSpec
from .queries import KEYED_FORMS
from .sources import vendor as V

ORACLES: dict[str, str] = {}


def oracle(name: str):
    def deco(fn):
        ORACLES[name] = fn()
        return fn
    return deco


# --------------------------------------------------------------------------
# vendor views in SQL
# --------------------------------------------------------------------------
WINDEVENTS_SRC = """
SELECT event_id,
       ts AS OPDATE,
       CASE WHEN event_type IN ('signup', 'click') THEN '0'
            WHEN event_type IN ('view', 'purchase') THEN '1' ELSE '2' END AS OPMODE,
       strftime(CAST(ts AS DATE) + CAST(event_id % 5 - 2 AS INTEGER), '%Y%m%d') AS TRADE_DT,
       CASE WHEN event_id % 9 = 0 THEN NULL ELSE user_id END AS user_id,
       CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 7 = 1 THEN CAST('NaN' AS DOUBLE)
            ELSE value END AS value_num,
       CASE WHEN event_id % 6 = 0 THEN NULL WHEN event_id % 6 = 1 THEN 'None'
            WHEN event_id % 6 = 2 THEN 'none' ELSE event_type END AS value_txt,
       CASE WHEN event_id % 10 = 3 THEN NULL ELSE ts END AS UPDATE_TIME,
       props AS extra
FROM events"""

ORDERSFEED_SRC = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       o_orderdate AS ENTRYTIME,
       strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 - 1 AS INTEGER), '%Y%m%d') AS con_date,
       o_orderpriority
FROM orders"""

CUSTOMERSNAP_SRC = """
SELECT c_custkey,
       CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 7 = 1 THEN 'None' ELSE c_name END AS c_name,
       CASE WHEN c_custkey % 7 = 5 THEN 'None' WHEN c_custkey % 7 = 6 THEN NULL
            ELSE CAST(c_nationkey AS VARCHAR) END AS c_nationkey_txt,
       CASE WHEN c_custkey % 7 = 2 THEN NULL WHEN c_custkey % 7 = 3 THEN CAST('NaN' AS DOUBLE)
            ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_custkey % 7 = 4 THEN 'None' ELSE CAST(c_acctbal AS VARCHAR) END AS c_acctbal_txt,
       c_mktsegment
FROM customer"""

LINEITEMFEED_SRC = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus,
       l_shipdate AS ENTRYTIME, strftime(l_shipdate, '%Y%m%d') AS ship_dt
FROM lineitem"""

WINDORDERS_SRC = """
SELECT o_orderkey, o_orderdate AS OPDATE, CAST(o_orderkey % 3 AS VARCHAR) AS OPMODE,
       strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 - 2 AS INTEGER), '%Y%m%d') AS TRADE_DT,
       o_custkey, o_totalprice
FROM orders"""

WINDLINES_SRC = """
SELECT l_orderkey, l_linenumber, l_shipdate AS OPDATE, CAST((l_orderkey + l_linenumber) % 3 AS VARCHAR) AS OPMODE,
       strftime(CAST(l_shipdate AS DATE) + CAST((l_orderkey + l_linenumber) % 5 - 2 AS INTEGER), '%Y%m%d') AS TRADE_DT,
       l_quantity, l_returnflag
FROM lineitem"""

CHANGED_ORDERS = """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderkey % 89 = 0 THEN o_totalprice + 0.5 ELSE o_totalprice END AS o_totalprice,
       o_orderdate,
       CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
       o_orderstatus AS o_flag
FROM orders WHERE o_orderkey % 97 <> 0
UNION ALL
SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       o_orderpriority, o_orderstatus AS o_flag
FROM orders WHERE o_orderkey % 101 = 0"""

SOURCES = {
    "windevents": WINDEVENTS_SRC, "ordersfeed": ORDERSFEED_SRC,
    "customersnap": CUSTOMERSNAP_SRC, "lineitemfeed": LINEITEMFEED_SRC,
    "windorders": WINDORDERS_SRC, "windlines": WINDLINES_SRC,
    "nationsnap": "SELECT * FROM nation", "regionsnap": "SELECT * FROM region",
}


# --------------------------------------------------------------------------
# fill and conversion rules in SQL
# --------------------------------------------------------------------------
def sql_text_fill(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR {c} = 'None' THEN '' ELSE {c} END"


def sql_epoch_seconds(c: str) -> str:
    return f"CAST(trunc(epoch_us({c}) / 1000000.0) AS BIGINT)"


def sql_day_int(c: str) -> str:
    return f"COALESCE(CAST(strftime({c}, '%Y%m%d') AS BIGINT), 19700101)"


def sql_column(name: str, logical: str, src_kind: str, change: bool, parquet: str = "") -> str:
    """One normalised column.  ``src_kind``: num, int, text, ts."""
    c = f'"{name}"'
    if parquet == "int32" and not change:
        inner = sql_column(name, logical, src_kind, change).rsplit(" AS ", 1)[0]
        return f"CAST({inner} AS INTEGER) AS {c}"
    if change:
        return f"{sql_day_int(c)} AS {c}"
    if logical == "float64":
        if src_kind == "text":
            v = f"CAST(NULLIF({c}, 'None') AS DOUBLE)"
        elif src_kind == "num":
            v = f"CASE WHEN isnan({c}) THEN 0.0 ELSE {c} END"
        else:
            v = f"CAST({c} AS DOUBLE)"
        return f"COALESCE({v}, 0.0) AS {c}"
    if logical == "int64":
        if src_kind == "text":
            v = f"CAST(NULLIF({c}, 'None') AS BIGINT)"
        elif src_kind == "ts":
            v = sql_epoch_seconds(c)
        elif src_kind == "num":
            v = f"CAST(trunc(CASE WHEN isnan({c}) THEN 0.0 ELSE {c} END) AS BIGINT)"
        else:
            v = f"CAST({c} AS BIGINT)"
        return f"COALESCE({v}, 0) AS {c}"
    return f"{sql_text_fill(c)} AS {c}"


# Source column kinds of the vendor views (what the SQL needs to know to
# pick a fill rule; Spark reads it from the schema).
KINDS = {
    "windevents": {"event_id": "int", "OPDATE": "ts", "OPMODE": "text", "TRADE_DT": "text",
                   "user_id": "int", "value_num": "num", "value_txt": "text",
                   "UPDATE_TIME": "ts"},
    "ordersfeed": {"o_orderkey": "int", "o_custkey": "int", "o_orderstatus": "text",
                   "o_totalprice": "num", "ENTRYTIME": "ts", "con_date": "text",
                   "o_orderpriority": "text"},
    "customersnap": {"c_custkey": "int", "c_name": "text", "c_nationkey_txt": "text",
                     "c_acctbal": "num", "c_acctbal_txt": "text", "c_mktsegment": "text"},
    "lineitemfeed": {"l_orderkey": "int", "l_linenumber": "int", "l_quantity": "num",
                     "l_extendedprice": "num", "l_returnflag": "text", "ENTRYTIME": "ts",
                     "ship_dt": "text"},
    "windorders": {"o_orderkey": "int", "OPDATE": "ts", "OPMODE": "text", "TRADE_DT": "text",
                   "o_custkey": "int", "o_totalprice": "num"},
    "windlines": {"l_orderkey": "int", "l_linenumber": "int", "OPDATE": "ts", "OPMODE": "text",
                  "TRADE_DT": "text", "l_quantity": "num", "l_returnflag": "text"},
    "nationsnap": {"n_nationkey": "int", "n_name": "text", "n_regionkey": "int"},
    "regionsnap": {"r_regionkey": "int", "r_name": "text"},
}


def sql_select_list(spec: TableSpec, change_day: bool, load_date: str | None) -> str:
    kinds = KINDS[spec.table_name]
    cols = [sql_column(c.name, c.logical_type, kinds[c.name],
                       change_day and c.name == spec.change_column, c.parquet_type)
            for c in spec.all_cols if c.name in kinds]
    if load_date is not None:
        cols.append(f"CAST({int(load_date)} AS BIGINT) AS LOAD_DATE")
    return ",\n       ".join(cols)


def day_range_sql(col: str, load_date: str) -> str:
    d = f"{load_date[:4]}-{load_date[4:6]}-{load_date[6:]}"
    return f"{col} >= TIMESTAMP '{d}' AND {col} < TIMESTAMP '{d}' + INTERVAL 1 DAY"


def entry_time_sql(col: str, load_date: str) -> str:
    d = f"{load_date[:4]}-{load_date[4:6]}-{load_date[6:]}"
    return f"{col} = TIMESTAMP '{d}'"


def change_rows_sql(spec: TableSpec, load_date: str) -> str:
    """Rows of a change-date load, as the vendor query would run them:
    a true UNION ALL of the two mode branches for the wind family."""
    src = SOURCES[spec.table_name]
    if spec.is_wind:
        day = day_range_sql(spec.change_column, load_date)
        return (f"SELECT * FROM ({src}) s WHERE {day} AND OPMODE = '0'\n"
                f"UNION ALL\n"
                f"SELECT * FROM ({src}) s WHERE {day} AND OPMODE = '1' "
                f"AND {spec.date_column} >= '{load_date}'")
    return f"SELECT * FROM ({src}) s WHERE {entry_time_sql(spec.change_column, load_date)}"


def business_rows_sql(spec: TableSpec, load_date: str) -> str:
    return f"SELECT * FROM ({SOURCES[spec.table_name]}) s WHERE {spec.date_column} = '{load_date}'"


def load_sql(spec: TableSpec, load_date: str, by: str, change_day: bool = True,
             with_load_date: bool = True) -> str:
    if not spec.dynamic:
        rows = SOURCES[spec.table_name]
    elif by == "change":
        rows = change_rows_sql(spec, load_date)
    else:
        rows = business_rows_sql(spec, load_date)
    sel = sql_select_list(spec, change_day,
                          load_date if (with_load_date and (spec.dynamic or load_date)) else None)
    return f"SELECT {sel}\nFROM ({rows}) r"


W, O = V.WIND_LOAD_DATE, V.OTHER_LOAD_DATE


@oracle("daily_load_change")
def _():
    return load_sql(V.WINDEVENTS, W, "change")


@oracle("daily_load_business")
def _():
    return load_sql(V.WINDEVENTS, W, "business")


@oracle("daily_load_v1")
def _():
    return load_sql(V.ORDERSFEED, O, "business", change_day=False, with_load_date=False)


def _count(sql: str) -> str:
    return f"(SELECT count(*) FROM ({sql}) c)"


def _audit_rows(specs, day, by) -> str:
    parts = []
    for s in specs:
        rows = change_rows_sql(s, day) if by == "change" else business_rows_sql(s, day)
        n = _count(rows)
        parts.append(f"SELECT '{s.original_table}' AS select_table, {n} = 0 AS table_empty, "
                     f"CAST({n} AS BIGINT) AS row_count, 'loaded' AS status")
    return "\nUNION ALL\n".join(parts)


FLAGGED = [V.WINDEVENTS, V.ORDERSFEED]


@oracle("daily_load_all")
def _():
    return _audit_rows(FLAGGED, W, "change")


@oracle("select_tables_listed")
def _():
    n = _count(business_rows_sql(V.ORDERSFEED, O))
    return (f"SELECT 'ORDERSFEED' AS select_table, {n} = 0 AS table_empty, CAST({n} AS BIGINT) AS row_count, "
            f"'loaded' AS status "
            f"UNION ALL SELECT 'CUSTOMERSNAP', false, (SELECT count(*) FROM customer), 'loaded' "
            f"UNION ALL SELECT 'NATIONSNAP', false, (SELECT count(*) FROM nation), 'loaded'")


@oracle("list_loaded_tables")
def _():
    return (f"SELECT select_table FROM ({_audit_rows(FLAGGED, W, 'change')}) a "
            f"WHERE NOT table_empty")


@oracle("comparable_tables")
def _():
    return (f"SELECT b.select_table FROM ({_audit_rows(FLAGGED, W, 'business')}) b "
            f"JOIN ({_audit_rows(FLAGGED, W, 'change')}) c USING (select_table) "
            f"WHERE NOT b.table_empty AND NOT c.table_empty")


# --------------------------------------------------------------------------
# comparison in SQL
# --------------------------------------------------------------------------
def _num(kind: str, x: str) -> str:
    """NaN counts as missing; whole numbers stay whole."""
    return f"(CASE WHEN isnan({x}) THEN NULL ELSE {x} END)" if kind == "num" else x


def joined_sql(left: str, right: str, keys: list[str], cols: list[tuple[str, str]],
               extra_left: list[str] = (), extra_right: list[str] = (),
               order: list[str] | None = None) -> str:
    """Full outer join of two loads on null-safe keys with per-column flags.
    ``cols``: shared compared columns with kind (num, int, text, ts).  With
    ``order`` the rows are first numbered within the key (``__ord``)."""
    jk = list(keys)
    if order is not None:
        ob = ", ".join(f"{c} ASC NULLS FIRST" for c in order)
        pk = ", ".join(keys)
        left = f"SELECT *, row_number() OVER (PARTITION BY {pk} ORDER BY {ob}) AS __ord FROM ({left}) x"
        right = f"SELECT *, row_number() OVER (PARTITION BY {pk} ORDER BY {ob}) AS __ord FROM ({right}) x"
        jk = keys + ["__ord"]
    on = " AND ".join(f"l.{k} IS NOT DISTINCT FROM r.{k}" for k in jk)
    sel = [f"CASE WHEN l.__in THEN l.{k} ELSE r.{k} END AS {k}" for k in jk]
    sel += ["COALESCE(l.__in, false) AS in_l", "COALESCE(r.__in, false) AS in_r",
            "CASE WHEN l.__in AND r.__in THEN 'both' WHEN l.__in THEN 'left_only' "
            "ELSE 'right_only' END AS _merge"]
    eqs = []
    for c, kind in cols:
        a, b = f"l.{c}", f"r.{c}"
        if kind in ("num", "int"):
            eq = f"({_num(kind, a)} IS NOT DISTINCT FROM {_num(kind, b)})"
            apart = f"abs({a} - {b})" if kind == "num" else f"abs(CAST({a} AS HUGEINT) - CAST({b} AS HUGEINT))"
            diff = f"CASE WHEN {_num(kind, a)} = {_num(kind, b)} THEN 0.0 WHEN {_num(kind, a)} IS NOT NULL AND {_num(kind, b)} IS NOT NULL THEN CAST({apart} AS DOUBLE) END"
            nd = f"(({_num(kind, a)} IS NULL) <> ({_num(kind, b)} IS NULL))"
        else:
            eq = f"({a} IS NOT DISTINCT FROM {b})"
            diff = "0.0"
            nd = f"(({a} IS NULL) <> ({b} IS NULL))"
        sel += [f"{a} AS {c}__l", f"{b} AS {c}__r", f"{eq} AS {c}__eq",
                f"{diff} AS {c}__diff", f"{nd} AS {c}__nd"]
        eqs.append(eq)
    sel.append(f"({' AND '.join(eqs) if eqs else 'true'}) AS all_eq")
    sel += [f"l.{c} AS {c}__lo" for c in extra_left]
    sel += [f"r.{c} AS {c}__ro" for c in extra_right]
    return (f"SELECT {', '.join(sel)} FROM (SELECT *, true AS __in FROM ({left}) x) l "
            f"FULL OUTER JOIN (SELECT *, true AS __in FROM ({right}) y) r ON {on}")


def counts_sql(j: str) -> str:
    return (f"SELECT count(*) FILTER (WHERE in_l) AS rows_left, "
            f"count(*) FILTER (WHERE in_r) AS rows_right, "
            f"count(*) FILTER (WHERE _merge = 'both') AS rows_common, "
            f"count(*) FILTER (WHERE _merge = 'left_only') AS rows_left_only, "
            f"count(*) FILTER (WHERE _merge = 'right_only') AS rows_right_only, "
            f"count(*) FILTER (WHERE _merge = 'both' AND all_eq) AS rows_all_equal, "
            f"count(*) FILTER (WHERE _merge = 'both' AND NOT all_eq) AS rows_some_unequal "
            f"FROM ({j}) j")


def columns_sql(j: str, cols: list[tuple[str, str, str, str]]) -> str:
    """cols: (name, kind, left_type, right_type)."""
    parts = []
    for c, _, lt, rt in cols:
        parts.append(
            f"SELECT '{c}' AS \"column\", '{lt}' AS left_type, '{rt}' AS right_type, "
            f"count(*) FILTER (WHERE _merge = 'both' AND {c}__eq) AS match_cnt, "
            f"count(*) FILTER (WHERE _merge = 'both' AND NOT {c}__eq) AS unequal_cnt, "
            f"COALESCE(max(CASE WHEN _merge = 'both' THEN {c}__diff END), 0.0) AS max_diff, "
            f"count(*) FILTER (WHERE _merge = 'both' AND {c}__nd) AS null_diff, "
            f"count(*) FILTER (WHERE _merge = 'both' AND NOT {c}__eq) = 0 AS all_match "
            f"FROM ({j}) j")
    return "\nUNION ALL\n".join(parts)


ORDERS_COLS = [("o_custkey", "int", "bigint", "bigint"),
               ("o_orderstatus", "text", "string", "string"),
               ("o_totalprice", "num", "double", "double"),
               ("o_orderdate", "ts", "timestamp_ntz", "timestamp_ntz"),
               ("o_orderpriority", "text", "string", "string")]
ORDERS_J = joined_sql("SELECT * FROM orders", CHANGED_ORDERS, ["o_orderkey"],
                      [(c, k) for c, k, _, _ in ORDERS_COLS], extra_right=["o_flag"])

LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_OTHER = [("l_partkey", "int"), ("l_suppkey", "int"), ("l_quantity", "num"),
              ("l_extendedprice", "num"), ("l_discount", "num"), ("l_tax", "num"),
              ("l_returnflag", "text"), ("l_linestatus", "text"), ("l_shipdate", "ts")]
LINE_RIGHT = ("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
              "l_discount, CASE WHEN l_suppkey % 40 = 0 THEN l_tax + 0.01 ELSE l_tax END AS l_tax, "
              "l_returnflag, l_linestatus, l_shipdate FROM lineitem WHERE l_partkey % 50 <> 0")
LINE_J = joined_sql("SELECT * FROM lineitem", LINE_RIGHT, LINE_KEYS, LINE_OTHER,
                    order=[c for c, _ in LINE_OTHER])


@oracle("reconcile_status")
def _():
    return f"SELECT o_orderkey, 1::BIGINT AS __ord, _merge FROM ({ORDERS_J}) j"


@oracle("reconcile_left_only")
def _():
    return ("SELECT o_orderkey, o_custkey__l AS o_custkey, o_orderstatus__l AS o_orderstatus, "
            "o_totalprice__l AS o_totalprice, o_orderdate__l AS o_orderdate, "
            f"o_orderpriority__l AS o_orderpriority FROM ({ORDERS_J}) j WHERE _merge = 'left_only'")


@oracle("reconcile_right_only")
def _():
    return ("SELECT o_orderkey, o_custkey__r AS o_custkey, o_orderstatus__r AS o_orderstatus, "
            "o_totalprice__r AS o_totalprice, o_orderdate__r AS o_orderdate, "
            "o_orderpriority__r AS o_orderpriority, o_flag__ro AS o_flag "
            f"FROM ({ORDERS_J}) j WHERE _merge = 'right_only'")


@oracle("reconcile_common")
def _():
    cols = ["o_orderkey", "1::BIGINT AS __ord"]
    for c, _, _, _ in ORDERS_COLS:
        cols += [f"{c}__l AS {c}_df_load", f"{c}__r AS {c}_df_opdate", f"{c}__eq AS {c}_match"]
    return f"SELECT {', '.join(cols)} FROM ({ORDERS_J}) j WHERE _merge = 'both'"


@oracle("reconcile_counts")
def _():
    return counts_sql(ORDERS_J)


@oracle("reconcile_columns")
def _():
    return columns_sql(ORDERS_J, ORDERS_COLS)


@oracle("reconcile_max_diff")
def _():
    return f"SELECT \"column\", max_diff FROM ({columns_sql(ORDERS_J, ORDERS_COLS)}) c"


@oracle("reconcile_null_diff")
def _():
    return f"SELECT \"column\", null_diff FROM ({columns_sql(ORDERS_J, ORDERS_COLS)}) c"


@oracle("reconcile_shape")
def _():
    return (f"SELECT 'df_load' AS side, 6 AS n_columns, rows_left AS n_rows FROM ({counts_sql(ORDERS_J)}) a "
            f"UNION ALL SELECT 'df_opdate', 7, rows_right FROM ({counts_sql(ORDERS_J)}) b")


_TYPE_NAMES = ("CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' "
               "WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' "
               "WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END")


@oracle("reconcile_schema")
def _():
    return (f"WITH l AS (SELECT column_name AS c, {_TYPE_NAMES} AS t FROM (DESCRIBE SELECT * FROM orders)), "
            f"r AS (SELECT column_name AS c, {_TYPE_NAMES} AS t FROM (DESCRIBE {CHANGED_ORDERS})) "
            "SELECT COALESCE(l.c, r.c) AS \"column\", l.c IS NOT NULL AS in_left, r.c IS NOT NULL AS in_right, "
            "l.t AS left_type, r.t AS right_type, COALESCE(l.c, r.c) = 'o_orderkey' AS is_key "
            "FROM l FULL OUTER JOIN r ON l.c = r.c")


@oracle("reconcile_sample_unequal")
def _():
    parts = []
    for c, _, _, _ in ORDERS_COLS:
        parts.append(f"SELECT '{c}' AS \"column\", o_orderkey, CAST({c}__l AS VARCHAR) AS left_value, "
                     f"CAST({c}__r AS VARCHAR) AS right_value FROM ({ORDERS_J}) j "
                     f"WHERE _merge = 'both' AND NOT {c}__eq")
    u = " UNION ALL ".join(parts)
    return (f"SELECT \"column\", o_orderkey, 1::BIGINT AS __ord, left_value, right_value FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY \"column\" ORDER BY o_orderkey ASC NULLS FIRST) AS rn FROM ({u}) u) s WHERE rn <= 10")


@oracle("reconcile_sample_one_sided")
def _():
    lo = ("SELECT o_orderkey, o_custkey__l AS o_custkey, o_orderstatus__l AS o_orderstatus, "
          "o_totalprice__l AS o_totalprice, o_orderdate__l AS o_orderdate, "
          "o_orderpriority__l AS o_orderpriority, NULL::VARCHAR AS o_flag, 'left' AS side "
          f"FROM ({ORDERS_J}) j WHERE _merge = 'left_only' ORDER BY o_orderkey LIMIT 10")
    ro = ("SELECT o_orderkey, o_custkey__r, o_orderstatus__r, o_totalprice__r, o_orderdate__r, "
          "o_orderpriority__r, o_flag__ro, 'right' "
          f"FROM ({ORDERS_J}) j WHERE _merge = 'right_only' ORDER BY o_orderkey LIMIT 10")
    return f"SELECT * FROM ({lo}) a UNION ALL SELECT * FROM ({ro}) b"


@oracle("duplicate_keys")
def _():
    return ("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem "
            "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")


@oracle("reconcile_dup_keys")
def _():
    return f"SELECT l_orderkey, l_linenumber, CAST(__ord AS BIGINT) AS __ord, _merge FROM ({LINE_J}) j"


@oracle("reconcile_dup_counts")
def _():
    return counts_sql(LINE_J)


@oracle("reconcile_report")
def _():
    return f"SELECT *, 'ORDERS' AS table_name, '{W}' AS load_date FROM ({counts_sql(ORDERS_J)}) c"


@oracle("values_equal")
def _():
    cols = [f"{c}__eq AS {c}_equal" for c, _, _, _ in ORDERS_COLS]
    return f"SELECT o_orderkey, {', '.join(cols)} FROM ({ORDERS_J}) j WHERE _merge = 'both'"


WIND_COLS = [("event_id", "int"), ("OPDATE", "ts"), ("OPMODE", "text"), ("TRADE_DT", "text"),
             ("user_id", "int"), ("value_num", "num"), ("value_txt", "text"),
             ("UPDATE_TIME", "int"), ("LOAD_DATE", "int")]


def _wind_pair_j() -> str:
    left = load_sql(V.WINDEVENTS, W, "business")
    right = load_sql(V.WINDEVENTS, W, "change")
    lower = ", ".join(f'"{c}" AS {c.lower()}' for c, _ in WIND_COLS)
    cols = [(c.lower(), k) for c, k in WIND_COLS if c != "event_id"]
    return joined_sql(f"SELECT {lower} FROM ({left}) a", f"SELECT {lower} FROM ({right}) b",
                      ["event_id"], cols)


@oracle("daily_reconcile")
def _():
    return counts_sql(_wind_pair_j())


@oracle("daily_load_many")
def _():
    return _audit_rows(V.order_catalog(), O, "change")


def _day_pair_j(spec: TableSpec) -> str:
    """A table's business-date load of the day joined with its change-date load; keys repeat, so rows are numbered."""
    kinds = {"int64": "int", "float64": "num"}
    cols = [(c.name.lower(), kinds.get(c.logical_type, "text")) for c in spec.all_cols] + [("load_date", "int")]
    lower = ", ".join(f'"{n}" AS {n.lower()}' for n in [*(c.name for c in spec.all_cols), "LOAD_DATE"])
    keys = [k.lower() for k in spec.primary_key]
    rest = [c for c in cols if c[0] not in keys]
    return joined_sql(f"SELECT {lower} FROM ({load_sql(spec, O, 'business')}) a", f"SELECT {lower} FROM ({load_sql(spec, O, 'change')}) b",
                      keys, rest, order=[c for c, _ in rest])


@oracle("daily_reconcile_many")
def _():
    parts = []
    for s in V.order_catalog():
        none = f"{_count(business_rows_sql(s, O))} = 0 OR {_count(change_rows_sql(s, O))} = 0"
        parts.append(f"SELECT '{s.original_table}' AS table_name, '{O}' AS load_date, 'compared' AS status, * "
                     f"FROM ({counts_sql(_day_pair_j(s))}) c WHERE NOT ({none})")
        parts.append(f"SELECT '{s.original_table}', '{O}', 'missing', NULL::BIGINT, NULL::BIGINT, NULL::BIGINT, "
                     f"NULL::BIGINT, NULL::BIGINT, NULL::BIGINT, NULL::BIGINT WHERE {none}")
    return " UNION ALL ".join(parts)


@oracle("daily_reconcile_all")
def _():
    biz = change_rows_sql(V.ORDERSFEED, W).replace("SELECT *", "SELECT 1", 1)
    c = counts_sql(_wind_pair_j())
    return (f"SELECT 'WINDEVENTS' AS table_name, '{W}' AS load_date, 'compared' AS status, * FROM ({c}) c "
            f"UNION ALL SELECT 'ORDERSFEED', '{W}', 'missing', NULL::BIGINT, NULL::BIGINT, NULL::BIGINT, "
            f"NULL::BIGINT, NULL::BIGINT, NULL::BIGINT, NULL::BIGINT "
            f"WHERE {_count(change_rows_sql(V.ORDERSFEED, W))} = 0 "
            f"OR {_count(business_rows_sql(V.ORDERSFEED, W))} = 0")


# --------------------------------------------------------------------------
# sources and sinks
# --------------------------------------------------------------------------
@oracle("scan_sql_query")
def _():
    return f"SELECT event_id, OPDATE, OPMODE, TRADE_DT FROM ({WINDEVENTS_SRC}) s WHERE TRADE_DT = '{W}'"


@oracle("scan_chunked")
def _():
    return f"SELECT event_id, event_type, ts FROM events WHERE {day_range_sql('ts', W)}"


@oracle("scan_load_date")
def _():
    return load_sql(V.WINDEVENTS, W, "business")


@oracle("load_partition")
def _():
    return load_sql(V.ORDERSFEED, O, "change")


@oracle("load_snapshot")
def _():
    return load_sql(V.CUSTOMERSNAP, None, "business", change_day=False, with_load_date=False)


@oracle("load_bounded_files")
def _():
    return "SELECT count(*) AS total_rows, true AS within_bound, true AS several_files FROM lineitem"


def _outcome(spec, day, by, profile) -> str:
    rows = change_rows_sql(spec, day) if by == "change" else business_rows_sql(spec, day)
    n = _count(rows)
    date_col = spec.change_column if by == "change" else spec.date_column
    return (f"SELECT '{day}' AS load_date, '{spec.original_table}' AS select_table, "
            f"CASE WHEN {n} > 0 THEN '{spec.original_table}/LOAD_DATE={int(day)}' ELSE '' END AS table_path, "
            f"{n} = 0 AS table_empty, {str(spec.dynamic).lower()} AS dynamic, "
            f"'{date_col}' AS date_column, CAST({n} AS BIGINT) AS row_count, 'loaded' AS status, "
            f"'{profile}' AS profile")


@oracle("skip_empty_load")
def _():
    return _outcome(V.WINDEVENTS, "20300101", "change", "change")


@oracle("load_outcome")
def _():
    return _outcome(V.WINDEVENTS, W, "change", "change")


@oracle("load_sidecar_v1")
def _():
    rows = [(c.name, c.database_type, c.parquet_type) for c in V.ORDERSFEED.all_cols]
    values = ", ".join(f"({i}, '{n}', '{d}', '{p}')" for i, (n, d, p) in enumerate(rows))
    n = _count(business_rows_sql(V.ORDERSFEED, O))
    return (f"SELECT '{V.ORDERSFEED.table_name}' AS table_name, '{V.ORDERSFEED.original_table}' AS original_table, "
            f"'{V.ORDERSFEED.date_column}' AS date_column, CAST(v.position AS INTEGER) AS position, v.column_name, v.original_type, v.parquet_type "
            f"FROM (VALUES {values}) v(position, column_name, original_type, parquet_type) WHERE {n} > 0")


def _keyed_sql(rows) -> str:
    parts = [f"SELECT '{s.table_name}' AS table_name, {key}::BIGINT AS key, {day}::BIGINT AS load_date FROM ({rows(s, day)}) r"
             for s, day, key in ((V.WINDEVENTS, W, "event_id"), (V.ORDERSFEED, O, "o_orderkey"))]
    return " UNION ALL ".join(parts)


@oracle("keyed_load_change")
def _():
    return _keyed_sql(change_rows_sql)


@oracle("keyed_load_business")
def _():
    return _keyed_sql(business_rows_sql)


for _form, (_, _business, _changed) in KEYED_FORMS.items():
    ORACLES[f"keyed_form_{_form}"] = " UNION ALL ".join(
        f"SELECT '{profile}' AS profile, event_id::BIGINT AS event_id FROM ({SOURCES['windevents']}) s WHERE {rule}"
        for profile, rule in (("business", _business), ("change", _changed)) if rule)


@oracle("load_sidecar")
def _():
    rows = [(c.name, c.database_type, c.parquet_type) for c in V.WINDEVENTS.all_cols]
    rows.append(("LOAD_DATE", "derived", "int64"))
    values = ", ".join(f"({i}, '{n}', '{d}', '{p}')" for i, (n, d, p) in enumerate(rows))
    n = _count(change_rows_sql(V.WINDEVENTS, W))
    return ("SELECT 'windevents' AS table_name, 'WINDEVENTS' AS original_table, true AS dynamic, "
            "'OPDATE' AS date_column, 'event_id' AS primary_key, CAST(v.position AS INTEGER) AS position, "
            "v.column_name, v.original_type, v.parquet_type "
            f"FROM (VALUES {values}) v(position, column_name, original_type, parquet_type) WHERE {n} > 0")


# --------------------------------------------------------------------------
# filters
# --------------------------------------------------------------------------
@oracle("filter_business_date")
def _():
    return business_rows_sql(V.WINDEVENTS, W)


@oracle("scan_snapshot")
def _():
    return "SELECT * FROM nation"


@oracle("filter_change_day")
def _():
    return f"SELECT * FROM ({WINDEVENTS_SRC}) s WHERE {day_range_sql('OPDATE', W)}"


@oracle("filter_entry_time")
def _():
    return f"SELECT * FROM ({ORDERSFEED_SRC}) s WHERE {entry_time_sql('ENTRYTIME', O)}"


@oracle("filter_opmode_new")
def _():
    return f"SELECT * FROM ({WINDEVENTS_SRC}) s WHERE OPMODE = '0'"


@oracle("filter_opmode_changed")
def _():
    return f"SELECT * FROM ({WINDEVENTS_SRC}) s WHERE OPMODE = '1' AND TRADE_DT >= '{W}'"


@oracle("incremental_filter")
def _():
    return change_rows_sql(V.WINDEVENTS, W)


@oracle("change_load_union")
def _():
    return change_rows_sql(V.WINDEVENTS, W)


@oracle("load_date_of")
def _():
    return "SELECT event_id, strftime(CAST(ts AS DATE) - 1, '%Y%m%d') AS load_date FROM events"


# --------------------------------------------------------------------------
# projections and scalar rules
# --------------------------------------------------------------------------
@oracle("project_declared")
def _():
    return f"SELECT {sql_select_list(V.ORDERSFEED, False, None)} FROM ({ORDERSFEED_SRC}) s"


@oracle("project_tolerant")
def _():
    return f"SELECT {sql_select_list(V.WINDEVENTS, True, None)} FROM ({WINDEVENTS_SRC}) s"


@oracle("add_load_date")
def _():
    return f"SELECT *, CAST({int(O)} AS BIGINT) AS LOAD_DATE FROM orders"


@oracle("fill_float")
def _():
    return ("SELECT c_custkey, COALESCE(CASE WHEN isnan(c_acctbal) THEN 0.0 ELSE c_acctbal END, 0.0) AS c_acctbal, "
            "COALESCE(CAST(NULLIF(c_acctbal_txt, 'None') AS DOUBLE), 0.0) AS c_acctbal_txt "
            f"FROM ({CUSTOMERSNAP_SRC}) s")


@oracle("fill_int")
def _():
    return ("SELECT event_id, COALESCE(user_id, 0) AS user_id, "
            "COALESCE(CAST(trunc(CASE WHEN isnan(value_num) THEN 0.0 ELSE value_num END) AS BIGINT), 0) AS value_int, "
            f"COALESCE({sql_epoch_seconds('UPDATE_TIME')}, 0) AS update_epoch FROM ({WINDEVENTS_SRC}) s")


@oracle("fill_string")
def _():
    return f"SELECT event_id, {sql_text_fill('value_txt')} AS value_txt FROM ({WINDEVENTS_SRC}) s"


@oracle("to_epoch_seconds")
def _():
    return f"SELECT event_id, {sql_epoch_seconds('ts')} AS epoch_s FROM events"


@oracle("change_day_int")
def _():
    return (f"SELECT event_id, {sql_day_int('OPDATE')} AS opdate_day, {sql_day_int('UPDATE_TIME')} AS update_day, "
            f"{sql_day_int('OPDATE')} AS epoch_day FROM ({WINDEVENTS_SRC}) s")


@oracle("day_text")
def _():
    return "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS day FROM orders"


@oracle("cast_declared")
def _():
    return ("SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, "
            "CAST(trunc(l_quantity) AS BIGINT) AS l_quantity, CAST(l_tax AS VARCHAR) AS l_tax FROM lineitem")


@oracle("check_write_schema")
def _():
    return ("SELECT l_orderkey, CAST(l_orderkey AS INTEGER) AS l_orderkey32, "
            "CAST(l_quantity AS INTEGER) AS l_quantity FROM lineitem")


def _hot_lineitem_sql(changed: bool) -> str:
    src = "lineitem"
    if changed:
        src = ("(SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
               "l_discount, CASE WHEN l_suppkey % 11 = 0 THEN l_tax + 0.01 ELSE l_tax END AS l_tax, "
               "l_returnflag, l_linestatus, l_shipdate FROM lineitem WHERE l_partkey % 7 <> 0)")
    h = "l_orderkey % 3 = 0"
    return (f"SELECT CASE WHEN {h} THEN CAST(0 AS BIGINT) ELSE l_orderkey END AS l_orderkey, "
            f"CASE WHEN {h} THEN l_partkey % 4 ELSE l_partkey END AS l_partkey, "
            f"CASE WHEN {h} THEN CAST(0 AS BIGINT) ELSE l_suppkey END AS l_suppkey, "
            f"CASE WHEN {h} THEN 1 ELSE l_linenumber END AS l_linenumber, "
            f"CASE WHEN {h} THEN 1.0 ELSE l_quantity END AS l_quantity, "
            f"CASE WHEN {h} THEN 1.0 ELSE l_extendedprice END AS l_extendedprice, "
            f"CASE WHEN {h} THEN 0.0 ELSE l_discount END AS l_discount, "
            f"CASE WHEN {h} THEN 0.0 ELSE l_tax END AS l_tax, l_returnflag, l_linestatus, "
            f"CASE WHEN {h} THEN TIMESTAMP '1998-01-01' ELSE l_shipdate END AS l_shipdate FROM {src} s")


@oracle("reconcile_hot_key")
def _():
    j = joined_sql(_hot_lineitem_sql(False), _hot_lineitem_sql(True), LINE_KEYS, LINE_OTHER,
                   order=[c for c, _ in LINE_OTHER])
    return counts_sql(j)


def _hot_j() -> str:
    return joined_sql(_hot_lineitem_sql(False), _hot_lineitem_sql(True), LINE_KEYS, LINE_OTHER,
                      order=[c for c, _ in LINE_OTHER])


@oracle("reconcile_hot_key_status")
def _():
    return (f"SELECT l_linenumber, _merge, count(*) AS n, min(__ord) AS first_ord, max(__ord) AS last_ord, "
            f"sum(__ord)::BIGINT AS sum_ord FROM ({_hot_j()}) j GROUP BY ALL")


@oracle("reconcile_hot_key_columns")
def _():
    cols = [(c, k, "", "") for c, k in LINE_OTHER]
    return f"SELECT \"column\", match_cnt, unequal_cnt, max_diff, null_diff FROM ({columns_sql(_hot_j(), cols)}) c"


@oracle("reconcile_hot_key_constant")
def _():
    left = "SELECT l_orderkey % 3 = 0 AS k, 1 AS v, l_partkey AS own_l FROM lineitem"
    right = "SELECT l_orderkey % 3 = 0 AS k, 1 AS v, l_suppkey AS own_r FROM lineitem WHERE l_partkey % 7 <> 0"
    number = "row_number() OVER (PARTITION BY k ORDER BY {}) AS __ord"
    j = joined_sql(f"SELECT *, {number.format('own_l')} FROM ({left}) x", f"SELECT *, {number.format('own_r')} FROM ({right}) x",
                   ["k", "__ord"], [("v", "int")])
    return counts_sql(j)


@oracle("reconcile_key_types")
def _():
    left = "SELECT o_orderkey::DOUBLE AS k, o_custkey FROM orders"
    right = ("SELECT o_orderkey + CASE WHEN o_orderkey % 7 = 0 THEN 0.5::DOUBLE ELSE 0 END AS k, o_custkey "
             "FROM orders WHERE o_orderkey % 5 <> 0")
    return counts_sql(joined_sql(left, right, ["k"], [("o_custkey", "int")]))


@oracle("reconcile_written_values")
def _():
    """Zeros without sign and NaN as missing from the start; then the plain rule."""
    value = ("CASE l_partkey % 6 WHEN 0 THEN 0.0::DOUBLE WHEN 1 THEN NULL WHEN 2 THEN 'inf'::DOUBLE WHEN 3 THEN NULL "
             "ELSE (l_partkey % 5)::DOUBLE END AS v FROM lineitem")
    j = joined_sql(f"SELECT l_orderkey % 40 AS k, {value}", f"SELECT l_orderkey % 40 AS k, {value} WHERE l_suppkey % 9 <> 0",
                   ["k"], [("v", "num")], order=["v"])
    return " UNION ALL ".join(f"SELECT *, '{way}' AS way FROM ({counts_sql(j)}) c" for way in ("rows", "runs"))


@oracle("reconcile_mostly_equal")
def _():
    right = ("SELECT * REPLACE (CASE WHEN l_orderkey % 2000 = 7 THEN l_tax + 0.01::DOUBLE ELSE l_tax END AS l_tax) "
             "FROM lineitem WHERE l_orderkey % 2000 <> 9")
    return counts_sql(joined_sql("SELECT * FROM lineitem", right, LINE_KEYS, LINE_OTHER, order=[c for c, _ in LINE_OTHER]))


@oracle("values_equal_edges")
def _():
    i = "event_id"
    left = (f"SELECT {i}, {1 << 53} + {i} AS b, CASE {i} % 4 WHEN 0 THEN 'inf'::DOUBLE WHEN 1 THEN 'nan'::DOUBLE "
            f"WHEN 2 THEN NULL ELSE {i}::DOUBLE END AS d FROM events")
    right = (f"SELECT {i}, {1 << 53} + {i} + {i} % 2 AS b, CASE WHEN {i} % 8 < 4 THEN 'inf'::DOUBLE WHEN {i} % 3 = 0 THEN 'nan'::DOUBLE "
             f"WHEN {i} % 3 = 1 THEN NULL ELSE '-inf'::DOUBLE END AS d FROM events")
    return columns_sql(joined_sql(left, right, [i], [("b", "int"), ("d", "num")]),
                       [("b", "int", "bigint", "bigint"), ("d", "num", "double", "double")])


_TAGGED = f"'ORDERS' AS table_name, '{W}' AS load_date"


@oracle("reconcile_report_columns")
def _():
    return f"SELECT *, {_TAGGED} FROM ({columns_sql(ORDERS_J, ORDERS_COLS)}) c"


@oracle("reconcile_report_samples")
def _():
    parts = [f"SELECT '{c}' AS \"column\", o_orderkey FROM ({ORDERS_J}) j WHERE _merge = 'both' AND NOT {c}__eq"
             for c, _, _, _ in ORDERS_COLS]
    return (f"SELECT \"column\", rank, '{{\"o_orderkey\":' || o_orderkey || ',\"__ord\":1}}' AS key, {_TAGGED} FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY \"column\" ORDER BY o_orderkey)::INT AS rank FROM ({' UNION ALL '.join(parts)}) u) s WHERE rank <= 10")


@oracle("reconcile_report_one_sided")
def _():
    def side(name: str) -> str:
        return (f"SELECT '{name}' AS side, row_number() OVER (ORDER BY o_orderkey) AS rank, '{{\"o_orderkey\":' || o_orderkey || '}}' AS key "
                f"FROM ({ORDERS_J}) j WHERE _merge = '{name}_only' QUALIFY rank <= 10")
    return f"{side('left')} UNION ALL {side('right')}"


@oracle("filter_change_day_epoch")
def _():
    return (f"SELECT event_id, epoch_us(ts) // 1000000 AS CHANGED FROM events "
            f"WHERE strftime(ts, '%Y%m%d') = '{W}'")


@oracle("filter_entry_time_epoch")
def _():
    return (f"SELECT o_orderkey, epoch_us(o_orderdate) // 1000000 AS CHANGED FROM orders "
            f"WHERE strftime(o_orderdate, '%Y%m%d') = '{O}' AND epoch(o_orderdate)::BIGINT % 86400 = 0")
