"""Registered plans: CSV blocks, table text, table parsing, percent cells, wide-to-long series, chart data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import number_text, percent_text
from ..operators.common import broadcast_if_small, spread
from ..operators.tables import (chart_series, parse_tables_long, serialize_tables, series_share,
                                unpivot_series)
from ..session import scratch_path
from .registry import register, table
from .sqltext import WS

SUPPLIER_CSV_COLUMNS = ["s_suppkey", "s_name", "s_acctbal"]


@register("csv_block", """
SELECT 'suppliers_' || CAST(s_nationkey AS VARCHAR) || '.csv' AS filename, 0 AS order_index, 'table' AS content_type,
       's_suppkey,s_name,s_acctbal' || chr(10) ||
       string_agg(CAST(s_suppkey AS VARCHAR) || ',' || s_name || ',' || CAST(s_acctbal AS VARCHAR) || chr(10), ''
                  ORDER BY s_suppkey) AS content
FROM supplier GROUP BY s_nationkey""")
def q_csv_block(spark, sf_dir):
    """Suppliers written as CSV files (one folder per nation) to the shared folder, scanned back with the CSV
    source, and each folder turned into one ``(0, 'table', csv text)`` block."""
    from ..sources.files import csv_blocks

    path = scratch_path(spark, "suppliers-csv")
    table(spark, sf_dir, "supplier").write.partitionBy("s_nationkey").option("header", True).csv(path)
    blocks = csv_blocks(spark, path, "s_suppkey long, s_name string, s_acctbal double, s_nationkey int",
                        group_col="s_nationkey", order_col="s_suppkey", columns=SUPPLIER_CSV_COLUMNS)
    return blocks.select(F.concat(F.lit("suppliers_"), F.col("s_nationkey").cast("string"), F.lit(".csv"))
                         .alias("filename"), "order_index", "content_type", "content")


LINE_COLUMNS = ["l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag"]

_SERIALIZE_SQL = f"""
  t AS (
    SELECT l_orderkey,
           'Sheet: order_' || CAST(l_orderkey AS VARCHAR) || chr(10) || '{",".join(LINE_COLUMNS)}' || chr(10) ||
           string_agg(concat_ws(',', {", ".join(f"CAST({c} AS VARCHAR)" for c in LINE_COLUMNS)}) || chr(10), ''
                      ORDER BY {", ".join(LINE_COLUMNS)}) AS content
    FROM lineitem GROUP BY l_orderkey
  )"""


def _order_sheets(spark, sf_dir) -> DataFrame:
    li = spread(table(spark, sf_dir, "lineitem"))
    # Line numbers repeat inside an order in this data, so lines are ordered by all their columns.
    return serialize_tables(li, ["l_orderkey"], LINE_COLUMNS, LINE_COLUMNS,
                            sheet=F.concat(F.lit("order_"), F.col("l_orderkey").cast("string")))


@register("table_serialize", f"WITH {_SERIALIZE_SQL} SELECT * FROM t")
def q_table_serialize(spark, sf_dir):
    """The lines of every order as one CSV sheet text (``Sheet: order_<key>``)."""
    return _order_sheets(spark, sf_dir)


@register("table_parse", f"""WITH {_SERIALIZE_SQL},
  h AS (SELECT l_orderkey, content, string_split(content, chr(10)) AS ls,
               coalesce(list_position(list_transform(string_split(content, chr(10)),
                                                     lambda l: starts_with(l, 'l_linenumber')), true), 0) AS hp
        FROM t),
  h2 AS (SELECT l_orderkey, content, ls, hp,
                list_transform(string_split(ls[hp], ','), lambda x: trim(x, '{WS}')) AS header FROM h WHERE hp > 0),
  d AS (SELECT l_orderkey, header,
               trim(regexp_extract(content, 'Sheet:\\s*([^\\n]+)', 1), '{WS}') AS sheet,
               list_filter(list_slice(ls, hp + 1, len(ls)),
                           lambda l: trim(l, '{WS}') <> '' AND NOT starts_with(l, '合计')
                                     AND len(string_split(l, ',')) = len(header)) AS data
        FROM h2),
  r AS (SELECT l_orderkey, sheet, header, unnest(data) AS line, CAST(generate_subscripts(data, 1) - 1 AS INTEGER) AS row_no
        FROM d)
SELECT l_orderkey, CASE WHEN sheet = '' THEN 'Sheet1' ELSE sheet END AS sheet, row_no,
       CAST(generate_subscripts(header, 1) AS INTEGER) AS col_no, unnest(header) AS field,
       unnest(list_transform(string_split(line, ','), lambda x: trim(x, '{WS}'))) AS value
FROM r""")
def q_table_parse(spark, sf_dir):
    """Order sheets parsed back: header found by its key column, naive comma split, one row per cell."""
    cells = parse_tables_long(_order_sheets(spark, sf_dir), key_col="l_linenumber")
    return cells.select("l_orderkey", "sheet", "row_no", "col_no", "field", "value")


@register("percent_format", """
SELECT l_orderkey, l_linenumber, printf('%.2f%%', l_discount * 100) AS discount_pct,
       printf('%.2f%%', l_tax * 100) AS tax_pct, CAST(l_quantity AS VARCHAR) AS quantity_text
FROM lineitem""")
def q_percent_format(spark, sf_dir):
    """Numeric cells as text: percent-formatted cells with two decimals, others as plain numbers."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", percent_text("l_discount").alias("discount_pct"),
                     percent_text("l_tax").alias("tax_pct"), number_text("l_quantity").alias("quantity_text"))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
WIDE_COLUMNS = SEGMENTS + ["customers", "balance_rate"]


def nation_segment_table(spark, sf_dir) -> DataFrame:
    """Wide report table: one row per nation (ordered by nation key) with customer counts per market segment, the
    customer count and the share of customers with a positive balance as ``'<int>%'``, plus a total row."""
    cust = table(spark, sf_dir, "customer")
    nation = broadcast_if_small(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    c = cust.join(nation, cust.c_nationkey == nation.n_nationkey)

    def metrics():
        return ([F.count(F.when(F.col("c_mktsegment") == s, 1)).cast("string").alias(s) for s in SEGMENTS]
                + [F.count(F.lit(1)).cast("string").alias("customers"),
                   F.concat((F.count(F.when(F.col("c_acctbal") > 0, 1)) * 100 / F.count(F.lit(1)))
                            .cast("long").cast("string"), F.lit("%")).alias("balance_rate")])

    per = c.groupBy("n_name", "n_nationkey").agg(*metrics())
    total = c.agg(*metrics()).select(F.lit("合计").alias("n_name"), F.lit(None).cast("int").alias("n_nationkey"),
                                     *WIDE_COLUMNS)
    return per.unionByName(total)


_WIDE_SQL = f"""
  c AS (SELECT n.n_nationkey, n.n_name, cu.c_mktsegment, cu.c_acctbal
        FROM customer cu JOIN nation n ON cu.c_nationkey = n.n_nationkey),
  w AS (
    SELECT n_name, n_nationkey, {", ".join(f"CAST(count(*) FILTER (WHERE c_mktsegment = '{s}') AS VARCHAR) AS {s}" for s in SEGMENTS)},
           CAST(count(*) AS VARCHAR) AS customers,
           CAST(CAST(trunc(count(*) FILTER (WHERE c_acctbal > 0) * 100 / count(*)) AS BIGINT) AS VARCHAR) || '%' AS balance_rate
    FROM c GROUP BY n_name, n_nationkey
    UNION ALL
    SELECT '合计', CAST(NULL AS INTEGER), {", ".join(f"CAST(count(*) FILTER (WHERE c_mktsegment = '{s}') AS VARCHAR)" for s in SEGMENTS)},
           CAST(count(*) AS VARCHAR),
           CAST(CAST(trunc(count(*) FILTER (WHERE c_acctbal > 0) * 100 / count(*)) AS BIGINT) AS VARCHAR) || '%'
    FROM c
  ),
  u AS (UNPIVOT w ON {", ".join(WIDE_COLUMNS)} INTO NAME field VALUE value_raw),
  un AS (SELECT field, CASE WHEN bool_or(contains(value_raw, '%')) OR contains(field, '率') THEN '%' ELSE '人' END AS unit
         FROM u GROUP BY field),
  long AS (
    SELECT CAST(list_position({[c for c in WIDE_COLUMNS]}, field) AS INTEGER) AS col_no, field, unit,
           n_nationkey AS pos, n_name AS name,
           CASE WHEN contains(value_raw, '%') THEN TRY_CAST(replace(value_raw, '%', '') AS DOUBLE)
                ELSE TRY_CAST(value_raw AS DOUBLE) END AS value,
           value_raw
    FROM u JOIN un USING (field) WHERE n_name <> '合计'
  )"""


def _long(spark, sf_dir):
    return unpivot_series(nation_segment_table(spark, sf_dir), "n_name", "n_nationkey")


@register("unpivot_series", f"WITH {_WIDE_SQL} SELECT * FROM long")
def q_unpivot_series(spark, sf_dir):
    """Nation report table (segment counts, customers, positive-balance rate) reshaped to one series per column."""
    return _long(spark, sf_dir)


@register("chart_series", f"""WITH {_WIDE_SQL}
SELECT a.pos, a.name, a.value AS value_2, b.value AS value_3
FROM long a JOIN long b ON a.pos = b.pos AND a.col_no = 2 AND b.col_no = 3""")
def q_chart_series(spark, sf_dir):
    """Columns 2 and 3 aligned by row position for a stacked bar chart."""
    return chart_series(_long(spark, sf_dir))


@register("series_share", f"""WITH {_WIDE_SQL}
SELECT col_no, field, pos, name, value, round(value / sum(value) OVER (PARTITION BY col_no), 6) AS share FROM long""")
def q_series_share(spark, sf_dir):
    """Each point's share of its column total (pie chart data)."""
    return series_share(_long(spark, sf_dir))


# ------------------------------------------------------------------------------------------------------ quoted records
def _quoted_sql(x: str) -> str:
    return f"""CASE WHEN regexp_matches({x}, '[,"\r\n]') THEN '"' || replace({x}, '"', '""') || '"' ELSE {x} END"""


@register("csv_quoted", f"""
SELECT role, 0 AS order_index, 'table' AS content_type,
       'conv_id,turn,text' || chr(10) || string_agg(conv_id || ',' || turn || ',' || {_quoted_sql("text")} || chr(10), '' ORDER BY conv_id, turn) AS content
FROM conversations GROUP BY role
UNION ALL SELECT 'none', 0, 'table', 'conv_id,turn,text' || chr(10)""")
def q_csv_quoted(spark, sf_dir):
    """Conversations written as one CSV file for each role, texts with line breaks, commas and quotes, and one file with a
    header only; each file read back in parallel as a (0, 'table', csv text) block."""
    from ..operators.csvtext import csv_file_blocks

    path = scratch_path(spark, "quoted-csv")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", "role")
    form = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": ""}
    rows.repartition("role").sortWithinPartitions("role", "conv_id", "turn").write.partitionBy("role").options(**form).csv(path)
    rows.select("conv_id", "turn", "text").limit(0).write.options(**form).csv(f"{path}/role=none")
    blocks = csv_file_blocks(spark, path)
    return blocks.select(F.regexp_extract("filename", "role=([^/]+)/", 1).alias("role"), "order_index", "content_type", "content")
