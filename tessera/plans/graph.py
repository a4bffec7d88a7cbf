"""Registered plans: cause tree, tree levels and rollups, flow edges, display lines, report context and document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.common import broadcast_if_small
from ..operators.graph import FLOW_EDGES, FLOW_NODES, cause_tree, flow_edges, tree_levels, tree_rollup
from ..operators.report import REPORT_TEMPLATE, display_fields, report_context, report_document
from ..operators.sections import cause_rows, main_problem, section_fields, suggestion_steps
from .registry import register, table
from .sections import _ANALYSIS_SQL, analysis_sections, event_sections
from .sqltext import WS

MD5_SQL = "CAST(CAST(('0x' || substr(md5({x}), 1, 8)) AS BIGINT) % 10000 AS VARCHAR)"


@register("cause_tree", f"""WITH {_ANALYSIS_SQL},
  d AS (SELECT report, cat_no, unnest(details) AS name, CAST(generate_subscripts(details, 1) AS INTEGER) AS detail_no
        FROM causes)
SELECT report, '1' AS id, '0' AS fid, 1 AS level, CAST(NULL AS INTEGER) AS cat_no, CAST(NULL AS INTEGER) AS detail_no,
       main_problem AS name FROM mp
UNION ALL
SELECT report, '100' || CAST(cat_no AS VARCHAR), '1', 2, cat_no, CAST(NULL AS INTEGER), category FROM causes
UNION ALL
SELECT report, '100' || CAST(cat_no AS VARCHAR) || CAST(detail_no AS VARCHAR) || {MD5_SQL.format(x="name")},
       '100' || CAST(cat_no AS VARCHAR), 3, cat_no, detail_no, name FROM d""")
def q_cause_tree(spark, sf_dir):
    """Per user report: the cause tree (problem root, categories, details) as adjacency rows."""
    secs = analysis_sections(spark, sf_dir)
    return cause_tree(main_problem(secs), cause_rows(secs))


# ------------------------------------------------------------------------------------------------- region forest
def region_forest(spark, sf_dir) -> DataFrame:
    """Region -> nation -> supplier/customer -> order as a forest (one tree per region):
    ``(tree, id, fid, name, ordinal)``; orders form a fourth level, beyond what the diagram can draw."""
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation")
    supplier = table(spark, sf_dir, "supplier")
    customer = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders")
    n2r = broadcast_if_small(nation.select("n_nationkey", F.col("n_regionkey").alias("tree")))
    c2r = customer.select("c_custkey", "c_nationkey").join(
        n2r, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "tree")
    return (region.select(F.col("r_regionkey").alias("tree"), F.concat(F.lit("R"), F.col("r_regionkey").cast("string"))
                          .alias("id"), F.lit("0").alias("fid"), F.col("r_name").alias("name"),
                          F.col("r_regionkey").cast("long").alias("ordinal"))
            .unionByName(nation.select(F.col("n_regionkey").alias("tree"),
                                       F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("id"),
                                       F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("fid"),
                                       F.col("n_name").alias("name"), F.col("n_nationkey").cast("long").alias("ordinal")))
            .unionByName(supplier.join(n2r, F.col("s_nationkey") == F.col("n_nationkey")).select(
                "tree", F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("id"),
                F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("fid"),
                F.col("s_name").alias("name"), F.col("s_suppkey").alias("ordinal")))
            .unionByName(customer.join(n2r, F.col("c_nationkey") == F.col("n_nationkey")).select(
                "tree", F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("id"),
                F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("fid"),
                F.col("c_name").alias("name"), F.col("c_custkey").alias("ordinal")))
            .unionByName(orders.join(c2r, F.col("o_custkey") == F.col("c_custkey")).select(
                "tree", F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("id"),
                F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("fid"),
                F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("name"),
                F.col("o_orderkey").alias("ordinal"))))


_FOREST_SQL = """
  nodes AS (
    SELECT r_regionkey AS tree, 'R' || CAST(r_regionkey AS VARCHAR) AS id, '0' AS fid, r_name AS name,
           CAST(r_regionkey AS BIGINT) AS ordinal FROM region
    UNION ALL SELECT n_regionkey, 'N' || CAST(n_nationkey AS VARCHAR), 'R' || CAST(n_regionkey AS VARCHAR), n_name,
           CAST(n_nationkey AS BIGINT) FROM nation
    UNION ALL SELECT n.n_regionkey, 'S' || CAST(s_suppkey AS VARCHAR), 'N' || CAST(s_nationkey AS VARCHAR), s_name,
           s_suppkey FROM supplier JOIN nation n ON s_nationkey = n.n_nationkey
    UNION ALL SELECT n.n_regionkey, 'C' || CAST(c_custkey AS VARCHAR), 'N' || CAST(c_nationkey AS VARCHAR), c_name,
           c_custkey FROM customer JOIN nation n ON c_nationkey = n.n_nationkey
    UNION ALL SELECT n.n_regionkey, 'O' || CAST(o_orderkey AS VARCHAR), 'C' || CAST(o_custkey AS VARCHAR),
           'order ' || CAST(o_orderkey AS VARCHAR), o_orderkey
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation n ON c_nationkey = n.n_nationkey
  ),
  lv AS (
    SELECT tree, id, min(level) AS level FROM (
      WITH RECURSIVE r(tree, id, level) AS (
        SELECT tree, id, 1 FROM nodes WHERE fid IS NULL OR fid = '0'
        UNION ALL
        SELECT nodes.tree, nodes.id, r.level + 1 FROM nodes JOIN r ON nodes.tree = r.tree AND nodes.fid = r.id)
      SELECT * FROM r) GROUP BY tree, id
  ),
  levelled AS (
    SELECT nodes.*, lv.level, d.depth, d.depth > 3 AS too_deep
    FROM nodes LEFT JOIN lv USING (tree, id)
    LEFT JOIN (SELECT tree, max(level) AS depth FROM lv GROUP BY tree) d USING (tree)
  )"""


@register("tree_levels", f"WITH {_FOREST_SQL} SELECT tree, id, fid, name, ordinal, level, depth, too_deep FROM levelled")
def q_tree_levels(spark, sf_dir):
    """Levels of the region forest (orders reach level 4), each tree's depth and the 3-level check."""
    return tree_levels(region_forest(spark, sf_dir), "tree")


def _width_sql(x: str, level: int) -> str:
    w1, w2, w3, pad = {1: (16, 8, 10, 40), 2: (13, 8, 5, 50), 3: (12, 8, 5, 30)}[level]
    wide = (f"(length(regexp_replace({x}, '[\\x{{0}}-\\x{{FF}}]', '', 'g')) + "
            f"length(regexp_replace({x}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')))")
    upper = f"length(regexp_replace({x}, '[^A-Z]', '', 'g'))"
    u16 = f"(length({x}) + length(regexp_replace({x}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')))"
    return f"({wide} * {w1} + {upper} * {w2} + ({u16} - {wide} - {upper}) * {w3} + {pad})"


@register("tree_rollup", f"""WITH {_FOREST_SQL},
  kids AS (
    SELECT tree, fid AS id, count(*) AS child_count,
           max(CASE WHEN level = 1 THEN {_width_sql("name", 1)} WHEN level = 2 THEN {_width_sql("name", 2)}
                    ELSE {_width_sql("name", 3)} END) AS max_child_width
    FROM levelled WHERE fid IS NOT NULL AND fid <> '0' GROUP BY tree, fid),
  second AS (
    SELECT tree, id, row_number() OVER (PARTITION BY tree ORDER BY ordinal, id) AS n FROM levelled WHERE level = 2)
SELECT l.tree, l.id, l.fid, l.level, CAST(coalesce(k.child_count, 0) AS BIGINT) AS child_count,
       CAST(k.max_child_width AS INTEGER) AS max_child_width, CAST(ceil(s.n / 2) AS INTEGER) AS team,
       CASE WHEN s.n IS NULL THEN NULL WHEN s.n % 2 = 1 THEN 'up' ELSE 'down' END AS side
FROM levelled l LEFT JOIN kids k ON l.tree = k.tree AND l.id = k.id
LEFT JOIN second s ON l.tree = s.tree AND l.id = s.id""")
def q_tree_rollup(spark, sf_dir):
    """Per node of the region forest: children, widest child label, and the level-2 pairing and side."""
    return tree_rollup(tree_levels(region_forest(spark, sf_dir), "tree"), "tree")


# -------------------------------------------------------------------------------------------------------- flow
EVENT_FLOW_NODES = [
    (n, t, {("overview", "培训主题"): ("signup", "k"), ("overview", "组织部门"): ("view", "k"),
            ("overview", "培训形式"): ("click", "k"), ("participation", "整体参训率"): ("purchase", "k"),
            ("metrics", "理论考试平均成绩"): ("error", "k"), ("metrics", "操作评估合格率"): ("view", "rate"),
            ("metrics", "最终通过率"): ("click", "k")}.get(src, src) if isinstance(src, tuple) else src)
    for n, t, src in FLOW_NODES]
EVENT_FLOW_PROBLEM = ("error", "problem")


def event_steps(spark, sf_dir) -> DataFrame:
    """A user's purchase events, in event order, read as that report's suggestion list."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    items = ev.select("user_id", "event_id",
                      F.concat(F.lit("buy k="), F.get_json_object("props", "$.k")).alias("text"))
    return suggestion_steps(items, "user_id", "event_id", "text")


def event_fields(spark, sf_dir) -> DataFrame:
    f = section_fields(event_sections(spark, sf_dir))
    return f.select("report", F.col("section").alias("part"), "sec_no", "field_no", "label", "value")


_STEPS_SQL = """
  steps AS (
    SELECT user_id AS report, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS INTEGER) AS step_no,
           'buy k=' || json_extract_string(props, '$.k') AS value
    FROM events WHERE event_type = 'purchase')"""


def _flow_sql() -> str:
    def look(src):
        part, label = src
        return (f"(SELECT arg_max(json_extract_string(e.props, '$.\"{label}\"'), e.event_id) FROM events e "
                f"WHERE e.user_id = r.report AND e.event_type = '{part}' "
                f"AND json_extract_string(e.props, '$.\"{label}\"') IS NOT NULL)")

    labels = {}
    for n, t, src in EVENT_FLOW_NODES:
        if src is None:
            labels[n] = f"'{t}'"
        elif src == "@problem":
            labels[n] = f"'{t}' || coalesce({look(EVENT_FLOW_PROBLEM)}, '无')"
        else:
            labels[n] = f"'{t}' || coalesce(nullif({look(src)}, ''), 'N/A')"
    rows = " UNION ALL ".join(
        f"SELECT r.report, {i + 1} AS seq, '{s}' AS src, {labels[s]} AS src_label, '{d}' AS dst, "
        f"{labels[d]} AS dst_label, '{e}' AS edge_label FROM r" for i, (s, d, e) in enumerate(FLOW_EDGES))
    return f"""WITH {_STEPS_SQL},
  r AS (SELECT DISTINCT user_id AS report FROM events),
  chain AS ({rows}),
  st AS (SELECT report, step_no AS i, 'R' || CAST(step_no AS VARCHAR) AS dst, coalesce(nullif(value, ''), 'N/A') AS dst_label
         FROM steps)
SELECT report, seq, src, src_label, dst, dst_label, edge_label FROM chain
UNION ALL
SELECT st.report, {len(FLOW_EDGES)} + st.i AS seq,
       coalesce(lag(st.dst) OVER (PARTITION BY st.report ORDER BY st.i), 'J') AS src,
       coalesce(lag(st.dst_label) OVER (PARTITION BY st.report ORDER BY st.i), c.dst_label) AS src_label,
       st.dst, st.dst_label, '' AS edge_label
FROM st JOIN chain c ON c.report = st.report AND c.dst = 'J'"""


@register("flow_edges", _flow_sql())
def q_flow_edges(spark, sf_dir):
    """Per user report: the fixed flow chain with values looked up from its event fields, and the chain of its
    steps after the problem node."""
    return flow_edges(event_fields(spark, sf_dir), event_steps(spark, sf_dir), nodes=EVENT_FLOW_NODES,
                      problem=EVENT_FLOW_PROBLEM)


# ------------------------------------------------------------------------------------------------------ display
@register("display_fields", f"""WITH {_ANALYSIS_SQL},
  f AS (SELECT report, sec_no, body, unnest(json_keys(body)) AS label,
               CAST(generate_subscripts(json_keys(body), 1) AS INTEGER) AS field_no FROM s),
  v AS (SELECT report, sec_no, field_no, label, json_extract(body, '$."' || label || '"') AS v FROM f),
  o AS (SELECT report, sec_no, field_no, label, v, unnest(json_keys(v)) AS k,
               generate_subscripts(json_keys(v), 1) AS kpos FROM v WHERE json_type(v) = 'OBJECT'),
  ov AS (SELECT report, sec_no, field_no, label, k, kpos, json_extract(v, '$."' || k || '"') AS kv FROM o),
  its AS (SELECT report, sec_no, field_no, label, k, kpos,
                 CASE WHEN json_type(kv) = 'ARRAY' THEN json_extract_string(kv, '$[*]')
                      WHEN json_type(kv) = 'VARCHAR' THEN [json_extract_string(kv, '$')]
                      ELSE CAST([] AS VARCHAR[]) END AS items FROM ov),
  e AS (SELECT report, sec_no, field_no, label, kpos, 0 AS ipos, 'heading' AS kind, k || '：' AS text FROM its
        UNION ALL
        SELECT report, sec_no, field_no, label, kpos, generate_subscripts(items, 1) AS ipos, 'item' AS kind,
               unnest(items) AS text FROM its)
SELECT report, sec_no, field_no, label,
       CAST(row_number() OVER (PARTITION BY report, sec_no, field_no ORDER BY kpos, ipos) AS INTEGER) AS line_no,
       kind, text FROM e
UNION ALL
SELECT report, sec_no, field_no, label, 1, 'value',
       CASE WHEN json_type(v) = 'VARCHAR' AND trim(json_extract_string(v, '$'), '{WS}') <> ''
            THEN trim(json_extract_string(v, '$'), '{WS}') ELSE '/' END
FROM v WHERE json_type(v) <> 'OBJECT'""")
def q_display_fields(spark, sf_dir):
    """Display lines of every analysis section's fields (object values flattened to headings and items)."""
    return display_fields(analysis_sections(spark, sf_dir))


# ------------------------------------------------------------------------------------------------------ context
def _context_inputs(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    charts = ev.groupBy(F.col("user_id").alias("report")).agg(
        (F.bool_or(F.col("event_type") == "click") & F.bool_or(F.col("event_type") == "view")).alias("has_chart"))
    mp = main_problem(analysis_sections(spark, sf_dir)).withColumnRenamed("main_problem", "evaluation")
    return charts.join(mp, "report")


def _context_sql() -> str:
    t = REPORT_TEMPLATE.replace("'", "''")
    rendered = f"'{t}'"
    for name in ["idx1", "idx2", "idx3", "evaluation", "advice1", "advice2", "advice3"]:
        rendered = f"replace({rendered}, '{{{{ {name} }}}}', coalesce({name}, ''))"
    nums = "['零', '一', '二', '三', '四', '五', '六', '七', '八', '九', '十']"
    return f"""WITH {_ANALYSIS_SQL}, {_STEPS_SQL},
  ch AS (SELECT user_id AS report, bool_or(event_type = 'click') AND bool_or(event_type = 'view') AS has_chart
         FROM events GROUP BY user_id),
  ctx AS (
    SELECT ch.report, mp.main_problem AS evaluation,
           {nums}[CASE WHEN has_chart THEN 4 ELSE 3 END + 1] AS idx1,
           {nums}[CASE WHEN has_chart THEN 4 ELSE 3 END + 2] AS idx2,
           {nums}[CASE WHEN has_chart THEN 4 ELSE 3 END + 3] AS idx3,
           coalesce((SELECT value FROM steps WHERE steps.report = ch.report AND step_no = 1), '') AS advice1,
           coalesce((SELECT value FROM steps WHERE steps.report = ch.report AND step_no = 2), '') AS advice2,
           coalesce((SELECT value FROM steps WHERE steps.report = ch.report AND step_no = 3), '') AS advice3
    FROM ch JOIN mp ON ch.report = mp.report)
SELECT report, idx1, idx2, idx3, advice1, advice2, advice3, {rendered} AS rendered FROM ctx"""


@register("report_context", _context_sql())
def q_report_context(spark, sf_dir):
    """Per user report: section numerals (after 4 fixed sections with charts, 3 without), the first three steps,
    and the filled report text."""
    return report_context(_context_inputs(spark, sf_dir), event_steps(spark, sf_dir))


# ------------------------------------------------------------------------------------------------------ document
DOC_PARTS = {"orgOverview": "signup", "trainingParticipation": "view", "assessmentDetail": "click"}


def _doc_sql() -> str:
    parts = []
    for key, sec in DOC_PARTS.items():
        parts.append(f"""
  p_{key} AS (
    SELECT user_id AS report,
           json_object('section', '{sec}', 'fields',
                       list(json_object('label', k, 'value', json_extract_string(props, '$."' || k || '"'))
                            ORDER BY event_id, kpos)) AS j
    FROM (SELECT user_id, event_id, props, unnest(json_keys(props)) AS k, generate_subscripts(json_keys(props), 1) AS kpos
          FROM events WHERE event_type = '{sec}')
    GROUP BY user_id)""")
    joins = " ".join(f"LEFT JOIN p_{k} ON p_{k}.report = r.report" for k in DOC_PARTS)
    fields = ", ".join(f"'{k}', p_{k}.j" for k in DOC_PARTS)
    return f"""WITH {_ANALYSIS_SQL}, {_STEPS_SQL}, {",".join(parts)},
  an AS (SELECT causes.report, json_object('section', '培训及考核情况分析（鱼骨图）', 'mainProblem', any_value(mp.main_problem),
                'causes', list(json_object('category', category, 'details', details) ORDER BY cat_no)) AS j
         FROM causes JOIN mp ON causes.report = mp.report GROUP BY causes.report),
  fl AS (SELECT report, json_object('section', '建议', 'steps',
                list(json_object('id', 'rec_' || CAST(step_no AS VARCHAR), 'label', '建议内容', 'value', value)
                     ORDER BY step_no)) AS j
         FROM steps GROUP BY report),
  r AS (SELECT DISTINCT user_id AS report FROM events)
SELECT r.report, CAST(json_object({fields}, 'assessmentAnalysis', an.j, 'rectificationFlow', fl.j) AS VARCHAR) AS document
FROM r {joins} LEFT JOIN an ON an.report = r.report LEFT JOIN fl ON fl.report = r.report"""


@register("report_document", _doc_sql())
def q_report_document(spark, sf_dir):
    """Per user report: the nested report document (field parts, analysis, steps) serialised as JSON."""
    secs = event_sections(spark, sf_dir)
    an = analysis_sections(spark, sf_dir)
    analysis = cause_rows(an).join(main_problem(an), "report")
    return report_document(section_fields(secs), analysis, event_steps(spark, sf_dir), DOC_PARTS)
