"""Trees and flows derived from reports: cause tree (adjacency rows), tree levels and depth check, per-parent
rollups and sibling pairing, and the flow chart edge list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import formats as fmt
from ..functions.text import label_width, md5_suffix, py_strip
from ..session import materialize
from .common import broadcast_if_small, row_number_within


# ------------------------------------------------------------------------------------------------------ cause tree
def cause_tree(problems: DataFrame, causes: DataFrame, root_id: str = "1", root_parent: str = "0",
               category_prefix: str = "100") -> DataFrame:
    """Main problem + cause rows -> tree nodes ``(report, id, fid, level, cat_no, detail_no, name)``.

    Root ``root_id`` (parent ``root_parent``) named after the main problem; category i gets id
    ``category_prefix + i`` under the root; detail j of category i gets ``<category id><j><suffix>`` where the suffix
    is a stable md5-based number below 10000 (standing in for a per-process salted hash).  Concatenated ids can
    collide, so ``(cat_no, detail_no)`` is the real key.  Row-wise apart from the union: no shuffle."""
    root = problems.select("report", F.lit(root_id).alias("id"), F.lit(root_parent).alias("fid"),
                           F.lit(1).alias("level"), F.lit(None).cast("int").alias("cat_no"),
                           F.lit(None).cast("int").alias("detail_no"), F.col("main_problem").alias("name"))
    cat_id = F.concat(F.lit(category_prefix), F.col("cat_no").cast("string"))
    cats = causes.select("report", cat_id.alias("id"), F.lit(root_id).alias("fid"), F.lit(2).alias("level"),
                         F.col("cat_no").cast("int").alias("cat_no"), F.lit(None).cast("int").alias("detail_no"),
                         F.col("category").alias("name"))
    det = causes.select("report", "cat_no", cat_id.alias("_cid"), F.posexplode("details").alias("_j", "name"))
    dets = det.select("report", F.concat(F.col("_cid"), (F.col("_j") + 1).cast("string"), md5_suffix("name"))
                      .alias("id"), F.col("_cid").alias("fid"), F.lit(3).alias("level"),
                      F.col("cat_no").cast("int").alias("cat_no"), (F.col("_j") + 1).cast("int").alias("detail_no"),
                      "name")
    return root.unionByName(cats).unionByName(dets)


def nest_tree(nodes: DataFrame) -> DataFrame:
    """Adjacency rows (three fixed levels) -> one nested tree per report: ``(report, tree)`` with
    ``tree = struct(id, fid, name, children array<struct(id, fid, name, children array<struct(id, fid, name)>)>)``.
    Children keep their ordinal order."""
    lvl3 = (nodes.where(F.col("level") == 3)
            .groupBy("report", "fid").agg(F.array_sort(F.collect_list(F.struct(
                F.col("detail_no").alias("_o"), "id", "fid", "name"))).alias("_k")))
    lvl2 = (nodes.where(F.col("level") == 2).alias("c")
            .join(lvl3.alias("d"), (F.col("c.report") == F.col("d.report")) & (F.col("c.id") == F.col("d.fid")),
                  "left")
            .select(F.col("c.report").alias("report"), F.col("c.fid").alias("fid"), F.struct(
                F.col("c.cat_no").alias("_o"), F.col("c.id").alias("id"), F.col("c.fid").alias("fid"),
                F.col("c.name").alias("name"),
                F.coalesce(F.transform("d._k", lambda x: F.struct(x["id"].alias("id"), x["fid"].alias("fid"),
                                                                  x["name"].alias("name"))),
                           F.array().cast("array<struct<id:string,fid:string,name:string>>")).alias("children"))
                .alias("_n"))
            .groupBy("report", "fid").agg(F.array_sort(F.collect_list("_n")).alias("_k")))
    roots = nodes.where(F.col("level") == 1)
    return (roots.join(lvl2, ["report"], "left")
            .select("report", F.struct("id", roots["fid"].alias("fid"), "name", F.coalesce(
                F.transform("_k", lambda x: x.dropFields("_o")), F.array()).alias("children")).alias("tree")))


# ---------------------------------------------------------------------------------------------------- tree levels
def tree_levels(nodes: DataFrame, tree_col: str = "tree", root_parent: str = "0", max_level: int = 3) -> DataFrame:
    """Level of every node (root = 1), whatever the depth.  Nodes that reach no root (orphans, cycles and what hangs
    off them) get a null level.  Adds the tree's depth (max level) and ``too_deep`` (the tree exceeds ``max_level``).
    An id that occurs several times in a tree has one parent: none if any of its rows is a root by a null parent, else
    the smallest.

    Pointer doubling: each round looks up the node that an unfinished node points at and takes over its pointer, so
    after n rounds all levels up to 2**n are known; a round that finishes no node leaves only cycles and ends the
    loop.  A round is one equi-join on (tree, id), checkpointed, so a lost executor costs one round; a parent with
    very many children is a skewed key that AQE splits."""
    nodes = materialize(nodes)      # read by the first round and by the result
    parent = nodes.groupBy(tree_col, "id").agg(F.min(F.struct("fid"))["fid"].alias("_up"))
    is_root = F.col("_up").isNull() | (F.col("_up") == root_parent)
    cur = parent.select(tree_col, "id", F.when(~is_root, F.col("_up")).alias("_up"), F.lit(1).alias("_steps"),
                        F.when(is_root, F.lit(1)).alias("level"))
    cur, before = materialize(cur), None
    while (left := cur.where("_up is not null").count()) and left != before:
        before = left
        above = cur.select(tree_col, F.col("id").alias("_up"), F.col("_up").alias("_next"), F.col("_steps").alias("_more"),
                           F.col("level").alias("_level"))
        moved = (cur.where("_up is not null").drop("level").join(above, [tree_col, "_up"], "left")
                 .select(tree_col, "id", F.col("_next").alias("_up"), (F.col("_steps") + F.col("_more")).alias("_steps"),
                         (F.col("_steps") + F.col("_level")).alias("level")))
        cur = materialize(cur.where("_up is null").unionByName(moved))
    levels = cur.select(tree_col, "id", "level")
    depth = levels.groupBy(tree_col).agg(F.max("level").alias("depth"))
    return (nodes.join(levels, [tree_col, "id"], "left").join(broadcast_if_small(depth), tree_col, "left")
            .withColumn("too_deep", F.col("depth") > max_level))


def tree_rollup(levelled: DataFrame, tree_col: str = "tree", order_col: str = "ordinal",
                root_parent: str = "0") -> DataFrame:
    """Per node: number of children and the widest child label (width rule of the child's level); for level-2 nodes
    the pair ("team") number ``ceil(n/2)`` and side (odd positions up, even down) in sibling order.

    Every node with a parent counts as its child, at any level and also where no root is reached (its label is then
    as wide as on the third level).  Child statistics are one partial aggregation per parent, joined back; the level-2 ordinal is computed with
    ``row_number_within`` (a window when the level is provably small, spread over tasks otherwise)."""
    levelled = materialize(levelled)   # read three times below
    width = (F.when(F.col("level") == 1, label_width("name", 1))
             .when(F.col("level") == 2, label_width("name", 2))
             .otherwise(label_width("name", 3)))
    kids = (levelled.where(F.col("fid").isNotNull() & (F.col("fid") != root_parent))
            .groupBy(tree_col, F.col("fid").alias("id"))
            .agg(F.count(F.lit(1)).alias("child_count"), F.max(width).alias("max_child_width")))
    second = row_number_within(levelled.where(F.col("level") == 2).select(tree_col, "id", order_col),
                            [tree_col], [order_col, "id"], out="_n")
    second = (second
              .select(tree_col, "id", F.ceil(F.col("_n") / 2).cast("int").alias("team"),
                      F.when(F.col("_n") % 2 == 1, F.lit("up")).otherwise(F.lit("down")).alias("side")))
    return (levelled.join(kids, [tree_col, "id"], "left")
            .join(second, [tree_col, "id"], "left")
            .select(tree_col, "id", "fid", "level", F.coalesce("child_count", F.lit(0)).alias("child_count"),
                    "max_child_width", "team", "side"))


# ----------------------------------------------------------------------------------------------------------- flow
# The flow chart's nodes, labels and edges.  A label is (text before the value, lookup), where the
# lookup names a (part, field label) of the report, "@problem" for the problem text, or None for a fixed label.
FLOW_NODES = [
    ("A", "启动专项培训\\n", ("overview", "培训主题")),
    ("B", "组织部门: ", ("overview", "组织部门")),
    ("C", "培训形式: ", ("overview", "培训形式")),
    ("D", "培训内容实施", None),
    ("E", "整体参训率: ", ("participation", "整体参训率")),
    ("F", "理论考试平均成绩: ", ("metrics", "理论考试平均成绩")),
    ("G", "操作合格率: ", ("metrics", "操作评估合格率")),
    ("H", "是否达标", None),
    ("I", "最终通过率: ", ("metrics", "最终通过率")),
    ("J", "问题分析: ", "@problem"),
    ("K", "总结与持续改进", None),
]
FLOW_EDGES = [("A", "B", ""), ("B", "C", ""), ("C", "D", ""), ("D", "E", ""), ("E", "F", ""), ("F", "G", ""),
              ("G", "H", ""), ("H", "I", "是"), ("H", "J", "否"), ("I", "K", "")]
FLOW_PROBLEM = ("participation", fmt.PROBLEM_KEY)
FLOW_PROBLEM_DEFAULT = "无"
STEP_ANCHOR = "J"


def _safe(v: Column, empty: str = fmt.EMPTY_FLOW) -> Column:
    """Falsy -> 'N/A' (no strip)."""
    return F.when(v.isNull() | (v == ""), F.lit(empty)).otherwise(v)


def flow_edges(fields: DataFrame, steps: DataFrame, nodes: Sequence = tuple(FLOW_NODES),
               edges: Sequence = tuple(FLOW_EDGES), problem: tuple[str, str] = FLOW_PROBLEM,
               summary_key: str = fmt.SUMMARY_KEY, details_key: str = fmt.DETAILS_KEY,
               anchor: str = STEP_ANCHOR) -> DataFrame:
    """Report fields ``(report, part, sec_no, field_no, label, value)`` + steps ``(report, step_no, value[, step_pos])``
    -> flow edges
    ``(report, seq, src, src_label, dst, dst_label, edge_label)``.

    Labels look up values per (part, label) -- the last duplicate wins -- and show 'N/A' when missing or empty.  The
    problem text is the problem object's summary, followed by its detail items when there are any, separated by a
    literal backslash-n (two characters); a plain value is shown as is, a null or empty one as 'N/A'; without the key
    it is '无'.  Steps are chained ``anchor -> R1 -> R2 ...`` in step order."""
    # Only the (part, label) pairs the chart looks up are kept, each reduced to its last value in (section, field)
    # order -- as a dict built in that order keeps the last duplicate -- so a report's lookup map is bounded by the
    # number of lookups however many fields the report has.
    wanted = {tuple(src) for _, _, src in nodes if isinstance(src, tuple)} | {tuple(problem)}
    key = F.concat_ws("\u0001", "part", "label")
    last = (fields.where(key.isin([f"{p}\u0001{lab}" for p, lab in sorted(wanted)]))
            .groupBy("report", key.alias("k"))
            .agg(F.max_by("value", F.struct("sec_no", "field_no")).alias("v")))
    lookup = last.groupBy("report").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("_m"))

    def get(part: str, label: str) -> Column:
        return F.try_element_at(F.col("_m"), F.lit(f"{part}\u0001{label}"))

    praw = get(*problem)
    given = F.coalesce(F.map_contains_key("_m", "\u0001".join(problem)), F.lit(False))
    pobj = F.when(py_strip(F.coalesce(praw, F.lit(""))).startswith("{"), F.from_json(praw, "map<string,string>"))
    summary = F.coalesce(F.element_at(pobj, F.lit(summary_key)), F.lit(""))
    det = F.from_json(F.element_at(pobj, F.lit(details_key)), "array<string>")
    det_text = F.array_join(F.coalesce(det, F.array()), "\\n")
    ptext = F.when(pobj.isNotNull(),
                   F.when(F.size(F.coalesce(det, F.array())) > 0, F.concat(summary, F.lit("\\n"), det_text))
                   .otherwise(summary)) \
        .otherwise(F.when(given, _safe(praw)).otherwise(FLOW_PROBLEM_DEFAULT))
    labels = {}
    for node_id, text, src in nodes:
        if src is None:
            labels[node_id] = F.lit(text)
        elif src == "@problem":
            labels[node_id] = F.concat(F.lit(text), ptext)
        else:
            labels[node_id] = F.concat(F.lit(text), _safe(get(*src)))
    fixed = F.array(*[F.struct(F.lit(i + 1).alias("seq"), F.lit(s).alias("src"), labels[s].alias("src_label"),
                               F.lit(d).alias("dst"), labels[d].alias("dst_label"), F.lit(e).alias("edge_label"))
                      for i, (s, d, e) in enumerate(edges)])
    reports = fields.select("report").unionByName(steps.select("report")).distinct()
    chain = (reports.join(lookup, "report", "left")
             .select("report", F.inline(fixed)))
    # Steps are chained by position: each step joins its predecessor on (report, position - 1) -- an equi-join,
    # not a window over the report -- and the first step hangs off the anchor node.
    if "step_pos" not in steps.columns:
        steps = row_number_within(steps, ["report"], ["step_no"], out="step_pos")
    st = steps.select("report", F.col("step_pos").alias("_i"),
                      F.concat(F.lit("R"), F.col("step_pos").cast("string")).alias("dst"),
                      _safe(F.col("value")).alias("dst_label"))
    prev = st.select("report", (F.col("_i") + 1).alias("_i"), F.col("dst").alias("_ps"),
                     F.col("dst_label").alias("_pl"))
    anchor_label = chain.where(F.col("dst") == anchor).select("report", F.col("dst_label").alias("_al"))
    st = (st.join(prev, ["report", "_i"], "left")
          .join(anchor_label, "report", "left")
          .select("report", (F.lit(len(edges)) + F.col("_i")).alias("seq"),
                  F.coalesce("_ps", F.lit(anchor)).alias("src"), F.coalesce("_pl", "_al").alias("src_label"),
                  "dst", "dst_label", F.lit("").alias("edge_label")))
    return chain.unionByName(st)
