"""Tables: cell grids to CSV text, CSV text back to row maps, wide tables to long series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import formats as fmt
from ..functions.text import number_text, parse_value, py_strip
from ..session import materialize
from .common import ordered_concat


# --------------------------------------------------------------------------------------------------- cells and CSV
def fill_nulls(cell: Column, mode: str = "null", mark: str = fmt.NULL_MARK) -> Column:
    """Missing-cell marker, three variants: ``null`` (only missing cells), ``blank`` (missing or blank after strip),
    ``none`` (left as is)."""
    if mode == "none":
        return cell
    if mode == "null":
        return F.coalesce(cell, F.lit(mark))
    if mode == "blank":
        return F.when(cell.isNull() | (py_strip(cell) == ""), F.lit(mark)).otherwise(cell)
    raise ValueError(f"unknown null fill mode: {mode}")


def csv_field(cell: Column) -> Column:
    """Minimal CSV quoting: a field holding a comma, quote or line break is quoted, quotes doubled; null is ''."""
    c = F.coalesce(cell.cast("string"), F.lit(""))
    return F.when(c.rlike('[,"\\r\\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))) \
        .otherwise(c)


def csv_line(cells: Sequence[Column]) -> Column:
    return F.concat_ws(",", *[csv_field(c) for c in cells])


def csv_header(names: Sequence[str]) -> str:
    def q(n: str) -> str:
        return '"' + n.replace('"', '""') + '"' if any(ch in n for ch in ',"\r\n') else n

    return ",".join(q(n) for n in names)


def serialize_tables(rows: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str],
                     null_mode: str = "none", mark: str = fmt.NULL_MARK, sheet: Column | None = None,
                     out: str = "content", chunk_on: int = 0) -> DataFrame:
    """One CSV text per table (``keys``): header line, one line per row in ``order``, each line ending with
    ``\\n``; optionally led by ``Sheet: <name>\\n``.  Rows are joined with a two-level ordered aggregation, chunked on
    the numeric order column ``order[chunk_on]``."""
    types = dict(rows.dtypes)
    cells = []
    for c in columns:
        text = number_text(c) if types.get(c) in ("double", "float") else F.col(c).cast("string")
        cell = fill_nulls(text, null_mode, mark)
        # Numbers, booleans and dates never hold a comma, quote or line break: no quoting test for them.
        plain = types.get(c, "string") != "string" and null_mode == "none"
        cells.append(F.coalesce(cell, F.lit("")) if plain else csv_field(cell))
    line = F.concat_ws(",", *cells)
    staged = rows.select(*keys, *order, line.alias("_line"),
                         *([sheet.alias("_sheet")] if sheet is not None else []))
    body = ordered_concat(staged, list(keys) + (["_sheet"] if sheet is not None else []), list(order),
                          F.concat(F.col("_line"), F.lit("\n")), "_body", chunk_on=chunk_on)
    text = F.concat(F.lit(csv_header(columns) + "\n"), F.col("_body"))
    if sheet is not None:
        text = F.concat(F.lit("Sheet: "), F.col("_sheet"), F.lit("\n"), text)
    return body.select(*keys, text.alias(out))


# -------------------------------------------------------------------------------------------------- parse CSV text
# Comma outside double quotes (CSV field separator when fields may be quoted).
QUOTED_SPLIT = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def _fields(line: Column, quoted: bool) -> Column:
    """Field texts of a line: plain comma split, or (``quoted``) a split on commas outside quotes with the quotes
    removed and doubled quotes restored."""
    if not quoted:
        return F.split(line, ",")
    return F.transform(F.split(line, QUOTED_SPLIT),
                       lambda f: F.when(f.rlike('^".*"$'),
                                        F.replace(F.regexp_replace(f, '^"|"$', ""), F.lit('""'), F.lit('"')))
                       .otherwise(f))


def _data_lines(tables: DataFrame, content_col: str, key_col: str, total: str, default_sheet: str,
                name_col: str | None, quoted: bool = False) -> DataFrame:
    """One row per kept data line: ``(..., title, sheet, row_no, _h, _l)`` (``_h`` = stripped header names)."""
    c = F.col(content_col)
    lines = F.split(c, "\n")
    hp = F.array_position(F.transform(lines, lambda l: l.startswith(key_col)), True)   # 1-based, 0 = none
    header = F.transform(_fields(F.element_at(lines, F.greatest(hp, F.lit(1)).cast("int")), quoted), py_strip)
    n = F.size(header)
    # Per-table values enter the line filter as zipped arrays, not as outer references inside the lambda (which
    # would be evaluated again for every line).
    m = F.size(lines)
    zipped = F.arrays_zip(lines.alias("l"), F.sequence(F.lit(1), F.greatest(m, F.lit(1))).alias("i"),
                          F.array_repeat(hp, m).alias("hp"), F.array_repeat(n, m).alias("n"))
    data = F.transform(F.filter(zipped, lambda z: (z["i"] > z["hp"]) & (py_strip(z["l"]) != "")
                                & ~z["l"].startswith(total) & (F.size(_fields(z["l"], quoted)) == z["n"])),
                       lambda z: z["l"])
    sheet = F.coalesce(F.nullif(py_strip(F.regexp_extract(c, r"Sheet:\s*([^\n]+)", 1)), F.lit("")),
                       F.lit(default_sheet))
    cols = [x for x in tables.columns if x != content_col]
    title = (F.replace(F.regexp_replace(F.col(name_col), "^.*/", ""), F.lit(".xlsx"), F.lit(""))
             if name_col else F.lit(None).cast("string"))
    staged = tables.where(hp > 0).select(*cols, title.alias("title"), sheet.alias("sheet"),
                                         header.alias("_h"), data.alias("_d"))
    return staged.select(*cols, "title", "sheet", "_h", F.posexplode("_d").alias("row_no", "_l"))


def parse_tables(tables: DataFrame, content_col: str = "content", key_col: str = fmt.KEY_COLUMN,
                 total: str = fmt.TOTAL_ROW, default_sheet: str = fmt.DEFAULT_SHEET,
                 name_col: str | None = None, quoted: bool = False) -> DataFrame:
    """Table text -> one row per data line: ``(..., title, sheet, row_no, row map<string,string>)``.

    Header = the first line starting with ``key_col`` (no header: the table is dropped).  Lines after it are split
    on plain commas (no quote handling), values stripped; blank lines, lines starting with ``total`` and lines whose
    field count differs from the header are skipped.  Repeated headers of later sheets stay as data rows.  Duplicate
    header names: the last value wins.  Everything is computed inside the row (arrays), so no shuffle is needed.
    ``quoted=True`` is the stricter mode: fields are split on commas outside double quotes and unquoted."""
    lines = _data_lines(tables, content_col, key_col, total, default_sheet, name_col, quoted)
    cols = [x for x in tables.columns if x != content_col]
    return lines.select(*cols, "title", "sheet", "row_no",
                        F.map_from_arrays("_h", F.transform(_fields(F.col("_l"), quoted), py_strip)).alias("row"))


def rows_long(parsed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row maps -> ``(keys, row_no, col_no, field, value)``, fields in header order."""
    return parsed.select(*keys, "row_no", F.posexplode(F.map_entries("row")).alias("col_no", "_e")) \
        .select(*keys, "row_no", (F.col("col_no") + 1).alias("col_no"),
                F.col("_e.key").alias("field"), F.col("_e.value").alias("value"))


def parse_tables_long(tables: DataFrame, content_col: str = "content", key_col: str = fmt.KEY_COLUMN,
                      total: str = fmt.TOTAL_ROW, default_sheet: str = fmt.DEFAULT_SHEET,
                      name_col: str | None = None, quoted: bool = False) -> DataFrame:
    """The cells of ``parse_tables`` as rows ``(..., title, sheet, row_no, col_no, field, value)`` in header order.

    Cells are exploded and stripped as plain (code-generated) expressions, without building maps; a duplicate
    header name appears once, at its first position, with the value of its last position (as in the map form)."""
    lines = _data_lines(tables, content_col, key_col, total, default_sheet, name_col, quoted)
    cols = [x for x in tables.columns if x != content_col]
    cells = lines.select(*cols, "title", "sheet", "row_no", "_h", _fields(F.col("_l"), quoted).alias("_fs"))
    cells = cells.select(*cols, "title", "sheet", "row_no", "_h", "_fs", F.posexplode("_fs").alias("_p", "_v"))
    pos = F.col("_p") + 1
    field = F.element_at("_h", pos.cast("int"))
    first = F.array_position("_h", field)
    last = (F.size("_h") + 1 - F.array_position(F.reverse("_h"), field)).cast("int")
    value = F.when(last == pos, F.col("_v")).otherwise(F.element_at("_fs", last))
    return cells.where(first == pos).select(*cols, "title", "sheet", "row_no", pos.cast("int").alias("col_no"),
                                            field.alias("field"), py_strip(value).alias("value"))


# ----------------------------------------------------------------------------------------------------- wide -> long
def unpivot_series(wide: DataFrame, key_col: str, order_col: str, value_cols: Sequence[str] | None = None,
                   total: str = fmt.TOTAL_ROW, rate_word: str = fmt.RATE_WORD, pct_unit: str = fmt.UNIT_PERCENT,
                   count_unit: str = fmt.UNIT_COUNT) -> DataFrame:
    """Wide table -> one series per non-key column: ``(col_no, field, unit, pos, name, value, value_raw)``.

    * columns: every column except the key (and the row-order column), in table order; ``col_no`` from 1;
    * unit: ``%`` when the column name contains ``rate_word`` or any value -- the total row included -- contains
      ``%``; otherwise ``count_unit``;
    * rows named ``total`` are left out of the series; ``value`` follows the parse ladder (percent, integer, float),
      null when the text is not a number (``value_raw`` keeps the text).
    The unit needs one small aggregate per column, joined back by broadcast (bounded by the number of columns).  The
    unpivoted table is checkpointed once (shared checkpoint folder), so its inputs are not recomputed per use.
    """
    cols = list(value_cols) if value_cols is not None else [c for c in wide.columns if c not in (key_col, order_col)]
    typed = wide.select(key_col, order_col, *[F.col(c).cast("string").alias(c) for c in cols])
    # A report table is read twice here (units, values) and again by chart/share consumers: compute it once.
    long = materialize(typed.unpivot([key_col, order_col], cols, "field", "value_raw"))
    col_no = F.array_position(F.array(*[F.lit(c) for c in cols]), F.col("field")).cast("int")
    units = long.groupBy("field").agg(F.bool_or(F.coalesce(F.col("value_raw").contains("%"), F.lit(False)))
                                      .alias("_pct"))
    units = units.select("field", F.when(F.col("_pct") | F.col("field").contains(rate_word), F.lit(pct_unit))
                         .otherwise(F.lit(count_unit)).alias("unit"))
    return (long.where(F.col(key_col) != total)
            .join(F.broadcast(units), "field")
            .select(col_no.alias("col_no"), "field", "unit", F.col(order_col).alias("pos"),
                    F.col(key_col).alias("name"), parse_value(F.col("value_raw")).alias("value"), "value_raw"))


def series_arrays(long: DataFrame) -> DataFrame:
    """Collected series: ``(col_no, field, unit, data array<struct<pos,name,value>>)`` in row order."""
    return long.groupBy("col_no", "field", "unit").agg(
        F.array_sort(F.collect_list(F.struct("pos", "name", "value"))).alias("data"))


def chart_series(long: DataFrame, x_col: int = 2, y_cols: Sequence[int] = (2, 3)) -> DataFrame:
    """Two series aligned by position for a stacked chart: ``(pos, name, value_<n>...)``; empty when a requested
    column is missing."""
    base = long.where(F.col("col_no") == x_col).select("pos", "name")
    for n in y_cols:
        s = long.where(F.col("col_no") == n).select("pos", F.col("value").alias(f"value_{n}"))
        base = base.join(s, "pos")
    return base


def series_share(long: DataFrame) -> DataFrame:
    """Each point's share of its series total: ``value / sum(value)`` per column (one small aggregate per column,
    broadcast back)."""
    totals = long.groupBy("col_no").agg(F.sum("value").alias("_total"))
    return (long.join(F.broadcast(totals), "col_no")
            .select("col_no", "field", "pos", "name", "value",
                    F.round(F.try_divide(F.col("value"), F.col("_total")), 6).alias("share")))
