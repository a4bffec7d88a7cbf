"""Column functions (scalar, JVM-side) shared by every operator.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------------------------------
# These must equal the source system's behaviour for equal results.
# Characters that Python's str.strip() removes (str.isspace() is true for exactly these code points).
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Line boundaries of Python's str.splitlines().
SPLITLINES_PATTERN = "\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029]"
# Marks after which a line break inside a merged page text is kept.
SENTENCE_CLOSERS = "。！？；：)”》）]）"
# Label-width weights per tree level: (per wide char, per upper-case ASCII letter, per other char, padding).
WIDTH_WEIGHTS = {1: (16, 8, 10, 40), 2: (13, 8, 5, 50), 3: (12, 8, 5, 30)}
# The five XML/HTML entities decoded in page text, '&amp;' last.
HTML_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
# ---------------------------------------------------------------------------------------------------------------------

# Token rule: runs of Han characters, or runs of other letters/digits.
TOKEN_PATTERN = r"\p{IsHan}+|[\p{L}\p{N}&&[^\p{IsHan}]]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Python ``str.strip()``: removes all Unicode white space at both ends (``trim`` only removes U+0020)."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def is_blank(c) -> Column:
    return py_strip(c) == F.lit("")


def cr_normalize(c) -> Column:
    """``\\r\\n``, then ``\\r``, then the spreadsheet escape ``_x000D_`` become ``\\n``."""
    x = F.replace(_col(c), F.lit("\r\n"), F.lit("\n"))
    x = F.replace(x, F.lit("\r"), F.lit("\n"))
    return F.replace(x, F.lit("_x000D_"), F.lit("\n"))


def repair_line_breaks(c, closers: str = SENTENCE_CLOSERS) -> Column:
    """Delete a line break unless a closing mark precedes it or another line break follows it."""
    cls = "".join("\\" + ch if ch in "]\\^-[" else ch for ch in closers)
    return F.regexp_replace(_col(c), F.lit(f"(?<![{cls}])\\n(?!\\n)"), F.lit(""))


def split_lines(c) -> Column:
    """Python ``splitlines()`` of a stripped text (no trailing empty element because the text is stripped)."""
    return F.split(_col(c), SPLITLINES_PATTERN)


def first_line(c) -> Column:
    """``text.split('\\n')[0]``."""
    return F.substring_index(_col(c), "\n", 1)


def rest_lines(c) -> Column:
    """``'\\n'.join(text.split('\\n')[1:])``."""
    x = _col(c)
    pos = F.instr(x, "\n")
    return F.when(pos > 0, x.substr(pos + 1, F.length(x))).otherwise(F.lit(""))


def tokens(c, lower: bool = False) -> Column:
    """Letter/digit runs; Han runs become overlapping character bigrams (a single Han character stays whole)."""
    x = _col(c)
    if lower:
        x = F.lower(x)
    raw = F.regexp_extract_all(x, F.lit(TOKEN_PATTERN), 0)

    def expand(t):
        n = F.length(t)
        bigrams = F.transform(F.sequence(F.lit(1), n - 1), lambda i: t.substr(i, F.lit(2)))
        return F.when(t.rlike(r"^\p{IsHan}") & (n > 1), bigrams).otherwise(F.array(t))

    # The per-token expansion is a higher-order function (interpreted per element), so it only runs on texts that
    # contain a Han character; other texts use the plain letter/digit runs.
    plain = F.regexp_extract_all(x, F.lit(r"[\p{L}\p{N}]+"), 0)
    return F.when(x.rlike(r"\p{IsHan}"), F.flatten(F.transform(raw, expand))).otherwise(plain)


def token_set(c, lower: bool = False) -> Column:
    return F.array_distinct(tokens(c, lower))


def overlap_ratio(query_tokens, doc_tokens) -> Column:
    """distinct(Q ∩ D) / distinct(Q); an empty query scores 0.0."""
    q = F.array_distinct(_col(query_tokens))
    d = F.array_distinct(_col(doc_tokens))
    n = F.size(q)
    return F.when(n == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(q, d)) / n)


def dot(a, b) -> Column:
    """Dot product of two numeric arrays, summed in double in element order."""
    prods = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0), lambda s, x: s + x)


def unit_normalize(v) -> Column:
    v = _col(v)
    norm = F.sqrt(dot(v, v))
    # The norm enters as a zipped argument: an outer reference inside the lambda would be recomputed per element.
    return F.zip_with(v, F.array_repeat(norm, F.size(v)), lambda x, n: x.cast("double") / n)


def md5_suffix(c, modulo: int = 10000) -> Column:
    """Stable replacement of a salted ``hash(x) % 10000``: the first 8 hex digits of md5, modulo ``modulo``."""
    return (F.conv(F.substring(F.md5(_col(c)), 1, 8), 16, 10).cast("long") % F.lit(modulo)).cast("string")


def decode_entities(c) -> Column:
    x = _col(c)
    for ent, ch in HTML_ENTITIES:
        x = F.replace(x, F.lit(ent), F.lit(ch))
    return x


def strip_tags(c) -> Column:
    return F.regexp_replace(_col(c), F.lit("<[^>]*>"), F.lit(""))


def drop_script_style(c) -> Column:
    return F.regexp_replace(_col(c), F.lit(r"(?is)<script\b.*?</script>|<style\b.*?</style>"), F.lit(""))


def utf16_length(c) -> Column:
    """String length in UTF-16 code units (what a browser's ``str.length`` reports)."""
    x = _col(c)
    astral = F.length(F.regexp_replace(x, F.lit("[^\\x{10000}-\\x{10FFFF}]"), F.lit("")))
    return F.length(x) + astral


def wide_count(c) -> Column:
    """UTF-16 code units above 255 (an astral character counts twice, as in the browser)."""
    x = _col(c)
    wide = F.length(F.regexp_replace(x, F.lit("[\\x{0}-\\x{FF}]"), F.lit("")))
    astral = F.length(F.regexp_replace(x, F.lit("[^\\x{10000}-\\x{10FFFF}]"), F.lit("")))
    return wide + astral


def upper_ascii_count(c) -> Column:
    return F.length(F.regexp_replace(_col(c), F.lit("[^A-Z]"), F.lit("")))


def label_width(c, level: int) -> Column:
    """Drawn label width: wide*w1 + upper*w2 + rest*w3 + pad, weights per tree level (levels above 3 use level 3)."""
    w1, w2, w3, pad = WIDTH_WEIGHTS[min(max(level, 1), 3)]
    wide = wide_count(c)
    upper = upper_ascii_count(c)
    rest = utf16_length(c) - wide - upper
    return wide * w1 + upper * w2 + rest * w3 + F.lit(pad)


def percent_text(v, decimals: int = 2) -> Column:
    """Python ``f"{v:.2%}"``: value times 100 with fixed decimals and a percent sign."""
    return F.format_string(f"%.{decimals}f%%", _col(v).cast("double") * 100)


def number_text(v) -> Column:
    """Python ``str(v)`` for an int or float cell: plain digits from 1e-4 up to 1e16, an exponent beyond."""
    text = _col(v).cast("string")
    power = F.regexp_extract(text, r"E(-?[0-9]+)$", 1).try_cast("int")
    plain = F.regexp_replace(text.try_cast("decimal(38,21)").cast("string"), "0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    mantissa = F.regexp_replace(F.regexp_replace(text, "E.*$", ""), r"\.0$", "")
    digits = F.abs(power).cast("string")
    digits = F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits)
    exponent = F.concat(mantissa, F.lit("e"), F.when(power < 0, "-").otherwise("+"), digits)
    # Most numbers have no exponent: their text is right as it is, and nothing below is evaluated for them.
    return F.when(~text.contains("E"), text).when(power.isNull(), text).when(power.between(-4, 15), plain).otherwise(exponent)


def parse_value(raw) -> Column:
    """Value ladder: '12.5%' -> 12.5; digits -> integer; a float literal -> float; anything else -> null.

    Returned as double; keep the raw text next to it for values that do not parse.
    """
    r = _col(raw)
    no_pct = F.replace(r, F.lit("%"), F.lit(""))
    num_rx = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
    pct = F.when(no_pct.rlike(num_rx), no_pct.cast("double"))
    plain = F.when(r.rlike(num_rx), r.cast("double"))
    return F.when(r.contains("%"), pct).otherwise(plain)


def normal_path(path, base: str = "/") -> Column:
    """A path made absolute and normal: a relative one stands under ``base``; empty and ``.`` segments go, ``..`` takes the
    segment before it away (nothing above the root).  Back slashes are part of a name.  Null stays null."""
    whole = F.when(_col(path).startswith("/"), _col(path)).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), _col(path)))
    none = F.array().cast("array<string>")
    step = lambda kept, s: (F.when(s.isin("", "."), kept)
                            .when(s == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))).otherwise(F.array_append(kept, s)))
    return F.concat(F.lit("/"), F.array_join(F.aggregate(F.split(whole, "/"), none, step), "/"))


def base_name(path) -> Column:
    """The last segment of a path."""
    return F.regexp_extract(_col(path), "([^/]*)$", 1)


def json_string(c) -> Column:
    """A text as a JSON string literal; null as the literal null."""
    listed = F.to_json(F.array(_col(c).cast("string")))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def value_json(raw) -> Column:
    """The value ladder as a JSON literal: '12.5%' -> 12.5 and '12%' -> 12.0; digits -> an integer; a float literal -> a
    float; any other text -> a string."""
    r = _col(raw)
    number = parse_value(r)
    whole = F.regexp_replace(r, r"^0+(?=\d)", "")
    return (F.when(r.rlike(r"^[0-9]+$"), whole).when(number.isNotNull(), number_text(number)).otherwise(json_string(r)))


def json_fence_body(c) -> Column:
    """Body of a fenced ```json block, or '' when there is none."""
    return F.regexp_extract(_col(c), "```json\\n([\\s\\S]*?)\\n```", 1)


def iso_now() -> Column:
    """The query's timestamp as ISO-8601 text with microseconds (one value per query)."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
