"""Scalar column functions.

All are compositions of Spark SQL built-ins: they stay inside whole-stage
codegen and never call back into Python.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: interfaces that take their date parameter with hyphens ---
HYPHEN_DATE_INTERFACES = ("stock_sse_deal_daily", "stock_notice_report")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nan_to_null(c) -> Column:
    """Missing values are nulls in Spark; NaN from pandas-written files becomes one."""
    c = _c(c)
    return F.when(~F.isnan(c.cast("double")), c)


def return_bps(p, p_h, clip: float | None = 2000.0) -> Column:
    """``10000 * (p_h / p - 1)`` clipped to ``[-clip, clip]``.

    The guard comes first: ``greatest``/``least`` skip nulls (a null would
    clip to the bound), take NaN as the greatest value, and ANSI division by
    zero raises.  A NaN price is a missing price.
    """
    p, p_h = nan_to_null(p), nan_to_null(p_h)
    raw = F.lit(10000) * (p_h / p - F.lit(1))
    val = raw if clip is None else F.greatest(F.lit(-float(clip)), F.least(F.lit(float(clip)), raw))
    return F.when(p.isNotNull() & p_h.isNotNull() & (p != 0), val)


def label_na(p, p_h, known_date: Column | None = None) -> Column:
    """1 when the label cannot be computed, else 0.

    Not computable: date not in the calendar, p or p_h null or NaN, or p == 0.
    """
    p, p_h = nan_to_null(p), nan_to_null(p_h)
    bad = p.isNull() | p_h.isNull() | (p == 0)
    if known_date is not None:
        bad = bad | ~known_date
    return F.when(bad, F.lit(1)).otherwise(F.lit(0))


def _is_fractional(dt: T.DataType) -> bool:
    return isinstance(dt, (T.DoubleType, T.FloatType, T.DecimalType))


def feature_text(features: Sequence[tuple[str, Column, T.DataType | None]],
                 all_numeric_as_float: bool = True) -> Column:
    """``name=value`` lines joined by newline, nulls (and NaN) skipped.

    ``features`` is an ordered list of (name, column, type).  Fractional
    values print ``%.6f``; integral ones too when ``all_numeric_as_float``
    (the reference's left joins turn integers into floats), else plain text.
    """
    parts = []
    for name, col, dt in features:
        col = _c(col)
        numeric = isinstance(dt, T.NumericType)
        if dt is not None and (_is_fractional(dt) or (numeric and all_numeric_as_float)):
            txt = F.format_string("%.6f", col.cast("double"))
            present = col.isNotNull() & ~F.isnan(col.cast("double"))
        else:
            txt = col.cast("string")
            present = col.isNotNull()
        parts.append(F.when(present, F.concat(F.lit(f"{name}="), txt)))
    if not parts:
        return F.lit("")
    return F.concat_ws("\n", *parts)


def target_text(label, na) -> Column:
    """``LABEL_NA=1`` (flag set, or label null or NaN) or the label truncated toward zero."""
    label, na = nan_to_null(label), _c(na)
    return (F.when((na == 1) | label.isNull(), F.lit("LABEL_NA=1"))
            .otherwise(label.cast("bigint").cast("string")))


def date_text(c, with_time: bool = True) -> Column:
    """F8: ``yyyy-MM-dd HH:mm:ss`` (pandas datetime print) or ``yyyy-MM-dd``."""
    c = _c(c)
    if with_time:
        return F.date_format(c.cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")
    return F.date_format(c, "yyyy-MM-dd")


# --- fixed values: JSON short escapes (as Python's json module writes them) ---
_JSON_SHORT = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}


def _json_char(ch: Column) -> Column:
    """One character as ASCII-only JSON text: short escapes, ``\\uXXXX`` for
    control and non-ASCII characters, surrogate pairs above U+FFFF."""
    code = F.ascii(ch)                                   # the code point
    u = lambda x: F.format_string("\\u%04x", x)        # noqa: E731
    off = code - F.lit(0x10000)
    pair = F.concat(u(F.lit(0xD800) + F.shiftright(off, 10)), u(F.lit(0xDC00) + off.bitwiseAND(F.lit(0x3FF))))
    out = None
    for k, v in _JSON_SHORT.items():
        out = F.when(ch == F.lit(k), F.lit(v)) if out is None else out.when(ch == F.lit(k), F.lit(v))
    return (out.when(code > 0xFFFF, pair)
            .when((code < 0x20) | (code > 0x7E), u(code))
            .otherwise(ch))


def _json_str(c: Column) -> Column:
    chars = F.regexp_extract_all(c, F.lit("(?s)."), 0)   # one element per code point
    return F.concat(F.lit('"'), F.array_join(F.transform(chars, _json_char), ""), F.lit('"'))


def canonical_params_json(params) -> Column:
    """Canonical JSON of a string map: keys sorted, ``", "`` and ``": "`` separators.

    Equals Python's ``json.dumps(params, sort_keys=True)`` byte for byte,
    including its ``\\uXXXX`` escaping of non-ASCII and control characters.
    """
    params = _c(params)
    entries = F.array_sort(F.map_entries(F.coalesce(params, F.create_map().cast("map<string,string>"))))
    body = F.array_join(F.transform(entries, lambda e: F.concat(_json_str(e["key"]), F.lit(": "),
                                                                _json_str(e["value"]))), ", ")
    return F.concat(F.lit("{"), body, F.lit("}"))


def task_id(interface_id, params) -> Column:
    """sha256 hex of ``<interface>-<canonical JSON of params>``."""
    return F.sha2(F.concat(_c(interface_id), F.lit("-"), canonical_params_json(params)), 256)


def landing_path(base: str, source_domain, interface_id, params, tid) -> Column:
    """``base/source_domain=../interface=../date=<date|static>/part-<id[:10]>.parquet``."""
    d = F.coalesce(F.element_at(_c(params), F.lit("date")), F.lit("static"))
    d = F.regexp_replace(d, "-", "")
    return F.concat_ws("/", F.lit(base.rstrip("/")),
                       F.concat(F.lit("source_domain="), _c(source_domain)),
                       F.concat(F.lit("interface="), _c(interface_id)),
                       F.concat(F.lit("date="), d),
                       F.concat(F.lit("part-"), F.substring(_c(tid), 1, 10), F.lit(".parquet")))


def date_param(interface_id, date) -> Column:
    """``yyyy-MM-dd`` for the hyphen sources, ``yyyyMMdd`` otherwise."""
    iface, d = _c(interface_id), _c(date)
    hyphen = F.lit(False)
    for name in HYPHEN_DATE_INTERFACES:
        hyphen = hyphen | iface.contains(name)
    return F.when(hyphen, F.date_format(d, "yyyy-MM-dd")).otherwise(F.date_format(d, "yyyyMMdd"))


# --- fixed values: the written forms of a date, and the pattern whose groups are year, month and day ---
DATE_FORMS = {
    "yyyymmdd": r"^(\d{4})(\d{2})(\d{2})$",                                          # 20240930
    "yyyymm": r"^(\d{4})(\d{2})()$",                                                 # 202409: the month's first day
    "separated": r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?:[ T].*)?$",                # 2024-09-30, 2024/9/30 15:00
    "year-month": r"^(\d{4})[-/.](\d{1,2})()$",                                      # 2024-09
    "text": r"^(\d{4})年(\d{1,2})月(?:(\d{1,2})日.*|份?)$",                             # 2024年9月30日, 2024年09月份
}


def date_form(c) -> Column:
    """Name of the form of :data:`DATE_FORMS` a written date has; null for none."""
    s = _written(c)
    return F.coalesce(*[F.when(s.rlike(p), F.lit(n)) for n, p in DATE_FORMS.items()])


def parse_date(c) -> Column:
    """A date from any of the forms; a month is its first day, as is usual for
    parsers.  The forms exclude one another, so each value is read by its own;
    anything else, and a day that does not exist, is null.  It reads ``c`` many
    times; :func:`with_date` makes each step once a row."""
    s = _written(c)
    return _iso_date(s, _iso(s))


def with_date(df: DataFrame, out: str, c) -> DataFrame:
    """``df`` with column ``out``, the date written in ``c``.  Each step is a
    column of its own, so a row's compiled code stays short enough to be optimised."""
    written = df.withColumn("__written", _written(c)).withColumn("__iso", _iso(F.col("__written")))
    return written.withColumn(out, _iso_date(F.col("__written"), F.col("__iso"))).drop("__written", "__iso")


# --- all of DATE_FORMS in one pattern; its end is that of ``$``, a last line break taken in ---
ANY_FORM = (r"^(\d{4})(?:(\d{2})(\d{2})?|[-/.](\d{1,2})(?:[-/.](\d{1,2})(?:[ T].*)?)?|年(\d{1,2})月(?:(\d{1,2})日.*|份?))"
            r"(?:\r\n|[\r\n\x{85}\x{2028}\x{2029}])?\z")


def _iso(s: Column) -> Column:
    """Year, month and day (empty for a month) of a written date; anything else as it is."""
    return F.regexp_replace(s, ANY_FORM, "$1-$2$4$6-$3$5$7")


def _iso_date(s: Column, iso: Column) -> Column:
    return F.when(s.rlike(ANY_FORM), F.try_to_date(F.when(iso.endswith("-"), F.concat(iso, F.lit("1"))).otherwise(iso)))


def _written(c) -> Column:
    """Numbers are written without exponent or fraction.  A text with anything but
    digits, signs and blanks is no whole number: it is not cast, since every
    cast that fails costs an exception."""
    c = _c(c)
    text = (F.typeof(c) == "string") & c.cast("string").rlike(r"[^-+\d\s\p{Cntrl}]|\d-")
    whole = F.when(text, F.lit(None)).otherwise(c.try_cast("bigint").cast("string"))
    return F.regexp_replace(F.trim(F.coalesce(whole, c.cast("string"))), r"^(\d+)\.0$", "$1")


def pct(part, whole, digits: int = 2) -> Column:
    """``round(100 * part / whole, digits)`` (HALF_UP)."""
    return F.round(F.lit(100.0) * _c(part) / _c(whole), digits)


def ticker_of(code, pad: bool = True) -> Column:
    """Exchange-qualified ticker: ``6xxxxx`` -> ``.SH``, anything else -> ``.SZ``.

    Codes stay strings; ``pad`` restores leading zeros lost upstream and
    leaves codes of six or more characters whole.
    """
    c = F.trim(_c(code).cast("string"))
    if pad:
        c = F.when(F.length(c) < 6, F.lpad(c, 6, "0")).otherwise(c)
    return F.concat(c, F.when(c.startswith("6"), F.lit(".SH")).otherwise(F.lit(".SZ")))


def first_matching(columns: Iterable[str], needle: str) -> str:
    """First column whose name contains ``needle`` (metadata only)."""
    for c in columns:
        if needle in c:
            return c
    raise ValueError(f"no column containing {needle!r}")


def all_matching(columns: Iterable[str], needle: str) -> list[str]:
    """Every column whose name contains ``needle``."""
    return [c for c in columns if needle in c]


def numeric_columns(schema: T.StructType) -> list[str]:
    """P10: names of numeric (non-boolean) columns."""
    return [f.name for f in schema.fields if isinstance(f.dataType, T.NumericType)]
