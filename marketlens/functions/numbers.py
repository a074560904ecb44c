"""Numeric-string scalars as native Column expressions (no UDFs).

X-01 parse_number, X-02 parse_cpc, X-03 parse_volume_legacy, X-04 intent_label,
X-05 first_int, X-07 score_gate, X-21 safe_div, plus decimal-then-round.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python ``float()`` accepts these finite forms; anything else (``7d``, ``1_000``,
# ``nan``, ``inf``) is rejected by the guard before Spark's cast sees it.
_FLOAT_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_INT_RE = r"^[+-]?[0-9]+$"
_WS_EDGES = r"^\s+|\s+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace (Spark's
    ``trim`` only removes spaces)."""
    return F.regexp_replace(_col(c), _WS_EDGES, "")


def _trunc(x: Column) -> Column:
    # int(float) truncates toward zero; ``x - x % 1`` does that on doubles of
    # any magnitude without a bigint overflow.
    return x - (x % F.lit(1.0))


def clean_number_text(c) -> Column:
    """First half of X-01: strip; delete ``, $ %`` and en/em dashes; strip."""
    return py_strip(F.regexp_replace(py_strip(F.coalesce(_col(c), F.lit(""))), "[,$%–—]", ""))


def parse_clean(s) -> Column:
    """Second half of X-01, on an already cleaned string: empty, ``-`` or
    ``n/a`` -> 0; K/M/B suffix (any case) -> ``trunc(float(head) * 10^n)``;
    with a ``.`` -> float; otherwise int; anything unparseable -> 0."""
    s = _col(s)
    last = F.upper(F.substring(s, -1, 1))
    head = py_strip(F.substring(s, F.lit(1), F.length(s) - F.lit(1)))
    scale = (F.when(last == "B", F.lit(1e9))
             .when(last == "M", F.lit(1e6))
             .when(last == "K", F.lit(1e3)))
    suffixed = F.when(head.rlike(_FLOAT_RE), _trunc(head.try_cast("double") * scale))
    plain = (F.when(s.contains("."), F.when(s.rlike(_FLOAT_RE), s.try_cast("double")))
             .otherwise(F.when(s.rlike(_INT_RE), s.try_cast("double"))))
    value = F.when(scale.isNotNull(), suffixed).otherwise(plain)
    empty = (s == "") | (s == "-") | (F.lower(s) == "n/a")
    return F.when(empty, F.lit(0.0)).otherwise(F.coalesce(value, F.lit(0.0)))


def parse_number(c, legacy: bool = False) -> Column:
    """Human number string -> double (X-01).

    strip; delete ``, $ %`` and en/em dashes; strip; empty, ``-`` or ``n/a``
    -> 0; K/M/B suffix (any case) -> ``trunc(float(head) * 10^n)``; with a
    ``.`` -> float; otherwise int; anything unparseable -> 0.
    ``legacy=True`` returns :func:`parse_volume_legacy` instead.

    On a DataFrame, prefer :func:`with_parsed_numbers`, which materialises
    the cleaned string once so the CASE branches do not repeat the
    cleaning regexes.
    """
    if legacy:
        return parse_volume_legacy(c)
    return parse_clean(clean_number_text(c))


def with_parsed_numbers(df, mapping: dict):
    """Add parsed columns ``{out: raw}`` in two projections: the cleaned
    strings first (one regex pass per value), then the parse on them."""
    tmp = {f"__clean_{o}": clean_number_text(r) for o, r in mapping.items()}
    staged = df.withColumns(tmp)
    return staged.withColumns({o: parse_clean(f"__clean_{o}") for o in mapping}).drop(*tmp)


def parse_cpc(c) -> Column:
    """CPC string -> double, NULL when empty or unparseable (X-02).

    ``$`` and ``,`` removed, then float(); the reference drops such values
    from the pool instead of counting them as 0.
    """
    s = F.translate(_col(c), "$,", "")
    t = py_strip(s)
    return F.when((s != "") & t.rlike(_FLOAT_RE), t.try_cast("double"))


def parse_volume_legacy(c) -> Column:
    """Paid-module volume parse (X-03): textual ``K -> 000``, ``M -> 000000``
    (upper case only), accepted when digits with at most one dot; so
    ``1.2K`` -> ``1.2000`` -> 1.2 (defect D8, kept on purpose)."""
    s = F.replace(F.replace(F.replace(_col(c), F.lit(","), F.lit("")),
                            F.lit("K"), F.lit("000")), F.lit("M"), F.lit("000000"))
    return F.when(s.rlike(r"^([0-9]+\.?[0-9]*|\.[0-9]+)$"), s.try_cast("double"))


# Intent codes and labels as the source tables print them.
INTENT_CODES = {"T": "Transactional", "C": "Commercial", "I": "Informational", "N": "Navigational"}
INTENT_LABELS = ["Transactional", "Commercial", "Informational", "Navigational"]


def intent_label(c) -> Column:
    """Intent code or label -> label; anything else 'Unknown' (X-04)."""
    x = _col(c)
    out = F.lit("Unknown")
    for code, label in INTENT_CODES.items():
        out = F.when(x == code, F.lit(label)).otherwise(out)
    return F.when(x.isin(*INTENT_LABELS), x).otherwise(out)


def first_int(c) -> Column:
    """First run of digits in a label ("5 stars") -> int, else NULL (X-05)."""
    digits = F.regexp_extract(_col(c), r"([0-9]+)", 1)
    return F.when(digits != "", digits.try_cast("int"))


def score_gate(c, upper: float = 100.0) -> Column:
    """Keep ``0 < v <= upper`` else 0 (X-07); ``upper=None`` keeps v > 0."""
    v = _col(c)
    ok = (v > 0) if upper is None else ((v > 0) & (v <= upper))
    return F.when(ok, v).otherwise(F.lit(0.0))


def safe_div(num, den) -> Column:
    """``num / den`` when ``den > 0`` else 0 (X-21). ANSI mode raises on /0."""
    n, d = _col(num), _col(den)
    return F.when(d > 0, n / F.when(d > 0, d)).otherwise(F.lit(0.0))


def dround(c, scale: int) -> Column:
    """Decimal-then-round (HALF_UP on the decimal value), back to double.

    Identical in Spark and DuckDB, unlike rounding the binary double."""
    return F.round(_col(c).cast("decimal(38,10)"), scale).cast("double")
