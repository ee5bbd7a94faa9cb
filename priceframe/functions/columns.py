"""Column-level functions: each returns a ``Column`` built from JVM expressions.

Nothing here is a Python UDF; every function composes ``pyspark.sql.functions``
so it stays inside whole-stage codegen.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Tokens that mean "no value" in text-typed numeric cells.
MISSING_TOKENS = ("", "nan", "none", "null")


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: ColumnOrName) -> Column:
    """NaN → null; everything else unchanged (aggregates propagate NaN, not null)."""
    c = _col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def parse_thousands(c: ColumnOrName) -> Column:
    """Text number with thousands separators → double; blanks/'nan'/'None'/junk → null.

    ``try_cast`` keeps ANSI mode from throwing on junk cells.
    """
    txt = F.trim(F.regexp_replace(_col(c).cast("string"), ",", ""))
    parsed = F.when(F.lower(txt).isin(*MISSING_TOKENS), F.lit(None)).otherwise(txt)
    return nan_to_null(parsed.try_cast("double"))


def canonical_key(c: ColumnOrName, case: str = "upper") -> Column:
    """Trimmed key in one case: ``upper`` for codes, ``lower`` for names."""
    t = F.trim(_col(c))
    if case == "upper":
        return F.upper(t)
    if case == "lower":
        return F.lower(t)
    raise ValueError(f"case must be 'upper' or 'lower', got {case!r}")


def guarded_ratio(num: ColumnOrName, den: ColumnOrName, scale: float = 1.0) -> Column:
    """``num * scale / den`` when ``den`` is present and positive, else null."""
    num, den = _col(num), _col(den)
    return F.when(den.isNotNull() & (den > 0), num * F.lit(float(scale)) / den)


def clamp_min(c: ColumnOrName, lo: float = 1.0) -> Column:
    """Floor at ``lo``; null stays null (``greatest`` alone would turn null into ``lo``)."""
    c = _col(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(float(lo))))


def decade_label(year: ColumnOrName) -> Column:
    """1997 → '1990s'."""
    decade = (F.floor(_col(year) / 10) * 10).cast("int")
    return F.concat(decade.cast("string"), F.lit("s"))


def round_scaled(c: ColumnOrName, digits: int) -> Column:
    """Round half away from zero as ``round(x·10^d) / 10^d`` on the binary double.

    ``F.round(x, d)`` rounds the double's decimal text instead, which differs on
    values like 2.675 (stored just below); the scaled form is what most SQL
    engines compute, so results agree bit for bit across engines.
    """
    m = float(10 ** digits)
    return F.round(_col(c) * F.lit(m)) / F.lit(m) if digits else F.round(_col(c))


def pct_round(c: ColumnOrName, digits: int = 1, half_even: bool = True) -> Column:
    """``c * 100`` rounded, a tie to the even digit as numpy does; ``half_even=False`` away from zero.

    The tie is one of the scaled binary double, as in numpy and most SQL engines.
    """
    scaled, m = _col(c) * F.lit(100.0), float(10 ** digits)
    # Adding 0 turns a negative zero into zero, whose text has no sign of its own.
    return F.rint(scaled * F.lit(m)) / F.lit(m) + F.lit(0.0) if half_even else round_scaled(scaled, digits)


def fmt_pct(c: ColumnOrName, digits: int = 1) -> Column:
    """0.1234 → '+12.3%', -0.05 → '-5.0%' (sign shown for non-negative values).

    The value is rounded first, then printed with the same digits, so the text
    does not depend on how an engine formats the unrounded double.
    """
    c = _col(c)
    return F.when(c.isNotNull(), signed_pct_text(pct_round(c, digits), digits))


def fmt_usd(c: ColumnOrName, digits: int = 2) -> Column:
    """2.5 → '$2.50'. Fixed decimals keep the text identical across engines."""
    c = _col(c)
    return F.when(c.isNotNull(), F.concat(F.lit("$"), F.format_string(f"%.{digits}f", round_scaled(c, digits))))


def signed_pct_text(pct: ColumnOrName, digits: int = 1) -> Column:
    """An already-scaled percent value → '+12.3%'."""
    pct = _col(pct)
    return F.concat(F.when(pct >= 0, F.lit("+")).otherwise(F.lit("")),
                    F.format_string(f"%.{digits}f", pct), F.lit("%"))


def hover_text(name: ColumnOrName, pct: ColumnOrName, price: ColumnOrName,
               index_label: str = "Valuation: ", price_label: str = "Price: ") -> Column:
    """Multi-part map label: name, signed valuation percent, price."""
    return F.concat(_col(name), F.lit("<br>"), F.lit(index_label), signed_pct_text(pct),
                    F.lit("<br>"), F.lit(price_label), fmt_usd(price))


def valuation_class(c: ColumnOrName, inclusive: bool = True,
                    labels: tuple[str, str] = ("Overvalued", "Undervalued")) -> Column:
    """Label by sign; ``inclusive`` puts 0 on the over side (dashboard), else not (chart)."""
    c = _col(c)
    over = (c >= 0) if inclusive else (c > 0)
    return F.when(c.isNotNull(), F.when(over, F.lit(labels[0])).otherwise(F.lit(labels[1])))


def bin_label(c: ColumnOrName, edges: Sequence[float], labels: Sequence[str],
              null_label: str | None = None) -> Column:
    """Left-closed bins ``[e_i, e_{i+1})`` → labels; null/NaN → ``null_label``.

    The ``when`` chain is generated from the edges; infinite edges drop their test.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per bin")
    c = _col(c)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = F.lit(True)
        if not math.isinf(lo):
            cond = cond & (c >= F.lit(float(lo)))
        if not math.isinf(hi):
            cond = cond & (c < F.lit(float(hi)))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    missing = c.isNull() | F.isnan(c)
    return F.when(missing, F.lit(null_label)).otherwise(expr)


def bin_ordinal(c: ColumnOrName, labels: Sequence[str], null_label: str | None = None) -> Column:
    """Position of a bin label in bin order (null label last) — for sorting labels."""
    c = _col(c)
    expr = None
    ordered = list(labels) + ([null_label] if null_label is not None else [])
    for i, lab in enumerate(ordered):
        expr = F.when(c == F.lit(lab), F.lit(i)) if expr is None else expr.when(c == F.lit(lab), F.lit(i))
    return expr


def residual(actual: ColumnOrName, predicted: ColumnOrName) -> Column:
    return _col(actual) - _col(predicted)
