"""Column functions: Column in, Column out, all inside generated code."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sixteen compass points clockwise from north.
COMPASS = ["N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE", "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW"]
# Month names in order.
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _lits(values: Sequence) -> Column:
    return F.array(*[F.lit(v) for v in values])


# ---- text -------------------------------------------------------------------


def remove_first(x, pattern: str) -> Column:
    """Cut the first match only."""
    return F.regexp_replace(_c(x), rf"(?s)^(.*?)(?:{pattern})", "$1")


def remove_all(x, pattern: str) -> Column:
    return F.regexp_replace(_c(x), pattern, "")


def replace_all(x, pattern: str, to: str) -> Column:
    return F.regexp_replace(_c(x), pattern, to)


def detect(x, pattern: str) -> Column:
    return _c(x).rlike(pattern)


def drop_last(x, n: int = 1) -> Column:
    """Text without its last n characters."""
    return F.substring(_c(x), F.lit(1), F.greatest(F.length(_c(x)) - n, F.lit(0)))


def parse_number(x) -> Column:
    """First number in a text; grouping commas are ignored, NULL if there is none."""
    t = F.regexp_extract(F.regexp_replace(_c(x), ",", ""), r"(-?\d+(?:\.\d+)?)", 1)
    return F.nullif(t, F.lit("")).try_cast("double")


def blank_to_null(x, blank: str = "") -> Column:
    return F.nullif(_c(x), F.lit(blank))


def title_case(x) -> Column:
    return F.initcap(_c(x))


def percent_to_fraction(x) -> Column:
    """'56.75%' to 0.5675; text that is no number gives NULL."""
    return F.regexp_replace(_c(x), "%", "").try_cast("double") * F.lit(0.01)


# ---- dates ------------------------------------------------------------------


def week_of_year(d) -> Column:
    """Whole weeks since 1 January, plus one (not the ISO week)."""
    return F.floor((F.dayofyear(_c(d)) - 1) / 7) + 1


def month_number(name) -> Column:
    """1..12 from a full month name or its three letters, NULL otherwise."""
    full = F.array_position(_lits(MONTHS), _c(name))
    abbr = F.array_position(_lits([m[:3] for m in MONTHS]), _c(name))
    return F.nullif(F.greatest(full, abbr), F.lit(0).cast("long"))


def month_name(n, short: bool = True) -> Column:
    return F.get(_lits([m[:3] if short else m for m in MONTHS]), _c(n).cast("int") - 1)


def first_of_month(year, month) -> Column:
    return F.to_date(F.format_string("%04d-%02d-01", _c(year).cast("int"), _c(month).cast("int")))


# ---- conditions and numbers -------------------------------------------------


def if_else(test: Column, yes, no, missing=None) -> Column:
    """A missing test gives ``missing``, not the no branch."""
    return F.when(test.isNull(), F.lit(missing)).when(test, yes).otherwise(no)


def case_when(*branches: tuple[Column, object], default=None) -> Column:
    out = None
    for cond, val in branches:
        v = val if isinstance(val, Column) else F.lit(val)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def safe_divide(a, b) -> Column:
    return F.try_divide(_c(a), _c(b))


def correlation(a, b) -> Column:
    """Pearson correlation of complete pairs; NULL where a side does not vary.

    ``corr`` divides by zero there, an error under ANSI rules. ``regr_r2`` does
    not, but says 1 when only its first side is constant; the covariance then
    is 0, which tells the cases apart.
    """
    x, y = _c(a).cast("double"), _c(b).cast("double")
    r2, cov = F.regr_r2(x, y), F.covar_pop(x, y)
    return F.when((cov != 0) | (r2 != 1), F.signum(cov) * F.sqrt(r2))


def round_half_even(x, digits: int = 0) -> Column:
    return F.bround(_c(x), digits)


def safe_log(x, base: float | None = None) -> Column:
    """log with -Infinity at zero and NaN below it."""
    v = _c(x).cast("double")
    raw = F.log(v) if base is None else F.log(float(base), v)
    return F.when(v == 0, F.lit(float("-inf"))).when(v < 0, F.lit(float("nan"))).otherwise(raw)


def cut_right(x, breaks: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """Bins (a, b]; NULL outside the breaks."""
    out, v = None, _c(x)
    for i, (a, b) in enumerate(zip(breaks, breaks[1:])):
        lab = labels[i] if labels else f"({a:g},{b:g}]"
        cond = (v > a) & (v <= b)
        out = F.when(cond, lab) if out is None else out.when(cond, lab)
    return out


def compass_degrees(x) -> Column:
    """Compass point to degrees clockwise from north, NULL if unknown."""
    pos = F.array_position(_lits(COMPASS), _c(x))
    return F.when(pos > 0, (pos - 1) * (360.0 / len(COMPASS)))


# ---- categories -------------------------------------------------------------


def level_code(x, levels: Sequence[str]) -> Column:
    """1-based index in an explicit level list, NULL if absent."""
    return F.nullif(F.array_position(_lits(levels), _c(x)), F.lit(0).cast("long"))


def ordinal_code(x, levels: Sequence[str], missing: str = "Unknown") -> Column:
    """Level index with one level read as missing."""
    return F.when(_c(x) == missing, F.lit(None)).otherwise(level_code(x, levels))


def recode(x, mapping: dict) -> Column:
    """Values by a fixed mapping, others unchanged."""
    out = None
    for k, v in mapping.items():
        out = F.when(_c(x) == F.lit(k), F.lit(v)) if out is None else out.when(_c(x) == F.lit(k), F.lit(v))
    return _c(x) if out is None else out.otherwise(_c(x))


def list_length(x) -> Column:
    return F.size(_c(x))


def compose(*fns: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """One column function from several, applied left to right."""

    def run(x: Column) -> Column:
        for f in fns:
            x = f(x)
        return x

    return run


def round_fast(col: str, digits: int) -> Column:
    """F.round of a double, without its decimal where the digits cut off are not near a half and the number is neither negative nor large."""
    c, ten = F.col(col), float(10**digits)
    up = c * ten
    plain = (c >= 0) & (up < 2.0**40) & (F.abs(up - F.floor(up) - 0.5) > 0.001)
    return F.when(plain, F.floor(up + 0.5) / ten).otherwise(F.round(c, digits))
