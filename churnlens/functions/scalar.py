"""Scalar Column expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# A number the way a lenient numeric parser accepts it: optional sign, digits
# with an optional fraction, optional exponent, or an infinity word.  Anything
# else ('12d', 'NaN', '1_000', blanks) is rejected before the cast, because
# try_cast alone accepts '12d' (as 12.0) and 'NaN'.
NUMBER_PATTERN = r"^[+-]?((\d+\.?\d*)|(\.\d+))([eE][+-]?\d+)?$|^[+-]?(?i:inf|infinity)$"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: ColumnOrName) -> Column:
    """Lenient numeric cast (P1): unparsable, blank or NaN text -> null."""
    t = F.trim(_col(c).cast("string"))
    return F.when(t.rlike(NUMBER_PATTERN), t.try_cast("double"))


def binarize(c: ColumnOrName, positive: str = "Yes") -> Column:
    """1 iff the value equals ``positive``; null and anything else -> 0."""
    return _col(c).eqNullSafe(F.lit(positive)).cast("int")


def cut_index(c: ColumnOrName, edges: Sequence[float]) -> Column:
    """Right-closed bins ``(e[i-1], e[i]]`` numbered from 1; outside -> null.

    ``Bucketizer`` is left-closed and cannot express this.
    """
    x = _col(c)
    expr = None
    for i in range(1, len(edges)):
        cond = (x > F.lit(edges[i - 1])) & (x <= F.lit(edges[i]))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def cut_label(index: ColumnOrName, labels: Sequence[str]) -> Column:
    """Label of a 1-based bin index; null index -> null label."""
    return decode(index, {i + 1: lab for i, lab in enumerate(labels)}, default=None)


def round_half_even(c: ColumnOrName, digits: int = 0) -> Column:
    """NumPy-style rounding ``rint(x * 10^d) / 10^d``.

    Spark's ``round`` rounds half up; ``bround`` rounds the exact decimal of the
    double, which differs from NumPy on values like 2.675.
    """
    scale = float(10 ** digits)
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale)


def pct(c: ColumnOrName, digits: int = 1) -> Column:
    """Share as percent, rounded half to even."""
    return round_half_even(_col(c) * F.lit(100.0), digits)


def band(c: ColumnOrName, thresholds: Sequence[tuple[float, str]], default: str) -> Column:
    """First label whose threshold the value strictly exceeds.

    ``thresholds`` are checked in the given order, e.g.
    ``[(40, 'High'), (20, 'Medium')]`` with default ``'Low'``.
    """
    x = _col(c)
    expr = None
    for bound, label in thresholds:
        cond = x > F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def decode(c: ColumnOrName, mapping: dict, default: str | None = "") -> Column:
    """Look a value up in a literal map; missing -> ``default``."""
    if not mapping:
        return F.lit(default)
    m = F.create_map(*[F.lit(v) for v in chain.from_iterable(mapping.items())])
    hit = F.try_element_at(m, _col(c))
    return hit if default is None else F.coalesce(hit, F.lit(default))


def trunc_int(c: ColumnOrName) -> Column:
    """Truncation toward zero, like Python's ``int()`` of a float."""
    return _col(c).cast("long")


def safe_ratio(num: ColumnOrName, den: ColumnOrName, zero: float | None = 0.0) -> Column:
    """num / den with a zero or null denominator giving ``zero``."""
    r = F.try_divide(_col(num).cast("double"), _col(den).cast("double"))
    return r if zero is None else F.coalesce(r, F.lit(zero))
