"""Row-level expressions: safe division, row-wise statistics, flags.

NULL is the only missing value in this package: every division goes through
``ratio`` and sources are scrubbed of NaN and infinities on the way in.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = str | Column


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: ColumnLike, den: ColumnLike) -> Column:
    """``num / den`` as double, NULL where the denominator is zero or missing."""
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))


def flag(condition: Column) -> Column:
    """0/1 integer that stays NULL where the condition is NULL."""
    return condition.cast("int")


def quoted(name: str) -> str:
    return f"`{name}`"


def literal(text: str) -> str:
    """A string as SQL text."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


# Statistics over families of columns are built as SQL text: one parsed expression
# instead of several calls into the JVM for every column.


def is_null_flag(c: str) -> Column:
    return F.expr(f"cast({quoted(c)} IS NULL AS int)")


def _nulls_sql(cols: Sequence[str]) -> str:
    return "(" + " + ".join(f"cast({quoted(c)} IS NULL AS int)" for c in cols) + ")"


def _sum_sql(cols: Sequence[str]) -> str:
    return "(" + " + ".join(f"coalesce(cast({quoted(c)} AS double), 0D)" for c in cols) + ")"


def _mean_sql(cols: Sequence[str]) -> str:
    return f"try_divide({_sum_sql(cols)}, cast({len(cols)} - {_nulls_sql(cols)} AS double))"


def null_count(cols: Sequence[str]) -> Column:
    return F.expr(_nulls_sql(cols))


def row_sum(cols: Sequence[str]) -> Column:
    """Sum that skips NULLs; 0 when every input is NULL."""
    return F.expr(_sum_sql(cols))


def row_mean(cols: Sequence[str]) -> Column:
    """Mean of the non-NULL inputs, NULL when there are none."""
    return F.expr(_mean_sql(cols))


def row_min(cols: Sequence[str]) -> Column:
    return F.expr(f"least({', '.join(map(quoted, cols))})")


def row_max(cols: Sequence[str]) -> Column:
    return F.expr(f"greatest({', '.join(map(quoted, cols))})")


def row_std(cols: Sequence[str]) -> Column:
    """Sample standard deviation over the non-NULL inputs (NULL below two)."""
    mean, freedom = _mean_sql(cols), f"({len(cols) - 1} - {_nulls_sql(cols)})"
    squares = " + ".join(f"coalesce(pow(cast({quoted(c)} AS double) - {mean}, 2), 0D)" for c in cols)
    return F.expr(f"CASE WHEN {freedom} > 0 THEN sqrt(try_divide({squares}, cast({freedom} AS double))) END")


def clipped_diff(a: ColumnLike, b: ColumnLike) -> Column:
    """``max(a - b, 0)``; like the row-wise maximum it is 0 when ``a - b`` is NULL."""
    return F.greatest(as_col(a) - as_col(b), F.lit(0))


def logit(p: ColumnLike, eps: float = 1e-6) -> Column:
    clipped = F.least(F.greatest(as_col(p), F.lit(eps)), F.lit(1.0 - eps))
    return F.ln(clipped / (1.0 - clipped))


def finite_or_null(c: ColumnLike) -> Column:
    """NaN and both infinities become NULL."""
    value = as_col(c)
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def finite_sql(name: str) -> str:
    """``finite_or_null`` of a column as double, as SQL text.

    Statistics over hundreds of columns are built from text: one parsed
    expression per column instead of a dozen calls into the JVM.
    """
    value = f"cast({quoted(name)} AS double)"
    return f"CASE WHEN NOT isnan({value}) AND abs({value}) <> double('Infinity') THEN {value} END"


def seeded_hash(key: ColumnLike, seed: int) -> Column:
    """Deterministic hex digest used wherever the work needs seeded randomness."""
    return F.md5(F.concat(as_col(key).cast("string"), F.lit(f":{seed}")))


# Rational approximation of the inverse normal CDF (P. J. Acklam): fixed values.
_CENTRE_NUM = (-39.69683028665376, 220.9460984245205, -275.9285104469687,
               138.3577518672690, -30.66479806614716, 2.506628277459239)
_CENTRE_DEN = (-54.47609879822406, 161.5858368580409, -155.6989798598866,
               66.80131188771972, -13.28068155288572, 1.0)
_TAIL_NUM = (-0.007784894002430293, -0.3223964580411365, -2.400758277161838,
             -2.549732539343734, 4.374664141464968, 2.938163982698783)
_TAIL_DEN = (0.007784695709041462, 0.3224671290700398, 2.445134137142996,
             3.754408661907416, 1.0)
_TAIL_CUT = 0.02425


def _polynomial(x: Column, coefficients: Sequence[float]) -> Column:
    return reduce(lambda acc, c: acc * x + F.lit(c), coefficients[1:], F.lit(coefficients[0]))


def inverse_normal(p: ColumnLike, eps: float = 1e-7) -> Column:
    """Standard normal quantile of a probability clipped to [eps, 1 - eps]."""
    prob = F.least(F.greatest(as_col(p), F.lit(eps)), F.lit(1.0 - eps))
    centred = prob - 0.5
    square = centred * centred
    centre = centred * _polynomial(square, _CENTRE_NUM) / _polynomial(square, _CENTRE_DEN)
    depth = F.sqrt(F.lit(-2.0) * F.ln(F.least(prob, 1.0 - prob)))
    tail = _polynomial(depth, _TAIL_NUM) / _polynomial(depth, _TAIL_DEN)
    return (
        F.when(prob < _TAIL_CUT, tail).when(prob > 1.0 - _TAIL_CUT, -tail).otherwise(centre)
    )
