"""Column-expression helpers shared by the operators (all JVM-side)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

__all__ = [
    "col_", "named", "quoted", "series_window", "cat_of", "dept_of", "state_of", "safe_div",
    "pos", "isclose", "pav3", "lookup", "round_doubles", "scalar",
    "higher_quantile_level", "conformal_level", "quantile_expr",
]

SERIES = ("item_id", "store_id")


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def named(c: str) -> str:
    """A column name in SQL text."""
    return "`" + c.replace("`", "``") + "`"


def quoted(text: str) -> str:
    """A string literal in SQL text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def series_window(keys: Iterable[str] = SERIES, order: str = "day_index"):
    """W_series: one partition per (item_id, store_id), ordered by day."""
    return Window.partitionBy(*keys).orderBy(order)


def cat_of(item_id="item_id") -> Column:
    """``HOBBIES_1_001`` -> ``HOBBIES``."""
    return F.split_part(col_(item_id), F.lit("_"), F.lit(1))


def dept_of(item_id="item_id") -> Column:
    """``HOBBIES_1_001`` -> ``HOBBIES_1``."""
    return F.substring_index(col_(item_id), "_", 2)


def state_of(store_id="store_id") -> Column:
    """``CA_1`` -> ``CA``."""
    return F.split_part(col_(store_id), F.lit("_"), F.lit(1))


def safe_div(num, den, default=None) -> Column:
    """Division that yields ``default`` (NULL) instead of raising on /0."""
    q = F.try_divide(col_(num), col_(den))
    return q if default is None else F.coalesce(q, F.lit(default))


def pos(x) -> Column:
    """(x)+ = max(x, 0)."""
    return F.greatest(col_(x), F.lit(0.0))


def isclose(a, b, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """NumPy ``isclose``: |a-b| <= atol + rtol*|b|."""
    a, b = col_(a), col_(b)
    return F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)


def pav3(a, b, c):
    """isotonic (pool-adjacent-violators) fit of three values, closed form.

    Returns three columns (g1 <= g2 <= g3) equal to the least-squares
    non-decreasing fit of (a, b, c) with unit weights.
    """
    a, b, c = col_(a), col_(b), col_(c)
    m = (a + b + c) / 3.0
    ab, bc = (a + b) / 2.0, (b + c) / 2.0
    g1 = F.least(a, ab, m)
    g2 = F.greatest(F.least(ab, m), F.least(b, bc))
    g3 = F.greatest(c, bc, m)
    return g1, g2, g3


def lookup(mapping: Mapping, key) -> Column:
    """Config map join as a literal map lookup (no join, no shuffle)."""
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*kv), col_(key))


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double/float column (stable value hashes across engines)."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            out.append(F.round(F.col(f"`{f.name}`").cast("double"), digits).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def scalar(df: DataFrame) -> Column:
    """A 1-row, 1-column aggregate as a scalar subquery column.

    Spark evaluates it once and inlines the value (and merges several
    scalar subqueries over the same plan into one job), so a global
    statistic is attached to every row without a join or an unpartitioned
    window.
    """
    return df.scalar()


def conformal_level(n, alpha) -> Column:
    """H2: min(ceil((n+1)(1-alpha))/n, 1)."""
    n = col_(n).cast("double")
    return F.least(F.ceil((n + 1) * (1 - F.lit(alpha))) / n, F.lit(1.0))


def higher_quantile_level(n, q) -> Column:
    """NumPy ``method='higher'`` at level q as a percentile_disc level.

    NumPy picks order statistic ceil((n-1)q) (0-based).  percentile_disc(p)
    returns the value at 1-based rank ceil(n*p); (r + 0.5)/n with r the
    0-based rank lands strictly inside that rank's step, avoiding float
    fragility at exact multiples of 1/n.
    """
    n = col_(n).cast("double")
    r = F.ceil((n - 1) * q - F.lit(1e-9))
    return (F.least(r, n - 1) + 0.5) / n


def quantile_expr(c, p, mode: str = "exact", accuracy: int = 100_000) -> Column:
    """Linear-interpolated quantile aggregate (NumPy default) or its
    approximation (``percentile_approx``) for very large inputs."""
    if mode == "approx":
        return F.percentile_approx(col_(c), p, accuracy)
    return F.percentile(col_(c), p)
