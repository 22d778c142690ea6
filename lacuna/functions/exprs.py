"""Column expressions shared by the operators.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values of the task: risk-class thresholds, truthy tokens, season months.
HIGH_RISK_AT = 85.0
MODERATE_RISK_AT = 70.0
TRUTHY_TOKENS = ("yes", "true", "1", "holiday", "public holiday")
SEASON_BY_MONTH = {12: "Winter", 1: "Winter", 2: "Winter",
                   3: "Spring", 4: "Spring", 5: "Spring",
                   6: "Summer", 7: "Summer", 8: "Summer",
                   9: "Autumn", 10: "Autumn", 11: "Autumn"}
DEFAULT_SEED = 42


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite_or_null(c: ColumnOrName) -> Column:
    """NaN and +/-inf become NULL: Spark treats NaN as a value, SQL NULL is the gap."""
    x = col(c)
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None)).otherwise(x)


def to_double(c: ColumnOrName) -> Column:
    """Numeric coercion: text that is not a number becomes NULL (never raises)."""
    return finite_or_null(col(c).try_cast("double"))


def to_date_or_null(c: ColumnOrName, fmt: str | None = None) -> Column:
    x = col(c)
    return F.try_to_date(x.cast("string"), F.lit(fmt)) if fmt else F.try_to_date(x.cast("string"))


def md5_key(key_cols, seed=DEFAULT_SEED, *extra) -> Column:
    """md5(key | ... | seed) as hex: a deterministic, engine-independent row shuffle.

    Identical in Spark and DuckDB as long as the key parts are integers or text.
    """
    parts = [col(k).cast("string") for k in key_cols]
    parts += [F.lit(str(e)) for e in extra]
    parts.append(F.lit(str(seed)))
    return F.md5(F.concat_ws("|", *parts))


def risk_class(rate: ColumnOrName, high: float = HIGH_RISK_AT,
               moderate: float = MODERATE_RISK_AT) -> Column:
    """>= high -> High, >= moderate -> Moderate, else (and NULL) -> Low."""
    r = col(rate)
    return (F.when(r >= F.lit(high), F.lit("High"))
             .when(r >= F.lit(moderate), F.lit("Moderate"))
             .otherwise(F.lit("Low")))


def truthy(c: ColumnOrName, kind: str = "string") -> Column:
    """Flag normaliser: booleans as is, numbers > 0, text in the truthy token list."""
    x = col(c)
    if kind == "boolean":
        return F.coalesce(x, F.lit(False))
    if kind == "numeric":
        return F.coalesce(x > 0, F.lit(False))
    return F.coalesce(F.lower(F.trim(x.cast("string"))).isin(*TRUTHY_TOKENS), F.lit(False))


def season_of(month: ColumnOrName) -> Column:
    m = col(month)
    out = None
    for season in ("Winter", "Spring", "Summer", "Autumn"):
        months = [k for k, v in SEASON_BY_MONTH.items() if v == season]
        cond = m.isin(*months)
        out = F.when(cond, F.lit(season)) if out is None else out.when(cond, F.lit(season))
    return out


def rounded(c: ColumnOrName, digits: int = 6) -> Column:
    return F.round(col(c), digits)
