"""Arrow-batched (pandas) UDFs for the few scalar functions Spark lacks.

This module deliberately has no ``from __future__ import annotations``: pandas
UDF type hints must be real types for Spark to infer the UDF kind.
"""

import math

import pandas as pd
from pyspark.sql.functions import pandas_udf

from .erf import erfc


@pandas_udf("double")
def normal_cdf(z: pd.Series) -> pd.Series:
    """Standard normal CDF (Spark has no erf)."""
    return pd.Series(0.5 * erfc(-z.to_numpy(dtype=float) / math.sqrt(2.0)), index=z.index)
