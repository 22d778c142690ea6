"""SQL fragments shared by the oracle queries (DuckDB dialect).

They restate, in SQL, the inputs the Spark plans derive from the driver tables:
the md5-ranked masks and the panel views.  ``mask_cte`` reproduces
``missing.mask_column`` (k smallest md5(key|column|seed), k = max(1, int(n*rate))).
"""

from __future__ import annotations

from ..sources.tables import ORDER_FACTS_SQL


def md5_sql(keys, *extra, seed=42) -> str:
    parts = [f"CAST({k} AS VARCHAR)" for k in keys] + [f"'{e}'" for e in extra] + [f"'{seed}'"]
    return f"md5(concat_ws('|', {', '.join(parts)}))"


def k_sql(n: str, rate: float) -> str:
    return f"least({n}, greatest(1, CAST(floor({n} * {rate}) AS BIGINT)))"


# events.value masked MCAR at 12 %; was_masked marks the cells
MASKED_EVENTS = f"""
ev_rank AS (
  SELECT event_id, user_id, ts, event_type, value,
         row_number() OVER (ORDER BY {md5_sql(['event_id'], 'value')}) AS _rn,
         count(*) OVER () AS _n
  FROM events),
mev AS (
  SELECT event_id, user_id, ts, event_type,
         CASE WHEN _rn <= {k_sql('_n', 0.12)} THEN NULL ELSE value END AS value,
         _rn <= {k_sql('_n', 0.12)} AS was_masked,
         value AS true_value
  FROM ev_rank)
"""

ORDER_FACTS_CTE = f"of AS ({ORDER_FACTS_SQL})"


def masked_order_facts(cols=("extprice", "qty", "o_totalprice"), rate=0.12) -> str:
    """order_facts with each listed column masked independently (MCAR, ``rate``)."""
    parts = [ORDER_FACTS_CTE]
    ranks = ", ".join(
        f"row_number() OVER (ORDER BY {md5_sql(['o_orderkey'], c)}) AS _r_{c}" for c in cols)
    parts.append(f"ofr AS (SELECT *, {ranks}, count(*) OVER () AS _n FROM of)")
    sel = []
    for c in cols:
        sel.append(f"CASE WHEN _r_{c} <= {k_sql('_n', rate)} THEN NULL ELSE {c} END AS {c}")
    keep = [x for x in ("o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus",
                        "c_mktsegment", "o_totalprice", "n_lines", "qty", "extprice", "avg_disc")
            if x not in cols]
    parts.append(f"mof AS (SELECT {', '.join(keep + sel)} FROM ofr)")
    return ",\n".join(parts)


def _w(part, order, frame=None):
    p = f"PARTITION BY {', '.join(part)} " if part else ""
    f = f" {frame}" if frame else ""
    return f"OVER ({p}ORDER BY {', '.join(order)}{f})"


BACK = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
FWD = "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
SBACK = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
SFWD = "ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING"


def _med(src, c):
    return f"(SELECT quantile_cont({c}, 0.5) FROM {src})"


def _linear_case(c, sfx):
    return (f"CASE WHEN {c} IS NOT NULL THEN {c} "
            f"WHEN pi{sfx} IS NOT NULL AND ni{sfx} IS NOT NULL AND ni{sfx} <> pi{sfx} "
            f"THEN pv{sfx} + (nv{sfx} - pv{sfx}) * (i - pi{sfx}) / (ni{sfx} - pi{sfx}) "
            f"WHEN pi{sfx} IS NOT NULL THEN pv{sfx} ELSE nv{sfx} END")


def _quad(x, a, b, c):
    (x0, y0), (x1, y1), (x2, y2) = a, b, c
    return (f"({y0} * ({x} - {x1}) * ({x} - {x2}) / (({x0} - {x1}) * ({x0} - {x2}))"
            f" + {y1} * ({x} - {x0}) * ({x} - {x2}) / (({x1} - {x0}) * ({x1} - {x2}))"
            f" + {y2} * ({x} - {x0}) * ({x} - {x1}) / (({x2} - {x0}) * ({x2} - {x1})))")


def repair_sql(method: str, src: str, cols, part, order, key) -> str:
    """A SELECT over CTE ``src`` returning ``key`` + repaired ``cols`` (DuckDB).

    Mirrors ``operators.impute`` for the SQL-expressible methods.
    """
    key = list(key)
    fb = {c: f"coalesce(%s, {_med(src, c)}, 0.0)" for c in cols}
    if method == "Mean":
        sel = [fb[c] % f"coalesce({c}, (SELECT avg({c}) FROM {src}))" + f" AS {c}" for c in cols]
        return f"SELECT {', '.join(key + sel)} FROM {src}"
    if method == "Median":
        return f"SELECT {', '.join(key + [fb[c] % c + f' AS {c}' for c in cols])} FROM {src}"
    if method == "Mode":
        sel = [fb[c] % (f"coalesce({c}, (SELECT {c} FROM {src} WHERE {c} IS NOT NULL "
                        f"GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1))") + f" AS {c}"
               for c in cols]
        return f"SELECT {', '.join(key + sel)} FROM {src}"
    if method == "Forward Fill":
        sel = [fb[c] % f"last_value({c} IGNORE NULLS) {_w(part, order, BACK)}" + f" AS {c}"
               for c in cols]
        return f"SELECT {', '.join(key + sel)} FROM {src}"
    if method == "Backward Fill":
        sel = [fb[c] % f"first_value({c} IGNORE NULLS) {_w(part, order, FWD)}" + f" AS {c}"
               for c in cols]
        return f"SELECT {', '.join(key + sel)} FROM {src}"
    # interpolation: position + neighbours per column
    nb = []
    for j, c in enumerate(cols):
        kn = f"CASE WHEN {c} IS NOT NULL THEN i END"
        nb += [f"last_value({kn} IGNORE NULLS) {_w(part, order, BACK)} AS pi{j}",
               f"last_value({c} IGNORE NULLS) {_w(part, order, BACK)} AS pv{j}",
               f"first_value({kn} IGNORE NULLS) {_w(part, order, FWD)} AS ni{j}",
               f"first_value({c} IGNORE NULLS) {_w(part, order, FWD)} AS nv{j}",
               f"last_value({kn} IGNORE NULLS) {_w(part, order, SBACK)} AS bi{j}",
               f"last_value({c} IGNORE NULLS) {_w(part, order, SBACK)} AS bv{j}",
               f"first_value({kn} IGNORE NULLS) {_w(part, order, SFWD)} AS ai{j}",
               f"first_value({c} IGNORE NULLS) {_w(part, order, SFWD)} AS av{j}"]
    posq = f"SELECT *, row_number() {_w(part, order)} AS i FROM {src}"
    nbq = f"SELECT *, {', '.join(nb)} FROM ({posq})"
    if method == "Linear Interpolation":
        sel = [fb[c] % _linear_case(c, j) + f" AS {c}" for j, c in enumerate(cols)]
        return f"SELECT {', '.join(key + sel)} FROM ({nbq})"
    if method == "Polynomial Interpolation":
        nb2 = []
        for j, c in enumerate(cols):
            nb2 += [f"last_value(CASE WHEN {c} IS NOT NULL THEN bi{j} END IGNORE NULLS) "
                    f"{_w(part, order, BACK)} AS ppi{j}",
                    f"last_value(CASE WHEN {c} IS NOT NULL THEN bv{j} END IGNORE NULLS) "
                    f"{_w(part, order, BACK)} AS ppv{j}",
                    f"first_value(CASE WHEN {c} IS NOT NULL THEN ai{j} END IGNORE NULLS) "
                    f"{_w(part, order, FWD)} AS nni{j}",
                    f"first_value(CASE WHEN {c} IS NOT NULL THEN av{j} END IGNORE NULLS) "
                    f"{_w(part, order, FWD)} AS nnv{j}"]
        nb2q = f"SELECT *, {', '.join(nb2)} FROM ({nbq})"
        sel = []
        x = "CAST(i AS DOUBLE)"
        for j, c in enumerate(cols):
            inside = f"pi{j} IS NOT NULL AND ni{j} IS NOT NULL"
            left = _quad(x, (f"ppi{j}", f"ppv{j}"), (f"pi{j}", f"pv{j}"), (f"ni{j}", f"nv{j}"))
            right = _quad(x, (f"pi{j}", f"pv{j}"), (f"ni{j}", f"nv{j}"), (f"nni{j}", f"nnv{j}"))
            e = (f"CASE WHEN {c} IS NOT NULL THEN {c} "
                 f"WHEN {inside} AND ppi{j} IS NOT NULL THEN {left} "
                 f"WHEN {inside} AND nni{j} IS NOT NULL THEN {right} "
                 f"WHEN {inside} THEN {_linear_case(c, j)} END")
            sel.append(fb[c] % e + f" AS {c}")
        return f"SELECT {', '.join(key + sel)} FROM ({nb2q})"
    raise ValueError(f"no SQL form for {method}")


SQL_METHODS = ["Mean", "Median", "Mode", "Forward Fill", "Backward Fill",
               "Linear Interpolation", "Polynomial Interpolation"]


def benchmark_sql(cols, part, order, key=("o_orderkey",), methods=SQL_METHODS,
                  rate=0.12) -> str:
    """CTEs up to ``metrics`` for the order_facts benchmark (masks, repairs, scores)."""
    key = list(key)
    longs = " UNION ALL ".join(
        f"SELECT {', '.join(key)}, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM of "
        f"WHERE {c} IS NOT NULL" for c in cols)
    ctes = [f"of AS ({ORDER_FACTS_SQL})",
            f"lg AS ({longs})",
            f"rk AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY "
            f"{md5_sql(key + ['feature'])}) AS r, count(*) OVER (PARTITION BY feature) AS n "
            f"FROM lg)",
            f"masks AS (SELECT {', '.join(key)}, feature, value FROM rk "
            f"WHERE n >= 2 AND r <= {k_sql('n', rate)})",
            "mflags AS (SELECT " + ", ".join(key) + ", " + ", ".join(
                f"bool_or(feature = '{c}') AS m_{c}" for c in cols) +
            " FROM masks GROUP BY " + ", ".join(key) + ")",
            "mw AS (SELECT of.* REPLACE (" + ", ".join(
                f"CASE WHEN coalesce(m_{c}, false) THEN NULL ELSE {c} END AS {c}" for c in cols) +
            ") FROM of LEFT JOIN mflags USING (" + ", ".join(key) + "))"]
    preds = []
    for m in methods:
        name = "rep_" + m.lower().replace(" ", "_").replace("(", "").replace(")", "")
        ctes.append(f"{name} AS ({repair_sql(m, 'mw', cols, part, order, key)})")
        for c in cols:
            preds.append(f"SELECT '{m}' AS method, {', '.join(key)}, '{c}' AS feature, "
                         f"{c} AS predicted FROM {name}")
    ctes.append(f"preds AS ({' UNION ALL '.join(preds)})")
    ctes.append("pairs AS (SELECT p.method, p.feature, " + ", ".join(f"p.{k}" for k in key) +
                ", m.value AS actual, p.predicted FROM preds p JOIN masks m USING (" +
                ", ".join(key) + ", feature))")
    ctes.append("srt AS (SELECT feature, method, actual, predicted, "
                "row_number() OVER (PARTITION BY feature, method ORDER BY actual) AS ra, "
                "row_number() OVER (PARTITION BY feature, method ORDER BY predicted) AS rp "
                "FROM pairs)")
    ctes.append("drift AS (SELECT a.feature, a.method, avg(abs(a.actual - p.predicted)) "
                "AS distribution_drift FROM srt a JOIN srt p ON a.feature = p.feature AND "
                "a.method = p.method AND a.ra = p.rp GROUP BY a.feature, a.method)")
    ctes.append("metrics AS (SELECT feature, method, "
                "sqrt(avg((predicted - actual) * (predicted - actual))) AS rmse, "
                "avg(abs(predicted - actual)) AS mae, avg(predicted - actual) AS bias, "
                "abs(avg(predicted - actual)) AS absolute_bias, var_pop(predicted) AS variance, "
                "CAST(count(*) AS BIGINT) AS masked_values FROM pairs GROUP BY feature, method)")
    ctes.append("metrics2 AS (SELECT m.*, d.distribution_drift FROM metrics m LEFT JOIN drift d "
                "USING (feature, method))")
    return "WITH " + ",\n".join(ctes)
