"""Reusable SQL fragments for the DuckDB twins of the drift plans.

The twins compute every statistic the textbook way (plain windows over the
whole feature, exact ``median``) so they are an independent check of the
bucketed Spark plans.
"""

from __future__ import annotations


def _kc(keys: tuple[str, ...]) -> str:
    return "".join(f"{k}, " for k in keys)


def _kon(keys: tuple[str, ...], a: str, b: str) -> str:
    return "".join(f"{a}.{k} = {b}.{k} AND " for k in keys)


def numeric_ctes(lg: str, keys: tuple[str, ...] = ()) -> str:
    """CTEs m (moments), ks (D, W, range), lev (Levene W) over long CTE ``lg``."""
    kc = _kc(keys)
    kp = ", ".join([*keys, "feature"])
    return f"""
m AS (
  SELECT {kc}feature,
    count(value) FILTER (WHERE cohort = 'ref') AS n_ref,
    count(value) FILTER (WHERE cohort = 'cur') AS n_cur,
    avg(value) FILTER (WHERE cohort = 'ref') AS mean_ref,
    avg(value) FILTER (WHERE cohort = 'cur') AS mean_cur,
    var_samp(value) FILTER (WHERE cohort = 'ref') AS var_ref,
    var_samp(value) FILTER (WHERE cohort = 'cur') AS var_cur,
    min(value) AS min_value, max(value) AS max_value
  FROM {lg} GROUP BY {kp}),
mm AS (
  SELECT *,
    sqrt(((n_ref - 1) * var_ref + (n_cur - 1) * var_cur) / (n_ref + n_cur - 2)) AS pooled_sd,
    (mean_ref - mean_cur) / sqrt(var_ref / n_ref + var_cur / n_cur) AS t_statistic,
    power(var_ref / n_ref + var_cur / n_cur, 2)
      / (power(var_ref / n_ref, 2) / (n_ref - 1) + power(var_cur / n_cur, 2) / (n_cur - 1)) AS t_df
  FROM m),
md AS (
  SELECT *, CASE WHEN pooled_sd = 0 THEN 0 ELSE (mean_cur - mean_ref) / pooled_sd END AS cohens_d FROM mm),
dv AS (
  SELECT {kc}feature, value,
    count(*) FILTER (WHERE cohort = 'ref') AS c_ref,
    count(*) FILTER (WHERE cohort = 'cur') AS c_cur
  FROM {lg} WHERE value IS NOT NULL GROUP BY {kp}, value),
ec AS (
  SELECT {kc}feature, value,
    sum(c_ref) OVER w AS cum_ref, sum(c_cur) OVER w AS cum_cur,
    lead(value) OVER (PARTITION BY {kp} ORDER BY value) AS next_value
  FROM dv
  WINDOW w AS (PARTITION BY {kp} ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ks AS (
  SELECT {_qual(keys, 'ec')}ec.feature,
    max(abs(cum_ref / md.n_ref - cum_cur / md.n_cur)) AS ks_statistic,
    coalesce(sum(abs(cum_ref / md.n_ref - cum_cur / md.n_cur) * (next_value - value)), 0) AS wasserstein_distance
  FROM ec JOIN md ON {_kon(keys, 'ec', 'md')}ec.feature = md.feature
  WHERE md.n_ref > 0 AND md.n_cur > 0
  GROUP BY {_qual(keys, 'ec')}ec.feature),
med AS (
  SELECT {kc}feature,
    median(value) FILTER (WHERE cohort = 'ref') AS median_ref,
    median(value) FILTER (WHERE cohort = 'cur') AS median_cur
  FROM {lg} WHERE value IS NOT NULL GROUP BY {kp}),
z AS (
  SELECT {_qual(keys, 'g')}g.feature, g.cohort,
    abs(g.value - CASE WHEN g.cohort = 'ref' THEN med.median_ref ELSE med.median_cur END) AS z
  FROM {lg} g JOIN med ON {_kon(keys, 'g', 'med')}g.feature = med.feature
  WHERE g.value IS NOT NULL),
zg AS (SELECT {kc}feature, cohort, count(*) AS n, avg(z) AS zbar, sum(z) AS sz FROM z GROUP BY {kp}, cohort),
zw AS (
  SELECT {_qual(keys, 'z')}z.feature, sum(power(z.z - zg.zbar, 2)) AS ssw
  FROM z JOIN zg ON {_kon(keys, 'z', 'zg')}z.feature = zg.feature AND z.cohort = zg.cohort
  GROUP BY {_qual(keys, 'z')}z.feature),
zt AS (SELECT {kc}feature, sum(n) AS ntot, sum(sz) / sum(n) AS zall FROM zg GROUP BY {kp}),
zb AS (
  SELECT {_qual(keys, 'zg')}zg.feature, sum(zg.n * power(zg.zbar - zt.zall, 2)) AS ssb
  FROM zg JOIN zt ON {_kon(keys, 'zg', 'zt')}zg.feature = zt.feature
  GROUP BY {_qual(keys, 'zg')}zg.feature),
lev AS (
  SELECT {_qual(keys, 'zt')}zt.feature, med.median_ref, med.median_cur,
    (zt.ntot - 2) * zb.ssb / zw.ssw AS levene_statistic
  FROM zt JOIN zb ON {_kon(keys, 'zt', 'zb')}zt.feature = zb.feature
  JOIN zw ON {_kon(keys, 'zt', 'zw')}zt.feature = zw.feature
  JOIN med ON {_kon(keys, 'zt', 'med')}zt.feature = med.feature
  WHERE zt.ntot > 2),
num AS (
  SELECT md.*, ks.ks_statistic, ks.wasserstein_distance,
    CASE WHEN md.max_value - md.min_value > 0 THEN ks.wasserstein_distance / (md.max_value - md.min_value)
         ELSE 0 END AS normalized_distance,
    lev.median_ref, lev.median_cur, lev.levene_statistic
  FROM md LEFT JOIN ks ON {_kon(keys, 'md', 'ks')}md.feature = ks.feature
  LEFT JOIN lev ON {_kon(keys, 'md', 'lev')}md.feature = lev.feature)"""


def _qual(keys: tuple[str, ...], alias: str) -> str:
    return "".join(f"{alias}.{k}, " for k in keys)


def categorical_ctes(lg: str, keys: tuple[str, ...] = (), low: int = 5) -> str:
    """CTEs cc (aligned counts), ct (totals), cat (chi2, psi, fallback inputs)."""
    kc = _kc(keys)
    kp = ", ".join([*keys, "feature"])
    return f"""
cc AS (
  SELECT {kc}feature, value AS category,
    count(*) FILTER (WHERE cohort = 'ref') AS c_ref,
    count(*) FILTER (WHERE cohort = 'cur') AS c_cur
  FROM {lg} GROUP BY {kp}, value),
ct AS (
  SELECT {kc}feature,
    CAST(coalesce(sum(c_ref) FILTER (WHERE category IS NOT NULL), 0) AS BIGINT) AS n_ref,
    CAST(coalesce(sum(c_cur) FILTER (WHERE category IS NOT NULL), 0) AS BIGINT) AS n_cur,
    count(category) AS n_categories,
    coalesce(bool_or(c_ref < {low} OR c_cur < {low}) FILTER (WHERE category IS NOT NULL), false) AS low_count
  FROM cc GROUP BY {kp}),
cj AS (
  SELECT cc.*, ct.n_ref, ct.n_cur, ct.n_categories,
    cc.c_ref / ct.n_ref AS p_ref, cc.c_cur / ct.n_cur AS p_cur,
    ct.n_ref * (cc.c_ref + cc.c_cur) / (ct.n_ref + ct.n_cur) AS e_ref,
    ct.n_cur * (cc.c_ref + cc.c_cur) / (ct.n_ref + ct.n_cur) AS e_cur
  FROM cc JOIN ct ON {_kon(keys, 'cc', 'ct')}cc.feature = ct.feature
  WHERE cc.category IS NOT NULL),
cs AS (
  SELECT {kc}feature,
    sum(CASE WHEN n_categories = 2
             THEN power(greatest(abs(c_ref - e_ref) - 0.5, 0), 2) / e_ref
                + power(greatest(abs(c_cur - e_cur) - 0.5, 0), 2) / e_cur
             ELSE power(c_ref - e_ref, 2) / e_ref + power(c_cur - e_cur, 2) / e_cur END) AS chi2_statistic,
    abs(sum((CASE WHEN p_cur = 0 THEN 1e-7 ELSE p_cur END - CASE WHEN p_ref = 0 THEN 1e-7 ELSE p_ref END)
        * ln(CASE WHEN p_cur = 0 THEN 1e-7 ELSE p_cur END / CASE WHEN p_ref = 0 THEN 1e-7 ELSE p_ref END))) AS psi,
    max(abs(p_ref - p_cur)) AS max_proportion_difference
  FROM cj GROUP BY {kp}),
cat AS (
  SELECT ct.*, CAST(ct.n_categories - 1 AS INTEGER) AS chi2_dof, cs.chi2_statistic, cs.psi,
    cs.max_proportion_difference
  FROM ct LEFT JOIN cs ON {_kon(keys, 'ct', 'cs')}ct.feature = cs.feature)"""


def effect_verdict_sql(alias: str = "num") -> str:
    """Effect-only numeric flags (no p-values): |d| > .1 or normalised distance > .05."""
    return (f"(coalesce(abs({alias}.cohens_d) > 0.1, false) OR coalesce({alias}.normalized_distance > 0.05, false))")


def sev_effect_sql(alias: str = "num") -> str:
    d = f"abs({alias}.cohens_d)"
    return (f"CASE WHEN coalesce({d} > 0.5, false) THEN 'HIGH' WHEN coalesce({d} > 0.3, false) THEN 'MEDIUM' "
            f"WHEN coalesce({d} > 0.1, false) THEN 'LOW' ELSE 'NONE' END")
