"""Registered resampling / drift-injection plans on fixtures M and L*."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidewatch.functions.scalar import normal_sql, uniform_sql
from tidewatch.operators import drift, inject
from tidewatch.operators.cohorts import encode_binary, to_long
from tidewatch.operators.generator import Generator, Recipe
from tidewatch.plans import fixtures as fx
from tidewatch.plans.registry import r, register
from tidewatch.plans.sqlparts import effect_verdict_sql, numeric_ctes
from tidewatch.session import cut_lineage, ensure_checkpoint_dir
from tidewatch.sources.versions import VersionedTables
from tidewatch.spec import DriftThresholds

# input-shift multipliers of the reference (fixed values, in its feature
# order), mapped onto the M features in order
M_SHIFTS = {"n_lines": 1.5, "qty_band": -1.2, "discount_pct": 0.8, "tax_pct": 1.0, "price_band": 0.6}
# the same multipliers on L, in baseline-sd units (L*)
L_SHIFTS = {"l_quantity": 1.5, "l_extendedprice": -1.2, "l_discount": 0.8, "l_tax": 1.0}
L_STAR_STRENGTH = 0.3
SRC, DST = "quiet", "busy"
UP, DOWN = "n_lines", "qty_band"


def _m(spark, sf):
    return fx.model_cohorts(spark, sf)


def _ref_base(m):
    return inject.wide_stats(m.where(F.col("cohort") == "ref"), fx.M_NUM, "b")


# ------------------------------------------------------------------ SQL helpers
def _base_sql(src: str, features, name: str = "b", where: str = "cohort = 'ref'") -> str:
    cols = ", ".join(f"min({f}) AS {name}_{f}_min, max({f}) AS {name}_{f}_max, stddev_samp({f}) AS {name}_{f}_std"
                     for f in features)
    return f"{name} AS (SELECT {cols} FROM {src} WHERE {where})"


def _clip_round(expr: str, lo: str, hi: str, rnd: bool = True) -> str:
    c = f"greatest(least({expr}, {hi}), {lo})"
    return f"round_even({c}, 0)" if rnd else c


def _jitter_cols(features, key: str, salt: str = "jitter") -> str:
    out = []
    for f in features:
        noisy = f"{f} + {normal_sql(key, f'{salt}|{f}', '0.0', f's_{f}_std * 0.1')}"
        out.append(f"CASE WHEN {f} IS NOT NULL THEN "
                   f"{_clip_round(noisy, f'greatest(0.0, b_{f}_min)', f'b_{f}_max')} END AS {f}")
    return ", ".join(out)


def _shift_cols(shifts, strength: float, key: str, sd_units: bool = False, rnd: bool = True,
                salt: str = "shift") -> str:
    out = []
    for f, m in shifts.items():
        u = f"b_{f}_std" if sd_units else "1.0"
        mean = f"({strength!r} * {float(m)!r}) * {u}"
        sd = f"({strength!r} * 0.3) * {u}"
        noisy = f"{f} + {normal_sql(key, f'{salt}|{f}', mean, sd)}"
        out.append(f"CASE WHEN {f} IS NOT NULL THEN {_clip_round(noisy, '0.0', f'b_{f}_max * 1.2', rnd)} END AS {f}")
    return ", ".join(out)


def _others(all_cols, changed) -> str:
    return ", ".join(c for c in all_cols if c not in changed)


M_COLS = ("o_orderkey", "o_orderdate", *fx.M_NUM, *fx.M_CAT, fx.M_TARGET, "cohort")


# ------------------------------------------------------------------ I2
@register("jitter", f"WITH {fx.M_SQL},\n{_base_sql('m', fx.M_NUM)},\n"
          f"{_base_sql('m', fx.M_NUM, 's', 'cohort = ' + chr(39) + 'cur' + chr(39))}" + f"""
SELECT o_orderkey, {_jitter_cols(fx.M_NUM, 'o_orderkey')}
FROM m, b, s WHERE m.cohort = 'cur'""")
def q_jitter(spark, sf):
    m = _m(spark, sf)
    cur = m.where(F.col("cohort") == "cur")
    j = inject.jitter(cur, fx.M_NUM, F.col("o_orderkey"), _ref_base(m))
    return j.select("o_orderkey", *fx.M_NUM)


# ------------------------------------------------------------------ I4 on L*: shifts in baseline-sd units, no rounding
def _lstar(spark, sf):
    l_ = fx.lineitem_cohorts(spark, sf, ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    base = inject.wide_stats(l_.where(F.col("cohort") == "ref"), fx.L_NUM, "b")
    cur = l_.where(F.col("cohort") == "cur").withColumn("_key", fx.lineitem_key())
    shifted = inject.input_shift(cur, L_SHIFTS, L_STAR_STRENGTH, F.col("_key"), base, step=None, sd_units=True)
    return l_.where(F.col("cohort") == "ref").unionByName(shifted.drop("_key"))


LSTAR_SQL = f"{fx.L_SQL},\n{_base_sql('l', fx.L_NUM)}," + f"""
lstar AS (
  SELECT cohort, {', '.join(fx.L_NUM)}, l_returnflag, l_linestatus FROM l WHERE cohort = 'ref'
  UNION ALL
  SELECT cohort, {_shift_cols(L_SHIFTS, L_STAR_STRENGTH, fx.L_KEY_SQL, True, False)}, l_returnflag, l_linestatus
  FROM l, b WHERE cohort = 'cur')"""


@register("input_shift", f"WITH {LSTAR_SQL},\n" + f"""
lg AS ({fx.long_sql('lstar', fx.L_NUM)})
SELECT feature, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
  round(min(value), 6) AS min, round(max(value), 6) AS max
FROM lg WHERE cohort = 'cur' GROUP BY feature""")
def q_input_shift(spark, sf):
    ls = _lstar(spark, sf).where(F.col("cohort") == "cur")
    long = to_long(ls, fx.L_NUM)
    return long.groupBy("feature").agg(F.count("value").alias("n"), r(F.avg("value"), "mean"),
                                       r(F.stddev_samp("value"), "std"), r(F.min("value"), "min"),
                                       r(F.max("value"), "max"))


EFFECT = DriftThresholds(effect_only=True)


@register("shifted_drift_effect", f"WITH {LSTAR_SQL},\n" + f"""lg AS ({fx.long_sql('lstar', fx.L_NUM)}),"""
          + numeric_ctes("lg") + f"""
SELECT feature, {effect_verdict_sql('num')} AS drift_detected, round(cohens_d, 6) AS effect_size,
  round(ks_statistic, 6) AS ks_statistic, round(normalized_distance, 6) AS normalized_distance
FROM num""")
def q_shifted_drift_effect(spark, sf):
    t = drift.numeric_tests(to_long(_lstar(spark, sf), fx.L_NUM), (), len(fx.L_NUM), with_p=False)
    v = drift.numeric_verdict(t, EFFECT)
    return v.select("feature", "drift_detected", r("effect_size"), r("ks_statistic"), r("normalized_distance"))


@register("shifted_drift")
def q_shifted_drift(spark, sf):
    """Full reference rule (p-values included) on L*: the injected drift must be found."""
    feats, ds = drift.detect(_lstar(spark, sf), fx.L_SPEC)
    return ds.select("total_features", "n_drifted_features", "high_severity_features", "severity_level")


# ------------------------------------------------------------------ I5
FLIP_STRENGTH = 0.5


@register("label_flip", f"WITH {fx.M_SQL}," + f"""
q AS (SELECT o_orderkey, {uniform_sql('o_orderkey', 'flip')} AS u FROM m WHERE segment = '{SRC}'),
k AS (SELECT CAST(floor(count(*) * {min(0.3 * FLIP_STRENGTH, 0.4)!r}) AS BIGINT) AS k FROM q),
f AS (SELECT o_orderkey, row_number() OVER (ORDER BY u, o_orderkey) AS rk FROM q)
SELECT m.o_orderkey, CASE WHEN f.rk <= (SELECT k FROM k) THEN '{DST}' ELSE m.segment END AS segment
FROM m LEFT JOIN f ON m.o_orderkey = f.o_orderkey""")
def q_label_flip(spark, sf):
    m = fx.model_table(spark, sf)
    out = inject.label_flip(m, fx.M_TARGET, SRC, DST, FLIP_STRENGTH, "o_orderkey")
    return out.select("o_orderkey", fx.M_TARGET)


# ------------------------------------------------------------------ I6
CONCEPT_STRENGTH = 0.5


def _concept_cols(strength: float, key: str) -> str:
    s = float(strength)
    u = f"{UP} + {normal_sql(key, f'concept|{UP}', repr(3 * s), repr(s))}"
    d = f"{DOWN} + {normal_sql(key, f'concept|{DOWN}', repr(-2.5 * s), repr(0.5 * s))}"
    return (f"CASE WHEN segment = '{SRC}' THEN CASE WHEN {UP} IS NOT NULL THEN {_clip_round(u, '0.0', '11.0')} END "
            f"ELSE {UP} END AS {UP}, "
            f"CASE WHEN segment = '{SRC}' THEN CASE WHEN {DOWN} IS NOT NULL THEN {_clip_round(d, '0.0', '11.0')} END "
            f"ELSE {DOWN} END AS {DOWN}")


@register("concept_shift", f"WITH {fx.M_SQL}" + f"""
SELECT o_orderkey, segment, {_concept_cols(CONCEPT_STRENGTH, 'o_orderkey')} FROM m""")
def q_concept_shift(spark, sf):
    m = fx.model_table(spark, sf)
    out = inject.concept_shift(m, fx.M_TARGET, SRC, CONCEPT_STRENGTH, F.col("o_orderkey"), UP, DOWN)
    return out.select("o_orderkey", fx.M_TARGET, UP, DOWN)


# ------------------------------------------------------------------ I7: input -> flip -> concept at 0.6 s
COMBINED_STRENGTH = 0.5
_CS = COMBINED_STRENGTH * 0.6


@register("combined_shift", f"WITH {fx.M_SQL},\n{_base_sql('m', fx.M_NUM)}," + f"""
c1 AS (
  SELECT {_others(M_COLS, M_SHIFTS)}, {_shift_cols(M_SHIFTS, _CS, 'o_orderkey')}
  FROM m, b WHERE m.cohort = 'cur'),
q AS (SELECT o_orderkey, {uniform_sql('o_orderkey', 'flip')} AS u FROM c1 WHERE segment = '{SRC}'),
k AS (SELECT CAST(floor(count(*) * {min(0.3 * _CS, 0.4)!r}) AS BIGINT) AS k FROM q),
f AS (SELECT o_orderkey, row_number() OVER (ORDER BY u, o_orderkey) AS rk FROM q),
c2 AS (
  SELECT c1.* EXCLUDE (segment), CASE WHEN f.rk <= (SELECT k FROM k) THEN '{DST}' ELSE c1.segment END AS segment
  FROM c1 LEFT JOIN f ON c1.o_orderkey = f.o_orderkey)
SELECT o_orderkey, segment, {', '.join(c for c in fx.M_NUM if c not in (UP, DOWN))},
  {_concept_cols(_CS, 'o_orderkey')}
FROM c2""")
def q_combined_shift(spark, sf):
    m = _m(spark, sf)
    cur = m.where(F.col("cohort") == "cur")
    out = inject.inject(cur, "combined_drift", COMBINED_STRENGTH, "o_orderkey", _ref_base(m), M_SHIFTS,
                        fx.M_TARGET, SRC, DST, UP, DOWN)
    return out.select("o_orderkey", fx.M_TARGET, *fx.M_NUM)


# ------------------------------------------------------------------ I3
VALID = ("busy", "quiet")


@register("repair_rows", f"WITH {fx.M_SQL},\n{_base_sql('m', fx.M_NUM)}," + f"""
bad AS (
  SELECT o_orderkey, {', '.join(f'{f} * 1.5 + 0.4 AS {f}' for f in fx.M_NUM)},
    CASE urgent WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END + 0.6 AS urgent,
    CASE WHEN discount_pct > 8 THEN 'unknown' ELSE segment END AS segment
  FROM m WHERE cohort = 'cur')
SELECT o_orderkey,
  {', '.join(f"CASE WHEN {f} IS NOT NULL THEN greatest(least(round_even({f}, 0), b_{f}_max), greatest(0.0, b_{f}_min)) END AS {f}" for f in fx.M_NUM)},
  CAST(CASE WHEN urgent IS NOT NULL THEN greatest(least(round_even(urgent, 0), 1.0), 0.0) END AS INTEGER) AS urgent,
  CASE WHEN segment IN ('busy', 'quiet') THEN segment
       ELSE ['busy', 'quiet'][CAST(least(floor({uniform_sql('o_orderkey', 'repair')} * 2), 1) AS INTEGER) + 1] END
    AS segment
FROM bad, b""")
def q_repair_rows(spark, sf):
    m = _m(spark, sf)
    cur = m.where(F.col("cohort") == "cur")
    bad = cur.select("o_orderkey", *[(F.col(f) * 1.5 + 0.4).alias(f) for f in fx.M_NUM],
                     (encode_binary("urgent") + 0.6).alias("urgent"),
                     F.when(F.col("discount_pct") > 8, "unknown").otherwise(F.col("segment")).alias("segment"))
    out = inject.repair_rows(bad, fx.M_NUM, ["urgent"], _ref_base(m), fx.M_TARGET, VALID, F.col("o_orderkey"))
    return out.select("o_orderkey", *fx.M_NUM, "urgent", fx.M_TARGET)


# ------------------------------------------------------------------ I1
BOOT_N, BOOT_CYCLE = 500, 3


def _boot_sql(n: int, cycle: int) -> str:
    return f"""r0 AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS idx FROM m WHERE cohort = 'ref'),
nn AS (SELECT count(*) AS nn FROM r0),
d AS (
  SELECT range AS draw,
    CAST(floor({uniform_sql(f"'{cycle}|' || CAST(range AS VARCHAR)", 'boot')} * nn) + 1 AS BIGINT) AS idx
  FROM range({n}), nn),
boot AS (
  SELECT CAST({(cycle + 1) * inject.SEQ_STRIDE} + d.draw AS BIGINT) AS seq, r0.* EXCLUDE (idx)
  FROM d JOIN r0 ON d.idx = r0.idx)"""


@register("bootstrap_exact", f"WITH {fx.M_SQL},\n{_boot_sql(BOOT_N, BOOT_CYCLE)}" + f"""
SELECT seq, o_orderkey, {', '.join(fx.M_NUM)}, segment FROM boot""")
def q_bootstrap_exact(spark, sf):
    ref = _m(spark, sf).where(F.col("cohort") == "ref")
    b = inject.bootstrap_exact(ref, BOOT_N, "o_orderkey", BOOT_CYCLE)
    return b.select("seq", "o_orderkey", *fx.M_NUM, fx.M_TARGET)


_POISSON = inject.poisson_steps(0.5)


@register("bootstrap_poisson", f"""WITH {fx.M_SQL},
d AS (SELECT *, {uniform_sql('o_orderkey', 'poisson')} AS u FROM m WHERE cohort = 'ref')
SELECT {fx.M_TARGET}, CAST(sum({' + '.join(f'CAST(u > {p!r} AS INTEGER)' for p in _POISSON)}) AS BIGINT) AS n
FROM d GROUP BY 1""")
def q_bootstrap_poisson(spark, sf):
    ref = _m(spark, sf).where(F.col("cohort") == "ref")
    return inject.poisson_bootstrap(ref, 0.5, F.col("o_orderkey")).groupBy(fx.M_TARGET).agg(F.count("*").alias("n"))


# ------------------------------------------------------------------ I9: one generator cycle (input_drift cycle)
AUG_CYCLE, AUG_STRENGTH, AUG_N = 4, 0.3, 200
_OUT = ("seq", "o_orderkey", *fx.M_NUM, *fx.M_CAT, fx.M_TARGET)


@register("augment_step", f"WITH {fx.M_SQL},\n{_base_sql('m', fx.M_NUM)},\n{_boot_sql(AUG_N, AUG_CYCLE)}," + f"""
{_base_sql('boot', fx.M_NUM, 's', 'true')},
jit AS (
  SELECT seq, o_orderkey, {_jitter_cols(fx.M_NUM, 'seq')}, urgent, fulfilled, segment FROM boot, b, s),
new AS (
  SELECT seq, o_orderkey, {_shift_cols(M_SHIFTS, AUG_STRENGTH, 'seq')}, urgent, fulfilled, segment FROM jit, b),
cur AS (SELECT CAST(o_orderkey AS BIGINT) AS seq, {', '.join(_OUT[1:])} FROM m WHERE cohort = 'cur'),
kept AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (ORDER BY seq DESC) AS rn FROM cur)
  WHERE rn <= greatest({4000} - (SELECT count(*) FROM new), 0))
SELECT {', '.join(_OUT)} FROM kept
UNION ALL
SELECT {', '.join(_OUT)} FROM new""")
def q_augment_step(spark, sf):
    # the working table feeds the index, bootstrap, baseline and retention branches: write it once
    m = cut_lineage(_m(spark, sf), "generator-input")
    ref = m.where(F.col("cohort") == "ref")
    cur = m.where(F.col("cohort") == "cur").select(F.col("o_orderkey").cast("long").alias("seq"), *_OUT[1:])
    out = inject.augment_step(cur, ref, AUG_CYCLE, AUG_STRENGTH, AUG_N, fx.M_NUM, "o_orderkey", M_SHIFTS,
                              fx.M_TARGET, SRC, DST, UP, DOWN)
    return out.select(*_OUT)


# ------------------------------------------------------------------ I9 / I11: five cycles, each published as a version of its own
GEN_CYCLES = 5


def generator(spark, sf) -> Generator:
    """A generator over M with sizes that follow the reference: the first cycle
    half of its rows, later ones a tenth each, at most three quarters kept."""
    ref = cut_lineage(_m(spark, sf).where(F.col("cohort") == "ref").drop("cohort"), "generator-input")
    n = ref.count()
    recipe = Recipe(fx.M_NUM, "o_orderkey", M_SHIFTS, fx.M_TARGET, SRC, DST, UP, DOWN, n // 2, n // 10, n * 3 // 4)
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidewatch/generator-{uuid.uuid4().hex}"
    made = Generator(VersionedTables(spark, root), recipe)
    made.reset(ref)
    return made


@register("generator_cycles", f"""WITH RECURSIVE {fx.M_SQL},
n AS (SELECT count(*) // 2 AS first_rows, count(*) // 10 AS new_rows, count(*) * 3 // 4 AS cap FROM m WHERE cohort = 'ref'),
c AS (
  SELECT 0 AS cycle, first_rows AS new_samples, first_rows AS total_size, 0.1::DOUBLE AS drift_strength, 0::BIGINT AS failed_detections FROM n
  UNION ALL
  SELECT cycle + 1, new_rows, least(cap, total_size + new_rows), CASE WHEN cycle >= 1 THEN least(drift_strength * 1.2, 0.8) ELSE drift_strength END,
    failed_detections + CASE WHEN cycle >= 1 THEN 1 ELSE 0 END
  FROM c, n WHERE cycle < {GEN_CYCLES - 1})
SELECT CAST(cycle AS INTEGER) AS cycle, ['input_drift', 'label_drift', 'concept_drift', 'combined_drift'][cycle % 4 + 1] AS drift_type,
  CAST(new_samples AS BIGINT) AS new_samples, CAST(total_size AS BIGINT) AS total_size, round(drift_strength, 6) AS drift_strength, failed_detections,
  CASE WHEN cycle > 1 THEN 'not_detected' WHEN cycle = 1 THEN 'unknown' END AS drift_state
FROM c""")
def q_generator_cycles(spark, sf):
    made = generator(spark, sf)
    for _ in range(GEN_CYCLES):
        made.step()
    return made.store.read("history").select(F.col("cycle").cast("int").alias("cycle"), "drift_type", "new_samples", "total_size", r("drift_strength"),
                                             "failed_detections", "drift_state")
