"""Test cohorts built from the driver tables (see FIXTURES.md §3).

Each builder returns a cohort-tagged DataFrame plus the matching SQL CTE so
the Spark plan and its DuckDB twin read exactly the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.cohorts import split_cohorts
from tidewatch.sources.tables import read_table
from tidewatch.spec import FeatureSpec

# cohort cut points (fixed values)
L_CUT = "1998-01-01 00:00:00"
E_CUT = "2024-01-16 00:00:00"
O_CUT = "1998-01-01 00:00:00"

L_NUM = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
L_CAT = ("l_returnflag", "l_linestatus")
E_NUM = ("value", "k")
E_CAT = ("event_type",)
O_NUM = ("o_totalprice",)
O_CAT = ("o_orderstatus", "o_orderpriority")

L_SPEC = FeatureSpec(numerical=L_NUM, categorical=L_CAT)
E_SPEC = FeatureSpec(numerical=E_NUM, categorical=E_CAT)
O_SPEC = FeatureSpec(numerical=O_NUM, categorical=O_CAT)

# unique row key of lineitem (FIXTURES.md §2): six columns, all kept integral
L_KEY_SQL = ("CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_partkey AS VARCHAR) || '|' || "
             "CAST(l_suppkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) || '|' || "
             "CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) || '|' || "
             "CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS VARCHAR)")


def ntz(ts: str):
    return F.expr(f"TIMESTAMP_NTZ '{ts}'")


def lineitem_key() -> "F.Column":
    return F.concat_ws(
        "|", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"),
        F.col("l_suppkey").cast("string"), F.col("l_linenumber").cast("string"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string"),
        F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("string"))


def lineitem_cohorts(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    cols = list(dict.fromkeys(("l_shipdate", *L_NUM, *L_CAT, *extra)))
    df = read_table(spark, sf_dir, "lineitem", cols)
    return split_cohorts(df, F.col("l_shipdate") < ntz(L_CUT))


L_SQL = f"""l AS (
  SELECT CASE WHEN l_shipdate < TIMESTAMP '{L_CUT}' THEN 'ref' ELSE 'cur' END AS cohort, *
  FROM lineitem)"""


def events_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    df = df.withColumn("k", F.get_json_object("props", "$.k").try_cast("double"))
    return split_cohorts(df, F.col("ts") < ntz(E_CUT))


E_SQL = f"""e AS (
  SELECT CASE WHEN ts < TIMESTAMP '{E_CUT}' THEN 'ref' ELSE 'cur' END AS cohort,
         event_id, ts, user_id, event_type, value,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
  FROM events)"""


def orders_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate", *O_NUM, *O_CAT])
    return split_cohorts(df, F.col("o_orderdate") < ntz(O_CUT))


O_SQL = f"""o AS (
  SELECT CASE WHEN o_orderdate < TIMESTAMP '{O_CUT}' THEN 'ref' ELSE 'cur' END AS cohort, *
  FROM orders)"""


def long_sql(src: str, features: tuple[str, ...], as_string: bool = False, keys: tuple[str, ...] = ()) -> str:
    """UNION ALL unpivot of ``features`` from CTE ``src``."""
    typ = "VARCHAR" if as_string else "DOUBLE"
    kc = "".join(f"{k}, " for k in keys)
    return "\n  UNION ALL ".join(
        f"SELECT {kc}cohort, '{f}' AS feature, CAST({f} AS {typ}) AS value FROM {src}" for f in features)


def lineitem_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L-empty-set: nullif(l_tax, 0), linestatus encoded O->1, F->0, and a
    feature that is NULL for every current row (``l_discount_ref_only``)."""
    df = lineitem_cohorts(spark, sf_dir)
    return (df.withColumn("l_tax", F.when(F.col("l_tax") != 0, F.col("l_tax")))
            .withColumn("l_linestatus_bin", F.when(F.col("l_linestatus") == "O", 1)
                        .when(F.col("l_linestatus") == "F", 0))
            .withColumn("l_discount_ref_only", F.when(F.col("cohort") == "ref", F.col("l_discount"))))


LN_SQL = L_SQL + """,
ln AS (
  SELECT cohort, l_quantity, l_extendedprice, nullif(l_tax, 0) AS l_tax,
         CASE l_linestatus WHEN 'O' THEN 1 WHEN 'F' THEN 0 END AS l_linestatus_bin,
         CASE WHEN cohort = 'ref' THEN l_discount END AS l_discount_ref_only
  FROM l)"""


# ------------------------------------------------------------------ H: daily history per event type
H_START = "2024-01-01"


def history_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (event_type, day): the drift-history shape, derived from events."""
    from pyspark.sql import Window

    from tidewatch.operators.history import drift_type_for

    e = read_table(spark, sf_dir, "events", ["ts", "event_type"])
    d = (e.groupBy("event_type", F.datediff(F.col("ts").cast("date"), F.lit(H_START).cast("date")).alias("cycle"))
         .agg(F.count("*").alias("new_samples"), F.min("ts").alias("timestamp")))
    w = Window.partitionBy("event_type").orderBy("cycle").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (d.withColumn("data_size", F.sum("new_samples").over(w))
            .withColumn("total_size", F.col("data_size"))
            .withColumn("drift_type", drift_type_for(F.col("cycle"))))


H_SQL = f"""h0 AS (
  SELECT event_type, CAST(date_diff('day', DATE '{H_START}', CAST(ts AS DATE)) AS INTEGER) AS cycle,
         count(*) AS new_samples, min(ts) AS timestamp
  FROM events GROUP BY 1, 2),
h AS (
  SELECT *, CAST(sum(new_samples) OVER (PARTITION BY event_type ORDER BY cycle
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS data_size,
         ['input_drift', 'label_drift', 'concept_drift', 'combined_drift'][(cycle % 4) + 1] AS drift_type
  FROM h0)"""


# ------------------------------------------------------------------ S: scored documents (evaluation)
def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents joined to labels; score = n_chars / (n_chars + 1500) at 4 dp,
    label = quality, pred = score >= 0.5."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "n_chars"])
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    j = d.join(lab, "doc_id")
    score = F.round(F.col("n_chars") / (F.col("n_chars") + 1500.0), 4)
    return j.select("doc_id", F.col("quality").alias("label"), score.alias("score"),
                    (score >= 0.5).cast("int").alias("pred"))


S_SQL = """s AS (
  SELECT d.doc_id, lab.quality AS label, round(d.n_chars / (d.n_chars + 1500.0), 4) AS score,
         CAST(round(d.n_chars / (d.n_chars + 1500.0), 4) >= 0.5 AS INTEGER) AS pred
  FROM documents d JOIN labels lab ON d.doc_id = lab.doc_id)"""


# ------------------------------------------------------------------ M: one row per order (classifier table)
M_NUM = ("n_lines", "qty_band", "discount_pct", "tax_pct", "price_band")
M_CAT = ("urgent", "fulfilled")
M_TARGET = "segment"
M_CLASSES = ("busy", "quiet")
M_SPEC = FeatureSpec(numerical=M_NUM, categorical=M_CAT, target=M_TARGET)
M_FLIP_RATE = 0.08


def model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders joined to per-order lineitem aggregates. Features are small
    integer scales; Yes/No flags; label 'busy' when n_lines + qty_band/2 >= 7,
    with about 8% of labels flipped by a hash of the order key (known signal)."""
    from tidewatch.functions.scalar import uniform

    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_quantity", "l_discount", "l_tax"])
    agg = li.groupBy("l_orderkey").agg(F.count("*").alias("n_lines"), F.avg("l_quantity").alias("_q"),
                                       F.avg("l_discount").alias("_d"), F.avg("l_tax").alias("_t"))
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus",
                                             "o_orderpriority"])
    m = o.join(agg, o.o_orderkey == agg.l_orderkey)
    rule = (F.col("n_lines") + F.col("qty_band") / 2) >= 7
    flip = uniform(F.col("o_orderkey"), "label") < M_FLIP_RATE
    return (m.select("o_orderkey", "o_orderdate",
                     F.col("n_lines").cast("double").alias("n_lines"),
                     F.rint(F.col("_q") / 5).alias("qty_band"),
                     F.rint(F.col("_d") * 100).alias("discount_pct"),
                     F.rint(F.col("_t") * 100).alias("tax_pct"),
                     F.rint(F.col("o_totalprice") / 50000).alias("price_band"),
                     F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Yes").otherwise("No").alias("urgent"),
                     F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("No").alias("fulfilled"))
            .withColumn(M_TARGET, F.when(rule != flip, "busy").otherwise("quiet")))


def model_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_cohorts(model_table(spark, sf_dir), F.col("o_orderdate") < ntz(O_CUT))


def _m_sql() -> str:
    from tidewatch.functions.scalar import uniform_sql

    return f"""m0 AS (
  SELECT l_orderkey, count(*) AS n_lines, avg(l_quantity) AS q_, avg(l_discount) AS d_, avg(l_tax) AS t_
  FROM lineitem GROUP BY l_orderkey),
m1 AS (
  SELECT o.o_orderkey, o.o_orderdate, CAST(m0.n_lines AS DOUBLE) AS n_lines, round_even(m0.q_ / 5, 0) AS qty_band,
    round_even(m0.d_ * 100, 0) AS discount_pct, round_even(m0.t_ * 100, 0) AS tax_pct,
    round_even(o.o_totalprice / 50000, 0) AS price_band,
    CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Yes' ELSE 'No' END AS urgent,
    CASE WHEN o.o_orderstatus = 'F' THEN 'Yes' ELSE 'No' END AS fulfilled,
    {uniform_sql('o.o_orderkey', 'label')} < {M_FLIP_RATE} AS flip_
  FROM orders o JOIN m0 ON o.o_orderkey = m0.l_orderkey),
m AS (
  SELECT o_orderkey, o_orderdate, n_lines, qty_band, discount_pct, tax_pct, price_band, urgent, fulfilled,
    CASE WHEN ((n_lines + qty_band / 2) >= 7) <> flip_ THEN 'busy' ELSE 'quiet' END AS segment,
    CASE WHEN o_orderdate < TIMESTAMP '{O_CUT}' THEN 'ref' ELSE 'cur' END AS cohort
  FROM m1)"""


M_SQL = _m_sql()
