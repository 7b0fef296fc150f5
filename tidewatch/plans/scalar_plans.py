"""Registered scalar-function plans and their SQL twins."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tidewatch.functions import scalar as sc
from tidewatch.operators.cohorts import encode_binary
from tidewatch.plans import fixtures as fx
from tidewatch.plans.registry import register
from tidewatch.sources.tables import read_table


# ------------------------------------------------------------------ B1
@register("encode_binary", """
SELECT l_returnflag, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS encoded, count(*) AS n
FROM lineitem GROUP BY 1, 2""")
def q_encode_binary(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_returnflag"])
    return (li.select("l_returnflag", encode_binary("l_returnflag", "R", "A").alias("encoded"))
            .groupBy("l_returnflag", "encoded").agg(F.count("*").alias("n")))


# ------------------------------------------------------------------ B7 / B8
@register("clip_round", """
SELECT CASE WHEN x IS NOT NULL THEN greatest(least(round_even(x, 0), 80.0), 5.0) END AS value, count(*) AS n
FROM (SELECT l_extendedprice / 1000.0 AS x FROM lineitem) GROUP BY 1""")
def q_clip_round(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_extendedprice"])
    v = sc.clip(sc.round_half_even(F.col("l_extendedprice") / 1000.0), 5.0, 80.0)
    return li.select(v.alias("value")).groupBy("value").agg(F.count("*").alias("n"))


# ------------------------------------------------------------------ B11
VALID_PRIORITIES = ("1-URGENT", "2-HIGH")


@register("domain_repair", f"""
SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority
            ELSE ['1-URGENT', '2-HIGH'][CAST(least(floor({sc.uniform_sql('o_orderkey', 'repair')} * 2), 1) AS INTEGER) + 1]
       END AS o_orderpriority, count(*) AS n
FROM orders GROUP BY 1""")
def q_domain_repair(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderpriority"])
    rep = sc.domain_repair("o_orderpriority", VALID_PRIORITIES, F.col("o_orderkey"))
    return o.select(rep.alias("o_orderpriority")).groupBy("o_orderpriority").agg(F.count("*").alias("n"))


# ------------------------------------------------------------------ B12
@register("label_encode", """
SELECT o_orderpriority AS label, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS DOUBLE) AS label_index,
  count(*) AS n
FROM orders GROUP BY o_orderpriority""")
def q_label_encode(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderpriority"])
    model = StringIndexer(inputCol="o_orderpriority", outputCol="label_index",
                          stringOrderType="alphabetAsc").fit(o)
    return (model.transform(o).groupBy(F.col("o_orderpriority").alias("label"), "label_index")
            .agg(F.count("*").alias("n")))


# ------------------------------------------------------------------ B15 / B16
@register("format_scores", f"WITH {fx.S_SQL}" + """
SELECT doc_id, score, printf('%.2f%%', score * 100.0) AS score_pct,
  repeat('█', CAST(floor(score * 20) AS INTEGER)) || repeat('░', 20 - CAST(floor(score * 20) AS INTEGER)) AS bar
FROM s""")
def q_format_scores(spark, sf):
    s = fx.scored_documents(spark, sf)
    return s.select("doc_id", "score", sc.percent("score").alias("score_pct"), sc.text_bar("score").alias("bar"))


# ------------------------------------------------------------------ B17
@register("ts_format", """
SELECT event_id, strftime(ts, '%m-%d %H:%M') AS ts_label, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso_ts,
  strptime(strftime(ts, '%Y-%m-%dT%H:%M:%S'), '%Y-%m-%dT%H:%M:%S') AS parsed_ts,
  CAST(date_diff('second', ts, TIMESTAMP '2024-02-01 00:00:00') AS BIGINT) AS age_seconds
FROM events""")
def q_ts_format(spark, sf):
    e = read_table(spark, sf, "events", ["event_id", "ts"])
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    age = (F.unix_timestamp(F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").cast("timestamp"))
           - F.unix_timestamp(F.date_trunc("second", F.col("ts").cast("timestamp"))))
    return e.select("event_id", F.date_format("ts", "MM-dd HH:mm").alias("ts_label"), iso.alias("iso_ts"),
                    F.to_timestamp_ntz(iso, F.lit("yyyy-MM-dd'T'HH:mm:ss")).alias("parsed_ts"),
                    age.cast("bigint").alias("age_seconds"))
