"""Result sinks rendered as rows: text report lines, nested JSON result, long
run log, order-insensitive dataset fingerprint, JSON record parsing.

Reports are built as DataFrames (one row per line / entry) and written with
the ordinary writers, so nothing is assembled on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.small import attach_row, join_small


def py_bool(c: Column) -> Column:
    return F.when(c, F.lit("True")).otherwise(F.lit("False"))


def fmt(c: Column, spec: str, missing: str = "N/A") -> Column:
    return F.when(c.isNotNull(), F.format_string(spec, c)).otherwise(F.lit(missing))


def report_lines(features: DataFrame, dataset: DataFrame, ref_shape: DataFrame) -> DataFrame:
    """(block, line_no, line): a header block 0 and one block per feature
    (ordered by name). ``ref_shape`` has n_ref_rows, n_cur_rows, n_columns."""
    d = attach_row(dataset, ref_shape)
    header = [
        F.lit("Robust Data Drift Detection Summary"), F.lit("=" * 50),
        F.format_string("Reference data shape: (%d, %d)", "n_ref_rows", "n_columns"),
        F.format_string("Current data shape: (%d, %d)", "n_cur_rows", "n_columns"), F.lit(""),
        F.lit("Overall Drift Metrics:"),
        F.format_string("- Number of drifted features: %d", "n_drifted_features"),
        F.concat(F.lit("- Share of drifted features: "),
                 F.format_string("%.2f%%", F.col("share_drifted_features") * 100.0)),
        F.concat(F.lit("- Dataset drift detected: "), py_bool(F.col("dataset_drift"))),
        F.concat(F.lit("- Critical drift detected: "), py_bool(F.col("critical_drift"))),
        F.format_string("- High severity features: %d", "high_severity_features"),
        F.concat(F.lit("- Severity level: "), F.col("severity_level")),
        F.concat(F.lit("- Recommended action: "), F.col("recommended_action")), F.lit(""),
        F.lit("Feature-level Results:"), F.lit("=" * 30),
    ]
    head = d.select(F.lit(0).alias("block"), F.posexplode(F.array(*header)).alias("line_no", "line"))
    w = Window.orderBy("feature")  # one row per feature: a tiny ranking
    f = features.withColumn("block", F.row_number().over(w))
    body = [
        F.lit(""), F.concat(F.col("feature"), F.lit(":")),
        F.concat(F.lit("  - Drift detected: "), py_bool(F.col("drift_detected"))),
        F.concat(F.lit("  - Severity: "), F.coalesce(F.col("severity"), F.lit("N/A"))),
        F.concat(F.lit("  - P-value: "), fmt(F.col("p_value"), "%.6f")),
        F.concat(F.lit("  - Method: "), F.coalesce(F.col("method"), F.lit("N/A"))),
        F.when(F.col("effect_size").isNotNull(),
               F.concat(F.lit("  - Effect size (Cohen's d): "), F.format_string("%.4f", F.col("effect_size")))),
        F.when(F.col("psi").isNotNull(), F.concat(F.lit("  - PSI: "), F.format_string("%.4f", F.col("psi")))),
    ]
    lines = f.select("block", F.filter(F.array(*body), lambda x: x.isNotNull()).alias("ls"))
    body_rows = lines.select("block", F.posexplode("ls").alias("line_no", "line"))
    return head.unionByName(body_rows)


def result_json(features: DataFrame, dataset: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Nested result document per segment: dataset fields + feature_details map."""
    detail = F.struct(*[c for c in features.columns if c not in (*keys, "feature")])
    fd = features.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("feature", detail)))
                                      .alias("feature_details"))  # one entry per feature
    j = join_small(dataset, fd, list(keys))
    cols = [c for c in j.columns if c not in keys]
    return j.select(*keys, F.to_json(F.struct(*cols)).alias("result_json"))


def run_log(metrics: DataFrame, run_id: Column, kind: str, keys: Sequence[str] = ()) -> DataFrame:
    """Long run log (run_id, kind, key, value): numeric and boolean columns only
    (booleans become 1.0 / 0.0), like a tracking server's metric log."""
    keep = [f.name for f in metrics.schema.fields
            if f.name not in keys and f.dataType.typeName() in
            ("integer", "long", "double", "float", "short", "boolean")]
    m = F.create_map(*[x for c in keep for x in (F.lit(c), F.col(c).cast("double"))])
    return metrics.select(*keys, run_id.alias("run_id"), F.lit(kind).alias("kind"),
                          F.explode(m).alias("key", "value"))


def fingerprint(df: DataFrame, row: Column) -> DataFrame:
    """(n_rows, fingerprint): XOR of a 60-bit md5 prefix per row; independent
    of row order and partitioning, a partial aggregate at any scale."""
    h = F.conv(F.substring(F.md5(row), 1, 15), 16, 10).cast("long")
    return df.agg(F.count("*").alias("n_rows"), F.bit_xor(h).alias("fingerprint"))


def parse_json_records(df: DataFrame, col: str, schema: str) -> DataFrame:
    """JSON column -> typed struct fields (``from_json``), one object per row."""
    parsed = df.withColumn("_j", F.from_json(F.col(col), schema))
    return parsed.select("*", "_j.*").drop("_j")


def record_batches(df: DataFrame, col: str, schema: str, keep: Sequence[str], envelope: str = "dataframe_records") -> DataFrame:
    """Scoring requests ``{"dataframe_records": [{...}, ...]}`` as rows: ``keep``,
    ``position`` in the request, the record's fields, and ``broken``.

    A request that is no such document, and a record whose fields do not fit
    ``schema``, come out as one row of NULL fields with the source text in
    ``broken``, so nothing is lost silently. A request of no records has no rows.
    """
    text = F.col(col)
    # records stay text first: one that does not fit its schema must not spoil its neighbours
    parts = F.from_json(text, f"`{envelope}` ARRAY<STRING>")[envelope]
    fields = [f.strip().split()[0].strip("`") for f in schema.split(",")]
    rows = df.select(*keep, text.alias("_request"), parts.alias("_parts"))
    rows = rows.select(*keep, "_request", F.col("_parts").isNull().alias("_bad"),
                       F.posexplode_outer(F.when(F.col("_parts").isNull(), F.array(F.lit(None).cast("string"))).otherwise(F.col("_parts"))).alias("position", "_record"))
    rows = rows.where(F.col("position").isNotNull()).withColumn("_r", F.from_json("_record", f"{schema}, _corrupt STRING", {"columnNameOfCorruptRecord": "_corrupt"}))
    fits = ~F.col("_bad") & F.col("_r").isNotNull() & F.col("_r._corrupt").isNull()
    return rows.select(*keep, F.when(~F.col("_bad"), F.col("position")).alias("position"), *[F.when(fits, F.col("_r")[f]).alias(f) for f in fields],
                       F.when(F.col("_bad"), F.col("_request")).when(~fits, F.coalesce("_record", F.lit("null"))).alias("broken"))
