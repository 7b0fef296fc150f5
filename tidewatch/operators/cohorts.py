"""Cohort tagging, feature projection and the long (unpivoted) feature layout."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

from tidewatch.spec import FeatureSpec

REF, CUR = "ref", "cur"


def split_cohorts(df: DataFrame, is_reference: Column) -> DataFrame:
    """Tag each row as reference or current by a predicate (pushed to the scan)."""
    return df.withColumn("cohort", F.when(is_reference, F.lit(REF)).otherwise(F.lit(CUR)))


def tag_cohorts(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Two frames of one schema -> one frame with a ``cohort`` column (by name)."""
    return (reference.withColumn("cohort", F.lit(REF))
            .unionByName(current.withColumn("cohort", F.lit(CUR)), allowMissingColumns=True))


def common_features(reference: DataFrame, current: DataFrame, spec: FeatureSpec) -> list[str]:
    """Column-name intersection minus target and segment keys, in reference order."""
    cur = set(current.columns)
    skip = {spec.target, "cohort", *spec.keys}
    return [c for c in reference.columns if c in cur and c not in skip]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def encode_binary(col: str | Column, positive: str = "Yes", negative: str = "No") -> Column:
    """Yes -> 1, No -> 0, anything else (and NULL) -> NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c == positive, F.lit(1)).when(c == negative, F.lit(0))


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def as_number(df: DataFrame, name: str) -> tuple[Column, Column]:
    """A column as DOUBLE (NaN as NULL) and whether a value is no number.
    Strings are parsed; other types that are no numbers fail as a whole."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (NumericType, BooleanType)):
        return nan_to_null(c.cast("double")), F.lit(False)
    if isinstance(kind, StringType):
        number = c.try_cast("double")
        return nan_to_null(number), c.isNotNull() & number.isNull()
    return F.lit(None).cast("double"), c.isNotNull()


def to_long(df: DataFrame, features: Sequence[str], keys: Iterable[str] = (),
            as_string: bool = False) -> DataFrame:
    """Unpivot features into ``(keys..., cohort, feature, value)``.

    Numeric features become DOUBLE with NaN normalised to NULL; categorical
    ones (``as_string``) become STRING. NULLs are kept so that a feature that
    is entirely missing in a cohort still shows up (as insufficient data).
    """
    keys = list(keys)
    if as_string:
        cols = [F.col(f).cast("string").alias(f) for f in features]
    else:
        cols = [as_number(df, f)[0].alias(f) for f in features]
    wide = df.select(*[F.col(k) for k in keys], F.col("cohort"), *cols)
    return wide.unpivot(keys + ["cohort"], list(features), "feature", "value")
