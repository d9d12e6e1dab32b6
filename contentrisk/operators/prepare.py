"""Fallback classifiers and schema harmonisation for analytics inputs.

When no dictionary enrichment exists, the reference prepares analytics tables
with a crude case-sensitive ``contains`` classifier, and it accepts legacy
tables whose flag columns have other names. Both are column expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentrisk.operators.enrich import TsSpec, ts_column

# The fallback classifiers' trigger words (case-sensitive, on
# the text only), their category labels and the constant detection record.
FALLBACK_A_WORDS = ["attack", "kill", "Trump", "drug"]
FALLBACK_B_WORDS = ["Trump", "attack", "kill", "drug", "fraud"]
FALLBACK_A_CATEGORY = "detected"
FALLBACK_B_CATEGORY = "violence"
FALLBACK_B_DETECTED = '{"category": "violence", "matched_keywords": ["attack"], "threat_score": 1.0}'
LEGACY_FILL_CATEGORY = "potential"
LEGACY_FILL_DETECTED = "threat_detected"



def _empty():
    return F.array().cast("array<string>")


def fallback_enrich(df: DataFrame, variant: str = "a", enrichment_ts: TsSpec = None) -> DataFrame:
    """Crude classifier: any trigger word in ``text`` (case-sensitive) -> threat, 'medium'."""
    words = FALLBACK_A_WORDS if variant == "a" else FALLBACK_B_WORDS
    hit = F.lit(False)
    for w in words:
        hit = hit | F.col("text").contains(w)
    is_threat = F.when(hit, F.lit(True)).otherwise(F.lit(False))   # null text -> False
    label = FALLBACK_A_CATEGORY if variant == "a" else FALLBACK_B_CATEGORY
    out = (df.withColumn("is_threat", is_threat)
           .withColumn("threat_severity", F.when(F.col("is_threat"), "medium").otherwise("benign"))
           .withColumn("threat_categories",
                       F.when(F.col("is_threat"), F.array(F.lit(label))).otherwise(_empty())))
    if variant == "a":
        out = out.withColumn("detected_threats", _empty())
    else:
        out = out.withColumn("detected_threats",
                             F.when(F.col("is_threat"), F.array(F.lit(FALLBACK_B_DETECTED))).otherwise(_empty()))
    return out.withColumn("enrichment_timestamp", ts_column(enrichment_ts))


def harmonize_schema(df: DataFrame) -> DataFrame:
    """Bring a legacy enriched table to the current column names and types.

    has_threat -> is_threat, threat_level -> threat_severity (when the new name is
    absent); missing severity / categories / detections are filled from the flag.
    Categories are always array<string> so that analytics can explode them.
    """
    cols = set(df.columns)
    if "is_threat" not in cols and "has_threat" in cols:
        df = df.withColumnRenamed("has_threat", "is_threat")
    if "threat_severity" not in cols and "threat_level" in cols:
        df = df.withColumnRenamed("threat_level", "threat_severity")
    cols = set(df.columns)
    flag = F.coalesce(F.col("is_threat"), F.lit(False))
    if "threat_severity" not in cols:
        df = df.withColumn("threat_severity", F.when(flag, "medium").otherwise("benign"))
    if "threat_categories" not in cols:
        df = df.withColumn("threat_categories",
                           F.when(flag, F.array(F.lit(LEGACY_FILL_CATEGORY))).otherwise(_empty()))
    elif dict(df.dtypes)["threat_categories"] == "string":
        df = df.withColumn("threat_categories",
                           F.when(F.col("threat_categories").isNull() | (F.col("threat_categories") == ""), _empty())
                           .otherwise(F.array(F.col("threat_categories"))))
    if "detected_threats" not in cols:
        df = df.withColumn("detected_threats",
                           F.when(flag, F.array(F.lit(LEGACY_FILL_DETECTED))).otherwise(_empty()))
    return df
