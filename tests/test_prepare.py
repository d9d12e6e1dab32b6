from contentrisk.operators.prepare import fallback_enrich, harmonize_schema


def test_fallback_is_case_sensitive_and_null_safe(spark):
    df = spark.createDataFrame([("1", "an attack"), ("2", "An Attack"), ("3", None), ("4", "Trump fraud")],
                               "id string, text string")
    a = {r.id: (r.is_threat, r.threat_severity, r.threat_categories, r.detected_threats)
         for r in fallback_enrich(df, "a", enrichment_ts="2024-01-31").collect()}
    assert a["1"] == (True, "medium", ["detected"], [])
    assert a["2"] == (False, "benign", [], [])          # case-sensitive, text only
    assert a["3"] == (False, "benign", [], [])          # null text -> not a threat
    b = {r.id: (r.is_threat, r.threat_categories, len(r.detected_threats))
         for r in fallback_enrich(df, "b").collect()}
    assert b["4"] == (True, ["violence"], 1)


def test_harmonize_renames_and_fills(spark):
    legacy = spark.createDataFrame([("1", True, "high"), ("2", False, None)],
                                   "id string, has_threat boolean, threat_level string")
    out = {r.id: (r.is_threat, r.threat_severity, r.threat_categories, r.detected_threats)
           for r in harmonize_schema(legacy).collect()}
    assert out["1"] == (True, "high", ["potential"], ["threat_detected"])
    assert out["2"] == (False, None, [], [])


def test_harmonize_string_categories_become_arrays(spark):
    simple = spark.createDataFrame([("1", True, "medium", "potential"), ("2", False, "benign", "")],
                                   "id string, is_threat boolean, threat_severity string, threat_categories string")
    out = harmonize_schema(simple)
    assert dict(out.dtypes)["threat_categories"] == "array<string>"
    assert {r.id: r.threat_categories for r in out.collect()} == {"1": ["potential"], "2": []}
