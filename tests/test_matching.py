import random
import re

import pytest
from pyspark.sql import functions as F

from contentrisk.functions.dictionary import SEVERITY_NAMES, ThreatDictionary, analysis_dictionary
from contentrisk.functions.matching import add_threat_columns, detect_threats_join

EDGE = ThreatDictionary.from_obj({"threat_categories": {
    "terror": {"keywords": ["ISIS", "attack"], "patterns": ["plan.*attack"],
               "severity_levels": {"high": ["attack plan"], "low": ["news"]}},
    "violence": {"keywords": ["attack", "stab"], "patterns": [],
                 "severity_levels": {"medium": ["stab"]}},
}})


def model(text, d):
    """Plain-Python statement of the matching semantics (independent of the Spark code)."""
    if not text:
        return [], "benign"
    tl = text.lower()
    out, rank = [], 0
    for c in d.categories:
        kws = [k.lower() for k in c.keywords if k.lower() in tl]
        pts = [p for p in c.patterns if re.search(p, tl, re.IGNORECASE | re.ASCII)]
        if kws or pts:
            out.append((c.name, kws, pts, float(len(kws) + 2 * len(pts))))
            for t in kws + pts:
                for lvl, inds in c.severity_levels:
                    if any(i.lower() in t.lower() for i in inds):
                        rank = max(rank, {"low": 1, "medium": 2, "high": 3}.get(lvl, 0))
    if not out:
        return [], "benign"
    return out, SEVERITY_NAMES[max(rank, 1)]


def native(spark, texts, d):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    rows = add_threat_columns(df, F.col("text"), d).orderBy("id").collect()
    return [([(s.category, list(s.matched_keywords), list(s.matched_patterns), s.threat_score)
              for s in r.detected_threats], r.threat_severity) for r in rows]


def test_edge_fixtures(spark):
    texts = [None, "", "ISIS", "the crisis deepens", "Plan the\nattack", "plan the\rattack",
             "They ATTACK", "stab wound", "plan an attack now"]
    got = native(spark, texts, EDGE)
    for t, g in zip(texts, got):
        assert g == model(t, EDGE), t
    assert got[0] == ([], "benign") and got[1] == ([], "benign")
    assert got[3][0][0][1] == ["isis"]                      # substring inside a word
    assert got[4][0] == [("terror", ["attack"], [], 1.0), ("violence", ["attack"], [], 1.0)]
    assert got[5][0][0] == ("terror", ["attack"], ["plan.*attack"], 3.0)   # '.' crosses \r
    assert got[7][1] == "medium"


def _random_texts(n, seed=7):
    d = analysis_dictionary()
    vocab = ["the", "and", "of", "crisis", "applied", "Plan", "attack", "\n", "\r", "@", "x@y.com",
             "10.0.0.1", 'token = "' + "a" * 40 + '"', "licensed under the MIT license",
             "worthless", "WORTHLESS", "Identity Theft", "sell", "drugs", "dark web market"]
    for c in d.categories:
        vocab += list(c.keywords)
    rnd = random.Random(seed)
    return [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def test_native_equals_python_model(spark):
    d = analysis_dictionary()
    texts = _random_texts(300)
    got = native(spark, texts, d)
    for t, g in zip(texts, got):
        assert g == model(t, d), t


def test_join_form_equals_expression_form(spark):
    d = analysis_dictionary()
    texts = _random_texts(200, seed=11)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    joined = {(r.id, r.category): (list(r.matched_keywords), list(r.matched_patterns), r.threat_score)
              for r in detect_threats_join(df, "id", F.col("text"), d).collect()}
    expr = {}
    for r in add_threat_columns(df, F.col("text"), d).collect():
        for s in r.detected_threats:
            expr[(r.id, s.category)] = (list(s.matched_keywords), list(s.matched_patterns), s.threat_score)
    assert joined == expr


def test_plan_stays_in_codegen(spark):
    df = spark.createDataFrame([(1, "a")], "id int, text string")
    out = add_threat_columns(df, F.col("text"), analysis_dictionary(), engine="native")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # no lambda (higher-order) functions in the projection: they would leave codegen
    assert "lambdafunction" not in plan


@pytest.mark.parametrize("text,expected", [("KILL people", "violence"), ("nothing here", None)])
def test_case_insensitive_match(spark, text, expected):
    got = native(spark, [text], analysis_dictionary())[0][0]
    cats = [c for c, *_ in got]
    assert (expected in cats) if expected else cats == []


def test_arrow_engine_equals_native(spark):
    d = analysis_dictionary()
    texts = _random_texts(300, seed=5) + [None, "", "Plan the\nattack", "plan the\rattack", "ÉCOLE 10.0.0.1"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    a = add_threat_columns(df, F.col("text"), d, engine="arrow").orderBy("id").collect()
    n = add_threat_columns(df, F.col("text"), d).orderBy("id").collect()
    assert [(r.detected_threats, r.threat_severity) for r in a] == \
        [(r.detected_threats, r.threat_severity) for r in n]


def test_one_engine_for_every_dictionary_size(spark):
    df = spark.createDataFrame([(1, "a kw7 b")], "id int, text string")
    for n in (3, 2000):
        d = ThreatDictionary.from_obj({"threat_categories": {"big": {"keywords": [f"kw{i}" for i in range(n)], "patterns": []}}})
        assert "ArrowEvalPython" in add_threat_columns(df, F.col("text"), d)._jdf.queryExecution().executedPlan().toString()


def test_engines_agree_on_empty_text_empty_terms_and_nullable_patterns(spark):
    d = ThreatDictionary.from_obj({"threat_categories": {
        "a": {"keywords": ["", "bad", "Worse"], "patterns": ["q*", "x+y", "(?:ab)c?"], "severity_levels": {"high": ["bad"]}},
        "b": {"keywords": [""], "patterns": []}}})
    assert d.categories[0].keywords == ("bad", "Worse") and d.categories[1].keywords == ()
    rows = [(1, ""), (2, None), (3, "nothing"), (4, "BAD xxy"), (5, "abc worse"), (6, " ")]
    df = spark.createDataFrame(rows, "id int, text string")
    native, arrow = ([tuple(r) for r in add_threat_columns(df, F.col("text"), d, engine=e).orderBy("id").collect()] for e in ("native", "arrow"))
    assert native == arrow == [tuple(r) for r in add_threat_columns(df, F.col("text"), d).orderBy("id").collect()]
    assert native[0][2] == native[1][2] == [] and native[0][3] == native[1][3] == "benign"
    joined = {(r.id, r.category): r.threat_score for r in detect_threats_join(df, "id", F.col("text"), d).collect()}
    assert joined == {(r[0], t.category): t.threat_score for r in native for t in r[2]}


def test_patterns_are_validated_on_every_load_path():
    row = {"category": "a", "description": "", "keywords": [], "severity_levels": {}, "version": "1"}
    for p in ("(a+)+$", "(?P<w>ab)c"):
        with pytest.raises(ValueError):
            ThreatDictionary.from_rows([row | {"patterns": [p]}])


def test_keyword_hits_finds_overlapping_and_nested_words(spark):
    from contentrisk.functions.matching_arrow import keyword_hits
    df = spark.createDataFrame([(1, "a crisis, bombs"), (2, ""), (3, None), (4, "isis isis")], "id int, text string")
    got = {r.id: r.hits for r in df.select("id", keyword_hits(F.col("text"), ["isis", "crisis", "bomb", ""]).alias("hits")).collect()}
    assert got == {1: ["bomb", "crisis", "isis"], 2: [], 3: [], 4: ["isis"]}
    assert df.select(keyword_hits(F.col("text"), []).alias("h")).first().h == []


def test_keyword_lookup_join_has_no_nested_loop(spark):
    from contentrisk.plans import queries as Q
    from tests.conftest import SF_SMALL
    plan = Q.QUERIES["keyword_lookup_join"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
