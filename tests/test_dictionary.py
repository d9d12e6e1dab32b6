import pytest

from contentrisk.functions.dictionary import (
    ThreatDictionary,
    analysis_dictionary,
    reference_dictionary,
    term_severity,
    validate_pattern,
)


def test_reference_dictionary_shape():
    d = reference_dictionary()
    assert [c.name for c in d.categories] == [
        "terrorism", "hacking", "sexual_abuse", "violence", "fraud", "drugs"]
    terms = d.terms()
    assert sum(t.kind == "keyword" for t in terms) == 86
    assert sum(t.kind == "pattern" for t in terms) == 36
    assert d.version == "1.0"


def test_keywords_are_lowercased_patterns_verbatim():
    terms = reference_dictionary().terms()
    kws = {t.term for t in terms if t.kind == "keyword"}
    assert "isis" in kws and "al-qaeda" in kws and "ISIS" not in kws
    assert all(t.weight == (1 if t.kind == "keyword" else 2) for t in terms)


def test_severity_is_indicator_in_term():
    d = reference_dictionary()
    fraud = next(c for c in d.categories if c.name == "fraud")
    assert term_severity(fraud, "identity theft") == 3
    assert term_severity(fraud, "scam") == 1
    # only one term of the published dictionary reaches a level above low
    raised = [(t.category, t.term, t.sev_rank) for t in d.terms() if t.sev_rank > 1]
    assert raised == [("fraud", "identity theft", 3)]


def test_corpus_dictionary_reaches_every_level():
    ranks = {t.sev_rank for t in analysis_dictionary().terms()}
    assert ranks == {1, 2, 3}


def test_pattern_validation():
    validate_pattern("plan.*attack")
    with pytest.raises(ValueError):
        validate_pattern("(a+)+b")
    with pytest.raises(Exception):
        validate_pattern("(unclosed")


def test_unknown_level_names_never_raise_severity():
    d = ThreatDictionary.from_obj({"threat_categories": {"c": {
        "keywords": ["x"], "severity_levels": {"critical": ["x"]}}}})
    assert d.terms()[0].sev_rank == 1
