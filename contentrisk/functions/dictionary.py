"""Threat dictionary model and its flattening into a term table.

A dictionary maps categories to keywords (substring match on lower-cased
text), regular-expression patterns (searched case-insensitively) and
severity indicators per level. Severity indicators are matched against the
*matched terms* (not the text), so the level a term raises a document to does
not depend on the data: it is computed once here, per (category, term).
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

# Level order used when several levels fire.
SEVERITY_ORDER = {"low": 1, "medium": 2, "high": 3}
SEVERITY_NAMES = {1: "low", 2: "medium", 3: "high"}

# The published threat dictionary (categories, keywords,
# patterns and severity indicators, in their published order). Results equal
# the reference only while these stay as they are.
REFERENCE_DICTIONARY = {
    "threat_categories": {
        "terrorism": {
            "description": "Content related to terrorist activities and extremism",
            "keywords": [
                "bomb", "explosive", "attack", "terror", "jihad", "ISIS", "Al-Qaeda",
                "extremist", "radical", "militant", "insurgent", "suicide bomber",
                "IED", "martyrdom", "caliphate", "infidel", "holy war",
            ],
            "patterns": [
                "plan.*attack", "make.*bomb", "join.*jihad", "kill.*infidels",
                "terror.*cell", "explosive.*device", "militant.*group",
            ],
            "severity_levels": {
                "high": ["bomb making", "attack planning", "recruitment", "active threat"],
                "medium": ["propaganda", "extremist ideology", "hate speech"],
                "low": ["discussion", "news reporting", "academic content"],
            },
        },
        "hacking": {
            "description": "Cybersecurity threats and hacking activities",
            "keywords": [
                "hack", "exploit", "vulnerability", "zero-day", "malware", "ransomware",
                "phishing", "breach", "backdoor", "trojan", "botnet", "DDoS",
                "SQL injection", "XSS", "rootkit", "keylogger", "cryptojacking",
            ],
            "patterns": [
                "hack.*system", "exploit.*vulnerability", "steal.*data",
                "bypass.*security", "crack.*password", "inject.*code",
            ],
            "severity_levels": {
                "high": ["zero-day exploit", "active breach", "ransomware deployment"],
                "medium": ["vulnerability disclosure", "hacking tools", "phishing attempts"],
                "low": ["security research", "ethical hacking", "bug bounty"],
            },
        },
        "sexual_abuse": {
            "description": "Content related to sexual abuse and exploitation",
            "keywords": [
                "abuse", "exploitation", "trafficking", "grooming", "predator",
                "minor", "child", "CSAM", "inappropriate", "assault",
            ],
            "patterns": [
                "groom.*child", "exploit.*minor", "sexual.*abuse",
                "inappropriate.*content", "trafficking.*victim",
            ],
            "severity_levels": {
                "high": ["active exploitation", "CSAM distribution", "grooming attempts"],
                "medium": ["suspicious behavior", "inappropriate content", "predatory language"],
                "low": ["awareness content", "prevention discussion", "support resources"],
            },
        },
        "violence": {
            "description": "Content promoting or depicting violence",
            "keywords": [
                "kill", "murder", "assault", "weapon", "gun", "knife", "violence",
                "fight", "attack", "shoot", "stab", "beat", "torture", "massacre",
            ],
            "patterns": [
                "plan.*attack", "kill.*people", "shoot.*up", "mass.*shooting",
                "violent.*threat", "weapon.*attack",
            ],
            "severity_levels": {
                "high": ["direct threats", "attack planning", "weapon acquisition"],
                "medium": ["violent content", "aggression", "hate speech"],
                "low": ["news reporting", "fiction", "gaming content"],
            },
        },
        "fraud": {
            "description": "Financial fraud and scam activities",
            "keywords": [
                "scam", "fraud", "phishing", "ponzi", "pyramid", "fake", "counterfeit",
                "identity theft", "credit card", "money laundering", "wire fraud",
                "investment scam", "romance scam", "Nigerian prince",
            ],
            "patterns": [
                "get.*rich.*quick", "investment.*opportunity", "verify.*account",
                "update.*payment", "claim.*prize", "urgent.*transfer",
            ],
            "severity_levels": {
                "high": ["active scam operation", "identity theft", "financial fraud"],
                "medium": ["phishing attempts", "suspicious offers", "fake websites"],
                "low": ["scam awareness", "fraud prevention", "educational content"],
            },
        },
        "drugs": {
            "description": "Illegal drug trade and substance abuse",
            "keywords": [
                "drugs", "narcotics", "cocaine", "heroin", "meth", "fentanyl",
                "dealer", "trafficking", "cartel", "overdose", "synthetic drugs",
                "dark web", "silk road", "bitcoin drugs",
            ],
            "patterns": [
                "sell.*drugs", "buy.*narcotics", "drug.*dealer", "trafficking.*route",
                "dark.*web.*market", "crypto.*drugs",
            ],
            "severity_levels": {
                "high": ["drug trafficking", "dealer activity", "distribution network"],
                "medium": ["drug use", "purchasing attempts", "dark web mentions"],
                "low": ["addiction support", "harm reduction", "news coverage"],
            },
        },
    },
    "metadata": {
        "version": "1.0",
        "last_updated": "2024-01-26",
        "description": "Threat classification mapping for content analysis",
    },
}

# Our own neutral test dictionary for the driver's synthetic corpus (the
# published one barely fires on it). Same file format; used together with the
# published categories by the registered queries so every level is reachable.
CORPUS_DICTIONARY = {
    "threat_categories": {
        "toxicity": {
            "description": "Insults and hostile language",
            "keywords": ["idiot", "stupid", "trash", "worthless", "hate"],
            "patterns": ["worthless.*worthless"],
            "severity_levels": {"high": ["worthless"], "medium": ["idiot"], "low": ["hate"]},
        },
        "secrets": {
            "description": "Credentials and access tokens",
            "keywords": ["token"],
            "patterns": ['token = "[0-9a-f]{40}"'],
            "severity_levels": {"high": ["token"]},
        },
        "contact": {
            "description": "Personal contact data",
            "keywords": ["@"],
            "patterns": [r"[a-z0-9._]+@[a-z0-9.]+\.com",
                         r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"],
            "severity_levels": {"medium": ["@"]},
        },
        "license": {
            "description": "License and copyright lines",
            "keywords": ["license", "apache", "mit"],
            "patterns": ["licensed under.*license"],
            "severity_levels": {"low": ["license"]},
        },
    },
    "metadata": {"version": "corpus-1", "description": "Test dictionary for the synthetic corpus"},
}

# A dictionary is compiled into per-row column expressions; above this many
# terms the expression form is split into chunks (see functions.matching).
MAX_TERMS_PER_PROJECTION = 500


@dataclass(frozen=True)
class Category:
    name: str
    description: str
    keywords: tuple[str, ...]
    patterns: tuple[str, ...]
    severity_levels: tuple[tuple[str, tuple[str, ...]], ...]


@dataclass(frozen=True)
class Term:
    category: str
    cat_ord: int
    kind: str          # 'keyword' | 'pattern'
    term_ord: int      # order inside (category, kind)
    term: str          # as reported: keywords lower-cased, patterns verbatim
    weight: int        # 1 for keywords, 2 for patterns
    sev_rank: int      # 1..3: level this term raises a document to


@dataclass
class ThreatDictionary:
    categories: list[Category]
    version: str | None = None
    metadata: dict = field(default_factory=dict)

    # -- construction -----------------------------------------------------
    @classmethod
    def from_obj(cls, obj: dict) -> "ThreatDictionary":
        cats = []
        for name, d in obj["threat_categories"].items():
            sev = tuple((lvl, tuple(inds)) for lvl, inds in (d.get("severity_levels") or {}).items())
            cats.append(Category(name, d.get("description"), *checked_terms(d.get("keywords"), d.get("patterns")), sev))
        meta = obj.get("metadata") or {}
        return cls(cats, meta.get("version"), meta)

    @classmethod
    def from_json_file(cls, path: str) -> "ThreatDictionary":
        with open(path, encoding="utf-8") as f:
            return cls.from_obj(json.load(f))

    @classmethod
    def from_rows(cls, rows) -> "ThreatDictionary":
        """From collected rows of the dictionary table (bounded: one row per category)."""
        cats = []
        version = None
        for r in rows:
            sev = tuple((k, tuple(v)) for k, v in (r["severity_levels"] or {}).items())
            cats.append(Category(r["category"], r["description"], *checked_terms(r["keywords"], r["patterns"]), sev))
            version = r["version"]
        return cls(cats, version)

    def merged(self, other: "ThreatDictionary") -> "ThreatDictionary":
        return ThreatDictionary(self.categories + other.categories, self.version, self.metadata)

    # -- flattening -------------------------------------------------------
    def terms(self) -> list[Term]:
        out = []
        for ci, c in enumerate(self.categories):
            for ki, kw in enumerate(c.keywords):
                out.append(Term(c.name, ci, "keyword", ki, kw.lower(), 1, term_severity(c, kw.lower())))
            for pi, p in enumerate(c.patterns):
                out.append(Term(c.name, ci, "pattern", pi, p, 2, term_severity(c, p)))
        if len(out) > 50_000:
            raise ValueError(f"dictionary has {len(out)} terms; the limit is 50000")
        return out


def term_severity(cat: Category, term: str) -> int:
    """Highest level whose indicator is contained (case-insensitively) in the term; at least low."""
    rank = 1
    t = term.lower()
    for level, indicators in cat.severity_levels:
        if any(ind.lower() in t for ind in indicators):
            rank = max(rank, SEVERITY_ORDER.get(level, 0))
    return rank


_NESTED_QUANTIFIER = re.compile(r"\([^)]*[*+][^)]*\)[*+{]")


# Groups that Python's and Java's regular expressions write differently.
_NOT_SHARED = re.compile(r"\(\?(P[<=>]|#|\()")


def checked_terms(keywords, patterns) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """A category's terms on every load path: empty ones (they would match any text) are
    dropped, patterns validated."""
    patterns = tuple(p for p in patterns or () if p)
    for p in patterns:
        validate_pattern(p)
    return tuple(k for k in keywords or () if k), patterns


def validate_pattern(p: str) -> None:
    """Patterns must compile, mean the same in both regex engines and not nest quantifiers
    (catastrophic backtracking)."""
    re.compile(p)
    if _NOT_SHARED.search(p):
        raise ValueError(f"pattern with a group that only one regex engine knows: {p!r}")
    if _NESTED_QUANTIFIER.search(p):
        raise ValueError(f"pattern with nested quantifiers is not allowed: {p!r}")


def reference_dictionary() -> ThreatDictionary:
    return ThreatDictionary.from_obj(REFERENCE_DICTIONARY)


def analysis_dictionary() -> ThreatDictionary:
    """Published categories followed by the corpus test categories."""
    return reference_dictionary().merged(ThreatDictionary.from_obj(CORPUS_DICTIONARY))
