"""Dictionary matching as native column expressions (and as a broadcast join).

Semantics (per document):
  * the text is lower-cased once; a keyword matches when its lower-cased form
    is a substring of it (so 'isis' matches inside 'crisis');
  * a pattern matches when a regex search finds it; '.' stops only at '\\n'
    (Java flag ``d``), case-insensitive when the pattern has capitals;
  * a category is reported when any of its terms match, with its matched
    keywords and patterns in dictionary order and
    ``threat_score = #keywords + 2 * #patterns``;
  * severity: 'benign' when nothing matched, otherwise the highest level of
    any matched term (levels are precomputed per term), at least 'low'.

The expression form keeps everything inside whole-stage codegen: one
projection computes ``lower(text)``, the next builds one match array per
category (each term is a ``contains`` or a gated ``rlike``), the last folds
them into the struct array. No Python, no shuffle; it streams with the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contentrisk.functions.dictionary import (
    MAX_TERMS_PER_PROJECTION,
    SEVERITY_NAMES,
    Term,
    ThreatDictionary,
)

THREAT_STRUCT = T.StructType([
    T.StructField("category", T.StringType(), False),
    T.StructField("matched_keywords", T.ArrayType(T.StringType()), True),
    T.StructField("matched_patterns", T.ArrayType(T.StringType()), True),
    T.StructField("threat_score", T.FloatType(), True),
])
THREATS_TYPE = T.ArrayType(THREAT_STRUCT)

_META = set(".^$*+?{}[]\\|()")


def java_regex(pattern: str) -> str:
    """Pattern for ``rlike`` on lower-cased text with Python ``re`` line semantics."""
    flags = "d" + ("i" if any(ch.isupper() for ch in pattern) else "")
    return f"(?{flags}){pattern}"


def literal_gate(pattern: str) -> list[str]:
    """Literal pieces every match must contain, for patterns made of literals and '.*'."""
    pieces = pattern.split(".*")
    if any(ch in _META for piece in pieces for ch in piece):
        return []
    return [p.lower() for p in pieces if p]


def sql_string(s: str) -> str:
    """A Spark SQL string literal (backslash escapes are processed by the parser)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _term_match_sql(lt: str, t: Term) -> str:
    if t.kind == "keyword":
        return f"contains({lt}, {sql_string(t.term)})"
    # AND short-circuits left to right: the regex runs only if every literal piece occurs.
    conds = [f"contains({lt}, {sql_string(g)})" for g in literal_gate(t.term)]
    conds.append(f"rlike({lt}, {sql_string(java_regex(t.term))})")
    return " AND ".join(conds)


_EMPTY_SQL = "CAST(array() AS array<string>)"


def _matched_terms(lt: str, terms: list[Term]) -> Column:
    """Matched terms of one category, in dictionary order.

    Written as concat(CASE WHEN match THEN array(term) ELSE array() END, ...): unlike
    filter/array_compact (lambda functions, interpreted) this stays in codegen. The
    expression is generated as one SQL string, so building it costs one call into the
    JVM instead of several per term.
    """
    if not terms:
        return F.expr(_EMPTY_SQL)
    parts = [f"CASE WHEN {_term_match_sql(lt, t)} THEN array({sql_string(t.term)}) ELSE {_EMPTY_SQL} END"
             for t in terms]
    return F.expr(parts[0] if len(parts) == 1 else "concat(" + ", ".join(parts) + ")")


def _concat_present(items: list[tuple[Column, Column]], empty: Column) -> Column:
    """Array of the values whose condition holds, in order (concat of CASE WHEN arrays)."""
    if not items:
        return empty
    parts = [F.when(cond, F.array(val)).otherwise(empty) for cond, val in items]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def add_threat_columns(df: DataFrame, text: Column, dictionary: ThreatDictionary,
                       threats_col: str = "detected_threats",
                       severity_col: str | None = "threat_severity",
                       engine: str = "arrow") -> DataFrame:
    """Append ``detected_threats`` (array<struct>) and ``threat_severity`` to ``df``.

    ``engine="arrow"`` (default, for every dictionary size): the Arrow-batched one-pass
    matcher of ``matching_arrow``. ``engine="native"``, only when asked for: column
    expressions in whole-stage codegen, O(terms x bytes). A null or empty text has no
    threats in either.
    """
    if engine == "arrow":
        from contentrisk.functions.matching_arrow import add_threat_columns_arrow
        return add_threat_columns_arrow(df, text, dictionary, threats_col, severity_col)
    if engine != "native":
        raise ValueError(f"unknown engine {engine!r}")
    terms = dictionary.terms()
    cats = dictionary.categories
    lt_name = "__cr_lt"
    base = df.withColumn(lt_name, F.lower(F.nullif(text, F.lit(""))))

    by_cat: dict[tuple[int, str], list[Term]] = {}
    for t in terms:
        by_cat.setdefault((t.cat_ord, t.kind), []).append(t)

    helper_cols, arrays = [], {}
    # Large dictionaries are compiled in chunks so each projection stays codegen-sized.
    step = _cats_per_chunk(terms, len(cats))
    for start in range(0, len(cats), step):
        chunk = []
        for ci in range(start, min(len(cats), start + step)):
            k_name, p_name = f"__cr_k{ci}", f"__cr_p{ci}"
            k_expr = _matched_terms(lt_name, by_cat.get((ci, "keyword"), []))
            p_expr = _matched_terms(lt_name, by_cat.get((ci, "pattern"), []))
            chunk += [k_expr.alias(k_name), p_expr.alias(p_name)]
            arrays[ci] = (k_name, p_name)
            helper_cols += [k_name, p_name]
        base = base.select("*", *chunk)

    structs = []
    for ci, c in enumerate(cats):
        k, p = (F.col(n) for n in arrays[ci])
        score = (F.size(k) + F.size(p) * 2).cast("float")
        structs.append((F.size(k) + F.size(p) > 0, F.struct(
            F.lit(c.name).alias("category"), k.alias("matched_keywords"),
            p.alias("matched_patterns"), score.alias("threat_score")).cast(THREAT_STRUCT)))
    new_cols = {threats_col: _concat_present(structs, F.array().cast(THREATS_TYPE))}
    if severity_col:
        new_cols[severity_col] = severity_expr(terms, arrays)
    return base.withColumns(new_cols).drop(lt_name, *helper_cols)


def _cats_per_chunk(terms: list[Term], n_cats: int) -> int:
    if not terms:
        return max(1, n_cats)
    per_cat = max(1, len(terms) // max(1, n_cats))
    return max(1, MAX_TERMS_PER_PROJECTION // per_cat)


def severity_expr(terms: list[Term], arrays: dict[int, tuple[str, str]]) -> Column:
    """Severity from the per-category match arrays (so it shares one projection with the structs)."""
    by_rank: dict[int, list[Column]] = {2: [], 3: []}
    for t in terms:
        if t.sev_rank >= 2:
            k_name, p_name = arrays[t.cat_ord]
            arr = F.col(k_name if t.kind == "keyword" else p_name)
            by_rank[t.sev_rank].append(F.array_contains(arr, t.term))
    total = None
    for k_name, p_name in arrays.values():
        n = F.size(k_name) + F.size(p_name)
        total = n if total is None else total + n
    expr = F.when(total == 0 if total is not None else F.lit(True), F.lit("benign"))
    for rank in (3, 2):
        if by_rank[rank]:
            cond = by_rank[rank][0]
            for c in by_rank[rank][1:]:
                cond = cond | c
            expr = expr.when(cond, F.lit(SEVERITY_NAMES[rank]))
    return expr.otherwise(F.lit("low"))


# ---------------------------------------------------------------------------
# Join form: an inverted index of the dictionary by q-grams.
# ---------------------------------------------------------------------------

#: Characters of an index entry.
GRAM = 3
#: A literal of this many characters holds GRAM entries, one for each way a text's grams may fall on it.
#: Shorter ones are looked for in each text.
LONG_ENOUGH = 2 * GRAM - 1


def longest_piece(t: Term) -> str:
    """The longest literal that every match of a term contains, '' where none is known."""
    return t.term if t.kind == "keyword" else max(literal_gate(t.term), key=len, default="")


def terms_frame(spark: SparkSession, dictionary: ThreatDictionary) -> DataFrame:
    """One row per term; ``piece``: its longest literal (null without one)."""
    rows = [(n, t.category, t.cat_ord, t.kind, t.term_ord, t.term,
             java_regex(t.term) if t.kind == "pattern" else None, longest_piece(t) or None,
             t.weight, t.sev_rank) for n, t in enumerate(dictionary.terms())]
    schema = ("term_id int, category string, cat_ord int, kind string, term_ord int, term string, "
              "rx string, piece string, weight int, sev_rank int")
    return spark.createDataFrame(rows, schema)


def text_grams(text: str) -> str:
    """The grams of a text side by side, as SQL: those that begin at characters 1, 4, 7, .. (linear in the text)."""
    return f"regexp_extract_all({text}, '(?s).{{{GRAM}}}', 0)"


def gram_index(terms: DataFrame, lowered: DataFrame) -> DataFrame:
    """The terms of ``terms`` under GRAM grams of their piece that follow each other, of which a text that holds
    the piece has exactly one among its grams: (gram, gram_at: its place in the piece, the term's columns).

    Of a piece's places those are taken whose grams are rarest in all texts (``lowered``: column ``__lt``).
    """
    entries = (terms.filter(F.length("piece") >= LONG_ENOUGH)
               .select("term_id", F.explode(F.expr(f"sequence(1, length(piece) - {GRAM - 1})")).alias("gram_at"), "piece")
               .select("term_id", "gram_at", F.expr(f"substring(piece, gram_at, {GRAM})").alias("gram")))
    # counts of the dictionary's grams in all texts; tasks add up first, one row a gram comes out
    counts = (lowered.select(F.explode(F.expr(text_grams("__lt"))).alias("gram"))
              .join(F.broadcast(entries.select("gram").distinct()), "gram").groupBy("gram").count())
    ahead = Window.partitionBy("term_id").orderBy("gram_at").rowsBetween(0, GRAM - 1)
    runs = (entries.join(F.broadcast(counts), "gram", "left")
            .select("term_id", "gram_at", "gram", F.sum(F.coalesce("count", F.lit(0))).over(ahead).alias("n"), F.count("*").over(ahead).alias("whole")))
    best = (runs.filter(F.col("whole") == GRAM).groupBy("term_id").agg(F.min(F.struct("n", "gram_at")).alias("best"))
            .select("term_id", F.col("best.gram_at").alias("first")))
    return (runs.select("term_id", "gram_at", "gram").join(F.broadcast(best), "term_id")
            .filter(F.col("gram_at").between(F.col("first"), F.col("first") + GRAM - 1))
            .select("term_id", "gram", "gram_at").join(F.broadcast(terms), "term_id"))


def match_terms_join(docs: DataFrame, id_col: str, text: Column,
                     dictionary: ThreatDictionary) -> DataFrame:
    """One row per (document, matched term), by an inverted index.

    A text's grams meet the terms in an equi join on the grams they are filed under; a hit counts where
    the term's literal first stands in the text, so a term comes once a text and a pattern's regular
    expression runs there only. Terms without a literal of LONG_ENOUGH characters (short keywords, patterns of
    classes) are tested on each text. The index is broadcast: it has GRAM rows a term, and
    ``ThreatDictionary.terms`` refuses more than 50,000 terms.
    """
    spark = docs.sparkSession
    terms = terms_frame(spark, dictionary)
    lowered = docs.select(F.col(id_col).alias("__id"), F.lower(text).alias("__lt")).filter("__lt <> ''")
    index = gram_index(terms, lowered)
    start = f"pos * {GRAM} + 2 - gram_at"
    at_first = F.expr(f"substring(__lt, {start}, length(piece)) = piece AND locate(piece, __lt) = {start}")
    # no lambda function here: the join would leave generated code and copy the text for every gram
    is_match = F.col("rx").isNull() | F.regexp_like(F.col("__lt"), F.col("rx"))
    out = ["category", "cat_ord", "kind", "term_ord", "term", "weight", "sev_rank"]
    by_gram = (lowered.select("__id", "__lt", F.posexplode(F.expr(text_grams("__lt"))).alias("pos", "gram"))
               .join(F.broadcast(index), "gram").filter(at_first).filter(is_match).select(F.col("__id").alias(id_col), *out))
    rest = [(n, t) for n, t in enumerate(dictionary.terms()) if len(longest_piece(t)) < LONG_ENOUGH]
    if not rest:
        return by_gram
    tested = [F.expr(f"CASE WHEN {_term_match_sql('__lt', t)} THEN array({n}) ELSE CAST(array() AS array<int>) END") for n, t in rest]
    # explode_outer: a filter on the size of the tests' array would evaluate them twice
    found = lowered.select("__id", F.explode_outer(F.flatten(F.array(*tested))).alias("term_id"))
    return by_gram.unionByName(found.join(F.broadcast(terms), "term_id").select(F.col("__id").alias(id_col), *out))


def detect_threats_join(docs: DataFrame, id_col: str, text: Column,
                        dictionary: ThreatDictionary) -> DataFrame:
    """(id, category, matched_keywords, matched_patterns, threat_score) via the join form.

    Groups are (document, category): bounded by the dictionary size, never by data skew.
    """
    hits = match_terms_join(docs, id_col, text, dictionary)
    kw = F.filter(F.array_sort(F.collect_list(F.struct("kind", "term_ord", "term"))),
                  lambda s: s["kind"] == "keyword")
    pt = F.filter(F.array_sort(F.collect_list(F.struct("kind", "term_ord", "term"))),
                  lambda s: s["kind"] == "pattern")
    return (hits.groupBy(id_col, "category", "cat_ord")
            .agg(F.transform(kw, lambda s: s["term"]).alias("matched_keywords"),
                 F.transform(pt, lambda s: s["term"]).alias("matched_patterns"),
                 F.sum("weight").cast("float").alias("threat_score"),
                 F.max("sev_rank").alias("sev_rank")))


def flatten_match_strings(df: DataFrame) -> DataFrame:
    """Arrays joined to strings (dictionary order) for order-insensitive comparison."""
    return df.withColumns({
        "matched_keywords": F.array_join("matched_keywords", "|"),
        "matched_patterns": F.array_join("matched_patterns", "|"),
    })
