"""Mixing sources to target weights by temperature, on DataFrame functions only.

A source's weight is its token share to the power of an exponent, normalised. The exponent is
bisected in [0, 1]: with a repetition limit, the smallest at which no source is passed over more
often than the limit; with a target entropy, the largest at which the weights have at least that
entropy (as a share of the highest possible). Without a budget of its own, the mix takes the fewest
tokens at which each source is passed over once at least: nothing is left out, smaller sources are
repeated. A source's tokens in the mix (its weight times the budget) are then filled pass by pass:
whole passes over all its blocks, and a last one over a permutation of them up to the budget, to the
nearest block. Each copy has a slot in (0, 1), its place in its source's share, by which the sources interleave.

Tokens are counted as white-space characters plus one, 0 for null and empty texts. A null source is
a source of its own. Rows with null ids share a block; repeated rows go together. A source without
tokens is passed over once. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentrisk.llm.common import clear_names, small_side
from contentrisk.operators.tables import free_name, write_table

BLOCKS = 256
BISECTIONS = 40
TOKENS = "CASE WHEN text IS NULL OR text = '' THEN 0 ELSE length(text) - length(translate(text, ' \\n\\t\\r', '')) + 1 END"
#: A number in [0, 2^32) from a string, as any engine with md5 can draw it.
DRAW = "conv(substring(md5({}), 1, 8), 16, 10)"


def block_of(id_col: str) -> str:
    return f"cast(cast({DRAW.format(f'''coalesce(cast({id_col} as string), '')''')} as bigint) % {BLOCKS} as int)"


def exponent(totals: DataFrame, repetition: float | None, entropy: float | None, budget: float | None) -> DataFrame:
    """One row: ``exponent``, and the sources' shares ``p``. The totals of all sources with tokens
    meet in one row: 8 bytes a source."""
    one = totals.filter("tokens > 0").agg(F.sort_array(F.collect_list(F.col("tokens").cast("double"))).alias("t"), F.sum("tokens").cast("double").alias("all"))
    one = one.withColumn("p", F.expr("transform(t, x -> x / all)"))
    powers = "transform(p, x -> power(x, {a}))"
    total = "aggregate({x}, 0D, (s, x) -> s + x)"
    if repetition is not None:
        # passes over a source: weight * budget / tokens; by default the least is 1
        most = (f"power(element_at(p, 1), {{a}} - 1) / power(element_at(p, -1), {{a}} - 1)" if budget is None else
                f"power(element_at(p, 1), {{a}} - 1) / {total.format(x=powers)} * ({float(budget)}D / all)")
        up = f"({most}) > {float(repetition)}D"  # too often: raise the exponent
    else:
        w = f"transform({powers}, x -> x / {total.format(x=powers)})"
        up = f"aggregate({w}, 0D, (s, x) -> s - x * ln(x)) >= {float(entropy)}D * ln(size(p))"
    mid = "(acc.lo + acc.hi) / 2"
    step = f"IF({up.format(a=mid)}, struct({mid} AS lo, acc.hi AS hi), struct(acc.lo AS lo, {mid} AS hi))"
    end = "acc -> acc.hi" if repetition is not None else "acc -> acc.lo"
    e = f"round(aggregate(sequence(1, {BISECTIONS}), struct(0D AS lo, 1D AS hi), (acc, k) -> {step}, {end}), 9)"
    return one.select("all", F.expr(e).alias("exponent"))


def weights(totals: DataFrame, repetition: float | None = None, entropy: float | None = None, budget: float | None = None) -> DataFrame:
    """``source``, ``tokens``, ``weight`` and ``passes`` (how often the source is passed over)."""
    if (repetition is None) == (entropy is None):
        raise ValueError("either a repetition limit or an entropy")
    found = exponent(totals, repetition, entropy, budget)
    powered = (totals.join(F.broadcast(found))  # one row
               .withColumn("power", F.expr("CASE WHEN tokens > 0 THEN power(tokens / all, exponent) ELSE 0D END")))
    norm = powered.agg(F.sum("power").alias("norm"), F.min(F.expr("CASE WHEN tokens > 0 THEN power / tokens END")).alias("least"))
    passes = "power / (tokens * least)" if budget is None else f"power / norm * {float(budget or 0)}D / tokens"
    return (powered.join(F.broadcast(norm))
            .select("source", "tokens", F.expr("CASE WHEN tokens > 0 THEN round(power / norm, 9) ELSE 0D END").alias("weight"),
                    F.expr(f"CASE WHEN tokens > 0 THEN round({passes}, 6) ELSE 1D END").alias("passes")))


def plan(counted: DataFrame, seed: str, **target) -> DataFrame:
    """(source, block, copy, slot): the copies of each block. ``counted`` has source, block, tokens.

    A source, hot or not, is BLOCKS sums by now; its window orders so many rows a pass.
    """
    blocks = write_table(counted.groupBy("source", "block").agg(F.sum("tokens").alias("tokens")), "mix-blocks")
    totals = blocks.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    w = write_table(weights(totals, **target), "mix-weights")
    each = (blocks.withColumnRenamed("tokens", "own").join(small_side(w), blocks.source.eqNullSafe(w.source))
            .drop(w.source).withColumn("copy", F.explode(F.expr("sequence(0, greatest(0, cast(ceil(passes) as int) - 1))"))))
    draw = DRAW.format(f"concat_ws('/', '{seed}', coalesce(source, ''), cast(copy as string), cast(block as string))")
    each = each.withColumn("draw", F.expr(f"cast({draw} as bigint)"))
    each = each.withColumn("before", F.expr("coalesce(sum(own) OVER (PARTITION BY source, copy ORDER BY draw, block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"))
    # the last pass ends at the budget, to the nearest block
    each = each.filter(F.expr("copy + 1 <= passes OR before + own / 2 <= (passes - copy) * tokens"))
    return each.select("source", "block", "copy", F.expr("round((copy * tokens + before + own / 2) / greatest(1, passes * tokens), 9)").alias("slot"))


def counted(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return (docs.select(F.col(source_col).alias("source"), F.expr(block_of(f"`{id_col}`")).alias("block"), F.col(text_col).alias("text"))
            .select("source", "block", F.expr(TOKENS).cast("bigint").alias("tokens")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix", **target) -> DataFrame:
    """``docs`` with ``copy`` and ``slot``: every row as often as its block is in the mix. Columns of
    those names are renamed. Texts are not shuffled where the plan (a few rows a block) is small."""
    p = write_table(plan(counted(docs, id_col, text_col, source_col), seed, **target), "mix-plan")
    by_block = p.groupBy("source", "block").agg(F.sort_array(F.collect_list(F.struct("copy", "slot"))).alias("__copies"))
    docs = clear_names(docs, ["copy", "slot"])
    source, block, copies, one = (free_name(docs, c) for c in ("source", "block", "copies", "one"))
    by_block = write_table(by_block.withColumnsRenamed({"source": source, "block": block, "__copies": copies}), "mix-copies")
    on = F.col(f"`{source_col}`").eqNullSafe(F.col(source)) & (F.expr(block_of(f"`{id_col}`")) == F.col(block))
    out = docs.join(small_side(by_block), on).withColumn(one, F.explode(copies))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(f"{one}.copy").alias("copy"), F.col(f"{one}.slot").alias("slot"))


#: The same in another engine's SQL (source and id not null), for a repetition limit and no budget.
SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, source,
         CASE WHEN text IS NULL OR text = '' THEN 0 ELSE length(text) - length(translate(text, ' ' || chr(10) || chr(9) || chr(13), '')) + 1 END AS tokens,
         CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) % {blocks} AS block
  FROM documents),
blocks AS (SELECT source, block, CAST(sum(tokens) AS BIGINT) AS own FROM d GROUP BY ALL),
t AS (SELECT source, CAST(sum(own) AS BIGINT) AS tokens FROM blocks GROUP BY ALL),
x AS (SELECT max(tokens)::DOUBLE AS hi_t, min(tokens)::DOUBLE AS lo_t, sum(tokens)::DOUBLE AS all_t FROM t WHERE tokens > 0),
bis(k, lo, hi) AS (
  SELECT 0, 0::DOUBLE, 1::DOUBLE
  UNION ALL
  SELECT k + 1, CASE WHEN up THEN mid ELSE lo END, CASE WHEN up THEN hi ELSE mid END
  FROM (SELECT k, lo, hi, (lo + hi) / 2 AS mid, pow(lo_t / all_t, (lo + hi) / 2 - 1) / pow(hi_t / all_t, (lo + hi) / 2 - 1) > {repetition} AS up FROM bis, x) s
  WHERE k < {bisections}),
a AS (SELECT round(hi, 9) AS alpha FROM bis WHERE k = {bisections}),
pw AS (SELECT source, tokens, CASE WHEN tokens > 0 THEN pow(tokens / all_t, alpha) ELSE 0 END AS power FROM t, x, a),
nm AS (SELECT min(CASE WHEN tokens > 0 THEN power / tokens END) AS least FROM pw),
w AS (SELECT source, tokens, CASE WHEN tokens > 0 THEN round(power / (tokens * least), 6) ELSE 1 END AS passes FROM pw, nm),
e AS (SELECT b.source, b.block, b.own, w.tokens, w.passes, c.copy,
             CAST(('0x' || substr(md5('{seed}/' || b.source || '/' || c.copy || '/' || b.block), 1, 8)) AS BIGINT) AS draw
      FROM blocks b JOIN w USING (source), LATERAL (SELECT unnest(range(0, greatest(1, ceil(w.passes)::BIGINT))) AS copy) c),
f AS (SELECT *, coalesce(sum(own) OVER (PARTITION BY source, copy ORDER BY draw, block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM e)
SELECT d.doc_id, d.source, CAST(f.copy AS INTEGER) AS copy, round((f.copy * f.tokens + before + own / 2) / greatest(1, passes * f.tokens), 9) AS slot
FROM d JOIN f USING (source, block)
WHERE copy + 1 <= passes OR before + own / 2 <= (passes - copy) * f.tokens
"""


def oracle(repetition: float, seed: str = "mix") -> str:
    return SQL.format(blocks=BLOCKS, bisections=BISECTIONS, repetition=float(repetition), seed=seed)
