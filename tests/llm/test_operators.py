"""Every operator against a brute-force version, and on nulls, empty and long texts, ties, repeated
rows, empty tables and columns of clashing names."""

import collections
import gzip
import hashlib
import math
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from contentrisk.llm import (common, decontamination, embedding_dedup, licenses, mixing, packing, quality,
                             simhash_dedup, token_counts, tokens, toxicity, warc)
from contentrisk.llm.queries import VOCABULARY
from contentrisk.operators.tables import write_table

DOC = "doc_id long, text string, source string"


def docs(spark, rows, schema=DOC):
    return spark.createDataFrame([(*r, "s")[:3] if len(r) < 3 else r for r in rows], schema)


# toxicity

def sample(n=120):
    rng = np.random.default_rng(0)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5))
    texts, label = [], []
    for i in range(n):
        w = [word() for _ in range(30)]
        if i % 3 == 0:
            for k in rng.integers(0, 30, 3):
                w[k] = "stemx" + word()[:2]
        texts.append(" ".join(w) + ".")
        label.append(int(i % 3 == 0))
    return texts, np.array(label)


def test_labelled_sample_is_one_text_an_id(spark):
    rows = [(1, f"text {k}") for k in range(500)] + [(2, None), (2, None), (3, "a"), (4, "b"), (None, "c")]
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 0), (4, 1), (None, 1)], "doc_id long, toxic int")
    got = [sorted((r.label, r.text or "") for r in common.labelled_sample(docs(spark, rows).repartition(k), labels, "toxic", "doc_id", "text", (5, 5)).collect()) for k in (1, 7)]
    assert got[0] == got[1] and got[0][:2] == [(0, ""), (0, "a")] and len(got[0]) == 3 and got[0][2][1].startswith("text ")


def test_toxic_words_of_few_documents_are_learnt():
    texts, label = sample(2000)
    rare = np.flatnonzero(label)[::45]   # 15 of 667 hold the word, which no other text does
    texts = [t.replace("stemx", "y") + (" zzqqz" if i in rare else "") for i, t in enumerate(texts)]
    model = toxicity.fit(texts, label)
    assert model.weights.get("zzqqz$", 0) > 1
    assert all(toxicity.scorer(model)(pa.array(["abcde zzqqz fgh"]))[1].to_numpy() == 1)


def test_score_without_evidence_is_of_all_labels(spark):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5))
    rows = [(i, " ".join(word() for _ in range(20))) for i in range(600)]   # 60 toxic, nothing to tell them by
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(600)], "doc_id long, toxic int")
    model = toxicity.train(docs(spark, rows), labels, most=(70, 50))
    score = toxicity.scorer(model)(pa.array(["", "abc def", None][:2]))[0].to_numpy()
    assert (abs(score - 0.1) < 0.05).all()


def test_every_run_of_letters_is_a_token(spark):
    text = ["considered-stemxab, well/stemxcd.Yes no", "\u4f60\u597d\uff0c\u50bb\u74dc", "", " .. 12", "a\u2014b c\u00a0d1\u00c9f!"]
    t = toxicity.tokens(pa.array(text))
    words = [t.words[int(w)].as_py() for w in t.word]
    assert words == ["considered", "stemxab", "well", "stemxcd", "yes", "no", "\u4f60\u597d", "\u50bb\u74dc", "", "", "a", "b", "c", "d", "\u00c9f"]
    assert t.starts.tolist() == [0, 6, 8, 9, 10, 15]
    doc = np.repeat(np.arange(5), np.diff(t.starts))
    assert [text[d][b:b + n].lower() for d, b, n in zip(doc, t.begin, t.length)] == [w.lower() for w in words]
    assert t.seq.tolist() == [0, 4, 6, 8, 9, 10, 15]   # a sentence ends inside well/stemxcd.Yes
    model = toxicity.fit(*sample())
    rows = [(i, x) for i, x in enumerate(["abc-stemxab", "abc/stemxab", "abc\u2014stemxab", "abc\u00a0stemxab", "abc,stemxab", "abc-def"])]
    got = toxicity.score_toxicity(docs(spark, rows), model).orderBy("doc_id").collect()
    assert [r.n_toxic_tokens for r in got] == [1, 1, 1, 1, 1, 0]
    assert all(r.text[s["begin"]:s["end"]] == "stemxab" for r in got for s in r.spans)


def test_chain_equals_enumeration():
    rng = np.random.default_rng(1)
    seq = np.array([0, 4, 5, 8])
    odds, trans = np.exp(rng.normal(size=8)), rng.normal(size=(2, 2))
    chain = toxicity.Chain(seq)
    marg, a, b = chain.marginals(odds, trans)
    pair = np.zeros((2, 2))
    for s, e in zip(seq, seq[1:]):
        n, total, one, two = e - s, 0.0, np.zeros(e - s), np.zeros((2, 2))
        for k in range(2 ** n):
            y = [(k >> i) & 1 for i in range(n)]
            p = math.prod(odds[s + i] if y[i] else 1.0 for i in range(n)) * math.exp(sum(trans[y[i], y[i + 1]] for i in range(n - 1)))
            total += p
            one += p * np.array(y)
            for i in range(n - 1):
                two[y[i], y[i + 1]] += p
        assert np.allclose(marg[s:e], one / total)
        pair += two / total
    assert np.allclose(chain.transitions(odds, trans, a, b), pair)


def test_toxicity(spark):
    texts, label = sample()
    model = toxicity.fit(texts, label)
    clash = "doc_id long, text string, score string, spans int"
    rows = [(1, "abc STEMXab!! def,\nstemxcd gh"), (2, "abc def gh."), (3, None), (4, ""), (1, "abc STEMXab!! def,\nstemxcd gh"), (None, "  "), (6, "abcde " * 50_000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], clash)
    got = toxicity.score_toxicity(df, model).collect()
    assert len(got) == len(rows) and got[0]["score_in"] == "x" and got[0]["spans_in"] == 1
    by = [r["score"] for r in got]
    assert by[0] > 0.3 and by[0] == by[4] and max(by[1], by[2], by[3], by[5], by[6]) < 0.3 and by[2] == by[3]
    assert [rows[0][1][s["begin"]:s["end"]] for s in got[0]["spans"]] == ["STEMXab", "stemxcd"]   # tokens are runs of letters
    assert toxicity.score_toxicity(df.limit(0), model).count() == 0
    held = sample(200)
    s = np.asarray(toxicity.scorer(model)(pa.array(held[0]))[0])
    assert ((s >= 0.3) == (held[1] == 1)).mean() > 0.95
    assert toxicity.fit(["a"], np.array([1])).doc[0] > 5 and toxicity.fit([], np.array([])).doc[0] < -5


# decontamination

def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def weighted(w):
    return collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def leaks(rows, items):
    out = {}
    for d, t in rows:
        w = words(t)
        for i, it in items:
            b = words(it)
            n = min(len(b), len(w))
            if n < 5:
                continue
            y = weighted(b)
            for s in range(len(w) - n + 1):
                x = weighted(w[s:s + n])
                both = sum((x & y).values())
                j = both / (sum(x.values()) + sum(y.values()) - both)
                if j >= 0.8 - 1e-12 and (out.get((d, i), (0, 0)) < (j, -s)):
                    out[d, i] = (j, -s)
    return {(d, i): round(j, 9) for (d, i), (j, s) in out.items()}


def test_decontamination(spark):
    rng = np.random.default_rng(2)
    text = lambda n: " ".join(f"w{k}" for k in rng.integers(0, 400, n))
    items = [(k, text(int(rng.integers(12, 60)))) for k in range(12)] + [(12, "a b c"), (13, None), (14, ""), (None, text(20))]
    items += [items[0], (99, items[1][1])]   # repeated, and the same text under another id
    rows = []
    for d in range(40):
        t = text(80).split()
        i = items[d % 12][1].split()
        if d % 4 == 0:
            t[10:10] = i
        elif d % 4 == 1:
            t[5:5] = i[2:]           # cut
        elif d % 4 == 2:
            t[5:5] = i[:-1] + ["zz"]  # changed at an end
        rows.append((d, " ".join(t).title() + ("!" if d % 2 else "")))
    rows += [(100, None), (101, ""), (102, "one two"), (103, items[3][1]), (104, " ".join(items[4][1].split()[:-1])), (None, items[5][1]), rows[0], (0, items[6][1])]
    df = docs(spark, rows).withColumn("row", F.lit(1)).withColumn("similarity", F.lit("x"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, round(r.similarity, 9), r.begin) for r in decontamination.contaminated(df, bench).drop("row").collect()}
    want = leaks([r[:2] for r in rows], items)
    # rows that share an id are told apart: keep the better of each id, as the brute force does
    best = {}
    for d, i, j, s in got:
        best[d, i] = max(best.get((d, i), 0), j)
    assert best == want
    clean = {r.doc_id for r in decontamination.decontaminate(df, bench).collect()}
    assert clean == {d for d, _ in (r[:2] for r in rows)} - {d for d, _ in want}
    assert decontamination.contaminated(df.limit(0), bench).count() == 0
    assert decontamination.decontaminate(df, bench.limit(0)).count() == len(rows)


def test_multi_index_finds_all_within_radius(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2 ** 63, 20, dtype=np.int64)
    near = [int(np.bitwise_xor.reduce([b, *(np.int64(1) << int(k) for k in rng.choice(63, n, replace=False))])) for b in base for n in (0, 7, 14, 20)]
    a = spark.createDataFrame([(int(x),) for x in base], "fp long").select("fp", decontamination.item_keys().alias("key"))
    b = spark.createDataFrame([(x,) for x in near], "fp long").select(F.col("fp").alias("other"), "fp").select("other", decontamination.window_keys().alias("key"))
    got = {tuple(r) for r in a.join(b, "key").filter("bit_count(fp ^ other) <= 20").select("fp", "other").distinct().collect()}
    assert got == {(int(x), y) for x in base for y in near if (int(x) ^ y).bit_count() <= 20}
    assert sum(s + 1 for s in decontamination.shares()) == decontamination.RADIUS + 1


# SimHash

def plain_fingerprint(text, k=4):
    w = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", w)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum((x >> b) & 1 for x in h) > len(h))


def components(n, pairs):
    up = list(range(n))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        up[max(root(a), root(b))] = min(root(a), root(b))
    return [root(x) for x in range(n)]


def test_simhash_near_duplicates(spark):
    rng = np.random.default_rng(4)
    base = [" ".join(f"v{k}" for k in rng.integers(0, 500, 300)) for _ in range(8)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(60):
        w = base[i % 8].split()
        for k in rng.integers(0, 300, i % 4):
            w[k] = "CHANGED"
        rows.append((100 + i, " ".join(w)))
    rows += [(300, None), (301, ""), (302, " \t\n"), (303, "One"), (304, "one"), (305, "One two Three"), (0, base[0]), (306, "É é\x0bx y z"), (307, "aa bb " * 60_000)]
    df = docs(spark, rows).withColumn("component_id", F.lit("x")).withColumn("fp", F.lit(1))
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in simhash_dedup.near_duplicates(df, 4, 4).collect())
    fps = [plain_fingerprint(t) for _, t in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4]
    comp = components(len(rows), pairs)
    low = {c: min(rows[i][0] for i in range(len(rows)) if comp[i] == c) for c in comp}
    assert got == sorted((rows[i][0], f"{fps[i]:016x}", low[comp[i]]) for i in range(len(rows)))
    kept = sorted(r.doc_id for r in simhash_dedup.keep_one(df, 4, 4).collect())
    assert kept == sorted(set(low.values()))
    again = simhash_dedup.keep_one(df.unionByName(df.limit(5)), 4, 4)
    assert sorted(r.doc_id for r in again.collect()) == kept and again.columns == df.columns
    assert simhash_dedup.near_duplicates(df.limit(0), 4, 4).count() == 0
    assert simhash_dedup.keep_one(docs(spark, [(None, "a b c d e"), (None, "a b c d e"), (1, "a b c d e")]), 4, 4).count() == 3


def test_ids_on_different_texts(spark):
    a, b, c = ("w%d " * 40 % tuple(range(k, k + 40)) for k in (0, 100, 200))
    # 5 goes beside 3, and stays with b; 7 names two groups; 3 is repeated
    df = docs(spark, [(3, a), (3, a), (5, a), (5, b), (5, b), (7, c), (7, "other words of its own"), (9, c)])
    kept = sorted((r.doc_id, r.text) for r in simhash_dedup.keep_one(df, 4, 4).collect())
    assert kept == sorted([(3, a), (5, b), (7, c), (7, "other words of its own")])


@pytest.mark.parametrize("distance", [1, 3, 4, 7])
def test_no_link_is_missed(spark, distance):
    rng = np.random.default_rng(distance)
    fps = set()
    for _ in range(6):
        x = int(rng.integers(0, 2 ** 63))
        for _ in range(150):
            y = x
            for k in rng.choice(64, int(rng.integers(0, distance + 3)), replace=False):
                y ^= 1 << int(k)
            fps.add(y)
    fps = sorted(fps)
    signed = [f - 2 ** 64 if f >> 63 else f for f in fps]
    got = simhash_dedup.candidate_links(spark.createDataFrame([(f,) for f in signed], "fp long"), distance).collect()
    at = {f: i for i, f in enumerate(signed)}
    links = [(at[r.a], at[r.b]) for r in got]
    assert all((fps[a] ^ fps[b]).bit_count() <= distance for a, b in links)
    v = np.array(fps, np.uint64)
    true = np.argwhere(np.triu(np.bitwise_count(v[:, None] ^ v[None, :]) <= distance, 1))
    assert components(len(fps), links) == components(len(fps), true.tolist())


def test_links_grow_with_a_group_not_with_its_square(spark):
    """Near copies of one centre: links linear in their number, whatever it is, and each one once."""
    rng = np.random.default_rng(5)
    for size in (100, 200, 400, 800):
        fps = {0x0123456789ABCDEF}
        while len(fps) < size:
            x = 0x0123456789ABCDEF
            for k in rng.choice(64, int(rng.integers(1, 3)), replace=False):
                x ^= 1 << int(k)
            fps.add(x)
        fps = sorted(fps)
        at = {f - 2 ** 64 if f >> 63 else f: i for i, f in enumerate(fps)}
        got = simhash_dedup.candidate_links(spark.createDataFrame([(f,) for f in at], "fp long"), 4).collect()
        links = [(at[r.a], at[r.b]) for r in got]
        assert len(set(links)) == len(links) < 12 * size   # a forest a mask, less what earlier masks gave
        assert all((fps[a] ^ fps[b]).bit_count() <= 4 for a, b in links)
        assert len(set(components(size, links))) == 1


def test_forest_equals_all_pairs():
    rng = np.random.default_rng(15)
    x = rng.integers(0, 60, 400)
    first = np.unique(np.concatenate([[0], rng.integers(0, 400, 30)]))
    bucket = np.searchsorted(first, np.arange(400), "right")
    i, j = common.forest(first, 400, lambda a, b: np.abs(x[a] - x[b]) <= 1)
    pairs = [(a, b) for a in range(400) for b in range(a) if bucket[a] == bucket[b] and abs(x[a] - x[b]) <= 1]
    comp = components(400, pairs)
    assert components(400, list(zip(i.tolist(), j.tolist()))) == comp and len(i) == 400 - len(set(comp))
    assert all(abs(x[a] - x[b]) <= 1 and bucket[a] == bucket[b] for a, b in zip(i, j))
    assert [len(v) for v in common.forest(np.zeros(0, np.int64), 0, None)] == [0, 0]


def test_whole_runs():
    rng = np.random.default_rng(16)
    key = np.sort(rng.integers(0, 30, 500))
    cuts = [0, *sorted(rng.integers(0, 500, 12)), 500]
    batches = [pa.RecordBatch.from_arrays([pa.array(key[a:b] // 5), pa.array(key[a:b])], ["k", "l"]) for a, b in zip(cuts, cuts[1:])]
    got = list(common.whole_runs(batches, ["k", "l"]))
    assert np.concatenate([t.column("l").to_numpy() for t in got]).tolist() == key.tolist()
    ends = [(t.column("l")[0].as_py(), t.column("l")[-1].as_py()) for t in got]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


def test_item_keys_are_one_literal_in_the_plan(spark):
    fps = spark.createDataFrame([(0x0123456789ABCDEF,), (-1,), (None,)], "fp long")
    keyed = fps.select("fp", decontamination.item_keys().alias("key"))
    assert keyed._jdf.queryExecution().analyzed().toString().count("shiftrightunsigned") == 1      # not one a key
    want = {k * 256 + (((fp >> 8 * k) & 255) ^ sum(1 << b for b in bits)) for fp in (0x0123456789ABCDEF,) for k, share in enumerate(decontamination.shares())
            for n in range(share + 1) for bits in combinations(range(8), n)}
    assert {r.key for r in keyed.filter("fp > 0").collect()} == want
    assert keyed.filter("fp IS NULL").count() == len(want)      # nulls, as many as keys


def test_a_round_of_components_is_counted_as_it_is_written(spark):
    edges = write_table(spark.createDataFrame([(1, 2), (2, 3), (3, 4), (7, 9), (9, 9)], "a long, b long"), "edges")
    spark.sparkContext.setJobGroup("rounds", "")
    try:
        for none in (edges.filter("a > 100"), edges.limit(0)):
            assert common.connected_components(none, "t").count() == 0
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("rounds")) < 10     # 13 with a job for the schema and one for the count
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {r.node: r.component for r in common.connected_components(edges, "t").collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 9: 7}


def test_connected_components(spark):
    rng = np.random.default_rng(6)
    e = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1060)]
    got = {r.node: r.component for r in common.connected_components(spark.createDataFrame(e, "a long, b long"), "t").collect()}
    comp = components(1100, e)
    assert got == {n: comp[n] for a, b in e if a != b for n in (a, b)}


# embeddings

def test_embeddings(spark):
    rng = np.random.default_rng(7)
    rows = []
    for c in range(12):
        x = rng.normal(size=16)
        rows += [(len(rows) + k, (x + rng.normal(size=16) * 0.09 * k / 4).tolist()) for k in range(9)]
    n = len(rows)
    rows += [(n, None), (n + 1, []), (n + 2, [0.0] * 16), (n + 3, [1.0, None] + [0.0] * 14), (n + 4, [float("nan")] * 16), (n + 5, [float("inf")] + [0.0] * 15),
             (n + 6, [1.0, 2.0]), (n + 7, [1e300 * x for x in rows[0][1]]), (3, rows[3][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, kept int")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df, 0.9, tile=40).collect())
    ok = [i for i, (_, v) in enumerate(rows) if v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]
    m = np.array([np.array(rows[i][1]) / np.abs(rows[i][1]).max() for i in ok])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    link = m @ m.T >= 0.9
    pairs = [(ok[a], ok[b]) for a, b in np.argwhere(np.triu(link, 1))]
    comp = components(len(rows), pairs)
    count = collections.Counter(x for p in pairs for x in p)
    low = {c: min(rows[i][0] for i in range(len(rows)) if comp[i] == c) for c in comp}
    assert got == sorted((rows[i][0], count[i], low[comp[i]], rows[i][0] == low[comp[i]]) for i in range(len(rows)))
    assert len(pairs) > 100 and embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_of_mixed_lengths(spark):
    one, two = [1.0, 2.0, 3.0], [3.0, 1.0]
    rows = [(1, one), (2, one), (3, one), (4, two), (5, two), (6, [-3.0, 1.0]), (7, [3.0, 1.0, 0.0]), (8, [1.0] * 5)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 0.9).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {
        1: (2, 1, True), 2: (2, 1, False), 3: (2, 1, False), 4: (1, 4, True), 5: (1, 4, False), 6: (0, 6, True), 7: (0, 7, True), 8: (0, 8, True)}


# licences

def test_licenses(spark):
    rows = [(1, "Foo. Released under the MIT License."), (2, "x Licensed under the Apache License, Version 2.0. Licensed under CC BY-NC 4.0."),
            (3, "This work is licensed under the GNU General Public License, version 3."), (4, None), (5, ""), (6, "the general public"),
            (7, "CC-BY-NC cc by nc"), (8, "mit license " * 20_000), (1, "Foo. Released under the MIT License."), (9, "unΣer the MIT license É2"), (10, "nc cc by")]
    df = docs(spark, rows + [(100 + k, "lorem ipsum the of") for k in range(30)]).withColumn("labels", F.lit(1)).withColumn("Score", F.lit(2))
    got = {r.doc_id: r for r in licenses.scan_licenses(df).collect()}
    low = str.maketrans({i: i + 32 for i in range(65, 91)})
    for d, t in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(low))
        at = [(i, x) for p, x in licenses.BASE for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        r = got[d]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(at), min([i for i, _ in at], default=None), max([i for i, _ in at], default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in at})) and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert 0 <= r.score <= 1
    assert got[3].labels == "gpl-3" and got[2].labels == "apache-2,cc-by-nc" and got[6].labels == "" and got[101].score == 0
    assert licenses.scan_licenses(df.limit(0)).count() == 0
    n, total = licenses.document_frequencies(df)
    assert total == len(rows) + 30 and n[licenses.CODE["public"]] == 2


def test_licenses_of_common_notices_and_small_tables(spark):
    whole, short = "This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3."
    for notice in (whole, short):
        for n in (1, 2, 40):   # tables of one row and two; half the rows hold the notice, and all of them
            for other in (0, n):
                df = docs(spark, [(k, notice) for k in range(n)] + [(n + k, "lorem ipsum the of") for k in range(other)])
                got = licenses.scan_licenses(df).collect()
                assert [r.labels for r in sorted(got, key=lambda r: r.doc_id)] == ["gpl-3"] * n + [""] * other
                assert all(r.score >= licenses.LEAST for r in got if r.labels)


def test_licenses_of_files_with_several(spark):
    notice = {t: label for label, t, _ in licenses.TEMPLATES}
    long = [t for t in notice if t.startswith(("permission", "redistribution"))]
    rows = [(k, " lorem ipsum. ".join([*long, t])) for k, t in enumerate(notice)] + [(90, " x ".join(notice)), (91, " x ".join(notice) * 300)]
    got = {r.doc_id: set(r.labels.split(",")) for r in licenses.scan_licenses(docs(spark, rows + [(100 + k, "lorem ipsum the of") for k in range(200)])).collect()}
    for k, label in enumerate(notice.values()):
        assert {"mit", "bsd", label} <= got[k]
    assert got[90] == got[91] == set(notice.values())


def test_license_votes_equal_search_at_every_place():
    rng = np.random.default_rng(5)
    texts = []
    for _ in range(120):   # notices with words lost, changed and doubled, several to a file
        w = []
        for t in rng.integers(0, len(licenses.TEMPLATES), rng.integers(0, 5)).tolist():
            own = licenses.TEMPLATES[t][1].split()
            for c in own:
                w += [[c], [], ["x"], [c, c], [licenses.VOCABULARY[rng.integers(len(licenses.VOCABULARY))]]][rng.choice(5, p=[0.9, 0.025, 0.025, 0.025, 0.025])]
        texts.append(" ".join(w))
    code, bounds = licenses.words(pa.array(texts))
    for df in (np.zeros(len(licenses.VOCABULARY), int), rng.integers(0, 1001, len(licenses.VOCABULARY)), np.full(len(licenses.VOCABULARY), 1000)):
        scan = licenses.Scanner(df, 1000)
        got, want = {}, {}
        for label, doc, share in scan.found(code, bounds):
            for d, x in zip(doc.tolist(), share.tolist()):
                got.setdefault(d, []).append((label, round(x, 9)))
        for d in range(len(texts)):
            one = code[bounds[d]:bounds[d + 1]].tolist()
            for (label, own, keys), weight in zip(scan.templates, scan.weights):
                for b in range(1 - len(own), len(one)):
                    span = [one[i] if 0 <= i < len(one) else -1 for i in range(b, b + len(own))]
                    same = np.array(span) == own
                    share = weight[same].sum() / weight.sum()
                    share = share if share >= licenses.LEAST else same.mean()
                    if share >= licenses.LEAST and len(set(own[same])) > 1 and all(any(span[i:i + len(k)] == k for i in range(len(span))) for k in keys):
                        want.setdefault(d, []).append((label, round(float(share), 9)))
        assert want and {d: sorted(x) for d, x in got.items()} == {d: sorted(x) for d, x in want.items()}


# quality

def test_quality(spark):
    rng = np.random.default_rng(8)
    texts, label = [], []
    for i in range(300):
        w = ["".join(rng.choice(list("abcdef"), int(rng.integers(2, 8)))) for _ in range(40)]
        label.append(i % 2)
        texts.append(" ".join(w) + "." if i % 2 else [" | ".join(w), "!! ".join(w).upper(), " ".join(w[:2] * 20)][i % 3])
    x, y = quality.features(pa.array(texts)), np.array(label, float)
    model = quality.fit(x[:200], y[:200])
    assert ((model.score(x[200:]) >= 0.5) == (y[200:] == 1)).mean() > 0.95
    assert len(model.pairs) and np.allclose(quality.features(pa.array(texts[5:6])), x[5:6])
    df = docs(spark, [(1, None), (2, ""), (3, "a"), (3, "a"), (4, "word " * 100_000)]).withColumn("score", F.lit("x"))
    got = [r.score for r in quality.score_quality(df, model).collect()]
    assert got[0] == got[1] and got[2] == got[3] and all(0 <= s <= 1 for s in got)
    assert quality.fit(x[:0], y[:0]).score(x[:2]).tolist() == [0.5, 0.5]
    assert quality.score_quality(df.limit(0), model).count() == 0
    one = quality.features(pa.array(["Ab ab ab 1,2 |"]))[0]
    got = dict(zip(quality.NAMES, one))
    assert got["distinct words"] == 4 / 5 and got["repeats of the word before"] == 1 / 5 and got["upper"] == 1 / 14 and got["bars"] == 1 / 14


# tokens

TEXTS = ["", " a", "a ", "a  b", "x\n y", "foo bar\nbaz\n\nq", "\n", "  ", "it's 5'll   x  y 'tis", "naïve café 日本 語", "a\u0085 b c", "a  b", "a\x0b b", "🙂 🙂🙂\n🙂"]


@pytest.fixture(scope="module")
def ranks():
    return tokens.load_ranks(VOCABULARY)


def test_ids_equal_whole_text_encoding(ranks):
    tok = tokens.Tokenizer(ranks)
    for _ in range(2):   # once with nothing known, once with words known
        ids, starts = tok.encode(pa.array(TEXTS * 2))
        for i, t in enumerate(TEXTS * 2):
            assert ids[starts[i]:starts[i + 1]].tolist() == tok.encoding.encode_ordinary(t)
    assert tok.encode(pa.array([], pa.string()))[0].tolist() == []


def test_best_fit_equals_search():
    rng = np.random.default_rng(9)
    sizes = rng.integers(1, 65, 500)
    room, rows = [], []
    for i in np.argsort(-sizes, kind="stable"):
        fits = [r for r in range(len(room)) if room[r] >= sizes[i]]
        if fits:
            least = min(room[r] for r in fits)
            rows[0]  # one of the rows with the least room
            r = next(r for r in fits if room[r] == least)
        else:
            room.append(64)
            rows.append([])
            r = len(room) - 1
        room[r] -= sizes[i]
        rows[r].append(i)
    got = packing.best_fit(sizes, 64)
    left = lambda rs: sorted(64 - int(sum(sizes[i] for i in r)) for r in rs)
    assert left(got) == left(rows) and sorted(i for r in got for i in r) == list(range(500))


def test_packing_round_trip(spark, ranks):
    tok = tokens.Tokenizer(ranks)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(50, None), (None, "null id"), (3, "a  b"), (60, "long text here. " * 400)]
    df = docs(spark, rows).withColumn("n_tokens", F.lit("x")).coalesce(1)
    out = packing.pack(df, VOCABULARY, capacity=32).collect()
    segments = collections.defaultdict(dict)
    for r in out:
        ids = np.frombuffer(r.input_ids, "<u2")
        assert len(ids) == 32 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and r.position_resets == r.cu_seqlens[:-1]
        for k, (d, o, row) in enumerate(zip(r.doc_ids, r.doc_offsets, r.doc_rows)):
            segments[row, d][o] = ids[r.cu_seqlens[k]:r.cu_seqlens[k + 1]].tolist()
    whole = sorted(([x for o in sorted(s) for x in s[o]], d is None, d or 0) for (_, d), s in segments.items())
    assert whole == sorted((tok.encoding.encode_ordinary(t or "") + [50256], d is None, d or 0) for d, t in rows)
    assert packing.pack(df.limit(0), VOCABULARY).count() == 0


def test_token_counts(spark, ranks):
    tok = tokens.Tokenizer(ranks)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(50, None), (3, "a  b"), (60, "line one\nline two!\n" * 300)]
    df = docs(spark, rows).withColumn("n_sections", F.lit("x"))
    for r, (d, t) in zip(token_counts.count_tokens(df, VOCABULARY).collect(), rows):
        t = t or ""
        bounds = np.cumsum([len(x.encode()) for x in t.splitlines(keepends=True) if x] if not set(t) & set("\x0b\u0085") else [len(t.encode())])
        if not len(bounds):
            bounds = np.array([0])
        want, at, crossing = [0] * len(bounds), 0, 0
        for i in tok.encoding.encode_ordinary(t):
            n = int(tok.lengths[i])
            share = [max(0, min(at + n, b) - max(at, a)) for a, b in zip([0, *bounds[:-1]], bounds)]
            want[share.index(max(share))] += 1
            crossing += sum(s > 0 for s in share) > 1
            at += n
        assert (r.doc_id, r.section_tokens, r.n_tokens, r.n_sections, r.n_crossing) == (d, want, sum(want), len(want), crossing)
    f = token_counts.count_field_tokens(df, VOCABULARY, ["source", "text"]).collect()
    assert all(sum(r.section_tokens) == r.n_tokens and r.n_sections == 2 for r in f)
    assert token_counts.count_tokens(df.limit(0), VOCABULARY).count() == 0


def test_boundary_rule():
    section, across = token_counts.attribute(np.array([0, 2, 6, 9]), np.array([2, 6, 9, 10]), np.array([4, 8, 10]))
    assert section.tolist() == [0, 0, 1, 2] and across.tolist() == [1, 2]


# mixing

def test_mixing(spark):
    rng = np.random.default_rng(10)
    rows = [(i, "w " * int(rng.integers(1, 40)), "big" if i % 10 < 7 else f"s{i % 10}") for i in range(3000)]
    rows += [(5000, None, "none"), (5001, "", "none"), (None, "a b", "big"), (5002, "null source " * 900, None), rows[0]]
    df = docs(spark, rows).withColumn("copy", F.lit("x"))
    got = mixing.mix(df, repetition=2.0).collect()
    seen = collections.Counter((r.doc_id, r.text, r.source) for r in got)
    assert set(seen) == {(d, t, s) for d, t, s in rows}          # nothing is left out
    tokens_of = lambda t: 0 if not t else sum(c in " \n\t\r" for c in t) + 1
    have, mixed, blocks = collections.Counter(), collections.Counter(), collections.Counter()
    for d, t, s in rows:
        have[s] += tokens_of(t)
    for r in got:
        mixed[r.source] += tokens_of(r.text)
    passes = {s: mixed[s] / have[s] for s in have if have[s]}
    assert abs(max(passes.values()) - 2) < 0.1 and abs(passes["big"] - 1) < 1e-9 and all(0 <= r.slot <= 1 for r in got)
    counted = mixing.counted(df, "doc_id", "text", "source").groupBy("source").agg(F.sum("tokens").alias("tokens"))
    w = {r.source: r for r in mixing.weights(counted, entropy=0.9).collect()}
    p = np.array([r.weight for r in w.values() if r.weight])
    assert abs(-(p * np.log(p)).sum() / np.log(len(p)) - 0.9) < 1e-6 and abs(p.sum() - 1) < 1e-6
    half = {r.source: r.passes for r in mixing.weights(counted, repetition=1.0, budget=sum(have.values()) / 2).collect()}
    assert max(v for s, v in half.items() if have[s]) <= 1.0 + 1e-6
    assert mixing.mix(df.limit(0), repetition=2.0).count() == 0


# WARC

def test_warc(spark, tmp_path):
    long = "<p>" + "x" * 200
    rows = [(5, "http://B.com/z", long), (3, "http://b.com/a?q=1", long), (1, "https://www.a.org", "short"), (2, "https://www.a.org", "short"), (7, None, None),
            (8, "::bad[", ""), (9, "http://b.com/\r\nX: y", "WARC/1.1\r\nContent-Length: 5\r\n\r\n" + "é" * 100), (3, "http://b.com/a?q=1", long), (None, "http://c.d/", long), (11, "u", "日本" * 100_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, record_type string").repartition(3)
    path = str(tmp_path / "warc")
    got = warc.archive(df, path).collect()
    assert len(got) == len(rows)
    data = {(i, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest()) for i, _, h in rows}
    assert {(r.page_id, r.payload_bytes, r.payload_digest) for r in got} == data
    same = [r for r in got if r.payload_bytes == len(long)]
    assert sorted((r.record_type, r.page_id or 0, r.refers_to or 0) for r in same) == [("response", 3, 0), ("revisit", 0, 3), ("revisit", 3, 3), ("revisit", 5, 3)]
    assert all(r.record_type == "response" and r.refers_to is None for r in got if r.payload_bytes != len(long))
    order = [(r.urlkey, r.captured_at, -1 if r.page_id is None else r.page_id) for r in sorted(got, key=lambda r: (r.shard, r.place))]
    assert order == sorted(order)
    for f in (tmp_path / "warc").glob("part-*"):   # any gzip reader reads the archive
        assert gzip.decompress(f.read_bytes()).startswith(b"WARC/1.1\r\n") or not gzip.decompress(f.read_bytes())
    for r in got:   # and any record by its place
        raw = gzip.decompress((tmp_path / "warc" / r.file).read_bytes()[r.offset:r.offset + r.length])
        assert f"X-Payload-Length: {r.payload_bytes}".encode() in raw
    assert warc.archive(df.limit(0)).count() == 0


def test_warc_with_many_repeats(spark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(warc, "small_side", lambda df: df)
    rows = [(i, f"http://h/{i}", f"{i % 7}" * 150) for i in range(60)]
    got = {r.page_id: r.refers_to for r in warc.archive(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: (i % 7 if i >= 7 else None) for i in range(60)}


def test_revisits_name_the_record_and_ranges_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RANGE", 7)
    rows = [(i, f"http://h/{i % 5}", f"{i % 6}" * 150) for i in range(40)] + [(None, "http://h/n", "n" * 200), (None, "http://h/n", "n" * 200)]
    path = str(tmp_path / "warc")
    got = warc.archive(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), path).collect()
    ids, refers = {}, []
    for f in (tmp_path / "warc").glob("part-*"):
        for _, _, h, _ in warc.records(f.read_bytes()):
            ids[h["WARC-Record-ID"]] = (h["WARC-Type"], h["WARC-Payload-Digest"])
            if "WARC-Refers-To" in h:
                refers.append((h["WARC-Refers-To"], h["WARC-Payload-Digest"]))
    assert len(ids) == 42 and len(refers) == 34 + 1
    assert all(ids[to] == ("response", digest) for to, digest in refers)
    assert len({r.shard for r in got}) >= 4
    order = [(r.urlkey, r.captured_at, -1 if r.page_id is None else r.page_id) for r in sorted(got, key=lambda r: (r.shard, r.place))]
    assert order == sorted(order)


def test_loser_tree():
    rng = np.random.default_rng(11)
    for k in (0, 1, 2, 5, 8):
        runs = [sorted(rng.integers(0, 50, int(rng.integers(0, 30))).tolist()) for _ in range(k)]
        assert list(warc.loser_tree(runs)) == sorted(x for r in runs for x in r)


def test_columns_of_internal_names(spark):
    """Columns that bear an internal or a result's name, and maps inside other values, stay as they are."""
    long = " ".join(f"w{k}" for k in range(30))
    rows = [(1, long, "s", 1, 2, 3, 4, 5, [{"a": 1}], ({"b": {"c": 2}},)), (1, long, "s", 1, 2, 3, 4, 5, [{"a": 1}], ({"b": {"c": 2}},)),
            (2, long + " x", "t", 1, 2, 3, 4, 5, [None], (None,)), (3, "other", None, 1, 2, 3, 4, 5, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, __id int, __leak int, __block int, __source int, __copies int, "
                                     "m array<map<string,int>>, n struct<x: map<string,map<string,int>>>")
    kept = simhash_dedup.keep_one(df, 4, 30 // 8)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) in ([1, 3], [1, 2, 3])
    bench = spark.createDataFrame([(9, long)], "item_id long, text string")
    clean = decontamination.decontaminate(df, bench)
    assert clean.columns == df.columns and [r.doc_id for r in clean.collect()] == [3]
    mixed = mixing.mix(df, repetition=2.0)
    assert mixed.columns == [*df.columns, "copy", "slot"] and mixed.filter("__source = 4").count() == mixed.count() >= 4
    named = df.select(F.col("text").alias("score"), F.col("doc_id").alias("spans"))
    got = toxicity.score_toxicity(named, toxicity.fit(*sample()), "score").collect()
    assert len(got) == 4 and got[0]["score_in"] == long and got[0]["spans_in"] == 1
