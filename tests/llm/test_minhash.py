"""MinHash fingerprints, the pass over neighbours and the near-duplicates, against plain versions."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from contentrisk.llm import minhash
from contentrisk.operators.tables import write_table


def words_of(text):
    return (text or "").encode().lower().split()


def shingles(text, k=5):
    w = words_of(text)
    return {b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def corpus(seed=0, n=12, copies=9):
    rng = np.random.default_rng(seed)
    base = [" ".join(f"w{k}" for k in rng.integers(0, 400, int(rng.integers(60, 200)))) for _ in range(n)]
    rows = []
    for b in base:
        for c in range(copies):
            w = b.split()
            for k in rng.integers(0, len(w), c % 5):
                w[k] = "changed"
            rows.append(" ".join(w))
    return rows


def test_signatures_estimate_jaccard():
    a = corpus(n=30, copies=4)
    sig = minhash.signatures(pa.array(a))
    assert sig.shape == (120, minhash.PERMUTATIONS)
    error = [minhash.likeness(sig[i:i + 1], sig[j:j + 1])[0] - jaccard(shingles(a[i]), shingles(a[j])) for i in range(120) for j in range(i)]
    assert abs(np.mean(error)) < 0.01 and np.std([e for e in error]) < 0.04
    one = [np.array_equal(minhash.signatures(pa.array([t]))[0], s) for t, s in zip(a, sig)]   # whatever stands beside it
    assert all(one)


def test_shingles_of_odd_texts():
    texts = ["", " \t\n", "One", "one  ", "a b c d", "a b c d e", "A  B\tc d\ne f", "\u00c9 \u00e9 x y z", "a a a a a a a"]
    h, count = minhash.shingle_hashes(pa.array(texts))
    assert count.tolist() == [0, 0, 1, 1, 1, 1, 2, 1, 3]
    own = np.split(h, np.cumsum(count)[:-1])
    assert [len(set(x.tolist())) for x in own] == [len(shingles(t)) for t in texts]
    assert own[2].tolist() == own[3].tolist() and own[5][0] == own[6][0]
    sig = minhash.signatures(pa.array(texts))
    assert (sig[0] == 0xFFFFFFFF).all() and (sig[0] == sig[1]).all() and (sig[2] == sig[3]).all()
    assert minhash.signatures(pa.array([], pa.string())).shape == (0, minhash.PERMUTATIONS)


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_with_next(spark, parts):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join("abc\u00e9\U0001f600"[k] * 3 for k in rng.integers(0, 5, int(rng.integers(0, 40))))) for i in rng.permutation(60).tolist()]
    rows += [(100, None), (101, ""), (102, "x"), (103, "abcd"), (104, "y" * 50_000), (-5, "first of all")]
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = spark.createDataFrame([(*r, "a", 3) for r in rows], "doc_id long, text string, fingerprint string, task int").repartition(4)
        got = minhash.with_next(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    rows = sorted((i, t or "") for i, t in rows)
    want = {}
    for (i, t), (_, f) in zip(rows, rows[1:] + rows[:1]):
        q = len(t) // 4
        want[i] = (len(t), t[:len(t) - q] + f[:q], t, f)
    assert len(got) == len(want)
    hexes = {}
    for r in got:
        n, changed, own, following = want[r.id]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(changed.encode()).hexdigest())
        assert r.text_sha256 == hashlib.sha256(own.encode()).hexdigest()
        s = minhash.signatures(pa.array([own, changed, following]))
        assert [r.fingerprint, r.edited_fingerprint] == minhash.hex_of(s[:2])
        assert (r.near_edited, r.near_next) == (minhash.likeness(s[:1], s[1:2])[0], minhash.likeness(s[:1], s[2:])[0])
        hexes.setdefault(own, set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in hexes.values())


def test_with_next_of_repeats(spark):
    """Repeated rows and null ids: one of equal rows meets the next text, the others each other."""
    df = spark.createDataFrame([(1, "aaaa"), (1, "aaaa"), (1, "aaaa"), (2, "bbbb"), (None, "cccc")], "doc_id long, text string").repartition(3)
    got = sorted(str((r.id, r.edited_sha256)) for r in minhash.with_next(df).collect())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == sorted(str(x) for x in [(None, sha("ccca")), (1, sha("aaaa")), (1, sha("aaaa")), (1, sha("aaab")), (2, sha("bbbc"))])
    one = minhash.with_next(df.filter("doc_id = 2")).collect()
    assert [(r.near_edited, r.near_next) for r in one] == [(1.0, 1.0)]
    assert minhash.with_next(df.limit(0)).collect() == []


def brute(rows, similarity=0.8):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= similarity:
                up[max(root(i), root(j))] = min(root(i), root(j))
    low = {}
    for i in range(len(rows)):
        if rows[i][0] is not None:
            low[root(i)] = min(low.get(root(i), rows[i][0]), rows[i][0])
    return sorted(((rows[i][0], low.get(root(i))) for i in range(len(rows))), key=str)


@pytest.mark.parametrize("tile", [4, 512])
def test_near_duplicates(spark, tile, monkeypatch):
    rows = list(enumerate(corpus(7)))
    rows += [(500, None), (501, ""), (502, "one two"), (503, "One  two"), (504, rows[3][1]), (None, rows[3][1]), (None, "alone here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit(1)).repartition(5)
    prints = write_table(minhash.fingerprints(df), "prints")
    got = sorted(((r.id, r.component_id) for r in minhash.near_duplicates(df, prints, tile=tile).collect()), key=str)
    assert got == brute(rows) and len({c for _, c in got}) < len(got) / 2
    none = df.limit(0)
    assert minhash.near_duplicates(none, write_table(minhash.fingerprints(none), "prints")).count() == 0


def test_candidate_links_are_few(spark):
    rng = np.random.default_rng(8)
    w = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(500):
        t = list(w)
        t[int(rng.integers(0, 300))] = f"x{i}"
        rows.append((i, " ".join(t)))
    prints = minhash.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    classes = write_table(prints.select(F.col("id").alias("class"), F.unhex("fingerprint").alias("fingerprint")), "classes")
    links = minhash.band_links(classes, minhash.CANDIDATE)
    assert links.count() < 500 * minhash.BANDS and links.agg(F.countDistinct("b")).first()[0] >= 490
