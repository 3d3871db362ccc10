"""Vector, mixing, sharding and graph operators, and the pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskframe.llm import ann, common, mixing, neardup, queries, sharding, simhash

SF = "/root/testdata/sf0.001"
DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
VEC = "vec_id bigint, embedding array<float>, label int"


# --- helpers

def test_permutations_are_bijections(spark):
    for n in (1, 2, 3, 7, 10, 97, 1000):
        assert sorted(common.permute_index(np.arange(n), n, 5)) == list(range(n))
        got = spark.range(n).select(common.swap_or_not(F.col("id"), F.lit(n), F.lit(9)).alias("x")).collect()
        assert sorted(r.x for r in got) == list(range(n))


def test_hypergeometric_draws():
    rng = random.Random(1)
    x = [common.hypergeometric(rng, 30, 70, 20) for _ in range(4000)]
    assert min(x) >= 0 and max(x) <= 20
    assert np.mean(x) == pytest.approx(6, abs=0.1) and np.var(x) == pytest.approx(20 * 0.3 * 0.7 * 80 / 99, rel=0.1)
    assert common.hypergeometric(rng, 5, 0, 3) == 3 and common.hypergeometric(rng, 0, 5, 3) == 0
    big = common.hypergeometric(rng, 10**12, 10**12, 10**6)
    assert abs(big - 500_000) < 5_000


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1100)] + [(7, 7)]
    parent = list(range(1200))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    got = {r.id: r.component for r in common.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: top(i) for e in edges for i in e if e[0] != e[1]}
    assert common.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- sharding

def test_shards(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(5, "doc_id").union(spark.createDataFrame([(None, None, None, None, None)] * 3, DOC))
    rows = docs.select("doc_id", "text", F.lit("x").alias("shard"), F.lit(1).alias("__where"))
    got = sharding.shuffle_into_shards(rows, 8).toPandas()
    assert len(got) == rows.count() and got.groupby("shard").size().max() - got.groupby("shard").size().min() <= 1
    for _, own in got.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    assert sorted(got.doc_id.dropna()) == sorted(r.doc_id for r in docs.collect() if r.doc_id is not None)
    assert sharding.shuffle_into_shards(rows.limit(0), 8).count() == 0
    q = queries.op9_shard(spark, SF).toPandas()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.size == len(texts[r.doc_id].encode()) + 1 for r in q.itertuples())


def test_communication_matrix_margins():
    m = sharding.communication_matrix([10, 0, 25, 7], 4, 3)
    assert list(m.sum(1)) == [10, 0, 25, 7] and sorted(m.sum(0)) == [10, 10, 11, 11]


# --- mixing

def slow_targets(sizes):
    """Reshare the excess until no source is above twice its size."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        target = {s: 2.0 * sizes[s] if s in full else left * weight[s] / open_weight for s in names}
        over = {s for s in names if s not in full and target[s] > 2 * sizes[s] + 1e-9}
        if not over:
            return target
        full |= over


def test_mix_meets_targets(spark):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randint(0, 300), "en", rng.choice(["a", "b", "é", "z", None, "b"]), 1) for i in range(600)]
    rows += [(None, "null id", "en", "a", 1), (3, None, None, None, None), (5, "twin row", "en", "a", 1), (5, "twin row", "en", "a", 1)]
    docs = spark.createDataFrame(rows, DOC)
    got = mixing.mix_sources(docs)["taken"].toPandas()
    sizes = {}
    for _, t, _, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = slow_targets(sizes)
    assert len(got) == len(rows) and (got.taken <= 2 * got["size"]).all()
    got["key"] = got.source.where(got.source.notna(), None)
    for s, t in want.items():
        own = got[got.source.isna()] if s is None else got[got.source == s]
        assert own.target.iloc[0] == pytest.approx(t) and own.source_size.iloc[0] == sizes[s]
        assert own.taken.sum() == pytest.approx(t, rel=0.02, abs=130)
    again = mixing.mix_sources(docs)["taken"].toPandas()
    cols = ["doc_id", "size", "taken"]
    assert got[cols].sort_values(cols).reset_index(drop=True).equals(again[cols].sort_values(cols).reset_index(drop=True))
    assert mixing.mix_sources(docs.limit(0))["taken"].count() == 0
    drawn = mixing.mix_sources(docs)["drawn"].toPandas()
    assert drawn.groupby(["rank", "block"]).j.nunique().max() <= 2 and drawn.shard.between(0, 15).all()


def test_mixed_documents_carry_the_taken_words(spark):
    rng = random.Random(7)
    rows = [(i, " " + "".join(f"w{k}{rng.choice([' ', chr(10), '  '])}" for k in range(rng.randint(0, 200))), "en", rng.choice("ab"), 1) for i in range(80)]
    docs = spark.createDataFrame(rows, DOC).withColumn("rank", F.lit(1)).withColumn("size", F.lit("x"))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    taken = {r.doc_id: r.taken for r in mixing.mix_sources(docs)["taken"].collect()}
    words = {}
    texts = {r[0]: r[1] for r in rows}
    for r in mixed.collect():
        own = r.text.split()
        words[r.doc_id] = words.get(r.doc_id, 0) + len(own)
        assert set(own) <= set(texts[r.doc_id].split())
        assert len(set(own)) == len(own)
    assert {i: n for i, n in taken.items() if n} == words
    assert mixing.mixed_documents(docs.limit(0)).count() == 0


# --- vectors

def vectors(rng, n=700, d=16):
    x = rng.standard_normal((n, d)).astype(np.float32)
    x[50:90] = x[40] + 0.02 * rng.standard_normal((40, d))  # a group larger than a list
    x[100:106] = x[99]  # copies
    x[200:203] = x[199] + 0.01 * rng.standard_normal((3, d))
    return x, rng.integers(0, 3, n)


def as_rows(x, labels, odd=True):
    rows = [(int(i), [float(c) for c in v], int(g)) for i, (v, g) in enumerate(zip(x, labels))]
    if odd:
        rows += [(9000, None, 1), (9001, [0.0] * x.shape[1], 1), (9002, [float("nan")] * x.shape[1], 1), (9003, [None] * x.shape[1], 1),
                 (9004, [float(c) for c in x[99]], None), (9005, [float("inf")] + [1.0] * (x.shape[1] - 1), 1), (9006, [], 1)]
    return rows


def test_near_duplicates_against_brute_force(spark):
    rng = np.random.default_rng(8)
    x, labels = vectors(rng)
    labels[40:110] = 1
    labels[199:203] = 2
    labels[201] = 0
    rows = as_rows(x, labels)
    got = {r.vec_id: r for r in neardup.near_duplicates(spark.createDataFrame(rows, VEC)).collect()}
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1)[:, None]
    near = (u @ u.T >= 0.93) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    low = np.arange(len(x))
    for _ in range(len(x)):
        new = np.array([min(low[i], low[near[i]].min(initial=10**6)) for i in range(len(x))])
        if (new == low).all():
            break
        low = new
    assert len(got) == len(rows)
    assert [got[i].n_links for i in range(len(x))] == near.sum(1).tolist()
    assert [got[i].component_id for i in range(len(x))] == low.tolist()
    assert all(got[i].kept == (low[i] == i) for i in range(len(x)))
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(9000, 9007))
    assert neardup.near_duplicates(spark.createDataFrame([], VEC)).count() == 0


def test_near_duplicates_with_repeated_and_null_ids(spark):
    v = [1.0, 0.0, 0.0]
    rows = spark.createDataFrame([(1, v, 1), (1, v, 1), (None, v, 1), (2, [0.0, 1.0, 0.0], 1), (3, [1.0, 0.0], 1)], VEC)
    got = sorted((r.vec_id or -1, r.n_links, r.component_id) for r in neardup.near_duplicates(rows).collect())
    assert got == [(-1, 2, 1), (1, 2, 1), (1, 2, 1), (2, 0, 2), (3, 0, 3)]


def test_near_duplicates_audit_of_rare_partners(spark, monkeypatch):
    rng = np.random.default_rng(10)
    x = rng.standard_normal((400, 64)).astype(np.float32)
    monkeypatch.setattr(neardup, "AUDIT", 8)
    df = spark.createDataFrame(as_rows(x, np.zeros(400, int)), VEC).where("vec_id < 400")
    monkeypatch.setattr(neardup, "AUDIT_MOST", 16, raising=False)
    assert {r.audit_recall for r in neardup.near_duplicates(df).collect()} == {None}  # no partner known: nothing audited
    monkeypatch.setattr(neardup, "AUDIT_MOST", 300)
    x[390:] = x[:10] + 0.001
    df = spark.createDataFrame(as_rows(x, np.zeros(400, int)), VEC).where("vec_id < 400")
    got = {r.vec_id: r for r in neardup.near_duplicates(df).collect()}
    assert all(got[390 + i].component_id == i for i in range(10)) and got[0].audit_recall == 1.0


def test_search_counts_a_repeated_id_once(spark):
    rng = np.random.default_rng(11)
    x = rng.standard_normal((60, 5))
    ids = np.arange(60)
    one = ann.nearest(x, ids, x[:7], ids[:7], 10)
    many = ann.nearest(np.r_[x, x, x + 9, x], np.r_[ids, ids, ids, ids], x[:7], ids[:7], 10)
    assert all(np.allclose(a, b) for a, b in zip(one, many))
    df = spark.createDataFrame([(int(i), v.tolist(), 1) for i, v in zip(ids, x)], VEC)
    twice = ann.search(df.unionByName(df), df.where("vec_id < 7")).collect()
    assert len({(r.query_id, r.vec_id) for r in twice}) == len(twice) == 70
    assert all(r.score == pytest.approx(np.linalg.norm(x[r.query_id] - x[r.vec_id])) for r in twice)


def test_search_recall_and_order(spark):
    rng = np.random.default_rng(9)
    x, labels = vectors(rng, n=3000)
    df = spark.createDataFrame(as_rows(x, labels), VEC).where("vec_id <> 9004").withColumn("score", F.lit(1)).withColumn("id", F.lit(2))
    got = ann.search(df, df.where("vec_id % 100 = 0"), k=10).toPandas()
    y = x.astype(np.float64)
    hits = 0
    for q, own in got.groupby("query_id"):
        d = np.sqrt(((y - y[q]) ** 2).sum(1))
        d[q] = np.inf
        best = np.lexsort((np.arange(len(d)), d))[:10]
        own = own.sort_values("rank")
        assert list(own["rank"]) == list(range(1, 11)) and own.score.is_monotonic_increasing
        assert np.allclose(own.score, d[own.vec_id]) and q not in set(own.vec_id)
        hits += len(set(best) & set(own.vec_id))
    assert got.query_id.nunique() == 30 and hits / 300 >= 0.9


def test_search_small_ties_and_empty(spark):
    df = spark.createDataFrame([(0, [0.5, 0.0], 1), (3, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (100, [0.0, 0.0], 1), (None, [1.0, 1.0], 1), (7, [1.0, 2.0, 3.0], 1)], VEC)
    got = [(r.query_id, r.rank, r.vec_id) for r in ann.search(df, df.where("vec_id % 100 = 0")).orderBy("rank").collect()]
    assert got == [(0, 1, 2), (0, 2, 3), (0, 3, 1)]
    assert ann.search(df.limit(0), df.limit(0)).count() == 0 and ann.search(df, df.limit(0)).count() == 0


# --- pipeline

def test_pipeline_stages_against_their_operators(spark):
    """Every stage is its operator's decision, taken on all that came before."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, SF))
        out[name] = docs
    names = list(out)
    assert all(out[n].columns == list(corpus_pipeline.COLUMNS) for n in names[:-1])
    counts = [out[n].count() for n in names]
    assert before >= counts[0] == counts[1] >= counts[2] > 0
    from riskframe.llm.quality import classify_quality

    source = spark.read.parquet(f"{SF}/documents.parquet")
    keep = {r.doc_id for r in classify_quality(source, spark.read.parquet(f"{SF}/labels.parquet")).where("keep").collect()}
    assert {r.doc_id for r in out[names[0]].collect()} == keep
    groups = simhash.simhash_components(out[names[1]]).collect()
    assert {r.doc_id for r in out[names[2]].collect()} == {r.component_id for r in groups}
    taken = {r.doc_id: r.taken for r in mixing.mix_sources(out[names[2]])["taken"].collect()}
    words = {}
    for r in out[names[3]].collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    assert words == {i: n for i, n in taken.items() if n}
    last = out[names[4]]
    assert last.where("piece = 0").count() == counts[3]
    assert corpus_pipeline.run(spark, SF).count() == counts[4]
