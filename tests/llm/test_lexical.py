"""Lexical search against a plain scoring of every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from riskframe.llm import lexical
from riskframe.llm.lexical import search_items

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


def brute_force(docs, items, k):
    counts = [(d, Counter(terms(t))) for d, t in docs if t is not None]
    counts = [(d, c) for d, c in counts if c]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    out = []
    for item, text in dict.fromkeys(i for i in items if i[1] is not None):
        scores = []
        for d, c in counts:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1000000000 * c[w]) // (1000 * c[w] + 12 * m)) for w in terms(text) if w in c)
            if s > 0:
                scores.append((s, d))
        scores.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(item, r, d, s) for r, (s, d) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, k, doc_schema="doc_id bigint, text string", item_schema="item_id bigint, text string", **kw):
    got = search_items(spark.createDataFrame(docs, doc_schema).repartition(3), spark.createDataFrame(items, item_schema), k=k, **kw)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=str)


def corpus():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)] + ["Été", "naïve", "中文", "don't", "x_y"]
    draw = lambda n: " ".join(rng.choice(words[: 1 + int(len(words) * rng.random() ** 2)]).upper() if rng.random() < 0.3 else rng.choice(words) for _ in range(n))
    docs = [(i, draw(rng.randrange(1, 60))) for i in range(400)]
    docs += [(1000 + i, docs[3][1]) for i in range(150)]  # ties
    docs += [(None, docs[5][1]), (7000, None), (7001, ""), (7002, "!! ??"), (7003, draw(30_000))]
    items = [(i, draw(rng.randrange(1, 90))) for i in range(25)] + [(90, docs[3][1]), (90, docs[3][1]), (90, "w1 w1 w2"), (91, "zzz"), (92, None), (93, ""), (None, "w5 w6")]
    return docs, items


@pytest.mark.parametrize(("block", "at_once"), [(lexical.DOCS, lexical.ITEMS), (64, 7)])
def test_equals_scoring_everything(spark, monkeypatch, block, at_once):
    docs, items = corpus()
    # tasks read the block's size from the module, which travels with the function's globals
    monkeypatch.setattr(lexical, "DOCS", block)
    assert found(spark, docs, items, 20, items_at_once=at_once) == brute_force(docs, items, 20)


def test_blocks_are_finished_safely():
    """Every block by itself keeps the k best, with equal scores by id."""
    import numpy as np
    import pyarrow as pa

    rng = random.Random(8)
    for _ in range(60):
        n = rng.randrange(1, 300)
        rows = [(rng.randrange(50), rng.randrange(1, 40), {rng.randrange(90): rng.randrange(1, 4) for _ in range(rng.randrange(0, 80))}) for _ in range(n)]
        table = pa.table({"id": pa.array([r[0] for r in rows], pa.int64()), "n": pa.array([r[1] for r in rows], pa.int64()),
                          "terms": pa.array([list(r[2]) for r in rows], pa.list_(pa.int32())), "tfs": pa.array([list(r[2].values()) for r in rows], pa.list_(pa.int64()))})
        total = sum(r[1] for r in rows)
        asked = sorted(rng.sample(range(100), rng.randrange(1, 95)))
        weights = [rng.randrange(1, 50) for _ in asked]
        best = lexical.Best(10)
        lexical.Block(table, n, total).search(np.array(asked), np.array(weights), best)
        want = []
        for d, size, c in rows:
            m = 75 + 25 * size * n // total
            want.append((sum(w * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t, w in zip(asked, weights, strict=True) if t in c), d))
        assert best.rows == sorted((x for x in want if x[0] > 0), key=lambda x: (-x[0], x[1]))[:10]


def test_defined_cases(spark):
    docs, items = [(1, "a b"), (2, "b c"), (2, "b c")], [(5, "b a")]
    assert found(spark, [], items, 3) == [] and found(spark, docs, [], 3) == []
    assert found(spark, docs, items, 3) == brute_force(docs, items, 3)
    wide = "doc_id bigint, text string, item_id int, score string, rank int, terms int, id int"
    assert found(spark, [(*d, 1, "x", 2, 3, 4) for d in docs], [(*i, 9, 8) for i in items], 3, wide, "item_id bigint, text string, doc_id int, item int") == brute_force(docs, items, 3)
    names = [("é", "a b"), ("z", "a b"), ("a", "a b"), ("q", "c")]
    got = found(spark, names, [("i", "a")], 2, "doc_id string, text string", "item_id string, text string")
    assert [r[2] for r in got] == ["a", "z"]
