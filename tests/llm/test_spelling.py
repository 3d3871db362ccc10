"""Spelling variants against brute force: every edit of every word is tried."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pytest

from riskframe.llm.spelling import spelling_variants

SCHEMA = "doc_id bigint, text string"


def brute_force(rows, least=7, at_least=2, factor=10):
    total = Counter()
    for doc, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= least:
                total[w] += 1
    words = {w: n for w, n in total.items() if n >= at_least}
    alphabet = {c for w in words for c in w}
    out, form, near = {}, {}, {}
    for w in words:
        tried = {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in alphabet}
        tried |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in alphabet} | {w[:i] + w[i + 1:] for i in range(len(w))}
        near[w] = [x for x in tried - {w} if x in words]
        if near[w]:
            best = min(near[w], key=lambda x: (-words[x], x))
            if words[best] >= factor * words[w]:
                form[w] = best
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(near[w]), words.get(form.get(w)))
    return out


def found(spark, rows, schema=SCHEMA, **kw):
    got = spelling_variants(spark.createDataFrame(rows, schema), **kw).collect()
    assert len({r["word"] for r in got}) == len(got)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got}


def variants():
    rows = [(i, "receive Receive RECEIVE separate") for i in range(60)]
    rows += [(100 + i, "recieve recceive recceivee seperate separates separat") for i in range(4)]
    rows += [(200 + i, "abcdefgh bacdefgh hgfedcba abcdefghh abcdefgÿ Éclairer éclairer xx") for i in range(7)]
    rows += [(300 + i, "aaaaaaa aaaaaaaa aaaaaaaaa baaaaaaa aaabaaaa") for i in range(3)]
    rows += [(400, "x" * 40_000 + " " + "x" * 39_999), (401, "x" * 40_000 + " " + "x" * 39_999), (None, "receive"), (None, None), (5, ""), (0, "receive")]
    return rows + rows[-1:] * 3


def test_equals_trying_every_edit(spark):
    rows = [r for r in variants() if not (r[1] or "").startswith("xxx")]
    want = brute_force(rows)
    assert found(spark, rows) == want
    assert any(v[0] for v in want.values())
    long = found(spark, variants())
    assert {w: v for w, v in long.items() if not w.startswith("xxx")} == want
    assert long["x" * 40_000][3] == 1 and long["x" * 39_999][3] == 1


@pytest.mark.parametrize("split", [1, 3])
def test_large_signatures_are_dealt_further(spark, split):
    rows = [r for r in variants() if not (r[1] or "").startswith("xxx")]
    assert found(spark, rows, split=split) == brute_force(rows)


def test_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = brute_force(rows)
    got = spelling_variants(docs).collect()
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got} == want


def test_defined_cases(spark):
    assert found(spark, []) == {}
    assert found(spark, [(1, None), (2, ""), (None, "short")]) == {}
    clash = "doc_id bigint, text string, word string, n bigint, near string, sig bigint, slice bigint"
    rows = [(1, "wonderful wonderful", "a", 1, "b", 2, 3), (None, "wonderfull wonderfull", None, None, None, None, None)]
    assert found(spark, rows, clash) == brute_force([r[:2] for r in rows])
    chain = [(1, "alphabet " * 400), (2, "alphabett " * 30), (3, "alphabettt " * 3), (4, "alphabetttt " * 2)]
    want = brute_force(chain)
    assert found(spark, chain) == want
