"""Ranked search by geometric blocks against scoring every document."""

import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from statmart.llm import ranked_search as rs


def plain_terms(text):
    out, now = [], ""
    for c in (text or "") + " ":
        if ord(c) > 127 or c.isascii() and c.isalnum():
            now += chr(ord(c) + 32) if "A" <= c <= "Z" else c
        elif now:
            out.append(now)
            now = ""
    return out


def plain(docs, items, k=50):
    counted = [(d, Counter(plain_terms(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n, total = len(counted), sum(s for *_, s in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(plain_terms(text))
    out = []
    for item, terms in wanted.items():
        found = []
        for d, c, size in counted:
            m = 100 - 50 + (50 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in terms if t in c)
            if s > 0:
                found.append((-s, d is None, d))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k], 1)]
    return out


def key(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x) for x in r))


def frames(spark, docs, items):
    return (spark.createDataFrame([(d, t, 1, "q") for d, t in docs], "doc_id long, text string, score int, query string")
            .repartition(4),
            spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, rank int"))


def test_terms():
    for text in (None, "", "...", "A-b_C1 2x", "Äb ÇD\x7fe`f{g[h", "ñandú\x00Z", "x" * 50, "\U0001F600a b"):
        assert [t for p in rs.terms_of(text) for t in p] == plain_terms(text)
    rng = random.Random(1)
    long = "".join(rng.choice("abcDEF  .é") for _ in range(2_300_000))
    assert [t for p in rs.terms_of(long) for t in p] == plain_terms(long)
    assert [t for p in rs.terms_of("b" * 3_000_000) for t in p] == ["b" * 3_000_000]


@pytest.mark.parametrize("block", [4, 32])
def test_blocks_are_skipped_and_nothing_is_lost(monkeypatch, block):
    monkeypatch.setattr(rs, "BLOCK", block)
    rng = np.random.default_rng(8)
    width, docs = 300, 1500
    topics = [rng.choice(width, 40, replace=False) for _ in range(20)]
    rows = [np.unique(np.concatenate([rng.choice(topics[rng.integers(20)], 15), rng.integers(0, 30, 5)])) for _ in range(docs)]
    counts = np.array([len(r) for r in rows])
    terms = np.concatenate(rows)
    values = rng.integers(1, 1_000_000, len(terms))
    df = np.bincount(terms, minlength=width)
    weights = np.array([rs.weight(int(f), docs) for f in df])
    shard = rs.Shard(rng.permutation(docs), counts, terms, values, weights)
    dense = np.zeros((docs, width), dtype=np.int64)
    dense[np.repeat(np.arange(docs), counts), terms] = values
    scored = touched = 0
    for q in range(60):
        query = np.unique(rng.choice(topics[q % 20], 12))
        best = rs.Best(1, 10)
        scored += shard.search(query, best)
        full = dense[:, query] @ weights[query]
        touched += (full > 0).sum()
        order = np.lexsort((shard.docs, -full))[:10]
        assert best.scores.tolist() == full[order].tolist() and best.ids.tolist() == shard.docs[order].tolist()
    assert scored < 0.8 * touched
    some = max(range(width), key=lambda t: df[t])
    listed, of, maxima = shard.blocks(some)
    assert sorted(listed) == np.flatnonzero(dense[:, some]).tolist() and np.bincount(of).max() <= block
    for b in range(of[-1] + 1):
        assert (maxima[b] == dense[listed[of == b]].max(axis=0)).all()


def test_search_against_every_document(spark, monkeypatch):
    monkeypatch.setattr(rs, "QUERY_TERMS", 40)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["Éa", "ñu", "z9"]
    docs = [(rng.randrange(400), " ".join(rng.choices(words, k=rng.choice([1, 5, 30, 200])))) for _ in range(500)]
    docs += [(1000 + i, "the same text of many Copies w1 w2 w3") for i in range(250)]  # a third of all rows
    docs += [(None, "w1 w2 w3"), (None, "w1 w2 w3"), (5, None), (6, ""), (7, "... --"), (8, "w4 " * 30_000), (9, "q" * 200_000)]
    items = [(1, "w1, W2! w3"), (2, " ".join(words[:50])), (3, None), (4, ""), (5, "absent"), (6, "copies text w9 w9"),
             (7, "ÉA éa Éa"), (7, "w50"), (None, "z9 w4"), (8, "w4"), (9, "q" * 200_000)]
    d, i = frames(spark, docs, items)
    out = rs.search(d, i)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert key(out.collect()) == key(plain(docs, items))


def test_empty_tables(spark):
    d, i = frames(spark, [(1, "a b")], [(1, "a")])
    assert rs.search(d.limit(0), i).count() == 0 and rs.search(d, i.limit(0)).count() == 0
    nothing, _ = frames(spark, [(1, None), (2, "!")], [])
    assert rs.search(nothing, i).count() == 0
    assert [tuple(r) for r in rs.search(d, i).collect()] == plain([(1, "a b")], [(1, "a")])


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    want = con.sql(rs.OP11_SQL).fetchall()
    got = rs.op11_geometric_blocks(spark, folder)
    assert len(want) > 1000 and key(got.select("item_id", "rank", "doc_id", "score").collect()) == key(want)
