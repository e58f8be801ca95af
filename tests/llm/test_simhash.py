"""Covering SimHash tables against brute force."""

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from statmart.llm import simhash as sh


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ")
             .replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_classes(rows):
    """doc_id, fingerprint, component per row; every pair compared."""
    fps = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 4:
            root[find(b)] = find(a)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, f"{f:016x}", least.get(find(i))) for i, ((d, _), f) in enumerate(zip(rows, fps))]


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "a", 1) for d, t in rows],
                                 "doc_id long, text string, fp string, mask int").repartition(5)


def test_masks_avoid_any_four_places():
    masks = sh.covering_masks()
    assert len(masks) == 31 and all(20 < m.bit_count() < 44 for m in masks)
    kinds = [[(v >> 0) for v in (sum(1 << k for k, m in enumerate(masks) if m >> i & 1),)][0] for i in range(64)]
    kinds = sorted(set(kinds))  # places that lie in the same masks behave alike
    for n in range(1, 5):
        for places in combinations(kinds, n):
            covered = 0
            for p in places:
                covered |= p
            assert covered != (1 << 31) - 1


def test_fingerprints_of_odd_texts():
    texts = ["", " \n\t", "one", "A b", "a\x0bB\x0cc d e", "ÄÖ x y z", "w " * 70_001, "x" * 300_000,
             " ".join(f"w{i}" for i in range(66_000))]
    assert [int(f) for f in sh.fingerprints(texts)] == [plain_fingerprint(t) for t in texts]


def test_classes(spark):
    rng = random.Random(5)
    rows = []
    for g in range(12):
        words = [f"g{g}w{rng.randrange(500)}" for _ in range(rng.choice([60, 200, 400]))]
        for _ in range(8):
            w = list(words)
            for _ in range(rng.randrange(3)):
                w[rng.randrange(len(w))] = f"new{rng.random()}"
            rows.append((rng.randrange(10_000), " ".join(w)))
    rows += [(20_000 + i, "a copy of one text that many hold in this place") for i in range(60)]
    rows += [(7, None), (9, ""), (None, "  "), (None, "only here without any id"), (30_000, "few"), (30_001, "FEW"),
             (30_002, "y" * 100_000), (30_002, "y" * 100_000)]
    rng.shuffle(rows)
    out = sh.near_duplicates(frame(spark, rows))
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    assert key(tuple(r) for r in out.collect()) == key(plain_classes(rows))


def closest(values):
    label = list(range(len(values)))
    for a, b in combinations(range(len(values)), 2):
        if (values[a] ^ values[b]).bit_count() <= 4:
            x, y = label[a], label[b]
            label = [min(x, y) if v in (x, y) else v for v in label]
    return label


@pytest.mark.parametrize("gather", [3, 1024])
def test_large_buckets_are_linked_without_being_gathered(spark, gather):
    """Values around a few centres crowd the buckets; with a small bound they take the path of flips."""
    from statmart.llm.components import connected_components
    rng = random.Random(2)
    values = set()
    for _ in range(6):
        c = rng.getrandbits(64)
        for _ in range(40):
            v = c
            for _ in range(rng.randrange(6)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    values = sorted(values, key=sh._signed)
    nodes = spark.createDataFrame([(sh._signed(v),) for v in values], "fp long")
    parts = dict(tuple(r) for r in connected_components(sh.near_edges(nodes, gather)).collect())
    want = closest(values)
    assert [parts.get(sh._signed(v), sh._signed(v)) for v in values] == [sh._signed(values[w]) for w in want]
    assert len(set(want)) > 6


def test_numpy_sets():
    rng = random.Random(3)
    values = [rng.getrandbits(4) << 10 | rng.getrandbits(5) << 40 for _ in range(50)] + [2 ** 64 - 1, 0]
    assert sh.linked_sets(np.array(values, dtype=np.uint64)).tolist() == closest(values)


def test_empty_table_and_one_fingerprint(spark):
    assert sh.near_duplicates(frame(spark, [])).count() == 0
    out = sh.near_duplicates(frame(spark, [(5, None), (3, ""), (3, "")])).collect()
    assert sorted(tuple(r) for r in out) == [(3, "0" * 16, 3), (3, "0" * 16, 3), (5, "0" * 16, 3)]


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert key(tuple(r) for r in sh.op13_covering_simhash(spark, folder).collect()) == key(plain_classes(rows))
