"""Line deduplication, n-gram join, decontamination and components against brute force."""

import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex

from statmart.llm import decontaminate, linededup, ngram_join
from statmart.llm.common import discard
from statmart.llm.components import connected_components
from statmart.session import shared_root

CLASHING = "doc_id long, text string, row long, node long, key string, codes int, n_shingles long, d string"


def documents(spark, rows, parts=5):
    return spark.createDataFrame([(i, t, 1, 2, "k", 3, 4, "d") for i, t in rows], CLASHING).repartition(parts)


def edit_distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def edited(rnd, s, k, signs="xyzé"):
    s = list(s)
    for _ in range(k):
        i, kind = rnd.randrange(len(s)), rnd.randint(0, 2)
        if kind == 0:
            s[i] = rnd.choice(signs)
        elif kind == 1 and len(s) > 1:
            del s[i]
        else:
            s.insert(i, rnd.choice(signs))
    return "".join(s)


def test_banded_distance():
    rnd = random.Random(5)
    for _ in range(1500):
        a = "".join(rnd.choice("abc") for _ in range(rnd.choice([0, 1, 2, 5, 20, 70, 130])))
        b = edited(rnd, a, rnd.randint(0, 5), "abcd") if a else "ab"[:rnd.randint(0, 2)]
        for limit in (0, 1, 2, 5):
            assert linededup.within(a, b, limit) == (edit_distance(a, b) <= limit), (a, b, limit)


def brute_lines(docs, shortest=linededup.MIN_CHARS):
    """Text and number of removed lines of each document; every document id once.

    Lines from ``shortest`` characters on are compared for equality, from ``MIN_CHARS`` on for nearness.
    """
    first = {}
    for d, t in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        for k, x in enumerate((t or "").split("\n")):
            if len(x) >= shortest:
                first.setdefault(x, (d is not None, d or 0, k))
    less = lambda s: {s, *(s[:i] + s[i + 1:] for i in range(len(s)))}
    near = defaultdict(set)
    wide = [x for x in first if len(x) >= linededup.MIN_CHARS]
    for x in wide:
        for v in less(x):
            near[v].add(x)
    gone = {x for x in wide if any(first[y] < first[x] and linededup.within(x, y, 1)
                                    for v in less(x) for y in near[v] if y != x)}
    out = {}
    for d, t in docs:
        if t is None:
            out[d] = (None, 0)
            continue
        lines = t.split("\n")
        keep = [x for k, x in enumerate(lines) if len(x) < shortest
                or x not in gone and first[x] == (d is not None, d or 0, k)]
        out[d] = ("\n".join(keep), len(lines) - len(keep))
    return out


@pytest.mark.parametrize("hot", [True, False])
def test_line_dedup_equals_brute_force(spark, hot):
    rnd = random.Random(2)
    base = "the quick brown fox jumps over the lazy dog and runs far away from here"
    if hot:  # hundreds of lines share a segment
        line = lambda: edited(rnd, base, rnd.choice([0, 1, 1, 2, 3])) if rnd.random() < .7 else edited(rnd, base[:30], 1)
        docs = [(i, "\n".join(line() for _ in range(rnd.randint(0, 5)))) for i in range(250)]
    else:
        docs = [(i, "\n".join(edited(rnd, base[::-1] * rnd.choice([1, 2]), rnd.choice([0, 1, 2])) for _ in range(2)))
                for i in range(12)]
        docs += [(99, "\n".join(f"{base} number {i} of many lines" for i in range(3000)))]
    docs += [(-1, None), (None, base), (1000, ""), (1001, "\n\n"), (1002, "short\nshort\n" + base + "\r"),
             (1003, base * 30), (1004, base * 29 + base[:-1] + "!")]
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in linededup.dedup_lines(documents(spark, docs)).collect()}
    assert got == brute_lines(docs)


def test_short_lines_by_equality(spark):
    line = "a line that is long enough to be looked at"
    docs = [(1, "Home\nMenu\n\nHome\n" + line), (2, "Home\n\n" + line[:-1] + "\nHomes\na\nb"), (3, "\na\n" + line[:31]),
            (4, line[:31] + "\n日本語の文。"), (5, "日本語の文。\nmenu"), (6, line[:30])]
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(documents(spark, docs), least=1).collect()}
    assert got == {1: "Home\nMenu\n\n" + line, 2: "\nHomes\na\nb", 3: "\n" + line[:31], 4: "日本語の文。", 5: "menu",
                   6: line[:30]}


def test_pipeline_drops_short_copies(spark):
    import corpus_pipeline as cp
    docs = spark.createDataFrame([(1, "Home\nfirst", "en", "s", 10), (2, "Home\nsecond", "en", "s", 11), (3, "Home", "en", "s", 4)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in cp.line_dedup(spark, docs, "").collect()}
    assert got == {1: ("Home\nfirst", 10), 2: ("second", 6)}


def test_very_long_lines(spark):
    line = "0123456789" * 50_000
    docs = [(1, line), (2, line + "x"), (3, line[:-2] + "9"), (4, line + "xy"), (5, line[:70_000] + "-" + line[70_000:])]
    got = {r["doc_id"]: r["n_removed"] for r in linededup.dedup_lines(documents(spark, docs)).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 1, 5: 1}  # 4 is one edit from 2


def test_line_dedup_keeps_columns_and_repeated_rows(spark):
    line = "a line that is long enough to be looked at"
    df = documents(spark, [(1, line + "\nx"), (1, line + "\nx"), (2, line), (2, "other")])
    out = linededup.dedup_lines(df)
    assert out.columns == [*df.columns, "n_lines", "n_removed", "old_chars"]
    assert sorted((r["doc_id"], r["text"], r["row"], r["key"], r["n_removed"]) for r in out.collect()) == [
        (1, line + "\nx", 1, "k", 0), (1, line + "\nx", 1, "k", 0), (2, "", 1, "k", 1), (2, "other", 1, "k", 0)]
    assert linededup.dedup_lines(df.limit(0)).count() == 0


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
    if len(words) >= 5:
        return {tuple(words[k:k + 5]) for k in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def brute_components(docs):
    """Set size, smallest linked id and number of links to other sets, of each row."""
    sets = [shingles(t) for _, t in docs]
    having = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            having[g].append(i)
    parent = list(range(len(docs)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [set() for _ in docs]
    for i, s in enumerate(sets):
        for j, k in Counter(j for g in s for j in having[g]).items():
            if j != i and 100 * k >= 80 * (len(s) + len(sets[j]) - k):
                parent[top(i)] = top(j)
                if sets[j] != s:
                    links[i].add(frozenset(sets[j]))
    least = {}
    for i, (d, _) in enumerate(docs):
        least[top(i)] = min(least.get(top(i), d), d)
    return sorted((d, len(sets[i]), least[top(i)], len(links[i])) for i, (d, _) in enumerate(docs))


def near_copies(rnd, groups, most):
    vocabulary = [f"w{i}" for i in range(400)]
    docs = []
    for g in range(groups):
        words = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 3, 5, 9, 30, 120, 300]))]
        for _ in range(rnd.randint(1, most)):
            w = list(words)
            for _ in range(rnd.randint(0, max(1, len(w) // 40))):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
            docs.append(" ".join(w).upper() if rnd.random() < .1 else "\t".join(w) if rnd.random() < .1 else " ".join(w))
    return docs


def test_ngram_join_equals_brute_force(spark):
    rnd = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = near_copies(rnd, 60, 8)
    texts += [f"{passage} {' '.join(f'q{rnd.randrange(9999)}' for _ in range(rnd.randint(5, 200)))}" for _ in range(60)]
    texts += [None, "", " \n\t", "one", "ONE", "one two three four", "one two three four", "é à", "é à",
              " ".join(f"long{i}" for i in range(30_000)), " ".join(f"long{i}" for i in range(29_000))]
    ids = list(range(len(texts)))
    rnd.shuffle(ids)
    docs = list(zip(ids, texts))
    got = sorted(map(tuple, ngram_join.similar_documents(documents(spark, docs)).collect()))
    assert got == brute_components(docs)
    assert ngram_join.similar_documents(documents(spark, [])).count() == 0


def test_large_group_of_near_copies(spark, monkeypatch):
    """Blocks of a cluster give the same links as one group."""
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rnd = random.Random(3)
    docs = list(enumerate(near_copies(rnd, 2, 150) + near_copies(rnd, 20, 2)))
    got = sorted(map(tuple, ngram_join.similar_documents(documents(spark, docs)).collect()))
    assert got == brute_components(docs)


def chained_pairs(rnd, pairs, passage=12):
    """Pairs of near copies; each pair has a passage in common with the next, too short for a link."""
    docs, word = [], iter(range(10**6))
    fresh = lambda n: [f"c{next(word)}" for _ in range(n)]
    link = fresh(passage)
    for _ in range(pairs):
        after = fresh(passage)
        words = link + fresh(170) + after
        link = after
        near = list(words)
        near[rnd.randrange(30, 150)] = "changed"
        docs += [" ".join(words), " ".join(near)]
    return docs


def test_chance_passages_do_not_chain_clusters(spark, monkeypatch):
    """In a large corpus the counts do not tell rare shingles, and all nodes hang together by some."""
    monkeypatch.setattr(ngram_join, "corpus_counts", lambda docs: np.zeros(1 << ngram_join.CELLS_LOG2, dtype=np.int64))
    found, verified = [], ngram_join._verified
    monkeypatch.setattr(ngram_join, "_verified", lambda docs, nodes, clusters, sets: found.append(
        Counter(r["component"] for r in clusters.collect())) or verified(docs, nodes, clusters, sets))
    docs = list(enumerate(chained_pairs(random.Random(1), 40)))
    got = sorted(map(tuple, ngram_join.similar_documents(documents(spark, docs)).collect()))
    assert got == brute_components(docs)
    assert [r[3] for r in got] == [1] * 80
    assert max(found[0].values()) == 2


@pytest.mark.parametrize("classes,whole", [(1, 1 << 24), (2, 0), (1024, 0)])
def test_shingles_of_many_classes(spark, monkeypatch, classes, whole):
    """Links are the same whatever shingles are counted by class, and joined at once."""
    monkeypatch.setattr(ngram_join, "CLASSES", classes)
    monkeypatch.setattr(ngram_join, "WHOLE_ROWS", whole)
    monkeypatch.setattr(ngram_join, "corpus_counts", lambda docs: np.zeros(1 << ngram_join.CELLS_LOG2, dtype=np.int64))
    rnd = random.Random(classes)
    passage = " ".join(f"p{i}" for i in range(90))
    texts = near_copies(rnd, 50, 9) + chained_pairs(rnd, 15)
    texts += [f"{passage} {' '.join(f'q{rnd.randrange(40)}' for _ in range(rnd.randint(1, 40)))}" for _ in range(50)]
    docs = list(enumerate(texts))
    got = sorted(map(tuple, ngram_join.similar_documents(documents(spark, docs)).collect()))
    assert got == brute_components(docs)


def test_shingle_tables_are_deleted(spark):
    root = shared_root(spark).removeprefix("file:") + "/statmart"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    docs = list(enumerate(near_copies(random.Random(5), 20, 4)))
    ngram_join.similar_documents(documents(spark, docs)).collect()
    left = {n.rpartition("-")[0] for n in set(os.listdir(root)) - before}
    assert left <= {"rows", "nodes", "members", "links", "linked", "candidates"}


def test_discard_odd_folder_names(spark, tmp_path):
    path = str(tmp_path / "a b%20ü#1")
    spark.range(5).write.parquet(path)
    (tmp_path / "other").mkdir()
    discard(spark.read.parquet(path))
    assert os.listdir(tmp_path) == ["other"]


def test_repeated_ids_and_null_ids(spark):
    text = "a b c d e f g h i j"
    rows = [(5, text), (5, text), (5, "other words stand in this row"), (7, text), (None, text), (None, None)]
    got = Counter(tuple(r)[:3] for r in ngram_join.similar_documents(documents(spark, rows)).collect())
    assert got == Counter({(5, 6, 5): 2, (5, 2, 5): 1, (7, 6, 5): 1, (None, 6, 5): 1, (None, 0, None): 1})


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(60)]
    edges += [(5000, 5001 + i) for i in range(400)] + [(7, 7), (-4, 9000), (9000, -4)]
    parent = {}

    def top(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    got = connected_components(spark.createDataFrame(edges, "u long, v long"))
    assert {r["node"]: r["component"] for r in got.collect()} == {n: top(n) for n in nodes}
    assert got.count() == len(nodes)
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def words_of(text):
    return [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]


def brute_contamination(docs, items):
    found = {}
    code = {}
    number = lambda ws: np.array([code.setdefault(w, len(code)) for w in ws], dtype=np.int64)
    for i, t in items:
        item = number(words_of(t))
        size = len(item)
        if size < decontaminate.LEAST:
            continue
        window = min(decontaminate.WINDOW, size)
        need = size if size < decontaminate.WINDOW else decontaminate.WINDOW - decontaminate.SUBSTITUTIONS
        for d, text in docs:
            doc = np.concatenate([np.full(size, -1), number(words_of(text)), np.full(size, -1)])
            equal = np.lib.stride_tricks.sliding_window_view(doc, size) == item
            runs = np.pad(equal, ((0, 0), (1, 0))).cumsum(1)
            best = (runs[:, window:] - runs[:, :-window]).max(1)
            ok = np.flatnonzero(best >= need)
            if len(ok):
                most = equal[ok].sum(1)
                row = max(zip(most.tolist(), best[ok].tolist(), (size - ok).tolist()))
                found[d, i] = max(found.get((d, i), row), row)
    return sorted((d, i, m, w, -s) for (d, i), (m, w, s) in found.items())


def test_masks_lose_nothing():
    from itertools import combinations
    for wrong in combinations(range(decontaminate.WINDOW), decontaminate.SUBSTITUTIONS):
        assert any(all(at + k not in wrong for k, c in enumerate(m) if c == "1")
                   for m in decontaminate.MASKS for at in range(decontaminate.WINDOW - len(m) + 1)), wrong


def test_contamination_equals_brute_force(spark):
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(50)]
    make = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    items = [(i, make(rnd.choice([2, 4, 5, 9, 12, 13, 14, 20, 45]))) for i in range(30)]
    docs = []
    for d in range(120):
        words = make(rnd.choice([0, 3, 20, 200]))
        if rnd.random() < .6:
            copy = list(rnd.choice(items)[1])
            for _ in range(rnd.randint(0, 1 + len(copy) // 5)):
                copy[rnd.randrange(len(copy))] = rnd.choice(["new", *vocabulary])
            at = rnd.randint(0, len(words))
            words[at:at] = copy[rnd.choice([0, 0, 1, 4]):]
        docs.append((d, rnd.choice([" ", ", ", "\n"]).join(words).capitalize()))
    docs += [(500, None), (501, ""), (502, "..."), (503, " ".join(["w1"] * 5000)), (504, " ".join(items[3][1] * 300))]
    items = [(i, " ".join(w)) for i, w in items] + [(90, None), (91, ""), (92, " ".join(["w1"] * 20)), (5, "one more text of the item five")]
    bench = spark.createDataFrame([(i, t, "c", 1) for i, t in items], "item_id long, text string, codes string, words int")
    got = sorted(map(tuple, decontaminate.contamination(documents(spark, docs), bench).collect()))
    assert got == brute_contamination(docs, items)
    assert decontaminate.contamination(documents(spark, []), bench).count() == 0
    assert decontaminate.contamination(documents(spark, docs), bench.limit(0)).count() == 0


def test_block_masks_lose_nothing():
    from itertools import combinations
    assert [decontaminate.tolerance(n) for n in (4, 5, 8, 9, 12, 13)] == [0, 1, 1, 2, 2, 3]
    for n in range(decontaminate.LEAST, decontaminate.WINDOW):
        for wrong in combinations(range(n), decontaminate.tolerance(n)):
            assert any(all(at + k not in wrong for k, c in enumerate(m) if c == "1")
                       for at, m in decontaminate.block_masks(n)), (n, wrong)


def test_short_items_with_changed_words(spark):
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in range(2, 16)] + [(90, "日本語の文章は空白がない。"), (91, "短い文")]
    docs, want = [], set()
    for n, text in items[:-2]:
        for k in range(5):
            for turn in range(3):
                words = text.split()
                for j in range(min(k, n)):
                    words[(turn * 2 + j * 3) % n if n % 3 else (turn * 2 + j) % n] = "new"
                d = 1000 * n + 10 * k + turn
                docs.append((d, "some words before " * (turn > 0) + " ".join(words) + " and after" * (turn > 1)))
                if n >= decontaminate.LEAST and words.count("new") <= decontaminate.tolerance(n):
                    want.add((d, n))
    docs += [(1, "前置き日本語の文章は余白がない"), (2, "日本語の短い文"), (3, " ".join(items[5][1].split()[1:]))]
    want |= {(1, 90), (3, 7)}  # of the last, the first word stands before the document
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.contamination(documents(spark, docs), bench, scaled=True)
    got = {(r["doc_id"], r["item_id"]) for r in out.collect()}
    assert {x for x in got if x[1] < 13 or x[1] > 15} == {x for x in want if x[1] < 13 or x[1] > 15}
    assert {x for x in want if 13 <= x[1] <= 15} <= got  # a longer one may have a better window
    assert sorted(map(tuple, decontaminate.unmatched(bench).collect())) == [(2, 2), (3, 3), (4, 4), (91, 3)]


def test_items_below_five_words(spark, tmp_path):
    """Found word for word in any document, first place counted, as a class of their own."""
    rnd = random.Random(9)
    vocabulary = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(n))) for i, n in enumerate([1, 1, 2, 2, 3, 3, 4, 4, 4])]
    items += [(20, "Who wrote Hamlet?"), (21, "短い文"), (22, ""), (23, None), (24, "..."), (20, "hamlet wrote"),
              (30, " ".join(f"long{i}" for i in range(20)))]
    docs = [(d, ", ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([0, 1, 3, 30])))) for d in range(60)]
    docs += [(100, "So, who wrote Hamlet? Nobody knows who wrote Hamlet."), (101, "日本語の短い文"), (102, None), (103, ""),
             (104, "w1 " * 3000), (105, "x " + items[-1][1]), (None, "who wrote hamlet")]
    want = set()
    for d, t in docs:
        ws = words_of(re.sub("([日本語の短い文])", r" \1 ", t or ""))
        for i in {i for i, _ in items}:
            own = [words_of(re.sub("([短い文])", r" \1 ", x or "")) for k, x in items if k == i]
            found = [(len(w), -p) for w in own if 0 < len(w) < 5 for p in range(len(ws)) if ws[p:p + len(w)] == w]
            if found:
                want.add((d, i, max(found)[0], max(found)[0], -max(found)[1]))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.short_matches(documents(spark, docs), bench).collect()
    assert len(got) == len(want) and set(map(tuple, got)) == want
    assert decontaminate.short_matches(documents(spark, []), bench).count() == 0
    assert decontaminate.short_matches(documents(spark, docs), bench.limit(0)).count() == 0
    documents(spark, docs).write.parquet(str(tmp_path / "documents.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    out = decontaminate.op8_spaced_seeds(spark, str(tmp_path)).collect()
    assert {tuple(r)[:5] for r in out if r["short"]} == want
    assert [(r["doc_id"], r["item_id"]) for r in out if not r["short"]] == [(105, 30)]


def test_one_word_repeated_meets_an_item_of_it(spark, monkeypatch):
    """As many diagonals as the document has words; pieces keep each comparison small."""
    monkeypatch.setattr(decontaminate, "PIECE", 32)  # below the longest item, as beyond it
    docs = [(1, "w1 " * 3000), (2, "w1 " * 5), (3, "a b " * 70 + "w1 " * 40 + "a b " * 30), (4, "w2 " * 300)]
    items = [(1, "w1 " * 40), (2, "a b " * 30), (3, "w1 " * 12)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, decontaminate.contamination(documents(spark, docs), bench).collect()))
    assert got == brute_contamination(docs, items)


def test_contamination_runs_no_python(spark):
    from conftest import plan_text
    sf = "/root/testdata/sf0.001"
    assert not re.search("Python|Pandas|Arrow", plan_text(decontaminate.op8_spaced_seeds(spark, sf)))


@pytest.mark.parametrize("query", ["lines", "ngrams", "benchmark"])
def test_registered_queries(spark, query):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    if query == "lines":
        got = {r["doc_id"]: (r["n_removed"], r["kept_chars"]) for r in linededup.op6_line_dedup(spark, sf).collect()}
        assert got == {d: (n, len(t or "")) for d, (t, n) in brute_lines(docs, 1).items()}
    elif query == "ngrams":
        assert sorted(map(tuple, ngram_join.op7_ngram_join(spark, sf).collect())) == brute_components(docs)
    else:
        items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
        assert sorted(tuple(r)[:5] for r in decontaminate.op8_spaced_seeds(spark, sf).collect()) == brute_contamination(docs, items)
