"""The pipeline's stages on planted cases."""

import hashlib
import os

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline as cp
from statmart.llm import bpe
from statmart.session import shared_root

EN = "the cat and the dog sat on the mat while it was raining over the old town number {} and nobody came home"
DE = "der hund und die katze saßen auf der matte während es über der alten stadt nummer {} regnete und niemand kam"


@pytest.fixture
def folder(spark, tmp_path):
    bench = "which of these seven old answers about green apples on a table is the right one for a child"
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    words = [f"word{i}" for i in range(120)]
    near = list(words)
    near[50] = "changed"
    rows = [(i, "\n".join(EN.format(20 * i + k) + f" {i * 7 + k}" for k in range(3)), "en") for i in range(20)]
    rows += [(100 + i, "\n".join(DE.format(20 * i + k) + f" {i * 7 + k}" for k in range(3)), "de") for i in range(20)]
    rows += [(200, None, "en"), (201, "", "en"), (202, "1234 ...", None),
             (300, rows[3][1], "en"), (300, rows[3][1], "en"), (301, rows[3][1] + "\nonly here and nowhere else in these documents", "en"),
             (400, " ".join(words), "en"), (401, " ".join(near), "en"),
             (500, "some text before " + bench.upper() + " and after it", "en")]
    docs = spark.createDataFrame([(i, t, g, "s", len(t or "")) for i, t, g in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path), dict((r[0], r[1]) for r in rows)


def test_stages(spark, folder):
    path, texts = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    by_name = dict(cp.STAGES)
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "ngram_join", "decontamination", "encoding"]
    ids = lambda df: sorted(r["doc_id"] for r in df.collect())
    known = by_name["language_id"](spark, docs, path)
    assert known.columns == cp.COLUMNS and ids(known) == sorted(i for i in ids(docs) if i not in (200, 201, 202))
    lines = by_name["line_dedup"](spark, known, path)
    kept = {r["doc_id"]: r for r in lines.collect()}
    assert lines.columns == cp.COLUMNS and 300 not in kept
    assert kept[301]["text"] == "only here and nowhere else in these documents"
    assert all(r["n_chars"] == len(r["text"]) for r in kept.values())
    assert all(kept[i]["text"] == texts[i] for i in (*range(20), *range(100, 120), 400, 401, 500))
    single = by_name["ngram_join"](spark, known, path)
    assert ids(single) == sorted(set(ids(known)) - {300, 301, 401}) and single.columns == cp.COLUMNS
    clean = by_name["decontamination"](spark, single, path)
    assert ids(clean) == [i for i in ids(single) if i != 500] and clean.columns == cp.COLUMNS


def test_ngram_stage_deletes_its_shingles(spark, folder):
    """What a stage leaves counts as disk in all later ones."""
    path, _ = folder
    root = shared_root(spark).removeprefix("file:") + "/statmart"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    dict(cp.STAGES)["ngram_join"](spark, spark.read.parquet(f"{path}/documents.parquet"), path).collect()
    left = {n.rpartition("-")[0] for n in set(os.listdir(root)) - before}
    assert not left & {"prefixes", "sets", "shared", "live", "clusters"}


def test_run(spark, folder):
    path, texts = folder
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.RANKS))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = {r["doc_id"]: r for r in cp.run(spark, path).collect()}
    assert set(out) == {*range(20), *range(100, 120), 301, 400}
    for i in (*range(20), 400):
        assert out[i]["n_tokens"] == len(own.encode_ordinary(texts[i]))
        assert out[i]["decoded_sha256"] == hashlib.sha256(texts[i].encode()).hexdigest()


def test_empty_table(spark, folder, tmp_path):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, docs, path).count() == 0


def test_rows_that_share_an_id_or_have_none(spark, folder, tmp_path):
    """A decision about one row does not touch another text under its id."""
    path, texts = folder
    bench = "which of these seven old answers about green apples on a table is the right one for a child"
    own = [" ".join(f"own{k}x{i}" for i in range(60)) for k in range(8)]
    rows = [(3, own[0]), (5, own[0] + " tail"), (5, own[1]), (5, own[1]), (3, own[2]),  # 5 holds a copy of 3 and a text of its own
            (None, own[0]), (None, own[3]), (None, own[3] + " end"), (6, own[4] + " " + bench), (6, own[5]),
            (None, own[6] + " " + bench), (8, None), (8, own[7]), (9, ""), (9, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    by_name = dict(cp.STAGES)
    got = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    single = got(by_name["ngram_join"](spark, docs, path))
    alone = [(5, own[1]), (3, own[2]), (6, own[4] + " " + bench), (6, own[5]), (None, own[6] + " " + bench), (8, None),
             (8, own[7]), (9, ""), (9, ""), (3, own[0])]
    either = [r for r in single if r not in alone]
    assert sorted((r for r in single if r in alone), key=str) == sorted(alone, key=str)
    assert len(either) == 1 and either[0] in ((None, own[3]), (None, own[3] + " end"))
    clean = got(by_name["decontamination"](spark, docs, path))
    assert clean == sorted(((i, t) for i, t in rows if bench not in (t or "")), key=str)
    en = [(i, EN.format(i) + " " + EN.format(i + 50)) for i in range(40)]
    told = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in en] + [(1, "12345 ...", None, "s", 9), (None, en[0][1], None, "s", 5)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert got(by_name["language_id"](spark, told, path)) == sorted([*en, (None, en[0][1])], key=str)


def test_line_dedup_needs_one_python_process_per_task(spark, folder):
    from conftest import plan_text
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    plan = plan_text(cp.line_dedup(spark, docs, path))
    assert plan.split("(1) ")[0].count("ArrowEvalPython") == 1


def test_frugal_codec_gives_the_same_ids(spark):
    rows = [(i, " ".join(f"word{i * k} größe 東京 {k}" for k in range(40)) if i % 7 else None) for i in range(60)] + [(60, ""), (60, "x" * 2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    ids = lambda df: sorted(map(tuple, df.collect()))
    assert ids(bpe.bpe_digests(docs, frugal=True)) == ids(bpe.bpe_digests(docs))
    path = public_tokenizers.path(bpe.RANKS)
    own = bpe.codec(path)
    frugal = bpe.codec(path, True)
    assert list(bpe._CODECS) == [(path, True)] and frugal is bpe.codec(path, True) is not own
    bpe._drop_codecs()
