"""Token files, byte-level BPE and sharding against the public libraries and plain loops."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from statmart.llm import bpe, sharding, textunits, tokenfile
from statmart.llm.common import numbered

RANKS = public_tokenizers.path(bpe.RANKS)
VOCABULARY = public_tokenizers.path(tokenfile.VOCABULARY)
SIGNS = "abAB ''  \n\n\t.,!?12３é日本語 ̀ß🙂ñ\x00\x1c\x85st're<|endoftext|>"


def odd_texts(n=300, seed=3):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(SIGNS) for _ in range(rnd.randint(0, 60))) for _ in range(n)] + [
        "", " ", "\n", "a" * 20_000, "aab" * 800, "ab" * 900, "日本語" * 300, "it's '''s don'tyou  we're",
        "word " * 30_000, "x\n" * 5_000]


def documents(spark, texts, ids=None):
    rows = [(i, t, f"s{i}", 7, "x") for i, t in zip(ids or range(len(texts)), texts)]
    # extra columns carry names that the operators use themselves
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, part int, row_no string")


@pytest.fixture(scope="module")
def library():
    ranks = bpe.load_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_codec_equals_the_library(library):
    own, texts = bpe.Codec(RANKS), odd_texts(2000)
    ids, counts = own.encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [library.encode_ordinary(t) for t in texts]
    assert own.decode(ids, counts) == [t.encode() for t in texts]


def test_long_and_short_queries_agree():
    own = bpe.Codec(RANKS)
    words = [w for w in {w for t in odd_texts(500) for w in t.split()} if w and len(w) < 200]
    raw = [w.encode() for w in words]
    assert [x.tolist() for x in own._contract(raw, bpe.SHORT_SQL)] == \
        [x.tolist() for x in own._contract(raw, bpe.LONG_SQL)]


def test_very_long_words_in_pieces(monkeypatch):
    rnd, own = random.Random(5), bpe.Codec(RANKS)
    words = ["".join(rnd.choices(letters, k=k)).encode() for letters in
             ("ab", "aAbB", "abcdefghijklmnopqrstuvwxyz", "etaoinshrdlu", "日本語的了", "é̀абв") for k in (130, 600)]
    words += [w.encode() for w in ("a" * 3000, "ab" * 900, "the" * 300, "internationalization" * 30, " " * 2000, "=" * 999)]
    whole = [own._contract([w], bpe.LONG_SQL)[0].tolist() for w in words]
    for piece in (2, 7, bpe.PIECE):
        monkeypatch.setattr(bpe, "PIECE", piece)
        assert [own._contract_pieces(w).tolist() for w in words] == whole
    own.close()


def test_a_blob_without_blanks(library):
    """100,000 random characters are one match; the work follows the length."""
    blob = "".join(random.Random(3).choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", k=100_000))
    own = bpe.Codec(RANKS)
    ids, counts = own.encode([blob, "x"])
    assert ids[:counts[0]].tolist() == library.encode_ordinary(blob)
    assert own.decode(ids, counts) == [blob.encode(), b"x"]
    own.close()


def test_a_full_table_of_units_starts_over(library):
    own = bpe.Codec(RANKS, bound=64)
    for t in odd_texts(200):
        assert own.encode([t])[0].tolist() == library.encode_ordinary(t)


def test_units_never_cut_a_pattern_match():
    import regex
    match = regex.compile(public_tokenizers.PATTERN).findall
    rnd = random.Random(1)
    points = [chr(c) for c in [*range(0x3000), *range(0xFE00, 0x10000)] if not 0xD800 <= c < 0xE000]
    for _ in range(400):
        text = "".join(rnd.choice([rnd.choice(points), rnd.choice(" \n'aZ9.")]) for _ in range(80))
        cut, start, end, _ = textunits.cut([text])
        assert [w for a, b in zip(start, end) for w in match(text[a:b])] == match(text)


def test_bpe_digests(spark, library):
    texts = odd_texts() + [None, "same", "same"]
    got = {r[0]: r[1:] for r in bpe.bpe_digests(documents(spark, texts), RANKS).collect()}
    for i, t in enumerate(texts):
        ids = library.encode_ordinary(t or "")
        assert got[i] == (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
                          hashlib.sha256((t or "").encode()).hexdigest())
    assert bpe.bpe_digests(documents(spark, []), RANKS).count() == 0


def test_bpe_encode_and_decode_tables(spark, library):
    texts = odd_texts(50) + [None]
    ids = bpe.bpe_encode(documents(spark, texts), "doc_id", "text", RANKS)
    assert {r[0]: r[1] for r in ids.collect()} == {i: library.encode_ordinary(t or "") for i, t in enumerate(texts)}
    back = {r[0]: bytes(r[1]) for r in bpe.bpe_decode(ids, "doc_id", "ids", RANKS).collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(texts)}


@pytest.mark.parametrize("unit", ["bit", "byte"])
@pytest.mark.parametrize("n", [0, 1, 4095, 4096, 10_000])
def test_planes_round_trip(unit, n):
    ids = np.random.default_rng(n).integers(0, 1 << 31, n, dtype=np.uint32)
    assert (tokenfile.from_planes(tokenfile.to_planes(ids, unit=unit), n, unit=unit) == ids).all()


@pytest.mark.parametrize("unit", ["bit", "byte"])
def test_token_files_round_trip(spark, tmp_path, unit):
    texts = odd_texts() + [None, "twice", "twice"]
    ids = list(range(len(texts) - 2)) + [5000, 5000]
    order = list(range(len(texts)))
    random.Random(2).shuffle(order)
    docs = documents(spark, [texts[i] for i in order], [ids[i] for i in order])
    tokenfile.write_token_files(docs, str(tmp_path / "t"), VOCABULARY, chunk_ids=3000, unit=unit)
    own = Tokenizer.from_file(VOCABULARY)
    own.encode_special_tokens = True
    want, start = [], 0
    for i, t in zip(ids, texts):
        x = own.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, start, x))
        start += len(x)
    got = sorted((r[0], r[1], list(r[2])) for r in tokenfile.read_token_files(spark, str(tmp_path / "t")).collect())
    assert got == want
    sums = sorted(map(tuple, tokenfile.digest_token_files(spark, str(tmp_path / "t")).collect()))
    assert sums == [(i, s, len(x), zlib.crc32(np.array(x, dtype="<u4").tobytes())) for i, s, x in want]
    index = sorted(map(tuple, tokenfile.read_index(spark, str(tmp_path / "t")).select("first", "n_ids").collect()))
    assert len(index) > 5 and all(a + n == b for (a, n), (b, _) in zip(index, index[1:])) and sum(index[-1]) == start


def test_added_tokens_as_in_the_plain_call(spark, tmp_path):
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, end * 3, f"{end}\n\n x", f"it's{end}'s", end[:-1], f"<|endof{end}text|>", "", None,
             *(t + end * (i % 3) + t[:9] for i, t in enumerate(odd_texts(80, seed=8)))]
    plain = Tokenizer.from_file(VOCABULARY)
    tokenfile.write_token_files(documents(spark, texts), str(tmp_path / "t"), VOCABULARY, chunk_ids=500)
    want, start = [], 0
    for i, t in enumerate(texts):
        x = plain.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, start, x))
        start += len(x)
    assert want[0][2][:-1].count(50256) == 1
    got = sorted((r[0], r[1], list(r[2])) for r in tokenfile.read_token_files(spark, str(tmp_path / "t")).collect())
    assert got == want


@pytest.mark.parametrize("flags", [{"lstrip": True}, {"rstrip": True}, {"single_word": True}, {"normalized": True}, {}])
def test_added_tokens_of_any_kind(tmp_path, flags):
    from tokenizers import AddedToken
    own = Tokenizer.from_file(VOCABULARY)
    own.add_special_tokens([AddedToken("<sep>", **{"normalized": False, **flags}), AddedToken("<sep>>", normalized=False)])
    own.save(str(tmp_path / "v.json"))
    texts = ["a  <sep>  b", "a<sep>b <sep>> c", "<sep><|endoftext|><sep>", "", "none here", "x <sep>>>\n"]
    ids, counts = tokenfile.LibraryEncoder(str(tmp_path / "v.json"))(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == \
        [own.encode(t, add_special_tokens=False).ids for t in texts]


def test_token_files_of_an_empty_table(spark, tmp_path):
    tokenfile.write_token_files(documents(spark, []), str(tmp_path / "t"), VOCABULARY)
    assert tokenfile.read_token_files(spark, str(tmp_path / "t")).count() == 0


@pytest.mark.parametrize("total", [0, 1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation_is_a_bijection(total):
    p = sharding.permute(np.arange(total), total, seed=5)
    assert sorted(p.tolist()) == list(range(total))
    assert all(sharding.permute(np.array([i]), total, 5)[0] == p[i] for i in range(0, total, 97))


def test_feistel_shards(spark):
    ids = [3, 3, 3, None, 9, 1] + list(range(100, 300))
    df = spark.createDataFrame([(i, "x", 1, 2) for i in ids], "doc_id long, shard string, id int, d int")
    out = sharding.feistel_shards(df, ["doc_id"], 7, seed=11).collect()
    assert len(out) == len(ids) and all((r["id"], r["d"]) == (1, 2) for r in out)
    assert sorted(r["row_no"] for r in out) == list(range(len(ids)))
    slots = {}
    for r in out:
        assert (r["shard"], r["slot"]) == sharding.locate(r["row_no"], len(ids), 7, 11)
        slots.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(s) for s in slots.values()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_row = [r["doc_id"] for r in sorted(out, key=lambda r: r["row_no"])]
    assert by_row == sorted(ids, key=lambda i: (i is not None, i))
    assert sharding.feistel_shards(df.limit(0), ["doc_id"], 7).count() == 0
    with pytest.raises(ValueError):
        sharding.feistel_shards(df, ["doc_id"], 0)


def test_numbered_keeps_all_columns(spark):
    df = spark.createDataFrame([(2, "b", 5), (1, "a", 6)], "k int, o0 string, part int")
    assert sorted(map(tuple, numbered(df, ["k"], "t").collect())) == [(1, "a", 6, 0), (2, "b", 5, 1)]


def test_registered_queries(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r[0]: r[1] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    own = Tokenizer.from_file(VOCABULARY)
    at = 0
    for r in sorted(tokenfile.op2_bitplane_files(spark, sf).collect()):
        ids = own.encode(docs[r["doc_id"]], add_special_tokens=False).ids + [2]
        assert tuple(r) == (r["doc_id"], at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        at += len(ids)
    placed = sharding.op9_feistel_sharding(spark, sf).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in placed} == \
        {i: (len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in docs.items()}
