"""Token-id files of bit-plane shuffled, compressed blocks with a chunk index.

A file set is a folder of two Parquet tables written by Spark's committer, so it can
lie in any store that Spark writes to and a lost task is simply written again:

``chunks``: one row per chunk of consecutive documents, in ascending order of
    (part, seq). ``planes`` holds one zstandard frame per plane: the chunk's ids are cut
    into blocks of ``block`` ids (the last one padded with 0) and plane k is bit k (or
    byte k) of every id, block after block, packed. Planes above the highest set bit
    are left out. ``doc_ids`` and ``doc_tokens`` list the chunk's documents.
``index``: one row per chunk without the planes: part, seq, ``first`` (ids of all
    chunks before it), n_ids, n_docs, first and last doc_id.

A chunk closes at the document that brings it to ``chunk_ids`` ids, so no document is
ever split and every chunk can be read by itself.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.llm.common import table
from statmart.llm.textunits import UnitEncoder, slices
from statmart.session import scratch_path

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
BLOCK = 4096
CHUNK_IDS = 1 << 18

CHUNK_SCHEMA = ("part int, seq int, before long, n_ids long, block int, unit string, "
                "doc_ids array<bigint>, doc_tokens array<bigint>, planes array<binary>")


def to_planes(ids: np.ndarray, block: int = BLOCK, unit: str = "bit", level: int = 3) -> list[bytes]:
    """Compressed planes of unsigned 32-bit ids."""
    padded = np.zeros(-(-len(ids) // block) * block, dtype=np.uint32)
    padded[:len(ids)] = ids
    bits = int(padded.max()).bit_length() if len(padded) else 0
    pack = zstandard.ZstdCompressor(level=level).compress
    if unit == "byte":
        return [pack(((padded >> np.uint32(8 * k)) & np.uint32(255)).astype(np.uint8).tobytes())
                for k in range(-(-bits // 8))]
    return [pack(np.packbits((padded & np.uint32(1 << k)) != 0).tobytes()) for k in range(bits)]


def from_planes(planes: list[bytes], n_ids: int, block: int = BLOCK, unit: str = "bit") -> np.ndarray:
    """The ids back from their planes."""
    size = -(-n_ids // block) * block
    out = np.zeros(size, dtype=np.uint32)
    unpack = zstandard.ZstdDecompressor().decompress
    for k, p in enumerate(planes):
        raw = np.frombuffer(unpack(p), dtype=np.uint8)
        if unit == "byte":
            out |= raw.astype(np.uint32) << np.uint32(8 * k)
        else:
            out |= np.unpackbits(raw, count=size).astype(np.uint32) << np.uint32(k)
    return out[:n_ids]


class LibraryEncoder:
    """The ids that the public tokenizers library gives for whole texts.

    The library takes the strings of the file's added tokens out of a text first and
    encodes what stands between them on its own, and so does this, with units. A text
    with an added token that also looks at its surroundings goes to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        own = Tokenizer.from_file(path)
        self._whole = lambda texts: [e.ids for e in own.encode_batch_fast(texts, add_special_tokens=False)]
        self._units = UnitEncoder(self._whole)
        added = own.get_added_tokens_decoder()
        self._added = {t.content: i for i, t in added.items()}
        self._odd = [t.content for t in added.values() if t.single_word or t.lstrip or t.rstrip or t.normalized]
        longest_first = sorted(self._added, key=len, reverse=True)
        self._match = re.compile(f"({'|'.join(map(re.escape, longest_first))})")

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after another, and the number of ids per text."""
        if not any(c in t for t in texts for c in self._added):
            return self._units(texts)
        pieces, owner, single, before = [], [], [], []  # added ids, and the pieces before each
        for i, t in enumerate(texts):
            if any(c in t for c in self._odd):
                ids = self._whole([t])[0]
                single += ids
                before += [len(pieces)] * len(ids)
                owner += [i] * len(ids)
            elif any(c in t for c in self._added):
                for k, x in enumerate(self._match.split(t)):
                    if k % 2:
                        single.append(self._added[x])
                        before.append(len(pieces))
                        owner.append(i)
                    else:
                        pieces.append((i, x))
            else:
                pieces.append((i, t))
        flat, counts = self._units([x for _, x in pieces])
        ends = np.concatenate([[0], np.cumsum(counts)])
        total = np.bincount(np.array([i for i, _ in pieces], dtype=np.int64), weights=counts, minlength=len(texts)) \
            + np.bincount(np.array(owner, dtype=np.int64), minlength=len(texts))
        return np.insert(flat, ends[before], np.array(single, dtype=np.uint32)), total.astype(np.int64)


_ENCODERS: dict[str, LibraryEncoder] = {}


def library_encoder(path: str) -> LibraryEncoder:
    """The process's encoder of a vocabulary file, kept for later tasks of the same worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = LibraryEncoder(path)
    return _ENCODERS[path]


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int = END_ID, block: int = BLOCK,
                      chunk_ids: int = CHUNK_IDS, unit: str = "bit") -> None:
    """Encode ``text`` of every row and write the files in ascending doc_id order.

    A null text is empty and gives the end id alone. Null doc_ids come first; rows with
    one doc_id follow the hash of their text, equal rows are each written. An empty
    table gives files without rows.
    """
    spark = docs.sparkSession

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(path)
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        names: list = []
        sizes: list[int] = []
        held = 0

        def row() -> pa.RecordBatch:
            planes = to_planes(np.concatenate(ids), block, unit)
            return pa.RecordBatch.from_pylist(
                [{"part": part, "seq": seq, "before": before, "n_ids": held, "block": block, "unit": unit,
                  "doc_ids": names, "doc_tokens": sizes, "planes": planes}], schema=layout)

        for batch in batches:
            at = 0
            for texts in slices(batch.column(1)):
                flat, counts = encoder(texts)
                ends = np.cumsum(counts)
                whole = np.insert(flat, ends, end_id).astype(np.uint32)  # the end id after each document
                where = np.concatenate([[0], ends + np.arange(1, len(texts) + 1)])
                keys = batch.column(0).slice(at, len(texts)).to_pylist()
                at += len(texts)
                for k, (a, b) in enumerate(zip(where[:-1].tolist(), where[1:].tolist())):
                    ids.append(whole[a:b])
                    names.append(keys[k])
                    sizes.append(b - a)
                    held += b - a
                    if held >= chunk_ids:
                        yield row()
                        before, seq = before + held, seq + 1
                        ids, names, sizes, held = [], [], [], 0
        if names:
            yield row()

    layout = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()),
                        ("block", pa.int32()), ("unit", pa.string()), ("doc_ids", pa.list_(pa.int64())),
                        ("doc_tokens", pa.list_(pa.int64())), ("planes", pa.list_(pa.binary()))])
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
     .repartitionByRange(parts, *order).sortWithinPartitions(*order)
     .mapInArrow(chunks, CHUNK_SCHEMA).write.parquet(f"{folder}/chunks"))
    stored = spark.read.schema(CHUNK_SCHEMA).parquet(f"{folder}/chunks")
    base, total = [], 0
    for r in sorted(stored.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()):  # a row per partition
        base.append((r["part"], total))
        total += r["n"]
    starts = spark.createDataFrame(base, "part int, base long")
    (stored.select("part", "seq", "before", "n_ids", F.size("doc_ids").alias("n_docs"),
                   F.element_at("doc_ids", 1).alias("first_doc"), F.element_at("doc_ids", -1).alias("last_doc"))
     .join(F.broadcast(starts), "part")
     .select("part", "seq", (F.col("base") + F.col("before")).alias("first"), "n_ids", "n_docs",
             "first_doc", "last_doc", "base")
     .write.parquet(f"{folder}/index"))


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/index")


def _chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Chunk rows with ``base``, the ids before their partition: one value per partition."""
    base = read_index(spark, folder).select("part", "base").distinct()
    return spark.read.schema(CHUNK_SCHEMA).parquet(f"{folder}/chunks").join(F.broadcast(base), "part")


def _documents(batch: pa.RecordBatch) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each chunk: doc_ids, global starts, numbers of ids, and all ids."""
    for r in batch.to_pylist():
        ids = from_planes(r["planes"], r["n_ids"], r["block"], r["unit"])
        sizes = np.asarray(r["doc_tokens"], dtype=np.int64)
        yield r["doc_ids"], r["base"] + r["before"] + np.cumsum(sizes) - sizes, sizes, ids


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, ids of every document, from the files alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, starts, sizes, ids in _documents(batch):
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(ids.astype(np.int64)))
                yield pa.record_batch([pa.array(names, pa.int64()), pa.array(starts), lists],
                                      names=["doc_id", "start", "ids"])
    return _chunks(spark, folder).mapInArrow(run, "doc_id long, start long, ids array<bigint>")


def digest_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and the checksum of the ids of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, starts, sizes, ids in _documents(batch):
                raw = memoryview(ids.astype("<u4").tobytes())
                ends = (4 * np.cumsum(sizes)).tolist()
                sums = [zlib.crc32(raw[a:b]) for a, b in zip([0, *ends[:-1]], ends)]
                yield pa.record_batch([pa.array(names, pa.int64()), pa.array(starts), pa.array(sizes),
                                       pa.array(sums, pa.int64())],
                                      names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return _chunks(spark, folder).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op2_bitplane_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as bit-plane files and read back."""
    folder = scratch_path(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(VOCABULARY))
    return digest_token_files(spark, folder)
