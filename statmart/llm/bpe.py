"""Byte-level BPE encoding and decoding with DuckDB recursive queries inside each task.

Texts are cut into units (:mod:`statmart.llm.textunits`), units into pattern matches,
and every distinct match that the task has not met yet becomes rows (word, position,
token). A recursive query joins neighbouring tokens with the merge table and
contracts, in each step and word, the leftmost pair of least rank, until no word has a
pair left. A match that is itself in the vocabulary is its own token, as in the public
library. Decoding joins ids with the vocabulary and puts the bytes of each text
together by an ordered aggregation.

Long matches use ``LONG_SQL``: in one step it contracts every pair of the least rank
that contracting one by one, left to right, would reach: every other one in a run of
such pairs, and only the leftmost while some token of the word could join the new one
at a lower rank (``risky``). The number of steps then follows the number of different
merges and not the length. Both queries give the same ids.

Very long matches are contracted in pieces of ``PIECE`` bytes, so the work grows with their
length. Ids are those of the whole match exactly if each two neighbouring ones are what
their own bytes contract to: a first pair contracted across two of them would also be the
least one of those bytes alone. Pairs inside a piece are so by its own contraction. Over a
seam the second half of the ids before it and the first half of those behind it are
contracted once more; if the outermost two come out unchanged, all pairs are proven, and
if not, the two pieces become one and are contracted again.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from statmart.llm.common import HELD, lean, table
from statmart.llm.textunits import SLICE, UnitEncoder, slices

RANKS = "byte_bpe_multi_50k.tiktoken"
LONG = 64  # bytes; from here on LONG_SQL
PIECE = 32  # bytes of a piece of a very long word
VERY_LONG = 512  # bytes; from here on in pieces
CHUNK = 1 << 17  # bytes of words, or ids to decode, in one query; bounds its memory
FRUGAL = 1 << 18  # characters at once, and known units, of a codec that takes more time and less memory

SHORT_SQL = """
WITH RECURSIVE step AS (
    SELECT w, pos, id, false AS done FROM start
    UNION ALL
    SELECT t.w, t.pos, CASE WHEN t.pos = best.spot THEN best.low ELSE t.id END, best.w IS NULL
    FROM (SELECT w, pos, id, lag(pos) OVER (PARTITION BY w ORDER BY pos) AS before
          FROM step WHERE NOT done) t
    LEFT JOIN (SELECT s.w, min(m.made) AS low,
                      CAST(min(CAST(m.made AS BIGINT) * 4294967296 + s.pos) % 4294967296 AS INTEGER) AS spot
               FROM (SELECT w, pos, id, lead(id) OVER (PARTITION BY w ORDER BY pos) AS next
                     FROM step WHERE NOT done) s
               JOIN merges m ON m.l = s.id AND m.r = s.next
               GROUP BY s.w) best ON best.w = t.w
    WHERE best.spot IS NULL OR t.before IS NULL OR t.before <> best.spot
)
SELECT w, id FROM step WHERE done ORDER BY w, pos
"""

LONG_SQL = """
WITH RECURSIVE step AS (
    SELECT w, pos, id, false AS done FROM start
    UNION ALL
    (WITH pair AS (
        SELECT s.w, s.pos, s.id, s.place, m.made
        FROM (SELECT w, pos, id, lead(id) OVER o AS next, row_number() OVER o AS place
              FROM step WHERE NOT done WINDOW o AS (PARTITION BY w ORDER BY pos)) s
        LEFT JOIN merges m ON m.l = s.id AND m.r = s.next),
     best AS (
        SELECT w, min(made) AS low,
               CAST(min(CAST(made AS BIGINT) * 4294967296 + pos) % 4294967296 AS INTEGER) AS spot
        FROM pair WHERE made IS NOT NULL GROUP BY w),
     single AS (
        SELECT DISTINCT best.w FROM best JOIN risky x ON x.made = best.low
        JOIN pair ON pair.w = best.w AND (pair.id = x.other OR x.other = best.low)),
     least AS (
        SELECT pair.w, pair.pos, pair.id, pair.place, best.low, best.spot, single.w IS NULL AS many,
               coalesce(pair.made = best.low, false) AS candidate
        FROM pair LEFT JOIN best ON best.w = pair.w LEFT JOIN single ON single.w = pair.w),
     runs AS (
        SELECT *, place - row_number() OVER (PARTITION BY w, candidate ORDER BY pos) AS run FROM least),
     chosen AS (
        SELECT *, candidate AND (pos = spot OR many AND
               row_number() OVER (PARTITION BY w, candidate, run ORDER BY pos) % 2 = 1) AS hit FROM runs)
     SELECT w, pos, CASE WHEN hit THEN low ELSE id END, low IS NULL
     FROM (SELECT *, lag(hit, 1, false) OVER (PARTITION BY w ORDER BY pos) AS taken FROM chosen)
     WHERE NOT taken)
)
SELECT w, id FROM step WHERE done ORDER BY w, pos
"""

DECODE_SQL = """
SELECT doc, string_agg(v.bytes, '' ORDER BY i.pos) AS bytes
FROM ids i JOIN vocab v ON v.id = i.id GROUP BY doc ORDER BY doc
"""


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Codec:
    """Encoder and decoder of one rank file; holds its tables in a DuckDB of its own.

    The database lives in the memory of the task's process, is bounded and writes no files.
    With ``frugal`` it gives memory back after every query.
    """

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN, bound: int = 1 << 20, frugal: bool = False):
        self._ranks = load_ranks(path)
        self._pattern = regex.compile(pattern)
        self._byte = np.array([self._ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self._size = np.zeros(max(self._ranks.values()) + 1, dtype=np.int32)
        self._size[list(self._ranks.values())] = [len(t) for t in self._ranks]
        merges = [(self._ranks[t[:k]], self._ranks[t[k:]], i) for t, i in self._ranks.items()
                  for k in range(1, len(t)) if t[:k] in self._ranks and t[k:] in self._ranks]
        # a token and a neighbour that it joins at a rank below its own
        risky = {p for l, r, made in merges for p in ((l, r), (r, l)) if made < p[0]}
        flush = {"allocator_flush_threshold": "1MB", "allocator_bulk_deallocation_flush_threshold": "1MB"} if frugal else {}
        self._db = duckdb.connect(config={"threads": 1, "memory_limit": "500MB", "temp_directory": "", **flush})
        self._put("merges", *zip(*merges), names=("l", "r", "made"))
        self._put("risky", *(zip(*sorted(risky)) if risky else ((), ())), names=("made", "other"))
        shown = pa.table({"id": pa.array(list(self._ranks.values()), pa.int32()),
                          "bytes": pa.array(["".join(chr(256 + b) for b in t) for t in self._ranks])})
        self._db.register("shown", shown)
        self._db.execute("CREATE TABLE vocab AS SELECT * FROM shown")
        self._units = UnitEncoder(self._encode_units, bound)

    def close(self) -> None:
        self._db.close()

    def _put(self, name: str, *columns, names: tuple[str, ...]) -> None:
        data = pa.table({n: pa.array(c, pa.int32()) for n, c in zip(names, columns)})
        self._db.register("given", data)
        self._db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")

    def _contract(self, words: list[bytes], sql: str) -> list[np.ndarray]:
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        first = np.cumsum(size) - size
        self._db.register("start", pa.table({
            "w": np.repeat(np.arange(len(words), dtype=np.int32), size),
            "pos": (np.arange(int(size.sum())) - np.repeat(first, size)).astype(np.int32),
            "id": self._byte[np.frombuffer(b"".join(words), dtype=np.uint8)]}))
        got = self._db.execute(sql).fetchnumpy()
        counts = np.bincount(np.asarray(got["w"]), minlength=len(words))
        return np.split(np.asarray(got["id"]).astype(np.uint32), np.cumsum(counts)[:-1])

    def _contract_all(self, words: list[bytes]) -> dict[bytes, np.ndarray]:
        """Contracted ids of each distinct word, some words in one query."""
        out: dict[bytes, np.ndarray] = {}
        for sql, long in ((SHORT_SQL, False), (LONG_SQL, True)):
            some, size = [], 0
            for b in dict.fromkeys(words):
                if (len(b) >= LONG) != long:
                    continue
                some.append(b)
                size += len(b)
                if size >= CHUNK:
                    out.update(zip(some, self._contract(some, sql)))
                    some, size = [], 0
            if some:
                out.update(zip(some, self._contract(some, sql)))
        return out

    def _contract_pieces(self, word: bytes) -> np.ndarray:
        """Ids of one very long word, contracted in pieces (see the module's docstring)."""
        pieces = [word[at:at + PIECE] for at in range(0, len(word), PIECE)]
        ids: list[np.ndarray | None] = [None] * len(pieces)
        seams: list[np.ndarray | None] = [None] * (len(pieces) - 1)  # ids of the window over each proven seam
        while True:
            new = self._contract_all([b for b, own in zip(pieces, ids) if own is None])
            ids = [new[b] if own is None else own for b, own in zip(pieces, ids)]
            half = [len(own) // 2 for own in ids]
            cut = [int(self._size[own[:n]].sum()) for own, n in zip(ids, half)]
            # a piece of one token has no first half: the seam before it stays open
            windows = {s: pieces[s][cut[s]:] + pieces[s + 1][:cut[s + 1]]
                       for s, known in enumerate(seams) if known is None and half[s + 1]}
            got = self._contract_all(list(windows.values()))
            for s, window in windows.items():
                over = got[window]
                if over[0] == ids[s][half[s]] and over[-1] == ids[s + 1][half[s + 1] - 1]:
                    seams[s] = over
            if all(known is not None for known in seams):
                return np.concatenate([ids[0][:half[0]], *seams, ids[-1][half[-1]:]])
            # pieces with an open seam between them become one, and seams beside it are open again
            joined, kept, open_ids = [], [], []
            first = 0
            for last in range(len(pieces)):
                if last < len(seams) and seams[last] is None:
                    continue
                alone = first == last
                joined.append(b"".join(pieces[first:last + 1]))
                open_ids.append(ids[first] if alone else None)
                if last < len(seams):
                    kept.append(seams[last])
                first = last + 1
            pieces, ids = joined, open_ids
            seams = [known if ids[s] is not None and ids[s + 1] is not None else None for s, known in enumerate(kept)]

    def encode_words(self, words: list[str]) -> dict[str, np.ndarray]:
        """Ids of each distinct pattern match."""
        out: dict[str, np.ndarray] = {}
        rest = {}
        for w in words:
            b = w.encode()
            whole = self._ranks.get(b)
            if whole is not None:
                out[w] = np.array([whole], dtype=np.uint32)
            elif len(b) >= VERY_LONG:
                out[w] = self._contract_pieces(b)
            else:
                rest[w] = b
        ids = self._contract_all(list(rest.values()))
        out.update((w, ids[b]) for w, b in rest.items())
        return out

    def _encode_units(self, units: list[str]) -> list[np.ndarray]:
        split = [self._pattern.findall(u) for u in units]
        ids = self.encode_words(list(dict.fromkeys(w for ws in split for w in ws)))
        return [ids[ws[0]] if len(ws) == 1 else np.concatenate([ids[w] for w in ws]) for ws in split]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after another, and the number of ids per text."""
        return self._units(texts)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each text."""
        out = [b""] * len(counts)
        ends = np.cumsum(counts)
        first = 0
        while first < len(counts):  # whole texts, about CHUNK ids at once
            start = int(ends[first] - counts[first])
            last = max(first + 1, int(np.searchsorted(ends, start + CHUNK, side="right")))
            part = ids[start:int(ends[last - 1])]
            if len(part):
                self._db.register("ids", pa.table({
                    "doc": np.repeat(np.arange(first, last, dtype=np.int32), counts[first:last]),
                    "pos": np.arange(len(part), dtype=np.int64), "id": part.astype(np.int32)}))
                for doc, s in self._db.execute(DECODE_SQL).fetchall():
                    out[doc] = (np.frombuffer(s.encode("utf-16-le"), dtype="<u2") - 256).astype(np.uint8).tobytes()
            first = last
        return out


_CODECS: dict[tuple[str, bool], Codec] = {}


def codec(path: str, frugal: bool = False) -> Codec:
    """The process's codec of a rank file, kept for later tasks of the same worker."""
    if (path, frugal) not in _CODECS:
        if (other := _CODECS.pop((path, not frugal), None)) is not None:
            other.close()
        _CODECS[path, frugal] = Codec(path, bound=FRUGAL, frugal=True) if frugal else Codec(path)
    return _CODECS[path, frugal]


def _drop_codecs() -> None:
    while _CODECS:
        _CODECS.popitem()[1].close()


HELD["codecs"] = _drop_codecs


def bpe_encode(df: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """``id_col`` and ``ids`` (array of long) of every row; a null text has no ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            done = 0
            for part in slices(batch.column(1)):
                ids, counts = own.encode(part)
                yield pa.record_batch([batch.column(0).slice(done, len(part)), pa.LargeListArray.from_arrays(
                    np.concatenate([[0], np.cumsum(counts)]), ids.astype(np.int64)).cast(pa.list_(pa.int64()))],
                    names=[id_col, "ids"])
                done += len(part)
    kept = df.select(id_col, text_col)
    return kept.mapInArrow(run, f"`{id_col}` {kept.schema[0].dataType.simpleString()}, ids array<bigint>")


def bpe_decode(df: DataFrame, id_col: str, ids_col: str, path: str) -> DataFrame:
    """``id_col`` and ``bytes`` (binary) of every row; null or no ids give no bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = [np.asarray(x or [], dtype=np.int64) for x in part.column(1).to_pylist()]
                raw = own.decode(np.concatenate(lists), np.array([len(x) for x in lists]))
                yield pa.record_batch([part.column(0), pa.array(raw, pa.binary())], names=[id_col, "bytes"])
    kept = df.select(id_col, ids_col)
    return kept.mapInArrow(run, f"`{id_col}` {kept.schema[0].dataType.simpleString()}, bytes binary")


def bpe_digests(docs: DataFrame, path: str | None = None, frugal: bool = False) -> DataFrame:
    """Encode and decode the text of every row in one pass over the table.

    Null and empty texts have no ids; repeated rows each give a row; columns other
    than doc_id and text are not read. ``frugal`` works on fewer texts at once and keeps
    fewer units, for jobs whose other stages leave little memory.
    """
    path = path or public_tokenizers.path(RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, frugal)
        for batch in batches:
            done = 0
            for part in slices(batch.column(1), FRUGAL if frugal else SLICE):
                ids, counts = own.encode(part)
                raw = ids.astype("<u4").tobytes()
                ends = np.cumsum(counts).tolist()
                yield pa.record_batch([
                    batch.column(0).slice(done, len(part)), pa.array(counts, pa.int64()),
                    pa.array([hashlib.sha256(raw[4 * (e - n):4 * e]).hexdigest()
                              for e, n in zip(ends, counts.tolist())], pa.string()),
                    pa.array([hashlib.sha256(b).hexdigest() for b in own.decode(ids, counts)], pa.string()),
                ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                done += len(part)
    return docs.select("doc_id", "text").mapInArrow(
        lean(run, keeps="codecs"), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by the multi-language rank file and decoded again."""
    return bpe_digests(table(spark, sf_dir, "documents"))
