"""Ranked lexical search with per-term geometric blocking.

Documents are indexed shard by shard, each of bounded size, as the tasks read them; the
corpus' counts (documents, terms, document frequencies) are taken over all documents
first. In a shard a term's posting list is clustered by the similarity of its documents
into blocks of at most ``BLOCK``, and every block stores the coordinatewise maximum of
its documents' vectors of impacts.

A query walks its terms from the heaviest to the lightest. A document that holds an
earlier term has been scored with that term's list or skipped for good, so a block's bound
takes only the terms from the current one on: their weights times the block's maxima. A
block is skipped only where this bound is below the query's 50th best score so far, and
the rest of the lists when the same bound over the whole shard is. Bounds and scores are
exact integers, so the answer is that of scoring every document. Lists that no query
reaches are never blocked.

The first thresholds come from a search over ``SEED_ROWS`` documents; they only spare work.
Each task returns its best for each query, and a ranked window brings them together.
Queries are taken in blocks of a bounded number of terms.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statmart.llm.common import stored, table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
BREAK = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
BEST = 50
BLOCK = 128  # documents in a block
SHARD_DOCS, SHARD_POSTINGS = 4096, 1 << 19
SKETCH = 24  # dimensions in which documents are compared for clustering
KEPT = 1 << 26  # bytes of blocks' maxima a shard keeps at once
SEED_ROWS = 4096
QUERY_TERMS = 16_384  # terms of one block of queries; a larger single item is a block of its own
PIECE = 1 << 20  # characters split into terms at once


def terms_of(text: str | None) -> Iterator[list[str]]:
    """The terms of a whole text, some at a time: runs of letters, digits and non-ASCII, A-Z in lower case."""
    text, at = text or "", 0
    while at < len(text):
        cut = BREAK.search(text, at + PIECE) if at + PIECE < len(text) else None
        end = cut.start() if cut else len(text)
        part = text[at:end]
        yield TERM.findall(part.lower() if part.isascii() else part.translate(LOWER))
        at = end


def weight(df: int, n: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, length: np.ndarray, n: int, total: int) -> np.ndarray:
    """The integer impact of a term that occurs ``tf`` times among ``length`` terms."""
    m = 50 + (50 * length * n) // total
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def gather(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions of all runs, run after run."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))


class Best:
    """The best documents of one query so far: highest score, then smallest doc_id."""

    def __init__(self, threshold: int, size: int = BEST):
        self.size, self.threshold = size, max(1, threshold)
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        on = scores >= self.threshold
        if not on.any():
            return
        scores, ids = np.concatenate([self.scores, scores[on]]), np.concatenate([self.ids, ids[on]])
        order = np.lexsort((ids, -scores))[:self.size]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.size:
            self.threshold = max(self.threshold, int(self.scores[-1]))


class Shard:
    """The documents of a shard as sparse vectors of impacts, and the blocked lists of its terms.

    ``docs`` are ids, ``counts`` the number of coordinates of each document; ``terms`` and
    ``values`` hold the coordinates document after document.
    """

    def __init__(self, docs: np.ndarray, counts: np.ndarray, terms: np.ndarray, values: np.ndarray, weights: np.ndarray):
        self.docs, self.counts, self.terms, self.values, self.weights = docs, counts, terms, values, weights
        self.first = np.cumsum(counts) - counts
        self.width = len(weights)
        order = np.argsort(terms, kind="stable")
        self.posted = np.repeat(np.arange(len(docs)), counts)[order]
        self.list_at = np.searchsorted(terms[order], np.arange(self.width + 1))
        self.most = np.zeros(self.width, dtype=np.int64)
        np.maximum.at(self.most, terms, values)
        self._lists: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray | None]] = {}
        self._bytes, self._sketch = 0, None

    def sketches(self) -> np.ndarray:
        """Every document's weighted vector in ``SKETCH`` random directions, of length one."""
        if self._sketch is None:
            directions = np.random.default_rng(11).normal(size=(self.width, SKETCH)).astype(np.float32)
            out = np.zeros((len(self.docs) + 1, SKETCH), dtype=np.float32)
            for a in range(0, len(self.docs), 256):
                b = min(a + 256, len(self.docs))
                rows = slice(self.first[a], self.first[b - 1] + self.counts[b - 1])
                x = directions[self.terms[rows]] * (self.values[rows] * self.weights[self.terms[rows]])[:, None].astype(np.float32)
                some = np.flatnonzero(self.counts[a:b])
                out[a + some] = np.add.reduceat(x, self.first[a + some] - self.first[a], axis=0)
            norm = np.linalg.norm(out, axis=1, keepdims=True)
            self._sketch = out / np.where(norm > 0, norm, 1)
        return self._sketch

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """A term's documents in block order, the block of each, and the blocks' maxima (None: one block)."""
        if term in self._lists:
            return self._lists[term]
        docs = self.posted[self.list_at[term]:self.list_at[term + 1]]
        block, maxima = np.zeros(len(docs), dtype=np.int64), None
        if len(docs) > BLOCK:
            sketch, k = self.sketches(), -(-len(docs) // BLOCK)
            centres = docs[np.linspace(0, len(docs) - 1, k).astype(np.int64)]
            near = sketch[docs] @ sketch[centres].T
            cluster = near.argmax(axis=1)
            order = np.lexsort((-near[np.arange(len(docs)), cluster], cluster))
            docs, cluster = docs[order], cluster[order]
            inside = np.arange(len(docs)) - np.searchsorted(cluster, cluster)
            new = np.ones(len(docs), dtype=bool)
            new[1:] = (cluster[1:] != cluster[:-1]) | (inside[1:] % BLOCK == 0)
            block = np.cumsum(new) - 1
            n = self.counts[docs]
            at = gather(self.first[docs], n)
            maxima = np.zeros((block[-1] + 1, self.width), dtype=np.int32)
            np.maximum.at(maxima.reshape(-1), np.repeat(block, n) * self.width + self.terms[at], self.values[at].astype(np.int32))
            self._bytes += maxima.nbytes
            if self._bytes > KEPT:
                self._lists, self._bytes = {}, maxima.nbytes
        self._lists[term] = docs, block, maxima
        return self._lists[term]

    def search(self, query: np.ndarray, best: Best) -> int:
        """Score what may enter ``best``; returns the number of documents scored."""
        query = query[(self.most[query] > 0) & (self.weights[query] > 0)]
        query = query[np.lexsort((query, -self.weights[query]))]
        own = np.zeros(self.width, dtype=np.int64)
        own[query] = self.weights[query]
        left = np.cumsum((self.most[query] * own[query])[::-1])[::-1]
        seen, scored = np.zeros(len(self.docs), dtype=bool), 0
        for i, term in enumerate(query):
            if left[i] < best.threshold:
                break
            docs, block, maxima = self.blocks(int(term))
            if maxima is not None:
                rest = query[i:]
                bound = maxima[:, rest].astype(np.int64) @ own[rest]
                docs = docs[(bound >= best.threshold)[block]]
            docs = docs[~seen[docs]]
            if not len(docs):
                continue
            seen[docs] = True
            n = self.counts[docs]
            at = gather(self.first[docs], n)
            scores = np.add.reduceat(own[self.terms[at]] * self.values[at], np.cumsum(n) - n)
            best.add(scores, self.docs[docs])
            scored += len(docs)
        return scored


def forward_rows(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """Per document its id, number of terms, and codes and counts of those in ``vocabulary``.

    Documents without a term are left out: they count nowhere and are found by nothing.
    """
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = known.value
        for batch in batches:
            for a in range(0, len(batch), 64):
                out = ([], [], [], [])
                for doc, text in zip(*[c.slice(a, 64).to_pylist() for c in batch.columns]):
                    n, own = 0, Counter()
                    for words in terms_of(text):
                        n += len(words)
                        own.update(filter(codes.__contains__, words))
                    if n:
                        for column, value in zip(out, (doc, n, [codes[w] for w in own], list(own.values()))):
                            column.append(value)
                if out[0]:
                    yield pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                                           pa.array(out[2], pa.list_(pa.int32())), pa.array(out[3], pa.list_(pa.int64()))],
                                          names=["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(count, "doc_id long, n long, terms array<int>, tfs array<long>")


NO_ID = np.iinfo(np.int64).max  # stands for a null doc_id, which comes last among equals


def _shards(batches: Iterator[pa.RecordBatch], weights: np.ndarray, n: int, total: int) -> Iterator[Shard]:
    """Shards of bounded size from rows of a forward table."""
    parts: list[tuple] = []
    docs = postings = 0

    def made() -> Shard:
        ids, lengths, counts, terms, tfs = (np.concatenate(c) for c in zip(*parts))
        return Shard(ids, counts, terms, impacts(tfs, np.repeat(lengths, counts), n, total), weights)

    for batch in batches:
        for a in range(0, len(batch), 64):
            rows = batch.slice(a, 64)
            terms, tfs = rows.column(2), rows.column(3)
            counts = np.diff(terms.offsets.to_numpy()).astype(np.int64)
            parts.append((rows.column(0).fill_null(NO_ID).to_numpy(), rows.column(1).to_numpy(), counts,
                          terms.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy()))
            docs, postings = docs + len(rows), postings + int(counts.sum())
            if docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                yield made()
                parts, docs, postings = [], 0, 0
    if parts:
        yield made()


FOUND = "query int, doc_id long, score long, scored long"


def _search(forward: DataFrame, queries: list[np.ndarray], weights: np.ndarray, n: int, total: int,
            thresholds: list[int]) -> DataFrame:
    """The best documents of every query in each task's part of ``forward``."""
    shared = forward.sparkSession.sparkContext.broadcast((queries, weights, thresholds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights, thresholds = shared.value
        best, scored = [Best(t) for t in thresholds], np.zeros(len(queries), dtype=np.int64)
        for shard in _shards(batches, weights, n, total):
            for q, query in enumerate(queries):
                scored[q] += shard.search(query, best[q])
        size = np.array([len(b.ids) for b in best], dtype=np.int64)
        if size.sum():
            ids = np.concatenate([b.ids for b in best])
            yield pa.record_batch([pa.array(np.repeat(np.arange(len(best)), size), pa.int32()),
                                   pa.array(ids, pa.int64(), mask=ids == NO_ID),
                                   pa.array(np.concatenate([b.scores for b in best])), pa.array(np.repeat(scored, size))],
                                  names=["query", "doc_id", "score", "scored"])

    return forward.mapInArrow(run, FOUND)


def _ranked(found: DataFrame) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= BEST)


def _query_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, set[str]]]]:
    """Items with their terms, in blocks of a bounded number of different terms."""
    block, vocabulary, last = [], set(), object()
    for item, text in items.select(F.col("item_id").cast("long"), "text").orderBy("item_id").toLocalIterator():
        own = set().union(*terms_of(text))
        if block and item == last:  # rows of one item are one query
            block[-1][1].update(own)
            vocabulary |= own
            continue
        if block and len(vocabulary | own) > QUERY_TERMS:
            yield block
            block, vocabulary = [], set()
        block.append((item, own))
        vocabulary |= own
        last = item
    if block:
        yield block


RESULT = "item_id long, rank int, doc_id long, score long"


def search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, rank, doc_id and score of the best documents (doc_id, text) of every item (item_id, text).

    Null and empty texts have no terms: such documents are not found and not counted, such
    items have no rows. Rows that repeat a doc_id are documents of their own; a null doc_id
    comes last among equal scores. Rows that repeat an item_id (null too) are one item of
    all their terms. Empty tables give no rows, other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    results = []
    for block in _query_blocks(items):
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*(own for _, own in block))))}
        if not vocabulary:
            continue
        forward = stored(forward_rows(docs, vocabulary), "forward")
        n, total = forward.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n:
            break
        df = np.zeros(len(vocabulary), dtype=np.int64)  # at most one row per term of the block
        for r in forward.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            df[r["t"]] = r["count"]
        weights = np.array([weight(int(f), n) for f in df], dtype=np.int64)
        queries = [np.array(sorted(vocabulary[t] for t in own), dtype=np.int64) for _, own in block]
        seed = _ranked(_search(forward.limit(SEED_ROWS), queries, weights, n, total, [1] * len(queries))) \
            .where(F.col("rank") == BEST).select("query", "score").collect()  # one row per query
        thresholds = [1] * len(queries)
        for r in seed:
            thresholds[r["query"]] = r["score"]
        ids = spark.createDataFrame([(q, item) for q, (item, _) in enumerate(block)], "query int, item_id long")
        found = _ranked(_search(forward, queries, weights, n, total, thresholds))
        results.append(found.join(F.broadcast(ids), "query").select("item_id", "rank", "doc_id", "score"))
    if not results:
        return spark.createDataFrame([], RESULT)
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def op11_geometric_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for each benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH words AS (
    SELECT doc_id, row_number() OVER () AS r,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents),
sizes AS (SELECT doc_id, r, w, CAST(len(w) AS BIGINT) AS n FROM words WHERE len(w) > 0),
corpus AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(n) AS BIGINT) AS l FROM sizes),
wanted AS (
    SELECT DISTINCT item_id, unnest(
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark),
postings AS (
    SELECT doc_id, r, n, term, count(*) AS tf
    FROM (SELECT doc_id, r, n, unnest(w) AS term FROM sizes)
    WHERE term IN (SELECT term FROM wanted)
    GROUP BY doc_id, r, n, term),
weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), corpus),
scores AS (
    SELECT item_id, doc_id, r,
           CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + ((50 * n * nn) // l))))) AS BIGINT) AS score
    FROM wanted JOIN postings USING (term) JOIN weights USING (term), corpus
    GROUP BY item_id, doc_id, r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
      FROM scores WHERE score > 0)
WHERE rank <= 50
"""
