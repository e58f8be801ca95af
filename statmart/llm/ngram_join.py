"""Similarity join of documents on word shingles: rare-first prefix filtering.

Two documents link when the Jaccard similarity of their shingle sets reaches the
threshold. Shingles are ordered rarest first, by counts over the whole corpus kept in a
table of fixed size, ties by hash. Of two linked documents the first
``n - ceil(0.8 n) + l`` shingles have at least ``l`` in common, so

1. documents with equal sets become one node, which keeps exact copies out of the join;
2. the prefixes are joined on the shingle, a slice of the shingles at a time, and only nodes
   stay that share as many of their prefix shingles as a linked node must;
3. the nodes left are dealt into classes by the node most of their shingles point to, and
   classes are merged into clusters where a node has as many shingles in another class as a
   link takes. Nodes that share a few shingles by chance, as most do in a large corpus, do
   not chain up, and a shingle with very many nodes gives as many rows and no pairs;
4. inside a cluster, pairs that meet in a prefix shingle pass a length, a positional and
   a suffix filter (the histogram of hashes bounds the overlap from above) and are
   verified once; a large cluster is dealt out as pairs of blocks. A group returns a
   spanning star per linked set and the number of links, never the pairs;
5. linked nodes are connected, and every document gets the smallest doc_id of its set.

Every choice of the order gives the same links; the counts only make the join cheap.
Shingles are told apart by 64-bit hashes, equal sets by 64-bit sums of these.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.llm.common import discard, lean, release_memory, stored, table
from statmart.llm.components import connected_components
from statmart.llm.textunits import finish, slices, span_hashes

WORDS = 5
CELLS_LOG2 = 20  # cells of the count table
BLOCK = 2048  # nodes of a cluster that one side of a group holds
SPARE = 16  # one shingle in so many is asked for beyond the first in a shared prefix
TOGETHER = 1 << 18  # postings looked at in one step of a comparison
LARGE = 1 << 18  # shingles of a group after which memory is given back
BROADCAST_ROWS = 1_000_000  # of three longs each
SLICES = 4  # of the shingles, joined one after the other if there are many
WHOLE_ROWS = 1 << 24  # prefix shingles that are joined at once
CLASSES = 1024  # a shingle of more classes is not counted for each of them
_U = np.uint64
_PLACE = finish(np.arange(101, 101 + WORDS, dtype=np.uint64)) | _U(1)


def shingle_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, text after text in ascending order, and their counts.

    Words are runs of other bytes than blank and 0x09 to 0x0D, with A-Z in lower case; a text
    of fewer than ``WORDS`` words has its whole sequence as its one shingle.
    """
    raw = [t.encode() for t in texts]
    size = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)) + 1
    data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    data = data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)
    word = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if len(word) and word[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[::2], edge[1::2]
    of = np.searchsorted(np.cumsum(size), starts, side="right")
    words = np.bincount(of, minlength=len(texts))
    h = span_hashes(data, starts, ends)
    if len(h) >= WORDS:
        whole = np.flatnonzero(of[:len(h) - WORDS + 1] == of[WORDS - 1:])
        mixed = np.zeros(len(whole), dtype=np.uint64)
        for k in range(WORDS):
            mixed += h[whole + k] * _PLACE[k]
        doc = of[whole]
    else:
        mixed, doc = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    few = np.flatnonzero((words > 0) & (words < WORDS))
    if len(few):
        first = (np.cumsum(words) - words)[few]
        short = words[few].astype(np.uint64)  # the number of words keeps short sequences apart
        for k in range(WORDS - 1):
            there = words[few] > k
            short[there] += h[first[there] + k] * _PLACE[k]
        mixed, doc = np.concatenate([mixed, short]), np.concatenate([doc, few])
    mixed = finish(mixed)
    order = np.lexsort((mixed, doc))
    mixed, doc = mixed[order], doc[order]
    new = np.ones(len(mixed), dtype=bool)
    new[1:] = (mixed[1:] != mixed[:-1]) | (doc[1:] != doc[:-1])
    return mixed[new], np.bincount(doc[new], minlength=len(texts))


def rare_first(hashes: np.ndarray, counts: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """The hashes of each text ordered by their cell's count, ties by hash."""
    doc = np.repeat(np.arange(len(counts)), counts)
    return hashes[np.lexsort((cells[(hashes >> _U(64 - CELLS_LOG2)).astype(np.int64)], doc))]


def set_ids(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set that does not depend on the order."""
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(finish(hashes ^ _U(0x5851F42D4C957F2D)), out=total[1:])
    ends = np.cumsum(counts)
    return finish(total[ends] - total[ends - counts] + counts.astype(np.uint64)).view(np.int64)


def corpus_counts(docs: DataFrame) -> np.ndarray:
    """How many documents' shingles fall into each cell, over all documents.

    Every task counts in a table of its own; the tables are added slice by slice, by
    sets of tasks first. The result has a fixed size whatever the corpus holds.
    """
    cells, cuts = 1 << CELLS_LOG2, 64

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(cells, dtype=np.int64)
        for batch in batches:
            for texts in slices(batch.column(0)):
                hashes, _ = shingle_sets(texts)
                own += np.bincount((hashes >> _U(64 - CELLS_LOG2)).astype(np.int64), minlength=cells)
        if own.any():
            part = TaskContext.get().partitionId() % 256
            yield pa.record_batch([pa.array(range(cuts), pa.int32()), pa.array([part] * cuts, pa.int32()),
                                   pa.array([x.tobytes() for x in np.split(own, cuts)], pa.binary())],
                                  names=["cut", "part", "counts"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b.as_buffer(), dtype=np.int64) for b in group.column("counts"))
        return pa.table({"cut": group.column("cut").slice(0, 1), "part": group.column("part").slice(0, 1),
                         "counts": pa.array([total.tobytes()], pa.binary())})

    layout = "cut int, part int, counts binary"
    sums = stored(docs.select("text").mapInArrow(lean(count), layout).groupBy("cut", "part").applyInArrow(add, layout)
                  .groupBy("cut").applyInArrow(add, layout).select("cut", "counts"), "cells")
    out = np.zeros(cells, dtype=np.int64)
    for r in sums.collect():
        out.reshape(cuts, -1)[r["cut"]] = np.frombuffer(r["counts"], dtype=np.int64)
    discard(sums)
    return out


def _prefix(n: np.ndarray, extra: np.ndarray | int = 1) -> np.ndarray:
    """Length of the prefix in which linked documents share at least ``extra`` shingles."""
    return n - (4 * n + 4) // 5 + extra


def _lists(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The hashes of each text as a list column."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()),
                                    pa.array(flat.view(np.int64)))


def _sliced(flat: np.ndarray, counts: np.ndarray, keep: np.ndarray) -> list[pa.Array]:
    """The first ``keep`` hashes of each text as a list column for each slice of the hashes."""
    first = np.cumsum(counts) - counts
    rows = np.repeat(first - (np.cumsum(keep) - keep), keep) + np.arange(int(keep.sum()))
    flat, doc = flat[rows], np.repeat(np.arange(len(keep)), keep)
    here = [flat % _U(SLICES) == k for k in range(SLICES)]
    return [_lists(flat[x], np.bincount(doc[x], minlength=len(keep))) for x in here]


def linked_stars(tokens: list[np.ndarray], left: np.ndarray, right: np.ndarray,
                 same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Link every pair of (left, right) sets that reaches the threshold.

    ``tokens`` are sets in the common rare-first order. Returns for each set the smallest
    index it is joined to and its number of links. With ``same`` both sides are one and
    each pair is taken once.
    """
    sizes = np.array([len(t) for t in tokens], dtype=np.int64)
    first = np.cumsum(sizes) - sizes
    prefix = _prefix(sizes)
    bins = np.array([np.bincount((t >> _U(33)).astype(np.int64) & 31, minlength=32) for t in tokens], dtype=np.int32)
    words, local = np.unique(np.concatenate(tokens), return_inverse=True)
    words, local = len(words), local.astype(np.int32)  # a group's tokens are few enough for short numbers

    def postings(length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = length[right]
        place = (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)).astype(np.int32)
        doc = np.repeat(right.astype(np.int32), n)
        word = local[first[doc] + place]
        order = np.argsort(word, kind="stable").astype(np.int32)
        at = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=words))])
        return at, doc[order], place[order]

    def look(own: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = at[own + 1] - at[own]
        return np.repeat(at[own] - (np.cumsum(n) - n), n) + np.arange(int(n.sum())), n

    def pieces(own: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int]]:
        """Runs of ``own`` whose postings are few enough to be looked at together."""
        n = np.cumsum(at[own + 1] - at[own])
        start = 0
        while start < len(own):
            stop = int(np.searchsorted(n, (n[start - 1] if start else 0) + TOGETHER, side="right"))
            yield start, max(start + 1, stop)
            start = max(start + 1, stop)

    at, docs, places = postings(prefix)
    whole = None
    label = np.arange(len(tokens))
    links = np.zeros(len(tokens), dtype=np.int64)
    for x in left:
        own = local[first[x]:first[x] + sizes[x]]
        fits = (5 * np.minimum(sizes, sizes[x]) >= 4 * np.maximum(sizes, sizes[x]))
        fits[:x + 1 if same else 0] = False
        fits[x] = False
        met: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for start, stop in pieces(own[:prefix[x]], at):
            rows, n = look(own[start:stop], at)
            other = docs[rows]
            new = fits[other]
            other, there, here = other[new], places[rows[new]], start + np.repeat(np.arange(stop - start), n)[new]
            other, where = np.unique(other, return_index=True)  # where the pair meets first
            fits[other] = False
            met.append((other, here[where], there[where]))
        other, here, there = (np.concatenate(c) for c in zip(*met))
        if not len(other):
            continue
        need = (4 * (sizes[x] + sizes[other]) + 8) // 9
        ok = 1 + np.minimum(sizes[x] - here - 1, sizes[other] - there - 1) >= need
        ok &= np.abs(bins[other] - bins[x]).sum(1) <= sizes[x] + sizes[other] - 2 * need
        other, need = other[ok], need[ok]
        if len(other) > 6:
            whole = whole or postings(sizes)
            shared = np.zeros(len(tokens), dtype=np.int64)
            for start, stop in pieces(own, whole[0]):
                shared += np.bincount(whole[1][look(own[start:stop], whole[0])[0]], minlength=len(tokens))
            shared = shared[other]
        else:
            shared = np.array([len(np.intersect1d(tokens[x], tokens[y], assume_unique=True)) for y in other],
                              dtype=np.int64)
        other = other[shared >= need]
        if len(other):
            links[x] += len(other)
            links[other] += 1
            found = np.unique(np.append(label[other], label[x]))
            if len(found) > 1:
                label[np.isin(label, found)] = found[0]
    return label, links


def similar_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and links of every row of ``docs`` (doc_id, text).

    Rows without a word have an empty set, no links and their own id; equal sets are
    linked (``links`` counts other sets, not copies). Rows that repeat a doc_id each give
    a row; a null doc_id is never the smallest. A very long text is one set like any other.
    An empty table gives no rows; other columns are ignored.
    """
    return document_classes(docs).select("doc_id", "n_shingles", "component_id", "links")


def row_key() -> Column:
    """A 64-bit hash that tells rows apart by doc_id and text; rows equal in both are copies."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text"))


def document_classes(docs: DataFrame) -> DataFrame:
    """:func:`similar_documents` with ``row``, the row's key, and ``root``, which names its class.

    ``root`` is null for rows without a word. Unlike component_id it also tells classes
    apart that hold rows of one doc_id.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .select("doc_id", row_key().alias("row"), "text")
    cells = spark.sparkContext.broadcast(corpus_counts(docs))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            done = 0
            for texts in slices(batch.column(batch.schema.get_field_index("text"))):
                hashes, counts = shingle_sets(texts)
                yield batch.slice(done, len(texts)), rare_first(hashes, counts, cells.value), counts, \
                    set_ids(hashes, counts)
                done += len(texts)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, flat, counts, ids in sets(batches):
            keep = np.where(counts > 0, np.minimum(counts, _prefix(counts, 1 + counts // SPARE)), 0)
            yield pa.record_batch([rows.column(0), rows.column(1), pa.array(counts, pa.int64()), pa.array(ids),
                                   *_sliced(flat, counts, keep)], names=["doc_id", "row", "n", "node", *prefix])

    prefix = [f"prefix{k}" for k in range(SLICES)]
    layout = ", ".join(["doc_id long, row long, n long, node long", *[f"{c} array<bigint>" for c in prefix]])
    whole = stored(docs.mapInArrow(lean(prefixes), layout).withColumn("place", F.monotonically_increasing_id()), "prefixes")
    kept = stored(whole.select("doc_id", "row", "n", "node", "place"), "rows")
    nodes = stored(kept.where("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.min("place").alias("place"), F.min_by("row", "place").alias("row"),
        F.first("n").alias("n")), "nodes")
    clusters = _clusters(_shared(whole, nodes, prefix), nodes)
    links = stored(_verified(docs, nodes, clusters, sets), "links")
    discard(clusters)
    parts = connected_components(links.select(F.col("node").alias("u"), F.col("root").alias("v")), "linked")
    degree = links.groupBy("node").agg(F.sum("links").alias("links"))
    where = nodes.select("node", "doc_id").join(parts, "node")
    least = where.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    placed = nodes.select("node", F.col("doc_id").alias("own_id")).join(
        where.select("node", "component").join(least, "component"), "node", "left") \
        .join(degree, "node", "left") \
        .select("node", F.coalesce("component_id", "own_id").alias("component_id"), "links",
                F.coalesce("component", "node").alias("root"))
    return kept.select("doc_id", "row", "n", F.when(F.col("n") > 0, F.col("node")).alias("node")) \
        .join(placed, "node", "left") \
        .select("doc_id", "row", "root", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
                F.coalesce("links", F.lit(0).cast("long")).alias("links"))


def _repeated(rows: DataFrame) -> DataFrame:
    """Shingles of more than one row (node, token), with the smallest of their nodes."""
    return rows.groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("hub")).where("c > 1")


def _wanted(n: Column) -> Column:
    """So many prefix shingles a linked node of ``n`` shingles shares with the other, at least.

    It has at least 0.8 n, and both prefixes are long enough for the smaller demand.
    """
    return F.floor(F.floor((4 * n + 4) / 5) / SPARE) + 1


def _shared(whole: DataFrame, nodes: DataFrame, prefix: list[str]) -> DataFrame:
    """(node, token) of the prefix shingles by which a node can have links; ``whole`` is discarded.

    Slices of the shingles do not meet, so each is joined by itself and the disk holds the
    shuffles of one slice.
    """
    tokens = whole.agg(F.sum(sum(F.size(c) for c in prefix))).first()[0] or 0
    own = stored(whole.where("n > 0").select("place", *prefix).join(nodes.select("place", "node"), "place")
                 .select("node", *prefix), "sets")
    discard(whole)
    live = []
    for part in [F.concat(*prefix)] if tokens <= WHOLE_ROWS else [F.col(c) for c in prefix]:
        rows = own.select("node", F.explode(part).alias("token"))
        live.append(stored(rows.join(_repeated(rows).select("token"), "token").select("node", "token"), "shared"))
    discard(own)
    for _ in range(2):  # again among those left: what only a node that has gone shared does not count
        counts = reduce(DataFrame.union, live).groupBy("node").agg(F.count(F.lit(1)).alias("c"))
        alive = stored(counts.join(nodes.select("node", "n"), "node").where(F.col("c") >= _wanted(F.col("n")))
                       .select("node"), "alive")
        for k, part in enumerate(live):
            left = part.join(alive, "node")
            live[k] = stored(left.join(_repeated(left).select("token"), "token").select("node", "token"), "live")
            discard(part)
        discard(alive)
    return reduce(DataFrame.union, live)


def _clusters(live: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, component) such that linked nodes are in one component; ``live`` is discarded.

    Any classes would do: of two linked nodes in different ones, each has as many shingles in
    the other's class as the link takes. Shingles of few classes are counted for each of
    them; the bound on classes is the largest that gives no more rows than ``live`` has. A
    link takes at least half of its demand from these or more than half from the others, and
    nodes with so many of the others are joined through the smallest class of each.
    """
    hubs = live.join(_repeated(live).select("token", "hub"), "token").groupBy("node", "hub").agg(
        F.count(F.lit(1)).alias("c"))
    classes = stored(hubs.groupBy("node").agg(F.max_by("hub", F.struct("c", "hub")).alias("class"))
                     .join(nodes.select("node", "n"), "node"), "classes")
    placed = stored(live.join(classes, "node").select("node", "token", "class", "n"), "placed")
    rows = placed.count()
    discard(live)
    mixed = placed.groupBy("token").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a < b")
    mixed_rows = stored(placed.join(mixed.select("token"), "token"), "mixed")
    discard(placed)
    sides = stored(mixed_rows.groupBy("token", "class").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.count(F.lit(1)).alias("m")), "sides")
    spread = stored(sides.groupBy("token").agg(F.count(F.lit(1)).alias("classes"), F.sum("m").alias("m"),
                                               F.min("class").alias("least")), "spread")
    costs = spread.where(F.col("classes") <= CLASSES).groupBy("classes").agg(
        F.sum(F.col("m") * (F.col("classes") - 1)).alias("rows")).collect()  # a row for each number of classes
    bound, total = 1, 0
    for r in sorted(costs):
        total += r["rows"]
        if total > rows:
            break
        bound = r["classes"]
    few = F.col("classes") <= bound
    many = mixed_rows.join(spread.where(~few).select("token"), "token")
    many_of = stored(many.groupBy("node").agg(F.count(F.lit(1)).alias("many")), "many")
    wanted = _wanted(F.col("n"))
    others = sides.join(spread.where(few).select("token"), "token").select("token", F.col("class").alias("other"), "lo", "hi")
    counted = mixed_rows.join(others, "token").where(
        (F.col("class") != F.col("other")) & (5 * F.col("n") >= 4 * F.col("lo")) & (4 * F.col("n") <= 5 * F.col("hi"))) \
        .groupBy("node", "n", "class", "other").agg(F.count(F.lit(1)).alias("c"))
    strong = stored(counted.join(many_of, "node", "left")
                    .where(F.col("c") >= F.greatest(wanted - F.floor(wanted / 2), wanted - F.coalesce("many", F.lit(0))))
                    .select("class", "other").distinct(), "strong")
    back = strong.select(F.col("class").alias("other"), F.col("other").alias("class"))
    edges = strong.join(back, ["class", "other"]).select(F.col("class").alias("u"), F.col("other").alias("v"))
    common = many.join(many_of, "node").where(F.col("many") > F.floor(wanted / 2)).select("token", "class")
    least = common.groupBy("token").agg(F.min("class").alias("least"))
    edges = edges.union(common.distinct().join(least, "token").select("class", "least"))
    merged = connected_components(edges, "candidates")
    found = classes.join(merged.select(F.col("node").alias("class"), "component"), "class", "left") \
        .select("node", F.coalesce("component", "class").alias("component"))
    alone = found.groupBy("component").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("component")
    clusters = stored(found.join(alone, "component").select("node", "component"), "clusters")
    discard(classes, mixed_rows, sides, spread, many_of, strong)
    return clusters


def _verified(docs: DataFrame, nodes: DataFrame, clusters: DataFrame, sets) -> DataFrame:
    """(node, root, links) of every node that has a link, from each group it is compared in."""
    sizes = clusters.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    total = clusters.count()
    small = F.col("size") <= BLOCK // 4
    # small clusters share a group; they have too few shingles in common for a link
    members = clusters.join(sizes, "component").join(nodes.select("node", "row"), "node").select(
        "row", "node", F.when(small, F.pmod(F.xxhash64("component"), F.lit(total // BLOCK + 1)))
        .otherwise(F.col("component")).alias("pool"),
        F.when(small, 1).otherwise(F.ceil(F.col("size") / BLOCK)).cast("int").alias("blocks"), small.alias("small"))
    members = stored(members, "members")
    chosen = F.broadcast(members) if total <= BROADCAST_ROWS else members

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, flat, counts, ids in sets(batches):
            right = rows.column(1).to_numpy() == ids  # always so but for equal hashes of two rows
            yield pa.record_batch([*[rows.column(i) for i in range(1, 5)], _lists(flat, counts)],
                                  names=["node", "pool", "blocks", "small", "tokens"]).filter(pa.array(right))

    full = docs.join(chosen, "row").select("text", "node", "pool", "blocks", "small") \
        .mapInArrow(lean(ordered), "node long, pool long, blocks int, small boolean, tokens array<bigint>")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = full.withColumn("block", block).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("small", "pool", F.least("block", "k").alias("i"), F.greatest("block", "k").alias("j"),
                "block", "node", "tokens")

    def verify(group: pa.Table) -> pa.Table:
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        node, where = np.unique(group.column("node").to_numpy(), return_index=True)
        side = group.column("block").to_numpy()[where]
        lists = group.column("tokens").combine_chunks()
        flat, at = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
        tokens = [flat[at[r]:at[r + 1]] for r in where]
        label, links = linked_stars(tokens, np.flatnonzero(side == i), np.flatnonzero(side == j), i == j)
        on = links > 0
        if len(flat) >= LARGE:
            release_memory()
        return pa.table({"node": node[on], "root": node[label[on]], "links": links[on]})

    return dealt.groupBy("small", "pool", "i", "j").applyInArrow(verify, "node long, root long, links long")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: five words, similarity 0.8 or more."""
    return similar_documents(table(spark, sf_dir, "documents"))
