"""Line deduplication by a segment-partition edit join.

A line of at least ``MIN_CHARS`` characters goes when an earlier line (by doc_id, then
place) differs from it by at most one edit, or is equal to it. Equal lines are brought to
their first occurrence; the join then works on distinct lines.

With a threshold of one edit a line has two segments, and of two lines within it, one
segment of the shorter stands unchanged at the same end of the longer. So every line is
indexed under its two segments, and probes the segments of its own length and of the
length below. The index holds no texts, only ids, lengths and two sums per line:

* keys that few lines share: pairs in a group pass a filter (the sums of both lines'
  characters may differ by one character or one exchange), then texts are fetched for
  the pairs left and verified by banded bit-parallel edit distance;
* keys that more than ``HOT`` lines share: the part that has not been compared is halved,
  and each line goes on under two longer keys, until few lines share one or one
  character is left. There the key itself proves the distance, and the earliest line of
  the group stands for all. So a group gives rows in proportion to its lines, never pairs.

Lines are told apart by two 64-bit sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.llm.common import lean, stored, table
from statmart.llm.textunits import finish, hash_between, running_hash, slices

THRESHOLD = 1
MIN_CHARS = 32
HOT = 48
BROADCAST_ROWS = 500_000  # of four longs each
_U = np.uint64
_CHAR = finish(np.arange(1001, 1065, dtype=np.uint64))  # one number for each of 64 kinds of characters
_CHANGES = np.unique(np.concatenate([(_CHAR[:, None] - _CHAR[None, :]).ravel(), _CHAR, _U(0) - _CHAR]))


def within(a: str, b: str, limit: int) -> bool:
    """Whether the edit distance is at most ``limit``: banded bit-parallel, for limits up to 30.

    The band of 64 cells around the diagonal is held in one word that moves down one row
    per character of the longer text.
    """
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > limit:
        return False
    if len(a) <= limit:  # the band must start inside; a common beginning changes no distance
        a, b = "-" * limit + a, "-" * limit + b
    word = (1 << 64) - 1
    # places of each character of ``a`` in the band, as of the row it was last needed in
    places = {}
    for i, c in enumerate(a[:limit]):
        places[c] = places.get(c, (0, 0))[0] | 1 << (63 - limit + i), 0

    vp, vn = (word << (63 - limit)) & word, 0
    distance, across = limit, 1 << 62
    for j, c in enumerate(b):
        if j + limit < len(a):  # the next character enters the band at its lower end
            bits, row = places.get(a[j + limit], (0, j))
            places[a[j + limit]] = bits >> (j - row) | 1 << 63, j
        bits, row = places.get(c, (0, j))
        pm = bits >> (j - row)
        d0 = ((((pm & vp) + vp) ^ vp) | pm | vn) & word
        hp, hn = (vn | ~(d0 | vp)) & word, d0 & vp
        if j < len(a) - limit:  # the band's lowest cell lies on the diagonal
            distance += not d0 >> 63
        else:  # the last row has been reached; follow it to the right
            distance += bool(hp & across)
            distance -= bool(hn & across)
            across >>= 1
        vp = (hn | ~((d0 >> 1) | hp)) & word
        vn = (d0 >> 1) & hp
    return distance <= limit


def _key(length: np.ndarray, before: np.ndarray, after: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Key of lines of one class: ``p`` characters from the left and ``q`` from the right are equal."""
    size = finish(length.astype(np.uint64) << _U(40) ^ p.astype(np.uint64) << _U(20) ^ q.astype(np.uint64))
    return finish(finish(before + size) + after).view(np.int64)


def _keys(total: np.ndarray, start: np.ndarray, end: np.ndarray, length: np.ndarray, p: np.ndarray,
          q: np.ndarray) -> np.ndarray:
    return _key(length, hash_between(total, start, start + p), hash_between(total, end - q, end), p, q)


def _scan(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Rows of the lines of at least ``least`` characters of documents (doc_id, row, text), without their texts."""
    for batch in batches:
        at = 0
        for texts in slices(batch.column(2)):
            points = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            cuts = np.flatnonzero(points == 10)
            start, end = np.concatenate([[0], cuts + 1]), np.append(cuts, len(points))
            count = np.fromiter((t.count("\n") + 1 for t in texts), dtype=np.int64, count=len(texts))
            doc = np.repeat(np.arange(len(texts)), count)
            line = np.arange(len(start)) - np.repeat(np.cumsum(count) - count, count)
            long = end - start >= least
            start, end, doc, line = start[long], end[long], doc[long], line[long]
            if len(start):
                n = end - start
                sums = np.concatenate([[_U(0)], np.cumsum(_CHAR[points & 63])])
                total = running_hash(points)
                half = n // 2
                zero = np.zeros(len(n), dtype=np.int64)
                less, half_less = n - 1, (n - 1) // 2  # 0 for a single character, which is no key below
                rows = pa.array(doc + at)
                yield pa.record_batch(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(line), pa.array(n),
                     pa.array(hash_between(total, start, end).view(np.int64)),
                     pa.array((sums[end] - sums[start]).view(np.int64)),
                     pa.array(_keys(total, start, end, n, half, zero)),
                     pa.array(_keys(total, start, end, n, zero, n - half)),
                     pa.array(_keys(total, start, end, less, half_less, zero)),
                     pa.array(_keys(total, start, end, less, zero, less - half_less))],
                    names=["doc_id", "row", "line", "n", "h", "m", "left", "right", "left1", "right1"])
            at += len(texts)


SCAN = ("doc_id long, row long, line long, n long, h long, m long, "
        "left long, right long, left1 long, right1 long")
KEYED = "key long, l long, p long, q long, n long, h long, m long"


def _light_pairs(rows: DataFrame) -> DataFrame:
    """Pairs (h, m, h2, m2) inside groups of few lines that pass the filter on character sums."""
    def pairs(group: pa.Table) -> pa.Table:
        key = group.column("key").to_numpy()
        order = np.argsort(key, kind="stable")
        key = key[order]
        h, m, n, l = (group.column(c).to_numpy()[order] for c in ("h", "m", "n", "l"))
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(new, len(key)))
        place = np.arange(len(key)) - np.repeat(new, size)
        # every row meets the rows before it in its group
        second = np.repeat(np.arange(len(key)), place)
        first = np.repeat(np.arange(len(key)) - place, place) + np.arange(len(second)) \
            - np.repeat(np.cumsum(place) - place, place)
        shorter = (n[first] == l[first]) | (n[second] == l[second])
        first, second = first[shorter], second[shorter]
        change = m[first].view(np.uint64) - m[second].view(np.uint64)
        keep = np.isin(change, _CHANGES)
        first, second = first[keep], second[keep]
        return pa.table({"h": h[first], "m": m[first], "h2": h[second], "m2": m[second]})

    groups = rows.count() // 50_000 + 8  # about so many rows each; no key has more than HOT
    return rows.groupBy(F.pmod("key", F.lit(groups)).alias("pool")).applyInArrow(
        pairs, "h long, m long, h2 long, m2 long")


def _longer_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The two longer keys of each row (l, p, q, n, h, m, text)."""
    for batch in batches:
        at = 0
        for texts in slices(batch.column(6)):
            points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            part, total = batch.slice(at, len(texts)), running_hash(points)
            at += len(texts)
            l, p, q, n = (part.column(i).to_numpy() for i in range(4))
            end = np.cumsum(n)
            start = end - n
            gap = l - p - q
            step = np.where(gap == 1, 1, gap // 2)
            rest = np.where(gap == 1, 1, gap - gap // 2)
            for more, most in ((p + step, q), (p, q + rest)):
                yield pa.record_batch([pa.array(_keys(total, start, end, l, more, most)), pa.array(l),
                                       pa.array(more), pa.array(most), pa.array(n), part.column(4), part.column(5)],
                                      names=["key", "l", "p", "q", "n", "h", "m"])


def _fetch(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, m, text) of distinct lines, wanted as (h, m, row, line)."""
    by_doc = wanted.groupBy("row").agg(F.collect_list(F.struct("line", "h", "m")).alias("wanted"))
    if wanted.count() <= BROADCAST_ROWS:
        by_doc = F.broadcast(by_doc)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (b.slice(at, 64) for b in batches for at in range(0, len(b), 64)):
            out = [(w["h"], w["m"], lines[w["line"]])
                   for text, some in zip(part.column(0).to_pylist(), part.column(1).to_pylist())
                   for lines in [text.split("\n")] for w in some]
            h, m, t = zip(*out) if out else ((), (), ())
            yield pa.record_batch([pa.array(h, pa.int64()), pa.array(m, pa.int64()), pa.array(t, pa.string())],
                                  names=["h", "m", "text"])
    return docs.join(by_doc, "row").select("text", "wanted").mapInArrow(lean(pick), "h long, m long, text string") \
        .dropDuplicates(["h", "m"])


def _near_lines(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(h, m) of the distinct lines that an earlier one lies within one edit of."""
    rank = F.struct(F.col("first.doc_id"), F.col("first.row"), F.col("first.line"))
    same, less = F.col("n"), F.col("n") - 1
    half, half_less = F.floor(same / 2), F.floor(less / 2)
    zero = F.lit(0).cast("long")

    def entry(key, l, p, q):
        return F.struct(F.col(key).alias("key"), l.alias("l"), p.cast("long").alias("p"), q.cast("long").alias("q"))

    keyed = lines.select("n", "h", "m", F.explode(F.array(
        entry("left", same, half, zero), entry("right", same, zero, same - half),
        entry("left1", less, half_less, zero), entry("right1", less, zero, less - half_less))).alias("e")) \
        .select("e.key", "e.l", "e.p", "e.q", "n", "h", "m").where(F.col("l") >= MIN_CHARS)
    pairs, near, texts = [], [], None
    while True:
        # a group matters if it holds a line of the class's own length and another line
        groups = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size"),
                                          F.max((F.col("n") == F.col("l")).cast("int")).alias("own")) \
            .where("size > 1 AND own = 1").select("key", "size")
        keyed = stored(keyed.join(groups, "key"), "linekeys")
        pairs.append(_light_pairs(keyed.where(F.col("size") <= HOT).drop("size")))
        hot = keyed.where(F.col("size") > HOT).drop("size")
        wanted = hot.select("h", "m").distinct().join(lines, ["h", "m"]).select("h", "m", "first.row", "first.line")
        if hot.isEmpty():
            break
        if texts is None:
            texts = stored(_fetch(docs, wanted), "hotlines")
        gap = F.col("l") - F.col("p") - F.col("q")
        ranked = hot.where(gap <= 1).join(lines.select("h", "m", rank.alias("rank")), ["h", "m"])
        own = F.col("n") == F.col("l")
        least = ranked.groupBy("key").agg(F.min(F.when(own, F.col("rank"))).alias("shorter"),
                                          F.min(F.when(~own, F.col("rank"))).alias("longer"))
        proven = ranked.join(least, "key").where(
            F.when(gap == 1, own & (F.col("rank") > F.col("shorter")))
            .when(own, F.col("rank") > F.col("longer")).otherwise(F.col("rank") > F.col("shorter")))
        near.append(stored(proven.select("h", "m").distinct(), "proven"))
        keyed = hot.where(gap >= 1).join(texts, ["h", "m"]).select("l", "p", "q", "n", "h", "m", "text") \
            .mapInArrow(lean(_longer_keys), KEYED).distinct()
    found = pairs[0]
    for p in pairs[1:]:
        found = found.union(p)
    a, b = F.struct("h", "m"), F.struct(F.col("h2").alias("h"), F.col("m2").alias("m"))
    found = stored(found.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "linepairs")
    ends = found.select("a.*").union(found.select("b.*")).distinct().join(lines, ["h", "m"]) \
        .select("h", "m", "first.row", "first.line")
    read = stored(_fetch(docs, ends).join(lines.select("h", "m", rank.alias("rank")), ["h", "m"])
                  .select(F.struct("h", "m").alias("id"), "text", "rank"), "pairlines")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [within(x, y, THRESHOLD) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    left = read.select(F.col("id").alias("a"), F.col("text").alias("text_a"), F.col("rank").alias("rank_a"))
    right = read.select(F.col("id").alias("b"), F.col("text").alias("text_b"), F.col("rank").alias("rank_b"))
    later = F.when(F.col("rank_a") > F.col("rank_b"), F.col("a")).otherwise(F.col("b"))
    checked = found.join(left, "a").join(right, "b").select(later["h"].alias("h"), later["m"].alias("m"),
                                                            "text_a", "text_b")
    out = checked.mapInArrow(lean(verify), "h long, m long")
    for n in near:
        out = out.union(n)
    return out.distinct()


def removed_lines(docs: DataFrame, least: int = MIN_CHARS) -> DataFrame:
    """``row`` and ``gone`` (numbers of the lines to remove) of documents that lose lines."""
    occurrences = stored(docs.where("text IS NOT NULL").mapInArrow(lean(lambda b: _scan(b, least)), SCAN), "lines")
    lines = stored(occurrences.groupBy("h", "m").agg(
        F.min(F.struct("doc_id", "row", "line")).alias("first"), F.count(F.lit(1)).alias("times"),
        *[F.first(c).alias(c) for c in ("n", "left", "right", "left1", "right1")]), "distinctlines")
    near = stored(_near_lines(docs, lines.where(F.col("n") >= MIN_CHARS)), "nearlines").withColumn("near", F.lit(True))
    verdict = lines.join(near, ["h", "m"], "left").where("near OR times > 1").select("h", "m", "first", "near")
    here = F.struct("doc_id", "row", "line")
    return occurrences.select("doc_id", "row", "line", "h", "m").join(verdict, ["h", "m"]) \
        .where(F.col("near").isNotNull() | ~here.eqNullSafe(F.col("first"))) \
        .groupBy("row").agg(F.collect_set("line").alias("gone"))


def dedup_lines(docs: DataFrame, least: int = MIN_CHARS) -> DataFrame:
    """All columns of ``docs`` with ``text`` cleaned, and ``n_lines``, ``n_removed``, ``old_chars``.

    Lines end at a line feed. Of equal or near lines the first by (doc_id, null first;
    hash of the row; place) stays, unless a line before it is near to it in turn. Lines
    below ``MIN_CHARS`` characters are compared for equality only, and those below ``least``
    not at all; empty lines, and null and empty texts, stay as they are. Equal rows
    keep the same lines. Columns of ``docs`` with one of the added names are replaced.
    """
    if least < 1:
        raise ValueError("empty lines are no copies of one another")
    docs = docs.drop("n_lines", "n_removed", "old_chars")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d")) \
        .withColumn("row", F.xxhash64("d.doc_id", "d.text"))
    gone = removed_lines(keyed.select(F.col("d.doc_id").cast("long").alias("doc_id"), "row", "d.text"), least)

    @F.pandas_udf("string")
    def without(texts: pd.Series, numbers: pd.Series) -> pd.Series:
        out = []
        for t, g in zip(texts, numbers):
            drop = set(g.tolist())
            out.append("\n".join(x for i, x in enumerate(t.split("\n")) if i not in drop))
        return pd.Series(out, dtype=object)

    joined = keyed.join(gone, "row", "left")
    touched, text = F.col("gone").isNotNull(), F.col("d.text")
    # a filter on the text would else run the function once more, in a second Python process of each task
    once = without.asNondeterministic()
    cleaned = F.when(touched, once(F.when(touched, text).otherwise(""),
                                      F.coalesce("gone", F.array().cast("array<bigint>")))).otherwise(text)
    lines = F.coalesce(F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1, F.lit(0))
    return joined.select(
        *[cleaned.alias(c) if c == "text" else F.col(f"d.`{c}`") for c in docs.columns], lines.alias("n_lines"),
        F.when(touched, F.size("gone")).otherwise(0).alias("n_removed"), F.length(text).alias("old_chars"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document after line deduplication, as digests; equal lines of any length go."""
    done = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), least=1)
    return done.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"),
                       F.col("n_removed").cast("long").alias("n_removed"),
                       F.length(F.coalesce("text", F.lit(""))).cast("long").alias("kept_chars"),
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
