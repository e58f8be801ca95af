"""Benchmark decontamination by spaced-seed hashing, in DataFrame operations only.

A seed is the hash of the words under the ones of a fixed mask, so words under its
zeros may differ. Seeds of all training positions are joined with those of the
benchmark; each hit names a diagonal (document position minus item position), along
which the words of both are compared. An item is found where ``WINDOW`` consecutive
positions of a diagonal hold at most ``SUBSTITUTIONS`` differing words. ``MASKS``
together hit every such window, whichever words differ, so the seeds lose nothing.

Items shorter than a window are found where all their words stand in a row, or, if
``scaled``, with ``tolerance`` of their words differing: such an item is cut into two
blocks more than that, so two blocks are whole wherever it differs, and every pair of
blocks is a mask. Items of fewer than ``LEAST`` words are no evidence of a leak, so
``contamination`` leaves them out and ``unmatched`` lists them; ``short_matches`` finds
them word for word, as a class of its own. Words are runs of letters and digits in lower
case, compared by 64-bit hashes; if ``scaled``, a character of a script without blanks is a
word of its own.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.llm.common import stored, table

# With these, any 3 differing words of 13 leave at least one seed whole.
MASKS = ["111011", "11001011", "1101000101"]
WINDOW, SUBSTITUTIONS = 13, 3
LEAST = 5
BROADCAST_SEEDS = 2_000_000  # of five longs each; beyond that the join shuffles
BROADCAST_HITS = 500_000  # of three values each, and as many ids
PIECE = 1024  # words of a document that hits are compared with at once, at least


NO_BLANKS = "([" + "".join(f"\\p{{Is{s}}}" for s in (
    "Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")) + "])"


def tolerance(words: int) -> int:
    """Words that may differ in an item, or in each window of a longer one."""
    return 0 if words < LEAST else 1 if words <= 8 else 2 if words < WINDOW else SUBSTITUTIONS


def block_masks(words: int) -> list[tuple[int, str]]:
    """Place of the first one, and mask from there to the last one, for a short item of ``words`` words."""
    blocks = tolerance(words) + 2
    edge = [words * b // blocks for b in range(blocks + 1)]
    out = []
    for pair in combinations(range(blocks), 2):
        mask = "".join("1" if any(edge[b] <= i < edge[b + 1] for b in pair) else "0" for i in range(words))
        out.append((mask.index("1"), mask.strip("0")))
    return out


def word_codes(text: Column, signs: bool = False) -> Column:
    """Hashes of the words of a text; none for null. ``signs``: characters of scripts without blanks are words."""
    text = F.lower(F.coalesce(text, F.lit("")))
    text = F.regexp_replace(text, NO_BLANKS, " $1 ") if signs else text
    words = F.array_remove(F.split(text, "[^\\p{L}\\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def unmatched(benchmark: DataFrame) -> DataFrame:
    """(item_id, words) of the items that have too few words to be looked for."""
    return benchmark.select("item_id", F.size(word_codes(F.col("text"), True)).alias("words")).where(F.col("words") < LEAST)


def _seed(mask: str, number: int) -> Column:
    picked = [F.get(F.col("codes"), F.col("pos") + i) for i, c in enumerate(mask) if c == "1"]
    return F.when(F.col("pos") + len(mask) <= F.size("codes"),
                  F.struct(F.lit(number).alias("mask"), F.xxhash64(*picked).alias("seed")))


def seeds(coded: DataFrame, key: str, masks: list[tuple[int, str]]) -> DataFrame:
    """(key, pos, mask, seed) of every position of ``codes`` that a mask fits at."""
    positions = coded.select(key, "codes", F.explode(F.sequence(F.lit(0), F.size("codes") - 1)).alias("pos"))
    return positions.select(key, "pos", F.explode(F.array(*[_seed(m, n) for n, m in masks])).alias("s")) \
        .where("s IS NOT NULL").select(key, "pos", "s.mask", "s.seed")


def contamination(docs: DataFrame, benchmark: DataFrame, scaled: bool = False) -> DataFrame:
    """(doc_id, item_id, matched, best_window, first_word) of every item found in a document.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text. ``matched`` is the number
    of equal words on the item's best diagonal, ``best_window`` the most in one window
    (or all of a short item), ``first_word`` where the item's beginning would stand.
    Null and empty texts hold and are nothing; an item_id or doc_id that repeats is one
    item or document with all its texts. Empty tables give no rows.
    """
    items = benchmark.select("item_id", word_codes(F.col("text"), scaled).alias("codes")) \
        .where(F.size("codes") >= LEAST).select("item_id", "codes", F.size("codes").alias("words")).distinct()
    short = [r[0] for r in items.where(F.col("words") < WINDOW).select("words").distinct().collect()]  # < WINDOW values
    general = list(enumerate(MASKS))
    at = {n: block_masks(n) if scaled else [(0, "1" * n)] for n in sorted(short)}
    number = {m: 100 + i for i, m in enumerate(sorted({m for masks in at.values() for _, m in masks}))}
    whole = [(i, m) for m, i in number.items()]
    texts = docs.select("doc_id", "text").where("text IS NOT NULL")
    known = seeds(items.where(F.col("words") >= WINDOW).select(F.struct("item_id", "codes").alias("item"), "codes"),
                  "item", general)
    if whole:
        exact = seeds(items.where(F.col("words") < WINDOW).select(F.struct("item_id", "codes").alias("item"), "codes"),
                      "item", whole)
        wanted = F.lit(False)
        for n, masks in at.items():
            for place, m in masks:
                wanted |= (F.size("item.codes") == n) & (F.col("pos") == place) & (F.col("mask") == number[m])
        known = known.union(exact.where(wanted))
    known = known.select(F.col("item.item_id").alias("item_id"), F.col("pos").alias("item_pos"), "mask", "seed")
    if known.count() <= BROADCAST_SEEDS:
        known = F.broadcast(known)
    coded = texts.select("doc_id", word_codes(F.col("text"), scaled).alias("codes"))
    hits = seeds(coded, "doc_id", general + whole).join(known, ["mask", "seed"]) \
        .select("doc_id", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift")).distinct()
    return verified(texts, items, hits, scaled)


def short_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, matched, best_window, first_word) of items below ``LEAST`` words in documents.

    All words of the item stand in a row; ``first_word`` is the first such place, and the
    other columns are the item's words. Items without a word are found nowhere. Nulls,
    repeated ids and empty tables as in ``contamination``.
    """
    items = benchmark.select("item_id", word_codes(F.col("text"), True).alias("codes")) \
        .where(F.size("codes").between(1, LEAST - 1)).distinct()
    lengths = sorted(r[0] for r in items.select(F.size("codes")).distinct().collect())  # < LEAST values
    masks = [(n, "1" * n) for n in lengths or [1]]
    known = seeds(items.select(F.struct("item_id", "codes").alias("item"), "codes"), "item", masks) \
        .where((F.col("pos") == 0) & (F.col("mask") == F.size("item.codes"))).select("item.item_id", "mask", "seed")
    if known.count() <= BROADCAST_SEEDS:
        known = F.broadcast(known)
    coded = docs.select("doc_id", "text").where("text IS NOT NULL") \
        .select("doc_id", word_codes(F.col("text"), True).alias("codes"))
    hits = seeds(coded if lengths else coded.limit(0), "doc_id", masks).join(known, ["mask", "seed"])
    return hits.groupBy("doc_id", "item_id").agg(F.max(F.struct(F.col("mask").alias("n"), (-F.col("pos")).alias("back"))).alias("b")) \
        .select("doc_id", "item_id", F.col("b.n").alias("matched"), F.col("b.n").alias("best_window"),
                (-F.col("b.back")).alias("first_word"))


def verified(texts: DataFrame, items: DataFrame, hits: DataFrame, scaled: bool = False) -> DataFrame:
    """Compare the words along each hit diagonal.

    Hits stay rows. A document with hits is cut into pieces that overlap by the longest
    item, and a hit meets the piece its diagonal begins in, so neither the hits nor the
    words of a document come together in one row or task.
    """
    hits = stored(hits, "seedhits")
    longest = items.agg(F.max("words")).first()[0] or 0
    step = max(PIECE, longest)  # a diagonal begins less than an item before the document
    ids, placed = hits.select("doc_id").distinct(), hits.withColumn("place", F.floor(F.col("shift") / step).cast("int"))
    if hits.count() <= BROADCAST_HITS:
        ids, placed = F.broadcast(ids), F.broadcast(placed)
    # the words of the few documents with hits only, so they are split after the join
    coded = texts.join(ids, "doc_id", "left_semi").select("doc_id", word_codes(F.col("text"), scaled).alias("codes"))
    begin = F.greatest(F.col("place") * step, F.lit(0))
    pieces = coded.select("doc_id", "codes", F.explode(F.sequence(F.lit(-1), F.floor(F.size("codes") / step).cast("int"))).alias("place")) \
        .select("doc_id", "place", begin.alias("begin"),
                F.slice("codes", begin + 1, (F.col("place") + 1) * step + longest - begin).alias("piece"))
    at = F.col("shift") - F.col("begin")
    lines = pieces.join(placed, ["doc_id", "place"]).select(
        "doc_id", "item_id", "shift", F.least(at, F.lit(0)).alias("off"),
        F.slice("piece", F.greatest(at, F.lit(0)) + 1, F.lit(longest)).alias("codes"))
    item = items.select("item_id", F.col("codes").alias("item"), "words")
    pair = lines.join(item, "item_id").select("doc_id", "item_id", "shift", "words", F.transform(
        "item", lambda w, i: F.when(F.get(F.col("codes"), F.col("off") + i) == w, 1).otherwise(0)).alias("equal"))
    width = F.least(F.lit(WINDOW), F.col("words"))
    windows = F.transform(F.sequence(F.lit(1), F.col("words") - width + 1), lambda s: F.aggregate(
        F.slice("equal", s, width), F.lit(0), lambda a, b: a + b))
    need = F.when(F.col("words") < WINDOW, F.col("words")).otherwise(WINDOW - SUBSTITUTIONS)
    if scaled:
        for n in range(LEAST, WINDOW):
            need = F.when(F.col("words") == n, n - tolerance(n)).otherwise(need)
    scored = pair.select("doc_id", "item_id", "shift", need.alias("need"), F.array_max(windows).alias("best_window"),
                         F.aggregate("equal", F.lit(0), lambda a, b: a + b).alias("matched"))
    best = F.max(F.struct("matched", "best_window", (-F.col("shift")).alias("back")))
    return scored.where(F.col("best_window") >= F.col("need")).groupBy("doc_id", "item_id").agg(best.alias("b")) \
        .select("doc_id", "item_id", "b.matched", "b.best_window", (-F.col("b.back")).alias("first_word"))


def op8_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in any document; ``short`` marks items below ``LEAST`` words."""
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = contamination(docs, benchmark, scaled=True).withColumn("short", F.lit(False))
    if unmatched(benchmark).where("words > 0").isEmpty():
        return found
    return found.unionByName(short_matches(docs, benchmark).withColumn("short", F.lit(True)))
