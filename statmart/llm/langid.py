"""Language identification by cross-parsing against suffix automata.

For each language the suffix automaton of a bounded sample of labelled text is built.
A text is parsed into phrases, each the longest match that the automaton of a language
allows from where the last one ended; the language that needs the fewest phrases,
normalised by the text's length and the sample's (phrases * log2(sample) / symbols: the
cross-parsing entropy), wins. Case is folded, letters that no sample holds match nothing
and end a phrase, runs of other characters count as one space. Where the samples hold more
letters than the alphabet has symbols, the commonest are one symbol each and the others are
spelled with several, so scripts of thousands of letters keep them all apart.

Whether a text is of the language it comes nearest to at all is decided by the same
entropy: it must stay within a bound fitted on labelled texts, each parsed by a model
that has not seen it. Short parses vary more, so the bound is fitted on windows of
several lengths and a text meets that of the longest window it fills.

The walk is vectorised: texts are parsed in blocks of ``BLOCK`` symbols, and many
blocks and all languages step through their automata together, so the work per
character is a few array operations whatever the lengths of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.llm.common import lean, table
from statmart.llm.textunits import slices

SAMPLE_SYMBOLS = 40_000  # the classifier is fitted on about so many characters of each language
MODEL_SYMBOLS = 640_000  # and on so many of all languages together, so many languages get less each
ALPHABET = 62
BLOCK = 512
SPACE = 0
UNDETERMINED = "und"
WINDOWS = (8, 16, 32, 64, 128)  # symbols; a text below the first is too short for its entropy to tell
LEAST_WINDOWS = 50  # a bound is fitted on so many at least
SPREAD = 5  # times the distance from the median to the 99th percentile that a bound lies above the median


def suffix_automaton(symbols: list[int], width: int) -> np.ndarray:
    """Transitions of the suffix automaton, -1 where there is none; state 0 is the start."""
    nxt: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                twin = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    out = np.full((len(nxt), width), -1, dtype=np.int64)
    for s, t in enumerate(nxt):
        if t:
            out[s, list(t)] = list(t.values())
    return out


@dataclass
class Spelling:
    """Letters of several symbols: the code points in order, and the symbols of each (rows)."""

    letters: np.ndarray
    digits: np.ndarray

    def spell(self, points: np.ndarray, got: np.ndarray) -> np.ndarray:
        """``got``, the first symbols of the characters ``points``, with the further ones put in."""
        at = np.flatnonzero((got >= self.digits[0, 0]) & (got <= self.digits[-1, 0]))
        if not len(at):
            return got
        further = self.digits.shape[1] - 1
        sizes = np.ones(len(got), dtype=np.int64)
        sizes[at] += further
        out = np.repeat(got, sizes)
        first = (np.cumsum(sizes) - sizes)[at]
        row = np.searchsorted(self.letters, points[at])
        for j in range(1, further + 1):
            out[first + j] = self.digits[row, j]
        return out


def choose_spelling(often: np.ndarray, alphabet: int) -> tuple[int, int]:
    """(letters of one symbol, symbols of each other letter) for letters found so ``often``, commonest first.

    Each place of a spelled letter has ``k`` symbols of its own, so a match cannot begin
    inside a letter as if at its start. Of the numbers of places the one that makes the
    sample shortest is taken.
    """
    if len(often) <= alphabet:
        return len(often), 1
    before = np.concatenate([[0], np.cumsum(often)])
    found = []
    for places in range(2, alphabet // 2 + 1):
        k = next((k for k in range(2, alphabet // places + 1) if k ** places >= len(often) - (alphabet - places * k)), None)
        if k is not None:
            single = alphabet - places * k
            found.append((int(before[single] + places * (before[-1] - before[single])), places, single))
    if not found:
        raise ValueError(f"{len(often)} letters cannot be spelled with {alphabet} symbols")
    _, places, single = min(found)
    return single, places


@dataclass
class LanguageModel:
    """Automata of all languages in one table of steps.

    ``step[state + symbol]`` is the next state (times the alphabet's width); a negative
    value ends a phrase and its complement is the state after the first symbol of the
    next one.
    """

    languages: list[str]
    lookup: np.ndarray
    step: np.ndarray
    roots: np.ndarray
    weight: np.ndarray
    bound: np.ndarray | None = None  # highest entropy of a language's texts (rows) by length (columns)
    share: float = 0.0  # least part of letters in a text that is too short for a bound
    spelling: Spelling | None = None

    def symbols(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        got = self.lookup[points]
        keep = got != SPACE
        keep[1:] |= got[:-1] != SPACE
        return got[keep] if self.spelling is None else self.spelling.spell(points[keep], got[keep])

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (rows) in each language (columns)."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        count = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        if not len(owner):
            return count
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        left = np.minimum(BLOCK, sizes[owner] - nth * BLOCK)
        flat = np.concatenate(texts)
        start = (np.cumsum(sizes) - sizes)[owner] + nth * BLOCK
        order = np.argsort(-left, kind="stable")
        left, start, owner = left[order], start[order], owner[order]
        padded = np.append(flat, np.zeros(BLOCK, dtype=np.uint8))
        lanes = padded[start[None, :] + np.arange(BLOCK)[:, None]].astype(np.int32)
        state = np.repeat(self.roots[:, None], len(owner), axis=1)
        ended = np.ones_like(state)  # the phrase that is open when the block ends
        active = np.searchsorted(-left, -np.arange(BLOCK), side="left")
        for t in range(int(left[0])):
            k = int(active[t])
            got = self.step.take(state[:, :k] + lanes[t, :k])
            over = got >> 31
            ended[:, :k] -= over
            state[:, :k] = got ^ over
        for i in range(len(self.languages)):
            count[:, i] = np.bincount(owner, weights=ended[i], minlength=len(texts)).astype(np.int64)
        return count

    def _parsed(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each text has a letter, its symbols, and its cost in each language."""
        known = np.array([bool(t) and any(map(str.isalpha, t)) for t in texts], dtype=bool)
        symbols = [self.symbols(t) if k else np.zeros(0, dtype=np.uint8) for t, k in zip(texts, known)]
        sizes = np.array([len(s) for s in symbols], dtype=np.int64)
        return known, sizes, self.phrases(symbols) * self.weight[None, :]

    def told(self, texts: list[str | None]) -> np.ndarray:
        """Whether each text is of one of the languages, as far as its entropy tells.

        A text without a letter is of none. Where no bound could be fitted any other text
        is; where nothing was learned, every text.
        """
        if not self.languages or not len(texts):
            return np.ones(len(texts), dtype=bool)
        known, sizes, cost = self._parsed(texts)
        if self.bound is None:
            return known
        best, length = cost.argmin(axis=1), np.searchsorted(WINDOWS, sizes, side="right") - 1
        entropy = cost.min(axis=1) / np.maximum(sizes, 1)
        ok = known & ((length < 0) | (entropy <= self.bound[best, np.maximum(length, 0)]))
        for i in np.flatnonzero(known & (length < 0)):
            ok[i] = letter_share(texts[i]) >= self.share
        return ok

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; ties go to the language named first in order.

        The score is the part of its phrases that the winner saves against the runner-up.
        """
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        known, _, cost = self._parsed(texts)
        best = cost.argmin(axis=1) if len(texts) else np.zeros(0, dtype=np.int64)
        low = np.sort(cost, axis=1)
        second = low[:, 1] if len(self.languages) > 1 else np.full(len(texts), np.inf)
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(known, np.clip(1 - low[:, 0] / second, 0, 1), 0.0)
        return [self.languages[b] if k else UNDETERMINED for b, k in zip(best, known)], score


def letter_share(text: str) -> float:
    """Letters among all characters that are not white space."""
    seen = sum(map(len, text.split()))
    return sum(map(str.isalpha, text)) / seen if seen else 0.0


def fit_bounds(languages: list[str], clean: dict[str, list[tuple[str, LanguageModel]]]) -> tuple[np.ndarray, float]:
    """Bounds by language and length, and the share of letters, from texts and models that have not seen them.

    A bound lies ``SPREAD`` times as far above the median of the windows' entropies as
    their 99th percentile does, so a few odd texts in the sample do not move it. Of lengths
    with too few windows the next shorter bound holds, and without any there is none.
    """
    bound = np.full((len(languages), len(WINDOWS)), np.inf)
    for i, g in enumerate(languages):
        parsed = [(m.symbols(t), m) for t, m in clean[g]]
        for j, w in enumerate(WINDOWS):
            found = []
            for model in {id(m): m for _, m in parsed}.values():
                cut = [s[a:a + w] for s, m in parsed if m is model for a in range(0, len(s) - w + 1, w)]
                own = model.languages.index(g)
                found.append(model.phrases(cut)[:, own] * model.weight[own] / w)
            rates = np.concatenate(found) if found else np.zeros(0)
            if len(rates) >= LEAST_WINDOWS:
                middle, high = np.quantile(rates, [0.5, 0.99])
                bound[i, j] = middle + SPREAD * (high - middle)
            elif j:
                bound[i, j] = bound[i, j - 1]
    return bound, min((letter_share(t) for ts in clean.values() for t, _ in ts), default=0.0) / 2


def build_model(samples: dict[str, list[str]], alphabet: int = ALPHABET) -> LanguageModel:
    """Model of the sample texts of each language; ``alphabet`` symbols stand for their letters."""
    languages = sorted(samples)
    points = np.concatenate([np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
                             for ts in samples.values() for t in ts])
    found, often = np.unique(points, return_counts=True)
    ranked = [(int(p), int(n)) for p, n in sorted(zip(found, often), key=lambda x: (-x[1], x[0])) if chr(p).isalpha()]
    single, places = choose_spelling(np.array([n for _, n in ranked], dtype=np.int64), alphabet)
    letters, others = [p for p, _ in ranked[:single]], np.array(sorted(p for p, _ in ranked[single:]), dtype=np.uint32)
    k = (alphabet - single) // places if len(others) else 0
    width = single + k * places + 2
    lookup = np.zeros(0x110000, dtype=np.uint8)
    lookup[[cp for cp in range(0x110000) if chr(cp).isalpha()]] = width - 1  # a letter that no sample holds
    lookup[letters] = np.arange(1, single + 1)
    model = LanguageModel(languages, lookup, np.zeros(0), np.zeros(0), np.zeros(0))
    if len(others):
        # spread over all first symbols; letters that are neighbours in Unicode share them
        code = np.arange(len(others)) * (k ** places) // len(others)
        digits = np.stack([single + 1 + j * k + code // k ** (places - 1 - j) % k for j in range(places)], axis=1)
        model.spelling = Spelling(others, digits.astype(np.uint8))
        lookup[others] = model.spelling.digits[:, 0]
    steps, roots, weights, base = [], [], [], 0
    for lang in languages:
        whole: list[int] = []
        for t in samples[lang]:
            # the outside symbol ends matches between two texts and is no transition
            whole += [*model.symbols(t).tolist(), width - 1]
        table_ = suffix_automaton(whole, width)
        table_[:, width - 1] = -1
        root = np.maximum(table_[0], 0)
        done = np.where(table_ >= 0, base + table_ * width, ~(base + root * width)[None, :])
        steps.append(done.ravel())
        roots.append(base)
        weights.append(np.log2(max(2, len(whole))))
        base += done.size
    if base >= 1 << 31:
        raise ValueError("the sample is too large for the table of steps")
    model.step = np.concatenate(steps).astype(np.int32)
    model.roots = np.array(roots, dtype=np.int32)
    model.weight = np.array(weights)
    return model


def fit_language_model(labelled: DataFrame, sample_symbols: int = SAMPLE_SYMBOLS,
                       alphabet: int = ALPHABET) -> LanguageModel:
    """Fit on a bounded sample of ``labelled`` (doc_id, text, lang).

    For each label, whole texts are taken in the order of a hash of doc_id until they
    hold ``sample_symbols`` characters, or their part of ``MODEL_SYMBOLS`` if that is less;
    a longer text gives so many of its first. Labels can be wrong: the sample is split in two,
    each half is predicted by a model of the other, and texts with another prediction
    are left out of the final model unless a language would lose more than half of its
    texts. Rows without a label, text or letter are not used; if none is left, every
    prediction is ``und``.
    """
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL AND text RLIKE '\\\\p{L}'")
    size = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).collect()
    if not size:
        return LanguageModel([], *[np.zeros(0)] * 4)
    sample_symbols = min(sample_symbols, max(1, MODEL_SYMBOLS // len(size)))
    key = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    # enough rows for the wanted characters, with room for chance; the exact bound is applied below
    share = F.lit(0)
    for r in size:
        want = min(1.0, 4 * sample_symbols / r["chars"] + 64 / r["n"])
        share = F.when(F.col("lang") == r["lang"], F.lit(int(want * (1 << 30)))).otherwise(share)
    near = rows.select("lang", "text", key.alias("key")).where(F.col("key") < share)
    sample: dict[str, list[str]] = {}
    held: dict[str, int] = {}
    running = F.sum(F.length("text")).over(_sample_order())
    for r in near.withColumn("before", running - F.length("text")).where(F.col("before") < sample_symbols) \
                 .orderBy("lang", "key", "text") \
                 .select("lang", F.substring("text", 1, sample_symbols).alias("text")).collect():  # bounded by the sample
        sample.setdefault(r["lang"], []).append(r["text"])
        held[r["lang"]] = held.get(r["lang"], 0) + len(r["text"])
    halves = [{g: ts[k::2] for g, ts in sample.items() if ts[k::2]} for k in (0, 1)]
    clean = {g: list(ts) for g, ts in sample.items()}
    unseen: dict[str, list[tuple[str, LanguageModel]]] = {}  # texts and the model of the other half
    if all(len(h) == len(sample) for h in halves):
        models = [build_model(h, alphabet) for h in halves]
        for g, ts in sample.items():
            said = [models[1 - i % 2].predict([t])[0][0] for i, t in enumerate(ts)]
            right = [i for i, s in enumerate(said) if s == g]
            right = right if 2 * len(right) >= len(ts) else list(range(len(ts)))
            clean[g] = [ts[i] for i in right]
            unseen[g] = [(ts[i], models[1 - i % 2]) for i in right]
    model = build_model(clean, alphabet)
    if unseen:
        model.bound, model.share = fit_bounds(model.languages, unseen)
    return model


def _sample_order():
    from pyspark.sql import Window
    return (Window.partitionBy("lang").orderBy("key", "text")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))


def predict_language(df: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred and score from the text alone; ``und`` with score 0 without a letter.

    Empty tables give no rows, repeated rows each give one; other columns are not read.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1)):
                langs, score = own.predict(texts)
                yield pa.record_batch([batch.column(0).slice(at, len(texts)), pa.array(langs, pa.string()),
                                       pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])
                at += len(texts)
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lean(run), "doc_id long, lang_pred string, score double")


def rows_told(df: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``df`` (text among its columns) whose text is of one of the model's languages.

    Each row is judged by its own text, so rows that share an id do not matter to each
    other. Null and empty texts are of no language; columns and copies stay as they are.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    place = df.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            at = 0
            for texts in slices(batch.column(place)):
                yield batch.slice(at, len(texts)).filter(pa.array(own.told(texts), pa.bool_()))
                at += len(texts)
    return df.mapInArrow(lean(run), df.schema)


def held_out():
    """Documents that the classifier never learns from; a null doc_id counts as the empty text."""
    return F.pmod(F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")), F.lit(5)) == 0


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit_language_model(docs.where(~held_out()))
    return predict_language(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
