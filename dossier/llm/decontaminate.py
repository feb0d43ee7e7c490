"""Benchmark decontamination by spaced-seed hashing.

A mask keeps some of the words of a span and ignores the others, so that a changed word spoils only the masks that
keep it. Hashes of test items and of documents are joined (a hash tells its mask); along the diagonals of the hits the words are
compared one by one, and a stretch of the item with enough equal words is an overlap. Short items, which
must match as a whole, have masks of their own length: whichever words may differ, one mask ignores them all.

Documents give only hashes that a bitmap of the test hashes' upper bits lets through, each once a text. Equal texts are one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.llm.common import WORD_BASE, blocks, map_arrow, mix, numbered, utf8
from dossier.llm.toxicity import lowered
from dossier.session import materialise

#: Fixed masks: 1 keeps a word, 0 ignores it. Each keeps six words; they ignore different places.
MASKS = ("111111", "11011011", "1110010101", "1100110011")
#: A stretch of so many words (or the whole item, if shorter) with this share of equal words is an overlap.
STRETCH, SHARE = 13, 0.8
#: Items of fewer words (none) are not searched for; items of so many words are reached by MASKS, shorter ones by short_masks().
LEAST_WORDS, MASKED_WORDS = 1, 12
#: Bits of the bitmap that is broadcast: 512 KB, however many test items there are.
SCREEN = 22
#: Keys (16 bytes each) that are broadcast to find texts; more are joined by a shuffle.
MOST_BROADCAST = 1_000_000
#: Diagonals times words that are compared at once.
CELLS = 1 << 21


def masked(h: np.ndarray, mask: str) -> np.ndarray:
    """The hash of the kept words of the span that begins at each word."""
    count = max(0, len(h) - len(mask) + 1)
    out = np.zeros(count, np.uint64)
    for k, kept in enumerate(mask):
        if kept == "1":
            out = out * np.uint64(WORD_BASE) + h[k : k + count]
    return mix(out ^ np.uint64(hash_of_mask(mask)))


def enough(size):
    """How many of *size* words must be equal."""
    return np.ceil(SHARE * size - 1e-9).astype(int)


def short_masks(n: int) -> list[str]:
    """Masks over whole items of n words. The words lie in two blocks more than may differ (in one if none may); every mask ignores
    as many blocks as words may differ."""
    differ = n - int(enough(np.int64(n)))
    parts = [set(x.tolist()) for x in np.array_split(np.arange(n), differ + 2 if differ else 1)]
    return ["".join("0" if any(k in x for x in gone) else "1" for k in range(n)) for gone in combinations(parts, differ)]


def hash_of_mask(mask: str) -> int:
    return int("1" + mask, 2) * 0x9E3779B97F4A7C15 & (1 << 64) - 1


def masks_of(n: int) -> list[str] | tuple[str, ...]:
    """The masks by which an item of n words is searched for."""
    return MASKS if n >= MASKED_WORDS else short_masks(n) if n >= LEAST_WORDS else ()


def diagonals(item: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Where word 0 of the item would stand in the text (it may lie outside), for each place where a mask hits."""
    marked = np.zeros(len(item) + len(words), bool)
    for m in masks_of(len(item)):
        own, other = masked(item, m), masked(words, m)
        at = np.flatnonzero(np.isin(other, own))
        if len(at):
            told = other[at]
            for place in np.flatnonzero(np.isin(own, told)).tolist():
                marked[at[told == own[place]] - place + len(item)] = True
    return np.flatnonzero(marked) - len(item)


def best_overlap(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int] | None:
    """(first word, words compared, equal words) of the overlap with the most equal words, of equally good ones the first; None without any.
    On each diagonal it reaches from the first qualifying stretch to the last."""
    n, best = len(item), None
    size = min(STRETCH, n)
    least = enough(np.int64(size)) if n else 0
    found = diagonals(item, words) if n else np.zeros(0, np.int64)
    step = max(1, CELLS // max(1, n))
    for a in range(0, len(found), step):
        d = found[a : a + step]
        at = d[:, None] + np.arange(n)
        inside = (at >= 0) & (at < len(words))
        same = np.zeros((len(d), n + 1), np.int32)
        np.cumsum(inside & (words[np.clip(at, 0, len(words) - 1)] == item), axis=1, out=same[:, 1:])
        low, high = np.maximum(0, -d), np.minimum(n, len(words) - d)  # words of the item that lie inside the text
        starts = np.arange(n - size + 1)
        good = (same[:, size:] - same[:, : n - size + 1] >= least) & (starts >= low[:, None]) & (starts + size <= high[:, None])
        rows = np.flatnonzero(good.any(1))
        if not len(rows):
            continue
        first, last = good[rows].argmax(1), n - size - good[rows][:, ::-1].argmax(1) + size
        equal = same[rows, last] - same[rows, first]
        k = int(np.lexsort((d[rows] + first, -equal))[0])
        told = (int(d[rows[k]] + first[k]), int(last[k] - first[k]), int(equal[k]))
        if best is None or told[2] > best[2]:
            best = told
    return best


def _row(text: str):
    return F.unhex(F.md5(text))


def _seeds(items: DataFrame) -> DataFrame:
    """h, ref, n: the distinct masked hashes of each item and its number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = utf8(b, "item_text")
            for a, z in blocks(texts):
                w = lowered(texts[a:z])
                for i, (x, y) in enumerate(zip(w.first.tolist(), w.first[1:].tolist()), a):
                    found = [masked(w.h[x:y], m) for m in masks_of(y - x)]
                    h = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array([b.column(0)[i].as_py()] * len(h), pa.binary()), pa.array(np.full(len(h), y - x, np.int32))], names=["h", "ref", "n"])

    return map_arrow(items.select("ref", "item_text"), run, "h long, ref binary, n int")


def _hits(texts: DataFrame, seeds: DataFrame) -> DataFrame:
    """row, ref: the texts (row, text) and items that share a masked hash."""
    lengths = sorted(r[0] for r in seeds.where(F.col("n") < MASKED_WORDS).select("n").distinct().collect())  # fewer than MASKED_WORDS
    long = not seeds.where(F.col("n") >= MASKED_WORDS).isEmpty()
    masks = [*(MASKS if long else ()), *(m for n in lengths for m in short_masks(n))]
    places = seeds.select(F.shiftrightunsigned("h", 64 - SCREEN).cast("int").alias("p")).distinct().toArrow().column("p").to_numpy()  # at most 2 ** SCREEN
    screen = np.zeros(1 << SCREEN, bool)
    screen[places] = True
    sent = texts.sparkSession.sparkContext.broadcast(np.packbits(screen))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = np.unpackbits(sent.value).astype(bool)
        for b in batches:
            bodies = utf8(b, "text")
            for a, z in blocks(bodies):
                w = lowered(bodies[a:z])
                found = []
                for m in masks:
                    h = masked(w.h, m)
                    at = np.flatnonzero(passes[(h >> np.uint64(64 - SCREEN)).astype(np.int64)])
                    at = at[w.doc[at] == w.doc[at + len(m) - 1]]
                    found.append(np.stack((w.doc[at].astype(np.uint64), h[at])))
                both = np.concatenate(found, 1) if found else np.zeros((2, 0), np.uint64)
                if both.shape[1]:
                    order = np.lexsort(both)
                    both = both[:, order]
                    both = both[:, np.append(True, (both[:, 1:] != both[:, :-1]).any(0))]
                    yield pa.RecordBatch.from_arrays([pa.array(both[1].view(np.int64)), b.column(0).take(pa.array(both[0].astype(np.int64) + a))], names=["h", "row"])

    found = map_arrow(texts.select("row", "text"), run, "h long, row binary")
    return found.join(seeds.select("h", "ref").distinct(), "h").select("row", "ref").distinct()


def _overlaps(docs: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str) -> DataFrame:
    """row (hash of the text), item, first_word, n_words, n_equal of each distinct text and item that overlap."""
    items = benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("item_text")).where("item_text is not null").distinct()
    items = materialise(items.withColumn("ref", F.unhex(F.md5(F.concat(F.coalesce(F.col("item").cast("string"), F.lit("")), F.lit(" "), F.col("item_text"))))).select("ref", "item", "item_text"), "items")
    texts = docs.select(_row(text).alias("row"), F.col(text).alias("text")).where("text is not null")
    hits = materialise(_hits(texts, materialise(_seeds(items), "seeds")), "hits")
    wanted = hits.select("row").distinct()
    few = wanted.count() <= MOST_BROADCAST
    bodies = texts.join(F.broadcast(wanted) if few else wanted, "row", "left_semi").groupBy("row").agg(F.first("text").alias("text"))
    pairs = hits.join(bodies, "row").join(items, "ref").select("row", "item", "text", "item_text")
    kind = pairs.schema["item"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bodies, tests = utf8(b, "text"), utf8(b, "item_text")
            found = [(i, *x) for i, (t, s) in enumerate(zip(bodies, tests)) if (x := best_overlap(lowered([s]).h, lowered([t]).h))]
            at = pa.array([f[0] for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), *(pa.array([f[k] for f in found], pa.int32()) for k in (1, 2, 3))], names=["row", "item", "first_word", "n_words", "n_equal"])

    return materialise(map_arrow(pairs, run, f"row binary, item {kind}, first_word int, n_words int, n_equal int"), "overlaps")


def find_overlaps(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and test item that overlap: key, item, first_word, n_words, n_equal of the overlap with the most equal words, of equally
    good ones the first.

    Null and empty texts on either side overlap with nothing, nor do items without words; repeated documents give repeated
    results, a repeated item counts once; empty tables give no rows; other columns are ignored.
    """
    found = _overlaps(docs, benchmark, text, item, item_text)
    return docs.select(F.col(key).alias("key"), _row(text).alias("row")).join(found, "row").select(F.col("key").alias(key), F.col("item").alias(item), "first_word", "n_words", "n_equal")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of *docs* that overlap with no test item, with all their columns, whatever their names; null and empty texts stay, and
    so do repeated rows. An empty table on either side drops nothing."""
    names, rows = docs.columns, numbered(docs)
    bad = _overlaps(docs, benchmark, text, item, item_text).select("row").distinct()
    body = f"c{names.index(text)}"
    return rows.withColumn("own", _row(body)).join(bad, F.col("own") == F.col("row"), "left_anti").drop("own").toDF(*names)
