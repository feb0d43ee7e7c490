"""Incremental substring deduplication by a log-structured fingerprint index.

A passage is a window of consecutive words. Each window has an anchor: the gram of GRAM words with the smallest hash inside it,
which equal windows share. Consecutive windows with one anchor form an entry (hash of the anchor, digest of the words
that its windows cover, place). A batch of documents becomes an immutable run: its entries, and a summary with a row an anchor, both
bucketed and sorted by the anchor's hash. The summary of a new batch is merge-joined with those of the runs before it, which moves none of their
rows, and tells which anchors recur now; only entries of these are looked up in the runs. They are verified by digests of the words'
bytes: of all words an entry covers, and where these differ, window by window. Verdicts only ever grow, so a batch adds its own to those before.
Runs are compacted into one as they pile up.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm.common import OTHER_BASE, Words, blocks, map_arrow, mix, range_hash, utf8
from dossier.session import discard, materialise, scratch_path

WINDOW, GRAM = 35, 8
#: Windows that are looked at together: bounds the arrays for a very long text.
SEGMENT = 1 << 22
#: Texts whose windows are checked one by one are picked out by a broadcast of so many 8-byte keys at most; beyond, by the join alone.
MOST_BROADCAST = 4_000_000
#: Runs that an index keeps before it compacts them.
MOST_RUNS = 2
#: Entries of an anchor that stand together in a run; those of a more frequent one are dealt out over as many places as it takes.
HOT = 1024

_POSITION = np.uint64(24)


def spaced(texts: list[bytes | None]) -> list[bytes]:
    """Texts with one space between words: equal words, wherever they stand, are equal bytes."""
    return [b" ".join(t.split()) if t else b"" for t in texts]


def digest(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def entries(w: Words, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Of spaced() texts: text, first window (a word of the text), windows, hash of the anchor, digest of the covered words."""
    found = [_segment(w, a, min(len(w.h), a + SEGMENT + window - 1), window, gram) for a in range(0, max(0, len(w.h) - window + 1), SEGMENT)]
    doc, first, count, anchor = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.uint64 if k > 2 else np.int64) for k in range(4))
    at = first + w.first[doc]
    covered = np.fromiter((digest(w.data[a:z]) for a, z in zip(w.start[at].tolist(), w.end[at + count + window - 2].tolist())), np.int64, len(at))
    return doc, first, count, anchor, covered


def _segment(w: Words, low: int, high: int, window: int, gram: int) -> tuple[np.ndarray, ...]:
    h, doc = w.h[low:high], w.doc[low:high]
    n = len(h) - window + 1
    at = np.arange(len(h) - gram + 1)
    g = mix(range_hash(h, at, at + gram, OTHER_BASE))
    # The smallest hash (by its upper bits) and of equal ones the first, by doubling the width of the minimum.
    least, width, span = (g >> _POSITION << _POSITION) | at.astype(np.uint64), 1, window - gram + 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    place = (least[:n] & np.uint64((1 << 24) - 1)).astype(np.int64)
    valid = doc[:n] == doc[window - 1 : window - 1 + n]
    new = np.ones(n, bool)
    new[1:] = (place[1:] != place[:-1]) | (doc[1:n] != doc[: n - 1]) | ~valid[:-1]
    starts = np.flatnonzero(new & valid)
    # A run of windows ends where the next begins, or where windows cross the end of a text.
    edges = np.append(np.flatnonzero(new | ~valid), n)
    ends = edges[np.searchsorted(edges, starts, side="right")]
    return doc[starts], starts + low - w.first[doc[starts]], ends - starts, g[place[starts]]


def window_digests(w: Words, starts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Digests of the windows of a spaced() text that begin at the words *starts*."""
    return np.fromiter((digest(w.data[a:z]) for a, z in zip(w.start[starts].tolist(), w.end[starts + window - 1].tolist())), np.int64, len(starts))


def covered_words(n: int, starts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Of n words, whether each is covered by a window that begins at one of *starts*."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + window, n), -1)
    return np.cumsum(step[:n]) > 0


@dataclass(frozen=True)
class Run:
    """Names of a run's tables: anchors (anchor, n, low, high, parts), a row an anchor; entries (anchor, salt, covered, row, first, windows)."""

    anchors: str
    entries: str


class FingerprintIndex:
    """Immutable runs in the shared folder, bucketed and sorted alike, so that joining two moves no rows, and the verdicts so far.

    Texts are known to the index by `row`, a 128-bit hash; batches must stay readable, as windows of earlier texts are looked at again.
    """

    ENTRY = "anchor long, covered long, row binary, first int, windows int"

    def __init__(self, spark: SparkSession, buckets: int | None = None, window: int = WINDOW, gram: int = GRAM, most_runs: int = MOST_RUNS):
        self.spark, self.window, self.gram, self.most_runs = spark, window, gram, most_runs
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs: list[Run] = []
        self.batches: list[DataFrame] = []
        self.verdicts: list[DataFrame] = []
        self.compactions = 0
        self.paths: dict[str, str] = {}

    def _table(self, rows: DataFrame, kind: str, *by: str) -> str:
        name = f"fingerprints_{kind}_{uuid.uuid4().hex}"
        self.paths[name] = scratch_path(self.spark, kind)
        dealt = rows.repartition(self.buckets, *by).sortWithinPartitions(*by)
        dealt.write.option("path", self.paths[name]).option("compression", "zstd").bucketBy(self.buckets, *by).sortBy(*by).saveAsTable(name, format="parquet")
        return name

    def _write(self, found: DataFrame, summary: DataFrame) -> Run:
        parts = F.ceil(F.col("n") / F.lit(HOT)).cast("int")
        anchors = self._table(summary.select("anchor", "n", "low", "high", parts.alias("parts")), "anchors", "anchor")
        hot = materialise(self.spark.table(anchors).where("parts > 1").select("anchor", "parts"), "hot")
        salt = F.coalesce(F.pmod(F.xxhash64("covered", "row"), F.col("parts")), F.lit(0)).cast("int")
        salted = found.join(hot, "anchor", "left").select("anchor", salt.alias("salt"), "covered", "row", "first", "windows")
        run = Run(anchors, self._table(salted, "entries", "anchor", "salt"))
        discard(self.spark, hot)
        return run

    def _entries(self, batch: DataFrame) -> DataFrame:
        window, gram = self.window, self.gram

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                texts, rows = utf8(b, "text"), b.column(0)
                for a, z in blocks(texts):
                    doc, first, count, anchor, covered = entries(Words(spaced(texts[a:z])), window, gram)
                    if len(doc):
                        yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(covered), rows.take(pa.array(doc + a)), pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32))], names=["anchor", "covered", "row", "first", "windows"])

        return map_arrow(batch.select("row", "text"), run, self.ENTRY)

    def append(self, batch: DataFrame) -> None:
        """Add a batch (row, text) as a run, and the verdicts that follow for it and for earlier batches; compact when there are too many runs."""
        fresh = materialise(self._entries(batch), "fresh")
        run = self._write(fresh, fresh.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("covered").alias("low"), F.max("covered").alias("high")))
        met = self.spark.table(run.anchors).select("anchor", "n", "low", "high")
        for old in self.runs:
            before = self.spark.table(old.anchors).select("anchor", F.col("n").alias("m"), F.col("low").alias("low2"), F.col("high").alias("high2"))
            met = met.join(before.hint("merge"), "anchor", "left").select("anchor", (F.col("n") + F.coalesce("m", F.lit(0))).alias("n"), F.least("low", "low2").alias("low"), F.greatest("high", "high2").alias("high"))
        touched = materialise(met.where("n > 1").select("anchor", (F.col("low") != F.col("high")).alias("mixed")), "touched")
        self.runs.append(run)
        self.batches.append(batch)
        found = reduce(DataFrame.unionByName, [self._lookup(r, touched) for r in self.runs])
        self.verdicts.append(self._judged(found))
        discard(self.spark, fresh, touched)
        if len(self.runs) > self.most_runs:
            self.compact()

    def _lookup(self, run: Run, touched: DataFrame) -> DataFrame:
        """A run's entries of the touched anchors."""
        known = self.spark.table(run.anchors).select("anchor", "parts")
        asked = touched.join(known.hint("merge"), "anchor").select("anchor", "mixed", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"))
        return self.spark.table(run.entries).join(asked.hint("merge"), ["anchor", "salt"]).drop("salt")

    def compact(self) -> None:
        """Merge all runs and all verdicts into one each."""
        if len(self.runs) < 2:
            return
        # Merge-joined like all runs: grouping a union of tables that are bucketed alike has been seen to leave an anchor in two rows.
        summary = self.spark.table(self.runs[0].anchors).select("anchor", "n", "low", "high")
        for r in self.runs[1:]:
            other = self.spark.table(r.anchors).select("anchor", F.col("n").alias("m"), F.col("low").alias("low2"), F.col("high").alias("high2"))
            summed = (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n")
            summary = summary.join(other.hint("merge"), "anchor", "full").select("anchor", summed, F.least("low", "low2").alias("low"), F.greatest("high", "high2").alias("high"))
        merged = self._write(reduce(DataFrame.unionByName, [self.spark.table(r.entries).drop("salt") for r in self.runs]), summary)
        told = materialise(self._merged(), "verdicts")
        self.close()
        self.runs, self.verdicts, self.compactions = [merged], [told], self.compactions + 1

    def close(self) -> None:
        """Drop the runs and verdicts with their files: whatever was asked of the index must have been written by then."""
        for r in self.runs:
            for t in (r.anchors, r.entries):
                self.spark.sql(f"DROP TABLE IF EXISTS {t}")
                discard(self.spark, self.paths.pop(t))
        discard(self.spark, *self.verdicts)
        self.runs, self.verdicts = [], []

    def _merged(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.verdicts).groupBy("anchor", "covered").agg(F.bit_or("mask").alias("mask"))

    def repeats(self) -> DataFrame:
        """row, first, mask: of each entry with windows (bit i: the i-th) that occur elsewhere."""
        found = reduce(DataFrame.unionByName, [self.spark.table(r.entries) for r in self.runs])
        return found.select("anchor", "covered", "row", "first").join(self._merged(), ["anchor", "covered"]).select("row", "first", "mask")

    def _judged(self, found: DataFrame) -> DataFrame:
        """anchor, covered, mask of each class of entries (those with one anchor and the same covered words) with windows that occur elsewhere.

        All windows of a class of two or more recur. Where an anchor has several classes, the windows of one entry of each are compared with
        those of the others.
        """
        window = self.window
        classes = materialise(found.groupBy("anchor", "covered").agg(F.count(F.lit(1)).alias("n"), F.first("mixed").alias("mixed"), F.min(F.struct("row", "first", "windows")).alias("x")).select("anchor", "covered", "n", "mixed", "x.*"), "classes")
        whole = classes.where("n > 1").select("anchor", "covered", F.expr("shiftleft(1L, windows) - 1").alias("mask"))
        asked = classes.where("mixed").groupBy("row").agg(F.collect_list(F.struct("anchor", "covered", "n", "first", "windows")).alias("x"))
        asked = materialise(asked.select("row", *(F.col(f"x.{c}").alias(c) for c in ("anchor", "covered", "n", "first", "windows"))), "asked")
        # Only texts that are asked for are shuffled; the others are left out where they are read, as long as the keys can be broadcast.
        few, wanted = asked.count() <= MOST_BROADCAST, asked.select("row")
        texts = reduce(DataFrame.unionByName, [b.select("row", "text").join(F.broadcast(wanted) if few else wanted, "row", "left_semi") for b in self.batches])
        met = texts.join(asked, "row")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                body, lists = spaced(utf8(b, "text")), [b.column(b.schema.get_field_index(c)) for c in ("anchor", "covered", "n", "first", "windows")]
                for i, t in enumerate(body):
                    anchor, covered, n, first, count = (x[i].values.to_numpy() for x in lists)
                    at = np.repeat(np.arange(len(first)), count)
                    offset = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
                    prints = window_digests(Words([t]), first[at] + offset, window)
                    yield pa.RecordBatch.from_arrays([pa.array(anchor[at]), pa.array(covered[at]), pa.array(n[at]), pa.array(offset.astype(np.int32)), pa.array(prints)], names=["anchor", "covered", "n", "offset", "print"])

        # A repeated row gives its windows twice, but then its classes count two or more anyway.
        windows = map_arrow(met, run, "anchor long, covered long, n long, offset int, print long")
        windows = materialise(windows, "windows")
        twice = windows.groupBy("anchor", "print").agg(F.sum("n").alias("total")).where("total > 1").select("anchor", "print")
        bits = windows.join(twice, ["anchor", "print"]).groupBy("anchor", "covered").agg(F.bit_or(F.expr("shiftleft(1L, `offset`)")).alias("mask"))
        judged = materialise(whole.unionByName(bits).groupBy("anchor", "covered").agg(F.bit_or("mask").alias("mask")), "judged")
        discard(self.spark, classes, asked, windows)
        return judged


def row_hash(key: str, text: str):
    """128 bits that tell rows apart by key and text."""
    told = F.concat(F.coalesce(F.concat(F.lit("+"), F.col(key).cast("string")), F.lit("-")), F.lit(" "), F.coalesce(F.col(text), F.lit("")))
    return F.unhex(F.md5(told))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, batches: int = 3, gram: int = GRAM) -> DataFrame:
    """Remove every word that lies in a window of *window* words which also begins anywhere else, in the same text or another; windows
    are judged on the input. Returns one row per row of *docs*: key, n_words, n_removed, kept_text.

    Words are runs of anything but ASCII white space, unchanged. A null text has no words. Texts shorter than a window keep all
    words. Repeated rows repeat each other's windows, so all their windows go. Null keys are keys like any other. An empty table gives no rows;
    other columns are ignored. The rows are indexed in *batches*, one after the other, as a growing corpus would be.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("row", row_hash("key", "text"))
    index = FingerprintIndex(docs.sparkSession, window=window, gram=gram)
    for b in range(batches):
        index.append(rows.where(F.pmod(F.xxhash64("row"), F.lit(batches)) == b))
    places = index.repeats().groupBy("row").agg(F.collect_set(F.struct("first", "mask")).alias("x"))
    places = materialise(places.select("row", F.col("x.first").alias("first"), F.col("x.mask").alias("mask")), "places")
    index.close()
    marked = rows.join(places, "row", "left").select("key", "text", "first", "mask")
    kind = marked.schema["key"].dataType.simpleString()

    def run(parts):
        for b in parts:
            first, mask = b.column(2), b.column(3)
            for a in range(0, b.num_rows, 64):
                texts = b.column(1).slice(a, 64).cast(pa.binary()).to_pylist()
                total, gone, kept = [], [], []
                for i, t in enumerate(texts, a):
                    words = t.split()
                    removed = 0
                    if first[i].is_valid:
                        at, bits = first[i].values.to_numpy(), mask[i].values.to_numpy()
                        row, offset = np.nonzero((bits[:, None] >> np.arange(window)) & 1)
                        cover = covered_words(len(words), at[row] + offset, window)
                        removed = int(cover.sum())
                        words = [w for w, c in zip(words, cover.tolist()) if not c]
                    total.append(len(words) + removed)
                    gone.append(removed)
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, 64), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=[key, "n_words", "n_removed", "kept_text"])

    return map_arrow(marked, run, f"`{key}` {kind}, n_words long, n_removed long, kept_text string")
