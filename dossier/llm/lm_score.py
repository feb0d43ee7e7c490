"""Cross-entropy difference of two matched n-gram models.

Target and background models are interpolated bigram models with exact counts of every word and pair of words of the corpus. They share
one vocabulary and are matched: the larger model's counts are scaled to the smaller's number of words, so that smoothing, which is
the same for both, weighs the same, and scores differ in nothing but the text. The background is the whole corpus, the target included. A document's score is its loss a token under the target model less that
under the background model: the lower, the more it resembles the target.

Words and pairs (grams) are 64-bit keys. Documents are dealt into groups; each group sends its distinct grams with its own counts to
buckets by the upper bits of the key, where they are summed, and gets the sums back. Groups and buckets are as many
as the corpus needs, and no table is held whole in one place.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.llm.common import Words, blocks, map_arrow, mix, utf8
from dossier.llm.toxicity import lowered
from dossier.session import materialise, ship_package

#: Bytes of text behind a bucket of grams and in a group of documents: their numbers grow with the input. Buckets at least.
BUCKET_BYTES, GROUP_BYTES, LEAST_BUCKETS = 1 << 24, 1 << 23, 64
#: Words that are looked up or scored at once.
STEP = 1 << 16
#: Weight of the unigram model in bigram counts.
BACKOFF = 4.0

_ONE = np.uint64(1)
#: What stands before the first word of a text.
START = np.uint64(0x5D588B656C078965)


def word_keys(h: np.ndarray) -> np.ndarray:
    """Keys of words are odd, those of pairs even."""
    return mix(h) | _ONE


def pair_keys(before: np.ndarray, h: np.ndarray) -> np.ndarray:
    return mix(mix(before) * np.uint64(0x9E3779B97F4A7C15) + h) & ~_ONE


def words_before(w: Words) -> np.ndarray:
    """The word before each word; before the first word of a text stands a start mark."""
    before = np.empty_like(w.h)
    before[1:] = w.h[:-1]
    before[w.first[:-1][w.first[:-1] < w.first[1:]]] = START
    return before


@dataclass
class Vocabulary:
    """Words of a small corpus, to look at or to compare with; the models don't need it."""

    words: np.ndarray  # sorted hashes; a word's id is its place, the unknown word's is their number

    def ids(self, h: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, at, len(self.words))

    def cells(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """The id of each word and the key of (word before, word)."""
        return self.ids(w.h), pair_keys(words_before(w), w.h)


def vocabulary(docs: DataFrame, text: str = "text", size: int | None = None) -> Vocabulary:
    """The *size* most frequent words (all by default) of a corpus whose words fit the driver; of equally frequent ones those of
    the smaller hash."""

    def run(batches):
        for b in batches:
            for a, z in blocks(texts := utf8(b, text)):
                h, n = np.unique(lowered(texts[a:z]).h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

    found = map_arrow(docs.select(text), run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word")
    top = (found if size is None else found.limit(size)).select("word").toArrow().column("word")
    return Vocabulary(np.sort(top.to_numpy().view(np.uint64)))


def matched_size(totals: tuple[int, int]) -> int:
    """The number of words that both models count as: the smaller one's, so that smoothing weighs the same in both."""
    return min(totals)


def total_bytes(docs: DataFrame, text: str) -> int:
    return int(docs.agg(F.sum(F.octet_length(text))).first()[0] or 0)


def planes(x: np.ndarray) -> bytes:
    """64-bit numbers as bytes: how many bytes the largest has, then the lowest of all, and so on up to that many."""
    width = max(1, (int(x.view(np.uint64).max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + x.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def numbers(x: bytes) -> np.ndarray:
    low = np.frombuffer(x, np.uint8, offset=1).reshape(x[0], -1)
    out = np.zeros((low.shape[1], 8), np.uint8)
    out[:, : x[0]] = low.T
    return out.view(np.int64).ravel()


def coded(keys: np.ndarray) -> bytes:
    """Sorted keys by their differences."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def decoded(x: bytes) -> np.ndarray:
    return np.cumsum(numbers(x).view(np.uint64), dtype=np.uint64)


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct values and each one's place among them: as np.unique, in about half the memory."""
    found = np.sort(x)
    found = found[np.append(True, found[1:] != found[:-1])[: len(found)]]
    place = np.empty(len(x), np.int32)
    for a in range(0, len(x), STEP):
        place[a : a + STEP] = np.searchsorted(found, x[a : a + STEP])
    return found, place


class Grams:
    """The sorted distinct grams of texts (keys), and for every word of the texts its doc and the place in *keys* of itself (word), of the
    word before it (before) and of both as a pair (pair)."""

    def __init__(self, texts: list[bytes | None]):
        found = [(w.h, words_before(w) == START, (w.doc + a).astype(np.int32)) for a, z in blocks(texts) if len((w := lowered(texts[a:z])).h)]
        h, self.first, self.doc = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, (np.uint64, bool, np.int32)[k]) for k in range(3))
        del found
        words, ids = distinct(np.append(h, START))
        del h
        start, ids = ids[-1], ids[:-1]
        before = np.where(self.first, start, np.roll(ids, 1))
        pairs, pair = distinct(before * np.int64(len(words)) + ids)
        keys = np.concatenate((word_keys(words), pair_keys(words[pairs // len(words)], words[pairs % len(words)])))
        n_words = len(words)
        del words, pairs
        order = np.argsort(keys)
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        self.keys, self.word, self.before = keys[order], place[ids], place[before]
        pair += np.int32(n_words)
        self.pair = place[pair]

    def counts(self, chosen: np.ndarray) -> np.ndarray:
        """How often each gram occurs in the chosen texts; the start mark once a text with words."""
        out = np.zeros(len(self.keys), np.int64)
        for at, more in ((self.word, True), (self.pair, True), (self.before, self.first)):
            out += np.bincount(at[chosen[self.doc] & more], minlength=len(out))
        return out

    def losses(self, n_texts: int, seen: tuple[np.ndarray, np.ndarray], known: int, totals: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Words of each text and its mean loss a word under both models (0 without words), with the models' counts of *keys*."""
        n, out = np.bincount(self.doc, minlength=n_texts), np.zeros((2, n_texts))
        size = matched_size(totals)
        for k in range(2):
            scale = size / max(totals[k], 1)
            loss = np.empty(len(self.doc))
            for a in range(0, len(loss), STEP):
                part = slice(a, a + STEP)
                share = (scale * seen[k][self.word[part]] + 1) / (scale * totals[k] + known + 1)
                p = (scale * seen[k][self.pair[part]] + BACKOFF * share) / (scale * seen[k][self.before[part]] + BACKOFF)
                loss[part] = -np.log(p)
            out[k] = np.bincount(self.doc, loss, minlength=n_texts) / np.maximum(n, 1)
        return n, out


@dataclass
class Models:
    """What the models are counted over: documents, and the keys (__k) of the target. They are counted as documents are scored."""

    docs: DataFrame
    target: DataFrame
    key: str
    text: str


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", quality: str = "quality") -> Models:
    """Models of all documents; the target are those labelled 1. Null labels and keys are ignored; of several labels of
    one key the largest counts."""
    good = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).cast(docs.schema[key].dataType).alias("__k")).agg((F.max(quality) == 1).alias("__target")).where("__target")
    return Models(docs, good.select("__k"), key, text)


def _dealt(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, int]:
    """Documents (__key, __text) in groups by key (by text without one), and how many groups."""
    groups = 1 + total_bytes(docs, text) // GROUP_BYTES
    of = F.when(F.col(key).isNull(), F.xxhash64(text)).otherwise(F.xxhash64(key))
    dealt = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"), F.pmod(of, F.lit(groups)).cast("int").alias("__group"))
    return dealt.repartition(groups, "__group"), groups


SENT = "__group int, bucket int, counts boolean, asks boolean, keys binary, target binary, background binary"
REPLY = "__group int, bucket int, target binary, background binary, n_words long, n_target long, n_background long"


def _sent(dealt: DataFrame, groups: int, target: DataFrame, buckets: int, counts: bool, asks: bool) -> DataFrame:
    """The distinct grams of each group by bucket with the group's counts. Labels grow with the documents, so they aren't broadcast."""
    bits = np.uint64(64 - (buckets.bit_length() - 1))

    def run(docs: pa.Table, good: pa.Table) -> pa.Table:
        texts = docs.column("__text").cast(pa.binary()).to_pylist()
        g, n_texts = Grams(texts), len(texts)
        del texts
        wanted = pc.is_in(docs.column("__key"), value_set=good.column("__k").combine_chunks()).to_numpy(zero_copy_only=False).astype(bool) if good.num_rows else np.zeros(n_texts, bool)
        at = np.append(np.searchsorted(g.keys, np.arange(buckets, dtype=np.uint64) << bits), len(g.keys))
        rows = [k for k in range(buckets) if at[k] < at[k + 1]] if len(g.doc) else []
        columns = [[coded(g.keys[at[k] : at[k + 1]]) for k in rows]]
        for chosen in (wanted, np.ones(n_texts, bool)):
            n = g.counts(chosen)
            columns.append([planes(n[at[k] : at[k + 1]]) for k in rows])
        same = lambda x, kind: pa.array([x] * len(rows), kind)
        group = docs.column("__group")[0].as_py() if docs.num_rows else None
        return pa.table([same(group, pa.int32()), pa.array(rows, pa.int32()), same(counts, pa.bool_()), same(asks, pa.bool_()), *(pa.array(c, pa.binary()) for c in columns)], names=["__group", "bucket", "counts", "asks", "keys", "target", "background"])

    marked = target.select("__k", F.pmod(F.xxhash64("__k"), F.lit(groups)).cast("int").alias("__group"))
    return dealt.groupBy("__group").cogroup(marked.groupBy("__group")).applyInArrow(run, SENT)


def _summed(sent: pa.Table) -> pa.Table:
    """One bucket: the sums of all groups that count, told to each group that asks, for its own grams. The row of no group (-1) holds
    the bucket's distinct words and how often they occur."""
    parts = [decoded(x) for x in sent.column("keys").to_pylist()]
    counting, asking = sent.column("counts").to_pylist(), sent.column("asks").to_pylist()
    ends = np.cumsum([0, *map(len, parts)])
    keys, at = np.unique(np.concatenate(parts), return_inverse=True)
    sums = []
    for c in ("target", "background"):
        total = np.zeros(len(keys), np.int64)
        for x, counts, a, z in zip(sent.column(c), counting, ends, ends[1:]):
            if counts:
                np.add.at(total, at[a:z], numbers(x.as_py()))
        sums.append(total)
    word = ((keys & _ONE) == _ONE) & (keys != word_keys(np.array([START]))) & (sums[1] > 0)
    rows = [j for j, x in enumerate(asking) if x]
    groups, bucket = sent.column("__group").to_pylist(), sent.column("bucket")[0].as_py()
    told = [[planes(n[at[ends[j] : ends[j + 1]]]) for j in rows] for n in sums]
    totals = [int(word.sum()), int(sums[0][word].sum()), int(sums[1][word].sum())]
    return pa.table(
        [pa.array([groups[j] for j in rows] + [-1], pa.int32()), pa.array([bucket] * (len(rows) + 1), pa.int32()), *(pa.array([*x, b""], pa.binary()) for x in told), *(pa.array([0] * len(rows) + [t], pa.int64()) for t in totals)],
        names=["__group", "bucket", "target", "background", "n_words", "n_target", "n_background"],
    )


def score(docs: DataFrame, models: Models, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_words, loss_target, loss_background, score of every whole text. Texts without words (null, empty) have losses and
    score 0; words and pairs that the models haven't seen count 0; repeated rows give repeated results; an empty table gives no
    rows; other columns are ignored. *docs* are read twice and must be the same both times."""
    ship_package(docs.sparkSession)
    same = docs is models.docs and (key, text) == (models.key, models.text)
    dealt, groups = _dealt(docs, key, text)
    buckets = max(LEAST_BUCKETS, 1 << (total_bytes(models.docs, models.text) // BUCKET_BYTES).bit_length())
    sent = _sent(dealt, groups, models.target if same else models.target.limit(0), buckets, same, True)
    if not same:
        sent = sent.unionByName(_sent(*_dealt(models.docs, models.key, models.text), models.target, buckets, True, False))
    replies = materialise(sent.groupBy("bucket").applyInArrow(_summed, REPLY), "grams")
    known, *totals = replies.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("n_words", "n_target", "n_background"))).first()

    def judged(part: pa.Table, told: pa.Table) -> pa.Table:
        texts = part.column("__text").cast(pa.binary()).to_pylist()
        g, n_texts = Grams(texts), len(texts)
        del texts
        told = told.sort_by("bucket")
        seen = [np.concatenate([np.zeros(0, np.int64), *map(numbers, told.column(c).to_pylist())]) for c in ("target", "background")]
        if len(g.doc) and len(seen[0]) != len(g.keys):
            raise ValueError("the documents changed while they were scored")
        n, (t, b) = g.losses(n_texts, seen, known, totals)
        return pa.table([part.column("__key"), pa.array(n), pa.array(t), pa.array(b), pa.array(t - b)], names=[key, "n_words", "loss_target", "loss_background", "score"])

    told = replies.where("__group >= 0").select("__group", "bucket", "target", "background")
    out = f"`{key}` {docs.schema[key].dataType.simpleString()}, n_words long, loss_target double, loss_background double, score double"
    return dealt.groupBy("__group").cogroup(told.groupBy("__group")).applyInArrow(judged, out)
