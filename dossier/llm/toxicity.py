"""Toxicity by non-negative positive-unlabelled learning.

Positives are documents confirmed as toxic; everything else is unlabelled text, toxic or not. With the class prior p the risk of
a classifier f is  p R+(f on positives) + max(0, Ru-(f on unlabelled) - p R-(f on positives)):  the second term estimates the
risk on negatives, and held at zero it can't reward memorised positives. f is linear in the presence of words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.llm.common import Words, blocks, map_arrow, numbered, utf8
from dossier.llm.langid import fold_of

#: Bounds of the training sample, in documents, and of the features.
POSITIVES, UNLABELLED, MOST_FEATURES = 4000, 12000, 1 << 15
#: A feature is a word whose share of positive documents exceeds its share of unlabelled ones by so many standard errors.
LEAST_Z, LEAST_DOCUMENTS = 4.5, 3
#: Bits of the table that screens words before the exact look-up.
SCREEN = 20

#: Words are runs of ASCII letters and digits and of bytes beyond ASCII.
SEPARATORS = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


def lowered(texts: list[bytes | None]) -> Words:
    return Words([t.lower() if t else t for t in texts], SEPARATORS)


@dataclass
class Model:
    words: np.ndarray  # sorted 64-bit hashes
    weights: np.ndarray
    bias: float

    def logits(self, texts: list[bytes | None]) -> np.ndarray:
        """The bias plus the weight of each known word that occurs, once a text."""
        out = np.full(len(texts), self.bias)
        if not len(self.words):
            return out
        if not hasattr(self, "_screen"):
            self._screen = np.zeros(1 << SCREEN, bool)
            self._screen[(self.words >> np.uint64(64 - SCREEN)).astype(np.int64)] = True
        w = lowered(texts)
        maybe = np.flatnonzero(self._screen[(w.h >> np.uint64(64 - SCREEN)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.words, w.h[maybe]), len(self.words) - 1)
        hit = self.words[at] == w.h[maybe]
        pairs = np.unique(w.doc[maybe][hit].astype(np.int64) * len(self.words) + at[hit])
        return out + np.bincount(pairs // len(self.words), self.weights[pairs % len(self.words)], minlength=len(texts))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, rounds: int = 400, rate: float = 0.05, l2: float = 1e-4) -> Model:
    """Fit on the distinct word hashes of each document. Without positives or unlabelled rows the model only knows the prior."""
    prior = float(np.clip(prior, 1e-6, 1 - 1e-6))
    empty = Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(prior / (1 - prior))))
    if not positive or not unlabelled:
        return empty
    in_p, n_p = np.unique(np.concatenate(positive), return_counts=True)
    in_u, n_u = np.unique(np.concatenate(unlabelled), return_counts=True)
    at = np.minimum(np.searchsorted(in_u, in_p), max(0, len(in_u) - 1))
    other = np.where(in_u[at] == in_p, n_u[at], 0) if len(in_u) else np.zeros(len(in_p))
    pooled = (n_p + other) / (len(positive) + len(unlabelled))
    error = np.sqrt(np.maximum(pooled * (1 - pooled), 1e-12) * (1 / len(positive) + 1 / len(unlabelled)))
    z = (n_p / len(positive) - other / len(unlabelled)) / error
    order = np.argsort(-z, kind="stable")[:MOST_FEATURES]
    words = np.sort(in_p[order[(z[order] >= LEAST_Z) & (n_p[order] >= LEAST_DOCUMENTS)]])
    if not len(words):
        return empty

    def rows(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        h = np.concatenate(docs)
        at = np.minimum(np.searchsorted(words, h), len(words) - 1)
        ok = words[at] == h
        return doc[ok], at[ok]

    (pd, pf), (ud, uf) = rows(positive), rows(unlabelled)
    w, bias = np.zeros(len(words)), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(words) + 1), np.zeros(len(words) + 1)
    for step in range(1, rounds + 1):
        zp = bias + np.bincount(pd, w[pf], minlength=len(positive))
        zu = bias + np.bincount(ud, w[uf], minlength=len(unlabelled))
        sp, su = _sigmoid(zp), _sigmoid(zu)
        negative = np.mean(np.logaddexp(0, zu)) - prior * np.mean(np.logaddexp(0, zp))
        # Of the logistic losses: positives as positives, unlabelled as negatives, positives as negatives.
        gp, gu = prior * (sp - 1) / len(sp), np.zeros(len(su))
        if negative >= 0:
            gp = gp - prior * sp / len(sp)
            gu = su / len(su)
        else:  # the estimate fell below zero: step back from it
            gp = prior * sp / len(sp)
            gu = -su / len(su)
        grad = np.append(np.bincount(pf, gp[pd], minlength=len(w)) + np.bincount(uf, gu[ud], minlength=len(w)) + l2 * w, gp.sum() + gu.sum())
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w = w - move[:-1]
        bias -= move[-1]
    return Model(words, w, float(bias))


def _word_sets(docs: DataFrame, key: str, text: str) -> list[np.ndarray]:
    def run(batches):
        for b in batches:
            texts = utf8(b, text)
            for a, z in blocks(texts):
                w = lowered(texts[a:z])
                sets = [np.unique(w.h[i:j]).view(np.int64) for i, j in zip(w.first, w.first[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(sets, pa.list_(pa.int64()))], names=["words"])

    # In the order of the sets themselves, so that the model doesn't hang on the order of tasks. One text a key bounds what is collected.
    texts = docs.select(key, text).groupBy(key).agg(F.min(text).alias(text))
    found = map_arrow(texts, run, "words array<long>").toArrow().column("words")
    sets = [x.values.to_numpy().view(np.uint64) if x.is_valid else np.zeros(0, np.uint64) for x in found]
    return sorted(sets, key=lambda s: (len(s), s[:8].tolist()))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic") -> Model:
    """Fit on rows that are not held out: at most POSITIVES documents labelled 1 and UNLABELLED documents of any kind, those with the
    smallest hash of their key. The prior is the share of 1 among all labels that are not held out.

    Null labels and keys are ignored; of several labels of one key the largest counts, and of several texts the smallest. Keys with equal
    hashes are taken in order of the keys. Sampled keys are at most POSITIVES + UNLABELLED rows, so they are broadcast to the scan of the texts.
    Empty tables give a model of the prior alone.
    """
    known = labels.where((fold_of(key) != 0) & F.col(key).isNotNull() & F.col(toxic).isNotNull()).groupBy(key).agg((F.max(toxic) == 1).alias("y"))
    share = known.agg(F.avg(F.col("y").cast("double")).alias("p")).first()["p"]
    some = lambda df, n: F.broadcast(df.select(F.col(key).alias("__k")).orderBy(*by_hash_of("__k")).limit(n))
    positive = docs.join(some(known.where("y"), POSITIVES), F.col(key) == F.col("__k"), "left_semi")
    others = docs.where((fold_of(key) != 0) & F.col(key).isNotNull())
    unlabelled = docs.join(some(others, UNLABELLED), F.col(key) == F.col("__k"), "left_semi")
    return nnpu(_word_sets(positive, key, text), _word_sets(unlabelled, key, text), share or 0.0)


def by_hash_of(column: str) -> list:
    return [F.xxhash64(column), F.col(column)]


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """*docs* with score and predicted for every whole text (null counts as empty). Repeated rows get equal scores; an empty table gives no
    rows; columns named score or predicted are replaced; a score at the threshold counts as toxic."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most MOST_FEATURES words
    docs = docs.drop("score", "predicted")
    fields, at = docs.columns, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).cast(pa.binary()).to_pylist()
            for a, z in blocks(texts):
                s = _sigmoid(sent.value.logits(texts[a:z]))
                yield pa.RecordBatch.from_arrays([*b.slice(a, z - a).columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=[*fields, "score", "predicted"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return map_arrow(docs, run, f"{kinds}, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of *docs* that score below the threshold, with all their columns, whatever their names."""
    names, rows = docs.columns, numbered(docs)
    scored = score(rows, model, f"c{names.index(key)}", f"c{names.index(text)}", threshold)
    return scored.where("predicted = 0").drop("score", "predicted").toDF(*names)
