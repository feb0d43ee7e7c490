"""Language identification by error-correcting output codes.

Each language has a codeword; one binary classifier a bit, over hashed character n-grams inside words, predicts the bits of a
text's codeword. Decoding weighs the losses of the bits by how well each classifier did in training and takes the codeword
with the least loss; a small gap to the second is flagged as ambiguous.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dossier.llm.common import blocks, map_arrow, utf8
from dossier.session import materialise

#: Hashed n-gram features; n-gram lengths in bytes; training rows a language at most (the bound on what the driver holds).
FEATURES, GRAMS, TRAIN_ROWS_PER_LANG = 1 << 14, (1, 2, 3), 400
#: Languages whose limits are broadcast to pick out texts; more are joined by a shuffle.
MOST_BROADCAST = 100_000
UNKNOWN = "und"
AMBIGUOUS_GAP = 0.1


def codewords(n: int) -> np.ndarray:
    """n codewords of +-1: all two-way splits of the languages for up to 5 languages (any two words then differ in over half of
    the bits), seeded random ones with 8 bits a doubling beyond."""
    if n <= 5:
        splits = [(1, *rest) for rest in itertools.product((1, -1), repeat=n - 1) if -1 in rest]
        return np.array(splits, np.int8).T.reshape(n, -1) if splits else np.ones((n, 1), np.int8)
    rng = np.random.default_rng(n)
    bits = 8 * max(4, int(np.ceil(np.log2(n))))
    best = max((rng.choice(np.array([1, -1], np.int8), (n, bits)) for _ in range(200)), key=lambda c: min((c[i] != c[j]).sum() for i in range(n) for j in range(i)))
    return best


_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[i for i in range(128) if not chr(i).isalpha()]] = True


def features(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For one n-gram length after the other: the text and the hashed feature of each n-gram of letters, with a mark where words
    begin and end. Case is folded for A-Z; n-grams never span two words' letters or two texts."""
    body = b"\x00".join(t or b"" for t in texts)
    raw = np.frombuffer(body.lower(), np.uint8)
    if not len(raw):
        return
    cut = _SEPARATOR[raw]
    raw = np.where(cut, 0, raw).astype(np.uint8)
    sizes = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)[: len(raw)]
    for n in GRAMS:
        count = len(raw) - n + 1
        if count <= 0:
            continue
        h = np.zeros(count, np.uint32)
        gap = np.zeros(count, np.int8)
        for k in range(n):
            part = raw[k : k + count]
            h = h * np.uint32(257) + part
            if 0 < k < n - 1 or n == 1:
                gap += part == 0  # a separator inside, or alone
        if n > 1:
            gap += (raw[:count] == 0) & (raw[n - 1 : n - 1 + count] == 0)
        h = (h ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
        keep = gap == 0
        yield doc[:count][keep], (h[keep] & np.uint32(FEATURES - 1)).astype(np.int32)


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # features x bits
    bias: np.ndarray
    trust: np.ndarray  # of each bit

    def margins(self, texts: list[bytes | None]) -> np.ndarray:
        out = np.zeros((len(texts), self.weights.shape[1]))
        n = np.zeros(len(texts))
        for doc, f in features(texts):
            n += np.bincount(doc, minlength=len(texts))
            for b in range(out.shape[1]):
                out[:, b] += np.bincount(doc, self.weights[:, b][f], minlength=len(texts))
        return out / np.maximum(n, 1)[:, None] + self.bias

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its score and whether the decision is ambiguous, of each row of margins."""
        loss = (np.logaddexp(0, -margins[:, None, :] * self.code[None]) * self.trust).sum(2) / self.trust.sum()
        order = np.argsort(loss, 1, kind="stable")
        near = np.exp(-(loss - loss.min(1, keepdims=True)) * self.code.shape[1])
        share = near / near.sum(1, keepdims=True)
        best = order[:, 0]
        gap = np.take_along_axis(loss, order[:, 1:2], 1)[:, 0] - loss[np.arange(len(loss)), best] if len(self.langs) > 1 else np.full(len(loss), np.inf)
        return best, share[np.arange(len(loss)), best], gap < AMBIGUOUS_GAP


def bag(texts: list[bytes | None]) -> np.ndarray:
    """The share of each feature in each text."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    for doc, f in features(texts):
        flat = np.bincount(doc.astype(np.int64) * FEATURES + f, minlength=out.size).reshape(out.shape)
        out += flat
    return out / np.maximum(out.sum(1, keepdims=True), 1)


def fit(x: np.ndarray, langs: list[str], rounds: int = 60, rate: float = 0.15) -> Model:
    """Train all bits at once on rows of bag(): logistic loss by Adam over mini-batches in a fixed order, in as many
    rounds whatever the number of rows. No rows: a model that
    only knows `und`."""
    names = sorted(set(langs))
    if not names:
        return Model([UNKNOWN], np.ones((1, 1), np.int8), np.zeros((FEATURES, 1), np.float32), np.zeros(1), np.ones(1))
    code = codewords(len(names))
    used = np.flatnonzero(x.any(0))
    x = x[:, used]
    scale = float(np.sqrt(len(GRAMS))) * 40
    y = code[[names.index(v) for v in langs]].astype(np.float32)
    rng = np.random.default_rng(0)
    held = rng.permutation(len(x)) % 10 == 0 if len(x) >= 100 else np.zeros(len(x), bool)
    w, bias = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    train, step = np.flatnonzero(~held), 0
    for _ in range(rounds):
        rng.shuffle(train)
        for a in range(0, len(train), 128):
            i = train[a : a + 128]
            z = scale * (x[i] @ w) + bias
            g = -y[i] / (1 + np.exp(y[i] * z)) / len(i)
            gw = scale * (x[i].T @ g) + 1e-5 * w
            step += 1
            m = 0.9 * m + 0.1 * gw
            v = 0.99 * v + 0.01 * gw * gw
            w -= rate * 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            bias -= 0.05 * g.sum(0)
    check = held if held.any() else ~held
    good = (np.sign(scale * (x[check] @ w) + bias) == y[check]).mean(0)
    trust = np.log((good * 0.98 + 0.015) / (1 - good * 0.98 - 0.005)).clip(0.05)
    weights = np.zeros((FEATURES, y.shape[1]), np.float32)
    weights[used] = scale * w
    return Model(names, code, weights, bias.astype(np.float64), trust)


def fold_of(key: str):
    """The remainder that holds a row out of learning: crc32 of the key as text, modulo 5."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(5))


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_lang: int = TRAIN_ROWS_PER_LANG) -> Model:
    """Fit on at most *per_lang* rows of each language: those with the smallest hash of (key, text) among rows that are not held
    out and have a language and a text; of equal hashes those of the smaller text. A language's limit is found by ranking hashes; only
    texts below it are moved. Without rows to learn from, the model says `und`."""
    rows = docs.where((fold_of(key) != 0) & F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.col(text) != ""))
    rows = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(key, text).alias("h"))
    # Hashes alone are ranked, in ever fewer buckets, each of which keeps per_lang of them: no task gets more than 32 times per_lang.
    local = rows.select("lang", "h")
    for n in (1024, 32, 1):
        best = Window.partitionBy("lang", F.pmod("h", F.lit(n))).orderBy("h")
        local = local.withColumn("r", F.row_number().over(best)).where(F.col("r") <= per_lang)
    limits = materialise(local.groupBy("lang").agg(F.max("h").alias("most")).withColumnRenamed("lang", "of"), "limits")
    few = limits.count() <= MOST_BROADCAST
    near = rows.join(F.broadcast(limits) if few else limits, (F.col("lang") == F.col("of")) & (F.col("h") <= F.col("most"))).select("lang", "text", "h")
    # Equal hashes may exceed per_lang (repeated rows do); the last rank settles it.
    last = Window.partitionBy("lang").orderBy("h", "text")
    picked = near.withColumn("r", F.row_number().over(last)).where(F.col("r") <= per_lang).select("lang", "text", "r")

    def sparse(batches):
        for b in batches:
            texts = utf8(b, "text")
            for a, z in blocks(texts, 1 << 19):
                for i in range(a, z):
                    row = bag(texts[i : i + 1])[0]
                    at = np.flatnonzero(row).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(i, 1), b.column(2).slice(i, 1), pa.array([at], pa.list_(pa.int32())), pa.array([row[at]], pa.list_(pa.float32()))], names=["lang", "r", "at", "share"])

    found = map_arrow(picked, sparse, "lang string, r int, at array<int>, share array<float>").orderBy("lang", "r").toArrow()
    x = np.zeros((found.num_rows, FEATURES), np.float32)
    for i, (at, share) in enumerate(zip(found.column("at"), found.column("share"))):
        x[i, at.values.to_numpy()] = share.values.to_numpy()
    return fit(x, found.column("lang").to_pylist())


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, lang_pred, score, ambiguous of every whole text. `und` with score 0 where the text is null or has no letter.
    A null key hashes as the empty string; repeated rows give repeated results; an empty table gives no rows; other columns are
    ignored. Of languages with equal losses the first by name is taken, and the row counts as ambiguous."""
    kind = docs.schema[key].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)  # features x bits: of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        names = np.array(m.langs, object)
        for b in batches:
            texts = utf8(b, text)
            for a, z in blocks(texts):
                part = texts[a:z]
                letters = np.array([bool(t) and any(map(str.isalpha, t.decode())) for t in part])
                best, score, vague = m.decode(m.margins(part))
                said = np.where(letters, names[best], UNKNOWN)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, z - a), b.column(1).slice(a, z - a), pa.array(said, pa.string()), pa.array(np.where(letters, score, 0.0)), pa.array(letters & vague)], names=[key, "held_out", "lang_pred", "score", "ambiguous"])

    rows = docs.select(key, (fold_of(key) == 0).alias("held_out"), text)
    return map_arrow(rows, run, f"`{key}` {kind}, held_out boolean, lang_pred string, score double, ambiguous boolean")
