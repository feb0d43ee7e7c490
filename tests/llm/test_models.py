from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from dossier.llm import langid, lm_score, toxicity


@pytest.fixture(scope="module")
def prose(spark):
    rng = random.Random(5)
    parts = {"en": ["the", "and", "ing", "tion", "th", "er"], "de": ["der", "und", "sch", "keit", "ung", "ver"], "fr": ["les", "eau", "oux", "que", "ment", "é"]}
    bad = ["vile", "wretch", "scoundrel"]
    rows, labels = [], []
    for i in range(600):
        lang = rng.choice(list(parts))
        words = ["".join(rng.choices(parts[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(20, 60))]
        toxic = int(rng.random() < 0.2)
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), lang, "s", 0, "x", 0.5))
        if i % 2 == 0:
            labels.append((i, int(lang == "en"), toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, label string, score double")
    truth = {r[0]: any(b in r[1].split() for b in bad) for r in rows}
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), truth, rows


def odd(spark, docs):
    return spark.createDataFrame([(1001, None), (1002, ""), (1003, "123 !!"), (1004, "漢字"), (None, "vile wretch"), (1005, "the " * 5000), (1005, "the " * 5000)], "doc_id long, text string")


def test_toxicity_is_learnt_from_positives_and_unlabelled(spark, prose):
    docs, labels, truth, _ = prose
    out = toxicity.score(docs, toxicity.train(docs, labels))
    assert out.columns == [*[c for c in docs.columns if c != "score"], "score", "predicted"]
    got = {r["doc_id"]: (r["predicted"], r["score"]) for r in out.collect()}
    assert all(0 <= s <= 1 and p == (s >= 0.5) for p, s in got.values())
    wrong = sum(bool(got[i][0]) != t for i, t in truth.items())
    assert wrong <= 0.03 * len(truth)


def test_toxicity_ignores_held_out_labels(spark, prose):
    docs, labels, _, _ = prose
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    flipped = labels.selectExpr("doc_id", "quality", f"case when doc_id in ({','.join(map(str, held))}) then 1 - toxic else toxic end as toxic")
    a, b = toxicity.train(docs, labels), toxicity.train(docs, flipped)
    assert np.array_equal(a.words, b.words) and np.allclose(a.weights, b.weights) and a.bias == b.bias


def test_toxicity_of_odd_tables(spark, prose):
    docs, labels, _, _ = prose
    model = toxicity.train(docs, labels)
    got = toxicity.score(odd(spark, docs), model).collect()
    assert len(got) == 7 and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score(docs.limit(0), model).count() == 0
    blank = toxicity.train(docs, labels.limit(0))
    assert all(r["predicted"] == 0 for r in toxicity.score(docs.limit(20), blank).collect())
    nulls = spark.createDataFrame([(None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    toxicity.train(docs, labels.unionByName(nulls))


def test_the_risk_estimator_steps_back_below_zero():
    """Positives that look like all unlabelled text leave no negatives; the fit stays finite."""
    same = [np.array([1, 2, 3], np.uint64)] * 30
    m = toxicity.nnpu(same, same, 0.9)
    assert np.isfinite(m.bias) and np.isfinite(m.weights).all()


def test_languages_are_told(spark, prose):
    docs, _, _, rows = prose
    out = langid.predict(docs, langid.train(docs))
    truth = {r[0]: r[2] for r in rows}
    got = out.collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    odd_rows = langid.predict(odd(spark, docs), langid.train(docs)).collect()
    said = {(r["doc_id"], r["lang_pred"]) for r in odd_rows}
    assert {(1001, "und"), (1002, "und"), (1003, "und")} <= said and all(0 <= r["score"] <= 1 for r in odd_rows)
    assert dict(said)[1004] in ("en", "de", "fr")
    none = langid.train(docs.limit(0))
    assert {r["lang_pred"] for r in langid.predict(docs.limit(5), none).collect()} == {"und"}
    assert langid.predict(docs.limit(0), none).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 9, 20])
def test_codewords_are_apart(n):
    c = langid.codewords(n)
    assert len({tuple(r) for r in c}) == n
    if n > 2:
        assert min((c[i] != c[j]).sum() for i in range(n) for j in range(i)) >= 2


def test_a_flipped_bit_is_corrected():
    code = langid.codewords(4)
    m = langid.Model(list("abcd"), code, np.zeros((1, code.shape[1])), np.zeros(code.shape[1]), np.ones(code.shape[1]))
    for k in range(4):
        for bit in range(code.shape[1]):
            margins = 3.0 * code[k : k + 1].astype(float)
            margins[0, bit] *= -1
            assert m.decode(margins)[0][0] == k


def test_one_language_and_ambiguity():
    m = langid.Model(["a"], langid.codewords(1), np.zeros((1, 1)), np.zeros(1), np.ones(1))
    best, score, vague = m.decode(np.zeros((2, 1)))
    assert list(best) == [0, 0] and list(score) == [1, 1] and not vague.any()
    four = langid.Model(list("abcd"), langid.codewords(4), np.zeros((1, 7)), np.zeros(7), np.ones(7))
    assert four.decode(np.zeros((1, 7)))[2].all()


def test_toxicity_scores_match_brute_force(spark):
    """Each score is the sigmoid of the bias and the weights of the distinct words, by plain dictionaries."""
    import re
    from math import exp

    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(30)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 12))) for _ in range(60)] + ["W1, w1! w2", None, ""]
    hashes = dict(zip(vocabulary, toxicity.lowered([" ".join(vocabulary).encode()]).h.tolist()))
    chosen = {w: rng.uniform(-2, 2) for w in vocabulary[:10]}
    order = sorted(chosen, key=hashes.get)
    model = toxicity.Model(np.array([hashes[w] for w in order], np.uint64), np.array([chosen[w] for w in order]), -0.3)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in toxicity.score(docs, model).collect():
        words = set(re.findall("[a-z0-9]+", (texts[r["doc_id"]] or "").lower()))
        want = 1 / (1 + exp(0.3 - sum(chosen.get(w, 0) for w in words)))
        assert abs(r["score"] - want) < 1e-12 and r["predicted"] == (want >= 0.5)


def test_nnpu_reaches_a_low_of_its_risk():
    """The risk is worked out again, term by term; no step away from the fitted model lowers it by much."""
    rng = np.random.default_rng(6)
    bad, all_ = np.arange(1, 9, dtype=np.uint64), np.arange(1, 200, dtype=np.uint64)
    positive = [np.unique(np.concatenate((rng.choice(bad, 4), rng.choice(all_, 10)))) for _ in range(80)]
    unlabelled = [np.unique(rng.choice(all_, 12)) for _ in range(300)] + [np.unique(np.concatenate((rng.choice(bad, 4), rng.choice(all_, 8)))) for _ in range(60)]
    prior = 60 / 360
    model = toxicity.nnpu(positive, unlabelled, prior)

    def risk(weights, bias):
        known = dict(zip(model.words.tolist(), weights))
        z = lambda docs: np.array([bias + sum(known.get(w, 0) for w in d.tolist()) for d in docs])
        zp, zu = z(positive), z(unlabelled)
        negative = np.mean(np.log1p(np.exp(zu))) - prior * np.mean(np.log1p(np.exp(zp)))
        return prior * np.mean(np.log1p(np.exp(-zp))) + max(0.0, negative)

    low = risk(model.weights, model.bias)
    assert set(model.words.tolist()) >= set(bad.tolist()) and low < risk(model.weights * 0, model.bias)
    for _ in range(40):
        step = rng.normal(size=len(model.words) + 1) * 0.3
        assert risk(model.weights + step[:-1], model.bias + step[-1]) > low - 0.02


def lm_brute(rows, good, vocab):
    """The same models by counters, over the same word ids and cells."""
    from collections import Counter

    coded = {}
    for r in rows:
        ids, cells = vocab.cells(lm_score.lowered([r[1].encode()]))
        coded[r[0]] = (ids.tolist(), cells.tolist())
    known, models = len(vocab.words), []
    for chosen in (good, set(coded)):
        uni, pair = Counter(), Counter()
        for i in chosen:
            uni.update(coded[i][0])
            pair.update(coded[i][1])
        models.append((uni, pair, sum(bool(coded[i][0]) for i in chosen), sum(uni.values())))
    out, size = {}, min(m[3] for m in models)
    for i, (ids, cells) in coded.items():
        losses = []
        for uni, pair, starts, total in models:
            loss, r = 0.0, size / total
            for k, (w, c) in enumerate(zip(ids, cells)):
                seen = uni[ids[k - 1]] if k else starts
                loss -= np.log((r * min(pair[c], seen) + lm_score.BACKOFF * (r * uni[w] + 1) / (size + known + 1)) / (r * seen + lm_score.BACKOFF))
            losses.append(loss / max(1, len(ids)))
        out[i] = losses[0] - losses[1]
    return out


def test_lm_scores_match_brute_force(spark, prose):
    docs, labels, _, rows = prose
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    got = {r["doc_id"]: r["score"] for r in lm_score.score(docs, lm_score.fit(docs, labels)).collect()}
    want = lm_brute(rows, good, lm_score.vocabulary(docs))
    assert max(abs(got[i] - want[i]) for i in want) < 1e-9
    english = {r[0]: r[2] == "en" for r in rows}
    assert np.mean([got[i] for i in english if english[i]]) < np.mean([got[i] for i in english if not english[i]])


def test_lm_of_odd_tables(spark, prose):
    docs, labels, _, _ = prose
    models = lm_score.fit(docs, labels)
    got = {r["doc_id"]: (r["n_words"], r["score"]) for r in lm_score.score(odd(spark, docs), models).collect()}
    assert got[1001] == got[1002] == (0, 0.0) and got[1005][0] == 5000
    assert lm_score.score(docs.limit(0), models).count() == 0
    empty = lm_score.fit(docs.limit(0), labels)
    assert lm_score.score(docs.limit(3), empty).count() == 3


def test_a_small_vocabulary_folds_rare_words(spark, prose):
    docs, _, _, _ = prose
    v = lm_score.vocabulary(docs, size=3)
    assert len(v.words) == 3 and list(v.words) == sorted(v.words)


def test_lm_counts_are_exact_beyond_any_fixed_size(spark):
    """More words and pairs than a fixed vocabulary and table had room for, against counters of the words themselves."""
    from collections import Counter

    rng = random.Random(11)
    texts = {i: " ".join(f"w{rng.randrange(60_000)}" for _ in range(300)) for i in range(300)}
    texts[300] = texts[7] + " once more"
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)], "doc_id long, quality int")
    got = {r["doc_id"]: (r["loss_target"], r["loss_background"]) for r in lm_score.score(docs, lm_score.fit(docs, labels)).collect()}
    known = len({w for t in texts.values() for w in t.split()})
    assert known > 1 << 15 and len(got) == len(texts)
    target = [i for i in range(200) if i % 3 == 0]
    size = sum(len(texts[i].split()) for i in target)
    for k, chosen in enumerate((target, list(texts))):
        words, pairs = Counter(), Counter()
        for i in chosen:
            ws = texts[i].split()
            words.update([None, *ws])
            pairs.update(zip([None, *ws], ws))
        r = size / (sum(words.values()) - words[None])
        for i, t in texts.items():
            ws = t.split()
            want = -sum(np.log((r * pairs[v, w] + lm_score.BACKOFF * (r * words[w] + 1) / (size + known + 1)) / (r * words[v] + lm_score.BACKOFF)) for v, w in zip([None, *ws], ws)) / len(ws)
            assert abs(got[i][k] - want) < 1e-9


def test_numbers_survive_their_coding():
    for x in ([], [0], [0, 0, 0], [255, 256, 1], [1 << 62, 3]):
        assert lm_score.numbers(lm_score.planes(np.array(x, np.int64))).tolist() == x
    keys = np.array([3, 1 << 40, (1 << 64) - 2], np.uint64)
    assert (lm_score.decoded(lm_score.coded(keys)) == keys).all()


def test_a_group_of_texts_takes_bounded_memory():
    """Tables of a group's grams, and of what it sends, in bytes a word: what an executor's memory is made of."""
    import tracemalloc

    rng = np.random.default_rng(13)
    texts = [" ".join(f"w{k}" for k in (rng.zipf(1.3, 400) % 50_000).tolist()).encode() for _ in range(1000)]
    lm_score.Grams(texts[:2])
    tracemalloc.start()
    g = lm_score.Grams(texts)
    built = tracemalloc.get_traced_memory()[1] / len(g.doc)
    n = g.counts(np.ones(len(texts), bool))
    tracemalloc.reset_peak()
    held = tracemalloc.get_traced_memory()[0]
    g.losses(len(texts), (n, n), 1000, (1000, 5000))
    scored = (tracemalloc.get_traced_memory()[1] - held) / len(g.doc)
    tracemalloc.stop()
    assert built < 80 and scored < 40, (built, scored)
    assert len(lm_score.coded(g.keys)) + 2 * len(lm_score.planes(n)) < 16 * len(g.keys)


def test_languages_are_trained_in_as_many_rounds_at_every_size(monkeypatch):
    rounds, make = [], np.random.default_rng

    class Counting:
        def __init__(self, seed):
            self.rng = make(seed)
            self.permutation = self.rng.permutation

        def shuffle(self, x):
            rounds[-1] += 1
            self.rng.shuffle(x)

    monkeypatch.setattr(langid.np.random, "default_rng", Counting)
    for n in (20, 900, 5000):
        rounds.append(0)
        langid.fit(make(n).random((n, 6), np.float32), [("en", "de")[i % 2] for i in range(n)])
    assert rounds == [60, 60, 60]
