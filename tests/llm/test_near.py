from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from dossier.llm import minhash, substring

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_sets(rows, words):
    out = []
    for i, t in rows:
        ws = SPACE.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        n = min(words, len(ws))
        out.append((i, {tuple(ws[k : k + n]) for k in range(len(ws) - n + 1)} if n else set()))
    return out


def components(rows, words, percent):
    sets = shingle_sets(rows, words)
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and None not in (i, j) and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return Counter((i, len(s), i if i is None or not s else find(i)) for i, s in sets)


def got(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_components_match_brute_force(docs_of, corpus, words, percent):
    rows = [*corpus, (None, "lost and found and lost"), (60, corpus[60][1])]
    out = minhash.near_duplicates(docs_of(rows), words=words, percent=percent)
    assert got(out) == components(rows, words, percent)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out.collect())


def test_chains_and_bridges_are_found(docs_of):
    """Texts that slide along: neighbours are linked, the ends are not; the pivots of a bucket can't see all links."""
    words = [f"w{k}" for k in range(400)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 120])) for i in range(40)]
    rows += [(100 + i, " ".join(["x"] * i + words[:100])) for i in range(12)]
    assert got(minhash.near_duplicates(docs_of(rows), words=3, percent=85)) == components(rows, 3, 85)


def test_blocks_and_parts_change_nothing(docs_of, corpus, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 3)
    monkeypatch.setattr(minhash, "VISITORS", 2)
    words = [f"w{k}" for k in range(300)]
    rows = corpus + [(200 + i, " ".join(words[3 * i : 3 * i + 90])) for i in range(40)]
    assert got(minhash.near_duplicates(docs_of(rows), words=3, percent=85)) == components(rows, 3, 85)


def test_odd_tables(docs_of):
    assert minhash.near_duplicates(docs_of([])).count() == 0
    rows = [(1, None), (2, ""), (3, " "), (4, "a"), (5, "A"), (6, "a b"), (None, "a"), (None, None)]
    assert got(minhash.near_duplicates(docs_of(rows), words=3, percent=85)) == Counter({(1, 0, 1): 1, (2, 0, 2): 1, (3, 0, 3): 1, (4, 1, 4): 1, (5, 1, 4): 1, (6, 1, 6): 1, (None, 1, None): 1, (None, 0, None): 1})
    kept = minhash.keep_representatives(docs_of(rows))
    assert kept.columns == docs_of([]).columns and kept.count() == 7


def test_every_pair_within_the_distance_meets():
    """The pigeonhole guarantee, tried with errors placed at random and as evenly as can be."""
    rng = np.random.default_rng(1)
    for percent in (80, 85):
        distance = minhash.most_differing(percent / 100)
        bounds = minhash.chunk_bounds(distance)
        assert sum(b - a for a, b in bounds) == minhash.SYMBOLS and 2 * len(bounds) > distance
        for trial in range(200):
            s = rng.integers(0, 1 << 16, (1, minhash.SYMBOLS)).astype(np.uint16)
            t = s.copy()
            at = np.array([bounds[k % len(bounds)][0] + k // len(bounds) for k in range(distance)]) if trial == 0 else rng.choice(minhash.SYMBOLS, distance, replace=False)
            t[0, at] ^= 1
            assert np.intersect1d(minhash.bucket_keys(s, bounds), minhash.bucket_keys(t, bounds)).size


def test_chance_of_meeting_in_no_bucket():
    rng = np.random.default_rng(3)
    for percent in (80, 85):
        bounds = minhash.chunk_bounds(minhash.most_differing(percent / 100))
        assert minhash.chance_missed(percent / 100, bounds) < 2e-9
    wrong = rng.random((100_000, minhash.SYMBOLS)) < 0.4
    lost = np.add.reduceat(wrong, [a for a, _ in bounds], axis=1, dtype=np.int64).min(1) > 1
    assert abs(lost.mean() - minhash.chance_missed(0.6, bounds)) < 0.003


def hot_group(n):
    """Copies of one text with one to four words replaced: about a quarter is linked with nothing."""
    rng = np.random.default_rng(4)
    words = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(n):
        own = list(words)
        for at in rng.choice(120, int(rng.integers(1, 5)), replace=False).tolist():
            own[at] = f"x{rng.integers(1 << 40)}"
        rows.append((i, " ".join(own)))
    return rows


def test_steps_grow_with_a_hot_group_in_proportion(docs_of, monkeypatch):
    sizes = {}
    for n in (300, 1200):
        rows, counted = hot_group(n), {}
        kept = minhash.materialise

        def count(df, name, kept=kept, counted=counted):
            out = kept(df, name)
            counted[name] = counted.get(name, 0) + out.count()
            return out

        monkeypatch.setattr(minhash, "materialise", count)
        out = got(minhash.near_duplicates(docs_of(rows), words=3, percent=85))
        monkeypatch.setattr(minhash, "materialise", kept)
        sizes[n] = counted
        if n == 300:
            assert out == components(rows, 3, 85)
    told = {n: s.pop("minhash-more") for n, s in sizes.items()}  # links told in a block: fewer than its members and visitors
    assert told[300] < 300 and told[1200] < 2400, told
    assert all(sizes[1200][k] <= 6.5 * max(x, 20) for k, x in sizes[300].items()), sizes


def test_tasks_of_a_hot_group_are_few(spark, docs_of):
    """Where little data is dealt out to many partitions, time goes with the number of stages: what each runs is next to nothing."""
    docs = docs_of(hot_group(60))
    coalesced = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.sparkContext.setJobGroup("hot", "near copies")
    try:
        minhash.near_duplicates(docs, words=3, percent=85).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesced)
    tracker, stages = spark.sparkContext.statusTracker(), set()
    for job in tracker.getJobIdsForGroup("hot"):
        stages |= set(tracker.getJobInfo(job).stageIds)
    infos = [tracker.getStageInfo(k) for k in stages]
    ran = [i.numTasks for i in infos if i and i.numCompletedTasks]
    assert len(ran) < 98, (len(ran), sum(ran))


def test_words_that_fold_alike_are_told_apart(docs_of):
    """Thue-Morse words, which polynomial hashes modulo a power of two confuse."""
    def morse(n, a, b):
        return a if n == 0 else morse(n - 1, a, b) + morse(n - 1, b, a)

    rows = [(1, morse(10, "a", "b")), (2, morse(10, "b", "a")), (3, morse(5, "a", "b")), (4, morse(5, "b", "a"))]
    assert got(minhash.near_duplicates(docs_of(rows), words=3, percent=85)) == components(rows, 3, 85)
    long = [(i, " ".join([t] * 36)) for i, t in rows]
    assert told(substring.remove_repeats(docs_of(long))) == removed(long, 35)


def test_distances_hold_practically_all_pairs():
    rng = np.random.default_rng(2)
    for percent in (80, 85):
        d = minhash.most_differing(percent / 100)
        assert (rng.binomial(minhash.SYMBOLS, 1 - percent / 100, 200_000) > d).mean() < 1e-4


def removed(rows, window):
    texts = [(i, SPACE.findall(t or "")) for i, t in rows]
    seen = Counter(tuple(ws[k : k + window]) for _, ws in texts for k in range(len(ws) - window + 1))
    out = Counter()
    for i, ws in texts:
        gone = set()
        for k in range(len(ws) - window + 1):
            if seen[tuple(ws[k : k + window])] > 1:
                gone |= set(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(ws) if k not in gone)
        out[i, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def told(df):
    return Counter((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest()) for r in df.collect())


@pytest.mark.parametrize("window,gram,batches", [(35, 8, 2), (12, 4, 3), (35, 8, 6)])
def test_repeats_match_brute_force(docs_of, corpus, window, gram, batches):
    rows = [*corpus, (None, corpus[70][1]), (60, corpus[60][1]), (95, "tick tock " * 40), (96, "tick " * 34), (97, "tick " * 35)]
    assert told(substring.remove_repeats(docs_of(rows), window=window, gram=gram, batches=batches)) == removed(rows, window)


def test_shifted_and_nested_passages(docs_of):
    words = [f"w{k}" for k in range(200)]
    rows = [(1, " ".join(words)), (2, " ".join(words[50:90])), (3, "a " + " ".join(words[40:76]) + " b"), (4, " ".join(words[60:94])), (5, " ".join(words[55:120] + ["z"] + words[120:160]))]
    assert told(substring.remove_repeats(docs_of(rows))) == removed(rows, 35)


def test_repeats_of_odd_tables(docs_of):
    assert substring.remove_repeats(docs_of([])).count() == 0
    rows = [(1, None), (2, ""), (3, "x"), (None, None)]
    assert told(substring.remove_repeats(docs_of(rows))) == removed(rows, 35)


def test_segments_change_nothing(corpus, monkeypatch):
    texts = [(t or "").encode() for _, t in corpus]
    w = substring.Words(substring.spaced(texts))
    whole = substring.entries(w)
    monkeypatch.setattr(substring, "SEGMENT", 500)
    cut = substring.entries(w)

    def windows(found):
        return {(d, f + k, a) for d, f, n, a in zip(*(x.tolist() for x in found[:4])) for k in range(n)}

    assert windows(whole) == windows(cut)


def test_index_grows_by_batches_and_compacts(spark, docs_of, corpus, monkeypatch):
    """After each batch the index tells what brute force tells of all batches so far."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(substring, "HOT", 3)  # so that frequent anchors are dealt out
    common = corpus[70][1][-300:]
    rows = [*corpus, *((200 + i, f"{i} {common} {i * i} tail") for i in range(12))]
    df = docs_of(rows).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("row", substring.row_hash("doc_id", "text")).cache()
    names = {bytes(r["row"]): r["doc_id"] for r in df.collect()}
    index = substring.FingerprintIndex(spark, most_runs=2)
    for b in range(4):
        index.append(df.where(f"doc_id % 4 = {b}").select("row", "text"))
        want = {i: n for (i, _, n, _), _ in removed([r for r in rows if r[0] % 4 <= b], 35).items() if n}
        got = {}
        for r in index.repeats().collect():
            got.setdefault(names[bytes(r["row"])], set()).update(k for o in range(64) if r["mask"] >> o & 1 for k in range(r["first"] + o, r["first"] + o + 35))
        assert {i: len(x) for i, x in got.items()} == want, b
    assert len(index.runs) <= 2 and index.compactions == 1
    index.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("fingerprints_")]
