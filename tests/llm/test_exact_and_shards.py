from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from dossier.llm import exact_dedup, sharding


def brute(rows):
    norm = {n: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for n, (_, t) in enumerate(rows)}
    groups = defaultdict(list)
    for n, (i, _) in enumerate(rows):
        groups[norm[n]].append(i)
    return Counter((i, min(groups[norm[n]]), len(groups[norm[n]]), i == min(groups[norm[n]]), hashlib.sha256(norm[n].encode()).hexdigest()) for n, (i, _) in enumerate(rows))


def result(df):
    return Counter(tuple(r) for r in df.collect())


def test_exact_groups_match_brute_force(docs_of, corpus):
    assert result(exact_dedup.exact_groups(docs_of(corpus))) == brute(corpus)


def test_collisions_of_the_content_hash_change_nothing(docs_of, corpus):
    weak = lambda c: F.substring(F.md5(c), 1, 1)
    assert result(exact_dedup.exact_groups(docs_of(corpus), content_hash=weak)) == brute(corpus)


def test_exact_groups_of_odd_tables(docs_of):
    assert exact_dedup.exact_groups(docs_of([])).count() == 0
    rows = [(3, "a"), (3, "a"), (None, "a"), (None, "b"), (1, None), (2, "")]
    got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_groups(docs_of(rows)).collect()}
    assert got == {(3, 3, 3, True), (None, 3, 3, False), (None, None, 1, True), (1, 1, 2, True), (2, 1, 2, False)}


def test_keep_first_keeps_columns_and_one_row(docs_of):
    df = docs_of([(3, "a"), (3, "a"), (2, "a"), (None, "a"), (5, "b  c"), (4, "b c"), (None, "z")])
    out = exact_dedup.keep_first(df)
    assert out.columns == df.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in out.collect()) == [("2", "a"), ("4", "b c"), ("None", "z")]


def test_sharding_law_key(docs_of, corpus):
    rows = corpus + [(i, None) for i in range(1000, 3000)]
    got = sharding.shard_documents(docs_of(rows)).collect()
    assert len(got) == len(rows) and {r["law"] for r in got} == {"key"}
    text = defaultdict(list)
    for i, t in rows:
        text[i].append((t or "").encode())
    by_shard = defaultdict(list)
    for r in got:
        body = text[r["doc_id"]][0]
        assert (r["size"], r["text_crc32"]) == (len(body) + 1, zlib.crc32(body))
        assert r["grown_shard"] in (r["shard"], 16)
        by_shard[r["shard"]].append(r["slot"])
    assert set(by_shard) == set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    mean = len(rows) / 16
    assert all(0.6 * mean < len(s) < 1.4 * mean for s in by_shard.values())
    moved = sum(r["grown_shard"] == 16 for r in got)
    assert 0.6 * len(rows) / 17 < moved < 1.4 * len(rows) / 17


def test_sharding_is_the_tree_that_the_definition_says(docs_of):
    """The descent in plain Python, for uneven weights."""
    import math

    tree = sharding.layout(19, weights={2: 0.0, 5: 3.0})

    def draw(key, path):
        return (int(hashlib.md5(f"{path}:{key}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)

    def weight(node):
        return node if isinstance(node, float) else sum(map(weight, node.values()))

    def pick(key, prefix, children):
        return min(((-math.log(draw(key, f"{prefix}{c}")) / weight(n), c) for c, n in sorted(children.items()) if weight(n) > 0))[1]

    def place(key):
        r = pick(key, "", tree)
        k = pick(key, f"{r}/", tree[r])
        return pick(key, f"{r}/{k}/", tree[r][k])

    rows = [(i, "t") for i in range(400)]
    got = {r["doc_id"]: r["shard"] for r in sharding.place(docs_of(rows), F.col("doc_id"), tree, "shard").collect()}
    assert got == {i: place(i) for i, _ in rows}
    assert 2 not in got.values()


def test_a_grown_weight_moves_rows_only_into_its_subtree(docs_of):
    a, b = sharding.layout(16), sharding.layout(16, weights={13: 2.0})
    df = sharding.place(sharding.place(docs_of([(i, "") for i in range(2000)]), F.col("doc_id"), a, "old"), F.col("doc_id"), b, "new")
    moved = [(r["old"], r["new"]) for r in df.where("old <> new").collect()]
    assert moved and all(n >= 8 for _, n in moved)  # into the region of shard 13
    assert all(n >= 12 for o, n in moved if o >= 8)  # inside it, into its rack
    assert all(n == 13 for o, n in moved if o >= 12)  # inside that, into the shard


def test_sharding_of_odd_tables(docs_of):
    assert sharding.shard_documents(docs_of([])).count() == 0
    got = sharding.shard_documents(docs_of([(None, None), (None, "a"), (7, "a"), (7, "a")])).collect()
    assert len(got) == 4 and len({(r["shard"], r["slot"]) for r in got}) == 4
