"""Sharding by a hierarchical weighted hash tree, in DataFrame functions alone.

A tree has regions, racks and shards. A row descends from the root: at each level every child draws an exponential
variate from a hash of the row's key and the child's path, divided by the child's weight, and the smallest
draw wins. A child's weight is the sum of its shards' weights. A change of one weight changes only draws on the path to it,
so rows move only into (or out of) the subtree whose weight grew (or fell).
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

#: Shards of the first layout, and its fan-out: shards beyond it each open a region, which takes rows only into itself.
BASE_SHARDS, RACK_SHARDS, REGION_RACKS = 16, 4, 2
#: Rows of a shard are numbered in so many buckets side by side: bounds the table of bucket sizes at shards times this.
SLOT_BUCKETS = 4096

Tree = dict[str, dict[str, dict[int, float]]]


def layout(shards: int, base: int = BASE_SHARDS, weights: dict[int, float] | None = None) -> Tree:
    """Region -> rack -> shard -> weight (1 unless given; 0 takes a shard out).

    The first *base* shards fill racks of RACK_SHARDS and regions of REGION_RACKS racks; every later shard opens a region,
    so that layout(n + 1) adds a subtree to layout(n) and changes no other weight.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    tree: Tree = defaultdict(lambda: defaultdict(dict))
    for s in range(shards):
        weight = (weights or {}).get(s, 1.0)
        if weight < 0:
            raise ValueError(f"shard {s}: negative weight")
        region = s // (RACK_SHARDS * REGION_RACKS) if s < base else f"+{s}"
        rack = s % (RACK_SHARDS * REGION_RACKS) // RACK_SHARDS if s < base else 0
        tree[f"r{region}"][f"k{rack}"][s] = weight
    return {r: {k: dict(x) for k, x in racks.items()} for r, racks in tree.items()}


def uniform(key: Column, path: str) -> Column:
    """A draw in (0, 1) from a key and a node's path: the first 52 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{path}:"), key))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def _winner(key: Column, children: list[tuple[str, float, Column]]) -> Column:
    """The result of the child with the smallest draw; ties go to the child named first."""
    live = [(path, w, out) for path, w, out in children if w > 0]
    if not live:
        raise ValueError("a tree needs a positive weight")
    if len(live) == 1:
        return live[0][2]
    draws = [F.struct((-F.log(uniform(key, path)) / F.lit(float(w))).alias("draw"), F.lit(i).alias("i")) for i, (path, w, _) in enumerate(live)]
    best = F.least(*draws)["i"]
    return reduce(lambda rest, x: F.when(best == x[0], x[1][2]).otherwise(rest), list(enumerate(live))[1:], live[0][2])


def place(df: DataFrame, key: Column, tree: Tree, out: str) -> DataFrame:
    """Add column *out*: the shard of each row. A null key counts as the empty string. One narrow projection a level."""
    total = lambda node: node if isinstance(node, float) else sum(map(total, node.values()))
    name = lambda c: f"__{out}_{c}"
    df = df.withColumn(name("key"), F.coalesce(key.cast("string"), F.lit("")))
    k = F.col(name("key"))
    regions = sorted(tree.items())
    df = df.withColumn(name("region"), _winner(k, [(r, total(racks), F.lit(r)) for r, racks in regions]))
    rack = F.lit(None).cast("string")
    for r, racks in regions:
        if total(racks) > 0:
            rack = F.when(F.col(name("region")) == r, _winner(k, [(f"{r}/{q}", total(shards), F.lit(f"{r}/{q}")) for q, shards in sorted(racks.items())])).otherwise(rack)
    df = df.withColumn(name("rack"), rack)
    shard = F.lit(None).cast("int")
    for r, racks in regions:
        for q, shards in sorted(racks.items()):
            if total(shards) > 0:
                shard = F.when(F.col(name("rack")) == f"{r}/{q}", _winner(k, [(f"{r}/{q}/{s}", w, F.lit(s)) for s, w in sorted(shards.items())])).otherwise(shard)
    return df.withColumn(out, shard).drop(name("key"), name("region"), name("rack"))


def number_slots(df: DataFrame, shard: str, key: str, out: str = "slot", buckets: int = SLOT_BUCKETS, ties: tuple[str, ...] = ()) -> DataFrame:
    """Number the rows of each shard from 0 without gaps, in order of (hash bucket of key, key).

    No task holds a shard: rows are numbered inside one of *buckets* buckets a shard, and start after the
    rows of the buckets before. The table of bucket sizes has at most shards x buckets rows, so it is broadcast.
    Rows with equal keys are told apart by the columns *ties*, which also spread them over buckets; rows that are equal in those too get
    different slots in any order, and are alike.
    """
    df = df.withColumn("__bucket", F.pmod(F.xxhash64(F.col(key), *ties), F.lit(buckets)).cast("int"))
    sizes = df.groupBy(F.col(shard).alias("__s"), F.col("__bucket").alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__s").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("__s", "__b", F.coalesce(before, F.lit(0)).alias("__from"))
    rank = F.row_number().over(Window.partitionBy(shard, "__bucket").orderBy(key, *ties))
    placed = df.withColumn("__rank", rank).join(F.broadcast(starts), (F.col(shard) == F.col("__s")) & (F.col("__bucket") == F.col("__b")), "left")
    return placed.withColumn(out, (F.col("__from") + F.col("__rank") - 1).cast("long")).drop("__bucket", "__s", "__b", "__from", "__rank")


def shard_documents(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Place every row of *docs* by its key; law `key`: key and shard count decide, and one more shard takes rows only
    into itself.

    Returns key, size (UTF-8 bytes plus 1), text_crc32, law, shard, slot, grown_shard (the shard among shards + 1).
    A null text counts as empty, a null key as the empty string; repeated rows are all placed; an empty table gives no
    rows; other columns of *docs* are ignored. The text is reduced to its size and checksum before the only shuffle.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key), (F.octet_length(body).cast("long") + 1).alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    rows = place(rows, F.col(key), layout(shards), "shard")
    rows = place(rows, F.col(key), layout(shards + 1), "grown_shard")
    return number_slots(rows, "shard", key, ties=("size", "text_crc32")).select(key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
