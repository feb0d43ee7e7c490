"""Near-duplicates by MinHash and a multi-index Hamming join.

A text's set of word shingles is reduced to a signature of SYMBOLS minima, of which 16 bits each are kept. Sets of a
given similarity differ in few symbols: `most_differing` gives the distance that practically no linked pair exceeds. The
signature is split into so many chunks that, by the pigeonhole principle, two signatures within the distance differ in at most one symbol
of some chunk; each chunk is indexed once for each symbol left out, which enumerates that error. So every pair within the
distance meets in a bucket.

A bucket's members are never paired with each other outright, and no table of candidate pairs exists. First each member is compared with
the highest centre of its buckets, which gathers most of a group of copies in one component. Then members of buckets that still hold
several components are dealt into cells, and each visits the cells of the members it shares a bucket with, if their component
is the larger. Visitors are compared with a cell's members on full sets, inside the task, which tells only links between
components that it hasn't joined yet: fewer than it has members and visitors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb, prod

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dossier.llm.common import OTHER_BASE, Words, blocks, map_arrow, mix, utf8
from dossier.operators.graph import connected_components
from dossier.session import materialise

SYMBOLS = 64
#: The chance with which a pair exactly at the threshold may lie beyond the signature distance.
MISSED = 1e-5
#: Members and visitors of a cell that are compared in one task; a larger cell is dealt out as blocks of members by parts of visitors.
BLOCK, VISITORS = 512, 2048
#: Keys that are broadcast to find texts; more are joined by a shuffle.
MOST_BROADCAST = 1_000_000

_rng = np.random.default_rng(20)
_SEEDS = _rng.integers(1, 1 << 63, (SYMBOLS, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def most_differing(similarity: float, missed: float = MISSED) -> int:
    """The least distance that symbols of two sets of this similarity exceed with a chance of at most *missed*."""
    q = (1 - similarity) * (1 - 2.0**-16)
    tail, d = 1.0, -1
    while tail > missed and d < SYMBOLS:
        d += 1
        tail -= comb(SYMBOLS, d) * q**d * (1 - q) ** (SYMBOLS - d)
    return d


def chunk_bounds(distance: int) -> list[tuple[int, int]]:
    """Chunks of nearly equal size, more than half as many as the distance: one of them has at most one error."""
    n = min(distance // 2 + 1, SYMBOLS // 2)
    if 2 * n <= distance:
        raise ValueError("this distance leaves chunks of a single symbol")
    edges = [SYMBOLS * i // n for i in range(n + 1)]
    return list(zip(edges, edges[1:]))


def chance_missed(similarity: float, bounds: list[tuple[int, int]]) -> float:
    """The chance that a pair of this similarity meets in no bucket: every chunk has two errors or more."""
    q = (1 - similarity) * (1 - 2.0**-16)
    return prod(1 - (1 - q) ** (b - a) - (b - a) * q * (1 - q) ** (b - a - 1) for a, b in bounds)


def shingles(w: Words, words: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, sorted; of a text with fewer words, its whole sequence; none without words."""
    grams = {n: w.grams(n, OTHER_BASE) for n in range(1, words + 1)}
    out = []
    for a, b in zip(w.first.tolist(), w.first[1:].tolist()):
        n = min(words, b - a)
        out.append(np.unique(grams[n][a : b - n + 1]) if n else np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """sets x SYMBOLS minima, 16 bits each; zeros for an empty set."""
    sizes = np.array([len(s) for s in sets])
    out = np.zeros((len(sets), SYMBOLS), np.uint16)
    if not sizes.sum():
        return out
    flat = np.concatenate(sets)
    full = np.flatnonzero(sizes)
    starts = (np.cumsum(sizes) - sizes)[full]
    for k, (a, b) in enumerate(_SEEDS):
        h = (flat * a + b) >> np.uint64(16)
        out[full, k] = (mix(np.minimum.reduceat(h, starts)) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def _signed_rows(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """key, sequence (128-bit hash of the words), n_shingles, signature of every row."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = utf8(b, text)
            for a, z in blocks(texts):
                part = [t.lower() if t else b"" for t in texts[a:z]]
                sets = shingles(Words(part), words)
                sig = signatures(sets)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(a, z - a), pa.array([hashlib.md5(b" ".join(t.split())).digest() for t in part]), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sig], pa.binary())],
                    names=["key", "sequence", "n_shingles", "signature"],
                )

    return map_arrow(docs.select(key, text), run, f"key {kind}, sequence binary, n_shingles long, signature binary")


def bucket_keys(signature: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """rows x SYMBOLS bucket keys: for each symbol, its chunk without it (and where it was)."""
    out = np.empty(signature.shape, np.uint64)
    wide = signature.astype(np.uint64)
    for c, (a, b) in enumerate(bounds):
        for left in range(a, b):
            h = np.full(len(wide), c * SYMBOLS + left, np.uint64)
            for k in range(a, b):
                if k != left:
                    h = mix(h * np.uint64(0x9E3779B97F4A7C15) + wide[:, k] + np.uint64(1))
            out[:, left] = h
    return out


def _sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """node, shingle set of the rows of *docs* whose key is wanted."""
    few = wanted.count() <= MOST_BROADCAST
    rows = docs.select(F.col(key).alias("node"), F.col(text).alias("text")).join(F.broadcast(wanted) if few else wanted, "node", "left_semi")
    kind = rows.schema["node"].dataType.simpleString()

    def run(batches):
        for b in batches:
            texts = utf8(b, "text")
            for a, z in blocks(texts):
                sets = shingles(Words([t.lower() if t else b"" for t in texts[a:z]]), words)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, z - a), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["node", "shingles"])

    return map_arrow(rows, run, f"node {kind}, shingles array<long>").where(F.size("shingles") > 0)


class Forest:
    """Labels of a task's rows, joined as links are found."""

    def __init__(self):
        self.parent: dict = {}

    def root(self, x):
        parent = self.parent
        while (up := parent.get(x, x)) != x:
            parent[x] = up = parent.get(up, up)
            x = up
        return x


class Cell:
    """The members of one block: their sets as places in the sorted table of all their shingles."""

    def __init__(self, labels: list, sets: list[np.ndarray], forest: Forest):
        self.n = np.array([len(s) for s in sets])
        self.starts = np.cumsum(self.n) - self.n
        self.known, self.place = np.unique(np.concatenate(sets), return_inverse=True)
        self.marked = np.zeros(len(self.known), np.int32)
        self.forest, self.names = forest, list(dict.fromkeys(labels))
        code = {x: i for i, x in enumerate(self.names)}
        self.code = np.array([code[x] for x in labels])
        self.tree = np.arange(len(self.names))  # of each name, the name that stands for all it is joined with

    def links(self, label, shingles: np.ndarray, percent: int) -> list[tuple]:
        """Links (label, label of a member) of a visitor, one for each component that it isn't joined with yet."""
        at = np.minimum(np.searchsorted(self.known, shingles), len(self.known) - 1)
        at = at[self.known[at] == shingles]
        if not len(at):
            return []
        if len(self.n) == 1:
            common = np.array([len(at)])
        else:
            self.marked[at] = 1
            common = np.add.reduceat(self.marked[self.place], self.starts)
            self.marked[at] = 0
        near = np.unique(self.tree[self.code[common * 100 >= percent * (self.n + len(shingles) - common)]])
        out, own = [], self.forest.root(label)
        for k in near.tolist():
            other = self.forest.root(self.names[k])
            if other != own:
                out.append((label, self.names[k]))
                self.forest.parent[other] = own
            self.tree[self.tree == k] = near[0]
        return out


def _near_centres(pivots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of nodes and the centres (node, cell) that they are compared with on full sets, the links (a, b), the smaller node last."""
    # No renaming below the joins: both sides are one shuffle of the sets.
    both = pivots.alias("p").join(sets.alias("x"), F.col("p.node") == F.col("x.node")).join(sets.alias("y"), F.col("p.cell") == F.col("y.node"))
    own, other = F.col("x.shingles"), F.col("y.shingles")
    sized = both.select(F.greatest("p.node", "p.cell").alias("a"), F.least("p.node", "p.cell").alias("b"), F.size(F.array_intersect(own, other)).cast("long").alias("c"), (F.size(own) + F.size(other)).alias("n"))
    return sized.where(F.col("c") * 100 >= percent * (F.col("n") - F.col("c"))).select("a", "b")


def _linked(members: DataFrame, visitors: DataFrame, sets: DataFrame, percent: int, name: str) -> DataFrame:
    """Links (a, b) between components: each visitor (cell, node, label) compared on full sets with the members (cell, node, label) of its cell.

    A cell of many members or visitors is dealt out as blocks times parts. Its members come first in a sorted partition; visitors stream
    past them.
    """
    rows = members.withColumn("visits", F.lit(False)).unionByName(visitors.withColumn("visits", F.lit(True)))
    counts = rows.groupBy("cell").agg(F.count(F.when(~F.col("visits"), 1)).alias("m"), F.count(F.when(F.col("visits"), 1)).alias("v")).where("m > 0 and v > 0")
    counts = counts.select("cell", F.ceil(F.col("m") / F.lit(BLOCK)).cast("int").alias("m"), F.ceil(F.col("v") / F.lit(VISITORS)).cast("int").alias("v"))
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    dealt = rows.join(counts, "cell").select("cell", "node", "label", "visits", own("m").alias("block"), own("v").alias("part"), "m", "v")
    dealt = dealt.select("cell", "node", "label", "visits", "block", "part", F.explode(F.sequence(F.lit(0), F.when(F.col("visits"), F.col("m")).otherwise(F.col("v")) - 1)).alias("other"))
    block, part = (F.when(F.col("visits"), F.col(x)).otherwise(F.col(y)) for x, y in (("other", "block"), ("part", "other")))
    placed = dealt.select("cell", "node", "label", "visits", block.alias("block"), part.alias("part")).join(sets, "node")
    placed = placed.select(F.xxhash64("cell", "block", "part").alias("g"), "cell", "block", "part", "visits", "label", "shingles")
    placed = placed.repartition("cell", "block", "part").sortWithinPartitions("cell", "block", "part", "visits", "label")
    kind = members.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, labels, held, cell, forest = None, [], [], None, None
        for b in batches:
            found = []
            shingles = b.column(6)
            for i, (g, visits, label) in enumerate(zip(b.column(0).to_pylist(), b.column(4).to_pylist(), b.column(5).to_pylist())):
                if g != at:
                    at, labels, held, cell, forest = g, [], [], None, Forest()
                own = shingles[i].values.to_numpy().view(np.uint64)
                if not visits:
                    labels.append(label)
                    held.append(own)
                    continue
                if cell is None:
                    cell = Cell(labels, held, forest) if held else None
                if cell is not None:
                    found += cell.links(label, own, percent)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], b.column(5).type) for k in (0, 1)], names=["a", "b"])

    found = map_arrow(placed, run, f"a {kind}, b {kind}")
    return materialise(found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)


def _meetings(members: DataFrame, label: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of members (bucket, node, centre) and the components of nodes: which (cell, node, label) stand in cells, and which visit which cell.

    A node's cell is the highest of its buckets' centres. In a bucket of several components, each node visits the cells of the nodes whose component
    is larger (in nodes, then by label): so of two nodes with different components one visits the cell of the other.
    """
    sized = label.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    known = label.join(sized, "component").select(F.col("vertex").alias("node"), F.struct("size", F.col("component").alias("label")).alias("order"))
    alone = F.struct(F.lit(1).cast("long").alias("size"), F.col("node").alias("label"))
    marked = members.join(known, "node", "left").select("bucket", "node", "centre", F.coalesce("order", alone).alias("order"))
    several = marked.groupBy("bucket").agg(F.min("order").alias("x"), F.max("order").alias("y")).where("x <> y").select("bucket")
    open_ = materialise(marked.join(several, "bucket", "left_semi"), "minhash-open")
    cells = open_.groupBy("node").agg(F.max("centre")["node"].alias("cell"), F.first("order").alias("order"))
    placed = open_.select("bucket", F.max("centre").over(Window.partitionBy("node"))["node"].alias("cell"), "order")
    top = placed.groupBy("bucket", "cell").agg(F.max("order").alias("top"))
    top = top.select(F.col("bucket").alias("met"), "cell", "top")
    visits = open_.join(top, (F.col("bucket") == F.col("met")) & (F.col("order") < F.col("top"))).select("cell", "node", F.col("order.label").alias("label")).distinct()
    return cells.select("cell", "node", F.col("order.label").alias("label")), materialise(visits, "minhash-visits")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """Link texts whose sets of *words*-word shingles have a Jaccard similarity of *percent* or more; returns one row per row of
    *docs*: key, n_shingles, component_id (the smallest key reachable), kept (key = component_id).

    Words are runs of anything but ASCII white space, A-Z lower-cased. A text with fewer words has one shingle, its whole sequence. Null and
    empty texts and texts without words have no shingles and are linked with nothing. Rows with a null key are linked with nothing and
    have a null component. Rows that share a key are one document: it is linked as any of its texts is. An empty table gives no
    rows; other columns are ignored. Copies (equal word sequences) are reduced to their smallest key before anything is compared.
    """
    bounds = chunk_bounds(most_differing(percent / 100))
    rows = materialise(_signed_rows(docs, key, text, words), "minhash-rows")
    kind = rows.schema["key"].dataType.simpleString()
    live = rows.where("n_shingles > 0 and key is not null")
    reps = materialise(live.groupBy("sequence").agg(F.min("key").alias("node"), F.first("signature").alias("signature")), "minhash-reps")

    def indexed(batches):
        for b in batches:
            for a in range(0, b.num_rows, 4096):
                part = b.slice(a, 4096)
                s = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16).reshape(-1, SYMBOLS)
                yield pa.RecordBatch.from_arrays([pa.array(bucket_keys(s, bounds).ravel().view(np.int64)), part.column(0).take(pa.array(np.repeat(np.arange(len(s)), SYMBOLS)))], names=["bucket", "node"])

    keys = map_arrow(reps.select("node", "signature"), indexed, f"bucket long, node {kind}")
    shared = keys.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("size")).where("low <> high").select("bucket", "size")
    members = materialise(keys.join(shared, "bucket"), "minhash-buckets")
    # A bucket's centre meets the most others: in a group of copies it is one of the least changed.
    ranked = members.select("bucket", F.struct(F.sum("size").over(Window.partitionBy("node")).alias("met"), "node").alias("rank"))
    centres = ranked.groupBy("bucket").agg(F.max("rank").alias("centre"))
    members = materialise(members.select("bucket", "node").join(centres, "bucket"), "minhash-members")
    homes = materialise(members.groupBy("node").agg(F.max("centre")["node"].alias("cell")), "minhash-pivots")
    sets = materialise(_sets(docs, homes.select("node"), key, text, words), "minhash-sets")

    links = materialise(_near_centres(homes.where("node <> cell"), sets, percent), "minhash-links")
    components = materialise(connected_components(links, "a", "b", written=True), "minhash-components")
    standing, visits = _meetings(members, components)
    more = _linked(standing, visits, sets, percent, "minhash-more")
    # Links between components join whole components.
    joined = connected_components(more, "a", "b", written=True).select(F.col("vertex").alias("component"), F.col("component").alias("joined"))
    home = reps.join(components, F.col("node") == F.col("vertex"), "left").select("sequence", F.coalesce("component", "node").alias("component"))
    home = home.join(joined, "component", "left").select("sequence", F.coalesce("joined", "component").alias("home"))
    placed = rows.select("key", "sequence", "n_shingles").join(home, "sequence", "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("key").isNotNull(), F.col("home")).otherwise(F.col("key"))
    return placed.select(F.col("key").alias(key), "n_shingles", component.alias("component_id"), F.col("key").eqNullSafe(component).alias("kept"))


def keep_representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of *docs* of which no other in their component has a smaller key, with all their columns, whatever their names; rows
    without a key stay."""
    gone = near_duplicates(docs.select(key, text), key, text, words, percent).where(~F.col("kept")).select(F.col(key).alias("gone")).distinct()
    return docs.join(gone, docs[key] == gone["gone"], "left_anti")
