"""Byte-level BPE by overlapping chunks.

A text is cut into chunks that overlap. Each chunk is split into pre-tokens on its own; two neighbours are stitched at the first
place of their overlap where both begin a pre-token after a non-space character: from there on both splits agree, since a split
depends only on what follows. The pieces between such places are encoded apart and their ids are joined. Decoding
concatenates the bytes of the ids. Texts of a single chunk need no stitching and never leave their task.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.llm.common import map_arrow, numbered

CHUNK_CHARS, OVERLAP_CHARS = 1 << 15, 1 << 9
#: A pre-token that ends so many characters before its chunk does can't change with what follows.
MARGIN = 8
#: A text with a longer run of white space is split here and encoded pre-token by pre-token: the encoder's own splitter gives up on such runs.
LONG_RUN = 1 << 15
_RUN = regex.compile(r"\p{White_Space}{%d}" % LONG_RUN)


@lru_cache(maxsize=4)
def _tokenizer(ranks_path: str, pattern: str) -> tuple[tiktoken.Encoding, list[bytes], regex.Pattern]:
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    table = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        table[i] = token
    # Spelled as properties, white space is the same set here as in the encoder.
    spelled = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
    return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), table, regex.compile(spelled)


def encode_piece(text: str, encoding: tiktoken.Encoding, split: regex.Pattern) -> list[int]:
    """The ids of a text that is cut no further."""
    if len(text) < LONG_RUN or not _RUN.search(text):
        return encoding.encode_ordinary(text)
    out: list[int] = []
    for m in split.finditer(text):
        out += encoding._encode_single_piece(m[0])
    return out


def chunks(text: str, size: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> list[tuple[int, str]]:
    """(start, chunk): each chunk holds *size* characters of its own and *overlap* of the next."""
    if overlap < 2 * MARGIN or size <= overlap:
        raise ValueError("the overlap must exceed the margin, and the chunk the overlap")
    return [(s, text[s : s + size + overlap]) for s in range(0, max(1, len(text)), size)]


def pre_tokens(chunk: str, pattern: regex.Pattern) -> np.ndarray:
    """Where the pre-tokens of a chunk begin."""
    return np.fromiter((m.start() for m in pattern.finditer(chunk)), np.int64)


def safe_starts(chunk: str, starts: np.ndarray) -> np.ndarray:
    """The starts after a non-space character: text cut there splits as the whole does."""
    return np.array([s for s in starts.tolist() if s and not chunk[s - 1].isspace()], np.int64)


def resynchronise(left: np.ndarray, right: np.ndarray, low: int, high: int) -> int | None:
    """The first place in [low, high - MARGIN) where both neighbours begin a pre-token; None if there is none."""
    left, right = left[(left >= low) & (left < high - MARGIN)], right[(right >= low) & (right < high - MARGIN)]
    both = np.intersect1d(left, right)
    return int(both[0]) if len(both) else None


def stitch(marks: list[tuple[int, int, np.ndarray]]) -> list[int | None]:
    """marks: start, end and safe starts (all in characters of the text) of each chunk in order. Where each chunk's piece begins.
    None if it has no place in common with its predecessor: from there on no split is known to be the whole text's, so this
    chunk and all later ones belong to the piece before."""
    cuts: list[int | None] = [0]
    for (_, end, left), (start, _, right) in zip(marks, marks[1:]):
        cuts.append(None if cuts[-1] is None else resynchronise(left, right, start, end))
    return cuts


def encode_text(text: str, ranks_path: str, pattern: str, size: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> list[int]:
    """Encode one text by chunks, all in this process."""
    encoding, _, split = _tokenizer(ranks_path, pattern)
    if len(text) <= size:
        return encode_piece(text, encoding, split)
    marks = [(s, s + len(c), safe_starts(c, pre_tokens(c, split)) + s) for s, c in chunks(text, size, overlap)]
    cuts = [c for c in stitch(marks) if c is not None] + [len(text)]
    return [i for a, b in zip(cuts, cuts[1:]) for i in encode_piece(text[a:b], encoding, split)]


def _with_file(path: str, name: str) -> str:
    """The vocabulary file: its own path where this machine has it, else the copy that Spark sent."""
    try:
        open(path, "rb").close()
        return path
    except OSError:
        return SparkFiles.get(name)


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", out: str = "ids", size: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """*docs* with column *out*: the token ids (array<int>) of each text. A null text counts as empty and has no ids; repeated
    rows each get theirs; an empty table gives no rows; other columns may bear any names, and one named *out* is replaced.

    Texts up to *size* characters are encoded where they are read. Longer ones are reduced to distinct texts, then their
    chunks spread over all tasks; only the safe starts inside overlaps are gathered by text for stitching.
    """
    ship_ranks(docs, ranks_path)
    name = ranks_path.rsplit("/", 1)[-1]
    names, docs = [c for c in docs.columns if c != out], docs.drop(out)
    docs, text = numbered(docs), f"c{names.index(text)}"
    fields = docs.columns
    body = F.coalesce(F.col(text), F.lit(""))
    # Bytes bound characters from above, so a text that isn't long in bytes is short.
    long_text = (F.octet_length(body) > size) & (F.char_length(body) > size)

    def short_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, _, split = _tokenizer(_with_file(ranks_path, name), pattern)
        for b in batches:
            texts = b.column(b.schema.get_field_index("__bpe_text")).to_pylist()
            for a in range(0, len(texts), 256):
                ids = [encode_piece(t, encoding, split) for t in texts[a : a + 256]]
                offsets = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) for x in ids], out=offsets[1:])
                flat = np.fromiter((i for x in ids for i in x), np.int32, int(offsets[-1]))
                part = b.slice(a, len(ids))
                kept = [part.column(i) for i, c in enumerate(b.schema.names) if c != "__bpe_text"]
                yield pa.RecordBatch.from_arrays([*kept, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=[*fields, "__bpe_ids"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    short = map_arrow(docs.where(~long_text).withColumn("__bpe_text", body), short_ids, f"{kinds}, __bpe_ids array<int>")
    return short.unionByName(_encode_long(docs.where(long_text), ranks_path, name, pattern, text, "__bpe_ids", size, overlap)).toDF(*names, out)


def ship_ranks(df: DataFrame, ranks_path: str) -> None:
    """Send the vocabulary file to the executors once a session."""
    sc = df.sparkSession.sparkContext
    sent = getattr(sc, "_dossier_files", set())
    if ranks_path not in sent:
        sc.addFile(ranks_path)
        sc._dossier_files = sent | {ranks_path}


def _encode_long(docs: DataFrame, ranks_path: str, name: str, pattern: str, text: str, out: str, size: int, overlap: int) -> DataFrame:
    chunk_schema = "__bpe_key string, __bpe_i int, __bpe_from long, __bpe_chunk string"

    def cut(batches):
        for b in batches:
            for key, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = chunks(body, size, overlap)
                for a in range(0, len(found), 64):
                    part = found[a : a + 64]
                    yield pa.RecordBatch.from_arrays([pa.array([key] * len(part)), pa.array(range(a, a + len(part)), pa.int32()), pa.array([s for s, _ in part], pa.int64()), pa.array([c for _, c in part], pa.string())], names=["__bpe_key", "__bpe_i", "__bpe_from", "__bpe_chunk"])

    def mark(batches):
        _, _, split = _tokenizer(_with_file(ranks_path, name), pattern)
        for b in batches:
            keys, numbers, starts, bodies = (b.column(i).to_pylist() for i in range(4))
            marks = []
            for s, c in zip(starts, bodies):
                safe = safe_starts(c, pre_tokens(c, split))
                safe = safe[(safe < overlap) | (safe >= size)] + s  # only what lies in an overlap
                marks.append(np.ascontiguousarray(safe, np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()), pa.array([s + len(c) for s, c in zip(starts, bodies)], pa.int64()), pa.array(marks, pa.binary())], names=["__bpe_key", "__bpe_i", "__bpe_from", "__bpe_to", "__bpe_marks"])

    def joined(pdf):
        pdf = pdf.sort_values("__bpe_i")
        cuts = stitch([(a, b, np.frombuffer(m, np.int64)) for a, b, m in zip(pdf["__bpe_from"], pdf["__bpe_to"], pdf["__bpe_marks"])])
        piece, pieces = 0, []
        for i, c in enumerate(cuts):
            piece = i if c is not None else piece
            pieces.append(piece)
        ends = [next((c for c in cuts[i + 1 :] if c is not None), int(pdf["__bpe_to"].iloc[-1])) for i in range(len(cuts))]
        return pdf[["__bpe_key", "__bpe_i"]].assign(__bpe_piece=np.array(pieces, np.int32), __bpe_cut=[-1 if c is None else c for c in cuts], __bpe_end=ends)

    def piece_ids(batches):
        encoding, _, split = _tokenizer(_with_file(ranks_path, name), pattern)
        for b in batches:
            keys, numbers, parts = (b.column(i).to_pylist() for i in range(3))
            ids = []
            for group in parts:
                group = sorted(group, key=lambda x: x["i"])
                cut_at, end = group[0]["cut"], group[0]["end"]
                body = "".join(x["chunk"][: (group[k + 1]["at"] if k + 1 < len(group) else end) - x["at"]] for k, x in enumerate(group))
                ids.append(encode_piece(body[cut_at - group[0]["at"] : end - group[0]["at"]], encoding, split))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(numbers, pa.int32()), pa.array(ids, pa.list_(pa.int32()))], names=["__bpe_key", "__bpe_piece", "__bpe_ids"])

    keyed = docs.withColumn("__bpe_key", F.sha2(F.col(text), 256))
    texts = keyed.groupBy("__bpe_key").agg(F.first(text).alias("__bpe_text"))
    parts = map_arrow(texts, cut, chunk_schema)
    parts = parts.repartition("__bpe_key", "__bpe_i")
    marks = map_arrow(parts, mark, "__bpe_key string, __bpe_i int, __bpe_from long, __bpe_to long, __bpe_marks binary")
    plan = marks.groupBy("__bpe_key").applyInPandas(joined, "__bpe_key string, __bpe_i int, __bpe_piece int, __bpe_cut long, __bpe_end long")
    # A piece is one chunk, or, where no place was found, a run of chunks that is encoded together.
    member = F.struct(F.col("__bpe_i").alias("i"), F.col("__bpe_from").alias("at"), F.col("__bpe_cut").alias("cut"), F.col("__bpe_end").alias("end"), F.col("__bpe_chunk").alias("chunk"))
    pieces = parts.join(plan, ["__bpe_key", "__bpe_i"]).groupBy("__bpe_key", "__bpe_piece").agg(F.collect_list(member).alias("__bpe_parts"))
    coded = map_arrow(pieces.select("__bpe_key", "__bpe_piece", "__bpe_parts"), piece_ids, "__bpe_key string, __bpe_piece int, __bpe_ids array<int>")
    whole = coded.groupBy("__bpe_key").agg(F.sort_array(F.collect_list(F.struct("__bpe_piece", "__bpe_ids"))).alias("__bpe_all"))
    whole = whole.select("__bpe_key", F.flatten(F.transform("__bpe_all", lambda x: x["__bpe_ids"])).alias(out))
    return keyed.join(whole, "__bpe_key").select(*docs.columns, out)


def decode(coded: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """*coded* with column *out*: the bytes of the ids (binary), concatenated as they come; they need not be valid UTF-8. Null ids
    count as none; an id outside the vocabulary raises an error; a column named *out* is replaced."""
    ship_ranks(coded, ranks_path)
    names, coded = [c for c in coded.columns if c != out], coded.drop(out)
    coded, at = numbered(coded), names.index(ids)
    name, fields = ranks_path.rsplit("/", 1)[-1], coded.columns

    def to_bytes(batches):
        _, table, _ = _tokenizer(_with_file(ranks_path, name), pattern)
        for b in batches:
            for a in range(0, b.num_rows, 256):
                part = b.slice(a, 256)
                texts = [b"".join(map(table.__getitem__, x)) if x else b"" for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], names=[*fields, "__bpe_bytes"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema.fields)
    return map_arrow(coded, to_bytes, f"{kinds}, __bpe_bytes binary").toDF(*names, out)


def digests(coded: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key, n_tokens, ids_sha256 (decimal ids joined by commas) and decoded_sha256 of encoded rows: the ids are decoded batch by
    batch, so that decoded texts are digested where they arise."""
    import hashlib

    ship_ranks(coded, ranks_path)
    name = ranks_path.rsplit("/", 1)[-1]

    def digest(batches):
        _, table, _ = _tokenizer(_with_file(ranks_path, name), pattern)
        decimal = [str(i) for i in range(len(table))]
        for b in batches:
            for a in range(0, b.num_rows, 256):
                part = b.slice(a, 256)
                rows = part.column(1).to_pylist()
                n = [len(x or ()) for x in rows]
                said = [hashlib.sha256(",".join(map(decimal.__getitem__, x or ())).encode()).hexdigest() for x in rows]
                back = [hashlib.sha256(b"".join(map(table.__getitem__, x or ()))).hexdigest() for x in rows]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(said), pa.array(back)], names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = coded.schema[key].dataType.simpleString()
    return map_arrow(coded.select(key, ids), digest, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
