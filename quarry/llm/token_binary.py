"""Operator 10: token ids packed best-fit-decreasing into binary matrices.

Tasks tokenise whole texts with a public byte-pair vocabulary (its path is a
parameter) and pack where they read: a task buffers documents up to
``buffer_tokens`` ids, cuts documents longer than a row into pieces without
loss, sorts pieces by falling length and puts each into the open row with the
least room that still fits it. A segment tree over capacities finds that row
in logarithmic time. No ids are shuffled, and memory is bounded by the buffer.

A packed row is written as little-endian ids (16 bits if the vocabulary
allows) filled up to ``row_tokens`` with the padding id, the cumulative segment
lengths from 0, and for each segment the document, the piece and the position
at which its numbering resumes: 0 resets it, a later piece of a cut document
goes on where the one before ended. Files are written by Spark's Parquet
writer, so a lost task is run again as a whole.

Defined results: null and empty texts have no ids and one row in the query's
result with 0 tokens; repeated rows are packed each on their own; an empty
table writes an empty matrix; only id and text are read.
"""

from __future__ import annotations

import base64
import hashlib
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.arrow import tidy
from quarry.llm.common import Scratch, table

ROW_TOKENS = 2048
BUFFER_TOKENS = 4_000_000
_SLICE = 200_000  # characters handed to the tokenizer at a time


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load_tokenizer(vocabulary: bytes):
    """Byte-level BPE from a ranks file (base64 token, rank per line)."""
    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, io.BytesIO(vocabulary))}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(tokenizer, text: str) -> np.ndarray:
    """Ids of a whole text; a very long one is cut before a space between
    letters, where the pre-tokenizer cuts anyway."""
    if len(text) <= _SLICE:
        return np.asarray(tokenizer.encode_ordinary(text), dtype=np.uint32)
    parts, at = [], 0
    while at < len(text):
        end = min(at + _SLICE, len(text))
        while end < len(text) and not (text[end] == " " and text[end - 1].isalpha() and text[end + 1:end + 2].isalpha()):
            end += 1
        parts.append(np.asarray(tokenizer.encode_ordinary(text[at:end]), dtype=np.uint32))
        at = end
    return np.concatenate(parts)


class CapacityTree:
    """Open rows by remaining room; finds the least room of at least ``n``.

    Leaf c counts the rows with c ids of room left; an inner node holds
    whether a leaf below it is filled."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.filled = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(self.size)]

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        i = room + self.size
        while i and not self.filled[i]:
            self.filled[i] = 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        i = need + self.size
        if not self.filled[i]:  # climb to the first filled subtree on the right, then down its left edge
            while i > 1 and (i & 1 or not self.filled[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.filled[2 * i] else 2 * i + 1
        room = i - self.size
        row = self.rows[room].pop()
        if not self.rows[room]:
            self.filled[i] = 0
            i >>= 1
            while i and not (self.filled[2 * i] or self.filled[2 * i + 1]):
                self.filled[i] = 0
                i >>= 1
        return room, row


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Rows of item numbers; every item is in exactly one row."""
    tree, rows = CapacityTree(capacity), []
    for item in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[item])
        found = tree.take(n)
        if found is None:
            room, row = capacity, len(rows)
            rows.append([])
        else:
            room, row = found
        rows[row].append(item)
        if room > n:
            tree.put(room - n, row)
    return rows


_SEGMENT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("doc", T.LongType()),
                         T.StructField("piece", T.IntegerType()), T.StructField("resumes_at", T.LongType())])
MATRIX = T.StructType([
    T.StructField("task", T.IntegerType()), T.StructField("matrix_row", T.LongType()), T.StructField("ids", T.BinaryType()),
    T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())), T.StructField("segments", T.ArrayType(_SEGMENT))])
_ARROW = pa.schema([
    ("task", pa.int32()), ("matrix_row", pa.int64()), ("ids", pa.binary()), ("cu_seqlens", pa.list_(pa.int32())),
    ("segments", pa.list_(pa.struct([("doc_id", pa.int64()), ("doc", pa.int64()), ("piece", pa.int32()),
                                     ("resumes_at", pa.int64())])))])


def pack_ids(docs: list[tuple], row_tokens: int, pad: int, dtype: str) -> list[dict]:
    """Packed rows of (doc_id, doc, ids) triples."""
    cut = [(doc_id, doc, k, at, ids[at:at + row_tokens]) for doc_id, doc, ids in docs
           for k, at in enumerate(range(0, len(ids), row_tokens))]
    lengths = np.array([len(p[4]) for p in cut], dtype=np.int64)
    out = []
    for items in best_fit_decreasing(lengths, row_tokens):
        ids = np.full(row_tokens, pad, dtype=dtype)
        ends = np.cumsum([0, *lengths[items]])
        for i, a, b in zip(items, ends, ends[1:]):
            ids[a:b] = cut[i][4]
        out.append({"ids": ids.tobytes(), "cu_seqlens": ends.tolist(),
                    "segments": [dict(zip(("doc_id", "doc", "piece", "resumes_at"), cut[i][:4])) for i in items]})
    return out


def packed_matrix(docs: DataFrame, vocabulary: bytes, id_col: str = "doc_id", text_col: str = "text",
                  row_tokens: int = ROW_TOKENS, buffer_tokens: int = BUFFER_TOKENS) -> DataFrame:
    """The packed rows of all documents, by ``MATRIX``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # one vocabulary file

    def pack(batches):
        from pyspark import TaskContext

        tokenizer = load_tokenizer(shared.value)
        pad = tokenizer.n_vocab
        dtype = "<u2" if pad < 1 << 16 else "<u4"
        task, rows, doc = TaskContext.get().partitionId(), 0, 0
        held, size = [], 0

        def flush():
            nonlocal rows, held, size
            packed = pack_ids(held, row_tokens, pad, dtype)
            for i in range(0, len(packed), 1024):
                part = packed[i:i + 1024]
                for k, row in enumerate(part):
                    row |= {"task": task, "matrix_row": rows + k}
                rows += len(part)
                yield pa.RecordBatch.from_pylist(part, schema=_ARROW)
            held, size = [], 0

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(tokenizer, text.as_py() or "").astype(dtype)
                if len(ids):
                    held.append((doc_id, doc, ids))
                    size += len(ids)
                doc += 1
                if size >= buffer_tokens:
                    yield from flush()
        yield from flush()

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(tidy(pack), MATRIX)


def read_back(matrix: DataFrame, dtype: str = "<u2") -> DataFrame:
    """One row per segment: doc_id, task, doc, piece, resumes_at, length,
    matrix_row, checksum of its ids."""
    schema = ("doc_id long, task int, doc long, piece int, resumes_at long, length int, matrix_row long, sha1 binary")

    def segments(batches):
        for batch in batches:
            out = {k: [] for k in ("doc_id", "task", "doc", "piece", "resumes_at", "length", "matrix_row", "sha1")}
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], dtype=dtype)
                for s, a, b in zip(r["segments"], r["cu_seqlens"], r["cu_seqlens"][1:]):
                    for k in ("doc_id", "doc", "piece", "resumes_at"):
                        out[k].append(s[k])
                    out["task"].append(r["task"])
                    out["matrix_row"].append(r["matrix_row"])
                    out["length"].append(b - a)
                    out["sha1"].append(hashlib.sha1(ids[a:b].astype("<u4").tobytes()).digest())
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                [("doc_id", pa.int64()), ("task", pa.int32()), ("doc", pa.int64()), ("piece", pa.int32()),
                 ("resumes_at", pa.int64()), ("length", pa.int32()), ("matrix_row", pa.int64()), ("sha1", pa.binary())]))

    return matrix.mapInArrow(tidy(segments), schema)


def write_matrix(docs: DataFrame, scratch: Scratch, vocabulary: bytes, **options) -> DataFrame:
    return scratch.save(packed_matrix(docs, vocabulary, **options), "matrix")


def op10_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens, n_pieces and ids_digest, the SHA-1 over
    the SHA-1s of its pieces' ids in order, read back from the written files."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    with open(vocabulary_path(), "rb") as f:
        vocabulary = f.read()
    matrix = write_matrix(docs, Scratch(spark, "token-binary"), vocabulary)
    per_doc = (read_back(matrix).groupBy("task", "doc", "doc_id")
               .agg(F.sum("length").cast("long").alias("n_tokens"), F.count(F.lit(1)).alias("n_pieces"),
                    F.sha1(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("piece", F.hex("sha1").alias("d")))),
                                                    lambda x: x["d"]), "").cast("binary")).alias("ids_digest"))
               .drop("task", "doc"))
    blank = docs.where("text is null or text = ''").select(
        "doc_id", F.lit(0).cast("long").alias("n_tokens"), F.lit(0).cast("long").alias("n_pieces"),
        F.lit(None).cast("string").alias("ids_digest"))
    return per_doc.unionByName(blank)


QUERIES = {"op10_token_binary": op10_token_binary}
