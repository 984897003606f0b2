"""Operator 5, token ids in binary files with shuffled planes.

Texts are put in ascending id order by a range sort, encoded, and written as a table of segments of whole
documents. A segment row is the file format's unit and can be read alone:

    shard, segment       place in the order
    doc_ids, n_tokens    its documents and their numbers of ids, end id included
    blocks               the chunk index: for each block of ``BLOCK`` ids (the last may be shorter) its ids,
                         and the compressed bytes of each of its planes
    payload              the planes one after the other, each a zstandard frame

A block of 32-bit ids is transposed into planes, by bytes (plane k holds byte k of every id) or by bits, and as
many planes as its largest id needs are kept. A second stored table, the index, has the number of ids before each
segment. Reading needs no order among rows: each segment is decoded where it lies and its start is joined on.

Defined results: a null text is empty and has the end id only; null ids come first; rows of equal id follow the
hash of their text, repeated rows are documents each; an empty table gives no segments. Only the id and text
columns are read.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillworks.llm.common import in_batches, resident, stored, table

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
BLOCK = 1 << 16
SEGMENT_IDS = 1 << 18
SEGMENT_ROWS = 16  # segments that travel to a Python worker at once
CACHED_WORDS = 250_000  # some 50 MB in a Python worker

# The normaliser and splitter for which words can be encoded one by one.
_WORD_WISE = {
    "normalizer": ["NFC", "Replace", "Lowercase"],
    "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
}
# Texts without such characters are plain: on all others lower case, letter class and white space are beyond doubt.
_ODD = re.compile(r"[^\x09-\x0D\x20-\x7EÀ-ÖØ-öø-ÿ]")
_PIECES = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\x09-\x0D\x20a-zß-öø-ÿ0-9]+")


class _Words(dict):
    """Ids of single words as bytes, encoded when first met; the first ``CACHED_WORDS`` are kept."""

    def __init__(self, tokenizer):
        self.encode = tokenizer.encode

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self) < CACHED_WORDS:
            self[word] = ids
        return ids


class Encoder:
    """A tokenizers file. Plain texts are encoded word by word from a cache, all others whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        split = ((spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0].get("pattern", {}).get("Regex")
        self.words = None
        if steps == _WORD_WISE["normalizer"] and split == _WORD_WISE["pattern"]:
            one = Tokenizer.from_file(path)
            one.normalizer = None
            one.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.words = _Words(one)

    @functools.cached_property
    def whole(self):
        """The file's tokenizer as it is; loaded when a text needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, "<u4")
        if self.words is not None and not _ODD.search(text) and not any(s in text for s in self.special):
            return np.frombuffer(b"".join(map(self.words.__getitem__, _PIECES.findall(text.lower()))), "<u4")
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")


def encoder(path: str | None) -> Encoder:
    """One per Python worker; None is the public vocabulary where the worker runs."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    return resident(("tokens", path), lambda: Encoder(path))


def to_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """A block's planes: as many as the largest id has bytes (or bits)."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    top = int(ids.max()) if len(ids) else 0
    if bits:
        raw = np.unpackbits(raw, axis=1, bitorder="little")[:, : top.bit_length()]
        return [np.packbits(plane, bitorder="little").tobytes() for plane in raw.T]
    return [plane.tobytes() for plane in raw[:, : -(-top.bit_length() // 8)].T]


def from_planes(planes: list[bytes], n: int, bits: bool = False) -> np.ndarray:
    if bits:
        rows = np.zeros((n, 32), np.uint8)
        for k, plane in enumerate(planes):
            rows[:, k] = np.unpackbits(np.frombuffer(plane, np.uint8), bitorder="little")[:n]
        return np.packbits(rows, axis=1, bitorder="little").view("<u4").ravel()
    rows = np.zeros((n, 4), np.uint8)
    for k, plane in enumerate(planes):
        rows[:, k] = np.frombuffer(plane, np.uint8)
    return rows.view("<u4").ravel()


def pack(ids: np.ndarray, block: int = BLOCK, bits: bool = False, level: int = 3) -> tuple[list[dict], bytes]:
    """The chunk index and payload of a segment."""
    squeeze = zstandard.ZstdCompressor(level=level).compress
    index, payload = [], []
    for k in range(0, len(ids), block):
        part = ids[k : k + block]
        frames = [squeeze(p) for p in to_planes(part, bits)]
        index.append({"ids": len(part), "planes": [len(f) for f in frames]})
        payload += frames
    return index, b"".join(payload)


def unpack(index: list[dict], payload: bytes, bits: bool = False) -> np.ndarray:
    expand, at, parts = zstandard.ZstdDecompressor().decompress, 0, []
    for b in index:
        planes = []
        for size in b["planes"]:
            planes.append(expand(payload[at : at + size]))
            at += size
        parts.append(from_planes(planes, b["ids"], bits))
    return np.concatenate(parts) if parts else np.zeros(0, "<u4")


def write(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end_id: int = END_ID, bits: bool = False, segment_ids: int = SEGMENT_IDS) -> tuple[DataFrame, DataFrame]:
    """The stored segments and the stored index (shard, segment, start)."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"shard int, segment int, n_ids bigint, doc_ids array<{kind}>, n_tokens array<int>, "
              "blocks array<struct<ids:int,planes:array<int>>>, payload binary")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path), np.array([end_id], "<u4")
        shard, made, ids, parts, held = TaskContext.get().partitionId(), 0, [], [], 0
        blocks_type = pa.list_(pa.struct([("ids", pa.int32()), ("planes", pa.list_(pa.int32()))]))

        def row(id_type: pa.DataType) -> pa.RecordBatch:
            whole = np.concatenate([x for p in parts for x in (p, end)])
            blocks, payload = pack(whole, BLOCK, bits)
            return pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "segment": pa.array([made], pa.int32()), "n_ids": [len(whole)],
                "doc_ids": pa.array([ids], pa.list_(id_type)), "n_tokens": pa.array([[len(p) + 1 for p in parts]], pa.list_(pa.int32())),
                "blocks": pa.array([blocks], blocks_type), "payload": pa.array([payload], pa.binary())})

        for batch in batches:
            id_type = batch.column(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = encode(text.as_py())
                ids.append(doc)
                parts.append(found)
                held += len(found) + 1
                if held >= segment_ids:
                    yield row(id_type)
                    ids, parts, held, made = [], [], 0, made + 1
        if ids:
            yield row(id_type)

    in_batches(docs.sparkSession)
    order = [F.col(id_col).asc_nulls_first(), F.xxhash64(text_col)]
    placed = docs.select(id_col, text_col).repartitionByRange(*order).sortWithinPartitions(*order)
    data = stored(placed.mapInArrow(segments, schema), "token-segments", "none")
    in_batches(docs.sparkSession, SEGMENT_ROWS)
    sizes = data.select("shard", "segment", "n_ids")
    of_shard = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    so_far = Window.rowsBetween(Window.unboundedPreceding, -1)
    before = of_shard.select("shard", F.coalesce(F.sum("n").over(so_far.orderBy("shard")), F.lit(0)).alias("base"))  # a row per shard
    inside = F.coalesce(F.sum("n_ids").over(so_far.partitionBy("shard").orderBy("segment")), F.lit(0))
    index = sizes.withColumn("inside", inside).join(before, "shard").select("shard", "segment", (F.col("base") + F.col("inside")).alias("start"))
    return data, stored(index, "token-index")


def read(data: DataFrame, index: DataFrame, bits: bool = False) -> DataFrame:
    """Per document of the files doc_id, start, n_tokens, ids_crc32."""
    kind = data.schema["doc_ids"].dataType.elementType.simpleString()

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, n = unpack(r["blocks"], r["payload"], bits), np.array(r["n_tokens"], np.int64)
                ends = np.cumsum(n)
                sums = [zlib.crc32(ids[e - k : e].tobytes()) for e, k in zip(ends.tolist(), n.tolist())]
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([r["shard"]] * len(n), pa.int32()), "segment": pa.array([r["segment"]] * len(n), pa.int32()),
                    "doc_id": pa.array(r["doc_ids"], batch.schema.field("doc_ids").type.value_type),
                    "inside": ends - n, "n_tokens": n, "ids_crc32": pa.array(sums, pa.int64())})

    found = data.select("shard", "segment", "doc_ids", "n_tokens", "blocks", "payload").mapInArrow(
        documents, f"shard int, segment int, doc_id {kind}, inside bigint, n_tokens bigint, ids_crc32 bigint")
    return found.join(index, ["shard", "segment"]).select("doc_id", (F.col("start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def op5_token_files(spark, sf_dir):
    return read(*write(table(spark, sf_dir, "documents")))
