"""Token ids in files: frequency ranks in a byte-aligned code with separate control bytes.

A block holds documents in ascending order of their keys. Each id is replaced by its rank among
all ids of the corpus, the most frequent one being 0, and written in one to four bytes; two bits
for each id, four ids in a control byte, tell how many. A reader looks the lengths of four ids up
for each control byte, adds them up, and picks the bytes, all in numpy.

A set of files is a folder: ``blocks`` is a Parquet table with a block in each row, so a lost task writes
its blocks again, and ``header`` one with the ids by rank, the tokenizer's name and the end id. Whoever has the
folder can read it, in another session and without the tokenizer.

Block: ``WTOK``, documents and ids as unsigned 64-bit numbers, document keys (signed 64-bit; a
mask byte each for null keys before them), the lengths of the documents in the same code, then the ids.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .ids import encoder, public_path
from .tables import ROW_GROUP_BYTES, only, stored
from .words import slices

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
MAGIC = b"WTOK"
#: Ids after which a block is closed.
BLOCK_IDS = 1 << 20

_CODE_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.int8) + 1
_LANES = np.arange(4, dtype=np.int8)


def pack_numbers(values: np.ndarray) -> bytes:
    """Numbers below 2**32 as control bytes, then data bytes."""
    values = np.ascontiguousarray(values, dtype="<u4")
    length = 1 + (values > 0xFF).astype(np.int8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    code = np.zeros(-(-len(values) // 4) * 4, dtype=np.uint8)
    code[:len(values)] = length - 1
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    data = values.view(np.uint8).reshape(-1, 4)[_LANES < length[:, None]]
    return control.tobytes() + data.tobytes()


def unpack_numbers(raw: np.ndarray, n: int) -> tuple[np.ndarray, int]:
    """(the first ``n`` numbers of ``raw``, bytes they took)."""
    controls = -(-n // 4)
    length = _CODE_LENGTHS[raw[:controls]].ravel()[:n]
    end = np.cumsum(length, dtype=np.int64)
    begin = controls + end - length
    out = raw[begin].astype(np.uint32)
    for lane in (1, 2, 3):
        longer = np.flatnonzero(length > lane)
        if len(longer):
            out[longer] |= raw[begin[longer] + lane].astype(np.uint32) << np.uint32(8 * lane)
    return out, controls + int(end[-1]) if n else 0


def write_block(keys: list[int | None], lengths: np.ndarray, ranks: np.ndarray) -> bytes:
    missing = np.array([k is None for k in keys], dtype=np.uint8)
    known = np.array([0 if k is None else k for k in keys], dtype="<i8")
    return b"".join([MAGIC, struct.pack("<QQ", len(keys), len(ranks)), missing.tobytes(), known.tobytes(),
                     pack_numbers(lengths), pack_numbers(ranks)])


def read_block(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(keys, lengths, ranks) of a block."""
    if block[:4] != MAGIC:
        raise ValueError("not a token block")
    docs, ids = struct.unpack_from("<QQ", block, 4)
    at = 20 + docs
    missing = np.frombuffer(block, np.uint8, docs, 20)
    keys = [None if m else k for m, k in zip(missing.tolist(), np.frombuffer(block, "<i8", docs, at).tolist())]
    raw = np.frombuffer(block, np.uint8, offset=at + 8 * docs)
    lengths, used = unpack_numbers(raw, docs)
    return keys, lengths.astype(np.int64), unpack_numbers(raw[used:], ids)[0]


def encoded(docs: DataFrame, tokenizer: str, end_id: int, wide: bool) -> DataFrame:
    """(doc_id, ids) of every row: its ids and the end id in two or four bytes each."""
    kind = "<u4" if wide else "<u2"

    def run(batches):
        texts = encoder(tokenizer, leading=False).texts
        for batch in batches:
            for s in slices(batch.column(1)):
                flat, at = texts(s)
                flat = np.insert(flat, at[1:], end_id).astype(kind)
                ends = at[1:] + np.arange(1, s.rows + 1)
                begins = at[:-1] + np.arange(s.rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.first, s.rows),
                     pa.array([flat[a:b].tobytes() for a, b in zip(begins.tolist(), ends.tolist())], pa.binary())],
                    names=["doc_id", "ids"])

    return docs.mapInArrow(run, "doc_id long, ids binary")


def counted(rows: DataFrame, kind: str, size: int) -> np.ndarray:
    """How often each id stands in all documents."""

    def run(batches):
        count = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for ids in batch.column(0):
                count += np.bincount(np.frombuffer(ids.as_buffer(), dtype=kind), minlength=size)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some])], names=["id", "times"])

    count = np.zeros(size, dtype=np.int64)
    for r in rows.select("ids").mapInArrow(run, "id long, times long").groupBy("id").agg(F.sum("times")).toLocalIterator():
        count[r[0]] = r[1]
    return count


HEADER = "tokenizer string, end_id long, by_rank binary"
BLOCKS = "part int, block int, before long, n_ids long, payload binary"


def write(docs: DataFrame, path: str, tokenizer: str | None = None, key: str = "doc_id", text: str = "text",
          end_id: int = END_ID) -> None:
    """Writes the ids of all rows of ``docs`` in ascending order of their keys to the new folder ``path``.

    A row of ``blocks`` has part and block (their order is the documents' order), before (ids of the part
    in earlier blocks), n_ids and payload. A null or empty text is its end id alone; null keys come
    first; rows with the same key stand in the order of their ids. An empty table has no blocks. Other
    columns are not looked at.
    """
    tokenizer = tokenizer or public_path(TOKENIZER)
    size = max(encoder(tokenizer, leading=False).tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
    wide = size > 1 << 16
    kind = "<u4" if wide else "<u2"
    rows = stored(encoded(only(docs, key, text), tokenizer, end_id, wide), "encoded")
    by_rank = np.argsort(-counted(rows, kind, size), kind="stable").astype("<u4")  # one number for each id of the tokenizer
    rank = np.empty(size, dtype="<u4")
    rank[by_rank] = np.arange(size, dtype="<u4")
    sent = docs.sparkSession.sparkContext.broadcast(rank)

    def run(batches):
        part = TaskContext.get().partitionId()
        keys, held, n, before, block = [], [], 0, 0, 0

        def closed():
            lengths = np.array([len(h) for h in held], dtype=np.int64)
            payload = write_block(keys, lengths, sent.value[np.concatenate(held)])
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in (
                (part, pa.int32()), (block, pa.int32()), (before, pa.int64()), (n, pa.int64()), (payload, pa.binary()))],
                names=["part", "block", "before", "n_ids", "payload"])

        for batch in batches:
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys.append(k)
                held.append(np.frombuffer(ids.as_py(), dtype=kind))
                n += len(held[-1])
                if n >= BLOCK_IDS:
                    yield closed()
                    keys, held, n, before, block = [], [], 0, before + n, block + 1
        if keys:
            yield closed()

    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(run, BLOCKS).write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(f"{path.rstrip('/')}/blocks")
    # the header comes last: a folder without one was not finished
    spark = docs.sparkSession
    (spark.createDataFrame([(tokenizer.rsplit("/", 1)[-1], end_id, by_rank.tobytes())], HEADER).coalesce(1)
     .write.parquet(f"{path.rstrip('/')}/header"))


def as_rows(keys: list[int | None], starts: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """Documents of a block with their ids as unsigned 32-bit integers."""
    ends = np.cumsum(lengths)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array(starts),
         pa.array([ids[a:b].tobytes() for a, b in zip((ends - lengths).tolist(), ends.tolist())], pa.binary())],
        names=["doc_id", "start", "ids"])


def header(spark: SparkSession, path: str) -> tuple[str, int, np.ndarray]:
    """(name of the tokenizer, end id, ids by rank) of a folder; one number for each id of the tokenizer."""
    row = spark.read.schema(HEADER).parquet(f"{path.rstrip('/')}/header").first()
    return row["tokenizer"], row["end_id"], np.frombuffer(row["by_rank"], "<u4")


def read(spark: SparkSession, path: str, make=as_rows, schema: str = "doc_id long, start long, ids binary") -> DataFrame:
    """Every document of a folder of token files, from the folder alone.

    ``make`` turns a decoded block (keys, starts, lengths, all ids) into rows of ``schema`` where it is
    decoded, so a reader that needs less than the ids does not pass them on.
    """
    blocks, (_, _, by_rank) = spark.read.schema(BLOCKS).parquet(f"{path.rstrip('/')}/blocks"), header(spark, path)
    total, starts = 0, {}
    for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").toLocalIterator():  # a row for each task that wrote
        starts[r["part"]] = total
        total += r["n"]
    sent = spark.sparkContext.broadcast((starts, by_rank))

    def run(batches):
        starts, by_rank = sent.value
        for batch in batches:
            for part, before, payload in zip(*(batch.column(i) for i in range(3))):
                keys, lengths, ranks = read_block(payload.as_py())
                first = np.cumsum(lengths) - lengths + starts[part.as_py()] + before.as_py()
                yield make(keys, first, lengths, by_rank[ranks])

    return blocks.select("part", "before", "payload").mapInArrow(run, schema)
