"""Token ids on disk: frequency-ranked, byte-aligned variable-length codes.

Ids are replaced by their rank in the corpus (0 = most frequent), so most take
one byte. The codes of a block lie in two streams: a control stream with two
bits per id (its number of bytes less one) and a data stream with the bytes,
low byte first. Decoding needs no branch per id: a 256-row table gives the four
lengths of each control byte, their running sum the position of each code, and
up to four masked reads its value.

A file row is one block: shard, block (the number within the shard of its first
document), the tokens of the shard before it, and a binary blob with header,
document table, control bytes and data bytes. Shards are ranges of doc_id with
a folder each, blocks hold consecutive documents, so shard, block and table
order is ascending doc_id. Blocks are written and read by Spark, through
whatever store the shared folder is in.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.llm.common import arrow, id_and_text, scratch, session, written
from ringwatch.llm.encoding import encoder
from ringwatch.llm.packing import ddl

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
#: A block is closed at the first document that takes it to this many tokens.
BLOCK_TOKENS = 1 << 19

MAGIC = b"RWT1"
HEADER = struct.Struct("<4sIQ")  # magic, documents, tokens
NULL_ID = -(2**63)

TOKENS = pa.schema([("shard", pa.int64()), ("seq", pa.int64()), ("at", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.binary())])
COUNTS = pa.schema([("token", pa.int64()), ("n", pa.int64())])
BLOCKS = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("first_token", pa.int64()),
                    ("n_tokens", pa.int64()), ("n_docs", pa.int64()), ("blob", pa.binary())])
OUT = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
                 ("shard", pa.int64()), ("block", pa.int64())])

#: Lengths of the four codes of each control byte.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    v = values.astype("<u4")
    width = 2 if not len(v) or v.max() < 1 << 16 else 4  # bytes that any code here may take
    code = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    for k in range(1, width):
        code[:len(v)] += v >= np.uint32(1 << 8 * k)
    quad = code.reshape(-1, 4)
    control = quad[:, 0] | quad[:, 1] << 2 | quad[:, 2] << 4 | quad[:, 3] << 6
    raw = v.astype(f"<u{width}").view(np.uint8).reshape(-1, width)
    keep = np.ones(raw.shape, bool)
    for k in range(1, width):
        keep[:, k] = code[:len(v)] >= k
    return control.tobytes(), raw[keep].tobytes()


def decode_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n values back, by table lookup on the control bytes."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    end = np.cumsum(size, dtype=np.int64)
    at = end - size
    raw = np.frombuffer(data, np.uint8)
    out = raw[at].astype(np.uint32) if n else np.zeros(0, np.uint32)
    for k in range(1, int(size.max()) if n else 1):
        more = np.flatnonzero(size > k)
        out[more] |= raw[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def encode_block(doc_ids: list, counts: list[int], ranks: np.ndarray) -> bytes:
    control, data = encode_values(ranks)
    ids = np.array([NULL_ID if d is None else d for d in doc_ids], "<i8")
    return b"".join([HEADER.pack(MAGIC, len(doc_ids), len(ranks)), ids.tobytes(), np.array(counts, "<u8").tobytes(),
                     control, data])


def decode_block(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc ids, tokens of each document, ranks)."""
    magic, docs, n = HEADER.unpack_from(blob)
    if magic != MAGIC:
        raise ValueError("not a token block")
    at = HEADER.size
    ids = np.frombuffer(blob, "<i8", docs, at)
    counts = np.frombuffer(blob, "<u8", docs, at + 8 * docs).astype(np.int64)
    at += 16 * docs
    control = -(-n // 4)
    return ids, counts, decode_values(blob[at:at + control], blob[at + control:], n)


def _tokenise(batches: Iterator[pa.RecordBatch], name: str, end_id: int) -> Iterator[pa.RecordBatch]:
    enc, end = encoder(name), np.array([end_id], "<u4").tobytes()
    shard, seq, at = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        ids, ats = [], []
        for text in batch.column("text").to_pylist():
            own = np.frombuffer(enc.ids(text) + end, "<u4")
            ids.append(_short(own))
            ats.append(at)
            at += len(own)
        yield arrow(TOKENS, shard=[shard] * len(ids), seq=range(seq, seq + len(ids)), at=ats,
                    doc_id=batch.column("doc_id"), ids=ids)
        seq += len(ids)


def _short(ids: np.ndarray) -> bytes:
    """Width byte and the ids in 16 bits where they fit, else 32."""
    return b"\x02" + ids.astype("<u2").tobytes() if ids.max() < 1 << 16 else b"\x04" + ids.tobytes()


def _long(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype("<u4")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        raw = batch.column("ids").to_pylist()
        for width in (2, 4):
            own = np.bincount(np.frombuffer(b"".join([r[1:] for r in raw if r[0] == width]), f"<u{width}"))
            if len(own) > len(total):
                own[:len(total)] += total
                total = own
            else:
                total[:len(own)] += own
    token = np.flatnonzero(total)
    yield arrow(COUNTS, token=token, n=total[token])


def rank_table(tokens: DataFrame) -> np.ndarray:
    """Token ids by descending count over all documents, ties by id. At most one entry per vocabulary id."""
    rows = (tokens.select("ids").mapInArrow(_count, ddl(COUNTS)).groupBy("token").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "token").select("token").toPandas())
    return rows["token"].to_numpy(dtype=np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], rank_of: np.ndarray, block_tokens: int) -> Iterator[pa.RecordBatch]:
    """Blocks of documents that follow each other in their shard."""
    docs: list = []
    parts: list = []
    shard = block = first = after = None
    held = 0

    def close():
        ranks = rank_of[np.concatenate(parts)]
        return arrow(BLOCKS, shard=[shard], block=[block], first_token=[first], n_tokens=[held], n_docs=[len(docs)],
                     blob=[encode_block(docs, [len(p) for p in parts], ranks)])

    for batch in batches:
        for own, seq, at, doc_id, raw in zip(*(batch.column(c).to_pylist() for c in TOKENS.names)):
            if docs and (own != shard or seq != after or held >= block_tokens):
                yield close()
                docs, parts, held = [], [], 0
            if not docs:
                shard, block, first = own, seq, at
            ids = _long(raw)
            docs.append(doc_id)
            parts.append(ids)
            held, after = held + len(ids), seq + 1
    if docs:
        yield close()


def write_token_files(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, end_id: int = END_ID,
                      id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> str:
    """Encode ``docs`` into ``folder``: ``ranks`` (token by rank) and ``blocks``. Null texts count as empty;
    every document ends with ``end_id``. Null ids come first, repeated ids in the order of their texts."""
    spark = session(docs.sparkSession)
    ordered = id_and_text(docs, id_col, text_col)
    # Ranges of (id, text digest): a repeated id can be split, too.
    ordered = ordered.withColumn("tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    tokens = written(ordered.mapInArrow(lambda b: _tokenise(b, tokenizer, end_id), ddl(TOKENS)), "token-ids")
    by_rank = rank_table(tokens)
    rank_of = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank))
    spark.createDataFrame([(int(t), k) for k, t in enumerate(by_rank)], "token long, rank long").coalesce(1).write.parquet(f"{folder}/ranks")
    (tokens.mapInArrow(lambda b: _blocks(b, rank_of, block_tokens), ddl(BLOCKS))
     .write.partitionBy("shard").option("compression", "uncompressed").parquet(f"{folder}/blocks"))
    return folder


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, shard, block) decoded from the files; ``start`` counts the ids
    of all documents before it."""
    session(spark)
    by_rank = spark.read.parquet(f"{folder}/ranks").orderBy("rank").toPandas()["token"].to_numpy(dtype=np.uint32)
    blocks = spark.read.schema(ddl(BLOCKS)).parquet(f"{folder}/blocks")
    # One row per shard, of which there are as many as the writing stage had tasks.
    sizes = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()
    before, total = {}, 0
    for r in sizes:
        before[r.shard] = total
        total += r.n

    def run(batches):
        for batch in batches:
            for shard, block, first, blob in zip(*(batch.column(c).to_pylist() for c in ("shard", "block", "first_token", "blob"))):
                ids, counts, ranks = decode_block(blob)
                raw = by_rank[ranks].astype("<u4").tobytes()
                ends = np.cumsum(counts)
                starts = ends - counts
                crc = [zlib.crc32(raw[4 * s:4 * e]) for s, e in zip(starts.tolist(), ends.tolist())]
                n = len(ids)
                yield arrow(OUT, doc_id=[None if d == NULL_ID else d for d in ids.tolist()],
                            start=starts + first + before[shard], n_tokens=counts, ids_crc32=crc,
                            shard=[shard] * n, block=[block] * n)

    return blocks.select("shard", "block", "first_token", "blob").mapInArrow(run, ddl(OUT))


def token_files(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID, id_col: str = "doc_id",
                text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Write ``docs`` as token files in the shared folder and read them back: one row per document.
    An empty table gives empty files and an empty result."""
    spark = docs.sparkSession
    folder = scratch(spark, "token-files")
    return read_token_files(spark, write_token_files(docs, folder, tokenizer, end_id, id_col, text_col, block_tokens))
