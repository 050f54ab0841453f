"""Operator 2: token ids in files, canonical length-limited Huffman coded.

``write_ids`` deals the documents by doc_id range, tokenizes them in order and
keeps the ids in blocks of whole documents; counts of all ids give one code of
at most 16 bits a token, found by package-merge and stored as code lengths
only.  A block holds its documents' ids as one bit string with the bit offset
of every 128th token, so blocks decode on their own and a block's checkpoints
decode side by side, by one table of 2**16 entries.

A folder of this format has two Parquet tables: ``codebook`` (id, bits) and
``blocks`` (part, block, first, doc_ids, sizes, n_tokens, payload,
checkpoints), ``first`` being the block's first token within its part.

Defined results: a NULL text is an empty one, whose ids are the end id alone.
NULL doc_ids come first.  Rows that repeat a doc_id follow each other, ordered
by a hash of their text.  An empty table gives an empty folder that reads back
as no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillroll.llm.common import cut, ship
from tillroll.llm.tokens import default_vocabulary, encoder

MAX_BITS = 16
BLOCK_TOKENS = 1 << 16
CHECKPOINT = 128
END_ID = 1
RAW = "part int, block int, first long, doc_ids array<long>, sizes array<long>, ids binary"
BLOCKS = ("part int, block int, first long, doc_ids array<long>, sizes array<long>, "
          "n_tokens long, payload binary, checkpoints array<long>")
DOCS = "part int, doc_id long, own_start long, n_tokens long, ids_crc32 long"


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Bits of each symbol in a best prefix code of at most ``max_bits``, by
    package-merge; symbols that do not occur get 0."""
    seen = np.flatnonzero(counts)
    n = len(seen)
    bits = np.zeros(len(counts), "i8")
    if n < 2:
        bits[seen] = 1
        return bits
    if n > 1 << max_bits:
        raise ValueError(f"{n} symbols do not fit codes of {max_bits} bits")
    order = seen[np.argsort(counts[seen], kind="stable")]
    own = counts[order].astype("i8")
    level, single = own, [np.ones(n, bool)]
    for _ in range(max_bits - 1):
        pairs = level[:len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([own, pairs])
        at = np.argsort(both, kind="stable")
        level = both[at]
        single.append(at < n)
    take = 2 * n - 2
    for flags in reversed(single):
        alone = int(flags[:take].sum())
        bits[order[:alone]] += 1
        take = 2 * (take - alone)
    return bits


def canonical_codes(bits: np.ndarray) -> np.ndarray:
    """Codes in order of (bits, symbol)."""
    codes = np.zeros(len(bits), "u4")
    order = np.lexsort((np.arange(len(bits)), bits))
    order = order[bits[order] > 0]
    code, width = 0, 0
    for size in np.unique(bits[order]):
        code <<= int(size) - width
        width = int(size)
        of = order[bits[order] == size]
        codes[of] = code + np.arange(len(of))
        code += len(of)
    return codes


def pack_bits(ids: np.ndarray, bits: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The ids' bit string, first bit highest, and the checkpoints."""
    size = bits[ids]
    end = np.cumsum(size)
    at = end - size
    total = int(end[-1]) if len(end) else 0
    word = at >> 4
    shifted = codes[ids].astype("i8") << (32 - (at & 15) - size)
    n = (total >> 4) + 2
    # No two codes share a bit, so sums are unions; they are exact in doubles.
    out = np.bincount(word, weights=shifted >> 16, minlength=n)[:n]
    out += np.bincount(word + 1, weights=shifted & 0xFFFF, minlength=n)[:n]
    return out.astype(">u2").tobytes()[:(total + 7) // 8], at[::CHECKPOINT]


def decode_table(bits: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(symbol, bits) for every value of the next ``max_bits`` bits."""
    symbols, sizes = np.zeros(1 << max_bits, "u4"), np.zeros(1 << max_bits, "i8")
    order = np.lexsort((np.arange(len(bits)), bits))
    order = order[bits[order] > 0]
    span = 1 << (max_bits - bits[order])
    n = int(span.sum())         # canonical codes fill the table from 0 on
    symbols[:n], sizes[:n] = np.repeat(order, span), np.repeat(bits[order], span)
    return symbols, sizes


def unpack_bits(payload: bytes, checkpoints: np.ndarray, n: int, table) -> np.ndarray:
    """All checkpoints' runs are read side by side, a token a step."""
    symbols, sizes = table
    raw = np.frombuffer(payload + bytes(CHECKPOINT * MAX_BITS // 8 + 8), "u1").astype("u4")
    three = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    at = checkpoints.astype("i8")
    out = np.empty((min(CHECKPOINT, n), len(at)), "u4")
    for step in range(len(out)):
        x = (three[at >> 3] >> (8 - (at & 7)).astype("u4")) & 0xFFFF
        out[step] = symbols[x]
        at += sizes[x]
    return out.T.ravel()[:n]


def _tokenize(path: str, end_id: int, kind: str):
    end = np.array([end_id], "u4")

    def run(batches):
        enc, part = encoder(path), TaskContext.get().partitionId()
        docs, sizes, ids, held, block, first = [], [], [], 0, 0, 0
        for batch in batches:
            names = batch.column(0).to_pylist()
            for at, got, starts in enc.encode(batch.column(1)):
                for i in range(len(starts) - 1):
                    ids += [got[starts[i]:starts[i + 1]], end]
                    docs.append(names[at + i])
                    sizes.append(int(starts[i + 1] - starts[i]) + 1)
                    held += sizes[-1]
                    if held >= BLOCK_TOKENS:
                        yield _block(part, block, first, docs, sizes, ids, kind)
                        block, first = block + 1, first + held
                        docs, sizes, ids, held = [], [], [], 0
        if docs:
            yield _block(part, block, first, docs, sizes, ids, kind)
    return run


def _block(part, block, first, docs, sizes, ids, kind) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([first], pa.int64()),
         pa.array([docs], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
         pa.array([np.concatenate(ids).astype(kind).tobytes()], pa.binary())],
        names=["part", "block", "first", "doc_ids", "sizes", "ids"])


def _count(symbols: int, kind: str):
    def run(batches):
        total = np.zeros(symbols, "i8")
        for batch in batches:
            for x in batch.column(0):
                total += np.bincount(np.frombuffer(x.as_buffer(), kind), minlength=symbols)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())],
                                         names=["id", "n"])
    return run


def _compress(bits: np.ndarray, kind: str):
    def run(batches):
        codes = canonical_codes(bits)
        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column(5)[i].as_buffer(), kind)
                payload, checkpoints = pack_bits(ids, bits, codes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(i, 1) for c in range(5)]
                    + [pa.array([len(ids)], pa.int64()), pa.array([payload], pa.binary()),
                       pa.array([checkpoints], pa.list_(pa.int64()))],
                    names=["part", "block", "first", "doc_ids", "sizes", "n_tokens", "payload", "checkpoints"])
    return run


def decode_blocks(batches, bits: np.ndarray):
    """Yield (row of the block as a dict without its payload, ids)."""
    table = decode_table(bits)
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i].as_py() for n in ("part", "first", "doc_ids", "sizes", "n_tokens")}
            checkpoints = batch.column("checkpoints")[i].values.to_numpy()
            yield row, unpack_bits(batch.column("payload")[i].as_py(), checkpoints, row["n_tokens"], table)


def _digest(bits: np.ndarray):
    def run(batches):
        for row, ids in decode_blocks(batches, bits):
            ids = ids.astype("<u4", copy=False)
            sizes = np.asarray(row["sizes"], "i8")
            end = np.cumsum(sizes)
            crc = [zlib.crc32(ids[e - s:e].tobytes()) for s, e in zip(sizes, end)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(sizes), row["part"], "i4")), pa.array(row["doc_ids"], pa.int64()),
                 pa.array(row["first"] + end - sizes), pa.array(sizes), pa.array(crc, pa.int64())],
                names=["part", "doc_id", "own_start", "n_tokens", "ids_crc32"])
    return run


def write_ids(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID,
              doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the ids of all documents, in ascending doc_id order, to ``path``."""
    spark = docs.sparkSession
    ship(spark)
    vocabulary = vocabulary or default_vocabulary()
    symbols = max(encoder(vocabulary).library.get_vocab_size(), end_id + 1)
    kind = "<u2" if symbols <= 1 << 16 else "<u4"
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    raw = cut(rows.select("doc_id", "text").mapInArrow(_tokenize(vocabulary, end_id, kind), RAW), "raw-ids")
    # One row per id of the vocabulary comes to the driver.
    counts = np.zeros(symbols, "i8")
    for r in (raw.select("ids").mapInArrow(_count(symbols, kind), "id long, n long")
                 .groupBy("id").agg(F.sum("n").alias("n")).collect()):
        counts[r["id"]] = r["n"]
    bits = code_lengths(counts)
    book = [(int(i), int(bits[i])) for i in np.flatnonzero(bits)]
    spark.createDataFrame(book, "id long, bits int").coalesce(1).write.parquet(f"{path}/codebook")
    raw.mapInArrow(_compress(bits, kind), BLOCKS).write.parquet(f"{path}/blocks")


def read_bits(spark: SparkSession, path: str) -> np.ndarray:
    """Code lengths by id; the codebook has a row per id that occurs."""
    book = spark.read.schema("id long, bits int").parquet(f"{path}/codebook").collect()
    bits = np.zeros(max((r["id"] for r in book), default=0) + 1, "i8")
    for r in book:
        bits[r["id"]] = r["bits"]
    return bits


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of a folder."""
    ship(spark)
    bits = read_bits(spark, path)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    # One row per part, that is, per task that wrote; parts are in doc_id order.
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    docs = blocks.mapInArrow(_digest(bits), DOCS)
    return (docs.join(F.broadcast(parts), "part")
                .select("doc_id", (F.col("before") + F.col("own_start")).alias("start"), "n_tokens", "ids_crc32"))
