"""Operator 8: best-fit packing of documents into sequences.

Documents are cut into pieces of at most ``width`` tokens.  Lengths are then
counted, and best-fit decreasing runs over the counts: all pieces of a length
are placed at once, into the tightest open sequences, which are kept as runs
of equal fill.  The plan is a small table of slots: pieces ``first .. first +
count - 1`` of a length go, ``per`` to a sequence, into consecutive sequences
at a given offset.  Pieces are ranked within their length and take the slot
that holds their rank.

Defined results: NULL and empty texts are documents of one token, the end id.
Rows that repeat a document are packed as often as they occur.  An empty table
gives no rows.  NULL doc_ids are kept.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillroll.llm import common
from tillroll.llm.common import cut, lean, ship
from tillroll.llm.tokens import REMEMBERED, default_vocabulary, encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
SLOTS = "length long, first long, count long, per long, sequence long, offset long"
WIDTH = 2048
END_ID = 0
#: Pieces of one length that are ranked together, about; a length with more is
#: dealt over as many parts as that takes, but PARTS, whose counts are summed up
#: in one task.
RANK_ROWS, PARTS = 1_000, 1 << 16


def _cut_pieces(path: str, width: int, end_id: int, remembered: int = REMEMBERED):
    end = np.array([end_id], "<u4")

    def run(batches):
        enc = encoder(path, remembered)
        common.HELD["tokens"] = encoder.cache_clear
        for batch in batches:
            ids_of = batch.column(0).to_pylist()
            out: list[list[int]] = [[], [], [], [], []]
            for first, ids, starts in enc.encode(batch.column(1)):
                ids = ids.astype("<u4", copy=False)
                for i in range(len(starts) - 1):
                    doc = np.concatenate([ids[starts[i]:starts[i + 1]], end])
                    for piece, at in enumerate(range(0, len(doc), width)):
                        part = doc[at:at + width]
                        for col, x in zip(out, (ids_of[first + i], piece, at, len(part),
                                                zlib.crc32(part.tobytes()))):
                            col.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def token_pieces(docs: DataFrame, vocabulary: str, width: int = WIDTH, end_id: int = END_ID,
                 doc_id: str = "doc_id", text: str = "text", remembered: int = REMEMBERED) -> DataFrame:
    """One row per piece of every document; ``remembered``: see ``tokens``."""
    ship(docs.sparkSession)
    return (docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string"))
                .mapInArrow(lean(_cut_pieces(vocabulary, width, end_id, remembered), "tokens"), PIECES))


def plan_slots(counts: dict[int, int], width: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over the counts of lengths.

    Open sequences are runs (first sequence, number) by room left; at most one
    run per room and one split per length keep the plan to a few rows per
    length and room, however many pieces there are.
    """
    slots, rooms, runs, sequences = [], [], {}, 0
    for length in sorted((x for x, n in counts.items() if n > 0), reverse=True):
        left, rank = counts[length], 0
        while left:
            i = bisect.bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                seq, many = runs[room].pop()
                if not runs[room]:
                    del runs[room], rooms[i]
            else:
                room, per = width, width // length
                seq, many = sequences, -(-left // per)
                sequences += many
            per = room // length
            full = min(many, left // per)
            last = left - full * per if full < many else 0
            for start, number, each in ((seq, full, per), (seq + full, 1, last)):
                if number and each:
                    slots.append((length, rank, number * each, each, start, width - room))
                    _open(rooms, runs, room - each * length, start, number)
                    rank += number * each
                    left -= number * each
            done = full + (last > 0)
            _open(rooms, runs, room, seq + done, many - done)
    return slots


def _open(rooms: list[int], runs: dict[int, list], room: int, start: int, number: int) -> None:
    if room and number:
        if room not in runs:
            bisect.insort(rooms, room)
            runs[room] = []
        runs[room].append((start, number))


def pack(pieces: DataFrame, width: int = WIDTH) -> DataFrame:
    """``pieces`` with sequence_id and offset."""
    spark = pieces.sparkSession
    names = pieces.columns
    # A number of its own for every row: repeated and NULL ids are dealt too.
    pieces = cut(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    # At most ``width`` counts come to the driver, and the plan's size depends
    # on ``width`` alone: both tables below may be broadcast.
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    slots = spark.createDataFrame(plan_slots(counts, width), SLOTS)
    parts = spark.createDataFrame([(x, min(PARTS, -(-n // RANK_ROWS))) for x, n in counts.items()],
                                  "length long, parts long")
    pieces = (pieces.join(F.broadcast(parts), "length")
                    .withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts"))))
    sizes = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    own = Window.partitionBy("length", "part").orderBy("row")
    ranked = (pieces.withColumn("own", F.row_number().over(own) - 1)
                    .join(sizes.select("length", "part", "before"), ["length", "part"])
                    .withColumn("rank", F.col("before") + F.col("own")))
    at = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("count"))
    placed = (ranked.join(F.broadcast(slots.withColumnRenamed("length", "slot_length")),
                          (F.col("length") == F.col("slot_length")) & at))
    k = F.col("rank") - F.col("first")
    return placed.select(*names,
                         (F.col("sequence") + F.floor(k / F.col("per"))).cast("long").alias("sequence_id"),
                         (F.col("offset") + F.pmod(k, F.col("per")) * F.col("length")).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, vocabulary: str | None = None, width: int = WIDTH,
                   end_id: int = END_ID, remembered: int = REMEMBERED) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A worker looks up each chunk of text once and remembers ``remembered`` of
    them, some 40 bytes each: fewer take less memory and more time.
    """
    return pack(token_pieces(docs, vocabulary or default_vocabulary(), width, end_id, remembered=remembered), width)
