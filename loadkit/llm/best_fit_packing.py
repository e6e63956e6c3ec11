"""Best-fit packing planned on the histogram of lengths.

Documents are cut into pieces of at most `size` tokens; only a longer document
is cut, and only its first piece may be short. The driver plans on counts per
length, at most `size` numbers, not on documents: best-fit decreasing places
runs of equal pieces into groups of equal sequences. Pieces then take the
planned places by joining on their rank within their length.

Defined results. A missing text is empty and has the end id only. Rows that
repeat a doc_id are documents of their own. An empty table gives no rows.
Columns that are not named are carried along under any name.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadkit.llm.shared import columns, map_batches, stage
from loadkit.llm.unit_tokens import library_encoder

#: Pieces of one length are ranked in parts of about so many.
RANKED = 50_000


def cut(docs: DataFrame, tokenizer_json: str, end_id: int, size: int = 2048, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids): every document's pieces; ids as 32-bit little-endian integers."""
    given = columns(docs, doc=doc, text=text)
    made = []

    def work(batch):
        if not made:
            made.append(library_encoder(tokenizer_json))
        ids, at = made[0].ids(batch.column("text"))
        total = np.diff(at) + 1
        full = np.full(len(ids) + len(total), end_id, "<u4")
        full[np.arange(len(ids)) + np.repeat(np.arange(len(total)), np.diff(at))] = ids
        pieces = -(-total // size)
        owner = np.repeat(np.arange(len(total)), pieces)
        piece = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = total - (pieces - 1) * size
        length = np.where(piece == 0, first[owner], size)
        start = np.where(piece == 0, 0, first[owner] + (piece - 1) * size)
        bounds = np.concatenate([[0], np.cumsum(4 * length)])
        packed = pa.Array.from_buffers(pa.large_binary(), len(owner), [None, pa.py_buffer(bounds), pa.py_buffer(full)]).cast(pa.binary())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc").take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
             pa.array(length, pa.int64()), packed], ["doc_id", "piece", "start", "length", "ids"])

    kind = given.schema["doc"].dataType.simpleString()
    # Larger slices hold fewer distinct units a byte, and each of those is looked up once a slice.
    return map_batches(given, work, f"doc_id {kind}, piece int, start long, length long, ids binary", most=2 << 20)


def plan(counts: Iterable[tuple[int, int]], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts of lengths.

    Returns runs (length, first_rank, pieces, per_sequence, sequence, offset): the
    pieces of that length with ranks from `first_rank` fill, `per_sequence` to each, the
    sequences from `sequence` on, beginning at `offset`.

    Sequences with the same room left are kept as ranges of numbers. A piece goes
    where the least room is left that holds it; more pieces of that length then go
    to the same sequence until it holds no more, so a range is filled as a whole.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> ranges (first sequence, how many)
    rooms: list[int] = []  # the rooms that occur, ascending
    runs, fresh = [], 0

    def add(left: int, first: int, many: int) -> None:
        if left and many:
            if left not in room:
                room[left] = []
                bisect.insort(rooms, left)
            room[left].append((first, many))

    for length, count in sorted(counts, reverse=True):
        rank = 0
        while rank < count:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                left = rooms[at]
                first, many = room[left].pop()
                if not room[left]:
                    del room[left], rooms[at]
            else:
                left, first, many = size, fresh, -(-(count - rank) // (size // length))
                fresh += many
            each, rest = left // length, count - rank
            whole = min(many, rest // each)
            offset = size - left
            if whole:
                runs.append((length, rank, whole * each, each, first, offset))
                add(left - each * length, first, whole)
                rank += whole * each
            if whole < many:
                some = min(each - 1, count - rank) if whole < many else 0
                if some and rank < count:
                    runs.append((length, rank, some, some, first + whole, offset))
                    add(left - some * length, first + whole, 1)
                    rank += some
                    whole += 1
                add(left, first + whole, many - whole)
    return runs


def pack(pieces: DataFrame, size: int = 2048, length: str = "length") -> DataFrame:
    """All columns of the pieces with sequence_id and offset.

    The pieces are staged, as they are counted first and placed then. A length
    that many pieces share is ranked in parts dealt by hash, whose sizes are summed
    before; no task gets all pieces of a length.
    """
    names = pieces.columns
    rows = stage(pieces.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("_row"), F.col(f"`{length}`").cast("long").alias("_length"))
                 .withColumn("_id", F.monotonically_increasing_id()), "pieces")
    counts = {r._length: r.n for r in rows.groupBy("_length").agg(F.count("*").alias("n")).collect()}
    if any(n is None or not 0 < n <= size for n in counts):
        raise ValueError(f"pieces need lengths from 1 to {size}")
    spark = pieces.sparkSession
    planned = plan(counts.items(), size)
    runs = spark.createDataFrame([(n, a, a + m, e, s, o) for n, a, m, e, s, o in planned],
                                 "r_length long, from_rank long, to_rank long, each long, first_sequence long, at long")
    parts = spark.createDataFrame([(n, -(-c // RANKED)) for n, c in counts.items()], "p_length long, parts long")
    dealt = (rows.join(F.broadcast(parts), F.col("_length") == F.col("p_length"))  # one row per length: at most `size`
             .withColumn("_part", F.pmod(F.xxhash64("_id"), F.col("parts"))).drop("p_length", "parts"))
    sizes = dealt.groupBy("_length", "_part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("_length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0).cast("long"))
    sizes = sizes.select(F.col("_length").alias("s_length"), F.col("_part").alias("s_part"), before.alias("before"))
    ranked = dealt.withColumn("_inside", F.row_number().over(Window.partitionBy("_length", "_part").orderBy("_id")) - 1)
    ranked = (ranked.join(sizes, (F.col("_length") == F.col("s_length")) & (F.col("_part") == F.col("s_part")))
              .withColumn("_rank", F.col("before") + F.col("_inside")))
    if len(planned) <= 16 * size:  # far more than plans have; a broadcast needs the bound
        runs = F.broadcast(runs)
    placed = ranked.join(runs, (F.col("_length") == F.col("r_length")) & (F.col("_rank") >= F.col("from_rank")) & (F.col("_rank") < F.col("to_rank")))
    nth = F.col("_rank") - F.col("from_rank")
    return placed.select(*[F.col("_row").getField(n).alias(n) for n in names],
                         (F.col("first_sequence") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
                         (F.col("at") + (nth % F.col("each")) * F.col("_length")).cast("long").alias("offset"))
