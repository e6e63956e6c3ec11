"""Token-id files written with the adaptive context-mixing range coder.

Documents are sorted by id over all partitions; each task encodes its documents
with the tokenizers library, appends the end id and codes the ids of many
documents together into one section of independently reset, checksummed blocks.
Sections are rows of a Parquet table in the given folder, with the number of
ids of each of their documents, so that Spark writes and reads them on any store.

Defined results. A missing text is empty and has the end id only. Documents are
in ascending order of doc_id, missing ids first, and of text where ids repeat. An empty
table makes an empty file table, which reads back as no rows. A damaged section
raises an error when it is read.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadkit.llm import range_coder
from loadkit.llm.shared import columns, slices
from loadkit.llm.unit_tokens import library_encoder

#: A section holds whole documents of at least so many ids together, or what is left.
SECTION = 4 << 20


def _sections(tokenizer_json: str, end_id: int, kind: pa.DataType):
    made = []

    def section(seq: int, docs: list, counts: list, parts: list) -> pa.RecordBatch:
        ids = np.concatenate(parts)
        entries = pa.StructArray.from_arrays([pa.concat_arrays(docs).cast(kind), pa.array(np.concatenate(counts), pa.int32())], ["doc", "n"])
        listed = pa.ListArray.from_arrays(pa.array([0, len(entries)], pa.int32()), entries)
        return pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(ids)], pa.int64()),
             listed, pa.array([range_coder.encode(ids)], pa.binary())], ["part", "seq", "n_ids", "docs", "data"])

    def run(batches):
        if not made:
            made.append(library_encoder(tokenizer_json))
        seq, held, docs, counts, parts = 0, 0, [], [], []
        for batch in batches:
            # Larger slices hold fewer distinct units a byte, and each of those is looked up once a slice.
            for some in slices(batch, 4 << 20):
                ids, at = made[0].ids(some.column("text"))
                full = np.full(len(ids) + some.num_rows, end_id, "<u2")
                full[np.arange(len(ids)) + np.repeat(np.arange(some.num_rows), np.diff(at))] = ids
                docs.append(some.column("doc")), counts.append(np.diff(at) + 1), parts.append(full)
                held += len(full)
                if held >= SECTION:
                    yield section(seq, docs, counts, parts)
                    seq, held, docs, counts, parts = seq + 1, 0, [], [], []
        if held:
            yield section(seq, docs, counts, parts)
    return run


def write(docs: DataFrame, path: str, tokenizer_json: str, end_id: int, doc: str = "doc_id", text: str = "text") -> None:
    """Write the ids of all documents to the folder `path`."""
    given = columns(docs, doc=doc, text=text)
    ordered = given.repartitionByRange(F.asc_nulls_first("doc")).sortWithinPartitions(F.asc_nulls_first("doc"), F.asc_nulls_first("text"))
    kind = given.schema["doc"].dataType
    out = ordered.mapInArrow(_sections(tokenizer_json, end_id, _arrow(kind)),
                             f"part int, seq int, n_ids long, docs array<struct<doc:{kind.simpleString()},n:int>>, data binary")
    out.write.parquet(path)


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, ids (32-bit little-endian integers).

    `start` is the number of ids of all documents before. One number per
    partition and section is summed up for it, not the documents.
    """
    files = spark.read.parquet(path)
    kind = files.schema["docs"].dataType.elementType["doc"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                ids = range_coder.decode(row.column("data")[0].as_py()).astype("<u4")
                entries = row.column("docs").flatten()
                count = entries.field(1).to_numpy().astype(np.int64)
                at = np.concatenate([[0], np.cumsum(count)])
                if at[-1] != len(ids):
                    raise ValueError("a section holds other documents than it names")
                same = lambda name: row.column(name).take(pa.array(np.zeros(len(count), np.int64)))
                for a in range(0, len(count), 4096):
                    some = slice(a, a + 4096)
                    raw = ids[at[some][0]:at[min(a + 4096, len(count))]]
                    bounds = pa.array(4 * (at[a:a + 4096 + 1] - at[a]), pa.int64())
                    packed = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, bounds.buffers()[1], pa.py_buffer(raw)])
                    yield pa.RecordBatch.from_arrays(
                        [same("part")[some], same("seq")[some], entries.field(0)[some], pa.array(at[:-1][some]), pa.array(count[some]),
                         packed.cast(pa.binary())], ["part", "seq", "doc_id", "inside", "n_tokens", "ids"])

    docs = files.select("part", "seq", "docs", "data").mapInArrow(
        run, f"part int, seq int, doc_id {kind}, inside long, n_tokens long, ids binary")
    return docs.join(_starts(files), ["part", "seq"]).select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids")


def _starts(files: DataFrame) -> DataFrame:
    """Ids before each section: within its partition, and of the partitions before, of which there is one row each."""
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(upto(Window.orderBy("part"))), zero).alias("parts_before"))
    inside = F.coalesce(F.sum("n_ids").over(upto(Window.partitionBy("part").orderBy("seq"))), zero)
    return (files.select("part", "seq", inside.alias("sections_before")).join(parts, "part")
            .select("part", "seq", (F.col("parts_before") + F.col("sections_before")).alias("before")))
