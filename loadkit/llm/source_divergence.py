"""How far the words of each source lie from those of the other sources and of its language, by chunk factorization.

White-space chunks are counted per document inside a slice of rows and summed
there by (language, source, chunk), with the number of documents and the least
and the greatest of their row numbers. They are dealt into buckets by the hash
of the chunk; in its bucket each globally distinct chunk is cut into terms once,
and its terms are joined back to all its counts. A second dealing, by the hash
of the term, gives the occurrences of a term by language and source. Documents
are not summed over chunks, as one may hold a term in several of them: of a
chunk in one or two documents both row numbers are known, so a source holds a
term in three documents or more if a chunk is in three, or if a row number lies
strictly between the least and the greatest of the source.

Most chunks are rare, so a Spark row for each would cost more than all else. A
row is what a slice or a bucket gives to one bucket: a compressed table of
counts. The number of buckets grows with the bytes of text, so that a bucket
stays of one size; buckets of a task are worked on one after the other, and the
tables of a bucket are merged as they come.

Shares are whole numbers of a billion, with one added to each count. The pairs
of sources of a language are computed in tiles: some terms of the language
against two blocks of sources, as dense arrays; a tile gives one partial sum per
pair, however many terms it has, and terms that neither block holds are added
as one product at the end. Rows leave a tile once per pair of sources, which is
the size of the result.

Defined results. Missing text, language and source are empty. Documents are
rows: rows that repeat are documents of their own. A text without white space
is one chunk. A language without kept terms has pairs of value 0 and no terms.
Empty tables give no rows. Other columns of the input play no part.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadkit.llm import textarrays as X
from loadkit.llm.shared import columns, give_back, slices, stage

WHOLE = 1_000_000_000
PACKED = "bucket int, counts binary"
CELLS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("count", pa.int64()), ("total", pa.int64())])
_INSIDE = np.ones(256, bool)
_INSIDE[[*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
PAIRS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64()), ("present", pa.int64()),
                   ("own", pa.int64()), ("other", pa.int64()), ("v", pa.int64())])
PAIRS_DDL = "lang string, source string, item string, value long, present long, own long, other long, v long"


@dataclass(frozen=True)
class Settings:
    #: Documents of a language that must hold a term; from 1 to 3, as two row numbers of each chunk are kept.
    least_docs: int = 3
    #: Ranks of the part `term`.
    ranks: int = 200
    #: Bytes of text counted at once, and bytes of text for each bucket.
    slice: int = 6 << 20
    bucket: int = 8 << 20
    #: Sources of a block and terms of a tile.
    block: int = 64
    terms: int = 16_384
    #: Rows of a looked-up table that may be broadcast.
    few: int = 100_000


class Counts:
    """Counts of texts (chunks, then terms) by language and source, as columns of numpy arrays."""

    def __init__(self, text: pa.Array, group: np.ndarray, groups: list[tuple[str, str]], numbers: list[np.ndarray]):
        """`numbers`: occurrences, documents, least and greatest row number, and one between them (else the least)."""
        self.text, self.group, self.groups, self.numbers = text, group, groups, numbers

    def packed(self, buckets: int) -> pa.RecordBatch:
        """One row per bucket: its rows as a compressed table."""
        bucket = bucket_of(self.text, buckets)
        order = np.argsort(bucket, kind="stable")
        text = self.text.take(pa.array(order)).cast(pa.large_binary())
        number = np.array([*self.group[None, :], *self.numbers])[:, order]
        ends = np.searchsorted(bucket[order], np.arange(buckets), side="right")
        held, blobs, at = [], [], 0
        names = pa.array([list(g) for g in self.groups], pa.list_(pa.string()))
        for b in np.flatnonzero(np.diff(ends, prepend=0)):
            part = pa.table([text.slice(at, ends[b] - at), *[pa.array(n[at:ends[b]]) for n in number]], names=["text", "group", "n", "df", "low", "high", "mid"])
            used, here = np.unique(number[0][at:ends[b]], return_inverse=True)
            part = part.set_column(1, "group", pa.array(here)).replace_schema_metadata({"groups": json.dumps(names.take(pa.array(used)).to_pylist())})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(part)
            held.append(b), blobs.append(sink.getvalue().to_pybytes())
            at = ends[b]
        return pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "counts"])


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary array together, and where each text begins."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8)[at[0]:at[-1]] if at[-1] > at[0] else np.zeros(0, np.uint8)), at - at[0]


def bucket_of(texts: pa.Array, buckets: int) -> np.ndarray:
    """A bucket for each text, the same in every task."""
    data, at = raw(texts)
    size = np.diff(at)
    place = np.arange(len(data)) - np.repeat(at[:-1], size)
    with np.errstate(over="ignore"):
        mixed = (data.astype(np.uint64) + np.uint64(1)) * _POWERS[place & 255] ^ (place >> 8).astype(np.uint64)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
        code = (total[at[1:]] - total[at[:-1]]) * np.uint64(0x9E3779B97F4A7C15)
    return ((code >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


_POWERS = np.cumprod(np.full(256, 0x100000001B3, np.uint64), dtype=np.uint64)


def unpacked(blob: bytes) -> Counts:
    table = pa.ipc.open_stream(blob).read_all().combine_chunks()
    text, *number = (c.chunk(0) if c.num_chunks else c.combine_chunks() for c in table.columns)
    group, *counts = (n.to_numpy(zero_copy_only=False).astype(np.int64) for n in number)
    return Counts(text, group, [tuple(g) for g in json.loads(table.schema.metadata[b"groups"])], counts)


def joined(parts: list[Counts]) -> Counts:
    """Several tables one after the other."""
    groups = {g: k for k, g in enumerate(dict.fromkeys(g for p in parts for g in p.groups))}
    group = [np.array([groups[g] for g in p.groups], np.int64)[p.group] for p in parts]
    return Counts(pa.concat_arrays([p.text for p in parts]), np.concatenate(group), list(groups),
                  [np.concatenate(n) for n in zip(*[p.numbers for p in parts])])


def _runs(key: np.ndarray) -> np.ndarray:
    """Where equal values of a sorted array begin."""
    return np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)


def merged(counts: Counts, documents: np.ufunc = np.add) -> Counts:
    """Rows of one text and group as one; texts in order of their first row.

    Documents add up over the counts of one chunk. Over several chunks of one
    term the most of them is what is sure (`documents` is np.maximum then), and
    the three row numbers tell whether there are two or more than two.
    """
    code, distinct = X.codes(counts.text)
    key = code * max(len(counts.groups), 1) + counts.group
    order = np.argsort(key, kind="stable")
    key, (n, df, low, high, mid) = key[order], [x[order] for x in counts.numbers]
    first = _runs(key)
    if not len(first):
        return counts
    least, last = np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)
    run = np.repeat(np.arange(len(first)), np.diff(np.concatenate([first, [len(key)]])))
    between = np.zeros(len(first), np.int64) - 1
    for seen in (low, mid, high):
        inside = (seen > least[run]) & (seen < last[run])
        between = np.maximum(between, np.maximum.reduceat(np.where(inside, seen, -1), first))
    text, group = np.divmod(key[first], max(len(counts.groups), 1))
    return Counts(distinct.take(pa.array(text)), group, counts.groups,
                  [np.add.reduceat(n, first), documents.reduceat(df, first), least, last, np.where(between < 0, least, between)])


def count_slice(batch: pa.RecordBatch) -> Counts:
    """Chunks of a slice of rows (row, lang, source, text), summed by language, source and chunk."""
    row = batch["row"].to_numpy(zero_copy_only=False).astype(np.int64)
    groups: dict[tuple[str, str], int] = {}
    group = np.array([groups.setdefault(g, len(groups)) for g in zip(batch["lang"].to_pylist(), batch["source"].to_pylist())], np.int64)
    data, offsets = X.flat(batch["text"])
    words, docs = X.Words(data, offsets), len(row)
    code, distinct = X.codes(words.array())
    key = np.sort(code * docs + np.repeat(np.arange(docs), np.diff(words.first)))
    at = _runs(key)
    times = np.diff(np.concatenate([at, [len(key)]]))
    code, doc = np.divmod(key[at], max(docs, 1))
    row_of = row[doc]
    return merged(Counts(distinct.take(pa.array(code)), group[doc], list(groups), [times, np.ones_like(times), row_of, row_of, row_of]))


def terms_of(chunks: Counts) -> Counts:
    """Counts of terms from those of chunks: each distinct chunk is cut once, its terms go back to all its rows.

    A chunk that holds a term twice gives two rows for it.
    """
    code, distinct = X.codes(chunks.text)
    data, offsets = raw(distinct)
    inside = _INSIDE[data]
    start, end = X.spans(inside, offsets)
    terms = X.strings(_LOWER[data[inside]], end - start)
    first = np.searchsorted(start, offsets)
    count = np.diff(first)[code] if len(code) else np.zeros(0, np.int64)
    upto = np.cumsum(count)
    which = np.repeat(first[:-1][code] - (upto - count), count) + np.arange(upto[-1] if len(upto) else 0)
    row = np.repeat(np.arange(len(code)), count)
    return Counts(terms.take(pa.array(which)), chunks.group[row], chunks.groups, [n[row] for n in chunks.numbers])


def kept(terms: Counts, least: int) -> pa.RecordBatch:
    """Cells (lang, source, term, count, total) of terms that enough documents of the language hold; `terms` has a row per term and group."""
    langs = {lang: k for k, lang in enumerate(dict.fromkeys(lang for lang, _ in terms.groups))}
    lang_of = np.array([langs[lang] for lang, _ in terms.groups], np.int64)
    code, distinct = X.codes(terms.text)
    by = code * max(len(langs), 1) + (lang_of[terms.group] if len(code) else code)
    order = np.argsort(by, kind="stable")
    count, df, low, high, mid = (x[order] for x in terms.numbers)
    docs = np.maximum(np.minimum(df, 3), np.where((mid > low) & (mid < high), 3, np.where(low < high, 2, 1)))
    first = _runs(by[order])
    if not len(first):
        return pa.RecordBatch.from_pylist([], CELLS)
    run = np.repeat(np.arange(len(first)), np.diff(np.concatenate([first, [len(order)]])))
    enough = (np.add.reduceat(docs, first) >= least)[run]
    total = np.add.reduceat(count, first)[run]
    names = [terms.groups[g] for g in terms.group[order][enough]]
    text = distinct.take(pa.array(code[order][enough])).cast(pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([pa.array([g[0] for g in names], pa.string()), pa.array([g[1] for g in names], pa.string()), text,
                                       pa.array(count[enough]), pa.array(total[enough])], schema=CELLS)


def each_bucket(batches: Iterator[pa.RecordBatch], documents: np.ufunc, most: int = 500_000) -> Iterator[Counts]:
    """The counts of one bucket after the other, from rows in order of their bucket; tables are merged as they come."""
    now, held, rows = None, [], 0
    for batch in batches:
        for bucket, blob in zip(batch["bucket"].to_pylist(), batch["counts"]):
            if held and bucket != now:
                yield merged(joined(held), documents)
                held, rows = [], 0
            now = bucket
            held.append(unpacked(blob.as_py()))
            rows += len(held[-1].group)
            if rows > most and len(held) > 1:
                held = [merged(joined(held), documents)]
                # What is left is distinct, so the next merging waits for about as much again.
                rows = min(len(held[0].group), most // 2)
    if held:
        yield merged(joined(held), documents)


def buckets_for(docs: DataFrame, size: int) -> int:
    """Buckets of about `size` bytes of text each."""
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(-(-total // size), 1)


def chunk_counts(docs: DataFrame, buckets: int, settings: Settings = Settings()) -> DataFrame:
    """Counts of chunks by language and source, one row per slice and bucket."""
    size = settings.slice

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, size):
                yield count_slice(part).packed(buckets)
                give_back()

    given = docs.select(F.monotonically_increasing_id().alias("row"), "lang", "source", "text")
    return given.mapInArrow(count, PACKED)


def by_bucket(counts: DataFrame, buckets: int) -> DataFrame:
    """Every bucket whole in one task; the tasks are the session's shuffle partitions, or more if those got over 16 buckets each."""
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return counts.repartition(max(min(tasks, 4 * buckets), buckets // 16), "bucket").sortWithinPartitions("bucket")


def kept_cells(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Occurrences by language, source and term, for terms that enough documents of the language hold; `total` is the language's."""
    buckets, least = buckets_for(docs, settings.bucket), settings.least_docs

    def to_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunks in each_bucket(batches, np.add):
            yield merged(terms_of(chunks), np.maximum).packed(buckets)
            give_back()

    def to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for terms in each_bucket(batches, np.maximum):
            yield kept(terms, least)
            give_back()

    terms = by_bucket(chunk_counts(docs, buckets, settings), buckets).mapInArrow(to_terms, PACKED)
    return stage(by_bucket(terms, buckets).mapInArrow(to_cells, "lang string, source string, term string, count long, total long"), "kept-cells")


def share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(WHOLE * (count + 1) / (n + v)); missing if there is nothing to divide by."""
    raised = (count + 1).cast("decimal(20,0)") * F.lit(WHOLE).cast("decimal(10,0)")
    return F.call_function("div", raised, F.nullif(n + v, F.lit(0).cast("long")).cast("decimal(20,0)")) + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def small(df: DataFrame, few: int) -> DataFrame:
    """A staged table, to be broadcast if it is counted to be small."""
    return F.broadcast(df) if df.count() <= few else df


def tile(rows: pa.Table) -> pa.Table:
    """Partial sums of all ordered pairs of the sources of two blocks, over the terms that either block holds here.

    Rows without a term name the sources, with the share of a count of 0.
    """
    rows = rows.combine_chunks()
    block, spot = (rows[c].to_numpy() for c in ("block", "place"))
    zero, named = rows["zero"].to_numpy(), ~rows["term"].is_valid().to_numpy()
    term, distinct = X.codes(rows["term"].filter(pa.array(~named)).combine_chunks())
    names, values = rows["source"].to_pylist(), rows["p"].fill_null(0).to_numpy()[~named]
    at, from_block, in_block, sides = np.flatnonzero(~named), block[~named], spot[~named], {}
    for b in np.unique(block):
        mine = np.flatnonzero(named & (block == b))
        mine = mine[np.argsort(spot[mine])]
        dense = np.repeat(zero[mine][None, :], len(distinct), axis=0)
        here = from_block == b
        dense[term[here], np.searchsorted(spot[mine], in_block[here])] = values[here]
        sides[b] = [names[i] for i in mine], zero[mine], dense
    lang, v = rows["lang"][0].as_py(), rows["v"][0].as_py()
    out = [[], [], [], [], []]
    low, high = sides[min(sides)], sides[max(sides)]
    for i, own in enumerate(low[0]):
        p, others = low[2][:, i:i + 1], high[2]
        square = (p - others) ** 2 if v else others[:0]
        forth = (square // others).sum(axis=0) if v else np.zeros(len(high[0]), np.int64)
        back = (square // p).sum(axis=0) if v else forth
        # Within one block the loop itself meets each pair in both orders.
        for j, other in enumerate(high[0]):
            if len(sides) == 2 or i != j:
                for part, value in zip(out, (own, other, forth[j], low[1][i], high[1][j])):
                    part.append(value)
            if len(sides) == 2:
                for part, value in zip(out, (other, own, back[j], high[1][j], low[1][i])):
                    part.append(value)
    size = len(out[0])
    return pa.table([pa.array([lang] * size, pa.string()), pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64()),
                     pa.array([len(distinct)] * size, pa.int64()), pa.array(out[3], pa.int64()), pa.array(out[4], pa.int64()),
                     pa.array([v] * size, pa.int64())], schema=PAIRS)


def _dealt(rows: DataFrame) -> DataFrame:
    """A row once for each pair of blocks that its own block is in."""
    own, j = F.col("block"), F.col("with")
    every = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return every.withColumns({"lo": F.least(own, j), "hi": F.greatest(own, j)}).drop("with", "blocks")


def source_pairs(cells: DataFrame, groups: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Value of each ordered pair of sources of a language.

    `cells`: lang, source, term, p. `groups`: lang, source, n, v, zero (the share of a count of 0).
    """
    by_lang = Window.partitionBy("lang")
    sized = groups.select("lang", "source", "v", F.coalesce("zero", F.lit(0).cast("long")).alias("zero"),
                          (F.row_number().over(by_lang.orderBy("source")) - 1).alias("number"), F.count("*").over(by_lang).alias("sources"))
    placed = stage(sized.where("sources > 1").select(
        "lang", "source", "v", "zero", (F.col("number") % settings.block).alias("place"), F.floor(F.col("number") / settings.block).cast("int").alias("block"),
        F.ceil(F.col("sources") / settings.block).cast("int").alias("blocks"),
        F.greatest(F.ceil(F.col("v") / settings.terms), F.lit(1)).cast("int").alias("parts")), "placed")
    shape = ["lang", "source", "v", "zero", "place", "block", "term", "p", "part", "blocks"]
    held = cells.join(small(placed, settings.few), ["lang", "source"]).withColumn("part", F.pmod(F.xxhash64("term"), F.col("parts")).cast("int"))
    marks = placed.withColumns({"term": F.lit(None).cast("string"), "p": F.lit(None).cast("long"),
                                "part": F.explode(F.sequence(F.lit(0), F.col("parts") - 1))})
    dealt = _dealt(held.select(*shape).unionByName(marks.select(*shape)))
    partial = dealt.groupBy("lang", "part", "lo", "hi").applyInArrow(tile, PAIRS_DDL)
    whole = partial.groupBy("lang", "source", "item", "own", "other", "v").agg(F.sum("value").alias("value"), F.sum("present").alias("present"))
    unseen = F.when(F.col("v") > 0, (F.col("v") - F.col("present")) * divergence(F.col("own"), F.nullif(F.col("other"), F.lit(0).cast("long")))).otherwise(0)
    return whole.select("lang", "source", "item", (F.col("value") + unseen).alias("value"))


def audit(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Parts `pair` and `term` of every source: lang, source, part, item, value, rank."""
    if not 1 <= settings.least_docs <= 3:
        raise ValueError("least_docs must be from 1 to 3")
    texts = columns(docs, lang="lang", source="source", text="text").select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    held = kept_cells(texts, settings)
    by_lang = held.groupBy("lang", "term").agg(F.max("total").alias("total")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("n_lang"))
    langs = stage(by_lang, "langs")
    none = F.lit(0).cast("long")
    sums = held.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = texts.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(small(langs, settings.few), "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("n", none).alias("n"), F.coalesce("v", none).alias("v"), F.coalesce("n_lang", none).alias("n_lang"))
    groups = stage(groups.withColumn("zero", share(none, F.col("n"), F.col("v"))), "groups")
    shared = held.join(small(groups, settings.few), ["lang", "source"]).withColumns({
        "p": share(F.col("count"), F.col("n"), F.col("v")), "q": share(F.col("total"), F.col("n_lang"), F.col("v"))})
    pairs = source_pairs(shared.select("lang", "source", "term", "p"), groups.select("lang", "source", "v", "zero"), settings)
    terms = shared.where(F.col("p") > F.col("q")).select("lang", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    first = terms.withColumn("rank", rank).where(F.col("rank") <= settings.ranks)
    return (pairs.withColumn("rank", rank).withColumn("part", F.lit("pair")).unionByName(first.withColumn("part", F.lit("term")))
            .select("lang", "source", "part", "item", "value", "rank"))
