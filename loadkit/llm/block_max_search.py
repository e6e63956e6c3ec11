"""Ranked lexical search: inverted lists in blocks, Block-Max MaxScore per segment, lists of the segments merged.

`build` cuts the documents into segments of a few MB of text and writes, for
each segment and term, its postings in blocks of 128: gaps and occurrences as
variable-length bytes, each block readable alone. Beside a block stand its last
document and its best pairs (occurrences, length of the document): no posting
of the block has both more occurrences and a shorter document than one of them.
The greatest weight within a block follows exactly from these, whatever the
statistics of the corpus turn out to be.

`search` takes the queries in blocks of a bounded number of terms. The index
rows of these terms go to the task of their segment. For each query the lists
are ordered by the bound of a whole list. Lists are read entirely while the
bounds of those left over could still lift a new document to the k-th score
found so far (essential lists). Over the lists that remain, a document found
before is first held against the greatest weight of its block, and only blocks
of documents that could still get there are unpacked. The k best of a segment
go to the merge, which keeps k per task before it shuffles.

Defined results. A missing text has no terms. A document is a row: rows that
repeat a doc_id are ranked each; a missing doc_id comes first among equal
scores. Rows of queries that share an item_id are one query with the terms of
all. Queries without terms and empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadkit.llm import textarrays as X
from loadkit.llm.shared import columns, slices, stage

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK = 128

_INSIDE = np.ones(256, bool)
_INSIDE[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

INDEX = pa.schema([("segment", pa.int64()), ("term", pa.string()), ("df", pa.int32()), ("ends", pa.list_(pa.int32())),
                   ("lasts", pa.list_(pa.int32())), ("tops", pa.list_(pa.int32())), ("top_ends", pa.list_(pa.int32())), ("data", pa.binary()),
                   ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32()))])
INDEX_DDL = ("segment long, term string, df int, ends array<int>, lasts array<int>, tops array<int>, top_ends array<int>, data binary, "
             "doc_ids array<long>, lengths array<int>")
FOUND = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


@dataclass(frozen=True)
class Settings:
    k: int = 10
    #: Bytes of text in a segment; a longer document is one alone.
    segment: int = 16 << 20
    #: (query, term) pairs that are searched for in one pass.
    pairs: int = 200_000


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as bytes of seven bits, the last of each marked; and the bytes of each."""
    size = np.ones(len(values), np.int64)
    for bits in (7, 14, 21, 28):
        size += values >= 1 << bits
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(5):
        has = np.flatnonzero(size > k)
        byte = (values[has] >> (7 * k)) & 0x7F
        out[ends[has] - size[has] + k] = byte | np.where(size[has] == k + 1, 0x80, 0)
    return out, size


def unpacked(data: np.ndarray) -> np.ndarray:
    """The numbers of `packed`."""
    last = np.flatnonzero(data & 0x80)
    start = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    size, out = last - start + 1, np.zeros(len(last), np.int64)
    for k in range(int(size.max()) if len(size) else 0):
        has = size > k
        out[has] |= (data[start[has] + k].astype(np.int64) & 0x7F) << (7 * k)
    return out


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.astype(np.int32)))


def segment_rows(number: int, ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """One row per term of the segment, and one without a term that holds the documents."""
    data, offsets = X.flat(texts)
    docs = len(offsets) - 1
    inside = _INSIDE[data]
    start, end = X.spans(inside, offsets)
    lengths = np.diff(np.searchsorted(start, offsets))
    code, distinct = X.codes(X.strings(_LOWER[data[inside]], end - start))
    key = np.sort(code * docs + np.repeat(np.arange(docs), lengths))
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    tf = np.diff(np.concatenate([at, [len(key)]]))
    code, doc = np.divmod(key[at], max(docs, 1))
    terms, postings = len(distinct), len(at)
    first = np.searchsorted(code, np.arange(terms + 1))

    rank = np.arange(postings) - first[code]
    opens = rank % BLOCK == 0
    block_of = np.cumsum(opens) - 1
    block_at = np.flatnonzero(opens)
    block_end = np.concatenate([block_at[1:], [postings]]) if postings else block_at
    blocks_before = np.searchsorted(code[block_at], np.arange(terms + 1))

    gap = doc - np.where(opens, 0, np.concatenate([[0], doc[:-1]])) if postings else doc
    pairs = np.empty(2 * postings, np.int64)
    pairs[0::2], pairs[1::2] = gap, tf
    raw, size = packed(pairs)
    upto = np.concatenate([[0], np.cumsum(size)])
    list_at = upto[2 * first]

    # Best pairs of each block: by length, a posting counts if it has more occurrences than all shorter documents.
    order = np.lexsort((-tf, lengths[doc], block_of))
    high = tf[order] + block_of[order] * (int(tf.max()) + 1) if postings else tf
    best = order[np.concatenate([[True], high[1:] > np.maximum.accumulate(high)[:-1]])] if postings else order
    tops = np.empty(2 * len(best), np.int64)
    tops[0::2], tops[1::2] = tf[best], lengths[doc[best]]
    top_upto = np.searchsorted(block_of[best], np.arange(len(block_at) + 1))
    of_block = np.repeat(np.arange(terms), np.diff(blocks_before))
    binary = pa.Array.from_buffers(pa.binary(), terms, [None, pa.py_buffer(list_at.astype(np.int32)), pa.py_buffer(raw)])
    rows = [pa.array(np.full(terms, number)), distinct.cast(pa.binary()).cast(pa.string()), pa.array(np.diff(first).astype(np.int32)),
            _lists(upto[2 * block_end] - list_at[of_block], blocks_before), _lists(doc[block_end - 1], blocks_before),
            _lists(tops, 2 * top_upto[blocks_before]), _lists(top_upto[1:] - top_upto[blocks_before[of_block]], blocks_before), binary,
            pa.nulls(terms, pa.list_(pa.int64())), pa.nulls(terms, pa.list_(pa.int32()))]
    of_docs = pa.RecordBatch.from_pylist([{"segment": number, "doc_ids": [], "lengths": []}], INDEX)
    held = [*of_docs.columns[:8], pa.ListArray.from_arrays(pa.array([0, docs], pa.int32()), ids.cast(pa.int64())),
            _lists(lengths, np.array([0, docs]))]
    return pa.Table.from_batches([pa.RecordBatch.from_arrays(rows, schema=INDEX), pa.RecordBatch.from_arrays(held, schema=INDEX)])


def build(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The index of all documents, staged in the shared folder."""
    size = settings.segment

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, so_far = TaskContext.get().partitionId() << 32, [], 0

        def done():
            whole = pa.Table.from_batches(held).combine_chunks()
            ids, texts = (c.chunk(0) for c in whole.columns)
            return segment_rows(number, ids, texts).to_batches()

        for batch in batches:
            for part in slices(batch, size):
                if held and so_far + part.nbytes > size:
                    yield from done()
                    number, held, so_far = number + 1, [], 0
                held.append(part)
                so_far += part.nbytes
        if held:
            yield from done()

    given = docs.select(F.col("`doc_id`").cast("long").alias("doc_id"), F.col("`text`").cast("string").alias("text"))
    return stage(given.mapInArrow(index, INDEX_DDL), "search-index")


@dataclass(frozen=True)
class Corpus:
    """Documents with a term, and all their terms."""

    documents: int
    terms: int

    def gains(self, tf: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """What a weight is multiplied with, for so many occurrences in documents of these lengths; whole numbers, rounded down."""
        factor = 90 * self.documents
        if factor * int(lengths.max(initial=0)) < 1 << 63:
            share = factor * lengths // max(self.terms, 1)
        else:
            share = np.array([factor * int(n) // self.terms for n in lengths], np.int64)
        return 1_000_000_000 * tf // (1000 * tf + 8 * (10 + share))


class List:
    """The postings of a term in a segment."""

    def __init__(self, row: dict, lengths: np.ndarray, corpus: Corpus):
        self.ends, self.lasts, self.data = row["ends"], row["lasts"], row["data"]
        self.lengths, self.corpus, self.whole, self.read = lengths, corpus, None, {}
        gains = corpus.gains(row["tops"][0::2], row["tops"][1::2])
        self.most = np.maximum.reduceat(gains, np.concatenate([[0], row["top_ends"][:-1]]))
        self.best = int(self.most.max())

    def _unpack(self, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        start = self.ends[begin - 1] if begin else 0
        pairs = unpacked(self.data[start:self.ends[end - 1]])
        gap, tf = pairs[0::2], pairs[1::2]
        doc = np.cumsum(gap)
        # A block begins anew from document 0.
        opens = np.arange(0, len(gap), BLOCK)
        before = np.where(opens > 0, doc[opens - 1], 0)
        doc -= np.repeat(before, np.diff(np.concatenate([opens, [len(gap)]])))
        return doc, self.corpus.gains(tf, self.lengths[doc])

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        if self.whole is None:
            self.whole = self._unpack(0, len(self.ends))
        return self.whole

    def of(self, docs: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Gains of documents, each in the block that can hold it; only these blocks are unpacked."""
        out = np.zeros(len(docs), np.int64)
        for b in np.unique(blocks):
            if self.whole is not None:
                held, gains = (part[b * BLOCK:(b + 1) * BLOCK] for part in self.whole)
            else:
                if b not in self.read:
                    self.read[b] = self._unpack(b, b + 1)
                held, gains = self.read[b]
            mine = np.flatnonzero(blocks == b)
            at = np.searchsorted(held, docs[mine])
            same = held[np.minimum(at, len(held) - 1)] == docs[mine]
            out[mine] = np.where(same, gains[np.minimum(at, len(held) - 1)], 0)
        return out


def kth(scores: np.ndarray, k: int) -> int:
    """The k-th greatest score, or 1 if fewer are above 0, so that documents without a score stay out."""
    return max(int(np.partition(scores, len(scores) - k)[len(scores) - k]), 1) if len(scores) >= k else 1


def best(lists: list[tuple[int, List]], docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents, with scores, among which are all of the k best and all that tie with the k-th."""
    lists = sorted(((w, one) for w, one in lists if w * one.best > 0), key=lambda p: -p[0] * p[1].best)
    left = np.concatenate([np.cumsum([w * one.best for w, one in lists][::-1])[::-1], [0]]).astype(np.int64)
    score, limit, i = np.zeros(docs, np.int64), 1, 0
    while i < len(lists) and left[i] >= limit:
        weight, one = lists[i]
        at, gains = one.all()
        score[at] += weight * gains
        limit, i = kth(score, k), i + 1
    some = np.flatnonzero(score + left[i] >= limit)
    some = some[score[some] > 0]
    for j in range(i, len(lists)):
        weight, one = lists[j]
        block = np.searchsorted(one.lasts, some)
        inside = block < len(one.lasts)
        most = np.where(inside, one.most[np.minimum(block, len(one.lasts) - 1)], 0)
        stays = score[some] + weight * most + left[j + 1] >= limit
        some, block, inside = some[stays], block[stays], inside[stays]
        score[some[inside]] += weight * one.of(some[inside], block[inside])
        limit = max(limit, kth(score[some], k))
        some = some[score[some] + left[j + 1] >= limit]
    return some, score[some]


def _numbers(value) -> np.ndarray:
    return value.values.to_numpy(zero_copy_only=False).astype(np.int64)


def search_segment(rows: pa.Table, queries: list[list[tuple[str, int]]], corpus: Corpus, k: int) -> pa.Table:
    """The k best documents of a segment for each query; ties beyond the k-th are left to the smaller doc_id."""
    rows = rows.combine_chunks()
    names = rows["term"].to_pylist()
    here = names.index(None)
    ids = rows["doc_ids"][here].values
    lengths, lists = _numbers(rows["lengths"][here]), {}
    for i, name in enumerate(names):
        if name is not None:
            row = {c: _numbers(rows[c][i]) for c in ("ends", "lasts", "tops", "top_ends")}
            lists[name] = List(row | {"data": np.frombuffer(rows["data"][i].as_buffer(), np.uint8)}, lengths, corpus)
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    number = ids.fill_null(0).to_numpy(zero_copy_only=False)
    items, docs, scores = [], [], []
    for item, terms in enumerate(queries):
        present = [(w, lists[t]) for t, w in terms if t in lists]
        if not present:
            continue
        some, score = best(present, len(lengths), k)
        order = np.lexsort((number[some], known[some], -score))[:k]
        items.append(np.full(len(order), item)), docs.append(some[order]), scores.append(score[order])
    if not items:
        return FOUND.empty_table()
    at = np.concatenate(docs)
    return pa.table([pa.array(np.concatenate(items).astype(np.int32)), ids.take(pa.array(at)), pa.array(np.concatenate(scores))], schema=FOUND)


def terms_of(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), 0))


def _pass(index: DataFrame, wanted: DataFrame, corpus: Corpus, k: int) -> DataFrame:
    """Lists of all segments for a bounded number of queries, given as (item, term)."""
    rows = wanted.collect()
    spark, names = index.sparkSession, sorted({r.term for r in rows})
    terms = F.broadcast(spark.createDataFrame([(t,) for t in names], "term string"))
    held = dict(index.join(terms, "term").groupBy("term").agg(F.sum("df")).collect())
    weight = {t: math.floor(1000 * math.log((2 * corpus.documents + 2) / (2 * df + 1))) for t, df in held.items()}
    items = sorted({r["item"] for r in rows}, key=lambda i: (i is not None, i))
    place = {item: n for n, item in enumerate(items)}
    queries = [[] for _ in items]
    for r in rows:
        if r.term in weight:
            queries[place[r["item"]]].append((r.term, weight[r.term]))
    given = index.join(terms, "term", "left_semi").unionByName(index.where("term IS NULL"))
    found = given.groupBy("segment").applyInArrow(lambda t: search_segment(t, queries, corpus, k), "item int, doc_id long, score long")
    numbered = F.broadcast(spark.createDataFrame(list(enumerate(items)), "item int, item_id long"))
    first = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first())
    top = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return top.join(numbered, "item").select("item_id", "rank", "doc_id", "score")


def search(index: DataFrame, queries: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The k best documents of each query, by rank."""
    asked = (columns(queries, item="item_id", text="text").select(F.col("item").cast("long").alias("item"), F.explode(terms_of(F.col("text"))).alias("term"))
             .distinct())
    asked = stage(asked, "search-terms")
    passes = -(-asked.count() // settings.pairs)
    whole = (index.where("term IS NULL").select(F.explode("lengths").alias("n")).where("n > 0")
             .agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first())
    corpus = Corpus(int(whole.documents), int(whole.terms))
    if not passes:
        return index.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    dealt = asked.withColumn("pass", F.pmod(F.xxhash64("item"), F.lit(passes)))
    return reduce(DataFrame.unionAll, [_pass(index, dealt.where(F.col("pass") == p), corpus, settings.k) for p in range(passes)])
