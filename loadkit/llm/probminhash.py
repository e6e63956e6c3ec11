"""Near duplicates by ProbMinHash.

A text is the multiset of its five-word shingles. The similarity of two texts
is the probability Jaccard similarity of their shingle counts: for counts of
one it is the usual Jaccard similarity. Each shingle is a Poisson process whose rate is
its count; every arrival falls on one of the registers, and a register keeps the
shingle of its first arrival. Two texts agree on a register with the probability of
their similarity. A process ends as soon as its next arrival is later than all registers' first ones.

Registers are banded; texts that agree on a band are candidates. Exact copies
(of the word sequence) are one node before that. Candidates are verified on
their shingles, in rounds that never list all pairs of a bucket:

1. every node against its bucket's best connected node;
2. in buckets whose nodes are still in different classes, every node against
   the node of another class that agrees most with it in its tile;
3. the nodes of which that left pairs out meet again with their texts, bucket by bucket and tile by tile.
   All those pairs that are in different classes still and whose registers do not rule the similarity
   out are verified there, and only links that connect what was apart in the tile leave it.

So every candidate pair is verified, ruled out by its registers, or already in one class.

Defined results. Words are split at ASCII white space and compared in lower
case. A text of one to four words is one shingle. A missing or wordless text is a class of its own.
A class keeps its row of the smallest doc_id, missing ids last. Rows that repeat a doc_id are rows of
their own; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkit.llm import textarrays as X
from loadkit.llm.components import components
from loadkit.llm.shared import columns, map_batches, passing, schema, stage

U64 = np.uint64


@dataclass(frozen=True)
class Settings:
    """Pairs at `limit` or above are linked. `bands` of `rows` registers find a pair of
    similarity s with probability 1 - (1 - s^rows)^bands: 0.999997 at 0.8. Registers rule a
    pair out when their agreement is `slack` below the limit, four standard deviations."""

    limit: float = 0.8
    words: int = 5
    bands: int = 42
    rows: int = 6  # at most six: a band's key holds a byte of each
    slack: float = 0.1
    best: int = 1
    tile: int = 512
    tile_bytes: int = 4 << 20  # of text in half a tile; a longer text fills one alone


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the finaliser of SplitMix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _lowered(column: pa.Array) -> pa.Array:
    return pa.array([None if v is None else v.lower() for v in column.to_pylist()], pa.string())


class Shingles:
    """Distinct shingles of a batch of texts: `text`, `hash` and `count` of each, in order of texts."""

    def __init__(self, column: pa.Array, size: int):
        data, offsets = X.flat(_lowered(column))
        self.texts = len(offsets) - 1
        words = X.Words(data, offsets)
        code, distinct = X.codes(words.array())
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in X.as_list(distinct)] or [0], U64)
        self.words, self.first = hashes[code], words.first
        self.n_words = np.diff(words.first)
        begin = X.windows(words.first, size)
        text = np.repeat(np.arange(self.texts), self.n_words)
        short = np.flatnonzero((self.n_words > 0) & (self.n_words < size))
        made = self._combined(begin, size)
        for length in range(1, size):
            some = short[self.n_words[short] == length]
            made = np.concatenate([made, self._combined(words.first[some], length)])
            begin = np.concatenate([begin, words.first[some]])
        owner = text[begin]
        order = np.argsort(owner, kind="stable")
        owner, made = owner[order], made[order]
        same, _ = X.codes((made ^ mix(owner.astype(U64) + U64(1))).view(np.int64))
        new = np.ones(len(same), bool)
        new[1:] = np.diff(np.maximum.accumulate(same)) > 0
        self.text, self.hash = owner[new], made[new]
        self.count = np.bincount(same, minlength=len(self.text)) if len(same) else np.zeros(0, np.int64)

    def _combined(self, begin: np.ndarray, size: int) -> np.ndarray:
        out = np.full(len(begin), size, U64)
        for k in range(size):
            out = out * U64(0x9E3779B97F4A7C15) + self.words[begin + k]
        return mix(out)

    def sequence_keys(self) -> list[bytes | None]:
        """128-bit keys of the word sequences; none for a text without words."""
        raw, at = self.words.tobytes(), (8 * self.first).tolist()
        return [xxhash.xxh3_128_digest(raw[a:b]) if b > a else None for a, b in zip(at, at[1:])]


#: Texts whose arrivals are held at once: some nine of 8 bytes for each register and text, in a dozen arrays.
TOGETHER = 128


def registers(shingles: Shingles, many: int) -> np.ndarray:
    """ProbMinHash of every text (texts x registers), made for `TOGETHER` texts at a time."""
    begins = range(0, shingles.texts, TOGETHER)
    bounds = np.searchsorted(shingles.text, [*begins, shingles.texts])
    out = np.zeros((shingles.texts, many), U64)
    for k, a, b in zip(begins, bounds, bounds[1:]):
        some = out[k:k + TOGETHER]
        some[:] = _registers(shingles.text[a:b] - k, shingles.hash[a:b], shingles.count[a:b].astype(float), len(some), many)
    return out


def _registers(texts: np.ndarray, element: np.ndarray, rate: np.ndarray, n: int, many: int) -> np.ndarray:
    """For each register of `n` texts the hash of the shingle that arrives first.

    Arrivals are followed up to a limit by which all registers are filled: what
    comes later is later than every register. A text that has an empty register then begins again with a doubled limit.
    """
    total = np.bincount(texts, rate, minlength=n)
    first, winner = np.full(n * many, np.inf), np.zeros(n * many, U64)
    with np.errstate(divide="ignore"):
        limit = many * (math.log(many) + 3) / total
    time, number = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    live = np.arange(len(texts))
    while len(live):
        found, todo = [], live
        time[live], number[live] = 0, 0
        while len(todo):
            # As many arrivals at once as are expected up to the limit.
            expected = np.ceil(rate[todo] * (limit[texts[todo]] - time[todo])).astype(np.int64).clip(1)
            at = np.repeat(todo, expected)
            begins = np.cumsum(expected) - expected
            nth = np.arange(len(at)) - np.repeat(begins, expected) + number[at]
            noise = mix(element[at] + mix(nth.astype(U64) * U64(0xD1342543DE82EF95) + U64(1)))
            wait = -np.log(((noise >> U64(11)).astype(float) + 0.5) / 2.0 ** 53) / rate[at]
            sums = np.cumsum(wait)
            when = sums - np.repeat(sums[begins] - wait[begins], expected) + time[at]
            place = texts[at] * many + (mix(noise) % U64(many)).astype(np.int64)
            inside = when <= limit[texts[at]]
            found.append((when[inside], place[inside], element[at[inside]]))
            time[todo] = when[begins + expected - 1]
            number[todo] += expected
            todo = todo[time[todo] <= limit[texts[todo]]]
        when, place, who = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(-when, kind="stable")
        when, place, who = when[order], place[order], who[order]
        better = when < first[place]
        first[place[better]], winner[place[better]] = when[better], who[better]  # the last written is the earliest
        open_texts = np.flatnonzero(np.isinf(first.reshape(-1, many)).any(axis=1) & (total > 0))
        limit[open_texts] *= 2
        live = np.flatnonzero(np.isin(texts, open_texts))
    return winner.reshape(-1, many)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Similarity of two weighted sets (sorted hashes, counts): the sum over common d of
    1 / sum over all e of max(a[e] / a[d], b[e] / b[d])."""
    common, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    x, y = a[1][at_a].astype(float), b[1][at_b].astype(float)
    ratio = x / y
    # max(a[e] / a[d], b[e] / b[d]) is the first where e's ratio is at least d's; what only one of them has has an endless or no ratio.
    order = np.argsort(ratio, kind="stable")
    ratio, x, y = ratio[order], x[order], y[order]
    only_a, only_b = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    from_here = np.concatenate([np.cumsum(x[::-1])[::-1], [0.0]])
    before = np.concatenate([[0.0], np.cumsum(y)])
    at = np.searchsorted(ratio, ratio, side="left")
    return float((1 / ((from_here[at] + only_a) / x + (before[at] + only_b) / y)).sum())


def _sketched(docs: DataFrame, doc: str, text: str, settings: Settings, carry: list[str]) -> DataFrame:
    """Staged: _id, doc, node key, bands, registers (one byte each), and the carried columns."""
    many = settings.bands * settings.rows
    # A carried text is read from its row, so that it is in a batch once.
    given = docs.select(F.col(f"`{doc}`").alias("_doc"), *([] if text in carry else [F.col(f"`{text}`").alias("_text")]),
                        *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_row")] if carry else []))

    def work(batch):
        shingles = Shingles(batch.column("_row").field(carry.index(text)) if text in carry else batch.column("_text"), settings.words)
        found = registers(shingles, many)
        found = mix(found) & U64(255)
        # A band's key is its number and its registers, so two texts share a bucket just where these registers are equal.
        bands = np.repeat(np.arange(settings.bands, dtype=U64)[None, :], shingles.texts, axis=0)
        for k in range(settings.rows):
            bands = bands * U64(256) + found[:, k::settings.rows]
        at = pa.array(np.arange(shingles.texts + 1, dtype=np.int32) * settings.bands)
        small = found.astype(np.uint8).tobytes()
        rest = [batch.column("_row")] if carry else []
        return pa.RecordBatch.from_arrays(
            [batch.column("_doc"), pa.array(shingles.sequence_keys(), pa.binary()),
             pa.ListArray.from_arrays(at, pa.array(bands.reshape(-1).view(np.int64))),
             pa.array([small[k:k + many] for k in range(0, len(small), many)], pa.binary()), *rest],
            ["_doc", "key", "bands", "registers", *["_row"] * len(rest)])

    made = schema(given.schema["_doc"], "key binary, bands array<long>, registers binary", *([given.schema["_row"]] if carry else []))
    return stage(map_batches(given, work, made, rows=1000).withColumn("_id", F.monotonically_increasing_id()), "sketches")


def _texts(docs: DataFrame, text: str, members: DataFrame, settings: Settings) -> DataFrame:
    """Staged (node, text) of the members (node, key). The key is made again from the text."""
    given = columns(docs, text=text)

    def work(batch):
        keys = Shingles(batch.column("text"), settings.words).sequence_keys()
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), batch.column("text")], ["key", "text"])

    keyed = map_batches(given, work, "key binary, text string").where("key IS NOT NULL")
    found = keyed.join(members, "key").groupBy("node").agg(F.min("text").alias("text"))
    return stage(found, "texts")


def verified(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) whose similarity reaches the limit."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return map_batches(both, lambda batch: _similar(batch, settings), "a long, b long, similarity double")


def _sets(texts: pa.Array, settings: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted shingle hashes and their counts of each text."""
    made = Shingles(texts, settings.words)
    bounds = np.searchsorted(made.text, np.arange(len(texts) + 1))
    sets = []
    for a, b in zip(bounds, bounds[1:]):
        order = np.argsort(made.hash[a:b])
        sets.append((made.hash[a:b][order], made.count[a:b][order]))
    return sets


def _similar(batch: pa.RecordBatch, settings: Settings) -> pa.RecordBatch:
    a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
    nodes, place = np.unique(np.concatenate([a, b]), return_index=True)
    every = pa.concat_arrays([batch.column("text_a"), batch.column("text_b")]).take(pa.array(place))
    sets = _sets(every, settings)
    value = np.array([probability_jaccard(sets[i], sets[j]) for i, j in zip(np.searchsorted(nodes, a), np.searchsorted(nodes, b))])
    good = value >= settings.limit - 1e-9
    return pa.RecordBatch.from_arrays([pa.array(a[good]), pa.array(b[good]), pa.array(value[good])], ["a", "b", "similarity"])


def _tiled(keys: DataFrame, blocks, work, out: str) -> DataFrame:
    """`work` on each tile (a record batch) of every bucket `key`: a block of its nodes against another or itself.

    `blocks` is the number of blocks of a row's bucket, which the caller chooses so that a
    block is small. `mine` is a node's own block, `i` and `j` are the tile's.
    """
    names = keys.columns
    dealt = keys.withColumn("blocks", blocks.cast("int")).withColumn("mine", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(*names, F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine")

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            # The last tile may go on in the next batch.
            at = [batch.column(c).to_numpy() for c in ("key", "i", "j")]
            edges = np.flatnonzero(np.any([np.diff(x) != 0 for x in at], axis=0)) + 1
            if held and any(held[-1].column(c)[-1] != batch.column(c)[0] for c in ("key", "i", "j")):
                yield work(pa.concat_batches(held))
                held = []
            bounds = [0, *edges.tolist(), batch.num_rows]
            for a, b in zip(bounds, bounds[1:]):
                held.append(batch.slice(a, b - a))
                if b < batch.num_rows:
                    yield work(pa.concat_batches(held))
                    held = []
        if held:
            yield work(pa.concat_batches(held))

    order = ("key", "i", "j")
    return dealt.repartition(*order).sortWithinPartitions(*order, "node").mapInArrow(run, out)


class Tile:
    """Nodes of a tile with their registers, and which pairs their registers allow."""

    def __init__(self, rows: pa.RecordBatch, settings: Settings):
        self.settings, many = settings, settings.bands * settings.rows
        self.key, self.same_block = rows.column("key")[0].as_py(), rows.column("i")[0] == rows.column("j")[0]
        self.node, self.before, self.mine = (rows.column(c).to_numpy() for c in ("node", "before", "mine"))
        self.regs = np.frombuffer(b"".join(rows.column("registers").to_pylist()), np.uint8).reshape(-1, many)
        self.least = (settings.limit - settings.slack) * many

    def ranked(self, x: int) -> np.ndarray:
        """The nodes of other classes of `before` that x can be linked to, the best agreeing first.

        A pair that shares several buckets counts in the one of its first band only. Within
        a diagonal tile every pair is looked at, else only those between its two blocks.
        """
        ys = np.flatnonzero((self.before != self.before[x]) & (self.same_block | (self.mine != self.mine[x])))
        same = self.regs[ys] == self.regs[x]
        agree = same.sum(axis=1)
        fits = np.flatnonzero(agree >= self.least)
        first = same[fits].reshape(-1, self.settings.bands, self.settings.rows).all(axis=2).argmax(axis=1)
        fits = fits[first == self.key >> (8 * self.settings.rows)]
        return ys[fits][np.lexsort((self.node[ys[fits]], -agree[fits]))]


def _best(keys: DataFrame, settings: Settings) -> DataFrame:
    """Rows (a, b, key): each node's best agreeing nodes of other classes in its tile.

    A row with the node as `a` and its bucket's `key` instead of `b` tells that pairs of it were left out.
    `keys` has key, node, before, n, registers.
    """
    def work(rows: pa.RecordBatch) -> pa.RecordBatch:
        tile, a, b, more = Tile(rows, settings), [], [], set()
        if (tile.before != tile.before[0]).any():
            for x in range(len(tile.node)):
                ys = tile.ranked(x)
                a += [int(tile.node[x])] * len(ys[:settings.best])
                b += tile.node[ys[:settings.best]].tolist()
                if len(ys) > settings.best:
                    more.update(tile.node[ys[settings.best:]].tolist(), [int(tile.node[x])])
        pairs = sorted({(min(p), max(p)) for p in zip(a, b)})
        return pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in pairs] + sorted(more), pa.int64()), pa.array([p[1] for p in pairs] + [None] * len(more), pa.int64()),
             pa.array([None] * len(pairs) + [tile.key] * len(more), pa.int64())], ["a", "b", "key"])

    return _tiled(keys, F.ceil(F.col("n") / settings.tile), work, "a long, b long, key long")


def _rest(keys: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b, similarity) among all pairs of a bucket that are in different classes.

    `keys` has key, node, before, registers, text. Of the links in a tile
    those are given that connect classes not yet connected in it, one less than its nodes at most.
    """
    sizes = keys.groupBy("key").agg(F.greatest(F.ceil(F.count("*") / settings.tile),
                                               F.ceil(F.sum(F.octet_length("text")) / settings.tile_bytes)).alias("many"))

    def work(rows: pa.RecordBatch) -> pa.RecordBatch:
        tile, out = Tile(rows, settings), []
        if (tile.before != tile.before[0]).any():
            sets, now = _sets(rows.column("text"), settings), tile.before.copy()
            for x in range(len(tile.node)):
                for y in tile.ranked(x).tolist():
                    if now[x] == now[y] or tile.node[y] < tile.node[x]:
                        continue
                    value = probability_jaccard(sets[x], sets[y])
                    if value >= settings.limit - 1e-9:
                        now[now == now[y]] = now[x]
                        out.append((int(tile.node[x]), int(tile.node[y]), value))
        a, b, value = zip(*out) if out else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(value, pa.float64())], ["a", "b", "similarity"])

    return _tiled(keys.join(sizes, "key"), F.col("many"), work, "a long, b long, similarity double")


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets that hold different labels and more than two nodes."""
    known = (members.where("n > 2").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
    open_keys = known.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
    return stage(known.join(open_keys, "key"), "open-buckets")


def _more(found: DataFrame, labels: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All links and their labels after more pairs were verified."""
    more = stage(pairs, "links")
    if more.isEmpty():
        return found, labels
    found = found.unionByName(more)
    return found, stage(components(found), "labels")


def links(docs: DataFrame, settings: Settings = Settings(), doc: str = "doc_id", text: str = "text",
          carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sketches, rows, labels): staged rows with _id and what they carry; their (_id, _doc, node); and (node, label) of all nodes that are linked."""
    with passing(docs.sparkSession) as keep:
        sketches = keep(_sketched(docs, doc, text, settings, list(carry)))
        # Staged, so that what joins it is a plain shuffle on both sides and adaptive execution can split a key that very many copies have.
        nodes = keep(stage(sketches.where("key IS NOT NULL").groupBy("key").agg(F.min("_id").alias("node")), "nodes"))
        first = sketches.join(nodes.select(F.col("node").alias("_id")), "_id", "left_semi")
        banded = first.select(F.col("_id").alias("node"), F.explode("bands").alias("key"))
        shared = banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        members = stage(banded.join(shared, "key"), "buckets")
        degree = members.groupBy("node").agg(F.sum(F.col("n") - 1).alias("degree"))
        keyed = nodes.join(degree.select("node"), "node")
        texts = _texts(docs, text, keyed, settings)
        bytes_of = stage(first.select(F.col("_id").alias("node"), "registers").join(degree.select("node"), "node"), "registers")

        centre = members.join(degree, "node").groupBy("key").agg(F.max(F.struct("degree", -F.col("node"))).alias("c")).select(
            "key", (-F.col("c")["col2"]).alias("centre"))
        stars = (members.join(centre, "key").where("node <> centre")
                 .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct())
        found = stage(verified(stars, texts, settings), "links")
        labels = stage(components(found), "labels")
        rest = _open(members, labels)
        if not rest.isEmpty():
            listed = stage(_best(rest.join(bytes_of, "node").withColumnRenamed("label", "before"), settings), "candidates")
            found, labels = _more(found, labels, verified(listed.where("b IS NOT NULL"), texts, settings))
            left = listed.where("b IS NULL").select(F.col("a").alias("node"), "key").distinct()
            if not left.isEmpty():
                known = (left.join(labels, "node", "left").withColumn("before", F.coalesce("label", "node")).drop("label")
                         .join(bytes_of, "node").join(texts, "node"))
                found, labels = _more(found, labels, _rest(known, settings))
        keep(labels)
    return sketches, sketches.select("_id", "_doc", "key").join(nodes, "key", "left").drop("key"), labels


def _classed(docs: DataFrame, settings: Settings, doc: str, text: str, carry: tuple[str, ...]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Staged rows with what they carry; (_id, _doc, class); staged: best row and size of each class."""
    sketches, rows, labels = links(docs, settings, doc, text, carry)
    labelled = (rows.join(labels, "node", "left")
                .select("_id", "_doc", F.coalesce("label", "node", -1 - F.col("_id")).alias("class")))
    best = F.min(F.struct(F.col("_doc").isNull().alias("none"), "_doc", "_id"))
    return sketches, labelled, stage(labelled.groupBy("class").agg(best.alias("best"), F.count("*").alias("class_size")), "classes")


def classes(docs: DataFrame, settings: Settings = Settings(), doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's doc_id, class_id (the smallest doc_id of its class), class_size and whether it is the one that is kept."""
    _, labelled, best = _classed(docs, settings, doc, text, ())
    return labelled.join(best, "class").select(
        F.col("_doc").alias("doc_id"), F.col("best")["_doc"].alias("class_id"), "class_size", (F.col("_id") == F.col("best")["_id"]).alias("kept"))


def one_of_each(docs: DataFrame, settings: Settings = Settings(), doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class with all its columns."""
    names = docs.columns
    with passing(docs.sparkSession) as keep:
        sketches, _, best = _classed(docs, settings, doc, text, tuple(names))
        keep(sketches), keep(best)
    kept = sketches.select("_id", "_row").join(best.select(F.col("best")["_id"].alias("_id")), "_id", "left_semi")
    return kept.select(*[F.col("_row").getField(n).alias(n) for n in names])
