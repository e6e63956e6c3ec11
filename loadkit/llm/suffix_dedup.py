"""Removal of repeated passages by sorting suffixes.

A passage is repeated if the `length` bytes from its begin also begin anywhere
else, in the same text or another one. Sorting every suffix would move every
byte hundreds of times; so suffixes are sorted at anchors. The anchor of a window of
`length` bytes is the place inside it whose next `gram` bytes have the smallest hash,
the first of equal ones: equal windows have their anchor at the same place. Neighbouring windows with the
same anchor are a run, some 140 windows; what a run spans is its context.

1. Runs are counted by their anchor's gram. Nothing repeats where it occurs once. Where all contexts of
   a gram are equal and there are two or more, all their windows repeat.
2. The distinct contexts of the other grams are range-partitioned by the leading bytes of
   their anchored suffix, with the splitters Spark samples. As equal leads stay
   together and are shorter than a gram, suffixes on both sides of a border differ within the lead.
3. In a bucket, multikey quicksort sorts the suffixes behind the anchors, and the
   reversed text before the anchors, with the common prefix of each two neighbours. A window
   that reaches d bytes before the anchor repeats if another context shares its rank interval at depth
   d on the left and length - d on the right.
4. A gram with very many distinct contexts is not sorted in one task: its windows are counted by a 128-bit hash.

Every byte of a repeated window is removed from all texts that hold it.

With `Settings.words` a window is `words` + 1 whole words instead, and only those that occur again as whole words, byte for
byte, are removed. The same steps find them: the anchor of such a window lies anywhere in its bytes, and a window that reaches d bytes
before the anchor and e behind it repeats if another context has one with the same reaches and shares its rank intervals. A gram with
a very long context is counted as one with very many.

Defined results. A missing text is empty; texts below `length` bytes lose nothing. Copies of a text lose
the same. Rows that repeat a doc_id are texts of their own; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkit.llm import textarrays as X
from loadkit.llm.probminhash import mix
from loadkit.llm.shared import columns, map_batches, passing, schema, slices, stage

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_SCRAMBLED = mix(np.arange(1, 257, dtype=U64))
PLACE_BITS = 24
_PLACE = U64((1 << PLACE_BITS) - 1)
#: Words can be of any length, so places among them can be greater.
_WORD_PLACE = U64((1 << 31) - 1)
#: Longer texts are searched in parts that overlap by a window.
PART = 1 << 20


@dataclass(frozen=True)
class Settings:
    """`length` bytes make a repeated window, `gram` bytes an anchor. A gram with more than
    `many` distinct contexts is counted by window hashes. With `words`, passages of over so many
    words are looked for, and `length` is only the least number of bytes they have; one whose contexts have over `wide` bytes is counted too."""

    length: int = 400
    gram: int = 128
    many: int = 4000
    words: int = 0
    wide: int = 2048

    def __post_init__(self):
        if self.words and self.length > 2 * self.words + 1:
            raise ValueError("a passage of over `words` words can be shorter than `length`")


#: Every passage of over 50 words, even of words of one letter.
PASSAGES = Settings(length=101, gram=48, words=50)


class _Powers:
    """Powers of the hash's base and of its inverse, computed once and as far as needed."""

    up, down = np.ones(1, U64), np.ones(1, U64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            powers = []
            for base in (_BASE, pow(_BASE, -1, 1 << 64)):
                factors = np.full(n + 1, base, U64)
                factors[0] = 1
                powers.append(np.cumprod(factors, dtype=U64))
            cls.up, cls.down = powers
        return cls.up, cls.down


def _window_least(values: np.ndarray, size: int) -> np.ndarray:
    """Smallest of every `size` neighbouring values: from two running minima within blocks of `size`."""
    n = len(values)
    padded = np.full(-(-n // size) * size, np.iinfo(U64).max, U64)
    padded[:n] = values
    blocks = padded.reshape(-1, size)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n - size + 1], ahead[size - 1:n])


def _range_least(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Smallest of the values in each range: two ranges of a power of two cover it."""
    out, level = np.empty(len(begin), U64), np.floor(np.log2(end - begin)).astype(np.int64)
    for k in range(int(level.max(initial=-1)) + 1):
        some = np.flatnonzero(level == k)
        out[some] = np.minimum(values[begin[some]], values[end[some] - (1 << k)])
        values = np.minimum(values[:-(1 << k)], values[1 << k:])
    return out


def _grams(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the `gram` bytes from every place."""
    up, down = _Powers.to(len(data) + 1)
    total = np.zeros(len(data) + 1, U64)
    np.cumsum(_SCRAMBLED[data] * up[:len(data)], out=total[1:])
    return mix((total[gram:] - total[:-gram]) * down[:len(data) - gram + 1])


def word_windows(data: np.ndarray, offsets: np.ndarray, many: int) -> tuple[np.ndarray, ...]:
    """Text number, first word, begin and end (places in `data`) of every window of `many` words."""
    words = X.Words(data, offsets)
    at = X.windows(words.first, many)
    return np.searchsorted(words.first, at, side="right") - 1, at, words.start[at], words.end[at + many - 1]


def _word_runs(data: np.ndarray, offsets: np.ndarray, settings: Settings) -> tuple[np.ndarray, ...]:
    """As from `runs`; the last window is given by its end less `length`."""
    owner, _, start, stop = word_windows(data, offsets, settings.words + 1)
    if not len(owner):
        return (np.zeros(0, np.int64),) * 5
    grams = _grams(data, settings.gram)
    keyed = (grams & ~_WORD_PLACE) | np.arange(len(grams), dtype=U64)
    at = (_range_least(keyed, start, stop - settings.gram + 1) & _WORD_PLACE).astype(np.int64)
    begin, end = _same(at, owner)
    return owner[begin], at[begin], start[begin], stop[end] - settings.length, grams[at[begin]].view(np.int64)


def _same(at: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of the neighbouring windows with one anchor."""
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
    begin = np.flatnonzero(new)
    return begin, np.concatenate([begin[1:], [len(at)]]) - 1 if len(at) else begin


def runs(data: np.ndarray, offsets: np.ndarray, settings: Settings) -> tuple[np.ndarray, ...]:
    """Text number, anchor, first and last window of every run (places in `data`), and the hash of the anchor's gram."""
    if settings.words:
        return _word_runs(data, offsets, settings)
    size, gram = settings.length, settings.gram
    none = np.zeros(0, np.int64)
    long_enough = np.flatnonzero(np.diff(offsets) >= size)
    if not len(long_enough):
        return none, none, none, none, none
    grams = _grams(data, gram)
    keyed = (grams & ~_PLACE) | np.arange(len(grams), dtype=U64)
    anchor = (_window_least(keyed, size - gram + 1) & _PLACE).astype(np.int64)
    counts = np.diff(offsets)[long_enough] - size + 1
    windows = np.repeat(offsets[long_enough] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    owner = np.repeat(long_enough, counts)
    at = anchor[windows]
    begin, end = _same(at, owner)
    return owner[begin], at[begin], windows[begin], windows[end], grams[at[begin]].view(np.int64)


def _parts(data: np.ndarray, offsets: np.ndarray, settings: Settings):
    """Pieces (data, offsets, text numbers, places of their begins) whose windows are those of all texts, each once."""
    if len(data) <= 2 * PART:
        yield data, offsets, np.arange(len(offsets) - 1), np.zeros(len(offsets) - 1, np.int64)
        return
    for k in range(len(offsets) - 1):
        a, b = int(offsets[k]), int(offsets[k + 1])
        if settings.words:
            for s, e in _word_parts(data[a:b], settings.words + 1):
                yield data[a + s:a + e], np.array([0, e - s]), np.array([k]), np.array([s])
            continue
        for s in range(a, max(a + 1, b - settings.length + 1), PART):
            piece = data[s:min(b, s + PART + settings.length - 1)]
            yield piece, np.array([0, len(piece)]), np.array([k]), np.array([s - a])


def _word_parts(data: np.ndarray, many: int):
    """Begins and ends of pieces of one text, each window of `many` words in one of them."""
    words = X.Words(data, np.array([0, len(data)]))
    i, n = 0, len(words.start)
    while i + many <= n:
        j = max(i + 1, int(np.searchsorted(words.start, words.start[i] + PART)))
        yield int(words.start[i]), int(words.end[min(n, j + many - 1) - 1])
        i = j


RUN = "key binary, at int, first int, last int, gram long, context long"


def _runs_of(docs: DataFrame, text: str, settings: Settings) -> DataFrame:
    """Staged: one row per run with the text's 128-bit key, its places in the text, and hashes of gram and context."""
    def work(batch):
        data, offsets = X.flat(batch.column("text"))
        raw = data.tobytes()
        keys = [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
        for piece, bounds, texts, begins in _parts(data, offsets, settings):
            owner, at, first, last, gram = runs(piece, bounds, settings)
            body = piece.tobytes()
            context = np.array([xxhash.xxh3_64_intdigest(body[a:b], seed=c)
                                for a, b, c in zip(first.tolist(), (last + settings.length).tolist(), (at - first).tolist())], U64)
            shift = begins[owner] - bounds[owner] if len(owner) else owner
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[i] for i in texts[owner].tolist()] if len(owner) else [], pa.binary()),
                 *[pa.array((x + shift).astype(np.int32)) for x in (at, first, last)],
                 pa.array(gram), pa.array(context.view(np.int64))], ["key", "at", "first", "last", "gram", "context"])

    return stage(map_batches(columns(docs, text=text), work, RUN), "runs")


def _keyed_texts(docs: DataFrame, text: str, once: bool, carry: DataFrame | None = None) -> DataFrame:
    """(key, text) of the texts; `once`: copies within a task are left out."""
    def run(batches):
        seen: set[bytes] = set()
        for batch in batches:
            for some in slices(batch):
                data, offsets = X.flat(some.column("text"))
                raw = data.tobytes()
                keys = [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
                out = pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *some.columns], ["key", *some.schema.names])
                if once:
                    fresh = []
                    for key in keys:
                        fresh.append(key not in seen)
                        seen.add(key)
                    out = out.filter(pa.array(fresh))
                    if len(seen) > 1_000_000:
                        seen.clear()
                yield out

    given = carry if carry is not None else columns(docs, text=text)
    return given.mapInArrow(run, schema("key binary", *given.schema.fields))


def _words(parts: list[bytes]) -> np.ndarray:
    """Strings as rows of big-endian 8-byte words, filled up with zeros; compared as numbers they sort as the strings."""
    width = -(-max(map(len, parts), default=1) // 8) * 8 or 8
    filled = b"".join(p.ljust(width, b"\0") for p in parts)
    return np.frombuffer(filled, ">u8").reshape(len(parts), -1).astype(U64)


def sort_suffixes(group: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of rows within their groups, one word at a time over all rows that still tie.

    Returns the order, and the bytes that each row shares with the row before it (-1 at the begin of a group).
    """
    order = np.argsort(group, kind="stable")
    shared = np.full(len(order), 8 * words.shape[1], np.int64)
    bound = np.ones(len(order), bool)  # a new tie class begins here
    bound[1:] = group[order][1:] != group[order][:-1]
    shared[bound] = -1
    for column in range(words.shape[1]):
        tie = np.cumsum(bound) - 1
        size = np.bincount(tie)
        live = np.flatnonzero(size[tie] > 1)
        if not len(live):
            break
        word = words[order[live], column]
        by = np.lexsort((word, tie[live]))
        order[live] = order[live[by]]
        word = word[by]
        split = np.flatnonzero((word[1:] != word[:-1]) & (tie[live][1:] == tie[live][:-1])) + 1
        differ = word[split] ^ word[split - 1]
        # Leading zero bytes of the difference are shared bytes.
        lead = 7 - np.floor(np.log2(differ.astype(np.float64)) / 8).astype(np.int64).clip(0, 7)
        exact = (differ >> (U64(8) * (U64(7) - lead.astype(U64)))) == 0  # the logarithm was rounded up
        lead = lead + exact
        shared[live[split]] = 8 * column + lead
        bound[live[split]] = True
    return order, shared


def repeated_windows(group: np.ndarray, contexts: list[bytes], anchor: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows that two or more contexts of a group share, as (context, reach before the anchor).

    Each context has the windows that lie in it and hold the anchor's gram.
    """
    n = len(contexts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    right = _words([c[a:a + length] for c, a in zip(contexts, anchor.tolist())])
    left = _words([c[:a][::-1] for c, a in zip(contexts, anchor.tolist())])
    size = np.array([len(c) for c in contexts])
    high, low = anchor, anchor + length - size
    (order_r, shared_r), (order_l, shared_l) = sort_suffixes(group, right), sort_suffixes(group, left)
    place_r, place_l, every = np.empty(n, np.int64), np.empty(n, np.int64), np.arange(n)
    place_r[order_r], place_l[order_l] = every, every
    out_i, out_d = [], []
    for d in range(int(low.min(initial=0)), int(high.max(initial=-1)) + 1):
        some = np.flatnonzero((low <= d) & (d <= high))
        if len(some) < 2:
            continue
        # The begin of the interval of rows that share so many bytes names the interval.
        by_r = np.maximum.accumulate(np.where(shared_r < length - d, every, 0))[place_r[some]]
        by_l = np.maximum.accumulate(np.where(shared_l < d, every, 0))[place_l[some]] if d else group[some]
        maybe = (np.bincount(by_r, minlength=n)[by_r] > 1) & (np.bincount(by_l, minlength=n)[by_l] > 1) if d else np.bincount(by_r, minlength=n)[by_r] > 1
        some, key = some[maybe], (by_r * np.int64(n) + by_l)[maybe] if d else by_r[maybe]
        if len(some) < 2:
            continue
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        twin = np.zeros(len(order), bool)
        twin[1:] = ordered[1:] == ordered[:-1]
        twin[:-1] |= twin[1:]
        out_i.append(some[order[twin]]), out_d.append(np.full(int(twin.sum()), d))
    if not out_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_i), np.concatenate(out_d)


def _intervals(group: np.ndarray, parts: list[bytes], which: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """For each asked row the begin of the interval of sorted rows that share `depth` bytes with it."""
    order, shared = sort_suffixes(group, _words(parts))
    every = np.arange(len(order))
    place, out = np.empty(len(order), np.int64), np.empty(len(which), np.int64)
    place[order] = every
    by = np.argsort(depth, kind="stable")
    for some in np.split(by, np.flatnonzero(np.diff(depth[by])) + 1):
        if len(some):
            out[some] = np.maximum.accumulate(np.where(shared < depth[some[0]], every, 0))[place[which[some]]]
    return out


def repeated_word_windows(group: np.ndarray, contexts: list[bytes], anchor: np.ndarray, many: int) -> tuple[np.ndarray, ...]:
    """Spans of windows of `many` words that two or more contexts of a group share, as (context, begin, end)."""
    if not contexts:
        return (np.zeros(0, np.int64),) * 3
    offsets = np.cumsum([0, *map(len, contexts)])
    which, word, begin, end = word_windows(np.frombuffer(b"".join(contexts), np.uint8), offsets, many)
    begin, end = begin - offsets[which], end - offsets[which]
    before, behind = anchor[which] - begin, end - anchor[which]
    places = anchor.tolist()
    keys = (_intervals(group, [c[a:] for c, a in zip(contexts, places)], which, behind),
            _intervals(group, [c[:a][::-1] for c, a in zip(contexts, places)], which, before), before, behind)
    order = np.lexsort(keys)
    same = np.ones(max(len(order) - 1, 0), bool)
    for key in keys:
        same &= key[order][1:] == key[order][:-1]
    twin = np.zeros(len(order), bool)
    twin[1:] |= same
    twin[:-1] |= same
    some = np.sort(order[twin])
    first, last = _same(word[some] - np.arange(len(some)), which[some])
    return which[some[first]], begin[some[first]], end[some[last]]


def _ranges(which: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring reaches: context, smallest and largest reach."""
    order = np.lexsort((reach, which))
    which, reach = which[order], reach[order]
    new = np.ones(len(which), bool)
    new[1:] = (which[1:] != which[:-1]) | (reach[1:] != reach[:-1] + 1)
    begin = np.flatnonzero(new)
    end = np.concatenate([begin[1:], [len(which)]]) - 1 if len(which) else begin
    return which[begin], reach[begin], reach[end]


FOUND = "gram long, context long, low int, high int"


def _sorted_windows(contexts: DataFrame, settings: Settings) -> DataFrame:
    """Ranges of repeated windows of the contexts (gram, context, lead, body, anchor)."""
    def found(batch: pa.RecordBatch) -> pa.RecordBatch:
        gram, context = batch.column("gram").to_numpy(), batch.column("context").to_numpy()
        # Copies of a text can bring a context twice.
        fresh = np.ones(len(gram), bool)
        fresh[1:] = (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])
        rows = np.flatnonzero(fresh)
        group = np.cumsum(np.concatenate([[0], np.diff(gram[rows]) != 0])) if len(rows) else rows
        body = batch.column("body").take(pa.array(rows)).to_pylist()
        anchor = batch.column("anchor").to_numpy()[rows].astype(np.int64)
        if settings.words:
            i, begin, end = repeated_word_windows(group, body, anchor, settings.words + 1)
            low, high = anchor[i] + settings.length - end, anchor[i] - begin
        else:
            i, low, high = _ranges(*repeated_windows(group, body, anchor, settings.length))
        return pa.RecordBatch.from_arrays([pa.array(gram[rows[i]]), pa.array(context[rows[i]]), pa.array(low.astype(np.int32)),
                                           pa.array(high.astype(np.int32))], ["gram", "context", "low", "high"])

    def run(batches):
        held: pa.RecordBatch | None = None
        for batch in batches:
            for some in slices(batch, 8 << 20):
                some = pa.concat_batches([held, some]) if held is not None else some
                gram = some.column("gram").to_numpy()
                edges = np.flatnonzero(np.diff(gram))
                last = int(edges[-1]) + 1 if len(edges) else 0
                if last:
                    yield found(some.slice(0, last))
                held = some.slice(last)
        if held is not None and held.num_rows:
            yield found(held)

    dealt = contexts.repartitionByRange("lead").sortWithinPartitions("lead", "gram", "context")
    return dealt.select("gram", "context", "body", "anchor").mapInArrow(run, FOUND)


def _counted_windows(contexts: DataFrame, settings: Settings) -> DataFrame:
    """The same for grams with very many contexts: windows are hashed and counted over all tasks."""
    def run(batch):
        gram, context, anchor = (batch.column(c).to_numpy() for c in ("gram", "context", "anchor"))
        out = {name: [] for name in ("gram", "context", "low", "high", "hash")}
        for k, body in enumerate(batch.column("body").to_pylist()):
            if settings.words:
                _, _, begin, end = word_windows(np.frombuffer(body, np.uint8), np.array([0, len(body)]), settings.words + 1)
                spans = zip(begin.tolist(), end.tolist())
            else:
                spans = ((s, s + settings.length) for s in range(len(body) - settings.length + 1))
            for s, e in spans:
                out["gram"].append(gram[k]), out["context"].append(context[k])
                out["low"].append(int(anchor[k]) + settings.length - e), out["high"].append(int(anchor[k]) - s)
                out["hash"].append(xxhash.xxh3_128_digest(body[s:e]))
        return pa.RecordBatch.from_arrays([pa.array(out["gram"], pa.int64()), pa.array(out["context"], pa.int64()), pa.array(out["low"], pa.int32()),
                                           pa.array(out["high"], pa.int32()), pa.array(out["hash"], pa.binary())], list(out))

    each = map_batches(contexts.select("gram", "context", "body", "anchor").dropDuplicates(["gram", "context"]), run,
                       "gram long, context long, low int, high int, hash binary")
    twice = each.groupBy("gram", "high", "hash").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return each.join(twice, ["gram", "high", "hash"]).select("gram", "context", "low", "high")


def repeated_spans(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """(key, spans): for the 128-bit key of each text the byte ranges that repeated windows cover; texts without any have no row."""
    with passing(docs.sparkSession) as keep:
        every = _runs_of(docs, text, settings)
        grams = every.groupBy("gram").agg(F.count("*").alias("n"), F.min("context").alias("lo"), F.max("context").alias("hi")).where("n > 1")
        # Staged, so that the join shuffles both sides and adaptive execution can split a gram that very many runs have.
        grams = stage(grams.select("gram", (F.col("lo") == F.col("hi")).alias("equal")), "grams")
        met = keep(stage(every.join(grams, "gram"), "met"))
    distinct = stage(met.where("NOT equal").groupBy("gram", "context").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "at", "first", "last")).alias("one")), "contexts")
    per_gram = distinct.groupBy("gram").agg(F.count("*").alias("contexts"), F.max(F.col("one.last") - F.col("one.first")).alias("longest"))
    if settings.words:
        too_wide = F.col("longest") + settings.length > settings.wide
        per_gram = per_gram.withColumn("contexts", F.when(too_wide, F.lit(settings.many + 1).cast("long")).otherwise(F.col("contexts")))
    asked = (distinct.join(per_gram, "gram").select("gram", "context", F.col("one.key").alias("key"), F.col("one.at").alias("at"),
                                                    F.col("one.first").alias("first"), F.col("one.last").alias("last"), "contexts")
             .groupBy("key").agg(F.collect_list(F.struct("gram", "context", "at", "first", "last", "contexts")).alias("runs")))
    texts = _keyed_texts(docs, text, once=True).join(asked, "key")

    def bodies(batch):
        out = {name: [] for name in ("gram", "context", "lead", "body", "anchor", "contexts")}
        for value, wanted in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
            raw = value.encode()
            for r in wanted:
                out["gram"].append(r["gram"]), out["context"].append(r["context"]), out["contexts"].append(r["contexts"])
                out["lead"].append(raw[r["at"]:r["at"] + min(64, settings.gram)])
                out["body"].append(raw[r["first"]:r["last"] + settings.length]), out["anchor"].append(r["at"] - r["first"])
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out))

    contexts = stage(map_batches(texts.select("text", "runs"), bodies,
                                 "gram long, context long, lead binary, body binary, anchor int, contexts long"), "bodies")
    ranges = _sorted_windows(contexts.where(F.col("contexts") <= settings.many), settings).unionByName(
        _counted_windows(contexts.where(F.col("contexts") > settings.many), settings))
    # A context that two runs share repeats as a whole; a missing reach is that of the run below.
    no = F.lit(None).cast("int")
    shared = distinct.where("n > 1").select("gram", "context", no.alias("low"), no.alias("high"))
    partly = met.where("NOT equal").join(ranges.unionByName(shared), ["gram", "context"])
    begin = F.greatest(F.col("at") - F.col("high"), F.col("first"))
    end = F.least(F.col("at") - F.col("low"), F.col("last")) + settings.length
    spans = (partly.select("key", begin.alias("begin"), end.alias("end"))
             .unionByName(met.where("equal").select("key", F.col("first").alias("begin"), (F.col("last") + settings.length).alias("end"))))
    return spans.distinct().groupBy("key").agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("spans"))


def merged_spans(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Sorted ranges joined to maximal ones."""
    out: list[tuple[int, int]] = []
    for s in spans or []:
        if out and s["begin"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s["end"]))
        else:
            out.append((s["begin"], s["end"]))
    return out


def deduplicated(docs: DataFrame, settings: Settings = Settings(), text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns of every row, removed spans (begin, end in bytes), and the kept bytes.

    `kept` holds exactly the bytes that are not removed; `kept_text` leaves whole
    characters, one of which only some bytes are repeated is kept.
    """
    given = docs.select(F.col(f"`{text}`").alias("text"), F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_row"))
    # Staged, so that the join can be split where very many rows are copies of a text.
    with passing(docs.sparkSession) as keep:
        spans = keep(stage(repeated_spans(docs, settings, text), "spans"))
    rows = _keyed_texts(docs, text, once=False, carry=given).join(spans, "key", "left")

    def work(batch):
        kept, whole, size, gone, listed = [], [], [], [], []
        for value, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            raw = (value or "").encode()
            cuts = merged_spans(spans)
            size.append(len(raw)), gone.append(sum(b - a for a, b in cuts)), listed.append([{"begin": a, "end": b} for a, b in cuts])
            kept.append(_without(raw, cuts))
            whole.append(None if value is None else _without(raw, [_whole(raw, a, b) for a, b in cuts]).decode())
        cut = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
        return pa.RecordBatch.from_arrays(
            [batch.column("_row"), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(listed, cut),
             pa.array(kept, pa.binary()), pa.array(whole, pa.string())], ["_row", "n_bytes", "n_removed", "removed", "kept", "kept_text"])

    out = map_batches(rows.select("_row", "text", "spans"), work,
                      schema(given.schema["_row"], "n_bytes long, n_removed long, removed array<struct<begin:int,end:int>>, kept binary, kept_text string"))
    return out.select(*[F.col("_row").getField(c).alias(c) for c in carry], "n_bytes", "n_removed", "removed", "kept", "kept_text")


def _without(raw: bytes, cuts: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for a, b in cuts:
        parts.append(raw[at:a])
        at = max(at, b)
    return b"".join([*parts, raw[at:]])


def _whole(raw: bytes, begin: int, end: int) -> tuple[int, int]:
    """The range shrunk to whole characters."""
    while begin < end and raw[begin] & 0xC0 == 0x80:
        begin += 1
    while end > begin and end < len(raw) and raw[end] & 0xC0 == 0x80:
        end -= 1
    return begin, end
