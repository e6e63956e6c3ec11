"""Quality rules from the frequency of lines across documents.

Lines are normalised (ASCII white space collapsed, lower case) and hashed. For
each host the operator counts the distinct documents that hold a line; lines
above the host's limit are removed, and a document that keeps too little of its
words is rejected. Exact copies of a text count as one document, so a group of
copies does not turn its own lines into boilerplate. With `Rules.near` a whole class of
near duplicates, as `probminhash` finds them, counts as one document, in a line's holders and in the host's total.

Defined results. A missing text has no words and is rejected by the base rule,
as is an empty one. A missing host is a host of its own. Rows that repeat a
doc_id are judged each on its own text. An empty table gives no rows. Columns
that the operator does not name are carried along under any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkit.llm import probminhash
from loadkit.llm import textarrays as X
from loadkit.llm.shared import map_batches, passing, schema, stage

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Rules:
    """Limits. A line is removed when more than `share` of the host's distinct texts, and
    more than `least` of them, hold it; a document needs `words_left` words and
    `share_left` of its words after that. With `near`, near duplicates are one text."""

    least: int = 25
    share: float = 0.05
    words_left: int = 10
    share_left: float = 0.3
    near: bool = False


FIGURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lines array<struct<h:binary,w:int>>"
RESULT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_lines",
          "n_removed_words", "base_failed", "kept")



def line_hash(line: bytes) -> bytes:
    """Hash of the line in lower case with its white space collapsed."""
    return xxhash.xxh3_128_digest(b" ".join(line.split()).decode().lower().encode())


def _lines(data, offsets):
    """Start, end and text number of every \\n-split line."""
    breaks = np.flatnonzero(data == 10)
    texts = len(offsets) - 1
    start = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    end = np.sort(np.concatenate([offsets[1:], breaks]), kind="stable")
    count = np.bincount(np.searchsorted(offsets[1:], breaks, side="right"), minlength=texts) + 1
    return start, end, np.repeat(np.arange(texts), count)


def figures(column: pa.Array) -> pa.RecordBatch:
    """Base figures of each text, and its distinct normalised lines with the words they hold."""
    data, offsets = X.flat(column)
    texts = len(offsets) - 1
    words = X.Words(data, offsets)
    n_words = np.diff(words.first)
    word_code, _ = X.codes(words.array())

    begin = X.windows(words.first, 5)
    text_of = np.repeat(np.arange(texts), n_words)
    same, _ = X.codes(X.window_codes(word_code, begin, 5) * texts + text_of[begin])
    twice = begin[np.bincount(same, minlength=1)[same] > 1] if len(same) else begin
    steps = np.zeros(len(text_of) + 5, np.int64)
    steps[twice] += 1
    steps[twice + 5] -= 1
    repeated = np.cumsum(steps)[:len(text_of)] > 0

    start, end, owner = _lines(data, offsets)
    solid_before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(words.solid, out=solid_before[1:])
    line_code, distinct = X.codes(X.strings(data[data != 10], end - start))
    real = solid_before[end] > solid_before[start]
    line_words = np.searchsorted(words.start, end) - np.searchsorted(words.start, start)
    first_of, _ = X.codes(line_code[real] * texts + owner[real])
    distinct_lines = np.zeros(texts, np.int64)
    if len(first_of):
        seen = np.unique(first_of, return_index=True)[1]
        distinct_lines = np.bincount(owner[real][seen], minlength=texts)
    n_dup = np.bincount(owner[real], minlength=texts) - distinct_lines

    hashes = [line_hash(v) for v in X.as_list(distinct)]
    line_hashes = pa.array(hashes, pa.binary()).take(pa.array(line_code[real]))
    at = np.zeros(texts + 1, np.int32)
    np.cumsum(np.bincount(owner[real], minlength=texts), out=at[1:])
    lines = pa.ListArray.from_arrays(pa.array(at), pa.StructArray.from_arrays(
        [line_hashes, pa.array(line_words[real].astype(np.int32))], ["h", "w"]))
    return pa.RecordBatch.from_arrays(
        [pa.array(n_words), pa.array(X.per_text_bytes(words.solid & ((data & 0xC0) != 0x80), offsets)),
         pa.array(X.per_text_bytes(SYMBOLS[data], offsets)), pa.array(n_dup), pa.array(words.per_text(repeated)),
         lines],
        ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"])


def _digest(text: str) -> Column:
    """128 bits that name a text; Spark makes them, so that no second Python worker is needed beside one that reads the text."""
    return F.unhex(F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))))


def _row(names: list[str]) -> list[Column]:
    """The named columns as one; none for no names."""
    return [F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row")] if names else []


def _measured(docs: DataFrame, text: str, host: str, carried: list[str]) -> DataFrame:
    """Staged figures of every row, with a row number that stays as written."""
    # A carried text is read from its row, so that it is in a batch once.
    given = docs.select(F.col(f"`{host}`").alias("_host"), _digest(text).alias("digest"), *_row(carried),
                        *([] if text in carried else [F.col(f"`{text}`").alias("_text")]))
    named = ["_host", "digest", *["_row"] * bool(carried)]

    def work(batch):
        made = figures(batch.column("_row").field(carried.index(text)) if text in carried else batch.column("_text"))
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in named), *made.columns], [*named, *made.schema.names])

    out = map_batches(given, work, schema("_host string, digest binary", *[given.schema[c] for c in named[2:]], FIGURES))
    return stage(out.withColumn("_id", F.monotonically_increasing_id()), "line-figures")


def near_classes(docs: DataFrame, text: str) -> DataFrame:
    """Staged (digest, class): texts of one class are near duplicates; texts without words are one class."""
    with passing(docs.sparkSession) as keep:
        _, rows, labels = probminhash.links(docs.select(_digest(text).alias("digest"), F.col(f"`{text}`").alias("text")), doc="digest")
        known = rows.select(F.col("_doc").alias("digest"), "node").distinct().join(labels, "node", "left")
        return keep(stage(known.select("digest", F.coalesce("label", "node", F.lit(-1)).alias("class")), "near-classes"))


def frequent_lines(measured: DataFrame, rules: Rules, classes: DataFrame | None = None) -> DataFrame:
    """(host, line hash) of the lines above the host's limit; texts count by their class if `classes` are given."""
    texts = (measured.select("_host", "digest", "lines").groupBy("_host", "digest")
             .agg(F.any_value("lines").alias("lines")))
    if classes is not None:
        texts = stage(texts, "distinct-texts").join(classes, "digest")
    hosts = texts.groupBy("_host").agg((F.count("*") if classes is None else F.count_distinct("class")).alias("texts"))
    held = texts.select("_host", *["class"] * (classes is not None), F.explode(F.array_distinct(F.col("lines.h"))).alias("h"))
    held = ((held if classes is None else held.distinct())
            .groupBy("_host", "h").agg(F.count("*").alias("holders")).where(F.col("holders") > rules.least))
    return (held.alias("a").join(hosts.alias("b"), F.col("a._host").eqNullSafe(F.col("b._host")))
            .where(F.col("holders") > F.lit(rules.share) * F.col("texts")).select("a._host", "h", "holders"))


def _verdicts(measured: DataFrame, rules: Rules, classes: DataFrame | None) -> DataFrame:
    """Removed lines of every row that has any; one row per row number."""
    lines = measured.select("_id", "_host", F.explode("lines").alias("line")).select("_id", "_host", "line.h", "line.w")
    hit = lines.alias("l").join(frequent_lines(measured, rules, classes).alias("f"),
                                F.col("l._host").eqNullSafe(F.col("f._host")) & (F.col("l.h") == F.col("f.h")))
    return hit.groupBy("l._id").agg(F.count("*").alias("n_removed_lines"), F.sum(F.col("w").cast("long")).alias("n_removed_words"),
                                    F.collect_set("l.h").alias("removed"))


def _judged(measured: DataFrame, rules: Rules, classes: DataFrame | None) -> DataFrame:
    hit = _verdicts(measured, rules, classes).withColumnRenamed("_id", "_hit")
    zero = F.lit(0).cast("long")
    out = measured.drop("lines").join(hit, F.col("_id") == F.col("_hit"), "left").withColumns({
        "n_removed_lines": F.coalesce("n_removed_lines", zero), "n_removed_words": F.coalesce("n_removed_words", zero)})
    left = F.col("n_words") - F.col("n_removed_words")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    depleted = (left < rules.words_left) | (left < F.lit(rules.share_left) * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)


def judge(docs: DataFrame, rules: Rules = Rules(), text: str = "text", host: str = "source",
          carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns of every row, its figures and whether it is kept."""
    judged = _judged(_measured(docs, text, host, list(carry)), rules, near_classes(docs, text) if rules.near else None)
    return judged.select(*[F.col("_row").getField(c).alias(c) for c in carry], *RESULT)


def without_lines(column: pa.Array, removed: pa.Array) -> list:
    """Each text without the lines whose hash is in its list; others as they are."""
    out = []
    for value, gone in zip(column.to_pylist(), removed.to_pylist()):
        if value is not None and gone:
            gone = set(gone)
            value = "\n".join(x for x in value.split("\n") if not x.strip(" \t\n\v\f\r") or line_hash(x.encode()) not in gone)
        out.append(value)
    return out


def clean(docs: DataFrame, rules: Rules = Rules(), text: str = "text", host: str = "source") -> DataFrame:
    """The kept rows with all their columns, their text without the removed lines.

    Rows of one host and text have one verdict, so only the verdicts are staged, and the rows are read again.
    """
    names = docs.columns
    with passing(docs.sparkSession) as keep:
        judged = _judged(_measured(docs, text, host, []), rules, near_classes(docs, text) if rules.near else None)
        verdicts = judged.where("kept").select(F.col("_host").alias("_of"), F.col("digest").alias("_named"), "removed").dropDuplicates(["_of", "_named"])
        # Staged, so that the join can be split where very many rows are copies of a text.
        verdicts = keep(stage(verdicts, "line-verdicts"))
    rows = docs.select(F.col(f"`{host}`").alias("_host"), _digest(text).alias("digest"), *_row(names))
    judged = rows.join(verdicts, F.col("_host").eqNullSafe(F.col("_of")) & (F.col("digest") == F.col("_named"))).select("_row", "removed")
    place = names.index(text)

    def work(batch):
        row = batch.column("_row")
        fields = [row.field(i) for i in range(len(names))]
        fields[place] = pa.array(without_lines(fields[place], batch.column("removed")), pa.string())
        return pa.RecordBatch.from_arrays(fields, names)

    return map_batches(judged, work, docs.schema)
