"""Language identification by compression.

Every language has a zstandard raw-content dictionary made of sample texts. A
text is compressed in blocks with the dictionary of each language; the language
with the smallest total wins, and the answer is marked as not accepted when the
margin to the next is narrow. Blocks keep a long text from teaching the
compressor its own words, so every part of the text has its say.

Defined results. A missing text, or one without a letter, is `und` with score 0
and not accepted; so is every text when no labelled text is there to learn
from. Ties go to the first language by name. Rows that repeat a doc_id are each
answered; an empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadkit.llm.shared import columns, map_batches, stage

NONE = "und"
LETTERS = re.compile(r"[^\W\d_]+")


def plain(text: str) -> bytes:
    """The words in lower case with a space between; signs and digits say little about a language."""
    return " ".join(LETTERS.findall(text.lower())).encode()


@dataclass(frozen=True)
class Settings:
    """The dictionaries learn from `sample` distinct texts of a language (all, if
    there are fewer), a piece of `piece` characters of each, up to `dictionary`
    bytes; `block` bytes are compressed at a time. An answer needs a margin of
    `margin` of the smallest size to be accepted. Up to `few` chosen texts are
    broadcast."""

    sample: int = 1200
    piece: int = 400
    dictionary: int = 256 << 10
    block: int = 8 << 10
    level: int = 9
    margin: float = 0.01
    few: int = 1_000_000


def held_out(doc: Column) -> Column:
    """Documents that are never learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc.cast("string")) % 4 == 2, F.lit(False))


def sampled(labelled: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(lang, at, text): a piece of each of the `sample` distinct texts of a language with the smallest hashes.

    Copies of a text count once, so that a text in very many rows neither fills
    the sample nor is shuffled: only (language, hash) is, and what is chosen of
    it, `sample` rows per language, is counted before it is broadcast.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") > 0))
    rows = rows.withColumn("at", F.xxhash64("text", F.lit(9)))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("at"))
    first = rows.select("lang", "at").distinct().withColumn("nth", nth).where(F.col("nth") <= settings.sample)
    chosen = stage(first.select("lang", "at"), "language-sample")
    if chosen.count() <= settings.few:
        chosen = F.broadcast(chosen)
    span = F.greatest(F.length("text") - settings.piece, F.lit(0)) + 1
    piece = F.substr("text", (F.pmod(F.xxhash64("text", F.lit(3)), span) + 1).cast("int"), F.lit(settings.piece))
    return rows.join(chosen, ["lang", "at"]).groupBy("lang", "at").agg(F.min(piece).alias("text"))


def learn(labelled: DataFrame, settings: Settings = Settings()) -> dict[str, bytes]:
    """Dictionary content per language, from rows (text, lang).

    The sample is chosen by hash, so it does not depend on partitions; at most
    `sample` pieces of each language reach the driver.
    """
    content: dict[str, list[bytes]] = {}
    for row in sorted(sampled(labelled, settings).collect(), key=lambda r: (r.lang, r.at, r.text)):
        content.setdefault(row.lang, []).append(plain(row.text))
    return {lang: b"\n".join(dict.fromkeys(texts))[:settings.dictionary] for lang, texts in content.items()}


class Scorer:
    """Compressed sizes of texts under every language."""

    def __init__(self, content: dict[str, bytes], settings: Settings):
        self.langs, self.settings, self.packers = sorted(content), settings, []
        for lang in self.langs:
            body = zstandard.ZstdCompressionDict(content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            body.precompute_compress(level=settings.level)
            self.packers.append(zstandard.ZstdCompressor(level=settings.level, dict_data=body, write_content_size=False,
                                                         write_checksum=False, write_dict_id=False))

    def sizes(self, text: str) -> np.ndarray:
        raw, step = plain(text), self.settings.block
        return np.array([sum(len(p.compress(raw[k:k + step])) for k in range(0, len(raw), step)) for p in self.packers])

    def answer(self, text: str | None) -> tuple[str, float, float, bool]:
        """Language, score from 0 to 1, margin and whether the margin is wide enough."""
        if not self.langs or text is None or not any(map(str.isalpha, text)):
            return NONE, 0.0, 0.0, False
        size = self.sizes(text)
        best = int(size.argmin())
        score = float(1 / np.exp2(np.maximum(-(size - size[best]), -60.0)).sum())
        if len(size) == 1:
            return self.langs[0], score, 1.0, True
        margin = float((np.partition(size, 1)[1] - size[best]) / size[best])
        return self.langs[best], score, margin, margin >= self.settings.margin


def identify(docs: DataFrame, content: dict[str, bytes], settings: Settings = Settings(), doc: str = "doc_id",
             text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, margin, accepted for every row."""
    given = columns(docs, doc=doc, text=text)
    shipped = docs.sparkSession.sparkContext.broadcast(content)
    made: list[Scorer] = []

    def work(batch):
        if not made:
            made.append(Scorer(shipped.value, settings))
        rows = [made[0].answer(t) for t in batch.column("text").to_pylist()]
        lang, score, margin, accepted = map(list, zip(*rows))
        return pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(lang), pa.array(score), pa.array(margin), pa.array(accepted)],
                                          ["doc_id", "lang_pred", "score", "margin", "accepted"])

    kind = given.schema["doc"].dataType.simpleString()
    return map_batches(given, work, f"doc_id {kind}, lang_pred string, score double, margin double, accepted boolean")
