"""What language identification learns from, and its scores by plain calls of the compressor."""

import zlib

import numpy as np
import zstandard
from pyspark.sql import functions as F

from loadkit.llm import zstd_language as Z

WORDS = {"aa": "lorem ipsum dolor sit amet consectetur elit sed".split(), "bb": "der die das und nicht mit einem wir".split()}


def labelled(spark, copies=3000, texts=60):
    rows = [(f"{lang} " + " ".join(words[(i * k + k) % len(words)] for k in range(40)) + f" {i}", lang) for lang, words in WORDS.items() for i in range(texts)]
    df = spark.createDataFrame(rows, "text string, lang string")
    hot = spark.range(copies).select(F.lit("der hot text und mit").alias("text"), F.lit("bb").alias("lang"))
    return df.unionAll(hot).unionAll(spark.createDataFrame([(None, "aa"), ("", "bb"), ("x", None)], "text string, lang string"))


def test_copies_of_a_text_are_one_of_the_sample(spark):
    df = labelled(spark)
    rows = Z.sampled(df, Z.Settings(sample=20)).collect()
    assert {lang: sum(r.lang == lang for r in rows) for lang in WORDS} == {"aa": 20, "bb": 20}
    every = Z.sampled(df, Z.Settings(sample=1000)).collect()
    assert len(every) == 121 and len({(r.lang, r.text) for r in every}) == 121
    assert sorted(map(tuple, Z.sampled(df, Z.Settings(sample=20, few=0)).collect())) == sorted(map(tuple, rows))
    assert Z.sampled(df.repartition(7), Z.Settings(sample=20)).exceptAll(Z.sampled(df, Z.Settings(sample=20))).collect() == []


def test_answers_equal_plain_compression(spark):
    settings = Z.Settings(block=64)
    content = Z.learn(labelled(spark), settings)
    texts = ["wir und die mit einem", "lorem dolor sed", "Der die das! " * 40, "12 ..", None, "", "elit und", "q"]
    rows = Z.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), content, settings).orderBy("doc_id").collect()
    for row, text in zip(rows, texts):
        if not text or not any(map(str.isalpha, text)):
            assert (row.lang_pred, row.score, row.accepted) == ("und", 0.0, False)
            continue
        raw, sizes = " ".join(Z.LETTERS.findall(text.lower())).encode(), []
        for lang in sorted(content):
            held = zstandard.ZstdCompressionDict(content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            packer = zstandard.ZstdCompressor(level=9, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes.append(sum(len(packer.compress(raw[k:k + 64])) for k in range(0, len(raw), 64)))
        assert row.lang_pred == sorted(content)[int(np.argmin(sizes))]
        assert abs(row.score - 1 / sum(2.0 ** (min(sizes) - n) for n in sizes)) < 1e-12
        assert row.accepted == ((max(sizes) - min(sizes)) / min(sizes) >= 0.01)


def test_ties_go_to_the_first_language(spark):
    rows = Z.identify(spark.createDataFrame([(1, "zz yy")], "doc_id long, text string"), {"b": b"same words", "a": b"same words"}).collect()
    assert rows[0].lang_pred == "a" and rows[0].margin == 0.0 and not rows[0].accepted and rows[0].score == 0.5


def test_held_out_rows_follow_the_checksum(spark):
    ids = [0, 1, 2, 17, -5, 10 ** 12]
    rows = spark.createDataFrame([(i,) for i in [*ids, None]], "doc_id long").select("doc_id", Z.held_out(F.col("doc_id")).alias("h")).collect()
    assert [r.h for r in rows] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in ids] + [False]
