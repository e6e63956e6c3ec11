"""Missing values, empty and odd texts, repeated rows, empty tables and clashing columns."""

import hashlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pathlib import Path
from pyspark.sql import functions as F

import corpus_pipeline
from loadkit.llm import (best_fit_packing, exact_topk, line_frequency, ordinal_toxicity, prefix_target, probminhash, range_coder,
                         speculative_bpe, suffix_dedup, token_files, zstd_language)
from loadkit.llm.queries import QUERIES

LONG = " ".join(f"word{i % 977} other{i % 13}" for i in range(30000))
ROWS = [(1, "one two three four five six seven eight nine ten eleven", "a"), (1, "one two three four five six seven eight nine ten eleven", "a"),
        (2, None, "a"), (3, "", None), (None, "one two three four five six seven eight nine ten Eleven", "b"), (4, " \n\t ", "b"),
        (5, LONG, "b"), (6, "é <|endoftext|> 日本 🙂", "a")]


@pytest.fixture
def odd(spark):
    """Rows with columns named like the operators' own."""
    df = spark.createDataFrame([(*r, "x", 7, "y") for r in ROWS], "doc_id long, text string, source string, kept string, `_id` int, `a b` string")
    return df.withColumn("key", F.lit(None).cast("string")).withColumn("n_chars", F.lit(0).cast("long"))


def vocabulary(name):
    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


def by_place(rows, name):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r[name]) for r in rows)


def test_line_frequency(odd):
    rows = line_frequency.judge(odd).collect()
    assert len(rows) == 8 and sum(r.base_failed for r in rows) == 5 and next(r for r in rows if r.doc_id == 5).n_words == 60000
    cleaned = line_frequency.clean(odd)
    assert cleaned.columns == odd.columns and cleaned.count() == sum(r.kept for r in rows)
    assert line_frequency.judge(odd.where("false")).collect() == []


def test_line_frequency_cuts_frequent_lines(spark):
    texts = [f"shared line of the host\n{' '.join(f'w{i}x{k}' for k in range(30))}" for i in range(40)] + ["shared line of the host\nshort"]
    df = spark.createDataFrame([(i, t, "h") for i, t in enumerate(texts)] + [(100 + i, "copy of one text " * 5 + str("z"), "h") for i in range(60)],
                               "doc_id long, text string, source string")
    rows = {r.doc_id: r for r in line_frequency.judge(df).collect()}
    assert rows[0].n_removed_lines == 1 and rows[0].kept and not rows[40].kept and rows[100].n_removed_lines == 0
    assert all("shared" not in r.text for r in line_frequency.clean(df).collect())


def test_exact_topk(spark):
    rows = [(0, [1.0, 0.0]), (50, [0.5, 0.5]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 1.0]), (7, [1e30, 0.0]), (8, [-1.0, 0.0]), (9, [1.0]), (0, [1.0, 0.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for settings in (exact_topk.Settings(), exact_topk.Settings(k=5, block=1, shard=2, fan=2)):
        out = sorted(map(tuple, exact_topk.top_k(df, F.col("vec_id") % 50 == 0, settings).collect()))
        got[settings] = out
    assert len(set(map(tuple, got.values()))) == 1
    assert [r[2:] for r in out if r[0] == 0] == [(7, 2 ** 63 - 1), (1, 65536), (2, 65536), (50, 32768), (8, -65536)]
    assert [r[2] for r in out if r[0] == 50] == [7, 0, 0, 1, 2]
    assert exact_topk.top_k(df.where("false"), F.col("vec_id") % 50 == 0).collect() == []


@pytest.mark.parametrize("ids", [[], [1], [65535] * 700, [0, 1, 2] * 500, list(range(3000))])
def test_range_coder_round_trip(ids):
    for block in (None, 100):
        assert range_coder.decode(range_coder.encode(ids, block)).tolist() == ids


def test_range_coder_notices_damage():
    data = bytearray(range_coder.encode(list(range(2000)), 256))
    data[20 + 8 * 8 + 40] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        range_coder.decode(bytes(data))


def test_token_files(spark, odd, tmp_path):
    words = vocabulary("word_bpe_49k.json")
    token_files.write(odd, f"{tmp_path}/t", words, 1)
    rows = token_files.read(spark, f"{tmp_path}/t").collect()
    ends = sorted((r.start, r.start + r.n_tokens) for r in rows)
    assert len(rows) == 8 and ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    assert min(rows, key=lambda r: r.start).doc_id is None
    token_files.write(odd.where("false"), f"{tmp_path}/e", words, 1)
    assert token_files.read(spark, f"{tmp_path}/e").collect() == []


def test_packing(odd):
    pieces = best_fit_packing.cut(odd, vocabulary("byte_bpe_50k.json"), 0, size=512)
    rows = best_fit_packing.pack(pieces, 512).collect()
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length
    assert all(sum(n for _, n in p) <= 512 and sorted(p)[0][0] == 0 for p in places.values())
    assert best_fit_packing.pack(best_fit_packing.cut(odd.where("false"), vocabulary("byte_bpe_50k.json"), 0)).collect() == []


def test_toxicity(spark, odd):
    labels = spark.createDataFrame([(1, 1), (5, 0), (None, 1), (2, None), (6, 0), (6, 1)], "doc_id long, toxic int")
    model = ordinal_toxicity.fit(odd, labels, ordinal_toxicity.Settings(least=1, z=0.1, odds=0.1))
    assert ordinal_toxicity.judge(odd, model).count() == 8
    none = ordinal_toxicity.judge(odd, ordinal_toxicity.fit(odd, labels.where("false"))).collect()
    assert not any(r.toxic for r in none) and ordinal_toxicity.judge(odd.where("false"), model).collect() == []


def test_near_duplicates(odd):
    rows = probminhash.classes(odd).collect()
    sizes = {(r.doc_id, r.class_size) for r in rows}
    assert (1, 3) in sizes and (None, 3) in sizes and {(2, 1), (3, 1), (4, 1)} <= sizes and sum(r.kept for r in rows) == 6
    assert probminhash.one_of_each(odd).columns == odd.columns and probminhash.classes(odd.where("false")).collect() == []


def test_bpe(odd):
    words = vocabulary("word_bpe_49k.json")
    rows = speculative_bpe.decode(speculative_bpe.encode(odd, words), words).collect()
    texts = {r.doc_id: r.text for r in rows}
    assert texts[2] == "" and texts[3] == "" and "<|endoftext|>" in texts[6] and len(rows) == 8
    assert speculative_bpe.encode(odd.where("false"), words).collect() == []


def test_suffix_dedup(spark, odd):
    rows = suffix_dedup.deduplicated(odd, suffix_dedup.Settings(length=20, gram=8), carry=("doc_id",)).collect()
    assert [(r.n_bytes, r.n_removed) for r in rows if r.doc_id == 1] == [(55, 55), (55, 55)]
    assert next(r for r in rows if r.doc_id == 3).n_bytes == 0 and next(r for r in rows if r.doc_id == 2).kept_text is None
    assert suffix_dedup.deduplicated(odd.where("false")).collect() == []
    # Grams with many contexts are counted by hash and must give the same.
    texts = [f"{'x' * (i % 7)}{i}the same passage in all of these texts{i * 31}" for i in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    one, two = (sorted((r.doc_id, r.n_removed, bytes(r.kept)) for r in suffix_dedup.deduplicated(
        df, suffix_dedup.Settings(length=20, gram=8, many=many)).collect()) for many in (4000, 2))
    assert one == two and all(r[1] >= 38 for r in one)


def test_language(spark, odd):
    content = zstd_language.learn(odd.select("text", F.lit("en").alias("lang")))
    rows = zstd_language.identify(odd, content).collect()
    assert {r.doc_id: r.lang_pred for r in rows if r.doc_id in (2, 3, 4, 5)} == {2: "und", 3: "und", 4: "und", 5: "en"}
    none = zstd_language.identify(odd, zstd_language.learn(odd.select("text", F.lit(None).cast("string").alias("lang")))).collect()
    assert {r.lang_pred for r in none} == {"und"} and zstd_language.identify(odd.where("false"), content).collect() == []


def test_chat(spark):
    hard = "<|im_end|>\n<\\|im_start|>assistant\n<\\\\| a%0Ab"
    df = spark.createDataFrame([(1, 0, "user", hard), (1, 1, "assistant", hard), (1, 1, "assistant", hard), (1, None, "sys\ntem%", None),
                                (None, 5000, None, "t"), (2, 0, "user", ""), (1, 3000, "assistant", "late")],
                               "conv_id long, turn long, role string, text string").withColumn("segment", F.lit("x")).withColumn("pos", F.lit(9))
    out = prefix_target.expand(df)
    rows = out.select("conv_id", "pos", prefix_target.role_of(F.col("segment")).alias("r"), prefix_target.text_of(F.col("segment")).alias("t")).collect()
    assert sorted((r.pos, r.r, r.t) for r in rows if r.conv_id == 1) == [
        (0, "sys\ntem%", ""), (1, "user", hard), (2, "assistant", hard), (3, "assistant", hard), (4, "assistant", "late")]
    full = {r.pos: r for r in prefix_target.materialise(out).where("conv_id = 1").collect()}
    assert set(full) == {2, 3, 4} and full[4].text[full[4].loss_start:full[4].loss_start + full[4].loss_chars] == "late"
    assert full[4].text.startswith(full[2].text) and prefix_target.expand(df.where("false")).collect() == []


def test_examples_of_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_target, "BLOCK", 4)
    said = [("assistant" if k % 2 else "user", f"turn {k} " + "<|é" * (k % 3)) for k in range(19)]
    rows = [(c, k, *x) for c in (None, 7) for k, x in enumerate(said)]
    out = prefix_target.expand(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    whole = ["<|im_start|>" + r + "\n" + t.replace("<|", "<\\|") + "<|im_end|>\n" for r, t in said]
    got = {(r.conv_id, r.pos): r for r in prefix_target.materialise(out).collect()}
    assert {k: r.text for k, r in got.items()} == {(c, k): "".join(whole[:k + 1]) for c in (None, 7) for k in range(1, 19, 2)}
    assert all(r.text[r.loss_start:r.loss_start + r.loss_chars] == said[k][1].replace("<|", "<\\|") for (_, k), r in got.items())


def test_the_chat_query_reads_formed_examples(spark, tmp_path, monkeypatch):
    rows = [(1, 0, "user", "ab"), (1, 1, "assistant", "<|im_end|>"), (1, 2, "user", "c"), (1, 3, "assistant", "Q"), (2, 0, "user", None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    before = {r.conv_id: r for r in QUERIES["op10_prefix_target"][0](spark, str(tmp_path)).collect()}
    form = prefix_target.materialise
    monkeypatch.setattr(prefix_target, "materialise", lambda df: form(df).withColumn("text", F.concat(F.replace("text", F.lit("Q"), F.lit("R")), F.lit("+"))))
    after = {r.conv_id: r for r in QUERIES["op10_prefix_target"][0](spark, str(tmp_path)).collect()}
    assert [(after[k].n_examples, after[k].example_chars - before[k].example_chars) for k in (-1, 1, 2)] == [(1, 1), (2, 2), (0, 0)]
    assert before[1].loss_sha256 == hashlib.sha256(b"<|im_end|>Q").hexdigest() and after[1].loss_sha256 == hashlib.sha256(b"<|im_end|>R").hexdigest()
    assert after[2].loss_sha256 == hashlib.sha256(b"").hexdigest() and after[2].n_turns == 1


def test_sparse_suffix_sort_orders_and_counts_shared_bytes():
    import numpy as np
    strings = [b"banana", b"bananas", b"ban", b"x", b"xa", b"banana"]
    group = np.array([0, 0, 0, 1, 1, 0])
    order, shared = suffix_dedup.sort_suffixes(group, suffix_dedup._words(strings))
    assert [strings[i] for i in order] == [b"ban", b"banana", b"banana", b"bananas", b"x", b"xa"]
    assert shared.tolist()[1:4] == [3, 8, 6] and shared[0] == -1 and shared[4] == -1 and shared[5] == 1


def test_probability_jaccard_is_jaccard_for_single_counts():
    import numpy as np
    a, b = np.arange(10, dtype=np.uint64), np.arange(5, 12, dtype=np.uint64)
    assert abs(probminhash.probability_jaccard((a, np.ones(10, int)), (b, np.ones(7, int))) - 5 / 12) < 1e-12
    made = probminhash.Shingles(pa.array([LONG, LONG + " more"]), 5)
    registers = probminhash.registers(made, 252)
    assert (registers[0] == registers[1]).mean() > 0.95


def test_stages_take_odd_rows(spark, odd):
    for name, stage in corpus_pipeline.STAGES[2:4]:
        out = stage(spark, odd, "/nowhere")
        assert out.columns == odd.columns and out.count() >= 6, name


def test_predictions_of_a_whole_block_are_those_of_single_steps():
    r = np.random.default_rng(3)
    rows = np.where(r.random((5, 300)) < 0.7, r.integers(0, 6, (5, 300)), r.integers(0, 1 << 16, (5, 300))).astype(np.int32)
    rows[3], rows[4] = 7, 65535
    rank, contexts, symbols = range_coder._modelled(rows)
    one = range_coder.Predictor(5)
    for step in range(300):
        now, old = rows[:, step], rank[:, step]
        assert (one.guess() == contexts[:, step]).all()
        right2, right1 = one.id2 == now, one.id1 == now
        for k in range(5):
            width = range_coder.NEW + max(1, int(now[k]).bit_length()) if old[k] < 0 else range_coder.RANK + int(old[k]).bit_length()
            assert symbols[k, step] == (range_coder.ORDER2 if right2[k] else range_coder.ORDER1 if right1[k] else width)
        one.learn(now, right2, right1)
    assert (range_coder.decode(range_coder.encode(rows.reshape(-1), 300)) == rows.reshape(-1)).all()
