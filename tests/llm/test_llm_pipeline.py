"""Stages of the pipeline on planted rows, against plain Python."""

import collections
import math
import random
import re
import struct
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from loadkit.llm import line_frequency, ordinal_toxicity, probminhash, suffix_dedup


def words(seed, n, short=False):
    r = random.Random(seed)
    return [("".join(r.choices("abcdefghij", k=1 if short else r.randint(2, 8)))) for _ in range(n)]


def without_passages(texts, many=51):
    """Each text without the windows of `many` words whose bytes occur more than once."""
    places = [[m.span() for m in re.finditer(r"[^ \t-\r]+", t)] for t in texts]
    at = [[(p[i][0], p[i + many - 1][1]) for i in range(len(p) - many + 1)] for p in places]
    times = collections.Counter(t[a:b] for t, spans in zip(texts, at) for a, b in spans)
    out = []
    for t, spans in zip(texts, at):
        gone = {x for a, b in spans if times[t[a:b]] > 1 for x in range(a, b)}
        out.append("".join(c for x, c in enumerate(t) if x not in gone))
    return out


def test_passages_of_over_50_words_are_cut(spark):
    def shared(seed, n, docs, short=False):
        middle = words(seed, n, short)
        return [" ".join([*words(f"{seed} {k}", 40), *middle, *words(f"{seed} {k} after", 30)]) for k in range(docs)]

    chain = words(99, 90)
    texts = [*shared(1, 51, 2), *shared(2, 50, 2), *shared(3, 51, 2, short=True), *shared(4, 80, 3), "", "é " * 20,
             # Three parts of 30 words that repeat in different places are no passage of over 50.
             " ".join(chain), " ".join([*words(5, 9), *chain[:40], *words(6, 9)]), " ".join([*words(7, 9), *chain[35:75], *words(8, 9)]),
             " ".join([*words(9, 9), *chain[55:], *words(10, 9)])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.repeated_passages(spark, df, "").collect()}
    assert [got[k] for k in range(len(texts))] == without_passages(texts)
    assert [len(got[k].split()) for k in (0, 2, 4, 6)] == [70, 120, 70, 70] and len(" ".join(words(1, 51))) < 400


def test_passages_are_found_by_sorted_suffixes(spark):
    """Spans of windows of 5 words, with contexts sorted, counted as too many, and counted as too wide."""
    r, pool = random.Random(4), words("pool", 40)

    def some(k):
        a = r.randrange(30)
        return r.choice([words(r.random(), 3, k % 2), pool[a:a + r.randint(3, 10)], ["é" * 90]])

    texts = [(" " if k % 3 else "  ").join(x for _ in range(r.randint(0, 9)) for x in some(k)) for k in range(120)]
    texts += [texts[7], "", None, "a b c d e f\0", "a b c d e f", "x a b c d e"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = without_passages([t or "" for t in texts], 5)
    assert sum(map(len, expected)) < 0.8 * sum(len(t or "") for t in texts)
    for changed in ({}, {"many": 3}, {"wide": 60}):
        settings = suffix_dedup.Settings(length=9, gram=5, words=4, **changed)
        got = {row.doc_id: row.kept_text for row in suffix_dedup.deduplicated(df, settings).collect()}
        assert [got[k] or "" for k in range(len(texts))] == expected, changed


def test_windows_of_words_in_sorted_contexts():
    import numpy as np
    contexts = [b"p a bb c d q", b"x a bb c d", b"a bb c dd", b"a bb c d"]
    got = suffix_dedup.repeated_word_windows(np.array([0, 0, 0, 1]), contexts, np.array([c.index(b"bb") for c in contexts]), 4)
    assert sorted(zip(*(x.tolist() for x in got))) == [(0, 2, 10), (1, 2, 10)]


def test_pieces_of_a_long_text_hold_each_window_once(monkeypatch):
    import numpy as np
    monkeypatch.setattr(suffix_dedup, "PART", 40)
    text = " ".join(words("parts", 300)).encode()
    whole = suffix_dedup.word_windows(np.frombuffer(text, np.uint8), np.array([0, len(text)]), 5)
    found = []
    for piece, bounds, _, begins in suffix_dedup._parts(np.frombuffer(text, np.uint8), np.array([0, len(text)]), suffix_dedup.Settings(9, 5, words=4)):
        _, _, start, end = suffix_dedup.word_windows(piece, bounds, 5)
        found += zip((start + begins[0]).tolist(), (end + begins[0]).tolist())
    assert found == list(zip(whole[2].tolist(), whole[3].tolist()))


def test_a_group_of_near_copies_leaves_one_document(spark, tmp_path):
    def lines(seed):
        made = words(seed, 120)
        return [" ".join(made[k:k + 12]) for k in range(0, 120, 12)]

    footer, group = "the footer of this host", lines("group")
    near = []
    for k in range(60):
        changed = [x.split(" ") for x in group]
        changed[k % 10][k % 7] = f"changed{k}"
        near.append("\n".join(" ".join(x) for x in changed))
    others = ["\n".join([*lines(f"own {k}"), *[footer] * (k < 30)]) for k in range(120)]
    df = spark.createDataFrame([(k, t, "host") for k, t in enumerate(near + others)], "doc_id long, text string, source string")
    first = corpus_pipeline.quality(spark, df, "")
    kept = {r.doc_id: r.text for r in first.collect()}
    assert [kept.get(k) for k in range(60)] == near
    assert [kept.get(60 + k) for k in range(120)] == [t.removesuffix("\n" + footer) for t in others]
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    second = corpus_pipeline.toxicity(spark, first, str(tmp_path))
    alone = corpus_pipeline.near_duplicates(spark, second, "").collect()
    assert sorted(r.doc_id for r in alone) == [0, *range(60, 180)]
    # The query's contract counts exact copies only.
    assert not any(r.kept for r in line_frequency.judge(df).collect() if r.doc_id < 60)


def test_copies_meet_in_plain_joins(spark):
    text = " ".join(words("copy", 90))
    docs = [(k, text, "x" * 50) for k in range(40)] + [(100 + k, " ".join(words(f"own {k}", 90)), "y") for k in range(5)]
    df = spark.createDataFrame(docs, "doc_id long, text string, other string")

    def aggregates(out):
        return out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate")

    one = probminhash.one_of_each(df)
    assert aggregates(one) == aggregates(probminhash.classes(df)) == aggregates(suffix_dedup.deduplicated(df)) == 0
    assert sorted(map(tuple, one.collect())) == sorted([docs[0], *docs[40:]])
    assert sorted((r.doc_id, r.class_id, r.class_size, r.kept) for r in probminhash.classes(df).collect())[39:41] == [(39, 0, 40, False), (100, 100, 1, True)]


def test_an_empty_table_passes_through_all_stages(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.collect() == [] and {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns)


def test_packing_places_the_librarys_ids(spark):
    texts = [None, "", *[" ".join(words(f"pack {k}", 1 + 37 * k % 900)) for k in range(60)], "long " * 9000, "copy", "copy"]
    rows = corpus_pipeline.packing(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "").collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, places = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r), places[r.sequence_id].append((r.offset, r.length))
    for k, text in enumerate(texts):
        ids, at = [*library.encode(text or "", add_special_tokens=False).ids, 0], 0
        for r in sorted(by_doc[k], key=lambda r: r.piece):
            assert r.start == at and r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *ids[at:at + r.length]))
            at += r.length
        assert at == len(ids)
    for held in places.values():
        ends = [a + n for a, n in sorted(held)]
        assert [a for a, _ in sorted(held)] == [0, *ends[:-1]] and ends[-1] <= 2048
    total = sum(r.length for r in rows)
    assert len(places) <= -(-total // 2048) + 1


def test_toxicity_keeps_what_a_plain_score_keeps(spark):
    """The stage's verdicts, by counting features and summing weights in plain Python."""
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = ordinal_toxicity.fit(docs, labels)
    settings, kept = ordinal_toxicity.Settings(), set()
    judged = {r.doc_id: r for r in ordinal_toxicity.judge(docs, model).collect()}
    for r in docs.collect():
        times = collections.Counter(f for w in re.findall(r"[^\W\d_]+", (r.text or "").lower())
                                    for f in [w, *[w[:k] + "*" for k in settings.prefixes if len(w) > k]] if f in model.weights)
        score = sum(math.log1p(n) * model.weights[f] for f, n in times.items())
        below = [1 / (1 + math.exp(-max(-40, min(40, c - score)))) for c in model.cuts]
        severity = sum(1 - b for b in below)
        assert abs(judged[r.doc_id].expected_severity - severity) < 1e-9 and list(model.cuts) == sorted(model.cuts)
        if severity < settings.limit:
            kept.add(r.doc_id)
    assert {r.doc_id for r in corpus_pipeline.toxicity(spark, docs, sf).collect()} == kept and len(kept) < len(judged)


def test_rows_that_repeat_an_id_are_one_labelled_document(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, "c"), (3, None), (3, "d"), (4, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(6)], "doc_id long, toxic int")
    rows = ordinal_toxicity.labelled_sample(docs, labels, ordinal_toxicity.Settings()).collect()
    assert sorted((r.doc, r.text, r.toxic) for r in rows if r.text) == [(1, "a", 1), (2, "c", 0), (3, "d", 1)] and len(rows) == 4


def test_registers_hold_few_arrivals_at_once():
    import tracemalloc

    import pyarrow as pa

    from loadkit.llm import probminhash
    made = probminhash.Shingles(pa.array([" ".join(f"w{(7 * i + k) % 5000}" for k in range(60)) for i in range(1000)] + [None, "one"]), 5)
    tracemalloc.start()
    found = probminhash.registers(made, 252)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6 and found.shape == (1002, 252)
    alone = probminhash.Shingles(pa.array([" ".join(f"w{(7 * 400 + k) % 5000}" for k in range(60))]), 5)
    assert (probminhash.registers(alone, 252)[0] == found[400]).all() and not found[1000].any() and found[1001].all()


def test_quality_has_one_python_worker_a_task(spark, monkeypatch):
    from loadkit.llm import line_frequency, probminhash

    class Seen(Exception):
        pass

    def links(docs, **named):
        assert "MapInArrow" not in docs._jdf.queryExecution().toString() and docs.columns == ["digest", "text"]
        raise Seen

    monkeypatch.setattr(probminhash, "links", links)
    with pytest.raises(Seen):
        line_frequency.near_classes(spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string"), "text")


def test_only_tables_that_are_still_read_stay_on_disk(spark, tmp_path, monkeypatch):
    from loadkit.llm import shared

    monkeypatch.setattr(shared, "shared_dir", lambda _: str(tmp_path))
    left = lambda: sorted(x.name[:-33] for x in tmp_path.iterdir())
    passage = " ".join(words("passage", 60))
    rows = [(k, f"{passage}\n" + " ".join(words(k, 40)), "web") for k in (1, 2, 3)] + [(4, " ".join(words(2, 40)) + " end", "web"), (None, None, None)]
    docs = spark.createDataFrame([*rows, rows[0]], "doc_id long, text string, source string")

    kept = line_frequency.clean(docs, line_frequency.Rules(near=True))
    assert left() == ["line-verdicts"] and sorted(r.doc_id for r in kept.collect()) == [1, 1, 2, 3, 4]
    kept = probminhash.one_of_each(docs)
    assert left() == ["classes", "line-verdicts", "sketches"] and kept.count() == 5
    cut = suffix_dedup.deduplicated(docs, suffix_dedup.PASSAGES)
    assert left() == ["classes", "line-verdicts", "sketches", "spans"]
    assert sorted(r.n_removed > 0 for r in cut.collect()) == [False, False, True, True, True, True]

    with pytest.raises(ZeroDivisionError), shared.passing(spark) as keep:
        shared.stage(docs, "gone")
        with shared.passing(spark) as keep_inner:
            outer, _ = keep_inner(shared.stage(docs, "outer")), shared.stage(docs, "inner")
        assert left()[2:4] == ["line-verdicts", "outer"] and "inner" not in left() and outer.count() == 6
        keep(outer)
        1 / 0
    assert left() == ["classes", "line-verdicts", "outer", "sketches", "spans"]
