"""Registered queries on the smallest tables, against SQL or a brute-force version."""

import collections
import hashlib
import struct
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from loadkit.llm.oracle import SQL
from loadkit.llm.queries import QUERIES
from verification import compare

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, name):
    con = compare.oracle_connection(SF)
    ok, account = compare.compare(spark, con, QUERIES[name][0], SQL[name], SF)
    con.close()
    assert ok, account


def test_op3_equals_the_library(spark, docs):
    library, start, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0, {}
    for d in sorted(docs):
        ids = [*library.encode(docs[d].text or "", add_special_tokens=False).ids, 1]
        want[d] = (start, len(ids), zlib.crc32(packed(ids)))
        start += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op3_context_mixing_coder"][0](spark, SF).collect()}
    assert got == want


def test_op4_packs_the_librarys_ids(spark, docs):
    library, rows = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), QUERIES["op4_best_fit_packing"][0](spark, SF).collect()
    by_doc, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r), sequences[r.sequence_id].append((r.offset, r.length))
    total = 0
    for d, row in docs.items():
        ids, at = [*library.encode(row.text or "", add_special_tokens=False).ids, 0], 0
        for r in sorted(by_doc[d], key=lambda r: r.piece):
            assert r.start == at and r.ids_crc32 == zlib.crc32(packed(ids[at:at + r.length])) and (r.piece == 0 or r.length == 2048)
            at += r.length
        assert at == len(ids)
        total += at
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-total // 2048) + 1


def test_op5_finds_the_labelled(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = QUERIES["op5_ordinal_toxicity"][0](spark, SF).collect()
    right = [r.toxic == bool(labels[r.doc_id]) for r in rows if r.doc_id in labels]
    assert len(rows) == 200 and sum(right) / len(right) > 0.85
    assert all(0 <= r.expected_severity <= 3 and r.kept != r.toxic for r in rows)


def test_op6_equals_brute_force(spark, docs):
    def shingles(text):
        w = text.lower().split()
        return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    sets, parent = {d: shingles(r.text or "") for d, r in docs.items()}, {d: d for d in docs}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    order = sorted(docs)
    for i, a in enumerate(order):
        for b in order[i + 1:]:
            if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    rows = QUERIES["op6_probminhash"][0](spark, SF).collect()
    assert {r.doc_id: r.class_id for r in rows} == {d: root(d) for d in docs}
    assert {r.doc_id for r in rows if r.kept} == {root(d) for d in docs}


def test_op7_equals_the_library(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in QUERIES["op7_speculative_bpe"][0](spark, SF).collect():
        ids = library.encode(docs[r.doc_id].text or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(packed(ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_op8_equals_brute_force(spark, docs):
    raws, size = {d: (r.text or "").encode() for d, r in docs.items()}, 400
    times = collections.Counter(raw[p:p + size] for raw in raws.values() for p in range(len(raw) - size + 1))
    for r in QUERIES["op8_suffix_dedup"][0](spark, SF).collect():
        raw = raws[r.doc_id]
        steps = np.zeros(len(raw) + 1, int)
        for p in range(len(raw) - size + 1):
            if times[raw[p:p + size]] > 1:
                steps[p] += 1
                steps[p + size] -= 1
        gone = np.cumsum(steps)[:len(raw)] > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())


def test_op9_accuracy_on_held_out(spark, docs):
    rows = QUERIES["op9_zstd_language"][0](spark, SF).collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held) > 0.85


def test_pipeline_keeps_columns_and_packs_what_is_left(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert k == 4 or docs.columns == columns
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] > counts[3] == counts[4] == docs.select("doc_id").distinct().count()
