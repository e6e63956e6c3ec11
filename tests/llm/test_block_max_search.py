"""Ranked search: brute force in plain Python, and the registered query against its SQL."""

import math
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from loadkit.llm import block_max_search as B
from loadkit.llm.queries import QUERIES
from verification import compare

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, queries, k=10):
    """Every document scored for every query; missing ids first among equal scores."""
    counts = [Counter(terms(t)) for _, t in docs]
    sizes = [sum(c.values()) for c in counts]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for c in counts for t in c)
    asked = {}
    for item, text in queries:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        found = []
        for (doc, _), c, size in zip(docs, counts, sizes):
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * (10 + 90 * size * n // total)))
                        for t in wanted if t in c)
            if score > 0:
                found.append((-score, doc is not None, doc or 0))
        out += [(item, rank, doc if known else None, -score) for rank, (score, known, doc) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def corpus(seed, size):
    pick = random.Random(seed)
    words = [f"w{int(pick.paretovariate(0.6))}" for _ in range(4000)] + ["Été", "naïve", "日本語", "x1"]
    docs = [(i if i % 50 else None, " ".join(pick.choices(words, k=int(pick.paretovariate(0.8)) % 900))) for i in range(1, size)]
    docs += [(5, docs[3][1]), (5, docs[3][1]), (9, None), (10, ""), (11, "  ..--  "), (12, "W1 w1 \x00W1_w2"), (13, "alone " * 20000)]
    queries = [(q, " ".join(pick.choices(words, k=pick.choice([1, 2, 8, 60])))) for q in range(12)]
    return docs, queries + [(3, "alone W1"), (None, "日本語 w1"), (77, None), (78, "!"), (79, "never seen"), (80, "w1 w1 w2")]


def test_numbers_round_trip():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2 ** 21, 2 ** 28 - 1, 2 ** 28, 2 ** 31 - 1] * 3)
    raw, size = B.packed(values)
    assert B.unpacked(raw).tolist() == values.tolist() and size.sum() == len(raw) and len(B.unpacked(raw[:0])) == 0


@pytest.mark.parametrize("seed, size", [(1, 900), (2, 60), (3, 2500)])
def test_segment_equals_brute_force(seed, size, monkeypatch):
    """One segment; few postings a block, so that lists have many blocks."""
    monkeypatch.setattr(B, "BLOCK", 4)
    docs, queries = corpus(seed, size)
    whole = B.segment_rows(7, pa.array([d for d, _ in docs], pa.int64()), pa.array([t for _, t in docs], pa.string()))
    sizes, df = [len(terms(t)) for _, t in docs], Counter(t for _, text in docs for t in set(terms(text)))
    known = B.Corpus(sum(s > 0 for s in sizes), sum(sizes))
    asked = {}
    for item, text in queries:
        asked.setdefault(item, set()).update(terms(text))
    weights = [[(t, math.floor(1000 * math.log((2 * known.documents + 2) / (2 * df[t] + 1)))) for t in ts if t in df] for ts in asked.values()]
    assert {r["term"]: r["df"] for r in whole.select(["term", "df"]).to_pylist() if r["term"] is not None} == dict(df)
    got, items = [], list(asked)
    rank = Counter()
    for r in B.search_segment(whole, weights, known, 10).to_pylist():
        rank[r["item"]] += 1
        got.append((items[r["item"]], rank[r["item"]], r["doc_id"], r["score"]))
    assert sorted(got, key=repr) == brute(docs, queries)


def test_lists_that_cannot_matter_are_not_unpacked(monkeypatch):
    """A common term's blocks are read only where a candidate lies whose block maximum could lift it."""
    monkeypatch.setattr(B, "BLOCK", 4)
    docs = [(i, "common " + "rare " * (i in range(100, 112)) + "filler " * (i % 7)) for i in range(4000)]
    whole = B.segment_rows(0, pa.array([d for d, _ in docs], pa.int64()), pa.array([t for _, t in docs]))
    read = []
    real = B.List._unpack
    monkeypatch.setattr(B.List, "_unpack", lambda self, a, b: read.append(b - a) or real(self, a, b))
    out = B.search_segment(whole, [[("rare", 5000), ("common", 3)]], B.Corpus(4000, 15000), 10)
    assert out.num_rows == 10 and sum(read) < 20


@pytest.mark.parametrize("settings", [B.Settings(), B.Settings(k=3, segment=2000, pairs=40)])
def test_search_equals_brute_force(spark, settings):
    docs, queries = corpus(4, 300)
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, segment int, term string").repartition(3)
    asked = spark.createDataFrame([(*q, "x") for q in queries], "item_id long, text string, term string")
    rows = B.search(B.build(df, settings), asked, settings).collect()
    assert sorted(map(tuple, rows), key=repr) == brute(docs, queries, settings.k)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "b c")], "item_id long, text string")
    assert B.search(B.build(docs.where("false")), asked).collect() == []
    assert B.search(B.build(docs), asked.where("false")).collect() == []
    assert len(B.search(B.build(docs), asked).collect()) == 1


@pytest.mark.skipif(not Path(SF).exists(), reason="the driver's tables are not here")
def test_query_equals_sql(spark):
    con = compare.oracle_connection(SF)
    ok, account = compare.compare(spark, con, *QUERIES["op13_block_max_search"], SF)
    assert ok, account
