"""Source divergence: brute force in plain Python, and the registered query against its SQL."""

import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loadkit.llm import source_divergence as D
from loadkit.llm.queries import QUERIES
from verification import compare

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, least=3, ranks=200):
    held, groups = defaultdict(Counter), {}
    for lang, source, text in docs:
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]
        groups.setdefault(lang or "", {}).setdefault(source or "", Counter()).update(terms)
        held[lang or ""].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in held[lang].items() if n >= least)

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 1000000000 * (counts[t] + 1) // (total + len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in sources.items()}, shares(sum(sources.values(), Counter()))
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if sources[s][t] and p[s][t] > q[t]]
            for part, rows in (("pair", pairs), ("term", terms)):
                rows.sort(key=lambda r: (-r[0], r[1].encode()))
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(rows, 1) if part == "pair" or k <= ranks]
    return sorted(out)


def corpus(seed, size, sources=7):
    pick = random.Random(seed)
    words = [f"w{'abcdefghij'[int(pick.paretovariate(0.5)) % 10]}{'xyzuv'[int(pick.paretovariate(0.9)) % 5]}" for _ in range(300)]
    words += ["Été,", "(naïve)", "日本語", "a-b", "a.b.a", "--", "123", "WAx", "x\x00y", "don't"]
    docs = [(pick.choice(["en", "de", None]), f"s{int(pick.paretovariate(0.6)) % sources}" if pick.random() < 0.95 else None,
             pick.choice([" ", "\n", "\t  "]).join(pick.choices(words, k=pick.randrange(40)))) for _ in range(size)]
    # Three documents hold a term in different chunks; two hold it in several; one row is there three times.
    docs += [("en", "s1", "rare, RARE. (rare"), ("en", "s2", "rare; rare"), ("en", "s3", "rare!"), ("en", "s1", "two. two, two"), ("en", "s2", "two;")]
    docs += [("en", "s9", "copied thing")] * 3 + [("en", "s1", "own. own, own; own! (own) own? own: own/")]
    return docs + [("fr", "only", "un deux trois"), ("fr", "one", None), ("fr", "two", ""), ("it", "alone", "uno uno uno"), ("en", "empty", " ... 12 "),
                   ("en", "long", "lungo" * 30000), ("en", "s2", "wax " * 30000)]


@pytest.mark.parametrize("settings, sources", [(D.Settings(), 7), (D.Settings(block=2, terms=16, slice=3000, bucket=500, few=0, ranks=5), 9), (D.Settings(least_docs=1), 3)])
def test_audit_equals_brute_force(spark, settings, sources):
    docs = corpus(sources, 250, sources)
    df = spark.createDataFrame([(*d, 1, "x", 2) for d in docs], "lang string, source string, text string, n int, term string, value int").repartition(4)
    rows = D.audit(df, settings).select("lang", "source", "part", "item", "value", "rank").collect()
    assert sorted(map(tuple, rows)) == brute(docs, settings.least_docs, settings.ranks)


def counts(rows, groups=(("en", "a"), ("en", "b"), ("de", "a"))):
    """Counts from (text, group, n, df, low, high, mid)."""
    numbers = [np.array([r[k] for r in rows], np.int64) for k in range(2, 7)]
    return D.Counts(pa.array([r[0].encode() for r in rows], pa.large_binary()), np.array([r[1] for r in rows], np.int64), list(groups), numbers)


def plain(c):
    return sorted((t.decode(), c.groups[g], *map(int, n)) for t, g, *n in zip(c.text.to_pylist(), c.group, *c.numbers))


def test_each_distinct_chunk_is_cut_once_and_its_terms_go_to_all_its_rows(monkeypatch):
    cut = []
    real = D.X.spans
    monkeypatch.setattr(D.X, "spans", lambda inside, offsets: cut.append(len(offsets) - 1) or real(inside, offsets))
    got = D.terms_of(counts([("A-b", 0, 2, 1, 5, 5, 5), ("A-b", 2, 3, 3, 6, 9, 7), ("--", 1, 1, 1, 8, 8, 8), ("Été.Été", 1, 1, 1, 8, 8, 8)]))
    assert cut == [3]
    assert plain(got) == sorted([("a", ("en", "a"), 2, 1, 5, 5, 5), ("b", ("en", "a"), 2, 1, 5, 5, 5), ("a", ("de", "a"), 3, 3, 6, 9, 7),
                                 ("b", ("de", "a"), 3, 3, 6, 9, 7), ("Été", ("en", "b"), 1, 1, 8, 8, 8), ("Été", ("en", "b"), 1, 1, 8, 8, 8)])


def test_row_numbers_tell_two_documents_from_three():
    rows = [("w", 0, 1, 1, 4, 4, 4), ("w", 0, 1, 1, 9, 9, 9), ("w", 0, 1, 2, 4, 9, 4)]
    assert plain(D.merged(counts(rows), np.maximum)) == [("w", ("en", "a"), 3, 2, 4, 9, 4)]
    three = rows + [("w", 0, 1, 1, 6, 6, 6)]
    for order in ([0, 1, 2, 3], [3, 0, 1, 2], [2, 3, 1, 0]):
        one = D.merged(counts([three[k] for k in order[:2]]), np.maximum)
        two = D.merged(counts([three[k] for k in order[2:]]), np.maximum)
        whole = D.merged(D.joined([one, two]), np.maximum)
        assert plain(whole) == [("w", ("en", "a"), 4, 2, 4, 9, 6)] and D.kept(whole, 3).num_rows == 1
    assert D.kept(D.merged(counts(rows), np.maximum), 3).num_rows == 0 and D.kept(D.merged(counts(rows), np.maximum), 2).num_rows == 1


def test_packed_tables_keep_every_row():
    pick = random.Random(9)
    rows = [(f"t{pick.randrange(300)}é", pick.randrange(3), 1, 1, k, k, k) for k in range(800)]
    c = counts(rows)
    batch = c.packed(7)
    parts = [D.unpacked(b) for b in batch["counts"].to_pylist()]
    assert sorted(r for p in parts for r in plain(p)) == plain(c) and len(set(batch["bucket"].to_pylist())) == 7
    for bucket, part in zip(batch["bucket"].to_pylist(), parts):
        assert set(D.bucket_of(part.text, 7)) == {bucket}
    assert plain(next(iter(D.each_bucket([pa.RecordBatch.from_pydict({"bucket": [0] * 7, "counts": batch["counts"]})], np.add, most=50)))) == plain(D.merged(c))
    assert counts([]).packed(3).num_rows == 0


def test_empty_table_and_settings(spark):
    df = spark.createDataFrame([("en", "s", "a")], "lang string, source string, text string")
    assert D.audit(df.where(F.lit(False))).collect() == []
    assert D.audit(df).collect() == []
    with pytest.raises(ValueError, match="least_docs"):
        D.audit(df, D.Settings(least_docs=4))


@pytest.mark.skipif(not Path(SF).exists(), reason="the driver's tables are not here")
def test_query_equals_sql(spark):
    con = compare.oracle_connection(SF)
    ok, account = compare.compare(spark, con, *QUERIES["op12_source_divergence"], SF)
    assert ok, account
