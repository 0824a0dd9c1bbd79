import re
from collections import Counter, defaultdict

import duckdb
import pandas as pd
import pytest

from marginwatch.llm import divergence as D
from marginwatch.llm.queries import ORACLE_SQL, op12_count_bitmaps

SCHEMA = "doc_id long, text string, lang string, source string, rank string, n long"


def brute(rows, least=10, top=10):
    docs = [(lang or "", source or "", Counter(re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or ""))) for _, text, lang, source in rows]
    there = defaultdict(Counter)
    for lang, _, words in docs:
        there[lang].update(words.keys())
    counts = defaultdict(Counter)
    for lang, source, words in docs:
        counts[lang, source].update({t: n for t, n in words.items() if there[lang][t] >= least})
    out = set()
    for (lang, source), own in counts.items():
        kept = [t for t, n in there[lang].items() if n >= least]
        whole = sum((c for (g, _), c in counts.items() if g == lang), Counter())
        p = lambda c, t: 1 + 1_000_000_000 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        pair = [(-sum(f(p(own, t), p(c, t)) for t in kept), other.encode()) for (g, other), c in counts.items() if g == lang and other != source]
        term = [(-f(p(own, t), p(whole, t)), t.encode()) for t in kept if own[t] and p(own, t) > p(whole, t)]
        for part, items in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
            out |= {(lang, source, part, item.decode(), -v, k) for k, (v, item) in enumerate(items, 1)}
    return out


def run(spark, rows, **more):
    return [tuple(r) for r in D.audit_sources(spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA).repartition(3), **more).collect()]


def corpus(n, seed=1):
    import random

    rng = random.Random(seed)
    words = ["The", "été", "Ünder", "a", "B", "ÀB", "naïve", "x1y", "don't", "語彙", *(f"w{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(9))]
    return [(i, " ".join(rng.choices(words, [1 / (k + 1) for k in range(len(words))], k=rng.randrange(60))), rng.choice(["en", "en", "de", None]), rng.choice(["hot", "hot", "s1", "S1", "é", None])) for i in range(n)]


@pytest.mark.parametrize("held", [200_000, 20])
def test_against_all_terms_of_all_pairs(spark, monkeypatch, held):
    monkeypatch.setattr(D, "HELD_TERMS", held)
    rows = corpus(500)
    got = run(spark, rows)
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None, "xx", "a"), (2, "", "xx", "b"), (3, "123 \n", None, None), *[(9, "same words same", "en", "s")] * 12, (4, "9", "en", "t"), (5, "word " * 300_000, "en", "t")]
    got = run(spark, rows)
    assert set(got) == brute(rows) and ("xx", "a", "pair", "b", 0, 1) in got and not [r for r in got if r[0] == ""]
    assert run(spark, rows, least_docs=1, top=1) and set(run(spark, rows, least_docs=1, top=1)) == brute(rows, 1, 1)
    assert D.audit_sources(spark.createDataFrame([], SCHEMA)).count() == 0


def test_frequencies_of_very_large_counts(spark):
    for n, den in ((0, 1), (9_000_000_000_000, 20_000_000_000_001), (5, 7), (12_345_678_901, 12_345_678_903)):
        assert spark.sql(f"select {D._p(f'{n}L', f'{den}L')} as p").first().p == 1 + 1_000_000_000 * (n + 2) // den


def test_query_matches_sql(spark):
    got = op12_count_bitmaps(spark, "/root/testdata/sf0.001").toPandas()
    duck = duckdb.connect()
    duck.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    want = duck.execute(ORACLE_SQL["op12_count_bitmaps"]).df()
    columns = ["lang", "source", "part", "item", "rank"]
    pd.testing.assert_frame_equal(got.sort_values(columns).reset_index(drop=True)[[*columns, "value"]], want.sort_values(columns).reset_index(drop=True)[[*columns, "value"]], check_dtype=False)
