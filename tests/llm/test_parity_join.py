import random
import re

import numpy as np
import pytest

from marginwatch.llm.components import connected_components
from marginwatch.llm import parity_join
from marginwatch.llm.parity_join import SLOT_BITS, Bands, folded, jaccard_components, repeated_slots, shingles, wide_distance, wide_sketch


def brute(rows, width, num, den):
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    root = {i: i for i, _ in rows if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x in range(len(rows)):
        for y in range(x):
            a, b, i, j = sets[x], sets[y], rows[x][0], rows[y][0]
            if a and b and i is not None and j is not None and len(a & b) * den >= len(a | b) * num:
                i, j = sorted((find(i), find(j)))
                root[j] = i
    return sorted(((i, len(s), None if i is None else find(i)) for (i, _), s in zip(rows, sets)), key=str)


def corpus():
    random.seed(2)
    vocabulary = [f"w{k}" for k in range(60)] + ["Été", "it's", "X|y"]
    rows, base = [], []
    for i in range(30):
        base.append([random.choice(vocabulary) for _ in range(random.choice([1, 2, 3, 4, 5, 8, 20, 60, 200, 900]))])
    for i in range(330):
        words = list(random.choice(base))
        for _ in range(random.choice([0, 0, 1, 2, 5]) * max(1, len(words) // 60)):
            words[random.randrange(len(words))] = random.choice(vocabulary)
        rows.append((1000 - i, random.choice([" ", "\n", "  "]).join(words)))
    return rows + [(2000, None), (2001, ""), (2002, " \t "), (2003, "one"), (2004, "ONE"), (2004, "two words"), (None, "one"), (2005, "two  WORDS"), (5, "x " * 30_000), (4, "x " * 29_000)]


@pytest.mark.parametrize(("width", "num", "den"), [(4, 85, 100), (5, 80, 100), (3, 50, 100), (4, 100, 100)])
def test_components_match_brute_force(spark, width, num, den):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, key int, component int").repartition(3)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(docs, width=width, num=num, den=den).collect()), key=str)
    assert got == brute(rows, width, num, den)


def test_empty_table(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_linked_sets_share_a_key_and_the_sketch_bounds_their_difference():
    rng = np.random.default_rng(7)
    for num, den in ((85, 100), (80, 100), (60, 100)):
        bands = Bands(num, den)
        for n in [1, 2, 3, 5, 6, 7, 12, 13, 40, 111, 500, 3000]:
            for _ in range(20):
                a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
                most = bands.difference(len(a))
                drop, more = rng.integers(0, most + 1), rng.integers(0, most + 1)
                b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 63, more, dtype=np.uint64)]))
                common = len(np.intersect1d(a, b))
                assert np.bitwise_count((folded(a) ^ folded(b)).view(np.uint64)).sum() <= len(a) + len(b) - 2 * common
                if len(b) and common * den >= (len(a) + len(b) - common) * num:
                    assert set(bands.keys(a).tolist()) & set(bands.keys(b).tolist()), (n, drop, more)


def test_shingles_of_short_and_repeated_texts():
    assert len(shingles(b"", 4)) == 0 and len(shingles(b"a b", 4)) == 1 and len(shingles(b"a " * 50, 4)) == 1
    assert shingles(b"a b c", 4).tolist() != shingles(b"a b c d", 4).tolist()


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (3, 2)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100)}


def test_linked_sets_share_one_of_the_keys_they_need_in_any_common_order():
    """Whatever the frequencies of keys, a linked pair meets in the rarest ones that each needs."""
    rng = np.random.default_rng(11)
    bands = Bands(80, 100)
    for n in [3, 12, 40, 111, 500, 3000]:
        for salt in range(20):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            most = bands.difference(len(a)) // 2
            b = np.unique(np.concatenate([a[rng.integers(0, most + 1):], rng.integers(0, 1 << 63, rng.integers(0, most + 1), dtype=np.uint64)]))
            common = len(np.intersect1d(a, b))
            if common * 100 < (len(a) + len(b) - common) * 80:
                continue
            kept = []
            for h in (a, b):
                keys, sizes, need = bands.elements(h)
                out, start = set(), 0
                for k in range(0, len(sizes), 2):
                    end = sizes[1] if k == 0 else len(keys)
                    filled = keys[start:start + sizes[k]].tolist()
                    out |= set(sorted(filled, key=lambda x: hash((x, salt)))[:need]) | set(keys[start + sizes[k]:end].tolist())
                    start = end
                kept.append(out)
            assert kept[0] & kept[1], (n, salt)
            x, y = wide_sketch(a), wide_sketch(b)
            assert x is None or y is None or wide_distance(x, y) <= len(a) + len(b) - 2 * common


def test_documents_around_one_long_passage(spark):
    """A passage in all texts, with as much besides: no two link, but for the near copies of some."""
    random.seed(5)
    passage = [f"p{k}" for k in range(700)]
    rows = []
    for i in range(60):
        own = [f"d{i}x{random.randrange(10**6)}" for _ in range(random.choice([60, 200, 800]))]
        rows.append((i, " ".join(own + passage)))
        if i % 5 == 0:
            rows.append((100 + i, " ".join(own + passage[:-5] + ["end"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(docs).collect())
    assert got == sorted(brute(rows, 5, 80, 100))


def test_keys_are_counted_by_slot(spark):
    rng = np.random.default_rng(3)
    known = rng.integers(-(1 << 63), 1 << 63, 400)
    rows = [[int(k) for k in rng.choice(known, rng.integers(0, 30), replace=False)] for _ in range(50)] + [[0, -1], [-1], []]
    counts = {}
    for row in rows:
        for k in row:
            slot = k % (1 << 64) >> (64 - SLOT_BITS)
            counts[slot] = counts.get(slot, 0) + 1
    got = {r.slot: r.n_rows for r in repeated_slots(spark.createDataFrame([(r,) for r in rows], "keys array<long>").repartition(4)).collect()}
    assert got == {k: n for k, n in counts.items() if n > 1}


def test_sketches_stay_where_they_are_when_copies_are_found(spark, monkeypatch):
    """Their only joins are with bitmaps, by bucket; joined with the table of repeats they were shuffled once that was large."""
    joins, write = [], parity_join.staged

    def seen(df, name):
        if name == "parity-vertices":
            joins.extend(line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line)
        return write(df, name)

    monkeypatch.setattr(parity_join, "staged", seen)
    rows = [(i, f"text {i % 40} " + " ".join(f"w{(i % 40) * k % 97}" for k in range(30))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(docs).collect()) == sorted(brute(rows, 5, 80, 100))
    assert joins and all("_bucket" in line for line in joins)
