import random

import pytest

from marginwatch.llm.line_dedup import line_dedup, near_lines, within_edits


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("edits", [0, 1, 2, 4])
def test_automaton_equals_the_distance(spark, edits):
    random.seed(edits)
    pairs = [("", ""), ("a", ""), ("", "ab"), ("kitten", "sitting"), ("ééa", "éa")]
    for _ in range(400):
        a = "".join(random.choice("abé ") for _ in range(random.randint(0, 14)))
        b = list(a)
        for _ in range(random.randint(0, edits + 2)):
            k = random.randint(0, len(b))
            b[k:k + random.randint(0, 1)] = random.choice(["", "a", "x"])
        pairs.append((a, "".join(b)))
    got = spark.createDataFrame(pairs, "x string, y string").selectExpr("x as a", "y as b", within_edits("x", "y", edits) + " as near").collect()
    for r in got:
        assert r.near == (distance(r.a, r.b) <= edits), (r.a, r.b)


def corpus():
    random.seed(9)
    words = ["alpha", "beta", "gamma", "delta", "Été", "of", "in", "7"]
    base = [" ".join(random.choice(words) for _ in range(random.randint(4, 14))) for _ in range(25)]
    rows = []
    for i in range(120):
        lines = []
        for _ in range(random.randint(0, 6)):
            line = list(random.choice(base))
            for _ in range(random.choice([0, 0, 1, 2, 3])):
                k = random.randint(0, len(line))
                line[k:k + random.randint(0, 1)] = random.choice(["", "z", "q"])
            lines.append("".join(line) + random.choice(["", " ", "\r"]))
        rows.append((500 - i, "\n".join(lines)))
    return rows + [(900, None), (901, ""), (902, "\n\n"), (903, "short\nshort"), (None, base[0]), (903, base[1] + "\nshort"), (903, base[1] + "\nshort"), (904, base[2] + "\n" + base[2])]


def brute(rows, edits, min_chars):
    places = []
    for i, t in rows:
        for pos, line in enumerate((t or "").split("\n") if t is not None else []):
            line = line.strip(" \t\r")
            if len(line) >= min_chars:
                places.append(((-1 if i is None else i), i, t, pos, line))
    distinct = sorted({p[4] for p in places})
    root = {x: x for x in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in distinct:
        for b in distinct:
            if a < b and abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return places, {x: find(x) for x in distinct}


@pytest.mark.parametrize("edits", [1, 2])
def test_lines_that_stay_match_brute_force(spark, edits):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, key string").repartition(3)
    got = line_dedup(docs, edits=edits).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "text", "key", "n_lines", "n_dropped", "dropped"}
    places, classes = brute(rows, edits, 20)
    dropped = {}
    first = {}
    for p in sorted(places, key=lambda p: (p[0], p[3])):
        c = classes[p[4]]
        first.setdefault(c, (p[0], p[2], p[3]))
        if first[c] != (p[0], p[2], p[3]):
            dropped.setdefault((p[1], p[2]), set()).add(p[3])
    want = sorted((str(i), "\n".join(x for k, x in enumerate(t.split("\n")) if k not in dropped.get((i, t), ())) if t is not None else None, len(dropped.get((i, t), ()))) for i, t in rows if i != 903 or t == "short\nshort")
    assert sorted((str(r.doc_id), r.text, r.n_dropped) for r in got if r.doc_id != 903 or r.text == "short\nshort") == want
    for r in got:
        assert r.n_lines == r.n_dropped + (0 if r.text is None or (r.text == "" and r.n_dropped) else len(r.text.split("\n")))


def test_near_lines_are_classes(spark):
    rows = corpus()
    docs = spark.createDataFrame([(k, i, t) for k, (i, t) in enumerate(rows)], "row_key long, doc_id long, text string")
    near = near_lines(docs).collect()
    places, classes = brute(rows, 2, 20)
    sizes = {}
    for p in places:
        sizes.setdefault(classes[p[4]], [set(), 0])
        sizes[classes[p[4]]][0].add(p[4])
        sizes[classes[p[4]]][1] += 1
    want = sorted((len(s), n) for s, n in sizes.values() if n > 1)
    have = {}
    for r in near:
        have.setdefault(r.class_key, []).append(r.n)
    assert sorted((len(x), sum(x)) for x in have.values()) == want


def test_short_lines_repeat_exactly(spark):
    rows = [(1, "yes\nno\n\n\na line that is longer than twenty"), (2, " yes\r\nnot"), (3, "no\nyes"), (None, "not"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.dropped) for r in line_dedup(docs, exact_chars=1).collect()}
    assert got == {1: (rows[0][1], []), 2: ("", [0, 1]), 3: ("", [0, 1]), None: ("not", []), 4: (None, [])}
    assert {r.doc_id: r.text for r in line_dedup(docs, exact_chars=3).collect()}[3] == "no"
    assert all(r.n_dropped == 0 for r in line_dedup(docs).collect())


def test_full_bitmap_changes_nothing(spark, monkeypatch):
    """With a bitmap of two bits every copy of a line passes it; each line still counts once."""
    docs = spark.createDataFrame([(k, i, t) for k, (i, t) in enumerate(corpus())], "row_key long, doc_id long, text string").repartition(5)
    want = sorted((r.line_key, r.class_key, r.n, r.first) for r in near_lines(docs, exact_chars=1).collect())
    monkeypatch.setattr("marginwatch.llm.common.FILTER_BITS", 1)
    assert sorted((r.line_key, r.class_key, r.n, r.first) for r in near_lines(docs, exact_chars=1).collect()) == want


def test_empty_table(spark):
    assert line_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
