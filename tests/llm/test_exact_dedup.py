import hashlib
import re

import pytest

from marginwatch.llm.exact_dedup import exact_dedup

ROWS = [(5, "a  b"), (3, "a\tb"), (9, "a b"), (4, None), (2, ""), (7, "x" * 200_000), (8, "x" * 200_000), (6, "x" * 199_999 + "y"),
        (1, "únïcode \x1c text"), (11, "únïcode \x1c text"), (12, "same id"), (12, "same id"), (12, "other text"), (13, " "), (None, "lonely"), (None, "a b"), (20, "a b")]


def brute(rows):
    norm = lambda t: hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for i, t in rows:
        g = groups[norm(t)]
        keep = min((x for x in g if x is not None), default=None)
        out.append((i, keep, len(g), i == keep, norm(t)))
    return sorted(out, key=str)


@pytest.mark.parametrize("all_digests", [True, False])
def test_groups_match_brute_force(spark, all_digests):
    docs = spark.createDataFrame([(i, t, "k", 3) for i, t in ROWS], "doc_id long, text string, n_bytes string, suspect int")
    got = exact_dedup(docs, all_digests=all_digests).collect()
    want = brute(ROWS)
    assert sorted((tuple(r)[:4] for r in got), key=str) == sorted((w[:4] for w in want), key=str)
    shas = {w[4] for w in want}
    assert all(r.text_sha256 in shas for r in got if r.group_size > 1 or all_digests)


def test_empty_table(spark):
    assert exact_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
