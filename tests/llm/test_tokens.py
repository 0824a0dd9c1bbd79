import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from marginwatch.llm import simple8b
from marginwatch.llm.packing import Packer, pack_documents
from marginwatch.llm.token_files import read_token_digests, read_token_files, write_token_files
from marginwatch.llm.tokens import WordEncoder, vocabulary_path

ODD = ["I'LL don't 're 'S it's ''s'll", "a\x1cb \x85 c d e", "İstanbul ΑΣ ς ﬁ é é Å ́x", "<|endoftext|> x<|startoftext|>",
       "１２ ½ 三四", "", "   \n", "日本語テキスト", "a'Sb 'Vex 'VE K'S 'ſ", "…'s“x” \x1e's 's\x1f", "\x00\x01a\x7f", "Ünïcödé ÉÈÇ ŒŸŽ ß"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(vocabulary_path())
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [1]


def test_word_encoder_equals_the_library(library, monkeypatch):
    random.seed(3)
    signs = "abcXYZ 'sStTdDlLrReEvVmM09.,!|-\n\t\x1c\x85éÉßΣİſŉĸ̸<>|_×÷"
    texts = ODD + ["".join(random.choice(signs) for _ in range(random.randint(1, 60))) for _ in range(4000)] + ["".join(map(chr, range(a, a + 40))) for a in range(0xA0, 0x500, 40)]
    monkeypatch.setattr("marginwatch.llm.tokens.CACHE_WORDS", 300)  # starts anew many times
    coder = WordEncoder(vocabulary_path())
    for i in range(0, len(texts), 100):
        ids, at = coder.encode([t.encode() for t in texts[i:i + 100]])
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [library(t) for t in texts[i:i + 100]]


@pytest.mark.parametrize("n", [0, 1, 2, 59, 60, 61, 4096, 4097, 20_000])
@pytest.mark.parametrize("limit", [1, 2, 7, 49_408, 1 << 40, 1 << 63])
def test_simple8b_round_trip(n, limit):
    rng = np.random.default_rng(n)
    values = rng.integers(0, limit, n, dtype=np.uint64) >> rng.integers(0, 30, n).astype(np.uint64)
    words, offsets = simple8b.encode(values)
    assert simple8b.decode(words).tolist() == values.tolist()
    for b in range(len(offsets) - 1):  # any block on its own
        assert simple8b.decode(words[offsets[b]:offsets[b + 1]]).tolist() == values[b * simple8b.BLOCK:(b + 1) * simple8b.BLOCK].tolist()


def documents(spark):
    random.seed(5)
    rows = [(i, " ".join(random.choice(["the", "of", "thhedtion,", "é", "x9"]) for _ in range(int(random.paretovariate(0.7)) % 300)), "en") for i in range(700) if i not in range(100, 120)]
    rows += [(100 + i, t, None) for i, t in enumerate(ODD)] + [(200, None, "x"), (7, "again the same id", "x"), (7, "again the same id", "x"), (None, "no id", "x"), (300, "word " * 30_000, "x")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, part string").repartition(3)


def test_token_files(spark, tmp_path, library):
    rows, docs = documents(spark)
    manifest = write_token_files(docs, str(tmp_path / "ids"), vocabulary_path(), file_ids=2000)
    got = sorted(read_token_files(manifest, str(tmp_path / "ids")).collect(), key=lambda r: r.start)
    assert sorted((str(r.doc_id), r.ids) for r in got) == sorted((str(i), library(t)) for i, t, _ in rows)
    keys = [r.doc_id if r.doc_id is not None else -1 for r in got]
    assert keys == sorted(keys) and manifest.count() > 1
    assert [r.start for r in got] == [0, *np.cumsum([len(r.ids) for r in got])[:-1].tolist()]
    digests = {r.start: (r.doc_id, r.n_tokens, r.ids_crc32) for r in read_token_digests(manifest, str(tmp_path / "ids")).collect()}
    assert digests == {r.start: (r.doc_id, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in got}


def test_token_files_of_an_empty_table(spark, tmp_path):
    manifest = write_token_files(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "none"), vocabulary_path())
    assert read_token_files(manifest, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("pool", [1000, 4_000_000])
def test_packing_holds_every_id_once(spark, library, pool):
    rows, docs = documents(spark)
    got = pack_documents(docs, vocabulary_path(), pool_ids=pool, with_ids=True).collect()
    sequences, pieces = {}, {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append(r)
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    for s in sequences.values():
        s.sort(key=lambda r: r.offset)
        assert [r.offset for r in s] == [0, *np.cumsum([r.length for r in s])[:-1].tolist()]
        total = sum(r.length for r in s)
        assert total == s[0].window and total & (total - 1) == 0 and total <= 2048  # nothing is padded
    assert sum(r.length for r in got) == sum(len(library(t)) for _, t, _ in rows)
    for i, t, _ in rows:
        mine = sorted(pieces[i, len(library(t))], key=lambda r: r.start)
        if i != 7:
            assert [x for r in mine for x in r.ids] == library(t)
    full = {}
    for s in sequences.values():
        full.setdefault((s[0].step_group, s[0].window), []).append(s)
    assert all(len(g) <= 32_768 // w for (_, w), g in full.items())


def test_packing_of_an_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), vocabulary_path()).count() == 0


def test_short_tiers_fill_long_gaps():
    packer = Packer()
    for doc, length in enumerate([1500, 300, 200, 48, 5000]):
        packer.add(doc, length)
    windows = [(w, sorted(p[0] for p in pieces)) for w, _, pieces in packer.pack(True)]
    assert (2048, [0, 1, 2, 3]) in windows and sum(w for w, _ in windows) == 7048


def test_step_groups_are_balanced():
    rng = np.random.default_rng(1)
    packer = Packer()
    for doc, length in enumerate(rng.integers(1, 3000, 4000).tolist()):
        packer.add(doc, length)
    cost = {}
    for window, group, pieces in packer.pack(False):
        if window == 2048:
            cost.setdefault(group, []).append(sum(p[2] ** 2 for p in pieces))
    sums = [sum(x) for x in cost.values()]
    assert {len(x) for x in cost.values()} == {16} and max(sums) < 1.05 * min(sums)


def test_what_fills_no_window_waits_for_the_next_pool():
    rng = np.random.default_rng(4)
    packer, total, held = Packer(), 0, []
    for doc, length in enumerate(rng.integers(1, 2500, 3000).tolist()):
        packer.add(doc, length)
        total += length
        if rng.random() < 0.3:
            held += packer.pack(False)
    held += packer.pack(True)
    assert sum(w for w, _, _ in held) == total and all(sum(p[2] for p in pieces) == w for w, _, pieces in held)
