import corpus_pipeline as P

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_of_documents(spark):
    docs = source = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    for name, stage in P.STAGES[:-1]:
        docs = P.staged(stage(spark, docs, SF), name)
        assert docs.dtypes == source.dtypes
        counts.append(docs.count())
        assert docs.select("doc_id").distinct().count() == counts[-1] and docs.join(source, "doc_id", "left_anti").count() == 0
    assert counts == sorted(counts, reverse=True) and len(set(counts)) > 3
    packed = P.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_stages_of_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n ", "en", "s", 3), (4, "a line of twenty characters\nanother", "en", "s", 35), (5, "a line of twenty characters", "en", "s", 27)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert P.lines(spark, docs, SF).count() == 4
    assert P.near_duplicates(spark, docs, SF).count() == 5
    assert P.packing(spark, P.mixing(spark, P.quality(spark, docs, SF), SF), SF).count() >= 0
    assert P.mixing(spark, docs.limit(0), SF).count() == P.near_duplicates(spark, docs.limit(0), SF).count() == 0


def test_clashing_columns_keep_their_values(spark):
    names = ["row_key", "among", "_bucket", "_bits", "_at", "n_dropped", "accepted", "topic", "component_id"]
    text = "a line of twenty characters\nand another that is long enough\n"
    rows = [(i, text * (i % 2) + f"words of document number {i} alone", "en", "s", 9, *[f"{n}{i}" for n in names]) for i in range(12)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", "n_chars", *names])
    labels_of = P.quality(spark, docs, SF)
    for got in (labels_of, P.lines(spark, docs, SF), P.near_duplicates(spark, docs, SF), P.mixing(spark, docs, SF)):
        assert got.dtypes == docs.dtypes
        assert all(r[n] == f"{n}{r.doc_id}" for r in got.collect() for n in names)
    # The last lines differ in a digit or two, so the first one stays; texts that lose all of theirs go.
    assert P.lines(spark, docs, SF).count() == 2
    kept = P.line_dedup(docs).collect()
    assert len(kept) == 12 and all(r[n] == f"{n}{r.doc_id}" for r in kept for n in names if n != "n_dropped") and {r.n_dropped for r in kept} == {0, 1, 3}
