"""The corpus pipeline against its stages in plain Python, and the registered queries."""

from collections import Counter

import corpus_pipeline
from courtline.llm import chosen_path, language_id, packing, repetition
from tests.llm.test_duplicates import brute_components, brute_removal


def test_pipeline_against_brute_force(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    kept = docs
    model = language_id.fit(docs)
    fine = {r["doc_id"] for r in language_id.identify(docs, model).filter("accepted").collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in fine]
    kept = corpus_pipeline.language_stage(spark, docs, small_dir)
    assert kept.schema == docs.schema and sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, _ in rows)

    good = {r["doc_id"] for r in repetition.repetition_rules(kept).filter("kept").collect()}
    rows = [r for r in rows if r[0] in good]
    sets = brute_components(rows, 5)
    rows = [r for r in rows if sets.find(r[0]) == r[0]]
    left = Counter({i: n - gone for i, n, gone, _, _ in brute_removal(rows)[0].values()})

    out = corpus_pipeline.run(spark, small_dir).collect()
    assert {r["doc_id"] for r in out} == set(left)
    tokens = Counter()
    for r in out:
        tokens[r["doc_id"]] += r["length"]
    # a document left whole packs as its own text does
    whole = {i: t for i, t in rows if left[i] == len(t.encode())}
    some = spark.createDataFrame(sorted(whole.items())[:50], "doc_id bigint, text string").selectExpr("*", "'s' as source")
    for r in packing.pack(some).groupBy("doc_id").max("doc_tokens").collect():
        assert tokens[r[0]] == r[1]


def test_stages_take_empty_and_odd_tables(edge_docs, no_docs, spark, small_dir):
    for start in (no_docs, edge_docs):
        docs = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, small_dir)
            assert out.columns == docs.columns
            docs = out.cache()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, small_dir).count() >= 0


def test_rows_alike_in_id_and_text_are_kept_once(spark):
    long = "one two three four five six seven eight nine ten " * 4
    rows = [(1, long), (1, long), (1, "another text under the id of the first " * 3), (2, long), (None, "no id " * 9), (None, "no id " * 9), (None, None), (None, None), (3, None), (3, None), (4, "")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, k1 string").repartition(4)
    got = Counter((r["doc_id"], r["text"]) for r in chosen_path.one_of_each(docs, shingle=5, similarity=(80, 100)).collect())
    assert got == Counter([(1, long), (1, rows[2][1]), (None, "no id " * 9), (None, None), (3, None), (4, "")])


def test_every_operator_has_one_query():
    import __spark_entry__
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
