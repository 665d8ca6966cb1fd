"""The corpus pipeline keeps clean documents, and each stage's decisions take effect."""

import corpus_pipeline
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.llm import decontaminate, ngram_join, quality_rules
from ledgerline.session import read_table
from test_text_operators import WORD, brute_kept


def test_stages_in_order_and_columns(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL).checkpoint()
        counts.append(docs.count())
        if name != "mix":
            assert docs.columns == columns, name
        if name == "ngram_join":
            assert ngram_join.near_duplicates(docs).where("n_links > 0").count() == 0
        if name == "decontaminate":
            assert decontaminate.find_leaks(docs, read_table(spark, SF_SMALL, "benchmark")).count() == 0
    assert counts == sorted(counts, reverse=True) and counts[-1] == counts[-2] > 0


def test_run_on_repeated_and_null_ids(spark, tmp_path):
    docs = read_table(spark, SF_SMALL, "documents")
    bench = read_table(spark, SF_SMALL, "benchmark")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    some = docs.where("n_chars > 600").orderBy("doc_id").limit(12).collect()
    a, b = some[0], some[1]
    put = lambda r, i: type(r)(**{**r.asDict(), "doc_id": i})
    cells = [*some, put(a, b.doc_id), put(some[2], None), put(some[2], None), put(some[3], a.doc_id), a]
    cells = [put(some[4], None) if r is some[4] else r for r in cells] + [put(some[4], None)]
    small = spark.createDataFrame(cells, docs.schema)
    small.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    good = {r.text_hash for r in quality_rules.filter_by_rules(small).select(F.xxhash64("text").alias("text_hash")).collect()}
    hashed = {r.text: r.h for r in small.select("text", F.xxhash64("text").alias("h")).collect()}
    lettered = [(r.doc_id, r.text) for r in cells if any(c.isalpha() for c in r.text)]
    want = brute_kept([x for x in lettered if hashed[x[1]] in good])
    kept = spark.createDataFrame([(None if i == "None" else int(i), t) for i, t in want], "doc_id long, text string")
    clean = decontaminate.drop_leaks(kept, bench).collect()
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r.doc_id) for r in clean) and "None" in {str(r.doc_id) for r in out}


def test_run_equals_the_stages(spark):
    out = corpus_pipeline.run(spark, SF_SMALL).toPandas()
    assert out.doc_id.is_unique and (out.taken <= 3 * out["size"]).all()


def test_run_on_no_rows_null_texts_and_clashing_names(spark, tmp_path):
    docs = read_table(spark, SF_SMALL, "documents")
    few = docs.where("n_chars > 600").orderBy("doc_id").limit(4).collect()
    put = lambda r, **k: type(r)(**{**r.asDict(), **k})
    odd = [put(few[0], doc_id=-1, text=None), put(few[0], doc_id=-2, text=""), put(few[0], doc_id=-3, text=" \n\t")]
    named = spark.createDataFrame([*few, *odd], docs.schema).withColumns(
        {c: F.lit(7) for c in ("_text_hash", "_leak_id", "_leak_text", "pattern", "_stats", "key")})
    for name, table in (("none", named.limit(0)), ("some", named)):
        table.write.parquet(str(tmp_path / name / "documents.parquet"))
        read_table(spark, SF_SMALL, "benchmark").write.parquet(str(tmp_path / name / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
    out = corpus_pipeline.run(spark, str(tmp_path / "some")).collect()
    texts = {r.doc_id: r.text for r in few}
    assert out and all(r.doc_id in texts and r["size"] == len(WORD.findall(texts[r.doc_id])) for r in out)
    # every column of the input is there until the last stage, as it was
    docs = read_table(spark, str(tmp_path / "some"), "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path / "some"))
        assert docs.columns == columns, name
    assert all(r["_text_hash"] == r["_leak_id"] == r["key"] == 7 for r in docs.collect())
