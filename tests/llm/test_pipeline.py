import corpus_pipeline
from notewright.llm import decontaminate, packing, quality, secrets, simhash
from notewright.llm.base import table
from notewright.session import scratch_path, settle
from test_simhash import plain_components

SF_DIR = "/root/testdata/sf0.01"


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "decontamination", "secret_scan", "packing"]


def test_every_stage_takes_effect(spark):
    docs = table(spark, SF_DIR, "documents")
    labels, items = table(spark, SF_DIR, "labels"), table(spark, SF_DIR, "benchmark")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = settle(stage(spark, before, SF_DIR), scratch_path(spark, name))
        if name != "packing":
            assert docs.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            kept.append(docs.count())
        if name == "quality_rules":
            found = quality.quality_rules(before, labels).where("quality.kept").select("row.doc_id").collect()
            assert {r[0] for r in found} == {r[0] for r in docs.select("doc_id").collect()}
        if name == "near_duplicates":
            assert simhash.first_of_linked(docs).count() == docs.count()
            firsts = {least for _, _, least in plain_components([(r["doc_id"], r["text"]) for r in before.collect()])}
            assert {r["doc_id"] for r in docs.collect()} == firsts
        if name == "decontamination":
            assert decontaminate.contaminated(before, items).count() > 0
            assert decontaminate.contaminated(docs, items).count() == 0
        if name == "secret_scan":
            assert secrets.scanned(before).where("spans != ''").count() > 0
            assert secrets.scanned(docs).where("spans RLIKE 'assign|access|hex'").count() == 0
            texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert 1000 > kept[0] > kept[1] > kept[2] == kept[3]
    tokens = packing.word_tokenizer(packing.vocabulary())
    sizes = {i: len(tokens.ids(t)) // 4 + 1 for i, t in texts.items()}
    got = {}
    for r in docs.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == sizes


def test_odd_rows(spark, odd_documents, no_documents, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for some in (odd_documents, no_documents):
        docs = some
        for name, stage in corpus_pipeline.STAGES:
            docs = settle(stage(spark, docs, str(tmp_path)), scratch_path(spark, name))
            if name != "packing":
                assert docs.columns == some.columns
    some.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
