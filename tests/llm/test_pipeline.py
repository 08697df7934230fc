"""The corpus pipeline: each stage takes and gives the columns of documents, and its decisions take effect."""

import corpus_pipeline
from panelforge.llm import fuzzy_lines, langid
from tests.llm.test_operators import brute_passages, brute_simhash

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(900001, "!!! 123 ...", "en", "s", 11), (900002, None, None, None, None)], docs.schema)
    docs = docs.unionByName(extra)
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = stage(spark, docs, SF)
        docs.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if name != "packing":
            assert docs.columns == columns, name
        if name == "language ID":
            lost = {r["doc_id"] for r in before.join(docs, "doc_id", "left_anti").collect()}
            und = {r["doc_id"] for r in langid.identify(before, before).where("lang_pred = 'und'").collect()}
            assert lost == und >= {900001, 900002}
        elif name == "line dedup":
            want = {r["doc_id"]: r["text"] for r in fuzzy_lines.dedup_lines(before).collect()}
            assert {r["doc_id"]: r["text"] for r in docs.collect()} == want
        elif name == "SimHash near-dedup":
            prints = {r["doc_id"]: brute_simhash(r["text"]) for r in before.collect()}
            label, changed = {i: i for i in prints}, True
            while changed:
                low = {i: min(label[j] for j, q in prints.items() if (p ^ q).bit_count() <= 3) for i, p in prints.items()}
                changed, label = low != label, low
            assert sorted(r["doc_id"] for r in docs.collect()) == sorted(set(label.values()))
        elif name == "suffix-array dedup":
            rows = before.select("doc_id", "text").collect()
            want = {r["doc_id"]: w[1] for r, w in zip(rows, brute_passages([(r["text"] or "").encode() for r in rows]))}
            sizes = {r["doc_id"]: len((r["text"] or "").encode()) for r in rows}
            got = {r["doc_id"]: len((r["text"] or "").encode()) for r in docs.collect()}
            # a cut may leave parts of a character, which the text drops
            assert got.keys() == want.keys() and all(0 <= sizes[i] - got[i] - n < 8 for i, n in want.items())
        else:
            assert {r["doc_id"] for r in docs.collect()} == {r["doc_id"] for r in before.collect()}


def test_empty_corpus(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
