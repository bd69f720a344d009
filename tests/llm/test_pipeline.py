import corpus_pipeline
from cloudmarts.llm import decontaminate, packing, quality_fm, secrets_cnn, simhash
from cloudmarts.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_stage_does_its_operators_work(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    scores = {r["doc_id"]: r["predicted"] for r in quality_fm.quality_scores(docs, labels).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {i for i in texts if scores[i]}
    prints = {i: simhash.simhash(texts[i]) for i in kept}
    group = {}

    def find(i):
        while group.setdefault(i, i) != i:
            i = group[i]
        return i

    for a in sorted(kept):
        for b in sorted(kept):
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                group[y] = x
    kept = {i for i in kept if find(i) == i}
    index = decontaminate.ContainmentIndex([r["text"] for r in items.collect()])
    order = sorted(kept)
    kept = {i for i, hits in zip(order, index.search([texts[i] for i in order]), strict=True) if not hits}
    encoder = packing.load_encoder(packing.default_vocabulary())

    after = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, after = after, stage(spark, after, SF)
        assert after.columns == docs.columns, name
    assert {r["doc_id"] for r in after.collect()} == kept
    hidden = {r["doc_id"]: r["text"] for r in after.collect()}
    for i in kept:
        assert not secrets_cnn.base_spans(hidden[i])
        if not secrets_cnn.base_spans(texts[i]):
            assert hidden[i] == texts[i]
    rows = corpus_pipeline.run(spark, SF).collect()
    total = {i: len(encoder.encode_ordinary(hidden[i])) + 1 for i in kept}
    assert {r["doc_id"] for r in rows} == kept
    assert sum(r["length"] for r in rows) == sum(total.values())


def test_registered_names():
    import __spark_entry__ as entry

    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "simhash_dedup", "decontamination", "secret_scan", "packing"]
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
