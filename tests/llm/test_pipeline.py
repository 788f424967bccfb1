from collections import Counter

import corpus_pipeline
from ledgermatch.llm import bpe, common, mixing, pii, quality, simhash

NUMBERS = ["quality classifier", "SimHash near-dedup", "PII", "mixing sources to target weights", "byte-level BPE encoding and decoding"]


def test_stages_in_order_each_on_what_the_one_before_kept(spark, small):
    assert [n for n, _ in corpus_pipeline.STAGES] == NUMBERS
    docs = common.read_table(spark, small, "documents")
    columns, seen = docs.columns, [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = common.store(stage(spark, before, small), "test").cache()
        if i < 4:
            assert docs.columns == columns
        seen.append(docs.count())
    assert seen[1] < seen[0] and seen[2] < seen[1] and seen[3] == seen[2] and seen[4] > seen[3] and seen[5] == seen[4]
    assert docs.columns == [*columns, "ids"]
    plain = lambda rows: Counter((*r[:-1], tuple(r[-1])) for r in map(tuple, rows))
    assert plain(corpus_pipeline.run(spark, small).collect()) == plain(docs.collect())


def test_stages_match_their_operators(spark, small):
    docs = common.read_table(spark, small, "documents")
    labels = common.read_table(spark, small, "labels")
    good = {r["doc_id"] for r in quality.op2_quality(spark, small).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in quality.keep_good(docs, labels).collect()} == good
    kept = simhash.op7_simhash(spark, small).where("doc_id = component_id").count()
    assert simhash.drop_near_duplicates(docs).count() == kept
    assert all("@" not in r["text"] or not pii.base_spans(r["text"]) for r in pii.mask(docs).collect())
    assert mixing.mix(docs).count() == sum(r["copies"] for r in mixing.plan(docs).collect())
    assert bpe.digests(docs).count() == docs.count()
