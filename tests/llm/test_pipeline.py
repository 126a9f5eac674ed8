"""The pipeline's stages, one after the other, on a small table."""

import sys
import os

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as C
from tandem.llm.decontaminate import contamination
from tandem.llm.mixing import mixture
from tandem.llm.neardup import near_duplicate_classes
from tandem.llm.quality import quality_scores, train_line_crf
from tandem.llm.common import load, stored

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = load(spark, SF, "documents")
    labels = load(spark, SF, "labels")
    names = [n for n, _ in C.STAGES]
    assert names == ["quality_rules", "minhash_near_dedup", "benchmark_decontamination", "source_mixing", "token_ids_orc"]
    seen = []
    for name, stage in C.STAGES:
        out = stored(stage(spark, docs, SF), name)
        ids = sorted(r.doc_id for r in out.select("doc_id").collect())
        seen.append(ids)
        if name != names[-1]:
            assert out.columns == docs.columns and out.schema == docs.schema
        if name == names[0]:
            want = quality_scores(docs, train_line_crf(docs, labels)).where("kept")
        elif name == names[1]:
            want = near_duplicate_classes(docs).where("kept").withColumnRenamed("id", "doc_id")
        elif name == names[2]:
            want = contamination(docs, load(spark, SF, "benchmark")).where("NOT contaminated")
        elif name == names[3]:
            want = mixture(docs).where("copies > 0").selectExpr("id doc_id", "explode(sequence(1, copies)) c")
        else:
            want = docs
        assert ids == sorted(r.doc_id for r in want.select("doc_id").collect()), name
        docs = out
    assert len(seen[0]) > len(seen[1]) >= len(seen[2]) and seen[4] == seen[3]
    assert C.ORACLE_SQL is None


def test_run_gives_the_last_stage(spark):
    out = C.run(spark, SF)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 0
