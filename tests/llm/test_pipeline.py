"""The pipeline's decisions, stage by stage, and its guard in the entry module."""

import subprocess
import sys
from pathlib import Path

import corpus_pipeline
from churnlens.llm.common import read_table

SF = "/root/testdata/sf0.01"
REPO = Path(__file__).resolve().parents[2]


def test_stages_follow_the_operators(spark, scratch):
    from churnlens.llm import decontaminate, quality, simhash, toxicity

    docs = read_table(spark, SF, "documents")
    labels, benchmark = read_table(spark, SF, "labels"), read_table(spark, SF, "benchmark")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{scratch}/{i}"
        stage(spark, docs, SF).write.parquet(path)
        kept = spark.read.parquet(path)
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        after = sorted(r.doc_id for r in kept.select("doc_id").collect())
        assert len(after) == len(set(after)) and set(after) <= before
        if name == "toxicity":
            want = {r.doc_id for r in toxicity.score_documents(docs, labels).collect() if r.predicted == 0}
        elif name == "quality":
            want = {r.doc_id for r in quality.score_documents(docs, labels).collect() if r.predicted == 1}
        elif name == "simhash_near_dedup":
            want = {r.component_id for r in simhash.near_duplicates(docs).collect()}
        elif name == "benchmark_decontamination":
            want = before - {r.doc_id for r in decontaminate.find_leaks(docs, benchmark).collect()}
        else:
            want = before
        assert set(after) == want
        if name != "packing":
            assert kept.columns == docs.columns and len(want) < len(before)
        docs = kept


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.columns == ["doc_id", "n_tokens", "bucket", "batch", "slot", "padding"] and rows.count() > 50


def test_entry_works_without_the_subpackage(scratch):
    code = ("import sys\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name == 'corpus_pipeline' or name.startswith('churnlens.llm'):\n"
            "            raise ModuleNotFoundError(name, name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "assert 'pipeline' not in e.queries() and not any(k.startswith('op') for k in e.queries())\n"
            "assert 'tenure_rates' in e.oracle_sql()\n")
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True)
