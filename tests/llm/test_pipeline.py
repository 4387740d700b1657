"""The pipeline against plain versions of its stages."""

from collections import Counter

import corpus_pipeline
from crossmart.llm import contamination, quality
from tests.llm import brute


def test_run_matches_the_plain_stages(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    kept = [(r["doc_id"], r["text"], r["source"]) for r in quality.judged(table).where("kept").collect()]
    first = {c for _, _, c in brute.near_duplicates([r[:2] for r in kept])}
    leaked = {r["doc_id"] for r in contamination.contaminated(table, items).collect()}
    left = [r for r in kept if r[0] in first and r[0] not in leaked]
    want = Counter({d: n for d, n in brute.copies(left).items() if n})
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter(r["doc_id"] for r in got) == want
    assert all(r["shard"] == brute.shard(r["doc_id"], 8) for r in got)
    for s in range(8):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
