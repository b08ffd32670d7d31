import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from retrograph.llm import queries

from .test_models import label_frame, labelled


@pytest.mark.parametrize("stage", ["op10", "pipeline"])
def test_equal_mixes_get_equal_decisions_at_every_size(spark, tmp_path, stage):
    rows, labels = labelled(13, 60)
    bad = {k for k, q, *_ in labels if not q}
    seen = []
    for times in (1, 4, 40):
        folder = str(tmp_path / str(times))
        docs = [(k + 1000 * c, t, "en", "s", len(t)) for k, t in rows for c in range(times)]
        spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
        label_frame(spark, [(k + 1000 * c, *rest) for k, *rest in labels for c in range(times)]).write.parquet(f"{folder}/labels.parquet")
        if stage == "op10":
            kept = queries.QUERIES["op10_quality_rules"](spark, folder).where("keep")
        else:
            kept = corpus_pipeline.apply_rules(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
        ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
        seen.append({i % 1000 for i in ids})
        assert len(ids) == times * len(seen[-1])
    assert seen[0] == seen[1] == seen[2]
    assert seen[0] == {k for k, _ in rows} - bad


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="no tables")
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_labelled_documents_of_small_tables(spark, sf):
    """Junk is rejected, and documents without a label are not rejected for being new to the target."""
    folder = f"/root/testdata/{sf}"
    kept = queries.QUERIES["op10_quality_rules"](spark, folder).select("doc_id", "keep")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    found = {r["quality"]: r["share"] for r in kept.join(labels, "doc_id", "left").groupBy("quality").agg(F.avg(F.col("keep").cast("int")).alias("share")).collect()}
    assert found[0] <= 0.1 and found[1] >= 0.95 and found[None] >= 0.7
