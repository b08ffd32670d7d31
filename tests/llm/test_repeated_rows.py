import random

import corpus_pipeline
from retrograph.llm import ngram_join

from .data import frame, words
from .test_join_packing import copies, kept_ids


def test_one_row_of_each_group_stays(spark, monkeypatch):
    rnd = random.Random(6)
    text, other = words(rnd, 30), words(rnd, 30, "pqrstu")
    near = text + " tail"
    rows = copies(2) + [(900, text), (900, text), (900, near), (None, text), (900, other), (950, near)]
    rows += [(None, "alone without an id"), (None, "alone without an id"), (960, "!!!"), (960, "!!!")]
    docs = frame(spark, rows)
    for limit in (ngram_join.BROADCAST_IDS, 0):
        monkeypatch.setattr(ngram_join, "BROADCAST_IDS", limit)
        kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
        assert kept.columns == docs.columns
        got = [(r["doc_id"], r["text"]) for r in kept.collect()]
        assert sorted([i is None, i or 0] for i, _ in got) == kept_ids(rows)
        assert (900, other) in got and sum(x in (text, near) for _, x in got) == 1
    assert corpus_pipeline.drop_near_duplicates(spark, frame(spark, []), "").collect() == []
