from __future__ import annotations

import hashlib
from collections import Counter

from cartlens.llm import spm_sampling


def test_query_reads_every_segmentation_back(spark):
    texts = ["A plain text of a few words.", "née ÉTÉ 日本語 \U0001f600\n\ttabs  and spaces ", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = spm_sampling.query(docs).collect()
    for r in got:
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    assert Counter(r.doc_id for r in got) == {0: 4, 1: 4, 2: 1, 3: 1}
    assert len({(r.doc_id, r.tokens_sha256) for r in got}) == len(got)      # without replacement
