"""What reaches the one task that trains is bounded by labels, not by rows."""

from __future__ import annotations

from trailmart.llm import toxicity
from trailmart.llm.common import prepare


def test_repeated_ids_bring_one_row_each(spark):
    prepare(spark)
    rows = [(i, f"text {i}") for i in range(20)] + [(3, f"copy {i % 4}") for i in range(200)] + [(4, None), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(20)], "doc_id long, quality int, toxic int")
    sample = toxicity.labelled_sample(docs, labels, 10).collect()
    assert len(sample) == len({r.draw for r in sample}) == 10
    again = toxicity.labelled_sample(docs.repartition(7), labels, 10).collect()
    assert sorted(map(str, sample)) == sorted(map(str, again))
    assert len(toxicity.labelled_sample(docs, labels, 100).collect()) == 20
