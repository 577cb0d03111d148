"""The pipeline's stages on missing, repeated and clashing values, and on nothing."""

import __spark_entry__ as entry
import corpus_pipeline
from samples import prose

STAGES = [stage for _, stage in corpus_pipeline.STAGES]


def through(spark, docs, folder):
    kept = []
    for n, stage in enumerate(STAGES[:-1]):
        stage(spark, docs, entry.SMOKE_DIR).write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
        kept.append(docs)
    return kept, STAGES[-1](spark, docs, entry.SMOKE_DIR)


def test_missing_repeated_and_clashing_values(spark, clashing, tmp_path):
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    rows = [(7, a, "en", "h", 0), (7, a, "en", "h", 0), (None, a + " x", "en", "h", 0), (None, b, None, None, None),
            (4, b + " " + c, "en", "h", 0), (5, None, "en", "h", 0), (None, None, None, None, None), (6, "", "en", "h", 0)]
    docs = clashing(rows)
    kept, packed = through(spark, docs, f"file://{tmp_path}")
    assert all(k.columns == docs.columns for k in kept)
    # Rows without words fail the rules; one of the near copies stays; the row without id loses what row 4 has.
    assert [sorted((r.doc_id or -1) for r in k.collect()) for k in kept] == [[-1, -1, 4, 7, 7], [-1, 4, 7], [-1, 4, 7], [-1, 4, 7]]
    assert {r.doc_id: r.text for r in kept[2].collect()} == {7: a, 4: b + " " + c, None: ""}
    assert {r.doc_id for r in packed.collect()} == {7, 4, None}


def test_an_empty_table(spark, frame, tmp_path):
    kept, packed = through(spark, frame([]), f"file://{tmp_path}")
    assert [k.count() for k in kept] == [0, 0, 0, 0] and packed.count() == 0
