"""The pipeline's stages on awkward rows and on none."""

import pytest

import corpus_pipeline

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_awkward_rows_and_none(spark, awkward, no_documents, name, stage):
    found = stage(spark, awkward, SF)
    assert stage(spark, no_documents, SF).collect() == []
    rows = found.collect()
    if name == "packing":
        assert sorted({str(r.doc_id) for r in rows}) == sorted({str(r.doc_id) for r in awkward.collect()})
        return
    assert found.columns == awkward.columns
    texts = sorted(str((r.doc_id, r.text)) for r in awkward.collect())
    kept = sorted(str((r.doc_id, r.text)) for r in rows)
    if name == "near_dedup":  # two rows of id 1 and one of id 2 hold the same text
        assert len(kept) == len(texts) - 2 and set(kept) == set(texts) - {t for t in texts if t.startswith("(2,")}
    else:
        assert kept == texts
