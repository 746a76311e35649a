"""The corpus pipeline's stages on a small fixture."""

import corpus_pipeline

LINES = {"en": "the cat and the dog", "de": "der hund und die katze", "fr": "le chat et le chien", "ru": "кошка и собака"}


def test_language_stage_drops_only_und_and_unknown_scripts(spark):
    assert "Mixed or unclear texts in known scripts stay" in " ".join(corpus_pipeline.__doc__.split())
    learn = [(100 + i, LINES[k], k) for i in range(24) for k in LINES]
    cases = [(1, " ".join(LINES.values()), None), (2, "qq zz xx vv", None), (3, None, None), (4, "123 !", None), (5, "漢字漢字漢字漢字 a", None), (6, LINES["ru"], None)]
    docs = spark.createDataFrame(learn + cases, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").collect()}
    assert kept & {1, 2, 3, 4, 5, 6} == {1, 2, 6}
