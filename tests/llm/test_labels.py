"""What the language network learns from."""

from llm_fixtures import folder  # noqa: F401

from cartmill.llm import langid


def test_rounds_of_training():
    assert langid.EPOCHS == 14


def test_every_label_is_learned(spark):
    rows = [(i, f"l{i % 70:02d}", f"text of language {i % 70}") for i in range(2800)]
    frame = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    learned = langid.training_sample(frame, "doc_id", "text", "lang")
    assert {name for name, _ in learned} == {f"l{k:02d}" for k in range(70)}
    assert langid.training_sample(frame.where("false"), "doc_id", "text", "lang") == []
