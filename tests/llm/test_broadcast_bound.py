"""What the join with alignments may broadcast."""

from llm_fixtures import folder  # noqa: F401

from cartmill.llm import decontaminate


def test_bound_counts_arrays(spark, monkeypatch):
    bounds = []

    def spy(frame, rows, row_bytes):
        if "__shifts" in frame.columns:
            bounds.append(rows * row_bytes)
        return frame

    monkeypatch.setattr(decontaminate, "small", spy)
    item = " ".join(f"w{i}" for i in range(5000))
    bench = spark.createDataFrame([(1, item), (None, "only once a few other tokens here make an item too")], "item_id long, text string")
    docs = spark.createDataFrame([(1, item)], "doc_id long, text string")
    assert decontaminate.overlaps(docs, bench).count() == 1
    assert bounds and bounds[0] >= 8 * 5000
