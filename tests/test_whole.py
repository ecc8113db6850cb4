"""Core queries do the whole job, whatever the length of the texts."""

from millrace.plans import registry


def test_log_errors_reads_whole_texts(spark, tmp_path):
    far, near = "first error here\n" + "x" * 30_000, "fine\n" + "y" * 10 + "\nsite unavailable"
    rows = [(1, far), (2, near), (3, far + "\nlast error"), (4, "all fine"), (5, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.said for r in registry.QUERIES["log_errors"](spark, str(tmp_path)).collect()}
    assert got == {1: "first error here", 2: "site unavailable", 3: "first error here"}
