import io as bytesio
import zipfile

import pyarrow as pa
from pyspark.sql import functions as F

from millrace.sources import io, schemas
from millrace.streaming import monitor_stream


def test_json_forms(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": "1", "image": null, "conversations": [{"from": "human", "value": "ü"}]}, {"id": "2"}]')
    (tmp_path / "b.json").write_text("{broken")
    assert [r.id for r in io.read_json_array(spark, str(tmp_path / "a.json"), schemas.ANNOTATION).orderBy("id").collect()] == ["1", "2"]
    good, bad = io.read_json_tolerant(spark, str(tmp_path), schemas.ANNOTATION)
    assert good.count() == 2 and bad.count() == 1
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    assert io.write_jsonl(df, str(tmp_path / "l")) == 2
    assert sorted(map(tuple, io.read_jsonl(spark, str(tmp_path / "l"), "a int, b string").collect())) == [(1, "x"), (2, None)]
    assert io.write_jsonl(df, str(tmp_path / "m"), limit=0) == 1


def test_parquet_forms(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    assert io.save_parquet(df, str(tmp_path / "p/x")) and not io.save_parquet(df.limit(0), str(tmp_path / "q"))
    (tmp_path / "p/bad.parquet").write_bytes(b"no")
    assert io.read_parquet_tree(spark, str(tmp_path / "p")).count() == 1
    assert io.row_count(spark, str(tmp_path / "p/x")) == 1
    assert io.read_shards(spark, [], "a int").count() == 0
    assert io.united([df, df.withColumn("a", F.lit(2))]).count() == 2


def test_csv_scores_and_tsv(spark, tmp_path):
    df = spark.createDataFrame([(1.5, None, "x"), (2.5, 3, "")], "ts double, step int, s string")
    io.write_csv(df, str(tmp_path / "c"), ["s", "ts", "step"])
    assert io.read_csv(spark, str(tmp_path / "c"), "s string, ts double, step int").where("step IS NULL").count() == 1
    io.append_csv(df, str(tmp_path / "c2"))
    io.append_csv(df, str(tmp_path / "c2"))
    assert io.read_csv(spark, str(tmp_path / "c2"), "ts double, step int, s string").count() == 4
    io.write_tsv(df, str(tmp_path / "t"))
    (tmp_path / "s.csv").write_text('"perception","reasoning","note"\n1418.31,300,n/a\n')
    assert {r.metric: r["value"] for r in io.read_scores(spark, str(tmp_path / "s.csv")).collect()} == {"perception": 1418.31, "reasoning": 300.0}


def test_media_archives_and_arrow(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m/a.jpg").write_bytes(b"abc")
    (tmp_path / "m/b.jpg").write_bytes(b"abc")
    assert {(r.path.rsplit("/", 1)[-1], r.length) for r in io.read_media(spark, str(tmp_path / "m")).collect()} == {("a.jpg", 3), ("b.jpg", 3)}
    io.write_blobs(io.read_blobs(spark, str(tmp_path / "m")), str(tmp_path / "blobs"))
    assert spark.read.parquet(str(tmp_path / "blobs")).count() == 1
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("in/x.txt", "1")
        z.writestr("out/y.txt", "22")
    assert [(r.member, r["size"], r.ok) for r in io.read_zip_members(spark, str(tmp_path), "in/").collect()] == [("in/x.txt", 1, True)]
    batch = pa.record_batch({"input_ids": [[1, 2], [], [3]], "other": [1, 2, 3]})
    sink = bytesio.BytesIO()
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_batch(batch)
    (tmp_path / "s.arrow").write_bytes(sink.getvalue())
    assert [r.input_ids for r in io.read_arrow_streams(spark, str(tmp_path), "input_ids", "array<long>").collect()] == [[1, 2], [], [3]]


def test_logs(spark):
    lines = spark.createDataFrame([(1, '{"current_steps": 5, "loss": 1.5}'), (2, '{"current_steps": 6, "lo'), (3, "INFO {}"), (4, '{"global_step": 7}'), (5, None)], "n int, value string")
    got = io.parse_log_objects(lines, "value", schemas.TRAINER_LINE).select("n", F.coalesce("current_steps", "global_step")).collect()
    assert sorted(map(tuple, got)) == [(1, 5), (4, 7)]
    log = spark.createDataFrame([("2026-09-27T01:53:22 1275904:MainThread:556MB  7:pt:worker:387MB",), ("2026-09-27T01:54:22  8:python:12MB",)], "value string")
    assert [(r.pid, r.name, r.mb) for r in io.parse_processes(log, "value").collect()] == [(1275904, "MainThread", 556.0), (7, "pt:worker", 387.0), (8, "python", 12.0)]
    text = spark.createDataFrame([(1, "aaaa\rbb\ncc")], "id int, t string")
    assert [r["value"] for r in io.tail_lines(text, "t", 5).orderBy("line").collect()] == ["bb", "cc"]


def test_registry(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n')
    missing = io.register_datasets(spark, str(tmp_path), {"one": {"file_name": "x.jsonl", "columns": {"b": "a"}}, "two": {"file_name": "y.jsonl"}})
    assert missing == ["two"] and spark.table("one").columns == ["b"]


def test_stream_state_carries_over_batches(spark, tmp_path):
    schema = "k string, t double"
    source, sink, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    got = []
    for times in ([0.0, 100.0], [1800.0, 1801.0], [1900.0]):
        spark.createDataFrame([("m", t) for t in times], schema).coalesce(1).write.mode("append").parquet(source)
        stream = monitor_stream.log_stream(spark, source, spark.read.parquet(source).schema)
        monitor_stream.run_once(monitor_stream.suppressed(stream, "k", "t"), sink, state)
        got.append(sorted(r.t for r in spark.read.schema(schema).parquet(sink).collect()))
    assert got == [[0.0], [0.0, 1801.0], [0.0, 1801.0]]


def test_first_non_empty(spark):
    a, b = spark.range(0), spark.range(2)
    assert io.first_non_empty(a, b).count() == 2 and io.first_non_empty(b, a).count() == 2 and io.first_non_empty(a, a).count() == 0
