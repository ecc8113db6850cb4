"""Readers and writers of the file formats that curation jobs exchange."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.session import exists
from millrace.sources import schemas


#: Timestamps without zone keep their microseconds in text.
_NTZ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that is one JSON array."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object a line; blank lines are skipped, a bad line raises."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("timestampNTZFormat", _NTZ).json(path)


def write_jsonl(df: DataFrame, path: str, limit: int | None = None) -> int:
    """Writes one object a line and returns the number of rows.

    A limit is tested after a row is written, so 0 still writes one. The
    count comes from the written files, not from a second run of the plan.
    """
    out = df if limit is None else df.limit(max(limit, 1))
    out.write.mode("overwrite").option("ignoreNullFields", False).option("timestampNTZFormat", _NTZ).json(path)
    return df.sparkSession.read.text(path).count()


def read_parquet_tree(spark: SparkSession, path: str, pattern: str = "*.parquet", schema: str | None = None) -> DataFrame:
    """All Parquet files below a folder; unreadable ones are skipped.

    Without ``schema`` it is merged from the readable footers, which reads
    every file's; give one where there are many.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option("ignoreCorruptFiles", True)
    return (reader.schema(schema) if schema else reader.option("mergeSchema", True)).parquet(path)


def read_shards(spark: SparkSession, paths: Sequence[str], schema: str) -> DataFrame:
    """Parquet shards in order of name; none give an empty table."""
    return spark.read.schema(schema).parquet(*sorted(paths)) if paths else spark.createDataFrame([], schema)


def save_parquet(df: DataFrame, path: str) -> bool:
    """Writes a table unless it is empty; says whether it did."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet table; with aggregate push-down only footers are read."""
    return spark.read.parquet(path).count()


def read_json_tolerant(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Good rows of JSON array files, and the names of files that are broken or no arrays of objects."""
    files = spark.read.text(path, wholetext=True).withColumn("_file", F.input_file_name())
    parsed = files.select("_file", F.when(F.ltrim("value").startswith("["), F.from_json("value", f"array<struct<{_as_struct(schema)}>>")).alias("_rows"))
    good = parsed.select(F.explode("_rows").alias("r")).where("r IS NOT NULL").select("r.*")
    return good, parsed.where("_rows IS NULL").select("_file")


def _as_struct(schema: str) -> str:
    """Column definitions in the form that a struct type takes."""
    return ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in StructType.fromDDL(schema))


def read_media(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """The listing of a media folder: path, length, time of change. Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return files.select("path", "length", "modificationTime")


def read_blobs(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path and bytes of media files."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "content")


def write_blobs(df: DataFrame, path: str) -> None:
    """Bytes (``content``) to a table keyed by their hash, each content once.

    Keyed by content, so two images of one question never share an entry. A
    table partitioned by leading hash digits replaces one file a blob, which
    would not scale.
    """
    keyed = df.where(F.col("content").isNotNull() & (F.length("content") > 0)).select(F.sha1("content").alias("key"), "content")
    once = keyed.groupBy("key").agg(F.first("content").alias("content")).withColumn("part", F.substring("key", 1, 2))
    once.write.mode("overwrite").partitionBy("part").parquet(path)


def read_zip_members(spark: SparkSession, path: str, prefix: str = "", contents: bool = False) -> DataFrame:
    """Members of zip archives below ``path`` (``archive, member, size, ok[, content]``) whose name starts with ``prefix``.

    ``ok`` says whether the member's checksum holds. One task an archive.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    packed = zipfile.ZipFile(io.BytesIO(blob))
                except zipfile.BadZipFile:
                    continue
                for info in packed.infolist():
                    if info.is_dir() or not info.filename.startswith(prefix):
                        continue
                    try:
                        body = packed.read(info)
                    except (zipfile.BadZipFile, OSError):
                        body = None
                    row = {"archive": [archive], "member": [info.filename], "size": [info.file_size], "ok": [body is not None]}
                    yield pa.RecordBatch.from_pydict(row | ({"content": [body]} if contents else {}), schema=pa.schema([("archive", pa.string()), ("member", pa.string()), ("size", pa.int64()), ("ok", pa.bool_()), *([("content", pa.binary())] if contents else [])]))

    return read_blobs(spark, path, "*.zip").mapInArrow(run, "archive string, member string, size long, ok boolean" + (", content binary" if contents else ""))


def read_arrow_streams(spark: SparkSession, path: str, column: str, kind: str) -> DataFrame:
    """One column of Arrow stream shards; meant to be written as Parquet once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(1).to_pylist():
                for part in pa.ipc.open_stream(blob):
                    yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(column))], names=[column])

    return read_blobs(spark, path, "*.arrow").mapInArrow(run, f"{column} {kind}")


def united(shards: Sequence[DataFrame]) -> DataFrame:
    """Shards of one schema, by name."""
    out = shards[0]
    for s in shards[1:]:
        out = out.unionByName(s)
    return out


def first_non_empty(*tables: DataFrame) -> DataFrame:
    """The first table with rows, else the last."""
    return next((t for t in tables[:-1] if not t.isEmpty()), tables[-1])


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """CSV with a header, columns in a fixed order, null as empty."""
    df.select(*columns).write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header; empty cells are null."""
    return spark.read.schema(schema).option("header", True).option("nullValue", "").csv(path)


def append_csv(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", True).option("nullValue", "").csv(path)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").csv(path)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """``file, metric, value`` of score files with one header and one value row.

    Names are trimmed, unquoted and in lower case; quoted cells may hold
    commas; cells that are no numbers are left out.
    """
    cell = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'  # commas outside quotes
    lines = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.split(F.trim("value"), r"\r?\n").alias("l")).where(F.size("l") > 1)
    pairs = lines.select("file", F.explode(F.arrays_zip(F.split(F.get("l", F.lit(0)), cell).alias("metric"), F.split(F.get("l", F.lit(1)), cell).alias("value"))).alias("c"))
    clean = lambda c: F.trim(F.regexp_replace(F.trim(c), '^"|"$', ""))
    return pairs.select("file", F.lower(clean("c.metric")).alias("metric"), clean("c.value").try_cast("double").alias("value")).where("value IS NOT NULL")


def read_log_objects(spark: SparkSession, path: str, schema: str = schemas.TRAINER_LINE) -> DataFrame:
    """Rows of a log of JSON lines, torn and other lines skipped."""
    return parse_log_objects(spark.read.text(path), "value", schema)


def parse_log_objects(lines: DataFrame, column: str, schema: str) -> DataFrame:
    """Objects of lines that start with a brace and parse; the rest is skipped."""
    opened = lines.where(F.ltrim(F.col(column)).startswith("{"))
    parsed = opened.withColumn("_row", F.from_json(column, schema + ", _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    return parsed.where("_row IS NOT NULL AND _row._corrupt IS NULL").select(*[c for c in lines.columns if c != column], "_row.*").drop("_corrupt")


def matching(files: DataFrame, path: str, globs: Sequence[str]) -> DataFrame:
    """Files whose whole path fits one of the globs; ``*`` and ``?`` stay within a folder."""
    rule = "|".join("".join({"*": "[^/]*", "?": "[^/]"}.get(c, re.escape(c)) for c in g) for g in globs)
    return files.where(F.col(path).rlike(f"^(?:{rule})$"))


def tail_lines(df: DataFrame, text: str, chars: int | None = None) -> DataFrame:
    """Lines (``line``, from 0) of whole texts or of their last ``chars`` characters, with carriage returns as line ends."""
    end = F.col(text) if chars is None else F.when(F.length(text) > chars, F.substring(F.col(text), -chars, chars)).otherwise(F.col(text))
    return df.select(*[c for c in df.columns if c != text], F.posexplode(F.split(F.translate(end, "\r", "\n"), "\n")).alias("line", "value"))


def parse_processes(lines: DataFrame, column: str) -> DataFrame:
    """``at, pid, name, mb`` of process log lines: a time, then ``pid:name:NMB`` entries."""
    rule = r"([0-9]+):(\S.*?):([0-9.]+)MB(?=\s|$)"
    line = F.trim(F.col(column))
    entries = lines.select(F.regexp_extract(line, r"^\S+", 0).alias("at"), F.explode(F.regexp_extract_all(line, F.lit(r"(?<=\s)" + rule), F.lit(0))).alias("e"))
    part = lambda i: F.regexp_extract("e", rule, i)
    return entries.select(F.col("at").try_cast("timestamp_ntz").alias("at"), part(1).cast("long").alias("pid"), part(2).alias("name"), part(3).try_cast("double").alias("mb"))


def format_process(pid, name, mb):
    """One entry of a process log line."""
    return F.concat(F.concat_ws(":", pid.cast("string"), name, mb.cast("string")), F.lit("MB"))


def register_datasets(spark: SparkSession, root: str, registry: Mapping[str, Mapping]) -> list[str]:
    """Temporary views of a registry: name to ``file_name`` and, optionally, ``columns`` (new name to old).

    Returns the names of entries whose file is not there.
    """
    missing = []
    for name, entry in registry.items():
        path = f"{root}/{entry['file_name']}"
        if not exists(spark, path):
            missing.append(name)
            continue
        df = spark.read.parquet(path) if path.endswith(".parquet") else spark.read.json(path)
        renames = entry.get("columns") or {}
        (df.select(*[F.col(old).alias(new) for new, old in renames.items()]) if renames else df).createOrReplaceTempView(name)
    return missing
