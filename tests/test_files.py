"""Workbooks, image fingerprints and the decontamination that uses them."""

import struct
import zipfile
import zlib

import numpy as np
from pyspark.sql import functions as F

from millrace.functions import images
from millrace.operators import references
from millrace.sources import xlsx


def workbook(path, rows, shared):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    cell = lambda r, c, v: f'<c r="{chr(65 + c)}{r}" t="s"><v>{shared.index(v)}</v></c>' if v in shared else f'<c r="{chr(65 + c)}{r}"><v>{v}</v></c>' if v is not None else ""
    body = "".join(f'<row r="{r}">' + "".join(cell(r, c, v) for c, v in enumerate(row)) + "</row>" for r, row in enumerate(rows, 1))
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><t>{s}</t></si>" for s in shared) + "</sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")


def test_workbooks(spark, tmp_path):
    words = ["index", "prediction", "Yes.", "no &amp; none"]
    workbook(tmp_path / "T1.xlsx", [["index", "prediction", None], [1, "Yes."], [2, None], [None, "no &amp; none"]], words)
    workbook(tmp_path / "T2.xlsx", [["prediction", "other"], ["Yes.", 4]], [*words, "other"])
    (tmp_path / "T3.xlsx").write_bytes(b"broken")
    got = xlsx.read_xlsx(spark, str(tmp_path), "index int, prediction string")
    assert sorted((r.file[-7:], r["index"], r.prediction) for r in got.fillna(-1).fillna("").collect()) == [("T1.xlsx", -1, "no & none"), ("T1.xlsx", 1, "Yes."), ("T1.xlsx", 2, ""), ("T2.xlsx", -1, "Yes.")]
    newest = xlsx.newest_workbooks(got.withColumn("model", F.lit("m")), ["model"])
    assert [r.prediction for r in newest.collect()] == ["Yes."]


def png(pixels, rule=0):
    height, width, channels = pixels.shape
    lines, above = [], np.zeros((width, channels), dtype=np.int64)
    for line in pixels.astype(np.int64):
        left = np.vstack([np.zeros((1, channels), dtype=np.int64), line[:-1]])
        corner = np.vstack([np.zeros((1, channels), dtype=np.int64), above[:-1]])
        p = left + above - corner
        a, b, c = abs(p - left), abs(p - above), abs(p - corner)
        guess = [0, left, above, (left + above) >> 1, np.where((a <= b) & (a <= c), left, np.where(b <= c, above, corner))][rule]
        lines.append(bytes([rule]) + ((line - guess) & 255).astype(np.uint8).tobytes())
        above = line
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, {1: 0, 3: 2}[channels], 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(lines))) + chunk(b"IEND", b"")


def bmp(pixels):
    height, width, _ = pixels.shape
    pad = -(width * 3) % 4
    body = b"".join(row[:, ::-1].tobytes() + b"\0" * pad for row in pixels[::-1])
    return b"BM" + struct.pack("<IHHI", 54 + len(body), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, width, height, 1, 24, 0, 0, 0, 0, 0, 0) + body


def test_images_of_any_form_have_one_fingerprint(spark):
    rng = np.random.default_rng(3)
    picture = np.repeat(np.repeat(rng.integers(0, 256, (5, 7, 3), dtype=np.uint8), 6, axis=0), 5, axis=1)
    for rule in range(5):
        assert (images.decode_png(png(picture, rule)) == picture).all()
    assert (images.decode_bmp(bmp(picture)) == picture).all()
    small = rng.integers(0, 256, (16, 16, 1), dtype=np.uint8)
    assert (images.reduced(small[:, :, 0]) == small[:, :, 0]).all()  # of that size already
    assert (images.reduced(np.full((40, 9), 77)) == 77).all()
    train = spark.createDataFrame([(1, png(picture)), (2, bmp(picture)), (3, png(small, 4)), (4, b"\x89PNG\r\n\x1a\nbroken"), (5, None), (6, b"")], "id int, content binary")
    prints = train.select("id", images.image_fingerprint(F.col("content")).alias("print"))
    by_id = {r.id: r["print"] for r in prints.collect()}
    assert by_id[1] == by_id[2] != by_id[3] and by_id[4] is by_id[5] is by_id[6] is None
    held_out = spark.createDataFrame([(png(picture, 2),)], "content binary").select(images.image_fingerprint(F.col("content")).alias("print"))
    assert [r.id for r in prints.join(held_out, "print", "left_semi").orderBy("id").collect()] == [1, 2]


def test_hot_buckets_of_references_are_spread(spark, monkeypatch):
    rows = [("t", i, "images", f"a/{i % 7}.jpg", "2024-03-01") for i in range(300)]
    ref = spark.createDataFrame(rows, "src_table string, row_id long, field string, path string, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    parents = spark.createDataFrame([("a/1.jpg", "2024-01-01", None), ("a/2.jpg", "2024-04-01", None), ("a/3.jpg", "2024-01-01", "2024-02-01")], "path string, added_at string, removed_at string")
    parents = parents.select("path", F.col("added_at").cast("timestamp_ntz").alias("added_at"), F.col("removed_at").cast("timestamp_ntz").alias("removed_at"))
    whole = sorted(map(tuple, references.orphan_references(ref, parents).collect()))
    monkeypatch.setattr(references, "SALT_ROWS", 10)
    assert sorted(map(tuple, references.orphan_references(ref, parents).collect())) == whole
    kinds = {int(r[3][2]): r[5] for r in whole}
    assert kinds == {0: "missing", 2: "late", 3: "deleted", 4: "missing", 5: "missing", 6: "missing"}
