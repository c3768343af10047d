"""The page catalog over real image files, numbering over many ranges, and records that are set aside."""

import struct
import zlib

from pyspark.sql import functions as F

from scriva import sinks
from scriva.plans import metrics, quarantine
from scriva.sources import pages


def png(width, height):
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    rows = b"".join(b"\0" + b"\x80" * width for _ in range(height))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def test_images_under_a_path(spark, tmp_path):
    for name, size in (("scan_10.png", (600, 700)), ("Scan_2.png", (501, 900)), ("small.PNG", (400, 900)), ("wide_3.png", (900, 500))):
        (tmp_path / name).write_bytes(png(*size))
    (tmp_path / "notes.txt").write_text("no image")
    (tmp_path / "broken.png").write_bytes(b"\x89PNG\r\n\x1a\nnothing")
    found = pages.read_images(spark, str(tmp_path))
    assert {(r["image_path"].split("/")[-1], r["width"], r["height"]) for r in found.collect()} == {("scan_10.png", 600, 700), ("Scan_2.png", 501, 900), ("small.PNG", 400, 900), ("wide_3.png", 900, 500)}
    placed = pages.number(pages.large_enough(found))
    assert {r["image_path"].split("/")[-1]: r["page_idx"] for r in placed.collect()} == {"Scan_2.png": 1, "scan_10.png": 2}


def test_numbering_over_ranges(spark):
    many = spark.range(5000, numPartitions=7).select(F.concat(F.lit("p"), (F.col("id") * 7919 % 5000).cast("string"), F.lit(".png")).alias("image_path"))
    got = {r["image_path"]: r["page_idx"] for r in pages.number(many).collect()}
    assert got == {f"p{k}.png": k + 1 for k in range(5000)}
    assert pages.number(many.limit(0)).count() == 0


def test_failed_records(spark):
    rows = [(1, "rec_1", "a.png", "text", None), (2, None, "b.png", None, None), (3, "rec_3", "c.png", "text", "missing anchor"), (4, None, None, "", None)]
    good, failed = quarantine.parted(spark.createDataFrame(rows, "record_id long, record_no string, image_name string, text string, error string"))
    assert sorted(r["record_id"] for r in good.collect()) == [1, 4] and "error" not in good.columns
    assert sorted(tuple(r) for r in failed.collect()) == [(2, "rec_2", "b.png", quarantine.NO_TEXT), (3, "rec_3", "c.png", "missing anchor")]
    review = sinks.failed_review(failed).where("record_id = 3").first().asDict()
    assert {v for k, v in review.items() if k not in ("record_id", "VALIDATION_ERRORS")} == {""} and review["VALIDATION_ERRORS"] == "missing anchor"
    assert {(r["RECORD_NO"], r["STATUS"], r["ERRORS"]) for r in sinks.failed_log(failed).collect()} == {("rec_2", "ERROR", quarantine.NO_TEXT), ("rec_3", "ERROR", "missing anchor")}
    done = spark.createDataFrame([("PASS",), ("REVIEW",)], "status string")
    assert tuple(metrics.summary(done, failed).first()) == (4, 1, 3) and tuple(metrics.summary(done).first()) == (2, 1, 1)
