"""Headers inside payloads that claim impossible lengths."""

import pytest

from tidemark.llm import warc

LENGTHS = ["2147483647", "2147483648", "3000000000", "9223372036854775807", "9223372036854775808", "9" * 40, "", "-5", "+7", "0", "1e3", " 12 "]


def inner(length):
    return f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:1>\r\nContent-Length: {length}\r\n\r\nabc\r\n\r\n"


@pytest.mark.parametrize("before, bin_size", [("", 1 << 22), ("<p>text</p>" * 50, 64)])
def test_hostile_lengths(spark, tmp_path, monkeypatch, before, bin_size):
    monkeypatch.setattr(warc, "BIN", bin_size)
    pages = [(i, "http://a/", before + inner(length) + "tail") for i, length in enumerate(LENGTHS)]
    pages.append((100, "http://a/", "".join(inner(length) for length in LENGTHS)))
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    warc.write(df, f"{tmp_path}/w")
    rows = warc.read(spark, f"{tmp_path}/w").select("*", warc.page_key("id").alias("page")).collect()
    want = {str(p): len(h.encode()) for p, _, h in pages}
    assert {r.page: r.held_bytes for r in rows} == want and len(rows) == len(pages)
    assert all(r.type == "response" and r.named_digest == "sha1:" + r.held_digest for r in rows)


def test_record_past_the_end(spark, tmp_path):
    """A reached record that claims more than its file holds what there is; nothing behind it is a record."""
    head = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:9>\r\nContent-Length: {}\r\n\r\n"
    http = "HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc"
    good = head.format(len(http)) + http + "\r\n\r\n"
    for length in ("9223372036854775000", "3000000000"):
        folder = tmp_path / length
        folder.mkdir()
        with open(folder / "a.txt", "w", newline="") as f:
            f.write(good + head.format(length) + http + "\r\n\r\n" + good)
        rows = sorted(warc.read(spark, str(folder)).collect(), key=lambda r: r.start)
        assert [r.start for r in rows] == [0, len(good)]
        assert rows[0].held_bytes == 3 and rows[1].held_bytes > 3


def test_offsets_over_splits(spark, tmp_path):
    """Splits far smaller than a record, and many files in a task, give the same records."""
    pages = [(i, "http://a/", inner(3) * (i % 3) + "é" * (37 * i % 400)) for i in range(200)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5)
    warc.write(df, f"{tmp_path}/w")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        rows = warc.read(spark, f"{tmp_path}/w").select("*", warc.page_key("id").alias("page")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(rows) == 200 and all(r.named_digest == "sha1:" + r.held_digest for r in rows if r.type == "response")


def test_texts_stay_out_of_shuffles(spark, tmp_path, monkeypatch):
    """Only pieces of broken records are shuffled with their texts."""
    df = spark.createDataFrame([(1, "u", "x" * 100), (2, "u", inner(5))], "page_id long, url string, html string")
    warc.write(df, f"{tmp_path}/w")
    seen = []
    joined = warc._placed

    def watch(rows, bases):
        out = joined(rows, bases)
        seen.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(warc, "_placed", watch)
    assert warc.read(spark, f"{tmp_path}/w").count() == 2
    assert len(seen) == 2 and not any("hashpartitioning" in plan for plan in seen)
