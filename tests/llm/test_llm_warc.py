import gzip
import hashlib
import random

import pandas as pd
from odd_rows import plain
from pyspark.sql import functions as F

from rebasket.llm import warc
from rebasket.llm.warc import LoserTree, order, records, url_key
from rebasket.session import fresh_path

SCHEMA = "page_id long, url string, html string"


def pages(spark):
    big, small = "é" * 600, "s" * 10
    rows = [
        (1, "http://b.example.com/x?b=2&a=1#f", big), (5, "https://www.a.example.com/", big), (5, "u", big), (3, None, big),
        (None, "http://a b.com/\r\nWARC/1.1", big), (2, "http://c.example.com", small), (4, "http://c.example.com", small), (6, "x", None),
        (7, "http://d.example.com", "WARC/1.1\r\n\r\n\r\n" * 100), (None, "y", "n" * 2000), (8, "", "Content-Length: 3\r\n\r\n"),
    ]
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("payload", "digest", "holder", "range", "block")})


def test_index_of_odd_pages(spark):
    found = warc.capture_index(pages(spark)).toPandas()
    assert len(found) == 11
    big = hashlib.sha1(("é" * 600).encode()).hexdigest()
    of = found[found.payload_digest == big]
    assert sorted((-1 if pd.isna(i) else int(i), t, -1 if pd.isna(r) else int(r)) for i, t, r in zip(of.page_id, of.record_type, of.refers_to)) == [
        (-1, "revisit", 5), (1, "revisit", 5), (3, "revisit", 5), (5, "response", -1), (5, "response", -1)]
    assert set(of.payload_bytes) == {1200}
    rest = found[found.payload_digest != big]
    assert set(rest.record_type) == {"response"} and rest.refers_to.isna().all()
    assert int(found[found.page_id == 6].payload_bytes.iloc[0]) == 0


def test_archives_are_plain_warc(spark, tmp_path):
    path = str(tmp_path / "warc")
    warc.write_archives(pages(spark).repartition(2), path)
    seen = 0
    for file in (tmp_path / "warc").glob("*.gz"):
        data = gzip.decompress(file.read_bytes())
        for offset, headers, content, start in records(data):
            assert data[offset:].startswith(b"WARC/1.1\r\n") and data[start + len(content):start + len(content) + 4] == b"\r\n\r\n"
            if headers["WARC-Type"] == "revisit":
                assert content.endswith(b"\r\n\r\n") and headers["WARC-Refers-To"] == "<urn:page:5>"
            seen += 1
    assert seen == 11


def test_index_is_globally_ordered_and_hot_urls_are_spread(spark):
    one = spark.range(3000).select(
        F.col("id").alias("page_id"), F.when(F.col("id") % 3 == 0, F.lit("http://hot.example.com/")).otherwise(
            F.concat(F.lit("http://h"), F.col("id") % 50, F.lit(".example.com/"), F.col("id"))).alias("url"),
        F.concat(F.lit("<p>"), F.col("id")).alias("html"))
    found = warc.capture_index(one.repartition(5)).toPandas().sort_values(["range", "place"])
    keys = list(zip(found.url_key, found.captured, found.page_id))
    assert keys == sorted(keys) and len(keys) == 3000
    hot = found[found.url_key == "com,example,hot)/"]
    assert hot.range.nunique() > 3 and found.groupby("range").size().max() < 600


def test_empty_table(spark):
    assert plain(warc.capture_index(spark.createDataFrame([], SCHEMA))) == []


def test_loser_tree_merges_any_number_of_runs():
    draw = random.Random(5)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(draw.choices(range(20), k=draw.randrange(9))) for _ in range(k)]
        assert list(LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_url_keys():
    assert url_key("HTTPS://user@www.Example.COM:443/A?b=2&a=1#x") == "com,example)/a?a=1&b=2"
    assert url_key("http://example.com:8080") == "com,example:8080)/"
    assert url_key("http://[bad") == "http://[bad" and url_key("") == ")/"
    assert order(("k", "t", None, 0, 0, 0, 0, "f", 1)) < order(("k", "t", 0, 0, 0, 0, 0, "f", 0))


def test_corrupt_payload_is_an_error(spark):
    path = fresh_path(spark, "warc-bad")
    warc.with_revisits(pages(spark)).limit(3).withColumn("payload_digest", F.lit("0" * 40)).select(
        warc.record(F.timestamp_seconds(F.lit(0))).alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)
    try:
        warc.index_runs(spark, path).collect()
    except Exception as found:
        assert "wrong payload" in str(found)
    else:
        raise AssertionError("a wrong payload passed")
