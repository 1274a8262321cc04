import base64
import hashlib

import zstandard
from pyspark.sql import functions as F

from payloom.llm.warc import open_input, parse, read_records, read_warc, write_warc


def brute(rows):
    """(page_id, bytes, digest, type, refers_to) of rows (page_id, url, html)."""
    last = {}
    for page, _, html in rows:
        if page is not None:
            last[html or ""] = max(page, last.get(html or "", page))
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        to = last.get(html or "") if page is not None else None
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page, len(body), digest, "response" if to in (page, None) else "revisit", to if to not in (page, None) else None))
    return sorted(out, key=repr)


def records(df):
    files = write_warc(df)
    got = read_warc(files).select("record_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return files, sorted(map(tuple, got.collect()), key=repr)


def test_round_trip(spark):
    rows = [(1, "http://a/", "x"), (2, "http://b/ c\r\nX-Evil: 1", "x"), (3, None, None), (4, "u", ""), (5, "u", "é" * 70000),
            (None, "n", "x"), (6, "u", "a\r\n\r\nb"), (7, "u", "dup"), (7, "u", "dup"), (8, "u", "dup"), (9, "u", "x" * 3_000_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("refers_to", F.lit(1)).withColumn("salt", F.lit(2))
    files, got = records(df)
    assert got == brute(rows)
    payloads = {r.record_id: bytes(r.payload).decode() for r in read_warc(files).filter("record_type = 'response' AND record_id IS NOT NULL").collect()}
    assert payloads[6] == "a\r\n\r\nb" and payloads[9] == "x" * 3_000_000
    assert read_warc(files).filter("record_id = 2").first().url == "http://b/%20c%0D%0AX-Evil:%201".replace("/%20", "/%20")


def test_table_is_whole(spark, sf):
    df = spark.read.parquet(f"{sf}/pages.parquet")
    rows = [tuple(r) for r in df.select("page_id", "url", "html").collect()]
    files, got = records(df.unionByName(df.withColumn("page_id", F.col("page_id") + 1000)))
    assert got == brute(rows + [(p + 1000, u, h) for p, u, h in rows])
    assert files.agg(F.sum("n_records")).first()[0] == 2 * len(rows)


def test_files_carry_their_dictionary_and_records_stand_alone(spark, sf):
    path = write_warc(spark.read.parquet(f"{sf}/pages.parquet")).first().path
    places = [at for at, _ in read_records(path)]
    with open_input(path) as f:
        data = f.read()
    size = int.from_bytes(data[4:8], "little")
    assert int.from_bytes(data[:4], "little") == 0x184D2A5D
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8:8 + size]))
    end = places[-1]
    alone = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj().decompress(data[end:])
    assert parse(alone)[0] is not None


def test_empty_table(spark):
    assert read_warc(write_warc(spark.createDataFrame([], "page_id long, url string, html string"))).count() == 0
