import glob
import hashlib
import io
import struct

import pytest
import zstandard

from daybook.llm import warc
from daybook.scratch import Scratch

SCHEMA = "page_id long, url string, html string"
PAGES = [(i, f"http://x/{i % 50}", f"<html><body>{i % 40} é " + "some common words of a page " * 20 + "</body></html>") for i in range(400)]


def want(rows):
    holder = {}
    for i, _, h in rows:
        if i is not None:
            holder[h or ""] = max(holder.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        p, to = (h or "").encode(), holder.get(h or "")
        to = None if to == i else to
        out.append((i, len(p), warc.base32_sha1(p), "response" if to is None else "revisit", to))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_round_trip(spark):
    rows = PAGES + [(900, None, None), (901, "", ""), (902, "a b\r\nEvil: 1", "x" * 3_000_000), (None, "u", "only null"), (None, "u", PAGES[0][2])]
    assert got(warc.round_trip(spark.createDataFrame(rows, SCHEMA).repartition(2))) == want(rows)


def test_repeated_rows_are_responses(spark):
    rows = [(7, "u", "same"), (7, "u", "same"), (3, "u", "same")]
    assert [r[3] for r in got(warc.round_trip(spark.createDataFrame(rows, SCHEMA)))] == ["revisit", "response", "response"]


def test_empty_table_and_clashing_columns(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, "u", "a", 5, "z")], SCHEMA + ", size int, sha1 string")
    assert got(warc.round_trip(df)) == want([(1, "u", "a")])


def test_small_payloads_are_all_responses(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], SCHEMA)
    assert {r[0]: r[4] for r in got(warc.round_trip(df, smallest=3))} == {1: None, 2: None, 3: 4, 4: None}


def test_dictionary_frame_and_single_records(spark):
    scratch = Scratch(spark, "test")
    root = scratch.path("archives")
    pages = spark.createDataFrame(PAGES, SCHEMA).coalesce(1)
    manifest = warc.write_archives(pages, root, archive_bytes=8_000, dictionary_from=60_000, dictionary_bytes=4096)
    assert manifest.count() > 1
    for row in manifest.collect():
        data = open(glob.glob(f"{root.removeprefix('file:')}/{row['archive']}")[0], "rb").read()
        magic, size = struct.unpack("<II", data[:8])
        assert magic == warc.DICTIONARY_MAGIC
        dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + size])
        rest, records = data[8 + size :], 0
        while rest:  # each record is a frame by itself
            plain = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
            assert plain.decompress(rest).startswith(b"WARC/1.1\r\nWARC-Type: ")
            rest, records = plain.unused_data, records + 1
        assert records == row["records"] + 1
    back = warc.read_archives(manifest, root).collect()
    assert {int(r["page_id"]): bytes(r["payload"]).decode() for r in back if r["record_type"] == "response"} == {i: h for i, _, h in PAGES if i >= 360}


def test_folders_as_spark_names_them(spark, tmp_path):
    pages = spark.createDataFrame(PAGES[:30], SCHEMA)
    for root in (f"{tmp_path}/plain", f"file:{tmp_path}/one", f"file://{tmp_path}/three"):
        manifest = warc.write_archives(pages, root)
        names = {r["archive"] for r in manifest.collect()}
        assert names and names == {x.rpartition("/")[2] for x in glob.glob(f"{root.partition(':')[2].replace('//', '') or root}/*.warc.zst")}
        assert warc.read_archives(manifest, root).count() == 30
    assert warc.store("file:/a/b")[1] == "/a/b" and warc.store("file:///a/b")[1] == "/a/b"
    with pytest.raises(ValueError, match="can't be written"):
        warc.store("unknown://host/folder")


def test_long_lists_of_repeated_payloads(spark, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    rows = PAGES + [(900, None, None), (901, "", ""), (None, "u", PAGES[0][2])]
    assert got(warc.round_trip(spark.createDataFrame(rows, SCHEMA).repartition(3))) == want(rows)


def test_too_few_records_make_no_dictionary():
    assert warc.train([b"a"]) is None
    plain = zstandard.ZstdCompressor().compress(warc.record(1, "u", b"x", 1, warc.base32_sha1(b"x"), None, "n"))
    (headers, block), = warc.read_records(io.BytesIO(plain))
    assert headers["X-Page-Id"] == "1" and block.endswith(b"\r\n\r\nx") and headers["WARC-Payload-Digest"].endswith(warc.base32_sha1(b"x"))
    assert len(hashlib.sha1(b"x").digest()) == 20
