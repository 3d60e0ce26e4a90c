import hashlib
from functools import reduce

import pytest
import zstandard
from livegauge.llm import warc
from livegauge.llm.files import opened
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tests.llm.data import SMALL, clash, grouped, rows


def plain(found):
    """found: (id, html)."""
    data = [(i, (h or "").encode()) for i, h in found]
    groups = grouped((d, i) for i, d in data if i is not None)
    out = []
    for i, d in data:
        to = max(groups[d]) if len(d) >= 1000 and groups.get(d) and max(groups[d]) != i else None
        out.append((i, len(d), hashlib.sha1(d).hexdigest(), "response" if to is None else "revisit", to))
    return out


def read(spark, df):
    index = warc.write_archive(df, warc.archive_folder(spark))
    return index, rows(warc.read_archive(index))


def digest(r):
    return r["id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]


def awkward(spark):
    same = "<p>copy</p>" * 200
    found = [(1, "u1", same), (2, None, same), (3, "http://x/a b\r\nX: y", same), (4, "u4", same.upper()), (5, "u5", "short"), (6, "u6", "short")]
    found += [(7, "u7", None), (8, "u8", ""), (9, "ü", "<p>é漢😀\r\n\r\nWARC/1.1\r\n</p>" * 60), (10, "u", "x" * 3_000_000), (None, "n", same), (None, "n", same)]
    found += [(11, "r", same + "r"), (11, "r", same + "r"), (None, None, None), (12, "u", "z" * 999), (13, "u", "z" * 999), (14, "u", "z" * 1000), (15, "u", "z" * 1000)]
    return clash(spark.createDataFrame(found, "page_id long, url string, html string"))


def test_awkward_rows(spark):
    df = awkward(spark)
    _, have = read(spark, df)
    assert sorted(map(digest, have), key=str) == sorted(plain([(r["page_id"], r["html"]) for r in rows(df)]), key=str)
    payloads = {r["id"]: r["payload"] for r in have}
    assert all(payloads[r["page_id"]] in (None, r["html"] or "") for r in rows(df) if r["page_id"] is not None)
    assert {r["id"]: r["url"] for r in have}[3] == "http://x/a%20b%0D%0AX:%20y"


def test_names_and_references_of_records(spark):
    """Rows that repeat an id with other payloads have names of their own, and a revisit names the record it refers to."""
    same = "<p>copy</p>" * 200
    df = spark.createDataFrame([(1, "u", same), (2, "u", same), (2, "u", "a"), (2, "u", "b"), (1, "u", "c"), (1, "u", same)], "page_id long, url string, html string")
    index, _ = read(spark, df)
    heads = [warc.parse(warc.Bundle(r["bundle"]).frame(r["frame"]), r["offset"])[0] for r in rows(index)]
    names = [h["WARC-Record-ID"] for h in heads]
    assert len(set(names)) == 6
    target = {h["WARC-Record-ID"] for h in heads if h["X-Page-ID"] == "2" and "copy" not in h and h["WARC-Type"] == "response"}
    assert {h["WARC-Refers-To"] for h in heads if h["WARC-Type"] == "revisit"} <= target and sum(h["WARC-Type"] == "revisit" for h in heads) == 2


def test_bundles_are_read_by_tasks_of_their_own(spark):
    df = spark.read.parquet(f"{SMALL}/pages.parquet")
    folder = warc.archive_folder(spark)
    parts = [warc.write_archive(df.where(F.col("page_id") % 6 == n), folder) for n in range(6)]
    index = reduce(DataFrame.union, parts)
    bundles = index.select("bundle").distinct().count()
    found = warc.read_archive(index).select("id", F.spark_partition_id().alias("task"))
    assert found.count() == df.count() and bundles >= 6 and found.select("task").distinct().count() >= bundles - 1


def test_given_pages_round_trip(spark):
    df = spark.read.parquet(f"{SMALL}/pages.parquet")
    index, have = read(spark, df)
    source = {r["page_id"]: r for r in rows(df)}
    assert sorted(map(digest, have)) == sorted(plain([(i, r["html"]) for i, r in source.items()]))
    assert all(r["payload"] == (source[r["id"]]["html"] or "") for r in have if r["record_type"] == "response")
    for r in rows(index)[:20]:  # one record by its identifier, from one frame
        headers, _, end = warc.parse(warc.Bundle(r["bundle"]).frame(r["frame"]), r["offset"])
        assert headers["X-Page-ID"] == str(r["id"]) and end == r["offset"] + r["length"]


def test_a_bundle_is_one_zstandard_stream_with_a_seek_table(spark):
    index, _ = read(spark, awkward(spark))
    for path in {r["bundle"] for r in rows(index)}:
        with opened(path, "read") as file:
            data = file.read()
        bundle = warc.Bundle(path)
        frames = [bundle.frame(k) for k in range(len(bundle.sizes))]
        assert zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read() == b"".join(frames)
        assert bundle.starts[-1] + 8 + 8 * len(frames) + 9 == len(data)


def test_bundles_roll_over(spark, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 2000)
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 3000)
    df = spark.read.parquet(f"{SMALL}/pages.parquet").coalesce(1)
    index, have = read(spark, df)
    assert len(have) == df.count() and len({r["bundle"] for r in rows(index)}) > 3


def test_a_damaged_payload_is_noticed(spark):
    index, _ = read(spark, awkward(spark))
    path = rows(index)[0]["bundle"]
    with opened(path, "read") as file:
        data = bytearray(file.read())
    data[len(data) // 2] ^= 255
    with opened(path, "write") as file:
        file.write(bytes(data))
    with pytest.raises(Exception):  # noqa: B017
        rows(warc.read_archive(index))


def test_no_rows(spark):
    index, have = read(spark, awkward(spark).limit(0))
    assert not have and index.count() == 0
