import base64
import gzip
import hashlib
from collections import Counter
from pathlib import Path

import pytest

from orderlake.llm import warc

PAGES = [
    (1, "http://a/", "<p>one</p>"),
    (2, "http://b/", "<p>one</p>"),
    (3, "http://c/ü \r\n", "<p>zwei ü 漢</p>"),
    (4, None, None),
    (5, "http://d/", ""),
    (6, "http://e/", "x" * 300_000),
    (6, "http://e/", "x" * 300_000),
    (2, "http://b2/", "<p>one</p>"),
    (None, "http://n/", "<p>one</p>"),
    (None, None, "<p>alone</p>"),
    (7, "http://f/", "HTTP/1.1\r\n\r\nWARC/1.1\r\n\r\n"),
]


def expected(pages, least=0):
    rows = []
    for key, _, html in pages:
        data = (html or "").encode()
        same = [k for k, _, h in pages if (h or "").encode() == data and k is not None]
        first = max(same, default=None) if len(data) >= least else None
        visit = first is not None and key != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        rows.append((key, len(data), digest, "revisit" if visit else "response", first if visit else None))
    return Counter(rows)


def result(frame):
    return Counter(
        (r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
        for r in frame.collect()
    )


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(
        [(*r, "clash", 1) for r in PAGES], "page_id long, url string, html string, key string, shard int"
    )


def files(root):
    return {p.name: p.read_bytes() for p in Path(root).glob("*.warc.gz")}


def test_round_trip(spark, pages, tmp_path):
    warc.write_archive(pages, f"{tmp_path}/w")
    found = warc.read_archive(spark, f"{tmp_path}/w", with_payload=True)
    assert result(found) == expected(PAGES)
    wanted = Counter((h or "").encode() for _, _, h in set(PAGES))
    payloads = Counter(
        bytes(r["payload"]) for r in found.where("record_type = 'response'").collect()
    )
    assert set(payloads) == set(wanted)
    assert {r["url"] for r in found.collect()} >= {None, "http://a/", "http://b2/"}


def test_small_payloads_are_never_revisits(spark, pages, tmp_path):
    warc.write_archive(pages, f"{tmp_path}/w", min_revisit_bytes=11)
    assert result(warc.read_archive(spark, f"{tmp_path}/w")) == expected(PAGES, 11)


def test_same_rows_same_files(spark, pages, tmp_path):
    options = {"shard_bytes": 100_000, "file_bytes": 400}
    warc.write_archive(pages.repartition(7), f"{tmp_path}/a", **options)
    manifest = warc.write_archive(pages.coalesce(1), f"{tmp_path}/b", **options)
    first, second = files(f"{tmp_path}/a"), files(f"{tmp_path}/b")
    assert first == second and len(first) > 3
    for row in manifest.collect():
        data = first[row["file"]]
        assert (len(data), hashlib.sha256(data).hexdigest()) == (row["bytes"], row["sha256"])
    assert not (tmp_path / "a" / "_temporary").exists()
    assert result(warc.read_archive(spark, f"{tmp_path}/a")) == expected(PAGES)


def test_record_ids_are_unique_and_members_are_records(spark, pages, tmp_path):
    warc.write_archive(pages, f"{tmp_path}/w")
    ids = [r["record_id"] for r in warc.read_archive(spark, f"{tmp_path}/w").collect()]
    assert len(ids) == len(set(ids)) == len(PAGES)
    whole = b"".join(gzip.decompress(data) for data in files(f"{tmp_path}/w").values())
    assert whole.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")


def test_files_outside_the_manifest_are_not_read(spark, pages, tmp_path):
    warc.write_archive(pages, f"{tmp_path}/w")
    (tmp_path / "w" / "part-000099-000000.warc.gz").write_bytes(b"left by a lost attempt")
    assert result(warc.read_archive(spark, f"{tmp_path}/w")) == expected(PAGES)


def test_damage_is_noticed(spark, pages, tmp_path):
    data = warc._member([("WARC-Block-Digest", "sha1:" + "A" * 32)], b"block")
    with pytest.raises(ValueError, match="damaged"):
        warc.parse_record(gzip.decompress(data))


def test_no_pages(spark, pages, tmp_path):
    assert warc.write_archive(pages.where("false"), f"{tmp_path}/w").count() == 0
    assert warc.read_archive(spark, f"{tmp_path}/w").count() == 0
