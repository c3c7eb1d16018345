import hashlib

import pytest

from cratelight.llm import warc

BIG = "é" * 700
PAGES = [
    (1, "http://a/x y", "small"), (2, None, "small"), (3, "http://b\r\nWARC-Type: evil", BIG), (9, "u", BIG), (4, "u", BIG), (5, "u", None), (6, "u", ""),
    (None, "u", BIG), (7, "u", "a\r\n\r\nWARC/1.1\r\n\r\nb" * 100), (8, "u", "z" * 2_000_000), (10, "u", "n" * 1000), (10, "u", "n" * 1000), (11, "u", "n" * 1000 + "x"),
]


@pytest.fixture(scope="module")
def archives(spark):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, digest string").repartition(2)
    return warc.write_archives(pages, frame_bytes=3000, archive_bytes=2000)


def test_round_trip(archives):
    got = sorted((tuple(r) for r in warc.read_archives(archives).collect()), key=str)
    want = []
    for page_id, _, html in PAGES:
        payload = (html or "").encode()
        revisit = html == BIG and page_id != 9
        want.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", 9 if revisit else None))
    assert got == sorted(want, key=str)


def test_seek_and_fetch(spark, archives):
    index = warc.index_of(archives).collect()
    content = {r.archive: bytes(r.content) for r in archives.collect()}
    assert len(content) > 1 and sum(len(warc.frames(c)) for c in content.values()) > len(content)
    for r in index:
        data = warc.frame(content[r.archive], r.frame)[r.start : r.start + r.length]
        (_, length, header, _), = warc.parse(data)
        assert length == r.length and header["WARC-Record-ID"] == f"<{r.record_id}>" and header["WARC-Type"] in ("response", "revisit")
    found = warc.fetch(archives, spark.createDataFrame([(7,), (8,), (77,)], "page_id long")).collect()
    assert sorted(r.page_id for r in found) == [7, 8]


def test_files(archives, tmp_path):
    import zstandard

    assert warc.save_files(archives, f"file://{tmp_path}/out") == archives.count()
    for file in (tmp_path / "out").iterdir():
        data = zstandard.ZstdDecompressor().stream_reader(file.read_bytes(), read_across_frames=True).read()
        assert sum(1 for _ in warc.parse(data)) > 0
