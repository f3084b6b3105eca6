"""Bundles give back what was written; their frames can be read alone."""

import base64
import hashlib

import pytest
import zstandard
from pyarrow import fs

from tastegraph.llm import warc
from tastegraph.llm.common import run_path

ROWS = [
    (5, "http://a b/", "<p>same</p>", 1), (3, "http://x/", "<p>same</p>", 1), (9, None, "<p>same</p>", 1), (1, "u", None, 1), (2, "u", "", 1),
    (None, "u", "<p>same</p>", 1), (7, "u", "é\r\n\r\n" * 1000, 1), (8, "u", "WARC/1.1\r\n", 1), (11, "u", "x" * 2_500_000, 1),
]


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string, digest int")


def test_contract(pages):
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archived(pages).collect()}
    first = {"<p>same</p>": 3, "": 1}
    want = {}
    for page_id, _, html, _ in ROWS:
        text = html or ""
        refers = first.get(text) if first.get(text, page_id) != page_id else None
        want[page_id] = (len(text.encode()), sha(text), "revisit" if refers else "response", refers)
    assert got == want


def test_small_payloads_stay_responses(pages):
    got = warc.archived(pages, revisit_min_bytes=12).collect()
    assert {r.record_type for r in got} == {"response"} and len(got) == len(ROWS)


def test_repeated_rows_and_empty_table(spark, pages):
    twice = spark.createDataFrame([(1, "u", "a", 1), (1, "u", "a", 1), (2, "u", "a", 1)], pages.schema)
    assert sorted((r.page_id, r.record_type) for r in warc.archived(twice).collect()) == [(1, "response"), (1, "response"), (2, "revisit")]
    assert warc.archived(pages.where("false")).count() == 0


def test_one_record_from_one_frame(spark, pages):
    folder = "file://" + run_path(spark, "warc-test")
    index = warc.write_bundles(pages, folder).where("page_id = 7").head()
    files, path = fs.FileSystem.from_uri(folder)
    info = files.get_file_info(f"{path}/{index.bundle}")
    with files.open_input_file(info.path) as file:
        at, packed, plain = warc.read_seek_table(file, info.size)[index.frame]
        file.seek(at)
        frame = zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=plain)
        file.seek(0)
        whole = zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True).read()
    raw = frame[index.frame_offset:index.frame_offset + index.record_length]
    assert warc.parsed(raw)[4].decode() == ROWS[6][2]
    assert whole.startswith(b"WARC/1.1")


def test_a_second_attempt_changes_nothing(spark, pages):
    """Another attempt of the same partition, its rows in another order, ends after the index was written."""
    folder = "file://" + run_path(spark, "warc-test")
    index = warc.write_bundles(pages, folder)
    for partition in {r.bundle.split("-")[1] for r in index.select("bundle").collect()}:
        late = warc.BundleWriter(folder, partition, "99999")
        for page_id, url, html, _ in reversed(ROWS):
            late.add(warc.record(page_id, url, (html or "").encode() + b"late", sha((html or "") + "late"), None, False))
        late.close()
    got = {r.page_id: bytes(r.payload).decode() for r in warc.read_bundles(index, folder).collect() if r.record_type == "response"}
    assert got == {i: t or "" for i, _, t, _ in ROWS if i in got} and {1, 3, 7, 8, 11} == set(got)


def test_a_wrong_payload_is_found(spark):
    folder = "file://" + run_path(spark, "warc-test")
    files, path = fs.FileSystem.from_uri(folder)
    files.create_dir(path)
    writer = warc.BundleWriter(folder, "000000", "1")
    index = spark.createDataFrame([(1, *writer.add(warc.record(1, "u", b"changed", sha("written"), None, False)))], warc.INDEX)
    writer.close()
    with pytest.raises(Exception, match="does not have the digest"):
        warc.read_bundles(index, folder).collect()


def test_small_frames_and_bundles(pages, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 500)
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 200)
    test_contract(pages)
