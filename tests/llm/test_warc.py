import base64
import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from mercato.llm import warc
from mercato.llm.warc import archived, read_records, write_archives

SHAPE = "page_id bigint, url string, html string, record_type int"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows, least=0):
    last = {}
    for page, _, text, _ in rows:
        if page is not None:
            last[text or ""] = max(page, last.get(text or "", page))
    out = []
    for page, _, text, _ in rows:
        size, to = len((text or "").encode()), last.get(text or "")
        revisit = size >= least and to is not None and to != page and sum((t or "") == (text or "") for _, _, t, _ in rows) > 1
        out.append((page, size, digest(text), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=repr)


def pages():
    rows = [(i, f"http://x.org/{i}?a=b c", f"<p>page {i % 40}</p>" * (1 + i % 40), 1) for i in range(120)]
    rows += [(200, None, None, 1), (201, "u\r\nX: y", "", 1), (202, "é", "ü" * 300_000, 1), (None, "n", "lone", 1)]
    return [*rows, (None, "n", rows[0][2], 1), (300, "r", "row", 1), (300, "r", "row", 1), (301, "w", "WARC/1.1\r\n\r\n", 1)]


@pytest.mark.parametrize("gap, most", [(64 << 10, 8 << 20), (0, 300), (-1, 1)])
@pytest.mark.parametrize("least", [0, 60])
def test_what_is_read_is_what_was_written(spark, monkeypatch, gap, most, least):
    """Reads of whole files, of short stretches and of single records."""
    monkeypatch.setattr(warc, "GAP", gap)
    monkeypatch.setattr(warc, "READ_BYTES", most)
    rows = pages()
    found = archived(spark.createDataFrame(rows, SHAPE).repartition(3), least=least)
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found.collect()]
    assert sorted(got, key=repr) == expected(rows, least)
    texts = {digest(t): (t or "").encode() for _, _, t, _ in rows}
    assert all(r.payload == texts[r.payload_digest] for r in found.collect() if r.record_type == "response")


def test_selected_records_are_read_alone(spark, tmp_path):
    rows = pages()
    folder = tmp_path.as_uri()
    index = write_archives(spark.createDataFrame(rows, SHAPE).repartition(2), folder)
    wanted = index.filter("url LIKE 'http://x.org/1%'")
    found = read_records(wanted, folder)
    assert {r.page_id for r in found.collect()} == {r.page_id for r in wanted.collect()}
    for row in index.collect():
        with open(f"{tmp_path}/{row.file}", "rb") as file:
            file.seek(row.offset)
            plain = gzip.decompress(file.read(row.length))
        assert plain.startswith(b"WARC/1.1\r\n") and f"sha1:{row.payload_digest}".encode() in plain
    # Whole files are valid streams of records, too.
    for name in os.listdir(tmp_path):
        if name.endswith(".warc.gz"):
            with gzip.open(f"{tmp_path}/{name}") as file:
                assert file.read().count(b"WARC-Record-ID") == index.filter(F.col("file") == name).count()


def test_a_damaged_payload_is_told():
    member = warc.record(1, "u", b"payload", digest("other"), None, None)
    fields, _, payload = warc.parse(member)
    assert warc.payload_digest(payload) != fields["WARC-Payload-Digest"].removeprefix("sha1:")


def test_no_pages(spark):
    assert archived(spark.createDataFrame([], SHAPE)).count() == 0
