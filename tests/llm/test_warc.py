import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from clickloom.llm import warc


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, record_type string, first int")


ROWS = [
    (7, "http://a.example/x y", "<p>" + "é" * 60),
    (3, "http://b.example/", "<p>" + "é" * 60),
    (9, None, "<p>" + "é" * 60),
    (1, "http://c.example/", "short"),
    (2, "http://d.example/", "short"),
    (4, "http://e.example/", None),
    (5, "http://f.example/", ""),
    (6, "", "WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\nfiledesc://x 1\n" * 5),
    (8, "http://h.example/", "a" * 100),
    (10, "http://i.example/", "a" * 100),
    (11, "http://j.example/", "b" * 99),
    (12, "http://k.example/", "b" * 99),
    (None, "http://l.example/", "a" * 100),
    (None, "http://l.example/", "c" * 200),
    (3, "http://b.example/", "<p>" + "é" * 60),
    (13, "http://m.example/", "long " * 50_000),
]


def text(row):
    return bytes(row.record).decode()


def plain(rows):
    payloads = [(i, (h or "").encode()) for i, _, h in rows]
    out = []
    for i, p in payloads:
        same = [k for k, q in payloads if q == p and k is not None]
        first = min(same, default=None) if len(p) >= 100 else i
        again = len(p) >= 100 and i != first
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def test_pages_through_both_formats(spark):
    got = warc.archive_pages(pages(spark, ROWS))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(ROWS)
    assert warc.archive_pages(pages(spark, [])).collect() == []


@pytest.mark.parametrize("version", ["1", "2"])
def test_arc_versions_keep_records(version):
    records = [("http://a b/\n", b"x\ny"), ("", b""), ("u", b"\n\nfiledesc://\n" * 3)]
    data = warc.arc_bytes("n.arc", records, version)
    got = list(warc.arc_records(data))
    assert [c for _, _, c in got] == [c for _, c in records]
    assert [f["URL"] for f, _, _ in got] == ["http://a%20b/%0A", "-", "u"]
    assert all(set(f) == set(warc.FIELDS[version].split()) for f, _, _ in got)
    for _, offset, content in got:
        assert content in data[offset:]


def test_foreign_arc_with_spaces_in_the_url_and_short_version_block():
    block = b"1 0 Somebody\n"
    data = b"filedesc://f.arc 1.2.3.4 19990101000000 text/plain %d\n" % len(block) + block
    data += b"http://a/b c 1.2.3.4 19990203040506 text/html 4\nabcd\n"
    ((fields, _, content),) = warc.arc_records(data)
    assert (fields["URL"], fields["Archive-date"], content) == ("http://a/b c", "19990203040506", b"abcd")
    with pytest.raises(ValueError):
        list(warc.arc_records(data[:-4]))
    with pytest.raises(ValueError):
        list(warc.arc_records(b"http://a 1 2 3 4\n"))


def test_version_1_converts_like_version_2(spark):
    made = [warc.converted(warc.pack_pages(pages(spark, ROWS[:6]), v)) for v in "12"]
    kinds = [sorted(text(r).split("\r\n")[1] for r in m.collect()) for m in made]
    assert kinds[0] == kinds[1] == ["WARC-Type: response"] * 4 + ["WARC-Type: revisit"] * 2


def test_records_are_synthesised_the_same_way_again(spark):
    packed = warc.pack_pages(pages(spark, ROWS).coalesce(1))
    one, two = (sorted(text(r) for r in warc.converted(packed).collect()) for _ in range(2))
    assert one == two
    assert all("WARC-Date: 2024-01-01T00:00:00Z" in r and "WARC-Record-ID: <urn:uuid:" in r for r in one)


def test_written_files_are_gzipped_warc(spark, tmp_path):
    folder = str(tmp_path / "w")
    warc.write_warc(warc.converted(warc.pack_pages(pages(spark, ROWS))), folder)
    blocks = []
    for file in (tmp_path / "w").glob("part-*"):
        data = file.read_bytes()
        records = list(warc.warc_records(data))
        blocks += records
        rest = io.BytesIO(gzip.decompress(data)).read()
        assert rest.startswith(b"WARC/1.1\r\n") and rest.endswith(b"\r\n\r\n")
    assert len(blocks) == len(ROWS)
    revisits = [f for f, _ in blocks if f["WARC-Type"] == "revisit"]
    ids = {f["WARC-Record-ID"] for f, _ in blocks}
    assert len(revisits) == 4 and all(f["WARC-Refers-To"] in ids and f["WARC-Profile"] == warc.SAME_PAYLOAD for f in revisits)
    assert len(ids) == len(ROWS)


def test_several_gzip_members_are_one_file():
    record = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    got = list(warc.warc_records(gzip.compress(record) + gzip.compress(record * 2)))
    assert [b for _, b in got] == [b"abc"] * 3


def test_damage_is_seen(spark, tmp_path):
    folder = tmp_path / "w"
    folder.mkdir()
    data = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: x\r\nWARC-Block-Digest: sha256:00\r\nWARC-Payload-Digest: sha256:00\r\n"
    (folder / "part-0.txt.gz").write_bytes(gzip.compress(data + b"Content-Length: 3\r\n\r\nabc\r\n\r\n"))
    with pytest.raises(Exception, match="damaged"):
        warc.read_warc(spark, str(folder)).agg(F.count("*")).collect()


#: Contents that are not UTF-8: a Latin-1 page, a GIF, a response of each, and a URL in Latin-1.
FOREIGN = [
    (b"http://a.example/latin", b"HTTP/1.0 200 OK\r\nX-Title: caf\xe9\r\n\r\n" + b"<p>caf\xe9 \xfcber\xff</p>" * 20),
    (b"http://a.example/pic.gif", b"HTTP/1.0 200 OK\r\n\r\nGIF89a\x00\x01\x80\xff\xfe\r\n\r\n\x00" + bytes(range(256)) * 2),
    (b"http://a.example/raw.gif", b"GIF89a\xff\x00\n" + bytes(range(255, -1, -1))),
    (b"http://a.example/again.gif", b"HTTP/1.0 200 OK\r\n\r\nGIF89a\x00\x01\x80\xff\xfe\r\n\r\n\x00" + bytes(range(256)) * 2),
    (b"http://a.example/caf\xe9 x", b"HTTP/1.0 200 OK\r\n\r\n\xff"),
]


def foreign_arc(packed):
    """An ARC 1 file; ``packed`` gives each record, and the description, a gzip member of its own."""
    block = b"1 0 Somebody\nURL IP-address Archive-date Content-type Archive-length\n"
    parts = [b"filedesc://f.arc 1.2.3.4 19990101000000 text/plain %d\n" % len(block) + block + b"\n"]
    parts += [u + b" 1.2.3.4 19990203040506 image/gif %d\n" % len(c) + c + b"\n" for u, c in FOREIGN]
    return b"".join(map(gzip.compress, parts)) if packed else b"".join(parts)


@pytest.mark.parametrize("kind", ["plain", "member by member", "one member"])
def test_any_bytes_are_converted_unchanged(spark, tmp_path, kind):
    (tmp_path / "arc").mkdir()
    data = foreign_arc(kind == "member by member")
    (tmp_path / "arc" / "f.arc.gz").write_bytes(gzip.compress(data) if kind == "one member" else data)
    archives = warc.read_arc(spark, str(tmp_path / "arc"))
    folder = str(tmp_path / "warc")
    warc.write_warc(warc.converted(archives), folder)
    blocks = {}
    for file in (tmp_path / "warc").glob("part-*"):
        for fields, block in warc.warc_records(file.read_bytes()):
            blocks[fields["WARC-Target-URI"]] = (fields["WARC-Type"], fields["WARC-Payload-Digest"], block)
    assert len(blocks) == len(FOREIGN)
    # records without a page id count as the same page, so none is a revisit
    assert {own for own, _, _ in blocks.values()} == {"response"}
    for url, content in FOREIGN:
        _, digest, block = blocks[url.replace(b"\xe9", b"%E9").decode()]
        _, payload = warc.split_response(content)
        assert digest == "sha256:" + hashlib.sha256(payload).hexdigest()
        assert block == content
    back = warc.read_warc(spark, folder).collect()
    assert sorted(r.payload_bytes for r in back) == sorted(len(warc.split_response(c)[1]) for _, c in FOREIGN)


def test_a_lost_response_is_an_error(spark, tmp_path, monkeypatch):
    """Files that differ between the passes never lose a revisit silently."""
    made = warc.records

    def other_ids(archives, payloads):
        rows = made(archives, payloads)
        return rows if payloads else rows.withColumn("record_id", F.concat("record_id", F.lit("x")))

    monkeypatch.setattr(warc, "records", other_ids)
    with pytest.raises(Exception, match="no record"):
        warc.archive_pages(pages(spark, ROWS)).collect()


def test_a_shuffled_source(spark):
    got = warc.archive_pages(pages(spark, ROWS).repartition(5, "url").orderBy("page_id"))
    assert sorted(map(tuple, got.collect()), key=str) == plain(ROWS)
