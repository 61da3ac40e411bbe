import base64
import gzip
import hashlib
import re

import pytest

from stationtide.llm import warc


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def wanted(rows):
    """(page_id, bytes, digest, type, refers_to) of each row, from the whole list."""
    out = []
    for page_id, _, html in rows:
        ids = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        least = min(ids, default=None)
        revisit = least is not None and page_id != least
        out.append((page_id, len((html or "").encode()), sha(html), "revisit" if revisit else "response", least if revisit else None))
    return sorted(out, key=str)


def found(df):
    rows = df.collect()
    assert {r.problem for r in rows} <= {None}
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)


@pytest.mark.parametrize("segment, chunk", [(64 * 1024, 8192), (150, 7)])
def test_round_trip(spark, frame, monkeypatch, segment, chunk):
    monkeypatch.setattr(warc, "SEGMENT_BYTES", segment)
    monkeypatch.setattr(warc, "CHUNK_BYTES", chunk)
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()][:30]
    trap = "WARC/1.1\r\nWARC-Type: response\r\n\r\n0\r\n\r\n日本é\r\n\r\n"
    rows += [(900, "u\r\nX: y", trap * 20), (901, None, trap * 20), (902, "u", None), (903, "u", ""), (None, "u", ""), (None, "u", "alone"), (904, "u", "alone2"),
             (904, "u", "alone2"), (905, "u", "alone2"), (906, "u", "é" * 200_000), (907, "u", "\n")]
    pages = frame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS first", "'x' AS value", "3 AS problem")
    assert found(warc.archived_pages(pages)) == wanted(rows)


def test_archives_are_well_formed(spark, frame, tmp_path):
    path = f"{tmp_path}/warc"
    pages = frame([(i, f"http://a/{i}", "é" * (i * 9000)) for i in range(12)], "page_id long, url string, html string")
    warc.write_archives(pages, path)
    ids, origins, kinds = [], {}, []
    for file in sorted(tmp_path.glob("warc/*.gz")):
        data = gzip.decompress(file.read_bytes())
        assert data.endswith(b"\r\n\r\n")
        for fields, block in warc.parse(data):
            ids.append(fields["warc-record-id"])
            kinds.append(fields["warc-type"])
            assert len(block) <= warc.SEGMENT_BYTES and re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", ids[-1])
            origins.setdefault(fields.get("warc-segment-origin-id", ids[-1]), []).append((int(fields.get("warc-segment-number", 0)), fields.get("warc-segment-total-length"), len(block)))
    assert len(set(ids)) == len(ids) and kinds.count("response") == 12 and kinds.count("continuation") > 10
    for parts in origins.values():
        if len(parts) > 1:
            parts.sort()
            assert [p[0] for p in parts] == list(range(1, len(parts) + 1)) and int(parts[-1][1]) == sum(p[2] for p in parts)


def test_damage_is_named(spark, frame, tmp_path):
    path = tmp_path / "warc"
    warc.write_archives(frame([(1, "u", "x" * 300_000), (2, "u", "y" * 300_000), (3, "u", "z" * 300_000), (4, "u", "fine")], "page_id long, url string, html string").coalesce(1), str(path))
    out = b""
    for file in path.glob("*.gz"):
        for fields, block in warc.parse(file.read_bytes()):
            if block[:200].count(b"x") > 90 and fields.get("warc-segment-number") == "3":
                continue
            if block[:200].count(b"y") > 90 and fields.get("warc-segment-number") == "2":
                block = block[:-1]
            if block[:200].count(b"z") > 90 and fields.get("warc-segment-number") == "2":
                block = block.replace(b"zz", b"zq", 1)
            fields["content-length"] = str(len(block))
            out += b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields.items()) + b"\r\n" + block + b"\r\n\r\n"
    plain = tmp_path / "plain"
    plain.mkdir()
    (plain / "a.warc").write_bytes(out)
    assert {r.page_id: r.problem for r in warc.read_archives(spark, str(plain)).collect()} == {1: "segments", 2: "length", 3: "digest", 4: None}


def test_chunks():
    assert warc.dechunked(b"4;a=b\r\nWiki\r\n6\r\npedia \r\nE\r\nin \r\n\r\nchunks.\r\n0\r\nT: x\r\n\r\n") == b"Wikipedia in \r\n\r\nchunks."
    for bad in (b"4\r\nWik", b"zz\r\n", b"", b"3\r\nWikx\r\n0\r\n\r\n"):
        with pytest.raises(ValueError):
            warc.dechunked(bad)


def test_empty_table(frame):
    assert warc.archived_pages(frame([], "page_id long, url string, html string")).count() == 0


def test_a_damaged_file_is_read_as_far_as_it_goes(spark, frame, tmp_path):
    path = tmp_path / "warc"
    rows = [(-7, "u", "seven"), (1, "u", "one " * 50), (2, "u", "two " * 50), (3, "u", "three " * 50), (4, "u", "four " * 30_000)]
    warc.write_archives(frame(rows, "page_id long, url string, html string").coalesce(1), str(path))
    (file,) = path.glob("*.gz")
    records = list(warc.parse(file.read_bytes()))
    small = {f.get("page-id"): (f, b) for f, b in records if "warc-segment-number" not in f}
    records = [small[i] for i in ("-7", "2", "3", "1")] + [r for r in records if "warc-segment-number" in r[0]]
    assert all("problem" not in fields for fields, _ in records)

    def text(fields, block, length=None):
        fields = {k: v for k, v in fields.items() if k != "content-length"} | ({} if length is None else {"content-length": str(length)})
        return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields.items()) + b"\r\n" + block + b"\r\n\r\n"

    whole = [text(f, b, len(b)) for f, b in records]
    folder = tmp_path / "damaged"
    folder.mkdir()
    whole[1] = b"garbage\r\nmore\r\n" + whole[1]
    whole[3] = text(*records[3])  # no length
    (folder / "a.warc").write_bytes(b"".join(whole)[:-3000])
    (folder / "b.warc.gz").write_bytes(file.read_bytes()[:60])
    (folder / "c.warc").write_bytes(bytes(range(256)) * 9)
    (folder / "d.warc").write_bytes(b"")
    (folder / "e.warc").write_bytes(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 1\r\n\r\nx\r\n\r\n")
    got = warc.read_archives(spark, str(folder)).collect()
    assert {r.page_id: r.problem for r in got if r.page_id is not None} == {-7: None, 1: "archive", 2: None, 3: None, 4: "segments"}
    assert [r.problem for r in got if r.record_type == "damaged"] == ["archive"] * 4
