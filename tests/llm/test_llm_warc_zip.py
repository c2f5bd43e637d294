import hashlib
import io
import random
import zipfile

import pyarrow as pa
import pytest

from pricelake.llm import warc_zip as Z


def brute(rows):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= Z.REVISIT_BYTES and i is not None:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, u, h in rows:
        b = (h or "").encode()
        again = b in first and i != first[b]
        out.append((i, u or "", "revisit" if again else "response", first[b] if again else None,
                    hashlib.sha256(b).hexdigest(), len(b), None if again else b))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Z, "PACKAGE_BYTES", 4000)
    r = random.Random(5)
    big = "".join(chr(r.randrange(32, 0x2FF)) for _ in range(300_000))
    rows = [(9, "http://a/", "x" * 100), (4, "http://b/ c", "x" * 100), (5, None, "x" * 99), (6, "é", "x" * 99), (7, "u", None),
            (8, "u\r\nInjected: 1", ""), (None, "n", "x" * 100), (4, "again", "x" * 100), (11, "big", big), (10, "big2", big),
            (12, "crlf", "a\r\n\r\nb" * 40)]
    rows += [(100 + k, f"http://h/{k}", f"page {k % 50} " * 20) for k in range(200)]
    df = spark.createDataFrame([(*x, "d", "n") for x in rows], "page_id long, url string, html string, digest string, n string").repartition(3)
    manifest = Z.write_archives(df, str(tmp_path / "packages"))
    assert manifest.count() > 3
    got = [(*x[:6], x.payload if x.payload is None else bytes(x.payload)) for x in Z.read_archives(manifest).collect()]
    want = [(i, u.replace("\r", "%0D").replace("\n", "%0A"), *rest) for i, u, *rest in brute(rows)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    manifest = Z.write_archives(df, str(tmp_path / "none"))
    assert manifest.count() == 0 and Z.read_archives(manifest).count() == 0


class Unseekable(io.BytesIO):
    def seekable(self):
        return False


def reader(data):
    return pa.BufferReader(data)


def test_directory_of_plain_and_zip64_files():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.comment = b"a comment with PK in it"
        z.writestr("é.txt", b"hello")
        with z.open(zipfile.ZipInfo("big"), "w", force_zip64=True) as f:
            f.write(b"world" * 1000)
        z.writestr(zipfile.ZipInfo("packed"), b"z" * 500, zipfile.ZIP_DEFLATED)
    f = reader(out.getvalue())
    d = Z.directory(f)
    assert list(d) == ["é.txt", "big", "packed"]
    for name, want in (("é.txt", b"hello"), ("big", b"world" * 1000)):
        at = Z.stored_start(f, d[name])
        assert out.getvalue()[at:at + d[name]["size"]] == want
    with pytest.raises(ValueError, match="not stored"):
        Z.stored_start(f, d["packed"])
    with pytest.raises(ValueError, match="no end"):
        Z.directory(reader(b"nothing here"))


def test_zip64_end_record_of_many_members():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for k in range(66_000):
            z.writestr(str(k), b"")
    d = Z.directory(reader(out.getvalue()))
    assert len(d) == 66_000 and d["65999"]["size"] == 0


def test_zip64_extra_field_of_large_offsets():
    import struct
    big = 5 << 32
    extra = struct.pack("<HH", 0x7777, 2) + b"ab" + struct.pack("<HHQQ", 1, 16, big, big + 7)
    assert Z._extra64(extra, [0xFFFFFFFF, 12, 0xFFFFFFFF]) == [big, 12, big + 7]
