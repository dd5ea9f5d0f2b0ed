import gzip
import hashlib

import pytest
from pyarrow import fs

from skyfold.llm import files, warc
from skyfold.session import new_path

KIND = "page_id long, url string, html string, digest string, shard int"
LONG = "x" * 120


def archived(spark, rows, **options):
    folder = new_path(spark, "archives")
    manifest = warc.write_archives(spark.createDataFrame(rows, KIND), folder, **options)
    return folder, manifest, warc.read_archives(spark, folder, manifest)


def test_classes_and_round_trip(spark):
    rows = [(5, "u5", LONG, "", 1), (2, "u2", LONG, "", 1), (9, None, None, "", 1), (1, "u1", "short", "", 1), (3, "u3", "short", "", 1), (None, "un", LONG, "", 1), (4, "u\r\n4", "ü" * 50, "", 1), (4, "u4", "ü" * 50, "", 1), (2, "u2", LONG, "", 1)]
    _, manifest, back = archived(spark, rows, shard_bytes=3000, roll_bytes=600)
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload).decode()) for r in back.collect()), key=str)
    want = [(5, 120, "revisit", 2, None), (2, 120, "response", None, LONG), (2, 120, "response", None, LONG), (9, 0, "response", None, ""), (1, 5, "response", None, "short"), (3, 5, "response", None, "short"), (None, 120, "revisit", 2, None)]
    want += [(4, 100, "response", None, "ü" * 50)] * 2
    assert got == sorted(want, key=str)
    assert all(r.payload_digest == hashlib.sha256((LONG if r.payload_bytes == 120 else {9: "", 1: "short", 3: "short", 4: "ü" * 50}[r.page_id]).encode()).hexdigest() for r in back.collect())
    assert manifest.count() > 2 and sum(r.records for r in manifest.collect()) == 9


def test_no_pages(spark):
    assert archived(spark, [])[2].count() == 0


def test_same_pages_give_the_same_files(spark):
    rows = [(i, f"u{i}", f"page {i % 7} " * (i % 50 + 1), "", 0) for i in range(300)]
    one, two = (archived(spark, given, shard_bytes=8000, roll_bytes=2000)[1] for given in (rows, rows[::-1]))
    key = lambda m: sorted((r.name, r.sha256, r.records) for r in m.collect())
    assert key(one) == key(two) and len(key(one)) > 15


def test_files_are_sorted_and_listed(spark):
    rows = [(i * 37 % 200, f"u{i}", f"<p>{i}</p>" * 40, "", 0) for i in range(200)]
    folder, manifest, back = archived(spark, rows, shard_bytes=10_000)
    store, root = files.filesystem(folder)
    last = -1
    for r in manifest.orderBy("shard", "seq").collect():
        with store.open_input_stream(f"{root}/{r.name}", compression=None) as f:
            content = f.read()
        assert hashlib.sha256(content).hexdigest() == r.sha256 and gzip.decompress(content).startswith(b"WARC/1.1\r\n")
        for headers, _ in warc.parsed(content):
            assert warc.page_of(headers["WARC-Record-ID"]) > last
            last = warc.page_of(headers["WARC-Record-ID"])
    files.write_file(folder, f"shard-99999999-00000{warc.SUFFIX}", [warc.record(999, "u", b"stray", None)])
    assert back.where("page_id = 999").count() == 0 and back.count() == 200
    assert [f for f in store.get_file_info(fs.FileSelector(f"{root}/_temporary")) if f.is_file] == []


def test_damage_is_found():
    content = warc.record(1, "u", b"payload", None)
    assert len(list(warc.parsed(content * 2))) == 2
    with pytest.raises(ValueError):
        list(warc.parsed(content + content[:-9]))
    with pytest.raises(ValueError):
        list(warc.parsed(gzip.compress(gzip.decompress(content).replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n"))))


def test_reading_is_linear():
    """A file of the size that production rolls at, of many records."""
    import time

    one = warc.record(1, "u", bytes(range(256)) * 4, None)
    content = one * ((16 << 20) // len(one))
    began = time.time()
    assert sum(1 for _ in warc.parsed(content)) == len(content) // len(one)
    assert time.time() - began < 20
    with pytest.raises(ValueError, match="ends within"):
        list(warc.parsed(content[:-9]))


def test_payload_beyond_the_roll_size(spark, tmp_path):
    import random

    big = "".join(random.Random(1).choices("abcdefghijklmnopqrstuvwxyz0123456789", k=300_000))
    pages = spark.createDataFrame([(i, "u", big + str(i % 2)) for i in range(4)] + [(9, "u", "x"), (None, "u", "y"), (None, "u", big + "0"), (None, None, None)], "page_id long, url string, html string")
    folder = str(tmp_path / "w")
    manifest = warc.write_archives(pages, folder, shard_bytes=10**9, roll_bytes=50_000)
    got = warc.read_archives(spark, folder, manifest).collect()
    kinds = sorted((r.page_id, r.record_type, r.refers_to) for r in got if r.page_id is not None)
    assert kinds == [(0, "response", None), (1, "response", None), (2, "revisit", 0), (3, "revisit", 1), (9, "response", None)]
    assert {(r.record_type, r.refers_to) for r in got if r.page_id is None} == {("response", None), ("revisit", 0)} and len(got) == 8
    assert manifest.count() >= 3


@pytest.mark.parametrize("harm", ["missing", "altered", "cut"])
def test_listed_files_must_be_there_whole(spark, tmp_path, harm):
    pages = spark.createDataFrame([(i, "u", f"page {i} " * 40) for i in range(50)], "page_id long, url string, html string")
    folder = tmp_path / "w"
    manifest = warc.write_archives(pages, str(folder), shard_bytes=4000)
    assert warc.read_archives(spark, str(folder), manifest).count() == 50
    file = sorted(p for p in folder.iterdir() if p.name.endswith(warc.SUFFIX))[1]
    other = sorted(p for p in folder.iterdir() if p.name.endswith(warc.SUFFIX))[0]
    if harm == "missing":
        file.unlink()
    else:
        file.write_bytes(other.read_bytes() if harm == "altered" else file.read_bytes()[:-5])
    with pytest.raises(Exception, match="missing|damaged|ends within"):
        warc.read_archives(spark, str(folder), manifest).collect()


def test_writing_again_leaves_equal_files_alone(spark, tmp_path):
    from skyfold.llm.files import write_file

    first = write_file(str(tmp_path), "a", [b"x", b"y"])
    before = (tmp_path / "a").stat().st_mtime_ns
    assert write_file(str(tmp_path), "a", [b"xy"]) == first and (tmp_path / "a").stat().st_mtime_ns == before
    assert write_file(str(tmp_path), "a", [b"z"]) != first and (tmp_path / "a").read_bytes() == b"z"
    assert not list((tmp_path / "_temporary").iterdir())
