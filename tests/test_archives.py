"""Archives made here, entry by entry, and read by Spark."""

import json
import lzma
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from siltstone import cli
from siltstone.operators.markdown import html_to_markdown
from siltstone.sources import archives

MIMES = ["text/html", "image/png", "text/html; charset=utf-8"]


def cluster(blobs, packing, wide=False):
    width, code = (8, "Q") if wide else (4, "I")
    offsets, at = [], width * (len(blobs) + 1)
    for b in [*blobs, b""]:
        offsets.append(at)
        at += len(b)
    data = struct.pack(f"<{len(offsets)}{code}", *offsets) + b"".join(blobs)
    data = {1: lambda d: d, 4: lambda d: lzma.compress(d), 5: lambda d: zstandard.compress(d)}[packing](data)
    return bytes([packing | (0x10 if wide else 0)]) + data


def archive(entries, clusters, version=6):
    """entries: (namespace, path, title, mime number, cluster, blob), or with "redirect" and an entry's number in place of the last three."""
    out = bytearray(80)
    mimes_at = len(out)
    out += b"".join(m.encode() + b"\0" for m in MIMES) + b"\0"
    dirents, places = [], []
    for namespace, path, title, kind, *rest in entries:
        text = path.encode() + b"\0" + title.encode() + b"\0"
        if kind == "redirect":
            dirents.append(struct.pack("<HBcII", 0xFFFF, 0, namespace.encode(), 0, rest[0]) + text)
        else:
            dirents.append(struct.pack("<HBcIII", kind, 0, namespace.encode(), 0, *rest) + text)
    for d in dirents:
        places.append(len(out))
        out += d
    paths_at = len(out)
    out += struct.pack(f"<{len(places)}Q", *places)
    starts = []
    for c in clusters:
        starts.append(len(out))
        out += c
    clusters_at = len(out)
    out += struct.pack(f"<{len(starts)}Q", *starts)
    checksum_at = len(out)
    out[:80] = struct.pack("<IHH16sIIQQQQIIQ", 72173914, version, 0, b"u" * 16, len(entries), len(clusters), paths_at, 0, clusters_at, mimes_at, 0xFFFFFFFF, 0xFFFFFFFF, checksum_at)
    return bytes(out + b"m" * 16)


def page(k):
    return f"<html><body><h1>Page {k}</h1><p>Tēxt {k} &amp; more {'word ' * (k % 7)}</p></body></html>".encode()


@pytest.fixture(scope="module")
def made(tmp_path_factory):
    """60 pages in five clusters of all kinds, pictures between them, redirects, and entries that stand in another order than contents."""
    folder = tmp_path_factory.mktemp("archives")
    packings = [(1, False), (4, False), (5, False), (1, True), (5, True)]
    clusters = [cluster([page(12 * c + j) if j < 12 else b"\x89png" * 50 for j in range(13)], *packings[c]) for c in range(5)]
    entries = [("C", f"p/{k:03}", "" if k % 2 else f"Titel {k}", 2 * (k % 2), k // 12, k % 12) for k in sorted(range(60), key=lambda k: k * 37 % 61)]
    entries += [("C", "moved", "Moved", "redirect", 3), ("I", "pic", "", 1, 2, 12), ("M", "Name", "", 0, 0, 0)]
    (folder / "a.zim").write_bytes(archive(entries, clusters))
    (folder / "b.zim").write_bytes(archive([("A", "one", "", 0, 0, 0)], [cluster([b"<p>\xff bad bytes</p>", b""], 5)], 5))
    (folder / "empty.zim").write_bytes(archive([], []))
    return folder


def test_entries(spark, made):
    spark.dataSource.register(archives.ArchiveSource)
    found = spark.read.format("zim_archive").option("path", str(made / "a.zim")).option("entriesPerTask", "7").load()
    assert found.rdd.getNumPartitions() == 9 and found.count() == 63
    moved = found.where("path = 'moved'").first()
    assert (moved["title"], moved["redirect"], moved["cluster"], moved["mime"]) == ("Moved", 3, None, None)
    assert found.where("namespace = 'C' AND mime LIKE 'text/html%'").select(F.collect_set("title")).first()[0].__len__() == 60
    assert archives.read_entries(spark, str(made / "empty.zim")).count() == 0


def test_pages(spark, made):
    got = archives.read_html(spark, *(str(made / f"{n}.zim") for n in ("a", "b", "empty")))
    assert {r["path"]: r["html"] for r in got.where("path LIKE 'p/%'").collect()} == {f"p/{k:03}": page(k).decode() for k in range(60)}
    assert [r["html"] for r in got.where("path = 'one'").collect()] == ["<p>� bad bytes</p>"] and got.count() == 61
    pictures = archives.with_contents(archives.read_entries(spark, str(made / "a.zim")).where("mime = 'image/png'"))
    assert [(r["path"], r["content"]) for r in pictures.collect()] == [("pic", b"\x89png" * 50)]


def test_large_contents_come_in_several_batches(spark, tmp_path):
    blobs = [bytes([65 + k]) * (6 << 20) for k in range(7)]
    (tmp_path / "l.zim").write_bytes(archive([("C", str(k), "", 0, 0, k) for k in range(7)], [cluster(blobs, 5)]))
    got = archives.read_html(spark, str(tmp_path / "l.zim")).select("path", F.length("html"), F.left("html", F.lit(1))).collect()
    assert sorted(map(tuple, got)) == [(str(k), 6 << 20, chr(65 + k)) for k in range(7)]


def broken():
    whole = archive([("C", "x", "", 0, 0, 0)], [cluster([page(1) * 50], 5)])
    good = cluster([b"a"], 1)
    yield "no archive", b"PK" + whole[2:], "not a ZIM archive"
    yield "version", archive([("C", "x", "", 0, 0, 0)], [good], 9), "version 9"
    yield "short", whole[:60], "archive ends"
    yield "directory", whole[:130], "archive ends"
    yield "mime", archive([("C", "x", "", 7, 0, 0)], [good]), "MIME type 7 of 3"
    yield "cluster", archive([("C", "x", "", 0, 4, 0)], [good]), "cluster 4 of 1"
    yield "blob", archive([("C", "x", "", 0, 0, 1)], [good]), "blob 1 of 1"
    yield "redirect", archive([("C", "x", "", "redirect", 5)], [good]), "redirect to entry 5"
    yield "packing", archive([("C", "x", "", 0, 0, 0)], [b"\x07" + good[1:]]), "compression 7"
    packed = cluster([page(1) * 50], 5)
    yield "stream", archive([("C", "x", "", 0, 0, 0)], [packed[:1] + b"\0" * 9 + packed[10:]]), "cluster 0"
    yield "cut", archive([("C", "x", "", 0, 0, 0)], [cluster([page(k) for k in range(90)], 4)[:-60]]), "cluster 0"


@pytest.mark.parametrize("case", [*broken()], ids=lambda c: c[0])
def test_broken_archives_are_errors_that_name_them(spark, tmp_path, case):
    name, data, message = case
    (tmp_path / "x.zim").write_bytes(data)
    with pytest.raises(Exception, match=f"x.zim: .*{message}"):
        archives.with_contents(archives.read_entries(spark, str(tmp_path / "x.zim"))).collect()


def test_extract_without_a_converter(spark, made, tmp_path):
    """Spark itself turns archives into Markdown; what is there is skipped, broken ones leave nothing."""
    (tmp_path / "datasets/base").mkdir(parents=True)
    (tmp_path / "datasets/base/a.zim").write_bytes((made / "a.zim").read_bytes())
    (tmp_path / "datasets/base/bad.zim").write_text("no archive")
    (tmp_path / "m").mkdir()
    (tmp_path / "m/base.json").write_text(json.dumps({f"datasets/base/{n}.zim": {"url": "u", "model": "lm-base", "size": 1} for n in ("a", "bad")}))
    command = ["--datasets", str(tmp_path / "m"), "--root", str(tmp_path), "extract", "--converter", "spark", "--per-file", "25", "--keep-going"]
    with pytest.raises(SystemExit, match="1 archives failed"):
        cli.main(command, spark)
    out = tmp_path / "datasets/base/markdown"
    assert [p.name for p in out.iterdir()] == ["a"] and sorted(p.name for p in (out / "a").iterdir()) == [f"a-{k:05}.md" for k in range(3)]
    text = "".join((out / "a" / f"a-{k:05}.md").read_text() for k in range(3))
    order = sorted(range(60), key=lambda k: k * 37 % 61)
    pages = spark.createDataFrame([(n, page(k).decode()) for n, k in enumerate(order)], "n int, html string").select("n", html_to_markdown(F.col("html")).alias("m")).orderBy("n").collect()
    assert text.replace("\n", "") == "".join(r["m"] for r in pages).replace("\n", "") and text.count("# Page") == 60
    before = {p.name: p.stat().st_mtime_ns for p in (out / "a").iterdir()}
    assert {r["key"]: r["action"] for r in cli.main([*command, "--dry-run"], spark).collect()} == {"datasets/base/a.zim": "skip", "datasets/base/bad.zim": "extract"}
    assert {p.name: p.stat().st_mtime_ns for p in (out / "a").iterdir()} == before
    with pytest.raises(RuntimeError, match="bad.zim"):
        cli.main(command[:-1], spark)
