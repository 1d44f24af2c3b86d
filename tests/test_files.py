"""File systems by URI, folders listed level by level, globs."""

import fnmatch
import os
import re

import pytest
from conftest import rows

from manifestqc.sources import files
from manifestqc.sources.manifest import glob_pattern, list_files


def test_schemes_of_object_stores_are_mapped(monkeypatch):
    """No network: only what the file-system library would be asked for."""
    from pyarrow import fs
    asked = []

    class Fake:
        @staticmethod
        def from_uri(uri):
            asked.append(uri)
            return f"<{uri}>", uri.partition("://")[2]

    monkeypatch.setattr(fs, "FileSystem", Fake)
    where = files.FileSystems("hdfs://name:8020")
    assert where.locate("s3a://bucket/a/b.fq") == ("<s3://bucket/>", "bucket/a/b.fq")
    assert where.locate("s3n://bucket/c") == ("<s3://bucket/>", "bucket/c") and where.locate("s3://bucket/d")[1] == "bucket/d"
    assert where.locate("gs://g/x") == ("<gs://g/>", "g/x")
    assert where.locate("/plain/x") == ("<hdfs://name:8020/>", "/plain/x")
    assert asked == ["s3://bucket/", "gs://g/", "hdfs://name:8020/"]
    assert files.file_system("s3a://bucket/out") == ("<s3://bucket/out>", "bucket/out")
    assert files.known_uri("/a/b") == "/a/b" and files.known_uri("wasbs://c@h/p") == "abfss://c@h/p"


def test_local_paths(tmp_path):
    where = files.FileSystems("")
    assert where.locate(str(tmp_path))[1] == str(tmp_path) and where.locate(f"file://{tmp_path}")[1] == str(tmp_path)


def test_listing_finds_hidden_names_and_every_level(spark, tmp_path):
    want = []
    for name in ("a.fq", "_b.fastq", ".c.fq.gz", "x/d.fq", "x/.y/_z/e.fastq.gz", "x/notes.txt", "w/empty.bam", "deep/1/2/3/4/f.fq"):
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"@" * len(name))
        if re.search(r"\.(fastq|fq)(\.gz)?$", name):
            want.append((str(p), p.name, len(name)))
    (tmp_path / "x" / "nothing").mkdir()
    os.symlink(tmp_path, tmp_path / "x" / "round")  # a link that leads round
    assert rows(list_files(spark, str(tmp_path)), "path", "name", "length") == sorted(want)
    assert rows(list_files(spark, f"file://{tmp_path}"), "path", "name", "length") == sorted(want)
    assert [r[1] for r in rows(list_files(spark, str(tmp_path), recursive=False), "path", "name")] == sorted(["a.fq", "_b.fastq", ".c.fq.gz"])
    with pytest.raises(FileNotFoundError):
        list_files(spark, str(tmp_path / "absent"))


def test_globs():
    for glob in ("*.fq", "a?c", "[ab]*", "[!a]x", "x.y"):
        for name in ("a.fq", "abc", "ac", "bx", "ax", "x.y", "xzy", ".fq", "a.fq2"):
            assert bool(re.match(glob_pattern(glob).replace("\\z", "\\Z"), name)) == fnmatch.fnmatchcase(name, glob), (glob, name)
    assert re.match(glob_pattern("*.{fastq,fq.gz}").replace("\\z", "\\Z"), "a.fq.gz") and not re.match(glob_pattern("*.{fastq,fq.gz}").replace("\\z", "\\Z"), "a.fq")
