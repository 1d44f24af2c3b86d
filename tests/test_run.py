"""End-to-end flows over files."""

import os
import tempfile

from manifestqc.plans.run import generate_templates, summary, validate_files
from manifestqc.sources.manifest import read_manifest

PROJECT = ("sample_name\tcollection_date\tgeo_loc_name\tlat_lon\tsample_source\thost\tfilename\n"
           "s1\t7/24/2017\tUSA\t36.9513, -122.0733\thost\t\ts1_R1.fq\n"
           "s2\t24-Jul-2017\tUSA: Ohio, Cincinnati\t\tenvironment\t\ts2_R1.fq\n"
           "s3\t\tCanada\t\tenvironmental\t\ts3.fq\n"
           "\t\t\t\t\t\t\n")
SAMPLE = ("sample_name\tlibrary_ID\tlibrary_layout\tplatform\tfilename\tfilename2\n"
          "s1\t\tPE\t\ts1_R1.fq\ts1_R2.fq\n"
          "s2\tL2\tpaired\tillumina\ts2_R1.fq\t\n"
          "s3\tL3\tsingle\tILLUMINA\ts3.fq\t\n")


def _files(d, names):
    for n in names:
        with open(os.path.join(d, n), "w") as fh:
            fh.write("@r\nACGT\n+\n!!!!\n")


def test_validate_files_strict_and_report(spark):
    d = tempfile.mkdtemp()
    data = os.path.join(d, "data")
    os.makedirs(data)
    _files(data, ["s1_R1.fq", "s1_R2.fq", "s2_R1.fq", "s3.fq"])
    p = os.path.join(d, "project.txt")
    s = os.path.join(d, "sample.txt")
    open(p, "w").write(PROJECT)
    open(s, "w").write(SAMPLE)
    out = os.path.join(d, "out")
    po, so, found, passed = validate_files(spark, p, s, None, file_dir=data, output_dir=out, strict=True)
    assert passed is False  # blank date in s3 is a strict failure
    assert not os.path.exists(out)  # gate first, nothing written
    rules = {r.rule for r in summary(found).collect()}
    assert "blank_date" in rules and "missing_file" not in rules
    po, so, found, passed = validate_files(spark, p, s, None, file_dir=data, output_dir=out)
    back = {r.sample_name: r for r in read_manifest(spark, os.path.join(out, "validated-project")).collect()}
    assert back["s1"].collection_date == "2017-07-24" and back["s1"].lat_lon == "36.9513 N 122.0733 W"
    assert back["s1"].sample_source == "host-associated" and back["s3"].collection_date == "not collected"
    assert back["s2"].geo_loc_name == "USA: Ohio, Cincinnati" and back["s3"].geo_loc_name == "Canada:"
    assert sorted(back) == ["s1", "s2", "s3"] and back["s1"].file_number == "1"
    sm = {r.sample_name: r for r in read_manifest(spark, os.path.join(out, "validated-sample")).collect()}
    assert sm["s1"].library_ID == "s1" and sm["s1"].library_layout == "paired" and sm["s1"].platform == "ILLUMINA"
    assert sm["s2"].platform == "ILLUMINA"


def test_generate_templates(spark):
    d = tempfile.mkdtemp()
    data = os.path.join(d, "data")
    os.makedirs(os.path.join(data, "sub"))
    _files(data, ["a_R1.fastq.gz", "a_R2.fastq.gz", "sub/b_1.fq", "sub/b_2.fq", "c.fastq", "notes.txt"])
    s_out, p_out = generate_templates(spark, data, os.path.join(d, "out"),
                                      {"default_values": {"platform": "ILLUMINA", "collection_date": "2020"}})
    samples = {r.sample_name: r for r in read_manifest(spark, s_out).collect()}
    assert set(samples) == {"a", "b", "c.fastq"}
    assert samples["a"].library_layout == "paired" and samples["c.fastq"].library_layout == "single"
    assert samples["b"].filepath.endswith("/sub/b_1.fq") and samples["a"].platform == "ILLUMINA"
    proj = read_manifest(spark, p_out).collect()
    assert len(proj) == 1 and proj[0].collection_date == "2020" and proj[0].host is None


def test_cli_validate_strict_exit(spark, capsys):
    from manifestqc.cli import main
    d = tempfile.mkdtemp()
    p = os.path.join(d, "project.txt")
    s = os.path.join(d, "sample.txt")
    open(p, "w").write(PROJECT)
    open(s, "w").write(SAMPLE)
    code = main(["validate", "--project", p, "--sample", s, "--strict", "--instrument", "MyScope 1"])
    assert code == 1
    assert "blank_date" in capsys.readouterr().out


def test_cli_templates(spark, capsys):
    import json
    from manifestqc.cli import main
    d = tempfile.mkdtemp()
    data = os.path.join(d, "data")
    os.makedirs(data)
    _files(data, ["x_R1.fq", "x_R2.fq", "y.fastq"])
    assert main(["templates", "--file-dir", data, "--output-dir", os.path.join(d, "out")]) == 0
    paths = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    names = sorted(r.sample_name for r in read_manifest(spark, paths["sample"]).collect())
    assert names == ["x", "y.fastq"]


def test_one_table_policies_and_schema(spark, tmp_path):
    import pytest

    from manifestqc.plans.validate import MissingFiles
    data = tmp_path / "data"
    data.mkdir()
    _files(str(data), ["s1_R1.fq", "s1_R2.fq", "s3.fq"])  # s2 has a missing file
    (tmp_path / "sample.txt").write_text(SAMPLE)
    path = str(tmp_path / "sample.txt")

    def run(**kw):
        return validate_files(spark, None, path, None, file_dir=str(data), **kw)

    _, out, found, passed = run()
    assert not passed and {r.rule for r in found.collect()} >= {"missing_file"} and out.count() == 3
    _, out, found, passed = run(on_missing="drop", strict=True, output_dir=str(tmp_path / "out"))
    assert sorted(r.sample_name for r in out.collect()) == ["s1", "s3"]
    assert [(r.rule, r.key) for r in found.where("rule in ('missing_file', 'removed_sample')").collect()] == [("removed_sample", "s2")]
    assert passed and sorted(r.sample_name for r in read_manifest(spark, str(tmp_path / "out" / "validated-sample")).collect()) == ["s1", "s3"]
    with pytest.raises(MissingFiles):
        run(on_missing="fail")
    with pytest.raises(ValueError):
        run(on_missing="keep")
    (tmp_path / "keyless.txt").write_text('title\thost\n"open\tx\nb\ty\tz\n')
    _, _, found, passed = validate_files(spark, None, str(tmp_path / "keyless.txt"), None, strict=True, output_dir=str(tmp_path / "none"))
    got = {(r.rule, r.row) for r in found.collect()}
    assert not passed and not (tmp_path / "none").exists()
    assert {("required_columns", None), ("file_columns", None), ("open_quote", 0), ("row_width", 1)} <= got


def test_stream_parses_cells_as_the_reader_does(spark, tmp_path):
    from manifestqc.streaming.normalize import read_manifest_stream
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('k\tt\th\na\t"5 inch\tHomo\nb\t"x\ty ""z"""\t\n')
    q = read_manifest_stream(spark, str(tmp_path / "in"), ["k", "t", "h"]).writeStream.format("memory").queryName("quoted_stream").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted(tuple(r)[:3] for r in spark.sql("select * from quoted_stream").collect()) == [("a", '"5 inch', "Homo"), ("b", 'x\ty "z"', None)]


def _sizes(folder, name=""):
    out = {}
    for at, _, files in os.walk(folder):
        for f in files:
            if f.startswith(name):
                out[os.path.join(at, f)] = os.path.getsize(os.path.join(at, f))
    return out


def test_validate_files_leaves_little_on_disk(spark, tmp_path):
    """No lines, no rows of the tables and no shuffle files stay: what is kept is far smaller than the manifests."""
    import time

    from manifestqc.session import ensure_checkpoint_dir
    n, changed = 20_000, ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.files.minPartitionNum")
    with open(tmp_path / "project.txt", "w") as p, open(tmp_path / "sample.txt", "w") as s:
        p.write("sample_name\tcollection_date\tplace\tno 1\thost a,b;{}\tplatform\tfilename\n")
        s.write("sample_name\tlibrary_ID\tlibrary_layout\tplatform\tfilename\tfilename2\n")
        for i in range(n):
            name = "" if i % 100 == 7 else f"s{i}"
            p.write(f"{name}\t24-Jul-2017\tUSA: Ohio, Cincinnati\t{i % 9}\tsome longer text that comes again\tillumina\ts{i}_R1.fq\n")
            s.write(f"{name}\t\t{'PE' if i % 2 else 'single'}\tILLUMINA\ts{i}_R1.fq\ts{i}_R2.fq\n")
    local = [str(d) for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    scratch = ensure_checkpoint_dir(spark)
    before, settings = _sizes(scratch), [spark.conf.get(k, None) for k in changed]
    shuffled = {f for d in local for f in _sizes(d, "shuffle_")}
    inventory = spark.createDataFrame([(f"/d/s{i}_R{k}.fq",) for i in range(n) for k in (1, 2) if i % 500], "path string")
    po, so, found, passed = validate_files(spark, str(tmp_path / "project.txt"), str(tmp_path / "sample.txt"), inventory=inventory, base="/d", output_dir=str(tmp_path / "out"))
    text = sum(os.path.getsize(tmp_path / f"{t}.txt") for t in ("project", "sample"))
    kept = sum(v for f, v in _sizes(scratch).items() if f not in before)
    assert 0 < kept < 0.5 * text
    for _ in range(40):  # files are removed in the background
        left = sum(v for d in local for f, v in _sizes(d, "shuffle_").items() if f not in shuffled)
        if left < 0.1 * text:
            break
        time.sleep(0.25)
    assert left < 0.1 * text
    assert [spark.conf.get(k, None) for k in changed] == settings
    counts = {r.rule: r.n_issues for r in summary(found).collect()}
    assert counts["missing_file"] == 2 * sum(1 for i in range(0, n, 500) if i % 100 != 7) and counts["blank_key"] == 2 * n // 100
    for out, name in ((po, "project"), (so, "sample")):
        rows, back = out.orderBy("_row").collect(), read_manifest(spark, str(tmp_path / "out" / f"validated-{name}")).orderBy("_row").collect()
        assert [r.sample_name for r in back] == [r.sample_name for r in rows] == [f"s{i}" for i in range(n) if i % 100 != 7]
        assert [r._row for r in rows] == [i for i in range(n) if i % 100 != 7]
    assert [r.file_number for r in po.orderBy("_row").collect()] == list(range(1, po.count() + 1))
    assert {"place", "host a,b;{}"} <= set(po.columns)
