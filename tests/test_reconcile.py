"""Reconciliation on the made-up fixture F6 and pairing F5."""

from pyspark.sql import functions as F

from manifestqc.operators import reconcile as R
from manifestqc.operators.pairs import build_samples, detect_pairs, prepare_table, project_template
from manifestqc.plans.validate import validate_pair


def _f6(spark):
    s = spark.createDataFrame([
        ("s1", "s1_R1.fq", "s1_R2.fq", 0), ("s2", "s2_R1.fq", "s2_R2.fq", 1), ("s2", "s2_R1.fq", "s2_R2.fq", 2),
        ("s3", "/abs/s3.fq", "", 3), (None, None, None, 4)], "sample_name string, filename string, filename2 string, _row long")
    p = spark.createDataFrame([("s1", "/other/s1_R1.fq", 0), ("s2", "zz.fq", 1), ("s4", None, 2)],
                              "sample_name string, filename string, _row long")
    inv = spark.createDataFrame([("/d/s1_R1.fq",), ("/d/s1_R2.fq",), ("/d/s2_R1.fq",)], "path string")
    return s, p, inv


def test_f6_reconcile(spark):
    s, p, inv = _f6(spark)
    d = R.duplicate_keys(s).collect()
    assert [(r.key, r.n_rows, r.first_row, r.last_row) for r in d] == [("s2", 2, 1, 2)]
    refs = R.file_refs(s, base="/d")
    miss = sorted(r.path for r in R.missing_files(refs, inv).collect())
    assert miss == ["/abs/s3.fq", "/d/s2_R2.fq", "/d/s2_R2.fq"]
    bad = R.missing_files(refs, inv).select("key").distinct()
    kept_s = sorted(str(r.sample_name) for r in R.remove_samples(s, bad).collect())
    assert kept_s == ["None", "s1"]
    assert sorted(r.sample_name for r in R.remove_samples(p, bad).collect()) == ["s1", "s4"]
    mm = R.filename_mismatch(s, p).collect()
    assert [(r.key, r.column) for r in mm] == [("s2", "filename")]
    cov = sorted((r.key, r.only_in) for r in R.key_coverage(s, p).collect())
    assert cov == [("s3", "sample"), ("s4", "project")]
    fc = R.file_counts(R.verify_files(refs, inv)).first()
    assert (fc.n_found, fc.n_missing, fc.n_samples_missing, fc.all_exist) == (4, 3, 2, False)


def test_validate_pair_drop(spark):
    s, p, inv = _f6(spark)
    po, so, iss = validate_pair(p, s, {"default_values": {}}, inventory=inv, base="/d", on_missing="drop")
    _, _, iss2 = validate_pair(p, s, {"default_values": {}}, inventory=inv, base="/d")
    assert sorted(r.sample_name for r in so.collect()) == ["s1"]
    assert sorted(r.sample_name for r in po.collect()) == ["s1", "s4"]
    rules = {r.rule for r in iss.collect()} | {r.rule for r in iss2.collect()}
    assert {"missing_file", "key_coverage", "duplicate_keys"} <= rules


def test_f5_pairs(spark):
    files = "a_R1.fastq.gz a_R2.fastq.gz b_1.fq b_2.fq c_forward.fq c_reverse.fq d_f.fq d_r.fq e_R1_001.fastq.gz e_R2_001.fastq.gz f_R1.fastq g.fastq h_R2.fastq".split()
    df = spark.createDataFrame([("/x/" + f,) for f in files], "path string")
    pairs = detect_pairs(df)
    got = {(r.file1, r.file2) for r in pairs.collect()}
    assert ("/x/a_R1.fastq.gz", "/x/a_R2.fastq.gz") in got and ("/x/d_f.fq", "/x/d_r.fq") in got
    singles = {r.file1 for r in pairs.filter("file2 is null").collect()}
    assert singles == {"/x/g.fastq", "/x/h_R2.fastq", "/x/f_R1.fastq"}
    samples = build_samples(pairs, {"default_values": {"platform": "ILLUMINA", "library_layout": "x"},
                                    "contact": {"email": "e"}})
    names = {r.sample_name: r for r in samples.collect()}
    assert set(names) == {"a", "b", "c_forward.fq", "d_f.fq", "e_R1_001.fastq.gz", "f", "g.fastq", "h"}
    assert names["a"].library_layout == "paired" and names["g.fastq"].library_layout == "single"
    assert names["a"].library_ID == "Lib_a" and names["a"].platform == "ILLUMINA"
    assert names["a"].contact_email == "e" and names["a"].bioproject_id == ""


def test_pairs_duplicate_names(spark):
    df = spark.createDataFrame([("/b/s_R1.fq",), ("/a/s_R1.fq",), ("/a/s_R2.fq",), ("/c/s_R2.fq",)], "path string")
    got = {(r.file1, r.file2) for r in detect_pairs(df).collect()}
    assert got == {("/a/s_R1.fq", "/a/s_R2.fq"), ("/b/s_R1.fq", None), ("/c/s_R2.fq", None)}


def test_prepare_and_template(spark):
    df = spark.createDataFrame([("x", "Human Stool", "x_R1.fq"), ("y", None, "y.fq")],
                               "sample_name string, title string, filename string")
    out = prepare_table(df, {"default_values": {"platform": "ILLUMINA"}, "contact": {"name": "n"}})
    r = {x.sample_name: x for x in out.collect()}
    assert r["x"].filename2 == "x_R2.fq" and r["y"].filename2 == ""
    assert r["x"].host == "Homo sapiens" and r["x"].isolation_source == "Stool"
    assert r["y"].sample_source == "environmental" and r["x"].platform == "ILLUMINA"
    assert r["x"].contact_name == "n" and r["x"].design_description == "Metagenomic sequencing"
    t = project_template(spark, {"default_values": {"collection_date": "2020"}}).first()
    assert len(t) == 20 and t.collection_date == "2020" and t.host == ""


def test_validate_pair_fail_policy(spark):
    import pytest
    from manifestqc.plans.validate import MissingFiles
    s, p, inv = _f6(spark)
    with pytest.raises(MissingFiles):
        validate_pair(p, s, {"default_values": {}}, inventory=inv, base="/d", on_missing="fail")


def test_validate_pair_mismatch_policy(spark):
    import pytest
    from manifestqc.plans.validate import FileNameMismatch
    s, p, inv = _f6(spark)
    with pytest.raises(FileNameMismatch):
        validate_pair(p, s, {"default_values": {}}, on_mismatch="fail")


def test_key_summary_gives_what_the_single_operators_give(spark):
    s, p, _ = _f6(spark)
    summary = R.key_summary(s, p)
    got = {r.key: (r.n_sample, r.n_project) for r in summary.collect()}
    assert got == {"s1": (1, 1), "s2": (2, 1), "s3": (1, 0), "s4": (0, 1)}
    assert sorted(map(tuple, R.summary_mismatches(summary, ["filename"]).collect())) == sorted(map(tuple, R.filename_mismatch(s, p).collect()))
    cov = {(r.key, r.tbl) for r in R.summary_coverage_issues(summary).collect()}
    assert cov == {(r.key, r.only_in) for r in R.key_coverage(s, p).collect()}
    dup = sorted(map(tuple, R.summary_duplicate_issues(summary, s, p).collect()))
    assert dup == sorted(map(tuple, R.duplicate_issues(s, "sample").unionByName(R.duplicate_issues(p, "project")).collect()))
    none = R.key_summary(s.limit(0), p.limit(0))
    assert none.count() == 0 and R.summary_mismatches(none, []).count() == 0


def test_pair_checks_shuffle_each_table_once_per_question(spark):
    s, p, inv = _f6(spark)
    _, _, iss = validate_pair(p, s, {"default_values": {}}, inventory=inv, base="/d")
    plan = iss._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") <= 8
    tail = [r for r in iss.collect() if r.rule == "tail_data"]
    assert tail == []
