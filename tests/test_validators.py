"""Table validators on the planted-fault fixtures F1 and F2."""

from pyspark.sql import functions as F

from manifestqc.operators.rows import dense_number
from manifestqc.plans.validate import validate_projects, validate_samples

CONFIG = {"default_values": {
    "library_strategy": "WGS", "library_source": "METAGENOMIC", "library_selection": "RANDOM",
    "platform": "ILLUMINA", "instrument_model": "Illumina MiSeq", "geo_loc_name": "USA:California",
    "lat_lon": "37.7749 N 122.4194 W", "collection_date": "2023-01-01"},
    "contact": {"name": "A", "email": "a@x", "organization": "O"}}

SAMPLE_COLS = ["sample_name", "library_ID", "title", "library_strategy", "library_source",
               "library_selection", "library_layout", "platform", "instrument_model",
               "design_description", "filetype", "filename", "filename2"]
SAMPLES = [
    ("sample1", "lib1", "t1", "WGS", "METAGENOMIC", "RANDOM", "paired", "ILLUMINA", "Illumina MiSeq", "d", "fastq", "s1_R1.fq", "s1_R2.fq"),
    ("sample2", "", "t2", "", "", "", "single", "", "", "d", "fastq", "s2.fq", ""),
    ("sample3", "lib3", "", "INVALID_S", "INVALID_SRC", "INVALID_SEL", "invalid", "INVALID_P", "INVALID_I", "d", "fastq", "s3_R1.fq", "s3_R2.fq"),
    ("sample4", "lib4", "t4", "WGS", "METAGENOMIC", "RANDOM", "paired", "ILLUMINA", "Illumina MiSeq", "d", "fastq", "s4_R1.fq", ""),
    ("sample5", "", "t5", "AMPLICON", "GENOMIC", "PCR", "PAIRED", "ILLUMINA", "Illumina MiSeq", "d", "bam", "s5_R1.fq", ""),
]


def _numbered(spark, rows, cols):
    df = spark.createDataFrame([r + (i,) for i, r in enumerate(rows)], cols + ["_row"])
    return df.withColumn("_row", F.col("_row").cast("long"))


def test_validate_samples_f1(spark):
    df = _numbered(spark, SAMPLES, SAMPLE_COLS)
    out, iss = validate_samples(df, CONFIG)
    got = {r.sample_name: r for r in out.collect()}
    assert got["sample1"].library_ID == "lib1"
    s2 = got["sample2"]
    assert (s2.library_ID, s2.library_strategy, s2.library_source, s2.library_selection, s2.platform,
            s2.instrument_model, s2.library_layout) == ("sample2", "WGS", "METAGENOMIC", "RANDOM", "ILLUMINA",
                                                        "Illumina MiSeq", "single")
    s3 = got["sample3"]
    assert (s3.library_strategy, s3.library_source, s3.library_selection, s3.platform, s3.instrument_model) == \
        ("WGS", "METAGENOMIC", "RANDOM", "ILLUMINA", "Illumina MiSeq")
    assert s3.library_layout == "invalid" and s3.title == ""
    assert got["sample5"].library_layout == "paired" and got["sample5"].library_ID == "sample5"
    assert got["sample5"].filetype == "bam" and got["sample5"].library_selection == "PCR"
    lm = {r.key for r in iss.filter("rule = 'layout_mate'").collect()}
    assert lm == {"sample4", "sample5"}
    vocab = {(r.key, r.col) for r in iss.filter("rule = 'vocabulary'").collect()}
    assert ("sample3", "library_layout") in vocab and ("sample3", "platform") in vocab
    # idempotent
    again, _ = validate_samples(out, CONFIG)
    assert sorted(map(tuple, again.select(*SAMPLE_COLS).collect())) == sorted(map(tuple, out.select(*SAMPLE_COLS).collect()))


PROJECT_COLS = ["bioproject_id", "project_title", "project_description", "sample_source", "collection_date",
                "geo_loc_name", "lat_lon", "library_strategy", "library_source", "library_selection", "platform",
                "instrument_model", "env_biome", "env_feature", "env_material", "depth", "altitude", "host",
                "host_tissue", "isolation_source"]


def _proj_row(i, date, geo, ll, src, strat, source, sel, plat, inst):
    return (f"PRJ{i}", "t", "d", src, date, geo, ll, strat, source, sel, plat, inst,
            "b", "f", "m", "1", "2", "Homo sapiens", "gut", "stool")


PROJECTS = [
    _proj_row(1, "2023-07-15", "USA:California", "36.9513 N 122.0733 W", "environmental", "WGS", "METAGENOMIC", "RANDOM", "ILLUMINA", "Illumina MiSeq"),
    _proj_row(2, "07/20/2023", "Canada", "45.123, -75.456", "environmental", "", "", "", "", ""),
    _proj_row(3, "Jun-2023", "USA:Ohio:Cincinnati", "39.1031 N 84.5120 W", "host-associated", "INVALID_S", "INVALID", "INVALID", "INVALID", "INVALID"),
    _proj_row(4, "2023", "Invalid Location", "invalid coords", "invalid", "WGS", "METAGENOMIC", "RANDOM", "ILLUMINA", "Illumina MiSeq"),
    _proj_row(5, "invalid-date", "", "", "ENVIRONMENTAL", "WGS", "METAGENOMIC", "RANDOM", "ILLUMINA", "Illumina MiSeq"),
]


def test_validate_projects_f2(spark):
    df = _numbered(spark, PROJECTS, PROJECT_COLS)
    out, iss = validate_projects(df, CONFIG)
    got = sorted(out.collect(), key=lambda r: r.file_number)
    assert [r.file_number for r in got] == [1, 2, 3, 4, 5]
    assert [r.collection_date for r in got] == ["2023-07-15", "2023-07-20", "2023-06", "2023", "invalid-date"]
    assert [r.geo_loc_name for r in got] == ["USA:California", "Canada:", "USA:Ohio:Cincinnati", "Invalid Location:", ""]
    assert [r.lat_lon for r in got] == ["36.9513 N 122.0733 W", "45.123 N 75.456 W", "39.1031 N 84.5120 W",
                                        "invalid coords", ""]
    assert [r.sample_source for r in got] == ["environmental", "environmental", "host-associated", "invalid",
                                              "environmental"]
    for r in got[1:3]:
        assert (r.library_strategy, r.library_source, r.library_selection, r.platform, r.instrument_model) == \
            ("WGS", "METAGENOMIC", "RANDOM", "ILLUMINA", "Illumina MiSeq")
    assert iss.filter("rule = 'duplicate_keys'").count() == 0


def test_trim_and_alignment(spark):
    rows = [("a", "x", "1"), ("", "y", "2"), ("b", None, "3"), (None, "z", None), ("", None, None), (None, "q", "")]
    df = _numbered(spark, rows, ["sample_name", "c1", "c2"])
    out, iss = validate_samples(df, {"default_values": {}})
    assert sorted(r._row for r in out.collect()) == [0, 1, 2]
    tail = {(r.col, r.row) for r in iss.filter("rule = 'tail_data'").collect()}
    assert tail == {("c1", 3), ("c1", 5)}
    miss = {(r.col, r.value) for r in iss.filter("rule = 'missing_cells'").collect()}
    assert ("c1", "1") in miss


def test_dense_number_partition_independent(spark):
    base = spark.range(0, 5000).select((F.col("id") * 7 + 3).alias("k"))
    for parts in (1, 3, 8):
        df = base.repartition(parts)
        n = dense_number(df, "k", name="n", start=1, n_buckets=parts + 2)
        bad = n.filter(F.col("n") != (F.col("k") - 3) / 7 + 1).count()
        assert bad == 0


def test_validate_projects_idempotent(spark):
    df = _numbered(spark, PROJECTS, PROJECT_COLS)
    once, _ = validate_projects(df, CONFIG)
    twice, _ = validate_projects(once, CONFIG)
    cols = PROJECT_COLS + ["file_number", "_row"]
    assert sorted(map(tuple, once.select(*cols).collect())) == sorted(map(tuple, twice.select(*cols).collect()))


def test_dense_number_uniform_ranges(spark):
    from manifestqc.operators.rows import dense_number, number_and_trim
    # positions with gaps (as after dropping rows): equal-width ranges, many of them
    base = spark.range(0, 20000).filter((F.col("id") % 7 != 3)).select((F.col("id") * 2).alias("_row"))
    n = dense_number(base, "_row", name="k", start=1, ranges="uniform", rows_per_range=700)
    rows = n.orderBy("_row").select("k").collect()
    assert [r.k for r in rows] == list(range(1, len(rows) + 1))
    keyed = base.withColumn("sample_name", F.when(F.col("_row") < 30000, F.lit("s")).otherwise(F.lit("")))
    t = number_and_trim(keyed, "sample_name", "file_number", "_row")
    got = t.orderBy("_row").select("file_number", "_row").collect()
    assert got[0].file_number == 1 and got[-1]._row < 30000
    assert [r.file_number for r in got] == list(range(1, len(got) + 1))


def test_layout_is_canonicalized_once_a_row(spark):
    """The rules name the layout many times; its trimming regular expression must not be repeated for each."""
    import contextlib
    import io

    from manifestqc.plans.validate import validate_samples
    df = spark.createDataFrame([("a", " PE ", "f1", None, 0), ("b", "se", "f1", "f2", 1), ("c", "odd", "f1", "f2", 2), ("d", None, "f1", "f2", 3)],
                               "sample_name string, library_layout string, filename string, filename2 string, _row long")
    found = validate_samples(df)[1].where("col = 'library_layout' and rule <> 'missing_cells'")
    assert sorted((r["rule"], r["row"], r["value"]) for r in found.collect()) == [("layout_mate", 0, None), ("layout_mate", 1, "f2"), ("vocabulary", 2, "odd")]
    said = io.StringIO()
    with contextlib.redirect_stdout(said):
        found.where("rule <> 'duplicate_keys'").explain()
    assert 1 <= said.getvalue().count("regexp_replace") <= 2
