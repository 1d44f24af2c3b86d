"""Pairing sequence files into samples and building/preparing sample tables.

Pairing is an equi-join of read-1 files on their expected mate name against
the base names of the other files.  To stay one-to-one (no pairs within a
group), each side is first reduced to its smallest path per name with an
aggregate (partial aggregation makes a hot name cheap); every other file
with the same name comes out as a single.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from manifestqc.functions.paths import basename, expected_mate, mate_name, sample_name_from_file
from manifestqc.functions.text import infer_host, infer_isolation_source, infer_sample_source
from manifestqc.functions.vocab import DESIGN_DESCRIPTION, PREPARE_FIELDS
from manifestqc.operators.rules import contact_columns

PAIR_SCHEMA = "file1 string, file2 string"


def detect_pairs(files: DataFrame, path_col: str = "path", same_dir: bool = False) -> DataFrame:
    """``(file1, file2)``: pairs, then singles with ``file2`` null.

    ``same_dir`` pairs files of one folder only, so equal names in several run
    folders each find their own mate.

    One aggregate does the matching: a read-1 file is keyed by the mate name
    it expects, any other file by its own base name; per key the smallest
    read-1 path and the smallest other path form the pair.  Partial
    aggregation keeps a hot name cheap and no pairs within a group are made."""
    f = files.select(F.col(path_col).alias("path")).filter(F.col("path").isNotNull()).distinct()
    name = basename(F.col("path"))
    tagged = f.select("path", name.alias("name"), expected_mate(name).alias("expected"))
    is_r1 = F.col("expected").isNotNull()
    folder = F.regexp_extract("path", r"^(.*/)", 1) if same_dir else F.lit("")
    groups = tagged.groupBy(folder.alias("_d"), F.coalesce("expected", "name").alias("_k")).agg(
        F.min(F.when(is_r1, F.col("path"))).alias("file1"),
        F.min(F.when(~is_r1, F.col("path"))).alias("file2"))
    pairs = groups.filter(F.col("file1").isNotNull() & F.col("file2").isNotNull()).select("file1", "file2")
    used = pairs.select(F.col("file1").alias("path")).unionByName(pairs.select(F.col("file2").alias("path")))
    singles = f.join(used, "path", "left_anti") \
               .select(F.col("path").alias("file1"), F.lit(None).cast("string").alias("file2"))
    return pairs.unionByName(singles)


def build_samples(pairs: DataFrame, config: Mapping | None = None) -> DataFrame:
    """One sample row per pair/single.  Derived fields win over config
    defaults; then ``contact_*``, ``bioproject_id`` and ``biosample_id``."""
    config = config or {}
    defaults = dict(config.get("default_values", {}))
    contact = contact_columns(config.get("contact", {}))
    s = sample_name_from_file(F.col("file1"))
    has2 = F.col("file2").isNotNull() & (F.col("file2") != "")
    derived = {
        "sample_name": s,
        "library_ID": F.concat(F.lit("Lib_"), s),
        "title": F.concat(F.lit("Metagenome from "), s),
        "filename": basename(F.col("file1")),
        "filename2": F.when(has2, basename(F.col("file2"))).otherwise(F.lit("")),
        "filepath": F.col("file1"),
        "filepath2": F.when(has2, F.col("file2")).otherwise(F.lit("")),
        "library_layout": F.when(has2, F.lit("paired")).otherwise(F.lit("single")),
        "design_description": F.lit(DESIGN_DESCRIPTION),
        "filetype": F.lit("fastq"),
    }
    cols = [c.alias(n) for n, c in derived.items()]
    cols += [F.lit(v).alias(k) for k, v in defaults.items() if k not in derived]
    cols += [F.lit(v).alias(k) for k, v in contact.items()]
    names = set(derived) | set(defaults) | set(contact)
    cols += [F.lit("").alias(k) for k in ("bioproject_id", "biosample_id") if k not in names]
    return pairs.select(*cols)


def prepare_table(df: DataFrame, config: Mapping | None = None) -> DataFrame:
    """Submission table from any manifest: the 9 target fields (copied, else
    default, else ''), file names (mate inferred when there is no second file
    column), attributes inferred from the title, contact columns, empty ids
    and a design description.  One projection over the input."""
    config = config or {}
    defaults = dict(config.get("default_values", {}))
    contact = contact_columns(config.get("contact", {}))

    def field(f: str):
        return F.col(f) if f in df.columns else F.lit(defaults.get(f, ""))

    cols = {f: field(f) for f in PREPARE_FIELDS}
    if "filename" in df.columns:
        cols["filename"] = F.col("filename")
        cols["filename2"] = F.col("filename2") if "filename2" in df.columns else mate_name(F.col("filename"))
    title = cols["title"]
    cols["sample_source"] = infer_sample_source(title)
    cols["host"] = infer_host(title)
    cols["isolation_source"] = infer_isolation_source(title)
    for k, v in contact.items():
        cols[k] = F.lit(v)
    cols.setdefault("bioproject_id", F.lit(""))
    cols.setdefault("biosample_id", F.lit(""))
    cols["design_description"] = (F.col("design_description") if "design_description" in df.columns
                                  else F.lit(DESIGN_DESCRIPTION))
    return df.select(*[c.alias(n) for n, c in cols.items()])


def project_template(spark, config: Mapping | None = None, fields=None) -> DataFrame:
    """One-row project template: every field empty unless the config has a default."""
    from manifestqc.functions.vocab import PROJECT_TEMPLATE_FIELDS
    fields = fields or PROJECT_TEMPLATE_FIELDS
    defaults = dict((config or {}).get("default_values", {}))
    return spark.range(1).select(*[F.lit(defaults.get(c, "")).alias(c) for c in fields])
