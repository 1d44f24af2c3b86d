"""Default controlled vocabularies and default values.

These are configuration, not engine constants: every operator takes the
vocabulary / defaults as arguments and these are only the defaults.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Accepted values per constrained field (submission-archive
# controlled vocabularies), in their published order.
VALID_OPTIONS: dict[str, list[str]] = {
    "library_strategy": [
        "WGA", "WGS", "WXS", "RNA-Seq", "miRNA-Seq", "WCS", "CLONE", "POOLCLONE",
        "AMPLICON", "CLONEEND", "FINISHING", "ChIP-Seq", "MNase-Seq",
        "DNase-Hypersensitivity", "Bisulfite-Seq", "Tn-Seq", "EST", "FL-cDNA",
        "CTS", "MRE-Seq", "MeDIP-Seq", "MBD-Seq", "Synthetic-Long-Read",
        "ATAC-seq", "ChIA-PET", "FAIRE-seq", "Hi-C", "ncRNA-Seq", "RAD-Seq",
        "RIP-Seq", "SELEX", "ssRNA-seq", "Targeted-Capture",
        "Tethered Chromatin Conformation Capture", "DIP-Seq", "GBS",
        "Inverse rRNA", "NOMe-Seq", "Ribo-seq", "VALIDATION", "OTHER",
    ],
    "library_source": [
        "GENOMIC", "TRANSCRIPTOMIC", "METAGENOMIC", "METATRANSCRIPTOMIC",
        "SYNTHETIC", "VIRAL RNA", "GENOMIC SINGLE CELL", "TRANSCRIPTOMIC SINGLE CELL", "OTHER",
    ],
    "library_selection": [
        "RANDOM", "PCR", "RANDOM PCR", "RT-PCR", "HMPR", "MF", "CF-S", "CF-M",
        "CF-H", "CF-T", "MDA", "MSLL", "cDNA", "ChIP", "MNase", "DNAse",
        "Hybrid Selection", "Reduced Representation", "Restriction Digest",
        "5-methylcytidine antibody", "MBD2 protein methyl-CpG binding domain",
        "CAGE", "RACE", "size fractionation", "Padlock probes capture method",
        "other", "unspecified", "cDNA_oligo_dT", "cDNA_randomPriming",
        "Inverse rRNA", "Oligo-dT", "PolyA", "repeat fractionation",
    ],
    "library_layout": ["paired", "single"],
    "platform": [
        "ABI_SOLID", "BGISEQ", "CAPILLARY", "COMPLETE_GENOMICS", "DNBSEQ",
        "ELEMENT", "GENAPSYS", "GENEMIND", "HELICOS", "ILLUMINA", "ION_TORRENT",
        "OXFORD_NANOPORE", "PACBIO_SMRT", "TAPESTRI", "ULTIMA", "VELA_DIAGNOSTICS",
    ],
    "filetype": [
        "fastq", "bam", "srf", "sff", "PacBio_HDF5", "CompleteGenomics_native",
        "OxfordNanopore_native",
    ],
    "instrument_model": [
        "Illumina NovaSeq X", "Illumina NovaSeq 6000", "Illumina HiSeq X", "Illumina HiSeq 2500",
        "Illumina HiSeq 2000", "Illumina HiSeq 1500", "Illumina HiSeq 1000", "Illumina MiSeq",
        "Illumina MiniSeq", "Illumina NextSeq 500", "Illumina NextSeq 550", "Illumina NextSeq 1000",
        "Illumina NextSeq 2000", "Illumina iSeq 100", "NextSeq 500",
        "MinION", "GridION", "PromethION",
        "PacBio RS", "PacBio RS II", "PacBio Sequel", "PacBio Sequel II", "PacBio Revio",
        "Ion Torrent PGM", "Ion Torrent S5", "Ion Torrent S5 XL", "Ion Torrent Genexus",
        "unspecified",
    ],
}

# System default values per field.
DEFAULT_VALUES: dict[str, str] = {
    "organism": "Homo sapiens",
    "geo_loc_name": "United States: Ohio: Cincinnati",
    "lat_lon": "39.10 N 84.51 W",
    "collection_date": "not collected",
    "title": "metagenomics project",
    "library_strategy": "WGS",
    "library_source": "METAGENOMIC",
    "library_selection": "RANDOM",
    "library_layout": "paired",
    "platform": "ILLUMINA",
    "instrument_model": "Illumina NovaSeq X",
    "filetype": "fastq",
}

# Field lists of the two manifest kinds.
SAMPLE_FILL_FIELDS = ["library_strategy", "library_source", "library_selection",
                      "platform", "instrument_model"]
PROJECT_FILL_FIELDS = SAMPLE_FILL_FIELDS + ["collection_date"]
SAMPLE_ESSENTIAL = ["sample_name", "library_ID", "title", "library_strategy",
                    "library_source", "library_selection", "library_layout",
                    "platform", "instrument_model", "design_description",
                    "filetype", "filename"]
PROJECT_ESSENTIAL = ["bioproject_id", "project_title", "project_description", "sample_source",
                     "collection_date", "geo_loc_name", "lat_lon", "library_strategy",
                     "library_source", "library_selection", "platform", "instrument_model"]
FILE_COLUMNS = ["filename", "filename2", "filepath", "filepath2", "file1", "file2"]
PREPARE_FIELDS = ["sample_name", "title", "library_ID", "library_strategy", "library_source",
                  "library_selection", "library_layout", "platform", "instrument_model"]
PROJECT_TEMPLATE_FIELDS = [
    "bioproject_id", "project_title", "project_description", "sample_source",
    "collection_date", "geo_loc_name", "lat_lon", "library_strategy", "library_source",
    "library_selection", "platform", "instrument_model", "env_biome", "env_feature",
    "env_material", "depth", "altitude", "host", "host_tissue", "isolation_source",
]
DESIGN_DESCRIPTION = "Metagenomic sequencing"

VOCAB_SCHEMA = T.StructType([
    T.StructField("field", T.StringType(), False),
    T.StructField("value", T.StringType(), False),
])


def vocabulary_frame(spark: SparkSession, options: Mapping[str, Iterable[str]] | None = None) -> DataFrame:
    """Vocabulary as a ``(field, value)`` DataFrame (distinct pairs)."""
    options = VALID_OPTIONS if options is None else options
    rows = sorted({(f, v) for f, vals in options.items() for v in vals})
    return spark.createDataFrame(rows, VOCAB_SCHEMA)


def extend_vocabulary(options: Mapping[str, Iterable[str]], field: str, value: str | None) -> dict[str, list[str]]:
    """Driver-side extension of a vocabulary mapping by one value (no duplicates)."""
    out = {k: list(v) for k, v in options.items()}
    if value:
        vals = out.setdefault(field, [])
        if value not in vals:
            vals.append(value)
    return out
