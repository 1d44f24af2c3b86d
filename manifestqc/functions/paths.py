"""File-name functions: base names, path resolution, read-1/read-2 mates,
sample names from files, sequence-file suffixes and upload destinations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from manifestqc.functions._col import as_col, null_str
from manifestqc.functions.blank import strip_ws

# Accepted sequence-file suffixes and the default upload folder name.
RE_SEQUENCE_FILE = r"\.(fastq|fq)(\.gz)?$"
DEFAULT_FOLDER = "sra_submission"
RE_URI = r"^[A-Za-z][A-Za-z0-9+.-]*://"


def basename(c) -> Column:
    """Text after the last ``/`` (``''`` for a path ending in ``/``).  A plain
    string function, not a regex, so it stays cheap when Catalyst inlines it."""
    return F.substring_index(as_col(c), "/", -1)


def resolve_path(c, base=None, strip: bool = True) -> Column:
    """Absolute paths and URIs (``scheme://...``) stay; relative ones are joined
    to ``base`` when a base is given (a ``/`` is inserted unless ``base`` already
    ends with one)."""
    p = as_col(c)
    if strip:
        p = strip_ws(p)
    if base is None:
        return p
    b = F.lit(base) if isinstance(base, str) else base
    joined = F.when(b.endswith("/"), F.concat(b, p)).otherwise(F.concat(b, F.lit("/"), p))
    return (
        F.when(p.startswith("/") | p.rlike(RE_URI), p)
        .when(b.isNull() | (b == ""), p)
        .otherwise(joined)
    )


def mate_name(c) -> Column:
    """Simple mate rule: when ``_R1`` or ``_1.`` occurs, every ``_R1`` becomes
    ``_R2`` and then every ``_1.`` becomes ``_2.``; otherwise (null too) ``''``."""
    f = as_col(c)
    swapped = F.replace(F.replace(f, F.lit("_R1"), F.lit("_R2")), F.lit("_1."), F.lit("_2."))
    return F.when(f.contains("_R1") | f.contains("_1."), swapped).otherwise(F.lit(""))


def expected_mate(c) -> Column:
    """Read-2 name expected for a read-1 file name, or null when the name is
    not a read-1 name.  Patterns in order, the first that occurs decides and
    all of its occurrences are rewritten: ``_R1.``/``_R1_``, ``_1.``,
    ``_forward``, ``_f.``."""
    n = as_col(c)
    return (
        F.when(n.contains("_R1.") | n.contains("_R1_"), F.regexp_replace(n, r"_R1([._])", "_R2$1"))
        .when(n.contains("_1."), F.replace(n, F.lit("_1."), F.lit("_2.")))
        .when(n.contains("_forward"), F.replace(n, F.lit("_forward"), F.lit("_reverse")))
        .when(n.contains("_f."), F.replace(n, F.lit("_f."), F.lit("_r.")))
        .otherwise(null_str())
    )


def is_read1(c) -> Column:
    return expected_mate(c).isNotNull()


def sample_name_from_file(c) -> Column:
    """Sample name from a file path: base name without ``_R?[12].<anything>``."""
    return F.regexp_replace(basename(c), r"_R?[12]\..*$", "")


def is_sequence_file(c) -> Column:
    """Case-sensitive ``.fastq``, ``.fq``, ``.fastq.gz`` or ``.fq.gz`` suffix."""
    return as_col(c).rlike(RE_SEQUENCE_FILE)


def safe_name(c, default: str = DEFAULT_FOLDER) -> Column:
    """Folder-safe name: characters outside ``[A-Za-z0-9_.-]`` become ``_``;
    blank input takes ``default``."""
    c = as_col(c)
    filled = F.when(c.isNull() | (c == ""), F.lit(default)).otherwise(c)
    return F.regexp_replace(filled, r"[^A-Za-z0-9_.\-]", "_")


def destination_path(dest, folder) -> Column:
    """Destination without trailing slashes, then ``/<folder>`` (both Columns or names)."""
    d = as_col(dest)
    f = as_col(folder)
    return F.concat(F.regexp_replace(d, r"/+$", ""), F.lit("/"), f)
