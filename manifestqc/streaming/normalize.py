"""Streaming use of the row rules.

The manifest format has no event time and the checks that need the whole
table (duplicates, tail, coverage, numbering) are batch-only.  The per-cell
rules are stateless Column expressions, so they apply unchanged to a
streaming DataFrame of manifest lines, e.g. a folder that receives new
manifest files.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from manifestqc.functions.vocab import VALID_OPTIONS
from manifestqc.operators import rules as U
from manifestqc.sources.records import parsed


def read_manifest_stream(spark: SparkSession, directory: str, header: Sequence[str],
                         sep: str = "\t") -> DataFrame:
    """Stream of manifest rows from new files in ``directory`` (header given,
    header lines equal to it are skipped).

    Cells are parsed as in ``read_manifest``; a stream takes every line as a record, so
    a quoted cell cannot go over lines here and its opening quote is text."""
    lines = spark.readStream.text(directory)
    head_line = sep.join(header)
    rows = lines.filter((F.col("value") != "") & (F.col("value") != F.lit(head_line)))
    cut = rows.select(parsed(F.regexp_replace("value", "\r\\z", ""), sep).alias("_p"), F.col("_metadata.file_path").alias("_file"))
    return cut.select(*[F.nullif(F.get("_p.cells", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(header)], "_file")


def normalize_stream(df: DataFrame, defaults: Mapping[str, str],
                     options: Mapping[str, Iterable[str]] = VALID_OPTIONS,
                     fill_fields: Sequence[str] = ()) -> DataFrame:
    """Stateless per-row rules: fill, synonyms, vocabulary, date, place, coordinates."""
    out = U.fill_defaults(df, fill_fields, defaults)
    out = U.canonical_layout(out)
    out = U.canonical_source(out)
    out = U.enforce_vocab(out, options, defaults)
    out = U.date_column(out, "collection_date", defaults.get("collection_date"))
    out = U.geo_column(out)
    return U.latlon_column(out)
