"""Configuration: defaults, contact and performance maps (one small JSON file,
read on the driver) and the overlay of custom defaults over system ones."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from manifestqc.functions.vocab import DEFAULT_VALUES, extend_vocabulary


def load_config(path: str | None, spark: SparkSession | None = None) -> dict:
    """Parse a JSON config, ``{}`` when no path is named.  A named path that is
    not there is an error.  With a session the file is read through Spark's file
    systems, so it may be remote."""
    if not path:
        return {}
    if spark is not None:
        return json.loads(spark.read.text(path, wholetext=True).first()["value"])
    with open(path, encoding="utf-8") as fh:
        return json.load(fh)


def effective_options(config: Mapping | None, options: Mapping[str, Iterable[str]]) -> dict[str, list[str]]:
    """The vocabulary extended by the config's own default instrument."""
    value = ((config or {}).get("default_values") or {}).get("instrument_model")
    return extend_vocabulary(options, "instrument_model", value)


def overlay_defaults(system: Mapping[str, str] = DEFAULT_VALUES,
                     custom: Mapping[str, str] | None = None) -> dict[str, str]:
    """System defaults overlaid by custom ones (custom key wins)."""
    return {**dict(system), **dict(custom or {})}


def effective_defaults(config: Mapping | None) -> dict[str, str]:
    """Defaults a validator uses: a config's ``default_values`` replaces the
    system defaults entirely (no merge); without one the system defaults apply."""
    if config and "default_values" in config:
        return dict(config["default_values"])
    return dict(DEFAULT_VALUES)


def overlay_frames(system: DataFrame, custom: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """Table form of the overlay: ``(key, value)`` rows, custom value wins.
    One full outer join on the key (both sides are distinct key sets)."""
    s = system.select(F.col(key).alias("_k"), F.col(value).alias("_sv"))
    c = custom.select(F.col(key).alias("_k"), F.col(value).alias("_cv"))
    return (s.join(c, "_k", "full_outer")
             .select(F.col("_k").alias(key), F.coalesce("_cv", "_sv").alias(value)))
