"""manifestqc: a Spark-native data-quality engine for submission manifests.

Main entry points::

    from manifestqc.sources.manifest import read_manifest, write_manifest, list_files
    from manifestqc.plans.validate import validate_samples, validate_projects, validate_pair
    from manifestqc.operators.issues import issue_summary, strict_gate, verdict
    from manifestqc.functions import normalize_date, normalize_geo, normalize_latlon
"""

__version__ = "0.1.0"

__all__ = ["__version__"]
