"""valuescope: profiling of large, wide, messy record collections on Spark.

Distinct values and counts of every field in one pass, cardinality reports,
cumulative frequency curves (raw versus cleaned), term-frequency indexes over
free text, identifier cross references, number-sequence studies and
fingerprint duplicate groups -- all as DataFrame transformations.

The most used entry points are importable from here; the submodules hold the rest.
"""

from .operators.ordered import compare_profiles, cumulate, sorted_index  # noqa: F401
from .operators.profile import (  # noqa: F401
    cardinality, cardinality_estimate, cardinality_report, value_counts, value_profile,
)
from .operators.tf import tf_index  # noqa: F401
from .operators.xref import cross_reference, id_length_histogram  # noqa: F401
from .session import build_session, pin, release_scratch  # noqa: F401

__version__ = "0.1.0"
