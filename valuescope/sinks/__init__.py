"""Writers: parquet, per-field CSV value files (with resume), partitioned profiles, pairs, rejects."""

from .writers import (  # noqa: F401
    done_fields, field_output_name, write_csv_pairs, write_field_csvs, write_parquet,
    write_profile_parquet, write_profile_partitioned, write_rejects, write_text_pairs,
)
