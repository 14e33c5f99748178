"""DataFrame -> DataFrame operators (profiles, ordered curves, TF, cross reference, sequences)."""
