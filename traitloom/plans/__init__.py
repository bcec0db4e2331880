"""The four jobs: wide text, wide numbers, integration, profiles. Each takes and returns DataFrames."""
