"""Operations of a training-data pipeline: deduplication, packing, mixing, scans, formatting, scoring."""
