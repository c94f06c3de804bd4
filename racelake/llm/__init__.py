"""Operations of a training-data pipeline: cleaning, deduplication, tokens, search."""
