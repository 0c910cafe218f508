"""Operations of a training-data pipeline: the operators and their queries."""
