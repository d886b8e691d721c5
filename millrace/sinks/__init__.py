"""Writers for data, logs and staged tables."""
