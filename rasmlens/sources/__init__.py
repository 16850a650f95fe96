from rasmlens.sources.models import load_classifier, load_features, save_classifier, save_fitted
from rasmlens.sources.tables import (
    read_csv, read_parquet, read_words, spread, write_csv, write_parquet, write_parquet_by, write_splits)

__all__ = [
    "load_classifier", "load_features", "read_csv", "read_parquet", "read_words",
    "save_classifier", "save_fitted", "spread", "write_csv", "write_parquet", "write_parquet_by", "write_splits",
]
