"""Settings, the dataset catalogue and fixed schemas."""

from eventmart.config.settings import Settings, load_settings
from eventmart.config.datasets import RAW_DATASETS, Dataset

__all__ = ["Settings", "load_settings", "RAW_DATASETS", "Dataset"]
