import importlib

from eventmart.config import datasets, schemas
from eventmart.config import settings as settings_module


def test_raw_datasets_are_defined():
    assert datasets.RAW_DATASETS
    assert isinstance(datasets.RAW_DATASETS, list)


def test_raw_datasets_have_file_and_table_names():
    for ds in datasets.RAW_DATASETS:
        assert ds.file_name and ds.table_name


def test_raw_dataset_file_names_are_csv():
    assert all(ds.file_name.endswith(".csv") for ds in datasets.RAW_DATASETS)


def test_raw_dataset_table_names_are_uppercase():
    assert all(ds.table_name == ds.table_name.upper() for ds in datasets.RAW_DATASETS)


def test_members_file_is_not_loaded():
    assert "members.csv" not in {ds.file_name for ds in datasets.RAW_DATASETS}
    assert len(datasets.RAW_DATASETS) == 8


def test_default_settings():
    s = settings_module.load_settings()
    assert s.storage.bucket
    assert s.storage.source_prefix == "landing/"
    assert s.storage.normalized_prefix == "landing_normalized/"
    assert s.storage.incremental_prefix == "incremental/events/"


def test_settings_follow_environment(monkeypatch):
    monkeypatch.setenv("EVENTMART_BUCKET", "test-bucket")
    reloaded = importlib.reload(settings_module)
    assert reloaded.settings.storage.bucket == "test-bucket"
    assert reloaded.load_settings().storage.source_dir == "s3a://test-bucket/landing/"


def test_settings_are_frozen():
    s = settings_module.load_settings()
    try:
        s.storage.bucket = "x"  # type: ignore[misc]
    except Exception as exc:  # dataclasses.FrozenInstanceError
        assert "cannot assign" in str(exc)
    else:
        raise AssertionError("settings must be immutable")


def test_staging_maps_have_reference_widths():
    widths = {k: len(v) for k, v in schemas.STAGING_MAPS.items()}
    assert widths == {"events": 48, "groups": 19, "venues": 12, "categories": 3,
                      "topics": 2, "groups_topics": 3}
    staged = [dst for _, dst in schemas.STG_EVENTS]
    assert len(set(staged)) == len(staged)
    assert all("." not in dst for m in schemas.STAGING_MAPS.values() for _, dst in m)
