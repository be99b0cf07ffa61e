"""The registry of sources and datasets: versions, writers in each other's way, lookup by source."""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pytest

from quayline.errors import InvalidParameterError, MissingFieldError
from quayline.plans import RegistryLog, read_dataset, write_dataset
from quayline.refs import CsvFormat, DatasetRef, SourceRef
from quayline.sources import filesystem


@pytest.fixture
def log(spark, tmp_path):
    return RegistryLog(spark, str(tmp_path / "log"))


@pytest.fixture
def source(tmp_path):
    return SourceRef("localfs", id="disk", path=str(tmp_path / "data"))


def test_datasets_are_found_by_id_and_by_source(spark, log, source):
    other = replace(source, id="other")
    for s in (source, other):
        assert log.create_source(s) == 1
    df = spark.range(5)
    refs = [DatasetRef.of(source, f"d{i}", df.schema, id=f"set_{i}", name="n", csv=CsvFormat(separator=";")) for i in range(3)]
    for ref in refs:
        write_dataset(df, ref)
        assert log.create_dataset(ref) == 1
    log.create_dataset(DatasetRef(other, "m", "model", "binary", id="model"))
    assert log.datasets_of("disk") == refs and [r.id for r in log.datasets_of("other")] == ["model"]
    assert {r.id for r in log.datasets("disk").collect()} == {"set_0", "set_1", "set_2"}
    assert log.dataset("set_1") == refs[1] and read_dataset(spark, log.dataset("set_1")).count() == 5
    assert log.source("other") == other and log.datasets("none").count() == 0
    # A dataset moves to another source with its next version.
    assert log.update_dataset(replace(refs[0], source=other)) == 2
    assert {r.id for r in log.datasets("disk").collect()} == {"set_1", "set_2"}
    assert {(r.id, r.version) for r in log.datasets("other").collect()} == {("set_0", 2), ("model", 1)}


def test_versions_and_deletion(log, source):
    log.create_source(source)
    ref = DatasetRef.of(source, "d", {"x": "int64"}, id="d")
    log.create_dataset(ref)
    with pytest.raises(InvalidParameterError, match="already exists"):
        log.create_dataset(ref)
    assert log.update_dataset(replace(ref, name="two"), known=1) == 2 and log.dataset("d").name == "two"
    with pytest.raises(InvalidParameterError, match="at version 2"):
        log.update_dataset(ref, known=1)
    with pytest.raises(InvalidParameterError, match="still has datasets"):
        log.delete_source("disk")
    log.delete_dataset("d")
    for missing in (lambda: log.dataset("d"), lambda: log.delete_dataset("d"), lambda: log.update_dataset(ref)):
        with pytest.raises(MissingFieldError):
            missing()
    assert log.versions("dataset", "d") == [1, 2, 3] and log.entries("dataset").count() == 0
    # The log goes on where it was.
    assert log.create_dataset(ref) == 4 and log.dataset("d") == ref
    log.delete_dataset("d")
    log.delete_source("disk")
    with pytest.raises(MissingFieldError):
        log.source("disk")


def test_of_two_writers_one_is_refused(spark, log, source, tmp_path):
    log.create_source(source)
    ref = DatasetRef.of(source, "d", {"x": "int64"}, id="d")

    def create(i):
        try:
            return RegistryLog(spark, str(tmp_path / "log"))._put("dataset", "d", {"writer": i}, 1, "disk")
        except InvalidParameterError:
            return None

    with ThreadPoolExecutor(8) as pool:
        assert sorted(pool.map(create, range(8)), key=str) == [1] + [None] * 7
    path = str(tmp_path / "x" / "y.json")
    assert filesystem.put_if_absent(spark, path, "a\n") and not filesystem.put_if_absent(spark, path, "b\n")
    assert (tmp_path / "x" / "y.json").read_text() == "a\n" and len(list((tmp_path / "x").iterdir())) <= 2
    assert log.versions("dataset", "d") == [1] and ref.id == "d"


def test_secrets_and_names(log, tmp_path):
    store = SourceRef("oss", id="s", endpoint="e", bucket="b", access_key="k", access_secret="hidden", password="hidden")
    log.create_source(store)
    stored = "".join(f.read_text() for f in (tmp_path / "log").rglob("*.json"))
    assert "hidden" not in stored and log.source("s", access_secret="hidden", password="hidden") == store
    for bad in ("", "../x", "a b"):
        with pytest.raises(Exception):
            log.create_source(replace(store, id=bad))
    with pytest.raises(MissingFieldError):
        log.create_dataset(DatasetRef.of(replace(store, id="none"), "d", {"x": "int64"}, id="d"))
    with pytest.raises(InvalidParameterError):
        log.entries("table")
