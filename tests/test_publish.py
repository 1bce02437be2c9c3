import json
import os
from types import SimpleNamespace

import pytest

from docsheaf.sources import sinks


def outputs(spark, stops_at=None, text="x"):
    def writer(name):
        def write(path):
            if name == stops_at:
                raise RuntimeError("stopped")
            spark.createDataFrame([(f"{name} {text}",)], "value string").coalesce(1).write.text(path)

        return write

    return {name: (f"{name}_r1.txt", writer(name)) for name in ("json", "csv", "report")}


def texts(spark, paths):
    return {name: spark.read.text(path).first().value for name, path in paths.items()}


@pytest.mark.parametrize("stops_at", ["json", "csv", "report"])
def test_a_stopped_save_shows_nothing_and_can_be_repeated(spark, tmp_path, stops_at):
    folder = str(tmp_path / "out")
    with pytest.raises(RuntimeError):
        sinks.publish(spark, folder, "r1", outputs(spark, stops_at))
    assert sinks.published(spark, folder, "r1") is None
    paths = sinks.publish(spark, folder, "r1", outputs(spark))
    assert paths == sinks.published(spark, folder, "r1")
    assert texts(spark, paths) == {name: f"{name} x" for name in ("json", "csv", "report")}
    assert [p.rpartition("/")[2] for p in paths.values()] == ["json_r1.txt", "csv_r1.txt", "report_r1.txt"]


def test_a_published_run_stays(spark, tmp_path):
    folder = str(tmp_path / "out")
    paths = sinks.publish(spark, folder, "r1", outputs(spark))
    assert sinks.publish(spark, folder, "r1", outputs(spark, text="later")) == paths
    assert texts(spark, paths)["csv"] == "csv x"
    other = sinks.publish(spark, folder, "r2", outputs(spark, text="y"))
    assert texts(spark, other)["csv"] == "csv y" and texts(spark, paths)["csv"] == "csv x"


def test_a_save_lost_before_its_manifest(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "out")

    def lost(value):
        raise KeyboardInterrupt

    monkeypatch.setattr(sinks, "json", SimpleNamespace(dumps=lost, loads=json.loads))
    with pytest.raises(KeyboardInterrupt):
        sinks.publish(spark, folder, "r1", outputs(spark))
    monkeypatch.undo()
    assert len(os.listdir(folder)) == 1 and sinks.published(spark, folder, "r1") is None
    assert sinks.publish(spark, folder, "r1", outputs(spark)) == sinks.published(spark, folder, "r1")
