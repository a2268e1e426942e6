"""Listing level by level, against the local file system's own walk."""

import os

import pytest

from marketlens.sources import catalog
from marketlens.sources.catalog import list_files, with_archives


@pytest.fixture
def tree(tmp_path):
    for a in range(5):
        for b in range(3):
            folder = tmp_path / f"a {a}" / f"b+%{b}" / "deep"
            folder.mkdir(parents=True)
            for n in range(4):
                (folder / f"ção {n}.csv").write_bytes(b"x" * n)
        (tmp_path / f"a {a}" / "readme").write_text("r")
    (tmp_path / "empty" / "folder").mkdir(parents=True)
    return tmp_path


def walked(root):
    return sorted((os.path.join(d, f), os.path.getsize(os.path.join(d, f))) for d, _, names in os.walk(root) for f in names)


def test_every_file_once(spark, tree):
    roots = [str(tree), str(tree / "a 1"), str(tree / "a 2" / "readme"), str(tree / "missing")]
    got = list_files(spark, roots)
    assert sorted((r.path, r.size_bytes) for r in got.collect()) == walked(tree)
    assert list_files(spark, []).isEmpty() and list_files(spark, [str(tree / "empty"), str(tree / "none")]).isEmpty()


def test_a_task_holds_one_folder_at_a_time(spark, tree, monkeypatch):
    seen = []
    plain = catalog.durable
    monkeypatch.setattr(catalog, "durable", lambda df: seen.append(df) or plain(df))
    list_files(spark, [str(tree)])
    assert [df.rdd.getNumPartitions() for df in seen] == [1, 6, 16, 15]


def test_files_are_opened_by_many_tasks(spark, tree):
    files = with_archives(list_files(spark, [str(tree)]))
    assert files.rdd.getNumPartitions() == 8 and files.filter("zipped").isEmpty() and files.count() == 65
