"""Media folders listed by tasks."""

import os
import tempfile

import pytest

from quire.sources.media_tree import media_tree


def tree():
    root = tempfile.mkdtemp(prefix="quire-tree-")
    for name in ("top.mp4", "a/one.mp4", "a/b/c/d/two.x.mp4", "a/b/c/d/notes.txt", "hot/e/three.mp4",
                 "_tmp/left.mp4", "hot/.part.mp4"):
        os.makedirs(os.path.dirname(os.path.join(root, name)), exist_ok=True)
        with open(os.path.join(root, name), "wb") as f:
            f.write(b"x" * len(name))
    os.makedirs(os.path.join(root, "empty/still"))
    return root


@pytest.mark.parametrize("levels", [0, 1, 5])
def test_every_file_of_the_tree_is_listed_once(spark, levels):
    root = tree()
    names = {"top": "top.mp4", "one": "a/one.mp4", "two.x": "a/b/c/d/two.x.mp4",
             "three": "hot/e/three.mp4"}
    got = sorted(tuple(r) for r in media_tree(spark, root, split_levels=levels).collect())
    assert got == sorted((k, f"{root}/{v}", len(v)) for k, v in names.items())
    assert {r["media_path"] for r in media_tree(spark, f"file://{root}/", "*.txt").collect()} == {
        f"file://{root}/a/b/c/d/notes.txt"}


def test_a_missing_root_is_an_error_and_an_empty_one_is_not(spark):
    root = tempfile.mkdtemp(prefix="quire-tree-")
    assert media_tree(spark, root).count() == 0
    with pytest.raises(FileNotFoundError):
        media_tree(spark, f"{root}/none")


def test_written_files_are_listed_by_tasks(spark):
    from quire.sources import io
    from quire.sources.media_tree import write_media_tree

    root = f"{tempfile.mkdtemp(prefix='quire-tree-')}/new"
    ids = [str(i) for i in range(-3, 40)]
    write_media_tree(spark.createDataFrame([(i,) for i in [*ids, *ids, None]], "id string"), root)
    media = io.media_files(spark, root, "*.parquet", levels=1)
    assert sorted(r["media_id"] for r in media.collect()) == sorted(ids)
    assert not any(f.endswith(".writing") for _, _, names in os.walk(root) for f in names)
    assert {r["v"] for r in spark.read.parquet(f"{root}/*/*.parquet").collect()} == set(ids)


def test_media_answers_leaves_no_listing_to_the_driver(spark, monkeypatch):
    from pyspark.sql import DataFrameReader

    from quire.plans.catalog import QUERIES

    d = tempfile.mkdtemp(prefix="quire-tables-")
    spark.createDataFrame([(c, t, "user", f"text {c} {t}") for c in (-4, 1, 2) for t in (0, 2)],
                          "conv_id long, turn long, role string, text string").write.parquet(
        f"{d}/conversations.parquet")

    def no_listing(reader, source):
        assert source != "binaryFile"
        return read_format(reader, source)

    read_format = DataFrameReader.format
    monkeypatch.setattr(DataFrameReader, "format", no_listing)
    got = sorted(r["reply"].split(":")[0] if "file" in r["reply"] else "url"
                 for r in QUERIES["media_answers"](spark, d).collect())
    assert got == ["file -4", "file -4", "file 2", "file 2", "url", "url"]
