"""Replace or add folders of stored tables so that a crash at any point can be repaired."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _beside(path: str, label: str) -> str:
    # Readers of the parent folder pass over names that start with a dot.
    parent, name = path.rstrip("/").rsplit("/", 1)
    return f"{parent}/.{label}-{name}"


def finish_replacement(spark: SparkSession, path: str) -> None:
    """Repair a replacement of ``path`` that was cut short; without one nothing happens.

    If the old folder has been put aside and the new one is not yet in place, the new one (complete by
    then) moves in. In every other state ``path`` holds whole contents and the leftovers go.
    """
    target, new, old = (_path(spark, p) for p in (path, _beside(path, "new"), _beside(path, "old")))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(old) and not fs.exists(target) and not fs.rename(new, target):
        raise OSError(f"cannot move {new} to {target}")
    fs.delete(old, True)
    fs.delete(new, True)


def replace_folder(df: DataFrame, path: str) -> None:
    """Write ``df`` as the new contents of the Parquet folder ``path``, which ``df`` may read.

    The rows are written beside the folder; then two renames put the old folder aside and the new one
    in its place. Readers that start between the renames find no folder. After a crash
    ``finish_replacement`` leaves the old or the new contents, never a mixture. One writer at a time; on
    stores without an atomic rename of folders use a table format instead.
    """
    spark = df.sparkSession
    finish_replacement(spark, path)
    target, new, old = (_path(spark, p) for p in (path, _beside(path, "new"), _beside(path, "old")))
    df.write.parquet(_beside(path, "new"))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"cannot move {target} to {old}")
    finish_replacement(spark, path) if fs.exists(old) else fs.rename(new, target)
    # A later read in this session must not use the listing of the old files.
    spark.catalog.refreshByPath(path)


def finish_addition(spark: SparkSession, path: str, added: str) -> None:
    """Repair ``replace_and_add`` that was cut short; without one nothing happens.

    Until the added rows are marked ready both folders are as before, and what was staged goes. From
    then on both changes are carried out, from whichever step is missing.
    """
    names = (path, _beside(path, "staged"), _beside(path, "replaced"), added, _beside(added, "staged"), _beside(added, "ready"))
    target, fresh, old, new_folder, staged, ready = (_path(spark, p) for p in names)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(ready):
        if fs.exists(fresh):
            if fs.exists(target) and not fs.rename(target, old):
                raise OSError(f"cannot move {target} to {old}")
            if not fs.rename(fresh, target):
                raise OSError(f"cannot move {fresh} to {target}")
        fs.delete(old, True)
        # The added folder comes last: a reader that sees it sees the replaced rows too.
        if not fs.rename(ready, new_folder):
            raise OSError(f"cannot move {ready} to {new_folder}")
        spark.catalog.refreshByPath(path)
    else:
        fs.delete(staged, True)
        fs.delete(fresh, True)


def replace_and_add(df: DataFrame, path: str, rows: DataFrame, added: str) -> None:
    """Replace the contents of ``path`` by ``df`` and add ``rows`` as the folder ``added``: both or neither.

    Both are written beside their places, and one rename marks them ready; ``finish_addition``, called here
    and by the next run after a crash, puts them in place. One writer at a time, as for ``replace_folder``.
    """
    spark = df.sparkSession
    finish_addition(spark, path, added)
    df.write.parquet(_beside(path, "staged"))
    staged, ready = _path(spark, _beside(added, "staged")), _path(spark, _beside(added, "ready"))
    rows.write.parquet(_beside(added, "staged"))
    fs = staged.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.rename(staged, ready):
        raise OSError(f"cannot move {staged} to {ready}")
    finish_addition(spark, path, added)


def numbered_folders(spark: SparkSession, parent: str, name: str) -> list[int]:
    """The numbers n of the folders ``name=n`` below ``parent``, ascending; none if it does not exist."""
    root = _path(spark, parent)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(root)] if fs.exists(root) else []
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{name}="))
