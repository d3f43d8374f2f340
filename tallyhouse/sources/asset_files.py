"""Image files and their manifest, written by the executors."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tallyhouse.operators.assets import DATA_LAKE


def write_files(rows: DataFrame, path: str, data: str, root: str) -> None:
    """Write the bytes of each row to its path under `root`, a folder or URI all executors reach.

    `path` holds logical paths below the data lake. A file appears under its name only when it is
    complete, so a task that runs again replaces whole files with the same bytes.
    """

    def write(partition: Iterator[Row]) -> None:
        import uuid

        from pyarrow import fs

        files, base = fs.FileSystem.from_uri(root)
        for target, payload in partition:
            full = f"{base}{target.removeprefix(DATA_LAKE)}"
            folder, name = full.rsplit("/", 1)
            files.create_dir(folder, recursive=True)
            unfinished = f"{folder}/.{name}.{uuid.uuid4().hex}.tmp"
            with files.open_output_stream(unfinished) as stream:
                stream.write(bytes(payload))
            files.move(unfinished, full)

    rows.select(path, data).foreachPartition(write)


def write_assets(carved: DataFrame, manifest: DataFrame, key: str, payload: str, root: str) -> None:
    """Raw payloads, carved images, then the manifest as JSON lines: it never names a missing file."""
    placed = manifest.select(key, "raw_path", "curated_path").join(carved, key)
    write_files(placed, "raw_path", payload, root)
    write_files(placed, "curated_path", "image", root)
    manifest.withColumn("extracted_at", F.current_timestamp()).write.mode("overwrite").json(f"{root}/manifests")
