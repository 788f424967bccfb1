"""Model packages: a tar.gz with manifest.json and model/, read only if its size, hash and members are as expected.

The archive is read and opened by a task (``binaryFile``); its members reach the shared folder
one at a time.  A package is bounded by ``LARGEST``, what it unpacks to by ``UNPACKED``.
"""

from __future__ import annotations

import importlib.metadata
import io
import json
import posixpath
import sys
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LARGEST, UNPACKED = 1_000_000_000, 4_000_000_000
CONTRACT = 1
#: Packages whose version must be that of the fit.
LIBRARIES = ("pyspark", "numpy", "pandas")


def safe_members(archive: tarfile.TarFile, unpacked: int) -> Iterator[tuple[str, bytes]]:
    """(name, content) of the files; any member that isn't a plain file or folder below the root is an error, before a byte is given out."""
    members, size, seen = archive.getmembers(), 0, set()
    for m in members:
        name = posixpath.normpath(m.name)
        if m.name.startswith("/") or "\\" in m.name or ":" in m.name or name.split("/")[0] == "..":
            raise ValueError(f"the package has an unsafe member: {m.name}")
        if not (m.isfile() or m.isdir()):
            raise ValueError(f"the package has a link or device: {m.name}")
        if m.isfile() and name in seen:
            raise ValueError(f"the package has {name} twice")
        seen.add(name)
        size += m.size
        if size > unpacked:
            raise ValueError(f"the package unpacks to more than {unpacked} bytes")
    for m in members:
        if m.isfile():
            yield posixpath.normpath(m.name), archive.extractfile(m).read()


def members(spark: SparkSession, path: str, sha256: str, largest: int = LARGEST, unpacked: int = UNPACKED) -> DataFrame:
    """(member, content) of the package at ``path``; the job fails if its size or hash is another."""
    found = spark.read.format("binaryFile").load(path)
    content = (
        F.when((F.col("length") <= 0) | (F.col("length") > largest), F.raise_error(F.concat(F.lit("the size of the package is out of bounds: "), F.col("length").cast("string"))).cast("binary"))
        .when(F.sha2("content", 256) != sha256.lower(), F.raise_error(F.lit("the package has another SHA-256")).cast("binary"))
        .otherwise(F.col("content"))
    )

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for raw in batch["content"]:
                with tarfile.open(fileobj=io.BytesIO(raw), mode="r:gz") as archive:
                    for name, data in safe_members(archive, unpacked):
                        yield pd.DataFrame({"member": [name], "content": [data]})

    return found.select(content.alias("content")).mapInPandas(of, "member string, content binary")


def unpack(spark: SparkSession, found: DataFrame, target: str) -> list[str]:
    """Write the members below ``target``, one at a time; their names."""
    at = spark._jvm.org.apache.hadoop.fs.Path
    files = at(target).getFileSystem(spark._jsc.hadoopConfiguration())
    names = []
    for row in found.toLocalIterator():
        out = files.create(at(f"{target}/{row['member']}"), True)
        out.write(bytearray(row["content"]))
        out.close()
        names.append(row["member"])
    return names


def incompatible(manifest: dict, client: int, features: list[str], target: str) -> list[str]:
    """What in a manifest doesn't fit this client, these features and label, and this environment."""
    version, built = manifest.get("dataset_version") or {}, manifest.get("versions") or {}
    python = ".".join(str(built.get("python", "")).split(".")[:2])
    checks = {
        "contract": version.get("contract") == CONTRACT,
        "client": version.get("client_id") == client,
        "dataset version": isinstance(version.get("id"), int) and version["id"] > 0,
        "features": manifest.get("features") == list(features),
        "target": manifest.get("target") == target,
        "python": python == f"{sys.version_info[0]}.{sys.version_info[1]}",
    } | {name: built.get(name) == importlib.metadata.version(name) for name in LIBRARIES}
    return [name for name, good in checks.items() if not good]


def manifest_of(client: int, dataset_version: int, features: list[str], target: str) -> dict:
    """The manifest of a model fitted here."""
    versions = {"python": ".".join(map(str, sys.version_info[:3]))} | {name: importlib.metadata.version(name) for name in LIBRARIES}
    return {"dataset_version": {"contract": CONTRACT, "client_id": client, "id": dataset_version}, "features": list(features), "target": target, "versions": versions}


def load_package(spark: SparkSession, path: str, sha256: str, target: str, client: int, features: list[str], label: str = "label", largest: int = LARGEST, unpacked: int = UNPACKED) -> tuple[PipelineModel, dict]:
    """(model, manifest) of a verified and compatible package, unpacked below ``target``."""
    names = unpack(spark, members(spark, path, sha256, largest, unpacked), target)
    if "manifest.json" not in names or not any(n.startswith("model/") for n in names):
        raise ValueError("a package holds manifest.json and model/")
    manifest = json.loads(spark.read.text(f"{target}/manifest.json", wholetext=True).first()["value"])
    if wrong := incompatible(manifest, client, features, label):
        raise ValueError(f"the model doesn't fit: {', '.join(wrong)}")
    return PipelineModel.load(f"{target}/model"), manifest
