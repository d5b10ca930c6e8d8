"""Model registry: versioned models, atomic publication, resolution by what is there.

A model's files are written first, under a folder of their own version; then
one small entry is moved into the manifest folder.  A move within a file system
is atomic and never replaces an entry, so a reader sees a model whole or not at
all, and of two writers of one version the later takes the next number.  An
entry whose files are gone counts as absent, so resolution falls back to the
next kind of model, as a service does that looks for files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from aeroseries.operators.boosting import BoostedModel
from aeroseries.operators.models import resolve_model

TOTAL = "Total_Pollen"
# Kinds of models by priority, and the types that each may serve (None: all).
PRIORITY = {"weather_only": (1, None), "multi_type": (2, None), "random_forest": (3, (TOTAL,))}
ENTRY = "pollen_type string, model string, version int, format string, path string, features array<string>"


@dataclass(frozen=True)
class Resolved:
    """A loaded model with its place in the registry; scores like the model itself."""
    pollen_type: str
    name: str
    version: int
    path: str
    model: object
    features: tuple

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)


class Registry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._loaded: dict[str, Resolved] = {}

    def _path(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        p, fs = self._path(path)
        return bool(fs.exists(p))

    def _manifest(self) -> list[dict]:
        """The entries; as many as models were published."""
        p, fs = self._path(f"{self.root}/manifest")
        if not fs.exists(p):
            return []
        out = []
        for status in fs.listStatus(p):
            if status.getPath().getName().endswith(".json"):
                source = fs.open(status.getPath())
                try:
                    out.append(json.loads(bytes(source.readAllBytes()).decode()))
                finally:
                    source.close()
        return out

    # A8 ---------------------------------------------------------------------------
    def publish(self, pollen_type: str, name: str, model, features: Sequence[str]) -> int:
        """Store a model with its ordered feature names; returns its version."""
        if name not in PRIORITY:
            raise ValueError(f"unknown kind of model: {name}")
        path = f"{self.root}/models/{pollen_type}/{name}/{uuid.uuid4().hex}"
        boosted = isinstance(model, BoostedModel)
        if boosted:
            model.save(self.spark, path)
        else:
            model.write().save(path)
        p, fs = self._path(f"{self.root}/manifest")
        fs.mkdirs(p)
        version = 1 + max([e["version"] for e in self._manifest() if (e["pollen_type"], e["model"]) == (pollen_type, name)], default=0)
        while True:
            entry = dict(pollen_type=pollen_type, model=name, version=version, format="boosted" if boosted else "pipeline", path=path, features=list(features))
            draft, _ = self._path(f"{self.root}/manifest/.{uuid.uuid4().hex}.draft")
            sink = fs.create(draft)
            sink.write(bytearray(json.dumps(entry).encode()))
            sink.close()
            target, _ = self._path(f"{self.root}/manifest/{pollen_type}-{name}-{version:06d}.json")
            if not fs.exists(target) and fs.rename(draft, target):
                return version
            fs.delete(draft, False)
            version += 1

    def entries(self) -> DataFrame:
        """The latest version of each model, and whether its files are there: one row a (type, kind)."""
        latest: dict[tuple, dict] = {}
        for e in sorted(self._manifest(), key=lambda e: e["version"]):
            if self._exists(e["path"]):
                latest[e["pollen_type"], e["model"]] = e
        rows = [(e["pollen_type"], e["model"], e["version"], e["format"], e["path"], e["features"], PRIORITY[e["model"]][0], PRIORITY[e["model"]][1] is None or e["pollen_type"] in PRIORITY[e["model"]][1]) for e in latest.values()]
        return self.spark.createDataFrame(rows, ENTRY + ", priority int, available boolean")

    # I16 --------------------------------------------------------------------------
    def resolve(self) -> DataFrame:
        """The model that serves each type: (pollen_type, model, priority, version, format, path, features)."""
        e = self.entries()
        return resolve_model(e).join(e.select("pollen_type", "model", "version", "format", "path", "features"), ["pollen_type", "model"])

    def load(self) -> dict[str, Resolved]:
        """The resolved model of each type; a model is read again only when another one is resolved."""
        out = {}
        for r in self.resolve().collect():
            known = self._loaded.get(r["pollen_type"])
            if known is None or known.path != r["path"]:
                model = BoostedModel.load(self.spark, r["path"]) if r["format"] == "boosted" else PipelineModel.load(r["path"])
                known = Resolved(r["pollen_type"], r["model"], r["version"], r["path"], model, tuple(r["features"]))
            out[r["pollen_type"]] = known
        self._loaded = out
        return out
