"""Versioned store of fitted models (IO9, D7): tables, Spark ML models and settings under one manifest.

A version is a folder of its own: ``tables/<name>`` (Parquet), ``models/<name>`` (Spark ML writers), and a
``manifest.json`` that names them and is written when all of them are there. The file ``current`` holds the name
of the version that is read by default; it is replaced by one rename, last of all, so readers see either the old version
or the whole new one, never a part. Writing goes through Hadoop's file systems, so any shared store that Spark reads
will do.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession

from ledgerline.sources.files import DataFileError


class ModelStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    # files
    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self._conf)

    def _read(self, *parts: str) -> str:
        if not self._fs().exists(self._path(*parts)):
            raise DataFileError(f"missing: {'/'.join([self.root, *parts])}")
        return "\n".join(r.value for r in self.spark.read.option("wholetext", True).text(str(self._path(*parts).toString())).collect())  # one small file

    def _write(self, text: str, *parts: str) -> None:
        out = self._fs().create(self._path(*parts), True)
        out.write(bytearray(text.encode()))
        out.close()

    def _replace(self, source: str, target: str) -> None:
        """Rename over what is there, in one step."""
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs().getUri(), self._conf)
        kind = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(kind, 1)
        how[0] = kind.OVERWRITE
        qualify = lambda p: self._fs().makeQualified(self._path(p))
        context.rename(qualify(source), qualify(target), how)

    # versions
    def save(self, tables: dict[str, DataFrame], models: dict | None = None, values: dict | None = None,
             check: Callable[[dict], None] | None = None) -> str:
        """Write a new version and make it the current one. ``check`` may look at the version as it would be loaded, and
        raise, before it becomes current."""
        version = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        base = f"{self.root}/versions/{version}"
        manifest = {"version": version, "tables": {}, "models": {}, "values": values or {}}
        for name, df in tables.items():
            df.write.parquet(f"{base}/tables/{name}")
            manifest["tables"][name] = json.loads(df.schema.json())
        for name, model in (models or {}).items():
            model.write().save(f"{base}/models/{name}")
            manifest["models"][name] = type(model).__name__
        self._write(json.dumps(manifest), "versions", version, "manifest.json")
        if check is not None:
            check(self.load(version))
        self._write(version, f"current-{version}")
        self._replace(f"current-{version}", "current")
        return version

    def current(self) -> str | None:
        return self._read("current").strip() if self._fs().exists(self._path("current")) else None

    def versions(self) -> list[str]:
        """Whole versions, oldest first (a folder without a manifest was never finished)."""
        if not self._fs().exists(self._path("versions")):
            return []
        names = [s.getPath().getName() for s in self._fs().listStatus(self._path("versions"))]
        return sorted(n for n in names if self._fs().exists(self._path("versions", n, "manifest.json")))

    def load(self, version: str | None = None) -> dict:
        """``tables``, ``models`` and ``values`` of a version (default: the current one)."""
        version = version or self.current()
        if version is None:
            raise DataFileError(f"no saved version under {self.root}")
        manifest = json.loads(self._read("versions", version, "manifest.json"))
        base = f"{self.root}/versions/{version}"
        tables = {}
        for name, schema in manifest["tables"].items():
            df = self.spark.read.parquet(f"{base}/tables/{name}")
            if [f["name"] for f in schema["fields"]] != df.columns:
                raise DataFileError(f"table {name!r} of version {version} has other columns than were saved")
            tables[name] = df
        models = {n: DefaultParamsReader.loadParamsInstance(f"{base}/models/{n}", self.spark) for n in manifest["models"]}
        return {"version": version, "tables": tables, "models": models, "values": manifest["values"]}

    def prune(self, keep: int = 3) -> list[str]:
        """Delete all but the newest ``keep`` whole versions; the current one stays, and so does what is newer than it."""
        now, whole = self.current(), self.versions()
        gone = [v for v in whole[:-keep] if keep > 0 and now is not None and v < now]
        for v in gone:
            self._fs().delete(self._path("versions", v), True)
        return gone


# ---------------------------------------------------------------- what the operators fit

def save_detector(store: ModelStore, state: dict) -> str:
    """The state of :func:`ledgerline.operators.anomaly.fit_state`."""
    tables = {k: v for k, v in state.items() if isinstance(v, DataFrame)}
    values = {}
    if state.get("forest") is not None:
        forest = state["forest"]
        tables |= {f"forest_{k}": forest[k] for k in ("scaler", "trees", "offsets")}
        values = {"features": forest["features"], "keys": forest["keys"]}
    return store.save(tables, values=values)


def load_detector(store: ModelStore, version: str | None = None) -> dict:
    got = store.load(version)
    state = {k: v for k, v in got["tables"].items() if not k.startswith("forest_")}
    if got["values"]:
        state["forest"] = {k[len("forest_"):]: v for k, v in got["tables"].items() if k.startswith("forest_")} | got["values"]
    return state


def save_boosted(store: ModelStore, model) -> str:
    spark = store.spark
    trees = spark.createDataFrame([(i, t.feature, t.cut, t.left, t.right, [float(v) for v in t.value], [float(v) for v in t.gain]) for i, t in enumerate(model.trees)],
                                  "tree int, feature array<int>, cut array<int>, left array<int>, right array<int>, value array<double>, gain array<double>")
    edges = spark.createDataFrame([(i, f, [float(x) for x in e]) for i, (f, e) in enumerate(zip(model.features, model.edges))],
                                  "position int, feature string, edges array<double>")
    return store.save({"trees": trees, "edges": edges}, values={"base": float(model.base)})


def load_boosted(store: ModelStore, version: str | None = None):
    import numpy as np

    from ledgerline.operators.trees import BoostedTrees, Tree
    got = store.load(version)
    edges = got["tables"]["edges"].orderBy("position").collect()               # as many rows as features
    trees = got["tables"]["trees"].orderBy("tree").collect()                   # as many rows as trees
    return BoostedTrees([r.feature for r in edges], [np.array(r.edges, float) for r in edges], got["values"]["base"],
                        [Tree(list(r.feature), list(r.cut), list(r.left), list(r.right), list(r.value), list(r.gain)) for r in trees])
