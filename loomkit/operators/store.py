"""Stores that are appended to: run records with their metrics (R12), and models by name and version.

Both live in a folder that the cluster shares.  A record is written to a folder of
its own, named by its key, so appending twice writes the same place and nothing
is ever rewritten; readers see records that were written to their end.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import storage
from ..sources.files import write_table
from .runs import EXP, RUN, START, resolve_model
from .scoring import ExpressionModel, NumpyLogisticModel


def _key(*parts) -> str:
    return hashlib.sha256("\x1f".join(map(str, parts)).encode()).hexdigest()[:32]


class RunStore:
    """Run records under ``root``: ``runs/<key>`` (Parquet) and ``metrics/<key>`` (JSON lines)."""

    def __init__(self, spark: SparkSession, root: str, id_type: str = "bigint"):
        self.spark, self.root = spark, root
        self.schema = (f"{EXP} {id_type}, {RUN} {id_type}, {START} timestamp_ntz, tags map<string,string>, "
                       "params map<string,string>, metrics map<string,double>")
        self.metric_schema = f"{EXP} {id_type}, {RUN} {id_type}, metric string, value double"

    def _at(self, kind: str, key: str = "") -> str:
        return os.path.join(self.root, kind, key)

    def append(self, run: DataFrame) -> bool:
        """Add one run record (a row as ``log_run`` makes it).

        False if the store holds the same record already; a different record under
        the same experiment and run is an error.  The metrics are written first,
        so a run that can be read has them."""
        empty = self.spark.createDataFrame([], self.schema)
        rows = run.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in empty.schema]).take(2)  # one record
        if len(rows) != 1:
            raise ValueError("append takes one run record at a time")
        record = self.spark.createDataFrame(rows, empty.schema)
        key = _key(rows[0][EXP], rows[0][RUN])
        if storage.exists(self.spark, self._at("runs", f"{key}/_SUCCESS")):
            held = self.spark.read.schema(self.schema).parquet(self._at("runs", key)).first()
            if held != rows[0]:
                raise ValueError(f"run {rows[0][RUN]} of experiment {rows[0][EXP]} is logged already, with other content")
            return False
        flat = record.select(EXP, RUN, F.explode("metrics").alias("metric", "value"))
        write_table(flat.coalesce(1), self._at("metrics", key), "json")
        write_table(record.coalesce(1), self._at("runs", key), "parquet")
        return True

    def _read(self, kind: str, schema: str, fmt: str) -> DataFrame:
        if not storage.exists(self.spark, self._at(kind)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").format(fmt).load(self._at(kind))

    def runs(self) -> DataFrame:
        """Every run record, as R1-R10 take them."""
        return self._read("runs", self.schema, "parquet")

    def metrics(self) -> DataFrame:
        """(experiment_id, run_id, metric, value) from the JSON files."""
        return self._read("metrics", self.metric_schema, "json")


class ModelStore:
    """Saved models by name, version and alias under ``root``."""

    VERSIONS = "model_name string, version bigint, run_id string, kind string, path string"
    ALIASES = "model_name string, alias string, version bigint"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _table(self, kind: str, schema: str) -> DataFrame:
        at = os.path.join(self.root, kind)
        if not storage.exists(self.spark, at):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(at)

    def versions(self) -> DataFrame:
        return self._table("model_versions", self.VERSIONS)

    def aliases(self) -> DataFrame:
        return self._table("model_aliases", self.ALIASES)

    def register(self, name: str, model, run_id=None) -> int:
        """Save a model as the next version of ``name``; two writers of one version: the later one fails."""
        last = self.versions().where(F.col("model_name") == name).agg(F.max("version")).first()[0]
        version = (last or 0) + 1
        path = os.path.join(self.root, "models", _key(name), str(version))
        if isinstance(model, Model):
            kind, pipeline = "spark", model if isinstance(model, PipelineModel) else PipelineModel(stages=[model])
            pipeline.write().overwrite().save(path)
        elif isinstance(model, (ExpressionModel, NumpyLogisticModel)):
            kind = "expression" if isinstance(model, ExpressionModel) else "python"
            path += ".json"
            model.save(path)
        else:
            raise TypeError(f"cannot save a {type(model).__name__}")
        row = self.spark.createDataFrame([(name, version, None if run_id is None else str(run_id), kind, path)], self.VERSIONS)
        write_table(row.coalesce(1), os.path.join(self.root, "model_versions", f"{_key(name)}-{version}"), mode="errorifexists")
        return version

    def set_alias(self, name: str, alias: str, version: int) -> None:
        """Point ``alias`` of ``name`` at a registered version (any earlier target is replaced)."""
        if not self.versions().where((F.col("model_name") == name) & (F.col("version") == version)).take(1):
            raise ValueError(f"{name} has no version {version}")
        row = self.spark.createDataFrame([(name, alias.lower(), version)], self.ALIASES)
        write_table(row.coalesce(1), os.path.join(self.root, "model_aliases", _key(name, alias.lower())))

    def resolve(self, name: str, spec: str = "champion") -> tuple[int, str, str]:
        """(version, kind, path) of a version number, an alias or ``latest``, by the rules of ``resolve_model``."""
        request = self.spark.createDataFrame([(name, str(spec))], "model_name string, version_spec string")
        known = self.versions()
        found = resolve_model(request, known, self.aliases()).join(
            known.select("model_name", F.col("version").alias("resolved_version"), "kind", "path"), ["model_name", "resolved_version"])
        row = found.select("resolved_version", "kind", "path").first()
        if row is None:
            raise ValueError(f"no model {name!r} with version or alias {spec!r}")
        return tuple(row)

    def load(self, name: str, spec: str = "champion"):
        """The model that ``spec`` of ``name`` resolves to."""
        _, kind, path = self.resolve(name, spec)
        loader = {"spark": PipelineModel.load, "expression": ExpressionModel.load, "python": NumpyLogisticModel.load}
        return loader[kind](path)
