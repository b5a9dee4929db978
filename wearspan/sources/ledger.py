"""Run ledger and registry as append-only tables under one folder."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearspan.operators.linear import LinearModel, of_regression
from wearspan.operators.registry import champions, consistent_shapes
from wearspan.operators.scaling import ScalerState
from wearspan.schemas import LINEAR_MODELS, MODEL_SHAPES, PROMOTIONS, RUN_METRICS, RUN_VALUES, SCALERS

class NoChampion(RuntimeError):
    """There is no promoted model to score with."""


class InconsistentArtifacts(ValueError):
    """A run's model and scaler disagree."""


@dataclass(frozen=True)
class Champion:
    """One concrete version: everything it needs comes from the same run."""

    model_name: str
    version: str
    run_id: str
    model: object
    scaler: ScalerState
    window_size: int

    @property
    def num_features(self) -> int:
        return len(self.scaler.features)


class Ledger:
    """Parameters, tags, metrics, reports, models and promotions of runs."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root

    def _append(self, rows: list[tuple], schema: T.StructType, name: str) -> None:
        table = self.spark.createDataFrame(rows, schema).coalesce(1)
        table.write.mode("append").parquet(f"{self.root}/{name}")

    def _table(self, name: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
                raise
            return self.spark.createDataFrame([], schema)

    def log_params(self, run_id: str, params: dict[str, object]) -> None:
        self._append([(run_id, k, str(v)) for k, v in params.items()], RUN_VALUES, "params")

    def log_tags(self, run_id: str, tags: dict[str, object]) -> None:
        self._append([(run_id, k, str(v)) for k, v in tags.items()], RUN_VALUES, "tags")

    def log_metrics(self, run_id: str, metrics: dict[str, float], step: int | None = None) -> None:
        rows = [(run_id, step, k, float(v)) for k, v in metrics.items()]
        self._append(rows, RUN_METRICS, "metrics")

    def append_history(self, history: DataFrame, columns: list[str]) -> None:
        """Step metrics in long form, straight from a history table."""
        entries = F.array(
            *[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in columns]
        )
        long = history.select("run_id", "step", F.inline(entries))
        long.write.mode("append").parquet(f"{self.root}/metrics")

    def append_report(self, report: DataFrame) -> None:
        report.write.mode("append").parquet(f"{self.root}/reports")

    def params(self) -> DataFrame:
        return self._table("params", RUN_VALUES)

    def tags(self) -> DataFrame:
        return self._table("tags", RUN_VALUES)

    def metrics(self) -> DataFrame:
        return self._table("metrics", RUN_METRICS)

    def promotions(self) -> DataFrame:
        return self._table("promotions", PROMOTIONS)

    def shapes(self) -> DataFrame:
        return self._table("shapes", MODEL_SHAPES)

    def scalers(self) -> DataFrame:
        return self._table("scalers", SCALERS)

    def linear_models(self) -> DataFrame:
        """The numbers of every saved model: what another engine needs to score with it."""
        return self._table("linear", LINEAR_MODELS)

    def linear_model(self, run_id: str) -> LinearModel:
        return LinearModel.of(self.linear_models().filter(F.col("run_id") == run_id))

    def runs(self) -> DataFrame:
        """(run_id, fingerprint, f2_weighted): what a champion comparison needs."""
        tags = (
            self.tags()
            .filter(F.col("name") == "fingerprint")
            .groupBy("run_id")
            .agg(F.max("value").alias("fingerprint"))
        )
        scores = (
            self.metrics()
            .filter((F.col("metric") == "test_f2_weighted") & F.col("step").isNull())
            .groupBy("run_id")
            .agg(F.max("value").alias("f2_weighted"))
        )
        return tags.join(scores, "run_id", "full")

    def save_model(self, run_id: str, model, scaler: DataFrame, window: int, width: int) -> None:
        model.write().overwrite().save(f"{self.root}/models/{run_id}")
        scaler.withColumn("run_id", F.lit(run_id)).select("run_id", *scaler.columns).coalesce(
            1
        ).write.mode("append").parquet(f"{self.root}/scalers")
        numbers = of_regression(model).table(self.spark).withColumn("run_id", F.lit(run_id))
        numbers.select(*LINEAR_MODELS.names).coalesce(1).write.mode("append").parquet(f"{self.root}/linear")
        self._append([(run_id, window, width, scaler.count())], MODEL_SHAPES, "shapes")

    def promote(self, model_name: str, run_id: str, at: datetime | None = None) -> int:
        """Register the next version of a model and make it the champion.

        Writers may promote at the same time: a number belongs to the one who creates its claim, the others
        take the next, and each writes a folder of its own. A writer that is lost in between leaves a number
        without a promotion; it is not given again.
        """
        last = (
            self.promotions().filter(F.col("model_name") == model_name).agg(F.max("version")).first()[0]
        )
        version = (last or 0) + 1
        folder = f"model-{quote(model_name, safe='')}"
        while not self._claim(f"{self.root}/claims/{folder}", version):
            version += 1
        at = at or datetime.now(UTC).replace(tzinfo=None)
        self._append([(model_name, version, run_id, at)], PROMOTIONS, f"promotions/{folder}/{version}")
        return version

    def _claim(self, folder: str, version: int) -> bool:
        """Whether this call created the claim of a version. File systems refuse to create a file twice; the local one
        only checks before it creates, so there the file is made by the operating system."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{version}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        files.mkdirs(path.getParent())
        if files.getUri().getScheme() == "file":
            return jvm.java.io.File(path.toUri().getPath()).createNewFile()
        try:
            files.create(path, False).close()
        except Py4JJavaError:
            if not files.exists(path):
                raise
            return False
        return True

    def champion(self, model_name: str, default_window: int) -> Champion:
        """Resolve the champion to one version and load that version's artifacts."""
        row = champions(self.promotions().filter(F.col("model_name") == model_name)).first()
        if row is None or row["run_id"] is None:
            raise NoChampion(f"model {model_name} has no champion")
        return self.version(model_name, str(row["version"]), row["run_id"], default_window)

    def version(self, model_name: str, version: str, run_id: str, default_window: int) -> Champion:
        """Load the artifacts of a given version, the champion of today or not."""
        shape = consistent_shapes(
            self.shapes().filter(F.col("run_id") == run_id), default_window
        ).first()
        if shape is not None and not shape["consistent"]:
            raise InconsistentArtifacts(
                f"run {run_id}: the model does not take the {shape['num_features']} features of its scaler"
            )
        scaler = ScalerState.of(
            self.scalers().filter(F.col("run_id") == run_id).drop("run_id")
        )
        return Champion(
            model_name=model_name,
            version=version,
            run_id=run_id,
            model=LogisticRegressionModel.load(f"{self.root}/models/{run_id}"),
            scaler=scaler,
            window_size=shape["window_size"] if shape is not None else default_window,
        )
