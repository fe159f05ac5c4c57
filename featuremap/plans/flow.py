"""Extract -> stages -> load composition.

Each stage is fitted on the output of the stage before it (P2) and can be
re-applied to new data through the returned ``PipelineModel`` (P3).  A stage
is anything with ``fit``/``transform`` (our estimators, ``pyspark.ml``
stages) or a plain ``DataFrame -> DataFrame`` function (P7).  Because every
fit is a Spark job, the intermediate result is persisted once, before the
first fit that follows other stages, so earlier stages are not recomputed per
fit (one cached copy, released by ``unpersist`` or after ``load_to``).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..errors import PipelineError
from ..operators.base import FunctionStage, Model


def _as_stage(stage):
    if hasattr(stage, "transform") or hasattr(stage, "fit"):
        return stage
    if callable(stage):
        return FunctionStage(stage)
    raise PipelineError(f"not a stage: {stage!r}")


def _fit(stage, df: DataFrame):
    if isinstance(stage, Model):
        return stage
    if hasattr(stage, "fit"):
        return stage.fit(df)
    return stage


class PipelineModel:
    def __init__(self, models: list):
        self.models = models

    def transform(self, df: DataFrame) -> DataFrame:
        for m in self.models:
            df = m.transform(df)
        return df


class Pipeline:
    """``Pipeline(source, destination, stages)`` with a fluent builder."""

    def __init__(self, source=None, destination=None, stages=None, transformers=None):
        self._source = source
        self._destination = destination
        self._stages = [_as_stage(s) for s in (stages or transformers or [])]
        self._data: DataFrame | None = None
        self._cached: list[DataFrame] = []
        self.model: PipelineModel | None = None

    # builder (stage 0)
    def extract_from(self, source) -> "Pipeline":
        self._source = source
        return self

    def add_transformer(self, stage) -> "Pipeline":
        self._stages.append(_as_stage(stage))
        return self

    add_stage = add_transformer

    def load_to(self, destination) -> "Pipeline":
        self._destination = destination
        return self

    @property
    def data(self) -> DataFrame | None:
        """The last produced DataFrame."""
        return self._data

    def fit(self, df: DataFrame) -> PipelineModel:
        """Fit every stage on the output of the previous one.

        The input of the first fit that follows another stage is persisted
        once; later stages are projections or broadcast joins of it, cheap to
        re-derive, so a single cached copy serves every later fit.
        """
        models = []
        for i, stage in enumerate(self._stages):
            needs_fit = hasattr(stage, "fit") and not isinstance(stage, Model)
            if needs_fit and i > 0 and not self._cached:
                df = df.persist(StorageLevel.MEMORY_AND_DISK)
                self._cached.append(df)
            m = _fit(stage, df)
            models.append(m)
            df = m.transform(df)
        self._data = df
        self.model = PipelineModel(models)
        # all stages are fitted: what comes now reads the input itself
        self.unpersist()
        return self.model

    def run(self, spark: SparkSession | None = None) -> DataFrame:
        if self._source is None:
            raise PipelineError("No source configured")
        try:
            spark = spark or SparkSession.getActiveSession()
            df = self._source.extract(spark) if hasattr(self._source, "extract") \
                else self._source(spark)
            self.fit(df)
            if self._destination is not None:
                save = getattr(self._destination, "save", self._destination)
                save(self._data)
            return self._data
        except PipelineError:
            raise
        except Exception as e:
            raise PipelineError(f"Pipeline failed: {e}") from e

    def unpersist(self) -> None:
        for d in self._cached:
            d.unpersist()
        self._cached = []


class SOMStage:
    """The map as a pipeline stage adding ``som_x``, ``som_y``."""

    def __init__(self, grid_size: int | tuple[int, int] = 10, epochs: int = 20,
                 normalize: bool = True, features: list[str] | None = None, **som_kw):
        # the map always min-max scales with the training bounds (decision D24),
        # so ``normalize=False`` cannot be honoured
        if not normalize:
            raise ValueError("the map always scales its features with the training bounds")
        self.grid = (grid_size, grid_size) if isinstance(grid_size, int) else tuple(grid_size)
        self.epochs, self.features, self.som_kw = epochs, features, som_kw

    def fit(self, df: DataFrame):
        from ..operators.som import SOM

        model = SOM(self.grid[0], self.grid[1], features=self.features, epochs=self.epochs,
                    **self.som_kw).fit(df)
        return FunctionStage(lambda d: model.transform(d, prefix="som"), "som")
