"""Automatic segmentation of any table (G6): preparation, grid-size rule, map,
labels, metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import q
from .prep import AutoPrep, AutoPrepModel, coord_label
from .som import SOM, SOMModel, default_grid_size
from .som import quality as Q


@dataclass
class Segmentation:
    """``rows``: the input with all its columns, unchanged, and ``som_group_x``,
    ``som_group_y`` and ``som_cluster`` (in place of columns of these names)."""

    rows: DataFrame
    prep: AutoPrepModel
    model: SOMModel
    _prepared: DataFrame
    _observed: Q.ObservedMetrics | None = None

    def metrics(self) -> DataFrame:
        """One row: qe, te, nodes_used, total_nodes, coverage, max_hits, mean_hits.  Rows
        saved to a destination were measured as they were written."""
        if self._observed is not None:
            return self._observed.table(self.rows.sparkSession)
        cfg = self.model.config
        return Q.metrics(self.model.score(self._prepared), cfg.x, cfg.y)


def auto_segment(df: DataFrame, epochs: int = 20, learning_rate: float = 0.5,
                 initialization: str = "grid", destination=None, rule=None) -> Segmentation:
    """Segment the rows of ``df``.  Id-like columns (by ``rule``) are kept but not
    used.  ``destination`` (a ``Destination``) saves the labelled rows and takes the
    metrics in the same pass."""
    df = df.drop("som_group_x", "som_group_y", "som_cluster")
    prep = (AutoPrep(rule) if rule else AutoPrep()).fit(df)
    prepared = prep.transform(df)
    n = prep.n_rows if prep.n_rows is not None else prepared.count()
    side, sigma = default_grid_size(n)
    model = SOM(side, side, features=prep.features, epochs=epochs, sigma=sigma,
                learning_rate=learning_rate, initialization=initialization).fit(prepared)
    # the columns as they were ride along while their prepared versions are scored;
    # other columns too, out of the way of the score's own names
    kept = {c: f"__was_{i}" for i, c in enumerate(df.columns)}
    both = prep.transform(df.withColumns({w: F.col(q(c)) for c, w in kept.items()}))
    both = both.select(*[F.col(q(c)) for c in prep.features], *kept.values())
    labelled = [*[F.col(w).alias(c) for c, w in kept.items()], "som_group_x", "som_group_y",
                coord_label("som_group_x", "som_group_y").alias("som_cluster")]
    if destination is None:
        return Segmentation(model.transform(both, prefix="som_group").select(*labelled), prep, model, prepared)
    scored = model.transform(both, distance=True, second=True, prefix="som_group")
    scored, observed = Q.observe_metrics(scored, side, side, "som_group")
    rows = scored.select(*labelled)
    destination.save(rows)
    return Segmentation(rows, prep, model, prepared, observed)
