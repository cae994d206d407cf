"""Models (M6-M10, M13): prior baseline, random forest, gradient-boosted trees.

Preprocessing, bins and trees are fitted on all training rows, which are written
once as blocks of binned rows (``Prepared``); ``growing`` grows the trees from
them in Spark tasks. Scoring covers all rows, in batches. A forest of more than
``MODEL_NODES`` nodes stays a table (``stored``).

* forest: depth unlimited if asked, class weights balanced in each bootstrap;
* booster: trees grown leaf by leaf to a number of leaves, L2 in gains and leaf
  values; beyond ``growing.EARLY_STOPPING_ROWS`` fitted rows the latest tenth of
  them decides when to stop.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import attach_one_row
from ..operators.features import CATEGORICAL_FEATURES, FEATURES
from ..operators.ordering import exact_rank
from ..session import materialize
from .growing import Shape, grow_all, held_rows, packed_rows, unpickled
from .preprocess import Encoder, feature_cuts
from .stored import StoredForest
from .trees import Bins, Booster, Columns, Trees

LABEL = "is_late"
WEIGHT = "class_weight"
VALIDATION = "is_validation"
SEED = 42
# Training rows in a block, and nodes up to which a forest is sent along with the rows to score.
BLOCK_ROWS, MODEL_NODES = 1 << 14, 1 << 20
# Rows in a part of the table that models score; its tasks' work hangs on rows, not on bytes.
SCORE_PART_ROWS = 5_000

# Search spaces of the two tuned models.
FOREST_SPACE = {
    "model__n_estimators": [300, 500, 800],
    "model__max_depth": [None, 8, 12, 20],
    "model__min_samples_leaf": [2, 5, 10, 20],
    "model__max_features": ["sqrt", 0.5, None],
}
BOOSTER_SPACE = {
    "model__max_iter": [200, 400, 600],
    "model__learning_rate": [0.03, 0.05, 0.1],
    "model__max_leaf_nodes": [15, 31, 63],
    "model__min_samples_leaf": [10, 20, 50],
    "model__l2_regularization": [0.0, 0.1, 1.0],
}
SEARCH_SPACES = {"random_forest": FOREST_SPACE, "hist_gradient_boosting": BOOSTER_SPACE}
# Default settings of the two models.
DEFAULTS = {
    "random_forest": {"model__n_estimators": 300, "model__min_samples_leaf": 5, "model__max_depth": None,
                      "model__max_features": "sqrt"},
    "hist_gradient_boosting": {"model__max_iter": 500, "model__learning_rate": 0.05, "model__max_leaf_nodes": 31,
                               "model__min_samples_leaf": 20, "model__l2_regularization": 0.0},
}


def build_search_spaces() -> dict[str, dict[str, list]]:
    return {k: {p: list(v) for p, v in space.items()} for k, space in SEARCH_SPACES.items()}


def sample_configs(space: dict[str, list], n: int, seed: int = SEED) -> list[dict]:
    """``n`` distinct configurations of the grid.

    The first ``n`` places of a seeded Mersenne-Twister permutation of the grid,
    whose keys are sorted, the last one running fastest. This is the draw behind
    the published search.
    """
    keys = sorted(space)
    grid = [dict(zip(keys, values, strict=True)) for values in itertools.product(*[space[k] for k in keys])]
    return [grid[i] for i in np.random.RandomState(seed).permutation(len(grid))[:n]]


def with_class_weights(train: DataFrame, label: str = LABEL, weight: str = WEIGHT) -> DataFrame:
    """Balanced weights ``n / (2 * n_class)`` from one aggregate on the training rows (M9)."""
    counts = train.agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col(label)).alias("_pos")
    )
    w = F.when(
        F.col(label) == 1, F.col("_n") / (2 * F.col("_pos"))
    ).otherwise(F.col("_n") / (2 * (F.col("_n") - F.col("_pos"))))
    return attach_one_row(train, counts).withColumn(weight, w.cast("double")).drop("_n", "_pos")


@dataclass
class PriorModel:
    """Constant probability equal to the training positive rate (M6)."""

    rate: float

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("p", F.lit(self.rate)).withColumn("margin", F.lit(self.rate))


def fit_prior(train: DataFrame, label: str = LABEL) -> PriorModel:
    return PriorModel(float(train.agg(F.avg(label)).first()[0]))


def validation_flag(train: DataFrame, fraction: float = 0.1, rank_col: str = "rank") -> DataFrame:
    """Latest ``fraction`` of the (time-ranked) training rows marked for early stopping."""
    bounds = train.agg(F.min(rank_col).alias("_lo"), F.max(rank_col).alias("_hi"))
    cut = F.col("_lo") + (F.col("_hi") - F.col("_lo") + 1) * (1 - fraction)
    return attach_one_row(train, bounds).withColumn(VALIDATION, F.col(rank_col) >= cut).drop("_lo", "_hi")


# ---------------------------------------------------------------- fitted models


@dataclass
class TreeModel:
    """Preprocessing, bins and trees: ``p`` and ``margin`` of any rows with the feature columns.

    A booster's margin is its raw score, a forest's its probability.
    """

    encoder: Encoder
    bins: Bins
    trees: Trees | Booster

    def scores(self) -> Column:
        """Struct of ``p`` and ``margin`` from the untouched feature columns, in batches."""
        encoder, bins, trees = self.encoder, self.bins, self.trees

        def score(*columns: pd.Series) -> pd.DataFrame:
            x = bins.apply(encoder.encode(columns))
            margin = trees.margin(x)
            return pd.DataFrame({"p": trees.chance(margin), "margin": margin})

        return F.pandas_udf(score, "p double, margin double")(*Encoder.columns())


def joint_scores(models: Sequence[TreeModel]) -> Column:
    """Array of the models' ``p`` from the untouched feature columns; models of the same rows share its encoder and bins, so a row is encoded once."""
    encoder, bins = models[0].encoder, models[0].bins
    if any(m.encoder is not encoder or m.bins is not bins for m in models):
        raise ValueError("the models have different encoders or bins")
    trees = [m.trees for m in models]

    def score(*columns: pd.Series) -> pd.DataFrame:
        x = bins.apply(encoder.encode(columns))
        return pd.DataFrame({f"p{k}": t.chance(t.margin(x)) for k, t in enumerate(trees)})

    names = [f"p{k}" for k in range(len(trees))]
    scored = F.pandas_udf(score, ", ".join(f"{n} double" for n in names))(*Encoder.columns())
    return F.array(*[scored[n] for n in names])


@dataclass
class FittedModel:
    name: str
    params: dict
    model: TreeModel | StoredForest | PriorModel
    extra: dict = field(default_factory=dict)

    def score(self, df: DataFrame) -> DataFrame:
        """Adds ``p`` (positive-class probability) and ``margin`` (calibration input)."""
        if isinstance(self.model, PriorModel | StoredForest):
            return self.model.transform(df)
        scored = df.withColumn("_scored", self.model.scores())
        return scored.select(*[F.col(f"`{c}`") for c in df.columns if c not in ("p", "margin")], "_scored.p", "_scored.margin")


# ---------------------------------------------------------------- fits

@dataclass
class Prepared:
    """Preprocessing and bins fitted on all training rows, and these rows binned, in blocks in the order of their ranks.

    They depend on the training rows alone, so all settings of a search share them.
    """

    encoder: Encoder
    cuts: list[np.ndarray]  # of all features; a booster takes categories as numbers
    blocks: DataFrame  # block, y, bins (as a forest has them)
    shape: Shape

    def bins(self, name: str) -> Bins:
        n_cat = len(CATEGORICAL_FEATURES) if name == "random_forest" else 0
        return Bins(self.cuts[: len(self.cuts) - n_cat], n_cat)

    def local(self) -> tuple[bytes, bytes]:
        """All rows and labels, column by column; for a bounded number of rows (``growing.TASK_ROWS``)."""
        got = self.blocks.orderBy("block").collect()
        x = np.concatenate([self.shape.unpacked(r["bins"]) for r in got]) if got else np.zeros((0, len(self.cuts)))
        return packed_rows(x, self.shape.forest.sizes), b"".join(r["y"] for r in got)


def prepared(train: DataFrame) -> Prepared:
    """Fit the preprocessing and the bins on ``train`` and write all of its rows as blocks, latest rows last."""
    encoder = Encoder.fit(train)
    cuts = feature_cuts(train, encoder)
    n_cat = len(CATEGORICAL_FEATURES)
    bins = Bins(cuts[: len(cuts) - n_cat], n_cat)
    columns = Columns(tuple([len(c) + 1 for c in bins.cuts] + [len(c) + 1 for c in encoder.codes]), n_cat)
    if "rank" not in train.columns:
        train = exact_rank(train, "order_id", "order_id")
    rows = train.select((F.col("rank") / BLOCK_ROWS).cast("long").alias("_block"), F.col("rank").alias("_rank"),
                        F.col(LABEL).cast("long").alias("_y"), *Encoder.columns())

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("_rank")
        x, y = bins.apply(encoder.encode([table.column(c).to_pandas() for c in FEATURES])), table.column("_y").to_numpy()
        return pa.table({"block": table.column("_block")[:1], "n": pa.array([len(y)], pa.int64()), "late": pa.array([int(y.sum())], pa.int64()),
                         "y": pa.array([y.astype(np.uint8).tobytes()], pa.binary()), "bins": pa.array([packed_rows(x, columns.sizes)], pa.binary())})

    # as many parts as later passes want, which AQE would join by their bytes
    n_blocks, cores = -(-train.count() // BLOCK_ROWS), train.sparkSession.sparkContext.defaultParallelism
    rows = rows.repartition(max(1, min(n_blocks, max(2 * cores, n_blocks // 64))), "_block")
    blocks = materialize(rows.groupBy("_block").applyInArrow(pack, "block long, n long, late long, y binary, bins binary"))
    # bounded: a row a block
    counts = sorted(blocks.select("block", "n", "late").collect())
    if [c["block"] for c in counts] != list(range(len(counts))):
        place = {c["block"]: k for k, c in enumerate(counts)}
        blocks = blocks.withColumn("block", F.create_map(*[F.lit(x) for pair in place.items() for x in pair])[F.col("block")].cast("long"))
    codes = [np.searchsorted(cut, np.arange(-1, size), side="left") for cut, size in zip(cuts[len(cuts) - n_cat :], map(len, encoder.codes), strict=True)]
    sizes = tuple(c["n"] for c in counts)
    shape = Shape(sizes, sum(c["late"] for c in counts), held_rows(sum(sizes)), columns, tuple(len(c) + 1 for c in cuts), tuple(codes))
    return Prepared(encoder, cuts, blocks.select("block", "y", "bins"), shape)


@dataclass(frozen=True)
class Fit:
    """One model to fit: the place of its training rows in the list given to ``fit_all``."""

    name: str
    data: int
    params: dict
    seed: int = SEED


def balanced(y: np.ndarray) -> np.ndarray:
    """Class weights ``n / (2 * n_class)`` of each row (M9)."""
    late = max(int(y.sum()), 1), max(int(len(y) - y.sum()), 1)
    return np.where(y == 1, len(y) / (2 * late[0]), len(y) / (2 * late[1]))


def fit_all(spark, fits: Sequence[Fit], data: Sequence[Prepared]) -> list[FittedModel]:
    """Fit all models side by side. Boosters, whose trees have few leaves, and forests up to ``MODEL_NODES`` nodes come to the driver."""
    binned = {(f.name, f.data): data[f.data].bins(f.name) for f in fits}
    grown = grow_all(spark, fits, data)
    # bounded: a row a tree
    nodes: dict[int, dict[int, int]] = {}
    for r in grown.select("fit", "tree", "nodes").collect():
        nodes.setdefault(r["fit"], {})[r["tree"]] = r["nodes"]
    out = []
    for k, fit in enumerate(fits):
        encoder, bins, own = data[fit.data].encoder, binned[fit.name, fit.data], grown.where(F.col("fit") == k)
        if fit.name == "random_forest" and sum(nodes[k].values()) > MODEL_NODES:
            out.append(FittedModel(fit.name, fit.params, StoredForest(encoder, bins, data[fit.data].shape.forest, own, nodes[k])))
            continue
        trees = [unpickled(r["payload"]) for r in own.orderBy("tree").select("payload").collect()]
        out.append(FittedModel(fit.name, fit.params, TreeModel(encoder, bins, Trees.join(trees) if fit.name == "random_forest" else trees[0])))
    return out


def fit_model(
    name: str, train: DataFrame, params: dict | None = None, seed: int = SEED, ready: Prepared | None = None
) -> FittedModel:
    """Fit one of ``dummy_baseline``, ``random_forest``, ``hist_gradient_boosting`` on (ranked) train rows.

    ``ready`` is what ``prepared`` made of these rows, if it is there already.
    """
    if name == "dummy_baseline":
        return FittedModel(name, {}, fit_prior(train))
    return fit_all(train.sparkSession, [Fit(name, 0, settings(name, params), seed)], [ready or prepared(train)])[0]


def settings(name: str, params: dict | None = None) -> dict:
    if name not in DEFAULTS:
        raise ValueError(f"unknown model {name!r}")
    return dict(DEFAULTS[name], **(params or {}))
