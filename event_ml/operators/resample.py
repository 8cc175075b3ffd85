"""Resampling studies: stratified bootstrap CI of the AUC, stability under
training-set perturbation, grouped mean/std.

Bootstrap at scale: a replicate draws, for each class on its own, as many rows
as the class has, with replacement.  The data is reduced once to (score, pos,
neg) with running counts, so a score's rows are a range of its class's rows in
order of score, and all that a replicate needs is how many of its draws lie
below each end of that range.

Those numbers come from a fixed binary tree over the class's rows: at a node,
the draws that reach it are split between its halves by a binomial draw, and
at a leaf of ``LEAF`` rows each draw picks a row.  Every node has its own seed
(replicates' seed, class, level, place), so any task can draw the part of the
tree that holds its own ends; a row's count is the same in all of them, and
class sizes are kept exactly.  Replicates don't depend on the partitioning.
No row is replicated, and a task's memory is bounded by replicates x scores of
one step.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from event_ml.functions.prefix import ordered_prefix
from event_ml.operators import metrics as m
from event_ml.operators.splits import TWO32, hash_sample, key_hash

# The map functions below run in Python workers; ship them by value so
# executors need not have this package installed or on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a leaf of the tree, as a power of two.
LEAF_BITS = 10
#: Scores of one step of a task.
STEP = 1024


class DrawTree:
    """Multinomial draws of ``n_boot`` replicates over ``n`` equally likely rows,
    ``n`` draws each, of which only what is asked for is drawn."""

    def __init__(self, seed: int, label: int, n: int, n_boot: int):
        self.seed, self.label, self.n, self.n_boot = seed, label, n, n_boot
        self.levels = max(0, (n - 1).bit_length() - LEAF_BITS)
        self.splits: dict = {}
        self.leaves: dict = {}

    def _random(self, level: int, place: int) -> np.random.Generator:
        return np.random.Generator(np.random.SFC64([self.seed, self.label, level, place]))

    @staticmethod
    def _once(kept: dict, most: int, name, make):
        """``make()``'s value; ``kept`` holds the ``most`` latest."""
        if name not in kept:
            if len(kept) >= most:
                del kept[next(iter(kept))]
            kept[name] = make()
        return kept[name]

    def _left(self, level: int, place: int, draws: np.ndarray) -> np.ndarray:
        """How many of a node's draws go to its left half.  Its rows are those
        from ``place`` times its width on."""
        width = 1 << (level + LEAF_BITS)
        low = place * width
        rows = min(width, self.n - low)
        half = width >> 1
        if rows <= half:
            return draws
        return self._once(self.splits, 256, (level, place), lambda: self._random(level, place).binomial(draws, half / rows))

    def _leaf(self, place: int, draws: np.ndarray) -> np.ndarray:
        """(replicate, row) counts of draws below each row of a leaf, and below its end."""

        def make() -> np.ndarray:
            rows = min(1 << LEAF_BITS, self.n - (place << LEAF_BITS))
            picked = self._random(0, place).integers(0, rows, int(draws.sum()))
            picked += np.repeat(np.arange(self.n_boot) * (rows + 1) + 1, draws)
            counts = np.bincount(picked, minlength=self.n_boot * (rows + 1)).reshape(self.n_boot, rows + 1)
            return counts.cumsum(1, dtype=np.int32)

        return self._once(self.leaves, 4, place, make)

    def below(self, ends: np.ndarray) -> np.ndarray:
        """(replicate, end): draws of rows before ``ends`` (ascending, 0 to n)."""
        out = np.zeros((self.n_boot, len(ends)), np.int64)
        out[:, np.searchsorted(ends, self.n) :] = self.n
        todo = [(self.levels, 0, np.full(self.n_boot, self.n, np.int64), np.zeros(self.n_boot, np.int64))]
        while todo:
            level, place, draws, before = todo.pop()
            width = 1 << (level + LEAF_BITS)
            if place * width >= self.n:
                continue
            # ends inside the node; at its beginning they need no draw of it
            a, b = np.searchsorted(ends, [place * width, min((place + 1) * width, self.n)])
            first = a + np.searchsorted(ends[a:b], place * width, "right")
            out[:, a:first] = before[:, None]
            if first == b:
                continue
            if level == 0:
                out[:, first:b] = before[:, None] + self._leaf(place, draws)[:, ends[first:b] - place * width]
                continue
            left = self._left(level, place, draws)
            todo.append((level - 1, 2 * place + 1, draws - left, before + left))
            todo.append((level - 1, 2 * place, left, before))
        return out


def _terms_fn(seed: int, n_boot: int):
    """Per task: one row a replicate with its AUC sum and its draws of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        term, drawn = np.zeros(n_boot), np.zeros((2, n_boot), np.int64)
        trees: list[DrawTree] = []
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not trees and len(columns[0]):
                trees = [DrawTree(seed, label, int(columns[2 + label][0]), n_boot) for label in (0, 1)]
            order = np.argsort(columns[0] + columns[1], kind="stable")
            for label, tree in enumerate(trees):
                # rows next to each other share an end: only the ends of their runs are needed
                upto, count = columns[label][order], columns[4 + label][order]
                new = np.append(True, upto[1:] - count[1:] != upto[:-1])[: len(order)]
                ends = np.concatenate([(upto - count)[new], upto[np.append(new[1:], True)[: len(order)]]])
                for at in range(0, len(ends) // 2, STEP):
                    first, last = (x[at : at + STEP] for x in np.split(ends, 2))
                    drawn[label] += (tree.below(last) - tree.below(first)).sum(1)
            own = order[columns[5][order] > 0]  # a score without positives adds nothing to the sum
            for at in range(0, len(own), STEP):
                sides = []
                for label, tree in enumerate(trees):
                    upto, count = (columns[i + label][own[at : at + STEP]] for i in (0, 4))
                    ends, places = np.unique(np.concatenate([upto - count, upto]), return_inverse=True)
                    below = tree.below(ends)
                    sides.append((below[:, places[: len(upto)]], below[:, places[len(upto) :]]))
                (neg_from, neg_to), (pos_from, pos_to) = sides
                term += np.einsum("ij,ij->i", pos_to - pos_from, neg_from + neg_to, dtype=float) / 2
        if trees:
            values = [pa.array(np.arange(n_boot)), pa.array(term), pa.array(drawn[1]), pa.array(drawn[0])]
            yield pa.RecordBatch.from_arrays(values, ["replicate", "term", "pos", "neg"])

    return run


def bootstrap_auc(
    pred: DataFrame,
    score_col: str,
    label_col: str,
    n_boot: int = 500,
    seed: int = 42,
    n_blocks: int | None = None,
) -> DataFrame:
    """(replicate, auc, n_pos, n_neg) of ``n_boot`` stratified bootstrap replicates;
    n_pos and n_neg, the rows drawn, are the classes' own sizes.  Without a row
    of one class the auc is null; an empty table has no replicates."""
    hist = m.score_table(pred, score_col, label_col)
    r = ordered_prefix(hist, "score", ["neg", "pos"], n_blocks=n_blocks, totals=True)
    r = r.select("neg_cum", "pos_cum", "neg_total", "pos_total", "neg", "pos")
    terms = r.mapInArrow(_terms_fn(seed, n_boot), "replicate long, term double, pos long, neg long")
    agg = terms.groupBy("replicate").agg(F.sum("term").alias("num"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    pairs = F.col("n_pos").cast("double") * F.col("n_neg")
    return agg.select("replicate", F.when(pairs > 0, F.col("num") / pairs).alias("auc"), "n_pos", "n_neg")


def bootstrap_ci(replicates: DataFrame, ci: float = 0.95) -> DataFrame:
    """(n_replicates, mean, ci_low, ci_high): percentile interval with
    linear interpolation (same definition as numpy.percentile)."""
    alpha = (1 - ci) / 2
    return replicates.agg(
        F.count(F.lit(1)).alias("n_replicates"),
        F.avg("auc").alias("mean"),
        F.percentile("auc", alpha).alias("ci_low"),
        F.percentile("auc", 1 - alpha).alias("ci_high"),
    )


def group_mean_std(df: DataFrame, group_col: str, value_col: str, z: float = 1.96, digits: int = 9) -> DataFrame:
    """(group, n, mean, std (ddof 1), band_low, band_high) with band = mean -+ z std."""
    g = df.groupBy(F.col(group_col).alias("grp")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value_col).alias("mean"), F.stddev_samp(value_col).alias("std")
    )
    return g.select(
        "grp",
        "n",
        F.round("mean", digits).alias("mean"),
        F.round("std", digits).alias("std"),
        F.round(F.col("mean") - z * F.col("std"), digits).alias("band_low"),
        F.round(F.col("mean") + z * F.col("std"), digits).alias("band_high"),
    )


def stability(
    train: DataFrame,
    test: DataFrame,
    key: str,
    fit_fn,
    levels: Sequence[float] = (0.05, 0.10, 0.20),
    trials: int = 3,
    parallelism: int = 4,
) -> DataFrame:
    """Refit on train with a fraction removed (deterministic hash sample,
    salt = trial * 100): (perturbation_pct, trial, n_removed, removed_keys,
    test_auc) per refit.

    ``removed_keys`` adds the keys' 32-bit hashes, so a trial's removed rows can
    be told from another's.  ``fit_fn(train_subset)`` returns a fitted model;
    up to ``parallelism`` refits are submitted at once from driver threads,
    which fills the cluster when single fits are too small to use it.  The
    scores of all refits are one long table, evaluated once.
    """
    from concurrent.futures import ThreadPoolExecutor

    from event_ml.operators.models import ranked_together

    jobs = [(int(round(frac * 100)), frac, trial) for frac in levels for trial in range(trials)]
    salt = lambda trial: f"stab{trial * 100}"
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        models = list(pool.map(lambda job: fit_fn(hash_sample(train, key, 1.0 - job[1], salt=salt(job[2]))), jobs))
    scored = [({"perturbation_pct": pct, "trial": trial}, model.transform(test)) for (pct, _, trial), model in zip(jobs, models, strict=True)]
    aucs = ranked_together(scored)
    # one pass over train counts what every trial removed
    gone = [(pct, trial, key_hash(key, salt(trial)) >= int(round((1.0 - frac) * TWO32))) for pct, frac, trial in jobs]
    items = [
        F.struct(F.lit(pct).alias("perturbation_pct"), F.lit(trial).alias("trial"), F.count_if(out).alias("n_removed"), F.coalesce(F.sum(F.when(out, key_hash(key))), F.lit(0)).alias("removed_keys"))
        for pct, trial, out in gone
    ]
    removed = train.agg(F.array(*items).alias("r")).select(F.explode("r").alias("r")).select("r.*")
    # a row a refit
    return F.broadcast(removed).join(aucs, ["perturbation_pct", "trial"]).select(
        "perturbation_pct", "trial", "n_removed", "removed_keys", F.col("auc").alias("test_auc")
    )
