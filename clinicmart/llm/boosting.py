"""Gradient-boosted trees over a bounded table of numbers, and their calibration."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Tree:
    """A tree of fixed depth as arrays: node i has the children 2i+1 and 2i+2."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        node = np.zeros(len(rows), np.int64)
        inner = len(self.feature)
        while inner and node.min() < inner:
            at = rows[np.arange(len(rows)), self.feature[node]]
            node = 2 * node + 1 + (at > self.cut[node])
        return self.value[node - inner]


@dataclass
class Boosted:
    """Logistic loss, trees of second-order gains, probabilities by Platt scaling."""

    trees: list[Tree] = field(default_factory=list)
    base: float = 0.0
    rate: float = 0.2
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.base)
        for tree in self.trees:
            out += self.rate * tree.score(rows)
        return out

    def probability(self, rows: np.ndarray) -> np.ndarray:
        if not len(rows):
            return np.empty(0)
        return _sigmoid(self.slope * self.margin(rows) + self.offset)

    def calibrate(self, rows: np.ndarray, labels: np.ndarray, steps: int = 50) -> None:
        """Fit slope and offset of the margins on rows the trees have not seen."""
        x = np.stack([self.margin(rows), np.ones(len(rows))], 1)
        target = (labels * (labels.sum() + 1) / (labels.sum() + 2)) + (1 - labels) / (
            (1 - labels).sum() + 2
        )
        weight = np.array([1.0, 0.0])
        for _ in range(steps):
            p = _sigmoid(x @ weight)
            slope = x.T @ (p - target) + 1e-3 * (weight - [1, 0])
            bend = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
            weight = weight - np.linalg.solve(bend, slope)
        self.slope, self.offset = float(weight[0]), float(weight[1])


def fit(
    rows: np.ndarray, labels: np.ndarray, rounds: int = 40, depth: int = 3, ridge: float = 1.0
) -> Boosted:
    """Fit trees; cuts are tried at up to 32 quantiles of each feature."""
    mean = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    model = Boosted(base=float(np.log(mean / (1 - mean))))
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, 33)[1:-1])) for column in rows.T]
    bins = np.stack([np.searchsorted(c, column) for c, column in zip(cuts, rows.T)], 1)
    margin = np.full(len(rows), model.base)
    for _ in range(rounds):
        p = _sigmoid(margin)
        tree = _grow(bins, cuts, p - labels, p * (1 - p), depth, ridge)
        model.trees.append(tree)
        margin += model.rate * tree.score(rows)
    return model


def _grow(
    bins: np.ndarray, cuts: list[np.ndarray], slope: np.ndarray, bend: np.ndarray, depth: int, ridge: float
) -> Tree:
    inner = (1 << depth) - 1
    feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
    node = np.zeros(len(bins), np.int64)
    for at in range(inner):
        here = np.flatnonzero(node == at)
        best = 0.0
        split = None
        g, h = slope[here], bend[here]
        whole = g.sum() ** 2 / (h.sum() + ridge)
        for k, values in enumerate(cuts):
            if not len(values) or not len(here):
                continue
            left_g = np.cumsum(np.bincount(bins[here, k], g, len(values) + 1))[:-1]
            left_h = np.cumsum(np.bincount(bins[here, k], h, len(values) + 1))[:-1]
            gain = left_g**2 / (left_h + ridge)
            gain += (g.sum() - left_g) ** 2 / (h.sum() - left_h + ridge) - whole
            j = int(gain.argmax())
            if gain[j] > best + 1e-9:
                best, split = gain[j], (k, j)
        if split:
            feature[at], cut[at] = split[0], cuts[split[0]][split[1]]
            node[here] = 2 * at + 1 + (bins[here, split[0]] > split[1])
        else:
            node[here] = 2 * at + 1
    leaf = node - inner
    sums = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, bend, inner + 1)
    return Tree(feature, cut, -sums[0] / (sums[1] + ridge))


#: Bins per feature: up to 31 distinct quantile cuts leave 32.
BINS = 32


def _quantiles(values: np.ndarray, counts: np.ndarray, qs: np.ndarray) -> np.ndarray:
    """``np.quantile`` of ``values`` repeated ``counts`` times, without repeating them."""
    order = np.argsort(values, kind="stable")
    values, ends = values[order], np.cumsum(counts[order])
    pos = qs * (ends[-1] - 1)
    low = np.floor(pos)
    at = lambda i: values[np.searchsorted(ends, i, side="right")]
    a, b, t = at(low), at(np.minimum(low + 1, ends[-1] - 1)), pos - low
    return np.where(t >= 0.5, b - (b - a) * (1 - t), a + (b - a) * t)


def _partial_sums(df, width: int, compute) -> np.ndarray:
    """Sum of ``compute(batch)`` (an array of ``width`` numbers) over all batches, partition by partition."""
    import pyarrow as pa

    def each(batches):
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += compute(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["s"])

    parts = df.mapInArrow(each, "s array<double>").collect()
    return np.sum([np.array(r["s"]) for r in parts], 0) if parts else np.zeros(width)


def fit_table(
    table, width: int, rounds: int = 40, depth: int = 3, ridge: float = 1.0
) -> Boosted | None:
    """:func:`fit` on every row of a Spark table ``(features array<double>, label int, weight long)``.

    A row stands for ``weight`` copies. Cuts are exact quantiles of all rows, from each feature's
    counted values; each level of a tree is grown from sums of slopes and bends per node, feature
    and bin, added up over partitions. Rows with the same bins and label meet as one. Without
    rows, None.
    """
    import pyarrow as pa
    from pyspark.sql import functions as F

    from clinicmart.llm.common import saved

    rows = table.filter("weight > 0")
    counted = (
        rows.select(F.posexplode("features").alias("k", "v"), "weight")
        .groupBy("k", "v")
        .agg(F.sum("weight").alias("n"))
        .collect()
    )
    if not counted:
        return None
    qs = np.linspace(0, 1, 33)[1:-1]
    cuts = []
    for k in range(width):
        mine = [(r["v"], r["n"]) for r in counted if r["k"] == k]
        values, counts = np.array([v for v, _ in mine], float), np.array([n for _, n in mine], np.int64)
        cuts.append(np.unique(_quantiles(values, counts, qs)) if len(mine) else np.empty(0))

    def binned(batches):
        for batch in batches:
            table = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            bins = np.stack([np.searchsorted(c, column) for c, column in zip(cuts, table.T)], 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(bins), pa.list_(pa.int32())), batch.column("label"), batch.column("weight")],
                ["bins", "label", "weight"],
            )

    grouped = rows.select("features", "label", "weight").mapInArrow(
        binned, "bins array<int>, label int, weight bigint"
    ).groupBy("bins", "label").agg(F.sum("weight").alias("weight"))
    binned_rows = saved(grouped, "boosting-bins")
    ones, total = (
        binned_rows.agg(F.sum(F.col("label") * F.col("weight")), F.sum("weight")).first()
    )
    mean = np.clip(ones / total, 1e-3, 1 - 1e-3)
    model = Boosted(base=float(np.log(mean / (1 - mean))))
    in_bins: list[Tree] = []
    inner = (1 << depth) - 1

    for _ in range(rounds):
        feature, cut, cut_bin = np.zeros(inner, np.int64), np.full(inner, np.inf), np.full(inner, np.inf)
        value = np.zeros(inner + 1)
        for level in range(depth):
            nodes, first = 1 << level, (1 << level) - 1
            grown, base, rate = list(in_bins), model.base, model.rate
            so_far = Tree(feature.copy(), cut_bin.copy(), value)

            def sums(batch, grown=grown, so_far=so_far, level=level, nodes=nodes, first=first, base=base, rate=rate):
                bins = batch.column("bins").flatten().to_numpy().reshape(-1, width)
                y = batch.column("label").to_numpy().astype(float)
                w = batch.column("weight").to_numpy().astype(float)
                margin = np.full(len(y), base)
                for tree in grown:
                    margin += rate * tree.score(bins)
                p = _sigmoid(margin)
                node = np.zeros(len(y), np.int64)
                for _ in range(level):
                    node = 2 * node + 1 + (bins[np.arange(len(y)), so_far.feature[node]] > so_far.cut[node])
                at = (node - first) * BINS
                out = np.zeros((2, nodes, width, BINS))
                for k in range(width):
                    for s, x in enumerate(((p - y) * w, p * (1 - p) * w)):
                        out[s, :, k, :] += np.bincount(at + bins[:, k], x, nodes * BINS).reshape(nodes, BINS)
                return out.ravel()

            g, h = _partial_sums(binned_rows, 2 * nodes * width * BINS, sums).reshape(2, nodes, width, BINS)
            for i in range(nodes):
                at = first + i
                whole_g, whole_h = g[i, 0].sum(), h[i, 0].sum()
                whole = whole_g**2 / (whole_h + ridge)
                best, split = 0.0, None
                for k, values in enumerate(cuts):
                    if not len(values):
                        continue
                    left_g = np.cumsum(g[i, k, : len(values) + 1])[:-1]
                    left_h = np.cumsum(h[i, k, : len(values) + 1])[:-1]
                    gain = left_g**2 / (left_h + ridge) + (whole_g - left_g) ** 2 / (whole_h - left_h + ridge) - whole
                    j = int(gain.argmax())
                    if gain[j] > best + 1e-9:
                        best, split = gain[j], (k, j)
                if split:
                    feature[at], cut[at], cut_bin[at] = split[0], cuts[split[0]][split[1]], split[1]
                    left = (np.cumsum(g[i, split[0]])[split[1]], np.cumsum(h[i, split[0]])[split[1]])
                else:
                    left = (whole_g, whole_h)
                if level == depth - 1:
                    leaf = 2 * at + 1 - inner
                    value[leaf] = -left[0] / (left[1] + ridge)
                    value[leaf + 1] = -(whole_g - left[0]) / (whole_h - left[1] + ridge)
        model.trees.append(Tree(feature, cut, value))
        in_bins.append(Tree(feature, cut_bin, value))
    return model


def calibrate_table(model: Boosted, margins, steps: int = 50) -> None:
    """:meth:`Boosted.calibrate` on a Spark table ``(margin double, label int, weight long)``.

    Each Newton step adds up its slope and bend over the partitions; it stops early once a step
    no longer moves the weights.
    """
    ones, zeros = _partial_sums(
        margins,
        2,
        lambda b: np.array(
            [
                (b.column("label").to_numpy() * b.column("weight").to_numpy()).sum(),
                ((1 - b.column("label").to_numpy()) * b.column("weight").to_numpy()).sum(),
            ],
            float,
        ),
    )
    weight = np.array([1.0, 0.0])
    for _ in range(steps):

        def sums(b, weight=weight):
            labels = b.column("label").to_numpy().astype(float)
            w = b.column("weight").to_numpy().astype(float)
            x = np.stack([b.column("margin").to_numpy(), np.ones(len(w))], 1)
            target = labels * (ones + 1) / (ones + 2) + (1 - labels) / (zeros + 2)
            p = _sigmoid(x @ weight)
            return np.concatenate([x.T @ ((p - target) * w), ((x * (p * (1 - p) * w)[:, None]).T @ x).ravel()])

        s = _partial_sums(margins, 6, sums)
        slope = s[:2] + 1e-3 * (weight - [1, 0])
        bend = s[2:].reshape(2, 2) + 1e-3 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        weight = weight - step
        if np.abs(step).max() <= 1e-12 * (1 + np.abs(weight).max()):
            break
    model.slope, model.offset = float(weight[0]), float(weight[1])
