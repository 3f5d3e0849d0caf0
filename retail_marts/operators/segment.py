"""Customer segmentation: features (C1), quantile scores (C2), scaling (C3),
k-means fit (C4), choice of k (C5), assignment and profile (C6).

The reference names clustering but no algorithm and no features; recency,
frequency and monetary value per customer is our choice.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_marts.functions.columns import MONEY, ratio, to_day
from retail_marts.operators.ranking import global_row_number, ntile_of

FEATURES = ["recency", "frequency", "monetary"]
Z = T.DecimalType(18, 6)


# C1 ----------------------------------------------------------------------------

def customer_features(orders: DataFrame, as_of: str) -> DataFrame:
    """Per customer: recency (days from the last order to ``as_of``),
    frequency (orders) and monetary (sum of order values, exact).

    ``orders``: order_id, customer_id, order_value, ordered_at. One partial +
    final aggregate; orders without a customer are left out.
    """
    return (orders.filter(F.col("customer_id").isNotNull())
                  .groupBy("customer_id")
                  .agg(F.max(to_day("ordered_at")).alias("_last"),
                       F.count(F.lit(1)).alias("frequency"),
                       F.sum(F.col("order_value").cast(MONEY)).cast(MONEY).alias("monetary"))
                  .select("customer_id",
                          F.datediff(F.to_date(F.lit(as_of)), F.col("_last")).cast("int").alias("recency"),
                          F.col("frequency").cast("bigint"), "monetary"))


def default_as_of(orders: DataFrame) -> str:
    """The day after the last order (one scalar from a partial + final max); 1970-01-01 without orders."""
    last = orders.agg(F.max(to_day("ordered_at")).alias("m")).first()["m"]
    if last is None:
        return "1970-01-01"
    return (last + __import__("datetime").timedelta(days=1)).isoformat()


# C2 ----------------------------------------------------------------------------

def score(df: DataFrame, col: str, key: str, n: int = 5, descending: bool = False,
          out: str | None = None, **kw) -> DataFrame:
    """Add ``out`` (default ``<col>_score``) = ``ntile(n)`` over (``col``,
    ``key``), computed without a one-partition window (``ranking``).
    ``descending`` orders the value high to low (the key stays ascending),
    e.g. recency, where fewer days is better."""
    out = out or f"{col}_score"
    tmp = "_ord"
    base = df.withColumn(tmp, -F.col(col) if descending else F.col(col))
    ranked, total = global_row_number(base, [tmp, key], "_rank", **kw)
    return ranked.withColumn(out, ntile_of(F.col("_rank"), total, n)).drop("_rank", tmp)


# C3 ----------------------------------------------------------------------------

def scale(df: DataFrame, cols: list[str], out: str = "z") -> tuple[DataFrame, PipelineModel]:
    """Zero mean, unit (sample, n - 1) standard deviation; a constant column
    becomes 0. Returns the frame with vector column ``out`` and the fitted
    model, to apply the same scaling to other rows."""
    pipe = Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="_raw", handleInvalid="error"),
                            StandardScaler(inputCol="_raw", outputCol=out, withMean=True, withStd=True)])
    model = pipe.fit(df)
    return model.transform(df).drop("_raw"), model


def z_columns(df: DataFrame, cols: list[str], vec: str = "z") -> DataFrame:
    """Unpack the scaled vector into ``z_<col>`` decimal(18,6) columns."""
    arr = vector_to_array(F.col(vec))
    return df.select(*[c for c in df.columns if c != vec],
                     *[F.round(arr[i], 6).cast(Z).alias(f"z_{c}") for i, c in enumerate(cols)])


# C4 ----------------------------------------------------------------------------

EXACT = T.DecimalType(18, 4)     # features enter with four decimals
MICRO = 1_000_000                # scaled features are whole millionths of a standard deviation


@dataclass(frozen=True)
class Scaling:
    """Mean and standard deviation (n - 1) per column, from exact sums."""

    cols: tuple[str, ...]
    n: int
    mean: tuple[float, ...]
    sd: tuple[float, ...]

    def units(self, col: str) -> Column:
        """``col`` scaled, in whole millionths (long); a constant column is 0."""
        i = self.cols.index(col)
        if self.sd[i] == 0:
            return F.when(F.col(col).isNotNull(), F.lit(0).cast("bigint"))
        z = (F.col(col).cast(EXACT).cast("double") - F.lit(self.mean[i])) / F.lit(self.sd[i])
        return F.floor(z * F.lit(float(MICRO))).cast("bigint")


@dataclass
class Segments:
    scaling: Scaling
    centres: list[list[int]]      # in millionths, in seeding order
    order: list[int]              # centre -> segment number (0 = highest mean of ``rank_by``)
    k: int

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``segment``: 0 is the segment with the highest mean monetary value; null
        where a feature is null."""
        if not self.centres:
            return df.withColumn("segment", F.lit(None).cast("int"))
        zs = [self.scaling.units(c) for c in self.scaling.cols]
        known = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in self.scaling.cols])
        near = _nearest(zs, _model(self.k, self.centres)["centres"])["j"]
        return df.withColumn("segment", F.when(known, F.array(*[F.lit(s) for s in self.order])[near]).cast("int"))


def _model(k: int, centres: list[list[int]], stats: dict | None = None) -> Column:
    """One model as a literal: k, its centres and, once known, each cluster's count, sums and sum of squares."""
    cs = F.array(*[F.struct(F.lit(j).alias("j"), F.array(*[F.lit(v).cast("bigint") for v in c]).alias("at")) for j, c in enumerate(centres)])
    gs = F.array(*[F.struct(F.lit(j).alias("j"), F.lit(float(r["n"])).alias("n"),
                            F.array(*[F.lit(float(int(r[f"s{i}"]))) for i in range(len(centres[0]))]).alias("sum"),
                            F.lit(float(int(r["squares"]))).alias("squares")) for j, r in sorted((stats or {}).items())])
    return F.struct(F.lit(k).alias("k"), cs.alias("centres"), *([gs.alias("clusters")] if stats else []))


def _nearest(zs: list[Column], centres: Column) -> Column:
    """(d, j): squared distance (double, terms added in column order) to the nearest centre and its number;
    a tie goes to the lower one."""
    def squared(at):
        terms = [(z - at[i]).cast("double") for i, z in enumerate(zs)]
        return reduce(lambda x, y: x + y, [t * t for t in terms])
    return F.array_min(F.transform(centres, lambda c: F.struct(squared(c["at"]).alias("d"), c["j"].alias("j"))))


def _uniform(key: str, seed: int, j: int) -> Column:
    """A number in (0, 1) from the key's MD5: 52 bits, the same in any placement."""
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(str(j)), F.col(key).cast("string"))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint")
    return (bits.cast("double") + 0.5) / F.lit(float(2 ** 52))


def _scaled(df: DataFrame, cols: list[str], key: str, extra: list[str],
            partitions: int | None) -> tuple[DataFrame, Scaling]:
    """The rows without nulls: ``_key``, ``extra`` and the scaled columns z0.., in a reliable
    checkpoint, and the scaling. The source is read once."""
    whole = df.select(F.col(key).alias("_key"), *[F.col(c).cast(EXACT).alias(c) for c in dict.fromkeys([*cols, *extra])])
    whole = whole.dropna(subset=["_key", *cols])
    data = (whole if partitions is None else whole.repartition(partitions, "_key")).checkpoint(eager=True)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        aggs += [F.sum(c).alias(f"s{i}"), F.sum(F.col(c) * F.col(c)).alias(f"q{i}")]
    m = data.agg(*aggs).first()
    mean, sd = [], []
    for i in range(len(cols)):
        s, q = float(m[f"s{i}"] or 0), float(m[f"q{i}"] or 0)
        mean.append(s / m["n"] if m["n"] else 0.0)
        var = (q - s * s / m["n"]) / (m["n"] - 1) if m["n"] > 1 else 0.0
        sd.append(math.sqrt(var) if var > 0 else 0.0)
    scaling = Scaling(tuple(cols), m["n"], tuple(mean), tuple(sd))
    scaled = data.select("_key", *extra, *[scaling.units(c).alias(f"z{i}") for i, c in enumerate(cols)])
    return scaled.checkpoint(eager=True), scaling


def _zs(scaling: Scaling) -> list[Column]:
    return [F.col(f"z{i}") for i in range(len(scaling.cols))]


def _seeds(data: DataFrame, zs: list[Column], k: int, seed: int) -> list[list[int]]:
    """k-means++ over all rows, one aggregate a centre: the row with the largest
    D^2 / -ln(u) is a draw with weight D^2 when u is uniform (a race of
    exponential clocks), and u is a hash of key and round. No centres where there
    are no rows; with fewer different rows than ``k`` centres repeat."""
    centres: list[list[int]] = []
    for j in range(k):
        weight = _nearest(zs, _model(j, centres)["centres"])["d"] if centres else F.lit(1.0)
        best = data.agg(F.max(F.struct((weight / -F.log(_uniform("_key", seed, j))).alias("w"), F.col("_key"), *zs)).alias("b")).first()["b"]
        if best is None:
            return []
        centres.append([int(best[2 + i]) for i in range(len(zs))])
    return centres


def _met(data: DataFrame, zs: list[Column], models: list[Column]) -> DataFrame:
    """Each row with each model (``m``) and its nearest centre there (``near``); rows are copied inside their map task."""
    return data.select(*zs, F.explode(F.array(*models)).alias("m")).withColumn("near", _nearest(zs, F.col("m.centres")))


def _clusters(met: DataFrame, n: int, *more: Column) -> list:
    """Exact count and sums per model and cluster: at most one row a task and cluster
    is shuffled, as many rows as there are clusters reach the driver."""
    return (met.groupBy(F.col("m.k").alias("k"), F.col("near.j").alias("j"))
            .agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(f"z{i}").cast("decimal(20,0)")).alias(f"s{i}") for i in range(n)], *more)
            .collect())


def lloyd(data: DataFrame, zs: list[Column], models: dict[int, list[list[int]]], max_iter: int) -> dict[int, list[list[int]]]:
    """Lloyd steps of several models together, until no centre moves or ``max_iter``.

    Sums are exact and a centre is the whole-number floor of its mean, so the
    steps give the same centres for any number and order of partitions; a
    centre that loses all its rows stays where it is. Models that stand still
    leave the pass."""
    now, moving = {k: [list(c) for c in cs] for k, cs in models.items()}, set(models)
    for _ in range(max_iter):
        if not moving:
            break
        after = {k: [list(c) for c in now[k]] for k in moving}
        for r in _clusters(_met(data, zs, [_model(k, now[k]) for k in sorted(moving)]), len(zs)):
            after[r["k"]][r["j"]] = [int(r[f"s{i}"]) // r["n"] for i in range(len(zs))]
        moving = {k for k in moving if after[k] != now[k]}
        now.update(after)
    return now


def fit_segments(df: DataFrame, k: int, seed: int = 1, cols: list[str] = FEATURES,
                 key: str = "customer_id", partitions: int | None = None, max_iter: int = 40,
                 rank_by: str = "monetary") -> Segments:
    """C4: scale ``cols`` and fit k-means (k-means++ seeding by hash, Lloyd steps on
    exact sums), the same for any placement of the rows. Segment numbers follow
    the descending mean of ``rank_by``; a tie goes to the earlier centre.
    ``partitions`` deals the rows anew before they are checkpointed. Rows with a
    null feature take no part; an empty table gives no centres and null segments."""
    data, scaling = _scaled(df, cols, key, [rank_by], partitions)
    zs = _zs(scaling)
    seeds = _seeds(data, zs, k, seed)
    if not seeds:
        return Segments(scaling, [], [], k)
    centres = lloyd(data, zs, {k: seeds}, max_iter)[k]
    near = _nearest(zs, _model(k, centres)["centres"])["j"]
    value = data.groupBy(near.alias("j")).agg(F.sum(rank_by).alias("s"), F.count(F.lit(1)).alias("n")).collect()
    mean = {r["j"]: float(r["s"]) / r["n"] if r["s"] is not None else -math.inf for r in value}
    order = [0] * k
    for segment, j in enumerate(sorted(range(k), key=lambda j: (-mean.get(j, -math.inf), j))):
        order[j] = segment
    return Segments(scaling, centres, order, k)


# C5 ----------------------------------------------------------------------------

def choose_k(df: DataFrame, ks: list[int], seed: int = 1, cols: list[str] = FEATURES,
             key: str = "customer_id", partitions: int | None = None, max_iter: int = 40) -> DataFrame:
    """Training cost (within-cluster sum of squares, four decimals) and mean
    silhouette (squared Euclidean, each row's to a millionth) for each k. One row per k.

    All k share one seeding (the first k centres of the largest) and every Lloyd
    pass. A row's mean distance to a cluster follows from the cluster's count, sum
    and sum of squares, so the silhouette is one more pass, not pairs of rows.
    A row alone in its cluster counts 0, as all rows do where one cluster holds all."""
    data, scaling = _scaled(df, cols, key, [], partitions)
    zs = _zs(scaling)
    seeds = _seeds(data, zs, max(ks), seed)
    rows = [(int(k), 0.0, 0.0) for k in ks]
    if seeds:
        models = lloyd(data, zs, {k: seeds[:k] for k in ks}, max_iter)
        norm = reduce(lambda x, y: x + y, [z.cast("double") * z.cast("double") for z in zs])
        whole = [F.sum(c.cast("bigint").cast("decimal(20,0)")).alias(name) for name, c in (("squares", norm), ("cost", F.col("near.d")))]
        found = _clusters(_met(data, zs, [_model(k, cs) for k, cs in models.items()]), len(zs), *whole)
        stats = {k: {r["j"]: r for r in found if r["k"] == k} for k in ks}
        met = _met(data, zs, [_model(k, cs, stats[k]) for k, cs in models.items()])
        marks = met.groupBy(F.col("m.k").alias("k")).agg(
            F.sum(F.floor(_silhouette(zs, norm) * F.lit(float(MICRO))).cast("decimal(20,0)")).alias("t")).collect()
        marks = {r["k"]: float(int(r["t"])) for r in marks}
        rows = [(int(k), float(sum(int(r["cost"]) for r in stats[k].values()) // 10 ** 8) / 1e4,
                 marks[k] / float(scaling.n) / float(MICRO)) for k in ks]
    return df.sparkSession.createDataFrame(rows, "k int, cost double, silhouette double")


def _silhouette(zs: list[Column], norm: Column) -> Column:
    """Silhouette of a row of ``_met`` against the clusters of its model."""
    def mean(g):
        dot = reduce(lambda x, y: x + y, [z.cast("double") * g["sum"][i] for i, z in enumerate(zs)])
        return norm - F.lit(2.0) * dot / g["n"] + g["squares"] / g["n"]
    groups, own = F.col("m.clusters"), F.col("near.j")
    a = F.array_max(F.transform(F.filter(groups, lambda g: (g["j"] == own) & (g["n"] > 1)), lambda g: mean(g) * g["n"] / (g["n"] - 1)))
    b = F.array_min(F.transform(F.filter(groups, lambda g: g["j"] != own), mean))
    most = F.greatest(a, b)
    return F.when(a.isNull() | b.isNull() | (most <= 0), F.lit(0.0)).otherwise((b - a) / most)


# C6 ----------------------------------------------------------------------------

def assign(df: DataFrame, centres: list[list], cols: list[str], out: str = "segment") -> DataFrame:
    """Nearest of the given ``centres`` (k x len(cols) numbers) by squared
    Euclidean distance; a tie goes to the lower centre index.

    The centres are literals inside one expression, so no join and no
    broadcast of data is needed; k is chosen by the caller and small.
    Decimal inputs give exact distances.
    """
    dists: list[Column] = []
    for c in centres:
        terms = [(F.col(col) - F.lit(v)) * (F.col(col) - F.lit(v)) for col, v in zip(cols, c)]
        e = terms[0]
        for t in terms[1:]:
            e = e + t
        dists.append(e)
    arr = F.array(*dists)
    return df.withColumn(out, (F.array_position(arr, F.array_min(arr)) - 1).cast("int"))


def profile(df: DataFrame, segment: str = "segment", cols: list[str] = FEATURES) -> DataFrame:
    """Per segment: customers, share of customers and the mean of each
    feature (exact sums, one division)."""
    from pyspark.sql import Window
    agg = df.groupBy(segment).agg(F.count(F.lit(1)).alias("customers"),
                                  *[F.sum(F.col(c)).alias(f"_s_{c}") for c in cols])
    total = F.sum("customers").over(Window.partitionBy())
    return agg.select(segment, "customers", ratio("customers", total).alias("share"),
                      *[ratio(f"_s_{c}", "customers").alias(f"mean_{c}") for c in cols])
