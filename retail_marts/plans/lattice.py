"""Stored aggregates of a star, and the choice of one for a request.

An aggregate holds, for a set of attributes, one row per combination with the
parts of every measure that adds up (``star.Measure``): sums, counts, and sum and
count of a mean. Coarser ones are built from the smallest finer one that covers
them, so the fact is read once for the finest. A request is answered from the
stored aggregate with the fewest rows whose attributes cover what the request groups
and filters by and whose measures it needs; a distinct count doesn't add up, so such a request,
like one that nothing covers, reads the star itself.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_marts.plans import star
from retail_marts.plans.star import Measure, StarModel


@dataclass
class Stored:
    attributes: tuple[str, ...]
    df: DataFrame
    rows: int


class Lattice:
    """``build`` writes the aggregates under ``root``; ``slice`` takes what ``star.slice`` takes."""

    def __init__(self, model: StarModel, stored: list[Stored]):
        self.model, self.stored = model, stored

    @property
    def measures(self) -> dict[str, Measure]:
        return {m: x for m, x in self.model.measures.items() if isinstance(x, Measure) and x.additive}

    @classmethod
    def build(cls, model: StarModel, root: str, sets: list[list[str]]) -> "Lattice":
        out = cls(model, [])
        spark = model.fact.sparkSession
        for attrs in sorted((tuple(dict.fromkeys(s)) for s in sets), key=lambda s: (-len(s), s)):
            star.check(model, [], list(attrs), [], [])
            finer = out.covering(attrs)
            if finer is None:
                df = _parts(model, out.measures, attrs)
            else:
                df = finer.df.groupBy(*attrs).agg(*[c for m, x in out.measures.items() for c in x.again(m)])
            path = f"{root.rstrip('/')}/{'-'.join(attrs) or 'total'}"
            df.write.mode("overwrite").parquet(path)
            kept = spark.read.schema(df.schema).parquet(path)
            out.stored.append(Stored(attrs, kept, kept.count()))
        return out

    def covering(self, attrs) -> Stored | None:
        """The smallest aggregate that has all ``attrs``."""
        able = [s for s in self.stored if set(attrs) <= set(s.attributes)]
        return min(able, key=lambda s: (s.rows, s.attributes), default=None)

    def source(self, measures: list[str], by: list[str], where: list[tuple] | None = None) -> Stored | None:
        """The aggregate that answers the request, or None for the star itself."""
        if any(m not in self.measures for m in measures):
            return None
        return self.covering([*by, *[w[0] for w in where or []]])

    def slice(self, measures: list[str], by: list[str], where: list[tuple] | None = None,
              order: list[tuple[str, str]] | None = None, n: int | None = None) -> DataFrame:
        where, order = where or [], order or []
        star.check(self.model, measures, by, where, order)
        stored = self.source(measures, by, where)
        if stored is None:
            return star.slice(self.model, measures, by, where, order, n)
        df = stored.df
        if where:
            df = df.filter(reduce(lambda a, b: a & b, [star._OPS[op](F.col(a), v[0] if v else None) for a, op, *v in where]))
        out = df.groupBy(*by).agg(*[self.measures[m].merged(m).alias(m) for m in measures])
        return star.ranked(out, by, order, n)


def _parts(model: StarModel, measures: dict[str, Measure], attrs: tuple[str, ...]) -> DataFrame:
    """The parts of all measures by ``attrs``: the fact summed by its keys, then by the attributes."""
    own = [a for a in attrs if model.attributes[a][0] is None]
    used = sorted({model.attributes[a][0] for a in attrs} - {None})
    keys = list(dict.fromkeys(k for n in used for k, _ in model.dims[n].pairs))
    df = model.fact.withColumns({f"_a_{a}": model.attributes[a][1]() for a in own}) if own else model.fact
    df = df.groupBy(*keys, *[f"_a_{a}" for a in own]).agg(*[c for m, x in measures.items() for c in x.parts(m)])
    for name in used:
        d = model.dims[name]
        right = d.df.select(*[F.col(k).alias(f"_{name}_key{i}") for i, (_, k) in enumerate(d.pairs)],
                            *[model.attributes[a][1]().alias(f"_a_{a}") for a in attrs if model.attributes[a][0] == name])
        df = df.join(right, reduce(lambda x, y: x & y, [F.col(f) == F.col(f"_{name}_key{i}") for i, (f, _) in enumerate(d.pairs)]), "left")
    return df.groupBy(*[F.col(f"_a_{a}").alias(a) for a in attrs]).agg(*[c for m, x in measures.items() for c in x.again(m)])
