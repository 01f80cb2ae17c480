"""Mixing to target weights by iterative proportional fitting (raking).

Documents are counted into cells of source, language and topic; the cells' token weights are raked until their
marginals are the targets; a document is then drawn with the probability that its cell's weight calls for.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, words

#: Sweeps at most, after how many of them the error is looked at, and the largest relative one of a marginal at which
#: raking ends.
SWEEPS, AT_ONCE, ERROR = 60, 5, 1e-6
#: Cells that one task rakes as arrays, at most; more of them are raked by windows.
CELLS = 1 << 18
#: Topics, told from which share of a text's words hashes to each.
TOPICS = 8


def topic(text: Column) -> Column:
    """The topic that most of a text's words of five or more letters hash to; the lowest of equals, 0 without any."""
    long = F.filter(words(F.lower(text)), lambda w: F.char_length(w) >= 5)
    codes = F.element_at(F.transform(F.array(F.array_sort(F.transform(long, lambda w: F.pmod(F.crc32(w.cast("binary")), F.lit(TOPICS)).cast("int")))), lambda c: F.transform(F.sequence(F.lit(0), F.lit(TOPICS - 1)), lambda t: F.struct(F.size(F.filter(c, lambda x: x == t)).alias("n"), (-t).alias("t")))), 1)
    return -F.array_max(codes)["t"]


def tempered(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """Targets of one dimension: its shares of tokens to a power, as shares. Columns: dim, target."""
    got = cells.groupBy(dim).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("p"))
    return got.crossJoin(got.agg(F.sum("p").alias("all"))).select(dim, (F.col("p") / F.col("all")).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], most: float | None = None) -> DataFrame:
    """cells with a `weight` whose marginals are the targets' shares of all tokens.

    cells has the dimensions and `tokens` > 0. A value without a target keeps no weight; a target without cells is
    left out and the others scaled up. Up to CELLS cells are raked as arrays in one task, in a job whatever the sweeps;
    more by windows, which hold the cells of one value of a dimension, in a job a sweep. Neither holds documents, and
    the driver plans a sweep at most. Ends when no factor is further than ERROR from 1; a warning says if SWEEPS don't
    get there. With most, no cell weighs more than so many times its tokens, and the others of its values make up for it.
    """
    dims = list(targets)
    now = cells.withColumns({"weight": F.col("tokens").cast("double"), "_off": F.lit(0.0)})
    for d in dims:
        now = now.join(targets[d].select(d, F.col("target").alias(f"_{d}")), d, "left")
    now = cut(now.select(*cells.columns, "weight", "_off", *(F.coalesce(f"_{d}", F.lit(0.0)).alias(f"_{d}") for d in dims)))
    if now.count() <= CELLS:
        now = cut(now.coalesce(1).mapInArrow(_in_arrays(dims, most), now.schema))
    else:
        now = _by_windows(now, dims, most)
    if (off := _furthest(now)) >= ERROR:
        warnings.warn(f"raking ended {off:.2g} from its targets", stacklevel=2)
    return now.select(*cells.columns, "weight")


def _furthest(now: DataFrame) -> float:
    return now.agg(F.max("_off")).first()[0] or 0.0


def _in_arrays(dims: list[str], most: float | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = pa.Table.from_batches(got) if (got := list(batches)) else None
        if not cells:
            return
        tokens, sides = cells["tokens"].to_numpy().astype(float), []
        for d in dims:
            code = cells[d].combine_chunks().dictionary_encode("encode").indices.to_numpy()
            goal = np.zeros(code.max() + 1)
            goal[code] = cells[f"_{d}"].to_numpy()
            sides.append((code, goal * (tokens.sum() / (goal.sum() or 1.0))))
        weight = tokens
        for sweep in range(1, SWEEPS + 1):
            off = 0.0
            for code, goal in sides:
                held = np.bincount(code, weight, len(goal))
                factor = np.divide(goal, held, out=np.zeros(len(goal)), where=held > 0)[code]
                off = max(off, np.abs(factor[weight > 0] - 1).max(initial=0.0))
                weight = weight * factor
                if most is not None:
                    weight = np.minimum(weight, tokens * most)
            if sweep % AT_ONCE == 0 and off < ERROR:
                break
        made = {"weight": pa.array(weight), "_off": pa.array(np.full(len(weight), off))}
        yield from pa.table([made.get(c, cells[c]) for c in cells.column_names], cells.column_names).to_batches()

    return run


def _by_windows(now: DataFrame, dims: list[str], most: float | None) -> DataFrame:
    own = [c for c in now.columns if c not in {f"_{d}" for d in dims}]
    # Shares of the values that have cells, scaled to the whole.
    there = [now.where(f"`_{d}` > 0").select(d, f"_{d}").distinct().agg(F.sum(f"_{d}").alias(f"_all_{d}")) for d in dims]
    for one in [now.agg(F.sum("tokens").cast("double").alias("_whole")), *there]:
        now = now.crossJoin(F.broadcast(one))  # a row each
    now = cut(now.select(*own, *(F.coalesce(F.col(f"_{d}") / F.col(f"_all_{d}") * F.col("_whole"), F.lit(0.0)).alias(f"_{d}") for d in dims)))
    for sweep in range(1, SWEEPS + 1):
        for d in dims:
            held = F.sum("weight").over(Window.partitionBy(d))
            now = now.withColumn("_f", F.when(held > 0, F.col(f"_{d}") / held).otherwise(0.0))
            off = F.when(F.col("weight") > 0, F.abs(F.col("_f") - 1)).otherwise(0.0)
            now = now.withColumn("_off", off if d == dims[0] else F.greatest("_off", off)).withColumn("weight", F.col("weight") * F.col("_f"))
            if most is not None:
                now = now.withColumn("weight", F.least("weight", F.col("tokens") * most))
        now = cut(now.drop("_f"))
        if sweep % AT_ONCE == 0 and _furthest(now) < ERROR:
            break
    return now


def mix(docs: DataFrame, dims: dict[str, Column], doc_id: Column, tokens: Column, power: float = 0.7, share: float = 0.5, seed: int = 0, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """docs with tokens, the dimensions as dim_<name>, weight (of a token), probability and sampled, in the place of
    columns of docs with such names.

    The token weights of a cell are raked to targets, by default each dimension's token shares to `power`.
    Probabilities are proportional to them and expect `share` of all tokens; a weight at which a document is certain is
    the largest, and other cells make up for the rest. A document is drawn if the hash of its
    id and the seed falls under its probability, so a row's fate depends on its id alone and repeated rows share
    it. Null dimensions are a value of their own; documents without tokens weigh as one token; an empty table
    gives no rows.
    """
    names = {f"dim_{k}": c for k, c in dims.items()}
    made = {k: F.coalesce(c.cast("string"), F.lit("\0")) for k, c in names.items()} | {"tokens": F.greatest(F.coalesce(tokens.cast("long"), F.lit(0)), F.lit(1)).cast("long")}
    u = F.pmod(F.xxhash64(doc_id, F.lit(seed)), F.lit(1 << 52)) / float(1 << 52)
    own = [c for c in docs.columns if c not in {*made, "weight", "probability", "sampled", "_u"}]
    rows = docs.select(*own, *(c.alias(k) for k, c in made.items()), u.alias("_u"))
    cells = cut(rows.groupBy(*names).agg(F.sum("tokens").alias("tokens")))
    goals = {f"dim_{k}": v.withColumnRenamed(k, f"dim_{k}") for k, v in (targets or {}).items()} or {k: tempered(cells, k, power) for k in names}
    raked = rake(cells, goals, 1 / share)
    raked = raked.select(*names, (F.col("weight") / F.col("tokens")).alias("weight"))
    drawn = rows.join(raked, list(names)).withColumn("probability", F.least(F.col("weight") * share, F.lit(1.0)))
    return drawn.withColumn("sampled", F.col("_u") < F.col("probability")).drop("_u")
