"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed for each (source, language, topic) cell; the cells' kept tokens are
raked to the three stated marginals in turn until all hold, never above what a cell
has nor below a twentieth of it; each document is then kept with its cell's calibrated probability.

Categories without a target share one ``other`` category of each dimension. Its target
is the mix's own share for ``other``; without one it is the share of the tokens that these
categories have, and the named targets are scaled to the rest. So there are at most (sources + 1) x (languages + 1) x (topics + 1) cells, a bound set by the
stated targets alone; only that table goes to the driver and back to the documents.
A source that a third of all rows have costs one partial sum a task.

A document is drawn by a hash of its id, so the same rows give the same sample at any
partitioning and after any lost executor.

Edge cases: a null source, language or id is a category (``other``) or id (the empty
one) of its own; null and empty texts have no tokens, and are drawn with their cell's
probability (the overall share in a cell without tokens); targets for categories that
do not occur are dropped and the rest scaled up; if the targets contradict each other
within what the cells have, the last iteration stands and ``residual`` says by how much
they are missed; repeated rows are drawn alike; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OTHER = "other"
DIMENSIONS = ("source", "lang", "topic")
ROUNDS = 100
# Least share of a cell's tokens that is kept, so that targets a corpus cannot meet empty no cell.
LEAST = 0.05


@dataclass(frozen=True)
class Mix:
    """Target shares of tokens by dimension, and the share of all tokens to keep."""

    source: dict[str, float]
    lang: dict[str, float]
    topic: dict[str, float]
    keep: float


# The mix of the query and the pipeline.
MIX = Mix(source={"src0": 0.30} | {f"src{k}": 0.70 / 19 for k in range(1, 20)},
          lang={"en": 0.58, "de": 0.16, "fr": 0.15, "es": 0.11},
          topic={"prose": 0.955, "short": 0.01, "list": 0.005, "shout": 0.015, "marks": 0.015},
          keep=0.85)


def topic_of(text: Column) -> Column:
    """Genre of a text by its form: shout, marks, list, short or prose."""
    text = F.coalesce(text, F.lit(""))
    return (F.when(F.contains(text, F.lit("!! ")), "shout").when(F.contains(text, F.lit("*** ")), "marks")
            .when(F.contains(text, F.lit(" | ")), "list").when(F.length(text) < 400, "short").otherwise("prose"))


def n_tokens(text: Column) -> Column:
    """Runs outside space and TAB..CR."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def rake(tokens: np.ndarray, targets: list[np.ndarray], keep: float, least: float = LEAST,
         rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Kept tokens of every cell, and the largest miss of a marginal as a share of the kept total.

    ``tokens`` has one axis for each marginal. Each step scales the cells of one
    category by one factor, within ``least`` of a cell's tokens and all of them.
    """
    total = keep * tokens.sum()
    want = []
    for axis, target in enumerate(targets):
        there = tokens.sum(axis=tuple(k for k in range(tokens.ndim) if k != axis)) > 0
        share = np.where(there, target, 0.0)
        want.append(total * share / share.sum() if share.sum() else np.zeros(len(share)))
    kept = tokens * keep
    miss = 0.0
    for _ in range(rounds):
        for axis, goal in enumerate(want):
            cells, most = np.moveaxis(kept, axis, 0), np.moveaxis(tokens, axis, 0)
            for k, amount in enumerate(goal):
                cells[k] = _scaled(cells[k], least * most[k], most[k], amount)
        sums = [kept.sum(axis=tuple(k for k in range(kept.ndim) if k != axis)) for axis in range(kept.ndim)]
        miss = max((float(np.abs(s - g).max()) for s, g in zip(sums, want, strict=True)), default=0.0) / max(total, 1e-300)
        if miss < 1e-9:
            break
    return kept, miss


def _scaled(cells: np.ndarray, low: np.ndarray, high: np.ndarray, amount: float) -> np.ndarray:
    """Cells times one factor, held between ``low`` and ``high``, with a sum as near ``amount`` as that allows."""
    if high.sum() <= amount or not cells.sum():
        return high.copy()
    least, most = -60.0, 60.0
    for _ in range(70):
        middle = (least + most) / 2
        if np.clip(cells * np.exp(middle), low, high).sum() < amount:
            least = middle
        else:
            most = middle
    return np.clip(cells * np.exp(most), low, high)


def _targets(tokens: np.ndarray, axis: int, names: list[str], shares: dict[str, float]) -> np.ndarray:
    """Target shares of an axis; ``other`` without one gets its share of the tokens, the named ones that occur the rest."""
    there = tokens.sum(axis=tuple(k for k in range(tokens.ndim) if k != axis))
    out = np.array([shares.get(x, 0.0) for x in names])
    if OTHER not in shares and there.sum():
        out[there == 0] = 0.0
        own = there[names.index(OTHER)] / there.sum()
        out *= (1 - own) / out.sum() if out.sum() else 0.0
        out[names.index(OTHER)] = own
    return out


def mix_documents(docs: DataFrame, mix: Mix = MIX, seed: str = "mix") -> DataFrame:
    """``docs`` with ``topic``, ``n_tokens``, ``probability`` and ``sampled``."""
    shares = {d: dict(getattr(mix, d)) for d in DIMENSIONS}
    named = docs.withColumns({"topic": topic_of(F.col("text")), "n_tokens": n_tokens(F.col("text"))})
    level = {d: F.when(F.col(d).isin(*shares[d]), F.col(d)).otherwise(F.lit(OTHER)).alias(f"_{d}") for d in DIMENSIONS}
    cells = (named.select(*level.values(), "n_tokens").groupBy(*(f"_{d}" for d in DIMENSIONS))
             .agg(F.sum("n_tokens").alias("tokens")).collect())  # bounded by the targets
    names = [[*shares[d], *([] if OTHER in shares[d] else [OTHER])] for d in DIMENSIONS]
    tokens = np.zeros([len(n) for n in names])
    at = [tuple(n.index(r[f"_{d}"]) for n, d in zip(names, DIMENSIONS, strict=True)) for r in cells]
    for place, row in zip(at, cells, strict=True):
        tokens[place] = row["tokens"]
    kept, residual = rake(tokens, [_targets(tokens, axis, n, shares[d]) for axis, (n, d) in enumerate(zip(names, DIMENSIONS, strict=True))], mix.keep)
    rows = [(*(n[k] for n, k in zip(names, place, strict=True)),
             float(min(1.0, kept[place] / tokens[place])) if tokens[place] else float(mix.keep)) for place in at]
    table = docs.sparkSession.createDataFrame(rows, ", ".join(f"_{d} string" for d in DIMENSIONS) + ", probability double")
    keyed = named.withColumns({f"_{d}": level[d] for d in DIMENSIONS})
    drawn = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 8), 16, 10)
    out = keyed.join(F.broadcast(table), [f"_{d}" for d in DIMENSIONS]).drop(*(f"_{d}" for d in DIMENSIONS))
    return out.withColumn("sampled", drawn.cast("double") / 2**32 < F.col("probability")).withColumn("residual", F.lit(residual))
