"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted into cells, one per combination of levels (source, language, topic). The cells' token shares are raked:
in turn, each margin is scaled to its target, until all margins hold. A document's probability is its cell's raked share per
token, divided by the largest one, so that no document is wanted more than once and expected token shares meet the targets.

A target names the levels it is for; all other values, nulls included, are one further level that keeps its share of the
tokens. So the number of cells is bounded by the targets and not by the data: raking is a fold over one row that holds them,
and their rates are broadcast. Everything is DataFrame expressions.

With ``keep``, that share of all tokens is drawn instead (see ``kept_rates``): scarce cells are taken whole and the others
divide what remains of each margin, so that no single cell sets the size of the sample.

Defined cases: a null or empty text has no tokens and is drawn at the rate of its cell; a cell without tokens has rate 0; a
level that the data lack gives its share to the others of its margin; rows with equal keys are drawn alike; an empty table
gives an empty result; ``mix`` keeps all columns under any names.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import mul

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.llm.base import once, whole_text

Targets = Mapping[str, Mapping[str, float]]

MOST_CELLS = 100_000


def token_count(text: str) -> Column:
    return F.regexp_count(whole_text(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def level(column: Column, targets: Mapping[str, float]) -> Column:
    """The place of a value among the target's names from 1, or 0."""
    return F.coalesce(F.array_position(F.array(*map(F.lit, targets)), column), F.lit(0)).cast("int")


def chance(key: Column, seed: str) -> Column:
    """A number in [0, 1) that follows from the key alone."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), key.cast("string")))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(16**12)


def _named(step, name: str):
    return lambda shares: step(shares, name)


def _add(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _margin(shares: Column, cells: Column, name: str, levels: int) -> Column:
    """The sum of the shares at each level."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(levels)),
        lambda at: _add(F.zip_with(shares, cells, lambda s, c: F.when(c[name] == at, s).otherwise(F.lit(0.0)))),
    )


def _goals(start: Column, cells: Column, name: str, targets: Mapping[str, float]) -> Column:
    """Target share per level: unnamed values keep theirs, the named levels that occur divide the rest."""
    weights = F.array(F.lit(0.0), *[F.lit(float(w)) for w in targets.values()])

    def shared(natural: Column) -> Column:
        present = F.zip_with(natural, weights, lambda n, w: F.when(n > 0, w).otherwise(F.lit(0.0)))
        return once(
            present,
            lambda p: F.transform(
                p,
                lambda w, at: F.when(at == 0, F.get(natural, F.lit(0))).otherwise(
                    F.coalesce(F.try_divide(w, _add(p)), F.lit(0.0)) * (1 - F.get(natural, F.lit(0)))
                ),
            ),
        )

    return once(_margin(start, cells, name, len(targets)), shared)


def rates(counted: DataFrame, targets: Targets, rounds: int = 20, most_tokens: float | None = None) -> DataFrame:
    """One row per cell: its levels, ``cell_tokens``, ``weight`` (raked share) and ``rate``.

    ``counted`` has a level column per target and ``tokens``. With ``most_tokens``, the rates are lowered so that about that
    many tokens are expected; they are never raised above the largest sample without repetition.
    """
    names = list(targets)
    room = reduce(mul, [len(t) + 1 for t in targets.values()])
    if room > MOST_CELLS:
        raise ValueError(f"{room} cells; {MOST_CELLS} are allowed")
    cells = counted.groupBy(*names).agg(F.sum("tokens").alias("cell_tokens"))
    row = cells.agg(F.sort_array(F.collect_list(F.struct(*names, "cell_tokens"))).alias("cells"))
    total = F.aggregate("cells", F.lit(0).cast("bigint"), lambda a, c: a + c["cell_tokens"])
    start = once(
        total,
        lambda n: F.transform(
            "cells", lambda c: F.coalesce(F.try_divide(c["cell_tokens"].cast("double"), n.cast("double")), F.lit(0.0))
        ),
    )
    goals = F.struct(*[_goals(F.col("start"), F.col("cells"), k, t).alias(k) for k, t in targets.items()])
    row = row.withColumn("start", start).withColumn("goals", goals)

    def rake(shares: Column, name: str) -> Column:
        def scaled(margin: Column) -> Column:
            return F.zip_with(
                shares,
                "cells",
                lambda s, c: F.coalesce(
                    s * F.try_divide(F.get(F.col(f"goals.{name}"), c[name]), F.get(margin, c[name])), F.lit(0.0)
                ),
            )

        return once(_margin(shares, F.col("cells"), name, len(targets[name])), scaled)

    def turn(shares: Column, _: Column) -> Column:
        for name in names:
            shares = once(shares, _named(rake, name))
        return shares

    raked = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.col("start"), turn)
    row = row.withColumn("raked", raked)
    per_token = F.zip_with(
        "raked", "cells", lambda s, c: F.coalesce(F.try_divide(s, c["cell_tokens"].cast("double")), F.lit(0.0))
    )
    rated = once(per_token, lambda f: F.transform(f, lambda x: F.coalesce(F.try_divide(x, F.array_max(f)), F.lit(0.0))))
    out = row.select(F.inline(F.arrays_zip("cells", "raked", rated.alias("rate")))).select(
        *[F.col("cells")[n].alias(n) for n in names],
        F.col("cells.cell_tokens").alias("cell_tokens"),
        F.col("raked").alias("weight"),
        "rate",
    )
    if most_tokens is None:
        return out
    expected = out.agg(F.sum(F.col("cell_tokens") * F.col("rate")).alias("expected"))
    return out.join(F.broadcast(expected)).withColumn(
        "rate", F.col("rate") * F.least(F.lit(1.0), F.try_divide(F.lit(float(most_tokens)), F.col("expected")))
    ).drop("expected")


def _filled(values: np.ndarray, caps: np.ndarray, goal: float) -> float:
    """The factor at which ``minimum(caps, factor * values)`` adds up to ``goal``, or one at which all caps are reached."""
    used = values > 0
    v, c = values[used], caps[used]
    if not len(v) or goal <= 0:
        return 0.0
    order = np.argsort(c / v, kind="stable")
    v, c = v[order], c[order]
    # Place i: the caps before it are reached.
    before, rest = np.concatenate(([0.0], np.cumsum(c)[:-1])), np.cumsum(v[::-1])[::-1]
    factors = (goal - before) / rest
    open_ = np.flatnonzero(factors <= c / v)
    return float(factors[open_[0]]) if len(open_) else float((c / v).max())


def _fit(places: list[np.ndarray], weights: list[np.ndarray], tokens: np.ndarray, keep: float, rounds: int) -> np.ndarray:
    """Drawing rates per cell; ``places`` and ``weights`` are the levels of the cells and the targets, by margin."""
    start = tokens / tokens.sum()
    caps = start / keep
    goals = []
    for place, weight in zip(places, weights):
        natural = np.bincount(place, start, len(weight) + 1)
        wanted = np.where(natural[1:] > 0, weight, 0.0)
        # A level that lacks the tokens for its goal gives all it has; the others share the rest as they share their goals.
        named = np.minimum(natural[1:] / keep, wanted * _filled(wanted, natural[1:] / keep, 1 - natural[0]))
        goals.append(np.concatenate(([min(natural[0] / keep, 1 - named.sum())], named)))
    factors = [np.ones(len(g)) for g in goals]
    for _ in range(rounds):
        for i, (place, goal) in enumerate(zip(places, goals)):
            others = start * reduce(mul, [f[p] for j, (f, p) in enumerate(zip(factors, places)) if j != i], 1.0)
            for at in range(len(goal)):
                cells = place == at
                factors[i][at] = min(_filled(others[cells], caps[cells], goal[at]), 1e12)
    shares = np.minimum(caps, start * reduce(mul, [f[p] for f, p in zip(factors, places)], 1.0))
    # Margins that cannot hold together leave the total a little off.
    shares = np.minimum(caps, shares * _filled(shares, caps, 1.0))
    return np.divide(shares * keep, start, out=np.zeros(len(start)), where=start > 0)


def kept_rates(counted: DataFrame, targets: Targets, keep: float, rounds: int = 100) -> DataFrame:
    """As ``rates``, for a sample of about ``keep`` of all tokens; ``weight`` is a cell's share of the sample.

    No rate is above 1. A level with too few tokens for its target is taken whole, and the other levels of its margin divide
    the rest by their targets; so do cells. The cells are bounded by the targets and are raked on the driver.
    """
    names = list(targets)
    room = reduce(mul, [len(t) + 1 for t in targets.values()])
    if room > MOST_CELLS:
        raise ValueError(f"{room} cells; {MOST_CELLS} are allowed")
    if not 0 < keep <= 1:
        raise ValueError(f"keep is {keep}; a share above 0 and up to 1 is wanted")
    rows = counted.groupBy(*names).agg(F.sum("tokens").alias("cell_tokens")).orderBy(*names).collect()
    tokens = np.array([r["cell_tokens"] for r in rows], dtype=np.float64)
    rate = np.zeros(len(rows))
    if tokens.sum() > 0:
        places = [np.array([r[n] for r in rows]) for n in names]
        rate = _fit(places, [np.array(list(t.values()), dtype=np.float64) for t in targets.values()], tokens, keep, rounds)
    drawn = tokens * rate
    weight = drawn / max(drawn.sum(), 1e-300)
    kinds = ", ".join([*(f"`{n}` int" for n in names), "cell_tokens bigint, weight double, rate double"])
    return counted.sparkSession.createDataFrame(
        [(*r, float(w), float(x)) for r, w, x in zip(rows, weight, rate)], kinds
    )


def plan(
    docs: DataFrame,
    levels: Mapping[str, Column],
    targets: Targets,
    key: str = "doc_id",
    text: str = "text",
    seed: str = "mix",
    rounds: int = 20,
    most_tokens: float | None = None,
    keep: float | None = None,
) -> DataFrame:
    """``docs`` with ``mix_tokens``, ``mix_weight``, ``mix_rate`` and ``mix_kept``; ``levels`` gives each target's value.

    With ``keep``, ``rounds`` and ``most_tokens`` do not count.
    """
    marks = {f"mix_{k}": level(levels[k], t) for k, t in targets.items()}
    marked = docs.withColumns({**marks, "mix_tokens": token_count(text)})
    names = {f"mix_{k}": t for k, t in targets.items()}
    counted = marked.withColumnRenamed("mix_tokens", "tokens")
    cells = rates(counted, names, rounds, most_tokens) if keep is None else kept_rates(counted, names, keep)
    # At most one row per combination of levels.
    cells = cells.select(*names, F.col("weight").alias("mix_weight"), F.col("rate").alias("mix_rate"))
    joined = marked.join(F.broadcast(cells), list(names))
    return joined.select(
        *docs.columns,
        "mix_tokens",
        "mix_weight",
        "mix_rate",
        (chance(F.col(key), seed) < F.col("mix_rate")).alias("mix_kept"),
    )


def mix(docs: DataFrame, levels: Mapping[str, Column], targets: Targets, key: str, text: str, **how) -> DataFrame:
    """The documents drawn, with the columns of ``docs``; ``levels`` are expressions over those."""
    inner = docs.withColumn("mix_row", F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    drawn = plan(
        inner.select("mix_row", *[v.alias(f"mix_of_{k}") for k, v in levels.items()],
                     F.col(f"`{key}`").alias("mix_key"), F.col(f"`{text}`").alias("mix_text")),
        {k: F.col(f"mix_of_{k}") for k in levels}, targets, "mix_key", "mix_text", **how,
    )
    return drawn.where("mix_kept").select("mix_row.*")
