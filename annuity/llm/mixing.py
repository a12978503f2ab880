"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic). The cells' token counts
are raked: their weights are scaled to each marginal's target shares in turn
until all marginals agree. A cell's documents are then kept with probability
min(1, scale * raked weight / tokens), where the scale is solved so that the
expected tokens are the wanted part of the input. Unless a caller names a budget, that
part is the largest at which the categories have the tokens that their targets ask for. Those that run
out first, with up to ``SHORT`` of a marginal's target together, may fall short: they
are kept whole, so that rare categories do not decide for all. Where the input has its
target shares already, everything is kept.

Every category has a target of its own; only where a caller names targets do
the categories without one share ``other``. Up to ``MAX_CELLS`` cells are raked
on the driver; a larger table of cells stays written, and each step is a sum by
marginal joined back to the cells. Both do the same steps. ``documents`` has no
topic column; the default topic is the form of the text (table, lines,
article, note).

Rows: one per input row. A null source or language is the category ``none``.
Null and empty texts weigh one token (a separator). The decision depends on the
seed, id and text, so repeated rows stay or go together. Clashing column names
are avoided; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annuity.llm.common import fresh, stage

# What the driver may hold; larger tables of cells are raked in Spark.
MAX_CELLS = 1 << 17
TEMPERATURE = 0.5
SHORT = 0.2
SEED = 7
ROUNDS, TOLERANCE = 500, 1e-9
MARGINALS = ("source", "lang", "topic")
OTHER, NONE = "other", "none"
HASH_DIGITS = 13


def token_count(text: Column) -> Column:
    """Words by white space, and one for the separator."""
    return (F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")) + 1).cast("long")


def form(text: Column) -> Column:
    """The default topic."""
    t = F.coalesce(text, F.lit(""))
    lines = F.length(t) - F.length(F.translate(t, "\n", "")) + 1
    return (F.when(F.length(t) - F.length(F.translate(t, "|", "")) >= 3, "table")
            .when((lines >= 4) & (F.length(t) < 80 * lines), "lines")
            .when(F.length(t) >= 2000, "article").otherwise("note"))


def rake(cells: np.ndarray, tokens: np.ndarray, targets: Sequence[np.ndarray],
         keep: float = 0.0) -> tuple[np.ndarray, float]:
    """(shares of the cells, largest deviation of a marginal). ``cells``: one column of categories per marginal.

    No cell gets more than it has when ``keep`` of all tokens is sampled (0:
    no such limit); the other cells of its categories make up for it. Targets
    of categories without tokens are spread over the others. Where the
    targets cannot all be met, the last round stands.
    """
    share = tokens / tokens.sum()
    most = share / keep if keep else np.full(len(share), np.inf)
    wanted = []
    for k, target in enumerate(targets):
        there = np.bincount(cells[:, k], weights=share, minlength=len(target)) > 0
        t = np.where(there, target, 0.0)
        wanted.append(t / t.sum() if t.sum() else np.where(there, 1 / there.sum(), 0.0))
    off = 0.0
    for _ in range(ROUNDS):
        for k, target in enumerate(wanted):
            now = np.bincount(cells[:, k], weights=share, minlength=len(target))
            share = share * np.divide(target, now, out=np.zeros_like(now), where=now > 0)[cells[:, k]]
            share = np.minimum(share, most)
        off = max(np.abs(np.bincount(cells[:, k], weights=share, minlength=len(t)) - t).max()
                  for k, t in enumerate(wanted))
        if off < TOLERANCE:
            break
    return share, float(off)


def probabilities(share: np.ndarray, tokens: np.ndarray, keep: float) -> np.ndarray:
    """min(1, scale * share / tokens) per cell, with ``keep`` of all tokens expected."""
    rate, budget = share / tokens, min(keep, 1.0) * tokens.sum()
    if budget > tokens[rate > 0].sum():
        return (rate > 0).astype(float)
    # Cells at probability one in order of rate; the rest carry what is left.
    order = np.argsort(-rate, kind="stable")
    full = np.r_[0.0, np.cumsum(tokens[order])]
    rest = np.r_[np.cumsum(share[order][::-1])[::-1], 0.0]
    for n in range(len(order)):
        scale = (budget - full[n]) / max(rest[n], 1e-300)
        if scale * rate[order[n]] <= 1:
            return np.minimum(1.0, scale * rate)
    return np.ones(len(tokens))


def affordable(there: np.ndarray, wanted: np.ndarray) -> float:
    """The largest part of all tokens at which one marginal's target shares are there.

    ``there``: its categories' shares of the input. Those that run out first are passed over while their
    targets are within ``SHORT`` together.
    """
    on = wanted > 0
    reach = there[on] / wanted[on]
    order = np.argsort(reach, kind="stable")
    late = np.flatnonzero(wanted[on][order].cumsum() > SHORT * wanted[on].sum())
    return min(1.0, float(reach[order][late[0]])) if len(late) else 1.0


def tempered(tokens: dict[str, int]) -> dict[str, float]:
    """Shares by the square root of the tokens, which lifts small categories."""
    total = sum(t ** TEMPERATURE for t in tokens.values())
    return {c: t ** TEMPERATURE / total for c, t in tokens.items()}


def category(column: Column, own: Sequence[str]) -> Column:
    named = F.coalesce(column, F.lit(NONE))
    return F.when(named.isin(list(own)), named).otherwise(OTHER)


def measured(docs: DataFrame, seed: int = SEED, topic: Column | None = None) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with tokens, topic and draw (0 to 16^13, by seed, id and text); and the names those columns got."""
    names = dict(zip(("tokens", "topic", "draw"), fresh(docs, "tokens", "topic", "draw")))
    draw = F.conv(F.substring(F.md5(F.concat_ws(
        ":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).cast("string"))), 1, HASH_DIGITS), 16, 10)
    topic = form(F.col("text")) if topic is None else topic
    return docs.withColumns({names["topic"]: topic, names["tokens"]: token_count(F.col("text")),
                             names["draw"]: draw.cast("long")}), names


def _raked_here(cells: DataFrame, targets: dict[str, dict[str, float]], keep: float | None) -> list[tuple]:
    """(source, lang, topic, weight, probability) of at most ``MAX_CELLS`` cells."""
    rows = sorted(cells.collect(), key=lambda r: [r[m] for m in MARGINALS])
    if not rows:
        return []
    tokens = np.array([float(r["tokens"]) for r in rows])
    index, wanted = [], []
    for m in MARGINALS:
        totals: dict[str, float] = {}
        for r in rows:
            totals[r[m]] = totals.get(r[m], 0) + r["tokens"]
        given = targets[m] if m in targets else tempered(totals)
        place = {c: k for k, c in enumerate(sorted({*given, *totals}))}
        index.append([place[r[m]] for r in rows])
        wanted.append(np.array([given.get(c, 0.0) for c in place]))
    if keep is None:
        there = [np.bincount(i, weights=tokens, minlength=len(w)) / tokens.sum() for i, w in zip(index, wanted)]
        keep = min(affordable(t, np.where(t > 0, w, 0.0) / max(w[t > 0].sum(), 1e-300)) for t, w in zip(there, wanted))
    share, _ = rake(np.array(index).T, tokens, wanted, min(keep, 1.0))
    odds = probabilities(share, tokens, keep)
    return [(*[r[m] for m in MARGINALS], float(s * tokens.sum() / t), float(p))
            for r, t, s, p in zip(rows, tokens, share, odds)]


def _wanted(cells: DataFrame, marginal: str, given: dict[str, float] | None) -> DataFrame:
    """(category, target share) of the categories that occur, as ``rake`` has them."""
    there = cells.groupBy(marginal).agg(F.sum("tokens").alias("t"))
    if given is None:
        there = there.withColumn("goal", F.pow("t", F.lit(TEMPERATURE)))
    else:
        named = cells.sparkSession.createDataFrame(
            [(c, float(x)) for c, x in given.items()], f"`{marginal}` string, goal double")
        there = there.join(named, marginal, "left").withColumn("goal", F.coalesce("goal", F.lit(0.0)))
    there = stage(there, "mixture-targets", narrow=True)
    total, n = there.agg(F.sum("goal"), F.count("*")).first()
    return there.select(marginal, (F.col("goal") / total if total else F.lit(1 / n)).alias("goal"))


# Categories are counted by their reach in steps of this part of a doubling.
REACH_STEPS = 1024


def _affordable(cells: DataFrame, marginal: str, wanted: DataFrame, total: float) -> float:
    """``affordable`` over a table of categories of any size, rounded down by less than a thousandth."""
    reach = F.col("t") / total / F.col("goal")
    step = F.floor(F.log2(reach) * REACH_STEPS).cast("long")
    steps = (cells.groupBy(marginal).agg(F.sum("tokens").alias("t")).join(wanted, marginal).where(F.col("goal") > 0)
             .groupBy(F.greatest(F.least(step, F.lit(0)), F.lit(-64 * REACH_STEPS)).alias("step")).agg(F.sum("goal").alias("goal")))
    # At most 64 doublings of steps.
    found = sorted(map(tuple, steps.collect()))
    short = 0.0
    for step, goal in found:
        short += goal
        if short > SHORT:
            return min(1.0, 2.0 ** (step / REACH_STEPS))
    return 1.0


def _raked_there(cells: DataFrame, targets: dict[str, dict[str, float]], keep: float | None) -> DataFrame:
    """The rows of ``_raked_here`` by the steps of ``rake`` and ``probabilities``, over a table of cells of any size.

    The cells are written after each step. It also ends when a round moves no cell by more than ``TOLERANCE``
    of its share, as further rounds would not either.
    """
    total = float(cells.agg(F.sum("tokens")).first()[0])
    wanted = {m: _wanted(cells, m, targets.get(m)) for m in MARGINALS}
    keep = min(_affordable(cells, m, wanted[m], total) for m in MARGINALS) if keep is None else min(keep, 1.0)
    most = F.col("tokens") / total / keep if keep else F.lit(float("inf"))
    plain = [*MARGINALS, "tokens"]
    state = cells.select(*plain, (F.col("tokens") / total).alias("share"))
    for _ in range(ROUNDS):
        state = state.withColumn("before", F.col("share"))
        for m in MARGINALS:
            factors = (state.groupBy(m).agg(F.sum("share").alias("now")).join(wanted[m], m)
                       .select(m, F.when(F.col("now") > 0, F.col("goal") / F.col("now")).otherwise(0.0).alias("factor")))
            state = stage(state.join(factors, m).select(
                *plain, F.least(F.col("share") * F.col("factor"), most).alias("share"), "before"),
                          "mixture-raked", narrow=True)
        off = max(state.groupBy(m).agg(F.sum("share").alias("now")).join(wanted[m], m)
                  .agg(F.max(F.abs(F.col("now") - F.col("goal")))).first()[0] for m in MARGINALS)
        if off < TOLERANCE or not state.where(F.abs(F.col("share") - F.col("before")) > TOLERANCE * F.col("before")).take(1):
            break
    budget, share, tokens = keep * total, F.col("share"), F.col("tokens")
    if budget > (state.where(share > 0).agg(F.sum("tokens")).first()[0] or 0):
        chance = (share > 0).cast("double")
    else:
        # Cells at probability one, and the scale that gives the others the rest, until no further cell reaches one.
        scale, full = 0.0, -1
        while True:
            above = F.lit(scale) * share > tokens
            got = state.agg(F.count(F.when(above, 1)), F.sum(F.when(above, tokens)), F.sum(F.when(~above, share))).first()
            if got[0] == full:
                break
            full, scale = got[0], max(scale, (budget - (got[1] or 0)) / max(got[2] or 0.0, 1e-300))
        chance = F.least(F.lit(1.0), F.lit(scale) * share / tokens)
    return state.select(*MARGINALS, (share * total / tokens).alias("weight"), chance.alias("chance"))


def mixed(rows: DataFrame, names: dict[str, str], targets: dict[str, dict[str, float]] | None = None,
          keep: float | None = None) -> tuple[DataFrame, dict[str, str]]:
    """``measured`` rows with weight, probability and selected; and the names of all added columns.

    ``targets``: shares by marginal and category (``other`` for the rest); a
    marginal without targets gets ``tempered`` shares of its own tokens. ``keep``: the part of
    all tokens to keep, by default the largest at which the targets can be met.
    """
    added = ("weight", "probability", "selected")
    names = names | dict(zip(added, fresh(rows, *added)))
    at = {"source": "source", "lang": "lang", "topic": names["topic"]}
    targets = {m: t for m, t in (targets or {}).items() if t is not None}
    own = {m: category(F.col(at[m]), list(targets[m])) if m in targets else F.coalesce(F.col(at[m]), F.lit(NONE))
           for m in MARGINALS}
    # One row per (source, lang, topic) that occurs.
    cells = stage(rows.groupBy(*[own[m].alias(m) for m in MARGINALS])
                  .agg(F.sum(names["tokens"]).alias("tokens")), "mixture-cells", narrow=True)
    *keys, weight, chance = fresh(rows, *[f"cell_{m}" for m in MARGINALS], "cell_weight", "cell_chance")
    if cells.count() <= MAX_CELLS:
        lookup = F.broadcast(rows.sparkSession.createDataFrame(
            _raked_here(cells, targets, keep),
            ", ".join([*[f"`{k}` string" for k in keys], f"`{weight}` double", f"`{chance}` double"])))
    else:
        # Texts are not sorted for this join.
        lookup = _raked_there(cells, targets, keep).toDF(*keys, weight, chance).hint("shuffle_hash")
    picked = rows.join(lookup, [own[m] == F.col(k) for m, k in zip(MARGINALS, keys)]).select(
        *rows.columns, F.col(weight).alias(names["weight"]), F.col(chance).alias(names["probability"]))
    chosen = F.col(names["draw"]) < F.col(names["probability"]) * float(16 ** HASH_DIGITS)
    return picked.withColumn(names["selected"], chosen), names


def op7(docs: DataFrame) -> DataFrame:
    rows, names = measured(docs.select("doc_id", "text", "source", "lang"))
    # Texts are read once; what the mixture needs of them is written.
    rows, names = mixed(stage(rows.drop("text"), "mixture-rows"), names)
    return rows.select("doc_id", "source", "lang", *[names[c] for c in
                                                     ("topic", "tokens", "weight", "probability", "selected")])
