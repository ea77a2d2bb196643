"""Mixing sources to target weights: iterative proportional fitting (raking) and calibrated Poisson sampling.

Documents fall into cells (source, language, topic). Spark sums the tokens of each cell; raking then scales the cells
until the weighted tokens match the target share of every source, language and topic. A document's probability is its
cell's weight times a common scale, 1 at most, and it stays if a hash of its id falls below. Without given targets the
shares found in the data are tempered (raised to TEMPER and normalised).

The bound of 1 is part of the raking (`rake_bounded`): what a full cell can't hold goes to the others of its values, until the
marginals of the final probabilities are met to TOLERANCE. A value with fewer tokens than its target is kept whole, the rest
of its dimension shares what it lacks; targets that can't be met are named in a warning.

The cell table has as many rows as there are combinations of values, whatever the number of documents: raking runs on the
driver up to MOST_CELLS cells, and beyond as joins of tables with the same steps, which end where those on the driver do.

Null source or language is the value `unknown`; a null text counts as empty, with 1 token. Values that have no target get
weight 0; targets of absent values are left out and the rest is normalised. Repeated rows share the decision of
their id. Extra columns of documents are kept as they are, but for those whose names the details take (mix_tokens, mix_topic,
mix_probability, with `details`); a null id hashes as empty text. Empty documents give no rows; a very long text counts whole.
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._spark import dropped, hot_join, spread, stored, table

DIMENSIONS = ("source", "lang", "topic")
#: Exponent of tempered shares, kept share of all tokens, the seed of the hash.
TEMPER, KEEP, SEED = 0.5, 0.5, "mix"
MOST_CELLS = 200_000
#: Share of all kept tokens by which a marginal of bounded raking may be off, rounds at most, and the largest weight.
TOLERANCE, MOST_ROUNDS, LARGEST = 1e-6, 2000, 1e100
#: The same for tables of more than MOST_CELLS cells: the size of the input picks the way, not the result.
TOLERANCE_BEYOND, ROUNDS_BEYOND = TOLERANCE, MOST_ROUNDS


def tokens(text: Column) -> Column:
    """Blanks and line ends plus one: the token estimate that both the weights and the targets use."""
    text = F.coalesce(text, F.lit(""))
    return F.length(text) - F.length(F.replace(F.replace(text, F.lit(" "), F.lit("")), F.lit("\n"), F.lit(""))) + 1


def topic(text: Column, n: Column) -> Column:
    """The kind of content, as no topic labels exist: tables, list of lines, short notes, articles, long reads."""
    text = F.coalesce(text, F.lit(""))
    return F.when(text.contains(" | "), "table").when(n < 50, "note").when(n < 500, "article").otherwise("long")


def _with_cells(documents: DataFrame, text_col: str, source_col: str, lang_col: str, names: dict[str, str]) -> DataFrame:
    n = tokens(F.col(text_col))
    df = documents.withColumn(names["n"], n)
    return (
        df.withColumn(names["source"], F.coalesce(F.col(source_col), F.lit("unknown")))
        .withColumn(names["lang"], F.coalesce(F.col(lang_col), F.lit("unknown")))
        .withColumn(names["topic"], topic(F.col(text_col), F.col(names["n"])))
    )


def _targets(cells: DataFrame, given: dict[str, dict[str, float]] | None) -> dict[str, dict[str, float]]:
    out = {}
    for d in DIMENSIONS:
        found = {r[d]: float(r["t"]) for r in cells.groupBy(d).agg(F.sum("tokens").alias("t")).collect()}  # the values of one dimension
        whole = sum(found.values())
        share = {v: given[d].get(v, 0.0) for v in found} if given and d in given else {v: (t / whole) ** TEMPER for v, t in found.items()}
        out[d] = {v: s / sum(share.values()) for v, s in share.items()} if sum(share.values()) else share
    return out


def _goals(cells: DataFrame, targets: dict[str, dict[str, float]], amount: float) -> dict[str, dict[str, float]]:
    """Tokens to keep of each value: its share of `amount`, all of its tokens at most; the others share what it lacks.

    For MOST_CELLS cells at most, as are `_targets` and `rake_bounded`.
    """
    out = {}
    for d in DIMENSIONS:
        held = {r[d]: float(r["t"]) for r in cells.groupBy(d).agg(F.sum("tokens").alias("t")).collect()}  # the values of one dimension
        goal, rest = {}, dict(held)
        while rest:
            left, share = max(amount - sum(goal.values()), 0.0), sum(targets[d][v] for v in rest)
            full = [v for v in rest if left * targets[d][v] / share >= rest[v]]
            if not full:
                goal |= {v: left * targets[d][v] / share for v in rest}
                break
            goal |= {v: rest.pop(v) for v in full}
        out[d] = goal
    return out


def rake_bounded(cells: DataFrame, targets: dict[str, dict[str, float]], keep: float = KEEP) -> DataFrame:
    """`cells` with a column `weight` between 0 and 1, such that weight * tokens has the target shares of `keep` of all tokens.

    A weight is a product of factors of its values, cut to 1. Each step multiplies the factor of a value by goal / held, held
    with the cut weights, which never oversteps the goal, so that steps repeated approach it.
    """
    spark, schema = cells.sparkSession, "source string, lang string, topic string, tokens long, weight double"
    rows = [r for r in cells.orderBy(*DIMENSIONS).collect() if all(targets[d][r[d]] > 0 for d in DIMENSIONS)]  # MOST_CELLS at most
    live = spark.createDataFrame([(*(r[d] for d in DIMENSIONS), r["tokens"]) for r in rows], schema.rpartition(",")[0])
    t, w = np.array([float(r["tokens"]) for r in rows]), np.full(len(rows), keep)
    amount = min(keep * (cells.agg(F.sum("tokens").alias("t")).first()["t"] or 0), t.sum())
    goals, steps = _goals(live, targets, amount), []
    for d in DIMENSIONS:
        at = {v: i for i, v in enumerate(sorted(goals[d]))}
        steps.append((np.array([at[r[d]] for r in rows], int), np.array([goals[d][v] for v in at])))
    for _ in range(MOST_ROUNDS):
        worst = 0.0
        for code, goal in steps:
            held = np.bincount(code, t * np.minimum(w, 1), len(goal))
            worst = max(worst, np.abs(held - goal).max(initial=0))
            w = np.minimum(w * np.divide(goal, held, out=np.ones_like(goal), where=held > 0)[code], LARGEST)
        if worst <= TOLERANCE * amount:
            break
    raked = spark.createDataFrame([(*(r[d] for d in DIMENSIONS), r["tokens"], float(x)) for r, x in zip(rows, np.minimum(w, 1), strict=True)], schema)
    missed = []
    for d in DIMENSIONS:
        whole = sum(targets[d][v] for v in goals[d])
        for r in raked.groupBy(d).agg(F.sum(F.col("tokens") * F.col("weight")).alias("held")).orderBy(d).collect():
            if amount and abs(r["held"] / amount - (want := targets[d][r[d]] / whole)) > 10 * TOLERANCE:
                missed.append(f"{d} {r[d]}: {r['held'] / amount:.4f} for {want:.4f}")
    if missed:
        warnings.warn("shares that the mixture can't meet: " + ", ".join(missed), stacklevel=2)
    return raked


def _capped(values: DataFrame, amount: float) -> DataFrame:
    """(v, goal) from stored (v, t, share): shares of `amount`, t at most; the level that the others rise to is found in a few sums."""
    level, before = 0.0, -1.0
    while level > before:
        full = F.col("t") <= F.col("share") * level
        sums = values.agg(F.sum(F.when(full, F.col("t")).otherwise(0.0)).alias("t"), F.sum(F.when(~full, F.col("share")).otherwise(0.0)).alias("share")).first()
        before, level = level, max(level, (amount - sums["t"]) / sums["share"]) if sums["share"] else level
    return values.select("v", F.least("t", F.col("share") * level).alias("goal"))


def rake_tables(cells: DataFrame, given: dict[str, dict[str, float]] | None, keep: float = KEEP) -> DataFrame:
    """`rake_bounded` for any number of cells and values, as joins of tables; ends at TOLERANCE_BEYOND, or after ROUNDS_BEYOND rounds.

    Only sums and the largest error of a round come to the driver. A value may hold most of the cells: joins are skew-safe.
    """
    spark, df, goals, shares = cells.sparkSession, cells.withColumn("tokens", F.col("tokens").cast("long")), {}, {}
    for d in DIMENSIONS:
        t = df.groupBy(F.col(d).alias("v")).agg(F.sum("tokens").cast("double").alias("t"))
        if given and d in given:
            wanted = spark.createDataFrame(list(given[d].items()), "v string, share double")
            shares[d] = stored(t.join(wanted, "v").where("share > 0").select("v", "share"))
        else:
            shares[d] = stored(t.select("v", F.pow("t", TEMPER).alias("share")))
    amount = keep * (df.agg(F.sum("tokens").alias("t")).first()["t"] or 0)
    for d in DIMENSIONS:
        df = hot_join(df, shares[d].select(F.col("v").alias(d)), d, "left_semi")
    df = stored(df.withColumn("weight", F.lit(float(keep))))
    amount = min(amount, float(df.agg(F.sum("tokens").alias("t")).first()["t"] or 0))
    for d in DIMENSIONS:
        held = df.groupBy(F.col(d).alias("v")).agg(F.sum("tokens").cast("double").alias("t"))
        goals[d] = stored(_capped(stored(held.join(shares[d], "v").select("v", "t", "share")), amount))
    for _ in range(ROUNDS_BEYOND):
        worst = 0.0
        for d in DIMENSIONS:
            held = df.groupBy(F.col(d).alias("v")).agg(F.sum(F.col("tokens") * F.least(F.lit(1.0), "weight")).alias("held"))
            factor = stored(held.join(goals[d], "v").select(F.col("v").alias(d), F.when(F.col("held") > 0, F.col("goal") / F.col("held")).otherwise(1.0).alias("factor"), F.abs(F.col("held") - F.col("goal")).alias("off")))
            worst = max(worst, factor.agg(F.max("off").alias("x")).first()["x"] or 0.0)
            new = stored(hot_join(df, factor.drop("off"), d).withColumn("weight", F.least(F.lit(LARGEST), F.col("weight") * F.col("factor"))).drop("factor"))
            dropped(df, factor)
            df = new
        if worst <= TOLERANCE_BEYOND * amount:
            break
    if worst > TOLERANCE_BEYOND * amount:
        warnings.warn(f"the mixture misses a share by {worst / amount:.4f} of all kept tokens", stacklevel=2)
    return df.select(*DIMENSIONS, "tokens", F.least(F.lit(1.0), "weight").alias("weight"))


def chance(id_col: str) -> Column:
    """A number in [0, 1) from the id: 52 bits of an md5 digest."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), 1, 13), 16, 10).cast("double") / float(1 << 52)


def mixed(documents: DataFrame, targets: dict[str, dict[str, float]] | None = None, keep: float = KEEP, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", details: bool = False) -> DataFrame:
    """The sampled documents with their own columns; `details` adds mix_tokens, mix_topic and mix_probability."""
    names = {c: f"mix_{c}" for c in ("n", *DIMENSIONS)}
    # columns of these names make way for the time being
    own = {c: f"own_{i}" if c in {*names.values(), "mix_weight"} else c for i, c in enumerate(documents.columns)}
    documents = documents.toDF(*own.values())
    docs = _with_cells(documents, text_col, source_col, lang_col, names)
    cells = stored(docs.groupBy(*(F.col(names[d]).alias(d) for d in DIMENSIONS)).agg(F.sum(names["n"]).alias("tokens")))
    if not cells.count():
        out = docs.withColumn("mix_weight", F.lit(0.0))
    else:
        few = cells.count() <= MOST_CELLS
        raked = rake_bounded(cells, _targets(cells, targets), keep) if few else stored(rake_tables(cells, targets, keep))
        weights = raked.select(*(F.col(d).alias(names[d]) for d in DIMENSIONS), F.col("weight").alias("mix_weight"))
        out = docs.join(F.broadcast(weights) if few else spread(weights), [names[d] for d in DIMENSIONS])
    out = out.where(chance(id_col) < F.col("mix_weight"))
    extra = {"mix_tokens": names["n"], "mix_topic": names["topic"], "mix_probability": "mix_weight"} if details else {}
    # a detail replaces a column of its name that the documents bring, such as that of an earlier mixture
    return out.select(*(F.col(hidden).alias(c) for c, hidden in own.items() if c not in extra), *(F.col(hidden).alias(c) for c, hidden in extra.items()))


def op8_mix_sources(spark, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, probability (9 digits) of the documents that the mixture keeps."""
    out = mixed(table(spark, sf_dir, "documents"), details=True)
    return out.select("doc_id", "source", "lang", F.col("mix_topic").alias("topic"), F.col("mix_tokens").cast("long").alias("n_tokens"), F.round("mix_probability", 9).alias("probability"))


def _oracle() -> str:
    """Bounded raking by its definition: capped goals of each value in closed form, then rounds over the marginals until they are met."""
    goals = ", ".join(
        f"""g_{d} AS (SELECT v, CASE WHEN level >= held / share THEN held ELSE share * max(level) FILTER (level < held / share) OVER () END AS goal FROM (
  SELECT *, (a.amount - coalesce(sum(held) OVER (ORDER BY held / share, v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(share) OVER (ORDER BY held / share, v ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM (SELECT {d} AS v, sum(tokens) AS held, pow(sum(tokens), {TEMPER}) / sum(pow(sum(tokens), {TEMPER})) OVER () AS share FROM cells GROUP BY {d}), amount a))"""
        for d in DIMENSIONS
    )
    step = "it WHERE i < {} AND worst > {}".format(MOST_ROUNDS, TOLERANCE)
    for i, d in enumerate(DIMENSIONS):
        step = f"(SELECT *, least(w{i} * g_{d} / h{i}, {LARGEST}) AS w{i + 1} FROM (SELECT *, sum(tokens * least(w{i}, 1)) OVER (PARTITION BY {d}) AS h{i} FROM {step}))"
    off = ", ".join(f"abs(h{i} - g_{d})" for i, d in enumerate(DIMENSIONS))
    return f"""
WITH RECURSIVE docs AS MATERIALIZED (SELECT *, CASE WHEN contains(x, ' | ') THEN 'table' WHEN n_tokens < 50 THEN 'note' WHEN n_tokens < 500 THEN 'article' ELSE 'long' END AS topic
  FROM (SELECT doc_id, source, lang, coalesce(text, '') AS x, length(coalesce(text, '')) - length(replace(replace(coalesce(text, ''), ' ', ''), chr(10), '')) + 1 AS n_tokens FROM documents)),
cells AS MATERIALIZED (SELECT coalesce(source, 'unknown') AS source, coalesce(lang, 'unknown') AS lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM docs GROUP BY ALL),
amount AS MATERIALIZED (SELECT {KEEP} * sum(tokens) AS amount FROM cells),
{goals},
it AS (
  SELECT 0 AS i, 1e300::DOUBLE AS worst, c.*, {", ".join(f"g_{d}.goal AS g_{d}" for d in DIMENSIONS)}, {KEEP}::DOUBLE AS w0 FROM cells c {" ".join(f"JOIN g_{d} ON g_{d}.v = c.{d}" for d in DIMENSIONS)}
  UNION ALL
  SELECT i + 1, max(greatest({off})) OVER () / (SELECT amount FROM amount), source, lang, topic, tokens, {", ".join(f"g_{d}" for d in DIMENSIONS)}, w{len(DIMENSIONS)} FROM {step}),
p AS (SELECT source, lang, topic, least(1.0, w0) AS p FROM it WHERE i = (SELECT max(i) FROM it))
SELECT d.doc_id, d.source, d.lang, d.topic, d.n_tokens, round(p.p, 9) AS probability FROM docs d JOIN p ON coalesce(d.source, 'unknown') = p.source AND coalesce(d.lang, 'unknown') = p.lang AND d.topic = p.topic
WHERE ('0x' || substr(md5('{SEED}:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0 < p.p
"""


ORACLE_SQL = _oracle()
