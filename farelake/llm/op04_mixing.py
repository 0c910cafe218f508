"""Mixing a corpus to target domain weights by soft membership (DataFrame
functions only).

1. A naive Bayes classifier learns the labelled table's domains from the words
   of a bounded sample of labelled documents, and gives every document a
   posterior over the domains (rounded to three decimals: the membership).
2. Each document gets a rate, its expected number of copies. Rates are fitted
   so that the expected tokens of each domain, memberships times tokens times
   rates, match the targets: least squares with a small pull towards rate 1,
   by projected gradient (accelerated, preconditioned by tokens, projected onto
   rates >= 0). An iteration is one aggregation to a sum per domain. Documents
   of equal membership keep equal rates, so the aggregation runs over the
   distinct memberships; a rate is recomputed from the gradients so far, which
   are a few numbers an iteration, so no iteration writes anything.
3. ``copies`` realises the rate: its whole part, and one more with the
   probability of the rest, decided by a hash of the id.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import stage

SAMPLE_ROWS = 6000     # labelled rows that the classifier learns from
VOCABULARY = 80        # words that it keeps
MAX_DOMAINS = 64
MAX_ITERATIONS = 40
PULL = 1e-4            # towards rate 1
TOLERANCE = 2e-4       # of a domain's share
TARGETS = {"q1_t0": 0.92, "q0_t0": 0.05, "q1_t1": 0.02, "q0_t1": 0.01}


_TOKEN = r"\p{L}+|[!-/:-@|]{2}"  # a word, or two marks in a row


def _tokens(text: str, pattern: str = _TOKEN) -> Column:
    """Distinct tokens of the lower-cased text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.col(text)), F.lit(pattern), F.lit(0)))


def _pattern(words: list[str]) -> str:
    """Finds the given words as ``_TOKEN`` would, and all marks. Words are
    letters, so nothing is escaped; those of one first letter share a branch."""
    by: dict[str, list[str]] = {}
    for w in words:
        if w[0].isalpha():
            by.setdefault(w[0], []).append(w[1:])
    if not by:
        return r"[!-/:-@|]{2}"
    branches = "|".join(f"{c}(?:{'|'.join(sorted(rest, key=lambda x: (-len(x), x)))})" for c, rest in sorted(by.items()))
    return rf"(?<!\p{{L}})(?=[{''.join(sorted(by))}])(?:{branches})(?!\p{{L}})|[!-/:-@|]{{2}}"


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[list[str], DataFrame, list[float]]:
    """(domains, (word, weights), scores of a text without known words) from a
    sample of labelled rows: Bernoulli naive Bayes over the words that tell the
    domains apart best."""
    named = labels.where("quality is not null and toxic is not null").select(
        F.col("doc_id").alias("lid"), F.concat(F.lit("q"), F.col("quality").cast("string"), F.lit("_t"), F.col("toxic").cast("string")).alias("domain")).where("lid is not null")
    chosen = named.orderBy(F.xxhash64("lid"), "lid", "domain").limit(SAMPLE_ROWS)
    rows = stage(docs.join(F.broadcast(chosen), docs[id_col] == F.col("lid")).where(F.col(text_col).isNotNull()).select(
        "domain", F.explode(F.array_append(_tokens(text_col), F.lit(None).cast("string"))).alias("word")), "op4-sample")
    sizes = {r.domain: r.n for r in rows.where("word is null").groupBy("domain").agg(F.count(F.lit(1)).alias("n")).limit(MAX_DOMAINS + 1).collect()}
    if len(sizes) > MAX_DOMAINS:
        raise ValueError(f"more than {MAX_DOMAINS} domains")
    if not sizes:
        return [], rows.where("false"), []
    domains, total = sorted(sizes), sum(sizes.values())
    prior = [sizes[d] / total for d in domains]
    df = rows.where("word is not null").groupBy("word").agg(*[F.sum((F.col("domain") == d).cast("int")).alias(f"n{i}") for i, d in enumerate(domains)],
                                                            F.count(F.lit(1)).alias("n")).where("n >= 5")
    p = [(F.col(f"n{i}") + 0.5) / (sizes[d] + 1.0) for i, d in enumerate(domains)]
    # how far the domains lie apart in this word, by its evidence
    gain = sum((F.abs(F.col(f"n{i}") - F.col("n") * p) / F.sqrt(F.col("n") * p + 1.0) for i, p in enumerate(prior)), F.lit(0.0))
    apart = F.log(F.greatest(*p) / F.least(*p)) if len(p) > 1 else F.lit(0.0)
    # words that all domains use about equally often would only tell long texts from short ones
    chosen = df.where(apart >= 1.0).select("word", F.array(*p).alias("p"), gain.alias("gain")).orderBy(F.desc("gain"), "word").limit(VOCABULARY)
    weights = stage(chosen.select("word", F.transform("p", lambda x: F.log(x / (1.0 - x))).alias("w"),
                                  F.transform("p", lambda x: F.log(1.0 - x)).alias("absent")).coalesce(1), "op4-words")
    absent = weights.agg(*[F.sum(F.col("absent")[i]) for i in range(len(domains))]).first()
    return domains, weights.select("word", "w"), [math.log(x) + (y or 0.0) for x, y in zip(prior, absent)]


def memberships(docs: DataFrame, domains: list[str], weights: DataFrame, base: list[float],
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tokens, p) for every row; p has the domains' posteriors in order."""
    body = F.trim(F.coalesce(F.col(text_col), F.lit("")))
    pattern = _pattern([r.word for r in weights.select("word").collect()])  # at most VOCABULARY
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"),
                       F.when(F.length(body) == 0, 0).otherwise(F.size(F.split(body, r"\s+"))).cast("long").alias("tokens"),
                       F.coalesce(_tokens(text_col, pattern), F.array(F.lit(""))).alias("words"))
    hit = rows.select("rid", "id", "tokens", F.explode_outer("words").alias("word")).join(F.broadcast(weights), "word", "left")
    k = range(len(domains))
    score = hit.groupBy("rid", "id", "tokens").agg(*[F.coalesce(F.sum(F.col("w")[i]), F.lit(0.0)).alias(f"s{i}") for i in k])
    score = score.withColumns({f"s{i}": F.col(f"s{i}") + base[i] for i in k})
    top = F.greatest(*[f"s{i}" for i in k]) if len(domains) > 1 else F.col("s0")
    score = score.withColumn("top", top).withColumns({f"e{i}": F.exp(F.col(f"s{i}") - F.col("top")) for i in k})
    norm = sum((F.col(f"e{i}") for i in k), F.lit(0.0))
    return score.select("id", "tokens", F.array(*[F.round(F.col(f"e{i}") / norm, 3) for i in k]).alias("p"))


def _rate(history: list[list[float]], which: str) -> Column:
    """The rate after the recorded gradients: r, or the look-ahead point y at
    which the next gradient is taken."""
    if not history:
        return F.lit(1.0)
    steps = ", ".join(f"named_struct('e', array({', '.join(f'{float(x)!r}D' for x in e)}), 'b', {t / (t + 3.0)!r}D)" for t, e in enumerate(history))
    slope = "aggregate(zip_with(p, h.e, (u, v) -> u * v), 0D, (a, u) -> a + u)"
    r = f"greatest(0D, s.y - ({slope} + {PULL!r}D * (s.y - 1D)) / {1 + PULL!r}D)"
    return F.expr(f"aggregate(array({steps}), named_struct('r', 1D, 'y', 1D), (s, h) -> "
                  f"named_struct('r', {r}, 'y', {r} + h.b * ({r} - s.r))).{which}")


def fit_rates(groups: DataFrame, k: int, share: list[float], budget: float | None) -> tuple[list[list[float]], float]:
    """Gradients of the projected-gradient fit over ``groups`` (p, tokens), and
    the token budget. Without a budget the domain of the largest share is to
    be used once."""
    def totals(point: Column) -> list[float]:
        r = groups.select("p", "tokens", point.alias("y")).agg(*[F.sum(F.col("tokens") * F.col("p")[i] * F.col("y")).alias(f"a{i}") for i in range(k)]).first()
        return [float(x or 0.0) for x in r]
    now = totals(F.lit(1.0))
    scale = sum(now) or 1.0
    if budget is None:
        main = max(range(k), key=lambda i: share[i])
        budget = now[main] / share[main] if now[main] > 0 else scale
    want = [s * budget for s in share]
    history: list[list[float]] = []
    for _ in range(MAX_ITERATIONS):
        e = [(a - w) / scale for a, w in zip(now, want)]
        if max(map(abs, e)) < TOLERANCE:
            break
        history.append(e)
        now = totals(_rate(history, "y"))
    return history, budget


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float], budget: float | None = None,
        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tokens, p_<domain>..., rate, copies) for every row of ``docs``.

    Domains are ``q<quality>_t<toxic>`` of ``labels``; ``targets`` their shares
    of the tokens (scaled to sum 1 over the domains that occur; a domain
    without a target gets none). Null and empty texts have no tokens and the
    memberships of a text without known words. Without labelled rows there is
    no domain, and every rate is 1, as it is where no target applies. Rows that
    repeat an id get equal copies; other columns are ignored.
    """
    domains, weights, base = learn(docs, labels, id_col, text_col)
    share = [targets.get(d, 0.0) for d in domains]
    if not sum(share):
        body = F.trim(F.coalesce(F.col(text_col), F.lit("")))
        return docs.select(id_col, F.when(F.length(body) == 0, 0).otherwise(F.size(F.split(body, r"\s+"))).cast("long").alias("tokens"),
                           F.lit(1.0).alias("rate"), F.lit(1).cast("long").alias("copies"))
    member = stage(memberships(docs, domains, weights, base, id_col, text_col), "op4-members")
    groups = member.groupBy("p").agg(F.sum("tokens").alias("tokens"))
    groups = stage(groups.coalesce(max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 16)), "op4-groups")
    history, _ = fit_rates(groups, len(domains), [s / sum(share) for s in share], budget)
    unit = F.pmod(F.xxhash64(F.lit("mix"), "id"), F.lit(1 << 32)) / float(1 << 32)
    out = member.withColumn("rate", F.round(_rate(history, "r"), 6))
    return out.select(F.col("id").alias(id_col), "tokens", *[F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(domains)], "rate",
                      (F.floor("rate") + (unit < F.col("rate") - F.floor("rate")).cast("long")).alias("copies"))


def op4_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"), TARGETS)


def stage_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document as often as its copies say. Rows without
    an id stay once; rows that repeat one share its rate."""
    mixed = mix(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), TARGETS)
    n = mixed.where("doc_id is not null").groupBy(F.col("doc_id").alias("mixed_id")).agg(F.max("copies").alias("n_copies"))
    times = F.expr("explode(array_repeat(0, cast(coalesce(n_copies, 1) as int)))")
    return docs.join(n, F.col("doc_id") == F.col("mixed_id"), "left").select(*docs.columns, times.alias("time")).drop("time")
