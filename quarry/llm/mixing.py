"""Mixing sources to target weights by Poisson replication (DataFrame functions only).

Every source gets a mean repetition rate ``weight share x target mass / source mass``.
A row draws its number of copies by inverting a Poisson distribution at a uniform number
hashed from (seed, key): no state, the same row gets the same copies on any cluster and
after a lost executor. Rates above 1 are drawn as a sum of independent Poisson parts of
mean at most 1, so the inversion table has a fixed length and no rate is too large.
Copies are dealt to tasks, and ordered inside them, by a hash of (seed, key, copy): a
global shuffle in one exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: terms of the inverse table: P(N > 18) < 2**-53 for a mean of at most 1
TERMS = 18
#: hex digits of the md5 behind a uniform number; 48 bits are exact in a double
DIGITS = 12
#: sources up to which the rate table is broadcast (about 300 bytes a row)
BROADCAST_SOURCES = 20_000


def uniform(*parts: Column) -> Column:
    """Uniform double in [0, 1) from the md5 of the parts joined by '|'."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("\\N")) for p in parts]))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("bigint") / F.lit(float(16 ** DIGITS))


def source_masses(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """(source, mass): characters per source, a null text counting 0."""
    return docs.groupBy(F.col(source).alias("source")).agg(
        F.coalesce(F.sum(F.length(text)), F.lit(0)).cast("bigint").alias("mass"))


def tempered_weights(masses: DataFrame, alpha: float) -> DataFrame:
    """(source, weight): target weight ``mass ** alpha`` (0 for a source without text)."""
    return masses.select("source", F.when(F.col("mass") > 0, F.pow(F.col("mass").cast("double"), F.lit(alpha)))
                         .otherwise(0.0).alias("weight"))


def repetition_rates(masses: DataFrame, weights: DataFrame, epochs: float = 1.0) -> DataFrame:
    """(source, rate, parts, cdf): the target is ``epochs`` times the whole mass, split by
    the weights' shares; ``cdf`` is the table of one of ``parts`` Poisson parts.
    A source without weight, with weight 0 or without mass has rate 0."""
    w = weights.select(F.col("source").alias("_ws"), F.col("weight"))
    joined = masses.join(w, F.col("source").eqNullSafe(F.col("_ws")), "left").select(
        "source", "mass", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    # two scalars come to the driver; everything by source stays a table
    total, weight_sum = joined.agg(F.sum("mass").cast("double"), F.sum("weight")).first()
    if not total or not weight_sum:
        total, weight_sum = 0.0, 1.0
    rate = F.when(F.col("mass") > 0, F.col("weight") / F.lit(weight_sum) * F.lit(total) * F.lit(float(epochs))
                  / F.col("mass")).otherwise(0.0)
    part = F.col("rate") / F.col("parts")
    term = lambda k: F.exp(-part) * F.pow(part, k.cast("double")) / F.factorial(k)
    cdf = F.aggregate(
        F.sequence(F.lit(0), F.lit(TERMS)),
        F.expr("cast(array() as array<double>)"),
        lambda acc, k: F.array_append(acc, F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0.0)) + term(k)),
    )
    return (joined
            .select("source", rate.alias("rate"))
            .withColumn("parts", F.greatest(F.ceil("rate"), F.lit(1)).cast("int"))
            .withColumn("cdf", cdf))


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, *, alpha: float = 0.5, epochs: float = 1.0,
                key: str = "doc_id", source: str = "source", text: str = "text", seed: int = 17) -> DataFrame:
    """Rows of ``docs`` replicated to the target mixture, globally shuffled.

    Adds ``mix_rate`` (double), ``mix_copy`` (0-based) and ``mix_order`` (the hash whose
    order is the shuffle). ``weights`` is (source, weight); by default sources are
    tempered, ``mass ** alpha``. Results in the odd cases: a null source is a source of
    its own; null and empty texts have mass 0 but are replicated like their source; a
    source with no text at all is left out; rows with equal keys draw equal counts; an
    empty table gives an empty result; extra columns pass through, and a column that has
    one of the three added names is replaced.
    """
    masses = source_masses(docs, source, text)
    rates = repetition_rates(masses, weights if weights is not None else tempered_weights(masses, alpha), epochs)
    rates = rates.select(F.col("source").alias("_mix_source"), F.col("rate").alias("_mix_rate"),
                         F.col("parts").alias("_mix_parts"), F.col("cdf").alias("_mix_cdf")).where("_mix_rate > 0")
    if masses.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)  # beyond that a shuffled join; AQE splits a hot source
    k = F.col(key)
    # the source's own name stays out of the seed: a copy count depends on key and rate only
    drawn = F.aggregate(
        F.sequence(F.lit(1), F.col("_mix_parts")), F.lit(0),
        lambda acc, part: acc + F.size(F.filter("_mix_cdf", lambda c: c <= uniform(F.lit(seed), k, part))))
    out = (docs.drop("mix_rate", "mix_copy", "mix_order")
           .join(rates, docs[source].eqNullSafe(F.col("_mix_source")))
           .withColumn("_mix_n", drawn)
           .where("_mix_n > 0")
           .withColumn("mix_copy", F.explode(F.sequence(F.lit(0), F.col("_mix_n") - 1)))
           .withColumn("mix_order", F.md5(F.concat_ws("|", F.lit(f"order{seed}"), k.cast("string"),
                                                      F.col("mix_copy").cast("string"))))
           .withColumnRenamed("_mix_rate", "mix_rate")
           .drop("_mix_source", "_mix_parts", "_mix_cdf", "_mix_n"))
    # equal and null keys have equal hashes: the text's own spreads them over the tasks
    return out.repartition("mix_order", F.xxhash64(F.col(text))).sortWithinPartitions("mix_order")
