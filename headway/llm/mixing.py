"""Mixing sources to target weights: token weights raked to source, language and topic marginals by
iterative proportional fitting, then documents sampled by calibrated probabilities.

The fitted weight of a cell is its tokens times a factor of its source, of its language and of its
topic. Cells are counted before anything else, and kept as one row per source with its cells in an
array, of at most languages x topics entries. A sweep then needs no shuffle for the sources: a source's
factor follows from its own row, and what languages and topics receive is summed to languages x topics
numbers, which the driver fits. Documents meet their source's factor in one join of narrow columns.

Everything is DataFrame operations; the text is read for the counts of words and topic marks only.

Defined results
- Tokens are runs without ASCII white space; null text has none. A null source, language or topic is the
  category '(none)'.
- A document's topic is the one whose mark comes most often for its length, at least once in 50
  words; ties to the first by name; otherwise 'general'. A column `topic` of the input is not used.
- weight is wanted tokens per token of the document's cell; its probability is min(1, scale x weight),
  the scale such that the expected number of tokens is `budget` of all. A document is drawn if a hash
  of its id and the seed falls below it: the same on every run, and alike for rows that share an id.
- A category without tokens has weight 0. Repeated rows count again. Empty tables: no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.shared import settle, text_or_empty

NONE = "(none)"
#: Marks of the topics that the documents are told apart by.
TOPICS = {
    "code": r"[{};=<>]",
    "contact": r"@|\+[0-9]|[0-9]{4}",
    "emphatic": r"!!|[A-ZÄÖÜÉÈ]{4}",
    "tabular": r"\|",
}
TOKEN = r"[^\x20\x09-\x0D]+"
MOST_MARGINS = 100_000


def topic_of(text: Column, n_tokens: Column, topics: dict[str, str]) -> Column:
    counted = [F.struct(F.regexp_count(text, F.lit(p)).alias("n"), F.lit(t).alias("topic")) for t, p in topics.items()]
    ranked = F.array_sort(
        F.array(*counted),
        lambda a, b: F.when(a["n"] != b["n"], b["n"] - a["n"]).otherwise(F.when(a["topic"] < b["topic"], -1).otherwise(1)),
    )
    best = ranked[0]
    return F.when(best["n"] * 50 >= F.greatest(n_tokens, F.lit(1)), best["topic"]).otherwise("general")


def described(docs: DataFrame, topics: dict[str, str] = TOPICS, row: str | None = None) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens of every document; under the name `row`, all its columns."""
    text = text_or_empty(F.col("text").cast("string"))
    named = [F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(c) for c in ("source", "lang")]
    counted = docs.select(
        "doc_id",
        *named,
        text.alias("text"),
        F.regexp_count(text, F.lit(TOKEN)).cast("long").alias("n_tokens"),
        *([F.struct(*docs.columns).alias(row)] if row else []),
    )
    topic = topic_of(F.col("text"), F.col("n_tokens"), topics).alias("topic")
    return counted.select("doc_id", "source", "lang", topic, "n_tokens", *([row] if row else []))


def tempered(totals: dict[str, float], power: float) -> dict[str, float]:
    """Shares proportional to a power of the observed tokens."""
    raised = {k: v**power if v > 0 else 0.0 for k, v in totals.items()}
    whole = math.fsum(raised.values())
    return {k: v / whole for k, v in raised.items()} if whole else {k: 0.0 for k in totals}


def _lookup(values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


class Fit:
    """Factors of a fitted mix: by source a table, by language and topic numbers; and the scale."""

    def __init__(self, sources: DataFrame, lang: dict[str, float], topic: dict[str, float], scale: float, sweeps: int):
        self.sources, self.lang, self.topic, self.scale, self.sweeps = sources, lang, topic, scale, sweeps


def rake(
    docs: DataFrame,
    power: dict[str, float],
    targets: dict[str, dict[str, float]] | None = None,
    budget: float = 0.5,
    tolerance: float = 1e-6,
    most_sweeps: int = 60,
) -> Fit | None:
    """Fits described documents to the targets; null if they hold no tokens.

    The sweeps end when all margins meet their targets within the tolerance, or when ten more no longer
    bring them closer: targets that no weights can meet, as empty cells can cause, are met as nearly as
    the sweeps get.

    targets: shares of `lang` and `topic` by category; what is not given, and the sources, which may be
    too many for that, are tempered: proportional to observed tokens to the given power.
    """
    cells = docs.groupBy("source", "lang", "topic").agg(F.sum("n_tokens").cast("double").alias("tokens")).where("tokens > 0")
    rows = settle(
        cells.groupBy("source").agg(
            F.array_sort(F.collect_list(F.struct("lang", "topic", "tokens"))).alias("cells"), F.sum("tokens").alias("tokens")
        ),
        "mix-cells",
    )
    margins = (
        rows.select(F.explode("cells").alias("c")).groupBy("c.lang", "c.topic").agg(F.sum("c.tokens").alias("tokens"))
    )
    observed = {(r.lang, r.topic): r.tokens for r in margins.limit(MOST_MARGINS + 1).collect()}
    if not observed:
        return None
    if len(observed) > MOST_MARGINS:
        raise ValueError(f"more than {MOST_MARGINS} pairs of language and topic")
    whole = math.fsum(observed.values())
    totals: dict[str, dict[str, float]] = {"lang": {}, "topic": {}}
    for (lang, topic), n in sorted(observed.items()):
        totals["lang"][lang] = totals["lang"].get(lang, 0) + n
        totals["topic"][topic] = totals["topic"].get(topic, 0) + n
    wanted = {d: (targets or {}).get(d) or tempered(totals[d], power[d]) for d in totals}
    raised = F.pow("tokens", F.lit(float(power["source"])))
    all_raised = rows.agg(F.sum(raised)).first()[0]
    rows = rows.withColumn("wanted", raised / F.lit(all_raised) * F.lit(whole))
    lang, topic = dict.fromkeys(totals["lang"], 1.0), dict.fromkeys(totals["topic"], 1.0)

    def fitted(lang: dict[str, float], topic: dict[str, float]) -> DataFrame:
        by_lang, by_topic = _lookup(lang), _lookup(topic)
        fits = F.transform(
            "cells",
            lambda c: F.struct(
                c["lang"].alias("lang"), c["topic"].alias("topic"), c["tokens"].alias("tokens"),
                (F.element_at(by_lang, c["lang"]) * F.element_at(by_topic, c["topic"])).alias("factor"),
            ),
        )
        got = F.aggregate(F.col("fits"), F.lit(0.0), lambda a, c: a + c["tokens"] * c["factor"])
        return rows.withColumn("fits", fits).withColumn("got", got).withColumn(
            "factor", F.when(F.col("got") > 0, F.col("wanted") / F.col("got")).otherwise(0.0)
        )

    sweeps, history = 0, []
    for sweeps in range(1, most_sweeps + 1):
        spread = fitted(lang, topic).select("factor", F.explode("fits").alias("c"))
        received = {
            (r.lang, r.topic): r.tokens
            for r in spread.groupBy("c.lang", "c.topic").agg(F.sum(F.col("factor") * F.col("c.tokens") * F.col("c.factor")).alias("tokens")).collect()
        }
        worst = 0.0
        for place, (name, factors) in enumerate((("lang", lang), ("topic", topic))):
            sums: dict[str, float] = dict.fromkeys(factors, 0.0)
            for key, n in sorted(received.items()):
                sums[key[place]] += n
            change = {k: wanted[name].get(k, 0.0) * whole / v if v > 0 else 0.0 for k, v in sums.items()}
            worst = max(worst, *(abs(x - 1) for k, x in change.items() if sums[k] > 0))
            for k, x in change.items():
                factors[k] *= x
            received = {key: n * change[key[place]] for key, n in received.items()}
        history.append(worst)
        if worst < tolerance or (sweeps > 10 and worst > 0.9 * history[-10]):
            break

    final = fitted(lang, topic)
    weights = settle(final.select("source", F.col("factor").alias("source_factor"), "fits"), "mix-factors")
    spread = weights.select(F.explode("fits").alias("c"), "source_factor").select(
        F.col("c.tokens").alias("tokens"), (F.col("source_factor") * F.col("c.factor")).alias("weight")
    )
    # The scale at which the expected tokens meet the budget, cells that are taken whole apart.
    scale, taken = 0.0, -1.0
    while True:
        whole_cell = F.col("weight") * F.lit(scale) >= 1
        r = spread.agg(
            F.coalesce(F.sum(F.when(whole_cell, F.col("tokens"))), F.lit(0.0)).alias("taken"),
            F.coalesce(F.sum(F.when(~whole_cell, F.col("tokens") * F.col("weight"))), F.lit(0.0)).alias("rest"),
        ).first()
        if r.taken <= taken or r.rest <= 0:
            break
        taken = r.taken
        scale = max(scale, (budget * whole - taken) / r.rest)
    return Fit(weights.select("source", "source_factor"), lang, topic, scale, sweeps)


def with_probabilities(docs: DataFrame, fit: Fit | None, seed: int = 0) -> DataFrame:
    """Described documents with weight, probability and whether they are drawn."""
    if fit is None:
        zero = {"weight": F.lit(0.0), "probability": F.lit(0.0), "sampled": F.lit(False)}
        return docs.withColumns(zero)
    weight = (
        F.coalesce("source_factor", F.lit(0.0))
        * F.coalesce(F.element_at(_lookup(fit.lang), F.col("lang")), F.lit(0.0))
        * F.coalesce(F.element_at(_lookup(fit.topic), F.col("topic")), F.lit(0.0))
    )
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return (
        docs.join(fit.sources, "source", "left")
        .withColumn("weight", weight)
        .drop("source_factor")
        .withColumn("probability", F.least(F.lit(1.0), F.col("weight") * F.lit(fit.scale)))
        .withColumn("sampled", drawn < F.col("probability"))
    )


def drawn(docs: DataFrame, power: dict[str, float], budget: float = 0.5, seed: int = 0, **options: object) -> DataFrame:
    """The documents that are drawn, with their own columns."""
    fit = rake(settle(described(docs), "mix-documents"), power, budget=budget, **options)
    return with_probabilities(described(docs, row="whole"), fit, seed).where("sampled").select("whole.*")


def mix(docs: DataFrame, power: dict[str, float], budget: float = 0.5, seed: int = 0, **options: object) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, weight, probability, sampled of every document."""
    facts = settle(described(docs), "mix-documents")
    return with_probabilities(facts, rake(facts, power, budget=budget, **options), seed).select(
        "doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "sampled"
    )
