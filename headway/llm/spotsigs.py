"""SpotSigs document fingerprints, and likeness by Jaccard over their signatures.

A signature is a common word (the anchor) with the chain of content words that follow it; a document's
fingerprint is the sorted set of its signatures. Sets are partitioned by length, so that a set need only
meet those of its own partition and the next: beyond, the ratio of lengths alone rules a pair out.

Everything is DataFrame operations. As every common word is an anchor, the j-th anchor at place i has
i - j content words before it: chains are read off the array of content words by arithmetic.

Defined results
- Words are lower-cased runs of letters and digits. A chain has `chain` content words, `step` apart.
- A text without a complete chain: each of its words is a signature. Without words: its hash is the only
  one. Equal texts so have equal fingerprints, and null counts as the empty text.
- Likeness is the exact Jaccard similarity of two signature sets, from 0 to 1.
- The next document is the next in the order of id, then text; null ids come first, and after the last
  comes the first. Repeated rows follow each other. Empty tables: no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headway.llm.shared import settle, text_or_empty

#: The common words of English, German, French and Spanish that anchor chains.
ANCHORS = (
    "the of and to in a is that it for was on be with as by this are "
    "der die das und in den von zu ist mit sich des auf für ein eine "
    "le la les de et des un une du en que qui pour dans est par "
    "el los las de y en que un una del por con se para es"
).split()

GROUPS = 128


def with_signatures(df: DataFrame, text_col: str, out: str, chain: int = 3, step: int = 1) -> DataFrame:
    """Adds the sorted set of 32-bit signatures of a text that is not null."""
    words, content, anchors = f"{out}__words", f"{out}__content", f"{out}__anchors"
    common = lambda w: w.isin(*dict.fromkeys(ANCHORS))
    split = F.filter(F.split(F.lower(F.col(text_col)), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    placed = F.transform(F.col(words), lambda w, i: F.when(common(w), F.struct(w.alias("w"), i.alias("i"))))

    def signature(anchor: Column, j: Column) -> Column:
        first = anchor["i"] - j
        links = [F.get(F.col(content), first + k * step) for k in range(chain)]
        return F.when(links[-1].isNotNull(), F.hash(anchor["w"], *links))

    chains = F.filter(F.transform(F.col(anchors), signature), lambda s: s.isNotNull())
    single = F.transform(F.col(words), lambda w: F.hash(w))
    found = (
        df.withColumn(words, split)
        .withColumn(content, F.filter(F.col(words), lambda w: ~common(w)))
        .withColumn(anchors, F.filter(placed, lambda a: a.isNotNull()))
        .withColumn(out, chains)
        .withColumn(
            out,
            F.when(F.size(out) > 0, F.col(out)).when(F.size(words) > 0, single).otherwise(F.array(F.hash(text_col))),
        )
    )
    return found.withColumn(out, F.array_sort(F.array_distinct(out))).drop(words, content, anchors)


def fingerprint(signatures: Column) -> Column:
    """The signature set as text: eight hexadecimal digits of each, in order."""
    return F.array_join(F.transform(signatures, lambda s: F.lower(F.lpad(F.hex(s.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    shared = F.size(F.array_intersect(a, b)).cast("double")
    return shared / (F.size(a) + F.size(b) - shared)


def length_partition(n: Column, threshold: float) -> Column:
    """Partition of a set length: lengths of two partitions that do not adjoin differ by more than the
    threshold allows."""
    return F.floor(F.log(n.cast("double")) / F.lit(-math.log(threshold))).cast("int")


def near_pairs(sets: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", set_col: str = "signatures") -> DataFrame:
    """Pairs (left_id, right_id, likeness) of different sets at or above the threshold.

    Equal sets stand for the least id that has them. A set is filed in its length partition under its
    rarest signatures, as many as two sets at the threshold can't both miss, and looks itself up in its own
    partition and the one above. The length ratio prunes a pair before its sets are compared.
    """
    sets = sets.where(F.col(set_col).isNotNull() & (F.size(set_col) > 0))
    one = settle(sets.groupBy(F.col(set_col).alias("s")).agg(F.min(id_col).alias("id")), "spot-sets")
    places = one.select("id", F.size("s").alias("n"), F.explode("s").alias("sig"))
    rare = places.join(places.groupBy("sig").agg(F.count("*").alias("df")), "sig")
    ranked = rare.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy("df", "sig")))
    # ceil on the product as computed, less an epsilon: rounding must not shorten the filed part.
    filed = ranked.where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1)
    part = length_partition(F.col("n"), threshold)
    index = filed.select("sig", F.col("id").alias("right_id"), F.col("n").alias("right_n"), part.alias("part"))
    asked = filed.select("sig", F.col("id").alias("left_id"), F.col("n").alias("left_n"), F.explode(F.array(part, part + 1)).alias("part"))
    longer = (F.col("right_n") > F.col("left_n")) | ((F.col("right_n") == F.col("left_n")) & (F.col("right_id") > F.col("left_id")))
    met = (
        asked.join(index, ["sig", "part"])
        .where(longer & (F.col("left_n") >= F.col("right_n") * threshold - 1e-9))
        .select("left_id", "right_id")
        .distinct()
    )
    left = one.select(F.col("id").alias("left_id"), F.col("s").alias("a"))
    right = one.select(F.col("id").alias("right_id"), F.col("s").alias("b"))
    compared = met.join(left, "left_id").join(right, "right_id").withColumn("likeness", likeness(F.col("a"), F.col("b")))
    return compared.where(F.col("likeness") >= threshold).select("left_id", "right_id", "likeness")


def with_next(docs: DataFrame, carried: list[str], rows_per_bucket: int = 500) -> DataFrame:
    """Rows (doc_id, text and more) with next_<c> of each carried column: its value in the next row.

    Rows are dealt to buckets of neighbouring ids, each ordered on its own; the last row of a bucket gets
    the first row of the next bucket that has any. Quantiles of the ids make 128 groups, each is cut into
    equal ranges of ids, and the driver sees one id of each group. No window spans more than a bucket or
    the bucket list of a group.
    """
    measured = docs.agg(
        F.count("*").alias("n"),
        F.percentile_approx("doc_id", [i / GROUPS for i in range(GROUPS + 1)], 10_000).alias("q"),
    ).first()
    bounds = sorted(set(measured.q or [])) or [0]
    cuts = max(1, math.ceil(measured.n / max(1, len(bounds)) / rows_per_bucket))
    edges = F.lit(bounds)
    place = F.size(F.filter(edges, lambda b: b <= F.col("doc_id")))
    group = F.when(F.col("doc_id").isNull(), 0).otherwise(place)
    low, high = F.get(edges, F.col("g") - 1), F.get(edges, F.col("g"))
    share = (F.col("doc_id") - low).cast("double") / (high - low).cast("double")
    cut = F.when(low.isNull() | high.isNull(), 0).otherwise(F.floor(share * cuts))

    def dealt(df: DataFrame) -> DataFrame:
        return df.withColumn("g", group).withColumn("c", F.least(F.coalesce(cut, F.lit(0)), F.lit(cuts - 1)).cast("int"))

    firsts = settle(
        dealt(docs.select("doc_id")).groupBy("g", "c").agg(F.min("doc_id").alias("first_id")), "spot-buckets"
    )
    heads = sorted((r.g, r.c, r.first_id) for r in firsts.groupBy("g").agg(F.min(F.struct("c", "first_id")).alias("s")).select("g", "s.*").collect())
    after = {a[0]: b[2] for a, b in zip(heads, heads[1:] + heads[:1], strict=True)}
    if not heads:
        return docs.withColumns({f"next_{c}": F.col(c) for c in carried})
    by_group = docs.sparkSession.createDataFrame(list(after.items()), "g int, group_next long")
    within = F.lead("first_id").over(Window.partitionBy("g").orderBy("c"))
    # Written, so that Spark knows how small it is before it plans the join with the texts.
    following = settle(
        firsts.withColumn("within", within)
        .join(F.broadcast(by_group), "g")
        .select("g", "c", F.coalesce("within", "group_next").alias("n_id")),
        "spot-following",
    )
    row = F.struct(F.col("text").alias("k"), *[F.col(c).alias(f"v_{c}") for c in carried])
    starts = docs.select(F.col("doc_id").alias("n_id"), row.alias("row"))
    # Null ids are a first row like any other: hence the null-safe comparison.
    borders = (
        following.join(starts, following.n_id.eqNullSafe(starts.n_id))
        .groupBy("g", "c")
        .agg(F.min_by("row", "row.k").alias("border"))
    )
    order = Window.partitionBy("g", "c").orderBy("doc_id", "text")
    led = dealt(docs).withColumns({f"led_{c}": F.lead(c).over(order) for c in carried} | {"last": F.lead(F.lit(1)).over(order).isNull()})
    joined = led.join(borders, ["g", "c"], "left")
    nexts = {f"next_{c}": F.when(F.col("last"), F.col(f"border.v_{c}")).otherwise(F.col(f"led_{c}")) for c in carried}
    return joined.withColumns(nexts).select(*docs.columns, *nexts)


def edited_likeness(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last quarter is the start of the next.

    doc_id, n_chars, edited (text), signatures, edited_signatures, near_edited, near_next and
    length_part, the partition by set length.
    """
    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty(F.col("text").cast("string")).alias("text"))
    rows = with_signatures(rows, "text", "signatures")
    paired = with_next(rows, ["text", "signatures"])
    n, quarter = F.length("text"), F.floor(F.length("text") / 4).cast("int")
    edited = paired.withColumn("n_chars", n.cast("long")).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next_text", F.lit(1), quarter))
    )
    edited = with_signatures(edited.drop("text", "next_text"), "edited", "edited_signatures")
    return edited.select(
        "doc_id",
        "n_chars",
        "edited",
        "signatures",
        "edited_signatures",
        likeness(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"),
        likeness(F.col("signatures"), F.col("next_signatures")).alias("near_next"),
        length_partition(F.size("signatures"), threshold).alias("length_part"),
    )
