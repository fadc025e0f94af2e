"""Mixing sources to target weights by iterative proportional fitting (raking), DataFrame functions only.

The corpus is aggregated once into cells, one per combination of the dimensions' values; partial
aggregation shrinks a hot source before the shuffle.  A sweep scales the cells' weights to one
dimension's target marginal after another.  Sweeps run on the cell table, whose size is the number of
value combinations, not of documents.  A document's factor is its cell's raked weight over the cell's
weight; rate * factor is its expected number of copies, drawn by a hash of its id.

Targets of a dimension: {value: share}, or a number a for shares in proportion to (weight ** a), with
a = 0 for equal shares.  A value that a dictionary does not list (NULL too) keeps its observed share; the
listed shares of the values that have weight are scaled to the rest.  A value listed with 0 gets 0.

Defined cases: a NULL value of a dimension is a value of its own; a cell of weight 0 (only empty or
NULL texts) has factor 1; a NULL id draws with the text 'NULL'; an empty table gives an empty result;
repeated rows draw alike; the columns ``factor``, ``probability``, ``copies`` and ``sampled`` are set
anew if the input has them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecheck.llm.common import WORD_REGEX, bounded, stored

DIMS = ("source", "lang", "topic")
# target marginals of the registered query and of the pipeline
TARGETS: dict[str, dict | float] = {
    "source": 0.5,
    "lang": {"en": 0.5, "de": 0.18, "fr": 0.18, "es": 0.14},
    "topic": {"legal": 0.03, "contact": 0.07, "listing": 0.05, "prose": 0.85},
}
SWEEPS = 8
SAVE_EVERY = 4
COPY_BLOCK = 1024        # copies of a row that are listed at once
NONE = "\u0001null"      # stands for NULL in a cell's key


def topic(text: Column) -> Column:
    """A coarse topic by marks in the text."""
    t = F.coalesce(text, F.lit(""))
    return (F.when(t.contains("icense") | t.contains("rights reserved"), "legal").when(t.contains("@"), "contact")
            .when(t.contains(" | "), "listing").otherwise("prose"))


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_REGEX)), F.lit(0)).cast("long")


def _key(d: str) -> Column:
    return F.coalesce(F.col(d).cast("string"), F.lit(NONE))


def _share(d: str, target: dict | float) -> Column:
    """The unscaled target share of each value of a dimension; NULL for a value that the target does not list."""
    if isinstance(target, dict):
        return F.coalesce(*[F.when(F.col(f"k_{d}") == k, float(v)) for k, v in target.items()])
    return F.pow(F.col(f"__sum_{d}"), F.lit(float(target)))


def rake(cells: DataFrame, targets: dict[str, dict | float], sweeps: int = SWEEPS) -> DataFrame:
    """``cells`` (k_<dim> columns, ``mass``) with ``raked``, scaled to the targets; total mass is kept."""
    mass = cells.where("mass > 0")
    total = float(mass.agg(F.sum("mass")).first()[0] or 0)
    w = mass.withColumn("raked", F.col("mass").cast("double"))
    for d, t in targets.items():
        g = mass.groupBy(f"k_{d}").agg(F.sum("mass").cast("double").alias(f"__sum_{d}"))
        g = g.withColumn("p", _share(d, t))
        norm, other = g.agg(F.sum("p"), F.sum(F.when(F.col("p").isNull(), F.col(f"__sum_{d}")))).first()
        whole = (total if norm else other) or 1.0                       # values not listed have shares of this weight
        listed = F.col("p") / F.lit(norm or 1.0) * F.lit(1.0 - (other or 0.0) / whole)
        w = w.join(g.select(f"k_{d}", F.coalesce(listed, F.col(f"__sum_{d}") / F.lit(whole)).alias(f"g_{d}")), f"k_{d}")
    w = stored(w, "cells")
    for s in range(sweeps):
        for d in targets:
            now = F.sum("raked").over(Window.partitionBy(f"k_{d}"))
            w = w.withColumn("__now", now).withColumn(
                "raked", F.when(F.col("__now") > 0, F.col("raked") * (F.lit(total) * F.col(f"g_{d}") / F.col("__now"))).otherwise(0.0)).drop("__now")
        if s % SAVE_EVERY == SAVE_EVERY - 1 or s == sweeps - 1:
            w = stored(w, "raked")
    return w.select(*[f"k_{d}" for d in targets], "mass", "raked")


def uniform(id_col: Column, seed: int = 0) -> Column:
    """A number in [0, 1) from the id's text."""
    h = F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("NULL")), F.lit(f":{seed}")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def calibrate(docs: DataFrame, targets: dict[str, dict | float] | None = None, weight: str = "n_tokens",
              id_col: str = "doc_id", rate: float = 1.0, seed: int = 0, sweeps: int = SWEEPS) -> DataFrame:
    """``docs`` with factor, probability (of at least one copy, given rate * factor expected copies),
    copies and sampled.  Needs the dimensions' columns and the weight column."""
    targets = targets or TARGETS
    keys = [f"k_{d}" for d in targets]
    docs = docs.drop("factor", "probability", "copies", "sampled").withColumns({f"k_{d}": _key(d) for d in targets})
    cells = stored(docs.groupBy(*keys).agg(F.sum(F.coalesce(F.col(weight), F.lit(0))).cast("long").alias("mass")), "mass")
    cells = rake(cells, targets, sweeps).withColumn("factor", F.round(F.col("raked") / F.col("mass"), 9)).select(*keys, "factor")
    out = docs.join(bounded(stored(cells, "factors")), keys, "left").drop(*keys)
    expected = F.col("factor") * F.lit(float(rate))
    return (out.withColumn("factor", F.coalesce("factor", F.lit(1.0)))
            .withColumn("probability", F.least(F.lit(1.0), expected))
            .withColumn("copies", (F.floor(expected) + (uniform(F.col(id_col), seed) < expected - F.floor(expected)).cast("long")).cast("long"))
            .withColumn("sampled", F.col("copies") > 0))


def repeat(drawn: DataFrame) -> DataFrame:
    """Each row of ``calibrate`` as often as its ``copies`` say; none for 0 copies."""
    block, left = F.lit(COPY_BLOCK), F.col("copies") - F.col("__block") * F.lit(COPY_BLOCK)
    blocks = drawn.where("copies > 0").withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / block))))
    return blocks.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least(left, block.cast("long"))))).drop("__block", "__copy")


def features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with topic and n_tokens (words) of the text, set anew."""
    return docs.withColumns({"topic": topic(F.col(text_col)), "n_tokens": tokens(F.col(text_col))})
