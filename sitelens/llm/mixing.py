"""Mixing sources to target weights by Efraimidis-Spirakis sampling (native).

Sizes are words.  Every source gets a target number of words; the mix takes a
document once per complete epoch of its source, and the fractional epoch takes
documents in the order of exponential keys ``-ln(u) / weight`` up to the
remaining budget.  ``u`` is a hash of seed and document, so reruns agree.

The prefix sums need no window over a whole source: keys fall into ranges,
range totals are pre-aggregated and summed per source, and the range where the
budget ends is narrowed until it holds few documents; a window adds up only
those.  The last slot goes to the unselected document that fits the remaining
gap best.

Defined cases: NULL or empty texts have size 0 and are taken 0 times; a NULL
source is a source of its own, last in order; a NULL, non-finite or
non-positive weight counts as the least weight; repeated rows (same id and
text) count each; an empty table gives an empty result.  Driver-side are only
one row per round of the water filling (three sums); the source table itself
stays a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, text_of

WORD = r"[^\x20\x09-\x0D]+"
LEAST_WEIGHT = 0.01
#: Weight of a document without a label.
UNLABELLED = 0.6
#: Ranges per narrowing step, rows at which a range is small, and the most steps (then only equal keys are left).
RANGES = 256
EDGE_ROWS = 20_000
MAX_LEVELS = 6


def n_words(col: Column) -> Column:
    return F.regexp_count(F.coalesce(col, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, shares=(5.0, 2.0, 1.0), at_most: float = 3.0) -> DataFrame:
    """(source, n_docs, source_size) -> plus target.

    Sources in code point order (NULL last) get the weights in turn; the sum
    of all sizes is shared by weight, a target stops at ``at_most`` times its
    source's size, and the excess is shared again until none is above.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    pos = (F.row_number().over(order) - 1) % len(shares)
    w = stored(sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in shares]), (pos + 1).cast("int")))
               .withColumn("cap", F.col("source_size") * F.lit(float(at_most))), "mix-sources")
    total = w.agg(F.sum("source_size")).first()[0] or 0
    level, capped = None, -1
    while True:
        full = F.lit(False) if level is None else F.col("cap") <= F.lit(level) * F.col("w")
        r = w.agg(F.sum(F.when(full, F.col("cap")).otherwise(0.0)).alias("held"),
                  F.sum(F.when(full, 0.0).otherwise(F.col("w"))).alias("open"),
                  F.count_if(full).alias("n")).first()
        if r["n"] == capped or not r["open"]:
            break
        capped, level = r["n"], (total - r["held"]) / r["open"]
    target = F.col("cap") if level is None else F.least(F.col("cap"), F.lit(float(level)) * F.col("w"))
    return w.select("source", "n_docs", "source_size", target.cast("double").alias("target"))


def mix(docs: DataFrame, weight: Column | None = None, labels: DataFrame | None = None, seed: int = 17,
        shares=(5.0, 2.0, 1.0), at_most: float = 3.0) -> DataFrame:
    """Per row of ``docs``: doc_id, source, size, source_size, target, taken (words), copies.

    The quality weight of a document (larger is taken earlier) is ``weight`` (default 1), times
    its weight by ``labels`` if they are given.
    """
    # only ids, sizes and hashes go on from here; texts are read once and never move
    wt = F.lit(1.0) if weight is None else weight.cast("double")
    d = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64(text_of()).alias("tie"), wt.alias("w"))
    if labels is not None:
        d = d.join(label_weights(labels), "doc_id", "left").withColumn("w", F.col("w") * F.coalesce("label_weight", F.lit(UNLABELLED)))
    w = F.when(F.col("w").isNull() | F.isnan("w") | (F.col("w") > 1e6), F.lit(LEAST_WEIGHT)).otherwise(F.greatest("w", F.lit(LEAST_WEIGHT)))
    u = (F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("tie")).bitwiseAND(F.lit((1 << 52) - 1)) + 0.5) / float(1 << 52)
    d = stored(d.select("doc_id", "source", "size", (-F.log(u) / w).alias("key"), "tie"), "mix-docs")
    sizes = d.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    t = source_targets(sizes, shares, at_most)
    t = t.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-9)).otherwise(0))
    t = stored(t.withColumn("budget", F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * F.col("source_size")))
               .withColumn("sid", F.xxhash64(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))), "mix-targets")
    few = _few(t)

    def by_source(x: DataFrame, per_source: DataFrame) -> DataFrame:
        return x.join(F.broadcast(per_source) if few else per_source, "sid", "left")

    x = d.withColumn("sid", F.xxhash64(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))) \
         .withColumn("z", 1 - F.exp(-F.col("key")))
    # the key range [lo, hi) per source in which the budget ends, narrowed until it holds few rows
    edge = t.select("sid", "budget", F.lit(0.0).alias("lo"), F.lit(2.0).alias("hi"), F.lit(0).cast("double").alias("before"))
    run = Window.partitionBy("sid").orderBy("part")
    for _ in range(MAX_LEVELS):
        width = (F.col("hi") - F.col("lo")) / RANGES
        tot = (by_source(x, edge).where((F.col("z") >= F.col("lo")) & (F.col("z") < F.col("hi")))
               .groupBy("sid", "budget", "lo", "hi", "before", F.floor((F.col("z") - F.col("lo")) / width).alias("part"))
               .agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n")))
        tot = tot.withColumn("b", F.sum("s").over(run) - F.col("s") + F.col("before"))
        edge = stored(tot.where((F.col("b") <= F.col("budget")) & (F.col("b") + F.col("s") > F.col("budget")))
                      .select("sid", "budget", (F.col("lo") + F.col("part") * width).alias("lo"),
                              (F.col("lo") + (F.col("part") + 1) * width).alias("hi"), F.col("b").alias("before"), "n"), "mix-edge")
        if (edge.agg(F.max("n")).first()[0] or 0) <= EDGE_ROWS:
            break
        edge = edge.drop("n")
    here = F.struct("key", "doc_id", "tie")
    order = ["key", "doc_id", "tie"]
    inside = Window.partitionBy("sid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    at = stored(x.join(F.broadcast(edge) if few else edge, "sid")
                .where((F.col("z") >= F.col("lo")) & (F.col("z") < F.col("hi")))
                .withColumn("left", F.col("budget") - F.col("before") - (F.sum("size").over(inside) - F.col("size")))
                .where(F.col("left") < F.col("size"))
                .groupBy("sid").agg(F.min(here).alias("cut"), F.max("left").alias("gap")), "mix-cut")
    y = by_source(by_source(x, at), t.select("sid", "source_size", "target", "epochs", "budget"))
    y = y.withColumn("in", F.coalesce(here < F.col("cut"), F.lit(False)))
    # the last slot: the unselected document nearest to the gap, when that is nearer than nothing
    off = F.abs(F.col("gap") - F.col("size"))
    last = stored(y.where(~F.col("in") & F.col("gap").isNotNull() & (F.col("size") > 0) & (off < F.col("gap")))
                  .groupBy("sid").agg(F.min(F.struct(off.alias("off"), *order)).alias("last")), "mix-last")
    y = by_source(y, last)
    chosen = F.coalesce((F.col("last.key") == F.col("key")) & F.col("last.doc_id").eqNullSafe(F.col("doc_id"))
                        & (F.col("last.tie") == F.col("tie")), F.lit(False))
    copies = (F.col("epochs") + F.when(F.col("in") | chosen, 1).otherwise(0)).cast("long")
    copies = F.when(F.col("size") > 0, copies).otherwise(F.lit(0).cast("long"))
    return y.select("doc_id", "source", "size", "source_size", "target", "key", "tie",
                    (copies * F.col("size")).alias("taken"), copies.alias("copies"))


def _few(t: DataFrame, rows: int = 100_000) -> bool:
    """Whether a per-source table is small enough to broadcast (narrow rows)."""
    return t.limit(rows + 1).count() <= rows


def label_weights(labels: DataFrame) -> DataFrame:
    """(doc_id, label_weight): good 1, bad 0.2; of several labels the worst counts."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("q"))
    return known.select("doc_id", F.when(F.col("q") == 1, 1.0).otherwise(0.2).alias("label_weight"))


def mixed(docs: DataFrame, labels: DataFrame, seed: int = 17) -> DataFrame:
    """Rows of ``docs``, each repeated as often as the mix takes it (columns unchanged).

    A document is found again by id, source and a hash of its text, so texts move once.
    """
    took = mix(docs, labels=labels, seed=seed).where("copies > 0").groupBy("doc_id", "source", "tie").agg(F.max("copies").alias("__copies"))
    took = stored(took.withColumnsRenamed({"doc_id": "__id", "source": "__source", "tie": "__tie"}), "mix-copies")
    same = (F.col("doc_id").eqNullSafe(F.col("__id"))) & (F.col("source").eqNullSafe(F.col("__source"))) & (F.xxhash64(text_of()) == F.col("__tie"))
    out = docs.join(took, same)
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select(*docs.columns)
