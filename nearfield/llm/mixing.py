"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Only DataFrame and SQL functions are used. Every source gets a target number of words; its rows, in the
order of a hash, are taken whole as many times as the target holds the source, then once more up
to a cut. Rows form blocks by leading hash bits. All drawn blocks are dealt to output shards by a
tree: a node's blocks are split between its halves with source counts drawn from the multivariate
hypergeometric law, as if all blocks had been shuffled together, but exactly and without a global
shuffle. Inside a shard rows follow a hash order.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nearfield.llm.words import WORD_REGEX
from nearfield.operators.ordinals import join_sized
from nearfield.session import cut_lineage

MOST_REPEATS = 3
KEY_BITS, DIGIT = 60, 12  # hash order; one radix level of the search for the cut
BLOCK_WORDS = 100_000
SHARD_WORDS = 4_000_000
SPREAD_LEVEL = 8  # the tree's nodes are dealt over tasks from this depth on


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_REGEX)), F.lit(0)).cast("long")


def hash_order(key: str, seed: int) -> Column:
    """60 bits that put rows into a repeatable random order; equal keys are together."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long")


def source_targets(sized: DataFrame) -> DataFrame:
    """One row per ``_src``: ``source_size`` and ``target``; sources by code point weigh 1, 2, 3, 1, …

    Shares are of all words. A target stops at three times its source, the excess goes to the
    others by weight: the level ``t`` with ``sum(least(3 size, weight t)) = all`` is the largest of the
    levels reached by capping the sources in order of ``3 size / weight``.
    """
    per = sized.groupBy("_src").agg(F.sum("size").alias("source_size"))
    ordinal = F.row_number().over(Window.orderBy(F.col("_src") == "", "_src"))
    per = per.withColumn("w", (ordinal - 1) % 3 + 1).withColumn("cap", MOST_REPEATS * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("_src") == "", "_src")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(after)
    per = per.withColumn("level", level).withColumn("t", F.max("level").over(whole))
    return per.select("_src", "source_size", F.least(F.col("cap").cast("double"), F.col("w") * F.col("t")).alias("target"))


def _cuts(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with ``full`` (whole passes) and ``cut``: the last hash of the partial pass.

    Rows of one hash are taken together, up to the point nearest to the rest. The search goes down
    the digits of the hash, so no task ever orders more than one bucket of a source.
    """
    ratio = F.floor(F.col("target") / F.col("source_size"))
    targets = targets.withColumn("full", F.when(F.col("source_size") > 0, ratio).otherwise(0).cast("long"))
    state = targets.withColumn("rest", F.col("target") - F.col("full") * F.col("source_size"))
    state = state.withColumn("at", _long(0)).withColumn("passed", _long(0))
    digits = KEY_BITS // DIGIT
    for level in range(digits):
        shift = KEY_BITS - DIGIT * (level + 1)
        prefix = F.shiftright("k", shift + DIGIT)
        inside = sized.join(F.broadcast(state.select("_src", "at", "rest", "passed")), "_src").where(prefix == F.col("at"))
        sums = inside.groupBy("_src", F.shiftright("k", shift).alias("next")).agg(
            F.sum("size").alias("g"), F.first("rest").alias("rest"), F.first("passed").alias("passed")
        )
        before = Window.partitionBy("_src").orderBy("next").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("c", F.col("passed") + F.coalesce(F.sum("g").over(before), F.lit(0)))
        last = level == digits - 1
        within = F.col("c") + F.col("g") / (2.0 if last else 1.0) <= F.col("rest")
        found = sums.groupBy("_src").agg(
            F.min(F.when(~within, F.struct("next", "c"))).alias("cross"),
            F.max("next").alias("top"),
            F.max(F.col("c") + F.col("g")).alias("done"),
        )
        state = state.drop("at", "passed").join(found, "_src", "left")
        # Where nothing crosses, the search ends behind the last bucket.
        state = state.withColumn("passed", F.coalesce("cross.c", "done", _long(0)))
        state = state.withColumn("at", F.coalesce(F.col("cross.next"), F.col("top") + 1, _long(0)))
        state = cut_lineage(state.drop("cross", "top", "done"), "cut")
    return state.select("_src", "source_size", "target", "full", (F.col("at") - 1).alias("cut"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is written and computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _log_factorial(k: Column) -> Column:
    """Natural log of k!, by Stirling's series at k + 8."""
    shifted = reduce(Column.__mul__, [k + F.lit(float(i)) for i in range(1, 9)])

    def series(x: Column) -> Column:
        return (x + 0.5) * F.log(x) - x + F.lit(0.9189385332046727) + 1 / (12 * x) - 1 / (360 * x * x * x)

    return _let(k + F.lit(8.0), series) - F.log(shifted)


def _hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """Marked ones among ``drawn`` of ``total`` without replacement: the inverse distribution at ``u``.

    Weights are taken within 9 standard deviations (and 9) of the mode; what lies outside is below
    1e-15.
    """
    share = marked / F.greatest(total, _long(1))
    variance = drawn * share * (1 - share) * (total - drawn) / F.greatest(total - 1, _long(1))
    facts = F.struct(
        F.greatest(_long(0), drawn + marked - total).alias("low"),
        F.least(marked, drawn).alias("high"),
        F.floor((drawn + 1) * (marked + 1) / (total + 2)).cast("long").alias("mode"),
        F.ceil(9 * F.sqrt(F.greatest(variance, F.lit(0.0))) + 9).cast("long").alias("reach"),
    )

    def limits(x: Column) -> Column:
        return F.struct(
            F.greatest(x["low"], F.least(x["mode"] - x["reach"], x["high"])).alias("a"),
            F.least(x["high"], F.greatest(x["mode"] + x["reach"], x["low"])).alias("b"),
        )

    def weight(k: Column) -> Column:
        parts = F.array(k, marked - k, drawn - k, total - marked - drawn + k)
        return -F.aggregate(parts, F.lit(0.0), lambda s, p: s + _log_factorial(p))

    def search(w: Column) -> Column:
        goal = u * F.aggregate(w, F.lit(0.0), lambda s, x: s + x)
        start = F.struct(F.lit(0.0).alias("sum"), _long(0).alias("n"))

        def count(g: Column) -> Column:
            def step(s: Column, x: Column) -> Column:
                return _let(s["sum"] + x, lambda y: F.struct(y.alias("sum"), (s["n"] + (y < g).cast("long")).alias("n")))

            return F.aggregate(w, start, step, lambda s: s["n"])

        return _let(goal, count)

    def draw(x: Column) -> Column:
        logs = F.transform(F.sequence(x["a"], x["b"]), weight)
        weights = _let(logs, lambda w: _let(F.array_max(w), lambda top: F.transform(w, lambda v: F.exp(v - top))))
        return F.least(x["a"] + _let(weights, search), x["b"])

    return _let(_let(facts, limits), draw)


def _split(node: dict[str, Column], seed: int) -> Column:
    """Source counts of a node's left half: ``drawn`` blocks of all its blocks, without replacement."""
    quotas, drawn = node["quotas"], node["drawn"]
    total = F.aggregate(quotas, _long(0), lambda s, q: s + q)
    start = F.struct(
        total.alias("total"), drawn.alias("drawn"), F.array().cast("array<long>").alias("left")
    )

    def step(s: Column, q: Column) -> Column:
        h = F.xxhash64(F.lit(seed), node["lo"], node["n"], F.size(s["left"]))
        u = F.shiftrightunsigned(h, 11) / F.lit(float(1 << 53))
        return _let(
            _hypergeometric(s["total"], q, s["drawn"], u),
            lambda x: F.struct(
                (s["total"] - q).alias("total"), (s["drawn"] - x).alias("drawn"), F.concat(s["left"], F.array(x)).alias("left")
            ),
        )

    return F.aggregate(quotas, start, step, lambda s: s["left"])


def shard_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """``(shard, quotas)`` from one row of ``quotas`` (array of blocks per source).

    Shards differ by at most one block in all, and their counts of every source add up exactly.
    """
    nodes = quotas.select(_long(0).alias("lo"), _long(shards).alias("n"), "quotas")
    for level in range((shards - 1).bit_length()):
        if level == SPREAD_LEVEL:
            nodes = nodes.repartition("lo")
        total = F.aggregate("quotas", _long(0), lambda s, q: s + q)
        half = F.shiftright("n", 1)
        drawn = F.floor(total * half / F.col("n")).cast("long")
        node = {c: F.col(c) for c in ("lo", "n", "quotas", "drawn")}
        nodes = nodes.withColumn("drawn", drawn).withColumn("left", F.when(F.col("n") > 1, _split(node, seed)))
        leaf = F.array(F.struct("lo", "n", "quotas"))
        children = F.array(
            F.struct("lo", half.alias("n"), F.col("left").alias("quotas")),
            F.struct(
                (F.col("lo") + half).alias("lo"),
                (F.col("n") - half).alias("n"),
                F.zip_with("quotas", "left", lambda q, x: q - x).alias("quotas"),
            ),
        )
        nodes = nodes.select(F.explode(F.when(F.col("n") > 1, children).otherwise(leaf)).alias("x")).select("x.*")
        nodes = cut_lineage(nodes, "tree")  # nested levels would make one very large expression
    return nodes.select(F.col("lo").alias("shard"), "quotas")


FACTS = ["_size", "_source_size", "_target", "_draws"]


def mixing_plan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 0,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``docs`` with ``_size``, ``_source_size``, ``_target`` and ``_draws``: ``array<struct<pass, shard>>``; columns of
    ``docs`` with those names are left out.

    A row occurs in the mix once for each draw, at most three times. A null source is a source of
    its own and comes last; a null text has size 0; rows of one key are drawn together. Sources
    without words have target 0 and are drawn 0 times, as is everything in a table without words.
    """
    out, names = _plan(docs, key, text, source, seed, block_words, shard_words)
    return out.select(*[F.col(i).alias(c) for c, i in names if c not in FACTS], *FACTS)


def _plan(
    docs: DataFrame, key: str, text: str, source: str, seed: int, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS
) -> tuple[DataFrame, list[tuple[str, str]]]:
    """``docs`` under inner names with the facts of the plan, and (name, inner name) of each column."""
    names = [(c, f"c{i}") for i, c in enumerate(docs.columns)]
    src = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))
    sized = docs.select(src.alias("_src"), word_count(F.col(text)).alias("size"), hash_order(key, seed).alias("k"))
    sized = cut_lineage(sized, "sizes")
    cuts = cut_lineage(_cuts(sized, cut_lineage(source_targets(sized), "targets")), "cuts")

    # Blocks: leading bits of the hash, as many as give about block_words, at most 4,096 a source.
    wanted = F.ceil(F.log2(F.greatest(F.col("source_size") / block_words, F.lit(1.0))))
    cuts = cuts.withColumn("bits", F.least(wanted, F.lit(DIGIT)).cast("int")).withColumn("shift", F.lit(KEY_BITS) - F.col("bits"))
    blocks = sized.where("size > 0").join(F.broadcast(cuts.select("_src", "shift", "full", "cut")), "_src")
    blocks = blocks.select("_src", "k", "full", "cut", F.call_function("shiftright", "k", "shift").alias("block"))
    blocks = blocks.groupBy("_src", "block").agg(F.min("k").alias("k"), F.first("full").alias("full"), F.first("cut").alias("cut"))
    passes = F.col("full") + (F.col("k") <= F.col("cut")).cast("long")
    draws = blocks.where(passes > 0).select("_src", "block", F.explode(F.sequence(_long(1), passes)).alias("pass"))
    mixed = F.xxhash64(F.lit(seed), "_src", "block", "pass")
    own = Window.partitionBy("_src").orderBy(mixed, "block", "pass")
    draws = cut_lineage(draws.withColumn("nth", F.row_number().over(own) - 1), "draws")

    total = draws.count()
    words = cuts.agg(F.sum("target")).first()[0] or 0.0
    shards = max(1, min(total, -(-int(words) // shard_words)))
    per = draws.groupBy("_src").agg(F.count(F.lit(1)).alias("q"))
    per = per.agg(F.array_sort(F.collect_list(F.struct("_src", "q"))).alias("all"))
    named = per.select(F.col("all._src").alias("names"), F.col("all.q").alias("quotas"))
    leaves = shard_quotas(named.select("quotas"), shards, seed)
    leaves = leaves.crossJoin(F.broadcast(named.select("names")))  # one row
    leaves = leaves.select("shard", F.explode(F.arrays_zip("names", "quotas")).alias("x")).select(
        "shard", F.col("x.names").alias("_src"), F.col("x.quotas").alias("q")
    )
    so_far = Window.partitionBy("_src").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    leaves = leaves.withColumn("c", F.coalesce(F.sum("q").over(so_far), _long(0))).where("q > 0")
    places = leaves.select("_src", "shard", F.explode(F.expr("sequence(c, c + q - 1)")).alias("nth"))
    dealt = draws.join(places, ["_src", "nth"]).groupBy("_src", "block").agg(
        F.array_sort(F.collect_list(F.struct("pass", "shard"))).alias("list")
    )
    dealt = dealt.withColumnRenamed("block", "_block").withColumnRenamed("list", "_list")

    made = [src.alias("_src"), word_count(F.col(text)).alias("_size"), hash_order(key, seed).alias("_k")]
    out = docs.select(*[F.col(f"`{c}`").alias(i) for c, i in names], *made)
    facts = cuts.select("_src", F.col("source_size").alias("_source_size"), F.col("target").alias("_target"),
                        F.col("full").alias("_full"), F.col("cut").alias("_cut"), F.col("shift").alias("_shift"))
    out = join_sized(out, facts, ["_src"]).withColumn("_block", F.call_function("shiftright", "_k", "_shift"))
    out = join_sized(out, dealt, ["_src", "_block"], "left")
    times = F.col("_full") + (F.col("_k") <= F.col("_cut")).cast("long")
    taken = F.filter("_list", lambda d: (d["pass"] <= times) & (F.col("_size") > 0))
    out = out.withColumn("_draws", F.coalesce(taken, F.array().cast("array<struct<pass:bigint,shard:bigint>>")))
    return out.select(*[i for _, i in names], *FACTS), names


def mix_sources(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as drawn, by shard and shuffled inside it.

    A shard is a contiguous range of the result's partitions. Columns are those of ``docs``.
    """
    rows, names = _plan(docs, key, text, source, seed)
    rows = rows.withColumn("_draw", F.explode("_draws"))
    order = [F.col("_draw.shard"), F.xxhash64(F.lit(seed), F.col(dict(names)[key]).cast("string"), "_draw.pass")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.select(*[F.col(i).alias(c) for c, i in names])
