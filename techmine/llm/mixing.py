"""Mixing sources to target weights with a multivariate-hypergeometric splitting
tree (native: no Python in tasks).

Every source is a stream of words, its documents in a keyed order, cut into blocks
of ``block`` words.  Its target, a number of words, makes an exact quota of draws:
whole passes over its blocks, a part of a further pass, and of the last block the
words that are left.  The draws of all sources are then dealt to output shards of
equal numbers of draws.  A tree over the sources does this: the root holds the
shard sizes, and every node splits its vector of draws per shard between its two
halves of sources by a multivariate hypergeometric variate, made of exact
univariate ones.  The leaves hold each source's draws per shard, so the shards are
distributed as if all draws had been shuffled together, and all margins are exact.
A source's shards take disjoint runs of its blocks in a permuted order (a keyed
bijection, new in each pass); within a shard the draws are put into keyed order.

All randomness is hashed from the seed: reruns agree.

Bounds: the driver holds two sums at a time; a row of the tree holds one number per
shard (``shards`` is a parameter), a level of the tree at most one row per source.
A document's draws are computed in its own row, so a hot source is never gathered:
its prefix sums are taken per bucket of documents, then over buckets.

Defined results: a null text has no words and is never taken; sources without words
have the target 0.  A null source is one source, last in order.  Rows that repeat
id, source and size share no state: each is a document of its own.  An empty table
gives an empty result.  Only the id, text and source columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from techmine.functions.text import let
from techmine.llm.common import partitions, prepare, small_side, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE_PCT = 150      # words of the mix, per hundred words of the table
MOST = 2             # passes a source is taken at most
BLOCK = 4096         # words of a block
SHARDS = 64
SEED = 20240611

# Rounds of the block permutation.
ROUNDS = 48
# About as many documents make a bucket of the prefix sums, and buckets a shelf.
BUCKET_ROWS = 1000
SHELF = 1000
# Half-width, in standard deviations, of the range a variate is drawn from; what
# lies beyond weighs less than a double can hold beside the rest.
SPREAD = 12


def uniform(*keys) -> Column:
    """A double in [0, 1) hashed from ``keys``."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 11).cast("double") / F.lit(float(1 << 53))


def _range(start: Column, stop: Column, step: int) -> Column:
    """start, start + step, ... up to stop; empty if stop lies behind."""
    some = stop >= start if step > 0 else stop <= start
    return F.when(some, F.sequence(start, stop, F.lit(step).cast("long"))).otherwise(
        F.array().cast("array<long>"))


def hypergeometric(good: Column, bad: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` items, taken without replacement from ``good + bad``,
    are good: the inverse of the distribution function at ``u``, taken in an order
    that begins at the mode.  All arguments but ``u`` are longs."""
    def of(s: Column) -> Column:
        g, b, d = s["g"], s["b"], s["d"]
        all_ = (g + b).cast("double")
        low, high = F.greatest(F.lit(0).cast("long"), d - b), F.least(g, d)
        mode = F.floor((d + 1).cast("double") * (g + 1) / (all_ + 2))
        spread = F.sqrt(F.greatest(F.lit(0.0), d * (g / all_) * (b / all_) * (all_ - d) / F.greatest(
            all_ - 1, F.lit(1.0))))
        reach = F.ceil(spread * SPREAD) + SPREAD
        return let(F.struct(g, b, d, s["u"].alias("u"), low.alias("low"), high.alias("high"),
                            F.greatest(low, F.least(high, mode)).cast("long").alias("mode"),
                            reach.cast("long").alias("reach")), walk)

    def walk(s: Column) -> Column:
        g, b, d, mode = s["g"].cast("double"), s["b"].cast("double"), s["d"].cast("double"), s["mode"]
        ks = F.concat(F.array(mode), _range(mode + 1, F.least(s["high"], mode + s["reach"]), 1),
                      _range(mode - 1, F.greatest(s["low"], mode - s["reach"]), -1))

        def step(acc: Column, k: Column) -> Column:
            up = acc["p"] * (g - k + 1) * (d - k + 1) / (k * (b - d + k))
            from_ = F.when(k == mode - 1, F.lit(1.0)).otherwise(acc["p"])
            down = from_ * (k + 1) * (b - d + k + 1) / ((g - k) * (d - k))
            p = F.when(k == mode, F.lit(1.0)).when(k > mode, up).otherwise(down)
            passed = (acc["left"] >= 0) & (acc["left"] - p < 0)
            return F.struct(p.alias("p"), (acc["left"] - p).alias("left"), (acc["sum"] + p).alias("sum"),
                            F.when(passed, k).otherwise(acc["k"]).alias("k"))

        def start(left: Column) -> Column:
            return F.struct(F.lit(0.0).alias("p"), left.alias("left"), F.lit(0.0).alias("sum"), mode.alias("k"))

        whole = F.aggregate(ks, start(F.lit(-1.0)), step, lambda acc: acc["sum"])
        return let(whole, lambda z: F.aggregate(ks, start(s["u"] * z), step, lambda acc: acc["k"]))

    long = lambda c: c.cast("long")
    s = F.struct(long(good).alias("g"), long(bad).alias("b"), long(drawn).alias("d"), u.alias("u"))
    return F.when((good > 0) & (bad > 0) & (drawn > 0), let(s, of)).otherwise(
        F.when(bad <= 0, drawn).otherwise(F.lit(0)).cast("long"))


def hypergeometric_vector(sizes: Column, drawn: Column, *keys) -> Column:
    """A multivariate hypergeometric variate: of ``drawn`` items taken without
    replacement from classes of these ``sizes``, how many fall into each."""
    total = F.aggregate(sizes, F.lit(0).cast("long"), lambda acc, x: acc + x)

    def step(acc: Column, x: Column) -> Column:
        at = F.size(acc["out"])
        k = hypergeometric(x, acc["rest"] - x, acc["drawn"], uniform(*keys, at))
        return let(k, lambda k: F.struct((acc["rest"] - x).alias("rest"), (acc["drawn"] - k).alias("drawn"),
                                         F.concat(acc["out"], F.array(k)).alias("out")))

    start = F.struct(total.alias("rest"), drawn.cast("long").alias("drawn"), F.array().cast("array<long>").alias("out"))
    return F.aggregate(sizes, start, step, lambda acc: acc["out"])


def permuted(x: Column, n: Column, *keys) -> Column:
    """A keyed bijection of 0..n-1 (swap-or-not): in each round, x and its mirror
    image at a keyed offset trade places or not, as a hash of the pair says."""
    def step(acc: Column, r: Column) -> Column:
        offset = F.pmod(F.xxhash64(*keys, r), n)
        mirror = F.pmod(offset - acc, n)
        return let(mirror, lambda m: F.when(
            F.xxhash64(*keys, r, F.greatest(m, acc)).bitwiseAND(F.lit(1).cast("long")) == 1, m).otherwise(acc))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x.cast("long"), step)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_pct: int = SHARE_PCT,
            most: int = MOST) -> DataFrame:
    """``sizes`` (source, size) with the source's rank, weight and target.

    Targets are ``least(most * size, rate * weight)`` with the one rate that gives
    the wanted total: a source above its bound is set to it, and the rate is taken
    anew over the others until none is above.
    """
    ranked = _ranked(sizes).withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]),
                                                       F.col("rank") % len(weights)))
    ranked = stored(ranked.withColumn("most", (F.lit(most) * F.col("size")).cast("double")), "mix-sources")
    wanted = ranked.agg(F.sum("size")).first()[0] or 0
    wanted = min(wanted * share_pct / 100, float(wanted * most))
    held, rate = None, 0.0
    while True:
        above = F.col("most") <= F.lit(rate) * F.col("weight")
        row = ranked.agg(F.coalesce(F.sum(F.when(above, F.col("most"))), F.lit(0.0)).alias("full"),
                         F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("open"),
                         F.count_if(above).alias("held")).first()
        if row["held"] == held or not row["open"]:
            break
        held, rate = row["held"], (wanted - row["full"]) / row["open"]
    full = F.lit(rate) * F.col("weight") >= F.col("most")
    target = F.when(full | F.lit(not row["open"]), F.col("most")).otherwise(F.lit(rate) * F.col("weight"))
    return ranked.select("source", "rank", "size", "weight", target.alias("target"))


def _ranked(sizes: DataFrame) -> DataFrame:
    """Dense ranks by code point, null last, without a window over all sources."""
    n = partitions(sizes.sparkSession)
    order = [F.col("source").isNull(), F.col("source")]
    at = sizes.repartitionByRange(n, *order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().alias("at"))
    at = stored(at, "mix-order")
    # One row per partition.
    counts = at.groupBy("pid").agg(F.count(F.lit(1)).alias("c"), F.min("at").alias("first"))
    counts = counts.select("pid", "first", (F.sum("c").over(Window.orderBy("pid")) - F.col("c")).alias("before"))
    return at.join(small_side(stored(counts, "mix-offsets")), "pid").select(
        "source", "size", (F.col("before") + F.col("at") - F.col("first")).alias("rank"))


def quotas(sources: DataFrame, block: int, seed: int) -> DataFrame:
    """``sources`` with blocks, draws and the words of the last draw.

    All blocks have ``block`` words but the last one of a source.  Of the pass that
    is taken in part, the short block's rank says how many blocks reach the target.
    """
    whole = F.round("target").cast("long").alias("words")
    out = sources.select("*", whole).withColumn("blocks", F.expr(f"(size + {block} - 1) div {block}"))
    out = out.withColumn("short", F.col("size") - (F.col("blocks") - 1) * block)
    out = out.withColumn("passes", F.expr("if(size = 0, 0L, words div size)"))
    out = out.withColumn("rest", F.col("words") - F.col("passes") * F.col("size"))
    rank = F.when(F.col("blocks") > 0, permuted(F.col("blocks") - 1, F.col("blocks"), F.lit(seed), F.col("rank"),
                                                F.col("passes")))
    out = out.withColumn("short_rank", rank)
    lost = F.lit(block) - F.col("short")
    plain = F.expr(f"(rest + {block} - 1) div {block}")
    part = F.when(plain <= F.col("short_rank"), plain).otherwise(
        ((F.col("rest") + lost + (block - 1)) / block).cast("long"))
    out = out.withColumn("part", F.when(F.col("rest") > 0, part).otherwise(F.lit(0)).cast("long"))
    before = (F.col("part") - 1) * block - F.when(F.col("part") - 1 > F.col("short_rank"), lost).otherwise(0)
    out = out.withColumn("last_words", F.when(F.col("rest") > 0, F.col("rest") - before))
    return out.withColumn("draws", F.col("passes") * F.col("blocks") + F.col("part"))


def splitting_tree(sources: DataFrame, shards: int, seed: int) -> DataFrame:
    """``sources`` (rank, draws) to (rank, per_shard): draws of each source in each
    shard.  Shard sizes differ by one draw at most; rows and columns sum exactly."""
    total, top = sources.agg(F.coalesce(F.sum("draws"), F.lit(0)), F.coalesce(F.max("rank"), F.lit(0))).first()
    depth = max(0, int(top).bit_length())
    # Draws of every node: of all sources whose rank shares its upper bits.
    level = F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level")
    nodes = sources.select("rank", "draws", level).groupBy(
        "level", F.expr("shiftright(rank, level)").alias("node")).agg(F.sum("draws").alias("draws"))
    nodes = stored(nodes, "mix-nodes")
    size, more = divmod(int(total), shards)
    at = nodes.where(F.col("level") == depth).select("node", F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda j: (F.lit(size) + F.when(j < more, 1).otherwise(0)).cast("long")).alias("per_shard"))
    for d in range(depth - 1, -1, -1):
        left = nodes.where((F.col("level") == d) & (F.col("node") % 2 == 0)).select(
            F.expr("node div 2").alias("node"), "draws")
        split = at.join(left, "node").select("node", "per_shard", hypergeometric_vector(
            F.col("per_shard"), F.col("draws"), F.lit(seed), F.lit(d), F.col("node")).alias("first"))
        halves = F.array(F.struct((F.col("node") * 2).alias("node"), F.col("first").alias("per_shard")),
                         F.struct((F.col("node") * 2 + 1).alias("node"),
                                  F.zip_with("per_shard", "first", lambda a, b: a - b).alias("per_shard")))
        at = split.select(F.explode(halves).alias("h")).select("h.*").where(F.col("node") <= (int(top) >> d))
        if (depth - d) % 4 == 0:  # keeps plans short
            at = stored(at, "mix-level")
    return stored(at.select(F.col("node").alias("rank"), "per_shard"), "mix-leaves")


def _starts(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``rows`` (id, source, size) with the source's words before each row, in an
    order hashed from the id; ``counts`` (source, rows) is a stored table.

    Every source has buckets in proportion to its documents; they are summed by
    themselves, then the buckets of a shelf, then the shelves of a source.
    """
    sides = small_side(counts.select(F.col("source").alias("s0"), F.expr(f"rows div {BUCKET_ROWS} + 1").alias("buckets")))
    keyed = (rows.join(sides, F.col("source").eqNullSafe(F.col("s0")))
                 .withColumn("hash", F.xxhash64(F.lit(SEED), "id"))
                 .withColumn("bucket", F.pmod(F.xxhash64(F.lit(SEED + 1), "id"), F.col("buckets"))).drop("s0", "buckets"))
    shelf = F.expr(f"bucket div {SHELF}").alias("shelf")
    sums = stored(keyed.groupBy("source", "bucket").agg(F.sum("size").alias("words")).select("*", shelf), "mix-buckets")
    before = lambda w: F.coalesce(F.sum("words").over(
        w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shelves = sums.groupBy("source", "shelf").agg(F.sum("words").alias("words")).select(
        F.col("source").alias("s1"), F.col("shelf").alias("h1"),
        before(Window.partitionBy("source").orderBy("shelf")).alias("to_shelf"))
    shelves = small_side(stored(shelves, "mix-shelves"))
    sums = (sums.withColumn("in_shelf", before(Window.partitionBy("source", "shelf").orderBy("bucket")))
                .join(shelves, F.col("source").eqNullSafe(F.col("s1")) & (F.col("shelf") == F.col("h1")))
                .select(F.col("source").alias("s2"), F.col("bucket").alias("b2"),
                        (F.col("to_shelf") + F.col("in_shelf")).alias("offset")))
    inside = Window.partitionBy("source", "bucket").orderBy("hash", "id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    own = keyed.withColumn("own", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return (own.join(small_side(stored(sums, "mix-starts")),
                     F.col("source").eqNullSafe(F.col("s2")) & (F.col("bucket") == F.col("b2")))
               .withColumn("start", F.col("offset") + F.col("own")).drop("s2", "b2"))


def planned(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_pct: int = SHARE_PCT, most: int = MOST,
            block: int = BLOCK, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id",
            text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: id, source, size, source_size, target and its draws,
    an array of (shard, place, pass, from_word, to_word): the words from_word to
    to_word (exclusive, of this document) go into ``shard``, at the keyed ``place``."""
    prepare(docs.sparkSession)
    words = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    rows = stored(docs.select(F.col(id_col).alias("id"), F.col(source).cast("string").alias("source"),
                              words.alias("size")), "mix-sizes")
    sizes = stored(rows.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")),
                   "mix-source-sizes")
    plan = stored(quotas(targets(sizes.drop("rows"), weights, share_pct, most), block, seed), "mix-quotas")
    leaves = splitting_tree(plan.select("rank", "draws"), shards, seed)
    # Runs of draws of the shards, as their ends.
    ends = F.aggregate("per_shard", F.array().cast("array<long>"),
                       lambda acc, x: F.concat(acc, F.array(x + F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0)))))
    side = plan.join(leaves, "rank").select(
        F.col("source").alias("s1"), "rank", F.col("size").alias("source_size"), "target", "blocks", "passes", "draws",
        "last_words", ends.alias("ends"))
    side = small_side(stored(side, "mix-side"))
    at = _starts(rows, sizes).join(side, F.col("source").eqNullSafe(F.col("s1")))
    first, last = F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}")

    def in_pass(b: Column, p: Column) -> Column:
        """The draw of block ``b`` in pass ``p``, cut to this document."""
        t = p * F.col("blocks") + permuted(b, F.col("blocks"), F.lit(seed), F.col("rank"), p)
        stop = lambda t: F.when((t == F.col("draws") - 1) & F.col("last_words").isNotNull(),
                                F.col("last_words")).otherwise(F.lit(block))
        return let(t, lambda t: F.struct(
            t.alias("t"), p.alias("pass"),
            (F.greatest(F.col("start"), b * block) - F.col("start")).alias("from_word"),
            (F.least(F.col("start") + F.col("size"), b * block + stop(t)) - F.col("start")).alias("to_word")))

    passes = F.when(F.col("draws") > F.col("passes") * F.col("blocks"), F.col("passes") + 1).otherwise(F.col("passes"))
    every = F.flatten(F.transform(F.sequence(first, last), lambda b: F.transform(
        F.sequence(F.lit(0).cast("long"), passes - 1), lambda p: in_pass(b, p))))
    none = F.array().cast("array<struct<t:bigint,pass:bigint,from_word:bigint,to_word:bigint>>")
    every = F.when((F.col("size") > 0) & (passes > 0), every).otherwise(none)
    at = at.withColumn("every", every)
    mine = F.filter("every", lambda x: (x["t"] < F.col("draws")) & (x["to_word"] > x["from_word"]))
    shard = lambda t: F.size(F.filter("ends", lambda e: e <= t))
    dealt = F.transform(mine, lambda x: F.struct(
        shard(x["t"]).alias("shard"), F.xxhash64(F.lit(seed), "id", x["t"]).alias("place"), x["pass"],
        x["from_word"], x["to_word"]))
    return at.select(F.col("id").alias(id_col), "source", "size", "source_size", "target", dealt.alias("draws"))


def taken(draws: Column | str = "draws") -> Column:
    """Words of a document in the mix, repeats counted."""
    return F.aggregate(draws, F.lit(0).cast("long"), lambda acc, x: acc + x["to_word"] - x["from_word"])


def write_mix(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text: str = "text",
              source: str = "source", **options) -> DataFrame:
    """Write the mix below ``path``, a folder per shard, and return its table:
    (id, pass, from_word, to_word, text, place, shard), each shard in the keyed order of
    ``place`` (shuffled locally).  Documents with the same id need distinct texts to
    be told apart; ids are expected to be unique."""
    draws = planned(docs, shards=shards, id_col=id_col, text=text, source=source, **options)
    draws = draws.select(id_col, F.explode("draws").alias("d")).select(id_col, "d.*")
    words = F.regexp_extract_all(F.col(text), F.lit(f"({WORD})"), F.lit(1))
    texts = docs.select(F.col(id_col), words.alias("words"))
    out = draws.join(texts, id_col).select(
        id_col, "pass", "from_word", "to_word",
        F.array_join(F.slice("words", (F.col("from_word") + 1).cast("int"),
                             (F.col("to_word") - F.col("from_word")).cast("int")), " ").alias("text"),
        "place", "shard")
    (out.repartitionByRange(partitions(docs.sparkSession), "shard", "place", id_col)
        .sortWithinPartitions("shard", "place", id_col).write.partitionBy("shard").parquet(path))
    return docs.sparkSession.read.parquet(path)
