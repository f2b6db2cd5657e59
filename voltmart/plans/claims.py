"""Which start requests win their key and their quote (H6, H8).

A start claims its idempotency key and consumes its quote, so requests interact: taken in
time order, a request starts if neither its key nor its quote is taken. That is computed in
rounds over the open requests, each of three steps:

* a request that is first both of its key and of its quote starts;
* whatever comes later in a key than a request that is first of its quote (or later in a quote than
  one that is first of its key) cannot start: that one or an earlier one takes the key;
* a request that only one earlier open request stands in the way of starts if and only if that one
  does not. Such requests form chains, and pointer jumping finds the head of a chain and the
  parity of the distance to it. Requests are numbered in the order of their turns and cut into blocks,
  so a chain passes each block once: inside blocks the jumps are steps over an array, and only the
  first request of a chain in each block is left, for log2(number of blocks) jumps by joins.

Every open request with the key or quote of a start is then settled. Usually one round settles all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmart.operators import rentals
from voltmart.session import cut_lineage

CLAIM = ["key", "quote_id", "turn", "order_id"]
SIDES = ("key", "quote_id")
BLOCK = 1 << 16


def _firsts(open_: DataFrame, side: str) -> DataFrame:
    """The earliest request of every key (or quote): a minimum that combines before its shuffle."""
    return open_.groupBy(side).agg(F.min(F.struct("turn", *CLAIM[:2], "order_id")).alias("c")).select("c.*")


def _plain_starts(open_: DataFrame) -> DataFrame:
    """Requests that are first of their key and of their quote."""
    per_quote = _firsts(open_, "quote_id").select("turn")
    return _firsts(open_, "key").join(per_quote, "turn", "left_semi").select(*CLAIM)


def _pruned(open_: DataFrame) -> DataFrame:
    """Without requests that come after one which settles their key or quote either way."""
    out = open_
    for side, other in (SIDES, SIDES[::-1]):
        settling = _firsts(open_, other).groupBy(side).agg(F.min("turn").alias("_until"))
        out = out.join(settling, side, "left").filter(F.col("_until").isNull() | (F.col("turn") <= F.col("_until"))).drop("_until")
    return out


def _chained(open_: DataFrame) -> DataFrame:
    """(turn, parent): requests with one earlier request in their way, and heads, their own parents.

    A request has just one in its way if it is first on one side and second on the other.
    """
    first = {side: _firsts(open_, side) for side in SIDES}
    heads = first["key"].join(first["quote_id"].select("turn"), "turn", "left_semi")
    parts = [heads.select("turn", F.col("turn").alias("parent"))]
    for side, other in (SIDES, SIDES[::-1]):
        leader = first[side].select(side, F.col("turn").alias("parent"))
        later = open_.join(leader, side).filter(F.col("turn") > F.col("parent"))
        # The second of each key (or quote), with the first.
        second = later.groupBy(side).agg(F.min(F.struct("turn", "parent")).alias("c")).select("c.*")
        parts.append(second.join(first[other].select("turn"), "turn", "left_semi").select("turn", "parent"))
    return reduce(DataFrame.unionByName, parts)


def _in_blocks(links: DataFrame, block: int) -> DataFrame:
    """(turn, n, root, up, odd): the first request of a chain in the block, and that one's parent.

    ``n`` numbers requests in the order of their turns, so a parent has a smaller one. ``up`` is ``root``
    if it is a head, and null if its parent is outside the chains. ``odd`` is the parity of the way to the root.
    """
    ranged = links.repartitionByRange("turn").sortWithinPartitions("turn")
    numbered = cut_lineage(ranged.withColumn("n", F.monotonically_increasing_id()))
    number = numbered.groupBy(F.col("turn").alias("parent")).agg(F.min("n").alias("up"))
    up = numbered.join(number, "parent", "left").select("n", "up", "turn")
    # Numbers of one block are dense: partitions begin at multiples of 2^33.
    blocks = up.groupBy(F.floor(F.col("n") / block).alias("b")).agg(F.array_sort(F.collect_list(F.struct("n", "up", "turn"))).alias("rows"))

    def place(n):
        return F.pmod(n, F.lit(block)).cast("int") * 2

    # Twice the place of the parent, plus one; a root has its own place and nothing added.
    inside = lambda r: (r["up"] < r["n"]) & (F.floor(r["up"] / block) == F.col("b"))
    steps = blocks.withColumn("to", F.transform("rows", lambda r: F.when(inside(r), place(r["up"]) + 1).otherwise(place(r["n"]))))

    def jumped(to, _):
        return F.transform(to, lambda c: F.get(to, F.shiftright(c, 1)).bitwiseXOR(c.bitwiseAND(F.lit(1))))

    jumps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.log2(F.size("to"))).cast("int")))
    done = steps.withColumn("to", F.aggregate(jumps, F.col("to"), jumped))

    def settled(c, i):
        root = F.get("rows", F.shiftright(c, 1))
        row = F.get("rows", i)
        return F.struct(row["turn"].alias("turn"), row["n"].alias("n"), root["n"].alias("root"), root["up"].alias("up"), c.bitwiseAND(F.lit(1)).alias("odd"))

    return done.select(F.inline(F.transform("to", settled)))


def _chain_starts(open_: DataFrame, block: int) -> tuple[DataFrame, int]:
    """Starts among the requests of chains whose head starts, and the jumps by joins it took."""
    local = cut_lineage(_in_blocks(_chained(open_), block))
    entries = local.filter((F.col("n") == F.col("root")) & (F.col("up") != F.col("root"))).select("n", F.col("up").alias("_n"))
    parents = local.select(F.col("n").alias("_n"), F.col("root").alias("parent"), "up", (1 - F.col("odd")).alias("odd"))
    links = cut_lineage(entries.join(parents, "_n").drop("_n"))
    jumps = 0
    # A parent that is a head, or has its own parent outside the chains, keeps its child where it is.
    while not links.filter(F.col("up") != F.col("parent")).isEmpty():
        up = links.select(F.col("n").alias("parent"), F.col("parent").alias("_p"), F.col("up").alias("_up"), F.col("odd").alias("_odd"))
        links = cut_lineage(
            links.join(up, "parent", "left").select(
                "n",
                F.coalesce("_p", "parent").alias("parent"),
                F.when(F.col("_p").isNull(), F.col("up")).otherwise(F.col("_up")).alias("up"),
                F.col("odd").bitwiseXOR(F.coalesce("_odd", F.lit(0))).alias("odd"),
            )
        )
        jumps += 1
    far = links.select(F.col("n").alias("root"), F.col("parent").alias("_p"), F.col("up").alias("_up"), F.col("odd").alias("_odd"))
    to_head = F.when(F.col("_p").isNull(), F.col("up") == F.col("root")).otherwise(F.col("_up") == F.col("_p"))
    even = F.col("odd") == F.coalesce("_odd", F.lit(0))
    starts = local.join(far, "root", "left").filter(to_head & even).select("turn")
    return open_.join(starts, "turn", "left_semi").select(*CLAIM), jumps


def _settled(open_: DataFrame, won: DataFrame) -> DataFrame:
    rest = open_.join(won.select("key"), "key", "left_anti")
    return rest.join(won.select("quote_id"), "quote_id", "left_anti").select(*CLAIM)


def first_claims(eligible: DataFrame, took: list[int] | None = None, block: int = BLOCK) -> DataFrame:
    """Winners among ``eligible(key, quote_id, turn, order_id)``; turns are unique and ordered.

    All steps are minima per key that combine before their shuffle and joins with lists of minima,
    so no key with very many requests is ever gathered. The open requests and the winners are read
    several times, so each is checkpointed once, narrow. ``took`` receives the jumps by joins of every
    round after the first, which has none. ``block`` is a power of two.
    """
    open_ = cut_lineage(eligible.select(*CLAIM))
    won = cut_lineage(_plain_starts(open_))
    rounds = [won]
    while True:
        # Usually empty after the first round; later rounds work on this small remainder.
        open_ = cut_lineage(_settled(open_, won))
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, rounds)
        open_ = cut_lineage(_pruned(open_))
        starts, jumps = _chain_starts(open_, block)
        won = cut_lineage(starts)
        rounds.append(won)
        if took is not None:
            took.append(jumps)


def decide_starts(
    requests: DataFrame, quotes: DataFrame, ejects: DataFrame, stored: DataFrame | None = None
) -> DataFrame:
    """Every start request with its outcome; ``stored`` are keys of earlier batches."""
    checked = rentals.with_checks(requests, quotes, ejects)
    eligible = checked.filter("eligible").select(
        F.col("idempotency_key").alias("key"), "quote_id", "turn", "order_id"
    )
    if stored is not None:
        eligible = eligible.join(stored.select("key"), "key", "left_anti")
    return rentals.outcomes(checked, first_claims(eligible), stored)
