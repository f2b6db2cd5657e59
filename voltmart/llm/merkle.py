"""Merkle manifest of a dataset: a digest tree per group, one tree over the groups' roots.

A row's leaf is the digest of its fields. Where a leaf stands among its group's leaves is a rank
query and needs no sort of the rows: per group, ids are merged into a bitmap of which only
non-empty 64-bit words are kept, a popcount directory (running counts on four levels of 16 bits of
the word number) says how many ids come before a word, and the bits below the id's own are
counted. Nodes then meet by (group, slot / 16) in slot arrays of at most 16 entries, level by level.

DataFrame functions only. Every key on the way names at most 65,536 words, 64 ids or 16 nodes, so
a group with most of the rows is spread like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltmart.session import cut_lineage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 16
NULL_WORD = -(1 << 57) - 1  # before the word of any 64-bit id
RESULT = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)


# ----- leaves


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf(fields: dict[str, Column]) -> Column:
    """Digest of the fields in order, each as byte count, colon and value, or ``-`` where it is null."""

    def framed(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(F.concat(*[framed(c) for c in fields.values()]))


def lowered(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, capitals, capitals.lower())


def suspect(doc_id: Column) -> Column:
    """Rows the check tampers with: 5 divides the unsigned crc32 of the decimal id; never null ids."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def leaf_rows(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "source") -> DataFrame:
    """doc_id, g, leaf, shown: the group as a sortable text, and the leaf after tampering (else null)."""
    columns = {f: F.col(f) for f in fields}
    bent = columns | {"text": lowered(F.col("text"))}
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        # Bytewise order with the null group first, and no null in the keys of joins.
        F.coalesce(F.concat(F.lit("1"), F.col(group_col).cast("string")), F.lit("0")).alias("g"),
        leaf(columns).alias("leaf"),
        F.when(suspect(F.col(id_col)), leaf(bent)).alias("shown"),
    )


# ----- coordinates


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """Adds ``number``, the place of each row in the given order, from 0, by ranges of that order."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    rows = cut_lineage(rows)
    part = F.shiftright("_at", 33)
    # One row per partition.
    counts = sorted((r["p"], r["n"]) for r in rows.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    before, seen = [], 0
    for p, n in counts:
        before.append((p, seen))
        seen += n
    starts = df.sparkSession.createDataFrame(before, "_p long, _before long")
    in_part = F.col("_at") - F.shiftleft(F.col("_p"), 33)
    return rows.withColumn("_p", part).join(F.broadcast(starts), "_p").withColumn("number", F.col("_before") + in_part).drop("_p", "_before", "_at")


def bitmap_words(rows: DataFrame) -> DataFrame:
    """g, w, bits, n: the non-empty words of each group's bitmap and the rows that fall into them.

    Rows with a null id fall into a word before all others. ``n`` exceeds the bits set where ids repeat.
    """
    word = F.coalesce(F.shiftright("doc_id", 6), F.lit(NULL_WORD))
    bit = F.expr("coalesce(shiftleft(1L, cast(doc_id & 63 AS int)), 0L)")
    return rows.groupBy("g", word.alias("w")).agg(F.bit_or(bit).alias("bits"), F.count("*").alias("n"))


def directory(words: DataFrame) -> DataFrame:
    """Adds ``before``, the rows of the group in earlier words, and ``total``, all rows of the group.

    Running counts on four levels: within 65,536 words, within 65,536 of such blocks, and so on. The
    levels cover all 58 bits of a word's number, so no window is longer than 65,536 rows.
    """
    levels = [words.withColumn("k", F.col("w"))]
    for _ in range(3):
        below = levels[-1].groupBy("g", F.shiftright("k", 16).alias("k")).agg(F.sum("n").alias("n"))
        levels.append(below)
    sizes = words.groupBy("g").agg(F.sum("n").alias("total"))
    above = sizes.select("g", F.lit(None).cast("long").alias("k"), F.lit(0).cast("long").alias("before"), "total")
    for depth, level in zip((3, 2, 1, 0), reversed(levels)):
        parent = F.lit(0) if depth == 3 else F.shiftright("k", 16)
        earlier = Window.partitionBy("g", "up").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
        here = level.withColumn("up", parent).withColumn("inside", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        start = above.select("g", F.col("k").alias("up"), F.col("before").alias("start"), "total")
        if depth == 3:
            start = start.withColumn("up", F.lit(0))
        here = here.join(start, ["g", "up"]).withColumn("before", F.col("start") + F.col("inside"))
        above = here.drop("up", "inside", "start")
    return above.drop("k")


def coordinates(rows: DataFrame) -> DataFrame:
    """Adds ``slot``, the place of each row in its group by ascending id (nulls first), and ``total``.

    Rows of one id are ordered by leaf; equal leaves take the places in turn, which changes no digest.
    """
    words = cut_lineage(directory(bitmap_words(rows)))
    crowded = F.col("n") > F.bit_count("bits")
    keyed = rows.withColumn("w", F.coalesce(F.shiftright("doc_id", 6), F.lit(NULL_WORD)))
    below = F.expr("bit_count(bits & ~shiftleft(-1L, cast(doc_id & 63 AS int)))")
    found = keyed.join(words, ["g", "w"])
    plain = found.where(~crowded).withColumn("slot", F.col("before") + below)
    columns = [*rows.columns, "slot", "total"]
    if words.where(crowded).isEmpty():
        return plain.select(*columns)
    # Words with repeated or null ids: their rows are numbered by ranges, however many share an id.
    rest = numbered(found.where(crowded), "g", "w", "doc_id", "leaf", "at")
    first = rest.groupBy("g", "w").agg(F.min("number").alias("first"))
    rest = rest.join(first, ["g", "w"]).withColumn("slot", F.col("before") + F.col("number") - F.col("first"))
    return plain.select(*columns).unionByName(rest.select(*columns))


# ----- levels


def reduced(nodes: DataFrame, most: int, payload: Sequence[str] = ()) -> tuple[list[DataFrame], DataFrame]:
    """Slot arrays of every level, and the last node of each tree as (g, digest, height).

    ``nodes`` has g, slot, total (nodes of that tree on this level), digest and the payload columns,
    which stay with the lowest level. ``most`` is the largest total.
    """
    levels, tops, height = [], [], 0
    while True:
        tops.append(nodes.where("total = 1").select("g", "digest", F.lit(height).alias("height")))
        if most <= 1:
            break
        member = F.struct((F.col("slot") % ARITY).cast("int").alias("k"), "digest", *(payload if height == 0 else ()))
        runs = (
            nodes.where("total > 1")
            .groupBy("g", "total", F.floor(F.col("slot") / ARITY).alias("slot"))
            .agg(F.array_sort(F.collect_list(member)).alias("members"))
        )
        digests = F.concat_ws("", F.transform("members", lambda m: m["digest"]))
        runs = cut_lineage(runs.withColumn("digest", digest(digests)))
        levels.append(runs)
        nodes = runs.select("g", "slot", F.ceil(F.col("total") / ARITY).alias("total"), "digest")
        most, height = -(-most // ARITY), height + 1
    return levels, reduce(DataFrame.unionByName, tops)


def with_paths(levels: list[DataFrame], tops: DataFrame, kept: Sequence[str]) -> DataFrame:
    """The lowest nodes of all trees with their siblings on every level up to the last node.

    ``tops`` has g, height, path (what is above the tree) and the ``kept`` columns. A path is an array
    of (left, right), the digests of a run before and after the node, joined. Trees of one node have
    no run and are not returned.
    """
    start = tops.select("g", F.lit(0).cast("long").alias("slot"), "height", "path", *kept)
    above: DataFrame | None = None
    for height in range(len(levels), 0, -1):
        up = start.where(F.col("height") == height).drop("height")
        up = up if above is None else up.unionByName(above.select(*up.columns))
        runs = levels[height - 1].select("g", "slot", "members")
        found = runs.join(up, ["g", "slot"]).withColumn("digests", F.transform("members", lambda m: m["digest"]))
        one = found.select("*", F.posexplode("members").alias("place", "member"))
        left = F.concat_ws("", F.slice("digests", F.lit(1), F.col("place")))
        right = F.concat_ws("", F.slice("digests", F.col("place") + 2, F.lit(ARITY)))
        step = F.array(F.struct(left.alias("left"), right.alias("right")))
        above = one.select(
            "g",
            (F.col("slot") * ARITY + F.col("member.k")).alias("slot"),
            "member",
            F.concat(step, "path").alias("path"),
            *kept,
        )
    return above


def manifest(rows: DataFrame) -> DataFrame:
    """doc_id, leaf, shown, subroot, root, path of every row of ``leaf_rows``.

    An empty table gives an empty result. The driver sees the number of groups, the size of the
    largest and the root.
    """
    spark = rows.sparkSession
    rows = cut_lineage(rows.withColumn("at", F.monotonically_increasing_id()))
    placed = coordinates(rows).withColumnRenamed("leaf", "digest")
    sizes = rows.groupBy("g").count().agg(F.max("count").alias("most"), F.count("*").alias("groups")).first()
    if not sizes["groups"]:
        return spark.createDataFrame([], "doc_id long, leaf string, shown string, subroot string, root string, path array<struct<left:string,right:string>>")
    placed = cut_lineage(placed.select("g", "slot", "total", "digest", "doc_id", "shown"))
    levels, subroots = reduced(placed, sizes["most"], ("doc_id", "shown"))
    subroots = numbered(subroots, "g").withColumnsRenamed({"g": "group", "number": "slot"})
    top_nodes = subroots.select(F.lit("").alias("g"), "slot", F.lit(sizes["groups"]).cast("long").alias("total"), "digest", "group", "height")
    top_levels, top = reduced(top_nodes, sizes["groups"], ("group", "height"))
    root = top.first()["digest"]
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    if sizes["groups"] == 1:
        roots = subroots.select(F.col("group").alias("g"), "height", nothing.alias("path"), F.col("digest").alias("subroot"))
    else:
        down = with_paths(top_levels, top.withColumn("path", nothing), ())
        roots = down.select(F.col("member.group").alias("g"), F.col("member.height").alias("height"), "path", F.col("member.digest").alias("subroot"))
    lone = placed.where("total = 1").join(roots, "g").select("doc_id", F.col("digest").alias("leaf"), "shown", "subroot", "path")
    out = lone
    if levels:
        found = with_paths(levels, roots, ["subroot"])
        out = lone.unionByName(found.select("member.doc_id", F.col("member.digest").alias("leaf"), "member.shown", "subroot", "path"))
    return out.select("doc_id", "leaf", "shown", "subroot", F.lit(root).alias("root"), "path")


def siblings(path: Column) -> Column:
    """The digests beside the way to the root, level by level, left to right, joined."""
    return F.concat_ws("", F.transform(path, lambda p: F.concat(p["left"], p["right"])))


def folded(path: Column, start: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda node, p: digest(F.concat(p["left"], node, p["right"])))


def merkle_manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "source") -> DataFrame:
    """One row per input row: leaf, subroot, root, proof_sha256, folded_root, verified.

    Null fields are ``-`` in the leaf; rows with a null id come first in their group and are never
    tampered with; the null group comes first. Repeated ids are ordered by leaf, repeated rows count
    each. A group of one row has its leaf as root, one group alone gives the root. Columns
    beside ``fields`` are not read.
    """
    rows = manifest(leaf_rows(docs, fields, id_col, group_col))
    out = rows.select(
        "doc_id", "leaf", "subroot", "root", digest(siblings(F.col("path"))).alias("proof_sha256"),
        folded(F.col("path"), F.coalesce("shown", "leaf")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


# The same rows for DuckDB. crc32 has no function there: its table of 256 entries is built by rule.
SQL = """
WITH RECURSIVE
crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
              lambda a, b: CASE WHEN a % 2 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)
),
framed AS (
  SELECT doc_id, source, dense_rank() OVER (ORDER BY source NULLS FIRST) AS g,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
           || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-')
           || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
         text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS bent,
         xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
           lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS crc
  FROM documents, crc_table
),
digested AS (
  SELECT doc_id, g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN crc % 5 = 0 THEN sha256(head || coalesce(strlen(bent) || ':' || bent, '-')) END AS shown
  FROM framed
),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS slot, count(*) OVER (PARTITION BY g) AS n
  FROM digested
),
lower_tree(g, lev, slot, n, digest) AS (
  SELECT g, 0, slot, n, leaf FROM leaves
  UNION ALL
  SELECT g, lev + 1, slot // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY slot))
  FROM lower_tree WHERE n > 1 GROUP BY g, lev, slot // 16, (n + 15) // 16
),
subroots AS (SELECT g, lev AS height, digest FROM lower_tree WHERE n = 1),
upper_tree(lev, slot, n, digest) AS (
  SELECT 0, g - 1, count(*) OVER (), digest FROM subroots
  UNION ALL
  SELECT lev + 1, slot // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY slot))
  FROM upper_tree WHERE n > 1 GROUP BY lev, slot // 16, (n + 15) // 16
),
runs AS (
  SELECT g, lev, slot // 16 AS run, list(digest ORDER BY slot) AS ds FROM lower_tree WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT s.g, s.height + u.lev, s.g // power, r.ds
  FROM subroots s, LATERAL (SELECT lev, CAST(16 ** (lev + 1) AS BIGINT) AS power FROM (SELECT DISTINCT lev FROM upper_tree WHERE n > 1)) u,
       LATERAL (SELECT list(digest ORDER BY slot) AS ds FROM upper_tree t
                WHERE t.lev = u.lev AND t.n > 1 AND t.slot // 16 = (s.g - 1) // u.power) r
),
walk(doc_id, leaf, g, nr, height, lev, slot, node, proof) AS (
  SELECT l.doc_id, l.leaf, l.g, row_number() OVER (), s.height, 0, l.slot, coalesce(l.shown, l.leaf), ''
  FROM leaves l JOIN subroots s USING (g)
  UNION ALL
  SELECT w.doc_id, w.leaf, w.g, w.nr, w.height, w.lev + 1,
         CASE WHEN w.lev + 1 = w.height THEN w.g - 1 ELSE w.at // 16 END,
         sha256(array_to_string(r.ds[1:k], '') || w.node || array_to_string(r.ds[k + 2:], '')),
         w.proof || array_to_string(r.ds[1:k], '') || array_to_string(r.ds[k + 2:], '')
  FROM (SELECT *, CASE WHEN lev = 0 AND height = 0 THEN g - 1 ELSE slot END AS at,
               CASE WHEN lev = 0 AND height = 0 THEN (g - 1) % 16 ELSE slot % 16 END AS k FROM walk) w
  JOIN runs r ON r.g = w.g AND r.lev = w.lev
   AND CASE WHEN w.lev < w.height THEN r.run = w.at // 16 ELSE TRUE END
),
ends AS (SELECT * FROM walk QUALIFY lev = max(lev) OVER (PARTITION BY nr))
SELECT e.doc_id, e.leaf, s.digest AS subroot, t.digest AS root, sha256(e.proof) AS proof_sha256,
       e.node AS folded_root, e.node = t.digest AS verified
FROM ends e JOIN subroots s USING (g), (SELECT digest FROM upper_tree WHERE n = 1) t
"""
