"""Merkle manifest of a dataset and proofs for every row.

Leaves are hashes of whole rows. Each tree (a language, in id order) hashes runs
of two up to its subroot; the subroots, in order of their languages, hash up to
the root in the same way.

The built levels are stored as parent-linked node rows: a node of every fourth
level has the siblings on its way over the next four levels (``sibs``; null where
it was alone in its run) and links to its ancestor there; the last node of a
language's tree links to its place in the tree of subroots. A Spark recursive
query then starts from all leaves and climbs the links, appending the siblings
to the proof and folding the (tampered) hash, until the root.

Texts are read once, to hash them; after that a row is an id and a digest of
32 bytes. Positions come from a range sort and one row per range and language,
four levels are hashed within groups of 16, so no tree is ever in one task.
Upper levels, counted and under ``BROADCAST_NODES`` rows together, are broadcast
to the climb, as all leaves pass the same few nodes there; the levels below,
where a node has few leaves beside all, are joined by shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from credal.llm.common import stored

STEP, RUN = 4, 16                   # levels per node row, nodes of their groups (2 ** STEP)
BROADCAST_NODES = 50_000            # node rows of at most 300 bytes
TOP = "^"                           # the tree of subroots; those of languages begin with '=' or are ''
LIMIT = "spark.sql.cteRecursionRowLimit"

_FOLD = ("aggregate({sibs}, {start}, (h, s) -> unhex(sha2(CASE WHEN s.digest IS NULL THEN lower(hex(h)) "
         "WHEN s.before THEN concat(lower(hex(s.digest)), lower(hex(h))) "
         "ELSE concat(lower(hex(h)), lower(hex(s.digest))) END, 256)))")


def digest_of(*hex_parts: Column) -> Column:
    """32 bytes: SHA-256 of the concatenated strings."""
    return F.unhex(F.sha2(F.concat(*hex_parts).cast("binary"), 256))


def field(c: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value."""
    s = c.cast("string")
    return F.when(s.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaves(docs: DataFrame) -> DataFrame:
    """``doc_id, tree, digest, tampered``: the digest after one is added to
    ``n_chars``, null where 7 doesn't divide the crc32 of the id."""
    head = [field(F.col(c)) for c in ("doc_id", "source", "lang")]
    grown = field(F.col("n_chars").cast("decimal(38,0)") + 1)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return docs.select(
        "doc_id", F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        digest_of(*head, field(F.col("n_chars")), field(F.col("text"))).alias("digest"),
        F.when(hit, digest_of(*head, grown, field(F.col("text")))).alias("tampered"))


def positions(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with ``pos`` within ``tree`` in the order given, from 0, and ``n``,
    the tree's size. Rows equal in all of ``order`` have any of their places."""
    rows = stored(nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
                  .withColumn("__m", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("__m", 33)
    # a row per range and tree; ranges of a tree are counted up within the tree
    sizes = rows.groupBy("tree", part.alias("__part")).agg(F.min("__m").alias("__first"), F.count(F.lit(1)).alias("__c"))
    of_tree = Window.partitionBy("tree").orderBy("__part")
    sizes = sizes.select("tree", "__part", (F.sum("__c").over(of_tree) - F.col("__c") - F.col("__first")).alias("__add"),
                         F.sum("__c").over(Window.partitionBy("tree")).alias("n"))
    return rows.withColumn("__part", part).join(sizes, ["tree", "__part"]) \
        .withColumn("pos", F.col("__m") + F.col("__add")).drop("__m", "__part", "__add")


def _parents(level: Column) -> Column:
    """The next level of a group: hashes of runs of two, the last may be one."""
    def hashed(i):
        return digest_of(F.lower(F.hex(F.get(level, i * 2))), F.coalesce(F.lower(F.hex(F.get(level, i * 2 + 1))), F.lit("")))
    return F.transform(F.sequence(F.lit(0), F.shiftright(F.size(level) - 1, 1)), hashed)


def build(nodes: DataFrame, payload: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """``nodes(tree, pos, n, digest, *payload)`` → node rows of every stored
    level, lowest first (``tree, level, pos, digest, sibs, last, *payload``), and the
    ``tree, digest`` of the tops. ``payload`` only in the lowest level."""
    levels, tops, level = [], [], 0
    while True:
        # halvings until one node is left: the binary digits of n - 1
        rest = F.when(F.col("n") == 1, 0).otherwise(F.length(F.bin(F.col("n") - 1)))
        groups = nodes.groupBy("tree", F.shiftright("pos", STEP).alias("group"), "n").agg(
            F.sort_array(F.collect_list(F.struct("pos", "digest", *payload))).alias("l"))     # at most RUN
        groups = groups.withColumn("steps", F.least(rest, F.lit(STEP))).withColumn("last", rest <= STEP) \
            .withColumn("l0", F.col("l.digest"))
        for j in range(STEP):
            groups = groups.withColumn(f"l{j + 1}", F.when(F.col("steps") > j, _parents(F.col(f"l{j}")))
                                       .otherwise(F.col(f"l{j}")))
        groups = stored(groups, f"level-{level}")
        i = F.col("i")
        sibs = F.array(*[F.struct(F.get(F.col(f"l{j}"), F.shiftright(i, j).bitwiseXOR(F.lit(1))).alias("digest"),
                                  (F.shiftright(i, j) % 2 == 1).alias("before")) for j in range(STEP)])
        levels.append(groups.select("tree", "group", "steps", "last", *[f"l{j}" for j in range(STEP)],
                                    F.posexplode("l").alias("i", "node"))
                      .select("tree", F.lit(level).alias("level"), "node.pos", "node.digest",
                              F.slice(sibs, 1, F.col("steps")).alias("sibs"), "last", "group",
                              *[f"node.{c}" for c in payload]))
        top = F.get(f"l{STEP}", 0).alias("digest")
        tops.append(groups.where("last").select("tree", top))
        nodes = groups.where("not last").select("tree", F.col("group").alias("pos"),
                                                F.shiftright(F.col("n") + RUN - 1, STEP).alias("n"), top)
        payload, level = [], level + 1
        if nodes.isEmpty():
            return levels, reduce(DataFrame.union, tops)


def _linked(node: DataFrame, places: DataFrame | None) -> DataFrame:
    """Node rows with their parent's ``ptree, plevel, ppos`` and the siblings as
    one ``part`` of the proof. A tree's last nodes link to ``places``."""
    part = F.expr("aggregate(sibs, X'', (p, s) -> concat(p, coalesce(s.digest, X'')))").alias("part")
    inner = node.where("not last").select("*", F.col("tree").alias("ptree"), (F.col("level") + 1).alias("plevel"),
                                          F.col("group").alias("ppos"), part)
    ends = node.where("last")
    if places is None:
        ends = ends.select("*", F.lit(None).cast("string").alias("ptree"), F.lit(None).cast("int").alias("plevel"),
                           F.lit(None).cast("bigint").alias("ppos"), part)
    else:
        # the last node rows of a tree are RUN at most
        ends = ends.join(places.select("tree", F.col("pos").alias("ppos")), "tree").select(
            *node.columns, F.lit(TOP).alias("ptree"), F.lit(0).alias("plevel"), "ppos", part)
    return inner.unionByName(ends).drop("last", "group")


def climb(spark: SparkSession, start: DataFrame, nodes: DataFrame, hint: str) -> DataFrame:
    """All rows of ``start(doc_id, digest, subroot, folded, proof, ptree, plevel,
    ppos)`` at every node that they reach over ``nodes``, in one recursive query."""
    fold = _FOLD.format(sibs="n.sibs", start="c.folded")
    return spark.sql(f"""
        WITH RECURSIVE climb (doc_id, digest, subroot, folded, proof, ptree, plevel, ppos) AS (
          SELECT doc_id, digest, subroot, folded, proof, ptree, plevel, ppos FROM {{start}}
          UNION ALL
          SELECT {hint} c.doc_id, c.digest,
                 coalesce(c.subroot, CASE WHEN n.tree = '{TOP}' AND n.level = 0 THEN n.digest END),
                 {fold}, concat(c.proof, n.part), n.ptree, n.plevel, n.ppos
          FROM climb c JOIN {{nodes}} n ON c.ptree = n.tree AND c.plevel = n.level AND c.ppos = n.pos)
        SELECT * FROM climb""", start=start, nodes=nodes)


def manifest(docs: DataFrame, broadcast_nodes: int = BROADCAST_NODES) -> DataFrame:
    """``docs(doc_id, source, lang, n_chars, text)`` → a row per row: ``doc_id,
    leaf, subroot, root, proof_sha256`` (hex), ``folded_root`` (hex) and
    ``verified``.

    Null values are ``-`` in a leaf; a null language is a tree of its own, before
    all others; null ids come first in their tree and are not tampered with.
    Rows with equal ids follow each other by their leaves, so the tree doesn't
    depend on the order of the input; equal rows have equal leaves and different
    proofs. Other columns are ignored; no rows give none.
    """
    spark = docs.sparkSession
    lowest = positions(leaves(docs), ["doc_id", "digest"])
    tree_levels, tops = build(lowest, ["doc_id", "tampered"])
    tops = stored(tops, "subroots")
    places = _places(tops)
    top_levels, roots = build(places.select(F.lit(TOP).alias("tree"), "pos", "n", "digest"), [])
    root = roots.first()
    root = bytes(root["digest"]) if root else b""
    tree_levels = [stored(_linked(x, places), "nodes") for x in tree_levels]
    top_levels = [stored(_linked(x, None), "nodes") for x in top_levels]

    # from the root down, the levels that fit a broadcast together
    upper, size = [], 0
    lower = [(F.col("ptree") != TOP, k, x) for k, x in enumerate(tree_levels)][1:]
    lower += [(F.col("ptree") == TOP, k, x) for k, x in enumerate(top_levels)]
    while lower and size + (n := lower[-1][2].count()) <= broadcast_nodes:
        upper.append(lower.pop())
        size += n
    row = F.expr(_FOLD.format(sibs="sibs", start="coalesce(tampered, digest)"))
    at = tree_levels[0].select("doc_id", "digest", F.lit(None).cast("binary").alias("subroot"), row.alias("folded"),
                               F.col("part").alias("proof"), "ptree", "plevel", "ppos")
    wanted = ["tree", "level", "pos", "digest", "sibs", "part", "ptree", "plevel", "ppos"]
    before = spark.conf.get(LIMIT)
    spark.conf.set(LIMIT, "-1")                 # a row per document and stored level
    try:
        for part, hint in ((lower, ""), (upper, "/*+ BROADCAST(n) */")):
            if part:
                nodes = reduce(DataFrame.union, [x.select(*wanted) for _, _, x in part])
                inside = reduce(Column.__or__, [kind & (F.col("plevel") == level) for kind, level, _ in part])
                # rows that have left these nodes
                at = stored(climb(spark, at, nodes, hint).where(~F.coalesce(inside, F.lit(False))), "climb")
    finally:
        spark.conf.set(LIMIT, before)

    def text(c):
        return F.lower(F.hex(c))
    return at.select("doc_id", text("digest").alias("leaf"), text("subroot").alias("subroot"),
                     F.lit(root.hex()).alias("root"), F.sha2(text("proof").cast("binary"), 256).alias("proof_sha256"),
                     text("folded").alias("folded_root"), (F.col("folded") == F.lit(root)).alias("verified"))


def _places(tops: DataFrame) -> DataFrame:
    """``tree, digest, pos, n`` of the subroots in bytewise order of the trees."""
    named = tops.select(F.lit(TOP).alias("tree"), F.col("tree").alias("name"), "digest")
    return stored(positions(named, ["name"]).select(F.col("name").alias("tree"), "digest", "pos", "n"), "places")
