"""Merkle manifest of a corpus: one digest over all documents, and per document the proof that it is in it.

Build.  A document's leaf is the SHA-256 of its fields.  Per source the leaves
ascend by doc_id, and every 16 consecutive nodes become one node above until
one, the subroot, remains; the subroots, ordered by source, become the root in
the same way.  Leaves are numbered without a window over a source: one range
shuffle, then the place inside the partition plus the rows of earlier ones.

Climb.  Every node below the root is stored as a row (node, parent, digests of
its run left and right of it).  A Spark recursive query joins what it holds
with these rows level by level, appends the siblings and folds the digest it
came with.  All leaves of one lowest run share every sibling above that run,
so the recursion carries one row per run with its up to 16 leaves' folded
digests in an array: about a tenth of the bytes of a row per leaf.  Digests
are bytes while they climb and hex text where they are hashed.  Rows of
nodes that stand over many runs are stored once per ``RUNS_A_COPY`` of them and
joined on (node, copy), so that the rows of the root's children, which every
climb meets, are no hot key.

Odd input.  Any field may be null (it counts as ``-``); a null doc_id comes
first and is never tampered with; null and empty texts differ.  Repeated
doc_ids stand side by side, ordered by leaf digest; rows that are equal in all
fields are equal leaves, each with its own place and result row.  A lone
document's leaf is its subroot and a lone source's subroot is the root.  An
empty table gives an empty result.  Columns beyond the five fields are ignored.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._tables import materialize

#: Nodes that become one node of the level above.
FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Runs of leaves that climb over one stored copy of a node row.
RUNS_A_COPY = 4096
#: monotonically_increasing_id: partition number above, place in the partition below.
PLACE_BITS = 33
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

RESULT = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")

CLIMB = """
    WITH RECURSIVE climb (node, copy, spread, members, proof, subroot) AS (
        SELECT node, copy, spread, members, proof, subroot FROM {starts}
      UNION ALL
        SELECT n.parent, pmod(c.spread, n.parent_copies), c.spread,
               transform(c.members, m -> struct(m.doc_id AS doc_id, m.leaf AS leaf,
                                                unhex(sha2(lower(hex(concat(n.left, m.folded, n.right))), 256)) AS folded)),
               concat(c.proof, n.left, n.right),
               CASE WHEN n.is_subroot THEN n.digest ELSE c.subroot END
        FROM climb c JOIN {nodes} n ON c.node = n.node AND c.copy = n.copy)
    SELECT members, proof, subroot FROM climb WHERE node = {root}"""


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _leaf(text: Column) -> Column:
    return F.sha2(F.concat(*[_field(text if c == "text" else F.col(c)) for c in FIELDS]), 256)


def default_tampering(doc_id: Column, text: Column) -> Column:
    """The text with A-Z lower-cased where 5 divides the CRC-32 of doc_id; else null (left alone)."""
    chosen = F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0
    return F.when(chosen, F.translate(text, UPPER, LOWER))


def _numbered(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` with ``place``: number of each row in its group (from 0, nulls first, equal rows in any order).

    One range shuffle deals the sorted rows out, whatever a group's size; the
    rows before a partition come from a table of (partition, group) counts.
    """
    keys = [F.col(c).asc_nulls_first() for c in (*group, *order, "__tie")]
    dealt = materialize(
        df.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
        .drop("__tie").withColumn("__at", F.monotonically_increasing_id()), name)
    part = F.shiftright("__at", PLACE_BITS)
    rows = dealt.groupBy(part.alias("__part"), *group).agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    before = "coalesce(sum(__n) over (partition by {} order by __part rows between unbounded preceding and 1 preceding), 0)"
    starts = rows.select(F.col("__part").alias("__p"), "__first", *[F.col(c).alias(f"__g{i}") for i, c in enumerate(group)],
                         F.expr(before.format(", ".join(group) or "1")).alias("__before"))
    same = part == F.col("__p")
    for i, c in enumerate(group):
        same &= F.col(c).eqNullSafe(F.col(f"__g{i}"))
    return dealt.join(starts, same).select(
        *df.columns, (F.col("__at") - F.col("__first") + F.col("__before")).alias("place"))


def _node(tree: Column, level: int, place: Column) -> Column:
    return F.concat_ws(".", tree.cast("string"), F.lit(str(level)), place.cast("string"))


def _copies(runs: str) -> Column:
    return F.ceil(F.col(runs) / F.lit(RUNS_A_COPY))


def _level(nodes: DataFrame, level: int, top: bool) -> tuple[DataFrame, DataFrame]:
    """Rows of the nodes of one level (with their siblings), and the nodes of the level above.

    ``nodes``: (tree, place, digest, runs, node, subroot flag); every tree in
    it has at least two nodes.  A run is at most 16 rows, so no group grows.
    """
    runs = nodes.groupBy("tree", F.floor(F.col("place") / FAN).alias("above")).agg(
        F.sort_array(F.collect_list(F.struct("place", "digest", "runs", "node"))).alias("run"),
        F.sum("runs").alias("run_runs"))
    digests = F.transform("run", lambda m: m["digest"])
    runs = runs.select("*", digests.alias("digests"), F.sha2(F.concat_ws("", digests), 256).alias("digest"),
                       _node(F.lit("top") if top else F.col("tree"), level + 1, F.col("above")).alias("parent"))
    rows = runs.select("digests", "parent", "run_runs", F.posexplode("run").alias("i", "m")).select(
        F.col("m.node").alias("node"), "parent", F.col("m.digest").alias("digest"),
        F.unhex(F.concat_ws("", F.slice("digests", F.lit(1), F.col("i")))).alias("left"),
        F.unhex(F.concat_ws("", F.slice("digests", F.col("i") + 2, F.lit(FAN)))).alias("right"),
        F.lit(top and level == 0).alias("is_subroot"),
        _copies("run_runs").alias("parent_copies"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("m.runs") / F.lit(RUNS_A_COPY)),
                                                              F.lit(1)) - 1)).alias("copy"))
    above = runs.select("tree", F.col("above").alias("place"), "digest", F.col("run_runs").alias("runs"),
                        F.col("parent").alias("node"))
    return rows, above


@contextmanager
def _unlimited_recursion(spark: SparkSession):
    """A climb has as many rows as the corpus has runs; Spark's limit on a recursion's rows must not stop it."""
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def build_manifest(documents: DataFrame, tampering=default_tampering) -> tuple[DataFrame, DataFrame, str | None]:
    """Lowest runs, node rows, and the root digest (null for an empty table).

    Runs hold (node, spread, members with doc_id, leaf and folded digest, the
    copy of the node row to climb over); ``tampering(doc_id, text)`` gives the
    text that a proof is folded from, or null for the stored one.
    """
    spark = documents.sparkSession
    wanted = documents.select(*FIELDS)
    changed = tampering(F.col("doc_id"), F.col("text"))
    leaves = materialize(wanted.select(
        "doc_id", "source", _leaf(F.col("text")).alias("leaf"),
        F.when(changed.isNotNull(), _leaf(changed)).alias("tampered")), "leaves")
    trees = materialize(_numbered(leaves.groupBy("source").agg(F.count("*").alias("n")), [], ["source"], "sources")
                        .withColumnRenamed("place", "tree"), "trees")
    n_trees, most = trees.agg(F.count("*"), F.max("n")).first()
    if not n_trees:
        return None, None, None
    own = trees.select(F.col("source").alias("__s"), "tree", "n")
    placed = _numbered(leaves, ["source"], ["doc_id", "leaf"], "placed").join(
        own, F.col("source").eqNullSafe(F.col("__s")))
    digests = F.transform("run", lambda m: m["leaf"])
    told = lambda m: F.coalesce(m["tampered"], m["leaf"])

    def folded(m: Column, i: Column) -> Column:
        hashed = F.sha2(F.concat_ws("", F.slice("digests", F.lit(1), i), F.array(told(m)),
                                    F.slice("digests", i + 2, F.lit(FAN))), 256)
        return F.struct(m["doc_id"].alias("doc_id"), F.unhex(m["leaf"]).alias("leaf"),
                        F.unhex(F.when(F.col("n") == 1, told(m)).otherwise(hashed)).alias("folded"))

    runs = placed.groupBy("tree", "n", F.floor(F.col("place") / FAN).alias("place")).agg(
        F.sort_array(F.collect_list(F.struct("place", "doc_id", "leaf", "tampered"))).alias("run"))
    runs = runs.select("*", digests.alias("digests")).select(
        "tree", "n", "place", F.when(F.col("n") == 1, F.element_at("digests", 1)).otherwise(
            F.sha2(F.concat_ws("", "digests"), 256)).alias("digest"),
        F.transform("run", folded).alias("members"), _node(F.col("tree"), 1, F.col("place")).alias("node"))
    runs = materialize(runs, "runs")

    nodes, subroots = [], []
    level = runs.select("tree", "place", "digest", F.lit(1).cast("long").alias("runs"), "node", "n")
    span, depth = FAN, 1
    while True:
        subroots.append(level.where(F.col("n") <= span).drop("n"))
        if most <= span:
            break
        rows, above = _level(level.where(F.col("n") > span).drop("n"), depth, top=False)
        nodes.append(rows)
        level = materialize(above.join(trees.select("tree", "n"), "tree"), f"level-{depth}")
        span, depth = span * FAN, depth + 1
    below = subroots[0]
    for more in subroots[1:]:
        below = below.unionByName(more)
    below = materialize(below.select(F.lit("top").alias("tree"), F.col("tree").alias("place"), "digest", "runs", "node"),
                        "subroots")
    left, depth = n_trees, 0
    while left > 1:
        rows, above = _level(below, depth, top=True)
        nodes.append(rows)
        below = materialize(above, f"top-{depth}")
        left, depth = -(-left // FAN), depth + 1
    root = below.select("digest", "node").first()
    everything = None
    for rows in nodes:
        everything = rows if everything is None else everything.unionByName(rows)
    if everything is not None:
        everything = materialize(everything, "nodes")
    starts = runs.select(
        "node", F.lit(0).cast("long").alias("copy"), F.xxhash64("tree", "place").alias("spread"), "members",
        F.lit(b"").alias("proof"), F.when(F.lit(n_trees == 1), F.lit(root["digest"])).alias("subroot"))
    return starts, everything, root


def prove(documents: DataFrame, tampering=default_tampering) -> DataFrame:
    """One row per document: its leaf, subroot and the root, the digest of its proof, and the climb's outcome.

    ``folded_root`` is what the tampered (else the stored) leaf and the stored
    siblings give; ``verified`` says whether that is the root.
    """
    spark = documents.sparkSession
    starts, nodes, root = build_manifest(documents, tampering)
    if starts is None:
        kinds = {"verified": "boolean", "doc_id": documents.schema["doc_id"].dataType.simpleString()}
        return spark.createDataFrame([], ", ".join(f"{c} {kinds.get(c, 'string')}" for c in RESULT))
    if nodes is None:
        ends = starts.select("members", "proof", "subroot")
    else:
        with _unlimited_recursion(spark):
            ends = materialize(spark.sql(CLIMB, starts=starts, nodes=nodes, root=root["node"]), "climb")
    shown = lambda c: F.lower(F.hex(c))
    others = F.concat_ws("", F.slice("leaves", F.lit(1), F.col("i")), F.slice("leaves", F.col("i") + 2, F.lit(FAN)))
    return (ends.select("proof", "subroot", F.transform("members", lambda m: shown(m["leaf"])).alias("leaves"),
                        F.posexplode("members").alias("i", "m"))
            .select(F.col("m.doc_id").alias("doc_id"), shown("m.leaf").alias("leaf"), "subroot",
                    F.lit(root["digest"]).alias("root"),
                    F.sha2(F.concat(others, shown("proof")), 256).alias("proof_sha256"),
                    shown("m.folded").alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
