"""A Merkle manifest of a table, and proofs that climb it by a recursive query.

Every row is a leaf: the hash of its fields. Leaves of one group ascend by the order
column and form a tree in which each run of 16 neighbours is hashed into its parent; what
remains is the group's subroot. Subroots, ordered by group, form the tree of the root.

Levels are built bottom up, each a sixteenth of the one before. A stored node row holds
its run of child hashes, its own hash and the key of its parent. A recursive query then
climbs for the leaves: at every node it appends the siblings it passes and folds the leaf
that is to be proven into the node's hash. The 256 leaves of a twig, the two lowest levels,
have the same siblings above it, so they climb in one row with the hashes they differ in;
their siblings within the twig are put before those of the climb at the end.

Nodes near the root are on the way of all leaves. Leaves are numbered over the whole table;
a node row is repeated for each block of numbers below it and a climbing row meets the copy
of its own block, so no key of a join has more rows than a block has runs.

Hashes are kept as 32 bytes and hashed as lower-case hexadecimal text.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wattledger.llm.common import stored

#: Children of a node.
FAN = 16
#: Leaves in a block of the climb.
BLOCK = 4096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree above the groups; a group's tree is "" for null, else "=" and its name.
TOP = "/"
_ROW_BITS = 33  # of monotonically_increasing_id: the row within its partition


def encoded(value: Column) -> Column:
    """The length in bytes, a colon and the value; "-" for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def hashed(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def written(digests: Column) -> Column:
    """Digests that follow each other, as hexadecimal text."""
    return F.lower(F.hex(digests))


def leaf_hash(*values: Column) -> Column:
    return hashed(F.concat(*map(encoded, values)))


def _joined(digests: Column) -> Column:
    """An array of digests as one binary."""
    return F.unhex(F.array_join(F.transform(digests, F.hex), ""))


def _placed(rows: DataFrame, tree: Column, order: list[str], label: str) -> DataFrame:
    """Rows numbered by ``tree`` and ``order``: ``place``, the tree's ``first`` and ``members``.

    ``place`` counts all rows before. Rows are sorted over many tasks, and what is added to
    their number within a task comes from counts: one row per task, and one per task and
    tree in it.
    """
    salted = rows.withColumns({"tree": tree, "salt": F.rand(1)})
    ordered = salted.repartitionByRange("tree", *order, "salt").sortWithinPartitions("tree", *order)
    kept = stored(ordered.drop("salt").withColumn("at", F.monotonically_increasing_id()), label)
    kept = kept.withColumns(
        {"part": F.shiftright("at", _ROW_BITS), "row": F.col("at").bitwiseAND((1 << _ROW_BITS) - 1)}
    )
    counts = stored(
        kept.groupBy("part", "tree").agg(F.min("row").alias("low"), F.count(F.lit(1)).alias("n")),
        f"{label}-counts",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.groupBy("part").agg(F.sum("n").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skipped")
    )
    counts = counts.join(parts, "part")
    trees = counts.groupBy("tree").agg(
        F.min(F.col("skipped") + F.col("low")).alias("first"), F.sum("n").alias("members")
    )
    offsets = stored(counts.join(trees, "tree").drop("low", "n"), f"{label}-offsets")
    return kept.join(offsets, ["part", "tree"]).select(
        "tree", *rows.columns, (F.col("skipped") + F.col("row")).alias("place"), "first", "members"
    )


def _parents(nodes: DataFrame, level: int, label: str) -> DataFrame:
    """The runs of 16 of the trees that still have several nodes, as nodes of ``level``.

    ``n`` counts a tree's nodes of the level, ``low`` and ``high`` bound the leaves below.
    """
    runs = nodes.filter("n > 1").groupBy("tree", F.expr(f"pos div {FAN}").alias("up")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "hash"))).alias("run"),
        F.first("n").alias("below"), F.min("low").alias("low"), F.max("high").alias("high"),
    )
    children = _joined(F.col("run.hash"))
    found = runs.select(
        "tree", F.lit(level).alias("level"), F.col("up").alias("pos"),
        F.expr(f"(below + {FAN - 1}) div {FAN}").alias("n"), "low", "high", children.alias("children"),
    )
    return stored(found.withColumn("hash", hashed(written(F.col("children")))), label)


def _levels(nodes: DataFrame, level: int, label: str) -> list[DataFrame]:
    """The levels above ``nodes``. A level's largest count is all that the driver sees."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    out = []
    while most > 1:
        level += 1
        nodes = _parents(nodes, level, f"{label}-{level}")
        out.append(nodes)
        most = -(-most // FAN)
    return out


def _linked(nodes: DataFrame, ranked: DataFrame, *extra: str) -> DataFrame:
    """Nodes with the key of their parent (``up_tree``, ``up_level``, ``up_pos``), and their
    place among its children (``slot``). A group's last node hangs in the top tree; the root
    has no parent."""
    plain = ("tree", "level", "pos", "n", "low", "high", "hash", *extra)
    link = lambda tree, level, place: [
        tree.alias("up_tree"), level.alias("up_level"),
        F.expr(f"{place} div {FAN}").alias("up_pos"), F.expr(f"cast({place} % {FAN} as int)").alias("slot"),
    ]
    inner = nodes.filter("n > 1").select(*plain, *link(F.col("tree"), F.col("level") + 1, "pos"))
    last = nodes.filter("n = 1").join(ranked, "tree", "left")
    several = F.coalesce(F.col("groups") > 1, F.lit(False))
    above = F.when(several, F.lit(TOP))
    return inner.unionByName(
        last.select(*plain, *link(above, F.when(several, F.lit(1)), "rank")).withColumns(
            {c: F.when(F.col("up_tree").isNotNull(), F.col(c)) for c in ("up_pos", "slot")}
        )
    )


@contextmanager
def _any_number_of_rows(spark: SparkSession):
    """Recursive queries stop at a row limit by default."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _replaced(children: str, slot: str, digest: str) -> str:
    """SQL: the hash of a run of children with another digest at a slot."""
    run = f"concat(substring({children}, 1, 32 * {slot}), {digest}, substring({children}, 32 * {slot} + 33))"
    return f"unhex(sha2(cast(lower(hex({run})) AS binary), 256))"


def _others(children: str, slot: str) -> str:
    """SQL: a run of children without the one at a slot."""
    return f"concat(substring({children}, 1, 32 * {slot}), substring({children}, 32 * {slot} + 33))"


FOLDS = f"""flatten(transform(runs, (r, i) -> transform(r.leaves, (x, j) -> CASE
    WHEN alone THEN x.given
    WHEN single THEN {_replaced('r.children', 'j', 'x.given')}
    ELSE {_replaced('children', 'i', _replaced('r.children', 'j', 'x.given'))} END)))"""

CLIMB = f"""
WITH RECURSIVE climb (twig, folds, shared, subroot, hash, block, up_tree, up_level, up_pos, slot) AS (
    SELECT low, folds, unhex(''), CASE WHEN n = 1 THEN hash END, hash, low div {BLOCK}, up_tree, up_level, up_pos, slot
    FROM {{twigs}}
    UNION ALL
    SELECT c.twig, transform(c.folds, x -> {_replaced('p.children', 'c.slot', 'x')}),
        concat(c.shared, {_others('p.children', 'c.slot')}),
        coalesce(c.subroot, CASE WHEN p.n = 1 AND p.tree <> '{TOP}' THEN p.hash END),
        p.hash, c.block, p.up_tree, p.up_level, p.up_pos, p.slot
    FROM climb c JOIN {{nodes}} p
        ON p.tree = c.up_tree AND p.level = c.up_level AND p.pos = c.up_pos AND p.block = c.block
), arrived AS (
    SELECT posexplode(t.runs) AS (i, run), t.children, t.single, t.ways, c.folds, c.shared, c.subroot, c.hash AS root
    FROM (SELECT * FROM climb WHERE up_tree IS NULL) c JOIN {{twigs}} t ON c.twig = t.low
), one AS (SELECT *, posexplode(run.leaves) AS (j, leaf) FROM arrived)
SELECT leaf.id, leaf.leaf, subroot, root, folds[ways[{FAN} * i + j] - 1] AS folded,
    concat({_others('run.children', 'j')}, CASE WHEN single THEN unhex('') ELSE {_others('children', 'i')} END, shared)
        AS siblings
FROM one
"""


def _twigs(placed: DataFrame) -> DataFrame:
    """The two lowest levels: a row for 16 runs of 16 leaves, or what a small tree has.

    A tree of one run has that run's hash (``single``), of one leaf the leaf (``alone``).
    """
    within = F.col("place") - F.col("first")
    runs = placed.groupBy("tree", F.floor(within / FAN).alias("pos")).agg(
        F.array_sort(F.collect_list(F.struct("place", "id", "leaf", "given"))).alias("leaves"),
        F.first("members").alias("members"),
    )
    bare = lambda x: F.struct(*(x[c].alias(c) for c in ("id", "leaf", "given")))
    runs = runs.select(
        "tree", "pos", "members", F.col("leaves")[0]["place"].alias("low"),
        F.transform("leaves", bare).alias("leaves"), _joined(F.col("leaves.leaf")).alias("children"),
    )
    alone, single = F.col("members") == 1, F.col("members") <= FAN
    hash_of = lambda own: F.coalesce(own, hashed(written(F.col("children"))))
    runs = runs.withColumn("hash", hash_of(F.when(alone, F.col("children"))))
    of = F.struct("pos", "children", "hash", "leaves")
    twigs = runs.groupBy("tree", F.expr(f"pos div {FAN}").alias("up"), "members").agg(
        F.array_sort(F.collect_list(of)).alias("runs"), F.min("low").alias("low")
    )
    twigs = twigs.select(
        "tree", F.lit(1).alias("level"), F.col("up").alias("pos"),
        F.expr(f"(members + {FAN * FAN - 1}) div {FAN * FAN}").alias("n"), "low",
        (F.col("low") + (F.size("runs") - 1) * FAN + F.size(F.element_at("runs", -1)["leaves"])).alias("high"),
        "runs", _joined(F.col("runs.hash")).alias("children"), single.alias("single"), alone.alias("alone"),
    )
    twigs = twigs.withColumn("hash", hash_of(F.when(F.col("single"), F.col("children"))))
    each = twigs.withColumn("each", F.expr(FOLDS)).withColumn("folds", F.array_distinct("each"))
    ways = F.expr("transform(each, f -> cast(array_position(folds, f) AS int))")
    return stored(each.withColumn("ways", ways).drop("each", "alone"), "merkle-twigs")


def proofs(leaves: DataFrame) -> DataFrame:
    """Proofs of (group, id, leaf, given): (id, leaf, subroot, root, siblings, folded).

    ``leaf`` and ``given`` are digests, ``siblings`` the digests beside the way to the root,
    from the leaf's run on, left to right. ``folded`` is the root that ``given`` leads to.
    Leaves of a group ascend by id, null first, equal ids by their digests; rows that agree
    in all are interchangeable. A group of one leaf has it as its subroot, one group
    only has its subroot as the root. An empty table gives no rows.
    """
    tree = F.when(F.col("group").isNull(), "").otherwise(F.concat(F.lit("="), F.col("group").cast("string")))
    placed = _placed(
        leaves.select("group", "id", "leaf", "given"), tree, ["id", "leaf", "given"], "merkle-leaves"
    )
    twigs = _twigs(placed)
    levels = _levels(twigs, 1, "merkle-level")
    last = [x.filter("n = 1").select("tree", "hash", "low", "high") for x in (twigs, *levels)]
    subroots = reduce(DataFrame.unionByName, last).withColumnRenamed("tree", "name")
    ranked = stored(
        _placed(subroots, F.lit(TOP), ["name"], "merkle-subroots").select(
            F.col("name").alias("tree"), F.col("place").alias("rank"), F.col("members").alias("groups"),
            "hash", "low", "high",
        ),
        "merkle-ranks",
    )
    base = ranked.select(
        F.lit(TOP).alias("tree"), F.col("rank").alias("pos"), F.col("groups").alias("n"), "low", "high", "hash"
    )
    ranks = ranked.select("tree", "rank", "groups")
    above = [*levels, *_levels(base, 0, "merkle-top")] or [twigs.filter("false")]
    nodes = reduce(DataFrame.unionByName, (_linked(x, ranks, "children") for x in above))
    blocks = F.sequence(F.expr(f"low div {BLOCK}"), F.expr(f"(high - 1) div {BLOCK}"))
    nodes = stored(nodes.withColumn("block", F.explode(blocks)).drop("low", "high"), "merkle-nodes")
    anchors = stored(_linked(twigs, ranks, "runs", "children", "single", "folds", "ways"), "merkle-anchors")
    spark = leaves.sparkSession
    with _any_number_of_rows(spark):
        return stored(spark.sql(CLIMB, twigs=anchors, nodes=nodes), "merkle-proofs")


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    group: str = "source",
    order: str = "doc_id",
    changed: dict[str, Column] | None = None,
) -> DataFrame:
    """(order, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    ``changed`` replaces fields of a row after the manifest was made; ``folded_root`` is
    what the changed row and the row's siblings lead to, and ``verified`` whether that is the
    root. Hashes are lower-case hexadecimal. Null fields, groups and ids are values of their
    own; texts are hashed whole. Extra columns are ignored.
    """
    given = changed or {}
    leaf = leaf_hash(*(F.col(c) for c in fields))
    after = leaf_hash(*(given.get(c, F.col(c)) for c in fields)) if given else leaf
    hashes = stored(
        docs.select(
            F.col(group).alias("group"), F.col(order).cast("long").alias("id"), leaf.alias("leaf"),
            after.alias("given"),
        ),
        "merkle-hashes",
    )
    found = proofs(hashes)
    return found.select(
        F.col("id").alias(order), *(written(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")),
        F.sha2(written(F.col("siblings")).cast("binary"), 256).alias("proof_sha256"),
        written(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def lowered_ascii(text: Column) -> Column:
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return F.translate(text, upper, upper.lower())
