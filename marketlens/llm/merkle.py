"""Merkle manifest of a dataset: a tree per source, a tree over their roots, proofs by pointer jumping.

H is SHA-256 in lowercase hex of its inputs, concatenated; digests go in as hex text. A leaf is H of the
fields of a row, each as the number of its UTF-8 bytes, a colon and its value, or `-` if null. The leaves
of a source ascend by id (null first, ties by digest). While a tree has more than one node at its top,
every `FANOUT` consecutive ones become their H. The roots of the sources, by source (null first, UTF-8
bytewise), are the leaves of the tree above them; its root is the dataset's.

Every node holds a pointer to an ancestor and the siblings on the way, level by level, left and right of
it: at first to its parent. A round joins the pointers with themselves, each node with its ancestor's,
which doubles the distance and concatenates the siblings; after the logarithm of the depth all point to
the root. The 16 nodes of a run have the way above them in common, so it is kept once, for their parent:
the pointers are those of inner nodes, and a leaf takes the last hop by a join with its parent's. Digests
of proofs, and the roots that are folded from them, are computed on the way out; no proof is stored
per leaf.

Leaves are numbered in one range shuffle over their digests. Each tree level aggregates 16 digests.
The ways are long where few nodes point to an ancestor and short where many do, except near the root:
there the ancestors are few, and are broadcast if their stored size allows.

Cases: null, empty and very long texts are values like any other. A null source is a source, null
ids are one id. Rows that repeat an id, or all fields, are leaves of their own. A lone leaf is its
source's root, and the root of all if there is no other. No rows give none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import numbered, stored
from marketlens.session import durable

FANOUT = 16
#: Names of trees: of the null source, of a source (before its name), of the tree above them, in this order.
NULL_TREE, TREE, TOP = "n", "s", "t"
HEX = 64
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PATH = "array<struct<left:binary,right:binary>>"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def _tree(source: Column) -> Column:
    return F.when(source.isNull(), NULL_TREE).otherwise(F.concat(F.lit(TREE), source))


def _hex(data: Column) -> Column:
    return F.lower(F.hex(data))


def _depth(nodes: int) -> int:
    """Levels above the leaves."""
    depth = 0
    while nodes > 1:
        nodes, depth = -(-nodes // FANOUT), depth + 1
    return depth


def _node(tree: Column, level: Column, idx: Column) -> Column:
    return F.struct(tree.alias("tree"), level.cast("int").alias("level"), idx.cast("long").alias("idx"))


def levels(leaves: DataFrame, depth: int) -> list[DataFrame]:
    """The inner nodes of trees from `leaves` (tree, idx, digest, n), a stored table per level: tree,
    level, idx, n (nodes of the level), digest, children (their digests, concatenated)."""
    out, below = [], leaves.select("tree", "idx", "digest", "n")
    for level in range(1, depth + 1):
        runs = below.where("n > 1").groupBy("tree", F.expr(f"idx div {FANOUT}").alias("run"))
        members = F.sort_array(F.collect_list(F.struct("idx", "digest")))
        rows = runs.agg(F.array_join(members["digest"], "").alias("text"), F.first("n").alias("under"))
        out.append(
            durable(
                rows.select(
                    "tree", F.lit(level).alias("level"), F.col("run").alias("idx"), F.expr(f"(under + {FANOUT - 1}) div {FANOUT}").alias("n"),
                    F.sha2("text", 256).alias("digest"), F.unhex("text").alias("children"),
                )
            )
        )
        below = out[-1]
    return out


def _beside(children: Column, idx: Column) -> Column:
    """The siblings of a node among its parent's children."""
    place = (idx % FANOUT).cast("int") * (HEX // 2)
    return F.struct(
        F.substring(children, F.lit(1), place).alias("left"), F.substring(children, place + (HEX // 2 + 1), F.lit(HEX // 2 * FANOUT)).alias("right")
    )


@dataclass(frozen=True)
class Manifest:
    """leaves: the rows' columns, tree, idx, n and digest. runs: node (the parent of leaves, or a lone
    leaf), children, subroot, path (siblings of the node and its ancestors). root: None without rows."""

    leaves: DataFrame
    runs: DataFrame
    root: str | None


def _pointers(nodes: DataFrame, tops: DataFrame) -> DataFrame:
    """Of every inner node the pointer to its parent: node, height, children, subroot, up, path."""
    parents = nodes.where("children IS NOT NULL").select(_node(F.col("tree"), F.col("level"), F.col("idx")).alias("up"), F.col("children").alias("family"))
    rows = nodes.join(tops, "tree", "left")
    top = F.col("n") == 1
    above = _node(F.lit(TOP), F.lit(0), F.col("place"))
    parent = _node(F.col("tree"), F.col("level") + 1, F.expr(f"idx div {FANOUT}"))
    node = _node(F.col("tree"), F.col("level"), F.col("idx"))
    up = F.when(~top, parent).when(F.col("tree") == TOP, node).otherwise(above)
    # children are of use to leaves only
    own = F.when(F.col("level") == 1, F.col("children"))
    rows = rows.select(node.alias("node"), "height", own.alias("children"), "subroot", up.alias("up"), top.alias("top"), F.col("idx").alias("i"))
    joined = rows.where("NOT top").join(parents, "up").select("node", "height", "children", "subroot", "up", F.array(_beside(F.col("family"), F.col("i"))).cast(_PATH).alias("path"))
    alone = rows.where("top").select("node", "height", "children", "subroot", "up", F.array().cast(_PATH).alias("path"))
    return durable(joined.unionByName(alone))


def manifest(docs: DataFrame, fields: list[str], id_col: str = "doc_id", source_col: str = "source", also: dict[str, Column] | None = None) -> Manifest:
    """The trees over `docs` and the ways from the parents of leaves to the root. `also` are further
    columns of the leaves, of `docs`."""
    rows = docs.select(
        docs[id_col].alias("doc_id"), _tree(docs[source_col].cast("string")).alias("tree"), leaf_digest(*[docs[c] for c in fields]).alias("digest"),
        *[c.alias(name) for name, c in (also or {}).items()],
    )
    leaves = durable(numbered(rows, "tree", [F.col("doc_id").asc_nulls_first(), F.col("digest")]))
    deepest = _depth(leaves.agg(F.max("n")).first()[0] or 0)
    lone = leaves.where("n = 1").select("tree", F.lit(0).alias("level"), "idx", "n", "digest", F.lit(None).cast("binary").alias("children"))
    nodes = lone
    for level in levels(leaves, deepest):
        nodes = nodes.unionByName(level)
    subroots = nodes.where("n = 1").select("tree", F.col("digest").alias("subroot"), F.lit(0).alias("one"))
    subroots = durable(numbered(subroots, "one", [F.col("tree")]).withColumnRenamed("idx", "place"))
    sources = subroots.count()
    upper = subroots.select(F.lit(TOP).alias("tree"), F.lit(0).alias("level"), F.col("place").alias("idx"), "n", F.col("subroot").alias("digest"))
    hops = max(deepest, 1)  # at most, from a node over leaves, or a lone leaf, to the tree above
    height = F.when(F.col("tree") == TOP, F.col("level") + hops).otherwise(F.col("level"))
    nodes = nodes.unionByName(upper.withColumn("children", F.lit(None).cast("binary")))
    depth = _depth(sources)
    top = None
    for top in levels(upper, depth):
        nodes = nodes.unionByName(top)
    last = (upper if top is None else top).where("n = 1").select("digest").first()
    _, tops = stored(subroots.select("tree", "subroot", "place"))
    pointers = _pointers(nodes.withColumn("height", height), tops)
    root = _node(F.lit(TOP), F.lit(depth), F.lit(0))
    far = 1
    while far < hops + depth:  # pointers span `far` levels, or reach the root
        nearer = pointers.where(F.col("height") >= far).select(F.col("node").alias("up"), F.col("up").alias("next"), F.col("path").alias("rest"))
        if far > 2:  # many nodes to an ancestor, so few ancestors
            _, nearer = stored(nearer)
        going = pointers.where(F.col("up") != root).join(nearer, "up")
        going = going.select("node", "height", "children", "subroot", F.col("next").alias("up"), F.concat("path", "rest").alias("path"))
        pointers = durable(going.unionByName(pointers.where(F.col("up") == root)))
        far *= 2
    runs = pointers.where(f"node.tree <> '{TOP}' AND node.level <= 1").select("node", "children", "subroot", "path")
    return Manifest(leaves, runs, last and last["digest"])


def proofs(built: Manifest) -> DataFrame:
    """The leaves with subroot, and path: the siblings left and right of the leaf and of its ancestors."""
    node = _node(F.col("tree"), F.when(F.col("n") > 1, 1).otherwise(0), F.expr(f"idx div {FANOUT}"))
    rows = built.leaves.withColumn("node", node).join(built.runs.withColumnRenamed("path", "way"), "node")
    own = F.array(_beside(F.col("children"), F.col("idx"))).cast(_PATH)
    path = F.when(F.col("n") > 1, F.concat(own, "way")).otherwise(F.col("way"))
    return rows.withColumn("path", path).drop("node", "way", "children")


def proof_digest(path: Column) -> Column:
    """H of the siblings of a path, in order."""
    return F.sha2(F.array_join(F.transform(path, lambda s: _hex(F.concat(s["left"], s["right"]))), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way lead to."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(_hex(s["left"]), acc, _hex(s["right"])), 256))


def verified(
    docs: DataFrame, fields: list[str], id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", tampered: Column | None = None
) -> DataFrame:
    """A row per row of `docs`: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. Where
    `tampered` holds, the text's A-Z are lower-cased in what is folded."""
    tampered = F.lit(False) if tampered is None else tampered
    changed = F.translate(docs[text_col], UPPER, UPPER.lower())
    other = F.when(tampered, leaf_digest(*[changed if c == text_col else docs[c] for c in fields]))
    built = manifest(docs, fields, id_col, source_col, {"other": other})
    rows = proofs(built).withColumn("folded_root", folded(F.coalesce("other", "digest"), F.col("path")))
    root = F.lit(built.root).cast("string")
    return rows.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", root.alias("root"), proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def tampered_fifth(doc_id: Column) -> Column:
    """Whether 5 divides the CRC-32 of the decimal id; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))
