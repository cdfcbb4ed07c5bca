"""A Merkle manifest of documents: one tree per group (language), a tree over the groups' roots, and a
proof for every document.

The place of a leaf in its tree is its doc_id's rank.  It is looked up, not sorted for: each group's ids
are a bitmap of 64-bit words, of which only words with a bit are kept; counts of bits in words, blocks
of words and everything before a block form a directory, so that the rank of an id is two additions and
the count of the bits below its own.  Nodes then fall into slots of subtrees of ``1 << LEVELS`` leaves;
each subtree is reduced in one group, and a few rounds of that reach the root, whatever the number of
documents.  Proofs go the same way down."""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwell.llm.prefix import running_sums
from tierwell.sources.shared import stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of the tree that one group of rows reduces: 1,024 nodes.
LEVELS = 10
#: Words of 64 ids in a block: 1,024.
BLOCK = 10
#: The word of rows without an id, before that of any id.
NO_WORD = -(1 << 62)


def leaf(fields: Sequence[Column]) -> Column:
    """SHA-256 in lowercase hex of the fields one after another: ``-`` for null, else the number of UTF-8
    bytes, ``:`` and the value."""
    shown = [c.cast("string") for c in fields]
    parts = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in shown]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaves(docs: DataFrame, claimed: Column | None = None) -> DataFrame:
    """The leaf of every document.  ``claimed`` is the leaf of what is to be verified, by default the same."""
    own = leaf([F.col(c) for c in FIELDS])
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        # Sorts as the group does, null first, and is never null.
        F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("tree"),
        own.alias("leaf"),
        (own if claimed is None else F.coalesce(claimed, own)).alias("claimed"),
    )


def _word(doc_id: str) -> Column:
    return F.coalesce(F.shiftright(doc_id, 6), F.lit(NO_WORD))


def _shifted(value: int) -> Column:
    """``value`` shifted to the place of the row's id in its word."""
    return F.call_function("shiftleft", F.lit(value).cast("long"), F.col("doc_id").bitwiseAND(63).cast("int"))


def directory(found: DataFrame) -> DataFrame:
    """The words of all groups' bitmaps: tree, word, bits, whether each bit is one row, the rank of the
    word's first row in its tree, and the tree's number of rows.

    Windows see at most the words of one block; blocks are summed by ``running_sums``."""
    bit = _shifted(1)
    words = stored(
        found.groupBy("tree", _word("doc_id").alias("word")).agg(
            F.coalesce(F.bit_or(bit), F.lit(0).cast("long")).alias("bits"), F.count(F.lit(1)).alias("rows")
        ),
        "words",
    ).withColumn("block", F.shiftright("word", BLOCK))
    blocks = running_sums(words.groupBy("tree", "block").agg(F.sum("rows").alias("rows")), ["tree", "block"], {"before": "rows"})
    blocks = stored(blocks, "blocks")
    trees = blocks.groupBy("tree").agg(F.min("before").alias("first"), F.sum("rows").alias("n"))
    blocks = blocks.join(trees, "tree").select("tree", "block", (F.col("before") - F.col("first")).alias("before"), "n")
    inside = Window.partitionBy("tree", "block").orderBy("word").rowsBetween(Window.unboundedPreceding, -1)
    return (
        words.withColumn("inside", F.coalesce(F.sum("rows").over(inside), F.lit(0)))
        .join(blocks, ["tree", "block"])
        .select("tree", "word", "bits", (F.bit_count("bits") == F.col("rows")).alias("single"), (F.col("before") + F.col("inside")).alias("first"), "n")
    )


def coordinates(found: DataFrame) -> DataFrame:
    """``found`` (doc_id, tree and more) with ``idx``, the row's rank by doc_id in its tree from 0, and
    ``n``, the tree's number of rows.

    A bitmap knows an id once.  In words where ids repeat, and for rows without an id, rows are ranked
    by doc_id, leaf and place in the scan; only those rows are sorted, by ranges, however many they are."""
    found = stored(found.withColumn("place", F.monotonically_increasing_id()), "leaves")
    words = stored(directory(found), "directory")
    worded = found.withColumn("word", _word("doc_id"))
    below = F.bitwise_not(_shifted(-1))
    kept = [c for c in found.columns if c != "place"]
    clean = worded.join(words.where("single"), ["tree", "word"]).select(
        *kept, (F.col("first") + F.bit_count(F.col("bits").bitwiseAND(below))).alias("idx"), "n"
    )
    repeated = worded.join(words.where("NOT single"), ["tree", "word"]).withColumn("one", F.lit(1).cast("long"))
    ranked = stored(running_sums(repeated, ["tree", "word", "doc_id", "leaf", "place"], {"rank": "one"}), "repeated")
    starts = ranked.groupBy("tree", "word").agg(F.min("rank").alias("start"))
    sorted_out = ranked.join(starts, ["tree", "word"]).select(*kept, (F.col("first") + F.col("rank") - F.col("start")).alias("idx"), "n")
    return clean.unionByName(sorted_out)


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _subtree(digests: list[str], n: int, levels: int) -> list[list[str]]:
    """The levels over neighbouring nodes of a level with ``n`` nodes, as many as one round reduces."""
    out = [digests]
    for _ in range(min(levels, (n - 1).bit_length())):
        own = out[-1]
        out.append([_hash("".join(own[i : i + 2])) for i in range(0, len(own), 2)])
    return out


def _ordered(nodes: pa.Table) -> pa.Table:
    return nodes.sort_by("idx")


def _group(levels: int) -> Column:
    """The subtree a node falls into."""
    return F.shiftright("idx", levels).alias("group")


_NODES = "tree string, idx long, n long, digest string"


def _reduced(levels: int):
    def run(key: tuple[pa.Scalar, ...], nodes: pa.Table) -> pa.Table:
        nodes = _ordered(nodes)
        n = nodes.column("n")[0].as_py()
        top = _subtree(nodes.column("digest").to_pylist(), n, levels)[-1]
        return pa.table({"tree": [key[0].as_py()], "idx": [key[1].as_py()], "n": [-(-n // (1 << levels))], "digest": top}, schema=_arrow(_NODES))

    return run


_ARROW = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}


def _arrow(columns: str) -> pa.Schema:
    return pa.schema([(name, _ARROW[kind]) for name, kind in (c.split() for c in columns.split(", "))])


def _rounds(nodes: DataFrame, widest: int, levels: int) -> list[DataFrame]:
    """``nodes`` and the results of the rounds over them, the last with one row per tree."""
    found = [nodes]
    while widest > 1:
        groups = found[-1].select("tree", "idx", "n", "digest").groupBy("tree", _group(levels))
        found.append(stored(groups.applyInArrow(_reduced(levels), _NODES), "nodes"))
        widest = -(-widest // (1 << levels))
    return found


_PATHS = "tree string, idx long, subroot string, root string, path array<string>"


def _steps(nodes: pa.Table, levels: int) -> list[list[str]]:
    """The path of each node to the top of its subtree: ``L`` or ``R`` and the sibling, ``-`` for none."""
    found = _subtree(nodes.column("digest").to_pylist(), nodes.column("n")[0].as_py(), levels)
    out: list[list[str]] = [[] for _ in found[0]]
    for height, level in enumerate(found[:-1]):
        for slot, path in enumerate(out):
            own = slot >> height
            other = own ^ 1
            path.append("-" if other >= len(level) else ("L" if own & 1 else "R") + level[other])
    return out


def _descended(levels: int):
    def run(key: tuple[pa.Scalar, ...], nodes: pa.Table, above: pa.Table) -> pa.Table:
        nodes = _ordered(nodes)
        subroot, root, path = (above.column(c)[0].as_py() for c in ("subroot", "root", "path"))
        count, steps = nodes.num_rows, _steps(nodes, levels)
        columns = {"tree": nodes.column("tree"), "idx": nodes.column("idx"), "subroot": [subroot] * count, "root": [root] * count, "path": [p + path for p in steps]}
        return pa.table(columns, schema=_arrow(_PATHS))

    return run


_PROOFS = "doc_id long, tree string, leaf string, subroot string, root string, siblings array<string>, proof_sha256 string, folded_root string, verified boolean"


def _proved(levels: int, siblings: bool):
    def run(key: tuple[pa.Scalar, ...], nodes: pa.Table, above: pa.Table) -> pa.Table:
        nodes = _ordered(nodes)
        subroot, root, path = (above.column(c)[0].as_py() for c in ("subroot", "root", "path"))
        count, proofs, folded, lists = nodes.num_rows, [], [], []
        for own, claimed in zip(_steps(nodes, levels), nodes.column("claimed").to_pylist(), strict=True):
            own += path
            proofs.append(_hash("".join([s[1:] for s in own])))
            folded.append(fold(claimed, own))
            lists.append(own if siblings else None)
        columns = {
            "doc_id": nodes.column("doc_id"), "tree": nodes.column("tree"), "leaf": nodes.column("digest"), "subroot": [subroot] * count,
            "root": [root] * count, "siblings": lists, "proof_sha256": proofs, "folded_root": folded, "verified": [f == root for f in folded],
        }
        return pa.table(columns, schema=_arrow(_PROOFS))

    return run


def fold(leaf: str, path: Sequence[str]) -> str:
    """The root that a leaf and the steps of its path lead to."""
    for step in path:
        leaf = _hash(step[1:] + leaf if step[0] == "L" else leaf + step[1:])
    return leaf


def _joined(nodes: DataFrame, above: DataFrame, levels: int):
    return nodes.groupBy("tree", _group(levels)).cogroup(above.groupBy("tree", F.col("idx").alias("group")))


def _down(rounds: list[DataFrame], top: DataFrame, levels: int) -> DataFrame:
    """The paths of the nodes that the first round made, from those of the trees' roots (idx 0)."""
    for nodes in reversed(rounds[1:-1]):
        top = stored(_joined(nodes, top, levels).applyInArrow(_descended(levels), _PATHS), "paths")
    return top


def manifest(docs: DataFrame, claimed: Column | None = None, siblings: bool = False, levels: int = LEVELS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, leaf, subroot (of its language), root, proof_sha256 (of the
    siblings up to the root), folded_root (from the claimed leaf and those siblings), verified (whether
    that is the root), and with ``siblings`` the steps of the proof: L or R for the side and the sibling's
    hash, ``-`` where a node has none.

    ``docs`` has the columns FIELDS; further ones are not looked at, whatever their names.  Each row is a
    leaf, repeated rows too.  In a tree rows ascend by doc_id, those without one first; rows of one doc_id
    by leaf, so that the root does not depend on the order of rows.  Null fields count as ``-``, empty
    texts as ``0:``.  Null is a language of its own.  Texts are hashed whole where they are read and go no
    further.  A group with a third of all rows is as many subtrees as it takes.  No rows give no rows."""
    found = coordinates(leaves(docs, claimed))
    nodes = stored(found.select("tree", "idx", "n", F.col("leaf").alias("digest"), "doc_id", "claimed"), "leaf-nodes")
    widest = nodes.agg(F.max("n").alias("n")).first()["n"] or 0
    rounds = _rounds(nodes, widest, levels)
    tops = rounds[-1].select("tree", "digest")
    n_trees = tops.count()
    # The tree over the trees: its leaves are the subroots in the order of their groups.
    ranked = running_sums(tops.withColumn("one", F.lit(1).cast("long")), ["tree"], {"rank": "one"})
    subroots = stored(ranked.select(F.lit("").alias("tree"), F.col("rank").alias("idx"), F.lit(n_trees).cast("long").alias("n"), "digest", F.col("tree").alias("own")), "subroots")
    upper = _rounds(subroots, n_trees, levels)
    start = upper[-1].select("tree", "idx", F.col("digest").alias("subroot"), F.col("digest").alias("root"), F.array().cast("array<string>").alias("path"))
    above = _down(upper, start, levels)
    if len(upper) > 1:
        above = _joined(subroots.drop("own"), above, levels).applyInArrow(_descended(levels), _PATHS)
    top = subroots.join(above.select("idx", "root", "path"), "idx").select(
        F.col("own").alias("tree"), F.lit(0).cast("long").alias("idx"), F.col("digest").alias("subroot"), "root", "path"
    )
    proofs = _joined(nodes, _down(rounds, stored(top, "tops"), levels), levels).applyInArrow(_proved(levels, siblings), _PROOFS)
    return proofs.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", *(["siblings"] if siblings else []))


def tampered(every: int = 7) -> Column:
    """For verification: the leaf of a document whose n_chars is one more than it was, where ``every`` divides
    the CRC-32 of the decimal doc_id; NULL, so the true leaf, elsewhere."""
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0, F.lit(False))
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    return F.when(chosen, leaf([more if c == "n_chars" else F.col(c) for c in FIELDS]))
