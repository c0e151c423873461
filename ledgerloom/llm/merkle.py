"""Merkle manifest of a table of documents: one ternary tree for each source, one over the sources' roots.

Leaves are numbered within their source and cut into aligned blocks of 3^height leaves. A block's subtree is one value in
van Emde Boas order: its levels are split at half height, the upper subtree comes first and the lower ones follow it, each laid out
alike. ``address`` gives a node's place by arithmetic alone, so building and looking up siblings touch few neighbouring
bytes whatever the size of a cache line. The blocks' roots are the leaves of the next tables of blocks, and so on up to
a single block. Proofs go the other way: a block gets the path of its root from the table above it, and its members
add their siblings. Blocks are bounded, so a source with any number of documents is spread over all tasks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored
from ledgerloom.llm.token_files import small_batches

FAN = 3
HEIGHT = 6      # levels below a block's root
_BYTES = 32


def nodes_in(levels: int) -> int:
    """Nodes of a full tree of so many levels."""
    return (FAN ** levels - 1) // (FAN - 1)


def levels_for(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    levels = 0
    while FAN ** levels < n:
        levels += 1
    return levels


def address(height: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of nodes ``index`` of ``depth`` (the root's is 0) in a block of ``height`` levels below its root."""
    levels, base = height + 1, np.zeros_like(index)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        depth, levels = depth - top, levels - top
        below = FAN ** depth
        base, index = base + nodes_in(top) + index // below * nodes_in(levels), index % below
    return base


@lru_cache
def _layout(height: int) -> list[list[int]]:
    """For each level from the leaves up, the places of its nodes."""
    return [address(height, height - up, np.arange(FAN ** (height - up))).tolist() for up in range(height + 1)]


def node(children: list[str]) -> str:
    return sha256("".join(children).encode()).hexdigest()


def build(leaves: list[str], height: int) -> tuple[bytes, str]:
    """A block as bytes, and its root. Nodes that do not exist, at the right edge, are zeros."""
    block, level = bytearray(_BYTES * nodes_in(height + 1)), leaves
    for up, places in enumerate(_layout(height)):
        if up:
            level = [node(level[i:i + FAN]) for i in range(0, len(level), FAN)]
        for at, digest in zip(places, level):
            block[_BYTES * at:_BYTES * (at + 1)] = bytes.fromhex(digest)
    return bytes(block), level[0]


def siblings(block: bytes, height: int, n: int, index: int) -> list[str]:
    """For each level from the leaf up, the node's place in its run as a digit, then its siblings' digests from left to right."""
    steps = []
    for places in _layout(height)[:-1]:
        first = index - index % FAN
        run = [block[_BYTES * places[i]:_BYTES * (places[i] + 1)].hex() for i in range(first, min(first + FAN, n)) if i != index]
        steps.append(f"{index - first}" + "".join(run))
        index, n = index // FAN, -(-n // FAN)
    return steps


def folded(leaf: str, path: list[str]) -> str:
    """The root that a leaf and the siblings on its path give."""
    for step in path:
        cut = 1 + 64 * int(step[0])
        leaf = sha256((step[1:cut] + leaf + step[cut:]).encode()).hexdigest()
    return leaf


def proof_digest(path: list[str]) -> str:
    return sha256("".join(step[1:] for step in path).encode()).hexdigest()


def leaf(text: Column | None = None) -> Column:
    """The digest of a row: each field with its length in bytes, a null as ``-``."""
    fields = [F.col(c).cast("string") for c in ("doc_id", "source", "lang", "n_chars")] + [F.col("text") if text is None else text]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in fields]), 256)


def positions(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, the place within the group from 0 on, and ``n``, the group's size; nulls come first.

    Rows are cut into ranges of (group, order) and numbered inside each; a group's ranges before add their counts. What is equal in
    all of that may stand in either order and is split as well, so neither one large group nor equal rows fill a range."""
    ranged = stored(rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(group, *order, "_tie").withColumn("_range", F.spark_partition_id()), "merkle-ranges")
    sizes = ranged.groupBy(F.col(group).alias("_g"), F.col("_range").alias("_r")).agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy("_g").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("_g", "_r", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy("_g")).alias("n"))
    inside = Window.partitionBy("_range", group).orderBy(*order, "_tie")
    numbered = ranged.withColumn("_rn", F.row_number().over(inside))
    joined = numbered.join(stored(shift, "merkle-shift"), (F.col("_range") == F.col("_r")) & F.col(group).eqNullSafe(F.col("_g")))
    return joined.select(*rows.columns, (F.col("_before") + F.col("_rn") - 1).alias("pos"), "n")


_BLOCK = "grp string, n bigint, block bigint, height int, members int, tree binary, root string"


def _built(height: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for n, leaves in zip(b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True):
                high = min(height, levels_for(n))
                out.append((high, len(leaves), *build(leaves, high)))
            columns = list(zip(*out)) or [()] * 4
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], *b.columns[4:]],
                                             names=["grp", "n", "block", "height", "members", "tree", "root", *b.schema.names[4:]])
    return run


def _block_rows(nodes: DataFrame, height: int, carried: str | None = None) -> DataFrame:
    """Blocks of ``nodes`` (grp, n, pos, digest); ``carried`` is a struct column whose members' values go along in order."""
    item = F.struct("pos", "digest", *([carried] if carried else []))
    runs = nodes.groupBy("grp", "n", F.floor(F.col("pos") / FAN ** height).alias("block")).agg(F.array_sort(F.collect_list(item)).alias("_items"))
    flat = runs.select("grp", "n", "block", F.col("_items.digest").alias("leaves"), *([F.col(f"_items.{carried}").alias(carried)] if carried else []))
    kind = f", {carried} {flat.schema[carried].dataType.simpleString()}" if carried else ""
    return stored(flat.mapInArrow(_built(height), _BLOCK + kind), "merkle-blocks")


@dataclass
class Forest:
    """Tables of blocks from the leaves up, and the root of each group's tree."""

    levels: list[DataFrame]
    roots: DataFrame
    height: int


def forest(nodes: DataFrame, most: int, height: int, carried: str | None = None) -> Forest:
    """Trees over ``nodes`` (grp, n, pos, digest), of which no group has more than ``most``."""
    whole, levels, finals = FAN ** height, [], []
    while True:
        blocks = _block_rows(nodes, height, carried)
        carried = None
        levels.append(blocks)
        finals.append(blocks.where(F.col("n") <= whole).select("grp", "root"))
        if most <= whole:
            break
        most = -(-most // whole)
        nodes = blocks.where(F.col("n") > whole).select("grp", F.ceil(F.col("n") / whole).cast("bigint").alias("n"), F.col("block").alias("pos"), F.col("root").alias("digest"))
    roots = finals[0]
    for x in finals[1:]:
        roots = roots.unionByName(x)
    return Forest(levels, roots, height)


def _member_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        grp, pos, paths = [], [], []
        for g, block, height, n, tree, path in zip(*[c.to_pylist() for c in b.columns], strict=True):
            for i in range(n):
                grp.append(g)
                pos.append(i)
                paths.append(siblings(tree, height, n, i) + path)
            pos[-n:] = [block * FAN ** height + i for i in range(n)] if n else []
        yield pa.RecordBatch.from_arrays([pa.array(grp, pa.string()), pa.array(pos, pa.int64()), pa.array(paths, pa.list_(pa.string()))], names=["_grp", "_pos", "path"])


def _with_paths(trees: Forest, level: int, tops: DataFrame) -> DataFrame:
    """Blocks of a level with the path of their roots: ``tops`` (grp, path) continues a tree's root."""
    whole, blocks = FAN ** trees.height, trees.levels[level]
    ends = tops.select(F.col("grp").alias("_grp"), F.lit(0).cast("bigint").alias("_pos"), "path")
    done = blocks.where(F.col("n") <= whole).join(ends.drop("_pos"), F.col("grp").eqNullSafe(F.col("_grp"))).drop("_grp")
    if level + 1 == len(trees.levels):
        return done
    above = _with_paths(trees, level + 1, tops).select("grp", "block", "height", "members", "tree", "path").mapInArrow(_member_paths, "_grp string, _pos bigint, path array<string>")
    more = blocks.where(F.col("n") > whole).join(stored(above, "merkle-paths"), F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("block") == F.col("_pos"))).drop("_grp", "_pos")
    return done.unionByName(more)


_PROVED = "doc_id bigint, leaf string, subroot string, proof_sha256 string, folded_root string"


def _proved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for height, n, tree, docs, path, subroot in zip(*[c.to_pylist() for c in b.columns], strict=True):
            for i, doc in enumerate(docs):
                whole = siblings(tree, height, n, i) + path
                out.append((doc["doc_id"], doc["leaf"], subroot, proof_digest(whole), folded(doc["seen"], whole)))
        names = [c.split()[0] for c in _PROVED.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k == "doc_id" else pa.string()) for k, c in zip(names, list(zip(*out)) or [()] * 5, strict=True)], names=names)


@dataclass
class Manifest:
    """The trees of a table: ``sources`` with one tree for each source, ``top`` with one tree over their roots."""

    sources: Forest
    top: Forest
    root: str | None

    def blocks(self) -> DataFrame:
        """Every block: tree (``sources`` or ``top``), level of blocks from the leaves up, group, number, root and nodes in van Emde Boas order."""
        tables = [x.select(F.lit(name).alias("tree"), F.lit(k).alias("level"), "grp", "block", "height", "members", "root", F.col("tree").alias("nodes"))
                  for name, trees in (("sources", self.sources), ("top", self.top)) for k, x in enumerate(trees.levels)]
        out = tables[0]
        for x in tables[1:]:
            out = out.unionByName(x)
        return out

    def proofs(self) -> DataFrame:
        """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row, from stored siblings and the leaf as seen."""
        no_path = self.top.roots.select("grp", F.array().cast("array<string>").alias("path"))
        above = _with_paths(self.top, 0, no_path).select("grp", "block", "height", "members", "tree", "path").mapInArrow(_member_paths, "_grp string, _pos bigint, path array<string>")
        named = self.top_places.join(stored(above, "merkle-paths").drop("_grp"), F.col("pos") == F.col("_pos")).select(F.col("source").alias("grp"), "path")
        tops = stored(named, "merkle-tops")
        subroots = self.sources.roots.select(F.col("grp").alias("_s"), F.col("root").alias("subroot"))
        ready = _with_paths(self.sources, 0, tops).join(subroots, F.col("grp").eqNullSafe(F.col("_s")))
        done = ready.select("height", "members", "tree", "doc", "path", "subroot").mapInArrow(_proved, _PROVED)
        return done.select("doc_id", "leaf", "subroot", F.lit(self.root).alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == F.lit(self.root)).alias("verified"))

    top_places: DataFrame = None


def manifest(docs: DataFrame, seen: Column | None = None, height: int = HEIGHT) -> Manifest:
    """The Merkle trees of ``docs`` (doc_id, source, lang, n_chars, text); other columns are not read.

    ``seen`` is the leaf as it is found now, by default the one recorded: proofs fold it. Leaves of a source ascend by doc_id, a null one
    first, and by digest where rows share a doc_id; equal rows are leaves of their own. A null field counts as ``-``, an empty text as
    a field of no bytes. A null source is a source, the first of all. An empty table has no root and no proofs."""
    small_batches(docs.sparkSession)
    own = leaf()
    rows = stored(docs.select(F.col("source").cast("string").alias("grp"), F.col("doc_id").cast("bigint").alias("doc_id"), own.alias("digest"), (own if seen is None else seen).alias("_seen")), "merkle-leaves")
    placed = positions(rows, "grp", ["doc_id", "digest"])
    nodes = stored(placed.select("grp", "n", "pos", "digest", F.struct("doc_id", F.col("digest").alias("leaf"), F.col("_seen").alias("seen")).alias("doc")), "merkle-nodes")
    most = nodes.agg(F.max("n")).first()[0] or 0
    sources = forest(nodes, most, height, "doc")
    roots = stored(sources.roots.select(F.lit(None).cast("string").alias("grp"), F.col("grp").alias("source"), F.col("root").alias("digest")), "merkle-subroots")
    places = stored(positions(roots, "grp", ["source"]), "merkle-sources")
    top = forest(places.select("grp", "n", "pos", "digest"), places.agg(F.max("n")).first()[0] or 0, height)
    root = top.roots.first()   # one row
    return Manifest(sources, top, root["root"] if root else None, places)


def without_line_ends(text: Column) -> Column:
    """A leaf of the row as it is after tampering: every second row by the checksum of its doc_id loses its text's line ends."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(chosen, leaf(F.replace(text, F.lit("\n"), F.lit("")))).otherwise(leaf())
