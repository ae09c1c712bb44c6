"""Merkle manifest of a dataset: checkpoint and recompute.

``write_manifest`` hashes every document to a leaf, orders the leaves of each source by doc_id and
builds a tree of runs of ``FAN`` nodes over them, then a tree over the sources' subroots. Only every
``LEVELS``-th level is stored: as rows that hold one aligned subtree's lowest nodes, ``WIDTH`` at
most. ``prove`` walks the stored levels from the root down. A task takes one stored row, makes the
missing interior nodes of its subtree again, gives every node below its siblings in front of the
siblings of the row itself, and forgets them. ``fold`` leads a leaf and its siblings to a root.

A run of fewer nodes at the end, even of one, is hashed as well while a level holds more than one
node; a lone leaf is its own subroot.

Leaves are numbered in two steps: rows are sorted by range (a source with a third of all rows lies
in many ranges) and the ranges' counts are summed up. Rows that agree in everything carry a number
of their own, so that even they are dealt to several ranges. Memory follows ``WIDTH``, not the table:
a task holds one subtree. The driver sees the root and the largest count of nodes of a level.

Defined cases: a null field is written ``-`` and differs from an empty text; a null source is a
source of its own, first in order; null ids come first in their source; rows that repeat are leaves
each, ordered by digest; texts of any length are hashed whole; other columns are ignored; an empty
table has no rows and the root None.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..operators.joins import attach
from .common import in_arrow, land, partitions, ship

FAN = 3
LEVELS = 5  # levels between two that are stored
WIDTH = FAN**LEVELS
PATH_ROWS = 20_000  # paths that are broadcast at most; each is below 3 KB

PATH = "array<struct<left: string, right: string>>"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@dataclass(frozen=True)
class Manifest:
    """Stored levels, lowest first: of the documents (by source) and of the sources."""

    documents: list[DataFrame]
    sources: list[DataFrame]
    root: str | None


# -- leaves -----------------------------------------------------------------------------------


def leaf(text: Column | None = None) -> Column:
    """Hex digest of a row of documents; with ``text`` instead of the row's own."""
    written = []
    for name in FIELDS:
        value = F.col(name).cast("long") if name in ("doc_id", "n_chars") else F.col(name)
        value = text if name == "text" and text is not None else value
        value = value.cast("string")
        framed = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        written.append(F.coalesce(framed, F.lit("-")))
    return F.sha2(F.concat(*written), 256)


def numbered(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` with ``idx``, the place of a row in its group by ``order`` (from 0, without gaps), and
    ``n``, the rows of its group. ``order`` must tell all rows apart."""
    spark = df.sparkSession
    sort = [F.col(c).asc_nulls_first() for c in [group, *order]]
    ranged = df.repartitionByRange(partitions(spark), *sort).sortWithinPartitions(*sort)
    placed = land(ranged.withColumn("_at", F.monotonically_increasing_id()), "merkle-order")
    placed = placed.withColumn("_range", F.shiftright("_at", 33))
    counts = placed.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        group, "_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy(group)).alias("n"),
    )
    met = attach(placed, offsets, [group, "_range"], null_safe=True)
    return met.withColumn("idx", F.col("_at") + F.col("_shift")).drop("_at", "_range", "_shift")


# -- subtrees ---------------------------------------------------------------------------------


def subtree(nodes: list[str], n: int) -> list[list[str]]:
    """All levels of a stored row's subtree, lowest first; ``n`` nodes are on its lowest level in
    the whole tree. The last level holds the one node on top."""
    levels = [nodes]
    while (len(levels) <= LEVELS) if n > WIDTH else (len(levels[-1]) > 1):
        last = levels[-1]
        levels.append([sha256("".join(last[i : i + FAN]).encode()).hexdigest() for i in range(0, len(last), FAN)])
    return levels


def siblings(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    """What stands left and right of node ``at`` in its run, and of the nodes above it."""
    out = []
    for level in levels[:-1]:
        low = at - at % FAN
        out.append(("".join(level[low:at]), "".join(level[at + 1 : low + FAN])))
        at //= FAN
    return out


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, n = batch.column("nodes").to_pylist(), batch.column("n").to_pylist()
        tops = [bytes.fromhex(subtree([x.hex() for x in row], k)[-1][0]) for row, k in zip(nodes, n)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tops, pa.binary())], [*batch.schema.names, "top"])


def _store(rows: DataFrame, label: str) -> DataFrame:
    """A level: one row for each aligned subtree of (grp, n, idx, node, item)."""
    kids = F.sort_array(F.collect_list(F.struct("idx", "node", "item")))
    cut = rows.groupBy("grp", "n", F.floor(F.col("idx") / WIDTH).alias("chunk")).agg(kids.alias("kids"))
    flat = cut.select("grp", "n", "chunk", F.col("kids.node").alias("nodes"), F.col("kids.item").alias("items"))
    schema = T.StructType([*flat.schema.fields, T.StructField("top", T.BinaryType())])
    return land(in_arrow(flat, _tops, schema), label)


def _levels(rows: DataFrame, label: str) -> list[DataFrame]:
    stores = []
    while True:
        store = _store(rows, f"merkle-{label}-{len(stores)}")
        stores.append(store)
        most = store.agg(F.max("n").alias("most")).first().most
        if most is None or most <= WIDTH:
            return stores
        rows = store.filter(F.col("n") > WIDTH).select(
            "grp", F.ceil(F.col("n") / WIDTH).alias("n"), F.col("chunk").alias("idx"), F.col("top").alias("node"),
            F.lit(None).cast("int").alias("item"),
        )


def write_manifest(docs: DataFrame, claimed: Column | None = None) -> Manifest:
    """Manifest of ``documents``. ``claimed`` is the leaf that someone else holds for a row (hex);
    it is stored beside the leaf for ``prove`` and takes no part in any node."""
    ship(docs.sparkSession)
    claim = F.unhex(claimed) if claimed is not None else F.lit(None).cast("binary")
    leaves = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("grp"),
        F.unhex(leaf()).alias("node"), claim.alias("claimed"), F.monotonically_increasing_id().alias("row"),
    )
    placed = numbered(land(leaves, "merkle-leaves"), "grp", ["doc_id", "node", "row"])
    documents = _levels(placed.select("grp", "n", "idx", "node", F.struct("doc_id", "claimed").alias("item")), "documents")
    roots = documents[0].filter(F.col("n") <= WIDTH).select("grp", "top", F.lit(0).alias("layer"))
    for layer, store in enumerate(documents[1:], 1):
        roots = roots.unionByName(store.filter(F.col("n") <= WIDTH).select("grp", "top", F.lit(layer).alias("layer")))
    # one group holds all sources
    named = numbered(roots.withColumn("_all", F.lit("")), "_all", ["grp"])
    item = F.struct(F.col("grp").alias("source"), "layer").alias("item")
    sources = _levels(named.select(F.col("_all").alias("grp"), "n", "idx", F.col("top").alias("node"), item), "sources")
    top = sources[-1].select(F.hex("top")).first()
    return Manifest(documents, sources, top[0].lower() if top else None)


# -- proofs -----------------------------------------------------------------------------------


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1)
            nodes = [x.hex() for x in row.column("nodes")[0].as_py()]
            levels = subtree(nodes, row.column("n")[0].as_py())
            above = [(x["left"], x["right"]) for x in row.column("path")[0].as_py() or []]
            paths = [siblings(levels, k) + above for k in range(len(nodes))]
            offsets, left, right = [0], [], []
            for path in paths:
                left += [x for x, _ in path]
                right += [x for _, x in path]
                offsets.append(len(left))
            pairs = pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], ["left", "right"])
            first = row.column("chunk")[0].as_py() * WIDTH
            yield pa.RecordBatch.from_arrays([
                pa.array([row.column("grp")[0].as_py()] * len(nodes), pa.string()),
                pa.array(range(first, first + len(nodes)), pa.int64()),
                row.column("items").flatten(),
                pa.array(nodes, pa.string()),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs),
                pa.array([row.column("subroot")[0].as_py()] * len(nodes), pa.string()),
            ], ["grp", "idx", "item", "node", "path", "subroot"])


def _descend(store: DataFrame, paths: DataFrame) -> DataFrame:
    """(grp, idx, item, node, path, subroot) of all nodes of a stored level, from the paths of its
    rows (grp, chunk, path, subroot)."""
    met = attach(store.drop("top"), paths, ["grp", "chunk"], max_rows=PATH_ROWS, null_safe=True)
    item = store.schema["items"].dataType.elementType.simpleString()
    schema = f"grp string, idx long, item {item}, node string, path {PATH}, subroot string"
    return in_arrow(met, _expand, schema)


def prove(manifest: Manifest) -> DataFrame:
    """(doc_id, source, leaf, claimed, subroot, path) of every document. ``path`` lists the siblings
    left and right of the leaf's node, level by level up to the root."""
    none = F.array().cast(PATH)
    paths = None
    for store in reversed(manifest.sources):
        if paths is None:
            paths = store.select("grp", "chunk", none.alias("path"), F.lit(None).cast("string").alias("subroot"))
        nodes = _descend(store, paths)
        paths = nodes.select("grp", F.col("idx").alias("chunk"), "path", "subroot")
    ends = land(nodes.select(
        F.col("item.source").alias("grp"), F.lit(0).cast("long").alias("chunk"), "path", F.col("node").alias("subroot"),
        F.col("item.layer").alias("layer"),
    ), "merkle-ends")
    below = None
    for layer in reversed(range(len(manifest.documents))):
        paths = ends.filter(F.col("layer") == layer).drop("layer")
        paths = paths if below is None else paths.unionByName(below)
        nodes = _descend(manifest.documents[layer], paths)
        below = nodes.select("grp", F.col("idx").alias("chunk"), "path", "subroot")
    return nodes.select(
        "item.doc_id", F.col("grp").alias("source"), F.col("node").alias("leaf"), F.lower(F.hex("item.claimed")).alias("claimed"),
        "subroot", "path",
    )


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and its siblings lead to."""
    return F.aggregate(path, start, lambda node, x: F.sha2(F.concat(x["left"], node, x["right"]), 256))


def path_digest(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""), 256)
