"""Merkle manifest of a dataset, with a witness for every leaf.

Leaves are hashes of rows, trees are FAN-ary, one tree for each group (lang)
and one over the groups' roots. A tree is built by streaming aligned appends:
``Subtree`` takes digests one by one, keeps the open run of each level, and
when a run is complete extends the partial witness of every leaf below it by
its siblings there. Blocks of FAN ** HEIGHT leaves, aligned in their group, are
streamed side by side in tasks; their roots are appended to the next level's
blocks in the same way, until one node of each group is left. Witnesses come
back down from the top: a block's own path is sent to it once, ahead of its
leaves, which append it to theirs.

Leaves are placed by a range sort on (group, doc_id, leaf) and a running count
over its tasks, so a group may span many tasks.

Defined results: every null field is the mark ``-``; a null doc_id comes first in its
group and is not tampered with; rows of equal doc_id go by their leaf, and rows that
repeat are equal leaves side by side; very long texts are hashed in full; columns
beyond the five are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

FAN, HEIGHT = 8, 4
BLOCK = FAN ** HEIGHT
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Subtree:
    """Nodes appended from left to right, with a witness for each: steps
    (siblings before, siblings after), from its own run upward."""

    def __init__(self) -> None:
        self.open: list[list[tuple[str, int, int, str]]] = [[]]  # digest, first and end leaf, siblings before
        self.witness: list[list[tuple[str, str]]] = []

    def append(self, node: str) -> None:
        self.witness.append([])
        self._add(0, node, len(self.witness) - 1, len(self.witness))

    def _add(self, level: int, node: str, first: int, end: int) -> None:
        if level == len(self.open):
            self.open.append([])
        run = self.open[level]
        run.append((node, first, end, run[-1][3] + run[-1][0] if run else ""))
        if len(run) == FAN:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        after = ""
        for node, first, end, before in reversed(run):
            for i in range(first, end):
                self.witness[i].append((before, after))
            after = node + after
        self._add(level + 1, digest(after), run[0][1], run[-1][2])

    def close(self, height: int) -> str:
        """Complete the open runs up to ``height``; the node there."""
        for level in range(height):
            if level < len(self.open) and self.open[level]:
                self._complete(level)
        return self.open[height][0][0]


def height_of(n: int) -> int:
    """Levels of a block whose group has ``n`` nodes in all."""
    height = 0
    while height < HEIGHT and FAN ** height < n:
        height += 1
    return height


def fold(node: str, steps: list[tuple[str, str]]) -> str:
    for before, after in steps:
        node = digest(before + node + after)
    return node


def leaf_of(text: Column) -> Column:
    """Hash of a row of documents with ``text`` as its text."""
    values = [F.col("doc_id").cast("string"), F.col("source"), F.col("lang"), F.col("n_chars").cast("string"), text]
    return F.sha2(F.concat(*[F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v))
                             for v in values]), 256)


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (grp and others) with idx, each row's place in its grp by
    ``order`` (nulls first), and n, the grp's rows. ``rows`` must be stored."""
    keys = [F.col(c).asc_nulls_first() for c in ["grp", *order]]
    kept = stored(rows.repartitionByRange(_parts(rows), *keys).sortWithinPartitions(*keys)
                  .withColumn("_mid", F.monotonically_increasing_id()), "sorted-nodes")
    kept = kept.withColumn("_part", F.shiftright("_mid", 33))
    stats = kept.groupBy("_part", "grp").agg(F.count("*").alias("_n"), F.min("_mid").alias("_first"))  # tasks + groups rows
    before = Window.partitionBy("grp").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))) \
        .withColumn("n", F.sum("_n").over(Window.partitionBy("grp"))).drop("_n")
    return stored(kept.join(stats, ["_part", "grp"]).withColumn("idx", F.col("_before") + F.col("_mid") - F.col("_first"))
                  .drop("_part", "_mid", "_first", "_before"), "placed-nodes")


def _blocks(rows: DataFrame, kept: list[str]) -> DataFrame:
    """``rows`` by block, each block's rows together and by idx."""
    return rows.select("grp", F.expr(f"idx div {BLOCK}").alias("block"), "idx", "n", "node", *kept) \
        .repartition(_parts(rows), "grp", "block").sortWithinPartitions("grp", "block", "idx")


def _above(nodes: DataFrame) -> DataFrame:
    """The blocks' roots as nodes of the next level."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tree, n = None, Subtree(), 0
        out: list[tuple] = []

        def finish() -> None:
            out.append((key[0], key[1], -(-n // BLOCK), tree.close(height_of(n))))

        for b in batches:
            out.clear()
            for grp, block, _, size, node in zip(*(c.to_pylist() for c in b.columns)):
                if (grp, block) != key:
                    if key is not None:
                        finish()
                    key, tree, n = (grp, block), Subtree(), size
                tree.append(node)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["grp", "idx", "n", "node"])
        if key is not None:
            out.clear()
            finish()
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["grp", "idx", "n", "node"])

    return stored(_blocks(nodes, []).mapInArrow(run, "grp string, idx long, n long, node string"), "block-roots")


def climb(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` (grp, idx, n, node) and the levels above, each of the roots of
    blocks of the one below; the last has one node for each grp."""
    levels = [nodes]
    while (levels[-1].agg(F.max("n")).first()[0] or 1) > 1:
        levels.append(_above(levels[-1]))
    return levels


_STEPS = "array<struct<before:string,after:string>>"
_ARROW = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(),
          _STEPS: pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))}


def _ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{c} {kind}" for c, kind in columns.items())


def _witnessed(nodes: DataFrame, paths: DataFrame, kept: list[str], result, returns: dict[str, str]) -> DataFrame:
    """Rows of ``nodes`` with their full witness. ``paths`` (grp, idx: a block;
    steps above it, subroot, root) goes ahead of each block's rows.
    ``result(idx, node, columns kept and grp and block, steps, subroot, root)``
    makes a row."""
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    heads = paths.select("grp", F.col("idx").alias("block"), none("idx", "long"), none("n", "long"), none("node", "string"),
                         *[none(c, nodes.schema[c].dataType) for c in kept], "steps", "subroot", "root")
    rows = nodes.select("grp", F.expr(f"idx div {BLOCK}").alias("block"), "idx", "n", "node", *kept,
                        none("steps", _STEPS), none("subroot", "string"), none("root", "string"))
    every = heads.unionByName(rows).select("idx", "n", "node", "steps", "subroot", "root", *kept, "grp", "block") \
        .repartition(_parts(nodes), "grp", "block").sortWithinPartitions("grp", "block", F.col("idx").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, tree, n, held = None, Subtree(), 0, []

        def finish() -> list[tuple]:
            if not held:
                return []
            tree.close(height_of(n))
            steps, subroot, root = head
            return [result(idx, node, values, own + steps, subroot, root) for (idx, node, values), own in zip(held, tree.witness)]

        def batch(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, _ARROW[kind]) for x, kind in zip(zip(*out), returns.values())], list(returns))

        for b in batches:
            out = []
            for idx, size, node, steps, subroot, root, *values in zip(*(c.to_pylist() for c in b.columns)):
                if idx is None:  # the next block begins
                    out += finish()
                    head, tree, held = ([(s["before"], s["after"]) for s in steps], subroot, root), Subtree(), []
                    continue
                n = size
                tree.append(node)
                held.append((idx, node, values))
            if out:
                yield batch(out)
        if held:
            yield batch(finish())

    return every.mapInArrow(run, _ddl(returns))


def _paths(levels: list[DataFrame], top: DataFrame) -> DataFrame:
    """Paths above the blocks of the lowest of ``levels``; ``top`` (grp, steps,
    subroot, root) has what is above each grp."""
    def to_block(idx, node, values, steps, subroot, root):
        return values[-2], idx, [{"before": a, "after": z} for a, z in steps], subroot, root

    paths = top.withColumn("idx", F.lit(0).cast("long"))
    for nodes in reversed(levels[1:-1]):
        paths = stored(_witnessed(nodes, paths, [], to_block, {
            "grp": "string", "idx": "bigint", "steps": _STEPS, "subroot": "string", "root": "string"}), "block-paths")
    return paths


def prove_documents(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every
    row of ``docs`` (FIELDS). The fold starts from the leaf as it is now: for
    ids whose crc32 is divisible by 3, the row with its text in lower case."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, leaf_of(F.translate("text", upper, lower)))
    leaves = stored(docs.select(*FIELDS).select(
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("grp"),  # null first, then bytewise
        F.col("doc_id"), leaf_of(F.col("text")).alias("node"), tampered.alias("now"), F.monotonically_increasing_id().alias("own")), "leaves")
    groups = climb(placed(leaves, ["doc_id", "node", "own"]))
    tops = stored(groups[-1].select(F.lit("").alias("grp"), F.col("grp").alias("lang"), "node"), "subroots")
    roots = climb(placed(tops, ["lang"]))
    top = roots[-1].select("grp", F.array().cast(_STEPS).alias("steps"), F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"))

    def to_group(idx, node, values, steps, subroot, root):
        return values[0], [{"before": a, "after": z} for a, z in steps], node, root

    by_group = stored(_witnessed(roots[0], _paths(roots, top), ["lang"], to_group, {
        "grp": "string", "steps": _STEPS, "subroot": "string", "root": "string"}), "group-paths")

    def to_row(idx, leaf, values, steps, subroot, root):
        doc_id, now = values[:2]
        folded = fold(now or leaf, steps)
        return doc_id, leaf, subroot, root, digest("".join(a + z for a, z in steps)), folded, folded == root

    return _witnessed(groups[0], _paths(groups, by_group), ["doc_id", "now"], to_row, {
        "doc_id": docs.schema["doc_id"].dataType.simpleString(), "leaf": "string", "subroot": "string", "root": "string",
        "proof_sha256": "string", "folded_root": "string", "verified": "boolean"})
