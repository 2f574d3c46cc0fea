"""A Merkle manifest of a dataset: every row's leaf, the roots above it and its proof, by a butterfly exchange between blocks."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tarnkit.llm.components import SHORT, stored

FANOUT = 2
#: Leaves of a block are between these, as far as the fanout's powers allow; blocks for each shuffle partition.
LEAST_LEAVES, MOST_LEAVES, BLOCKS_A_PARTITION = 16, 1 << 14, 4
#: Rounds of the exchange after which the blocks are stored.
ROUNDS_STORED = 12
#: Leaves whose proofs are laid out together.
_SLICE = 2048
_HEX = 64

PROOF = "siblings array<string>, places array<int>, widths array<int>"


def leaf_hash(columns: Sequence[str | Column]) -> Column:
    """Hex SHA-256 of the columns one after the other, each as its UTF-8 byte count, a colon and the value; null is ``-``."""

    def field(column: str | Column) -> Column:
        value = (F.col(f"`{column}`") if isinstance(column, str) else column).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(field, columns)), 256)


def merkle_manifest(
    docs: DataFrame,
    leaf: Column,
    group: str = "lang",
    order: str = "doc_id",
    keep: Sequence[Column] = (),
    fanout: int = FANOUT,
    block_leaves: int | None = None,
) -> DataFrame:
    """Per row of ``docs``: the order column as bigint, the columns of ``keep``, leaf, subroot, root and its proof.

    Leaves (``leaf``, a hex SHA-256) of one ``group`` ascend by ``order``; every ``fanout`` consecutive nodes become one, the SHA-256 of their hex
    digests, until one node, the group's subroot, is left. Subroots in order of group (null first, then by UTF-8 bytes) give the root
    likewise. The proof lists from the leaf to the root: ``siblings`` (the other nodes of each run, left to right), ``places`` (the node's own place
    in its run) and ``widths`` (nodes in the run, itself included): :func:`fold` computes the root from them.

    Rows are dealt by ranges of (group, order), so a group with most rows is spread; a leaf's place is counted from the ranges' sizes. Aligned blocks of
    leaves hash their own subtrees. Then blocks exchange roots: in round r those whose numbers differ in digit r (base ``fanout``) alone form a group of
    ``fanout`` blocks, swap the roots of the subtrees they stand in, and each hashes the parent for itself. After the last round every block knows its upper
    proof, and no pass leads down again. Only slim rows move: digests, and one row for each block.

    Null order values come first; rows that tie go by leaf, and equal leaves are the same row to a tree. A lone leaf is its subroot, a lone
    subroot the root. Empty tables give no rows. Further columns of ``docs`` are not read and may have any name.
    """
    spark = docs.sparkSession
    g = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))  # no nulls, the same order
    rows = docs.select(
        g.alias("g"), F.col(f"`{order}`").cast("bigint").alias("id"), F.unhex(leaf).alias("leaf"), F.struct(F.lit(0).alias("_"), *keep).alias("keep")
    )
    leaves, total, most = _placed(stored(rows, "leaves"))
    if not total:
        return _named(spark.createDataFrame([], _schema(leaves)), order, leaves)
    size = _block_size(block_leaves or _wanted(spark, total), fanout)
    tops = stored(_exchanged(_roots(leaves, size, fanout), -(-most // size), fanout), "blocks")
    # the subroots are the leaves of one more tree
    subroots = tops.filter("block = 0").select(F.lit("").alias("g"), F.unhex("node").alias("leaf"), F.struct(F.col("g").alias("of")).alias("keep"))
    subroots, _, groups = _placed(subroots.select("g", F.lit(None).cast("bigint").alias("id"), "leaf", "keep"), by="keep")
    upper = _exchanged(_roots(subroots, size, fanout), -(-groups // size), fanout)
    proofs = _proofs(subroots, upper, size, fanout)
    above = proofs.select(F.col("keep.of").alias("g"), F.col("subroot").alias("root"), *[F.col(c).alias(f"top_{c}") for c in ("siblings", "places", "widths")])
    joined = tops.join(above, "g").select(
        "g", "block", "blocks", "node", *[F.concat(c, f"top_{c}").alias(c) for c in ("siblings", "places", "widths")], "root"
    )
    return _named(_proofs(leaves, joined, size, fanout), order, leaves)


def fold(leaf: Column, siblings: str = "siblings", places: str = "places", widths: str = "widths") -> Column:
    """The root that a leaf and its proof give."""

    def step(done: Column, level: Column) -> Column:
        others = F.col(siblings)
        left = F.array_join(F.slice(others, done["at"], level["place"]), "")
        right = F.array_join(F.slice(others, done["at"] + level["place"], level["width"] - 1 - level["place"]), "")
        return F.struct(F.sha2(F.concat(left, done["node"], right), 256).alias("node"), (done["at"] + level["width"] - 1).alias("at"))

    levels = F.zip_with(places, widths, lambda p, w: F.struct(p.alias("place"), w.alias("width")))
    return F.aggregate(levels, F.struct(leaf.alias("node"), F.lit(1).alias("at")), step)["node"]


def _wanted(spark, total: int) -> int:
    return min(max(total // (BLOCKS_A_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))), LEAST_LEAVES), MOST_LEAVES)


def _block_size(wanted: int, fanout: int) -> int:
    size = fanout
    while size * fanout <= wanted:
        size *= fanout
    return size


def _placed(rows: DataFrame, by: str = "id") -> tuple[DataFrame, int, int]:
    """g, id, leaf, keep, pos (from 0 in its group, in order of ``by`` and leaf), n (leaves of the group); rows of all, and of the largest group."""
    order = ["g", by, "leaf"]
    sorted_ = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("at", 33).alias("part")
    runs = sorted_.groupBy("g", part).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    of_group = W.partitionBy("g")
    before = F.coalesce(F.sum("n").over(of_group.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    runs = stored(runs.select("g", "part", "first", before.alias("before"), F.sum("n").over(of_group).alias("n")), "runs")
    # a run for each range and each group in it
    n_runs, total, most = runs.agg(F.count(F.lit(1)), F.sum(F.when(F.col("before") == 0, F.col("n"))), F.max("n")).first()
    runs = F.broadcast(runs) if n_runs <= SHORT else runs
    placed = (
        sorted_.withColumn("part", part)
        .join(runs, ["g", "part"])
        .select("g", "id", "leaf", "keep", (F.col("at") - F.col("first") + F.col("before")).alias("pos"), "n")
    )
    return placed, total or 0, most or 0


def _parents(nodes: list[bytes], fanout: int) -> list[bytes]:
    return [hashlib.sha256(b"".join(nodes[k : k + fanout])).hexdigest().encode() for k in range(0, len(nodes), fanout)]


def _levels(leaves: list[bytes], size: int, n: int, fanout: int) -> list[list[bytes]]:
    """The nodes of a block from its leaves to its root: up to one node in a group of one block, else up to the blocks' common height."""
    levels, span = [leaves], 1
    while (span < size) if n > size else len(levels[-1]) > 1:
        levels.append(_parents(levels[-1], fanout))
        span *= fanout
    return levels


def _hex(leaves: pa.ChunkedArray) -> list[bytes]:
    return [v.hex().encode() for v in leaves.to_pylist()]


def _blocked(leaves: DataFrame, size: int) -> DataFrame:
    return leaves.withColumn("block", F.floor(F.col("pos") / size).cast("bigint"))


def _roots(leaves: DataFrame, size: int, fanout: int) -> DataFrame:
    """g, block, blocks (of the group), node: what each block's own subtree comes to."""

    def root(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        n = table.column("n")[0].as_py()
        node = _levels(_hex(table.column("leaf")), size, n, fanout)[-1][0]
        return pa.table(
            {"g": table.column("g")[:1], "block": table.column("block")[:1], "blocks": pa.array([-(-n // size)], pa.int64()), "node": pa.array([node.decode()])}
        )

    slim = _blocked(leaves, size).select("g", "block", "pos", "n", "leaf")
    return slim.groupBy("g", "block").applyInArrow(root, "g string, block bigint, blocks bigint, node string")


def _exchanged(roots: DataFrame, most: int, fanout: int) -> DataFrame:
    """g, block, blocks, node (the group's root), siblings, places, widths: every block with its upper proof. ``most``: blocks of the largest group.

    A group's blocks are filled up to a power of the fanout by blocks without a node of their own: they take part in the exchange, so that also the last
    subtree's root is at hand wherever it is asked for, and every swap has ``fanout`` blocks, however many the group has.
    """
    powers = [1]
    while powers[-1] < most:
        powers.append(powers[-1] * fanout)
    full = F.array_min(F.filter(F.array(*[F.lit(p).cast("bigint") for p in powers]), lambda p: p >= F.col("blocks")))
    numbers = F.filter(F.transform(F.sequence(F.lit(0), F.lit(fanout - 1)), lambda k: F.col("own") + k * F.col("blocks")), lambda b: b < full)
    nothing = [F.array().cast(kind).alias(name) for name, kind in (("siblings", "array<string>"), ("places", "array<int>"), ("widths", "array<int>"))]
    state = roots.withColumnRenamed("block", "own").select("g", "own", F.explode(numbers).alias("block"), "blocks", "node")
    state = state.select("g", "block", "blocks", F.when(F.col("block") == F.col("own"), F.col("node")).alias("node"), *nothing)
    for done, power in enumerate(powers[:-1], 1):
        state = _swap(state, power, fanout)
        if done % ROUNDS_STORED == 0:
            state = stored(state, "round")
    return state.filter("block < blocks")


def _swap(state: DataFrame, power: int, fanout: int) -> DataFrame:
    """One round: ``fanout`` blocks that differ in one digit swap their nodes and hash the parent, each for itself."""
    active = F.col("blocks") > power
    digit = F.when(active, F.pmod(F.floor(F.col("block") / power), F.lit(fanout))).otherwise(0).cast("int")
    members = F.array_sort(F.collect_list(F.struct(digit.alias("digit"), "block", "node", "siblings", "places", "widths")))
    swapped = state.groupBy("g", "blocks", (F.col("block") - digit * power).alias("base")).agg(members.alias("members"))
    # nodes that are missing are the last of their run
    nodes = F.transform(F.filter("members", lambda m: m["node"].isNotNull()), lambda m: m["node"])
    parent = F.when(F.size("nodes") > 0, F.sha2(F.array_join("nodes", ""), 256))
    each = swapped.withColumn("nodes", nodes).select("g", "blocks", "nodes", parent.alias("parent"), F.explode("members").alias("m"))
    others = F.concat(F.slice("nodes", 1, F.col("m.digit")), F.slice("nodes", F.col("m.digit") + 2, F.lit(fanout)))
    grown = F.col("blocks") > power
    return each.select(
        "g",
        "m.block",
        "blocks",
        F.when(grown, F.col("parent")).otherwise(F.col("m.node")).alias("node"),
        F.when(grown, F.concat("m.siblings", others)).otherwise(F.col("m.siblings")).alias("siblings"),
        F.when(grown, F.concat("m.places", F.array("m.digit"))).otherwise(F.col("m.places")).alias("places"),
        F.when(grown, F.concat("m.widths", F.array(F.size("nodes")))).otherwise(F.col("m.widths")).alias("widths"),
    )


def _schema(leaves: DataFrame) -> T.StructType:
    first = T.StructType([leaves.schema["id"], leaves.schema["keep"]])
    return T.StructType([*first, *T._parse_datatype_string(f"leaf string, subroot string, root string, {PROOF}")])


def _proofs(leaves: DataFrame, blocks: DataFrame, size: int, fanout: int) -> DataFrame:
    """id, keep, leaf, subroot, root and the whole proof of every leaf: of its own block, then of the blocks above."""
    has_root = "root" in blocks.columns
    blocks = blocks if has_root else blocks.withColumn("root", F.col("node"))

    def prove(own: pa.Table, above: pa.Table) -> pa.Table:
        own = own.sort_by("pos")
        count = own.num_rows
        levels = _levels(_hex(own.column("leaf")), size, own.column("n")[0].as_py(), fanout)
        upper = {c: above.column(c)[0].as_py() for c in ("node", "root", "siblings", "places", "widths")}
        parts = [_laid_out(levels, upper, at, min(at + _SLICE, count), fanout) for at in range(0, count, _SLICE)]
        names = ["siblings", "places", "widths"]
        columns = [pa.chunked_array([p[k] for p in parts]) for k in range(3)]
        same = lambda value: pa.array([value] * count)
        return pa.table(
            [own.column("id"), own.column("keep"), pa.array([v.decode() for v in levels[0]]), same(upper["node"]), same(upper["root"]), *columns],
            names=["id", "keep", "leaf", "subroot", "root", *names],
        )

    slim = _blocked(leaves, size).select("g", "block", "pos", "n", "id", "leaf", "keep")
    right = blocks.select("g", "block", "node", "root", "siblings", "places", "widths")
    return slim.groupBy("g", "block").cogroup(right.groupBy("g", "block")).applyInArrow(prove, _schema(leaves))


def _laid_out(levels: list[list[bytes]], upper: dict, start: int, end: int, fanout: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """The proofs of the block's leaves from ``start`` to ``end`` as Arrow lists."""
    at = np.arange(start, end)
    nodes, there, places, widths = [], [], [], []
    for level in levels[:-1]:
        names = np.array(level, f"S{_HEX}")
        first = at // fanout * fanout
        for k in range(fanout):
            member = first + k
            there.append((member < len(level)) & (member != at))
            nodes.append(names[np.minimum(member, len(level) - 1)])
        places.append(at - first)
        widths.append(np.minimum(first + fanout, len(level)) - first)
        at = at // fanout
    rows = end - start
    for node in upper["siblings"]:
        nodes.append(np.full(rows, node.encode(), f"S{_HEX}"))
        there.append(np.ones(rows, bool))
    for out, name in ((places, "places"), (widths, "widths")):
        out += [np.full(rows, value) for value in upper[name]]
    offsets = lambda sizes: pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
    mask = np.stack(there, 1) if there else np.zeros((rows, 0), bool)
    flat = (np.stack(nodes, 1) if nodes else np.zeros((rows, 0), f"S{_HEX}"))[mask]
    ends = np.arange(len(flat) + 1, dtype=np.int32) * _HEX
    texts = pa.StringArray.from_buffers(len(flat), pa.py_buffer(ends.tobytes()), pa.py_buffer(flat.tobytes()))
    siblings = pa.ListArray.from_arrays(offsets(mask.sum(1)), texts)
    numbers = []
    for values in (places, widths):
        flat = np.stack(values, 1).astype(np.int32).ravel() if values else np.zeros(0, np.int32)
        numbers.append(pa.ListArray.from_arrays(offsets(np.full(rows, len(values))), pa.array(flat)))
    return siblings, *numbers


def _named(found: DataFrame, order: str, leaves: DataFrame) -> DataFrame:
    kept = [f"keep.`{c}`" for c in leaves.schema["keep"].dataType.names[1:]]
    return found.select(F.col("id").alias(order), *kept, "leaf", "subroot", "root", "siblings", "places", "widths")
