"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

1. Number: turns are dealt to tasks by ranges of (conversation, turn), numbered
   within each task's run, and a run that starts in an earlier task continues
   its number.  No task takes a whole conversation, however long.
2. Rebuild: a conversation's first turns come from the conversation that it
   continues, the rest are its own.  From here on a turn is a 128-bit digest
   and a size; texts are not moved.
3. Nodes: a prefix is the exclusive or of the digests of its turns, each hashed
   with its depth: 128 bits, computed in blocks of a conversation.  Equal
   prefixes are one node; members combine map-side.
4. Totals by contraction.  Each round is one aggregate over parents and two
   joins on unique keys.  *Rake*: nodes without children hand their totals to
   their parent and leave.  *Compress*: in chains of nodes with one child,
   those whose hash is above that of both neighbours are spliced out; what
   they hold goes on the edge over the gap.  Both shrink the tree by a constant
   share, so rounds grow with the logarithm of the nodes, whatever the depth.
   Spliced nodes are then re-expanded from the last round to the first: a
   node's total is its child's, plus what was put on the edge.
5. Ends: the ids that end at a node are sorted over ranges, joined to pieces
   of text in each range, and the pieces are hashed one after another: a task
   holds one piece, never all ids of a node.

Tables between the steps are written to the checkpoint folder.

Defined cases: rows without a conversation id are left out; null turns come
first; turns of equal number stand in the order of their digests; null role or
text is empty; a repeated row is a turn of its own; no rows, no nodes, not even
a root.  Ids are integers.  Other columns, of whatever name, are not read; very
long texts are hashed and measured where they stand.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch_of, materialise

#: Turns of a conversation that one task takes at a time.
BLOCK_TURNS = 10_000
PIECE_CHARS = 1 << 16
#: A parent with more than this share of all nodes has its children joined by broadcast: so many such parents at most.
HOT_PARENTS = 256


def numbered_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """``conv_id, pos, digest, n_bytes``: each turn with its place in its conversation, from 1."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
                        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
                        F.octet_length(text).cast("long").alias("n_bytes")).filter("conv_id IS NOT NULL")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", "digest", "n_bytes", F.spark_partition_id().cast("long").alias("part"))
    schema = pa.schema([("conv_id", pa.int64()), ("digest", pa.binary()), ("n_bytes", pa.int64()), ("part", pa.int64()),
                        ("local", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column(0).to_numpy(zero_copy_only=False)
            first = np.concatenate([[0], np.flatnonzero(ids[1:] != ids[:-1]) + 1])
            local = np.arange(1, len(ids) + 1) - np.repeat(first, np.diff(np.append(first, len(ids))))
            if ids[0] == last:
                local[:first[1] if len(first) > 1 else None] += held
            last, held = ids[-1], int(local[-1])
            yield batch_of(schema, *[b.column(k) for k in range(4)], local)

    numbered = materialise(dealt.mapInArrow(run, "conv_id long, digest binary, n_bytes long, part long, local long"), "turns")
    runs = numbered.groupBy("conv_id", "part").agg(F.max("local").alias("held"))
    before = F.sum("held").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = runs.select("conv_id", "part", before.alias("before")).filter("before > 0")  # one a task at most
    return numbered.join(offsets, ["conv_id", "part"], "left").select(
        "conv_id", (F.col("local") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "n_bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (``conv_id, length``) and their turns (``conv_id, depth, digest, n_bytes, length``).

    The first h turns come from conversation c - c % 5, with h = crc32(c) % 9;
    the others are c's own after its first h.
    """
    own = turns.groupBy("conv_id").agg(F.max("pos").alias("held"))
    c = F.col("conv_id")
    named = own.select("conv_id", "held", (c - c % 5).alias("source"), (F.crc32(c.cast("string")) % 9).alias("h"))
    source = own.select(F.col("conv_id").alias("source"), F.col("held").alias("source_held"))
    taken = F.least("h", F.coalesce("source_held", F.lit(0)))
    convs = materialise(named.join(source, "source", "left").withColumn("taken", taken).select(
        "conv_id", "source", "h", "taken", "held",
        (F.col("taken") + F.greatest(F.col("held") - F.col("h"), F.lit(0))).alias("length")), "conversations")
    heads = turns.filter("pos <= 8").withColumnRenamed("conv_id", "source")
    borrowed = heads.join(convs.filter("taken > 0"), "source").filter("pos <= taken").select(
        "conv_id", F.col("pos").alias("depth"), "digest", "n_bytes", "length")
    # a long conversation meets its own row once a block of turns
    blocks = convs.select("conv_id", "h", "taken", "length", F.explode(F.sequence(F.lit(0), F.floor(F.col("held") / BLOCK_TURNS))).alias("block"))
    kept = turns.withColumn("block", F.floor(F.col("pos") / BLOCK_TURNS)).join(blocks, ["conv_id", "block"]).filter("pos > h")
    rest = kept.select("conv_id", (F.col("taken") + F.col("pos") - F.col("h")).alias("depth"), "digest", "n_bytes", "length")
    return convs.select("conv_id", "length"), borrowed.unionByName(rest)


def prefixes(steps: DataFrame) -> DataFrame:
    """``steps`` with the digests of the prefix (``x, y``) and of the one before it (``px, py``)."""
    tagged = steps.select("*", F.xxhash64("depth", "digest").alias("tx"), F.xxhash64("digest", "depth", F.lit(1)).alias("ty"),
                          F.floor(F.col("depth") / BLOCK_TURNS).alias("block"))
    within = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    local = tagged.select("*", F.bit_xor("tx").over(within).alias("lx"), F.bit_xor("ty").over(within).alias("ly"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = tagged.filter(F.col("length") >= BLOCK_TURNS).groupBy("conv_id", "block").agg(F.bit_xor("tx").alias("bx"), F.bit_xor("ty").alias("by"))
    before = sums.select("conv_id", "block", F.bit_xor("bx").over(earlier).alias("bx"), F.bit_xor("by").over(earlier).alias("by"))
    whole = local.join(before.filter("bx IS NOT NULL"), ["conv_id", "block"], "left")
    x, y = (F.col(f"l{a}").bitwiseXOR(F.coalesce(f"b{a}", F.lit(0).cast("long"))) for a in "xy")
    return whole.select("conv_id", "depth", "n_bytes", "length", x.alias("x"), y.alias("y"),
                        x.bitwiseXOR(F.col("tx")).alias("px"), y.bitwiseXOR(F.col("ty")).alias("py"))


def end_hashes(ends: DataFrame, key: list[str]) -> DataFrame:
    """``key, ends_sha256``: SHA-256 of each key's ``conv_id`` values, ascending, comma-joined."""
    order = [*key, "conv_id"]
    dealt = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    fields = ", ".join(f"{c} long" for c in key)
    n = len(key)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces of the joined text, each with the first id in it."""
        for b in batches:
            if not b.num_rows:
                continue
            columns = [b.column(k).to_numpy(zero_copy_only=False) for k in range(n + 1)]
            new = np.zeros(b.num_rows, bool)
            new[0] = True
            for c in columns[:n]:
                new[1:] |= c[1:] != c[:-1]
            starts = np.flatnonzero(new)
            out = []
            for a, z in zip(starts.tolist(), [*starts[1:].tolist(), b.num_rows]):
                for k in range(a, z, PIECE_CHARS // 16):
                    out.append((k, ",".join(map(str, columns[n][k:min(z, k + PIECE_CHARS // 16)].tolist()))))
            at = pa.array([k for k, _ in out])
            yield pa.RecordBatch.from_arrays([*[b.column(k).take(at) for k in range(n + 1)], pa.array([p for _, p in out], pa.string())],
                                             names=[*order, "piece"])

    pieces = dealt.mapInArrow(join, f"{fields}, conv_id long, piece string")
    sorted_pieces = pieces.repartition(*key).sortWithinPartitions(*order)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*key, "ends_sha256"]
        last, state = None, None
        for b in batches:
            done = []
            for *own, piece in zip(*[b.column(k).to_pylist() for k in range(n)], b.column(n + 1).to_pylist()):
                if own == last:
                    state.update(b",")
                else:
                    if last is not None:
                        done.append((*last, state.hexdigest()))
                    last, state = own, hashlib.sha256()
                state.update(piece.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], pa.int64() if k < n else pa.string()) for k in range(n + 1)], names=names)
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*last, state.hexdigest())], names=names)

    return sorted_pieces.mapInArrow(digest, f"{fields}, ends_sha256 string")


def with_parents(nodes: DataFrame) -> DataFrame:
    """``nodes`` (``conv_id, depth, x, y, px, py`` and more; root aside) with ``parent_conv_id``, and ``n_children`` of each.

    A parent with a large share of all nodes as children would be one join
    task; there are few such parents, and those are broadcast.
    """
    kids = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")).agg(F.count("*").alias("n_children"))
    counted = materialise(nodes.join(kids, ["depth", "x", "y"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "counted")
    parents = counted.filter("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"),
                                                      F.col("conv_id").alias("parent_conv_id"), "n_children")
    limit = counted.count() // HOT_PARENTS
    key = ["depth", "px", "py"]
    hot = parents.filter(F.col("n_children") > limit).drop("n_children")
    rest = parents.filter(F.col("n_children") <= limit).drop("n_children")
    below = counted.filter("depth > 1")
    found = below.join(F.broadcast(hot), key).unionByName(below.join(F.broadcast(hot.select(*key)), key, "left_anti").join(rest, key))
    return found.unionByName(counted.filter("depth = 1").withColumn("parent_conv_id", F.lit(None).cast("long")))


def subtree_sums(nodes: DataFrame, weights: list[str]) -> DataFrame:
    """``id`` and, for each of ``weights``, its sum over the node's subtree, top included.

    ``nodes``: ``id, parent`` (null: root), ``n_children`` and the weights,
    longs that are not null.  Ids are unique, of any type that joins.
    """
    # g_: weight that waits on the edge to the parent
    tree = nodes.select("id", "parent", F.col("n_children").alias("kids"), *weights, *[F.lit(0).cast("long").alias(f"g_{w}") for w in weights])
    tree = materialise(tree, "trie_0")
    done, spliced, k = [], [], 0
    while not tree.filter("parent IS NOT NULL").isEmpty():
        k += 1
        bare = F.col("kids") == 0
        up = tree.filter("parent IS NOT NULL").groupBy("parent").agg(
            F.count_if(~bare).alias("kids"), *[F.sum(F.when(bare, F.col(w) + F.col(f"g_{w}")).otherwise(0)).alias(f"in_{w}") for w in weights],
            F.min(F.when(~bare, F.struct("id", *[f"g_{w}" for w in weights]))).alias("child"))
        inner = tree.filter(~bare).drop("kids").join(up.withColumnRenamed("parent", "id"), "id")
        rank = lambda c: F.xxhash64(F.col(c), F.lit(k))
        peak = (rank("id") > rank("parent")) & (rank("id") > rank("child.id"))
        raked = materialise(inner.select("id", "parent", "kids", *[(F.col(w) + F.col(f"in_{w}")).alias(w) for w in weights],
                                         *[f"g_{w}" for w in weights], "child",
                                         F.coalesce(F.col("parent").isNotNull() & (F.col("kids") == 1) & peak, F.lit(False)).alias("out")),
                            f"trie_rake_{k}")
        done.append(tree.filter(bare & F.col("parent").isNotNull()).select("id", *weights))
        gone = raked.filter("out")
        spliced.append(gone.select("id", F.col("child.id").alias("child"), *[(F.col(w) + F.col(f"child.g_{w}")).alias(w) for w in weights]))
        bridge = gone.select(F.col("child.id").alias("id"), F.col("parent").alias("to"),
                             *[(F.col(w) + F.col(f"g_{w}") + F.col(f"child.g_{w}")).alias(f"to_{w}") for w in weights])
        tree = materialise(raked.filter("NOT out").drop("out", "child").join(bridge, "id", "left").select(
            "id", F.coalesce("to", "parent").alias("parent"), "kids", *weights,
            *[F.coalesce(f"to_{w}", f"g_{w}").alias(f"g_{w}") for w in weights]), f"trie_{k}")
    totals = tree.select("id", *weights)
    for k in reversed(range(len(done))):
        below = totals.select(F.col("id").alias("child"), *[F.col(w).alias(f"sub_{w}") for w in weights])
        back = spliced[k].join(below, "child").select("id", *[(F.col(w) + F.col(f"sub_{w}")).alias(w) for w in weights])
        totals = totals.unionByName(materialise(back, f"trie_expand_{k}")).unionByName(done[k])
    return totals


def prefix_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations.

    ``conv_id`` (least member), ``depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``, and the ``x, y`` digest of the prefix.
    """
    convs, steps = rebuilt(materialise(numbered_turns(turns, conv_col, turn_col, role_col, text_col), "numbered"))
    rows = materialise(prefixes(steps), "prefixes")
    nodes = materialise(rows.groupBy("depth", "x", "y").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("n_bytes").alias("n_bytes"),
        F.min("px").alias("px"), F.min("py").alias("py")), "nodes")
    zero = F.lit(0).cast("long")
    first = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    top = nodes.filter("depth = 1").agg(F.count("*").alias("n_children"))
    root = first.crossJoin(top).select(  # one row each
        zero.alias("depth"), zero.alias("x"), zero.alias("y"), "conv_id", "n_convs", zero.alias("n_bytes"),
        F.lit(None).cast("long").alias("parent_conv_id"), "n_children")
    linked = with_parents(nodes).drop("px", "py").join(F.broadcast(first.select(F.col("conv_id").alias("root_id"))))  # one row
    linked = linked.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "root_id")).drop("root_id")
    linked = materialise(linked.unionByName(root), "linked")
    sums = subtree_sums(linked.select(
        F.struct("conv_id", "depth").alias("id"),
        F.when(F.col("parent_conv_id").isNotNull(), F.struct(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))).alias("parent"),
        "n_children", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens")), ["n_leaves", "saved_tokens"])
    ends = rows.filter("depth = length").select("depth", "x", "y", "conv_id").unionByName(
        convs.filter("length = 0").select(zero.alias("depth"), zero.alias("x"), zero.alias("y"), "conv_id"))
    hashed = end_hashes(ends, ["depth", "x", "y"])
    named = sums.select(F.col("id.conv_id").alias("conv_id"), F.col("id.depth").alias("depth"), "n_leaves", "saved_tokens")
    return linked.join(named, ["conv_id", "depth"]).join(hashed, ["depth", "x", "y"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "x", "y")
