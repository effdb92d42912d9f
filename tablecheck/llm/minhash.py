"""Near-duplicate documents by one-permutation MinHash, banded buckets and star-shaped edges.

1. Each document gives its set of distinct word shingles as 64-bit hashes, a
   128-bit digest of that set and one signature: a single hash of each shingle
   picks its bin, the least value of a bin stays, and an empty bin copies the
   bin that its own hash sequence reaches first (optimal densification).
2. Documents with equal sets are one class and go on as one node.
3. Bands of the signature are bucket keys.  Buckets of one node end here.
4. Star edges: in each bucket one node, the *centre*, is paired with the
   others, so a bucket of n nodes costs n pairs.  The first centre is the node
   with the largest buckets over all bands: the least edited copy of a group,
   near the others.  Pairs are confirmed on the full sets and linked.
5. Buckets that still hold several components get further rounds: the next
   most central node of the largest component against the nodes outside it,
   and that of the other nodes against all that are not its own.  Links of a
   round join components by their labels.  They end when a round adds no link,
   at the latest after ``STAR_ROUNDS``: what they leave is left to step 6.
6. Exact finish: two nodes that share a bucket, are not in one component and
   were never centre there are still open.  The nodes of such a bucket are dealt
   into blocks of about ``HOLDERS`` nodes, every two blocks that may hold nodes
   of different components meet once, and the task where they meet counts what
   their full sets share and gives the links alone: no list of pairs is written
   and no task holds more than two blocks.  No bucket, partner or candidate is capped.

A pair at similarity s meets in a bucket with probability
1 - (1 - s^rows)^bands: 0.999995 at 0.75 with 32 bands of 4.

Intermediate tables (16-byte nodes, buckets, links) are written to the shared
checkpoint folder; a lost executor costs one step.

Defined cases: rows without words have an empty set and link with nothing
(``component_id`` is their own id); rows that share an id are told apart by
their sets; a null id counts as largest, and a component of null ids only has a
null ``component_id``; every input row gives one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch_of, column, lower_words, materialise

BANDS, ROWS = 32, 4
SHINGLE = 5
#: Similarity in percent.
THRESHOLD = 75
#: Rounds of star edges before the exact finish.
STAR_ROUNDS = 3
#: Nodes and shingles of a block in the exact finish, and the shingles counted at a time.
HOLDERS, HELD_SHINGLES, COLUMNS = 500, 2_000_000, 2048
_NONE = np.uint64(2**64 - 1)
MAX_MEMO = 500_000


class _WordHashes(dict):
    """64-bit hashes of the words seen so far; a bounded cache."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_MEMO:
            self.clear()
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h


_WORDS = _WordHashes()


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser: spreads every input bit over the output."""
    for shift, factor in ((33, 0x9E3779B97F4A7C15), (29, 0xD6E8FEB86659FD93)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(32))


def shingles(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; fewer words count as one shingle."""
    words = lower_words(text)
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, n)
    width = min(n, size)
    factors = _odd(size, size)
    h = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        h += _mix(w[k:n - width + 1 + k] * factors[k])
    return np.unique(_mix(h))


class Signer:
    """Signatures of ``bands * rows`` bins, and their band keys."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        self.factors = _odd(101, rows)

    def signatures(self, sets: list[np.ndarray]) -> np.ndarray:
        """One row of bins per set; sets must not be empty."""
        sizes = np.array([len(s) for s in sets])
        h = np.concatenate(sets)
        out = np.full(len(sets) * self.bins, _NONE)
        np.minimum.at(out, np.repeat(np.arange(len(sets)), sizes) * self.bins + (h % np.uint64(self.bins)).astype(np.int64),
                      h // np.uint64(self.bins))
        out = out.reshape(len(sets), self.bins)
        filled = out != _NONE
        row, col = np.nonzero(~filled)
        attempt = 0
        while len(row):  # each empty bin follows its own sequence of bins to the first filled one
            attempt += 1
            to = (_mix(col.astype(np.uint64) * np.uint64(1_000_003) + np.uint64(attempt)) % np.uint64(self.bins)).astype(np.int64)
            ok = filled[row, to]
            out[row[ok], col[ok]] = out[row[ok], to[ok]]
            row, col = row[~ok], col[~ok]
        return out

    def band_keys(self, signatures: np.ndarray) -> np.ndarray:
        s = signatures.reshape(len(signatures), self.bands, self.rows)
        keys = _mix(np.arange(self.bands, dtype=np.uint64))[None, :].repeat(len(signatures), 0)
        for k in range(self.rows):
            keys = _mix(keys + s[:, :, k] * self.factors[k])
        return keys.view(np.int64)


def signed(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int, size: int) -> DataFrame:
    """``id, n, node, bands`` of each row: size and digest of its set, and its band keys (null without words)."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("node", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(bands, rows)
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                b = whole.slice(start, 1024)
                sets = [shingles(t, size) for t in column(b, "text")]
                full = [k for k, s in enumerate(sets) if len(s)]
                keys: list = [None] * len(sets)
                if full:
                    for k, own in zip(full, signer.band_keys(signer.signatures([sets[k] for k in full]))):
                        keys[k] = own
                yield batch_of(schema, b.column(0), [len(s) for s in sets],
                               [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                               keys)

    rows_in = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows_in.mapInArrow(run, "id long, n long, node binary, bands array<long>")


def node_sets(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``node, shingles`` for the classes in ``nodes`` (``node, id``: one row's id that holds the class)."""
    schema = pa.schema([("node", pa.binary()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                b = whole.slice(start, 1024)
                sets = [shingles(t, size) for t in column(b, "text")]
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                mine = [k for k, want in enumerate(column(b, "node")) if want == digests[k]]
                yield batch_of(schema, [digests[k] for k in mine], [sets[k].view(np.int64) for k in mine])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    wanted = rows.join(nodes, rows["id"].eqNullSafe(nodes["id"])).select("text", "node")
    return wanted.mapInArrow(run, "node binary, shingles array<long>").dropDuplicates(["node"])


def _alike(a: Column, b: Column, percent: int) -> Column:
    """Sizes that allow the similarity."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows of ``pairs`` (``a, b`` and more) whose full sets are similar enough."""
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.filter(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select(*pairs.columns)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, component`` (the least node reachable) of an edge list ``a, b``.

    Each step lets every node hand the least node it knows to its neighbours
    and to itself, one aggregate and one join on the node, until all edges lead
    to the least node of their component.  The edge list is written to the
    checkpoint folder after each step.
    """
    edges = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), name)
    while not _are_stars(edges):
        both = edges.union(edges.select("v", "u").toDF("u", "v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        handed = both.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m"))
        edges = materialise(handed.filter("u <> v").distinct(), name)
    return edges.toDF("node", "component").union(edges.select("v", "v").distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Every node on the larger end of an edge has that one edge, and its smaller end is on no larger end."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("large"), F.lit(0).alias("small")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    seen = ends.groupBy("x").agg(F.sum("large").alias("large"), F.max("small").alias("small"))
    return seen.filter("large > 1 OR large = 1 AND small = 1").isEmpty()


def _star_pairs(seen: DataFrame, used: DataFrame | None, percent: int) -> tuple[DataFrame, DataFrame]:
    """Centres (``bucket, centre``) of a round and the pairs they give; ``seen``: bucket, node, n, score, component."""
    per = seen.groupBy("bucket", "component").agg(F.count("*").alias("held"))
    top = per.groupBy("bucket").agg(F.count("*").alias("parts"), F.max_by("component", F.struct("held", "component")).alias("largest"))
    mixed = seen.join(top.filter("parts > 1"), "bucket")
    free = mixed if used is None else mixed.join(used, ["bucket", "node"], "left_anti")
    who = F.struct("score", "node", "n", "component")
    if used is None:
        centres = free.groupBy("bucket").agg(F.max(who).alias("c"))
    else:
        centres = free.groupBy("bucket", (F.col("component") == F.col("largest")).alias("inside")).agg(F.max(who).alias("c"))
    centres = materialise(centres.select("bucket", "c"), "star_centres")
    pairs = mixed.join(centres, "bucket").filter((F.col("component") != F.col("c.component")) & _alike(F.col("n"), F.col("c.n"), percent))
    first = F.col("node") < F.col("c.node")
    ends = [F.when(first, x).otherwise(y).alias(name) for x, y, name in (
        (F.col("node"), F.col("c.node"), "a"), (F.col("c.node"), F.col("node"), "b"),
        (F.col("component"), F.col("c.component"), "of_a"), (F.col("c.component"), F.col("component"), "of_b"))]
    return centres.select("bucket", F.col("c.node").alias("node")), pairs.select(*ends).distinct()


def _open_rows(seen: DataFrame, used: DataFrame) -> DataFrame:
    """The rows of ``seen`` whose node shares the bucket with an unchecked node of another component.

    A centre met every other component of its bucket, so only nodes that were no centre there are open.
    """
    free = seen.join(used, ["bucket", "node"], "left_anti")
    mixed = free.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    return free.join(mixed.select("bucket"), "bucket", "left_semi").select("bucket", "node", "n", "component")


def _dealt(rows: DataFrame, percent: int, holders: int) -> DataFrame:
    """``bucket, node, n, component`` of open buckets, once for each ``meeting`` (``kind, low, high``) of two blocks, with its ``side``.

    The largest component of a bucket has blocks of its own, which meet the
    blocks of the rest only (kind 1); blocks of the rest meet each other and
    themselves (kind 0).  Nodes of the largest component too small or too large
    for any of the rest stay out.
    """
    per = rows.groupBy("bucket", "component").agg(F.count("*").alias("held"), F.sum("n").alias("of_n"),
                                                  F.min("n").alias("least"), F.max("n").alias("most"))
    largest = per.groupBy("bucket").agg(F.max_by("component", F.struct("held", "component")).alias("largest"))
    inside = F.col("component") == F.col("largest")

    def of(how, c, where):
        return how(F.when(where, F.col(c)))

    def parts(where):
        blocks = F.greatest(of(F.sum, "held", where) / holders, of(F.sum, "of_n", where) / HELD_SHINGLES)
        return F.ceil(blocks).cast("int")

    sizes = per.join(largest, "bucket").groupBy("bucket").agg(
        F.first("largest").alias("largest"), parts(inside).alias("m"), parts(~inside).alias("r"),
        of(F.min, "least", ~inside).alias("least"), of(F.max, "most", ~inside).alias("most"))
    near = (100 * F.col("n") >= percent * F.col("least")) & (100 * F.col("most") >= percent * F.col("n"))
    dealt = rows.join(sizes, "bucket").withColumn("inside", inside).filter(~F.col("inside") | near)
    block = F.pmod(F.xxhash64("node"), F.when(F.col("inside"), F.col("m")).otherwise(F.col("r"))).cast("int")
    dealt = dealt.withColumn("block", block)
    b, rest, main = F.col("block"), F.sequence(F.lit(0), F.col("r") - 1), F.sequence(F.lit(0), F.col("m") - 1)

    def meeting(kind, low, high, side):
        return F.struct(F.lit(kind).alias("kind"), low.alias("low"), high.alias("high"), side.cast("int").alias("side"))

    with_rest = F.transform(rest, lambda o: meeting(0, F.least(b, o), F.greatest(b, o), b > o))
    with_main = F.transform(main, lambda o: meeting(1, b, o, F.lit(0)))
    from_main = F.transform(rest, lambda o: meeting(1, o, b, F.lit(1)))
    each = F.explode(F.when(F.col("inside"), from_main).otherwise(F.concat(with_rest, with_main))).alias("meeting")
    return dealt.select("bucket", "node", "n", "component", each).select(
        "bucket", "meeting.kind", "meeting.low", "meeting.high", "meeting.side", "node", "n", "component")


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets have in common, by products of 0/1 matrices of ``COLUMNS`` shingles at a time."""
    out = np.zeros((len(left), len(right)), np.float32)
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))
    spots = []
    for sets in (left, right):
        row, flat = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets)
        at = np.minimum(np.searchsorted(both, flat), max(len(both) - 1, 0))
        own = both[at] == flat if len(both) else np.zeros(len(flat), bool)
        order = np.argsort(at[own], kind="stable")
        spots.append((row[own][order], at[own][order]))
    for first in range(0, len(both), COLUMNS):
        sides = []
        for sets, (row, at) in zip((left, right), spots):
            start, stop = np.searchsorted(at, (first, first + COLUMNS))
            ones = np.zeros((len(sets), COLUMNS), np.float32)
            ones[row[start:stop], at[start:stop] - first] = 1
            sides.append(ones)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def _open_links(rows: DataFrame, sets: DataFrame, percent: int, holders: int) -> DataFrame:
    """``a, b, of_a, of_b``: the links between the components of each open bucket, found where two blocks meet."""
    schema = pa.schema([(c, pa.binary()) for c in ("a", "b", "of_a", "of_b")])

    def run(met: pa.Table) -> pa.Table:
        side = np.array(met.column("side"))
        alone = met.column("kind")[0].as_py() == 0 and met.column("low")[0] == met.column("high")[0]
        left = np.flatnonzero(side == 0)
        right = left if alone else np.flatnonzero(side == 1)
        if not len(left) or not len(right):
            return schema.empty_table()
        full = [s.values.to_numpy() for s in met.column("shingles")]
        n, nodes, of = np.array(met.column("n")), met.column("node").to_pylist(), met.column("component").to_pylist()
        label = np.unique(np.array(of, object), return_inverse=True)[1]
        both = _shared([full[k] for k in left], [full[k] for k in right])
        union = n[left][:, None] + n[right][None, :] - both
        linked = (100 * both >= percent * union) & (label[left][:, None] != label[right][None, :])
        ends = [sorted(((nodes[left[i]], of[left[i]]), (nodes[right[j]], of[right[j]]))) for i, j in zip(*np.nonzero(linked))]
        return pa.Table.from_arrays([pa.array([e[x][y] for e in ends], pa.binary()) for y in (0, 1) for x in (0, 1)], schema=schema)

    met = _dealt(rows, percent, holders).join(sets, "node")
    return met.groupBy("bucket", "kind", "low", "high").applyInArrow(run, "a binary, b binary, of_a binary, of_b binary").distinct()


def _joined(state: DataFrame, found: DataFrame) -> DataFrame:
    """``state`` with the components that the links ``found`` join: only the labels are grouped."""
    grouped = components(found.select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))).toDF("component", "joined")
    return materialise(state.join(grouped, "component", "left")
                       .select("node", "n", "score", F.coalesce("joined", "component").alias("component")), "nodes")


def link_nodes(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """``node, component`` of the classes that share a bucket with another class."""
    placed = classes.select("node", "n", F.explode("bands").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.count("*").alias("held")).filter("held > 1")
    buckets = materialise(placed.join(shared, "bucket").select("bucket", "node", "n", "held"), "buckets")
    state = materialise(buckets.groupBy("node").agg(F.first("n").alias("n"), F.sum("held").alias("score"))
                        .withColumn("component", F.col("node")), "nodes")
    buckets = buckets.select("bucket", "node")
    sets = materialise(node_sets(docs, classes.join(state.select("node"), "node", "left_semi").select("node", "id"),
                                 id_col, text_col, size), "node_sets")
    used = checked = None
    for _ in range(STAR_ROUNDS):
        centres, pairs = _star_pairs(buckets.join(state, "node"), used, percent)
        if checked is not None:
            pairs = pairs.join(checked, ["a", "b"], "left_anti")
        pairs = materialise(pairs, "star_pairs")
        found = materialise(confirmed(pairs, sets, percent), "star_links")
        first = used is None
        used = centres if first else used.union(centres)
        checked = pairs.select("a", "b") if first else checked.union(pairs.select("a", "b"))
        if not found.isEmpty():
            state = _joined(state, found)
        elif not first:
            break
    rows = materialise(_open_rows(buckets.join(state, "node"), used), "open_rows")
    if not rows.isEmpty():
        found = materialise(_open_links(rows, sets, percent, HOLDERS), "open_links")
        if not found.isEmpty():
            state = _joined(state, found)
    return state.select("node", "component")


def _grouped(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows' ``id, n, node`` and, for each node, its ``component`` (a node) and least ``id``."""
    signs = materialise(signed(docs, id_col, text_col, bands, rows, size), "signatures")
    classes = signs.filter("n > 0").groupBy("node").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    linked = link_nodes(docs, classes, id_col, text_col, size, percent)
    own = signs.filter("n > 0").groupBy("node").agg(F.min("id").alias("id"))
    return signs, own.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS, rows: int = ROWS,
                    size: int = SHINGLE, percent: int = THRESHOLD) -> DataFrame:
    """``id, n_shingles, component_id, kept`` for each row of ``docs``.

    ``component_id`` is the least id reachable over links (similarity of
    ``percent`` or more on full shingle sets), ``kept`` marks the row's own.
    """
    signs, grouped = _grouped(docs, id_col, text_col, bands, rows, size, percent)
    least = grouped.groupBy("component").agg(F.min("id").alias("component_id"))
    named = grouped.join(least, "component").select("node", "component_id")
    rows_out = signs.select("id", "n", "node").join(named, "node", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return rows_out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                           F.col("id").eqNullSafe(component).alias("kept"))


def with_node(docs: DataFrame, text_col: str, size: int) -> DataFrame:
    """``row, node``: each row of ``docs`` as a struct and the digest of its set (null without words)."""
    flat = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = (shingles(t, size) for t in column(b, "text"))
            nodes = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(nodes, pa.binary())], names=["row", "node"])

    return flat.mapInArrow(run, f"row {flat.schema['row'].dataType.simpleString()}, node binary")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS, rows: int = ROWS,
                         size: int = SHINGLE, percent: int = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each group of near duplicates and every row without words, all columns.

    The row of the least id stays (null last; of several texts under that id,
    the one of the least set digest).
    """
    _, grouped = _grouped(docs, id_col, text_col, bands, rows, size, percent)
    stays = grouped.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "node")).alias("stays")) \
        .select(F.col("stays.id").alias("_id"), F.col("stays.node").alias("_node"))
    rows_in = with_node(docs, text_col, size).withColumn("id", F.col(f"row.`{id_col}`").cast("long"))
    same = (F.col("node") == F.col("_node")) & F.col("id").eqNullSafe(F.col("_id"))
    kept = rows_in.filter("node IS NOT NULL").join(stays, same, "left_semi").dropDuplicates(["node"])
    out = kept.unionByName(rows_in.filter("node IS NULL"))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
