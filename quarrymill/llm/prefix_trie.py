"""A trie of conversations by their turns, as succinct level-order tries (LOUDS) of prefix shards.

1. Turns are numbered; role and text become a 128-bit label, so that texts are shuffled once.
2. Conversations are read turn by turn in one pass that chains the labels: a node's path is the hash of its parent's path and its label. Nodes are groups of
   equal paths, counted before the shuffle, so that copies and common beginnings cost a row a task.
3. Nodes are dealt into shards by their path at depth 1; a shard with more than ``SHARD_NODES`` is parted at depth 2, 4, 8 and so on, as long as it has
   too many. Nodes above the depth at which their shards begin are the upper levels; the root always is one.
4. A task builds each shard's trie in numpy: nodes in level order, the LOUDS bit vector (10, then for each node a 1 a child and a 0), the label array, and the rollups
   over subtrees, which go up level by level from the last with ``add.at``. A shard is one row of the table that ``build`` returns.
5. The upper levels merge apart, without a task that holds them: each node belongs to its smallest conversation. Upper nodes' own figures and
   shards' totals are put on the turns of these conversations, summed from the last turn to the first, and these sums are added up by path.

Ids of the conversations that end at a node are joined in runs of ``1 << ID_BITS`` ids and hashed run by run in order, so that no task holds all ids of a node.

Defined results: null role and text are empty; turns with null number come first, equal numbers in the order of role, then text; repeated rows are turns
of their own; rows with null conv_id take no part; c % 100 keeps the sign of c, as SQL's does; a conversation left without turns is a member of
the root alone; an empty table gives no nodes; other columns are ignored, whatever their names. Bounds: no shard has more than ``SHARD_NODES`` nodes; a conversation's turns are read in order by one
task, row by row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import Scratch, read

SHARD_NODES = 100_000
ID_BITS = 13
ROOT = bytes(16)
NO_ENDS = hashlib.sha256(b"").hexdigest()

STEPS = "conv_id long, depth int, path binary, parent binary, label binary, chars long, is_end boolean, cuts array<binary>"
#: A shard: its top node's figures, then the trie; lists are in level order.
SHARDS = (
    "top binary, parent binary, depth int, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, n_nodes long, louds binary, labels binary, "
    "conv_ids array<long>, convs array<long>, leaves array<long>, saved array<long>, ends array<string>"
)
NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


# --- conversations --------------------------------------------------------------------------------------------


def numbered_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, label, chars) of (conv_id, turn, role, text); pos from 1."""
    own = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    pos = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text"))
    label = F.substring(F.unhex(F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)), 1, 16)
    return own.where(F.col("conv_id").isNotNull()).select("conv_id", pos.alias("pos"), label.alias("label"), F.char_length("text").cast("long").alias("chars"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """Conversation c begins with the first h turns of conversation c - c % 100 in place of its own, h = crc32(c) % 6.

    turns: a table that reads the same each time. Positions keep their order, not their numbers; each conversation has a row with pos 0 and no label.
    """
    base, h = F.col("conv_id") - F.col("conv_id") % 100, F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    own = turns.where((F.col("conv_id") == base) | (F.col("pos") > h))
    heads = turns.where("pos = 1").select("conv_id", base.alias("base"), h.alias("h"))
    first = turns.where((F.col("conv_id") % 100 == 0) & (F.col("pos") <= 5)).withColumnRenamed("conv_id", "base")
    lent = heads.where("conv_id <> base").join(first, "base").where("pos <= h").select("conv_id", "pos", "label", "chars")
    starts = heads.select("conv_id", F.lit(0).alias("pos"), F.lit(None).cast("binary").alias("label"), F.lit(0).cast("long").alias("chars"))
    return own.unionByName(lent).unionByName(starts)


def _chained(batches):
    """Rows of a conversation in order, the one with pos 0 first, as its nodes from the root to its end."""
    held = None
    now = path = cuts = depth = None

    def out(rows):
        columns = list(zip(*rows))
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.bool_(), pa.list_(pa.binary())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["conv_id", "depth", "path", "parent", "label", "chars", "is_end", "cuts"])

    for b in batches:
        rows = []
        for conv, label, chars in zip(*(b.column(c).to_pylist() for c in ("conv_id", "label", "chars"))):
            new = conv != now
            if held:
                rows.append((*held[:6], new, held[6]))
            if new:
                now, path, parent, cuts, depth = conv, ROOT, None, [], 0
            else:
                parent, depth = path, depth + 1
                path = hashlib.blake2b(parent + label, digest_size=16).digest()
                if depth & (depth - 1) == 0:
                    cuts = [*cuts, path]
            held = conv, depth, path, parent, label, chars, cuts
        if rows:
            yield out(rows)
    if held:
        yield out([(*held[:6], True, held[6])])


def steps_of(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, path, parent, label, chars, is_end, cuts) of (conv_id, pos, label, chars); cuts: the paths at depths 1, 2, 4, ..."""
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "pos").select("conv_id", "label", "chars").mapInArrow(_chained, STEPS)


def _hashed(batches):
    """(path, ends_sha256) of (path, ids) in order of path and ids."""
    now = digest = None
    for b in batches:
        rows = []
        for path, ids in zip(b.column("path").to_pylist(), b.column("ids").to_pylist()):
            if path != now:
                if now is not None:
                    rows.append((now, digest.hexdigest()))
                now, digest = path, hashlib.sha256()
                digest.update(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), (pa.binary(), pa.string()))], ["path", "ends_sha256"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([digest.hexdigest()])], ["path", "ends_sha256"])


def ends_of(steps: DataFrame, id_bits: int = ID_BITS) -> DataFrame:
    """(path, ends_sha256) of the nodes at which conversations end."""
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    runs = steps.where("is_end").groupBy("path", F.shiftright("conv_id", id_bits).alias("run")).agg(ids.alias("ids"))
    return runs.repartition("path").sortWithinPartitions("path", "run").select("path", "ids").mapInArrow(_hashed, "path binary, ends_sha256 string")


def nodes_of(steps: DataFrame) -> DataFrame:
    """One row a node: path, parent, depth, label, chars, cuts, conv_id (smallest member), n_convs and ends_sha256 (null: no ends)."""
    # All but the last two follow from the path.
    nodes = steps.groupBy("path", "parent", "depth", "label", "chars", "cuts").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    return nodes.join(ends_of(steps), "path", "left")


# --- shards ---------------------------------------------------------------------------------------------------


def louds_bits(degree: np.ndarray) -> np.ndarray:
    """The level-order bit vector of nodes with so many children: 10 for a root above the root, then for each node its children as ones and a zero."""
    bits = np.ones(2 + int(degree.sum()) + len(degree), np.uint8)
    bits[1] = 0
    bits[1 + np.cumsum(degree + 1)] = 0
    return bits


class Louds:
    """A level-order trie: parents and children from its bit vector by rank and select."""

    def __init__(self, packed: bytes, labels: bytes, n: int):
        self.n, self.labels = n, labels
        bits = np.unpackbits(np.frombuffer(packed, np.uint8), count=2 * n + 1)
        self.zeros = np.flatnonzero(bits == 0)  # select0
        ones = np.flatnonzero(bits)  # select1: node i is the i-th one
        self.parent = ones - np.arange(n) - 1  # zeros before it, less the one of the root above
        self.degree = np.diff(self.zeros) - 1

    def children(self, i: int) -> range:
        first = int(self.zeros[i]) - i  # ones before the node's block
        return range(first, first + int(self.degree[i]))

    def levels(self) -> list[slice]:
        """The nodes of each level."""
        out, a, b = [], 0, 1
        while a < self.n:
            out.append(slice(a, b))
            a, b = b, b + int(self.degree[a:b].sum())
        return out

    def find(self, labels: list[bytes]) -> int | None:
        """The node reached from the top by these labels."""
        at = 0
        for label in labels:
            at = next((c for c in self.children(at) if self.labels[16 * c : 16 * c + 16] == label), None)
            if at is None:
                return None
        return at


def _built(table: pa.Table) -> dict:
    """A shard's row from its nodes (of one top, in any order)."""
    depth = table.column("depth").to_numpy()
    # Level order: depth by depth, children in the order of their parents, then by label.
    table = table.take(pa.array(np.argsort(depth, kind="stable")))
    depth, path = table.column("depth").to_numpy(), table.column("path").combine_chunks()
    above = pc.index_in(table.column("parent").combine_chunks(), path).fill_null(-1).to_numpy()  # place of the parent before the order below
    label = np.array([x or b"" for x in table.column("label").to_pylist()], object)
    cuts = [0, *(np.flatnonzero(np.diff(depth)) + 1).tolist(), len(depth)]
    place = np.zeros(len(depth), np.int64)
    order = np.zeros(len(depth), np.int64)
    for a, b in zip(cuts, cuts[1:]):
        parents = place[above[a:b]] if a else np.zeros(b - a, np.int64)
        own = np.lexsort((np.argsort(np.argsort(label[a:b], kind="stable"), kind="stable"), parents))
        order[a:b] = a + own
        place[a + own] = np.arange(a, b)
    degree = np.bincount(place[above[1:]], minlength=len(depth))
    packed = np.packbits(louds_bits(degree)).tobytes()
    labels = b"".join(label[order])
    trie = Louds(packed, labels, len(depth))
    conv, convs, chars = (table.column(c).to_numpy()[order] for c in ("conv_id", "n_convs", "chars"))
    leaves, saved = (degree == 0).astype(np.int64), (convs - 1) * chars
    for level in reversed(trie.levels()[1:]):
        np.add.at(leaves, trie.parent[level], leaves[level])
        np.add.at(saved, trie.parent[level], saved[level])
    ends = table.column("ends_sha256").take(pa.array(order)).to_pylist()
    top = {"top": path[0].as_py(), "parent": table.column("parent")[0].as_py(), "depth": int(depth[0]), "conv_id": int(conv[0]), "n_convs": int(convs[0]), "n_children": int(degree[0])}
    top |= {"n_leaves": int(leaves[0]), "saved_tokens": int(saved[0]), "ends_sha256": ends[0], "n_nodes": len(depth), "louds": packed, "labels": labels}
    return top | {"conv_ids": conv.tolist(), "convs": convs.tolist(), "leaves": leaves.tolist(), "saved": saved.tolist(), "ends": ends}


def _groups(batches, column: str) -> Iterator[pa.Table]:
    """Tables of equal values of a column, of batches sorted by it."""
    held, now = [], None
    for b in batches:
        keys = b.column(b.schema.get_field_index(column)).to_pylist()
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for i, j in zip(cuts, cuts[1:]):
            if i == j:
                continue
            if held and keys[i] != now:
                yield pa.Table.from_batches(held)
                held = []
            now = keys[i]
            held.append(b.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


_SHARD_FIELDS = [
    ("top", pa.binary()), ("parent", pa.binary()), ("depth", pa.int32()), *((n, pa.int64()) for n in ("conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")), ("ends_sha256", pa.string()),
    ("n_nodes", pa.int64()), ("louds", pa.binary()), ("labels", pa.binary()), *((n, pa.list_(pa.int64())) for n in ("conv_ids", "convs", "leaves", "saved")), ("ends", pa.list_(pa.string())),
]


def _shards(batches):
    for group in _groups(batches, "top"):
        row = _built(group)
        yield pa.RecordBatch.from_arrays([pa.array([row[n]], k) for n, k in _SHARD_FIELDS], [n for n, _ in _SHARD_FIELDS])


def deal(nodes: DataFrame, shard_nodes: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Nodes with the path of their shard's top, and the nodes of the upper levels. nodes: a table that reads the same each time."""
    upper, dealt, left = nodes.where("depth = 0"), None, nodes.where("depth > 0")
    level = 0
    while True:
        keyed = left.withColumn("top", F.col("cuts")[level])
        large = scratch.put(keyed.groupBy("top").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > shard_nodes).select("top"), f"large{level}")
        here = keyed.join(large, "top", "left_anti")  # large: a row for more than shard_nodes nodes; Spark broadcasts it while it is small
        dealt = here if dealt is None else dealt.unionByName(here)
        if large.isEmpty():
            return dealt, upper
        level += 1
        inside = keyed.join(large, "top", "left_semi").drop("top")
        upper = upper.unionByName(inside.where(F.col("depth") < 1 << level))
        left = inside.where(F.col("depth") >= 1 << level)


def build(turns: DataFrame, shard_nodes: int = SHARD_NODES) -> tuple[DataFrame, DataFrame]:
    """The trie of (conv_id, pos, label, chars), each conversation with a row of pos 0: the table of shards, and that of the upper levels' nodes."""
    scratch = Scratch(turns.sparkSession)
    steps = scratch.put(steps_of(turns), "steps")
    nodes = scratch.put(nodes_of(steps), "nodes")
    dealt, upper = deal(nodes, shard_nodes, scratch)
    shards = scratch.put(dealt.drop("cuts").repartition("top").sortWithinPartitions("top", "depth").mapInArrow(_shards, SHARDS), "shards")
    upper = scratch.put(upper.drop("cuts", "label"), "upper")
    return shards, scratch.put(merged(upper, shards, steps), "merged")


def merged(upper: DataFrame, shards: DataFrame, steps: DataFrame) -> DataFrame:
    """The upper levels' nodes with path, children and rollups.

    A node's smallest conversation passes through all nodes above it. So what a node adds to the nodes above it is put on that conversation's step, and
    sums from a conversation's last step to its first, added up by path, are the rollups: rows in proportion to the steps, whatever the depth.
    """
    tops = shards.select(F.col("top").alias("path"), "parent", "depth", "conv_id", "n_leaves", "saved_tokens")
    children = upper.select("parent").unionByName(tops.select("parent")).where("parent IS NOT NULL").groupBy(F.col("parent").alias("path")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = upper.join(children, "path", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    own = nodes.select("conv_id", "depth", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    added = own.unionByName(tops.select("conv_id", "depth", F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")))
    last = added.groupBy("conv_id").agg(F.max("depth").alias("_last"))
    steps = steps.join(last, "conv_id").where(F.col("depth") <= F.col("_last")).select("conv_id", "depth", "path", *(F.lit(0).cast("long").alias(c) for c in ("leaves", "saved")))
    upward = Window.partitionBy("conv_id").orderBy(F.desc("depth"))  # with the step's own sums: rows of one depth are peers
    sums = steps.unionByName(added.withColumn("path", F.lit(None).cast("binary"))).select("path", F.sum("leaves").over(upward).alias("leaves"), F.sum("saved").over(upward).alias("saved"))
    totals = sums.where("path IS NOT NULL").groupBy("path").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    return nodes.join(totals, "path").select("path", "parent", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _unpacked(batches):
    """The nodes of shards below their tops, read back from the bit vectors."""
    for b in batches:
        for row in b.to_pylist():
            trie = Louds(row["louds"], row["labels"], row["n_nodes"])
            depth = np.zeros(trie.n, np.int64)
            for k, level in enumerate(trie.levels()):
                depth[level] = row["depth"] + k
            conv = np.array(row["conv_ids"], np.int64)
            columns = [conv[1:], depth[1:], conv[trie.parent[1:]], np.array(row["convs"], np.int64)[1:], trie.degree[1:], *(np.array(row[c], np.int64)[1:] for c in ("leaves", "saved"))]
            ends = pa.array([x or NO_ENDS for x in row["ends"][1:]], pa.string())
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), ends], [c.split()[0] for c in NODES.split(", ")])


def nodes(shards: DataFrame, upper: DataFrame) -> DataFrame:
    """All nodes of a trie that ``build`` made."""
    inner = shards.select("depth", "louds", "labels", "n_nodes", "conv_ids", "convs", "leaves", "saved", "ends").mapInArrow(_unpacked, NODES)
    figures = "n_convs", "n_children", "n_leaves", "saved_tokens"
    tops = shards.select("parent", "depth", "conv_id", *figures, "ends_sha256").unionByName(upper.drop("path"))
    above = upper.select(F.col("path").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    ends = F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")
    outer = tops.join(above, "parent", "left").select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", *figures, ends)
    return inner.unionByName(outer)


def trie_of(conversations: DataFrame, shard_nodes: int = SHARD_NODES) -> tuple[DataFrame, DataFrame]:
    """Shards and upper levels of rebuilt conversations (conv_id, turn, role, text)."""
    turns = Scratch(conversations.sparkSession).put(numbered_turns(conversations), "turns")
    return build(rebuilt(turns), shard_nodes)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes(*trie_of(read(spark, sf_dir, "conversations")))


ORACLE = """
WITH crc_table AS (
  SELECT list(list_reduce(range(8), lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, i) ORDER BY i) AS tab FROM range(256) t(i)
), own AS (
  SELECT conv_id, list({'hash': md5(coalesce(role, '') || chr(0) || coalesce(text, '')), 'chars': length(coalesce(text, ''))}
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
  SELECT own.*, conv_id - conv_id % 100 AS base,
    xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
      lambda v, x: xor(v // 256, tab[(xor(v, x) % 256) + 1]), 4294967295::BIGINT), 4294967295) % 6 AS h
  FROM own, crc_table
), rebuilt AS (
  SELECT h.conv_id, list_concat(coalesce(b.turns[1:h], []), h.turns[h + 1:]) AS turns FROM h LEFT JOIN own b ON b.conv_id = h.base
), steps AS (
  SELECT conv_id, d, len(turns) AS n, list_transform(turns[1:d], lambda x: x.hash) AS path, CASE WHEN d = 0 THEN 0 ELSE turns[d].chars END AS chars
  FROM rebuilt, unnest(range(0, len(turns) + 1)) t(d)
), nodes AS (
  SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
  FROM steps GROUP BY d, path
), children AS (SELECT path[1:d - 1] AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
sums AS (
  SELECT v.path[1:i] AS path, sum(CASE WHEN c.n IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((v.n_convs - 1) * v.chars) AS saved_tokens
  FROM nodes v LEFT JOIN children c ON c.path = v.path, unnest(range(0, v.d + 1)) t(i) GROUP BY 1
)
SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, v.n_convs, coalesce(c.n, 0) AS n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM nodes v JOIN sums s ON s.path = v.path LEFT JOIN children c ON c.path = v.path LEFT JOIN nodes p ON v.d > 0 AND p.d = v.d - 1 AND p.path = v.path[1:v.d - 1]
"""
