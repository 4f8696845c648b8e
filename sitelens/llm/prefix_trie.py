"""Conversation prefix trie on minimal-perfect-hash node tables.

Conversations are rebuilt (the first turns come from another conversation), and
every distinct sequence of first turns is a node.  A node's key is 128 bits: the
xor of two hashes of (position, content of the turn) over the prefix.  Xor needs
no order, so a conversation is cut into pieces of ``PIECE`` turns: a piece's keys
are a running xor inside the piece on top of the xor of the pieces before it, and
no task ever holds a whole conversation.

Pieces are dealt to shards of about ``SHARD_ROWS`` turns, the conversations of one
family (same source of the first turns) together.  A shard lists its distinct
prefix digests, gives each a slot by a minimal perfect hash that is verified against
the stored keys, and holds its nodes in flat numpy arrays with the slot of the parent:

1. ends of pieces are scattered to their slots and counts run up through the
   parent slots, deepest nodes first: members of every node in the shard;
2. Spark adds up the shards' nodes by key (at most one row per node and shard,
   however many conversations pass it) and checks that one key never stands for two
   prefixes; if it does, all is done again with other hashes;
3. each node's tokens and whether it is a leaf go to the shard of its smallest
   member, are scattered and run up in the same way, and Spark adds up by key again.

What later pieces of a conversation own is added at the last node of each piece before.
Members that end at a node are joined into chunks of text by range and hashed
in order as a stream, so a node where a third of all conversations end never stands in memory.

Defined cases: a NULL role or text is empty; rows without conv_id belong to no
conversation; turns with one number are ordered by role, then by a hash of role and
text, and repeated rows are turns of their own; a NULL turn comes first; a
conversation without turns after rebuilding ends at the root; an empty table has no
nodes, not even a root; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sequence import number_rows
from .common import stored

#: Conversations with ids c - c % FAMILY ... belong together; their heads have up to HEADS - 1 turns.
FAMILY, HEADS = 5, 9
#: Turns of a piece, turns of a shard, conversations of a chunk of ends.
PIECE = 1024
SHARD_ROWS = 50_000
CHUNK = 4096
KEY = ["k1", "k2"]
PARENT = ["p1", "p2"]


class SlotTable:
    """Minimal perfect hash of distinct 128-bit keys: levels of bit arrays, a key's slot is the rank of its bit.

    ``slots`` answers -1 for a key that is not in the table: every answer is
    verified against the key stored at the slot.
    """

    def __init__(self, k1: np.ndarray, k2: np.ndarray):
        self.levels, self.offsets = [], [0]
        self.k1, self.k2 = np.empty_like(k1), np.empty_like(k2)
        a, b = k1, k2
        while len(a):
            size = 2 * len(a)
            at = self._at(a, b, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            rank = np.cumsum(alone) - 1
            self.levels.append((alone, rank))
            mine = alone[at]
            slot = self.offsets[-1] + rank[at[mine]]
            self.k1[slot], self.k2[slot] = a[mine], b[mine]
            self.offsets.append(self.offsets[-1] + int(alone.sum()))
            a, b = a[~mine], b[~mine]

    @staticmethod
    def _at(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        x = a.view(np.uint64) ^ (b.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level * 0xD1B54A32D192ED03 & (1 << 64) - 1))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)

    def slots(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        out = np.full(len(k1), -1, np.int64)
        open_ = np.arange(len(k1))
        for level, (alone, rank) in enumerate(self.levels):
            at = self._at(k1[open_], k2[open_], level, len(alone))
            hit = alone[at]
            out[open_[hit]] = self.offsets[level] + rank[at[hit]]
            open_ = open_[~hit]
        found = np.flatnonzero(out >= 0)
        wrong = (self.k1[out[found]] != k1[found]) | (self.k2[out[found]] != k2[found])
        out[found[wrong]] = -1
        return out


def run_up(parent: np.ndarray, depth: np.ndarray, *values: np.ndarray) -> None:
    """Add every node's value to its parent's, deepest nodes first (in place)."""
    order = np.argsort(-depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[order])) + 1
    for level in np.split(order, cuts):
        level = level[parent[level] >= 0]
        for v in values:
            np.add.at(v, parent[level], v[level])


def _turns(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, content, n_bytes) with pos = 1, 2, ... inside each conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # the length keeps role and text apart
    content = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    narrow = rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.col("turn"), role.alias("role"), content.alias("content"), F.octet_length(text).cast("long").alias("n_bytes"))
    # numbered over the whole table and then from each conversation's least number: a long conversation is split by range
    numbered = number_rows(narrow, ["conv_id", F.asc_nulls_first("turn"), "role", "content"], "at").select("conv_id", "content", "n_bytes", "at")
    first = numbered.groupBy("conv_id").agg(F.min("at").alias("first"))
    return stored(numbered.join(first, "conv_id").select("conv_id", (F.col("at") - F.col("first") + 1).alias("pos"), "content", "n_bytes"), "trie-turns")


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, content, n_bytes) of the rebuilt conversations, and (conv_id) of all."""
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("long")
    source = F.col("conv_id") - F.col("conv_id") % FAMILY
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    sizes = convs.select(F.col("conv_id").alias("source"), F.col("n").alias("source_n"))
    convs = convs.select("conv_id", head.alias("head"), source.alias("source")).join(sizes, "source", "left")
    convs = stored(convs.select("conv_id", "head", "source", F.least("head", F.coalesce("source_n", F.lit(0))).alias("taken")), "trie-convs")
    heads = (turns.where(F.col("pos") < HEADS).withColumnRenamed("conv_id", "source")
             .join(convs.select("conv_id", "source", "head"), "source").where("pos <= head")     # FAMILY conversations a source at most
             .select("conv_id", F.col("pos").alias("depth"), "content", "n_bytes"))
    own = (turns.join(convs.select("conv_id", "head", "taken"), "conv_id").where("pos > head")
           .select("conv_id", (F.col("pos") - F.col("head") + F.col("taken")).alias("depth"), "content", "n_bytes"))
    return heads.unionByName(own), convs.select("conv_id")


def _prefixes(rebuilt: DataFrame, seed: int) -> DataFrame:
    """Every rebuilt turn with the key of its prefix and of the prefix before, and whether its piece ends there."""
    mixed = rebuilt.select("*", F.floor((F.col("depth") - 1) / PIECE).cast("long").alias("piece"),
                           F.xxhash64(F.lit(2 * seed), "depth", "content").alias("h1"), F.xxhash64(F.lit(2 * seed + 1), "content", "depth").alias("h2"))
    mixed = stored(mixed, "trie-mixed")
    upto = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)    # one row a piece
    none = F.lit(0).cast("long")
    before = (mixed.groupBy("conv_id", "piece").agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"))
              .select("conv_id", "piece", F.coalesce(F.bit_xor("x1").over(upto), none).alias("b1"), F.coalesce(F.bit_xor("x2").over(upto), none).alias("b2")))
    inside = Window.partitionBy("conv_id", "piece").orderBy("depth")                                    # PIECE rows
    run = inside.rowsBetween(Window.unboundedPreceding, 0)
    rows = mixed.join(before, ["conv_id", "piece"])
    k1, k2 = (F.col(f"b{i}").bitwiseXOR(F.bit_xor(f"h{i}").over(run)) for i in (1, 2))
    rows = rows.select("conv_id", "depth", "piece", "content", "n_bytes", "h1", "h2", k1.alias("k1"), k2.alias("k2"),
                       F.lead("depth").over(inside).isNull().alias("ends"))
    return rows.select("conv_id", "depth", "piece", "content", "n_bytes", *KEY, F.col("k1").bitwiseXOR(F.col("h1")).alias("p1"),
                       F.col("k2").bitwiseXOR(F.col("h2")).alias("p2"), "ends")


def _shard(conv, piece, shards: int):
    family = conv - conv % FAMILY
    return F.pmod(F.xxhash64(family, piece), F.lit(shards)).cast("long").alias("shard")


def _tables(rows: pd.DataFrame):
    """(slots, distinct nodes of the rows in slot order, slot of each node's parent or -1)."""
    nodes = rows.drop_duplicates(KEY)
    table = SlotTable(nodes["k1"].to_numpy(), nodes["k2"].to_numpy())
    slot = table.slots(nodes["k1"].to_numpy(), nodes["k2"].to_numpy())
    nodes = nodes.iloc[np.argsort(slot)]
    parent, piece = table.slots(nodes["p1"].to_numpy(), nodes["p2"].to_numpy()), nodes["piece"].to_numpy()
    # a parent in the piece before gets nothing here: what goes there is carried by conversation
    parent[piece[parent] != piece] = -1
    return table, nodes, parent


LOCAL = "shard long, k1 long, k2 long, p1 long, p2 long, depth long, piece long, content binary, n_bytes long, n long, conv_id long, clash boolean"


def _count_members(g: pd.DataFrame) -> pd.DataFrame:
    """One shard's pieces -> its nodes with members and smallest member."""
    table, nodes, parent = _tables(g)
    slot = table.slots(g["k1"].to_numpy(), g["k2"].to_numpy())
    n, least = np.zeros(len(nodes), np.int64), np.full(len(nodes), np.iinfo(np.int64).max)
    np.add.at(n, slot[g["ends"].to_numpy(bool)], 1)
    run_up(parent, nodes["depth"].to_numpy(), n)
    np.minimum.at(least, slot, g["conv_id"].to_numpy())
    # one key, one prefix: the same parent, depth and content in all rows of a slot
    clash = np.zeros(len(nodes), bool)
    for c in (*PARENT, "depth", "content"):
        clash[slot[g[c].to_numpy() != nodes[c].to_numpy()[slot]]] = True
    out = nodes[["shard", *KEY, *PARENT, "depth", "piece", "content", "n_bytes"]].copy()
    return out.assign(n=n, conv_id=least, clash=clash)


def _add_subtrees(local: pd.DataFrame, owned: pd.DataFrame) -> pd.DataFrame:
    """One shard's nodes and the values scattered to them -> what each node's subtree holds of them."""
    out = {"k1": [], "k2": [], "tokens": [], "leaves": []}
    if len(local):
        table, nodes, parent = _tables(local)
        tokens, leaves = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64)
        slot = table.slots(owned["k1"].to_numpy(), owned["k2"].to_numpy())
        if len(slot) and slot.min() < 0:
            raise ValueError("a node is not in the shard of its smallest member")
        np.add.at(tokens, slot, owned["tokens"].to_numpy())
        np.add.at(leaves, slot, owned["leaves"].to_numpy())
        run_up(parent, nodes["depth"].to_numpy(), tokens, leaves)
        some = (tokens > 0) | (leaves > 0)
        out = {"k1": nodes["k1"].to_numpy()[some], "k2": nodes["k2"].to_numpy()[some], "tokens": tokens[some], "leaves": leaves[some]}
    return pd.DataFrame(out, columns=["k1", "k2", "tokens", "leaves"])


def _ends(at: DataFrame) -> DataFrame:
    """(k1, k2, conv_id) -> (k1, k2, ends_sha256): ids in order, joined by commas, hashed."""
    def runs(batches):
        for b in batches:
            k1, k2, ids = b["k1"].to_numpy(), b["k2"].to_numpy(), b["conv_id"].to_numpy()
            new = np.flatnonzero((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])) + 1
            starts = [i for a, z in zip([0, *new.tolist()], [*new.tolist(), len(b)]) for i in range(a, z, CHUNK)]
            joined = [",".join(map(str, ids[i:j].tolist())) for i, j in zip(starts, [*starts[1:], len(b)])]
            if starts:
                yield pd.DataFrame({"k1": k1[starts], "k2": k2[starts], "first": ids[starts], "ids": joined})

    def hashes(batches):
        key, sha = None, None
        for b in batches:
            out = []
            for k1, k2, ids in zip(b["k1"].tolist(), b["k2"].tolist(), b["ids"]):
                if key != (k1, k2):
                    if key is not None:
                        out.append((*key, sha.hexdigest()))
                    key, sha = (k1, k2), hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if out:
                yield pd.DataFrame(out, columns=["k1", "k2", "ends_sha256"])
        if key is not None:
            yield pd.DataFrame([(*key, sha.hexdigest())], columns=["k1", "k2", "ends_sha256"])

    chunks = at.repartitionByRange("k1", "k2", "conv_id").sortWithinPartitions("k1", "k2", "conv_id")
    chunks = chunks.select(*KEY, "conv_id").mapInPandas(runs, "k1 long, k2 long, first long, ids string")
    return chunks.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first").mapInPandas(hashes, "k1 long, k2 long, ends_sha256 string")


def build(rows: DataFrame) -> DataFrame:
    """The nodes of the trie over ``rows`` (conv_id, turn, role, text), one row each."""
    rebuilt, convs = _rebuilt(_turns(rows))
    # of all conversations: members of the root
    n_convs, least = convs.agg(F.count(F.lit(1)), F.min("conv_id")).first()
    shards = None
    for seed in range(8):
        prefixes = _prefixes(rebuilt, seed)
        if shards is None:
            shards = max(1, math.ceil(rebuilt.count() / SHARD_ROWS))
        prefixes = stored(prefixes.select("*", _shard(F.col("conv_id"), F.col("piece"), shards)), "trie-prefixes")
        local = stored(prefixes.groupBy("shard").applyInPandas(_count_members, LOCAL), "trie-local")
        same = [F.min(c).alias(c) for c in (*PARENT, "depth", "content", "n_bytes")]
        differ = [F.min(c) != F.max(c) for c in (*PARENT, "depth", "content")]
        clash = F.max("clash")
        for d in differ:
            clash = clash | d
        nodes = stored(local.groupBy(*KEY).agg(F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"), *same, clash.alias("clash")), "trie-nodes")
        # the root has key (0, 0): no other node may have it
        if nodes.where(F.col("clash") | ((F.col("k1") == 0) & (F.col("k2") == 0))).isEmpty():
            break
    else:
        raise RuntimeError("prefix keys collide under every seed")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    children = nodes.groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(one).alias("n_children"))
    root = children.sparkSession.range(1 if n_convs else 0).select(
        zero.alias("k1"), zero.alias("k2"), F.lit(n_convs).cast("long").alias("n_convs"), F.lit(least).cast("long").alias("conv_id"),
        F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"), zero.alias("depth"), zero.alias("n_bytes"))
    nodes = stored(nodes.drop("content", "clash").unionByName(root).join(children, KEY, "left")
                   .withColumn("n_children", F.coalesce("n_children", zero)), "trie-nodes")
    # values of a node go to the shard of its smallest member
    piece = F.floor((F.col("depth") - 1) / PIECE).cast("long")
    value = nodes.where("depth > 0").select(
        *KEY, "conv_id", piece.alias("piece"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("tokens"),
        F.when(F.col("n_children") == 0, one).otherwise(zero).alias("leaves")).where("tokens > 0 OR leaves > 0")
    owned = value.select(_shard(F.col("conv_id"), F.col("piece"), shards), *KEY, "tokens", "leaves")
    # what later pieces own counts for the last node of each piece before
    later = (value.where("piece > 0").groupBy("conv_id", "piece").agg(F.sum("tokens").alias("tokens"), F.sum("leaves").alias("leaves")))
    stops = prefixes.where((F.col("depth") % PIECE == 0) & F.col("ends")).select("conv_id", "piece", "shard", *KEY)
    run = Window.partitionBy("conv_id").orderBy(F.desc("piece"))         # one row a piece, two at most
    both = stops.select("conv_id", "piece", "shard", *KEY, zero.alias("tokens"), zero.alias("leaves"), F.lit(False).alias("is_value")).unionByName(
        later.select("conv_id", "piece", F.lit(None).cast("long").alias("shard"), F.lit(None).cast("long").alias("k1"), F.lit(None).cast("long").alias("k2"),
                     "tokens", "leaves", F.lit(True).alias("is_value")))
    after = run.rangeBetween(Window.unboundedPreceding, -1)
    carried = both.select("shard", *KEY, F.sum("tokens").over(after).alias("tokens"), F.sum("leaves").over(after).alias("leaves"), "is_value")
    carried = carried.where("NOT is_value AND (tokens > 0 OR leaves > 0)").drop("is_value")
    owned = owned.unionByName(carried)
    sums = (local.select("shard", *KEY, *PARENT, "depth", "piece").groupBy("shard").cogroup(owned.groupBy("shard"))
            .applyInPandas(_add_subtrees, "k1 long, k2 long, tokens long, leaves long")
            .groupBy(*KEY).agg(F.sum("tokens").alias("saved_tokens"), F.sum("leaves").alias("n_leaves")))
    sums = stored(sums, "trie-sums")
    # the root's subtree is the whole trie; alone it is its own leaf
    total = (sums.join(nodes.where("depth = 1").select(*KEY), KEY, "left_semi")
             .agg(F.coalesce(F.sum("saved_tokens"), zero).alias("saved_tokens"), F.greatest(F.coalesce(F.sum("n_leaves"), one), one).alias("n_leaves"))
             .select(zero.alias("k1"), zero.alias("k2"), "saved_tokens", "n_leaves"))
    sums = sums.unionByName(total)
    last = prefixes.groupBy("conv_id").agg(F.max(F.struct("depth", *KEY)).alias("last"))
    ends = _ends(convs.join(last, "conv_id", "left").select(F.coalesce("last.k1", zero).alias("k1"), F.coalesce("last.k2", zero).alias("k2"), "conv_id"))
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(sums, KEY, "left").join(ends, KEY, "left").join(parents, PARENT, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", zero).alias("n_leaves"),
                      F.coalesce("saved_tokens", zero).alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
