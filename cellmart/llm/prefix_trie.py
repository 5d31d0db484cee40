"""Shared prefixes of conversations as a z-fast trie.

A conversation is a sequence of turns (role, text); conversations that begin alike share the nodes
of a trie. The trie is kept compacted, as a table with one row per branching or ending node: an
edge with its depths ``(above, depth]``, a conversation that runs along it (``rep``), and a handle, the
prefix at the two-fattest depth of that interval (the depth with most trailing zero bits).

1. ``sequences``: turns get their places by a global sort (range partitions, so one conversation
   may span many tasks) and every prefix gets two 64-bit hashes, the exclusive or of its turns'
   hashes by place. Running values are taken in chunks of ``CHUNK`` turns and added up chunk by chunk.
2. Equal sequences are one path; the smallest conversation stands for it.
3. ``ZFastTrie.insert`` adds the paths batch by batch. A path finds its exit node by fat binary search:
   each round probes the handle at the two-fattest depth of the open interval, for all paths of
   the batch at once, so the rounds are the logarithm of the longest path. Exit edges are split
   where paths leave them; what hangs below is compacted by grouping the new prefixes by hash.
4. Totals over subtrees run over the compacted nodes by pointer doubling (a node adds its sum to
   its ancestor 1, 2, 4, ... levels up), then edges are expanded to one row per depth.
5. The ids that end in a node are hashed as a stream of sorted pieces of ``PIECE`` consecutive ids.

Nothing that grows with the input is broadcast, collected or held by one task: a turn or a whole
conversation that a third of all rows share is one path after step 2, its ids meet in pieces, and
a conversation with a third of all turns is cut in chunks. Two different prefixes of one depth
are taken for one with a probability of 2**-128 a pair.

Defined results: turns are ordered by turn (null first), equal ones by role and text; a null role or
text is empty; repeated rows are turns of their own. Rows without a conversation id belong to no
conversation. An empty table has no node, not even a root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import written

CHUNK = 1024
PIECE = 512
#: Sixteenths of the paths in each batch.
BATCHES = (1, 15)
WORD = r"[^\x20\x09-\x0D]+"
KEY = ["depth", "p1", "p2"]


def turn_places(conversations: DataFrame) -> DataFrame:
    """Per turn: conv_id, pos (from 0), t1 and t2 (hashes of role and text), words of the text."""
    own = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("tie"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("tie")]
    rows = written(own.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("seq"),
        F.xxhash64("role", "text").alias("t1"), F.xxhash64("text", F.lit("|"), "role").alias("t2"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words")), "trie-turns")
    place = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("seq")).cast("long") - 1
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("conv_id", "part").count().withColumn("before", F.sum("count").over(before)).where("before > 0")
    placed = rows.withColumn("pos", place).join(offsets.drop("count"), ["conv_id", "part"], "left")
    return placed.select("conv_id", (F.col("pos") + F.coalesce("before", F.lit(0))).alias("pos"), "t1", "t2", "words")


def rebuild(turns: DataFrame, family: int = 20, heads: int = 4) -> DataFrame:
    """Conversations that begin with turns of their family's first one. The first ``h`` turns of a
    conversation give way to the first ``h`` of conversation ``c - c % family`` (all that it has, none
    if it is absent; ``%`` as in SQL, towards zero), with ``h`` the CRC-32 of the decimal id modulo ``heads``. Per turn: conv_id, depth
    (from 1), t1, t2, words; and a row of depth 0 for every conversation."""
    turns = written(turns, "trie-places")
    base = F.col("conv_id") - F.col("conv_id") % family
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    first = turns.where((F.col("pos") < heads - 1) & (base == F.col("conv_id")))
    lengths = first.groupBy(F.col("conv_id").alias("base")).agg(F.count("*").alias("have"))
    ids = written(turns.select("conv_id").distinct().withColumn("base", base).withColumn("h", h), "trie-ids")
    head = ids.join(first.withColumnRenamed("conv_id", "base"), "base").where("pos < h").select(
        "conv_id", (F.col("pos") + 1).alias("depth"), "t1", "t2", "words")
    tail = turns.withColumn("base", base).withColumn("h", h).where("pos >= h").join(lengths, "base", "left")
    taken = F.least("h", F.coalesce("have", F.lit(0)))
    tail = tail.select("conv_id", (taken + F.col("pos") - F.col("h") + 1).alias("depth"), "t1", "t2", "words")
    zero = F.lit(0).cast("long")
    root = ids.select("conv_id", zero.alias("depth"), zero.alias("t1"), zero.alias("t2"), zero.alias("words"))
    return head.unionByName(tail).unionByName(root)


def sequences(turns: DataFrame) -> DataFrame:
    """Per prefix of a conversation: conv_id, depth, p1, p2 (hashes of the prefix), total (words so
    far), words (of its last turn)."""
    none = F.lit(0).cast("long")
    rows = turns.select("conv_id", "depth", F.floor(F.col("depth") / CHUNK).cast("long").alias("chunk"), "words",
                        F.when(F.col("depth") > 0, F.xxhash64("depth", "t1", "t2")).otherwise(none).alias("e1"),
                        F.when(F.col("depth") > 0, F.xxhash64("t2", "t1", "depth")).otherwise(none).alias("e2"))
    rows = written(rows, "trie-elements")
    ends = [("p1", F.bit_xor, "e1"), ("p2", F.bit_xor, "e2"), ("total", F.sum, "words")]
    inside = Window.partitionBy("conv_id", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    long = rows.where("chunk > 0").select("conv_id").distinct()
    chunks = rows.join(long, "conv_id", "left_semi").groupBy("conv_id", "chunk").agg(*[f(c).alias(n) for n, f, c in ends])
    chunks = chunks.select("conv_id", "chunk", *[f(n).over(before).alias(f"b_{n}") for n, f, _ in ends]).where("chunk > 0")
    run = rows.select("conv_id", "chunk", "depth", "words", *[f(c).over(inside).alias(n) for n, f, c in ends])
    run = run.join(chunks, ["conv_id", "chunk"], "left")
    earlier = {n: F.coalesce(f"b_{n}", none) for n, _, _ in ends}
    return run.select("conv_id", "depth", F.col("p1").bitwiseXOR(earlier["p1"]).alias("p1"),
                      F.col("p2").bitwiseXOR(earlier["p2"]).alias("p2"), (F.col("total") + earlier["total"]).alias("total"), "words")


def two_fattest(a: Column, b: Column) -> Column:
    """The number with most trailing zero bits in ``(a, b]``."""
    top = F.length(F.bin(a.bitwiseXOR(b))) - 1
    return b.bitwiseAND(F.call_function("shiftleft", F.lit(-1).cast("long"), top))


class ZFastTrie:
    """The written tables of one trie. ``steps`` has the prefixes of all paths: rep, depth, p1, p2,
    total, words. ``nodes``: rep, above, depth, p1, p2 of the compacted nodes; ``handles``: the same with the
    handle (hd, h1, h2) and the first prefix of the edge (f1, f2)."""

    def __init__(self, steps: DataFrame):
        self.steps = steps
        root = steps.where("depth = 0").agg(F.min("rep").alias("rep")).where("rep IS NOT NULL")
        zero = F.lit(0).cast("long")
        self._store(root.select("rep", F.lit(-1).cast("long").alias("above"), zero.alias("depth"), zero.alias("p1"), zero.alias("p2")))
        self.empty = True

    def at(self, rows: DataFrame, rep: str, depth: Column, **names: str) -> DataFrame:
        """``rows`` with columns of the prefix of path ``rep`` at ``depth``; null where the path is shorter."""
        found = self.steps.select(F.col("rep").alias("__rep"), F.col("depth").alias("__depth"),
                                  *[F.col(c).alias(n) for n, c in names.items()])
        return rows.withColumn("__at", depth).join(
            found, (F.col(rep) == F.col("__rep")) & (F.col("__at") == F.col("__depth")), "left").drop("__at", "__rep", "__depth")

    def _store(self, nodes: DataFrame) -> None:
        self.nodes = written(nodes, "trie-nodes")
        rows = self.nodes.where("depth > 0").withColumn("hd", two_fattest(F.col("above"), F.col("depth")))
        rows = self.at(rows, "rep", F.col("hd"), h1="p1", h2="p2")
        self.handles = written(self.at(rows, "rep", F.col("above") + 1, f1="p1", f2="p2"), "trie-handles")

    def locate(self, paths: DataFrame) -> DataFrame:
        """Per path (rep, len): ``a``, the depth of the deepest compacted node that it runs through, the
        edge below by which it leaves (``edge_rep``, ``edge_end``, null if none), and ``m``, the depth where it
        leaves the trie."""
        handles = self.handles.select("hd", "h1", "h2", F.col("above").alias("z_above"), F.col("depth").alias("z_depth"),
                                      F.col("p1").alias("z1"), F.col("p2").alias("z2"))
        state = paths.select("rep", "len", F.lit(0).cast("long").alias("a"), F.col("len").alias("b"))
        done = None
        while True:
            state = written(state, "trie-search")
            ended = state.where("a >= b")
            done = ended if done is None else done.unionByName(ended)
            state = state.where("a < b")
            if state.isEmpty():
                break
            probe = self.at(state.withColumn("f", two_fattest(F.col("a"), F.col("b"))), "rep", F.col("f"), q1="p1", q2="p2")
            hit = probe.join(handles, (F.col("f") == F.col("hd")) & (F.col("q1") == F.col("h1")) & (F.col("q2") == F.col("h2")), "left")
            hit = self.at(hit, "rep", F.col("z_depth"), e1="p1", e2="p2")
            through = F.coalesce((F.col("e1") == F.col("z1")) & (F.col("e2") == F.col("z2")), F.lit(False))
            # A handle that fits: the search goes on below its node, or the path leaves on its edge.
            a = F.when(F.col("z_depth").isNull(), F.col("a")).when(through, F.col("z_depth")).otherwise(F.col("z_above"))
            b = F.when(F.col("z_depth").isNull(), F.col("f") - 1).when(through, F.col("b")).otherwise(F.col("z_above"))
            state = hit.select("rep", "len", a.alias("a"), b.alias("b"))
        rows = self.at(done.drop("b"), "rep", F.col("a") + 1, q1="p1", q2="p2")
        edges = self.handles.select((F.col("above") + 1).alias("fd"), "f1", "f2", F.col("rep").alias("edge_rep"), F.col("depth").alias("edge_end"))
        rows = rows.join(edges, (F.col("a") + 1 == F.col("fd")) & (F.col("q1") == F.col("f1")) & (F.col("q2") == F.col("f2")), "left")
        rows = written(rows.select("rep", "len", "a", "edge_rep", "edge_end"), "trie-exits")
        along = rows.where("edge_rep IS NOT NULL").select(
            "rep", "edge_rep", F.explode(F.sequence(F.col("a") + 1, F.least("len", "edge_end"))).alias("depth"))
        along = self.at(self.at(along, "rep", F.col("depth"), q1="p1", q2="p2"), "edge_rep", F.col("depth"), e1="p1", e2="p2")
        common = along.where("q1 = e1 AND q2 = e2").groupBy("rep").agg(F.max("depth").alias("common"))
        return rows.join(common, "rep", "left").select("rep", "len", "a", "edge_rep", "edge_end", F.coalesce("common", "a").alias("m"))

    def insert(self, paths: DataFrame) -> None:
        """Add paths (rep, len) that the trie does not hold yet."""
        if self.empty:
            none = F.lit(None).cast("long")
            zero = F.lit(0).cast("long")
            exits = paths.select("rep", "len", zero.alias("a"), none.alias("edge_rep"), none.alias("edge_end"), zero.alias("m"))
        else:
            exits = written(self.locate(paths), "trie-located")
        # Edges are cut where paths leave or end inside them.
        cuts = exits.where("m > a AND m < edge_end").select(F.col("edge_rep").alias("rep"), F.col("edge_end").alias("end"), F.col("m").alias("depth")).distinct()
        cuts = self.at(cuts, "rep", F.col("depth"), p1="p1", p2="p2")
        whole = self.nodes.withColumn("end", F.col("depth"))
        points = whole.unionByName(cuts.withColumn("above", F.lit(None).cast("long")).select(*whole.columns))
        edge = Window.partitionBy("rep", "end").orderBy("depth")
        start = F.max("above").over(Window.partitionBy("rep", "end"))
        old = points.withColumn("above", F.coalesce(F.lag("depth").over(edge), start)).drop("end")
        # Prefixes below the exits: new nodes, compacted where they branch or end.
        tails = self.steps.join(exits.where("len > m").select("rep", "len", "m"), "rep").where("depth >= m")
        before = Window.partitionBy("rep").orderBy("depth")
        tails = tails.select("rep", "m", *KEY, (F.col("depth") == F.col("len")).alias("end"),
                             *[F.lag(c).over(before).alias(f"u{c[1]}") for c in ("p1", "p2")]).where("depth > m")
        tails = written(tails, "trie-tails")
        new = written(tails.groupBy(*KEY, "u1", "u2").agg(F.min("rep").alias("rep"), F.max("end").alias("end")), "trie-new")
        kids = new.groupBy((F.col("depth") - 1).alias("depth"), F.col("u1").alias("p1"), F.col("u2").alias("p2")).agg(F.count("*").alias("kids"))
        kept = written(new.join(kids.where("kids > 1"), KEY, "left").where("end OR kids IS NOT NULL").select(*KEY, F.col("rep").alias("owner")), "trie-kept")
        on_path = tails.join(kept, KEY).select("rep", "m", "owner", *KEY)
        on_path = on_path.withColumn("above", F.coalesce(F.lag("depth").over(before), "m"))
        fresh = on_path.where("rep = owner").select("rep", "above", *KEY)
        self._store(old.select("rep", "above", *KEY).unionByName(fresh))
        self.empty = False


def _add_up(nodes: DataFrame, sums: list[str], least: str | None = None) -> DataFrame:
    """Totals over subtrees: nodes have id, up (parent id, null for the root) and the named columns."""
    values = [*sums, *([least] if least else [])]
    state = written(nodes.select("id", "up", *values), "trie-sums")
    while not state.where("up IS NOT NULL").isEmpty():
        more = state.where("up IS NOT NULL").groupBy(F.col("up").alias("id")).agg(
            *[F.sum(c).alias(f"m_{c}") for c in sums], *([F.min(least).alias(f"m_{least}")] if least else []))
        jump = state.where("up IS NOT NULL").select(F.col("id").alias("up"), F.col("up").alias("next"))
        state = state.join(more, "id", "left").join(jump, "up", "left")
        state = written(state.select(
            "id", F.col("next").alias("up"), *[(F.col(c) + F.coalesce(f"m_{c}", F.lit(0))).alias(c) for c in sums],
            *([F.least(least, f"m_{least}").alias(least)] if least else [])), "trie-sums")
    return state.drop("up")


def _digests(batches):
    """SHA-256 of the ids of each node, from its sorted pieces, one after the other."""
    key = digest = None

    def row(key, digest):
        cols = [pa.array([v], pa.int64()) for v in key] + [pa.array([digest.hexdigest()], pa.string())]
        return pa.RecordBatch.from_arrays(cols, [*KEY, "ends_sha256"])

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for *now, text in zip(*columns):
            if now != key:
                if key is not None:
                    yield row(key, digest)
                key, digest = now, hashlib.sha256(text.encode())
            else:
                digest.update(b"," + text.encode())
    if key is not None:
        yield row(key, digest)


def end_digests(ends: DataFrame) -> DataFrame:
    """Per node in which conversations end: depth, p1, p2, ends_sha256 (of their decimal ids, rising,
    joined by commas)."""
    pieces = ends.groupBy(*KEY, F.floor(F.col("conv_id") / PIECE).alias("piece")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    texts = pieces.select(*KEY, "piece", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("text"))
    texts = written(texts, "trie-ends").repartition(*KEY).sortWithinPartitions(*KEY, "piece")
    return texts.select(*KEY, "text").mapInArrow(_digests, "depth long, p1 long, p2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """All nodes of the trie of the sequences in ``turns`` (conv_id, depth from 1, t1, t2, words; depth 0
    for each conversation). Per node: conv_id (the smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256, and rep, a conversation that holds the prefix.
    """
    prefixes = written(sequences(turns), "trie-prefixes")
    ends = prefixes.groupBy("conv_id").agg(F.max(F.struct("depth", "p1", "p2")).alias("e")).select("conv_id", "e.*")
    ends = written(ends, "trie-whole")
    paths = written(ends.groupBy(*KEY).agg(F.min("conv_id").alias("rep"), F.count("*").alias("copies")), "trie-paths")
    steps = written(prefixes.withColumnRenamed("conv_id", "rep").join(paths.select("rep"), "rep", "left_semi"), "trie-steps")
    trie = ZFastTrie(steps)
    share, low = F.pmod(F.xxhash64("p1", "p2"), F.lit(sum(BATCHES))), 0
    for size in BATCHES:
        trie.insert(paths.where((share >= low) & (share < low + size) & (F.col("depth") > 0)).select("rep", F.col("depth").alias("len")))
        low += size
    return _expanded(trie, paths, end_digests(ends))


def _expanded(trie: ZFastTrie, paths: DataFrame, digests: DataFrame) -> DataFrame:
    nodes = written(trie.nodes.withColumn("id", F.monotonically_increasing_id()), "trie-numbered")
    nodes = trie.at(nodes, "rep", F.col("depth"), total="total")
    nodes = trie.at(nodes, "rep", F.col("above"), u1="p1", u2="p2", upper="total")
    nodes = written(nodes, "trie-totals")
    parents = nodes.select(F.col("id").alias("up"), F.col("depth").alias("above"), F.col("p1").alias("u1"), F.col("p2").alias("u2"))
    nodes = nodes.join(parents, ["above", "u1", "u2"], "left")
    nodes = nodes.join(paths.select(*KEY, F.col("rep").alias("first"), "copies"), KEY, "left")
    nodes = written(nodes.join(digests, KEY, "left"), "trie-linked")
    kids = nodes.where("up IS NOT NULL").groupBy(F.col("up").alias("id")).agg(F.count("*").alias("kids"))
    nodes = written(nodes.join(kids, "id", "left").fillna(0, ["kids", "copies", "upper"]), "trie-kids")
    sizes = _add_up(nodes.select("id", "up", F.col("copies").alias("n"), (F.col("kids") == 0).cast("long").alias("leaves"),
                                 F.col("first").alias("least")), ["n", "leaves"], "least")
    nodes = written(nodes.join(sizes, "id").withColumn("worth", (F.col("n") - 1) * (F.col("total") - F.col("upper"))), "trie-sizes")
    nodes = nodes.join(_add_up(nodes.select("id", "up", F.col("worth").alias("saved")), ["saved"]), "id")
    nodes = nodes.join(sizes.select(F.col("id").alias("up"), F.col("least").alias("over")), "up", "left")
    edges = written(nodes.select(
        "rep", "above", F.col("depth").alias("end"), "total", "n", "leaves", "least", "over", "kids", "ends_sha256",
        (F.col("saved") - F.col("worth")).alias("below"),
        F.explode(F.sequence(F.col("above") + 1, "depth")).alias("depth")), "trie-edges")
    rows = trie.at(edges, "rep", F.col("depth"), so_far="total", words="words")
    last = F.col("depth") == F.col("end")
    return rows.select(
        F.col("least").alias("conv_id"), "depth",
        F.when(F.col("depth") > 0, F.when(F.col("depth") == F.col("above") + 1, F.col("over")).otherwise(F.col("least"))).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(last, F.col("kids")).otherwise(F.lit(1).cast("long")).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        ((F.col("n") - 1) * (F.col("total") - F.col("so_far") + F.col("words")) + F.col("below")).alias("saved_tokens"),
        F.when(last & F.col("ends_sha256").isNotNull(), F.col("ends_sha256")).otherwise(F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
        "rep")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return prefix_trie(rebuild(turn_places(conversations)))
