"""Trie of conversation prefixes; subtree figures by the Euler-tour technique.

A prefix is named by the exclusive-or of its turns' hashes, each salted with its depth, so
prefixes are running aggregates and no task ever holds a whole conversation. Every node gets an
enter and an exit arc; the tour through all arcs is a linked list, ranked by contracting
the stretches inside blocks of nodes and doubling pointers over what is left. Leaves and
savings of a subtree are differences of prefix sums at a node's two arcs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskmill.functions.durable import small_table
from riskmill.llm.common import MAX_SMALL_ROWS, join_sized, materialize, plain, running_start

WORD = r"[^\x20\x09-\x0D]+"
#: A conversation begins with up to ``MOST_SHARED`` turns of the first of its block of so many ids.
BLOCK_OF_IDS, MOST_SHARED = 20, 3
#: Nodes whose arcs are contracted at once, and conv_ids joined to one text at once.
BLOCK, IDS = 1 << 16, 1 << 12
KEY = ["d", "k1", "k2"]


def in_order(rows: DataFrame, order: list, name: str) -> DataFrame:
    """``rows`` written in a global order, with ``at`` (increasing) and ``range`` (number of the sorted range)."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    return materialize(ranged.withColumn("range", F.shiftright("at", 33).cast("int")), name)


def carried(rows: DataFrame, key: str, **totals: tuple) -> DataFrame:
    """(range, key, totals of the key's rows in earlier ranges) for keys in more than one range of ``in_order`` rows.

    ``rows`` are sorted by ``key`` first, so a range shares at most two keys with others: the result has
    at most two rows per range and is broadcast. ``totals``: name=(aggregate, column).
    """
    ends = rows.groupBy("range").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    ends = ends.select(F.explode(F.array_distinct(F.array("low", "high"))).alias(key)).groupBy(key).agg(F.count("*").alias("n"))
    crossing = small_table(ends.filter("n > 1").select(key), MAX_SMALL_ROWS, "ranges")
    parts = rows.join(crossing, key).groupBy(key, "range").agg(*(f(c).alias(name) for name, (f, c) in totals.items()))
    before = Window.partitionBy(key).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    again = {"n": F.sum}
    sums = [F.coalesce(again.get(name, F.bit_xor)(name).over(before), F.lit(0)).alias(name) for name in totals]
    return small_table(parts.select("range", key, *sums), MAX_SMALL_ROWS, "ranges")


def numbered(rows: DataFrame, key: str, name: str) -> DataFrame:
    """``in_order`` rows with their number, from 1, among the rows of their key."""
    before = carried(rows, key, n=(F.count, "at"))
    local = F.row_number().over(Window.partitionBy("range", key).orderBy("at"))
    return rows.withColumn("local", local).join(before, ["range", key], "left").withColumn(name, F.col("local") + F.coalesce("n", F.lit(0))).drop("local", "n")


def shared_turns(conv: Column) -> Column:
    """How many turns a conversation takes over: unsigned crc32 of the decimal id, modulo four."""
    return F.crc32(conv.cast("string").cast("binary")) % (MOST_SHARED + 1)


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv, d, k1, k2, x1, x2, words) of every rebuilt turn, (conv, h) of every conversation).

    Turns are ordered by turn (null first), then by the MD5 of role and text. Null roles and texts are
    empty; rows without conv_id belong to no conversation. ``x`` are the hashes of the turn at its depth
    ``d``, ``k`` their exclusive-or up to it.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = plain(rows, "conv_id", "turn", "role", "text").filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn",
        F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("tie"),
    )
    turns = in_order(turns, ["conv", F.col("turn").asc_nulls_first(), "digest", "tie"], "turns")
    own = materialize(numbered(turns, "conv", "i").select("conv", "i", "digest", "words"), "own-turns")
    convs = materialize(own.filter("i = 1").select("conv", shared_turns(F.col("conv")).alias("h")), "conversations")
    first = own.filter((F.col("conv") % BLOCK_OF_IDS == 0) & (F.col("i") <= MOST_SHARED))
    first = first.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("i", "digest", "words"))).alias("head"))
    taken = convs.filter("h > 0").withColumn("base", F.col("conv") - F.col("conv") % BLOCK_OF_IDS)
    taken = taken.join(first.withColumnRenamed("conv", "base"), "base").select("conv", F.explode(F.slice("head", F.lit(1), F.col("h").cast("int"))).alias("t"))
    kept = own.filter(F.col("i") > shared_turns(F.col("conv")))
    both = taken.select("conv", F.lit(0).alias("part"), "t.*").union(kept.select("conv", F.lit(1), "i", "digest", "words"))
    placed = numbered(in_order(both, ["conv", "part", "i"], "rebuilt"), "conv", "d")
    placed = materialize(placed.select("conv", "d", "words", "range", "at", F.xxhash64("d", "digest").alias("x1"), F.xxhash64("digest", F.lit(7), "d").alias("x2")), "placed")
    before = carried(placed, "conv", c1=(F.bit_xor, "x1"), c2=(F.bit_xor, "x2"))
    upto = Window.partitionBy("range", "conv").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    paths = placed.withColumns({"l1": F.bit_xor("x1").over(upto), "l2": F.bit_xor("x2").over(upto)}).join(before, ["range", "conv"], "left")
    key = lambda i: F.col(f"l{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0))).alias(f"k{i}")
    return materialize(paths.select("conv", "d", key(1), key(2), "x1", "x2", "words"), "paths"), convs


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's texts joined by commas, from rows sorted by node and place; only a running digest is held."""
    names, node, running = [*KEY, "ends"], None, None
    for batch in batches:
        done = []
        for *key, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
            if key == node:
                running.update(b"," + text.encode())
                continue
            if node:
                done.append((*node, running.hexdigest()))
            node, running = key, hashlib.sha256(text.encode())
        if done:
            yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*done)))))
    if node:
        yield pa.RecordBatch.from_pydict({n: [v] for n, v in zip(names, (*node, running.hexdigest()))})


def ending(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """(d, k1, k2, ends): digest of the conv_ids that end at a node, for nodes where any does.

    Ids are joined to texts of up to ``IDS`` ids where they lie, so even a node at which a third of all
    conversations end hands few rows to the task of its digest.
    """
    last = paths.groupBy("conv").agg(F.max(F.struct(*KEY)).alias("last"))
    at = [F.coalesce(F.col("last")[k], F.lit(0)).alias(k) for k in KEY]
    rows = in_order(convs.join(last, "conv", "left").select("conv", *at), [*KEY, "conv"], "ends")
    texts = rows.groupBy(*KEY, F.floor(F.col("at") / IDS).alias("place")).agg(F.array_join(F.array_sort(F.collect_list("conv")), ",").alias("ids"))
    sorted_texts = texts.repartition(*KEY).sortWithinPartitions(*KEY, "place")
    return sorted_texts.mapInArrow(_digests, "d bigint, k1 bigint, k2 bigint, ends string")


def _with_next_sibling(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``next``: conv of the next child of the same parent, by conv; families may span ranges."""
    rows = in_order(nodes, ["d", "parent", "conv"], "siblings")
    node = F.struct("d", "parent", "conv")
    firsts = rows.groupBy("range").agg(F.min_by(node, "at").alias("first"))
    # one row per range
    after = small_table(firsts.select("range", F.lead("first").over(Window.orderBy("range")).alias("after")), MAX_SMALL_ROWS, "ranges")
    rows = rows.join(after, "range", "left").withColumn("after", F.coalesce(F.lead(node).over(Window.partitionBy("range").orderBy("at")), "after"))
    same = (F.col("after.d") == F.col("d")) & (F.col("after.parent") == F.col("parent"))
    return rows.withColumn("next", F.when(same, F.col("after.conv"))).drop("after", "range", "at")


def contract(conv: np.ndarray, d: np.ndarray, following: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(head, offset, is_tail) of the arcs of a block of nodes; arc 2i enters node i, arc 2i + 1 leaves it.

    ``following`` (arcs, 2) holds the next arc as (conv, 2 * depth + side), side one for exit, or conv -1
    past the end. A stretch of arcs inside the block is named by its first arc, its head.
    """
    names, at = np.unique(conv, return_inverse=True)
    span = int(max(d.max(), (following[:, 1] >> 1).max())) + 1
    keys = at * span + d
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    place = np.minimum(np.searchsorted(names, following[:, 0]), len(names) - 1)
    wanted = place * span + (following[:, 1] >> 1)
    found = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    inside = (names[place] == following[:, 0]) & (keys[found] == wanted) & (following[:, 1] >= 0)
    target = 2 * order[found] + (following[:, 1] & 1)
    head = np.arange(2 * len(conv))
    head[target[inside]] = np.flatnonzero(inside)
    offset = (head != np.arange(len(head))).astype(np.int64)
    while True:
        further = head[head]
        if (further == head).all():
            return head, offset, ~inside
        offset, head = offset + offset[head], further


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For blocks of nodes (conv, d, enter_conv, enter_ds, exit_conv, exit_ds): every arc with its stretch."""
    names = ["conv", "d", "side", "head_conv", "head_ds", "offset", "tail", "next_conv", "next_ds"]

    def block(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        conv, d = (table.column(c).to_numpy() for c in ("conv", "d"))
        following = np.stack([table.column(c).to_numpy() for c in ("enter_conv", "enter_ds", "exit_conv", "exit_ds")], axis=1).reshape(-1, 2)
        head, offset, tail = contract(conv, d, following)
        own, side = np.repeat(np.arange(len(conv)), 2), np.tile([0, 1], len(conv))
        columns = [conv[own], d[own], side, conv[head >> 1], 2 * d[head >> 1] + (head & 1), offset, tail, following[:, 0], following[:, 1]]
        yield from pa.table([pa.array(c) for c in columns], names=names).to_batches(max_chunksize=10_000)

    held, rows = [], 0
    for batch in batches:
        if rows and rows + batch.num_rows > BLOCK:
            yield from block(held)
            held, rows = [], 0
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
    if rows:
        yield from block(held)


def list_ranks(stretches: DataFrame) -> DataFrame:
    """(conv, ds, behind): arcs from each stretch's head to the end of the list, itself included.

    ``stretches`` (conv, ds, next_conv, next_ds, behind) link to the next stretch's head, next_ds -1 at the end;
    ``behind`` is a stretch's own length at first. Every round doubles the reach of all links.
    Links lead to different heads, so no key of a round's join repeats.
    """
    while True:
        stretches = materialize(stretches, "ranks")
        open_ends = stretches.filter("next_ds >= 0")
        if open_ends.isEmpty():
            return stretches.select("conv", "ds", "behind")
        to = stretches.toDF("next_conv", "next_ds", "then_conv", "then_ds", "more")
        step = open_ends.join(to, ["next_conv", "next_ds"])
        step = step.select("conv", "ds", F.col("then_conv").alias("next_conv"), F.col("then_ds").alias("next_ds"), (F.col("behind") + F.col("more")).alias("behind"))
        stretches = stretches.filter("next_ds < 0").unionByName(step)


def subtree_sums(tree: DataFrame, values: list[str]) -> DataFrame:
    """(conv, d, sums of ``values`` over the subtree of every node, itself included).

    ``tree`` is a written table of one tree, nodes (conv, d): depth d, conv unique at a depth, ``parent`` the conv of the parent (null: root),
    ``first`` the conv of the first child, ``next`` of the next sibling (null: none).
    """
    at = lambda conv, ds: (conv.cast("long"), ds.cast("long"))
    d, side = F.col("d"), 1
    enter = [F.when(F.col("first").isNotNull(), a).otherwise(b) for a, b in zip(at(F.col("first"), 2 * (d + 1)), at(F.col("conv"), 2 * d + side))]
    leave = [F.when(F.col("next").isNotNull(), a).when(F.col("parent").isNotNull(), b).otherwise(-1)
             for a, b in zip(at(F.col("next"), 2 * d), at(F.col("parent"), 2 * (d - 1) + side))]
    linked = tree.select("conv", "d", enter[0].alias("enter_conv"), enter[1].alias("enter_ds"), leave[0].alias("exit_conv"), leave[1].alias("exit_ds"))
    ranged = linked.repartitionByRange("conv", "d").sortWithinPartitions("conv", "d")
    arcs = materialize(ranged.mapInArrow(
        _stretches, "conv bigint, d bigint, side bigint, head_conv bigint, head_ds bigint, offset bigint, tail boolean, next_conv bigint, next_ds bigint"
    ), "arcs")
    tails = arcs.filter("tail").select(F.col("head_conv").alias("conv"), F.col("head_ds").alias("ds"), "next_conv", "next_ds", (F.col("offset") + 1).alias("behind"))
    ranks = list_ranks(tails).withColumnsRenamed({"conv": "head_conv", "ds": "head_ds"})
    total = arcs.count()
    weights = tree.select("conv", "d", *values)
    toured = arcs.join(ranks, ["head_conv", "head_ds"]).select("conv", "d", "side", (total - F.col("behind") + F.col("offset")).alias("place"))
    toured = toured.join(weights, ["conv", "d"]).withColumn("chunk", F.floor(F.col("place") / max(BLOCK, -(-total // BLOCK))))
    toured = materialize(toured.withColumns({v: F.when(F.col("side") == 0, F.col(v)).otherwise(0) for v in values}), "tour")
    starts = toured.groupBy("chunk").agg(*(F.sum(v).alias(v) for v in values))
    for v in values:
        starts = running_start(starts, ["chunk"], v, f"start_{v}")
    starts = small_table(starts.drop(*values), MAX_SMALL_ROWS, "chunks")
    before = Window.partitionBy("chunk").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    upto = toured.join(starts, "chunk").withColumns({f"upto_{v}": F.col(f"start_{v}") + F.sum(v).over(before) for v in values})
    ends = lambda v: F.sum(F.when(F.col("side") == 1, F.col(f"upto_{v}")).otherwise(F.col(v) - F.col(f"upto_{v}"))).cast("long").alias(v)
    return upto.groupBy("conv", "d").agg(*(ends(v) for v in values))


def prefix_trie(rows: DataFrame) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations of ``rows`` (conv_id, turn, role, text).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), see ``rebuilt`` for the order
    of turns, nulls and ties. Repeated rows are turns of their own. Conversations without rebuilt turns end at the root.
    An empty table gives an empty table. Other columns take no part.
    """
    paths, convs = rebuilt(rows)
    nodes = paths.groupBy(*KEY).agg(F.min("conv").alias("conv"), F.count("*").alias("n"), F.min("words").alias("words"),
                                    *(F.min(x).alias(x) for x in ("x1", "x2")))
    zero = [F.lit(0).cast("long").alias(c) for c in ("words", "x1", "x2")]
    root = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n")).filter("n > 0")
    nodes = nodes.unionByName(root.select(*(F.lit(0).cast("long").alias(k) for k in KEY), "conv", "n", *zero))
    up = {"up_d": F.col("d") - 1, "up_k1": F.col("k1").bitwiseXOR(F.col("x1")), "up_k2": F.col("k2").bitwiseXOR(F.col("x2"))}
    nodes = materialize(nodes.withColumns(up).drop("x1", "x2"), "nodes")
    families = nodes.filter("d > 0").groupBy(*up).agg(F.count("*").alias("n_children"), F.min("conv").alias("first"))
    nodes = nodes.join(families.toDF(*KEY, "n_children", "first"), KEY, "left").join(ending(paths, convs), KEY, "left")
    nodes = materialize(nodes.fillna(0, ["n_children"]).fillna(hashlib.sha256(b"").hexdigest(), ["ends"]), "nodes")
    parents = nodes.filter("n_children > 0").select(*(F.col(k).alias(f"up_{k}") for k in KEY), F.col("conv").alias("parent"), F.col("n_children").alias("size"))
    tree = join_sized(nodes, parents, list(up), "size").select(
        "conv", "d", "parent", "n", "n_children", "first", "ends", (F.col("n_children") == 0).cast("long").alias("leaves"),
        ((F.col("n") - 1) * F.col("words")).alias("saved"))
    tree = materialize(_with_next_sibling(tree), "tree")
    sums = subtree_sums(tree, ["leaves", "saved"])
    return tree.drop("leaves", "saved").join(sums, ["conv", "d"]).select(
        F.col("conv").alias("conv_id"), F.col("d").alias("depth"), F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


def trie_sql() -> str:
    """The same rows for DuckDB, by joining every node with the path of its smallest member."""
    digest = "md5(length(role) || ':' || role || text)"
    crc = """xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
        lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295::bigint)"""
    return f"""
    with t as (select conv_id, row_number() over (partition by conv_id order by turn nulls first, {digest}) as i, {digest} as m,
        len(regexp_extract_all(text, '{WORD}')) as w
      from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null)),
    c as (select conv_id, {crc} % {MOST_SHARED + 1} as h, conv_id - conv_id % {BLOCK_OF_IDS} as base, n
      from (select distinct conv_id from t) left join (select conv_id as base, count(*) as n from t group by all) b on b.base = conv_id - conv_id % {BLOCK_OF_IDS}),
    r as (select c.conv_id, t.i as d, m, w from c join t on t.conv_id = c.base and t.i <= h
      union all select c.conv_id, t.i - h + least(h, coalesce(n, 0)), m, w from c join t on t.conv_id = c.conv_id and t.i > h),
    p as (select conv_id, d, w, md5(string_agg(m, ',') over (partition by conv_id order by d)) as k,
        coalesce(md5(string_agg(m, ',') over (partition by conv_id order by d rows between unbounded preceding and 1 preceding)), '') as up from r
      union all select conv_id, 0, 0, '', null from c),
    n as (select d, k, min(conv_id) as conv_id, count(*) as n, min(w) as w, min(up) as up from p group by d, k),
    f as (select d - 1 as d, up as k, count(*) as n_children from n where d > 0 group by all),
    e as (select d, k, string_agg(conv_id::varchar, ',' order by conv_id) as ids
      from (select conv_id, max(d) as d from p group by conv_id) join p using (conv_id, d) group by d, k),
    s as (select p.d, p.k, count(*) filter (f.k is null) as n_leaves, sum((n.n - 1) * n.w) as saved
      from n left join f using (d, k) join p on p.conv_id = n.conv_id and p.d <= n.d group by p.d, p.k)
    select n.conv_id, n.d as depth, u.conv_id as parent_conv_id, n.n as n_convs, coalesce(n_children, 0) as n_children, n_leaves,
      saved::bigint as saved_tokens, sha256(coalesce(ids, '')) as ends_sha256
    from n left join f using (d, k) left join e using (d, k) join s using (d, k) left join n u on u.d = n.d - 1 and u.k = n.up"""
