"""Prefix trie of conversations (operator 13).

Conversations are sorted by their sequences of turns. The length of the prefix that two sorted neighbours
share (LCP) is an edge between them; a union-find takes the edges in descending depth, and every merge of
components makes a branching node, whose sums are those of its parts. Each partition builds its forest alone.
Nodes that go on in a neighbouring partition, prefixes of what meets at the boundary, are left as partial sums
by depth, and one aggregation merges them by the prefix they stand for.

Sums belong to an edge of the compressed trie, a node with the unbranched path above it, and are spread to
the turns of that path at the end. Sequences are sorted in blocks of ``WIDTH`` turns: conversations that
agree in a whole block and go on form a class that is sorted by the next block, so no row grows with a
conversation. Equal sequences are one element from the start.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.operators.spread import HOT_ROWS, numbered, running
from flowtables.session import cut, stored

# Turns of a conversation sorted at once, and hexadecimal digits of a hash that stand for a turn.
WIDTH = 1024
DIGITS = 32
SHARED, EVERY = 6, 100
EMPTY = hashlib.sha256(b"").hexdigest()
# A node with the unbranched path from ``lo`` (its parent's depth) down to itself at ``hi``. ``base`` is what it
# saves, but for the code points above it. ``node`` names what is merged over partitions.
EDGE = (
    "conv bigint, lo bigint, hi bigint, n bigint, total bigint, base bigint, children bigint, "
    "leaves bigint, ender bigint, parent_conv bigint, parent string, node string"
)


def original_turns(turns: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """(conv, pos, mark, chars): turns in order of ``turn`` (null first), role and text, counted from 1.

    A null role or text is empty; rows without ``conv_id`` belong to no conversation and are left out.
    """
    named = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    placed = numbered(
        named, ["conv"], ["turn", "role", "text"], "pos", hot_rows, sizes=named.select("conv")
    )
    said = F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text")
    return stored(
        placed.select(
            "conv",
            "pos",
            F.substring(F.sha2(said.cast("binary"), 256), 1, DIGITS).alias("mark"),
            F.char_length("text").cast("bigint").alias("chars"),
        ),
        "turns",
    )


def with_shared_heads(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of the first of their hundred: turns, and all ids.

    Conversation c starts with the first h turns of c - c % 100, where h = crc32(c) % 6, and goes on with its own
    turns behind its first h.
    """
    sizes = stored(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("m")), "convs")
    base = F.col("conv") - F.col("conv") % EVERY
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % SHARED
    first = sizes.select(F.col("conv").alias("base"), F.col("m").alias("base_m"))
    plan = (
        sizes.select("conv", base.alias("base"), h.alias("h"))
        .join(first, "base", "left")
        .withColumn("lent", F.least("h", F.coalesce("base_m", F.lit(0))))
        .select("conv", "base", "h", "lent")
    )
    plan = stored(plan, "plan")
    heads = turns.where(F.col("pos") < SHARED).withColumnRenamed("conv", "base")
    lent = plan.join(heads, "base").where("pos <= h").select("conv", "pos", "mark", "chars")
    own = turns.join(plan, "conv").where("pos > h")
    own = own.select("conv", (F.col("pos") - F.col("h") + F.col("lent")).alias("pos"), "mark", "chars")
    return lent.unionByName(own), plan.select("conv")


def _shared(a: str, b: str) -> int:
    """Number of turns at the start that two sequences share."""
    most, n = min(len(a), len(b)) // DIGITS, 0
    while n < most and a[n * DIGITS : (n + 1) * DIGITS] == b[n * DIGITS : (n + 1) * DIGITS]:
        n += 1
    return n


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First and last element of a partition."""
    first = last = None
    for batch in batches:
        if batch.num_rows:
            first = first or batch.slice(0, 1)
            last = batch.slice(batch.num_rows - 1)
    if first is not None:
        yield from (first, last)


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Depth at which each partition meets the one before it, from the ends of all in order."""
    rows, before = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if before and before["pid"] != row["pid"]:
                same = before["cls"] == row["cls"]
                depth = _shared(before["key"], row["key"]) if same else -1
                rows.append({"left": before["pid"], "right": row["pid"], "depth": depth})
            before = row
    kind = pa.schema([("left", pa.int32()), ("right", pa.int32()), ("depth", pa.int64())])
    yield pa.RecordBatch.from_pylist(rows, kind)


def _merged(lcp: np.ndarray, length: np.ndarray, conv: np.ndarray) -> tuple[list, np.ndarray]:
    """Union-find over the inner edges: branching nodes [depth, first, last, children, conv], and the
    parent node of every element (by its number) and node (by its number behind the elements)."""
    k = len(length)
    inner = lcp[1:k]
    order = np.argsort(-inner, kind="stable")
    order = order[inner[order] >= 1] + 1
    # components are runs of sorted neighbours, known by their ends
    first, last, top = list(range(k)), list(range(k)), list(range(k))
    depths, sizes, convs = lcp.tolist(), length.tolist(), conv.tolist()
    nodes, parent = [], [-1] * k
    for i in order.tolist():
        d, f, e = depths[i], first[i - 1], last[i]
        left, right = top[f], top[i]
        if left >= k and nodes[left - k][0] == d:
            node = nodes[left - k]
            node[3] += 1
        else:
            held = nodes[left - k][4] if left >= k else convs[left]
            node = [d, f, e, 1 + (sizes[f] > d), held]
            parent[left] = top[f] = k + len(nodes)
            nodes.append(node)
            parent.append(-1)
        node[2] = e
        node[4] = min(node[4], nodes[right - k][4] if right >= k else convs[right])
        parent[right] = top[f]
        last[f], first[e] = e, f
    return nodes, np.array(parent, np.int64)


def _forest(meets: dict[int, tuple[int, int]], offset: int) -> Callable:
    """Edges of one sorted partition; ``meets`` has the depths of its left and right boundary."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        k = table.num_rows
        cls, key = table.column("cls").to_pylist(), table.column("key").to_pylist()
        names = ("conv", "n", "total", "deep", "deep_leaves", "deep_children")
        conv, n, total, deep, deep_leaves, deep_children = (
            table.column(c).to_numpy().astype(np.int64) for c in names
        )
        ender = table.column("ender").to_pylist()
        sums = table.column("sums").combine_chunks()
        values, starts = sums.values.to_numpy(), sums.offsets.to_numpy()
        length = np.diff(starts) - 1
        lcp = np.full(k + 1, -1, np.int64)
        lcp[0], lcp[k] = meets.get(table.column("pid")[0].as_py(), (-1, -1))
        for i in range(1, k):
            if cls[i] == cls[i - 1]:
                lcp[i] = _shared(key[i - 1], key[i])
        goes_on = lcp[1:] == length
        leaves = np.where(deep_leaves > 0, deep_leaves, ~goes_on)
        # code points up to the depth shared with the element before, and to the end with what lies deeper
        above = np.where(lcp[:-1] >= 0, values[starts[:-1] + np.maximum(lcp[:-1], 0)], 0)
        below = values[starts[1:] - 1] + deep

        def running(x):
            return np.concatenate([[0], np.cumsum(x)])

        all_n, all_total, all_leaves = running(n), running(total), running(leaves)
        all_base, all_above = running(total - below), running(above)

        def name(i, depth):
            if depth == 0:
                return cls[i]
            prefix = f"{cls[i]}:{key[i][: depth * DIGITS]}"
            return hashlib.sha256(prefix.encode()).hexdigest()

        def spread(f, e, heads):
            """Sums of elements f to e; ``heads`` if f is the first of the node."""
            x = all_above[e + 1] - all_above[f + 1 if heads else f]
            return (
                int(all_n[e + 1] - all_n[f]),
                int(all_total[e + 1] - all_total[f]),
                int(all_base[e + 1] - all_base[f] + x),
                int(all_leaves[e + 1] - all_leaves[f]),
            )

        rows = []

        def add(conv, lo, hi, sums, children, ender, parent_conv, parent, node):
            n, total, base, leaves = sums
            rows.append(
                (conv, lo + offset, hi + offset, n, total, base, children, leaves, ender)
                + (parent_conv, parent, node)
            )

        def add_partial(f, e, depth, low):
            heads = lcp[f] < depth
            inner = lcp[f + heads : e + 1] == depth
            children = int(inner.sum()) + bool(heads and length[f] > depth)
            ends = ender[f] if heads and length[f] == depth else None
            parent = name(f, depth - 1) if depth else None
            add(int(low), depth - 1, depth, spread(f, e, heads), children, ends, None, parent, name(f, depth))

        left, right = int(lcp[0]), int(lcp[k])
        reach = np.minimum.accumulate(lcp[1:k]) if k > 1 else lcp[1:1]
        back = np.minimum.accumulate(lcp[1:k][::-1]) if k > 1 else lcp[1:1]
        lowest, lowest_back = np.minimum.accumulate(conv), np.minimum.accumulate(conv[::-1])
        for depth in range(1, left + 1):
            e = int((reach >= depth).sum())
            add_partial(0, e, depth, lowest[e])
        for depth in range(1, right + 1):
            behind = int((back >= depth).sum())
            if behind < k - 1 or depth > left:
                add_partial(k - 1 - behind, k - 1, depth, lowest_back[behind])
        heads = np.flatnonzero(np.concatenate([[True], lcp[1:k] < 0]))
        for f, stop in zip(heads.tolist(), [*heads[1:].tolist(), k]):
            add_partial(f, stop - 1, 0, conv[f:stop].min())

        nodes, parent = _merged(lcp, length, conv)
        is_open = [
            (f == 0 and d <= left) or (e == k - 1 and d <= right) for d, f, e, _, _ in nodes
        ]

        def add_whole(item, f, e, hi, sums, children, ender, conv):
            lo = max(int(lcp[f]), int(lcp[e + 1]), 0)
            up = int(parent[item]) - k
            known = up >= 0 and not is_open[up]
            above = (nodes[up][4], None) if known else (None, name(f, lo))
            add(conv, lo, hi, sums, children, ender, *above, None)

        for i in np.flatnonzero(~goes_on & (length > 0)).tolist():
            own = spread(i, i, True)
            add_whole(i, i, i, int(length[i]), own, int(deep_children[i]), ender[i], int(conv[i]))
        for number, (d, f, e, children, low) in enumerate(nodes):
            if not is_open[number]:
                ends = ender[f] if length[f] == d else None
                add_whole(k + number, f, e, d, spread(f, e, True), children, ends, low)
        columns = list(zip(*rows))
        kinds = [pa.int64()] * 10 + [pa.string()] * 2
        names = [part.split()[0] for part in EDGE.split(", ")]
        for at in range(0, len(rows), 1 << 16):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[at : at + (1 << 16)], t) for c, t in zip(columns, kinds)], names
            )

    return build


def _edges(elements: DataFrame, offset: int) -> tuple[DataFrame, DataFrame]:
    """Edges of the elements' forest, and the nodes merged over partitions."""
    ordered = cut(
        elements.repartitionByRange("cls", "key")
        .sortWithinPartitions("cls", "key")
        .withColumn("pid", F.spark_partition_id())
    )
    places = "pid int, cls string, key string"
    ends = ordered.select("pid", "cls", "key").mapInArrow(_ends, places)
    # two rows per partition, whatever their number of elements
    met = ends.coalesce(1).sortWithinPartitions("pid", "cls", "key").mapInArrow(
        _meeting, "left int, right int, depth bigint"
    )
    meets: dict[int, list[int]] = {}
    for row in met.collect():
        meets.setdefault(row["left"], [-1, -1])[1] = row["depth"]
        meets.setdefault(row["right"], [-1, -1])[0] = row["depth"]
    found = stored(
        ordered.mapInArrow(_forest({p: tuple(d) for p, d in meets.items()}, offset), EDGE), "edges"
    )
    added = [F.sum(c).alias(c) for c in ("n", "total", "base", "children", "leaves")]
    merged = stored(
        found.where("node is not null")
        .groupBy("node", "lo", "hi", "parent")
        .agg(F.min("conv").alias("conv"), F.min("ender").alias("ender"), *added),
        "nodes",
    )
    return found.where("node is null"), merged


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each sorted run, as one stream."""
    pairs = (
        pair
        for batch in batches
        for pair in zip(batch.column("sig").to_pylist(), batch.column("conv").to_pylist())
    )
    for _, run in groupby(pairs, key=lambda p: p[0]):
        first = next(run)[1]
        digest = hashlib.sha256(str(first).encode())
        for _, conv in run:
            digest.update(b",%d" % conv)
        yield pa.RecordBatch.from_pydict({"ender": [first], "ends": [digest.hexdigest()]})


def prefix_trie(
    turns: DataFrame, convs: DataFrame, width: int = WIDTH, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Nodes of the trie of all conversations: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    ``turns`` has (conv, pos, mark, chars), positions of a conversation without gaps from 1; ``convs`` all ids,
    also those without turns. Without conversations there is no row.
    """
    path = running(turns, ["conv"], ["pos"], {"after": F.col("chars")}, hot_rows, turns.select("conv"))
    block = F.floor((F.col("pos") - 1) / width).cast("bigint")
    path = stored(path.withColumn("block", block), "path")
    sizes = path.groupBy("conv").agg(F.max("pos").alias("m"), F.sum("chars").alias("total"))
    whole = convs.join(sizes, "conv", "left").na.fill(0, ["m", "total"])
    turn = F.struct("pos", "mark", "after", (F.col("after") - F.col("chars")).alias("before"))
    listed = F.sort_array(F.collect_list(turn))
    before = F.transform(F.slice("t", 1, 1), lambda t: t["before"])
    blocks = stored(
        path.groupBy("conv", "block")
        .agg(listed.alias("t"))
        .select(
            "conv",
            "block",
            F.array_join(F.transform("t", lambda t: t["mark"]), "").alias("key"),
            F.concat(before, F.transform("t", lambda t: t["after"])).alias("sums"),
        ),
        "blocks",
    )
    members = whole.join(blocks.where("block = 0").drop("block"), "conv", "left").select(
        F.lit("").alias("cls"),
        "conv",
        "m",
        "total",
        F.coalesce("key", F.lit("")).alias("key"),
        F.coalesce("sums", F.array(F.lit(0).cast("bigint"))).alias("sums"),
    )
    rounds = []
    while True:
        stop = (len(rounds) + 1) * width
        members = stored(
            members.withColumn("more", F.col("m") > stop).withColumn(
                "sig", F.sha2(F.concat("cls", F.lit(":"), "key").cast("binary"), 256)
            ),
            "members",
        )
        ends = F.when(~F.col("more"), F.col("conv"))
        goes = F.when(F.col("more"), F.col("conv"))
        elements = stored(
            members.groupBy("cls", "sig", "key", "sums").agg(
                F.min("conv").alias("conv"),
                F.count(F.lit(1)).alias("n"),
                F.sum("total").alias("total"),
                F.count(ends).alias("n_end"),
                F.min(ends).alias("ender"),
                F.count(goes).alias("n_more"),
                F.min(goes).alias("goer"),
                F.sum(F.when(F.col("more"), F.col("total"))).alias("goer_total"),
                F.max("m").alias("m"),
            ),
            "elements",
        )
        rounds.append((members, elements))
        classes = elements.where("n_more > 1").select("sig")
        if not classes.take(1):
            break
        further = members.where("more").join(classes, "sig", "left_semi")
        members = (
            further.select(F.col("sig").alias("cls"), "conv", "m", "total")
            .join(blocks.where(F.col("block") == len(rounds)).drop("block"), "conv")
            .select("cls", "conv", "m", "total", "key", "sums")
        )

    edges, streams, deeper, root = [], [], None, None
    for number in reversed(range(len(rounds))):
        members, elements = rounds[number]
        if deeper is None:
            elements = elements.withColumns({c: F.lit(0).cast("bigint") for c in ("d", "l", "k")})
        else:
            elements = elements.join(deeper, "sig", "left")
        end = F.element_at("sums", -1)
        one, many = F.col("n_more") == 1, F.col("n_more") > 1

        def of(single, several):
            return F.when(many, several).when(one, single).otherwise(0).cast("bigint")

        known = elements.select(
            "cls",
            "key",
            "sums",
            "conv",
            "n",
            "total",
            "ender",
            of(F.col("goer_total") - end, F.col("d") - end).alias("deep"),
            of(F.lit(1), F.col("l")).alias("deep_leaves"),
            of(F.lit(1), F.col("k")).alias("deep_children"),
        )
        own, merged = _edges(known, number * width)
        top = F.col("hi") == number * width
        inner = merged.where(~top)
        deeper = merged.where(top).select(
            F.col("node").alias("sig"),
            (F.col("total") - F.col("base")).alias("d"),
            F.col("leaves").alias("l"),
            F.col("children").alias("k"),
        )
        if number:
            tops = rounds[number - 1][1].where("n_more > 1").select(F.col("sig").alias("node"), "conv")
        else:
            root = merged.where(top)
            tops = root.select("node", "conv")
        above = inner.select("node", "conv").unionByName(tops).toDF("parent", "found_conv")
        columns = ["conv", "lo", "hi", "n", "base", "children", "leaves", "ender"]
        asked = inner.select(*columns, "parent").unionByName(
            own.where("parent is not null").select(*columns, "parent")
        )
        edges.append(
            asked.join(above, "parent").select(*columns, F.col("found_conv").alias("parent_conv"))
        )
        edges.append(own.where("parent is null").select(*columns, "parent_conv"))
        edges.append(  # a conversation that goes on alone
            rounds[number][1]
            .where("n_more = 1")
            .select(
                F.col("goer").alias("conv"),
                F.lit((number + 1) * width).cast("bigint").alias("lo"),
                F.col("m").alias("hi"),
                F.lit(1).cast("bigint").alias("n"),
                *[F.lit(x).cast("bigint").alias(c) for c, x in zip(columns[4:7], (0, 0, 1))],
                F.col("goer").alias("ender"),
                F.col("conv").alias("parent_conv"),
            )
        )
        several = rounds[number][1].where("n_end > 1").select("sig")
        streams.append(
            members.where(~F.col("more")).join(several, "sig", "left_semi").select("sig", "conv")
        )

    listed = streams[0]
    for more in streams[1:]:
        listed = listed.unionByName(more)
    digests = stored(
        listed.repartition("sig")
        .sortWithinPartitions("sig", "conv")
        .mapInArrow(_digests, "ender bigint, ends string"),
        "ends",
    )
    paths = edges[0]
    for more in edges[1:]:
        paths = paths.unionByName(more)
    alone = F.sha2(F.col("ender").cast("string").cast("binary"), 256)

    def with_ends(df: DataFrame) -> DataFrame:
        named = df.join(digests, "ender", "left")
        return named.withColumn(
            "ends", F.when(F.col("ender").isNull(), EMPTY).otherwise(F.coalesce("ends", alone))
        )

    blocks_of = F.sequence(
        F.floor(F.col("lo") / width).cast("bigint"), F.floor((F.col("hi") - 1) / width).cast("bigint")
    )
    pieces = with_ends(paths).withColumn("block", F.explode(blocks_of))
    last, first = F.col("pos") == F.col("hi"), F.col("pos") == F.col("lo") + 1
    nodes = (
        path.join(pieces, ["conv", "block"])
        .where("pos > lo and pos <= hi")
        .select(
            F.col("conv").alias("conv_id"),
            F.col("pos").alias("depth"),
            F.when(first, F.col("parent_conv")).otherwise(F.col("conv")).alias("parent_conv_id"),
            F.col("n").alias("n_convs"),
            F.when(last, F.col("children")).otherwise(1).alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            (F.col("base") - (F.col("n") - 1) * (F.col("after") - F.col("chars"))).alias(
                "saved_tokens"
            ),
            F.when(last, F.col("ends")).otherwise(EMPTY).alias("ends_sha256"),
        )
    )
    return nodes.unionByName(
        with_ends(root).select(
            F.col("conv").alias("conv_id"),
            F.col("hi").alias("depth"),
            F.lit(None).cast("bigint").alias("parent_conv_id"),
            F.col("n").alias("n_convs"),
            F.col("children").alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            F.col("base").alias("saved_tokens"),
            F.col("ends").alias("ends_sha256"),
        )
    )
