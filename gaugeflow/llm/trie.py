"""The trie of conversations that begin with the same turns, by ROLLUP over columns of turn ids.

A conversation is cut into blocks of eight turns. One row per block has the eight turn ids as
columns beside the key of the prefix before it, and one ROLLUP over these columns aggregates the
prefixes of all lengths at once: the grouping id tells how many turns a group has. The key of a
further block is the id of the node at which the block before it ends, so blocks of different
conversations meet just where all turns before them are equal. A second ROLLUP, over the nodes, sums
what lies below each; sums of further blocks go up the chain of blocks by doubling jumps.

Turns and prefixes are told apart by 128 bits of SHA-256. Nothing here gathers a conversation or a
group: turns are numbered over sorted ranges, and keys are chained within stretches of 64 blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm import common

BLOCK = 8
#: Turns whose block keys are chained in one row.
STRETCH = 512
#: Conversation numbers that make one part of a node's list of ends.
ENDS_TOGETHER = 4096
_T = [f"t{k}" for k in range(1, BLOCK + 1)]
_NONE = b""


def _digest(content: Column) -> Column:
    return F.unhex(F.substring(F.sha2(content, 256), 1, 32))


def _prefix_id(key: Column, turns: list[Column]) -> Column:
    """Id of the prefix that goes on from key with these turns; null ones are not there."""
    return _digest(F.concat(key, *(F.coalesce(turn, F.lit(_NONE)) for turn in turns)))


# ---- turns


def turn_id(role: Column, text: Column) -> Column:
    """Sixteen bytes that tell (role, text) apart, then the code points of text in four bytes."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    content = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(_digest(content), F.unhex(F.lpad(F.hex(F.length(text)), 8, "0")))


def _code_points(turn: Column) -> Column:
    return F.conv(F.hex(F.substring(turn, 17, 4)), 16, 10).cast("long")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, position (from 0), turn_id of (conv_id, turn, role, text), in the order of turn.

    Missing turn numbers come first; equal ones in the order of turn_id. The rows are sorted over
    ranges, stored, and counted on from range to range, so a long conversation is many tasks' work.
    """
    keyed = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        turn_id(F.col("role"), F.col("text")).alias("turn_id"),
    ).filter("conv_id IS NOT NULL")
    # Copies of one turn have an order too, so that many of them do not meet in one range.
    keyed = keyed.withColumn("spread", F.monotonically_increasing_id())
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("turn_id"), F.col("spread")]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = common.stored(
        ranged.select("conv_id", "turn_id", F.monotonically_increasing_id().alias("place")),
        "turns",
    ).withColumn("part", F.shiftright("place", 33))
    parts = placed.groupBy("conv_id", "part").agg(
        F.count("*").alias("n"), F.min("place").alias("first")
    )
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    parts = parts.select("conv_id", "part", (before - F.col("first")).alias("shift"))
    return placed.join(parts, ["conv_id", "part"]).select(
        "conv_id", (F.col("place") + F.col("shift")).alias("position"), "turn_id"
    )


def share_openings(turns: DataFrame, most: int = 6, family: int = 100) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: the first h turns of the family's head, then the own ones after h.

    h is the CRC-32 of the decimal conv_id modulo most; the head is conv_id - conv_id % family, and
    gives all its turns if it has fewer than h, none if it is not there. Returns the turns and all
    conv_ids, also of conversations that are left without a turn.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    head = F.col("conv_id") - F.col("conv_id") % family
    convs = sizes.select("conv_id", head.alias("head"), taken.alias("h"))
    heads = sizes.filter(F.col("conv_id") % family == 0)
    heads = heads.select(F.col("conv_id").alias("head"), F.col("n").alias("of_head"))
    convs = common.stored(
        convs.join(heads, "head", "left").select(
            "conv_id", "head", "h", F.least("h", F.coalesce("of_head", F.lit(0))).alias("given")
        ),
        "conversations",
    )
    moved = (F.col("position") - F.col("h") + F.col("given")).alias("position")
    own = turns.join(convs.drop("head"), "conv_id").filter("position >= h")
    opening = turns.filter((F.col("position") < most) & (F.col("conv_id") % family == 0))
    opening = opening.withColumnRenamed("conv_id", "head")
    # At most `most` turns of a head meet at most `family` conversations.
    first = convs.drop("given").join(opening, "head").filter("position < h")
    rebuilt = own.select("conv_id", moved, "turn_id").unionByName(
        first.select("conv_id", "position", "turn_id")
    )
    return rebuilt, convs.select("conv_id")


# ---- blocks


def _stretches(turns: DataFrame, convs: DataFrame, stretch: int) -> DataFrame:
    """conv_id, stretch, ids: the turn ids of each stretch in order; more: whether one follows."""
    # A row without a turn for every conversation, as it may have none.
    alone = convs.select("conv_id", F.lit(None).cast("long").alias("position"))
    every = turns.unionByName(alone, allowMissingColumns=True)
    number = F.coalesce(F.floor(F.col("position") / stretch), F.lit(0)).alias("stretch")
    turn = F.when(F.col("position").isNotNull(), F.struct("position", "turn_id"))
    found = every.groupBy("conv_id", number).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    found = found.select("conv_id", "stretch", F.col("turns.turn_id").alias("ids"))
    found = common.stored(found, "stretches")
    later = found.filter("stretch > 0").select(
        "conv_id", (F.col("stretch") - 1).alias("stretch"), F.lit(True).alias("more")
    )
    return found.join(later, ["conv_id", "stretch"], "left")


def _whole_prefixes(stretches: DataFrame, stretch: int) -> DataFrame:
    """conv_id, stretch, until: the id of all turns up to the end of each full stretch.

    The id of the last 2^k stretches comes from two of the last 2^(k-1), so the rounds grow with
    the logarithm of the longest conversation; usually no stretch is full and there is none.
    """
    whole = F.aggregate("ids", F.lit(b"stretch"), lambda done, turn: _digest(F.concat(done, turn)))
    full = stretches.filter(F.size("ids") == stretch)
    known = common.stored(full.select("conv_id", "stretch", whole.alias("until")), "prefixes")
    last = known.agg(F.max("stretch")).first()[0] or 0
    step = 1
    while step <= last:
        back = known.select(
            "conv_id", (F.col("stretch") + step).alias("stretch"), F.col("until").alias("before")
        )
        both = F.when(
            F.col("before").isNotNull(), _digest(F.concat(F.lit(b"both"), "before", "until"))
        )
        known = known.join(back, ["conv_id", "stretch"], "left")
        known = common.stored(
            known.select("conv_id", "stretch", F.coalesce(both, "until").alias("until")), "prefixes"
        )
        step *= 2
    return known


def blocks(turns: DataFrame, convs: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """A row per conversation and eight turns: conv_id, depth (turns before), key, next, last, t1-t8.

    key is the id of the prefix before the block, next that of the prefix with it.
    """
    if stretch % BLOCK:
        raise ValueError("a stretch is made of whole blocks")
    found = _stretches(turns, convs, stretch)
    until = _whole_prefixes(found, stretch)
    before = until.select(
        "conv_id", (F.col("stretch") + 1).alias("stretch"), F.col("until").alias("before")
    )
    found = found.join(until, ["conv_id", "stretch"], "left")
    found = found.join(before, ["conv_id", "stretch"], "left")
    n = F.greatest(F.ceil(F.size("ids") / BLOCK).cast("int"), F.lit(1))

    def turn(block: Column, k: int) -> Column:
        return F.get("ids", block * BLOCK + k)

    def chained(keys: Column, block: Column) -> Column:
        following = _prefix_id(F.element_at(keys, -1), [turn(block, k) for k in range(BLOCK)])
        return F.concat(keys, F.array(following))

    start = F.array(F.coalesce("before", F.lit(_NONE)))
    keys = F.aggregate(F.sequence(F.lit(0), n - 1), start, chained)
    rows = found.select("*", keys.alias("keys"), n.alias("n")).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("b")
    )
    final = F.col("b") == F.col("n") - 1
    return rows.select(
        "conv_id",
        (F.col("stretch") * stretch + F.col("b") * BLOCK).alias("depth"),
        F.get("keys", F.col("b")).alias("key"),
        F.when(final, F.coalesce("until", F.get("keys", F.col("b") + 1)))
        .otherwise(F.get("keys", F.col("b") + 1))
        .alias("next"),
        (final & F.col("more").isNull()).alias("last"),
        *(turn(F.col("b"), k).alias(name) for k, name in enumerate(_T)),
    )


# ---- nodes


def _rolled(rows: DataFrame, aggregates: str) -> DataFrame:
    """Aggregates of all prefixes within blocks, with level (turns in the block) and id.

    rows: key, depth, next (the id where t8 is there) and t1-t8. Groups that end beyond the turns
    of a shorter row are no prefixes; neither is a further block without a turn.
    """
    # The id after a whole block goes with its last turn, so that nothing but numbers is aggregated.
    columns, last = ", ".join(_T), _T[-1]
    rolled = rows.sparkSession.sql(
        f"SELECT key, depth, {columns}, next, bit_count(grouping_id()) AS missing, {aggregates} "
        f"FROM {{rows}} GROUP BY key, depth, "
        f"ROLLUP({', '.join(_T[:-1])}, ({last}, next))",
        rows=rows,
    )
    # Of the nine rolled up columns the last two come and go together.
    shorter = BLOCK + 1 - F.col("missing")
    rolled = rolled.withColumn("level", F.when(F.col("missing") == 0, BLOCK).otherwise(shorter))
    level = F.col("level")
    there = F.get(F.array(*_T), level - 1).isNotNull() | ((level == 0) & (F.col("depth") == 0))
    own = F.when(level == 0, F.col("key")).when(level == BLOCK, F.col("next"))
    return rolled.filter(there).withColumn(
        "id", F.coalesce(own, _prefix_id(F.col("key"), [F.col(t) for t in _T]))
    )


def _nodes(blocks: DataFrame) -> DataFrame:
    """One row per node: id, parent, key, depth and level, t1-t8, conv_id, n_convs, chars."""
    rolled = _rolled(blocks, "min(conv_id) AS conv_id, count(*) AS n_convs")
    level = F.col("level")
    shorter = [F.when(level > k + 1, F.col(t)) for k, t in enumerate(_T)]
    parent = F.when(level == 1, F.col("key")).when(level > 1, _prefix_id(F.col("key"), shorter))
    turn = F.get(F.array(*_T), level - 1)
    return rolled.select(
        "id", parent.alias("parent"), "key", "depth", "level", *_T, "conv_id", "n_convs",
        turn.alias("turn_id"), F.coalesce(_code_points(turn), F.lit(0)).alias("chars"),
    )


def _sums_below_blocks(valued: DataFrame) -> DataFrame:
    """key, leaves, saved: the sums over all nodes in each further block and the blocks after it.

    Each block knows the one `jump` blocks before it and the sums of the `jump` blocks from itself
    on; a round doubles the jump.
    """
    further = valued.filter("depth > 0").groupBy("key", "depth")
    held = further.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    # The node before a further block is the last of the block in front.
    ends = valued.filter(f"level = {BLOCK}").select(
        F.col("id").alias("key"), F.when(F.col("depth") > 0, F.col("key")).alias("up")
    )
    known = common.stored(held.join(ends, "key"), "blocks-below")
    last = (known.agg(F.max("depth")).first()[0] or 0) // BLOCK
    jump = 1
    while jump < last:
        given = known.filter("up IS NOT NULL").groupBy(F.col("up").alias("key"))
        given = given.agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        above = known.select(F.col("key").alias("up"), F.col("up").alias("farther"))
        total = {c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in ("leaves", "saved")}
        known = common.stored(
            known.join(given, "key", "left")
            .join(above, "up", "left")
            .select("key", "depth", *(v.alias(c) for c, v in total.items()), F.col("farther").alias("up")),
            "blocks-below",
        )
        jump *= 2
    return known.select("key", "leaves", "saved")


def _ends(blocks: DataFrame) -> DataFrame:
    """id, ends_sha256: the digest of the conversations that end at each node.

    Their numbers are joined in parts of a bounded range each, and only the digest itself goes
    through the parts of a node one after the other.
    """
    full = F.col(_T[-1]).isNotNull()
    bare = F.col(_T[0]).isNull()
    own = F.when(bare, F.col("key")).when(full, F.col("next"))
    node = F.coalesce(own, _prefix_id(F.col("key"), [F.col(t) for t in _T]))
    ending = blocks.filter("last").select(
        node.alias("id"), "conv_id", F.floor(F.col("conv_id") / ENDS_TOGETHER).alias("part")
    )
    listed = F.array_sort(F.collect_list("conv_id"))
    joined = F.array_join(F.transform(listed, lambda c: c.cast("string")), ",")
    parts = ending.groupBy("id", "part").agg(joined.alias("listed"))
    in_order = parts.repartition("id").sortWithinPartitions("id", "part")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            ids, digests = [], []
            for node, text in zip(
                batch["id"].to_pylist(), batch["listed"].to_pylist(), strict=True
            ):
                if node == current:
                    state.update(b",")
                else:
                    if state:
                        ids.append(current)
                        digests.append(state.hexdigest())
                    current, state = node, hashlib.sha256()
                state.update(text.encode())
            yield _ends_batch(ids, digests)
        if state:
            yield _ends_batch([current], [state.hexdigest()])

    return common.arrow_map(
        in_order.select("id", "listed"), digest, "id binary, ends_sha256 string"
    )


def _ends_batch(ids: list, digests: list) -> pa.RecordBatch:
    columns = [pa.array(ids, pa.binary()), pa.array(digests, pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["id", "ends_sha256"])


def prefix_trie(
    turns: DataFrame, convs: DataFrame | None = None, stretch: int = STRETCH
) -> DataFrame:
    """The nodes of the trie of (conv_id, position, turn_id), as `numbered_turns` gives them.

    One row per distinct sequence of first turns, from the root without turns: conv_id (smallest
    member), depth, parent_conv_id (of the root: null), n_convs, n_children, n_leaves (childless
    nodes below it, itself included), saved_tokens (over itself and all below: members beyond the
    first times the code points of the last text), ends_sha256 (of the conv_ids that end here, in
    ascending order with commas), and turn_id of the last turn (of the root: null; `turn_texts`
    spells it).

    convs: all conv_ids, if some have no turn. Conversations may be of any length. A conv_id is one
    conversation; rows without one belong to none and are left out by `numbered_turns`. Without a
    conversation there is no node, not even a root.
    """
    convs = turns.select("conv_id").distinct() if convs is None else convs
    cut = common.stored(blocks(turns, convs, stretch), "turn-blocks")
    nodes = common.stored(_nodes(cut), "trie-nodes")
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("id"))
    counted = nodes.join(children.agg(F.count("*").alias("n_children")), "id", "left")
    n_children = F.coalesce("n_children", F.lit(0))
    valued = common.stored(
        counted.withColumns(
            {
                "n_children": n_children,
                "leaves": F.when(n_children == 0, 1).otherwise(0).cast("long"),
                "saved": (F.col("n_convs") - 1) * F.col("chars"),
            }
        ),
        "trie-values",
    )
    below = _sums_below_blocks(valued).select(
        F.col("key").alias("id"), F.col("leaves").alias("more"), F.col("saved").alias("more_saved")
    )
    own = valued.select("id", "key", "depth", "level", *_T, "leaves", "saved")
    own = own.join(below, "id", "left").select(
        "key", "depth", *_T, F.when(F.col("level") == BLOCK, F.col("id")).alias("next"),
        (F.col("leaves") + F.coalesce("more", F.lit(0))).alias("leaves"),
        (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
    )
    sums = _rolled(own, "sum(leaves) AS n_leaves, sum(saved) AS saved_tokens")
    parents = valued.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    no_end = F.lit(hashlib.sha256().hexdigest())
    return (
        valued.join(sums.select("id", "n_leaves", "saved_tokens"), "id")
        .join(_ends(cut), "id", "left")
        # Many nodes may have one parent; the engine splits such a key.
        .join(parents, "parent", "left")
        .select(
            "conv_id",
            (F.col("depth") + F.col("level")).cast("long").alias("depth"),
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", no_end).alias("ends_sha256"),
            "turn_id",
        )
    )


def turn_texts(conversations: DataFrame) -> DataFrame:
    """turn_id, role, text: what each distinct turn says (null: empty)."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    said = conversations.select(turn_id(role, text).alias("turn_id"), role.alias("role"), text.alias("text"))
    return said.dropDuplicates(["turn_id"])


def shared_openings(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as `share_openings` rebuilds them, without turn_id."""
    rebuilt, convs = share_openings(numbered_turns(conversations))
    return prefix_trie(rebuilt, convs).drop("turn_id")


#: The same rows by lists of turns, each prefix spelt out. crc: the CRC-32 of a decimal number.
ORACLE_SQL = """
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(
      list_prepend(i::BIGINT, range(8)::BIGINT[]),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) AS r(i))),
said AS (
  SELECT conv_id, turn, {'r': coalesce(role, ''), 't': coalesce(text, '')} AS s
  FROM conversations WHERE conv_id IS NOT NULL),
ordered AS (
  SELECT conv_id, s, row_number() OVER (
    PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, substr(sha256(length(s.r) || ':' || s.r || s.t), 1, 32)) - 1 AS p
  FROM said),
sizes AS (SELECT conv_id, count(*) AS n FROM ordered GROUP BY conv_id),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS head, xor(list_reduce(
      list_prepend(4294967295::BIGINT,
        list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 6 AS h
  FROM sizes, crc_table),
given AS (
  SELECT c.*, least(h, coalesce(s.n, 0)) AS g
  FROM convs c LEFT JOIN sizes s ON s.conv_id = c.head),
rebuilt AS (
  SELECT g.conv_id, o.s, o.p - h + g.g AS p
  FROM given g JOIN ordered o ON o.conv_id = g.conv_id AND o.p >= h
  UNION ALL
  SELECT g.conv_id, o.s, o.p FROM given g JOIN ordered o ON o.conv_id = g.head AND o.p < h),
lists AS (
  SELECT g.conv_id, coalesce(list(s ORDER BY p) FILTER (s IS NOT NULL), []) AS l
  FROM given g LEFT JOIN rebuilt USING (conv_id) GROUP BY g.conv_id),
prefixes AS (
  SELECT conv_id, d, list_slice(l, 1, d) AS pre, len(l) = d AS is_end
  FROM lists, unnest(range(0, len(l) + 1)) AS u(d)),
nodes AS (
  SELECT d, pre, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_end), ''))
      AS ends_sha256
  FROM prefixes GROUP BY d, pre),
children AS (
  SELECT d - 1 AS d, list_slice(pre, 1, d - 1) AS pre, count(*) AS n_children
  FROM nodes WHERE d > 0 GROUP BY ALL),
valued AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children,
    CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf,
    CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * length(pre[d].t) END AS saved
  FROM nodes n LEFT JOIN children USING (d, pre)),
below AS (
  SELECT k AS d, list_slice(pre, 1, k) AS pre, sum(leaf)::BIGINT AS n_leaves,
    sum(saved)::BIGINT AS saved_tokens
  FROM valued, unnest(range(0, d + 1)) AS u(k) GROUP BY ALL)
SELECT v.conv_id, v.d AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children,
  b.n_leaves, b.saved_tokens, v.ends_sha256
FROM valued v JOIN below b USING (d, pre)
LEFT JOIN nodes p ON p.d = v.d - 1 AND p.pre = list_slice(v.pre, 1, v.d - 1)
"""
