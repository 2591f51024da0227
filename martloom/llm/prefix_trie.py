"""The trie of conversation prefixes, built by van Emde Boas recursion.

A conversation is a sequence of turns, cut into pieces of ``PIECE`` turns. The trie of
all sequences is cut at half its depth, again and again, until its parts are as high as
a piece. From below, blocks of turns get names by joining the names of their halves;
from above, the prefix at every cut gets its name from the prefix at the cut above and
the block between them. Parts of one height are independent, so that one Spark job names
all of them, and there are as many jobs as the depth can be halved. A part's nodes are
named within its pieces; equal sequences, and only these, have equal names.

Totals of subtrees go the other way. First they cover the nodes of one part alone. Then
parts are joined pair by pair: what the lower parts under a cut node amount to is grafted
on that node and on its ancestors in the upper part, found in the row of the node's own
smallest member. Every height adds at most one row for each turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm.sharding import numbered
from martloom.llm.tables import read_table
from martloom.session import keep

# Turns of a piece, the height at which the recursion ends.
PIECE = 16
# Members that share the first turns of another conversation.
FAMILY, MOST_SHARED = 100, 6
# Ids are joined to texts of at most so many.
JOINED = 50_000

_JOINED = "conv_id long, depth long, first long, ids string"
_HASHED = "conv_id long, depth long, ends_sha256 string"


def _hash(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _turns(conversations: DataFrame) -> DataFrame:
    """conv_id, digest, chars and place (from 1) of every turn, without its text."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        # With the length of the role in front, no two turns look alike.
        _hash(F.concat(F.length(role), F.lit(":"), role, text).cast("binary")).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    )
    counted, _ = numbered(rows, ["conv_id", "turn", "digest"])
    return counted.select("conv_id", "digest", "chars", "row_number")


def _families(turns: DataFrame) -> DataFrame:
    """Where each conversation starts, its turns, and how many it takes from which one."""
    sizes = keep(
        turns.groupBy("conv_id").agg(F.min("row_number").alias("start"), F.count("*").alias("turns")),
        "sizes",
    )
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED
    donor = F.col("conv_id") - F.col("conv_id") % FAMILY
    given = sizes.select(F.col("conv_id").alias("donor"), F.col("turns").alias("given"))
    taken = F.least("shared", F.coalesce("given", F.lit(0).cast("long")))
    return keep(
        sizes.withColumns({"shared": shared, "donor": donor})
        .join(given, "donor", "left")
        .withColumn("taken", taken)
        .withColumn("depth", F.col("taken") + F.greatest(F.col("turns") - F.col("shared"), F.lit(0)))
        .select("conv_id", "start", "shared", "donor", "taken", "depth"),
        "families",
    )


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (conv_id, depth, digest, chars), and their lengths.

    A conversation begins with up to five turns of the first one of its hundred and goes
    on with its own turns after as many places.
    """
    turns = keep(_turns(conversations), "turns")
    families = _families(turns)
    placed = turns.join(families, "conv_id").withColumn(
        "place", F.col("row_number") - F.col("start") + 1
    )
    own = placed.where("place > shared").select(
        "conv_id", (F.col("place") - F.col("shared") + F.col("taken")).alias("depth"), "digest", "chars"
    )
    first = placed.where(F.col("place") < MOST_SHARED).select(
        F.col("conv_id").alias("donor"), "place", "digest", "chars"
    )
    taken = (
        families.select("conv_id", "donor", "taken")
        .join(first, "donor")
        .where("place <= taken")
        .select("conv_id", F.col("place").alias("depth"), "digest", "chars")
    )
    return keep(own.unionAll(taken), "rebuilt"), families.select("conv_id", "depth")


def _chain(root: Column, turns: str) -> Column:
    """Names of the prefixes of an array of turns below ``root``, each from the one before."""
    return F.aggregate(
        turns,
        F.array(root),
        lambda names, turn: F.concat(
            names, F.array(_hash(F.element_at(names, -1), turn["digest"]))
        ),
    )


def _pieces(turns: DataFrame) -> DataFrame:
    piece = F.expr(f"(depth - 1) div {PIECE}")
    listed = F.sort_array(F.collect_list(F.struct("depth", "digest", "chars")))
    return keep(
        turns.groupBy("conv_id", piece.alias("piece")).agg(listed.alias("turns")), "pieces"
    )


def _blocks(pieces: DataFrame, heights: int) -> list[DataFrame]:
    """Names of whole blocks of 1, 2, 4 ... pieces, by number of the block."""
    nothing = F.unhex(F.lit(""))
    whole = pieces.where(F.size("turns") == PIECE)
    named = F.element_at(_chain(nothing, "turns"), -1)
    out = [keep(whole.select("conv_id", "piece", named.alias("block")), "blocks")]
    for _ in range(1, heights):
        half = F.col("piece") % 2
        pairs = (
            out[-1]
            .groupBy("conv_id", F.expr("piece div 2").alias("piece"))
            .agg(
                F.max(F.when(half == 0, F.col("block"))).alias("upper"),
                F.max(F.when(half == 1, F.col("block"))).alias("lower"),
            )
            .where("upper IS NOT NULL AND lower IS NOT NULL")
        )
        out.append(keep(pairs.select("conv_id", "piece", _hash("upper", "lower").alias("block")), "blocks"))
    return out


def _cut_prefixes(conversations: DataFrame, blocks: list[DataFrame]) -> DataFrame:
    """Name of the prefix above every piece, from the highest cut to the lowest."""
    roots = conversations.select(
        "conv_id", F.lit(0).cast("long").alias("piece"), F.unhex(F.lit("")).alias("root")
    )
    for height in reversed(range(len(blocks))):
        block = blocks[height].select("conv_id", F.col("piece").alias("number"), "block")
        # Roots known so far lie at every second block of this height.
        below = (
            roots.withColumn("number", F.expr(f"piece div {1 << height}"))
            .join(block, ["conv_id", "number"])
            .select(
                "conv_id", (F.col("piece") + (1 << height)).alias("piece"), _hash("root", "block").alias("root")
            )
        )
        roots = keep(roots.unionAll(below), "cuts")
    return roots


def _members(turns: DataFrame, conversations: DataFrame, pieces_deep: int) -> DataFrame:
    """conv_id, depth, chars, node and n_convs of every turn of every conversation.

    ``node`` is the smallest conv_id with the same first ``depth`` turns.
    """
    pieces = _pieces(turns)
    # Cuts lie above the pieces 1 to pieces_deep - 1.
    blocks = _blocks(pieces, (pieces_deep - 1).bit_length()) if pieces_deep > 1 else []
    roots = _cut_prefixes(conversations, blocks)
    names = F.slice(_chain(F.col("root"), "turns"), 2, PIECE)
    named = (
        pieces.join(roots, ["conv_id", "piece"])
        .select("conv_id", F.explode(F.arrays_zip("turns", names.alias("names"))).alias("t"))
        .select("conv_id", F.col("t.turns.depth").alias("depth"), F.col("t.turns.chars").alias("chars"),
                F.col("t.names").alias("name"))
    )
    named = keep(named, "named")
    nodes = keep(
        named.groupBy("name").agg(F.min("conv_id").alias("node"), F.count("*").alias("n_convs")),
        "nodes",
    )
    return keep(named.join(nodes, "name").drop("name"), "members")


def _own_nodes(members: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, saved, leaves.

    ``saved`` and ``leaves`` are the node's own. Nodes of depth 1 have no parent yet.
    """
    above = members.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent_conv_id"))
    nodes = members.where("conv_id = node").join(above, ["conv_id", "depth"], "left")
    nodes = keep(nodes.drop("node"), "own")
    children = (
        nodes.where("depth > 1")
        .groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
        .agg(F.count("*").alias("n_children"))
    )
    n_children = F.coalesce("n_children", F.lit(0).cast("long"))
    return keep(
        nodes.join(children, ["conv_id", "depth"], "left").select(
            "conv_id", "depth", "parent_conv_id", "n_convs", n_children.alias("n_children"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
            F.when(n_children == 0, 1).otherwise(0).cast("long").alias("leaves"),
        ),
        "own",
    )


def _added(rows: DataFrame, conv_id: str, depth: str = "depth") -> DataFrame:
    return rows.groupBy(F.col(conv_id).alias("conv_id"), F.expr(depth).alias("depth")).agg(
        F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")
    )


def _subtrees(members: DataFrame, nodes: DataFrame, deepest: int) -> DataFrame:
    """``nodes`` with ``saved`` and ``leaves`` of their whole subtrees."""
    rest = ("parent_conv_id", "n_convs", "n_children")
    places = members.select("conv_id", "depth", "node")
    # Within a part of one piece: a member's own nodes count for all above them in it.
    piece = Window.partitionBy("conv_id", F.expr(f"(depth - 1) div {PIECE}")).orderBy(F.desc("depth"))
    own = places.join(nodes.select("conv_id", "depth", "saved", "leaves"), ["conv_id", "depth"], "left")
    upward = own.select("node", "depth", *(F.sum(c).over(piece).alias(c) for c in ("saved", "leaves")))
    totals = keep(
        nodes.drop("saved", "leaves").join(
            _added(upward.where("leaves IS NOT NULL"), "node"), ["conv_id", "depth"]
        ),
        "totals",
    )
    height = PIECE
    while height < deepest:
        # Parts of this height meet at the cuts; the roots of the lower ones lie just below.
        grafts = _added(
            totals.where((F.col("depth") - 1) % (2 * height) == height), "parent_conv_id", "depth - 1"
        ).withColumnRenamed("depth", "cut")
        cut = F.expr(f"(depth - 1) div {2 * height} * {2 * height} + {height}")
        reached = (
            places.where((F.col("depth") - 1) % (2 * height) < height)
            .withColumn("cut", cut)
            .join(grafts, ["conv_id", "cut"])
        )
        more = _added(reached, "node").withColumnsRenamed({"saved": "saved_more", "leaves": "leaves_more"})
        zero = F.lit(0).cast("long")
        totals = keep(
            totals.join(more, ["conv_id", "depth"], "left").select(
                "conv_id", "depth", *rest,
                *((F.col(c) + F.coalesce(f"{c}_more", zero)).alias(c) for c in ("saved", "leaves")),
            ),
            "totals",
        )
        height *= 2
    return totals


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids of each node as comma-joined texts of bounded length."""
    node, ids = None, []

    def row() -> pa.RecordBatch:
        text = ",".join(map(str, ids))
        values = [[node[0]], [node[1]], [ids[0]]]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(v, pa.int64()) for v in values), pa.array([text])],
            names=["conv_id", "depth", "first", "ids"],
        )

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("conv_id", "depth", "member")]
        out = []
        for conv_id, depth, member in zip(*columns):
            if node != (conv_id, depth) or len(ids) == JOINED:
                if ids:
                    out.append(row())
                node, ids = (conv_id, depth), []
            ids.append(member)
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
    if ids:
        yield row()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's texts, which come in order; a hash needs no room for them."""
    node = state = None

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string())
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, names=["conv_id", "depth", "ends_sha256"])

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("conv_id", "depth", "ids")]
        out = []
        for conv_id, depth, ids in zip(*columns):
            if node != (conv_id, depth):
                if state:
                    out.append((*node, state.hexdigest()))
                node, state = (conv_id, depth), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if out:
            yield batch_of(out)
    if state:
        yield batch_of([(*node, state.hexdigest())])


def _ends(members: DataFrame, conversations: DataFrame, root: int) -> DataFrame:
    """Hash of the conversations that end at a node, for the nodes that have such."""
    last = conversations.join(members.select("conv_id", "depth", "node"), ["conv_id", "depth"], "left")
    rows = last.select(
        F.coalesce("node", F.lit(root)).alias("conv_id"), "depth", F.col("conv_id").alias("member")
    )
    order = ["conv_id", "depth", "member"]
    texts = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_joined, _JOINED)
    return (
        texts.repartition("conv_id", "depth")
        .sortWithinPartitions("conv_id", "depth", "first")
        .mapInArrow(_hashed, _HASHED)
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    ``conversations`` has conv_id, turn, role and text. Turns are in the order of turn,
    missing ones first, then of a hash of role and text, which missing ones leave empty.
    Rows without conv_id take no part; repeated rows are turns of their own. A
    conversation left without turns is a member of the root alone. An empty table gives
    no node.
    """
    turns, lengths = rebuilt(conversations)
    whole = lengths.agg(F.min("conv_id"), F.count("*"), F.max("depth")).first()
    root, count, deepest = whole[0], whole[1], whole[2] or 0
    spark = conversations.sparkSession
    members = _members(turns, lengths, -(-deepest // PIECE))
    totals = _subtrees(members, _own_nodes(members), deepest)
    top = totals.where("depth = 1").agg(
        F.count("*").alias("n_children"), F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")
    )
    long = lambda value: F.lit(value).cast("long")
    roots = top.select(
        long(root).alias("conv_id"), long(0).alias("depth"), long(None).alias("parent_conv_id"),
        long(count).alias("n_convs"), "n_children",
        F.coalesce("saved", long(0)).alias("saved"), F.coalesce("leaves", long(1)).alias("leaves"),
    ).where(F.lit(count > 0))
    below = totals.withColumn(
        "parent_conv_id", F.when(F.col("depth") == 1, long(root)).otherwise(F.col("parent_conv_id"))
    )
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        below.select(*roots.columns)
        .unionAll(roots)
        .join(_ends(members, lengths, root), ["conv_id", "depth"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
            F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", empty).alias("ends_sha256"),
        )
    )


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(read_table(spark, folder, "conversations"))


def oracle_sql() -> str:
    return rf"""
WITH crc_table AS (
  SELECT list(list_reduce(list_concat([b], range(8)), lambda c, i:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS entries
  FROM (SELECT unnest(range(256)) AS b)
), given AS MATERIALIZED (
  SELECT conv_id, length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS turn_text,
    length(coalesce(text, ''))::BIGINT AS chars, turn FROM conversations WHERE conv_id IS NOT NULL
), original AS MATERIALIZED (
  SELECT conv_id, list({{'t': sha256(turn_text), 'n': chars}} ORDER BY turn NULLS FIRST, sha256(turn_text)) AS turns
  FROM given GROUP BY 1
), shared AS (
  SELECT conv_id, turns, xor(list_reduce(list_concat([4294967295::BIGINT],
    list_transform(regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'), lambda h: ('0x' || h)::BIGINT)),
    lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])), 4294967295) % {MOST_SHARED} AS h
  FROM original, crc_table
), rebuilt AS MATERIALIZED (
  SELECT s.conv_id, list_concat(coalesce(d.turns[1:h], []), s.turns[h + 1:]) AS turns
  FROM shared s LEFT JOIN original d ON d.conv_id = s.conv_id - s.conv_id % {FAMILY}
), places AS MATERIALIZED (
  SELECT conv_id, 0 AS depth, '' AS name, 0 AS chars, len(turns) AS length FROM rebuilt
  UNION ALL
  SELECT conv_id, depth, sha256(list_aggregate(list_transform(turns[1:depth], lambda x: x.t), 'string_agg', ',')),
    turns[depth].n, len(turns)
  FROM (SELECT conv_id, turns, unnest(range(1, len(turns) + 1)) AS depth FROM rebuilt)
), nodes AS MATERIALIZED (
  SELECT name, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (length = depth), '')) AS ends_sha256
  FROM places GROUP BY 1, 2
), linked AS MATERIALIZED (
  SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n
  LEFT JOIN places m ON m.conv_id = n.conv_id AND m.depth = n.depth - 1
  LEFT JOIN nodes p ON p.name = m.name AND p.depth = m.depth
), counted AS MATERIALIZED (
  SELECT l.*, coalesce(c.n, 0) AS n_children FROM linked l
  LEFT JOIN (SELECT parent_conv_id, depth - 1 AS depth, count(*) AS n FROM linked GROUP BY 1, 2) c
    ON c.parent_conv_id = l.conv_id AND c.depth = l.depth
), subtrees AS (
  SELECT m.name, m.depth, sum((c.n_convs - 1) * c.chars) AS saved, sum((c.n_children = 0)::INTEGER) AS leaves
  FROM counted c JOIN places m ON m.conv_id = c.conv_id AND m.depth <= c.depth GROUP BY 1, 2
)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs, n_children, leaves::BIGINT AS n_leaves,
  saved::BIGINT AS saved_tokens, ends_sha256
FROM counted JOIN subtrees USING (name, depth)
"""
