"""Merkle manifest of a dataset: one root per source, one over all sources, and proofs of single rows.

Rows become leaves (SHA-256 of their fields). Leaves are put in order with a distributed sort and gathered in
aligned blocks of 256 nodes. A block keeps each of its levels as one hex string: fixed-width substrings of it
are the runs of 16 nodes that hash to their parents, and the substrings on both sides of a node in its run are
that node's siblings. Two levels are folded a round; the blocks' top nodes are the next round's nodes, so
the rounds grow with the logarithm of the largest source and each is 256 times smaller than the one before.
Proofs go the same way down: a block takes its path from the block above and hands it to its nodes.

Only digests are ever shuffled, no texts, and a task holds one block of 256 nodes at a time, so a source with a
third of all rows is as many tasks as any other rows are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, cut, with_row_id

HEX = 64  # characters of a digest
FAN = 16
BLOCK = FAN * FAN
RUN = FAN * HEX  # characters of a full run
PART_BITS = 33  # monotonically_increasing_id: partition number above, place in it below


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the inputs one after the other; digests go in as hex text."""
    return F.sha2(F.concat(*parts) if len(parts) > 1 else parts[0], 256)


def field(value: Column) -> Column:
    """A value as it goes into a leaf: its UTF-8 length, ``:`` and itself; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def positions(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Add ``pos``, the place from 0 among the rows with equal ``group`` (null is a group), and ``m``, their number.

    Rows are dealt by ranges of (group, order, row number), so a group of any size, also one of equal rows,
    spreads over tasks. A row's number after the sort gives its place in its range; what lies before the range is a
    prefix sum over one count per group and range.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order, "salt")]
    laid = cut(with_row_id(cut(with_row_id(rows, "salt")).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("salt"), "at"))
    laid = laid.withColumn("part", F.shiftright("at", PART_BITS))
    spans = laid.groupBy(F.col(group).alias("of"), F.col("part").alias("in")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("of").orderBy("in").rowsBetween(Window.unboundedPreceding, -1)
    spans = (spans.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
             .withColumn("m", F.sum("n").over(Window.partitionBy("of"))).drop("n"))
    return (laid.join(spans, F.col(group).eqNullSafe(F.col("of")) & (F.col("part") == F.col("in")))
            .withColumn("pos", F.col("at") - F.col("first") + F.col("before"))
            .drop("at", "part", "of", "in", "first", "before"))


def _runs(text: Column, nodes: Column) -> Column:
    """The level above as one hex string: a digest for every run of ``FAN`` nodes in ``text``."""
    return F.array_join(F.transform(F.sequence(F.lit(0), F.floor((nodes - 1) / FAN).cast("int")),
                                    lambda i: F.sha2(F.substring(text, i * RUN + 1, F.lit(RUN)), 256)), "")


def _levels(blocks: DataFrame) -> DataFrame:
    """Add the block's levels as hex strings (bytes, so that a substring costs its own length) and its top node."""
    low = F.array_join(F.transform("items", lambda x: x["node"]), "").cast("binary")
    out = blocks.withColumn("low", low)
    out = out.withColumn("high", _runs(F.col("low"), F.size("items")).cast("binary"))
    top = (F.when(F.col("m") <= 1, F.col("low").cast("string")).when(F.col("m") <= FAN, F.col("high").cast("string"))
           .otherwise(F.sha2("high", 256)))
    return out.withColumn("top", top)


def _blocks(nodes: DataFrame, extra: list[str]) -> DataFrame:
    """Gather nodes (group, pos, m, node, extra) into one row per aligned block: group, block, m, items in order."""
    item = F.struct("pos", "node", *extra)
    return (nodes.groupBy("group", F.floor(F.col("pos") / BLOCK).cast("bigint").alias("block"), "m")
            .agg(F.sort_array(F.collect_list(item)).alias("items")))


def climb(nodes: DataFrame, extra: list[str]) -> list[DataFrame]:
    """The rounds from the leaves up, each (group, block, m, items); the last has one block per group."""
    rounds = []
    while True:
        rounds.append(cut(_blocks(nodes, extra)))
        most = rounds[-1].agg(F.max("m")).first()[0]
        if most is None or most <= BLOCK:
            return rounds
        nodes = _levels(rounds[-1]).select("group", F.col("block").alias("pos"), F.ceil(F.col("m") / BLOCK).cast("bigint").alias("m"),
                                           F.col("top").alias("node"))
        extra = []


def tops(rounds: list[DataFrame]) -> DataFrame:
    """(group, top) of each group."""
    return _levels(rounds[-1]).select("group", "top")


def _flanks(text: Column, place: Column) -> Column:
    """Siblings on both sides of the node at ``place``: the rest of its run of ``FAN``."""
    run = F.floor(place / FAN).cast("int") * RUN
    at = (place % FAN).cast("int") * HEX
    return F.struct(F.substring(text, run + 1, at).cast("string").alias("left"),
                    F.substring(text, run + at + HEX + 1, RUN - HEX - at).cast("string").alias("right"))


def descend(rounds: list[DataFrame], above: DataFrame, carried: list[str]) -> DataFrame:
    """Every node of the first round with its path: its fields, ``path`` (left and right siblings, level by level up) and ``carried``.

    ``above`` has a row per group: group, the path from its top on, and the carried columns.
    """
    paths = above.withColumn("pos", F.lit(0).cast("bigint"))
    for level in reversed(rounds):
        up = paths.select(F.col("group").alias("of"), F.col("pos").alias("in"), F.col("path").alias("above"), *carried)
        met = _levels(level).drop("top").join(up, F.col("group").eqNullSafe(F.col("of")) & (F.col("block") == F.col("in")))
        one = met.select("group", "m", "low", "high", "above", *carried, F.explode("items").alias("item"))
        place = (F.col("item.pos") % BLOCK).cast("int")
        path = F.concat(F.when(F.col("m") > 1, F.array(_flanks(F.col("low"), place))).otherwise(F.array()),
                        F.when(F.col("m") > FAN, F.array(_flanks(F.col("high"), F.floor(place / FAN).cast("int")))).otherwise(F.array()),
                        F.col("above"))
        paths = one.select("group", "item.*", path.alias("path"), *carried)
    return paths


def proof_digest(path: Column) -> Column:
    """Digest of a proof: all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, p: F.sha2(F.concat(p["left"], node, p["right"]), 256))


def manifest(docs: DataFrame, leaf: Column, tampered: Column, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """Leaf, subroot, root and proof of every row, and the root that its tampered leaf folds to.

    Rows: id, leaf, subroot, root, path, proof_sha256, folded_root, verified. ``leaf`` and ``tampered`` are digests over
    the columns of ``docs``; a null ``tampered`` stands for the leaf itself. Leaves ascend by id within their source,
    null ids first; rows with one id go by their leaf, and equal rows have equal leaves, so their order changes
    nothing. A null source is a source of its own, before all others. No rows give no rows. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("group"), leaf.alias("node"), tampered.alias("changed"))
    rows = rows.withColumn("changed", F.when(F.col("changed") != F.col("node"), F.col("changed")))
    leaves = climb(positions(rows, "group", ["id", "node"]), ["id", "changed"])
    subroots = tops(leaves).select(F.lit(0).alias("group"), F.col("group").alias("source"), F.col("top").alias("node"))
    sources = climb(positions(subroots, "group", ["source"]), ["source"])
    none = F.array().cast("array<struct<left:string,right:string>>")
    root = tops(sources).select("group", none.alias("path"), F.col("top").alias("root"))
    above = descend(sources, root, ["root"]).select(F.col("source").alias("group"), "path", F.col("node").alias("subroot"), "root")
    out = descend(leaves, above, ["subroot", "root"])
    folded = fold(F.coalesce("changed", "node"), F.col("path"))
    return out.select(F.col("id").alias(id_col), F.col("node").alias("leaf"), "subroot", "root", "path",
                      proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def document_leaf(text: Column | None = None, id_col: str = "doc_id") -> Column:
    """Leaf of a row of ``documents``: doc_id, source, lang, n_chars and text (or another text in its place)."""
    return digest(*[field(F.col(c)) for c in (id_col, "source", "lang", "n_chars")], field(F.col("text") if text is None else text))


def document_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents``, where tampering lower-cases A-Z in each text whose id's CRC-32 is divisible by 5.

    A null id is never tampered with, a null text stays null.
    """
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return manifest(docs, document_leaf(), F.when(hit, document_leaf(ascii_lower(F.col("text")))))


def _oracle(levels: int = 8) -> str:
    """The same tree with one table per level (sources of up to 16**levels rows)."""
    def h(*cols: str) -> str:
        return "sha256(" + " || ".join(f"coalesce(octet_length(encode(cast({c} AS VARCHAR))) || ':' || cast({c} AS VARCHAR), '-')" for c in cols) + ")"

    crc = ("list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(cast(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)), "
           "lambda x, b: list_reduce(list_prepend(xor(x, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), "
           "lambda y, z: xor(y >> 1, CASE WHEN y & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)))")
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ctes = [f"""leaves AS (
  SELECT doc_id, source, {h('doc_id', 'source', 'lang', 'n_chars', 'text')} AS leaf,
         CASE WHEN xor({crc}, 4294967295) % 5 = 0 THEN {h('doc_id', 'source', 'lang', 'n_chars', lowered)}
              ELSE {h('doc_id', 'source', 'lang', 'n_chars', 'text')} END AS changed
  FROM documents)""", """placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS m FROM leaves)""",
            "s0 AS (SELECT source, pos, leaf AS node, m FROM placed)"]

    def level(name: str, k: int, group: str) -> list[str]:
        return [f"""{name}{k} AS (
  SELECT {group} pos // 16 AS pos, sha256(string_agg(node, '' ORDER BY pos)) AS node, count(*) AS run, (any_value(m) + 15) // 16 AS m, string_agg(node, '' ORDER BY pos) AS kids
  FROM {name}{k - 1} WHERE m > 1 GROUP BY {group} pos // 16)"""]

    for k in range(1, levels + 1):
        ctes += level("s", k, "source,")
    ctes.append("subs AS (" + " UNION ALL ".join(f"SELECT source, node AS subroot, m FROM s{k} WHERE m = 1" for k in range(levels + 1)) + ")")
    ctes.append("t0 AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, subroot AS node, count(*) OVER () AS m FROM subs)")
    for k in range(1, 5):
        ctes += level("t", k, "")
    ctes.append("roots AS (" + " UNION ALL ".join(f"SELECT node AS root FROM t{k} WHERE m = 1" for k in range(5)) + ")")
    steps = [f"u0 AS (SELECT p.doc_id, p.source, p.leaf, p.changed AS acc, '' AS proof, p.pos FROM placed p)"]

    def up(new: str, old: str, table: str, key: str) -> str:
        node = "acc"
        at = "(pos % 16) * 64"
        return f"""{new} AS (
  SELECT u.* EXCLUDE (acc, proof, pos), CASE WHEN l.kids IS NULL THEN u.acc ELSE sha256(l.kids[1:{at}] || u.{node} || l.kids[{at} + 65:]) END AS acc,
         u.proof || coalesce(l.kids[1:{at}] || l.kids[{at} + 65:], '') AS proof, u.pos // 16 AS pos
  FROM {old} u LEFT JOIN {table} l ON {key} l.pos = u.pos // 16)""".replace("(pos % 16)", "(u.pos % 16)")

    for k in range(1, levels + 1):
        steps.append(up(f"u{k}", f"u{k - 1}", f"s{k}", "l.source IS NOT DISTINCT FROM u.source AND"))
    steps.append(f"""v0 AS (SELECT u.doc_id, u.leaf, t.node AS subroot, u.acc, u.proof, t.pos FROM u{levels} u JOIN t0 t ON t.source IS NOT DISTINCT FROM u.source)""")
    for k in range(1, 5):
        steps.append(up(f"v{k}", f"v{k - 1}", f"t{k}", ""))
    return "WITH " + ",\n".join(ctes + steps) + """
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = root AS verified FROM v4, roots"""


ORACLE = _oracle()
