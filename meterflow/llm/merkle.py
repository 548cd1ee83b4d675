"""Merkle manifest of a dataset: a leaf per document, a tree per source, a tree over the sources.

Inner nodes are digests of up to 16 children's digests (hex text), and a level is added while more
than one node is left; a last run of fewer children, even one, gets its node like any other. Leaves
are digested next to the texts; only digests and ids are shuffled. They are put in order by (source,
doc_id) with range partitioning, and dealt out in aligned blocks of `BLOCK` leaves of one source, so
that a source with a third of all documents is many blocks. Each block makes its own lowest levels.

The levels above come from a butterfly exchange. In round r every block asks one block in each of the
16 subtrees under its next ancestor for the root of that subtree: the block with its own offset in
there (modulo the number of blocks, where the last subtree is not full). All blocks under an ancestor
hash it, each for itself, and keep what they received as that level's part of the proof. After as many
rounds as the tree has levels above the blocks, every block has the whole upper proof and the root,
and nothing is sent down again. The same exchange goes on over the sources, whose blocks then act for
their source. A round sends at most 16 short rows per block, and is written, so a lost executor costs
one round.

Defined cases: null fields are digested as ``-``, so a null text differs from an empty one. A null
source is a source of its own, the first; null ids come first in theirs. Rows with one source and
doc_id are ordered by their leaf; equal rows are leaves of their own, with proofs by position. A
source with one leaf has that leaf as its subroot, and a single source's subroot is the root; without
any sibling the proof is empty. An empty table gives no rows. Texts of any length are digested whole.
Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.plans.stage import staged

#: Fixed by the manifest's form: children per node, and the digested fields in order.
FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Leaves of a block; its own part of the tree has two levels.
BLOCK = FANOUT * FANOUT


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(c: Column) -> Column:
    value = c.cast("string")
    return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf(**changed: Column) -> Column:
    """The digest of a document; `changed` are fields to be taken from elsewhere than their column."""
    return digest(*(field(changed.get(name, F.col(name))) for name in FIELDS))


def joined(nodes: Column) -> Column:
    return F.array_join(nodes, "")


def placed(df: DataFrame, order: list, name: str) -> DataFrame:
    """`df` with `place`, its rows' dense position from 0 in an order that tells all rows apart, and
    `part`, the range they lie in. The table of ranges has a row per shuffle partition."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    rows = staged(rows.withColumn("part", F.shiftright("at", 33)), name)
    parts = rows.groupBy("part").agg(F.min("at").alias("first_at"), F.count(F.lit(1)).alias("n_at"))
    before = F.sum("n_at").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", (F.coalesce(before, F.lit(0)) - F.col("first_at")).alias("shift"))
    return rows.join(F.broadcast(parts), "part").withColumn("place", F.col("at") + F.col("shift")).drop("at", "shift")


def leaf_blocks(docs: DataFrame, claim: Column | None) -> tuple[DataFrame, DataFrame, int]:
    """Blocks (rank, n, block, leaves, nodes, node), sources (rank, n) and the number of sources."""
    source = F.when(F.col("source").isNull(), "0").otherwise(F.concat(F.lit("1"), F.col("source").cast("string")))
    other = F.lit(None).cast("string") if claim is None else claim
    rows = docs.select(*FIELDS).select(source.alias("key"), "doc_id", leaf().alias("leaf"), other.alias("claim"))
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "leaves")
    rows = placed(rows, [F.col("key"), F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("row")], "ordered-leaves")
    sources = rows.groupBy("key").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    sources = staged(placed(sources, [F.col("key")], "ordered-sources").withColumnRenamed("place", "rank").drop("part"), "sources")
    # a source's leaves meet their source range by range, so that a large source is no hot key
    spread = rows.select("key", "part").distinct().join(sources, "key")
    rows = rows.join(spread, ["key", "part"]).withColumn("position", F.col("place") - F.col("first"))
    blocks = rows.groupBy("rank", "n", F.floor(F.col("position") / BLOCK).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("position", "doc_id", "leaf", "claim"))).alias("leaves")
    )
    digests = F.col("leaves.leaf")
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(digests) - 1) / FANOUT).cast("int")), lambda i: F.sha2(joined(F.slice(digests, i * FANOUT + 1, FANOUT)).cast("binary"), 256))
    blocks = blocks.withColumn("nodes", F.when(F.col("n") > 1, runs).otherwise(digests))
    node = F.when(F.col("n") > FANOUT, digest(joined(F.col("nodes")))).otherwise(F.element_at("nodes", 1))
    return staged(blocks.withColumn("node", node), "blocks"), sources.select("rank", "n"), sources.count()


def subtree(mine: Column, count: Column, span: int) -> tuple[Column, Column, Column]:
    """For `digit`, the number of a subtree under the next ancestor of position `mine`: does it exist
    among `count` positions, which position there is asked, and which digit is one's own. A subtree
    has `span` positions, the last one perhaps fewer."""
    start = (F.floor(mine / (span * FANOUT)) * FANOUT + F.col("digit")) * span
    asked = start + (mine % span) % F.least(F.lit(span), count - start)
    return start < count, asked, F.floor(mine / span) % FANOUT


def hashed(state: DataFrame, got: DataFrame, mine: Column) -> DataFrame:
    """`state` one level up: what a block received (`got`: rank, block, digit, sent) is hashed, and the
    nodes besides its own become the next part of its proof."""
    run = got.groupBy("rank", "block").agg(F.sort_array(F.collect_list(F.struct("digit", "sent"))).alias("run"))
    up = state.join(run, ["rank", "block"])
    side = lambda test: joined(F.transform(F.filter("run", test), lambda x: x["sent"]))
    up = up.withColumn("own", mine.cast("int"))
    up = up.withColumn("left", side(lambda x: x["digit"] < F.col("own"))).withColumn("right", side(lambda x: x["digit"] > F.col("own")))
    proof = F.array_append("proof", F.struct("left", "right"))
    return up.select("rank", "blocks", "block", digest("left", "node", "right").alias("node"), proof.alias("proof"), "subroot")


def butterfly(blocks: DataFrame, sources: DataFrame, n_sources: int) -> DataFrame:
    """(rank, block, subroot, node, proof) of every block, where node is the root and proof an array of
    (left, right) siblings' digests per level above the block."""
    empty = F.array().cast("array<struct<left:string,right:string>>")
    count = F.ceil(F.col("n") / BLOCK)
    state = staged(blocks.select("rank", count.alias("blocks"), "block", "node", empty.alias("proof"), F.lit(None).cast("string").alias("subroot")), "state")
    digits = F.explode(F.sequence(F.lit(0), F.lit(FANOUT - 1))).alias("digit")
    most = state.agg(F.max("blocks")).first()[0] or 0
    span = 1
    while span < most:
        more = state.where(F.col("blocks") > span)
        there, asked, own = subtree(F.col("block"), F.col("blocks"), span)
        wants = more.select("rank", "block", "blocks", digits).where(there).select("rank", "block", "digit", asked.alias("asked"))
        sent = state.select("rank", F.col("block").alias("asked"), F.col("node").alias("sent"))
        up = hashed(more, wants.join(sent, ["rank", "asked"]), own)
        state = staged(up.unionByName(state.where(F.col("blocks") <= span)), "state")
        span *= FANOUT
    state = staged(state.withColumn("subroot", F.col("node")), "state") if n_sources > 1 else state.withColumn("subroot", F.col("node"))
    of_source = sources.select(F.col("rank").alias("asked"), F.ceil(F.col("n") / BLOCK).alias("blocks_there"))
    span = 1
    while span < n_sources:
        there, asked, own = subtree(F.col("rank"), F.lit(n_sources), span)
        wants = state.select("rank", "block", digits).where(there).select("rank", "block", "digit", asked.alias("asked"))
        wants = wants.join(of_source, "asked").withColumn("asked_block", F.col("block") % F.col("blocks_there"))
        sent = state.select(F.col("rank").alias("asked"), F.col("block").alias("asked_block"), F.col("node").alias("sent"))
        state = staged(hashed(state, wants.join(sent, ["asked", "asked_block"]).select("rank", "block", "digit", "sent"), own), "state")
        span *= FANOUT
    return state.select("rank", "block", "subroot", "node", "proof")


def manifest(docs: DataFrame, claim: Column | None = None) -> DataFrame:
    """A row per document: doc_id, leaf, subroot, root, proof (siblings' digests as (left, right) pairs
    from the leaf's level up) and folded_root, the root that follows from the claimed leaf (`claim`,
    over the documents' columns; where null, the leaf itself) and the proof."""
    blocks, sources, n_sources = leaf_blocks(docs, claim)
    whole = blocks.join(butterfly(blocks, sources, n_sources).withColumnRenamed("node", "root"), ["rank", "block"])
    digests, nodes, n = F.col("leaves.leaf"), F.col("nodes"), F.col("n")
    pair = lambda left, right: F.array(F.struct(joined(left).alias("left"), joined(right).alias("right")))
    none = F.array().cast("array<struct<left:string,right:string>>")

    def proved(x: Column, i: Column) -> Column:
        run, k = F.floor(i / FANOUT).cast("int"), i % FANOUT
        low = F.when(n > 1, pair(F.slice(digests, i - k + 1, k), F.slice(digests, i + 2, FANOUT - 1 - k))).otherwise(none)
        high = F.when(n > FANOUT, pair(F.slice(nodes, F.lit(1), run), F.slice(nodes, run + 2, F.lit(FANOUT)))).otherwise(none)
        return F.struct(x["doc_id"].alias("doc_id"), x["leaf"].alias("leaf"), F.coalesce(x["claim"], x["leaf"]).alias("claim"), F.concat(low, high, F.col("proof")).alias("proof"))

    rows = whole.select("subroot", "root", F.inline(F.transform("leaves", proved)))
    folded = F.aggregate("proof", F.col("claim"), lambda node, x: digest(x["left"], node, x["right"]))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof", folded.alias("folded_root"))


def tampered_leaf() -> Column:
    """The leaf after A-Z of the text are lower-cased, where 5 divides the CRC-32 of the id; else null."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, leaf(text=F.translate("text", upper, upper.lower())))


def audit(docs: DataFrame) -> DataFrame:
    """The manifest checked against documents of which some are tampered with: proofs as one digest,
    and whether the folded root is the root."""
    proof = F.sha2(joined(F.transform("proof", lambda x: F.concat(x["left"], x["right"]))).cast("binary"), 256)
    rows = manifest(docs, tampered_leaf())
    return rows.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
