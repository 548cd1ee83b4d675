"""Near-duplicate classes by DartMinHash signatures, banded joining and exact verification.

A text is the weighted set of its shingles of five words (lower-cased letters, digits and
non-ASCII characters), a shingle weighing as often as it occurs; a text of one to four words has
one shingle. Similarity is weighted Jaccard: shared weight over joint weight; links need 0.8.

Signature: for every element darts are thrown at the plane of weight and rank, cut into regions
(powers of two in both directions), with a Poisson number of darts per unit of area. Number, weight,
rank and coordinate of a region's darts are hashes of element and region, so equal elements get
equal darts in any text. A text keeps darts below its elements' weights, up to a rank that makes
about k log k of them, and of each of the k coordinates the dart of least rank. Where a coordinate
stays empty, the rank is doubled. The chance that a coordinate agrees in two texts is their
similarity.

Classes:

1. Texts with equal shingle weights become one node, whatever their ids.
2. A node is put into one bucket per band of its signature. Every node of a bucket is compared
   with the bucket's pivot, the node that shares the most bucket entries with others: buckets give
   as many pairs as nodes, however large, and in a group of near copies the pivot is close to what
   they are copies of.
3. Similar pairs are links; their connected components are found.
4. Pairs of one bucket in different components are still to be compared. In buckets of up to
   `small` nodes they become rows; by the triangle inequality of the distance 1 - similarity, only
   those whose distances to the pivot differ by at most 0.2.
   In larger buckets the nodes outside the bucket's largest component meet all of its nodes in
   blocks, and a block returns, of the links it finds, one for each node and component.
5. Buckets with more than `block` nodes outside their largest component are thinned before that by a
   prefix filter: in the order of how many nodes have a unit of weight, rarest first, the first
   n - ceil(0.8 n) + 1 of a node's n units must hold one of a similar node's. Nodes without such a
   unit in common with another component leave, so that texts which share a passage and nothing else
   are not compared in pairs. The components are joined by the links of both steps.

So every two texts that share a bucket are compared, are in one component already, or cannot be
similar: nothing is capped, and groups of near copies never turn into rows for all their pairs. At
24 bands of 4, two texts at the threshold share no bucket with probability 3e-6, more similar ones
less.

Texts without words (null and empty ones too) are in a class with equal texts only; null is as
empty. Rows with a null id are left out of the result. Repeated rows of an id give one row; rows of
one id with different texts are nodes of their own, and give a row for each class that they are in.
Texts are read whole, however long. An empty table gives no rows. Ties for the pivot are told apart
by a hash. Columns other than id and text are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.text import ALNUM, Words, blocks, buffers, find_words, grams, mix, sums, unit
from meterflow.plans.components import connected_components
from meterflow.plans.stage import release, staged

#: Bytes of a node's row besides its id.
ID_BYTES = 40

_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)
#: Upper end of the lowest rank layer; every further layer is as wide as all below it.
_LOWEST = 2.0**-4


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    similarity: float = 0.8
    bands: int = 24
    rows: int = 4
    #: buckets of more nodes are compared in blocks of about `block` nodes
    small: int = 12
    block: int = 256
    #: most nodes (some 100 bytes each) whose ids are broadcast
    broadcast: int = 16 << 20  # bytes of ids

    @property
    def k(self) -> int:
        return self.bands * self.rows


def shingles(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every shingle, by text and place; a text of fewer than n words has one."""
    at, g = grams(w.hash, w.last, n)
    row = w.row[at]
    size = np.diff(w.first)
    short = np.flatnonzero((size > 0) & (size < n))
    if len(short):
        h = np.zeros(len(short), _U)
        for j in range(n - 1):
            more = size[short] > j
            h[more] = mix(h[more]) + w.hash[w.first[short[more]] + j]
        row, g = np.concatenate([row, short]), np.concatenate([g, mix(h + _U(17))])
        order = np.argsort(row, kind="stable")
        row, g = row[order], g[order]
    return row, g


def weighted(row: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, element, weight) of distinct elements, sorted by text and element."""
    order = np.lexsort((g, row))
    row, g = row[order], g[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    return row[first], g[first], np.diff(np.append(first, len(g))).astype(np.float64)


def _poisson(u: np.ndarray, area: float) -> np.ndarray:
    """Poisson numbers of mean `area` from uniform ones."""
    term, cdf, i = np.exp(-area), [], 0
    if term == 0.0:  # areas beyond some 700: the sum of parts of it
        half = _poisson(u, area / 2)
        return half + _poisson(unit(mix((u * 2.0**53).astype(_U))), area / 2)
    total = term
    while total < 1 - 1e-15 and i < 20 * area + 60:
        cdf.append(total)
        i += 1
        term *= area / i
        total += term
    return np.searchsorted(np.array(cdf), u, "right")


def _darts(row, element, weight, reach, k):
    """(text * k + coordinate, rank and identity in one number) of the darts below weight and reach."""
    out_at, out_val = [], []
    layer, lo, hi = 0, 0.0, _LOWEST
    while len(row):
        open_ = reach[row] > lo
        row, element, weight = row[open_], element[open_], weight[open_]
        r, e, w, stratum, wlo, whi = row, element, weight, 0, 0.0, 1.0
        while len(r):
            cell = mix(e ^ mix(np.array([layer * 1000 + stratum + 1], _U) * _GOLD))
            n = _poisson(unit(cell), (hi - lo) * (whi - wlo))
            i = np.repeat(np.arange(len(r)), n)
            d = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
            x = mix(cell[i] + (d + 1).astype(_U) * _GOLD)
            rank = (lo + (hi - lo) * unit(x)).astype(np.float32)
            y = mix(x + _GOLD)
            ok = rank < reach[r[i]].astype(np.float32)
            if whi > 1.0 or (w < 1.0).any():
                ok &= wlo + (whi - wlo) * unit(y) < w[i]
            i, x, rank = i[ok], mix(y[ok] + _GOLD), rank[ok]
            out_at.append(r[i] * k + (x % _U(k)).astype(np.int64))
            out_val.append((rank.view(np.uint32).astype(_U) << _U(32)) | (x >> _U(32)))
            more = w > whi
            r, e, w = r[more], e[more], w[more]
            stratum, wlo, whi = stratum + 1, whi, 2 * whi
        layer, lo, hi = layer + 1, hi, 2 * hi
    return np.concatenate(out_at), np.concatenate(out_val)


def signatures(row: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, k: int) -> np.ndarray:
    """n rows of k darts (least rank first in the number, then identity); texts without elements get the largest number."""
    none = _U(2**64 - 1)
    sig = np.full(n * k, none)
    total = np.bincount(row, weight, n)
    with np.errstate(divide="ignore"):
        reach = k * (np.log(k) + 5) / total
    todo = total > 0
    while todo.any():
        use = todo[row]
        at, val = _darts(row[use], element[use], weight[use], reach, k)
        np.minimum.at(sig, at, val)
        todo &= (sig.reshape(n, k) == none).any(1)
        reach = np.where(todo, 2 * reach, reach)
    return sig.reshape(n, k)


def sketches(docs: DataFrame, id_col: str, text_col: str, s: Settings) -> DataFrame:
    """(id, key_1, key_2, bands array<long>): two hashes of the weighted set, and a hash per band."""

    def run(batches):
        for batch in batches:
            offs, data = buffers(batch.column("text"))
            for lo, hi in blocks(offs, 1 << 20):
                n = hi - lo
                row, element, weight = weighted(*shingles(find_words(offs[lo : hi + 1], data, ALNUM), s.shingle))
                first = np.searchsorted(row, np.arange(n + 1))
                keys = set_keys(element, weight, first)
                bare = np.flatnonzero(first[1:] == first[:-1])
                for i in bare:  # no words: the text itself is the key
                    raw = np.frombuffer(data[offs[lo + i] : offs[lo + i + 1]].tobytes() + b"\x01", np.uint8).astype(_U)
                    h = mix(mix(raw + np.arange(len(raw), dtype=_U) * _GOLD).sum(dtype=_U))
                    keys[0][i], keys[1][i] = h, mix(h)
                sig = signatures(row, element, weight, n, s.k).reshape(n, s.bands, s.rows)
                h = np.full((n, s.bands), _GOLD)
                for j in range(s.rows):
                    h = mix(h) + sig[:, :, j]
                ends = np.append(0, np.cumsum(np.where(first[1:] > first[:-1], s.bands, 0)))
                bands = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(mix(h)[first[1:] > first[:-1]].ravel().view(np.int64)))
                cols = [batch.column("id").slice(lo, n), *(pa.array(x.view(np.int64)) for x in keys), bands]
                yield pa.RecordBatch.from_arrays(cols, ["id", "key_1", "key_2", "bands"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id is not null")
    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, key_1 long, key_2 long, bands array<long>")


def set_keys(element: np.ndarray, weight: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Two hashes of every weighted set."""
    unit_hash = mix(element + weight.astype(_U) * _GOLD)
    return [sums(unit_hash, first), sums(mix(unit_hash + _GOLD), first)]


def unit_elements(texts: DataFrame, s: Settings) -> DataFrame:
    """(node, units array<long>) of the rows (node, key_1, key_2, text) whose text has these keys: a
    hash for each unit of weight, so that sharing units is sharing weight."""

    def run(batches):
        for batch in batches:
            offs, data = buffers(batch.column("text"))
            for lo, hi in blocks(offs, 1 << 20):
                row, element, weight = weighted(*shingles(find_words(offs[lo : hi + 1], data, ALNUM), s.shingle))
                first = np.searchsorted(row, np.arange(hi - lo + 1))
                n = weight.astype(np.int64)
                nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                units = mix(np.repeat(element, n) + nth.astype(_U) * _GOLD).view(np.int64)
                ends = np.append(0, np.cumsum(np.bincount(row, n, hi - lo).astype(np.int64)))
                own = np.ones(hi - lo, bool)
                for name, key in zip(("key_1", "key_2"), set_keys(element, weight, first)):
                    own &= batch.column(name).slice(lo, hi - lo).to_numpy() == key.view(np.int64)
                out = pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(units))], ["node", "units"]
                )
                yield out.filter(pa.array(own))

    found = texts.select("node", "key_1", "key_2", "text").mapInArrow(run, "node long, units array<long>")
    return found.groupBy("node").agg(F.first("units").alias("units"))


def similarities(pairs: DataFrame, units: DataFrame) -> DataFrame:
    """`pairs` (a, b) with their exact weighted Jaccard similarity."""
    left = pairs.join(units.select(F.col("node").alias("b"), F.col("units").alias("ub")), "b")
    both = left.join(units.select(F.col("node").alias("a"), F.col("units").alias("ua")), "a")
    shared = F.size(F.array_intersect("ua", "ub"))
    return both.select("a", "b", (shared / (F.size("ua") + F.size("ub") - shared)).alias("similarity"))


def _merge(component: DataFrame, compared: DataFrame, s: Settings) -> DataFrame:
    """`component` (node, component) after joining the components that similar pairs link."""
    of = lambda end, name: component.select(F.col("node").alias(end), F.col("component").alias(name))
    links = compared.where(F.col("similarity") >= s.similarity).join(of("a", "src"), "a").join(of("b", "dst"), "b").where("src <> dst").select("src", "dst")
    joined = connected_components(links).select(F.col("id").alias("component"), F.col("component").alias("into"))
    return staged(component.join(joined, "component", "left").select("node", F.coalesce("into", "component").alias("component")), "components")


def rare_partners(dense: DataFrame, units: DataFrame, s: Settings) -> DataFrame:
    """(node): the nodes of `dense` (node, component) that share a unit of their prefixes with a node
    of another component. All others are similar to none of another component."""
    n = F.size("units")
    each = dense.join(units, "node").select("node", "component", F.ceil(n * s.similarity - 1e-9).cast("int").alias("least"), F.explode("units").alias("unit"))
    shared = staged(each.groupBy("unit").agg(F.count("*").alias("c")).where("c > 1"), "shared")
    mine = each.join(shared, "unit")
    # units that no other node has come first: `c > 1` ones begin at place n - m, so m - least + 1 of them are in the prefix
    own = Window.partitionBy("node")
    mine = mine.withColumn("m", F.count("*").over(own)).where("m >= least").withColumn("place", F.row_number().over(own.orderBy("c", "unit")))
    prefix = staged(mine.where("place <= m - least + 1").select("node", "component", "unit"), "prefix")
    mixed = prefix.groupBy("unit").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("unit")
    found = staged(prefix.join(staged(mixed, "mixed units"), "unit", "left_semi").select("node").distinct(), "partners")
    release(shared, prefix)
    return found


def _block_links(similarity: float):
    """For applyInPandas: links between the rows of side "l" and those of side "r", one per left
    node and right component."""

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        left, right = rows[rows["side"] == "l"], rows[rows["side"] == "r"]
        out: list[tuple] = []
        sizes = right["units"].map(len).to_numpy(np.int64)
        if len(left) and sizes.sum():
            owner = np.repeat(np.arange(len(right)), sizes)
            units = np.concatenate(right["units"].to_list())
            order = np.argsort(units, kind="stable")
            units, owner = units[order], owner[order]
            component, node = right["component"].to_numpy(), right["node"].to_numpy()
            for a, own, mine in zip(left["node"], left["component"], left["units"]):
                lo, hi = np.searchsorted(units, mine, "left"), np.searchsorted(units, mine, "right")
                n = hi - lo
                at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                shared = np.bincount(owner[at], minlength=len(right))
                score = shared / (len(mine) + sizes - shared)
                for j in np.flatnonzero((score >= similarity) & (component != own))[::-1]:
                    out.append((a, node[j], component[j]))
        found = pd.DataFrame(out, columns=["a", "b", "component"]).drop_duplicates(["a", "component"], keep="last")
        return found[["a", "b"]]

    return links


def shapes(large: DataFrame, s: Settings) -> DataFrame:
    """(band, hash, main, nl, nr) of the buckets of several components: the largest component, the
    numbers of blocks for the nodes outside of it and for all nodes."""
    per = large.groupBy("band", "hash", "component").agg(F.count("*").alias("n"))
    shape = per.groupBy("band", "hash").agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("main")).where("n > main.n")
    blocks_of = lambda n: F.ceil(n / s.block).cast("int")
    main = F.col("main.component").alias("main")
    return staged(shape.select("band", "hash", main, blocks_of(F.col("n") - F.col("main.n")).alias("nl"), blocks_of(F.col("n")).alias("nr")), "shape")


def block_pairs(large: DataFrame, shape: DataFrame, units: DataFrame, s: Settings) -> DataFrame:
    """(a, b): links across components in the buckets in `shape` of entries (band, hash, node, component), found in blocks."""
    rows = large.select("band", "hash", "node", "component").join(shape, ["band", "hash"]).join(units, "node")
    mine = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    left = rows.where("component <> main").withColumn("bl", mine(F.col("nl"))).withColumn("br", F.explode(F.sequence(F.lit(0), F.col("nr") - 1)))
    right = rows.withColumn("br", mine(F.col("nr"))).withColumn("bl", F.explode(F.sequence(F.lit(0), F.col("nl") - 1)))
    cols = ["band", "hash", "bl", "br", "node", "component", "units"]
    both = left.select(F.lit("l").alias("side"), *cols).unionByName(right.select(F.lit("r").alias("side"), *cols))
    return both.groupBy("band", "hash", "bl", "br").applyInPandas(_block_links(s.similarity), "a long, b long").distinct()


def duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(id_col, class_id, representative boolean): one row per id; class_id is the smallest id of the
    class of near copies, exact copies included, and its document is the representative."""
    s = settings
    sketch = staged(sketches(docs, id_col, text_col, s), "sketches")
    # counts per key or bucket are written before they are joined to the rows they were counted from:
    # the join then has an exchange of its own on both sides, and Spark can split a hot key
    texts = sketch.groupBy("key_1", "key_2").agg(F.min("id").alias("id"), F.first("bands").alias("bands"))
    nodes = staged(texts.withColumn("node", F.monotonically_increasing_id()), "nodes")
    spread = nodes.select("node", F.posexplode("bands").alias("band", "hash"))
    # buckets of two or more nodes, with the pivot of each
    sizes = staged(spread.groupBy("band", "hash").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    entries = staged(spread.join(sizes, ["band", "hash"]), "entries")
    weight = staged(entries.groupBy("node").agg(F.sum("n").alias("weight")), "weight")
    wanted = weight.select("node")
    heavy = F.max_by("node", F.struct(F.col("weight"), F.xxhash64("node")))
    pivots = staged(entries.join(weight, "node").groupBy("band", "hash").agg(heavy.alias("pivot")), "pivots")
    members = staged(entries.join(pivots, ["band", "hash"]), "members")
    release(sizes, entries, pivots)
    of_ids = staged(nodes.drop("bands").join(wanted, "node", "left_semi"), "wanted")
    # texts meet the ids of nodes where they are, if these are few; else both are shuffled
    size = of_ids.agg(F.sum(F.coalesce(F.octet_length(F.col("id").cast("string")), F.lit(0)) + ID_BYTES)).first()[0] or 0
    here = F.broadcast(of_ids) if size <= s.broadcast else of_ids
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(here, "id")
    units = staged(unit_elements(rows, s), "units")
    first_pairs = members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    compared = staged(similarities(first_pairs, units), "compared")
    component = _merge(wanted.withColumn("component", F.col("node")), compared, s)
    placed = members.join(component, "node")
    mixed = placed.groupBy("band", "hash").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("band", "hash")
    mixed = staged(mixed, "mixed")
    placed = staged(placed.join(mixed, ["band", "hash"], "left_semi"), "placed")
    to_pivot = compared.select(F.col("a").alias("pivot"), F.col("b").alias("node"), (1 - F.col("similarity")).alias("d"))
    rest = placed.where((F.col("n") <= s.small) & (F.col("node") != F.col("pivot"))).join(to_pivot, ["pivot", "node"])
    x = rest.select("band", "hash", F.col("node").alias("a"), F.col("d").alias("da"), F.col("component").alias("ca"))
    y = rest.select("band", "hash", F.col("node").alias("b"), F.col("d").alias("db"), F.col("component").alias("cb"))
    near = F.abs(F.col("da") - F.col("db")) <= 1 - s.similarity + 1e-9
    pairs = x.join(y, ["band", "hash"]).where("a < b and ca <> cb").where(near).select("a", "b")
    large = placed.where(F.col("n") > s.small)
    shape = shapes(large, s)
    pairs = pairs.unionByName(block_pairs(large, shape.where("nl = 1"), units, s))
    wide = shape.where("nl > 1").select("band", "hash")
    if not wide.isEmpty():
        crowded = large.join(wide, ["band", "hash"], "left_semi")
        thinned = crowded.join(rare_partners(crowded.select("node", "component").distinct(), units, s), "node", "left_semi")
        pairs = pairs.unionByName(block_pairs(thinned, shapes(thinned, s), units, s))
    more = staged(similarities(pairs.distinct(), units), "compared")
    merged = _merge(component, more, s)
    release(members, weight, units, compared, mixed, placed, shape, more, component)
    lead = of_ids.select("node", "id").join(merged, "node").groupBy("component").agg(F.min("id").alias("class_id"))
    of_nodes = staged(merged.join(staged(lead, "leads"), "component").select("node", "class_id"), "of nodes")
    by_key = nodes.select("key_1", "key_2", "id", "node").join(of_nodes, "node", "left")
    by_key = staged(by_key.select("key_1", "key_2", F.coalesce("class_id", "id").alias("class_id")), "classes")
    release(nodes, of_ids, merged, of_nodes)
    classed = sketch.select("id", "key_1", "key_2").join(by_key, ["key_1", "key_2"])
    return classed.select(F.col("id").alias(id_col), "class_id").distinct().withColumn("representative", F.col(id_col) == F.col("class_id"))
