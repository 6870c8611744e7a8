"""Near duplicates by BagMinHash: weighted-Jaccard signatures of word shingles, banded and verified.

A text is the multiset of its runs of ``SHINGLE`` words (lower-cased A-Z; a shorter text is one
shingle).  The likeness of two texts is the weighted Jaccard index of their multisets.

Signatures.  Each shingle has a Poisson process of unit rate over (weight, time); a point counts for a
text if its weight lies below the shingle's count.  Component ``i`` of the signature is the earliest
point that falls to it, so two texts agree there with a probability equal to their likeness, without
bias.  Points come from a hierarchy over the discretised weights (0,1], (1,2], (2,4], (4,8], ...: a
node yields one point and then splits in halves, of which those at or above the count are not followed,
so a count of w costs about log w.  Only points up to a time that fills the signature are made.

Candidates and links.  Texts that agree in a band meet in its bucket.  Within a bucket everyone is first compared to
the first and the last member only, and what the true multiset overlap confirms is linked.  Members of
one bucket that are in different classes after that are all compared, large buckets inside a task by an
index that returns links only, so no pair that shares a bucket is passed over and no group's pairs are rows.

Edge cases.  Null text is empty.  Equal texts are one node of the graph, whatever their ids, and
always share a class; a text without words is like its equals only.  A null id is kept, and
a class is named by its smallest id (null if it has no other).  Repeated rows each have a row in the result.
Only the two named columns are read, so further columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.blocks import GOLDEN, Words, in_blocks, list_array, mixed, runs, unit
from footfall.runtime import stored

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 25, 5   # a pair of likeness 0.8 meets in a band with probability 0.99995
SMALL, CHUNK = 8, 2000
SIGN_BYTES, UNIT_BYTES = 2 << 20, 1 << 20   # of text worked on at once
U = np.uint64
NODE = "node binary"


def occurrences(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shingles of a block: (hash, how many equal ones came before it in its text, ends of texts).

    Sorted within each text, so equal shingles of a text stand together.
    """
    word = words.hashes()[words.ids] if len(words.ids) else np.empty(0, U)
    starts, ends = words.starts, words.ends
    factors = mixed(np.arange(1, SHINGLE + 1, dtype=U) * GOLDEN) | U(1)
    inside = max(0, len(word) - SHINGLE + 1)
    joined = np.zeros(inside, U)
    for k in range(SHINGLE):
        joined += word[k:k + inside] * factors[k]
    joined = mixed(joined)
    parts = []
    for start, end in zip(starts.tolist(), ends.tolist()):
        if end - start >= SHINGLE:
            parts.append(np.sort(joined[start:end - SHINGLE + 1]))
        elif end > start:
            short = (word[start:end] * factors[:end - start]).sum(dtype=U) + U(end - start)
            parts.append(mixed(np.array([short], U)))
        else:
            parts.append(np.empty(0, U))
    sizes = np.array([len(p) for p in parts], np.int64)
    shingles = np.concatenate(parts) if parts else np.empty(0, U)
    stops = np.cumsum(sizes)
    new = np.ones(len(shingles), bool)
    new[1:] = shingles[1:] != shingles[:-1]
    first = stops - sizes
    new[first[sizes > 0]] = True
    runs = np.flatnonzero(new)
    before = np.arange(len(shingles)) - np.repeat(runs, np.diff(np.append(runs, len(shingles))))
    return shingles, before, stops


def units(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Each text's multiset as a sorted set of hashes, the k-th copy of a shingle having a hash of its own."""
    shingles, before, stops = occurrences(words)
    keys = mixed(shingles + before.astype(U) * GOLDEN)
    start = 0
    for stop in stops.tolist():
        keys[start:stop].sort()
        start = stop
    return keys, stops


class Processes:
    """Poisson processes of many nodes: their text, seed, interval of weights, next point and its component."""

    def __init__(self, text, seed, low, width, weight, m):
        self.text, self.seed, self.low, self.width, self.weight, self.m = text, seed, low, width, weight, m
        self.time, self.count = np.zeros(len(text)), np.zeros(len(text), U)
        self.point = np.zeros(len(text), U)

    def next(self, where=slice(None)) -> None:
        """Move the chosen nodes to their next point."""
        self.count[where] += U(1)
        point = mixed(self.seed[where] + self.count[where] * GOLDEN)
        self.time[where] -= np.log(unit(point)) / self.width[where]
        self.point[where] = mixed(point ^ GOLDEN)

    def kept(self, mask: np.ndarray) -> Processes:
        out = object.__new__(Processes)
        out.m = self.m
        for name in ("text", "seed", "low", "width", "weight", "time", "count", "point"):
            setattr(out, name, getattr(self, name)[mask])
        return out

    def halves(self, emitted: np.ndarray) -> list[Processes]:
        """Both halves of each node; the half with the node's point goes on from it."""
        upper = (mixed(self.seed ^ GOLDEN) & U(1)).astype(bool)
        out = []
        for side in (False, True):
            half = self.kept(np.ones(len(self.text), bool))
            half.width = self.width / 2
            half.low = self.low + half.width * side
            half.seed = mixed(self.seed + U(2 + side) * GOLDEN)
            half.count = np.zeros(len(self.text), U)
            half.next(np.flatnonzero((upper != side) | emitted))
            out.append(half)
        return out


def joined(parts: list[Processes]) -> Processes:
    out = parts[0].kept(slice(None))
    for name in ("text", "seed", "low", "width", "weight", "time", "count", "point"):
        setattr(out, name, np.concatenate([getattr(p, name) for p in parts]))
    return out


def signatures(shingles: np.ndarray, weight: np.ndarray, text: np.ndarray, n_texts: int, m: int) -> np.ndarray:
    """The ``m`` components of each text; ``text`` names the text that a (distinct) shingle and its count belong to.

    A text without shingles has zeros.
    """
    total = np.bincount(text, weight, n_texts)
    signature = np.zeros((n_texts, m), U)
    with np.errstate(divide="ignore", over="ignore"):
        limit = m * (math.log(m) + 4) / total
        open_texts = total > 0
        while open_texts.any():
            mine = open_texts[text]
            filled, found = first_points(shingles[mine], weight[mine], text[mine], limit, n_texts, m)
            done = open_texts & filled
            signature[done] = found[done]
            open_texts &= ~filled
            limit = limit * 2
    return signature


def first_points(shingles, weight, text, limit, n_texts, m) -> tuple[np.ndarray, np.ndarray]:
    """Whether points up to ``limit`` fill a text's signature, and the earliest of each component."""
    live, low = [], 0
    while True:
        width = max(1, low)
        above = np.flatnonzero(weight > low)
        if not len(above):
            break
        block = Processes(text[above], mixed(shingles[above] + U(low) * GOLDEN), np.full(len(above), low),
                          np.full(len(above), float(width)), weight[above], m)
        block.next()
        live.append(block)
        low += width
    earliest = np.full(n_texts * m, np.inf)
    slots, times, points = [], [], []
    now = joined(live) if live else None
    while now is not None and len(now.text):
        now = now.kept((now.time <= limit[now.text]) & (now.low < now.weight))
        inside = now.low + now.width <= now.weight
        slot = now.text[inside].astype(np.int64) * m + (now.point[inside] % U(m)).astype(np.int64)
        np.minimum.at(earliest, slot, now.time[inside])
        slots.append(slot)
        times.append(now.time[inside])
        points.append(now.point[inside])
        leaf = now.width <= 1
        leaves = now.kept(leaf)
        leaves.next()
        now = joined([leaves, *now.kept(~leaf).halves(inside[~leaf])])
    found = np.zeros(n_texts * m, U)
    if slots:
        slot, time, point = np.concatenate(slots), np.concatenate(times), np.concatenate(points)
        first = time == earliest[slot]
        found[slot[first]] = point[first]
    return np.isfinite(earliest).reshape(n_texts, m).all(axis=1), found.reshape(n_texts, m)


def band_hashes(texts: list[bytes], bands: int = BANDS, rows: int = ROWS) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each text in each band, and which texts have words."""
    words = Words(texts)
    shingles, before, stops = occurrences(words)
    sizes = np.diff(stops, prepend=0)
    starts = np.flatnonzero(before == 0)
    weight = np.diff(np.append(starts, len(shingles)))
    owner = np.repeat(np.arange(len(texts)), sizes)
    signature = signatures(shingles[starts], weight, owner[starts], len(texts), bands * rows)
    out = np.zeros((len(texts), bands), U)
    for band in range(bands):
        key = mixed(np.full(len(texts), band + 1, U))
        for row in range(rows):
            key = mixed(key ^ signature[:, band * rows + row])
        out[:, band] = key
    return out, sizes > 0


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in in_blocks(batches, "text", SIGN_BYTES):
        keys, has_words = band_hashes(texts)
        ends = np.cumsum(np.where(has_words, BANDS, 0))
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), rows.column(1), list_array(keys[has_words].ravel().view(np.int64), ends)],
            ["id", "node", "bands"])


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in in_blocks(batches, "text", UNIT_BYTES):
        keys, ends = units(Words(texts))
        yield pa.RecordBatch.from_arrays([rows.column(0), list_array(keys.view(np.int64), ends)], ["node", "units"])


def node_of(text: str):
    """Equal texts are one node: the MD5 of the whole text."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def confirmed(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose multisets overlap enough; ``texts`` has (node, n, units)."""
    a = texts.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("units").alias("ua"))
    b = texts.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("units").alias("ub"))
    both = pairs.join(a, "a").join(b, "b").where(F.least("na", "nb") >= F.greatest("na", "nb") * similarity)
    common = F.size(F.array_intersect("ua", "ub"))
    return both.where(common >= similarity * (F.col("na") + F.col("nb") - common)).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """The connected components of links (a, b): (node, label), for the nodes that have a link.

    Each round every node takes the smallest label among itself and its neighbours, then the label
    of that label.  Rounds are written to the shared folder, so lineage stays short.
    """
    links = links.union(links.select("b", "a")).toDF("a", "b").distinct()
    links = stored(links, "links")
    labels = stored(links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
                    .select("node", F.least("node", "b").alias("label")), "labels")
    while True:
        near = (links.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        closer = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("next"))
        step = stored(closer.join(jump, "new", "left").select(
            "node", "label", F.coalesce(F.least("new", "next"), "new").alias("new")), "labels")
        moved = step.where(F.col("label") != F.col("new")).limit(1).count()
        labels = step.select("node", F.col("new").alias("label"))
        if not moved:
            return labels


def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
            similarity: float = SIMILARITY) -> DataFrame:
    """Every row's (id, node, label, class_id, class_size): its class of near duplicates and how many rows that has.

    ``label`` tells classes apart even if ids are repeated or null.

    Runs jobs while it is called; what they find is in the shared folder.
    """
    docs = docs.select(F.col(id_col).alias("id"), node_of(text).alias("node"), F.col(text).alias("text"))
    signed = stored(docs.mapInArrow(_signed, f"id {dict(docs.dtypes)['id']}, {NODE}, bands array<bigint>"), "signed")
    nodes = signed.groupBy("node").agg(F.min("id").alias("id"), F.first("bands").alias("bands"))
    in_bands = nodes.select("node", "id", F.explode("bands").alias("band"))
    shared = in_bands.groupBy("band").agg(
        F.min("node").alias("first"), F.max("node").alias("last")).where("first != last")
    members = stored(in_bands.join(shared, "band"), "members")

    wanted = members.select("node", "id").distinct()
    rows = docs.alias("d").join(wanted.alias("w"), (F.col("d.node") == F.col("w.node"))
                                & F.col("d.id").eqNullSafe(F.col("w.id")), "left_semi")
    texts = rows.select("node", "text").mapInArrow(_units, f"{NODE}, units array<bigint>")
    texts = stored(texts.dropDuplicates(["node"]).withColumn("n", F.size("units")), "units")

    ends = members.select("node", F.explode(F.array("first", "last")).alias("end")).where("node != end")
    pairs = ends.select(F.least("node", "end").alias("a"), F.greatest("node", "end").alias("b")).distinct()
    links = stored(confirmed(pairs, texts, similarity), "links")
    labels = components(links)

    rest = stored(_rest(members, labels, pairs, texts, similarity), "links")
    if rest.limit(1).count():
        labels = components(links.union(rest))
    label = F.coalesce("label", "node")
    found = signed.select("id", "node").join(labels, "node", "left").select("id", "node", label.alias("label"))
    found = stored(found, "found")
    per_class = found.groupBy("label").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return found.join(per_class, "label").select("id", "node", "label", "class_id", "class_size")


def _rest(members: DataFrame, labels: DataFrame, pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links between members of a bucket that are in different classes so far.

    Buckets of up to ``SMALL`` members give the pairs to compare.  In larger ones members are compared inside a task,
    which returns only links that join classes.  Above ``CHUNK`` members a bucket is cut by a hash in chunks, and
    each pair of chunks is a task's group: a member goes to as many groups as there are chunks.
    """
    named = members.join(labels, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label"))
    open_bands = (named.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                            F.count(F.lit(1)).alias("size")).where("low != high").select("band", "size"))
    named = stored(named.join(open_bands, "band"), "unsettled")

    small = named.where(F.col("size") <= SMALL)
    a = small.select("band", F.col("node").alias("a"), F.col("label").alias("la"))
    b = small.select("band", F.col("node").alias("b"), F.col("label").alias("lb"))
    few = a.join(b, "band").where("a < b and la != lb").select("a", "b").distinct().join(pairs, ["a", "b"], "left_anti")

    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    large = named.where(F.col("size") > SMALL).withColumn("chunk", F.pmod(F.xxhash64("node"), chunks).cast("int"))
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    large = large.select("band", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
                         "node", "label").join(texts.select("node", "units"), "node")

    def compare(group: pa.Table) -> pa.Table:
        return joining(group["node"].to_pylist(), group["label"].to_pylist(), group["units"], similarity)

    return confirmed(few, texts, similarity).union(
        large.groupBy("band", "i", "j").applyInArrow(compare, "a binary, b binary"))


def joining(nodes: list[bytes], labels: list[bytes], units: pa.ChunkedArray, similarity: float) -> pa.Table:
    """The links that join classes of a group's members, found from an index of which members have a unit.

    Members of the largest class are looked up by the others, not among themselves.
    """
    flat = units.combine_chunks()
    if isinstance(flat, pa.ChunkedArray):
        flat = pa.concat_arrays(flat.chunks)
    sizes = flat.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    kinds, unit_of = np.unique(flat.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
    order = np.argsort(unit_of, kind="stable")
    member = np.repeat(np.arange(len(nodes)), sizes)[order]
    stops = np.cumsum(np.bincount(unit_of, minlength=len(kinds)))
    starts = np.concatenate([[0], stops[:-1]]) if len(stops) else stops
    names, root = np.unique(np.array(labels, object), return_inverse=True)
    largest = int(np.argmax(np.bincount(root)))
    out_a, out_b = [], []
    for x in np.flatnonzero(root != largest).tolist():
        mine = unit_of[ends[x] - sizes[x]:ends[x]]
        common = np.bincount(member[runs(starts, stops - starts, mine)], minlength=len(nodes))
        like = common >= similarity * (sizes[x] + sizes - common)
        for y in np.flatnonzero(like & (root != root[x])).tolist():
            if root[y] != root[x]:
                out_a.append(min(nodes[x], nodes[y]))
                out_b.append(max(nodes[x], nodes[y]))
                root[root == root[x]] = root[y]
    return pa.table({"a": pa.array(out_a, pa.binary()), "b": pa.array(out_b, pa.binary())})


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, class, the size of the class, and whether it is the one that stays.

    The row with the smallest id of a class stays (all of them if that id is repeated).
    """
    found = classes(docs, id_col, text)
    return found.select(F.col("id").alias(id_col), "class_id", "class_size",
                        F.col("id").eqNullSafe(F.col("class_id")).alias("kept"))


def unused(docs: DataFrame, name: str) -> str:
    """The name, or with underscores before it if ``docs`` has such a column."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = "_" + name
    return name


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each class, all columns; of repeated rows one stays."""
    found = classes(docs, id_col, text)
    stay = (found.where(F.col("id").eqNullSafe(F.col("class_id"))).groupBy("label", "class_id")
            .agg(F.min("node").alias("keep_node")))
    of_id, of_node, copy = (unused(docs, name) for name in ("keep_id", "keep_node", "copy"))
    stay = stay.select(F.col("class_id").alias(of_id), F.col("keep_node").alias(of_node))
    kept = docs.join(stay, F.col(id_col).eqNullSafe(F.col(of_id)) & (node_of(text) == F.col(of_node)), "left_semi")
    if not found.groupBy("id", "node").count().where("count > 1").limit(1).count():
        return kept
    key = Window.partitionBy(node_of(text), F.col(id_col)).orderBy(F.lit(0))
    return kept.withColumn(copy, F.row_number().over(key)).where(F.col(copy) == 1).drop(copy)
