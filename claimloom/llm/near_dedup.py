"""Near-duplicates: fast similarity sketches, bands, exact verification, components.

Sketch (Dahlgaard, Knudsen, Thorup 2017): in round i every shingle is hashed to a
bin and a value; a bin keeps the least (i, value). The first t rounds choose the
bin at random, round t + j puts every shingle into bin j, so that all t bins
are filled after 2t rounds at the latest and, with concentration bounds, after
about log t rounds of a text of t shingles. Sketch agreement estimates Jaccard.

Links are confirmed on the full shingle sets (as 64-bit hashes). The result is
which texts can reach each other through links. Texts with equal sets are one
node, so copies cost nothing. Bands only propose candidates; ``bands_for``
makes so many that a pair at the threshold is missed with a probability below
``MISS``.

No group's pairs are ever listed. Every member of a bucket is verified against
one leader, which settles most buckets, as members of one component need no
further test. Buckets that still hold several components are joined to
families; in each, the texts outside the largest component are compared with
everybody, tile by tile. A family too wide for that goes on with its members'
rarest shingles (prefix filter): two sets this similar share one of them
whatever the order, so that nothing is lost, and texts that only have a
frequent passage in common never meet.

Null and empty texts, and texts without words, have no shingles and link with
nothing; texts with fewer words than a shingle have their whole word sequence
as the only shingle. Rows without an id take no part (component null, kept).
Rows that repeat an id share its component. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from claimloom.llm.batches import pieces
from claimloom.operators.skew import broadcast_if_small
from claimloom.staging import stage

ROWS_PER_BAND = 6
MISS = 1e-7
LEADER_BLOCK, MEMBER_BLOCK = 256, 1024  # sets that meet in one tile
WIDEST_FAMILY = 20_000  # texts beyond which rare shingles say who is compared
_MAX_WORDS = 250_000  # entries of the word-hash memo


def bands_for(similarity: float, rows: int = ROWS_PER_BAND, miss: float = MISS) -> int:
    """Bands so that a pair at ``similarity`` shares none with a probability below ``miss``."""
    return math.ceil(math.log(miss) / math.log(1 - similarity**rows))


# --- shingles and sketches ----------------------------------------------------


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MAX_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles."""

    def __init__(self, words: int):
        self.words, self.hashes = words, _WordHashes()

    def __call__(self, text: str | None) -> np.ndarray:
        # bytes.lower folds A-Z only; bytes.split() cuts at space and 0x09-0x0D only
        words = (text or "").encode().lower().split()
        if len(words) < self.words:
            whole = [xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))] if words else []
            return np.array(whole, np.uint64)
        single = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        n = len(words) - self.words + 1
        shingles = np.zeros(n, np.uint64)
        for i in range(self.words):
            shingles = _mix(shingles * np.uint64(0x9E3779B97F4A7C15) + single[i : i + n])
        return np.unique(shingles)


def sketches(sets: list[np.ndarray], t: int) -> np.ndarray:
    """One fast similarity sketch of ``t`` coordinates per non-empty set."""
    out = np.full((len(sets), t), np.uint64(2**64 - 1))
    flat = out.reshape(-1)
    sizes = np.array([len(s) for s in sets])
    elements = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    for i in range(2 * t):
        if not len(elements):
            break
        h = _mix(elements + np.uint64(((i + 1) * 0x9E3779B97F4A7C15) % 2**64))
        bins = (h >> np.uint64(32)) % np.uint64(t) if i < t else np.full(len(h), i - t, np.uint64)
        value = (np.uint64(i) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))
        np.minimum.at(flat, owner * t + bins.astype(np.int64), value)
        # later rounds only put larger values: a text is done once all its bins are filled
        open_ = (out == np.uint64(2**64 - 1)).any(axis=1)[owner]
        elements, owner = elements[open_], owner[open_]
    return out


def signatures(docs: DataFrame, id: str, text: str, words: int, bands: int, rows: int) -> DataFrame:
    """(id, n_shingles, digest, bands) per row; ``digest`` names the set, null if empty."""
    t = bands * rows

    def sign(batches):
        shingler = Shingler(words)
        for piece in pieces(batches):
            sets = [shingler(value) for value in piece.column(1).to_pylist()]
            full = [s for s in sets if len(s)]
            keys = sketches(full, t).reshape(len(full), bands, rows)
            band = np.tile(np.arange(bands, dtype=np.uint64), (len(full), 1))
            for r in range(rows):
                band = _mix(band * np.uint64(0x9E3779B97F4A7C15) + keys[:, :, r])
            digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            rest = iter(band.astype(np.int64).tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array([next(rest) if len(s) else [] for s in sets], pa.list_(pa.int64())),
                ],
                names=["id", "n_shingles", "digest", "bands"],
            )

    rows_ = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return rows_.mapInArrow(sign, "id bigint, n_shingles bigint, digest binary, bands array<bigint>")


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """(id, shingles) of ``docs(id, text)``."""

    def cut(batches):
        shingler = Shingler(words)
        for piece in pieces(batches):
            sets = [shingler(t).view(np.int64) for t in piece.column(1).to_pylist()]
            arrays = [piece.column(0), pa.array(sets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "shingles"])

    return docs.select("id", "text").mapInArrow(cut, "id bigint, shingles array<bigint>")


# --- links ----------------------------------------------------------------------


def verified(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of ``edges`` for which 100 * |A and B| >= percent * |A or B| holds on the full sets."""
    a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a"))
    b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return edges.join(b, "b").join(a, "a").where(100 * common >= percent * union).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every node of ``links(a, b)``; the component is its least id.

    Alternating large-star and small-star steps (Kiveris et al. 2014): each is
    a minimum per node and a join, and the number of steps is logarithmic.
    """
    edges = stage(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    while not _is_star_forest(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        ends = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        small = large.join(least, "u").select(F.explode(ends).alias("e")).select("e.*")
        edges = stage(small.where(F.col("u") != F.col("v")).distinct(), "links")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )


def _is_star_forest(edges: DataFrame) -> bool:
    """Has every node one parent at most, and no parent a parent of its own?"""
    ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where(F.col("up") + F.col("down") > 1).isEmpty()


def merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels(id, component)`` after the components joined by ``links(a, b)`` became one."""
    for end in ("a", "b"):
        label = labels.select(F.col("id").alias(end), F.col("component").alias(f"of_{end}"))
        links = links.join(label, end)
    merged = components(links.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")))
    merged = merged.select(F.col("id").alias("component"), F.col("component").alias("merged"))
    joined = labels.join(merged, "component", "left")
    return stage(joined.select("id", F.coalesce("merged", "component").alias("component")), "labels")


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, id, component) of the buckets of ``members`` that hold several components."""
    known = members.select("bucket", "id").join(labels, "id")
    several = (
        known.groupBy("bucket")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("id").alias("first"))
        .where(F.col("lo") != F.col("hi"))
        .select("bucket", "first")
    )
    return stage(known.join(several, "bucket"), "open")


def _overlaps(own: np.ndarray, keys: np.ndarray, starts: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    """Shingles that ``own`` shares with each of ``n`` sets; these are given by shingle."""
    at = np.searchsorted(keys, own)
    at = at[(at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == own)]
    counts = starts[at + 1] - starts[at]
    places = np.repeat(starts[at] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    return np.bincount(owners[places], minlength=n)


def tile_links(table: pa.Table, percent: int) -> dict[str, list[int]]:
    """Links of one tile: its leaders with its members, one per leader and other component."""
    lead = table.filter(table.column("leads"))
    rest = table.filter(pa.compute.invert(table.column("leads")))
    out: dict[str, list[int]] = {"a": [], "b": []}
    if not lead.num_rows or not rest.num_rows:
        return out
    flat = lead.column("shingles").combine_chunks()
    sizes = flat.value_lengths().to_numpy()
    owners = np.repeat(np.arange(lead.num_rows), sizes)
    shingles = flat.flatten().to_numpy()
    order = np.argsort(shingles, kind="stable")
    owners = owners[order]
    keys, starts = np.unique(shingles[order], return_index=True)
    starts = np.append(starts, len(shingles))
    ids, of = (lead.column(c).to_numpy() for c in ("id", "component"))
    known = set()
    for one, component, own in zip(rest.column("id").to_pylist(), rest.column("component").to_pylist(), rest.column("shingles")):
        own = own.values.to_numpy()
        common = _overlaps(own, keys, starts, owners, lead.num_rows)
        linked = (100 * common >= percent * (len(own) + sizes - common)) & (of != component)
        for other, other_component in zip(ids[linked].tolist(), of[linked].tolist()):
            if (other_component, component) not in known:
                known.add((other_component, component))
                out["a"].append(other)
                out["b"].append(one)
    return out


def family_links(
    members: DataFrame, sets: DataFrame, percent: int, leaders: int = LEADER_BLOCK, others: int = MEMBER_BLOCK
) -> DataFrame:
    """(a, b): links that join different components within the families of ``members(family, id, component)``.

    The members outside a family's largest component lead: each is compared
    with everybody of another component. Blocks of leaders meet blocks of
    members in tiles, tasks of their own, so a set is sent once per tile, not
    once per pair, and a large family is many tasks' work.
    """
    parts = members.groupBy("family", "component").agg(F.count("*").alias("c"))
    plan = parts.groupBy("family").agg(F.max(F.struct("c", "component")).alias("top"), F.sum("c").alias("n"))
    plan = plan.select(
        "family", F.col("top.component").alias("main"),
        F.ceil((F.col("n") - F.col("top.c")) / leaders).alias("lead_blocks"), F.ceil(F.col("n") / others).alias("blocks"),
    ).where(F.col("lead_blocks") > 0)
    planned = members.join(plan, "family").join(sets, "id")

    def every(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1))

    row = ["family", "id", "component", "shingles"]
    place = F.xxhash64("id")
    tiles = (
        planned.where(F.col("component") != F.col("main"))
        .select(*row, F.lit(True).alias("leads"), F.pmod(place, "lead_blocks").alias("x"), every("blocks").alias("y"))
        .unionByName(
            planned.select(*row, F.lit(False).alias("leads"), every("lead_blocks").alias("x"), F.pmod(place, "blocks").alias("y"))
        )
    )

    def link(table: pa.Table) -> pa.Table:
        return pa.table(tile_links(table, percent), schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return tiles.groupBy("family", "x", "y").applyInArrow(link, "a bigint, b bigint")


def _rare_buckets(ids: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(bucket, id): each set's rarest shingles, enough that linked sets share one."""
    own = sets.join(ids, "id", "left_semi")
    spread = own.select("id", F.size("shingles").alias("n"), F.explode("shingles").alias("bucket"))
    counts = spread.groupBy("bucket").agg(F.count("*").alias("holders"))
    shared = spread.join(counts.where(F.col("holders") > 1), "bucket")
    # shingles held once come first in every order and link nothing: they use up prefix places
    prefix = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)) + 1
    held = shared.groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("holders", "bucket"))).alias("s"))
    places = (prefix - (F.col("n") - F.size("s"))).cast("int")
    rarest = held.where(places > 0).select("id", F.explode(F.slice("s", F.lit(1), places)).alias("x"))
    return rarest.select(F.col("x.bucket").alias("bucket"), "id")


def link_components(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
    rows: int = ROWS_PER_BAND,
    widest: int = WIDEST_FAMILY,
) -> DataFrame:
    """(id, n_shingles, component, kept), one row per row of ``docs``."""
    signed = stage(signatures(docs, id, text, words, bands_for(percent / 100, rows), rows), "signatures")
    full = signed.where(F.col("digest").isNotNull() & F.col("id").isNotNull())
    node = stage(full.groupBy("digest").agg(F.min("id").alias("node")), "nodes")
    nodes = full.join(node.select("node"), F.col("id") == F.col("node"), "left_semi")
    members = nodes.select("id", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    # of a bucket only its size and least member are needed, if it has two members at all
    shared = members.groupBy("bucket").agg(F.min(F.struct("id", "n")).alias("least"), F.count("*").alias("held"))
    shared = shared.where(F.col("held") > 1).select("bucket", F.col("least.id").alias("a"), F.col("least.n").alias("n_a"))
    members = stage(members.join(shared, "bucket"), "buckets")

    candidates = broadcast_if_small(stage(members.select("id").distinct(), "candidates"))
    texts = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    sets = shingle_sets(texts.join(candidates, "id", "left_semi"), words)
    sets = stage(sets, "shingles")

    # every member with the least one of its bucket: near copies of one text are mostly settled by that
    least = F.col("id") != F.col("a")
    sized = 100 * F.least("n", "n_a") >= percent * F.greatest("n", "n_a")
    stars = members.where(least & sized).select("a", F.col("id").alias("b")).distinct()
    labels = merge(sets.select("id", F.col("id").alias("component")).distinct(), verified(stars, sets, percent))

    # what shares a bucket but no component yet
    open_ = _open(members, labels)
    if not open_.isEmpty():
        ties = components(open_.select(F.col("first").alias("a"), F.col("id").alias("b")))
        family = ties.select("id", F.col("component").alias("family"))
        rows_ = stage(open_.select("id", "component").distinct().join(family, "id"), "families")
        wide = rows_.groupBy("family").agg(F.count("*").alias("n")).where(F.col("n") > widest).select("family")
        labels = merge(labels, family_links(rows_.join(wide, "family", "left_anti"), sets, percent))
        wide = rows_.join(wide, "family", "left_semi").select("id")
        if not wide.isEmpty():
            rare = _open(_rare_buckets(wide, sets, percent), labels).withColumnRenamed("bucket", "family")
            labels = merge(labels, family_links(rare.drop("first"), sets, percent))

    labels = labels.select(F.col("id").alias("node"), F.col("component").alias("linked_to"))
    named = stage(node.join(labels, "node", "left").select("digest", F.coalesce("linked_to", "node").alias("of")), "named")
    result = signed.select("id", "n_shingles", "digest").join(named, "digest", "left")
    linked = F.col("of").isNotNull() & F.col("id").isNotNull()
    component = F.when(linked, F.col("of")).otherwise(F.col("id"))
    return result.select(
        "id", "n_shingles", component.alias("component"), F.col("id").eqNullSafe(component).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """One row of each component stays: the one with its least id. All columns kept."""
    flagged = link_components(docs, id, text, **settings)
    dropped = stage(flagged.where(~F.col("kept")).select(F.col("id").alias("_dropped")), "near-dropped")
    return docs.join(broadcast_if_small(dropped), docs[id] == dropped["_dropped"], "left_anti")
