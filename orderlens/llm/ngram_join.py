"""N-gram Jaccard join: rare-first prefixes with length, positional and suffix filters.

1. Every document's set of word shingles is formed inside its block, and the shards of
   `blocks.exchange` tell each shingle's document frequency as a power of two. Shingles are
   ordered rare first (frequency class, then hash), and a document's prefix is its first
   n - ceil(threshold * n) + 1 shingles: two similar documents share one of them. Shingles
   that only one document has cannot be shared, so most documents post nothing at all.
2. Documents with equal sets are one class; only its first document goes on.
3. Posted shingles meet. First each shingle's most central document (fewest unique shingles)
   is compared with the others; then all pairs that these links have not joined into one
   component yet, in classes of length. Length, positional and suffix filters (suffixes are
   compared by their counts in eight ranges of the order) thin the candidates, as does the
   number of shingles that only one document has; the second time, bitmaps of the sets bound
   their difference from below, first for a token's documents of two components as wholes.
   Each distinct pair is verified once on its whole sets.

Pairs inside one component need no further test, as only membership is returned; no link
between components is lost. A group of copies therefore costs its size, not its square.

Defined results: null or blank text has no shingles and is linked with nothing; fewer words
than a shingle make one shingle of all words; rows with equal text are linked whatever their
ids; a null doc_id comes after all others. Other columns are ignored. Empty in, empty out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm import blocks
from orderlens.llm import words as W
from orderlens.llm.components import components
from orderlens.session import cut_lineage

SHINGLE = 5
#: Similarity as a fraction.
THRESHOLD = (3, 4)
#: Bits of a hash by which frequencies are counted. A shared value only makes a shingle look
#: more frequent to all documents alike.
COUNTED = np.uint64(16)
CELLS = 8
#: Bits of a set's bitmap; each is set when an odd number of shingles falls on it.
BITS = 1024
#: Just above 4/3, so similar sets are at most one class of length apart.
LENGTH_BASE = 1.34
PROFILE = (
    "uid long, doc_id long, n long, digest binary, unique long, cells long, "
    "tokens array<long>, positions array<int>, grams array<long>, bits array<long>, text_digest binary"
)


def shingle_sets(texts: pa.Array, n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    begins, flat = W.split(pc.ascii_lower(texts))
    hashes = W.hashed(flat)
    grams = W.windows(hashes, n)
    out = []
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
        own = grams[a : b - n + 1] if b - a >= n else W.windows(hashes[a:b], b - a) if b > a else grams[:0]
        own = np.sort(own)
        out.append(own[np.diff(own, prepend=own[:1] + np.uint64(1)) != 0])
    return out


def prefix_length(n: int) -> int:
    """Shingles of a set of n, of which a similar set must have one in its own prefix."""
    part, whole = THRESHOLD
    return n - -(-part * n // whole) + 1


def _frequency_class(hashes, counts, known) -> np.ndarray:
    return np.floor(np.log2(counts.astype(float))).astype(np.uint8)


def _counted(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct counted values of a block, the documents that have each, and where each shingle is."""
    flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
    short = (flat >> COUNTED) << COUNTED
    order = np.argsort(short)
    ordered = short[order]
    first = np.diff(ordered, prepend=ordered[:1] + np.uint64(1)) != 0
    where = np.empty(len(order), np.int64)
    where[order] = np.cumsum(first) - 1
    n = np.diff(np.flatnonzero(first), append=len(order))
    return ordered[first], where, n.astype(np.uint64)


def profiles(docs: DataFrame, block_bytes: int = blocks.BLOCK_BYTES) -> DataFrame:
    """One row per document: its set's size and digest and, where its prefix has shingles that
    other documents may share, those shingles and the set."""
    bounds = blocks.bounds_of(docs, block_bytes)

    def ask(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        distinct, _, n = _counted(shingle_sets(W.whole(table["text"])))
        return distinct, n

    def finish(block: int, table: pa.Table, said: np.ndarray) -> pa.Table:
        sets = shingle_sets(W.whole(table["text"]))
        _, where, _ = _counted(sets)
        classes = said[where]
        rows, at = [], 0
        for k, own in enumerate(sets):
            rare = classes[at : at + len(own)]
            at += len(own)
            rows.append((block * 2**32 + k, *_profile(own, rare)))
        names = [x.split()[0] for x in PROFILE.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(),
                 pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds]
        columns.insert(1, table["doc_id"].cast(pa.int64()).combine_chunks())
        own = (hashlib.sha256((t or "").encode()).digest() for t in table["text"].to_pylist())
        columns.append(pa.array(own, pa.binary()))
        return pa.table(columns, names=names)

    packed = blocks.packed(docs, bounds)
    return blocks.exchange(packed, len(bounds) + 1, ask, np.uint8, _frequency_class, finish, PROFILE)


def _profile(own: np.ndarray, rare: np.ndarray) -> tuple:
    if not len(own):
        return 0, None, 0, 0, None, None, None, None
    unique = int((rare == 0).sum())
    size = prefix_length(len(own))
    digest = xxhash.xxh3_128_digest(own.tobytes())
    if unique >= size:
        return len(own), digest, unique, 0, None, None, None, None
    order = np.argsort(rare, kind="stable")[:size]
    shared = np.flatnonzero(rare[order] > 0)
    counts = np.bincount((own >> np.uint64(61)).astype(np.int64), minlength=CELLS)
    cells = np.minimum(counts, 255).astype(np.uint8).tobytes()
    odd = np.bincount((own >> np.uint64(54)).astype(np.int64), minlength=BITS).astype(np.uint8) & 1
    return (
        len(own), digest, unique, int.from_bytes(cells, "little", signed=True),
        own[order[shared]].view(np.int64), shared.astype(np.int32), own.view(np.int64),
        np.packbits(odd, bitorder="little").view("<i8"),
    )


def overlap(n1: Column, n2: Column) -> Column:
    """Common shingles that make two sets similar: i / (n1 + n2 - i) at the threshold."""
    part, whole = THRESHOLD
    return F.ceil((n1 + n2) * part / (part + whole))


def may_match(a: str, b: str) -> Column:
    """Length, positional and suffix filter for a shingle that both prefixes have.

    Shingles that one document alone has cannot be common.
    """
    part, whole = THRESHOLD
    n1, n2, p1, p2, u1, u2 = (F.col(f"{x}.{y}") for y in ("n", "pos", "unique") for x in (a, b))
    need = overlap(n1, n2)
    length = F.least(n1, n2) * whole >= F.greatest(n1, n2) * part
    most = F.least(p1, p2) + 1 + F.least(n1 - p1 - 1, n2 - p2 - 1)
    cell = lambda x, k: F.shiftrightunsigned(F.col(f"{x}.cells"), 8 * k).bitwiseAND(255)
    apart = sum((F.abs(cell(a, k) - cell(b, k)) for k in range(CELLS)), F.lit(0))
    shared = F.least(n1 - u1, n2 - u2) >= need
    return length & shared & (most >= need) & (n1 + n2 - need * 2 >= apart)


def bitmaps_may_match(a: str, b: str) -> Column:
    """Bits that differ are at most the shingles that only one of the two sets has."""
    n = F.col(f"{a}.n") + F.col(f"{b}.n")
    differ = _bits_apart(F.col(f"{a}.bits"), F.col(f"{b}.bits"))
    return differ <= n - overlap(F.col(f"{a}.n"), F.col(f"{b}.n")) * 2


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("n1"), F.col("grams").alias("g1"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("n2"), F.col("grams").alias("g2"))
    common = F.size(F.array_intersect("g1", "g2"))
    return (
        pairs.join(one, "a").join(two, "b")
        .where(common >= overlap(F.col("n1"), F.col("n2")))
        .select("a", "b")
    )


def link_components(profile: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes of equal sets (digest, node, first_id), and (node, component) of linked classes.

    `profile` has the rows of `profiles`, from a written table.
    """
    classes = cut_lineage(
        profile.where("digest is not null")
        .groupBy("digest")
        .agg(F.min(F.struct("uid", "doc_id")).alias("first"))
        .select("digest", F.col("first.uid").alias("node"), F.col("first.doc_id").alias("first_id"))
    )
    heads = profile.where("tokens is not null").join(
        classes.select(F.col("node").alias("uid")), "uid", "left_semi"
    )
    sets = heads.select(F.col("uid").alias("node"), "n", "grams")
    posts = heads.select(
        F.col("uid").alias("node"), "n", "unique", "cells",
        F.explode(F.arrays_zip("tokens", "positions")).alias("p"),
    ).select("node", "n", "unique", "cells", F.col("p.tokens").alias("token"), F.col("p.positions").alias("pos"))
    centers = posts.groupBy("token").agg(
        F.min(F.struct("unique", "node", "n", "pos", "cells")).alias("c"), F.count(F.lit(1)).alias("m")
    ).where("m > 1")
    met = cut_lineage(posts.join(centers.hint("merge"), "token"))
    tried = cut_lineage(
        met.alias("x")
        .where(F.col("node") != F.col("c.node"))
        .where(may_match("x", "c"))
        .select(F.least("x.node", "c.node").alias("a"), F.greatest("x.node", "c.node").alias("b"))
        .distinct()
    )
    links = cut_lineage(verified(tried, sets))
    joined = components(links)
    bits = heads.select(F.col("uid").alias("node"), "bits")
    more = verified(_untried(met, joined, bits).join(tried, ["a", "b"], "left_anti"), sets)
    return classes, components(links.union(more))


def _bits_apart(a: Column, b: Column) -> Column:
    return sum((F.bit_count(a[k].bitwiseXOR(b[k])) for k in range(BITS // 64)), F.lit(0))


def _may_reach(bits: Column, n: Column, radius: Column) -> Column:
    """Whether documents at most `radius` bits around `bits` and the lead of group y may be similar:
    sets of n1 and n2 then differ in at most (n1 + n2) * (whole - part) / (whole + part)."""
    part, whole = THRESHOLD
    beyond = _bits_apart(bits, F.col("y.lead")) - radius
    return beyond * (whole + part) <= (n + F.col("y.n")) * (whole - part)


def _near_groups(groups: DataFrame) -> DataFrame:
    """Pairs of a token's groups (token, step, component, radius, n, lead) between which documents may match.

    `lead` is the bitmap of the component's first document, `radius` how many bits at most the
    group's differ from it, and `n` the size of the largest set.
    """
    named = groups.withColumn("own", F.col("step"))
    near = named.select(
        "token",
        F.explode(F.array(*(F.col("step") + k for k in (-1, 0, 1)))).alias("step"),
        F.struct("component", "own", "radius", "n", "lead").alias("y"),
    )
    return (
        named.alias("x")
        .join(near.hint("merge"), ["token", "step"])
        .where(F.col("x.component") < F.col("y.component"))
        .where(_may_reach(F.col("x.lead"), F.col("x.n"), F.col("x.radius") + F.col("y.radius")))
        .select("token", F.col("x.own").alias("step"), F.col("x.component").alias("component"), "y", F.col("y.own").alias("y_step"))
    )


def _untried(met: DataFrame, joined: DataFrame, bits: DataFrame) -> DataFrame:
    """Candidate pairs that are in different components so far.

    A token's documents of one component and class of length are a group. Numbers of bits that
    differ obey the triangle inequality, so where the bitmaps of two components' first documents
    are further apart than the bitmaps of the groups' documents are from these, and than similar
    documents are, no pair between the groups can match. Only pairs of the other groups are made,
    first with the documents of one that are near enough to the other as a whole.
    """
    component = F.coalesce("component", "node").alias("component")
    placed = bits.join(joined, "node", "left").select("node", component, "bits")
    first = bits.select(F.col("node").alias("component"), F.col("bits").alias("lead"))
    placed = cut_lineage(
        placed.join(first, "component").withColumn("radius", _bits_apart(F.col("bits"), F.col("lead"))).drop("lead")
    )
    known = met.select("token", "node", "n", "pos", "unique", "cells").join(
        placed.select("node", "component", "radius"), "node"
    )
    split = known.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    open_ = cut_lineage(
        known.join(split.where("low < high").select("token").hint("merge"), "token", "left_semi")
        .withColumn("step", F.floor(F.log(F.col("n")) / float(np.log(LENGTH_BASE))))
    )
    groups = cut_lineage(
        open_.groupBy("token", "step", "component")
        .agg(F.max("radius").alias("radius"), F.max("n").alias("n"))
        .join(first.hint("merge"), "component")
    )
    of_x = open_.drop("radius").join(bits.hint("merge"), "node")
    document = F.struct("node", "n", "pos", "unique", "cells", "bits")
    keys = {"step": "y_step", "component": "y_component"}
    of_y = of_x.select("token", *[F.col(c).alias(k) for c, k in keys.items()], document.alias("y"))
    some = (
        _near_groups(groups)
        .join(of_x.select("token", *keys, document.alias("x")).hint("merge"), ["token", *keys])
        .where(_may_reach(F.col("x.bits"), F.col("x.n"), F.col("y.radius")))
        .select("token", "y_step", F.col("y.component").alias("y_component"), "x")
    )
    return (
        some.join(of_y.hint("merge"), ["token", "y_step", "y_component"])
        .where(may_match("x", "y") & bitmaps_may_match("x", "y"))
        .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
        .distinct()
    )


def linked_rows(docs: DataFrame, block_bytes: int = blocks.BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, text_digest (SHA-256), n, component_id, and whether it is the first
    of its component by id and then text."""
    profile = cut_lineage(profiles(docs, block_bytes))
    classes, linked = link_components(profile)
    linked = cut_lineage(linked)
    ids = classes.select(F.col("node").alias("component"), F.col("first_id").alias("component_id"))
    named = (
        classes.join(linked, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .join(ids, "component")
        .select("digest", "component", "component_id")
    )
    rows = profile.select("uid", "doc_id", "text_digest", "n", "digest")
    found = rows.where("digest is not null").join(named.hint("merge"), "digest")
    alone = rows.where("digest is null")
    columns = ["doc_id", "text_digest", "n", "component_id", "first"]
    return found.withColumn("first", F.col("uid") == F.col("component")).select(columns).union(
        alone.withColumn("component_id", F.col("doc_id")).withColumn("first", F.lit(True)).select(columns)
    )


def join(docs: DataFrame, block_bytes: int = blocks.BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least id reachable by links)."""
    return linked_rows(docs, block_bytes).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
