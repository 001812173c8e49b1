"""Near-duplicate documents by b-bit MinHash.

1. A document is the set of its distinct shingles of ``SHINGLE`` words. Documents with equal sets are
   one class, found by a 128-bit digest of the set; only one document of a class goes on.
2. ``HASHES`` minima of the set give ``BANDS`` band keys of ``ROWS`` minima each, and a signature of
   two bits of every minimum's mix, packed as bit planes of four 64-bit numbers.
3. Documents sharing a band key are candidates. Bits that differ are counted on the planes; freed of
   chance agreement (1/4) they estimate the similarity, and pairs far below the threshold are dropped.
4. Candidates are confirmed on the full shingle sets of both texts.
5. Links are joined into components by large-star and small-star rounds.

Candidates are not all pairs of a bucket. First each class is tried against the best of its buckets'
hubs (the smallest class of a bucket), one pair a class. Then only buckets that still hold several
components are taken up: each class outside a bucket's largest component is tried against one member
of it, the best over its buckets, and at last against all classes of other components whose longer
signature does not rule it out, once a pair however many buckets it shares. So a bucket of many like
copies costs as many pairs as it has members, while a link between unlike groups is still tried.

Texts are shuffled for no pair: of the table of all texts those of the candidates are picked by their
numbers, which Spark broadcasts while that table is below its threshold.

At a similarity of 0.8 a pair shares no band with probability (1 - 0.8^6)^42 = 3e-6.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from veracast.llm.common import kept, refuse_taken, scratch
from veracast.llm.encode import byte_slices

SHINGLE = 5
PERCENT = 80
HASHES, BANDS, ROWS = 256, 42, 6
# Minima of the longer signature of documents that pairs across components are drawn from.
LONG_HASHES = 2048
# Standard deviations by which an estimate may miss the similarity before the pair is dropped.
DEVIATIONS = 4.5
# Text, and pairs, that a task works on at a time.
_SLICE_BYTES, _SLICE_PAIRS = 1 << 20, 100
_FEATURES = "n bigint, k1 bigint, k2 bigint, bands array<bigint>, planes array<bigint>"


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix in which each input bit sways each output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _word_hash(word: str) -> int:
    digest = hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(digest, "little")


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; a shorter text is one shingle."""
    texts = pc.take(texts.cast(pa.large_string()), pa.array(np.arange(len(texts))))
    runs = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = runs.flatten().dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    hashes = np.fromiter(map(_word_hash, distinct), np.uint64, len(distinct))
    full = np.fromiter((bool(w) for w in distinct), bool, len(distinct))
    index = coded.indices.to_numpy(zero_copy_only=False)
    words, real = hashes[index], full[index]
    before = np.concatenate([[0], np.cumsum(real)])[runs.offsets.to_numpy()]
    words = words[real]
    out = []
    for first, last in zip(before[:-1].tolist(), before[1:].tolist()):
        own = words[first:last]
        wide = min(width, len(own))
        if not wide:
            out.append(own)
            continue
        k = len(own) - wide + 1
        total = np.full(k, np.uint64(wide))
        for i in range(wide):
            total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + own[i : i + k])
        out.append(np.unique(total))
    return out


class Signer:
    """Minima, band keys, planes and digests of shingle sets."""

    def __init__(self, hashes: int = HASHES, seed: int = 5):
        draw = np.random.default_rng(seed)
        self.hashes = hashes
        self._a = draw.integers(0, 1 << 31, hashes, np.uint32) * np.uint32(2) + np.uint32(1)
        self._b = draw.integers(0, 1 << 32, hashes, np.uint32)
        self._band = draw.integers(0, 1 << 63, (BANDS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)
        self._salt = draw.integers(0, 1 << 63, BANDS, np.uint64)

    def minima(self, hashes: np.ndarray) -> np.ndarray:
        small = (hashes >> np.uint64(32)).astype(np.uint32)
        out = np.full(self.hashes, np.uint32(0xFFFFFFFF))
        for at in range(0, len(small), 1024):
            part = self._a[:, None] * small[None, at : at + 1024] + self._b[:, None]
            np.minimum(out, part.min(axis=1), out=out)
        return out

    def sign(self, sets: list[np.ndarray]) -> pa.StructArray:
        n = np.array([len(s) for s in sets], np.int64)
        minima = np.array([self.minima(s) for s in sets], np.uint32).reshape(-1, HASHES)
        rows = minima[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.uint64)
        keys = _mixed((rows * self._band).sum(axis=2, dtype=np.uint64) ^ self._salt).view(np.int64)
        planes = _planes(minima)
        digests = np.array(
            [np.frombuffer(hashlib.blake2b(s, digest_size=16).digest(), np.int64) for s in sets]
        ).reshape(-1, 2)
        columns = [
            pa.array(n),
            pa.array(digests[:, 0].copy()),
            pa.array(digests[:, 1].copy()),
            _lists(keys),
            _lists(planes),
        ]
        return pa.StructArray.from_arrays(columns, ["n", "k1", "k2", "bands", "planes"])


def _planes(minima: np.ndarray) -> np.ndarray:
    """The low bits of all mixed minima, then their second bits, 64 to a number.

    The hashes are linear, so whether two shingles' raw low bits agree is the same for all of them.
    Mixed with a salt of each hash they agree by chance, which the estimate builds on.
    """
    salt = np.arange(1, minima.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    low = np.empty((len(minima), 2, minima.shape[1]), np.uint8)
    for at in range(0, len(minima), 64):
        mixed = _mixed(minima[at : at + 64].astype(np.uint64) ^ salt)
        low[at : at + 64, 0], low[at : at + 64, 1] = mixed & 1, (mixed >> 1) & 1
    return np.packbits(low, axis=2).view(np.int64).reshape(len(minima), minima.shape[1] // 32)


def _lists(values: np.ndarray) -> pa.ListArray:
    n, k = values.shape
    flat = pa.array(values.reshape(-1))
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), flat)


def _signer(width: int):
    def rows(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        signer = Signer()
        for texts in batches:
            pa.default_memory_pool().release_unused()
            parts = [
                signer.sign(shingle_sets(texts.slice(at, n), width))
                for at, n in byte_slices(texts, _SLICE_BYTES)
            ]
            yield pa.concat_arrays(parts) if parts else signer.sign([])

    return F.arrow_udf(rows, _FEATURES).asNondeterministic()


def _long_signer(width: int):
    def rows(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        signer = Signer(LONG_HASHES, seed=6)
        for texts in batches:
            pa.default_memory_pool().release_unused()
            parts = [np.zeros((0, LONG_HASHES // 32), np.int64)]
            for at, n in byte_slices(texts, _SLICE_BYTES):
                sets = shingle_sets(texts.slice(at, n), width)
                parts.append(_planes(np.array([signer.minima(s) for s in sets], np.uint32)))
            yield _lists(np.concatenate(parts))

    return F.arrow_udf(rows, "array<bigint>").asNondeterministic()


def _confirmer(width: int, percent: int):
    def rows(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            pa.default_memory_pool().release_unused()
            out = []
            for at in range(0, len(left), _SLICE_PAIRS):
                pairs = zip(
                    shingle_sets(left.slice(at, _SLICE_PAIRS), width),
                    shingle_sets(right.slice(at, _SLICE_PAIRS), width),
                )
                for a, b in pairs:
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    out.append(both > 0 and 100 * both >= percent * (len(a) + len(b) - both))
            yield pa.array(out, pa.bool_())

    return F.arrow_udf(rows, "boolean").asNondeterministic()


def differing(a: Column, b: Column, hashes: int = HASHES) -> Column:
    """Minima of two signatures whose low bits differ."""
    half = hashes // 64
    return sum(
        F.bit_count(
            a[i].bitwiseXOR(b[i]).bitwiseOR(a[i + half].bitwiseXOR(b[i + half]))
        )
        for i in range(half)
    )


def most_differing(percent: int, hashes: int = HASHES) -> int:
    """Differing minima beyond which a pair of that similarity lies with vanishing probability.

    Two low bits agree by chance in a quarter of the minima that differ, so minima of sets with
    similarity s agree in 1/4 + 3/4 s of all cases; the estimate's spread is that of a binomial.
    """
    agree = 0.25 + 0.75 * percent / 100
    spread = DEVIATIONS * (agree * (1 - agree) / hashes) ** 0.5
    return int(hashes * (1 - agree + spread))


def components(edges: DataFrame) -> DataFrame:
    """(u, v) links to (node, comp), comp the smallest node reached; linked nodes alone.

    Minima are sums per node and task before they are dealt out, and they are kept before they are
    joined, so that Spark can split the links of a node that has very many.
    """
    at = kept(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where("u <> v")
        .distinct(),
        "links",
    )
    state = None
    while True:
        both = at.select(F.col("u").alias("a"), F.col("v").alias("b")).union(at.select("v", "u"))
        least = kept(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "large")
        large = kept(
            both.join(least, "a").where("b > a").select(F.col("b").alias("u"), F.col("m").alias("v")).distinct(),
            "large",
        )
        least = kept(large.groupBy("u").agg(F.min("v").alias("m")), "small")
        down = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        at = kept(down.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = at.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return at.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        state = now


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """``pairs`` (u, v) with ``linked``, from the texts of both."""
    pairs = kept(pairs, "pairs")
    ids = kept(pairs.select(F.col("u").alias("uid")).union(pairs.select("v")).distinct(), "ids")
    some = kept(texts.join(ids, "uid"), "texts")
    left = some.select(F.col("uid").alias("u"), F.col("text").alias("_left"))
    right = some.select(F.col("uid").alias("v"), F.col("text").alias("_right"))
    both = pairs.join(left, "u").join(right, "v")
    return both.select("u", "v", _confirmer(width, percent)("_left", "_right").alias("linked"))


def _open_members(shared: DataFrame, found: DataFrame, sides: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, with the bucket's largest one, ``main``."""
    placed = shared.join(found, "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp"))
    groups = placed.groupBy("key", "comp").agg(F.count("*").alias("rows"))
    open_keys = kept(
        groups.groupBy("key")
        .agg(F.max(F.struct("rows", "comp"))["comp"].alias("main"), F.count("*").alias("comps"))
        .where("comps > 1")
        .select("key", "main"),
        "open",
    )
    return kept(placed.join(open_keys, "key").join(sides, "node"), "members")


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    into: str = "_near",
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``docs`` with a struct column ``into``: uid, n_shingles, comp, component_id, first.

    ``component_id`` is the smallest id in the row's component; ``comp`` and ``uid`` are numbers of
    the component and the row; ``first`` is true for one row of each component, the one with the
    smallest id. A text without words has no shingles and a component of its own. Rows without an id
    take part; a component of such rows alone has the component_id null. Repeated ids are separate
    rows. Columns other than the id and the text are carried along; a column ``into`` is refused.
    """
    refuse_taken(docs, into)
    with scratch(docs.sparkSession, "signed", "placed"):
        return _grouped(docs, shingle, percent, into, doc_id, text)


def _grouped(
    docs: DataFrame, shingle: int, percent: int, into: str, doc_id: str, text: str
) -> DataFrame:
    signed = docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        F.struct(*[docs[c] for c in docs.columns if c not in (doc_id, text)]).alias("_rest")
        if set(docs.columns) - {doc_id, text}
        else F.lit(None).cast("int").alias("_rest"),
        _signer(shingle)(F.col(text)).alias("s"),
    ).select("uid", "doc_id", "text", "_rest", "s.*")
    rows = kept(signed, "signed")
    full = rows.where("n > 0")
    classes = kept(
        full.groupBy("k1", "k2").agg(F.min("uid").alias("uid"), F.min("doc_id").alias("least_id")),
        "classes",
    )
    nodes = kept(
        full.select("uid", "n", "bands", "planes").join(classes.select("uid"), "uid"), "nodes"
    )
    banded = nodes.select(F.col("uid").alias("node"), F.explode("bands").alias("key"))
    hubs = kept(
        banded.groupBy("key")
        .agg(F.min("node").alias("hub"), F.count("*").alias("size"))
        .where("size > 1"),
        "hubs",
    )
    # Most band keys are one class's own. All are dealt out twice, to find the others and their members;
    # what follows reads those alone.
    shared = kept(banded.join(hubs.select("key", "hub"), "key").select("key", "node", "hub"), "shared")
    planes = nodes.select("uid", "planes")
    most = most_differing(percent)
    tried = shared.where("node <> hub").select("node", "hub").distinct()
    tried = (
        tried.join(planes.select(F.col("uid").alias("node"), F.col("planes").alias("p")), "node")
        .join(planes.select(F.col("uid").alias("hub"), F.col("planes").alias("q")), "hub")
        .select("node", "hub", differing(F.col("p"), F.col("q")).alias("differ"))
        .where(F.col("differ") <= most)
        .groupBy("node")
        .agg(F.min(F.struct("differ", "hub")).alias("best"))
        .select(F.col("node").alias("u"), F.col("best.hub").alias("v"))
    )
    texts = rows.select("uid", "text")
    first = kept(_confirmed(tried, texts, shingle, percent), "confirmed")
    links = first.where("linked").select("u", "v")
    found = components(links)

    # Buckets that still hold several components: first each outsider against one member, another in
    # each bucket, of the bucket's largest component, then all pairs across components.
    sides = nodes.select(F.col("uid").alias("node"), F.col("n").alias("size"), "planes")
    members = _open_members(shared, found, sides)
    hub = F.min_by(F.struct("node", "planes"), F.xxhash64("node", "key")).alias("hub")
    chosen = kept(members.where("comp = main").groupBy("key").agg(hub), "chosen")
    tried = (
        members.where("comp <> main")
        .join(chosen, "key")
        .select(
            "node", "main", F.col("hub.node").alias("hub"), differing(F.col("planes"), F.col("hub.planes")).alias("differ")
        )
        .where(F.col("differ") <= most)
        .groupBy("node", "main")
        .agg(F.min(F.struct("differ", "hub")).alias("best"))
        .select(F.greatest("node", "best.hub").alias("u"), F.least("node", "best.hub").alias("v"))
        .distinct()
    )
    done = first.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    second = kept(
        _confirmed(tried.join(done, ["u", "v"], "left_anti"), texts, shingle, percent), "confirmed"
    )
    known = found.select(F.col("node").alias("u"), F.col("comp").alias("v"))
    found = components(known.union(second.where("linked").select("u", "v")))
    members = _open_members(shared, found, sides)
    # The long signature is made for these documents alone, and theirs are the only band keys looked at.
    ids = kept(members.select(F.col("node").alias("uid")).distinct(), "ids")
    signed = rows.select("uid", "text", "bands").join(ids, "uid")
    signed = signed.select(F.col("uid").alias("node"), "bands", _long_signer(shingle)("text").alias("long"))
    members = members.join(kept(signed, "long"), "node")
    side = lambda name, size, comp, p, lp, bands: [
        F.col("key"),
        F.col("node").alias(name),
        F.col("comp").alias(comp),
        F.col("size").alias(size),
        F.col("planes").alias(p),
        F.col("long").alias(lp),
        F.col("bands").alias(bands),
    ]
    outside = members.where("comp <> main").select("main", *side("x", "nx", "cx", "p", "lp", "bx"))
    inside = members.select(*side("y", "ny", "cy", "q", "lq", "by"))
    across = (
        outside.join(
            inside,
            (outside["key"] == inside["key"])
            & (F.col("cx") != F.col("cy"))
            & (100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny"))
            # Two that are both outside the largest component meet from either side.
            & ((F.col("cy") == F.col("main")) | (F.col("x") < F.col("y")))
            & (differing(F.col("p"), F.col("q")) <= most)
            & (
                differing(F.col("lp"), F.col("lq"), LONG_HASHES)
                <= most_differing(percent, LONG_HASHES)
            )
            # A pair is taken in the first bucket it shares; every bucket it shares is open.
            & (F.get(F.array_intersect("bx", "by"), F.lit(0)) == outside["key"]),
        )
        .select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v"))
        .distinct()
    )
    done = done.union(second.select("u", "v"))
    again = kept(
        _confirmed(across.join(done, ["u", "v"], "left_anti"), texts, shingle, percent), "confirmed"
    )
    known = found.select(F.col("node").alias("u"), F.col("comp").alias("v"))
    merged = components(known.union(again.where("linked").select("u", "v")))

    comps = kept(
        classes.join(merged, classes["uid"] == merged["node"], "left").select(
            "k1", "k2", "uid", "least_id", F.coalesce("comp", "uid").alias("comp")
        ),
        "comps",
    )
    ids = kept(comps.groupBy("comp").agg(F.min("least_id").alias("component_id")), "ids")
    named = kept(comps.join(ids, "comp").select("k1", "k2", "comp", "component_id"), "named")
    # Worked out without texts, which are shuffled once at last, for their own row alone.
    placed = rows.select("uid", "doc_id", "n", "k1", "k2").join(named, ["k1", "k2"], "left")
    placed = placed.select(
        "uid",
        "doc_id",
        "n",
        F.coalesce("comp", "uid").alias("comp"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
    # One row of each component; rows that share its smallest id are told apart by their number.
    same = F.col("doc_id").eqNullSafe(F.col("component_id"))
    firsts = kept(placed.where(same).groupBy("comp").agg(F.min("uid").alias("first_uid")), "firsts")
    placed = kept(
        placed.join(firsts.select("first_uid"), F.col("uid") == F.col("first_uid"), "left").drop("doc_id"), "placed"
    )
    out = rows.select("uid", "doc_id", "text", "_rest").join(placed, "uid")
    near = F.struct(
        "uid",
        F.col("n").alias("n_shingles"),
        "comp",
        "component_id",
        F.col("first_uid").isNotNull().alias("first"),
    ).alias(into)
    carried = {c: F.col("_rest")[c] for c in docs.columns}
    carried |= {doc_id: F.col("doc_id"), text: F.col("text")}
    return out.select(*[carried[c].alias(c) for c in docs.columns], near)
