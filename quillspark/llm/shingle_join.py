"""Jaccard self-join of documents on word shingles with PartEnum signatures.

Sets are compared inside bands of similar size. For a band, ``k`` bounds the number of elements in which two linked sets can differ. The feature domain
is cut into ``n > k`` parts, and a set has one signature per part, made from its elements there: two linked sets differ in at most ``k`` parts, so they
agree in at least ``n - k``. (This is the enumeration of subsets with one part left in each subset, the cheapest in signatures.) A set also has
signatures for the next band, where larger partners are. Empty parts say nothing and are skipped as long as a set has fewer than ``n - k`` of them, which
leaves linked sets a common signature in a filled part.

Shingles that are frequent in a bounded sample are first left out of the parts. Leaving out a fixed set of elements never makes two sets differ more, so
no link is lost, whatever the sample; a set that is left with too many empty parts also has signatures of its whole self.

Equal sets are one node. A set knows how many filled signatures any partner must share with it: ``n - k`` less its own empty parts. Links are found in
two steps. First, signature groups tie their members to their smallest; ties with enough common signatures form clusters, which are cut into blocks of
bounded size. All sets of a block are compared with each other and with two pivots of the cluster, by products of incidence matrices. Tasks give back
a spanning star per block, never pairs, and sets move once.

Second, what the first step can have missed lies between its components: pairs of different components that share enough signatures. A signature group
whose members are in one component, as those of copies are, has nothing left. In any other, the members outside its largest component (seekers) meet
the rest: in groups of up to ``SEEKERS`` sets by counting the signatures of each pair, and a pair is compared only if the parities of its sets allow a
link. (Sets have an odd or even number of elements in each of 256 places, and differ in no fewer elements than places.) The sets of larger groups are compared with each other through rare
shingles: in one order for all sets, rarest first, two linked sets must share a shingle near the start, how near follows from their sizes. Shingles that
few sets have near the start give pairs; those of many are told apart by the sizes of their sets, and only what many sets still share is compared in
blocks, seekers against the rest. So every pair that can be linked is either compared or already connected.

Edge cases: a null or empty text, or one of white space, has no shingles and links with nothing. With fewer words than a shingle needs, the whole
text is one shingle. Rows with a null id take part; ``component_id`` is the smallest id that is not null, if there is one. Repeated rows are linked
copies. Other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fits
from .components import smallest_reachable
from .shared import as_table, small_batches, stored

WORDS, PERCENT = 5, 80
BATCH = 2 << 20
BLOCK = 512
COLUMNS = 8_192
BUCKET_BYTES = 4 << 20
SAMPLE_DOCS = 4_000
COMMON = 0.005
SEEKERS = 64
LISTED = 64
IDS = 1 << 20
NARROW = 96
TALLY = 1 << 20
PART_BYTES = 12 << 20
PARITIES = ("p0", "p1", "p2", "p3")
LOW48 = np.uint64((1 << 48) - 1)
CHUNK = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0D]")
BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
STEP = np.uint64(0x9E3779B97F4A7C15)
POWERS = np.ones(1, dtype=np.uint64)
ODD = [np.uint64((0xD6E8FEB86659FD93 * (2 * j + 1) ** 3 + 2 * j) % (1 << 64) | 1) for j in range(16)]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * ODD[13])


def powers(count: int) -> np.ndarray:
    """``STEP`` to the powers 0 to ``count - 1`` modulo 2 to the 64th, from a table that grows as longer words come."""
    global POWERS
    if count > len(POWERS):
        POWERS = np.cumprod(np.append(np.uint64(1), np.full(2 * count - 1, STEP)))
    return POWERS[:count]


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A hash and the place of every word: a mix of the sum of ``LETTERS`` times the power of ``STEP`` for the byte's place in the word, and the length."""
    hashes, places, low = [], [], 0
    while low < len(raw):
        high = len(raw)
        if high - low > CHUNK:  # cut at white space, further on where a word is longer
            gap = SPACE.search(raw, low + CHUNK)
            high = gap.start() + 1 if gap else high
        letters = np.frombuffer(raw, np.uint8, high - low, low)
        filled = np.append(~BLANK[letters], False)
        edges = np.flatnonzero(np.diff(filled, prepend=False))
        first, sizes = edges[::2], edges[1::2] - edges[::2]
        if len(first):
            begins = np.cumsum(sizes) - sizes
            within = np.arange(sizes.sum()) - np.repeat(begins, sizes)
            sums = np.add.reduceat(LETTERS[letters[filled[:-1]]] * powers(int(sizes.max()))[within], begins)
            hashes.append(mixed(sums + sizes.astype(np.uint64) * ODD[12]))
            places.append(first + low)
        low = high
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(places)


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """The sorted hashes of each text's distinct shingles. Only A to Z are lower-cased, only ASCII white space separates words."""
    raw = [text.encode("utf-8", "surrogatepass").lower() if text else b"" for text in texts]
    begins = np.cumsum([0, *(len(r) + 1 for r in raw)])
    w, places = word_hashes(b" ".join(raw))
    cuts = np.searchsorted(places, begins)
    total = np.full(max(0, len(w) - words + 1), ODD[words], dtype=np.uint64)
    for j in range(words):
        total += w[j:j + len(total)] * ODD[j]
    total, found = mixed(total), []
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        size = high - low
        if 0 < size < words:
            found.append(mixed((w[low:high] * np.array(ODD[:size])).sum(keepdims=True) + ODD[size]))
            continue
        here = np.sort(total[low:high - words + 1]) if size else w[:0]
        found.append(here[np.append(True, here[1:] != here[:-1])] if len(here) else here)
    return found


def mark_of(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def parities(shingles: np.ndarray) -> np.ndarray:
    """A set's ``PARITIES``, 64 bits each: whether it has an odd number of elements in each place. Two sets have at least as many different elements as
    different bits."""
    odd = np.bincount((shingles % np.uint64(64 * len(PARITIES))).astype(np.int64), minlength=64 * len(PARITIES)) % 2
    return np.packbits(odd.astype(bool)).view(np.int64)


def short_id(mark: bytes) -> int:
    """48 bits of a mark. Two sets may share them; candidates are looked up by mark again."""
    return int.from_bytes(mark[:6], "little")


def counted_sets(docs: DataFrame, common: np.ndarray, words: int, percent: int) -> DataFrame:
    """``doc_id, n, mark, short, need`` and ``PARITIES`` per row."""
    shared = docs.sparkSession.sparkContext.broadcast(common)
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("mark", pa.binary()), ("short", pa.int64()), ("need", pa.int64()),
                        *((p, pa.int64()) for p in PARITIES)])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, usual = Bands(percent), Common(shared.value)
        for batch in small_batches(batches, "text", BATCH):
            sets = shingle_sets(batch.column("text").to_pylist(), words)
            marks = [mark_of(s) for s in sets]
            odd = np.stack([parities(s) for s in sets])
            yield as_table({"doc_id": batch.column("doc_id"), "n": [len(s) for s in sets], "mark": marks,
                            "short": [m and short_id(m) for m in marks], "need": [needed(s, bands, usual) if len(s) else None for s in sets],
                            **{p: odd[:, i] for i, p in enumerate(PARITIES)}}, schema)

    return docs.mapInArrow(rows, "doc_id long, n long, mark binary, short long, need long, " + ", ".join(f"{p} long" for p in PARITIES))


def common_shingles(docs: DataFrame, rows: int, words: int) -> np.ndarray:
    """Shingles of at least ``COMMON`` of about ``SAMPLE_DOCS`` distinct texts; there are at most a mean set's size divided by ``COMMON``."""
    every = max(1, rows // SAMPLE_DOCS)
    schema = pa.schema([("mark", pa.binary()), ("shingles", pa.list_(pa.int64()))])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BATCH):
            found = [s for s in shingle_sets(batch.column("text").to_pylist(), words) if len(s)]
            yield as_table({"mark": [mark_of(s) for s in found], "shingles": [s.view(np.int64) for s in found]}, schema)

    picked = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(every)) == 0)
    sample = stored(picked.mapInArrow(sets, "mark binary, shingles array<long>").dropDuplicates(["mark"]), "sample")
    least = max(10, int(COMMON * sample.count()))
    found = sample.select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    return np.sort(found.select("s").toArrow().column("s").to_numpy().view(np.uint64))


@dataclass
class Common:
    """A fixed set of shingles with a bit table before the search."""
    keys: np.ndarray

    def __post_init__(self):
        self.heads = np.zeros(1 << 20, dtype=bool)
        self.heads[self.keys >> np.uint64(44)] = True

    def outside(self, x: np.ndarray) -> np.ndarray:
        maybe = np.flatnonzero(self.heads[x >> np.uint64(44)])
        keep = np.ones(len(x), dtype=bool)
        if len(maybe):
            at = np.minimum(np.searchsorted(self.keys, x[maybe]), len(self.keys) - 1)
            keep[maybe[self.keys[at] == x[maybe]]] = False
        return x[keep]


class Bands:
    """Sizes from ``starts[i]`` to below ``starts[i + 1]`` are band ``i``; linked sets lie in the same band or in neighbours."""

    def __init__(self, percent: int):
        self.percent, self.starts = percent, [1]

    def of(self, size: int) -> int:
        while self.starts[-1] <= size:
            self.starts.append(self.starts[-1] * 100 // self.percent + 1)
        return int(np.searchsorted(self.starts, size, side="right")) - 1

    def differing(self, band: int) -> int:
        """The most elements in which linked sets of at most this band's sizes differ."""
        while len(self.starts) <= band + 1:
            self.starts.append(self.starts[-1] * 100 // self.percent + 1)
        return 2 * (self.starts[band + 1] - 1) * (100 - self.percent) // (100 + self.percent)


def signatures(shingles: np.ndarray, bands: Bands, common: Common) -> np.ndarray:
    """Signatures of one set for its own band and the next."""
    own = bands.of(len(shingles))
    rare = common.outside(shingles)
    found = []
    for band in (own, own + 1):
        k = bands.differing(band)
        if not k:
            continue
        n = k + 1 + k // 8
        filled = parts(rare, n, 2 * band)
        found.append(filled)
        if n - len(filled) >= n - k:
            whole = parts(shingles, n, 2 * band + 1)
            found.append(whole)
            if n - len(whole) >= n - k:
                here = np.zeros(n, dtype=bool)
                here[part_of(shingles, n)] = True
                found.append(mixed((np.flatnonzero(~here).astype(np.uint64) * ODD[9]) + salted(2 * band + 1) + ODD[11]))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def needed(shingles: np.ndarray, bands: Bands, common: Common) -> int:
    """The fewest signatures that this set shares with a linked set, whichever of its two bands they meet in."""
    own = bands.of(len(shingles))
    part_hash, least = common.outside(shingles), []
    for band in (own, own + 1):
        k = bands.differing(band)
        if k:
            n = k + 1 + k // 8
            filled = np.count_nonzero(np.diff(part_of(part_hash, n), prepend=-1))
            least.append(max(1, n - k - (n - filled)))
    return min(least, default=1)


def part_of(shingles: np.ndarray, n: int) -> np.ndarray:
    return (((shingles >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def parts(shingles: np.ndarray, n: int, kind: int) -> np.ndarray:
    """A signature for each filled part: a hash of the part and the sum of its elements' hashes."""
    part = part_of(shingles, n)
    starts = np.flatnonzero(np.diff(part, prepend=-1))  # sorted shingles have sorted parts
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.add.reduceat(shingles * ODD[8], starts)
    return mixed(mixed(sums) + part[starts].astype(np.uint64) * ODD[9] + salted(kind))


def salted(kind: int) -> np.uint64:
    return np.uint64(kind * int(ODD[10]) % (1 << 64))


def signature_blocks(docs: DataFrame, common: np.ndarray, parts_count: int, words: int, percent: int) -> DataFrame:
    """``part, entries``: 12 bytes per signature, 48 bits of it and 48 of the set, dealt to ``parts_count`` parts by a hash of all bits."""
    shared = docs.sparkSession.sparkContext.broadcast(common)
    schema = pa.schema([("part", pa.int32()), ("entries", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, usual, seen = Bands(percent), Common(shared.value), set()
        for batch in small_batches(batches, "text", BATCH):
            sigs, ids, sizes = [], [], []
            for s in shingle_sets(batch.column("text").to_pylist(), words):
                mark = mark_of(s)
                if mark is None or mark in seen:
                    continue
                seen.add(mark)
                found = signatures(s, bands, usual)
                sigs.append(found)
                ids.append(short_id(mark))
                sizes.append(len(found))
            if not sizes or not sum(sizes):
                continue
            sig = np.concatenate(sigs)
            who = np.repeat(np.array(ids, dtype=np.uint64), sizes)
            part = ((mixed(sig) >> np.uint64(32)) * np.uint64(parts_count) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            sig, who, part = sig[order] & LOW48, who[order], part[order]
            packed = np.empty((len(sig), 3), dtype="<u4")
            packed[:, 0] = sig & np.uint64(0xFFFFFFFF)
            packed[:, 1] = who & np.uint64(0xFFFFFFFF)
            packed[:, 2] = (sig >> np.uint64(32)) | ((who >> np.uint64(32)) << np.uint64(16))
            cuts = np.flatnonzero(np.diff(part, prepend=-1))
            raw = packed.tobytes()
            ends = np.append(cuts[1:], len(part))
            yield as_table({"part": part[cuts].astype(np.int32), "entries": [raw[12 * a:12 * b] for a, b in zip(cuts, ends)]}, schema)

    return docs.mapInArrow(rows, "part int, entries binary")


PAIR, STAR, GROUP = 0, 1, 2


def matched_sets(table: pa.Table) -> pa.Table:
    """What the signatures of one part say, as ``kind, a, b, c``: ``c`` signatures that only the sets ``a`` and ``b`` have (``PAIR``), that tie ``b`` to
    the smallest set ``a`` of a larger group (``STAR``), or that set ``b`` has as a member of the group ``a`` (``GROUP``), named by its members."""
    packed = np.frombuffer(b"".join(table.column("entries").to_pylist()), dtype="<u4").reshape(-1, 3)
    high = packed[:, 2].astype(np.uint64)
    sig = packed[:, 0].astype(np.uint64) | ((high & np.uint64(0xFFFF)) << np.uint64(32))
    who = packed[:, 1].astype(np.uint64) | ((high >> np.uint64(16)) << np.uint64(32))
    order = np.argsort(sig, kind="stable")
    sig, who = sig[order], who[order]
    same = sig[1:] == sig[:-1]
    shared = np.zeros(len(sig), dtype=bool)
    shared[1:] |= same
    shared[:-1] |= same
    sig, who = sig[shared], who[shared]
    order = np.lexsort((who, sig))
    sig, who = sig[order], who[order]
    fresh = np.ones(len(sig), dtype=bool)
    fresh[1:] = (sig[1:] != sig[:-1]) | (who[1:] != who[:-1])
    sig, who = sig[fresh], who[fresh]
    if not len(sig):
        return matches([])
    starts = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
    sizes = np.diff(np.append(starts, len(sig)))
    names = mixed(np.add.reduceat(mixed(who), starts) + sizes.astype(np.uint64)) >> np.uint64(1)
    first, name, size = np.repeat(who[starts], sizes), np.repeat(names, sizes), np.repeat(sizes, sizes)
    later = first != who
    found = []
    for kind, left, keep in ((PAIR, first, (size == 2) & later), (STAR, first, (size > 2) & later), (GROUP, name, size > 2)):
        pairs, counts = counted_pairs(left[keep], who[keep])
        found.append((kind, pairs, counts))
    return matches(found)


def counted_pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((right, left))
    pairs = np.stack([left[order], right[order]], axis=1)
    starts = np.flatnonzero(np.append(True, (pairs[1:] != pairs[:-1]).any(axis=1))) if len(pairs) else np.zeros(0, np.int64)
    return pairs[starts], np.diff(np.append(starts, len(pairs)))


def matches(found: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.Table:
    kinds = np.concatenate([np.full(len(c), k, np.int32) for k, _, c in found]) if found else []
    pairs = np.concatenate([p for _, p, _ in found]).astype(np.int64) if found else np.zeros((0, 2), np.int64)
    return pa.table({"kind": pa.array(kinds, pa.int32()), "a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64()),
                     "c": pa.array(np.concatenate([c for _, _, c in found]) if found else [], pa.int64())})


def whole_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """The rows of ``wanted`` with ``shingles`` in place of ``doc`` and ``want``, the id and mark of a row to take them from. Up to ``IDS`` ids are
    broadcast first, so that only texts that are wanted move; beyond that each text moves once."""
    ids = wanted.select("doc").distinct()
    if fits(ids, IDS):
        docs = docs.join(F.broadcast(ids), F.col("doc_id").eqNullSafe(F.col("doc")), "left_semi")
    names = [n for n in wanted.columns if n not in ("doc", "want")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BATCH):
            sets = shingle_sets(batch.column("text").to_pylist(), words)
            keep = [i for i, (s, m) in enumerate(zip(sets, batch.column("want").to_pylist())) if mark_of(s) == m]
            part = batch.select(names).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array([sets[i].tobytes() for i in keep], pa.binary())], [*names, "shingles"])

    met = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("doc"))).select(*names, "want", "text")
    schema = T.StructType([*(f for f in wanted.schema if f.name in names), T.StructField("shingles", T.BinaryType())])
    return met.mapInArrow(rows, schema)


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Numbers of common elements of all sets of two lists, by products of incidence matrices over a range of elements at a time."""
    sizes = [len(x) for x in left + right]
    values, place = np.unique(np.concatenate(left + right), return_inverse=True)
    seen = np.bincount(place)
    rank = np.where(seen > 1, np.cumsum(seen > 1) - 1, -1)[place]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    owner, rank = owner[rank >= 0], rank[rank >= 0]
    order = np.argsort(rank, kind="stable")
    owner, rank = owner[order], rank[order]
    total = np.zeros((len(left), len(right)), dtype=np.float32)
    for low in range(0, int((seen > 1).sum()), COLUMNS):
        a, b = np.searchsorted(rank, [low, low + COLUMNS])
        grid = np.zeros((len(sizes), COLUMNS), dtype=np.float32)
        grid[owner[a:b], rank[a:b] - low] = 1
        total += grid[:len(left)] @ grid[len(left):].T
    return total


def star_of(nodes: np.ndarray, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For links between places ``p`` and ``q``: the linked nodes and the smallest node each is connected to."""
    root = nodes.copy()
    while len(p):
        before = root.copy()
        low = np.minimum(root[p], root[q])
        np.minimum.at(root, p, low)
        np.minimum.at(root, q, low)
        if (before == root).all():
            break
    met = np.unique(np.concatenate([p, q]))
    met = met[root[met] != nodes[met]]
    return nodes[met], root[met]


def similar(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    both = common_counts(left, right).astype(np.float64)
    union = np.array([len(x) for x in left])[:, None] + np.array([len(x) for x in right])[None, :] - both
    return np.nonzero((100 * both >= percent * union) & (both > 0))


def block_stars(percent: int):
    """For blocks dealt to one task: stars of the links inside each block and with its pivots."""
    def rows(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cluster", "ascending"), ("block", "ascending")])
        cluster, block = table.column("cluster").to_numpy(), table.column("block").to_numpy()
        nodes, raw = table.column("node").to_numpy(), table.column("shingles")
        starts = np.flatnonzero(np.append(True, (cluster[1:] != cluster[:-1]) | (block[1:] != block[:-1])))
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for low, high in zip(starts, np.append(starts[1:], len(nodes))):
            sets = [np.frombuffer(x, np.uint64) for x in raw.slice(low, high - low).to_pylist()]
            p, q = similar(sets, sets, percent)
            node, root = star_of(nodes[low:high], p, q)
            a.append(node)
            b.append(root)
        return pa.table({"a": pa.array(np.concatenate(a), pa.int64()), "b": pa.array(np.concatenate(b), pa.int64())})

    return rows


def seeker_stars(percent: int):
    """For one block of seekers and one of a cluster's blocks: stars of the links between them."""
    def rows(table: pa.Table) -> pa.Table:
        seeks = table.column("seeks").to_numpy()
        nodes, raw = table.column("node").to_numpy(), table.column("shingles").to_pylist()
        left, right = np.flatnonzero(seeks), np.flatnonzero(~seeks)
        a = b = np.zeros(0, np.int64)
        if len(left) and len(right):
            sets = [np.frombuffer(x, np.uint64) for x in raw]
            p, q = similar([sets[i] for i in left], [sets[i] for i in right], percent)
            a, b = star_of(nodes, left[p], right[q])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows


def pair_links(percent: int):
    """The links among the pairs of one bucket; a set's row lists its partners there."""
    def rows(table: pa.Table) -> pa.Table:
        nodes, raw = table.column("node").to_pylist(), table.column("shingles").to_pylist()
        sets = {n: np.frombuffer(x, np.uint64) for n, x in zip(nodes, raw)}
        a, b = [], []
        for node, partners in zip(nodes, table.column("partners").to_pylist()):
            for other in partners:
                x, y = sets[node], sets[other]
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both and 100 * both >= percent * (len(x) + len(y) - both):
                    a.append(node)
                    b.append(other)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows


def compared_pairs(texts: DataFrame, pairs: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """The links among distinct ``pairs`` (``a``, ``b``). The partners of a set are dealt to buckets, a set moves once to each bucket that needs it."""
    pairs = stored(pairs.select("a", "b"), "pairs")
    buckets = max(1, pairs.count() // 256)
    dealt = stored(pairs.withColumn("bucket", F.pmod(F.xxhash64("a", F.pmod(F.xxhash64("b"), F.lit(max(1, buckets // 16)))), F.lit(buckets)).cast("int")), "dealt")
    none = F.lit(None).cast("long")
    ends = dealt.select("bucket", F.col("a").alias("node"), F.col("b").alias("partner")).unionAll(dealt.select("bucket", F.col("b").alias("node"), none.alias("partner")))
    wanted = ends.groupBy("bucket", "node").agg(F.collect_list("partner").alias("partners")).join(nodes.select("node", "doc", F.col("mark").alias("want")), "node")
    return whole_sets(texts, stored(wanted, "wanted"), words).groupBy("bucket").applyInArrow(pair_links(percent), "a long, b long")


def with_seekers(members: DataFrame) -> DataFrame:
    """The rows (``group``, ``root`` and others) of groups with several roots; ``seeks`` marks those outside the largest one, ``seekers`` counts them."""
    roots = members.groupBy("group", "root").agg(F.count(F.lit(1)).alias("m"))
    several = roots.groupBy("group").agg(F.max_by("root", F.struct("m", "root")).alias("largest"), F.sum("m").alias("members"),
                                         (F.sum("m") - F.max("m")).alias("seekers")).filter(F.col("seekers") > 0)
    return members.join(stored(several, "groups"), "group").withColumn("seeks", F.col("root") != F.col("largest"))


def may_link(percent: int) -> Column:
    """False only for sets (columns ``.._a`` and ``.._b``) whose parities differ in more places than linked sets of their sizes have different elements."""
    apart = sum((F.bit_count(F.col(f"{p}_a").bitwiseXOR(F.col(f"{p}_b"))) for p in PARITIES), F.lit(0))
    return (100 + percent) * apart <= (100 - percent) * (F.col("n_a") + F.col("n_b"))


def later_links(texts: DataFrame, matched: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between different components. ``nodes`` has ``node, short, n, need, component, doc, mark`` and ``PARITIES`` per set."""
    told = nodes.select("node", "short", "n", "need", F.col("component").alias("root"), *PARITIES)
    groups = matched.filter(F.col("kind") == GROUP).groupBy(F.col("a").alias("group"), F.col("b").alias("short")).agg(F.sum("c").alias("c"))
    members = stored(groups.join(told, "short"), "members")
    met = stored(with_seekers(members), "open")

    few = met.filter(F.col("members") <= SEEKERS)
    left = few.filter("seeks").select("group", "c", *[F.col(x).alias(f"{x}_a") for x in ("node", "n", "need", "root", *PARITIES)])
    right = few.select("group", "seeks", *[F.col(x).alias(f"{x}_b") for x in ("node", "n", "need", "root", *PARITIES)])
    cross = left.join(right, "group").filter(~F.col("seeks") | (F.col("node_a") < F.col("node_b")))
    ends = [told.select(*[F.col(x).alias(f"{x}_{e}") for x in told.columns]) for e in "ab"]
    only = matched.filter(F.col("kind") == PAIR).groupBy(F.col("a").alias("short_a"), F.col("b").alias("short_b")).agg(F.sum("c").alias("c"))
    only = only.join(ends[0], "short_a").join(ends[1], "short_b")
    low, high = F.least("node_a", "node_b"), F.greatest("node_a", "node_b")
    close = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    pairs = [t.filter((F.col("root_a") != F.col("root_b")) & close & may_link(percent)).select(low.alias("a"), high.alias("b"), "c", F.greatest("need_a", "need_b").alias("need")) for t in (cross, only)]
    enough = pairs[0].unionByName(pairs[1]).groupBy("a", "b").agg(F.sum("c").alias("c"), F.max("need").alias("need")).filter(F.col("c") >= F.col("need"))
    links = compared_pairs(texts, enough, nodes, words, percent)

    many = met.filter(F.col("members") > SEEKERS)
    return links if many.isEmpty() else links.unionAll(crowd_links(texts, many, nodes, words, percent))


def tallies(sets: DataFrame) -> np.ndarray:
    """About how often shingles occur in ``sets``, added up in ``TALLY`` places by their first bits: a table of bounded size. What a task meets once counts as
    unseen there. The table only gives the order of shingles; any order is right, and a good one makes lists short."""
    schema = pa.schema([("place", pa.int32()), ("n", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(TALLY, np.int64)
        for batch in small_batches(batches, "shingles", BATCH):
            np.add.at(held, tally_place(np.frombuffer(b"".join(batch.column("shingles").to_pylist()), np.uint64)), 1)
        at = np.flatnonzero(held > 1)
        yield as_table({"place": at.astype(np.int32), "n": held[at]}, schema)

    found = sets.select("shingles").mapInArrow(rows, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(TALLY, np.int64)
    total[found.column("place").to_numpy()] = found.column("n").to_numpy()
    return total


def tally_place(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(32)) * np.uint64(TALLY) >> np.uint64(32)).astype(np.int64)


def prefix(n, other, percent: int):
    """Of two linked sets of ``n`` and ``other`` shingles, in one order, the first ``prefix(n, other)`` and ``prefix(other, n)`` have one in common."""
    return n + 1 + -percent * (n + other) // (100 + percent)


def prefix_entries(sets: DataFrame, percent: int) -> DataFrame:
    """``shingle, at, node, root, seeks, n``: the shingles at the start of each set that a linked set of any size may need, rarest first."""
    shared = sets.sparkSession.sparkContext.broadcast(tallies(sets))
    schema = pa.schema([("shingle", pa.int64()), ("at", pa.int32()), ("node", pa.int64()), ("root", pa.int64()), ("seeks", pa.bool_()), ("n", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        usual = shared.value
        for batch in small_batches(batches, "shingles", BATCH):
            firsts, counts, sizes = [], [], []
            for raw in batch.column("shingles").to_pylist():
                x = np.frombuffer(raw, np.uint64)
                length = prefix(len(x), -(-percent * len(x) // 100), percent)
                firsts.append(x[np.lexsort((x, usual[tally_place(x)]))[:length]])
                counts.append(len(firsts[-1]))
                sizes.append(len(x))
            owner = np.repeat(np.arange(len(counts)), counts)
            told = batch.select(["node", "root", "seeks"]).take(pa.array(owner, pa.int64()))  # not the set itself, which would be copied for each entry
            yield as_table({"shingle": np.concatenate(firsts).view(np.int64), "at": np.concatenate([np.arange(c, dtype=np.int32) for c in counts]),
                            **{c: told.column(c) for c in ("node", "root", "seeks")}, "n": np.array(sizes, np.int64)[owner]}, schema)

    return sets.mapInArrow(rows, "shingle long, at int, node long, root long, seeks boolean, n long")


def by_size(percent: int):
    """Entries once for each band of sizes that a linked set may be in and that needs the entry: ``low`` and ``high`` are the two sets' bands."""
    schema = pa.schema([("shingle", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("at", pa.int32()), ("node", pa.int64()), ("root", pa.int64()),
                        ("seeks", pa.bool_()), ("n", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(NARROW)
        for batch in batches:
            n, at = batch.column("n").to_numpy(), batch.column("at").to_numpy()
            if not len(n):
                continue
            last = bands.of(int(n.max()) * 100 // percent)
            starts = np.array(bands.starts, np.int64)
            own = np.searchsorted(starts, n, side="right") - 1
            least, most = -(-percent * n // 100), n * 100 // percent
            for band in range(int(np.searchsorted(starts, least.min(), side="right")) - 1, last + 1):
                smallest = np.maximum(starts[band], least)
                keep = np.flatnonzero((smallest <= np.minimum(starts[band + 1] - 1, most)) & (at < prefix(n, smallest, percent)))
                if len(keep):
                    told = batch.take(pa.array(keep, pa.int64()))
                    yield as_table({"low": np.minimum(own[keep], band).astype(np.int32), "high": np.maximum(own[keep], band).astype(np.int32),
                                    **{c: told.column(c) for c in ("shingle", "at", "node", "root", "seeks", "n")}}, schema)

    return rows


def with_lists(entries: DataFrame, keys: list[str]) -> DataFrame:
    """Entries whose list, all those of equal ``keys``, has a seeker and sets of several components; ``members`` and ``first`` are its size and least node."""
    lists = entries.groupBy(*keys).agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("first"), F.max("seeks").alias("sought"),
                                       (F.min("root") != F.max("root")).alias("several"))
    return entries.join(lists.filter(F.col("sought") & F.col("several")).select(*keys, "members", "first"), keys)


def listed_pairs(entries: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Pairs (``a``, ``b``) of a seeker and another component's set in a list of at most ``LISTED`` sets, both near enough to the start for both sizes."""
    short = entries.filter(F.col("members") <= LISTED)
    left, right = (short.select(*keys, *[F.col(x).alias(f"{x}_{e}") for x in ("at", "node", "root", "seeks", "n")]) for e in "ab")
    met = left.filter("seeks_a").join(right, keys).filter((F.col("root_a") != F.col("root_b")) & (~F.col("seeks_b") | (F.col("node_a") < F.col("node_b"))))
    overlap = F.ceil(percent * (F.col("n_a") + F.col("n_b")) / F.lit(100 + percent))
    near = (F.col("at_a") <= F.col("n_a") - overlap) & (F.col("at_b") <= F.col("n_b") - overlap)
    return met.filter(near).select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))


def crowd_links(texts: DataFrame, many: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between different components among the sets of crowded groups. ``many`` has ``node, root, seeks`` per set and group."""
    crowd = many.groupBy("node").agg(F.min("root").alias("root"), F.max("seeks").alias("seeks"))
    sets = stored(whole_sets(texts, stored(crowd.join(nodes.select("node", "doc", F.col("mark").alias("want")), "node"), "crowd"), words), "crowd-sets")
    entries = stored(with_lists(stored(prefix_entries(sets, percent), "entries"), ["shingle"]), "lists")
    keys = ["shingle", "low", "high"]
    sized = entries.filter(F.col("members") > LISTED).select("shingle", "at", "node", "root", "seeks", "n").mapInArrow(
        by_size(percent), "shingle long, low int, high int, at int, node long, root long, seeks boolean, n long")
    sized = stored(with_lists(stored(sized, "sized"), keys), "sized-lists")
    pairs = listed_pairs(entries, ["shingle"], percent).unionAll(listed_pairs(sized, keys, percent)).distinct()
    links = compared_pairs(texts, pairs, nodes, words, percent)
    rest = stored(sized.filter(F.col("members") > LISTED).select("node", "root", "first").distinct(), "rest")
    if rest.isEmpty():
        return links
    pieces = smallest_reachable(rest.select(F.col("node").alias("a"), F.col("first").alias("b")))
    pieces = rest.select("node", "root").distinct().join(pieces.select("node", F.col("component").alias("group")), "node")
    met = stored(with_seekers(pieces), "pieces").withColumn("rows", F.ceil(F.col("seekers") / BLOCK).cast("int")).withColumn(
        "blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    place = lambda seed, n: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    seeking = met.filter("seeks").select("node", "group", place(2, "rows").alias("row"), spread("blocks").alias("block"), "seeks")
    sought = met.select("node", "group", spread("rows").alias("row"), place(3, "blocks").alias("block"), F.lit(False).alias("seeks"))
    dealt = seeking.unionByName(sought).join(sets.select("node", "shingles"), "node")
    return links.unionAll(dealt.groupBy("group", "row", "block").applyInArrow(seeker_stars(percent), "a long, b long"))


def clusters_of(matched: DataFrame, nodes: DataFrame) -> DataFrame:
    """``short, cluster`` of the sets that are tied to another by as many signatures as a link needs."""
    need = nodes.groupBy("short").agg(F.min("need").alias("need"))
    ties = matched.filter(F.col("kind") != GROUP).groupBy("a", "b").agg(F.sum("c").alias("c"))
    for end in "ab":
        ties = ties.join(need.select(F.col("short").alias(end), F.col("need").alias(f"need_{end}")), end)
    enough = ties.filter(F.col("c") >= F.greatest("need_a", "need_b")).select("a", "b")
    return smallest_reachable(enough).select(F.col("node").alias("short"), F.col("component").alias("cluster"))


def block_links(texts: DataFrame, members: DataFrame, words: int, percent: int) -> DataFrame:
    """Spanning stars of the links inside the blocks of each cluster and with its pivots. ``members`` has ``node, doc, mark, n, cluster`` per set."""
    sizes = stored(members.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"), F.min("node").alias("low"),
                                                  F.max("node").alias("high"), F.sum("n").alias("held")), "clusters")
    placed = members.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pivot = (F.col("node") == F.col("low")) | (F.col("node") == F.col("high"))
    places = F.when((F.col("blocks") > 1) & pivot, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    wanted = stored(placed.select("node", "doc", F.col("mark").alias("want"), "cluster", F.explode(places).alias("block")), "wanted")
    held = sizes.agg(F.sum("held")).first()[0] or 0
    buckets = max(1, 8 * held // BUCKET_BYTES)
    sets = whole_sets(texts, wanted, words).withColumn("bucket", F.pmod(F.xxhash64("cluster", "block"), F.lit(buckets)).cast("int"))
    return sets.groupBy("bucket").applyInArrow(block_stars(percent), "a long, b long")


def with_components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    return nodes.join(smallest_reachable(links), "node", "left").withColumn("component", F.coalesce("component", "node"))


def jaccard_components(docs: DataFrame, percent: int = PERCENT, words: int = WORDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row; documents link when ``100 * intersection >= percent * union``."""
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    common = common_shingles(texts, texts.count(), words)
    rows = stored(counted_sets(texts, common, words, percent), "sets")
    total = rows.agg(F.sum("n")).first()[0] or 0
    nodes = stored(rows.filter(F.col("mark").isNotNull()).groupBy("mark").agg(F.min("doc_id").alias("doc"), *[F.min(x).alias(x) for x in ("short", "n", "need", *PARITIES)])
                   .withColumn("node", F.monotonically_increasing_id()), "nodes")
    blocks = signature_blocks(texts, common, max(1, 7 * total // PART_BYTES), words, percent)
    matched = stored(blocks.groupBy("part").applyInArrow(matched_sets, "kind int, a long, b long, c long"), "matched")
    members = stored(nodes.join(clusters_of(matched, nodes), "short"), "members")
    first = stored(block_links(texts, members, words, percent), "stars")
    met = stored(with_components(nodes, first), "met")
    later = stored(later_links(texts, matched, met, words, percent), "later")
    groups = with_components(nodes, first.unionAll(later))
    least = groups.groupBy("component").agg(F.min("doc").alias("component_id"))
    answer = stored(groups.join(least, "component").select("mark", "component_id"), "answer")
    return rows.join(answer, "mark", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("mark").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
