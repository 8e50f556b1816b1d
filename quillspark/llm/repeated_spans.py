"""Removing byte strings that occur more than once, with suffix arrays over shards of candidate text.

Every ``window``-byte string contains an anchor, the ``gram``-byte string of smallest hash inside it, at a place that its content fixes. So two equal
windows meet under the same anchor. Anchors that occur once need no further look. The surroundings of the others, as far as windows around the anchor
reach, are candidates:

* where all surroundings of an anchor are equal, all their windows repeat;
* otherwise one of each equal kind goes to a shard with others of its anchor. A shard's suffix array is induced, the common prefixes with the
  predecessors give the classes of equal windows, and a class from two places marks its places;
* an anchor with very many different surroundings is split by all its windows, which are counted by content, so that no task gets all of them.

Equal texts are processed once. Edge cases: a null text is empty; texts shorter than the window lose nothing. Bytes are removed by what the input has,
overlapping windows included. Repeated rows are equal texts and lose all their bytes if they are long enough. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import as_table, small_batches, stored
from .suffix_array import common_prefixes, suffix_array

WINDOW, GRAM = 200, 64
BATCH = 1 << 20
ENTRY_BYTES = 8 << 20
SHARD_BYTES = 1 << 20
CROWDED = 256
LOW48 = np.uint64((1 << 48) - 1)
BASE = 0x9E3779B97F4A7C15
WEIGHTS = np.array([(BASE * (2 * b + 3) ** 7 + b) % (1 << 64) | 1 for b in range(256)], dtype=np.uint64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    size = 1 << max(16, n.bit_length())
    if size not in _powers:
        one = np.uint64(1)
        _powers.clear()
        _powers[size] = tuple(np.cumprod(np.concatenate([[one], np.full(size, b, np.uint64)]), dtype=np.uint64) for b in (
            np.uint64(BASE), np.uint64(pow(BASE, -1, 1 << 64))))
    return _powers[size]


class Rolling:
    """Hashes of any substring of some bytes."""

    def __init__(self, raw: np.ndarray):
        up, self.down = powers(len(raw))
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(WEIGHTS[raw] * up[:len(raw)], dtype=np.uint64)])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:n]) * self.down[:n] + np.uint64(size))


def running(values: np.ndarray, width: int, pick: np.ufunc, fill: int) -> np.ndarray:
    """``pick`` over each stretch of ``width`` values, by its first position."""
    n = len(values)
    if n < width:
        return values[:0]
    rows = -(-n // width)
    padded = np.full(rows * width, fill, dtype=values.dtype)
    padded[:n] = values
    grid = padded.reshape(rows, width)
    ahead = pick.accumulate(grid, axis=1).ravel()
    back = np.ascontiguousarray(pick.accumulate(grid[:, ::-1], axis=1)[:, ::-1]).ravel()
    return pick(back[:n - width + 1], ahead[width - 1:n])


def anchors(raw: np.ndarray, rolling: Rolling, starts: np.ndarray, ends: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions that are the smallest gram of some window inside a text, and their hashes. ``starts`` and ``ends`` bound the texts."""
    if len(raw) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    value = rolling.grams(gram) | np.uint64(1)
    width = window - gram + 1
    least = running(value, width, np.minimum, 2 ** 64 - 1)
    inside = np.zeros(len(least) + 1, dtype=np.int64)
    fit = ends - window >= starts
    np.add.at(inside, starts[fit], 1)
    np.add.at(inside, ends[fit] - window + 1, -1)
    least[np.cumsum(inside)[:-1] == 0] = 0
    padded = np.zeros(len(value) + width - 1, dtype=np.uint64)
    padded[width - 1:width - 1 + len(least)] = least
    chosen = np.flatnonzero((running(padded, width, np.maximum, 0) == value))
    return chosen, value[chosen]


def text_key(raw: bytes) -> int:
    """48 bits of a text's digest; the same as :func:`key_column`."""
    return int.from_bytes(hashlib.md5(raw).digest()[:6], "big")


def texts_of(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary").alias("text"))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    return np.frombuffer(b"".join(texts), dtype=np.uint8), ends - sizes, ends


def anchor_entries(texts: DataFrame, parts: int, window: int, gram: int) -> DataFrame:
    """``part, entries``: per anchor 32 bytes with its hash, the text's key, the place in the text, and a hash of its surroundings."""
    schema = pa.schema([("part", pa.int32()), ("entries", pa.binary())])
    side = window - gram

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in small_batches(batches, "text", BATCH):
            held = {text_key(t): t for t in batch.column("text").to_pylist() if len(t) >= window}
            keys = [k for k in held if k not in seen]
            if not keys:
                continue
            seen.update(keys)
            raw, starts, ends = joined([held[k] for k in keys])
            rolling = Rolling(raw)
            at, value = anchors(raw, rolling, starts, ends, window, gram)
            owner = np.searchsorted(ends, at, side="right")
            left, right = np.maximum(at - side, starts[owner]), np.minimum(at + window, ends[owner])
            entry = np.stack([value, np.array(keys, dtype=np.uint64)[owner], (at - starts[owner]).astype(np.uint64), rolling.of(left, right)], axis=1)
            part = ((mixed(value) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            yield split_entries(entry, part, schema)

    return texts.select("text").mapInArrow(rows, "part int, entries binary")


def split_entries(entry: np.ndarray, part: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    order = np.argsort(part, kind="stable")
    entry, part = np.ascontiguousarray(entry[order].astype("<u8")), part[order]
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    ends = np.append(cuts[1:], len(part))
    raw, width = entry.tobytes(), 8 * entry.shape[1]
    return as_table({"part": part[cuts].astype(np.int32), "entries": [raw[width * a:width * b] for a, b in zip(cuts, ends)]}, schema)


def shared_anchors(crowded: int, window: int):
    """For one part: ``key, kind, places``. Kind 0 has anchors whose surroundings repeat as a whole, 1 anchors to compare, 2 anchors with too many
    different surroundings; ``places`` are pairs of an anchor's hash and its place in the text."""
    def rows(table: pa.Table) -> pa.Table:
        e = np.frombuffer(b"".join(table.column("entries").to_pylist()), dtype="<u8").reshape(-1, 4)
        e = e[np.lexsort((e[:, 2], e[:, 1], e[:, 3], e[:, 0]))]
        fresh = np.append(True, (e[1:] != e[:-1]).any(axis=1)) if len(e) else np.zeros(0, bool)
        e = e[fresh]
        if not len(e):
            return pa.table({"key": pa.array([], pa.int64()), "kind": pa.array([], pa.int32()), "places": pa.array([], pa.binary())})
        new_anchor = np.append(True, e[1:, 0] != e[:-1, 0])
        new_kind = new_anchor | np.append(True, e[1:, 3] != e[:-1, 3])
        sizes = counts(new_anchor)
        kinds = np.add.reduceat(new_kind.astype(np.int64), np.flatnonzero(new_anchor))
        kinds = np.repeat(kinds, sizes)
        alike = np.repeat(counts(new_kind), counts(new_kind))
        whole = alike > 1
        compare = (np.repeat(sizes, sizes) > 1) & (kinds > 1) & (kinds <= crowded) & new_kind
        many = (kinds > crowded) & new_kind
        out = {"key": [], "kind": [], "places": []}
        for kind, mask in ((0, whole), (1, compare), (2, many)):
            rows_ = e[mask]
            rows_ = rows_[np.argsort(rows_[:, 1], kind="stable")]
            cuts = np.flatnonzero(np.append(True, rows_[1:, 1] != rows_[:-1, 1])) if len(rows_) else np.zeros(0, np.int64)
            ends = np.append(cuts[1:], len(rows_))
            flat = np.ascontiguousarray(rows_[:, [0, 2]]).astype("<u8").tobytes()
            out["key"] += rows_[cuts, 1].astype(np.int64).tolist()
            out["kind"] += [kind] * len(cuts)
            out["places"] += [flat[16 * a:16 * b] for a, b in zip(cuts, ends)]
        return pa.table({"key": pa.array(out["key"], pa.int64()), "kind": pa.array(out["kind"], pa.int32()), "places": pa.array(out["places"], pa.binary())})

    return rows


def counts(heads: np.ndarray) -> np.ndarray:
    return np.diff(np.append(np.flatnonzero(heads), len(heads)))


def surroundings(candidates: DataFrame, parts: int, window: int, gram: int) -> DataFrame:
    """``part, key, start, bytes``: the text around each anchor to compare, dealt by the anchor."""
    schema = pa.schema([("part", pa.int32()), ("key", pa.int64()), ("start", pa.int64()), ("bytes", pa.binary())])
    side = window - gram

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BATCH):
            out = {f.name: [] for f in schema}
            for key, text, places in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "places"))):
                spots = np.frombuffer(b"".join(places), dtype="<u8").reshape(-1, 2)
                part = ((mixed(spots[:, 0].copy()) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
                for p, at in zip(part.tolist(), spots[:, 1].tolist()):
                    start = max(0, at - side)
                    out["part"].append(p)
                    out["key"].append(key)
                    out["start"].append(start)
                    out["bytes"].append(text[start:at + window])
            yield as_table(out, schema)

    return candidates.mapInArrow(rows, "part int, key long, start long, bytes binary")


def shard_spans(window: int):
    """For one shard of surroundings: spans of texts (``key, start, end``) whose windows occur at another place too."""
    def rows(table: pa.Table) -> pa.Table:
        pieces = table.column("bytes").to_pylist()
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        s = np.frombuffer(b"\0".join(pieces) + b"\0", dtype=np.uint8).astype(np.int16) + 1
        begins = np.cumsum(sizes + 1) - sizes - 1
        s[begins + sizes] = 0
        order = suffix_array(s, 257)
        shared = common_prefixes(s, order, stop=0)
        owner = np.repeat(np.arange(len(pieces)), sizes + 1)
        offset = np.arange(len(s)) - begins[owner]
        fits = offset + window <= sizes[owner]
        key, start = table.column("key").to_numpy(), table.column("start").to_numpy()
        place = offset + start[owner]
        # A class is a run of suffixes that share a window with their predecessor. No window reaches over an end, as ends are symbols of their own and
        # only suffixes with a whole window count.
        head = ~((shared[order] >= window) & fits[order])
        run = np.cumsum(head) - 1
        ok = fits[order]
        texts, places = key[owner[order]], place[order]
        first = np.flatnonzero(head)
        other = (texts != texts[first][run]) | (places != places[first][run])
        several = np.zeros(len(first), dtype=bool)
        several[run[other & ok]] = True
        found = ok & several[run]
        return spans(texts[found], places[found], window)

    return rows


def spans(keys: np.ndarray, places: np.ndarray, window: int) -> pa.Table:
    """Windows at places of texts as joined spans."""
    order = np.lexsort((places, keys))
    keys, places = keys[order], places[order]
    head = np.append(True, (keys[1:] != keys[:-1]) | (places[1:] > places[:-1] + window)) if len(keys) else np.zeros(0, bool)
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(keys)) - 1
    return pa.table({"key": pa.array(keys[first].astype(np.int64), pa.int64()), "start": pa.array(places[first].astype(np.int64), pa.int64()),
                     "end": pa.array(places[last].astype(np.int64) + window, pa.int64())})


def window_entries(candidates: DataFrame, parts: int, window: int, gram: int) -> DataFrame:
    """``part, entries``: for crowded anchors all their windows, 24 bytes with the window's hash, the text and the place, dealt by the hash."""
    schema = pa.schema([("part", pa.int32()), ("entries", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BATCH):
            entries = []
            for key, text, places in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "places"))):
                at = np.frombuffer(b"".join(places), dtype="<u8").reshape(-1, 2)[:, 1].astype(np.int64)
                begin = np.unique((at[:, None] - np.arange(window - gram + 1)[None, :]).ravel())
                begin = begin[(begin >= 0) & (begin + window <= len(text))]
                value = Rolling(np.frombuffer(text, dtype=np.uint8)).of(begin, begin + window)
                entries.append(np.stack([value, np.full(len(begin), key, np.uint64), begin.astype(np.uint64)], axis=1))
            entry = np.concatenate(entries)
            if len(entry):
                part = ((mixed(entry[:, 0].copy()) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
                yield split_entries(entry, part, schema)

    return candidates.mapInArrow(rows, "part int, entries binary")


def window_spans(window: int):
    def rows(table: pa.Table) -> pa.Table:
        e = np.frombuffer(b"".join(table.column("entries").to_pylist()), dtype="<u8").reshape(-1, 3)
        e = e[np.lexsort((e[:, 2], e[:, 1], e[:, 0]))]
        e = e[np.append(True, (e[1:] != e[:-1]).any(axis=1))] if len(e) else e
        n = np.zeros(0, np.int64)
        if len(e):
            heads = np.append(True, e[1:, 0] != e[:-1, 0])
            n = np.repeat(counts(heads), counts(heads))
        return spans(e[n > 1, 1], e[n > 1, 2].astype(np.int64), window)

    return rows


def kept_texts(candidates: DataFrame) -> DataFrame:
    """``key, n_removed, n_spans, kept_sha256, kept`` of texts with their spans (``places``: starts and ends)."""
    schema = pa.schema([("key", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BATCH):
            out = {f.name: [] for f in schema}
            for key, text, found in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "found"))):
                kept, at, removed, runs = [], 0, 0, 0
                for start, end in union(sorted((x["start"], x["end"]) for x in found)):
                    kept.append(text[at:start])
                    removed, runs, at = removed + end - start, runs + 1, end
                left = b"".join([*kept, text[at:]])
                for name, value in (("key", key), ("n_removed", removed), ("n_spans", runs), ("kept_sha256", hashlib.sha256(left).hexdigest()), ("kept", left)):
                    out[name].append(value)
            yield as_table(out, schema)

    return candidates.mapInArrow(rows, "key long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def union(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    joined_: list[tuple[int, int]] = []
    for start, end in found:
        if joined_ and start <= joined_[-1][1]:
            joined_[-1] = (joined_[-1][0], max(end, joined_[-1][1]))
        else:
            joined_.append((start, end))
    return joined_


def whole_spans(shared: DataFrame, sizes: DataFrame, window: int, gram: int) -> DataFrame:
    """The surroundings of anchors of kind 0, as spans."""
    schema = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
    side = window - gram

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"key": [], "start": [], "end": []}
            for key, n, places in zip(*(batch.column(c).to_pylist() for c in ("key", "n", "places"))):
                at = np.frombuffer(places, dtype="<u8").reshape(-1, 2)[:, 1].astype(np.int64)
                for start, end in union(sorted(zip(np.maximum(at - side, 0).tolist(), np.minimum(at + window, n).tolist()))):
                    out["key"].append(key)
                    out["start"].append(start)
                    out["end"].append(end)
            yield as_table(out, schema)

    return shared.filter(F.col("kind") == 0).join(sizes, "key").select("key", "n", "places").mapInArrow(rows, "key long, start long, end long")


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_column: str = "doc_id", text_column: str = "text",
                   keep_text: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row, with ``keep_text`` also the ``kept`` bytes of rows that lost some."""
    texts = texts_of(docs, id_column, text_column)
    digest = F.md5("text")
    key = F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")
    rows = stored(texts.select("doc_id", digest.alias("mark"), key.alias("key"), F.octet_length("text").cast("long").alias("n_bytes"),
                               F.sha2("text", 256).alias("sha")), "rows")
    same = stored(rows.groupBy("mark").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("copies"), F.min("n_bytes").alias("n"),
                                           F.min(F.coalesce("doc_id", F.lit(-1 << 63))).alias("doc")), "same")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    blocks = anchor_entries(texts, max(1, total * 32 // 60 // ENTRY_BYTES), window, gram)
    shared = stored(blocks.groupBy("part").applyInArrow(shared_anchors(CROWDED, window), "key long, kind int, places binary"), "anchors")

    # Copies of long texts go as a whole; the others' texts are fetched once, by one of their rows.
    single = stored(same.filter(F.col("n") >= window), "long")
    places = stored(shared.groupBy("key").agg(
        F.collect_list(F.when(F.col("kind") == 1, F.col("places"))).alias("compare"), F.collect_list(F.when(F.col("kind") == 2, F.col("places"))).alias("many")),
        "places")
    wanted = stored(single.join(places, "key"), "wanted")
    met = texts.withColumn("doc", F.coalesce("doc_id", F.lit(-1 << 63))).join(wanted, "doc").filter(F.md5("text") == F.col("mark")).dropDuplicates(["mark"])
    candidates = stored(met.select("key", "mark", "copies", "text", "compare", "many"), "candidates")

    compare = candidates.filter(F.size("compare") > 0).select("key", "text", F.col("compare").alias("places"))
    around = shared.filter(F.col("kind") == 1).agg(F.sum(F.octet_length("places"))).first()[0] or 0
    shards = surroundings(compare, max(1, around // 16 * (2 * window - gram) // SHARD_BYTES), window, gram)
    by_shard = shards.groupBy("part").applyInArrow(shard_spans(window), "key long, start long, end long")
    crowded = candidates.filter(F.size("many") > 0).select("key", "text", F.col("many").alias("places"))
    many = shared.filter(F.col("kind") == 2).agg(F.sum(F.octet_length("places"))).first()[0] or 0
    by_window = window_entries(crowded, max(1, many // 16 * (window - gram) * 24 // ENTRY_BYTES), window, gram).groupBy("part").applyInArrow(
        window_spans(window), "key long, start long, end long")
    whole = whole_spans(shared, single.select("key", "n"), window, gram)
    found = stored(by_shard.unionAll(by_window).unionAll(whole), "spans").groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    once = candidates.filter(F.col("copies") == 1).select("key", "mark", "text").join(found, "key")
    result = kept_texts(once.select("key", "text", "found")).join(candidates.select("key", "mark"), "key")
    extra = ["kept"] if keep_text else []
    cut = stored(result.select("mark", "n_removed", "n_spans", "kept_sha256", *extra), "cut")
    gone = same.filter((F.col("copies") > 1) & (F.col("n") >= window)).select(
        "mark", F.col("n").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.sha2(F.lit("").cast("binary"), 256).alias("kept_sha256"),
        *[F.lit("").cast("binary").alias(c) for c in extra])
    changed = stored(cut.unionAll(gone), "changed")
    return rows.join(changed, "mark", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"), *extra)
