"""N-gram vocabularies, TF-IDF and count features.

Terms are counted inside tasks, batch by batch, on Arrow arrays of token codes, so the only shuffle of the vocabulary job is the per-term
total, and it is combined map-side first. N-grams are counted length by length on stored codes, and only those whose parts can still be chosen: an n-gram is
never more frequent than a part of it, and each length counted raises the floor for the next. A row's weights are made in its own task: no row is exploded, joined or gathered again. The vocabulary is
capped by ``max_features``, which bounds what is collected and broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..session import stored

MAX_VOCABULARY = 100_000
POOL = 200_000
STEP_TOKENS = 1 << 20
MERGED = 1 << 20


@dataclass(frozen=True)
class VectorizerSpec:
    """What to count and how to weigh it."""

    low: int = 1
    high: int = 1
    min_df: int = 1
    max_df: float = 1.0
    max_features: int = 5000
    sublinear: bool = False
    kind: str = "tfidf"

    def __post_init__(self) -> None:
        if self.kind not in ("tfidf", "count"):
            raise ValueError("vectorizer kind must be 'tfidf' or 'count'")
        if not 0 < self.max_features <= MAX_VOCABULARY:
            raise ValueError(f"max_features must be between 1 and {MAX_VOCABULARY}")


BOOK_TFIDF = VectorizerSpec(1, 3, 3, 0.7, 2000, sublinear=True)
BOOK_COUNT = VectorizerSpec(1, 3, 3, 0.7, 2000, kind="count")
REVIEW_TFIDF = VectorizerSpec(1, 2, 1, 1.0, 5000)
REVIEW_COUNT = VectorizerSpec(1, 2, 1, 1.0, 5000, kind="count")


@dataclass(frozen=True)
class Vocabulary:
    """The chosen terms in alphabetical order, with corpus counts. At most ``spec.max_features`` rows."""

    spec: VectorizerSpec
    n_docs: int
    rows: tuple[tuple[str, int, int, int], ...]

    @property
    def size(self) -> int:
        return len(self.rows)

    @property
    def terms(self) -> list[str]:
        return [r[0] for r in self.rows]

    def table(self, spark: SparkSession) -> DataFrame:
        base = spark.createDataFrame(list(self.rows), "term string, term_idx int, tf long, df long")
        return base.withColumn("idf", F.log((1.0 + self.n_docs) / (1.0 + F.col("df"))) + 1.0)


def steps(batch: pa.RecordBatch, column: str, most: int = STEP_TOKENS) -> Iterator[tuple[pa.RecordBatch, np.ndarray, pa.Array]]:
    """Slices of a batch with about ``most`` list entries each, with the row of each entry and the entries."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + most, side="right")))
        part = batch.slice(start, stop - start)
        yield part, np.repeat(np.arange(stop - start), sizes[start:stop]), part.column(column).flatten()
        start = stop


def _following(rows: np.ndarray, at: np.ndarray, ahead: int) -> np.ndarray:
    """Which entries ``at`` have an entry of the same row ``ahead`` places on."""
    last = len(rows) - ahead
    return (at < last) & (rows[np.minimum(at + ahead, len(rows) - 1)] == rows[at])


def _totals(df: DataFrame, text: str, spec: VectorizerSpec, pool: list[str] | None = None) -> DataFrame:
    """``term, tf, df`` of every n-gram (of words in ``pool``, if given); a row with a null term counts the texts as ``tf``."""
    shared = df.sparkSession.sparkContext.broadcast(pa.array(pool, pa.string())) if pool is not None else None
    schema = pa.schema([("term", pa.string()), ("tf", pa.int64()), ("df", pa.int64())])

    def counted(terms: pa.Array, code: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
        tf = np.bincount(code, minlength=len(terms))
        once = np.unique(rows * max(len(terms), 1) + code) % max(len(terms), 1)
        return pa.RecordBatch.from_arrays([terms, pa.array(tf), pa.array(np.bincount(once, minlength=len(terms)))], schema=schema)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            n += batch.num_rows
            for _, rows, tokens in steps(batch, "tokens"):
                coded = tokens.cast(pa.string()).dictionary_encode()
                words, word = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                known = np.ones(len(words), dtype=bool) if shared is None else pc.is_in(words, value_set=shared.value).to_numpy(zero_copy_only=False)
                at = np.nonzero(known[word])[0]
                code, names = word[at], words
                for n_words in range(1, spec.high + 1):
                    if n_words > 1:
                        on = _following(rows, at, n_words - 1)
                        on[on] = known[word[at[on] + n_words - 1]]
                        at, pair = at[on], code[on] * len(words) + word[at[on] + n_words - 1]
                        keys, code = np.unique(pair, return_inverse=True)
                        names = pc.binary_join_element_wise(names.take(pa.array(keys // max(len(words), 1))), words.take(pa.array(keys % max(len(words), 1))), " ")
                    if n_words >= spec.low and len(at):
                        made = counted(names, code, rows[at])
                        yield made.filter(pc.greater(made.column("tf"), 0))
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.string()), pa.array([n]), pa.array([0])], schema=schema)

    found = df.select(X.feature_tokens(F.col(text)).alias("tokens")).mapInArrow(totals, "term string, tf long, df long")
    return found.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def _within(totals: DataFrame, spec: VectorizerSpec, n_docs: int) -> DataFrame:
    return totals.filter(F.col("term").isNotNull() & (F.col("df") >= spec.min_df) & (F.col("df") <= spec.max_df * n_docs))


def _size(totals: DataFrame) -> int:
    return totals.filter("term IS NULL").agg(F.sum("tf")).first()[0] or 0


def _frequent_words(singles: DataFrame, spec: VectorizerSpec, n_docs: int) -> list[str] | None:
    """The words that chosen n-grams can be made of, or None if they are too many to send around.

    An n-gram is never more frequent than its rarest word. If ``max_features`` single words are allowed, the count of
    the last of them is a floor for every chosen term, so n-grams with a word below it need not be counted at all.
    """
    ranked = _within(singles, spec, n_docs).orderBy(F.desc("tf")).select("tf").limit(spec.max_features).collect()
    floor = ranked[-1]["tf"] if len(ranked) == spec.max_features else max(spec.min_df, 1)
    words = singles.filter((F.col("tf") >= floor) & F.col("term").isNotNull()).select("term").limit(POOL + 1).collect()
    return [r["term"] for r in words] if len(words) <= POOL else None


def _coded(df: DataFrame, text: str, pool: list[str]) -> DataFrame:
    """``codes``: each text's tokens as places in ``pool``, -1 for other words. Stored."""
    shared = df.sparkSession.sparkContext.broadcast(pa.array(pool, pa.string()))

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, rows, tokens in steps(batch, "tokens"):
                place = pc.fill_null(pc.index_in(tokens.cast(pa.string()), value_set=shared.value), -1).cast(pa.int32())
                ends = np.append(0, np.cumsum(np.bincount(rows, minlength=part.num_rows))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends), place)], names=["codes"])

    return stored(df.select(X.feature_tokens(F.col(text)).alias("tokens")).mapInArrow(codes, "codes array<int>"), "codes")


def _gram_totals(coded: DataFrame, size: int, allowed: list[np.ndarray]) -> DataFrame:
    """``key, tf, df`` of the n-grams of ``len(allowed) + 2`` words whose parts are allowed. ``allowed`` has the sorted keys of two words and more; a key is the
    place of all words but the last, times ``size``, and the last word's place."""
    shared = coded.sparkSession.sparkContext.broadcast(allowed)
    schema = pa.schema([("key", pa.int64()), ("tf", pa.int64()), ("df", pa.int64())])

    def merged(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, place = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
        return keys, *(np.bincount(place, weights=np.concatenate([f[i] for f in found]), minlength=len(keys)).astype(np.int64) for i in (1, 2))

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            for _, rows, codes in steps(batch, "codes"):
                word = codes.to_numpy(zero_copy_only=False).astype(np.int64)
                gram, key = word, word
                for n in range(2, len(shared.value) + 3):
                    at = np.nonzero(gram >= 0)[0]
                    at = at[_following(rows, at, n - 1)]
                    at = at[gram[at + 1] >= 0]
                    key = gram[at] * size + word[at + n - 1]
                    if n < len(shared.value) + 2:
                        keys = shared.value[n - 2]
                        place = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
                        gram = np.full(len(word), -1)
                        hit = keys[place] == key if len(keys) else np.zeros(len(key), dtype=bool)
                        gram[at[hit]] = place[hit]
                if not len(key):
                    continue
                keys, code, tf = np.unique(key, return_inverse=True, return_counts=True)
                once = np.unique(rows[at] * len(keys) + code) % len(keys)
                held.append((keys, tf, np.bincount(once, minlength=len(keys))))
                if sum(len(h[0]) for h in held) > MERGED:
                    held = [merged(held)]
                    if len(held[0][0]) > MERGED // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held.pop()], schema=schema)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged(held)], schema=schema)

    return coded.mapInArrow(totals, "key long, tf long, df long").groupBy("key").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def _grown(df: DataFrame, text: str, spec: VectorizerSpec, n_docs: int, top: list, pool: list[str]) -> list | None:
    """The chosen ``(term, tf, df)``, from those of one word and the words that longer ones can be made of, or None if too many n-grams stay possible."""
    spark, coded, size = df.sparkSession, _coded(df, text, pool), len(pool)
    names, allowed = pool, []
    words = F.broadcast(spark.createDataFrame(pa.table({"_last": pa.array(range(size), pa.int64()), "_word": pa.array(pool, pa.string())})))
    for n in range(2, spec.high + 1):
        floor = top[-1][1] if len(top) == spec.max_features else max(spec.min_df, 1)
        totals = _gram_totals(coded, size, allowed).filter(F.col("tf") >= floor).persist()
        parts = F.broadcast(spark.createDataFrame(pa.table({"_part": pa.array(range(len(names)), pa.int64()), "_name": pa.array(names, pa.string())})))
        inside = totals.filter((F.col("df") >= spec.min_df) & (F.col("df") <= spec.max_df * n_docs))
        named = inside.select("tf", "df", F.expr(f"key div {size}L").alias("_part"), F.expr(f"key % {size}L").alias("_last")).join(parts, "_part").join(words, "_last")
        more = named.select(F.concat("_name", F.lit(" "), "_word").alias("term"), "tf", "df").orderBy(F.desc("tf"), "term").limit(spec.max_features).collect()
        top = sorted([*top, *((r["term"], r["tf"], r["df"]) for r in more)], key=lambda r: (-r[1], r[0].encode()))[:spec.max_features]
        if n < spec.high:
            floor = top[-1][1] if len(top) == spec.max_features else max(spec.min_df, 1)
            keys = totals.filter(F.col("tf") >= floor).select("key").limit(POOL + 1).toArrow().column("key").to_numpy()
            if len(keys) > POOL:
                totals.unpersist()
                return None
            allowed.append(np.sort(keys))
            names = [f"{names[k // size]} {pool[k % size]}" for k in allowed[-1].tolist()]
        totals.unpersist()
    return top


def fit(df: DataFrame, text: str, spec: VectorizerSpec) -> Vocabulary:
    """Terms within the document-frequency limits, then the most frequent ``max_features`` of them."""
    totals = _totals(df, text, replace(spec, high=spec.low)).persist()
    n_docs = _size(totals)

    def best() -> list:
        return [(r["term"], r["tf"], r["df"]) for r in _within(totals, spec, n_docs).orderBy(F.desc("tf"), "term").limit(spec.max_features).collect()]

    if spec.high == spec.low:
        top = best()
    else:
        pool = _frequent_words(totals, spec, n_docs) if spec.low == 1 else None
        top = _grown(df, text, spec, n_docs, best(), pool) if pool is not None else None
        if top is None:
            totals.unpersist()
            totals = _totals(df, text, spec, pool).persist()
            top = best()
    totals.unpersist()
    ordered = sorted(top, key=lambda r: r[0].encode())
    return Vocabulary(spec, n_docs, tuple((term, i, tf, df) for i, (term, tf, df) in enumerate(ordered)))


def raw_weight(spec: VectorizerSpec, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    if spec.kind == "count":
        return tf.astype(np.float64)
    return (1.0 + np.log(tf) if spec.sublinear else tf) * idf


class Matcher:
    """Finds a vocabulary's terms in token arrays: one lookup of words, then one of (term so far, next word) per further word of a term."""

    def __init__(self, vocab: Vocabulary):
        split = [t.split(" ") for t in vocab.terms]
        self.words = sorted({w for t in split for w in t})
        place = {w: i for i, w in enumerate(self.words)}
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        code = np.zeros(len(split), dtype=np.int64)
        for n in range(max((len(t) for t in split), default=0)):
            key = np.array([code[i] * len(place) + place[t[n]] if len(t) > n else -1 for i, t in enumerate(split)], dtype=np.int64)
            keys = np.unique(key[key >= 0])
            code = np.searchsorted(keys, key)
            ends = np.full(len(keys), -1, dtype=np.int64)
            for i, t in enumerate(split):
                if len(t) == n + 1:
                    ends[code[i]] = i
            self.levels.append((keys, ends))

    def __call__(self, tokens: pa.Array, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and term of every occurrence."""
        found_rows, found_terms = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        if not len(tokens) or not self.words:
            return found_rows[0], found_terms[0]
        word = pc.fill_null(pc.index_in(tokens.cast(pa.string()), value_set=pa.array(self.words, pa.string())), -1).to_numpy().astype(np.int64)
        at, code = np.nonzero(word >= 0)[0], None
        for n, (keys, ends) in enumerate(self.levels):
            if n:
                on = _following(rows, at, n)
                at, code = at[on], code[on]
            nxt = word[at + n]
            key = nxt if code is None else code * len(self.words) + nxt
            place = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
            hit = (nxt >= 0) & (keys[place] == key) if len(keys) else np.zeros(len(key), dtype=bool)
            at, code = at[hit], place[hit]
            full = ends[code] >= 0
            found_rows.append(rows[at[full]])
            found_terms.append(ends[code[full]])
        return np.concatenate(found_rows), np.concatenate(found_terms)


def sparse_rows(df: DataFrame, text: str, vocab: Vocabulary, key: str = "row_id",
                carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``df``: key, the ``carry`` columns, and parallel arrays ``idx`` (ascending) and ``weight``; unit length for TF-IDF, empty without terms."""
    idf = np.array([np.log((1.0 + vocab.n_docs) / (1.0 + r[3])) + 1.0 for r in vocab.rows])
    shared = df.sparkSession.sparkContext.broadcast((Matcher(vocab), idf))
    spec, size = vocab.spec, max(vocab.size, 1)

    def weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, idf = shared.value
        for batch in batches:
            for part, rows, tokens in steps(batch, "_tokens"):
                row, term = matcher(tokens, rows)
                pair, tf = np.unique(row * size + term, return_counts=True)
                row, term = pair // size, pair % size
                weight = raw_weight(spec, tf, idf[term] if len(idf) else np.zeros(len(term)))
                if spec.kind != "count":
                    weight = weight / np.sqrt(np.bincount(row, weights=weight * weight, minlength=part.num_rows))[row]
                ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=part.num_rows))]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v)) for v in (term.astype(np.int32), weight.astype(np.float64))]
                names = [c for c in part.schema.names if c != "_tokens"]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], *lists], names=[*names, "idx", "weight"])

    given = df.select(key, *carry, X.feature_tokens(F.col(text)).alias("_tokens"))
    out = T.StructType([*given.schema.fields[:-1], T.StructField("idx", T.ArrayType(T.IntegerType())), T.StructField("weight", T.ArrayType(T.DoubleType()))])
    return given.mapInArrow(weights, out)


def long_rows(sparse: DataFrame, vocab: Vocabulary, key: str = "row_id") -> DataFrame:
    """``(key, term, term_idx, weight)``, one row per non-zero entry."""
    pairs = F.arrays_zip(F.col("idx").alias("idx"), F.col("weight").alias("weight"))
    flat = X.each(sparse, [key], pairs, "p").select(
        key, F.col("p.idx").alias("term_idx"), F.col("p.weight").alias("weight"))
    return flat.join(F.broadcast(vocab.table(sparse.sparkSession).select("term_idx", "term")), "term_idx")


def feature_names(vocab: Vocabulary, spark: SparkSession) -> DataFrame:
    return vocab.table(spark).select("term_idx", "term")
