"""A stored inverted index over weighted terms, and exact top-k by it.

Texts are put into blocks by their heaviest term. A block's texts have places, and a posting row holds what one term has in one block: the places, the
weights, and the largest weight. Rows are partitioned by ranges of terms, so a search reads the rows of the terms that are asked for and no others. A task
gets whole blocks, one after the other; the largest weights bound what a block can score for a question, and a block is scored only for questions that it
can still change. Many questions are answered in rounds of bounded size; the blocks are read and shuffled once for each ``PASS`` rounds, which look at a
block one after another.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import asdict

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .nearest import DIGITS
from .vectorize import Vocabulary, VectorizerSpec

BLOCK = 1024
RANGE = 64
ROUND = 4096
PASS = 16
SEED_BLOCKS = 256
USUAL = 160
SLACK = 2 * 10.0 ** -DIGITS
IDS, GONE = -1, -2
POSTINGS = "block long, term_idx int, top double, places array<int>, weights array<double>, ids array<string>"


def blocks_of(sparse: DataFrame, key: str, first: int = 0, size: int = BLOCK) -> DataFrame:
    """Add ``block``: texts with the same heaviest term together, small groups side by side, large ones split by hash. Null for texts without terms."""
    heaviest = F.element_at("idx", F.array_position("weight", F.array_max("weight")).cast("int"))
    tagged = sparse.withColumn("_lead", F.when(F.size("idx") > 0, heaviest))
    counts = tagged.filter("_lead IS NOT NULL").groupBy("_lead").agg(F.count(F.lit(1)).alias("n")).orderBy("_lead").collect()  # a row per term at most
    rows, block, held = [], first, 0
    for r in counts:
        if held and held + r["n"] > size:
            block, held = block + 1, 0
        parts = -(-r["n"] // size)
        rows.append((r["_lead"], block, parts))
        block, held = (block + parts, 0) if parts > 1 else (block, held + r["n"])
    places = sparse.sparkSession.createDataFrame(rows, "_lead int, _first long, _parts int")
    met = tagged.join(F.broadcast(places), "_lead", "left")
    return met.withColumn("block", F.col("_first") + F.pmod(F.xxhash64(key), F.col("_parts"))).drop("_lead", "_first", "_parts")


def postings(blocked: DataFrame, key: str) -> DataFrame:
    """The posting rows of rows with ``block``, ``idx`` and ``weight``; a row with term ``IDS`` lists the block's keys by place."""
    schema = pa.schema([("block", pa.int64()), ("term_idx", pa.int32()), ("top", pa.float64()), ("places", pa.list_(pa.int32())),
                        ("weights", pa.list_(pa.float64())), ("ids", pa.list_(pa.string()))])

    def invert(table: pa.Table) -> pa.Table:
        ids = table.column("id").combine_chunks()
        idx, weight = table.column("idx").combine_chunks(), table.column("weight").combine_chunks()
        sizes = np.asarray(idx.value_lengths())
        term, value = idx.flatten().to_numpy(), weight.flatten().to_numpy()
        place = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
        order = np.lexsort((place, term))
        term, value, place = term[order], value[order], place[order]
        terms, first = np.unique(term, return_index=True)
        ends = np.append(first, len(term)).astype(np.int32)
        n, block = len(terms), table.column("block")[0].as_py()
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v)) for v in (place, value)]
        made = [pa.array([block] * n, pa.int64()), pa.array(terms, pa.int32()), pa.array(np.maximum.reduceat(value, first)), *lists, pa.nulls(n, schema[5].type)]
        names = pa.table([[block], [IDS], [0.0], [[]], [[]], [ids.to_pylist()]], schema=schema)
        return pa.concat_tables([pa.Table.from_arrays(made, schema=schema), names])

    rows = blocked.filter("block IS NOT NULL").select("block", F.col(key).cast("string").alias("id"), "idx", "weight")
    return rows.groupBy("block").applyInArrow(invert, POSTINGS)


class Round:
    """Questions of one round: their weights by term, and the best texts so far. Questions are short, so products go over the terms they have,
    and as a matrix only over the few terms that many questions share with many texts."""

    def __init__(self, lists: list[list[int]], weights: list[list[float]], k: int, floor: np.ndarray | None = None):
        self.k, self.n = k, len(lists)
        terms = np.concatenate([np.zeros(0, dtype=np.int64), *[np.array(t, dtype=np.int64) for t in lists]])
        values = np.concatenate([np.zeros(0), *[np.array(w, dtype=np.float64) for w in weights]])
        self.terms, col = np.unique(terms, return_inverse=True)
        order = np.argsort(col, kind="stable")
        self.q_col, self.q_row, self.q_value = col[order], np.repeat(np.arange(self.n), [len(t) for t in lists])[order], values[order]
        self.ends = np.searchsorted(self.q_col, np.arange(len(self.terms) + 1))
        self.floor = np.zeros(self.n) if floor is None else floor.copy()
        self.row, self.score, self.id = np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0, dtype=object)
        self.bounded = self.scored = 0

    def column(self, terms: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.terms, terms)

    def bound(self, terms: np.ndarray, tops: np.ndarray) -> np.ndarray:
        """The most that a text with these largest weights can score for each question."""
        most = np.zeros(len(self.terms))
        most[self.column(terms)] = tops
        return np.bincount(self.q_row, weights=self.q_value * most[self.q_col], minlength=self.n)

    def add(self, terms: np.ndarray, tops: np.ndarray, lists: list[tuple[np.ndarray, np.ndarray]], ids: list[str], gone: np.ndarray) -> None:
        """Score a block for the questions that it can change."""
        columns = self.column(terms)
        bound = self.bound(terms, tops)
        active = np.nonzero((bound > 0) & (bound >= self.floor - SLACK))[0]
        self.bounded += self.n
        self.scored += len(active)
        if not len(active):
            return
        place = np.full(self.n, -1)
        place[active] = np.arange(len(active))
        work = (self.ends[columns + 1] - self.ends[columns]) * np.array([len(p) for p, _ in lists])
        usual = np.argsort(work, kind="stable")[-USUAL:]
        q, block, rare = np.zeros((len(active), len(usual))), np.zeros((len(usual), len(ids))), np.ones(len(columns), dtype=bool)
        rare[usual] = False

        def of(column: int) -> tuple[np.ndarray, np.ndarray]:
            at = slice(self.ends[column], self.ends[column + 1])
            rows, values = place[self.q_row[at]], self.q_value[at]
            return rows[rows >= 0], values[rows >= 0]

        for i, j in enumerate(usual):
            rows, values = of(columns[j])
            q[rows, i] = values
            block[i, lists[j][0]] = lists[j][1]
        score = q @ block
        for j in np.flatnonzero(rare):
            rows, values = of(columns[j])
            if len(rows):
                places, weights = lists[j]
                score[rows[:, None], places] += values[:, None] * weights
        score[:, gone] = 0.0
        least = self.floor[active]
        new = least <= 0
        if score.shape[1] > self.k and new.any():
            least[new] = np.partition(score[new], -self.k, axis=1)[:, -self.k]
        least -= SLACK
        r, c = np.nonzero((score >= least[:, None]) & (np.round(1.0 - score, DIGITS) < 1.0))
        if not len(r):
            return
        row, value, names = (np.concatenate(x) for x in ((self.row, active[r]), (self.score, score[r, c]), (self.id, np.array(ids, dtype=object)[c])))
        order = np.lexsort((names, np.round(1.0 - value, DIGITS), row))
        row, value, names = row[order], value[order], names[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        kept = place < self.k
        self.row, self.score, self.id = row[kept], value[kept], names[kept]
        full = place[kept] == self.k - 1
        self.floor[self.row[full]] = np.maximum(self.floor[self.row[full]], self.score[full])


class Rounds:
    """The rounds of a pass, over the same blocks. A question is known by its place in the pass."""

    def __init__(self, lists: list[list[int]], weights: list[list[float]], k: int, floor: np.ndarray | None = None, size: int = ROUND):
        at = [slice(i, i + size) for i in range(0, len(lists), size)]
        self.size, self.parts = size, [Round(lists[x], weights[x], k, None if floor is None else floor[x]) for x in at]

    def bound(self, terms: np.ndarray, tops: np.ndarray) -> np.ndarray:
        made = [np.zeros(0)]
        for r in self.parts:
            known = np.isin(terms, r.terms)
            made.append(r.bound(terms[known], tops[known]))
        return np.concatenate(made)

    def add(self, terms: np.ndarray, tops: np.ndarray, lists: list[tuple[np.ndarray, np.ndarray]], ids: list[str], gone: np.ndarray) -> None:
        for r in self.parts:
            known = np.flatnonzero(np.isin(terms, r.terms))
            r.add(terms[known], tops[known], [lists[j] for j in known], ids, gone)

    def best(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Places, texts and scores of the best, round by round."""
        for i, r in enumerate(self.parts):
            yield r.row + i * self.size, r.id, r.score


def _scored(rows: DataFrame, lists: list, weights: list, ids: list, k: int, floor: np.ndarray | None, q_type: str, counter=None,
            size: int = ROUND) -> DataFrame:
    """``q_id, item_id, distance``: the best ``k`` texts of the given posting rows for each question, by task."""
    shared = rows.sparkSession.sparkContext.broadcast((lists, weights, ids, floor))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, weights, q_ids, floor = shared.value
        asked = Rounds(lists, weights, k, floor, size)
        block, held, names, gone = None, [], [], []

        def close() -> None:
            if held:
                asked.add(np.array([h[0] for h in held]), np.array([h[1] for h in held]), [h[2] for h in held], names, np.array(gone, dtype=np.int64))

        for batch in batches:
            places, values = batch.column("places"), batch.column("weights")
            for i, (b, term, top) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("block", "term_idx", "top")))):
                if b != block:
                    close()
                    block, held, names, gone = b, [], [], []
                if term == GONE:
                    gone += places[i].as_py()
                elif term == IDS:
                    names = batch.column("ids")[i].as_py()
                else:
                    held.append((term, top, (places[i].values.to_numpy(), values[i].values.to_numpy())))
        close()
        if counter is not None:
            for total, n in zip(counter, (sum(r.bounded for r in asked.parts), sum(r.scored for r in asked.parts))):
                total.add(n)
        for row, texts, found in asked.best():
            made = [[q_ids[r] for r in row], texts.tolist(), (np.round(1.0 - found, DIGITS) + 0.0).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(made[0], pa.int64() if q_type == "bigint" else pa.string()), pa.array(made[1], pa.string()), pa.array(made[2], pa.float64())],
                                             names=["q_id", "item_id", "distance"])

    ordered = rows.repartition("block").sortWithinPartitions("block", "term_idx")
    return ordered.mapInArrow(score, f"q_id {q_type}, item_id string, distance double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(W.partitionBy("q_id").orderBy("distance", "item_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k)


class InvertedIndex:
    """Posting rows and vocabulary in a folder. Adding appends blocks; deleting appends rows with term ``GONE``. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _at(self, name: str) -> str:
        return os.path.join(self.path, name)

    def rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(POSTINGS + ", terms int").parquet(self._at("postings"))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], POSTINGS + ", terms int")

    def _append(self, rows: DataFrame) -> None:
        tagged = rows.withColumn("terms", F.floor(F.col("term_idx") / RANGE).cast("int"))
        tagged.repartition("terms", "block").sortWithinPartitions("terms", "term_idx", "block").write.mode("append").partitionBy("terms").parquet(self._at("postings"))

    def save_vocabulary(self, vocab: Vocabulary) -> None:
        about = json.dumps({"spec": asdict(vocab.spec), "n_docs": vocab.n_docs})
        self.spark.createDataFrame([(about,)], "about string").write.parquet(self._at("about"))
        vocab.table(self.spark).drop("idf").write.parquet(self._at("vocabulary"))

    def vocabulary(self) -> Vocabulary:
        about = json.loads(self.spark.read.parquet(self._at("about")).head()[0])
        rows = self.spark.read.parquet(self._at("vocabulary")).select("term", "term_idx", "tf", "df").orderBy("term_idx").collect()  # at most max_features
        return Vocabulary(VectorizerSpec(**about["spec"]), about["n_docs"], tuple(tuple(r) for r in rows))

    def add(self, sparse: DataFrame, key: str, size: int = BLOCK) -> None:
        """Index rows with ``key``, ``idx`` and ``weight`` (non-negative). Keys must be new."""
        last = self.rows().filter(F.col("term_idx") == IDS).agg(F.max("block")).head()[0]
        self._append(postings(blocks_of(sparse, key, 0 if last is None else last + 1, size), key))

    def delete(self, ids: DataFrame) -> None:
        """Take the texts with the given ``id`` out of all later results."""
        listed = self.rows().filter((F.col("terms") == IDS) & (F.col("term_idx") == IDS)).select("block", F.posexplode("ids").alias("place", "id"))
        gone = listed.join(ids.select(F.col("id").cast("string").alias("id")).distinct(), "id", "left_semi").groupBy("block").agg(F.collect_list("place").alias("places"))
        self._append(gone.select("block", F.lit(GONE).alias("term_idx"), F.lit(0.0).alias("top"), "places",
                                 F.array().cast("array<double>").alias("weights"), F.lit(None).cast("array<string>").alias("ids")))

    def read_terms(self, terms: list[int]) -> DataFrame:
        """The posting rows of these terms, and the keys of the blocks. Other terms' files and row groups are not read."""
        wanted = [IDS, GONE, *terms]
        return self.rows().filter(F.col("terms").isin(sorted({t // RANGE for t in wanted})) & F.col("term_idx").isin(wanted)).drop("terms")

    def search(self, asked: DataFrame, k: int, seed_blocks: int = SEED_BLOCKS, round_size: int = ROUND, counter=None) -> DataFrame:
        """``q_id, item_id, distance, rank`` for questions ``q_id, idx, weight``: the ``k`` texts with the largest sum of products, of those with any.

        In an index of ``seed_blocks`` blocks or more, each question's most promising block is scored first, so that all tasks start with a bound.
        ``counter``, two accumulators, counts the pairs of question and block that were looked at and that were scored.
        """
        q_type = asked.schema["q_id"].dataType.simpleString()
        asked = asked.filter(F.size("idx") > 0).select("q_id", "idx", "weight").persist()
        passes = max(1, -(-asked.count() // (round_size * PASS)))
        found = None
        for i in range(passes):
            part = asked.filter(F.pmod(F.xxhash64(F.lit(9), "q_id"), F.lit(passes)) == i).toArrow()
            lists, weights, ids = (part.column(c).to_pylist() for c in ("idx", "weight", "q_id"))
            rows = self.read_terms(sorted({t for one in lists for t in one}))
            floor = self._floors(rows, lists, weights, k, seed_blocks, round_size)
            made = _scored(rows, lists, weights, ids, k, floor, q_type, counter, round_size)
            found = made if found is None else found.unionAll(made)
        return _ranked(found, k)

    def _floors(self, rows: DataFrame, lists: list, weights: list, k: int, seed_blocks: int, size: int = ROUND) -> np.ndarray | None:
        """For each question a score that its ``k`` best texts reach, from one block each."""
        if not lists or rows.filter(F.col("term_idx") == IDS).count() < seed_blocks:
            return None
        tops = rows.filter(F.col("term_idx") >= 0).select("block", "term_idx", "top")
        q = self.spark.sparkContext.broadcast((lists, weights))

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked, bounds = Rounds(*q.value, 1, size=size), {}
            for batch in batches:
                block, term, top = (batch.column(c).to_numpy() for c in ("block", "term_idx", "top"))
                for b in np.unique(block):
                    at = block == b
                    bounds[b] = bounds.get(b, 0) + asked.bound(term[at], top[at])
            if bounds:
                names, table = np.array(list(bounds)), np.stack(list(bounds.values()))
                most = table.argmax(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(most))), pa.array(table.max(axis=0)), pa.array(names[most])], names=["q", "bound", "block"])

        spread = tops.repartition("block").mapInArrow(best, "q long, bound double, block long")
        chosen = spread.groupBy("q").agg(F.max_by("block", "bound").alias("block")).select("block").distinct()  # a row per question of the pass at most
        first = _scored(rows.join(F.broadcast(chosen), "block", "left_semi"), lists, weights, list(range(len(lists))), k, None, "bigint", size=size)
        floor = np.zeros(len(lists))
        for r in _ranked(first, k).filter(F.col("rank") == k).select("q_id", "distance").collect():
            floor[r["q_id"]] = 1.0 - r["distance"]
        return floor
