"""Spelling variants: words one edit apart, found by a relational trie frontier, and the form that a rare variant most likely stands for.

Words are counted in the tasks that read the texts. The counted vocabulary becomes a trie, kept as a distributed table of edges. A frontier of states
(word, position, node, edits) is joined with it level by level: a state without edits takes one edit at its node (replace, insert, delete), a state with an
edit has to match the word's next character. States that end at the end of a word are neighbours.

Two words one edit apart agree before or after the edit on at least half their length. So there are two tries, of words and of reversed words, each entered
at the middle of the word, below the crowded nodes; an edge carries what follows it (next characters, and at which depths words end), so that a step that
cannot be followed by another is not taken. A state also carries the word that it would arrive at; neighbours are looked up in the vocabulary by that
word, and so do not rest on hashes of nodes. States left after ``LEVELS`` levels are looked up the same way at once.

Nodes have at most as many edges as the alphabet has characters. Edges and states are shuffled by node in ordinary joins, which Spark splits when one node
has many states. Spark takes the size of a table made by these functions from the few words it was made of, so joins are marked not to broadcast by it; only
states that were counted are. Words longer than ``LONG`` enter the frontier only at nodes that branch, found with narrow rows.

Edge cases: a null text has no words, a null id reads as an empty one. Repeated rows count each. Ties go to the smaller word in code-point order. Texts
are read whole, whatever their length. An empty table, or one without frequent words, gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import fits
from .shared import dealt, forget, kept, small_batches, stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})
HELD = 300_000
OUT = 50_000
LEVELS = 16
LONG = 64
DEPTHS = 62
SMALL = 100_000
PRIME, STEP = (1 << 61) - 1, 1_000_003


def runs_of(text: str) -> Counter:
    """The runs of a text, lower-cased in A-Z, with their counts."""
    found = Counter(RUN.findall(text) if len(text) < 1 << 20 else (m.group() for m in RUN.finditer(text)))
    low = Counter()
    for run, n in found.items():
        low[run.lower() if run.isascii() else run.translate(LOWER)] += n
    return low


def count_words(docs: DataFrame, damage: int | None = None) -> DataFrame:
    """``word, n``: all words of the texts. With ``damage``, a run whose CRC-32 together with its document's id is divisible by it loses a character.

    A task holds at most ``HELD`` words before it gives them on.
    """

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def given() -> Iterator[pa.RecordBatch]:
            words, n = list(held), list(held.values())
            for i in range(0, len(words), OUT):
                yield pa.RecordBatch.from_arrays([pa.array(words[i:i + OUT], pa.string()), pa.array(n[i:i + OUT], pa.int64())], names=["word", "n"])
            held.clear()

        for batch in small_batches(batches, "text"):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if text is None:
                    continue
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in runs_of(text).items():
                    if damage and (h := zlib.crc32(word.encode(), start)) % damage == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                    held[word] += n
                if len(held) > HELD:
                    yield from given()
        yield from given()

    return docs.select("doc_id", "text").mapInArrow(counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def path_hashes(word: str, back: bool) -> list[int]:
    """A number for each prefix of a word, the empty one included."""
    h, found = 2 if back else 1, []
    for c in word:
        found.append(h)
        h = (h * STEP + ord(c) + 7) % PRIME
    return [*found, h]


def _rows(made: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in made:
        held.append(row)
        if len(held) == OUT:
            yield batch()
            held.clear()
    if held:
        yield batch()


def _both_ways(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bool, list[int]]]:
    for batch in batches:
        for word in batch.column("word").to_pylist():
            for text, back in ((word, False), (word[::-1], True)):
                yield text, back, path_hashes(text, back)


def trie_edges(words: DataFrame) -> DataFrame:
    """``node, c, child, outs, depths`` of both tries, below the middle of the words.

    ``outs`` are the characters that can follow the edge, bit ``d`` of ``depths`` says that a word ends ``d`` characters below it. A node at which a word ends
    has an edge to itself without a character.
    """
    schema = pa.schema([("node", pa.int64()), ("c", pa.string()), ("child", pa.int64()), ("out", pa.string()), ("left", pa.int32())])

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            for text, _, path in _both_ways(batches):
                size = len(text)
                for i in range((size - 1) // 2, size):
                    yield path[i], text[i], path[i + 1], text[i + 1:i + 2], min(size - i - 1, DEPTHS)
                yield path[size], "", path[size], "", 0

        return _rows(made(), schema)

    flat = words.select("word").mapInArrow(edges, "node long, c string, child long, out string, left int")
    return flat.groupBy("node", "c", "child").agg(F.array_join(F.sort_array(F.collect_set("out")), "").alias("outs"),
                                                  F.bit_or(F.expr("shiftleft(1L, left)")).alias("depths"))


def entries(words: DataFrame, edges: DataFrame) -> DataFrame:
    """``word, back, i, node``: the states without edits, from the middle of each word on. ``word`` is reversed where ``back``."""
    schema = pa.schema([("word", pa.string()), ("back", pa.bool_()), ("i", pa.int32()), ("node", pa.int64())])

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _rows(((text, back, i, path[i]) for text, back, path in _both_ways(batches) for i in range(len(text) // 2, len(text) + 1)), schema)

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _rows(((path[-1], back, i, path[i]) for text, back, path in _both_ways(batches) for i in range(len(text) // 2, len(text) + 1)),
                     schema.set(0, pa.field("word", pa.int64())))

    def oriented(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _rows(((path[-1], text) for text, _, path in _both_ways(batches)), pa.schema([("id", pa.int64()), ("text", pa.string())]))

    kind = "word string, back boolean, i int, node long"
    short = words.filter(F.length("word") <= LONG).select("word").mapInArrow(states, kind)
    long = words.filter(F.length("word") > LONG).select("word")
    branching = edges.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("node")
    met = long.mapInArrow(narrow, kind.replace("string", "long")).join(dealt(branching), "node", "left_semi")
    texts = long.mapInArrow(oriented, "id long, text string")
    return short.unionAll(met.join(dealt(texts), F.col("word") == F.col("id")).select(F.col("text").alias("word"), "back", "i", "node"))


def _char(at: Column) -> Column:
    return F.substring(F.col("word"), at + 1, F.lit(1))


def _can(to: Column) -> Column:
    """Whether an edge leaves a chance to a state that stands before the word's place ``to`` after it."""
    left = F.length("word") - to
    ends = F.col("depths").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.least(left, F.lit(DEPTHS)))) != 0
    return ends & ((left == 0) | F.contains(F.col("outs"), _char(to)))


def first_edits(states: DataFrame, edges: DataFrame) -> DataFrame:
    """``word, back, made, i, node``: states with one edit. ``made`` is the word they are on the way to.

    An inserted character differs from the next one of the word, and of equal neighbours the last is deleted: other places of these edits make the same word.
    """
    i, size, c = F.col("i"), F.length("word"), F.col("c")
    other = (c != "") & ((i == size) | (c != _char(i)))
    last = (i < size) & ((i + 1 == size) | (_char(i) != _char(i + 1)))
    replaced = (i < size) & other & _can(i + 1)
    inserted = other & _can(i)
    deleted = last & F.when(i + 1 == size, c == "").otherwise((c != "") & (c == _char(i + 1)) & _can(i + 2))
    before, rest = F.substring(F.col("word"), F.lit(1), i), (lambda at: F.substring(F.col("word"), at + 1, size))
    option = lambda made, to: F.struct(made.alias("made"), to.cast("int").alias("i"))
    options = F.array_compact(F.array(
        F.when(replaced, option(F.concat(before, c, rest(i + 1)), i + 1)), F.when(inserted, option(F.concat(before, c, rest(i)), i)),
        F.when(deleted, option(F.concat(before, rest(i + 1)), F.least(i + 2, size)))))
    met = states.join(dealt(edges), "node").filter(replaced | inserted | deleted)
    return met.select("word", "back", F.explode(options).alias("o"), F.col("child").alias("node")).select("word", "back", "o.made", "o.i", "node")


def next_level(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states that match the word's next character."""
    met = (F.broadcast(states) if fits(states, SMALL) else dealt(states)).join(edges, "node").filter((F.col("c") == _char(F.col("i"))) & _can(F.col("i") + 1))
    return met.select("word", "back", "made", (F.col("i") + 1).alias("i"), F.col("child").alias("node"))


def neighbours(words: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``word, near, n`` for all words that differ by one edit, in both directions; ``n`` is the count of ``near``."""
    spark = words.sparkSession
    edges = stored(trie_edges(words), "trie")
    ended, over = [], F.col("i") == F.length("word")
    states, path = kept(first_edits(entries(words, edges), edges), "frontier")
    for _ in range(levels):
        if states.filter(~over).isEmpty():
            break
        ended.append(stored(states.filter(over).select("word", "back", "made"), "ended"))
        new, new_path = kept(next_level(states.filter(~over), edges), "frontier")
        forget(spark, path)
        states, path = new, new_path
    ended.append(states.select("word", "back", "made"))
    found = ended[0]
    for more in ended[1:]:
        found = found.unionAll(more)
    turned = lambda c: F.when(F.col("back"), F.reverse(c)).otherwise(F.col(c))
    pairs = found.select(turned("word").alias("word"), turned("made").alias("near")).distinct()
    return pairs.join(dealt(words.select(F.col("word").alias("near"), "n")), "near").select("word", "near", "n")


def roots_of(links: DataFrame) -> DataFrame:
    """``word, root``: the last word when following ``word -> form``, by doubling the distance in each round. Forms must not lead back."""
    spark = links.sparkSession
    roots, path = kept(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        hop = roots.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        moved = roots.join(dealt(hop), F.col("root") == F.col("_word"), "left")
        new, new_path = kept(moved.select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")), "roots")
        forget(spark, path)
        roots, path = new, new_path
        if roots.filter("moved").isEmpty():
            return roots.select("word", "root")


def group_variants(docs: DataFrame, least_length: int = 6, least_count: int = 5, ratio: int = 5, damage: int | None = None, levels: int = LEVELS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word with at least ``least_length`` characters and ``least_count`` occurrences.

    ``form`` is the most frequent neighbour if it is at least ``ratio`` times as frequent as the word, ``root`` the end of the chain of forms.
    """
    words = stored(count_words(docs, damage).filter((F.length("word") >= least_length) & (F.col("n") >= least_count)), "words")
    best = neighbours(words, levels).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    forms = words.join(dealt(best), "word", "left")
    strong = -F.col("best.less") >= ratio * F.col("n")
    forms = stored(forms.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(strong, F.col("best.form")).alias("form"),
                                F.when(strong, -F.col("best.less")).alias("form_n")), "forms")
    roots = roots_of(forms.filter("form IS NOT NULL"))
    return forms.join(dealt(roots), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
