"""The stored collection: exact search against brute force, additions, deletions, and what a search reads and skips."""

import numpy as np
import pytest

from quillspark.operators import inverted_index, vectorize
from quillspark.operators.collection import Collection
from quillspark.operators.inverted_index import InvertedIndex
from quillspark.session import scratch_path

SPEC = vectorize.VectorizerSpec(1, 2, 1, 1.0, 400, sublinear=True)
CHUNK = "chunk_id string, source string, page int, text string"


def texts(rng, n, first=0):
    """Chunks of a few subjects with words of their own and some common ones."""
    rows = []
    for i in range(first, first + n):
        subject = rng.integers(12)
        words = [f"subject{'abcdefghijkl'[subject]}{'mnopqrst'[w]}" for w in rng.integers(0, 8, size=rng.integers(1, 12))] + [f"common{'uvwxyz'[w]}" for w in rng.integers(0, 6, size=2)]
        rows.append((f"c{i}", f"book{subject}.pdf", i, " ".join(words)))
    return rows


def brute(spark, vocab, chunks, questions, k):
    """Top-k by dense products over the weights of the vectoriser."""
    def rows(pairs):
        df = spark.createDataFrame(pairs, "row_id string, text string")
        out = {}
        for r in vectorize.sparse_rows(df, "text", vocab).collect():
            v = np.zeros(vocab.size)
            v[r["idx"]] = r["weight"]
            out[r["row_id"]] = v
        return out
    a, b = rows(chunks), rows(questions)
    found = set()
    for q, v in b.items():
        near = sorted((round(1 - float(v @ w), 9) + 0.0, c) for c, w in a.items())[:k]
        if len(v):
            found |= {(q, c, n, d) for n, (d, c) in enumerate(near, 1)}
    return found


def test_collection_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(6)
    first, later = texts(rng, 300), texts(rng, 60, 300) + [("c5", "other.pdf", 1, "not new"), ("empty", "e.pdf", 1, "")]
    asked = [("q1", "subjectam subjectan commonu"), ("q2", "nothing known here"), ("q3", "subjectbm"), ("q4", "commonv commonw commonx"), ("q5", "")]
    questions = spark.createDataFrame(asked, "q_id string, query string")
    made = Collection.make(spark, scratch_path(spark, "c"), spark.createDataFrame(first + first[:3], CHUNK), SPEC)
    made.add(spark.createDataFrame(later, CHUNK))
    opened = Collection(spark, made.path)
    vocab = opened.index.vocabulary()
    kept = [(c, t) for c, _, _, t in first + later if t != "not new"]
    assert opened.table.count() == len(kept)

    def same(rows):
        got = {(r["q_id"], r["chunk_id"], r["rank"], r["distance"]) for r in opened.search(questions, 5).collect()}
        assert got == brute(spark, vocab, rows, [(q, t) for q, t in asked], 5)

    same(kept)
    monkeypatch.setattr(inverted_index, "SEED_BLOCKS", 1)
    gone = {r[1] for r in brute(spark, vocab, kept, asked, 5)} | {"c7"}
    opened.delete(spark.createDataFrame([(g,) for g in [*gone, "unknown"]], "id string"))
    same([r for r in kept if r[0] not in gone])
    shown = {r["q_id"]: r for r in opened.answer(questions, 2).collect()}
    assert shown["q3"]["n_hits"] == 2 and "From book1.pdf, page" in shown["q3"]["answer"] and shown["q2"]["best_score"] == 0


def test_search_skips_blocks_and_reads_few_terms(spark):
    rng = np.random.default_rng(7)
    rows = [(f"d{i:05d}", " ".join(f"{'abcdefghijklmnopqrst'[i % 20] * 3}{'uvwxyz'[w]}" for w in rng.integers(0, 6, size=6))) for i in range(6000)]
    chunks = spark.createDataFrame(rows, "id string, text string")
    vocab = vectorize.fit(chunks, "text", SPEC)
    index = InvertedIndex(spark, scratch_path(spark, "i"))
    index.add(vectorize.sparse_rows(chunks, "text", vocab, "id"), "id", size=100)
    asked = [(f"q{c}", f"{c * 3}u {c * 3}v") for c in "abcdefgh"]
    questions = spark.createDataFrame(asked, "row_id string, text string")
    weights = vectorize.sparse_rows(questions, "text", vocab).withColumnRenamed("row_id", "q_id")
    counter = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    got = {(r["q_id"], r["item_id"], r["rank"], r["distance"]) for r in index.search(weights, 3, seed_blocks=1, round_size=3, counter=counter).collect()}
    assert got == brute(spark, vocab, rows, asked, 3)
    bounded, scored = (c.value for c in counter)
    blocks = index.rows().filter("term_idx = -1").count()
    assert 0 < scored < 0.1 * len(asked) * blocks and scored < 0.5 * bounded
    terms = weights.head()["idx"]
    plan = index.read_terms(terms)._jdf.queryExecution().toString()
    assert "PartitionFilters: [terms" in plan and "PushedFilters: [In(term_idx" in plan
    read = index.read_terms(terms).filter("term_idx >= 0").agg({"term_idx": "count"}).head()[0]
    assert read < 0.1 * index.rows().count()


def test_blocks_are_read_once_for_many_rounds(spark, monkeypatch):
    rows = [(f"d{i}", " ".join(f"{w}{w}{w}" for w in ("abcdefgh"[i % 8], "abcdefgh"[i // 8 % 8], "zzz"[i % 3]))) for i in range(200)] + [("none", "")]
    chunks = spark.createDataFrame(rows, "id string, text string")
    vocab = vectorize.fit(chunks, "text", SPEC)
    index = InvertedIndex(spark, scratch_path(spark, "i"))
    index.add(vectorize.sparse_rows(chunks, "text", vocab, "id"), "id", size=30)
    asked = [(f"q{i}", f"{c * 3} {'abcdefgh'[i // 2] * 3}") for i, c in enumerate("abcdefgh")]
    weights = vectorize.sparse_rows(spark.createDataFrame(asked, "row_id string, text string"), "text", vocab).withColumnRenamed("row_id", "q_id")
    reads, real = [], inverted_index._scored
    monkeypatch.setattr(inverted_index, "_scored", lambda *a, **b: (reads.append(1), real(*a, **b))[1])
    for seeds, most in ((1000, 1), (1, 2)):  # with few blocks once, else once more for the bounds
        reads.clear()
        got = {(r["q_id"], r["item_id"], r["rank"], r["distance"]) for r in index.search(weights, 3, seed_blocks=seeds, round_size=1).collect()}
        assert got == brute(spark, vocab, rows, asked, 3) and len(reads) == most


def test_vectoriser_matches_counting(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(["aa", "bb", "cc", "éé", "x"], size=n))) for i, n in enumerate([0, 1, 2, 3, 9, 40])] + [(9, None)]
    df = spark.createDataFrame(rows, "row_id int, text string")
    vocab = vectorize.fit(df, "text", vectorize.VectorizerSpec(2, 3, 2, 1.0, 30, kind="count"))
    tf, seen = {}, {}
    for i, t in rows:
        words = [w for w in (t or "").split() if len(w) > 1]
        for n in (2, 3):
            for j in range(len(words) - n + 1):
                g = " ".join(words[j:j + n])
                tf[g] = tf.get(g, 0) + 1
                seen.setdefault(g, {}).setdefault(i, 0)
                seen[g][i] += 1
    want = sorted(sorted((g for g in tf if len(seen[g]) >= 2), key=lambda g: (-tf[g], g.encode()))[:30], key=str.encode)
    assert vocab.terms == want and vocab.n_docs == 7 and {r[0]: r[2:] for r in vocab.rows} == {g: (tf[g], len(seen[g])) for g in want}
    got = {r["row_id"]: dict(zip(r["idx"], r["weight"])) for r in vectorize.sparse_rows(df, "text", vocab).collect()}
    assert got == {i: {n: seen[g][i] for n, g in enumerate(want) if i in seen[g]} for i, _ in rows}
    with pytest.raises(ValueError):
        vectorize.VectorizerSpec(max_features=0)
