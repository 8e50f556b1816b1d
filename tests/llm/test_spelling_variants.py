"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

from quillspark.llm import queries
from quillspark.llm import spelling_variants as S

FOLDER = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, word string, n int, node int, back int"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def brute(docs, damage, length=6, count=5):
    total = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: chr(ord(m.group()) + 32), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode()) & 0xFFFFFFFF
            total[run[:h % len(run)] + run[h % len(run) + 1:] if h % damage == 0 else run] += 1
    words = {w: n for w, n in total.items() if len(w) >= length and n >= count}
    by_gap = {}
    for w in words:  # words that agree after deleting a character are candidates
        for v in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            by_gap.setdefault(v, []).append(w)
    near = {w: set() for w in words}
    for group in by_gap.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda b: (-words[b], b), default=None)
        if best is not None and words[best] >= 5 * n:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items()}


def found(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_small_alphabet(spark):
    rng = random.Random(9)
    words = {"".join(rng.choice("aabbcÉé×") for _ in range(rng.randrange(4, 9))) for _ in range(1500)}
    words |= {"x" * n for n in range(5, 12)} | {("ab" * 90)[:n] for n in (6, 100, 101, 150)} | {"q" * 80 + "z" + "q" * 70, "q" * 80 + "y" + "q" * 70, "q" * 150, "q" * 80 + "zq"}
    weights = [rng.choice([1, 1, 1, 8, 60, 450]) for _ in words]
    docs = [(i, " ".join(rng.choice([w, w.upper() if w.isascii() else w]) for w in rng.choices(sorted(words), weights, k=4000))) for i in range(30)]
    docs += [(None, "xxxxxx,xxxxxx-xxxxxx0xxxxxx_xxxxxx"), (None, None), (5, ""), (5, "123 ..."), docs[3], docs[3], (7, ("Hello" * 9 + " ") * 40_000 + "hellohello " * 7)]
    table = spark.createDataFrame([(*d, "x", 1, 2, 3) for d in docs], DOC).repartition(4)
    want = brute(docs, 7)
    assert found(S.group_variants(table, damage=7)) == want
    assert found(S.group_variants(table, damage=7, levels=1)) == want
    assert len([r for r in want if r[1]]) > 20 and any(r[1] and r[1] != r[2] for r in want)
    assert found(S.group_variants(table.limit(0), damage=7)) == set()


def test_whole_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert found(queries.op11_spelling_variants(spark, FOLDER)) == brute([tuple(d) for d in docs], 199)


def test_spark_broadcasts_no_side_by_its_own_estimate(spark, monkeypatch):
    monkeypatch.setattr(S, "SMALL", -1)
    words = S.stored(spark.createDataFrame([("aab" * n, 5) for n in range(2, 40)] + [("aac" * n, 50) for n in range(2, 40)], "word string, n long"), "words")
    edges = S.stored(S.trie_edges(words), "trie")
    states = S.first_edits(S.entries(words, edges), edges)
    links = words.select("word", S.F.lit("x").alias("form"))
    for made in (states, S.next_level(states, edges), S.neighbours(words, 1), S.roots_of(links), S.group_variants(words.select(S.F.col("n").alias("doc_id"), S.F.col("word").alias("text")))):
        assert "Broadcast" not in made._jdf.queryExecution().executedPlan().toString()
