"""The fold of a log, the template's round trip, and whole conversations against a plain fold."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quillspark.llm import chat_format as C
from quillspark.llm import queries

FOLDER = "/root/testdata/sf0.001"
LOG = "conv_id long, seq long, step int, event string, message string, role string, text string, at string, stretch int"
TURNS = "conv_id long, turn long, role string, text string, message string, part int"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(turns):
    """Digest columns of a list of (role, text)."""
    learnt = "".join(t for r, t in turns if r == "assistant")
    return len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(learnt), digest(learnt)


def folded(events):
    """A plain fold of one conversation's (seq, step, event, message, role, text), in order."""
    started, text, places, gone = {}, {}, {}, set()
    for seq, step, event, message, role, piece in sorted(events, key=lambda e: (e[0], e[1])):
        piece = piece or ""
        if event == "start":
            started.setdefault(message, (role or ""))
            places.setdefault(message, (seq, step))
            text[message] = text.get(message, "") + piece
        elif event == "delta":
            text[message] = text.get(message, "") + piece
        elif event == "edit":
            text[message] = piece
        elif event == "regenerate":
            text[message] = ""
            if message in places:
                gone |= {m for m, at in places.items() if at > places[message]}
    return [(started[m], text[m]) for m in sorted(started, key=places.get) if m not in gone]


def got(spark, log, **how):
    rows = C.digests(C.read_back(C.format_log(log, **how))).collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in rows}


def test_random_logs(spark):
    rng, rows, want = random.Random(5), [], {}
    for conv in [*range(40), None]:
        events, names = [], []
        for seq in rng.sample(range(0, 40_000, 7), 60):
            events.append([seq, rng.choice([0, 1, None and 0]) or 0])
        events.sort()
        made = []
        for seq, step in events:
            kind = rng.choice(["start", "start", "delta", "delta", "delta", "edit", "regenerate", "noise"]) if names else "start"
            if kind == "start":
                names.append(f"m{len(names)}")
                made.append((seq, step, kind, names[-1], rng.choice(["user", "assistant", "tool", None, "<|user|>"]), rng.choice([None, "hello "])))
            else:
                made.append((seq, step, kind, rng.choice([*names, "never"]), None, rng.choice(["a", "</s>", "[", "INST] ", "é\\", "", None])))
        rows += [(conv, *e, "x", 1) for e in made]
        want[conv] = expected(folded([e for e in made if e[2] != "noise"]))
    rng.shuffle(rows)
    log = spark.createDataFrame(rows, LOG)
    assert got(spark, log) == want
    assert got(spark, log, part=5) == want
    assert got(spark, log.limit(0)) == {}


def test_regeneration_far_behind_discards(spark):
    step = C.STRETCH
    log = [(1, 0, 0, "start", "u", "user", "q"), (1, 1, 0, "start", "a", "assistant", "old"), (1, 5 * step, 0, "start", "u2", "user", "more"),
           (1, 9 * step, 0, "regenerate", "a", None, None), (1, 9 * step, 1, "delta", "a", None, "new"), (1, 9 * step + 1, 0, "start", "u3", "user", "last")]
    log = spark.createDataFrame([(*e, "x", 1) for e in log], LOG)
    assert got(spark, log) == {1: expected([("user", "q"), ("assistant", "new"), ("user", "last")])}


def test_escape_is_reversible(spark):
    rng = random.Random(3)
    pieces = ["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "<|user|>", "<|", "|>", "\n", "</s>\n", "a", "é", "😀", "<<SYS>>", " "]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(12))) for _ in range(3000)]
    made = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(C.escaped(F.col("t"))).collect()]
    assert [C.unescaped(m) for m in made] == texts
    assert not [m for m in made if "</s>" in m or "[INST]" in m or "<|user|>" in m]
    with pytest.raises(ValueError):
        C.Template(tail="\n\n")


def test_turn_rows(spark):
    rows = [(1, 2, "assistant", "b" * 70_000, "x", 1), (1, 1, "user", None, "x", 1), (1, 2, "assistant", "b" * 70_000, "x", 1), (1, None, "system", "", "x", 1),
            (None, 3, None, "</s>\n<|other|>", "x", 1), (2, 1, "a\nb<|text|>", "", "x", 1), (2, 1, "a", "z", "x", 1)]
    turns = spark.createDataFrame(rows, TURNS)
    long = "b" * 70_000
    assert got(spark, C.turn_events(turns)) == {
        1: expected([("system", ""), ("user", ""), ("assistant", long), ("assistant", long)]), None: expected([("", "</s>\n<|other|>")]),
        2: expected([("a", "z"), ("a\nb<|text|>", "")])}
    parts = C.format_log(C.turn_events(turns)).filter("conv_id = 1").orderBy("stretch", "part").collect()
    assert len(parts) == 3 and "".join(p["formatted"] for p in parts) == f"<|system|>\n</s>\n<|user|>\n</s>\n<|assistant|>\n{long}</s>\n<|assistant|>\n{long}</s>\n"
    assert C.digests(C.read_back(C.format_log(C.turn_events(turns.limit(0))))).count() == 0


def test_whole_conversations(spark):
    rows = spark.read.parquet(f"{FOLDER}/conversations.parquet").orderBy("conv_id", "turn").collect()
    hard = "</s>[INST] ok [/INST]"
    turns = {-7: [("user", hard), ("assistant", hard)]}
    for r in rows:
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    found = {r["conv_id"]: r for r in queries.op13_chat_format(spark, FOLDER).collect()}
    assert {c: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for c, r in found.items()} == {c: expected(t) for c, t in turns.items()}
    assert all(r["formatted_chars"] > sum(len(t) for _, t in turns[c]) for c, r in found.items())
