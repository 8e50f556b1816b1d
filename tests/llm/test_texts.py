"""Operators on texts and pages, against brute force and round trips."""

import base64
import hashlib
import random
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from quillspark.llm import html_text, langid, mixing, packing, queries, repeated_spans, shingle_join, suffix_array, surrogates, warc

FOLDER = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, size long, piece int"


def documents(spark, texts, **columns):
    rows = [(i, t, columns.get("lang", [None] * len(texts))[i], columns.get("source", ["s"] * len(texts))[i], 7, 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC)


def test_packing_edges(spark):
    from tokenizers import Tokenizer

    texts = [None, "", " ", "a  b \n c", "word " * 3000, "x" * 4000, "it's <|endoftext|> é中😀", "same", "same"]
    docs = documents(spark, texts)
    docs = docs.unionAll(docs.limit(2)).unionAll(spark.createDataFrame([(None, "no id", None, None, 1, 1)], DOC))
    got = packing.pack(docs, queries.tokenizer_path(), open_bins=3).toPandas()
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    for i, text in enumerate(texts):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        mine = got[got.doc_id == i].drop_duplicates("piece").sort_values("piece")
        assert mine.length.sum() == len(ids) and (mine.length.iloc[1:] == 1024).all()
        for r in mine.itertuples():
            assert zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32
    assert got.doc_id.isna().sum() == 1 and len(got[got.doc_id == 0]) == 2
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]] and s.length.sum() <= 1024
    assert packing.pack(docs.limit(0), queries.tokenizer_path()).count() == 0


def test_packing_is_tight(spark):
    rng = random.Random(5)
    rows = [(i, 0, 0, rng.randint(1, 1024), 0) for i in range(4000)]
    got = packing.best_fit(spark.createDataFrame(rows, packing.PIECES)).toPandas()
    assert got.sequence_id.nunique() <= 1.01 * sum(r[3] for r in rows) / 1024 + 1


def test_packing_keeps_ids(spark):
    got = packing.pack(documents(spark, ["one two three"]), queries.tokenizer_path(), keep_ids=True).collect()
    assert zlib.crc32(np.array(got[0].ids, dtype="<u4").tobytes()) == got[0].ids_crc32


def test_archives(spark):
    trap = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"
    rows = [(1, "http://a/ b\n", trap), (2, "http://b", trap), (3, None, None), (4, "", ""), (5, "u", "é" * 30000), (None, "n", trap), (7, "r", "r"), (7, "r", "r")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, kind string")
    found = warc.round_trip(pages)
    assert {"response", "request", "metadata"} <= set(found.columns)
    assert all(r.request and r.metadata for r in found.collect())
    got = sorted(map(tuple, warc.digest_rows(found).collect()), key=str)
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    want = [(1, trap, "revisit", 2), (2, trap, "response", None), (3, None, "revisit", 4), (4, "", "response", None), (5, "é" * 30000, "response", None),
            (None, trap, "revisit", 2), (7, "r", "response", None), (7, "r", "response", None)]
    assert got == sorted(((i, len((t or "").encode()), digest(t), k, to) for i, t, k, to in want), key=str)
    assert warc.digest_rows(warc.round_trip(pages.limit(0))).count() == 0


def test_page_text(spark):
    page = """<html><head><title>t</title><style>p{}</style></head><body><header>Site</header><nav><ul><li><a href=x>A</a></ul></nav>
    <div class="cookie-notice">We use cookies.</div><main><h1>Head &amp; line</h1><p>First  para,<b>bold</b> text.<p>Second &lt;para&gt;.<ul><li>item one.</li></ul>
    <form><input>Search</form><aside>Side</aside></main><section id="comments"><p>Nice, I like it!</p></section><footer>foot</footer><script>var a="<p>x</p>";</script></body></html>"""
    assert html_text.main_text(page) == "Head & line First para,bold text. Second <para>. item one."
    bare = "<div id=menu><a href=1>One</a></div><div><p>Only this text, here.</p><p>And that.</p></div><!-- <p>no</p> -->"
    assert html_text.main_text(bare) == "Only this text, here. And that."
    assert html_text.main_text("plain < text &amp more") == "plain < text & more"
    assert [html_text.main_text(x) for x in (None, "", " ", "<p>", "<!--x")] == [""] * 5
    rows = [(1, "u", page, "x"), (1, "u", page, "x"), (None, None, None, None), (3, "v", "<p>" + "long word " * 50000 + "</p>", "x")]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(got) == 4 and all(r.n_chars == len(r.text) for r in got) and max(r.n_chars for r in got) == 499_999


def test_surrogates(spark):
    texts = ["Mr. John Smith met Mary Jones. Mary Jones wrote to JO.99@Mail.Example.com and jo.99@mail.example.com, call +1 (511) 555-6887 or 511-555-6887.",
             "ip 10.0.0.1, 4111 1111 1111 1111; 4111111111111111 token = \"cf1d64a9a4cd9723e1f4eafc27395915e6868ffa\" 123-45-6789 Frau Müller, Herr Hans Müller",
             None, "", "Clean Text of 12 words in 2024, v1.2.3.4.5.", "x " * 40000 + "a.b@c.de"]
    rows = [(i, t, 5) for i, t in enumerate(texts + texts[:1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_entities long")
    got = {r.doc_id: r for r in surrogates.with_surrogates(docs).collect()}
    assert len(got) == 7 and got[2].text is None and got[3].text == "" and got[4].text == texts[4] and got[4].n_entities == 0
    a, b = got[0].text, got[1].text
    assert got[6].text == a and got[0].n_entities == 10
    for secret in ("Smith", "Jones", "99@", "555-6887", "10.0.0.1", "4111", "cf1d64", "123-45", "Müller", "a.b@c"):
        assert all(secret not in (r.text or "") for r in got.values())
    words = a.split()
    mails = [w.strip(",") for w in words if "@" in w]
    assert mails[0].lower() == mails[1] and mails[0][:2].isupper() and mails[1].endswith("@" + mails[0].split("@")[1].lower())
    first = a.index("met ") + 4
    assert a[first:].split(". ")[0] == a[first:].split(". ")[1][:len(a[first:].split(". ")[0])]
    digits = lambda s: "".join(c for c in s if c.isdigit())
    phones = a.split("call ")[1].split(" or ")
    assert digits(phones[0])[1:] == digits(phones[1]) and phones[0].startswith("+1 (")
    card = digits(b.split(", ")[1].split(";")[0])
    assert surrogates.luhn(card) == 0 and card in b.replace(" ", "") and b.count(" ".join(card[i:i + 4] for i in (0, 4, 8, 12))) == 1
    given = b.split("Herr ")[1].split()[0]
    assert surrogates.GIVEN_OF[given] == ("m", "LATIN")
    assert surrogates.with_surrogates(docs.limit(0)).count() == 0


def test_surrogates_are_distinct(spark):
    rows = [("ipv4", f"{a}.{b}.1.1") for a in range(1, 10) for b in range(10)]  # nearly the whole of a small format
    got = surrogates.assigned(spark.createDataFrame(rows, "kind string, form string")).collect()
    assert len({r.made for r in got}) == len(rows) == len(got) and not {r.made for r in got} & {f for _, f in rows}


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(1)
    for _ in range(150):
        sigma = int(rng.integers(1, 5))
        s = rng.integers(0, sigma, int(rng.integers(1, 60))).astype(np.uint8)
        raw, order = s.tobytes(), suffix_array.suffix_array(s, sigma)
        assert order.tolist() == sorted(range(len(s)), key=lambda i: raw[i:])
        shared = suffix_array.common_prefixes(s, order)
        for a, b in zip(order, order[1:]):
            n = next((k for k in range(len(s)) if a + k >= len(s) or b + k >= len(s) or s[a + k] != s[b + k]), len(s))
            assert shared[b] == n


def repeats(texts, window):
    seen = Counter(t[i:i + window] for t in texts for i in range(len(t) - window + 1))
    for t in texts:
        gone = np.zeros(len(t) + 1, dtype=bool)
        for i in range(len(t) - window + 1):
            if seen[t[i:i + window]] > 1:
                gone[i:i + window] = True
        gone = gone[:len(t)]
        kept = bytes(np.frombuffer(t, np.uint8)[~gone]) if t else b""
        yield len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("crowded", [256, 8])
def test_repeated_spans(spark, monkeypatch, crowded):
    monkeypatch.setattr(repeated_spans, "CROWDED", crowded)
    rng = random.Random(4)
    text = lambda n: " ".join("".join(rng.choice("abcdéfg") for _ in range(rng.randint(1, 8))) for _ in range(n))
    shared, long = [text(60) for _ in range(6)], text(300)
    texts = [None, "", "x", *[text(rng.randint(1, 200)) for _ in range(40)],
             *[text(30) + rng.choice(shared)[rng.randint(0, 30):] + text(20) for _ in range(200)], shared[0] + " " + text(10) + " " + shared[0], "ab" * 400, "a" * 1000]
    for _ in range(20):
        words = long.split()
        words[rng.randint(0, 299)] = text(1)
        texts.append(" ".join(words))
    texts += [long] * 5 + ["short copy"] * 3
    got = {r.doc_id: tuple(r)[1:] for r in repeated_spans.remove_repeats(documents(spark, texts).repartition(3)).collect()}
    assert [got[i] for i in range(len(texts))] == list(repeats([(t or "").encode() for t in texts], 200))
    assert repeated_spans.remove_repeats(documents(spark, [])).count() == 0


def test_mixture(spark):
    rng = random.Random(2)
    sources = [rng.choice(["a", "b", "é", None, "tiny"]) if i % 3 else "a" for i in range(400)]
    sources[:3] = ["tiny"] * 3
    texts = [None if i == 7 else "" if i == 8 else "w x " * rng.randint(1, 80) if sources[i] != "tiny" else "one two" for i in range(400)]
    docs = documents(spark, texts, source=sources)
    got = sorted(mixing.mix(docs).collect(), key=lambda r: r.doc_id)
    assert got == sorted(mixing.mix(docs.repartition(5)).collect(), key=lambda r: r.doc_id)
    sizes = Counter()
    for r, t, s in zip(got, texts, sources):
        assert r["size"] == len((t or "").split(" ")) - (not t or t.endswith(" ")) and 0 <= r.taken <= 3 * r["size"]
        sizes[s] += r["size"]
    names = sorted([s for s in sizes if s is not None]) + [None]
    weight, total, capped = {s: i % 3 + 1 for i, s in enumerate(names)}, sum(sizes.values()), {}
    while True:
        rate = (total - sum(capped.values())) / sum(weight[s] for s in names if s not in capped)
        over = [s for s in names if s not in capped and weight[s] * rate > 3 * sizes[s]]
        if not over:
            break
        capped |= {s: 3 * sizes[s] for s in over}
    for s in names:
        mine = [r for r, x in zip(got, sources) if x == s]
        target = capped.get(s, weight[s] * rate)
        assert all(abs(r.target - target) < 1e-6 and r.source_size == sizes[s] for r in mine)
        assert abs(sum(r.taken for r in mine) - target) <= 2
    assert mixing.mix(docs.limit(0)).count() == 0
    assert {r.taken for r in mixing.mix(documents(spark, [None, ""])).collect()} == {0}


def test_highest_quotients():
    for seed in range(30):
        rng = random.Random(seed)
        values, seats = [rng.randint(0, 90) for _ in range(9)], rng.randint(0, 400)
        most = [3 * v for v in values]
        given = [0] * 9
        for _ in range(seats):
            open_ = [i for i in range(9) if values[i] and given[i] < most[i]]
            if open_:
                given[min(open_, key=lambda i: (-values[i] / (2 * given[i] + 1), i))] += 1
        assert mixing.highest_quotients(values, most, seats) == given


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def components(n, links):
    root = list(range(n))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


@pytest.mark.parametrize(("common", "block", "seekers", "listed"), [(0.005, 512, 64, 64), (0.3, 4, 64, 64), (0.3, 4, 1, 64), (1.1, 2, 0, 1), (0.005, 4, 0, 3)])
def test_jaccard_components(spark, monkeypatch, common, block, seekers, listed):
    monkeypatch.setattr(shingle_join, "LISTED", listed)
    monkeypatch.setattr("quillspark.llm.components.FEW", 1 << 19 if listed == 64 else -1)
    monkeypatch.setattr(shingle_join, "COMMON", common)
    monkeypatch.setattr(shingle_join, "SEEKERS", seekers)
    monkeypatch.setattr(shingle_join, "BLOCK", block)
    rng = random.Random(9)
    vocabulary = ["w%d" % i for i in range(400)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, texts = text(50), [None, "", " \n", "one", "ONE", "a b c d", "A b c d e", "É x y z w", "é x y z w"]
    for _ in range(25):
        base = text(rng.choice([6, 12, 30, 60, 150, 400]))
        for _ in range(rng.randint(1, 9)):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                at = rng.randrange(len(words))
                words[at:at + 1] = rng.choice([[], text(1), text(2)])
            texts.append(" ".join(words))
    texts += [" ".join(passage + text(110)) for _ in range(60)] + [" ".join(passage + text(9)) for _ in range(30)]
    sets = [shingles(t) for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in shingle_join.jaccard_components(documents(spark, texts).repartition(3)).collect()}
    assert got == {i: (len(s), c) for i, (s, c) in enumerate(zip(sets, components(len(sets), links)))}


def test_linked_sets_share_an_early_shingle():
    rng, linked = random.Random(4), 0
    for _ in range(20_000):
        base = rng.sample(range(120), rng.randint(1, 60))
        x, y = (sorted({v for v in base if rng.random() > 0.08} | set(rng.sample(range(120), rng.randint(0, 4)))) for _ in range(2))
        if x and y and 100 * len({*x} & {*y}) >= 80 * len({*x} | {*y}):
            linked += 1
            near = [a[:shingle_join.prefix(len(a), len(b), 80)] for a, b in ((x, y), (y, x))]
            assert {*near[0]} & {*near[1]} and len(near[0]) <= shingle_join.prefix(len(x), -(-80 * len(x) // 100), 80)
    assert linked > 1_000


def test_starts_of_long_sets_are_listed_without_copies_of_the_set(spark, monkeypatch):
    """A set is not repeated for each of its entries, which for sets of 20,000 shingles takes 0.6 GB each."""
    sizes = [20_000, 1, 30, 15_000]
    sets = [np.sort(shingle_join.mixed(np.arange(1 + 100_000 * i, 1 + 100_000 * i + n, dtype=np.uint64))) for i, n in enumerate(sizes)]
    batch = pa.RecordBatch.from_pydict({"node": [0, 1, 2, 3], "root": [0, 1, 0, 1], "seeks": [False, False, False, True], "shingles": [x.tobytes() for x in sets]})
    monkeypatch.setattr(shingle_join, "tallies", lambda _: np.zeros(shingle_join.TALLY, np.int64))
    rows = shingle_join.prefix_entries(SimpleNamespace(sparkSession=spark, mapInArrow=lambda made, _: made), 80)
    usual = pa.default_memory_pool()
    pool = pa.proxy_memory_pool(usual)
    pa.set_memory_pool(pool)
    try:
        found = [r for b in rows(iter([batch])) for r in b.to_pylist()]
    finally:
        pa.set_memory_pool(usual)
    assert pool.max_memory() < 16 << 20
    for i, x in enumerate(sets):
        own = [r for r in found if r["node"] == i]
        length = shingle_join.prefix(len(x), -(-80 * len(x) // 100), 80)
        assert [r["at"] for r in own] == list(range(length)) and {(r["root"], r["seeks"], r["n"]) for r in own} == {(i % 2, i == 3, len(x))}
        assert len({r["shingle"] for r in own}) == length and {r["shingle"] for r in own} <= set(x.view(np.int64).tolist())


def test_parities_let_every_linked_pair_through(spark):
    rng, rows = random.Random(6), []
    for _ in range(2_000):
        base = rng.sample(range(1, 1 << 40), rng.randint(1, 200))
        x, y = (np.unique(shingle_join.mixed(np.array([v for v in base if rng.random() > 0.06] + rng.sample(range(1, 1 << 40), rng.randint(1, 9)), np.uint64)))
                for _ in range(2))
        both = len(np.intersect1d(x, y))
        rows.append((100 * both >= 80 * (len(x) + len(y) - both), len(x), len(y), *shingle_join.parities(x).tolist(), *shingle_join.parities(y).tolist()))
    named = ["linked", "n_a", "n_b", *[f"{p}_{e}" for e in "ab" for p in shingle_join.PARITIES]]
    told = spark.createDataFrame(rows, named).select("linked", shingle_join.may_link(80).alias("may")).collect()
    assert sum(r.linked for r in told) > 100 and all(r.may for r in told if r.linked)


@pytest.mark.parametrize("ids", [1 << 20, 0])
def test_only_pairs_that_can_link_are_compared(spark, monkeypatch, ids):
    """Texts that have a word run in common are candidates of each other by a signature and nothing else."""
    rng, compared = random.Random(12), []
    text = lambda n: [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(999)) for _ in range(n)]
    texts = []
    for _ in range(30):
        passage = text(6)
        texts += [" ".join(text(8) + passage + text(8)) for _ in range(20)]
    texts += [f"{t} more" for t in texts[:5]]
    whole = shingle_join.compared_pairs

    def watched(texts, pairs, *rest):
        compared.append(pairs.count())
        return whole(texts, pairs, *rest)

    monkeypatch.setattr(shingle_join, "compared_pairs", watched)
    monkeypatch.setattr(shingle_join, "IDS", ids)
    got = {r.doc_id: r.component_id for r in shingle_join.jaccard_components(documents(spark, texts)).collect()}
    assert got == {i: i if i < 600 else i - 600 for i in range(605)}
    assert compared and max(compared) <= 50


def test_jaccard_edges(spark):
    docs = documents(spark, ["a b c d e f", None]).unionAll(spark.createDataFrame([(None, "a b c d e f", None, None, 1, 1)] * 2 + [(0, "a b c d e f", None, None, 1, 1)], DOC))
    got = sorted(map(tuple, shingle_join.jaccard_components(docs).collect()), key=str)
    assert got == sorted([(0, 2, 0), (0, 2, 0), (1, 0, 1), (None, 2, 0), (None, 2, 0)], key=str)
    assert shingle_join.jaccard_components(docs.limit(0)).count() == 0


def test_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    models = langid.learn(docs)
    got = langid.predict(docs, models).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 200 and (held.lang == held.lang_pred).mean() > 0.99 and not got.rejected.any() and got.score.between(0, 1).all()
    odd = documents(spark, [None, "", "12 34!", "the " * 30000, "xqzkv jjwq zzxq kkqw pqzx vvkq zzqx jjkw qqzx xvkq", "İ"])
    rows = langid.predict(odd.unionAll(odd.limit(1)), models).orderBy("doc_id").collect()
    assert [r.lang_pred for r in rows[:4]] == ["und"] * 4 and all(r.rejected and r.score == 0 for r in rows[:4])
    assert rows[4].lang_pred == "en" and not rows[4].rejected and rows[5].rejected and rows[5].lang_pred != "und"
    none = langid.identify(documents(spark, ["text", None]))
    assert [r.lang_pred for r in none.collect()] == ["und", "und"]
    assert langid.identify(odd.limit(0)).count() == 0


def test_languages_count_every_gram(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = docs.unionAll(docs.limit(9)).select("doc_id", "text", "lang")
    small, large = langid.learn(docs), langid.learn(docs, max_grams=10)
    assert (small.langs, small.floor) == (large.langs, large.floor) and len(small.langs) == 4
    for k in range(1, langid.ORDER + 1):
        for a, b in ((small.grams[k], large.grams[k]), (small.contexts[k], large.contexts[k])):
            np.testing.assert_array_equal(a.keys, b.keys)
            np.testing.assert_array_equal(a.start, b.start)
            np.testing.assert_allclose(a.values, b.values, rtol=1e-5, atol=1e-6)
    rows, same = (sorted(map(tuple, langid.predict(docs, m).select("doc_id", "held_out", "lang_pred", "rejected", "cross_entropy").collect()), key=str) for m in (small, large))
    assert [r[:4] for r in rows] == [r[:4] for r in same]
    np.testing.assert_allclose([r[4] for r in rows], [r[4] for r in same], rtol=1e-5)


def test_language_probabilities_sum_to_one():
    rng = np.random.default_rng(3)
    grams = np.unique(rng.integers(97, 101, (60, 3)).astype(np.uint32), axis=0)
    model = langid.Smoothed(grams, rng.integers(1, 9, len(grams)), 4)
    for context in grams[:, :2][:10]:
        every = np.array([[*context, c] for c in range(97, 101)], dtype=np.uint32)
        assert abs(model.probability(every).sum() - 1) < 1e-9


@pytest.mark.parametrize("blocks", [1 << 20, 400, 3])
def test_sources_take_their_targets_at_any_block_size(spark, blocks, monkeypatch):
    rng = random.Random(blocks)
    sizes = {"a": 9000, "b": 300, "c": 7, "d": 2500, "e": 0, "f": 4000}
    texts, source = [], []
    for name, words in sizes.items():
        while words > 0:
            n = min(words, rng.randrange(1, 90))
            texts.append("w " * n)
            source.append(name)
            words -= n
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", 2)
    rows = mixing.mix(documents(spark, texts, source=source), blocks=blocks).collect()
    assert len(rows) == len(texts) and all(0 <= r.taken <= 3 * r["size"] for r in rows)
    for name in set(source):
        own = [r for r in rows if r.source == name]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.5 + 1e-9
