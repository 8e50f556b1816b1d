"""Replacing personal data by keyed surrogates of the same kind and format.

Texts are searched for e-mail addresses, telephone numbers, card and account numbers, IPv4 addresses, secrets and names. An entity is a kind and a
canonical form (lower case, digits only), so all its mentions get the same surrogate, written in the mention's own format. Digits become digits, letters
become letters of the same script, case and sort (vowel or consonant), given names become given names of the same gender and script, cards keep their
check digit, addresses stay valid. All choices come from a keyed hash of the entity.

The distinct entities of all documents get their surrogates in rounds: a surrogate that is a real entity, or that two entities want, is refused, one of
the two keeps it, and the others try again with the next number; late rounds lengthen the form, so that the rounds end.

Edge cases: null and empty texts stay as they are, like all texts without entities. Repeated rows stay repeated and get the same text. Rows with null ids
are treated like others. All columns of the input are kept; ``text`` is replaced and ``n_entities`` is added.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import as_table, small_batches, stored

KEY = b"documented default key; set your own"
LATE = 12
# Words before names, with the gender they tell, and given names by gender and script.
TITLES = {"m": "Mr Mr. Sir Herr Monsieur M. Señor Sr Sr. Don Господин".split(), "f": "Mrs Mrs. Ms Ms. Miss Madam Frau Madame Mme Mme. Mademoiselle Señora"
          " Sra Sra. Señorita Doña Госпожа".split(), "u": "Dr Dr. Prof Prof. Professor".split()}
GIVEN = {
    ("m", "LATIN"): "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony Steven Paul Andrew Kevin Brian George Edward"
                    " Hans Jürgen Klaus Stefan Wolfgang Pierre Jacques François Luc Carlos José Miguel Javier Pablo".split(),
    ("f", "LATIN"): "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Margaret Sandra Ashley Emily Michelle Laura Rebecca Helen Amy"
                    " Ursula Monika Sabine Heike Ingrid Marie Claire Sophie Camille Carmen Lucía Pilar Rosario Isabel".split(),
    ("m", "CYRILLIC"): "Иван Пётр Сергей Алексей Дмитрий Николай Андрей Михаил Павел Владимир".split(),
    ("f", "CYRILLIC"): "Анна Мария Елена Ольга Татьяна Наталья Ирина Светлана Екатерина Людмила".split(),
    ("m", "GREEK"): "Γιώργος Δημήτρης Κώστας Γιάννης Νίκος Παναγιώτης".split(),
    ("f", "GREEK"): "Μαρία Ελένη Κατερίνα Βασιλική Σοφία Αγγελική".split(),
}
LETTERS = {"LATIN": ("aeiou", "bcdfghklmnprstvz"), "CYRILLIC": ("аеиоу", "бвгдзклмнпрст"), "GREEK": ("αειου", "βγδζκλμνπρστ")}
RESERVED = {"example.com", "example.org", "example.net"}

TITLE_OF = {t: g for g, ts in TITLES.items() for t in ts}
GIVEN_OF = {n: k for k, ns in GIVEN.items() for n in ns}
NAME_WORDS = frozenset(TITLE_OF) | frozenset(GIVEN_OF)
EMAIL = re.compile(r"(?<![\w.+-])[A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}", re.A)
IPV4 = re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\d]|\.\d)", re.A)
PHONE = re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?!\w)", re.A)
NUMBER = re.compile(r"(?<![\w.])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{3}-\d{2}-\d{4})(?![\w])", re.A)
SECRET = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64}|AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|sk-[0-9A-Za-z]{20,48})(?![0-9A-Za-z])")
NAME = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")


def detected(text: str) -> list[tuple[int, int, str, str]]:
    """Start, end, kind and canonical form of the entities of a text; earlier patterns win where two overlap."""
    found: list[tuple[int, int, str, str]] = []
    if "@" in text:
        found += [(m.start(), m.end(), "email", m[0].lower()) for m in EMAIL.finditer(text)]
    if re.search("[0-9]", text):
        for kind, pattern in (("secret", SECRET), ("ipv4", IPV4), ("phone", PHONE), ("number", NUMBER)):
            for m in pattern.finditer(text):
                form = m[0].lower() if kind == "secret" else m[0] if kind == "ipv4" else re.sub(r"\D", "", m[0])
                if kind == "phone" and len(form) == 11 and form[0] == "1":
                    form = form[1:]  # the same number with and without its country code
                found.append((m.start(), m.end(), kind, form))
    if not NAME_WORDS.isdisjoint(text.split()):
        found += names(text)
    kept, end = [], -1
    order = {k: i for i, k in enumerate(("email", "secret", "ipv4", "phone", "number"))}
    for x in sorted(found, key=lambda x: (x[0], order.get(x[2], 9), -x[1])):
        if x[0] >= end:
            kept.append(x)
            end = x[1]
    return kept


def names(text: str) -> Iterator[tuple[int, int, str, str]]:
    """Given names followed by a capitalised word, and one or two capitalised words after a title; each word is an entity of its own."""
    tokens = [(m.start(), m[0]) for m in re.finditer(r"\S+", text)]
    taken = -1
    for i, (_, token) in enumerate(tokens):
        if i <= taken:
            continue
        gender = TITLE_OF.get(token)
        if gender is None and token not in GIVEN_OF:
            continue
        words = []
        for j in range(i + (gender is not None), min(len(tokens), i + (3 if gender is not None else 2))):
            m = NAME.match(tokens[j][1])
            if not m or not m[0][0].isupper() or (len(m[0]) > 1 and m[0].isupper()):
                break
            words.append((j, tokens[j][0], m[0]))
            if m[0] != tokens[j][1]:
                break
        if not words or gender is None and len(words) < 2:
            continue
        for k, (j, start, word) in enumerate(words):
            known = GIVEN_OF.get(word)
            kind = f"given-{known[0]}-{known[1]}" if known and k == 0 else f"given-{gender or 'u'}" if k == 0 and len(words) > 1 else "surname"
            yield start, start + len(word), kind, word.lower()
            taken = j


def choices(key: bytes, kind: str, form: str, attempt: int) -> Iterator[int]:
    """An endless keyed stream of bytes for an entity."""
    block = 0
    while True:
        yield from hmac.new(key, f"{kind}\0{form}\0{attempt}\0{block}".encode(), hashlib.sha256).digest()
        block += 1


def other_letter(c: str, pick: int) -> str:
    """A letter of the same script, case and sort."""
    base = unicodedata.normalize("NFD", c.lower())[0]
    for vowels, consonants in LETTERS.values():
        for group in (vowels, consonants):
            if base in group or base in "yjqwx" and group == LETTERS["LATIN"][1]:
                made = group[pick % len(group)]
                return made.upper() if c.isupper() else made
    first = ord(c) & ~0x3F
    block = [chr(x) for x in range(first, first + 64) if chr(x).isalpha() and chr(x).isupper() == c.isupper()]
    return block[pick % len(block)] if block else c


def luhn(digits: str) -> int:
    """Check sum of a card number, 0 if it is valid."""
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10


def surrogate(kind: str, form: str, attempt: int, key: bytes) -> str:
    """The canonical form that an entity gets in a round."""
    stream = choices(key, kind, form, attempt)
    longer = max(0, attempt - LATE)
    if kind.startswith("given-") and kind.count("-") == 2:
        pool = sorted(GIVEN[tuple(kind.split("-")[1:])], key=lambda n: hmac.new(key, n.encode(), hashlib.sha256).digest())
        at = [n.lower() for n in pool].index(form)
        return pool[(at + 1) % len(pool)].lower()
    if kind in ("surname",) or kind.startswith("given-"):
        return "".join(other_letter(c, next(stream)) if c.isalpha() else c for c in form) + "".join("aeiou"[next(stream) % 5] for _ in range(longer))
    if kind == "ipv4":
        parts = []
        for i, part in enumerate(form.split(".")):
            low, high = ((1 if i == 0 else 0), 9) if len(part) == 1 else (10, 99) if len(part) == 2 else (100, 223 if i == 0 else 254)
            parts.append(str(low + (next(stream) * 256 + next(stream)) % (high - low + 1)))
        return ".".join(parts) if not longer else ".".join(str(1 + (next(stream) * 256 + next(stream)) % 223) for _ in range(4))
    if kind == "phone":
        keep = len(form) - 10 if len(form) > 10 else 0
        return form[:keep] + str(2 + next(stream) % 8) + "".join(str(next(stream) % 10) for _ in form[keep + 1:]) + "".join(str(next(stream) % 10) for _ in range(longer))
    if kind == "number":
        body = form[0] + "".join(str(next(stream) % 10) for _ in form[1:-1]) + "".join(str(next(stream) % 10) for _ in range(longer))
        if len(form) >= 13 and luhn(form) == 0:
            return body + next(d for d in "0123456789" if luhn(body + d) == 0)
        return body + next(d for d in (str((next(stream) + k) % 10) for k in range(40)) if len(form) < 13 or luhn(body + d) != 0)
    if kind == "secret":
        head = next((p for p in ("akia", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-") if form.startswith(p)), "")
        signs = "0123456789abcdef" if not head else "abcdefghijklmnopqrstuvwxyz0123456789"
        return head + "".join(signs[next(stream) % len(signs)] for _ in form[len(head):]) + "".join(signs[next(stream) % 16] for _ in range(longer))
    local, _, host = form.partition("@")
    made = "".join(str(next(stream) % 10) if c.isdigit() else other_letter(c, next(stream)) if c.isalpha() else c for c in local)
    return made + "".join("aeiou"[next(stream) % 5] for _ in range(longer)) + "@" + hidden_host(host, key)


def hidden_host(host: str, key: bytes) -> str:
    """The same for all addresses of a host: reserved and top names stay, the others change letter by letter."""
    labels = host.split(".")
    fixed = 2 if ".".join(labels[-2:]) in RESERVED else 1
    stream = choices(key, "host", host, 0)
    return ".".join(["".join(str(next(stream) % 10) if c.isdigit() else other_letter(c, next(stream)) if c.isalpha() else c for c in x)
                     for x in labels[:-fixed]] + labels[-fixed:])


def worded(original: str, made: str, kind: str) -> str:
    """A canonical surrogate in the format of a mention: its separators, its capitals."""
    if kind in ("phone", "number"):
        own = re.sub(r"\D", "", original)
        digits = iter(own[:max(0, len(own) - len(made))] + made)
        out = "".join(next(digits, "") if c.isdigit() else c for c in original)
        return out + "".join(digits)
    if kind == "ipv4":
        return made
    if original.isupper():
        return made.upper()
    if original[:1].isupper() and original[1:] == original[1:].lower():
        return made[:1].upper() + made[1:]
    return "".join(m.upper() if o.isupper() else m for o, m in zip(original, made)) + made[len(original):]


HIT = "start int, end int, kind string, form string"


def found_entities(texts: DataFrame) -> DataFrame:
    """``mark, text, hits`` for the texts with entities (column ``text``), once per text and task."""
    hit = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("form", pa.string())])
    schema = pa.schema([("mark", pa.string()), ("text", pa.string()), ("hits", pa.list_(hit))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            out = {"mark": [], "text": [], "hits": []}
            for mark, text in zip(batch.column("mark").to_pylist(), batch.column("text").to_pylist()):
                if hits := detected(text):
                    out["mark"].append(mark)
                    out["text"].append(text)
                    out["hits"].append([dict(zip(("start", "end", "kind", "form"), h)) for h in hits])
            if out["mark"]:
                yield as_table(out, schema)

    return texts.mapInArrow(rows, f"mark string, text string, hits array<struct<{HIT.replace(' string', ':string').replace(' int', ':int')}>>")


def may_have_entities(text: Column) -> Column:
    """False only for texts in which nothing is ever detected."""
    words = F.split(text, r"[\s\x1c-\x1f\x85   -     　]+")
    return F.coalesce(text.rlike("[0-9@]") | F.arrays_overlap(words, F.array(*[F.lit(w) for w in sorted(NAME_WORDS)])), F.lit(False))


def assigned(entities: DataFrame, key: bytes = KEY) -> DataFrame:
    """``kind, form, made`` for distinct entities (``kind``, ``form``): no two of a kind get the same, none gets a real one's form."""
    schema = pa.schema([("kind", pa.string()), ("form", pa.string()), ("made", pa.string())])

    def tried(df: DataFrame, attempt: int) -> DataFrame:
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kinds, forms = batch.column("kind").to_pylist(), batch.column("form").to_pylist()
                yield as_table({"kind": kinds, "form": forms, "made": [surrogate(k, f, attempt, key) for k, f in zip(kinds, forms)]}, schema)
        return df.select("kind", "form").mapInArrow(rows, "kind string, form string, made string")

    taken, pending, attempt = None, entities, 0
    real = entities.filter(F.size(F.split("kind", "-")) < 3).select("kind", F.col("form").alias("made"))
    while True:
        offered = stored(tried(pending, attempt), "offered")
        free = offered.join(real, ["kind", "made"], "left_anti")
        if taken is not None:
            free = free.join(taken.select("kind", "made"), ["kind", "made"], "left_anti")
        won = free.groupBy("kind", "made").agg(F.min("form").alias("form")).select("kind", "form", "made")
        taken = stored(won if taken is None else taken.unionAll(won), "surrogates")
        pending = stored(pending.join(taken.select("kind", "form"), ["kind", "form"], "left_anti"), "pending")
        attempt += 1
        if pending.isEmpty():
            return taken


def replaced(found: DataFrame, made: DataFrame) -> DataFrame:
    """``mark, new_text, n_entities`` for texts with hits."""
    schema = pa.schema([("mark", pa.string()), ("new_text", pa.string()), ("n_entities", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            texts, counts = [], []
            for text, spots in zip(batch.column("text").to_pylist(), batch.column("spots").to_pylist()):
                out, at = [], 0
                for x in sorted(spots, key=lambda x: x["start"]):
                    out += [text[at:x["start"]], worded(text[x["start"]:x["end"]], x["made"], x["kind"])]
                    at = x["end"]
                texts.append("".join([*out, text[at:]]))
                counts.append(len(spots))
            yield as_table({"mark": batch.column("mark"), "new_text": texts, "n_entities": counts}, schema)

    hits = found.select("mark", F.explode("hits").alias("h")).select("mark", "h.start", "h.end", "h.kind", "h.form")
    spots = hits.join(made, ["kind", "form"]).groupBy("mark").agg(F.collect_list(F.struct("start", "end", "kind", "made")).alias("spots"))
    return found.select("mark", "text").join(spots, "mark").mapInArrow(rows, "mark string, new_text string, n_entities long")


def with_surrogates(docs: DataFrame, text_column: str = "text", key: bytes = KEY) -> DataFrame:
    """All rows and columns of ``docs``, with surrogates in the text, and ``n_entities``. Texts that cannot hold an entity are not moved."""
    columns = [F.col(c) for c in docs.columns if c != "n_entities"]
    text = F.col(text_column).cast("string")
    some = docs.filter(may_have_entities(text))
    found = stored(found_entities(some.select(F.md5(text.cast("binary")).alias("mark"), text.alias("text"))).dropDuplicates(["mark"]), "found")
    entities = stored(found.select(F.explode("hits").alias("h")).select("h.kind", "h.form").distinct(), "entities")
    changed = stored(replaced(found, assigned(entities, key)), "replaced").select(
        F.col("mark").alias("_mark"), F.col("new_text").alias("_text"), F.col("n_entities").alias("_n"))
    new = [F.coalesce("_text", c).alias(text_column) if n == text_column else c for n, c in zip([c for c in docs.columns if c != "n_entities"], columns)]
    met = some.join(changed, F.md5(text.cast("binary")) == F.col("_mark"), "left").select(*new, F.coalesce("_n", F.lit(0)).cast("long").alias("n_entities"))
    return docs.filter(~may_have_entities(text)).select(*columns, F.lit(0).cast("long").alias("n_entities")).unionAll(met)
