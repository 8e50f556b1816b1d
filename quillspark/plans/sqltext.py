"""SQL building blocks for the comparison queries: named common table expressions and text expressions."""

from __future__ import annotations

from ..functions import fixed_values as V
from ..functions.text import stop_words


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def swap(expr: str, *steps: tuple[str, str]) -> str:
    for pattern, to in steps:
        target = "chr(10)" if to == "\n" else lit(to)
        expr = f"regexp_replace({expr}, {lit(pattern)}, {target}, 'g')"
    return expr


def collapse(expr: str) -> str:
    return f"trim({swap(expr, (V.WS + '+', ' '))})"


def clean_page(expr: str) -> str:
    flat = collapse(swap(expr, (V.PAGE_NUMBER_LINE, "\n"), (V.PAGE_OF, ""), (V.CHAPTER_MARK, "")))
    return f"(SELECT CASE WHEN len(string_split(f, ' ')) >= {V.MIN_PAGE_WORDS} THEN f ELSE '' END FROM (SELECT {flat} AS f))"


def clean_book(expr: str) -> str:
    kept = swap(expr, (V.BOOK_URL, ""), (V.BOOK_EMAIL, ""), (V.BOOK_DROPPED_CHARS, ""))
    return swap(collapse(f"lower({kept})"), (V.BOOK_NUMBER, ""))


def clean_review(expr: str) -> str:
    return collapse(swap(f"lower({expr})", (V.REVIEW_TAG, " "), (V.REVIEW_URL, " "), (V.REVIEW_DROPPED_CHARS, " ")))


def strip_markup(expr: str) -> str:
    bare = swap(expr, (V.SCRIPT_OR_STYLE, " "), (V.MARKUP_TAG, " "))
    for entity, char in V.ENTITIES:
        bare = f"replace({bare}, {lit(entity)}, {lit(char)})"
    return collapse(bare)


def words(expr: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, {lit(V.WS + '+')}), lambda w: w <> '')"


def keep(tokens: str, test: str) -> str:
    return f"list_filter({tokens}, lambda t: {test})"


def in_list(values: list[str]) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


def r6(expr: str) -> str:
    return f"(round(CAST({expr} AS DOUBLE), 6) + 0.0)"


def ngrams(tokens: str, low: int, high: int) -> str:
    """All runs of ``low`` to ``high`` tokens of a list column, as one list."""
    runs = [tokens if n == 1 else
            f"list_transform(range(1, len({tokens}) - {n - 2}), lambda i: array_to_string({tokens}[i:i+{n - 1}], ' '))"
            for n in range(low, high + 1)]
    return " || ".join(runs)


BOOK_STOP = in_list(stop_words(extra=True))
REVIEW_STOP = in_list(stop_words(extra=False))

# name -> (names it reads, text)
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "page_docs": ((), "SELECT doc_id AS row_id, source, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS INT)"
                      " AS page, lang, text FROM documents"),
    "marked": ((), "SELECT doc_id AS row_id, source, concat('Chapter ', doc_id, ' Intro', chr(10), ' ', doc_id, ' ', chr(10),"
                   " text, ' Page 3 of 12 see https://example.com/a?b=1 or www.example.org', chr(160),"
                   " 'mail me@example.com <b>end</b> 2024') AS text FROM documents"),
    "reviews": ((), "SELECT d.doc_id AS row_id, d.text AS reviewText, CAST(1 + 2*l.quality + 2*(1 - l.toxic) AS DOUBLE)"
                    " AS overall FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"),
    "vectors": ((), "SELECT concat('vec_', e.vec_id) AS id, e.vec_id, coalesce(d.text, '') AS document,"
                    " CAST(e.embedding AS DOUBLE[]) AS embedding, e.label, coalesce(d.source, '') AS source"
                    " FROM embeddings e LEFT JOIN documents d ON e.vec_id = d.doc_id"),
    "questions": ((), "SELECT conv_id * 1000 + turn AS q_id, text AS query FROM conversations WHERE role = 'user'"),
    "cleaned": (("page_docs",), f"SELECT row_id, source, page, lang, text, {clean_book('text')} AS clean FROM page_docs"),
    "kept_pages": (("page_docs",), "SELECT * FROM (SELECT row_id, source, page, lang, "
                                   f"{clean_page('text')} AS text FROM page_docs) WHERE text <> ''"),
    "book_words": (("cleaned",), f"SELECT row_id, unnest({words('clean')}) AS word FROM cleaned"),
    "book_tokens": (("cleaned",), f"SELECT row_id, lang, regexp_extract_all(clean, {lit(V.BOOK_TOKEN)}) AS tokens FROM cleaned"),
    "book_stopped": (("book_tokens",), f"SELECT row_id, lang, tokens, "
                                       f"{keep('tokens', f'NOT list_contains({BOOK_STOP}, t)')} AS stopped FROM book_tokens"),
    "book_sized": (("book_stopped",), "SELECT row_id, lang, tokens, stopped, "
                                      f"{keep('stopped', 'length(t) BETWEEN 3 AND 20')} AS sized FROM book_stopped"),
    "sized_long": (("book_sized",), "SELECT row_id, unnest(sized) AS token, generate_subscripts(sized, 1) AS pos FROM book_sized"),
    "repeated_long": (("sized_long",), "SELECT row_id, token, pos FROM (SELECT *, count(*) OVER (PARTITION BY row_id, token) AS n"
                                       " FROM sized_long) WHERE n >= 2"),
    "repeated": (("book_sized", "repeated_long"),
                 "SELECT b.row_id, b.lang, coalesce(r.repeated, '') AS repeated FROM book_sized b LEFT JOIN (SELECT row_id,"
                 " string_agg(token, ' ' ORDER BY pos) AS repeated FROM repeated_long GROUP BY row_id) r ON b.row_id = r.row_id"),
    "review_clean": (("reviews",), "SELECT row_id, reviewText, CAST(trunc(overall) AS INT) AS overall, "
                                   f"{clean_review('reviewText')} AS clean FROM reviews"),
    "review_tokens": (("review_clean",), "SELECT row_id, overall, "
                                         f"{keep('string_split(clean, chr(32))', f'length(t) > 1 AND NOT list_contains({REVIEW_STOP}, t)')}"
                                         " AS tokens FROM review_clean"),
    "rated": (("review_tokens",), "SELECT row_id, overall, CAST(overall >= 4 AS INT) AS sentiment, tokens,"
                                  " array_to_string(tokens, ' ') AS clean_joined, CAST(len(tokens) AS INT) AS review_len"
                                  " FROM review_tokens WHERE overall IS NOT NULL AND len(tokens) >= 3"),
}


def add_table(name: str, needs: tuple[str, ...], text: str) -> None:
    TABLES[name] = (needs, text)


def with_tables(*names_and_body: str, extra: dict[str, tuple[tuple[str, ...], str]] | None = None) -> str:
    """``WITH`` list for the named tables and all they read, followed by the body (last argument)."""
    *names, body = names_and_body
    known = {**TABLES, **(extra or {})}
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for need in known[name][0]:
            visit(need)
        ordered.append(name)

    for name in names:
        visit(name)
    parts = ",\n".join(f"{n} AS MATERIALIZED ({known[n][1]})" for n in ordered)
    return f"WITH {parts}\n{body}" if ordered else body


SMALL_SIZE, SMALL_OVERLAP = 200, 50
add_table("small_chunks", ("cleaned",), f"""
SELECT row_id, CAST((i // {SMALL_SIZE - SMALL_OVERLAP}) AS INT) AS chunk_idx, array_to_string(w[i+1:i+{SMALL_SIZE}], ' ') AS chunk
FROM (SELECT row_id, w, unnest(range(0, len(w), {SMALL_SIZE - SMALL_OVERLAP})) AS i FROM (SELECT row_id, {words('clean')} AS w FROM cleaned))""")
_STEP = V.CHUNK_WORDS - V.CHUNK_OVERLAP
add_table("chunks", ("kept_pages",), f"""
SELECT row_id, source, page, lang, text AS original_text, CAST(i // {_STEP} AS INT) AS chunk_idx,
       array_to_string(w[i+1:i+{V.CHUNK_WORDS}], ' ') AS chunk
FROM (SELECT *, unnest(range(0, len(w), {_STEP})) AS i FROM
      (SELECT *, {words(clean_book('text'))} AS w FROM kept_pages))""")
