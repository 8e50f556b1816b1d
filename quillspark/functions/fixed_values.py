"""Values that results depend on, stated once.

Regular expressions here avoid look-around so that Java and RE2 read them alike.
"""

# fixed values: white space as Python's ``\s`` understands it
WIDE_SPACE = r"\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACE = r"\s\x0b\x1c-\x1f" + WIDE_SPACE
WS = f"[{SPACE}]"
NOT_WS = f"[^{SPACE}]"

# fixed values: page clean-up, in order of use
PAGE_NUMBER_LINE = rf"\n{WS}*\p{{Nd}}+{WS}*\n"
PAGE_OF = r"Page \p{Nd}+ of \p{Nd}+"
CHAPTER_MARK = r"Chapter \p{Nd}+"
MIN_PAGE_WORDS = 4
ENOUGH_WORDS = r"(?s)^[^ ]+ [^ ]+ [^ ]+ [^ ].*$"

# fixed values: book clean-up, in order of use
BOOK_URL = rf"https?://{NOT_WS}+|www\.{NOT_WS}+"
BOOK_EMAIL = rf"{NOT_WS}+@{NOT_WS}+"
BOOK_DROPPED_CHARS = rf"[^a-zA-Z0-9{SPACE}.,!?:;\-()]"
BOOK_NUMBER = r"\b[0-9]+\b"

# fixed values: review clean-up, in order of use
REVIEW_TAG = r"<[^>]+>"
REVIEW_URL = rf"http{NOT_WS}+|www[^\n]{NOT_WS}+"
REVIEW_DROPPED_CHARS = rf"[^a-z{SPACE}]"

# fixed values: tokens
BOOK_TOKEN = r"[a-z0-9]+(?:-[a-z0-9]+)*|\.{3}|[.,!?:;()\-]"
FEATURE_TOKEN = r"[\p{L}\p{N}_]{2,}"
SENTENCE_END = rf"[.!?]+(?:{WS}+|$)"
MIN_TOKEN_LENGTH = 3
MAX_TOKEN_LENGTH = 20
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his himself
she she's her hers herself it it's its itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did doing a an the and but if or because as
until while of at by for with about against between into through during before after above below to from up down in out
on off over under again further then once here there when where why how all any both each few more most other some such
no nor not only own same so than too very s t can will just don don't should should've now d ll m o re ve y ain aren
aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't
mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()
EXTRA_STOP_WORDS = ["fig", "figure", "table", "et", "al", "etc", "ie", "eg", "chapter", "section"]

# fixed values: markup of stored web pages
SCRIPT_OR_STYLE = r"(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>"
MARKUP_TAG = r"<[^>]+>"
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]

# fixed values: strings a CSV reader treats as missing
CSV_MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

# fixed values: sizes and seeds
CHUNK_WORDS = 1000
CHUNK_OVERLAP = 100
TOP_K = 5
N_COMPONENTS = 100
REVIEW_COMPONENTS = 50
SEED = 42
SNIPPET_CHARS = 300

# fixed values: answer and prompt texts
ANSWER_HEAD = "Based on the provided books, here's information related to your query '{query}':\n\n"
REFUSAL = "No, this question cannot be answered using these books"
PROMPT = (
    "The collection holds books on data science and on business reporting.\n"
    "Question: {query}\n"
    "If the books can answer it, reply with a refined question that finds the right passages by cosine similarity.\n"
    'If "{query}" is not about them, reply "' + REFUSAL + '". Do not use the * character.'
)
