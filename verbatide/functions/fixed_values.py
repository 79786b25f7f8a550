"""Fixed values. Results depend on every one of them, so they are stated as plain text.

Patterns use explicit Unicode classes instead of ``\\w`` and ``\\s`` because those are
ASCII-only in Java; the classes below are what a Unicode regular expression engine matches.
"""

# --- fixed values: character classes -------------------------------------------------------
SPACE = r"\t-\r\x1C-\x20\x85\p{Z}"
WORD = r"\p{L}\p{N}_"

# --- fixed values: patterns ----------------------------------------------------------------
SPACES = rf"[{SPACE}]+"
WORDS = rf"[{WORD}]+"
LONG_WORDS = rf"[{WORD}]{{2,}}"
WORDS_OR_MARKS = rf"[{WORD}]+|[^{WORD}{SPACE}]"
URL = rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+"
HTTP_RUN = rf"http[^{SPACE}]+"
TAG = r"<[^>]+>"
TAG_ON_ONE_LINE = r"<[^\n]*?>"
EMOJI = (
    r"[\x{1F600}-\x{1F64F}"
    r"\x{1F300}-\x{1F5FF}"
    r"\x{1F680}-\x{1F6FF}"
    r"\x{1F1E0}-\x{1F1FF}"
    r"\x{2702}-\x{27B0}"
    r"\x{24C2}-\x{1F251}]+"
)
EMOJI_NARROW = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}"
    r"\x{2702}-\x{27B0}]+"
)
ASCII_PUNCTUATION = r"[!-/:-@\[-`{-~]"
NOT_WORD_OR_SPACE = rf"[^{WORD}{SPACE}]"
DIGITS = r"\p{Nd}+"
HASHTAG = rf"#[{WORD}]+"
MENTION = rf"@[{WORD}]+"
HASHTAG_BODY = rf"#([{WORD}]+)"
MENTION_BODY = rf"@([{WORD}]+)"

# --- fixed values: date format -------------------------------------------------------------
DAY_FORMAT = "dd-MM-yyyy"

# --- fixed values: class names, codes and the five-level scale -----------------------------
NEGATIVE, NEUTRAL, POSITIVE = "Negative", "Neutral", "Positive"
CLASS_CODES = {"Neutral": "0", "Negative": "1", "Positive": "2"}
NEGATIVE_LEVELS = ["Extremely Negative", "Negative"]
POSITIVE_LEVELS = ["Extremely Positive", "Positive"]
NUMERIC_CODES = {"Positive": 1, "Neutral": 0, "Negative": 2}

# --- fixed values: marks that join Spark's English stop words ------------------------------
STOP_MARKS = [
    "!", "?", "@", "...", "'", ",", ".", "!", "!!", "_", "??", "???", ":", ";", "-LRB-", "-RRB-",
    "#", "`", "'s", "-", "&", "''", "``", "n't", "‰", "¥", "˜", "ð", "®", "¹", "¦", "¶", "•",
    "-lsb-", "-rsb-", "amp",
]

# --- fixed values: the English stop words of the three cleaners ----------------------------
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself
yourselves he him his himself she she's her hers herself it it's its itself they them their
theirs themselves what which who whom this that that'll these those am is are was were be been
being have has had having do does did doing a an the and but if or because as until while of at
by for with about against between into through during before after above below to from up down
in out on off over under again further then once here there when where why how all any both each
few more most other some such no nor not only own same so than too very s t can will just don
don't should should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn
doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn
needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# --- fixed values: suffix rules of the dictionary lemmatiser, by part of speech -------------
SUFFIX_RULES = {
    "n": [("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"),
          ("shes", "sh"), ("men", "man"), ("ies", "y")],
    "v": [("s", ""), ("ies", "y"), ("es", "e"), ("es", ""), ("ed", "e"), ("ed", ""),
          ("ing", "e"), ("ing", "")],
}
