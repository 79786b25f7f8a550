"""SQL fragments shared by the oracle statements."""

from __future__ import annotations

from verbatide.functions import fixed_values as V


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def replace(expr: str, pattern: str, by: str) -> str:
    return f"regexp_replace({expr}, {quoted(pattern)}, {quoted(by)}, 'g')"


def split(expr: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, {quoted(V.SPACES)}), lambda w: w <> '')"


def in_list(words: list[str]) -> str:
    return "(" + ", ".join(quoted(w) for w in dict.fromkeys(words)) + ")"


def noise(expr: str) -> str:
    expr = f"lower({expr})"
    for pattern in (V.URL, V.TAG, V.EMOJI, V.ASCII_PUNCTUATION):
        expr = replace(expr, pattern, "")
    return expr


def plain(expr: str) -> str:
    """Words without ASCII punctuation, in lower case."""
    return split(replace(f"lower({expr})", V.ASCII_PUNCTUATION, ""))


CLEANER_STOP = in_list(V.STOP_WORDS)


# --- fixed values: Spark's English stop words, stated here so that SQL needs no session ---------
SPARK_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if
or because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very
s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()

STOP = in_list([w.lower() for w in SPARK_STOP_WORDS + V.STOP_MARKS])


def content(expr: str) -> str:
    return f"list_filter({plain(expr)}, lambda w: w NOT IN {STOP})"


CLASS = (
    "CASE WHEN l.toxic = 1 THEN 'Negative' WHEN l.quality = 1 THEN 'Positive' ELSE 'Neutral' END"
)
CLASSED = f"""classed AS (
  SELECT d.doc_id, d.text, {CLASS} AS Sentiments
  FROM documents d LEFT JOIN labels l USING (doc_id))"""
LABELLED = f"""labelled AS (
  SELECT d.doc_id, d.text, {CLASS} AS Sentiments
  FROM documents d JOIN labels l USING (doc_id))"""
PREDICTIONS = """predictions AS (
  SELECT CASE WHEN l_quantity < 15 THEN 0.0::DOUBLE WHEN l_quantity < 40 THEN 1.0 ELSE 2.0 END AS prediction,
         CASE l_returnflag WHEN 'A' THEN 0.0::DOUBLE WHEN 'N' THEN 1.0 ELSE 2.0 END AS label,
         l_extendedprice / 100000 AS score
  FROM lineitem)"""
GAPS = """gaps AS (
  SELECT event_id, user_id, event_type,
         CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN 'NaN'::DOUBLE ELSE value END AS value
  FROM events)"""
BENCH_WORDS = f"bench_words AS (SELECT DISTINCT unnest({split(noise('text'))}) AS word FROM benchmark)"
ABBREVIATIONS = f"""{BENCH_WORDS},
abbreviations AS (
  SELECT abbrev, min(word) || ' ' || max(word) AS expansion
  FROM (SELECT word, substr(word, 1, n) AS abbrev FROM bench_words, (VALUES (1), (2), (3)) t(n)
        WHERE length(word) > 3)
  WHERE abbrev IN (SELECT word FROM bench_words WHERE length(word) <= 3)
  GROUP BY abbrev)"""
LEXICON = f"""lexicon AS (
  SELECT DISTINCT word AS lemma
  FROM (SELECT unnest({split(noise('text'))}) AS word FROM conversations) WHERE length(word) >= 3)"""
EXCEPTIONS = """exceptions AS (
  SELECT word AS form, substr(word, 1, 4) AS lemma FROM bench_words WHERE length(word) > 4)"""


def lemma_ctes(vocabulary: str, pos: str, with_exceptions: bool) -> str:
    """``lemmas(token, lemma)`` for the tokens of the table ``vocabulary(token)``."""
    tries = [f"SELECT token, 0 AS o, token AS lemma FROM {vocabulary}"]
    for i, (suffix, ending) in enumerate(V.SUFFIX_RULES[pos], 1):
        tries.append(
            f"SELECT token, {i} AS o, substr(token, 1, length(token) - {len(suffix)}) || '{ending}' AS lemma "
            f"FROM {vocabulary} WHERE token LIKE '%{suffix}'"
        )
    rules = " UNION ALL ".join(tries)
    if with_exceptions:
        rules = f"""
          SELECT * FROM ({rules}) WHERE token NOT IN (SELECT form FROM exceptions)
          UNION ALL SELECT token, 0 AS o, token AS lemma FROM {vocabulary} WHERE token IN (SELECT form FROM exceptions)
          UNION ALL SELECT v.token, 1 AS o, e.lemma FROM {vocabulary} v JOIN exceptions e ON v.token = e.form"""
    return f"""tries AS ({rules}),
ranked AS (
  SELECT token, lemma, row_number() OVER (PARTITION BY token ORDER BY length(lemma), o, lemma) AS r
  FROM tries WHERE lemma IN (SELECT lemma FROM lexicon)),
lemmas AS (SELECT token, lemma FROM ranked WHERE r = 1 AND token <> lemma)"""


def stop_values(words: list[str]) -> str:
    return ", ".join(f"({quoted(w)})" for w in dict.fromkeys(words))
