"""Tokenization as column expressions: everything runs inside the JVM, one pass per text."""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.stopwords import ENGLISH_STOP_WORDS

# What counts as a URL-like token, a clitic ending and a word.
URL_ENDINGS = ["com", "org", "net", "edu", "gov", "io"]
CLITICS = ["'s", "n't", "'re", "'ve", "'ll", "'d", "'m"]
LETTER, ALNUM = r"\p{L}", r"[\p{L}\p{N}]"

URL_TOKEN = (
    r"(?<!\S)(?:(?:https?://|www\.)\S*|[\p{L}\p{N}.-]+\.(?:"
    + "|".join(URL_ENDINGS)
    + r")(?:/\S*|(?!\S)))"
)
# No URL-like token can do without one of these, so most texts skip the pattern.
URL_HINTS = ["://", "www."] + ["." + e for e in URL_ENDINGS]
CLITIC_ENDING = "(?:" + "|".join(CLITICS) + r")(?!\S)"
ALPHA_WORD = rf"(?<!{ALNUM}){LETTER}++(?!\p{{N}})"
ANY_WORD = rf"{ALNUM}+"
ANY_TOKEN = rf"{ALNUM}+|[^\p{{L}}\p{{N}}\s]+"


def _only_if(condition: Column, changed: Column, text: Column) -> Column:
    return F.when(condition, changed).otherwise(text)


def straighten(text: Column) -> Column:
    """Text as string with typographic apostrophes replaced."""
    return F.replace(text.cast("string"), F.lit("’"), F.lit("'"))


def drop_urls(text: Column) -> Column:
    """Remove whole whitespace-separated tokens that look like URLs."""
    hinted = reduce(or_, [F.contains(text, F.lit(h)) for h in URL_HINTS])
    return _only_if(hinted, F.regexp_replace(text, URL_TOKEN, " "), text)


def drop_clitics(text: Column) -> Column:
    """Cut ``'s``, ``n't`` and the like from the end of whitespace-separated tokens."""
    has_apostrophe = F.contains(text, F.lit("'"))
    return _only_if(has_apostrophe, F.regexp_replace(text, CLITIC_ENDING, ""), text)


def segment(text: Column, alpha_only: bool = True, keep_punct: bool = False) -> Column:
    """Split text into words: letter-only words, alphanumeric words, or also punctuation runs."""
    pattern = ALPHA_WORD if alpha_only else ANY_TOKEN if keep_punct else ANY_WORD
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def drop_stop_words(tokens: Column, stop_words=ENGLISH_STOP_WORDS) -> Column:
    """Stop words are compared without case; a long list becomes one hash lookup per token."""
    words = sorted({w.lower() for w in stop_words})
    return F.filter(tokens, lambda t: ~F.lower(t).isin(words)) if words else tokens


def lower_tokens(tokens: Column) -> Column:
    return F.transform(tokens, F.lower)


def surface_tokens(
    text: Column,
    *,
    urls: bool = False,
    clitics: bool = False,
    alpha_only: bool = True,
    keep_punct: bool = False,
    stop_words=ENGLISH_STOP_WORDS,
    lower_first: bool = True,
) -> Column:
    """Tokens before lemmatizing. ``lower_first=False`` keeps case for a case-sensitive table."""
    text = straighten(text)
    text = F.lower(text) if lower_first else text
    text = text if urls else drop_urls(text)
    text = text if clitics else drop_clitics(text)
    tokens = segment(text, alpha_only, keep_punct)
    return drop_stop_words(tokens, stop_words) if stop_words else tokens


def tokenize(text: Column) -> Column:
    """The default tokenizer: lower-case words without URLs, numbers, punctuation, stop words."""
    return surface_tokens(text)


def raw_tokens(text: Column) -> Column:
    """Every token of the text, stop words and punctuation included."""
    return surface_tokens(
        text, urls=True, clitics=True, alpha_only=False, keep_punct=True, stop_words=None
    )


def plain_words(text: Column) -> Column:
    """Lower-case alphanumeric words with stop words kept, for sequence encoding."""
    return surface_tokens(text, urls=True, clitics=True, alpha_only=False, stop_words=None)
