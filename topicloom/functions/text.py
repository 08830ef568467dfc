"""Text normalisation as Column expressions: no UDF, no shuffle."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, functions as F

from topicloom.functions.arrays import let
from topicloom.functions.words import DOMAIN_STOPWORDS, ENGLISH_STOPWORDS, IRREGULAR_PLURALS, NO_PLURALS, SCIENCE_ENDINGS

# The patterns decide which characters survive, so they must not change.
URL_PATTERN = r"http\S+|www\S+|https\S+"
EMAIL_PATTERN = r"\S+@\S+"
SYMBOL_PATTERN = r"[^a-zA-Z0-9\s]"
UNICODE_SYMBOL_PATTERN = r"[^\p{L}\p{N}\s]"
SPACE_PATTERN = r"\s+"

# One-word contractions that a word tokeniser splits in two.
CONTRACTIONS = (
    ("can", "not"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("wan", "na"),
)

_CONTRACTED = tuple("".join(parts) for parts in CONTRACTIONS)

# \s and \S match every Unicode space, not just the ASCII ones.
_UNICODE_CLASSES = "(?U)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _if_found(c: Column | str, needles: tuple[str, ...], rewrite: Callable[[Column], Column]) -> Column:
    """Rewrite only texts that contain a needle: a byte search is far cheaper than a regex."""

    def guarded(t: Column) -> Column:
        found = reduce(lambda a, b: a | b, [t.contains(n) for n in needles])
        return F.when(found, rewrite(t)).otherwise(t)

    return let(_col(c), guarded)


def fill_missing(c: Column | str) -> Column:
    """Missing text becomes the empty string."""
    return F.coalesce(_col(c), F.lit(""))


def drop_urls(c: Column | str) -> Column:
    """Delete everything from ``http`` or ``www`` to the next space."""
    return _if_found(c, ("http", "www"), lambda t: F.regexp_replace(t, _UNICODE_CLASSES + URL_PATTERN, ""))


def drop_emails(c: Column | str) -> Column:
    """Delete space-free runs around an ``@``."""
    return _if_found(c, ("@",), lambda t: F.regexp_replace(t, _UNICODE_CLASSES + EMAIL_PATTERN, ""))


def drop_symbols(c: Column | str, unicode: bool = False) -> Column:
    """Turn everything but letters, digits and spaces into a space.

    Only ASCII letters are kept by default; ``unicode=True`` keeps all letters.
    """
    pattern = UNICODE_SYMBOL_PATTERN if unicode else SYMBOL_PATTERN
    return F.regexp_replace(_col(c), _UNICODE_CLASSES + pattern, " ")


def squeeze_spaces(c: Column | str) -> Column:
    """One space between words, none at the ends."""
    return F.trim(F.regexp_replace(_col(c), _UNICODE_CLASSES + SPACE_PATTERN, " "))


def clean_text(c: Column | str, unicode: bool = False) -> Column:
    """Lower-case text without URLs, e-mail addresses and symbols.

    Dropping symbols and then squeezing spaces leaves one space for every run of
    characters that are neither letter nor digit, so both are one replacement here.
    """
    return F.trim(F.regexp_replace(_without_addresses(c), _gaps(unicode), " "))


def _without_addresses(c: Column | str) -> Column:
    return drop_emails(drop_urls(F.lower(fill_missing(c))))


def _gaps(unicode: bool) -> str:
    # \P{Alnum} is [^a-zA-Z0-9], but several times faster: one table lookup per character
    return r"[^\p{L}\p{N}]+" if unicode else r"\P{Alnum}+"


def _split_contractions(c: Column | str) -> Column:
    heads = "|".join(f"{head}(?={tail}\\b)" for head, tail in CONTRACTIONS)
    return F.regexp_replace(_col(c), rf"\b({heads})", "$1 ")


def _split_words(c: Column | str) -> Column:
    return F.split(_if_found(c, _CONTRACTED, _split_contractions), " ")


def _clean_words(c: Column | str, unicode: bool = False) -> Column:
    """Words of ``clean_text``, and empty ones at the ends. A text without contractions is split
    where it would be cleaned, so its cleaned form is never written out."""

    def words(t: Column) -> Column:
        found = reduce(lambda a, b: a | b, [t.contains(n) for n in _CONTRACTED])
        cleaned = F.trim(F.regexp_replace(t, _gaps(unicode), " "))
        return F.when(found, F.split(_split_contractions(cleaned), " ")).otherwise(F.split(t, _gaps(unicode)))

    return let(_without_addresses(c), words)


def tokenize(c: Column | str) -> Column:
    """Words of cleaned text, with one-word contractions split."""
    return F.filter(_split_words(c), lambda t: t != "")


def noun_lemma(token: Column) -> Column:
    """Singular of an English noun by irregular forms and suffix rules.

    The rules see no dictionary, so a lemma table (see ``operators.normalise``) is better
    where one is at hand. Words in -uses are plurals of -us after most consonants (viruses), of
    -use otherwise (causes).
    """
    science = reduce(lambda a, b: a | b, [token.endswith(e) for e in SCIENCE_ENDINGS])
    of_us = token.endswith("uses") & (F.length(token) >= 7) & token.substr(F.length(token) - 4, F.lit(1)).isin(*"ehiknprst")
    irregular = F.create_map(*[F.lit(x) for pair in IRREGULAR_PLURALS.items() for x in pair])
    return (
        F.when(~token.endswith("s"), F.when(token.isin(list(IRREGULAR_PLURALS)), irregular[token]).otherwise(token))
        .when(token.isin([w for w in IRREGULAR_PLURALS if w.endswith("s")]), irregular[token])
        .when((F.length(token) <= 3) | science | token.isin(list(NO_PLURALS)), token)
        .when(token.endswith("ss") | token.endswith("us") | token.endswith("is"), token)
        .when(token.endswith("ies") & (F.length(token) > 4), F.concat(token.substr(F.lit(1), F.length(token) - 3), F.lit("y")))
        .when(
            token.endswith("ches") | token.endswith("shes") | token.endswith("xes")
            | token.endswith("zes") | token.endswith("sses") | of_us,
            token.substr(F.lit(1), F.length(token) - 2),
        )
        .otherwise(token.substr(F.lit(1), F.length(token) - 1))
    )


def lemmatize(tokens: Column | str) -> Column:
    """Every token replaced by its lemma."""
    return F.transform(_col(tokens), noun_lemma)


def stopword_list(extra: tuple[str, ...] = DOMAIN_STOPWORDS) -> list[str]:
    """English stopwords plus domain words."""
    return sorted(set(ENGLISH_STOPWORDS) | set(extra))


def within_length(token: Column, shortest: int = 2, longest: int = 30) -> Column:
    """Length filter of one token, both ends included."""
    return F.length(token).between(shortest, longest)


def not_stopword(token: Column, stopwords: list[str] | None = None) -> Column:
    """Stopword filter of one token."""
    return ~token.isin(stopword_list() if stopwords is None else stopwords)


def only_letters(token: Column) -> Column:
    """Alphabetic filter of one token; cleaned tokens hold letters and digits only."""
    return ~token.rlike("[0-9]")


def filter_tokens(
    tokens: Column | str, shortest: int = 2, longest: int = 30, stopwords: list[str] | None = None
) -> Column:
    """Alphabetic tokens of sensible length that are no stopwords."""
    return F.filter(
        _col(tokens),
        lambda t: within_length(t, max(shortest, 1), longest) & not_stopword(t, stopwords) & only_letters(t),
    )


def join_tokens(tokens: Column | str) -> Column:
    """Tokens as one space-separated string."""
    return F.array_join(_col(tokens), " ")


def preprocess_tokens(
    c: Column | str,
    shortest: int = 2,
    longest: int = 30,
    stopwords: list[str] | None = None,
    lemmas: bool = True,
    unicode: bool = False,
) -> Column:
    """Clean, split, lemmatise, then filter. The order matters: a lemma can be a stopword."""
    words = _clean_words(c, unicode)
    return filter_tokens(lemmatize(words) if lemmas else words, shortest, longest, stopwords)
