"""Text expressions: cleaning, contact details, whole-word terms, tokens."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobweave.functions import fixed

_WORD = fixed.WORD_CHARACTER
_EMPTY = "cast(array() as array<string>)"


def _empty_strings() -> Column:
    return F.expr(_EMPTY)


def clean_text(text: Column) -> Column:
    """Lower case, no ASCII punctuation but the hyphen, single spaces; null gives ``''``."""
    stripped = F.translate(F.lower(text), fixed.REMOVED_PUNCTUATION, "")
    return F.coalesce(F.trim(F.regexp_replace(stripped, fixed.WHITESPACE_PATTERN, " ")), F.lit(""))


def has_content(text: Column) -> Column:
    """Whether the cleaned text is not empty, found without cleaning: the search ends at the first hit."""
    ignored = re.escape(fixed.REMOVED_PUNCTUATION) + fixed.WHITESPACE_PATTERN.removeprefix("[").removesuffix("]+")
    return F.coalesce(text.rlike(f"[^{ignored}]"), F.lit(False))


def preview(text: Column, chars: int = fixed.PREVIEW_CHARS) -> Column:
    """The first characters, with an ellipsis when something was cut; null gives ``''``."""
    cut = F.when(F.length(text) > chars, F.concat(F.substring(text, 1, chars), F.lit("...")))
    return F.coalesce(cut.otherwise(text), F.lit(""))


def upload_preview(text: Column, placeholder: str = "(no preview)") -> Column:
    """The first 500 characters of an upload, or a placeholder when it had no readable text."""
    return F.coalesce(F.substring(text, 1, fixed.UPLOAD_PREVIEW_CHARS), F.lit(placeholder))


def extract_emails(text: Column) -> Column:
    """All e-mail addresses of the raw text, in order, duplicates kept."""
    found = F.regexp_extract_all(text, F.lit(fixed.EMAIL_PATTERN), F.lit(0))
    # The plain substring test spares the regex on the many texts without an address.
    return F.when(text.contains("@"), found).otherwise(_empty_strings())


def extract_phone_numbers(text: Column) -> Column:
    """All US-style phone numbers of the raw text, in order, duplicates kept."""
    found = F.regexp_extract_all(text, F.lit("(?U)" + fixed.PHONE_PATTERN), F.lit(0))
    return F.when(text.rlike("[0-9]{4}"), found).otherwise(_empty_strings())


# --- whole-word vocabulary terms ---------------------------------------------------------


def _is_word(char: str) -> bool:
    return char.isalnum() or char == "_"


def _alternatives(terms: Sequence[str]) -> str:
    """One regex for all terms that shares common prefixes and prefers the longest term."""
    by_first: dict[str, list[str]] = {}
    ends_here = False
    for term in terms:
        if term:
            by_first.setdefault(term[0], []).append(term[1:])
        else:
            ends_here = True
    branches = []
    for first, rests in sorted(by_first.items()):
        # A single continuation needs no nesting.
        tail = re.escape(rests[0]) if len(rests) == 1 else _alternatives(rests)
        branches.append(re.escape(first) + tail)
    if not branches:
        return ""
    body = "(?:" + "|".join(branches) + ")"
    return body + "?" if ends_here else body


def _edges(term: str, symbol_aware: bool) -> tuple[str, str]:
    """Look-behind and look-ahead of a term.

    A word edge must not touch another word character. At a symbol edge (``c++``) the plain
    word-boundary rule asks for an adjacent word character; the symbol-aware rule
    treats it like a word edge.
    """
    no_before, before = rf"(?<![{_WORD}])", rf"(?<=[{_WORD}])"
    no_after, after = rf"(?![{_WORD}])", rf"(?=[{_WORD}])"
    left = no_before if symbol_aware or _is_word(term[0]) else before
    right = no_after if symbol_aware or _is_word(term[-1]) else after
    return left, right


def _implied(longest: str, term: str, right_edge: str) -> bool:
    """Does finding ``longest`` at a place mean that its prefix ``term`` is there as well?"""
    if longest == term or not longest.startswith(term):
        return False
    next_is_word = _is_word(longest[len(term)])
    return next_is_word if right_edge.startswith("(?=") else not next_is_word


def _with_prefixes(hits: Column, shorter: Sequence[tuple[str, str]]) -> Column:
    """Each hit followed by the shorter terms it implies. ``hits`` is evaluated once."""
    implied: dict[str, list[str]] = {}
    for longest, term in shorter:
        implied.setdefault(longest, []).append(term)
    table = F.create_map(*[F.lit(v) if isinstance(v, str) else F.array(*map(F.lit, v)) for kv in implied.items() for v in kv])
    return F.flatten(
        F.transform(hits, lambda h: F.concat(F.array(h), F.coalesce(F.element_at(table, h), _empty_strings())))
    )


def match_terms(text: Column, terms: Sequence[str], symbol_aware: bool = False) -> Column:
    """The vocabulary terms that occur as whole words: distinct, lower case, sorted.

    Overlapping terms all count. Each group of terms is one regex scanned once: the
    pattern has zero width, so a match never hides one that starts inside it, and of the terms
    starting at one place it reports the longest; shorter ones follow from it by a fixed table.
    Meant for vocabularies of up to a few thousand terms; for larger ones join with
    :func:`jobweave.operators.tagging.match_vocabulary`.
    """
    vocabulary = sorted({t.lower() for t in terms if t})
    groups: dict[tuple[str, str], list[str]] = {}
    for term in vocabulary:
        groups.setdefault(_edges(term, symbol_aware), []).append(term)
    lowered = F.lower(text)
    found = _empty_strings()
    for (left, right), group in sorted(groups.items()):
        pattern = f"{left}(?=({_alternatives(group)}){right})"
        hits = F.array_distinct(F.regexp_extract_all(lowered, F.lit(pattern), F.lit(1)))
        shorter = [(a, b) for a in group for b in group if _implied(a, b, right)]
        if shorter:
            hits = _with_prefixes(hits, shorter)
        found = F.concat(found, hits)
    return F.coalesce(F.array_sort(F.array_distinct(found)), _empty_strings())


def longest_terms(text: Column, terms: Sequence[str]) -> Column:
    """At each place of the lower-case text where some of the lower-case terms stand as whole words, the longest of them; in text order.

    Terms begin and end in a word character. One scan by one pattern, as in :func:`match_terms`.
    """
    if not terms:
        return _empty_strings()
    pattern = f"(?<![{_WORD}])(?=({_alternatives(sorted(set(terms)))})(?![{_WORD}]))"
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(1))


# --- tokens ------------------------------------------------------------------------------


def word_tokens(text: Column, stop_words: Sequence[str] = ()) -> Column:
    """Lower-case words of two or more word characters, stop words removed, in order."""
    words = F.regexp_extract_all(F.lower(text), F.lit(f"[{_WORD}]{{2,}}"), F.lit(0))
    if stop_words:
        dropped = [w.lower() for w in stop_words]
        words = F.filter(words, lambda w: ~w.isin(dropped))
    return F.coalesce(words, _empty_strings())


def with_bigrams(tokens: Column) -> Column:
    """The tokens followed by the pairs of neighbouring tokens."""
    count = F.size(tokens)
    firsts = F.slice(tokens, F.lit(1), F.greatest(count - 1, F.lit(0)))
    seconds = F.slice(tokens, F.lit(2), F.greatest(count - 1, F.lit(0)))
    pairs = F.zip_with(firsts, seconds, lambda a, b: F.concat_ws(" ", a, b))
    return F.concat(tokens, pairs)


def text_segments(text: Column) -> Column:
    """The lower-case text cut into alternating runs of word and non-word characters."""
    pattern = f"[{_WORD}]+|[^{_WORD}]+"
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))
