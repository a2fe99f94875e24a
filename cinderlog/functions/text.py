"""Message text: words, term and phrase matching. A word is a run of letters and digits of any script, or underscores."""

from __future__ import annotations

import re
from collections.abc import Sequence

from cinderlog.functions import quoted, quoted_list

_NO_WORD = r"[^\p{L}\p{N}_]+"


def tokens(text: str) -> str:
    """SQL: the lower-case words of a text, in order."""
    return f"filter(split(lower({text}), {quoted(_NO_WORD)}), w -> w <> '')"


def words_of(term: str) -> list[str]:
    """The words of a search term, cut as those of a text; a term without any is an error."""
    found = re.findall(r"\w+", term.lower())
    if not found:
        raise ValueError(f"no word in search term {term!r}")
    return found


def term_words(terms: Sequence[str]) -> list[str]:
    """The different words of all terms, sorted."""
    return sorted({w for t in terms for w in words_of(t)})


def may_match(text: str, terms: Sequence[str], every: bool) -> str:
    """SQL: whether the words (every one, or any) occur as parts of the text, which tokens must do too."""
    held = [f"contains(lower({text}), {quoted(w)})" for w in term_words(terms)]
    return "({})".format((" AND " if every else " OR ").join(held))


def match_any(token_list: str, terms: Sequence[str]) -> str:
    return f"arrays_overlap({token_list}, array({quoted_list(term_words(terms))}))"


def match_all(token_list: str, terms: Sequence[str]) -> str:
    return f"size(array_except(array({quoted_list(term_words(terms))}), {token_list})) = 0"


def match_count(token_list: str, terms: Sequence[str]) -> str:
    """SQL: how many tokens are among the words, repeats included."""
    return f"CAST(size(filter({token_list}, w -> w IN ({quoted_list(term_words(terms))}))) AS BIGINT)"


def match_phrase(token_list: str, phrase: str) -> str:
    """SQL: whether the words of the phrase stand one after another among the tokens."""
    wanted = quoted(f" {' '.join(words_of(phrase))} ")
    return f"contains(concat(' ', array_join({token_list}, ' '), ' '), {wanted})"
