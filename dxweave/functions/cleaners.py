"""Composite cell cleaners: free text in, pipe-joined list of diagnosis terms out.

Each is one expression over one column, so a whole table is cleaned in a single
projection without a shuffle.  ``CLEANERS`` is the registry; any ``Column -> Column``
function can be added to it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from dxweave import vocab as V
from dxweave.functions import text as X

Cleaner = Callable[[Column], Column]


def _distinct_cell(terms: Column) -> Column:
    return X.join_pipe(F.array_distinct(terms))


def clean_diagnosis(cell: Column, pack: V.DiagnosisVocab = V.OBSTETRIC) -> Column:
    """Current profile: bracket-aware split, term filters, connector split."""

    def head(term: Column) -> Column:
        term = X.drop_leading_words(X.drop_ordinal(term), pack.leading_words)
        term = X.drop_empty_brackets(X.drop_question_marks(term))
        return X.trim_edges(X.drop_phrases(term, pack.phrases), pack.edge_characters)

    def tail(piece: Column) -> Column:
        piece = X.drop_question_marks(X.trim_edges(piece, pack.edge_characters))
        return X.drop_phrases(X.ws_trim(X.drop_empty_brackets(piece)), pack.phrases)

    terms = F.transform(X.depth_split(cell, pack.separators), head)
    terms = F.filter(terms, lambda t: (t != "") & ~X.is_non_disease(t, pack))
    pieces = F.flatten(F.transform(terms, lambda t: X.connector_split(t, pack)))
    pieces = F.filter(
        F.transform(pieces, tail),
        lambda p: (p != "") & ~X.is_non_disease(p, pack) & ~X.is_digits(p),
    )
    return _distinct_cell(pieces)


def clean_diagnosis_plain(cell: Column, pack: V.DiagnosisVocab = V.OBSTETRIC_ARCHIVED) -> Column:
    """Archived profile: no connector split, no phrase removal, fewer separators."""

    def head(term: Column) -> Column:
        term = X.drop_leading_words(X.drop_ordinal(term), pack.leading_words)
        return X.trim_edges(term, pack.edge_characters)

    terms = F.transform(X.depth_split(cell, pack.separators), head)
    terms = F.filter(
        terms, lambda t: (t != "") & ~X.is_non_disease(t, pack) & ~X.is_digits(t)
    )
    return _distinct_cell(terms)


def clean_risk(cell: Column, pack: V.RiskVocab = V.RiskVocab()) -> Column:
    """Risk items end in a colour marker and may start with the name of a body system."""

    def item(part: Column) -> Column:
        return X.ws_trim(reduce(X.remove_first, pack.prefixes, X.ws_trim(part)))

    items = F.transform(X.marker_split(cell, pack.marker_pattern), item)
    items = F.filter(items, lambda t: (t != "") & ~t.isin(*pack.stop_terms))
    return _distinct_cell(items)


def clean_complication(cell: Column) -> Column:
    """Archived complications profile.

    Sizes such as ``0.5x0.5cm`` are matched first by every deletion and put back, which
    keeps their decimal points out of reach of the ordinal rules.
    """
    size = f"({V.COMPLICATION_SIZE_PATTERN})"
    text = X.drop_leading_words(cell)
    text = F.regexp_replace(text, rf"{size}|\p{{Nd}}+\.{X.BLANK}*", "$1")
    text = F.translate(text, "。?？", "")
    text = F.regexp_replace(text, rf"{size}|\p{{Nd}}+[、.]", "$1")
    stop = V.COMPLICATION_STOP_TERMS
    terms = F.filter(
        X.trimmed_nonempty(F.split(text, "[;；,，、]")),
        lambda t: ~t.isin(*stop) & ~X.is_digits(t),
    )
    words = F.flatten(F.transform(terms, lambda t: F.split(t, X.BLANK + "+")))
    words = F.transform(words, lambda w: F.regexp_replace(w, "^" + V.COMPLICATION_PREFIX, ""))
    words = F.filter(
        words,
        lambda w: ((F.char_length(w) > 1) | w.rlike(r"^\p{L}$")) & ~w.isin(*stop),
    )
    return _distinct_cell(words)


# Private-use characters that open and close the number of a protected span.
_CORD, _GESTATION, _END = "\ue000", "\ue001", "\ue002"
_MARKERS = _CORD + _GESTATION + _END
_MARK = f"[{_CORD}{_GESTATION}][^{_END}]*{_END}"
_DIGITS = "0123456789"
_SHIELDED_DIGITS = "".join(chr(0xE010 + i) for i in range(10))


def _gestation_patterns() -> tuple[str, ...]:
    """Gestation spans, most specific first; none reaches across a protected span."""
    inside = f"[^\n{_MARKERS}]*?"
    dated = r"孕\p{Nd}+产\p{Nd}+孕\p{Nd}+\+\p{Nd}+周"
    return (
        rf"孕\p{{Nd}}+\+\p{{Nd}}+周\({inside}\)",
        rf"{dated}{inside}(?:左|右)(?:枕|骶)(?:前|后|横)(?:早产临产)?",
        rf"{dated}{inside}(?:单|双|多)活胎",
        rf"{dated}{inside}(?=[,，;；]|$)",
    )


def _protect(cell: Column, pattern: str, opener: str) -> Column:
    """Put markers around each match that is not already between markers."""
    outside = f"(?![^{_MARKERS}]*{_END})"
    return F.regexp_replace(cell, f"({pattern}){outside}", f"{opener}$1{_END}")


def _mask(segments: Column) -> Column:
    """The cell with every protected span replaced by its number in private-use digits."""

    def one(segment: Column, i: Column) -> Column:
        number = F.translate(i.cast("string"), _DIGITS, _SHIELDED_DIGITS)
        masked = F.concat(F.left(segment, F.lit(1)), number, F.lit(_END))
        return F.when(segment.rlike("^" + _MARK), masked).otherwise(segment)

    return F.array_join(F.transform(segments, one), "")


def _unmask(token: Column, segments: Column) -> Column:
    def one(part: Column) -> Column:
        number = F.translate(part, _SHIELDED_DIGITS + _MARKERS, _DIGITS)
        span = F.translate(F.get(segments, number.try_cast("int")), _MARKERS, "")
        return F.when(part.rlike("^" + _MARK), span).otherwise(part)

    parts = F.regexp_extract_all(token, F.lit(f"{_MARK}|[^{_MARKERS}]+"), F.lit(0))
    restored = F.array_join(F.transform(parts, one), "")
    return F.when(token.rlike(_MARK), restored).otherwise(token)


def _rewrite_cause(text: Column, keep_text_before: bool) -> Column:
    """``<before>查因：<cause>`` becomes ``<cause>``; what stood before is lost by default."""
    word = f"{V.CAUSE_WORD}[：:]"
    if keep_text_before:
        return F.regexp_replace(text, word, "")
    rewritten = F.regexp_replace(text, rf"(?d).*?{word}(.*?)(?=$|[,，;；])", "$1")
    return F.when(text.contains(V.CAUSE_WORD), rewritten).otherwise(text)


def _normalise_symbols(text: Column) -> Column:
    text = F.translate(text, "?？", "  ")
    text = F.regexp_replace(text, r"\p{Nd}+\.|[.*\\/、]", " ")
    text = F.translate(text, "。", "")
    text = reduce(lambda c, p: F.replace(c, F.lit(p), F.lit("")), V.INDICATION_REQUEST_PHRASES, text)
    others = X.any_of(V.OTHER_PREFIXES)
    return F.regexp_replace(text, f"{X.BLANK}+(?:{others}){X.BLANK}+", " ")


def clean_indication(cell: Column, keep_text_before_cause: bool = False) -> Column:
    """Archived indications profile.

    Cord and gestation spans are lifted out first and put back last, because they contain
    characters the steps between treat as separators.  A lifted span leaves its number
    behind in characters no later rule can match.
    """
    stop, other_blank = V.INDICATION_STOP_TERMS, f"[^{X.BLANK[1:-1]}]+"
    text = X.drop_leading_words(X.ws_trim(F.translate(cell, _MARKERS + _SHIELDED_DIGITS, "")))
    text = reduce(lambda c, p: _protect(c, p, _CORD), V.CORD_PATTERNS, text)
    text = reduce(lambda c, p: _protect(c, p, _GESTATION), _gestation_patterns(), text)
    segments = F.regexp_extract_all(text, F.lit(f"{_MARK}|[^{_MARKERS}]+"), F.lit(0))

    def tokens_of(term: Column) -> Column:
        """Words of a term; a term of several words also loses its stop words."""
        words = F.regexp_extract_all(term, F.lit(f"{_MARK}|{other_blank}"), F.lit(0))
        loose = term.contains(" ") & ~term.rlike(_MARK)
        return F.filter(words, lambda w: ~(loose & w.isin(*stop)))

    def restore(token: Column, spans: Column) -> Column:
        """A span that stands alone stays whole; one glued to a word is cut at blanks."""
        restored = _unmask(token, spans)
        whole = token.rlike(rf"\A{_MARK}\z")
        return F.when(whole, F.array(restored)).otherwise(F.split(restored, X.BLANK + "+"))

    def tokens(spans: Column) -> Column:
        body = _rewrite_cause(_mask(spans), keep_text_before_cause)
        body = F.regexp_replace(body, rf"{X.BLANK}+([(（])", "$1")
        plus_splits = F.when(body.contains(_GESTATION), body).otherwise(F.replace(body, F.lit("+"), F.lit(",")))
        terms = F.transform(
            F.split(_normalise_symbols(plus_splits), "[;；,，]"),
            lambda t: X.ws_trim(X.drop_empty_brackets(X.ws_trim(t))),
        )
        terms = F.filter(terms, lambda t: (t != "") & ~t.isin(*stop))
        words = F.flatten(F.transform(terms, tokens_of))
        return F.flatten(F.transform(words, lambda w: restore(w, spans)))

    kept = F.filter(
        X.let(segments, tokens),
        lambda t: (t != "") & ~X.is_digits(t) & ~t.rlike(rf"^\p{{Nd}}*{V.WEEK_WORD}$"),
    )
    return _distinct_cell(kept)


CLEANERS: dict[str, Cleaner] = {
    "diagnosis": clean_diagnosis,
    "diagnosis_plain": clean_diagnosis_plain,
    "risk": clean_risk,
    "complication": clean_complication,
    "indication": clean_indication,
}
