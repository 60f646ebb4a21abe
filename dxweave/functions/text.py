"""Scalar text functions, all built from Spark SQL expressions (``Column -> Column``).

Two conventions hold throughout.  "Blank" means any character Python's ``str.strip``
removes, not only the ASCII space Spark's ``trim`` knows.  List-valued cells are
``array<string>`` inside the engine; the pipe form exists only at its edges.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

from dxweave import vocab as V

# Every character that counts as white space (fixed values of the Unicode standard).
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Zero-width, bidirectional and byte-order marks, as ranges of a character class.
INVISIBLE = "\u200b-\u200f\u202a-\u202e\u2060\ufeff"
# Stripped from the two ends of a term before it is compared.
LEADING_NOISE = " .,;:，。；：、)]】）"
TRAILING_NOISE = " .,;:，。；：、([【（"
# Characters with a digit value beyond the decimal digits, as ranges: superscripts,
# subscripts, circled, parenthesised and full-stop digits, and older numeral systems.
DIGIT_FORMS = (
    "\u00b2\u00b3\u00b9\u1369-\u1371\u19da\u2070\u2074-\u2079\u2080-\u2089"
    "\u2460-\u2468\u2474-\u247c\u2488-\u2490\u24ea\u24f5-\u24fd\u24ff"
    "\u2776-\u277e\u2780-\u2788\u278a-\u2792"
    "\U00010a40-\U00010a43\U00010e60-\U00010e68\U00011052-\U0001105a"
    "\U0001f100-\U0001f10a"
)
_REGEX_SPECIAL = set(r"\^$.|?*+()[]{}-&~#")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is evaluated once however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def escape(text: str) -> str:
    """``text`` as a literal inside a regular expression or character class."""
    return "".join("\\" + ch if ch in _REGEX_SPECIAL else ch for ch in text)


def char_class(chars: str) -> str:
    return "[" + escape(chars) + "]"


def any_of(words: Sequence[str]) -> str:
    """Alternation over literals, longest first so that no word hides a longer one."""
    return "|".join(escape(w) for w in sorted(words, key=lambda w: (-len(w), w)))


# The same characters as a class of ranges, which matches faster than a list.
_WIDE_BLANKS = "\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BLANK = f"[\t-\r\x1c- {_WIDE_BLANKS}]"
_NOT_SPACE = f"\t-\r\x1c-\x1f{_WIDE_BLANKS}"
# A run of blanks that is not already one space.
_UNEVEN_BLANKS = f"[{_NOT_SPACE}]{BLANK}*| {BLANK}+"


# -- blanks, nulls, lists -----------------------------------------------------


def ws_trim(c: Column) -> Column:
    return F.trim(c, F.lit(BLANKS))


def _trimmed(c: Column) -> Column:
    """``ws_trim`` of a plain reference, which it names several times: most strings have no blank at their ends."""
    blank = F.substring(c, 1, 1).isin(*BLANKS) | F.substring(c, -1, 1).isin(*BLANKS)
    return F.when(blank, ws_trim(c)).otherwise(c)


def null_if_in(c: Column, words: Sequence[str]) -> Column:
    """A cell that equals a placeholder exactly becomes null; nothing is trimmed first."""
    return F.when(~c.isin(*words), c)


def nullish_to_empty(c: Column) -> Column:
    trimmed = ws_trim(F.coalesce(c, F.lit("")))
    return F.when(F.lower(trimmed) == "nan", F.lit("")).otherwise(trimmed)


def trimmed_nonempty(parts: Column) -> Column:
    return F.filter(F.transform(parts, ws_trim), lambda p: p != "")


def split_pipe(c: Column) -> Column:
    """Pieces of a pipe list, trimmed, blank ones dropped; a cell that only says ``nan`` has none."""
    cell = F.coalesce(c, F.lit(""))
    nothing = cell.rlike(rf"\A{BLANK}*[nN][aA][nN]{BLANK}*\z")
    pieces = F.filter(F.transform(F.split(cell, r"\|"), _trimmed), lambda p: p != "")
    return F.when(nothing, F.array().cast("array<string>")).otherwise(pieces)


def join_pipe(parts: Column) -> Column:
    """Pipe-joined list; an empty list is null.  The list is computed once."""
    return _let(parts, lambda p: F.when(F.size(p) > 0, F.array_join(p, "|")))


# -- splitting ----------------------------------------------------------------


#: Stands for a cut while a cell is put together again; not a character of any text (a Unicode noncharacter).
_CUT = "\uffff"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often a lambda inside it is called."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _depths(deltas: Column) -> Column:
    """The depth before each of the steps +1, 0, -1; a depth never falls below 0.

    Steps are taken in blocks of about the square root of their number: first the depth at which each
    block starts, with numbers alone, then the depths inside.  A list only grows within its block.
    """

    def down(depth: Column, delta: Column) -> Column:
        return F.greatest(depth + delta, F.lit(0))

    def scan(start: Column, items: Column, step) -> Column:
        empty = F.struct(start.alias("at"), F.array().cast("array<int>").alias("list"))
        grown = lambda s, x: F.struct(step(s["at"], x).alias("at"), F.concat(s["list"], F.array(s["at"])).alias("list"))
        return F.aggregate(items, empty, grown, lambda s: s["list"])

    def of_blocks(blocks: Column) -> Column:
        starts = scan(F.lit(0), blocks, lambda depth, block: F.aggregate(block, depth, down))
        return F.flatten(F.zip_with(blocks, starts, lambda block, start: scan(start, block, down)))

    width = F.ceil(F.sqrt(F.size(deltas))).cast("int")
    cut = F.transform(F.sequence(F.lit(1), F.size(deltas), width), lambda i: F.slice(deltas, i, width))
    return _let(cut, of_blocks)


def depth_split(c: Column, separators: str = V.TERM_SEPARATORS) -> Column:
    """Split on separators that stand outside brackets.

    All bracket kinds share one counter: any closer undoes any opener, surplus closers
    are ignored and an opener that is never closed shields the rest of the cell.  Cells
    without a bracket take a plain ``split``.  The others are cut into runs (a flat
    bracket pair, a lone bracket, or text without brackets); the separators of runs at depth 0
    become cuts.
    """
    brackets = V.OPENING_BRACKETS + V.CLOSING_BRACKETS
    opening, closing = char_class(V.OPENING_BRACKETS), char_class(V.CLOSING_BRACKETS)
    plain = "[^" + escape(brackets) + "]"
    separator = char_class(separators)
    runs = F.regexp_extract_all(
        c, F.lit(f"{opening}{plain}*{closing}|{char_class(brackets)}|{plain}+"), F.lit(0)
    )

    def delta(run: Column) -> Column:
        opens = run.rlike("^" + opening) & (F.char_length(run) == 1)
        return F.when(opens, 1).when(run.rlike("^" + closing), -1).otherwise(0)

    def cut(run: Column, depth: Column) -> Column:
        return F.when((depth == 0) & ~run.rlike("^" + char_class(brackets)), F.regexp_replace(run, separator, _CUT)).otherwise(run)

    def marked(all_runs: Column) -> Column:
        depths = _let(F.transform(all_runs, delta), _depths)
        return F.array_join(F.zip_with(all_runs, depths, cut), "")

    folded = F.split(_let(runs, marked), _CUT)
    parts = F.when(c.rlike(char_class(brackets)), folded).otherwise(F.split(c, separator))
    return trimmed_nonempty(parts)


def connector_split(term: Column, pack: V.DiagnosisVocab) -> Column:
    """Cut a term at joining words, leaving those inside lexicon words alone.

    Fewer than two chunks give the term back whole, so a leading or trailing connector
    survives; so does a term whose chunks are all stop words or digits.
    """
    if not pack.connectors:
        return F.array(ws_trim(term))
    words = [w for w in pack.lexicon if any(k in w for k in pack.connectors)]
    # One private-use character stands in for each protected word while we cut.
    shields = [(w, chr(0xF0000 + i)) for i, w in enumerate(words)]
    shielded = reduce(lambda c, s: F.replace(c, F.lit(s[0]), F.lit(s[1])), shields, term)
    chunks = F.split(shielded, any_of(pack.connectors))

    def restore(chunk: Column) -> Column:
        chunk = reduce(lambda c, s: F.replace(c, F.lit(s[1]), F.lit(s[0])), shields, chunk)
        if pack.squeeze_chunks:
            return F.regexp_replace(chunk, BLANK + "+", "")
        return ws_trim(chunk)

    chunks = F.filter(F.transform(chunks, restore), lambda p: p != "")
    kept = F.filter(chunks, lambda p: ~p.isin(*pack.stop_terms) & ~is_digits(p))
    whole = F.array(ws_trim(term))
    cut = F.when(F.size(kept) > 0, kept).otherwise(whole)
    return F.when(term.rlike(any_of(pack.connectors)) & (F.size(chunks) > 1), cut).otherwise(whole)


def marker_split(c: Column, pattern: str = V.RISK_MARKER_PATTERN) -> Column:
    """Split on the marker; text after the last marker is a part too."""
    return F.split(c, pattern)


# -- deletions ----------------------------------------------------------------


def drop_ordinal(c: Column) -> Column:
    return F.regexp_replace(c, rf"^\p{{Nd}}+[.、]{BLANK}*", "")


def drop_leading_words(c: Column, words: Sequence[str] = V.OTHER_PREFIXES) -> Column:
    return F.regexp_replace(c, rf"^(?:{any_of(words)}){BLANK}*", "")


def drop_question_marks(c: Column) -> Column:
    return F.translate(c, "?？", "")


def drop_empty_brackets(c: Column) -> Column:
    return F.regexp_replace(c, rf"[（(]{BLANK}*[）)]", "")


def drop_phrases(c: Column, phrases: Sequence[str]) -> Column:
    return ws_trim(reduce(lambda t, p: F.replace(t, F.lit(p), F.lit("")), phrases, c))


def trim_edges(c: Column, chars: str = V.EDGE_CHARACTERS) -> Column:
    return F.trim(c, F.lit(chars))


def remove_first(c: Column, literal: str) -> Column:
    """Remove one occurrence, the first, wherever it stands."""
    return F.regexp_replace(c, rf"(?s)\A(.*?){escape(literal)}", "$1")


def strip_html(c: Column) -> Column:
    """Delete tags.  A tag may span ``\\r`` but not ``\\n``."""
    return F.regexp_replace(c, "(?d)<.*?>", "")


# -- predicates ---------------------------------------------------------------


def is_digits(c: Column) -> Column:
    return c.rlike(rf"^[\p{{Nd}}{DIGIT_FORMS}]+$")


def matches_any(c: Column, patterns: Sequence[str]) -> Column:
    """Full match of one of the patterns."""
    return c.rlike(r"(?d)\A(?:" + "|".join(patterns) + r")\z")


def is_stop_term(c: Column, words: Sequence[str]) -> Column:
    return F.lower(ws_trim(c)).isin(*words)


def is_non_disease(c: Column, pack: V.DiagnosisVocab) -> Column:
    term = ws_trim(c)
    verdict = is_stop_term(c, pack.stop_terms)
    if pack.drop_patterns:
        verdict = verdict | matches_any(term, pack.drop_patterns)
    if pack.drop_keyword:
        supervised = term.contains(pack.drop_keyword)
        if pack.keep_patterns:
            supervised = supervised & ~matches_any(term, pack.keep_patterns)
        verdict = verdict | supervised
    return verdict


def contains_any(c: Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words], F.lit(False))


def is_error_code(code: Column) -> Column:
    return code.contains("ERROR")


def is_missing_code(code: Column) -> Column:
    return (ws_trim(code) == "") | F.lower(code).isin("none", "nan")


def is_usable_code(code: Column) -> Column:
    return ~is_error_code(code) & ~is_missing_code(code)


# -- normalisation and noise --------------------------------------------------


# Finds all invisible characters and blanks but single spaces, and little else: ranges of what is left alone.
_UNUSUAL = "[^ -~\u00a1-\u167f\u1681-\u1fff\u2070-\u2fff\u3001-\ufefe\uff00-\uffef]"
_NAN = tuple("".join(w) for w in product("nN", "aA", "nN"))


def _may_change(term: Column) -> Column:
    """False for most terms that are normalised already: cheaper than to normalise them."""
    first, last = F.substring(term, 1, 1), F.substring(term, -1, 1)
    return term.rlike(_UNUSUAL) | term.contains("  ") | first.isin(*LEADING_NOISE) | last.isin(*TRAILING_NOISE) | term.isin(*_NAN)


def normalize_trimmed(term: Column) -> Column:
    """``normalize_term`` for a term that is neither null nor has blanks at its ends."""
    text = F.when(F.lower(term) == "nan", F.lit("")).otherwise(term)
    visible = F.regexp_replace(text, f"[{INVISIBLE}]", "")
    single_spaced = F.regexp_replace(visible, _UNEVEN_BLANKS, " ")
    changed = F.rtrim(F.ltrim(single_spaced, F.lit(LEADING_NOISE)), F.lit(TRAILING_NOISE))
    return F.when(_may_change(term), changed).otherwise(term)


def normalize_term(c: Column) -> Column:
    """The form in which terms are compared and counted."""
    return normalize_trimmed(ws_trim(F.coalesce(c, F.lit(""))))


def noise_reason(normalized: Column) -> Column:
    """Why a normalised term is noise; null when it is not."""
    return (
        F.when(normalized == "", F.lit(V.NOISE_EMPTY))
        .when(normalized.isin(*V.EXPLICIT_NOISE_TERMS), F.lit(V.NOISE_EXPLICIT))
        .when(normalized.rlike(r"\A[^\p{L}\p{N}]+\z"), F.lit(V.NOISE_PUNCTUATION))
    )


# -- JSON replies -------------------------------------------------------------


def extract_json(reply: Column) -> Column:
    """The JSON object inside a free-text reply, as a string; null when there is none.

    A fenced block is taken first; without one that parses, the span from the first
    opening to the last closing brace.
    """
    fenced = F.regexp_extract(reply, r"(?s)```json\s*(\{.*?\})\s*```", 1)
    bare = F.regexp_extract(reply, r"(?s)\{.*\}", 0)
    return F.when(F.try_parse_json(fenced).isNotNull(), fenced).when(
        F.try_parse_json(bare).isNotNull(), bare
    )


def _field(document: Column, name: str) -> Column:
    return F.try_variant_get(F.try_parse_json(document), f"$.{name}", "variant")


def verdict_code(reply: Column) -> Column:
    """Code of a rule verdict whose ``match_found`` is the boolean true."""
    document = extract_json(reply)
    flag = _field(document, "match_found")
    hit = (F.schema_of_variant(flag) == "BOOLEAN") & F.try_variant_get(flag, "$", "boolean")
    code = F.get_json_object(document, "$.target_code")
    return F.when(hit & (code != ""), code)


def split_terms(reply: Column) -> Column:
    """Sub-terms of a split reply as an array; a scalar counts as a list of one."""
    terms = _field(extract_json(reply), "english_terms")
    scalar = F.coalesce(F.try_variant_get(terms, "$", "string"), F.lit("None"))
    return F.when(
        F.schema_of_variant(terms).startswith("ARRAY"),
        F.try_variant_get(terms, "$", "array<string>"),
    ).when(terms.isNotNull(), F.array(scalar))


def selected_code(reply: Column) -> Column:
    code = F.get_json_object(extract_json(reply), "$.best_match_code")
    return F.when(code != "", code)


def safe_int(c: Column) -> Column:
    return F.coalesce(ws_trim(c.cast("string")).try_cast("bigint"), F.lit(0).cast("bigint"))


# -- formatting and hashing ---------------------------------------------------


def percent_text(x: Column) -> Column:
    """``x`` with four decimals and a percent sign, correctly rounded.

    The midpoint between two neighbouring outputs is an odd multiple of 1/20000.  The
    distance of ``x`` to it is computed without error by splitting ``x`` into two halves
    of 26 bits, so a value is rounded by what the double really is; exact ties go to the
    even neighbour.
    """
    odd = F.floor(x * 10000) * 2 + 1
    carried = x * F.lit(134217729.0)
    high = carried - (carried - x)
    low = x - high
    distance = (high * F.lit(20000.0) - odd.cast("double")) + low * F.lit(20000.0)
    below, above = F.floor((odd - 1) / 2), F.floor((odd + 1) / 2)
    units = (
        F.when(distance < 0, below)
        .when(distance > 0, above)
        .otherwise(F.when(below % 2 == 0, below).otherwise(above))
    )
    return F.format_string("%d.%04d%%", F.floor(units / 10000), units % 10000)


def short_hash(c: Column) -> Column:
    return F.substring(F.md5(c.cast("binary")), 1, 8)


def safe_name(text: str) -> str:
    """A model or table name reduced to characters that are safe in a path."""
    keep = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._-")
    words = "".join(ch if ch in keep else "\0" for ch in text).split("\0")
    squeezed: list[str] = []
    for i, word in enumerate(words):
        if word or i in (0, len(words) - 1):
            squeezed.append(word)
    return "_".join(squeezed)
