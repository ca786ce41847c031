"""String expressions: cleaning, counting and title extraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearsay import labels
from hearsay.functions.arrays import let


def contains_any(text: Column, words: Column) -> Column:
    return F.exists(words, lambda w: F.contains(text, w))


def count_occurrences(text: Column, word: str) -> Column:
    """Overlapping occurrences: a zero-width match at every start position."""
    if not word:
        return F.lit(0)
    return F.regexp_count(text, F.lit(f"(?={_quoted(word)})"))


def count_pair(text: Column, words: str) -> Column:
    """``a;b`` counts the pairs that can be formed, a single word its occurrences."""
    parts = words.split(";")
    if len(parts) == 1:
        return count_occurrences(text, words)
    return F.least(count_occurrences(text, parts[0]), count_occurrences(text, parts[1]))


def _quoted(word: str) -> str:
    return "\\Q" + word.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def clean_body(text: Column) -> Column:
    """Drop quotes, square brackets and characters outside the basic plane."""
    return F.regexp_replace(text, "[\\[\\]'\"]|[^\\x{0000}-\\x{FFFF}]", "")


def clean_content(text: Column) -> Column:
    return F.regexp_replace(text, "['\"]|[^\\x{0000}-\\x{FFFF}]", "")


def clean_noise(title: Column) -> Column:
    return F.regexp_replace(title, labels.TITLE_NOISE, "")


def body_segments(body: Column, subject: Column) -> Column:
    """Comma-separated body as distinct segments longer than one character, without the subject."""
    return segment_set(F.split(body, ","), subject)


def segment_set(segments: Column, subject: Column) -> Column:
    def strip(segment: Column) -> Column:
        named = F.when(F.length(subject) > 0, F.replace(segment, subject, F.lit("")))
        return F.regexp_replace(F.coalesce(named, segment), "</?p>|[<>/ ]", "")

    return F.filter(F.array_distinct(F.transform(segments, strip)), lambda s: F.length(s) > 1)


def subject_name(keys: Column) -> Column:
    """Second space-separated token, or the whole text when there is none."""
    return F.coalesce(F.try_element_at(F.split(keys, " "), F.lit(2)), keys)


def missing_to_null(text: Column) -> Column:
    """Empty text and the literal ``null`` both mean missing."""
    return F.when(~text.isin("", "null"), text)


def truncate_summary(text: Column, longer_than: int, keep: int = 100) -> Column:
    return F.when(F.length(text) > longer_than, F.substring(text, 1, keep)).otherwise(text)


def nonword_length(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"\w+", ""))


def title_pieces(title: Column) -> Column:
    """Candidate pieces of a title: split on marks, then on spaces; empty pieces are dropped."""

    def cut(by_mark: Column) -> Column:
        by_space = F.split(title, " ")
        unmarked = F.size(F.filter(by_mark, lambda p: p != "")) <= 1
        unmarked = unmarked & ~F.rlike(title, F.lit(f"^(?:{labels.TITLE_MARKS})"))
        pieces = F.flatten(F.transform(by_mark, lambda p: F.split(p, " ")))

        def whole(long_words: Column) -> Column:
            return F.when(F.size(long_words) > 0, long_words).otherwise(F.array(title))

        words = let(F.filter(by_space, lambda p: F.length(p) > 4), whole)
        return F.filter(F.when(~unmarked, pieces).otherwise(words), lambda p: p != "")

    return let(F.split(title, labels.TITLE_MARKS), cut)


def pick_most_nonword(pieces: Column) -> Column:
    """The piece with most non-word characters; the first one on ties."""
    ranked = F.transform(
        pieces, lambda p, i: F.struct(nonword_length(p).alias("n"), (-i).alias("o"), p.alias("p"))
    )
    return F.array_max(ranked)["p"]


def clean_title(
    title: Column,
    subject: Column,
    any_character: bool = True,
    min_length: int = 5,
    quote_noise: str = "[“#”]",
) -> Column:
    """Headline of a title.

    A quoted passage wins; otherwise the piece with most non-word characters, preferably among the
    pieces that mention the subject (as a whole, or ``any_character`` of it) and have ``min_length``.
    """
    def best(pieces: Column, subject_parts: Column) -> Column:
        def mentions(piece: Column) -> Column:
            if any_character:
                return F.exists(subject_parts, lambda c: F.contains(piece, c))
            return F.contains(piece, subject)

        def choice(named: Column) -> Column:
            return (
                F.when(F.size(named) > 0, pick_most_nonword(named))
                .when(F.size(pieces) > 0, pick_most_nonword(pieces))
                .otherwise(title)
            )

        return let(F.filter(pieces, lambda p: mentions(p) & (F.length(p) >= min_length)), choice)

    characters = F.filter(F.split(subject, ""), lambda c: c != "")
    plain = let(title_pieces(title), lambda pieces: let(characters, lambda parts: best(pieces, parts)))
    quoted = F.regexp_extract(title, labels.QUOTED_TITLE, 0)
    return let(quoted, lambda q: F.when(q != "", F.regexp_replace(q, quote_noise, "")).otherwise(plain))


def strip_title_marks(title: Column) -> Column:
    """Final clean-up of an event title: book marks stay only in matching pairs."""
    paired = F.contains(title, F.lit("《")) & F.contains(title, F.lit("》"))
    return F.when(paired, F.regexp_replace(title, r"[\[@\]|]", "")).otherwise(
        F.regexp_replace(title, r"[\[@\]|《》]", "")
    )
