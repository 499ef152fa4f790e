"""Turning descriptions into terms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token is a run of two or more letters, digits or underscores.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

# The English stop words Spark ships with its StopWordsRemover, but
# for contractions, which the token pattern never yields whole.
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him
    his himself she her hers herself it its itself they them their theirs themselves
    what which who whom this that these those am is are was were be been being have
    has had having do does did doing a an the and but if or because as until while of
    at by for with about against between into through during before after above below
    to from up down in out on off over under again further then once here there when
    where why how all any both each few more most other some such no nor not only own
    same so than too very s t can will just don should now cannot could ought would
    """.split()
)


def terms(text: Column, stop_words: tuple[str, ...] = STOP_WORDS) -> Column:
    """The words of a text without stop words, then its pairs of neighbouring words.

    Pairs are formed after stop words are gone, so they may span one.
    """
    found = F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))
    words = F.filter(found, lambda w: ~w.isin(*stop_words))
    # Named as often as it is used, a text would be searched that often.
    return once(words, lambda w: F.concat(w, neighbours(w)))


def neighbours(words: Column) -> Column:
    rest = F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))
    return F.transform(rest, lambda b, i: F.concat(F.get(words, i), F.lit(" "), b))


def tallied(found: Column) -> Column:
    """The distinct members of an array without nulls with how often each occurs, by member: the
    runs of the sorted array, so a row is counted by itself and nothing is shuffled."""
    ordered = F.sort_array(found)

    def runs(array: Column) -> Column:
        places = F.slice(F.sequence(F.lit(0), F.size(array)), F.lit(1), F.size(array))
        starts = F.filter(
            places, lambda i: ~F.get(array, i).eqNullSafe(F.get(array, i - 1))
        )
        return once(
            starts,
            lambda at: F.transform(
                at,
                lambda i, k: F.struct(
                    F.get(array, i).alias("term"),
                    (F.coalesce(F.get(at, k + 1), F.size(array)) - i).cast("long").alias("tf"),
                ),
            ),
        )

    return once(ordered, runs)


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often `body` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
